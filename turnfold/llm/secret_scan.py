"""Secret scan: base patterns and a randomness test battery.  DataFrame and
SQL functions only.

Base spans are assignments to secret-like names, access keys and long hex
runs.  The battery looks at the other long tokens of key characters.  It
infers a token's encoding (decimal, hex, base32, letters, letters of one case
with digits, base64), and within that alphabet takes

* a chi-squared test of uniformity,
* a runs test about the middle of the alphabet,
* a lag-one serial-correlation test.

A token is random-like if none of the three rejects.  Ordinary tokens may look
so by chance, the more the shorter they are.  Hence a p-value against ordinary
words, and false-discovery control (Benjamini-Hochberg) over the whole table
within each encoding and length band.

Each alphabet has its own null: words joined by signs, each word a first-order
chain whose rates are those of the table's recurring words shorter than a
token, within that alphabet.  Such a chain holds what the three tests look at:
how often characters coincide, how often their class changes, and what follows
what.  The p-value is the inverse of the likelihood ratio of a uniform draw to
that chain: under the null the ratio is 1 in the mean, so it is at least 1 / p
with chance at most p.  Signs count for neither side, and ``STRAY`` bounds what
one character can add.  The driver sees the counts of adjacent characters and
of p-values by band, both bounded tables.

Positions are code points, ends exclusive.  Defined results: null text counts
as empty and has no spans; repeated rows get the same spans; ties in start
order by kind; an empty table gives no rows; text columns of any length are
read whole; other columns stay as they are in ``redact``.
"""

from __future__ import annotations

from collections import Counter
from math import log

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KINDS = ("assign", "access", "hex", "random")
ASSIGN = (r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = r"AKIA[A-Z0-9]{16,}"  # a run of AKIA[A-Z0-9]+ with 20 characters or more
# whole runs only: the look behind spares a search from each character of a word
HEX = r"(?<![0-9a-f])[0-9a-f]{24,}+"  # a run of [0-9a-f]+ with 24 characters or more
TOKEN = r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}+={0,2}"
MASK = "[secret]"

FALSE_DISCOVERY = 0.001
REJECT = 3.3  # |z| at which a randomness test rejects
STRAY = 0.05  # share of a word's characters taken to be out of the blue
THIN = 20  # counts a character, below which a null stays near uniform
SHORT = 19  # characters of the longest word that is no token
P_BINS = 400  # of -log10(p), ten to a unit

_DECIMAL = "0123456789"
_HEX_CHARS = "0123456789abcdef"
_BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
_LETTERS = "abcdefghijklmnopqrstuvwxyz"
_ONE_CASE = "abcdefghijklmnopqrstuvwxyz0123456789+/"
_BASE64 = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
_ALPHABETS = (_DECIMAL, _HEX_CHARS, _BASE32, _LETTERS, _ONE_CASE, _BASE64)
_W = "_scan_"


def _let(value: str, name: str, body: str) -> str:
    """``body`` with ``name`` bound to ``value``.  A column that a lambda names
    may be put in its place by the optimiser and then be worked out for each
    element; a bound variable is worked out once a row."""
    return f"element_at(transform(array({value}), {name} -> {body}), 1)"


def _matches(df: DataFrame, name: str, pattern: str, maybe) -> DataFrame:
    """Columns ``m`` (matches) and ``at`` (their starts) of a pattern.  The
    pieces between the matches give the starts: sums of lengths, kept linear
    for texts with very many matches by sums over blocks of 64."""
    m, g = f"{_W}{name}_m", f"{_W}{name}_g"
    none = F.array().cast("array<string>")
    text = F.col(_W + "text")
    df = df.withColumn(m, F.when(maybe, F.regexp_extract_all(text, F.lit(pattern), F.lit(0))).otherwise(none))
    df = df.withColumn(g, F.when(F.size(m) > 0, F.split(text, pattern, -1)).otherwise(none))
    starts = _let(f"named_struct('m', {m}, 'g', {g})", "p", _let(
        "named_struct('g', p.g, 'n', zip_with(p.m, slice(p.g, 1, size(p.m)), (x, y) -> char_length(x) + char_length(y)))", "q",
        _let("named_struct('g', q.g, 'n', q.n, 'b', transform(sequence(0, cast(size(q.n) div 64 as int)), "
             "k -> aggregate(slice(q.n, k * 64 + 1, 64), 0, (a, x) -> a + x)))", "r",
             "transform(r.n, (x, i) -> aggregate(slice(r.b, 1, cast(i div 64 as int)), 0, (a, v) -> a + v)"
             " + aggregate(slice(r.n, cast(i div 64 as int) * 64 + 1, i % 64), 0, (a, v) -> a + v)"
             " + char_length(r.g[i]))")))
    return df.withColumn(f"{_W}{name}_at", F.expr(starts)).drop(g)


def _spans(name: str, order: int) -> str:
    return (f"zip_with({_W}{name}_at, {_W}{name}_m, (s, x) -> "
            f"named_struct('start', s, 'kind', {order}, 'stop', s + char_length(x)))")


def ordinary_pairs(docs: DataFrame, text: str = "text") -> dict[tuple[str, str], int]:
    """Counts of adjacent characters in the table's recurring words of letters
    and digits, shorter than a token; each distinct word counts once.  The
    first of a pair is empty at a word's start.  At most 63 x 62 entries."""
    words = docs.select(F.explode(F.split(F.col(text), "[^A-Za-z0-9]+")).alias("w")).where(F.length("w").between(2, SHORT))
    often = words.groupBy("w").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    pairs = often.selectExpr("explode(transform(sequence(1, length(w)), i -> named_struct("
                             "'a', IF(i = 1, '', substring(w, i - 1, 1)), 'b', substring(w, i, 1)))) AS p")
    counted = pairs.groupBy("p.a", "p.b").agg(F.count(F.lit(1)).alias("n")).collect()
    return {(r["a"], r["b"]): r["n"] for r in counted}


def evidence(pairs: dict[tuple[str, str], int], alphabet: str) -> list[int]:
    """Log likelihood ratios of a uniform draw to the alphabet's null, in
    thousandths, at (place of the character before, 0 at a word's start) x size
    + place - 1.  Without a count all are 0."""
    k, cased = len(alphabet), alphabet == _BASE64
    own = str if cased else (str.upper if alphabet == _BASE32 else str.lower)
    signs = [c for c in alphabet if not c.isalnum()]
    chars = [c for c in alphabet if c.isalnum()]
    n: Counter = Counter()
    for (a, b), count in pairs.items():
        if (not a or own(a) in chars) and own(b) in chars:
            n[own(a), own(b)] += count
    one, before = Counter(), Counter()
    for (a, b), count in n.items():
        one[b] += count
        before[a] += count
    total = sum(one.values())
    out = []
    for a in ["", *alphabet]:
        a = "" if a in signs else a
        for c in alphabet:
            single = (one[c] + THIN) / (total + THIN * len(chars))
            chain = (n[a, c] + THIN * len(chars) * single) / (before[a] + THIN * len(chars))
            null = (1 - STRAY) * chain + STRAY / len(chars)
            out.append(0 if c in signs else round(-1000 * log(len(chars) * null)))
    return out


def _battery(tokens: str, pairs: dict[tuple[str, str], int]) -> str:
    """Expression: tokens (start, t) with encoding, length, test results."""
    tables = " ".join(f"WHEN {len(a)} THEN array({','.join(map(str, evidence(pairs, a)))})" for a in _ALPHABETS)
    encoded = (
        f"transform({tokens}, c -> named_struct('start', c.start, 'stop', c.stop, 't', c.t, 'a', CASE "
        f"WHEN c.t RLIKE '^[0-9]+$' THEN '{_DECIMAL}' "
        f"WHEN c.t RLIKE '^([0-9a-f]+|[0-9A-F]+)$' THEN '{_HEX_CHARS}' "
        f"WHEN c.t RLIKE '^[A-Z2-7]+$' THEN '{_BASE32}' "
        f"WHEN c.t RLIKE '^[A-Za-z]?[a-z]+$' THEN '{_LETTERS}' "
        f"WHEN c.t RLIKE '^([a-z0-9+/_-]+|[A-Z0-9+/_-]+)=*$' THEN '{_ONE_CASE}' ELSE '{_BASE64}' END))")
    indexed = (
        f"transform({encoded}, c -> named_struct('start', c.start, 'stop', c.stop, 'k', char_length(c.a), "
        "'x', transform(split(translate(CASE WHEN char_length(c.a) IN (16, 26, 38) THEN lower(c.t) ELSE c.t END, '-_', '+/'), ''), "
        "v -> cast(instr(c.a, v) as double))))")
    # instr gives 0 for padding; those do not count
    trimmed = (
        f"transform({indexed}, c -> named_struct('start', c.start, 'stop', c.stop, 'k', cast(c.k as double), "
        "'x', filter(c.x, v -> v > 0)))")
    summed = (
        f"transform({trimmed}, c -> named_struct('start', c.start, 'stop', c.stop, 'k', c.k, 'x', c.x, "
        "'n', cast(size(c.x) as double), "
        "'mean', aggregate(c.x, 0D, (a, v) -> a + v) / size(c.x), "
        "'same', aggregate(array_distinct(c.x), 0D, (a, v) -> a + power(size(filter(c.x, w -> w = v)), 2)), "
        "'high', cast(size(filter(c.x, v -> v > c.k / 2)) as double), "
        "'turns', 1D + size(filter(sequence(1, greatest(size(c.x) - 1, 1)), i -> size(c.x) > 1 AND (c.x[i] > c.k / 2) != (c.x[i - 1] > c.k / 2)))))")
    evidence_sum = ("aggregate(sequence(1, size(c.x)), 0L, (a, i) -> "
                    "a + e[cast(IF(i = 1, 0, c.x[greatest(i - 2, 0)]) * c.k + c.x[i - 1] - 1 as int)])")
    moved = (
        f"transform({summed}, c -> named_struct('start', c.start, 'stop', c.stop, 'k', c.k, 'n', c.n, "
        "'chi', c.k * c.same / c.n - c.n, "
        "'turns', c.turns, 'runs', 2 * c.high * (c.n - c.high) / c.n + 1, "
        "'var', aggregate(c.x, 0D, (a, v) -> a + power(v - c.mean, 2)), "
        "'cov', aggregate(sequence(1, greatest(size(c.x) - 1, 1)), 0D, "
        "(a, i) -> a + CASE WHEN size(c.x) > 1 THEN (c.x[i] - c.mean) * (c.x[i - 1] - c.mean) ELSE 0D END), "
        f"'evidence', {_let(f'CASE cast(c.k as int) {tables} END', 'e', evidence_sum)}))")
    tested = (
        f"transform({moved}, c -> named_struct('start', c.start, 'stop', c.stop, 'k', c.k, 'n', c.n, "
        # Wilson and Hilferty: the cube root of chi-squared over its degrees is near normal
        "'uniform', (cbrt(c.chi / (c.k - 1)) - (1 - 2 / (9 * (c.k - 1)))) / sqrt(2 / (9 * (c.k - 1))), "
        "'runs', CASE WHEN c.runs > 2 THEN (c.turns - c.runs) / sqrt((c.runs - 1) * (c.runs - 2) / (c.n - 1)) ELSE 99D END, "
        "'serial', CASE WHEN c.var > 0 THEN c.cov / c.var * sqrt(c.n) ELSE 99D END, "
        "'evidence', c.evidence))")
    return (
        f"transform({tested}, c -> named_struct('start', c.start, 'stop', c.stop, 'k', cast(c.k as int), "
        "'band', cast(floor(log2(c.n)) as int), "
        f"'random', abs(c.uniform) <= {REJECT} AND abs(c.runs) <= {REJECT} AND abs(c.serial) <= {REJECT}, "
        # the evidence is in thousandths of a natural logarithm
        f"'bin', cast(greatest(0, least({P_BINS - 1}, floor(c.evidence / {100 * log(10)!r}))) as int)))")


def scan(docs: DataFrame, text: str = "text", pairs: dict[tuple[str, str], int] | None = None) -> DataFrame:
    """``docs`` with ``_scan_base`` (spans start, kind, stop) and
    ``_scan_tokens`` (tested tokens outside the base spans); row by row.
    ``pairs`` are the table's ``ordinary_pairs``, counted here if not given."""
    pairs = ordinary_pairs(docs, text) if pairs is None else pairs
    df = docs.withColumn(_W + "text", F.coalesce(F.col(text), F.lit("")))
    t = F.col(_W + "text")
    df = _matches(df, "assign", ASSIGN, t.contains("=") | t.contains(":"))
    values = F.when(F.size(_W + "assign_m") > 0, F.regexp_extract_all(t, F.lit(ASSIGN), F.lit(2)))
    df = df.withColumn(_W + "values", F.coalesce(values, F.array().cast("array<string>")))
    df = _matches(df, "access", ACCESS, t.contains("AKIA"))
    df = _matches(df, "hex", HEX, F.lit(True))
    df = _matches(df, "token", TOKEN, F.lit(True))
    long_value = _let(f"named_struct('s', {_spans('assign', 0)}, 'v', {_W}values)", "p",
                      "filter(p.s, (s, i) -> char_length(p.v[i]) >= 6)")
    df = df.withColumn(_W + "base", F.expr(f"array_sort(concat({long_value}, {_spans('access', 1)}, {_spans('hex', 2)}))"))
    found = (f"zip_with({_W}token_at, {_W}token_m, (s, x) -> named_struct('start', s, 'stop', s + char_length(x), 't', x))")
    tokens = _let(f"named_struct('c', {found}, 'base', {_W}base)", "p",
                  "filter(p.c, c -> NOT c.t RLIKE '^(.)\\\\1*$' "
                  "AND NOT exists(p.base, b -> b.start < c.stop AND c.start < b.stop))")
    df = df.withColumn(_W + "plain", F.expr(tokens))
    df = df.withColumn(_W + "tokens", F.expr(_battery(_W + "plain", pairs)))
    made = [f"{_W}{n}_{x}" for n in ("assign", "access", "hex", "token") for x in ("m", "at")]
    return df.drop(*made, _W + "values", _W + "plain", _W + "text")


def discovery_bounds(scanned: DataFrame, rate: float = FALSE_DISCOVERY) -> list[tuple[int, int, int]]:
    """(alphabet, band, least bin) by Benjamini-Hochberg within each encoding
    and length band; from counts per bin, at most 6 x 32 x ``P_BINS`` rows."""
    one = scanned.select(F.explode(_W + "tokens").alias("c")).select("c.*")
    counts = one.groupBy("k", "band", "bin").agg(F.count(F.lit(1)).alias("n")).collect()
    by: dict[tuple[int, int], dict[int, int]] = {}
    for r in counts:
        by.setdefault((r["k"], r["band"]), {})[r["bin"]] = r["n"]
    out = []
    for (k, band), bins in sorted(by.items()):
        total, above, least = sum(bins.values()), 0, None
        for b in sorted(bins, reverse=True):
            above += bins[b]
            if 10.0 ** (-b / 10.0) <= rate * above / total:
                least = b
        if least is not None:
            out.append((k, band, least))
    return out


def with_spans(scanned: DataFrame, bounds: list[tuple[int, int, int]]) -> DataFrame:
    """``_scan_spans``: base spans and the tokens found random, by start."""
    found = " OR ".join(f"(c.k = {k} AND c.band = {band} AND c.bin >= {least})" for k, band, least in bounds) or "false"
    return scanned.withColumn(_W + "spans", F.expr(
        f"array_sort(concat({_W}base, transform(filter({_W}tokens, c -> c.random AND ({found})), "
        "c -> named_struct('start', c.start, 'kind', 3, 'stop', c.stop))))"))


def _joined(spans: str):
    names = "array(" + ", ".join(f"'{k}'" for k in KINDS) + ")"
    return F.expr(f"array_join(transform({spans}, s -> concat_ws(':', {names}[s.kind], s.start, s.stop)), ',')")


def digest(spanned: DataFrame, key: str = "doc_id") -> DataFrame:
    count = lambda kind: F.expr(f"cast(size(filter({_W}base, s -> s.kind = {kind})) as bigint)")
    return spanned.select(
        F.col(key).cast("long").alias("doc_id"), count(0).alias("n_assign"), count(1).alias("n_access"),
        count(2).alias("n_hex"), F.sha2(_joined(_W + "base"), 256).alias("base_sha256"),
        _joined(_W + "spans").alias("spans"))


def redact(docs: DataFrame, text: str = "text", mask: str = MASK) -> DataFrame:
    """``docs`` with every span of ``text`` replaced by ``mask``; overlapping
    spans become one mask, null stays null.  Three passes: the first two
    only count adjacent characters and p-values."""
    pairs = ordinary_pairs(docs, text)
    bounds = discovery_bounds(scan(docs.select(text), text, pairs))
    df = with_spans(scan(docs, text, pairs), bounds)
    cut = (f"aggregate({_W}spans, named_struct('at', 0, 'out', ''), (a, s) -> named_struct("
           "'at', greatest(a.at, s.stop), 'out', CASE WHEN s.start >= a.at THEN "
           f"concat(a.out, substring(`{text}`, a.at + 1, s.start - a.at), '{mask}') ELSE a.out END), "
           f"a -> concat(a.out, substring(`{text}`, a.at + 1)))")
    return df.withColumn(text, F.when(F.size(_W + "spans") > 0, F.expr(cut)).otherwise(F.col(text))).select(*docs.columns)
