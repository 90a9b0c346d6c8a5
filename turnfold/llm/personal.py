"""Personal data: candidate spans judged by gradient-boosted trees.

Four kinds are sought: e-mail addresses, IPv4 addresses, card numbers and
phone numbers.  Base spans follow fixed patterns and checks and always stay.
High-recall generators propose further, overlapping spans: whole tokens around
an at sign, dotted and separated digit groups of any length, and every run of
neighbouring groups that could be a card or a phone number.

Labels come from the table itself.  A candidate is positive if it is a base
span that stands alone; it is negative if it sits inside a longer word or
number, cuts or overlaps a base span, or fails its kind's check (check digit,
octets, number of digits, dotted domain).  The others are unlabelled: numbers
run together with a neighbour, which the base patterns swallow and drop, phone
numbers without a plus, addresses with odd signs.  Features tell format, check
and context (sizes, separators, groups, neighbouring characters and words).
Boosted trees (Newton steps on the logistic loss) are fitted on at most
``SAMPLE`` labelled candidates.  For every kind the threshold is the least
score from which the held-out labelled candidates of the whole table are
positive with a share of ``PRECISION``; without ``ENOUGH`` of both labels
nothing is added.  Added spans overlap no base span and no better added one.

Positions are code points, ends exclusive.  Defined results: null text counts
as empty and has no spans; repeated rows get the same spans; ties between
candidates go to the earlier, the longer, the kind listed first; null ids are
rows of their own; an empty table gives no rows; texts of any length are read
whole; other columns stay as they are in ``redact``.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .frames import hashed_sample, written

KINDS = ("email", "ip", "card", "phone")
SAMPLE = 20_000
PRECISION = 0.98
ENOUGH = 20
SCORE_BINS = 200
ROUNDS, DEPTH, STEP, BINS, L2 = 50, 4, 0.2, 32, 1.0
NEVER = 2.0

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_MARK = re.compile(r"[0-9@]")
_AROUND = re.compile(r"[^\s@<>\"'(),;:]+")
_DOTTED = re.compile(r"[0-9]++(?:\.[0-9]++){2,}")
_GROUPED = re.compile(r"\+?\(?[0-9](?:[ ().-]{0,2}[0-9])+")
_GROUP = re.compile(r"[0-9]+")


def luhn(digits: str) -> bool:
    total = sum(map(int, digits[-1::-2])) + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Around each at sign: the run of local characters before it (none of an
    earlier address) and the domain after it.  Linear in the text."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            yield start, m.end()
        done = m.end() if m else at + 1
        at = text.find("@", done)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) by kind, then start."""
    if not _MARK.search(text):
        return []
    out = [(0, s, e) for s, e in _emails(text)]
    for m in _IP.finditer(text):
        if passes(1, m.group()):
            out.append((1, *m.span()))
    for m in _CARD.finditer(text):
        if passes(2, m.group()):
            out.append((2, *m.span()))
    for m in _PHONE.finditer(text):
        if passes(3, m.group()):
            out.append((3, *m.span()))
    return out


def candidates(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) of the generators; spans overlap.  Each character
    starts a bounded number of them."""
    out = set()
    at = text.find("@")
    while at >= 0:
        right = _AROUND.match(text, at + 1)
        left, lowest = at, max(0, at - 64)
        while left > lowest and not text[left - 1].isspace() and text[left - 1] not in "@<>\"'(),;:":
            left -= 1
        if right and left < at:
            for end in {right.end(), at + 1 + len(right.group().rstrip(".-_!?"))}:
                if at + 1 < end <= at + 129:
                    out.add((0, left, end))
        at = text.find("@", at + 1)
    for m in _DOTTED.finditer(text):
        out.add((1, *m.span()))
    for m in _GROUPED.finditer(text):
        groups = [(m.start() + g.start(), m.start() + g.end()) for g in _GROUP.finditer(m.group())]
        for i, (start, _) in enumerate(groups):
            digits, before = 0, start
            while before > m.start() and text[before - 1] in "+(":
                before -= 1
            for j in range(i, min(i + 8, len(groups))):
                digits += groups[j][1] - groups[j][0]
                if digits > 40 and j > i:
                    break
                if digits >= 12:
                    out.add((2, start, groups[j][1]))
                if 7 <= digits <= 20:
                    out.add((3, before, groups[j][1]))
    return sorted(out)


def passes(kind: int, span: str) -> bool:
    """The check of a kind, without its pattern."""
    digits = "".join(_GROUP.findall(span))
    if kind == 0:
        return _DOMAIN.fullmatch(span.rpartition("@")[2]) is not None and span.rpartition(".")[2].isalpha()
    if kind == 1:
        return _IP.fullmatch(span) is not None and all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in span.split("."))
    return 16 <= len(digits) <= 19 and luhn(digits) if kind == 2 else 8 <= len(digits) <= 15


def _char_class(c: str) -> int:
    if not c or c.isspace():
        return 0
    if c.isalpha():
        return 1
    if c.isdigit():
        return 2
    return 4 if c in "=\"'_:/" else 3


def features(text: str, kind: int, start: int, end: int) -> list[float]:
    """Format of the span, its check and its context."""
    span, before, after = text[start:end], text[max(0, start - 24):start], text[end:end + 24]
    sizes = [len(g) for g in _GROUP.findall(span)] or [0]
    digits = sum(sizes)
    counts = [span.count(str(d)) for d in range(10)]
    words_before, words_after = before.split(), after.split()
    near = words_before[-1] if words_before else ""
    return [kind, passes(kind, span), min(len(span), 200), digits, sum(c.isalpha() for c in span), span.count(" "), span.count("-"), span.count("."),
            span.count("(") - span.count(")"), span.count("("), span[0] == "+", len(sizes), max(sizes), min(sizes), sizes[0], sizes[-1],
            max(counts) / max(digits, 1), sum(n > 0 for n in counts), span[0] == "0", _char_class(before[-1:]),
            _char_class(after[:1]), len(near), any(c.isdigit() for c in near), len(words_after[0]) if words_after else 0,
            sum(c.isalpha() for c in before) / 24, sum(c.isdigit() for c in before) / 24,
            sum(c.isdigit() for c in after) / 24, _char_class(before[-2:-1]), _char_class(after[1:2])]


def label(text: str, base: list[tuple[int, int, int]], kind: int, start: int, end: int) -> int | None:
    inside = text[start - 1:start].isalnum() or text[end:end + 1].isalnum()
    if (kind, start, end) in base:
        return 0 if inside else 1
    if inside or not passes(kind, text[start:end]) or any(s < end and start < e for _, s, e in base):
        return 0
    return None


SPAN = "struct<kind:int,start:int,stop:int>"
CANDIDATE = "struct<kind:int,start:int,stop:int,label:int,x:array<float>>"
_SPAN_TYPE = pa.list_(pa.struct([("kind", pa.int32()), ("start", pa.int32()), ("stop", pa.int32())]))
_CANDIDATE_TYPE = pa.list_(pa.struct([("kind", pa.int32()), ("start", pa.int32()), ("stop", pa.int32()), ("label", pa.int32()),
                                      ("x", pa.list_(pa.float32()))]))


def proposals(column: pa.Array) -> tuple[pa.Array, pa.Array]:
    """Base spans and candidates of every text."""
    base, found = [], []
    for text in column.to_pylist():
        own = base_spans(text) if text else []
        base.append([{"kind": k, "start": s, "stop": e} for k, s, e in own])
        spans = candidates(text) if text and _MARK.search(text) else []
        found.append([{"kind": k, "start": s, "stop": e, "label": label(text, own, k, s, e), "x": features(text, k, s, e)}
                      for k, s, e in spans])
    return pa.array(base, _SPAN_TYPE), pa.array(found, _CANDIDATE_TYPE)


def scan(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, base, candidates`` of every row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), *proposals(batch.column(1))], ["doc_id", "base", "candidates"])

    return (docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
            .mapInArrow(run, f"doc_id long, base array<{SPAN}>, candidates array<{CANDIDATE}>"))


class Booster:
    """Boosted trees of fixed depth over quantile bins, logistic loss."""

    def __init__(self, cuts: np.ndarray, start: float):
        self.cuts, self.start, self.trees = cuts, start, []

    def bins(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(c, x[:, j], side="left") for j, c in enumerate(self.cuts)], axis=1) if len(x) else \
            np.zeros((0, len(self.cuts)), np.int64)

    def _leaf(self, tree, b: np.ndarray) -> np.ndarray:
        feature, cut, _ = tree
        node = np.zeros(len(b), np.int64)
        for _ in range(DEPTH):
            node = 2 * node + 1 + (b[np.arange(len(b)), feature[node]] > cut[node])
        return node - (2**DEPTH - 1)

    def margin(self, b: np.ndarray) -> np.ndarray:
        out = np.full(len(b), self.start)
        for tree in self.trees:
            out += tree[2][self._leaf(tree, b)]
        return out

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(-self.margin(self.bins(x))))


def _grow(b: np.ndarray, g: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """One tree: (feature, cut) of the inner nodes and the leaf values.  A
    node without a gain sends all rows left."""
    n, m = b.shape
    feature, cut = np.zeros(2**DEPTH - 1, np.int64), np.full(2**DEPTH - 1, BINS, np.int64)
    node = np.zeros(n, np.int64)
    for level in range(DEPTH):
        first, width = 2**level - 1, 2**level
        cell = ((node[:, None] - first) * m + np.arange(m)) * BINS + b
        G, H = (np.bincount(cell.ravel(), weights=np.repeat(w, m), minlength=width * m * BINS).reshape(width, m, BINS).cumsum(axis=2)
                for w in (g, h))
        all_g, all_h = G[:, :, -1:], H[:, :, -1:]
        gain = G**2 / (H + L2) + (all_g - G) ** 2 / (all_h - H + L2) - all_g**2 / (all_h + L2)
        gain[(H < 1.0) | (all_h - H < 1.0)] = 0.0
        best = gain.reshape(width, -1).argmax(axis=1)
        for i, at in enumerate(best):
            if gain[i].ravel()[at] > 1e-9:
                feature[first + i], cut[first + i] = divmod(int(at), BINS)
        node = 2 * node + 1 + (b[np.arange(n), feature[node]] > cut[node])
    leaf = node - (2**DEPTH - 1)
    G, H = (np.bincount(leaf, weights=w, minlength=2**DEPTH) for w in (g, h))
    return feature, cut, -STEP * G / (H + L2)


def fit(x: np.ndarray, y: np.ndarray) -> Booster:
    cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, BINS + 1)[1:-1])) for j in range(x.shape[1])]
    share = (y.sum() + 0.5) / (len(y) + 1.0)
    model = Booster(cuts, float(np.log(share / (1 - share))))
    b = model.bins(x)
    margin = model.margin(b)
    for _ in range(ROUNDS):
        p = 1.0 / (1.0 + np.exp(-margin))
        tree = _grow(b, p - y, np.maximum(p * (1 - p), 1e-6))
        model.trees.append(tree)
        margin += tree[2][model._leaf(tree, b)]
    return model


def thresholds(counts: list[tuple[int, int, int, int]]) -> np.ndarray:
    """Least score per kind from (kind, score bin, label, n): from there up
    the held-out candidates are positive with a share of ``PRECISION``."""
    out = np.full(len(KINDS), NEVER)
    table = np.zeros((len(KINDS), 2, SCORE_BINS))
    for kind, at, y, n in counts:
        table[kind, y, at] += n
    for kind, (bad, good) in enumerate(table):
        if min(bad.sum(), good.sum()) < ENOUGH:
            continue
        up_good, up_bad = np.cumsum(good[::-1])[::-1], np.cumsum(bad[::-1])[::-1]
        fine = (up_good >= PRECISION * (up_good + up_bad)) & (up_good > 0)
        at = SCORE_BINS
        while at > 0 and (fine[at - 1] or up_good[at - 1] + up_bad[at - 1] == 0):
            at -= 1
        if at < SCORE_BINS and fine[at]:
            out[kind] = at / SCORE_BINS
    return out


def learn(scanned: DataFrame) -> tuple[Booster | None, np.ndarray]:
    """The booster and the thresholds from the labelled candidates: one in
    four, by a hash of document and place, is held out for the thresholds."""
    one = scanned.select("doc_id", F.explode("candidates").alias("c")).select("doc_id", "c.*").where("label IS NOT NULL")
    one = one.withColumn("place", F.concat_ws("|", "doc_id", "kind", "start", "stop"))
    held = F.pmod(F.crc32("place"), F.lit(4)) == 0
    rows = hashed_sample(one.where(~held).select("place", "label", "x"), "place", SAMPLE, "personal|").toArrow()
    never = np.full(len(KINDS), NEVER)
    y = rows["label"].to_numpy().astype(float)
    if not 0 < y.sum() < len(y):
        return None, never
    x = np.array(rows["x"].to_pylist(), dtype=float)
    model = fit(x, y)
    shared = scanned.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                score = shared.value.score(np.array(batch.column(2).to_pylist(), dtype=float))
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.minimum(score * SCORE_BINS, SCORE_BINS - 1).astype(np.int32)),
                                                  batch.column(1)], ["kind", "at", "label"])

    counts = (one.where(held).select("kind", "label", "x").mapInArrow(run, "kind int, at int, label int")
              .groupBy("kind", "at", "label").count().collect())
    return model, thresholds([tuple(r) for r in counts])


def choose(base: list[dict], found: list[dict], score: np.ndarray, bound: np.ndarray) -> list[tuple[int, int, int, float | None]]:
    """Base spans and the added ones (kind, start, end, score)."""
    out = [(b["kind"], b["start"], b["stop"], None) for b in base]
    ranked = sorted((-s, c["start"], -c["stop"], c["kind"]) for s, c in zip(score.tolist(), found, strict=True)
                    if s >= bound[c["kind"]])
    for s, start, stop, kind in ranked:
        if all(-stop <= o[1] or o[2] <= start for o in out):
            out.append((kind, start, -stop, -s))
    return sorted(out, key=lambda o: o[:3])


def with_spans(scanned: DataFrame, model: Booster | None, bound: np.ndarray) -> DataFrame:
    """``doc_id, base, spans``; a span's score is null for a base span."""
    shared = scanned.sparkSession.sparkContext.broadcast((model, bound))
    span_type = pa.list_(pa.struct([("kind", pa.int32()), ("start", pa.int32()), ("stop", pa.int32()), ("score", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, least = shared.value
        for batch in batches:
            bases, lists = batch.column(1).to_pylist(), batch.column(2).to_pylist()
            flat = np.array([c["x"] for found in lists for c in found], dtype=float)
            score = own.score(flat) if own and len(flat) else np.zeros(len(flat))
            ends = np.cumsum([len(found) for found in lists])
            spans = [[dict(zip(("kind", "start", "stop", "score"), s, strict=True)) for s in
                      choose(b, found if own else [], score[end - len(found):end] if own else score[:0], least)]
                     for b, found, end in zip(bases, lists, ends, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(spans, span_type)], ["doc_id", "base", "spans"])

    return scanned.select("doc_id", "base", "candidates").mapInArrow(
        run, f"doc_id long, base array<{SPAN}>, spans array<struct<kind:int,start:int,stop:int,score:double>>")


def find(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, base, spans`` of every row."""
    scanned = written(scan(docs, key, text), "personal")
    return with_spans(scanned, *learn(scanned))


def joined(spans: str) -> Column:
    names = "array(" + ", ".join(f"'{k}'" for k in KINDS) + ")"
    return F.expr(f"array_join(transform({spans}, s -> concat_ws(':', {names}[s.kind], s.start, s.stop)), ',')")


def digest(found: DataFrame) -> DataFrame:
    counts = [F.expr(f"cast(size(filter(base, s -> s.kind = {i})) as bigint)").alias(f"n_{k}") for i, k in enumerate(KINDS)]
    return found.select("doc_id", *counts, F.sha2(joined("base"), 256).alias("base_sha256"), joined("spans").alias("spans"))


def mask_text(text: str, spans: list[tuple[int, int, int, float | None]]) -> str:
    parts, done = [], 0
    for start, stop, kind in sorted((s[1], s[2], s[0]) for s in spans):
        if stop <= done:
            continue
        if start >= done:
            parts += [text[done:start], f"[{KINDS[kind]}]"]
        done = max(done, stop)
    return "".join([*parts, text[done:]])


def redact(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with each span of ``text`` replaced by its kind in brackets
    (overlapping spans: the first one's); null stays null."""
    model, bound = learn(written(scan(docs, key, text), "personal"))
    shared, at = docs.sparkSession.sparkContext.broadcast((model, bound)), docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, least = shared.value
        for batch in batches:
            out = []
            base, found = (x.to_pylist() for x in proposals(batch.column(at)))
            for t, b, c in zip(batch.column(at).to_pylist(), base, found, strict=True):
                score = own.score(np.array([x["x"] for x in c], dtype=float)) if own and c else np.zeros(0)
                out.append(t if t is None else mask_text(t, choose(b, c if own else [], score, least)))
            yield batch.set_column(at, batch.schema.field(at), pa.array(out, batch.schema.field(at).type))

    return docs.mapInArrow(run, docs.schema)
