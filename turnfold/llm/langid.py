"""Language identification with error-correcting output codes.

Each language has a codeword of bits.  For every bit a binary classifier over
hashed byte n-grams (one to four bytes of letters, A-Z lower-cased) tells the
languages with a 1 from those with a 0; its weights are log odds of n-gram
counts over all learning documents.  Decoding sums, over the bits, the
logistic loss of the bit's margin against a codeword, weighted by how well
the bit parts its training languages, and takes the codeword with the least
loss.  A document whose two best codewords are closer than ``AMBIGUOUS`` is
flagged.

Counts are summed on the executors for all learning rows; what reaches the
driver is languages x ``BUCKETS`` numbers.  Defined results: null texts and
texts without letters are ``und`` with score 0; ties go to the language that
sorts first; repeated rows get equal predictions; a row without an id is in no
fold (``held_out`` null) and is learnt from; without learning rows all are
``und``; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .frames import fold
from .textops import text_slices

BUCKETS = 1 << 15
GRAMS = (1, 2, 3, 4)
AMBIGUOUS = 0.1
SLICE = 1 << 18  # bytes of text whose n-grams a task holds at once
UNKNOWN = "und"

_LETTER = np.full(256, 32, np.uint8)
_LETTER[128:] = np.arange(128, 256)
for _c in range(26):
    _LETTER[65 + _c] = _LETTER[97 + _c] = 97 + _c


def grams(buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, bucket) of every n-gram of a slice; runs of other characters
    count as one space, and n-grams never cross rows."""
    x = _LETTER[buf]
    row = np.repeat(np.arange(len(offs) - 1), np.diff(offs))
    keep = np.ones(len(x), bool)
    if len(x) > 1:
        keep[1:] = (x[1:] != 32) | (x[:-1] != 32) | (row[1:] != row[:-1])
    x, row = x[keep].astype(np.uint64), row[keep]
    rows, cells = [], []
    code = np.zeros(len(x), np.uint64)
    for k in GRAMS:
        n = len(x) - k + 1
        if n <= 0:
            break
        code = code[:n] * np.uint64(257) + x[k - 1:] + np.uint64(1)
        h = (code * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - 15)
        whole = row[:n] == row[k - 1:]
        if k == 1:
            whole &= x[:n] != 32
        rows.append(row[:n][whole])
        cells.append(h[whole].astype(np.int64))
    return (np.concatenate(rows), np.concatenate(cells)) if rows else (np.zeros(0, np.int64), np.zeros(0, np.int64))


def has_letters(arr, lo: int, hi: int, buf: np.ndarray, offs: np.ndarray) -> np.ndarray:
    ascii_letter = np.zeros(len(buf) + 1, np.int64)
    np.cumsum((_LETTER[buf] >= 97) & (_LETTER[buf] <= 122), out=ascii_letter[1:])
    out = ascii_letter[offs[1:]] > ascii_letter[offs[:-1]]
    for i in np.flatnonzero(~out & (offs[1:] > offs[:-1])):
        out[i] = any(c.isalpha() for c in arr[lo + int(i)].as_py())
    return out


def gram_counts(docs: DataFrame, text: str, lang: str) -> DataFrame:
    """``lang, bucket, n`` over all rows; a task sends one row for each
    language and bucket at most."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, np.ndarray] = {}
        for batch in batches:
            names = np.array(batch.column(1).to_pylist(), dtype=object)
            for lo, hi, buf, offs in text_slices(batch.column(0), SLICE):
                row, cell = grams(buf, offs)
                levels, code = np.unique(names[lo:hi].astype(str), return_inverse=True)
                got = np.bincount(code[row] * BUCKETS + cell, minlength=len(levels) * BUCKETS).reshape(-1, BUCKETS)
                for name, n in zip(levels, got, strict=True):
                    total[str(name)] = total.get(str(name), 0) + n
        for name, n in total.items():
            at = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays([pa.array([name] * len(at)), pa.array(at.astype(np.int32)), pa.array(n[at])],
                                             ["lang", "bucket", "n"])

    parts = (docs.where(F.col(lang).isNotNull() & F.col(text).isNotNull())
             .select(F.col(text).alias("text"), F.col(lang).alias("lang"))
             .mapInArrow(run, "lang string, bucket int, n long"))
    return parts.groupBy("lang", "bucket").agg(F.sum("n").alias("n"))


def codewords(n: int, seed: int = 5) -> np.ndarray:
    """(n, bits) of 0/1.  Up to six languages every way to part them in two;
    beyond, random balanced codes with the widest least distance of 64 tries."""
    if n <= 1:
        return np.ones((n, 1), np.int64)
    if n <= 6:
        parts = np.arange(1, 2 ** (n - 1))
        return ((parts[None, :] >> np.arange(n)[:, None]) & 1).astype(np.int64)
    rng = np.random.default_rng(seed)
    bits = int(np.ceil(10 * np.log2(n)))
    best, width = None, -1
    for _ in range(64):
        code = rng.integers(0, 2, (n, bits))
        code = code[:, (code.min(axis=0) == 0) & (code.max(axis=0) == 1)]
        distance = (code[:, None, :] != code[None, :, :]).sum(axis=2) + np.eye(n, dtype=int) * bits
        if distance.min() > width:
            best, width = code, int(distance.min())
    return best


def fit(counts: list[tuple[str, int, int]]) -> dict:
    """Bit classifiers from (lang, bucket, n)."""
    langs = sorted({c[0] for c in counts})
    table = np.zeros((len(langs), BUCKETS))
    place = {x: i for i, x in enumerate(langs)}
    for name, bucket, n in counts:
        table[place[name], bucket] = n
    code = codewords(len(langs))
    share = (table + 0.5) / (table + 0.5).sum(axis=1, keepdims=True) if len(langs) else table
    weights, bias, trust = [], [], []
    for bit in range(code.shape[1]):
        one, zero = code[:, bit] == 1, code[:, bit] == 0
        w = np.log(share[one].mean(axis=0)) - np.log(share[zero].mean(axis=0)) if zero.any() else np.zeros(BUCKETS)
        mean = share @ w  # a language's mean margin under this bit
        low, high = (mean[one].min(), mean[zero].max()) if zero.any() else (1.0, -1.0)
        middle, gap = (low + high) / 2.0, low - high
        weights.append(w)
        bias.append(middle)
        trust.append(max(gap, 1e-3))
    return {"langs": langs, "code": code, "w": np.array(weights), "bias": np.array(bias), "trust": np.array(trust)}


def decode(model: dict, row: np.ndarray, cell: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(index of the language, score, margin over the second) of ``n`` rows."""
    size = np.maximum(np.bincount(row, minlength=n), 1)
    sign = 2 * model["code"] - 1
    loss = np.zeros((n, len(model["langs"])))
    for w, bias, trust, s in zip(model["w"], model["bias"], model["trust"], sign.T, strict=True):
        z = (np.bincount(row, weights=w[cell], minlength=n) / size - bias) / trust * 4.0
        loss += min(trust, 1.0) * np.logaddexp(0.0, -z[:, None] * s[None, :])
    best = loss.argmin(axis=1)
    odds = np.exp(-(loss - loss.min(axis=1, keepdims=True)))
    odds /= odds.sum(axis=1, keepdims=True)
    ranked = np.sort(odds, axis=1)
    second = ranked[:, -2] if odds.shape[1] > 1 else np.zeros(n)
    return best, odds[np.arange(n), best], ranked[:, -1] - second


def judge(m: dict, column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
    """(lo, hi, language or ``und``, score, margin over the second) by row ranges."""
    for lo, hi, buf, offs in text_slices(column, SLICE):
        known = has_letters(column, lo, hi, buf, offs) & bool(m["langs"])
        name, score, margin = np.full(hi - lo, UNKNOWN, dtype=object), np.zeros(hi - lo), np.zeros(hi - lo)
        if m["langs"]:
            best, sure, gap = decode(m, *grams(buf, offs), hi - lo)
            name[known] = np.array(m["langs"], dtype=object)[best[known]]
            score[known], margin[known] = sure[known], gap[known]
        yield lo, hi, name, score, margin


def predict(docs: DataFrame, model: dict, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, lang_pred, score, ambiguous`` of every whole text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in batches:
            for lo, hi, name, score, margin in judge(m, batch.column(1)):
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, hi - lo), pa.array(name, pa.string()), pa.array(score),
                     pa.array(margin < AMBIGUOUS)], ["doc_id", "lang_pred", "score", "ambiguous"])

    return (docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
            .mapInArrow(run, "doc_id long, lang_pred string, score double, ambiguous boolean"))


def learn(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", modulus: int = 4,
          held: int = 2) -> dict:
    """The model of the rows outside the held-out fold with text and lang."""
    learning = F.coalesce(fold(key, modulus) != held, F.lit(True))
    counts = gram_counts(docs.where(learning), text, lang)
    return fit([tuple(r) for r in counts.toArrow().to_pandas().itertuples(index=False)])


def keep_identified(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """``docs`` without the rows that have no letters or an ambiguous
    language; no shuffle of texts."""
    shared = docs.sparkSession.sparkContext.broadcast(learn(docs, key, text, lang))
    at = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, name, _, margin in judge(shared.value, batch.column(at)):
                yield batch.slice(lo, hi - lo).filter(pa.array((name != UNKNOWN) & (margin >= AMBIGUOUS)))

    return docs.mapInArrow(run, docs.schema)


def identify(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", modulus: int = 4,
             held: int = 2) -> DataFrame:
    """``doc_id, held_out, lang_pred, score, ambiguous``; learns outside the
    held-out fold from text and non-null lang."""
    model = learn(docs, key, text, lang, modulus, held)
    return predict(docs, model, key, text).select(
        "doc_id", (fold("doc_id", modulus) == held).alias("held_out"), "lang_pred", "score", "ambiguous")
