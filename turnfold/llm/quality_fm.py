"""Quality classifier: a factorisation machine.

A text becomes a sparse vector: hashed words (square root of the word's share
of the text), structure statistics and its length as metadata.  The score is

    sigmoid(w0 + sum_i w_i x_i + 1/2 sum_f [(sum_i v_if x_i)^2 - sum_i v_if^2 x_i^2])

the sum-of-squares identity giving all pairwise interactions in time linear in
the number of features present.  It is fitted on a bounded sample of labelled
rows (``SAMPLE_ROWS``) and scored over whole texts on the executors.

Defined results: a null text counts as empty and gets the score of a text
without words; repeated rows get equal scores; an empty table gives no rows;
without labelled rows of both classes every score is the share of label 1, or
0.5 without any; a row without an id is scored, is in no fold (``held_out``
null) and never learnt from.  Labels, lang, source and key never enter a score.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .frames import fold, hashed_sample
from .textops import group_counts, span_hashes, text_slices, word_spans
from .textstats import RATIO_NAMES, count_texts, ratios

SAMPLE_ROWS = 6_000
HASHED = 1 << 15
FACTORS = 4
EPOCHS = 12
DENSE = len(RATIO_NAMES) + 1
WIDTH = HASHED + DENSE


def features(buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sparse (row, column, value), sorted by row, of every text of a slice."""
    n = len(offs) - 1
    s, e, row = word_spans(buf, offs)
    cols = (span_hashes(buf, s, e, lower=True) >> np.uint64(20)).astype(np.int64) & (HASHED - 1)
    r, c, count = group_counts(row, cols)
    words = np.bincount(row, minlength=n)
    value = np.sqrt(count / np.maximum(words[r], 1))
    counts = count_texts(buf, offs)
    dense = np.column_stack([np.sqrt(ratios(counts)), np.log1p(counts["n_chars_all"]) / 10.0])
    rows = np.concatenate([r, np.repeat(np.arange(n), DENSE)])
    columns = np.concatenate([c, np.tile(np.arange(HASHED, WIDTH), n)])
    values = np.concatenate([value, dense.ravel()])
    order = np.argsort(rows, kind="stable")
    return rows[order], columns[order], values[order]


def margins(model: dict, row: np.ndarray, col: np.ndarray, val: np.ndarray, n: int) -> np.ndarray:
    """Raw FM output of ``n`` rows, linear in the number of entries."""
    out = np.full(n, model["w0"])
    out += np.bincount(row, weights=model["w"][col] * val, minlength=n)
    for f in range(model["v"].shape[1]):
        part = model["v"][col, f] * val
        out += 0.5 * (np.bincount(row, weights=part, minlength=n) ** 2 - np.bincount(row, weights=part * part, minlength=n))
    return out


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -35.0, 35.0)))


def fit(rows: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, factors: int = FACTORS, epochs: int = EPOCHS,
        rate: float = 0.08, decay: float = 1e-4, batch: int = 128, seed: int = 11) -> dict:
    """AdaGrad on the logistic loss over rows (columns, values)."""
    rng = np.random.default_rng(seed)
    prior = float(np.mean(y)) if len(y) else 0.5
    model = {"w0": 0.0, "w": np.zeros(WIDTH), "v": rng.normal(0.0, 0.02, (WIDTH, factors))}
    if prior in (0.0, 1.0) or not len(y):
        return {"w0": 0.0, "w": np.zeros(WIDTH), "v": np.zeros((WIDTH, factors)), "constant": prior}
    g0, gw, gv = 1e-6, np.full(WIDTH, 1e-6), np.full((WIDTH, factors), 1e-6)
    for _ in range(epochs):
        order = rng.permutation(len(rows))
        for lo in range(0, len(order), batch):
            picked = order[lo:lo + batch]
            row = np.repeat(np.arange(len(picked)), [len(rows[i][0]) for i in picked])
            col = np.concatenate([rows[i][0] for i in picked])
            val = np.concatenate([rows[i][1] for i in picked])
            n = len(picked)
            err = (sigmoid(margins(model, row, col, val, n)) - y[picked]) / n
            used, at = np.unique(col, return_inverse=True)
            e = err[row] * val
            grad = np.bincount(at, weights=e, minlength=len(used)) + decay * model["w"][used]
            gw[used] += grad**2
            grad_w = grad / np.sqrt(gw[used])
            for f in range(factors):
                v = model["v"][col, f]
                total = np.bincount(row, weights=v * val, minlength=n)
                grad = np.bincount(at, weights=e * (total[row] - v * val), minlength=len(used)) + decay * model["v"][used, f]
                gv[used, f] += grad**2
                model["v"][used, f] -= 0.25 * rate * grad / np.sqrt(gv[used, f])
            model["w"][used] -= rate * grad_w
            g0 += err.sum() ** 2
            model["w0"] -= rate * err.sum() / np.sqrt(g0)
    return model


def training_rows(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", modulus: int = 3,
                  held: int = 1, sample_rows: int = SAMPLE_ROWS) -> tuple[list, np.ndarray]:
    """Features and labels of at most ``sample_rows`` labelled rows outside
    the held-out fold, those with the least hash of the key."""
    marks = (labels.where(F.col("quality").isNotNull() & (fold("doc_id", modulus) != held))
             .groupBy(F.col("doc_id").cast("long").alias("_id")).agg(F.max("quality").cast("int").alias("_y")))
    marks = hashed_sample(marks, "_id", sample_rows, "fm")
    chosen = (docs.select(F.col(key).cast("long").alias("_id"), F.col(text).alias("_text"))
              .join(F.broadcast(marks), "_id").select("_id", "_y", "_text"))  # at most sample_rows short rows

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, buf, offs in text_slices(batch.column(2)):
                row, col, val = features(buf, offs)
                cuts = np.searchsorted(row, np.arange(hi - lo + 1))
                lists = lambda x, kind: pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(x, kind))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, hi - lo), batch.column(1).slice(lo, hi - lo),
                     lists(col, pa.int32()), lists(val, pa.float32())], ["id", "y", "col", "val"])

    got = chosen.mapInArrow(run, "id long, y int, col array<int>, val array<float>").toArrow().sort_by("id").combine_chunks()
    if not got.num_rows:
        return [], np.zeros(0)
    rows = []
    for name, kind in (("col", np.int64), ("val", np.float64)):
        column = got[name].combine_chunks()
        offs, flat = column.offsets.to_numpy(), column.values.to_numpy()
        rows.append([flat[a:b].astype(kind) for a, b in zip(offs[:-1], offs[1:], strict=True)])
    return list(zip(*rows, strict=True)), got["y"].to_numpy().astype(np.float64)


def score_documents(docs: DataFrame, model: dict, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, score`` of every whole text; one pass, no shuffle.  The model
    has ``WIDTH * (FACTORS + 1)`` numbers at most."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in batches:
            for lo, hi, buf, offs in text_slices(batch.column(1)):
                if "constant" in m:
                    score = np.full(hi - lo, m["constant"])
                else:
                    score = sigmoid(margins(m, *features(buf, offs), hi - lo))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), pa.array(score)], ["doc_id", "score"])

    return (docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
            .mapInArrow(run, "doc_id long, score double"))


def classify(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", modulus: int = 3,
             held: int = 1) -> DataFrame:
    """``doc_id, held_out, score, predicted``."""
    model = fit(*training_rows(docs, labels, key, text, modulus, held))
    return score_documents(docs, model, key, text).select(
        "doc_id", (fold("doc_id", modulus) == held).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"))
