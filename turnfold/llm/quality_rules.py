"""Quality rules judged by an isolation forest.

Every document gets rule statistics (shares of symbols, capitals, repeated
words and lines, word lengths ...).  A forest of random splits isolates odd
documents: the fewer splits a document needs, the higher its anomaly score
``2 ** (-mean path / c(psi))``.  The forest is fitted on a bounded sample of
labelled rows; the score above which a document goes is calibrated from all
labelled rows, as a histogram made on the executors.

Defined results: a null text counts as empty; empty and short texts fail the
base rule; repeated rows get the same verdict; an empty table gives no rows;
without labelled rows the forest keeps all that pass the base rule.  Columns
of the input other than the key and the text are never read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .frames import hashed_sample, written
from .textops import text_slices
from .textstats import BASE, COUNTS, RATIO_NAMES, count_texts, ratios

SAMPLE_ROWS = 16_384
TREES = 256
PSI = 2048
DEPTH = 11
BINS = 2_000
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
CLEAN_LOSS = 0.002  # share of labelled good documents that the threshold may cost
RULES = RATIO_NAMES


def _mean_path(n: np.ndarray | float) -> np.ndarray:
    """Mean depth of an unsuccessful search among n points."""
    n = np.asarray(n, dtype=np.float64)
    m = np.maximum(n, 2.0)
    return np.where(n <= 1, 0.0, 2.0 * (np.log(np.maximum(m - 1.0, 1.0)) + 0.5772156649) - 2.0 * (m - 1.0) / m)


def fit_forest(x: np.ndarray, good: np.ndarray, trees: int = TREES, psi: int = PSI, depth: int = DEPTH,
               seed: int = 7) -> dict:
    """Random-split trees over the ``good`` rows of ``x``.

    Features are scaled by the good rows' median and spread.  A split's place
    is uniform over the box of its node, the root's box spanning good and bad
    rows: what lies where no good row does ends on a short path.  Trees are
    heaps: node i has children 2i+1 and 2i+2; ``path`` holds the path length
    credited at a leaf."""
    rng = np.random.default_rng(seed)
    kept = x[good] if good.any() else x
    middle = np.median(kept, axis=0)
    spread = np.quantile(np.abs(kept - middle), 0.99, axis=0) + 1e-3
    z, zall = scaled(kept, middle, spread), scaled(x, middle, spread)
    nodes = 2 ** (depth + 1) - 1
    feature = np.full((trees, nodes), -1, np.int16)
    cut, path = np.zeros((trees, nodes)), np.zeros((trees, nodes))
    size = min(psi, len(z))
    for t in range(trees):
        todo = [(0, z[rng.choice(len(z), size, replace=False)], zall.min(axis=0), zall.max(axis=0), 0)]
        while todo:
            node, rows, low, high, level = todo.pop()
            if level == depth or len(rows) <= 1:
                path[t, node] = level + _mean_path(len(rows))
                continue
            j = int(rng.integers(z.shape[1]))
            v = rng.uniform(low[j], high[j])
            feature[t, node], cut[t, node] = j, v
            left, below, above = rows[:, j] <= v, high.copy(), low.copy()
            below[j] = above[j] = v
            todo += [(2 * node + 1, rows[left], low, below, level + 1), (2 * node + 2, rows[~left], above, high, level + 1)]
    return {"feature": feature, "cut": cut, "path": path, "norm": float(max(_mean_path(size), 1.0)), "depth": depth,
            "middle": middle, "spread": spread}


def scaled(x: np.ndarray, middle: np.ndarray, spread: np.ndarray) -> np.ndarray:
    return np.arcsinh(np.clip((x - middle) / spread, -8.0, 8.0))


def anomaly(forest: dict, x: np.ndarray) -> np.ndarray:
    """Anomaly score in (0, 1) of every row of ``x``."""
    x = scaled(x, forest["middle"], forest["spread"])
    total = np.zeros(len(x))
    rows = np.arange(len(x))
    for feature, cut, path in zip(forest["feature"], forest["cut"], forest["path"], strict=True):
        node = np.zeros(len(x), np.int64)
        for _ in range(forest["depth"]):
            j = feature[node]
            inner = j >= 0
            right = x[rows, np.maximum(j, 0)] > cut[node]
            node = np.where(inner, 2 * node + 1 + right, node)
        total += path[node]
    return 2.0 ** (-(total / len(forest["path"])) / forest["norm"])


def rules(counts: dict[str, np.ndarray]) -> np.ndarray:
    return ratios(counts)


def rule_statistics(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key`` and the integer ``COUNTS`` of every whole text; one pass, no shuffle."""
    fields = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, buf, offs in text_slices(batch.column(1)):
                c = count_texts(buf, offs)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, hi - lo), *(pa.array(c[k]) for k in COUNTS)], ["doc_id", *COUNTS])

    return fields.mapInArrow(run, "doc_id long, " + ", ".join(f"{k} long" for k in COUNTS))


def base_failed():
    return ((F.col("n_words") < MIN_WORDS)
            | (F.lit(100) * F.col("n_repeat_words") > F.lit(MAX_REPEAT_PERCENT) * F.col("n_words")))


def _scored(stats: DataFrame, forest: dict, keep: list[str]) -> DataFrame:
    """``keep`` columns and ``anomaly``; the forest's size is bounded by
    ``TREES`` and ``DEPTH``."""
    schema = stats.select(*keep).schema.add("anomaly", "double")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = rules({k: batch.column(k).to_numpy() for k in COUNTS})
            score = anomaly(forest, x) if len(x) else np.zeros(0)
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in keep), pa.array(score)], [*keep, "anomaly"])

    return stats.mapInArrow(run, schema)


def calibrate(histogram: list[tuple[int, int, int]], bins: int = BINS, clean_loss: float = CLEAN_LOSS) -> float:
    """The score bound, from (bin, quality, rows): among the bounds that cost
    at most ``clean_loss`` of the good rows, the highest one that parts bad
    from good rows best.  Infinite without good or without bad rows."""
    good, bad = np.zeros(bins + 1), np.zeros(bins + 1)
    for b, quality, n in histogram:
        (good if quality == 1 else bad)[b] += n
    if not good.sum() or not bad.sum():
        return float("inf")
    lost = np.cumsum(good[::-1])[::-1] / good.sum()  # share at this bin or higher
    caught = np.cumsum(bad[::-1])[::-1] / bad.sum()
    gain = np.where(lost <= clean_loss, caught - lost, -1.0)
    best = int(np.flatnonzero(gain >= gain.max() - 1e-12)[-1])
    return best / bins if gain[best] > 0 else float("inf")


def judge_documents(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text",
                    sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """``doc_id``, the base counts, ``base_failed``, ``kept`` and ``anomaly``.

    The statistics are written once (some bytes a document) and read for the
    sample, the calibration and the verdicts."""
    stats = written(rule_statistics(docs, key, text), "rule-statistics")
    marks = (labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull())
             .groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("quality").cast("int").alias("quality")))
    labelled = stats.where(~base_failed()).join(marks, "doc_id")
    sample = hashed_sample(labelled, "doc_id", sample_rows, "forest").select("quality", *COUNTS).toPandas()
    if not len(sample):
        return stats.select("doc_id", *BASE, base_failed().alias("base_failed"), (~base_failed()).alias("kept"),
                            F.lit(None).cast("double").alias("anomaly"))
    forest = fit_forest(rules({k: sample[k].to_numpy() for k in COUNTS}), sample["quality"].to_numpy() == 1)
    histogram = (_scored(labelled, forest, ["quality"])
                 .groupBy((F.col("anomaly") * BINS).cast("int").alias("bin"), "quality").count().collect())
    bound = calibrate([tuple(r) for r in histogram])
    out = _scored(stats, forest, ["doc_id", *BASE])
    return out.select("doc_id", *BASE, base_failed().alias("base_failed"),
                      (~base_failed() & (F.col("anomaly") < bound)).alias("kept"), "anomaly")
