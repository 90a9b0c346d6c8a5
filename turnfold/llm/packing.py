"""Packing of token ids into windows by Karmarkar-Karp multiway differencing.

Each document (its ids and an end id) is cut into full windows and a rest; the
rest is cut into parts of at most ``PART`` ids.  The parts are dealt by hash
into groups of about ``GROUP`` parts.  In a group of parts with sum T, k =
ceil(T / window) windows are tried first: every part starts as a partial
partition with one filled window; the two partial partitions with the largest
imbalance merge, the fullest windows of one onto the emptiest of the other,
until one is left.  If its fullest window exceeds the capacity, k rises.

Only piece descriptions are shuffled, never ids.  Defined results: a null text
is an empty document, one end id; repeated rows, ids that repeat and null ids
are packed each as a document of its own; an empty table gives no rows; other
columns are not read.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .frames import ship, written
from .idtokens import encode_batches, tokenizer_path

WINDOW = 2048
PART = 512
GROUP = 1536
END_ID = 1


def cut(n: int, window: int = WINDOW, part: int = PART) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document of ``n`` ids."""
    full = n // window * window
    return ([(a, window) for a in range(0, full, window)]
            + [(a, min(part, n - a)) for a in range(full, n, part)])


def difference(sizes: np.ndarray, k: int) -> np.ndarray:
    """Window of every item after multiway differencing into ``k`` windows."""
    if k == 1:
        return np.zeros(len(sizes), np.int64)
    n = len(sizes)
    sums = {}
    heap = []
    for i, size in enumerate(sizes.tolist()):
        row = np.zeros(k, np.int64)
        row[-1] = size
        sums[i] = row
        heap.append((-size, i))
    heapq.heapify(heap)
    merges = []
    node = n
    while len(heap) > 1:
        (_, a), (_, b) = heapq.heappop(heap), heapq.heappop(heap)
        total = sums.pop(a) + sums.pop(b)[::-1]
        order = np.argsort(total, kind="stable")
        total = total[order]
        total -= total[0]
        merges.append((a, b, order))
        sums[node] = total
        heapq.heappush(heap, (-int(total[-1]), node))
        node += 1
    place = {heap[0][1]: np.arange(k)}
    for at in range(len(merges) - 1, -1, -1):
        a, b, order = merges[at]
        window = np.empty(k, np.int64)
        window[order] = place.pop(n + at)
        place[a], place[b] = window, window[::-1]
    return np.fromiter((place[i][-1] for i in range(n)), np.int64, n)


def pack_sizes(sizes: np.ndarray, capacity: int = WINDOW) -> np.ndarray:
    """Window of every item; the window count rises until none overflows."""
    k, more = max(1, -(-int(sizes.sum()) // capacity)), 1
    while True:
        window = difference(sizes, k)
        if np.bincount(window, weights=sizes, minlength=k).max() <= capacity:
            return window
        k, more = k + more, more + 1


def cut_documents(docs: DataFrame, key: str = "doc_id", text: str = "text", path: str | None = None,
                  end_id: int = END_ID, window: int = WINDOW, part: int = PART) -> DataFrame:
    """``doc_id, start, length, ids_crc32, doc_tokens, salt`` of every piece."""
    path = path or tokenizer_path()
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = 0
        for batch in batches:
            keys = batch.column(0)
            for lo, hi, ids, lengths in encode_batches(batch.column(1), path, end_id):
                first, cols = 0, [[] for _ in range(6)]
                for i, n in enumerate(lengths.tolist()):
                    doc = keys[lo + i].as_py()
                    for start, size in cut(n, window, part):
                        a = first + start
                        for col, v in zip(cols, (doc, start, size, zlib.crc32(ids[a:a + size].tobytes()), n, row), strict=True):
                            col.append(v)
                    first += n
                    row += 1
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols],
                                                 ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "salt"])

    return (docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
            .mapInArrow(run, "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, salt long"))


def pack_documents(docs: DataFrame, key: str = "doc_id", text: str = "text", path: str | None = None,
                   end_id: int = END_ID, window: int = WINDOW, part: int = PART, group: int = GROUP) -> DataFrame:
    """The pieces with ``sequence_id`` and ``offset``."""
    pieces = written(cut_documents(docs, key, text, path, end_id, window, part)
                     .withColumn("uid", F.monotonically_increasing_id()), "pieces")
    columns = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
    parts = pieces.where(F.col("length") < window)
    n_groups = max(1, -(-parts.count() // group))
    dealt = parts.withColumn("grp", F.pmod(F.xxhash64("doc_id", "start", "salt"), F.lit(n_groups)))

    def place(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["doc_id", "start", "uid"], ignore_index=True)
        at = pack_sizes(frame["length"].to_numpy(), window)
        order = np.argsort(at, kind="stable")
        length, at = frame["length"].to_numpy()[order], at[order]
        end = np.cumsum(length)
        first = np.searchsorted(at, at, side="left")
        out = frame.iloc[order][columns].copy()
        out["sequence_id"] = 2 * ((frame["grp"].to_numpy()[order] << 24) + at)
        out["offset"] = end - length - (end - length)[first]
        return out

    packed = dealt.groupBy("grp").applyInPandas(
        place, "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long")
    whole = pieces.where(F.col("length") == window).select(
        *columns, (F.col("uid") * 2 + 1).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    return whole.unionByName(packed)
