"""Token-id files: documents as ids in key order, in range-coded blocks.

The table is range-partitioned and sorted by key; every partition (shard)
encodes its texts, cuts the ids into blocks of ``idcoder.BLOCK`` and writes
one row a block: shard, block number, place in the shard, the pieces of documents that the block
holds, and the coded ids.  Spark's own writer commits the rows, so a lost
executor repeats its shard only.

``read_documents`` decodes the blocks anywhere, in any order: a piece's CRC is
shifted over the ids behind it in its document, and the exclusive-or of a
document's pieces is the CRC of the whole document.

Defined results: a null text is an empty document (the end id alone); repeated
keys stay separate documents; ties in key keep some order; an empty table
gives a file without blocks and a read without rows; columns other than the
key and the text are not written.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import idcoder
from .frames import ship
from .idtokens import encode_batches, tokenizer_path

END_ID = 0
SHARD_ROWS = 8_192
BLOCK_SCHEMA = ("shard int, block long, first long, doc_no array<long>, doc_id array<long>, doc_start array<long>, "
                "length array<long>, doc_tokens array<long>, payload binary")
_POLY = 0xEDB88320


def _times(matrix: list[int], value: int) -> int:
    out, i = 0, 0
    while value:
        if value & 1:
            out ^= matrix[i]
        value >>= 1
        i += 1
    return out


def _zero_byte_powers(n: int = 48) -> list[list[int]]:
    """Matrices that put 2**k zero bytes behind a CRC-32."""
    step = [_POLY] + [1 << i for i in range(31)]
    for _ in range(3):  # one bit, two, four, eight
        step = [_times(step, x) for x in step]
    out = [step]
    for _ in range(n - 1):
        step = [_times(step, x) for x in step]
        out.append(step)
    return out


_SHIFT = _zero_byte_powers()


def crc_shift(crc: int, n_bytes: int) -> int:
    """What ``crc`` adds to the CRC-32 of a string that goes on for ``n_bytes``:
    crc(a + b) == crc_shift(crc(a), len(b)) ^ crc(b)."""
    k = 0
    while n_bytes:
        if n_bytes & 1:
            crc = _times(_SHIFT[k], crc)
        n_bytes >>= 1
        k += 1
    return crc


class _Cutter:
    """Cuts the ids of one shard into blocks with their pieces."""

    def __init__(self, size: int):
        self.size, self.held, self.pieces, self.have = size, [], [], 0
        self.ready: list[tuple[np.ndarray, list]] = []

    def add(self, doc_no: int, doc_id: int | None, ids: np.ndarray) -> None:
        at, n = 0, len(ids)
        while at < n:
            take = min(n - at, self.size - self.have)
            self.held.append(ids[at:at + take])
            self.pieces.append((doc_no, doc_id, at, take, n))
            self.have += take
            at += take
            if self.have == self.size:
                self.close()

    def close(self) -> None:
        if self.have:
            self.ready.append((np.concatenate(self.held), self.pieces))
            self.held, self.pieces, self.have = [], [], 0


def encode_documents(docs: DataFrame, key: str = "doc_id", text: str = "text", path: str | None = None,
                     end_id: int = END_ID, shard_rows: int = SHARD_ROWS, block: int = idcoder.BLOCK) -> DataFrame:
    """The block rows of ``BLOCK_SCHEMA``, shards ascending with the key."""
    path = path or tokenizer_path()
    ship(docs.sparkSession)
    fields = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
    shards = max(1, -(-fields.select("doc_id").count() // shard_rows))

    def rows(ready: list, first: int) -> pa.RecordBatch:
        shard = TaskContext.get().partitionId()
        columns = list(zip(*[[list(x) for x in zip(*pieces, strict=True)] for _, pieces in ready], strict=True))
        kind = pa.list_(pa.int64())
        return pa.RecordBatch.from_arrays(
            [pa.array([shard] * len(ready), pa.int32()), pa.array(range(first, first + len(ready)), pa.int64()),
             pa.array(range(first * block, (first + len(ready)) * block, block), pa.int64()),
             *(pa.array(c, kind) for c in columns),
             pa.array(idcoder.encode_blocks([ids for ids, _ in ready]), pa.binary())],
            ["shard", "block", "first", "doc_no", "doc_id", "doc_start", "length", "doc_tokens", "payload"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cutter, done, doc_no = _Cutter(block), 0, 0
        for batch in batches:
            keys = batch.column(0)
            for lo, _, ids, lengths in encode_batches(batch.column(1), path, end_id):
                ends = np.cumsum(lengths)
                for i, (a, b) in enumerate(zip((ends - lengths).tolist(), ends.tolist(), strict=True)):
                    cutter.add(doc_no, keys[lo + i].as_py(), ids[a:b])
                    doc_no += 1
                while len(cutter.ready) >= idcoder.LANES:
                    now, cutter.ready = cutter.ready[:idcoder.LANES], cutter.ready[idcoder.LANES:]
                    yield rows(now, done)
                    done += len(now)
        cutter.close()
        while cutter.ready:
            now, cutter.ready = cutter.ready[:idcoder.LANES], cutter.ready[idcoder.LANES:]
            yield rows(now, done)
            done += len(now)

    return (fields.repartitionByRange(shards, "doc_id").sortWithinPartitions("doc_id").mapInArrow(run, BLOCK_SCHEMA))


def write_documents(docs: DataFrame, folder: str, **options) -> None:
    encode_documents(docs, **options).write.parquet(folder)


def _batches_of(batches: Iterator[pa.RecordBatch], lanes: int) -> Iterator[pa.Table]:
    """Tables of about ``lanes`` blocks, so that decoding fills its lanes."""
    held, have = [], 0
    for batch in batches:
        held.append(batch)
        have += batch.num_rows
        if have >= lanes:
            yield pa.Table.from_batches(held)
            held, have = [], 0
    if have:
        yield pa.Table.from_batches(held)


def read_ids(spark: SparkSession, folder: str) -> DataFrame:
    """``shard, block, doc_no, doc_id, doc_start, doc_tokens, ids`` of every
    piece of the file."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _batches_of(batches, idcoder.LANES):
            for lo in range(0, table.num_rows, idcoder.LANES):
                part = table.slice(lo, idcoder.LANES).to_pylist()
                for r, ids in zip(part, idcoder.decode_blocks([r["payload"] for r in part]), strict=True):
                    n = len(r["length"])
                    offs = np.concatenate([[0], np.cumsum(r["length"])]).astype(np.int32)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([r["shard"]] * n, pa.int32()), pa.array([r["block"]] * n, pa.int64()),
                         *(pa.array(r[c], pa.int64()) for c in ("doc_no", "doc_id", "doc_start", "doc_tokens")),
                         pa.ListArray.from_arrays(pa.array(offs), pa.array(ids.astype(np.int32)))],
                        ["shard", "block", "doc_no", "doc_id", "doc_start", "doc_tokens", "ids"])

    return spark.read.parquet(folder).mapInArrow(
        run, "shard int, block long, doc_no long, doc_id long, doc_start long, doc_tokens long, ids array<int>")


def read_documents(spark: SparkSession, folder: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of every document of the file."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _batches_of(batches, idcoder.LANES):
            for lo in range(0, table.num_rows, idcoder.LANES):
                part = table.slice(lo, idcoder.LANES).to_pylist()
                cols = [[] for _ in range(6)]
                for r, ids in zip(part, idcoder.decode_blocks([r["payload"] for r in part]), strict=True):
                    raw, at = ids.astype("<u4").tobytes(), 0
                    for no, doc, start, n, total in zip(r["doc_no"], r["doc_id"], r["doc_start"], r["length"],
                                                        r["doc_tokens"], strict=True):
                        crc = crc_shift(zlib.crc32(raw[4 * at:4 * (at + n)]), 4 * (total - start - n))
                        # the place of a document in its shard is that of its first id
                        for col, v in zip(cols, (r["shard"], no, doc, r["first"] + at - start, total, crc),
                                          strict=True):
                            col.append(v)
                        at += n
                yield pa.RecordBatch.from_arrays(
                    [pa.array(cols[0], pa.int32()), *(pa.array(c, pa.int64()) for c in cols[1:])],
                    ["shard", "doc_no", "doc_id", "place", "n_tokens", "crc"])

    pieces = spark.read.parquet(folder).mapInArrow(
        run, "shard int, doc_no long, doc_id long, place long, n_tokens long, crc long")
    whole = pieces.groupBy("shard", "doc_no").agg(
        F.first("doc_id").alias("doc_id"), F.first("place").alias("place"), F.first("n_tokens").alias("n_tokens"),
        F.bit_xor("crc").alias("ids_crc32"))
    # one row a shard: the window has no more rows than the file has shards
    sizes = (spark.read.parquet(folder).groupBy("shard")
             .agg(F.sum(F.aggregate("length", F.lit(0).cast("long"), lambda a, x: a + x)).alias("ids")))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("shard", F.coalesce(F.sum("ids").over(before), F.lit(0).cast("long")).alias("shard_start"))
    return whole.join(starts, "shard").select(
        "doc_id", (F.col("shard_start") + F.col("place")).alias("start"), "n_tokens", "ids_crc32")
