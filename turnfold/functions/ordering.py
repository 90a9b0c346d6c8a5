"""Order-dependent helpers that stay distributed.

A window with no partition key, or a lag over a key that may hold a third
of all rows, sends that data to one task.  The helpers here range-partition
on the full ordering key instead (a hot key is then cut across several
partitions) and work through each sorted partition in the stage that sorts
it.  The result is written once to the shared folder; a second, small pass
fetches one row per partition, and what crosses a partition's border is
joined from that table.  Records are shuffled once.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import scratch_path, ship

_PID = "_tf_pid"
_POS = "_tf_pos"


def _cols(cols: Sequence[str | Column]) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in cols]


def _num_partitions(df: DataFrame, num_partitions: int | None) -> int:
    if num_partitions:
        return num_partitions
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))


def range_sorted(df: DataFrame, order: Sequence[str | Column],
                 num_partitions: int | None = None) -> DataFrame:
    """Range-partition on the whole ordering key and sort inside partitions;
    afterwards partition ``i`` holds only keys below those of ``i + 1``.
    ``_tf_pid`` records the partition and ``_tf_pos`` the position inside
    it; both are computed in the same stage as the sort."""
    n = _num_partitions(df, num_partitions)
    return (df.repartitionByRange(n, *_cols(order))
              .sortWithinPartitions(*_cols(order))
              .withColumn(_PID, F.spark_partition_id())
              .withColumn(_POS, F.monotonically_increasing_id()
                          - F.shiftleft(F.col(_PID).cast("long"), 33)))


def _written(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _by_partition(s: DataFrame, columns: Sequence[str]) -> list:
    """The last row (``columns``) and the number of rows of each partition."""
    last = F.max_by(F.struct(*columns), F.col(_POS)) if columns else F.lit(None)
    return sorted(s.groupBy(_PID).agg(last.alias("last"), F.count(F.lit(1)).alias("n")).collect(), key=lambda r: r[_PID])


def with_row_index(df: DataFrame, order: Sequence[str | Column], name: str = "row_index",
                   num_partitions: int | None = None) -> DataFrame:
    """0-based position of every row in the total order ``order`` (which must
    be a unique key for the index to be deterministic)."""
    s = _written(range_sorted(df, order, num_partitions), "ranges")
    rows, offset = [], 0
    for r in _by_partition(s, []):
        rows.append((r[_PID], offset))
        offset += r["n"]
    offsets = df.sparkSession.createDataFrame(rows, f"{_PID} int, _tf_off long")  # one row a partition
    return s.join(F.broadcast(offsets), _PID).withColumn(name, F.col("_tf_off") + F.col(_POS)).drop(_PID, _POS, "_tf_off")


def ordered_pass(df: DataFrame, order: Sequence[str | Column], sums: Sequence[str] = (), lags: Sequence[str] = (),
                 group: Sequence[str] = (), suffix: str = "_cum", prefix: str = "prev_",
                 num_partitions: int | None = None) -> DataFrame:
    """Inclusive running sums (``<c>_cum``, nulls count as 0) over the whole
    order, and the values of the row before (``prev_<c>``, null where it is of
    another ``group``)."""
    ship(df.sparkSession)
    s = range_sorted(df, order, num_partitions)
    kinds = {c: ("double" if s.schema[c].dataType.typeName() in ("double", "float", "decimal") else "long") for c in sums}
    out = T.StructType(list(s.schema.fields))
    for c in sums:
        out = out.add("_tf_sum_" + c, kinds[c])
    for c in lags:
        out = out.add("_tf_lag_" + c, s.schema[c].dataType)
    names, group, lags, sums = out.names, list(group), list(lags), list(sums)
    carried = list(dict.fromkeys([*group, *lags]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, last = dict.fromkeys(sums, 0), None
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            more = []
            for c in sums:
                kind = pa.float64() if kinds[c] == "double" else pa.int64()
                cum = np.cumsum(np.asarray(batch.column(c).cast(kind).fill_null(0))) + total[c]
                total[c] = cum[-1]
                more.append(pa.array(cum, kind))
            own = {c: batch.column(c) for c in carried}
            before = {c: pa.concat_arrays([last[c] if last else pa.nulls(1, x.type), x.slice(0, n - 1)]) for c, x in own.items()}
            same = np.ones(n, bool)
            same[0] = last is not None
            for g in group:
                there = np.asarray(own[g].is_valid()), np.asarray(before[g].is_valid())
                equal = np.asarray(pc.equal(own[g], before[g]).fill_null(False))
                same &= np.where(there[0] & there[1], equal, there[0] == there[1])
            more += [pc.if_else(pa.array(same), before[c], pa.nulls(n, before[c].type)) for c in lags]
            last = {c: x.slice(n - 1, 1) for c, x in own.items()}
            yield pa.RecordBatch.from_arrays([*batch.columns, *more], names)

    s = _written(s.mapInArrow(run, out), "ranges")
    ends = _by_partition(s, [*["_tf_sum_" + c for c in sums], *carried])
    rows, offset, before = [], [0.0 if kinds[c] == "double" else 0 for c in sums], [None] * len(carried)
    for r in ends:
        rows.append((r[_PID], bool(rows), *offset, *before))
        offset = [o + (r["last"]["_tf_sum_" + c] or 0) for o, c in zip(offset, sums, strict=True)]
        before = [r["last"][c] for c in carried]
    kind = T.StructType([T.StructField(_PID, T.IntegerType()), T.StructField("_tf_any", T.BooleanType())])
    for c in sums:
        kind = kind.add("_tf_off_" + c, kinds[c])
    for c in carried:
        kind = kind.add("_tf_end_" + c, s.schema[c].dataType)
    joined = s.join(F.broadcast(df.sparkSession.createDataFrame(rows, kind)), _PID)  # one row a partition
    same = F.col("_tf_any")
    for g in group:
        same = same & F.col("_tf_end_" + g).eqNullSafe(F.col(g))
    cols = [F.col(c) for c in df.columns]
    cols += [(F.col("_tf_sum_" + c) + F.col("_tf_off_" + c)).alias(c + suffix) for c in sums]
    cols += [F.when(F.col(_POS) > 0, F.col("_tf_lag_" + c)).when(same, F.col("_tf_end_" + c)).alias(prefix + c) for c in lags]
    return joined.select(*cols)


def running_sums(df: DataFrame, order: Sequence[str | Column], value_cols: Sequence[str],
                 suffix: str = "_cum", num_partitions: int | None = None) -> DataFrame:
    """Inclusive running sums of ``value_cols`` in the total order ``order``."""
    return ordered_pass(df, order, sums=value_cols, suffix=suffix, num_partitions=num_partitions)


def with_lag(df: DataFrame, group: Sequence[str], order: Sequence[str],
             value_cols: Sequence[str], prefix: str = "prev_",
             num_partitions: int | None = None) -> DataFrame:
    """``lag(v, 1)`` over ``partition by group order by order`` for each value
    column, without putting a hot group into one task."""
    return ordered_pass(df, list(group) + list(order), lags=value_cols, group=group, prefix=prefix, num_partitions=num_partitions)


def group_row_number(df: DataFrame, group: Sequence[str], order: Sequence[str],
                     name: str = "rn", num_partitions: int | None = None) -> DataFrame:
    """``row_number() over (partition by group order by order)`` (1-based)
    without sorting a hot group in one task: a global index over
    ``group + order`` (range partitions cut a hot group into pieces) minus
    the group's first index, taken from a grouped ``min`` (partial
    aggregation) and joined back on the group key (a shuffle join that AQE
    can split when one key is hot)."""
    idx = with_row_index(df, list(group) + list(order), "_tf_gi", num_partitions)
    first = idx.groupBy(*group).agg(F.min("_tf_gi").alias("_tf_g0"))
    for g in group:  # a null group is a group
        first = first.withColumnRenamed(g, "_tf_key_" + g)
    same = F.lit(True)
    for g in group:
        same = same & idx[g].eqNullSafe(first["_tf_key_" + g])
    return (idx.join(first, same).drop(*["_tf_key_" + g for g in group])
               .withColumn(name, F.col("_tf_gi") - F.col("_tf_g0") + F.lit(1))
               .drop("_tf_gi", "_tf_g0"))
