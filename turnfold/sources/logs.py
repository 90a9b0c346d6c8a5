"""Match-log JSONL readers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schema as S
from ..session import scratch_path

CORRUPT = "_corrupt_record"
OFFSETS = 1_000_000  # splits whose offsets are broadcast, some 100 bytes each


def read_match_logs(spark: SparkSession, path: str, schema: T.StructType = S.MATCH_LOG) -> DataFrame:
    """A1/A2: JSON lines with an explicit schema.  Blank lines are skipped; a
    malformed line fails the job (Spark names the file; :func:`read_strict`
    names the line too, :func:`read_with_rejects` keeps bad records apart)."""
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def file_order(df: DataFrame) -> DataFrame:
    """Adds ``_file``, ``_block`` and ``_seq``: together they order records
    as they appear in their files (``_seq`` increases inside a split)."""
    return (df.withColumn("_file", F.col("_metadata.file_path"))
              .withColumn("_block", F.col("_metadata.file_block_start"))
              .withColumn("_seq", F.monotonically_increasing_id()))


def scan_positions(df: DataFrame, name: str, per_file: bool = False) -> DataFrame:
    """``df``, a file scan with filters at most, with the 0-based place of each
    row in the order of the files (by path), or in its own file.

    Rows are numbered where they are read: a first pass counts the rows of
    each split (a part of a file that one task reads in order), and the counts
    of the splits before are added to a row's place in its split.  Only counts
    are shuffled, one row a split.  The table of offsets has one row a split;
    the driver holds a list of all splits anyway to hand them out.  It is
    broadcast up to ``OFFSETS`` rows and joined otherwise."""
    rows = file_order(df)
    first = df.columns[0]  # a column is read, so that both passes see the same rows
    splits = rows.groupBy("_file", "_block").agg(F.count(F.lit(1)).alias("_n"), F.min("_seq").alias("_first"),
                                                 F.count(first).alias("_read"))
    splits = written_small(splits.drop("_read"), "splits")
    before = (Window.partitionBy("_file") if per_file else Window.partitionBy()).orderBy(
        *([] if per_file else ["_file"]), "_block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = splits.select(F.col("_file").alias("_f"), F.col("_block").alias("_b"), "_first",
                            F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    if splits.count() <= OFFSETS:
        offsets = F.broadcast(offsets)
    return (rows.join(offsets, (F.col("_file") == F.col("_f")) & (F.col("_block") == F.col("_b")))
            .withColumn(name, F.col("_offset") + F.col("_seq") - F.col("_first"))
            .drop("_block", "_seq", "_f", "_b", "_first", "_offset"))


def written_small(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    df.coalesce(1).write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """``_file, line, value``: all lines of the files with their 1-based
    number, blank lines counted."""
    lines = scan_positions(spark.read.text(path), "line", per_file=True)
    return lines.select("_file", (F.col("line") + 1).alias("line"), "value")


def read_with_rejects(spark: SparkSession, path: str, schema: T.StructType = S.MATCH_LOG
                      ) -> tuple[DataFrame, DataFrame]:
    """A3: ``(valid records, rejects)``; rejects carry the file, the 1-based
    line and the raw text.  Blank lines are skipped but counted."""
    full = T.StructType(schema.fields + [T.StructField(CORRUPT, T.StringType())])
    record = F.from_json("value", full, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})
    parsed = (numbered_lines(spark, path).where(F.trim(F.regexp_replace("value", "[\\t\\r]", " ")) != "")
              .select("_file", "line", "value", record.alias("_rec")))
    broken = F.col("_rec").isNull() | F.col(f"_rec.{CORRUPT}").isNotNull()
    bad = parsed.where(broken).select("_file", "line", F.col("value").alias("record"))
    good = parsed.where(~broken).select(*[F.col(f"_rec.{f.name}").alias(f.name) for f in schema.fields])
    return good, bad


class BadRecord(ValueError):
    """A malformed record, by file and line."""


def read_strict(spark: SparkSession, path: str, schema: T.StructType = S.MATCH_LOG) -> DataFrame:
    """A1: the records, or :class:`BadRecord` naming file and line of the
    first malformed one (files by path)."""
    good, bad = read_with_rejects(spark, path, schema)
    first = bad.agg(F.min(F.struct("_file", "line", "record")).alias("r")).first()["r"]
    if first is not None:
        raise BadRecord(f"{first['_file']}, line {first['line']}: not a JSON record: {first['record'][:200]}")
    return good


def with_position_id(df: DataFrame, id_col: str = "battle_id") -> DataFrame:
    """A5: the records' own keys if every record has one; otherwise, for all
    records alike, the 0-based index in file order (files by path), without
    moving a record (:func:`scan_positions`).  Keys that repeat are an error:
    ids join scores to labels."""
    if id_col in df.columns:
        seen = df.agg(F.count(F.lit(1)).alias("n"), F.count(id_col).alias("keyed")).first()
        if seen["n"] == seen["keyed"]:
            twice = df.groupBy(id_col).count().where(F.col("count") > 1).limit(1).collect()
            if twice:
                raise ValueError(f"{id_col} {twice[0][id_col]} stands for more than one record")
            return df
    return scan_positions(df, "_pos").withColumn(id_col, F.col("_pos")).drop("_file", "_pos")


def require_fields(df: DataFrame, fields: Sequence[str] = S.REQUIRED_FIELDS,
                   id_col: str = "battle_id") -> tuple[DataFrame, DataFrame]:
    """An explicit schema turns an absent key into a silent null; this
    splits records into ``(valid, rejects)`` with the missing field named."""
    reason = None
    for f in fields:
        cond = F.col(f).isNull()
        reason = (F.when(cond, F.lit(f"missing field {f}")) if reason is None
                  else reason.when(cond, F.lit(f"missing field {f}")))
    tagged = df.withColumn("_reason", reason)
    return (tagged.where(F.col("_reason").isNull()).drop("_reason"),
            tagged.where(F.col("_reason").isNotNull()).select(id_col, F.col("_reason").alias("reason")))
