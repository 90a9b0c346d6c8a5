"""The flat timeline fold as a stateful streaming aggregation.

Every per-match value of the flat fold that is a plain aggregate (turns,
observed alive counters, last value overall and per roster member) is kept
in Spark's state store, keyed by match, and updated as turn rows arrive.
Distinct counts are not supported by streaming aggregation, so revealed
members and distinct moves stay batch-only.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schema as S
from ..session import scratch_path


def state_aggregates(match: str, order: Sequence[str], member: str, value: str,
                     roster: Sequence[str], fainted: Column) -> list[Column]:
    o = F.struct(*[F.col(c) for c in order])
    aggs = [F.count(F.lit(1)).cast("long").alias("turns"),
            (F.lit(S.START_ALIVE) - F.count_if(fainted)).cast("long").alias("alive"),
            (F.lit(S.START_DISCOVERED_ALIVE) + F.count(F.lit(1)) - F.count_if(fainted))
            .cast("long").alias("discovered_alive"),
            F.max_by(F.col(value), o).alias("leader_value")]
    for name in dict.fromkeys(roster):
        aggs.append(F.coalesce(F.max_by(F.col(value), F.when(F.col(member) == name, o)),
                               F.lit(1.0)).alias(f"hp_{name}"))
    return aggs


def run_state_fold(spark: SparkSession, source_dir: str, file_glob: str, match: str,
                   order: Sequence[str], member: str, value: str, roster: Sequence[str],
                   fainted: Column, max_files_per_trigger: int = 1) -> DataFrame:
    """Stream the turn rows of the parquet table ``file_glob`` in
    ``source_dir`` through the stateful fold until all available input is
    processed; each micro-batch writes the complete state table to a
    parquet folder under the shared checkpoint folder, which is returned."""
    source, pattern = f"{source_dir.rstrip('/')}/{file_glob}", "*.parquet"
    schema = spark.read.parquet(source).schema
    listed = spark.read.format("binaryFile").option("pathGlobFilter", file_glob).load(source_dir).select("path")
    if not listed.isEmpty():  # the table is a file; a stream reads folders
        source, pattern = source_dir, file_glob
    stream = (spark.readStream.schema(schema).option("pathGlobFilter", pattern)
              .option("maxFilesPerTrigger", max_files_per_trigger).parquet(source))
    folded = stream.groupBy(match).agg(*state_aggregates(match, order, member, value, roster,
                                                         fainted))
    out = scratch_path(spark, "state-fold")

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(out)

    q = (folded.writeStream.outputMode("complete").foreachBatch(write)
         .option("checkpointLocation", scratch_path(spark, "state-fold-ckpt"))
         .trigger(availableNow=True).start())
    q.awaitTermination()
    if q.exception():
        raise q.exception()
    return spark.read.parquet(out)
