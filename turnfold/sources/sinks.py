"""Prediction CSV, model runs and the runs table.

Folders are listed through the Hadoop FileSystem of the session, so the
same code works on HDFS or an object store.
"""

from __future__ import annotations

import datetime as _dt
import re

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .logs import file_order

RUNS_TABLE = "_runs"


def write_predictions(df: DataFrame, path: str, id_col: str = "battle_id",
                      label_col: str = "prediction") -> None:
    """Header ``battle_id,player_won``; integers.  Written in parallel
    (one file per partition); order by key only when a single ordered file
    is needed."""
    (df.select(F.col(id_col).cast("long").alias("battle_id"),
               F.col(label_col).cast("int").alias("player_won"))
       .write.mode("overwrite").option("header", True).csv(path))


def read_predictions(spark: SparkSession, path: str) -> DataFrame:
    """Key as string, label as int; when a key repeats the last one in
    file order wins (the original loads the rows into a dict)."""
    df = spark.read.schema("battle_id string, player_won int").option("header", True).csv(path)
    o = file_order(df)
    pos = F.struct("_file", "_block", "_seq")
    return o.groupBy("battle_id").agg(F.max_by("player_won", pos).alias("player_won"))


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def run_numbers(spark: SparkSession, root: str, prefix: str = "model") -> list[int]:
    """Numeric suffixes of ``<prefix>_<N>`` folders under root (others ignored)."""
    p, fs = _fs(spark, root)
    if not fs.exists(p):
        return []
    pat = re.compile(rf"^{re.escape(prefix)}_(\d+)$")
    out = []
    for st in fs.listStatus(p):
        m = pat.match(st.getPath().getName())
        if st.isDirectory() and m:
            out.append(int(m.group(1)))
    return sorted(out)


def save_run(spark: SparkSession, model: PipelineModel, root: str, prefix: str = "model",
             params: dict | None = None) -> tuple[int, str]:
    """A8 + A10: new folder ``<prefix>_<max N + 1>`` (starting at 1) holding
    the pipeline; one row appended to the runs table."""
    n = (max(run_numbers(spark, root, prefix)) + 1) if run_numbers(spark, root, prefix) else 1
    path = f"{root.rstrip('/')}/{prefix}_{n}"
    model.write().overwrite().save(path)
    append_run_record(spark, root, prefix, n, params or {})
    return n, path


def latest_run(spark: SparkSession, root: str, prefix: str = "model") -> tuple[int, str]:
    """Highest run number; raises when there is none."""
    nums = run_numbers(spark, root, prefix)
    if not nums:
        raise FileNotFoundError(f"no {prefix}_N run under {root}")
    return nums[-1], f"{root.rstrip('/')}/{prefix}_{nums[-1]}"


def load_latest(spark: SparkSession, root: str, prefix: str = "model") -> tuple[int, PipelineModel]:
    n, path = latest_run(spark, root, prefix)
    return n, PipelineModel.load(path)


def check_package(model: PipelineModel, required: dict[str, type]) -> None:
    """Raise unless every named stage type is present."""
    have = [type(s) for s in model.stages]
    missing = [k for k, t in required.items() if not any(issubclass(h, t) for h in have)]
    if missing:
        raise KeyError(f"model package lacks {missing}")


_RUN_SCHEMA = T.StructType([
    T.StructField("prefix", T.StringType()), T.StructField("run", T.IntegerType()),
    T.StructField("ts", T.TimestampType()), T.StructField("key", T.StringType()),
    T.StructField("value", T.StringType()),
])


def append_run_record(spark: SparkSession, root: str, prefix: str, run: int, params: dict) -> None:
    """``key: value`` parameters become rows of a parquet runs table
    (UTC stamp, hyper-parameters, metrics, row counts, diff %)."""
    ts = _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)
    rows = [(prefix, int(run), ts, str(k), None if v is None else str(v)) for k, v in params.items()]
    if not rows:
        rows = [(prefix, int(run), ts, "created", "true")]
    spark.createDataFrame(rows, _RUN_SCHEMA).write.mode("append").parquet(
        f"{root.rstrip('/')}/{RUNS_TABLE}")


def read_runs(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.schema(_RUN_SCHEMA).parquet(f"{root.rstrip('/')}/{RUNS_TABLE}")


def latest_run_record(spark: SparkSession, root: str, prefix: str = "model") -> DataFrame:
    """Parameters of the newest run of ``prefix``."""
    r = read_runs(spark, root).where(F.col("prefix") == prefix)
    top = r.agg(F.max("run").alias("run"))
    return r.join(top, "run").select("prefix", "run", "key", "value")
