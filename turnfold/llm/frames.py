"""Spark-side helpers of the language-model operators."""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
WORD = r"[^\x20\x09-\x0D]+"


def ship(spark: SparkSession) -> None:
    """Let local Python workers import this package whatever the working
    folder; a cluster gets it by ``--py-files`` or PYTHONPATH."""
    env = spark.sparkContext.environment
    if ROOT not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(x for x in (env.get("PYTHONPATH", ""), ROOT) if x)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(key: str | Column, modulus: int) -> Column:
    """crc32 of the key's decimal text, modulo ``modulus``."""
    key = F.col(key) if isinstance(key, str) else key
    return F.pmod(F.crc32(key.cast("string")), F.lit(modulus).cast("long"))


def written(df: DataFrame, name: str) -> DataFrame:
    """The frame, written to a fresh folder under ``spark.checkpoint.dir`` and
    read back: lineage ends there and a lost executor repeats no more."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def hashed_sample(df: DataFrame, key: str, rows: int, salt: str) -> DataFrame:
    """At most ``rows`` rows, those with the least hash of the key.  A filter
    on the hash, from a count, keeps what tasks send near ``rows`` in all."""
    h = F.crc32(F.concat(F.lit(salt), F.col(key).cast("string")))
    n = df.count()
    share = min(1.0, (rows + 6.0 * rows**0.5 + 10.0) / max(n, 1))
    return df.where(h <= int(share * 2**32)).orderBy(h, key).limit(rows)
