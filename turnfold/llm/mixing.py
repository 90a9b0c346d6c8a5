"""Mixing of sources to target weights.

Word counts are summed per source; the sources, in code-point order with null
last, weigh 5, 2, 1, 5, ... and share the whole.  A source's target stops at
``MAX_REPEATS`` times its size and what exceeds that is shared anew by weight
until no target is above.  A document of a source with repetition rate r is
emitted floor(r) times, and once more if a hash-seeded Bernoulli draw with
probability p = r - floor(r) says so.  The draws of a source are spread: its
documents are dealt by hash into strata of about ``STRATUM`` documents; inside
a stratum, by size, the i-th document gets its copy if floor(u + i p) steps up
there, u being a hash of the stratum.  Each document alone has probability p,
and neighbours in size make up for each other, so the words taken miss the
target by less than the largest document of each stratum.

A hot source is many strata, so no task gets it whole; a stratum comes from the
id and the text, so documents without an id or under one id are spread too.
Defined results: null text has size 0; a source without words has target 0 and
yields nothing; null and repeated ids are rows of their own; rows equal in id
and text share a stratum, are drawn one by one, and reruns agree on how many of
them are taken; an empty table gives no rows; other
columns pass through ``mix_documents`` untouched, and clashing names with the
working columns are kept apart by a prefix.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .frames import WORD, written

WEIGHTS = (5, 2, 1)
MAX_REPEATS = 3
STRATUM = 256


def word_count(text: str | Column) -> Column:
    text = F.col(text) if isinstance(text, str) else text
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def unit_hash(*parts: Column) -> Column:
    """A uniform number in [0, 1) from the md5 of the parts, as SQL on any
    engine can repeat: 13 hex digits over 2**52."""
    text = F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit("<null>")) for p in parts])
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("long") / F.lit(float(2**52))


def source_targets(sized: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_repeats: float = MAX_REPEATS) -> DataFrame:
    """``source, source_size, source_docs, target`` from rows (source, size).

    After the grouped sum there is one row a source; the two windows without
    a key run over those rows only."""
    per = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("source_docs"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    place = F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights)))
    per = per.withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (place + 1).cast("int")))
    per = per.withColumn("cap", F.col("source_size") * F.lit(float(max_repeats)))
    rising = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before = rising.rowsBetween(Window.unboundedPreceding, -1)
    onward = rising.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    whole = Window.partitionBy()
    per = (per.withColumn("total", F.sum("source_size").over(whole).cast("double"))
           .withColumn("level", (F.col("total") - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
                       / F.sum("weight").over(onward))
           .withColumn("open", F.col("level") * F.col("weight") <= F.col("cap")))
    # the level of the first source that stays below its cap holds for all later ones
    final = F.min(F.when(F.col("open"), F.struct(F.col("cap") / F.col("weight"), F.col("level"))))
    per = per.withColumn("final", final.over(whole)["level"])
    return per.select("source", "source_size", "source_docs",
                      F.least(F.col("cap"), F.coalesce(F.col("final") * F.col("weight"), F.col("cap"))).alias("target"))


def copy_counts(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source",
                seed: int = 17, keep: list[str] | None = None) -> DataFrame:
    """``doc_id, source, size, source_size, target, copies`` per document.

    The targets are written first, so that the plan knows how few they are:
    the documents are then dealt to strata only, not to sources before."""
    kept = [F.col(c).alias("_kept_" + c) for c in keep or []]
    sized = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(source).alias("source"),
                        word_count(text).alias("size"), F.md5(text).alias("_text"), *kept)
    targets = written(source_targets(sized.select("source", "size")), "source-targets").withColumnRenamed("source", "_s")
    df = sized.join(targets, F.col("source").eqNullSafe(F.col("_s")), "inner").drop("_s")
    strata = F.greatest(F.lit(1), F.ceil(F.col("source_docs") / STRATUM)).cast("long")
    df = df.withColumn("stratum", F.floor(unit_hash(F.lit(seed), F.col("doc_id"), F.col("_text")) * strata).cast("long"))
    order = Window.partitionBy("source", "stratum").orderBy("size", "doc_id", "_text")
    start = unit_hash(F.lit(seed), F.col("source"), F.col("stratum"))
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    df = df.withColumn("_rate", rate).withColumn("_u", start).withColumn("_i", F.row_number().over(order))
    part = F.col("_rate") - F.floor("_rate")
    extra = F.floor(F.col("_u") + F.col("_i") * part) - F.floor(F.col("_u") + (F.col("_i") - 1) * part)
    return (df.withColumn("copies", (F.floor("_rate") + extra).cast("int"))
            .drop("stratum", "source_docs", "_text", "_rate", "_u", "_i"))


def mix_documents(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source",
                  seed: int = 17) -> DataFrame:
    """The mix itself: every document as many times as it is taken, with the
    columns of ``docs``."""
    counted = copy_counts(docs, key, text, source, seed, keep=docs.columns)
    one_each = counted.where(F.col("copies") > 0).withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("copies"))))
    return one_each.select(*[F.col("_kept_" + c).alias(c) for c in docs.columns])
