"""Counts, class-balance weights, target encoding and distinct scans.

Every statistic that the original kept in a driver-side dict is a keyed
DataFrame here.  Scalars (total, min, max, mean, population sd, global
mean) come from one aggregate row, the only thing brought to the driver.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import selection as SEL

TASK_ROWS = 500_000  # rows of a task of the target encoding
NAME_PARTS = 16      # parts that the rows of a name and fold are summed in

WEIGHT_METHODS = ("inverse_frequency", "sqrt_inverse", "log_inverse", "min_max", "z_score")
RENORMALISED = ("inverse_frequency", "sqrt_inverse", "log_inverse")


def py_float(col: Column) -> Column:
    """A double in Python spelling: plain from 1e-4 up to below 1e16, where
    Spark's cast changes to an exponent at 1e-3 and 1e7; then ``1e+16``."""
    s = col.cast("string")
    split = F.split(F.ltrim(s, F.lit("-")), "E")
    mantissa, e = split[0], F.get(split, F.lit(1)).cast("int")
    short = F.regexp_replace(mantissa, r"\.0$", "")
    digits = F.replace(short, F.lit("."), F.lit(""))
    padded = F.rpad(digits, F.greatest(F.length(digits), e + 1), F.lit("0"))
    fraction = F.substr(padded, e + 2)
    large = F.concat(F.substr(padded, F.lit(1), e + 1), F.lit("."), F.when(fraction == "", "0").otherwise(fraction))
    small = F.concat(F.lit("0."), F.repeat(F.lit("0"), -e - 1), digits)
    power = F.concat(short, F.when(e < 0, "e-").otherwise("e+"), F.lpad(F.abs(e).cast("string"), F.greatest(F.length(F.abs(e).cast("string")), F.lit(2)), F.lit("0")))
    spelled = F.when((e >= 0) & (e < 16), large).when((e < 0) & (e >= -4), small).otherwise(power)
    return (F.when(F.isnan(col), "nan").when(col == float("inf"), "inf").when(col == -float("inf"), "-inf")
            .when(s.contains("E"), F.concat(F.when(s.startswith("-"), "-").otherwise(""), spelled)).otherwise(s))


def py_str(col: Column, dtype: T.DataType) -> Column:
    """``str(value)`` as the original renders it, for the types a member
    record holds: strings as is, numbers and booleans in Python spelling,
    string lists as ``['a', 'b']`` and null as ``None``."""
    if isinstance(dtype, T.StringType):
        s = col
    elif isinstance(dtype, T.BooleanType):
        s = F.when(col, F.lit("True")).otherwise(F.lit("False"))
    elif isinstance(dtype, (T.DoubleType, T.FloatType)):
        s = py_float(col)
    elif isinstance(dtype, T.ArrayType):
        s = F.concat(F.lit("["),
                     F.array_join(F.transform(col, lambda x: F.concat(F.lit("'"), x.cast("string"),
                                                                      F.lit("'"))), ", "),
                     F.lit("]"))
    else:
        s = col.cast("string")
    return F.coalesce(s, F.lit("None"))


def content_key(df: DataFrame, fields: Sequence[str]) -> Column:
    """E1 key: concatenation of ``str(value)`` of all fields in order.
    (Different records can share a key: "1"+"23" = "12"+"3"; use
    :func:`content_count` with ``by_struct=True`` to avoid collisions.)"""
    types = {f.name: f.dataType for f in df.schema.fields}
    return F.concat(*[py_str(F.col(f), types[f]) for f in fields])


def content_count(df: DataFrame, fields: Sequence[str], by_struct: bool = False,
                  position: str | None = None) -> DataFrame:
    """``key, count`` (and ``first_pos`` = smallest position when a
    position column is given).  Partial aggregation: a key holding a third
    of all rows is combined map-side."""
    key = F.struct(*fields) if by_struct else content_key(df, fields)
    aggs = [F.count(F.lit(1)).cast("long").alias("count")]
    if position:
        aggs.append(F.min(position).alias("first_pos"))
    return df.groupBy(key.alias("key")).agg(*aggs)


def first_seen(df: DataFrame, fields: Sequence[str], position: str,
               attrs: Sequence[str] | None = None) -> DataFrame:
    """The first record (smallest ``position``) of every content key."""
    attrs = list(attrs or fields)
    rec = F.struct(*[F.col(a) for a in attrs])
    out = df.groupBy(content_key(df, fields).alias("key")).agg(
        F.count(F.lit(1)).cast("long").alias("count"),
        F.min(position).alias("first_pos"),
        F.min_by(rec, F.col(position)).alias("_rec"))
    return out.select("key", "count", "first_pos", *[F.col("_rec." + a).alias(a) for a in attrs])


def attribute_table(first: DataFrame, features: Sequence[str], types_col: str | None = None
                    ) -> DataFrame:
    """One column per feature, non-``type_`` features first (sorted),
    then ``type_`` flags (sorted); a feature ``f`` reads ``base_f`` if that
    column exists, else ``f``, else null (the original prints N/A)."""
    cols = set(first.columns)
    ordered = sorted(features, key=lambda f: (f.startswith("type_"), f))
    out = [F.col("key"), F.col("count")]
    for f in ordered:
        if f.startswith("type_"):
            t = f.split("_", 1)[1]
            val = (F.array_contains(F.col(types_col), F.lit(t)).cast("int") if types_col
                   else F.lit(None).cast("int"))
        elif "base_" + f in cols:
            val = F.col("base_" + f).cast("string")
        elif f in cols:
            val = F.col(f).cast("string")
        else:
            val = F.lit(None).cast("string")
        out.append(val.alias(f))
    return first.select(*out)


def count_stats(counts: DataFrame, count_col: str = "count") -> dict:
    """Total, number of keys, mean, population sd, min and max of counts
    (one aggregate row)."""
    c = F.col(count_col)
    r = counts.agg(F.sum(c).alias("total"), F.count(F.lit(1)).alias("n"), F.avg(c).alias("mean"),
                   F.stddev_pop(c).alias("sd"), F.min(c).alias("min"),
                   F.max(c).alias("max")).first()
    return r.asDict()


def _rescaled(c: Column, origin: float | None, unit: float | None, flat: float) -> Column:
    """``(c - origin) / unit``; a constant where the counts do not differ."""
    return (c - F.lit(float(origin))) / F.lit(float(unit)) if unit else F.lit(flat)


#: Weight of a count, given the statistics of all counts.
WEIGHTS = {
    "inverse_frequency": lambda c, s: 1.0 / c,
    "sqrt_inverse": lambda c, s: 1.0 / F.sqrt(c),
    "log_inverse": lambda c, s: 1.0 / F.log(c + 1.0),
    "min_max": lambda c, s: _rescaled(c, s["min"], s["max"] - s["min"], 1.0),
    "z_score": lambda c, s: _rescaled(c, s["mean"], s["sd"], 0.0),
}


def weight_expr(method: str, stats: dict, count_col: str = "count") -> Column:
    """E4-E8 before re-normalisation."""
    if method not in WEIGHTS:
        raise ValueError(f"no weight method {method!r}; there are {', '.join(WEIGHTS)}")
    return WEIGHTS[method](F.col(count_col).cast("double"), stats)


def normalise_counts(counts: DataFrame, method: str = "inverse_frequency",
                     count_col: str = "count", stats: dict | None = None) -> DataFrame:
    """Adds ``freq`` (count / total) and ``weight``; the inverse
    methods are re-scaled so the weights sum to the number of keys.  An
    empty input gives an empty result (E9: the method is only checked when
    there is something to weigh).  ``stats`` may carry an earlier
    :func:`count_stats` result of the same counts, saving its pass."""
    stats = stats if stats is not None else count_stats(counts, count_col)
    if not stats["n"]:
        return counts.withColumn("weight", F.lit(None).cast("double")) \
                     .withColumn("freq", F.lit(None).cast("double"))
    w = weight_expr(method, stats, count_col)
    out = counts.withColumn("weight", w.cast("double"))
    if method in RENORMALISED:
        wsum = out.agg(F.sum("weight")).first()[0]
        out = out.withColumn("weight", F.col("weight") / F.lit(wsum) * F.lit(float(stats["n"])))
    return out.withColumn("freq", F.col(count_col) / F.lit(float(stats["total"])))


def attach_weights(members: DataFrame, weights: DataFrame, fields: Sequence[str],
                   weight_col: str = "sample_weight", default: float = 1.0) -> DataFrame:
    """Weight of every member by its content key (computed on the
    original fields, so re-applying does not change the key), default 1.0.

    The weight table has one row per distinct key; the planner picks the
    join from its size in bytes."""
    keyed = members.withColumn("_tf_key", content_key(members, fields))
    w = weights.select(F.col("key").alias("_tf_key"), F.col("weight").alias("_tf_w"))
    out = keyed.join(w, "_tf_key", "left")
    return out.withColumn(weight_col, F.coalesce(F.col("_tf_w"), F.lit(default))) \
              .drop("_tf_key", "_tf_w")


def require_path(df: DataFrame, path: str) -> None:
    """A record lacking the path voids the whole weighting call in
    the original; here it raises with the number of such records."""
    missing = df.where(F.col(path).isNull()).limit(1).count()
    if missing:
        n = df.where(F.col(path).isNull()).count()
        raise ValueError(f"{n} records lack the field path {path!r}")


def method_comparison(counts: DataFrame, methods: Sequence[str] = RENORMALISED,
                      order_col: str = "first_pos") -> DataFrame:
    """For each method, the weights of the most and least common key
    and their ratio (least / most, 0 when most <= 0).  Ties follow a stable
    sort by count descending over first-seen order: the most common is the
    first seen among the largest counts, the least common the last seen
    among the smallest."""
    order = F.struct(F.col("count"), F.negative(F.col(order_col)))
    stats = count_stats(counts)          # one pass, shared by every method
    rows = []
    for m in methods:
        w = normalise_counts(counts, m, stats=stats)
        rows.append(w.agg(F.lit(m).alias("method"),
                          F.max_by("key", order).alias("most_key"),
                          F.min_by("key", order).alias("least_key"),
                          F.max_by("weight", order).alias("most_weight"),
                          F.min_by("weight", order).alias("least_weight")))
    out = rows[0]
    for r in rows[1:]:
        out = out.unionByName(r)
    return out.withColumn("ratio", F.when(F.col("most_weight") > 0,
                                          F.col("least_weight") / F.col("most_weight"))
                          .otherwise(F.lit(0.0)))


def hash_fold(cols: Sequence[str | Column], k: int, seed: int = 42) -> Column:
    """Fold id from a seeded hash of a key -- stable under
    repartitioning and retries (the original shuffles row positions, so the
    folds are equal in distribution, not identical)."""
    cs = [F.col(c) if isinstance(c, str) else c for c in cols]
    return F.pmod(F.xxhash64(F.lit(seed), *cs), F.lit(k)).cast("int")


def kfold_target_encoding(rows: DataFrame, name: str, target: Column, fold: Column,
                          min_name_len: int = 1) -> DataFrame:
    """Out-of-fold mean target per name.

    For every fold f in which the name is in the validation part, the code
    is the name's mean target on the other folds, or the global mean when
    the name does not occur there; the name's encoding is the plain mean of
    these per-fold codes.

    Rows are summed by (name, fold, part of the name's rows), these sums by
    (name, fold), and a window over name sees at most k rows a name.  There
    are as many tasks as ``TASK_ROWS`` asks for whatever the session says, so
    what a task holds does not grow with the rows, and a frequent name is
    summed by several tasks.
    """
    base = rows.select(F.col(name).alias("name"), target.cast("double").alias("_y"), fold.alias("_fold"),
                       F.pmod(SEL.whole_row(rows), F.lit(NAME_PARTS)).alias("_part"))
    base = base.where(F.col("name").isNotNull() & (F.length("name") >= min_name_len))
    gm, n = base.agg(F.avg("_y"), F.count(F.lit(1))).first()
    tasks = max(rows.sparkSession.sparkContext.defaultParallelism, -(-n // TASK_ROWS))
    keys = ["name", "_fold", "_part"]
    per = base.repartition(tasks, *keys).groupBy(*keys).agg(F.sum("_y").alias("_s"), F.count(F.lit(1)).alias("_n"))
    per = per.repartition(tasks, "name").groupBy("name", "_fold").agg(F.sum("_s").alias("_s"), F.sum("_n").alias("_n"))
    w = Window.partitionBy("name")
    per = (per.withColumn("_tot_s", F.sum("_s").over(w))
              .withColumn("_tot_n", F.sum("_n").over(w)))
    code = F.when(F.col("_tot_n") > F.col("_n"),
                  (F.col("_tot_s") - F.col("_s")) / (F.col("_tot_n") - F.col("_n"))
                  ).otherwise(F.lit(gm))
    return per.groupBy("name").agg(F.avg(code).alias("encoding"),
                                   F.max("_tot_n").cast("long").alias("n"))


def distinct_field_values(df: DataFrame, struct_cols: Sequence[str], field: str) -> DataFrame:
    """Distinct values of ``field`` over every struct column of a turn
    that has it (array values are fine here, unlike the original)."""
    types = {f.name: f.dataType for f in df.schema.fields}
    have = [c for c in struct_cols
            if isinstance(types.get(c), T.StructType) and field in types[c].fieldNames()]
    if not have:
        return df.sparkSession.createDataFrame([], T.StructType([T.StructField("value", T.StringType())]))
    stacked = df.select(F.explode(F.array(*[F.col(c)[field].cast("string") for c in have]))
                        .alias("value"))
    return stacked.where(F.col("value").isNotNull()).distinct()


def class_counts(df: DataFrame, label: Column) -> DataFrame:
    """Total, wins, losses."""
    y = label.cast("int")
    return df.agg(F.count(F.lit(1)).cast("long").alias("total"),
                  F.count_if(y == 1).cast("long").alias("wins"),
                  F.count_if(y == 0).cast("long").alias("losses"))


def weight_handling(members: DataFrame, counts: DataFrame, fields: Sequence[str],
                    method: str = "sqrt_inverse", weight_col: str = "sample_weight"
                    ) -> tuple[DataFrame, DataFrame]:
    """The weighting driver -- the E12 comparison report, then the
    chosen method's weights (E3-E10) attached to every member (E11).
    Returns ``(weighted members, comparison report)``."""
    report = method_comparison(counts)
    weights = normalise_counts(counts, method, stats=count_stats(counts))
    return attach_weights(members, weights, fields, weight_col=weight_col), report


def roster_counts(rosters: DataFrame, team_col: str) -> DataFrame:
    """Total members and total matches of an array-of-members column."""
    return rosters.agg(F.sum(F.size(team_col)).cast("long").alias("members"),
                       F.count(F.lit(1)).cast("long").alias("matches"))
