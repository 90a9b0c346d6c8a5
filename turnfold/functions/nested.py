"""Nested path walks, unnesting and named projections."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def path_walk(df: DataFrame, path: Sequence[str]) -> Column:
    """B1: walk ``path`` from the row; through a struct take the child; at
    an array of structs take the field of the **first element that has it
    non-null**; if none has it, the list itself is kept (and counts as
    found), as the counting walk does."""
    dtype: T.DataType = df.schema
    col: Column | None = None
    for name in path:
        if isinstance(dtype, T.StructType):
            if name not in dtype.fieldNames():
                return F.lit(None)
            col = F.col(name) if col is None else col[name]
            dtype = dtype[name].dataType
        elif isinstance(dtype, T.ArrayType) and isinstance(dtype.elementType, T.StructType) \
                and name in dtype.elementType.fieldNames():
            arr = col
            hit = F.try_element_at(F.filter(arr, lambda x: x[name].isNotNull()), F.lit(1))
            col = hit[name]
            dtype = dtype.elementType[name].dataType
        else:
            return col if col is not None else F.lit(None)
    return col


def skip_missing(df: DataFrame, path: str) -> DataFrame:
    """B2: records lacking the path are skipped."""
    return df.where(F.col(path).isNotNull())


def unnest(df: DataFrame, array_col: str, keep: Sequence[str] = (), with_pos: bool = False
           ) -> DataFrame:
    """One row per element; records with no elements vanish (not the
    ``_outer`` variants)."""
    if with_pos:
        return df.select(*keep, F.posexplode(array_col).alias("pos", "member"))
    return df.select(*keep, F.explode(array_col).alias("member"))


def named_projection(df: DataFrame, feature_names: Sequence[str], types_col: str = "types",
                     weight_col: str | None = "sample_weight") -> DataFrame:
    """One column per name in the given order; ``type_<x>`` is the
    membership indicator of x in the member's types (B6); the optional
    weight column defaults to 1.0 (B7).  A missing plain field raises."""
    cols = set(df.columns)
    out = []
    for name in feature_names:
        if name.startswith("type_"):
            t = name.split("_", 1)[1]
            out.append(F.array_contains(F.col(types_col), F.lit(t)).cast("int").alias(name))
        else:
            if name not in cols:
                raise KeyError(name)
            out.append(F.col(name))
    if weight_col is not None:
        w = F.col(weight_col) if weight_col in cols else F.lit(None)
        out.append(F.coalesce(w.cast("double"), F.lit(1.0)).alias("sample_weight"))
    return df.select(*out)


def non_empty_names(df: DataFrame, name_col: str) -> DataFrame:
    """Drop null and empty names."""
    return df.where(F.col(name_col).isNotNull() & (F.col(name_col) != F.lit("")))


def numeric_projection(df: DataFrame, exclude: Sequence[str]) -> DataFrame:
    """All numeric columns except the keys, **sorted by name** (as the
    set difference on a column index sorts)."""
    numeric = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType,
               T.DecimalType)
    names = sorted(f.name for f in df.schema.fields
                   if isinstance(f.dataType, numeric) and f.name not in set(exclude))
    return df.select(*names)
