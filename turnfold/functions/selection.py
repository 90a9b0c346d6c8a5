"""Exact places in a total order without sorting the rows.

The value at a place (the k-th smallest) is found digit by digit: a pass
counts the rows by the next 16 bits of the ordering value among those that
share the digits found so far, for all wanted places together.  A pass shuffles
counts only, at most 65 536 for each place, and reads only the ordering
columns.  Once few rows are left below a place, they are fetched and it is
done; values of 64 bits therefore take two or three passes.  Ties go on to the
next ordering value; rows that are equal in all of them need a number.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import scratch_path

DIGIT = 16
FEW = 4096  # values of one place that are fetched instead of counted
_SIGN = 1 << 63
_U = "_sel_u"


NUMBER = "_sel_number"


class Tied(ValueError):
    """Rows at a wanted place that the ordering values do not part."""


def numbered(df: DataFrame) -> DataFrame:
    """The frame with ``NUMBER``, a last ordering value that parts all rows.
    It is written to the shared folder: numbers by scan order hold only for
    rows that every reader finds in the same place."""
    path = scratch_path(df.sparkSession, "numbered")
    df.withColumn(NUMBER, F.monotonically_increasing_id()).write.parquet(path)
    return df.sparkSession.read.parquet(path)


def whole_row(df: DataFrame) -> Column:
    """A hash of all columns that can be hashed."""
    return F.xxhash64(*[f.name for f in df.schema if "map<" not in f.dataType.simpleString()])


def order_value(df: DataFrame, name: str) -> Column:
    """A column as a long of the same order; of other types than numbers and
    times a hash stands in."""
    kind = df.schema[name].dataType
    if isinstance(kind, (T.LongType, T.IntegerType, T.ShortType, T.ByteType, T.BooleanType)):
        return F.col(name).cast("long")
    if isinstance(kind, T.DateType):
        return F.unix_date(name).cast("long")
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(name)
    return F.xxhash64(name)


def _unsigned(value: Column) -> Column:
    """Longs whose unsigned order is the signed order, null first."""
    return F.coalesce(value, F.lit(-_SIGN)).bitwiseXOR(F.lit(-_SIGN))


def _signed(u: int) -> int:
    return u - 2 * _SIGN if u >= _SIGN else u


def _low_bits(bits: int) -> int:
    return (1 << bits) - 1


def values_at(rows: DataFrame, value: Column, places: Sequence[int]) -> list[tuple[int, int, int]]:
    """For each 0-based place in the order of ``value`` (a long) the value
    there as an unsigned number, the rows below it, and the rows equal to it."""
    if not places:
        return []
    u = rows.select(_unsigned(value).alias(_U))
    flipped = F.col(_U).bitwiseXOR(F.lit(-_SIGN))
    n, low, high = u.agg(F.count(F.lit(1)), F.min(flipped), F.max(flipped)).first()
    if max(places) >= n:
        raise ValueError(f"place {max(places)} of {n} rows")
    low, high = low + _SIGN, high + _SIGN
    bits = (low ^ high).bit_length()  # the bits above are common to all
    found = {p: (low >> bits, 0, n) for p in set(places)}  # digits so far, rows below, rows that share them
    while bits:
        prefixes = sorted({d for d, _, _ in found.values()})
        head = F.shiftrightunsigned(_U, bits) if bits < 64 else F.lit(0).cast("long")
        shared = u.where(head.isin([_signed(x) for x in prefixes]))
        if sum({d: n for d, _, n in found.values()}.values()) <= FEW:
            step, tail = bits, F.col(_U)
        else:
            step = min(DIGIT, bits)
            tail = F.shiftrightunsigned(_U, bits - step)
        counts = shared.groupBy(tail.alias("v")).agg(F.count(F.lit(1)).alias("n")).collect()
        bits -= step
        by: dict[int, list[tuple[int, int]]] = {}
        for v, m in sorted((v + 2 * _SIGN if v < 0 else v, m) for v, m in counts):
            by.setdefault(v >> step, []).append((v, m))
        for p, (digits, below, _) in list(found.items()):
            for v, m in by[digits]:
                if p < below + m:
                    found[p] = (v, below, m)
                    break
                below += m
    return [found[p] for p in places]


def below_place(df: DataFrame, order: Sequence[Column], place: int) -> Column:
    """A condition that holds for the first ``place`` rows of ``df`` in the
    order of ``order`` (longs).  ``df`` is read a few times, key columns only."""
    return below_places(df, order, [place])[0]


def below_places(df: DataFrame, order: Sequence[Column], places: Sequence[int]) -> list[Column]:
    """``below_place`` for several places; the first value's passes are shared."""
    n = df.count()
    inner = [p for p in places if 0 < p < n]
    cuts = dict(zip(inner, values_at(df, order[0], [p for p in inner]), strict=True))
    out = []
    for p in places:
        if p <= 0 or p >= n:
            out.append(F.lit(p > 0))
            continue
        at, below, _ = cuts[p]  # the row at the place itself is the first that does not belong
        own = _unsigned(order[0]).bitwiseXOR(F.lit(-_SIGN))
        cut = F.lit(at - _SIGN)
        before = own < cut
        if p > below:
            if len(order) == 1:
                raise Tied(f"the order does not part the rows at place {p}")
            before = before | ((own == cut) & below_place(df.where(own == cut), order[1:], p - below))
        out.append(before)
    return out


def fold_of(df: DataFrame, order: Sequence[Column], k: int) -> Column:
    """Fold 0..k-1 of each row: consecutive parts of the order, of equal size
    up to one row (the first folds are the larger)."""
    n = df.count()
    sizes = [n // k + (i < n % k) for i in range(k)]
    ends = [sum(sizes[:i + 1]) for i in range(k - 1)]
    return reduce(lambda a, b: a + b, [(~c).cast("int") for c in below_places(df, order, ends)], F.lit(0))
