"""Multi-grain median benchmarks (A7/A8), one exact form for every size.

Rows are expanded to the wanted grains; rolled-up keys get the sentinel
(-999), never ``coalesce`` (a real key may be NULL). A median needs no group
in one task:

1. equal values are counted (partial aggregation): the many zeros of a dense
   grid collapse to one row per group before the shuffle;
2. values are put into ranges by the leading bits of their binary form, which
   sort like the values; the counts of the ranges are summed up per group (a
   few thousand ranges at most);
3. inside the one or two ranges that hold the middle ranks, the counts of the
   values are summed up, and the middle values are taken.

The result is PERCENTILE_CONT(0.5): low + (high - low) / 2 of the middle values.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlight import schemas as S

#: Ranges keep sign, exponent and this many leading bits of the mantissa: a range spans 0.02 % of its values.
RANGE_BITS = 12


def _all_sets(optional: list[str]) -> list[list[str]]:
    n = len(optional)
    return [[optional[i] for i in range(n) if mask & (1 << (n - 1 - i))] for mask in range((1 << n) - 1, -1, -1)]


def expand_grains(df: DataFrame, always: Sequence[str], optional: Sequence[str], sets: Sequence[Sequence[str]],
                  values: dict[str, str], sentinel: int = S.ALL_MEMBERS, carry: Sequence[str] = ()) -> DataFrame:
    """One row per (input row, grain): keys outside the grain become ``sentinel``; the columns ``carry`` stay as they are."""
    grains = F.array(*[F.struct(*[(F.col(k) if k in st else F.lit(sentinel).cast(df.schema[k].dataType)).alias(k) for k in optional])
                       for st in sets])
    return df.select(*always, *carry, *[F.col(src).cast("double").alias(out) for out, src in values.items()],
                     F.explode(grains).alias("__v")).select(*always, *carry, "__v.*", *values.keys())


def _range(value: str, bits: int) -> Column:
    """An integer that sorts like the double: the leading part of its magnitude, signed."""
    size = F.abs(F.col(value))
    exponent = F.when(size > 0, F.floor(F.log2(size))).otherwise(F.lit(-1075))
    lead = F.when(size > 0, F.floor(size / F.pow(F.lit(2.0), exponent) * (1 << bits))).otherwise(F.lit(0))
    code = (exponent + 1076) * (1 << (bits + 2)) + lead
    return F.when(F.col(value) < 0, -code).otherwise(code).cast("long")


def group_median(df: DataFrame, group_cols: Sequence[str], value: str, bits: int = RANGE_BITS, weight: str | None = None) -> DataFrame:
    """Exact PERCENTILE_CONT(0.5) of ``value`` per group (NULL values are skipped, NULL keys form groups). A row
    stands for ``weight`` equal rows (positive whole numbers; one if there is no such column)."""
    counted = (df.filter(F.col(value).isNotNull()).withColumn("__g", F.struct(*group_cols))
               .groupBy("__g", F.col(value).alias("__v")).agg((F.sum(weight) if weight else F.count(F.lit(1))).alias("__n"))
               .withColumn("__r", _range("__v", bits)))
    middle = _middle(counted.groupBy("__g", "__r").agg(F.sum("__n").alias("__n")), ["__g"])
    found = _picked(counted.join(middle, ["__g", "__r"]), ["__g"], value)
    return found.select(*[F.col("__g")[c].alias(c) for c in group_cols], value)


def _ranks() -> tuple[Column, Column]:
    """The middle ranks, from 1."""
    return F.floor((F.col("__all") + 1) / 2), F.floor(F.col("__all") / 2) + 1


def _middle(ranges: DataFrame, by: Sequence[str]) -> DataFrame:
    """The one or two ranges that hold a group's middle ranks, with the values before them (``__n`` values per group and range ``__r``)."""
    upto = Window.partitionBy(*by).orderBy("__r").rowsBetween(Window.unboundedPreceding, 0)
    ranges = ranges.select(*by, "__r", F.sum("__n").over(upto).alias("__to"), F.col("__n").alias("__in"),
                           F.sum("__n").over(Window.partitionBy(*by)).alias("__all"))
    low, high = _ranks()
    first = F.col("__to") - F.col("__in") + 1
    return ranges.filter((first <= high) & (F.col("__to") >= low)).select(*by, "__r", "__all", (first - 1).alias("__before"))


def _picked(near: DataFrame, by: Sequence[str], out: str) -> DataFrame:
    """The middle of the counted values (``__v``, ``__n``) of the middle ranges."""
    within = Window.partitionBy(*by, "__r").orderBy("__v").rowsBetween(Window.unboundedPreceding, 0)
    near = near.withColumn("__end", F.col("__before") + F.sum("__n").over(within)).withColumn("__begin", F.col("__end") - F.col("__n") + 1)

    def at(rank: Column) -> Column:
        return F.max(F.when((F.col("__begin") <= rank) & (F.col("__end") >= rank), F.col("__v")))

    low, high = _ranks()
    found = near.groupBy(*by).agg(at(low).alias("__lo"), at(high).alias("__hi"))
    return found.select(*by, (F.col("__lo") + (F.col("__hi") - F.col("__lo")) * 0.5).alias(out))


def multi_grain_median(df: DataFrame, always: str, optional: Sequence[str], values: dict[str, str],
                       sets: Sequence[Sequence[str]] | None = None, sentinel: int = S.ALL_MEMBERS,
                       bits: int = RANGE_BITS, weight: str | None = None) -> DataFrame:
    """Median of each ``values`` column per grain (every subset of ``optional`` by default), with ``always``; a row
    stands for ``weight`` rows.

    All values are ranked in one pass: each row gives one (name, value) per
    column. A group all of whose values are NULL has a NULL median; a zero
    under a name of its own, one counted row per group, keeps it in the result.
    """
    optional = list(optional)
    sets = [list(st) for st in sets] if sets is not None else _all_sets(optional)
    keys = [always, *optional]
    carry = [weight] if weight else []
    rows = expand_grains(df, [always], optional, sets, values, sentinel, carry)
    named = F.array(F.struct(F.lit("").alias("__name"), F.lit(0.0).alias("__value")),
                    *[F.struct(F.lit(v).alias("__name"), F.col(v).alias("__value")) for v in values])
    long = rows.select(*keys, *carry, F.explode(named).alias("__x")).select(*keys, *carry, "__x.__name", "__x.__value")
    found = group_median(long, [*keys, "__name"], "__value", bits, weight)
    return found.groupBy(*keys).agg(*[F.max(F.when(F.col("__name") == v, F.col("__value"))).alias(v) for v in values])

