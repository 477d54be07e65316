"""Silver rules (R1-R4): table constraints re-expressed as data checks.

A rule set is a mapping name -> boolean Column that is TRUE for a valid
row. ``split`` evaluates all rules in one projection and returns
(valid, rejects); rejects carry the list of broken rules. ``assert_rules``
is the load gate: it raises when any row breaks a rule (``on_fail="raise"``)
or returns the split.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlight.operators.joins import bounded
from ledgerlight.session import checkpoint_dir

RULES_COL = "regras_violadas"


def not_null(*cols: str) -> dict[str, Column]:
    return {f"{c}_not_null": F.col(c).isNotNull() for c in cols}


def broken(rules: Mapping[str, Column]) -> Column:
    # NULL rule result (unknown) passes, like a SQL CHECK constraint
    return F.array_compact(F.array(*[F.when(~F.coalesce(cond, F.lit(True)), F.lit(name))
                                     for name, cond in rules.items()]))


def split(df: DataFrame, rules: Mapping[str, Column]) -> tuple[DataFrame, DataFrame]:
    """R2: (valid rows, rejected rows + broken rule names)."""
    tagged = df.withColumn(RULES_COL, broken(rules))
    valid = tagged.filter(F.size(RULES_COL) == 0).drop(RULES_COL)
    rejects = tagged.filter(F.size(RULES_COL) > 0)
    return valid, rejects


def rule_counts(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """Rows breaking each rule, one scan -> (regra, qtd)."""
    wide = df.agg(*[F.count_if(~F.coalesce(c, F.lit(True))).alias(n) for n, c in rules.items()])
    return wide.unpivot([], list(rules), "regra", "qtd")


def uniqueness_violations(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Key values that are NULL or occur more than once -> (key..., contagem)."""
    null_key = F.lit(False)
    for k in key:
        null_key = null_key | F.col(k).isNull()
    g = df.groupBy(*key).agg(F.count(F.lit(1)).alias("contagem"),
                             F.max(null_key.cast("int")).alias("__null"))
    return g.filter((F.col("contagem") > 1) | (F.col("__null") == 1)).drop("__null")


def keep_first(df: DataFrame, key: Sequence[str], rule: str = "chave_unica") -> tuple[DataFrame, DataFrame]:
    """R1 on load: (one row per key, the repeats with ``rule`` as their broken rule).

    The smallest row by the other columns stays (NULLs first), whatever the
    input order. A filter on ``row_number() = 1`` is pushed below the shuffle
    (each task keeps one row per key), so a key of any size is safe. The
    repeats come from counts: equal rows collapse to one counted row before
    the shuffle, the row that stays loses one of its copies, and no task
    sorts or holds all rows of a key.
    """
    others = [F.col(c).asc_nulls_first() for c in df.columns if c not in key]
    nth = F.row_number().over(Window.partitionBy(*key).orderBy(*(others or [F.col(key[0])])))
    kept = df.withColumn("__nth", nth).filter("__nth = 1").drop("__nth")
    return kept, _repeats(df, key).withColumn(RULES_COL, F.array(F.lit(rule)))


def repeated_keys(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """The non-null keys that occur more than once, as a checkpoint; only keys and counts travel."""
    checkpoint_dir(df.sparkSession)                      # the cluster's folder, set where it is not yet
    return df.select(*key).dropna(how="any").groupBy(*key).agg(F.count(F.lit(1)).alias("__n")).filter("__n > 1").select(*key).checkpoint()


def keep_first_of_few(df: DataFrame, key: Sequence[str], rule: str = "chave_unica") -> tuple[DataFrame, DataFrame]:
    """``keep_first`` for tables whose keys are mostly unique, with the same rows for all others too.

    The repeated keys are found first, from the keys alone; only their rows (and
    those with a NULL in the key) are ranked and counted, all others stay as
    they are. The list is broadcast if it is proven small, so the rows are not
    shuffled; a longer one is joined by a shuffle. ``df`` is read several times: give a
    table that was written or is kept.
    """
    again = bounded(repeated_keys(df, key).select(*[F.col(k).alias(f"__again_{k}") for k in key]))
    same = reduce(Column.__and__, [F.col(k) == F.col(f"__again_{k}") for k in key])
    unknown = reduce(Column.__or__, [F.col(k).isNull() for k in key])
    alone = df.filter(~unknown).join(again, same, "left_anti")
    kept, repeats = keep_first(df.filter(~unknown).join(again, same, "left_semi").unionByName(df.filter(unknown)), key, rule)
    return alone.unionByName(kept), repeats


def _repeats(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """All rows of ``df`` but the smallest of each key."""
    row = F.struct(*[c for c in df.columns if c not in key]) if len(key) < len(df.columns) else F.lit(0)
    counted = df.select(F.struct(*key).alias("__key"), row.alias("__row")).groupBy("__key", "__row").agg(F.count(F.lit(1)).alias("__n"))
    again = (counted.groupBy("__key").agg(F.sum("__n").alias("__all"), F.min("__row").alias("__first"))
             .filter("__all > 1").select(F.col("__key").alias("__again"), "__first"))
    more = (counted.join(again, F.col("__key").eqNullSafe(F.col("__again")))
            .withColumn("__left", F.col("__n") - F.col("__row").eqNullSafe(F.col("__first")).cast("int")).filter("__left > 0"))
    fields = [(F.col("__key")[c] if c in key else F.col("__row")[c]).alias(c) for c in df.columns]
    return more.select(*fields, F.explode(F.sequence(F.lit(1), F.col("__left"))).alias("__copy")).drop("__copy")


class RuleViolation(Exception):
    pass


def assert_rules(df: DataFrame, rules: Mapping[str, Column], on_fail: str = "raise"):
    """Load gate. ``raise`` -> exception naming the broken rules (one
    scan, only counts reach the driver); ``split`` -> (valid, rejects)."""
    if on_fail == "split":
        return split(df, rules)
    counts = {r["regra"]: r["qtd"] for r in rule_counts(df, rules).collect()}
    broken = {k: v for k, v in counts.items() if v}
    if broken:
        raise RuleViolation(f"rows break rules: {broken}")
    return df
