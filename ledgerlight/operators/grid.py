"""Dense daily grids (J3/J4): every day x every observed member combination,
with zero where nothing was booked.

The grid is generated per combination with ``explode(sequence(...))``
instead of a cross join: the combination list is a distinct projection of
the facts (dimension-bounded) and each row fans out to its days in
parallel. The facts are aggregated to the grid grain first (partial
aggregation), then attached with an equi-join, so the join input on the
fact side is at most one row per (day, combination).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlight.operators.joins import with_scalars


def daily_totals(facts: DataFrame, date_col: str, keys: Sequence[str], value: str, out: str) -> DataFrame:
    """A3/A4/A5: SUM(value) per (date, keys...)."""
    return facts.groupBy(date_col, *keys).agg(F.sum(value).alias(out))


def dense_grid(combos: DataFrame, span: DataFrame, date_col: str = "data") -> DataFrame:
    """Every (combo, day) for the days of ``span``, a one-row frame
    ``(inicio, fim)``; adds ano, mes, dia. An empty or NULL span gives no rows.

    The list of combinations is dealt out by its own columns, so the fan-out
    over days runs in parallel; adaptive execution merges short partitions.
    """
    days = F.when(F.col("fim") >= F.col("inicio"), F.sequence("inicio", "fim"))
    spread = combos.repartition(*combos.columns)
    g = with_scalars(spread, span).select(*combos.columns, F.explode(days).alias(date_col))
    return g.withColumn("ano", F.year(date_col)).withColumn("mes", F.month(date_col)) \
            .withColumn("dia", F.dayofmonth(date_col))


def fill_grid(grid: DataFrame, totals: DataFrame, on: Sequence[tuple[str, str]], value: str,
              out: str) -> DataFrame:
    """Grid LEFT JOIN totals on equality (NULL keys never match), missing -> 0."""
    # fresh names on the totals side: the grid is often derived from them
    t = totals.select(*[F.col(tc).alias(f"__t{i}") for i, (_, tc) in enumerate(on)],
                      F.col(value).alias("__tv"))
    cond = None
    for i, (gc, _) in enumerate(on):
        c = F.col(gc) == F.col(f"__t{i}")
        cond = c if cond is None else cond & c
    j = grid.join(t, cond, "left")
    return j.select(*grid.columns, F.coalesce(F.col("__tv"), F.lit(0)).alias(out))
