"""Medians from kept counts (A8, W20, G4): a state that merges over months.

``month_ranges`` counts, for every month, day of month, grain and value column,
how many booked cells of the grid lie in each range of values
(``benchmark``'s ranges). Counts add up, so the state of any as-of date is
the sum of its months, a late month replaces its own rows only, and a median
needs three small steps:

1. the counts of the months before the cut are summed up; cells without a
   booking are members times days, less the booked ones, and count as zero;
2. the ranges that hold the middle ranks are found (one or two per group);
3. only values of these ranges are read from the members' months, counted,
   and the exact middle values taken.

The state is kept for grains that put members together. At the finest grain
a cell is its own count, and the members' months are the smaller form.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlight import schemas as S
from ledgerlight.operators import benchmark, steps
from ledgerlight.operators.joins import runtime_sized

GRAIN = "grao"


def merged_sets(keys: Sequence[str]) -> list[list[str]]:
    """The grains that the state is kept for: every subset of ``keys`` but the whole."""
    return [st for st in benchmark._all_sets(list(keys)) if len(st) < len(keys)]


def _code(keys: Sequence[str], grain: Sequence[str]) -> int:
    return sum(1 << i for i, k in enumerate(keys) if k in grain)


def _grains(df: DataFrame, keys: Sequence[str], sets: Sequence[Sequence[str]]) -> Column:
    """The grains of a row: keys outside of a grain become the sentinel."""
    def key(k: str, st: Sequence[str]) -> Column:
        return (F.col(k) if k in st else F.lit(S.ALL_MEMBERS).cast(df.schema[k].dataType)).alias(k)
    return F.array(*[F.struct(F.lit(_code(keys, st)).alias(GRAIN), *[key(k, st) for k in keys]) for st in sets])


def booked_cells(found: DataFrame, keys: Sequence[str], values: dict[str, str], sets: Sequence[Sequence[str]],
                 days: Sequence[int] | None = None, bits: int = benchmark.RANGE_BITS) -> DataFrame:
    """``ano, mes, dia, grao, keys, nome, valor, faixa``: one row per day of a step (``steps.steps``), grain and value that is not NULL."""
    listed = F.sequence("de", F.col("ate") - 1)
    if days:
        listed = F.filter(listed, lambda d: d.isin(*days))
    named = F.array(*[F.struct(F.lit(name).alias("nome"), F.col(c).cast("double").alias("valor")) for name, c in values.items()])
    rows = found.select("ano", "mes", F.explode(_grains(found, keys, sets)).alias("__g"), named.alias("__n"), listed.alias("__d"))
    rows = rows.select("ano", "mes", "__g.*", F.explode(F.filter("__n", lambda x: x["valor"].isNotNull())).alias("__x"), "__d")
    rows = rows.select("ano", "mes", GRAIN, *keys, "__x.nome", "__x.valor", "__d").withColumn("faixa", benchmark._range("valor", bits))
    return rows.select("ano", "mes", F.explode("__d").alias("dia"), GRAIN, *keys, "nome", "valor", "faixa")


def month_ranges(found: DataFrame, keys: Sequence[str], values: dict[str, str], bits: int = benchmark.RANGE_BITS) -> DataFrame:
    """The state: ``ano, mes, grao, dia, keys, nome, faixa, n``, at most a few thousand ranges per group."""
    rows = booked_cells(found, keys, values, merged_sets(keys), bits=bits)
    return rows.groupBy("ano", "mes", GRAIN, "dia", *keys, "nome", "faixa").agg(F.count(F.lit(1)).alias("n"))


def before(state: DataFrame, cut: dt.date) -> DataFrame:
    """The counts of the days before ``cut``."""
    month, last = F.col("ano") * 12 + F.col("mes"), cut.year * 12 + cut.month
    return state.filter((month < last) | ((month == last) & (F.col("dia") < cut.day)))


def all_cells(members: DataFrame, span: DataFrame, keys: Sequence[str], sets: Sequence[Sequence[str]], cut: dt.date | None = None,
              days: Sequence[int] | None = None) -> DataFrame:
    """``grao, dia, keys, n``: the cells of the dense grid per group, counted without making it."""
    grained = members.select(F.explode(_grains(members, keys, sets)).alias("__g")).select("__g.*")
    counted = grained.groupBy(GRAIN, *keys).agg(F.count(F.lit(1)).alias("__members"))
    cells = steps.cells(counted, span, [GRAIN, *keys, "__members"], cut)
    cells = cells.filter(F.col("dia").isin(*days)) if days else cells
    return cells.select(GRAIN, "dia", *keys, (F.col("__members") * F.col("celulas")).cast("long").alias("n"))


def medians(state: DataFrame, found: DataFrame, cells: DataFrame, keys: Sequence[str], values: dict[str, str], zero: str,
            sets: Sequence[Sequence[str]], days: Sequence[int] | None = None, bits: int = benchmark.RANGE_BITS) -> DataFrame:
    """``dia, keys`` and the exact median of every value column. ``state`` and ``found`` hold the same days; ``cells`` says how
    many cells a group has: those that are not booked are zero in the column ``zero`` and NULL in the others. NULL keys form groups."""
    group = [GRAIN, "dia", *keys]
    state = state.filter(F.col(GRAIN).isin(*[_code(keys, st) for st in sets]))
    state = state.filter(F.col("dia").isin(*days)) if days else state
    booked = state.filter(F.col("nome") == zero).select(*group, (-F.col("n")).alias("n"))
    empty = (cells.select(*group, "n").unionByName(booked).groupBy(*group).agg(F.sum("n").alias("n")).filter("n > 0")
             .select(*group, F.lit(zero).alias("nome"), F.lit(0.0).alias("valor"), "n").withColumn("faixa", benchmark._range("valor", bits)))

    g, r = F.struct(*group, "nome").alias("__g"), F.col("faixa").alias("__r")
    ranges = state.select(g, r, "n").unionByName(empty.select(g, r, "n")).groupBy("__g", "__r").agg(F.sum("n").alias("__n"))
    middle = benchmark._middle(ranges, ["__g"])
    one = F.lit(1).cast("long").alias("__n")
    near = (booked_cells(found, keys, values, sets, days, bits).select(g, r, F.col("valor").alias("__v"), one)
            .unionByName(empty.select(g, r, F.col("valor").alias("__v"), F.col("n").alias("__n"))))
    near = near.join(runtime_sized(middle), ["__g", "__r"]).groupBy("__g", "__r", "__all", "__before", "__v").agg(F.sum("__n").alias("__n"))
    picked = benchmark._picked(near, ["__g"], "__m").select("__g.*", "__m")
    # every group of the grid has a row, also where all values are NULL
    listed = picked.unionByName(cells.select(*group, F.lit("").alias("nome"), F.lit(0.0).alias("__m")))
    of = [F.max(F.when(F.col("nome") == name, F.col("__m"))).alias(name) for name in values]
    return listed.groupBy(*group).agg(*of).drop(GRAIN)
