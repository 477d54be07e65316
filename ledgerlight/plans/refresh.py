"""Late entries: only what they change is computed and written again.

``build`` writes the gold tables beside the kept silver tables, by month.
``add_entries`` takes a late file of raw ledger rows through the same cleansing and
rules as the first load and publishes one new version in which

* the ledger's touched months are replaced: months that get an entry, or lose one
  to a smaller row with the same id (the row that a full load would keep);
* rejects are appended, and the booked days and benchmark counts of the touched months replaced;
* gold tables whose rows depend on their own month alone are built from the touched
  months only;
* gold tables that look across months (year-to-date, lags, yearly means) are built
  anew from the monthly totals, which are small, compared month by month with the
  old ones, and the months that differ are replaced: those of the touched month,
  of its year, and wherever the lags reach.

All of it appears at once, and equals a full load of all rows.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlight import schemas as S
from ledgerlight.operators import grid, rules, steps
from ledgerlight.operators.joins import bounded
from ledgerlight.plans import gold
from ledgerlight.plans import silver as plan
from ledgerlight.plans.load import DIMENSIONS, MONTH, KeptSilver
from ledgerlight.plans.silver import Silver
from ledgerlight.sources.snapshots import Snapshots

LEDGER = [f.name for f in S.FACT_LANCAMENTOS.fields]
_ID = "id_lancamento"

#: Gold tables whose rows depend on the ledger of their own month.
OF_MONTH: dict[str, Callable[[Silver], DataFrame]] = {
    "gold_lancamentos": gold.gold_lancamentos,
    "gold_lancamentos_consolidados_dia": gold.gold_lancamentos_consolidados_dia,
    "gold_lancamentos_diario": gold.gold_lancamentos_diario,
}
#: Gold tables that look across months, from monthly totals.
ACROSS: dict[str, Callable[[Silver], DataFrame]] = {"gold_realizado": gold.gold_realizado, "gold_mensal": gold.gold_mensal}


def _by_month(df: DataFrame) -> DataFrame:
    """``df`` with the partition columns of its month."""
    if set(MONTH) <= set(df.columns):
        return df
    return df.withColumns({"ano": F.year("data_lancamento"), "mes": F.month("data_lancamento")})


@dataclass
class Change:
    """What a late file did: the ledger's months that it touched, and the months rewritten of every table."""
    touched: list[tuple[int, int]]
    rewritten: dict[str, list[tuple]]
    silver: KeptSilver


def _reader(sv: KeptSilver, version: dict | None = None) -> KeptSilver:
    """The same tables as of ``version`` (the newest by default)."""
    return KeptSilver(sv.spark, sv.stg, sv.cfg, sv.store.root, version or sv.store.latest())


def read(sv: KeptSilver, name: str) -> DataFrame:
    """A gold table of the newest version."""
    latest = sv.store.latest()
    return sv.store.read(name, latest).select(*latest["notes"]["gold"][name])


def build(sv: KeptSilver, tables: Sequence[str] | None = None) -> KeptSilver:
    """Write the gold tables of ``sv``, by month."""
    sv.load()
    written, columns = {}, {}
    for name, make in {**OF_MONTH, **ACROSS}.items():
        if tables is None or name in tables:
            df = make(sv)
            columns[name] = df.columns
            written[name] = sv.store.write(name, _by_month(df), MONTH)
    sv.store.publish(written, {"gold": columns})
    return _reader(sv)


def _same_row(a: str, b: str):
    return F.struct(*[F.col(f"{a}.{c}") for c in LEDGER]).eqNullSafe(F.struct(*[F.col(f"{b}.{c}") for c in LEDGER]))


def _months(df: DataFrame) -> list[tuple]:
    """The months of ``df`` on the driver: as many as the calendar has."""
    return sorted((r["ano"], r["mes"]) for r in df.select(*MONTH).distinct().collect())


def _digests(df: DataFrame) -> DataFrame:
    """One row per month: the number of rows and the sum of their hashes."""
    return df.groupBy(*MONTH).agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64(*df.columns).cast("decimal(38,0)")).alias("h"))


def _changed(old: DataFrame, new: DataFrame) -> list[tuple]:
    """Months whose rows differ."""
    a, b = _digests(old).alias("a"), _digests(new).alias("b")
    on = F.col("a.ano").eqNullSafe(F.col("b.ano")) & F.col("a.mes").eqNullSafe(F.col("b.mes"))
    both = a.join(b, on, "full_outer").filter(~(F.col("a.n").eqNullSafe(F.col("b.n")) & F.col("a.h").eqNullSafe(F.col("b.h"))))
    found = both.select(*[F.when(F.col("b.n").isNull(), F.col(f"a.{c}")).otherwise(F.col(f"b.{c}")).alias(c) for c in MONTH])
    return sorted(((r["ano"], r["mes"]) for r in found.collect()), key=str)


def add_entries(sv: KeptSilver, late: DataFrame) -> Change:
    """Load the raw ledger rows ``late`` into the kept tables of ``sv`` and publish them.

    ``late`` is small beside the ledger: its ids are broadcast, if a count proves that they fit, to find rows with the
    same ids in the ledger's id column. A second writer's version in between raises ``Conflict``; nothing has
    changed then. Empty and wholly rejected files touch no month.
    """
    store: Snapshots = sv.store
    base = store.latest()
    now = _reader(sv, base)
    fresh = plan.Silver(sv.spark, {**dict(sv.stg), "stg_lancamentos": late}, sv.cfg).replace(**{d: getattr(now, d) for d in DIMENSIONS})
    flagged = fresh.ledger_flagged.withColumn(rules.RULES_COL, rules.broken(plan.ledger_rules(sv.cfg))).select(*LEDGER, rules.RULES_COL)
    landed_as = store.write("landed_late", flagged)
    landed = store.read("late", {"tables": {"late": landed_as}})
    valid = landed.filter(F.size(rules.RULES_COL) == 0).select(*LEDGER)

    # rows with one id meet: the smallest stays, as in a full load
    known = now.fact_lancamentos.join(bounded(valid.select(_ID).distinct()), _ID, "left_semi").select(*LEDGER)
    first, repeats = rules.keep_first(known.unionByName(valid), [_ID], f"{_ID}_unique")
    first, known = first.checkpoint(), known.checkpoint()
    same = (F.col(f"a.{_ID}") == F.col(f"b.{_ID}")) & _same_row("a", "b")
    new = first.alias("a").join(known.alias("b"), same, "left_anti")
    gone = known.alias("a").join(first.alias("b"), same, "left_anti")
    touched = _months(_by_month(new.unionByName(gone)))

    tables = {"rejects_lancamentos": store.append("rejects_lancamentos", landed.filter(F.size(rules.RULES_COL) > 0).unionByName(repeats), base)}
    rewritten: dict[str, list[tuple]] = {}
    notes = dict(base["notes"]["ledger"])

    def draft() -> dict:
        return {**base, "tables": {**base["tables"], **tables}, "notes": {**base["notes"], "ledger": notes}}

    if touched:
        old = store.read("fact_lancamentos", base).filter(Snapshots.among(MONTH, touched)).select(*LEDGER)
        months = old.join(gone.select(_ID), _ID, "left_anti").select(*LEDGER).unionByName(new)
        tables["fact_lancamentos"] = store.replace("fact_lancamentos", _by_month(months), touched, base)
        notes.update(_span(store.read("fact_lancamentos", draft()), new, gone, notes))
        part = _reader(sv, draft())
        fact = store.read("fact_lancamentos", draft()).filter(Snapshots.among(MONTH, touched)).select(*LEDGER)
        daily = grid.daily_totals(fact, "data_lancamento", plan.MEMBER, "valor", "total_do_dia")
        tables["member_months"] = store.replace("member_months", steps.member_months(daily, "data_lancamento", plan.MEMBER, "total_do_dia"), touched, base)
        booked = store.read("member_months", draft()).filter(Snapshots.among(MONTH, touched))
        tables["median_ranges"] = store.replace("median_ranges", plan.median_ranges(booked), touched, base)
        rewritten.update({t: touched for t in ("fact_lancamentos", "member_months", "median_ranges")})
        for name, make in OF_MONTH.items():
            if name in base["tables"]:
                tables[name] = store.replace(name, _by_month(make(part.replace(fact_lancamentos=fact))), touched, base)
                rewritten[name] = touched
        whole = _reader(sv, draft())
        for name, make in ACROSS.items():
            if name in base["tables"]:
                made = _by_month(make(whole)).checkpoint()
                months_ = _changed(store.read(name, base), made)
                if months_:
                    tables[name] = store.replace(name, made.filter(Snapshots.among(MONTH, months_)), months_, base)
                    rewritten[name] = months_
    store.publish(tables, {"ledger": notes}, base=base)
    store.discard(landed_as)
    return Change(touched, rewritten, _reader(sv))


def _span(fact: DataFrame, new: DataFrame, gone: DataFrame, notes: dict) -> dict:
    """First and last day and number of rows after the change; only a row that left makes it look at the whole date column."""
    ends = [F.min("data_lancamento").cast("string"), F.max("data_lancamento").cast("string"), F.count(F.lit(1))]
    lost = gone.count()
    if lost:
        first, last, n = fact.agg(*ends).first()
        return {"first": first, "last": last, "rows": n}
    first, last, n = new.agg(*ends).first()
    known = lambda pick, *days: pick((d for d in days if d is not None), default=None)
    return {"first": known(min, notes["first"], first), "last": known(max, notes["last"], last), "rows": notes["rows"] + n}
