"""Load once, query many times: the silver tables as kept tables.

``KeptSilver`` is the ``Silver`` of a staging area whose tables were built,
checked and written before; queries scan them and neither join a dimension to
check a key nor sort the ledger by id. What is loaded together is published
together (``sources.snapshots``): the four dimensions, the ledger with its
rejects, the budget with its rejects; the booked days by month and the counts of the
benchmark by month, derived from the ledger, follow. Each group is loaded when it is
first asked for.

The ledger is read from staging once: typed rows with the rules that they
break are landed, and while they are written every rule is counted
(``DataFrame.observe``, no scan of its own). The kept fact and the rejects come
from the landed rows, which then go. Facts are partitioned by (ano, mes). The
version's notes hold what readers would have to look up: rows, bytes and
NULL keys of a dimension (the broadcast rule), first and last day of the ledger
(the calendar), broken rows by rule.
"""

from __future__ import annotations

import datetime as dt
import hashlib
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlight import schemas as S
from ledgerlight.operators import rules
from ledgerlight.operators.joins import remember, size_facts
from ledgerlight.plans import silver as plan
from ledgerlight.plans.config import Config
from ledgerlight.session import checkpoint_dir, file_system
from ledgerlight.sources.snapshots import Conflict, Snapshots

DIMENSIONS = {"dim_centro_custo": "id_cc", "dim_camp_marketing": "id_camp", "dim_categoria": "id_categoria", "dim_fornecedores": "id_forn"}
MONTH = ["ano", "mes"]


class KeptSilver(plan.Silver):
    """Silver tables under ``root``, loaded from ``stg`` when there is no version of them yet. ``version`` reads
    that version (it may not be published yet) instead of the newest."""

    def __init__(self, spark: SparkSession, stg, cfg: Config, root: str, version: dict | None = None) -> None:
        super().__init__(spark, stg, cfg)
        self.store, self.version = Snapshots(spark, root), version

    # ---------------------------------------------------------------- loading
    def _version(self, group: str, build) -> dict:
        """The version that holds ``group``; ``build`` writes its tables if none does yet."""
        found = self.version or self.store.latest()
        if group in found["notes"]:
            return found
        tables, notes = build()
        for _ in range(20):
            try:
                return self.store.publish(tables, {group: notes})
            except Conflict:                        # another driver published a group; ours is whole by itself
                found = self.store.latest()
                if group in found["notes"]:
                    return found
        raise Conflict(f"{group} could not be published")

    def _build_dimensions(self) -> tuple[dict, dict]:
        splits = plan.Silver(self.spark, self.stg, self.cfg)._splits
        tables = {name: self.store.write(name, splits[name][0], facts=size_facts(splits[name][0], key)) for name, key in DIMENSIONS.items()}
        return tables, {name: t["seen"] for name, t in tables.items()}

    def _load(self, name: str, flagged: DataFrame, checks: dict, schema, key: str, day: str, by_month) -> tuple[dict, dict]:
        """Land the rows with their broken rules, then write what stays (one row per key) and the rejects."""
        columns = [f.name for f in schema.fields]
        landed = flagged.withColumn(rules.RULES_COL, rules.broken(checks)).select(*columns, rules.RULES_COL)
        rows = self.store.write(f"landed_{name}", landed, facts={n: F.count_if(F.array_contains(rules.RULES_COL, n)) for n in checks})
        landed = self.store.read("landed", {"tables": {"landed": rows}})
        unique = f"{key}_unique"
        kept, repeats = rules.keep_first_of_few(landed.filter(F.size(rules.RULES_COL) == 0).select(*columns), [key], unique)
        fact = self.store.write(f"fact_{name}", by_month(kept), MONTH, facts={
            "rows": F.count(F.lit(1)), "first": F.min(day).cast("string"), "last": F.max(day).cast("string")})
        rejects = self.store.write(f"rejects_{name}", landed.filter(F.size(rules.RULES_COL) > 0).unionByName(repeats),
                                   facts={unique: F.count_if(F.array_contains(rules.RULES_COL, unique))})
        self.store.discard(rows)
        return ({f"fact_{name}": fact, f"rejects_{name}": rejects}, {**fact["seen"], "rules": {**rows["seen"], **rejects["seen"]}})

    def _build_ledger(self) -> tuple[dict, dict]:
        return self._load("lancamentos", self.ledger_flagged, plan.ledger_rules(self.cfg), S.FACT_LANCAMENTOS, "id_lancamento",
                          "data_lancamento", lambda df: df.withColumns({"ano": F.year("data_lancamento"), "mes": F.month("data_lancamento")}))

    def _build_budget(self) -> tuple[dict, dict]:
        return self._load("orcamento", self.budget_flagged, plan.budget_rules(self.cfg), S.FACT_ORCAMENTO, "id_orcamento",
                          "data_orcamento", lambda df: df)

    # --------------------------------------------------------------- reading
    @cached_property
    def _dimensions(self) -> dict[str, DataFrame]:
        version = self._version("dimensions", self._build_dimensions)
        out = {}
        for name, key in DIMENSIONS.items():
            out[name] = self.store.read(name, version)
            seen = version["notes"]["dimensions"][name]
            remember(out[name], seen["rows"], seen["size"], {key: seen["nulls"] > 0})
        return out

    @cached_property
    def _ledger(self) -> dict:
        return self._version("ledger", self._build_ledger)

    @cached_property
    def _budget(self) -> dict:
        return self._version("budget", self._build_budget)

    dim_centro_custo = cached_property(lambda self: self._dimensions["dim_centro_custo"])
    dim_camp_marketing = cached_property(lambda self: self._dimensions["dim_camp_marketing"])
    dim_categoria = cached_property(lambda self: self._dimensions["dim_categoria"])
    dim_fornecedores = cached_property(lambda self: self._dimensions["dim_fornecedores"])

    @cached_property
    def _ledger_by_month(self) -> DataFrame:
        return self.store.read("fact_lancamentos", self._ledger)

    @cached_property
    def fact_lancamentos(self) -> DataFrame:
        return self._ledger_by_month.select(*[f.name for f in S.FACT_LANCAMENTOS.fields])

    def entries_between(self, start: dt.date, end: dt.date) -> DataFrame:
        """The ledger from ``start`` to ``end``: only the folders of these months are read."""
        if "fact_lancamentos" in self.replaced:
            return super().entries_between(start, end)
        month = F.col("ano") * 12 + F.col("mes")
        inside = self._ledger_by_month.filter(month.between(start.year * 12 + start.month, end.year * 12 + end.month))
        return inside.select(*self.fact_lancamentos.columns).filter(F.col("data_lancamento").between(F.lit(start), F.lit(end)))

    @cached_property
    def member_months(self) -> DataFrame:
        """Kept too: what daily grids, medians and their measures read instead of the ledger."""
        if "fact_lancamentos" in self.replaced:
            return super().member_months
        version = self._version("months", lambda: ({"member_months": self.store.write("member_months", super(KeptSilver, self).member_months, MONTH)}, {}))
        return self.store.read("member_months", version)

    @cached_property
    def median_ranges(self) -> DataFrame:
        """Kept by month: benchmarks add the counts of the months that they look at."""
        if "fact_lancamentos" in self.replaced:
            return super().median_ranges
        version = self._version("ranges", lambda: ({"median_ranges": self.store.write("median_ranges", plan.median_ranges(self.member_months), MONTH)}, {}))
        return self.store.read("median_ranges", version)

    @cached_property
    def rejects_lancamentos(self) -> DataFrame:
        return self.store.read("rejects_lancamentos", self._ledger)

    @cached_property
    def fact_orcamento(self) -> DataFrame:
        return self.store.read("fact_orcamento", self._budget)

    @cached_property
    def rejects_orcamento(self) -> DataFrame:
        return self.store.read("rejects_orcamento", self._budget)

    @property
    def ledger_rows(self) -> DataFrame:
        """All rows of the ledger view: a load leaves each one either in the fact or among the rejects."""
        if "fact_lancamentos" in self.replaced:
            return super().ledger_rows
        return self.fact_lancamentos.unionByName(self.rejects_lancamentos.drop(rules.RULES_COL))

    @property
    def budget_rows(self) -> DataFrame:
        """All rows of the budget view, from the fact and the rejects."""
        if "fact_orcamento" in self.replaced:
            return super().budget_rows
        return self.fact_orcamento.unionByName(self.rejects_orcamento.drop(rules.RULES_COL))

    @cached_property
    def calendar_span(self) -> DataFrame:
        """First and last day of the ledger's years, from the notes of the load: no scan."""
        if "fact_lancamentos" in self.replaced:
            return super().calendar_span
        seen = self._ledger["notes"]["ledger"]
        days = [None, None] if seen["first"] is None else [dt.date(int(seen["first"][:4]), 1, 1), dt.date(int(seen["last"][:4]), 12, 31)]
        return self.spark.range(1).select(*[F.lit(d).cast("date").alias(n) for n, d in zip(("inicio", "fim"), days)])

    def rule_counts(self) -> DataFrame:
        """(regra, qtd): the rows that broke each rule when the ledger was loaded, from the notes of the load."""
        return self.spark.createDataFrame(list(self._ledger["notes"]["ledger"]["rules"].items()), "regra string, qtd long")

    def load(self) -> "KeptSilver":
        """Load everything now."""
        self._dimensions, self._ledger, self._budget, self.member_months, self.median_ranges
        return self


def _stamp(spark: SparkSession, paths: list[str]) -> list:
    """Sizes and times of the files at ``paths``: other input is loaded anew."""
    out = []
    for path in paths:
        fs, p = file_system(spark, path)
        if fs.exists(p):
            for s in fs.listStatus(p):
                out.append([s.getPath().getName(), s.getLen(), s.getModificationTime()])
    return out


def kept_root(spark: SparkSession, source: str, paths: list[str], cfg: Config) -> str:
    """The shared folder of what this application keeps of ``source`` (input files ``paths``) under ``cfg``."""
    mark = hashlib.sha256(repr((source, _stamp(spark, paths), cfg)).encode()).hexdigest()[:16]
    return f"{checkpoint_dir(spark).rstrip('/')}/ledgerlight-silver/{spark.sparkContext.applicationId}/{mark}"
