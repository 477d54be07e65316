"""Silver layer: typed, cleansed star schema built from the six staging
tables (dimensions first, then facts; all come back as valid + rejects).

Keys are enforced on load: every dimension and fact holds one row per
non-null key, categories belong to a known cost centre, and rows that break
a rule, repeats included, are kept apart as rejects. ``Silver`` plans all of
this lazily from staging; ``plans.load`` does it once and keeps the tables,
and that is what queries read.
"""

from __future__ import annotations

import copy
import datetime as dt
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlight import schemas as S
from ledgerlight.operators import calendar as cal
from ledgerlight.functions.safe import nullif
from ledgerlight.operators import cleanse, grid, median_state, rules, steps
from ledgerlight.operators.joins import BROADCAST_BYTES, check_all, with_missing
from ledgerlight.plans.config import Config

#: The keys of a member of the daily grid; the benchmark's columns and what they are medians of.
MEMBER = ["id_centro_custo", "id_categoria"]
BENCHMARK_VALUES = {"peso_do_dia": "perc_gasto_mes", "valor_mediano_dia": "gasto_mtd"}


def share_of_month() -> Column:
    """The running total's share of the whole month (NULL for a month without spend)."""
    return F.try_divide(F.col("gasto_mtd").cast("double"), nullif(F.col("total_do_mes"), 0).cast("double"))


def median_ranges(months: DataFrame) -> DataFrame:
    """The benchmark's state of the booked ``months``: counted value ranges by month, grain and day."""
    return median_state.month_ranges(steps.steps(months, MEMBER).withColumn("perc_gasto_mes", share_of_month()), MEMBER, BENCHMARK_VALUES)


# ---------------------------------------------------------------- dimensions
def dim_camp_marketing(stg: DataFrame) -> DataFrame:
    """Campaigns (typed)."""
    return stg.select(F.col("id_camp").try_cast("int").alias("id_camp"),
                      F.col("nome_camp").alias("nome_campanha"),
                      F.col("mes_ref").try_cast("int").alias("mes_referente"))


def dim_centro_custo(stg: DataFrame) -> DataFrame:
    """Cost centres with sentence-case names."""
    return cleanse.sentence_case_names(stg, ["nome_cc"]).select(F.col("id_cc").try_cast("int").alias("id_cc"), "nome_cc")


def dim_categoria(stg: DataFrame) -> DataFrame:
    """Categories: float-text keys to int (null keys become rejects)."""
    d = cleanse.float_keys_to_int(stg, ["id_cat", "id_cc"])
    return d.select(F.col("id_cat").alias("id_categoria"), "id_cc", F.col("nome_cat").alias("nome_categoria"))


def dim_fornecedores(stg: DataFrame) -> DataFrame:
    return stg.select(F.col("id_forn").try_cast("int").alias("id_forn"), "nome_forn")


# --------------------------------------------------------------------- facts
def vw_lancamentos(stg: DataFrame, dim_cc: DataFrame) -> DataFrame:
    """Typed ledger view: null dates dropped, unknown cost centre -> -1,
    float-text campaign key, abs value + original, status normalised."""
    df = stg.filter(F.col("data_lancamento").isNotNull())
    df = df.select(
        F.col("id_lancamento").try_cast("long").alias("id_lancamento"),
        F.col("data_lancamento").try_cast("date").alias("data_lancamento"),
        F.col("id_centro_custo").try_cast("int").alias("id_centro_custo"),
        F.col("id_categoria").try_cast("int").alias("id_categoria"),
        F.col("id_fornecedor").try_cast("int").alias("id_fornecedor"),
        F.col("id_campanha_marketing").try_cast("double").try_cast("int").alias("id_campanha"),
        F.col("valor_lancamento").try_cast(S.MONEY_LEDGER).alias("valor"),
        "status_pagamento",
    )
    df = cleanse.rekey_unknown(df, "id_centro_custo", dim_cc, "id_cc")
    df = cleanse.sign_repair(df, "valor", "valor", "valor_original")
    df = cleanse.normalise_category(df, "status_pagamento")
    return df.select([f.name for f in S.FACT_LANCAMENTOS.fields])


def vw_orcamento(stg: DataFrame) -> DataFrame:
    """Typed budget with month-end date and the outlier flag."""
    df = stg.select(
        F.col("id_orcamento").try_cast("int").alias("id_orcamento"),
        F.col("ano").try_cast("int").alias("ano"),
        F.col("mes").try_cast("int").alias("mes"),
        F.col("id_centro_custo").try_cast("int").alias("id_centro_custo"),
        F.col("id_categoria").try_cast("int").alias("id_categoria"),
        F.col("valor_orcado").try_cast(S.MONEY_BUDGET).alias("valor"),
    )
    df = cleanse.month_end_anchor(df, "ano", "mes", "data_orcamento")
    once, _ = rules.keep_first(df, ["id_orcamento"])         # a repeated id counts once in the means
    df = cleanse.outlier_flag(df, "valor", ["id_centro_custo", "id_categoria"], "status_dado", over=once)
    return df.select([f.name for f in S.FACT_ORCAMENTO.fields])


def _fk_flags(df: DataFrame, fks: dict[str, tuple[str, DataFrame, str]]) -> DataFrame:
    """Attach one boolean per FK: parent found (or child key NULL)."""
    out = df
    for name, (ck, parent, pk) in fks.items():
        out = with_missing(out, ck, parent, pk, f"__fk_{name}").withColumn(f"__fk_{name}", ~F.col(f"__fk_{name}"))
    return out


def dimension_split(dim: DataFrame, key: str, parent: tuple[str, DataFrame, str] | None = None) -> tuple[DataFrame, DataFrame]:
    """R1/R2 of a dimension: (one row per non-null key, rejects). ``parent`` =
    (column, table, key) adds a foreign-key rule whose column is not null."""
    checks = rules.not_null(key)
    flagged = dim
    if parent:
        column, table, pk = parent
        flagged = _fk_flags(dim, {column: (column, table, pk)})
        checks |= rules.not_null(column) | {f"fk_{column}": F.col(f"__fk_{column}")}
    valid, broken = rules.split(flagged, checks)
    kept, repeats = rules.keep_first(valid.select(*dim.columns), [key], f"{key}_unique")
    return kept, broken.select(*dim.columns, rules.RULES_COL).unionByName(repeats)


def ledger_rules(cfg: Config) -> dict:
    c = F.col
    r = rules.not_null("id_lancamento", "data_lancamento", "id_centro_custo", "id_categoria",
                       "id_fornecedor", "valor", "valor_original", "status_pagamento")
    r["data_lancamento_range"] = (c("data_lancamento") > F.lit(cfg.ledger_min_date)) & \
        (c("data_lancamento") <= F.lit(cfg.load_date))
    r["valor_positive"] = c("valor") > 0
    r["status_domain"] = c("status_pagamento").isin(S.STATUS_PAID, S.STATUS_OPEN)
    for fk in ("centro_custo", "categoria", "fornecedor", "campanha"):
        r[f"fk_{fk}"] = c(f"__fk_{fk}")
    return r


def budget_rules(cfg: Config) -> dict:
    c = F.col
    r = rules.not_null("id_orcamento", "data_orcamento", "ano", "mes", "id_centro_custo",
                       "id_categoria", "valor", "status_dado")
    r["data_orcamento_range"] = c("data_orcamento").between(F.lit(cfg.calendar_start), F.lit(cfg.calendar_end))
    r["ano_range"] = (c("ano") >= cfg.budget_min_year) & (c("ano") <= cfg.load_date.year)
    r["mes_range"] = c("mes").between(1, 12)
    r["valor_positive"] = c("valor") > 0
    r["status_domain"] = c("status_dado").isin(S.BUDGET_SUSPECT, S.BUDGET_TRUSTED)
    for fk in ("centro_custo", "categoria"):
        r[f"fk_{fk}"] = c(f"__fk_{fk}")
    return r


def calendar_rules(cfg: Config) -> dict:
    """R2 for the daily calendar (the day check tests ``dia``, the column it means)."""
    c = F.col
    r = rules.not_null("data", "dia_da_semana", "ano", "mes", "dia", "nome_do_mes", "mes_ano", "ano_mes")
    r["data_range"] = c("data").between(F.lit(cfg.calendar_start), F.lit(cfg.calendar_end))
    r["dia_util_domain"] = c("dia_util").isin(S.WORKDAY_YES, S.WORKDAY_NO)
    r["ano_range"] = c("ano").between(cfg.calendar_start.year, cfg.calendar_end.year)
    r["mes_range"] = c("mes").between(1, 12)
    r["dia_range"] = c("dia").between(1, 31)
    r["semestre_domain"] = c("semestre").isin(1, 2)
    r["trimestre_domain"] = c("trimestre").isin(1, 2, 3, 4)
    r["bimestre_domain"] = c("bimestre").isin(1, 2, 3, 4, 5, 6)
    return r


def month_rules(cfg: Config) -> dict:
    """R2 for the month dimension."""
    c = F.col
    r = rules.not_null("ano_mes", "ano", "mes", "primeiro_dia", "ultimo_dia")
    r["ano_range"] = c("ano").between(cfg.calendar_start.year, cfg.calendar_end.year)
    r["mes_range"] = c("mes").between(1, 12)
    r["primeiro_dia_is_first"] = F.dayofmonth("primeiro_dia") == 1
    r["ultimo_dia_is_month_end"] = F.dayofmonth("ultimo_dia").between(28, 31)
    return r


def _load(flagged: DataFrame, checks: dict, schema, key: str) -> tuple[DataFrame, DataFrame]:
    """(rows that break no rule, one per key; rejects with the rules they break)."""
    columns = [f.name for f in schema.fields]
    valid, broken = rules.split(flagged, checks)
    kept, repeats = rules.keep_first(valid.select(*columns), [key], f"{key}_unique")
    return kept, broken.select(*columns, rules.RULES_COL).unionByName(repeats)


class Silver:
    """The silver tables of one run, built lazily: a query that only needs
    the ledger never plans (or checks) the budget, and vice versa."""

    def __init__(self, spark: SparkSession, stg: dict[str, DataFrame], cfg: Config):
        self.spark, self.stg, self.cfg = spark, stg, cfg
        self.replaced: frozenset[str] = frozenset()

    def replace(self, **tables: DataFrame) -> "Silver":
        """A copy with some tables substituted (e.g. a sliced ledger)."""
        out = copy.copy(self)
        out.__dict__ = dict(self.__dict__)
        out.__dict__.update(tables)
        if "fact_lancamentos" in tables:        # what is derived from the ledger follows it
            for name in ("calendar_span", "dim_calendario", "dim_mes", "median_ranges", "member_months", "members", "month_steps"):
                if name not in tables:
                    out.__dict__.pop(name, None)
        out.replaced = self.replaced | frozenset(tables)
        return out

    @cached_property
    def _splits(self) -> dict[str, tuple[DataFrame, DataFrame]]:
        centres, bad = dimension_split(dim_centro_custo(self.stg["stg_dim_centro_custo"]), "id_cc")
        centres = cleanse.add_default_member(centres, "id_cc", "nome_cc")
        return {
            "dim_centro_custo": (centres, bad),
            "dim_camp_marketing": dimension_split(dim_camp_marketing(self.stg["stg_dim_campanha"]), "id_camp"),
            "dim_categoria": dimension_split(dim_categoria(self.stg["stg_dim_categoria"]), "id_categoria", ("id_cc", centres, "id_cc")),
            "dim_fornecedores": dimension_split(dim_fornecedores(self.stg["stg_dim_fornecedores"]), "id_forn"),
        }

    @cached_property
    def dim_camp_marketing(self) -> DataFrame:
        return self._splits["dim_camp_marketing"][0]

    @cached_property
    def dim_centro_custo(self) -> DataFrame:
        """With the unknown member."""
        return self._splits["dim_centro_custo"][0]

    @cached_property
    def dim_categoria(self) -> DataFrame:
        return self._splits["dim_categoria"][0]

    @cached_property
    def dim_fornecedores(self) -> DataFrame:
        return self._splits["dim_fornecedores"][0]

    def dimension_rejects(self, name: str) -> DataFrame:
        """Rows of a dimension's staging table that are not loaded, with the rules they break."""
        return self._splits[name][1]

    @cached_property
    def calendar_span(self) -> DataFrame:
        """One row: first and last day of the years that the ledger covers (no row leaves the calendar)."""
        return cal.covering_years(self.fact_lancamentos, "data_lancamento")

    @cached_property
    def dim_calendario(self) -> DataFrame:
        return cal.calendar_attributes(cal.days_of(self.calendar_span))

    def calendar_side(self, df: DataFrame) -> DataFrame:
        """A projection of the calendar as a broadcast join side: the ledger rules bound its days by
        (load_date - ledger_min_date), and that bound is checked."""
        days = (self.cfg.load_date - self.cfg.ledger_min_date).days + 366
        return F.broadcast(df) if days * 256 <= BROADCAST_BYTES else df

    @cached_property
    def dim_mes(self) -> DataFrame:
        return cal.dim_mes(self.dim_calendario)

    @cached_property
    def vw_lancamentos(self) -> DataFrame:
        check_all({"cc": (self.dim_centro_custo, "id_cc"), "cat": (self.dim_categoria, "id_categoria"),
                   "forn": (self.dim_fornecedores, "id_forn"), "camp": (self.dim_camp_marketing, "id_camp")})
        return vw_lancamentos(self.stg["stg_lancamentos"], self.dim_centro_custo)

    @cached_property
    def vw_orcamento(self) -> DataFrame:
        return vw_orcamento(self.stg["stg_orcamento"])

    @property
    def ledger_rows(self) -> DataFrame:
        """All rows of the ledger view, rejects included."""
        return self.vw_lancamentos

    @property
    def budget_rows(self) -> DataFrame:
        """All rows of the budget view, rejects included."""
        return self.vw_orcamento

    @cached_property
    def ledger_flagged(self) -> DataFrame:
        """The ledger view with one flag per foreign key (the input of the ledger rules)."""
        return _fk_flags(self.vw_lancamentos, {
            "centro_custo": ("id_centro_custo", self.dim_centro_custo, "id_cc"),
            "categoria": ("id_categoria", self.dim_categoria, "id_categoria"),
            "fornecedor": ("id_fornecedor", self.dim_fornecedores, "id_forn"),
            "campanha": ("id_campanha", self.dim_camp_marketing, "id_camp")})

    @cached_property
    def _ledger_split(self) -> tuple[DataFrame, DataFrame]:
        return _load(self.ledger_flagged, ledger_rules(self.cfg), S.FACT_LANCAMENTOS, "id_lancamento")

    @cached_property
    def budget_flagged(self) -> DataFrame:
        check_all({"cc": (self.dim_centro_custo, "id_cc"), "cat": (self.dim_categoria, "id_categoria")})
        return _fk_flags(self.vw_orcamento, {
            "centro_custo": ("id_centro_custo", self.dim_centro_custo, "id_cc"),
            "categoria": ("id_categoria", self.dim_categoria, "id_categoria")})

    @cached_property
    def _budget_split(self) -> tuple[DataFrame, DataFrame]:
        return _load(self.budget_flagged, budget_rules(self.cfg), S.FACT_ORCAMENTO, "id_orcamento")

    @cached_property
    def fact_lancamentos(self) -> DataFrame:
        return self._ledger_split[0]

    def entries_between(self, start: dt.date, end: dt.date) -> DataFrame:
        """The ledger from ``start`` to ``end``, both included."""
        return self.fact_lancamentos.filter(F.col("data_lancamento").between(F.lit(start), F.lit(end)))

    @cached_property
    def member_months(self) -> DataFrame:
        """The booked days of every month of a (cost centre, category), as one row."""
        daily = grid.daily_totals(self.fact_lancamentos, "data_lancamento", MEMBER, "valor", "total_do_dia")
        return steps.member_months(daily, "data_lancamento", MEMBER, "total_do_dia")

    @property
    def monthly_totals(self) -> DataFrame:
        """A2: SUM(valor) by month, cost centre and category, from the booked days."""
        total = F.aggregate(steps.BOOKED, F.lit(0).cast("decimal(38,2)"), lambda a, x: (a + x["valor"]).cast("decimal(38,2)"))
        return self.member_months.select("ano", "mes", "id_centro_custo", "id_categoria", total.alias("realizado"))

    @cached_property
    def members(self) -> DataFrame:
        """The (cost centre, category) pairs that have entries."""
        return self.member_months.select("id_centro_custo", "id_categoria").distinct()

    @cached_property
    def month_steps(self) -> DataFrame:
        """The daily grid of running month totals in step form."""
        return steps.steps(self.member_months, MEMBER)

    @cached_property
    def median_ranges(self) -> DataFrame:
        """What medians of the grid are found by, at the grains that put members together."""
        return median_ranges(self.member_months)

    @cached_property
    def rejects_lancamentos(self) -> DataFrame:
        return self._ledger_split[1]

    @cached_property
    def fact_orcamento(self) -> DataFrame:
        return self._budget_split[0]

    @cached_property
    def rejects_orcamento(self) -> DataFrame:
        return self._budget_split[1]

    def tables(self) -> dict[str, DataFrame]:
        return {k: getattr(self, k) for k in (
            "dim_camp_marketing", "dim_centro_custo", "dim_categoria", "dim_fornecedores",
            "dim_calendario", "fact_lancamentos", "fact_orcamento")}


def build(spark: SparkSession, stg: dict[str, DataFrame], cfg: Config) -> Silver:
    return Silver(spark, stg, cfg)
