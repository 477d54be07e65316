"""The whole medallion run: raw files -> profile -> silver -> gold.

  bronze   B1, B2: the six raw CSV files, read once and landed with their declared all-text layouts, the lines that
           do not have the declared fields beside them
  quality  Q17, B3: profile and line counts of every staging table, counted while it is landed (no scan)
  silver   S/R: typed dimensions and facts, rejects kept apart, written with
           idempotent full refreshes; facts partitioned by (ano, mes)
  gold     G1-G9 written from the persisted silver tables (lineage cut: gold
           jobs read parquet, not the staging plans)
  measures M1-M21 as of ``Config.as_of``, from silver and the persisted benchmark

Every write is an overwrite of its own folder, so re-running the pipeline
gives the same result (no truncate/drop ordering, no duplicate rows).
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlight import schemas as S
from ledgerlight.operators import audit, quality
from ledgerlight.plans import gold, measures
from ledgerlight.plans import silver as silver_plan
from ledgerlight.plans.config import Config
from ledgerlight.sources import files
from ledgerlight.sources.snapshots import Snapshots

RAW_FILES = {
    "stg_lancamentos": "fact_lancamentos",
    "stg_orcamento": "fact_orcamento",
    "stg_dim_centro_custo": "dim_centro_custo",
    "stg_dim_categoria": "dim_categoria",
    "stg_dim_fornecedores": "dim_fornecedores",
    "stg_dim_campanha": "dim_campanha_marketing",
}

FACT_PARTITIONS = {"fact_lancamentos": ["ano", "mes"], "fact_orcamento": ["ano"]}


REJECTED_LINES = "linhas_rejeitadas"


@dataclass
class Landed:
    """The landed staging tables, their profile and the lines that were left out."""
    tables: dict[str, DataFrame]
    profile: DataFrame
    rejected: DataFrame
    seen: dict[str, dict[str, int]]

    def counts(self) -> DataFrame:
        """B3 of the load: (tabela, total_registros, linhas_rejeitadas), as counted while landing."""
        spark = self.rejected.sparkSession
        rows = [(n, s[quality.ROWS], s[REJECTED_LINES]) for n, s in self.seen.items()]
        return spark.createDataFrame(rows, "tabela string, total_registros long, linhas_rejeitadas long")


def land(spark: SparkSession, lines: dict[str, DataFrame], root: str) -> Landed:
    """Write the staging tables and profile them on the way.

    ``lines`` are frames of staging columns and, if read from files, the column of rejected lines. Each is read
    once: rows are landed as they are, and every rule of the profile is counted in the writing stage (observed
    metrics), so neither the profile nor the rejects nor silver read a raw file again. All tables become visible
    by one version."""
    store = Snapshots(spark, root)
    written = {}
    for name, df in lines.items():
        columns = [c for c in df.columns if c != files.REJECTED_LINE]
        if files.REJECTED_LINE not in df.columns:
            df = df.withColumn(files.REJECTED_LINE, F.lit(None).cast("string"))
        bad = F.col(files.REJECTED_LINE).isNotNull()
        written[name] = store.write(name, df, facts={**quality.profile_facts(columns, rows=~bad), REJECTED_LINES: F.count_if(bad)})
    version = files.publish(store, written)
    store.vacuum()
    tables, rejects = {}, []
    for name in lines:
        df = store.read(name, version)
        bad = F.col(files.REJECTED_LINE).isNotNull()
        tables[name] = df.filter(~bad).drop(files.REJECTED_LINE)
        rejects.append(df.filter(bad).select(F.lit(name).alias("tabela"), files.REJECTED_LINE))
    seen = {name: version["tables"][name]["seen"] for name in lines}
    return Landed(tables, quality.profile_of(spark, seen), reduce(DataFrame.unionByName, rejects), seen)


def raw_frames(spark: SparkSession, raw_dir: str) -> dict[str, DataFrame]:
    """All lines of the six raw files, for ``land``."""
    return {stg: files.raw_lines(spark, files.raw_path(spark, raw_dir, name), S.STAGING_SCHEMAS[stg]) for stg, name in RAW_FILES.items()}


@dataclass
class Result:
    silver: silver_plan.Silver
    counts: DataFrame
    paths: dict[str, str]
    landed: Landed


def _persist_silver(sv: silver_plan.Silver, out: str) -> dict[str, DataFrame]:
    written = {}
    tables = {**sv.tables(), "rejects_lancamentos": sv.rejects_lancamentos,
              "rejects_orcamento": sv.rejects_orcamento, "dim_mes": sv.dim_mes}
    for name, df in tables.items():
        part = FACT_PARTITIONS.get(name, [])
        if name == "fact_lancamentos":
            df = df.withColumn("ano", F.year("data_lancamento")).withColumn("mes", F.month("data_lancamento"))
        written[name] = files.full_refresh(df, f"{out}/silver/{name}", part)
        if name == "fact_lancamentos":
            written[name] = written[name].select([f.name for f in S.FACT_LANCAMENTOS.fields])
        elif name in S.SILVER_SCHEMAS:
            written[name] = written[name].select([f.name for f in S.SILVER_SCHEMAS[name].fields])
    return written


def run(spark: SparkSession, raw_dir: str, out_dir: str, cfg: Config,
        stg: dict[str, DataFrame] | None = None, with_measures: bool = True) -> Result:
    """Run bronze -> quality -> silver -> gold (-> measures); ``stg`` may
    replace the CSV ingest."""
    out = out_dir.rstrip("/")
    landed = land(spark, raw_frames(spark, raw_dir) if stg is None else stg, f"{out}/bronze")
    files.full_refresh(landed.profile, f"{out}/quality/profile")
    files.full_refresh(landed.counts(), f"{out}/quality/contagens")
    files.full_refresh(landed.rejected, f"{out}/quality/linhas_rejeitadas")
    built = silver_plan.build(spark, landed.tables, cfg)
    persisted = _persist_silver(built, out)
    sv = built.replace(**{k: v for k, v in persisted.items() if k in built.tables() or k.startswith("rejects")})
    views = {
        "gold_orcamento": gold.gold_orcamento(sv),
        "gold_realizado": gold.gold_realizado(sv),
        "gold_lancamentos": gold.gold_lancamentos(sv),
        "gold_referencia_mtd": gold.gold_referencia_mtd(sv, cfg),
        "gold_lancamentos_diarios": gold.gold_lancamentos_diarios(sv),
        "gold_lancamentos_consolidados_dia": gold.gold_lancamentos_consolidados_dia(sv),
        "gold_mensal": gold.gold_mensal(sv),
    }
    paths = {}
    for name, df in views.items():
        paths[name] = f"{out}/gold/{name}"
        files.full_refresh(df, paths[name])
    if with_measures:
        ref = files.read_table(spark, paths["gold_referencia_mtd"])      # persisted benchmark, read once
        for name, df in measure_reports(sv, cfg, ref).items():
            paths[name] = f"{out}/measures/{name}"
            files.full_refresh(df, paths[name])
    counts = audit.audit_counts(sv.tables())
    return Result(sv, counts, paths, landed)


def measure_reports(sv: silver_plan.Silver, cfg: Config, ref: DataFrame) -> dict[str, DataFrame]:
    """M1-M21 as of ``cfg.as_of`` (the benchmark ``ref`` is the G4 view)."""
    m = measures
    return {
        "m01_kpis": m.kpis_by_cost_centre(sv, cfg), "m02_consumo": m.consumption(sv, cfg),
        "m03_orcado_ideal": m.ideal_budget_mtd(sv, cfg, ref), "m04_proj_linear": m.linear_projection(sv, cfg),
        "m05_proj_historica": m.historical_projection(sv, cfg, ref),
        "m06_proj_caminho": m.projection_path(sv, cfg, ref), "m07_semaforo": m.risk_matrix(sv, cfg),
        "m08_ritmo": m.pace(sv, cfg, ref), "m09_top_risco": m.top_risk(sv, cfg),
        "m09_top_estouro": m.top_projected_overrun(sv, cfg, ref), "m10_top_fornecedores_geral": m.top_suppliers(sv, cfg),
        "m01_empresa": m.company_cards(sv, cfg),
        "m10_top_categorias": m.top_categories(sv, cfg), "m10_top_fornecedores": m.top_suppliers_per_category(sv, cfg),
        "m11_top_crescimento": m.top_growth(sv, cfg), "m12_pendentes": m.pending_payables(sv, cfg),
        "m13_diario": m.daily_cumulative(sv, cfg), "m14_kpis_anuais": m.annual_kpis(sv, cfg),
        "m15_mensal": m.monthly_variance(sv), "m16_matriz": m.variance_matrix(sv, cfg),
        "m17_yoy_mensal": m.yoy_monthly(sv, cfg), "m18_ytd_vs_ly": m.ytd_vs_last_year(sv, cfg),
        "m19_crescimento": m.growth_table(sv, cfg), "m20_resultado_previsto": m.forecast_vs_budget(sv, cfg, ref),
        "m21_ritmo_diario": m.pace_table(sv, cfg, ref),
    }
