"""Publish the silver tables and gold views under the reference's view
names, so SQL written against them runs through ``spark.sql``.

Spark resolves identifiers case-insensitively by default, so 'gasto_MTD' or
'Orcado_YTD' already find our lower-case columns. With
``reference_names=True`` the few columns whose names differ by more than
letter case (a blank or an accent) also get the reference's spelling, as
do the columns of the cleansing views.

Registering is lazy except for what the gold operators measure up front
(largest groups, dimension sizes).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlight.plans import gold
from ledgerlight.plans.config import Config
from ledgerlight.plans.silver import Silver

# ---------------------------------------------------------------------------
# View and column names of the reference (API surface).
# ---------------------------------------------------------------------------
GOLD_VIEW_COLUMNS = {
    "vw_gold_realizado": {"realizado_ytd": "Realizado YTD", "media_mensal": "Média_mensal"},
    "vw_gold_lancamentos_consolidados_dia": {"participacao_no_mes": "Partipação no mês"},
}
CLEANSING_VIEW_COLUMNS = {
    "vw_campanhas": ("dim_camp_marketing", {"id_camp": "ID_camp", "nome_campanha": "nome_camp",
                                            "mes_referente": "mes_ref"}),
    "vw_centro_custo": ("dim_centro_custo", {"id_cc": "id_cc", "nome_cc": "nome_cc"}),
    "vw_categoria": ("dim_categoria", {"id_categoria": "id_cat", "id_cc": "id_cc", "nome_categoria": "nome_cat"}),
    "vw_fornecedores": ("dim_fornecedores", {"id_forn": "id_forn", "nome_forn": "nome_forn"}),
    "vw_lancamentos": ("vw_lancamentos", {"id_lancamento": "id_lancamento", "data_lancamento": "data_lancamento",
                                          "id_centro_custo": "id_cc", "id_categoria": "id_categoria",
                                          "id_fornecedor": "id_fornecedor", "id_campanha": "id_campanha",
                                          "valor": "valor_absoluto", "valor_original": "valor_original",
                                          "status_pagamento": "status_pagamento"}),
    "vw_orcamento": ("vw_orcamento", {"id_orcamento": "id_orcamento", "data_orcamento": "data", "ano": "ano",
                                      "mes": "mes", "id_centro_custo": "id_centro_custo",
                                      "id_categoria": "id_categoria", "valor": "valor_orcado",
                                      "status_dado": "status_dado"}),
}


def _rename(df: DataFrame, names: dict[str, str]) -> DataFrame:
    return df.select(*[F.col(c).alias(names.get(c, c)) for c in df.columns])


def gold_views(sv: Silver, cfg: Config) -> dict[str, DataFrame]:
    return {
        "vw_gold_orcamento": gold.gold_orcamento(sv),
        "vw_gold_realizado": gold.gold_realizado(sv),
        "vw_gold_lancamentos": gold.gold_lancamentos(sv),
        "vw_gold_referencia_mtd": gold.gold_referencia_mtd(sv, cfg),
        "vw_gold_lancamentos_diarios": gold.gold_lancamentos_diarios(sv),
        "vw_gold_lancamentos_consolidados_dia": gold.gold_lancamentos_consolidados_dia(sv),
        "vw_gold_mensal": gold.gold_mensal(sv),
    }


def register(spark: SparkSession, sv: Silver, cfg: Config, reference_names: bool = True,
             include_gold: bool = True) -> list[str]:
    """Create temp views: silver tables, cleansing views and (optionally) gold views."""
    views: dict[str, DataFrame] = dict(sv.tables())
    views["dim_mes"] = sv.dim_mes
    for name, (src, cols) in CLEANSING_VIEW_COLUMNS.items():
        df = getattr(sv, src)
        views[name] = _rename(df, cols) if reference_names else df
    if include_gold:
        for name, df in gold_views(sv, cfg).items():
            views[name] = _rename(df, GOLD_VIEW_COLUMNS.get(name, {})) if reference_names else df
    for name, df in views.items():
        df.createOrReplaceTempView(name)
    return sorted(views)
