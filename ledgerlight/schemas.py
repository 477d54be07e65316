"""Declared schemas and fixed values.

Bronze (staging) tables are all-text; silver tables are typed. Columns bind
by position at ingest, so the staging schemas below carry the staging
names, not the CSV header names.
"""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values that must equal the reference's for identical results.
# ---------------------------------------------------------------------------
DEFAULT_MEMBER_ID = -1
DEFAULT_MEMBER_NAME = "Não identificado"
ALL_MEMBERS = -999                      # "all cost centres" / "all categories"
STATUS_PAID = "Pago"
STATUS_OPEN = "Aberto"
STATUS_OTHER = "Outros"
STATUS_PENDING = "Pendente"             # display name of STATUS_OPEN in gold
PAID_SPELLINGS = ("PAGO", "Paga", "Pago")
OPEN_SPELLINGS = ("Pending", "Aberto")
BUDGET_SUSPECT = "Dado suspeito"
BUDGET_TRUSTED = "Dado confiavel"
SUSPECT_RATIO_MINUS_ONE = 9             # value / group mean - 1 > 9
ATYPICAL = "Valor_atipico"
NORMAL = "Valor_normal"
ABOVE_NORMAL = "Valor_acima_do_normal"
BELOW_NORMAL = "Valor_abaixo_do_normal"
ATYPICAL_HIGH_FACTOR = 2.0
ATYPICAL_LOW_FACTOR = 0.5
FLAG_YES = "Sim"
FLAG_NO = "Nao"
WORKDAY_YES = "sim"
WORKDAY_NO = "nao"
MISSING_LABEL = "Sem Informação"
# Portuguese calendar names, Sunday first / January first.
WEEKDAY_NAMES = ("Domingo", "Segunda-feira", "Terça-feira", "Quarta-feira",
                 "Quinta-feira", "Sexta-feira", "Sábado")
MONTH_NAMES = ("Janeiro", "Fevereiro", "Março", "Abril", "Maio", "Junho",
               "Julho", "Agosto", "Setembro", "Outubro", "Novembro", "Dezembro")
MONTH_ABBREVIATIONS = ("jan", "fev", "mar", "abr", "mai", "jun",
                       "jul", "ago", "set", "out", "nov", "dez")
# Deviation bands of value / mean - 1 (first match wins; (0.2, 1) is not covered).
DEVIATION_BANDS = (
    ("1. 1000%+", 10.0, None),
    ("2. 900~1000%", 9.0, 10.0),
    ("3. 100~900%", 1.0, 9.0),
    ("4. 10 ~ 20%", 0.1, 0.2),
    ("5. 0 ~ 10%", 0.0, 0.1),
    ("6. -10~0%", -0.1, 0.0),
    ("7. -20~-10%", -0.2, -0.1),
    ("8. -30~-20%", -0.3, -0.2),
    ("9. -30%-", None, -0.3),
)
# Risk light and pace labels of the dashboard measures.
RISK_RED = "Vermelho"
RISK_AMBER = "Laranja"
RISK_GREEN = "Verde"
PACE_OVER = "Tende a Estourar"
PACE_ON = "Dentro do Esperado"
PACE_UNDER = "Abaixo do Ritmo"

MONEY_LEDGER = T.DecimalType(16, 2)
MONEY_BUDGET = T.DecimalType(18, 2)


def text_schema(*names: str) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType(), True) for n in names])


# Staging (bronze) layouts, in file column order.
STG_LANCAMENTOS = text_schema(
    "id_lancamento", "data_lancamento", "id_centro_custo", "id_categoria",
    "id_fornecedor", "id_campanha_marketing", "valor_lancamento", "status_pagamento")
STG_ORCAMENTO = text_schema(
    "id_orcamento", "ano", "mes", "id_centro_custo", "id_categoria", "valor_orcado")
STG_CENTRO_CUSTO = text_schema("id_cc", "nome_cc")
STG_CATEGORIA = text_schema("id_cat", "id_cc", "nome_cat")
STG_FORNECEDORES = text_schema("id_forn", "nome_forn")
STG_CAMPANHA = text_schema("id_camp", "nome_camp", "mes_ref")

STAGING_SCHEMAS = {
    "stg_lancamentos": STG_LANCAMENTOS,
    "stg_orcamento": STG_ORCAMENTO,
    "stg_dim_centro_custo": STG_CENTRO_CUSTO,
    "stg_dim_categoria": STG_CATEGORIA,
    "stg_dim_fornecedores": STG_FORNECEDORES,
    "stg_dim_campanha": STG_CAMPANHA,
}

# Silver (typed) layouts.
DIM_CENTRO_CUSTO = T.StructType([
    T.StructField("id_cc", T.IntegerType(), False),
    T.StructField("nome_cc", T.StringType(), True)])
DIM_CATEGORIA = T.StructType([
    T.StructField("id_categoria", T.IntegerType(), False),
    T.StructField("id_cc", T.IntegerType(), True),
    T.StructField("nome_categoria", T.StringType(), True)])
DIM_FORNECEDORES = T.StructType([
    T.StructField("id_forn", T.IntegerType(), False),
    T.StructField("nome_forn", T.StringType(), True)])
DIM_CAMP_MARKETING = T.StructType([
    T.StructField("id_camp", T.IntegerType(), False),
    T.StructField("nome_campanha", T.StringType(), True),
    T.StructField("mes_referente", T.IntegerType(), True)])
FACT_LANCAMENTOS = T.StructType([
    T.StructField("id_lancamento", T.LongType(), False),
    T.StructField("data_lancamento", T.DateType(), False),
    T.StructField("id_centro_custo", T.IntegerType(), False),
    T.StructField("id_categoria", T.IntegerType(), False),
    T.StructField("id_fornecedor", T.IntegerType(), False),
    T.StructField("id_campanha", T.IntegerType(), True),
    T.StructField("valor", MONEY_LEDGER, False),
    T.StructField("valor_original", MONEY_LEDGER, False),
    T.StructField("status_pagamento", T.StringType(), False)])
FACT_ORCAMENTO = T.StructType([
    T.StructField("id_orcamento", T.IntegerType(), False),
    T.StructField("data_orcamento", T.DateType(), False),
    T.StructField("ano", T.IntegerType(), False),
    T.StructField("mes", T.IntegerType(), False),
    T.StructField("id_centro_custo", T.IntegerType(), False),
    T.StructField("id_categoria", T.IntegerType(), False),
    T.StructField("valor", MONEY_BUDGET, False),
    T.StructField("status_dado", T.StringType(), False)])

SILVER_SCHEMAS = {
    "dim_centro_custo": DIM_CENTRO_CUSTO,
    "dim_categoria": DIM_CATEGORIA,
    "dim_fornecedores": DIM_FORNECEDORES,
    "dim_camp_marketing": DIM_CAMP_MARKETING,
    "fact_lancamentos": FACT_LANCAMENTOS,
    "fact_orcamento": FACT_ORCAMENTO,
}
