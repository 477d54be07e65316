"""Registered profiling (Q), rule (R) and source/sink (B) operators."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlight import schemas as S
from ledgerlight.functions.safe import money
from ledgerlight.operators import audit, quality, rules
from ledgerlight.operators.joins import with_scalars
from ledgerlight.plans import gold
from ledgerlight.plans import silver as silver_plan
from ledgerlight.plans.config import TESTDATA as CFG
from ledgerlight.plans.oracle_sql import q, sentence
from ledgerlight.plans.queries_gold import view_ctes
from ledgerlight.plans.registry import register, silver, staging
from ledgerlight.session import input_bytes
from ledgerlight.sources import files, testdata

#: Bytes of the given tables per landed file.
LANDED_BYTES = 64 << 20

STG_COLUMNS = {name: [f.name for f in st.fields] for name, st in S.STAGING_SCHEMAS.items()}

SQL_PRED = {
    quality.RULE_EXTRA_SPACE: "coalesce(length({c}) > length(trim({c})), false)",
    quality.RULE_NULL_OR_EMPTY: "({c} IS NULL OR length(rtrim({c})) = 0)",
}


def _sql_report(rules_: list[str], with_rows: bool = False) -> str:
    parts = []
    for t, cols in STG_COLUMNS.items():
        if with_rows:
            parts.append(f"SELECT '{t}' AS tabela, '*' AS coluna, 'linhas' AS regra, CAST(COUNT(*) AS BIGINT) AS qtd FROM {t}")
        for r in rules_:
            for c in cols:
                pred = SQL_PRED[r].format(c=c)
                parts.append(f"SELECT '{t}' AS tabela, '{c}' AS coluna, '{r}' AS regra, "
                             f"CAST(COUNT(*) FILTER (WHERE {pred}) AS BIGINT) AS qtd FROM {t}")
    return "\nUNION ALL\n".join(parts)


def _report(spark, sf_dir, rule_names, with_rows=False):
    stg = staging(spark, sf_dir)
    out = None
    for t, cols in STG_COLUMNS.items():
        p = quality.profile(stg[t], t, cols, {r: quality.STANDARD_RULES[r] for r in rule_names})
        if not with_rows:
            p = p.filter(F.col("regra") != "linhas")
        out = p if out is None else out.unionByName(p)
    return out


# ------------------------------------------------------------------ Q1, Q2, Q17
@register("q1", q(_sql_report([quality.RULE_EXTRA_SPACE])))
def q1(spark, sf_dir):
    return _report(spark, sf_dir, [quality.RULE_EXTRA_SPACE])


_LEADING_SQL = "\nUNION ALL\n".join(
    f"SELECT '{t}' AS tabela, '{c}' AS coluna, CAST(COUNT(*) FILTER (WHERE length(rtrim({c})) > length(trim({c}))) "
    f"AS BIGINT) AS qtd FROM {t}" for t, cols in STG_COLUMNS.items() for c in cols)


@register("q1l", q(_LEADING_SQL))
def q1l(spark, sf_dir):
    """Q1 as the reference's length function counts it: trailing blanks are
    ignored, so only leading blanks are found."""
    stg = staging(spark, sf_dir)
    out = None
    for t, cols in STG_COLUMNS.items():
        w = quality.extra_space_counts(stg[t], cols, leading_only=True)
        p = w.select(F.explode(F.array(*[F.struct(F.lit(c).alias("coluna"), F.col(c).alias("qtd")) for c in cols]))
                     .alias("__p")).select(F.lit(t).alias("tabela"), "__p.coluna", "__p.qtd")
        out = p if out is None else out.unionByName(p)
    return out


@register("q2", q(_sql_report([quality.RULE_NULL_OR_EMPTY])))
def q2(spark, sf_dir):
    return _report(spark, sf_dir, [quality.RULE_NULL_OR_EMPTY])


@register("q17", q(_sql_report([quality.RULE_EXTRA_SPACE, quality.RULE_NULL_OR_EMPTY], with_rows=True)))
def q17(spark, sf_dir):
    return _report(spark, sf_dir, [quality.RULE_EXTRA_SPACE, quality.RULE_NULL_OR_EMPTY], with_rows=True)


# ------------------------------------------------------------------ Q3 .. Q16
@register("q3", q("SELECT * FROM stg_lancamentos WHERE data_lancamento IS NULL OR id_fornecedor IS NULL"))
def q3(spark, sf_dir):
    return quality.offending_rows(staging(spark, sf_dir)["stg_lancamentos"], ["data_lancamento", "id_fornecedor"])


PK_COLUMNS = {"stg_lancamentos": "id_lancamento", "stg_orcamento": "id_orcamento",
              "stg_dim_centro_custo": "id_cc", "stg_dim_categoria": "id_cat",
              "stg_dim_fornecedores": "id_forn", "stg_dim_campanha": "id_camp"}


@register("q4", q("\nUNION ALL\n".join(
    f"SELECT '{t}' AS tabela, {k} AS chave, COUNT({k}) AS contagem FROM {t} GROUP BY {k} HAVING COUNT({k}) > 1"
    for t, k in PK_COLUMNS.items())))
def q4(spark, sf_dir):
    """Primary-key duplicates of every staging table (NULL keys never reported)."""
    stg = staging(spark, sf_dir)
    out = None
    for t, k in PK_COLUMNS.items():
        d = quality.duplicate_keys(stg[t], k).select(F.lit(t).alias("tabela"), "chave", "contagem")
        out = d if out is None else out.unionByName(d)
    return out


NAME_COLUMNS = {"stg_dim_centro_custo": "nome_cc", "stg_dim_categoria": "nome_cat",
                "stg_dim_fornecedores": "nome_forn", "stg_dim_campanha": "nome_camp"}


@register("q5", q("\nUNION ALL\n".join(
    f"SELECT '{t}' AS tabela, lower(trim({c})) AS nome, COUNT(*) AS contagem FROM {t} WHERE {c} IS NOT NULL GROUP BY 2 HAVING COUNT(*) > 1"
    for t, c in NAME_COLUMNS.items())))
def q5(spark, sf_dir):
    """Repeated names of all four dimensions."""
    stg = staging(spark, sf_dir)
    out = [quality.duplicate_names(stg[t], c).select(F.lit(t).alias("tabela"), "nome", "contagem") for t, c in NAME_COLUMNS.items()]
    return reduce(DataFrame.unionByName, out)


@register("q6", q(f"""
SELECT * FROM stg_dim_centro_custo WHERE length(trim(nome_cc)) > 3 AND trim(nome_cc) <> {sentence('nome_cc')}
"""))
def q6(spark, sf_dir):
    return quality.not_sentence_case(staging(spark, sf_dir)["stg_dim_centro_custo"], "nome_cc")


@register("q7", q("""
SELECT * FROM stg_dim_categoria WHERE length(trim(nome_cat)) > 3 AND trim(nome_cat) = upper(trim(nome_cat))
"""))
def q7(spark, sf_dir):
    return quality.all_upper(staging(spark, sf_dir)["stg_dim_categoria"], "nome_cat")


@register("q8", q(f"""
SELECT 'mes' AS coluna,
       CAST(COUNT(*) FILTER (WHERE TRY_CAST(mes AS INTEGER) IS NOT NULL AND TRY_CAST(mes AS INTEGER) NOT BETWEEN 1 AND 12) AS BIGINT) AS fora_do_intervalo,
       CAST(COUNT(*) FILTER (WHERE mes IS NOT NULL AND TRY_CAST(mes AS INTEGER) IS NULL) AS BIGINT) AS nao_numerico
FROM stg_orcamento
UNION ALL
SELECT 'ano',
       CAST(COUNT(*) FILTER (WHERE TRY_CAST(ano AS INTEGER) IS NOT NULL
                             AND TRY_CAST(ano AS INTEGER) NOT BETWEEN {CFG.budget_min_year} AND 1999) AS BIGINT),
       CAST(COUNT(*) FILTER (WHERE ano IS NOT NULL AND TRY_CAST(ano AS INTEGER) IS NULL) AS BIGINT)
FROM stg_orcamento
UNION ALL
SELECT 'mes_ref',
       CAST(COUNT(*) FILTER (WHERE TRY_CAST(mes_ref AS INTEGER) IS NOT NULL AND TRY_CAST(mes_ref AS INTEGER) NOT BETWEEN 1 AND 12) AS BIGINT),
       CAST(COUNT(*) FILTER (WHERE mes_ref IS NOT NULL AND TRY_CAST(mes_ref AS INTEGER) IS NULL) AS BIGINT)
FROM stg_dim_campanha
"""))
def q8(spark, sf_dir):
    o = staging(spark, sf_dir)["stg_orcamento"]
    # an analysed year range narrower than the data, so the check finds rows
    m = quality.out_of_range(o, "mes", 1, 12).select(F.lit("mes").alias("coluna"), "*")
    a = quality.out_of_range(o, "ano", CFG.budget_min_year, 1999).select(F.lit("ano").alias("coluna"), "*")
    c = quality.out_of_range(staging(spark, sf_dir)["stg_dim_campanha"], "mes_ref", 1, 12) \
               .select(F.lit("mes_ref").alias("coluna"), "*")
    return m.unionByName(a).unionByName(c)


@register("q9", q("""
SELECT 'stg_dim_categoria' AS tabela, 'id_cat' AS coluna, CAST(COUNT(*) FILTER (WHERE id_cat LIKE '%.%') AS BIGINT) AS qtd FROM stg_dim_categoria
UNION ALL SELECT 'stg_dim_categoria', 'id_cc', CAST(COUNT(*) FILTER (WHERE id_cc LIKE '%.%') AS BIGINT) FROM stg_dim_categoria
UNION ALL SELECT 'stg_lancamentos', 'id_campanha_marketing',
                 CAST(COUNT(*) FILTER (WHERE id_campanha_marketing LIKE '%.%') AS BIGINT) FROM stg_lancamentos
"""))
def q9(spark, sf_dir):
    stg = staging(spark, sf_dir)
    a = quality.decimal_point_keys(stg["stg_dim_categoria"], ["id_cat", "id_cc"])
    b = quality.decimal_point_keys(stg["stg_lancamentos"], ["id_campanha_marketing"])
    a = a.unpivot([], ["id_cat", "id_cc"], "coluna", "qtd").select(F.lit("stg_dim_categoria").alias("tabela"), "*")
    b = b.unpivot([], ["id_campanha_marketing"], "coluna", "qtd").select(F.lit("stg_lancamentos").alias("tabela"), "*")
    return a.unionByName(b)


FK_SQL = """
SELECT 'id_centro_custo' AS coluna, CAST(COUNT(*) AS BIGINT) AS qtd FROM stg_lancamentos
WHERE TRY_CAST(id_centro_custo AS INTEGER) NOT IN (SELECT id_cc FROM dim_centro_custo)
UNION ALL SELECT 'id_categoria', CAST(COUNT(*) AS BIGINT) FROM stg_lancamentos
WHERE TRY_CAST(id_categoria AS INTEGER) NOT IN (SELECT id_categoria FROM dim_categoria)
UNION ALL SELECT 'id_fornecedor', CAST(COUNT(*) AS BIGINT) FROM stg_lancamentos
WHERE TRY_CAST(id_fornecedor AS INTEGER) NOT IN (SELECT id_forn FROM dim_fornecedores)
UNION ALL SELECT 'id_campanha', CAST(COUNT(*) AS BIGINT) FROM stg_lancamentos
WHERE CAST(TRUNC(TRY_CAST(id_campanha_marketing AS DOUBLE)) AS INTEGER) NOT IN (SELECT id_camp FROM dim_camp_marketing)
"""


# The profiling runs on staging BEFORE the default member exists.
# Keys that are no numbers are rejects of the dimension; with them, NOT IN would report nothing at all.
Q10_PREFIX = ", dim_cc_raw AS (SELECT id_cc FROM centre_rows WHERE id_cc IS NOT NULL)\n"


def _raw_centres(spark, sf_dir):
    return silver_plan.dim_centro_custo(staging(spark, sf_dir)["stg_dim_centro_custo"]).filter(F.col("id_cc").isNotNull())


FK_SQL_RAW = FK_SQL.replace("SELECT id_cc FROM dim_centro_custo", "SELECT id_cc FROM dim_cc_raw", 1)


@register("q10", q(Q10_PREFIX + FK_SQL_RAW))
def q10(spark, sf_dir):
    stg = staging(spark, sf_dir)["stg_lancamentos"]
    sv = silver(spark, sf_dir)
    dim_cc = _raw_centres(spark, sf_dir)
    return quality.fk_violations(stg, {
        "id_centro_custo": (F.col("id_centro_custo").try_cast("int"), dim_cc, "id_cc"),
        "id_categoria": (F.col("id_categoria").try_cast("int"), sv.dim_categoria, "id_categoria"),
        "id_fornecedor": (F.col("id_fornecedor").try_cast("int"), sv.dim_fornecedores, "id_forn"),
        "id_campanha": (F.col("id_campanha_marketing").try_cast("double").try_cast("int"),
                        sv.dim_camp_marketing, "id_camp"),
    })


@register("q11", q(Q10_PREFIX + """
SELECT DISTINCT TRY_CAST(id_centro_custo AS INTEGER) AS chave FROM stg_lancamentos
WHERE TRY_CAST(id_centro_custo AS INTEGER) NOT IN (SELECT id_cc FROM dim_cc_raw)
"""))
def q11(spark, sf_dir):
    stg = staging(spark, sf_dir)
    dim_cc = _raw_centres(spark, sf_dir)
    return quality.orphan_keys(stg["stg_lancamentos"], F.col("id_centro_custo").try_cast("int"), dim_cc, "id_cc")


@register("q12", q(Q10_PREFIX + """
, typed AS (SELECT *, TRY_CAST(valor_lancamento AS DECIMAL(18,2)) AS v FROM stg_lancamentos)
SELECT 'data_nula' AS defeito, CAST(SUM(v) AS DOUBLE) AS valor_total,
       CAST(COALESCE(SUM(v) FILTER (WHERE data_lancamento IS NULL), 0) AS DOUBLE) AS valor_defeito,
       round(CAST(COALESCE(SUM(v) FILTER (WHERE data_lancamento IS NULL), 0) AS DOUBLE) / CAST(SUM(v) AS DOUBLE), 6) AS impacto
FROM typed
UNION ALL
SELECT 'centro_custo_invalido', CAST(SUM(v) AS DOUBLE),
       CAST(COALESCE(SUM(v) FILTER (WHERE TRY_CAST(id_centro_custo AS INTEGER) NOT IN (SELECT id_cc FROM dim_cc_raw)), 0) AS DOUBLE),
       round(CAST(COALESCE(SUM(v) FILTER (WHERE TRY_CAST(id_centro_custo AS INTEGER) NOT IN (SELECT id_cc FROM dim_cc_raw)), 0) AS DOUBLE)
             / CAST(SUM(v) AS DOUBLE), 6)
FROM typed
"""))
def q12(spark, sf_dir):
    stg = staging(spark, sf_dir)
    fl = stg["stg_lancamentos"].withColumn("__v", F.col("valor_lancamento").try_cast("decimal(18,2)"))
    a = quality.financial_impact(fl, F.col("__v"), F.col("data_lancamento").isNull())
    dim_cc = _raw_centres(spark, sf_dir)
    from ledgerlight.operators.joins import bounded
    keys = bounded(dim_cc.select(F.col("id_cc").alias("__pk")).distinct())
    ck = F.col("id_centro_custo").try_cast("int")
    flk = fl.join(keys, ck == F.col("__pk"), "left")
    b = quality.financial_impact(flk, F.col("__v"), ck.isNotNull() & F.col("__pk").isNull())
    return a.select(F.lit("data_nula").alias("defeito"), "*") \
            .unionByName(b.select(F.lit("centro_custo_invalido").alias("defeito"), "*"))


@register("q13", q("""
SELECT status_pagamento, COUNT(TRY_CAST(valor_lancamento AS DECIMAL(18,2))) AS qtd_registros,
       CAST(SUM(TRY_CAST(valor_lancamento AS DECIMAL(18,2))) AS DOUBLE) AS valor_por_status
FROM stg_lancamentos WHERE TRY_CAST(valor_lancamento AS DECIMAL(18,2)) < 0 GROUP BY status_pagamento
"""))
def q13(spark, sf_dir):
    fl = staging(spark, sf_dir)["stg_lancamentos"]
    return quality.negative_profile(fl, F.col("valor_lancamento").try_cast("decimal(18,2)"), "status_pagamento")


@register("q13b", q("""
SELECT CAST(COUNT(*) FILTER (WHERE TRY_CAST(valor_orcado AS DOUBLE) < 0) AS BIGINT) AS valores_negativos
FROM stg_orcamento
"""))
def q13b(spark, sf_dir):
    """Q13, budget variant: a bare count of negative values."""
    o = staging(spark, sf_dir)["stg_orcamento"]
    return o.agg(F.count_if(F.col("valor_orcado").try_cast("double") < 0).alias("valores_negativos"))


@register("q14", q("SELECT DISTINCT status_pagamento FROM stg_lancamentos"))
def q14(spark, sf_dir):
    return quality.domain_values(staging(spark, sf_dir)["stg_lancamentos"], "status_pagamento")


#: Q15 as a join of the values to a table of edges; of several matching bands the first counts.
BANDS_SQL = """
, edges AS (
  SELECT * FROM (VALUES (1, '1. 1000%+', 10.0, false, NULL, false), (2, '2. 900~1000%', 9.0, true, 10.0, true), (3, '3. 100~900%', 1.0, true, 9.0, true),
    (4, '4. 10 ~ 20%', 0.1, true, 0.2, true), (5, '5. 0 ~ 10%', 0.0, true, 0.1, true), (6, '6. -10~0%', -0.1, true, 0.0, true),
    (7, '7. -20~-10%', -0.2, true, -0.1, true), (8, '8. -30~-20%', -0.3, true, -0.2, true), (9, '9. -30%-', NULL, false, -0.3, false))
  e(ordem, faixa_nome, de, com_de, ate, com_ate)),
cells AS (SELECT rowid_ AS cell, id_centro_custo, id_categoria, v FROM (
  SELECT row_number() OVER () AS rowid_, id_centro_custo, id_categoria, TRY_CAST(valor_orcado AS DECIMAL(18,2)) AS v FROM stg_orcamento)),
averages AS (SELECT id_centro_custo, id_categoria, CAST(SUM(v) AS DOUBLE) / COUNT(v) AS media FROM cells GROUP BY ALL),
away AS (SELECT cell, v, CAST(v AS DOUBLE) / nullif(media, 0) - 1 AS r FROM cells JOIN averages USING (id_centro_custo, id_categoria)),
hits AS (
  SELECT a.cell, any_value(a.v) AS v, min(e.ordem) AS ordem
  FROM away a JOIN edges e
    ON (e.de IS NULL OR a.r > CAST(e.de AS DOUBLE) OR e.com_de AND a.r = CAST(e.de AS DOUBLE))
   AND (e.ate IS NULL OR a.r < CAST(e.ate AS DOUBLE) OR e.com_ate AND a.r = CAST(e.ate AS DOUBLE))
  GROUP BY a.cell)
SELECT e.faixa_nome, CAST(coalesce(SUM(h.v), 0) AS DOUBLE) AS valor_concentrado, COUNT(h.cell) AS registros
FROM edges e LEFT JOIN hits h USING (ordem) GROUP BY ALL
"""


def _bands(spark, sf_dir):
    o = staging(spark, sf_dir)["stg_orcamento"]
    return quality.deviation_bands(o, F.col("valor_orcado").try_cast("decimal(18,2)"),
                                   ["id_centro_custo", "id_categoria"])


register("q15", q(BANDS_SQL))(_bands)
register("j7", q(BANDS_SQL))(_bands)      # J7 is the band join inside Q15


def _as_lines(table: str, df: DataFrame) -> DataFrame:
    """Every row of a table as one line, so that tables with different columns can be listed together."""
    cells = [F.coalesce(F.col(c).cast("string"), F.lit("<nulo>")) for c in df.columns]
    return df.select(F.lit(table).alias("tabela"), F.concat_ws("|", *cells).alias("linha"))


LINES_SQL = "\nUNION ALL\n".join(
    f"SELECT '{t}' AS tabela, concat_ws('|', " + ", ".join(f"coalesce({c}, '<nulo>')" for c in cols) + f") AS linha FROM {t}"
    for t, cols in STG_COLUMNS.items())


@register("q16", q(LINES_SQL))
def q16(spark, sf_dir):
    """Overview of all six staging tables."""
    return reduce(DataFrame.unionByName, [_as_lines(t, df) for t, df in staging(spark, sf_dir).items()])


# ------------------------------------------------------------------ R1 .. R4
#: Views before the keys are enforced, and their keys.
KEYED_SQL = {"campaign_rows": ("dim_camp_marketing", "id_camp"), "centre_rows": ("dim_centro_custo", "id_cc"),
             "category_rows": ("dim_categoria", "id_categoria"),
             "(SELECT TRY_CAST(id_forn AS INTEGER) AS id_forn FROM stg_dim_fornecedores)": ("dim_fornecedores", "id_forn"),
             "dim_calendario": ("dim_calendario", "data"),
             "(SELECT DISTINCT ano_mes FROM dim_calendario)": ("dim_mes", "ano_mes"),
             "vw_lancamentos": ("fact_lancamentos", "id_lancamento"), "vw_orcamento": ("fact_orcamento", "id_orcamento")}


@register("r1", q("\nUNION ALL\n".join(
    f"SELECT '{t}' AS tabela, CAST({k} AS VARCHAR) AS chave, COUNT(*) AS contagem FROM {v} GROUP BY {k} HAVING COUNT(*) > 1 OR {k} IS NULL"
    for v, (t, k) in KEYED_SQL.items())))
def r1(spark, sf_dir):
    """Repeated and NULL primary keys of all eight tables, before the load keeps one row of each.

    The facts' views are not planned from staging again: what was loaded and what was rejected are all their rows."""
    sv, stg = silver(spark, sf_dir), staging(spark, sf_dir)
    views = {"dim_camp_marketing": silver_plan.dim_camp_marketing(stg["stg_dim_campanha"]),
             "dim_centro_custo": silver_plan.dim_centro_custo(stg["stg_dim_centro_custo"]),
             "dim_categoria": silver_plan.dim_categoria(stg["stg_dim_categoria"]),
             "dim_fornecedores": silver_plan.dim_fornecedores(stg["stg_dim_fornecedores"]),
             "dim_calendario": sv.dim_calendario, "dim_mes": sv.dim_mes,
             "fact_lancamentos": sv.ledger_rows, "fact_orcamento": sv.budget_rows}
    keys = dict(KEYED_SQL.values())
    return reduce(DataFrame.unionByName, [
        rules.uniqueness_violations(v, [keys[t]]).select(F.lit(t).alias("tabela"), F.col(keys[t]).cast("string").alias("chave"), "contagem")
        for t, v in views.items()])


LEDGER_RULES_SQL = [
    ("id_lancamento_not_null", "id_lancamento IS NOT NULL"),
    ("data_lancamento_not_null", "data_lancamento IS NOT NULL"),
    ("id_centro_custo_not_null", "id_centro_custo IS NOT NULL"),
    ("id_categoria_not_null", "id_categoria IS NOT NULL"),
    ("id_fornecedor_not_null", "id_fornecedor IS NOT NULL"),
    ("valor_not_null", "valor IS NOT NULL"),
    ("valor_original_not_null", "valor_original IS NOT NULL"),
    ("status_pagamento_not_null", "status_pagamento IS NOT NULL"),
    ("data_lancamento_range", f"data_lancamento > DATE '{CFG.ledger_min_date}' AND data_lancamento <= DATE '{CFG.load_date}'"),
    ("valor_positive", "valor > 0"),
    ("status_domain", "status_pagamento IN ('Pago', 'Aberto')"),
    ("fk_centro_custo", "id_centro_custo IS NULL OR id_centro_custo IN (SELECT id_cc FROM dim_centro_custo)"),
    ("fk_categoria", "id_categoria IS NULL OR id_categoria IN (SELECT id_categoria FROM dim_categoria)"),
    ("fk_fornecedor", "id_fornecedor IS NULL OR id_fornecedor IN (SELECT id_forn FROM dim_fornecedores)"),
    ("fk_campanha", "id_campanha IS NULL OR id_campanha IN (SELECT id_camp FROM dim_camp_marketing)"),
]
_BROKEN = ", ".join(f"CASE WHEN NOT coalesce({c}, true) THEN '{n}' END" for n, c in LEDGER_RULES_SQL)


_LEDGER_ORDER = ("data_lancamento, id_centro_custo, id_categoria, id_fornecedor, id_campanha NULLS FIRST, valor, valor_original, status_pagamento")


@register("r2", q(f"""
, broken AS (SELECT id_lancamento, valor, concat_ws(',', {_BROKEN}) AS regras_violadas FROM vw_lancamentos)
SELECT id_lancamento, CAST(valor AS DOUBLE) AS valor, regras_violadas FROM broken WHERE regras_violadas <> ''
UNION ALL
SELECT id_lancamento, CAST(valor AS DOUBLE), 'id_lancamento_unique'
FROM (SELECT *, row_number() OVER (PARTITION BY id_lancamento ORDER BY {_LEDGER_ORDER}) AS nth FROM good_entries) WHERE nth > 1
"""))
def r2(spark, sf_dir):
    """Rejected ledger rows, repeats included."""
    sv = silver(spark, sf_dir)
    return sv.rejects_lancamentos.select("id_lancamento", money("valor").alias("valor"),
                                         F.concat_ws(",", rules.RULES_COL).alias(rules.RULES_COL))


BUDGET_RULES_SQL = [
    *[(f"{c}_not_null", f"{c} IS NOT NULL") for c in ("id_orcamento", "data_orcamento", "ano", "mes", "id_centro_custo", "id_categoria",
                                                      "valor", "status_dado")],
    ("data_orcamento_range", f"data_orcamento BETWEEN DATE '{CFG.calendar_start}' AND DATE '{CFG.calendar_end}'"),
    ("ano_range", f"ano >= {CFG.budget_min_year} AND ano <= {CFG.load_date.year}"),
    ("mes_range", "mes BETWEEN 1 AND 12"), ("valor_positive", "valor > 0"),
    ("status_domain", "status_dado IN ('Dado suspeito', 'Dado confiavel')"),
    ("fk_centro_custo", "id_centro_custo IS NULL OR id_centro_custo IN (SELECT id_cc FROM dim_centro_custo)"),
    ("fk_categoria", "id_categoria IS NULL OR id_categoria IN (SELECT id_categoria FROM dim_categoria)"),
]
_BUDGET_BROKEN = ", ".join(f"CASE WHEN NOT coalesce({c}, true) THEN '{n}' END" for n, c in BUDGET_RULES_SQL)


@register("r2b", q(f"""
, broken AS (SELECT id_orcamento, valor, concat_ws(',', {_BUDGET_BROKEN}) AS regras_violadas FROM vw_orcamento)
SELECT id_orcamento, CAST(valor AS DOUBLE) AS valor, regras_violadas FROM broken WHERE regras_violadas <> ''
UNION ALL
SELECT id_orcamento, CAST(valor AS DOUBLE), 'id_orcamento_unique'
FROM (SELECT *, row_number() OVER (PARTITION BY id_orcamento ORDER BY data_orcamento, ano, mes, id_centro_custo, id_categoria, valor, status_dado) AS nth
      FROM good_budget) WHERE nth > 1
"""))
def r2b(spark, sf_dir):
    """Rejected budget rows, repeats included."""
    return silver(spark, sf_dir).rejects_orcamento.select("id_orcamento", money("valor").alias("valor"),
                                                          F.concat_ws(",", rules.RULES_COL).alias(rules.RULES_COL))


@register("r2d", q("""
SELECT 'dim_centro_custo' AS tabela, CAST(id_cc AS VARCHAR) AS chave, nome_cc AS nome, 'id_cc_not_null' AS regras_violadas
FROM centre_rows WHERE id_cc IS NULL
UNION ALL
SELECT 'dim_centro_custo', CAST(id_cc AS VARCHAR), nome_cc, 'id_cc_unique'
FROM (SELECT *, row_number() OVER (PARTITION BY id_cc ORDER BY nome_cc) AS nth FROM centre_rows WHERE id_cc IS NOT NULL) WHERE nth > 1
UNION ALL
SELECT 'dim_categoria', CAST(id_categoria AS VARCHAR), nome_categoria,
       concat_ws(',', CASE WHEN id_categoria IS NULL THEN 'id_categoria_not_null' END, CASE WHEN id_cc IS NULL THEN 'id_cc_not_null' END,
                 CASE WHEN id_cc NOT IN (SELECT id_cc FROM dim_centro_custo) THEN 'fk_id_cc' END)
FROM category_rows WHERE id_categoria IS NULL OR id_cc IS NULL OR id_cc NOT IN (SELECT id_cc FROM dim_centro_custo)
UNION ALL
SELECT 'dim_fornecedores', id_forn, nome_forn, 'id_forn_unique'
FROM (SELECT *, row_number() OVER (PARTITION BY TRY_CAST(id_forn AS INTEGER) ORDER BY nome_forn) AS nth FROM stg_dim_fornecedores) WHERE nth > 1
"""))
def r2d(spark, sf_dir):
    """Rejected rows of the dimensions: keys that are NULL or no numbers, unknown cost centres, repeats."""
    sv = silver(spark, sf_dir)
    cols = {"dim_centro_custo": ("id_cc", "nome_cc"), "dim_categoria": ("id_categoria", "nome_categoria"),
            "dim_fornecedores": ("id_forn", "nome_forn"), "dim_camp_marketing": ("id_camp", "nome_campanha")}
    return reduce(DataFrame.unionByName, [
        sv.dimension_rejects(t).select(F.lit(t).alias("tabela"), F.col(k).cast("string").alias("chave"), F.col(n).alias("nome"),
                                       F.concat_ws(",", rules.RULES_COL).alias(rules.RULES_COL)) for t, (k, n) in cols.items()])


@register("r3", q("""
SELECT 'fact_orcamento.id_centro_custo' AS coluna, CAST(COUNT(*) AS BIGINT) AS qtd FROM vw_orcamento
WHERE id_centro_custo NOT IN (SELECT id_cc FROM dim_centro_custo)
UNION ALL SELECT 'fact_orcamento.id_categoria', CAST(COUNT(*) AS BIGINT) FROM vw_orcamento
WHERE id_categoria NOT IN (SELECT id_categoria FROM dim_categoria)
UNION ALL SELECT 'fact_lancamentos.id_fornecedor', CAST(COUNT(*) AS BIGINT) FROM vw_lancamentos
WHERE id_fornecedor NOT IN (SELECT id_forn FROM dim_fornecedores)
UNION ALL SELECT 'fact_lancamentos.id_campanha', CAST(COUNT(*) AS BIGINT) FROM vw_lancamentos
WHERE id_campanha NOT IN (SELECT id_camp FROM dim_camp_marketing)
UNION ALL SELECT 'dim_categoria.id_cc', CAST(COUNT(*) AS BIGINT) FROM dim_categoria
WHERE id_cc NOT IN (SELECT id_cc FROM dim_centro_custo)
"""))
def r3(spark, sf_dir):
    sv = silver(spark, sf_dir)
    a = quality.fk_violations(sv.vw_orcamento, {
        "fact_orcamento.id_centro_custo": ("id_centro_custo", sv.dim_centro_custo, "id_cc"),
        "fact_orcamento.id_categoria": ("id_categoria", sv.dim_categoria, "id_categoria")})
    b = quality.fk_violations(sv.vw_lancamentos, {
        "fact_lancamentos.id_fornecedor": ("id_fornecedor", sv.dim_fornecedores, "id_forn"),
        "fact_lancamentos.id_campanha": ("id_campanha", sv.dim_camp_marketing, "id_camp")})
    c = quality.fk_violations(sv.dim_categoria, {
        "dim_categoria.id_cc": ("id_cc", sv.dim_centro_custo, "id_cc")})
    return a.unionByName(b).unionByName(c)


@register("r4", q("\nUNION ALL\n".join(
    f"SELECT '{n}' AS regra, CAST(COUNT(*) FILTER (WHERE NOT coalesce({c}, true)) AS BIGINT) AS qtd FROM vw_lancamentos" for n, c in LEDGER_RULES_SQL)
    + """
UNION ALL
SELECT 'id_lancamento_unique', CAST(COUNT(*) - COUNT(DISTINCT id_lancamento) AS BIGINT) FROM good_entries
"""))
def r4(spark, sf_dir):
    """Load gate: the verdict per rule over everything that asks to be loaded (``rules.assert_rules`` raises on it)."""
    sv = silver(spark, sf_dir)
    checks = silver_plan.ledger_rules(CFG)
    valid, _ = rules.split(sv.ledger_flagged, checks)
    repeats = valid.agg((F.count("id_lancamento") - F.count_distinct("id_lancamento")).alias("qtd"))
    return rules.rule_counts(sv.ledger_flagged, checks).unionByName(repeats.select(F.lit("id_lancamento_unique").alias("regra"), "qtd"))


# ------------------------------------------------------------------ B
@register("b1", q(LINES_SQL))
def b1(spark, sf_dir):
    """All six raw tables landed as CSV text, then bulk-ingested with the
    declared all-text staging schemas: the round trip must be lossless."""
    base = files.scratch_path(spark, "bronze")
    out = []
    for t, df in staging(spark, sf_dir).items():
        files.write_csv(df, f"{base}/{t}")
        out.append(_as_lines(t, files.ingest_csv(spark, f"{base}/{t}", S.STAGING_SCHEMAS[t])))
    return files.taken_over(reduce(DataFrame.unionByName, out), base)


@register("b2", q("""
SELECT id_orcamento, data_orcamento, ano, mes, id_centro_custo, id_categoria, CAST(valor AS DOUBLE) AS valor, status_dado
FROM fact_orcamento
"""))
def b2(spark, sf_dir):
    """Full refresh twice (idempotent): the target holds one copy."""
    path = files.scratch_path(spark, "fact-orcamento")
    fo = silver(spark, sf_dir).fact_orcamento
    files.full_refresh(fo, path, ["ano"])
    out = files.full_refresh(fo, path, ["ano"])
    return files.taken_over(out.select(*[f.name for f in S.FACT_ORCAMENTO.fields]).withColumn("valor", money("valor")), path)


@register("b3", q("""
SELECT 'dim_camp_marketing' AS tabela, COUNT(*) AS total_registros FROM dim_camp_marketing
UNION ALL SELECT 'dim_centro_custo', COUNT(*) FROM dim_centro_custo
UNION ALL SELECT 'dim_categoria', COUNT(*) FROM dim_categoria
UNION ALL SELECT 'dim_fornecedores', COUNT(*) FROM dim_fornecedores
UNION ALL SELECT 'dim_calendario', COUNT(*) FROM dim_calendario
UNION ALL SELECT 'fact_lancamentos', COUNT(*) FROM fact_lancamentos
UNION ALL SELECT 'fact_orcamento', COUNT(*) FROM fact_orcamento
"""))
def b3(spark, sf_dir):
    return audit.audit_counts(silver(spark, sf_dir).tables())


#: Declared types of the staging columns, and of the generated calendar tables.
DECLARED = {
    "stg_lancamentos": {"id_lancamento": "bigint", "data_lancamento": "date", "id_centro_custo": "int", "id_categoria": "int", "id_fornecedor": "int",
                        "id_campanha_marketing": "double", "valor_lancamento": "decimal(16,2)"},
    "stg_orcamento": {"id_orcamento": "int", "ano": "int", "mes": "int", "id_centro_custo": "int", "id_categoria": "int", "valor_orcado": "decimal(18,2)"},
    "stg_dim_centro_custo": {"id_cc": "int"}, "stg_dim_categoria": {"id_cat": "double", "id_cc": "double"},
    "stg_dim_fornecedores": {"id_forn": "int"}, "stg_dim_campanha": {"id_camp": "int", "mes_ref": "int"},
    "dim_calendario": {"data": "date", "ano": "int", "mes": "int", "dia": "int", "ano_mes": "int", "semestre": "int", "trimestre": "int", "bimestre": "int"},
    "dim_mes": {"ano_mes": "int", "ano": "int", "mes": "int", "primeiro_dia": "date", "ultimo_dia": "date"},
}


@register("b4", q(", dim_mes AS (SELECT ano_mes, ano, mes, min(data) AS primeiro_dia, max(data) AS ultimo_dia FROM dim_calendario GROUP BY ALL)\n"
                  + "\nUNION ALL\n".join(
    f"SELECT '{t}' AS tabela, '{c}' AS coluna, '{k}' AS tipo, COUNT(*) AS linhas, "
    f"COUNT(*) FILTER (WHERE {c} IS NOT NULL AND TRY_CAST({c} AS {k}) IS NULL) AS nao_convertidos, COUNT(*) FILTER (WHERE {c} IS NULL) AS nulos FROM {t}"
    for t, cols in DECLARED.items() for c, k in cols.items())))
def b4(spark, sf_dir):
    """Schema audit on the data: values that do not cast to the declared types, and NULLs, of every table."""
    sv, stg = silver(spark, sf_dir), staging(spark, sf_dir)
    tables = {**stg, "dim_calendario": sv.dim_calendario, "dim_mes": sv.dim_mes}
    return reduce(DataFrame.unionByName, [audit.cast_audit(t, tables[t], types) for t, types in DECLARED.items()])


@register("b5", q("""
SELECT id_lancamento, data_lancamento, id_centro_custo, id_categoria, id_fornecedor, id_campanha,
       CAST(valor AS DOUBLE) AS valor, CAST(valor_original AS DOUBLE) AS valor_original, status_pagamento
FROM fact_lancamentos
"""))
def b5(spark, sf_dir):
    """Insert-select load of the ledger fact into a typed target partitioned by (ano, mes)."""
    path = files.scratch_path(spark, "fact-lancamentos")
    fl = silver(spark, sf_dir).fact_lancamentos
    part = fl.withColumn("ano", F.year("data_lancamento")).withColumn("mes", F.month("data_lancamento"))
    out = files.full_refresh(part, path, ["ano", "mes"])
    out = out.select(*[f.name for f in S.FACT_LANCAMENTOS.fields]) \
             .withColumn("valor", money("valor")).withColumn("valor_original", money("valor_original"))
    return files.taken_over(out, path)


@register("b7", q(view_ctes("g2") + """
SELECT ano, mes, id_centro_de_custo, id_categoria, realizado, realizado_ytd, flag_centro_custo_coringa FROM v_g2
"""))
def b7(spark, sf_dir):
    """Gold view published to SQL, then queried by name."""
    view = f"vw_gold_realizado_{abs(hash(sf_dir)) % 10**8}"
    files.publish_views({view: gold.gold_realizado(silver(spark, sf_dir))})
    return spark.sql(f"SELECT ano, mes, id_centro_de_custo, id_categoria, realizado, realizado_ytd, flag_centro_custo_coringa FROM {view}")




def _as_files(spark, sf_dir: str, raw: DataFrame, most: int) -> DataFrame:
    """``raw`` in several parts, each of about a block of the given tables; not more than ``most``, what one trigger
    takes, since of a repeated id the smallest row of its batch stays."""
    return raw.repartition(min(most, 4 + input_bytes(spark, testdata.source_paths(sf_dir)) // LANDED_BYTES))


@register("b1s", q("""
SELECT id_lancamento, data_lancamento, id_centro_custo, id_categoria, id_fornecedor, id_campanha,
       CAST(valor AS DOUBLE) AS valor, CAST(valor_original AS DOUBLE) AS valor_original, status_pagamento
FROM fact_lancamentos
"""))
def b1s(spark, sf_dir):
    """Raw ledger landed as several CSV files and ingested incrementally by a
    Structured Streaming query (availableNow): same rows as the batch load."""
    from ledgerlight.streaming import ledger_stream
    base = files.scratch_path(spark, "stream")
    landing = f"{base}/landing"
    files.write_csv(_as_files(spark, sf_dir, staging(spark, sf_dir)["stg_lancamentos"], ledger_stream.FILES_PER_TRIGGER), landing)
    sv = silver(spark, sf_dir)
    qry = ledger_stream.start_ingest(spark, landing, f"{base}/out", f"{base}/checkpoint", sv, CFG)
    qry.awaitTermination()
    out = ledger_stream.read_ingested(spark, f"{base}/out")
    out = out.select(*[f.name for f in S.FACT_LANCAMENTOS.fields]) \
             .withColumn("valor", money("valor")).withColumn("valor_original", money("valor_original"))
    return files.taken_over(out, base)


CAL_RULES_SQL = [
    ("data_not_null", "data IS NOT NULL"), ("dia_da_semana_not_null", "dia_da_semana IS NOT NULL"),
    ("ano_not_null", "ano IS NOT NULL"), ("mes_not_null", "mes IS NOT NULL"), ("dia_not_null", "dia IS NOT NULL"),
    ("nome_do_mes_not_null", "nome_do_mes IS NOT NULL"), ("mes_ano_not_null", "mes_ano IS NOT NULL"),
    ("ano_mes_not_null", "ano_mes IS NOT NULL"),
    ("data_range", f"data BETWEEN DATE '{CFG.calendar_start}' AND DATE '{CFG.calendar_end}'"),
    ("dia_util_domain", "dia_util IN ('sim', 'nao')"),
    ("ano_range", f"ano BETWEEN {CFG.calendar_start.year} AND {CFG.calendar_end.year}"),
    ("mes_range", "mes BETWEEN 1 AND 12"), ("dia_range", "dia BETWEEN 1 AND 31"),
    ("semestre_domain", "semestre IN (1, 2)"), ("trimestre_domain", "trimestre IN (1, 2, 3, 4)"),
    ("bimestre_domain", "bimestre IN (1, 2, 3, 4, 5, 6)"),
]


@register("r2c", q("\nUNION ALL\n".join(
    f"SELECT '{n}' AS regra, CAST(COUNT(*) FILTER (WHERE NOT coalesce({c}, true)) AS BIGINT) AS qtd FROM dim_calendario"
    for n, c in CAL_RULES_SQL)))
def r2c(spark, sf_dir):
    """R2 on the calendar generated over the ledger's years: broken rows per rule."""
    return rules.rule_counts(silver(spark, sf_dir).dim_calendario, silver_plan.calendar_rules(CFG))


MONTH_RULES_SQL = [
    *[(f"{c}_not_null", f"{c} IS NOT NULL") for c in ("ano_mes", "ano", "mes", "primeiro_dia", "ultimo_dia")],
    ("ano_range", f"ano BETWEEN {CFG.calendar_start.year} AND {CFG.calendar_end.year}"), ("mes_range", "mes BETWEEN 1 AND 12"),
    ("primeiro_dia_is_first", "day(primeiro_dia) = 1"), ("ultimo_dia_is_month_end", "day(ultimo_dia) BETWEEN 28 AND 31"),
]


@register("r2m", q("""
, months AS (SELECT ano_mes, ano, mes, min(data) AS primeiro_dia, max(data) AS ultimo_dia FROM dim_calendario GROUP BY ALL)
""" + "\nUNION ALL\n".join(
    f"SELECT '{n}' AS regra, COUNT(*) AS linhas, CAST(COUNT(*) FILTER (WHERE NOT coalesce({c}, true)) AS BIGINT) AS qtd FROM months"
    for n, c in MONTH_RULES_SQL)))
def r2m(spark, sf_dir):
    """R2 on the month dimension: rows checked and broken per rule."""
    months = silver(spark, sf_dir).dim_mes
    checks = silver_plan.month_rules(CFG)
    n = months.agg(F.count(F.lit(1)).alias("linhas"))
    return with_scalars(rules.rule_counts(months, checks), n).select("regra", "linhas", "qtd")


@register("a3s", q("""
SELECT data_lancamento, id_centro_custo, id_categoria, CAST(SUM(valor) AS DOUBLE) AS total_do_dia
FROM fact_lancamentos GROUP BY 1, 2, 3
"""))
def a3s(spark, sf_dir):
    """A3 maintained by the streaming ingest over landed raw files."""
    from ledgerlight.streaming import ledger_stream
    base = files.scratch_path(spark, "stream-a3")
    landing = f"{base}/landing"
    files.write_csv(_as_files(spark, sf_dir, staging(spark, sf_dir)["stg_lancamentos"], ledger_stream.FILES_PER_TRIGGER), landing)
    qry = ledger_stream.start_daily_totals(spark, landing, f"{base}/out", f"{base}/checkpoint",
                                           silver(spark, sf_dir), CFG)
    qry.awaitTermination()
    out = ledger_stream.read_daily_totals(spark, f"{base}/out")
    return files.taken_over(out.select("data_lancamento", "id_centro_custo", "id_categoria", money("total_do_dia").alias("total_do_dia")), base)
