"""Independent SQL statements of every registered query, for DuckDB.

The staging and silver layers are written once as CTEs (``PREFIX``) over the
driver's pre-registered tables; each query's oracle is that prefix plus its
own final SELECT. Parameters are those of ``plans.config.TESTDATA``.
"""

from __future__ import annotations

from ledgerlight.plans.config import TESTDATA as CFG

SEG = ("CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 101 WHEN 'BUILDING' THEN 102 "
       "WHEN 'FURNITURE' THEN 103 WHEN 'HOUSEHOLD' THEN 104 ELSE 105 END")


def sentence(x: str) -> str:
    return f"(upper(left(trim({x}), 1)) || lower(substr(trim({x}), 2)))"


def d(x) -> str:
    return f"DATE '{x.isoformat()}'"


STAGING = f"""
single_entries AS (
  SELECT CAST(o.o_orderkey AS VARCHAR) AS id_lancamento,
         CASE WHEN o.o_orderkey % 97 = 0 THEN NULL ELSE CAST(CAST(o.o_orderdate AS DATE) AS VARCHAR) END AS data_lancamento,
         CAST(c.c_nationkey AS VARCHAR) AS id_centro_custo,
         CAST({SEG} AS VARCHAR) AS id_categoria,
         CAST(s.l_suppkey AS VARCHAR) AS id_fornecedor,
         CASE WHEN o.o_orderpriority = '4-NOT SPECIFIED' THEN NULL ELSE left(o.o_orderpriority, 1) || '.0' END AS id_campanha_marketing,
         CAST(CAST(CASE WHEN o.o_orderkey % 89 = 0 THEN -o.o_totalprice ELSE o.o_totalprice END AS DECIMAL(16,2)) AS VARCHAR) AS valor_lancamento,
         CASE o.o_orderstatus
           WHEN 'F' THEN CASE o.o_orderkey % 3 WHEN 0 THEN 'PAGO' WHEN 1 THEN 'Paga' ELSE 'Pago' END
           WHEN 'P' THEN 'Pago'
           ELSE CASE o.o_orderkey % 2 WHEN 0 THEN 'Aberto' ELSE 'Pending' END END AS status_pagamento
  FROM orders o JOIN customer c ON c.c_custkey = o.o_custkey
  LEFT JOIN (SELECT l_orderkey, min(l_suppkey) AS l_suppkey FROM lineitem GROUP BY l_orderkey) s
         ON s.l_orderkey = o.o_orderkey),
stg_lancamentos AS (
  FROM single_entries
  UNION ALL
  SELECT * REPLACE (CAST(CAST(valor_lancamento AS DECIMAL(16,2)) + 1 AS VARCHAR) AS valor_lancamento)
  FROM single_entries WHERE CAST(id_lancamento AS BIGINT) % 101 = 0),
single_cells AS (
  SELECT CAST((ano * 12 + mes) * 10000 + cc * 100 + cat % 100 AS VARCHAR) AS id_orcamento,
         CAST(ano AS VARCHAR) AS ano, CAST(mes AS VARCHAR) AS mes,
         CAST(cc AS VARCHAR) AS id_centro_custo, CAST(cat AS VARCHAR) AS id_categoria,
         CAST(CAST(v * CASE WHEN (ano * 12 + mes + cc + cat) % 53 = 0 THEN 20 ELSE 1 END AS DECIMAL(18,2)) AS VARCHAR) AS valor_orcado
  FROM (SELECT CAST(year(l.l_shipdate) AS INTEGER) AS ano, CAST(month(l.l_shipdate) AS INTEGER) AS mes,
               c.c_nationkey AS cc, {SEG} AS cat, sum(CAST(l.l_extendedprice AS DECIMAL(16,2))) AS v
        FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey
        JOIN customer c ON c.c_custkey = o.o_custkey JOIN nation n ON n.n_nationkey = c.c_nationkey
        WHERE n.n_regionkey <> 4 GROUP BY 1, 2, 3, 4) t),
stg_orcamento AS (
  FROM single_cells
  UNION ALL
  SELECT * REPLACE (CAST(CAST(valor_orcado AS DECIMAL(18,2)) + 1 AS VARCHAR) AS valor_orcado) FROM single_cells
  WHERE (CAST(ano AS INTEGER) + CAST(mes AS INTEGER) + CAST(id_centro_custo AS INTEGER) + CAST(id_categoria AS INTEGER)) % 47 = 0),
stg_dim_centro_custo AS (
  SELECT CAST(n_nationkey AS VARCHAR) AS id_cc,
         CASE n_nationkey % 4 WHEN 0 THEN n_name WHEN 1 THEN ' ' || n_name WHEN 2 THEN n_name || ' '
              ELSE lower(n_name) END AS nome_cc
  FROM nation WHERE n_regionkey <> 4
  UNION ALL
  SELECT CASE WHEN n_nationkey % 5 = 0 THEN CAST(n_nationkey AS VARCHAR) ELSE 'CC' || n_nationkey END, n_name || ' bis'
  FROM nation WHERE n_regionkey <> 4 AND (n_nationkey % 5 = 0 OR n_nationkey % 11 = 1)),
stg_seg AS (SELECT DISTINCT c_mktsegment FROM customer),
stg_dim_categoria AS (
  SELECT CAST({SEG} AS VARCHAR) || '.0' AS id_cat,
         CAST(CASE WHEN {SEG} = 105 THEN 5 ELSE {SEG} - 101 END AS VARCHAR) || '.0' AS id_cc,
         {sentence('c_mktsegment')} AS nome_cat
  FROM stg_seg
  UNION ALL
  SELECT NULL, NULL, c_mktsegment FROM stg_seg WHERE c_mktsegment = 'BUILDING'),
stg_dim_fornecedores AS (
  SELECT CAST(s_suppkey AS VARCHAR) AS id_forn, s_name AS nome_forn FROM supplier
  UNION ALL
  SELECT CAST(s_suppkey AS VARCHAR), s_name FROM supplier WHERE s_suppkey % 7 = 0),
stg_dim_campanha AS (
  SELECT left(o_orderpriority, 1) AS id_camp,
         {sentence("split_part(o_orderpriority, '-', 2)")} AS nome_camp,
         CASE left(o_orderpriority, 1) WHEN '1' THEN '5' WHEN '2' THEN '8' WHEN '3' THEN '11' WHEN '5' THEN '12' END AS mes_ref
  FROM (SELECT DISTINCT o_orderpriority FROM orders WHERE o_orderpriority <> '4-NOT SPECIFIED') p)
"""

CAL_ATTRS = """
  SELECT data,
         ['Domingo','Segunda-feira','Terça-feira','Quarta-feira','Quinta-feira','Sexta-feira','Sábado'][dayofweek(data) + 1] AS dia_da_semana,
         CASE WHEN dayofweek(data) IN (0, 6) THEN 'nao' ELSE 'sim' END AS dia_util,
         CAST(year(data) AS INTEGER) AS ano, CAST(month(data) AS INTEGER) AS mes, CAST(day(data) AS INTEGER) AS dia,
         ['Janeiro','Fevereiro','Março','Abril','Maio','Junho','Julho','Agosto','Setembro','Outubro','Novembro','Dezembro'][month(data)] AS nome_do_mes,
         ['jan','fev','mar','abr','mai','jun','jul','ago','set','out','nov','dez'][month(data)] || '/' || lpad(CAST(year(data) % 100 AS VARCHAR), 2, '0') AS mes_ano,
         CAST(year(data) * 100 + month(data) AS INTEGER) AS ano_mes,
         CASE WHEN month(data) <= 6 THEN 1 ELSE 2 END AS semestre,
         CAST(CASE WHEN month(data) <= 6 THEN 1 ELSE 2 END AS VARCHAR) || '/' || CAST(year(data) AS VARCHAR) AS semestre_ano,
         CAST(year(data) * 10 + CASE WHEN month(data) <= 6 THEN 1 ELSE 2 END AS INTEGER) AS ano_semestre,
         CAST(quarter(data) AS INTEGER) AS trimestre,
         CAST(quarter(data) AS VARCHAR) || '/' || CAST(year(data) AS VARCHAR) AS trimestre_ano,
         CAST(year(data) * 10 + quarter(data) AS INTEGER) AS ano_trimestre,
         CAST(ceil(month(data) / 2) AS INTEGER) AS bimestre,
         CAST(CAST(ceil(month(data) / 2) AS INTEGER) AS VARCHAR) || '/' || CAST(year(data) AS VARCHAR) AS bimestre_ano,
         CAST(year(data) * 10 + ceil(month(data) / 2) AS INTEGER) AS ano_bimestre
"""

SILVER = f"""
campaign_rows AS (
  SELECT TRY_CAST(id_camp AS INTEGER) AS id_camp, nome_camp AS nome_campanha, TRY_CAST(mes_ref AS INTEGER) AS mes_referente FROM stg_dim_campanha),
dim_camp_marketing AS (
  SELECT DISTINCT ON (id_camp) * FROM campaign_rows WHERE id_camp IS NOT NULL
  ORDER BY id_camp, nome_campanha NULLS FIRST, mes_referente NULLS FIRST),
centre_rows AS (SELECT TRY_CAST(id_cc AS INTEGER) AS id_cc, {sentence('nome_cc')} AS nome_cc FROM stg_dim_centro_custo),
dim_centro_custo AS (
  SELECT id_cc, min(nome_cc) AS nome_cc FROM centre_rows WHERE id_cc <> -1 GROUP BY id_cc
  UNION ALL SELECT -1, 'Não identificado'),
category_rows AS (
  SELECT CAST(TRUNC(TRY_CAST(id_cat AS DOUBLE)) AS INTEGER) AS id_categoria, CAST(TRUNC(TRY_CAST(id_cc AS DOUBLE)) AS INTEGER) AS id_cc,
         nome_cat AS nome_categoria
  FROM stg_dim_categoria),
dim_categoria AS (
  SELECT DISTINCT ON (id_categoria) c.* FROM category_rows c SEMI JOIN dim_centro_custo USING (id_cc)
  WHERE id_categoria IS NOT NULL ORDER BY id_categoria, id_cc, nome_categoria NULLS FIRST),
dim_fornecedores AS (
  SELECT TRY_CAST(id_forn AS INTEGER) AS id_forn, min(nome_forn) AS nome_forn FROM stg_dim_fornecedores
  WHERE TRY_CAST(id_forn AS INTEGER) IS NOT NULL GROUP BY 1),
entry_rows AS (
  SELECT TRY_CAST(id_lancamento AS BIGINT) AS id_lancamento, TRY_CAST(data_lancamento AS DATE) AS data_lancamento,
         TRY_CAST(id_centro_custo AS INTEGER) AS cc, TRY_CAST(id_categoria AS INTEGER) AS id_categoria,
         TRY_CAST(id_fornecedor AS INTEGER) AS id_fornecedor, CAST(TRUNC(TRY_CAST(id_campanha_marketing AS DOUBLE)) AS INTEGER) AS id_campanha,
         TRY_CAST(valor_lancamento AS DECIMAL(16,2)) AS valor_original, upper(rtrim(status_pagamento)) AS escrita
  FROM stg_lancamentos WHERE data_lancamento IS NOT NULL),
vw_lancamentos AS (
  SELECT id_lancamento, data_lancamento, if(list_contains((SELECT list(id_cc) FROM dim_centro_custo), cc), cc, if(cc IS NULL, NULL, -1)) AS id_centro_custo,
         id_categoria, id_fornecedor,
         id_campanha, abs(valor_original) AS valor, valor_original, coalesce(['Pago', 'Pago', 'Aberto', 'Aberto'][list_position(['PAGO', 'PAGA', 'PENDING', 'ABERTO'], escrita)], 'Outros') AS status_pagamento
  FROM entry_rows),
good_entries AS (
  SELECT v.* FROM vw_lancamentos v SEMI JOIN dim_categoria USING (id_categoria) SEMI JOIN dim_fornecedores f ON f.id_forn = v.id_fornecedor
  WHERE id_lancamento IS NOT NULL AND id_centro_custo IS NOT NULL AND valor > 0 AND status_pagamento <> 'Outros'
    AND data_lancamento > {d(CFG.ledger_min_date)} AND data_lancamento <= {d(CFG.load_date)}
    AND (id_campanha IS NULL OR EXISTS (FROM dim_camp_marketing m WHERE m.id_camp = id_campanha))),
fact_lancamentos AS (
  SELECT DISTINCT ON (id_lancamento) * FROM good_entries
  ORDER BY id_lancamento, data_lancamento, id_centro_custo, id_categoria, id_fornecedor, id_campanha NULLS FIRST, valor, valor_original, status_pagamento),
budget_rows AS (
  SELECT TRY_CAST(id_orcamento AS INTEGER) AS id_orcamento, TRY_CAST(ano AS INTEGER) AS ano,
         TRY_CAST(mes AS INTEGER) AS mes, TRY_CAST(id_centro_custo AS INTEGER) AS id_centro_custo,
         TRY_CAST(id_categoria AS INTEGER) AS id_categoria, TRY_CAST(valor_orcado AS DECIMAL(18,2)) AS valor
  FROM stg_orcamento),
budget_means AS (
  SELECT id_centro_custo, id_categoria, CAST(SUM(valor) AS DOUBLE) / COUNT(valor) AS media
  FROM (SELECT DISTINCT ON (id_orcamento) * FROM budget_rows ORDER BY id_orcamento, ano, mes, id_centro_custo, id_categoria, valor) GROUP BY ALL),
vw_orcamento AS (
  SELECT r.id_orcamento, last_day(make_date(r.ano, r.mes, 1)) AS data_orcamento, r.ano, r.mes, r.id_centro_custo, r.id_categoria, r.valor,
         if(CAST(r.valor AS DOUBLE) / m.media - 1 > 9, 'Dado suspeito', 'Dado confiavel') AS status_dado
  FROM budget_rows r LEFT JOIN budget_means m
    ON m.id_centro_custo IS NOT DISTINCT FROM r.id_centro_custo AND m.id_categoria IS NOT DISTINCT FROM r.id_categoria),
good_budget AS (
  SELECT v.* FROM vw_orcamento v SEMI JOIN dim_centro_custo c ON c.id_cc = v.id_centro_custo SEMI JOIN dim_categoria USING (id_categoria)
  WHERE id_orcamento IS NOT NULL AND valor > 0 AND mes BETWEEN 1 AND 12
    AND ano BETWEEN {CFG.budget_min_year} AND {CFG.load_date.year} AND data_orcamento BETWEEN {d(CFG.calendar_start)} AND {d(CFG.calendar_end)}),
fact_orcamento AS (
  SELECT DISTINCT ON (id_orcamento) * FROM good_budget
  ORDER BY id_orcamento, data_orcamento, ano, mes, id_centro_custo, id_categoria, valor, status_dado),
cal_span AS (SELECT year(min(data_lancamento)) AS y1, year(max(data_lancamento)) AS y2 FROM fact_lancamentos),
cal_days AS (
  SELECT make_date(y1, 1, 1) + CAST(unnest(range(date_diff('day', make_date(y1, 1, 1), make_date(y2 + 1, 1, 1)))) AS INTEGER) AS data FROM cal_span),
dim_calendario AS (
{CAL_ATTRS}  FROM cal_days)
"""

PREFIX = "WITH " + STAGING.strip() + ",\n" + SILVER.strip() + "\n"


def q(body: str) -> str:
    """Full statement: shared CTEs, optional extra CTEs, final SELECT.

    ``body`` either starts with ', name AS (...)' (more CTEs) or is a SELECT.
    """
    body = body.strip()
    if body.startswith(","):
        return PREFIX + body + "\n"
    return PREFIX + body + "\n"
