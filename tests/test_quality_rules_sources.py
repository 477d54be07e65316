"""Profiling, rules, audits and file sources."""

import os
import tempfile
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from conftest import rows
from ledgerlight import schemas as S
from ledgerlight.operators import audit, quality, rules
from ledgerlight.sources import files


@pytest.fixture
def cc(spark):
    return spark.createDataFrame(
        [("1", " Marketing"), ("2", "RH "), ("3", "FINANCEIRO"), ("4", "Comercial/Vendas"), ("5", "Projetos Especiais"),
         ("6", "TI"), ("7", "   "), (None, None)], S.STG_CENTRO_CUSTO)


def test_profile_one_pass_long_form(cc):
    p = quality.profile(cc, "stg_dim_centro_custo")
    got = {(r["coluna"], r["regra"]): r["qtd"] for r in p.collect()}
    assert got[("*", "linhas")] == 8
    assert got[("nome_cc", quality.RULE_EXTRA_SPACE)] == 3
    assert got[("nome_cc", quality.RULE_NULL_OR_EMPTY)] == 2
    assert got[("id_cc", quality.RULE_NULL_OR_EMPTY)] == 1
    lead = quality.extra_space_counts(cc, ["nome_cc"], leading_only=True).first()[0]
    assert lead == 1                  # only " Marketing": a length that ignores trailing blanks


def test_letter_case_rules(cc):
    bad = sorted(r[1] for r in rows(quality.not_sentence_case(cc, "nome_cc")))
    assert bad == ["Comercial/Vendas", "FINANCEIRO", "Projetos Especiais"]   # 'TI' is too short
    assert [r[1] for r in rows(quality.all_upper(cc, "nome_cc"))] == ["FINANCEIRO"]


def test_duplicates_ignore_null_keys(spark):
    df = spark.createDataFrame([("a",), ("a",), (None,), (None,), ("b",)], "k string")
    assert rows(quality.duplicate_keys(df, "k")) == [("a", 2)]
    names = spark.createDataFrame([("Building",), ("BUILDING ",), ("Other",)], "n string")
    assert rows(quality.duplicate_names(names, "n")) == [("building", 2)]


def test_fk_not_in_semantics(spark):
    child = spark.createDataFrame([(1,), (2,), (None,), (9,)], "k int")
    parent = spark.createDataFrame([(1,), (2,)], "pk int")
    parent_null = spark.createDataFrame([(1,), (None,)], "pk int")
    out = quality.fk_violations(child, {"k": ("k", parent, "pk"), "k_null_parent": ("k", parent_null, "pk")})
    assert dict(rows(out)) == {"k": 1, "k_null_parent": 0}
    assert rows(quality.orphan_keys(child, "k", parent, "pk")) == [(9,)]


def test_financial_impact_and_negatives(spark):
    df = spark.createDataFrame([(Decimal("10.00"), None, "Pago"), (Decimal("-30.00"), "x", "PAGO"),
                                (Decimal("60.00"), "y", "Pago")], "v decimal(18,2), d string, s string")
    r = quality.financial_impact(df, F.col("v"), F.col("d").isNull()).first()
    assert (r["valor_total"], r["valor_defeito"], r["impacto"]) == (40.0, 10.0, 0.25)
    assert rows(quality.negative_profile(df, F.col("v"), "s")) == [("PAGO", 1, -30.0)]


def test_deviation_bands_keep_empty_bands(spark):
    # mean 10: 25 -> +150 % (band 3); 9.5 -> -5 % (band 6); 1, 0 -> -90 %, -100 % (band 9);
    # 14.5 -> +45 % (no band)
    vals = [Decimal(x) for x in ("25", "9.5", "1", "14.5", "0")]
    df = spark.createDataFrame([("g", v) for v in vals], "g string, v decimal(18,2)")
    out = {r["faixa_nome"]: (r["valor_concentrado"], r["registros"])
           for r in quality.deviation_bands(df, F.col("v"), ["g"]).collect()}
    assert len(out) == 9
    assert out["3. 100~900%"] == (25.0, 1) and out["6. -10~0%"] == (9.5, 1) and out["9. -30%-"] == (1.0, 2)
    assert sum(n for _, n in out.values()) == 4                           # (0.2, 1) is not covered
    assert out["1. 1000%+"] == (0.0, 0)


def test_rules_split_is_a_partition(spark):
    df = spark.createDataFrame([(1, 5, "Pago"), (2, -1, "Pago"), (3, 4, "Outros"), (4, None, None)],
                               "id int, v int, s string")
    r = {"v_positive": F.col("v") > 0, "s_domain": F.col("s").isin("Pago", "Aberto"),
         **rules.not_null("v", "s")}
    valid, rejects = rules.split(df, r)
    assert valid.count() + rejects.count() == df.count()
    got = {i: sorted(b) for i, b in rows(rejects, "id", rules.RULES_COL)}
    assert got == {2: ["v_positive"], 3: ["s_domain"], 4: ["s_not_null", "v_not_null"]}
    with pytest.raises(rules.RuleViolation):
        rules.assert_rules(df, r)
    assert rules.assert_rules(valid, r).count() == 1
    assert rows(rules.uniqueness_violations(
        spark.createDataFrame([(1,), (1,), (None,), (2,)], "k int"), ["k"])) == [(None, 1), (1, 2)]


def test_csv_ingest_round_trip_keeps_blanks(spark):
    df = spark.createDataFrame([("1", " Marketing"), ("2", "RH "), ("3", None), ("4", "a,b")], S.STG_CENTRO_CUSTO)
    path = os.path.join(tempfile.mkdtemp(prefix="ll-csv-"), "cc")
    files.write_csv(df, path)
    back = files.ingest_csv(spark, path, S.STG_CENTRO_CUSTO)
    assert rows(back) == rows(df)


def test_csv_ingest_binds_by_position_and_skips_bom(spark):
    d = tempfile.mkdtemp(prefix="ll-csv-")
    p = os.path.join(d, "dim.csv")
    with open(p, "w", encoding="utf-8-sig") as fh:          # UTF-8 with BOM, other header names
        fh.write("id_centro_custo,nome_centro_custo\n1,Marketing\n2, TI\n")
    got = rows(files.ingest_csv(spark, p, S.STG_CENTRO_CUSTO))
    assert got == [("1", "Marketing"), ("2", " TI")]


def test_full_refresh_is_idempotent(spark):
    df = spark.createDataFrame([(2024, 1, 1.0), (2024, 2, 2.0)], "ano int, mes int, v double")
    path = os.path.join(tempfile.mkdtemp(prefix="ll-pq-"), "t")
    files.full_refresh(df, path, ["ano"])
    back = files.full_refresh(df, path, ["ano"])
    assert back.count() == 2


def test_csv_lines_with_other_fields_are_rejects(spark):
    d = tempfile.mkdtemp(prefix="ll-csv-")
    p = os.path.join(d, "dim.csv")
    with open(p, "w") as fh:
        fh.write('a,b\n1,Marketing\n1,A,extra\n7\n2,"two\nlines"\n3,Vendas\n')
    good, bad = files.ingest_csv(spark, p, S.STG_CENTRO_CUSTO), files.ingest_rejects(spark, p, S.STG_CENTRO_CUSTO)
    assert ("1", "Marketing") in rows(good) and ("3", "Vendas") in rows(good) and ("1", "A") not in rows(good)
    assert {"1,A,extra", "7"} <= {r[0] for r in bad.collect()}
    multi = {"multiLine": "true"}
    assert rows(files.ingest_csv(spark, p, S.STG_CENTRO_CUSTO, **multi)) == [("1", "Marketing"), ("2", "two\nlines"), ("3", "Vendas")]
    assert len(files.ingest_rejects(spark, p, S.STG_CENTRO_CUSTO, **multi).collect()) == 2
    os.makedirs(os.path.join(d, "dim_old"))
    assert files.raw_path(spark, d, "dim").endswith("/dim.csv")
    with pytest.raises(FileNotFoundError):
        files.raw_path(spark, d, "di")


def test_failed_refresh_keeps_the_old_table_and_months_are_few_files(spark):
    path = os.path.join(tempfile.mkdtemp(prefix="ll-pq-"), "t")
    df = spark.range(4000).repartition(8).selectExpr("cast(2024 as int) ano", "cast(id % 3 as int) mes", "id")
    files.full_refresh(df, path, ["ano", "mes"])
    [data] = os.listdir(f"{path}/data")
    for m in range(3):
        assert len([f for f in os.listdir(f"{path}/data/{data}/ano=2024/mes={m}") if f.endswith(".parquet")]) <= 2
    bad = df.withColumn("id", F.when(F.col("id") == 7, F.raise_error(F.lit("broken"))).otherwise(F.col("id")).cast("long"))
    with pytest.raises(Exception, match="broken"):
        files.full_refresh(bad, path, ["ano", "mes"])
    assert files.read_table(spark, path).count() == 4000


def test_cast_audit(spark):
    df = spark.createDataFrame([("1", "2024-01-01"), ("x", None), (None, "2024-13-01")], "a string, b string")
    got = rows(audit.cast_audit("t", df, {"a": "int", "b": "date"}), "coluna", "linhas", "nao_convertidos", "nulos")
    assert got == [("a", 3, 1, 1), ("b", 3, 1, 1)]


def test_audits(spark):
    a = spark.createDataFrame([(1,)], "x int")
    b = spark.createDataFrame([(1,), (2,)], "y int")
    assert dict(rows(audit.audit_counts({"a": a, "b": b}))) == {"a": 1, "b": 2}
    s = audit.schema_audit(spark, {"a": a}, {"a": S.text_schema("x")})
    r = s.first()
    assert (r["tabela"], r["coluna"], r["tipo"], r["tipo_esperado"], r["confere"]) == ("a", "x", "int", "string", False)
