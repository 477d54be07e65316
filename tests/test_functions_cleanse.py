"""Column helpers and cleansing operators on hand-made frames (FIXTURES §4)."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from conftest import rows
from ledgerlight import schemas as S
from ledgerlight.functions.text import (
    float_text_to_int, has_extra_space, is_null_or_blank, normalise_status, sentence_case,
)
from ledgerlight.operators import cleanse

NAMES = [" Marketing", "RH ", "  Facilities", "FINANCEIRO", "TI", "Comercial/Vendas", "   ", None]


@pytest.fixture
def names(spark):
    return spark.createDataFrame([(i, n) for i, n in enumerate(NAMES)], "id int, nome string")


def test_sentence_case_is_not_initcap(names):
    out = dict(rows(names.select("id", sentence_case("nome").alias("s"))))
    assert out[0] == "Marketing" and out[1] == "Rh" and out[2] == "Facilities"
    assert out[3] == "Financeiro" and out[4] == "Ti"
    assert out[5] == "Comercial/vendas"           # only the first letter is raised
    assert out[6] == "" and out[7] is None


def test_blank_and_space_rules(names):
    r = dict((i, (b, a, lead)) for i, b, a, lead in rows(names.select(
        "id", is_null_or_blank("nome").alias("b"), has_extra_space("nome").alias("a"),
        has_extra_space("nome", leading_only=True).alias("l"))))
    assert [i for i, v in r.items() if v[0]] == [6, 7]           # blank-only counts as empty
    assert sorted(i for i, v in r.items() if v[1]) == [0, 1, 2, 6]
    assert sorted(i for i, v in r.items() if v[2]) == [0, 2]     # trailing blanks ignored: "   " has length 0
    assert r[7] == (True, False, False)                           # NULL has no extra space


def test_float_text_keys(spark):
    df = spark.createDataFrame([("101.0",), ("5",), ("7.9",), ("x",), (None,)], "k string")
    assert rows(df.select(float_text_to_int("k").alias("v"))) == [(None,), (None,), (5,), (7,), (101,)]


def test_status_normalisation(spark):
    df = spark.createDataFrame([(s,) for s in ["PAGO", "Paga", "Pago", "Pending", "Aberto", "pago ", None]], "s string")
    got = [r[0] for r in df.select(normalise_status("s")).collect()]          # case-insensitive collation
    assert got == ["Pago", "Pago", "Pago", "Aberto", "Aberto", "Pago", "Outros"]
    exact = [r[0] for r in df.select(normalise_status("s", case_insensitive=False)).collect()]
    assert exact[5] == "Outros"


def test_rekey_unknown_keeps_null(spark):
    """fk fixture: key NULL, known, unknown -> stays NULL, kept, -1."""
    dim = spark.createDataFrame([(1, "a"), (2, "b")], "id_cc int, nome_cc string")
    fact = spark.createDataFrame([(10, None), (11, 1), (12, 999)], "id int, cc int")
    out = cleanse.rekey_unknown(fact, "cc", dim, "id_cc")
    assert rows(out) == [(10, None), (11, 1), (12, -1)]


def test_rekey_unknown_ignores_null_dimension_keys(spark):
    dim = spark.createDataFrame([(1, "a"), (None, "b")], "id_cc int, nome_cc string")
    fact = spark.createDataFrame([(11, 1), (12, 999)], "id int, cc int")
    assert rows(cleanse.rekey_unknown(fact, "cc", dim, "id_cc")) == [(11, 1), (12, -1)]


def test_default_member_is_idempotent(spark):
    dim = spark.createDataFrame([(1, "a")], "id_cc int, nome_cc string")
    once = cleanse.add_default_member(dim, "id_cc", "nome_cc")
    twice = cleanse.add_default_member(once, "id_cc", "nome_cc")
    assert rows(twice) == [(-1, S.DEFAULT_MEMBER_NAME), (1, "a")]


def test_outlier_flag_needs_more_than_ten_times_the_mean(spark):
    # group mean includes the outlier: 9 x 1 + 100 -> mean 10.9, 100/10.9 - 1 = 8.17 (not suspect)
    vals = [(i, "g", Decimal("1.00")) for i in range(9)] + [(9, "g", Decimal("100.00"))]
    vals += [(10 + i, "h", Decimal("1.00")) for i in range(30)] + [(40, "h", Decimal("100.00"))]
    df = spark.createDataFrame(vals, "id int, g string, v decimal(18,2)")
    out = dict((i, f) for i, f in rows(cleanse.outlier_flag(df, "v", ["g"], "flag").select("id", "flag")))
    assert out[9] == S.BUDGET_TRUSTED
    assert out[40] == S.BUDGET_SUSPECT                 # 100 / (130/31) - 1 = 22.8
    assert sum(1 for f in out.values() if f == S.BUDGET_SUSPECT) == 1


def test_sign_repair_and_labels(spark):
    df = spark.createDataFrame([(1, Decimal("-5.00"), None), (2, Decimal("3.00"), "  x ")],
                               "id int, v decimal(16,2), camp string")
    out = cleanse.fill_label(cleanse.sign_repair(df, "v", "v", "v_orig"), ["camp"])
    assert rows(out, "id", "v", "v_orig", "camp") == [
        (1, Decimal("5.00"), Decimal("-5.00"), S.MISSING_LABEL), (2, Decimal("3.00"), Decimal("3.00"), "x")]


def test_typed_projection_never_raises(spark):
    df = spark.createDataFrame([("1", "2024-01-31", "10.50"), ("x", "31/01/2024", "abc")], "a string, d string, v string")
    out = cleanse.typed_projection(df, {"a": "int", "d": "date", "v": "decimal(16,2)"})
    got = rows(out)
    assert got[0] == (None, None, None)
    assert got[1][0] == 1 and str(got[1][1]) == "2024-01-31" and got[1][2] == Decimal("10.50")
    assert out.filter(F.col("a").isNull()).count() == 1
