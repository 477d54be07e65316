"""Property tests: the text helpers agree with plain-Python definitions."""

from hypothesis import given, settings
from hypothesis import strategies as st

from ledgerlight.functions.text import has_extra_space, is_null_or_blank, normalise_status, sentence_case

ALPHABET = " abcXYZçÃéÍ/-'0"
texts = st.lists(st.one_of(st.none(), st.text(alphabet=ALPHABET, max_size=12)), min_size=1, max_size=40)


def py_sentence(t):
    if t is None:
        return None
    s = t.strip(" ")
    return s[:1].upper() + s[1:].lower()


def py_extra(t, leading_only=False):
    if t is None:
        return False
    base = len(t.rstrip(" ")) if leading_only else len(t)
    return base > len(t.strip(" "))


def py_status(t):
    if t is None:
        return "Outros"
    k = t.rstrip(" ").upper()
    return "Pago" if k in ("PAGO", "PAGA") else ("Aberto" if k in ("PENDING", "ABERTO") else "Outros")


@settings(max_examples=15, deadline=None)
@given(texts)
def test_text_helpers_match_python(spark, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, t string")
    got = df.select("i", sentence_case("t").alias("s"), has_extra_space("t").alias("e"),
                    has_extra_space("t", leading_only=True).alias("l"), is_null_or_blank("t").alias("b")) \
            .orderBy("i").collect()
    for r, v in zip(got, values):
        assert r["s"] == py_sentence(v)
        assert r["e"] == py_extra(v) and r["l"] == py_extra(v, True)
        assert r["b"] == (v is None or v.rstrip(" ") == "")


@settings(max_examples=10, deadline=None)
@given(st.lists(st.one_of(st.none(), st.sampled_from(["PAGO", "Paga", "pago ", " Pago", "Pending", "aberto",
                                                      "ABERTO  ", "x", ""])), min_size=1, max_size=20))
def test_status_mapping_matches_python(spark, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, t string")
    got = [r["s"] for r in df.select("i", normalise_status("t").alias("s")).orderBy("i").collect()]
    assert got == [py_status(v) for v in values]
