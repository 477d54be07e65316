import random

import duckdb
import pytest

from edges import edge_docs, empty_docs, rows_by_key
from ledgerlight.llm import lines
from ledgerlight.llm.lines import line_dedup

SF = "/root/testdata/sf0.001"


def brute(docs, run, words=20, size=400):
    """Texts without lines of runs, and without long lines, that occurred before, by comparing all of them."""
    seen, out = set(), {}
    for k, text in sorted(docs.items()):
        own = text.split("\n")
        at = [i for i, x in enumerate(own) if x.encode().split()]
        gone = set()
        spans = [at[j:j + run] for j in range(len(at) - run + 1)]
        spans += [[i] for i in at if len(own[i].encode().split()) >= words or len(own[i].encode()) >= size] if run > 1 else []
        for span in sorted(spans):
            window = tuple(own[i] for i in span)
            if window in seen:
                gone.update(span)
            seen.add(window)
        out[k] = "\n".join(x for i, x in enumerate(own) if i not in gone)
    return out


@pytest.mark.parametrize("window, gram", [(2, 1), (1, 1), (3, 1), (3, 2)])
def test_documents_against_brute_force(spark, window, gram):
    df = spark.read.parquet(f"{SF}/documents.parquet")
    docs = {r["doc_id"]: r["text"] for r in df.collect()}
    got = {r["doc_id"]: r["text"] for r in line_dedup(df, window=window, gram=gram).collect()}
    assert got == brute(docs, window + gram - 1)


def test_random_lines_against_brute_force(spark):
    rnd = random.Random(3)
    pool = [" ".join(rnd.choice("abcdef") for _ in range(rnd.choice([1, 2, 5, 19, 20, 30]))) for _ in range(60)] + ["", " ", "x" * 399, "y" * 400, "\u4e2d" * 134]
    docs = {k: "\n".join(rnd.choice(pool) for _ in range(rnd.randint(1, 9))) for k in range(150)}
    df = spark.createDataFrame(list(docs.items()), "doc_id long, text string")
    for window, gram in [(2, 1), (2, 2), (4, 1)]:
        got = {r["doc_id"]: r["text"] for r in line_dedup(df, window=window, gram=gram).collect()}
        assert got == brute(docs, window + gram - 1)


def test_a_passage_on_one_line_goes(spark):
    long = " ".join(f"w{i}" for i in range(51))
    blankless = "\u4e2d\u6587" * 80
    short = " ".join(f"s{i}" for i in range(19))
    docs = [(1, f"a\n{long}\nb\n{blankless}\n{short}"), (2, f"c\n{long}\nd\n{short}\ne\n{blankless}"), (3, long)]
    got = {r["doc_id"]: r["text"] for r in line_dedup(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert got == {1: docs[0][1], 2: f"c\nd\n{short}\ne", 3: ""}


def test_lines_that_collide_under_a_polynomial_are_kept_apart(spark):
    one = "".join("ab"[bin(i).count("1") % 2] for i in range(4096))
    docs = [(1, one), (2, one.translate({97: "b", 98: "a"}))]
    got = {r["doc_id"]: r["text"] for r in line_dedup(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert got == dict(docs)


def test_query_matches_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    want = sorted(con.execute(f"SELECT doc_id, text, n_lines, n_removed FROM ({lines.SQL})").fetchall())
    got = sorted(tuple(r) for r in lines.op2_line_dedup(spark, SF).select("doc_id", "text", "n_lines", "n_removed").collect())
    assert got == want and sum(r[3] for r in got) > 0


def test_edge_rows(spark):
    df = edge_docs(spark)
    out = line_dedup(df)
    assert out.columns == [*df.columns, "n_lines_", "n_removed_"]
    got = rows_by_key(out, "doc_id")
    assert got[2][0]["text"] is None and got[2][0]["n_lines_"] == 0
    assert got[3][0]["text"] == "" and got[4][0]["text"] == " \t\n\n "
    assert got[8][0]["text"] == "line a b\nline c d\nline e f\n\n" and got[8][0]["n_removed_"] == 2
    assert len(got[7]) == 2 and got[7][0] == got[7][1] and got[7][0]["n_lines"] == "clash"
    assert line_dedup(empty_docs(spark)).count() == 0


def test_copies_keep_the_first_and_empty_the_rest(spark):
    text = "a b\nc d\ne f"
    df = spark.createDataFrame([(3, text), (1, text), (2, "a b\nx y\nc d")], "doc_id long, text string")
    got = {r["doc_id"]: (r["text"], r["n_removed"]) for r in line_dedup(df).collect()}
    assert got == {1: (text, 0), 2: ("a b\nx y\nc d", 0), 3: ("", 3)}
