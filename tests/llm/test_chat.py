import hashlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from ledgerlight.llm import chat

SF = "/root/testdata/sf0.001"
TRICKY = st.text(alphabet=st.sampled_from(list("\\#</turn> :\nab")), max_size=40) | st.sampled_from(["### assistant: ", " </turn>\n", "\\", "\\###", chat.PROBE])


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "a:b", "\\", ""]) | TRICKY, TRICKY), max_size=6))
def test_round_trip(turns):
    examples = list(chat.expand(turns))
    if turns:
        assert chat.read_turns(examples[-1][1]) == turns
    for target, formatted, a, b in examples:
        n = target + 1 if target >= 0 else len(turns)
        assert chat.read_turns(formatted) == turns[:n]
        assert chat.unescape(formatted[a:b]) == (turns[target][1] if target >= 0 else "")
    assert [t for t, *_ in examples if t >= 0] == [i for i, (r, _) in enumerate(turns) if r == "assistant"]


def expected(turns):
    loss = "".join(t for r, t in turns if r == "assistant")
    return (len(turns), hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest(),
            sum(len(f) for _, f, _, _ in chat.expand(turns)))


def test_query_against_brute_force(spark):
    convs = {-7: [("user", chat.PROBE), ("assistant", chat.PROBE)]}
    for r in sorted(spark.read.parquet(f"{SF}/conversations.parquet").collect(), key=lambda r: (r["conv_id"], r["turn"])):
        convs.setdefault(r["conv_id"], []).append((r["role"], r["text"] or ""))
    got = {r["conv_id"]: tuple(r)[1:6] for r in chat.op3_chat_format(spark, SF).collect()}
    assert got == {k: expected(v) for k, v in convs.items()}


def test_edge_rows(spark):
    rows = [(1, 0, "user", "hi"), (1, 1, "assistant", None), (2, 0, "system", "only"), (3, 1, "assistant", "b"), (3, 1, "assistant", "a"), (3, None, None, ""),
            (None, 0, "user", "x"), (None, 1, "assistant", "y" * 300000), (4, 0, "user", "u"), (4, 0, "user", "u"), (4, 2, "user", "after")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr("*", "'c' AS example", "'c' AS formatted", "1 AS n_turns")
    got = {r["conv_id"]: tuple(r)[1:6] for r in chat.read_back(chat.chat_examples(df)).collect()}
    assert got == {1: expected([("user", "hi"), ("assistant", "")]), 2: expected([("system", "only")]), 3: expected([("", ""), ("assistant", "a"), ("assistant", "b")]),
                   None: expected([("user", "x"), ("assistant", "y" * 300000)]), 4: expected([("user", "u"), ("user", "u"), ("user", "after")])}
    assert chat.read_back(chat.chat_examples(df.limit(0))).count() == 0


@pytest.mark.parametrize("n", [1, 2, 9])
def test_one_example_per_assistant_turn(n):
    turns = [("user", "q"), ("assistant", "a")] * n + [("user", "open")]
    examples = list(chat.expand(turns))
    assert len(examples) == n + 1 and examples[-1][0] == -1 and examples[-1][2] == examples[-1][3]
    assert chat.read_turns(examples[-1][1]) == turns


def test_a_long_conversation_leaves_in_small_batches(spark, monkeypatch):
    """The 300 prefixes of one conversation are never held together."""
    sent = []

    class Rows:
        schema = {"conv_id": type("F", (), {"dataType": type("T", (), {"simpleString": staticmethod(lambda: "long")})})}
        repartition = sortWithinPartitions = select = lambda self, *a: self
        sparkSession = spark

        def mapInArrow(self, run, schema):
            turns = chat.pa.RecordBatch.from_pydict({"conv_id": [1] * 600, "role": ["user", "assistant"] * 300, "text": ["x"] * 600})
            sent.extend(run(iter([turns[:350], turns[350:]])))

    monkeypatch.setattr(chat, "_BATCH_CHARS", 50_000)
    chat.chat_examples(Rows())
    assert len(sent) > 20 and max(sum(len(f) for f in b["formatted"].to_pylist()) for b in sent) < 100_000
    assert [e for b in sent for e in b["example"].to_pylist()] == list(range(300))


def test_large_ids_beside_nulls_and_tables_split_anywhere(spark):
    rows = [(c, n, "assistant" if n % 2 else "user", f"text {c} {n}") for c in (2**53 + 1, 2**53, None, 5) for n in range(6)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").coalesce(1)
    examples = chat.chat_examples(df)
    want = {r["conv_id"]: tuple(r)[1:] for r in chat.read_back(examples, grouped=True).collect()}
    assert set(want) == {2**53 + 1, 2**53, None, 5}
    split = spark.createDataFrame(sorted(examples.collect(), key=lambda r: r["formatted"][::-1]), examples.schema).repartition(5)
    assert {r["conv_id"]: tuple(r)[1:] for r in chat.read_back(split).collect()} == want
