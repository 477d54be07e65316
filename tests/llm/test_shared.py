import random

import numpy as np

from ledgerlight.llm import shared


def test_span_hashes_depend_on_bytes_only():
    data = np.frombuffer("ab abc ab \xe9 abc".encode(), dtype=np.uint8)
    starts, ends = shared.word_spans(data)
    words = [bytes(data[a:b]) for a, b in zip(starts, ends)]
    assert words == "ab abc ab \xe9 abc".encode().split()
    h = shared.span_hashes(data, starts, ends)
    assert h[0] == h[2] and h[1] == h[4] and len({*h.tolist()}) == 3
    assert shared.span_hashes(data, starts[1:2] + 1, ends[1:2])[0] != h[1]


def test_fold_grams_needs_all_words():
    h = shared.mix64(np.arange(5, dtype=np.uint64))
    assert len(shared.fold_grams(h, 3)) == 3 and len(shared.fold_grams(h[:2], 3)) == 0
    assert shared.fold_grams(h, 3)[1] == shared.fold_grams(h[1:4], 3)[0] != shared.fold_grams(h[1:4][::-1].copy(), 3)[0]


def test_count_words(spark):
    df = spark.createDataFrame([(None,), ("",), (" a\tb\x0bc\x0cd\re\nf ",), ("a\u00a0b\x1cc",)], "t string")
    assert [r[0] for r in df.select(shared.count_words(df["t"])).collect()] == [0, 0, 6, 1]


def test_components(spark):
    rng = random.Random(3)
    edges = [(i, i + 1) for i in range(100, 160)] + [(500, 500 + i) for i in range(1, 200)] + [(7, 7)]
    edges += [(rng.randrange(1000, 1200), rng.randrange(1000, 1200)) for _ in range(120)]
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x
    for a, b in edges:
        if a != b:
            a, b = find(a), find(b)
            root[max(a, b)] = min(a, b)
    got = {r["node"]: r["component"] for r in shared.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: find(x) for x in root}
    assert shared.components(spark.createDataFrame([], "a long, b long")).count() == 0
