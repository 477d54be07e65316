import zlib

import numpy as np

from edges import edge_docs, empty_docs, rows_by_key
from ledgerlight.llm import language


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    langs = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = language.op7_language_id(spark, sf).collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in rows) and len(rows) == len(langs)
    held = [r for r in rows if r["held_out"]]
    assert len(held) > 100 and np.mean([r["lang_pred"] == langs[r["doc_id"]] for r in held]) >= 0.97
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_one_lookup_returns_all_languages():
    rng = np.random.default_rng(1)
    members = [rng.integers(0, 1 << 63, 500, dtype=np.uint64) for _ in range(70)]
    members[3] = np.concatenate([members[3], members[66][:100]])
    model = language.Model.build([f"l{i}" for i in range(70)], members)
    assert model.bits.shape[0] == 2

    def known(grams):
        out = set()
        for k in range(70):
            bits = [(model.bits[k // 64][a] >> np.uint64(k % 64)) & np.uint64(1) for a in language._slots(grams, model.bits.shape[1])]
            if np.all(np.minimum.reduce(bits) == 1):
                out.add(k)
        return out
    assert known(members[66][:100]) >= {3, 66} and len(known(members[66][:100])) == 2 and known(members[5]) == {5}
    rate = model.false_positives()
    assert (rate < 1e-6).all() and len(rate) == 70


def test_texts_without_letters_and_without_languages():
    model = language.Model.build(["en", "de"], [language.grams(["the house and the garden"])[0], language.grams(["das haus und der garten"])[0]])
    langs, scores = model.predict(["", " 12 !", "the garden", "das haus", "qqqqqq", "A"], model.false_positives())
    assert langs == ["und", "und", "en", "de", "en", "en"] and scores[:2] == [0.0, 0.0] and scores[2] > 0.5 and scores[4] == 0.0
    empty = language.Model.build([], [])
    assert empty.predict(["abc", ""], empty.false_positives()) == (["und", "und"], [0.0, 0.0])


def test_training_ignores_held_out_rows(spark):
    keys = [i for i in range(400) if zlib.crc32(str(i).encode()) % 5]
    out = [i for i in range(400) if i not in keys]
    rows = [(i, "the house and the garden", "en") for i in keys[:100]] + [(i, "das haus und der garten", "de") for i in keys[100:200]]
    rows += [(i, "zzz yyy xxx www", "zz") for i in out] + [(None, "vvv uuu ttt", "vv")]
    model = language.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert set(model.languages) == {"en", "de"}


def test_edge_rows(spark):
    df = edge_docs(spark)
    got = rows_by_key(language.identify(df, language.fit(df)))
    assert [got[k][0]["lang_pred"] for k in (2, 3, 4)] == ["und"] * 3 and len(got[7]) == 2
    assert language.fit(empty_docs(spark)).languages == ()
    assert {r["lang_pred"] for r in language.identify(df, language.fit(empty_docs(spark))).collect()} == {"und"}
    assert language.identify(empty_docs(spark), language.fit(df)).count() == 0


def test_no_language_is_left_out(spark):
    """300 languages, each with letters of its own: all are learned and found, in words of 64 bits."""
    def text(k):
        word = "".join(chr(0x4E00 + 30 * k + i) for i in range(6))
        return f"{word} {word[::-1]} {word}"
    docs = spark.createDataFrame([(10 * k + i, text(k), f"l{k:03d}") for k in range(300) for i in range(3)], "doc_id long, text string, lang string")
    model = language.fit(docs)
    learned = {r["lang"] for r in docs.where(~language.held_out(language.F.col("doc_id"))).collect()}
    assert set(model.languages) == learned and len(learned) >= 295 and model.bits.shape[0] == 5
    rows = docs.join(language.identify(docs, model), language.F.col("doc_id") == language.F.col("key")).where(language.F.col("lang").isin(*learned)).collect()
    assert all(r["lang"] == r["lang_pred"] for r in rows)


def exact_prediction(members, text):
    """Shares of a text's n-grams that are in each language's exact set."""
    hashes, _, lettered = language.grams([text])
    total = max(1, len(hashes))
    return [sum(int(h) in m for h in hashes) / total for m in members], bool(lettered[0])


def test_predictions_against_exact_sets(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()
    rng = np.random.default_rng(2)
    names = ["de", "en", "es", "fr"]
    sets = [np.unique(np.concatenate([language.grams([r["text"]])[0] for r in docs if r["lang"] == n and r["text"]][:30])) for n in names]
    model = language.Model.build(names, [s[rng.random(len(s)) < 0.5] for s in sets])
    rng = np.random.default_rng(2)
    members = [set(s[rng.random(len(s)) < 0.5].tolist()) for s in sets]
    texts = [r["text"] for r in docs if r["text"]]
    got, scores = model.predict(texts, model.false_positives())
    for text, lang, score in zip(texts, got, scores):
        share, lettered = exact_prediction(members, text)
        if lettered and sorted(share)[-1] - sorted(share)[-2] > 0.05:          # beyond what false positives of the filter can move
            assert lang == names[int(np.argmax(share))] and abs(score - max(share) / sum(share)) < 0.05
