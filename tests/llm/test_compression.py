import math
import zlib

import numpy as np
import zstandard
from pyspark.sql import functions as F

from edges import edge_docs, empty_docs, rows_by_key
from ledgerlight.llm import compression

SF = "/root/testdata/sf0.01"


def _docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")


def test_held_out_accuracy_and_scores_by_brute_force(spark):
    docs, labels = _docs(spark)
    quality = {r["doc_id"]: r["quality"] for r in labels.collect()}
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    rows = compression.op11_quality_classifier(spark, SF).collect()
    assert len(rows) == docs.count() and all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in rows)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.7) for r in rows)
    held = [(quality[r["doc_id"]], r["predicted"]) for r in rows if r["held_out"] and r["doc_id"] in quality]
    assert len(held) > 60 and np.mean([a == b for a, b in held]) >= 0.93
    model = compression.fit(docs, labels)

    def size(data, text):
        d, total = zstandard.ZstdCompressionDict(data), 0
        d.precompute_compress(level=3)
        for i in range(0, len(text), 512):
            frame = zstandard.ZstdCompressor(level=3, dict_data=d, write_content_size=False, write_dict_id=False).compress(text[i:i + 512])
            assert zstandard.ZstdDecompressor(dict_data=d).decompress(frame, max_output_size=512) == text[i:i + 512]
            total += len(frame)
        return total

    for r in rows[::25]:
        t = (texts[r["doc_id"]] or "").encode()
        d = (size(model.bad, t) - size(model.good, t)) / (len(t) + 16) if t else 0.0
        assert abs(r["score"] - 1 / (1 + math.exp(-(model.slope * d + model.offset)))) < 1e-9


def test_nothing_but_learnable_labels_and_texts_counts(spark):
    docs, labels = _docs(spark)
    wrong = labels.withColumn("quality", F.when(compression.held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    other = docs.withColumns({"lang": F.lit("xx"), "source": F.lit("s"), "n_chars": F.lit(1)})
    assert compression.fit(other, wrong) == compression.fit(docs, labels)
    conflicting = labels.unionByName(labels.where("quality = 0").withColumn("quality", F.lit(1)))       # no bad label is left
    model = compression.fit(docs, conflicting)
    assert model.slope == 0 and 0.5 < model.score(np.array([0.0]))[0] < 1


def test_edges(spark):
    docs, labels = _docs(spark)
    model = compression.fit(docs, labels)
    rows = compression.classify(edge_docs(spark), model).collect()
    assert len(rows) == edge_docs(spark).count() and all(0 <= r["score"] <= 1 for r in rows)
    by = rows_by_key(edge_docs(spark).select(F.col("doc_id").alias("key"), "text"))
    got = rows_by_key(compression.classify(edge_docs(spark), model))
    middle = model.score(np.array([0.0]))[0]
    assert got[2][0]["score"] == got[3][0]["score"] == middle and by[2][0]["text"] is None
    assert got[7][0] == got[7][1] and got[1][0]["score"] == got[7][0]["score"] == got[None][0]["score"]
    assert compression.classify(empty_docs(spark), model).count() == 0
    none = compression.fit(empty_docs(spark), labels)
    assert none.slope == 0 and none.score(np.array([0.3]))[0] == 0.5
    big = spark.createDataFrame([(2**53 + 1, "a b"), (None, "c")], "doc_id long, text string").coalesce(1)
    assert {r["key"] for r in compression.classify(big, model).collect()} == {2**53 + 1, None}


def test_the_sample_is_bounded_and_one_text_per_id(spark, monkeypatch):
    monkeypatch.setattr(compression, "SAMPLE_ROWS", 5)
    docs = spark.range(200).select((F.col("id") % 50).alias("doc_id"), F.concat(F.lit("text "), F.col("id")).alias("text"))
    labels = spark.range(50).select(F.col("id").alias("doc_id"), (F.col("id") % 2).cast("int").alias("quality"))
    rows = compression._sample(docs, labels, "doc_id", "text", "quality").collect()
    assert len(rows) == 10 and len({r["key"] for r in rows}) == 10


def test_dictionaries_of_few_samples(spark):
    assert compression.dictionary([]) == b"" and compression.dictionary([b"abc"]) == b"abc"
    assert compression.Sizes(b"", b"the same words again " * 4).difference("the same words again") < 0
