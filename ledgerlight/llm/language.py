"""Language identification by bit-sliced Bloom filters of character n-grams.

Training counts, over a bounded sample of labelled documents per language, in how many documents each n-gram
occurs; a language keeps its most common n-grams. All languages share one Bloom filter whose slots hold a bit per
language, so one lookup (the AND of a few slots) returns all languages that contain an n-gram. A text's n-grams
are looked up at once; the hits per language, less the filter's own false positives, decide.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerlight.llm.shared import mix64, ship, text_chunks

N = 4
#: Bounds of the training: sampled documents of a language, its n-grams, and the n-grams of all languages together,
#: which are shared evenly. No language is left out: the filter's words grow with the languages found.
SAMPLE_DOCS, GRAMS, ALL_GRAMS = 4000, 20_000, 5_000_000
#: An n-gram belongs to a language if at least this share of its documents has it, and this share of the best language's.
LEAST_SHARE, LEAST_RATIO = 0.002, 0.2
PROBES = 3
SLOTS = 1 << 19
UNDETERMINED = "und"


@functools.lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    table = np.zeros(0x110000, dtype=bool)
    table[[i for i in range(0x110000) if chr(i).isalpha()]] = True
    return table


def grams(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of the n-grams of all texts, the text of each, and which texts have letters.

    Texts are lower-cased, everything but letters becomes a blank; n-grams with fewer than ``N - 1`` letters are left out.
    """
    joined = "".join(f" {t.lower()} " + " " * N for t in texts)
    points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    sizes = np.array([len(t.lower()) + 2 + N for t in texts], dtype=np.int64)
    doc = np.repeat(np.arange(len(texts)), sizes)
    letter = _letters()[points]
    points = np.where(letter, points, 32).astype(np.uint64)
    count = len(points) - N + 1
    code, inside = np.zeros(count, dtype=np.uint64), np.zeros(count, dtype=np.int8)
    for j in range(N):
        code = code * np.uint64(0x110001) + points[j:j + count]
        inside += letter[j:j + count]
    take = inside >= N - 1
    return mix64(code[take]), doc[:count][take], np.bincount(doc[letter], minlength=len(texts)) > 0


def _slots(hashes: np.ndarray, slots: int) -> list[np.ndarray]:
    a, b = hashes & np.uint64(0xFFFFFFFF), (hashes >> np.uint64(32)) | np.uint64(1)
    return [((a + np.uint64(i) * b) % np.uint64(slots)).astype(np.int64) for i in range(PROBES)]


@dataclass(frozen=True)
class Model:
    """Languages, most frequent first, and slots x words of 64 language bits."""

    languages: tuple[str, ...]
    bits: np.ndarray

    @classmethod
    def build(cls, languages: list[str], members: list[np.ndarray], slots: int = SLOTS) -> Model:
        bits = np.zeros((max(1, -(-len(languages) // 64)), slots), dtype=np.uint64)
        for k, own in enumerate(members):
            for at in _slots(own, slots):
                np.bitwise_or.at(bits[k // 64], at, np.uint64(1 << k % 64))
        return cls(tuple(languages), bits)

    def false_positives(self) -> np.ndarray:
        """Chance that a foreign n-gram hits a language: its share of set slots to the power of the probes."""
        share = [np.mean((self.bits[k // 64] >> np.uint64(k % 64)) & np.uint64(1)) for k in range(len(self.languages))]
        return np.asarray(share) ** PROBES

    def predict(self, texts: list[str], false_positives: np.ndarray) -> tuple[list[str], list[float]]:
        hashes, doc, lettered = grams(texts)
        at = _slots(hashes, self.bits.shape[1])
        total = np.maximum(np.bincount(doc, minlength=len(texts)), 1)
        hits = np.zeros((len(texts), max(1, len(self.languages))))
        for word in range(self.bits.shape[0]):
            found = functools.reduce(np.bitwise_and, (self.bits[word][a] for a in at))
            for k in range(64 * word, min(64 * word + 64, len(self.languages))):
                own = (found >> np.uint64(k - 64 * word)) & np.uint64(1)
                hits[:, k] = np.bincount(doc, weights=own, minlength=len(texts))
        if not self.languages:
            return [UNDETERMINED] * len(texts), [0.0] * len(texts)
        share = np.clip((hits / total[:, None] - false_positives) / np.maximum(1 - false_positives, 1e-9), 0, 1)
        best, mass = share.argmax(axis=1), share.sum(axis=1)
        score = np.where(mass > 0, share[np.arange(len(texts)), best] / np.where(mass > 0, mass, 1), 0.0)
        return ([self.languages[b] if ok else UNDETERMINED for b, ok in zip(best, lettered)],
                [float(s) if ok else 0.0 for s, ok in zip(score, lettered)])


def held_out(key: Column) -> Column:
    """Rows that training never sees: CRC-32 of the key as text is divisible by 5 (null key: the empty text)."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % 5 == 0


def fit(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", sample_docs: int = SAMPLE_DOCS) -> Model:
    """Learn from rows with text and language that are not held out; at most about ``sample_docs`` rows per language.

    The sample is a hash threshold per language, so it is the same in every run. The driver gets the language
    counts and at most ``ALL_GRAMS`` n-gram hashes (one per language at least).
    """
    spark = ship(docs.sparkSession)
    rows = docs.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("text"), F.col(f"`{lang}`").cast("string").alias("lang"))
    rows = rows.where(F.col("text").isNotNull() & F.col("lang").isNotNull() & ~held_out(F.col("key")))
    counts = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "lang").collect()}
    if not counts:
        return Model.build([], [])
    spark_hash = F.pmod(F.xxhash64("key"), F.lit(1_000_000))
    limit = spark.createDataFrame([(k, -(-1_000_000 * sample_docs // n)) for k, n in counts.items()], "lang string, most long")
    sample = rows.join(F.broadcast(limit), "lang").where(spark_hash < F.col("most")).select("lang", "text")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for some, _ in text_chunks(texts):
                hashes, doc, _ = grams([texts[i] for i in some])
                order = np.lexsort((hashes, doc))
                h, d = hashes[order], doc[order]
                fresh = np.ones(len(h), dtype=bool)
                fresh[1:] = (h[1:] != h[:-1]) | (d[1:] != d[:-1])
                h, of = h[fresh], np.array([langs[i] for i in some], dtype=object)[d[fresh]]
                for name in sorted(set(of)):
                    values, n = np.unique(h[of == name], return_counts=True)
                    yield pa.RecordBatch.from_arrays([pa.array([name] * len(values)), pa.array(values.view(np.int64)), pa.array(n)], ["lang", "gram", "n"])

    found = sample.mapInArrow(count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    sizes = spark.createDataFrame([(k, float(min(n, sample_docs))) for k, n in counts.items()], "lang string, docs double")
    found = (found.join(F.broadcast(sizes), "lang").withColumn("share", F.col("n") / F.col("docs"))
             .where((F.col("share") >= LEAST_SHARE) & ((F.col("n") > 1) | (F.col("docs") < 50))))
    best = found.groupBy("gram").agg(F.max("share").alias("best"))
    kept = found.join(best, "gram").where(F.col("share") >= LEAST_RATIO * F.col("best"))
    top = Window.partitionBy("lang").orderBy(F.desc("n"), "gram")
    kept = kept.withColumn("nth", F.row_number().over(top)).where(F.col("nth") <= max(1, min(GRAMS, ALL_GRAMS // len(counts)))).select("lang", "gram").toPandas()
    by = {k: g.to_numpy(dtype=np.int64).view(np.uint64) for k, g in kept.groupby("lang")["gram"]}
    members = [by.get(k, np.zeros(0, dtype=np.uint64)) for k in counts]
    return Model.build(list(counts), members)


def identify(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, lang_pred, score`` for every row, from its whole text alone.

    ``und`` with score 0 for null texts and texts without letters (and if no language was learned). A text that
    no language's filter knows gets the most frequent language with score 0; ties go to the more frequent
    language. Repeated rows get equal results, an empty table none. Only ``key`` and ``text`` are read. The model
    that is broadcast has a fixed size: ``SLOTS`` x 8 bytes for each 64 languages.
    """
    rows = docs.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("text"))
    kind = rows.schema["key"].dataType.simpleString()
    shared = ship(docs.sparkSession).sparkContext.broadcast(model)
    rates = model.false_positives()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            langs, scores = [], []
            for some, _ in text_chunks(texts):
                a, b = shared.value.predict([texts[i] for i in some], rates)
                langs += a
                scores += b
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(langs, type=pa.string()), pa.array(scores, type=pa.float64())],
                                             ["key", "lang_pred", "score"])

    return rows.mapInArrow(run, f"key {kind}, lang_pred string, score double")


def op7_language_id(spark, sf_dir: str) -> DataFrame:
    """Every document with its predicted language; ``held_out`` rows took no part in training."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return identify(docs, fit(docs)).select(F.col("key").cast("long").alias("doc_id"), held_out(F.col("key")).alias("held_out"), "lang_pred", "score")
