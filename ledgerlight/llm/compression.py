"""Operator 11: a quality classifier that compresses.

Two zstandard dictionaries are trained, one from good and one from bad
labelled texts. A text is compressed twice, with one and with the other: the
dictionary of its own kind saves more bytes. The difference of the compressed
sizes by raw byte is the only feature; a logistic curve, fitted on labelled
texts that the dictionaries have not seen, turns it into a score.

Texts are compressed whole, in pieces of ``PIECE`` bytes, each with a fresh
window: so the dictionary, not the text's own beginning, stands for what is
expected, and the difference does not fade out in long texts.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlight.llm.shared import ship

#: Bound of the training sample: labelled rows per class, in the order of a hash of their ids.
SAMPLE_ROWS = 6_000
#: A sample text gives at most so many pieces to a dictionary, spread over the whole text.
SAMPLE_PIECES = 8
PIECE = 512
DICTIONARY_BYTES = 112 << 10
LEVEL = 3
#: Added to the raw size, so that a few bytes are not taken for evidence.
FEW_BYTES = 16
ACCEPT = 0.7


def held_out(key: Column) -> Column:
    """Rows that no label is learned from (a null id is not one of them)."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def pieces(text: bytes) -> list[bytes]:
    return [text[i:i + PIECE] for i in range(0, len(text), PIECE)]


@dataclass(frozen=True)
class Model:
    """Two dictionaries (their bytes) and the curve ``1 / (1 + exp(-(slope * difference + offset)))``."""
    good: bytes
    bad: bytes
    slope: float
    offset: float

    def score(self, difference: np.ndarray) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(-np.clip(self.slope * difference + self.offset, -500, 500)))


class Sizes:
    """Compressors of a task."""

    def __init__(self, good: bytes, bad: bytes) -> None:
        self._pair = [self._compressor(d) for d in (good, bad)]

    @staticmethod
    def _compressor(dictionary: bytes) -> zstandard.ZstdCompressor:
        if not dictionary:
            return zstandard.ZstdCompressor(level=LEVEL, write_content_size=False)
        d = zstandard.ZstdCompressionDict(dictionary)
        d.precompute_compress(level=LEVEL)
        return zstandard.ZstdCompressor(level=LEVEL, dict_data=d, write_content_size=False, write_dict_id=False)

    def difference(self, text: str | None) -> float:
        """(size with the bad dictionary - size with the good one) / raw size; 0 without text."""
        raw = (text or "").encode("utf-8", "surrogatepass")
        if not raw:
            return 0.0
        cut = pieces(raw)
        good, bad = (sum(len(c.compress(p)) for p in cut) for c in self._pair)
        return (bad - good) / (len(raw) + FEW_BYTES)


def dictionary(samples: list[bytes]) -> bytes:
    """A trained dictionary; too few samples to train on become the dictionary themselves."""
    total = sum(map(len, samples))
    try:
        return zstandard.train_dictionary(max(1024, min(DICTIONARY_BYTES, total // 4)), samples).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[:DICTIONARY_BYTES]


def curve(differences: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Slope and offset of the logistic curve (Newton's method, a weak pull of the slope to zero). Without both
    labels the slope is zero and the offset the smoothed share of good texts."""
    good = float(labels.sum())
    share = math.log((good + 1) / (len(labels) - good + 1))
    if good in (0.0, float(len(labels))):
        return 0.0, share
    scale = max(float(np.std(differences)), 1e-12)
    x = np.column_stack([differences / scale, np.ones(len(labels))])
    pull = np.diag([1e-3, 1e-9])
    w = np.array([0.0, share])

    def loss(w: np.ndarray) -> float:
        z = x @ w
        return float(np.sum(np.logaddexp(0, z) - labels * z) + w @ pull @ w / 2)

    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -500, 500)))
        grad = x.T @ (p - labels) + pull @ w
        step = np.linalg.solve((x * (p * (1 - p) + 1e-12)[:, None]).T @ x + pull, grad)
        now, size = loss(w), 1.0
        while loss(w - size * step) > now and size > 1e-6:
            size /= 2
        w = w - size * step
        if np.abs(size * step).max() < 1e-10:
            break
    return float(w[0] / scale), float(w[1])


def _sample(docs: DataFrame, labels: DataFrame, key: str, text: str, label: str) -> DataFrame:
    """``key, label, text``: the bounded training sample, one text per id (of repeated ids the one with the
    smallest hash); ids with both labels, null labels and held-out ids are not in it."""
    of = (labels.select(F.col(f"`{key}`").alias("key"), F.col(f"`{label}`").cast("int").alias("label"))
          .where(F.col("key").isNotNull() & F.col("label").isin(0, 1) & ~held_out(F.col("key")))
          .groupBy("key").agg(F.min("label").alias("label"), F.max("label").alias("_other")).where("label = _other").drop("_other"))
    order = [F.xxhash64("key"), F.col("key")]
    chosen = of.where("label = 0").orderBy(*order).limit(SAMPLE_ROWS).union(of.where("label = 1").orderBy(*order).limit(SAMPLE_ROWS))
    rows = docs.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("text")).where(F.length("text") > 0)
    found = rows.join(F.broadcast(chosen), "key")                      # at most 2 * SAMPLE_ROWS ids
    return found.groupBy("key", "label").agg(F.min(F.struct(F.xxhash64("text").alias("h"), "text"))["text"].alias("text"))


#: The part of the sample that fits the curve instead of the dictionaries.
_FOR_CURVE = "pmod(xxhash64(key, 1), 3) = 0"


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality") -> Model:
    """Learn from labelled rows that are not held out.

    The driver gets at most ``2 * SAMPLE_ROWS * SAMPLE_PIECES`` pieces of ``PIECE`` bytes and at most
    ``2 * SAMPLE_ROWS`` differences, however large the tables are. Without labelled texts every score is 0.5.
    """
    spark = ship(docs.sparkSession)
    sample = _sample(docs, labels, key, text, label)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: tuple[list, list, list, list] = ([], [], [], [])
            for k, y, t in zip(batch.column(0), batch.column(1), batch.column(2)):
                whole = pieces(t.as_py().encode("utf-8", "surrogatepass"))
                for n in sorted({i * len(whole) // SAMPLE_PIECES for i in range(SAMPLE_PIECES)}):
                    for column, value in zip(out, (str(k.as_py()), y.as_py(), n, whole[n])):
                        column.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, t in zip(out, (pa.string(), pa.int32(), pa.int32(), pa.binary()))],
                                             ["key", "label", "n", "piece"])

    seen = sorted(sample.where(f"NOT {_FOR_CURVE}").mapInArrow(cut, "key string, label int, n int, piece binary").collect())
    good, bad = (dictionary([bytes(r["piece"]) for r in seen if r["label"] == y]) for y in (1, 0))

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sizes = Sizes(good, bad)
        for batch in batches:
            found = [sizes.difference(t.as_py()) for t in batch.column(2)]
            yield pa.RecordBatch.from_arrays([batch.column(1), pa.array(found, type=pa.float64())], ["label", "difference"])

    points = sorted(tuple(r) for r in sample.where(_FOR_CURVE).mapInArrow(measure, "label int, difference double").collect())
    slope, offset = curve(np.array([p[1] for p in points]), np.array([p[0] for p in points], dtype=float))
    return Model(good, bad, slope, offset)


def classify(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, score, difference`` for every row, from its whole text alone.

    Null and empty texts have difference 0, the middle of the curve's axis. Repeated rows get equal scores, an empty table none. Only
    ``key`` and ``text`` are read, so extra columns of any name are ignored; keys keep their type and value.
    """
    rows = docs.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("text"))
    kind = rows.schema["key"].dataType.simpleString()
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sizes = Sizes(model.good, model.bad)
        for batch in batches:
            found = np.array([sizes.difference(t.as_py()) for t in batch.column(1)], dtype=float)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(model.score(found)), pa.array(found)], ["key", "score", "difference"])

    return rows.mapInArrow(run, f"key {kind}, score double, difference double")


def op11_quality_classifier(spark, sf_dir: str) -> DataFrame:
    """Every document with its quality score; ``held_out`` rows took no part in learning."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    found = classify(docs, model)
    return found.select(F.col("key").cast("long").alias("doc_id"), held_out(F.col("key")).alias("held_out"), "score",
                        (F.col("score") >= ACCEPT).cast("int").alias("predicted"))
