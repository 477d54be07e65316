"""Helpers of the operators: shared scratch tables, word hashing, connected components."""

from __future__ import annotations

import contextlib
import os
import shutil
import tempfile
import uuid

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Words are runs of anything but ASCII white space.
SPACE_CLASS = r"[\x20\x09-\x0D]"
WORD_PATTERN = r"[^\x20\x09-\x0D]+"

MASK64 = (1 << 64) - 1


def scratch_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``; a local one is made only for a local master (tests)."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        path = tempfile.mkdtemp(prefix="ledgerlight-scratch-")
        spark.conf.set("spark.checkpoint.dir", path)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(path)
    return path.rstrip("/")


_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"


def ship(spark: SparkSession) -> SparkSession:
    """Send this package's code to the executors, once per application; Spark's own file server hands it out."""
    sc = spark.sparkContext
    if spark.conf.get(_BATCH, "10000") == "10000":      # rows are whole documents: shorter batches than the default
        spark.conf.set(_BATCH, "1024")
    if not getattr(sc, "_ledgerlight_shipped", False):
        root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
        folder = tempfile.mkdtemp(prefix="ledgerlight-code-")
        sc.addPyFile(shutil.make_archive(os.path.join(folder, "ledgerlight_code"), "zip", root, "ledgerlight"))
        sc._ledgerlight_shipped = True
    return spark


_SCOPE: list[str] = []


@contextlib.contextmanager
def scratch_scope(spark: SparkSession, name: str):
    """Tables that ``stored`` writes inside go to a folder of their own, emptied first: for work in stages whose
    results are written before the next stage begins, so that a stage's leftovers go when the next one starts."""
    _remove(spark, f"{_scratch_folder(spark)}/{name}")
    _SCOPE.append(name)
    try:
        yield
    finally:
        _SCOPE.pop()


def _scratch_folder(spark: SparkSession) -> str:
    return f"{scratch_root(spark)}/ledgerlight-llm/{spark.sparkContext.applicationId}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to a fresh table in the shared folder and read it back.

    Cuts the lineage with a copy that survives lost executors. The folder is
    ``<root>/ledgerlight-llm/<application>/...``; ``clear_scratch`` removes it.
    """
    spark = df.sparkSession
    path = "/".join([_scratch_folder(spark), *_SCOPE, f"{name}-{uuid.uuid4().hex[:12]}"])
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._scratch_path = path
    return out


def _remove(spark: SparkSession, path: str) -> None:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def discard(df: DataFrame) -> None:
    """Remove the table of ``stored`` once everything that is derived from it is stored itself."""
    _remove(df.sparkSession, df._scratch_path)


def clear_scratch(spark: SparkSession) -> None:
    """Remove this application's scratch tables; call it once the results are written."""
    _remove(spark, _scratch_folder(spark))


#: Keys that are broadcast to find their rows; more of them go to the rows by a shuffle.
FEW = 1_000_000


def few(keys: DataFrame) -> DataFrame:
    """A one-column frame of numbers, to be broadcast if a count proves that there are few of them."""
    return F.broadcast(keys) if keys.limit(FEW + 1).count() <= FEW else keys


def count_words(text: Column) -> Column:
    """Number of words of ``text`` (null: 0) as long."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD_PATTERN)), F.lit(0)).cast("long")


def free_name(df: DataFrame, base: str) -> str:
    """A column name that ``df`` does not have (extra columns may clash with ours)."""
    taken = {c.lower() for c in df.columns}
    name = base
    while name.lower() in taken:
        name += "_"
    return name


# ---------------------------------------------------------------- hashing

def mix64(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finalizer (multiply and xor-shift), vectorised and wrapping."""
    x = np.asarray(x, dtype=np.uint64).copy()
    x ^= x >> np.uint64(31)
    x *= np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    return x


_BASE = 0x2545F4914F6CDD1D | 1
_TABLE = mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xA24BAED4963EE407))
_POWERS: list[np.ndarray] = []


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """``_BASE ** j`` and its inverse powers modulo 2**64 for j < n (kept between calls)."""
    if not _POWERS or len(_POWERS[0]) < n:
        size = max(n, 1 << 16)
        _POWERS.clear()
        for base in (_BASE, pow(_BASE, -1, 1 << 64)):
            p = np.empty(size, dtype=np.uint64)
            p[0], filled = 1, 1
            while filled < size:
                take = min(filled, size - filled)
                p[filled:filled + take] = p[:take] * np.uint64(pow(base, filled, 1 << 64))
                filled += take
            _POWERS.append(p)
    return _POWERS[0][:n], _POWERS[1][:n]


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of the bytes ``data[start:end]`` of every span; equal bytes give equal hashes.

    A polynomial over random byte values modulo 2**64, from prefix sums, so all
    spans of a buffer cost a few vector operations.
    """
    up, down = _powers(len(data) + 1)
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(_TABLE[data] * up[:-1], out=sums[1:])
    poly = (sums[ends] - sums[starts]) * down[starts]
    return mix64(poly + (ends - starts).astype(np.uint64) * np.uint64(0x9FB21C651E98DF25))


_IS_SPACE = np.zeros(256, dtype=bool)
_IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def word_spans(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words in a buffer of UTF-8 bytes."""
    inside = np.zeros(len(data) + 2, dtype=np.int8)
    inside[1:-1] = ~_IS_SPACE[data]
    step = np.diff(inside)
    return np.flatnonzero(step == 1), np.flatnonzero(step == -1)


def lower_ascii(data: np.ndarray) -> np.ndarray:
    """A-Z to a-z, other bytes unchanged."""
    return np.where((data >= 65) & (data <= 90), data + np.uint8(32), data)


def fold_grams(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hashes of all runs of ``n`` consecutive hashes (empty if there are fewer)."""
    if len(hashes) < n:
        return hashes[:0]
    out = np.zeros(len(hashes) - n + 1, dtype=np.uint64)
    for j in range(n):
        out = mix64(out + hashes[j:len(hashes) - n + 1 + j] * np.uint64(2 * j + 0x9E3779B1))
    return out


def text_chunks(texts: list[str], limit: int = 1 << 19):
    """Split a batch into runs of texts of about ``limit`` bytes: yields (indices, list of UTF-8 bytes)."""
    some, own, size = [], [], 0
    for i, t in enumerate(texts):
        b = t.encode("utf-8", "surrogatepass")
        own.append(b)
        some.append(i)
        size += len(b)
        if size >= limit:
            yield some, own
            some, own, size = [], [], 0
    if some:
        yield some, own


# ------------------------------------------------------ connected components

def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Connected components of undirected edges ``(a long, b long)``: ``(node, component)``, component = smallest node.

    Every round each node points at the smallest label among itself and its
    neighbours, then labels are shortened by following them once (pointer
    jumping), so the rounds grow with the logarithm of a component's
    diameter. Only minima are aggregated (partial sums, no neighbour lists),
    so a hub of any degree is safe. Labels are checkpointed every round.
    """
    spark = edges.sparkSession
    scratch_root(spark)
    pairs = (edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
             .distinct().checkpoint())
    both = pairs.select("a", "b").union(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
    labels = (both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m"))
              .select("node", F.least("node", "m").alias("component")).checkpoint())
    for _ in range(max_rounds):
        of_b = labels.select(F.col("node").alias("b"), F.col("component").alias("label"))
        near = both.join(of_b, "b").groupBy(F.col("a").alias("node")).agg(F.min("label").alias("label"))
        # a node's old label learns the smaller labels seen by all nodes that carry it
        seen = labels.join(near, "node").select("node", "component", F.least("component", "label").alias("new"))
        hooked = seen.groupBy(F.col("component").alias("root")).agg(F.min("new").alias("hook"))
        moved = (seen.join(hooked, F.col("component") == F.col("root"))
                 .select("node", "component", F.least("new", "hook").alias("new")))
        jump = hooked.select(F.col("root").alias("new"), F.col("hook").alias("far"))
        after = (moved.join(jump, "new", "left")
                 .select("node", F.col("component").alias("old"), F.least("new", F.coalesce("far", "new")).alias("component"))
                 .checkpoint())
        changed = after.where("component <> old").limit(1).count()
        labels = after.select("node", "component")
        if not changed:
            return labels
    raise RuntimeError("components did not settle; raise max_rounds")
