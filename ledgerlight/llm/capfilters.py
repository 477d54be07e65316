"""Near-duplicate vectors by spherical-cap filters (locality-sensitive filtering with random product codes).

A filter is a direction; its cap holds the vectors that point almost its way. Directions form a product code: after
a fixed random rotation the space is cut into two halves with a small random code each, and every pair of code
words is a direction. So the best directions of a vector are decoded from two short score lists, without scoring
all. Each vector lists all directions whose score is within ``margin`` of its best one. Two vectors meet in a
filter that is the best of one and on the list of the other; met pairs are verified exactly.

Equal vectors are one class with a multiplicity. Filters with many vectors are cut into blocks of bounded size and
every pair of blocks is a group of its own, so no task holds more than two blocks at once. Groups report link
counts and a spanning forest of their links instead of all pairs.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlight.llm.shared import components, ship, stored

THRESHOLD = 0.98
#: Scores within this of the best are listed: about three standard errors of a pair at the threshold in 64 dimensions.
#: These errors shrink with the root of the dimension, and the margin with them (``fitted``).
MARGIN, MARGIN_DIM = 0.08, 64
#: Vectors that a filter should hold on average, and bounds of a half's code.
PER_FILTER, LEAST_CODE, MOST_CODE = 64, 16, 4096
#: Vectors of one block of a filter.
BLOCK = 512


@functools.lru_cache(maxsize=8)
def product_code(dim: int, size: int, seed: int = 5) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A random rotation of ``dim`` dimensions and two codes of ``size`` unit vectors for its halves."""
    random = np.random.default_rng([seed, dim, size])
    rotation = np.linalg.qr(random.standard_normal((dim, dim)))[0]
    halves = []
    for d in (dim // 2, dim - dim // 2):
        words = random.standard_normal((size, max(d, 1)))[:, :d]
        halves.append(words / np.maximum(np.linalg.norm(words, axis=1, keepdims=True), 1e-300) / np.sqrt(2))
    return rotation, halves[0], halves[1]


def fitted(dim: int, size: int, margin: float) -> tuple[int, float]:
    """Code size of a half and margin for vectors of ``dim`` dimensions, so that lists stay short in all of them: few
    dimensions have room for few distinct directions, many have scores that differ little."""
    return min(size, 8 << dim // 2), margin * min(1.0, float(np.sqrt(MARGIN_DIM / dim)))


def decode(units: np.ndarray, size: int, margin: float) -> tuple[np.ndarray, list[np.ndarray]]:
    """Best direction and list of directions within ``margin`` of it for each unit vector."""
    rotation, one, two = product_code(units.shape[1], size)
    turned = units @ rotation
    a, b = turned[:, :one.shape[1]] @ one.T, turned[:, one.shape[1]:] @ two.T
    best_a, best_b = a.argmax(axis=1), b.argmax(axis=1)
    lists = []
    for i in range(len(units)):
        top_a, top_b = a[i, best_a[i]], b[i, best_b[i]]
        ia, ib = np.flatnonzero(a[i] >= top_a - margin), np.flatnonzero(b[i] >= top_b - margin)
        near = (top_a - a[i, ia])[:, None] + (top_b - b[i, ib])[None, :] <= margin
        lists.append((ia[:, None] * size + ib[None, :])[near])
    return best_a * size + best_b, lists


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return np.asarray(column.flatten(), dtype=np.float64).reshape(-1, dim)


def links(first: np.ndarray, second: np.ndarray, threshold: float) -> np.ndarray:
    """Which pairs have a cosine of at least ``threshold``, in double precision."""
    a = np.linalg.norm(first, axis=1)
    b = np.linalg.norm(second, axis=1)
    return (first @ second.T) / a[:, None] / b[None, :] >= threshold


def near_vectors(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label",
                 threshold: float = THRESHOLD, margin: float = MARGIN) -> DataFrame:
    """``key, n_links, component``: one row per input row, each linked to the near vectors of its label.

    Compared are rows with equal, non-null labels and equal dimensions. Null, empty or zero vectors, vectors with
    null or non-finite components, and rows without a key link with nothing: 0 links, their own key as component.
    Repeated rows count as vectors of their own. An empty table gives no rows. Other columns are not read.
    Links below ``threshold`` never occur; links at it are found unless rounding of the scores hides both vectors'
    best directions from the other's list (recall is measured in the tests).
    """
    ship(vectors.sparkSession)
    v = F.col("vector")
    rows = vectors.select(F.col(f"`{key}`").cast("long").alias("key"), F.col(f"`{vector}`").cast("array<double>").alias("vector"), F.col(f"`{label}`").alias("label"))
    finite = F.coalesce(F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))), F.lit(False))
    sound = F.col("key").isNotNull() & F.col("label").isNotNull() & finite & F.coalesce(F.exists(v, lambda x: x != 0), F.lit(False))
    marked = rows.select("key", F.when(sound, F.col("label")).alias("label"), F.when(sound, v).alias("vector"),
                         F.xxhash64(F.lit(1), "vector").alias("h1"), F.xxhash64(F.lit(2), "vector").alias("h2"), sound.alias("sound"))
    classes = (marked.where("sound").groupBy("label", "h1", "h2")
               .agg(F.min("key").alias("rep"), F.count("*").alias("n"), F.first("vector").alias("vector")))
    # one id per class: a repeated key may hold several vectors
    classes = stored(classes.select(F.xxhash64("label", "h1", "h2").alias("node"), "label", "rep", "n", "vector"), "classes")
    size = int(min(MOST_CODE, max(LEAST_CODE, np.ceil(np.sqrt(classes.count() / PER_FILTER)))))

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = np.diff(np.asarray(batch.column(1).offsets))
            best, lists = np.zeros(len(dims), dtype=np.int64), [np.zeros(0, dtype=np.int64)] * len(dims)
            for d in np.unique(dims):
                own = np.flatnonzero(dims == d)
                units = _matrix(batch.column(1).take(pa.array(own)), int(d))
                units = units / np.abs(units).max(axis=1, keepdims=True)
                units = units / np.linalg.norm(units, axis=1, keepdims=True)
                b, some = decode(units, *fitted(int(d), size, margin))
                best[own] = b
                for i, x in zip(own, some):
                    lists[i] = x
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(best), pa.array(lists, type=pa.list_(pa.int64()))], ["node", "best", "filters"])

    coded = (classes.select("node", "vector").mapInArrow(code, "node long, best long, filters array<long>")
             .join(classes.select("node", "label", F.size("vector").alias("dim"), "n"), "node"))
    coded = stored(coded, "codes")

    # members of each filter; hot filters are cut into blocks, and every pair of blocks meets once
    members = coded.select("node", "label", "dim", "best", F.explode("filters").alias("filter"))
    counts = (members.groupBy("label", "dim", "filter").agg(F.count("*").alias("size"), F.max((F.col("best") == F.col("filter")).cast("int")).alias("home"))
              .where("size > 1 and home = 1").select("label", "dim", "filter", F.ceil(F.col("size") / BLOCK).cast("int").alias("blocks")))
    placed = members.join(counts, ["label", "dim", "filter"]).withColumn("own", F.pmod(F.xxhash64("node", "filter"), F.col("blocks")).cast("int"))
    placed = placed.select("node", "filter", "own", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    placed = placed.select("node", "filter", "own", F.least("own", "other").alias("a"), F.greatest("own", "other").alias("b"))
    full = placed.join(coded, "node").join(classes.select("node", "vector"), "node")
    groups = (full.select("label", "dim", "filter", "a", "b", "own", "node", "n", "best", "filters", "vector")
              .repartition("label", "dim", "filter", "a", "b").sortWithinPartitions("label", "dim", "filter", "a", "b", "own", "node"))

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: pa.Table | None = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            waiting = table if waiting is None else pa.concat_tables([waiting, table]).combine_chunks()
            cut = _starts(waiting)
            if len(cut) > 1:                    # the last group may go on in the next batch
                yield from _verified(waiting.slice(0, int(cut[-1])), cut[:-1], threshold)
                waiting = waiting.slice(int(cut[-1]))
        if waiting is not None and len(waiting):
            yield from _verified(waiting, _starts(waiting), threshold)

    found = stored(groups.mapInArrow(verify, "a long, b long, n long"), "links")
    counted = found.where("b is null").groupBy(F.col("a").alias("node")).agg(F.sum("n").alias("linked"))
    parts = components(found.where("b is not null").select("a", "b"))
    smallest = parts.join(classes.select("node", "rep"), "node").groupBy("component").agg(F.min("rep").alias("smallest"))
    by_class = (classes.select("node", "rep", "n").join(counted, "node", "left").join(parts, "node", "left").join(smallest, "component", "left")
                .select("node", F.col("n").alias("copies"), "linked", F.coalesce("smallest", "rep").alias("component")))
    named = marked.select("key", F.when(F.col("sound"), F.xxhash64("label", "h1", "h2")).alias("node"))
    return (named.join(by_class, "node", "left")
            .select("key", F.coalesce(F.col("copies") - 1 + F.coalesce("linked", F.lit(0)), F.lit(0)).cast("long").alias("n_links"),
                    F.coalesce("component", "key").alias("component")))


def _starts(table: pa.Table) -> np.ndarray:
    """Rows at which a group (label, dim, filter, a, b) begins."""
    fresh = np.zeros(len(table), dtype=bool)
    fresh[:1] = True
    for name in ("label", "dim", "filter", "a", "b"):
        column = table.column(name).combine_chunks()
        values = np.asarray(column.dictionary_encode().indices if not pa.types.is_integer(column.type) else column)
        fresh[1:] |= values[1:] != values[:-1]
    return np.flatnonzero(fresh)


def _verified(table: pa.Table, starts: np.ndarray, threshold: float) -> Iterator[pa.RecordBatch]:
    """Links of each group: ``(node, null, other copies linked)`` and forest edges ``(node, node, null)``."""
    ends = [*starts[1:].tolist(), len(table)]
    get = {name: table.column(name).combine_chunks() for name in ("own", "a", "b", "filter", "node", "n", "best", "dim")}
    get = {k: np.asarray(x) for k, x in get.items()}
    vectors, lists = table.column("vector").combine_chunks(), table.column("filters").combine_chunks()
    out_a, out_b, out_n = [], [], []
    for s, e in zip(starts.tolist(), ends):
        if e - s < 2:
            continue
        f, own, best = get["filter"][s], get["own"][s:e], get["best"][s:e]
        data = _matrix(vectors.slice(s, e - s), int(get["dim"][s]))
        near = links(data, data, threshold)
        near[np.tril_indices(e - s)] = False
        if get["a"][s] != get["b"][s]:
            near &= own[:, None] != own[None, :]            # pairs inside a block belong to the block's own group
        home = best == f
        near &= home[:, None] | home[None, :]
        x, y = np.nonzero(near)
        if not len(x):
            continue
        # a pair that also meets in the other's best filter counts in the smaller of the two
        other = np.where(home[x], best[y], best[x])
        lesser = np.flatnonzero(other < f)
        drop = np.zeros(len(x), dtype=bool)
        if len(lesser):
            own_lists = [frozenset(v) for v in lists.slice(s, e - s).to_pylist()]
            for k in lesser:
                i, j = (x[k], y[k]) if home[x[k]] else (y[k], x[k])      # i at home here, j a guest
                drop[k] = int(best[j]) in own_lists[i]
        x, y = x[~drop], y[~drop]
        node, n = get["node"][s:e], get["n"][s:e]
        linked = np.bincount(x, weights=n[y], minlength=e - s) + np.bincount(y, weights=n[x], minlength=e - s)
        hit = np.flatnonzero(linked)
        out_a.append(node[hit])
        out_b.append(np.full(len(hit), -1))
        out_n.append(linked[hit].astype(np.int64))
        root = np.arange(e - s)
        edges = []
        for i, j in zip(x.tolist(), y.tolist()):
            while root[i] != i:
                root[i] = root[root[i]]
                i = root[i]
            while root[j] != j:
                root[j] = root[root[j]]
                j = root[j]
            if i != j:
                root[max(i, j)] = min(i, j)
                edges.append((i, j))
                if len(edges) == e - s - 1:
                    break
        if edges:
            i, j = np.asarray(edges).T
            out_a.append(node[i])
            out_b.append(node[j])
            out_n.append(np.full(len(i), -1))
    if out_a:
        a, b, n = (np.concatenate(c).astype(np.int64) for c in (out_a, out_b, out_n))
        yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b, mask=n >= 0), pa.array(n, mask=n < 0)], ["a", "b", "n"])


def op9_near_vectors(spark, sf_dir: str) -> DataFrame:
    """Every vector with its links, its component and whether it stays."""
    found = near_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    return found.select(F.col("key").alias("vec_id"), "n_links", F.col("component").alias("component_id"), (F.col("key") == F.col("component")).alias("kept"))
