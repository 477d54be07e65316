"""N-gram Jaccard join with a token-group matrix.

Texts become sets of word shingles; equal sets are one node. Candidates come from an exact signature: the shingles
of a set are dealt into ``m`` parts by hash, and two sets whose similarity reaches the threshold differ in fewer
shingles than there are parts, so at least one part is equal. A part is several shingles that must all agree, so
common passages or words make no hot keys; only real copies meet often.

1. Star rounds: a node is compared with one hub only, the node of its parts whose own parts are the most common; an
   original is the hub of its copies. Linked nodes form components; a second round has the hubs of what is apart.
2. Groups: the nodes of parts that still hold different components are partitioned into groups of similar sets
   (those with the same most common part, in buckets of a bounded number of shingles). A task opens a group by its token matrix: the
   union of its shingles, with the members that hold each. A query is first bounded by its overlap with the
   union; only if that could reach the threshold are its overlaps with the members counted.
3. Groups report links between different components only, so a copy group of any size adds a forest, not pairs.

Every link is exact, none is lost: what the star rounds do not connect is compared in step 2.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlight.llm.shared import components, discard, few, fold_grams, lower_ascii, mix64, ship, span_hashes, stored, text_chunks, word_spans

#: Sizes of a band grow by this factor; shingles of a group's members, and queries of a task's share of it.
BAND, GROUP_TOKENS, QUERIES = 1.45, 1 << 18, 1024
#: Rounds of comparisons with hubs before groups are opened.
STAR_ROUNDS = 2
#: Postings of a bucket of part keys.
BUCKET = 250_000
_FIRST_DOC = -(1 << 63)


def shingle_sets(raw: list[bytes], words: int) -> list[np.ndarray]:
    """Sorted hashes of the distinct shingles of each text; with fewer words the whole sequence is the only one."""
    data = lower_ascii(np.frombuffer(b"\n".join(raw) + b"\n", dtype=np.uint8))
    starts, ends = word_spans(data)
    hashes = span_hashes(data, starts, ends)
    edge = np.concatenate([[0], np.cumsum([len(t) + 1 for t in raw])])
    cut = np.searchsorted(starts, edge)
    grams = fold_grams(hashes, words)
    out = []
    for a, b in zip(cut[:-1].tolist(), cut[1:].tolist()):
        if b - a >= words:
            out.append(np.unique(grams[a:b - words + 1]))
        else:
            out.append(mix64(fold_grams(hashes[a:b], b - a) + np.uint64(b - a)) if b > a else hashes[:0])
    return out


@functools.lru_cache(maxsize=8)
def _edges() -> tuple[int, ...]:
    edges = [1]
    while edges[-1] < 1 << 40:
        edges.append(max(edges[-1] + 1, math.ceil(edges[-1] * BAND)))
    return tuple(edges)


@functools.lru_cache(maxsize=4096)
def parts_of_band(band: int, percent: int) -> tuple[int, int]:
    """(most shingles that differ, parts) for pairs whose smaller set is in the band.

    Sets of sizes s <= l with similarity t differ in at most (s + l)(1 - t) / (1 + t) <= s (1 - t) / t shingles. There
    are some more parts than that, so that sets nearly always have more non-empty parts than differing shingles.
    """
    low, high = _edges()[band], _edges()[band + 1] - 1
    most = high * (100 - percent) // percent
    parts = most + 1
    while True:
        empty = parts * math.exp(-low / parts)
        if parts - empty - 3.5 * math.sqrt(empty) >= most + 1 or parts >= 2 * most + 2:
            return most, parts
        parts += 1


def part_keys(tokens: np.ndarray, percent: int) -> tuple[np.ndarray, int]:
    """Keys of the parts of a set, for its own band and as the larger set of a pair for the band below, and how many
    of them a similar set must share: the non-empty parts of a band less the shingles that may differ."""
    size = len(tokens)
    edges = _edges()
    own = int(np.searchsorted(edges, size, side="right")) - 1
    mixed = mix64(tokens ^ np.uint64(0x5851F42D4C957F2D))
    keys, need = [], size
    for band in (own, own - 1):
        if band < 0 or band < own and size * percent > (edges[band + 1] - 1) * 100:
            continue
        most, parts = parts_of_band(band, percent)
        if most == 0:                                       # only equal sets reach the threshold
            continue
        at = (mixed % np.uint64(parts)).astype(np.int64)
        sums = np.zeros(parts, dtype=np.uint64)
        np.add.at(sums, at, tokens)
        filled = np.bincount(at, minlength=parts) > 0
        numbers = np.arange(parts, dtype=np.uint64)
        if filled.sum() > most:                             # an equal part that is not empty is certain
            sums, numbers = sums[filled], numbers[filled]
        need = min(need, max(1, int(filled.sum()) - most))
        keys.append(mix64(mix64(sums) + numbers * np.uint64(0xA0761D6478BD642F) + np.uint64(band + 1)))
    return (np.concatenate(keys), need) if keys else (tokens[:0], 0)


def node_of(tokens: np.ndarray) -> int:
    """64-bit id of a set, as a signed number."""
    total = int(np.add.reduce(mix64(tokens ^ np.uint64(0x8EBC6AF09C88C6E3)), dtype=np.uint64))
    return int(mix64(np.array([(total + len(tokens) * 0x589965CC75374CC3) & ((1 << 64) - 1)], dtype=np.uint64)).view(np.int64)[0])


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = 3, percent: int = 90) -> DataFrame:
    """``key, n_shingles, component`` per row; component: the smallest key reachable by links of ``percent`` % or more.

    Words are lower-cased (A-Z). Null texts and texts without words have no shingles and link with nothing; their
    component is their own key. Repeated rows have equal sets and so share a component; a null key is ignored as
    a component's name. Texts are taken whole, an empty table gives no rows. Only ``key`` and ``text`` are read.
    """
    ship(docs.sparkSession)
    rows = docs.select(F.col(f"`{key}`").cast("long").alias("key"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes, sizes, keys, needs = [], [], [], []
            for _, raw in text_chunks(batch.column(1).to_pylist()):
                for s in shingle_sets(raw, words):
                    nodes.append(node_of(s) if len(s) else None)
                    sizes.append(len(s))
                    own, need = part_keys(s, percent)
                    keys.append(own.view(np.int64))
                    needs.append(need)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(nodes, type=pa.int64()), pa.array(sizes, type=pa.int64()),
                                              pa.array(needs, type=pa.int64()), pa.array(keys, type=pa.list_(pa.int64()))],
                                             ["key", "node", "size", "need", "parts"])

    found = stored(rows.mapInArrow(sign, "key long, node long, size long, need long, parts array<long>"), "parts")
    signed = stored(found.select("key", "node", "size", "need"), "signed")
    met = stored(meetings(found.where("node is not null").select("node", "parts")), "met")
    discard(found)
    # a set shares as many parts as it needs, or has no similar set
    nodes = signed.where("node is not null").groupBy("node").agg(F.first("need").alias("need"), F.first("size").alias("size"))
    enough = met.groupBy("node").agg(F.count("*").alias("n")).join(nodes, "node").where("n >= need").select("node", "size")
    met = met.join(enough, "node")
    met = stored(met.join(met.groupBy("part").agg(F.count("*").alias("n")).where("n > 1").select("part"), "part", "left_semi"), "kept")

    # their shingles, read again from one text of each node
    wanted = met.select("node").distinct()
    first_doc = F.min(F.coalesce("key", F.lit(_FIRST_DOC))).alias("d")
    chosen = signed.join(wanted, "node", "left_semi").groupBy("node").agg(first_doc)

    def reread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, raw in text_chunks(batch.column(1).to_pylist()):
                sets = [s for s in shingle_sets(raw, words) if len(s)]
                yield pa.RecordBatch.from_arrays([pa.array([node_of(s) for s in sets], type=pa.int64()),
                                                  pa.array([s.view(np.int64) for s in sets], type=pa.list_(pa.int64()))], ["node", "tokens"])

    chosen = stored(chosen, "chosen")
    texts = rows.select(F.coalesce("key", F.lit(_FIRST_DOC)).alias("d"), "text").join(few(chosen.select("d").distinct()), "d", "left_semi").select("d", "text")
    sets = stored(texts.mapInArrow(reread, "node long, tokens array<long>").join(chosen, "node", "left_semi").dropDuplicates(["node"]), "sets")

    # star rounds: each node is compared with one hub, a node whose parts most others have too
    sizes = met.groupBy("part").agg(F.count("*").alias("n"))
    weights = met.join(sizes, "part").groupBy("node").agg(F.sum("n").alias("weight"))
    weighed = stored(met.join(weights, "node"), "weighed")
    near, parts = None, None
    for _ in range(STAR_ROUNDS):
        known = weighed.withColumn("component", F.col("node")) if parts is None else (
            weighed.join(parts, "node", "left").withColumn("component", F.coalesce("component", "node")))
        hub = known.groupBy("part").agg(F.max(F.struct("weight", "node", "component")).alias("hub"))
        apart = known.join(hub, "part").where("component <> hub.component")
        star = apart.groupBy("node", "component").agg(F.max("hub").alias("hub"))
        star = stored(star.select(F.col("hub.node").alias("gid"), "node", "component", F.col("hub.component").alias("of")), "star")
        centers = star.select("gid", F.col("gid").alias("node"), F.col("of").alias("component")).distinct()
        found_now = stored(open_groups(centers, star.select("gid", "node", "component"), sets, percent), "near")
        near = found_now if near is None else near.union(found_now)
        parts = components(near)

    # what is left: parts with nodes of different components
    labelled = met.join(parts, "node", "left").select("part", "node", "size", F.coalesce("component", "node").alias("component"))
    mixed = labelled.groupBy("part").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low <> high").select("part")
    left = stored(labelled.join(mixed, "part", "left_semi"), "left")
    common = left.join(left.groupBy("part").agg(F.count("*").alias("n")), "part")
    home = common.groupBy("node", "component", "size").agg(F.max(F.struct("n", "part"))["part"].alias("home"))
    buckets = home.groupBy("home").agg(F.ceil(F.sum("size") / GROUP_TOKENS).alias("buckets"))
    members = home.join(buckets, "home").select("node", "component", F.xxhash64("home", F.pmod(F.xxhash64("node"), F.col("buckets"))).alias("gid"))
    members = stored(members, "groups")
    held = (left.select("part", "node").join(members, "node").groupBy("part", "gid")
            .agg(F.min("component").alias("low"), F.max("component").alias("high"))
            .groupBy("part").agg(F.collect_list(F.struct("gid", "low", "high")).alias("groups")))
    foreign = F.transform(F.filter("groups", lambda g: (g["low"] != F.col("component")) | (g["high"] != F.col("component"))), lambda g: g["gid"])
    asked = (left.join(held, "part").select("node", "component", foreign.alias("gids")).groupBy("node", "component")
             .agg(F.array_distinct(F.flatten(F.collect_set("gids"))).alias("gids"))
             .select(F.explode("gids").alias("gid"), "node", "component"))
    more = stored(open_groups(members.select("gid", "node", "component"), asked, sets, percent), "more")
    every = components(near.union(more))

    classes = signed.where("node is not null").groupBy("node").agg(F.min("key").alias("least"))
    named = classes.join(every, "node", "left").select("node", "least", F.coalesce("component", "node").alias("component"))
    smallest = named.groupBy("component").agg(F.min("least").alias("smallest"))
    by_node = named.join(smallest, "component").select("node", "smallest")
    return (signed.select("key", "node", "size").join(by_node, "node", "left")
            .select("key", F.col("size").alias("n_shingles"), F.coalesce("smallest", "key").alias("component")))


def meetings(signed: DataFrame) -> DataFrame:
    """``(part, node)`` for every part that at least two nodes have, each with all its nodes.

    Postings travel as blocks: a task sorts the keys of a batch and cuts them into buckets by their leading bits,
    13 bytes a posting. Nodes of one batch with the same key meet right there, and only the smallest goes on, so a
    key that a third of all rows share arrives once per batch. A bucket, whose number grows with the postings, is
    worked on at a time. Parts are known by the leading bits and 40 more; a chance meeting is sorted out later.
    """
    total = signed.agg(F.sum(F.size("parts"))).first()[0] or 0
    bits = max(6, math.ceil(math.log2(max(1, total / BUCKET))))
    rest = np.uint64(max(0, 24 - bits))

    def runs(keys: np.ndarray, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Sorted by key and node without repeats: keys, nodes, and where each key starts."""
        order = np.lexsort((nodes, keys))
        keys, nodes = keys[order], nodes[order]
        fresh = np.ones(len(keys), dtype=bool)
        fresh[1:] = (keys[1:] != keys[:-1]) | (nodes[1:] != nodes[:-1])
        keys, nodes = keys[fresh], nodes[fresh]
        first = np.ones(len(keys), dtype=bool)
        first[1:] = keys[1:] != keys[:-1]
        return keys, nodes, np.flatnonzero(first)

    def meeting(keys: np.ndarray, nodes: np.ndarray, starts: np.ndarray) -> pa.RecordBatch:
        counts = np.diff(np.append(starts, len(keys)))
        shared = np.repeat(counts > 1, counts)
        return pa.RecordBatch.from_arrays([pa.array(keys[shared].view(np.int64)), pa.array(nodes[shared], type=pa.int64())], ["part", "node"])

    def of_batch(batch: pa.RecordBatch):
        lists = batch.column(1)
        nodes = np.repeat(np.asarray(batch.column(0)), np.diff(np.asarray(lists.offsets)))
        return runs(np.asarray(lists.flatten()).view(np.uint64) >> rest, nodes)

    def inside(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield meeting(*of_batch(batch))

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, nodes, starts = of_batch(batch)
            keys, nodes = keys[starts], nodes[starts]
            bucket = (keys >> np.uint64(40)).astype(np.int64)
            low = keys.view(np.uint8).reshape(-1, 8)[:, :5] if len(keys) else np.zeros((0, 5), dtype=np.uint8)
            cut = np.flatnonzero(np.diff(bucket, prepend=-1))
            ends = [*cut[1:].tolist(), len(keys)]
            blobs = [low[a:b].tobytes() + nodes[a:b].tobytes() for a, b in zip(cut.tolist(), ends)]
            yield pa.RecordBatch.from_arrays([pa.array(bucket[cut]), pa.array(blobs, type=pa.binary())], ["bucket", "blob"])

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket, waiting = None, []

        def closed() -> pa.RecordBatch:
            sizes = [len(b) // 13 for b in waiting]
            low = np.zeros((sum(sizes), 8), dtype=np.uint8)
            low[:, :5] = np.concatenate([np.frombuffer(b, dtype=np.uint8, count=5 * n).reshape(-1, 5) for b, n in zip(waiting, sizes)])
            nodes = np.concatenate([np.frombuffer(b, dtype=np.int64, offset=5 * n) for b, n in zip(waiting, sizes)])
            return meeting(*runs(low.reshape(-1).view(np.uint64) | np.uint64(bucket << 40), nodes))

        for batch in batches:
            for b, blob in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if b != bucket and waiting:
                    yield closed()
                    waiting = []
                bucket = b
                waiting.append(blob)
        if waiting:
            yield closed()

    schema = "part long, node long"
    dealt = signed.mapInArrow(blocks, "bucket long, blob binary").repartition("bucket").sortWithinPartitions("bucket")
    return signed.mapInArrow(inside, schema).union(dealt.mapInArrow(merge, schema)).distinct()


def open_groups(members: DataFrame, queries: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links ``(a, b)`` between queries and members of their group ``gid`` that are of different components.

    Both are ``(gid, node, component)``. A group with many queries is opened by several tasks, each with all
    members and a bounded share of the queries.
    """
    share = queries.groupBy("gid").agg(F.ceil(F.count("*") / QUERIES).alias("shares"))
    asked = queries.join(share, "gid").select("gid", F.pmod(F.xxhash64("node"), F.col("shares")).alias("share"), F.lit(1).alias("kind"), "node", "component")
    opened = (members.join(share, "gid")
              .select("gid", F.explode(F.sequence(F.lit(0).cast("long"), F.col("shares") - 1)).alias("share"), F.lit(0).alias("kind"), "node", "component"))
    full = asked.union(opened).join(sets, "node").select("gid", "share", "kind", "node", "component", "tokens")
    full = full.repartition("gid", "share").sortWithinPartitions("gid", "share", "kind", "node")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, matrix = None, None
        waiting: list[tuple[int, int, np.ndarray]] = []
        out: list[tuple[int, int]] = []
        for batch in batches:
            head = [batch.column(i).to_pylist() for i in range(5)]
            offsets = np.asarray(batch.column(5).offsets)
            flat = np.asarray(batch.column(5).values).view(np.uint64)
            for i, (gid, part, kind, node, component) in enumerate(zip(*head)):
                tokens = flat[offsets[i]:offsets[i + 1]]
                if (gid, part) != group:
                    group, waiting, matrix = (gid, part), [], None
                if kind == 0:
                    waiting.append((node, component, tokens.copy()))
                    continue
                matrix = matrix or Matrix(waiting, percent)
                out += matrix.links(node, component, tokens)
            if out:
                a, b = zip(*out)
                yield pa.RecordBatch.from_arrays([pa.array(a, type=pa.int64()), pa.array(b, type=pa.int64())], ["a", "b"])
                out = []

    return full.mapInArrow(run, "a long, b long")


class Matrix:
    """The token matrix of an opened group: its union of shingles, and the members that hold each."""

    def __init__(self, members: list[tuple[int, int, np.ndarray]], percent: int) -> None:
        self.percent = percent
        self.nodes = [m[0] for m in members]
        self.sizes = np.array([len(m[2]) for m in members], dtype=np.int64)
        self.root = {m[1]: m[1] for m in members}
        self.labels = [m[1] for m in members]
        tokens = np.concatenate([m[2] for m in members]) if members else np.zeros(0, dtype=np.uint64)
        owner = np.repeat(np.arange(len(members)), self.sizes)
        order = np.argsort(tokens, kind="stable")
        self.owner = owner[order]
        self.union, self.first = np.unique(tokens[order], return_index=True)
        self.first = np.append(self.first, len(tokens))

    def _find(self, x: int) -> int:
        self.root.setdefault(x, x)
        while self.root[x] != x:
            self.root[x] = self.root[self.root[x]]
            x = self.root[x]
        return x

    def links(self, node: int, component: int, tokens: np.ndarray) -> list[tuple[int, int]]:
        """Links of a query that join components which this group has not joined yet."""
        p, size = self.percent, len(tokens)
        if not len(self.union):
            return []
        at = np.searchsorted(self.union, tokens)
        at = at[self.union[at.clip(max=len(self.union) - 1)] == tokens]
        # no member of the right size can share more than the union does
        fitting = (self.sizes * 100 >= size * p) & (size * 100 >= self.sizes * p)
        if not fitting.any() or len(at) * (100 + p) < p * (size + int(self.sizes[fitting].min())):
            return []
        counts = self.first[at + 1] - self.first[at]
        places = np.repeat(self.first[at] - np.concatenate([[0], np.cumsum(counts)[:-1]]), counts) + np.arange(counts.sum())
        common = np.bincount(self.owner[places], minlength=len(self.nodes))
        found = []
        for i in np.flatnonzero(fitting & (100 * common >= p * (size + self.sizes - common))):
            a, b = self._find(component), self._find(self.labels[i])
            if a != b:
                self.root[max(a, b)] = min(a, b)
                found.append((node, self.nodes[i]))
        return found


def op1_jaccard_join(spark, sf_dir: str) -> DataFrame:
    """Every document with its number of 3-word shingles and its component of 90 % links."""
    found = near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return found.select(F.col("key").alias("doc_id"), "n_shingles", F.col("component").alias("component_id"))
