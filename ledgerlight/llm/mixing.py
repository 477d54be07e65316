"""Mixing sources to target weights by a multivariate-hypergeometric splitting tree (DataFrame functions only).

1. Sizes per source give the targets: shares by weight, none above ``max_epochs`` times its source (water filling).
2. Every source is cut into blocks of about ``block_words`` words by a hash of the document key, so a source with a
   third of all rows is simply many blocks. An affine permutation orders the blocks of a source without any sort.
3. A target is whole passes over the source plus a prefix of the permuted blocks. The block at the cut is split
   between documents: in hash order each document that still fits is taken.
4. The block quotas of all sources form the root of a binary tree over output shards. A node hands its left half
   a sample without replacement: sources in turn, each by inverting the exact hypergeometric distribution with a
   hashed uniform number. The leaves are disjoint runs of every source's permuted blocks.
5. A shard is shuffled locally: its rows are sorted by a hash.

Everything is a function of hashes of the rows, so reruns agree.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerlight.llm.shared import count_words, free_name, scratch_root

WEIGHTS = (5, 2, 1)
SHARE_PERCENT = 150
MAX_EPOCHS = 2
#: Words of a block, and of an output shard.
BLOCK_WORDS = 1 << 14
SHARD_WORDS = 1 << 20
#: Blocks per run in the two-step prefix sum.
RUN = 4096
#: The source table is broadcast up to this many sources; beyond it the join shuffles.
BROADCAST_SOURCES = 100_000
_PRIME = 2147483647


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share_percent: int = SHARE_PERCENT,
            max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """``(source, source_size, target)`` from ``(source, size)``: one row per source, ordered by code point, null last.

    Weights repeat in that order. A source is capped when its cap per weight is below the level that the others
    would get; caps are taken in order of cap per weight, so one pass of running sums finds the level. These
    windows run over one row per source (three numbers each), never over documents.
    """
    by_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    ranked = by_source.withColumn("_rank", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1)
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.pmod("_rank", F.lit(len(weights))) + 1).cast("int"))
    ranked = ranked.withColumn("_w", weight.cast("long")).withColumn("_cap", F.col("source_size") * max_epochs)
    order = Window.orderBy((F.col("_cap") / F.col("_w")).asc(), "_rank")
    everything = Window.partitionBy()
    ranked = (ranked
              .withColumn("_all", F.sum("source_size").over(everything))
              .withColumn("_cap_before", F.coalesce(F.sum("_cap").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
              .withColumn("_w_from", F.sum("_w").over(order.rowsBetween(0, Window.unboundedFollowing))))
    left = F.col("_all").cast("double") * share_percent / 100 - F.col("_cap_before")
    ranked = ranked.withColumn("_capped", F.col("_cap") * F.col("_w_from") <= left * F.col("_w"))
    ranked = (ranked
              .withColumn("_c", F.sum(F.when(F.col("_capped"), F.col("_cap")).otherwise(0)).over(everything))
              .withColumn("_u", F.sum(F.when(F.col("_capped"), 0).otherwise(F.col("_w"))).over(everything)))
    shared = (F.col("_all").cast("double") * share_percent / 100 - F.col("_c")) * F.col("_w") / F.col("_u")
    return ranked.select("source", "source_size", "_rank",
                         F.when(F.col("_capped"), F.col("_cap").cast("double")).otherwise(shared).alias("target"))


def _hash(*parts: Column | str, seed: int) -> Column:
    """Non-negative 60-bit hash that SQL engines share: the first 15 hex digits of an MD5 digest."""
    text = F.concat_ws(":", F.lit(str(seed)), *[F.coalesce(p.cast("string") if isinstance(p, Column) else F.col(p).cast("string"), F.lit("")) for p in parts])
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long")


def _once(value: Column, use) -> Column:
    """``use(value)`` with ``value`` worked out once: expressions inside lambdas are not shared otherwise."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _hypergeometric(total: Column, good: Column, draws: Column, u: Column) -> Column:
    """How many of ``draws`` items, out of ``total`` of which ``good`` are of the kind, are of the kind.

    Inverts the distribution at ``u``. Outcomes are visited from the mode upwards, then downwards, so weights are
    products of neighbouring ratios and nothing overflows; 12 standard deviations cover it to double precision.
    """
    n, k, d = total.cast("double"), good.cast("double"), draws.cast("double")
    low, high = F.greatest(F.lit(0.0), d + k - n), F.least(k, d)
    mode = F.least(high, F.greatest(low, F.floor((k + 1) * (d + 1) / (n + 2)).cast("double")))
    spread = F.ceil(12 * F.sqrt(F.greatest(F.lit(0.0), d * (k / n) * (1 - k / n) * (n - d) / F.greatest(F.lit(1.0), n - 1))) + 12).cast("double")
    top, bottom = F.least(high, mode + spread).cast("long"), F.greatest(low, mode - spread).cast("long")
    m = mode.cast("long")
    upward = F.sequence(m, top)
    downward = F.when(bottom < m, F.sequence(m - 1, bottom, F.lit(-1).cast("long"))).otherwise(F.array().cast("array<long>"))
    steps = F.concat(upward, downward)

    def ratio(j: Column) -> Column:  # p(j + 1) / p(j)
        return (k - j) * (d - j) / ((j + 1) * (n - k - d + j + 1))

    def weight(before: Column, x: Column) -> Column:
        j = x.cast("double")
        return (F.when(x == m, F.lit(1.0)).when(x > m, before * ratio(j - 1))
                .when(x == m - 1, 1 / ratio(j)).otherwise(before / ratio(j)))

    mass = F.aggregate(steps, F.struct(F.lit(1.0).alias("w"), F.lit(0.0).alias("s")),
                       lambda a, x: _once(weight(a["w"], x), lambda w: F.struct(w.alias("w"), (a["s"] + w).alias("s"))), lambda a: a["s"])
    # the level u * mass is part of the state, so it is worked out once
    start = F.struct(F.lit(1.0).alias("w"), F.lit(0.0).alias("s"), m.alias("pick"), F.lit(False).alias("done"), (u * mass).alias("need"))

    def walk(a: Column, x: Column) -> Column:
        return _once(weight(a["w"], x), lambda w: F.struct(
            w.alias("w"), (a["s"] + w).alias("s"), F.when(a["done"], a["pick"]).otherwise(x).alias("pick"),
            (a["done"] | (a["s"] + w >= a["need"])).alias("done"), a["need"].alias("need")))

    picked = F.aggregate(steps, start, walk, lambda a: F.when(a["done"], a["pick"]).otherwise(m))
    return F.when((good <= 0) | (draws <= 0), F.lit(0).cast("long")).when(good >= total, draws.cast("long")).otherwise(picked)


_QUOTA = "array<struct<rank:int,start:long,n:long>>"


def splitting_tree(quotas: DataFrame, depth: int, seed: int = 0) -> DataFrame:
    """Leaves ``(shard, rank, start, n)`` of the tree over ``2 ** depth`` shards for ``(rank, n)``: quotas by source.

    The root is one row with three numbers per source. Levels are expressions and explodes over nodes; after the
    first eight levels the nodes are dealt out to all tasks.
    """
    node = quotas.groupBy().agg(F.sort_array(F.collect_list(F.struct(
        F.col("rank").cast("int").alias("rank"), F.lit(0).cast("long").alias("start"), F.col("n").cast("long").alias("n")))).alias("q"))
    node = node.select(F.lit(0).cast("long").alias("shard"), F.col("q").cast(_QUOTA).alias("q"))
    for level in range(depth):
        total = F.aggregate("q", F.lit(0).cast("long"), lambda a, x: a + x["n"])
        node = node.withColumn("_total", total)
        first = F.struct(F.col("_total").alias("items"), F.floor(F.col("_total") / 2).cast("long").alias("draws"),
                         F.array().cast("array<long>").alias("took"))

        u_level = F.lit(level)

        def carry(a: Column, x: Column) -> Column:  # noqa: B023
            u = _hash(F.col("shard"), x["rank"], u_level, seed=seed + 7).cast("double") / float(1 << 60)  # noqa: B023
            got = _hypergeometric(a["items"], x["n"], a["draws"], u)
            return _once(got, lambda g: F.struct((a["items"] - x["n"]).alias("items"), (a["draws"] - g).alias("draws"),
                                                 F.concat(a["took"], F.array(g)).alias("took")))

        node = node.withColumn("_left", F.aggregate("q", first, carry, lambda a: a["took"]))
        left = F.zip_with("q", "_left", lambda x, t: F.struct(x["rank"].alias("rank"), x["start"].alias("start"), t.alias("n")))
        right = F.zip_with("q", "_left", lambda x, t: F.struct(x["rank"].alias("rank"), (x["start"] + t).alias("start"), (x["n"] - t).alias("n")))
        keep = lambda a: F.filter(a, lambda x: x["n"] > 0)
        node = node.select(F.explode(F.array(F.struct((F.col("shard") * 2).alias("shard"), keep(left).alias("q")),
                                             F.struct((F.col("shard") * 2 + 1).alias("shard"), keep(right).alias("q")))).alias("c")).select("c.shard", "c.q")
        if level == 7:
            node = node.repartition(F.col("shard"))
        if level % 3 == 2:                      # a few numbers per node: keeps the plans small
            node = node.checkpoint()
    return node.select("shard", F.explode("q").alias("x")).select("shard", "x.rank", "x.start", "x.n")


def mix(docs: DataFrame, text: str = "text", source: str = "source", key: str = "doc_id", seed: int = 17,
        block_words: int = BLOCK_WORDS, shard_words: int = SHARD_WORDS, weights: tuple[int, ...] = WEIGHTS,
        share_percent: int = SHARE_PERCENT, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """The mixing plan: every row of ``docs`` as ``key, row_hash, size, source, source_size, target, shards``.

    ``shards`` lists the output shard of every copy that the mix takes (empty: not taken). ``drawn`` turns it
    into the mixed rows. A null text has size 0; rows without words and empty sources are never taken; null and
    empty sources are sources of their own, null last; repeated rows with one key share a block and are cut like
    any other rows (equal rows are interchangeable). An empty table gives an empty plan. Only ``key``, ``text``
    and ``source`` are read, so other columns may have any name.
    """
    spark = docs.sparkSession
    scratch_root(spark)
    sized = docs.select(F.col(f"`{key}`").alias("key"), F.col(f"`{source}`").cast("string").alias("source"), count_words(F.col(f"`{text}`")).alias("size"),
                        row_hash(docs, key, text, source).alias("row_hash"))
    sized = sized.checkpoint()
    mixture = targets(sized, weights, share_percent, max_epochs).checkpoint()
    n_sources, words = mixture.agg(F.count("*"), F.coalesce(F.sum("target"), F.lit(0.0))).first()
    depth = 0
    while shard_words << depth < words:
        depth += 1

    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    plan = (mixture.withColumn("blocks", F.greatest(F.lit(1), F.ceil(F.col("source_size") / block_words)).cast("long"))
            .withColumn("whole", whole).withColumn("partial", F.col("target") - F.col("whole") * F.col("source_size"))
            .withColumnRenamed("_rank", "rank"))
    small = F.broadcast(plan) if n_sources <= BROADCAST_SOURCES else plan
    same = sized["source"].eqNullSafe(plan["source"])
    # the permutation of a source's blocks: multiply by a prime beyond any block number, shift by the source's rank
    at = F.pmod(_hash("key", seed=seed) % F.col("blocks") * _PRIME + F.col("rank"), F.col("blocks"))
    rows = sized.join(small, same).select("key", sized["source"], "size", "row_hash", "source_size", "target", "rank", "blocks", "whole",
                                          "partial", at.alias("block"), _hash("key", seed=seed + 1).alias("order")).checkpoint()

    # the cut: runs of blocks, blocks of the run at the cut, documents of the block at the cut
    blocks = rows.groupBy("rank", "block").agg(F.sum("size").alias("size"), F.first("partial").alias("partial"),
                                               F.first("whole").alias("whole"), F.first("blocks").alias("blocks")).checkpoint()

    def crossing(parts: DataFrame, by: list[str], at_: str) -> DataFrame:
        """Rows of ``parts`` inside which the running size passes the partial target, with the size before them."""
        before = Window.partitionBy(*by).orderBy(at_).rowsBetween(Window.unboundedPreceding, -1)
        summed = parts.withColumn("before", F.col("base") + F.coalesce(F.sum("size").over(before), F.lit(0)))
        return summed.where((F.col("before") <= F.col("partial")) & (F.col("before") + F.col("size") > F.col("partial")))

    numbered = blocks.withColumn("run", F.floor(F.col("block") / RUN).cast("long"))
    runs = numbered.groupBy("rank", "run").agg(F.sum("size").alias("size"), F.first("partial").alias("partial")).withColumn("base", F.lit(0).cast("long"))
    run = crossing(runs, ["rank"], "run").select("rank", "run", F.col("before").alias("base"))
    cut = (crossing(numbered.join(run, ["rank", "run"]), ["rank"], "block")
           .select("rank", F.col("block").alias("cut"), (F.col("partial") - F.col("before")).alias("room")).checkpoint())

    # each document of the block at the cut is taken if it still fits; a block has about block_words words
    at_cut = (rows.where("size > 0").join(cut.withColumnRenamed("cut", "block"), ["rank", "block"])
              .select("rank", "key", "size", "order", "room"))
    queue = at_cut.groupBy("rank", "room").agg(F.sort_array(F.collect_list(F.struct("order", "key", "size"))).alias("q"))
    chosen = F.aggregate("q", F.struct(F.col("room").alias("room"), F.array().cast("array<boolean>").alias("took")),
                         lambda a, x: F.struct((a["room"] - F.when(x["size"] <= a["room"], x["size"]).otherwise(0)).alias("room"),
                                               F.concat(a["took"], F.array(x["size"] <= a["room"])).alias("took")), lambda a: a["took"])
    fits = (queue.select("rank", F.explode(F.zip_with("q", chosen, lambda x, t: F.struct(x["key"].alias("key"), x["size"].alias("size"), t.alias("took")))).alias("x"))
            .where("x.took").groupBy("rank", F.col("x.key").alias("key"), F.col("x.size").alias("size")).agg(F.count("*").alias("fit")))

    # copies of blocks in the order in which they are drawn: whole passes, then the permuted prefix
    cuts = cut.select("rank", "cut")
    copied = (blocks.join(cuts, "rank", "left")
              .withColumn("passes", F.col("whole") + F.when((F.col("partial") > 0) & (F.col("block") <= F.coalesce("cut", F.lit(-1))), 1).otherwise(0)))
    quotas = copied.groupBy("rank").agg((F.max("whole") * F.max("blocks") + F.max(F.coalesce("cut", F.lit(-1))) + 1).alias("n"))
    leaves = splitting_tree(quotas, depth, seed).checkpoint()
    drawn_blocks = (leaves.select("rank", "shard", F.explode(F.sequence(F.col("start"), F.col("start") + F.col("n") - 1)).alias("at")))
    wanted = copied.where("passes > 0").select("rank", "block", "blocks", F.explode(F.sequence(F.lit(0).cast("long"), F.col("passes") - 1)).alias("pass"))
    wanted = wanted.withColumn("at", F.col("pass") * F.col("blocks") + F.col("block"))
    placed = (wanted.join(drawn_blocks, ["rank", "at"])
              .groupBy("rank", "block").agg(F.transform(F.sort_array(F.collect_list(F.struct("pass", "shard"))), lambda x: x["shard"]).alias("block_shards")))

    # back to the documents: blocks are small, so no key is hot
    got = (rows.join(placed, ["rank", "block"], "left").join(F.broadcast(cuts) if n_sources <= BROADCAST_SOURCES else cuts, "rank", "left"))
    same_rows = Window.partitionBy("rank", "key", "size").orderBy("order")
    keyed = fits.select(F.col("rank").alias("f_rank"), F.col("key").alias("f_key"), F.col("size").alias("f_size"), "fit")
    edge = (got.where((F.col("block") == F.col("cut")) & (F.col("size") > 0)).withColumn("nth", F.row_number().over(same_rows))
            .join(keyed, (F.col("rank") == F.col("f_rank")) & F.col("key").eqNullSafe(F.col("f_key")) & (F.col("size") == F.col("f_size")), "left")
            .withColumn("copies", F.col("whole") + F.when(F.col("nth") <= F.coalesce("fit", F.lit(0)), 1).otherwise(0)))
    inner = got.where((F.col("cut").isNull()) | (F.col("block") != F.col("cut")) | (F.col("size") == 0))
    inner = inner.withColumn("copies", F.when(F.col("size") == 0, 0).otherwise(
        F.col("whole") + F.when(F.col("block") < F.coalesce("cut", F.lit(-1)), 1).otherwise(0)))
    cols = ["key", "row_hash", "size", "source", "source_size", "target", "block_shards", "copies"]
    both = inner.select(*cols).union(edge.select(*cols))
    shards = F.when(F.col("copies") > 0, F.slice("block_shards", F.lit(1), F.col("copies").cast("int"))).otherwise(F.array().cast("array<long>"))
    return both.select("key", "row_hash", "size", "source", "source_size", "target", shards.alias("shards"))


def row_hash(docs: DataFrame, key: str, text: str, source: str) -> Column:
    """Tells rows of one key apart; rows with equal hash and key are copies of each other."""
    return F.xxhash64(F.col(f"`{key}`").cast("string"), F.col(f"`{source}`").cast("string"), F.col(f"`{text}`"))


def drawn(docs: DataFrame, plan: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", seed: int = 17) -> DataFrame:
    """The mixed rows: every taken copy of a row of ``docs`` with ``shard, shard_order``, shuffled locally inside the shard.

    Rows are told apart by key, text and source: different rows of one key (null included) are drawn each by its own plan;
    copies of a row are one row, drawn as often as all of them together. A task holds whole shards, each in its shuffled
    order. The two names are suffixed by ``_`` if taken.
    """
    name = F.coalesce(F.col("key").cast("string"), F.lit(""))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(f"`{key}`").alias("key"),
                       row_hash(docs, key, text, source).alias("row_hash"))
    own = ["no_key", "name", "row_hash"]
    rows = (rows.select("row", F.col("key").isNull().alias("no_key"), name.alias("name"), "row_hash")
            .groupBy(*own).agg(F.min_by("row", F.xxhash64("row")).alias("row")))
    copies = (plan.where(F.size("shards") > 0)
              .select(F.col("key").isNull().alias("no_key"), name.alias("name"), "row_hash", F.posexplode("shards").alias("copy", "shard")))
    out = rows.join(copies, own).withColumn("place", F.xxhash64(F.lit(seed), "shard", "name", "row_hash", "copy"))
    return (out.repartition("shard").sortWithinPartitions("shard", "place")
            .select("row.*", F.col("shard").alias(free_name(docs, "shard")), F.col("place").alias(free_name(docs, "shard_order"))))


def op10_mix_sources(spark, sf_dir: str) -> DataFrame:
    """Every document with its size, its source's size and target, and the words that the mix takes."""
    plan = mix(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return plan.select(F.col("key").cast("long").alias("doc_id"), F.col("size").cast("long").alias("size"), F.col("source_size").cast("long").alias("source_size"),
                       "target", (F.col("size") * F.size("shards")).cast("long").alias("taken"))


#: The same targets, blocks and cut in SQL: shares by fixed point over capped sources, the cut by walking documents.
SQL = """
WITH RECURSIVE sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS size FROM documents
), per_source AS (
  SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS rank FROM sized GROUP BY source
), weighed AS (
  SELECT *, CASE rank % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS w, (SELECT sum(source_size) FROM per_source)::DOUBLE AS total FROM per_source
), level AS (
  SELECT 0 AS round, (SELECT any_value(total) FROM weighed) * 150 / 100 / (SELECT sum(w) FROM weighed) AS unit
  UNION ALL
  SELECT round + 1, ((SELECT any_value(total) FROM weighed) * 150 / 100 - (SELECT coalesce(sum(2 * source_size), 0) FROM weighed WHERE 2 * source_size <= unit * w))
         / (SELECT sum(w) FROM weighed WHERE 2 * source_size > unit * w)
  FROM level WHERE round < 60 AND EXISTS (SELECT 1 FROM weighed WHERE 2 * source_size > unit * w)
), unit AS (SELECT arg_max(unit, round) AS unit FROM level WHERE unit IS NOT NULL
), target AS (
  SELECT source, source_size, rank, CASE WHEN 2 * source_size <= unit * w THEN (2 * source_size)::DOUBLE ELSE
           ((total * 150 / 100 - (SELECT coalesce(sum(2 * source_size), 0) FROM weighed, unit WHERE 2 * source_size <= unit * w)) * w
            / (SELECT sum(w) FROM weighed, unit WHERE 2 * source_size > unit * w)) END AS target
  FROM weighed, unit
), planned AS (
  SELECT *, greatest(1, ceil(source_size / 16384.0))::BIGINT AS blocks, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END::BIGINT AS whole FROM target
), rows AS (
  SELECT doc_id, size, p.*, target - whole * source_size AS part,
         (('0x' || substr(md5('17:' || coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT % blocks * 2147483647 + rank) % blocks AS block,
         ('0x' || substr(md5('18:' || coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT AS ord
  FROM sized s JOIN planned p ON s.source IS NOT DISTINCT FROM p.source
), upto AS (
  SELECT rank, block, sum(sum(size)) OVER (PARTITION BY rank ORDER BY block) AS after_it, sum(size) AS size, any_value(part) AS part FROM rows GROUP BY rank, block
), cut AS (
  SELECT rank, block AS cut, part - (after_it - size) AS room FROM upto WHERE after_it - size <= part AND after_it > part
), queue AS (
  SELECT r.rank, r.doc_id, r.size, c.room, row_number() OVER (PARTITION BY r.rank ORDER BY ord, r.doc_id, r.size) AS nth
  FROM rows r JOIN cut c ON r.rank = c.rank AND r.block = c.cut WHERE r.size > 0
), walk AS (
  SELECT rank, nth, doc_id, size <= room AS took, room - CASE WHEN size <= room THEN size ELSE 0 END AS room FROM queue WHERE nth = 1
  UNION ALL
  SELECT q.rank, q.nth, q.doc_id, q.size <= w.room, w.room - CASE WHEN q.size <= w.room THEN q.size ELSE 0 END
  FROM walk w JOIN queue q ON q.rank = w.rank AND q.nth = w.nth + 1
)
SELECT r.doc_id, r.size, r.source_size::BIGINT AS source_size, r.target,
       (r.size * (r.whole + CASE WHEN r.block < c.cut THEN 1 WHEN r.block = c.cut AND w.took THEN 1 ELSE 0 END))::BIGINT AS taken
FROM rows r LEFT JOIN cut c ON r.rank = c.rank LEFT JOIN walk w ON w.rank = r.rank AND w.doc_id = r.doc_id
"""
