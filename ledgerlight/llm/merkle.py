"""Operator 12: a Merkle manifest of a dataset, by slot pivots.

Every row is a leaf; per source the leaves are ordered by id, and runs of
``FANOUT`` nodes become their parent's hash until one is left, the subroot. The
subroots, ordered by source, make up a tree of the same kind: the root.

A run is spread into fanout columns by conditional aggregates, one column per
slot. All of them concatenated give the parent's hash; without a node's own
slot they are its siblings, kept as what stands before and after it.

Nothing is sorted or numbered in one task. Leaves are dealt out by ranges of
(source, id, hash), so a hot source spans many tasks, and numbered by the counts of
the ranges before. The pivots of ``LEVELS`` levels at a time run inside blocks
of ``FANOUT ** LEVELS`` neighbours, which one shuffle brings together; only the
blocks' hashes go on to the next such round.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlight.llm.shared import discard, stored

FANOUT = 3
#: Levels per shuffle: a block holds at most 3 ** 6 = 729 nodes.
LEVELS = 6
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")

_PATH = "array<struct<before:string,after:string>>"


def digest(*parts: Column) -> Column:
    """Lower-case hex SHA-256 of the concatenated parts."""
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def encoded(value: Column) -> Column:
    """``-`` for null, else the UTF-8 byte count, ``:`` and the value; no two lists of values encode alike."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_hash(**replaced: Column) -> Column:
    return digest(*[encoded(replaced.get(f, F.col(f"`{f}`"))) for f in FIELDS])


def tampered_leaf(key: Column, text: Column) -> Column:
    """The hash of a row that lost its line breaks, for every row whose id has an even checksum; null for the others."""
    return F.when(F.crc32(key.cast("string").cast("binary")) % 2 == 0, leaf_hash(text=F.replace(text, F.lit("\n"), F.lit(""))))


# ------------------------------------------------------------------ numbers

def numbered(nodes: DataFrame, group: str, order: list[str], name: str) -> tuple[DataFrame, DataFrame]:
    """(``nodes`` with ``idx``, its number from 0 in its group, and ``total``, the group's size; the stored table behind it).

    ``group`` must not be null. Ties in ``order`` are rows of equal columns as long as ``order`` ends in their hash."""
    by = [F.col(group), *[F.col(c).asc_nulls_first() for c in order]]
    dealt = nodes.repartitionByRange(*by).sortWithinPartitions(*by).withColumn("_at", F.monotonically_increasing_id())
    table = stored(dealt, name)
    task = F.shiftright("_at", 33)
    ranges = table.groupBy(group, task.alias("_task")).agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(group).orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)      # one row per task of a group
    ranges = ranges.select(F.col(group).alias("_group"), "_task", (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first")).alias("_shift"),
                           F.sum("_n").over(Window.partitionBy(group)).alias("total"))
    joined = table.join(ranges, (F.col(group) == F.col("_group")) & (task == F.col("_task")))
    return joined.select(*nodes.columns, (F.col("_at") + F.col("_shift")).alias("idx"), "total"), table


# -------------------------------------------------------------------- tree

def _slots(run) -> list[Column]:
    """The nodes of a run in fanout columns; an empty slot is an empty text."""
    return [F.coalesce(F.max(F.when(F.col("_slot") == k, F.col("node"))).over(run), F.lit("")) for k in range(FANOUT)]


def _pivoted(nodes: DataFrame, group: str, fold: bool) -> DataFrame:
    """``LEVELS`` levels inside blocks. ``node`` becomes the block's hash. With ``fold``, ``folded`` is taken up through the
    hashes with the original siblings, and ``siblings`` collects these, else ``path`` collects what stands before and after."""
    width = FANOUT ** LEVELS
    df = nodes.withColumn("_block", F.floor(F.col("idx") / width).cast("long")).repartition(group, "_block")
    df = df.withColumns({"_at": F.col("idx"), "_left": F.col("total")})
    df = df.withColumn("siblings", F.lit("")) if fold else df.withColumn("path", F.array().cast(_PATH))
    for _ in range(LEVELS):
        df = df.withColumns({"_slot": F.pmod("_at", F.lit(FANOUT)), "_up": F.floor(F.col("_at") / FANOUT).cast("long")})
        s = _slots(Window.partitionBy(group, "_block", "_up"))
        df = df.withColumns({f"_s{k}": s[k] for k in range(FANOUT)})
        more, own = F.col("_left") > 1, F.col("_slot")
        parts = [F.col(f"_s{k}") for k in range(FANOUT)]
        before = F.concat(*[F.when(own > k, parts[k]).otherwise(F.lit("")) for k in range(FANOUT)])
        after = F.concat(*[F.when(own < k, parts[k]).otherwise(F.lit("")) for k in range(FANOUT)])
        new = {"node": F.when(more, digest(*parts)).otherwise(F.col("node"))}
        if fold:
            new["folded"] = F.when(more, digest(before, F.col("folded"), after)).otherwise(F.col("folded"))
            new["siblings"] = F.when(more, F.concat("siblings", before, after)).otherwise(F.col("siblings"))
        else:
            step = F.array(F.struct(before.alias("before"), after.alias("after")))
            new["path"] = F.when(more, F.concat("path", step)).otherwise(F.col("path"))
        df = df.withColumns({**new, "_at": F.col("_up"), "_left": F.ceil(F.col("_left") / FANOUT).cast("long")})
    return df.drop("_slot", "_up", "_at", *[f"_s{k}" for k in range(FANOUT)])


def _blocks(pivoted: DataFrame, group: str) -> DataFrame:
    """The nodes that the next round starts from: one per block."""
    return pivoted.groupBy(group, F.col("_block").alias("idx")).agg(F.first("node").alias("node"), F.first("_left").alias("total"))


def _climb(nodes: DataFrame, group: str, most: int) -> DataFrame:
    """``group, idx, path, top`` of nodes ``(group, idx, total, node)``: the way from each node to the top of its group."""
    if most <= 1:
        return nodes.select(group, "idx", F.array().cast(_PATH).alias("path"), F.col("node").alias("top"))
    inside = _pivoted(nodes, group, fold=False)
    upper = _climb(stored(_blocks(inside, group), "merkle-blocks"), group, -(-most // FANOUT ** LEVELS))
    upper = upper.select(F.col(group).alias("_group"), F.col("idx").alias("_node"), F.col("path").alias("_above"), "top")
    return (inside.join(upper, (F.col(group) == F.col("_group")) & (F.col("_block") == F.col("_node")))
            .select(group, "idx", F.concat("path", "_above").alias("path"), "top"))


@dataclass
class Manifest:
    """``rows``: one per row of the table, the columns of ``manifest``; ``subroots``: one per source."""
    rows: DataFrame
    subroots: DataFrame


def manifest(docs: DataFrame, tampered=tampered_leaf) -> Manifest:
    """The tree of a table with the columns ``FIELDS``, and for every row its proof and a check of the row.

    Columns of the result: ``doc_id, source, leaf, subroot, root, proof_sha256, folded_root, verified``.
    ``tampered(key, text)`` is the hash of a row as it is found later, null if it is unchanged.

    Null ids come first in their source, ids that repeat are ordered by their leaf hash; equal rows have equal
    leaves, and each is a leaf of its own. Null sources form one group, before all others. A null or
    empty text is a value like any other. A table of one row has that leaf as its subroot and root, and its
    proof is the hash of nothing. An empty table gives no rows. Extra columns are ignored.
    """
    group = F.coalesce(F.concat(F.lit("1"), F.col("`source`").cast("string")), F.lit("0")).alias("_g")   # bytewise order, null first
    leaves = docs.select(group, F.col("`doc_id`").alias("doc_id"), F.col("`source`").alias("source"), leaf_hash().alias("leaf"),
                         tampered(F.col("`doc_id`"), F.col("`text`")).alias("found"))
    leaves = stored(leaves, "merkle-leaves")                                   # texts are read once
    rows, table = numbered(leaves, "_g", ["doc_id", "leaf"], "merkle-order")
    nodes = rows.select("_g", "doc_id", "source", "leaf", "idx", "total", F.col("leaf").alias("node"), F.coalesce("found", "leaf").alias("folded"))
    inside = _pivoted(nodes, "_g", fold=True)
    # blocks of all sources and their way to the subroots
    blocks = stored(_blocks(inside, "_g"), "merkle-blocks")
    most = blocks.agg(F.max("total")).first()[0] or 0
    ways = stored(_climb(blocks, "_g", most), "merkle-ways")
    # the tree over the sources
    tops = ways.where("idx = 0").select(F.lit("").alias("_all"), "_g", F.col("top").alias("node"))
    sources, order = numbered(tops, "_all", ["_g"], "merkle-sources")
    sources = stored(sources, "merkle-subroots")
    discard(order)
    root = _climb(sources, "_all", sources.agg(F.max("total")).first()[0] or 0)
    named = sources.select("idx", "_g", F.col("node").alias("subroot"))
    root = named.join(root.select("idx", F.col("path").alias("_last"), F.col("top").alias("root")), "idx")
    full = ways.join(root.drop("idx"), "_g").select("_g", F.col("idx").alias("_block"), F.concat("path", "_last").alias("_way"), "subroot", "root")
    done = inside.join(full, ["_g", "_block"])
    folded = F.aggregate("_way", F.col("folded"), lambda acc, x: digest(x["before"], acc, x["after"]))
    above = F.array_join(F.transform("_way", lambda x: F.concat(x["before"], x["after"])), "")
    out = done.select("doc_id", "source", "leaf", "subroot", "root", digest(F.col("siblings"), above).alias("proof_sha256"),
                      folded.alias("folded_root"))
    return Manifest(out.withColumn("verified", F.col("folded_root") == F.col("root")), root.select(F.when(F.col("_g") != "0", F.substring("_g", 2, 1 << 30)).alias("source"), "subroot", "root"))


def op12_merkle_manifest(spark, sf_dir: str) -> DataFrame:
    """All documents under one root, each with its proof and the check of its (for half of them changed) row."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = manifest(docs).rows
    return found.select(F.col("doc_id").cast("long").alias("doc_id"), "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


def _sql_value(column: str) -> str:
    return f"coalesce(strlen({column}::VARCHAR)::VARCHAR || ':' || {column}::VARCHAR, '-')"


def _sql_leaf(text: str) -> str:
    return "sha256(concat(" + ", ".join(_sql_value(text if f == "text" else f) for f in FIELDS) + "))"


#: The manifest level by level: whole runs are joined as texts, each row then walks up to the root.
SQL = f"""
WITH RECURSIVE hashed AS (
  SELECT doc_id, coalesce('1' || source, '0') AS g, {_sql_leaf("text")} AS leaf, {_sql_leaf("replace(text, chr(10), '')")} AS bare,
         list_reduce(list_concat([4294967295::UBIGINT], list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::UBIGINT)),
                     lambda crc, b: list_reduce(list_concat([xor(crc, b)], [0::UBIGINT, 0, 0, 0, 0, 0, 0, 0]),
                                          lambda x, bit: CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384::UBIGINT) ELSE x // 2 END)) AS register
  FROM documents
), leaves AS (
  SELECT doc_id, g, leaf, CASE WHEN xor(register, 4294967295::UBIGINT) % 2 = 0 THEN bare ELSE leaf END AS found,
         row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx, count(*) OVER (PARTITION BY g) AS n
  FROM hashed
), tree AS (
  SELECT g, 0 AS lev, idx, n, leaf AS h FROM leaves
  UNION ALL
  SELECT g, lev + 1, idx // 3, (n + 2) // 3, sha256(string_agg(h, '' ORDER BY idx)) FROM tree WHERE n > 1 GROUP BY g, lev, n, idx // 3
), tops AS (
  SELECT g, h AS subroot, row_number() OVER (ORDER BY g) - 1 AS idx, count(*) OVER () AS n FROM tree WHERE n = 1
), crown AS (
  SELECT 0 AS lev, idx, n, subroot AS h FROM tops
  UNION ALL
  SELECT lev + 1, idx // 3, (n + 2) // 3, sha256(string_agg(h, '' ORDER BY idx)) FROM crown WHERE n > 1 GROUP BY lev, n, idx // 3
), runs AS (
  SELECT g, lev, idx // 3 AS up, list(h ORDER BY idx) AS run FROM tree WHERE n > 1 GROUP BY ALL
  UNION ALL
  SELECT NULL, lev, idx // 3, list(h ORDER BY idx) FROM crown WHERE n > 1 GROUP BY ALL
), ways AS (
  SELECT doc_id, g, idx AS number, 0 AS lev, idx, found AS folded, '' AS proof FROM leaves
  UNION ALL
  SELECT w.doc_id, w.g, w.number, w.lev + 1, w.idx // 3,
         sha256(list_aggregate(list_concat(run[:w.idx % 3], [w.folded], run[w.idx % 3 + 2:]), 'string_agg', '')),
         w.proof || coalesce(list_aggregate(list_concat(run[:w.idx % 3], run[w.idx % 3 + 2:]), 'string_agg', ''), '')
  FROM ways w JOIN runs r ON r.g = w.g AND r.lev = w.lev AND r.up = w.idx // 3
), in_source AS (
  SELECT g, number, arg_max(folded, lev) AS folded, arg_max(proof, lev) AS proof FROM ways GROUP BY g, number
), last_ways AS (
  SELECT s.g, s.number, 0 AS lev, t.idx, s.folded, s.proof FROM in_source s JOIN tops t USING (g)
  UNION ALL
  SELECT w.g, w.number, w.lev + 1, w.idx // 3,
         sha256(list_aggregate(list_concat(run[:w.idx % 3], [w.folded], run[w.idx % 3 + 2:]), 'string_agg', '')),
         w.proof || coalesce(list_aggregate(list_concat(run[:w.idx % 3], run[w.idx % 3 + 2:]), 'string_agg', ''), '')
  FROM last_ways w JOIN runs r ON r.g IS NULL AND r.lev = w.lev AND r.up = w.idx // 3
), done AS (
  SELECT g, number, arg_max(folded, lev) AS folded, arg_max(proof, lev) AS proof FROM last_ways GROUP BY g, number
)
SELECT l.doc_id, l.leaf, t.subroot, c.h AS root, sha256(d.proof) AS proof_sha256, d.folded AS folded_root, d.folded = c.h AS verified
FROM leaves l JOIN tops t USING (g) JOIN done d ON d.g = l.g AND d.number = l.idx CROSS JOIN (SELECT h FROM crown WHERE n = 1) c
"""
