"""Join operators and the broadcast policy.

Three kinds of small sides, three rules:

* dimensions: broadcast only behind a size check (``fits`` / ``bounded`` /
  ``check_all``): at most 2 M rows and 64 MB, both measured with a limited
  scan. Above the bound the plain DataFrame is returned and Spark plans a
  shuffle join.
* sides derived from the data (group means, month totals, benchmark rows):
  no hint and no eager count (``runtime_sized``); AQE converts the join to a
  broadcast after measuring the side's shuffle output.
* one-row global aggregates (``with_scalars``): bounded by construction.

A foreign key whose parent is beyond the bound does not send the child's rows
through a shuffle either: its distinct keys are looked up (``absent_keys``), and
the rows meet only the keys that were not found, which are few in sound data.
"""

from __future__ import annotations

import weakref
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlight.session import checkpoint_dir

# A dimension is broadcast when it has at most this many rows AND its
# estimated size (rows x schema width) stays under BROADCAST_BYTES.
DEFAULT_BROADCAST_ROWS = 2_000_000
BROADCAST_BYTES = 64 << 20

_WIDTH = {"int": 4, "bigint": 8, "smallint": 2, "tinyint": 1, "double": 8, "float": 4, "date": 4,
          "timestamp": 8, "timestamp_ntz": 8, "boolean": 1, "string": 32}


def row_width(df: DataFrame) -> int:
    """Estimated bytes per row from the schema (strings counted as 32 bytes)."""
    w = 0
    for f in df.schema.fields:
        t = f.dataType.simpleString()
        w += 16 if t.startswith("decimal") else _WIDTH.get(t, 64)
    return max(w, 1)


def row_limit(df: DataFrame, max_rows: int = DEFAULT_BROADCAST_ROWS) -> int:
    return min(max_rows, BROADCAST_BYTES // row_width(df))


def _seen_bytes(df: DataFrame) -> Column:
    """Aggregate: real bytes of the rows, fixed-width columns by type and texts by length."""
    fixed = sum((16 if t.startswith("decimal") else _WIDTH.get(t, 64)) for t in (f.dataType.simpleString() for f in df.schema.fields) if t != "string")
    texts = [F.coalesce(F.sum(F.octet_length(f"`{f.name}`")), F.lit(0)) for f in df.schema.fields if f.dataType.simpleString() == "string"]
    return reduce(lambda x, y: x + y, texts, F.count(F.lit(1)) * max(fixed, 1)).cast("long")


_CHECKED: "weakref.WeakKeyDictionary[DataFrame, dict]" = weakref.WeakKeyDictionary()


def _memo(kind: str, df: DataFrame, arg, compute) -> bool:
    """Remember a size/NULL check per DataFrame object, so a dimension that
    is joined several times in one plan is checked once."""
    seen = _CHECKED.setdefault(df, {})
    if (kind, arg) not in seen:
        seen[(kind, arg)] = compute()
    return seen[(kind, arg)]


def fits(df: DataFrame, max_rows: int = DEFAULT_BROADCAST_ROWS) -> bool:
    """True when ``df`` has at most ``row_limit`` rows (``max_rows`` capped by
    the estimated width) and its real size, texts measured, is at most
    BROADCAST_BYTES; one scan of <= limit + 1 rows."""
    n = row_limit(df, max_rows)

    def check() -> bool:
        rows, size = df.limit(n + 1).agg(F.count(F.lit(1)), _seen_bytes(df)).first()
        return rows <= n and size <= BROADCAST_BYTES

    return _memo("fits", df, max_rows, check)


def has_null(df: DataFrame, col: str) -> bool:
    """True when ``col`` holds a NULL (stops at the first one)."""
    return _memo("null", df, col, lambda: df.filter(F.col(col).isNull()).limit(1).count() > 0)


def check_all(dims: dict[str, tuple[DataFrame, str]], max_rows: int = DEFAULT_BROADCAST_ROWS) -> None:
    """Size and NULL-key checks of several dimensions in ONE action: a union
    of limited one-row aggregates (each scans at most max_rows + 1 rows).
    The answers fill the memo used by ``fits`` / ``has_null``; a NULL-key
    answer is kept only when the whole dimension was seen."""
    todo = {n: (df, key) for n, (df, key) in dims.items() if ("fits", max_rows) not in _CHECKED.get(df, {})}
    if not todo:
        return
    limits = {name: row_limit(df, max_rows) for name, (df, _) in todo.items()}
    parts = [df.limit(limits[name] + 1)
               .agg(F.count(F.lit(1)).alias("n"), F.max(F.col(key).isNull().cast("int")).alias("nulls"), _seen_bytes(df).alias("size"))
               .select(F.lit(name).alias("dim"), "n", "nulls", "size")
             for name, (df, key) in todo.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    for r in out.collect():                              # one row per dimension
        df, key = todo[r["dim"]]
        seen = _CHECKED.setdefault(df, {})
        whole = r["n"] <= limits[r["dim"]]
        seen[("fits", max_rows)] = whole and r["size"] <= BROADCAST_BYTES
        if whole:
            seen[("null", key)] = bool(r["nulls"])


def remember(df: DataFrame, rows: int, size: int, keys: dict[str, bool], max_rows: int = DEFAULT_BROADCAST_ROWS) -> None:
    """Answers of ``fits`` and ``has_null`` for a table whose rows, bytes and NULL keys were counted when it was
    written, so that no query counts them again."""
    seen = _CHECKED.setdefault(df, {})
    seen[("fits", max_rows)] = rows <= row_limit(df, max_rows) and size <= BROADCAST_BYTES
    for column, nulls in keys.items():
        seen[("null", column)] = nulls


def size_facts(df: DataFrame, key: str) -> dict[str, Column]:
    """Aggregates that ``remember`` wants of a dimension."""
    return {"rows": F.count(F.lit(1)), "size": _seen_bytes(df), "nulls": F.count_if(F.col(key).isNull())}


def bounded(df: DataFrame, max_rows: int = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """Broadcast hint for ``df`` only if its size is proven small."""
    return F.broadcast(df) if fits(df, max_rows) else df


def runtime_sized(df: DataFrame) -> DataFrame:
    """A side derived from the data (group means, month totals): no hint and
    no eager count (that would run its whole plan twice). Adaptive execution
    measures the side after its shuffle and converts the join to a
    broadcast only under ``spark.sql.adaptive.autoBroadcastJoinThreshold``;
    above it the sort-merge join stays."""
    return df


def with_scalars(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """Attach the columns of a global aggregate (exactly one row, so the
    broadcast is bounded by construction) to every row, through a constant
    equi-join key."""
    k = "__one"
    return df.withColumn(k, F.lit(1)).join(F.broadcast(one_row.withColumn(k, F.lit(1))), k).drop(k)


def absent_keys(child: DataFrame, key: Column | str, parent: DataFrame, parent_key: str) -> DataFrame:
    """(__gone): the distinct non-null keys of ``child`` that ``parent`` lacks, as a checkpoint.

    Only keys travel: equal ones collapse before the shuffle, so a key that a third of all rows share is a row per
    task. The checkpoint lets the size of the result decide how the rows are joined with it."""
    checkpoint_dir(child.sparkSession)                   # the cluster's folder, set where it is not yet
    used = child.select((F.col(key) if isinstance(key, str) else key).alias("__gone")).filter(F.col("__gone").isNotNull()).distinct()
    keys = parent.select(F.col(parent_key).alias("__pk"))
    return used.join(keys, used["__gone"] == keys["__pk"], "left_anti").checkpoint()


def with_missing(child: DataFrame, key: Column | str, parent: DataFrame, parent_key: str, flag: str,
                 max_rows: int = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """``child`` with the boolean ``flag``: TRUE where the non-null ``key`` is not among the parent's keys (whose
    NULLs match nothing), never NULL. Rows are neither lost nor repeated.

    A parent of proven size is broadcast. Of a larger one only the absent keys meet the rows (``absent_keys``);
    these are broadcast if they are proven few, so the rows are not shuffled.
    """
    ck = F.col(key) if isinstance(key, str) else key
    own, other = f"__ck_{flag}", f"__pk_{flag}"
    probe = child.withColumn(own, ck)
    if fits(parent, max_rows):
        keys = F.broadcast(parent.select(F.col(parent_key).alias(other)).distinct())        # keys <= parent rows
        missing = F.col(own).isNotNull() & F.col(other).isNull()
    else:
        keys = bounded(absent_keys(child, ck, parent, parent_key).withColumnRenamed("__gone", other), max_rows)
        missing = F.col(other).isNotNull()
    return probe.join(keys, F.col(own) == F.col(other), "left").withColumn(flag, missing).drop(own, other)


def anti_join(child: DataFrame, parent: DataFrame, child_key: Column | str, parent_key: str,
              max_rows: int = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """Rows of ``child`` whose non-null key is absent from ``parent``.

    NOT IN semantics of the reference: a NULL probe key is never reported;
    a NULL inside the parent key list makes every probe unknown, so nothing
    is reported either.
    """
    ck = F.col(child_key) if isinstance(child_key, str) else child_key
    if has_null(parent, parent_key):
        return child.limit(0)
    probe = child.withColumn("__ck", ck).filter(F.col("__ck").isNotNull())
    if fits(parent, max_rows):
        keys = F.broadcast(parent.select(F.col(parent_key).alias("__pk")).distinct())        # keys <= parent rows
        return probe.join(keys, probe["__ck"] == keys["__pk"], "left_anti").drop("__ck")
    gone = bounded(absent_keys(child, ck, parent, parent_key), max_rows)
    return probe.join(gone, probe["__ck"] == gone["__gone"], "left_semi").drop("__ck")
