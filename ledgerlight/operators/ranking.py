"""Top-k reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlight.session import shuffle_partitions


def top_k(df: DataFrame, order: Sequence[Column], k: int) -> DataFrame:
    """Global top-k: ``orderBy().limit()`` plans a TakeOrderedAndProject
    (each task keeps k rows, the driver merges tasks x k rows)."""
    return df.orderBy(*order).limit(k)


def top_k_per_group(df: DataFrame, group: Sequence[str], order: Sequence[Column], k: int,
                    salt_col: str | None = None, buckets: int | None = None) -> DataFrame:
    """Top-k rows of every group, skew-safe.

    Phase 1 ranks inside (group, salt) where salt = hash(salt_col) mod
    ``buckets``, so a hot group is split over many window partitions; only
    k rows per (group, salt) survive. Phase 2 ranks those survivors
    (<= k x buckets per group). Ties are broken by the full ``order``.
    """
    n = buckets or max(1, shuffle_partitions(df.sparkSession))
    rank = "__rk"
    if salt_col is None:
        w = Window.partitionBy(*group).orderBy(*order)
        return df.withColumn(rank, F.row_number().over(w)).filter(F.col(rank) <= k).drop(rank)
    salted = df.withColumn("__salt", F.pmod(F.xxhash64(salt_col), F.lit(n)))
    w1 = Window.partitionBy(*group, "__salt").orderBy(*order)
    local = salted.withColumn(rank, F.row_number().over(w1)).filter(F.col(rank) <= k).drop(rank, "__salt")
    w2 = Window.partitionBy(*group).orderBy(*order)
    return local.withColumn(rank, F.row_number().over(w2)).filter(F.col(rank) <= k) \
                .withColumnRenamed(rank, "posicao")
