"""Staging (bronze) tables derived from the driver's test data.

The star schema of the budget pipeline is planted on the TPC-H-like tables:
one ledger entry per order, one budget cell per (year, month, nation,
market segment) of shipped lines, nations as cost centres, segments as
categories and suppliers as suppliers. The defects of the raw files are
reproduced: null dates, orphan cost centres, negative values, five status
spellings, float-text keys, blanks and letter case in names, a null-key
duplicate category and x20 budget outliers.

Every table is all-text, exactly like a raw CSV landed in staging.
"""

from __future__ import annotations

import weakref
from collections.abc import Iterator, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlight.functions.text import sentence_case

# Fixed values of the test-data mapping.
SEGMENT_TO_CATEGORY = (("AUTOMOBILE", 101), ("BUILDING", 102), ("FURNITURE", 103),
                       ("HOUSEHOLD", 104))
OTHER_CATEGORY = 105
EXCLUDED_REGION = 4                     # its nations are not cost centres -> orphans
NULL_DATE_MODULUS = 97                  # o_orderkey % 97 = 0 -> null date
NEGATIVE_MODULUS = 89                   # o_orderkey % 89 = 0 -> negative value
OUTLIER_MODULUS = 53                    # (ano*12 + mes + cc + cat) % 53 = 0 -> x20
OUTLIER_FACTOR = 20
UNSPECIFIED_PRIORITY = "4-NOT SPECIFIED"
OTHER_CATEGORY_CC = 5                   # categories 101..104 belong to cost centre cat-101
DUPLICATED_SEGMENT = "BUILDING"         # planted null-key duplicate category name
REPEATED_ENTRY_MODULUS = 101            # o_orderkey % 101 = 0 -> the id comes twice, the second value + 1
REPEATED_CELL_MODULUS = 47              # (ano + mes + cc + cat) % 47 = 0 -> the budget id comes twice
REPEATED_CENTRE_MODULUS = 5             # n_nationkey % 5 = 0 -> a second name under the same key
BAD_CENTRE_MODULUS, BAD_CENTRE_REST = 11, 1     # n_nationkey % 11 = 1 -> a row whose key is no number
REPEATED_SUPPLIER_MODULUS = 7           # s_suppkey % 7 = 0 -> the same row twice
CAMPAIGN_MONTH = (("1", "5"), ("2", "8"), ("3", "11"), ("5", "12"))  # priority digit -> month


_OPENED: "weakref.WeakKeyDictionary[SparkSession, dict[str, DataFrame]]" = weakref.WeakKeyDictionary()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table, opened once per session and folder (opening reads the file's schema in a job)."""
    opened = _OPENED.setdefault(spark, {})
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    if path not in opened:
        opened[path] = spark.read.parquet(path)
    return opened[path]


#: The given tables that staging is planted on.
SOURCES = ("nation", "customer", "supplier", "orders", "lineitem")


def source_paths(sf_dir: str) -> list[str]:
    return [f"{sf_dir.rstrip('/')}/{name}.parquet" for name in SOURCES]


def forget(spark: SparkSession, sf_dir: str) -> None:
    """Open the tables of a folder anew (their files may have changed)."""
    opened = _OPENED.get(spark, {})
    for path in source_paths(sf_dir):
        opened.pop(path, None)


def copies(repeated: Column) -> Column:
    """Copy numbers of a row: 0, and 1 for repeated rows (to be exploded)."""
    return F.explode(F.when(repeated, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))


def segment_category(col) -> F.Column:
    expr = F.lit(OTHER_CATEGORY)
    for seg, cat in reversed(SEGMENT_TO_CATEGORY):
        expr = F.when(col == seg, F.lit(cat)).otherwise(expr)
    return expr


def stg_lancamentos(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    # first supplier of each order: partial aggregation before the shuffle
    s = (table(spark, sf_dir, "lineitem").groupBy("l_orderkey")
         .agg(F.min("l_suppkey").alias("l_suppkey")))
    j = (o.join(c, o.o_custkey == c.c_custkey)
         .join(s, o.o_orderkey == s.l_orderkey, "left"))
    k = F.col("o_orderkey")
    j = j.select("*", copies(k % REPEATED_ENTRY_MODULUS == 0).alias("copia"))
    value = F.when(k % NEGATIVE_MODULUS == 0, -F.col("o_totalprice")).otherwise(F.col("o_totalprice"))
    status = (F.when(F.col("o_orderstatus") == "F",
                     F.when(k % 3 == 0, "PAGO").when(k % 3 == 1, "Paga").otherwise("Pago"))
              .when(F.col("o_orderstatus") == "P", "Pago")
              .otherwise(F.when(k % 2 == 0, "Aberto").otherwise("Pending")))
    return j.select(
        k.cast("string").alias("id_lancamento"),
        F.when(k % NULL_DATE_MODULUS == 0, F.lit(None).cast("string"))
         .otherwise(F.col("o_orderdate").cast("date").cast("string")).alias("data_lancamento"),
        F.col("c_nationkey").cast("string").alias("id_centro_custo"),
        segment_category(F.col("c_mktsegment")).cast("string").alias("id_categoria"),
        F.col("l_suppkey").cast("string").alias("id_fornecedor"),
        F.when(F.col("o_orderpriority") == UNSPECIFIED_PRIORITY, F.lit(None).cast("string"))
         .otherwise(F.concat(F.substring("o_orderpriority", 1, 1), F.lit(".0")))
         .alias("id_campanha_marketing"),
        (value.cast("decimal(16,2)") + F.col("copia")).cast("decimal(16,2)").cast("string").alias("valor_lancamento"),
        status.alias("status_pagamento"),
    )


def stg_orcamento(spark: SparkSession, sf_dir: str) -> DataFrame:
    l = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_extendedprice", "l_shipdate")
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    n = (table(spark, sf_dir, "nation").filter(F.col("n_regionkey") != EXCLUDED_REGION)
         .select("n_nationkey"))
    # orders meet their customers first, so that the lines, the largest table, are shuffled once and by order
    of_order = (o.join(c.join(n, c.c_nationkey == n.n_nationkey), o.o_custkey == c.c_custkey)
                .select("o_orderkey", F.col("c_nationkey").alias("cc"), segment_category(F.col("c_mktsegment")).alias("cat")))
    cells = (l.join(of_order, l.l_orderkey == of_order.o_orderkey)
             .groupBy(F.year("l_shipdate").alias("ano"), F.month("l_shipdate").alias("mes"), "cc", "cat")
             .agg(F.sum(F.col("l_extendedprice").cast("decimal(16,2)")).alias("v")))
    factor = F.when((F.col("ano") * 12 + F.col("mes") + F.col("cc") + F.col("cat")) % OUTLIER_MODULUS == 0,
                    F.lit(OUTLIER_FACTOR)).otherwise(F.lit(1))
    # Deterministic cell key instead of a global row_number (no single-task window).
    cell_id = (F.col("ano") * 12 + F.col("mes")) * 10000 + F.col("cc") * 100 + F.col("cat") % 100
    cells = cells.select("*", copies((F.col("ano") + F.col("mes") + F.col("cc") + F.col("cat")) % REPEATED_CELL_MODULUS == 0).alias("copia"))
    return cells.select(
        cell_id.cast("string").alias("id_orcamento"),
        F.col("ano").cast("string").alias("ano"),
        F.col("mes").cast("string").alias("mes"),
        F.col("cc").cast("string").alias("id_centro_custo"),
        F.col("cat").cast("string").alias("id_categoria"),
        ((F.col("v") * factor).cast("decimal(18,2)") + F.col("copia")).cast("decimal(18,2)").cast("string").alias("valor_orcado"),
    )


def stg_dim_centro_custo(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = table(spark, sf_dir, "nation").filter(F.col("n_regionkey") != EXCLUDED_REGION)
    k = F.col("n_nationkey")
    name = (F.when(k % 4 == 0, F.col("n_name"))
            .when(k % 4 == 1, F.concat(F.lit(" "), F.col("n_name")))
            .when(k % 4 == 2, F.concat(F.col("n_name"), F.lit(" ")))
            .otherwise(F.lower("n_name")))
    repeated = k % REPEATED_CENTRE_MODULUS == 0
    again = n.filter(repeated | (k % BAD_CENTRE_MODULUS == BAD_CENTRE_REST)).select(
        F.when(repeated, k.cast("string")).otherwise(F.concat(F.lit("CC"), k.cast("string"))).alias("id_cc"),
        F.concat("n_name", F.lit(" bis")).alias("nome_cc"))
    return n.select(k.cast("string").alias("id_cc"), name.alias("nome_cc")).unionByName(again)


def stg_dim_categoria(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One category per market segment present in ``customer`` (float-text
    keys), plus a null-key, upper-case duplicate of one of them."""
    seg = table(spark, sf_dir, "customer").select("c_mktsegment").distinct()
    cat = segment_category(F.col("c_mktsegment"))
    cc = F.when(cat == OTHER_CATEGORY, F.lit(OTHER_CATEGORY_CC)).otherwise(cat - 101)
    good = seg.select(
        F.concat(cat.cast("string"), F.lit(".0")).alias("id_cat"),
        F.concat(cc.cast("string"), F.lit(".0")).alias("id_cc"),
        sentence_case("c_mktsegment").alias("nome_cat"))
    dup = seg.filter(F.col("c_mktsegment") == DUPLICATED_SEGMENT).select(
        F.lit(None).cast("string").alias("id_cat"), F.lit(None).cast("string").alias("id_cc"),
        F.col("c_mktsegment").alias("nome_cat"))
    return good.unionByName(dup)


def stg_dim_fornecedores(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", copies(F.col("s_suppkey") % REPEATED_SUPPLIER_MODULUS == 0))
    return s.select(F.col("s_suppkey").cast("string").alias("id_forn"), F.col("s_name").alias("nome_forn"))


def stg_dim_campanha(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One campaign per order priority present in ``orders`` (but the
    unspecified one): id = leading digit, name from the priority text."""
    p = (table(spark, sf_dir, "orders").select("o_orderpriority").distinct()
         .filter(F.col("o_orderpriority") != UNSPECIFIED_PRIORITY))
    digit = F.substring("o_orderpriority", 1, 1)
    month = F.lit(None).cast("string")
    for d, m in reversed(CAMPAIGN_MONTH):
        month = F.when(digit == d, F.lit(m)).otherwise(month)
    return p.select(digit.alias("id_camp"),
                    sentence_case(F.substring_index("o_orderpriority", "-", -1)).alias("nome_camp"),
                    month.alias("mes_ref"))


_BUILDERS = {"stg_lancamentos": stg_lancamentos, "stg_orcamento": stg_orcamento, "stg_dim_centro_custo": stg_dim_centro_custo,
             "stg_dim_categoria": stg_dim_categoria, "stg_dim_fornecedores": stg_dim_fornecedores, "stg_dim_campanha": stg_dim_campanha}


class Staging(Mapping):
    """The six staging tables; each is planned when it is first asked for."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self._spark, self._dir, self._tables = spark, sf_dir, {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._tables:
            self._tables[name] = _BUILDERS[name](self._spark, self._dir)
        return self._tables[name]

    def __iter__(self) -> Iterator[str]:
        return iter(_BUILDERS)

    def __len__(self) -> int:
        return len(_BUILDERS)


def staging(spark: SparkSession, sf_dir: str) -> Staging:
    return Staging(spark, sf_dir)
