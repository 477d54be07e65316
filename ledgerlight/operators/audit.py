"""Row-count and schema audits."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def audit_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """(tabela, total_registros), one count job per table, unioned."""
    parts = [df.agg(F.count(F.lit(1)).alias("total_registros"))
               .select(F.lit(name).alias("tabela"), "total_registros")
             for name, df in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


SCHEMA_AUDIT = T.StructType([
    T.StructField("tabela", T.StringType()), T.StructField("coluna", T.StringType()),
    T.StructField("posicao", T.IntegerType()), T.StructField("tipo", T.StringType()),
    T.StructField("anulavel", T.BooleanType())])


def schema_audit(spark: SparkSession, tables: Mapping[str, DataFrame],
                 expected: Mapping[str, T.StructType] | None = None) -> DataFrame:
    """Column list of each table (name, position, type, nullable) from
    its analysed schema (metadata only: no data is read). With ``expected``
    the result is full-outer compared and carries ``tipo_esperado`` and
    ``confere`` (type matches)."""
    rows = [(name, f.name, i + 1, f.dataType.simpleString(), f.nullable)
            for name, df in tables.items() for i, f in enumerate(df.schema.fields)]
    actual = spark.createDataFrame(rows, SCHEMA_AUDIT)
    if not expected:
        return actual
    exp_rows = [(name, f.name, f.dataType.simpleString())
                for name, st in expected.items() for f in st.fields]
    exp = spark.createDataFrame(exp_rows, "tabela string, coluna string, tipo_esperado string")
    j = actual.join(exp, ["tabela", "coluna"], "full_outer")
    return j.withColumn("confere", F.coalesce(F.col("tipo") == F.col("tipo_esperado"), F.lit(False)))


def cast_audit(name: str, df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """B4 on the data: per column the declared type, the rows, the values that
    do not cast to the type, and the NULLs; one scan of the table."""
    aggs = [F.count(F.lit(1)).alias("linhas")]
    for c, t in types.items():
        aggs += [F.count_if(F.col(c).isNotNull() & F.col(c).try_cast(t).isNull()).alias(f"b_{c}"), F.count_if(F.col(c).isNull()).alias(f"n_{c}")]
    wide = df.agg(*aggs)
    rows = F.array(*[F.struct(F.lit(c).alias("coluna"), F.lit(t).alias("tipo"), F.col(f"b_{c}").alias("nao_convertidos"), F.col(f"n_{c}").alias("nulos"))
                     for c, t in types.items()])
    return wide.select("linhas", F.explode(rows).alias("r")).select(F.lit(name).alias("tabela"), "r.coluna", "r.tipo", "linhas", "r.nao_convertidos", "r.nulos")
