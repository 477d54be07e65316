"""File sources and sinks.

Raw files are read with an explicit all-text schema: nothing is inferred,
the header line is skipped, a UTF-8 BOM never reaches a column name, and
columns bind by position (the declared staging names win over the header).
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlight.session import checkpoint_dir, file_system
from ledgerlight.sources.snapshots import Conflict, Snapshots

CSV_OPTIONS = {
    "header": "true",
    "sep": ",",
    "encoding": "UTF-8",
    "mode": "PERMISSIVE",           # a short/long line never fails the load; it is kept as a reject
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}


_BROKEN = "__linha"
REJECTED_LINE = "linha"


def _read_csv(spark: SparkSession, path: str | Sequence[str], schema: T.StructType, options: dict[str, str]) -> DataFrame:
    checked = T.StructType([*schema.fields, T.StructField(_BROKEN, T.StringType())])
    opts = {**CSV_OPTIONS, "columnNameOfCorruptRecord": _BROKEN, "columnPruning": "false", **options}
    return spark.read.schema(checked).options(**opts).csv(path if isinstance(path, str) else list(path))


def ingest_csv(spark: SparkSession, path: str | Sequence[str], schema: T.StructType, **options: str) -> DataFrame:
    """B1: bulk-ingest CSV files into an all-text staging DataFrame: the lines
    that have exactly the declared fields. ``multiLine="true"`` keeps line
    breaks inside quotes. The other lines are in ``ingest_rejects``."""
    read = _read_csv(spark, path, schema, options)
    return read.filter(F.col(_BROKEN).isNull()).select(*schema.names)


def ingest_rejects(spark: SparkSession, path: str | Sequence[str], schema: T.StructType, **options: str) -> DataFrame:
    """The lines that ``ingest_csv`` leaves out, whole: surplus or missing fields, broken quotes -> (linha)."""
    read = _read_csv(spark, path, schema, options)
    # the reader wants a parsed column beside the line
    line = F.coalesce(F.col(_BROKEN), F.col(schema.names[0])).alias("linha")
    return read.filter(F.col(_BROKEN).isNotNull()).select(line)


def raw_lines(spark: SparkSession, path: str | Sequence[str], schema: T.StructType, **options: str) -> DataFrame:
    """Every line of CSV files: the declared text columns, and ``linha``, which holds the whole line where it does not
    have the declared fields (NULL otherwise). ``ingest_csv`` and ``ingest_rejects`` in one reading."""
    return _read_csv(spark, path, schema, options).withColumnRenamed(_BROKEN, REJECTED_LINE)


def raw_path(spark: SparkSession, folder: str, name: str) -> str:
    """``<folder>/<name>.csv`` or the folder ``<folder>/<name>`` of parts, nothing else of a similar name."""
    base = f"{folder.rstrip('/')}/{name}"
    for path in (f"{base}.csv", base):
        fs, p = file_system(spark, path)
        if fs.exists(p):
            return path
    raise FileNotFoundError(f"neither {base}.csv nor {base}/ exists")


def write_csv(df: DataFrame, path: str) -> None:
    """Land a DataFrame as header CSV (blanks kept, NULL as empty field)."""
    df.write.mode("overwrite").options(**CSV_OPTIONS).csv(path)


def full_refresh(df: DataFrame, path: str, partition_by: Sequence[str] = (),
                 fmt: str = "parquet") -> DataFrame:
    """Idempotent reload of a target, then read back.

    The new table is written to a folder of its own and becomes the current
    one by one atomic step (``snapshots``): a run that fails at any point
    leaves the old table as it was, and readers of the old one are not
    disturbed. ``read_table`` reads it later. Of concurrent reloads each is
    whole; the last one stays.
    """
    store = Snapshots(df.sparkSession, path)
    written = store.write("table", df, partition_by, fmt)
    version = publish(store, {"table": written})
    store.vacuum()
    return store.read("table", version)


def publish(store: Snapshots, tables: dict, tries: int = 20) -> dict:
    """Publish whole tables; another writer's version in between does not matter, theirs is replaced."""
    for n in range(tries):
        try:
            return store.publish(tables)
        except Conflict:
            if n == tries - 1:
                raise
            time.sleep(0.05 * (n + 1))
    raise AssertionError


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """The current rows of a target of ``full_refresh``."""
    return Snapshots(spark, path).read("table")


def remove(spark: SparkSession, path: str) -> None:
    fs, p = file_system(spark, path)
    fs.delete(p, True)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint folder (never machine-local
    on a cluster: the cluster names ``spark.checkpoint.dir``)."""
    return f"{checkpoint_dir(spark).rstrip('/')}/ledgerlight-{name}-{uuid.uuid4().hex[:12]}"


def taken_over(df: DataFrame, path: str) -> DataFrame:
    """``df``, which reads scratch files, as a checkpoint; the scratch folder is removed.

    Checkpoints lie in the shared folder too and go when they are no longer referenced."""
    out = df.checkpoint()
    remove(df.sparkSession, path)
    return out


def publish_views(tables: dict[str, DataFrame]) -> list[str]:
    """Expose DataFrames to SQL as temporary views."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)
    return sorted(tables)
