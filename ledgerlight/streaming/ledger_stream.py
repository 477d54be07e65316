"""Incremental ledger ingest with Structured Streaming.

The reference reloads its raw ledger file in full. Here new raw files that
land in a folder are picked up as a stream and go through the SAME
cleansing and rule operators as the batch silver build:

  readStream.csv(all-text schema) -> vw_lancamentos (null dates dropped,
  unknown cost centre -> -1, abs value + original, status normalised)
  -> FK flags against the (static, broadcast if small) dimensions
  -> rules.split -> valid rows to the fact table, rejects aside.

Each micro-batch is written with ``foreachBatch`` into folders partitioned
by (ano, mes, lote) with dynamic partition overwrite, so a batch that is
replayed after a failure rewrites its own partition instead of adding
duplicates; the checkpoint (in the shared checkpoint folder) records the
files already consumed.

Ids stay unique (R1, Q4): repeats inside a batch and ids of earlier batches
are rejects. What was loaded is looked up in an index, not in the fact table:
every batch leaves its ids, sorted, and a list of the id ranges that they lie
in. A batch reads the ids only of batches that share a range with it, and
there only the row groups between its own ids; a batch of new ids reads none.

``start_daily_totals`` also keeps the A3 rollup, and ``start_running_totals`` the
month-to-date totals per entry (W12, W13): per touched day the running sums
inside the day, and the day's totals. Offsets of earlier days of the month are
added when rows are read, from at most 31 totals per group and month, so a
late entry corrects the whole month and rewrites one day.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ledgerlight import schemas as S
from ledgerlight.operators import rules
from ledgerlight.operators.running import running_sum
from ledgerlight.plans import silver as silver_plan
from ledgerlight.plans.config import Config
from ledgerlight.session import file_system
from ledgerlight.sources.files import CSV_OPTIONS
from ledgerlight.sources.snapshots import Snapshots

BATCH_COL = "lote"

FILES_PER_TRIGGER = 100

#: Ids of one range of the index.
ID_RANGE = 1 << 20

#: Ids that a task of the index's write sorts, about.
IDS_OF_TASK = 1 << 21

#: Groups of the running totals (with the month), by column.
RUNNING = {"gasto_mtd": ["id_centro_custo", "id_categoria", "id_fornecedor", "id_campanha"], "gasto_mtd_cc_cat": ["id_centro_custo", "id_categoria"]}
_DAY = "data_lancamento"


def read_landing(spark: SparkSession, landing_dir: str, max_files_per_trigger: int = FILES_PER_TRIGGER) -> DataFrame:
    """Raw ledger CSV files as an all-text stream (schema declared, never inferred)."""
    return (spark.readStream.schema(S.STG_LANCAMENTOS).options(**CSV_OPTIONS)
            .option("maxFilesPerTrigger", str(max_files_per_trigger)).csv(landing_dir))


def cleanse_stream(raw: DataFrame, sv: silver_plan.Silver, cfg: Config) -> DataFrame:
    """Stream of typed ledger rows with the rule results attached."""
    lanc = silver_plan.vw_lancamentos(raw, sv.dim_centro_custo)
    flagged = silver_plan._fk_flags(lanc, {
        "centro_custo": ("id_centro_custo", sv.dim_centro_custo, "id_cc"),
        "categoria": ("id_categoria", sv.dim_categoria, "id_categoria"),
        "fornecedor": ("id_fornecedor", sv.dim_fornecedores, "id_forn"),
        "campanha": ("id_campanha", sv.dim_camp_marketing, "id_camp")})
    return flagged.withColumn(rules.RULES_COL, rules.broken(silver_plan.ledger_rules(cfg)))


def _append(df: DataFrame, path: str, keys: list[str]) -> None:
    """Write ``df`` by ``keys``; the partitions that it has rows of are replaced as a whole."""
    (df.hint("rebalance", *keys).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(*keys).parquet(path))


def _id_range() -> Column:
    return F.floor(F.col("id_lancamento") / ID_RANGE).cast("long").alias("faixa")


class LoadedIds:
    """The ids that earlier batches loaded, by batch: ``ids`` (sorted) and ``ranges`` (the id ranges that they lie in)."""

    def __init__(self, spark: SparkSession, out: str) -> None:
        self.spark, self.out = spark, out
        self.ids, self.ranges = f"{out}/ids_lancamentos", f"{out}/faixas_lancamentos"

    def add(self, loaded: DataFrame) -> None:
        """Index the ids of ``loaded`` (``id_lancamento, lote``); a batch that is replayed replaces its own."""
        ids = loaded.select("id_lancamento", BATCH_COL)
        tasks = 1 + ids.count() // IDS_OF_TASK                          # a task sorts some ranges, however many ids the batch has
        (ids.repartition(tasks, BATCH_COL, _id_range()).sortWithinPartitions(BATCH_COL, "id_lancamento").write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy(BATCH_COL).parquet(self.ids))
        _append(ids.select(_id_range(), BATCH_COL).distinct(), self.ranges, [BATCH_COL])

    def among(self, rows: DataFrame, batch_id: int) -> DataFrame | None:
        """Ids that other batches loaded and ``rows`` may hold; None if no batch shares an id range with ``rows``."""
        fs, ranges = file_system(self.spark, self.ranges)
        if not fs.exists(ranges):
            fs, fact = file_system(self.spark, f"{self.out}/fact_lancamentos")
            if not fs.exists(fact):
                return None
            self.add(read_ingested(self.spark, self.out).filter(F.col(BATCH_COL) != batch_id))        # loaded before there was an index
        ranges = self.spark.read.schema(f"faixa long, {BATCH_COL} long").parquet(self.ranges).filter(F.col(BATCH_COL) != batch_id)
        met = ranges.join(rows.select(_id_range()).distinct(), "faixa", "left_semi").select(BATCH_COL).distinct()
        batches = [r[BATCH_COL] for r in met.collect()]                 # numbers of batches, not rows
        if not batches:
            return None
        low, high = rows.agg(F.min("id_lancamento"), F.max("id_lancamento")).first()
        ids = self.spark.read.schema(f"id_lancamento long, {BATCH_COL} long").parquet(self.ids)
        return ids.filter(F.col(BATCH_COL).isin(*batches) & F.col("id_lancamento").between(low, high)).select("id_lancamento")


def _touched_days(spark: SparkSession, out: str, batch: DataFrame) -> DataFrame:
    """All loaded entries of the days of ``batch``; only the folders of their months are read."""
    days = batch.select(_DAY).distinct()
    months = [tuple(r) for r in days.select(F.year(_DAY), F.month(_DAY)).distinct().collect()]        # as many as the calendar has
    fact = read_ingested(spark, out).filter(Snapshots.among(["ano", "mes"], months))
    return fact.join(days, _DAY, "left_semi").select(*[f.name for f in S.FACT_LANCAMENTOS.fields])


def _running_of_days(entries: DataFrame) -> DataFrame:
    """Entries with their running sums inside the day."""
    for name, group in RUNNING.items():
        entries = running_sum(entries, [_DAY, *group], _DAY, "id_lancamento", "valor", name)
    return entries


def _writer(out_dir: str, totals: bool = False, running: bool = False):
    cols = [f.name for f in S.FACT_LANCAMENTOS.fields]
    out = out_dir.rstrip("/")

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        batch.persist()                     # one micro-batch, read by several writes
        by_month = {"ano": F.year(_DAY), "mes": F.month(_DAY), BATCH_COL: F.lit(batch_id)}
        kept, repeats = rules.keep_first_of_few(batch.filter(F.size(rules.RULES_COL) == 0).select(*cols), ["id_lancamento"], "id_lancamento_unique")
        index = LoadedIds(spark, out)
        loaded = index.among(kept, batch_id)
        if loaded is not None:              # ids of other batches: the first batch wins, a replayed batch meets no rows of its own
            again = kept.join(loaded, "id_lancamento", "left_semi").withColumn(rules.RULES_COL, F.array(F.lit("id_lancamento_unique")))
            kept, repeats = kept.join(loaded, "id_lancamento", "left_anti"), repeats.unionByName(again)
        kept = kept.select(*cols)
        broken = batch.filter(F.size(rules.RULES_COL) > 0).select(*cols, rules.RULES_COL)
        _append(kept.withColumns(by_month), f"{out}/fact_lancamentos", ["ano", "mes", BATCH_COL])
        _append(broken.unionByName(repeats).withColumns(by_month), f"{out}/rejects_lancamentos", ["ano", "mes", BATCH_COL])
        index.add(kept.withColumn(BATCH_COL, F.lit(batch_id)))
        if totals:
            days = _touched_days(spark, out, batch).groupBy(_DAY, "id_centro_custo", "id_categoria").agg(F.sum("valor").alias("total_do_dia"))
            _append(days, f"{out}/daily_totals", [_DAY])
        if running:
            entries = _touched_days(spark, out, batch)
            _append(_running_of_days(entries), f"{out}/running_entries", [_DAY])
            _append(entries.groupBy(_DAY, *RUNNING["gasto_mtd"]).agg(F.sum("valor").alias("total_do_dia")), f"{out}/running_days", [_DAY])
        batch.unpersist()
    return write


def _start(stream: DataFrame, write, checkpoint: str, available_now: bool) -> StreamingQuery:
    w = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return (w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")).start()


def start_ingest(spark: SparkSession, landing_dir: str, out_dir: str, checkpoint: str,
                 sv: silver_plan.Silver, cfg: Config, available_now: bool = True) -> StreamingQuery:
    """Start the ingest query (``availableNow`` processes what has landed and stops)."""
    return _start(cleanse_stream(read_landing(spark, landing_dir), sv, cfg), _writer(out_dir), checkpoint, available_now)


def read_ingested(spark: SparkSession, out_dir: str, table: str = "fact_lancamentos") -> DataFrame:
    return spark.read.parquet(f"{out_dir.rstrip('/')}/{table}")


def start_daily_totals(spark: SparkSession, landing_dir: str, out_dir: str, checkpoint: str,
                       sv: silver_plan.Silver, cfg: Config, available_now: bool = True) -> StreamingQuery:
    """A3 maintained incrementally: the ingest, and after each micro-batch the
    totals of the days it touched, from the fact table. A day is a partition
    that is overwritten as a whole, so a crash or a replayed batch leaves
    every day right, late entries included, and no other day is rewritten."""
    return _start(cleanse_stream(read_landing(spark, landing_dir), sv, cfg), _writer(out_dir, totals=True), checkpoint, available_now)


def read_daily_totals(spark: SparkSession, out_dir: str) -> DataFrame:
    days = spark.read.parquet(f"{out_dir.rstrip('/')}/daily_totals")
    return days.withColumn("data_lancamento", F.col("data_lancamento").cast("date"))


def start_running_totals(spark: SparkSession, landing_dir: str, out_dir: str, checkpoint: str,
                         sv: silver_plan.Silver, cfg: Config, available_now: bool = True) -> StreamingQuery:
    """W12, W13 maintained incrementally: the ingest, and after each
    micro-batch the running sums inside the days it touched and these days'
    totals. A day is overwritten as a whole, so replays and late entries are right."""
    return _start(cleanse_stream(read_landing(spark, landing_dir), sv, cfg), _writer(out_dir, running=True), checkpoint, available_now)


def read_running_totals(spark: SparkSession, out_dir: str) -> DataFrame:
    """The loaded entries with the month-to-date totals ``gasto_mtd`` and ``gasto_mtd_cc_cat``: the running sum inside the
    day, and the totals of the group's earlier days of the month (30 at most). NULL keys form groups, as in windows."""
    out = out_dir.rstrip("/")
    day = F.col(_DAY).cast("date").alias(_DAY)
    entries, days = (spark.read.parquet(f"{out}/{name}").withColumn(_DAY, day) for name in ("running_entries", "running_days"))
    for name, group in RUNNING.items():
        key = F.struct(*group).alias("__g")
        of_day = days.select(_DAY, key, "total_do_dia").groupBy(_DAY, "__g").agg(F.sum("total_do_dia").alias("__t"))
        earlier = (Window.partitionBy("__g", F.trunc(_DAY, "MM")).orderBy(_DAY).rowsBetween(Window.unboundedPreceding, -1))
        offsets = of_day.select(_DAY, "__g", F.coalesce(F.sum("__t").over(earlier), F.lit(0)).alias("__before"))
        entries = (entries.withColumn("__g", F.struct(*group)).join(offsets, [_DAY, "__g"])
                   .withColumn(name, F.col(name) + F.col("__before")).drop("__g", "__before"))
    return entries.select(*[f.name for f in S.FACT_LANCAMENTOS.fields], *RUNNING)
