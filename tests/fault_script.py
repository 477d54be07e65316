"""Run by test_fault_tolerance in its own JVM (local mode with task retries)."""

import sys
import tempfile

sys.path.insert(0, sys.argv[1])

from pyspark import TaskContext  # noqa: E402
from pyspark.sql import SparkSession, Window  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from ledgerlight.operators.running import running_sum  # noqa: E402

spark = (SparkSession.builder.master("local[4,4]").config("spark.sql.shuffle.partitions", "8")
         .config("spark.ui.enabled", "false").config("spark.checkpoint.dir", tempfile.mkdtemp())
         .getOrCreate())
spark.sparkContext.setLogLevel("OFF")


@F.udf("long")
def fail_once(v):
    """Raise in the first attempt of task 1 of its stage (an injected task loss)."""
    tc = TaskContext.get()
    if tc.attemptNumber() == 0 and tc.partitionId() == 1:
        raise RuntimeError("injected task failure")
    return v


df = spark.range(0, 20000, numPartitions=4).select(
    F.col("id"), F.when(F.col("id") % 5 == 0, F.lit("cold")).otherwise(F.lit("hot")).alias("g"),
    (F.col("id") % 29).alias("d"), fail_once(F.col("id") % 97).alias("v"))          # fails before the blocks
out = running_sum(df, ["g"], "d", "id", "v", "rs", block=64)
out = out.withColumn("rs", fail_once(F.col("rs")))                                     # fails after them
clean = spark.range(0, 20000, numPartitions=4).select(
    F.col("id"), F.when(F.col("id") % 5 == 0, F.lit("cold")).otherwise(F.lit("hot")).alias("g"),
    (F.col("id") % 29).alias("d"), (F.col("id") % 97).alias("v"))
w = Window.partitionBy("g").orderBy("d", "id").rowsBetween(Window.unboundedPreceding, 0)
want = clean.withColumn("rs", F.sum("v").over(w))
diff = out.select("id", "rs").exceptAll(want.select("id", "rs")).count()
print("DIFF", diff, out.count())
