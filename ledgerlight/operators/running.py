"""Running totals over raw entries, one form for every size.

The total of an entry within its group (a month of a cost centre, ...) is the
sum of three parts, each over a bounded number of rows:

1. the totals of the group's earlier days: at most 31 per month;
2. inside the day, the totals of earlier blocks of ids: entries are dealt to
   blocks of ``block`` consecutive ids (``id div block``);
3. inside the block, the running sum by id. Ids are unique (enforced on
   load), so a block holds at most ``block`` entries.

Blocks are a function of the id: nothing is sampled, measured or
checkpointed, and a recomputed task deals the same blocks. A group of any
size is spread over (group, day, block); only day and block totals, from a
partial aggregation, meet per group and day.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

BLOCK = 65_536


def running_sum(df: DataFrame, group_cols: Sequence[str], day_col: str, id_col: str,
                value_col: str, out_col: str, block: int = BLOCK) -> DataFrame:
    """Add ``out_col`` = SUM(value) OVER (PARTITION BY group ORDER BY day, id
    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) for unique ``id_col``.

    NULL group keys form a group of their own, as in SQL windows: the keys
    travel as one struct, and equality on structs treats NULL fields as equal.
    """
    start = Window.unboundedPreceding
    keyed = df.withColumn("__g", F.struct(*group_cols)).withColumn("__d", F.col(day_col)) \
              .withColumn("__b", F.floor(F.col(id_col) / block).cast("long"))
    inside = Window.partitionBy("__g", "__d", "__b").orderBy(id_col).rowsBetween(start, 0)
    rows = keyed.withColumn("__in", F.sum(value_col).over(inside))
    blocks = keyed.groupBy("__g", "__d", "__b").agg(F.sum(value_col).alias("__t"))
    days = blocks.groupBy("__g", "__d").agg(F.sum("__t").alias("__t"))
    before_day = Window.partitionBy("__g").orderBy("__d").rowsBetween(start, -1)
    before_block = Window.partitionBy("__g", "__d").orderBy("__b").rowsBetween(start, -1)
    day_offsets = days.select("__g", "__d", F.sum("__t").over(before_day).alias("__day"))
    offsets = (blocks.select("__g", "__d", "__b", F.sum("__t").over(before_block).alias("__block"))
               .join(day_offsets, ["__g", "__d"]))
    zero = F.lit(0)
    joined = rows.join(offsets, ["__g", "__d", "__b"])
    return joined.select(*df.columns, (F.coalesce("__day", zero) + F.coalesce("__block", zero) + F.col("__in")).alias(out_col))
