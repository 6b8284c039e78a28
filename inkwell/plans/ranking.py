"""Row numbers per group without putting a whole group in one task.

A window partitioned by the group key sends each group to one task; one
query whose results cover most documents would then be ranked by a single
task.  Instead the rows are range-partitioned on (group, order keys), so a
large group spans many partitions, numbered locally inside each partition,
and shifted by the row counts of the earlier partitions of the same group
(a small summary table: at most groups x partitions rows).

The locally numbered frame is checkpointed (shared checkpoint folder) so the
numbers and the summary come from the same materialised rows even if an
executor is lost and work is recomputed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_LOCAL_BITS = 33  # monotonically_increasing_id: partition id above bit 33


def distributed_row_number(df: DataFrame, group: str, order: list[Column],
                           name: str = "rank", dtype: str = "int") -> DataFrame:
    """``row_number() over (partition by group order by *order)`` as a
    distributed sort.  ``order`` must be a total order within a group;
    ``dtype`` is the type of the number."""
    s = (df.repartitionByRange(F.col(group), *order)
         .sortWithinPartitions(F.col(group), *order)
         .withColumn("_mid", F.monotonically_increasing_id())
         .checkpoint())
    s = s.withColumn("_pid", F.shiftright("_mid", _LOCAL_BITS)).withColumn(
        "_loc", F.col("_mid").bitwiseAND(F.lit((1 << _LOCAL_BITS) - 1)))
    summary = s.groupBy(group, "_pid").agg(F.min("_loc").alias("_first"),
                                          F.count("*").alias("_n"))
    before = Window.partitionBy(group).orderBy("_pid").rowsBetween(
        Window.unboundedPreceding, -1)
    summary = summary.withColumn(
        "_before", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    summary = summary.withColumnsRenamed({group: "_group", "_pid": "_part"})
    out = s.join(summary, F.col(group).eqNullSafe(F.col("_group")) & (F.col("_pid") == F.col("_part"))).withColumn(
        name, (F.col("_loc") - F.col("_first") + F.col("_before") + 1).cast(dtype))
    return out.drop("_mid", "_pid", "_loc", "_first", "_n", "_before", "_group", "_part")
