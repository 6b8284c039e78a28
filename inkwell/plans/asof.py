"""As-of lookups ("latest value strictly before this row") without putting a
whole key in one task.

A plain ``last(value) over (partition by key order by ts)`` sends each key to
a single task; one session holding a third of all rows would be ranked by
one task.  Here the key's timeline is cut into ``ts`` buckets:

1. inside (key, bucket): a running ``last(value, ignorenulls)``;
2. per (key, bucket): the last value of the bucket (an aggregation);
3. per key, over the bucket summaries only: the last value of earlier buckets;
4. each row takes (1), or (3) when its bucket has nothing earlier.

Groups in step 1 hold at most one bucket of rows; step 3 sees one row per
bucket, far fewer than the rows themselves.  The bucket width is taken from
the range and the number of the timestamps unless it is given.  Null keys are
a key like any other, and rows without a timestamp come before all others of
their key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Rows a bucket holds on average when its width is taken from the data.
BUCKET_ROWS = 10_000


def last_value_before(df: DataFrame, keys: list[str], ts: str, seq: str, value: str,
                      out: str, bucket_width: int | None = None) -> DataFrame:
    """Add ``out``: the last non-null ``value`` of an earlier row of the same
    keys, in (ts, seq) order."""
    if bucket_width is None:
        low, high, n = df.agg(F.min(ts), F.max(ts), F.count(ts)).first()
        bucket_width = max(1, (high - low) * BUCKET_ROWS // n) if n else 1
    d = df.withColumn("_b", F.floor(F.col(ts) / F.lit(bucket_width)))
    inside = (Window.partitionBy(*keys, "_b").orderBy(ts, seq)
              .rowsBetween(Window.unboundedPreceding, -1))
    d = d.withColumn("_local", F.last(value, ignorenulls=True).over(inside))
    summary = d.groupBy(*keys, "_b").agg(
        F.max(F.when(F.col(value).isNotNull(), F.struct(ts, seq, value))).alias("_last"))
    earlier = (Window.partitionBy(*keys).orderBy("_b")
               .rowsBetween(Window.unboundedPreceding, -1))
    summary = summary.select(*keys, "_b", F.last(F.col("_last")[value], ignorenulls=True)
                             .over(earlier).alias("_carry"))
    names = [*keys, "_b"]
    summary = summary.withColumnsRenamed({k: f"_s_{k}" for k in names})
    same = [F.col(k).eqNullSafe(F.col(f"_s_{k}")) for k in names]
    return (d.join(summary, same)
            .withColumn(out, F.coalesce("_local", "_carry"))
            .drop("_b", "_local", "_carry", *[f"_s_{k}" for k in names]))
