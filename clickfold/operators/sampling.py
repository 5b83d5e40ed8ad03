"""Label-balanced sampling (F5): keep every negative and the positives whose
id falls in a fixed subset of buckets.

The reference draws a random integer 1..6 per row and keeps 1-3 or
``is_trade == 0``.  Here the bucket is a hash of the id, so a rerun -- or a
recomputed partition after a lost executor -- keeps the same rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Number of buckets and the buckets kept for positives.
BUCKETS = 6
KEEP = (0, 1, 2)


def sample_bucket(id_col: str = "instance_id", buckets: int = BUCKETS) -> Column:
    """First 32 bits of md5(id text) as an integer, modulo ``buckets``."""
    h = F.conv(F.substring(F.md5(F.col(id_col).cast("string")), 1, 8), 16, 10).cast("long")
    return h % F.lit(buckets)


def balanced_sample(df: DataFrame, id_col: str = "instance_id", label: str = "is_trade",
                    buckets: int = BUCKETS, keep=KEEP) -> DataFrame:
    """Narrow filter (no shuffle): all negatives, positives in ``keep``."""
    b = sample_bucket(id_col, buckets)
    return df.where((F.col(label) == 0) | b.isin(*keep))
