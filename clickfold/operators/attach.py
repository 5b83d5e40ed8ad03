"""Attach many keyed feature tables to one row table.

A one-pass aggregate over several key sets (GROUPING SETS) is written once,
one folder per set.  Each set is then a table of its own files, so its rows
are known when the joins are planned.  Tables that the session's own broadcast
threshold allows are joined one by one (the engine broadcasts them), as long
as all of them together stay within a few thresholds: the driver holds every
broadcast table of a query at the same time, unpacked.  All others meet the
rows in ONE narrow join: every row sends a short (table, key, row number) per
table, these meet all tables stacked into one, and what they find is gathered
by row number.  So the wide rows are shuffled once, not once per table, and
adaptive execution splits hot keys in the narrow join.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickfold.session import table_path, write_table


#: Broadcast tables of one query together, in broadcast thresholds.
BROADCAST_TOTAL = 4
# Bytes of a row in a hash table beside its values, and of a text value.
_ROW_BYTES, _TEXT_BYTES = 48, 32


@dataclass
class Keyed:
    """A table that is unique on ``keys``; ``rows``: how many it has."""
    df: DataFrame
    keys: list[str]
    rows: int | None = None

    @property
    def size(self) -> int | None:
        """Bytes as an unpacked hash table (files are several times smaller)."""
        if self.rows is None:
            return None
        return self.rows * (_ROW_BYTES + sum(_TEXT_BYTES if isinstance(f.dataType, T.StringType) else 8
                                             for f in self.df.schema.fields))


class SetTables:
    """The written sets of a GROUPING SETS aggregate, by grouping id."""

    def __init__(self, combined: DataFrame, gid_col: str = "_gid", name: str = "sets"):
        spark = combined.sparkSession
        self._spark, self._gid = spark, gid_col
        self._schema = T.StructType([f for f in combined.schema.fields if f.name != gid_col])
        self._path = table_path(spark, name)
        # Rows of a set together in few files; large sets are split adaptively.
        combined.hint("rebalance", gid_col).write.partitionBy(gid_col).parquet(self._path)
        written = spark.read.schema(combined.schema).parquet(self._path)
        self._rows = {r[0]: r[1] for r in written.groupBy(gid_col).count().collect()}

    def __getitem__(self, gid: int) -> DataFrame:
        if gid not in self._rows:
            return self._spark.createDataFrame([], self._schema)
        return self._spark.read.schema(self._schema).parquet(f"{self._path}/{self._gid}={gid}")

    def rows(self, gid: int) -> int:
        return self._rows.get(gid, 0)


def broadcast_threshold(spark) -> int:
    """The session's ``autoBroadcastJoinThreshold`` in bytes (-1: never)."""
    text = spark.conf.get("spark.sql.autoBroadcastJoinThreshold", "10485760").strip().lower()
    digits = text.rstrip("bkmgt")
    return int(digits) << {"k": 10, "m": 20, "g": 30, "t": 40}.get(text[len(digits):][:1], 0)


def attach_tables(rows: DataFrame, tables: list[Keyed], how: str = "left") -> DataFrame:
    """Left-join every table on its keys; NULL keys find nothing.

    Tables of unknown size are plain joins, and so are the smallest others
    while each is within the broadcast threshold and all together within
    ``BROADCAST_TOTAL`` thresholds; the rest is never broadcast, and two or
    more of them go through ``narrow_join``.
    """
    limit = broadcast_threshold(rows.sparkSession)
    large, total = [], 0
    for t in sorted((t for t in tables if t.size is not None), key=lambda t: t.size):
        total += t.size
        if t.size > limit or total > BROADCAST_TOTAL * limit:
            large.append(t)
    if how == "left" and len(large) > 1:
        large = [t for t in tables if t in large]
        rows = narrow_join(rows, large)
        tables = [t for t in tables if t not in large]
    for t in tables:
        rows = rows.join(t.df.hint("merge") if t in large else t.df, t.keys, how)
    return rows


def _key_text(number: int, df: DataFrame, keys: list[str]) -> Column:
    """A table's number and its key values as one text, each with its length,
    so that different keys never give the same text; NULL if one is NULL."""
    parts = [F.lit(f"{number}")]
    for k in keys:
        text = F.col(k).cast("string")
        parts += [F.lit(":"), F.length(text).cast("string"), F.lit(":"), text]
    return F.concat(*parts)


def narrow_join(rows: DataFrame, tables: list[Keyed], name: str = "rows") -> DataFrame:
    """Left-join all ``tables`` in one join of (table and key, row number).

    The rows are written once with a number, which stays whatever is lost.
    Values travel as doubles (counts and flags are exact up to 2**53) and get
    their types back.
    """
    columns = rows.columns
    numbered = write_table(rows.withColumn("_row", F.monotonically_increasing_id()), name=name)
    values = [[c for c in t.df.columns if c not in t.keys] for t in tables]
    stacked, wanted = None, []
    for i, (t, names) in enumerate(zip(tables, values)):
        one = t.df.select(_key_text(i, t.df, t.keys).alias("_key"), F.array(
            *[F.col(c).cast("double") for c in names]).alias("_values"))
        stacked = one if stacked is None else stacked.unionAll(one)
        wanted.append(F.struct(F.lit(i).alias("_set"), _key_text(i, numbered, t.keys).alias("_key")))
    probes = numbered.select("_row", F.inline(F.filter(F.array(*wanted), lambda p: p["_key"].isNotNull())))
    # The sides are large by construction: a sort-merge join, split where skewed.
    met = probes.hint("merge").join(stacked, "_key").select("_row", "_set", "_values")
    found, types = [], {f.name: f.dataType for t in tables for f in t.df.schema.fields}
    for i, names in enumerate(values):
        for j, c in enumerate(names):
            found.append(F.max(F.when(F.col("_set") == i, F.get("_values", F.lit(j)))).alias(c))
    gathered = met.repartition("_row").groupBy("_row").agg(*found)
    out = numbered.join(gathered.hint("merge"), "_row", "left")
    return out.select(*columns, *[F.col(c).cast(types[c]).alias(c) for names in values for c in names])


def grouping_id(cols: list[str], present) -> int:
    """Spark's ``grouping_id()``: bit i (from the left) is 1 when ``cols[i]``
    is aggregated away in the set."""
    gid = 0
    for c in cols:
        gid = (gid << 1) | (0 if c in present else 1)
    return gid
