"""Score sink (S3): ``instance_id predicted_score``, space separated, header
row, carriage-return line ends."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Fixed values of the output layout.
SCORE_COLUMNS = ("instance_id", "predicted_score")
SEPARATOR = " "
LINE_END = "\r"


def write_scores(scores: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Write scores as a directory of part files (one per task; no single
    writer, no driver collect)."""
    (scores.select(*SCORE_COLUMNS).write.mode(mode)
     .option("sep", SEPARATOR).option("header", True).option("lineSep", LINE_END)
     .csv(path))


def read_scores(spark: SparkSession, path: str) -> DataFrame:
    return (spark.read.schema("instance_id long, predicted_score double")
            .option("sep", SEPARATOR).option("header", True).option("lineSep", LINE_END)
            .csv(path))
