"""Ingest of source files as they arrive: the batch transformations on a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terrafold.operators import ingest as I


def read_stream(spark: SparkSession, path: str, columns: dict[str, str], header: list[str], encoding: str = "utf-8", files_per_batch: int = 8) -> DataFrame:
    """New delimited files of a folder, mapped as in batch."""
    schema = T.StructType([T.StructField(n, T.StringType()) for n in header])
    raw = spark.readStream.schema(schema).option("header", True).option("encoding", encoding).option("escape", '"').option("maxFilesPerTrigger", files_per_batch).csv(path)
    return raw.select(*[F.coalesce(F.col(f"`{theirs}`"), F.lit("")).alias(ours) for ours, theirs in columns.items()])


def places_stream(raw: DataFrame, codes: DataFrame, bad: DataFrame | None = None, grid: bool = False) -> DataFrame:
    """Kept rows as places; stateless, so ids and duplicates are left to the batch reduction."""
    return I.places(I.judged(I.stripped(I.located(raw, grid)), codes, bad))


def write_stream(places: DataFrame, path: str, checkpoint: str):
    """Appends places by source and county; exactly once, by the checkpoint."""
    return places.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).partitionBy("source", "county").outputMode("append").trigger(availableNow=True).start()


def windowed_rejects(rows: DataFrame, time: str = "arrived", width: str = "10 minutes", late: str = "30 minutes") -> DataFrame:
    """Rejected rows by reason and window of arrival, with a bound on lateness."""
    return rows.where("reject_reason is not null").withWatermark(time, late).groupBy(F.window(time, width), "reject_reason").agg(F.count("*").alias("rows"))
