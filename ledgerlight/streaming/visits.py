"""Field visits as a stream.

Visits land as files. A visit may arrive late, more than once, and changed. Two
ways to count them by day: ``daily_counts`` closes a day after seven days and
keeps state for no longer; ``store_visits`` keeps the visits and the counts of
all days in one table, where every batch corrects the days it touches.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.measures import local_day
from ..schemas import LOCAL_ZONE, VISITS
from ..sinks.tables import drop_old_versions, read_day_counts, upsert_days

# --- fixed value: the reprocessed window of the batch loads, in days -----------
LATENESS = "7 days"


def read_visit_stream(spark: SparkSession, path: str, fmt: str = "json", files_per_batch: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(VISITS).format(fmt)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(path)


def first_arrivals(visits: DataFrame) -> DataFrame:
    """Each visit once. Needs only the ids of the last seven days."""
    local = visits.withColumn("hora_local", F.from_utc_timestamp("timestamp", LOCAL_ZONE))
    return local.withWatermark("hora_local", LATENESS).dropDuplicatesWithinWatermark(["id"])


def daily_counts(visits: DataFrame) -> DataFrame:
    """Visits per local day and seller; a day is emitted once no late visit can change it."""
    return (
        first_arrivals(visits)
        .groupBy(F.window("hora_local", "1 day").alias("dia_janela"), "cod_vendedor")
        .agg(F.count(F.lit(1)).alias("visitas"))
        .select(F.to_date("dia_janela.start").alias("dia"), "cod_vendedor", "visitas")
    )


def write_daily_counts(counts: DataFrame, path: str, checkpoint: str, once: bool = True) -> StreamingQuery:
    """Append closed days to Parquet, exactly once."""
    writer = counts.writeStream.outputMode("append").format("parquet").option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if once else writer.trigger(processingTime="1 minute")
    return writer.start(path)


def store_visits(visits: DataFrame, path: str, checkpoint: str, once: bool = True) -> StreamingQuery:
    """Keep the visit table, and the visits by day and seller, up to date from the stream.

    Visits are put in by id, wherever they were: one that comes again with another
    day or seller is taken off the old count and put on the new one. A batch that
    runs again after a failure changes nothing. Only the days that a batch touches
    are rewritten, and old files go, but for those of the last two states.
    """

    def merge(batch: DataFrame, _: int) -> None:
        visits = batch.withColumn("dia", local_day("timestamp"))
        upsert_days(visits, path, ["id"], "dia", order_by="timestamp", counted=["cod_vendedor"])
        drop_old_versions(batch.sparkSession, path)

    writer = visits.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if once else writer.trigger(processingTime="1 minute")
    return writer.start()


def visits_by_day(spark: SparkSession, path: str) -> DataFrame:
    """Visits of every day and seller, of the table that ``store_visits`` keeps."""
    return read_day_counts(spark, path).select("dia", "cod_vendedor", F.col("linhas").alias("visitas"))
