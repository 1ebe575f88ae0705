"""Continuous order ingest and streaming roll-ups.

All sinks are files below the shared folder and idempotent per batch: a batch
that is run again after a failure overwrites its own output.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming.query import StreamingQuery

from salesweft.functions import dates, numbers
from salesweft.operators import ingest
from salesweft.session import new_work_dir, written


def file_stream(
    spark: SparkSession, folder: str, schema: T.StructType, fmt: str = "parquet",
    name_filter: str | None = None, files_per_batch: int | None = None,
) -> DataFrame:
    """New files of a folder as a stream; the schema is given, not inferred."""
    reader = spark.readStream.format(fmt).schema(schema)
    if name_filter:
        reader = reader.option("pathGlobFilter", name_filter)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(folder)


def _run(
    stream: DataFrame, write_batch: Callable[[DataFrame, int], None], checkpoint: str,
    mode: str = "append", continuous: str | None = None,
) -> StreamingQuery:
    """Start a query; without an interval it drains what is there and stops."""
    writer = stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).foreachBatch(write_batch)
    writer = writer.trigger(processingTime=continuous) if continuous else writer.trigger(availableNow=True)
    return writer.start()


def _drain(query: StreamingQuery) -> None:
    query.awaitTermination()
    if query.exception():
        raise query.exception()


def validated_ingest(
    orders: DataFrame, out: str, checkpoint: str, fmt: str = "parquet", continuous: str | None = None
) -> StreamingQuery:
    """Defaults, validation, then valid and rejected records to two sinks."""
    checked = ingest.validate(orders)

    def write(batch: DataFrame, batch_id: int) -> None:
        # One pass: the reject flag is the partition folder.
        flagged = batch.withColumn(
            "outcome", F.when(F.col("reject_reason").isNull(), "valid").otherwise("rejected")
        )
        flagged.write.mode("overwrite").partitionBy("outcome").format(fmt).save(f"{out}/batch={batch_id:010d}")

    return _run(checked, write, checkpoint, continuous=continuous)


def ingest_now(orders: DataFrame) -> DataFrame:
    """Drain the stream through :func:`validated_ingest`; all records with outcome."""
    spark = orders.sparkSession
    out = new_work_dir(spark, "ingest")
    _drain(validated_ingest(orders, out, new_work_dir(spark, "ingest-state")))
    return spark.read.parquet(out).drop("batch")


def latest_snapshot(spark: SparkSession, out: str) -> DataFrame:
    """The newest result that :func:`running` has written."""
    snapshots = spark.read.parquet(out)
    newest = snapshots.agg(F.max("_batch").alias("b")).scalar()
    return snapshots.where(F.col("_batch") == newest).drop("_batch", "_slot")


def _snapshot_writer(out: str) -> Callable[[DataFrame, int], None]:
    """Each batch replaces the older of two snapshots, so the newest can be read meanwhile."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.withColumn("_batch", F.lit(batch_id).cast("long")).write.mode("overwrite").parquet(f"{out}/_slot={batch_id % 2}")

    return write


def _batch_writer(out: str) -> Callable[[DataFrame, int], None]:
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/batch={batch_id:010d}")

    return write


def running(aggregated: DataFrame, out: str, checkpoint: str, continuous: str | None = None) -> StreamingQuery:
    """Keep the whole result of an aggregation in two alternating snapshots below ``out``.

    For results of bounded size, as counts per source are.
    """
    return _run(aggregated, _snapshot_writer(out), checkpoint, mode="complete", continuous=continuous)


def _complete_now(aggregated: DataFrame, purpose: str) -> DataFrame:
    spark = aggregated.sparkSession
    out = new_work_dir(spark, purpose)
    _drain(running(aggregated, out, new_work_dir(spark, f"{purpose}-state")))
    return latest_snapshot(spark, out)


def late_rows(query: StreamingQuery) -> int:
    """Rows that came behind the watermark, over the progress Spark still holds."""
    return sum(op.numRowsDroppedByWatermark for p in query.recentProgress for op in p.stateOperators)


def source_counts(orders: DataFrame, out: str, checkpoint: str, continuous: str | None = None) -> StreamingQuery:
    """Running total, valid and invalid records per source; state is one row per source."""
    return running(ingest.source_counts(ingest.validate(orders)), out, checkpoint, continuous)


def source_counts_now(orders: DataFrame) -> DataFrame:
    """Drained :func:`source_counts`."""
    return _complete_now(ingest.source_counts(ingest.validate(orders)), "source-counts")


def dated(orders: DataFrame, date_column: str, event_time: str) -> tuple[DataFrame, DataFrame]:
    """Rows with a readable date, with their event time, and the rest with a reason."""
    timed = orders.withColumn(event_time, F.col(date_column).try_cast("timestamp"))
    unread = timed.where(F.col(event_time).isNull()).drop(event_time)
    return timed.where(F.col(event_time).isNotNull()), unread.withColumn("reject_reason", F.lit(f"Unreadable {date_column}"))


def first_sightings(orders: DataFrame, key: str, event_time: str, delay: str) -> DataFrame:
    """Drop repeats of a key that arrive within the delay; state stays bounded."""
    return orders.withWatermark(event_time, delay).dropDuplicatesWithinWatermark([key])


def sightings(
    orders: DataFrame, key: str, event_time: str, delay: str, out: str, checkpoint: str, continuous: str | None = None
) -> StreamingQuery:
    """:func:`first_sightings` into one folder per batch; keys leave the state behind the watermark."""
    return _run(first_sightings(orders, key, event_time, delay), _batch_writer(out), checkpoint, continuous=continuous)


def rejected(orders: DataFrame, out: str, checkpoint: str, continuous: str | None = None) -> StreamingQuery:
    """Rejected rows, with their reason, into one folder per batch."""
    return _run(orders, _batch_writer(out), checkpoint, continuous=continuous)


def rejected_now(orders: DataFrame) -> DataFrame:
    """Drained :func:`rejected`."""
    spark = orders.sparkSession
    out = new_work_dir(spark, "rejected")
    _drain(rejected(orders, out, new_work_dir(spark, "rejected-state")))
    return spark.read.parquet(out).drop("batch")


def first_sightings_now(orders: DataFrame, key: str, event_time: str, delay: str) -> DataFrame:
    """Drained :func:`first_sightings`."""
    spark = orders.sparkSession
    out = new_work_dir(spark, "first-sightings")
    _drain(sightings(orders, key, event_time, delay, out, new_work_dir(spark, "first-sightings-state")))
    return spark.read.parquet(out).drop("batch")


def first_records(stream: DataFrame, key: str, order: list[str], out: str, checkpoint: str, parts: int = 64, continuous: str | None = None) -> StreamingQuery:
    """Keep the first record of every key, by the order columns, whenever its repeats arrive.

    The records so far are a snapshot split into parts by a digest of the key.
    A batch is first cut down to one record per key; the parts it touches are
    read, merged and written as those parts' versions of this batch, the others
    stay as they are.  A batch that is run again starts from the versions before
    it and overwrites its own, so the result does not depend on failures.
    Unlike a stream's own state, the snapshot has no time limit.
    """

    def first(records: DataFrame) -> DataFrame:
        place = F.struct(*[F.struct(F.col(c).isNull(), F.col(c)) for c in order], F.xxhash64(*records.columns))
        return records.groupBy(key).agg(F.min_by(F.struct(*records.columns), place).alias("r")).select("r.*")

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        new = written(first(batch).withColumn("part", F.pmod(F.xxhash64(key), F.lit(parts)).cast("int")), "first-records")
        touched = [r["part"] for r in new.select("part").distinct().collect()]
        before = current_records(spark, out, batch_id)
        if before is not None:
            new = new.unionByName(before.where(F.col("part").isin(touched)))
        merged = first(new).withColumn("batch", F.lit(batch_id).cast("long"))
        merged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("part", "batch").parquet(out)

    return _run(stream, write, checkpoint, continuous=continuous)


def current_records(spark: SparkSession, out: str, before: int | None = None) -> DataFrame | None:
    """The snapshot of :func:`first_records`, with its part; None when there is none.

    Of every part the newest version counts (of those before a batch).
    """
    at = spark._jvm.org.apache.hadoop.fs.Path(out)
    if not at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at):
        return None
    versions = spark.read.parquet(out).withColumn("batch", F.col("batch").cast("long"))
    if before is not None:
        versions = versions.where(F.col("batch") < before)
    newest = versions.groupBy("part").agg(F.max("batch").alias("batch"))
    return versions.join(F.broadcast(newest), ["part", "batch"]).drop("batch")


def first_records_now(stream: DataFrame, key: str, order: list[str]) -> DataFrame:
    """Drained :func:`first_records`."""
    spark = stream.sparkSession
    out = new_work_dir(spark, "first-records")
    _drain(first_records(stream, key, order, out, new_work_dir(spark, "first-records-state")))
    return current_records(spark, out).drop("part")


def daily_rollup(stream: DataFrame, event_time: str, amount: str, delay: str = "1 day") -> DataFrame:
    """Count and amount per day, kept up to date behind a watermark."""
    return (
        stream.withWatermark(event_time, delay).groupBy(F.window(event_time, "1 day").alias("w"))
        .agg(F.count("*").alias("orders"), numbers.money_sum(F.col(amount)).alias("revenue"))
        .select(dates.day_text(F.col("w.start")).alias("date"), "orders", "revenue")
    )


def daily_totals(
    stream: DataFrame, event_time: str, amount: str, out: str, checkpoint: str, delay: str = "1 day", continuous: str | None = None
) -> StreamingQuery:
    """:func:`daily_rollup` day by day as days close behind the watermark; state is the open days."""
    return _run(daily_rollup(stream, event_time, amount, delay), _batch_writer(out), checkpoint, continuous=continuous)


def daily_rollup_now(stream: DataFrame, event_time: str, amount: str) -> DataFrame:
    """Drained :func:`daily_rollup` with every day, open ones included."""
    return _complete_now(daily_rollup(stream, event_time, amount), "daily-rollup")
