"""Ingest, clean and roll up order files; one write per result."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from salesweft.operators import ingest, quality, rollups
from salesweft.session import written
from salesweft.sources import order_files, schemas


@dataclass(frozen=True)
class IngestResult:
    valid_path: str
    rejected_path: str
    stats: DataFrame
    refused: DataFrame  # deliveries of which nothing was read: source, path, reason


def ingest_files(
    spark: SparkSession, deliveries: list[tuple[str, str]], out: str, fmt: str | None = None, json_array: bool = False
) -> IngestResult:
    """Read each ``(source, path)``, tag, validate, write valid and rejected.

    Records of an unknown source are read and rejected with that reason.
    Unknown sources and missing files are listed in ``refused``.  A repeated
    run into the same folder replaces the earlier one's result.  The results
    are compressed: as plain text they would be larger than all else that is
    written and moved.
    """
    frames, refused = [], []
    for source, path in deliveries:
        try:
            frames.append(ingest.tag_source(order_files.read_order_text(spark, path, fmt, json_array), source))
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            refused.append((source, path, "Missing file"))
            continue
        if source not in schemas.SOURCES:
            refused.append((source, path, f"Unknown source type: {source}"))
    if not frames:
        frames = [spark.createDataFrame([], schemas.ORDER)]
    checked = written(ingest.validate(ingest.union_sources(frames)), "ingest-checked")
    listed = written(spark.createDataFrame(refused, "source string, path string, reason string"), "ingest-refused")
    valid, rejected = f"{out}/valid", f"{out}/rejected"
    order_files.write_raw_orders(ingest.valid_records(checked), valid, mode="overwrite", **order_files.PACKED)
    order_files.write_raw_orders(ingest.rejected_records(checked), rejected, mode="overwrite", **order_files.PACKED)
    return IngestResult(valid, rejected, ingest.ingest_stats(checked), listed)


def clean_files(spark: SparkSession, path: str, out: str, fmt: str | None = None, json_array: bool = False) -> DataFrame:
    """Clean an order file into a Parquet table; returns the quality report."""
    raw = order_files.with_input_position(order_files.read_order_text(spark, path, fmt, json_array))
    order_files.write_cleaned_orders(quality.clean_orders(raw), f"{out}/orders", mode="overwrite")
    report = quality.quality_report(raw)
    order_files.write_report(report, f"{out}/quality_report")
    return report


def roll_up_files(spark: SparkSession, cleaned: str, out: str) -> DataFrame:
    """All six roll-ups of a cleaned table; returns the group counts."""
    orders = order_files.read_cleaned_tree(spark, cleaned)
    rolled = written(rollups.rollup_all(orders), "rollups")
    rolled.write.mode("overwrite").partitionBy("dimension").json(out)
    return rollups.rollup_group_counts(rolled)
