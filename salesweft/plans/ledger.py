"""Repeated ingest of deliveries with a ledger of what was taken.

A delivery is a source and a path, a file or a folder.  A run lists the files
of all deliveries, leaves out those the ledger holds with the same length and
time of change, reads the rest with one scan per format, however many
deliveries there are, and writes their validated records into one folder per
file.  The ledger entry comes last: it is the commit.  A run that failed before
it is repeated whole and overwrites the same folders; a file that changed since
replaces its own earlier records and no others.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from salesweft.operators import ingest
from salesweft.session import written
from salesweft.sources import order_files, schemas

ENTRY = "file string, length long, modified long, source string, format string, run int"
REFUSED = "source string, path string, reason string"


@dataclass(frozen=True)
class LedgerRun:
    run: int
    taken: DataFrame  # ledger entries of this run
    refused: DataFrame  # deliveries of which nothing is read


def _files(spark: SparkSession, path: str) -> list[tuple[str, int, int]] | None:
    """(path, length, time of change) of the data files at a path; None when there is nothing."""
    jvm = spark._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    fs = at.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(at):
        return None
    found, listed = [], fs.listFiles(at, True)
    while listed.hasNext():
        status = listed.next()
        if not status.getPath().getName().startswith(("_", ".")):
            found.append((status.getPath().toString(), status.getLen(), status.getModificationTime()))
    return found


def ledger(spark: SparkSession, out: str) -> DataFrame:
    """All entries; the newest of a file is the one in force."""
    kept = _files(spark, f"{out}/ledger")
    if not kept:
        return spark.createDataFrame([], ENTRY)
    return spark.read.schema(ENTRY).option("recursiveFileLookup", True).parquet(f"{out}/ledger")


def records(spark: SparkSession, out: str) -> DataFrame:
    """All validated records with their file's folder and the reason of rejected ones; only files of the ledger count."""
    names = ledger(spark, out).select(folder_of("file").alias("delivery")).distinct()
    return spark.read.parquet(f"{out}/records").join(names, "delivery", "left_semi")


def folder_of(file):
    """Name of the folder with a file's records."""
    return F.md5(F.col(file).cast("binary"))


def _read(spark: SparkSession, fmt: str, entries: list[tuple], json_array: bool) -> DataFrame:
    """The files of one format as one scan, with file and source; the list of files goes to the rows, not they to it."""
    raw = order_files.read_order_text(spark, [e[0] for e in entries], fmt, json_array)
    named = raw.withColumn("_path", F.regexp_replace(F.col("_metadata.file_path"), "^file:/+", "file:/"))
    sources = spark.createDataFrame([(f"{e[0]}", e[3]) for e in entries], "_file string, _source string")
    # File names come back as URIs, with blanks and the like encoded.
    known = sources.withColumn("_path", F.regexp_replace("_file", "^file:/+", "file:/"))
    decoded = named.withColumn("_path", F.expr("url_decode(replace(_path, '+', '%2B'))"))
    return decoded.join(F.broadcast(known), "_path").drop("_path").withColumn("Source", F.col("_source")).drop("_source")


def take(spark: SparkSession, deliveries: list[tuple[str, str]], out: str, fmt: str | None = None, json_array: bool = False) -> LedgerRun:
    """Ingest what is new among the deliveries into ``out``."""
    known = {(r["file"], r["length"], r["modified"]) for r in ledger(spark, out).collect()}
    last = ledger(spark, out).agg(F.max("run")).first()[0]
    run = 0 if last is None else last + 1
    fresh: dict[str, tuple] = {}
    refused = []
    for source, path in deliveries:
        found = _files(spark, path)
        if found is None:
            refused.append((source, path, "Missing file"))
            continue
        if source not in schemas.SOURCES:
            refused.append((source, path, f"Unknown source type: {source}"))
        for file, length, modified in found:
            if (file, length, modified) not in known:
                fresh[file] = (file, length, modified, source, fmt or order_files.format_of(file), run)
    entries = sorted(fresh.values())
    if entries:
        formats = sorted({e[4] for e in entries})
        frames = [_read(spark, f, [e for e in entries if e[4] == f], json_array) for f in formats]
        checked = ingest.validate(reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames))
        (
            checked.withColumn("delivery", folder_of("_file")).drop("_file")
            .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("delivery").parquet(f"{out}/records")
        )
    taken = written(spark.createDataFrame(entries, ENTRY), "ledger-run")
    if entries:
        taken.coalesce(1).write.mode("overwrite").parquet(f"{out}/ledger/run={run:08d}")
    return LedgerRun(run, taken, written(spark.createDataFrame(refused, REFUSED), "ledger-refused"))
