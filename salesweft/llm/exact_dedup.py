"""Exact deduplication by a tree merge of sorted digest runs.

Every partition first reduces its rows to a run: one entry per digest, in
digest order, with the best row and the number of copies.  Rounds then merge
the runs of neighbouring partitions: in a round of fan-in 4 (two binomial
rounds at once) run ``r`` meets the runs ``4*(r//4) .. 4*(r//4)+3``.  A merge
keeps, for every digest, the best row of all merged runs, so a group that
holds a third of all rows is down to one entry per run before it moves, and
no round gathers a group.  The best row is a struct, which Spark aggregates
over sorted input (``SortAggregate``), i.e. by merging runs.

An entry is only merged with one of the same SHA-256, the same length and the
same independent 64-bit hash of the normalised text (the verification).

Defined cases: a null text is empty; empty texts are copies of each other; of
rows with equal text length the smallest id stays, a null id after all others;
of fully repeated rows one stays.  An empty table gives an empty result.
Other columns are neither read nor changed, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesweft.session import written

RUNS = 64
FAN_IN = 4
ROW = "__exact_dedup_row"


def digests(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", row: str | None = None) -> DataFrame:
    """One narrow row per document: id, length and verified digest of its normalised text."""
    text = F.coalesce(F.col(text_column), F.lit(""))
    normal = F.regexp_replace(text, r"[\x20\x09-\x0D]+", "")
    return docs.select(
        F.col(id_column).alias("id"),
        (F.col(row) if row else F.monotonically_increasing_id()).alias("row"),
        F.length(text).alias("chars"),
        F.unhex(F.sha2(normal, 256)).alias("digest"),
        F.xxhash64(normal).alias("check"),
        F.length(normal).alias("normal_chars"),
        F.pmod(F.spark_partition_id(), F.lit(RUNS)).alias("run"),
    )


def merged_runs(rows: DataFrame, runs: int = RUNS, fan_in: int = FAN_IN) -> DataFrame:
    """One row per digest with its best row and its number of copies, by rounds of run merges."""
    key = ["digest", "check", "normal_chars"]
    order = F.struct("chars", F.col("id").isNotNull().alias("known"), F.bitwise_not("id").alias("id"), F.bitwise_not("row").alias("row"))
    entries = rows.select("run", *key, order.alias("best"), F.lit(1).cast("long").alias("copies"))
    while True:
        runs = -(-runs // fan_in)
        last = runs <= 1
        entries = entries.withColumn("run", F.floor(F.col("run") / fan_in).cast("int"))
        entries = entries.groupBy(*([] if last else ["run"]), *key).agg(
            F.max("best").alias("best"), F.sum("copies").alias("copies")
        )
        if last:
            return entries.select(
                *key,
                F.bitwise_not("best.id").alias("keep_id"),
                F.bitwise_not("best.row").alias("keep_row"),
                F.col("copies").alias("group_size"),
            )


def decisions(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", row: str | None = None) -> DataFrame:
    """Per document: doc_id, keep_id, group_size, kept, text_sha256 and its row number."""
    rows = written(digests(docs, id_column, text_column, row), "exact-digests")
    groups = merged_runs(rows).where("group_size > 1")
    joined = rows.join(groups, ["digest", "check", "normal_chars"], "left")
    alone = F.col("group_size").isNull()
    return joined.select(
        F.col("id").alias("doc_id"),
        F.when(alone, F.col("id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        (alone | (F.col("row") == F.col("keep_row"))).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
        "row",
    )


def deduplicated(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The documents of which a copy stays, with all their columns."""
    numbered = written(docs.withColumn(ROW, F.monotonically_increasing_id()), "exact-rows")
    dropped = decisions(numbered, id_column, text_column, ROW).where(~F.col("kept")).select(F.col("row").alias(ROW))
    return numbered.join(dropped, ROW, "left_anti").select(*docs.columns)
