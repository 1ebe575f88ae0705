"""Order and basket files, cleaned-table and report sinks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from salesweft.sources import schemas

# Quotes inside quoted text are doubled.
CSV = {"header": "true", "escape": '"'}
# For text that is written and read again at scale; Spark reads it by its ending.
PACKED = {"compression": "snappy"}
FORMATS = {".json": "json", ".csv": "csv", ".parquet": "parquet"}


def format_of(path: str) -> str:
    """File format by extension; others are rejected."""
    for suffix, name in FORMATS.items():
        if path.rstrip("/").endswith(suffix):
            return name
    raise ValueError(f"Unsupported file format: {path}")


def read_order_text(
    spark: SparkSession, path: str, fmt: str | None = None, json_array: bool = False
) -> DataFrame:
    """Orders as raw text columns (Parquet keeps its own types).

    Line-delimited JSON, the form :func:`write_raw_orders` produces, is the
    default.  JSON written as one array per file (``json_array=True``) needs
    the multi-line reader, which reads a file in one task.
    """
    fmt = fmt or format_of(path)
    schema = schemas.text_schema(schemas.ORDER)
    if fmt == "parquet":
        return spark.read.parquet(path)
    if fmt == "json":
        return spark.read.schema(schema).option("multiLine", json_array).json(path)
    # CSV columns are matched by header, so the header row decides the order.
    return spark.read.options(**CSV).csv(path)


def type_orders(df: DataFrame) -> DataFrame:
    """Declared columns get their declared type; unreadable values are null."""
    casts: dict[str, Column] = {}
    for f in schemas.ORDER.fields:
        if f.name in df.columns and df.schema[f.name].dataType != f.dataType:
            casts[f.name] = F.col(f.name).try_cast(f.dataType)
    return df.withColumns(casts) if casts else df


def read_orders(spark: SparkSession, path: str, fmt: str | None = None, json_array: bool = False) -> DataFrame:
    """Typed orders from JSON, CSV or Parquet."""
    return type_orders(read_order_text(spark, path, fmt, json_array))


def with_input_position(df: DataFrame, name: str = "input_position") -> DataFrame:
    """Add the place of each row in the input files.

    A split is read in order by one task, so within (file, split start) the
    generated id rises with the row.  No global sort or row number is needed.
    Only for frames read straight from files.
    """
    return df.withColumn(
        name,
        F.struct(
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("split"),
            F.monotonically_increasing_id().alias("row"),
        ),
    )


def read_cleaned_tree(spark: SparkSession, folder: str) -> DataFrame:
    """Every Parquet file below a folder."""
    return (
        spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet").parquet(folder)
    )


def write_cleaned_orders(df: DataFrame, path: str, mode: str = "append") -> None:
    """Cleaned orders as Parquet by order year."""
    (
        df.withColumn("order_year", F.year("Order_Date"))
        .write.mode(mode).partitionBy("order_year").parquet(path)
    )


def write_raw_orders(df: DataFrame, path: str, mode: str = "append", **options: str) -> None:
    """Raw orders as line-delimited JSON, for example with ``PACKED``; null fields are left out."""
    df.write.mode(mode).options(**options).option("ignoreNullFields", True).json(path)


def write_report(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """A roll-up or report as JSON."""
    df.write.mode(mode).option("ignoreNullFields", False).json(path)


def read_baskets(spark: SparkSession, path: str, fmt: str | None = None, json_array: bool = False) -> DataFrame:
    """Transactions with an item list; empty baskets are dropped.

    JSON holds ``Items`` as an array, CSV as one comma-separated text.
    """
    fmt = fmt or format_of(path)
    if fmt == "json":
        raw = (
            spark.read.schema(schemas.text_schema(schemas.TRANSACTION_BASKET))
            .option("multiLine", json_array).json(path)
        )
        items = F.col("Items")
    elif fmt == "csv":
        raw = spark.read.options(**CSV).csv(path)
        items = split_items(F.col("Items"))
    else:
        raw = spark.read.parquet(path)
        items = F.col("Items")
    return drop_empty_baskets(raw.withColumn("Items", items))


def split_items(text: Column) -> Column:
    """Comma-separated text to an item list."""
    return F.split(text, ",")


def drop_empty_baskets(baskets: DataFrame, column: str = "Items") -> DataFrame:
    """Keep baskets that hold at least one item."""
    return baskets.where(F.size(column) > 0)


def type_numbers(df: DataFrame) -> DataFrame:
    """Only the number fields typed; dates stay as they came."""
    casts: dict[str, Column] = {}
    for name in schemas.QUALITY_BOUNDS:
        if name in df.columns:
            number = F.col(name).try_cast("double")
            whole = isinstance(schemas.ORDER[name].dataType, T.LongType)
            casts[name] = number.try_cast("long") if whole else number
    return df.withColumns(casts) if casts else df


def fill_defaults(df: DataFrame) -> DataFrame:
    """Ingest defaults for absent fields: Quantity 1, money 0.0, texts ''."""
    # The defaults.
    defaults = {
        "Quantity": 1, "Unit_Price": 0.0, "Discount": 0.0, "Total_Amount": 0.0,
        "Region": "", "Season": "", "Category": "", "Product_Code": "",
    }
    return df.withColumns({
        name: F.coalesce(F.col(name), F.lit(value).cast(df.schema[name].dataType))
        for name, value in defaults.items()
        if name in df.columns
    })
