"""Declared schemas with their constraints in ``StructField.metadata``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

# Allowed values and bounds of the declared schemas.
SOURCES = ["ERP", "POS", "ONLINE_EC", "APP", "MINI_PROGRAM"]
ENUMS = {
    "Source": SOURCES,
    "Season": ["Spring", "Summer", "Autumn", "Winter"],
    "Category": [
        "T-Shirt", "Shirt", "Pants", "Jacket", "Coat", "Dress", "Skirt",
        "Sweater", "Hoodie", "Innerwear", "Accessories", "Shoes", "Bags",
    ],
    "Size": ["XS", "S", "M", "L", "XL", "XXL", "Free"],
    "Age_Group": ["<18", "18-25", "26-35", "36-45", "46-55", ">55"],
    "Gender": ["Male", "Female", "Unknown"],
}
PAYMENT_METHODS = ["Cash", "Credit_Card", "Alipay", "WeChat_Pay", "Member_Card"]
PRICE_RANGES = ["Low", "Mid", "High"]
QUALITY_BOUNDS = {
    "Quantity": (1, 100),
    "Unit_Price": (0, 10000),
    "Discount": (0, 1000),
    "Total_Amount": (0, 100000),
}
REQUIRED_FIELDS = [
    "Order_ID", "Source", "Region", "Order_Date", "Season", "Category", "Product_Code",
]
DATE_FIELDS = ["Order_Date", "Last_Purchase_Date", "Transaction_Date"]
NUMERIC_FIELDS = [
    "Quantity", "Unit_Price", "Discount", "Total_Amount", "Sales_Volume", "Sales_Amount",
]

_SPARK_TYPES = {
    "string": T.StringType(),
    "time": T.StringType(),
    "date": T.DateType(),
    "integer": T.LongType(),
    "float": T.DoubleType(),
    "boolean": T.BooleanType(),
    "array": T.ArrayType(T.StringType()),
}


def _field(name, kind, required=False, enum=None, minimum=None, default=None) -> T.StructField:
    notes = {"declared": kind, "required": required}
    if enum is not None:
        notes["enum"] = list(enum)
    if minimum is not None:
        notes["min"] = minimum
    if default is not None:
        notes["default"] = str(default)
    return T.StructField(name, _SPARK_TYPES[kind], True, notes)


# Names, types and constraints of the declared schemas.
ORDER = T.StructType([
    _field("Order_ID", "string", True),
    _field("Source", "string", True, ENUMS["Source"]),
    _field("Region", "string", True),
    _field("Store_Code", "string"),
    _field("Order_Date", "date", True),
    _field("Order_Time", "time"),
    _field("Season", "string", True, ENUMS["Season"]),
    _field("Category", "string", True, ENUMS["Category"]),
    _field("Product_Code", "string", True),
    _field("Product_Name", "string"),
    _field("Color", "string"),
    _field("Size", "string", False, ENUMS["Size"]),
    _field("Quantity", "integer", True, minimum=1),
    _field("Unit_Price", "float", True, minimum=0),
    _field("Discount", "float", minimum=0, default=0),
    _field("Total_Amount", "float", True, minimum=0),
    _field("Payment_Method", "string", False, PAYMENT_METHODS),
    _field("Customer_ID", "string"),
    _field("Age_Group", "string", False, ENUMS["Age_Group"]),
    _field("Gender", "string", False, ENUMS["Gender"]),
])

USER_BEHAVIOR = T.StructType([
    _field("Customer_ID", "string", True),
    _field("Total_Orders", "integer", True, minimum=0),
    _field("Total_Spend", "float", True, minimum=0),
    _field("Avg_Order_Value", "float", True, minimum=0),
    _field("Purchase_Frequency", "float", True, minimum=0),
    _field("Favorite_Category", "string"),
    _field("Favorite_Season", "string"),
    _field("Preferred_Region", "string"),
    _field("Last_Purchase_Date", "date"),
    _field("Days_Since_Last_Purchase", "integer", True, minimum=0),
])

SALES_TIMESERIES = T.StructType([
    _field("Date", "date", True),
    _field("Category", "string", True),
    _field("Region", "string"),
    _field("Sales_Volume", "integer", True, minimum=0),
    _field("Sales_Amount", "float", True, minimum=0),
    _field("Promotion_Flag", "boolean", default=False),
])

TRANSACTION_BASKET = T.StructType([
    _field("Transaction_ID", "string", True),
    _field("Order_ID", "string", True),
    _field("Customer_ID", "string"),
    _field("Transaction_Date", "date", True),
    _field("Items", "array", True),
])

REGIONAL_SALES = T.StructType([
    _field("Region", "string", True),
    _field("Season", "string", True),
    _field("Category", "string", True),
    _field("Price_Range", "string", True, PRICE_RANGES),
    _field("Sales_Volume", "integer", True, minimum=0),
])

CATALOGUE = {
    "order": ORDER,
    "user_behavior": USER_BEHAVIOR,
    "sales_timeseries": SALES_TIMESERIES,
    "transaction_basket": TRANSACTION_BASKET,
    "regional_sales": REGIONAL_SALES,
}


def describe_schemas(spark: SparkSession) -> DataFrame:
    """The schema catalogue as rows."""
    rows = [
        (
            name, position, f.name, f.metadata["declared"], f.metadata["required"],
            ", ".join(f.metadata["enum"]) if "enum" in f.metadata else None,
            float(f.metadata["min"]) if "min" in f.metadata else None,
            f.metadata.get("default"),
        )
        for name, schema in CATALOGUE.items()
        for position, f in enumerate(schema.fields)
    ]
    return spark.createDataFrame(
        rows,
        "schema string, position int, field string, type string, required boolean, "
        "allowed string, minimum double, default_value string",
    )


def text_schema(schema: T.StructType) -> T.StructType:
    """The same columns as raw text (arrays stay arrays), for tolerant reads."""
    return T.StructType([
        T.StructField(
            f.name, f.dataType if isinstance(f.dataType, T.ArrayType) else T.StringType(), True, f.metadata
        )
        for f in schema.fields
    ])


def constraint_checks(schema: T.StructType, columns: list[str]) -> dict[str, Column]:
    """Violation predicate per declared constraint, from the field metadata."""
    checks: dict[str, Column] = {}
    for f in schema.fields:
        if f.name not in columns:
            continue
        value, notes = F.col(f.name), f.metadata
        if notes.get("required"):
            checks[f"{f.name}:required"] = value.isNull()
        if "enum" in notes:
            checks[f"{f.name}:enum"] = value.isNotNull() & ~value.isin(list(notes["enum"]))
        if "min" in notes:
            checks[f"{f.name}:min"] = F.coalesce(value < notes["min"], F.lit(False))
    return checks
