"""Fixed schemas: landing (what writers append) and bronze (after the casts)."""

from __future__ import annotations

from pyspark.sql import types as T

# Bronze column types per entity, in reference column order.
BRONZE_TYPES: dict[str, list[tuple[str, str]]] = {
    "sales": [
        ("transaction_id", "int"), ("store_id", "int"), ("event_time", "timestamp"),
        ("customer_id", "int"), ("product_id", "int"), ("quantity", "int"),
        ("unit_price", "double"), ("total_amount", "double"), ("payment_method", "string"),
        ("discount_applied", "double"), ("tax_amount", "double"),
    ],
    "customers": [
        ("customer_id", "int"), ("name", "string"), ("email", "string"), ("address", "string"),
        ("join_date", "timestamp"), ("loyalty_points", "int"), ("phone_number", "string"),
        ("age", "int"), ("gender", "string"), ("last_update_time", "timestamp"),
    ],
    "products": [
        ("product_id", "int"), ("name", "string"), ("category", "string"), ("brand", "string"),
        ("price", "double"), ("stock_quantity", "int"), ("size", "string"), ("color", "string"),
        ("description", "string"), ("last_update_time", "timestamp"),
    ],
    "stores": [
        ("store_id", "int"), ("name", "string"), ("address", "string"), ("manager", "string"),
        ("open_date", "timestamp"), ("status", "string"), ("phone_number", "string"),
        ("last_update_time", "timestamp"),
    ],
}

_SIMPLE = {
    "int": T.IntegerType(), "bigint": T.LongType(), "double": T.DoubleType(),
    "string": T.StringType(), "timestamp": T.TimestampType(), "date": T.DateType(),
}


def struct(fields: list[tuple[str, str]]) -> T.StructType:
    return T.StructType([T.StructField(n, _SIMPLE[t], True) for n, t in fields])


# Landing schemas are explicit: a small batch whose only ``manager`` is NULL
# has no type to infer, so readers and writers never infer. Writers land whole
# numbers as BIGINT; files with INT are read just as well.
LANDING_SCHEMAS: dict[str, T.StructType] = {
    e: struct([(n, "bigint" if t == "int" else t) for n, t in f]) for e, f in BRONZE_TYPES.items()}

LINEAGE_COLS = ("ingest_timestamp", "source_file_path")


def bronze_columns(entity: str) -> list[str]:
    return [n for n, _ in BRONZE_TYPES[entity]]
