"""Typed table reads: parquet tables and CSV files with explicit schemas."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .byte_ranges import quoted_records

_S, _TS, _D = T.StringType(), T.TimestampNTZType(), T.DoubleType()


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields])


# Column names of the three funnel base tables.
CONTACTS = _struct(
    ("id_guest_anon", _S), ("id_host_anon", _S), ("id_listing_anon", _S),
    ("ts_interaction_first", _TS), ("ts_reply_at_first", _TS), ("ts_accepted_at_first", _TS),
    ("ts_booking_at", _TS), ("ds_checkin_first", _TS), ("ds_checkout_first", _TS),
    ("m_guests", _D), ("m_interactions", _D), ("m_first_message_length_in_characters", _D),
    ("contact_channel_first", _S), ("guest_user_stage_first", _S),
)
LISTINGS = _struct(
    ("id_listing_anon", _S), ("room_type", _S), ("listing_neighborhood", _S), ("total_reviews", _D),
)
USERS = _struct(("id_user_anon", _S), ("country", _S), ("words_in_user_profile", _D))
REVIEWS = _struct(("review", _S), ("sentiment", _S))


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


CSV_OPTIONS = {"mode": "FAILFAST", "escape": '"', "timestampNTZFormat": "yyyy-MM-dd HH:mm:ss[.SSSSSS]"}


def ddl(schema: T.StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)


# The text of a timestamp by the format above.
TIMESTAMP_TEXT = r"^[0-9]{4}-[0-9]{2}-[0-9]{2} [0-9]{2}:[0-9]{2}:[0-9]{2}(\.[0-9]{6})?$"


def parse_records(records: DataFrame, schema: T.StructType) -> DataFrame:
    """Typed rows of quoted records (first, value): a file's first record is its header, blank ones
    are left out. No inference; a bad row stops the job. Timestamps are read as text and cast, which
    is faster than a format; rows with any other text in them are parsed by the format."""
    rows = records.where((~F.col("first")) & (F.col("value") != ""))
    by_format = F.from_csv("value", ddl(schema), CSV_OPTIONS)
    times = [f.name for f in schema.fields if f.dataType == _TS]
    if not times:
        return rows.select(by_format.alias("row")).select("row.*")
    as_text = T.StructType([T.StructField(f.name, _S if f.name in times else f.dataType) for f in schema.fields])
    texts = rows.select("value", F.from_csv("value", ddl(as_text), CSV_OPTIONS).alias("row"))
    cast = [F.when(F.col("row")[n].rlike(TIMESTAMP_TEXT), F.col("row")[n].try_cast(_TS)).alias(n) for n in times]
    parsed = texts.select("value", "row", F.struct(*cast).alias("times"))
    known = reduce(lambda a, b: a & b, [F.col("row")[n].isNull() | F.col("times")[n].isNotNull() for n in times])
    fields = [F.col("times" if f.name in times else "row")[f.name].alias(f.name) for f in schema.fields]
    return parsed.select(F.when(known, F.struct(*fields)).otherwise(by_format).alias("row")).select("row.*")


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """CSV with a header, a declared schema and quoted values that may hold line feeds.

    A file is read in as many tasks as it has splits, and gives the same rows in one or in many.
    Quotes stand around whole values, and are doubled inside them.
    """
    return parse_records(quoted_records(spark, path, header=",".join(schema.names)), schema)


def read_csv_lines(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """As read_csv for files whose values hold no line breaks: one scan, by Spark's own reader."""
    return spark.read.schema(schema).option("header", True).options(**CSV_OPTIONS).csv(path)


def register_views(tables: dict[str, DataFrame]) -> None:
    """(Re)place named views; replaces the drop-then-create pair."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)
