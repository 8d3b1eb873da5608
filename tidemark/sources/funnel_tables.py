"""Contacts, listings and users derived from the order tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .tables import table


def _later(ts: Column, days=0, hours=0, minutes=0) -> Column:
    parts = [F.lit(p) if isinstance(p, int) else p.cast("int") for p in (days, hours, minutes)]
    return ts + F.make_dt_interval(*parts, F.lit(0).cast("decimal(18,6)"))


def contacts(spark: SparkSession, folder: str) -> DataFrame:
    lines = table(spark, folder, "lineitem")
    orders = table(spark, folder, "orders")
    rows = lines.join(orders, lines.l_orderkey == orders.o_orderkey).withColumn(
        "inter", _later(F.col("o_orderdate"), hours=F.col("l_orderkey") % 24)
    )
    inter, qty = F.col("inter"), F.col("l_quantity")
    checkin = F.when(
        F.col("l_linenumber") < 7, _later(inter, days=F.col("l_linenumber") - 2)
    )
    return rows.withColumn("checkin", checkin).select(
        F.concat(F.lit("C"), F.col("o_custkey").cast("string")).alias("id_guest_anon"),
        F.concat(F.lit("S"), F.col("l_suppkey").cast("string")).alias("id_host_anon"),
        F.col("l_partkey").cast("string").alias("id_listing_anon"),
        inter.alias("ts_interaction_first"),
        F.when(F.col("l_returnflag") != "R", _later(inter, minutes=qty * 10)).alias("ts_reply_at_first"),
        F.when(F.col("l_returnflag") == "A", _later(inter, minutes=qty * 30)).alias("ts_accepted_at_first"),
        F.when(
            (F.col("l_returnflag") == "A") & (F.col("l_linestatus") == "F"), _later(inter, hours=qty)
        ).alias("ts_booking_at"),
        F.col("checkin").alias("ds_checkin_first"),
        _later(F.col("checkin"), days=F.col("l_partkey") % 14 + 1).alias("ds_checkout_first"),
        F.col("l_linenumber").cast("double").alias("m_guests"),
        qty.alias("m_interactions"),
        (F.floor("l_extendedprice") % 1000).cast("double").alias("m_first_message_length_in_characters"),
        F.when(F.col("o_orderpriority") == "1-URGENT", "instant_book")
        .when(F.col("o_orderpriority") == "2-HIGH", "book_it")
        .when(F.col("o_orderpriority") == "5-LOW", F.lit(None))
        .otherwise("contact_me").alias("contact_channel_first"),
        F.when(F.col("o_orderstatus") == "F", "past_booker")
        .when(F.col("o_orderstatus") == "O", "new").alias("guest_user_stage_first"),
    )


def listings(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "part").select(
        F.col("p_partkey").cast("string").alias("id_listing_anon"),
        F.when(F.col("p_type").isin("STANDARD", "LARGE"), "Entire home/apt")
        .when(F.col("p_type").isin("ECONOMY", "SMALL"), "Shared room")
        .otherwise("Private room").alias("room_type"),
        F.col("p_brand").alias("listing_neighborhood"),
        F.col("p_size").cast("double").alias("total_reviews"),
    )


def users(spark: SparkSession, folder: str) -> DataFrame:
    customer, supplier = table(spark, folder, "customer"), table(spark, folder, "supplier")
    people = customer.select(
        F.concat(F.lit("C"), F.col("c_custkey").cast("string")).alias("id_user_anon"),
        F.col("c_nationkey").alias("nationkey"), F.col("c_acctbal").alias("balance"),
    ).unionByName(
        supplier.select(
            F.concat(F.lit("S"), F.col("s_suppkey").cast("string")).alias("id_user_anon"),
            F.col("s_nationkey").alias("nationkey"), F.col("s_acctbal").alias("balance"),
        )
    )
    nation = table(spark, folder, "nation")
    return people.join(nation, people.nationkey == nation.n_nationkey).select(
        "id_user_anon",
        F.col("n_name").alias("country"),
        F.floor(F.abs("balance") / 100).cast("double").alias("words_in_user_profile"),
    )
