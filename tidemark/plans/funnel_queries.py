"""Queries over the funnel tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import columns as c
from ..operators import funnel, resample
from ..sources import funnel_tables, tables
from ..session import scratch_path
from . import funnel_sql as q
from .registry import query, six


def funnel_base(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    return {
        "contacts": funnel_tables.contacts(spark, folder),
        "listings": funnel_tables.listings(spark, folder),
        "users": funnel_tables.users(spark, folder),
    }


def master(spark: SparkSession, folder: str) -> DataFrame:
    return funnel.master(**funnel_base(spark, folder))


@query("scan_typed", f"""WITH {q.CONTACTS}, {q.LISTINGS}, {q.USERS}
SELECT 'contacts' AS table_name, count(*) AS n_rows, count(ts_reply_at_first) AS n_a, count(ts_booking_at) AS n_b,
  count(ds_checkin_first) AS n_c, count(contact_channel_first) AS n_d FROM contacts
UNION ALL SELECT 'listings', count(*), count(room_type), count(listing_neighborhood), count(total_reviews), 0 FROM listings
UNION ALL SELECT 'users', count(*), count(country), count(words_in_user_profile), 0, 0 FROM users""")
def scan_typed(spark, folder):
    """Rows and present values of the three typed base tables."""
    base = funnel_base(spark, folder)
    wanted = {
        "contacts": ["ts_reply_at_first", "ts_booking_at", "ds_checkin_first", "contact_channel_first"],
        "listings": ["room_type", "listing_neighborhood", "total_reviews"],
        "users": ["country", "words_in_user_profile"],
    }
    parts = []
    for name, columns in wanted.items():
        counts = [F.count(col) for col in columns] + [F.lit(0).cast("long")] * (4 - len(columns))
        parts.append(base[name].agg(
            F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("n_rows"),
            *[n.alias(f"n_{letter}") for n, letter in zip(counts, "abcd")],
        ))
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query("scan_csv", "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def scan_csv(spark, folder):
    """The customer table through CSV, read back with a declared schema."""
    customer = tables.table(spark, folder, "customer")
    path = scratch_path(spark, "customer_csv")
    customer.write.option("header", True).csv(path)
    return tables.read_csv_lines(spark, path, customer.schema)


def _through_csv(spark, folder, name, schema):
    """A base table written as CSV and loaded with its declared types."""
    path = scratch_path(spark, f"{name}_csv")
    funnel_base(spark, folder)[name].write.option("header", True).option("escape", '"').options(
        timestampNTZFormat="yyyy-MM-dd HH:mm:ss.SSSSSS").csv(path)
    return tables.read_csv(spark, path, schema)


@query("load_contacts", f"WITH {q.CONTACTS} SELECT * FROM contacts")
def load_contacts(spark, folder):
    return _through_csv(spark, folder, "contacts", tables.CONTACTS)


@query("load_listings", f"WITH {q.LISTINGS} SELECT * FROM listings")
def load_listings(spark, folder):
    return _through_csv(spark, folder, "listings", tables.LISTINGS)


@query("load_users", f"WITH {q.USERS} SELECT * FROM users")
def load_users(spark, folder):
    return _through_csv(spark, folder, "users", tables.USERS)


@query("named_views", f"""WITH {q.MASTER}
SELECT guest_country, count(*) AS n, count(DISTINCT id_listing_anon) AS n_listings
FROM master GROUP BY guest_country""")
def named_views(spark, folder):
    tables.register_views({"funnel_master": master(spark, folder)})
    return spark.sql("""SELECT guest_country, count(*) AS n, count(DISTINCT id_listing_anon) AS n_listings
        FROM funnel_master GROUP BY guest_country""")


@query("filter_null_tolerant", f"""WITH {q.CONTACTS}
SELECT * FROM contacts WHERE ds_checkin_first IS NULL OR ds_checkin_first >= ts_interaction_first""")
def filter_null_tolerant(spark, folder):
    return funnel_tables.contacts(spark, folder).where(
        c.missing_or_at_least("ds_checkin_first", "ts_interaction_first"))


@query("filter_interval_lag", f"""WITH {q.CONTACTS}
SELECT * FROM contacts WHERE ts_reply_at_first IS NULL
  OR date_diff('microsecond', ts_interaction_first, ts_reply_at_first) < 17280000000""")
def filter_interval_lag(spark, folder):
    return funnel_tables.contacts(spark, folder).where(
        c.missing_or_within_days("ts_interaction_first", "ts_reply_at_first", funnel.REPLY_LIMIT_DAYS))


@query("filter_segment", f"WITH {q.MASTER} SELECT * FROM master WHERE room_type = 'Private room'")
def filter_segment(spark, folder):
    return resample.segment_filter(master(spark, folder), "room_type", "Private room")


@query("filter_null_safe_ne", f"""WITH {q.CONTACTS}
SELECT * FROM contacts WHERE contact_channel_first IS DISTINCT FROM 'instant_book'""")
def filter_null_safe_ne(spark, folder):
    return funnel_tables.contacts(spark, folder).where(c.differs("contact_channel_first", "instant_book"))


@query("filter_in_list", f"WITH {q.USERS} SELECT * FROM users WHERE country IN ('NATION_1', 'NATION_7')")
def filter_in_list(spark, folder):
    return funnel_tables.users(spark, folder).where(F.col("country").isin("NATION_1", "NATION_7"))


@query("presence_flags", f"""WITH {q.CONTACTS}
SELECT id_guest_anon, id_listing_anon, ts_interaction_first,
  CAST(ts_reply_at_first IS NOT NULL AS INTEGER) AS replied,
  CAST(ts_accepted_at_first IS NOT NULL AS INTEGER) AS accepted,
  CAST(ts_booking_at IS NOT NULL AS INTEGER) AS booked,
  CAST(guest_user_stage_first IS NOT DISTINCT FROM 'past_booker' AS INTEGER) AS past_booker
FROM contacts""")
def presence_flags(spark, folder):
    return funnel_tables.contacts(spark, folder).select(
        "id_guest_anon", "id_listing_anon", "ts_interaction_first",
        c.present("ts_reply_at_first").alias("replied"),
        c.present("ts_accepted_at_first").alias("accepted"),
        c.present("ts_booking_at").alias("booked"),
        c.equals_flag("guest_user_stage_first", "past_booker").alias("past_booker"),
    )


@query("ts_span", f"""WITH {q.CONTACTS}
SELECT id_guest_anon, id_listing_anon, ts_interaction_first,
  CAST(date_diff('microsecond', ts_interaction_first, ts_reply_at_first) AS DOUBLE) / 3.6e9 AS reply_hours,
  CAST(date_diff('microsecond', ds_checkin_first, ds_checkout_first) AS DOUBLE) / 8.64e10 AS stay_days
FROM contacts""", six("reply_hours", "stay_days"))
def ts_span(spark, folder):
    return funnel_tables.contacts(spark, folder).select(
        "id_guest_anon", "id_listing_anon", "ts_interaction_first",
        c.ts_span("ts_interaction_first", "ts_reply_at_first", "hour").alias("reply_hours"),
        c.ts_span("ds_checkin_first", "ds_checkout_first", "day").alias("stay_days"),
    )


@query("ts_extract", """
SELECT event_id, CAST(hour(ts) AS INTEGER) AS hour, dayname(ts) AS day, monthname(ts) AS month,
  CAST(year(ts) AS INTEGER) AS year, CAST(isodow(ts) - 1 AS INTEGER) AS day_order,
  CAST(month(ts) AS INTEGER) AS month_order,
  date_trunc('hour', ts) AS bin_hour, CAST(date_trunc('day', ts) AS TIMESTAMP) AS bin_day,
  CAST(date_trunc('week', ts) AS TIMESTAMP) + INTERVAL 6 DAY AS bin_week,
  CAST(last_day(ts) AS TIMESTAMP) AS bin_month
FROM events""")
def ts_extract(spark, folder):
    return tables.table(spark, folder, "events").select(
        "event_id",
        *[c.ts_extract("ts", unit).alias(unit) for unit in ("hour", "day", "month", "year")],
        c.ts_ordinal("ts", "day").alias("day_order"), c.ts_ordinal("ts", "month").alias("month_order"),
        c.calendar_bin("ts", "H").alias("bin_hour"), c.calendar_bin("ts", "D").alias("bin_day"),
        c.calendar_bin("ts", "W").alias("bin_week"), c.calendar_bin("ts", "M").alias("bin_month"),
    )


@query("master_view", f"WITH {q.MASTER} SELECT * FROM master ORDER BY ts_interaction_first ASC NULLS LAST")
def master_view(spark, folder):
    return funnel.in_inquiry_order(master(spark, folder))


_INQUIRY_DOUBLES = six(
    "avg_guests", "avg_interactions", "avg_inquires_per_guest", "avg_message_length", "pct_contact_me",
    "pct_book_it_me", "pct_instant_book", "pct_past_booker", "pct_new_user",
)


@query("hourly_inquiries", f"WITH {q.MASTER}, {q.INQUIRIES} SELECT * FROM inquiries", _INQUIRY_DOUBLES)
def hourly_inquiries(spark, folder):
    return funnel.hourly_inquiries(master(spark, folder))


@query("hourly_replies", f"WITH {q.MASTER}, {q.REPLIES} SELECT * FROM replies ORDER BY reply_time ASC NULLS LAST",
       six("avg_reply_hours"))
def hourly_replies(spark, folder):
    return funnel.hourly_replies(master(spark, folder)).orderBy(F.col("reply_time").asc_nulls_last())


@query("hourly_accepted", f"WITH {q.MASTER}, {q.ACCEPTED} SELECT * FROM accepted ORDER BY accepted_time ASC NULLS LAST")
def hourly_accepted(spark, folder):
    return funnel.hourly_accepted(master(spark, folder)).orderBy(F.col("accepted_time").asc_nulls_last())


@query("hourly_bookings", f"WITH {q.MASTER}, {q.BOOKINGS} SELECT * FROM bookings ORDER BY booking_time ASC NULLS LAST")
def hourly_bookings(spark, folder):
    return funnel.hourly_bookings(master(spark, folder)).orderBy(F.col("booking_time").asc_nulls_last())


def _funnel_sql(how: str) -> str:
    return f"""WITH {q.STAGES}
SELECT i.*, r.*, a.*, b.*, coalesce(inquiry_time, reply_time, accepted_time, booking_time) AS "time"
FROM (SELECT * FROM inquiries WHERE inquiry_time IS NOT NULL) i
{how} JOIN (SELECT * FROM replies WHERE reply_time IS NOT NULL) r ON i.inquiry_time = r.reply_time
{how} JOIN (SELECT * FROM accepted WHERE accepted_time IS NOT NULL) a
  ON coalesce(inquiry_time, reply_time) = accepted_time
{how} JOIN (SELECT * FROM bookings WHERE booking_time IS NOT NULL) b
  ON coalesce(inquiry_time, reply_time, accepted_time) = booking_time"""


_FUNNEL_DOUBLES = {**_INQUIRY_DOUBLES, "avg_reply_hours": 6}


@query("hourly_funnel", _funnel_sql("INNER"), _FUNNEL_DOUBLES)
def hourly_funnel(spark, folder):
    return funnel.hourly_funnel(master(spark, folder)).orderBy("time")


@query("hourly_funnel_full", _funnel_sql("FULL"), _FUNNEL_DOUBLES)
def hourly_funnel_full(spark, folder):
    return funnel.hourly_funnel(master(spark, folder), how="full").orderBy("time")


def _dataset_sql() -> str:
    dates = {"inquiry": "ts_interaction_first", "reply": "ts_reply_at_first",
             "accept": "ts_accepted_at_first", "book": "ts_booking_at"}
    out = [f"{ts} AS {n}_date" for n, ts in dates.items()]
    forms = {"year": "CAST(year({0}) AS INTEGER)", "month": "monthname({0})", "day": "dayname({0})",
             "hour": "CAST(hour({0}) AS INTEGER)"}
    for unit, form in forms.items():
        out += [f"{form.format(ts)} AS {n}_{unit}" for n, ts in dates.items()]
    for flag, n in (("replied", "reply"), ("accepted", "accept"), ("booked", "book")):
        out.append(f"CAST({dates[n]} IS NOT NULL AS INTEGER) AS {flag}")
        out.append(f"CAST(date_diff('microsecond', ts_interaction_first, {dates[n]}) AS DOUBLE) / 3.6e9 AS {n}_lag")
    return f"""WITH {q.MASTER} SELECT {', '.join(out)}, contact_channel_first AS inquiry_type,
  CAST(date_diff('microsecond', ds_checkin_first, ds_checkout_first) AS DOUBLE) / 8.64e10 AS stay_duration,
  CAST(guest_user_stage_first IS NOT DISTINCT FROM 'past_booker' AS INTEGER) AS past_booker,
  id_guest_anon AS guest_id, id_host_anon AS host_id, guest_country, host_country, m_guests AS n_guests,
  m_interactions AS n_interactions, room_type, total_reviews AS n_reviews,
  m_first_message_length_in_characters AS guest_msg_length,
  words_in_guest_profile AS n_guest_about_me_words, words_in_host_profile AS n_host_about_me_words FROM master"""


@query("create_dataset", _dataset_sql(), six("reply_lag", "accept_lag", "book_lag", "stay_duration"))
def create_dataset(spark, folder):
    return funnel.create_dataset(master(spark, folder))
