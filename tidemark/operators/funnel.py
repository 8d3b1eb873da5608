"""Booking funnel: the joined fact view, hour-grain aggregates and the hourly funnel."""

from __future__ import annotations

import re
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .attach import BROADCAST_ROWS
from ..functions.columns import (
    calendar_bin, missing_or_at_least, missing_or_within_days, present, ratio, ts_extract, ts_span,
    equals_flag,
)

REPLY_LIMIT_DAYS = 0.2
# Contacts of one cell of the grid at most, and parts into which each of its three sides is cut at least.
CELL_ROWS, GRID_SIDE = 1 << 21, 4
# A copied row of a dimension is about a fifth of what the contacts' two other shuffles move for a row.
COPIES_PER_CONTACT = 5
# Dimensions that stay below Spark's broadcast limit at so many bytes a row are left to Spark.
DIMENSION_ROW_BYTES = 50


def plausible_contacts(contacts: DataFrame) -> DataFrame:
    """Contacts whose check-in is not before the inquiry and whose reply came in time."""
    return contacts.where(
        missing_or_at_least("ds_checkin_first", "ts_interaction_first")
        & missing_or_within_days("ts_interaction_first", "ts_reply_at_first", REPLY_LIMIT_DAYS)
    )


def _threshold(spark: SparkSession) -> int:
    """Spark's limit for broadcasts in bytes."""
    number, unit = re.fullmatch(r"(-?\d+)([kmgt]?)b?", spark.conf.get("spark.sql.autoBroadcastJoinThreshold").lower()).groups()
    return int(number) << 10 * " kmgt".index(unit or " ")


def _grid_side(contacts: DataFrame, listings: DataFrame, users: DataFrame) -> int | None:
    """Parts for each side of the grid; None where one shuffle for each join moves less."""
    n_listings, n_users = listings.count(), users.count()
    if max(n_listings, n_users) <= max(BROADCAST_ROWS, _threshold(contacts.sparkSession) // DIMENSION_ROW_BYTES):
        return None
    n, side = contacts.count(), GRID_SIDE
    while side ** 3 * CELL_ROWS < n:
        side += 1
    return side if side ** 2 * (n_listings + 2 * n_users) <= COPIES_PER_CONTACT * n else None


def _as_spans(rows: DataFrame) -> tuple[DataFrame, dict[str, Column]]:
    """The rows with every timestamp but the first as the span since that, and the columns that bring
    the timestamps back. A row's moments lie close together, so the spans are short and compress better."""
    spans, moments = {}, {}
    for kind in ("timestamp", "timestamp_ntz"):
        names = [name for name, its in rows.dtypes if its == kind]
        if names:
            start = F.coalesce(F.col(names[0]), F.lit("1970-01-01").cast(kind))
        for c in names[1:]:
            if kind == "timestamp":  # no difference of local times, which are not the same all year
                spans[c] = F.unix_micros(c) - F.unix_micros(start)
                moments[c] = F.timestamp_micros(F.col(c) + F.unix_micros(start))
            else:
                spans[c], moments[c] = F.col(c) - start, start + F.col(c)
    return rows.withColumns(spans), moments


def _join_on_grid(rows: DataFrame, roles: dict[str, DataFrame], side: int) -> DataFrame:
    """Inner joins of `rows` with every dimension on its key, in one shuffle of `rows`.

    Each key's hash cuts one side of a grid. A row goes to the one cell that its keys name, a
    dimension's row to all cells of its part, so they meet whatever the order of the joins. A key's
    rows spread over as many cells as the other keys have parts.
    """
    rows, moments = _as_spans(rows)

    def part(key: str, place: int) -> Column:
        return (F.pmod(F.xxhash64(key), F.lit(side)) * side ** place).cast("int")

    parts = [part(key, place) for place, key in enumerate(roles)]
    cells = side ** len(roles)
    joined = rows.withColumn("__cell", reduce(lambda a, b: a + b, parts)).repartitionById(cells, F.col("__cell"))
    for place, (key, dimension) in enumerate(roles.items()):
        first = [cell for cell in range(cells) if cell // side ** place % side == 0]
        copies = dimension.withColumn("__first", F.explode(F.array(*[F.lit(cell) for cell in first]))).withColumn(
            "__cell", F.col("__first") + parts[place]).drop("__first")
        joined = joined.join(copies.repartitionById(cells, F.col("__cell")).hint("merge"), ["__cell", key])
    return joined.withColumns(moments)


def master(contacts: DataFrame, listings: DataFrame, users: DataFrame) -> DataFrame:
    """Contacts joined with their listing, guest and host.

    The tables are counted first. Small dimensions carry no hint: Spark broadcasts the ones below its
    size threshold and sort-merges, with skew splitting, the others. For larger ones the wide contacts
    are shuffled once for all three joins, and the dimensions' narrow rows are copied to meet them,
    as long as that moves less.
    """

    def as_role(role: str) -> DataFrame:
        return users.select(
            F.col("id_user_anon").alias(f"id_{role}_anon"),
            F.col("country").alias(f"{role}_country"),
            F.col("words_in_user_profile").alias(f"words_in_{role}_profile"),
        )

    roles = {"id_listing_anon": listings, "id_guest_anon": as_role("guest"), "id_host_anon": as_role("host")}
    joined, side = plausible_contacts(contacts), _grid_side(contacts, listings, users)
    if side is not None:
        joined = _join_on_grid(joined, roles, side)
    else:
        for key, dimension in roles.items():
            joined = joined.join(dimension, key)
    return joined.select(
        *contacts.columns, "room_type", "listing_neighborhood", "total_reviews",
        "guest_country", "words_in_guest_profile", "host_country", "words_in_host_profile",
    )


def in_inquiry_order(df: DataFrame) -> DataFrame:
    return df.orderBy(F.col("ts_interaction_first").asc_nulls_last())


def _inquiry_measures(scope: Callable[[Column], Column]) -> list[Column]:
    """Aggregates over inquiries. `scope` limits each input to the rows that are inquiries."""

    def of(name: str) -> Column:
        return scope(F.col(name))

    def hits(name: str, value: str) -> Column:
        return F.sum(scope(equals_flag(name, value)))

    def share(name: str, value: str) -> Column:
        return ratio(hits(name, value), F.count(of(name)))

    room, channel, stage = "room_type", "contact_channel_first", "guest_user_stage_first"
    inquiries = F.count(of("ts_interaction_first"))
    return [
        inquiries.alias("total_inquiries"),
        F.avg(of("m_guests")).alias("avg_guests"),
        F.avg(of("m_interactions")).alias("avg_interactions"),
        ratio(inquiries, F.countDistinct(of("id_guest_anon"))).alias("avg_inquires_per_guest"),
        hits(room, "Entire home/apt").alias("total_home_inquires"),
        hits(room, "Shared room").alias("total_shared_inquires"),
        hits(room, "Private room").alias("total_private_inquires"),
        F.avg(of("m_first_message_length_in_characters")).alias("avg_message_length"),
        hits(channel, "contact_me").alias("total_contact_me"),
        hits(channel, "book_it").alias("total_book_it"),
        hits(channel, "instant_book").alias("total_instant_book"),
        share(channel, "contact_me").alias("pct_contact_me"),
        share(channel, "book_it").alias("pct_book_it_me"),
        share(channel, "instant_book").alias("pct_instant_book"),
        share(stage, "past_booker").alias("pct_past_booker"),
        share(stage, "new").alias("pct_new_user"),
    ]


def hourly_inquiries(m: DataFrame) -> DataFrame:
    hour = calendar_bin("ts_interaction_first", "H").alias("inquiry_time")
    return m.groupBy(hour).agg(*_inquiry_measures(lambda c: c))


def _by_hour(m: DataFrame, ts: str, hour: str, total: str, *more: Column) -> DataFrame:
    return m.groupBy(calendar_bin(ts, "H").alias(hour)).agg(F.count(ts).alias(total), *more)


def hourly_replies(m: DataFrame) -> DataFrame:
    """Replies per hour; contacts without a reply form a NULL hour with count 0."""
    lag = F.avg(ts_span("ts_interaction_first", "ts_reply_at_first", "hour"))
    return _by_hour(m, "ts_reply_at_first", "reply_time", "total_replies", lag.alias("avg_reply_hours"))


def hourly_accepted(m: DataFrame) -> DataFrame:
    return _by_hour(m, "ts_accepted_at_first", "accepted_time", "total_accepted")


def hourly_bookings(m: DataFrame) -> DataFrame:
    return _by_hour(m, "ts_booking_at", "booking_time", "total_booking")


# Funnel stages in order: timestamp, hour column, count column.
STAGES = (
    ("ts_interaction_first", "inquiry_time", "total_inquiries"),
    ("ts_reply_at_first", "reply_time", "total_replies"),
    ("ts_accepted_at_first", "accepted_time", "total_accepted"),
    ("ts_booking_at", "booking_time", "total_booking"),
)


def hourly_funnel(m: DataFrame, how: str = "inner") -> DataFrame:
    """The four hour-grain tables side by side.

    `inner` keeps the hours where all four stages occur, `full` every hour in
    which any stage occurs. Every contact is spread to the hours of its stages
    first, so the joined fact rows are read once and shuffled once, by hour.
    """
    if how not in ("inner", "full"):
        raise ValueError(f"how must be 'inner' or 'full', not {how!r}")
    hours = F.array(*[
        F.struct(F.lit(i).alias("stage"), calendar_bin(ts, "H").alias("hour"))
        for i, (ts, _, _) in enumerate(STAGES)
    ])
    moments = (
        m.withColumn("moment", F.explode(hours))
        .where(F.col("moment.hour").isNotNull())
        .withColumn("time", F.col("moment.hour"))
        .withColumn("stage", F.col("moment.stage"))
    )

    def within(i: int) -> Callable[[Column], Column]:
        return lambda c: F.when(F.col("stage") == i, c)

    lag = ts_span("ts_interaction_first", "ts_reply_at_first", "hour")
    wide = moments.groupBy("time").agg(
        *_inquiry_measures(within(0)),
        F.avg(within(1)(lag)).alias("avg_reply_hours"),
        *[
            F.count(within(i)(F.col("time"))).alias(total)
            for i, (_, _, total) in enumerate(STAGES) if i > 0
        ],
    )
    occurs = [F.col(total) > 0 for _, _, total in STAGES]
    if how == "inner":
        wide = wide.where(reduce(lambda a, b: a & b, occurs))
    first_stage = [c for c in wide.columns if c not in (
        "time", "avg_reply_hours", "total_replies", "total_accepted", "total_booking")]
    parts = [first_stage, ["total_replies", "avg_reply_hours"], ["total_accepted"], ["total_booking"]]
    out = []
    for (_, hour, _), occurred, names in zip(STAGES, occurs, parts):
        out.append(F.when(occurred, F.col("time")).alias(hour))
        out += [F.when(occurred, F.col(c)).alias(c) for c in names]
    return wide.select(*out, "time")


def create_dataset(m: DataFrame) -> DataFrame:
    """One row per contact: dates, their parts, stage flags, lags and descriptors."""
    dates = {
        "inquiry": "ts_interaction_first", "reply": "ts_reply_at_first",
        "accept": "ts_accepted_at_first", "book": "ts_booking_at",
    }
    out = [F.col(ts).alias(f"{name}_date") for name, ts in dates.items()]
    for unit in ("year", "month", "day", "hour"):
        out += [ts_extract(ts, unit).alias(f"{name}_{unit}") for name, ts in dates.items()]
    out.append(F.col("contact_channel_first").alias("inquiry_type"))
    flags = {"replied": "reply", "accepted": "accept", "booked": "book"}
    out += [present(dates[stage]).alias(flag) for flag, stage in flags.items()]
    out += [
        ts_span(dates["inquiry"], dates[stage], "hour").alias(f"{stage}_lag")
        for stage in ("reply", "accept", "book")
    ]
    out += [
        ts_span("ds_checkin_first", "ds_checkout_first", "day").alias("stay_duration"),
        equals_flag("guest_user_stage_first", "past_booker").alias("past_booker"),
    ]
    renamed = {
        "guest_id": "id_guest_anon", "host_id": "id_host_anon", "guest_country": "guest_country",
        "host_country": "host_country", "n_guests": "m_guests", "n_interactions": "m_interactions",
        "room_type": "room_type", "n_reviews": "total_reviews",
        "guest_msg_length": "m_first_message_length_in_characters",
        "n_guest_about_me_words": "words_in_guest_profile",
        "n_host_about_me_words": "words_in_host_profile",
    }
    out += [F.col(old).alias(new) for new, old in renamed.items()]
    return m.select(*out)
