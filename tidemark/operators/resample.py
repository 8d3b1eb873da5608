"""Calendar resampling and the marketplace metric family.

Gap rule: empty bins between the first and the last bin of a series count as
zero, bins outside that span stay NULL.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import calendar_bin, differs, present, ratio, ts_extract, ts_span
from ..session import stored

BIN = "inquiry_date"

STEP = {"H": "INTERVAL 1 HOUR", "D": "INTERVAL 1 DAY", "W": "INTERVAL 7 DAYS", "M": "INTERVAL 1 MONTH"}


def bins_between(first: Column, last: Column, interval: str) -> Column:
    """Every bin label from first to last as an array."""
    if interval not in STEP:
        raise ValueError(f"no calendar bin is called {interval!r}")
    labels = F.sequence(first, last, F.expr(STEP[interval]))
    if interval == "M":
        starts = F.sequence(F.trunc(first, "month"), F.trunc(last, "month"), F.expr(STEP[interval]))
        labels = F.transform(starts, lambda d: F.last_day(d).cast("timestamp_ntz"))
    return labels


def calendar_spine(binned: DataFrame, bin_column: str, interval: str) -> DataFrame:
    """One row per bin from the first to the last bin of the data."""
    span = binned.agg(F.min(bin_column).alias("first"), F.max(bin_column).alias("last"))
    return span.where(F.col("first").isNotNull()).select(
        F.explode(bins_between(F.col("first"), F.col("last"), interval)).alias(bin_column)
    )


def on_spine(series: DataFrame, spine: DataFrame, bin_column: str) -> DataFrame:
    """Left join of a binned series onto a dense calendar."""
    return spine.join(series, bin_column, "left")


def resample(df: DataFrame, ts: str, measures: dict[str, Column], interval: str = "D",
             bin_column: str = "bin") -> DataFrame:
    """Aggregate per calendar bin; empty bins inside the span become 0."""
    binned = stored(
        df.where(F.col(ts).isNotNull())
        .groupBy(calendar_bin(ts, interval).alias(bin_column))
        .agg(*[measure.alias(name) for name, measure in measures.items()])
    )
    dense = on_spine(binned, calendar_spine(binned, bin_column, interval), bin_column)
    return dense.select(bin_column, *[F.coalesce(F.col(n), F.lit(0)).alias(n) for n in measures])


def with_calendar(df: DataFrame, bin_column: str = BIN) -> DataFrame:
    return df.select(
        "*",
        ts_extract(bin_column, "day").alias("day"),
        ts_extract(bin_column, "month").alias("month"),
        ts_extract(bin_column, "year").alias("year"),
    )


@dataclass(frozen=True)
class Metric:
    """A mean of `value` over the rows for which `rows` holds; `needs` are its columns."""

    value: Column | None = None
    needs: tuple[str, ...] = ()
    rows: Column | None = None
    distinct: str | None = None


def _metrics() -> dict[str, Metric]:
    inquiry = "ts_interaction_first"

    def hours_to(ts: str) -> Metric:
        return Metric(ts_span(inquiry, ts, "hour"), (ts,))

    return {
        "inquiry_rate": Metric(distinct="id_guest_anon", needs=("id_guest_anon",)),
        "listing_rate": Metric(distinct="id_listing_anon", needs=("id_listing_anon",)),
        "avg_guest_profile_completeness": Metric(F.col("words_in_guest_profile"), ("words_in_guest_profile",)),
        "avg_host_profile_completeness": Metric(F.col("words_in_host_profile"), ("words_in_host_profile",)),
        "host_response_rate": Metric(present("ts_reply_at_first"), ("ts_reply_at_first",)),
        "host_approval_rate": Metric(
            present("ts_accepted_at_first"), ("ts_accepted_at_first", "contact_channel_first"),
            rows=differs("contact_channel_first", "instant_book"),
        ),
        "booking_conversion_rate": Metric(present("ts_booking_at"), ("ts_booking_at",)),
        "avg_response_time": hours_to("ts_reply_at_first"),
        "avg_approval_time": hours_to("ts_accepted_at_first"),
        "avg_booking_time": hours_to("ts_booking_at"),
        "avg_stay_time": Metric(
            ts_span("ds_checkin_first", "ds_checkout_first", "day"),
            ("ds_checkin_first", "ds_checkout_first"),
        ),
        "avg_engagement": Metric(F.col("m_interactions"), ("m_interactions",)),
        "avg_reviews": Metric(F.col("total_reviews"), ("total_reviews",)),
    }


# Metric names in output order.
METRIC_NAMES = (
    "inquiry_rate", "listing_rate", "avg_guest_profile_completeness", "avg_host_profile_completeness",
    "host_response_rate", "host_approval_rate", "booking_conversion_rate", "avg_response_time",
    "avg_approval_time", "avg_booking_time", "avg_stay_time", "avg_engagement", "avg_reviews",
)


def _check_columns(df: DataFrame, names) -> None:
    for name in names:
        if name not in df.columns:
            raise ValueError(f"the table has no column {name!r}")


def segment_filter(df: DataFrame, variable: str | None, value) -> DataFrame:
    """Rows of one segment; applies only when both arguments are given."""
    if variable is None or value is None:
        return df
    _check_columns(df, [variable])
    return df.where(F.col(variable) == F.lit(value))


def _bin_totals(df: DataFrame, names, interval: str, series: Column | None) -> DataFrame:
    """One row per (segment, value, bin) with the wanted sums and distinct counts.

    A distinct count needs its own grouping key. The rows are held in memory, on
    disk if they don't fit, so the input is read once: the sums combine on the map
    side to a row per series and bin, and only (series, bin, key) is shuffled to
    count keys, without the sums. The totals are stored.
    """
    metrics = _metrics()
    chosen = {name: metrics[name] for name in names}
    for metric in chosen.values():
        _check_columns(df, metric.needs)
    rows = df.where(F.col("ts_interaction_first").isNotNull())
    columns = [calendar_bin("ts_interaction_first", interval).alias(BIN)]
    columns.append(F.explode(series).alias("series") if series is not None else _overall_struct().alias("series"))
    sums = {}
    for name, metric in chosen.items():
        if metric.distinct is None:
            value = metric.value.cast("double")
            value = value if metric.rows is None else F.when(metric.rows, value)
            columns.append(value.alias(f"v_{name}"))
            sums[f"s_{name}"] = F.sum(f"v_{name}")
            sums[f"n_{name}"] = F.count(f"v_{name}")
    distinct = {name: m.distinct for name, m in chosen.items() if m.distinct}
    columns += [F.col(key).alias(f"k_{name}") for name, key in distinct.items()]
    rows = rows.select(*columns)
    keys = ["series", BIN]
    if not distinct:
        return stored(rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), *[c.alias(k) for k, c in sums.items()]))
    kinds = F.array(*[
        F.struct(F.lit(i).alias("kind"), F.col(f"k_{name}").cast("string").alias("id"))
        for i, name in enumerate(distinct)
    ])
    held = rows.persist()
    try:
        totals = held.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), *[c.alias(k) for k, c in sums.items()])
        copies = held.select("series", BIN, F.explode(kinds).alias("copy"))
        named = copies.where(F.col("copy.id").isNotNull()).select(
            "series", BIN, F.col("copy.kind").alias("kind"), F.col("copy.id").alias("id")).distinct()
        counts = named.groupBy(*keys).agg(*[F.count(F.when(F.col("kind") == i, 1)).alias(f"d_{name}") for i, name in enumerate(distinct)])
        t, d = totals.alias("t"), counts.alias("d")
        same = (
            (F.col(f"t.{BIN}") == F.col(f"d.{BIN}"))
            & F.col("t.series.segment").eqNullSafe(F.col("d.series.segment"))
            & F.col("t.series.value").eqNullSafe(F.col("d.series.value"))
        )
        return stored(t.join(d, same, "left").select(
            "t.*", *[F.coalesce(F.col(f"d.d_{name}"), F.lit(0)).alias(f"d_{name}") for name in distinct]))
    finally:
        held.unpersist()


def _series_struct(segment: Column, value: Column) -> Column:
    return F.struct(segment.cast("string").alias("segment"), value.cast("string").alias("value"))


def _overall_struct() -> Column:
    return _series_struct(F.lit(None), F.lit(None))


def _series_values(totals: DataFrame, names, interval: str) -> DataFrame:
    """Long form: every series on the dense overall calendar, with the gap rule.

    The stored totals (bins x series) feed the spans, the grid and the denominators.
    """
    metrics = _metrics()
    distinct = [n for n in names if metrics[n].distinct]
    approval = [n for n in names if metrics[n].rows is not None]
    spans = totals.groupBy("series").agg(
        F.min(BIN).alias("first"), F.max(BIN).alias("last"),
        *[F.min(F.when(F.col(f"n_{n}") > 0, F.col(BIN))).alias(f"first_{n}") for n in approval],
        *[F.max(F.when(F.col(f"n_{n}") > 0, F.col(BIN))).alias(f"last_{n}") for n in approval],
    )
    overall = spans.where(F.col("series.segment").isNull()).select(
        F.struct("first", "last").alias("whole")
    ).scalar()
    grid = spans.select(
        "*", F.explode(bins_between(overall.getField("first"), overall.getField("last"), interval)).alias(BIN)
    ).alias("g")
    t = totals.alias("t")
    placed = grid.join(
        t,
        (F.col(f"g.{BIN}") == F.col(f"t.{BIN}"))
        & F.col("g.series.segment").eqNullSafe(F.col("t.series.segment"))
        & F.col("g.series.value").eqNullSafe(F.col("t.series.value")),
        "left",
    ).select("g.*", *[f"t.{c}" for c in totals.columns if c not in ("series", BIN)])
    if distinct:
        everyone = (
            totals.where(F.col("series.segment").isNull())
            .select(BIN, *[F.col(f"d_{n}").alias(f"all_{n}") for n in distinct])
        )
        placed = placed.join(everyone, BIN, "left")
    out = []
    for n in names:
        if n in distinct:
            value = F.coalesce(ratio(F.col(f"d_{n}"), F.col(f"all_{n}")), F.lit(0.0))
        else:
            low, high = (f"first_{n}", f"last_{n}") if n in approval else ("first", "last")
            mean = F.coalesce(ratio(F.col(f"s_{n}"), F.col(f"n_{n}")), F.lit(0.0))
            value = F.when(F.col(BIN).between(F.col(low), F.col(high)), mean)
        out.append(value.alias(n))
    return placed.select(
        BIN, F.col("series.segment").alias("segment"), F.col("series.value").alias("value"), *out
    )


def metric_series(df: DataFrame, metric: str, interval: str = "D", variable: str | None = None,
                  value=None) -> DataFrame:
    """One metric per bin, over its own span, optionally for one segment."""
    if metric not in METRIC_NAMES:
        raise ValueError(f"unknown metric: {metric}")
    segmented = variable is not None and value is not None
    name = f"{metric}_{variable}_{value}" if segmented else metric
    distinct = _metrics()[metric].distinct
    if distinct:
        # the denominator is the unfiltered series, so the overall span applies
        series = F.array(_overall_struct())
        if segmented:
            _check_columns(df, [variable])
            hit = F.col(variable) == F.lit(value)
            mine = _series_struct(F.lit(variable), F.lit(value))
            series = F.array_compact(F.array(_overall_struct(), F.when(hit, mine)))
        totals = _bin_totals(df, [metric], interval, series)
        long = _series_values(totals, [metric], interval)
        wanted = F.col("segment").isNotNull() if segmented else F.col("segment").isNull()
        return long.where(wanted).select(BIN, F.col(metric).alias(name))
    totals = _bin_totals(segment_filter(df, variable, value), [metric], interval, None)
    long = _series_values(totals, [metric], interval)
    return long.where(F.col(metric).isNotNull()).select(BIN, F.col(metric).alias(name))


def _of_type(df: DataFrame, column: str, value) -> Column:
    """A literal in the column's type; NULL, which equals nothing, where it does not convert."""
    return F.lit(value).try_cast(df.schema[column].dataType)


def segment_series(df: DataFrame, segments: list[str], values: list | None = None,
                   interval: str = "D") -> DataFrame:
    """All metrics in long form: a row per bin, segment and value, and one per bin overall
    (segment NULL). Without `values` every value of each segment column is a series."""
    _check_columns(df, segments)
    parts = []
    for segment in segments:
        column = F.col(segment)
        keep = column.isNotNull() if values is None else column.isin([_of_type(df, segment, v) for v in values])
        parts.append(F.when(keep, _series_struct(F.lit(segment), column)))
    series = F.array_compact(F.array(_overall_struct(), *parts))
    return _series_values(_bin_totals(df, METRIC_NAMES, interval, series), METRIC_NAMES, interval)


def generate_timeseries(df: DataFrame, interval: str = "D", segments: list[str] | None = None,
                        values: list | None = None) -> DataFrame:
    """All metrics as columns on one dense calendar, with day, month and year.

    With segments there is one column per metric, segment and value. Values
    default to the distinct values of the segment columns.
    """
    metrics = _metrics()
    if not segments:
        totals = _bin_totals(df, METRIC_NAMES, interval, None)
        wide = _series_values(totals, METRIC_NAMES, interval).drop("segment", "value")
        return with_calendar(wide)
    pairs = segment_values(df, segments, values)
    long = segment_series(df, segments, values, interval)
    columns = []
    for segment, value in pairs:
        mine = (F.col("segment") == segment) & (F.col("value") == _of_type(df, segment, value).cast("string"))
        for m in METRIC_NAMES:
            found = F.max(F.when(mine, F.col(m)))
            # the rates of a segment without any row are zero in every bin
            found = F.coalesce(found, F.lit(0.0)) if metrics[m].distinct else found
            columns.append(found.alias(f"{m}_{segment}_{value}"))
    return with_calendar(long.groupBy(BIN).agg(*columns))


def segment_values(df: DataFrame, segments: list[str], values: list | None) -> list[tuple[str, object]]:
    """The (segment, value) pairs that become columns: the same values for every segment, or
    each segment's own values. Each is a column per metric; segment_series has no such width."""
    if values is not None:
        return [(segment, value) for segment in segments for value in values]
    _check_columns(df, segments)
    pairs = []
    for segment in segments:
        found = df.select(segment).where(F.col(segment).isNotNull()).distinct()
        pairs += [(segment, value) for value in sorted(r[0] for r in found.collect())]
    return pairs
