"""Queries over calendar bins: resampling and the marketplace metrics."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import resample as r
from ..session import scratch_path
from ..sources import tables
from ..sources.sinks import read_timeseries_csv, write_timeseries_csv
from . import funnel_sql as q
from .funnel_queries import master
from .registry import query, six

_STEP = {"H": ("hour", "1 HOUR"), "D": ("day", "1 DAY")}
_HOURS = "CAST(date_diff('microsecond', ts_interaction_first, {0}) AS DOUBLE) / 3.6e9"
_AGGREGATES = {
    "inquiry_rate": "count(DISTINCT id_guest_anon)",
    "listing_rate": "count(DISTINCT id_listing_anon)",
    "avg_guest_profile_completeness": "avg(words_in_guest_profile)",
    "avg_host_profile_completeness": "avg(words_in_host_profile)",
    "host_response_rate": "avg(CAST(ts_reply_at_first IS NOT NULL AS DOUBLE))",
    "host_approval_rate": "avg(CAST(ts_accepted_at_first IS NOT NULL AS DOUBLE))",
    "booking_conversion_rate": "avg(CAST(ts_booking_at IS NOT NULL AS DOUBLE))",
    "avg_response_time": f"avg({_HOURS.format('ts_reply_at_first')})",
    "avg_approval_time": f"avg({_HOURS.format('ts_accepted_at_first')})",
    "avg_booking_time": f"avg({_HOURS.format('ts_booking_at')})",
    "avg_stay_time": "avg(CAST(date_diff('microsecond', ds_checkin_first, ds_checkout_first) AS DOUBLE) / 8.64e10)",
    "avg_engagement": "avg(m_interactions)",
    "avg_reviews": "avg(total_reviews)",
}


def _bins(interval: str) -> str:
    unit, step = _STEP[interval]
    return f"""{q.MASTER},
binned AS (SELECT *, CAST(date_trunc('{unit}', ts_interaction_first) AS TIMESTAMP) AS bin
  FROM master WHERE ts_interaction_first IS NOT NULL),
spine AS (SELECT unnest(generate_series(lo, hi, INTERVAL {step})) AS bin
  FROM (SELECT min(bin) AS lo, max(bin) AS hi FROM binned))"""


def _metric_table(metric: str, where: str) -> str:
    """A SELECT of (bin, x) for every spine bin; NULL outside the span of the metric's rows."""
    aggregate = _AGGREGATES[metric]
    if metric in ("inquiry_rate", "listing_rate"):
        return f"""SELECT spine.bin, coalesce(CAST(part.n AS DOUBLE) / nullif(whole.n, 0), 0) AS x FROM spine
LEFT JOIN (SELECT bin, {aggregate} AS n FROM binned WHERE {where} GROUP BY bin) part ON part.bin = spine.bin
LEFT JOIN (SELECT bin, {aggregate} AS n FROM binned GROUP BY bin) whole ON whole.bin = spine.bin"""
    if metric == "host_approval_rate":
        where += " AND contact_channel_first IS DISTINCT FROM 'instant_book'"
    return f"""SELECT spine.bin, CASE WHEN spine.bin BETWEEN lo AND hi THEN coalesce(v, 0) END AS x FROM spine
LEFT JOIN (SELECT bin, {aggregate} AS v FROM binned WHERE {where} GROUP BY bin) part ON part.bin = spine.bin
CROSS JOIN (SELECT min(bin) AS lo, max(bin) AS hi FROM binned WHERE {where}) span"""


def _condition(variable, value) -> str:
    return f"{variable} = '{value}'" if variable else "true"


def _metric_sql(metric: str, interval: str, variable=None, value=None) -> str:
    name = f"{metric}_{variable}_{value}" if variable else metric
    return f"""WITH {_bins(interval)}
SELECT bin AS inquiry_date, x AS "{name}"
FROM ({_metric_table(metric, _condition(variable, value))}) WHERE x IS NOT NULL"""


def _series_sql(interval: str, series: list[tuple]) -> str:
    joins, columns = [], []
    for i, (variable, value) in enumerate(series):
        for metric in r.METRIC_NAMES:
            alias = f"t{i}_{metric}"
            name = f"{metric}_{variable}_{value}" if variable else metric
            joins.append(f"LEFT JOIN ({_metric_table(metric, _condition(variable, value))}) {alias} ON {alias}.bin = s.bin")
            columns.append(f'{alias}.x AS "{name}"')
    return f"""WITH {_bins(interval)} SELECT s.bin AS inquiry_date, {', '.join(columns)},
dayname(s.bin) AS day, monthname(s.bin) AS month, CAST(year(s.bin) AS INTEGER) AS year
FROM spine s {' '.join(joins)}"""


# Each metric once over all rows and once for a segment, daily or hourly.
_PLANS = {
    "inquiry_rate": ("D", "room_type", "Private room"),
    "listing_rate": ("D", "host_country", "NATION_3"),
    "avg_guest_profile_completeness": ("D", "room_type", "Shared room"),
    "avg_host_profile_completeness": ("H", None, None),
    "host_response_rate": ("D", "guest_country", "NATION_5"),
    "host_approval_rate": ("D", "guest_country", "NATION_5"),
    "booking_conversion_rate": ("D", "contact_channel_first", "book_it"),
    "avg_response_time": ("H", None, None),
    "avg_approval_time": ("D", "host_country", "NATION_4"),
    "avg_booking_time": ("D", None, None),
    "avg_stay_time": ("D", "guest_user_stage_first", "new"),
    "avg_engagement": ("D", "listing_neighborhood", "Brand#13"),
    "avg_reviews": ("D", None, None),
}


def _register_metric(metric: str, interval: str, variable, value) -> None:
    name = f"{metric}_{variable}_{value}" if variable else metric

    @query(metric, _metric_sql(metric, interval, variable, value), six(name))
    def run(spark, folder):
        return r.metric_series(master(spark, folder), metric, interval, variable, value)


for _metric, _plan in _PLANS.items():
    _register_metric(_metric, *_plan)


@query("generate_timeseries", _series_sql("D", [(None, None)]), six(*r.METRIC_NAMES))
def generate_timeseries(spark, folder):
    return r.generate_timeseries(master(spark, folder), "D")


_VALUES = ["NATION_2", "NATION_9"]
_PAIRS = [(segment, value) for segment in ("guest_country", "host_country") for value in _VALUES]


@query("generate_timeseries_segmented", _series_sql("D", _PAIRS),
       six(*[f"{m}_{s}_{v}" for s, v in _PAIRS for m in r.METRIC_NAMES]))
def generate_timeseries_segmented(spark, folder):
    return r.generate_timeseries(master(spark, folder), "D", ["guest_country", "host_country"], _VALUES)


def _long_sql() -> str:
    parts = []
    for variable, value in [(None, None)] + [("room_type", v) for v in (
            "Entire home/apt", "Private room", "Shared room")]:
        joins = " ".join(
            f"LEFT JOIN ({_metric_table(m, _condition(variable, value))}) t_{m} ON t_{m}.bin = s.bin"
            for m in r.METRIC_NAMES)
        labels = f"'{variable}' AS segment, '{value}' AS value" if variable else (
            "CAST(NULL AS VARCHAR) AS segment, CAST(NULL AS VARCHAR) AS value")
        parts.append(f"""SELECT s.bin AS inquiry_date, {labels},
{', '.join(f't_{m}.x AS {m}' for m in r.METRIC_NAMES)} FROM spine s {joins}""")
    return f"WITH {_bins('D')} {' UNION ALL '.join(parts)}"


@query("timeseries_by_segment", _long_sql(), six(*r.METRIC_NAMES))
def timeseries_by_segment(spark, folder):
    """Long form over every value of a segment column."""
    return r.segment_series(master(spark, folder), ["room_type"])


@query("sink_timeseries", _series_sql("D", [(None, None)]), six(*r.METRIC_NAMES))
def sink_timeseries(spark, folder):
    """The metric table written as CSV with its calendar column and read back."""
    path = scratch_path(spark, "timeseries_csv")
    series = r.generate_timeseries(master(spark, folder), "D")
    write_timeseries_csv(series, path)
    return read_timeseries_csv(spark, path, series.schema)


_EVENT_BINS = """
WITH b AS (SELECT CAST(date_trunc('{unit}', ts) AS TIMESTAMP) AS bin, {agg} FROM events GROUP BY 1),
spine AS (SELECT unnest(generate_series(lo, hi, INTERVAL {step})) AS bin
  FROM (SELECT min(bin) AS lo, max(bin) AS hi FROM b))
SELECT spine.bin, {out} FROM spine LEFT JOIN b ON b.bin = spine.bin"""


@query("resample_nunique", _EVENT_BINS.format(
    unit="hour", step="1 HOUR", agg="count(DISTINCT user_id) AS n, count(DISTINCT event_type) AS m",
    out="coalesce(n, 0) AS n_users, coalesce(m, 0) AS n_types"))
def resample_nunique(spark, folder):
    events = tables.table(spark, folder, "events")
    return r.resample(events, "ts", {
        "n_users": F.countDistinct("user_id"), "n_types": F.countDistinct("event_type")}, "H")


@query("resample_mean", _EVENT_BINS.format(
    unit="hour", step="1 HOUR", agg="avg(value) AS v", out="coalesce(v, 0) AS mean_value"), six("mean_value"))
def resample_mean(spark, folder):
    return r.resample(tables.table(spark, folder, "events"), "ts", {"mean_value": F.avg("value")}, "H")


@query("resample_sum", _EVENT_BINS.format(
    unit="day", step="1 DAY", agg="count(*) FILTER (event_type = 'purchase') AS v",
    out="CAST(coalesce(v, 0) AS BIGINT) AS purchases"))
def resample_sum(spark, folder):
    bought = (F.col("event_type") == "purchase").cast("int")
    return r.resample(tables.table(spark, folder, "events"), "ts", {"purchases": F.sum(bought)}, "D")


@query("spine_left_join", """
WITH b AS (SELECT CAST(date_trunc('day', o_orderdate) AS TIMESTAMP) AS bin, o_orderstatus, count(*) AS n
  FROM orders GROUP BY 1, 2),
spine AS (SELECT unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS bin
  FROM (SELECT min(bin) AS lo, max(bin) AS hi FROM b))
SELECT spine.bin, n AS pending FROM spine LEFT JOIN (SELECT bin, n FROM b WHERE o_orderstatus = 'P') p
ON p.bin = spine.bin""")
def spine_left_join(spark, folder):
    orders = tables.table(spark, folder, "orders")
    binned = orders.withColumn("bin", r.calendar_bin("o_orderdate", "D"))
    pending = binned.where(F.col("o_orderstatus") == "P").groupBy("bin").agg(F.count(F.lit(1)).alias("pending"))
    return r.on_spine(pending, r.calendar_spine(binned, "bin", "D"), "bin")
