"""Small hand-computed cases for the decisive edge rules."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidemark.functions import columns as c
from tidemark.functions import text
from tidemark.operators import cluster, encode, funnel, ordered, outliers, profile, resample, scaling, scores
from tidemark.sources.tables import CONTACTS

DAY = datetime(2024, 1, 1)


def contact(**given):
    row = dict.fromkeys(CONTACTS.names)
    row.update(id_guest_anon="g", id_host_anon="h", id_listing_anon="l", ts_interaction_first=DAY)
    row.update(given)
    return tuple(row[n] for n in CONTACTS.names)


def master_of(spark, *rows):
    df = spark.createDataFrame([contact(**r) for r in rows], CONTACTS)
    listings = spark.createDataFrame([("l", "Private room", "n", 3.0), ("k", "Shared room", "n", 5.0)],
                                     "id_listing_anon string, room_type string, listing_neighborhood string, total_reviews double")
    users = spark.createDataFrame([(u, "NL", 4.0) for u in ("g", "g2", "h")],
                                  "id_user_anon string, country string, words_in_user_profile double")
    return funnel.master(df, listings, users)


def values(df, *names):
    return [tuple(r[n] for n in names) if len(names) > 1 else r[names[0]] for r in df.collect()]


def test_null_hour_group(spark):
    m = master_of(spark, {}, {"ts_reply_at_first": DAY + timedelta(hours=1), "ts_accepted_at_first": DAY,
                              "ts_booking_at": DAY})
    rows = {r["reply_time"]: (r["total_replies"], r["avg_reply_hours"]) for r in funnel.hourly_replies(m).collect()}
    assert rows == {None: (0, None), DAY + timedelta(hours=1): (1, 1.0)}
    assert funnel.hourly_funnel(m).count() == 0
    full = funnel.hourly_funnel(m, "full")
    assert sorted(values(full, "time")) == [DAY, DAY + timedelta(hours=1)]
    with pytest.raises(ValueError):
        funnel.hourly_funnel(m, "left")


def test_reply_boundary(spark):
    lags = [timedelta(minutes=288), timedelta(minutes=287, seconds=59, milliseconds=999), timedelta(minutes=-5), None]
    rows = [{"ts_reply_at_first": DAY + lag if lag is not None else None} for lag in lags]
    kept = values(master_of(spark, *rows), "ts_reply_at_first")
    assert set(kept) == {DAY + lags[1], DAY + lags[2], None}


def test_rows_without_dimension_are_dropped(spark):
    assert master_of(spark, {"id_guest_anon": "nobody"}, {"id_listing_anon": "none"}).count() == 0


def test_span_fill(spark):
    days = [DAY + timedelta(days=i) for i in range(5)]
    rows = [{"ts_interaction_first": d, "m_interactions": 1.0, "id_guest_anon": "g"} for d in days]
    rows += [{"ts_interaction_first": days[i], "m_interactions": 3.0 + i, "id_listing_anon": "k", "id_guest_anon": "g2"}
             for i in (1, 3)]
    m = master_of(spark, *rows)
    wide = resample.generate_timeseries(m, "D", ["room_type"], ["Shared room"]).orderBy("inquiry_date")
    assert values(wide, "avg_engagement_room_type_Shared room") == [None, 4.0, 0.0, 6.0, None]
    assert values(wide, "inquiry_rate_room_type_Shared room") == [0.0, 0.5, 0.0, 0.5, 0.0]
    alone = resample.metric_series(m, "avg_engagement", "D", "room_type", "Shared room").orderBy("inquiry_date")
    assert values(alone, "avg_engagement_room_type_Shared room") == [4.0, 0.0, 6.0]
    with pytest.raises(ValueError):
        resample.metric_series(m, "avg_engagement", "D", "nothing", "x")


def test_segment_without_rows(spark):
    m = master_of(spark, {"m_interactions": 1.0})
    row = resample.generate_timeseries(m, "D", ["room_type"], ["Tent"]).first()
    assert row["inquiry_rate_room_type_Tent"] == 0.0
    assert row["avg_engagement_room_type_Tent"] is None


def test_default_segment_values(spark):
    m = master_of(spark, {"m_interactions": 1.0}, {"id_listing_anon": "k", "m_interactions": 2.0})
    row = resample.generate_timeseries(m, "D", ["room_type"]).first()
    assert row["avg_engagement_room_type_Shared room"] == 2.0
    assert row["avg_engagement_room_type_Private room"] == 1.0


def test_one_value_list_for_columns_of_different_types(spark):
    m = master_of(spark, {"m_guests": 2.0, "m_interactions": 5.0}, {"m_guests": 3.0, "m_interactions": 7.0})
    row = resample.generate_timeseries(m, "D", ["room_type", "m_guests"], ["Private room", 2.0]).first()
    assert row["avg_engagement_m_guests_2.0"] == 5.0
    assert row["avg_engagement_room_type_Private room"] == 6.0
    assert row["avg_engagement_m_guests_Private room"] is None


def test_instant_null(spark):
    m = master_of(spark, {"contact_channel_first": "instant_book", "ts_accepted_at_first": DAY},
                  {"contact_channel_first": None, "ts_accepted_at_first": DAY}, {"contact_channel_first": "book_it"})
    assert values(resample.metric_series(m, "host_approval_rate"), "host_approval_rate") == [0.5]


def test_week_and_month_bins(spark):
    rows = spark.createDataFrame([(datetime(2024, 1, 7, 13),), (datetime(2024, 1, 8),), (datetime(2024, 3, 31),)],
                                 "ts timestamp_ntz")
    assert values(rows.select(c.calendar_bin("ts", "W").alias("b")), "b")[:2] == [
        datetime(2024, 1, 7), datetime(2024, 1, 14)]
    monthly = resample.resample(rows, "ts", {"n": F.count(F.lit(1))}, "M").orderBy("bin")
    assert values(monthly, "bin", "n") == [
        (datetime(2024, 1, 31), 2), (datetime(2024, 2, 29), 0), (datetime(2024, 3, 31), 1)]


def test_unknown_units():
    for call in (lambda: c.ts_span("a", "b", "week"), lambda: c.ts_extract("a", "week")):
        with pytest.raises(ValueError):
            call()


def test_iqr_nulls(spark):
    df = spark.createDataFrame([(i, v) for i, v in enumerate([1.0, 2.0, None, 100.0, 3.0, 2.0])], "i int, v double")
    out = outliers.impute_median(df, "v").orderBy("i")
    assert values(out, "v") == [1.0, 2.0, 2.0, 2.0, 3.0, 2.0]


def test_even_odd_window(spark):
    df = spark.createDataFrame([("a", i, float(i)) for i in range(1, 7)], "k string, i int, v double")

    def averaged(weights):
        return values(ordered.moving_average(df, "v", ["k"], ["i"], weights, "m").orderBy("i"), "m")

    assert averaged([1.0] * 3) == [1.5, 2.0, 3.0, 4.0, 5.0, 5.5]
    assert averaged([1.0] * 4) == [1.5, 2.0, 2.5, 3.5, 4.5, 5.0]
    long = [1.0 + (j == 3) for j in range(71)]
    expected = []
    for i in range(6):
        cells = [(long[j], i + j - 35 + 1) for j in range(71) if 0 <= i + j - 35 < 6]
        expected.append(sum(w * x for w, x in cells) / sum(w for w, _ in cells))
    assert averaged(long) == pytest.approx(expected)


def test_window_end(spark):
    df = spark.createDataFrame([("a", i, float(i), float(-i)) for i in range(6)], "k string, i int, x double, y double")
    args = (df, ["x"], ["y"], ["k"], ["i"], "i")
    assert sorted(values(ordered.window_horizon(*args, window=2, horizon=1), "start")) == [0, 1, 2]
    last = ordered.window_horizon(*args, window=2, horizon=1, include_last=True)
    assert sorted(values(last, "start", "x_x", "y_y")) == [
        (i, [float(i), float(i + 1)], [float(-i - 1)]) for i in range(4)]


def test_bins_max(spark):
    df = spark.createDataFrame([(0.0,), (5.0,), (10.0,)], "v double")
    assert values(scaling.create_bins(df, "v", num_bins=5), "bin_index") == [1, 3, 6]
    flat = spark.createDataFrame([(2.0,), (2.0,)], "v double")
    assert values(scaling.create_bins(flat, "v", num_bins=3), "bin_index") == [4, 4]
    assert values(scaling.bin_edges(df, "v", num_bins=2).orderBy("edge"), "value") == [0.0, 5.0, 10.0]


def test_singleton_cluster(spark):
    df = spark.createDataFrame([([0.0], 0), ([1.0], 0), ([5.0], 1)], "v array<double>, l int")
    expected = ((5 - 1) / 5 + (4 - 1) / 4) / 2
    for distance in ("euclidean", "manhattan"):
        assert values(cluster.silhouette(df, "v", "l", distance), "score") == [pytest.approx(expected)]
    assert values(cluster.silhouette(df.where("l = 0"), "v", "l"), "score") == [0.0]
    assert values(cluster.dunn(df, "v", "l"), "score") == [4.0]
    assert values(cluster.dunn(df.where("l = 0"), "v", "l"), "score") == [0.0]


def test_mode_ties(spark):
    df = spark.createDataFrame([(1.0, "b"), (1.0, "b"), (3.0, "a"), (3.0, "a")], "v double, t string")
    rows = {r["column"]: r for r in profile.describe(df).collect()}
    assert rows["v"]["mode"] == 2.0 and rows["t"]["mode_text"] == "a" and rows["t"]["mean"] is None
    one = profile.moments(df, ["v"]).first()
    assert (one["mode"], one["mode_count"]) == (1.0, 2)


def test_zero_division(spark):
    df = spark.createDataFrame([(1, 0), (0, 0)], "y int, p int")
    row = scores.classification_scores(df, "y", "p").first()
    assert (row["accuracy"], row["precision"], row["recall"], row["f1"], row["roc_auc"]) == (0.5, 0.0, 0.0, 0.0, 0.5)


def test_null_safe_filters(spark):
    df = spark.createDataFrame([("a",), (None,), ("b",)], "x string")
    assert values(df.where(c.differs("x", "a")), "x") == [None, "b"]
    assert values(df.select(c.equals_flag("x", "a").alias("f")), "f") == [1, 0, 0]


def test_factorize_order_and_missing(spark):
    df = spark.createDataFrame([(1, "z"), (2, None), (3, "a"), (4, "z")], "i int, t string")
    assert values(encode.factorize(df, "i").orderBy("i"), "t") == [0, -1, 1, 0]


def test_text_steps(spark):
    df = spark.createDataFrame([("<br />I DONT know,\n  it's <b>fine</b>  &  cant",)], "t string")
    assert df.select(text.clean_text("t").alias("t")).first()[0] == "i do not know\n  its fine    cant"
    kept = text.clean_text("t", remove_punctuation=False)
    assert df.select(kept.alias("t")).first()[0] == "i do not know,\n  it is fine  &  cant"


def test_negative_values_stop_the_log_error(spark):
    df = spark.createDataFrame([(1.0, -0.5)], "y double, p double")
    with pytest.raises(Exception, match="negative value"):
        scores.regression_scores(df, "y", "p", 0).collect()


def test_impurity_method(spark):
    with pytest.raises(ValueError):
        profile.impurity(spark.range(3), "id", "other")


def test_key_copies_carry_no_sums(spark, monkeypatch):
    """Distinct keys are counted on rows without the metrics' values; before, all sums rode along."""
    plans, kept = [], resample.stored
    monkeypatch.setattr(resample, "stored", lambda df: plans.append(df._jdf.queryExecution().optimizedPlan().toString()) or kept(df))
    rows = [("g1", "l1", 1.0), ("g1", "l2", None), ("g2", "l2", 3.0), (None, "l2", 5.0)]
    frame = spark.createDataFrame(rows, "id_guest_anon string, id_listing_anon string, m_interactions double").withColumn(
        "ts_interaction_first", F.lit("2024-01-01 05:00:00").cast("timestamp_ntz"))
    totals = resample._bin_totals(frame, ["inquiry_rate", "listing_rate", "avg_engagement"], "D", None).first()
    assert (totals["n"], totals["s_avg_engagement"], totals["n_avg_engagement"]) == (4, 9.0, 3)
    assert (totals["d_inquiry_rate"], totals["d_listing_rate"]) == (2, 2)
    distinct = [line for line in plans[0].splitlines() if "Aggregate" in line and "kind" in line]
    assert distinct and not any("v_avg_engagement" in line for line in distinct)
