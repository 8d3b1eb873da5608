"""The forms for groups too large for one task give the same results as the simple ones."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.operators import encode, funnel, ordered, outliers, profile, ranking, spectral, splitting
from tidemark.operators.quantiles import quantiles
from tidemark.sources import funnel_tables

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture
def series(small_tasks):
    """Two series; one holds most of the rows."""
    rng = np.random.default_rng(4)
    rows = [("hot" if i % 10 else "cold", i, None if i % 17 == 5 else float(np.round(rng.normal(), 2)))
            for i in range(400)]
    return small_tasks.createDataFrame(rows, "k string, i int, v double")


def by_key(series):
    rows = sorted(series.collect(), key=lambda r: r["i"])
    return {k: [r for r in rows if r["k"] == k] for k in ("hot", "cold")}


@pytest.mark.parametrize("by", [[], ["k"]])
def test_quantiles(series, by):
    probabilities = [0.0, 0.1, 0.25, 0.5, 0.9, 1.0]
    for row in quantiles(series, "v", probabilities, by).collect():
        v = [r["v"] for r in series.collect() if r["v"] is not None and (not by or r["k"] == row["k"])]
        assert row["n"] == len(v)
        assert row["q"] == pytest.approx(list(np.quantile(v, probabilities)))


def test_quantiles_of_a_mass_of_equal_values(small_tasks):
    df = small_tasks.range(3000).select(F.when(F.col("id") % 3 == 0, 7.0).otherwise(F.col("id") * 0.5).alias("v"))
    v = [r[0] for r in df.collect()]
    assert quantiles(df, "v", [0.01, 0.3, 0.77]).first()["q"] == pytest.approx(list(np.quantile(v, [0.01, 0.3, 0.77])))


def test_quantiles_inside_narrow_brackets(spark):
    """One group beyond the size where brackets narrow, one below, a third of all values equal."""
    df = spark.range(300_000).select(
        F.when(F.col("id") % 100 == 0, "tiny").otherwise("hot").alias("k"),
        F.when(F.col("id") % 3 == 0, 0.5).otherwise(F.pmod(F.xxhash64("id"), F.lit(1_000_003)) / 1_000_003.0).alias("v"))
    probabilities = [0.05, 0.5, 0.95]
    plain = {r["k"]: r for r in quantiles(df, "v", probabilities, ["k"]).collect()}
    spark.conf.set("spark.tidemark.singleTaskRows", "7")
    split = {r["k"]: r for r in quantiles(df, "v", probabilities, ["k"]).collect()}
    spark.conf.unset("spark.tidemark.singleTaskRows")
    for k, row in plain.items():
        v = [r[0] for r in df.where(F.col("k") == k).select("v").collect()]
        assert row["q"] == pytest.approx(list(np.quantile(v, probabilities)))
        assert split[k]["q"] == pytest.approx(row["q"])


def test_running_sums(series):
    out = ranking.running_sums(series, ["k"], [F.col("i")], {"total": F.coalesce("v", F.lit(0.0))})
    got = {r["i"]: r["total"] for r in out.collect()}
    for rows in by_key(series).values():
        expected = np.cumsum([r["v"] or 0.0 for r in rows])
        assert [got[r["i"]] for r in rows] == pytest.approx(list(expected))


def test_positions_without_key(series):
    out = ranking.positions(series, [], [F.col("i").desc()], "p").collect()
    assert {r["i"]: r["p"] for r in out} == {i: 400 - i for i in range(400)}


def test_last_seen(series):
    got = {r["i"]: r["f"] for r in ranking.last_seen(series, ["k"], ["i"], F.col("v"), "f").collect()}
    for rows in by_key(series).values():
        last = None
        for r in rows:
            last = r["v"] if r["v"] is not None else last
            assert got[r["i"]] == last


@pytest.mark.parametrize("weights", [[1.0] * 5, [0.1, 0.2, 0.3, 0.4], None])
def test_moving_average(series, weights):
    out = ordered.moving_average(series, "v", ["k"], ["i"], weights, "m").collect()
    got = {r["i"]: r["m"] for r in out}
    for rows in by_key(series).values():
        w = weights or [1.0] * len(rows)
        first = -(len(w) // 2)
        for at, r in enumerate(rows):
            cells = [(w[j], rows[at + first + j]["v"]) for j in range(len(w)) if 0 <= at + first + j < len(rows)]
            cells = [(g, x) for g, x in cells if x is not None]
            assert got[r["i"]] == pytest.approx(sum(g * x for g, x in cells) / sum(g for g, _ in cells))


def test_window_horizon(series):
    out = ordered.window_horizon(series, ["v"], ["v"], ["k"], ["i"], "i", window=3, horizon=2, stride=2).collect()
    for k, rows in by_key(series).items():
        got = {r["start"]: r for r in out if r["k"] == k}
        starts = range(0, len(rows) - 3 - 2 - 1, 2)
        assert sorted(got) == list(starts)
        for s in starts:
            assert got[s]["x_v"] == [r["v"] for r in rows[s:s + 3]]
            assert got[s]["t_y"] == [r["i"] for r in rows[s + 3:s + 5]]


def test_neighbours(series, spark):
    done = outliers.impute_neighbours(series, "v", ["k"], ["i"], "m").collect()
    got = {r["i"]: r["m"] for r in done}
    v = [r["v"] for r in series.collect() if r["v"] is not None]
    a, b = np.quantile(v, [0.25, 0.75])
    for rows in by_key(series).values():
        for at, r in enumerate(rows):
            odd = r["v"] is None or not a - 1.5 * (b - a) <= r["v"] <= b + 1.5 * (b - a)
            if odd and 0 < at < len(rows) - 1:
                near = rows[at - 1]["v"], rows[at + 1]["v"]
                expected = None if None in near else sum(near) / 2
            else:
                expected = r["v"]
            assert got[r["i"]] == (pytest.approx(expected) if expected is not None else None)


@pytest.mark.parametrize("n", [36, 37, 64, 91])
def test_fourier_of_a_long_series(small_tasks, n):
    rng = np.random.default_rng(n)
    x = rng.normal(size=n)
    df = small_tasks.createDataFrame([("a", i, float(v)) for i, v in enumerate(x)], "k string, i int, v double")
    small_tasks.conf.set("spark.tidemark.singleTaskRows", "15")
    out = spectral.fft_spectrum(df, "v", ["k"], ["i"], fs=10.0).orderBy("bin").collect()
    expected = np.fft.fft(x)[: n // 2 if n % 2 == 0 else n // 2 + 1]
    assert [r["magnitude"] for r in out] == pytest.approx(list(np.abs(expected) * 2 / n), abs=1e-9)
    assert [r["frequency"] for r in out] == pytest.approx([10.0 * k / n for k in range(len(expected))])
    assert np.exp(1j * np.array([r["phase"] for r in out])) == pytest.approx(np.exp(1j * np.angle(expected)), abs=1e-6)


def test_codes(small_tasks):
    df = small_tasks.createDataFrame([(i, f"v{(i * 7) % 30:02d}") for i in range(60)], "i int, t string")
    rows = encode.label_encode(df, "t", "code").collect()
    assert all(r["code"] == int(r["t"][1:]) for r in rows)
    first = {}
    for i in range(60):
        first.setdefault((i * 7) % 30, len(first))
    coded = {r["i"]: r["t"] for r in encode.factorize(df, "i").collect()}
    assert coded == {i: first[(i * 7) % 30] for i in range(60)}


def test_roc(small_tasks):
    df = small_tasks.createDataFrame([(int(i % 3 == 0), (i * 37 % 101) / 100) for i in range(300)], "y int, p double")
    curve = sorted((r["fpr"], r["tpr"]) for r in ordered.roc_curve(df, "y", "p").collect())
    rows = df.collect()
    levels = sorted({r["p"] for r in rows}, reverse=True)
    pos, neg = sum(r["y"] for r in rows), sum(1 - r["y"] for r in rows)
    expected = [(0.0, 0.0)] + [
        (sum(1 - r["y"] for r in rows if r["p"] >= t) / neg, sum(r["y"] for r in rows if r["p"] >= t) / pos)
        for t in levels]
    assert np.array(curve) == pytest.approx(np.array(sorted(expected)))


def test_describe_is_the_same(spark, series):
    large = sorted(profile.describe(series).collect())
    spark.conf.unset("spark.tidemark.singleTaskRows")
    small = sorted(profile.describe(series).collect())
    for a, b in zip(large, small):
        assert [x for x in a if isinstance(x, str)] == [x for x in b if isinstance(x, str)]
        assert [x for x in a if isinstance(x, float)] == pytest.approx([x for x in b if isinstance(x, float)])


def test_exact_split(spark):
    df = spark.range(1000).select("id", F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id") % 7).alias("s"))
    out = splitting.train_test_split(df, ["id"], ["s"], 0.7, seed=3)
    assert out.count() == 1000 and out.select("id").distinct().count() == 1000
    sizes = out.groupBy("s").agg(F.count(F.lit(1)).alias("n"), F.sum((F.col("split") == "train").cast("int")).alias("t"))
    assert all(r["t"] == round(0.7 * r["n"]) for r in sizes.collect())
    again = splitting.train_test_split(df.repartition(3), ["id"], ["s"], 0.7, seed=3)
    assert sorted(out.collect()) == sorted(again.collect())
    everything = splitting.train_test_split(df, ["id"], [], 1.0)
    assert everything.where("split = 'test'").count() == 0


def test_large_dimensions_meet_contacts_shuffled_once(spark, monkeypatch):
    contacts = funnel_tables.contacts(spark, FOLDER).withColumn("id_host_anon", F.expr("if(m_guests = 2, null, id_host_anon)"))
    listings, users = funnel_tables.listings(spark, FOLDER), funnel_tables.users(spark, FOLDER)
    users = users.unionByName(users.where("id_user_anon IN ('S1', 'C1')").withColumn("country", F.lit("twice")))
    # One listing holds a third of all contacts.
    contacts = contacts.withColumn("id_listing_anon", F.expr("if(m_interactions % 3 = 0, '7', id_listing_anon)"))
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        simple = sorted(map(str, funnel.master(contacts, listings, users).collect()))
        monkeypatch.setattr(funnel, "BROADCAST_ROWS", 20)
        on_grid = funnel.master(contacts, listings, users)
        assert sorted(map(str, on_grid.collect())) == simple and len(simple) > 1000
        assert "twice" in {r["guest_country"] for r in on_grid.select("guest_country").distinct().collect()}
        # Each of the three dimensions is shuffled, and the contacts once.
        assert on_grid._jdf.queryExecution().optimizedPlan().toString().count("RepartitionByExpression") == 4
        sizes = on_grid.groupBy(F.spark_partition_id()).count().collect()
        assert len(sizes) == 64 and max(r["count"] for r in sizes) < len(simple) / 8
        # Dimensions that are large beside the contacts are joined one by one.
        monkeypatch.setattr(funnel, "COPIES_PER_CONTACT", 0)
        one_by_one = funnel.master(contacts, listings, users)
        assert "RepartitionByExpression" not in one_by_one._jdf.queryExecution().optimizedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)


def test_moments_cross_the_grid_as_spans(spark):
    """One timestamp of a kind is shuffled whole, before all were; missing ones, far ones and those around a
    change of the clock come back as they were."""
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Europe/Berlin")
    try:
        texts = ["2024-03-31 01:59:59.999999", "2024-03-31 03:00:00", "2024-10-27 02:30:00", "0001-01-03 00:00:00", "9999-12-30 12:00:00", None]
        pairs = [(a, b, "k") for a in texts for b in texts]
        rows = spark.createDataFrame(pairs, "a string, b string, k string")
        for kind in ("timestamp", "timestamp_ntz"):
            typed = rows.select(F.col("a").cast(kind), F.col("b").cast(kind), F.col("b").cast(kind).alias("c"), "k")
            spans, _ = funnel._as_spans(typed)
            assert [its for _, its in spans.dtypes].count(kind) == 1
            joined = funnel._join_on_grid(typed, {"k": spark.createDataFrame([("k", 7)], "k string, seven int")}, 2)
            assert joined.schema["b"].dataType == typed.schema["b"].dataType
            got, want = (sorted(map(str, x.select(*[F.col(c).cast("string") for c in "abc"]).collect())) for x in (joined, typed))
            assert got == want and joined.where("seven = 7").count() == len(pairs)
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
