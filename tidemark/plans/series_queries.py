"""Queries over ordered series: windows, shares, curves, spectra."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.columns import calendar_bin
from ..operators import ordered, spectral
from ..sources.tables import table
from .registry import query, six


def _events(spark, folder):
    return table(spark, folder, "events").select("event_id", "event_type", "ts", "value")


_ORDER = ["ts", "event_id"]
_W = "PARTITION BY event_type ORDER BY ts, event_id"
_SKEWED = [0.1, 0.4, 0.3, 0.2]
_TERMS = [f"lag(value, {2 - i}) OVER s" if i < 2 else f"lead(value, {i - 2}) OVER s" for i in range(4)]


@query("moving_average", f"""SELECT event_id,
  avg(value) OVER (s ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING) AS odd_equal,
  avg(value) OVER (s ROWS BETWEEN 2 PRECEDING AND 1 FOLLOWING) AS even_equal,
  ({' + '.join(f'coalesce({w} * {t}, 0)' for w, t in zip(_SKEWED, _TERMS))})
    / ({' + '.join(f'CASE WHEN {t} IS NOT NULL THEN {w} ELSE 0 END' for w, t in zip(_SKEWED, _TERMS))}) AS weighted,
  avg(value) OVER (PARTITION BY event_type ORDER BY row ROWS BETWEEN n // 2 PRECEDING
    AND n // 2 - 1 + n % 2 FOLLOWING) AS whole
  FROM (SELECT *, count(*) OVER (PARTITION BY event_type) AS n, row_number() OVER ({_W}) AS row FROM events)
  WINDOW s AS ({_W})""", six("odd_equal", "even_equal", "weighted", "whole"))
def moving_average(spark, folder):
    rows = _events(spark, folder)
    for weights, name in (([1.0] * 5, "odd_equal"), ([1.0] * 4, "even_equal"), (_SKEWED, "weighted"), (None, "whole")):
        rows = ordered.moving_average(rows, "value", ["event_type"], _ORDER, weights, name)
    return rows.select("event_id", "odd_equal", "even_equal", "weighted", "whole")


_LONG = [1.0 + (j * j) % 7 for j in range(120)]


@query("moving_average_long", f"""WITH e AS (SELECT event_id, event_type, value, row_number() OVER ({_W}) AS r FROM events)
  SELECT a.event_id, sum(w * b.value) / sum(w) FILTER (b.value IS NOT NULL) AS weighted
  FROM e a JOIN (SELECT unnest(range(0, 120)) AS j, 1.0 + (j * j) % 7 AS w) ON true
  LEFT JOIN e b ON b.event_type = a.event_type AND b.r = a.r - 60 + j GROUP BY a.event_id""", six("weighted"))
def moving_average_long(spark, folder):
    """A hundred and twenty unequal weights, applied by block convolution."""
    return ordered.moving_average(_events(spark, folder), "value", ["event_type"], _ORDER, _LONG, "weighted").select("event_id", "weighted")


@query("window_horizon", f"""WITH r AS (SELECT event_type, ts, value, event_id, row_number() OVER ({_W}) - 1 AS i,
    count(*) OVER (PARTITION BY event_type) AS n FROM events)
  SELECT a.event_type, a.i AS start, 'x' AS role, CAST(b.i - a.i AS BIGINT) AS step, b.value, b.ts FROM r a JOIN r b
    ON a.event_type = b.event_type AND b.i BETWEEN a.i AND a.i + 3 WHERE a.i % 2 = 0 AND a.i < a.n - 4 - 2 - 1
  UNION ALL
  SELECT a.event_type, a.i, 'y', b.i - a.i - 4, b.value, b.ts FROM r a JOIN r b
    ON a.event_type = b.event_type AND b.i BETWEEN a.i + 4 AND a.i + 5 WHERE a.i % 2 = 0 AND a.i < a.n - 4 - 2 - 1""")
def window_horizon(spark, folder):
    """Autoregressive samples of each event series, one row per window cell."""
    samples = ordered.window_horizon(
        _events(spark, folder), ["value"], ["value"], ["event_type"], _ORDER, "ts", window=4, horizon=2, stride=2)
    sides = []
    for role in ("x", "y"):
        cells = F.posexplode(F.arrays_zip(F.col(f"{role}_value").alias("value"), F.col(f"t_{role}").alias("ts")))
        sides.append(samples.select("event_type", "start", F.lit(role).alias("role"), cells).select(
            "event_type", "start", "role", F.col("pos").cast("long").alias("step"), "col.value", "col.ts"))
    return sides[0].unionByName(sides[1])


@query("cumulative_share", """WITH v AS (SELECT i - 1 AS dimension, var_samp(x) AS variance FROM (
    SELECT unnest(embedding)::DOUBLE AS x, unnest(range(1, 65)) AS i FROM embeddings) GROUP BY 1)
  SELECT dimension, variance, sum(variance) OVER (ORDER BY variance DESC, dimension) / sum(variance) OVER () AS share
  FROM v""", six("variance", "share"))
def cumulative_share(spark, folder):
    """Share of the total variance held by the embedding dimensions, largest first."""
    cells = table(spark, folder, "embeddings").select(F.posexplode("embedding").alias("dimension", "x"))
    spread = cells.groupBy(F.col("dimension").cast("long").alias("dimension")).agg(
        F.var_samp(F.col("x").cast("double")).alias("variance"))
    return ordered.cumulative_share(spread, "variance", [F.col("variance").desc(), F.col("dimension")])


SCORED = "(SELECT doc_id, toxic AS y, (doc_id * 37 % 101) / 100.0::DOUBLE AS p FROM labels)"


def scored(spark, folder):
    """Labels with a made-up probability per document."""
    return table(spark, folder, "labels").select(
        "doc_id", F.col("toxic").alias("y"), ((F.col("doc_id") * 37 % 101) / F.lit(100.0)).alias("p"))


@query("roc_curve", f"""WITH g AS (SELECT p, count(*) FILTER (y = 1) AS a, count(*) FILTER (y <> 1) AS b
    FROM {SCORED} GROUP BY p)
  SELECT p AS threshold, sum(b) OVER w / sum(b) OVER () AS fpr, sum(a) OVER w / sum(a) OVER () AS tpr FROM g
    WINDOW w AS (ORDER BY p DESC)
  UNION ALL SELECT NULL, 0.0, 0.0""", six("threshold", "fpr", "tpr"))
def roc_curve(spark, folder):
    return ordered.roc_curve(scored(spark, folder), "y", "p")


_DAILY = "(SELECT event_type, date_trunc('day', ts) AS d, sum(value) AS v FROM events GROUP BY 1, 2)"


def _daily(spark, folder):
    events = table(spark, folder, "events")
    return events.groupBy("event_type", calendar_bin("ts", "D").alias("day")).agg(F.sum("value").alias("v"))


def _dft_sql(x: str) -> str:
    return f"""r AS (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY d) - 1 AS t,
    count(*) OVER (PARTITION BY event_type) AS n, avg(v) OVER (PARTITION BY event_type) AS m FROM {_DAILY}),
  f AS (SELECT a.event_type, a.n, b.t AS k, sum(({x}) * cos(2 * pi() * (a.t * b.t % a.n) / a.n)) AS re,
    -sum(({x}) * sin(2 * pi() * (a.t * b.t % a.n) / a.n)) AS im
    FROM r a JOIN r b ON a.event_type = b.event_type GROUP BY 1, 2, 3)"""


@query("fft_spectrum", f"""WITH {_dft_sql('a.v')}
  SELECT event_type, CAST(k AS BIGINT) AS bin, k * 1.0 / n AS frequency, sqrt(re * re + im * im) * 2 / n AS magnitude,
    CASE WHEN k = 0 THEN 0.0 ELSE atan2(im, re) END AS phase
  FROM f WHERE k < CASE WHEN n % 2 = 0 THEN n // 2 ELSE n // 2 + 1 END""",
       {"frequency": 6, "magnitude": 4, "phase": 6})
def fft_spectrum(spark, folder):
    """Spectrum of the daily event values of each type."""
    return spectral.fft_spectrum(_daily(spark, folder), "v", ["event_type"], ["day"])


_HANN = "(0.5 - 0.5 * cos(2 * pi() * {t} / {n}))"


@query("periodogram", f"""WITH {_dft_sql(f"(a.v - a.m) * {_HANN.format(t='a.t', n='a.n')}")},
  w AS (SELECT event_type, sum(pow({_HANN.format(t='t', n='n')}, 2)) AS w2 FROM r GROUP BY 1)
  SELECT event_type, CAST(k AS BIGINT) AS bin, k * 1.0 / n AS frequency,
    (re * re + im * im) / w2 * CASE WHEN k = 0 OR k * 2 = n THEN 1 ELSE 2 END AS power
  FROM f JOIN w USING (event_type) WHERE k * 2 <= n""", {"frequency": 6, "power": 3})
def periodogram(spark, folder):
    """Power density of the daily event values around their mean."""
    return spectral.periodogram(_daily(spark, folder), "v", ["event_type"], ["day"], detrend="constant")
