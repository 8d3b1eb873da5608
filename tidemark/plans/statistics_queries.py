"""Queries for profiles, outliers, encoding, scaling, tests and splits."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import columns as c
from ..operators import encode, hypothesis, outliers, profile, scaling, splitting
from ..session import scratch_path, stored
from ..sources.sinks import write_split
from ..sources.tables import table
from .registry import query, six

NUMBERS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def _union(template: str, columns: list[str]) -> str:
    return " UNION ALL ".join(template.replace("{c}", name) for name in columns)


_SKEW = "skewness({c}) * (count({c}) - 2) / sqrt(count({c}) * (count({c}) - 1.0))"
_COUNTS = "(SELECT {c} AS v, count(*) AS k FROM {t} WHERE {c} IS NOT NULL GROUP BY {c})"
_TOP = f"SELECT v, k FROM {_COUNTS} QUALIFY k = max(k) OVER ()"


def _describe_sql(numbers: str, texts: str, n_cols: dict[str, str], t_cols: list[str], missing: dict[str, str],
                  others: dict[str, tuple[str, str]] | None = None) -> str:
    parts = []
    for name, dtype in n_cols.items():
        gone = missing.get(name, "")
        parts.append(f"""SELECT '{name}' AS "column", count({name}) AS "count", avg({name}) AS mean,
  stddev_samp({name}) AS std, CAST(min({name}) AS DOUBLE) AS min, quantile_cont({name}, 0.25) AS q25,
  quantile_cont({name}, 0.5) AS q50, quantile_cont({name}, 0.75) AS q75, CAST(max({name}) AS DOUBLE) AS max,
  (SELECT median(v) FROM ({_TOP.replace('{c}', name).replace('{t}', numbers)})) AS mode,
  CAST(NULL AS VARCHAR) AS mode_text,
  CASE WHEN count(DISTINCT {name}) > 1 THEN {_SKEW.replace('{c}', name)} END AS skew,
  '{dtype}' AS dtype, count(DISTINCT {name}) AS cardinality,
  count(*) FILTER ({name} IS NULL {gone}) AS missing FROM {numbers}""")
    for name in t_cols:
        gone = missing.get(name, "")
        parts.append(f"""SELECT '{name}', count({name}), NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL,
  (SELECT min(v) FROM ({_TOP.replace('{c}', name).replace('{t}', texts)})), NULL, 'string',
  count(DISTINCT {name}), count(*) FILTER ({name} IS NULL {gone}) FROM {texts}""")
    for name, (dtype, source) in (others or {}).items():
        parts.append(f"""SELECT '{name}', count({name}), NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL,
  (SELECT min(CAST(v AS VARCHAR)) FROM ({_TOP.replace('{c}', name).replace('{t}', source)})), NULL, '{dtype}',
  count(DISTINCT {name}), count(*) FILTER ({name} IS NULL) FROM {source}""")
    return " UNION ALL ".join(parts)


_DESCRIBED = six("mean", "std", "min", "q25", "q50", "q75", "max", "mode", "skew")


@query("describe", _describe_sql(
    "orders", "orders",
    {"o_orderkey": "bigint", "o_custkey": "bigint", "o_totalprice": "double"},
    ["o_orderstatus", "o_orderpriority"],
    {"o_orderpriority": "OR o_orderpriority = '4-NOT SPECIFIED'",
     **{name: f"OR {name} = 0" for name in ("o_orderkey", "o_custkey", "o_totalprice")}},
    {"o_orderdate": ("timestamp_ntz", "orders"),
     "is_open": ("boolean", "(SELECT CASE WHEN o_orderkey % 7 > 0 THEN o_orderstatus = 'O' END AS is_open FROM orders)")}),
    _DESCRIBED)
def describe(spark, folder):
    orders = table(spark, folder, "orders").withColumn(
        "is_open", F.when(F.col("o_orderkey") % 7 > 0, F.col("o_orderstatus") == "O"))
    return profile.describe(orders, ["4-NOT SPECIFIED", 0])


@query("moments", _union(f"""SELECT '{{c}}' AS "column", count({{c}}) AS n, avg({{c}}) AS mean, median({{c}}) AS median,
  (SELECT min(v) FROM ({_TOP.replace('{t}', 'lineitem')})) AS mode,
  (SELECT max(k) FROM {_COUNTS.replace('{t}', 'lineitem')}) AS mode_count,
  stddev_pop({{c}}) AS sdev, skewness({{c}}) AS skew, kurtosis({{c}}) AS kurtosis FROM lineitem""", NUMBERS),
       six("mean", "median", "mode", "sdev", "skew", "kurtosis"))
def moments(spark, folder):
    return profile.moments(table(spark, folder, "lineitem"), NUMBERS)


@query("iqr", _union("""SELECT '{c}' AS "column",
  quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25) AS iqr FROM lineitem""", NUMBERS), six("iqr"))
def iqr(spark, folder):
    return profile.iqr(table(spark, folder, "lineitem"), NUMBERS)


@query("skew_table", _union(f"""SELECT '{{c}}' AS "column", {_SKEW} AS skew FROM lineitem""", NUMBERS), six("skew"))
def skew_table(spark, folder):
    return profile.skew_table(table(spark, folder, "lineitem"), NUMBERS)


@query("typed_columns", """SELECT l_quantity, l_extendedprice, l_discount, l_tax, l_linenumber, l_orderkey,
  l_partkey, l_suppkey, l_linestatus AS target FROM lineitem""")
def typed_columns(spark, folder):
    """Numeric feature columns and one target, picked by type."""
    lines = table(spark, folder, "lineitem")
    numbers = profile.numeric_columns(lines)
    features, _ = profile.features_and_target(lines.select(*numbers, "l_linestatus"), "l_linestatus")
    return lines.select(*features.columns, F.col("l_linestatus").alias("target"))


@query("label_counts", """SELECT quality, count(*) AS n, count(*) * 100.0 / (SELECT count(*) FROM labels) AS percent
  FROM labels GROUP BY quality""", six("percent"))
def label_counts(spark, folder):
    return profile.label_counts(table(spark, folder, "labels"), "quality").withColumn(
        "percent", F.col("percent").cast("double"))


@query("distinct_values", "SELECT o_orderpriority, count(*) AS n FROM orders GROUP BY 1 ORDER BY 1")
def distinct_values(spark, folder):
    return profile.distinct_values(table(spark, folder, "orders"), "o_orderpriority")


_SHARES = "(SELECT count(*) * 1.0 / sum(count(*)) OVER () AS p FROM orders GROUP BY o_orderpriority)"


@query("impurity", f"""SELECT 'shannon' AS method, sum(-p * log2(p)) AS impurity FROM {_SHARES}
  UNION ALL SELECT 'gini', 1 - sum(p * p) FROM {_SHARES}""", six("impurity"))
def impurity(spark, folder):
    orders = table(spark, folder, "orders")
    both = [
        profile.impurity(orders, "o_orderpriority", m).select(F.lit(m).alias("method"), "impurity")
        for m in ("shannon", "gini")
    ]
    return both[0].unionByName(both[1])


def _gain_sql(method: str) -> str:
    form = {"shannon": "sum(-p * log2(p))", "gini": "1 - sum(p * p)"}[method]
    return f"""SELECT '{method}' AS method,
  (SELECT {form} FROM (SELECT count(*) * 1.0 / sum(count(*)) OVER () AS p FROM lineitem GROUP BY l_returnflag))
  - (SELECT sum(w * i) FROM (SELECT max(w) AS w, {form} AS i FROM (
      SELECT l_linestatus AS s, count(*) * 1.0 / sum(count(*)) OVER (PARTITION BY l_linestatus) AS p,
        sum(count(*)) OVER (PARTITION BY l_linestatus) * 1.0 / sum(count(*)) OVER () AS w
      FROM lineitem GROUP BY l_linestatus, l_returnflag) GROUP BY s)) AS info_gain"""


@query("info_gain", f"{_gain_sql('shannon')} UNION ALL {_gain_sql('gini')}", six("info_gain"))
def info_gain(spark, folder):
    lines = table(spark, folder, "lineitem")
    both = [
        profile.info_gain(lines, "l_linestatus", "l_returnflag", m).select(F.lit(m).alias("method"), "info_gain")
        for m in ("shannon", "gini")
    ]
    return both[0].unionByName(both[1])


_Q = "(SELECT quantile_cont({c}, {lo}) AS a, quantile_cont({c}, {hi}) AS b, median({c}) AS m, avg({c}) AS mean FROM {t})"


def _q(column: str, relation: str, lo: float = 0.25, hi: float = 0.75) -> str:
    return _Q.format(c=column, t=relation, lo=lo, hi=hi)


@query("outliers", f"""SELECT o_orderkey, o_totalprice, r - 1 AS "row" FROM
  (SELECT *, row_number() OVER (ORDER BY o_orderkey) AS r FROM orders), {_q('o_totalprice', 'orders', 0.1, 0.3)}
  WHERE o_totalprice < a - 1.5 * (b - a) OR o_totalprice > b + 1.5 * (b - a)""")
def outlier_rows(spark, folder):
    orders = table(spark, folder, "orders").select("o_orderkey", "o_totalprice")
    return outliers.outliers(orders, "o_totalprice", ["o_orderkey"], span=(0.1, 0.3))


@query("treat_outliers", f"""SELECT event_id,
  CASE WHEN value < lo OR value > hi THEN m + sign(value) * (b - a) ELSE value END AS clipped,
  CASE WHEN value < lo OR value > hi THEN m ELSE value END AS by_median,
  CASE WHEN value < lo OR value > hi THEN mean ELSE value END AS by_mean
  FROM events, (SELECT *, a - 0.5 * (b - a) AS lo, b + 0.5 * (b - a) AS hi FROM {_q('value', 'events')})""",
       six("clipped", "by_median", "by_mean"))
def treat_outliers(spark, folder):
    events = table(spark, folder, "events").select("event_id", "value")
    out = events
    for method, name in (("clip", "clipped"), ("median", "by_median"), ("mean", "by_mean")):
        out = outliers.treat_outliers(out, "value", method, scale=0.5, name=name, fit=events)
    return out.drop("value")


@query("iqr_impute_median", f"""SELECT event_id,
  CASE WHEN value BETWEEN a - 1.5 * (b - a) AND b + 1.5 * (b - a) THEN value ELSE m END AS treated
  FROM events, {_q('value', 'events')}""", six("treated"))
def iqr_impute_median(spark, folder):
    events = table(spark, folder, "events").select("event_id", "value")
    return outliers.impute_median(events, "value", "treated").drop("value")


@query("iqr_impute_neighbours", f"""WITH w AS (SELECT event_id, event_type, value,
  lag(value) OVER s AS p, lead(value) OVER s AS n FROM events WINDOW s AS (PARTITION BY event_type ORDER BY ts, event_id))
  SELECT event_id, event_type, CASE WHEN NOT coalesce(value BETWEEN a - 1.5 * (b - a) AND b + 1.5 * (b - a), false)
    AND p IS NOT NULL AND n IS NOT NULL THEN (p + n) / 2 ELSE value END AS treated
  FROM w, {_q('value', 'events')}""", six("treated"))
def iqr_impute_neighbours(spark, folder):
    events = table(spark, folder, "events").select("event_id", "event_type", "ts", "value")
    done = outliers.impute_neighbours(events, "value", ["event_type"], ["ts", "event_id"], "treated")
    return done.select("event_id", "event_type", "treated")


@query("outliers_to_ffill", f"""WITH f AS (SELECT event_id, event_type, ts,
  CASE WHEN value < a - 0.1 * (b - a) OR value > b + 0.1 * (b - a) THEN NULL ELSE value END AS kept
  FROM events, {_q('value', 'events', 0.05, 0.8)})
  SELECT event_id, last_value(kept IGNORE NULLS) OVER (PARTITION BY event_type ORDER BY ts, event_id
    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS filled FROM f""")
def outliers_to_ffill(spark, folder):
    events = table(spark, folder, "events").select("event_id", "event_type", "ts", "value")
    done = outliers.outliers_to_ffill(
        events, "value", ["event_type"], ["ts", "event_id"], span=(0.05, 0.8), scale=0.1, name="filled")
    return done.select("event_id", "filled")


_SPREAD = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_partkey", "l_suppkey"]


@query("topk_outlier_columns", "SELECT * FROM (" + _union(f"""SELECT '{{c}}' AS "column",
  count(*) FILTER ({{c}} < a - 0.1 * (b - a) OR {{c}} > b + 0.1 * (b - a)) AS n_outliers
  FROM lineitem, {_q('{c}', 'lineitem', 0.1, 0.8)}""", _SPREAD) + ') ORDER BY n_outliers DESC, "column" LIMIT 4')
def topk_outlier_columns(spark, folder):
    return outliers.topk_outlier_columns(table(spark, folder, "lineitem"), _SPREAD, 4, span=(0.1, 0.8), scale=0.1)


@query("log_transform", """SELECT event_id, ln(value - (SELECT min(value) FROM events) + 1) AS x FROM events""", six("x"))
def log_transform(spark, folder):
    events = table(spark, folder, "events").select("event_id", "value")
    return scaling.log_transform(events, "value", name="x").drop("value")


@query("sqrt_transform", """SELECT event_id, sqrt(value + greatest(1e-10, (SELECT min(value) FROM events))) AS x
  FROM events""", six("x"))
def sqrt_transform(spark, folder):
    events = table(spark, folder, "events").select("event_id", "value")
    return scaling.sqrt_transform(events, "value", name="x").drop("value")


def _bin_sql(k: str) -> str:
    return f"""CAST(CASE WHEN value >= hi THEN k_{k} + 1
      ELSE floor((value - lo) * k_{k} / (hi - lo)) + 1 END AS BIGINT) AS {k}"""


@query("create_bins", f"""SELECT event_id, {_bin_sql('sturges')}, {_bin_sql('freedman')}, {_bin_sql('root')},
  {_bin_sql('five')} FROM events, (SELECT min(value) AS lo, max(value) AS hi,
    floor(1 + sqrt(count(value))) AS k_sturges, floor(sqrt(count(value))) AS k_root, 5 AS k_five,
    floor((max(value) - min(value)) / (2 * (quantile_cont(value, 0.75) - quantile_cont(value, 0.25))
      / pow(count(value), 1 / 3.0))) AS k_freedman FROM events)""")
def create_bins(spark, folder):
    events = table(spark, folder, "events").select("event_id", "value")
    out = events
    for method, name in (("sturges", "sturges"), ("freedman_diaconis", "freedman"), ("sqrt", "root")):
        out = scaling.create_bins(out, "value", method, name=name, fit=events)
    return scaling.create_bins(out, "value", num_bins=5, name="five", fit=events).drop("value")


@query("polynomial", """SELECT event_id, 2.0 - 0.5 * value + 0.01 * value * value AS with_constant,
  0.25 * value - 0.002 * value * value AS without_constant FROM events""", six("with_constant", "without_constant"))
def polynomial(spark, folder):
    return table(spark, folder, "events").select(
        "event_id", c.polynomial("value", [2.0, -0.5, 0.01]).alias("with_constant"),
        c.polynomial("value", [0.25, -0.002], zero_order=False).alias("without_constant"))


@query("sign", "SELECT c_custkey, CAST(sign(c_acctbal) AS DOUBLE) AS sign FROM customer")
def sign(spark, folder):
    return table(spark, folder, "customer").select("c_custkey", c.sign("c_acctbal").alias("sign"))


def _chi2_sql(features: dict[str, str]) -> str:
    parts = []
    for name, code in features.items():
        parts.append(f"""SELECT '{name}' AS feature, sum(pow(o - e, 2) / e) AS chi2, count(*) - 1 AS dof FROM (
  SELECT sum(x) AS o, sum(sum(x)) OVER () * count(*) / sum(count(*)) OVER () AS e
  FROM (SELECT {code} AS x, o_orderstatus AS y FROM orders) GROUP BY y)""")
    return " UNION ALL ".join(parts)


@query("chi2_test", _chi2_sql({
    "o_orderpriority": "dense_rank() OVER (ORDER BY o_orderpriority) - 1", "o_custkey": "o_custkey"}), six("chi2"))
def chi2_test(spark, folder):
    return hypothesis.chi2_statistics(
        table(spark, folder, "orders"), ["o_orderpriority", "o_custkey"], "o_orderstatus")


# With two degrees of freedom both tails have a closed form.
@query("chi2_test_p_values", f"""SELECT *, exp(-chi2 / 2) AS p_value FROM ({_chi2_sql({
    "o_orderpriority": "dense_rank() OVER (ORDER BY o_orderpriority) - 1", "o_custkey": "o_custkey"})})""",
       six("chi2", "p_value"))
def chi2_test_p_values(spark, folder):
    return hypothesis.chi2_test(table(spark, folder, "orders"), ["o_orderpriority", "o_custkey"], "o_orderstatus")


_ANOVA_SQL = _union("""SELECT '{c}' AS feature,
  (sum(n * pow(m - g, 2)) / (count(*) - 1)) / (sum(n * v) / (sum(n) - count(*))) AS f,
  count(*) - 1 AS dof_between, CAST(sum(n) - count(*) AS BIGINT) AS dof_within
  FROM (SELECT count({c}) AS n, avg({c}) AS m, var_pop({c}) AS v FROM lineitem GROUP BY l_returnflag),
    (SELECT avg({c}) AS g FROM lineitem)""", NUMBERS)


@query("anova_f_test", _ANOVA_SQL, six("f"))
def anova_f_test(spark, folder):
    return hypothesis.anova_statistics(table(spark, folder, "lineitem"), NUMBERS, "l_returnflag")


@query("anova_f_test_p_values", f"""SELECT *, pow(1 + 2 * f / dof_within, -dof_within / 2.0) AS p_value
  FROM ({_ANOVA_SQL})""", six("f", "p_value"))
def anova_f_test_p_values(spark, folder):
    """Standardising first does not change F."""
    return hypothesis.anova_f_test(table(spark, folder, "lineitem"), NUMBERS, "l_returnflag", standardize=True)


@query("anova_f_test_normal")
def anova_f_test_normal(spark, folder):
    """After a map to normal scores."""
    return hypothesis.anova_f_test(
        table(spark, folder, "lineitem"), NUMBERS, "l_returnflag", quantile_normal_transform=True, standardize=True)


@query("quantile_normal")
def quantile_normal(spark, folder):
    events = table(spark, folder, "events").select("event_id", "value")
    return scaling.quantile_normal(events, "value", "score")


@query("label_encode", """SELECT o_orderkey, CAST(dense_rank() OVER (ORDER BY o_orderpriority) - 1 AS INTEGER) AS code
  FROM orders""")
def label_encode(spark, folder):
    orders = table(spark, folder, "orders").select("o_orderkey", "o_orderpriority")
    return encode.label_encode(orders, "o_orderpriority", "code").drop("o_orderpriority")


def _first_seen_sql(column: str) -> str:
    return f"""SELECT {column} AS v, row_number() OVER (ORDER BY f, {column}) - 1 AS code
  FROM (SELECT {column}, min(o_orderkey) AS f FROM orders_n WHERE {column} IS NOT NULL GROUP BY 1)"""


@query("factorize", f"""WITH orders_n AS (SELECT o_orderkey, o_orderstatus,
    nullif(o_orderpriority, '5-LOW') AS o_orderpriority FROM orders)
  SELECT o_orderkey, CAST(coalesce(a.code, -1) AS INTEGER) AS o_orderstatus,
    CAST(coalesce(b.code, -1) AS INTEGER) AS o_orderpriority FROM orders_n o
  LEFT JOIN ({_first_seen_sql('o_orderstatus')}) a ON o.o_orderstatus = a.v
  LEFT JOIN ({_first_seen_sql('o_orderpriority')}) b ON o.o_orderpriority = b.v""")
def factorize(spark, folder):
    priority = F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderpriority"))
    orders = table(spark, folder, "orders").select(
        "o_orderkey", "o_orderstatus", priority.alias("o_orderpriority"))
    return encode.factorize(orders, "o_orderkey")


@query("one_hot_drop_first", """SELECT o_orderkey, CAST(o_orderstatus = 'O' AS INTEGER) AS "o_orderstatus_O",
  CAST(o_orderstatus = 'P' AS INTEGER) AS "o_orderstatus_P" FROM orders""")
def one_hot_drop_first(spark, folder):
    orders = table(spark, folder, "orders").select("o_orderkey", "o_orderstatus")
    return encode.one_hot_drop_first(orders, "o_orderstatus")


_NAMES = """SELECT o_orderkey, CASE WHEN o_orderkey % 7 <> 0 THEN 'customer ' || o_custkey END AS name FROM orders"""


def _named_orders(spark, folder):
    """Orders with their customer's name, of which a seventh is missing."""
    name = F.when(F.col("o_orderkey") % 7 != 0, F.concat(F.lit("customer "), F.col("o_custkey")))
    return table(spark, folder, "orders").select("o_orderkey", name.alias("name"))


@query("one_hot_sparse", f"""WITH n AS ({_NAMES}), c AS (SELECT name, row_number() OVER (ORDER BY name) - 1 AS code
    FROM (SELECT DISTINCT name FROM n WHERE name IS NOT NULL))
  SELECT o_orderkey, CASE WHEN code IS NOT NULL THEN (SELECT count(*) - 1 FROM c) END AS size,
    CASE WHEN code > 0 THEN CAST(code - 1 AS INTEGER) END AS place FROM n LEFT JOIN c USING (name)""")
def one_hot_sparse(spark, folder):
    """Indicators of as many levels as there are customers, as sparse vectors."""
    orders = _named_orders(spark, folder)
    codes = stored(encode.sorted_codes(orders, ["name"]))
    found = encode.one_hot_sparse(orders, "name", codes, "vector")
    return found.select("o_orderkey", F.col("vector.size").alias("size"), F.get(F.col("vector.indices"), F.lit(0)).alias("place"))


@query("one_hot_sparse_inverse", _NAMES)
def one_hot_sparse_inverse(spark, folder):
    """The names, back from their sparse vectors."""
    orders = _named_orders(spark, folder)
    codes = stored(encode.sorted_codes(orders, ["name"]))
    found = encode.one_hot_sparse(orders, "name", codes, "vector").drop("name")
    return encode.one_hot_sparse_inverse(found, "vector", "name", codes, "name").drop("vector")


@query("label_decode", "SELECT o_orderkey, o_orderpriority AS priority FROM orders")
def label_decode(spark, folder):
    """The priorities, back from their codes."""
    orders = table(spark, folder, "orders").select("o_orderkey", "o_orderpriority")
    coded = encode.label_encode(orders, "o_orderpriority", "code").drop("o_orderpriority")
    return encode.label_decode(coded, "code", encode.sorted_codes(orders, ["o_orderpriority"]), "priority").drop("code")


@query("one_hot_inverse", "SELECT o_orderkey, o_orderstatus FROM orders")
def one_hot_inverse(spark, folder):
    """The status, back from its indicator columns."""
    orders = table(spark, folder, "orders").select("o_orderkey", "o_orderstatus")
    levels = ["F", "O", "P"]
    coded = encode.one_hot_drop_first(orders, "o_orderstatus", levels)
    return encode.one_hot_inverse(coded, "o_orderstatus", levels).select("o_orderkey", "o_orderstatus")


_TRAIN = "l_linestatus = 'F'"


@query("standard_scale", "SELECT l_orderkey, l_linenumber, " + ", ".join(
    f"(t.{n} - p.m_{n}) / p.s_{n} AS {n}" for n in NUMBERS) + " FROM lineitem t, (SELECT " + ", ".join(
    f"avg({n}) AS m_{n}, stddev_pop({n}) AS s_{n}" for n in NUMBERS) + f" FROM lineitem WHERE {_TRAIN}) p",
       six(*NUMBERS))
def standard_scale(spark, folder):
    """Scaled by the mean and deviation of the training rows."""
    lines = table(spark, folder, "lineitem")
    parameters = scaling.standard_parameters(lines.where(_TRAIN), NUMBERS)
    return scaling.scale(lines.select("l_orderkey", "l_linenumber", *NUMBERS), parameters)


@query("transform_inverse", f"""SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice,
  (l_quantity - m) / s AS z FROM lineitem, (SELECT avg(l_quantity) AS m, stddev_pop(l_quantity) AS s
  FROM lineitem WHERE {_TRAIN})""", six("l_quantity", "l_extendedprice", "z"))
def transform_inverse(spark, folder):
    """Scaled and scaled back; the scaled quantity is kept beside."""
    lines = table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_linestatus", "l_quantity",
                                                    "l_extendedprice")
    parameters = scaling.standard_parameters(lines.where(_TRAIN), ["l_quantity", "l_extendedprice"])
    forward = scaling.scale(lines, parameters).withColumn("z", F.col("l_quantity"))
    return scaling.unscale(forward, parameters).drop("l_linestatus")


VOXELS = """(SELECT l_orderkey % 20 AS subject, l_linenumber % 4 AS modality, l_partkey % 16 AS x,
  l_suppkey % 16 AS y, l_orderkey % 16 AS z, l_extendedprice AS value,
  CAST(l_returnflag = 'A' AS INTEGER) AS label, CAST(l_linestatus = 'F' AS INTEGER) AS predicted FROM lineitem)"""


def voxels(spark, folder):
    """Stand-in voxel table derived from the order lines."""
    return table(spark, folder, "lineitem").select(
        (F.col("l_orderkey") % 20).alias("subject"), (F.col("l_linenumber") % 4).alias("modality"),
        (F.col("l_partkey") % 16).alias("x"), (F.col("l_suppkey") % 16).alias("y"),
        (F.col("l_orderkey") % 16).alias("z"), F.col("l_extendedprice").alias("value"),
        (F.col("l_returnflag") == "A").cast("int").alias("label"),
        (F.col("l_linestatus") == "F").cast("int").alias("predicted"))


@query("minmax_scale", f"""SELECT subject, modality, x, y, z, value, (value - lo) / (hi - lo) AS scaled
  FROM {VOXELS} JOIN (SELECT subject, modality, min(value) AS lo, max(value) AS hi FROM {VOXELS}
  GROUP BY 1, 2) USING (subject, modality)""", six("scaled"))
def minmax_scale(spark, folder):
    scaled = scaling.minmax_by_group(voxels(spark, folder), ["subject", "modality"], "value", "scaled")
    return scaled.select("subject", "modality", "x", "y", "z", "value", "scaled")


@query("volume_slice", f"SELECT subject, x, y, value, label FROM {VOXELS} WHERE modality = 2 AND z = 7")
def volume_slice(spark, folder):
    from ..operators.volumes import volume_slice as cut
    return cut(voxels(spark, folder), modality=2, axis="z", position=7).select("subject", "x", "y", "value", "label")


_SPLIT_COUNTS = """WITH s AS (SELECT o_orderstatus, o_orderpriority, count(*) AS n FROM orders GROUP BY 1, 2),
  t AS (SELECT *, CAST(round_even(n * 0.8, 0) AS BIGINT) AS k FROM s)
  SELECT o_orderstatus, o_orderpriority, 'train' AS split, k AS n FROM t WHERE k > 0
  UNION ALL SELECT o_orderstatus, o_orderpriority, 'test', n - k FROM t WHERE n > k"""
_STRATA = ["o_orderstatus", "o_orderpriority"]


@query("train_test_split", _SPLIT_COUNTS)
def train_test_split(spark, folder):
    """Rows of each split in each stratum."""
    split = splitting.train_test_split(table(spark, folder, "orders"), ["o_orderkey"], _STRATA, seed=7)
    return split.groupBy(*_STRATA, "split").agg(F.count(F.lit(1)).alias("n"))


@query("sink_split", _SPLIT_COUNTS)
def sink_split(spark, folder):
    """The split tables written by split and read back."""
    path = scratch_path(spark, "orders_split")
    write_split(splitting.train_test_split(table(spark, folder, "orders"), ["o_orderkey"], _STRATA, seed=7), path)
    return spark.read.parquet(path).groupBy(*_STRATA, "split").agg(F.count(F.lit(1)).alias("n"))


@query("sample_per_label")
def sample_per_label(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "text")
    labelled = docs.join(table(spark, folder, "labels"), "doc_id")
    return splitting.sample_per_label(labelled, "quality", ["doc_id"], 4, seed=11)


@query("cov_matrix", " UNION ALL ".join(
    f"SELECT '{a}' AS row_name, '{b}' AS column_name, covar_samp({a}, {b}) AS covariance FROM lineitem"
    for a in NUMBERS for b in NUMBERS), {"covariance": 4})
def cov_matrix(spark, folder):
    from ..operators.decompose import covariance_table
    return covariance_table(table(spark, folder, "lineitem"), NUMBERS)
