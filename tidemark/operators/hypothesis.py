"""Feature tests against a class column."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.distributions import chi2_tail, f_tail
from .encode import sorted_codes
from .profile import numeric_columns, unpivoted
from .scaling import quantile_normal, standard_scale


def chi2_statistics(df: DataFrame, features: Sequence[str], target: str) -> DataFrame:
    """Per feature: sums of the (encoded) feature value by class against the sums expected from
    the class shares. Text features are encoded in sorted order. Columns feature, chi2, dof."""
    numbers = [f for f in features if f in numeric_columns(df)]
    texts = [f for f in features if f not in numbers]
    by_class = []
    if numbers:
        cells = unpivoted(df, numbers, [target])
        by_class.append(cells.groupBy("column", target).agg(F.sum("value").alias("observed")))
    if texts:
        # count each (feature, value, class) first: the codes join that small table only
        table = unpivoted(df, texts, [target], cast="string").groupBy("column", "value", target).agg(
            F.count(F.lit(1)).alias("n"))
        coded = table.join(sorted_codes(df, texts), ["column", "value"])
        by_class.append(coded.groupBy("column", target).agg(
            F.sum(F.col("code") * F.col("n")).cast("double").alias("observed")))
    observed = by_class[0] if len(by_class) == 1 else by_class[0].unionByName(by_class[1])
    total = df.agg(F.count(F.lit(1))).scalar()
    shares = df.groupBy(target).agg((F.count(F.lit(1)) / total).alias("share"))
    per_feature = Window.partitionBy("column")
    both = observed.join(shares, target).withColumn(
        "expected", F.sum("observed").over(per_feature) * F.col("share"))
    gap = F.col("observed") - F.col("expected")
    return both.groupBy(F.col("column").alias("feature")).agg(
        F.sum(F.try_divide(gap * gap, F.col("expected"))).alias("chi2"),
        (F.count(F.lit(1)) - 1).alias("dof"))


def chi2_test(df: DataFrame, features: Sequence[str], target: str, significance_level: float = 0.05,
              only_return_significant: bool = False) -> DataFrame:
    result = chi2_statistics(df, features, target).withColumn(
        "p_value", chi2_tail(F.col("chi2"), F.col("dof").cast("double")))
    return result.where(F.col("p_value") <= significance_level) if only_return_significant else result


def anova_statistics(df: DataFrame, features: Sequence[str], target: str,
                     quantile_normal_transform: bool = False, standardize: bool = False) -> DataFrame:
    """One-way F statistic of each feature. Columns feature, f, dof_between, dof_within."""
    if quantile_normal_transform:
        for f in features:
            df = quantile_normal(df, f)
    if standardize:
        df = standard_scale(df, features)
    cells = unpivoted(df, features, [target]).where(F.col("value").isNotNull())
    classes = cells.groupBy("column", target).agg(
        F.count("value").alias("n"), F.avg("value").alias("mean"), F.var_pop("value").alias("var"))
    per_feature = Window.partitionBy("column")
    grand = F.sum(F.col("n") * F.col("mean")).over(per_feature) / F.sum("n").over(per_feature)
    shift = F.col("mean") - F.col("grand")
    sums = classes.withColumn("grand", grand).groupBy("column").agg(
        F.sum(F.col("n") * shift * shift).alias("between"),
        F.sum(F.col("n") * F.col("var")).alias("within"),
        (F.count(F.lit(1)) - 1).alias("dof_between"),
        (F.sum("n") - F.count(F.lit(1))).alias("dof_within"))
    # one class, or one row in each, leaves F undefined
    mean_between = F.try_divide(F.col("between"), F.col("dof_between"))
    f = F.try_divide(mean_between, F.try_divide(F.col("within"), F.col("dof_within")))
    return sums.select(F.col("column").alias("feature"), f.alias("f"), "dof_between", "dof_within")


def anova_f_test(df: DataFrame, features: Sequence[str], target: str, quantile_normal_transform: bool = False,
                 standardize: bool = False, significance_level: float = 0.05,
                 only_return_significant: bool = False) -> DataFrame:
    stats = anova_statistics(df, features, target, quantile_normal_transform, standardize)
    result = stats.withColumn("p_value", f_tail(
        F.col("f"), F.col("dof_between").cast("double"), F.col("dof_within").cast("double")))
    return result.where(F.col("p_value") <= significance_level) if only_return_significant else result
