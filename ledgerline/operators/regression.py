"""Linear regression on several features per series, from one aggregate.

The sums of products of features and target are all that a fit needs, so map tasks
combine before the shuffle and a series of any length is one row of sums. The centred
moment matrix is factored into ``L D L'`` column by column with native expressions; its
solution gives the coefficients, and the same factors give the leverage of a new row.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import fixed_values as fixed

#: What is left of a feature's variation, below which it is a mixture of the features before it.
COLLINEAR = 1e-10


def _exact(name: str) -> Column:
    return F.col(name).cast("decimal(18,3)")


def fit(df: DataFrame, keys: Sequence[str], features: Sequence[str], target: str) -> DataFrame:
    """One row per key: n, coefficients by feature, intercept, sigma, and the factors that ``predict`` uses.

    Rows with a missing feature or target are left out. Sums are exact, of values rounded to three decimals. A series with no more rows
    than parameters, or with features that depend on each other linearly, has missing coefficients.
    """
    names = [*features, target]
    p = len(features)
    known = df.dropna(subset=names)
    sums = [F.sum(_exact(c)).cast("double").alias(f"_s{i}") for i, c in enumerate(names)]
    products = [
        F.sum((_exact(a) * _exact(b)).cast("decimal(38,6)")).cast("double").alias(f"_p{i}_{j}")
        for i, a in enumerate(names) for j, b in enumerate(names) if j <= i
    ]
    model = known.groupBy(*keys).agg(F.count("*").alias("n"), *sums, *products)
    n = F.col("n").cast("double")
    # centred moments: row and column p belong to the target
    moment = {f"_m{i}_{j}": F.col(f"_p{i}_{j}") - F.col(f"_s{i}") * F.col(f"_s{j}") / n for i in range(p + 1) for j in range(i + 1)}
    means = {f"_mean{i}": F.col(f"_s{i}") / n for i in range(p + 1)}
    model = model.select(*keys, "n", *(c.alias(k) for k, c in {**moment, **means}.items()))
    # the target is the last row of the factor, so its entries are the solution of the lower system
    for j in range(p):
        left = F.col(f"_m{j}_{j}") - sum((F.col(f"_l{j}_{k}") * F.col(f"_l{j}_{k}") * F.col(f"_d{k}") for k in range(j)), F.lit(0.0))
        model = model.withColumn(f"_d{j}", F.when(left > COLLINEAR * F.col(f"_m{j}_{j}"), left))
        entries = {}
        for i in range(j + 1, p + 1):
            rest = F.col(f"_m{i}_{j}") - sum((F.col(f"_l{i}_{k}") * F.col(f"_l{j}_{k}") * F.col(f"_d{k}") for k in range(j)), F.lit(0.0))
            entries[f"_l{i}_{j}"] = F.try_divide(rest, F.col(f"_d{j}"))
        model = model.withColumns(entries)
    spread = F.col(f"_m{p}_{p}") - sum((F.col(f"_l{p}_{k}") * F.col(f"_l{p}_{k}") * F.col(f"_d{k}") for k in range(p)), F.lit(0.0))
    free = F.when(n > p + 1, n - (p + 1))
    model = model.withColumn("sigma", F.sqrt(F.greatest(spread, F.lit(0.0)) / free))
    for j in reversed(range(p)):
        solved = F.col(f"_l{p}_{j}") - sum((F.col(f"_l{i}_{j}") * F.col(f"_b{i}") for i in range(j + 1, p)), F.lit(0.0))
        model = model.withColumn(f"_b{j}", solved)
    named = {f"coef_{c}": F.when(F.col("sigma").isNotNull(), F.col(f"_b{i}")) for i, c in enumerate(features)}
    intercept = F.col(f"_mean{p}") - sum((F.col(f"_b{i}") * F.col(f"_mean{i}") for i in range(p)), F.lit(0.0))
    factors = [f"_l{i}_{j}" for i in range(p) for j in range(i)] + [f"_d{j}" for j in range(p)] + [f"_mean{i}" for i in range(p + 1)]
    return model.withColumns(named).withColumn("intercept", F.when(F.col("sigma").isNotNull(), intercept)).select(
        *keys, "n", "intercept", *named, "sigma", *factors
    )


def predict(
    df: DataFrame, model: DataFrame, keys: Sequence[str], features: Sequence[str], z: float = fixed.CONFIDENCE_Z
) -> DataFrame:
    """``df`` with fitted, lower and upper: the value the model gives a row and the 95 % interval of a new observation.

    Missing where a feature or the model is.
    """
    p = len(features)
    of = model.withColumnsRenamed({k: f"_of_{k}" for k in keys})
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_of_{k}"))
    joined = df.join(of, same, "left")
    fitted = F.col("intercept") + sum((F.col(f"coef_{c}") * F.col(c).cast("double") for c in features), F.lit(0.0))
    for i, c in enumerate(features):
        apart = F.col(c).cast("double") - F.col(f"_mean{i}") - sum((F.col(f"_l{i}_{k}") * F.col(f"_z{k}") for k in range(i)), F.lit(0.0))
        joined = joined.withColumn(f"_z{i}", apart)
    leverage = 1 / F.col("n").cast("double") + sum((F.col(f"_z{i}") * F.col(f"_z{i}") / F.col(f"_d{i}") for i in range(p)), F.lit(0.0))
    margin = z * F.col("sigma") * F.sqrt(1 + leverage)
    return joined.withColumns({"fitted": fitted, "_margin": margin}).select(
        *df.columns, "fitted", (F.col("fitted") - F.col("_margin")).alias("lower"), (F.col("fitted") + F.col("_margin")).alias("upper")
    )
