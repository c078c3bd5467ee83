"""Polynomial fits of churn rate against a numeric attribute.

The points are aggregated rows (one per value or bucket), so the fit is small;
it still runs through MLlib (``PolynomialExpansion`` + ``LinearRegression`` with
the normal-equation solver, no regularisation) so nothing leaves Spark. x is
scaled to [-1, 1] for conditioning. R^2 is computed by an aggregate with the
least-squares definition (weighted when a weight column is given).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.feature import PolynomialExpansion, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import LinearRegression
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass
class PolyFit:
    model: object
    degree: int
    lo: float
    hi: float
    x: str

    def _scaled(self, df: DataFrame, x: str) -> DataFrame:
        mid, half = (self.hi + self.lo) / 2.0, (self.hi - self.lo) / 2.0 or 1.0
        v = VectorAssembler(inputCols=["_xs"], outputCol="_xv").transform(
            df.withColumn("_xs", (F.col(x).cast("double") - F.lit(mid)) / F.lit(half)))
        return PolynomialExpansion(degree=self.degree, inputCol="_xv", outputCol="_features").transform(v)

    def predict(self, df: DataFrame, x: str | None = None, out: str = "prediction") -> DataFrame:
        p = self.model.transform(self._scaled(df, x or self.x))
        return p.withColumnRenamed("prediction", out).drop("_xs", "_xv", "_features")


def poly_fit(points: DataFrame, x: str, y: str, degree: int, weight: str | None = None) -> PolyFit:
    """Least-squares polynomial of ``degree`` through the points (weighted by ``weight``)."""
    lo, hi = points.agg(F.min(x).cast("double"), F.max(x).cast("double")).first()
    fit = PolyFit(None, degree, float(lo), float(hi), x)
    data = fit._scaled(points.where(F.col(x).isNotNull() & F.col(y).isNotNull()), x)
    lr = LinearRegression(featuresCol="_features", labelCol=y, solver="normal", regParam=0.0,
                          elasticNetParam=0.0, standardization=False, fitIntercept=True)
    if weight:
        lr = lr.setWeightCol(weight)
    fit.model = lr.fit(data)
    return fit


def r_squared(pred: DataFrame, y: str, p: str = "prediction", weight: str | None = None) -> DataFrame:
    """1 - SS_res / SS_tot (weighted), one aggregate."""
    w = F.col(weight).cast("double") if weight else F.lit(1.0)
    ybar = F.try_divide(F.sum(w * F.col(y)), F.sum(w))
    s = pred.agg(ybar.alias("_ybar"))
    j = pred.withColumn("_ybar", s.scalar())
    return j.agg((F.lit(1.0) - F.try_divide(F.sum(w * (F.col(y) - F.col(p)) ** 2),
                                             F.sum(w * (F.col(y) - F.col("_ybar")) ** 2))).alias("r2"))


def fit_summary(points: DataFrame, x: str, y: str, degree: int, weight: str | None = None) -> DataFrame:
    """One row: degree, points, R^2, intercept and coefficients (x scaled to [-1, 1]). With no more
    points than the degree nothing is determined: R^2 and the coefficients are null."""
    n = points.where(F.col(x).isNotNull() & F.col(y).isNotNull()).count()
    if n <= degree:
        return points.sparkSession.createDataFrame(
            [(degree, n, None, None, None, None, None)],
            "degree int, n_points long, r2 double, intercept double, coefficients array<double>, x_min double, x_max double")
    f = poly_fit(points, x, y, degree, weight)
    r2 = r_squared(f.predict(points), y, weight=weight)
    coef = [float(c) for c in f.model.coefficients]
    return r2.select(F.lit(degree).alias("degree"), F.lit(n).cast("long").alias("n_points"), "r2",
                     F.lit(float(f.model.intercept)).alias("intercept"),
                     F.array(*[F.lit(c) for c in coef]).alias("coefficients"),
                     F.lit(f.lo).alias("x_min"), F.lit(f.hi).alias("x_max"))


def normal_equations(points: DataFrame, x: str, y: str, degree: int, weight: str | None = None) -> DataFrame:
    """One row per power k of x from 0 to ``degree``: |sum w r x^k| over sum w |y x^k|, r being the
    residual of the fit. A least-squares solution has 0 in each. One aggregate."""
    f = poly_fit(points, x, y, degree, weight)
    w = F.col(weight).cast("double") if weight else F.lit(1.0)
    mid, half = (f.hi + f.lo) / 2.0, (f.hi - f.lo) / 2.0 or 1.0
    used = f.predict(points.where(F.col(x).isNotNull() & F.col(y).isNotNull()))
    power = lambda k: F.pow((F.col(x).cast("double") - F.lit(mid)) / F.lit(half), F.lit(k))
    sums = used.agg(F.count(F.lit(1)).alias("n_points"), F.sum(w).alias("weight"), *[
        F.try_divide(F.abs(F.sum(w * (F.col(y) - F.col("prediction")) * power(k))), F.sum(w * F.abs(F.col(y) * power(k)))).alias(f"k{k}")
        for k in range(degree + 1)])
    return sums.select("n_points", "weight", F.posexplode(F.array(*[f"k{k}" for k in range(degree + 1)])).alias("power", "residual"))


def poly_curve(spark: SparkSession, fit: PolyFit, n: int = 500, points=(-117.0, -110.0),
               segment=(-123.0, -110.0)) -> DataFrame:
    """Predictions on ``n`` evenly spaced x over the fitted range, the marked
    single points, and a segment label around ``segment``."""
    step = (fit.hi - fit.lo) / max(n - 1, 1)
    grid = spark.range(n).select((F.lit(fit.lo) + F.col("id") * F.lit(step)).alias("x"), F.lit("grid").alias("kind"))
    marks = spark.createDataFrame([(float(p), "point") for p in points], "x double, kind string")
    lo, hi = segment
    seg = F.when(F.col("x") < lo, "before").when(F.col("x") <= hi, "elbow").otherwise("after")
    return fit.predict(grid.unionByName(marks), "x").withColumn("segment", seg)


__all__ = ["PolyFit", "poly_fit", "r_squared", "fit_summary", "normal_equations", "poly_curve", "vector_to_array"]
