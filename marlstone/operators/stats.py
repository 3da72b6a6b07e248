"""Polynomial least squares, model selection, diagnostics, intervals and rejection sampling.

A fit is two aggregates over the rows: means and deviations of the terms, then the Gram matrix of
the standardised terms. The driver solves a system of about ten unknowns; predictions, leverages
and distances are column expressions with the solved numbers as literals.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from marlstone.functions import features as X
from marlstone.functions import numerics
from marlstone.operators.scale import exact_quantiles, number_rows

Terms = list[tuple[str, Column]]


@dataclass
class Fit:
    """A fitted linear model; ``z`` quantities are in standardised terms."""

    name: str
    terms: Terms
    n: int
    means: np.ndarray
    scales: np.ndarray
    z_coefficients: np.ndarray
    z_inverse: np.ndarray
    rss: float
    tss: float

    @property
    def k(self) -> int:
        return len(self.terms)

    @property
    def labels(self) -> list[str]:
        return [label for label, _ in self.terms]

    @property
    def _back(self) -> np.ndarray:
        """Matrix from standardised to original coefficients."""
        back = np.diag(np.concatenate([[1.0], 1.0 / self.scales]))
        back[0, 1:] = -self.means / self.scales
        return back

    @property
    def coefficients(self) -> np.ndarray:
        return self._back @ self.z_coefficients

    @property
    def inverse(self) -> np.ndarray:
        """Inverse of X'X in the original terms."""
        return self._back @ self.z_inverse @ self._back.T

    @property
    def gram(self) -> np.ndarray:
        """X'X in the original terms."""
        forward = np.linalg.inv(self._back)
        return forward.T @ np.linalg.inv(self.z_inverse) @ forward

    @property
    def sigma2(self) -> float:
        return self.rss / (self.n - self.k)

    def _z(self) -> list[Column]:
        scaled = [(c - float(m)) / float(s) for (_, c), m, s in zip(self.terms[1:], self.means, self.scales)]
        return [F.lit(1.0), *scaled]

    def predict(self) -> Column:
        return reduce(lambda a, b: a + b, [z * float(g) for z, g in zip(self._z(), self.z_coefficients)])

    def leverage(self) -> Column:
        z = self._z()
        parts = [
            z[i] * z[j] * float(self.z_inverse[i, j] * (1 if i == j else 2))
            for i in range(self.k) for j in range(i, self.k)
        ]
        return reduce(lambda a, b: a + b, parts)


def gram(df: DataFrame, terms: Terms, y: str = "y") -> DataFrame:
    """One row with n, every ``xx_i_j`` and ``xy_i``, and yy."""
    pairs = [(i, j) for i in range(len(terms)) for j in range(i, len(terms))]
    staged = df.select(*[c.alias(f"t{i}") for i, (_, c) in enumerate(terms)], F.col(y).cast("double").alias("y")).dropna()
    return staged.agg(
        F.count("*").alias("n"),
        *[F.sum(F.col(f"t{i}") * F.col(f"t{j}")).alias(f"xx_{i}_{j}") for i, j in pairs],
        *[F.sum(F.col(f"t{i}") * F.col("y")).alias(f"xy_{i}") for i in range(len(terms))],
        F.sum(F.col("y") * F.col("y")).alias("yy"),
    )


def fit(df: DataFrame, model: str | Terms, y: str = "y", name: str | None = None) -> Fit:
    """Least squares of a named polynomial model or of given terms (the intercept first)."""
    terms = X.polynomial_terms(model) if isinstance(model, str) else model
    name = name or (model if isinstance(model, str) else "model")
    columns = [f"t{i}" for i in range(1, len(terms))]
    staged = df.select(
        *[c.alias(n) for n, (_, c) in zip(columns, terms[1:])], F.col(y).cast("double").alias("y")
    ).dropna()
    moments = staged.agg(
        *[F.avg(c).alias(f"m_{c}") for c in [*columns, "y"]], *[F.stddev_samp(c).alias(f"s_{c}") for c in columns]
    ).first()
    means = np.array([moments[f"m_{c}"] for c in columns])
    scales = np.array([moments[f"s_{c}"] or 1.0 for c in columns])
    y_mean = float(moments["m_y"])
    z_terms: Terms = [("1", F.lit(1.0))] + [
        (label, (F.col(c) - float(m)) / float(s)) for (label, _), c, m, s in zip(terms[1:], columns, means, scales)
    ]
    row = gram(staged.withColumn("y", F.col("y") - y_mean), z_terms).first()
    k = len(terms)
    zz, zy = np.zeros((k, k)), np.array([row[f"xy_{i}"] for i in range(k)])
    for i in range(k):
        for j in range(i, k):
            zz[i, j] = zz[j, i] = row[f"xx_{i}_{j}"]
    inverse = np.linalg.inv(zz)
    solved = np.linalg.solve(zz, zy)
    solved[0] += y_mean
    result = Fit(name, terms, row["n"], means, scales, solved, inverse, 0.0, row["yy"])
    # The residual sum comes from the residuals themselves, not from a difference of large sums.
    e = F.col("_y") - F.col("_f")
    complete = df.select(F.col(y).cast("double").alias("_y"), result.predict().alias("_f")).dropna()
    result.rss = float(complete.agg(F.sum(e * e).alias("rss")).first()["rss"])
    return result


def fit_all(df: DataFrame, models: Sequence[str] = tuple(X.POLYNOMIAL_MODELS), y: str = "y") -> dict[str, Fit]:
    """Fits of all models. Each reads ``df`` three times: settle one that a join makes."""
    return {m: fit(df, m, y) for m in models}


def coefficient_table(spark: SparkSession, fits: dict[str, Fit]) -> DataFrame:
    """One row per model, coefficients padded with NULL to the longest model."""
    width = max(f.k for f in fits.values())
    rows = [(name, *[float(c) for c in f.coefficients], *[None] * (width - f.k)) for name, f in fits.items()]
    return spark.createDataFrame(rows, "model string, " + ", ".join(f"theta_{i} double" for i in range(width)))


def log_likelihood(rss: float, n: int) -> float:
    """Gaussian log-likelihood with the variance taken as rss / (n - 1)."""
    s2 = rss / (n - 1)
    return -(n / 2) * math.log(2 * math.pi) - (n / 2) * math.log(s2) - rss / (2 * s2)


def selection_table(spark: SparkSession, fits: dict[str, Fit]) -> DataFrame:
    """RSS, log-likelihood, AIC and BIC per model; the parameters are the design columns."""
    rows = []
    for name, f in fits.items():
        ll = log_likelihood(f.rss, f.n)
        rows.append((name, f.k, f.n, f.rss, ll, 2 * f.k - 2 * ll, f.k * math.log(f.n) - 2 * ll))
    return spark.createDataFrame(
        rows, "model string, parameters int, n bigint, rss double, log_likelihood double, aic double, bic double"
    )


def selection_from_rss(rss_rows: DataFrame) -> DataFrame:
    """The same table from (model, parameters, n, rss) rows, as expressions."""
    n, rss, k = F.col("n"), F.col("rss"), F.col("parameters")
    s2 = rss / (n - 1)
    ll = -(n / 2) * F.log(F.lit(2 * math.pi)) - (n / 2) * F.log(s2) - rss / (2 * s2)
    with_ll = rss_rows.withColumn("log_likelihood", ll)
    return with_ll.withColumn("aic", 2 * k - 2 * F.col("log_likelihood")).withColumn(
        "bic", k * F.log(n) - 2 * F.col("log_likelihood")
    )


def best_model(selection: DataFrame) -> DataFrame:
    return selection.orderBy("aic", "model").limit(1)


def summary(spark: SparkSession, f: Fit) -> DataFrame:
    """Coefficients with standard errors, t and p values; R2 and residual deviation on every row."""
    errors = np.sqrt(f.sigma2 * np.diag(f.inverse))
    rows = []
    for label, b, se in zip(f.labels, f.coefficients, errors):
        t = b / se
        rows.append((label, float(b), float(se), float(t), numerics.t_two_sided(float(t), f.n - f.k),
                     1 - f.rss / f.tss, math.sqrt(f.sigma2)))
    return spark.createDataFrame(
        rows, "term string, coefficient double, std_error double, t_value double, p_value double, r2 double, sigma double"
    )


def with_fit(df: DataFrame, f: Fit, y: str = "y") -> DataFrame:
    """Add ``fitted`` and ``residual``."""
    return df.withColumn("fitted", f.predict()).withColumn("residual", F.col(y) - F.col("fitted"))


def cooks_distance(df: DataFrame, f: Fit, y: str = "y") -> DataFrame:
    """Add ``leverage``, ``cooks_d`` and ``influential`` (distance above 4 / n)."""
    e, h = F.col("residual"), F.col("leverage")
    return (
        with_fit(df, f, y)
        .withColumn("leverage", f.leverage())
        .withColumn("cooks_d", e * e * h / (f.k * f.sigma2 * F.pow(1 - h, 2)))
        .withColumn("influential", F.col("cooks_d") > 4.0 / f.n)
    )


def prediction_interval(df: DataFrame, f: Fit, level: float = 0.95) -> DataFrame:
    """Add ``fitted``, ``lower`` and ``upper`` of a new observation."""
    t = numerics.t_quantile(level, f.n - f.k)
    half = F.lit(t * math.sqrt(f.sigma2)) * F.sqrt(1 + F.col("leverage"))
    return (
        df.withColumn("fitted", f.predict()).withColumn("leverage", f.leverage())
        .withColumn("lower", F.col("fitted") - half).withColumn("upper", F.col("fitted") + half).drop("leverage")
    )


def autocorrelation(df: DataFrame, row_id: str, value: str, lags: int | None = None, block: int = 1_000_000) -> DataFrame:
    """Autocorrelation by lag of the row id: (lag, acf), lag 0 included. A lag pairs ids that differ by it.

    The series is cut into blocks; each block also gets the earlier rows that its lags reach, from as
    many blocks as that takes, so that every lagged product is formed inside one block. Ids must be
    unique; gaps have no products. The default lag count is ``floor(10 * log10(n))``.
    """
    stats = df.agg(F.count(value).alias("n"), F.avg(value).alias("mean")).first()
    if lags is None:
        lags = max(1, min(stats["n"] - 1, int(10 * math.log10(stats["n"])))) if stats["n"] > 1 else 0
    e = df.select(F.col(row_id).cast("bigint").alias("id"), (F.col(value) - stats["mean"]).alias("e"))
    home = F.floor(F.col("id") / block).cast("bigint")
    spread = e.withColumn("home", home).withColumn(
        "block", F.explode(F.sequence(home, F.floor((F.col("id") + lags) / block).cast("bigint")))
    )
    order = Window.partitionBy("block").orderBy("id")
    shifted = spread.select(
        "id", "e", "home", "block", *[F.max("e").over(order.rangeBetween(-k, -k)).alias(f"l{k}") for k in range(1, lags + 1)]
    ).filter("home = block")
    total = F.sum(F.col("e") * F.col("e"))
    row = shifted.agg(
        F.lit(1.0).alias("0"),
        *[(F.coalesce(F.sum(F.col("e") * F.col(f"l{k}")), F.lit(0.0)) / total).alias(str(k)) for k in range(1, lags + 1)],
    )
    return row.unpivot([], row.columns, "lag", "acf").withColumn("lag", F.col("lag").cast("int"))


# Acklam's rational approximation of the normal quantile.
_CENTRAL = (
    (-3.969683028665376e01, 2.209460984245205e02, -2.759285104469687e02, 1.383577518672690e02, -3.066479806614716e01, 2.506628277459239e00),
    (-5.447609879822406e01, 1.615858368580409e02, -1.556989798598866e02, 6.680131188771972e01, -1.328068155288572e01, 1.0),
)
_TAIL = (
    (-7.784894002430293e-03, -3.223964580411365e-01, -2.400758277161838e00, -2.549732539343734e00, 4.374664141464968e00, 2.938163982698783e00),
    (7.784695709041462e-03, 3.224671290700398e-01, 2.445134137142996e00, 3.754408661907416e00, 1.0),
)


def normal_quantile(p: Column) -> Column:
    """Inverse of the standard normal distribution, relative error about 1e-9."""

    def ratio(x, above, below):
        horner = lambda cs: reduce(lambda acc, c: acc * x + c, cs[1:], F.lit(cs[0]))
        return horner(above) / horner(below)

    centre = p - 0.5
    middle = centre * ratio(centre * centre, *_CENTRAL)
    side = F.sqrt(-2 * F.log(F.least(p, 1 - p)))
    outer = ratio(side, *_TAIL)
    return F.when(p.between(0.02425, 1 - 0.02425), middle).when(p < 0.5, outer).otherwise(-outer)


def qq_points(df: DataFrame, value: str, ties: Sequence[str] = ()) -> DataFrame:
    """Normal quantile-quantile points: (i, position, theoretical, sample), ranks formed range by range."""
    rows = df.select(F.col(value).cast("double").alias("sample"), *ties).dropna()
    n = rows.agg(F.count("*")).scalar()
    ranked = number_rows(rows, "sample", "i", ties=list(ties))
    shift = F.when(n > 10, 0.5).otherwise(0.375)
    position = (F.col("i") - shift) / (n + 1 - 2 * shift)
    return ranked.withColumn("position", position).select(
        "i", *ties, "position", normal_quantile(F.col("position")).alias("theoretical"), "sample"
    )


def _uniform(seed: int | str, stream: str) -> Column:
    """Repeatable uniform number in [0, 1) of (id, stream, seed)."""
    digest = F.md5(F.concat_ws("|", F.col("id").cast("string"), F.lit(stream), F.lit(str(seed))))
    return F.conv(F.substring(digest, 1, 12), 16, 10).cast("double") / float(16**12)


def largest_coefficients(f: Fit, n: int = 2) -> list[int]:
    """Positions of the coefficients of largest size, the intercept included."""
    return [int(i) for i in np.argsort(-np.abs(f.coefficients), kind="stable")[:n]]


def prior_draws(
    spark: SparkSession, f: Fit, parameters: Sequence[int], widths: Sequence[float], n: int, seed: int | str = 123
) -> DataFrame:
    """``n`` draws of two parameters from uniform priors around the fit, with their distance.

    The distance of a draw is the residual sum on the training rows. By the normal equations it is
    rss + d'(X'X)d for the shift d of the two parameters, so no draw meets the rows again.
    """
    centre, g = f.coefficients, f.gram
    draws = spark.range(n)
    shifts = []
    for name, i, w in zip(("theta_1", "theta_2"), parameters, widths):
        shift = (_uniform(seed, name) * 2 - 1) * float(w)
        draws = draws.withColumn(f"_{name}", shift).withColumn(name, F.col(f"_{name}") + float(centre[i]))
        shifts.append(F.col(f"_{name}"))
    (a, b), (i, j) = shifts, parameters
    distance = f.rss + a * a * float(g[i, i]) + 2 * a * b * float(g[i, j]) + b * b * float(g[j, j])
    return draws.select("id", "theta_1", "theta_2", distance.alias("distance"))


def relative_widths(f: Fit, parameters: Sequence[int], share: float = 0.20, least: float = 0.01) -> list[float]:
    return [max(least, share * abs(float(f.coefficients[i]))) for i in parameters]


def rejection_sample(
    spark: SparkSession, f: Fit, draws: int = 10_000, pilot: int = 3_000, quantile: float = 0.02, seed: int | str = 123,
    parameters: Sequence[int] | None = None,
) -> tuple[DataFrame, float]:
    """Accepted draws of two parameters (the largest by default) and the accepted distance.

    The distance limit is the given quantile of a pilot run.
    """
    parameters = largest_coefficients(f) if parameters is None else parameters
    widths = relative_widths(f, parameters)
    first = prior_draws(spark, f, parameters, widths, pilot, f"{seed}-pilot")
    limit = exact_quantiles(first, ["distance"], [quantile])["distance"][0]
    return prior_draws(spark, f, parameters, widths, draws, seed).filter(F.col("distance") <= limit), limit


def joint_posterior(
    spark: SparkSession, f: Fit, draws: int = 10_000, pilot: int = 3_000, quantile: float = 0.02, seed: int | str = 123,
    parameters: Sequence[int] | None = None, bins: int = 20,
) -> DataFrame:
    """Accepted draws over the prior's box of ``bins`` by ``bins`` cells, empty cells included.

    (bin_1, bin_2, theta_1, theta_2, accepted, density, prior_density, acceptance_rate): the parameters at the
    middle of the cell, the posterior's density in it and the prior's. A density is NULL if no draw was accepted.
    """
    parameters = largest_coefficients(f) if parameters is None else parameters
    widths = relative_widths(f, parameters)
    accepted, _ = rejection_sample(spark, f, draws, pilot, quantile, seed, parameters)
    names = ("theta_1", "theta_2")
    lows = [float(f.coefficients[i]) - w for i, w in zip(parameters, widths)]
    sides = [2 * w / bins for w in widths]
    cell = [
        F.greatest(F.lit(0), F.least(F.floor((F.col(t) - low) / side), F.lit(bins - 1))).cast("int").alias(f"bin_{k}")
        for k, (t, low, side) in enumerate(zip(names, lows, sides), 1)
    ]
    counts = accepted.groupBy(*cell).agg(F.count("*").alias("accepted"))
    box = spark.range(bins * bins).select(
        F.floor(F.col("id") / bins).cast("int").alias("bin_1"), F.pmod("id", F.lit(bins)).cast("int").alias("bin_2"))
    # At most one row per cell of the box.
    held = box.join(F.broadcast(counts), ["bin_1", "bin_2"], "left").fillna(0, ["accepted"])
    total = F.sum("accepted").over(Window.partitionBy())
    return held.select(
        "bin_1", "bin_2", *[(F.lit(low) + (F.col(f"bin_{k}") + 0.5) * F.lit(side)).alias(t)
                            for k, (t, low, side) in enumerate(zip(names, lows, sides), 1)],
        "accepted", F.try_divide(F.col("accepted"), total * F.lit(sides[0] * sides[1])).alias("density"),
        F.lit(1.0 / (bins * bins * sides[0] * sides[1])).alias("prior_density"), (total / F.lit(draws)).alias("acceptance_rate"),
    )


def rejection_sample_simple(
    spark: SparkSession, f: Fit, draws: int = 1_000, width: float = 0.1, factor: float = 1.5, seed: int | str = 123
) -> DataFrame:
    """The simple variant: first two parameters, fixed width, limit a multiple of the residual sum."""
    return prior_draws(spark, f, [0, 1], [width, width], draws, seed).filter(F.col("distance") < factor * f.rss)


def normal_posterior(spark: SparkSession, f: Fit, parameters: Sequence[int]) -> DataFrame:
    """Normal approximation: mean and deviation per parameter."""
    cov = f.sigma2 * f.inverse
    rows = [(f.labels[i], float(f.coefficients[i]), math.sqrt(float(cov[i, i]))) for i in parameters]
    return spark.createDataFrame(rows, "term string, mean double, sd double")
