"""Least squares and its diagnostics on the signal view, series statistics on the events."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.views import table, view, with_views
from marlstone.functions import features as X
from marlstone.operators import explore, split, stats
from marlstone.session import settle

MODELS = list(X.POLYNOMIAL_MODELS)


def signals(s, d):
    return view(s, d, "signals")


def _normal_equations(s, d):
    """Cosines between residuals and design columns of every model: 0 exactly at least squares."""
    out, data = None, settle(signals(s, d))
    for name, f in stats.fit_all(data).items():
        rows = stats.with_fit(data, f)
        e = F.col("residual")
        size = F.sqrt(F.sum(e * e))
        one = rows.agg(*[
            F.round(F.abs(F.sum(e * c) / (size * F.sqrt(F.sum(c * c)))), 6).alias(label) for label, c in f.terms
        ])
        part = one.unpivot([], one.columns, "term", "cosine").withColumn("model", F.lit(name))
        out = part if out is None else out.unionByName(part)
    return out


def _m1(s, d):
    return stats.fit(signals(s, d), "m1")


def _rss(s, d):
    """Residual sums of fixed linear guesses, for the selection formulas."""
    guess = F.col("x1") * 1500.0
    rows = signals(s, d).agg(F.count("*").alias("n"), F.sum(F.pow(F.col("y") - guess, 2)).alias("a"), F.sum(F.pow(F.col("y") - guess - F.col("x5"), 2)).alias("b"))
    return rows.unpivot(["n"], ["a", "b"], "model", "rss").withColumn("parameters", F.when(F.col("model") == "a", 7).otherwise(10))


def _intervals(s, d):
    marked = split.hashed_split(table(s, d, "lineitem").withColumn("k", F.concat_ws("-", *["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_extendedprice"])), "k", 0.7)
    rows = marked.select("data_split", F.col("l_quantity").alias("x1"), F.col("l_discount").alias("x2"), F.col("l_extendedprice").alias("y"))
    terms = [("1", F.lit(1.0)), ("x1", F.col("x1")), ("x2", F.col("x2"))]
    f = stats.fit(rows.filter("data_split = 'train'"), terms)
    return stats.prediction_interval(rows.filter("data_split = 'test'"), f)


def _lineitem_fit(s, d):
    rows = table(s, d, "lineitem").select(F.col("l_quantity").alias("x"), F.col("l_extendedprice").alias("y"))
    return rows, stats.fit(rows, [("1", F.lit(1.0)), ("x", F.col("x"))])


#: Half the width of the prior of a line's parameters: wide enough that many of its draws are refused.
WIDE = 3000.0


def _accepted(s, d):
    return stats.rejection_sample(s, stats.fit(signals(s, d), "m5"))[0]


QUERIES = {
    "pf18_polynomial_terms": lambda s, d: signals(s, d).agg(*[
        F.round(F.sum(c), 3).alias(label) for label, c in [*X.polynomial_terms("m1")[1:4], *X.polynomial_terms("m5")[7:]]
    ]),
    "m36_gram_matrix": lambda s, d: stats.gram(signals(s, d), X.polynomial_terms("m3")).select(
        "n", *[F.round(F.col(c) / 1e6, 3).alias(c) for c in ("xx_0_1", "xx_1_1", "xx_1_6", "xy_1", "xy_6", "yy")]
    ),
    "m36_normal_equations": _normal_equations,
    "m36_simple_regression": lambda s, d: (lambda rf: stats.coefficient_table(s, {"line": rf[1]}).select(
        "model", F.round("theta_0", 4).alias("theta_0"), F.round("theta_1", 4).alias("theta_1")))(_lineitem_fit(s, d)),
    "m36_coefficients": lambda s, d: stats.coefficient_table(s, stats.fit_all(settle(signals(s, d)))),
    "m37_m38_selection": lambda s, d: stats.selection_from_rss(_rss(s, d)).select(
        "model", "parameters", "n", *[F.round(c, 3).alias(c) for c in ("log_likelihood", "aic", "bic")]
    ),
    "m38_best_model": lambda s, d: stats.best_model(stats.selection_table(s, stats.fit_all(settle(signals(s, d))))),
    "m39_cooks_distance": lambda s, d: (lambda rf: stats.cooks_distance(rf[0], rf[1]).select(
        "x", "y", F.round("leverage", 9).alias("leverage"), F.round("cooks_d", 9).alias("cooks_d"), F.col("influential").cast("int").alias("influential")))(_lineitem_fit(s, d)),
    "m40_j13_prediction_interval": lambda s, d: _intervals(s, d),
    "m40_line_interval": lambda s, d: stats.prediction_interval(*_lineitem_fit(s, d)).select(
        "x", "y", *[F.round(c, 3).alias(c) for c in ("fitted", "lower", "upper")]),
    "m43_j14_accepted_draws": _accepted,
    "m44_line_draws": lambda s, d: stats.rejection_sample_simple(s, _lineitem_fit(s, d)[1], width=WIDE).select(
        "id", F.round("theta_1", 4).alias("theta_1"), F.round("theta_2", 4).alias("theta_2")),
    "m45_line_posterior": lambda s, d: stats.normal_posterior(s, _lineitem_fit(s, d)[1], [0, 1]).select(
        "term", F.round("mean", 4).alias("mean"), F.round("sd", 4).alias("sd")),
    "m44_simple_draws": lambda s, d: stats.rejection_sample_simple(s, stats.fit(signals(s, d), "m5")),
    "m45_normal_posterior": lambda s, d: (lambda f: stats.normal_posterior(s, f, stats.largest_coefficients(f)))(stats.fit(signals(s, d), "m5")),
    "m46_posterior_histogram": lambda s, d: explore.histogram(_accepted(s, d), "theta_1", 30),
    "m43_m46_joint_posterior": lambda s, d: stats.joint_posterior(s, _lineitem_fit(s, d)[1], parameters=[0, 1]).select(
        "bin_1", "bin_2", "accepted", "acceptance_rate", F.round("theta_1", 3).alias("theta_1"), F.round("theta_2", 3).alias("theta_2"),
        F.round(F.col("density") / F.col("prior_density"), 6).alias("lift"), F.round(F.lit(1) / F.col("prior_density"), 2).alias("prior_area")),
    "m47_summary": lambda s, d: stats.summary(s, stats.fit(signals(s, d), "m5")),
    "m47_simple_summary": lambda s, d: (lambda rf: stats.summary(s, rf[1]).select(
        "term", F.round("std_error", 4).alias("std_error"), F.round("r2", 8).alias("r2"), F.round("sigma", 4).alias("sigma")))(_lineitem_fit(s, d)),
    "wn7_autocorrelation": lambda s, d: stats.autocorrelation(table(s, d, "events"), "event_id", "value", block=3000).withColumn("acf", F.round("acf", 6)),
    "wn10_qq_points": lambda s, d: stats.qq_points(table(s, d, "events"), "value", ["event_id"]).select("event_id", "i", "sample", F.round("position", 9).alias("position"), F.round("theoretical", 6).alias("theoretical")),
}


def _ratio(x, above, below):
    """Two polynomials, highest power first, by powers of ``x``."""
    power = lambda cs: " + ".join(f"({c!r}::DOUBLE) * pow({x}, {len(cs) - 1 - k})" for k, c in enumerate(cs))
    return f"(({power(above)}) / ({power(below)}))"


def _draws(name, n, seed):
    """The draws of both parameters with their distance, from the numbers of their MD5."""
    u = lambda t, w: f"(CAST('0x' || substr(md5(range || '|{t}|{seed}'), 1, 12) AS BIGINT) / 281474976710656.0::DOUBLE * 2 - 1) * {w}"
    return (
        f"{name} AS (SELECT *, rss + p * p * n + 2 * p * q * sx + q * q * sxx AS distance FROM "
        f"(SELECT {u('theta_1', 'wa')} AS p, {u('theta_2', 'wb')} AS q, range AS id, f.* FROM range({n}), f))"
    )


def _v(sql, extra=""):
    return with_views(sql, "signals", extra=extra)


_TERMS = {"x1^3": "x1*x1*x1", "x2^2": "x2*x2", "x3^2": "x3*x3", "x1*x2": "x1*x2", "x3*x4": "x3*x4", "x2*x6": "x2*x6"}
_LL = "(-(n / 2.0) * ln(2 * pi()) - (n / 2.0) * ln(rss / (n - 1)) - rss / (2 * (rss / (n - 1))))"

ORACLES = {
    "pf18_polynomial_terms": _v("SELECT " + ", ".join(f"round(sum({e}), 3) AS \"{n}\"" for n, e in _TERMS.items()) + " FROM signals"),
    "m36_gram_matrix": _v(
        "SELECT count(*) AS n, round(sum(x1) / 1e6, 3) AS xx_0_1, round(sum(x1 * x1) / 1e6, 3) AS xx_1_1, round(sum(x1 * x6 * x6) / 1e6, 3) AS xx_1_6, "
        "round(sum(x1 * y) / 1e6, 3) AS xy_1, round(sum(x6 * x6 * y) / 1e6, 3) AS xy_6, round(sum(y * y) / 1e6, 3) AS yy FROM signals"
    ),
    "m36_normal_equations": _v(" UNION ALL ".join(
        f"SELECT '{m}' AS model, '{t}' AS term, CAST(0 AS DOUBLE) AS cosine"
        for m in MODELS for t in ["1"] + [label for label, _ in X.POLYNOMIAL_MODELS[m]])),
    "m36_simple_regression": "SELECT 'line' AS model, round(regr_intercept(l_extendedprice, l_quantity), 4) AS theta_0, round(regr_slope(l_extendedprice, l_quantity), 4) AS theta_1 FROM lineitem",
    "m37_m38_selection": _v(
        f"SELECT model, parameters, n, round({_LL}, 3) AS log_likelihood, round(2 * parameters - 2 * {_LL}, 3) AS aic, round(parameters * ln(n) - 2 * {_LL}, 3) AS bic FROM "
        "(SELECT 'a' AS model, 7 AS parameters, count(*) AS n, sum(pow(y - x1 * 1500, 2)) AS rss FROM signals UNION ALL "
        "SELECT 'b', 10, count(*), sum(pow(y - x1 * 1500 - x5, 2)) FROM signals)"
    ),
    "m39_cooks_distance": "WITH s AS (SELECT count(*) AS n, avg(l_quantity) AS m, regr_sxx(l_extendedprice, l_quantity) AS sxx, regr_slope(l_extendedprice, l_quantity) AS b, regr_intercept(l_extendedprice, l_quantity) AS a FROM lineitem), "
    "r AS (SELECT l_quantity AS x, l_extendedprice AS y, l_extendedprice - a - b * l_quantity AS e, 1.0::DOUBLE / n + pow(l_quantity - m, 2) / sxx AS h, n FROM lineitem, s), "
    "v AS (SELECT sum(e * e) / (count(*) - 2) AS s2 FROM r) SELECT x, y, round(h, 9) AS leverage, round(e * e * h / (2 * s2 * pow(1 - h, 2)), 9) AS cooks_d, "
    "CAST(e * e * h / (2 * s2 * pow(1 - h, 2)) > 4.0::DOUBLE / n AS INTEGER) AS influential FROM r, v",
    "m43_m46_joint_posterior": "WITH l AS (SELECT l_quantity AS x, l_extendedprice AS y FROM lineitem), g AS (SELECT regr_intercept(y, x) AS a, regr_slope(y, x) AS b, CAST(count(*) AS DOUBLE) AS n, sum(x) AS sx, sum(x * x) AS sxx FROM l), "
    "f AS (SELECT any_value(COLUMNS(g.*)), sum(pow(y - a - b * x, 2)) AS rss, greatest(0.01, 0.2 * abs(any_value(a))) AS wa, greatest(0.01, 0.2 * abs(any_value(b))) AS wb FROM l, g), "
    + _draws("pilot", 3000, "123-pilot") + ", " + _draws("main", 10000, "123") + ", "
    "k AS (SELECT CAST(least(floor((p + wa) / (2 * wa) * 20), 19) AS INTEGER) AS bin_1, CAST(least(floor((q + wb) / (2 * wb) * 20), 19) AS INTEGER) AS bin_2, count(*) AS accepted "
    "FROM main WHERE distance <= (SELECT quantile_cont(distance, 0.02) FROM pilot) GROUP BY 1, 2), "
    "box AS (SELECT CAST(i.range AS INTEGER) AS bin_1, CAST(j.range AS INTEGER) AS bin_2 FROM range(20) i, range(20) j), "
    "t AS (SELECT bin_1, bin_2, coalesce(accepted, 0) AS accepted, sum(coalesce(accepted, 0)) OVER () AS total FROM box LEFT JOIN k USING (bin_1, bin_2)) "
    "SELECT bin_1, bin_2, accepted, CAST(total AS DOUBLE) / 10000 AS acceptance_rate, round(a - wa + (bin_1 + 0.5::DOUBLE) * wa / 10, 3) AS theta_1, "
    "round(b - wb + (bin_2 + 0.5::DOUBLE) * wb / 10, 3) AS theta_2, round(accepted * 400.0::DOUBLE / CAST(total AS DOUBLE), 6) AS lift, round(4 * wa * wb, 2) AS prior_area FROM t, f",
    # The t of a 95% interval as its series in 1 / (n - 2), whose rest is below 1e-10 from some 500 rows on.
    "m40_line_interval": "WITH s AS (SELECT count(*) AS n, avg(l_quantity) AS m, regr_sxx(l_extendedprice, l_quantity) AS sxx, regr_slope(l_extendedprice, l_quantity) AS b, regr_intercept(l_extendedprice, l_quantity) AS a FROM lineitem), "
    "v AS (SELECT sqrt(sum(pow(l_extendedprice - a - b * l_quantity, 2)) / (any_value(n) - 2)) AS sd FROM lineitem, s), "
    "t AS (SELECT n - 2 AS k, 1.959963984540054::DOUBLE AS z FROM s), "
    "q AS (SELECT z + (pow(z, 3) + z) / (4 * k) + (5 * pow(z, 5) + 16 * pow(z, 3) + 3 * z) / (96 * pow(k, 2)) "
    "+ (3 * pow(z, 7) + 19 * pow(z, 5) + 17 * pow(z, 3) - 15 * z) / (384 * pow(k, 3)) AS t FROM t), "
    "r AS (SELECT l_quantity AS x, l_extendedprice AS y, a + b * l_quantity AS f, t * sd * sqrt(1 + 1.0::DOUBLE / n + pow(l_quantity - m, 2) / sxx) AS h FROM lineitem, s, v, q) "
    "SELECT x, y, round(f, 3) AS fitted, round(f - h, 3) AS lower, round(f + h, 3) AS upper FROM r",
    "m44_line_draws": "WITH l AS (SELECT l_quantity AS x, l_extendedprice AS y FROM lineitem), g AS (SELECT regr_intercept(y, x) AS a, regr_slope(y, x) AS b, CAST(count(*) AS DOUBLE) AS n, sum(x) AS sx, sum(x * x) AS sxx FROM l), "
    f"f AS (SELECT any_value(COLUMNS(g.*)), sum(pow(y - a - b * x, 2)) AS rss, {WIDE}::DOUBLE AS wa, {WIDE}::DOUBLE AS wb FROM l, g), "
    + _draws("main", 1000, "123") + " SELECT id, round(a + p, 4) AS theta_1, round(b + q, 4) AS theta_2 FROM main WHERE distance < 1.5 * rss",
    "m45_line_posterior": "WITH s AS (SELECT count(*) AS n, avg(l_quantity) AS m, regr_sxx(l_extendedprice, l_quantity) AS sxx, regr_slope(l_extendedprice, l_quantity) AS b, regr_intercept(l_extendedprice, l_quantity) AS a FROM lineitem), "
    "v AS (SELECT sqrt(sum(pow(l_extendedprice - a - b * l_quantity, 2)) / (any_value(n) - 2)) AS sd FROM lineitem, s), "
    "p AS (SELECT '1' AS term, a AS mean, sd * sqrt(1.0::DOUBLE / n + m * m / sxx) AS sd FROM s, v UNION ALL SELECT 'x', b, sd / sqrt(sxx) FROM s, v) "
    "SELECT term, round(mean, 4) AS mean, round(sd, 4) AS sd FROM p",
    "m47_simple_summary": "WITH s AS (SELECT count(*) AS n, avg(l_quantity) AS m, regr_sxx(l_extendedprice, l_quantity) AS sxx, regr_slope(l_extendedprice, l_quantity) AS b, regr_intercept(l_extendedprice, l_quantity) AS a, regr_r2(l_extendedprice, l_quantity) AS r2 FROM lineitem), "
    "v AS (SELECT sum(pow(l_extendedprice - a - b * l_quantity, 2)) / (any_value(n) - 2) AS s2 FROM lineitem, s) "
    "SELECT t.term, round(CASE WHEN t.term = 'x' THEN sqrt(s2 / sxx) ELSE sqrt(s2 * (1.0::DOUBLE / n + m * m / sxx)) END, 4) AS std_error, round(r2, 8) AS r2, round(sqrt(s2), 4) AS sigma FROM (VALUES ('1'), ('x')) t(term), s, v",
    "wn7_autocorrelation": "WITH e AS (SELECT event_id AS id, value - (SELECT avg(value) FROM events) AS e FROM events), t AS (SELECT sum(e * e) AS t, floor(10 * log10(count(*))) AS k FROM e) "
    "SELECT CAST(l.range AS INTEGER) AS lag, round(sum(a.e * b.e) / any_value(t.t), 6) AS acf FROM range(0, 100) l, t, e a, e b WHERE l.range <= t.k AND b.id = a.id - l.range GROUP BY 1",
    "wn10_qq_points": "WITH r AS (SELECT event_id, value, row_number() OVER (ORDER BY value, event_id) AS i, count(*) OVER () AS n FROM events), "
    "q AS (SELECT event_id, i, value AS sample, (i - 0.5::DOUBLE) / n AS p, p - 0.5 AS c, c * c AS cc, sqrt(-2 * ln(least(p, 1 - p))) AS s FROM r) "
    f"SELECT event_id, i, sample, round(p, 9) AS position, round(CASE WHEN p BETWEEN 0.02425 AND 1 - 0.02425 THEN c * {_ratio('cc', *stats._CENTRAL)} "
    f"WHEN p < 0.5 THEN {_ratio('s', *stats._TAIL)} ELSE -{_ratio('s', *stats._TAIL)} END, 6) AS theoretical FROM q",
}
