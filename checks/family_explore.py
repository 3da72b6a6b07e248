"""Exploration, dashboards and statistics of columns on the incident and signal views."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import sqltext as q
from checks.views import table, view, with_views
from marlstone.functions import cleaning as C
from marlstone.functions import features as X
from marlstone.operators import clean, dashboard, explore, profile, split

SIGNALS = ["x1", "x2", "x3", "x4", "x5", "x6", "y"]


def incidents(s, d):
    return view(s, d, "incidents")


def _exact(s, d):
    return clean.engineer_accidents(clean.clean_accidents(incidents(s, d), approximate=False)).select(
        "accident_id", "casualties", "risk_score", "temperature", "weather", "road_type", "festival", "hour_bin", "is_festival"
    )


QUERIES = {
    "ag1_frequency": lambda s, d: profile.frequency(incidents(s, d), "accident_severity"),
    "ag2_hotspots": lambda s, d: explore.grouped_summary(incidents(s, d), **explore.SUMMARIES["hotspots"]),
    "ag3_day_hour_counts": lambda s, d: explore.grouped_summary(incidents(s, d), **explore.SUMMARIES["day_hour"]),
    "ag4_cause_severity_counts": lambda s, d: explore.grouped_summary(incidents(s, d), **explore.SUMMARIES["cause_severity"]),
    "ag5_risk_by_severity": lambda s, d: explore.grouped_summary(incidents(s, d), **explore.SUMMARIES["risk_by_severity"]),
    "ag6_shape": lambda s, d: profile.shape(incidents(s, d)),
    "ag6_type_tally": lambda s, d: profile.type_tally(incidents(s, d)),
    "ag7_null_counts": lambda s, d: profile.null_counts(incidents(s, d)),
    "ag8_numeric_summary": lambda s, d: profile.numeric_summary(
        incidents(s, d), ["hour", "temperature", "casualties", "risk_score"]
    ).select("column", "count", *[F.round(c, 6).alias(c) for c in ("mean", "stddev", "min", "max")]),
    "ag9_modes": lambda s, d: explore.modes(incidents(s, d), ["weather", "visibility", "road_type", "cause"]),
    "ag9_fill_modes": lambda s, d: explore.fill_modes(
        incidents(s, d).select("accident_id", "weather", "visibility"), ["weather", "visibility"]
    ),
    "ag10_imputer_medians": lambda s, d: explore.fill_medians(
        incidents(s, d).select("accident_id", "temperature", "casualties", "risk_score"),
        ["temperature", "casualties", "risk_score"], approximate=True,
    ),
    "pf1_select_rename": lambda s, d: incidents(s, d).select(
        F.col("accident_id").alias("id"), "city", F.col("risk_score").alias("actual")
    ),
    "pf2_pf3_pf4_accident_features": lambda s, d: clean.engineer_accidents(
        incidents(s, d).select("accident_id", "hour", X.fill_category("festival").alias("festival"))
    ),
    "pf5_pf6_clean_accidents": _exact,
    "pf10_pf11_class_weight": lambda s, d: split.with_class_weight(
        split.with_class_weight(incidents(s, d).select("accident_id", "accident_severity"), "accident_severity"),
        "accident_severity", balanced=True, name="balanced",
    ).withColumn("balanced", F.round("balanced", 9)),
    "t12_iso_date_parts": lambda s, d: table(s, d, "events").select(
        "event_id", F.date_format("ts", "yyyy-MM-dd").alias("date")
    ).withColumns(C.iso_date_parts("date")).withColumn("date_parsed", F.date_format("date_parsed", "yyyy-MM-dd")),
    "t17_numeric_functions": lambda s, d: table(s, d, "events").select(
        "event_id", F.round("value", 1).alias("rounded"), F.round(F.abs(F.col("value") - 100), 9).alias("absolute"),
        F.round(F.sqrt("value"), 9).alias("root"), F.round(F.log("value"), 9).alias("logarithm"),
        F.round(F.exp(-F.col("value") / 100), 9).alias("exponential"), F.round(F.pow("value", 2), 6).alias("square"),
    ),
    "t18_standardize": lambda s, d: explore.standardize(
        table(s, d, "events").select("event_id", "value"), ["value"]
    ).withColumn("value", F.round("value", 6)),
    "ag29_correlation": lambda s, d: explore.correlation(view(s, d, "signals"), SIGNALS).withColumn("r", F.round("r", 6)),
    "ag30_histogram": lambda s, d: explore.histogram(table(s, d, "lineitem"), "l_extendedprice", 40).select(
        "bin", "count", *[F.round(c, 6).alias(c) for c in ("bin_low", "bin_high")], F.round("density", 12).alias("density")
    ),
    "ag30_histogram_breaks": lambda s, d: explore.histogram_breaks(
        table(s, d, "events"), "value", [0.0, 50.0, 100.0, 200.0, 400.0, 2000.0]
    ).withColumn("density", F.round("density", 9)),
    "ag30_histogram_default": lambda s, d: explore.histogram_breaks(table(s, d, "lineitem"), "l_extendedprice").withColumn(
        "density", F.round("density", 12)
    ),
    "ag31_density": lambda s, d: explore.density(table(s, d, "events"), "value", 128).select(
        "i", F.round("x", 6).alias("x"), F.round("density", 9).alias("density")
    ),
    "ag33_describe_exact": lambda s, d: explore.describe_exact(table(s, d, "lineitem"), "l_extendedprice", (0.02, 0.25, 0.5, 0.75)).select(
        *[F.round(c, 6).alias(c) for c in ("sd", "mean", "q02", "q25", "q50", "q75")]
    ),
    "m42_trend": lambda s, d: explore.trend(view(s, d, "signals"), "x6", "y", 20).select(
        "bin", "n", *[F.round(c, 4).alias(c) for c in ("mean_x", "slope", "fitted")]
    ),
    "m42_local_line": lambda s, d: explore.local_line(view(s, d, "signals"), "x6", "y").select(
        "cell", "n", F.round(F.log("x"), 9).alias("log_x"), F.round("slope", 3).alias("slope"), F.round("fitted", 2).alias("fitted")
    ),
    "dx1_cause_severity_bars": lambda s, d: dashboard.cause_severity(incidents(s, d)),
    "dx2_hotspot_points": lambda s, d: dashboard.hotspot_points(incidents(s, d)),
    "dx2_hotspot_grid": lambda s, d: dashboard.hotspot_grid(incidents(s, d), 0),
    "dx3_hour_day_heatmap": lambda s, d: dashboard.hour_day_heatmap(incidents(s, d)),
    "dx4_city_severity_bars": lambda s, d: dashboard.city_severity(incidents(s, d)),
}

DAYS = ("Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday")
_all = ["accident_id", "city", "state", "ts", "latitude", "longitude", "hour", "day_of_month", "day_of_week", "cause",
        "road_type", "weather", "visibility", "temperature", "accident_severity", "casualties", "festival", "risk_score"]


def _i(sql):
    return with_views(sql, "incidents")


_MODES = " UNION ALL ".join(
    f"SELECT * FROM (SELECT '{c}' AS \"column\", {c} AS mode, count(*) AS count FROM incidents WHERE {c} IS NOT NULL GROUP BY {c} "
    f"ORDER BY 3 DESC, 2 LIMIT 1)" for c in ("weather", "visibility", "road_type", "cause")
)
_FILLED = (
    "filled AS (SELECT accident_id, hour, coalesce(festival, 'None') AS festival, "
    "coalesce(temperature, (SELECT median(temperature) FROM incidents)) AS temperature, "
    "coalesce(casualties, (SELECT median(casualties) FROM incidents)) AS casualties, "
    "coalesce(risk_score, (SELECT median(risk_score) FROM incidents)) AS risk_score, "
    "coalesce(weather, (SELECT weather FROM incidents WHERE weather IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)) AS weather, "
    "road_type FROM incidents)"
)
_BIN = "CASE WHEN hour BETWEEN 5 AND 11 THEN 'morning' WHEN hour BETWEEN 12 AND 16 THEN 'afternoon' WHEN hour BETWEEN 17 AND 20 THEN 'evening' ELSE 'night' END AS hour_bin"
_CELL = "(value - s.start) / s.step"

ORACLES = {
    "ag1_frequency": _i("SELECT accident_severity, count(*) AS count FROM incidents GROUP BY 1"),
    "ag2_hotspots": _i(
        f"SELECT city, state, accident_severity, count(*) AS accidents, {q.d('avg(risk_score)', 3)} AS avg_risk_score, "
        f"{q.d('avg(latitude)', 5)} AS avg_lat, {q.d('avg(longitude)', 5)} AS avg_lon FROM incidents GROUP BY 1, 2, 3"
    ),
    "ag3_day_hour_counts": _i("SELECT day_of_week, hour, count(*) AS accidents FROM incidents GROUP BY 1, 2"),
    "ag4_cause_severity_counts": _i("SELECT cause, accident_severity, count(*) AS accidents FROM incidents GROUP BY 1, 2"),
    "ag5_risk_by_severity": _i(
        f"SELECT accident_severity, {q.d('avg(risk_score)', 3)} AS avg_risk_score, {q.d('avg(casualties)', 2)} AS avg_casualties, "
        "count(*) AS n FROM incidents GROUP BY 1"
    ),
    "ag6_shape": _i(f"SELECT count(*) AS rows, CAST({len(_all)} AS BIGINT) AS columns FROM incidents"),
    "ag7_null_counts": _i(" UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", count(*) - count({c}) AS nulls FROM incidents" for c in _all)),
    "ag8_numeric_summary": _i(" UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", count({c}) AS count, round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS stddev, "
        f"round(CAST(min({c}) AS DOUBLE), 6) AS min, round(CAST(max({c}) AS DOUBLE), 6) AS max FROM incidents"
        for c in ("hour", "temperature", "casualties", "risk_score"))),
    "ag9_modes": _i(_MODES),
    "ag9_fill_modes": _i(
        "SELECT accident_id, coalesce(weather, (SELECT weather FROM incidents WHERE weather IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)) AS weather, "
        "coalesce(visibility, (SELECT visibility FROM incidents WHERE visibility IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)) AS visibility FROM incidents"
    ),
    "pf1_select_rename": _i("SELECT accident_id AS id, city, risk_score AS actual FROM incidents"),
    "pf2_pf3_pf4_accident_features": _i(
        f"SELECT accident_id, hour, coalesce(festival, 'None') AS festival, {_BIN}, CASE WHEN festival IS NULL THEN 0 ELSE 1 END AS is_festival FROM incidents"
    ),
    "pf5_pf6_clean_accidents": with_views(
        "SELECT accident_id, CASE WHEN casualties > 5 THEN 5 ELSE casualties END AS casualties, risk_score, temperature, weather, road_type, festival, "
        f"{_BIN}, CASE WHEN festival = 'None' THEN 0 ELSE 1 END AS is_festival FROM filled WHERE risk_score BETWEEN 0 AND 1",
        "incidents", extra=_FILLED,
    ),
    "pf10_pf11_class_weight": _i(
        "SELECT accident_id, accident_severity, CAST(round(CAST(max(n) OVER () AS DOUBLE) / n, 4) AS DOUBLE) AS weight, "
        "round((SELECT count(*) FROM incidents) / CAST((SELECT count(DISTINCT accident_severity) FROM incidents) * n AS DOUBLE), 9) AS balanced "
        "FROM (SELECT accident_id, accident_severity, count(*) OVER (PARTITION BY accident_severity) AS n FROM incidents)"
    ),
    "t12_iso_date_parts": "SELECT event_id, strftime(ts, '%Y-%m-%d') AS date, strftime(ts, '%Y-%m-%d') AS date_parsed, "
    "CAST(year(ts) AS INTEGER) AS accident_year, CAST(month(ts) AS INTEGER) AS accident_month FROM events",
    "t17_numeric_functions": f"SELECT event_id, {q.d('value', 1)} AS rounded, round(abs(value - 100), 9) AS absolute, round(sqrt(value), 9) AS root, "
    "round(ln(value), 9) AS logarithm, round(exp(-value / 100), 9) AS exponential, round(pow(value, 2), 6) AS square FROM events",
    "t18_standardize": "SELECT event_id, round((value - (SELECT avg(value) FROM events)) / (SELECT stddev_samp(value) FROM events), 6) AS value FROM events",
    "ag29_correlation": with_views(" UNION ALL ".join(
        f"SELECT '{a}' AS x, '{b}' AS y, " + ("CAST(1 AS DOUBLE)" if a == b else f"round(corr({a}, {b}), 6)") + " AS r" + ("" if a == b else " FROM signals")
        for a in SIGNALS for b in SIGNALS), "signals"),
    "ag30_histogram": "WITH s AS (SELECT min(l_extendedprice) AS lo, max(l_extendedprice) AS hi, count(*) AS n FROM lineitem), "
    "c AS (SELECT CAST(least(floor((l_extendedprice - lo) / (hi - lo) * 40), 39) AS INTEGER) + 1 AS bin, count(*) AS n FROM lineitem, s GROUP BY 1) "
    "SELECT CAST(b.range AS INTEGER) AS bin, coalesce(c.n, 0) AS count, round(lo + (hi - lo) / 40 * (b.range - 1), 6) AS bin_low, "
    "round(lo + (hi - lo) / 40 * b.range, 6) AS bin_high, round(coalesce(c.n, 0) / (s.n * ((hi - lo) / 40)), 12) AS density "
    "FROM range(1, 41) b LEFT JOIN c ON c.bin = b.range, s",
    "ag30_histogram_breaks": "WITH b(bin, bin_low, bin_high) AS (VALUES (1, 0.0::DOUBLE, 50.0::DOUBLE), (2, 50, 100), (3, 100, 200), (4, 200, 400), (5, 400, 2000)), "
    "n AS (SELECT count(*) AS n FROM events WHERE value BETWEEN 0 AND 2000) "
    "SELECT bin, bin_low, bin_high, count(e.value) AS count, round(count(e.value) / (any_value(n.n) * (bin_high - bin_low)), 9) AS density "
    "FROM b LEFT JOIN events e ON (e.value > bin_low OR (bin = 1 AND e.value = 0)) AND e.value <= bin_high, n GROUP BY 1, 2, 3",
    "ag30_histogram_default": "WITH s AS (SELECT min(l_extendedprice) AS lo, max(l_extendedprice) AS hi, count(l_extendedprice) AS n FROM lineitem), "
    "r AS (SELECT *, (hi - lo) / ceil(log2(n) + 1) AS raw FROM s), a AS (SELECT *, pow(10::DOUBLE, floor(log10(raw))) AS base FROM r), "
    "b AS (SELECT *, CASE WHEN 2 * base - raw < 1.5 * (raw - base) THEN 2 * base ELSE base END AS u FROM a), "
    "c AS (SELECT * REPLACE (CASE WHEN 5 * base - raw < 2.75 * (raw - u) THEN 5 * base ELSE u END AS u) FROM b), "
    "w AS (SELECT * REPLACE (CASE WHEN 10 * base - raw < 1.5 * (raw - u) THEN 10 * base ELSE u END AS u) FROM c), "
    "g AS (SELECT *, floor(lo / u + 1e-7) AS first, ceil(hi / u - 1e-7) AS last FROM w), "
    "e AS (SELECT CAST(i.range + 1 AS INTEGER) AS bin, (first + i.range) * u AS bin_low, (first + i.range + 1) * u AS bin_high, n "
    "FROM g, range(1000) i WHERE i.range < greatest(last - first, 1)) "
    "SELECT bin, bin_low, bin_high, count(l_extendedprice) AS count, round(count(l_extendedprice) / (any_value(n) * (bin_high - bin_low)), 12) AS density "
    "FROM e LEFT JOIN lineitem ON (l_extendedprice > bin_low OR (bin = 1 AND l_extendedprice = bin_low)) AND l_extendedprice <= bin_high GROUP BY 1, 2, 3",
    "ag31_density": "WITH h AS (SELECT min(value) AS lo, max(value) AS hi, count(*) AS n, "
    "0.9::DOUBLE * least(stddev_samp(value), (quantile_cont(value, 0.75) - quantile_cont(value, 0.25)) / 1.34::DOUBLE) * pow(count(*), -0.2::DOUBLE) AS h FROM events), "
    "s AS (SELECT *, lo - 3 * h AS start, (hi + 3 * h - (lo - 3 * h)) / 127 AS step FROM h), "
    f"p AS (SELECT CAST(floor({_CELL}) AS INTEGER) AS i, {_CELL} - floor({_CELL}) AS f FROM events, s), "
    "w AS (SELECT i, sum(w) AS w FROM (SELECT i, 1 - f AS w FROM p UNION ALL SELECT i + 1, f FROM p) GROUP BY 1) "
    "SELECT CAST(g.range AS INTEGER) AS i, round(s.start + g.range * s.step, 6) AS x, "
    "round(sum(w.w * exp(-0.5 * pow((g.range - w.i) * (s.step / s.h), 2))) / (s.n * s.h * sqrt(2 * pi())), 9) AS density "
    "FROM range(128) g, w, s GROUP BY g.range, s.start, s.step, s.n, s.h",
    "ag33_describe_exact": "SELECT round(stddev_samp(l_extendedprice), 6) AS sd, round(avg(l_extendedprice), 6) AS mean, "
    + ", ".join(f"round(quantile_cont(l_extendedprice, {p}), 6) AS q{n}" for p, n in ((0.02, "02"), (0.25, "25"), (0.5, "50"), (0.75, "75")))
    + " FROM lineitem",
    "m42_trend": with_views(
        "SELECT bin, count(*) AS n, round(avg(x6), 4) AS mean_x, round(regr_slope(y, x6), 4) AS slope, round(avg(y), 4) AS fitted "
        "FROM (SELECT x6, y, CAST((SELECT count(*) FROM e WHERE e.e <= x6) AS INTEGER) AS bin FROM signals) GROUP BY 1",
        "signals", extra="e AS (SELECT DISTINCT unnest(quantile_cont(x6, [" + ", ".join(str(i / 20) for i in range(1, 20)) + "])) AS e FROM signals)",
    ),
    "m42_local_line": with_views(
        "SELECT CAST(cell AS INTEGER) AS cell, n, round(ln(m * w + low), 9) AS log_x, round(b / w, 3) AS slope, round((sy - b * su) / sn, 2) AS fitted "
        "FROM (SELECT *, CASE WHEN sn * suu - su * su > 1e-12 * sn * sn THEN (sn * suy - su * sy) / (sn * suu - su * su) ELSE 0 END AS b FROM sums), s",
        "signals", extra="s AS (SELECT min(x6) AS low, max(x6) - min(x6) AS w, count(*) AS total FROM signals), r AS (SELECT (x6 - low) / w AS u, y FROM signals, s), "
        "c AS (SELECT least(floor(u * 256), 255) AS cell, count(*) AS n, sum(u) AS u, sum(u * u) AS uu, sum(y) AS y, sum(u * y) AS uy, sum(u) / count(*) AS m FROM r GROUP BY 1), "
        "p AS (SELECT a.cell, a.n AS own, a.m, abs(o.m - a.m) AS d, o.n, o.u - o.n * a.m AS u, o.uu - 2 * a.m * o.u + o.n * a.m * a.m AS uu, o.y, o.uy - a.m * o.y AS uy FROM c a, c o), "
        "h AS (SELECT cell, min(d) AS h FROM (SELECT cell, d, sum(n) OVER (PARTITION BY cell ORDER BY d, n) AS seen FROM p), s WHERE seen >= ceil(0.6666666666666666::DOUBLE * total) GROUP BY 1), "
        "w AS (SELECT p.*, pow(1 - pow(least(d / h, 1), 3), 3) AS w FROM p JOIN h USING (cell)), "
        "sums AS (SELECT cell, any_value(own) AS n, any_value(m) AS m, sum(w * n) AS sn, sum(w * u) AS su, sum(w * uu) AS suu, sum(w * y) AS sy, sum(w * uy) AS suy FROM w GROUP BY 1)",
    ),
    "dx1_cause_severity_bars": _i("SELECT cause, accident_severity, count(*) AS accidents FROM incidents GROUP BY 1, 2"),
    "dx2_hotspot_points": _i("SELECT accident_id, accident_severity, avg(latitude) AS latitude, avg(longitude) AS longitude FROM incidents GROUP BY 1, 2"),
    "dx2_hotspot_grid": _i("SELECT round(latitude, 0) AS latitude, round(longitude, 0) AS longitude, accident_severity, count(*) AS accidents FROM incidents GROUP BY 1, 2, 3"),
    "dx3_hour_day_heatmap": _i("SELECT hour, " + ", ".join(f"count(*) FILTER (day_of_week = '{x}') AS {x}" for x in DAYS) + " FROM incidents GROUP BY 1"),
    "dx4_city_severity_bars": _i("SELECT city, accident_severity, count(*) AS accidents FROM incidents GROUP BY 1, 2"),
}
