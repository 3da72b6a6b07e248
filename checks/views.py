"""Stand-in views over the test tables, as SQL that Spark and the SQL check both run."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
    "embeddings", "pages", "benchmark", "labels", "conversations",
)

INCIDENTS = """
SELECT e.event_id AS accident_id, n.n_name AS city, r.r_name AS state, e.ts AS ts,
       CAST(e.event_id % 180 AS DOUBLE) / 2.0 AS latitude, CAST(e.event_id % 360 AS DOUBLE) / 4.0 AS longitude,
       CAST(extract(hour FROM e.ts) AS INT) AS hour,
       CAST(extract(day FROM e.ts) AS INT) AS day_of_month,
       {day_name} AS day_of_week,
       e.event_type AS cause, c.c_mktsegment AS road_type,
       CASE e.event_id % 5 WHEN 0 THEN 'rain' WHEN 1 THEN 'fog' WHEN 2 THEN NULL ELSE 'clear' END AS weather,
       CASE WHEN e.event_id % 7 < 3 THEN 'low' WHEN e.event_id % 7 < 6 THEN 'high' END AS visibility,
       CASE WHEN e.event_id % 11 = 0 THEN NULL ELSE CAST(e.event_id % 37 AS INT) END AS temperature,
       CASE WHEN e.value >= 150 THEN 'fatal' WHEN e.value >= 60 THEN 'major' ELSE 'minor' END AS accident_severity,
       CASE WHEN e.event_id % 17 = 0 THEN NULL ELSE CAST(e.event_id % 8 AS INT) END AS casualties,
       CASE WHEN e.event_id % 97 = 0 THEN 'Harvest' END AS festival,
       CASE WHEN e.event_id % 23 = 0 THEN NULL ELSE e.value / CAST(400 AS DOUBLE) END AS risk_score
FROM {events} e
JOIN {customer} c ON e.user_id = c.c_custkey
JOIN {nation} n ON c.c_nationkey = n.n_nationkey
JOIN {region} r ON n.n_regionkey = r.r_regionkey
"""

VEHICLES = """
SELECT vid,
       CASE vid % 8 WHEN 0 THEN ' SUV ' WHEN 1 THEN 'motor  cycle' WHEN 2 THEN 'N/A' WHEN 3 THEN 'Truck'
            WHEN 4 THEN 'spaceship' WHEN 5 THEN 'van' WHEN 6 THEN 'CAR' ELSE '?' END AS vehicle_model,
       CASE h % 5 WHEN 0 THEN 'Good' WHEN 1 THEN ' avg' WHEN 2 THEN 'p00r' WHEN 3 THEN 'AVERAGE' ELSE 'bad' END AS maintenance_history,
       CASE h % 9 WHEN 0 THEN 'gasoline' WHEN 1 THEN 'DSL' WHEN 2 THEN 'ev' WHEN 3 THEN 'Hybrid' WHEN 4 THEN 'cng'
            WHEN 5 THEN 'steam' WHEN 6 THEN 'Petrol' WHEN 7 THEN NULL ELSE 'electric' END AS fuel_type,
       CASE h % 4 WHEN 0 THEN 'auto' WHEN 1 THEN 'Manual' WHEN 2 THEN 'AUTOMATIC' ELSE 'null' END AS transmission_type,
       CASE h % 7 WHEN 0 THEN '1st' WHEN 1 THEN 'First  Owner' WHEN 2 THEN '2nd' WHEN 3 THEN 'third' WHEN 4 THEN 'second owner'
            WHEN 5 THEN '4th' ELSE '3rd' END AS owner_type,
       CASE vid % 6 WHEN 0 THEN 'Worn_Out' WHEN 1 THEN 'worn-out' WHEN 2 THEN 'GOOD' WHEN 3 THEN 'new'
            WHEN 4 THEN 'unknown' ELSE NULL END AS tire_condition,
       CASE h % 3 WHEN 0 THEN 'worn out' WHEN 1 THEN 'Good' ELSE ' new ' END AS brake_condition,
       CASE h % 6 WHEN 0 THEN 'WEAK' WHEN 1 THEN 'weak' WHEN 2 THEN 'worn out' WHEN 3 THEN 'new' ELSE 'good' END AS battery_status,
       CASE vid % 7 WHEN 0 THEN concat('$', CAST(vid AS VARCHAR(20))) WHEN 1 THEN concat(CAST(vid AS VARCHAR(20)), ' km')
            WHEN 2 THEN 'three' WHEN 3 THEN '12,5' WHEN 4 THEN '-40' WHEN 5 THEN 'not recorded' ELSE '1,234,567' END AS mileage,
       CASE h % 5 WHEN 0 THEN 'many' WHEN 1 THEN 'None' WHEN 2 THEN '25' ELSE CAST(h % 11 AS VARCHAR(20)) END AS reported_issues,
       CASE WHEN h % 13 = 0 THEN '0' WHEN h % 13 = 1 THEN '31' ELSE CAST(h % 29 AS VARCHAR(20)) END AS vehicle_age,
       CASE vid % 5 WHEN 0 THEN '1.6L' WHEN 1 THEN '1600 cc' WHEN 2 THEN '2.0 l' WHEN 3 THEN '99999' ELSE 'n/a' END AS engine_size,
       concat(CAST(h * 487 AS VARCHAR(20)), ' KM') AS odometer_reading,
       CASE WHEN h % 10 = 0 THEN '1.2.3' ELSE concat('$', CAST(h * 31 AS VARCHAR(20)), '.5') END AS insurance_premium,
       CASE h % 6 WHEN 0 THEN 'ten' WHEN 1 THEN 'multiple' ELSE CAST(h % 33 AS VARCHAR(20)) END AS service_history,
       CASE WHEN h % 8 = 0 THEN 'zero' ELSE CAST(h % 5 AS VARCHAR(20)) END AS accident_history,
       CASE h % 4 WHEN 0 THEN '15.5 km/l' WHEN 1 THEN '12,75' WHEN 2 THEN '3' ELSE '1e1' END AS fuel_efficiency,
       CASE vid % 4 WHEN 0 THEN '2024-03-05' WHEN 1 THEN '03/05/2024' WHEN 2 THEN '25/12/2023' ELSE '1999-01-01' END AS last_service_date,
       CASE vid % 3 WHEN 0 THEN '2023-01-01' WHEN 1 THEN '2026-06-30' ELSE 'null' END AS warranty_expiry_date,
       CASE WHEN h % 3 = 0 AND vid % 9 <> 4 THEN 'Yes' ELSE CASE vid % 9 WHEN 0 THEN 'Yes' WHEN 1 THEN 'no' WHEN 2 THEN 'TRUE' WHEN 3 THEN '0'
            WHEN 4 THEN 'maybe' WHEN 5 THEN 'False' ELSE 'no' END END AS need_maintenance
FROM (SELECT o_orderkey AS vid, (o_orderkey * 7919 + 17) % 1000 AS h FROM {orders}) o
"""

VEHICLES_DUPLICATED = f"SELECT * FROM ({VEHICLES}) a UNION ALL SELECT * FROM ({VEHICLES}) b WHERE vid % 50 = 0"

SIGNALS = """
SELECT l.l_quantity AS x1, l.l_discount AS x2, l.l_tax AS x3, CAST(l.l_linenumber AS DOUBLE) AS x4,
       CAST(p.p_size AS DOUBLE) AS x5, p.p_retailprice AS x6, l.l_extendedprice AS y
FROM {lineitem} l JOIN {part} p ON l.l_partkey = p.p_partkey
"""

SCORED = """
SELECT event_id AS row_id, CASE WHEN event_type IN ('purchase', 'signup') THEN 1 ELSE 0 END AS y,
       CAST(event_id * 7919 % 1000 AS DOUBLE) / CAST(1000 AS DOUBLE) AS p, value, event_type
FROM {events}
"""

PUBLICATIONS = """
SELECT doc_id, doc_id AS seq, concat('http://pub.example.org/en/publications/', CAST(doc_id AS VARCHAR(20))) AS publication_url,
       split_part(text, chr(10), 1) AS title, text AS abstract, source AS author, lang AS organisation,
       CAST(2010 + doc_id % 17 AS VARCHAR(4)) AS year
FROM {documents}
"""

_USED = {
    "incidents": (INCIDENTS, ("events", "customer", "nation", "region")),
    "vehicles": (VEHICLES, ("orders",)),
    "vehicles_duplicated": (VEHICLES_DUPLICATED, ("orders",)),
    "signals": (SIGNALS, ("lineitem", "part")),
    "scored": (SCORED, ("events",)),
    "publications": (PUBLICATIONS, ("documents",)),
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    sql, used = _USED[name]
    frames = {t: table(spark, sf_dir, t) for t in used}
    if "{day_name}" in sql:
        sql = sql.replace("{day_name}", "date_format(e.ts, 'EEEE')")
    df = spark.sql(sql, **frames)
    if name == "publications":
        df = df.withColumn("authors", F.array("author")).withColumn("organisations", F.array("organisation"))
    return df


def sql_view(name: str) -> str:
    """The view's text for the SQL check, where the tables are known by name."""
    sql, used = _USED[name]
    return sql.replace("{day_name}", "dayname(e.ts)").format(**{t: t for t in used})


def with_views(query: str, *names: str, extra: str = "") -> str:
    parts = [f"{n} AS ({sql_view(n)})" for n in names] + ([extra] if extra else [])
    return f"WITH {', '.join(parts)} {query}"
