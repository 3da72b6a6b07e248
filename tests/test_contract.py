import __spark_entry__ as entry
import pytest

FAST = ["ag3_day_hour_counts", "j12_ag25_risk_band_summary", "x8_slug", "ag13_confusion_square", "m3_stratified_split",
        "j6_sl1_rk4_search", "m42_local_line", "m43_m46_joint_posterior", "m33_served_classifier"]


def test_names_line_up():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    rows = entry.entry(spark).collect()
    assert 0 < len(rows) <= 10


@pytest.mark.parametrize("name", FAST)
def test_queries_match_sql(spark, folder, name):
    import duckdb
    from pathlib import Path
    from tools.check import canonical

    con = duckdb.connect()
    for path in Path(folder).glob("*.parquet"):
        con.sql(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    got = canonical(entry.queries()[name](spark, folder).toPandas())
    assert got.equals(canonical(con.sql(entry.oracle_sql()[name]).df()))
