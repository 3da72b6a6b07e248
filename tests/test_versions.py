import pytest

from marlstone import session
from marlstone.operators import explore, textclass
from marlstone.sources import files, versions

ROW = "n int"


def numbers(spark, folder):
    return sorted(r["n"] for r in files.read_records(spark, folder, ROW).collect())


def test_a_reader_finds_a_whole_version_between_all_steps(spark, tmp_path):
    folder = str(tmp_path / "t")
    assert versions.current(spark, folder) is None and numbers(spark, folder) == []
    files.write_json(spark.range(3).selectExpr("CAST(id AS INT) AS n"), folder)
    assert versions.current(spark, folder) == folder and numbers(spark, folder) == [0, 1, 2]

    files.replace_records(spark, files.read_records(spark, folder, ROW).selectExpr("n + 10 AS n"), folder)
    assert numbers(spark, folder) == [10, 11, 12]
    reader = files.read_records(spark, folder, ROW)
    name = versions.write_version(spark, folder, lambda f: reader.selectExpr("n + 10 AS n").write.json(f))
    assert numbers(spark, folder) == [10, 11, 12]
    versions.point_to(spark, folder, name)
    assert numbers(spark, folder) == [20, 21, 22]
    assert sorted(r["n"] for r in reader.collect()) == [10, 11, 12]
    versions.drop_old(spark, folder, keep=1)
    assert numbers(spark, folder) == [20, 21, 22] and len(list((tmp_path / "t").glob("v-*"))) == 1


def test_a_writer_that_fails_leaves_the_former_version(spark, tmp_path):
    folder = str(tmp_path / "t")
    files.replace_records(spark, spark.createDataFrame([(1,)], ROW), folder)

    def fails(path):
        spark.createDataFrame([(2,)], ROW).write.json(path)
        raise OSError("lost")

    with pytest.raises(OSError):
        versions.publish(spark, folder, fails)
    assert numbers(spark, folder) == [1]
    for n in (3, 4, 5):
        files.replace_records(spark, spark.createDataFrame([(n,)], ROW), folder)
    assert numbers(spark, folder) == [5] and len(list((tmp_path / "t").glob("v-*"))) == 2


def test_a_single_file_is_read_as_it_is(spark, tmp_path):
    (tmp_path / "r.jsonl").write_text('{"n": 7}\n\n')
    assert numbers(spark, str(tmp_path / "r.jsonl")) == [7]


TEXTS = [(1, "red apple pie", "food"), (2, "green apple tart", "food"), (3, "fast red car", "cars"), (4, "slow green car", "cars"), (5, None, "cars")]


def test_a_saved_classifier_answers_alike_in_a_table_and_a_stream(spark, tmp_path):
    docs = spark.createDataFrame(TEXTS, "doc_id bigint, text string, label string")
    folder = str(tmp_path / "model")
    with pytest.raises(FileNotFoundError):
        textclass.SavedClassifier(spark, folder)
    priors, terms = textclass.fit_classifier(docs, "doc_id", "text", "label")
    textclass.save_classifier(spark, folder, priors, terms)
    model = textclass.SavedClassifier(spark, folder)
    new = spark.createDataFrame([(10, "apple"), (11, "a car, a car"), (12, ""), (13, None), (14, "unseen")], "doc_id bigint, text string")
    want = {r["doc_id"]: r for r in textclass.classify(textclass.term_counts(new, "doc_id", "text"), new, priors, terms, "doc_id").collect()}
    assert want[10]["prediction"] == "food" and {want[i]["prediction"] for i in (11, 12, 13, 14)} == {"cars"}
    assert {r["doc_id"]: r for r in model.classify(new, "doc_id", "text").collect()} == want

    arriving, out = str(tmp_path / "in"), str(tmp_path / "out")

    def serve():
        stream = spark.readStream.schema(new.schema).parquet(arriving)
        model.classify_stream(stream, "doc_id", "text", out, str(tmp_path / "progress")).awaitTermination()
        return {r["doc_id"]: r for r in spark.read.parquet(out).drop("batch").collect()}

    new.filter("doc_id < 13").write.parquet(arriving)
    assert serve() == {i: want[i] for i in (10, 11, 12)}
    new.filter("doc_id >= 13").write.mode("append").parquet(arriving)
    assert serve() == want and serve() == want


def test_a_newer_model_leaves_a_loaded_one_alone(spark, tmp_path):
    docs = spark.createDataFrame(TEXTS, "doc_id bigint, text string, label string")
    folder = str(tmp_path / "model")
    textclass.save_classifier(spark, folder, *textclass.fit_classifier(docs, "doc_id", "text", "label"))
    old = textclass.SavedClassifier(spark, folder)
    textclass.save_classifier(spark, folder, *textclass.fit_classifier(docs.replace("food", "dish"), "doc_id", "text", "label"), stopwords=["car"])
    new, probe = textclass.SavedClassifier(spark, folder), spark.createDataFrame([(1, "apple pie")], "doc_id bigint, text string")
    assert new.stopwords == ["car"] and new.version != old.version
    assert [m.classify(probe, "doc_id", "text").first()["prediction"] for m in (old, new)] == ["food", "dish"]


def test_a_scope_frees_persisted_tables(spark):
    held = lambda: spark.sparkContext._jsc.getPersistentRDDs().size()
    before = held()
    with session.SettledTables() as outer:
        with session.SettledTables():
            inner = session._owned(spark.range(10).persist())
            assert inner.count() == 10 and held() == before + 1
        assert held() == before and not inner.is_cached and not outer.tables


def test_a_scope_deletes_checkpoint_files(spark, tmp_path):
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(spark.conf.get("spark.checkpoint.dir", str(tmp_path)))
    with session.SettledTables() as scope:
        rows = session._owned(spark.range(10).selectExpr("id * 2 AS n").checkpoint())
        assert rows.agg({"n": "sum"}).first()[0] == 90
        path = spark._jvm.org.apache.hadoop.fs.Path(session._checkpoint_file(scope.tables[0]))
        files_of = path.getFileSystem(spark._jsc.hadoopConfiguration())
        assert files_of.exists(path)
    assert not files_of.exists(path)


def test_local_line(spark):
    import numpy as np

    rng = np.random.default_rng(3)
    x = rng.uniform(0, 10, 400)
    y = np.sin(x) * 3 + x
    rows = [(float(a), float(b)) for a, b in zip(x, y)] + [(None, 1.0), (float("nan"), 1.0), (1.0, float("inf")), (2.0, None)]
    df = spark.createDataFrame(rows, "x double, y double")
    got = explore.local_line(df, "x", "y", span=0.2, cells=2000).collect()
    assert sum(r["n"] for r in got) == 400
    # With cells far narrower than the span the line is that of single rows.
    for r in got[::20]:
        d = np.abs(x - r["x"])
        w = np.clip(1 - (d / np.sort(d)[79]) ** 3, 0, None) ** 3
        slope, level = np.polyfit(x - r["x"], y, 1, w=np.sqrt(w))
        assert abs(level - r["fitted"]) < 0.02 and abs(slope - r["slope"]) < 0.05
    line = explore.local_line(spark.range(50).selectExpr("CAST(id AS DOUBLE) AS x", "2.0D * id + 1 AS y"), "x", "y", cells=10)
    assert all(abs(r["slope"] - 2) < 1e-9 and abs(r["fitted"] - 2 * r["x"] - 1) < 1e-9 for r in line.collect())
    (flat,) = explore.local_line(spark.createDataFrame([(4.0, 1.0), (4.0, 3.0)], "x double, y double"), "x", "y").collect()
    assert (flat["n"], flat["x"], flat["slope"], flat["fitted"]) == (2, 4.0, 0.0, 2.0)
    assert explore.local_line(df.limit(0), "x", "y").count() == 0
