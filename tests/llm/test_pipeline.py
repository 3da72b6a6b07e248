"""The pipeline's stages against brute force, each on its predecessor's documents, and its registration."""

from __future__ import annotations

import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from marlstone.llm import language, token_files
from tests.llm.fixtures import rows
from tests.llm.test_joins import alnum, brute_components, tokenizer_path

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def stages(spark, folder, tmp_path_factory):
    docs, out = spark.read.parquet(f"{folder}/documents.parquet"), {}
    out["documents"] = docs
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path_factory.mktemp("stage") / "out")
        stage(spark, docs, folder).write.parquet(path)
        docs = out[name] = spark.read.parquet(path)
    return out


def test_columns_stay(stages):
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "language ID", "n-gram Jaccard join", "benchmark decontamination", "mixing sources to target weights", "token-ID / binary output"]
    for name, docs in list(stages.items())[:-1]:
        assert docs.columns == COLUMNS, name


def test_language_stage_keeps_documents_with_letters(stages):
    before, after = stages["documents"].collect(), stages["language ID"].collect()
    kept = {r["doc_id"] for r in before if r["text"] and any(c.isalpha() for c in r["text"])}
    assert {r["doc_id"] for r in after} == kept
    truth = {r["doc_id"]: r["lang"] for r in before}
    assert np.mean([truth[r["doc_id"]] == r["lang"] for r in after]) > 0.97


def test_join_stage_keeps_one_of_each_group(stages):
    data = [tuple(r) for r in stages["language ID"].collect()]
    want = {c for (k, n, c, d), _ in brute_components(data).items()}
    assert sorted(r["doc_id"] for r in stages["n-gram Jaccard join"].collect()) == sorted(want)


def test_decontamination_stage(spark, folder, stages):
    windows = defaultdict(set)
    for item in spark.read.parquet(f"{folder}/benchmark.parquet").collect():
        w = alnum(item["text"])
        n = min(13, len(w))
        windows[n].update(tuple(w[k:k + n]) for k in range(len(w) - n + 1))
    want = []
    for r in stages["n-gram Jaccard join"].collect():
        w, hit = alnum(r["text"]), set()
        for n, own in windows.items():
            for k in range(len(w) - n + 1):
                if tuple(w[k:k + n]) in own:
                    hit.update(range(k, k + n))
        if not (hit and 20 * len(hit) >= len(w)):
            want.append(r["doc_id"])
    assert sorted(r["doc_id"] for r in stages["benchmark decontamination"].collect()) == sorted(want)


def test_mixing_stage(stages):
    before = {r["doc_id"]: r for r in stages["benchmark decontamination"].collect()}
    after = stages["mixing sources to target weights"].collect()
    copies = Counter(r["doc_id"] for r in after)
    assert all(before[r["doc_id"]] == r for r in after) and max(copies.values()) <= 2
    size = {k: len(r["text"].split()) for k, r in before.items()}
    total = sum(copies[k] * size[k] for k in before)
    assert abs(total / sum(size.values()) - 1.5) < 0.02


def test_token_stage(stages):
    from tokenizers import Tokenizer

    encoder = Tokenizer.from_file(tokenizer_path())
    docs = sorted(stages["mixing sources to target weights"].collect(), key=lambda r: r["doc_id"])
    got = stages["token-ID / binary output"].orderBy("start").collect()
    start = 0
    for doc, r in zip(docs, got, strict=True):
        ids = np.array(encoder.encode(doc["text"], add_special_tokens=False).ids + [token_files.END], "<u4")
        assert tuple(r) == (doc["doc_id"], start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)


def test_stages_take_odd_rows(spark, folder, monkeypatch):
    monkeypatch.setattr(language, "STEPS", 20)
    data = [(r[0], r[1], r[2], r[3], None) for r in rows()[:30] + rows()[40:47]]
    docs = spark.createDataFrame(data, "doc_id long, text string, lang string, source string, n_chars long")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs.limit(0), folder).collect() == [], name
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, folder).cache()
        assert docs.count() > 0


def test_language_stage_without_labels_keeps_documents(spark, folder):
    data = [(k, t, lang, "s", None) for k, (t, lang) in enumerate([("One two", None), ("", None), (None, None), ("12 %", None), ("drei", None)])]
    own = next(k for k in range(100, 200) if zlib.crc32(str(k).encode()) % 4 == 2)
    data.append((own, "held out", "aa", "s", None))
    docs = spark.createDataFrame(data, "doc_id long, text string, lang string, source string, n_chars long")
    got = {r["doc_id"]: r["lang"] for r in corpus_pipeline.identify_language(spark, docs, folder).collect()}
    assert got == {0: None, 4: None, own: "aa"}


def test_every_operator_is_registered():
    names = list(entry.queries())
    for n in range(1, 11):
        assert sum(name.startswith(f"op{n}_") for name in names) == 1
    assert "pipeline" in names and {"op2_threshold_top_k", "op3_ngram_jaccard_join", "op6_line_chunks", "op7_fm_index_decontamination"} <= set(entry.oracle_sql())


def test_shuffle_files_of_an_ended_stage_are_given_back(spark):
    import time
    from pathlib import Path

    import corpus_pipeline

    folders = list(spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString())
    files = lambda: sum(len(list(Path(f).rglob("shuffle_*"))) for f in folders)
    stage = corpus_pipeline.small_batches(lambda spark, docs, folder: docs)
    stage(spark, spark.range(1), "")
    time.sleep(3)
    before = files()
    table = spark.range(1000).repartition(5, "id")
    assert len(table.collect()) == 1000 and files() > before
    del table
    for _ in range(20):
        stage(spark, spark.range(1), "")
        if files() <= before:
            break
        time.sleep(0.5)
    assert files() <= before


def test_join_gives_back_its_shuffles_before_texts_are_dealt(spark, monkeypatch):
    from marlstone.llm import ngram_join

    seen, told = [], ngram_join._told
    monkeypatch.setattr(ngram_join, "release_shuffles", lambda s: seen.append("released"), raising=False)
    monkeypatch.setattr(ngram_join, "_told", lambda *a: seen.append("told") or told(*a))
    docs = spark.createDataFrame([(i, f"one two three four five six {i % 3}") for i in range(6)], "doc_id long, text string")
    assert sorted(r["doc_id"] for r in ngram_join.drop_linked(docs).collect()) == [0, 1, 2]
    assert seen == ["released", "told"]
