"""Search of many queries over dealt blocks: the same rows as scoring every document, with blocks skipped."""

from __future__ import annotations

import math
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pytest

from marlstone.functions import fixed, text
from marlstone.operators import search


def corpus(n=300):
    rng = random.Random(5)
    pool = [f"w{k}" for k in range(60)]
    weights = [1 / (k + 1) for k in range(60)]
    docs = [(i, " ".join(rng.choices(pool, weights, k=rng.choice([0, 1, 5, 40, 90])))) for i in range(n)]
    docs += [(n + k, docs[7][1]) for k in range(20)] + [(n + 20, None), (n + 21, "")]  # equal scores
    queries = [(q, " ".join(rng.choices(pool, k=rng.choice([1, 2, 6])))) for q in range(25)] + [(25, "unknown"), (26, "the"), (27, "w0 w0 w1 W0")]
    return docs, queries


def brute(docs, queries, top_k):
    terms = {i: Counter(text.query_terms(t or "")) for i, t in docs}
    length = {i: sum(c.values()) for i, c in terms.items()}
    mean, n = sum(length.values()) / len(docs), len(docs)
    df = Counter(t for c in terms.values() for t in c)
    out = set()
    for q, words in queries:
        asked, scores = Counter(text.query_terms(words)), {}
        for i, own in terms.items():
            score = sum(
                w * math.log1p((n - df[t] + 0.5) / (df[t] + 0.5)) * own[t] * (fixed.BM25_K1 + 1)
                / (own[t] + fixed.BM25_K1 * (1 - fixed.BM25_B + fixed.BM25_B * length[i] / mean))
                for t, w in asked.items() if own[t])
            if score:
                scores[i] = round(score, 9)
        best = sorted(scores, key=lambda i: (-scores[i], i))[:top_k]
        out |= {(q, r + 1, i, round(scores[i], 4)) for r, i in enumerate(best)}
    return out


@pytest.mark.parametrize("tokens, block, group", [(1 << 22, 128, 4096), (700, 4, 6), (1, 1, 1000)])
def test_search_many_matches_scoring_every_document(spark, tmp_path, monkeypatch, tokens, block, group):
    monkeypatch.setattr(search, "SHARD_TOKENS", tokens)
    monkeypatch.setattr(search, "BLOCK_DOCS", block)
    monkeypatch.setattr(search, "QUERY_BLOCK", group)
    docs, queries = corpus()
    table = spark.createDataFrame(docs, "doc_id long, body string").repartition(3)
    asked = spark.createDataFrame(queries, "query_id long, query string")
    index = search.build_index(table, "body")
    want = brute(docs, queries, 5)
    assert {tuple(r) for r in search.search_many(index, asked, 5).collect()} == want
    saved = search.save_index(index, str(tmp_path / "index"))
    assert {tuple(r) for r in search.search_many(saved, asked, 5).collect()} == want
    assert search.search_many(saved, asked.limit(0), 5).collect() == []


def test_no_pair_of_query_and_document_is_shuffled(spark, tmp_path):
    docs, queries = corpus()
    table = spark.createDataFrame(docs, "doc_id long, body string").coalesce(1)
    asked = spark.createDataFrame(queries, "query_id long, query string")
    index = search.save_index(search.build_index(table, "body"), str(tmp_path / "index"))
    plan = search.search_many(index, asked, 3)._jdf.queryExecution().executedPlan().toString()
    exchanges = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    assert exchanges and not any("query_id" in line and "doc_id" in line for line in exchanges)



def test_blocks_that_cannot_win_are_not_read(monkeypatch):
    monkeypatch.setattr(search, "BLOCK_DOCS", 4)
    docs = [["common"] * (1 + k % 3) + ["rare"] * (k < 10) + ["other"] * (k % 7) for k in range(200)]
    blocks = search._deal(pa.table({"part": [0] * 200, "doc_id": range(200), "terms": docs}), 0)
    gains = {"common": 0.1, "rare": 3.0}
    asked = pa.table({"query_id": [1, 1], "term": list(gains), "gain": list(gains.values())})
    found = blocks.filter(pc.is_in(blocks["term"], pa.array(list(gains))))
    read, original = [], np.repeat
    monkeypatch.setattr(np, "repeat", lambda a, n: read.append(len(n)) or original(a, n))
    got = search._best_of_shard(3, 1.2, 0.75, 5.0)(found, asked)
    monkeypatch.undo()
    everything = search._best_of_shard(300, 1.2, 0.75, 5.0)(found, asked)
    assert got["doc_id"].to_pylist() == everything["doc_id"].to_pylist()[:3]
    assert read == [3, 3] and found.num_rows == 53


def test_a_shard_ends_within_a_batch(monkeypatch):
    monkeypatch.setattr(search, "SHARD_TOKENS", 100)
    sizes = [30, 0, 40, 50, 7, 200, 0, 99, 1, 3]
    whole = pa.record_batch({"part": [8] * 10, "doc_id": range(10), "terms": [["a"] * n for n in sizes]})
    for batches in ([whole], [whole.slice(0, 4), whole.slice(4, 0), whole.slice(4)]):
        dealt = pa.Table.from_batches(search._dealt(iter(batches)))
        every = dealt.filter(pc.equal(dealt["term"], "")).to_pylist()
        assert [(r["shard"], r["docs"]) for r in every] == [(8, [0, 1, 2, 3]), (9, [4, 5]), (10, [6, 7, 8]), (11, [9])]
        assert sum(map(sum, dealt.filter(pc.equal(dealt["term"], "a"))["tfs"].to_pylist())) == sum(sizes)
