"""Classifiers by held-out accuracy and gradients; search, sharding and mixing against brute force."""

from __future__ import annotations

import copy
import random
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest

from marlstone.llm import convolution, gru, language, mixing, placement, quality, shape, topk, toxicity
from marlstone.llm.texts import ALNUM, SPACED, hashes, slices, words
from tests.llm.fixtures import SCHEMA, prose, rows


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(rows(), SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def labelled(spark):
    rng = random.Random(8)
    data, marks = [], []
    for i in range(420):
        lang = "aa" if i % 2 else "bb"
        text = prose(rng, lang, rng.choice([20, 60, 150]))
        toxic, good = int(rng.random() < 0.35), int(rng.random() < 0.75)
        if toxic:
            spot = text.split(" ")
            spot.insert(rng.randrange(len(spot)), rng.choice(["vileword", "grimword"] if lang == "aa" else ["übelwort", "bösewort"]))
            text = " ".join(spot)
        if not good:
            text = " ".join(w + "%%%" for w in text.split(" "))
        data.append((i, text, lang))
        if i % 3:
            marks.append((i, good, toxic))
    marks += [(None, 1, 1), (5000, 1, 0), (7, None, None), marks[0]]
    return (spark.createDataFrame(data, "doc_id long, text string, lang string"),
            spark.createDataFrame(marks, "doc_id long, quality int, toxic int"), marks)


# --- text helpers

def test_slices_and_words():
    texts = ["One  two\tthree", None, "", "äö x-y 7Z", "a" * 50, "b"]
    for limit in (1, 20, 1000):
        got = []
        for first, last, data, at in slices(pa.array(texts).slice(0), limit):
            starts, ends, index = words(data, at, SPACED)
            own = [bytes(data[a:b]).decode() for a, b in zip(starts, ends)]
            got += [own[a:b] for a, b in zip(index[:-1], index[1:])]
            assert last > first
        assert got == [(t or "").split() for t in texts]
    _, _, data, at = next(slices(pa.array(["x-y Ab aB AB"])))
    starts, ends, _ = words(data, at, ALNUM)
    names = hashes(data, starts, ends)
    assert len(names) == 5 and len(set(names.tolist())) == 3


# --- language

def test_gru_gradients():
    rng = np.random.default_rng(0)
    net = gru.new_network(3, 4, rng)
    codes = rng.integers(0, 256, (6, 5))
    codes[4:, 0] = gru.PAD
    labels = rng.integers(0, 3, 5)
    _, found = gru.gradients(net, codes, labels)
    values = [net.ahead.table, net.ahead.weight, net.ahead.bias, net.back.table, net.back.weight, net.back.bias, net.out, net.out_bias]
    for value, grad in zip(values, found):
        place = np.unravel_index(np.abs(grad).argmax(), grad.shape)
        kept, losses = value[place], []
        for step in (1e-2, -1e-2):
            value[place] = kept + step
            losses.append(gru.gradients(net, codes, labels)[0])
        value[place] = kept
        assert abs((losses[0] - losses[1]) / 2e-2 - grad[place]) < 2e-3


def test_padding_changes_nothing():
    net = gru.new_network(2, 4, np.random.default_rng(2))
    text = np.frombuffer(b"some text", np.uint8).astype(np.int64)
    padded = np.concatenate([text, np.full(30, gru.PAD)])
    assert np.allclose(gru.label_windows(net, text[:, None]), gru.label_windows(net, padded[:, None]), atol=1e-5)


def test_language(docs, empty, labelled, monkeypatch):
    monkeypatch.setattr(language, "STEPS", 60)
    model = language.fit(labelled[0])
    assert model[1] == ["aa", "bb"]
    got = language.identify(docs, model).collect()
    assert len(got) == len(rows())
    for r in got:
        row = r["row"]
        assert 0 <= r["score"] <= 1 and row["row"] in ("x", None)
        if row["text"] is None or not any(c.isalpha() for c in row["text"]):
            assert (r["lang_pred"], r["score"]) == ("und", 0)
        elif len(row["text"]) > 150 and row["lang"]:
            assert r["lang_pred"] == row["lang"]
    assert {r["lang_pred"] for r in language.identify(docs, None).collect()} == {"und"}
    assert language.fit(empty) is None and language.identify(empty, model).collect() == []


# --- quality and toxicity

def test_quality_on_held_out(labelled, docs, empty, monkeypatch):
    monkeypatch.setattr(quality, "STEPS", 300)
    data, table, marks = labelled
    model = quality.fit(data.where("doc_id % 5 <> 0"), table.where("doc_id % 5 <> 0"))
    assert 0.6 < model.prior < 0.95  # 0.75 of the texts are good
    got = {r["row"]["doc_id"]: r for r in quality.score(data, model).collect()}
    right = [got[i]["predicted"] == q for i, q, _ in marks if i in got and q is not None and i % 5 == 0]
    assert len(right) > 40 and np.mean(right) > 0.9
    odd = quality.score(docs, model).collect()
    assert len(odd) == len(rows()) and all(0 <= r["score"] <= 1 for r in odd)
    assert quality.fit(data, table.limit(0)) is None and quality.fit(empty, table) is None
    assert {r["score"] for r in quality.score(docs, None).collect()} == {0.0}


def test_class_prior():
    rng = np.random.default_rng(0)
    p = rng.normal(2, 1, 4000)
    for share in (0.2, 0.6, 0.9):
        n = int(4000 * share)
        u = np.concatenate([rng.normal(2, 1, n), rng.normal(-2, 1, 4000 - n)])
        assert abs(quality.class_prior(p, u) - share) < 0.07


def test_non_negative_risk_does_not_learn_unlabelled_positives_as_negatives():
    rng = np.random.default_rng(1)
    good, bad = np.zeros((300, shape.SIZE)), np.zeros((100, shape.SIZE))
    good[:, :2], bad[:, :2] = rng.normal(1, 0.3, (300, 2)), rng.normal(-1, 0.3, (100, 2))
    model = quality.train(good[:150], np.concatenate([good[150:], bad]), 0.6, 200)
    assert (model.margin(good) > 0).mean() > 0.95 and (model.margin(bad) < 0).mean() > 0.95


def test_toxicity_on_held_out(labelled, docs, empty):
    data, table, marks = labelled
    model = toxicity.fit(data.where("doc_id % 5 <> 0"), table.where("doc_id % 5 <> 0"))
    got = {r["row"]["doc_id"]: r for r in toxicity.score(data, model).collect()}
    right = [got[i]["predicted"] == t for i, _, t in marks if i in got and t is not None and i % 5 == 0]
    assert len(right) > 40 and np.mean(right) > 0.9
    odd = toxicity.score(docs, model).collect()
    assert len(odd) == len(rows()) and all(0 <= r["score"] <= 1 for r in odd)
    assert toxicity.fit(data, table.limit(0)) is None and toxicity.fit(empty.select("doc_id", "text", "lang"), table) is None
    assert {r["predicted"] for r in toxicity.score(docs, None).collect()} == {0}


def test_best_cut():
    assert 1 < toxicity.best_cut(np.array([3.0, 0.5, 1.0, 2.0]), np.array([1, 0, 0, 1])) < 2


def test_toxicity_is_fitted_on_every_marked_row_by_shards(spark, monkeypatch):
    """More rows than the former sample held, dealt to shards: all are counted, and all shards are trained on."""
    words = "red green blue grey pink gold".split()
    data = [(i, f"{words[i % 6]} {words[i % 5]} {'vile' if i % 4 == 0 else 'kind'} {words[i % 3]}", "en", int(i % 4 == 0)) for i in range(7000)]
    docs = spark.createDataFrame(data, "doc_id long, text string, lang string, toxic int").repartition(3)
    seen, begin = [], convolution.begin
    monkeypatch.setattr(toxicity, "SHARD_CHARS", 40_000)
    monkeypatch.setattr(toxicity, "EPOCHS", 2)
    monkeypatch.setattr(toxicity.cnn, "begin", lambda rng, counts, totals, languages: seen.append((counts, totals)) or begin(rng, counts, totals, languages))
    model = toxicity.fit(docs.drop("toxic"), docs.select("doc_id", "toxic"))
    (counts, totals), = seen
    kept = docs.where("pmod(xxhash64(doc_id, 23), 5) <> 0")
    bad, good = kept.where("toxic = 1").count(), kept.where("toxic = 0").count()
    assert totals == (bad + 1, good + 1) and bad + good > 5000
    (vile, _, _), _ = _words(["vile kind"])
    assert counts[0][:, vile].T.tolist() == [[bad, 0], [0, good]]
    assert {(r["row"]["toxic"], r["predicted"]) for r in toxicity.score(docs, model).collect()} == {(0, 0), (1, 1)}


def test_shards_are_joined_by_the_mean_of_those_that_moved():
    rows_, first, marks = _marked([("a bad b", 1), ("a b", 0)] * 8)
    counts = convolution.kind_counts(rows_, first, marks.astype(float))
    before = convolution.begin(np.random.default_rng(1), counts, (9.0, 9.0), 0)
    after = []
    for k in range(2):
        one = copy.deepcopy(before)
        convolution.advance(one, rows_, first, marks, np.full(16, -1), np.arange(16), np.random.default_rng(k), 3)
        after.append(one)
    total = [x + y for x, y in zip(*[convolution.moved(before, one, 16) for one in after])]
    got = convolution.joined(before, total)
    for mean, one, two in zip(got.values(), after[0].values(), after[1].values()):
        assert np.allclose(mean, (one + two) / 2, atol=1e-6)
    change = [one.model.tables[0] - before.model.tables[0] for one in after]
    moved = np.maximum(sum((one.pace[0] > before.pace[0]).astype(int) for one in after), 1)
    assert np.allclose(got.model.tables[0] - before.model.tables[0], sum(change) / moved[:, None], atol=1e-6) and got.step == after[0].step


def test_cut_of_counted_scores():
    score, bad = np.array([0.5, 0.5, 1.0, 2.0, 3.0, 3.0]), np.array([0, 0, 0, 1, 1, 1])
    counted = toxicity.best_cut(np.array([0.5, 1.0, 2.0, 3.0]), np.array([0, 0, 1, 2]), np.array([2, 1, 0, 0]))
    assert counted == toxicity.best_cut(score, bad) == 1.5


def test_convolution_pools_whole_texts():
    model = convolution.train(*_marked([("a b", 0), ("a bad b", 1)] * 60), np.full(120, -1), 0, 6)
    model.cuts = np.zeros(1)
    rows_, first = _words(["x " * 3000 + "bad", "x " * 3000, ""])
    score = convolution.scores(model, rows_, first)[:, 0]
    assert score[0] > score[1] and len(score) == 3


def _words(texts):
    _, _, data, at = next(slices(pa.array(texts), 1 << 30))
    return convolution.word_rows(data, at)


def _marked(pairs):
    return *_words([t for t, _ in pairs]), np.array([m for _, m in pairs])


# --- search

def brute_top(vectors, asked, k):
    out = Counter()
    sound = [(i, np.floor(1024 * np.array(v)).astype(int)) for i, v in vectors if v is not None and i is not None
             and all(x is not None and np.isfinite(x) for x in v)]
    for q, v in sound:
        if asked(q):
            best = sorted(((-int(v @ w), c) for c, w in sound if c != q and len(w) == len(v)))[:k]
            out.update((q, n + 1, c, -s) for n, (s, c) in enumerate(best))
    return out


@pytest.mark.parametrize("depth, shard", [(2, 16), (64, 1 << 14)])
def test_top_k_matches_brute_force(spark, monkeypatch, depth, shard):
    monkeypatch.setattr(topk, "DEPTH", depth)
    monkeypatch.setattr(topk, "SHARD_ROWS", shard)
    monkeypatch.setattr(topk, "QUERY_ROWS", 3)
    rng = np.random.default_rng(3)
    data = [(i, [float(x) for x in rng.normal(0, 0.1, 6)]) for i in range(90)]
    data += [(100 + i, [0.25] * 6) for i in range(15)] + [(200, [0.0] * 6), (300, None), (301, [1.0, None]), (302, [float("nan")] * 6),
             (303, [1.0, 2.0]), (304, [float("inf")] * 6), (None, [0.1] * 6), (310, [])]
    table = spark.createDataFrame(data, "vec_id long, embedding array<float>").repartition(3)
    stored = [(r["vec_id"], r["embedding"]) for r in table.collect()]
    got = topk.top_k(table, table.where("vec_id % 20 = 0 OR vec_id > 290"), 10)
    assert Counter(map(tuple, got.collect())) == brute_top(stored, lambda q: q % 20 == 0 or q > 290, 10)
    assert topk.top_k(table, table.limit(0)).collect() == []
    assert topk.top_k(table.limit(0), table).collect() == []


def test_threshold_stops_early(monkeypatch):
    monkeypatch.setattr(topk, "DEPTH", 4)
    rng = np.random.default_rng(5)
    vectors = rng.integers(0, 1000, (5000, 2))
    lists = topk.SortedLists(np.arange(5000), vectors)
    score, key = lists.search(np.array([3, 2]), -1, 10, None)
    full = vectors @ np.array([3, 2])
    assert sorted(full)[-10:] == sorted(score.tolist()) and lists.looked_up < 2500


# --- sharding

def test_lookup_table():
    names = placement.shard_names(20)
    table = placement.lookup_table(names, 997)
    counts = np.bincount(table, minlength=20)
    assert counts.min() >= 49 and counts.max() <= 50
    assert [names[i] for i in table] == [sorted(names)[i] for i in placement.lookup_table(sorted(names), 997)]
    # Brute force of the turns: each claims the first free slot of its own permutation.
    fewer = placement.lookup_table(names[:-1], 997)
    kept = table != 19
    assert (fewer[kept] != table[kept]).mean() < 0.2
    for bad in ((names, 10), ([], 997), (["a", "a"], 997)):
        with pytest.raises(ValueError):
            placement.lookup_table(*bad)


def test_place(spark, docs, empty):
    names = placement.shard_names(7)
    got = placement.place(docs, names, slots=101).collect()
    table = placement.lookup_table(names, 101)
    assert len(got) == len(rows()) and all(r["shard"] == names[table[r["slot"]]] for r in got)
    by_key = defaultdict(set)
    for r in got:
        by_key[r["row"]["doc_id"]].add(r["shard"])
    assert all(len(s) == 1 for s in by_key.values())
    assert placement.place(empty, names).collect() == []


# --- mixing

def test_targets():
    sizes = pd.DataFrame({"source": ["b", None, "a", "c"], "source_size": [1000, 10, 400, 5000]})
    got = mixing.targets(sizes)
    assert got["source"].tolist() == ["a", "b", "c", None]
    # a (5) stops at 800, None (5) at 20; b and c share the rest 2 to 1, b stops at 2000.
    assert np.allclose(got["target"], [800, 2000, 1.5 * 6410 - 2820, 20])


def test_mix(docs, empty):
    data = rows()
    got = mixing.mix(docs).collect()
    assert len(got) == len(data)
    size, taken, target = Counter(), Counter(), {}
    for r in got:
        n = len((r["row"]["text"] or "").split())
        assert r["size"] == n and r["copies"] in (0, 1, 2)
        size[r["row"]["source"]] += n
        taken[r["row"]["source"]] += n * r["copies"]
        target[r["row"]["source"]] = r["target"]
    want = mixing.targets(pd.DataFrame({"source": pd.Series(list(size), dtype=object), "source_size": list(size.values())}))
    for s, t in zip(want["source"], want["target"]):
        assert abs(target[s] - t) < 1e-6
        # One document holds most words of s1, so its target cannot be met closely.
        assert abs(taken[s] - t) <= (max(5, 0.01 * t) if s != "s1" else 3000)
    again = mixing.mix(docs.repartition(7)).collect()
    key = lambda x: Counter((r["row"]["doc_id"], r["row"]["text"], r["copies"]) for r in x)
    assert key(got) == key(again)
    assert mixing.mix(empty).collect() == []


def test_balance_solves_the_dual(spark):
    rng = np.random.default_rng(0)
    table = pd.DataFrame({"id": rng.integers(0, 3, 400), "size": rng.integers(1, 500, 400), "docs": rng.integers(1, 9, 400)})
    table = table.groupby(["id", "size"], as_index=False)["docs"].sum()
    table["scale"] = table.groupby("id")["size"].transform("max")
    words_ = (table["size"] * table["docs"]).groupby(table["id"]).sum()
    wanted = pd.DataFrame({"source": list("abc"), "source_size": words_.to_numpy(), "target": words_.to_numpy() * [0.05, 1.3, 1.99]})
    got = mixing.balance(spark.createDataFrame(table), wanted)
    tilt = table["id"].map(dict(zip(got["id"], got["tilt"])))
    rate = 2 / (1 + np.exp(-tilt * table["size"] / table["scale"]))
    reached = (rate * table["size"] * table["docs"]).groupby(table["id"]).sum()
    assert np.allclose(reached, wanted["target"], rtol=1e-6)
