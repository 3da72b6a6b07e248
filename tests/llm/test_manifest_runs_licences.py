"""Merkle proofs, periodic runs and the licence scan against brute force."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from marlstone.llm import licences, merkle, periodic
from tests.llm.fixtures import SCHEMA, rows

UPPER = {c: c + 32 for c in range(65, 91)}


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(rows(), SCHEMA).repartition(5)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# --- manifest

def leaf(values):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def tree(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        last = levels[-1]
        levels.append([sha("".join(last[k:k + 2])) for k in range(0, len(last), 2)])
    return levels


def walk(levels, place):
    path = []
    for level in levels[:-1]:
        run = level[place // 2 * 2:place // 2 * 2 + 2]
        path.append([(j % 2 == 0, x) for j, x in enumerate(run, place // 2 * 2) if j != place])
        place //= 2
    return path


def brute_manifest(data, fields, key, group, changed):
    """Straight from the definition: whole trees in memory, every path taken from them."""
    groups = {}
    for r in data:
        own = [r[f] for f in fields]
        groups.setdefault(r[group], []).append((r[key], leaf(own), leaf(changed(r, own))))
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {}
    for g in order:
        groups[g].sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
        trees[g] = tree([x[1] for x in groups[g]])
    upper = tree([trees[g][-1][0] for g in order])
    out = Counter()
    for at, g in enumerate(order):
        for place, (name, own, claim) in enumerate(groups[g]):
            path = walk(trees[g], place) + walk(upper, at)
            for step in path:
                claim = sha(claim if not step else step[0][1] + claim if step[0][0] else claim + step[0][1])
            proof = sha("".join(x for step in path for _, x in step))
            out[name, own, trees[g][-1][0], upper[-1][0], proof, claim, claim == upper[-1][0]] += 1
    return out


@pytest.mark.parametrize("tier, part", [(14, 1 << 13), (1, 1), (2, 5), (3, 4)])
def test_manifest_matches_brute_force(docs, monkeypatch, tier, part):
    monkeypatch.setattr(merkle, "TIER", tier)
    monkeypatch.setattr(merkle, "PART_LEAVES", part)
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    got = merkle.manifest(docs, ["doc_id", "lang", "text", "node"], node=F.when(hit, F.col("node") + 1).otherwise(F.col("node")))
    names = SCHEMA.replace(",", "").split()[::2]
    data = [dict(zip(names, r)) for r in rows()]

    def changed(r, own):
        more = r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 3 == 0 and r["node"] is not None
        return [*own[:3], own[3] + 1] if more else own

    want = brute_manifest(data, ["doc_id", "lang", "text", "node"], "doc_id", "lang", changed)
    assert Counter(map(tuple, got.collect())) == want
    assert {k[-1] for k in want} == {True, False}


@pytest.mark.parametrize("n", [1, 2, 3, 7, 8, 13, 64])
def test_multiproof_is_minimal_and_suffices(n):
    rng = random.Random(n)
    levels = tree([sha(str(k)) for k in range(n)])
    for _ in range(20):
        wanted = sorted(rng.sample(range(n), rng.randint(1, n)))
        need = merkle.missing(np.array(wanted), n)
        assert len(need) == len(set(need))
        known = merkle.derive(wanted, n, [levels[0][k] for k in wanted], [(a, b, levels[a][b]) for a, b in need])
        for k in wanted:
            assert merkle.fold(levels[0][k], merkle.siblings(k, n, known)) == levels[-1][0]
        for left_out in need:  # whatever is left out, some proof lacks it
            rest = [(a, b, levels[a][b]) for a, b in need if (a, b) != left_out]
            with pytest.raises(KeyError):
                known = merkle.derive(wanted, n, [levels[0][k] for k in wanted], rest)
                for k in wanted:
                    merkle.siblings(k, n, known)


def test_some_leaves_prove_alone(spark, docs, monkeypatch):
    monkeypatch.setattr(merkle, "PART_LEAVES", 16)
    forest = merkle.grow(docs.select(F.col("lang").alias("tree"), F.col("doc_id").alias("key"), merkle.leaf_hash(F.col("text")).alias("hash")))
    wanted = forest.leaves.where("at % 11 = 3").withColumn("claim", F.col("hash"))
    proved = merkle.prove(forest, wanted)
    tops = {r["tree"]: r["hash"] for r in forest.tops.collect()}
    got = proved.collect()
    assert len(got) == wanted.count() > 5 and all(r["folded"] == tops[r["tree"]] for r in got)


def test_manifest_of_nothing(empty):
    assert merkle.manifest(empty, ["doc_id", "text"]).collect() == []


# --- periodic runs

def brute_runs(w, least):
    out = []
    for q in range(1, len(w) // 2 + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            length = j - i + q
            if j > i and length >= max(least, 2 * q):
                own = w[i:i + length]
                if not any(own[d:] == own[:-d] for d in range(1, q)):
                    out.append((i, length, q))
            i = max(j, i + 1)
    return sorted(out, key=lambda r: (r[0], r[2]))


def test_runs_match_brute_force():
    rng = random.Random(1)
    for _ in range(1500):
        n, k = rng.choice([0, 1, 2, 5, 13, 30, 60]), rng.choice([1, 2, 2, 3, 4])
        w = [rng.randrange(k) for _ in range(n)]
        if n > 4 and rng.random() < 0.5:
            a, p = rng.randrange(n), rng.randrange(1, n)
            w = [w[i] if i < a else w[a + (i - a) % min(p, n - a)] for i in range(n)]
        least = rng.choice([2, 4, 12])
        assert periodic.runs(w, least) == brute_runs(w, least), (w, least)


def test_path_pieces_tell_the_last_end_of_every_suffix():
    rng = random.Random(2)
    w = [rng.randrange(2) for _ in range(60)]
    length, link, prefixes = periodic.automaton(w)
    paths = periodic.Paths(link)
    for i, state in enumerate(prefixes):
        told = {}
        for end, deepest, above in paths.access(state, i):
            told.update({n: end for n in range(length[above] + 1, length[deepest] + 1)})
        for n in range(1, i + 2):
            ends = [e for e in range(n - 1, i) if w[e - n + 1:e + 1] == w[i - n + 1:i + 1]]
            assert told.get(n) == (max(ends) if ends else None)


def words(text):
    return [x for x in re.split("[\x20\x09-\x0d]+", text or "") if x]


def brute_collapse(text, least):
    w = words(text)
    found = brute_runs(w, least)
    gone = {k for s, n, p in found for k in range(s + p, s + n)}
    return found, " ".join(x for k, x in enumerate(w) if k not in gone)


def repeating():
    rng = random.Random(6)
    out = ["a " * 40, "x\ty\n" * 9, "one two three four five six " * 2 + "end", "b b b", "ü ö " * 8 + "ü"]
    for _ in range(30):
        w = [rng.choice("ab c dd".split()) for _ in range(rng.choice([12, 40, 90]))]
        k = rng.randrange(len(w))
        out.append(" ".join(w[:k] + w[:k] + w[k // 2:k] + w + w))
    return out


def test_collapse_matches_brute_force(spark, docs):
    texts = [r[1] for r in rows() if not r[1] or len(r[1]) < 9000] + repeating()
    table = spark.createDataFrame([(k, t, k) for k, t in enumerate(texts)], "runs long, text string, collapsed long").repartition(3)
    got = {r["row"]["runs"]: ([tuple(x) for x in r["runs"]], r["collapsed"]) for r in periodic.collapse_runs(table).collect()}
    assert got == {k: brute_collapse(t, 12) for k, t in enumerate(texts)}
    assert sum(bool(f) for f, _ in got.values()) > 20
    assert periodic.collapse_runs(docs).count() == len(rows())


def planted(key, text):
    w = words(text)
    if key is None or not w:
        return text
    h = zlib.crc32(str(key).encode())
    if h % 10:
        return text
    g, n = h // 10, len(w)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return " ".join(w[i] if i < a else w[a + (i - a) % p] for i in range(n))


def test_op12_query_matches_brute_force(spark, tmp_path):
    texts = [t for t in repeating() * 3 + [r[1] for r in rows()] if not t or len(t) < 4000]
    data = [(k if k % 9 else None, t) for k, t in enumerate(texts)] + [(-5, texts[0]), (-5, texts[0])]
    spark.createDataFrame(data, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    want = Counter()
    for key, text in data:
        found, rest = brute_collapse(planted(key, text), 12)
        best = min(found, key=lambda r: (-r[1], r[0], r[2]), default=None)
        top = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
        want[(key, len(found), *top, sha("".join(f"{s},{n},{p}\n" for s, n, p in found)), sha(rest))] += 1
    got = periodic.op12_periodic_runs(spark, str(tmp_path))
    assert got.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    assert Counter(map(tuple, got.collect())) == want


def test_collapse_of_nothing(empty):
    assert periodic.collapse_runs(empty).collect() == []


# --- licences

def alnum(text):
    return re.findall(r"[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", (text or "").translate(UPPER))


def brute_licences(text, phrases, templates, threshold):
    w = alnum(text)
    places = sorted((i, label) for p, label in phrases.items() for i in range(len(w)) if w[i:i + len(alnum(p))] == alnum(p))
    longest = max(len(alnum(s)) for _, s in templates)
    held = set()
    for b in range(max(0, (len(w) - 1 - longest) // longest) + 1):
        block = set(w[b * longest:(b + 2) * longest])
        for label, s in templates:
            t = set(alnum(s))
            if len(block & t) >= threshold * len(t) - 1e-9:
                held.add((b, label, len(block & t) / len(t)))
    score = 1.0 if places else max((c for _, _, c in held), default=0.0)
    return len(w), places, sorted(held), score


@pytest.mark.parametrize("threshold", [0.3, 0.6, 0.9, 1.0])
def test_licences_match_brute_force(spark, threshold):
    rng = random.Random(8)
    texts = [r[1] for r in rows()] + [
        "Under the MIT-License! under the mit license", "underthe mit license", "x" * 5000 + " CC BY-NC cc\n by\nnc 4.0",
        "APACHE license, Version 2.", "Apache License version", "licensed under the GNU general\npublic license; version 3, or GPL",
        "Ünder the mit license", "under the mit licenseé", "by cc nc under licensed 0 4", "a b a b a",
    ]
    pool = sorted({w for _, s in licences.TEMPLATES for w in alnum(s)}) + ["und", "der", "wald"]
    texts += [" ".join(rng.choice(pool) for _ in range(rng.choice([3, 25, 80, 200]))) for _ in range(25)]
    for label, s in licences.TEMPLATES:
        texts.append(" ".join(rng.choice(pool[:9]) for _ in range(37)) + "\n" + s.upper() + "; " + s)
    phrases = {**licences.PHRASES, "a b a": "aba", "Wald": "w"}
    table = spark.createDataFrame([(k, t, k) for k, t in enumerate(texts)], "digest long, text string, score long").repartition(4)
    got = {}
    for r in licences.licences(table, phrases, threshold=threshold).collect():
        blocks = sorted({tuple(b) for b in r["blocks"]})
        got[r["row"]["digest"]] = (r["n_words"], sorted(map(tuple, r["places"])), blocks, r["score"])
    want = {k: brute_licences(t, phrases, licences.TEMPLATES, threshold) for k, t in enumerate(texts)}
    assert got == want


def test_licences_of_nothing(spark, empty, docs):
    assert licences.licences(empty).collect() == []
    bare = licences.licences(docs, {}, []).collect()
    assert len(bare) == len(rows()) and all(r["score"] == 0 and not r["places"] for r in bare)


def test_op13_finds_its_statements_and_leaves_prose_alone(spark, tmp_path):
    texts = ["Wald und Stein.\nThis work is licensed under the GNU General Public License, version 3.", "no license here under the version of mit", None,
             "Under the MIT license. CC BY-NC"]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r["doc_id"]: tuple(r)[1:] for r in licences.op13_license_scan(spark, str(tmp_path)).collect()}
    assert got == {
        0: (15, 0, None, None, "", "gpl-3", 1.0), 1: (8, 0, None, None, "", "", 0.0), 2: (0, 0, None, None, "", "", 0.0),
        3: (7, 2, 0, 4, "cc-by-nc,mit", "cc-by-nc,mit", 1.0),
    }


def test_no_python_runs_on_the_texts(docs):
    plan = licences.licences(docs)._jdf.queryExecution().toString()
    assert "MapInArrow" not in plan and "Python" not in plan and "CartesianProduct" not in plan
