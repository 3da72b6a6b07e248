"""Similarity join, decontamination, line chunks and token files against brute force."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from marlstone.llm import fm_index, line_chunks, links, ngram_join, token_files
from marlstone.llm.texts import slices
from tests.llm.fixtures import SCHEMA, rows

UPPER = {c: c + 32 for c in range(65, 91)}


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(rows(), SCHEMA).repartition(5)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def shingles(text):
    w = [x for x in re.split("[\x20\x09-\x0d]+", (text or "").translate(UPPER)) if x]
    return frozenset(tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))) if w else frozenset()


def brute_components(data):
    sets = [shingles(r[1]) for r in data]
    parent, degree = list(range(len(data))), Counter()

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(data)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 75 * len(sets[a] | sets[b]):
                degree[a] += 1
                degree[b] += 1
                parent[find(a)] = find(b)
    least = {}
    for k, r in enumerate(data):
        if r[0] is not None:
            least[find(k)] = min(r[0], least.get(find(k), r[0]))
    return Counter((r[0], len(sets[k]), least.get(find(k)), degree[k]) for k, r in enumerate(data))


def test_jaccard_links_match_brute_force(docs):
    assert Counter(map(tuple, ngram_join.jaccard_links(docs).collect())) == brute_components(rows())


def test_jaccard_blocks_are_cut(docs, monkeypatch):
    monkeypatch.setattr(ngram_join, "BLOCK_ROWS", 3)
    assert Counter(map(tuple, ngram_join.jaccard_links(docs).collect())) == brute_components(rows())


def test_drop_linked_keeps_one_of_each(docs):
    kept = ngram_join.drop_linked(docs)
    assert kept.columns == docs.columns
    kept = Counter((r["doc_id"], r["text"]) for r in kept.collect())
    data, want = rows(), Counter()
    linked = {k: c for (k, n, c, d), _ in brute_components(data).items() if d}
    for r in data:
        if r[0] not in linked:
            want[r[0], r[1]] += 1
        elif linked[r[0]] == r[0]:
            want[r[0], r[1]] = 1
    assert kept == want


def test_overlaps_accumulate_and_discard(monkeypatch):
    monkeypatch.setattr(ngram_join, "BLOCK_COLUMNS", 16)
    rng = np.random.default_rng(0)
    sets = [np.unique(rng.integers(0, 90, 60)).astype(np.uint64) for _ in range(30)]
    counts, bound = ngram_join.overlaps(sets, None, 75)
    for a in range(30):
        for b in range(a):
            both = len(np.intersect1d(sets[a], sets[b]))
            assert counts[a, b] <= both
            assert (counts[a, b] >= bound[a, b]) == (100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both))


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, k) for k in range(101, 160)] + [(7, 7), (None, 3)]
    got = {r["node"]: r["root"] for r in links.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 160)}}


def test_empty_tables(empty):
    assert ngram_join.jaccard_links(empty).collect() == []
    assert ngram_join.drop_linked(empty).collect() == []
    assert line_chunks.remove_repeated(empty).collect() == []


# --- decontamination

def alnum(text):
    return re.findall(r"[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", (text or "").translate(UPPER))


def brute_hits(data, items):
    out = Counter()
    for r in data:
        w, hit, ids, hits = alnum(r[1]), set(), set(), False
        for item, text in items:
            b = alnum(text)
            n = min(13, len(b))
            for k in range(len(b) - n + 1 if b else 0):
                for p in range(len(w) - n + 1):
                    if w[p:p + n] == b[k:k + n]:
                        hit.update(range(p, p + n))
                        if item is not None:
                            ids.add(str(item))
        out[r[0], len(w), len(hit), len(ids), ",".join(sorted(ids)), bool(hit) and 20 * len(hit) >= len(w)] += 1
    return out


@pytest.mark.parametrize("block_bytes", [1 << 20, 60])
def test_contamination_matches_brute_force(spark, docs, block_bytes, monkeypatch):
    monkeypatch.setattr(fm_index, "SHARD_WORDS", 300)
    data = rows()
    long = next(r[1] for r in data if r[1] and len(r[1]) > 20_000).split()
    items = [(10, " ".join(long[500:540])), (9, " ".join(long[520:560]).upper()), (2, data[1][1]), (3, None), (4, ""),
             (5, "One"), (None, " ".join(long[900:915])), (10, "never seen here"), (11, "12 34"), (12, " ".join(long[40:60]))]
    table = spark.createDataFrame(items, "item_id long, text string")
    got = fm_index.contamination(docs, table, block_bytes=block_bytes)
    got = Counter((r["row"]["doc_id"], r["n_words"], r["n_hit"], r["n_items"], ",".join(r["item_ids"]), r["contaminated"]) for r in got.collect())
    assert got == brute_hits(data, items)


def test_contamination_without_items(spark, docs):
    none = spark.createDataFrame([], "item_id long, text string")
    got = fm_index.contamination(docs, none).collect()
    assert len(got) == len(rows()) and not any(r["n_hit"] or r["contaminated"] for r in got)


def test_fm_index_finds_all_places():
    rng = np.random.default_rng(1)
    text = np.concatenate([np.append(rng.integers(1, 4, n), 0) for n in (1, 50, 7, 300, 2)]).astype(np.int32)
    index = fm_index.FMIndex(text, 3)
    for n in (1, 2, 5):
        patterns = rng.integers(1, 4, (40, n))
        low, high = index.find(patterns)
        for pattern, a, b in zip(patterns, low, high):
            want = [k for k in range(len(text) - n + 1) if (text[k:k + n] == pattern).all()]
            assert sorted(index.locate(np.arange(a, b)).tolist()) == want


# --- line chunks

def brute_lines(data):
    chunks, out = [], {}
    for r in sorted(set((r[0] if r[0] is not None else -1, r[1]) for r in data if r[1] is not None)):
        lines, start, seen = r[1].split("\n"), 0, [0, 0]
        for i, line in enumerate(lines):
            seen = [*seen[-2:], int(hashlib.md5(line.encode()).hexdigest()[:8], 16)]
            roll = ((seen[0] * 31 + seen[1]) % 2147483647 * 31 + seen[2]) % 2147483647
            if roll % 4 == 0 or i == len(lines) - 1:
                chunks.append((r, start, lines[start:i + 1]))
                start = i + 1
    met = set()
    for r, start, lines in chunks:
        text = "\n".join(lines)
        gone = len(lines) > 1 and text in met
        met.add(text)
        if not gone:
            out.setdefault(r, []).append(text)
    return {r: "\n".join(out.get(r, [])) for r, _, _ in chunks}


def test_line_chunks_match_brute_force(docs):
    want = brute_lines(rows())
    got = line_chunks.remove_repeated(docs).collect()
    assert len(got) == len(rows())
    for r in got:
        row = r["row"]
        if row["text"] is None:
            assert r["clean"] is None and r["n_lines"] == 0
        else:
            assert r["clean"] == want[row["doc_id"] if row["doc_id"] is not None else -1, row["text"]]
    assert any(r["removed"] for r in got)


def brute_pairs(data):
    met, out = set(), {}
    for r in sorted(set((r[0] if r[0] is not None else -1, r[1]) for r in data if r[1] is not None)):
        lines, gone = r[1].split("\n"), set()
        for i, pair in enumerate(zip(lines, lines[1:])):
            if pair in met:
                gone |= {i, i + 1}
            met.add(pair)
        out[r] = "\n".join(x for i, x in enumerate(lines) if i not in gone)
    return out


def test_every_repeated_passage_goes(spark):
    own = iter(range(10_000))
    other = lambda n: [f"own line {next(own)}" for _ in range(n)]
    data, passages = [], []
    for n in range(2, 9):
        for m in range(4):
            passage = [f"passage {n} {m} line {i} " + "word " * 30 for i in range(n)]
            passages.append(passage)
            data += [(len(data), "\n".join(other(3) + passage + other(2))), (len(data) + 1, "\n".join(other(1 + m) + passage + other(4)))]
    data += [(len(data), "\n".join(passages[-1][2:5] + other(1))), (len(data) + 1, "a\na\na\na"), (len(data) + 2, "a\na"), (None, "\n".join(passages[9]))]
    data += [(len(data), None), (len(data) + 1, ""), data[4]]
    docs = spark.createDataFrame(data, "doc_id long, text string").repartition(5)
    got = line_chunks.remove_repeated(docs, every_pair=True).collect()
    want = brute_pairs(data)
    assert len(got) == len(data)
    lines = set()
    for r in got:
        k, text = r["row"]
        assert r["clean"] == (None if text is None else want[-1 if k is None else k, text])
        lines |= set((r["clean"] or "").split("\n"))
        assert all(a["start"] + a["n"] <= b["start"] for a, b in zip(r["removed"], r["removed"][1:]))
    assert lines >= {x for _, text in data if text is not None for x in text.split("\n")}
    for passage in passages:
        assert len({r["row"] for r in got if passage[0] in (r["clean"] or "")}) == 1


def test_every_pair_takes_all_that_chunks_take(docs):
    few = {(r["row"]["doc_id"], r["row"]["text"]): r["clean"] for r in line_chunks.remove_repeated(docs).collect()}
    for r in line_chunks.remove_repeated(docs, every_pair=True).collect():
        if r["clean"] is not None:
            assert not Counter(r["clean"].split("\n")) - Counter(few[r["row"]["doc_id"], r["row"]["text"]].split("\n"))


# --- token files

def tokenizer_path():
    import public_tokenizers

    return public_tokenizers.path(token_files.TOKENIZER)


def test_codec_round_trip():
    for values in ([], [0], [255, 256, 65535, 65536, 1 << 24, (1 << 32) - 1, 7], list(range(0, 70_000, 13))):
        control, data = token_files.encode(np.array(values, np.uint32))
        assert len(control) == -(-len(values) // 4)
        assert token_files.decode(control, data, len(values)).tolist() == values


def test_token_files_match_tokenizer(spark, docs, monkeypatch, tmp_path):
    from tokenizers import Tokenizer

    monkeypatch.setattr(token_files, "PART_BYTES", 4000)
    monkeypatch.setattr(token_files, "BLOCK_IDS", 500)
    folder = token_files.write_token_files(docs, str(tmp_path / "t"), tokenizer_path())
    got = [tuple(r) for r in token_files.read_token_files(spark, folder).drop("ids").orderBy("start").collect()]
    encoder, start = Tokenizer.from_file(tokenizer_path()), 0
    coded = {r[1]: np.array(encoder.encode(r[1] or "", add_special_tokens=False).ids + [0], "<u4") for r in rows()}
    assert sorted(g[0] is not None for g in got) == [g[0] is not None for g in got]
    assert [g[0] for g in got if g[0] is not None] == sorted(r[0] for r in rows() if r[0] is not None)
    want = Counter((r[0], len(coded[r[1]]), zlib.crc32(coded[r[1]].tobytes())) for r in rows())
    assert Counter((g[0], g[2], g[3]) for g in got) == want
    for g in got:
        assert g[1] == start
        start += g[2]
    ranks = [r["id"] for r in spark.read.parquet(f"{folder}/ranks").orderBy("rank").collect()]
    counts = Counter(i for r in rows() for i in coded[r[1]].tolist())
    assert ranks == sorted(counts, key=lambda i: (-counts[i], i))


@pytest.mark.parametrize("remembered", [1 << 20, 30])
def test_pieces_encode_like_whole_texts(monkeypatch, remembered):
    from tokenizers import Tokenizer

    monkeypatch.setattr(token_files, "REMEMBERED", remembered)

    encoder, pieces = Tokenizer.from_file(tokenizer_path()), token_files.Pieces(tokenizer_path())
    odd = ["a  b\n c <|endoftext|> d\t e", "é è ê　 x  y 's 're it's ", "  lead", "trail  ", "ß ü  zwei", " ", "x\u0085 y\n\nb  c 123 45a !!?? 'll"]
    odd += [" ".join(f"word{i}{'x' * (i % 7)}" for i in range(k, k + 1300)) for k in (0, 700, 5)]
    for turn in range(4):
        odd = odd[turn:] + odd[:turn]
        for _, _, data, at in slices(pa.array(odd)):
            ids, place = pieces.encode(data, at)
            for k, text in enumerate(odd):
                assert ids[place[k]:place[k + 1]].tolist() == encoder.encode(text, add_special_tokens=False).ids


def test_empty_token_files(empty):
    assert token_files.token_digest(empty, tokenizer_path()).collect() == []
