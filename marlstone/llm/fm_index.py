"""Benchmark decontamination: an FM-index over each shard of the corpus, searched for the benchmark's word windows."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marlstone.llm.texts import ALNUM, carried, hashes, slices, words

#: Words of a window.
WINDOW = 13
#: Bytes of item text searched in one pass; a larger benchmark takes more passes, each over all documents.
BLOCK_BYTES = 4 << 20
#: A shard closes at so many indexed words, rows, or bytes of carried text.
SHARD_WORDS, SHARD_ROWS, SHARD_BYTES = 1 << 20, 20_000, 32 << 20
#: Every so many text positions one suffix position is kept.
SAMPLED = 8


class WaveletMatrix:
    """Ranks and symbols of a sequence in one step per bit of the alphabet."""

    def __init__(self, sequence: np.ndarray, symbols: int):
        self.levels = []
        for shift in reversed(range(max(1, int(symbols).bit_length()))):
            bit = (sequence >> shift) & 1
            self.levels.append((shift, len(sequence) - int(bit.sum()), *packed(bit)))
            sequence = np.concatenate([sequence[bit == 0], sequence[bit == 1]])
        self.starts = self._down(np.arange(symbols + 1), np.zeros(symbols + 1, np.int64))

    def _down(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        for shift, zeros, bits, base in self.levels:
            ones = rank(bits, base, at)
            at = np.where((symbol >> shift) & 1, zeros + ones, at - ones)
        return at

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each symbol occurs before each position."""
        return self._down(symbol, at) - self.starts[symbol]

    def access(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The symbol at each position and its rank there."""
        symbol = np.zeros(len(at), np.int64)
        for shift, zeros, bits, base in self.levels:
            bit = (bits[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1)
            ones = rank(bits, base, at)
            at = np.where(bit, zeros + ones, at - ones)
            symbol |= bit.astype(np.int64) << shift
        return symbol, at - self.starts[symbol]


def packed(bit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bits in 64-bit words, and the ones before each word."""
    n = len(bit) // 64 + 1
    full = np.zeros(n * 64, np.uint8)
    full[:len(bit)] = bit
    bits = np.packbits(full, bitorder="little").view(np.uint64)
    base = np.zeros(n, np.int64)
    np.cumsum(np.bitwise_count(bits)[:-1], out=base[1:])
    return bits, base


def rank(bits: np.ndarray, base: np.ndarray, at: np.ndarray) -> np.ndarray:
    word = at >> 6
    below = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
    return base[word] + np.bitwise_count(bits[word] & below).astype(np.int64)


class FMIndex:
    """Over runs of symbols from 1, each followed by a 0; no pattern holds a 0."""

    def __init__(self, text: np.ndarray, symbols: int):
        suffixes = suffix_array(text)
        last = text[suffixes - 1]
        self.size = len(text)
        self.before = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=symbols + 1))]).astype(np.int64)
        self.wavelet = WaveletMatrix(last.astype(np.int64), symbols)
        # Starts of runs are sampled too, so that no walk passes a 0.
        known = (suffixes % SAMPLED == 0) | (last == 0)
        self.known, self.known_base = packed(known)
        self.samples = suffixes[known]

    def find(self, patterns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First and last + 1 suffix of each pattern (rows of a matrix), by backward search."""
        low, high = np.zeros(len(patterns), np.int64), np.full(len(patterns), self.size)
        live = np.arange(len(patterns))
        for k in reversed(range(patterns.shape[1])):
            symbol = patterns[live, k].astype(np.int64)
            low[live] = self.before[symbol] + self.wavelet.rank(symbol, low[live])
            high[live] = self.before[symbol] + self.wavelet.rank(symbol, high[live])
            live = live[low[live] < high[live]]
        return low, np.maximum(high, low)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of suffixes: walk back to a sampled one."""
        out, steps = np.zeros(len(rows), np.int64), np.zeros(len(rows), np.int64)
        at, left = rows.copy(), np.arange(len(rows))
        while len(left):
            own = at[left]
            hit = (self.known[own >> 6] >> (own & 63).astype(np.uint64)) & np.uint64(1) > 0
            done = left[hit]
            out[done] = self.samples[rank(self.known, self.known_base, at[done])] + steps[done]
            left = left[~hit]
            symbol, order = self.wavelet.access(at[left])
            at[left] = self.before[symbol] + order
            steps[left] += 1
        return out


def suffix_array(text: np.ndarray) -> np.ndarray:
    """By prefix doubling; every 0 counts as a symbol of its own, smaller than all others."""
    zero = text == 0
    order = np.where(zero, np.cumsum(zero) - 1, int(zero.sum()) + text.astype(np.int64))
    n, step = len(text), 0
    while True:
        key = order * (n + 1)
        if step:
            key[:n - step] += order[step:] + 1
        found = np.argsort(key, kind="stable")
        fresh = np.diff(key[found]) != 0
        order = np.empty(n, np.int64)
        order[found] = np.concatenate([[0], np.cumsum(fresh)])
        if fresh.all():
            return found
        step = max(1, 2 * step)


@dataclass
class Phrases:
    """The windows of a block of items: word hashes of the vocabulary, windows by length, items of each window."""

    vocabulary: np.ndarray
    windows: list[np.ndarray]
    owners: list[tuple[np.ndarray, np.ndarray]]
    names: list[str | None]
    shortest: int


def phrases(names: list[str | None], texts: list[str | None], window: int) -> Phrases | None:
    """None if no item has a word."""
    found = []
    for _, _, data, offsets in slices(pa.array(texts, pa.large_string())):
        starts, ends, first = words(data, offsets, ALNUM)
        own = hashes(data, starts, ends)
        found += [own[a:b] for a, b in zip(first[:-1], first[1:])]
    vocabulary = np.unique(np.concatenate(found))
    if not len(vocabulary):
        return None
    by_length: dict[int, list[tuple[np.ndarray, int]]] = {}
    for item, own in enumerate(found):
        if len(own):
            code = (np.searchsorted(vocabulary, own) + 1).astype(np.int32)
            length = min(window, len(code))
            by_length.setdefault(length, []).append((np.lib.stride_tricks.sliding_window_view(code, length), item))
    windows, owners = [], []
    for length in sorted(by_length):
        rows = np.concatenate([w for w, _ in by_length[length]])
        item = np.concatenate([np.full(len(w), i) for w, i in by_length[length]])
        distinct, which = np.unique(rows, axis=0, return_inverse=True)
        pairs = np.unique(np.stack([which.ravel(), item]), axis=1)
        windows.append(distinct)
        owners.append((np.searchsorted(pairs[0], np.arange(len(distinct) + 1)), pairs[1]))
    return Phrases(vocabulary, windows, owners, names, min(by_length))


def contamination(
    docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text",
    item_key: str = "item_id", item_text: str = "text", window: int = WINDOW, block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """One row per row of ``docs``: ``row`` (all its columns), n_words, n_hit, n_items, item_ids, spans, contaminated.

    Words are runs of ASCII digits, ASCII letters (A-Z lower-cased) and characters beyond ASCII. A window
    is ``window`` consecutive words of an item, or the whole item if it has fewer. Document words inside an
    occurrence of a window are hit; ``spans`` are the merged ranges of hit words (start, end), ``item_ids``
    the items with occurrences as sorted strings. A row is contaminated when at least one word in twenty is hit.

    Documents are streamed in shards. Runs of words that occur in the benchmark, as long as its shortest
    window or longer, are put into an FM-index of the shard (other places cannot hold a window); all
    windows are searched backwards at once, occurrences located from sampled suffix positions and merged
    into spans. The items travel in blocks of at most ``block_bytes`` (or one larger item), one pass each,
    so no broadcast grows with the benchmark.

    A null or empty text has no words and is not contaminated; a null or empty item has no window. A null
    item id is hit like others but neither counted nor listed; repeated ids count once. Repeated document
    rows each get their row. An empty table of items leaves all documents clean.
    """
    spark = docs.sparkSession
    out = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")).select(
        "row", F.lit(None).cast("long").alias("n_words"),
        F.expr("cast(array() AS array<struct<start:bigint,end:bigint>>)").alias("spans"),
        F.expr("cast(array() AS array<string>)").alias("item_ids"),
    )
    kind = docs.schema.simpleString()
    shape = f"row {kind}, n_words long, spans array<struct<start:bigint,end:bigint>>, item_ids array<string>"
    blocks = 0
    asked = items.select(F.col(item_key).cast("string").alias("name"), F.col(item_text).alias("text"))
    for block in _blocks(asked, block_bytes, window):
        out = out.mapInArrow(_match(spark.sparkContext.broadcast(block), text), shape)
        blocks += 1
    if not blocks:
        out = out.mapInArrow(_match(None, text), shape)
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    ids = F.array_sort(F.array_distinct(F.filter("item_ids", lambda x: x.isNotNull())))
    return out.select(
        "row", "n_words", hit.alias("n_hit"), F.size(ids).cast("long").alias("n_items"), ids.alias("item_ids"), "spans"
    ).withColumn("contaminated", (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words")))


def _blocks(items: DataFrame, limit: int, window: int) -> Iterator[Phrases]:
    names, texts, held = [], [], 0
    for row in items.toLocalIterator():
        names.append(row["name"])
        texts.append(row["text"])
        held += len(row["text"] or "")
        if held >= limit:
            if (block := phrases(names, texts, window)) is not None:
                yield block
            names, texts, held = [], [], 0
    if texts and (block := phrases(names, texts, window)) is not None:
        yield block


class _Shard:
    def __init__(self):
        self.batches: list[pa.RecordBatch] = []
        self.counts: list[np.ndarray] = []
        self.runs: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []  # symbols, rows, first words
        self.rows = self.words = self.bytes = 0

    def add(self, batch: pa.RecordBatch, data: np.ndarray, offsets: np.ndarray, block: Phrases | None, quick) -> None:
        starts, ends, first = words(data, offsets, ALNUM)
        self.counts.append(np.diff(first))
        if block is not None and len(starts):
            own = hashes(data, starts, ends)
            code = np.zeros(len(own) + 1, np.int32)
            maybe = np.flatnonzero(quick[(own & np.uint64(0xFFFF)).astype(np.int64)])
            place = np.searchsorted(block.vocabulary, own[maybe])
            place[place == len(block.vocabulary)] = 0
            right = block.vocabulary[place] == own[maybe]
            code[maybe[right]] = place[right] + 1
            known = code[:-1] > 0
            begin = known & np.concatenate([[True], ~known[:-1]])
            edges = first[:-1][np.diff(first) > 0]
            begin[edges] = known[edges]
            begins = np.flatnonzero(begin)
            stop = ~known
            stop[edges] = True
            stops = np.concatenate([np.flatnonzero(stop), [len(known)]])
            ends_of = stops[np.searchsorted(stops, begins + 1)]
            long = ends_of - begins >= block.shortest
            begins, ends_of = begins[long], ends_of[long]
            if len(begins):
                row = np.searchsorted(first, begins, "right") - 1
                length = ends_of - begins + 1
                at = np.cumsum(length) - length
                index = np.repeat(begins - at, length) + np.arange(int(length.sum()))
                symbols = code[index]
                symbols[at + length - 1] = 0
                self.runs.append((symbols, np.repeat(row + self.rows, length), index - np.repeat(first[row], length)))
                self.words += len(symbols)
        self.batches.append(batch)
        self.rows += batch.num_rows
        self.bytes += len(data)

    def full(self) -> bool:
        return self.words >= SHARD_WORDS or self.rows >= SHARD_ROWS or self.bytes >= SHARD_BYTES

    def close(self, block: Phrases | None) -> Iterator[pa.RecordBatch]:
        spans: dict[int, list[tuple[int, int]]] = {}
        named: dict[int, list] = {}
        if self.runs:
            symbols, rows, place = (np.concatenate(x) for x in zip(*self.runs))
            spans, named = _search(symbols, rows, place, block)
        first = 0
        for batch, counts in zip(self.batches, self.counts):
            columns = {name: batch.column(i) for i, name in enumerate(batch.schema.names)}
            mine = [k for k in range(batch.num_rows) if first + k in spans]
            new_spans, new_ids = columns["spans"], columns["item_ids"]
            if mine:
                have, ids = new_spans.to_pylist(), new_ids.to_pylist()
                for k in mine:
                    have[k] = _merged([(s["start"], s["end"]) for s in have[k]] + spans[first + k])
                    ids[k] = list(dict.fromkeys(ids[k] + named[first + k]))
                new_spans, new_ids = pa.array(have, new_spans.type), pa.array(ids, new_ids.type)
            yield pa.RecordBatch.from_arrays(
                [columns["row"], pa.array(counts, pa.int64()), new_spans, new_ids], list(columns)
            )
            first += batch.num_rows


def _merged(spans: list[tuple[int, int]]) -> list[dict]:
    out: list[dict] = []
    for start, end in sorted(spans):
        if out and start <= out[-1]["end"]:
            out[-1]["end"] = max(out[-1]["end"], end)
        else:
            out.append({"start": start, "end": end})
    return out


def _search(symbols: np.ndarray, rows: np.ndarray, place: np.ndarray, block: Phrases):
    """Spans of hit words and item names, by row of the shard."""
    index = FMIndex(symbols, len(block.vocabulary))
    cover = np.zeros(len(symbols) + 1, np.int64)
    pairs = []
    for windows, (at, owner) in zip(block.windows, block.owners):
        low, high = index.find(windows)
        found = np.flatnonzero(high > low)
        many = high[found] - low[found]
        window = np.repeat(found, many)
        suffix = np.repeat(low[found] - np.cumsum(many) + many, many) + np.arange(int(many.sum()))
        position = index.locate(suffix)
        np.add.at(cover, position, 1)
        np.add.at(cover, position + windows.shape[1], -1)
        row, window = np.unique(np.stack([rows[position], window]), axis=1)
        each = at[window + 1] - at[window]
        item = owner[np.repeat(at[window] - np.cumsum(each) + each, each) + np.arange(int(each.sum()))]
        pairs.append(np.unique(np.stack([np.repeat(row, each), item]), axis=1))
    hit = np.cumsum(cover[:-1]) > 0
    edge = np.diff(np.concatenate([[0], hit.astype(np.int8), [0]]))
    spans: dict[int, list[tuple[int, int]]] = {}
    for a, b in zip(np.flatnonzero(edge > 0).tolist(), np.flatnonzero(edge < 0).tolist()):
        spans.setdefault(int(rows[a]), []).append((int(place[a]), int(place[b - 1]) + 1))
    named: dict[int, list] = {row: [] for row in spans}
    for row, item in np.concatenate(pairs, axis=1).T.tolist():
        named[row].append(block.names[item])
    return spans, named


def _match(sent, text: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = sent.value if sent is not None else None
        quick = np.zeros(1 << 16, bool)
        if block is not None:
            quick[(block.vocabulary & np.uint64(0xFFFF)).astype(np.int64)] = True
        shard = _Shard()
        for batch in batches:
            for first, last, data, offsets in slices(carried(batch, text)[1]):
                shard.add(batch.slice(first, last - first), data, offsets, block, quick)
                if shard.full():
                    yield from shard.close(block)
                    shard = _Shard()
        if shard.rows:
            yield from shard.close(block)

    return run


def op7_fm_index_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    found = contamination(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return found.select(
        "row.doc_id", "n_words", "n_hit", "n_items",
        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"), "contaminated",
    )


OP7_SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
bw AS (SELECT DISTINCT item_id, least(13, len(w)) AS l, unnest(list_transform(range(1, len(w) - least(13, len(w)) + 2),
    lambda i: array_to_string(w[i:i + least(13, len(w)) - 1], ' '))) AS s FROM b WHERE len(w) > 0),
dw AS (SELECT doc_id, l, unnest(range(1, len(w) - l + 2)) AS p, unnest(list_transform(range(1, len(w) - l + 2),
    lambda i: array_to_string(w[i:i + l - 1], ' '))) AS s FROM d, (SELECT DISTINCT l FROM bw)),
hit AS (SELECT doc_id, item_id, p, dw.l FROM dw JOIN bw ON dw.l = bw.l AND dw.s = bw.s),
cov AS (SELECT doc_id, count(DISTINCT q) AS n_hit FROM (SELECT doc_id, unnest(range(p, p + l)) AS q FROM hit) GROUP BY 1),
it AS (SELECT doc_id, count(DISTINCT item_id) AS n_items,
    string_agg(DISTINCT CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS ids FROM hit GROUP BY 1)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN cov USING (doc_id) LEFT JOIN it USING (doc_id)
"""
