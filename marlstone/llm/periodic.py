"""Periodic runs of words, found by a suffix automaton whose link tree is coloured by last occurrence.

The automaton of a word sequence has one state per class of substrings with the same ends. On the way from
the state of a prefix to the root lie all suffixes of that prefix. Every appended word accesses its prefix in
a link-cut tree over the suffix links: the way is gathered into one path of the colour "ends here", and the
pieces of older paths it was made of tell, for each range of lengths, where these suffixes ended last. A
piece that ended p words ago and holds the suffix of length p is a square of period p, which is extended to
its run.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marlstone.llm.texts import SPACED, carried, hashes, mix, slices, words

#: A run has at least this many words; it is also at least twice its period.
LEAST = 12
_STEP = np.uint64(0x9E3779B97F4A7C15)


def automaton(ids: list[int]) -> tuple[list[int], list[int], list[int]]:
    """Longest length and suffix link of every state (1 is the root, 0 none), and the state of each prefix."""
    moves: list[dict[int, int]] = [{}, {}]
    link, length, prefixes, last = [0, 0], [-1, 0], [], 1
    for word in ids:
        state = len(moves)
        moves.append({})
        length.append(length[last] + 1)
        link.append(1)
        at = last
        while at and word not in moves[at]:
            moves[at][word] = state
            at = link[at]
        if at:
            old = moves[at][word]
            if length[old] == length[at] + 1:
                link[state] = old
            else:
                copy = len(moves)
                moves.append(moves[old].copy())
                length.append(length[at] + 1)
                link.append(link[old])
                while at and moves[at].get(word) == old:
                    moves[at][word] = copy
                    at = link[at]
                link[old] = link[state] = copy
        last = state
        prefixes.append(state)
    return length, link, prefixes


class Paths:
    """The link tree as paths, each kept in a splay tree by depth; a path has one colour, at its splay root."""

    def __init__(self, link: list[int]):
        self.left, self.right, self.up = [0] * len(link), [0] * len(link), list(link)
        self.colour = [-1] * len(link)

    def _raise(self, x: int) -> None:
        """Splay ``x`` to the root of its path's tree, where it takes over the colour."""
        left, right, up, colour = self.left, self.right, self.up, self.colour
        while True:
            p = up[x]
            if not p or (left[p] != x and right[p] != x):
                return
            g = up[p]
            if g and (left[g] == p or right[g] == p):
                top = g
                turns = (p, x) if (left[g] == p) == (left[p] == x) else (x, x)
            else:
                top, turns = p, (x,)
            colour[x] = colour[top]
            for y in turns:
                p = up[y]
                g = up[p]
                if g:
                    if left[g] == p:
                        left[g] = y
                    elif right[g] == p:
                        right[g] = y
                if left[p] == y:
                    inner = right[y]
                    left[p], right[y] = inner, p
                else:
                    inner = left[y]
                    right[p], left[y] = inner, p
                if inner:
                    up[inner] = p
                up[p], up[y] = y, g

    def access(self, state: int, colour: int) -> Iterator[tuple[int, int, int]]:
        """Gather the way from ``state`` to the root into one path of ``colour``; for each piece of an older
        path on it, deepest first, that path's colour, the piece's deepest state and the state above the piece."""
        right, up = self.right, self.up
        below, x = 0, state
        while x:
            self._raise(x)
            old = self.colour[x]
            if right[x]:
                self.colour[right[x]] = old
            right[x] = below
            if old >= 0:
                yield old, x, up[x]
            below, x = x, up[x]
        self.colour[below] = colour


def runs(ids: list[int], least: int = LEAST) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs of at least ``least`` words and two periods, by start and period."""
    length, link, prefixes = automaton(ids)
    paths, n = Paths(link), len(ids)
    found, known = [], {}  # period: end of the last run of that period
    for i, state in enumerate(prefixes):
        for end, deepest, above in paths.access(state, i):
            p = i - end
            # shorter suffixes have ended later, so the square's half of p words is no power of a shorter word
            if length[above] < p <= length[deepest] and known.get(p, 0) <= i:
                stop, start = i + 1, i + 1 - 2 * p
                while stop < n and ids[stop] == ids[stop - p]:
                    stop += 1
                while start > 0 and ids[start - 1] == ids[start - 1 + p]:
                    start -= 1
                known[p] = stop
                if stop - start >= least:
                    found.append((start, stop - start, p))
    return sorted(found, key=lambda r: (r[0], r[2]))


def stretches(word: np.ndarray, first: np.ndarray, least: int = LEAST) -> list[tuple[int, int]]:
    """Stretches of words, within the rows that start at ``first``, outside of which no run can lie.

    A run of ``least`` words and two periods agrees with itself, a period later, over at least half of
    ``least`` words; so each of its words lies in a group of ``least // 2`` words that occurs twice in its row.
    """
    size, total = least // 2, len(word)
    if total < least:
        return []
    row = np.repeat(np.arange(len(first) - 1), np.diff(first))
    group = np.zeros(total - size + 1, np.uint64)
    for k, step in enumerate(_STEP * np.arange(1, 2 * size, 2, dtype=np.uint64)):
        group += mix(word[k:total - size + 1 + k] * step)
    group = mix(group) + row[:len(group)].astype(np.uint64) * _STEP
    whole = np.flatnonzero(row[:len(group)] == row[size - 1:])
    order = whole[np.argsort(group[whole], kind="stable")]
    same = group[order][1:] == group[order][:-1]
    twice = np.zeros(len(order), bool)
    twice[1:] |= same
    twice[:-1] |= same
    change = np.zeros(total + 1, np.int64)
    hit = order[twice]
    np.add.at(change, hit, 1)
    np.add.at(change, hit + size, -1)
    inside = np.cumsum(change)[:-1] > 0
    begin = inside.copy()
    begin[1:] &= ~inside[:-1] | (row[1:] != row[:-1])
    stop = inside.copy()
    stop[:-1] &= ~inside[1:] | (row[1:] != row[:-1])
    pairs = zip(np.flatnonzero(begin).tolist(), (np.flatnonzero(stop) + 1).tolist())
    return [(a, b) for a, b in pairs if b - a >= least]


_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def _collapse(text: str, least: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, column = carried(batch, text)
            for a, b, data, offsets in slices(column):
                starts, ends, first = words(data, offsets, SPACED)
                found: list[list[tuple[int, int, int]]] = [[] for _ in range(b - a)]
                raw, base = data.tobytes(), first.tolist()
                for low, high in stretches(hashes(data, starts, ends, lower=False), first, least):
                    k = int(np.searchsorted(first, low, "right")) - 1
                    names: dict[bytes, int] = {}
                    own = [raw[x:y] for x, y in zip(starts[low:high].tolist(), ends[low:high].tolist())]
                    ids = [names.setdefault(w, len(names)) for w in own]
                    found[k] += [(low - base[k] + s, n, p) for s, n, p in runs(ids, least)]
                kept = []
                for k, own in enumerate(found):
                    said = raw[offsets[k]:offsets[k + 1]].split()  # bytes split at the same white space
                    if own:
                        keep = np.ones(len(said), bool)
                        for s, n, p in own:
                            keep[s + p:s + n] = False
                        said = [said[j] for j in np.flatnonzero(keep).tolist()]
                    kept.append(b" ".join(said))
                yield pa.RecordBatch.from_arrays([
                    rows.slice(a, b - a),
                    pa.array([[dict(zip(("start", "length", "period"), r)) for r in own] for own in found], pa.list_(_RUN)),
                    pa.array(kept, pa.binary()).cast(pa.string()),
                ], ["row", "runs", "collapsed"])

    return run


def collapse_runs(docs: DataFrame, text: str = "text", least: int = LEAST) -> DataFrame:
    """``row`` (the document), ``runs`` (start, length, period in words, by start and period) and ``collapsed``.

    Words end at ASCII white space. A run is a stretch of at least ``least`` words and two of its smallest
    period that cannot be lengthened. ``collapsed`` joins by one space the words that no run holds beyond its
    first period. A null or empty text has no runs and collapses to the empty text. Each row stands for
    itself, so repeated rows and ids do not matter. A worker holds one slice of texts, and the automaton of
    one repetitive stretch of one text (about 1 kB a word).
    """
    kind = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    row = kind.schema["row"].dataType.simpleString()
    return kind.mapInArrow(
        _collapse(text, least), f"row {row}, runs array<struct<start:bigint,length:bigint,period:bigint>>, collapsed string")


def with_planted_period(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with one text in ten made periodic from a word on; place, period and choice come from the key's crc32."""
    h = F.crc32(F.col(key).cast("string").cast("binary"))
    chosen = docs.withColumn("_w", F.when(h % 10 == 0, F.filter(F.split(text, "[ \\t-\\r]+"), lambda w: w != "")))
    n, g = F.size("_w"), F.floor(h / 10)
    a = g % n
    chosen = chosen.withColumns({"_a": a, "_p": 1 + F.floor((n - a) / (3 + g % 8))})
    place = lambda i: F.when(i < F.col("_a"), i).otherwise(F.col("_a") + (i - F.col("_a")) % F.col("_p")).cast("int")
    moved = F.array_join(F.transform("_w", lambda w, i: F.get("_w", place(i))), " ")
    return chosen.withColumn(text, F.when(F.size("_w") > 0, moved).otherwise(F.col(text))).drop("_w", "_a", "_p")


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    found = collapse_runs(with_planted_period(docs))
    top = F.array_max(F.transform("runs", lambda r: F.struct(
        r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    lines = F.array_join(F.transform("runs", lambda r: F.concat_ws(",", *[
        r[c].cast("string") for c in ("start", "length", "period")])), "\n")
    lines = F.when(F.size("runs") > 0, F.concat(lines, F.lit("\n"))).otherwise("")
    out = found.select(
        F.col("row.doc_id").alias("doc_id"), F.size("runs").cast("long").alias("n_runs"), top.alias("top"),
        F.sha2(lines, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
    return out.select(
        "doc_id", "n_runs", (-F.col("top.start")).alias("start"), F.col("top.length").alias("length"),
        (-F.col("top.period")).alias("period"), F.expr("1000 * top.length div -top.period").alias("exponent_milli"),
        "runs_sha256", "collapsed_sha256")
