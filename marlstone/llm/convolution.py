"""A convolutional text classifier in numpy: hashed word embeddings, several filter widths, max pooling over the text."""

from __future__ import annotations

import copy
from dataclasses import dataclass, field

import numpy as np

from marlstone.llm.texts import ALNUM, hashes, mix, words

#: Rows of the embedding tables for words and for word beginnings.
WORD_ROWS, STEM_ROWS = 1 << 16, 1 << 14
#: Words of a training step, which bounds its arrays; a longer text is a step of its own.
STEP_WORDS = 1 << 20
#: Bytes of the word beginnings.
STEMS = (4, 5)
DIM = 6
WIDTHS = (1, 2, 3)
FILTERS = 8


@dataclass
class Classifier:
    tables: list[np.ndarray]  # of words and of each beginning
    filters: list[np.ndarray]  # by width: filters x (width * DIM)
    biases: list[np.ndarray]
    out: np.ndarray  # (1 + languages) x all filters: toxicity and language
    out_bias: np.ndarray
    cuts: np.ndarray = field(default_factory=lambda: np.zeros(1))  # by language, in the toxicity score


def word_rows(data: np.ndarray, offsets: np.ndarray) -> tuple[tuple[np.ndarray, ...], np.ndarray]:
    """Rows of each word in the tables, and where the words of each text start (texts + 1)."""
    starts, ends, first = words(data, offsets, ALNUM)
    rows = [hashes(data, starts, ends)]
    rows += [mix(hashes(data, starts, np.minimum(ends, starts + n)) + np.uint64(n)) for n in STEMS]
    sizes = (WORD_ROWS, *[STEM_ROWS] * len(STEMS))
    return tuple((r >> np.uint64(20)).astype(np.int64) & (n - 1) for r, n in zip(rows, sizes)), first


def features(model: Classifier, rows: tuple[np.ndarray, ...], first: np.ndarray, shift: np.ndarray | None = None):
    """Per text the maximum of every filter (0 at least), and the word where it is reached (-1: nowhere)."""
    texts, total = len(first) - 1, len(rows[0])
    vectors = np.zeros((total + max(WIDTHS), DIM), np.float32)
    vectors[:total] = sum(t[r] for t, r in zip(model.tables, rows))
    if shift is not None:
        vectors[:total, 0] += shift
    owner_end = np.repeat(first[1:], np.diff(first))
    best = np.zeros((texts, len(WIDTHS) * FILTERS), np.float32)
    where = np.full(best.shape, -1)
    filled = np.flatnonzero(np.diff(first) > 0)
    for k, width in enumerate(WIDTHS):
        filters = model.filters[k].reshape(FILTERS, width, DIM)
        values = np.repeat(model.biases[k][None, :], total, axis=0)
        for j in range(width):
            part = vectors[j:j + total] @ filters[:, j].T
            if j:
                part[np.arange(total) + j >= owner_end] = 0
            values += part
        if not len(filled):
            continue
        top = np.maximum.reduceat(values, first[filled], axis=0)
        columns = slice(k * FILTERS, (k + 1) * FILTERS)
        best[filled, columns] = np.maximum(top, 0)
        places = where[:, columns]
        if model.cuts is None:  # training: find the places
            for f in range(FILTERS):
                hit = np.flatnonzero(values[:, f] == np.repeat(top[:, f], np.diff(first)[filled]))
                text = np.searchsorted(first, hit, "right") - 1
                text, once = np.unique(text, return_index=True)
                places[text, f] = np.where(best[text, k * FILTERS + f] > 0, hit[once], -1)
    return best, where, vectors


def scores(model: Classifier, rows: tuple[np.ndarray, ...], first: np.ndarray) -> np.ndarray:
    best, _, _ = features(model, rows, first)
    return best @ model.out.T + model.out_bias


def lean(bad: np.ndarray, good: np.ndarray) -> np.ndarray:
    """How much more often words occur in toxic texts, from shares of both kinds of text; shrunk for rare words."""
    count = bad[0] + good[0]
    return np.clip((np.log((bad[0] + 0.5) / bad[1]) - np.log((good[0] + 0.5) / good[1])) * count / (count + 10), -3, 3)


def kind_counts(rows: tuple[np.ndarray, ...], first: np.ndarray, toxic: np.ndarray) -> list[np.ndarray]:
    """For each table, in how many toxic and in how many other texts each of its rows occurs (2 x rows)."""
    owner, out = np.repeat(np.arange(len(first) - 1), np.diff(first)), []
    for r, size in zip(rows, (WORD_ROWS, *[STEM_ROWS] * len(STEMS))):
        pair = np.unique(owner * size + r)
        mark = toxic[pair // size]
        out.append(np.stack([np.bincount(pair % size, w, size) for w in (mark, 1 - mark)]))
    return out


def without_own(rows: tuple[np.ndarray, ...], first: np.ndarray, toxic: np.ndarray, counts: list[np.ndarray], totals) -> np.ndarray:
    """For each word what its lean differs by without its own text.

    The fit sees each text with the lean that all other texts give its words, as a new text would.
    """
    shift, mark = np.zeros(len(rows[0]), np.float32), np.repeat(toxic.astype(np.uint8), np.diff(first))
    for r, (bad, good) in zip(rows, counts):
        start = lean((bad, totals[0]), (good, totals[1]))
        less = [lean((np.maximum(bad - k, 0), totals[0]), (np.maximum(good - 1 + k, 0), totals[1])) - start for k in (0, 1)]
        shift += np.where(mark == 1, less[1][r], less[0][r])
    return shift


@dataclass
class Fit:
    """A classifier in training, with what its steps remember."""

    model: Classifier
    counts: list[np.ndarray]  # by table, as kind_counts gives them for all texts
    totals: tuple[float, float]  # toxic and other texts, each plus 1
    moments: list[tuple[np.ndarray, np.ndarray]]
    pace: list[np.ndarray]  # by table
    step: int = 0

    def values(self) -> list[np.ndarray]:
        return [*self.model.filters, *self.model.biases, self.model.out, self.model.out_bias]


def begin(rng: np.random.Generator, counts: list[np.ndarray], totals: tuple[float, float], languages: int) -> Fit:
    """A classifier before its first step; the first column of its tables is the lean of the words."""
    tables = [rng.normal(0, 0.1, (n, DIM)).astype(np.float32) for n in (WORD_ROWS, *[STEM_ROWS] * len(STEMS))]
    for table, (bad, good) in zip(tables, counts):
        table[:, 0] = lean((bad, totals[0]), (good, totals[1]))
    model = Classifier(
        tables, [rng.normal(0, 0.3, (FILTERS, w * DIM)).astype(np.float32) for w in WIDTHS],
        [np.zeros(FILTERS, np.float32) for _ in WIDTHS],
        rng.normal(0, 0.2, (1 + languages, len(WIDTHS) * FILTERS)).astype(np.float32), np.zeros(1 + languages, np.float32), None,
    )
    for k, w in enumerate(WIDTHS):
        model.filters[k][:FILTERS // 2, ::DIM] = np.abs(model.filters[k][:FILTERS // 2, ::DIM]) + 0.5 / w
    fit = Fit(model, counts, totals, [], [np.full(len(t), 1e-2, np.float32) for t in tables])
    fit.moments = [(np.zeros_like(v), np.zeros_like(v)) for v in fit.values()]
    return fit


def all_epochs(epochs: int, texts: int, batch: int = 64) -> int:
    """Epochs of a fit: few texts are read more often."""
    return max(epochs, 300 * batch // max(texts, 1))


def train(
    rows: tuple[np.ndarray, ...], first: np.ndarray, toxic: np.ndarray, language: np.ndarray, languages: int,
    epochs: int, batch: int = 64, rate: float = 0.02, seed: int = 3,
) -> Classifier:
    """Fit on texts with marks; ``language`` -1 is unknown."""
    rng = np.random.default_rng(seed)
    rest = rng.permutation(len(toxic))
    totals = float(toxic.sum() + 1), float((1 - toxic).sum() + 1)
    fit = begin(rng, kind_counts(rows, first, toxic.astype(float)), totals, languages)
    advance(fit, rows, first, toxic, language, rest, rng, all_epochs(epochs, len(rest), batch), batch, rate)
    return fit.model


def advance(
    fit: Fit, rows: tuple[np.ndarray, ...], first: np.ndarray, toxic: np.ndarray, language: np.ndarray, rest: np.ndarray,
    rng: np.random.Generator, epochs: int, batch: int = 64, rate: float = 0.02,
) -> None:
    """Go on with a fit over texts for some epochs. A step reads ``batch`` texts, or fewer when these have many words."""
    shift = without_own(rows, first, toxic, fit.counts, fit.totals)
    model, values, moments, pace, languages = fit.model, fit.values(), fit.moments, fit.pace, len(fit.model.out) - 1

    def of(texts):
        index = np.concatenate([np.arange(first[t], first[t + 1]) for t in texts])
        at = np.concatenate([[0], np.cumsum(first[texts + 1] - first[texts])])
        return tuple(r[index] for r in rows), at, shift[index]

    def batches():
        for k in range(0, len(rest), batch):
            texts = rest[k:k + batch]
            part = np.cumsum(first[texts + 1] - first[texts]) // STEP_WORDS
            yield from np.split(texts, np.flatnonzero(np.diff(part)) + 1)

    for _ in range(epochs):
        rng.shuffle(rest)
        for texts in batches():
            fit.step += 1
            step = fit.step
            own, at, off = of(texts)
            best, where, vectors = features(model, own, at, off)
            logits = best @ model.out.T + model.out_bias
            pull = np.zeros_like(logits)
            pull[:, 0] = (0.5 * np.tanh(0.5 * logits[:, 0]) + 0.5) - toxic[texts]
            named = np.flatnonzero(language[texts] >= 0)
            if languages and len(named):
                chance = np.exp(logits[named, 1:] - logits[named, 1:].max(axis=1, keepdims=True))
                chance /= chance.sum(axis=1, keepdims=True)
                chance[np.arange(len(named)), language[texts][named]] -= 1
                pull[named, 1:] = 0.3 * chance
            pull /= len(texts)
            found = [np.zeros_like(v) for v in values]
            found[-2], found[-1] = pull.T @ best, pull.sum(axis=0)
            flow = pull @ model.out
            grads = np.zeros_like(vectors)
            for i, width in enumerate(WIDTHS):
                filters = model.filters[i].reshape(FILTERS, width, DIM)
                for f in range(FILTERS):
                    place = where[:, i * FILTERS + f]
                    hit = np.flatnonzero(place >= 0)
                    g, p = flow[hit, i * FILTERS + f], place[hit]
                    found[len(WIDTHS) + i][f] = g.sum()
                    for j in range(width):
                        inside = p + j < at[hit + 1]
                        found[i].reshape(FILTERS, width, DIM)[f, j] = (g * inside) @ vectors[p + j]
                        np.add.at(grads, p + j, (g * inside)[:, None] * filters[f, j])
            for v, g, (m, s) in zip(values, found, moments):
                m += 0.1 * (g - m)
                s += 0.01 * (g * g - s)
                v -= rate * (m / (1 - 0.9 ** step)) / (np.sqrt(s / (1 - 0.99 ** step)) + 1e-6)
            moved = np.flatnonzero(np.abs(grads[:len(own[0])]).sum(axis=1) > 0)
            for table, r, speed in zip(model.tables, own, pace):
                np.add.at(speed, r[moved], (grads[moved] ** 2).sum(axis=1))
                np.add.at(table, r[moved], -0.02 * grads[moved] / np.sqrt(speed[r[moved]])[:, None])


def moved(before: Fit, after: Fit, texts: int) -> list[np.ndarray]:
    """What a shard's steps changed, as arrays that add up over shards: see :func:`joined`."""
    out = [np.array([texts, texts * after.step], np.float64)]
    for old, new, slow, fast in zip(before.model.tables, after.model.tables, before.pace, after.pace):
        out += [new - old, fast - slow, (fast > slow).astype(np.float32)]
    for value, (m, s) in zip(after.values(), after.moments):
        out += [texts * value.astype(np.float64), texts * m.astype(np.float64), texts * s.astype(np.float64)]
    return out


def joined(before: Fit, total: list[np.ndarray]) -> Fit:
    """The fit after a round: a table's row moves by the mean of the shards that moved it, all else is the mean by texts."""
    texts, fit = total[0][0], copy.deepcopy(before)
    fit.step, rest = int(round(total[0][1] / texts)), iter(total[1:])
    for table, pace in zip(fit.model.tables, fit.pace):
        change, faster, shards = next(rest), next(rest), np.maximum(next(rest), 1)
        table += change / shards[:, None]
        pace += faster / shards
    for value, (m, s) in zip(fit.values(), fit.moments):
        for array in (value, m, s):
            array[...] = next(rest) / texts
    return fit
