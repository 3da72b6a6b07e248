"""How a text is made, as numbers: pairs of character kinds, repetition, lengths."""

from __future__ import annotations

import numpy as np

from marlstone.llm.texts import SPACED, hashes, words

#: Kinds of bytes. ASCII marks that prose uses have kinds of their own; other marks and controls share one each.
KINDS = np.full(256, 11, np.int64)
for _kind, _bytes in enumerate([b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b" ", b"\n", b".", b",",
                                b"!?", b"'\"-:;()", b"|", bytes(range(0x80, 0x100))]):
    KINDS[list(_bytes)] = _kind
KINDS[[*range(0x09), *range(0x0B, 0x20), 0x7F]] = 12
_N = 13
SIZE = _N * _N + 9


def measures(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """A row of ``SIZE`` numbers for each row of a slice; a text without bytes is all zeros."""
    texts, size = len(offsets) - 1, np.diff(offsets)
    out = np.zeros((texts, SIZE), np.float32)
    kind = KINDS[data]
    owner = np.repeat(np.arange(texts), size)
    pair = kind[:-1] * _N + kind[1:]
    within = owner[:-1] == owner[1:]
    counts = np.bincount((owner[:-1] * _N * _N + pair)[within], minlength=texts * _N * _N).reshape(texts, -1)
    out[:, :_N * _N] = np.sqrt(counts / np.maximum(size - 1, 1)[:, None])

    starts, ends, first = words(data, offsets, SPACED)
    count = np.diff(first)
    some = np.maximum(count, 1)
    text = np.repeat(np.arange(texts), count)
    own = hashes(data, starts, ends)
    order = np.lexsort((own, text))
    fresh = np.ones(len(own), bool)
    fresh[1:] = (own[order][1:] != own[order][:-1]) | (text[order][1:] != text[order][:-1])
    again = np.zeros(len(own), bool)
    again[1:] = (own[1:] == own[:-1]) & (text[1:] == text[:-1])
    length = ends - starts
    upper = np.concatenate([[0], np.cumsum(kind == 1)])
    marks = np.concatenate([[0], np.cumsum((kind == 11) | (kind == 9) | (kind == 7))])

    def mean(values: np.ndarray) -> np.ndarray:
        return np.bincount(text, values, texts) / some

    extra = [
        np.bincount(text[order], fresh, texts) / some, mean(again), mean(length) / 10, np.sqrt(mean(length > 20)),
        np.sqrt(mean((upper[ends] - upper[starts]) > 1)), np.sqrt(mean(marks[ends] > marks[starts])),
        np.log1p(count) / 10, count > 0, np.log1p(size) / 10,
    ]
    out[:, _N * _N:] = np.stack(extra, axis=1)
    return out
