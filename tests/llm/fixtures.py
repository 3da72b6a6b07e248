"""Small documents with every odd case: null and empty texts, a long text, exact and near copies, repeated rows."""

from __future__ import annotations

import random

SCHEMA = "doc_id long, text string, lang string, source string, row string, node long, score string, size string, bucket string"
WORDS = {
    "aa": "the of and tion ing ther with that from this which house water light stone river".split(),
    "bb": "und der die das nicht schaft keit ung zwei wald stein licht fluss haus über".split(),
}


def prose(rng: random.Random, lang: str, n: int) -> str:
    words = [rng.choice(WORDS[lang]) + rng.choice(["", "", "er", "en", "al", "ix", "om"]) for _ in range(n)]
    lines = [" ".join(words[k:k + 9]) for k in range(0, n, 9)]
    return ".\n".join(lines)


def rows() -> list[tuple]:
    rng = random.Random(4)
    texts = [(prose(rng, lang, rng.choice([4, 30, 60, 120])), lang) for lang in ("aa", "bb") * 20]
    texts += [(None, "aa"), ("", "bb"), ("   \n ", None), ("12 %% 34", "aa"), ("One", "aa"), ("one", "aa")]
    texts += [(prose(rng, "aa", 6000), "aa")]
    base = prose(rng, "bb", 100).split(" ")
    for k in range(12):  # near copies
        own = list(base)
        own[7 * k] = f"neu{k}"
        texts.append((" ".join(own), "bb"))
    texts += [(texts[1][0], "bb")] * 5 + [(texts[1][0].upper(), "bb")]  # exact copies, and one that differs in case
    out = [(i, t, lang, [None, "s1", "s2", "s1", "s1"][i % 5], "x", i, "y", "z", "w") for i, (t, lang) in enumerate(texts)]
    return out + [out[3], out[3], (None, texts[1][0], None, None, None, None, None, None, None)]
