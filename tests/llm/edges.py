"""A small table with every awkward case, for all operators."""

from __future__ import annotations

import numpy as np

#: Names that the operators use inside.
CLASHING = ["id", "h", "key", "at", "row", "x", "y", "k", "place", "rank", "part", "guest", "signs", "found", "gone", "places", "pattern", "lettered", "score_"]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{c} string" for c in CLASHING)


def words(rng, n, k=30):
    return [f"w{rng.integers(0, k)}" for _ in range(n)]


def documents():
    rng = np.random.default_rng(7)
    long = words(rng, 4000, 2000)
    passage = words(rng, 70, 500)
    texts = [
        None, "", " \t\n ", "one", "one two", "Éa ÉB éa", "12 34 !?", " ".join(long), " ".join(long), " ".join([*long[:1000], "edit", *long[1000:]]),
        " ".join(words(rng, 20, 500) + passage + words(rng, 20, 500)), "\n".join(passage), " ".join(words(rng, 30, 500) + passage), "a " * 300, "a " * 200, "b a " * 150,
        "same text again", "same text again", "same text again", "x y 　z", "日本語のテキスト", "▁ mark  two   three", "line\none\n\n two\r\nthree", "tail ",
    ]
    ids = list(range(100, 100 + len(texts)))
    ids[16] = ids[17]  # a repeated row
    ids[4] = None
    rows = [(i, t, "en" if k % 2 else None, None if k % 5 == 0 else f"s{k % 3}", None if t is None else len(t)) for k, (i, t) in enumerate(zip(ids, texts))]
    return [(*r, *["c"] * len(CLASHING)) for r in rows]


def split(text, table=" \t\n\x0b\x0c\r"):
    out, now = [], ""
    for c in text or "":
        if c in table:
            if now:
                out.append(now)
            now = ""
        else:
            now += c
    return [*out, now] if now else out
