"""Ranked lexical search against a brute-force ranking."""

import math
import re
from collections import Counter

import numpy as np
import pytest

from shelfscout.llm import lexical_search

DOCS = "doc_id long, text string, item string, term int, n string, at string, m string, score string"
ITEMS = "item_id long, text string, id string, rank string"
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def docs(spark, rows):
    return spark.createDataFrame([(i, t, "x", 1, "n", "a", "m", "s") for i, t in rows], DOCS)


def items(spark, rows):
    return spark.createDataFrame([(i, t, "x", "r") for i, t in rows], ITEMS)


def terms(text):
    return TERM.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, k):
    counted = [(i, Counter(terms(t))) for i, t in docs if terms(t)]
    total = sum(sum(c.values()) for _, c in counted)
    holding = Counter(t for _, c in counted for t in c)
    asked = {}
    for i, t in items:
        asked.setdefault(i, set()).update(terms(t))
    rows = []
    for item, wanted in asked.items():
        scored = []
        for i, c in counted:
            m = 10 + 90 * sum(c.values()) * len(counted) // total
            score = sum(
                math.floor(1000 * math.log((2 * len(counted) + 2) / (2 * holding[t] + 1)))
                * (1000000000 * c[t] // (1000 * c[t] + 8 * m))
                for t in wanted & c.keys()
            )
            if score > 0:
                scored.append((-score, i is None, i or 0, i))
        rows += [(item, n, i, -s) for n, (s, _, _, i) in enumerate(sorted(scored, key=lambda x: x[:3])[:k], 1)]
    return Counter(rows)


def corpus():
    rng = np.random.default_rng(5)
    words = ["the", "of", "The", "été", "ÉTÉ", "x1", "1", "a-b", "a_b", "naïve", "zz", "Q", "日本", "end."]
    made = [(i, " ".join(rng.choice(words, int(rng.integers(0, 30))))) for i in range(150)]
    same = [(i, "the same row, the same") for i in (900, 901, 901, None, None)]
    odd = [(700, None), (701, ""), (702, " \x00..\x7f"), (703, "the " * 60000 + "rare"), (704, "KK İI")]
    return made + same + odd


ASKED = [
    (1, "the same SAME été"),
    (2, "rare x1 x1"),
    (3, None),
    (4, "no-such nothing"),
    (None, "zz K"),
    (5, "ÉTÉ 1 b"),
    (5, "naïve"),
    (6, "theof he"),
]


@pytest.mark.parametrize("part_bytes", [1 << 20, 30])
@pytest.mark.parametrize("k", [1, 10])
def test_equals_brute_force(spark, monkeypatch, part_bytes, k):
    monkeypatch.setattr(lexical_search, "HELD", 20)
    monkeypatch.setattr(lexical_search, "AT_ONCE", 50)
    found = lexical_search.search(docs(spark, corpus()).repartition(3), items(spark, ASKED), k, part_bytes=part_bytes)
    assert Counter(tuple(row) for row in found.collect()) == brute(corpus(), ASKED, k)


def test_nothing_to_search(spark):
    assert lexical_search.search(docs(spark, []), items(spark, ASKED)).count() == 0
    assert lexical_search.search(docs(spark, corpus()), items(spark, [])).count() == 0
    assert lexical_search.search(docs(spark, [(1, None), (2, "..")]), items(spark, [(1, None)])).count() == 0
