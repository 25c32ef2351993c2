"""Divergence of sources against its definition in plain integers."""

import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from shelfscout.llm import divergence

SCHEMA = "doc_id long, text string, lang string, source string, term string, count int, bits string, part int, value string"
TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def docs(spark, rows):
    return spark.createDataFrame([(i, *row, "t", 1, "b", 2, "v") for i, row in enumerate(rows)], SCHEMA)


def terms(text):
    return TERM.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute(rows, least, most):
    rows = [tuple(x or "" for x in row) for row in rows]
    found = []
    for lang in {lang for _, lang, _ in rows}:
        holding, groups = Counter(), defaultdict(Counter)
        for text, one, source in rows:
            if one == lang:
                holding.update(set(terms(text)))
                groups[source].update(terms(text))
        kept = [t for t, n in holding.items() if n >= least]
        total = sum((Counter({t: c[t] for t in kept}) for c in groups.values()), Counter())

        def share(counts, kept=kept):
            size = sum(counts[t] for t in kept) + len(kept)
            return {t: 1 + 1000000000 * (counts[t] + 1) // size for t in kept}

        shares, whole = {s: share(c) for s, c in groups.items()}, share(total)
        for s, p in shares.items():
            pairs = [(-sum((p[t] - q[t]) ** 2 // q[t] for t in kept), o.encode(), o) for o, q in shares.items() if o != s]
            found += [(lang, s, "pair", o, -v, n) for n, (v, _, o) in enumerate(sorted(pairs), 1)]
            own = [
                (-((p[t] - whole[t]) ** 2 // whole[t]), t.encode(), t) for t in kept if groups[s][t] and p[t] > whole[t]
            ]
            found += [(lang, s, "term", t, -v, n) for n, (v, _, t) in enumerate(sorted(own)[:most], 1)]
    return Counter(found)


def corpus():
    rng = np.random.default_rng(11)
    words = ["the", "The", "of", "é", "É", "naïve", "x1y", "日本", "a-b", "Zz", "q"] + [f"w{chr(97 + i)}" for i in range(26)]
    weights = 1 / np.arange(1, len(words) + 1)
    rows = []
    for i in range(400):
        lang = ["en", "en", "fr", None, ""][i % 5]
        source = "hot" if i % 3 == 0 else None if i % 11 == 0 else f"s{i % 7}"
        rows.append((" ".join(rng.choice(words, int(rng.integers(0, 25)), p=weights / weights.sum())), lang, source))
    rows += [("the the", "xx", "a"), ("the 12", "xx", "b"), (None, "xx", "c")]  # keeps no term
    rows += [(None, "fr", "bare"), ("", "en", "none"), ("the " * 30000, "en", "s1"), ("İ K ſ", "en", "s2")]
    return rows + rows[:60]


@pytest.mark.parametrize(("block", "part"), [(1024, 64), (4, 2), (70, 1)])
def test_equals_the_definition(spark, monkeypatch, block, part):
    monkeypatch.setattr(divergence, "HELD", 40)
    monkeypatch.setattr(divergence, "AT_ONCE", 5)
    table = docs(spark, corpus()).repartition(3)
    found = divergence.audit(table, least_docs=3, most_terms=7, block=block, part=part)
    assert Counter(tuple(row) for row in found.collect()) == brute(corpus(), 3, 7)


def test_nothing_and_one_group(spark):
    assert divergence.audit(docs(spark, [])).count() == 0
    rows = [("a b", "en", "s")] * 3
    assert Counter(tuple(r) for r in divergence.audit(docs(spark, rows)).collect()) == brute(rows, 3, 200)
    rows = [("a", "en", "s"), (None, "en", "t"), ("..", None, None)]
    assert Counter(tuple(r) for r in divergence.audit(docs(spark, rows)).collect()) == brute(rows, 3, 200)


def test_shares_of_counts_beyond_64_bits():
    assert divergence.shares(np.array([10**15]), 2 * 10**15).tolist() == [1 + 10**9 * (10**15 + 1) // (2 * 10**15)]
