"""Exact and near duplicates against brute force."""

import hashlib
import re
from itertools import combinations

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from shelfscout.llm import chunk_dedup, simhash
from shelfscout.llm.common import keep_rows

SCHEMA = "doc_id long, text string, lang string, id string, text_key int, kept boolean"


def docs(spark, texts, ids=None):
    """A documents table whose other columns have the names operators use themselves."""
    ids = range(len(texts)) if ids is None else ids
    return spark.createDataFrame([(i, t, None, "x", 1, False) for i, t in zip(ids, texts, strict=True)], SCHEMA)


def long_text(seed, words=3000):
    rng = np.random.default_rng(seed)
    return " ".join("".join(chr(97 + c) for c in rng.integers(0, 26, rng.integers(1, 9))) for _ in range(words))


TEXTS = [
    "a b c", "abc", " a\tb\nc ", "abcd", None, "", " \r\n", "é x", "éx", long_text(1), long_text(1) + " \n",
    long_text(1) + "z", "x" + long_text(1), "y" * 5000, "y" * 5000 + "y", "\U0001f600 b", "\U0001f600b",
]


@pytest.mark.parametrize("weak", [False, True])
def test_exact_dedup_equals_grouping_by_text(spark, weak):
    # A hash of the length alone makes unequal chunks collide.
    chunk_hash = (lambda chunk: F.char_length(chunk).cast("long")) if weak else F.xxhash64
    found = chunk_dedup.chunk_dedup(docs(spark, TEXTS), chunk_hash=chunk_hash).collect()
    groups = {}
    for i, text in enumerate(TEXTS):
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]", "", text or ""), []).append(i)
    want = set()
    for stripped, members in groups.items():
        keep = min(members, key=lambda i: (-len(TEXTS[i] or ""), i))
        digest = hashlib.sha256(stripped.encode()).hexdigest()
        want |= {(i, keep, len(members), i == keep, digest) for i in members}
    assert {(r.id, r.keep_id, r.group_size, r.kept, r.text_sha256) for r in found} == want


def test_chunks_cover_the_text_and_survive_an_insertion(spark):
    text = long_text(7, 20_000).replace(" ", "")
    cut = re.compile(chunk_dedup.CHUNK)
    one, other = cut.findall(text), cut.findall("inserted" + text)
    assert "".join(one) == text
    assert len(set(one) & set(other)) > 0.9 * len(one)


def test_exact_dedup_of_repeated_rows_null_ids_and_nothing(spark):
    repeated = docs(spark, ["q", "q", "q", "r", "r"], [5, 5, 5, None, None])
    found = chunk_dedup.chunk_dedup(repeated)
    assert sorted((r.text_sha256[:2], r.kept) for r in found.where("kept").collect()) == sorted(
        (hashlib.sha256(t.encode()).hexdigest()[:2], True) for t in "qr"
    )
    kept = keep_rows(repeated, found, "doc_id", "text")
    assert kept.columns == repeated.columns
    assert sorted(r.text for r in kept.collect()) == ["q", "r"]
    assert chunk_dedup.chunk_dedup(docs(spark, [])).count() == 0


def brute_fingerprint(text, shingle):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    runs = [words] if len(words) < shingle else [words[i : i + shingle] for i in range(len(words) - shingle + 1)]
    hashes = [xxhash.xxh64_intdigest(b" ".join(run), 42) for run in runs]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def brute_components(codes, most):
    root = list(range(len(codes)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in combinations(range(len(codes)), 2):
        if (codes[i] ^ codes[j]).bit_count() <= most:
            a, b = find(i), find(j)
            root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(codes))]


def test_fingerprints_equal_their_definition(spark, monkeypatch):
    texts = [None, "", "one", "One two", "A b\x0bc", "é É x y z", long_text(3, 500), "a a a a a a"]
    found = simhash.fingerprints(docs(spark, texts), "doc_id", "text", 3).collect()
    assert {(r.id, r.code % 2**64) for r in found} == {(i, brute_fingerprint(t, 3)) for i, t in enumerate(texts)}
    monkeypatch.setattr(simhash, "AT_ONCE", 7)
    assert simhash.fingerprint(long_text(3, 500), 3) == brute_fingerprint(long_text(3, 500), 3)


def crowded(seed=5):
    """Random codes, and clusters whose members differ in few bits, dense enough to be divided."""
    rng = np.random.default_rng(seed)
    codes = set(map(int, rng.integers(0, 2**63, 300)))
    for centre in list(codes)[:10]:
        for _ in range(25):
            a, b, c = (int(x) for x in rng.integers(0, 64, 3))
            codes |= {centre ^ (1 << a), centre ^ (1 << a) ^ (1 << b), centre ^ (1 << a) ^ (1 << b) ^ (1 << c)}
    return sorted(codes)


@pytest.mark.parametrize(("most", "node"), [(0, 8192), (2, 8192), (2, 8), (3, 16)])
def test_index_finds_every_link(spark, monkeypatch, most, node):
    # A small node size makes every crowded node divide again, down to a few free bits.
    monkeypatch.setattr(simhash, "NODE", node)
    codes = crowded()
    signed = [(code - 2**64 if code >> 63 else code,) for code in codes]
    table = spark.createDataFrame(signed, "code long")
    roots = brute_components(codes, most)
    found = {r.node % 2**64: r.root for r in simhash.components(simhash.links(table, most)).collect()}
    same = {}
    for code, root in zip(codes, roots, strict=True):
        same.setdefault(root, set()).add(found.get(code, code - 2**64 if code >> 63 else code))
    assert all(len(names) == 1 for names in same.values())
    assert len({next(iter(names)) for names in same.values()}) == len(same)


def test_near_duplicates_of_nulls_ties_and_nothing(spark):
    texts = ["p q r s", "p  Q r\ns", None, "", "unique words here now", "p q r s"]
    table = docs(spark, texts, [3, 1, 9, 8, 4, None])
    found = simhash.near_duplicates(table, shingle=3, most=2)
    assert {(r.id, r.component, r.kept) for r in found.collect()} == {
        (3, 1, False), (1, 1, True), (None, 1, False), (9, 8, False), (8, 8, True), (4, 4, True),
    }
    kept = keep_rows(table, found, "doc_id", "text")
    assert sorted(r.doc_id for r in kept.collect()) == [1, 4, 8]
    assert simhash.near_duplicates(docs(spark, [])).count() == 0


def test_near_duplicates_over_the_test_documents(spark):
    table = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(r.doc_id, r.text) for r in table.collect()]
    codes = [brute_fingerprint(text, 3) for _, text in rows]
    roots = brute_components(codes, 2)
    least = {}
    for (i, _), root in zip(rows, roots, strict=True):
        least[root] = min(least.get(root, i), i)
    found = {r.id: (r.code % 2**64, r.component) for r in simhash.near_duplicates(table).collect()}
    assert found == {i: (code, least[root]) for (i, _), code, root in zip(rows, codes, roots, strict=True)}
