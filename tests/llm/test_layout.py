"""Mixing, shards and packing: exact sums, exact round trips."""

import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from shelfscout.llm import mixing, packing, sharding

PATH = public_tokenizers.path("byte_bpe_50k.json")
SCHEMA = "doc_id long, text string, source string, size string, cell int, copies string"


def docs(spark, rows):
    return spark.createDataFrame([(i, text, source, "x", 0, None) for i, text, source in rows], SCHEMA)


def corpus():
    rng = np.random.default_rng(3)
    rows = []
    for i in range(600):
        source = "hot" if i % 3 == 0 else None if i % 11 == 0 else f"s{i % 7}"
        rows.append((i, " ".join(["w"] * int(rng.integers(0, 60) if i % 50 else 900)), source))
    return rows


def test_targets_respect_caps_and_order():
    totals = {"b": 100, "a": 1, None: 50, "z": 0, "é": 7}
    targets = mixing.source_targets(totals)
    assert sum(targets.values()) == pytest.approx(1.5 * 158)
    assert all(targets[name] <= 2 * totals[name] + 1e-9 for name in totals)
    # Sources a, b, z, é, null weigh 3, 1, 2, 3, 1; a, z and é are capped at once, b and null share the rest.
    rest = 1.5 * 158 - 2 - 0 - 14
    assert targets["b"] == pytest.approx(min(200, max(rest / 2, rest - 100)))
    assert targets[None] == pytest.approx(rest - targets["b"])
    assert mixing.source_targets({}) == {}
    assert mixing.source_targets({"a": 0}) == {"a": 0}


def test_newton_meets_overlapping_targets(spark):
    # Cells count toward a source and a language at once.
    cells = [([0, 2], 100), ([0, 3], 50), ([1, 2], 80), ([1, 3], 20)]
    table = spark.createDataFrame(cells, "at array<int>, size long")
    rates = np.array([1.2, 0.5, 0.9, 1.6])
    sizes = np.array([size for _, size in cells])
    member = np.array([[j in at for j in range(4)] for at, _ in cells])
    targets = (rates * sizes) @ member
    unknown = mixing.solve(table, targets, most=3.0)
    assert (np.exp(member @ unknown) * sizes) @ member == pytest.approx(targets, rel=1e-6)


def test_mix_meets_targets_and_reruns_agree(spark):
    rows = corpus()
    found = mixing.mix(docs(spark, rows)).collect()
    assert sorted(r.id for r in found) == [i for i, *_ in rows]
    source = {i: s for i, _, s in rows}
    size = {i: len(t.split()) for i, t, _ in rows}
    totals = defaultdict(int)
    for i, s in source.items():
        totals[s] += size[i]
    targets = mixing.source_targets(dict(totals))
    taken = defaultdict(int)
    for r in found:
        assert (r.size, r.source_size) == (size[r.id], totals[source[r.id]])
        assert r.target == pytest.approx(targets[source[r.id]])
        assert 0 <= r.copies <= 2
        taken[source[r.id]] += r.copies * r.size
    for name, target in targets.items():
        assert abs(taken[name] - target) <= 2, name
    again = mixing.mix(docs(spark, rows).repartition(7)).collect()
    assert {(r.id, r.copies) for r in again} == {(r.id, r.copies) for r in found}


def test_mix_of_equal_rows_nulls_and_nothing(spark, monkeypatch):
    monkeypatch.setattr(mixing, "RANKED", 5)
    rows = [(None, "a b c", "s")] * 40 + [(1, None, None), (2, "x", "t"), (3, "", "u")]
    table = docs(spark, rows)
    found = mixing.mix(table)
    copied = mixing.copy_rows(table, found, "doc_id", "text")
    assert copied.columns == table.columns
    counts = {r.source: r["count"] for r in copied.groupBy("source").count().collect()}
    targets = mixing.source_targets({"s": 120, None: 0, "t": 1, "u": 0})
    assert abs(3 * counts["s"] - targets["s"]) <= 3
    assert mixing.mix(docs(spark, [])).count() == 0


@pytest.mark.parametrize("shards", [1, 3, 40])
def test_shards_are_even_contiguous_and_gapless(spark, monkeypatch, shards):
    monkeypatch.setattr(sharding, "ROWS", 50)
    monkeypatch.setattr(sharding, "GROUP", 3)
    rows = [*corpus(), (7, "é" * 9, "s"), (7, "é" * 9, "s"), (None, None, None), (None, "", None)]
    found = sharding.byte_shards(docs(spark, rows), shards).collect()
    want = sorted((len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for _, t, _ in rows)
    assert sorted((r.size, r.text_crc32) for r in found) == want
    by_shard = defaultdict(list)
    for r in found:
        by_shard[r.shard].append(r)
    total, largest = sum(r.size for r in found), max(r.size for r in found)
    for members in by_shard.values():
        assert sorted(r.slot for r in members) == list(range(len(members)))
        assert abs(sum(r.size for r in members) - total / shards) <= largest
    again = sharding.byte_shards(docs(spark, rows).repartition(5), shards).collect()
    assert sorted((r.size, r.text_crc32, r.shard, r.slot) for r in again) == sorted(
        (r.size, r.text_crc32, r.shard, r.slot) for r in found
    )


@pytest.mark.parametrize("shards", [1, 7, 40])
def test_shards_are_cut_where_the_prefix_sums_say(spark, shards):
    """The whole order, row by row: a row goes where its middle byte lies; a very long text included."""
    rows = [*corpus(), (9001, "x" * 400_000, "s"), (9002, None, "s"), (9002, None, "s"), (None, "y z", None)]
    found = sorted(sharding.byte_shards(docs(spark, rows), shards).collect(), key=lambda r: (r.shard, r.slot))
    assert len(found) == len(rows)
    total, before, slots = sum(r.size for r in found), 0, {}
    for r in found:
        assert r.shard == min((2 * before + r.size) * shards // (2 * total), shards - 1)
        assert r.slot == slots.get(r.shard, 0)
        slots[r.shard] = r.slot + 1
        before += r.size


def test_a_very_long_text_is_mixed_like_any_other(spark):
    rows = [(1, "w " * 500_000, "a"), (2, "w w", "a"), (3, "w", "b")]
    found = {r.id: (r.size, r.source_size) for r in mixing.mix(docs(spark, rows)).collect()}
    assert found == {1: (500_000, 500_002), 2: (2, 500_002), 3: (1, 1)}


def test_shards_of_few_rows_and_nothing(spark):
    assert [r.slot for r in sharding.byte_shards(docs(spark, [(1, "a", "s")]), 5).collect()] == [0]
    assert sharding.byte_shards(docs(spark, []), 5).count() == 0
    with pytest.raises(ValueError, match="at least one"):
        sharding.byte_shards(docs(spark, []), 0)


ODD = [
    None, "", "  ", " a  b\n c \n d\n\n e", "<|endoftext|> x 's don't", "a\x85b 　 c", "x\n y\t z", "\x1c \x1d a",
    "plain words, and more words.", "word " * 4000, "x" * 3000, "\U0001f600 é 12 345 !!",
]


@pytest.mark.parametrize("text", [*filter(None, ODD), "a b", " a", "a ", "a\n b", "a \nb", "a\nb c", "a\u3000 b", "\x1f a b"])
def test_texts_are_cut_at_single_spaces(text):
    assert packing.spaced(text) == packing.SPACE.split(text)


@pytest.mark.parametrize("at_once", [1 << 20, 50])
def test_pieces_hold_every_id_once(spark, monkeypatch, at_once):
    monkeypatch.setattr(packing, "AT_ONCE", at_once)
    monkeypatch.setattr(packing, "REMEMBERED", 3)
    tokenizer = Tokenizer.from_file(PATH)
    tokenizer.encode_special_tokens = True
    rows = [(i, text, "s") for i, text in enumerate(ODD)]
    found = packing.decompose(docs(spark, rows), PATH, longest=64, end_id=0)
    by_doc = defaultdict(list)
    for r in found.collect():
        assert r.length == len(r.ids) // 4
        assert r.length & (r.length - 1) == 0 and r.length <= 64
        assert r.offset == 0
        by_doc[r.id].append(r)
    for i, text in enumerate(ODD):
        want = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]
        pieces = sorted(by_doc[i], key=lambda r: r.start)
        assert [r.start for r in pieces] == list(np.cumsum([0, *[r.length for r in pieces[:-1]]]))
        assert np.frombuffer(b"".join(bytes(r.ids) for r in pieces), "<u4").tolist() == want
        assert {r.doc_tokens for r in pieces} == {len(want)}
        lengths = [r.length for r in pieces]
        assert lengths == packing.lengths_of(len(want), 64)
    sequences = [r.sequence for pieces in by_doc.values() for r in pieces]
    assert len(sequences) == len(set(sequences))


def test_pieces_of_repeated_and_null_ids_and_buckets(spark, tmp_path):
    rows = [(None, "a b", "s"), (1, "a b", "s"), (1, "a b", "s")]
    found = packing.decompose(docs(spark, rows), PATH)
    assert found.count() == 6
    packing.write_buckets(found, f"{tmp_path}/buckets")
    assert spark.read.parquet(f"{tmp_path}/buckets").where(F.col("length") == 1).count() == 3
    assert packing.decompose(docs(spark, []), PATH).count() == 0
    with pytest.raises(ValueError, match="power of two"):
        packing.decompose(found, PATH, longest=100)
