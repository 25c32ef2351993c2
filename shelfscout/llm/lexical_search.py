"""Ranked lexical search by scanning the documents for the terms of all items.

Every term of the items is put between two boundary marks into one Aho-Corasick
automaton, which goes to every task. One scan of the documents counts how often
each of these terms occurs, straight from the text: no index of the documents
is built, and only what the items ask for is counted. Weights follow from the
counts of the whole corpus; a second pass, over the counts alone, maps terms to
the items that hold them and keeps the best documents of each item per task.

Items are dealt to parts of at most about ``PART_BYTES`` of terms, each with an
automaton and a scan of its own, so that what is sent to the tasks is bounded
however many items there are.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from functools import reduce
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfscout.llm.common import term_table, text_of
from shelfscout.session import materialise

FOLD = term_table(digits=True)
# UTF-8 bytes of (item, term) pairs that one automaton serves.
PART_BYTES = 4 << 20
# Postings, and cells of (document, item), that are added up at a time.
AT_ONCE = 1 << 21
# Candidates a task holds before it cuts them back to the best of each item.
HELD = 1 << 17
# Fixed by the scoring rule: saturation and the share of the length in it.
UNIT, SLOPE, STEP, LENGTH_SHARE = 1_000_000_000, 1000, 8, 90


def item_terms(items: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """One row per item id and distinct term: ``item``, ``term``."""
    read = items.select(F.col(f"`{id_col}`").cast("long").alias("item"), text_of(text_col).alias("text"))

    def task(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for item, text in zip(part.column("item").to_pylist(), part.column("text"), strict=True):
                terms = sorted(set(text.as_py().encode().translate(FOLD).split()))
                found = pa.array(terms, pa.binary()).cast(pa.string())
                yield pa.record_batch([pa.array([item] * len(terms), pa.int64()), found], names=["item", "term"])

    return read.mapInArrow(task, "item long, term string").distinct()


def count_terms(docs: DataFrame, terms: list[str], id_col: str, text_col: str) -> DataFrame:
    """One row per document with a term at all: ``id``, ``n`` (its terms with repeats),
    ``at`` (places in ``terms`` of those it holds) and ``tf`` (how often each)."""
    read = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), text_of(text_col).alias("text"))

    def task(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import ahocorasick

        automaton = ahocorasick.Automaton()
        for place, term in enumerate(terms):
            automaton.add_word(f" {term} ", place)
        automaton.make_automaton()
        place_of = itemgetter(1)
        for part in parts:
            ids, lengths, ends, at, tf = [], [], [0], [], []
            for one, scalar in zip(part.column("id").to_pylist(), part.column("text"), strict=True):
                folded = scalar.as_py().encode().translate(FOLD)
                length = len(folded.split())
                if not length:
                    continue
                # Two neighbours share the mark between them: matches may overlap.
                found = Counter(map(place_of, automaton.iter(f" {folded.decode()} "))) if terms else {}
                ids.append(one)
                lengths.append(length)
                at += found.keys()
                tf += found.values()
                ends.append(len(at))
            lists = [pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(x, pa.int32())) for x in (at, tf)]
            yield pa.record_batch(
                [pa.array(ids, pa.int64()), pa.array(lengths, pa.int64()), *lists], names=["id", "n", "at", "tf"]
            )

    return read.mapInArrow(task, "id long, n long, at array<int>, tf array<int>")


class Best:
    """The ``k`` best (score, smaller id first, null ids last) of each item, exactly."""

    def __init__(self, k: int, items: int):
        self.k = k
        self.least = np.ones(items, np.int64)  # a score below cannot be among the best
        self.held: list[tuple[np.ndarray, ...]] = []
        self.kept = self.fresh = 0

    def add(self, scores: np.ndarray, ids: np.ndarray, null: np.ndarray) -> None:
        """``scores``: documents by items."""
        doc, item = np.nonzero(scores >= self.least)
        if len(doc):
            self.held.append((item, scores[doc, item], ids[doc], null[doc]))
            self.fresh += len(doc)
            if self.fresh > max(HELD, self.kept):
                self.cut()

    def cut(self) -> tuple[np.ndarray, ...]:
        if not self.held:
            return (np.empty(0, np.int64),) * 3 + (np.empty(0, bool),)
        item, score, ids, null = (np.concatenate(x) for x in zip(*self.held, strict=True))
        order = np.lexsort((ids, null, -score, item))
        item, score, ids, null = item[order], score[order], ids[order], null[order]
        rank = np.arange(len(item)) - np.searchsorted(item, item)
        full = rank == self.k - 1
        self.least[item[full]] = score[full]
        kept = rank < self.k
        self.held = [(item[kept], score[kept], ids[kept], null[kept])]
        self.kept, self.fresh = int(kept.sum()), 0
        return self.held[0]


def best_documents(
    counted: DataFrame, weights: np.ndarray, first: np.ndarray, holders: np.ndarray, items: list[int | None], k: int
) -> DataFrame:
    """The ``k`` best documents of every item within each task: ``item_id``, ``id``, ``score``.

    ``counted`` has ``id``, ``m``, ``at`` and ``tf``. Term t belongs to the items
    at ``holders[first[t]:first[t + 1]]``.
    """

    def task(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = Best(k, len(items))
        for part in parts:
            ids = part.column("id")
            null = ids.is_null().to_numpy(zero_copy_only=False)
            ids = ids.fill_null(0).to_numpy()
            m = part.column("m").to_numpy()
            at = part.column("at").flatten().to_numpy()
            tf = part.column("tf").flatten().to_numpy().astype(np.int64)
            ends = np.concatenate([[0], np.cumsum(part.column("at").value_lengths().to_numpy())])
            gain = weights[at] * (UNIT * tf // (SLOPE * tf + STEP * np.repeat(m, np.diff(ends))))
            spread = (first[1:] - first[:-1])[at]
            # Up to each document: postings, and cells, to cut the batch by.
            work = np.maximum(np.concatenate([[0], np.cumsum(spread)])[ends], len(items) * np.arange(len(ends)))
            start = 0
            while start < len(m):
                end = max(start + 1, int(np.searchsorted(work, work[start] + AT_ONCE, "right")) - 1)
                hits = slice(ends[start], ends[end])
                times = spread[hits]
                total = int(times.sum())
                # Posting j of a hit is holders[first[term] + j].
                offset = np.arange(total) - np.repeat(np.cumsum(times) - times, times)
                item = holders[np.repeat(first[at[hits]], times) + offset]
                doc = np.repeat(np.arange(end - start), np.diff(ends[start : end + 1]))
                scores = np.zeros((end - start) * len(items), np.int64)
                np.add.at(scores, np.repeat(doc, times) * len(items) + item, np.repeat(gain[hits], times))
                best.add(scores.reshape(end - start, len(items)), ids[start:end], null[start:end])
                start = end
        item, score, ids, null = best.cut()
        yield pa.record_batch(
            [pa.array([items[i] for i in item], pa.int64()), pa.array(ids, mask=null), pa.array(score)],
            names=["item_id", "id", "score"],
        )

    return counted.mapInArrow(task, "item_id long, id long, score long")


def _saturating_length(documents: int, terms: int) -> Column:
    weighed = F.expr(f"({LENGTH_SHARE} * n * {documents}L) div {terms}L")
    return (F.lit(100 - LENGTH_SHARE) + weighed).cast("long")


def search(
    docs: DataFrame,
    items: DataFrame,
    k: int = 10,
    doc_id: str = "doc_id",
    doc_text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    part_bytes: int = PART_BYTES,
) -> DataFrame:
    """The ``k`` best documents of every item: ``item_id``, ``rank`` (from 1), ``id``, ``score``.

    Terms are maximal runs of letters, digits and everything beyond ASCII, with
    A-Z lower-cased; an item asks for each of its terms once. Documents without
    a term count nowhere; null texts have none. Only scores above 0 are ranked,
    equal ones by ascending id, null ids last. Repeated documents, and documents
    of one id, are ranked each on its own; rows with one item id, nulls included,
    are one item with the terms of all. An item without terms, or without a
    document to show, has no row; empty tables give no rows. Texts are scanned
    whole, in memory proportional to the longest; other columns are not read.
    An item's own terms are never divided: one item may exceed ``part_bytes``.
    """
    spark = docs.sparkSession
    asked = materialise(item_terms(items, item_id, item_text), "asked-terms")
    size = asked.select(F.sum(F.octet_length("term") + 8)).first()[0] or 0
    parts = -(-size // part_bytes)
    found = [
        _search_part(docs, asked.where(F.pmod(F.xxhash64(F.col("item")), F.lit(parts)) == part), k, doc_id, doc_text)
        for part in range(parts)
    ]
    schema = "item_id long, id long, score long"
    best = reduce(DataFrame.union, found) if found else spark.createDataFrame([], schema)
    order = Window.partitionBy("item_id").orderBy(F.desc("score"), F.col("id").asc_nulls_last())
    ranked = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("item_id", "rank", "id", "score")


def _search_part(docs: DataFrame, asked: DataFrame, k: int, doc_id: str, doc_text: str) -> DataFrame:
    pairs = [(row.item, row.term) for row in asked.collect()]
    terms = sorted({term for _, term in pairs})
    items = sorted({item for item, _ in pairs}, key=lambda item: (item is None, item or 0))
    place_of, index_of = {term: i for i, term in enumerate(terms)}, {item: i for i, item in enumerate(items)}
    held = sorted((place_of[term], index_of[item]) for item, term in pairs)
    holders = np.array([item for _, item in held], np.int64)
    first = np.searchsorted(np.array([term for term, _ in held], np.int64), np.arange(len(terms) + 1))

    counted = materialise(count_terms(docs, terms, doc_id, doc_text), "term-counts")
    corpus = counted.agg(F.count("*").alias("documents"), F.sum("n").alias("terms")).first()
    weights = np.zeros(len(terms), np.int64)
    for row in counted.select(F.explode("at").alias("at")).groupBy("at").count().collect():
        weights[row["at"]] = math.floor(1000 * math.log((2 * corpus.documents + 2) / (2 * row["count"] + 1)))
    with_length = counted.select(
        "id", _saturating_length(corpus.documents, corpus.terms or 1).alias("m"), "at", "tf"
    )
    return best_documents(with_length, weights, first, holders, items, k)
