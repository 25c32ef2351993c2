"""Near-duplicates by SimHash, found through a Gray-order hierarchical index.

A fingerprint is 64 bits. Two that differ in at most ``t`` bits agree in at
least one of ``t + 1`` blocks of bits, so every fingerprint is placed once per
block, next to all that share the block's value: the top nodes of the index. A
node that is still too large is divided again by the bits that are left, in the
same way, so no node is ever beyond ``NODE`` and none is given up.

Inside a top node the fingerprints are sorted by Gray rank, which puts similar
ones side by side. Runs of ``FAN`` neighbours form upper nodes that keep the
bits their members share (a mask and a pattern). The search walks pairs of
nodes from the top, adds up the differences in the bits shared so far, and
drops a whole pair of groups once the sum exceeds ``t``. Of the links found in
a node only a spanning forest leaves it; rounds of contraction then join the
forests into components.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfscout.llm.common import text_key, text_of, words_of
from shelfscout.session import materialise

BITS = 64
SEED = 42  # fixed by the fingerprint's definition
NODE = 8192
FAN = 8
# Shingles whose bits are counted at a time, and pairs of nodes held at a time.
AT_ONCE = 1 << 15
PAIRS = 1 << 20


def fingerprint(text: str | None, shingle: int) -> int:
    """A bit is 1 if it is set in over half of the shingle hashes; no word gives 0."""
    words = words_of(text)
    if not words:
        return 0
    ends = max(1, len(words) - shingle + 1)
    ones = np.zeros(BITS, np.int64)
    digest = xxhash.xxh64_intdigest
    for start in range(0, ends, AT_ONCE):
        part = words[start : min(start + AT_ONCE, ends) + shingle - 1]
        if len(part) <= shingle:
            hashes = [digest(b" ".join(part), SEED)]
        else:
            runs = zip(*(part[i:] for i in range(shingle)), strict=False)
            hashes = [digest(run, SEED) for run in map(b" ".join, runs)]
        octets = np.array(hashes, np.uint64).view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(octets, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > ends, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, id_col: str, text_col: str, shingle: int) -> DataFrame:
    """``row`` (numbers the rows once written), ``id``, ``text_key``, ``code`` (the fingerprint as a signed long)."""
    read = docs.select(
        F.col(f"`{id_col}`").cast("long").alias("id"),
        text_key(text_col).alias("text_key"),
        text_of(text_col).alias("text"),
    )

    def task(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = TaskContext.get().partitionId() << 40
        for part in parts:
            codes = np.array([fingerprint(text.as_py(), shingle) for text in part.column("text")], np.uint64)
            rows = np.arange(row, row + len(codes), dtype=np.int64)
            row += len(codes)
            yield pa.record_batch(
                [pa.array(rows), part.column("id"), part.column("text_key"), pa.array(codes.view(np.int64))],
                names=["row", "id", "text_key", "code"],
            )

    return read.mapInArrow(task, "row long, id long, text_key long, code long")


def gray_rank(codes: np.ndarray) -> np.ndarray:
    """Position of each code in the Gray order: bit i is the parity of bits i and above."""
    rank = codes.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(shift)
    return rank


class GrayForest:
    """One tree per group over fingerprints sorted by group, then Gray rank."""

    def __init__(self, groups: np.ndarray, codes: np.ndarray):
        order = np.lexsort((gray_rank(codes), groups))
        self.codes = codes[order]
        full = np.full(len(codes), ~np.uint64(0))
        self.patterns, self.masks, self.firsts = [self.codes], [full], []
        owner = groups[order]
        while len(owner) and (owner[1:] == owner[:-1]).any():
            starts = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
            place = np.arange(len(owner)) - np.repeat(starts, np.diff(np.r_[starts, len(owner)]))
            first = np.flatnonzero(place % FAN == 0)
            pattern, mask = self.patterns[-1], self.masks[-1]
            both = np.bitwise_and.reduceat(pattern, first)
            either = np.bitwise_or.reduceat(pattern, first)
            shared = np.bitwise_and.reduceat(mask, first) & ~(both ^ either)
            self.patterns.append(both & shared)
            self.masks.append(shared)
            self.firsts.append(np.r_[first, len(owner)])
            owner = owner[first]

    def links(self, most: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Positions of all pairs of one group that differ in at most ``most`` bits, a block at a time."""
        top = len(self.masks) - 1
        roots = np.arange(len(self.masks[top]))
        waiting = [(top, roots, roots, np.zeros(len(roots), np.uint8))]
        while waiting:
            level, a, b, apart = waiting.pop()
            if len(a) > PAIRS // FAN**2:
                half = len(a) // 2
                waiting += [(level, a[:half], b[:half], apart[:half]), (level, a[half:], b[half:], apart[half:])]
                continue
            if level == 0:
                yield a[a < b], b[a < b]
                continue
            left, right, parent = self._children(level, a, b)
            known = (self.masks[level][a] & self.masks[level][b])[parent]
            mask, pattern = self.masks[level - 1], self.patterns[level - 1]
            fresh = mask[left] & mask[right] & ~known
            total = apart[parent] + np.bitwise_count((pattern[left] ^ pattern[right]) & fresh)
            near = total <= most
            if near.any():
                waiting.append((level - 1, left[near], right[near], total[near]))

    def _children(self, level: int, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        first = self.firsts[level - 1]
        wide, high = first[a + 1] - first[a], first[b + 1] - first[b]
        each = wide * high
        parent = np.repeat(np.arange(len(a)), each)
        place = np.arange(len(parent)) - np.repeat(np.cumsum(each) - each, each)
        left = first[a][parent] + place // high[parent]
        right = first[b][parent] + place % high[parent]
        once = left <= right
        return left[once], right[once], parent[once]


def spanning_forest(groups: np.ndarray, codes: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """For every code that has a link in its group: the code and its tree's first code."""
    forest = GrayForest(groups, codes)
    root = np.arange(len(codes))
    for a, b in forest.links(most):
        while True:
            ra, rb = root[a], root[b]
            if (ra == rb).all():
                break
            low, high = np.minimum(ra, rb), np.maximum(ra, rb)
            np.minimum.at(root, high, low)
            while (root != root[root]).any():
                root = root[root]
    linked = np.flatnonzero(root != np.arange(len(root)))
    return forest.codes[linked], forest.codes[root[linked]]


def _parts(mask: int, blocks: int) -> list[int]:
    """The bits outside ``mask``, cut into blocks, each together with ``mask``."""
    free = [bit for bit in range(BITS) if not mask >> bit & 1]
    cuts = [round(i * len(free) / blocks) for i in range(blocks + 1)]
    return [mask | sum(1 << bit for bit in free[i:j]) for i, j in zip(cuts, cuts[1:], strict=False)]


def _signed(value: int) -> int:
    return value - (1 << BITS) if value >> (BITS - 1) else value


def _placed(codes: DataFrame, masks: list[int]) -> DataFrame:
    one = F.explode(F.array(*[F.lit(_signed(mask)).cast("long") for mask in masks])).alias("mask")
    return codes.select("code", one).withColumn("value", F.col("code").bitwiseAND(F.col("mask")))


def links(codes: DataFrame, most: int) -> DataFrame:
    """Edges (a, b) that connect all codes (distinct, column ``code``) within ``most`` bits of each other."""
    masks = _parts(0, most + 1)
    placed, ready = _placed(codes, masks), []
    while True:
        sizes = placed.groupBy("mask", "value").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
        sizes = materialise(sizes, "node-sizes")
        ready.append(placed.join(sizes.where(F.col("n") <= NODE).drop("n"), ["mask", "value"], "left_semi"))
        large = sizes.where(F.col("n") > NODE).drop("n")
        if large.isEmpty():
            break
        inside = materialise(placed.join(large, ["mask", "value"], "left_semi"), "large-nodes")
        finer = F.create_map(
            *[
                x
                for mask in masks
                for x in (
                    F.lit(_signed(mask)).cast("long"),
                    F.array(*[F.lit(_signed(part)).cast("long") for part in _parts(mask, most + 1)]),
                )
            ]
        )
        divided = inside.select("code", F.explode(finer[F.col("mask")]).alias("mask")).distinct()
        placed = divided.withColumn("value", F.col("code").bitwiseAND(F.col("mask")))
        masks = sorted({part for mask in masks for part in _parts(mask, most + 1)})

    def search(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []

        def found() -> Iterator[pa.RecordBatch]:
            whole = np.concatenate(held, axis=1)
            changes = (whole[0][1:] != whole[0][:-1]) | (whole[1][1:] != whole[1][:-1])
            groups = np.r_[0, np.cumsum(changes)]
            a, b = spanning_forest(groups, whole[2].view(np.uint64), most)
            yield pa.record_batch([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"])

        for part in parts:
            columns = np.stack([part.column(name).to_numpy() for name in ("mask", "value", "code")])
            same = (columns[0] == columns[0][-1]) & (columns[1] == columns[1][-1])
            if sum(x.shape[1] for x in held) >= PAIRS and not same.all():
                # The rows' order keeps a group together: all but the last group is whole.
                held.append(columns[:, ~same])
                yield from found()
                held = [columns[:, same]]
            else:
                held.append(columns)
        if held:
            yield from found()

    edges = None
    for rows in ready:
        near = rows.repartition("mask", "value").sortWithinPartitions("mask", "value")
        one = near.select("mask", "value", "code").mapInArrow(search, "a long, b long")
        edges = one if edges is None else edges.unionByName(one)
    return edges


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``root`` for every node of the edges (a, b): equal roots, same component.

    Each round hangs every node on its smallest neighbour and contracts, which
    at least halves the nodes that still have edges. Rounds are written to the
    shared folder.
    """
    edges = materialise(edges.where("a != b").distinct(), "edges")
    found = None
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        hung = both.groupBy("a").agg(F.min("b").alias("b"))
        hung = hung.select(F.col("a").alias("node"), F.least("a", "b").alias("root"))
        hung = materialise(hung, "hung")
        # Hooks point to smaller nodes only; two more steps shorten the chains.
        for _ in range(2):
            step = hung.select(F.col("node").alias("root"), F.col("root").alias("next"))
            hung = hung.join(step, "root").select("node", F.col("next").alias("root"))
        hung = materialise(hung, "hung")
        if found is None:
            found = hung
        else:
            step = hung.select(F.col("node").alias("root"), F.col("root").alias("next"))
            found = found.join(step, "root", "left").select("node", F.coalesce("next", "root").alias("root"))
        found = materialise(found, "found")
        a = hung.select(F.col("node").alias("a"), F.col("root").alias("ra"))
        b = hung.select(F.col("node").alias("b"), F.col("root").alias("rb"))
        rest = edges.join(a, "a").join(b, "b").where("ra != rb")
        rest = rest.select(F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b")).distinct()
        edges = materialise(rest, "edges")
        if edges.isEmpty():
            return found


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, most: int = 2
) -> DataFrame:
    """One row per input row with its fingerprint and component.

    Fingerprints link if they differ in ``most`` bits or fewer; components are
    what links reach. Texts are lower-cased (A-Z) and cut into shingles of
    ``shingle`` words, repeats included; a text of fewer words is one shingle; a
    text without words, a null included, has fingerprint zero and links like any
    other. Columns: ``id`` (long), ``text_key``, ``code`` (the fingerprint as a
    signed long), ``component`` (smallest id of the component, null if it has
    none) and ``kept``, true for one row of each component: the one of smallest
    id, nulls last; of rows equal in id, one. Repeated rows are rows of their
    own. Other input columns are not read; an empty table gives no rows.
    A text of any length is hashed whole by one task.
    """
    prints = materialise(fingerprints(docs, id_col, text_col, shingle), "fingerprints")
    first = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "row")).alias("first")
    codes = materialise(prints.groupBy("code").agg(first, F.count(F.lit(1)).alias("rows")), "codes")
    roots = components(links(codes.select("code"), most))
    placed = codes.join(roots, codes["code"] == roots["node"], "left")
    placed = placed.select("code", "first", "rows", F.coalesce("root", "code").alias("root"), F.col("root").isNotNull().alias("linked"))
    # Only codes that several rows or codes share need the way back to the rows.
    shared = materialise(placed.where("linked or rows > 1"), "shared-codes")
    best = shared.groupBy("root").agg(F.min("first").alias("best"))
    best = shared.select("code", "root").join(best, "root").select("code", "best")
    return prints.join(best, "code", "left").select(
        "id",
        "text_key",
        "code",
        F.when(F.col("best").isNull(), F.col("id")).otherwise(F.col("best.id")).alias("component"),
        F.coalesce(F.col("best.row") == F.col("row"), F.lit(True)).alias("kept"),
    )
