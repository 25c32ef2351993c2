"""Language-model scores by online logistic context mixing.

A text is coded as binary decisions. Frequent words are leaves of a Huffman
tree; any other word is an escape followed by its bytes in a second tree. For
each decision several predictors look up how often 0 and 1 followed: in the node
alone, and in three hashed contexts of the node with words or bytes that stand
before. Their stretched probabilities are summed with weights that a gate picks
by how much evidence each context has, and the sum is refined by a table of what
really happened at such sums. A text's bits are the sum over its decisions.

Learning is one online pass: each task predicts a block, corrects weights and
refinement, then counts the block. Tasks' counts are added and their weights
averaged by evidence; scoring uses the merged model as it is.
"""

from __future__ import annotations

import heapq
import math
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfscout.llm.common import text_of
from shelfscout.session import materialise

# Hashed contexts of a word's decisions, and of a byte's.
WORD_CONTEXTS, BYTE_CONTEXTS = 3, 3
# Added to both counts of a context; symbols and characters worked on at a time.
PRIOR = np.float32(0.4)
SYMBOLS, AT_ONCE = 1 << 13, 1 << 20
# Groups of that many characters whose words are looked up together.
TOGETHER = 8
# Symbols of the first block; blocks double up to ``SYMBOLS``.
FIRST = 1 << 6
# Symbols up to which every block renews what it touched of the derived tables, and
# after which all of them are renewed: at first, and at most (it doubles).
EARLY, LATE = 1 << 15, 1 << 21
# Tokens (a power of two) that a learning task has at least, however the rows are dealt.
TASK_BITS = 18
# Words a counting task holds before it passes them on.
HELD = 1 << 20
# The most frequent words, the last of which is a context of every word.
MARKERS = 32
# Evidence classes of a context: none, 1-2, 3-8, more. One gate per combination.
CLASSES = np.array([0, 1, 1, 2, 2, 2, 2, 2, 2, 3], np.uint16)
STEPS, REACH = 97, 12.0  # refinement: points, and the largest sum they span
LEVELS = 255  # a context's stretched probability is held in one byte
STRETCHED = np.linspace(-REACH, REACH, LEVELS + 1, dtype=np.float32)  # by that byte
FAITH = 20.0  # decisions' worth of trust in the unrefined probability
DEEP = 50  # chances of that many decisions can be multiplied before a double underflows
PACE = 0.25  # part of a diagonal Newton step the weights take
BLOCK = 1 << 13  # slots that travel together
MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9))  # odd multipliers


def huffman(counts: list[int]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Path lengths of the symbols; nodes and bits of all paths, from the root, one
    symbol after another; for each node, numbered from 0, how often 0 and 1 follow."""
    size = len(counts)
    heap = [(count, i) for i, count in enumerate(counts)]
    heapq.heapify(heap)
    above, side, follow = np.full(2 * size - 1, -1), np.zeros(2 * size - 1, np.int8), []
    for made in range(size, 2 * size - 1):
        (a, left), (b, right) = heapq.heappop(heap), heapq.heappop(heap)
        above[[left, right]] = made
        side[right] = 1
        heapq.heappush(heap, (a + b, made))
        follow += [a, b]
    lengths, at = np.zeros(size, np.int64), np.arange(size)
    while (up := above[at] >= 0).any():
        lengths += up
        at = np.where(up, above[at], at)
    nodes, bits = np.zeros(int(lengths.sum()), np.int32), np.zeros(int(lengths.sum()), np.int8)
    last, at = np.cumsum(lengths) - 1, np.arange(size)
    for step in range(int(lengths.max())):
        up = lengths > step
        nodes[(last - step)[up]] = above[at[up]] - size
        bits[(last - step)[up]] = side[at[up]]
        at = np.where(up, above[at], at)
    return lengths, nodes, bits, np.array(follow, np.int64)


class Coder:
    """Texts as symbols, symbols as decisions."""

    def __init__(self, words: list[bytes], counts: list[int], others: int, texts: int):
        self.words = words
        self.end, self.escape = len(words), len(words) + 1
        self.byte, self.stop = len(words) + 2, len(words) + 258
        self.start = len(words) + 259
        upper = huffman([*counts, texts + 1, others + 1])
        letters = Counter()
        for word, count in zip(words, counts, strict=True):
            for byte in word:
                letters[byte] += count
        lower = huffman([*[letters[byte] + 1 for byte in range(256)], sum(counts) + 1])
        self.word_counts = np.minimum(upper[-1], 2**32 - 1).astype(np.uint32)
        self.lengths = np.concatenate([upper[0], lower[0]])
        # Nodes of all paths, doubled, and the bit taken there.
        self.paths = np.concatenate([2 * tree[1] + tree[2] for tree in (upper, lower)])
        self.offsets = np.cumsum(self.lengths) - self.lengths
        self.index: pa.Array | None = None

    def look_up(self, words: pa.Array) -> pa.Array:
        """Each word's symbol, null if it is spelled. Arrow indexes the coded words in every call: ask for many."""
        if self.index is None:
            self.index = pa.array(self.words, pa.binary())
        return pc.index_in(words, value_set=self.index)

    def tokens(
        self, texts: pa.ListArray | list[list[bytes]], found: pa.Array | None = None
    ) -> tuple[pa.Array, np.ndarray, np.ndarray]:
        """Of texts as words, looked up or not: the spelled words; all words' symbols, -1 if spelled, each text
        closed by its end; where texts start."""
        if isinstance(texts, list):
            texts = pa.array(texts, pa.list_(pa.binary()))
        words, sizes = texts.flatten(), texts.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64) + 1
        if found is None:
            found = self.look_up(words)
        starts = np.cumsum(sizes) - sizes
        known, within = np.full(int(sizes.sum()), self.end), np.ones(int(sizes.sum()), bool)
        within[starts + sizes - 1] = False
        known[within] = found.fill_null(-1).to_numpy(zero_copy_only=False)
        return words.filter(found.is_null()), known, starts

    def symbols(self, spelled: pa.Array, known: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The tokens' symbols, spelled words as escape, bytes and stop, and where texts start among them."""
        letters, wide = letters_of(spelled)
        at = np.flatnonzero(known < 0)
        sizes = np.ones(len(known), np.int64)
        sizes[at] = wide + 2
        places = np.cumsum(sizes) - sizes
        found = np.empty(int(sizes.sum()), np.int64)
        found[places] = np.where(known < 0, self.escape, known)
        if len(at):
            first = places[at] + 1
            within = np.arange(int(wide.sum())) - np.repeat(np.cumsum(wide) - wide, wide)
            found[np.repeat(first, wide) + within] = letters.astype(np.int64) + self.byte
            found[first + wide] = self.stop
        return found, places[starts]

    def contexts(
        self, symbols: np.ndarray, starts: np.ndarray, words: np.ndarray, letters: np.ndarray
    ) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """Hashes of what stands before the symbols at some places, within their text: as words, and as bytes.

        Of a word: the last very frequent word, the word before, the two before.
        Of a byte: the two, three and four symbols before.
        """
        before, shifted = [], symbols.astype(np.uint64)
        for _ in range(4):
            last, shifted = shifted, np.empty_like(shifted)
            shifted[1:] = last[:-1]
            shifted[starts] = self.start
            before.append(shifted)
        # Odd: a very frequent word stands there; even: a text starts. The place is half of it.
        latest = np.zeros(len(symbols), np.int64)
        marked = np.flatnonzero(symbols[:-1] < MARKERS)
        latest[marked + 1] = 2 * marked + 1
        latest[starts] = 2 * starts
        latest = np.maximum.accumulate(latest)[words]
        marker = np.where(latest & 1, symbols[latest >> 1], self.start).astype(np.uint64)
        first, second = (x[words] for x in before[:2])
        found = [marker, first, first * MIX[0] + second]
        first, second, third, fourth = (x[letters] for x in before)
        pair = first * MIX[0] + second
        triple = pair * MIX[0] + third
        spelled = [pair, triple, triple * MIX[0] + fourth]
        for hashes in (found, spelled):
            for order, mixed in enumerate(hashes):
                hashes[order] = (mixed + np.uint64(order + 1)) * MIX[1]
                hashes[order] ^= hashes[order] >> np.uint64(29)
        return found, spelled


def letters_of(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all words of a binary array, one word after another, and the words' lengths."""
    if not len(words):
        return np.zeros(0, np.uint8), np.zeros(0, np.int64)
    ends = np.frombuffer(words.buffers()[1], np.int32)[words.offset : words.offset + len(words) + 1]
    data = np.frombuffer(words.buffers()[2], np.uint8) if ends[-1] > ends[0] else np.zeros(0, np.uint8)
    return data[ends[0] : ends[-1]], np.diff(ends).astype(np.int64)


def derived(table: np.ndarray) -> np.ndarray:
    """Stretched probability (low byte) and evidence class (high byte) for each pair of counts."""
    zeros, ones = table[0::2].astype(np.float32), table[1::2].astype(np.float32)
    level = np.clip(np.log((ones + PRIOR) / (zeros + PRIOR)), -REACH, REACH) + np.float32(REACH)
    classes = CLASSES.take(np.minimum(zeros + ones, len(CLASSES) - 1).astype(np.int8))
    return np.rint(level * np.float32(LEVELS / (2 * REACH))).astype(np.uint16) | classes << 8


def sent_counts(counts: np.ndarray) -> bytes:
    """Counts for the way: a byte each, then those that need more."""
    large = np.flatnonzero(counts >= 255).astype("<u4")
    small = np.minimum(counts, 255).astype(np.uint8)
    return zlib.compress(small.tobytes() + large.tobytes() + counts[large].astype("<u4").tobytes(), 1)


def received_counts(payload: bytes, size: int) -> np.ndarray:
    data = zlib.decompress(payload)
    counts = np.frombuffer(data, np.uint8, size).astype(np.int64)
    large, values = np.frombuffer(data, "<u4", offset=size).reshape(2, -1)
    counts[large] = values
    return counts


@dataclass
class Mixer:
    """Of one tree: counts of bits per node and per hashed context, weights per
    gate, and the refinement. Predictions read tables derived from the counts,
    which ``refresh`` renews."""

    slots: int
    contexts: int
    alone: np.ndarray  # counts of the nodes
    given: bool  # whether those are known beforehand

    def __post_init__(self) -> None:
        self.gates = 4**self.contexts
        self.tables = [self.alone, *[np.zeros(2 * self.slots, np.uint32) for _ in range(self.contexts)]]
        self.weights = np.full((self.contexts + 2, self.gates), 0.35, np.float32)
        self.weights[-1] = 0
        self.evidence = np.full((self.contexts + 2, self.gates), 50.0)
        self.seen = np.zeros((2, self.gates * STEPS))  # per gate and step: decisions, and ones among them
        self.learned, self.fresh, self.due = 0, 0, EARLY  # symbols: all, since the last renewal, until the next
        self.refresh()

    def refresh(self) -> None:
        self.codes = [derived(table) for table in self.tables]
        self.refine()
        self.weigh()

    def weigh(self) -> None:
        """What each input adds to the sum, by gate and level; the constant comes with the first."""
        self.parts = [(weight[:, None] * STRETCHED).ravel() for weight in self.weights[:-1]]
        self.parts[0] = (self.weights[-1][:, None] + self.parts[0].reshape(self.gates, -1)).ravel()

    def refine(self) -> None:
        steps = np.linspace(-REACH, REACH, STEPS)
        prior = np.tile(1 / (1 + np.exp(-steps)), self.gates)
        self.refined = ((self.seen[1] + FAITH * prior) / (self.seen[0] + FAITH)).astype(np.float32)

    def decisions(
        self, coder: Coder, symbols: np.ndarray, contexts: list[np.ndarray]
    ) -> tuple[np.ndarray, list[np.ndarray]]:
        """Bit and places in the tables of every decision of some symbols of one tree."""
        lengths = coder.lengths[symbols]
        at = np.arange(int(lengths.sum())) + np.repeat(coder.offsets[symbols] - (np.cumsum(lengths) - lengths), lengths)
        path = coder.paths.take(at)
        bit, node = (path & 1).astype(np.int8), (path >> 1).astype(np.int64)
        salt = (node.view(np.uint64) + np.uint64(1)) * MIX[0]
        shift = np.uint64(64 - (self.slots.bit_length() - 1))
        places = [node]
        for context in contexts:
            place = np.repeat(context, lengths)
            place ^= salt
            place *= MIX[2]
            place >>= shift
            places.append(place.view(np.int64))
        return bit, places

    def sums(self, places: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
        """Sum of the weighted inputs, gate, and for each input the gate and level together."""
        codes = [table.take(place) for table, place in zip(self.codes, places, strict=True)]
        gate = codes[1] >> 8
        for code in codes[2:]:
            gate <<= 2
            gate |= code >> 8
        high = gate << 8
        spots = [(high | code & 255).astype(np.int64) for code in codes]
        total = self.parts[0].take(spots[0])
        for part, spot in zip(self.parts[1:], spots[1:], strict=True):
            total += part.take(spot)
        np.maximum(total, np.float32(-REACH), out=total)
        np.minimum(total, np.float32(REACH), out=total)
        return total, gate, spots

    def cells(self, total: np.ndarray, gate: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Refinement cell below a sum, and how far the sum is towards the next."""
        part = total + np.float32(REACH)
        part *= np.float32((STEPS - 1) / (2 * REACH))
        cell = np.minimum(part.astype(np.int32), STEPS - 2)
        part -= cell.astype(np.float32)
        return cell + gate.astype(np.int32) * STEPS, part

    def chances(self, places: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """Mixed probability of a 1, and with the refined one."""
        total, gate, _ = self.sums(places)
        cell, part = self.cells(total, gate)
        chance = logistic(total)
        cell = cell.astype(np.int64)
        refined = self.refined.take(cell)
        cell += 1
        part *= self.refined.take(cell) - refined
        refined += part
        # Neither part is ever 0 or 1: sums are clipped, refined chances lean on their prior.
        refined += chance
        refined /= 2
        return chance, refined

    def learn(self, coder: Coder, symbols: np.ndarray, contexts: list[np.ndarray]) -> None:
        """Predict a block, correct weights and refinement, count it."""
        bit, places = self.decisions(coder, symbols, contexts)
        total, gate, spots = self.sums(places)
        cell, part = self.cells(total, gate)
        chance = logistic(total)
        miss = (bit - chance).astype(float)
        chance *= 1 - chance
        spread = chance.astype(float)
        # An input takes few values: misses and spreads are added up per gate and value, then multiplied.
        size, value = (self.gates, LEVELS + 1), STRETCHED.astype(float)
        for row, spot in enumerate(spots):
            spreads = np.bincount(spot, spread, self.gates * (LEVELS + 1)).reshape(size)
            misses = np.bincount(spot, miss, self.gates * (LEVELS + 1)).reshape(size)
            self.evidence[row] += np.einsum("gv,v->g", spreads, value * value)
            self.weights[row] += (PACE * np.einsum("gv,v->g", misses, value) / self.evidence[row]).astype(np.float32)
        self.evidence[-1] += spreads.sum(axis=1)
        self.weights[-1] += (PACE * misses.sum(axis=1) / self.evidence[-1]).astype(np.float32)
        self.weigh()
        cell += part > 0.5
        cell *= 2
        cell += bit
        ended = np.bincount(cell, minlength=2 * self.gates * STEPS).reshape(-1, 2)
        self.seen[0] += ended[:, 0] + ended[:, 1]
        self.seen[1] += ended[:, 1]
        # A pair of counts is taken as one number: a 1 adds to its upper half.
        added = np.uint64(1) << (bit.astype(np.uint64) << np.uint64(5))
        for table, place in list(zip(self.tables, places, strict=True))[self.given :]:
            np.add.at(table.view("<u8"), place, added)
        self.learned += len(symbols)
        self.fresh += len(symbols)
        if self.learned <= EARLY:
            for code, table, place in list(zip(self.codes, self.tables, places, strict=True))[self.given :]:
                code[place] = derived(table.reshape(-1, 2)[place].ravel())
            self.refine()
            self.fresh = 0
        elif self.fresh >= self.due:
            self.refresh()
            self.fresh, self.due = 0, min(2 * self.due, LATE)

    def bits(self, coder: Coder, symbols: np.ndarray, contexts: list[np.ndarray]) -> np.ndarray:
        """Bits of each symbol."""
        bit, places = self.decisions(coder, symbols, contexts)
        final = self.chances(places)[-1]
        final -= bit ^ 1
        final = np.abs(final).astype(float)
        lengths = coder.lengths[symbols]
        begins = np.cumsum(lengths) - lengths
        if lengths.max(initial=0) > DEEP:
            return -np.add.reduceat(np.log2(final), begins)
        return -np.log2(np.multiply.reduceat(final, begins))


def logistic(total: np.ndarray) -> np.ndarray:
    chance = np.negative(total)
    np.exp(chance, out=chance)
    chance += 1
    return np.reciprocal(chance, out=chance)


class Model:
    """A mixer for the words' tree, whose nodes' counts follow from the words', and one for the bytes'."""

    def __init__(self, coder: Coder, slots: int):
        self.mixers = [
            Mixer(slots, WORD_CONTEXTS, coder.word_counts, given=True),
            Mixer(slots // 2, BYTE_CONTEXTS, np.zeros(2 * 256, np.uint32), given=False),
        ]

    def _trees(
        self, coder: Coder, symbols: np.ndarray, starts: np.ndarray
    ) -> Iterator[tuple[Mixer, np.ndarray, list[np.ndarray]]]:
        """Each tree's mixer, the places of its symbols, and the contexts there."""
        letter = symbols >= coder.byte
        both = np.flatnonzero(~letter), np.flatnonzero(letter)
        yield from zip(self.mixers, both, coder.contexts(symbols, starts, *both), strict=True)

    def learn(
        self, coder: Coder, texts: pa.ListArray | list[list[bytes]], found: pa.Array | None = None
    ) -> None:
        """Take texts in, block by block."""
        symbols, starts = coder.symbols(*coder.tokens(texts, found))
        for mixer, places, contexts in self._trees(coder, symbols, starts):
            i = 0
            while i < len(places):
                part = slice(i, i + min(SYMBOLS, max(FIRST, mixer.learned)))
                mixer.learn(coder, symbols[places[part]], [context[part] for context in contexts])
                i = part.stop

    def token_bits(self, coder: Coder, spelled: pa.Array, known: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Bits of each text, given as tokens."""
        symbols, begins = coder.symbols(spelled, known, starts)
        costs = np.zeros(len(symbols))
        for mixer, places, contexts in self._trees(coder, symbols, begins):
            # A symbol costs the same wherever it stands in the same contexts.
            mine = symbols[places]
            key = mine.astype(np.uint64)
            for context in contexts:
                key = (key * MIX[0]) ^ context
            merged = pa.array(key).dictionary_encode()
            which = merged.indices.to_numpy()
            first = np.empty(len(merged.dictionary), np.int64)
            first[which[::-1]] = np.arange(len(which))[::-1]
            each = [np.zeros(0)]
            for i in range(0, len(first), SYMBOLS):
                part = first[i : i + SYMBOLS]
                each.append(mixer.bits(coder, mine[part], [context[part] for context in contexts]))
            costs[places] = np.concatenate(each)[which]
        return np.add.reduceat(costs, begins) if len(begins) else np.zeros(0)

    def text_bits(self, coder: Coder, texts: pa.ListArray | list[list[bytes]]) -> np.ndarray:
        return self.token_bits(coder, *coder.tokens(texts))


def grouped(column: pa.Array, coder: Coder | None = None) -> Iterator[tuple[int, pa.ListArray, pa.Array | None]]:
    """Texts of a batch as lists of lower-cased (A-Z) words, about ``AT_ONCE`` characters at a time, with the
    first text's place and, given a coder, the words looked up there, for ``TOGETHER`` groups at a time."""
    bounds, size = [0], 0
    sizes = pc.utf8_length(column).to_pylist()
    for i, characters in enumerate(sizes, 1):
        size += characters
        if size >= AT_ONCE or i == len(sizes):
            bounds.append(i)
            size = 0
    for k in range(0, len(bounds) - 1, TOGETHER):
        some = bounds[k : k + TOGETHER + 1]
        texts = split(column.slice(some[0], some[-1] - some[0]))
        found = coder.look_up(texts.values) if coder else None
        ends = texts.offsets.to_numpy()
        for first, last in zip(some, some[1:]):
            low, high = first - some[0], last - some[0]
            words = found.slice(ends[low], ends[high] - ends[low]) if coder else None
            yield first, texts.slice(low, high - low), words


def split(texts: pa.Array) -> pa.ListArray:
    """Each text's words. Arrow knows as white space, as ``bytes.split`` does, exactly the six ASCII characters."""
    pieces = pc.ascii_split_whitespace(pc.ascii_lower(texts.cast(pa.string())))
    words, ends = pieces.flatten(), np.r_[0, np.cumsum(pieces.value_lengths().to_numpy(zero_copy_only=False))]
    real = pc.not_equal(pc.binary_length(words), 0)  # white space at an edge leaves an empty piece
    if real.false_count:
        before = np.r_[0, np.cumsum(real.to_numpy(zero_copy_only=False))]
        words, ends = words.filter(real), before[ends]
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), words.cast(pa.binary()))


def count_words(texts: DataFrame) -> DataFrame:
    """``word`` (lower-cased UTF-8) and ``n`` over a text column; each task adds up first."""

    def added_up(held: list[pa.Table]) -> pa.Table:
        found = pa.concat_tables(held)
        return found.group_by("word").aggregate([("n", "sum")]).select(["word", "n_sum"]).rename_columns(["word", "n"])

    def task(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = [], 0
        for part in parts:
            for _, group, _ in grouped(part.column("text")):
                words, n = group.flatten().value_counts().flatten()
                held.append(pa.table([words, n], names=["word", "n"]))
                rows += len(words)
                if rows >= HELD:
                    held = [added_up(held)]
                    rows = len(held[0])
                if rows >= HELD // 2 and len(held) == 1:
                    yield from held[0].to_batches()
                    held, rows = [], 0
        if held:
            yield from added_up(held).to_batches()

    return texts.select("text").mapInArrow(task, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))


def learn(texts: DataFrame, coder: Coder, slots: int) -> Model:
    """One online pass over a text column, merged over tasks.

    What a task sends is its tables in blocks; each block is added up where its
    key is, one after another, and only what scoring reads of it (two bytes per
    slot) comes to the driver.
    """
    sent = texts.sparkSession.sparkContext.broadcast(coder)
    # Payloads are keyed by mixer, table (-1: weights, evidence and refinement) and first slot.
    schema, names = "mixer int, kind int, block long, payload binary", ["mixer", "kind", "block", "payload"]

    def row(mixer: int, kind: int, block: int, payload: bytes) -> pa.RecordBatch:
        columns = [pa.array([mixer], pa.int32()), pa.array([kind], pa.int32()), pa.array([block])]
        return pa.record_batch([*columns, pa.array([payload], pa.binary())], names=names)

    def task(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, model = sent.value, None
        for part in parts:
            for _, group, found in grouped(part.column("text"), coder):
                model = model or Model(coder, slots)
                model.learn(coder, group, found)
        for i, mixer in enumerate(model.mixers if model else ()):
            for kind, table in list(enumerate(mixer.tables))[mixer.given :]:
                for block in range(0, len(table), 2 * BLOCK):
                    values = table[block : block + 2 * BLOCK]
                    if values.any():
                        yield row(i, kind, block // 2, sent_counts(values))
            rest = [mixer.weights * mixer.evidence, mixer.evidence, mixer.seen]
            yield row(i, -1, 0, np.concatenate([x.ravel() for x in rest]).tobytes())

    empty = Model(coder, slots)
    sizes = [[len(table) for table in mixer.tables] for mixer in empty.mixers]

    def add_up(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, total = None, np.zeros(0)

        def done() -> pa.RecordBatch:
            return row(*key, (total if key[1] < 0 else derived(total)).tobytes())

        for part in parts:
            for mixer, kind, block, payload in zip(*part.to_pydict().values(), strict=True):
                if kind < 0:
                    values = np.frombuffer(payload, float)
                else:
                    values = received_counts(payload, min(2 * BLOCK, sizes[mixer][kind] - 2 * block))
                if key == (mixer, kind, block):
                    total = total + values
                    continue
                if key is not None:
                    yield done()
                key, total = (mixer, kind, block), values
        if key is not None:
            yield done()

    key = ["mixer", "kind", "block"]
    sums = texts.select("text").mapInArrow(task, schema).repartition(*key).sortWithinPartitions(*key)
    for i, kind, block, payload in sums.mapInArrow(add_up, schema).collect():
        mixer = empty.mixers[i]
        if kind >= 0:
            values = np.frombuffer(bytes(payload), np.uint16)
            mixer.codes[kind][block : block + len(values)] = values
            continue
        weighted, evidence, seen = np.split(np.frombuffer(bytes(payload), float), np.cumsum([mixer.evidence.size] * 2))
        mixer.evidence = evidence.reshape(mixer.evidence.shape)
        mixer.weights = (weighted.reshape(mixer.evidence.shape) / mixer.evidence).astype(np.float32)
        mixer.seen = seen.reshape(mixer.seen.shape)
    for mixer in empty.mixers:
        mixer.tables, mixer.alone = [], np.zeros(0)  # scoring reads the codes alone
        mixer.refine()
        mixer.weigh()
    return empty


def score(
    docs: DataFrame,
    held_out: Column,
    id_col: str = "doc_id",
    text_col: str = "text",
    coded: int = 1 << 17,
    tokens_per_slot: int = 64,
    least_slots: int = 1 << 20,
    most_slots: int = 1 << 22,
) -> DataFrame:
    """One row per input row with its word-unigram base and its model score.

    Learns from the rows ``held_out`` is not true for, scores all. Tokens are
    the words of the lower-cased (A-Z) text and one end. The ``coded`` most
    frequent words, if seen more than once, have a code of their own and go to
    every executor with their counts; counts of all others are joined. A context
    table has about one slot per ``tokens_per_slot`` learned tokens, between
    ``least_slots`` and ``most_slots``.

    Columns: ``id``, ``held_out``, ``n_tokens``, ``n_known`` (seen in learning),
    ``train_tokens``, ``base_score`` (sum of log10 of add-one probabilities),
    ``score`` (log10), ``bits_per_byte`` (of the words with one byte for each
    token's end). A null text counts as empty and is its end alone. Repeated rows
    and null ids are rows of their own. With nothing to learn from, all counts
    are 0 and every decision starts even. An empty table gives no rows; other
    columns are not read.
    A text of any length is one task's work, a part of it at a time in memory.
    """
    spark = docs.sparkSession
    read = docs.select(
        F.col(f"`{id_col}`").cast("long").alias("id"),
        F.coalesce(held_out, F.lit(False)).alias("held_out"),
        text_of(text_col).alias("text"),
    )
    training = read.where("not held_out")
    counts = materialise(count_words(training), "word-counts")
    words, distinct = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
    texts = training.count()
    tokens, types = words + texts, distinct + (texts > 0)
    # Bounded by ``coded``. Words seen once are spelled: their share is what new
    # words will have, and they teach the byte tree what such words look like.
    head = counts.where("n > 1").orderBy(F.desc("n"), "word").limit(coded).collect()
    numbers = [row.n for row in head]
    coder = Coder([bytes(row.word) for row in head], numbers, words - sum(numbers), texts)
    slots = min(most_slots, max(least_slots, 1 << round(math.log2(max(1, tokens / tokens_per_slot)))))
    # Small partitions are learned from together: weights fit only contexts that had evidence.
    model = learn(training.coalesce(max(1, tokens >> TASK_BITS)), coder, slots)

    base = math.log10(tokens + types + 1)
    # By symbol; the end is a token like any word.
    sent = spark.sparkContext.broadcast((coder, model, np.array([*numbers, texts], float)))

    def task(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, model, seen = sent.value
        base_logs = np.log10(seen + 1) - base
        row = TaskContext.get().partitionId() << 40
        for part in parts:
            ids, held = part.column("id"), part.column("held_out")
            for first, group, found in grouped(part.column("text"), coder):
                size = len(group)
                spelled, known, starts = coder.tokens(group, found)
                count = np.where(known < 0, 0, seen[known])
                logs = np.where(known < 0, 0, base_logs[known])
                words = group.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
                letters = np.r_[0, np.cumsum(letters_of(group.flatten())[1])][np.r_[0, np.cumsum(words)]]
                begins = np.append(np.searchsorted(np.flatnonzero(known < 0), starts), len(spelled)).astype(np.int32)
                yield pa.record_batch(
                    [
                        pa.array(np.arange(row, row + size)),
                        ids.slice(first, size),
                        held.slice(first, size),
                        pa.array(words + 1),
                        pa.array(np.add.reduceat((count > 0).astype(np.int64), starts)),
                        pa.array(np.add.reduceat(logs, starts)),
                        pa.array(model.token_bits(coder, spelled, known, starts)),
                        pa.array(np.diff(letters) + words + 1),
                        pa.ListArray.from_arrays(pa.array(begins), spelled),
                    ],
                    names=["row", "id", "held_out", "n_tokens", "known", "logs", "bits", "bytes", "rare"],
                )
                row += size

    scored = materialise(
        read.mapInArrow(
            task,
            "row long, id long, held_out boolean, n_tokens long, known long, logs double, bits double, bytes long, "
            "rare array<binary>",
        ),
        "scored",
    )
    rare = scored.select("row", F.explode("rare").alias("word"))
    rare = rare.join(counts, "word", "left").groupBy("row").agg(
        F.sum(F.log10(F.coalesce("n", F.lit(0)) + 1) - base).alias("rare_logs"),
        F.count("n").alias("rare_known"),
    )
    return scored.drop("rare").join(rare, "row", "left").select(
        "id",
        "held_out",
        "n_tokens",
        (F.col("known") + F.coalesce("rare_known", F.lit(0))).alias("n_known"),
        F.lit(tokens).cast("long").alias("train_tokens"),
        (F.col("logs") + F.coalesce("rare_logs", F.lit(0.0))).alias("base_score"),
        (-F.col("bits") * math.log10(2)).alias("score"),
        (F.col("bits") / F.col("bytes")).alias("bits_per_byte"),
    )
