"""Packing by power-of-two decomposition.

A document's token ids, with one end id, are cut into pieces whose lengths are
powers of two: as many of the longest as fit, then the binary digits of the
rest, longest first. A piece is a sequence of its own, so no sequence crosses
documents and none needs padding; sequences of one length form a bucket, from
which a trainer draws batches of even shape. One pass over the documents, no
shuffle.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Callable, Iterator
from itertools import accumulate, chain, compress, pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfscout.llm.common import text_of

# A space between two characters that are not white space: the byte-level
# pattern never joins anything across the place before it.
SPACE = re.compile(r" (?<=\S )(?=\S)")
# Fixed by byte-level tokenizers: how a token writes a space.
SPACE_BYTE = "Ġ"
# Fixed by byte-level tokenizers with their usual pattern: the pattern, and the characters bytes are written as.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
PRINTED = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
# Texts of characters that are letters, digits, white space or none of these in every version of Unicode.
SETTLED = re.compile("[\t\n\r\x20-\x7e\xa1-\u024f]*")
# Words that surely neither begin nor end with white space.
INKED = "^[!-~\u00a1-\u024f](.*[!-~\u00a1-\u024f])?$"
# Characters encoded at a time, and words in a worker's memory before it starts the next.
AT_ONCE = 1 << 20
REMEMBERED = 400_000

PIECES = pa.schema(
    [
        ("id", pa.int64()),
        ("start", pa.int64()),
        ("length", pa.int64()),
        ("ids", pa.binary()),
        ("doc_tokens", pa.int64()),
        ("sequence", pa.int64()),
        ("offset", pa.int64()),
    ]
)


def spaced(text: str) -> list[str]:
    """The text cut at ``SPACE``. Where all white space is single spaces, which most
    texts are, plain splitting does it in half the time."""
    words = text.split(" ")
    plain = "" not in words and list(map(str.strip, words)) == words
    return words if plain else SPACE.split(text)


class Encoder:
    """Token ids of whole texts as little-endian unsigned 32-bit integers.

    Where the tokenizer is known to treat every word with the space before it
    on its own (byte-level with its usual pattern, no normalizer), each distinct
    word is encoded once and remembered; otherwise texts are encoded whole.
    """

    _loaded: dict[str, Encoder] = {}

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are what runs in parallel
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        with open(path, encoding="utf-8") as file:
            config = json.load(file)
        before = config.get("pre_tokenizer") or {}
        self.by_word = (
            config.get("normalizer") is None
            and before.get("type") == "ByteLevel"
            and before.get("use_regex", True)
            and not before.get("add_prefix_space", True)
            and all(token["special"] for token in config.get("added_tokens") or [])
        )
        # Per token: whether it begins with a space, which among words without white space only their first does.
        size = self.tokenizer.get_vocab_size()
        tokens = [self.tokenizer.id_to_token(i) or "" for i in range(size)]
        self.begins = np.array([token.startswith(SPACE_BYTE) for token in tokens], bool)
        self.quick = _quick(config, self.tokenizer) if self.by_word else None
        self.memo: dict[str, bytes] = {}
        self.former: dict[str, bytes] = {}

    @classmethod
    def at(cls, path: str) -> Encoder:
        if path not in cls._loaded:
            cls._loaded[path] = cls(path)
        return cls._loaded[path]

    def flat(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts one after the other, and how many each text has."""
        if not self.by_word:
            return _joined(self._whole(texts))
        lists = pc.split_pattern(pa.array(texts, pa.string()), " ")
        ends = lists.offsets.to_numpy().astype(np.int64)
        coded = lists.flatten().dictionary_encode()
        code, words = coded.indices.to_numpy(), coded.dictionary.to_pylist()
        inked = pc.match_substring_regex(coded.dictionary, f"(?s){INKED}").to_numpy(zero_copy_only=False)
        # Where all white space is single spaces, splitting at them is cutting at SPACE.
        bare = ~inked
        bare[bare] = [not words[i] or words[i] != words[i].strip() for i in np.flatnonzero(bare)]
        odd = bare[code]
        odd_before = np.concatenate([[0], np.cumsum(odd)])
        whole = [i for i in np.flatnonzero(np.diff(odd_before[ends])) if texts[i]]
        # A text is the codes of its words; its first word, which no space precedes, has a code of its own,
        # and so has what stands for a text that is cut otherwise.
        known = list(map(self._known(words).__getitem__, words))
        heads = [text.partition(" ")[0] for text in texts]
        for i in whole:
            heads[i] = ""
        table = known + self._whole(heads)
        for i in whole:
            table[len(words) + i] = self._cut(texts[i])
        code = code.astype(np.int64)
        code[ends[:-1]] = len(words) + np.arange(len(texts))
        if whole:
            kept = np.ones(len(code), bool)
            for i in whole:
                kept[ends[i] + 1 : ends[i + 1]] = False
            code, ends = code[kept], np.concatenate([[0], np.cumsum(kept)])[ends]
        ids, sizes = _joined(table)
        firsts = np.cumsum(sizes) - sizes
        lengths = sizes[code]
        before = np.concatenate([[0], np.cumsum(lengths)])
        places = np.arange(before[-1]) + np.repeat(firsts[code] - before[:-1], lengths)
        return ids[places], np.diff(before[ends])

    def _known(self, words: list[str]) -> dict[str, bytes]:
        """The memory, with the ids of all these words after a space."""
        missing = [word for word in words if word not in self.memo]
        if len(self.memo) + len(missing) > REMEMBERED:
            # Words that are still in use come back from the former memory at no cost.
            self.former, self.memo = self.memo, {}
            missing = words
        memo, former = self.memo, self.former
        fresh = []
        for word in missing:
            held = former.get(word)
            if held is None:
                fresh.append(word)
            else:
                memo[word] = held
        one = [word for word in fresh if word and len(word.split()) == 1 and word == word.strip()]
        settled = [word for word in one if SETTLED.fullmatch(word)]
        for words in (settled, list(set(one).difference(settled))):
            memo.update(zip(words, self._together(words), strict=True))
        rest = [f" {word}" for word in fresh if word not in memo]
        memo.update(zip((word[1:] for word in rest), self._whole(rest), strict=True))
        return memo

    def _together(self, words: list[str]) -> list[bytes]:
        """Ids of words without white space, each after a space: encoded as one text, cut where a token begins with one."""
        if not words:
            return []
        text = f" {' '.join(words)}"
        ids = np.array(self._ids([text])[0], "<u4")
        starts = np.flatnonzero(self.begins[ids])
        if len(starts) != len(words):  # a word holds a character that its tokenizer writes like a space
            return self._whole([f" {word}" for word in words])
        flat, ends = ids.tobytes(), [*(4 * starts).tolist(), 4 * len(ids)]
        return [flat[start:end] for start, end in pairwise(ends)]

    def _cut(self, text: str) -> bytes:
        """One text, cut at SPACE."""
        words = spaced(text)
        known = self._known(list(dict.fromkeys(words[1:])))
        return self._whole(words[:1])[0] + b"".join(map(known.__getitem__, words[1:]))

    def _ids(self, texts: list[str]) -> list[list[int]]:
        if self.quick is not None and all(map(SETTLED.fullmatch, texts)):
            return list(map(self.quick, texts))
        return [one.ids for one in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _whole(self, texts: list[str]) -> list[bytes]:
        settled = [bool(SETTLED.fullmatch(text)) for text in texts]
        held = iter(self._ids(list(compress(texts, settled))))
        others = iter(self._ids([text for text, quick in zip(texts, settled, strict=True) if not quick]))
        found = [next(held if quick else others) for quick in settled]
        flat = np.fromiter(chain.from_iterable(found), "<u4").tobytes()
        ends = [0, *accumulate(4 * len(ids) for ids in found)]
        return [flat[start:end] for start, end in pairwise(ends)]

    def encode(self, texts: list[str]) -> list[bytes]:
        ids, counts = self.flat(texts)
        flat, ends = ids.tobytes(), [0, *(4 * np.cumsum(counts)).tolist()]
        return [flat[start:end] for start, end in pairwise(ends)]

    def long_text(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """``flat`` for one text of any length, a part at a time where parts are independent."""
        if not self.by_word or len(text) <= AT_ONCE:
            return self.flat([text])
        found, start = [], 0
        while start < len(text):
            cut = SPACE.search(text, start + AT_ONCE)
            end = cut.start() if cut else len(text)
            # Later parts begin with a space, which stays with their first word.
            found.append(self.flat([text[start:end]])[0])
            start = end
        ids = np.concatenate(found)
        return ids, np.array([len(ids)])


def _quick(config: dict, tokenizer) -> Callable[[str], list[int]] | None:
    """A quicker encoder of the same ids, where the vocabulary allows one: ids in the
    order of the merges, so that the merge of the smallest id comes first. Held
    against the tokenizer on every entry of the vocabulary."""
    model = config["model"]
    plain = not any(model.get(name) for name in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges"))
    if model.get("type") != "BPE" or not plain:
        return None
    pairs = [pair.split(" ") if isinstance(pair, str) else pair for pair in model["merges"]]
    merged = [model["vocab"][left + right] for left, right in pairs]
    if any(a >= b for a, b in pairwise(merged)):
        return None
    hidden = (byte for byte in range(256) if byte not in PRINTED)
    byte_of = {chr(byte): byte for byte in PRINTED} | {chr(256 + n): byte for n, byte in enumerate(hidden)}
    ranks = {
        bytes(map(byte_of.__getitem__, token)): number
        for token, number in model["vocab"].items()
        if byte_of.keys() >= set(token)
    }
    if any(ranks.get(bytes([byte]), len(ranks)) >= min(merged, default=0) for byte in range(256)):
        return None
    import tiktoken

    quick = tiktoken.Encoding("words", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
    texts = [text for entry in ranks if "\ufffd" not in (text := entry.decode(errors="replace"))]
    wanted = tokenizer.encode_batch_fast(texts, add_special_tokens=False)
    same = all(quick(text) == one.ids for text, one in zip(texts, wanted, strict=True) if SETTLED.fullmatch(text))
    return quick if same else None


def _joined(parts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    return np.frombuffer(b"".join(parts), "<u4"), np.fromiter(map(len, parts), np.int64, len(parts)) // 4


def lengths_of(tokens: int, longest: int) -> list[int]:
    """``longest`` as often as it fits, then the powers of two that make up the rest."""
    rest = tokens % longest
    small = [1 << bit for bit in range(rest.bit_length() - 1, -1, -1) if rest >> bit & 1]
    return [longest] * (tokens // longest) + small


def decompose(
    docs: DataFrame,
    tokenizer: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    longest: int = 1024,
    end_id: int = 0,
) -> DataFrame:
    """One row per piece: ``id``, ``start``, ``length``, ``ids``, ``doc_tokens``, ``sequence``, ``offset``.

    ``tokenizer`` is the path of a file of the tokenizers library, present on
    every executor; strings of special tokens count as ordinary text. ``ids``
    holds the piece's token ids as little-endian unsigned 32-bit integers,
    ``doc_tokens`` counts all of the document's ids with ``end_id``, which closes
    every document: a null or empty text is one piece holding just that.
    ``longest`` is a power of two. ``sequence`` is unique; it names the input
    partition, the bucket (log2 of the length) and the place in both, so reruns
    over the same files agree. ``offset`` is always 0. Repeated rows and null
    ids give pieces of their own; other input columns are not read.
    A text of any length is encoded by one task, a part at a time where the tokenizer allows it.
    """
    if longest < 1 or longest & (longest - 1):
        raise ValueError("longest is a power of two")
    read = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), text_of(text_col).alias("text"))
    def task(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder.at(tokenizer)
        partition = TaskContext.get().partitionId()
        places = np.zeros(longest.bit_length() + 1, np.int64)

        def pieces(ids: list[int | None], encoded: tuple[np.ndarray, np.ndarray]) -> pa.RecordBatch:
            flat, counts = encoded
            flat = np.insert(flat, np.cumsum(counts), end_id).astype("<u4")
            counts = counts + 1
            cut = [lengths_of(count, longest) for count in counts.tolist()]
            lengths = np.fromiter(chain.from_iterable(cut), np.int64)
            owner = np.repeat(np.arange(len(cut)), list(map(len, cut)))
            ends = np.concatenate([[0], np.cumsum(lengths)])
            first = (np.cumsum(counts) - counts)[owner]
            buckets = np.log2(lengths).astype(np.int64)
            sequences = (np.int64(partition) << 6 | buckets) << 32
            for bucket in np.unique(buckets):
                here = np.flatnonzero(buckets == bucket)
                sequences[here] += places[bucket] + np.arange(len(here))
                places[bucket] += len(here)
            # A document's pieces follow each other as its ids do.
            held = pa.py_buffer((4 * ends).astype(np.int32)), pa.py_buffer(flat.tobytes())
            arrays = [
                pa.array(ids, pa.int64()).take(pa.array(owner)),
                pa.array(ends[:-1] - first),
                pa.array(lengths, pa.int64()),
                pa.Array.from_buffers(pa.binary(), len(lengths), [None, *held]),
                pa.array(counts[owner], pa.int64()),
                pa.array(sequences),
                pa.array(np.zeros(len(lengths), np.int64)),
            ]
            return pa.record_batch(arrays, schema=PIECES)

        for part in parts:
            ids, texts, size = [], [], 0
            for one, scalar in zip(part.column("id").to_pylist(), part.column("text"), strict=True):
                text = scalar.as_py()
                if len(text) > AT_ONCE:
                    yield pieces([one], encoder.long_text(text))
                    continue
                ids.append(one)
                texts.append(text)
                size += len(text)
                if size >= AT_ONCE:
                    yield pieces(ids, encoder.flat(texts))
                    ids, texts, size = [], [], 0
            if ids:
                yield pieces(ids, encoder.flat(texts))

    return read.mapInArrow(
        task, "id long, start long, length long, ids binary, doc_tokens long, sequence long, offset long"
    )


def write_buckets(pieces: DataFrame, path: str) -> None:
    """The pieces as Parquet, one folder per bucket of equal lengths."""
    pieces.write.partitionBy("length").parquet(path)
