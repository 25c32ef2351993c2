"""Token counts by a count-only Viterbi search.

An Aho-Corasick automaton lists every vocabulary piece that ends at a
character; dynamic programming carries, for each character, the best score, the
number of tokens on the best path and whether it ends in an unknown character.
No piece, id or offset is kept. Words are independent (a space starts a new
one), so each distinct word is searched once and remembered.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfscout.llm.common import text_of

MARK = "▁"  # stands for a space, at the start of every word
# Fixed by the unigram tokenizer: how far an unknown character lies below the worst piece.
UNKNOWN = 10.0
# Characters searched at a time, words remembered per worker before it starts anew.
AT_ONCE = 1 << 20
REMEMBERED = 400_000


class Counter:
    """Counts tokens as a unigram tokenizer with the given pieces would.

    Rules, in the tokenizer's order: the path of highest score wins; of equal
    paths to a character the one whose last piece starts first; a character that
    is no piece itself may be unknown, at the worst score less ``UNKNOWN``.
    Neighbouring unknown characters are one token, or one per byte if the
    vocabulary has a piece for each of their bytes.
    """

    _loaded: dict[str, Counter] = {}

    def __init__(self, pieces: Sequence[tuple[str, float]]):
        import ahocorasick

        self.automaton = ahocorasick.Automaton()
        for piece, score in pieces:
            if piece:
                self.automaton.add_word(piece, (len(piece), score))
        self.automaton.make_automaton()
        names = {piece for piece, _ in pieces}
        self.bytes = {i for i in range(256) if f"<0x{i:02X}>" in names}
        self.unknown = min((score for _, score in pieces), default=0.0) - UNKNOWN
        self.memo: dict[str, tuple[int, float]] = {}

    @classmethod
    def at(cls, path: str) -> Counter:
        """From a sentencepiece model file: its pieces and scores."""
        if path not in cls._loaded:
            import sentencepiece

            model = sentencepiece.SentencePieceProcessor(model_file=path)
            size = model.get_piece_size()
            cls._loaded[path] = cls([(model.id_to_piece(i), model.get_score(i)) for i in range(size)])
        return cls._loaded[path]

    def word(self, word: str) -> tuple[int, float]:
        """Tokens and best score of one word, its mark included."""
        ends: dict[int, list[tuple[int, float]]] = {}
        for end, found in self.automaton.iter(word):  # longest first at every end
            ends.setdefault(end, []).append(found)
        # Per character: best score, tokens before the open run of unknowns, that run's start.
        best: list[tuple[float, int, int]] = [(0.0, 0, -1)]
        for end in range(len(word)):
            top, single = None, False
            for length, score in ends.get(end, ()):
                single = single or length == 1
                before = best[end + 1 - length]
                total = before[0] + score
                if top is None or total > top[0]:
                    top = (total, self._closed(word, before, end + 1 - length) + 1, -1)
            if not single:
                before = best[end]
                total = before[0] + self.unknown
                if top is None or total > top[0]:
                    top = (total, before[1], before[2] if before[2] >= 0 else end)
            best.append(top)
        return self._closed(word, best[-1], len(word)), best[-1][0]

    def _closed(self, word: str, state: tuple[float, int, int], end: int) -> int:
        _, tokens, start = state
        if start < 0:
            return tokens
        run = word[start:end].encode()
        return tokens + (len(run) if self.bytes.issuperset(run) else 1)

    def texts(self, texts: list[str]) -> list[tuple[int, float]]:
        cut = [words_of(text) for text in texts]
        if len(self.memo) > REMEMBERED:
            self.memo.clear()
        for word in set().union(*cut).difference(self.memo):
            self.memo[word] = self.word(MARK + word)
        find, found = self.memo.__getitem__, []
        for words in cut:
            each = list(map(find, words))
            found.append((sum(tokens for tokens, _ in each), sum(score for _, score in each)))
        return found


def words_of(text: str) -> list[str]:
    """Words without their mark: a mark or space starts one, the text's start another unless it is one."""
    if not text:
        return []
    words = text.replace(MARK, " ").split(" ")
    return words if words[0] else words[1:]


def count_tokens(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: ``id``, ``n_tokens``, ``best_score``.

    ``vocabulary`` is the path of a sentencepiece model file, present on every
    executor; its pieces and scores are the unigram vocabulary. Null and empty
    texts have no tokens and score 0. Repeated rows and null ids are rows of
    their own; an empty table gives no rows; other columns are not read. A word
    of any length is searched in one piece, in memory proportional to it.
    """
    read = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), text_of(text_col).alias("text"))

    def task(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter.at(vocabulary)
        for part in parts:
            found, held, size = [], [], 0
            for scalar in part.column("text"):
                text = scalar.as_py()
                held.append(text)
                size += len(text)
                if size >= AT_ONCE:
                    found += counter.texts(held)
                    held, size = [], 0
            found += counter.texts(held)
            counts, scores = zip(*found, strict=True) if found else ((), ())
            yield pa.record_batch(
                [part.column("id"), pa.array(counts, pa.int64()), pa.array(scores, pa.float64())],
                names=["id", "n_tokens", "best_score"],
            )

    return read.mapInArrow(task, "id long, n_tokens long, best_score double")
