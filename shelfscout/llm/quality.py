"""Quality classifier: naive Bayes support vectors.

Indicators of hashed n-grams are scaled by the log-count ratio of the two
classes, and a linear hinge-loss model is fitted over them by dual coordinate
descent. Features: byte trigrams, words and word pairs of the lower-cased text;
a word that repeats the one before it counts as "again", so runs of any word
look alike. Only the text is read, never another column.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfscout.llm.common import text_of, words_of

SPREAD = np.uint32(2654435761)  # Knuth's multiplier
AGAIN = zlib.crc32(b"\x00again")
# Bytes whose n-grams are taken at a time.
AT_ONCE = 1 << 20


@dataclass(frozen=True)
class Fit:
    """How the model is fitted.

    ``sample`` bounds the labelled rows that are read for the fit (the labels
    with the smallest hashes of their id), ``bits`` the feature space.
    """

    sample: int = 10_000
    bits: int = 18
    smoothing: float = 1.0
    cost: float = 1.0
    epochs: int = 12
    seed: int = 7


@dataclass(frozen=True)
class Model:
    """Weights per feature (ratio times hinge weight), ratios, and the line from margin to score."""

    bits: int
    weights: np.ndarray
    ratios: np.ndarray
    bias: float
    slope: float
    shift: float

    def score(self, text: str | None) -> float:
        return float(1 / (1 + np.exp(-(self.slope * self.margin(features(text, self.bits)) + self.shift))))

    def margin(self, found: np.ndarray) -> float:
        length = np.sqrt(np.square(self.ratios[found]).sum())
        return float(self.weights[found].sum() / length + self.bias) if length > 0 else self.bias


def features(text: str | None, bits: int) -> np.ndarray:
    """The distinct features of a text, sorted; an empty text has none."""
    shift = np.uint32(32 - bits)
    found = []
    words = words_of(text)
    for start in range(0, len(words), AT_ONCE):
        # One word and two bytes of overlap, so no n-gram is lost between parts.
        part = words[max(0, start - 1) : start + AT_ONCE]
        codes = np.fromiter(map(zlib.crc32, part), np.uint32, len(part))
        codes[1:][codes[1:] == codes[:-1]] = AGAIN
        pairs = codes[:-1] * SPREAD ^ codes[1:]
        octets = np.frombuffer(b" ".join(part), np.uint8).astype(np.uint32)
        runs = octets[:-2] << np.uint32(16) | octets[1:-1] << np.uint32(8) | octets[2:]
        for salt, grams in enumerate((codes, pairs, runs), 1):
            found.append(np.unique((grams ^ np.uint32(salt * 0x3C6EF372 & 0xFFFFFFFF)) * SPREAD >> shift))
    return np.unique(np.concatenate(found)).astype(np.int32) if found else np.zeros(0, np.int32)


def _fit(rows: list[tuple[np.ndarray, int]], how: Fit) -> Model:
    """``rows``: features and label (0 or 1), in a fixed order. Every fourth row only sets the score's line."""
    size = 1 << how.bits
    learn = [row for i, row in enumerate(rows) if i % 4]
    aside = [row for i, row in enumerate(rows) if i % 4 == 0]
    counts = np.full((2, size), how.smoothing)
    for found, label in learn:
        counts[label, found] += 1
    ratios = np.log(counts[1] / counts[1].sum()) - np.log(counts[0] / counts[0].sum())
    weights, bias = np.zeros(size), 0.0
    scaled = []
    for found, label in learn:
        values = ratios[found]
        length = np.sqrt(np.square(values).sum())
        scaled.append((found, values / length if length > 0 else values, 2 * label - 1))
    share = np.array([max(1, sum(y > 0 for *_, y in scaled)), max(1, sum(y < 0 for *_, y in scaled))])
    upper = how.cost * len(scaled) / (2 * share) if scaled else np.ones(2)
    duals, order = np.zeros(len(scaled)), np.random.default_rng(how.seed)
    for _ in range(how.epochs):
        for i in order.permutation(len(scaled)):
            found, values, y = scaled[i]
            slope = y * (weights[found] @ values + bias) - 1
            dual = min(max(duals[i] - slope / (values @ values + 1), 0.0), upper[0 if y > 0 else 1])
            if dual != duals[i]:
                step = (dual - duals[i]) * y
                weights[found] += step * values
                bias += step
                duals[i] = dual
    model = Model(how.bits, (weights * ratios).astype(np.float32), ratios.astype(np.float32), bias, 1.0, 0.0)
    margins = np.array([model.margin(found) for found, _ in aside])
    slope, shift = _line(margins, np.array([label for _, label in aside], float))
    return Model(how.bits, model.weights, model.ratios, bias, slope, shift)


def _line(margins: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Logistic fit of label on margin by Newton's steps; a faint prior keeps it finite."""
    line, prior = np.array([1.0, 0.0]), np.diag([1e-2, 1e-2])
    if len(margins):
        inputs = np.stack([margins, np.ones_like(margins)], axis=1)
        for _ in range(50):
            chance = 1 / (1 + np.exp(-np.clip(inputs @ line, -30, 30)))
            pull = inputs.T @ (labels - chance) - prior @ (line - [1.0, 0.0])
            step = np.linalg.solve(inputs.T @ (inputs * (chance * (1 - chance))[:, None]) + prior, pull)
            line = line + step * min(1.0, 2.0 / (np.abs(step).max() + 1e-12))
            if np.abs(step).max() < 1e-9:
                break
    return max(float(line[0]), 1e-3), float(line[1])


def train(
    docs: DataFrame,
    labels: DataFrame,
    label_col: str = "quality",
    id_col: str = "doc_id",
    text_col: str = "text",
    usable: Column | None = None,
    how: Fit = Fit(),  # noqa: B008
) -> Model:
    """Fit on at most ``how.sample`` labelled documents.

    ``usable`` says which rows of ``labels`` may be learned from. Labels other
    than 0 and 1 and null ids are left out; of repeated ids one label and one
    document count. Without any label the model is indifferent (score 0.5).
    A text of any length gives its features a part at a time.
    """
    known = (labels if usable is None else labels.where(usable)).select(
        F.col(f"`{id_col}`").alias("id"), F.col(f"`{label_col}`").cast("int").alias("label")
    )
    known = known.where(F.col("id").isNotNull() & F.col("label").isin(0, 1))
    known = known.groupBy("id").agg(F.min("label").alias("label")).withColumn("order", F.xxhash64("id"))
    # A threshold on the hash first, so no more than a few rows too many are ever ranked.
    share = min(1.0, 1.1 * how.sample / max(1, known.count()))
    if share < 1:
        known = known.where(F.col("order") < F.lit(int((2 * share - 1) * (2**63 - 1))))
    known = known.orderBy("order", "id").limit(how.sample)
    texts = docs.select(F.col(f"`{id_col}`").alias("id"), text_of(text_col).alias("text"))
    bits = how.bits

    def read(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            found = [features(text.as_py(), bits).tobytes() for text in part.column("text")]
            yield pa.record_batch(
                [part.column("order"), part.column("id").cast(pa.string()), part.column("label"), pa.array(found, pa.binary())],
                names=["order", "id", "label", "found"],
            )

    # At most ``how.sample`` rows of 12 bytes: bounded, so sent to every executor.
    rows = texts.join(F.broadcast(known), "id").select("order", "id", "label", "text")
    rows = rows.mapInArrow(read, "order long, id string, label int, found binary")
    rows = rows.groupBy("id").agg(F.min(F.struct("order", "label", "found")).alias("one")).select("one.*", "id")
    rows = rows.select("order", "id", "label", "found")

    def fit(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = sorted(row for part in parts for row in zip(*part.to_pydict().values(), strict=True))
        model = _fit([(np.frombuffer(x, np.int32), label) for _, _, label, x in found], how)
        yield pa.record_batch(
            [
                pa.array([model.weights.tobytes()]),
                pa.array([model.ratios.tobytes()]),
                pa.array([[model.bias, model.slope, model.shift]], pa.list_(pa.float64())),
            ],
            names=["weights", "ratios", "rest"],
        )

    made = rows.repartition(1).mapInArrow(fit, "weights binary, ratios binary, rest array<double>").collect()
    if not made:
        nothing = np.zeros(1 << bits, np.float32)
        return Model(bits, nothing, nothing, 0.0, 1.0, 0.0)
    weights, ratios = (np.frombuffer(bytes(x), np.float32) for x in made[0][:2])
    return Model(bits, weights, ratios, *made[0].rest)


def score(docs: DataFrame, model: Model, text_col: str = "text", name: str = "score") -> DataFrame:
    """All columns of ``docs`` with the score (0 to 1, higher: label 1 likelier).

    Null and empty texts get the score of the bias alone. A column called
    ``name`` that is already there is replaced.
    A text of any length gives its features a part at a time.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)  # two floats per feature

    @F.pandas_udf("double")
    def chance(texts: pd.Series) -> pd.Series:
        one = sent.value
        return texts.map(one.score)

    return docs.withColumn(name, chance(text_of(text_col)))
