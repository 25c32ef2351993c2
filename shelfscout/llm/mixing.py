"""Mixing sources to target weights by entropy balancing.

Every document gets the rate, in copies, that stays closest to 1 in relative
entropy (weighted by size) while each group's tokens meet their target. The
convex dual has one unknown per target; Newton's method solves it, each step
one Spark aggregate for value, gradient and Hessian over the groups' cells. The
rates are exponentials of sums of those unknowns, cut off at ``most``.

Rates become whole copies without losing the totals: documents of one cell and
size are alike, so their extra copies are counted per size, from the largest
down, carrying the remainder along; which of them get one is decided by a hash.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfscout.llm.common import rows_by_key, text_key, text_of
from shelfscout.session import materialise

WORD = r"[^\x20\x09-\x0D]+"
# Rows of one cell and size that are ranked together.
RANKED = 1000


def source_targets(
    totals: dict[str | None, int], share: float = 1.5, weights: Sequence[float] = (3, 1, 2), most: float = 2.0
) -> dict[str | None, float]:
    """Targets per source: ``share`` of all tokens by weight, none above ``most`` times its source.

    Sources go by code point, null last, and take the weights in turn. What a
    capped source cannot take is shared among the others by weight until none is
    above its cap.
    """
    names = sorted(totals, key=lambda name: (name is None, name or ""))
    weight = {name: weights[i % len(weights)] for i, name in enumerate(names)}
    left, open_names, targets = share * sum(totals.values()), list(names), {}
    while open_names:
        unit = left / sum(weight[name] for name in open_names)
        over = [name for name in open_names if unit * weight[name] > most * totals[name]]
        if not over:
            return targets | {name: unit * weight[name] for name in open_names}
        for name in over:
            targets[name] = float(most * totals[name])
            left -= targets[name]
        open_names = [name for name in open_names if name not in targets]
        left = max(left, 0.0)
    return targets


def _dual(cells: DataFrame, unknown: np.ndarray, most: float) -> tuple[float, np.ndarray, np.ndarray]:
    """Sum over cells of the dual's value, with gradient and Hessian, in one aggregate."""
    count = len(unknown)

    def part_sums(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        value, gradient, hessian = 0.0, np.zeros(count), np.zeros((count, count))
        for part in parts:
            sizes = part.column("size").to_numpy().astype(float)
            at = np.array(part.column("at").to_pylist(), np.int64).reshape(len(sizes), -1)
            tilt = unknown[at].sum(axis=1)
            rate = np.exp(np.minimum(tilt, math.log(most)))
            value += (sizes * (rate + most * np.maximum(tilt - math.log(most), 0))).sum()
            free = sizes * rate * (tilt < math.log(most))
            for a in at.T:
                np.add.at(gradient, a, sizes * rate)
                for b in at.T:
                    np.add.at(hessian, (a, b), free)
        rows, columns = np.nonzero(hessian)
        first = np.flatnonzero(gradient)
        yield pa.record_batch(
            [
                pa.array(np.r_[-1, first, rows]),
                pa.array(np.r_[-1, np.full(len(first), -1), columns]),
                pa.array(np.r_[value, gradient[first], hessian[rows, columns]]),
            ],
            names=["i", "j", "x"],
        )

    sums = cells.mapInArrow(part_sums, "i long, j long, x double").groupBy("i", "j").agg(F.sum("x").alias("x"))
    value, gradient, hessian = 0.0, np.zeros(count), np.zeros((count, count))
    for i, j, x in sums.collect():  # as many rows as the unknowns have pairs
        if i < 0:
            value = x
        elif j < 0:
            gradient[i] = x
        else:
            hessian[i, j] = x
    return value, gradient, hessian


def solve(cells: DataFrame, targets: np.ndarray, most: float, steps: int = 60) -> np.ndarray:
    """The dual's unknowns for cells (``at``: which targets a cell counts toward, ``size``: its tokens).

    Damped Newton steps; a target that cannot be met within ``most`` is met as
    far as it can be.
    """
    unknown = np.zeros(len(targets))
    value, gradient, hessian = _dual(cells, unknown, most)
    value -= unknown @ targets
    for _ in range(steps):
        miss = targets - gradient
        if (np.abs(miss) <= 1e-8 * np.maximum(targets, 1)).all():
            break
        ridge = 1e-9 * max(1.0, hessian.max(initial=0))
        step = np.linalg.solve(hessian + ridge * np.eye(len(targets)), miss)
        step *= min(1.0, 1.0 / max(np.abs(step).max(), 1e-12))
        while True:
            tried = unknown + step
            new, new_gradient, new_hessian = _dual(cells, tried, most)
            new -= tried @ targets
            noise = 1e-13 * (abs(value) + np.abs(tried * targets).sum())
            if new <= value - 1e-4 * (step @ miss) + noise or np.abs(step).max() < 1e-10:
                break
            step /= 2
        unknown, value, gradient, hessian = tried, new, new_gradient, new_hessian
        if np.abs(step).max() < 1e-10:
            break
    return unknown


def _extras(rate: float) -> tuple[int, float]:
    whole = math.floor(rate + 1e-9)
    return whole, max(0.0, rate - whole)


def quotas(sizes: pd.DataFrame) -> pd.DataFrame:
    """Extra copies per size of one cell, largest first, the remainder carried along."""
    sizes = sizes.sort_values("size", ascending=False, ignore_index=True)
    whole, extra = _extras(float(sizes["rate"].iloc[0])) if len(sizes) else (0, 0.0)
    carried, given = 0.0, []
    rest = float((sizes["size"] * sizes["rows"]).sum())
    for size, rows in zip(sizes["size"].tolist(), sizes["rows"].tolist(), strict=True):
        rest -= size * rows
        wanted, take = carried + extra * size * rows, 0
        if size:
            # As near as can be, but no more is left than the smaller sizes can make up for.
            low, high = (wanted - (1 - extra) * rest) / size, (wanted + extra * rest) / size
            take = min(max(math.floor(wanted / size + 0.5), math.ceil(low - 1e-9)), math.floor(high + 1e-9))
            take = min(max(take, 0), rows)
        carried = wanted - take * size
        given.append(take)
    return sizes.assign(whole=whole, extra=given)[["cell", "size", "rows", "whole", "extra"]]


def mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    share: float = 1.5,
    weights: Sequence[float] = (3, 1, 2),
    most: float = 2.0,
) -> DataFrame:
    """One row per input row with the copies the mix takes of it.

    Size: words of the text (null: 0). Targets: ``source_targets``. Columns:
    ``id``, ``text_key``, ``size``, ``source_size``, ``target``, ``rate``,
    ``copies`` (at most ``most``, rounded up); a document's tokens in the mix are
    copies times size. Null sources are a source of their own. Documents without
    words are taken as often as the rate's whole part says and count nothing.
    Repeated rows are rows of their own; equal ones may differ in copies by one.
    Other columns are not read; an empty table gives no rows. One total per
    source reaches the driver, as many as there are targets.
    A text of any length is counted whole by one task.
    """
    sized = docs.select(
        F.col(f"`{id_col}`").alias("id"),
        F.col(f"`{source_col}`").cast("string").alias("source"),
        text_key(text_col).alias("text_key"),
        F.regexp_count(text_of(text_col), F.lit(WORD)).cast("long").alias("size"),
    )
    sized = materialise(sized, "sizes")
    # Written: one row per source, read again by every Newton step.
    per_source = materialise(sized.groupBy("source").agg(F.sum("size").alias("size")), "source-sizes")
    totals = {row.source: row["size"] for row in per_source.collect()}
    targets = source_targets(totals, share, weights, most)
    names = sorted(targets, key=lambda name: (name is None, name or ""))
    spark = docs.sparkSession
    schema = "source string, cell int, source_size long, target double"
    listed = spark.createDataFrame([(n, i, totals[n], targets[n]) for i, n in enumerate(names)], schema)

    cells = per_source.join(F.broadcast(listed), per_source["source"].eqNullSafe(listed["source"]))
    cells = cells.where("size > 0").select(F.array("cell").alias("at"), "size")
    unknown = solve(cells, np.array([targets[name] for name in names]), most)
    rates = [(n, min(math.exp(u), most) if totals[n] else 0.0) for n, u in zip(names, unknown, strict=True)]
    rated = spark.createDataFrame(rates, "source string, rate double")
    listed = listed.join(F.broadcast(rated), listed["source"].eqNullSafe(rated["source"])).drop(rated["source"])

    # One row per source: as many as there are targets, so sent to every executor.
    named = sized.join(
        F.broadcast(listed.withColumnRenamed("source", "name")), F.col("source").eqNullSafe(F.col("name"))
    ).drop("name", "source")
    alike = named.groupBy("cell", "size").agg(F.count(F.lit(1)).alias("rows"), F.first("rate").alias("rate"))
    # At most one row per document length in a cell.
    given = alike.groupBy("cell").applyInPandas(
        lambda part: quotas(part), "cell int, size long, rows long, whole long, extra long"
    )
    order = F.xxhash64("id", "text_key")
    parts = F.ceil(F.col("rows") / RANKED)
    # One length may be that of most documents of a source: adaptive execution splits such a key of an inner join.
    placed = named.join(given, ["cell", "size"]).withColumn("order", order).withColumn("part", F.pmod("order", parts))
    placed = materialise(placed, "placed")
    counts = placed.groupBy("cell", "size", "part").agg(F.count(F.lit(1)).alias("here"))
    before = Window.partitionBy("cell", "size").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select("cell", "size", "part", F.coalesce(F.sum("here").over(before), F.lit(0)).alias("before"))
    # Written, so that the join deals rows by part too and not by the counts' layout.
    counts = materialise(counts, "part-counts")
    within = Window.partitionBy("cell", "size", "part").orderBy("order", "id")
    ranked = placed.withColumn("rank", F.row_number().over(within)).join(counts, ["cell", "size", "part"])
    chosen = (F.col("before") + F.col("rank") <= F.col("extra")).cast("long")
    return ranked.select(
        "id", "text_key", "size", "source_size", "target", "rate", (F.col("whole") + chosen).alias("copies")
    )


def copy_rows(docs: DataFrame, decided: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Rows of ``docs``, each as often as ``decided`` (id, text_key, copies) says, all columns as they were.

    Rows are found by id and text; of rows equal in both, one stands for all and
    gets their copies together.
    """
    keyed = rows_by_key(docs, id_col, text_col)
    wanted = decided.groupBy("id", "text_key").agg(
        F.sum("copies").cast("int").alias("copies"), F.count(F.lit(1)).alias("rows")
    )
    wanted = materialise(wanted.withColumnsRenamed({"id": "to_id", "text_key": "to_key"}), "copies")
    if not wanted.where("rows > 1").isEmpty():
        keyed = keyed.dropDuplicates(["id", "key"])
    found = F.col("id").eqNullSafe(F.col("to_id")) & (F.col("key") == F.col("to_key"))
    taken = keyed.join(wanted.where("copies > 0"), found)
    return taken.select(F.explode(F.array_repeat("row", F.col("copies"))).alias("row")).select("row.*")
