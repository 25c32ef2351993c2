"""Exact top-k by inner product through a pivot-distance index.

Inner products become distances by one added coordinate that gives every
candidate the same norm M: |q - x|^2 = |q|^2 + M^2 - 2 q.x. Every vector is
keyed by its nearest pivot and its distance to it; pivot and distance step make
a cell, an annulus around the pivot. By the triangle inequality no vector of an
annulus is nearer to a query than the gap between the query's own distance to
that pivot and the annulus. A query asks for its cells in order of that bound,
twice as many each round, and stops once the bound of the next one cannot reach
its k-th score. Cells are joined with the queries that ask for them in blocks.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfscout.session import materialise

# The least number of pivots, rows per pivot and pivot (pivots grow with the root of the rows, and cells
# with them), distance steps per pivot, and the vectors that pivots are chosen from: at least, and per pivot.
PIVOTS, CROWD, RINGS = 32, 16, 16
SAMPLE, SAMPLED = 2048, 16
# Rows of a cell, and queries that ask for it, that one task multiplies.
BLOCK = 4096
FIRST = 4
# Bounds are computed in doubles; this much of the scale is given away for it.
SLACK = 1e-9


def _vectors(table: DataFrame, id_col: str, vector_col: str, scale: int) -> DataFrame:
    """``vec_id``, ``dim``, ``v`` (floor(scale * x) as little-endian doubles) of rows that take part."""
    cast = table.select(F.col(f"`{id_col}`").cast("long").alias("vec_id"), F.col(f"`{vector_col}`").cast("array<double>").alias("x"))
    whole = cast.where("vec_id is not null and x is not null")
    finite = ~F.exists("x", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))

    def task(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            lists = part.column("x")
            # 0.0 is added for the sign of zeros: equal vectors have equal bytes.
            values = np.floor(scale * lists.flatten().to_numpy(zero_copy_only=False)) + 0.0
            sizes = lists.value_lengths().to_numpy(zero_copy_only=False)
            ends = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])
            held = [None, pa.py_buffer(8 * ends), pa.py_buffer(values.tobytes())]
            packed = pa.Array.from_buffers(pa.large_binary(), len(lists), held).cast(pa.binary())
            yield pa.record_batch(
                [part.column("vec_id"), pa.array(sizes, pa.int32()), packed], names=["vec_id", "dim", "v"]
            )

    return whole.where(finite).mapInArrow(task, "vec_id long, dim int, v binary")


def _matrix(column: pa.ChunkedArray | pa.Array, dim: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), float).reshape(-1, dim)


def scores(queries: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Integer inner products; exact beyond the doubles' range too."""
    if queries.size and rows.size:
        most = np.abs(queries).max() * np.abs(rows).max() * queries.shape[1]
        if most >= 2**53:
            exact = [[int(x) for x in row] for row in rows]
            found = [[sum(int(a) * b for a, b in zip(q, row, strict=True)) for row in exact] for q in queries]
            return np.array(found, object).astype(np.int64)
    return (queries @ rows.T).astype(np.int64)


def choose_pivots(sample: np.ndarray, count: int) -> np.ndarray:
    """Farthest-first points of a sample."""
    chosen = [0]
    apart = np.linalg.norm(sample - sample[0], axis=1)
    while len(chosen) < min(count, len(sample)) and apart.max() > 0:
        chosen.append(int(apart.argmax()))
        apart = np.minimum(apart, np.linalg.norm(sample - sample[chosen[-1]], axis=1))
    return sample[chosen]


def _lifted(rows: np.ndarray, most: float) -> np.ndarray:
    rest = np.sqrt(np.maximum(most**2 - np.square(rows).sum(axis=1), 0))
    return np.c_[rows, rest]


def _distances(points: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """From every point to every pivot; the pivots, not the points, are looped over."""
    return np.stack([np.linalg.norm(points - pivot, axis=1) for pivot in pivots], axis=1)


def exact_top_k(
    table: DataFrame,
    is_query: Column,
    k: int = 10,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    scale: int = 1024,
    report: Callable[[dict[str, int]], None] | None = None,
) -> DataFrame:
    """The ``k`` best candidates of every query: ``query_id``, ``rank`` (from 1), ``vec_id``, ``score``.

    Components become floor(scale * x); the score is their inner product, ties
    go to the smaller id. Queries are the rows ``is_query`` holds for (over
    column ``vec_id``), candidates all rows but those of the query's own id. A
    candidate's repeated rows are candidates of their own, so its id may take
    several ranks. A query's repeated rows, equal in id and vector, are asked
    once; an id with several vectors is a query, ranked from 1, for each. Null
    ids, and vectors that are null or hold null or non-finite components, take no
    part; vectors of different length are never compared. Fewer candidates than
    ``k`` give fewer rows; an empty table none. A score beyond a long is an error.
    Other columns are not read.

    ``report`` is called once per length of vectors with the numbers of
    ``queries``, ``rows``, ``pivots`` and pairs ``compared``; pairs the index has
    pruned are queries times rows less those.
    """
    vectors = materialise(_vectors(table, id_col, vector_col, scale), "vectors")
    # Of equal vectors only the k + 1 smallest ids, k rows each, can be among the best k of a query.
    alike = Window.partitionBy("v").orderBy("vec_id")
    held = vectors.groupBy("dim", "v", "vec_id").agg(F.least(F.count(F.lit(1)), F.lit(k)).alias("copies"))
    held = held.withColumn("place", F.row_number().over(alike)).where(F.col("place") <= k + 1)
    rows = held.select("vec_id", "dim", "v", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("copy"))
    rows = materialise(rows.drop("copy"), "candidates")
    found = None
    # Vectors of one length are one search; a table usually has one length.
    for (dim,) in vectors.where(is_query).select("dim").distinct().orderBy("dim").collect():
        one = _search(rows.where(F.col("dim") == dim), vectors.where(is_query & (F.col("dim") == dim)), k, dim, report)
        found = one if found is None else found.unionByName(one)
    if found is None:
        return table.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    return found


def pivots_for(rows: int) -> int:
    """With CROWD * p * p rows and more, p pivots: a cell's rows and a query's cells grow alike."""
    return max(PIVOTS, math.isqrt(rows // CROWD))


def _search(
    rows: DataFrame, queries: DataFrame, k: int, dim: int, report: Callable[[dict[str, int]], None] | None
) -> DataFrame:
    spark, total = rows.sparkSession, rows.count()
    few_pivots = pivots_for(total)
    wanted_sample = max(SAMPLE, SAMPLED * few_pivots)
    share = min(1.0, wanted_sample / max(1, total))
    few = rows.withColumn("order", F.xxhash64("v"))
    if share < 1:
        few = few.where(F.col("order") < F.lit(int((2 * share - 1) * (2**63 - 1))))
    sample = _matrix(pa.array([bytes(x.v) for x in few.orderBy("order", "vec_id").limit(wanted_sample).collect()], pa.binary()), dim)

    def norms(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            yield pa.record_batch([pa.array(np.square(_matrix(part.column("v"), dim)).sum(axis=1))], names=["n"])

    most = float(np.sqrt(rows.select("v").mapInArrow(norms, "n double").agg(F.max("n")).first()[0] or 0.0))
    if not len(sample):
        sample = np.zeros((1, dim))
    pivots = choose_pivots(_lifted(sample, most), few_pivots)
    near = _distances(_lifted(sample, most), pivots).min(axis=1)
    width = max(float(near.max()) / RINGS, 1e-12)

    def keyed(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            apart = _distances(_lifted(_matrix(part.column("v"), dim), most), pivots)
            pivot = apart.argmin(axis=1)
            distance = apart[np.arange(len(pivot)), pivot]
            ring = np.minimum(distance / width, RINGS - 1).astype(int)
            yield pa.record_batch(
                [part.column("vec_id"), part.column("v"), pa.array(pivot * RINGS + ring), pa.array(distance)],
                names=["vec_id", "v", "cell", "distance"],
            )

    index = materialise(rows.select("vec_id", "v").mapInArrow(keyed, "vec_id long, v binary, cell long, distance double"), "index")
    # One row per cell: pivots times rings at most.
    span = (F.min("distance").alias("low"), F.max("distance").alias("high"), F.count(F.lit(1)).alias("rows"))
    cells = index.groupBy("cell").agg(*span).orderBy("cell").collect()
    cell = np.array([x.cell for x in cells], int)
    low, high = (np.array([x[name] for x in cells], float) for name in ("low", "high"))
    rows_of = {x.cell: x.rows for x in cells}
    parts_of = {x.cell: -(-x.rows // BLOCK) for x in cells}

    def upper(vectors: np.ndarray) -> np.ndarray:
        """Highest score a cell can hold for each query."""
        apart = _distances(np.c_[vectors, np.zeros(len(vectors))], pivots)[:, cell // RINGS]
        gap = np.maximum(np.maximum(apart - high, low - apart), 0)
        scale = np.square(vectors).sum(axis=1)[:, None] + most**2
        return (scale - np.square(gap)) / 2 + SLACK * scale

    # Numbered, for an id may ask with several vectors; written, the numbers stay.
    queries = queries.select(F.col("vec_id").alias("query_id"), "v").distinct()
    queries = materialise(queries.withColumn("query", F.monotonically_increasing_id()), "queries")
    best, start, count = None, 0, max(FIRST, len(cell) // 64)
    compared = 0
    while start < len(cell):
        state = queries.withColumn("least", F.lit(None).cast("double"))
        if best is not None:
            kth = best.where(F.col("rank") == k).select("query", F.col("score").cast("double").alias("least"))
            state = queries.join(kth, "query", "left")

        def asked(parts: Iterator[pa.RecordBatch], start: int = start, count: int = count) -> Iterator[pa.RecordBatch]:
            for part in parts:
                bound = upper(_matrix(part.column("v"), dim))
                order = np.argsort(-bound, axis=1, kind="stable")[:, start : start + count]
                least = np.array([-np.inf if x is None else x for x in part.column("least").to_pylist()])
                at, place = np.nonzero(np.take_along_axis(bound, order, axis=1) >= least[:, None])
                kept = [part.column(name).take(pa.array(at)) for name in ("query", "query_id", "v")]
                yield pa.record_batch([*kept, pa.array(cell[order[at, place]])], names=["query", "query_id", "v", "cell"])

        wanted = materialise(state.mapInArrow(asked, "query long, query_id long, v binary, cell long"), "asked")
        calls = {row.cell: row["count"] for row in wanted.groupBy("cell").count().collect()}  # one row per cell at most
        if not calls:
            break
        compared += sum(rows_of[c] * n for c, n in calls.items())
        sizes = spark.createDataFrame(
            [(c, parts_of[c], -(-n // BLOCK)) for c, n in calls.items()], "cell long, row_parts int, query_parts int"
        )
        left = wanted.join(F.broadcast(sizes), "cell").withColumn("query_part", F.pmod(F.xxhash64("query"), "query_parts").cast("int"))
        left = left.withColumn("row_part", F.explode(F.sequence(F.lit(0), F.col("row_parts") - 1)))
        right = index.join(F.broadcast(sizes), "cell").withColumn("row_part", F.pmod(F.xxhash64("vec_id"), "row_parts").cast("int"))
        right = right.withColumn("query_part", F.explode(F.sequence(F.lit(0), F.col("query_parts") - 1)))
        key = ["cell", "row_part", "query_part"]

        def multiply(asking: pa.Table, held: pa.Table) -> pa.Table:
            names = pa.schema([(name, pa.int64()) for name in ("query", "query_id", "vec_id", "score")])
            if not asking.num_rows or not held.num_rows:
                return names.empty_table()
            ids = held.column("vec_id").to_numpy()
            asked_by = (asking.column(name).to_numpy() for name in ("query", "query_id"))
            table = scores(_matrix(asking.column("v"), dim), _matrix(held.column("v"), dim))
            out: list[list] = [[], [], [], []]
            for query, own, line in zip(*asked_by, table, strict=True):
                other = np.flatnonzero(ids != own)
                top = other[np.lexsort((ids[other], -line[other]))[:k]]
                for column, values in zip(out, ([query] * len(top), [own] * len(top), ids[top], line[top]), strict=True):
                    column.extend(values)
            return pa.table([pa.array(x, pa.int64()) for x in out], schema=names)

        made = left.select(*key, "query", "query_id", "v").groupBy(*key).cogroup(right.select(*key, "vec_id", "v").groupBy(*key))
        new = made.applyInArrow(multiply, "query long, query_id long, vec_id long, score long")
        if best is not None:
            new = new.unionByName(best.select("query", "query_id", "vec_id", "score"))
        place = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "vec_id"))
        best = materialise(new.withColumn("rank", place).where(F.col("rank") <= k), "best")
        start, count = start + count, 2 * count
    if report is not None:
        report({"queries": queries.count(), "rows": total, "pivots": len(pivots), "compared": compared})
    if best is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    return best.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
