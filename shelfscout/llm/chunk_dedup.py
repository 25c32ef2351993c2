"""Exact deduplication by content-defined chunk recipes.

Texts are compared without white space. Each is cut where its own characters
say so, so equal texts give equal chunks. The chunks are deduplicated by their
full content: a chunk's 64-bit hash becomes its identifier only after it is
known that one content has that hash, and contents that share a hash get a
number on top. A document is then its ordered list of identifiers, its recipe;
grouping and joining move recipes, never texts.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfscout.llm.common import WHITE_SPACE, text_key, text_of
from shelfscout.session import materialise

# Fixed values of the chunk rule: a cut falls after a letter of the first class
# followed by one of the second, at the earliest after LEAST characters and at
# the latest after MOST.
CUT = "[hpx][bjrz]"
LEAST, MOST = 256, 2048
CHUNK = rf"(?s).{{{LEAST}}}.{{0,{MOST - LEAST - 2}}}?{CUT}|.{{1,{MOST}}}"


def chunk_dedup(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    chunk_hash: Callable[[Column], Column] = F.xxhash64,
) -> DataFrame:
    """One row per input row: which row of its group of equal texts stays.

    Texts are equal if they are identical without the characters of
    ``WHITE_SPACE``; null counts as empty, and empty texts equal each other. The
    row with the most code points in its original text stays, then the smallest
    id (null last); of rows equal in both, one. Columns: ``id``, ``text_key``,
    ``keep_id``, ``group_size``, ``kept``, ``text_sha256`` (of the text without
    white space). Other input columns are not read. An empty table gives no rows.
    A text of any length is cut whole by one task; later steps move its chunks and identifiers.
    """
    stripped = F.regexp_replace(text_of(text_col), f"{WHITE_SPACE}+", "")
    cut = docs.select(
        F.col(f"`{id_col}`").alias("id"),
        F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit("null")).alias("id_key"),
        text_key(text_col).alias("text_key"),
        F.char_length(text_of(text_col)).alias("points"),
        stripped.alias("stripped"),
    ).select(
        "id",
        "id_key",
        "text_key",
        "points",
        F.sha2("stripped", 256).alias("text_sha256"),
        F.regexp_extract_all("stripped", F.lit(CHUNK), F.lit(0)).alias("chunks"),
    )
    recipes = materialise(
        cut.select(
            F.monotonically_increasing_id().alias("row"),
            "id",
            "id_key",
            "text_key",
            "points",
            "text_sha256",
            F.transform("chunks", lambda chunk: chunk_hash(chunk)).alias("recipe"),
        ),
        "recipes",
    )
    contents = cut.select(F.explode("chunks").alias("chunk")).distinct().select(chunk_hash(F.col("chunk")).alias("hash"))
    shared = materialise(contents.groupBy("hash").count().where("count > 1").select("hash"), "shared-hashes")
    if shared.isEmpty():
        numbered = recipes.withColumn("numbers", F.lit(""))
    else:
        numbered = recipes.join(_numbers(cut, shared, chunk_hash), ["id_key", "text_key", "text_sha256"], "left")
        numbered = numbered.withColumn("numbers", F.coalesce("numbers", F.lit("")))
    return _decide(numbered)


def _numbers(cut: DataFrame, shared: DataFrame, chunk_hash: Callable[[Column], Column]) -> DataFrame:
    """Which content is meant, by position, in texts holding a hash that several contents share."""
    chunks = cut.select("id_key", "text_key", "text_sha256", F.posexplode("chunks").alias("at", "chunk"))
    found = chunks.withColumn("hash", chunk_hash(F.col("chunk"))).join(shared, "hash", "left_semi").distinct()
    order = Window.partitionBy("hash").orderBy("chunk")
    number = found.select("hash", "chunk").distinct().withColumn("number", F.row_number().over(order))
    named = found.join(number, ["hash", "chunk"])
    listed = F.array_sort(F.collect_list(F.struct("at", "number")))
    return (
        named.groupBy("id_key", "text_key", "text_sha256")
        .agg(listed.alias("listed"))
        .select("id_key", "text_key", "text_sha256", F.to_json("listed").alias("numbers"))
    )


def _decide(recipes: DataFrame) -> DataFrame:
    best = F.min(F.struct((-F.col("points")).alias("a"), F.col("id").isNull().alias("b"), "id", "row"))
    groups = recipes.groupBy("recipe", "numbers").agg(
        best.alias("best"), F.count(F.lit(1)).alias("group_size")
    )
    return recipes.join(groups, ["recipe", "numbers"]).select(
        "id",
        "text_key",
        F.col("best.id").alias("keep_id"),
        "group_size",
        (F.col("row") == F.col("best.row")).alias("kept"),
        "text_sha256",
    )
