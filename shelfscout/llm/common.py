"""Small helpers the operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The six ASCII characters that count as white space everywhere in this subpackage.
WHITE_SPACE = r"[\x20\x09-\x0D]"


def words_of(text: str | None) -> list[bytes]:
    """Lower-cased (A-Z only) words of a text as UTF-8; a null has none.

    ``bytes.lower`` and ``bytes.split`` know ASCII alone: exactly A-Z, and
    exactly the six characters of ``WHITE_SPACE``.
    """
    return text.encode().lower().split() if text else []


def term_table(digits: bool) -> bytes:
    """For ``bytes.translate`` on UTF-8: letters A-Z lower-cased; a-z, all beyond
    ASCII and, if asked for, digits as they are; every other byte a space."""
    kept = {*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100), *(range(0x30, 0x3A) if digits else ())}
    return bytes(byte + 0x20 * (0x41 <= byte <= 0x5A) if byte in kept else 0x20 for byte in range(256))


def text_of(name: str) -> Column:
    """A text column with null as the empty text."""
    return F.coalesce(F.col(f"`{name}`").cast("string"), F.lit(""))


def text_key(name: str) -> Column:
    """64 bits of a text, to tell rows of one id apart."""
    return F.xxhash64(text_of(name))


def rows_by_key(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``id`` and ``key`` of every row, the row itself in a column ``row``: no name of it can clash."""
    row = F.struct(*[F.col(f"`{name}`").alias(name) for name in docs.columns]).alias("row")
    return docs.select(row, F.col(f"`{id_col}`").alias("id"), text_key(text_col).alias("key"))


def keep_rows(docs: DataFrame, decided: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Rows of ``docs`` that ``decided`` (id, text_key, kept) keeps, all columns as they were.

    Ids may be null or repeated: rows are found by id and text. Of rows equal in
    both, one stays if ``decided`` keeps only one of them.
    """
    keyed = rows_by_key(docs, id_col, text_col)
    kept = decided.where("kept").select(F.col("id").alias("kept_id"), F.col("text_key").alias("kept_key"))
    repeated = decided.groupBy("id", "text_key").count().where("count > 1")
    once = not repeated.isEmpty()
    if once:
        keyed = keyed.dropDuplicates(["id", "key"])
        kept = kept.distinct()
    found = F.col("id").eqNullSafe(F.col("kept_id")) & (F.col("key") == F.col("kept_key"))
    return keyed.join(kept, found, "left_semi").select("row.*")
