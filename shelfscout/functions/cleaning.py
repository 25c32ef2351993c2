"""Turning dirty text into typed values. Bad values become NULL, never an error."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Every character with the Unicode White_Space property. A literal
# list for btrim is cheaper per row than a regular expression.
WHITESPACE = (
    "\t\n\u000b\u000c\r\u0020\u0085\u00a0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
ASCII_WHITESPACE = "\t\n\u000b\u000c\r\u0020"
# Fixed value: what a money text may keep.
MONEY_NOISE = r"[^0-9.\-]"
MONEY_TYPE = "decimal(38,9)"
# Fixed value: a money text in the export's own layout (optional prefix, comma groups).
MONEY_LAYOUT = r"^(GBP\s*)?-?(\d{1,3}(,\d{3})+|\d+)(\.\d+)?$"
# Dates written out in full, which a cast reads at a fraction of a format's cost.
DMY_LAYOUT = r"\A[0-9]{2}/[0-9]{2}/[1-9][0-9]{3}\z"
ISO_LAYOUT = r"\A[1-9][0-9]{3}-[0-9]{2}-[0-9]{2}\z"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _bare(text: Column) -> Column:
    """Whether a text begins and ends with a visible ASCII character, so there is
    nothing to trim. An empty text does not."""
    return F.substring(text, 1, 1).between("!", "~") & F.substring(text, -1, 1).between("!", "~")


def trimmed(c: Column | str) -> Column:
    """Edge white space off, tabs and no-break spaces included. Most texts need
    none of it, and a look at both ends costs less than the list."""
    text = _col(c)
    return F.when(_bare(text), text).otherwise(F.btrim(text, F.lit(WHITESPACE)))


def trimmed_fact(c: Column | str) -> Column:
    """The same result for columns of a fact table, at about half the cost: plain
    ASCII text, one byte per character, is trimmed against the short list. Makes
    larger code, so not for the wide staging projections."""
    text = _col(c)
    is_ascii = F.octet_length(text) == F.length(text)
    return F.when(is_ascii, F.btrim(text, F.lit(ASCII_WHITESPACE))).otherwise(trimmed(text))


def clean_string(c: Column | str) -> Column:
    """Trimmed text; nothing left means NULL."""
    text = _col(c)
    return F.when(_bare(text), text).otherwise(F.nullif(F.btrim(text, F.lit(WHITESPACE)), F.lit("")))


def parse_money(c: Column | str) -> Column:
    """``GBP 76,503.29`` to an exact decimal.

    Keeps digits, points and minus signs only, so ``(500)`` reads as 500; see
    ``money_layout_ok`` for a strict test.
    """
    digits = F.regexp_replace(clean_string(c), MONEY_NOISE, "")
    return digits.try_cast(MONEY_TYPE)


def money_layout_ok(c: Column | str) -> Column:
    """True where the text has the expected layout; NULL for a missing value."""
    return clean_string(c).rlike(MONEY_LAYOUT)


def parse_dmy(c: Column | str) -> Column:
    """Day-first dates. One format per column: a silent switch must surface."""
    text = _col(c)
    day = F.concat_ws("-", F.substring(text, 7, 4), F.substring(text, 4, 2), F.substring(text, 1, 2))
    return F.when(text.rlike(DMY_LAYOUT), day.try_cast("date")).otherwise(F.try_to_date(clean_string(c), "d/M/yyyy"))


def parse_iso(c: Column | str) -> Column:
    text = _col(c)
    return F.when(text.rlike(ISO_LAYOUT), text.try_cast("date")).otherwise(F.try_to_date(clean_string(c), "yyyy-M-d"))


def normalise_key(c: Column | str) -> Column:
    """Join keys are text on both sides, whatever type the source used."""
    return clean_string(_col(c).cast("string"))


def full_name(first: Column | str, last: Column | str) -> Column:
    """Both parts missing gives an empty text, not NULL."""
    parts = [F.coalesce(clean_string(part), F.lit("")) for part in (first, last)]
    return trimmed(F.concat(parts[0], F.lit(" "), parts[1]))


def stage_group(stage: Column | str) -> Column:
    """won / lost / open; an unknown or missing stage is still live."""
    cleaned = clean_string(stage)
    return (
        F.when(cleaned == "Closed Won", "won")
        .when(cleaned == "Closed Lost", "lost")
        .otherwise("open")
    )


def row_hash(columns: list[str] | list[Column]) -> Column:
    """A short stand-in for a row: JSON keeps neighbours apart, whatever they
    hold, and writes a missing value unlike any text."""
    row = F.struct(*[_col(c).alias(f"c{i}") for i, c in enumerate(columns)])
    return F.sha2(F.to_json(row, {"ignoreNullFields": "false"}), 256)


def row_fingerprint(columns: list[str]) -> Column:
    """The cleaned row as one comparable value: two rows agree only if they
    agree on what is missing too."""
    return row_hash([clean_string(name) for name in columns])
