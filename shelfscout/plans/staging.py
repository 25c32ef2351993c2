"""Raw feeds to typed rows. Clean and type only: no joins, and all nights stay."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfscout.functions.cleaning import (
    clean_string,
    full_name,
    normalise_key,
    parse_dmy,
    parse_iso,
    parse_money,
    stage_group,
    trimmed,
)
from shelfscout.operators.latest import latest_per_key

LINEAGE_COLUMNS = ["snapshot_date", "_source_file", "_loaded_at"]
ROW_HASH = "_row_hash"

ACCOUNT_TEXT = [
    "account_id",
    "account_name",
    "city",
    "address",
    "store_number",
    "segment",
    "account_owner",
    "status",
]
CONTACT_TEXT = ["contact_id", "account_id", "first_name", "last_name", "title"]
OPPORTUNITY_TEXT = ["opportunity_id", "account_id", "product_sku", "stage", "owner"]
PRODUCT_TEXT = ["sku_id", "product_name", "company", "variant", "category"]
PRODUCT_TYPED = ["bottle_size_cl", "abv_pct", "list_price_gbp", "pack_size", "launch_date"]

# Date columns of each raw feed with the one format they are held to.
DATE_FORMATS = {
    "accounts": {"contract_start_date": "uk", "last_activity_date": "iso", "created_date": "iso"},
    "opportunities": {
        "expected_close_date": "uk",
        "closed_date": "uk",
        "last_activity_date": "iso",
        "created_date": "iso",
    },
}
MONEY_COLUMNS = {"accounts": ["annual_target_gbp"], "opportunities": ["value_gbp"]}

PARSERS = {"uk": parse_dmy, "iso": parse_iso}


def _text(names: list[str]) -> list[Column]:
    return [clean_string(name).alias(name) for name in names]


def _dates(feed: str) -> list[Column]:
    return [PARSERS[how](name).alias(name) for name, how in DATE_FORMATS[feed].items()]


def _money(feed: str) -> list[Column]:
    return [parse_money(name).alias(name) for name in MONEY_COLUMNS[feed]]


def one_per_night(raw: DataFrame, key: str) -> DataFrame:
    """One raw row per cleaned key and night: the last loaded.

    Runs before anything is parsed. Ties are settled by the row hash the load has
    stored, so the scan and the shuffle carry only columns a later step reads; a
    feed without one is ordered by all its columns, by name.
    """
    texts = sorted(c for c in raw.columns if c not in ("snapshot_date", "_loaded_at"))
    tie = [F.col(c) for c in ([ROW_HASH] if ROW_HASH in raw.columns else texts)]
    keyed = raw.withColumn("_key", clean_string(key))
    return latest_per_key(keyed, ["_key", "snapshot_date"], "_loaded_at", tie).drop("_key")


def stage_accounts(raw: DataFrame) -> DataFrame:
    """One row per account and night. Some accounts are listed twice every night."""
    return one_per_night(raw, "account_id").select(
        *_text(ACCOUNT_TEXT), *_dates("accounts"), *_money("accounts"), *LINEAGE_COLUMNS
    )


def stage_contacts(raw: DataFrame) -> DataFrame:
    """One row per contact and night. E-mail is lower-cased for matching; names keep their case."""
    return one_per_night(raw, "contact_id").select(
        *_text(CONTACT_TEXT),
        F.lower(clean_string("email")).alias("email"),
        *_text(["phone", "linkedin_url"]),
        full_name("first_name", "last_name").alias("full_name"),
        *LINEAGE_COLUMNS,
    )


def stage_opportunities(raw: DataFrame) -> DataFrame:
    """One row per opportunity and night, with the stage collapsed to won, lost or open."""
    return one_per_night(raw, "opportunity_id").select(
        *_text(OPPORTUNITY_TEXT),
        clean_string("type").alias("opportunity_type"),
        *_dates("opportunities"),
        *_money("opportunities"),
        stage_group("stage").alias("stage_group"),
        *LINEAGE_COLUMNS,
    )


STAGERS = {
    "accounts": stage_accounts,
    "contacts": stage_contacts,
    "opportunities": stage_opportunities,
}


def stage_products(raw: DataFrame) -> DataFrame:
    """The catalogue arrives typed; its texts are only trimmed."""
    return raw.select(*[trimmed(c).alias(c) for c in PRODUCT_TEXT], *PRODUCT_TYPED)


def stage_market(rollup: DataFrame, normalised: bool = False) -> DataFrame:
    """The sales rollup with a join key comparable to the CRM's.

    A table that was laid out by the ``normalised`` key keeps its column as it
    is: only then can Spark use the layout.
    """
    attributes = ["store_name", "address", "city", "county"]
    rest = [c for c in rollup.columns if c not in ("store_number", *attributes)]
    key = F.col("store_number") if normalised else normalise_key("store_number").alias("store_number")
    return rollup.select(
        key,
        *[trimmed(c).alias(c) for c in attributes],
        *rest,
    )
