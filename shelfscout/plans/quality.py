"""The declared checks over every model, and the invariants of the ranked list."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfscout.functions.cleaning import clean_string, parse_money, row_fingerprint
from shelfscout.operators.checks import ModelChecks
from shelfscout.plans.staging import DATE_FORMATS, MONEY_COLUMNS, PARSERS
from shelfscout.policy import TargetingPolicy

# Columns on which two listings of one account have to agree.
ACCOUNT_FACTS = [
    "account_name",
    "city",
    "address",
    "store_number",
    "segment",
    "account_owner",
    "contract_start_date",
    "annual_target_gbp",
    "last_activity_date",
    "created_date",
    "status",
]


def duplicates_agree(raw: DataFrame, key: str, facts: list[str]) -> DataFrame:
    """Keys listed more than once on a night with differing facts.

    Versions are grouped first, so identical copies of a hot key collapse before
    anything is counted; only a hash per row is shuffled, not the row.
    """
    versions = raw.groupBy(
        clean_string(key).alias(key), "snapshot_date", row_fingerprint(facts).alias("_facts")
    ).agg(F.count(F.lit(1)).alias("_copies"))
    return (
        versions.groupBy(key, "snapshot_date")
        .agg(
            F.sum("_copies").alias("duplicate_rows"),
            F.count(F.lit(1)).alias("distinct_versions"),
        )
        .where("distinct_versions > 1")
    )


def parse_failures(raw: DataFrame, feed: str) -> DataFrame:
    """One row per present value that parsed to nothing: dates and money of a feed
    in one scan. Money is held to no format (NULL).

    Filtering rows before they are laid out by column looks cheaper and measured
    slower: every value would be cleaned once for the filter and again after it.
    """
    formats = DATE_FORMATS[feed] | dict.fromkeys(MONEY_COLUMNS[feed])
    entries = [
        F.struct(
            F.lit(f"{feed}_snapshots").alias("source_table"),
            F.lit(name).alias("source_column"),
            F.lit(how).cast("string").alias("expected_format"),
            F.col(name).alias("unparseable_value"),
            (clean_string(name).isNotNull() & PARSERS.get(how, parse_money)(name).isNull()).alias("_failed"),
        )
        for name, how in formats.items()
    ]
    return raw.select("snapshot_date", F.inline(F.array(*entries))).where("_failed").drop("_failed")


def all_parse_failures(accounts_raw: DataFrame, opportunities_raw: DataFrame) -> DataFrame:
    return parse_failures(accounts_raw, "accounts").unionByName(
        parse_failures(opportunities_raw, "opportunities")
    )


def date_failures(failures: DataFrame) -> DataFrame:
    return failures.where("expected_format is not null")


def money_failures(failures: DataFrame) -> DataFrame:
    return failures.where("expected_format is null").drop("expected_format")


VERDICTS = "snapshot_date date, check_name string, violations long"


def night_verdicts(raw: DataFrame, feed: str) -> DataFrame:
    """``snapshot_date``, ``check_name``, ``violations``: what the raw checks of a feed
    find on each night; a check that finds nothing on a night has no row.

    Every raw check compares rows of one night only, so verdicts of nights that
    were checked at different times add up to those of the whole history.
    """
    failures = parse_failures(raw, feed).select(
        "snapshot_date", F.when(F.col("expected_format").isNull(), "money_parses").otherwise("dates_parse").alias("check_name")
    )
    if feed == "accounts":
        differing = duplicates_agree(raw, "account_id", ACCOUNT_FACTS)
        failures = failures.union(differing.select("snapshot_date", F.lit("duplicates_agree")))
    return failures.groupBy("snapshot_date", "check_name").agg(F.count(F.lit(1)).alias("violations"))


def excluded_in_targets(
    mart: DataFrame, accounts: DataFrame, policy: TargetingPolicy
) -> DataFrame:
    """Ranked accounts that the policy keeps out, asked of the CRM directly.

    Joined on the account, not on the store key that many accounts lack.
    """
    barred = accounts.where(F.col("crm_state").isin(*policy.excluded_states)).select(
        "account_id", "crm_state"
    )
    return mart.select("target_rank", "account_id", "account_name", "store_number").join(
        barred, "account_id"
    )


def demotion_breaches(mart: DataFrame) -> DataFrame:
    """Penalised accounts ranked ahead of a live one of their tier. Empty by
    construction when the penalty is switched off."""
    worst = (
        mart.where("relationship_penalty = 0")
        .groupBy("evidence_tier")
        .agg(F.max("target_rank").alias("worst_live_rank"))
    )
    lost = mart.where("relationship_penalty = 1").select(
        "account_id", "account_name", "evidence_tier", "target_rank"
    )
    # One row per tier, four at most.
    return lost.join(F.broadcast(worst), "evidence_tier").where("target_rank < worst_live_rank")


@dataclass
class Models:
    """Everything the suite looks at. Pass written tables: each is read by
    several checks and would otherwise be computed for each of them.

    ``verdicts`` are those of ``night_verdicts`` over all raw feeds and nights.
    """

    verdicts: DataFrame
    accounts: DataFrame
    opportunities: DataFrame
    contacts: DataFrame
    products: DataFrame
    market: DataFrame
    accounts_current: DataFrame
    primary_contact: DataFrame
    store_recent_sales: DataFrame
    mart: DataFrame


def declared_checks(m: Models, policy: TargetingPolicy) -> list[ModelChecks]:
    """The full list: 29 on staging, 13 on intermediate models, 18 on the mart
    and five invariants."""
    cats = policy.categories
    first_year = int(policy.sales_start[:4])

    def found(check: str) -> DataFrame:
        return m.verdicts.where(F.col("check_name") == check)

    return [
        ModelChecks("accounts", m.accounts)
        .unique_combination("account_id", "snapshot_date")
        .not_null("account_id", "snapshot_date")
        .accepted_values("status", policy.statuses)
        .accepted_values("segment", policy.segments)
        .accepted_range("annual_target_gbp", low=0),
        ModelChecks("opportunities", m.opportunities)
        .unique_combination("opportunity_id", "snapshot_date")
        .not_null("opportunity_id", "snapshot_date", "account_id")
        .relationships("account_id", m.accounts, "account_id")
        .relationships("product_sku", m.products, "sku_id")
        .accepted_values("stage", policy.stages)
        .accepted_values("stage_group", ("won", "lost", "open"))
        .accepted_range("value_gbp", low=0),
        ModelChecks("contacts", m.contacts)
        .unique_combination("contact_id", "snapshot_date")
        .not_null("contact_id", "snapshot_date", "account_id")
        .relationships("account_id", m.accounts, "account_id"),
        ModelChecks("products", m.products).unique("sku_id").not_null("sku_id", "list_price_gbp"),
        ModelChecks("market", m.market)
        .unique_combination("store_number", "year", "cat_group", "gin_category")
        .not_null("store_number", "cat_group")
        .accepted_values("cat_group", cats.groups)
        .accepted_values("gin_category", cats.details)
        .accepted_range("year", low=first_year),
        ModelChecks("accounts_current", m.accounts_current)
        .unique("account_id", "store_number")
        .not_null("account_id", "crm_state", "crm_as_of_date")
        .accepted_values("crm_state", ("closed_won", "open", "closed_lost", "no_opportunity")),
        ModelChecks("primary_contact", m.primary_contact)
        .unique("account_id")
        .not_null("account_id", "contact_name"),
        ModelChecks("store_recent_sales", m.store_recent_sales)
        .unique("store_number")
        .not_null("store_number", "premium_gin_dollars")
        .accepted_range("premium_share_of_gin", low=0, high=1),
        ModelChecks("target_accounts", m.mart)
        .unique("target_rank", "account_id", "store_number")
        .not_null("target_rank", "account_id", "has_market_match", "evidence_tier")
        .not_null("relationship_penalty", "tier_measure", "target_type")
        .not_null("rank_rationale", "is_top_target")
        .relationships("account_id", m.accounts_current, "account_id")
        .accepted_values("evidence_tier", (1, 2, 3, 4))
        .accepted_values("relationship_penalty", (0, 1))
        .accepted_range("tier_measure", low=0)
        .accepted_range("premium_gin_dollars", low=0)
        .accepted_values("target_type", ("known_prospect", "previous_loss", "no_opportunity")),
        ModelChecks("accounts_raw", m.verdicts).counts("duplicates_agree", found("duplicates_agree")),
        ModelChecks("raw_feeds", m.verdicts)
        .counts("dates_parse", found("dates_parse"))
        .counts("money_parses", found("money_parses")),
        ModelChecks("target_accounts", m.mart)
        .rows("no_excluded_state", excluded_in_targets(m.mart, m.accounts_current, policy))
        .rows("lost_demoted", demotion_breaches(m.mart)),
    ]
