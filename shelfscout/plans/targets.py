"""The ranked list: every approachable account, scored by what the market shows.

The CRM defines the universe and stays on the left of every join; market data
only scores it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfscout.functions.scoring import (
    evidence_tier,
    or_zero,
    rank_rationale,
    relationship_penalty,
    target_type,
    tier_label,
    tier_measure,
)
from shelfscout.operators.joins import left_join_hollow_key
from shelfscout.operators.ranking import number_rows
from shelfscout.policy import TargetingPolicy

# The output schema.
MARKET_MEASURES = [
    "premium_gin_dollars",
    "other_gin_dollars",
    "total_gin_dollars",
    "non_gin_dollars",
    "total_dollars",
    "premium_gin_bottles",
    "premium_gin_order_lines",
    "premium_share_of_gin",
    "gin_share_of_store",
    "premium_gin_dollars_per_bottle",
    "last_premium_gin_purchase_date",
    "last_purchase_date",
]
CONTACT_COLUMNS = [
    "contact_name",
    "contact_title",
    "contact_email",
    "contact_phone",
    "contact_linkedin_url",
]
TARGET_COLUMNS = [
    "target_rank",
    "is_top_target",
    "account_id",
    "account_name",
    "target_type",
    "evidence_tier",
    "evidence_tier_label",
    "relationship_penalty",
    "crm_status",
    "crm_segment",
    "crm_state",
    "account_owner",
    "open_pipeline_gbp",
    "annual_target_gbp",
    "opportunity_count",
    "crm_last_activity_date",
    "crm_as_of_date",
    *CONTACT_COLUMNS,
    "has_market_match",
    "store_number",
    "store_name",
    "city",
    "county",
    "address",
    "tier_measure",
    *MARKET_MEASURES,
    "rank_rationale",
]


def eligible(accounts: DataFrame, policy: TargetingPolicy) -> DataFrame:
    """The universe. The state is never NULL, so nothing is lost by accident."""
    return accounts.where(~F.col("crm_state").isin(*policy.excluded_states))


def match_market(accounts: DataFrame, market: DataFrame) -> DataFrame:
    """Accounts with their store, where there is one. Market measures stay NULL
    without a match: no data is not the same as no purchases."""
    sides = ["city", "address"]
    stores = market.withColumnsRenamed({c: f"_store_{c}" for c in sides}).withColumn(
        "_matched", F.lit(True)
    )
    joined = left_join_hollow_key(accounts, stores, "store_number", spread_by="account_id")
    return (
        joined.withColumns({c: F.coalesce(c, f"_store_{c}") for c in sides})
        .withColumn("has_market_match", F.col("_matched").isNotNull())
        .drop("_matched", *[f"_store_{c}" for c in sides])
    )


def score(joined: DataFrame, policy: TargetingPolicy) -> DataFrame:
    """Tier, penalty, type, measure and label; no row moves."""
    return (
        joined.withColumns(
            {
                "evidence_tier": evidence_tier(policy),
                "relationship_penalty": relationship_penalty(policy),
                "target_type": target_type(),
            }
        )
        .withColumns({"tier_measure": tier_measure(), "evidence_tier_label": tier_label(policy)})
    )


def rank(scored: DataFrame, policy: TargetingPolicy) -> DataFrame:
    """Best evidence first, previous losses last in their tier, then dollars,
    pipeline and the account id, which makes the order reproducible."""
    order = [
        F.col("evidence_tier").asc(),
        F.col("relationship_penalty").asc(),
        F.col("tier_measure").desc(),
        or_zero("open_pipeline_gbp").desc(),
        F.col("account_id").asc(),
    ]
    ranked = number_rows(scored, order, "target_rank", "targets")
    return ranked.withColumn("is_top_target", F.col("target_rank") <= policy.list_size)


def scored_accounts(
    accounts: DataFrame, market: DataFrame, contacts: DataFrame, policy: TargetingPolicy
) -> DataFrame:
    """Everything but the rank. Contacts join first: accounts that come straight
    from the opportunity join are still laid out by account, so this one needs no
    shuffle of them. Accounts read back from files are shuffled once more."""
    universe = eligible(accounts, policy).withColumnsRenamed(
        {
            "segment": "crm_segment",
            "status": "crm_status",
            "last_activity_date": "crm_last_activity_date",
        }
    )
    people = contacts.select("account_id", *CONTACT_COLUMNS)
    reachable = universe.join(people, "account_id", "left")
    return score(match_market(reachable, market), policy)


def target_accounts(
    accounts: DataFrame, market: DataFrame, contacts: DataFrame, policy: TargetingPolicy
) -> DataFrame:
    """The mart: one row per eligible account. All rows are kept and the top of
    the list is only flagged, so "who is next?" needs no rebuild."""
    ranked = rank(scored_accounts(accounts, market, contacts, policy), policy)
    return ranked.withColumn("rank_rationale", rank_rationale(policy)).select(*TARGET_COLUMNS)


def top_targets(scored: DataFrame, policy: TargetingPolicy) -> DataFrame:
    """Only the list itself, when nobody asks for the rest: a top-N, no full sort."""
    return scored.orderBy(
        F.col("evidence_tier"),
        F.col("relationship_penalty"),
        F.col("tier_measure").desc(),
        or_zero("open_pipeline_gbp").desc(),
        F.col("account_id"),
    ).limit(policy.list_size)
