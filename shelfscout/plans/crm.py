"""The CRM as of its latest night."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfscout.functions.scoring import account_state
from shelfscout.operators.latest import first_per_key, latest_date
from shelfscout.policy import TargetingPolicy


def opportunity_rollup(opportunities: DataFrame) -> DataFrame:
    """One row per account, so the join to accounts cannot fan out."""
    group = F.col("stage_group")
    return opportunities.groupBy("account_id").agg(
        F.count(F.lit(1)).alias("opportunity_count"),
        F.bool_or(group == "won").alias("has_won_opportunity"),
        F.bool_or(group == "open").alias("has_open_opportunity"),
        F.bool_or(group == "lost").alias("has_lost_opportunity"),
        F.sum(F.when(group == "open", F.col("value_gbp")).otherwise(F.lit(0))).alias(
            "open_pipeline_gbp"
        ),
        F.max("last_activity_date").alias("last_opportunity_activity_date"),
    )


def accounts_current(
    accounts: DataFrame, opportunities: DataFrame, as_of: Column | None = None
) -> DataFrame:
    """One row per account with its state; both feeds as of the same night.

    ``as_of`` defaults to the newest night of the accounts. Pass the newest night
    of the raw feed where you have it: that scan reads one column, while the
    staged feed would be deduplicated first. The filter reaches the raw scan
    through the deduplication, because the night is part of its key.
    """
    as_of = latest_date(accounts) if as_of is None else as_of
    tonight = accounts.where(F.col("snapshot_date") == as_of)
    rolled = opportunity_rollup(opportunities.where(F.col("snapshot_date") == as_of))
    joined = tonight.join(rolled, "account_id", "left")
    flags = ["has_won_opportunity", "has_open_opportunity", "has_lost_opportunity"]
    filled = joined.withColumns(
        {
            "opportunity_count": F.coalesce("opportunity_count", F.lit(0)),
            **{flag: F.coalesce(flag, F.lit(False)) for flag in flags},
        }
    )
    return filled.select(
        "account_id",
        "account_name",
        "store_number",
        "city",
        "address",
        "segment",
        "account_owner",
        "status",
        "annual_target_gbp",
        "contract_start_date",
        "last_activity_date",
        F.col("snapshot_date").alias("crm_as_of_date"),
        "opportunity_count",
        *flags,
        # NULL, not 0, for an account without opportunities.
        "open_pipeline_gbp",
        "last_opportunity_activity_date",
        account_state().alias("crm_state"),
    )


def primary_contact(
    contacts: DataFrame, policy: TargetingPolicy, as_of: Column | None = None
) -> DataFrame:
    """The one person to call per account: best title, then lowest id.

    Uses the contacts' own newest night unless told otherwise, so a late contact
    feed still names someone.
    """
    as_of = latest_date(contacts) if as_of is None else as_of
    titles = F.array(*[F.lit(t) for t in policy.title_precedence])
    place = F.array_position(titles, F.col("title"))
    unranked = F.lit(len(policy.title_precedence) + 1)
    precedence = F.coalesce(F.when(place > 0, place), unranked)
    best = first_per_key(
        contacts.where(F.col("snapshot_date") == as_of),
        ["account_id"],
        [precedence.asc(), F.col("contact_id").asc()],
    )
    return best.select(
        "account_id",
        "contact_id",
        F.col("full_name").alias("contact_name"),
        F.col("title").alias("contact_title"),
        F.col("email").alias("contact_email"),
        F.col("phone").alias("contact_phone"),
        F.col("linkedin_url").alias("contact_linkedin_url"),
    )


def late_feeds(as_of: Column, **feeds: DataFrame) -> DataFrame:
    """Feeds without a row on the night in use. Without this, a late opportunity
    feed would quietly turn every account into one without opportunities."""
    parts = [
        feed.where(F.col("snapshot_date") == as_of)
        .agg(F.count(F.lit(1)).alias("row_count"))
        .select(F.lit(name).alias("feed"), "row_count")
        for name, feed in feeds.items()
    ]
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result.where("row_count = 0").select("feed")
