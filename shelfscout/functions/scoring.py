"""The targeting rules as column expressions over the joined account row."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from shelfscout.functions.cleaning import normalise_key
from shelfscout.functions.display import fmt_int, fmt_plain_int
from shelfscout.policy import TargetingPolicy


def safe_ratio(a: Column | str, b: Column | str) -> Column:
    """Ratio as double, NULL on a zero or missing denominator."""
    top, bottom = (F.col(c) if isinstance(c, str) else c for c in (a, b))
    return F.try_divide(top.cast("double"), bottom.cast("double"))


def or_zero(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(0))


def account_state() -> Column:
    """By precedence: one win makes a customer, whatever else is in the pipeline."""
    return (
        F.when(F.col("has_won_opportunity"), "closed_won")
        .when(F.col("has_open_opportunity"), "open")
        .when(F.col("has_lost_opportunity"), "closed_lost")
        .otherwise("no_opportunity")
    )


def evidence_tier(policy: TargetingPolicy) -> Column:
    """1 premium demand at scale, 2 any demand, 3 matched only, 4 no match.

    Tier 1 also needs a positive amount, so that a floor of 0 means "any
    premium purchase" and does not lift every matched account.
    """
    premium = or_zero("premium_gin_dollars")
    return (
        F.when(~F.col("has_market_match"), 4)
        .when((premium >= policy.premium_floor) & (premium > 0), 1)
        .when(or_zero("total_gin_dollars") > 0, 2)
        .otherwise(3)
    )


def relationship_penalty(policy: TargetingPolicy) -> Column:
    if not policy.demote_closed_lost:
        return F.lit(0)
    return F.when(F.col("crm_state") == "closed_lost", 1).otherwise(0)


def target_type() -> Column:
    state = F.col("crm_state")
    return (
        F.when(state == "open", "known_prospect")
        .when(state == "closed_lost", "previous_loss")
        .otherwise(state)
    )


def tier_measure() -> Column:
    """Dollars that order accounts inside their tier; never compared across tiers."""
    tier = F.col("evidence_tier")
    return (
        F.when(tier == 1, or_zero("premium_gin_dollars"))
        .when(tier == 2, or_zero("total_gin_dollars"))
        .when(tier == 3, or_zero("total_dollars"))
        .otherwise(F.lit(0))
    )


def tier_label(policy: TargetingPolicy) -> Column:
    """One label per tier, with the floor filled in."""
    # The wording of the labels.
    labels = {
        1: f"buys premium gin at scale (>= ${policy.premium_floor})",
        2: f"gin demand, below the ${policy.premium_floor} premium-gin floor",
        3: "no gin traction",
    }
    tier = F.col("evidence_tier")
    label = F.lit("no market match -- CRM evidence only")
    for number, text in labels.items():
        label = F.when(tier == number, text).otherwise(label)
    return label


def _dollars(name: str) -> Column:
    return F.concat(F.lit("$"), fmt_int(or_zero(name)))


def _evidence_text(policy: TargetingPolicy) -> Column:
    # The wording of the evidence sentence.
    at_scale = F.concat(
        _dollars("premium_gin_dollars"),
        F.lit(" premium gin over "),
        or_zero("premium_gin_order_lines").cast("string"),
        F.lit(" orders, "),
        fmt_plain_int(F.coalesce(F.col("premium_share_of_gin"), F.lit(0.0)) * 100),
        F.lit("% of its gin spend"),
    )
    some_premium = F.concat(
        F.lit("but only "),
        _dollars("premium_gin_dollars"),
        F.lit(f" of it premium tier -- below the ${policy.premium_floor} floor"),
    )
    below_floor = F.concat(
        _dollars("total_gin_dollars"),
        F.lit(" gin spend, "),
        F.when(or_zero("premium_gin_dollars") > 0, some_premium).otherwise(
            F.lit("none of it premium tier -- switch target")
        ),
    )
    size_only = F.concat(
        _dollars("total_dollars"),
        F.lit(" total liquor spend, no gin purchases in the window"),
    )
    unmatched = F.concat(
        F.lit("no Iowa store matched"),
        F.when(F.col("store_number").isNull(), " (no store_number on the account)").otherwise(
            F.concat(
                F.lit(" (store_number "), F.col("store_number"), F.lit(" not in the market data)")
            )
        ),
    )
    tier = F.col("evidence_tier")
    return (
        F.when(tier == 1, at_scale)
        .when(tier == 2, below_floor)
        .when(tier == 3, size_only)
        .otherwise(unmatched)
    )


def _relationship_text() -> Column:
    # The wording of the relationship sentence.
    owner = F.coalesce(F.col("account_owner"), F.lit("unassigned"))
    kind = F.col("target_type")
    return (
        F.when(
            kind == "known_prospect",
            F.concat(
                F.lit("open prospect, owned by "),
                owner,
                F.lit(", GBP "),
                fmt_int(or_zero("open_pipeline_gbp")),
                F.lit(" open pipeline"),
            ),
        )
        .when(
            kind == "previous_loss",
            F.concat(F.lit("PREVIOUSLY LOST -- demoted within tier; owned by "), owner),
        )
        .otherwise(F.coalesce(kind, F.lit("unknown")))
    )


def rank_rationale(policy: TargetingPolicy) -> Column:
    """Why the account ranks where it does, in three parts, none of them ever NULL."""
    return F.concat_ws(
        "; ",
        F.concat(
            F.lit("Tier "),
            F.col("evidence_tier").cast("string"),
            F.lit(" -- "),
            F.col("evidence_tier_label"),
        ),
        _evidence_text(policy),
        _relationship_text(),
    )


def match_state() -> Column:
    """Why an account has, or lacks, market data."""
    # The three labels.
    return (
        F.when(F.col("has_market_match"), "Matched to an Iowa store")
        .when(normalise_key("store_number").isNull(), "No store_number on the account")
        .otherwise("store_number not found in market data")
    )
