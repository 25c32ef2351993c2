"""Reports on the market rollup and on the finished mart. All are report-sized
results of one grouping each; only formatting happens after it.

Fixed values throughout: the names and order of report columns, as their readers know them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfscout.functions.display import fmt_currency, fmt_share, title_case
from shelfscout.functions.scoring import match_state, safe_ratio
from shelfscout.policy import TargetingPolicy



def _accounts() -> Column:
    return F.count(F.lit(1)).alias("accounts")


# --- market ------------------------------------------------------------------


def category_price(market: DataFrame) -> DataFrame:
    """Dollars per unit of every listed category, cheapest first."""
    sums = (
        market.where(F.col("gin_category").isNotNull())
        .groupBy("gin_category")
        .agg(
            F.max("cat_group").alias("cat_group"),
            F.sum("net_sale_dollars").alias("dollars"),
            F.sum("net_bottles").alias("bottles"),
        )
    )
    priced = sums.withColumn("usd_per_bottle", safe_ratio("dollars", "bottles"))
    return priced.orderBy("usd_per_bottle", "gin_category")


def price_gap(market: DataFrame, policy: TargetingPolicy) -> DataFrame:
    """Weighted price of both listed groups and how far apart they are."""
    cats = policy.categories

    def price(group: str) -> Column:
        inside = F.col("cat_group") == group
        return safe_ratio(
            F.sum(F.when(inside, F.col("net_sale_dollars"))),
            F.sum(F.when(inside, F.col("net_bottles"))),
        )

    prices = market.agg(
        price(cats.premium_group).alias("premium_price"), price(cats.other_group).alias("other_price")
    )
    return prices.withColumn("price_ratio", safe_ratio("premium_price", "other_price"))


def market_trend(
    market: DataFrame, policy: TargetingPolicy, approximate: bool = False
) -> DataFrame:
    """Dollars and stocking stores per complete year and listed group."""
    stores = F.approx_count_distinct if approximate else F.count_distinct
    listed = F.col("cat_group") != policy.categories.outside_group
    return (
        market.where(listed & F.col("year").isin(*policy.trend_years))
        .groupBy("year", "cat_group")
        .agg(F.sum("net_sale_dollars").alias("dollars"), stores("store_number").alias("stores"))
        .orderBy("year", "cat_group")
    )


def _per_store(trend: DataFrame) -> DataFrame:
    return trend.withColumn("per_store", safe_ratio("dollars", "stores"))


def market_index(trend: DataFrame) -> DataFrame:
    """Dollars, stores and spend per store with each group's first year as 100."""
    by_year = Window.partitionBy("cat_group").orderBy("year")
    indexed = [
        (safe_ratio(F.col(c), F.first(c).over(by_year)) * 100).alias(f"{c}_index")
        for c in ("dollars", "stores", "per_store")
    ]
    return _per_store(trend).select("year", "cat_group", *indexed)


def market_change(trend: DataFrame, first_year: int, last_year: int) -> DataFrame:
    """Percent change of each measure between two named years, per group."""

    def at(measure: str, year: int) -> Column:
        return F.max(F.when(F.col("year") == year, F.col(measure)))

    measures = ("dollars", "stores", "per_store")
    ends = _per_store(trend).groupBy("cat_group").agg(
        *[at(m, first_year).alias(f"{m}_first") for m in measures],
        *[at(m, last_year).alias(f"{m}_last") for m in measures],
    )
    changes = [
        ((safe_ratio(f"{m}_last", f"{m}_first") - 1) * 100).alias(f"{m}_change_pct")
        for m in measures
    ]
    return ends.select("*", *changes)


# --- the list ----------------------------------------------------------------


def on_list() -> Column:
    return F.col("is_top_target")


def overview(mart: DataFrame) -> DataFrame:
    """How many accounts are ranked, and as of which night."""
    return mart.agg(_accounts(), F.max("crm_as_of_date").alias("as_of"))


def call_sheet(mart: DataFrame) -> DataFrame:
    """The list as a rep reads it."""
    # The headings and their order.
    return (
        mart.where(on_list())
        .orderBy("target_rank")
        .select(
            F.col("target_rank").alias("#"),
            F.col("evidence_tier").alias("T"),
            F.substring("account_name", 1, 32).alias("Account"),
            title_case(F.col("city")).alias("City"),
            fmt_currency(F.col("tier_measure"), "$").alias("Gin $"),
            fmt_share(F.col("premium_share_of_gin")).alias("prem %"),
            F.col("crm_segment").alias("Store Segment"),
            F.col("account_owner").alias("Owner"),
            F.col("contact_name").alias("Contact"),
            fmt_currency(F.col("open_pipeline_gbp"), "£").alias("Pipeline"),
        )
    )


def tier_summary(mart: DataFrame) -> DataFrame:
    """Accounts per tier and how many of them made the list."""
    return (
        mart.groupBy("evidence_tier", "evidence_tier_label")
        .agg(_accounts(), F.count_if(on_list()).alias("in_top"))
        .orderBy(F.col("evidence_tier").desc())
    )


def concentration(mart: DataFrame) -> DataFrame:
    """How much of all premium evidence the list holds."""
    premium = F.coalesce("premium_gin_dollars", F.lit(0))
    sums = mart.agg(
        _accounts(),
        F.count_if("has_market_match").alias("matched"),
        F.sum(F.when(on_list(), premium).otherwise(F.lit(0))).alias("premium_in_top"),
        F.sum(premium).alias("premium_all"),
    )
    share = safe_ratio("premium_in_top", "premium_all") * 100
    return sums.withColumn("top_share_pct", share)


def owner_workload(mart: DataFrame) -> DataFrame:
    """The list per owner; accounts without one are left out."""
    return (
        mart.where(on_list() & F.col("account_owner").isNotNull())
        .groupBy("account_owner")
        .agg(
            _accounts(),
            F.coalesce(F.sum("open_pipeline_gbp"), F.lit(0)).alias("pipeline"),
            F.count_if(F.col("evidence_tier") == 1).alias("tier1"),
        )
        .withColumn("pipeline_text", fmt_currency(F.col("pipeline"), "£"))
        .orderBy(F.col("accounts").desc(), "account_owner")
    )


def segment_mix(mart: DataFrame) -> DataFrame:
    """The list per segment."""
    return (
        mart.where(on_list() & F.col("crm_segment").isNotNull())
        .groupBy("crm_segment")
        .agg(_accounts())
        .orderBy(F.col("accounts").desc(), "crm_segment")
    )


# --- losses, trade-offs, coverage ---------------------------------------------


def previous_losses(mart: DataFrame) -> DataFrame:
    """Lost accounts that stay in the universe, best first."""
    return (
        mart.where(F.col("target_type") == "previous_loss")
        .orderBy("target_rank")
        .select(
            "target_rank",
            "evidence_tier",
            F.substring("account_name", 1, 36).alias("account_name"),
            fmt_currency(F.col("tier_measure"), "$").alias("measure"),
        )
    )


def loss_report(mart: DataFrame) -> DataFrame:
    """How many there are, how many reach the list, and the best rank among them."""
    return mart.where(F.col("target_type") == "previous_loss").agg(
        F.count(F.lit(1)).alias("lost_accounts"),
        F.count_if(on_list()).alias("in_top"),
        F.min("target_rank").alias("best_rank"),
    )


def _short_name() -> Column:
    name = F.substring(F.split_part("account_name", F.lit(" - "), F.lit(1)), 1, 22)
    return F.concat(F.lit("#"), F.col("target_rank").cast("string"), F.lit(" "), name)


def volume_vs_fit(mart: DataFrame, labelled: int = 3, pure_pct: float = 99.0) -> DataFrame:
    """Tier 2 of the list: volume against share of premium.

    Names the few largest by volume, and among the pure-premium accounts the
    leader with a count of the others.
    """
    tier2 = mart.where(on_list() & (F.col("evidence_tier") == 2)).select(
        "target_rank",
        _short_name().alias("short_name"),
        F.col("tier_measure").alias("volume"),
        (F.coalesce("premium_share_of_gin", F.lit(0.0)) * 100).alias("prem_pct"),
    )
    by_volume = [F.col("volume").desc(), F.col("target_rank").asc()]
    pure = F.col("prem_pct") >= pure_pct
    largest = tier2.orderBy(*by_volume).limit(labelled).select(
        "target_rank", F.lit(True).alias("_largest")
    )
    leader = tier2.where(pure).orderBy(*by_volume).limit(1).select(
        "target_rank", F.lit(True).alias("_leads")
    )
    others = tier2.where(pure).agg(F.count(F.lit(1)) - 1).scalar()
    return (
        tier2.join(largest, "target_rank", "left")
        .join(leader, "target_rank", "left")
        .select(
            "target_rank",
            "short_name",
            "volume",
            "prem_pct",
            F.col("_largest").isNotNull().alias("is_largest"),
            F.col("_leads").isNotNull().alias("leads_pure"),
            F.when(F.col("_leads"), others).alias("other_pure"),
        )
        .orderBy(*by_volume)
    )


def match_coverage(mart: DataFrame) -> DataFrame:
    """Accounts, list places and pipeline by whether and why data is missing."""
    return (
        mart.groupBy(match_state().alias("match_state"))
        .agg(
            _accounts(),
            F.count_if(on_list()).alias("in_top"),
            F.coalesce(F.sum("open_pipeline_gbp"), F.lit(0)).alias("pipeline_gbp"),
        )
        .withColumn("pipeline_text", fmt_currency(F.col("pipeline_gbp"), "£"))
        .orderBy(F.col("accounts").desc(), "match_state")
    )


def unmatched_summary(mart: DataFrame) -> DataFrame:
    """What the market data cannot see."""
    unmatched = ~F.col("has_market_match")
    sums = mart.agg(
        F.count_if(unmatched).alias("unmatched"),
        _accounts(),
        F.coalesce(F.sum(F.when(unmatched, F.col("open_pipeline_gbp"))), F.lit(0)).alias(
            "unmatched_pipeline_gbp"
        ),
    )
    return sums.withColumn("unmatched_pct", safe_ratio("unmatched", "accounts") * 100)
