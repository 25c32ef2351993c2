"""The registered queries: the library's operators over the stand-in feeds."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import replace
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfscout.functions import cleaning, scoring
from shelfscout.operators import checks, latest
from shelfscout.operators.latest import latest_date
from shelfscout.plans import crm, market, quality, reports, staging, targets
from shelfscout.policy import TargetingPolicy
from shelfscout.session import materialise, shared_folder
from shelfscout.sources import nights, snapshots
from shelfscout.streaming import snapshot_stream
from testbed.feeds import POLICY, feed, write_exports

NO_LOSSES = replace(POLICY, exclude_closed_lost=True, premium_floor=0)
EQUAL_LOSSES = replace(POLICY, demote_closed_lost=False, premium_floor=150000)
AUDIT_TEXT = "M"

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


# Whole numbers that may be missing; some readers turn those into floats.
HOLLOW_COUNTS = ("premium_gin_bottles", "premium_gin_order_lines", "other_pure")


def plain(df: DataFrame) -> DataFrame:
    """Decimals and hollow counts as doubles, dates as text: any reader compares alike."""

    def shown(name: str, kind: str) -> Column:
        column = F.col(f"`{name}`")
        if kind.startswith("decimal") or name in HOLLOW_COUNTS:
            return column.cast("double").alias(name)
        if kind.startswith(("date", "timestamp")):
            return column.cast("string").alias(name)
        return column

    return df.select(*[shown(name, kind) for name, kind in df.dtypes])


class Bed:
    """The pipeline over one test folder; every stage is built when first asked for."""

    def __init__(self, spark: SparkSession, sf_dir: str, policy: TargetingPolicy = POLICY):
        self.spark, self.sf_dir, self.policy = spark, sf_dir, policy
        self.feeds: dict[str, DataFrame] = {}

    def raw(self, name: str) -> DataFrame:
        if name not in self.feeds:
            self.feeds[name] = feed(self.spark, self.sf_dir, name)
        return self.feeds[name]

    @cached_property
    def accounts_raw(self) -> DataFrame:
        return self.raw("accounts")

    @cached_property
    def opportunities_raw(self) -> DataFrame:
        return self.raw("opportunities")

    @cached_property
    def accounts(self) -> DataFrame:
        return staging.stage_accounts(self.accounts_raw)

    @cached_property
    def opportunities(self) -> DataFrame:
        return staging.stage_opportunities(self.opportunities_raw)

    @cached_property
    def contacts(self) -> DataFrame:
        return staging.stage_contacts(self.raw("contacts"))

    @cached_property
    def products(self) -> DataFrame:
        return staging.stage_products(self.raw("products"))

    @cached_property
    def rollup(self) -> DataFrame:
        return market.sales_rollup(self.raw("sales"), self.policy)

    @cached_property
    def market(self) -> DataFrame:
        return staging.stage_market(self.rollup)

    @cached_property
    def stores(self) -> DataFrame:
        return market.store_recent_sales(self.market, self.policy)

    @cached_property
    def current(self) -> DataFrame:
        as_of = latest_date(self.accounts_raw)
        return crm.accounts_current(self.accounts, self.opportunities, as_of)

    @cached_property
    def people(self) -> DataFrame:
        as_of = latest_date(self.raw("contacts"))
        return crm.primary_contact(self.contacts, self.policy, as_of)

    @cached_property
    def scored(self) -> DataFrame:
        return targets.scored_accounts(self.current, self.stores, self.people, self.policy)

    @cached_property
    def mart(self) -> DataFrame:
        return targets.target_accounts(self.current, self.stores, self.people, self.policy)

    @cached_property
    def trend(self) -> DataFrame:
        return reports.market_trend(self.market, self.policy)

    def written(self, *stages: str) -> Bed:
        """Write the named stages now; later ones then read the files."""
        for stage in stages:
            self.__dict__[stage] = materialise(getattr(self, stage), stage)
        return self


def query(build: Callable[[Bed], DataFrame]) -> Callable[[Bed], DataFrame]:
    REGISTRY[build.__name__] = lambda spark, sf_dir: plain(build(Bed(spark, sf_dir)))
    return build


# --- cleaning and staging ------------------------------------------------------


@query
def clean_string(bed: Bed) -> DataFrame:
    cleaned = cleaning.clean_string("account_name")
    return bed.accounts_raw.select(
        cleaning.clean_string("account_id").alias("account_id"),
        cleaned.alias("account_name"),
        F.length(cleaned).alias("name_length"),
        cleaning.clean_string("address").alias("address"),
        "snapshot_date",
    )


@query
def parse_money(bed: Bed) -> DataFrame:
    return bed.opportunities_raw.select(
        "opportunity_id", "snapshot_date", cleaning.parse_money("value_gbp").alias("value_gbp")
    )


@query
def parse_dates(bed: Bed) -> DataFrame:
    parsed = [
        staging.PARSERS[how](name).alias(name)
        for name, how in staging.DATE_FORMATS["opportunities"].items()
    ]
    return bed.opportunities_raw.select("opportunity_id", "snapshot_date", *parsed)


@query
def stage_accounts(bed: Bed) -> DataFrame:
    return bed.accounts


@query
def stage_contacts(bed: Bed) -> DataFrame:
    return bed.contacts


@query
def stage_opportunities(bed: Bed) -> DataFrame:
    return bed.opportunities


@query
def stage_products(bed: Bed) -> DataFrame:
    return bed.products


@query
def stage_market(bed: Bed) -> DataFrame:
    return bed.market


# --- ingest ----------------------------------------------------------------------


@query
def dedup_snapshots(bed: Bed) -> DataFrame:
    then = [F.col(c).asc() for c in ("status", "amount", "event_id")]
    grain = ["account_id", "snapshot_date"]
    return latest.latest_per_key(bed.raw("snapshots"), grain, "_loaded_at", then)


@query
def snapshot_name_parse(bed: Bed) -> DataFrame:
    """One export name per night and status; the errors carry a wrong extension."""
    ending = F.when(F.col("status") == "error", ".txt").otherwise(".csv")
    name = F.concat(
        F.lit("landing/crm_"), "status", F.lit("_"), F.col("snapshot_date").cast("string"), ending
    )
    names = bed.raw("snapshots").select(name.alias("uri")).distinct()
    return names.select("uri", snapshots.snapshot_date_of(F.col("uri")).alias("snapshot_date"))


@query
def ingest_gap(bed: Bed) -> DataFrame:
    """All nights against those that hold at least the average number of rows."""
    counts = snapshots.snapshot_counts(bed.raw("snapshots"))
    full = counts.where(F.col("row_count") >= counts.select(F.avg("row_count")).scalar())
    return snapshots.missing_snapshots(counts.select("snapshot_date"), full)


@query
def snapshot_counts(bed: Bed) -> DataFrame:
    return snapshots.snapshot_counts(bed.raw("snapshots"))


@query
def snapshot_inventory(bed: Bed) -> DataFrame:
    return snapshots.snapshot_inventory(bed.raw("snapshots"))


@query
def streamed_snapshot_counts(bed: Bed) -> DataFrame:
    """The events file taken in as a file stream, landed by night, then counted."""
    spark, landed = bed.spark, f"{shared_folder(bed.spark)}/streamed-{uuid.uuid4().hex}"
    stored = spark.read.parquet(f"{bed.sf_dir}/events.parquet")
    arriving = (
        spark.readStream.schema(stored.schema)
        .option("pathGlobFilter", "events.parquet")
        .parquet(bed.sf_dir)
        .withColumn("snapshot_date", F.col("ts").cast("date"))
    )
    snapshot_stream.run_available(arriving, f"{landed}/rows", f"{landed}/state")
    return snapshots.snapshot_counts(nights.read_nights(spark, f"{landed}/rows"))


@query
def streamed_exports(bed: Bed) -> DataFrame:
    """The accounts written as nightly exports, taken in as a stream of files, then looked at by night."""
    spark, root = bed.spark, f"{shared_folder(bed.spark)}/exports-{uuid.uuid4().hex}"
    columns = [c for c in bed.accounts_raw.columns if c not in snapshots.LINEAGE]
    write_exports(bed.accounts_raw.select(*columns, "snapshot_date"), f"{root}/landing", "accounts")
    arriving = snapshot_stream.snapshot_stream(spark, f"{root}/landing", "accounts", columns)
    snapshot_stream.run_available(arriving, f"{root}/rows", f"{root}/state")
    held = nights.read_nights(spark, f"{root}/rows")
    texts = F.concat_ws("|", *[F.coalesce(c, F.lit("")) for c in columns])
    return held.groupBy("snapshot_date").agg(
        F.count(F.lit(1)).alias("row_count"),
        F.count_distinct("account_id").alias("accounts"),
        F.sum(F.length(texts)).alias("characters"),
        F.max(F.regexp_extract("_source_file", "[^/]*$", 0)).alias("file_name"),
    )


# --- market ----------------------------------------------------------------------


@query
def category_classify(bed: Bed) -> DataFrame:
    return market.category_classify(bed.raw("sales"), bed.policy.categories)


@query
def category_audit(bed: Bed) -> DataFrame:
    return market.category_audit(bed.raw("sales"), bed.policy.categories, AUDIT_TEXT)


@query
def sales_rollup(bed: Bed) -> DataFrame:
    return bed.rollup


@query
def latest_attributes(bed: Bed) -> DataFrame:
    return latest.latest_attributes(
        bed.raw("sales"), ["store_number"], "date", market.STORE_ATTRIBUTES
    )


@query
def store_recent_sales(bed: Bed) -> DataFrame:
    return bed.stores


@query
def store_ratios(bed: Bed) -> DataFrame:
    return bed.stores.select(
        "store_number",
        "premium_share_of_gin",
        "gin_share_of_store",
        "premium_gin_dollars_per_bottle",
    )


# --- CRM -------------------------------------------------------------------------


@query
def opportunity_rollup(bed: Bed) -> DataFrame:
    as_of = latest_date(bed.opportunities_raw)
    return crm.opportunity_rollup(bed.opportunities.where(F.col("snapshot_date") == as_of))


@query
def accounts_current(bed: Bed) -> DataFrame:
    return bed.current


@query
def primary_contact(bed: Bed) -> DataFrame:
    return bed.people


@query
def late_feeds(bed: Bed) -> DataFrame:
    """As of the accounts' first night, for which contacts sent nothing."""
    first_night = bed.accounts_raw.select(F.min("snapshot_date")).scalar()
    return crm.late_feeds(
        first_night,
        accounts=bed.accounts_raw,
        opportunities=bed.opportunities_raw,
        contacts=bed.raw("contacts"),
    )


# --- targets -----------------------------------------------------------------------


@query
def match_flag(bed: Bed) -> DataFrame:
    return targets.match_market(bed.current, bed.stores).select(
        "account_id", "store_number", "has_market_match", "store_name", "city", "address"
    )


@query
def evidence_tier(bed: Bed) -> DataFrame:
    """Under the default policy and with both switches the other way."""
    matched = targets.match_market(bed.current, bed.stores)
    return matched.select(
        "account_id",
        scoring.evidence_tier(POLICY).alias("tier"),
        scoring.evidence_tier(NO_LOSSES).alias("tier_any_premium"),
        scoring.relationship_penalty(POLICY).alias("penalty"),
        scoring.relationship_penalty(EQUAL_LOSSES).alias("penalty_off"),
    )


@query
def tier_measure(bed: Bed) -> DataFrame:
    return bed.scored.select(
        "account_id", "evidence_tier", "evidence_tier_label", "tier_measure", "target_type"
    )


@query
def rank_rationale(bed: Bed) -> DataFrame:
    return bed.scored.select("account_id", scoring.rank_rationale(POLICY).alias("rank_rationale"))


@query
def target_rank(bed: Bed) -> DataFrame:
    return targets.rank(bed.scored, bed.policy).select("target_rank", "account_id")


@query
def target_mart(bed: Bed) -> DataFrame:
    return bed.mart


def _under(policy: TargetingPolicy) -> Query:
    def build(spark: SparkSession, sf_dir: str) -> DataFrame:
        return plain(Bed(spark, sf_dir, policy).mart)

    return build


REGISTRY["target_mart_without_losses"] = _under(NO_LOSSES)
REGISTRY["target_mart_equal_losses"] = _under(EQUAL_LOSSES)


@query
def top_targets(bed: Bed) -> DataFrame:
    return targets.top_targets(bed.scored, bed.policy).select(
        "account_id", "account_name", "evidence_tier", "tier_measure"
    )


@query
def call_sheet(bed: Bed) -> DataFrame:
    return reports.call_sheet(bed.mart)


# --- checks ------------------------------------------------------------------------


@query
def duplicates_agree(bed: Bed) -> DataFrame:
    return quality.duplicates_agree(bed.accounts_raw, "account_id", quality.ACCOUNT_FACTS)


@query
def parse_failures(bed: Bed) -> DataFrame:
    return quality.all_parse_failures(bed.accounts_raw, bed.opportunities_raw)


@query
def check_unique(bed: Bed) -> DataFrame:
    def repeated(df: DataFrame, column: str) -> DataFrame:
        value = F.col(column).cast("string").alias("value")
        return checks.unique(df, column).select(
            F.lit(column).alias("column_name"), value, "row_count"
        )

    events = repeated(bed.raw("snapshots"), "event_id")
    return events.unionByName(repeated(bed.opportunities_raw, "account_id"))


@query
def check_unique_combo(bed: Bed) -> DataFrame:
    return checks.unique_combination(bed.raw("snapshots"), ["account_id", "snapshot_date"])


@query
def check_not_null(bed: Bed) -> DataFrame:
    columns = ["account_id", "city", "store_number", "annual_target_gbp", "contract_start_date"]
    return checks.not_null(bed.accounts, columns)


@query
def check_accepted_values(bed: Bed) -> DataFrame:
    return checks.accepted_values(bed.accounts, "segment", bed.policy.segments)


@query
def check_range(bed: Bed) -> DataFrame:
    outside = checks.accepted_range(bed.stores, "premium_share_of_gin", low=0, high=1)
    return outside.select("store_number", "premium_share_of_gin")


@query
def check_relationships(bed: Bed) -> DataFrame:
    orphans = checks.relationships(bed.opportunities, "product_sku", bed.products, "sku_id")
    return orphans.select("opportunity_id", "snapshot_date", "product_sku")


@query
def check_universe(bed: Bed) -> DataFrame:
    """A list built with losses held against the policy that bars them."""
    return quality.excluded_in_targets(bed.mart, bed.current, NO_LOSSES)


@query
def check_demotion(bed: Bed) -> DataFrame:
    """Ranks given without the penalty, read with it."""
    other = Bed(bed.spark, bed.sf_dir, EQUAL_LOSSES)
    ranked = other.mart.withColumn("relationship_penalty", scoring.relationship_penalty(POLICY))
    return quality.demotion_breaches(ranked)


@query
def check_suite(bed: Bed) -> DataFrame:
    """All declared checks. Stages read by several checks are written once."""
    bed = bed.written(
        "accounts", "opportunities", "contacts", "market", "stores", "current", "people", "mart"
    )
    models = quality.Models(
        verdicts=materialise(
            quality.night_verdicts(bed.accounts_raw, "accounts").unionByName(
                quality.night_verdicts(bed.opportunities_raw, "opportunities")
            ),
            "verdicts",
        ),
        accounts=bed.accounts,
        opportunities=bed.opportunities,
        contacts=bed.contacts,
        products=bed.products,
        market=bed.market,
        accounts_current=bed.current,
        primary_contact=bed.people,
        store_recent_sales=bed.stores,
        mart=bed.mart,
    )
    return checks.run_suite(quality.declared_checks(models, bed.policy))


# --- reports -------------------------------------------------------------------------


@query
def category_price(bed: Bed) -> DataFrame:
    return reports.category_price(bed.market)


@query
def price_gap(bed: Bed) -> DataFrame:
    return reports.price_gap(bed.market, bed.policy)


@query
def market_trend(bed: Bed) -> DataFrame:
    return bed.trend


@query
def market_index(bed: Bed) -> DataFrame:
    return reports.market_index(bed.trend)


@query
def market_change(bed: Bed) -> DataFrame:
    years = bed.policy.trend_years
    return reports.market_change(bed.trend, years[0], years[-1])


@query
def overview(bed: Bed) -> DataFrame:
    return reports.overview(bed.mart)


@query
def tier_summary(bed: Bed) -> DataFrame:
    return reports.tier_summary(bed.mart)


@query
def concentration(bed: Bed) -> DataFrame:
    return reports.concentration(bed.mart)


@query
def owner_workload(bed: Bed) -> DataFrame:
    return reports.owner_workload(bed.mart)


@query
def segment_mix(bed: Bed) -> DataFrame:
    return reports.segment_mix(bed.mart)


@query
def match_coverage(bed: Bed) -> DataFrame:
    return reports.match_coverage(bed.mart)


@query
def unmatched_summary(bed: Bed) -> DataFrame:
    return reports.unmatched_summary(bed.mart)


@query
def previous_losses(bed: Bed) -> DataFrame:
    return reports.previous_losses(bed.mart)


@query
def loss_report(bed: Bed) -> DataFrame:
    return reports.loss_report(bed.mart)


@query
def volume_vs_fit(bed: Bed) -> DataFrame:
    """With a list long enough to reach tier 2 at every scale: all accounts."""
    return reports.volume_vs_fit(bed.mart.withColumn("is_top_target", F.lit(True)))
