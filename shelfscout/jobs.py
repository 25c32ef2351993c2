"""The three jobs, each safe to run again.

    python -m shelfscout.jobs sync    LANDING RAW [--feed F] [--catalogue FILE] [--multi-line]
    python -m shelfscout.jobs market  SALES TABLE [--force] [--estimate] [--buckets N] [--state FOLDER]
    python -m shelfscout.jobs targets RAW MARKET_TABLE CATALOGUE_TABLE TABLE [--restage]
    python -m shelfscout.jobs sweep   RAW

or the same arguments after ``spark-submit .../jobs.py``. ``market`` and ``targets``
take the policy as ``--policy FILE`` (a JSON object of fields) and ``--set
FIELD=JSON``, as often as needed. The session comes from the environment; set
``spark.checkpoint.dir`` to a folder all executors share.
"""

from __future__ import annotations

import argparse
import datetime as dt
import json
from collections.abc import Callable
from functools import partial, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfscout.functions.cleaning import normalise_key
from shelfscout.operators.checks import run_suite
from shelfscout.operators.latest import latest_date
from shelfscout.plans import crm, market, quality, staging, targets
from shelfscout.policy import SCAN_CEILING_BYTES, TargetingPolicy
from shelfscout.session import materialise, remove_folder, scratch
from shelfscout.sources import increments, nights, snapshots, tables

CATALOGUE_TABLE = "product_catalogue"
# Property of the market table: the loads of its state that it was folded from.
LOADS = "shelfscout.loads"


def sync_crm(
    spark: SparkSession,
    landing: str,
    raw: str,
    feeds: tuple[str, ...] = snapshots.FEEDS,
    catalogue: str | None = None,
    multi_line: bool = False,
) -> dict[str, int]:
    """Load the missing nights of every feed; replace the catalogue if one is given."""
    loaded = {
        feed: snapshots.sync_feed(spark, landing, feed, f"{raw}/{feed}_snapshots", multi_line)
        for feed in feeds
    }
    if catalogue:
        tables.replace_table(spark, catalogue, CATALOGUE_TABLE)
    return loaded


def scan_ceiling(spark: SparkSession, policy: TargetingPolicy) -> int:
    if policy.scan_ceiling_bytes is not None:
        return policy.scan_ceiling_bytes
    if spark.sparkContext.master.startswith("local"):
        return SCAN_CEILING_BYTES
    raise ValueError("set scan_ceiling_bytes in the policy (0: no ceiling)")


def market_bytes(spark: SparkSession, files: DataFrame, policy: TargetingPolicy) -> int:
    """Bytes the rollup reads of a listing of sales files: its columns, from ``sales_start`` on."""
    since = ("date", dt.date.fromisoformat(policy.sales_start))
    return tables.column_bytes(spark, files, market.SALES_COLUMNS, since)


def build_market(
    spark: SparkSession,
    sales: str,
    table: str,
    policy: TargetingPolicy,
    force: bool = False,
    buckets: int = tables.BUCKETS,
    state: str | None = None,
) -> bool:
    """Roll the sales up, behind the scan ceiling; nothing else reads them. True if
    the table was written.

    The table is laid out by the key in the form the CRM uses, so what groups by
    store later needs no shuffle. Without a ``state`` folder it is built once.
    With one the folder keeps what was made of every sales file, and each run
    reads only files that are new: the table is what all of them fold into.
    ``force`` starts over.
    """
    ceiling = scan_ceiling(spark, policy)

    def laid_out(rollup: DataFrame) -> DataFrame:
        return rollup.withColumn("store_number", normalise_key("store_number"))

    if state is None:
        tables.check_budget(market_bytes(spark, increments.list_files(spark, sales), policy), ceiling, sales)
        whole = lambda: laid_out(market.sales_rollup(spark.read.parquet(sales), policy))
        return tables.build_table(spark, whole, table, force, key="store_number", buckets=buckets)
    if force:
        remove_folder(spark, state)
    made_by = policy.market_choices()
    new = increments.pending_files(spark, sales, state, made_by)
    tables.check_budget(market_bytes(spark, new, policy), ceiling, sales)
    increments.take_in(spark, sales, state, made_by, partial(market.sales_partials, policy=policy))
    held = ",".join(increments.loads_of(spark, state, made_by))
    if not held or tables.marked(spark, table, LOADS) == held:
        return False
    folded = laid_out(market.fold_partials(increments.read_state(spark, state, made_by)))
    tables.write_clustered(folded, table, "store_number", buckets)
    # Last: a run that dies before writes the table again.
    tables.mark(spark, table, LOADS, held)
    return True


def derive_nights(
    spark: SparkSession,
    raw: str,
    feed: str,
    kind: str,
    derive: Callable[[DataFrame], DataFrame],
    again: bool = False,
    schema: str | None = None,
) -> DataFrame:
    """What ``derive`` makes of a feed's nights, as a table of nights beside the feed.

    Each night is derived from its own rows alone, so only nights that were
    loaded since, or loaded anew, are read; all of them if asked for ``again``.
    """
    path, derived = f"{raw}/{feed}_snapshots", f"{raw}/{feed}_{kind}"
    offered = nights.held_nights(spark, path)
    if not again:
        done = nights.held_nights(spark, derived).select("snapshot_date", F.col("recorded_at").alias("derived_at"))
        offered = offered.join(done, "snapshot_date", "left").where("derived_at is null or recorded_at > derived_at")
    wanted = {row.snapshot_date: row.row_count for row in offered.collect()}
    if any(wanted.values()):
        nights.commit_load(derive(nights.read_nights(spark, path, wanted)), derived, wanted)
    elif wanted:
        nights.commit_empty(spark, derived, wanted)
    return nights.read_nights(spark, derived, schema=schema)


def stage_feed(spark: SparkSession, raw: str, feed: str, restage: bool = False) -> DataFrame:
    """The staged history of a feed. Nights that are staged already are not parsed
    again unless asked for."""
    return derive_nights(spark, raw, feed, "staged", staging.STAGERS[feed], restage)


def check_nights(spark: SparkSession, raw: str, again: bool = False) -> DataFrame:
    """Verdicts of the raw checks by night. Nights checked already are not read again unless asked for."""
    verdicts = [
        derive_nights(spark, raw, feed, "verdicts", partial(quality.night_verdicts, feed=feed), again, quality.VERDICTS)
        for feed in staging.DATE_FORMATS
    ]
    return reduce(DataFrame.unionByName, verdicts)


def build_targets(
    spark: SparkSession,
    raw: str,
    market_table: str,
    catalogue_table: str,
    table: str,
    policy: TargetingPolicy,
    restage: bool = False,
) -> DataFrame:
    """Write the ranked mart to ``table`` and the verdict of every check to
    ``<table>_checks``, which is returned.

    Stages that several checks read are written once and deleted at the end. Of
    the raw feeds only nights new since the last build are read. A late feed stops the build: it would turn accounts into ones without
    opportunities.
    """
    # From the records: no file of the history is opened to find the newest night.
    held = {f: nights.held_nights(spark, f"{raw}/{f}_snapshots").where("row_count > 0") for f in snapshots.FEEDS}
    as_of = latest_date(held["accounts"])
    late = crm.late_feeds(as_of, opportunities=held["opportunities"]).collect()
    if late:
        raise nights.SnapshotError(f"no rows for the latest night: {[r.feed for r in late]}")
    staged = {f: stage_feed(spark, raw, f, restage) for f in snapshots.FEEDS}
    rollup = staging.stage_market(spark.table(market_table), normalised=True)
    with scratch(spark):
        stores = materialise(market.store_recent_sales(rollup, policy), "stores")
        night = latest_date(held["contacts"])
        people = materialise(crm.primary_contact(staged["contacts"], policy, night), "people")
        # Straight from its join, still laid out by account, for the contacts.
        current = crm.accounts_current(staged["accounts"], staged["opportunities"], as_of)
        mart = targets.target_accounts(current, stores, people, policy)
        mart.write.mode("overwrite").saveAsTable(table)
        models = quality.Models(
            verdicts=check_nights(spark, raw, restage),
            **staged,
            products=staging.stage_products(spark.table(catalogue_table)),
            market=rollup,
            accounts_current=materialise(current, "current"),
            primary_contact=people,
            store_recent_sales=stores,
            mart=spark.table(table),
        )
        verdicts = run_suite(quality.declared_checks(models, policy))
        verdicts.write.mode("overwrite").saveAsTable(f"{table}_checks")
    return spark.table(f"{table}_checks")


def sweep_raw(spark: SparkSession, raw: str) -> int:
    """Delete what died loads left in the feeds and what is derived from them; returns how many loads."""
    kinds = ("snapshots", "staged", "verdicts")
    return sum(nights.sweep(spark, f"{raw}/{feed}_{kind}") for feed in snapshots.FEEDS for kind in kinds)


def policy_of(spark: SparkSession, path: str | None, choices: list[str]) -> TargetingPolicy:
    """The policy of a JSON file, with ``FIELD=JSON`` choices on top."""
    text = spark.read.option("wholetext", True).text(path).first().value if path else "{}"
    named = dict(choice.split("=", 1) for choice in choices)
    return TargetingPolicy.from_json(text).changed({name: json.loads(value) for name, value in named.items()})


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    jobs = parser.add_subparsers(dest="job", required=True)
    sync = jobs.add_parser("sync")
    sync.add_argument("landing")
    sync.add_argument("raw")
    sync.add_argument("--feed", choices=snapshots.FEEDS)
    sync.add_argument("--catalogue")
    sync.add_argument("--multi-line", action="store_true")
    rollup = jobs.add_parser("market")
    rollup.add_argument("sales")
    rollup.add_argument("table")
    rollup.add_argument("--force", action="store_true")
    rollup.add_argument("--estimate", action="store_true")
    rollup.add_argument("--buckets", type=int, default=tables.BUCKETS)
    rollup.add_argument("--state")
    ranked = jobs.add_parser("targets")
    for name in ("raw", "market_table", "catalogue_table", "table"):
        ranked.add_argument(name)
    ranked.add_argument("--restage", action="store_true")
    swept = jobs.add_parser("sweep")
    swept.add_argument("raw")
    for one in (rollup, ranked):
        one.add_argument("--policy")
        one.add_argument("--set", action="append", default=[], metavar="FIELD=JSON")
    args = parser.parse_args(argv)
    spark = SparkSession.builder.getOrCreate()
    if args.job == "sync":
        feeds = (args.feed,) if args.feed else snapshots.FEEDS
        print(sync_crm(spark, args.landing, args.raw, feeds, args.catalogue, args.multi_line))
        return 0
    if args.job == "sweep":
        print(f"{sweep_raw(spark, args.raw)} loads deleted")
        return 0
    policy = policy_of(spark, args.policy, args.set)
    if args.job == "market" and args.estimate:
        files = increments.list_files(spark, args.sales)
        if args.state and not args.force:
            files = increments.pending_files(spark, args.sales, args.state, policy.market_choices())
        print(f"{args.sales}: {market_bytes(spark, files, policy):,} bytes from {policy.sales_start} on")
    elif args.job == "market":
        built = build_market(spark, args.sales, args.table, policy, args.force, args.buckets, args.state)
        print("built" if built else "kept")
    else:
        verdicts = build_targets(
            spark, args.raw, args.market_table, args.catalogue_table, args.table, policy, args.restage
        )
        failed = verdicts.where("not passed").collect()  # one row per declared check at most
        for row in failed:
            print(f"{row.model}.{row.column_name}: {row.check_name}: {row.violations:,} violations")
        return 1 if failed else 0
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
