"""From files on disk to the ranked table, with the default policy."""

import datetime as dt
from pathlib import Path

import pytest
from conftest import plan, rows

from shelfscout import TargetingPolicy, jobs
from shelfscout.operators.latest import latest_date
from shelfscout.plans import crm, market, staging
from shelfscout.session import materialise, shared_folder
from shelfscout.sources.nights import SnapshotError, read_nights
from shelfscout.sources.tables import ScanBudgetError

ACCOUNTS = (
    "account_id,account_name,city,address,store_number,segment,account_owner,status,"
    "contract_start_date,last_activity_date,created_date,annual_target_gbp"
)
CONTACTS = "contact_id,account_id,first_name,last_name,title,email,phone,linkedin_url"
OPPORTUNITIES = (
    "opportunity_id,account_id,product_sku,stage,owner,type,expected_close_date,closed_date,"
    "last_activity_date,created_date,value_gbp"
)


def account(number, store="", segment="Wholesale Club", name="Shop"):
    return f'ACC-{number},{name} {number} ,Ames,1 Main St,{store},{segment},Kim,Active,24/01/2023,2026-05-01,2022-01-31,"GBP 76,503.29"'


def opportunity(number, stage):
    return f'OPP-{number},ACC-{number},SKU-1,{stage},Kim,New,24/06/2026,,2026-05-01,2026-01-31,"GBP 1,200.50"'


@pytest.fixture
def landing(tmp_path):
    root = tmp_path / "landing"
    root.mkdir()
    for night in ("2026-05-01", "2026-05-02"):
        accounts = [account(1, "10"), account(1, "10", name="Shop"), account(2, "20"), account(3), account(4, "99"), account(5)]
        opportunities = [opportunity(1, "Negotiation"), opportunity(2, "Closed Lost"), opportunity(3, "Prospecting"),
                         opportunity(4, "Closed Won"), opportunity(5, "Closed Lost")]
        contacts = [f"CON-{n},ACC-{n},Jo,Doe,Owner,JO{n}@X.COM,1,http://x" for n in range(1, 6)]
        for feed, header, lines in (("accounts", ACCOUNTS, accounts), ("contacts", CONTACTS, contacts),
                                    ("opportunities", OPPORTUNITIES, opportunities)):
            (root / f"crm_{feed}_{night}.csv").write_text("\n".join([header, *lines]) + "\n")
    return root


@pytest.fixture
def sales(spark, tmp_path):
    path = str(tmp_path / "sales")
    day = dt.date(2025, 3, 1)
    spark.createDataFrame(
        [("10", "s", "a", "c", "k", day, "IMPORTED DRY GINS", 700.0, 28, 21.0),
         ("20", "s", "a", "c", "k", day, "Flavored Gin", 65.0, 2, 1.5),
         ("20", "s", "a", "c", "k", day, "AMERICAN SLOE GINS", 100.0, 9, 6.75),
         ("20", "s", "a", "c", "k", dt.date(2020, 1, 1), "IMPORTED GINS", 9999.0, 9, 6.75)],
        "store_number string, store_name string, address string, city string, county string, date date, "
        "category_name string, sale_dollars double, bottles_sold int, volume_sold_liters double",
    ).write.parquet(path)
    return path


@pytest.fixture
def catalogue(spark, tmp_path):
    path = str(tmp_path / "product_catalogue.parquet")
    spark.createDataFrame(
        [("SKU-1 ", "p", "c", "v", "g", 70.0, 41.4, 35.0, 6, dt.date(2020, 1, 1))],
        "sku_id string, product_name string, company string, variant string, category string, bottle_size_cl double, "
        "abv_pct double, list_price_gbp double, pack_size int, launch_date date",
    ).write.parquet(path)
    return path


def test_from_files_to_list(spark, landing, sales, catalogue, tmp_path):
    raw, policy = str(tmp_path / "raw"), TargetingPolicy()
    loaded = jobs.sync_crm(spark, str(landing), raw, catalogue=catalogue)
    assert loaded == {"accounts": 2, "contacts": 2, "opportunities": 2}
    assert set(jobs.sync_crm(spark, str(landing), raw).values()) == {0}
    assert jobs.build_market(spark, sales, "market", policy) is True
    assert jobs.build_market(spark, sales, "market", policy) is False
    assert jobs.build_market(spark, sales, "market", policy, force=True) is True
    verdicts = jobs.build_targets(spark, raw, "market", "product_catalogue", "mart", policy)
    assert verdicts.count() == 65
    assert rows(verdicts) == rows(spark.table("mart_checks"))
    assert rows(verdicts.where("not passed")) == []
    found = [tuple(r) for r in spark.table("mart").orderBy("target_rank")
             .select("account_id", "evidence_tier", "relationship_penalty", "contact_email").collect()]
    assert found == [
        ("ACC-1", 1, 0, "jo1@x.com"), ("ACC-2", 2, 1, "jo2@x.com"),
        ("ACC-3", 4, 0, "jo3@x.com"), ("ACC-5", 4, 1, "jo5@x.com"),
    ]
    (row,) = spark.table("mart").where("account_id = 'ACC-2'").collect()
    assert row.rank_rationale == (
        "Tier 2 -- gin demand, below the $600 premium-gin floor; $65 gin spend, but only $65 of it premium tier "
        "-- below the $600 floor; PREVIOUSLY LOST -- demoted within tier; owned by Kim"
    )


def test_a_late_feed_stops_the_build(spark, landing, sales, catalogue, tmp_path):
    for feed, lines in (("accounts", f"{ACCOUNTS}\n{account(1)}"), ("contacts", CONTACTS)):
        (landing / f"crm_{feed}_2026-05-03.csv").write_text(f"{lines}\n")
    raw = str(tmp_path / "raw")
    jobs.sync_crm(spark, str(landing), raw, catalogue=catalogue)
    jobs.build_market(spark, sales, "late_market", TargetingPolicy())
    with pytest.raises(SnapshotError, match="opportunities"):
        jobs.build_targets(spark, raw, "late_market", "product_catalogue", "late_mart", TargetingPolicy())


def test_the_rollup_respects_its_ceiling(spark, sales):
    with pytest.raises(ScanBudgetError):
        jobs.build_market(spark, sales, "never_built", TargetingPolicy(scan_ceiling_bytes=10))
    assert not spark.catalog.tableExists("never_built")


def test_the_market_takes_in_new_months_only(spark, sales, tmp_path):
    state, policy = str(tmp_path / "state"), TargetingPolicy()
    built = lambda **more: jobs.build_market(spark, sales, "growing", policy, buckets=2, state=state, **more)
    assert (built(), built()) == (True, False)
    old = spark.read.parquet(sales)
    late = old.where("store_number = '10'").selectExpr(
        "store_number", "'renamed' as store_name", "address", "city", "county", "date'2025-04-01' as date",
        "category_name", "0.1 as sale_dollars", "-1 as bottles_sold", "volume_sold_liters")
    late.select([late[c].cast(t) for c, t in old.dtypes]).write.mode("append").parquet(sales)
    taken = set(jobs.increments.pending_files(spark, sales, state, policy.market_choices()).toPandas().path)
    assert 0 < len(taken) < len(old.inputFiles()) + 1
    assert (built(), built()) == (True, False)
    grown = rows(spark.table("growing"))
    jobs.build_market(spark, sales, "rebuilt", policy, buckets=2)
    assert grown == rows(spark.table("rebuilt"))
    assert {r.store_name for r in spark.table("growing").where("store_number = '10'").collect()} == {"renamed"}
    # A run that died after taking files in: the table is written again.
    jobs.tables.mark(spark, "growing", jobs.LOADS, "older")
    assert (built(), built()) == (True, False)
    assert built(force=True) is True and rows(spark.table("growing")) == grown
    with pytest.raises(ScanBudgetError):
        jobs.build_market(spark, sales, "growing", TargetingPolicy(scan_ceiling_bytes=10, sales_start="2022-01-01"), state=state)


def test_the_market_table_keeps_its_layout(spark, sales):
    """No exchange under the store pivot, whatever the broadcast limit."""
    assert jobs.build_market(spark, sales, "laid_out", TargetingPolicy(), buckets=4)
    staged = staging.stage_market(spark.table("laid_out"), normalised=True)
    assert "Exchange" not in plan(market.store_recent_sales(staged, TargetingPolicy()))


def test_the_contact_join_does_not_move_accounts_again(spark, landing, tmp_path):
    raw = str(tmp_path / "raw")
    jobs.sync_crm(spark, str(landing), raw)
    staged = {feed: jobs.stage_feed(spark, raw, feed) for feed in ("accounts", "contacts", "opportunities")}
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        night = latest_date(staged["accounts"])
        current = crm.accounts_current(staged["accounts"], staged["opportunities"], night)
        people = materialise(crm.primary_contact(staged["contacts"], TargetingPolicy(), night), "people")
        alone = plan(current).count("Exchange hashpartitioning(account_id")
        joined = plan(current.join(people, "account_id", "left")).count("Exchange hashpartitioning(account_id")
        assert joined == alone + 1  # the contacts' own
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def test_history_is_staged_once(spark, landing, tmp_path, monkeypatch):
    raw = str(tmp_path / "raw")
    jobs.sync_crm(spark, str(landing), raw)
    first = jobs.stage_feed(spark, raw, "accounts")
    stamps = {r[0] for r in first.select("_metadata.file_path").distinct().collect()}
    (landing / "crm_accounts_2026-05-03.csv").write_text(f"{ACCOUNTS}\n{account(7)}\n")
    jobs.sync_crm(spark, str(landing), raw, feeds=("accounts",))
    again = jobs.stage_feed(spark, raw, "accounts")
    assert stamps < {r[0] for r in again.select("_metadata.file_path").distinct().collect()}
    assert again.where("snapshot_date = '2026-05-03'").count() == 1
    restaged = jobs.stage_feed(spark, raw, "accounts", restage=True)
    fresh = staging.stage_accounts(read_nights(spark, f"{raw}/accounts_snapshots"))
    assert rows(restaged.select(*fresh.columns)) == rows(fresh)


def test_a_second_build_reads_only_the_new_night(spark, landing, sales, catalogue, tmp_path):
    raw, policy = str(tmp_path / "raw"), TargetingPolicy()
    jobs.sync_crm(spark, str(landing), raw, catalogue=catalogue)
    jobs.build_market(spark, sales, "nightly_market", policy)
    jobs.build_targets(spark, raw, "nightly_market", "product_catalogue", "nightly_mart", policy)
    old = [path for feed in ("accounts", "contacts", "opportunities")
           for path in Path(raw, f"{feed}_snapshots").glob("load=*/snapshot_date=*/*.parquet")]
    assert len(old) >= 6
    for feed, header, lines in (
        ("accounts", ACCOUNTS, [account(1), account(1, name="Other"), account(2).replace("2022-01-31", "31/01/2022")]),
        ("contacts", CONTACTS, ["CON-1,ACC-1,Jo,Doe,Owner,JO1@X.COM,1,http://x"]),
        ("opportunities", OPPORTUNITIES, [opportunity(1, "Negotiation"), opportunity(2, "Prospecting").replace("GBP 1,200.50", "to be agreed")]),
    ):
        (landing / f"crm_{feed}_2026-05-03.csv").write_text("\n".join([header, *lines]) + "\n")
    jobs.sync_crm(spark, str(landing), raw)
    kept = {path: path.read_bytes() for path in old}
    for path in old:
        path.write_bytes(b"not to be opened")
        path.with_name(f".{path.name}.crc").unlink(missing_ok=True)
    again = rows(jobs.build_targets(spark, raw, "nightly_market", "product_catalogue", "nightly_mart", policy))
    for path, content in kept.items():
        path.write_bytes(content)
    whole = jobs.build_targets(spark, raw, "nightly_market", "product_catalogue", "whole_mart", policy, restage=True)
    assert rows(whole) == again and len(again) == 65
    found = {row.check_name: row.violations for row in whole.where("model in ('accounts_raw', 'raw_feeds')").collect()}
    assert found == {"duplicates_agree": 1, "dates_parse": 1, "money_parses": 1}


def test_staging_reads_only_what_is_asked_for(spark, landing, tmp_path):
    raw = str(tmp_path / "raw")
    jobs.sync_crm(spark, str(landing), raw)
    staged = staging.stage_opportunities(read_nights(spark, f"{raw}/opportunities_snapshots"))
    scanned = plan(crm.opportunity_rollup(staged)).split("ReadSchema: struct<")[1].split(">")[0]
    assert {field.split(":")[0] for field in scanned.split(",")} <= {
        "opportunity_id", "account_id", "stage", "last_activity_date", "value_gbp", "_loaded_at", "_row_hash",
    }


def test_a_build_leaves_no_intermediates(spark, landing, sales, catalogue, tmp_path):
    raw = str(tmp_path / "raw")
    jobs.sync_crm(spark, str(landing), raw, catalogue=catalogue)
    jobs.build_market(spark, sales, "tidy_market", TargetingPolicy())
    before = set(Path(shared_folder(spark).removeprefix("file:")).iterdir())
    verdicts = jobs.build_targets(spark, raw, "tidy_market", "product_catalogue", "tidy_mart", TargetingPolicy())
    assert verdicts.count() == 65
    assert set(Path(shared_folder(spark).removeprefix("file:")).iterdir()) == before


def test_every_choice_can_be_made_on_the_command_line(spark, landing, sales, catalogue, tmp_path, capsys):
    raw, choices = str(tmp_path / "raw"), tmp_path / "policy.json"
    choices.write_text('{"window_years": [2020], "premium_floor": 5000, "categories": {"premium": ["IMPORTED GINS"]}}')
    assert jobs.main(["sync", str(landing), raw, "--catalogue", catalogue]) == 0
    market_args = ["market", sales, "chosen_market", "--policy", str(choices), "--set", 'sales_start="2019-01-01"']
    with pytest.raises(ScanBudgetError, match="scan_ceiling_bytes"):
        jobs.main([*market_args, "--set", "scan_ceiling_bytes=1"])
    assert jobs.main([*market_args, "--estimate"]) == 0
    assert jobs.main([*market_args, "--set", "scan_ceiling_bytes=0", "--buckets", "2"]) == 0
    target_args = ["targets", raw, "chosen_market", "product_catalogue", "chosen_mart", "--policy", str(choices)]
    more = ["--set", "exclude_closed_lost=true", "--set", "list_size=1", "--set", 'sales_start="2019-01-01"']
    code = jobs.main([*target_args, *more])
    assert code == int(spark.table("chosen_mart_checks").where("not passed").count() > 0)
    assert "built" in capsys.readouterr().out
    found = [tuple(r) for r in spark.table("chosen_mart").orderBy("target_rank")
             .select("account_id", "evidence_tier", "is_top_target").collect()]
    assert found == [("ACC-1", 4, True), ("ACC-3", 4, False)]


def test_policy_from_json():
    policy = TargetingPolicy.from_json('{"window_years": [2020, 2021], "categories": {"other_group": "REST"}}')
    assert (policy.window_years, policy.categories.other_group) == ((2020, 2021), "REST")
    assert policy.categories.premium == TargetingPolicy().categories.premium
    with pytest.raises(ValueError, match="no such policy field"):
        TargetingPolicy.from_json('{"premium_flor": 1}')
