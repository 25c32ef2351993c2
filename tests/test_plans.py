"""The pipeline on small hand-made frames: missing values, ties, signs, duplicates."""

import datetime as dt
from dataclasses import replace
from decimal import Decimal, localcontext

import pytest
from conftest import plan, rows
from pyspark.sql import functions as F

from shelfscout.functions import exact
from shelfscout.plans import crm, market, quality, reports, staging, targets
from shelfscout.operators.latest import latest_date
from shelfscout.policy import CategoryPolicy, TargetingPolicy
from shelfscout.sources.nights import commit_load, read_nights
from shelfscout.sources.snapshots import loaded_snapshots

D = dt.date
POLICY = TargetingPolicy(
    categories=CategoryPolicy(premium=("GOOD", "FINE"), other=("PLAIN",), aliases={"FINE": "GOOD"}),
    sales_start="2021-01-01",
    window_years=(2024, 2025),
    trend_years=(2023, 2024),
    premium_floor=100,
    list_size=3,
)
SALES = (
    "store_number string, store_name string, address string, city string, county string, "
    "date date, category_name string, sale_dollars double, bottles_sold int, volume_sold_liters double"
)


def sale(store, day, category, dollars, units, name="n", address="a"):
    return (store, name, address, "c", None, D.fromisoformat(day), category, dollars, units, 0.75 * units)


@pytest.fixture(scope="module")
def sales(spark):
    return spark.createDataFrame(
        [
            sale("1", "2020-12-31", "GOOD", 999.0, 1),
            sale("1", "2024-03-01", " good", 60.1, 2, name="old"),
            sale("1", "2024-03-02", "FINE", 60.2, 2, name="new"),
            sale("1", "2024-03-02", "good ", -20.05, -1, name="new", address="b"),
            sale("1", "2024-05-01", "PLAIN", 30.0, 3),
            sale("1", "2024-06-01", None, 5.0, 0),
            sale("1", "2025-01-01", "RUM", 7.0, 1),
            sale("1", "2023-01-01", "GOOD", 50.0, 5),
            sale("2", "2024-01-01", "RUM", 10.0, 1),
            sale("2", "2024-01-02", "RUM", None, 1),
            sale("3", "2025-01-01", "PLAIN", -10.0, -1),
        ],
        SALES,
    )


@pytest.fixture(scope="module")
def rollup(sales):
    return market.sales_rollup(sales, POLICY)


def test_rollup_measures(rollup):
    found = rollup.where("store_number = '1' and year = 2024").drop("address", "city", "county", "store_number")
    assert rows(found) == sorted(
        [
            ("new", 2024, "GIN_PREMIUM", "GOOD", Decimal("100.25"), Decimal("120.30"), Decimal("-20.05"),
             Decimal("2.250"), 3, 1, 3, D(2024, 3, 2)),
            ("n", 2024, "GIN_OTHER", "PLAIN", Decimal("30.00"), Decimal("30.00"), Decimal("0.00"),
             Decimal("2.250"), 3, 0, 1, D(2024, 5, 1)),
            # A zero-unit line counts in the net only.
            ("n", 2024, "NON_GIN", None, Decimal("5.00"), Decimal("0.00"), Decimal("0.00"),
             Decimal("0.000"), 0, 0, 1, D(2024, 6, 1)),
        ],
        key=repr,
    )
    assert rollup.where("year = 2020").count() == 0
    assert [r.address for r in rollup.where("gin_category = 'GOOD' and year = 2024").collect()] == ["b"]


def test_rollup_missing_amounts(rollup):
    (row,) = rollup.where("store_number = '2'").collect()
    assert (row.net_sale_dollars, row.order_lines, row.net_bottles) == (Decimal("10.00"), 2, 2)


def test_rollup_sums_are_exact(spark):
    """Small amounts add up, fractional units count, wide decimals keep every digit."""
    small = spark.range(1000).select(
        F.lit("1").alias("store_number"), *[F.lit("x").alias(c) for c in market.STORE_ATTRIBUTES],
        F.lit(D(2024, 1, 1)).alias("date"), F.lit("RUM").alias("category_name"),
        F.lit(0.004).alias("sale_dollars"), F.lit(0.5).alias("bottles_sold"), F.lit(0.0004).alias("volume_sold_liters"),
    )
    (row,) = market.sales_rollup(small, POLICY).collect()
    assert (row.net_sale_dollars, row.gross_sale_dollars, row.net_volume_liters, row.net_bottles) == (
        Decimal("4"), Decimal("4"), Decimal("0.4"), Decimal("500"),
    )
    wide = small.limit(3).withColumn("sale_dollars", F.lit("90071992547409931.01").cast("decimal(28,2)"))
    (row,) = market.sales_rollup(wide, POLICY).collect()
    assert row.net_sale_dollars == Decimal("270215977642229793.03")
    odd = small.limit(2).withColumn("sale_dollars", F.lit(float("nan")))
    assert market.sales_rollup(odd, POLICY).first().net_sale_dollars is None


def lines(spark, amounts, units=None):
    units = units or [1.0] * len(amounts)
    rows = [("1", *"xxxx", D(2024, 1, 1), "RUM", a, u, 0.75) for a, u in zip(amounts, units, strict=True)]
    names = ["store_number", *market.STORE_ATTRIBUTES]
    schema = ", ".join(f"{c} string" for c in names) + ", date date, category_name string, sale_dollars double, bottles_sold double, volume_sold_liters double"
    return spark.createDataFrame(rows, schema)


@pytest.mark.parametrize(
    "amounts",
    [
        [6e19, 6e19, 6e19],
        [1.5e21, 0.01, -1.5e21],
        [9e15, 9007199254740993.0, 0.1, 0.2],
        [1e11, -1e11, 99999999999.9999, 123456.78901, 1e-15, 5e-324],
        [0.1, 0.2, 0.3, -0.0, None, float("nan"), float("inf")],
        [-1.0001, -2.5, -(2.0**-20), 1 / 3, 2 / 3, 12345.6789],
    ],
)
def test_sums_equal_those_of_the_printed_decimals(spark, amounts):
    units = [float((i % 3) - 1) for i in range(len(amounts))]
    (row,) = market.sales_rollup(lines(spark, amounts, units), POLICY).collect()

    def total(wanted):
        held = [a for a, u in zip(amounts, units, strict=True) if wanted(u) and a is not None and abs(a) < float("inf")]
        return sum((Decimal(repr(a)).quantize(Decimal("1e-15"), rounding="ROUND_HALF_UP") for a in held), Decimal(0))

    with localcontext(prec=60):
        assert row.net_sale_dollars == total(lambda u: True)
        assert row.gross_sale_dollars == total(lambda u: u > 0)
        assert row.returns_dollars == total(lambda u: u < 0)
    assert row.net_volume_liters == Decimal("0.75") * len(amounts)


def test_an_amount_beyond_all_totals_stops_the_job(spark):
    with pytest.raises(Exception, match="NUMERIC_VALUE_OUT_OF_RANGE"):
        market.sales_rollup(lines(spark, [1e24]), POLICY).collect()


def test_ordinary_lines_meet_no_wide_decimal(spark):
    text = plan(market.sales_partials(lines(spark, [1.0]), POLICY))
    assert "SortAggregate" not in text and text.count("HashAggregate") == 2
    found = market.sales_partials(lines(spark, [1.0, 19.99, 0.0004, 1e10]), POLICY).first()
    assert found.net_sale_dollars_rest is None and found.net_sale_dollars_high is not None


def test_partials_of_parts_fold_into_the_rollup_of_the_whole(spark):
    whole = lines(spark, [1.25, 1 / 3, 6e19, None, -4.0, 0.1], [1.0, -1.0, 0.5, 1.0, -2.0, 0.0])
    whole = whole.withColumn("store_name", F.concat(F.lit("shop "), F.col("bottles_sold"))).withColumn(
        "date", F.date_add("date", F.col("bottles_sold").cast("int"))
    )
    parts = [market.sales_partials(whole.where(c), POLICY) for c in ("bottles_sold > 0", "bottles_sold <= 0")]
    assert rows(market.fold_partials(parts[0].union(parts[1]))) == rows(market.sales_rollup(whole, POLICY))


def test_variants_are_sorted_by_a_hash_of_their_keys(spark):
    text = plan(market.sales_rollup(lines(spark, [1.0]), POLICY))
    assert "Sort [" in text and "Sort [store_number#" not in text
    whole = lines(spark, [1.0, 2.0, 4.0, None, 1e10], [1.0, -1.0, 1.0, 1.0, 1.0])
    whole = whole.withColumn("store_number", F.when(F.col("sale_dollars") < 3, F.col("store_number")))
    found = market.sales_rollup(whole, POLICY).groupBy("store_number").agg(F.sum("net_sale_dollars"))
    assert rows(found.where("store_number is null")) == [(None, Decimal("10000000004.000000000000000"))]


def test_totals_agree_on_both_sides_of_the_short_path(spark):
    limit = exact.MOST_HIGH
    held = [(limit, 5, None), (limit + 1, 5, None), (-limit, 7, None), (-limit - 1, 7, None), (3, exact.MOST_LOW + 9, None)]
    held += [(None, None, None), (1, 2, Decimal("0.5")), (None, None, Decimal("0.25"))]
    df = spark.createDataFrame([(i, *row) for i, row in enumerate(held)], "i int, a_high long, a_low long, a_rest decimal(38,15)")
    found = [row[0] for row in df.orderBy("i").select(exact.total("a", df.columns)).collect()]
    with localcontext(prec=60):
        for (high, low, rest), amount in zip(held, found, strict=True):
            parts = [] if high is None else [(Decimal(high) * (1 << exact.LOW_BITS) + low) / exact.UNITS]
            parts += [] if rest is None else [rest]
            assert amount == (sum(parts) if parts else None)


def test_rollup_pushes_the_date_and_reads_only_its_columns(spark, sales, tmp_path):
    path = str(tmp_path / "sales")
    sales.withColumn("invoice", F.lit("x")).write.parquet(path)
    text = plan(market.sales_rollup(spark.read.parquet(path), POLICY))
    assert "GreaterThanOrEqual(date,2021-01-01)" in text
    assert "invoice" not in text
    assert text.count("Exchange") == 2


@pytest.fixture(scope="module")
def stores(rollup):
    return market.store_recent_sales(staging.stage_market(rollup), POLICY)


def test_store_pivot(stores):
    found = {r.store_number: r for r in stores.collect()}
    one = found["1"]
    assert one.premium_gin_dollars == Decimal("100.25")
    assert one.other_gin_dollars == Decimal("30.00")
    assert one.total_gin_dollars == Decimal("130.25")
    assert one.non_gin_dollars == Decimal("12.00")
    assert one.total_dollars == Decimal("142.25")
    assert (one.premium_gin_bottles, one.premium_gin_order_lines) == (3, 3)
    assert (one.last_premium_gin_purchase_date, one.last_purchase_date) == (D(2024, 3, 2), D(2025, 1, 1))
    assert one.premium_share_of_gin == 100.25 / 130.25
    two = found["2"]
    assert two.premium_gin_dollars == 0
    assert two.last_premium_gin_purchase_date is None
    assert two.premium_share_of_gin is None
    assert two.premium_gin_dollars_per_bottle is None


def test_store_attributes_of_the_latest_year_then_the_larger_amount(spark):
    rollup = spark.createDataFrame(
        [("9", "a", 2024, "GIN_OTHER", 500.0), ("9", "b", 2025, "NON_GIN", None),
         ("9", "c", 2025, "GIN_PREMIUM", 5.0), ("9", "d", 2025, "GIN_OTHER", 5.0),
         (None, "x", 2025, "NON_GIN", 1.0)],
        "store_number string, store_name string, year int, cat_group string, net_sale_dollars double",
    ).selectExpr(
        "*", "'' address", "'' city", "'' county", "cast(null as string) gin_category",
        "1L net_bottles", "1L order_lines", "date'2025-01-01' last_purchase_date",
    )
    (row,) = market.store_recent_sales(rollup, POLICY).collect()
    assert (row.store_number, row.store_name) == ("9", "d")


def test_category_audit(sales):
    found = market.category_audit(sales, POLICY.categories, "U")
    assert rows(found) == sorted(
        [("FINE", False, True, 1), ("GOOD", False, True, 4), ("PLAIN", False, True, 2), ("RUM", True, False, 3)]
    )


ACCOUNT_COLUMNS = [
    "account_id", "account_name", "city", "address", "store_number", "segment", "account_owner",
    "status", "contract_start_date", "last_activity_date", "created_date", "annual_target_gbp",
]
OPPORTUNITY_COLUMNS = [
    "opportunity_id", "account_id", "product_sku", "stage", "owner", "type",
    "expected_close_date", "closed_date", "last_activity_date", "created_date", "value_gbp",
]
CONTACT_COLUMNS = [
    "contact_id", "account_id", "first_name", "last_name", "title", "email", "phone", "linkedin_url",
]


def raw(spark, columns, records, night="2026-05-02"):
    """Raw rows from dicts, absent fields empty."""
    data = [tuple(r.get(c, "") for c in columns) + (r.get("night", night),) for r in records]
    df = spark.createDataFrame(data, ", ".join(f"{c} string" for c in [*columns, "night"]))
    return df.select(
        *columns,
        F.to_date("night").alias("snapshot_date"),
        F.lit("f.csv").alias("_source_file"),
        F.to_timestamp(F.lit("2026-05-02 01:00:00")).alias("_loaded_at"),
    )


@pytest.fixture(scope="module")
def accounts_raw(spark):
    return raw(
        spark,
        ACCOUNT_COLUMNS,
        [
            {"account_id": "A1", "account_name": "One", "store_number": "1", "account_owner": "Kim",
             "status": "Active", "annual_target_gbp": "GBP 76,503.29", "contract_start_date": "24/01/2023"},
            {"account_id": "A1 ", "account_name": "One  ", "store_number": "1", "account_owner": "Kim",
             "status": "Active", "annual_target_gbp": "GBP 76,503.29", "contract_start_date": "24/01/2023"},
            {"account_id": "A2", "account_name": "Two", "store_number": "2", "city": "Ames"},
            {"account_id": "A3", "account_name": "Three", "store_number": " 3 "},
            {"account_id": "A4", "account_name": "Four"},
            {"account_id": "A5", "account_name": "Five", "store_number": "77"},
            {"account_id": "A6", "account_name": "Six", "store_number": "1x"},
            {"account_id": "A7", "account_name": "Seven"},
            {"account_id": "A1", "account_name": "Before", "night": "2026-05-01"},
        ],
    )


@pytest.fixture(scope="module")
def opportunities_raw(spark):
    return raw(
        spark,
        OPPORTUNITY_COLUMNS,
        [
            {"opportunity_id": "O1", "account_id": "A1", "stage": "Negotiation", "value_gbp": "GBP 1,000.00"},
            {"opportunity_id": "O2", "account_id": "A1", "stage": "Closed Lost", "value_gbp": "GBP 9,000.00"},
            {"opportunity_id": "O3", "account_id": "A2", "stage": "Closed Lost"},
            {"opportunity_id": "O4", "account_id": "A3", "stage": "", "value_gbp": "x"},
            {"opportunity_id": "O5", "account_id": "A5", "stage": "Closed Won"},
            {"opportunity_id": "O6", "account_id": "A5", "stage": "Prospecting"},
            {"opportunity_id": "O7", "account_id": "A6", "stage": "Closed Lost"},
            {"opportunity_id": "O8", "account_id": "A7", "stage": "Prospecting", "value_gbp": "5"},
            {"opportunity_id": "O1", "account_id": "A1", "stage": "Closed Won", "night": "2026-05-01"},
        ],
    )


@pytest.fixture(scope="module")
def contacts_raw(spark):
    return raw(
        spark,
        CONTACT_COLUMNS,
        [
            {"contact_id": "C9", "account_id": "A1", "first_name": "Al", "last_name": "B", "title": "Owner",
             "email": " AL@X.COM"},
            {"contact_id": "C1", "account_id": "A1", "first_name": "Zed", "title": "Store Manager"},
            {"contact_id": "C2", "account_id": "A2", "title": "Intern"},
            {"contact_id": "C3", "account_id": "A2", "first_name": "Bo"},
            {"contact_id": "C0", "account_id": "A1", "title": "Owner", "night": "2026-05-01"},
        ],
    )


@pytest.fixture(scope="module")
def current(accounts_raw, opportunities_raw):
    return crm.accounts_current(
        staging.stage_accounts(accounts_raw), staging.stage_opportunities(opportunities_raw)
    )


@pytest.fixture(scope="module")
def people(contacts_raw):
    return crm.primary_contact(staging.stage_contacts(contacts_raw), POLICY)


@pytest.fixture(scope="module")
def mart(current, stores, people):
    return targets.target_accounts(current, stores, people, POLICY)


def test_staging_types_and_grain(accounts_raw):
    staged = staging.stage_accounts(accounts_raw)
    kinds = dict(staged.dtypes)
    assert kinds["annual_target_gbp"] == "decimal(38,9)"
    assert kinds["contract_start_date"] == "date"
    assert staged.count() == 8
    (one,) = staged.where("account_id = 'A1' and snapshot_date = '2026-05-02'").collect()
    assert (one.account_name, one.annual_target_gbp) == ("One", Decimal("76503.29"))
    assert one.contract_start_date == D(2023, 1, 24)
    assert one.city is None


def test_states_by_precedence(current):
    found = {r.account_id: r for r in current.collect()}
    assert {k: r.crm_state for k, r in found.items()} == {
        "A1": "open", "A2": "closed_lost", "A3": "open", "A4": "no_opportunity",
        "A5": "closed_won", "A6": "closed_lost", "A7": "open",
    }
    assert found["A1"].opportunity_count == 2
    assert found["A1"].open_pipeline_gbp == 1000
    assert found["A4"].opportunity_count == 0
    assert found["A4"].open_pipeline_gbp is None
    assert {r.crm_as_of_date for r in found.values()} == {D(2026, 5, 2)}


def test_only_the_latest_night_is_read(spark, accounts_raw, opportunities_raw, tmp_path):
    """The night reaches the folder listing through the deduplication."""
    feeds = {}
    for name, feed in (("accounts", accounts_raw), ("opportunities", opportunities_raw)):
        commit_load(feed, str(tmp_path / name))
        feeds[name] = read_nights(spark, str(tmp_path / name))
    df = crm.accounts_current(
        staging.stage_accounts(feeds["accounts"]),
        staging.stage_opportunities(feeds["opportunities"]),
        latest_date(loaded_snapshots(spark, str(tmp_path / "accounts"))),
    )
    pruned = [p for p in plan(df).split("PartitionFilters: [")[1:] if "Subquery" in p.split("]")[0]]
    assert len(pruned) >= 2
    assert df.count() == 7


def test_primary_contact(people):
    found = {r.account_id: r for r in people.collect()}
    assert (found["A1"].contact_id, found["A1"].contact_name) == ("C9", "Al B")
    assert found["A1"].contact_email == "al@x.com"
    assert (found["A2"].contact_id, found["A2"].contact_name) == ("C2", "")


def test_contacts_of_one_huge_account(spark):
    contacts = spark.range(5000).select(
        F.format_string("C%05d", "id").alias("contact_id"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("account_id"),
        F.lit("n").alias("full_name"),
        F.when(F.col("id") == 4500, "Owner").alias("title"),
        F.lit("").alias("email"), F.lit("").alias("phone"), F.lit("").alias("linkedin_url"),
        F.lit(D(2026, 5, 2)).alias("snapshot_date"),
    )
    (hot,) = crm.primary_contact(contacts, POLICY).where("account_id = 'hot'").collect()
    assert hot.contact_id == "C04500"


def test_late_feed_is_named(accounts_raw, opportunities_raw):
    late = opportunities_raw.where("snapshot_date < '2026-05-02'")
    as_of = F.lit(D(2026, 5, 2))
    assert rows(crm.late_feeds(as_of, accounts=accounts_raw, opportunities=late)) == [("opportunities",)]
    assert crm.late_feeds(as_of, accounts=accounts_raw, opportunities=opportunities_raw).count() == 0


def test_ranked_list(mart):
    assert len(mart.columns) == 42
    found = [
        (r.target_rank, r.account_id, r.evidence_tier, r.relationship_penalty, r.target_type, r.is_top_target)
        for r in mart.orderBy("target_rank").collect()
    ]
    assert found == [
        (1, "A1", 1, 0, "known_prospect", True),
        (2, "A3", 3, 0, "known_prospect", True),
        (3, "A2", 3, 1, "previous_loss", True),
        (4, "A7", 4, 0, "known_prospect", False),
        (5, "A4", 4, 0, "no_opportunity", False),
        (6, "A6", 4, 1, "previous_loss", False),
    ]


def test_rationale_is_never_blank(mart):
    found = {r.account_id: r.rank_rationale for r in mart.collect()}
    assert found == {
        "A1": "Tier 1 -- buys premium gin at scale (>= $100); $100 premium gin over 3 orders, "
              "77% of its gin spend; open prospect, owned by Kim, GBP 1,000 open pipeline",
        "A2": "Tier 3 -- no gin traction; $10 total liquor spend, no gin purchases in the window; "
              "PREVIOUSLY LOST -- demoted within tier; owned by unassigned",
        "A3": "Tier 3 -- no gin traction; $-10 total liquor spend, no gin purchases in the window; "
              "open prospect, owned by unassigned, GBP 0 open pipeline",
        "A4": "Tier 4 -- no market match -- CRM evidence only; no Iowa store matched "
              "(no store_number on the account); no_opportunity",
        "A6": "Tier 4 -- no market match -- CRM evidence only; no Iowa store matched "
              "(store_number 1x not in the market data); PREVIOUSLY LOST -- demoted within tier; owned by unassigned",
        "A7": "Tier 4 -- no market match -- CRM evidence only; no Iowa store matched "
              "(no store_number on the account); open prospect, owned by unassigned, GBP 5 open pipeline",
    }


def test_crm_values_win_and_market_fills_gaps(mart):
    found = {r.account_id: r for r in mart.collect()}
    assert (found["A1"].city, found["A2"].city, found["A4"].city) == ("c", "Ames", None)
    assert found["A4"].premium_gin_dollars is None
    assert found["A2"].premium_gin_dollars == 0


def test_tier_two_wording(current, stores, people):
    strict = replace(POLICY, premium_floor=101)
    scored = targets.scored_accounts(current, stores, people, strict)
    assert [r.evidence_tier for r in scored.where("account_id = 'A1'").collect()] == [2]
    mart = targets.target_accounts(current, stores, people, strict)
    (text,) = [r[0] for r in mart.where("account_id = 'A1'").select("rank_rationale").collect()]
    assert "$130 gin spend, but only $100 of it premium tier -- below the $101 floor" in text


def test_switches(current, stores, people):
    without = replace(POLICY, exclude_closed_lost=True)
    kept = targets.eligible(current, without)
    assert {r.crm_state for r in kept.collect()} == {"open", "no_opportunity"}
    equal = replace(POLICY, demote_closed_lost=False)
    ranked = targets.target_accounts(current, stores, people, equal)
    assert [r.account_id for r in ranked.orderBy("target_rank").limit(3).collect()] == ["A1", "A2", "A3"]
    assert {r.relationship_penalty for r in ranked.collect()} == {0}


def test_zero_floor_means_any_premium(current, stores, people):
    scored = targets.scored_accounts(current, stores, people, replace(POLICY, premium_floor=0))
    tiers = {r.account_id: r.evidence_tier for r in scored.collect()}
    assert (tiers["A1"], tiers["A2"], tiers["A3"]) == (1, 3, 3)


def test_top_targets_equals_the_flag(current, stores, people, mart):
    top = targets.top_targets(targets.scored_accounts(current, stores, people, POLICY), POLICY)
    assert "TakeOrderedAndProject" in plan(top)
    assert [r.account_id for r in top.collect()] == [
        r.account_id for r in mart.where("is_top_target").orderBy("target_rank").collect()
    ]


def test_no_plan_uses_a_cross_join_or_python(current, stores, people, mart, rollup):
    for df in (current, stores, people, mart, rollup, targets.scored_accounts(current, stores, people, POLICY)):
        text = plan(df)
        assert "CartesianProduct" not in text
        assert "BroadcastNestedLoopJoin" not in text
        assert "Python" not in text


def test_invariants_hold_and_notice_breaches(mart, current):
    assert quality.excluded_in_targets(mart, current, POLICY).count() == 0
    assert quality.demotion_breaches(mart).count() == 0
    strict = replace(POLICY, exclude_closed_lost=True)
    assert {r.account_id for r in quality.excluded_in_targets(mart, current, strict).collect()} == {"A2", "A6"}
    swapped = mart.withColumn("target_rank", 7 - F.col("target_rank"))
    assert {r.account_id for r in quality.demotion_breaches(swapped).collect()} == {"A2", "A6"}


def test_duplicates_agree(spark, accounts_raw):
    assert quality.duplicates_agree(accounts_raw, "account_id", quality.ACCOUNT_FACTS).count() == 0
    other = raw(spark, ACCOUNT_COLUMNS, [{"account_id": "A2", "account_name": "Two", "store_number": "9"}])
    found = quality.duplicates_agree(accounts_raw.unionByName(other), "account_id", quality.ACCOUNT_FACTS)
    assert [(r.account_id, r.duplicate_rows, r.distinct_versions) for r in found.collect()] == [("A2", 2, 2)]


def test_parse_failures(spark, accounts_raw, opportunities_raw):
    bad = raw(spark, ACCOUNT_COLUMNS, [{"account_id": "A9", "contract_start_date": "2023-01-24",
                                        "created_date": "24/01/2023", "last_activity_date": "2023-01-24"}])
    found = quality.date_failures(quality.all_parse_failures(accounts_raw.unionByName(bad), opportunities_raw))
    assert rows(found.select("source_table", "source_column", "expected_format", "unparseable_value")) == [
        ("accounts_snapshots", "contract_start_date", "uk", "2023-01-24"),
        ("accounts_snapshots", "created_date", "iso", "24/01/2023"),
    ]
    failures = quality.all_parse_failures(accounts_raw, opportunities_raw)
    money = quality.money_failures(failures)
    assert rows(money.select("source_table", "source_column", "unparseable_value")) == [
        ("opportunities_snapshots", "value_gbp", "x")
    ]
    assert plan(failures).count("Scan") == 2


def suite_of(accounts_raw, opportunities_raw, contacts_raw, rollup, current, people, stores, mart, products):
    return quality.declared_checks(
        quality.Models(
            verdicts=quality.night_verdicts(accounts_raw, "accounts").union(
                quality.night_verdicts(opportunities_raw, "opportunities")
            ),
            accounts=staging.stage_accounts(accounts_raw),
            opportunities=staging.stage_opportunities(opportunities_raw),
            contacts=staging.stage_contacts(contacts_raw),
            products=products,
            market=staging.stage_market(rollup),
            accounts_current=current,
            primary_contact=people,
            store_recent_sales=stores,
            mart=mart,
        ),
        POLICY,
    )


def test_suite_has_65_checks(spark, accounts_raw, opportunities_raw, contacts_raw, rollup, current, people, stores, mart):
    products = spark.createDataFrame([("S", 1.0)], "sku_id string, list_price_gbp double")
    checks = suite_of(accounts_raw, opportunities_raw, contacts_raw, rollup, current, people, stores, mart, products)
    assert sum(len(c) for c in checks) == 65
    by_model = {}
    for c in checks[:9]:
        by_model[c.model] = len(c)
    assert by_model == {
        "accounts": 6, "opportunities": 9, "contacts": 5, "products": 3, "market": 6,
        "accounts_current": 6, "primary_contact": 3, "store_recent_sales": 4, "target_accounts": 18,
    }


@pytest.fixture(scope="module")
def stage_market_frame(rollup):
    return staging.stage_market(rollup)


def test_market_reports(stage_market_frame):
    trend = reports.market_trend(stage_market_frame, POLICY)
    assert rows(trend) == [
        (2023, "GIN_PREMIUM", Decimal("50.00"), 1),
        (2024, "GIN_OTHER", Decimal("30.00"), 1),
        (2024, "GIN_PREMIUM", Decimal("100.25"), 1),
    ]
    assert rows(reports.market_trend(stage_market_frame, POLICY, approximate=True)) == rows(trend)
    index = reports.market_index(trend).where("cat_group = 'GIN_PREMIUM'")
    assert rows(index) == [(2023, "GIN_PREMIUM", 100.0, 100.0, 100.0), (2024, "GIN_PREMIUM", 200.5, 100.0, 200.5)]
    change = {r.cat_group: r for r in reports.market_change(trend, 2023, 2024).collect()}
    assert change["GIN_PREMIUM"].dollars_change_pct == pytest.approx(100.5)
    assert change["GIN_OTHER"].dollars_change_pct is None
    gap = reports.price_gap(stage_market_frame, POLICY).first()
    assert gap.premium_price == pytest.approx(150.25 / 8)
    assert gap.other_price == pytest.approx(20 / 2)
    prices = reports.category_price(stage_market_frame).collect()
    assert [(r.gin_category, r.cat_group) for r in prices] == [("PLAIN", "GIN_OTHER"), ("GOOD", "GIN_PREMIUM")]


def test_list_reports(mart):
    assert [tuple(r) for r in reports.tier_summary(mart).select("evidence_tier", "accounts", "in_top").collect()] == [
        (4, 3, 0), (3, 2, 2), (1, 1, 1),
    ]
    c = reports.concentration(mart).first()
    assert (c.accounts, c.matched, float(c.premium_in_top), c.top_share_pct) == (6, 3, 100.25, 100.0)
    assert rows(reports.owner_workload(mart)) == [("Kim", 1, Decimal(1000), 1, "£1,000")]
    assert reports.segment_mix(mart).count() == 0
    coverage = {r.match_state: (r.accounts, r.in_top) for r in reports.match_coverage(mart).collect()}
    assert coverage == {
        "Matched to an Iowa store": (3, 3),
        "No store_number on the account": (2, 0),
        "store_number not found in market data": (1, 0),
    }
    assert tuple(reports.overview(mart).first()) == (6, D(2026, 5, 2))
    u = reports.unmatched_summary(mart).first()
    assert (u.unmatched, u.accounts, u.unmatched_pipeline_gbp, u.unmatched_pct) == (3, 6, 5, 50.0)
    assert tuple(reports.loss_report(mart).first()) == (2, 1, 3)
    assert [r.measure for r in reports.previous_losses(mart).collect()] == ["$10", "$0"]
    sheet = reports.call_sheet(mart).collect()
    assert [tuple(r) for r in sheet][0] == (
        1, 1, "One", "C", "$100", "77%", None, "Kim", "Al B", "£1,000",
    )
    assert sheet[1]["Pipeline"] == "-"
    assert sheet[2]["prem %"] == "0%"


def test_volume_against_fit(spark):
    mart = spark.createDataFrame(
        [(7, 2, "Division - 1", 1800.0, 0.05), (8, 2, "Hill", 900.0, 0.995), (9, 2, "Mill", 900.0, 1.0),
         (10, 2, "Rill", 100.0, 0.99), (11, 2, "Till", 50.0, None), (12, 1, "Other", 9999.0, 1.0)],
        "target_rank int, evidence_tier int, account_name string, tier_measure double, premium_share_of_gin double",
    ).withColumn("is_top_target", F.lit(True))
    found = [tuple(r) for r in reports.volume_vs_fit(mart).collect()]
    assert [(r[0], r[1], r[4], r[5], r[6]) for r in found] == [
        (7, "#7 Division", True, False, None),
        (8, "#8 Hill", True, True, 2),
        (9, "#9 Mill", True, False, None),
        (10, "#10 Rill", False, False, None),
        (11, "#11 Till", False, False, None),
    ]
    empty = mart.where("evidence_tier = 1")
    assert reports.volume_vs_fit(empty).count() == 0
