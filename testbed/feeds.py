"""Stand-ins for the raw feeds, derived from the whole test tables.

Each feed is one SQL text that runs unchanged in Spark (tables passed in) and in
DuckDB (tables registered), except for the few words in ``DIALECT``. They play:

* sales     every line item; a store is one brand at one supplier
* accounts  every customer and supplier, listed on two nights; the customers of
            nation 9 are listed twice on the second one, padded
* contacts  every customer as a person; up to three people per account
* opportunities  every order, on two nights
* products  every part
* snapshots every event as a nightly row with several versions per key

Faults are planted by attribute: empty texts, texts that do not parse, wrong date
layouts, padding, disagreeing duplicates, keys that lead nowhere.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from shelfscout.policy import CategoryPolicy, TargetingPolicy
from shelfscout.session import folder_names

TABLES = ("customer", "supplier", "part", "orders", "lineitem", "events")
# Tables whose rows a feed lists several times.
DEALT = ("customer", "supplier", "orders")

# What the two engines spell differently: the text type, a generator, grouped digits.
DIALECT = {
    "spark": {
        "text": "string",
        "each": "explode(array({0}))",
        "grouped": "format_number({0}, 2)",
    },
    "duckdb": {
        "text": "varchar",
        "each": "unnest([{0}])",
        "grouped": "format('{{:,.2f}}', {0})",
    },
}

POLICY = TargetingPolicy(
    categories=CategoryPolicy(
        premium=("LARGE", "MEDIUM"), other=("STANDARD",), aliases={"MEDIUM": "LARGE"}
    ),
    sales_start="1997-01-01",
    window_years=(2000, 2001),
    trend_years=(1997, 1998, 1999, 2000),
    premium_floor=60000,
    title_precedence=("BUILDING", "MACHINERY", "AUTOMOBILE"),
    segments=("BUILDING", "MACHINERY", "AUTOMOBILE", "FURNITURE", "HOUSEHOLD"),
)


def _dmy(day: str) -> str:
    return (
        f"lpad(cast(day({day}) as @text), 2, '0') || '/' || "
        f"lpad(cast(month({day}) as @text), 2, '0') || '/' || cast(year({day}) as @text)"
    )


def _gbp(amount: str) -> str:
    return f"'GBP ' || @grouped({amount})"


SALES = """
select cast(l_suppkey as @text) || '-' || split_part(p_brand, '#', 2) as store_number,
       'Shop ' || p_brand || ' ' || l_returnflag as store_name,
       cast(l_suppkey as @text) || ' ' || l_linestatus || ' Street' as address,
       case when l_linestatus = 'F' then 'port o''brien' else 'NEW town-hall' end as city,
       case when l_returnflag = 'N' then null else 'county ' || l_returnflag end as county,
       cast(l_shipdate as date) as date,
       case when p_size = 7 then null else ' ' || lower(p_type) || ' ' end as category_name,
       case when l_returnflag = 'R' and l_linestatus = 'F' then -l_extendedprice
            else l_extendedprice end as sale_dollars,
       cast(case when l_returnflag = 'R' and l_linestatus = 'F' then -l_quantity
                 when l_returnflag = 'N' and l_linestatus = 'F' and l_quantity = 50 then 0
                 else l_quantity end as int) as bottles_sold,
       cast(0.75 as double) * case when l_returnflag = 'R' and l_linestatus = 'F' then -l_quantity
                                   else l_quantity end as volume_sold_liters
from @lineitem join @part on l_partkey = p_partkey
"""

_HOLDERS = """
select 'C' || cast(c_custkey as @text) as id, c_name as name, c_nationkey as nation,
       c_mktsegment as segment, c_acctbal as balance,
       cast('2019-01-01' as date) + cast(c_custkey % 1500 as int) as since,
       case when c_custkey % 5 < 2 then ''
            when c_custkey % 5 = 2 then 'X' || cast(c_custkey as @text)
            else cast(cast(floor(c_custkey / 15) as bigint) as @text) || '-'
                 || cast(c_custkey % 15 + 1 as @text) end as store
from @customer
union all
select 'S' || cast(s_suppkey as @text), s_name, s_nationkey, 'WHOLESALE', s_acctbal,
       cast('2019-01-01' as date) + cast(s_suppkey % 1500 as int),
       cast(s_suppkey as @text) || '-20'
from @supplier
"""

ACCOUNTS = f"""
select case when listing = 3 then id || ' ' else id end as account_id,
       case when listing = 3 then name || '   ' else chr(9) || name end as account_name,
       case when nation < 5 then '' else 'nation ' || cast(nation as @text) || ' o''port' end as city,
       case when nation < 5 then '  ' else cast(nation as @text) || ' Main Street' end as address,
       case when listing = 2 then ' ' || store else store end as store_number,
       case when listing = 3 and balance > 7000 then 'CHANGED' else segment end as segment,
       case when nation = 0 then '' when listing = 1 then 'owner_before'
            else 'owner_' || cast(nation as @text) end as account_owner,
       case when balance < 0 then 'Prospect' else 'Active' end as status,
       case when balance < 0 then '' when nation = 7 then cast(since as @text)
            else {_dmy('since')} end as contract_start_date,
       case when nation = 6 then {_dmy('since + 30')}
            else cast(since + 30 as @text) end as last_activity_date,
       cast(since as @text) as created_date,
       case when balance < 0 then '' when nation = 11 then 'n/a'
            else {_gbp('balance')} end as annual_target_gbp,
       case when listing = 1 then cast('2024-01-29' as date)
            else cast('2024-01-30' as date) end as snapshot_date,
       case when listing = 1 then 'crm_accounts_2024-01-29.csv'
            else 'crm_accounts_2024-01-30.csv' end as _source_file,
       case when listing = 1 then cast('2024-01-29 23:00:00' as timestamp)
            else cast('2024-01-30 23:00:00' as timestamp) end as _loaded_at
from (select *, @each(1, 2, 3) as listing from ({_HOLDERS}) holders) listed
where listing < 3 or nation = 9
"""

CONTACTS = """
select 'P' || cast(c_custkey as @text) || ' ' as contact_id,
       'C' || cast(c_custkey - c_custkey % 3 as @text) as account_id,
       case when c_nationkey % 5 = 0 then null else split_part(c_name, '#', 1) end as first_name,
       case when c_nationkey % 10 = 0 then '' else ' ' || split_part(c_name, '#', 2) || ' ' end
         as last_name,
       c_mktsegment as title,
       upper(c_name) || '@EXAMPLE.COM ' as email,
       case when c_nationkey = 3 then '' else '+1 555 ' || cast(c_custkey as @text) end as phone,
       'https://people.example/' || cast(c_custkey as @text) as linkedin_url,
       cast('2024-01-30' as date) as snapshot_date,
       'crm_contacts_2024-01-30.csv' as _source_file,
       cast('2024-01-30 23:05:00' as timestamp) as _loaded_at
from @customer
"""

OPPORTUNITIES = f"""
select 'O' || cast(o_orderkey as @text) as opportunity_id,
       'C' || cast(o_custkey as @text) || ' ' as account_id,
       case when o_orderstatus = 'P' and o_orderpriority = '5-LOW' then ''
            when price > 499000 then 'NO-SUCH-SKU'
            else 'SKU' || cast(o_orderkey % 200 as @text) end as product_sku,
       case when night = 1 then 'Prospecting'
            when o_orderstatus = 'F' and o_orderpriority = '1-URGENT' then ' Closed Won'
            when o_orderstatus = 'P' and o_orderpriority = '2-HIGH' then 'Negotiation'
            when o_orderstatus = 'O' and o_orderpriority = '2-HIGH' and price > 400000 then ''
            else 'Closed Lost ' end as stage,
       'rep_' || o_orderstatus as owner,
       case when o_orderpriority = '1-URGENT' then 'New Business' else 'Renewal' end as type,
       {_dmy('opened + 60')} as expected_close_date,
       case when night = 1 or o_orderpriority = '2-HIGH' then ' '
            when o_orderpriority = '3-MEDIUM' and o_orderstatus = 'F' then '31/02/2024'
            else {_dmy('opened + 45')} end as closed_date,
       cast(opened + 20 as @text) as last_activity_date,
       case when o_orderpriority = '4-NOT SPECIFIED' and o_orderstatus = 'O' then {_dmy('opened')}
            else cast(opened as @text) end as created_date,
       case when o_orderpriority = '5-LOW' and o_orderstatus = 'F' then ''
            when o_orderpriority = '5-LOW' and o_orderstatus = 'O' then 'n/a'
            when o_orderpriority = '3-MEDIUM' then chr(9) || ' GBP ' || cast(price as @text) || ' '
            else {_gbp('o_totalprice')} end as value_gbp,
       case when night = 1 then cast('2024-01-29' as date)
            else cast('2024-01-30' as date) end as snapshot_date,
       case when night = 1 then 'crm_opportunities_2024-01-29.csv'
            else 'crm_opportunities_2024-01-30.csv' end as _source_file,
       case when night = 1 then cast('2024-01-29 23:10:00' as timestamp)
            else cast('2024-01-30 23:10:00' as timestamp) end as _loaded_at
from (select *, cast(o_orderdate as date) as opened,
             cast(o_totalprice as decimal(18,2)) as price, @each(1, 2) as night
      from @orders) nightly
"""

PRODUCTS = """
select ' SKU' || cast(p_partkey as @text) as sku_id, p_name || ' ' as product_name,
       p_brand as company, lower(p_type) as variant, p_type as category,
       p_size as bottle_size_cl, cast(40 + p_size % 8 as double) as abv_pct,
       p_retailprice as list_price_gbp, 6 as pack_size, cast('2020-01-01' as date) as launch_date
from @part
"""

SNAPSHOTS = """
select user_id as account_id, cast(ts as date) as snapshot_date, ts as _loaded_at,
       event_type as status, value as amount, event_id
from @events
"""

FEEDS = {
    "sales": SALES,
    "accounts": ACCOUNTS,
    "contacts": CONTACTS,
    "opportunities": OPPORTUNITIES,
    "products": PRODUCTS,
    "snapshots": SNAPSHOTS,
}


def feed_sql(name: str, engine: str) -> str:
    """A feed in one engine's spelling; Spark tables come as ``{table}`` slots."""
    words = DIALECT[engine]
    text = FEEDS[name].replace("@text", words["text"])
    for word in ("each", "grouped"):
        text = re.sub(rf"@{word}\(([^()]*)\)", lambda m: words[word].format(m[1]), text)
    for table in TABLES:
        text = text.replace(f"@{table}", f"{{{table}}}" if engine == "spark" else table)
    return text.strip()


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A test table. A million narrow rows can be one row group, and so one task's
    work however often a feed multiplies and widens them: such tables are dealt out
    by the whole row first."""
    table = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return table.repartition(*table.columns) if name in DEALT else table


def feed(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    text = feed_sql(name, "spark")
    used = {t: read_table(spark, sf_dir, t) for t in TABLES if f"{{{t}}}" in text}
    return spark.sql(text, **used)


def write_exports(rows: DataFrame, folder: str, name: str) -> None:
    """A feed as its source would export it: one CSV file per night, named by it."""
    spark = rows.sparkSession
    options = {"header": "true", "escape": '"', "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
    rows.repartition("snapshot_date").write.partitionBy("snapshot_date").options(**options).csv(f"{folder}/written")
    root = spark._jvm.org.apache.hadoop.fs.Path(folder)
    system = root.getFileSystem(spark._jsc.hadoopConfiguration())
    for night in folder_names(spark, f"{folder}/written"):
        (part,) = system.globStatus(spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/written/{night}/part-*"))
        named = f"{folder}/crm_{name}_{night.removeprefix('snapshot_date=')}.csv"
        system.rename(part.getPath(), spark._jvm.org.apache.hadoop.fs.Path(named))
