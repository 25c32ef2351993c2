"""DuckDB SQL for every registered query, written apart from the Spark plans.

The stand-in feeds are the common ground; everything above them is SQL of its
own. Cleaning queries are held against the undamaged columns of the base tables
instead, so the parsers of one engine are not checked with those of the other.
"""

from __future__ import annotations

from testbed.feeds import POLICY, feed_sql
from testbed.queries import AUDIT_TEXT, EQUAL_LOSSES, NO_LOSSES


def _trim(c: str) -> str:
    return rf"regexp_replace({c}, '^[\s\p{{Z}}]+|[\s\p{{Z}}]+$', '', 'g')"


def _clean(c: str) -> str:
    return f"nullif({_trim(c)}, '')"


def _money(c: str) -> str:
    return rf"try_cast(regexp_replace({_clean(c)}, '[^0-9.\-]', '', 'g') as decimal(38,9))"


def _date(c: str, layout: str) -> str:
    pattern = {"uk": "%d/%m/%Y", "iso": "%Y-%m-%d"}[layout]
    return f"cast(try_strptime({_clean(c)}, '{pattern}') as date)"


def _whole(c: str) -> str:
    return f"format('{{:,.0f}}', cast({c} as double))"


def _listed(column: str, values) -> str:
    return f"list_contains({list(values)!r}, {column})"


def _doubles(*names: str) -> str:
    return ", ".join(f"cast({n} as double) as {n}" for n in names)


def _texts(*names: str) -> str:
    return ", ".join(f"cast({n} as varchar) as {n}" for n in names)


def _ratio(a: str, b: str) -> str:
    return f"cast({a} as double) / nullif(cast({b} as double), 0)"


# Columns of an account export.
EXPORTED = (
    "account_id account_name city address store_number segment account_owner status "
    "contract_start_date last_activity_date created_date annual_target_gbp"
).split()
CATS = POLICY.categories
NAME = _trim("upper(category_name)")
# Both are looked up, by name, in what the policy lists.
GROUPS = dict.fromkeys(CATS.other, "GIN_OTHER") | dict.fromkeys(CATS.premium, "GIN_PREMIUM")
DETAILS = {name: CATS.aliases.get(name, name) for name in CATS.listed}
GROUP = f"coalesce(map {GROUPS!r}[{NAME}], 'NON_GIN')"
DETAIL = f"map {DETAILS!r}[{NAME}]"


def _dedup(source: str, key: str, fields: str) -> str:
    """One raw row per cleaned key and night; its columns, by name, settle ties."""
    texts = ", ".join(f"{c} nulls first" for c in sorted(fields.split()))
    return f"""select * from {source} qualify row_number() over (
        partition by {_clean(key)}, snapshot_date order by _loaded_at desc, {texts}) = 1"""


# The wording of labels and sentences, by tier and by kind of target.
LABELS = [
    "buys premium gin at scale (>= ${floor})",
    "gin demand, below the ${floor} premium-gin floor",
    "no gin traction",
    "no market match -- CRM evidence only",
]
AT_SCALE = "${} premium gin over {} orders, {}% of its gin spend"
BELOW = "${} gin spend, {}"
SOME = "but only ${} of it premium tier -- below the ${floor} floor"
NONE = "none of it premium tier -- switch target"
SIZE_ONLY = "${} total liquor spend, no gin purchases in the window"
NO_KEY = "no Iowa store matched (no store_number on the account)"
DEAD_KEY = "no Iowa store matched (store_number {} not in the market data)"
PROSPECT = "open prospect, owned by {}, GBP {} open pipeline"
LOST = "PREVIOUSLY LOST -- demoted within tier; owned by {}"
# What an account counts as, by the first of these stages it has.
STATES = {"won": "closed_won", "open": "open", "lost": "closed_lost", "": "no_opportunity"}
KINDS = {"open": "known_prospect", "closed_lost": "previous_loss"}


def _mart_ctes(suffix: str, policy) -> dict[str, str]:
    """The scoring chain under one policy: tiers as counts of what an account
    shows, everything that depends on the tier picked from a list by it."""
    floor = str(policy.premium_floor)
    labels = [label.replace("{floor}", floor) for label in LABELS]
    some = SOME.replace("{floor}", floor)
    return {
        f"universe{suffix}": f"""
            select *, coalesce(premium_gin_dollars, 0) as premium, coalesce(total_gin_dollars, 0) as gin,
              coalesce(total_dollars, 0) as spend, coalesce(account_owner, 'unassigned') as owned_by
            from matched left join people using (account_id)
            where not {_listed("crm_state", policy.excluded_states)}""",
        f"scored{suffix}": f"""
            select *, [premium, gin, spend, 0][evidence_tier] as tier_measure,
              {labels!r}[evidence_tier] as evidence_tier_label,
              coalesce(map {KINDS!r}[crm_state], crm_state) as target_type,
              (crm_state = 'closed_lost')::int * {int(policy.demote_closed_lost)}
                as relationship_penalty
            from (select *, 4 - has_market_match::int * (1 + greatest(gin > 0, at_scale)::int
                + at_scale::int) as evidence_tier
              from (select *, premium > 0 and premium >= {floor} as at_scale
                from universe{suffix}))""",
        f"mart{suffix}": f"""
            select *, 1 + count(*) over (order by evidence_tier, relationship_penalty,
                tier_measure desc, coalesce(open_pipeline_gbp, 0) desc, account_id
                rows between unbounded preceding and 1 preceding) as target_rank,
              concat_ws('; ', format('Tier {{}} -- {{}}', evidence_tier, evidence_tier_label),
                [format('{AT_SCALE}', {_whole("premium")}, coalesce(premium_gin_order_lines, 0),
                    printf('%.0f', coalesce(premium_share_of_gin, 0) * 100)),
                  format('{BELOW}', {_whole("gin")},
                    if(premium > 0, format('{some}', {_whole("premium")}), '{NONE}')),
                  format('{SIZE_ONLY}', {_whole("spend")}),
                  coalesce(format('{DEAD_KEY}', store_number), '{NO_KEY}')][evidence_tier],
                coalesce(map {{'known_prospect': format('{PROSPECT}', owned_by,
                    {_whole("coalesce(open_pipeline_gbp, 0)")}),
                  'previous_loss': format('{LOST}', owned_by)}}[target_type], target_type)
              ) as rank_rationale
            from scored{suffix}""",
    }


CTES: dict[str, str] = {
    **{f"{name}_raw": feed_sql(name, "duckdb") for name in (
        "sales", "accounts", "contacts", "opportunities", "products", "snapshots")},
    "accounts_picked": _dedup("accounts_raw", "account_id", """
        account_id account_name city address store_number segment account_owner status
        contract_start_date last_activity_date created_date annual_target_gbp _source_file"""),
    "accounts": f"""
        select {_clean('account_id')} as account_id, {_clean('account_name')} as account_name,
          {_clean('city')} as city, {_clean('address')} as address,
          {_clean('store_number')} as store_number, {_clean('segment')} as segment,
          {_clean('account_owner')} as account_owner, {_clean('status')} as status,
          {_date('contract_start_date', 'uk')} as contract_start_date,
          {_date('last_activity_date', 'iso')} as last_activity_date,
          {_date('created_date', 'iso')} as created_date,
          {_money('annual_target_gbp')} as annual_target_gbp,
          snapshot_date, _source_file, _loaded_at
        from accounts_picked""",
    "opportunities": f"""
        select {_clean('opportunity_id')} as opportunity_id, {_clean('account_id')} as account_id,
          {_clean('product_sku')} as product_sku, {_clean('stage')} as stage,
          {_clean('owner')} as owner, {_clean('type')} as opportunity_type,
          {_date('expected_close_date', 'uk')} as expected_close_date,
          {_date('closed_date', 'uk')} as closed_date,
          {_date('last_activity_date', 'iso')} as last_activity_date,
          {_date('created_date', 'iso')} as created_date, {_money('value_gbp')} as value_gbp,
          case {_clean('stage')} when 'Closed Won' then 'won' when 'Closed Lost' then 'lost'
            else 'open' end as stage_group,
          snapshot_date, _source_file, _loaded_at
        from opportunities_raw""",
    "contacts": f"""
        select {_clean('contact_id')} as contact_id, {_clean('account_id')} as account_id,
          {_clean('first_name')} as first_name, {_clean('last_name')} as last_name,
          {_clean('title')} as title, lower({_clean('email')}) as email,
          {_clean('phone')} as phone, {_clean('linkedin_url')} as linkedin_url,
          {_trim(f"coalesce({_clean('first_name')}, '') || ' ' || coalesce({_clean('last_name')}, '')")}
            as full_name,
          snapshot_date, _source_file, _loaded_at
        from contacts_raw""",
    "products": f"""
        select {_trim('sku_id')} as sku_id, {_trim('product_name')} as product_name,
          {_trim('company')} as company, {_trim('variant')} as variant,
          {_trim('category')} as category, bottle_size_cl, abv_pct, list_price_gbp, pack_size,
          launch_date
        from products_raw""",
    "rollup": f"""
        with lines as (
          select * replace (cast(sale_dollars as decimal(18,2)) as sale_dollars,
              cast(volume_sold_liters as decimal(18,3)) as volume_sold_liters),
            cast(year(date) as int) as year, {GROUP} as cat_group, {DETAIL} as gin_category
          from sales_raw where date >= date '{POLICY.sales_start}'),
        newest as (
          select store_number, year, cat_group, gin_category, store_name, address, city, county
          from lines qualify row_number() over (
            partition by store_number, year, cat_group, gin_category
            order by date desc, store_name desc nulls last, address desc nulls last,
              city desc nulls last, county desc nulls last) = 1),
        sums as (
          select store_number, year, cat_group, gin_category,
            sum(sale_dollars) as net_sale_dollars,
            sum(case when bottles_sold > 0 then sale_dollars else 0 end) as gross_sale_dollars,
            sum(case when bottles_sold < 0 then sale_dollars else 0 end) as returns_dollars,
            sum(volume_sold_liters) as net_volume_liters,
            cast(sum(bottles_sold) as bigint) as net_bottles,
            count(*) filter (bottles_sold < 0) as return_lines, count(*) as order_lines,
            max(date) as last_purchase_date
          from lines group by all)
        select sums.*, newest.store_name, newest.address, newest.city, newest.county
        from sums join newest on sums.store_number = newest.store_number
          and sums.year = newest.year and sums.cat_group = newest.cat_group
          and sums.gin_category is not distinct from newest.gin_category""",
    "windowed": f"select * from rollup where year in ({', '.join(map(str, POLICY.window_years))})",
    "per_group": """
        select store_number, cat_group, sum(net_sale_dollars) as dollars,
          sum(net_bottles) as bottles, sum(order_lines) as lines, max(last_purchase_date) as last
        from windowed group by store_number, cat_group""",
    "per_store": """
        select store_number, sum(dollars) as total_dollars, max(last) as last_purchase_date
        from per_group group by store_number""",
    "named_stores": """
        select store_number, unnest(first({'store_name': store_name, 'address': address,
            'city': city, 'county': county} order by year desc, net_sale_dollars desc,
            cat_group, gin_category))
        from windowed group by store_number""",
    "stores": f"""
        select *, premium_gin_dollars + other_gin_dollars as total_gin_dollars,
          {_ratio('premium_gin_dollars', 'premium_gin_dollars + other_gin_dollars')}
            as premium_share_of_gin,
          {_ratio('premium_gin_dollars + other_gin_dollars', 'total_dollars')}
            as gin_share_of_store,
          {_ratio('premium_gin_dollars', 'premium_gin_bottles')} as premium_gin_dollars_per_bottle
        from (select named_stores.*, total_dollars, last_purchase_date,
            coalesce(p.dollars, 0) as premium_gin_dollars,
            coalesce(o.dollars, 0) as other_gin_dollars,
            coalesce(n.dollars, 0) as non_gin_dollars,
            coalesce(p.bottles, 0)::bigint as premium_gin_bottles,
            coalesce(p.lines, 0)::bigint as premium_gin_order_lines,
            p.last as last_premium_gin_purchase_date
          from named_stores join per_store using (store_number)
          left join (from per_group where cat_group = 'GIN_PREMIUM') p using (store_number)
          left join (from per_group where cat_group = 'GIN_OTHER') o using (store_number)
          left join (from per_group where cat_group = 'NON_GIN') n using (store_number))""",
    # Opportunities of the night by account and stage, then what an account shows by looking stages up.
    "by_stage": """
        select account_id, stage_group, count(*) as n, sum(value_gbp) as amount, max(last_activity_date) as day
        from opportunities semi join (select max(snapshot_date) as snapshot_date from accounts_raw)
          using (snapshot_date) group by all""",
    "shown": """
        select account_id, list(stage_group) as stages, map_from_entries(list((stage_group, amount))) as amounts,
          sum(n) as many, max(day) as day from by_stage group by account_id""",
    "rolled": """
        select account_id, cast(many as bigint) as opportunity_count,
          'won' in stages as has_won_opportunity, 'open' in stages as has_open_opportunity,
          'lost' in stages as has_lost_opportunity,
          if(stages = ['open'], amounts['open'], coalesce(amounts['open'], 0)) as open_pipeline_gbp,
          day as last_opportunity_activity_date
        from shown""",
    "current": f"""
        select * exclude (created_date, snapshot_date, _source_file, _loaded_at, stages)
            replace (coalesce(opportunity_count, 0) as opportunity_count,
              'won' in coalesce(stages, []) as has_won_opportunity,
              'open' in coalesce(stages, []) as has_open_opportunity,
              'lost' in coalesce(stages, []) as has_lost_opportunity),
          snapshot_date as crm_as_of_date,
          {list(STATES.values())!r}[coalesce(list_min(list_transform(stages,
            lambda stage: list_position({list(STATES)!r}, stage))), {len(STATES)})] as crm_state
        from accounts semi join (select max(snapshot_date) as snapshot_date from accounts_raw)
            using (snapshot_date)
          left join (from rolled join (select account_id, stages from shown) using (account_id))
            using (account_id)""",
    "titled": f"""
        select *, coalesce(list_position({list(POLICY.title_precedence)!r}, title), 1000) as place
        from contacts semi join (select max(snapshot_date) as snapshot_date from contacts)
          using (snapshot_date)""",
    "people": """
        select account_id, contact_id, full_name as contact_name, title as contact_title,
          email as contact_email, phone as contact_phone, linkedin_url as contact_linkedin_url
        from titled join (select account_id, place, min(contact_id) as contact_id from titled
            join (select account_id, min(place) as place from titled group by account_id)
              using (account_id, place) group by account_id, place)
          using (account_id, place, contact_id)""",
    "prospects": """
        select * rename (segment as crm_segment, status as crm_status,
            last_activity_date as crm_last_activity_date)
        from current""",
    "matched": """
        select p.* replace (coalesce(p.city, s.city) as city,
            coalesce(p.address, s.address) as address),
          s.* exclude (store_number, city, address), true as has_market_match
        from prospects p join stores s using (store_number)
        union all by name
        select *, false as has_market_match from prospects anti join stores using (store_number)""",
    **_mart_ctes("", POLICY),
    **_mart_ctes("_without_losses", NO_LOSSES),
    **_mart_ctes("_equal_losses", EQUAL_LOSSES),
    "failed_dates": " union all ".join(
        f"""select snapshot_date, '{table}_snapshots' as source_table,
              '{column}' as source_column, '{layout}' as expected_format,
              {column} as unparseable_value
            from {table}_raw
            where {_clean(column)} is not null and {_date(column, layout)} is null"""
        for table, column, layout in (
            ("accounts", "contract_start_date", "uk"),
            ("accounts", "last_activity_date", "iso"),
            ("accounts", "created_date", "iso"),
            ("opportunities", "expected_close_date", "uk"),
            ("opportunities", "closed_date", "uk"),
            ("opportunities", "last_activity_date", "iso"),
            ("opportunities", "created_date", "iso"),
        )
    ),
    "failed_money": " union all ".join(
        f"""select snapshot_date, '{table}_snapshots' as source_table,
              '{column}' as source_column, {column} as unparseable_value
            from {table}_raw
            where {_clean(column)} is not null and {_money(column)} is null"""
        for table, column in (("accounts", "annual_target_gbp"), ("opportunities", "value_gbp"))
    ),
    "disagreeing": f"""
        select account_id, cast(snapshot_date as varchar) as snapshot_date,
          count(*) as duplicate_rows, count(distinct facts) as distinct_versions
        from (select {_clean('account_id')} as account_id, snapshot_date,
            to_json(struct_pack({', '.join(f"{c} := {_clean(c)}" for c in (
                'account_name', 'city', 'address', 'store_number', 'segment', 'account_owner',
                'contract_start_date', 'annual_target_gbp', 'last_activity_date', 'created_date',
                'status'))})) as facts from accounts_raw)
        group by 1, 2 having count(distinct facts) > 1""",
    "trend": f"""
        select year, cat_group, sum(net_sale_dollars) as dollars,
          count(distinct store_number) as stores, {_ratio('sum(net_sale_dollars)',
          'count(distinct store_number)')} as per_store
        from rollup where cat_group <> 'NON_GIN'
          and year in ({', '.join(map(str, POLICY.trend_years))})
        group by year, cat_group""",
    "breaches": """
        select l.account_id, l.account_name, l.evidence_tier, l.target_rank, worst_live_rank
        from mart l join (select evidence_tier, max(target_rank) as worst_live_rank from mart
            where relationship_penalty = 0 group by 1) w on l.evidence_tier = w.evidence_tier
        where l.relationship_penalty = 1 and l.target_rank < worst_live_rank""",
}


def _needed(text: str, seen: list[str]) -> list[str]:
    """Names of the building blocks a text mentions, each after its own needs."""
    words = set(text.replace("(", " ").replace(")", " ").replace(",", " ").split())
    for name in CTES:
        if name in words and name not in seen:
            _needed(CTES[name], seen)
            if name not in seen:
                seen.append(name)
    return seen


def _sql(text: str, **local: str) -> str:
    body = " ".join([*local.values(), text])
    parts = [f"{n} as ({CTES[n]})" for n in _needed(body, [])]
    parts += [f"{n} as ({t})" for n, t in local.items()]
    return (f"with {', '.join(parts)} " if parts else "") + text


MART_COLUMNS = f"""
    cast(target_rank as bigint) as target_rank, target_rank <= {POLICY.list_size} as is_top_target,
    account_id, account_name, target_type, evidence_tier, evidence_tier_label,
    relationship_penalty, crm_status, crm_segment, crm_state, account_owner,
    {_doubles('open_pipeline_gbp', 'annual_target_gbp')}, opportunity_count,
    {_texts('crm_last_activity_date', 'crm_as_of_date')}, contact_name, contact_title,
    contact_email, contact_phone, contact_linkedin_url, has_market_match, store_number,
    store_name, city, county, address, {_doubles('tier_measure', 'premium_gin_dollars',
    'other_gin_dollars', 'total_gin_dollars', 'non_gin_dollars', 'total_dollars')},
    {_doubles('premium_gin_bottles', 'premium_gin_order_lines')}, premium_share_of_gin,
    gin_share_of_store, premium_gin_dollars_per_bottle, {_texts('last_premium_gin_purchase_date',
    'last_purchase_date')}, rank_rationale"""

TOP = f"target_rank <= {POLICY.list_size}"

ROLLUP_COLUMNS = f"""
    store_number, store_name, address, city, county, year, cat_group, gin_category,
    {_doubles('net_sale_dollars', 'gross_sale_dollars', 'returns_dollars', 'net_volume_liters')},
    net_bottles, return_lines, order_lines, {_texts('last_purchase_date')}"""


def _shown(symbol: str, c: str) -> str:
    return f"case when {c} is null then '-' else '{symbol}' || {_whole(c)} end"


def _suite() -> str:
    """One row per declared check, from a list of (model, check, column, violations)."""
    rows = []

    def where(model: str, table: str, check: str, column: str, condition: str) -> None:
        rows.append((model, check, column, f"select count(*) from {table} where {condition}"))

    def keyed(model: str, table: str, check: str, columns: str, condition: str = "true") -> None:
        rows.append((model, check, columns.replace(", ", ","), f"""select count(*) from (select 1
            from {table} where {condition} group by {columns} having count(*) > 1)"""))

    def null(model: str, table: str, *columns: str) -> None:
        for c in columns:
            where(model, table, "not_null", c, f"{c} is null")

    def unique(model: str, table: str, *columns: str) -> None:
        for c in columns:
            keyed(model, table, "unique", c, f"{c} is not null")

    def accepted(model: str, table: str, column: str, values) -> None:
        where(model, table, "accepted_values", column, f"not {_listed(column, values)}")

    def bounded(model: str, table: str, column: str, condition: str) -> None:
        where(model, table, "accepted_range", column, condition)

    def refers(model: str, table: str, column: str, parent: str, field: str) -> None:
        where(model, table, "relationships", column, f"""{column} is not null and not exists
            (select 1 from {parent} p where p.{field} = {table}.{column})""")

    keyed("accounts", "accounts", "unique_combination", "account_id, snapshot_date")
    null("accounts", "accounts", "account_id", "snapshot_date")
    accepted("accounts", "accounts", "status", POLICY.statuses)
    accepted("accounts", "accounts", "segment", POLICY.segments)
    bounded("accounts", "accounts", "annual_target_gbp", "annual_target_gbp < 0")
    keyed("opportunities", "opportunities", "unique_combination", "opportunity_id, snapshot_date")
    null("opportunities", "opportunities", "opportunity_id", "snapshot_date", "account_id")
    refers("opportunities", "opportunities", "account_id", "accounts", "account_id")
    refers("opportunities", "opportunities", "product_sku", "products", "sku_id")
    accepted("opportunities", "opportunities", "stage", POLICY.stages)
    accepted("opportunities", "opportunities", "stage_group", ("won", "lost", "open"))
    bounded("opportunities", "opportunities", "value_gbp", "value_gbp < 0")
    keyed("contacts", "contacts", "unique_combination", "contact_id, snapshot_date")
    null("contacts", "contacts", "contact_id", "snapshot_date", "account_id")
    refers("contacts", "contacts", "account_id", "accounts", "account_id")
    unique("products", "products", "sku_id")
    null("products", "products", "sku_id", "list_price_gbp")
    keyed("market", "rollup", "unique_combination", "store_number, year, cat_group, gin_category")
    null("market", "rollup", "store_number", "cat_group")
    accepted("market", "rollup", "cat_group", CATS.groups)
    accepted("market", "rollup", "gin_category", CATS.details)
    bounded("market", "rollup", "year", f"year < {POLICY.sales_start[:4]}")
    unique("accounts_current", "current", "account_id", "store_number")
    null("accounts_current", "current", "account_id", "crm_state", "crm_as_of_date")
    accepted("accounts_current", "current", "crm_state",
             ("closed_won", "open", "closed_lost", "no_opportunity"))
    unique("primary_contact", "people", "account_id")
    null("primary_contact", "people", "account_id", "contact_name")
    unique("store_recent_sales", "stores", "store_number")
    null("store_recent_sales", "stores", "store_number", "premium_gin_dollars")
    bounded("store_recent_sales", "stores", "premium_share_of_gin",
            "premium_share_of_gin < 0 or premium_share_of_gin > 1")
    unique("target_accounts", "mart", "target_rank", "account_id", "store_number")
    null("target_accounts", "mart", "target_rank", "account_id", "has_market_match",
         "evidence_tier", "relationship_penalty", "tier_measure", "target_type", "rank_rationale")
    where("target_accounts", "mart", "not_null", "is_top_target", "target_rank is null")
    refers("target_accounts", "mart", "account_id", "current", "account_id")
    accepted("target_accounts", "mart", "evidence_tier", (1, 2, 3, 4))
    accepted("target_accounts", "mart", "relationship_penalty", (0, 1))
    bounded("target_accounts", "mart", "tier_measure", "tier_measure < 0")
    bounded("target_accounts", "mart", "premium_gin_dollars", "premium_gin_dollars < 0")
    accepted("target_accounts", "mart", "target_type",
             ("known_prospect", "previous_loss", "no_opportunity"))
    where("accounts_raw", "disagreeing", "duplicates_agree", "", "true")
    where("raw_feeds", "failed_dates", "dates_parse", "", "true")
    where("raw_feeds", "failed_money", "money_parses", "", "true")
    where("target_accounts", "mart", "no_excluded_state", "", "crm_state = 'closed_won'")
    where("target_accounts", "breaches", "lost_demoted", "", "true")
    counted = " union all ".join(
        f"select '{model}' as model, '{check}' as check_name, '{column}' as column_name, "
        f"({count}) as violations"
        for model, check, column, count in rows
    )
    return f"select *, violations = 0 as passed from ({counted})"


SQL: dict[str, str] = {
    # Cleaning: the expected values come from the base tables, not from a parser.
    "clean_string": """
        with holders as (
          select 'C' || c_custkey as id, c_name as name, c_nationkey as nation from customer
          union all select 'S' || s_suppkey, s_name, s_nationkey from supplier),
        nights as (
          select *, '2024-01-29' as night from holders union all
          select *, '2024-01-30' from holders union all
          select *, '2024-01-30' from holders where nation = 9)
        select id as account_id, name as account_name, cast(length(name) as int) as name_length,
          case when nation >= 5 then nation || ' Main Street' end as address,
          night as snapshot_date
        from nights""",
    "parse_money": """
        select 'O' || o_orderkey as opportunity_id, night as snapshot_date,
          case when o_orderpriority = '5-LOW' and o_orderstatus in ('F', 'O') then null
            else cast(cast(o_totalprice as decimal(18,2)) as double) end as value_gbp
        from orders, (values ('2024-01-29'), ('2024-01-30')) nights(night)""",
    "parse_dates": """
        select 'O' || o_orderkey as opportunity_id, night as snapshot_date,
          cast(d + 60 as varchar) as expected_close_date,
          case when night = '2024-01-29' or o_orderpriority = '2-HIGH'
              or (o_orderpriority = '3-MEDIUM' and o_orderstatus = 'F') then null
            else cast(d + 45 as varchar) end as closed_date,
          cast(d + 20 as varchar) as last_activity_date,
          case when o_orderpriority = '4-NOT SPECIFIED' and o_orderstatus = 'O' then null
            else cast(d as varchar) end as created_date
        from (select *, cast(o_orderdate as date) as d from orders),
          (values ('2024-01-29'), ('2024-01-30')) nights(night)""",
    "stage_accounts": _sql(f"""
        select account_id, account_name, city, address, store_number, segment, account_owner,
          status, {_texts('contract_start_date', 'last_activity_date', 'created_date')},
          {_doubles('annual_target_gbp')}, {_texts('snapshot_date')}, _source_file,
          {_texts('_loaded_at')} from accounts"""),
    "stage_contacts": _sql(f"""
        select contact_id, account_id, first_name, last_name, title, email, phone, linkedin_url,
          full_name, {_texts('snapshot_date')}, _source_file, {_texts('_loaded_at')}
        from contacts"""),
    "stage_opportunities": _sql(f"""
        select opportunity_id, account_id, product_sku, stage, owner, opportunity_type,
          {_texts('expected_close_date', 'closed_date', 'last_activity_date', 'created_date')},
          {_doubles('value_gbp')}, stage_group, {_texts('snapshot_date')}, _source_file,
          {_texts('_loaded_at')} from opportunities"""),
    "stage_products": _sql(f"select * replace ({_texts('launch_date')}) from products"),
    "stage_market": _sql(f"select {ROLLUP_COLUMNS} from rollup"),
    "dedup_snapshots": _sql(f"""
        select account_id, {_texts('snapshot_date', '_loaded_at')}, status, amount, event_id
        from snapshots_raw qualify row_number() over (partition by account_id, snapshot_date
          order by _loaded_at desc, status, amount, event_id) = 1"""),
    "snapshot_name_parse": _sql("""
        select distinct 'landing/crm_' || status || '_' || snapshot_date
            || case when status = 'error' then '.txt' else '.csv' end as uri,
          case when status <> 'error' then cast(snapshot_date as varchar) end as snapshot_date
        from snapshots_raw"""),
    "ingest_gap": _sql("""
        select cast(snapshot_date as varchar) as snapshot_date from nights
        where n < (select avg(n) from nights)""",
        nights="select snapshot_date, count(*) as n from snapshots_raw group by 1"),
    "snapshot_counts": _sql("""
        select cast(snapshot_date as varchar) as snapshot_date, count(*) as row_count
        from snapshots_raw group by 1"""),
    "streamed_snapshot_counts": """
        select cast(cast(ts as date) as varchar) as snapshot_date, count(*) as row_count
        from events group by 1""",
    "streamed_exports": _sql(f"""
        select cast(snapshot_date as varchar) as snapshot_date, count(*) as row_count,
          count(distinct account_id) as accounts,
          cast(sum(length(concat_ws('|', {", ".join(f"coalesce({c}, '')" for c in EXPORTED)}))) as bigint) as characters,
          'crm_accounts_' || cast(snapshot_date as varchar) || '.csv' as file_name
        from accounts_raw group by snapshot_date"""),
    "snapshot_inventory": _sql("""
        select count(distinct snapshot_date) as snapshots, count(*) as row_count
        from snapshots_raw"""),
    "category_classify": _sql(f"""
        select category_name, count(*) as line_count, {GROUP} as cat_group,
          {DETAIL} as gin_category from sales_raw group by category_name"""),
    "category_audit": _sql(f"""
        select {NAME} as category_name, contains({NAME}, '{AUDIT_TEXT}') as has_text,
          {_listed(NAME, CATS.listed)} as is_listed, count(*) as line_count
        from sales_raw where category_name is not null group by 1, 2, 3
        having has_text <> is_listed"""),
    "sales_rollup": _sql(f"select {ROLLUP_COLUMNS} from rollup"),
    "latest_attributes": _sql("""
        select store_number, cast(date as varchar) as date, store_name, address, city, county
        from sales_raw qualify row_number() over (partition by store_number order by date desc,
          store_name desc nulls last, address desc nulls last, city desc nulls last,
          county desc nulls last) = 1"""),
    "store_recent_sales": _sql(f"""
        select store_number, store_name, address, city, county, {_doubles('premium_gin_dollars',
          'other_gin_dollars', 'total_gin_dollars', 'non_gin_dollars', 'total_dollars')},
          {_doubles('premium_gin_bottles', 'premium_gin_order_lines')},
          {_texts('last_premium_gin_purchase_date', 'last_purchase_date')},
          premium_share_of_gin, gin_share_of_store, premium_gin_dollars_per_bottle from stores"""),
    "store_ratios": _sql("""
        select store_number, premium_share_of_gin, gin_share_of_store,
          premium_gin_dollars_per_bottle from stores"""),
    "opportunity_rollup": _sql(f"""
        select * replace ({_doubles('open_pipeline_gbp')},
          {_texts('last_opportunity_activity_date')}) from rolled"""),
    "accounts_current": _sql(f"""
        select * replace ({_doubles('annual_target_gbp', 'open_pipeline_gbp')},
          {_texts('contract_start_date', 'last_activity_date', 'crm_as_of_date',
          'last_opportunity_activity_date')}) from current"""),
    "primary_contact": _sql("select * from people"),
    "late_feeds": _sql("""
        select feed from (
          select 'accounts' as feed, count(*) filter (snapshot_date = night) as n
          from accounts_raw, (select min(snapshot_date) as night from accounts_raw)
          union all select 'opportunities', count(*) filter (snapshot_date = night)
          from opportunities_raw, (select min(snapshot_date) as night from accounts_raw)
          union all select 'contacts', count(*) filter (snapshot_date = night)
          from contacts_raw, (select min(snapshot_date) as night from accounts_raw))
        where n = 0"""),
    "match_flag": _sql("""
        select account_id, store_number, has_market_match, store_name, city, address
        from matched"""),
    "evidence_tier": _sql(f"""
        select account_id,
          case when not has_market_match then 4
            when premium_gin_dollars >= {POLICY.premium_floor} then 1
            when total_gin_dollars > 0 then 2 else 3 end as tier,
          case when not has_market_match then 4 when premium_gin_dollars > 0 then 1
            when total_gin_dollars > 0 then 2 else 3 end as tier_any_premium,
          case when crm_state = 'closed_lost' then 1 else 0 end as penalty, 0 as penalty_off
        from matched"""),
    "tier_measure": _sql(f"""
        select account_id, evidence_tier, evidence_tier_label, {_doubles('tier_measure')},
          target_type from scored"""),
    "rank_rationale": _sql("select account_id, rank_rationale from mart"),
    "target_rank": _sql("select target_rank, account_id from mart"),
    "target_mart": _sql(f"select {MART_COLUMNS} from mart"),
    "target_mart_without_losses": _sql(f"select {MART_COLUMNS} from mart_without_losses"),
    "target_mart_equal_losses": _sql(f"select {MART_COLUMNS} from mart_equal_losses"),
    "top_targets": _sql(f"""
        select account_id, account_name, evidence_tier, {_doubles('tier_measure')}
        from mart where {TOP}"""),
    "call_sheet": _sql(f"""
        select target_rank as "#", evidence_tier as "T", account_name[1:32] as "Account",
          array_to_string(list_transform(regexp_extract_all(lower(city), '[a-z]+|[^a-z]'),
            lambda w: upper(w[1]) || w[2:]), '') as "City",
          {_shown('$', 'tier_measure')} as "Gin $",
          cast(round_even(coalesce(premium_share_of_gin, 0) * 100, 0) as bigint) || '%' as "prem %",
          crm_segment as "Store Segment", account_owner as "Owner", contact_name as "Contact",
          {_shown('£', 'open_pipeline_gbp')} as "Pipeline"
        from mart where {TOP}"""),
    "duplicates_agree": _sql("select * from disagreeing"),
    "parse_failures": _sql(f"""
        select * replace ({_texts('snapshot_date')}) from failed_dates union all by name
        select * replace ({_texts('snapshot_date')}) from failed_money"""),
    "check_unique": _sql("""
        select 'event_id' as column_name, cast(event_id as varchar) as value,
          count(*) as row_count from snapshots_raw group by event_id having count(*) > 1
        union all select 'account_id', account_id, count(*) from opportunities_raw
        where account_id is not null group by account_id having count(*) > 1"""),
    "check_unique_combo": _sql("""
        select account_id, cast(snapshot_date as varchar) as snapshot_date,
          count(*) as row_count from snapshots_raw group by 1, 2 having count(*) > 1"""),
    "check_not_null": _sql("""
        select column_name, violations from (unpivot (
            select count(*) - count(account_id) as account_id, count(*) - count(city) as city,
              count(*) - count(store_number) as store_number,
              count(*) - count(annual_target_gbp) as annual_target_gbp,
              count(*) - count(contract_start_date) as contract_start_date from accounts)
          on columns(*) into name column_name value violations)
        where violations > 0"""),
    "check_accepted_values": _sql(f"""
        select segment as value, count(*) as row_count from accounts
        where not {_listed('segment', POLICY.segments)} group by segment"""),
    "check_range": _sql("""
        select store_number, premium_share_of_gin from stores
        where premium_share_of_gin < 0 or premium_share_of_gin > 1"""),
    "check_relationships": _sql(f"""
        select opportunity_id, {_texts('snapshot_date')}, product_sku from opportunities o
        where product_sku is not null
          and not exists (select 1 from products p where p.sku_id = o.product_sku)"""),
    "check_universe": _sql("""
        select target_rank, account_id, account_name, store_number, crm_state from mart
        where crm_state in ('closed_won', 'closed_lost')"""),
    "check_demotion": _sql(
        """select l.account_id, l.account_name, l.evidence_tier, l.target_rank, worst_live_rank
           from flagged l join (select evidence_tier, max(target_rank) as worst_live_rank
             from flagged where not lost group by 1) w on l.evidence_tier = w.evidence_tier
           where lost and l.target_rank < worst_live_rank""",
        flagged="""select account_id, account_name, evidence_tier, target_rank,
             crm_state = 'closed_lost' as lost from mart_equal_losses""",
    ),
    "check_suite": _sql(_suite()),
    "category_price": _sql(f"""
        select gin_category, max(cat_group) as cat_group,
          cast(sum(net_sale_dollars) as double) as dollars,
          cast(sum(net_bottles) as bigint) as bottles,
          {_ratio('sum(net_sale_dollars)', 'sum(net_bottles)')} as usd_per_bottle
        from rollup where gin_category is not null group by gin_category"""),
    "price_gap": _sql(f"""
        select premium_price, other_price, premium_price / nullif(other_price, 0) as price_ratio
        from (select
          {_ratio("sum(net_sale_dollars) filter (cat_group = 'GIN_PREMIUM')",
                  "sum(net_bottles) filter (cat_group = 'GIN_PREMIUM')")} as premium_price,
          {_ratio("sum(net_sale_dollars) filter (cat_group = 'GIN_OTHER')",
                  "sum(net_bottles) filter (cat_group = 'GIN_OTHER')")} as other_price
          from rollup)"""),
    "market_trend": _sql(f"select year, cat_group, {_doubles('dollars')}, stores from trend"),
    "market_index": _sql(f"""
        select t.year, t.cat_group, {_ratio('t.dollars', 'b.dollars')} * 100 as dollars_index,
          {_ratio('t.stores', 'b.stores')} * 100 as stores_index,
          {_ratio('t.per_store', 'b.per_store')} * 100 as per_store_index
        from trend t join trend b on t.cat_group = b.cat_group
          and b.year = (select min(year) from trend f where f.cat_group = t.cat_group)"""),
    "market_change": _sql(f"""
        select f.cat_group, cast(f.dollars as double) as dollars_first, f.stores as stores_first,
          f.per_store as per_store_first, cast(l.dollars as double) as dollars_last,
          l.stores as stores_last, l.per_store as per_store_last,
          ({_ratio('l.dollars', 'f.dollars')} - 1) * 100 as dollars_change_pct,
          ({_ratio('l.stores', 'f.stores')} - 1) * 100 as stores_change_pct,
          ({_ratio('l.per_store', 'f.per_store')} - 1) * 100 as per_store_change_pct
        from trend f join trend l on f.cat_group = l.cat_group
        where f.year = {POLICY.trend_years[0]} and l.year = {POLICY.trend_years[-1]}"""),
    "overview": _sql("""
        select count(*) as accounts, cast(max(crm_as_of_date) as varchar) as as_of from mart"""),
    "tier_summary": _sql(f"""
        select evidence_tier, evidence_tier_label, count(*) as accounts,
          count(*) filter ({TOP}) as in_top from mart group by 1, 2"""),
    "concentration": _sql(f"""
        select count(*) as accounts, count(*) filter (has_market_match) as matched,
          cast(sum(case when {TOP} then coalesce(premium_gin_dollars, 0) else 0 end) as double)
            as premium_in_top,
          cast(sum(coalesce(premium_gin_dollars, 0)) as double) as premium_all,
          {_ratio(f"sum(case when {TOP} then coalesce(premium_gin_dollars, 0) else 0 end)",
                  "sum(coalesce(premium_gin_dollars, 0))")} * 100 as top_share_pct
        from mart"""),
    "owner_workload": _sql(f"""
        select account_owner, count(*) as accounts,
          cast(coalesce(sum(open_pipeline_gbp), 0) as double) as pipeline,
          count(*) filter (evidence_tier = 1) as tier1,
          '£' || {_whole('coalesce(sum(open_pipeline_gbp), 0)')} as pipeline_text
        from mart where {TOP} and account_owner is not null group by account_owner"""),
    "segment_mix": _sql(f"""
        select crm_segment, count(*) as accounts from mart
        where {TOP} and crm_segment is not null group by 1"""),
    "match_coverage": _sql(f"""
        select case when has_market_match then 'Matched to an Iowa store'
            when store_number is null then 'No store_number on the account'
            else 'store_number not found in market data' end as match_state,
          count(*) as accounts, count(*) filter ({TOP}) as in_top,
          cast(coalesce(sum(open_pipeline_gbp), 0) as double) as pipeline_gbp,
          '£' || {_whole('coalesce(sum(open_pipeline_gbp), 0)')} as pipeline_text
        from mart group by 1"""),
    "unmatched_summary": _sql(f"""
        select count(*) filter (not has_market_match) as unmatched, count(*) as accounts,
          cast(coalesce(sum(open_pipeline_gbp) filter (not has_market_match), 0) as double)
            as unmatched_pipeline_gbp,
          {_ratio('count(*) filter (not has_market_match)', 'count(*)')} * 100 as unmatched_pct
        from mart"""),
    "previous_losses": _sql(f"""
        select target_rank, evidence_tier, account_name[1:36] as account_name,
          {_shown('$', 'tier_measure')} as measure
        from mart where target_type = 'previous_loss'"""),
    "loss_report": _sql(f"""
        select count(*) as lost_accounts, count(*) filter ({TOP}) as in_top,
          min(target_rank) as best_rank from mart where target_type = 'previous_loss'"""),
    "volume_vs_fit": _sql(
        """select target_rank, '#' || target_rank || ' ' || split_part(account_name, ' - ', 1)[1:22]
             as short_name, cast(tier_measure as double) as volume, prem_pct,
             place <= 3 as is_largest, pure and pure_place = 1 as leads_pure,
             case when pure and pure_place = 1 then cast(pure_count - 1 as double) end
               as other_pure
           from placed""",
        placed="""select *, row_number() over (order by tier_measure desc, target_rank) as place,
             row_number() over (partition by pure order by tier_measure desc, target_rank)
               as pure_place,
             count(*) over (partition by pure) as pure_count
           from (select *, coalesce(premium_share_of_gin, 0) * 100 as prem_pct,
               coalesce(premium_share_of_gin, 0) * 100 >= 99 as pure
             from mart where evidence_tier = 2)""",
    ),
}
