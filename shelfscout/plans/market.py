"""From sales lines to one row per store, and the questions asked of categories."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfscout.functions import exact
from shelfscout.functions.categories import category_name, classify
from shelfscout.functions.scoring import safe_ratio
from shelfscout.policy import CategoryPolicy, TargetingPolicy

STORE_ATTRIBUTES = ["store_name", "address", "city", "county"]
ROLLUP_KEYS = ["store_number", "year", "cat_group", "gin_category"]
ROLLUP_SUMS = [
    "net_sale_dollars",
    "gross_sale_dollars",
    "returns_dollars",
    "net_volume_liters",
    "net_bottles",
    "return_lines",
    "order_lines",
]
AMOUNTS = ROLLUP_SUMS[:5]
COUNTS = ROLLUP_SUMS[5:]
# What the rollup reads of the sales.
SALES_COLUMNS = [
    "store_number",
    *STORE_ATTRIBUTES,
    "date",
    "category_name",
    "sale_dollars",
    "bottles_sold",
    "volume_sold_liters",
]


def sales_partials(sales: DataFrame, policy: TargetingPolicy) -> DataFrame:
    """Sales lines by the rollup's keys and the store attributes together, with sums
    that merge: partials of parts of the sales, taken together, fold into the
    rollup of the whole (``fold_partials``).

    Attributes drift slowly, so this is the reduction that matters, done by hash
    aggregation and combined before the shuffle (a hot store shrinks in every
    task). Sums are exact (``functions.exact``); nothing is rounded before display.
    """
    kinds = {c: sales.schema[c].dataType for c in ("sale_dollars", "bottles_sold", "volume_sold_liters")}
    in_range = sales.where(F.col("date") >= F.lit(policy.sales_start).cast("date"))
    lines = classify(in_range, policy.categories).withColumn("year", F.year("date"))
    for c, kind in kinds.items():
        if exact.in_parts(kind):
            lines = lines.withColumns(exact.line_parts(c, kind))
    units = exact.finite("bottles_sold", kinds["bottles_sold"])

    def sums(c: str, name: str, condition: Column | None = None) -> list[Column]:
        return exact.sums(c, kinds[c], name, condition)

    return lines.groupBy(*ROLLUP_KEYS, *STORE_ATTRIBUTES).agg(
        *sums("sale_dollars", "net_sale_dollars"),
        *sums("sale_dollars", "gross_sale_dollars", units > 0),
        *sums("sale_dollars", "returns_dollars", units < 0),
        *sums("volume_sold_liters", "net_volume_liters"),
        *sums("bottles_sold", "net_bottles"),
        F.count_if(units < 0).alias("return_lines"),
        F.count(F.lit(1)).alias("order_lines"),
        F.max("date").alias("last_purchase_date"),
    )


def fold_partials(partials: DataFrame) -> DataFrame:
    """One row per store, year, category group and category, with the latest attributes.

    Attribute variants, of one load or of many, fold into the latest one, on the
    already small partials and again combined before the shuffle, so that even a
    store whose name changes on every line cannot flood one task. Texts in the
    result make this a sort, which a hash of the keys in front of them settles by
    one number a row instead of by texts.
    """
    columns = partials.columns
    newest = F.max(F.struct("last_purchase_date", *STORE_ATTRIBUTES)).alias("_newest")
    folded = partials.groupBy(F.xxhash64(*ROLLUP_KEYS).alias("_hash"), *ROLLUP_KEYS).agg(
        newest,
        *[one for name in AMOUNTS for one in exact.merged(name, columns)],
        *[F.sum(name).alias(name) for name in COUNTS],
    )
    return folded.select(
        "store_number",
        *[F.col(f"_newest.{a}").alias(a) for a in STORE_ATTRIBUTES],
        "year",
        "cat_group",
        "gin_category",
        *[exact.total(name, columns) for name in AMOUNTS],
        *COUNTS,
        F.col("_newest.last_purchase_date").alias("last_purchase_date"),
    )


def sales_rollup(sales: DataFrame, policy: TargetingPolicy) -> DataFrame:
    """Sales lines to store x year x category group x category, in the two steps above."""
    return fold_partials(sales_partials(sales, policy))


def _sum_where(condition: Column, value: str) -> Column:
    return F.sum(F.when(condition, F.col(value)).otherwise(F.lit(0)))


def store_recent_sales(market: DataFrame, policy: TargetingPolicy) -> DataFrame:
    """One row per store over the scoring window, category groups as columns.

    Sums, dates and attributes come from one grouping, so nothing joins back.
    """
    cats, group = policy.categories, F.col("cat_group")
    premium = group == cats.premium_group
    outside = group == cats.outside_group
    net = F.col("net_sale_dollars")
    # Latest year first, then the larger amount (missing last), then by name.
    preference = F.struct(-F.col("year"), net.isNull(), -net, "cat_group", "gin_category")
    in_window = F.col("year").isin(*policy.window_years) & F.col("store_number").isNotNull()
    stores = (
        market.where(in_window)
        .groupBy("store_number")
        .agg(
            F.min_by(F.struct(*STORE_ATTRIBUTES), preference).alias("_store"),
            _sum_where(premium, "net_sale_dollars").alias("premium_gin_dollars"),
            _sum_where(group == cats.other_group, "net_sale_dollars").alias("other_gin_dollars"),
            _sum_where(~outside, "net_sale_dollars").alias("total_gin_dollars"),
            _sum_where(outside, "net_sale_dollars").alias("non_gin_dollars"),
            F.sum(net).alias("total_dollars"),
            _sum_where(premium, "net_bottles").alias("premium_gin_bottles"),
            _sum_where(premium, "order_lines").alias("premium_gin_order_lines"),
            F.max(F.when(premium, F.col("last_purchase_date"))).alias(
                "last_premium_gin_purchase_date"
            ),
            F.max("last_purchase_date").alias("last_purchase_date"),
        )
    )
    measures = [c for c in stores.columns if c not in ("store_number", "_store")]
    return stores.select(
        "store_number",
        *[F.col(f"_store.{a}").alias(a) for a in STORE_ATTRIBUTES],
        *measures,
        safe_ratio("premium_gin_dollars", "total_gin_dollars").alias("premium_share_of_gin"),
        safe_ratio("total_gin_dollars", "total_dollars").alias("gin_share_of_store"),
        safe_ratio("premium_gin_dollars", "premium_gin_bottles").alias(
            "premium_gin_dollars_per_bottle"
        ),
    )


def category_list(sales: DataFrame) -> DataFrame:
    """Every category name as the source spells it, with its lines."""
    return sales.groupBy("category_name").agg(F.count(F.lit(1)).alias("line_count"))


def category_classify(sales: DataFrame, policy: CategoryPolicy) -> DataFrame:
    """How each raw name is read. Names are grouped first, so the lists are
    consulted once per name and not once per line."""
    return classify(category_list(sales), policy)


def category_audit(sales: DataFrame, policy: CategoryPolicy, text: str) -> DataFrame:
    """Names on which a substring test and the list disagree."""
    name = category_name("category_name")
    audit = category_list(sales).select(
        name.alias("category_name"),
        F.coalesce(name.contains(text), F.lit(False)).alias("has_text"),
        F.coalesce(name.isin(*policy.listed), F.lit(False)).alias("is_listed"),
        "line_count",
    )
    return (
        audit.where(F.col("has_text") != F.col("is_listed"))
        .groupBy("category_name", "has_text", "is_listed")
        .agg(F.sum("line_count").alias("line_count"))
    )
