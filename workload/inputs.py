"""Warehouse-shaped inputs derived from the supplied tables with Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.columns import key_from_date
from tidemark.operators.latest import newest_per_key
from tidemark.operators.pit_join import RANGE
from tidemark.schemas import NOT_APPLICABLE, NOT_APPLICABLE_KEY, SALES, TS

# One stamp for dimensions that are loaded once.
LOADED = "2024-01-01 00:00:00"


class Tables:
    """The supplied tables of one folder, read on demand."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder

    def __getattr__(self, name: str) -> DataFrame:
        df = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        setattr(self, name, df)
        return df


def loaded() -> F.Column:
    return F.lit(LOADED).cast("timestamp_ntz")


def is_reseller_sale() -> F.Column:
    """Two of the five priorities stand for sales through resellers; their customer is not applicable."""
    return F.col("o_orderpriority").isin("4-NOT SPECIFIED", "5-LOW")


def line_key() -> F.Column:
    return F.col("l_orderkey") * 1000 + F.col("l_linenumber")


def sales_lines(t: Tables, *more: F.Column) -> DataFrame:
    """Order lines with what the columns of the sales history follow from. They end up dealt by order."""
    lines = t.lineitem.join(t.supplier.select("s_suppkey", "s_nationkey"), F.col("l_suppkey") == F.col("s_suppkey")).join(
        t.orders, F.col("l_orderkey") == F.col("o_orderkey")
    )
    return lines.select(
        line_key().alias("salesorderlinekey"),
        F.when(is_reseller_sale(), F.col("l_suppkey")).otherwise(NOT_APPLICABLE_KEY).cast("long").alias("resellerkey"),
        F.when(is_reseller_sale(), NOT_APPLICABLE_KEY).otherwise(F.col("o_custkey")).cast("long").alias("customerkey"),
        F.col("l_partkey").alias("productkey"),
        F.col("o_orderdate").cast("date").alias("orderdate"),
        F.col("s_nationkey").cast("long").alias("salesterritorykey"),
        F.col("l_quantity").cast("long").alias("order_quantity"),
        (F.col("l_extendedprice") / F.col("l_quantity")).alias("unit_price"),
        F.col("l_extendedprice").alias("extended_amount"),
        F.col("l_discount").alias("unit_price_discount_pct"),
        F.col("l_tax").alias("product_standard_cost"),
        (F.col("l_tax") * F.col("l_quantity")).alias("total_product_cost"),
        F.col("l_shipdate").alias(TS),
        *more,
    )


def newest_lines(t: Tables) -> DataFrame:
    """The newest of these lines of each line key.

    With line numbers from 0 to 999 the order follows from the line key, and the newest lines are found where lines
    have met their orders. One number beyond that, or none, and lines are dealt by line key instead.
    """
    beyond = F.col("l_linenumber").isNull() | ~F.col("l_linenumber").between(0, 999)
    if not t.lineitem.where(beyond).isEmpty():
        return newest_per_key(sales_lines(t), "salesorderlinekey", tie_break=LINE_TIE_BREAK)
    lines = sales_lines(t, F.col("l_orderkey").alias("_order"))
    return newest_per_key(lines, "salesorderlinekey", tie_break=LINE_TIE_BREAK, dealt_by=["_order"]).drop("_order")


def sales_columns(lines: DataFrame) -> DataFrame:
    """The columns of the sales history; those that follow from others are best added after a shuffle."""
    made = {
        "orderdatekey": key_from_date(F.col("orderdate")),
        "duedatekey": key_from_date(F.date_add("orderdate", 30)),
        "shipdatekey": key_from_date(F.col(TS)),
        "sales_amount": F.col("extended_amount") * (1 - F.col("unit_price_discount_pct")),
    }
    return lines.select(*(made[c].alias(c) if c in made else F.col(c) for c in SALES.history_schema.names))


def sales_history(t: Tables) -> DataFrame:
    """Order lines; a line key that occurs several times stands for versions, stamped by ship date."""
    return sales_columns(sales_lines(t))


# Settles equal stamps of a line key by its values.
SALES_TIE_BREAK = tuple(c for c in SALES.attributes if c != SALES.key)
# The same order by what these follow from: days are ordered as their keys, and the columns left out never decide.
LINE_TIE_BREAK = tuple(
    {"orderdatekey": "orderdate"}.get(c, c)
    for c in SALES_TIE_BREAK if c not in ("duedatekey", "shipdatekey", "sales_amount"))
LABEL_TIE_BREAK = ("channel", "sales_order", "sales_order_line")


def order_label_history(t: Tables) -> DataFrame:
    """Labels per line; those of line 7 carry the next order's number and are not valid."""
    number = F.when(F.col("l_linenumber") == 7, F.col("l_orderkey") + 1).otherwise(F.col("l_orderkey"))
    label = F.concat(F.lit("SO"), number.cast("string"))
    return t.lineitem.select(
        F.when(F.col("l_linestatus") == "O", "Internet").otherwise("Reseller").alias("channel"),
        line_key().alias("salesorderlinekey"),
        label.alias("sales_order"),
        F.concat(label, F.lit(" - "), F.col("l_linenumber").cast("string")).alias("sales_order_line"),
        F.col("l_shipdate").alias(TS),
    )


def priority_history(t: Tables) -> DataFrame:
    """A version per customer and order day, attribute: the highest priority of that day."""
    return t.orders.groupBy(F.col("o_custkey").alias("customerkey"), F.col("o_orderdate").alias(TS)).agg(
        F.max("o_orderpriority").alias("priority")
    ).select("customerkey", "priority", TS)


def part_history(t: Tables) -> DataFrame:
    """A version per part and ship day, attribute: the highest supplier key of that day.

    Dealt by part alone, which also serves the joins and windows by part that follow: they need no further shuffle.
    """
    lines = t.lineitem.select("l_partkey", "l_shipdate", "l_suppkey").repartition("l_partkey")
    return lines.groupBy(F.col("l_partkey").alias("productkey"), F.col("l_shipdate").alias(TS)).agg(
        F.max("l_suppkey").alias("supplier")
    ).select("productkey", "supplier", TS)


def newest_parts(t: Tables) -> DataFrame:
    """The newest of these versions of each part: one row per part and map task before the shuffle."""
    newest = F.max(F.struct("l_shipdate", "l_suppkey")).alias("newest")
    return t.lineitem.groupBy(F.col("l_partkey").alias("productkey")).agg(newest).select(
        "productkey", F.col("newest.l_suppkey").alias("supplier"), F.col("newest.l_shipdate").alias(TS))


def newest_priorities(t: Tables) -> DataFrame:
    """The newest of these versions of each customer."""
    newest = F.max(F.struct("o_orderdate", "o_orderpriority")).alias("newest")
    return t.orders.groupBy(F.col("o_custkey").alias("customerkey")).agg(newest).select(
        "customerkey", F.col("newest.o_orderpriority").alias("priority"), F.col("newest.o_orderdate").alias(TS))


def event_history(t: Tables) -> DataFrame:
    """A version per event of a user: many versions on one day."""
    return t.events.select("user_id", "event_type", F.col("ts").alias(TS))


def nation_history(t: Tables) -> DataFrame:
    """A version per nation and order day: few keys with thousands of versions each."""
    placed = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
    return placed.groupBy(F.col("c_nationkey").alias("nationkey"), F.col("o_orderdate").alias(TS)).agg(
        F.max("o_totalprice").alias("best_price")
    ).select("nationkey", "best_price", TS)


def nations(t: Tables) -> DataFrame:
    return t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        "n_nationkey", "n_name", "r_name"
    )


def with_not_applicable(df: DataFrame, key: str) -> DataFrame:
    """Adds the member that stands for "no such customer" or "no such reseller"."""
    values = {"string": F.lit(NOT_APPLICABLE), "timestamp_ntz": loaded()}
    member = df.sparkSession.range(1).select(
        *(F.lit(NOT_APPLICABLE_KEY).cast("long").alias(c) if c == key else values[t].alias(c) for c, t in df.dtypes)
    )
    return df.unionByName(member)


def no_asia(name: str) -> F.Column:
    return F.when(F.col("r_name") == "ASIA", NOT_APPLICABLE).otherwise(F.col(name))


def customer_history(t: Tables) -> DataFrame:
    """Customers versioned by order day. Some places are NULL, some not applicable."""
    return described_customers(t, priority_history(t))


def described_customers(t: Tables, priorities: DataFrame) -> DataFrame:
    who = t.customer.join(nations(t), F.col("c_nationkey") == F.col("n_nationkey"))
    rows = priorities.join(who, F.col("customerkey") == F.col("c_custkey")).select(
        "customerkey",
        F.concat(F.lit("C"), F.col("customerkey").cast("string")).alias("customer_id"),
        F.col("c_name").alias("customer"),
        F.col("priority").alias("city"),
        F.expr("nullif(n_name, 'NATION_3')").alias("state_province"),
        no_asia("r_name").alias("country_region"),
        F.col("c_mktsegment").alias("postal_code"),
        TS,
    )
    return with_not_applicable(rows, "customerkey")


def reseller_history(t: Tables) -> DataFrame:
    rows = t.supplier.join(nations(t), F.col("s_nationkey") == F.col("n_nationkey")).select(
        F.col("s_suppkey").alias("resellerkey"),
        F.concat(F.lit("R"), F.col("s_suppkey").cast("string")).alias("reseller_id"),
        F.when(F.col("s_acctbal") < 0, "Debtor").otherwise("Creditor").alias("business_type"),
        F.col("s_name").alias("reseller"),
        no_asia("n_name").alias("city"),
        F.col("n_name").alias("state_province"),
        F.col("r_name").alias("country_region"),
        F.col("s_nationkey").cast("string").alias("postal_code"),
        loaded().alias(TS),
    )
    return with_not_applicable(rows, "resellerkey")


def product_history(t: Tables) -> DataFrame:
    """Parts versioned by ship day."""
    return described_parts(t, part_history(t))


def described_parts(t: Tables, versions: DataFrame) -> DataFrame:
    """Versions of parts, perhaps with their ranges, and what is known of each part."""
    return versions.join(t.part, F.col("productkey") == F.col("p_partkey")).select(
        "productkey",
        F.concat(F.lit("P-"), F.col("productkey").cast("string")).alias("sku"),
        F.col("p_name").alias("product"),
        F.col("p_retailprice").alias("standard_cost"),
        F.expr("nullif(p_type, 'SMALL')").alias("color"),
        F.col("p_retailprice").alias("list_price"),
        F.concat(F.lit("M-"), F.col("supplier").cast("string")).alias("model"),
        F.col("p_type").alias("subcategory"),
        F.col("p_brand").alias("category"),
        TS,
        *(c for c in RANGE if c in versions.columns),
    )


def territory_history(t: Tables) -> DataFrame:
    return nations(t).select(
        F.col("n_nationkey").cast("long").alias("salesterritorykey"),
        F.col("n_name").alias("region"),
        F.col("r_name").alias("country"),
        F.upper(F.substring("r_name", 1, 2)).alias("group"),
        loaded().alias(TS),
    )


def calendar(t: Tables) -> DataFrame:
    """Order days but the 13th of each month, so that the calendar visibly filters."""
    days = t.orders.select(F.col("o_orderdate").alias("date")).distinct().where(F.dayofmonth("date") != 13)
    return days.select(
        key_from_date(F.col("date")).alias("datekey"),
        "date",
        F.concat(F.lit("FY"), F.year("date").cast("string")).alias("fiscal_year"),
        F.concat(F.lit("FY"), F.year("date").cast("string"), F.lit(" Q"), F.quarter("date").cast("string"))
        .alias("fiscal_quarter"),
        F.date_format("date", "yyyy-MM").alias("month"),
        F.date_format("date", "yyyy-MM-dd").alias("full_date"),
        (F.year("date") * 100 + F.month("date")).cast("long").alias("monthkey"),
        loaded().alias(TS),
    )


def customer_staging(t: Tables) -> DataFrame:
    """Customers as staged today, the segment missing for some."""
    return t.customer.select(
        F.col("c_custkey").alias("customerkey"),
        F.col("c_name").alias("customer"),
        F.expr("nullif(c_mktsegment, 'BUILDING')").alias("segment"),
        F.col("c_acctbal").alias("balance"),
        loaded().alias(TS),
    )


def earlier_customers(t: Tables) -> DataFrame:
    """What an earlier load had seen: no debtors, and another balance for one region's nations."""
    moved = F.col("c_nationkey").between(5, 9)
    return t.customer.where(F.col("c_acctbal") >= 0).select(
        F.col("c_custkey").alias("customerkey"),
        F.col("c_name").alias("customer"),
        F.expr("nullif(c_mktsegment, 'BUILDING')").alias("segment"),
        F.when(moved, F.col("c_acctbal") + 1).otherwise(F.col("c_acctbal")).alias("balance"),
        F.lit("2023-01-01 00:00:00").cast("timestamp_ntz").alias(TS),
    )


def customer_versions(t: Tables) -> DataFrame:
    """What two earlier loads had seen: a later one had other balances for every third nation."""
    later = t.customer.where((F.col("c_acctbal") >= 0) & (F.col("c_nationkey") % 3 == 0)).select(
        F.col("c_custkey").alias("customerkey"),
        F.col("c_name").alias("customer"),
        F.expr("nullif(c_mktsegment, 'BUILDING')").alias("segment"),
        (F.col("c_acctbal") + 5).alias("balance"),
        F.lit("2023-06-01 00:00:00").cast("timestamp_ntz").alias(TS),
    )
    return earlier_customers(t).unionByName(later)


def order_dates(t: Tables) -> DataFrame:
    """One row per order: heavily repeated days, as a staged calendar with copies."""
    return t.orders.select(
        key_from_date(F.col("o_orderdate")).alias("datekey"), F.col("o_orderdate").alias("date"), loaded().alias(TS)
    )


def sheets(t: Tables, lines: DataFrame | None = None) -> dict[str, DataFrame]:
    """All seven sheets of a full load: the newest row of each key, without its stamp.

    ``lines`` are the newest lines if they are there already.
    """
    newest = {
        "Customer_data": newest_per_key(described_customers(t, newest_priorities(t)), "customerkey"),
        "Date_data": calendar(t),
        "Product_data": newest_per_key(described_parts(t, newest_parts(t)), "productkey"),
        "Reseller_data": reseller_history(t),
        "Sales_data": sales_columns(newest_lines(t) if lines is None else lines),
        "Sales Order_data": newest_per_key(
            order_label_history(t), "salesorderlinekey", tie_break=LABEL_TIE_BREAK
        ),
        "Sales Territory_data": territory_history(t),
    }
    return {name: df.drop(TS) for name, df in newest.items()}


def staged_sheets(t: Tables) -> dict[str, DataFrame]:
    """The sheets as staged: stamped, and lines "shipped" before their order day have no ship date yet.

    Lines are dealt by line key, as two such sheets share that shuffle.
    """
    staged = sheets(t, newest_per_key(sales_lines(t), "salesorderlinekey", tie_break=LINE_TIE_BREAK))
    shipped = F.when(F.col("shipdatekey") >= F.col("orderdatekey"), F.col("shipdatekey"))
    staged["Sales_data"] = staged["Sales_data"].withColumn("shipdatekey", shipped)
    return {name: df.withColumn(TS, loaded()) for name, df in staged.items()}


def earlier_sheets(t: Tables) -> dict[str, DataFrame]:
    """What an earlier load had seen of the staged sheets: less, and some of it otherwise."""
    earlier = {name: df.withColumn(TS, F.lit("2023-01-01 00:00:00").cast("timestamp_ntz"))
               for name, df in staged_sheets(t).items()}

    def changed(sheet: str, column: str, where: F.Column, value: F.Column) -> None:
        earlier[sheet] = earlier[sheet].withColumn(column, F.when(where, value).otherwise(F.col(column)))

    earlier["Customer_data"] = earlier["Customer_data"].where(F.col("postal_code") != "BUILDING")
    earlier["Date_data"] = earlier["Date_data"].where(F.col("datekey") < 19990101)
    earlier["Sales_data"] = earlier["Sales_data"].where(F.col("orderdatekey") < 20000101)
    # Every line left has an order day, so its key stays. But no filter on the key alone goes below the choice of the
    # newest lines any more, which so is the staged sheet's and is computed once for both.
    changed("Sales_data", "salesorderlinekey", F.col("orderdatekey").isNull(), F.lit(None))
    earlier["Sales Order_data"] = earlier["Sales Order_data"].where(F.col("channel") == "Internet")
    changed("Product_data", "list_price", F.col("subcategory") == "PROMO", F.col("list_price") + 1)
    changed("Reseller_data", "business_type", F.col("business_type") == "Debtor", F.lit("Reseller"))
    changed("Sales_data", "unit_price", F.col("salesterritorykey") == 5, F.col("unit_price") + 1)
    changed("Sales Territory_data", "group", F.col("country") == "ASIA", F.lit("Far East"))
    return earlier


def first_load_sheets(t: Tables) -> dict[str, DataFrame]:
    """The sheets of a first load: resellers named otherwise, no sales shipped since 2000."""
    first = sheets(t)
    first["Reseller_data"] = first["Reseller_data"].withColumn("business_type", F.lit("Reseller"))
    first["Sales_data"] = first["Sales_data"].where(F.col("shipdatekey") < 20000101)
    return first


def moved_first_load_sheets(t: Tables) -> dict[str, DataFrame]:
    """The same, where all real customers lived elsewhere and products had another price."""
    first = first_load_sheets(t)
    real = F.col("customerkey") != NOT_APPLICABLE_KEY
    first["Customer_data"] = first["Customer_data"].withColumn("city", F.when(real, "Elsewhere").otherwise(F.col("city")))
    first["Product_data"] = first["Product_data"].withColumn("list_price", F.col("list_price") + 1)
    return first
