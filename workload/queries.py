"""One query per operator of the warehouse, over the supplied tables."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.functions.names import normalized
from tidemark.operators import checks
from tidemark.operators.changes import LATEST, changed_counts, counts_as_json, new_or_changed, tables_to_refresh
from tidemark.operators.labels import newest_order_labels, valid_order_labels
from tidemark.operators.latest import newest_per_key, sales_fact
from tidemark.operators.pit_join import pit_join
from tidemark.operators.scd2 import current_versions, scd2_ranges, with_current_flag
from tidemark.operators.upsert import append_missing, upsert
from tidemark.plans import mart
from tidemark.plans.refresh import refresh_dim, register_views
from tidemark.plans.run import run
from tidemark.plans.upload import captured as captured_rows
from tidemark.schemas import (
    AUDIT_TABLE, COHORT_VIEW, CUSTOMER, DATE, FLOOR, MART_TABLE, PRODUCT, RESELLER, SALES, SALES_ORDER, TERRITORY, TS,
    UPLOAD_ORDER, Entity,
)
from tidemark.session import shared_dir
from tidemark.sources.audit import AuditLog
from tidemark.sources.rejects import read_checked
from tidemark.sources.sheets import conform, normalize_columns, read_sheet, stamp
from tidemark.sources.store import Store
from workload import inputs as i
from workload.inputs import Tables

EARLY_FLOOR = "1900-01-01"
FIRST_LOAD = dt.datetime(2000, 6, 1)
SECOND_LOAD = dt.datetime(2001, 1, 1, 12)
AS_OF = dt.date(2024, 1, 15)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(build: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
    QUERIES[build.__name__] = lambda spark, folder: build(Tables(spark, folder))
    return build


# --- change capture -----------------------------------------------------------------------------------------------


@query
def new_or_changed_strict(t: Tables) -> DataFrame:
    return new_or_changed(i.customer_staging(t), i.earlier_customers(t))


@query
def new_or_changed_filtered(t: Tables) -> DataFrame:
    """By a key of text, which no list of proven size holds: a Bloom filter thins the history."""
    staged = i.customer_staging(t)
    return new_or_changed(staged, i.earlier_customers(t), key="customer", staged_rows=staged.count())


@query
def new_or_changed_null_default(t: Tables) -> DataFrame:
    return new_or_changed(i.customer_staging(t), i.earlier_customers(t), null_defaults={"segment": ""})


@query
def new_or_changed_latest(t: Tables) -> DataFrame:
    """Against each customer's newest version: returns to old values are captured too."""
    return new_or_changed(i.customer_staging(t), i.customer_versions(t), key="customerkey", against=LATEST)


@query
def new_or_changed_latest_null_default(t: Tables) -> DataFrame:
    return new_or_changed(
        i.customer_staging(t), i.customer_versions(t), null_defaults={"segment": ""}, key="customerkey",
        against=LATEST)


@query
def new_or_changed_by_key(t: Tables) -> DataFrame:
    dates = i.order_dates(t)
    return new_or_changed(dates, dates.where(F.col("datekey") < 19990101), compare=["datekey"])


def captured(t: Tables) -> dict[str, DataFrame]:
    dates = i.order_dates(t)
    labels = i.order_label_history(t)
    return {
        "dim_customer_data": new_or_changed(i.customer_staging(t), i.earlier_customers(t)),
        "dim_date_data": new_or_changed(dates, dates.where(F.col("datekey") < 19990101), compare=["datekey"]),
        "dim_sales_order_data": new_or_changed(labels, labels),
    }


@query
def changed_rows(t: Tables) -> DataFrame:
    return changed_counts(captured(t))


@query
def changed_rows_json(t: Tables) -> DataFrame:
    return counts_as_json(changed_counts(captured(t)))


@query
def refresh_plan(t: Tables) -> DataFrame:
    return tables_to_refresh(changed_counts(captured(t)))


def capture_query(entity: Entity) -> None:
    """Capture of one entity with its own compared columns and NULL defaults."""

    def build(t: Tables) -> DataFrame:
        staged, earlier = i.staged_sheets(t)[entity.sheet], i.earlier_sheets(t)[entity.sheet]
        return new_or_changed(staged, earlier, entity.compared, entity.null_defaults)

    build.__name__ = f"captured_{entity.history_table.removeprefix('src_')}"
    query(build)


for each in UPLOAD_ORDER:
    capture_query(each)


# --- type-2 dimensions --------------------------------------------------------------------------------------------


@query
def scd2_customer(t: Tables) -> DataFrame:
    return scd2_ranges(i.priority_history(t), "customerkey", as_of="2000-06-30")


@query
def scd2_events_same_day(t: Tables) -> DataFrame:
    return scd2_ranges(i.event_history(t), "user_id", as_of=AS_OF)


@query
def scd2_part(t: Tables) -> DataFrame:
    return scd2_ranges(i.part_history(t), "productkey", as_of="2000-06-30")


@query
def scd2_territory(t: Tables) -> DataFrame:
    return scd2_ranges(territories(t), "salesterritorykey", as_of=AS_OF)


@query
def dim_customer(t: Tables) -> DataFrame:
    return scd2_ranges(i.customer_history(t), "customerkey", as_of="2000-06-30")


@query
def dim_product(t: Tables) -> DataFrame:
    return scd2_ranges(i.product_history(t), "productkey", as_of="2000-06-30")


@query
def dim_reseller(t: Tables) -> DataFrame:
    return scd2_ranges(i.reseller_history(t), "resellerkey", as_of=AS_OF)


@query
def current_event_versions(t: Tables) -> DataFrame:
    return current_versions(scd2_events_same_day(t))


# --- newest versions and facts ------------------------------------------------------------------------------------


@query
def latest_per_line(t: Tables) -> DataFrame:
    return i.sales_columns(i.newest_lines(t))


@query
def fact_sales(t: Tables) -> DataFrame:
    return sales_fact(i.sales_lines(t), i.LINE_TIE_BREAK, i.sales_columns)


# --- order labels and upserts -------------------------------------------------------------------------------------


@query
def order_labels_valid(t: Tables) -> DataFrame:
    return valid_order_labels(i.order_label_history(t))


@query
def latest_order_label(t: Tables) -> DataFrame:
    return newest_order_labels(i.order_label_history(t), i.LABEL_TIE_BREAK)


@query
def upsert_lines(t: Tables) -> DataFrame:
    sales = i.sales_history(t)
    cut = F.lit("1998-01-01").cast("timestamp_ntz")
    before = newest_per_key(sales.where(F.col(TS) < cut), "salesorderlinekey", tie_break=i.SALES_TIE_BREAK)
    after = newest_per_key(sales.where(F.col(TS) >= cut), "salesorderlinekey", tie_break=i.SALES_TIE_BREAK)
    return upsert(before, after, "salesorderlinekey")


@query
def upsert_order_labels(t: Tables) -> DataFrame:
    """Labels of shipped lines already in the dimension; later labels overwrite them or are added."""
    labels = i.order_label_history(t)
    cut = F.lit("1998-01-01").cast("timestamp_ntz")
    before = newest_order_labels(labels.where(F.col(TS) < cut), i.LABEL_TIE_BREAK)
    after = newest_order_labels(labels.where(F.col(TS) >= cut), i.LABEL_TIE_BREAK)
    return upsert(before.select(*SALES_ORDER.target_schema.names), after, "salesorderlinekey")


@query
def append_missing_dates(t: Tables) -> DataFrame:
    days = i.calendar(t)
    return append_missing(days, days.where(F.col("datekey") < 19990101), "datekey")


# --- point-in-time joins ------------------------------------------------------------------------------------------


def order_facts(t: Tables) -> DataFrame:
    return t.orders.select(
        F.col("o_orderkey").alias("orderkey"),
        F.col("o_custkey").alias("customerkey"),
        F.col("o_orderdate").cast("date").alias("orderdate"),
    )


def priority_ranges(t: Tables, floor: str) -> DataFrame:
    return scd2_ranges(i.priority_history(t), "customerkey", floor=floor).withColumnRenamed(TS, "version_ts")


@query
def pit_customer(t: Tables) -> DataFrame:
    return pit_join(order_facts(t), priority_ranges(t, EARLY_FLOOR), "customerkey", "orderdate")


@query
def pit_customer_default_floor(t: Tables) -> DataFrame:
    return pit_join(order_facts(t), priority_ranges(t, FLOOR), "customerkey", "orderdate")


@query
def pit_many_versions(t: Tables) -> DataFrame:
    """Few keys with thousands of versions each: matched month by month."""
    facts = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).select(
        F.col("o_orderkey").alias("orderkey"),
        F.col("c_nationkey").alias("nationkey"),
        F.date_add("o_orderdate", 3).alias("duedate"),
    )
    versions = scd2_ranges(i.nation_history(t), "nationkey", floor=EARLY_FLOOR).withColumnRenamed(TS, "version_ts")
    return pit_join(facts, versions, "nationkey", "duedate")


# --- the mart -----------------------------------------------------------------------------------------------------


def territories(t: Tables) -> DataFrame:
    return i.territory_history(t).withColumnRenamed("group", "group_region")


def products(t: Tables, floor: str, dealt: bool = False) -> DataFrame:
    """Versions of parts are about as many as the lines: their ranges are found on narrow rows, before parts are described."""
    return i.described_parts(t, scd2_ranges(i.part_history(t), "productkey", floor=floor, dealt=dealt))


def dimensions(t: Tables, floor: str, dealt: bool = False) -> dict[str, DataFrame]:
    """With ``dealt`` the ranges of parts and customers are found where all versions of a key lie: parts are dealt by key
    in any case, and customers have a version for each stamp of their orders at most."""
    return {
        "customer": scd2_ranges(i.customer_history(t), "customerkey", floor=floor, dealt=dealt),
        "product": products(t, floor, dealt),
        "reseller": scd2_ranges(i.reseller_history(t), "resellerkey", floor=floor),
        "territory": scd2_ranges(territories(t), "salesterritorykey", floor=floor),
        "calendar": i.calendar(t),
        "orders": newest_order_labels(i.order_label_history(t), i.LABEL_TIE_BREAK),
    }


@query
def mart_fallback_attributes(t: Tables) -> DataFrame:
    """Places of the customer, or of the reseller where the customer's do not apply."""
    sales = sales_fact(i.sales_history(t), i.SALES_TIE_BREAK).select("salesorderlinekey", "customerkey", "resellerkey")
    customer = current_versions(scd2_ranges(i.customer_history(t), "customerkey", as_of=AS_OF)).select(
        "customerkey", *(F.col(c).alias(f"c_{c}") for c in mart.PLACES)
    )
    reseller = i.reseller_history(t).select("resellerkey", *(F.col(c).alias(f"r_{c}") for c in mart.PLACES))
    joined = sales.join(customer, "customerkey").join(reseller, "resellerkey")
    combined = mart.combined_places(joined, "c_", "r_")
    return combined.select("salesorderlinekey", *(f"{c}_combined" for c in mart.PLACES))


def build_mart(t: Tables, floor: str) -> DataFrame:
    return mart.sales_mart(fact_sales(t), **dimensions(t, floor, dealt=True))


@query
def sales_mart(t: Tables) -> DataFrame:
    return build_mart(t, EARLY_FLOOR)


@query
def sales_mart_default_floor(t: Tables) -> DataFrame:
    return build_mart(t, FLOOR)


@query
def customer_cohorts(t: Tables) -> DataFrame:
    return mart.customer_cohorts(build_mart(t, EARLY_FLOOR))


# --- checks -------------------------------------------------------------------------------------------------------


@query
def duplicate_keys(t: Tables) -> DataFrame:
    return checks.duplicate_keys(i.sales_history(t), ["salesorderlinekey", TS])


@query
def null_keys(t: Tables) -> DataFrame:
    return checks.null_keys(i.customer_staging(t), ["customerkey", "segment"])


@query
def key_report(t: Tables) -> DataFrame:
    return checks.key_report(i.customer_staging(t), ["segment"])


@query
def unmatched_facts(t: Tables) -> DataFrame:
    dims = dimensions(t, FLOOR)
    keys = {"customer": "customerkey", "product": "productkey", "reseller": "resellerkey",
            "territory": "salesterritorykey"}
    return checks.unmatched_facts(
        fact_sales(t), {n: (dims[n], k) for n, k in keys.items()}, dims["calendar"], dims["orders"]
    )


# --- sheets and names ---------------------------------------------------------------------------------------------


@query
def normalized_names(t: Tables) -> DataFrame:
    decorated = F.concat(F.lit("  "), F.col("p_name"), F.lit("-(%) "), F.col("p_brand"), F.lit(" "), F.col("p_type"))
    return t.part.select(F.col("p_partkey").alias("productkey"), normalized(decorated).alias("name"))


@query
def csv_sheet(t: Tables) -> DataFrame:
    """Parts exported as CSV with decorated column names, read back as a staged product sheet."""
    path = f"{shared_dir(t.spark)}/sheet_{uuid.uuid4().hex}"
    t.part.select(
        F.col("p_partkey").alias("ProductKey"),
        F.concat(F.lit("P-"), F.col("p_partkey").cast("string")).alias(" SKU "),
        F.col("p_name").alias("Product"),
        F.col("p_retailprice").alias("Standard Cost"),
        F.when(F.col("p_type") == "SMALL", "NA").otherwise(F.col("p_type")).alias("Color"),
        (F.col("p_retailprice") / 3).alias("List-Price"),
        F.col("p_brand").alias("Model"),
        F.col("p_type").alias("Subcategory"),
        F.col("p_size").cast("string").alias("(Category)"),
    ).write.option("header", True).csv(path)
    sheet = stamp(normalize_columns(read_sheet(t.spark, path)), FIRST_LOAD)
    return conform(sheet, PRODUCT.history_schema)


def exported_parts(t: Tables) -> str:
    """Parts as CSV files of a thousand keys each, in order; some lines lack a cell, some have a word for a cost."""
    path = f"{shared_dir(t.spark)}/sheet_{uuid.uuid4().hex}"
    key = F.col("p_partkey")
    cost = F.when(key % 89 == 0, "unknown").otherwise(F.col("p_size").cast("string"))
    cells = F.concat_ws(",", key.cast("string"), F.concat(F.lit("P-"), key.cast("string")), F.when(key % 53 != 0, cost))
    lines = t.part.select(F.floor(key / 1000).alias("thousand"), key.alias("place"), cells.alias("line"))
    headers = lines.select("thousand").distinct().select(
        "thousand", F.lit(-1).alias("place"), F.lit("ProductKey,SKU,Standard Cost").alias("line"))
    (
        lines.unionByName(headers).repartition("thousand").sortWithinPartitions("thousand", "place")
        .select("thousand", "line").write.partitionBy("thousand").text(path)
    )
    return path


@query
def rejected_rows(t: Tables) -> DataFrame:
    """What a checked read of a sheet sets aside, with its place and what is wrong."""
    rejected = read_checked(t.spark, exported_parts(t), PRODUCT.schema).rejected
    thousand = F.regexp_extract("source_file", "thousand=([0-9]+)", 1).cast("long")
    return rejected.select(thousand.alias("thousand"), "source_line", "record", "problem")


@query
def accepted_rows(t: Tables) -> DataFrame:
    """What it loads."""
    accepted = normalize_columns(read_checked(t.spark, exported_parts(t), PRODUCT.schema).accepted)
    schema = [f for f in PRODUCT.schema if f.name in accepted.columns]
    return conform(accepted, StructType(schema))


# --- stored tables and full runs ----------------------------------------------------------------------------------


def new_store(t: Tables) -> Store:
    """A warehouse of its own in the shared folder."""
    return Store(t.spark, f"warehouse_{uuid.uuid4().hex}").create()


@query
def published_fact(t: Tables) -> DataFrame:
    store = new_store(t)
    store.publish(SALES.target, fact_sales(t), SALES.target_key, bucket_by=SALES.key)
    return store.table(SALES.target)


@query
def audit_log(t: Tables) -> DataFrame:
    """What one full run records, per step and status; the database's name is left out."""
    store = new_store(t)
    run(store, i.sheets(t), SECOND_LOAD)
    step = F.substring_index("procedure_name", ".", -1).alias("procedure_name")
    return store.table(AUDIT_TABLE).groupBy(step, "status").agg(
        F.count(F.lit(1)).alias("n_records"), F.sum("rows").alias("n_rows")
    )


@query
def stored_mart(t: Tables) -> DataFrame:
    """The mart after two loads: resellers have two versions, later sales came with the second load."""
    store = new_store(t)
    run(store, i.first_load_sheets(t), FIRST_LOAD)
    run(store, i.sheets(t), SECOND_LOAD, as_of=AS_OF)
    return store.table(MART_TABLE)


@query
def incremental_mart(t: Tables) -> DataFrame:
    """The mart after a second load that also brings new versions of old customers and of products: only the parts
    of the stored tables that it touches are replaced."""
    store = Store(t.spark, f"warehouse_{uuid.uuid4().hex}", rows_per_file=500).create()
    run(store, i.moved_first_load_sheets(t), FIRST_LOAD)
    run(store, i.sheets(t), SECOND_LOAD, as_of=AS_OF)
    return store.table(MART_TABLE)


@query
def stored_reseller_dim(t: Tables) -> DataFrame:
    """One dimension from sheet to table, loaded twice."""
    store = new_store(t)
    for sheets, load_ts in ((i.first_load_sheets(t), FIRST_LOAD), (i.sheets(t), SECOND_LOAD)):
        rows = store.stage(RESELLER.staging_table, stamp(sheets[RESELLER.sheet], load_ts))
        store.append_history(RESELLER, captured_rows(store, RESELLER, rows))
    refresh_dim(store, AuditLog(store), RESELLER.target, AS_OF)
    return store.table(RESELLER.target)


def published_store(t: Tables) -> Store:
    """A warehouse with the sales history and all targets of the mart in place."""
    store = new_store(t)
    dims = dimensions(t, EARLY_FLOOR)
    for entity, df in (
        (CUSTOMER, dims["customer"]), (PRODUCT, dims["product"]), (RESELLER, dims["reseller"]),
        (TERRITORY, dims["territory"]),
    ):
        store.publish(entity.target, with_current_flag(df, AS_OF), entity.target_key)
    store.publish(DATE.target, dims["calendar"], DATE.target_key)
    store.publish(SALES_ORDER.target, dims["orders"], SALES_ORDER.target_key, bucket_by=SALES_ORDER.key)
    store.append_history(SALES, latest_per_line(t))
    store.publish(SALES.target, sales_fact(store.table(SALES.history_table)), SALES.target_key, bucket_by=SALES.key)
    return store


@query
def cohort_view(t: Tables) -> DataFrame:
    """The cohorts as a SQL user reads them: a view over the live mart over published tables."""
    register_views(published_store(t))
    return t.spark.sql(f"SELECT * FROM {COHORT_VIEW}")
