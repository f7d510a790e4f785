"""The seven entities: columns, keys, compared columns, and where each one ends up."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field
from types import MappingProxyType

from pyspark.sql import types as T

from tidemark.functions.names import history_name, staging_name

# Defaults of the validity columns and the label and key of the "not applicable" member.
FLOOR = "2000-01-01"
CEILING = "3000-01-01"
NOT_APPLICABLE = "[Not Applicable]"
NOT_APPLICABLE_KEY = -1

TS = "update_ts"

SCD2, APPEND, UPSERT, FACT = "scd2", "append", "upsert", "fact"

TYPES = {
    "bigint": T.LongType(),
    "int": T.IntegerType(),
    "double": T.DoubleType(),
    "string": T.StringType(),
    "date": T.DateType(),
    "timestamp_ntz": T.TimestampNTZType(),
    "seconds": T.DecimalType(18, 6),
}


def struct(columns: str) -> T.StructType:
    """``"name type, name type"`` as a schema; unlike Spark's own DDL reader it needs no running session."""
    return T.StructType([T.StructField(name, TYPES[kind]) for name, kind in (c.split() for c in columns.split(","))])


@dataclass(frozen=True)
class Entity:
    sheet: str
    target: str
    kind: str
    key: str
    columns: str
    compare: tuple[str, ...] | None = None
    null_defaults: Mapping[str, object] = field(default_factory=lambda: MappingProxyType({}))
    renames: Mapping[str, str] = field(default_factory=lambda: MappingProxyType({}))

    @property
    def schema(self) -> T.StructType:
        return struct(self.columns)

    @property
    def attributes(self) -> tuple[str, ...]:
        return tuple(self.schema.names)

    @property
    def compared(self) -> tuple[str, ...]:
        return self.compare or self.attributes

    @property
    def staging_table(self) -> str:
        return staging_name(self.sheet)

    @property
    def history_table(self) -> str:
        return history_name(self.sheet)

    @property
    def history_schema(self) -> T.StructType:
        return T.StructType(self.schema.fields).add(TS, T.TimestampNTZType())

    @property
    def history_key(self) -> tuple[str, ...]:
        """The calendar has one row per day; everything else has one per key and load."""
        return (self.key,) if self.kind == APPEND else (self.key, TS)

    @property
    def target_key(self) -> tuple[str, ...]:
        return (self.key, TS) if self.kind == SCD2 else (self.key,)

    @property
    def target_schema(self) -> T.StructType:
        schema = T.StructType()
        for f in self.history_schema:
            is_date_key = self.kind == FACT and f.name in DATE_KEYS
            schema.add(self.renames.get(f.name, f.name), T.DateType() if is_date_key else f.dataType)
        if self.kind == SCD2:
            schema.add("valid_from", T.DateType()).add("valid_to", T.DateType()).add("is_valid", T.IntegerType())
        if self.kind == UPSERT:
            schema = T.StructType([schema[self.key], *(f for f in schema if f.name != self.key)])
        return schema


# Fixed values, down to the mart's columns: names and types of tables and columns, and what is compared.
DATE_KEYS = ("orderdatekey", "duedatekey", "shipdatekey")

CUSTOMER = Entity(
    sheet="Customer_data", target="dim_customer_data", kind=SCD2, key="customerkey",
    columns="customerkey bigint, customer_id string, customer string, city string, state_province string, "
            "country_region string, postal_code string",
)
DATE = Entity(
    sheet="Date_data", target="dim_date_data", kind=APPEND, key="datekey",
    columns="datekey bigint, date timestamp_ntz, fiscal_year string, fiscal_quarter string, month string, "
            "full_date string, monthkey bigint",
    compare=("datekey",),
)
PRODUCT = Entity(
    sheet="Product_data", target="dim_product_data", kind=SCD2, key="productkey",
    columns="productkey bigint, sku string, product string, standard_cost double, color string, "
            "list_price double, model string, subcategory string, category string",
    null_defaults=MappingProxyType({"color": ""}),
)
RESELLER = Entity(
    sheet="Reseller_data", target="dim_reseller_data", kind=SCD2, key="resellerkey",
    columns="resellerkey bigint, reseller_id string, business_type string, reseller string, city string, "
            "state_province string, country_region string, postal_code string",
)
SALES = Entity(
    sheet="Sales_data", target="fct_sales_data", kind=FACT, key="salesorderlinekey",
    columns="salesorderlinekey bigint, resellerkey bigint, customerkey bigint, productkey bigint, "
            "orderdatekey bigint, duedatekey bigint, shipdatekey bigint, salesterritorykey bigint, "
            "order_quantity bigint, unit_price double, extended_amount double, unit_price_discount_pct double, "
            "product_standard_cost double, total_product_cost double, sales_amount double",
    null_defaults=MappingProxyType({"shipdatekey": 0}),
)
SALES_ORDER = Entity(
    sheet="Sales Order_data", target="dim_sales_order_data", kind=UPSERT, key="salesorderlinekey",
    columns="channel string, salesorderlinekey bigint, sales_order string, sales_order_line string",
)
TERRITORY = Entity(
    sheet="Sales Territory_data", target="dim_sales_territory_data", kind=SCD2, key="salesterritorykey",
    columns="salesterritorykey bigint, region string, country string, group string",
    renames=MappingProxyType({"group": "group_region"}),
)

# Fixed orders: sheets as they are loaded, entities as they are uploaded.
SHEET_ORDER = (SALES_ORDER, TERRITORY, SALES, RESELLER, DATE, PRODUCT, CUSTOMER)
UPLOAD_ORDER = (CUSTOMER, DATE, PRODUCT, RESELLER, SALES, SALES_ORDER, TERRITORY)
BY_TARGET = MappingProxyType({e.target: e for e in UPLOAD_ORDER})

MART_TABLE = "mv_sales_datamart_all_joint"
MART_VIEW = "v_sales_datamart"
COHORT_VIEW = "v_customer_cohors"
AUDIT_TABLE = "etl_log"

MART_SCHEMA = struct(
    "salesorderlinekey bigint, resellerkey bigint, customerkey bigint, productkey bigint, orderdatekey date, "
    "duedatekey date, shipdatekey date, salesterritorykey bigint, order_quantity bigint, unit_price double, "
    "extended_amount double, unit_price_discount_pct double, product_standard_cost double, "
    "total_product_cost double, sales_amount double, city_combined string, state_province_combined string, "
    "country_region_combined string, sku_product string, product_name string, list_price_product double, "
    "model_product string, subcategory_product string, category_product string, business_type_reseller string, "
    "reseller_name string, channel_sales_order string, sales_order string, region_territory string, "
    "country_territory string, group_region_territory string"
)

# Row counts are bigint: a fact load at scale passes the range of int.
AUDIT_SCHEMA = struct(
    "order_id bigint, schema_name string, procedure_name string, start_ts timestamp_ntz, end_ts timestamp_ntz, "
    "msg string, rows bigint, status string, duration_sec seconds"
)
