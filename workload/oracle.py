"""The same results as SQL for DuckDB, on purpose in another form than the Spark queries.

Ranges come from neighbours in a window over all versions, newest rows from DISTINCT ON, change capture from
NOT EXISTS, labels from LIKE, and upserts from an anti join plus union.
"""

from __future__ import annotations

MEMBER = "'[Not Applicable]'"
LOADED = "timestamp '2024-01-01 00:00:00'"


def yyyymmdd(date: str) -> str:
    return f"cast(strftime({date}, '%Y%m%d') as bigint)"


def parsed(key: str) -> str:
    return f"cast(strptime(cast({key} as varchar), '%Y%m%d') as date)"


SALES_COLUMNS = (
    "salesorderlinekey, resellerkey, customerkey, productkey, orderdatekey, duedatekey, shipdatekey, "
    "salesterritorykey, order_quantity, unit_price, extended_amount, unit_price_discount_pct, "
    "product_standard_cost, total_product_cost, sales_amount, update_ts"
)
SALES_NEWEST = "salesorderlinekey, update_ts desc, " + ", ".join(f"{c} desc" for c in SALES_COLUMNS.split(", ")[1:15])
LABEL_NEWEST = "salesorderlinekey, update_ts desc, channel desc, sales_order desc, sales_order_line desc"

RESELLER_SALE = "o_orderpriority in ('4-NOT SPECIFIED', '5-LOW')"

CTES = {
    "sales": f"""
        select l_orderkey * 1000 + l_linenumber as salesorderlinekey,
               case when {RESELLER_SALE} then l_suppkey else -1 end as resellerkey,
               case when {RESELLER_SALE} then -1 else o_custkey end as customerkey,
               l_partkey as productkey,
               {yyyymmdd('o_orderdate')} as orderdatekey,
               {yyyymmdd("o_orderdate + interval 30 days")} as duedatekey,
               {yyyymmdd('l_shipdate')} as shipdatekey,
               cast(s_nationkey as bigint) as salesterritorykey,
               cast(l_quantity as bigint) as order_quantity,
               l_extendedprice / l_quantity as unit_price,
               l_extendedprice as extended_amount,
               l_discount as unit_price_discount_pct,
               l_tax as product_standard_cost,
               l_tax * l_quantity as total_product_cost,
               l_extendedprice * (1 - l_discount) as sales_amount,
               l_shipdate as update_ts
        from lineitem, orders, supplier
        where l_orderkey = o_orderkey and l_suppkey = s_suppkey""",
    "newest_sales": f"select distinct on (salesorderlinekey) * from sales order by {SALES_NEWEST}",
    "fact": f"""
        select * replace ({parsed('orderdatekey')} as orderdatekey, {parsed('duedatekey')} as duedatekey,
                          {parsed('shipdatekey')} as shipdatekey)
        from newest_sales""",
    "labels": """
        select case l_linestatus when 'O' then 'Internet' else 'Reseller' end as channel,
               l_orderkey * 1000 + l_linenumber as salesorderlinekey,
               'SO' || (case when l_linenumber = 7 then l_orderkey + 1 else l_orderkey end) as sales_order,
               'SO' || (case when l_linenumber = 7 then l_orderkey + 1 else l_orderkey end) || ' - ' || l_linenumber
                   as sales_order_line,
               l_shipdate as update_ts
        from lineitem""",
    "valid_labels": """
        select * from labels
        where sales_order like '%' || (salesorderlinekey // 1000) || '%'
          and sales_order_line like '%' || (salesorderlinekey // 1000) || '%'""",
    "newest_labels": f"select distinct on (salesorderlinekey) * from valid_labels order by {LABEL_NEWEST}",
    "priorities": """
        select o_custkey as customerkey, max(o_orderpriority) as priority, o_orderdate as update_ts
        from orders group by all""",
    "part_versions": """
        select l_partkey as productkey, max(l_suppkey) as supplier, l_shipdate as update_ts
        from lineitem group by all""",
    "event_versions": "select user_id, event_type, ts as update_ts from events",
    "nation_versions": """
        select c_nationkey as nationkey, max(o_totalprice) as best_price, o_orderdate as update_ts
        from orders join customer on o_custkey = c_custkey group by all""",
    "nations": "select n_nationkey, n_name, r_name from nation join region on n_regionkey = r_regionkey",
    "customers": f"""
        select customerkey, 'C' || customerkey as customer_id, c_name as customer, priority as city,
               nullif(n_name, 'NATION_3') as state_province,
               case r_name when 'ASIA' then {MEMBER} else r_name end as country_region,
               c_mktsegment as postal_code, update_ts
        from priorities join customer on customerkey = c_custkey join nations on c_nationkey = n_nationkey
        union all
        select -1, {', '.join([MEMBER] * 6)}, {LOADED}""",
    "resellers": f"""
        select s_suppkey as resellerkey, 'R' || s_suppkey as reseller_id,
               case when s_acctbal < 0 then 'Debtor' else 'Creditor' end as business_type, s_name as reseller,
               case r_name when 'ASIA' then {MEMBER} else n_name end as city,
               n_name as state_province, r_name as country_region, cast(s_nationkey as varchar) as postal_code,
               {LOADED} as update_ts
        from supplier join nations on s_nationkey = n_nationkey
        union all
        select -1, {', '.join([MEMBER] * 7)}, {LOADED}""",
    "products": """
        select productkey, 'P-' || productkey as sku, p_name as product, p_retailprice as standard_cost,
               nullif(p_type, 'SMALL') as color, p_retailprice as list_price, 'M-' || supplier as model,
               p_type as subcategory, p_brand as category, update_ts
        from part_versions join part on productkey = p_partkey""",
    "territories": f"""
        select cast(n_nationkey as bigint) as salesterritorykey, n_name as region, r_name as country,
               upper(left(r_name, 2)) as group_region, {LOADED} as update_ts
        from nations""",
    "days": f"""
        select distinct {yyyymmdd('o_orderdate')} as datekey, o_orderdate as date,
               'FY' || year(o_orderdate) as fiscal_year,
               'FY' || year(o_orderdate) || ' Q' || quarter(o_orderdate) as fiscal_quarter,
               strftime(o_orderdate, '%Y-%m') as month, strftime(o_orderdate, '%Y-%m-%d') as full_date,
               cast(strftime(o_orderdate, '%Y%m') as bigint) as monthkey, {LOADED} as update_ts
        from orders where day(o_orderdate) <> 13""",
    "staged_customers": f"""
        select c_custkey as customerkey, c_name as customer, nullif(c_mktsegment, 'BUILDING') as segment,
               c_acctbal as balance, {LOADED} as update_ts
        from customer""",
    "earlier_customers": """
        select c_custkey as customerkey, c_name as customer, nullif(c_mktsegment, 'BUILDING') as segment,
               c_acctbal + (case when c_nationkey between 5 and 9 then 1 else 0 end) as balance
        from customer where c_acctbal >= 0""",
    "customer_versions": """
        select c_custkey as customerkey, c_name as customer, nullif(c_mktsegment, 'BUILDING') as segment,
               if(c_nationkey % 3 = 0, c_acctbal + 5, c_acctbal + if(c_nationkey between 5 and 9, 1, 0)) as balance
        from customer where c_acctbal >= 0""",
    "staged_dates": f"""
        select {yyyymmdd('o_orderdate')} as datekey, o_orderdate as date, {LOADED} as update_ts from orders""",
    "captured_customers": """
        select customerkey, customer, segment, balance, max(update_ts) as update_ts
        from staged_customers s
        where not exists (select 1 from earlier_customers e
                          where e.customerkey = s.customerkey and e.customer = s.customer
                            and e.segment = s.segment and e.balance = s.balance)
        group by all""",
    "captured_dates": """
        select datekey, date, max(update_ts) as update_ts
        from staged_dates
        where datekey not in (select datekey from staged_dates where datekey < 19990101)
        group by all""",
    "counts": """
        select 'dim_customer_data' as table_name, (select count(*) from captured_customers) as rows_changed
        union all select 'dim_date_data', (select count(*) from captured_dates)
        union all select 'dim_sales_order_data', 0""",
}


def ranged(name: str, key: str, floor: str = "2000-01-01", as_of: str | None = None) -> str:
    flag = ""
    if as_of:
        flag = f", cast(date '{as_of}' between valid_from and valid_to as integer) as is_valid"
    return f"""
        select *{flag} from (
            select *,
                   case when row_number() over w = 1 then date '{floor}' else cast(update_ts as date) end as valid_from,
                   coalesce(cast(lead(update_ts) over w as date) - 1, date '3000-01-01') as valid_to
            from {name}
            window w as (partition by {key} order by update_ts))"""


def needs(text: str, known: dict[str, str]) -> list[str]:
    """The named subqueries a text uses, each after those it uses itself."""
    words = set(text.replace("(", " ").replace(")", " ").replace(",", " ").split())
    found: list[str] = []
    for name, body in known.items():
        if name in words and body is not text:
            for inner in [*needs(body, known), name]:
                if inner not in found:
                    found.append(inner)
    return found


def sql(body: str, **extra: str) -> str:
    known = {**CTES, **extra}
    parts = ", ".join(f"{name} as ({known[name]})" for name in needs(body, known))
    return f"with {parts} {body}" if parts else body


def dims(floor: str) -> dict[str, str]:
    return {
        "dim_customer": ranged("customers", "customerkey", floor),
        "dim_product": ranged("products", "productkey", floor),
        "dim_reseller": ranged("resellers", "resellerkey", floor),
        "dim_territory": ranged("territories", "salesterritorykey", floor),
    }


MART = """
    select f.* exclude (update_ts),
           if(c.city <> '[Not Applicable]', c.city, r.city) as city_combined,
           if(c.state_province <> '[Not Applicable]', c.state_province, r.state_province) as state_province_combined,
           if(c.country_region <> '[Not Applicable]', c.country_region, r.country_region) as country_region_combined,
           p.sku as sku_product, p.product as product_name, p.list_price as list_price_product,
           p.model as model_product, p.subcategory as subcategory_product, p.category as category_product,
           r.business_type as business_type_reseller, r.reseller as reseller_name,
           o.channel as channel_sales_order, o.sales_order,
           g.region as region_territory, g.country as country_territory, g.group_region as group_region_territory
    from fact f, days d, newest_labels o, dim_customer c, dim_product p, dim_reseller r, dim_territory g
    where d.date = f.orderdatekey and o.salesorderlinekey = f.salesorderlinekey
      and c.customerkey = f.customerkey and f.orderdatekey between c.valid_from and c.valid_to
      and p.productkey = f.productkey and f.orderdatekey between p.valid_from and p.valid_to
      and r.resellerkey = f.resellerkey and f.orderdatekey between r.valid_from and r.valid_to
      and g.salesterritorykey = f.salesterritorykey and f.orderdatekey between g.valid_from and g.valid_to"""


def unmatched(name: str, key: str) -> str:
    return f"""
        select '{name}' as dimension, count(*) as n_unmatched from fact f
        where not exists (select 1 from dim_{name} d
                          where d.{key} = f.{key} and f.orderdatekey between d.valid_from and d.valid_to)"""


def pit_customer(floor: str) -> str:
    return sql(
        """select o_orderkey as orderkey, customerkey, cast(o_orderdate as date) as orderdate, priority,
                  update_ts as version_ts
           from orders join versions on o_custkey = customerkey and o_orderdate between valid_from and valid_to""",
        versions=ranged("priorities", "customerkey", floor),
    )


# The staged sheets, and what an earlier load had seen of them.
STAGED = {
    "customer_data": "select distinct on (customerkey) * from customers order by customerkey, update_ts desc",
    "date_data": "select * from days",
    "product_data": "select distinct on (productkey) * from products order by productkey, update_ts desc",
    "reseller_data": "select * from resellers",
    "sales_data": """
        select * replace (if(shipdatekey >= orderdatekey, shipdatekey, null) as shipdatekey) from newest_sales""",
    "sales_order_data": f"select distinct on (salesorderlinekey) * from labels order by {LABEL_NEWEST}",
    "sales_territory_data": "select * rename (group_region as \"group\") from territories",
}
EARLIER = {
    "customer_data": "select * from staged where postal_code <> 'BUILDING'",
    "date_data": "select * from staged where datekey < 19990101",
    "product_data": "select * replace (list_price + if(subcategory = 'PROMO', 1, 0) as list_price) from staged",
    "reseller_data": """
        select * replace (if(business_type = 'Debtor', 'Reseller', business_type) as business_type) from staged""",
    "sales_data": """
        select * replace (unit_price + if(salesterritorykey = 5, 1, 0) as unit_price) from staged
        where orderdatekey < 20000101""",
    "sales_order_data": "select * from staged where channel = 'Internet'",
    "sales_territory_data": """
        select * replace (if(country = 'ASIA', 'Far East', "group") as "group") from staged""",
}
# The columns compared per entity.
COMPARED = {
    "customer_data": "customerkey customer_id customer city state_province country_region postal_code",
    "date_data": "datekey",
    "product_data": "productkey sku product standard_cost list_price model subcategory category",
    "reseller_data": "resellerkey reseller_id business_type reseller city state_province country_region postal_code",
    "sales_data": "salesorderlinekey resellerkey customerkey productkey orderdatekey duedatekey salesterritorykey "
                  "order_quantity unit_price extended_amount unit_price_discount_pct product_standard_cost "
                  "total_product_cost sales_amount",
    "sales_order_data": "channel salesorderlinekey sales_order sales_order_line",
    "sales_territory_data": "salesterritorykey region country \"group\"",
}
NULL_DEFAULT = {
    "product_data": " and coalesce(s.color, '') = coalesce(e.color, '')",
    "sales_data": " and coalesce(s.shipdatekey, 0) = coalesce(e.shipdatekey, 0)",
}


def captured(table: str) -> str:
    equal = " and ".join(f"s.{c} = e.{c}" for c in COMPARED[table].split()) + NULL_DEFAULT.get(table, "")
    return sql(
        f"""select * exclude (update_ts), max(update_ts) as update_ts from restamped s
            where not exists (select 1 from earlier e where {equal}) group by all""",
        staged=STAGED[table],
        earlier=EARLIER[table],
        restamped=f"select * replace ({LOADED} as update_ts) from staged",
    )


# Each reseller's versions after a first load on 2000-06-01 and a second on 2001-01-01, and the mart over them: all
# other dimensions have one version, whose range is open on both sides.
TWICE_LOADED = {
    "dim_reseller": """
        select * replace ('Reseller' as business_type, timestamp '2000-06-01 00:00:00' as update_ts),
               date '2000-01-01' as valid_from, date '2000-12-31' as valid_to, 0 as is_valid
        from resellers where business_type is not null
        union all
        select * replace (timestamp '2001-01-01 12:00:00' as update_ts),
               date '2001-01-01' as valid_from, date '3000-01-01' as valid_to, 1 as is_valid
        from resellers""",
    **{
        f"dim_{name}": f"""
            select distinct on ({key}) *, date '2000-01-01' as valid_from, date '3000-01-01' as valid_to
            from {name}s order by {key}, update_ts desc"""
        for name, key in (("customer", "customerkey"), ("product", "productkey"))
    },
    "dim_territory": ranged("territories", "salesterritorykey"),
}

# The sheet holds the newest label of each line, valid or not; only then are invalid ones left out.
NEWEST_OF_ALL = f"""
    select distinct on (salesorderlinekey) *,
           contains(sales_order, (salesorderlinekey // 1000)::varchar)
           and contains(sales_order_line, (salesorderlinekey // 1000)::varchar) as valid
    from labels order by {LABEL_NEWEST}"""

# As before, but customers and products have a version of each load as well.
MOVED = TWICE_LOADED | {
    "newest_labels": f"select * from ({NEWEST_OF_ALL}) where valid",
    "newest_customers": "select distinct on (customerkey) * from customers order by customerkey, update_ts desc",
    "newest_products": "select distinct on (productkey) * from products order by productkey, update_ts desc",
    "dim_customer": """
        select * replace ('Elsewhere' as city), date '2000-01-01' as valid_from, date '2000-12-31' as valid_to
        from newest_customers where customerkey <> -1
        union all
        select *, date '2001-01-01' as valid_from, date '3000-01-01' as valid_to
        from newest_customers where customerkey <> -1
        union all
        select *, date '2000-01-01' as valid_from, date '3000-01-01' as valid_to
        from newest_customers where customerkey = -1""",
    "dim_product": """
        select * replace (list_price + 1 as list_price), date '2000-01-01' as valid_from, date '2000-12-31' as valid_to
        from newest_products
        union all
        select *, date '2001-01-01' as valid_from, date '3000-01-01' as valid_to from newest_products""",
}

STEPS = """
    select 'load src_sales_order_data_temp' as procedure_name, 'OK' as status, 1 as n_records, n_labels as n_rows from n
    union all select 'load src_sales_territory_data_temp', 'OK', 1, n_territories from n
    union all select 'load src_sales_data_temp', 'OK', 1, n_sales from n
    union all select 'load src_reseller_data_temp', 'OK', 1, n_resellers from n
    union all select 'load src_date_data_temp', 'OK', 1, n_days from n
    union all select 'load src_product_data_temp', 'OK', 1, n_products from n
    union all select 'load src_customer_data_temp', 'OK', 1, n_customers from n
    union all select 'initial_temp_load_all_sheets', 'OK', 1, n_all from n
    union all select 'fn_upload_src', 'STARTED', 1, null
    union all select 'fn_upload_src', 'OK', 9, n_all from n
    union all select 'sp_refresh_dims', 'STARTED', 6, null
    union all select 'sp_refresh_dims', 'OK', 12, n_all - n_sales - n_labels + n_valid_labels from n
    union all select 'sp_refresh_fct', 'STARTED', 1, null
    union all select 'sp_refresh_fct', 'OK', 1, n_sales from n
    union all select 'sp_refresh_sales_datamart', 'OK', 2, null
    union all select 'initial_full_load_pipeline', 'OK', 1, n_all from n"""

COHORTS = sql(
    """select customerkey, year(min(orderdatekey)) || '-Q' || quarter(min(orderdatekey)) as cohor_y_q
       from mart where customerkey <> -1 group by customerkey order by 2, 1""",
    mart=MART, **dims("1900-01-01"),
)

ORACLE: dict[str, str] = {
    "new_or_changed_strict": sql("select * from captured_customers"),
    "new_or_changed_filtered": sql("select * from captured_customers"),
    "new_or_changed_null_default": sql(
        """select customerkey, customer, segment, balance, max(update_ts) as update_ts
           from staged_customers s
           where not exists (select 1 from earlier_customers e
                             where e.customerkey = s.customerkey and e.customer = s.customer
                               and coalesce(e.segment, '') = coalesce(s.segment, '') and e.balance = s.balance)
           group by all"""
    ),
    "new_or_changed_latest": sql(
        """select customerkey, s.customer, s.segment, s.balance, max(update_ts) as update_ts
           from staged_customers s left join customer_versions v using (customerkey)
           where not coalesce(v.customer = s.customer and v.segment = s.segment and v.balance = s.balance, false)
           group by all"""
    ),
    "new_or_changed_latest_null_default": sql(
        """select customerkey, s.customer, s.segment, s.balance, max(update_ts) as update_ts
           from staged_customers s left join customer_versions v using (customerkey)
           where not coalesce(v.customer = s.customer and coalesce(v.segment, '') = coalesce(s.segment, '')
                              and v.balance = s.balance, false)
           group by all"""
    ),
    "new_or_changed_by_key": sql("select * from captured_dates"),
    "changed_rows": sql("select table_name, cast(rows_changed as bigint) as rows_changed from counts"),
    "changed_rows_json": sql(
        """select '{' || string_agg('"' || table_name || '":' || rows_changed, ',' order by table_name) || '}'
                  as updated_tables from counts"""
    ),
    "refresh_plan": sql(
        "select table_name, cast(rows_changed as bigint) as rows_changed from counts where rows_changed > 1"
    ),
    **{f"captured_{table}": captured(table) for table in STAGED},
    "dim_customer": sql(ranged("customers", "customerkey", as_of="2000-06-30")),
    "dim_product": sql(ranged("products", "productkey", as_of="2000-06-30")),
    "dim_reseller": sql(ranged("resellers", "resellerkey", as_of="2024-01-15")),
    "scd2_customer": sql(ranged("priorities", "customerkey", as_of="2000-06-30")),
    "scd2_events_same_day": sql(ranged("event_versions", "user_id", as_of="2024-01-15")),
    "scd2_part": sql(ranged("part_versions", "productkey", as_of="2000-06-30")),
    "scd2_territory": sql(ranged("territories", "salesterritorykey", as_of="2024-01-15")),
    "current_event_versions": sql(
        "select * from flagged where is_valid = 1", flagged=ranged("event_versions", "user_id", as_of="2024-01-15")
    ),
    "latest_per_line": sql("select * from newest_sales"),
    "fact_sales": sql("select * from fact"),
    "order_labels_valid": sql("select * from valid_labels"),
    "latest_order_label": sql("select * from newest_labels"),
    "upsert_lines": sql(
        "select * from target where salesorderlinekey not in (select salesorderlinekey from source) "
        "union all select * from source",
        target="select distinct on (salesorderlinekey) * from sales where update_ts < timestamp '1998-01-01' "
               f"order by {SALES_NEWEST}",
        source="select distinct on (salesorderlinekey) * from sales where update_ts >= timestamp '1998-01-01' "
               f"order by {SALES_NEWEST}",
    ),
    "upsert_order_labels": sql(
        "select * from target where salesorderlinekey not in (select salesorderlinekey from source) "
        "union all select * from source",
        target="select distinct on (salesorderlinekey) * from valid_labels where update_ts < timestamp '1998-01-01' "
               f"order by {LABEL_NEWEST}",
        source="select distinct on (salesorderlinekey) * from valid_labels where update_ts >= timestamp '1998-01-01' "
               f"order by {LABEL_NEWEST}",
    ),
    "append_missing_dates": sql("select * from days where datekey >= 19990101"),
    "pit_customer": pit_customer("1900-01-01"),
    "pit_customer_default_floor": pit_customer("2000-01-01"),
    "pit_many_versions": sql(
        """select o_orderkey as orderkey, nationkey, cast(o_orderdate + interval 3 days as date) as duedate,
                  best_price, update_ts as version_ts
           from orders join customer on o_custkey = c_custkey
           join versions on nationkey = c_nationkey
            and cast(o_orderdate + interval 3 days as date) between valid_from and valid_to""",
        versions=ranged("nation_versions", "nationkey", "1900-01-01"),
    ),
    "mart_fallback_attributes": sql(
        """select line.salesorderlinekey,
                  coalesce(nullif(buyer.city, '[Not Applicable]'), shop.city) as city_combined,
                  coalesce(nullif(buyer.state_province, '[Not Applicable]'), shop.state_province)
                      as state_province_combined,
                  coalesce(nullif(buyer.country_region, '[Not Applicable]'), shop.country_region)
                      as country_region_combined
           from fact line
           join newest_customers buyer using (customerkey)
           join resellers shop on shop.resellerkey = line.resellerkey""",
        newest_customers="select distinct on (customerkey) * from customers order by customerkey, update_ts desc",
    ),
    "sales_mart": sql(MART, **dims("1900-01-01")),
    "sales_mart_default_floor": sql(MART, **dims("2000-01-01")),
    "customer_cohorts": COHORTS,
    "cohort_view": COHORTS,
    "duplicate_keys": sql(
        "select salesorderlinekey, update_ts, count(*) as n_rows from sales group by all having count(*) > 1"
    ),
    "null_keys": sql("select * from staged_customers where segment is null"),
    "key_report": sql(
        """select cast(sum(n) as bigint) as n_rows,
                  count(*) filter (where n > 1 and segment is not null) as n_duplicate_keys,
                  cast(coalesce(sum(n) filter (where segment is null), 0) as bigint) as n_null_keys
           from (select segment, count(*) as n from staged_customers group by all)"""
    ),
    "unmatched_facts": sql(
        " union all ".join([
            unmatched("customer", "customerkey"), unmatched("product", "productkey"),
            unmatched("reseller", "resellerkey"), unmatched("territory", "salesterritorykey"),
            """select 'calendar', count(*) from fact where orderdatekey not in (select cast(date as date) from days)""",
            """select 'orders', count(*) from fact
               where salesorderlinekey not in (select salesorderlinekey from newest_labels)""",
        ]),
        **dims("2000-01-01"),
    ),
    "normalized_names": """
        select p_partkey as productkey,
               trim(regexp_replace(lower('  ' || p_name || '-(%) ' || p_brand || ' ' || p_type), '[^a-z0-9]+', '_', 'g'),
                    '_') as name
        from part""",
    "csv_sheet": """
        select p_partkey as productkey, 'P-' || p_partkey as sku, p_name as product, p_retailprice as standard_cost,
               nullif(p_type, 'SMALL') as color, p_retailprice / 3 as list_price, p_brand as model,
               p_type as subcategory, cast(p_size as varchar) as category,
               timestamp '2000-06-01 00:00:00' as update_ts
        from part""",
    "rejected_rows": """
        select * from (
            select p_partkey // 1000 as thousand,
                   1 + row_number() over (partition by p_partkey // 1000 order by p_partkey) as source_line,
                   p_partkey || ',P-' || p_partkey ||
                   case when p_partkey % 53 = 0 then ''
                        when p_partkey % 89 = 0 then ',unknown' else ',' || p_size end as record,
                   case when p_partkey % 53 = 0 then 'not 3 cells'
                        when p_partkey % 89 = 0 then 'Standard Cost is not a double' end as problem
            from part)
        where problem is not null""",
    "accepted_rows": """
        select p_partkey as productkey, 'P-' || p_partkey as sku, cast(p_size as double) as standard_cost
        from part where p_partkey % 53 <> 0 and p_partkey % 89 <> 0""",
    "published_fact": sql("select * from fact"),
    "audit_log": sql(
        "select procedure_name, status, cast(n_records as bigint) as n_records, cast(n_rows as bigint) as n_rows "
        f"from ({STEPS})",
        n="""
            select *, n_labels + n_territories + n_sales + n_resellers + n_days + n_products + n_customers as n_all
            from (select (select count(distinct salesorderlinekey) from labels) as n_labels,
                         (select count(*) from newest_of_all where valid) as n_valid_labels,
                         (select count(*) from territories) as n_territories,
                         (select count(*) from newest_sales) as n_sales,
                         (select count(*) from resellers) as n_resellers,
                         (select count(*) from days) as n_days,
                         (select count(distinct productkey) from products) as n_products,
                         (select count(distinct customerkey) from customers) as n_customers)""",
        newest_of_all=NEWEST_OF_ALL,
    ),
    "stored_reseller_dim": sql("select * from dim_reseller", **TWICE_LOADED),
    "incremental_mart": sql(MART, **MOVED),
    "stored_mart": sql(MART, **TWICE_LOADED | {"newest_labels": f"select * from ({NEWEST_OF_ALL}) where valid"}),
}
