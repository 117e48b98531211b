"""The nine input tables as views over the driver tables.

The text runs in Spark and in DuckDB; only identifier quotes differ.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

BASE = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem"]

VIEWS = {
    "fx_orders": """
        select o_orderkey as order_id, o_orderkey as customer_id,
          case when o_orderkey % 50 = 0 then 'canceled' when o_orderkey % 75 = 1 then 'unavailable'
               when o_orderstatus = 'P' then 'shipped' else 'delivered' end as order_status,
          o_orderdate + (o_orderkey % 24) * interval '1' hour as order_purchase_timestamp,
          case when o_orderkey % 600 = 0 then null
               else o_orderdate + (o_orderkey % 24 + 1) * interval '1' hour end as order_approved_at,
          case when o_orderkey % 50 = 0 or o_orderkey % 75 = 1 then null
               else o_orderdate + interval '1' day end as order_delivered_carrier_date,
          case when o_orderkey % 50 = 0 or o_orderkey % 75 = 1 or o_orderstatus = 'P' then null
               when o_orderkey % 400 = 5 then o_orderdate - interval '2' day
               else o_orderdate + (1 + (o_orderkey * 7) % 45) * interval '1' day
                    + ((o_orderkey * 5) % 24) * interval '1' hour end as order_delivered_customer_date,
          o_orderdate + (10 + (o_orderkey * 3) % 30) * interval '1' day as order_estimated_delivery_date
        from orders
    """,
    "fx_customers": """
        select o_orderkey as customer_id, o_custkey as customer_unique_id,
          c_nationkey * 1000 + o_custkey % 1000 as customer_zip_code_prefix,
          lower(c_mktsegment) || '_' || cast(c_nationkey as varchar(10)) as customer_city,
          lower(n_name) as customer_state
        from orders join customer on c_custkey = o_custkey join nation on n_nationkey = c_nationkey
    """,
    "fx_order_items": """
        select l_orderkey as order_id,
          cast(row_number() over (partition by l_orderkey
            order by l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_shipdate) as int) as order_item_id,
          l_partkey as product_id, l_suppkey as seller_id, l_shipdate as shipping_limit_date,
          case when l_partkey % 97 = 0 then cast(0 as double) else l_extendedprice end as price,
          l_quantity * cast(1.5 as double) as freight_value
        from lineitem
    """,
    "fx_products": """
        select p_partkey as product_id,
          case when p_partkey % 53 = 0 then null
               else 'cat_' || lower(p_type) || '_' || cast(p_size % 5 as varchar(10)) end as product_category_name,
          cast(length(p_name) as int) as product_name_lenght,
          cast(length(p_name) * 16 as int) as product_description_lenght,
          cast(1 + p_partkey % 4 as int) as product_photos_qty,
          cast(case when p_partkey % 211 = 0 then 0 else p_size * 100 end as double) as product_weight_g,
          cast(p_size as double) as product_length_cm,
          cast(p_size % 17 as double) as product_height_cm,
          cast(p_size % 23 as double) as product_width_cm
        from part
    """,
    "fx_translation": """
        select distinct 'cat_' || lower(p_type) || '_' || cast(p_size % 5 as varchar(10)) as product_category_name,
          lower(p_type) || ' ' || cast(p_size % 5 as varchar(10)) as product_category_name_english
        from part where not (p_type = 'STANDARD' and p_size % 5 = 4)
    """,
    "fx_order_payments": """
        select o_orderkey as order_id, 1 as payment_sequential,
          case o_orderpriority when '1-URGENT' then 'credit_card' when '2-HIGH' then 'credit_card'
            when '3-MEDIUM' then 'boleto' when '4-NOT SPECIFIED' then 'voucher' else 'debit_card' end as payment_type,
          cast(1 + o_orderkey % 10 as int) as payment_installments, o_totalprice as payment_value
        from orders
        union all
        select o_orderkey + 100000000, 1, 'not_defined', 0, cast(0 as double) from orders where o_orderkey % 400 = 3
        union all
        select o_orderkey, 2, 'voucher', 1, cast(floor(o_totalprice / 10) as double) from orders where o_orderkey % 20 = 7
    """,
    "fx_order_reviews": """
        select o_orderkey as review_id, o_orderkey as order_id,
          case when o_orderkey % 300 = 11 then null when o_orderkey % 500 = 13 then 0
               else cast(1 + (o_orderkey * 7 + o_custkey) % 5 as int) end as review_score,
          case when o_orderkey % 8 = 0 then 'title ' || cast(o_orderkey % 10 as varchar(10)) end as review_comment_title,
          case when o_orderkey % 5 < 2 then 'message ' || cast(o_orderkey % 100 as varchar(10)) end as review_comment_message,
          o_orderdate + interval '20' day as review_creation_date,
          o_orderdate + interval '22' day as review_answer_timestamp
        from orders where o_orderkey % 9 <> 4
    """,
    "fx_sellers": """
        select s_suppkey as seller_id, s_nationkey * 1000 as seller_zip_code_prefix,
          'city_' || cast(s_suppkey % 7 as varchar(10)) as seller_city, lower(n_name) as seller_state
        from supplier join nation on n_nationkey = s_nationkey
    """,
    "fx_geolocation": """
        select c_nationkey * 1000 + c_custkey % 20 as geolocation_zip_code_prefix,
          cast(c_nationkey as double) as geolocation_lat, cast(c_custkey % 20 as double) as geolocation_lng,
          'city_' || cast(c_custkey % 20 as varchar(10)) as geolocation_city, lower(n_name) as geolocation_state
        from customer join nation on n_nationkey = c_nationkey
    """,
    "fx_dirty": """
        select p_partkey as `Item Id`,
          case when p_partkey % 31 = 0 then ' N/A ' when p_partkey % 37 = 0 then '-'
               when p_partkey % 41 = 0 then 'Null' when p_partkey % 43 = 0 then '   '
               else '  ' || p_name || ' ' end as ` Product--Label `,
          case p_partkey % 4 when 0 then 'ONLINE' when 1 then 'app ' when 2 then 'Marketplace' else 'phone' end as ` Channel`,
          case p_partkey % 4 when 0 then 'Y' when 1 then 'no' when 2 then ' YES' else 'n' end as `Returned `
        from part
    """,
}

TABLES = {
    "customers": "fx_customers",
    "geolocation": "fx_geolocation",
    "order_items": "fx_order_items",
    "order_payments": "fx_order_payments",
    "order_reviews": "fx_order_reviews",
    "orders": "fx_orders",
    "products": "fx_products",
    "sellers": "fx_sellers",
    "category_name_translation": "fx_translation",
}


def _view(spark: SparkSession, folder: str, view: str) -> DataFrame:
    text = VIEWS[view]
    for name in BASE:
        if re.search(rf"\b(from|join) {name}\b", text):
            spark.read.parquet(f"{folder}/{name}.parquet").createOrReplaceTempView(name)
    return spark.sql(text)


def tables(spark: SparkSession, folder: str, *names: str) -> dict[str, DataFrame]:
    return {name: _view(spark, folder, TABLES[name]) for name in names or TABLES}


def dirty(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """One table with untidy names, tokens and labels."""
    return {"catalog": _view(spark, folder, "fx_dirty")}


def with_views(sql: str, extra: dict[str, str], keyed: dict[str, str]) -> str:
    """DuckDB text: ``sql`` with the views it uses, also indirectly, as CTEs in front.

    ``keyed`` gives the heads of recursive views.
    """
    known = {**{k: v.replace("`", '"') for k, v in VIEWS.items()}, **extra}
    used: list[str] = []
    seen: set[str] = set()

    def visit(text: str) -> None:
        for name in known:
            if name not in seen and re.search(rf"\b{name}\b", text):
                seen.add(name)
                visit(known[name])
                used.append(name)

    visit(sql)
    heads = {name: keyed[name] if name in keyed else name for name in used}
    recursive = "recursive " if any(name in keyed for name in used) else ""
    ctes = ",\n".join(f"{heads[name]} as ({known[name]})" for name in used)
    return f"with {recursive}{ctes}\nselect * from ({sql})" if used else sql
