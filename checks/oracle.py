"""The same results in DuckDB SQL, written from the definitions and not from the Spark plans."""

from __future__ import annotations

from itertools import combinations_with_replacement

from checks.adapter import TABLES, with_views
from patronscope import schema
from patronscope.operators import segments

WHO = "customer_unique_id"

# Columns and types of the nine tables, in order.
COLUMNS = {
    "customers": "customer_id bigint, customer_unique_id bigint, customer_zip_code_prefix bigint, customer_city string, customer_state string",
    "geolocation": "geolocation_zip_code_prefix bigint, geolocation_lat double, geolocation_lng double, geolocation_city string, geolocation_state string",
    "order_items": "order_id bigint, order_item_id int, product_id bigint, seller_id bigint, shipping_limit_date timestamp_ntz, price double, freight_value double",
    "order_payments": "order_id bigint, payment_sequential int, payment_type string, payment_installments int, payment_value double",
    "order_reviews": "review_id bigint, order_id bigint, review_score int, review_comment_title string, review_comment_message string, review_creation_date timestamp_ntz, review_answer_timestamp timestamp_ntz",
    "orders": "order_id bigint, customer_id bigint, order_status string, order_purchase_timestamp timestamp_ntz, order_approved_at timestamp_ntz, order_delivered_carrier_date timestamp_ntz, order_delivered_customer_date timestamp_ntz, order_estimated_delivery_date timestamp_ntz",
    "products": "product_id bigint, product_category_name string, product_name_lenght int, product_description_lenght int, product_photos_qty int, product_weight_g double, product_length_cm double, product_height_cm double, product_width_cm double",
    "sellers": "seller_id bigint, seller_zip_code_prefix int, seller_city string, seller_state string",
    "category_name_translation": "product_category_name string, product_category_name_english string",
}
LAYOUT = {t: [tuple(c.split()) for c in text.split(", ")] for t, text in COLUMNS.items()}


def days(start: str, end: str) -> str:
    return f"cast(floor((epoch_us({end}) - epoch_us({start})) / 86400000000.0) as bigint)"


def favorite(source: str, value: str, name: str, key: str = WHO) -> str:
    return f"""
        select {key}, max(case when place = 1 then {value} end) as {name} from (
          select {key}, {value}, row_number() over (partition by {key} order by ({value} is null), n desc, {value}) as place
          from (select {key}, {value}, count(*) as n from {source} where {key} is not null group by all))
        group by {key}"""


def histogram(source: str, column: str) -> str:
    return f"""
        with v as (select cast({column} as double) as v from ({source}) where {column} is not null),
        r as (select min(v) as a, max(v) as b from v),
        h as (select cast(least(floor((v - a) / (b - a) * 40), 39) as bigint) as bin, count(*) as n from v, r group by 1)
        select s.bin, round(a + s.bin * ((b - a) / 40), 6) as bin_start, round(a + (s.bin + 1) * ((b - a) / 40), 6) as bin_end,
          coalesce(n, 0) as n
        from (select unnest(range(40)) as bin) s cross join r left join h on h.bin = s.bin"""


def clipped(table: str, column: str) -> str:
    return f"select least({column}, (select quantile_cont({column}, 0.99) from {table})) as {column} from {table} where {column} is not null"


SIMPLE_SAMPLE = "order by md5(concat_ws('-', {keys}, '{seed}')), {keys} limit {n}"

MODEL = schema.MODEL_FEATURES
Z = [f"z_{c}" for c in MODEL]


def gap(a: str, b: str, dims: list[str]) -> str:
    return " + ".join(f"({a}.{d} - {b}.{d}) * ({a}.{d} - {b}.{d})" for d in dims)


VIEWS = {
    "o_flat": """select * from fx_orders left join fx_customers using (customer_id)
        left join fx_order_items using (order_id) left join fx_products using (product_id)
        left join fx_translation using (product_category_name)""",
    "o_map": "select distinct order_id, customer_unique_id from fx_orders left join fx_customers using (customer_id)",
    "o_payments": "select * from fx_order_payments left join o_map using (order_id)",
    "o_reviews": "select * from fx_order_reviews left join o_map using (order_id)",
    "o_snapshot": "select max(order_purchase_timestamp) + interval 1 day as snapshot_date from fx_orders",
    "o_totals": """select order_id, customer_unique_id, order_purchase_timestamp,
        coalesce(sum(cast(price as decimal(18,2))), 0) as p, coalesce(sum(cast(freight_value as decimal(18,2))), 0) as f
        from o_flat where order_id is not null and customer_unique_id is not null and order_purchase_timestamp is not null
        group by all""",
    "o_rfm": f"""select customer_unique_id, {days('max(order_purchase_timestamp)', '(select snapshot_date from o_snapshot)')} as recency,
        count(distinct order_id) as frequency, cast(sum(p + f) as double) as monetary,
        cast(sum(p + f) as double) / count(distinct order_id) as avg_order_value
        from o_totals group by customer_unique_id""",
    "o_category": favorite("o_flat", "product_category_name_english", "preferred_category"),
    "o_area": """select customer_unique_id, arg_min(customer_state, (order_purchase_timestamp, order_id)) as customer_state,
        arg_min(customer_city, (order_purchase_timestamp, order_id)) as customer_city
        from o_flat where customer_unique_id is not null group by 1""",
    "o_returns": """select customer_unique_id, count(distinct order_id) as total_orders,
        count(distinct case when order_status in ('canceled', 'unavailable') then order_id end) as problematic_orders,
        count(distinct case when order_status in ('canceled', 'unavailable') then order_id end) / count(distinct order_id) as return_rate
        from o_flat where customer_unique_id is not null group by 1""",
    "o_channel": favorite("o_payments", "payment_type", "preferred_channel"),
    "o_installments": """select customer_unique_id, avg(payment_installments) as avg_installments
        from o_payments where customer_unique_id is not null group by 1""",
    "o_score": """select customer_unique_id, avg(review_score) as avg_review_score
        from o_reviews where customer_unique_id is not null group by 1""",
    "o_delivery": f"""select customer_unique_id,
        avg({days('order_estimated_delivery_date', 'order_delivered_customer_date')}) as delivery_delay,
        avg({days('order_purchase_timestamp', 'order_delivered_customer_date')}) as avg_delivery_time
        from o_flat where customer_unique_id is not null group by 1""",
    "o_ratio": """select customer_unique_id, avg(freight_value / nullif(price, 0)) as avg_freight_ratio
        from o_flat where customer_unique_id is not null group by 1""",
    "o_diversity": """select customer_unique_id, count(distinct product_category_name_english) as category_diversity
        from o_flat where customer_unique_id is not null group by 1""",
    "o_tenure": f"""select customer_unique_id, {days('min(order_purchase_timestamp)', 'max(order_purchase_timestamp)')} as tenure_days
        from o_flat where customer_unique_id is not null group by 1""",
    "o_features": "select " + ", ".join(schema.FEATURE_COLUMNS) + """ from o_rfm left join o_category using (customer_unique_id)
        left join o_area using (customer_unique_id) left join o_returns using (customer_unique_id)
        left join o_channel using (customer_unique_id) left join o_installments using (customer_unique_id)
        left join o_score using (customer_unique_id) left join o_delivery using (customer_unique_id)
        left join o_ratio using (customer_unique_id) left join o_diversity using (customer_unique_id)
        left join o_tenure using (customer_unique_id)""",
    "o_logs": "select *, " + ", ".join(
        f"ln(1 + greatest(cast({c} as double), 0)) as {c}_log" for c in schema.LOG_FEATURES
    ) + " from o_features",
    "o_imputed": "select customer_unique_id, " + ", ".join(
        f"cast(coalesce({c}, (select median({c}) from o_features)) as double) as {c}"
        if c in schema.MEDIAN_FILLED else f"cast(coalesce({c}, 0) as double) as {c}"
        for c in MODEL
    ) + " from o_logs",
    "o_constants": "select " + ", ".join(
        f"avg({c}) as m_{c}, coalesce(nullif(stddev_pop({c}), 0), 1) as s_{c}" for c in MODEL
    ) + " from o_imputed",
    "o_scaled": "select customer_unique_id, " + ", ".join(
        f"({c} - m_{c}) / s_{c} as z_{c}" for c in MODEL
    ) + " from o_imputed, o_constants",
    "o_labeled": "select *, cast(customer_unique_id % 5 as int) as label from o_scaled",
    "o_segments": "select *, cast(customer_unique_id % 5 as int) as segment from o_features",
    "o_top_category": favorite("o_segments", "preferred_category", "top_category", "segment"),
    "o_top_channel": favorite("o_segments", "preferred_channel", "top_channel", "segment"),
    "o_profile": "select segment, count(customer_unique_id) as customers, " + ", ".join(
        f"avg({f}) as {n}" for n, f in segments.AVERAGES.items()
    ) + """, sum(monetary) as total_revenue,
        100.0 * count(customer_unique_id) / (select count(*) from o_segments) as pct_of_customers,
        100.0 * sum(monetary) / (select sum(monetary) from o_segments) as pct_of_revenue
        from o_segments group by segment""",
    "o_named": f"""select *, case
        when coalesce(avg_frequency > 1.5 and high and avg_review_score >= 4, false) then '{segments.LOYAL}'
        when coalesce(high and avg_review_score >= 4, false) and not coalesce(avg_delivery_delay > 0, false) then '{segments.ONE_TIME}'
        when coalesce(avg_delivery_delay > 0 and avg_review_score < 3, false) then '{segments.FRUSTRATED}'
        when coalesce(avg_return_rate > 0.1, false) then '{segments.RETURNERS}'
        when not high and coalesce(avg_review_score >= 4, false) then '{segments.EVERYDAY}'
        else '{segments.OCCASIONAL}' end as segment_name
        from (select *, avg_monetary > (select median(avg_monetary) from o_profile) as high from o_profile)""",
    "o_insights": f"""select 0 as line_no, '{segments.INSIGHT_HEADER}' as line union all
        select row_number() over (order by pct_of_revenue desc, segment),
          'Segment ''' || segment_name || ''' (' || printf('%.0f', pct_of_customers) || '% of customers) generates '
          || printf('%.0f', pct_of_revenue) || '% of revenue, with ' || printf('%.1f', avg_review_score)
          || ' avg rating and ' || printf('%.0f', avg_return_rate * 100) || '% return rate.'
        from o_named union all
        select (select count(*) from o_named) + 1, '' union all
        select (select count(*) from o_named) + 2, '{segments.RECOMMENDATION}'""",
    "o_items": "select * from fx_order_items left join fx_products using (product_id) left join fx_translation using (product_category_name)",
    "o_top10": """select product_category_name_english, count(*) as n from o_items
        where product_category_name_english is not null group by 1 order by n desc, 1 limit 10""",
    "o_clean_names": """select "Item Id" as item_id, " Product--Label " as product_label, " Channel" as channel, "Returned " as returned
        from fx_dirty""",
    "o_eps_pairs": f"""select a.customer_unique_id as a, b.customer_unique_id as b from o_scaled a, o_scaled b
        where {gap('a', 'b', Z)} <= 2.25""",
    "o_core": "select a as id from o_eps_pairs group by a having count(*) >= 10",
    "o_core_edges": "select a, b from o_eps_pairs where a in (select id from o_core) and b in (select id from o_core)",
    "o_reach": """select id, id as cluster from o_core
        union
        select e.b, min(r.cluster) from o_reach r join o_core_edges e on e.a = r.id
          join recurring.o_reach t on t.id = e.b
        where r.cluster < t.cluster group by e.b""",
}

VIEWS["o_planted"] = f"""select order_id as {WHO}, place, (order_id * 37) % 101 / 101 + place * 40 as x,
    (order_id * 53) % 103 / 103 + (place % 2) * 60 as y from (select order_id,
    case when order_id % 15 < 5 then 0 when order_id % 15 < 9 then 1 when order_id % 15 < 12 then 2 when order_id % 15 < 14 then 3 else 4 end as place
    from fx_orders)"""
VIEWS["o_planted_groups"] = f"select {WHO}, min({WHO}) over (partition by place) as first from o_planted"

VIEWS["o_spreads"] = """select p.place, x, y, avg(sqrt((p.px - c.x) ** 2 + (p.py - c.y) ** 2)) as s
    from (select place, x as px, y as py from o_planted) p join (select place, avg(x) as x, avg(y) as y from o_planted group by 1) c using (place) group by all"""
VIEWS["o_joined_spreads"] = """select p.place, x, y, avg(sqrt((p.px - c.x) ** 2 + (p.py - c.y) ** 2)) as s
    from (select place, x as px, y as py from (select * replace (least(place, 3) as place) from o_planted)) p join (select place, avg(x) as x, avg(y) as y from (select * replace (least(place, 3) as place) from o_planted) group by 1) c using (place) group by all"""
KEYED = {"o_reach": "o_reach(id, cluster) using key (id)"}


def _union(template: str) -> str:
    """One select per (table, column)."""
    return " union all ".join(
        template.format(t=t, v=TABLES[t], c=c, i=i, k=k) for t, cols in LAYOUT.items() for i, (c, k) in enumerate(cols)
    )


def _shapes(extra: str = "") -> str:
    return " union all ".join(
        f"select '{t}' as dataset, count(*) as rows, {len(cols)} as columns from {TABLES[t]}" for t, cols in LAYOUT.items()
    )


def _describe() -> str:
    parts = []
    none = "cast(null as double)"
    for t, cols in LAYOUT.items():
        for c, k in cols:
            v = TABLES[t]
            if k == "string":
                parts.append(
                    f"""select '{t}' as dataset, '{c}' as "column", 'text' as kind, cast(sum(n) filter ({c} is not null) as bigint) as count,
                    count({c}) as "unique", arg_min({c}, (-n, {c})) filter ({c} is not null) as top, max(n) filter ({c} is not null) as freq,
                    {none} as mean, {none} as std, {none} as min, {none} as p25, {none} as p50, {none} as p75, {none} as max
                    from (select {c}, count(*) as n from {v} group by 1)"""
                )
                continue
            kind = "timestamp" if k.startswith("timestamp") else "number"
            x = f"epoch_us({c}) / 1e6" if kind == "timestamp" else f"cast({c} as double)"
            std = none if kind == "timestamp" else "round(stddev_samp(x), 4)"
            parts.append(
                f"""select '{t}', '{c}', '{kind}', count(x), null, null, null, round(avg(x), 4), {std}, round(min(x), 4),
                round(quantile_cont(x, 0.25), 4), round(quantile_cont(x, 0.5), 4), round(quantile_cont(x, 0.75), 4), round(max(x), 4)
                from (select {x} as x from {v})"""
            )
    parts.sort(key=lambda p: "as dataset" not in p)  # the select with the names comes first
    return " union all ".join(parts)


def _nulls(view_of=lambda t: TABLES[t]) -> str:
    return " union all ".join(
        f"""select '{t}' as dataset, '{c}' as "column", count(*) - count({c}) as count,
        round((count(*) - count({c})) / count(*) * 100, 6) as percentage from {view_of(t)}"""
        for t, cols in LAYOUT.items() for c, _ in cols
    )


def _duplicates() -> str:
    return " union all ".join(
        f"""select '{t}' as dataset, (select count(*) from {TABLES[t]}) - (select count(*) from (select distinct * from {TABLES[t]})) as exact_duplicates"""
        for t in LAYOUT
    )


TOKENS = "('NA', 'N/A', 'Null', 'null', '-', '')"
STRIP_TOKENS = "('NA', 'N/A', 'Null', 'null', '-')"


def _hidden() -> str:
    parts = [
        f"""select '{t}' as dataset, '{c}' as "column", count(*) filter ({c} in {TOKENS}) as hidden_null_count from {TABLES[t]}"""
        for t, cols in LAYOUT.items() for c, k in cols if k == "string"
    ] + [
        f"""select 'catalog', '{c}', count(*) filter ("{c}" in {TOKENS}) from fx_dirty""" for c in (" Product--Label ", " Channel", "Returned ")
    ]
    return f"select * from ({' union all '.join(parts)}) where hidden_null_count > 0"


RULES = [
    ("price > 0", "fx_order_items", "price <= 0"),
    ("freight_value >= 0", "fx_order_items", "freight_value < 0"),
    ("payment_value > 0", "fx_order_payments", "payment_value <= 0"),
    ("review_score between 1 and 5", "fx_order_reviews", "not coalesce(review_score between 1 and 5, false)"),
    ("product_weight_g > 0", "fx_products", "product_weight_g <= 0"),
    ("product_length_cm > 0", "fx_products", "product_length_cm <= 0"),
    ("product_height_cm > 0", "fx_products", "product_height_cm <= 0"),
    ("product_width_cm > 0", "fx_products", "product_width_cm <= 0"),
    ("delivery_date >= purchase_date", "fx_orders", "order_delivered_customer_date < order_purchase_timestamp"),
]


def _rules(*positions: int) -> str:
    return " union all ".join(
        f"select '{RULES[i][0]}' as rule, count(*) filter ({RULES[i][2]}) as invalid_count from {RULES[i][1]}" for i in positions
    )


def _dirty(f, source="o_clean_names") -> str:
    return "select item_id, " + ", ".join(f"{f(c)} as {c}" for c in ("product_label", "channel", "returned")) + f" from {source}"


def _strip(c):
    return f"regexp_replace({c}, '^\\s+|\\s+$', '', 'g')"


def _labels(c, labels):
    return f"case {c} " + " ".join(f"when '{a}' then '{b}'" for a, b in labels.items()) + f" else {c} end"


def _log_rows() -> str:
    return " union all ".join(
        f"""select 'catalog' as dataset, '{c}' as "column", '{a}' as old_value, '{b}' as new_value,
        count(*) filter (lower({_strip(c)}) = '{a}') as rows from o_clean_names"""
        for c, labels in schema.STANDARD_LABELS.items() for a, b in labels.items()
    )


def _contents(as_text: bool, changed: dict[tuple[str, str], str] | None = None) -> str:
    """Known values and the sum of what they stand for. ``as_text``: only declared columns are typed, others are text."""
    parts = []
    for t, cols in LAYOUT.items():
        typed = [*schema.TIMESTAMP_COLUMNS.get(t, []), *schema.INTEGER_COLUMNS.get(t, []), *schema.DOUBLE_COLUMNS.get(t, [])]
        for c, k in cols:
            x = (changed or {}).get((t, c), c)
            if k == "string" or (as_text and c not in typed):
                value = f"cast('0x' || substr(md5(cast({x} as varchar)), 1, 8) as bigint)"
            elif k.startswith("timestamp"):
                value = f"epoch_us({x})"
            else:
                value = f"round(cast({x} as double) * 10000)"
            parts.append(f"""select '{t}' as dataset, '{c}' as "column", count({x}) as known,
                cast(sum(cast({value} as decimal(28,0))) as varchar) as total from {TABLES[t]}""")
    return " union all ".join(parts)


def _text(c):
    return f"strftime({c}, '%Y-%m-%d %H:%M:%S')"


def _round_features() -> str:
    doubles = {"monetary", "avg_order_value", "return_rate", "avg_installments", "avg_review_score", "delivery_delay", "avg_delivery_time", "avg_freight_ratio"}
    return "select " + ", ".join(f"round({c}, 6) as {c}" if c in doubles else c for c in schema.FEATURE_COLUMNS) + " from o_features"


def _counted(table: str, column: str, more: str = "") -> str:
    return f"select {column}, count(*) as n{more} from {table} where {column} is not null group by 1"


def _correlations() -> str:
    parts = []
    for a, b in combinations_with_replacement(schema.NUMERIC_FEATURES, 2):
        for x, y in dict.fromkeys([(a, b), (b, a)]):
            parts.append(f"select '{x}' as feature_x, '{y}' as feature_y, round(corr({x}, {y}), 6) as r from o_features")
    return " union all ".join(parts)


def _quantiles() -> str:
    return " union all ".join(
        f"""select count(*) as rows, '{w}' as way, '{c}' as "column", cast({p} as double) as p, round(quantile_cont({c}, {p}), 6) as value from fx_order_items"""
        for w in ("direct", "search") for c in ("price", "freight_value") for p in (0.25, 0.5, 0.99)
    )


RANKED = ", ".join(
    c if c in ("segment", "segment_name") else f"round({c}, 2) + 0.0 as {c}" for c in segments.RANKING_COLUMNS
)

SQL = {
    "io1_csv_load": _shapes(),
    "io1_csv_contents": _contents(True),
    "io1_quoted_csv": """select review_id, order_id, case when review_id % 3 = 0 then 'a "quoted"' || chr(10) || 'line, ' || review_comment_message
        || chr(10) || chr(10) || '"end"' end as review_comment_message, review_score from fx_order_reviews""",
    "io5_clean_contents": _contents(False),
    "io6_observed_audits": "select 'missing' as audit, dataset, \"column\" as name, count as n from (" + _nulls() + ") union all "
    + f"select 'rule', '', rule, invalid_count from ({_rules(*range(len(RULES)))})",
    "cl9_dirty_flow": _contents(True, {("orders", "order_status"): "(case when order_id % 7 <> 0 then order_status end)"}),
    "io2_missing_tables": """select count(*) as orders,
        'category_name_translation,customers,geolocation,order_items,order_payments,order_reviews,products,sellers' as missing,
        true as fails_if_empty from fx_orders""",
    "io3_null_tokens": _dirty(lambda c: f"case when {c} in ('N/A', 'NA', 'null', '') then null else {c} end"),
    "io4_feature_reload": "select customer_unique_id, recency, frequency, monetary, preferred_category from o_features",
    "io5_clean_sink": _shapes(),
    "io6_audit_sink": f"""select 'missing_values_audit' as "table", {sum(map(len, LAYOUT.values()))} as rows union all
        select 'exact_duplicates_audit', 9 union all select 'duplicate_order_ids', 1 union all
        select 'hidden_nulls_audit', count(*) from ({_hidden()}) where dataset <> 'catalog' union all
        select 'text_label_mapping_log', 0 union all select 'business_rule_validation', 9 union all select 'type_log', 0""",
    "io7_feature_sink": """select count(*) as rows, cast(sum(frequency) as bigint) as orders, count(preferred_category) as with_category,
        17 as columns from o_features""",
    "io8_profile_sink": "select segment, customers, segment_name from o_named",
    "io9_insight_text": "select line from o_insights",
    "in1_columns": _union("""select '{t}' as dataset, {i} as position, '{c}' as "column", (select count(*) from {v}) as rows"""),
    "in2_shapes": _shapes(),
    "in3_column_info": _union("""select '{t}' as dataset, '{c}' as "column", '{k}' as dtype, count({c}) as non_null from {v}"""),
    "in4_describe": _describe(),
    "au1_missing_values": _nulls(),
    "au2_exact_duplicates": _duplicates(),
    "au3_duplicate_order_ids": " union all ".join(
        f"select '{t}' as dataset, count(*) - (select count(*) from (select distinct order_id from {TABLES[t]})) as duplicates from {TABLES[t]}"
        for t in ("orders", "order_payments")
    ),
    "au4_hidden_nulls": _hidden(),
    "dq7_business_rules": " union all ".join(
        f"select {i} as position, rule, invalid_count from ({_rules(i)})" for i in range(9)
    ),
    "dq1_price": _rules(0),
    "dq2_freight": _rules(1),
    "dq3_payment": _rules(2),
    "dq4_review_score": _rules(3),
    "dq5_dimensions": _rules(4, 5, 6, 7),
    "dq6_delivery_date": _rules(8),
    "cl1_column_names": "select * from o_clean_names",
    "cl2_strip_and_nulls": _dirty(lambda c: f"case when {_strip(c)} in {STRIP_TOKENS} then null else {_strip(c)} end"),
    "cl3_lower": _dirty(lambda c: _strip(f"lower({c})")),
    "cl4_labels": "select item_id, product_label, "
    + ", ".join(f"{_labels(c, labels)} as {c}" for c, labels in schema.STANDARD_LABELS.items())
    + " from (" + _dirty(lambda c: f"lower(case when {_strip(c)} in {STRIP_TOKENS} then null else {_strip(c)} end)") + ")",
    "cl5_label_log": _log_rows(),
    "cl6_timestamps": f"""select order_id, case when order_id % 3 <> 0 then {_text('order_purchase_timestamp')} end as purchased,
        {_text('order_delivered_customer_date')} as delivered from fx_orders""",
    "cl7_numbers": "select order_id, order_item_id, case when order_id % 3 <> 0 then price end as price, freight_value from fx_order_items",
    "s9_column_types": """select 'orders' as dataset, order_id as id, cast(case order_id % 4 when 0 then epoch_us(date_trunc('day', order_purchase_timestamp))
          when 2 then epoch_us(order_purchase_timestamp) + 250000 else epoch_us(order_purchase_timestamp) end as double) as a,
          cast(epoch_us(date_trunc('day', order_estimated_delivery_date)) as double) as b from fx_orders
        union all select 'order_items', order_id, order_item_id + case when order_id % 5 = 0 then 0.5 else 0 end, null from fx_order_items
        union all select 'order_reviews', order_id, 3000000000 + review_score, null from fx_order_reviews""",
    "cl8_categories": "select order_status, count(*) as n from fx_orders group by 1",
    "cl9_cleaning_flow": _nulls(),
    "cl10_dated_orders": "select order_id, order_status from fx_orders where order_delivered_customer_date is not null",
    "cl11_delivery_range": f"select * from (select order_id, {days('order_purchase_timestamp', 'order_delivered_customer_date')} as days from fx_orders) where days between 0 and 60",
    "cl13_rename": "select product_id, product_category_name as category from fx_products",
    "jn1_orders_customers": "select order_id, order_status, customer_unique_id, customer_state, customer_city from fx_orders left join fx_customers using (customer_id)",
    "jn2_orders_items": "select order_id, order_item_id, product_id, price from fx_orders left join fx_order_items using (order_id)",
    "jn3_items_products": "select order_id, order_item_id, product_category_name, product_weight_g from fx_order_items left join fx_products using (product_id)",
    "jn4_category_names": "select product_id, product_category_name, product_category_name_english from fx_products left join fx_translation using (product_category_name)",
    "jn5_flat_table": """select order_id, customer_unique_id, order_status, order_item_id, product_id, price, freight_value,
        product_category_name, product_category_name_english, customer_state from o_flat""",
    "jn6_payments_customers": "select * from o_payments",
    "jn7_reviews_customers": "select review_id, order_id, review_score, customer_unique_id from o_reviews",
    "jn8_feature_assembly": _round_features(),
    "jn9_items_categories": "select order_id, order_item_id, product_id, product_category_name_english from o_items",
    "jn10_reviews_categories": """select review_id, r.order_id, review_score, product_id, product_category_name_english
        from fx_order_reviews r join fx_orders using (order_id) left join o_items i on i.order_id = r.order_id""",
    "jn11_top_category_items": """select order_id, order_item_id, product_category_name_english from o_items
        where product_category_name_english in (select product_category_name_english from o_top10)""",
    "jn12_segment_favorites": "select segment, top_category, top_channel from o_top_category join o_top_channel using (segment)",
    "fe1_snapshot": f"select {_text('snapshot_date')} as snapshot_date from o_snapshot",
    "fe2_order_totals": """select order_id, customer_unique_id, cast(p as double) as order_total, cast(f as double) as order_freight,
        cast(p + f as double) as order_total_with_freight from o_totals""",
    "fe3_recency": "select customer_unique_id, recency from o_rfm",
    "fe4_frequency": "select customer_unique_id, frequency from o_rfm",
    "fe5_monetary": "select customer_unique_id, monetary from o_rfm",
    "fe6_rfm": "select * from o_rfm",
    "fe7_preferred_category": "select * from o_category",
    "fe8_area": "select * from o_area",
    "fe9_return_rate": "select * from o_returns",
    "fe10_preferred_channel": "select * from o_channel",
    "fe11_avg_installments": "select * from o_installments",
    "fe12_avg_review_score": "select * from o_score",
    "fe13_delivery_delay": "select customer_unique_id, delivery_delay from o_delivery",
    "fe14_delivery_time": "select customer_unique_id, avg_delivery_time from o_delivery",
    "fe15_freight_ratio": "select customer_unique_id, round(avg_freight_ratio, 6) as avg_freight_ratio from o_ratio",
    "fe16_category_diversity": "select * from o_diversity",
    "fe17_tenure": "select * from o_tenure",
    "fe18_feature_table": _round_features(),
    "ch1_order_status": _counted("fx_orders", "order_status"),
    "ch2_review_scores": _counted("fx_order_reviews", "review_score"),
    "ch3_monthly_orders": """with m as (select date_trunc('month', order_purchase_timestamp) as month, count(*) as n from fx_orders
          where order_purchase_timestamp is not null group by 1)
        select strftime(s.month, '%Y-%m-%d') as month, coalesce(n, 0) as n
        from (select unnest(generate_series((select min(month) from m), (select max(month) from m), interval 1 month)) as month) s
        left join m on m.month = s.month""",
    "ch4_top_states": _counted("fx_customers", "customer_state") + " order by n desc, 1 limit 10",
    "ch5_top_categories": "select * from o_top10",
    "ch6_payment_types": _counted("fx_order_payments", "payment_type", ", round(100.0 * count(*) / sum(count(*)) over (), 6) as share"),
    "ch7_installments": _counted("fx_order_payments", "payment_installments"),
    "ch8_price_histogram": histogram(clipped("fx_order_items", "price"), "price"),
    "ch9_price_freight_sample": "select order_id, order_item_id, price, freight_value from fx_order_items "
    + SIMPLE_SAMPLE.format(keys="order_id, order_item_id", seed=1, n=3000),
    "ch10_delivery_histogram": histogram(
        f"select * from (select {days('order_purchase_timestamp', 'order_delivered_customer_date')} as days from fx_orders) where days between 0 and 60", "days"
    ),
    "ch11_top_sellers": """select *, 'S' || row_number() over (order by n desc, seller_id) as rank_label from (
        select seller_id, count(*) as n from fx_order_items where seller_id is not null group by 1 order by n desc, 1 limit 10)""",
    "ch12_top_category_scores": """select product_category_name_english, round(avg(review_score), 6) as avg_review_score
        from fx_order_reviews r join (select order_id from fx_orders) using (order_id) left join o_items i on i.order_id = r.order_id
        where product_category_name_english in (select product_category_name_english from o_top10) group by 1""",
    "ch13_correlations": _correlations(),
    "ch14_monetary_histogram": histogram(clipped("o_features", "monetary"), "monetary"),
    "ch15_recency_frequency_sample": "select customer_unique_id, recency, frequency, monetary from o_features "
    + SIMPLE_SAMPLE.format(keys="customer_unique_id", seed=1, n=3000),
    "ch16_top_states_features": _counted("o_features", "customer_state") + " order by n desc, 1 limit 10",
    "ch17_preferred_categories": _counted("o_features", "preferred_category") + " order by n desc, 1 limit 10",
    "ch19_segment_sizes": "select segment, round(pct_of_customers, 6) as pct_of_customers from o_profile",
    "s6_clip": """select order_id, order_item_id, greatest(1000, least(price, (select quantile_cont(price, 0.99) from fx_order_items))) as price
        from fx_order_items""",
    "s10_floor_days": f"select order_id, {days('order_estimated_delivery_date', 'order_delivered_customer_date')} as days from fx_orders",
    "s12_quantiles": _quantiles(),
    "s14_fixed_sample": "select order_id, order_status from fx_orders " + SIMPLE_SAMPLE.format(keys="order_id", seed=7, n=3000),
    "s15_shares": _counted("fx_orders", "order_status", ", round(count(*) / sum(count(*)) over (), 6) as share"),
    "s17_number_text": """select customer_unique_id, printf('%.1f', avg_review_score) as score, printf('%.0f', avg_order_value) as value,
        printf('%.0f', return_rate * 100) as returns from o_features""",
    "ml1_log_features": "select customer_unique_id, " + ", ".join(f"round({c}_log, 6) as {c}_log" for c in schema.LOG_FEATURES) + " from o_logs",
    "ml2_imputed": "select customer_unique_id, " + ", ".join(f"round({c}, 6) as {c}" for c in MODEL) + " from o_imputed",
    "ml3_scaled": "select customer_unique_id, " + ", ".join(f"round({z}, 6) as {z}" for z in Z) + " from o_scaled",
    "ml7_dbscan": """with border as (
          select p.a as id, min(r.cluster) as cluster from o_eps_pairs p join o_reach r on r.id = p.b
          where p.a not in (select id from o_core) group by 1),
        members as (select id, cluster from o_reach union all select id, cluster from border)
        select customer_unique_id, cast(coalesce(label, -1) as int) as label from o_scaled
        left join (select id, dense_rank() over (order by cluster) - 1 as label from members) m on m.id = customer_unique_id""",
    "ml7_few_pivots": """with border as (
          select p.a as id, min(r.cluster) as cluster from o_eps_pairs p join o_reach r on r.id = p.b
          where p.a not in (select id from o_core) group by 1),
        members as (select id, cluster from o_reach union all select id, cluster from border)
        select customer_unique_id, cast(coalesce(label, -1) as int) as label from o_scaled
        left join (select id, dense_rank() over (order by cluster) - 1 as label from members) m on m.id = customer_unique_id""",
    "ml8_planted": """with g as (select order_id, order_id % 15 as g from fx_orders),
        p as (select order_id, case when g < 5 then 0 when g < 9 then 1 when g < 12 then 2 when g < 14 then 3 else 4 end as place from g)
        select order_id, cast(row as int) as label from p join
          (select place, row_number() over (order by count(*) desc, place) - 1 as row from p group by 1) using (place)""",
    "ml4_planted": "select cast(k as int) as k, k = 5 as chosen from (select unnest(range(2, 9)) as k)",
    "ml5_planted": "select * from o_planted_groups",
    "ml9_planted": " union all ".join(f"select '{m}' as model, * from o_planted_groups" for m in ("kmeans", "dbscan", "hierarchical")),
    "io10_planted": "select * from o_planted_groups",
    "ev4_planted": " union all ".join(
        f"""select '{m}' as model, round(avg(worst), 6) as davies_bouldin from (
          select a.place, max((a.s + b.s) / sqrt((a.x - b.x) ** 2 + (a.y - b.y) ** 2)) as worst from {v} a join {v} b on a.place <> b.place group by 1)"""
        for m, v in (("right", "o_spreads"), ("joined", "o_joined_spreads"))
    ),
    "ev1_silhouette": f"""with s as (select * from o_labeled {SIMPLE_SAMPLE.format(keys='customer_unique_id', seed=42, n=5000)}),
        sizes as (select label, count(*) as size from s group by 1),
        d as (select a.customer_unique_id as id, a.label as own, b.label as other, sum(sqrt({gap('a', 'b', Z)})) as total
          from s a, s b group by all),
        p as (select id, max(total / (size - 1)) filter (own = other and size > 1) as a,
          min(total / size) filter (own <> other) as b, max(size) filter (own = other) as n from d join sizes on label = other group by 1)
        select 'label' as model, round(avg(case when n = 1 then 0 else (b - a) / greatest(a, b) end), 6) as silhouette from p""",
    "ev2_davies_bouldin": "with c as (select label, " + ", ".join(f"avg({z}) as {z}" for z in Z) + f""" from o_labeled group by 1),
        s as (select p.label, avg(sqrt({gap('p', 'c', Z)})) as spread from o_labeled p join c on c.label = p.label group by 1),
        w as (select a.label, max((sa.spread + sb.spread) / sqrt({gap('a', 'b', Z)})) as worst
          from c a join c b on a.label <> b.label join s sa on sa.label = a.label join s sb on sb.label = b.label group by 1)
        select round(avg(worst), 6) as davies_bouldin from w""",
    "ev3_cluster_sizes": "select label, round(count(*) / (select count(*) from o_labeled), 6) as share from o_labeled group by 1",
    "ev5_assign_segments": """select customer_unique_id, cast(place as int) as segment, avg_review_score from o_segments
        join (select segment as label, row_number() over (order by avg(monetary), segment) - 1 as place from o_segments group by 1)
        on label = segment""",
    "pr1_profile": "select segment, customers, " + ", ".join(f"round({c}, 4) as {c}" for c in segments.AVERAGES)
    + ", round(total_revenue, 4) as total_revenue from o_profile",
    "pr2_shares": "select segment, round(pct_of_customers, 6) as pct_of_customers, round(pct_of_revenue, 6) as pct_of_revenue from o_profile",
    "pr3_favorites": """select segment, customers, top_category, top_channel from o_profile join o_top_category using (segment)
        join o_top_channel using (segment)""",
    "pr4_segment_names": "select segment, segment_name from o_named",
    "pr5_named_segments": f"select {RANKED} from o_named",
    "pr6_insights": "select cast(line_no as bigint) as line_no, line from o_insights",
}


CHART_TABLES = {
    "order_status": "ch1_order_status", "review_scores": "ch2_review_scores", "monthly_orders": "ch3_monthly_orders",
    "top_states": "ch4_top_states", "top_categories": "ch5_top_categories", "payment_types": "ch6_payment_types",
    "installments": "ch7_installments", "price_histogram": "ch8_price_histogram",
    "price_freight_sample": "ch9_price_freight_sample", "delivery_histogram": "ch10_delivery_histogram",
    "top_sellers": "ch11_top_sellers", "top_category_scores": "ch12_top_category_scores",
    "correlations": "ch13_correlations", "monetary_histogram": "ch14_monetary_histogram",
    "recency_frequency_sample": "ch15_recency_frequency_sample", "top_states_features": "ch16_top_states_features",
    "preferred_categories": "ch17_preferred_categories",
}
SQL["ch20_all_tables"] = " union all ".join(
    f"""select '{t}' as "table", count(*) as rows from ({SQL[q]})""" for t, q in CHART_TABLES.items()
)
SQL["pl1_saved_run"] = f"""select *, 0 as computed from ({SQL["ch20_all_tables"]} union all select 'customers', count(*) from o_features
    union all select 'labels', count(*) from o_features union all select 'segments', count(*) from o_features)"""
SQL["pl1_from_csv"] = """select customer_unique_id, recency, frequency, round(monetary, 6) as monetary, preferred_category,
    round(avg_review_score, 6) as avg_review_score from o_features"""


def oracle() -> dict[str, str]:
    return {name: with_views(sql, VIEWS, KEYED) for name, sql in SQL.items()}
