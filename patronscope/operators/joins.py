"""The joins between the tables.

No side is forced to be broadcast: Spark broadcasts a table only when its size is below
``spark.sql.autoBroadcastJoinThreshold``, and adaptive execution splits hot keys of the
other joins.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from patronscope.sources.catalog import Tables, require


def orders_with_customers(tables: Tables) -> DataFrame:
    require(tables, "orders", "customers")
    return tables["orders"].join(tables["customers"], "customer_id", "left")


def product_names(tables: Tables) -> DataFrame:
    """product_id with the category and its English name."""
    require(tables, "products", "category_name_translation")
    return (
        tables["products"]
        .select("product_id", "product_category_name")
        .join(tables["category_name_translation"], "product_category_name", "left")
    )


def orders_with_items(tables: Tables) -> DataFrame:
    """One row per order item; orders without items stay."""
    require(tables, "orders", "order_items")
    return tables["orders"].join(tables["order_items"], "order_id", "left")


def items_with_products(tables: Tables) -> DataFrame:
    require(tables, "order_items", "products")
    return tables["order_items"].join(tables["products"], "product_id", "left")


def flat_items(tables: Tables) -> DataFrame:
    """One row per order item with order and customer; orders without items stay. The flat table without
    products, for all that reads none of their columns; ``product_id`` is the key of the products."""
    require(tables, "orders", "customers", "order_items")
    return orders_with_customers(tables).join(tables["order_items"], "order_id", "left")


def flat_table(tables: Tables) -> DataFrame:
    """One row per order item with order, customer, product and English category; orders
    without items stay."""
    require(tables, "products", "category_name_translation")
    return (
        flat_items(tables)
        .join(tables["products"], "product_id", "left")
        .join(tables["category_name_translation"], "product_category_name", "left")
    )


def order_customer_map(tables: Tables) -> DataFrame:
    """Distinct (order_id, customer_unique_id), taken before the fan-out to items."""
    return orders_with_customers(tables).select("order_id", "customer_unique_id").distinct()


def payments_with_customers(tables: Tables) -> DataFrame:
    return tables["order_payments"].join(order_customer_map(tables), "order_id", "left")


def reviews_with_customers(tables: Tables) -> DataFrame:
    return tables["order_reviews"].join(order_customer_map(tables), "order_id", "left")


def items_with_categories(tables: Tables) -> DataFrame:
    return tables["order_items"].join(product_names(tables), "product_id", "left")


def reviews_with_categories(tables: Tables) -> DataFrame:
    """Reviews of known orders at item grain, with category names."""
    known = tables["order_reviews"].join(tables["orders"].select("order_id"), "order_id")
    items = tables["order_items"].select("order_id", "product_id")
    return known.join(items, "order_id", "left").join(product_names(tables), "product_id", "left")
