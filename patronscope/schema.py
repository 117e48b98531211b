"""Column declarations of the nine input tables.

Fixed values: column names and their types are part of the input format, the token and
label lists are part of the cleaning rules.
"""

TABLES = [
    "customers",
    "geolocation",
    "order_items",
    "order_payments",
    "order_reviews",
    "orders",
    "products",
    "sellers",
    "category_name_translation",
]

TRANSLATION_FILE = "product_category_name_translation.csv"

# Free text with quoted line breaks occurs only here.
MULTILINE_TABLES = {"order_reviews"}

TIMESTAMP_COLUMNS = {
    "orders": [
        "order_purchase_timestamp",
        "order_approved_at",
        "order_delivered_carrier_date",
        "order_delivered_customer_date",
        "order_estimated_delivery_date",
    ],
    "order_items": ["shipping_limit_date"],
    "order_reviews": ["review_creation_date", "review_answer_timestamp"],
}

INTEGER_COLUMNS = {
    "customers": ["customer_zip_code_prefix"],
    "geolocation": ["geolocation_zip_code_prefix"],
    "order_items": ["order_item_id"],
    "order_payments": ["payment_sequential", "payment_installments"],
    "order_reviews": ["review_score"],
    "products": ["product_name_lenght", "product_description_lenght", "product_photos_qty"],
    "sellers": ["seller_zip_code_prefix"],
}

DOUBLE_COLUMNS = {
    "geolocation": ["geolocation_lat", "geolocation_lng"],
    "order_items": ["price", "freight_value"],
    "order_payments": ["payment_value"],
    "products": [
        "product_weight_g",
        "product_length_cm",
        "product_height_cm",
        "product_width_cm",
    ],
}

# Tokens counted as hidden nulls before trimming.
HIDDEN_NULL_TOKENS = ["NA", "N/A", "Null", "null", "-", ""]

# Tokens a CSV reader of data frames takes for null by default.
CSV_NULL_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND",
    "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]

# Label standardization: column -> {value after lower-casing: standard label}.
STANDARD_LABELS = {
    "channel": {"online": "Online", "app": "App", "marketplace": "Marketplace"},
    "returned": {"yes": "Yes", "y": "Yes", "no": "No", "n": "No"},
}

# Order states that count as a return.
RETURN_STATES = ["canceled", "unavailable"]

# Customer feature table.
FEATURE_COLUMNS = [
    "customer_unique_id", "recency", "frequency", "monetary", "avg_order_value",
    "preferred_category", "customer_state", "customer_city", "return_rate",
    "preferred_channel", "avg_installments", "avg_review_score", "delivery_delay",
    "avg_delivery_time", "avg_freight_ratio", "category_diversity", "tenure_days",
]

NUMERIC_FEATURES = [
    "recency", "frequency", "monetary", "avg_order_value", "return_rate",
    "avg_installments", "avg_review_score", "delivery_delay", "avg_delivery_time",
    "avg_freight_ratio", "category_diversity", "tenure_days",
]

# Model input.
LOG_FEATURES = ["monetary", "avg_order_value", "frequency", "tenure_days"]
MEDIAN_FILLED = ["delivery_delay", "avg_delivery_time", "avg_freight_ratio"]
MODEL_FEATURES = [
    "recency", "monetary_log", "frequency_log", "avg_order_value_log", "return_rate",
    "avg_installments", "avg_review_score", "delivery_delay", "avg_delivery_time",
    "avg_freight_ratio", "category_diversity",
]
