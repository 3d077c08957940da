"""Explicit schemas of every external table."""

from __future__ import annotations

from pyspark.sql import types as T

STRING, LONG, INT, DOUBLE = T.StringType(), T.LongType(), T.IntegerType(), T.DoubleType()
TIME, MONEY = T.TimestampNTZType(), T.DecimalType(12, 2)


def _struct(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


RETAIL = T.StructType(
    [
        T.StructField("Invoice", STRING),
        T.StructField("StockCode", STRING),
        T.StructField("Description", STRING),
        T.StructField("Quantity", LONG),
        T.StructField("InvoiceDate", TIME),
        T.StructField("Price", DOUBLE),
        T.StructField("Customer ID", STRING),
        T.StructField("Country", STRING),
    ]
)

MARKETPLACE = {
    "orders": _struct(
        order_id=STRING,
        customer_id=STRING,
        order_status=STRING,
        order_purchase_timestamp=TIME,
        order_approved_at=TIME,
        order_delivered_carrier_date=TIME,
        order_delivered_customer_date=TIME,
        order_estimated_delivery_date=TIME,
    ),
    "order_items": _struct(
        order_id=STRING,
        order_item_id=INT,
        product_id=STRING,
        seller_id=STRING,
        shipping_limit_date=TIME,
        price=MONEY,
        freight_value=MONEY,
    ),
    "order_reviews": _struct(
        review_id=STRING,
        order_id=STRING,
        review_score=INT,
        review_comment_title=STRING,
        review_comment_message=STRING,
        review_creation_date=TIME,
        review_answer_timestamp=TIME,
    ),
    "products": _struct(
        product_id=STRING,
        product_category_name=STRING,
        product_name_lenght=INT,
        product_description_lenght=INT,
        product_photos_qty=INT,
        product_weight_g=INT,
        product_length_cm=INT,
        product_height_cm=INT,
        product_width_cm=INT,
    ),
    "customers": _struct(
        customer_id=STRING,
        customer_unique_id=STRING,
        customer_zip_code_prefix=STRING,
        customer_city=STRING,
        customer_state=STRING,
    ),
    "sellers": _struct(
        seller_id=STRING,
        seller_zip_code_prefix=STRING,
        seller_city=STRING,
        seller_state=STRING,
    ),
    "order_payments": _struct(
        order_id=STRING,
        payment_sequential=INT,
        payment_type=STRING,
        payment_installments=INT,
        payment_value=MONEY,
    ),
    "geolocation": _struct(
        geolocation_zip_code_prefix=STRING,
        geolocation_lat=DOUBLE,
        geolocation_lng=DOUBLE,
        geolocation_city=STRING,
        geolocation_state=STRING,
    ),
    "product_category_name_translation": _struct(
        product_category_name=STRING,
        product_category_name_english=STRING,
    ),
}

ISSUE = "struct<category:string,subcategory:string,evidence:string,confidence:double>"
ISSUES = f"array<{ISSUE}>"
REVIEW_RESULT = (
    "review_id string, order_id string, review_score int, raw_text string, normalized_text_hash string, "
    f"issues {ISSUES}, method string, model string, needs_manual_review boolean, actionable_for_seller boolean"
)
RUN_METADATA = (
    "record_count bigint, empty_text_count bigint, dedup_count bigint, rule_texts bigint, small_llm_texts bigint, "
    "large_llm_texts bigint, rule_records bigint, small_llm_records bigint, large_llm_records bigint, "
    "offline_small_llm_fallback_records bigint, offline_large_llm_fallback_records bigint, estimated_cost_usd double, "
    "estimated_input_tokens bigint, estimated_output_tokens bigint, llm_call_count bigint, budget_exhausted boolean, "
    "schema_error_count bigint, evidence_error_count bigint"
)

EVENTS = _struct(
    event_id=LONG, ts=TIME, user_id=LONG, event_type=STRING, value=DOUBLE, props=STRING
)
