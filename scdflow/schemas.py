"""Schemas of records, source tables and warehouse tables.

The lengths, precisions, topic names and statuses below are fixed values of the
data model this package serves.
"""


TOPIC_PREFIX = "ecommerce.public."
CUSTOMERS = TOPIC_PREFIX + "customers"
PRODUCTS = TOPIC_PREFIX + "products"
ORDERS = TOPIC_PREFIX + "orders"
ORDER_ITEMS = TOPIC_PREFIX + "order_items"
TOPICS = [CUSTOMERS, PRODUCTS, ORDERS, ORDER_ITEMS]

ADDRESS = ["topic", "partition", "offset"]

RECORD = (
    "topic string, partition int, offset bigint, timestamp timestamp_ntz, key string, value string"
)

CUSTOMER_IMAGE = (
    "customer_id bigint, first_name string, last_name string, email string, "
    "phone string, address string, city string, country string"
)
PRODUCT_IMAGE = (
    "product_id bigint, product_name string, category string, brand string, "
    "price double, cost double, description string"
)
ORDER_IMAGE = (
    "order_id bigint, customer_id bigint, order_date string, status string, total_amount double"
)
ORDER_ITEM_IMAGE = (
    "order_item_id bigint, order_id bigint, product_id bigint, quantity int, "
    "unit_price double, line_total double"
)

CUSTOMER_TRACKED = ["phone", "address", "city", "country"]
CUSTOMER_TYPE1 = ["first_name", "last_name", "email"]
PRODUCT_TRACKED = ["price", "cost"]
PRODUCT_TYPE1 = ["product_name", "category", "brand", "description"]

# Longest text each warehouse column takes.
CUSTOMER_LENGTHS = {
    "first_name": 100,
    "last_name": 100,
    "email": 255,
    "phone": 20,
    "address": 500,
    "city": 100,
    "country": 100,
}
PRODUCT_LENGTHS = {"product_name": 255, "category": 100, "brand": 100}
ORDER_LENGTHS = {"status": 50}

MONEY = "decimal(10,2)"
PERCENT = "decimal(5,2)"

STATUSES = ["pending", "retrying", "resolved", "ignored", "dead_letter"]
UNRESOLVED = ["pending", "retrying"]
MAX_RETRIES = 3
FIRST_DELAY_MINUTES = 5
RETRY_DELAY_MINUTES = 15

FAILED_MESSAGE = (
    "failed_message_id bigint, topic string, partition int, message_offset bigint, "
    "message_timestamp timestamp_ntz, message_key string, message_value string, "
    "error_type string, error_message string, error_stacktrace string, "
    "retry_count int, max_retries int, last_retry_at timestamp_ntz, "
    "next_retry_at timestamp_ntz, status string, resolution_notes string, "
    "failed_at timestamp_ntz, resolved_at timestamp_ntz"
)

DIM_CUSTOMER = (
    "customer_key bigint, customer_id bigint, first_name string, last_name string, "
    "email string, phone string, address string, city string, country string, "
    "valid_from timestamp_ntz, valid_to timestamp_ntz, is_current boolean, version int, "
    "open_partition int, open_offset bigint"
)
DIM_PRODUCT = (
    "product_key bigint, product_id bigint, product_name string, category string, "
    "brand string, price decimal(10,2), cost decimal(10,2), "
    "margin_percentage decimal(5,2), description string, valid_from timestamp_ntz, "
    "valid_to timestamp_ntz, is_current boolean, version int, "
    "open_partition int, open_offset bigint"
)
