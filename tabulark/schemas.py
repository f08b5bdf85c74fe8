"""Table contracts of the three layers (stg, dds, cdm) and document bodies."""

from __future__ import annotations

from pyspark.sql import types as T

MONEY = T.DecimalType(19, 5)
RATING = T.DecimalType(2, 1)

# --- stg: raw feeds -------------------------------------------------------

# Order-system documents (orders, restaurants, users): JSON text body.
DOCUMENT = T.StructType([
    T.StructField("object_id", T.StringType(), False),
    T.StructField("object_value", T.StringType(), True),
    T.StructField("update_ts", T.TimestampNTZType(), False),
])

BONUS_USER = T.StructType([
    T.StructField("id", T.LongType(), False),
    T.StructField("order_user_id", T.StringType(), True),
])

BONUS_RANK = T.StructType([
    T.StructField("id", T.LongType(), False),
    T.StructField("name", T.StringType(), True),
    T.StructField("bonus_percent", MONEY, True),
    T.StructField("min_payment_threshold", MONEY, True),
])

# Outbox of the bonus system.
BONUS_EVENT = T.StructType([
    T.StructField("id", T.LongType(), False),
    T.StructField("event_ts", T.TimestampNTZType(), True),
    T.StructField("event_type", T.StringType(), True),
    T.StructField("event_value", T.StringType(), True),
])

# Courier-service pages, landed as JSON lines.
COURIER_PAGE = T.StructType([
    T.StructField("_id", T.StringType(), True),
    T.StructField("name", T.StringType(), True),
])

DELIVERY_PAGE = T.StructType([
    T.StructField("order_id", T.StringType(), True),
    T.StructField("order_ts", T.TimestampNTZType(), True),
    T.StructField("delivery_id", T.StringType(), True),
    T.StructField("courier_id", T.StringType(), True),
    T.StructField("address", T.StringType(), True),
    T.StructField("delivery_ts", T.TimestampNTZType(), True),
    T.StructField("rate", T.IntegerType(), True),
    T.StructField("sum", MONEY, True),
    T.StructField("tip_sum", MONEY, True),
])

BOOKMARK = T.StructType([
    T.StructField("workflow_key", T.StringType(), False),
    T.StructField("workflow_settings", T.StringType(), True),
])

# --- document bodies (parsed from object_value / event_value) ---------------

ORDER_BODY = T.StructType([
    T.StructField("_id", T.StringType()),
    T.StructField("final_status", T.StringType()),
    T.StructField("restaurant", T.StructType([T.StructField("id", T.StringType())])),
    T.StructField("user", T.StructType([T.StructField("id", T.StringType())])),
    T.StructField("update_ts", T.StringType()),
    T.StructField("ts_date", T.StringType()),
])

MENU_ITEM = T.StructType([
    T.StructField("_id", T.StringType()),
    T.StructField("name", T.StringType()),
    T.StructField("price", MONEY),
])

RESTAURANT_BODY = T.StructType([
    T.StructField("_id", T.StringType()),
    T.StructField("name", T.StringType()),
    T.StructField("update_ts", T.StringType()),
    T.StructField("menu", T.ArrayType(MENU_ITEM)),
])

USER_BODY = T.StructType([
    T.StructField("_id", T.StringType()),
    T.StructField("name", T.StringType()),
    T.StructField("login", T.StringType()),
])

PRODUCT_PAYMENT = T.StructType([
    T.StructField("product_id", T.StringType()),
    T.StructField("price", MONEY),
    T.StructField("quantity", T.IntegerType()),
    T.StructField("product_cost", MONEY),
    T.StructField("bonus_payment", MONEY),
    T.StructField("bonus_grant", MONEY),
])

BONUS_TRANSACTION_BODY = T.StructType([
    T.StructField("order_id", T.StringType()),
    T.StructField("product_payments", T.ArrayType(PRODUCT_PAYMENT)),
])

# --- dds -----------------------------------------------------------------

DM_USERS = ["id", "user_id", "user_name", "user_login"]
DM_RESTAURANTS = ["id", "restaurant_id", "restaurant_name", "active_from", "active_to"]
DM_TIMESTAMPS = ["id", "ts", "ts_year", "ts_month", "ts_day", "ts_date", "ts_time"]
DM_PRODUCTS = ["id", "product_id", "product_name", "product_price",
               "active_from", "active_to", "restaurant_id"]
DM_ORDERS = ["id", "order_key", "order_status", "restaurant_id", "timestamp_id", "user_id"]
DM_COURIERS = ["id", "courier_id", "courier_name"]
FCT_PRODUCT_SALES = ["event_id", "position", "product_id", "order_id", "count", "price",
                     "total_sum", "bonus_payment", "bonus_grant"]
FCT_DELIVERIES = ["delivery_id", "order_id", "order_ts", "courier_id", "rate", "sum", "tip_sum"]

# --- cdm -----------------------------------------------------------------

SETTLEMENT_REPORT = ["restaurant_id", "restaurant_name", "settlement_date", "orders_count",
                     "orders_total_sum", "orders_bonus_payment_sum",
                     "orders_bonus_granted_sum", "order_processing_fee",
                     "restaurant_reward_sum"]
COURIER_LEDGER = ["courier_id", "courier_name", "settlement_year", "settlement_month",
                  "orders_count", "orders_total_sum", "rate_avg", "order_processing_fee",
                  "courier_order_sum", "courier_tips_sum", "courier_reward_sum"]
