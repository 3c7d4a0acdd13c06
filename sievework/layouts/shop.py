"""Contracts of the order tables. Names, types and limits are fixed values."""

from ..contracts import Contract

CUSTOMERS = Contract(
    "customers",
    "customer_id int, customer_name string, email string, country string, signup_date date",
    key=("customer_id",),
    required=("customer_name", "email", "country", "signup_date"),
)
PRODUCTS = Contract(
    "products",
    "product_id int, product_name string, category string, price decimal(10,2), is_active boolean",
    key=("product_id",),
    required=("product_name", "category", "price", "is_active"),
)
ORDERS = Contract(
    "orders",
    "order_id int, customer_id int, order_date timestamp, status string, order_total decimal(10,2)",
    key=("order_id",),
    required=("customer_id", "order_date", "status", "order_total"),
)
ORDER_ITEMS = Contract(
    "order_items",
    "order_item_id int, order_id int, product_id int, quantity int, unit_price decimal(10,2)",
    key=("order_item_id",),
    required=("order_id", "product_id", "quantity", "unit_price"),
)
SHOP = [CUSTOMERS, PRODUCTS, ORDERS, ORDER_ITEMS]

PRODUCTS_LOADED = Contract(
    "products_loaded",
    "product_id int, product_name string, category string, price decimal(10,2), is_active boolean, "
    "ingestion_timestamp timestamp",
    key=("product_id",),
    required=("product_name", "ingestion_timestamp"),
    max_length={"product_name": 200, "category": 100},
)
ORDERS_LOADED = Contract(
    "orders_loaded",
    "order_id int, customer_id int, order_date timestamp, status string, order_total decimal(10,2), "
    "ingestion_timestamp timestamp",
    key=("order_id",),
    required=("ingestion_timestamp",),
    max_length={"status": 50},
)
