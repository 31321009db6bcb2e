"""Column names, types and fixed business values."""

from __future__ import annotations

from pyspark.sql import types as T

# Shipping modes, unit cost per order line, expected on-time rate.
SHIPPING_MODES = (
    ("Same Day", 25, 0.95),
    ("First Class", 15, 0.85),
    ("Second Class", 10, 0.70),
    ("Standard Class", 5, 0.55),
)
MODE_COST = {mode: cost for mode, cost, _ in SHIPPING_MODES}
MODE_ONTIME = {mode: rate for mode, _, rate in SHIPPING_MODES}
UNKNOWN_MODE_COST = 10
LATE_PENALTY_PER_DAY = 50
FACILITY_COST = 50_000
TRANSPORT_COST_PER_KM = 1.0
EARTH_RADIUS_KM = 6371.0

# Routing defaults.
SPEED_KMH = 40.0
SERVICE_MINUTES = 10.0
MAX_ROUTE_MINUTES = 480.0
NUM_VEHICLES = 3
MAX_STOPS = 50
SINGLE_TOUR_POINTS = 15

# Modelling defaults.
SEED = 42
TEST_PERCENT = 20
CV_FOLDS = 5
FULL_DEPTH = 30  # the deepest trees that Spark grows
FORECAST_DAYS = 30

# Money in files has more digits than cents in places; a double keeps them.
MONEY = T.DoubleType()

# Fixed values: (header in the CSV file, column name here, type)
CSV_COLUMNS = (
    ("Type", "payment_type", T.StringType()),
    ("Days for shipping (real)", "days_real", T.IntegerType()),
    ("Days for shipment (scheduled)", "days_scheduled", T.IntegerType()),
    ("Sales per customer", "sales_per_customer", MONEY),
    ("Delivery Status", "delivery_status", T.StringType()),
    ("Late_delivery_risk", "late_delivery_risk", T.IntegerType()),
    ("Category Id", "category_id", T.StringType()),
    ("Category Name", "category_name", T.StringType()),
    ("Customer City", "customer_city", T.StringType()),
    ("Customer Country", "customer_country", T.StringType()),
    ("Customer Id", "customer_id", T.StringType()),
    ("Customer Segment", "customer_segment", T.StringType()),
    ("Customer State", "customer_state", T.StringType()),
    ("Customer Zipcode", "customer_zipcode", T.StringType()),
    ("Department Id", "department_id", T.StringType()),
    ("Department Name", "department_name", T.StringType()),
    ("Latitude", "latitude", T.DoubleType()),
    ("Longitude", "longitude", T.DoubleType()),
    ("Market", "market", T.StringType()),
    ("Order City", "order_city", T.StringType()),
    ("Order Country", "order_country", T.StringType()),
    ("Order Customer Id", "order_customer_id", T.StringType()),
    ("order date (DateOrders)", "order_ts", T.TimestampNTZType()),
    ("Order Id", "order_id", T.StringType()),
    ("Order Item Discount", "order_item_discount", MONEY),
    ("Order Item Id", "line_key", T.StringType()),
    ("Order Item Quantity", "order_item_quantity", T.IntegerType()),
    ("Sales", "sales", MONEY),
    ("Order Item Total", "order_item_total", MONEY),
    ("Order Profit Per Order", "order_profit", MONEY),
    ("Order Region", "order_region", T.StringType()),
    ("Order State", "order_state", T.StringType()),
    ("Order Status", "order_status", T.StringType()),
    ("Order Zipcode", "order_zipcode", T.StringType()),
    ("Product Card Id", "product_id", T.StringType()),
    ("Product Price", "product_price", MONEY),
    ("shipping date (DateOrders)", "shipping_ts", T.TimestampNTZType()),
    ("Shipping Mode", "shipping_mode", T.StringType()),
    ("Benefit per order", "benefit_per_order", MONEY),
    ("Customer Email", "customer_email", T.StringType()),
    ("Customer Fname", "customer_first_name", T.StringType()),
    ("Customer Lname", "customer_last_name", T.StringType()),
    ("Customer Password", "customer_password", T.StringType()),
    ("Customer Street", "customer_street", T.StringType()),
    ("Order Item Cardprod Id", "order_item_product_id", T.StringType()),
    ("Order Item Discount Rate", "order_item_discount_rate", T.DoubleType()),
    ("Order Item Product Price", "order_item_product_price", MONEY),
    ("Order Item Profit Ratio", "order_item_profit_ratio", T.DoubleType()),
    ("Product Category Id", "product_category_id", T.StringType()),
    ("Product Description", "product_description", T.StringType()),
    ("Product Image", "product_image", T.StringType()),
    ("Product Name", "product_name", T.StringType()),
    ("Product Status", "product_status", T.IntegerType()),
)

REQUIRED_COLUMNS = (
    "order_id", "line_key", "order_ts", "shipping_ts", "days_real",
    "days_scheduled", "late_delivery_risk", "customer_city",
    "customer_country", "product_price", "order_item_quantity",
)

CRITICAL_COLUMNS = (
    "order_ts", "shipping_ts", "days_real", "days_scheduled",
    "late_delivery_risk", "customer_city", "product_price",
)

ID_COLUMNS = (
    "order_id", "customer_id", "order_customer_id", "product_id", "line_key",
    "category_id", "department_id", "customer_zipcode", "order_zipcode",
)

NUMBER_COLUMNS = (
    "product_price", "order_item_quantity", "sales", "order_item_total",
    "order_profit", "benefit_per_order", "sales_per_customer", "days_real",
    "days_scheduled",
)

ONE_HOT_COLUMNS = (
    "payment_type", "delivery_status", "category_name", "customer_segment",
    "department_name", "shipping_mode", "order_status", "market", "order_region",
)

DELIVERY_FEATURES = (
    "order_item_quantity", "product_price", "sales", "order_month",
    "order_dayofweek", "order_hour", "shipping_month", "shipping_dayofweek",
    "days_scheduled",
)

RISK_NUMERIC_FEATURES = (
    "days_scheduled", "order_item_quantity", "product_price",
    "order_item_total", "sales_per_customer", "order_dayofweek",
    "order_month", "order_hour", "is_weekend",
)
RISK_CATEGORIES = ("shipping_mode", "customer_segment", "market", "order_region")
