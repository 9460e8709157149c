"""Names, fixed domain values and query parameters in one place."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, datetime

# --- layer / dataset names ------------------------------------------------
# Two-level names in the session catalog (schemas must not start with a digit).
LANDING, BRONZE, SILVER, GOLD, QUALITY = "landing", "bronze", "silver", "gold", "quality"

ENTITIES = ("sales", "customers", "products", "stores")

BRONZE_SALES = f"{BRONZE}.bronze_sales"
BRONZE_CUSTOMERS = f"{BRONZE}.bronze_customers"
BRONZE_PRODUCTS = f"{BRONZE}.bronze_products"
BRONZE_STORES = f"{BRONZE}.bronze_stores"

SILVER_CUSTOMERS = f"{SILVER}.silver_customers"
SILVER_PRODUCTS = f"{SILVER}.silver_products"
SILVER_STORES = f"{SILVER}.silver_stores"
SILVER_SALES = f"{SILVER}.silver_sales_transaction"
SILVER_RETURNS = f"{SILVER}.silver_returns_transaction"
# Sales that passed the referential checks, with names: kept while a refresh runs.
CHECKED_SALES = f"{SILVER}._checked_sales"

GOLD_FACTS = f"{GOLD}.gold_denormalized_sales_facts"
GOLD_DAILY_STORE = f"{GOLD}.gold_daily_sales_by_store"
GOLD_PRODUCT = f"{GOLD}.gold_product_performance"
GOLD_CUSTOMER = f"{GOLD}.gold_customer_lifetime_value"

# Expectation counters per dataset and run / micro-batch (E3 metrics).
QUALITY_METRICS = f"{QUALITY}.expectations"

# Dataset comments.
COMMENTS = {
    BRONZE_SALES: "Every landed sales line, typed, with its ingest time and file",
    BRONZE_CUSTOMERS: "Every landed customer change, typed",
    BRONZE_PRODUCTS: "Every landed product change, typed",
    BRONZE_STORES: "Every landed store change, typed",
    SILVER_CUSTOMERS: "Customer versions over time",
    SILVER_PRODUCTS: "Product versions over time",
    SILVER_STORES: "Store versions over time",
    SILVER_SALES: "Checked sales lines that sold something",
    SILVER_RETURNS: "Checked sales lines that came back, as positive amounts",
    GOLD_FACTS: "One wide row per sold line, with today's names",
    GOLD_DAILY_STORE: "Turnover, lines, items and customers of each store and UTC day",
    GOLD_PRODUCT: "Turnover, items and lines of each product",
    GOLD_CUSTOMER: "Spend, orders, recency and segment of each customer",
    QUALITY_METRICS: "Rows passing and failing each rule, by dataset and batch",
}
# The views of open versions.
CURRENT_VIEWS = {
    SILVER_CUSTOMERS: "silver_customers_current",
    SILVER_PRODUCTS: "silver_products_current",
    SILVER_STORES: "silver_stores_current",
}

# --- fixed values that must equal the reference's ---------------------------
# Accepted payment methods, genders and store statuses.
PAYMENT_METHODS = ("Cash", "Credit Card", "Debit Card", "Mobile Pay", "Gift Card", "UPI", "Net Banking")
GENDERS = ("Male", "Female", "Other")
STORE_STATUSES = ("Open", "Under Renovation")
# Product price bounds [low, high), age bounds, tax rates and the
# unit price up to which the low rate applies.
PRICE_MIN, PRICE_MAX = 99, 10000
AGE_MIN, AGE_MAX = 16, 100
TAX_LOW_RATE, TAX_HIGH_RATE, TAX_LOW_UP_TO = 0.05, 0.12, 1000
# RFM segment names in report order.
RFM_SEGMENTS = ("Champions", "Loyal Customers", "At Risk", "New/Potential", "Lost")
# Watermark on sales event time, daily window.
WATERMARK = "10 minutes"
DAY_WINDOW = "1 day"

# --- SCD2 flows (T4) --------------------------------------------------------
SEQUENCE_COL = "last_update_time"
SCD2_EXCEPT = ("last_update_time", "ingest_timestamp", "source_file_path")
SCD2_TRACK = {
    "customers": ("name", "email", "address", "phone_number", "gender"),
    "products": ("name", "category", "brand", "price", "description", "color", "size"),
    "stores": ("name", "address", "manager", "status"),
}
KEYS = {"sales": "transaction_id", "customers": "customer_id", "products": "product_id", "stores": "store_id"}


# --- query parameters -------------------------------------------------------
@dataclass(frozen=True)
class Params:
    """Dashboard and gold parameters. ``current_date`` is injected (``as_of``)
    instead of read from the clock so results are reproducible."""

    date_min: datetime = datetime(1997, 1, 1, 0, 0, 0)
    date_max: datetime = datetime(1998, 12, 31, 23, 59, 59)
    as_of: date = date(2002, 1, 1)            # customer lifetime value (G4)
    acquisition_as_of: date = date(1995, 9, 30)  # 90-day acquisition trend (Q18)
    acquisition_days: int = 90
    # "reference" keeps the published scoring (ntile 1 = best); "best_high"
    # flips it so 5 = best.
    score_order: str = "reference"


DEFAULT_PARAMS = Params()
