"""Column types of the data sets the jobs read (columns not named are text)."""

from __future__ import annotations

# Card transactions: running seconds, 28 anonymous features, amount and label.
CARD_TRANSACTIONS = {"Time": "double", "Amount": "double", "Class": "int", **{f"V{i}": "double" for i in range(1, 29)}}

# Payment activity: id, date and type are text.
PAYMENT_ACTIVITY = {"amount": "double", "hour": "int", "frequency_per_day": "int", "is_fraud": "int"}

# Supply-chain orders, ISO-8859-1.
SUPPLY_ORDERS = {
    "Sales per customer": "double",
    "Order Item Quantity": "int",
    "Benefit per order": "double",
    "Late_delivery_risk": "int",
    "Days for shipping (real)": "int",
    "Days for shipment (scheduled)": "int",
}

# KPI metric rows: one per month and KPI.
KPI_METRICS = {"actual_value": "double", "target_value": "double"}

# Financials, ISO-8859-1: money columns are text such as "$1,234.50".
FINANCIALS = {"Month Number": "int", "Year": "int"}
FINANCIAL_AMOUNTS = (
    "Units Sold",
    "Manufacturing Price",
    "Sale Price",
    "Gross Sales",
    "Discounts",
    "Sales",
    "COGS",
    "Profit",
)

# Financial records.
FINANCIAL_RECORDS = {"amount": "double"}

# Store orders, ISO-8859-1: two date columns in one of two day/month orders.
STORE_ORDERS = {"Sales": "double", "Profit": "double", "Discount": "double", "Quantity": "int"}
STORE_DATE_FORMATS = ("d/M/yyyy", "M/d/yyyy")

# Sales and inventory by month, product and region.
SALES_INVENTORY = {"units_sold": "int", "revenue": "double", "stock_level": "int", "reorder_point": "int"}

# Taxi trips.
TRIPS = {
    "trip_distance": "double",
    "total_amount": "double",
    "fare_amount": "double",
    "tip_amount": "double",
    "payment_type": "int",
    "passenger_count": "int",
    "VendorID": "int",
    "PULocationID": "int",
    "DOLocationID": "int",
}
TRIP_TIME_FORMATS = ("yyyy-MM-dd HH:mm:ss", "M/d/yyyy h:mm:ss a")
