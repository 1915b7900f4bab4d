"""The driver's tables seen as the data sets of the five jobs, once for Spark and once as SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.workload.base import cents, read_table, sql_cents

EPOCH_2024 = 1_704_067_200_000_000


# -- card transactions from events -------------------------------------------------------------------


def transactions(spark: SparkSession, folder: str) -> DataFrame:
    e = read_table(spark, folder, "events")
    return e.select(
        (F.timestamp_diff("MICROSECOND", F.lit("2024-01-01").cast("timestamp_ntz"), F.col("ts")) / F.lit(1_000_000.0)).alias("Time"),
        (F.get_json_object("props", "$.k").cast("double") - 50).alias("V1"),
        (F.minute("ts") - 30).cast("double").alias("V4"),
        (F.second("ts") - 30).cast("double").alias("V14"),
        F.col("value").alias("Amount"),
        (F.col("event_type") == "error").cast("int").alias("Class"),
    )


TRANSACTIONS = f"""
  select distinct (epoch_us(ts) - {EPOCH_2024}) / 1000000.0 as "Time",
         json_extract_string(props, '$.k')::double - 50 as "V1",
         (minute(ts) - 30)::double as "V4", (second(ts) - 30)::double as "V14",
         value as "Amount", (event_type = 'error')::int as "Class"
  from events
"""

TRANSACTIONS_CLEAN = f"""
  select *, ln(1 + "Amount") as amount_log,
         (floor("Time" / 3600)::bigint % 24)::int as "Hour"
  from ({TRANSACTIONS})
"""

SCORED = f"""
  with t as ({TRANSACTIONS_CLEAN}),
  s as (select avg(amount_log) as mu, stddev_pop(amount_log) as sd, min(amount_log) as lo, max(amount_log) as hi,
               max(abs("V1")) as m1, max(abs("V4")) as m4, max(abs("V14")) as m14,
               quantile_cont("Amount", 0.99) as cut
        from t),
  f as (select t.*,
          abs(amount_log - mu) > 2.5 * sd as zscore_flag,
          "Amount" > cut as iqr_flag,
          (amount_log - lo) / (hi - lo) * 40
            + case when "Hour" <= 4 or "Hour" >= 22 then 20 else 0 end
            + abs("V1") / m1 * 15 + abs("V4") / m4 * 15 + abs("V14") / m14 * 10 as risk_score
        from t, s)
  select *, case when risk_score <= 40 then 'Low' when risk_score <= 70 then 'Medium' else 'High' end as risk_level,
         zscore_flag or iqr_flag or risk_score >= 70 as flagged
  from f
"""


# -- supply-chain orders from lineitem and orders ------------------------------------------------------


def supply_orders(spark: SparkSession, folder: str) -> DataFrame:
    """Order rows under the raw column names of the supply-chain data set."""
    li = read_table(spark, folder, "lineitem")
    orders = read_table(spark, folder, "orders")
    price, discount = F.col("l_extendedprice"), F.col("l_discount")
    joined = li.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    took = F.date_diff("l_shipdate", "o_orderdate")
    return joined.select(
        F.col("o_orderdate").alias("order date (DateOrders)"),
        F.col("o_orderpriority").alias("Department Name"),
        price.alias("Sales per customer"),
        F.col("l_quantity").cast("int").alias("Order Item Quantity"),
        F.when(F.col("l_tax") != 0, cents(price * (F.lit(0.1) - discount))).alias("Benefit per order"),
        F.when(F.col("o_orderstatus") == "P", "Shipping canceled")
        .when(took > 30, "Late delivery")
        .when(took < 0, "Advance shipping")
        .otherwise("Shipping on time")
        .alias("Delivery Status"),
        (F.col("l_returnflag") == "R").cast("int").alias("Late_delivery_risk"),
        took.alias("Days for shipping (real)"),
        F.lit(30).alias("Days for shipment (scheduled)"),
    )


SUPPLY = f"""
  select strftime(o_orderdate, '%b-%Y') as "Month-Year", o_orderdate, o_orderpriority as "Department Name",
         l_extendedprice as sales, l_quantity::int as quantity,
         case when l_tax <> 0 then {sql_cents("l_extendedprice * (0.1::double - l_discount)")} else 0 end as profit,
         case when o_orderstatus <> 'P' and datediff('day', o_orderdate, l_shipdate) <= 30 then 1 else 0 end as on_time,
         (l_returnflag = 'R')::int as late_risk,
         datediff('day', o_orderdate, l_shipdate) - 30 as delay_days
  from lineitem join orders on l_orderkey = o_orderkey
"""


# -- store orders from lineitem and its dimensions -----------------------------------------------------


def store_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Order lines with the measures of the store data set, without the product and region columns."""
    price, discount = F.col("l_extendedprice"), F.col("l_discount") + F.lit(0.0)
    return read_table(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("Order ID"),
        F.col("l_partkey").alias("Product ID"),
        F.col("l_suppkey").alias("supplier"),
        F.col("l_shipdate").alias("Order Date"),
        price.alias("Sales"),
        F.col("l_quantity").cast("int").alias("Quantity"),
        discount.alias("Discount"),
        cents(price * (F.lit(0.1) - discount)).alias("Profit"),
    )


def with_category(lines: DataFrame, spark: SparkSession, folder: str) -> DataFrame:
    part = read_table(spark, folder, "part").select(
        F.col("p_partkey").alias("Product ID"), F.col("p_type").alias("Category"), F.col("p_brand").alias("Sub-Category")
    )
    return lines.join(part, "Product ID")


def with_region(lines: DataFrame, spark: SparkSession, folder: str) -> DataFrame:
    supplier = read_table(spark, folder, "supplier").select(F.col("s_suppkey").alias("supplier"), "s_nationkey")
    nation = read_table(spark, folder, "nation").select("n_nationkey", "n_regionkey")
    region = read_table(spark, folder, "region").select("r_regionkey", F.col("r_name").alias("Region"))
    places = (
        supplier.join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
        .select("supplier", "Region")
    )
    return lines.join(places, "supplier")


STORE = f"""
  select l_orderkey as order_id, l_partkey as product_id, l_shipdate as order_date, l_extendedprice as sales,
         l_quantity::int as quantity, {sql_cents("l_extendedprice * (0.1::double - (l_discount + 0.0::double))")} as profit,
         l_discount + 0.0::double as discount, l_suppkey as supplier,
         p_type as category, p_brand as subcategory, r_name as region
  from lineitem join part on l_partkey = p_partkey join supplier on l_suppkey = s_suppkey
       join nation on s_nationkey = n_nationkey join region on n_regionkey = r_regionkey
"""

# -- financial records from lineitem -----------------------------------------------------------------


def records(spark: SparkSession, folder: str) -> DataFrame:
    """Financial records with faults of every kind, derived from order lines."""
    quantity, price = F.col("l_quantity"), F.col("l_extendedprice")
    return read_table(spark, folder, "lineitem").select(
        F.concat_ws("-", F.col("l_orderkey"), F.col("l_linenumber")).alias("record_id"),
        F.when(F.col("l_linenumber") == 7, F.date_format("l_shipdate", "yyyy/MM/dd"))
        .otherwise(F.date_format("l_shipdate", "yyyy-MM-dd"))
        .alias("date"),
        F.when(quantity != 13, F.col("l_suppkey")).alias("vendor_id"),
        F.when(quantity == 1, -price).when(quantity != 2, price).alias("amount"),
        F.when(F.col("l_returnflag") == "A", "USD").when(F.col("l_returnflag") == "N", "EUR").otherwise("XYZ").alias("currency"),
        F.when(quantity == 50, "unknown")
        .when(F.col("l_linestatus") == "O", "pending")
        .otherwise("paid")
        .alias("payment_status"),
        F.date_format(F.date_add("l_shipdate", quantity.cast("int") - 3), "yyyy-MM-dd").alias("delivery_date"),
        F.when(F.col("l_tax") != 0, F.concat(F.lit("user_"), F.col("l_linenumber").cast("string"))).alias("created_by"),
        "l_orderkey",
        "l_linenumber",
    )


def vendors(spark: SparkSession, folder: str) -> DataFrame:
    """The vendor reference list: suppliers in credit."""
    return read_table(spark, folder, "supplier").filter("s_acctbal > 0").select("s_suppkey")


RECORDS = """
  select l_orderkey || '-' || l_linenumber as record_id,
         case when l_linenumber = 7 then strftime(l_shipdate, '%Y/%m/%d') else strftime(l_shipdate, '%Y-%m-%d') end as "date",
         case when l_quantity <> 13 then l_suppkey end as vendor_id,
         case when l_quantity = 1 then -l_extendedprice when l_quantity <> 2 then l_extendedprice end as amount,
         case l_returnflag when 'A' then 'USD' when 'N' then 'EUR' else 'XYZ' end as currency,
         case when l_quantity = 50 then 'unknown' when l_linestatus = 'O' then 'pending' else 'paid' end as payment_status,
         l_shipdate::date + (l_quantity::int - 3) as delivered, l_shipdate::date as shipped,
         case when l_tax <> 0 then 'user_' || l_linenumber end as created_by, l_orderkey, l_linenumber
  from lineitem
"""


# -- financials (money as text) from lineitem ----------------------------------------------------------


def financials(spark: SparkSession, folder: str) -> DataFrame:
    """Order lines as a text table: padded names, currency text, month-first dates."""
    quantity, price = F.col("l_quantity"), F.col("l_extendedprice")

    def money(c):
        return F.concat(F.lit("$"), F.format_number(c, 2), F.lit(" "))

    return read_table(spark, folder, "lineitem").select(
        F.concat(F.lit(" "), F.col("l_returnflag"), F.lit(" ")).alias(" Segment"),
        F.col("l_linestatus").alias("Country"),
        F.col("l_partkey").cast("string").alias("Product"),
        F.when(quantity == 50, " -   ").otherwise(F.format_number(quantity, 1)).alias(" Units Sold "),
        cents(price / quantity).alias("Sale Price"),
        money(F.when(F.col("l_linenumber") == 1, price * 2).otherwise(price)).alias("Gross Sales"),
        money(cents(price * (F.lit(1.0) - F.col("l_discount")))).alias(" Sales"),
        F.when(F.col("l_tax") == 0, 0.0).otherwise(cents(price * F.lit(0.8))).alias("COGS"),
        F.when(F.col("l_tax") == 0, "nan")
        .otherwise(money(cents(price * (F.lit(0.1) - F.col("l_discount")))))
        .alias(" Profit "),
        F.date_format("l_shipdate", "M/d/yyyy").alias("Date"),
        F.month("l_shipdate").alias("Month Number"),
        F.year("l_shipdate").alias("Year"),
    )


FINANCIALS = f"""
  select distinct l_returnflag as "Segment", l_linestatus as "Country", l_partkey::varchar as "Product",
         case when l_quantity <> 50 then l_quantity end as "Units Sold",
         {sql_cents("l_extendedprice / l_quantity")} as "Sale Price",
         case when l_linenumber = 1 then l_extendedprice * 2 else l_extendedprice end as "Gross Sales",
         {sql_cents("l_extendedprice * (1.0::double - l_discount)")} as "Sales",
         case when l_tax = 0 then 0 else {sql_cents("l_extendedprice * 0.8::double")} end as "COGS",
         case when l_tax <> 0 then {sql_cents("l_extendedprice * (0.1::double - l_discount)")} end as "Profit",
         l_shipdate::date as "Date", month(l_shipdate) as "Month Number", year(l_shipdate) as "Year"
  from lineitem
"""


# -- trips from events -------------------------------------------------------------------------------


def trips(spark: SparkSession, folder: str) -> DataFrame:
    """Events as trips: the property gives the duration, the value distance and amount."""
    k = F.get_json_object("props", "$.k").cast("int")
    return read_table(spark, folder, "events").select(
        F.col("event_id"),
        F.col("ts").alias("tpep_pickup_datetime"),
        (F.col("ts") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), (k * 120 - 600).cast("decimal(18,6)"))).alias(
            "tpep_dropoff_datetime"
        ),
        (F.floor("value") / F.lit(10.0)).alias("trip_distance"),
        F.col("value").alias("total_amount"),
        F.col("event_type").alias("payment_type"),
        F.col("user_id").alias("PULocationID"),
    )


TRIPS = """
  select event_id, ts as pickup, (json_extract_string(props, '$.k')::int * 120 - 600) / 60.0 as duration,
         floor(value) / 10.0 as distance, value as amount, event_type as payment_type, user_id as zone
  from events
"""
PLAUSIBLE_TRIPS = f"""
  select * from ({TRIPS})
  where duration > 0 and duration < 180 and distance > 0 and distance < 100 and amount > 0 and amount < 300
"""


# -- KPI metrics from events -------------------------------------------------------------------------


def kpi_metrics(spark: SparkSession, folder: str) -> DataFrame:
    """Daily value per event type against the type's mean day, as KPI metric rows."""
    from tidemark.functions import total

    daily = (
        read_table(spark, folder, "events")
        .groupBy(F.date_format("ts", "yyyy-MM-dd").alias("month"), F.col("event_type").alias("kpi_id"))
        .agg(total(F.col("value"), 2).alias("actual_value"))
    )
    goal = daily.groupBy("kpi_id").agg(F.round(F.avg("actual_value"), 2).alias("target_value"))
    # Joins one row per day and type with one row per type.
    return daily.join(goal, "kpi_id").withColumn(
        "department", F.when(F.col("kpi_id") == "error", "Operations").otherwise("Sales")
    )


KPI_METRICS = """
  select d.*, g.target_value, case when d.kpi_id = 'error' then 'Operations' else 'Sales' end as department
  from (select strftime(ts, '%Y-%m-%d') as "month", event_type as kpi_id,
               sum(value::decimal(18,2))::double as actual_value
        from events group by 1, 2) d
  join (select kpi_id, round(avg(actual_value), 2) as target_value
        from (select event_type as kpi_id, strftime(ts, '%Y-%m-%d') as day, sum(value::decimal(18,2))::double as actual_value
              from events group by 1, 2) group by 1) g on d.kpi_id = g.kpi_id
"""


# -- sales and inventory from lineitem -----------------------------------------------------------------


def inventory(spark: SparkSession, folder: str) -> DataFrame:
    """Order lines as sales and inventory rows: quantity is the stock, the line number sets the reorder point."""
    return read_table(spark, folder, "lineitem").select(
        F.col("l_shipdate").cast("date").alias("date"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_returnflag").alias("region"),
        F.col("l_linestatus").alias("category"),
        F.col("l_quantity").cast("int").alias("units_sold"),
        F.col("l_extendedprice").alias("revenue"),
        F.col("l_quantity").cast("int").alias("stock_level"),
        (F.col("l_linenumber") * 5).alias("reorder_point"),
    )


INVENTORY = """
  select l_shipdate::date as "date", l_partkey as product_id, l_returnflag as region, l_linestatus as category,
         l_quantity::int as units_sold, l_extendedprice as revenue, l_quantity::int as stock_level,
         l_linenumber * 5 as reorder_point
  from lineitem
"""
