"""Trend, growth, season, ranking and stock queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import percent, total
from tidemark.operators import trends
from tidemark.plans import store
from tidemark.workload import tables as t
from tidemark.workload.base import Query, read_table, rounded, sql_money

MONTHS = f"""
  select date_trunc('month', o_orderdate)::date as m, strftime(o_orderdate, '%b-%Y') as label,
         {sql_money("o_totalprice")} as sales, count(*) as quantity
  from orders group by 1, 2
"""


def months(spark: SparkSession, folder: str) -> DataFrame:
    orders = read_table(spark, folder, "orders").withColumn("Quantity", F.lit(1))
    return trends.monthly_totals(orders, "o_orderdate", "o_totalprice", "Quantity", scale=2)


def text_month(df: DataFrame, column: str = "month") -> DataFrame:
    return rounded(df.withColumn(column, F.date_format(column, "yyyy-MM")))


def monthly_revenue_trend(spark, folder):
    return text_month(trends.revenue_trend(months(spark, folder)))


def label_order_trend(spark, folder):
    return text_month(trends.revenue_trend(months(spark, folder), order="label"))


def mom_growth(spark, folder):
    return text_month(trends.growth_table(months(spark, folder)))


def sales_anomalies(spark, folder):
    return text_month(trends.sales_anomalies(months(spark, folder)))


def trend_report(spark, folder):
    series = months(spark, folder).select(
        F.date_format("month", "yyyy-MM-dd").alias("date"),
        F.col("Sales").alias("revenue"),
        F.col("Quantity").alias("units_sold"),
    )
    return rounded(trends.trend_report(series))


def store_months(spark, folder, by):
    """Monthly totals per group key, for series with more than one line."""
    lines = t.store_lines(spark, folder)
    month = F.trunc(F.col("Order Date").cast("date"), "month").alias("month")
    sums = [total(F.col("Sales"), 2).alias("Sales"), F.sum("Quantity").cast("bigint").alias("Quantity")]
    kinds = read_table(spark, folder, "part").select(F.col("p_partkey").alias("Product ID"), F.col("p_type").alias(by))
    return lines.groupBy("Product ID", month).agg(*sums).join(kinds, "Product ID").groupBy(by, "month").agg(*sums)


def category_anomalies(spark, folder):
    series = store_months(spark, folder, "Category").withColumn("Month-Year", F.date_format("month", "MMM-yyyy"))
    return text_month(trends.sales_anomalies(series, by=["Category"]))


def sums_by(spark: SparkSession, folder: str, *keys) -> DataFrame:
    """Sales summed per key before any join."""
    return t.store_lines(spark, folder).groupBy(*keys).agg(total(F.col("Sales"), 2).alias("Sales"))


def regional_revenue_pivot(spark, folder):
    # Products and suppliers are small beside the lines and joined by broadcast where their size allows; the few cells are
    # summed where the lines are read.
    lines = t.with_region(t.with_category(t.store_lines(spark, folder), spark, folder), spark, folder)
    return rounded(trends.revenue_pivot(lines, scale=2))


def supplier_trend(spark, folder):
    """Every supplier's monthly sales with its own missing months, means over calendar months."""
    series = trends.monthly_totals(t.store_lines(spark, folder), scale=2, fill_gaps=True, by=["supplier"])
    return text_month(trends.revenue_trend(series, by=["supplier"]))


def supplier_growth(spark, folder):
    """Growth from month to month where both have sales, for every supplier."""
    series = trends.monthly_totals(t.store_lines(spark, folder), scale=2, by=["supplier"])
    return text_month(trends.growth_table(series, by=["supplier"], fill_gaps=True))


def product_region_matrix(spark, folder):
    """Revenue by region and product, more products than a table can have columns, as one map each."""
    lines = t.with_region(t.store_lines(spark, folder), spark, folder)
    found = trends.revenue_matrix(lines, "Region", "Product ID", scale=2, widest=100)
    return found.select("Region", F.size("revenue").alias("products"), F.explode("revenue").alias("product", "Sales"))


def seasonal_avg(spark, folder):
    return rounded(trends.seasonal_mean(read_table(spark, folder, "orders"), "o_orderdate", "o_totalprice"))


def seasonal_index(spark, folder):
    return rounded(trends.seasonal_index(months(spark, folder)))


def product_sums(spark: SparkSession, folder: str) -> DataFrame:
    """Lines summed per product before any join: a product sold very often is combined where it is read."""
    return (
        t.store_lines(spark, folder)
        .groupBy("Product ID")
        .agg(
            total(F.col("Profit"), 2).alias("Profit"),
            total(F.col("Sales"), 2).alias("Sales"),
            F.sum("Quantity").cast("bigint").alias("Quantity"),
        )
    )


def subcategory_margin(spark, folder):
    sums = t.with_category(product_sums(spark, folder), spark, folder)
    return rounded(trends.margin_ranking(sums, "Sub-Category", scale=2))


def top_bottom_products(spark, folder):
    margins = product_sums(spark, folder).withColumn("profit_margin_pct", percent(F.col("Profit"), F.col("Sales")))
    return rounded(trends.top_bottom(margins, "Product ID"))


def category_margin(spark, folder):
    margins = store.derive(t.store_lines(spark, folder)).groupBy("Product ID").agg(
        F.sum("profit_margin").alias("margins"), F.count("profit_margin").alias("lines")
    )
    by = t.with_category(margins, spark, folder).groupBy("Category")
    return rounded(by.agg((F.sum("margins") / F.sum("lines")).alias("avg_margin")))


def region_sales(spark, folder):
    sums = sums_by(spark, folder, "supplier")
    return rounded(trends.group_revenue(t.with_region(sums, spark, folder), "Region", scale=2))


def region_rank_by_month(spark, folder):
    orders = read_table(spark, folder, "orders")
    customer = read_table(spark, folder, "customer").select("c_custkey", "c_nationkey")
    nation = read_table(spark, folder, "nation").select("n_nationkey", "n_regionkey")
    region = read_table(spark, folder, "region").select("r_regionkey", F.col("r_name").alias("Region"))
    placed = (
        orders.join(customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
    )
    ranked = trends.region_rank(placed, "o_orderdate", "Region", "o_totalprice", scale=2)
    return text_month(ranked)


def revenue_last_6_months(spark, folder):
    lines = t.with_region(t.with_category(t.store_lines(spark, folder), spark, folder), spark, folder)
    return rounded(trends.recent_revenue(lines, scale=2))


def month_category_matrix(spark, folder):
    sums = sums_by(spark, folder, "Product ID", F.date_format("Order Date", "yyyy-MM").alias("month"))
    return rounded(trends.revenue_pivot(t.with_category(sums, spark, folder), "month", scale=2))


def store_cleaning_summary(spark, folder):
    return store.cleaning_summary(t.store_lines(spark, folder))


def store_overview(spark, folder):
    # Duplicates go first: each line has one product and one supplier, so the joins cannot change which stay.
    clean = store.clean(t.store_lines(spark, folder), ["Order Date", "Sales", "Quantity", "Discount", "supplier"])
    out = store.overview(t.with_region(t.with_category(clean, spark, folder), spark, folder))
    return rounded(out.withColumns({c: F.col(c).cast("string") for c in ("first_date", "last_date")}), 2)


def low_stock(spark, folder):
    return trends.low_stock(t.inventory(spark, folder)).withColumn("date", F.col("date").cast("string"))


def low_stock_records(spark, folder):
    return trends.low_stock_records(t.inventory(spark, folder))


def inventory_regional_ranking(spark, folder):
    tables = store.inventory_results(t.inventory(spark, folder))
    return text_month(tables["regional_ranking"].withColumn("Sales", F.round("Sales", 2)))


TREND = """
  case when count(sales) over (order by {key} rows between 1 preceding and 1 following) = 3
       then avg(sales) over (order by {key} rows between 1 preceding and 1 following) end
"""
GROWTH = "({v} - lag({v}) over (order by {key})) / nullif(lag({v}) over (order by {key}), 0)::double * 100"

CLEAN_STORE = f"""
  select *, row_number() over (partition by order_id, product_id
      order by order_date, sales, quantity, discount, supplier) as rn
  from ({t.STORE})
"""

# The part types that the SQL pivots, which must name its columns; the queries find them.
PART_TYPES = ("ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD")

# The months of every supplier from its first to its last one.
SUPPLIER_MONTHS = """
  with sums as (
    select l_suppkey as supplier, date_trunc('month', l_shipdate)::date as m, sum(cast(l_extendedprice as decimal(18,2)))::double as sales,
           sum(l_quantity::int)::bigint as quantity
    from lineitem where l_shipdate is not null group by 1, 2
  ), spine as (
    select supplier, unnest(generate_series(min(m), max(m), interval 1 month))::date as m from sums group by 1
  ), filled as (
    select spine.supplier, spine.m, sales, quantity from spine left join sums on sums.supplier = spine.supplier and sums.m = spine.m
  )
"""

QUERIES: dict[str, Query] = {
    "monthly_revenue_trend": Query(
        monthly_revenue_trend,
        f"""select strftime(m, '%Y-%m') as "month", label as "Month-Year", round(sales, 4) as "Sales",
                   quantity as "Quantity", round({TREND.format(key="m")}, 4) as rolling_avg_3m from ({MONTHS})""",
    ),
    "label_order_trend": Query(
        label_order_trend,
        f"""select strftime(m, '%Y-%m') as "month", label as "Month-Year", round(sales, 4) as "Sales",
                   quantity as "Quantity", round({TREND.format(key="label")}, 4) as rolling_avg_3m from ({MONTHS})""",
    ),
    "mom_growth": Query(
        mom_growth,
        f"""select strftime(m, '%Y-%m') as "month", label as "Month-Year",
                   round({GROWTH.format(v="sales", key="m")}, 4) as "Sales_Growth_%",
                   round({GROWTH.format(v="quantity", key="m")}, 4) as "Quantity_Growth_%" from ({MONTHS})""",
    ),
    "sales_anomalies": Query(
        sales_anomalies,
        f"""select strftime(m, '%Y-%m') as "month", label as "Month-Year", round(sales, 4) as "Sales",
                   round(r, 4) as rolling_avg_3m, round(g, 4) as mom_growth, round(abs((sales - r) / r) * 100, 4) as deviation_pct
            from (select *, {TREND.format(key="m")} as r, {GROWTH.format(v="sales", key="m")} as g from ({MONTHS}))
            where abs((sales - r) / r) * 100 > 15""",
    ),
    "trend_report": Query(
        trend_report,
        f"""select strftime(m, '%Y-%m-%d') as "date", round(sales, 4) as revenue, quantity as units_sold,
                   round({GROWTH.format(v="sales", key="m")}, 4) as rev_mom_pct,
                   round({GROWTH.format(v="quantity", key="m")}, 4) as units_mom_pct,
                   round(avg(sales) over w, 4) as rev_roll3, round(avg(quantity) over w, 4) as units_roll3,
                   abs((sales - avg(sales) over w) / avg(sales) over w) * 100 > 15 as rev_anomaly
            from ({MONTHS}) window w as (order by m rows between 2 preceding and current row)""",
    ),
    "category_anomalies": Query(
        category_anomalies,
        f"""with m as (select category, date_trunc('month', order_date)::date as m, {sql_money("sales")} as sales
                       from (select l_shipdate as order_date, l_extendedprice as sales, p_type as category
                             from lineitem join part on l_partkey = p_partkey) group by 1, 2),
                 r as (select *, case when count(sales) over w = 3 then avg(sales) over w end as r,
                              (sales - lag(sales) over o) / lag(sales) over o * 100 as g
                       from m window w as (partition by category order by m rows between 1 preceding and 1 following),
                                     o as (partition by category order by m))
            select category as "Category", strftime(m, '%Y-%m') as "month", strftime(m, '%b-%Y') as "Month-Year",
                   round(sales, 4) as "Sales", round(r, 4) as rolling_avg_3m, round(g, 4) as mom_growth,
                   round(abs((sales - r) / r) * 100, 4) as deviation_pct
            from r where abs((sales - r) / r) * 100 > 15""",
    ),
    "regional_revenue_pivot": Query(
        regional_revenue_pivot,
        "select region as \"Region\", "
        + ", ".join(
            f"sum(sales::decimal(18,2)) filter (category = '{c}')::double as \"{c}\"" for c in PART_TYPES
        )
        + f" from ({t.STORE}) group by 1",
    ),
    "supplier_trend": Query(
        supplier_trend,
        f"""{SUPPLIER_MONTHS}
            select supplier, strftime(m, '%Y-%m') as "month", strftime(m, '%b-%Y') as "Month-Year", round(sales, 4) as "Sales", quantity as "Quantity",
                   round(case when count(sales) over w = 3 then avg(sales) over w end, 4) as rolling_avg_3m
            from filled window w as (partition by supplier order by m rows between 1 preceding and 1 following)""",
    ),
    "supplier_growth": Query(
        supplier_growth,
        f"""{SUPPLIER_MONTHS}
            select supplier, strftime(m, '%Y-%m') as "month", strftime(m, '%b-%Y') as "Month-Year",
                   round((sales - lag(sales) over w) / nullif(lag(sales) over w, 0) * 100, 4) as "Sales_Growth_%",
                   round((quantity - lag(quantity) over w)::double / nullif(lag(quantity) over w, 0) * 100, 4) as "Quantity_Growth_%"
            from filled window w as (partition by supplier order by m)""",
    ),
    "product_region_matrix": Query(
        product_region_matrix,
        f"""with c as (select region, product_id, sum(sales::decimal(18,2))::double as sales from ({t.STORE}) group by 1, 2)
            select region as "Region", (count(*) over (partition by region))::int as products, product_id::varchar as product, sales as "Sales" from c""",
    ),
    "seasonal_avg": Query(
        seasonal_avg,
        """select month(o_orderdate)::int as "Month", round(avg(o_totalprice), 4) as "Sales",
                  strftime(min(o_orderdate), '%b') as "Month_Name" from orders group by 1""",
    ),
    "seasonal_index": Query(
        seasonal_index,
        f"""with i as (select month(m)::int as calendar_month, sales / avg(sales) over (partition by year(m)) as idx from ({MONTHS}))
            select calendar_month, count(idx) as years, round(avg(idx), 4) as mean_index,
                   count(*) filter (idx > 1) as years_over, count(*) filter (idx < 1) as years_under,
                   case when count(*) filter (idx > 1) = count(idx) then 'over'
                        when count(*) filter (idx < 1) = count(idx) then 'under' else 'mixed' end as verdict
            from i group by 1""",
    ),
    "subcategory_margin": Query(
        subcategory_margin,
        f"""select subcategory as "Sub-Category", {sql_money("profit")} as "Profit", {sql_money("sales")} as "Sales",
                   round({sql_money("profit")} / {sql_money("sales")} * 100, 2) as profit_margin_pct
            from ({t.STORE}) group by 1""",
    ),
    "top_bottom_products": Query(
        top_bottom_products,
        f"""with p as (select product_id as "Product ID", {sql_money("profit")} as "Profit", {sql_money("sales")} as "Sales",
                              sum(quantity)::bigint as "Quantity", round({sql_money("profit")} / {sql_money("sales")} * 100, 2) as profit_margin_pct
                       from ({t.STORE}) group by 1)
            (select *, 'Top 10' as ranking from p order by profit_margin_pct desc, "Product ID" limit 10)
            union all (select *, 'Bottom 10' as ranking from p order by profit_margin_pct, "Product ID" limit 10)""",
    ),
    "category_margin": Query(
        category_margin,
        f"""select category as "Category", round(avg(profit / sales * 100), 4) as avg_margin from ({t.STORE}) group by 1""",
    ),
    "region_sales": Query(
        region_sales, f"""select region as "Region", {sql_money("sales")} as "Sales" from ({t.STORE}) group by 1"""
    ),
    "region_rank_by_month": Query(
        region_rank_by_month,
        f"""select strftime(m, '%Y-%m') as "month", region as "Region", sales as "Sales",
                   rank() over (partition by m order by sales desc)::int as "rank"
            from (select date_trunc('month', o_orderdate)::date as m, r_name as region, {sql_money("o_totalprice")} as sales
                  from orders join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey
                       join region on n_regionkey = r_regionkey group by 1, 2)""",
    ),
    "revenue_last_6_months": Query(
        revenue_last_6_months,
        f"""select region as "Region", category as "Category", {sql_money("sales")} as "Sales" from ({t.STORE})
            where order_date >= (select date_trunc('month', max(l_shipdate)) - interval 5 month from lineitem)
            group by 1, 2""",
    ),
    "month_category_matrix": Query(
        month_category_matrix,
        "select strftime(order_date, '%Y-%m') as \"month\", "
        + ", ".join(
            f"sum(sales::decimal(18,2)) filter (category = '{c}')::double as \"{c}\"" for c in PART_TYPES
        )
        + f" from ({t.STORE}) group by 1",
    ),
    "store_cleaning_summary": Query(
        store_cleaning_summary,
        """select * from (values (0, 'loaded', (select count(*) from lineitem)), (1, 'invalid date', 0),
               (2, 'sales not positive', 0), (3, 'quantity not positive', 0),
               (4, 'duplicates', (select count(*) - count(distinct (l_orderkey, l_partkey)) from lineitem)),
               (5, 'kept', (select count(distinct (l_orderkey, l_partkey)) from lineitem))) v(step, name, "rows")""",
    ),
    "store_overview": Query(
        store_overview,
        f"""select count(*) as "rows", min(order_date)::date::varchar as first_date, max(order_date)::date::varchar as last_date,
                   count(distinct category) as categories, count(distinct subcategory) as sub_categories,
                   count(distinct region) as regions, round(avg(profit / sales * 100), 2) as overall_margin
            from ({CLEAN_STORE}) where rn = 1""",
    ),
    "low_stock": Query(
        low_stock,
        f"""select product_id, region, "date"::varchar as "date", stock_level, reorder_point
            from (select *, row_number() over (partition by product_id, region
                          order by "date" desc, stock_level desc, reorder_point desc) as rn from ({t.INVENTORY}))
            where rn = 1 and stock_level < reorder_point""",
    ),
    "low_stock_records": Query(
        low_stock_records,
        f"""select count(*) as records, count(*) filter (stock_level < reorder_point) as low_stock_records from ({t.INVENTORY})""",
    ),
    "inventory_regional_ranking": Query(
        inventory_regional_ranking,
        f"""select strftime(m, '%Y-%m') as "month", region, round(sales, 2) as "Sales",
                   rank() over (partition by m order by sales desc)::int as "rank"
            from (select date_trunc('month', "date")::date as m, region, {sql_money("revenue")} as sales
                  from ({t.INVENTORY}) group by 1, 2)""",
    ),
}
