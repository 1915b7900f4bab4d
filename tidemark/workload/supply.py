"""Monthly KPI and target queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import kpi
from tidemark.plans import supply
from tidemark.workload import tables as t
from tidemark.workload.base import Query, read_table, rounded, sql_money


def orders(spark, folder):
    return supply.clean(t.supply_orders(spark, folder))


def kpi_on_time(spark, folder):
    return kpi.on_time(orders(spark, folder))


def kpi_avg_sales(spark, folder):
    o = read_table(spark, folder, "orders").withColumn("Month-Year", F.date_format("o_orderdate", "MMM-yyyy"))
    return kpi.average_sales(o, sales="o_totalprice")


def kpi_revenue(spark, folder):
    return rounded(kpi.revenue(orders(spark, folder), scale=2))


def kpi_late_risk(spark, folder):
    return kpi.late_risk(orders(spark, folder))


def kpi_delay(spark, folder):
    return kpi.delay(orders(spark, folder))


def kpi_margin(spark, folder):
    return rounded(kpi.margin(orders(spark, folder), scale=2))


def on_time_vs_late(spark, folder):
    return kpi.on_time_vs_late(orders(spark, folder))


def kpi_board(spark, folder):
    return rounded(kpi.board(orders(spark, folder), scale=2))


def supply_overview(spark, folder):
    out = supply.overview(orders(spark, folder))
    return out.withColumns({c: F.col(c).cast("string") for c in ("first_date", "last_date")})


def supply_cleaning_summary(spark, folder):
    return supply.cleaning_summary(t.supply_orders(spark, folder))


def kpi_target_alerts(spark, folder):
    return rounded(kpi.target_alerts(t.kpi_metrics(spark, folder), 20.0))


def kpi_on_target(spark, folder):
    marked = kpi.on_target(t.kpi_metrics(spark, folder), lower_is_better=["error"])
    return rounded(marked)


def kpi_latest_vs_target(spark, folder):
    return rounded(kpi.latest_vs_target(t.kpi_metrics(spark, folder)))


def kpi_trend_line(spark, folder):
    chosen = kpi.select_metrics(
        t.kpi_metrics(spark, folder), departments=["Sales"], first_month="2024-01-08", last_month="2024-01-21"
    )
    return rounded(kpi.trend_line(chosen, "purchase"))


def kpi_target_status(spark, folder):
    marked = kpi.on_target(t.kpi_metrics(spark, folder), lower_is_better=["error"])
    return kpi.target_status(marked, by=["department"])


QUERIES: dict[str, Query] = {
    "kpi_on_time": Query(
        kpi_on_time,
        f"""select "Month-Year", "Department Name", sum(on_time)::bigint as on_time_count, count(on_time) as total_orders,
                   round(sum(on_time) / count(on_time)::double * 100, 2) as on_time_pct from ({t.SUPPLY}) group by 1, 2""",
    ),
    "kpi_avg_sales": Query(
        kpi_avg_sales,
        """select strftime(o_orderdate, '%b-%Y') as "Month-Year", round(avg(o_totalprice), 2) as avg_sales,
                  round(quantile_cont(o_totalprice, 0.5)::decimal(18,6), 2)::double as median_sales, round(stddev_samp(o_totalprice), 2) as std_sales
           from orders group by 1""",
    ),
    "kpi_revenue": Query(
        kpi_revenue,
        f"""select "Month-Year", {sql_money("sales")} as total_revenue, sum(quantity)::bigint as total_quantity
            from ({t.SUPPLY}) group by 1""",
    ),
    "kpi_late_risk": Query(
        kpi_late_risk,
        f"""select "Month-Year", round(avg(late_risk) * 100, 2) as late_risk_pct from ({t.SUPPLY}) group by 1""",
    ),
    "kpi_delay": Query(
        kpi_delay,
        f"""select "Month-Year", round(avg(delay_days), 2) as avg_delay, min(delay_days)::int as min_delay,
                   max(delay_days)::int as max_delay from ({t.SUPPLY}) group by 1""",
    ),
    "kpi_margin": Query(
        kpi_margin,
        f"""select "Month-Year", {sql_money("profit")} as total_profit, {sql_money("sales")} as total_sales,
                   round({sql_money("profit")} / {sql_money("sales")} * 100, 2) as profit_margin_pct
            from ({t.SUPPLY}) group by 1""",
    ),
    "on_time_vs_late": Query(
        on_time_vs_late,
        f"""select "Month-Year", sum(on_time)::bigint as on_time, (count(*) - sum(on_time))::bigint as late
            from ({t.SUPPLY}) group by 1""",
    ),
    "kpi_board": Query(
        kpi_board,
        f"""select "Month-Year", count(*) as orders, sum(on_time)::bigint as on_time, round(avg(sales), 2) as avg_sales,
                   round(stddev_samp(sales), 2) as std_sales, {sql_money("sales")} as total_revenue,
                   sum(quantity)::bigint as total_quantity, round(avg(late_risk) * 100, 2) as late_risk_pct,
                   round(avg(delay_days), 2) as avg_delay, min(delay_days)::int as min_delay, max(delay_days)::int as max_delay,
                   {sql_money("profit")} as total_profit, (count(*) - sum(on_time))::bigint as late,
                   round({sql_money("profit")} / {sql_money("sales")} * 100, 2) as profit_margin_pct
            from ({t.SUPPLY}) group by 1""",
    ),
    "supply_overview": Query(
        supply_overview,
        f"""select count(*) as orders, min(o_orderdate)::date::varchar as first_date, max(o_orderdate)::date::varchar as last_date,
                   count(distinct "Department Name") as departments, round(avg(on_time) * 100, 2) as on_time_pct from ({t.SUPPLY})""",
    ),
    "supply_cleaning_summary": Query(
        supply_cleaning_summary,
        f"""select * from (values (0, 'loaded', (select count(*) from ({t.SUPPLY}))),
               (1, 'invalid date', (select count(*) from ({t.SUPPLY}) where o_orderdate is null)),
               (2, 'sales not positive', (select count(*) from ({t.SUPPLY}) where not sales > 0)),
               (3, 'quantity not positive', (select count(*) from ({t.SUPPLY}) where sales > 0 and not quantity > 0)),
               (4, 'kept', (select count(*) from ({t.SUPPLY}) where sales > 0 and quantity > 0))) v(step, name, "rows")""",
    ),
    "kpi_target_alerts": Query(
        kpi_target_alerts,
        f"""select "month", kpi_id, actual_value, target_value, department,
                   round(abs(actual_value - target_value) / target_value * 100, 4) as deviation_pct
            from ({t.KPI_METRICS}) where abs(actual_value - target_value) / target_value * 100 > 20""",
    ),
    "kpi_on_target": Query(
        kpi_on_target,
        f"""select "month", kpi_id, actual_value, target_value, department,
                   case when kpi_id = 'error' then actual_value <= target_value else actual_value >= target_value end as on_target
            from ({t.KPI_METRICS})""",
    ),
    "kpi_latest_vs_target": Query(
        kpi_latest_vs_target,
        f"""select department, kpi_id, "month", actual_value, target_value, round(actual_value - target_value, 4) as delta,
                   round(abs(actual_value - target_value) / target_value * 100, 4) as deviation_pct
            from (select *, row_number() over (partition by department, kpi_id order by "month" desc) as rn from ({t.KPI_METRICS}))
            where rn = 1""",
    ),
    "kpi_trend_line": Query(
        kpi_trend_line,
        f"""select "month", kpi_id, actual_value, target_value, department from ({t.KPI_METRICS})
            where department = 'Sales' and kpi_id = 'purchase' and "month" between '2024-01-08' and '2024-01-21'""",
    ),
    "kpi_target_status": Query(
        kpi_target_status,
        f"""select department, count(*) filter (ok) as reached, count(*) filter (not ok) as missed
            from (select department, case when kpi_id = 'error' then actual_value <= target_value else actual_value >= target_value end as ok
                  from ({t.KPI_METRICS})) group by 1""",
    ),
}
