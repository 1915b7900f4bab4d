"""Cleaning, parsing and profile queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark import sources
from tidemark.functions import (
    POSITION,
    bin_label,
    is_iso_date,
    month_label,
    month_name,
    parse_amount,
    quarter_label,
    safe_ratio,
    show_count,
    show_percent,
    strip,
)
from tidemark.operators import cleaning, profiles, statistics
from tidemark.plans import supply
from tidemark.sources import read_delimited, write_delimited
from tidemark.sources.checkpoints import fresh_path
from tidemark.workload import tables as t
from tidemark.workload.base import SCHEMAS, Query, read_table, rounded

FORMATS = ("d/M/yyyy", "M/d/yyyy")


def sparse_lineitem(spark, folder):
    """Order lines whose zero tax and discount read as missing."""
    li = read_table(spark, folder, "lineitem")
    return li.withColumns({c: F.nullif(F.col(c), F.lit(0.0)) for c in ("l_tax", "l_discount")})


def dedup_full(spark, folder):
    """Whole order lines, each of the even orders there twice."""
    li = read_table(spark, folder, "lineitem").withColumn("l_shipdate", F.date_format("l_shipdate", "yyyy-MM-dd"))
    signless = {c: F.col(c) + F.lit(0.0) for c in ("l_tax", "l_discount")}
    return cleaning.drop_duplicates(li.unionByName(li.where("l_orderkey % 2 = 0")).withColumns(signless))


def through_csv(df, encoding):
    """The table written to the shared folder as CSV and read back."""
    path = fresh_path(df.sparkSession, "csv")
    write_delimited(df, path, encoding=encoding)
    numbers = {c: kind for c, kind in df.dtypes if kind != "string"}
    return read_delimited(df.sparkSession, path, numbers, encoding)


def csv_round_trip(spark, folder):
    return through_csv(read_table(spark, folder, "customer"), "UTF-8")


def csv_latin1(spark, folder):
    named = read_table(spark, folder, "supplier").withColumn("s_name", F.concat("s_name", F.lit(', "Größe" été')))
    return through_csv(named, "ISO-8859-1")


def dedup_keyed(spark, folder):
    order = ["l_shipdate", "l_linenumber", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus"]
    kept = cleaning.keep_first(read_table(spark, folder, "lineitem"), ["l_orderkey", "l_partkey"], order)
    return kept.select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
        F.date_format("l_shipdate", "yyyy-MM-dd").alias("l_shipdate"),
    )


def first_in_file(spark, folder):
    """The line of every part that comes first in the file, and the rows that were dropped for it."""
    lines = sources.read_table(spark, folder, "lineitem", SCHEMAS["lineitem"], position=True)
    kept = cleaning.keep_first(lines, ["l_partkey"], [F.col(POSITION)])
    return kept.select("l_partkey", "l_orderkey", "l_linenumber", "l_extendedprice", F.col(f"{POSITION}.row").alias("row"))


def duplicate_rows(spark, folder):
    return cleaning.duplicate_rows(read_table(spark, folder, "lineitem"), ["l_orderkey", "l_linenumber"])


def drop_missing(spark, folder):
    kept = cleaning.drop_missing(sparse_lineitem(spark, folder), ["l_tax", "l_discount"])
    return kept.groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("rows"))


def completeness(spark, folder):
    return rounded(statistics.completeness(sparse_lineitem(spark, folder)))


def profile_describe(spark, folder):
    return rounded(statistics.describe(sparse_lineitem(spark, folder)), 3)


def profile_describe_large(spark, folder):
    """The same profile by the way that holds for any input size."""
    return rounded(statistics.describe(sparse_lineitem(spark, folder), method="radix"), 3)


def table_shape(spark, folder):
    return statistics.shape(read_table(spark, folder, "lineitem"))


def distinct_counts(spark, folder):
    return statistics.distinct_counts(read_table(spark, folder, "lineitem"), ["l_returnflag", "l_suppkey", "l_partkey", "l_shipdate"])


PROFILED = ("l_partkey", "l_quantity", "l_extendedprice", "l_tax", "l_returnflag", "l_shipdate")


def monthly_parts(spark, folder):
    """Profiles of every month of order lines, written to the shared folder and read back."""
    months = sparse_lineitem(spark, folder).withColumn("month", F.date_format("l_shipdate", "yyyy-MM"))
    path = fresh_path(spark, "profiles")
    profiles.keep_profiles(profiles.partial_profiles(months, PROFILED, ["month"]), path, ["month"])
    return profiles.kept_profiles(spark, path, "month string")


def merged_profile(spark, folder):
    """The profile of all months from those of each, its estimates beside exact counts."""
    merged = profiles.read_profiles(profiles.merge_profiles(monthly_parts(spark, folder)))
    exact = statistics.distinct_counts(read_table(spark, folder, "lineitem"), ["l_partkey", "l_quantity", "l_returnflag", "l_shipdate"])
    near = F.abs(F.col("distinct_estimate") - F.col("distinct_values")) <= F.col("distinct_values") * F.lit(4 * profiles.ERROR)
    both = merged.join(exact, "column").withColumn("near", near)
    return rounded(both.drop("distinct_estimate"), 3)


def yearly_profile(spark, folder):
    """The profiles of every year from those of its months."""
    parts = monthly_parts(spark, folder).withColumn("year", F.substring("month", 1, 4).cast("int"))
    return rounded(profiles.read_profiles(profiles.merge_profiles(parts, ["year"])).drop("distinct_estimate"), 3)


def key_columns(spark, folder):
    return cleaning.column_report(t.supply_orders(spark, folder), supply.KEY_COLUMNS)


def preview_lines(spark, folder):
    """The first lines by price, the dearest first."""
    lines = read_table(spark, folder, "lineitem").drop("l_shipdate")
    return statistics.preview(lines, 5, [F.desc("l_extendedprice"), F.col("l_orderkey"), F.col("l_linenumber")])


def shown_shares(spark, folder):
    """Rows and shares of the return flags as a report prints them."""
    shares = statistics.value_shares(read_table(spark, folder, "lineitem"), "l_returnflag")
    return shares.select("l_returnflag", show_count(F.col("rows")).alias("rows"), show_percent(F.col("pct"), 1).alias("share"))


def mixed_times(spark, folder):
    """Ship times as text, some of them in another format and some unreadable."""
    li = read_table(spark, folder, "lineitem")
    moment = F.timestamp_add("SECOND", F.col("l_partkey") * 61, F.col("l_shipdate"))
    text = (
        F.when(F.col("l_linenumber") == 7, F.lit("n/a"))
        .when(F.col("l_linenumber") == 6, F.date_format(moment, "yyyy-MM-dd"))
        .otherwise(F.date_format(moment, "M/d/yyyy H:mm"))
    )
    return li.select("l_orderkey", "l_linenumber", "l_partkey", text.alias("shipped"))


def time_format_failures(spark, folder):
    return rounded(cleaning.format_failures(mixed_times(spark, folder), "shipped", supply.DATE_FORMATS))


def price_summary(spark, folder):
    return rounded(statistics.summary_values(read_table(spark, folder, "events"), "value", [0.5, 0.99]))


def box_plot(spark, folder):
    return rounded(statistics.box_plot(read_table(spark, folder, "events"), "value"))


def profit_tails(spark, folder):
    return rounded(cleaning.tail_counts(read_table(spark, folder, "events"), "value"))


def value_histogram(spark, folder):
    return rounded(statistics.histogram(read_table(spark, folder, "events"), "value", 50), 3)


def parse_money(spark, folder):
    orders = read_table(spark, folder, "orders")
    price = F.format_string("$%,.2f ", "o_totalprice")
    text = orders.select("o_orderkey", F.when(F.col("o_orderstatus") == "P", " $-   ").otherwise(price).alias("text"))
    return text.select("o_orderkey", parse_amount(F.col("text")).alias("amount"))


def money_failures(spark, folder):
    orders = read_table(spark, folder, "orders")
    text = orders.select(
        F.when(F.col("o_orderstatus") == "P", "1d").otherwise(F.format_string("$%,.2f", "o_totalprice")).alias("price"),
        F.when(F.col("o_orderpriority") == "5-LOW", "nan").otherwise("1,000").alias("units"),
    )
    return cleaning.conversion_failures(text, {c: parse_amount(F.col(c)) for c in text.columns})


def date_texts(spark, folder):
    orders = read_table(spark, folder, "orders")
    return orders.select("o_orderkey", F.date_format("o_orderdate", "M/d/yyyy").alias("ordered"))


def parse_dates(spark, folder):
    parsed = cleaning.parse_dates(date_texts(spark, folder), ["ordered"], FORMATS)
    return parsed.withColumn("ordered", F.date_format("ordered", "yyyy-MM-dd"))


def date_format_failures(spark, folder):
    return rounded(cleaning.format_failures(date_texts(spark, folder), "ordered", FORMATS))


def iso_dates(spark, folder):
    r = t.records(spark, folder)
    return r.groupBy(is_iso_date(F.col("date")).alias("iso")).agg(F.count(F.lit(1)).alias("rows"))


def strip_text(spark, folder):
    d = read_table(spark, folder, "documents")
    padded = d.select("doc_id", F.concat(F.lit(" \t "), F.col("text"), F.lit(" \n ")).alias("text"))
    return cleaning.strip_values(padded).select("doc_id", F.length("text").alias("chars"), F.md5("text").alias("digest"))


def calendar_labels(spark, folder):
    o = read_table(spark, folder, "orders")
    return o.select(
        month_label(F.col("o_orderdate")).alias("label"),
        quarter_label(F.col("o_orderdate")).alias("quarter"),
        month_name(F.month("o_orderdate")).alias("name"),
        F.year("o_orderdate").alias("year"),
    ).groupBy("label", "quarter", "name", "year").agg(F.count(F.lit(1)).alias("rows"))


def size_bins(spark, folder):
    p = read_table(spark, folder, "part")
    binned = p.select(bin_label(F.col("p_size"), (1, 10, 25, 50), ("small", "medium", "large")).alias("bin"))
    return binned.groupBy("bin").agg(F.count(F.lit(1)).alias("rows"))


def safe_ratios(spark, folder):
    li = read_table(spark, folder, "lineitem")
    ratio = safe_ratio(F.col("l_tax"), F.col("l_discount"))
    return rounded(
        li.groupBy("l_linenumber").agg(
            F.count(ratio).alias("defined"), F.count_if(ratio == 0).alias("zero"), F.avg(ratio).alias("mean_ratio")
        )
    )


def rename_and_map(spark, folder):
    c = read_table(spark, folder, "customer")
    mapped = cleaning.map_schema(
        c, {"customer_id": "c_custkey", "segment": strip(F.lower("c_mktsegment")), "balance": "c_acctbal", "in_debt": F.col("c_acctbal") < 0}
    )
    return cleaning.keep_existing(cleaning.rename(mapped, {"balance": "account_balance"}), ["customer_id", "segment", "account_balance", "in_debt", "phone"])


SPARSE = """
  select l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, nullif(l_discount, 0) as l_discount,
         nullif(l_tax, 0) as l_tax, l_returnflag, l_linestatus, l_shipdate from lineitem
"""
LINE_COLUMNS = (
    "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
    "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate",
)
PROFILE = " union all ".join(
    f"""select '{c}' as "column", count({c}) as "count", round(avg({c}), 3) as mean, round(stddev_samp({c}), 3) as std,
               round(min({c})::double, 3) as "min", round(quantile_cont({c}::double, 0.25), 3) as q25,
               round(quantile_cont({c}::double, 0.5), 3) as q50, round(quantile_cont({c}::double, 0.75), 3) as q75,
               round(max({c})::double, 3) as "max" from ({SPARSE})"""
    for c in LINE_COLUMNS[:8]
)

DISTINCT_PROFILED = ("l_partkey", "l_quantity", "l_returnflag", "l_shipdate")


def sql_profile(column: str, keys: str = "", more: str = "") -> str:
    """Profile of one column; a column that is no number has neither moments nor limits."""
    number = f"{column}::double" if column not in ("l_returnflag", "l_shipdate") else "null::double"
    return f"""select {keys} '{column}' as "column", count(*) as "rows", count(*) - count({column}) as nulls,
                      round(count({column}) / count(*)::double * 100, 3) as complete_pct, round(avg({number}), 3) as mean,
                      round(stddev_samp({number}), 3) as std, round(min({number}), 3) as "min", round(max({number}), 3) as "max"{more}
               from ({SPARSE}) group by all"""


QUERIES: dict[str, Query] = {
    "merged_profile": Query(
        merged_profile,
        " union all ".join(sql_profile(c, more=f", count(distinct {c}) as distinct_values, true as near") for c in DISTINCT_PROFILED),
    ),
    "yearly_profile": Query(
        yearly_profile, " union all ".join(sql_profile(c, 'year(l_shipdate)::int as "year",') for c in PROFILED)
    ),
    "key_columns": Query(
        key_columns,
        " union all ".join(
            f"""select {i}::int as "position", '{c}' as "column", {f"'{kind}'" if kind else "null::varchar"} as "type",
                       {"true" if kind else "false"} as present, {f"count({value})" if kind else "count(null)"} as filled
                from lineitem join orders on l_orderkey = o_orderkey"""
            for i, (c, (kind, value)) in enumerate(
                zip(
                    supply.KEY_COLUMNS,
                    [
                        ("timestamp_ntz", "o_orderdate"),
                        ("string", "o_orderpriority"),
                        ("double", "l_extendedprice"),
                        ("int", "l_quantity"),
                        ("double", "nullif(l_tax, 0)"),
                        ("string", "o_orderstatus"),
                        ("int", "l_returnflag"),
                        ("int", "l_shipdate"),
                        ("int", "1"),
                        *[("", "")] * 4,
                    ],
                )
            )
        ),
    ),
    "preview_lines": Query(
        preview_lines,
        """select * exclude (l_shipdate) from lineitem order by l_extendedprice desc, l_orderkey, l_linenumber limit 5""",
    ),
    "shown_shares": Query(
        shown_shares,
        """select l_returnflag, format('{:,}', n) as "rows", format('{:.1f}%', round(n * 100.0 / sum(n) over (), 2)) as share
           from (select l_returnflag, count(*) as n from lineitem group by 1)""",
    ),
    "time_format_failures": Query(
        time_format_failures,
        """select format, count(*) as "rows", count(*) filter (l_linenumber > last or l_linenumber < first) as failures,
                  round(count(*) filter (l_linenumber > last or l_linenumber < first) / count(*)::double * 100, 4) as failure_pct
           from lineitem, (values ('M/d/yyyy H:mm', 1, 5), ('yyyy-MM-dd HH:mm:ss', 8, 8), ('yyyy-MM-dd', 6, 6)) f(format, first, last)
           group by 1""",
    ),
    "dedup_full": Query(
        dedup_full,
        """select distinct * replace (strftime(l_shipdate, '%Y-%m-%d') as l_shipdate, l_tax + 0.0::double as l_tax,
                                      l_discount + 0.0::double as l_discount) from lineitem""",
    ),
    "csv_round_trip": Query(csv_round_trip, "select * from customer"),
    "csv_latin1": Query(csv_latin1, "select * replace (s_name || ', \"Größe\" été' as s_name) from supplier"),
    "dedup_keyed": Query(
        dedup_keyed,
        """select l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, strftime(l_shipdate, '%Y-%m-%d') as l_shipdate
           from (select *, row_number() over (partition by l_orderkey, l_partkey order by l_shipdate, l_linenumber, l_suppkey,
                   l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus) as rn from lineitem) where rn = 1""",
    ),
    "first_in_file": Query(
        first_in_file,
        """select l_partkey, l_orderkey, l_linenumber, l_extendedprice, n - 1 as "row"
           from (select *, row_number() over (partition by l_partkey order by n) as k from (select *, row_number() over () as n from lineitem))
           where k = 1""",
    ),
    "duplicate_rows": Query(
        duplicate_rows,
        """select count(*) as "rows", count(distinct (l_orderkey, l_linenumber)) as distinct_rows,
                  count(*) - count(distinct (l_orderkey, l_linenumber)) as removed from lineitem""",
    ),
    "drop_missing": Query(
        drop_missing,
        """select l_returnflag, count(*) as "rows" from lineitem where l_tax <> 0 and l_discount <> 0 group by 1""",
    ),
    "completeness": Query(
        completeness,
        " union all ".join(
            f"""select '{c}' as "column", count(*) as "rows", count(*) - count({c}) as nulls,
                       round(count({c}) / count(*)::double * 100, 4) as complete_pct from ({SPARSE})"""
            for c in LINE_COLUMNS
        ),
    ),
    "profile_describe": Query(profile_describe, PROFILE),
    "profile_describe_large": Query(profile_describe_large, PROFILE),
    "table_shape": Query(table_shape, 'select count(*) as "rows", 11::bigint as columns from lineitem'),
    "distinct_counts": Query(
        distinct_counts,
        " union all ".join(
            f"""select '{c}' as "column", count(distinct {c}) as distinct_values from lineitem"""
            for c in ("l_returnflag", "l_suppkey", "l_partkey", "l_shipdate")
        ),
    ),
    "price_summary": Query(
        price_summary,
        """select count(value) as "count", round(sum(value), 4) as "sum", round(avg(value), 4) as mean, min(value) as "min",
                  max(value) as "max", round(stddev_samp(value), 4) as std, round(quantile_cont(value, 0.5), 4) as q50,
                  round(quantile_cont(value, 0.99), 4) as q99 from events""",
    ),
    "box_plot": Query(
        box_plot,
        """with q as (select quantile_cont(value, 0.25) as q1, quantile_cont(value, 0.5) as q2, quantile_cont(value, 0.75) as q3 from events),
                f as (select *, q1 - 1.5 * (q3 - q1) as lower, q3 + 1.5 * (q3 - q1) as upper from q)
           select count(*) as n, min(value) as "min", max(value) as "max", round(any_value(q1), 4) as q1, round(any_value(q2), 4) as median,
                  round(any_value(q3), 4) as q3, least(min(value) filter (value >= lower), any_value(q1)) as whisker_low,
                  greatest(max(value) filter (value <= upper), any_value(q3)) as whisker_high,
                  count(*) filter (value < lower or value > upper) as fliers
           from events, f""",
    ),
    "profit_tails": Query(
        profit_tails,
        """with q as (select quantile_cont(value, 0.01) as a, quantile_cont(value, 0.99) as b from events)
           select round(any_value(a), 4) as low_cut, round(any_value(b), 4) as high_cut, count(*) filter (value < a) as below,
                  count(*) filter (value > b) as above, count(*) filter (value < a or value > b) as extreme from events, q""",
    ),
    "value_histogram": Query(
        value_histogram,
        """with r as (select min(value) as lo, max(value) as hi from events),
                c as (select least(49, floor((value - lo) / (hi - lo) * 50))::int as bin, count(*) as n from events, r group by 1)
           select b.i::int as bin, round(lo + b.i * ((hi - lo) / 50), 3) as lower, round(lo + (b.i + 1) * ((hi - lo) / 50), 3) as upper,
                  coalesce(n, 0) as "rows" from range(50) b(i) cross join r left join c on c.bin = b.i""",
    ),
    "parse_money": Query(
        parse_money,
        "select o_orderkey, case when o_orderstatus <> 'P' then o_totalprice end as amount from orders",
    ),
    "money_failures": Query(
        money_failures,
        """select 'price' as "column", count(*) as "rows", count(*) filter (o_orderstatus = 'P') as failures from orders
           union all select 'units', count(*), count(*) filter (o_orderpriority = '5-LOW') from orders""",
    ),
    "parse_dates": Query(parse_dates, "select o_orderkey, strftime(o_orderdate, '%Y-%m-%d') as ordered from orders"),
    "date_format_failures": Query(
        date_format_failures,
        """select f as format, count(*) as "rows", count(*) filter (bad) as failures,
                  round(count(*) filter (bad) / count(*)::double * 100, 4) as failure_pct
           from (select 'd/M/yyyy' as f, try_strptime(strftime(o_orderdate, '%-m/%-d/%Y'), '%d/%m/%Y') is null as bad from orders
                 union all select 'M/d/yyyy', try_strptime(strftime(o_orderdate, '%-m/%-d/%Y'), '%m/%d/%Y') is null from orders)
           group by 1""",
    ),
    "iso_dates": Query(
        iso_dates, 'select l_linenumber <> 7 as iso, count(*) as "rows" from lineitem group by 1'
    ),
    "strip_text": Query(
        strip_text,
        """select doc_id, length(s)::int as chars, md5(s) as digest
           from (select doc_id, regexp_replace(text, '^\\s+|\\s+$', '', 'g') as s from documents)""",
    ),
    "calendar_labels": Query(
        calendar_labels,
        """select strftime(o_orderdate, '%b-%Y') as label, 'Q' || quarter(o_orderdate) as quarter,
                  strftime(o_orderdate, '%b') as name, year(o_orderdate)::int as "year", count(*) as "rows" from orders group by all""",
    ),
    "size_bins": Query(
        size_bins,
        """select case when p_size <= 10 then 'small' when p_size <= 25 then 'medium' else 'large' end as bin, count(*) as "rows"
           from part group by 1""",
    ),
    "safe_ratios": Query(
        safe_ratios,
        """select l_linenumber, count(r) as defined, count(*) filter (r = 0) as zero, round(avg(r), 4) as mean_ratio
           from (select l_linenumber, case when l_discount = 0 then case when l_tax <> 0 then 0 end
                                           else l_tax / l_discount * 100 end as r from lineitem) group by 1""",
    ),
    "rename_and_map": Query(
        rename_and_map,
        """select c_custkey as customer_id, lower(c_mktsegment) as segment, c_acctbal as account_balance, c_acctbal < 0 as in_debt
           from customer""",
    ),
}
