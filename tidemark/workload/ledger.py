"""Rule, report and score queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import quality
from tidemark.operators.cleaning import out_of_range, same_domain, unexpected_values
from tidemark.plans import financials, ledger
from tidemark.sources.checkpoints import store
from tidemark.workload import tables as t
from tidemark.workload.base import Query, read_table, rounded

ORDER = ("l_orderkey", "l_linenumber")
CURRENCIES = ("USD", "EUR")


def report(spark, folder):
    records = t.records(spark, folder)
    return ledger.report(
        records, t.vendors(spark, folder), ORDER, vendor_key="s_suppkey", currencies=CURRENCIES
    )


def integrity_report(spark, folder):
    return report(spark, folder).drop("checked")


def integrity_score(spark, folder):
    return rounded(quality.integrity_score(report(spark, folder)))


def rule_status(spark, folder):
    return quality.status_counts(report(spark, folder))


def severity_counts(spark, folder):
    return quality.severity_counts(report(spark, folder))


def row_rules(spark, folder):
    records = t.records(spark, folder)
    found = ledger.rules(records, t.vendors(spark, folder), vendor_key="s_suppkey", currencies=CURRENCIES)
    return records, [r for r in found if isinstance(r, quality.RowRule)]


def violating_records(spark, folder):
    records, rules = row_rules(spark, folder)
    rows = quality.violating_rows(records, rules)
    return rows.select("record_id", "amount", F.size("broken_rules").alias("broken"), F.array_join("broken_rules", "; ").alias("rules"))


def unknown_vendors(spark, folder):
    records = t.records(spark, folder)
    vendors = t.vendors(spark, folder)
    return records.join(vendors, records["vendor_id"] == vendors["s_suppkey"], "left_anti").select("record_id", "vendor_id")


def financial_rows(spark, folder):
    return store(financials.clean(t.financials(spark, folder)), "financials")


def financial_checks(spark, folder):
    table = financials.checks(financial_rows(spark, folder), t.financials(spark, folder))
    return rounded(table.select("rule", "subject", "violations", "complete_pct", "status"))


def financial_issues(spark, folder):
    return financials.issue_report(financials.checks(financial_rows(spark, folder)))


def gross_mismatch(spark, folder):
    rows = financials.validated(financial_rows(spark, folder)).filter("gross_diff_pct > 0.10")
    return rows.groupBy("Segment", "Country").agg(
        F.count(F.lit(1)).alias("rows"), F.round(F.avg("gross_diff_pct"), 4).alias("mean_gap")
    )


def domain_violations(spark, folder):
    orders = read_table(spark, folder, "orders")
    region = read_table(spark, folder, "region")
    return unexpected_values(orders, "o_orderstatus", ["F", "O"]).unionByName(
        unexpected_values(region, "r_name", ["AFRICA", "AMERICA", "ASIA", "EUROPE"])
    )


def domain_match(spark, folder):
    orders = read_table(spark, folder, "orders")
    return same_domain(orders, "o_orderstatus", ["F", "O", "P"]).unionByName(
        same_domain(orders, "o_orderpriority", ["1-URGENT", "2-HIGH", "3-MEDIUM"])
    )


def range_violations(spark, folder):
    li = read_table(spark, folder, "lineitem")
    return out_of_range(li, {"l_discount": (0.01, 0.09), "l_quantity": (1, 45), "l_linenumber": (1, 7)})


def _rule(number: int, severity: str, name: str, condition: str) -> str:
    return f"""
      select {number} as n, '{name}' as rule, '{severity}' as severity,
             (select count(*) from r where {condition}) as violations, (select count(*) from r) as checked,
             (select string_agg(record_id, ', ' order by l_orderkey, l_linenumber) from
                (select * from r where {condition} order by l_orderkey, l_linenumber limit 10)) as ids
    """


# Deliveries are judged only where both dates are ISO days.
REPORT = f"""
  with r as (select q.*, (select avg(amount) from ({t.RECORDS})) as mu,
                    (select stddev_samp(amount) from ({t.RECORDS})) as sd,
                    count(*) over (partition by record_id) as copies,
                    vendor_id in (select s_suppkey from supplier where s_acctbal > 0) as known
             from ({t.RECORDS}) q),
  all_rules as (
    {_rule(1, "Critical", "1. No nulls in required fields", "vendor_id is null or amount is null or currency is null")}
    union all {_rule(2, "Critical", "2. No duplicate record_id", "copies > 1")}
    union all {_rule(3, "Major", "3. Date format YYYY-MM-DD", "l_linenumber = 7")}
    union all {_rule(4, "Major", "4. delivery_date after date", "l_linenumber <> 7 and delivered <= shipped")}
    union all {_rule(5, "Critical", "5. amount > 0", "amount is null or amount <= 0")}
    union all {_rule(6, "Minor", "6. amount within 3 SD (outlier)", "abs(amount - mu) > 3 * sd")}
    union all {_rule(7, "Major", "7. currency in {USD, EUR}", "currency not in ('USD', 'EUR')")}
    union all {_rule(8, "Critical", "8. vendor_id in reference list", "known is not true")}
    union all {_rule(9, "Major", "9. payment_status in {paid, pending, overdue}", "payment_status = 'unknown'")}
    union all select 10, '10. All columns ≥ 95% non-null', 'Minor',
      (select count(*) from (select unnest([count("date"), count(vendor_id), count(amount), count(created_by)]) as f,
                                    count(*) as c from r) where f / c::double * 100 < 95), 10, '')
"""
REPORT_ROWS = REPORT + """
  select rule, severity, case when violations > 0 then 'FAIL' else 'PASS' end as status, violations,
         coalesce(ids, '') || case when violations > 10 and coalesce(ids, '') <> '' then ' …' else '' end as sample_ids
  from all_rules
"""
WEIGHT = "case severity when 'Critical' then 3 when 'Major' then 2 else 1 end"
SCORE = f"sum({WEIGHT} * (1 - violations / checked::double)) / sum({WEIGHT}) * 100"


BROKEN = """
  select record_id, amount, list_filter([
           case when vendor_id is null or amount is null then '1. No nulls in required fields' end,
           case when l_linenumber = 7 then '3. Date format YYYY-MM-DD' end,
           case when l_linenumber <> 7 and delivered <= shipped then '4. delivery_date after date' end,
           case when amount is null or amount <= 0 then '5. amount > 0' end,
           case when abs(amount - (select avg(amount) from r)) > 3 * (select stddev_samp(amount) from r)
                then '6. amount within 3 SD (outlier)' end,
           case when currency = 'XYZ' then '7. currency in {USD, EUR}' end,
           case when payment_status = 'unknown' then '9. payment_status in {paid, pending, overdue}' end],
         lambda x : x is not null) as broken
  from r
"""

NAMES = (
    "Segment",
    "Country",
    "Product",
    "Units Sold",
    "Sale Price",
    "Gross Sales",
    "Sales",
    "COGS",
    "Profit",
    "Date",
    "Month Number",
    "Year",
)
REQUIRED = ("Segment", "Country", "Product", "Units Sold", "Sales", "Profit", "Date")
CHECK_CTE = f"""
  f as (select *, "Units Sold" * "Sale Price" as calc_gross,
               abs("Gross Sales" - "Units Sold" * "Sale Price") / "Gross Sales" as gross_diff_pct
        from ({t.FINANCIALS})),
  k as (select 0 as rule, '' as subject, 0 as violations, null::double as complete_pct, false as raises where false
"""
for _c in REQUIRED:
    CHECK_CTE += f"""union all select 1, '{_c}', count(*) - count("{_c}"), null, true from f\n"""
CHECK_CTE += """union all select 3, 'Date', count(*) - count("Date"), null, false from f\n"""
for _n, _c in ((4, "Units Sold"), (5, "Sale Price"), (6, "Sales"), (9, "COGS")):
    CHECK_CTE += f"""union all select {_n}, '{_c}', count(*) filter ("{_c}" <= 0), null, true from f\n"""
CHECK_CTE += """
  union all select 7, 'Profit', count(*) filter (abs("Profit" - (select avg("Profit") from f)) > 3 * (select stddev_samp("Profit") from f)), null, false from f
  union all select 8, 'Gross Sales', count(*) filter (gross_diff_pct > 0.10), null, false from f
"""
for _c in (*NAMES, "calc_gross", "gross_diff_pct"):
    CHECK_CTE += f"""union all select 10, '{_c}', (count("{_c}") / count(*)::double * 100 < 95)::int, count("{_c}") / count(*)::double * 100, true from f\n"""
CHECK_CTE += ")"

QUERIES: dict[str, Query] = {
    "integrity_report": Query(integrity_report, REPORT_ROWS),
    "integrity_score": Query(
        integrity_score,
        REPORT
        + f"""select round(s, 4) as score, case when s >= 90 then 'A' when s >= 75 then 'B' when s >= 60 then 'C' else 'D' end as grade
              from (select {SCORE} as s from all_rules)""",
    ),
    "rule_status": Query(
        rule_status,
        REPORT + "select count(*) filter (violations = 0) as passed, count(*) filter (violations > 0) as failed from all_rules",
    ),
    "severity_counts": Query(
        severity_counts,
        REPORT
        + """select severity, count(*) as rules, count(*) filter (violations > 0) as failed, sum(violations)::bigint as violations
             from all_rules group by 1""",
    ),
    "violating_records": Query(
        violating_records,
        f"""with r as ({t.RECORDS}), b as ({BROKEN})
            select record_id, amount, len(broken)::int as broken, array_to_string(broken, '; ') as rules from b where len(broken) > 0""",
    ),
    "unknown_vendors": Query(
        unknown_vendors,
        f"""select record_id, vendor_id from ({t.RECORDS}) r
            where not exists (select 1 from supplier where s_acctbal > 0 and s_suppkey = r.vendor_id)""",
    ),
    "financial_checks": Query(
        financial_checks,
        f"""with {CHECK_CTE}
            select rule, subject, violations::bigint as violations, round(complete_pct, 4) as complete_pct,
                   case when not raises then 'INFO' when violations > 0 then 'FAIL' else 'PASS' end as status from k
            union all select 2, 'row', (select count(*) from lineitem) - (select count(*) from f), null, 'INFO'""",
    ),
    "financial_issues": Query(
        financial_issues,
        f"""with {CHECK_CTE},
            m as (select rule, subject, case rule
                    when 1 then format('Rule 1: {{:,}} nulls in {{}}', violations::bigint, subject)
                    when 10 then 'Rule 10: ' || subject || ' only ' || format('{{:.1f}}', complete_pct) || '% complete'
                    else format('Rule {{}}: {{:,}} rows with {{}} <= 0', rule, violations::bigint, subject) end as line
                  from k where raises and violations > 0)
            select 0 as line_no, 'FINANCIAL DATA VALIDATION REPORT' as line
            union all select 1, repeat('=', 60) union all select 2, ''
            union all select 3, 'ISSUES FOUND: ' || (select count(*) from m)
            union all select (3 + row_number() over (order by rule, subject))::int, '  • ' || line from m""",
    ),
    "gross_mismatch": Query(
        gross_mismatch,
        f"""with f as (select *, abs("Gross Sales" - "Units Sold" * "Sale Price") / "Gross Sales" as gap from ({t.FINANCIALS}))
            select "Segment", "Country", count(*) as "rows", round(avg(gap), 4) as mean_gap from f where gap > 0.10 group by 1, 2""",
    ),
    "domain_violations": Query(
        domain_violations,
        """select 'o_orderstatus' as "column", o_orderstatus as value, count(*) as "rows" from orders
           where o_orderstatus not in ('F', 'O') group by 2
           union all select 'r_name', r_name, count(*) from region
           where r_name not in ('AFRICA', 'AMERICA', 'ASIA', 'EUROPE') group by 2""",
    ),
    "domain_match": Query(
        domain_match,
        """select 'o_orderstatus' as "column", count(distinct o_orderstatus) = 3 and count(*) filter (o_orderstatus not in ('F','O','P')) = 0 as matches,
                  count(*) filter (o_orderstatus not in ('F','O','P')) as unexpected_rows from orders
           union all select 'o_orderpriority', count(*) filter (o_orderpriority not in ('1-URGENT','2-HIGH','3-MEDIUM')) = 0,
                  count(*) filter (o_orderpriority not in ('1-URGENT','2-HIGH','3-MEDIUM')) from orders""",
    ),
    "range_violations": Query(
        range_violations,
        """select 'l_discount' as "column", count(*) filter (l_discount < 0.01 or l_discount > 0.09) as violations from lineitem
           union all select 'l_quantity', count(*) filter (l_quantity < 1 or l_quantity > 45) from lineitem
           union all select 'l_linenumber', count(*) filter (l_linenumber < 1 or l_linenumber > 7) from lineitem""",
    ),
}
