
from __future__ import annotations

from collections.abc import Callable
from importlib.util import find_spec

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillscope.functions.measures import as_double
from tillscope.operators.calendar import with_months
from tillscope.operators.cleaning import clean
from tillscope.operators.quality import quality_report
from tillscope.operators.rollup import merchant_totals, roll_up
from tillscope.plans import insights, results
from tillscope.sources import star

# The training-text part may be left out; where it is there, errors in it are errors here.
_PARTS = [find_spec(name) for name in ("corpus_pipeline", "tillscope.llm")]
if all(part is not None and part.origin for part in _PARTS):
    import corpus_pipeline
    from tillscope.llm import queries as training_text
else:
    corpus_pipeline = training_text = None

SMOKE_DIR = "/root/testdata/sf0.001"
# Fixed value: the moment the quality report calls "now"; some test orders lie after it.
REPORT_TIME = "2001-01-01 00:00:00"

Query = Callable[[SparkSession, str], DataFrame]


def _merchant_sales(spark: SparkSession, folder: str, result: str) -> DataFrame:
    """Totals with merchants attached, grouped only as finely as ``result`` needs."""
    return merchant_totals(
        star.order_totals(spark, folder),
        star.merchants(spark, folder),
        results.MERCHANT_KEYS[result],
    )


def _calendar_sales(spark: SparkSession, folder: str, result: str) -> DataFrame:
    """Totals that need no merchant at all."""
    keys = results.CALENDAR_KEYS[result]
    if "installments" in keys:
        return roll_up(star.transactions(spark, folder), keys, in_cents=True)
    return roll_up(star.order_totals(spark, folder), keys)


def _result(name: str) -> Query:
    """One of the result tables."""
    source = _merchant_sales if name in results.MERCHANT_KEYS else _calendar_sales
    build = getattr(results, name)
    return lambda spark, folder: as_double(build(source(spark, folder, name)))


def _insight(name: str, result: str, build: Callable[[DataFrame], DataFrame]) -> Query:
    """A report figure over the table ``build`` makes from the sales of ``result``."""
    source = _merchant_sales if result in results.MERCHANT_KEYS else _calendar_sales
    figure = getattr(insights, name)
    return lambda spark, folder: as_double(figure(build(source(spark, folder, result))))


def _dataset_profile(spark: SparkSession, folder: str) -> DataFrame:
    return insights.dataset_profile(_merchant_sales(spark, folder, "city_category_sales"))


def _task4_coverage(spark: SparkSession, folder: str) -> DataFrame:
    sales = _merchant_sales(spark, folder, "city_dominant_categories")
    return insights.task4_coverage(
        results.popular_merchants_by_city(sales), results.city_dominant_categories(sales)
    )


def _data_quality(spark: SparkSession, folder: str) -> DataFrame:
    merchants = star.merchants(spark, folder)
    as_text = merchants.select(*[F.col(c).cast("string").alias(c) for c in merchants.columns])
    return quality_report(star.transactions(spark, folder), merchants, REPORT_TIME, as_text)


def _cleaned(spark: SparkSession, folder: str) -> DataFrame:
    return clean(star.transactions(spark, folder), star.merchants(spark, folder))


def _sample_rows(spark: SparkSession, folder: str) -> DataFrame:
    """First five cleaned rows (the feature is a five-row sample), in a repeatable order.

    Cleaning keeps every sale once, so the five are picked first and cleaned alone.
    """
    order = ("purchase_date", "merchant_id", "installments", "purchase_amount")
    first = star.transactions(spark, folder).orderBy(*order).limit(5)
    return clean(first, star.merchants(spark, folder)).orderBy(*order)


def queries() -> dict[str, Query]:
    """Every result table, report figure and table layer; each reads its whole tables."""
    tables = {name: _result(name) for name in (*results.MERCHANT_KEYS, *results.CALENDAR_KEYS)}
    averages = ("avg_sales_by_merchant_state", results.merchant_state_averages)
    popular = "popular_merchants_by_city"
    hourly = ("hourly_sales_patterns", results.hourly_sales_patterns)
    figures = {
        "dataset_profile": _dataset_profile,
        "task1_coverage": _insight(
            "task1_coverage", "top_merchants_by_month_city", results.top_merchants_by_month_city
        ),
        "task3_coverage": _insight(
            "task3_coverage", "top_hours_by_category", results.category_peak_hours
        ),
        "task4_coverage": _task4_coverage,
        "avg_sale_summary": _insight("avg_sale_summary", *averages),
        "top_average_merchants": _insight("top_average_merchants", *averages),
        "avg_sales_page": _insight("avg_sales_page", *averages),
        "peak_hour_distribution": _insight(
            "peak_hour_distribution", "top_hours_by_category", results.category_peak_hours
        ),
        # A city's leaders and podium need no deeper ranks than they show.
        "overall_popular_merchants": _insight(
            "overall_popular_merchants", popular,
            lambda sales: results.popular_merchants_by_city(sales, n=1),
        ),
        "city_podium": _insight(
            "city_podium", popular, lambda sales: results.popular_merchants_by_city(sales, n=3)
        ),
        "category_dominance": _insight(
            "category_dominance", "city_dominant_categories", results.city_dominant_categories
        ),
        "top_city_market_share": _insight(
            "top_city_market_share", "recommendation_top_cities",
            lambda sales: results.performance(sales, "city_id"),
        ),
        "monthly_trend_direction": _insight(
            "monthly_trend_direction", "monthly_sales_trends", results.monthly_sales_trends
        ),
        "peak_business_hours": _insight("peak_business_hours", *hourly),
        "peak_hours_chart": _insight("peak_hours_chart", *hourly),
        "best_installment_plan": _insight(
            "best_installment_plan", "installment_profitability_analysis",
            results.installment_profitability_analysis,
        ),
    }
    layers = {
        "raw_transactions": lambda spark, d: with_months(star.transactions(spark, d)),
        "raw_merchants": star.merchants,
        "cleaned_transactions": lambda spark, d: with_months(_cleaned(spark, d)),
        "sample_rows": _sample_rows,
        "data_quality_report": _data_quality,
    }
    return {**tables, **figures, **layers, **_training_text()}


def _training_text() -> dict[str, Query]:
    """Queries of the training-text operators and their pipeline, where they are installed."""
    if training_text is None:
        return {}
    return {**training_text.QUERIES, "pipeline": corpus_pipeline.run}


def entry(spark: SparkSession) -> DataFrame:
    """Flagship query: best merchants per month and city."""
    return queries()["top_merchants_by_month_city"](spark, SMOKE_DIR)


# --- the same questions in SQL ----------------------------------------------------------

_TRANSACTIONS = """
tx AS (
  SELECT CASE WHEN o_custkey % 17 = 3 THEN 'X' ELSE 'M' END || CAST(o_custkey AS VARCHAR) AS merchant_id,
         l_extendedprice AS purchase_amount,
         CAST(round(l_extendedprice * 100) AS BIGINT) AS cents,
         o_orderdate + to_hours(CAST(o_orderkey % 24 AS INTEGER)) AS purchase_date,
         CASE WHEN o_orderpriority <> '4-NOT SPECIFIED' THEN o_orderpriority END AS raw_category,
         CAST(l_linenumber AS INTEGER) AS installments
  FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey
)"""

_MERCHANTS = """
merchants AS (
  SELECT 'M' || CAST(c_custkey AS VARCHAR) AS merchant_id,
         CASE WHEN c_custkey % 10 <> 0 THEN c_name END AS merchant_name,
         CAST(c_nationkey AS INTEGER) AS city_id,
         CAST(n_regionkey AS INTEGER) AS state_id
  FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey
)"""

_CLEANED = f"""{_TRANSACTIONS},{_MERCHANTS},
cleaned AS (
  SELECT tx.merchant_id,
         coalesce(m.merchant_name, tx.merchant_id) AS merchant_name,
         m.city_id, m.state_id,
         coalesce(tx.raw_category, 'Unknown category') AS category,
         tx.purchase_date, tx.purchase_amount, tx.installments, tx.cents,
         CAST(year(tx.purchase_date) AS INTEGER) AS year,
         CAST(month(tx.purchase_date) AS INTEGER) AS month,
         CAST(hour(tx.purchase_date) AS INTEGER) AS hour
  FROM tx LEFT JOIN merchants m ON tx.merchant_id = m.merchant_id
)"""

# Amounts are whole cents, so sums are integers; means are rounded half up on integers.
_SUMS = "CAST(sum(cents) AS BIGINT) AS c, count(*) AS n"
_MEAN2 = "CAST((2 * c + n) // (2 * n) AS DOUBLE) / 100.0"

_TASK1 = f"""{_CLEANED},
task1 AS (
  SELECT strftime(make_date(year, month, 1), '%b %Y') AS month, city_id, merchant_name,
         c / 100.0 AS purchase_total, n AS no_of_sales
  FROM (
    SELECT *, dense_rank() OVER (PARTITION BY year, month, city_id ORDER BY c DESC, n DESC) AS r
    FROM (SELECT year, month, city_id, merchant_name, {_SUMS} FROM cleaned GROUP BY ALL)
  ) WHERE r <= 5
)"""

_TASK2 = f"""{_CLEANED},
task2 AS (
  SELECT merchant_name, state_id, (2 * c + n) // (2 * n) AS avg_cents,
         {_MEAN2} AS average_amount
  FROM (SELECT merchant_name, state_id, {_SUMS} FROM cleaned GROUP BY ALL)
)"""

_TASK3 = f"""{_CLEANED},
task3 AS (
  SELECT category, hour FROM (
    SELECT *, dense_rank() OVER (PARTITION BY category ORDER BY c DESC) AS r
    FROM (SELECT category, hour, {_SUMS} FROM cleaned GROUP BY ALL)
  ) WHERE r <= 3
)"""

_TASK4 = f"""{_CLEANED},
popular AS (
  SELECT merchant_name, city_id, n AS transaction_count, CAST(r AS INTEGER) AS rank FROM (
    SELECT *, dense_rank() OVER (PARTITION BY city_id ORDER BY n DESC) AS r
    FROM (SELECT merchant_name, city_id, count(*) AS n FROM cleaned GROUP BY ALL)
  ) WHERE r <= 10
),
dominant AS (
  SELECT city_id, category AS dominant_category, n AS category_transactions FROM (
    SELECT *, row_number() OVER (PARTITION BY city_id ORDER BY n DESC, category DESC) AS r
    FROM (SELECT city_id, category, count(*) AS n FROM cleaned GROUP BY ALL)
  ) WHERE r = 1
)"""


def _performance(key: str) -> str:
    return f"""{_CLEANED},
performance AS (
  SELECT {key}, c, c / 100.0 AS total_sales, n AS transaction_count,
         CAST(c AS DOUBLE) / (100 * n) AS mean_sale  -- rounded once
  FROM (SELECT {key}, {_SUMS} FROM cleaned GROUP BY ALL)
)"""


_CALENDAR = f"""{_CLEANED},
monthly AS (
  SELECT year, month, c, c / 100.0 AS total_sales, n AS transaction_count
  FROM (SELECT year, month, {_SUMS} FROM cleaned GROUP BY ALL)
),
hourly AS (
  SELECT hour, c, c / 100.0 AS total_sales, n AS transaction_count
  FROM (SELECT hour, {_SUMS} FROM cleaned GROUP BY ALL)
)"""

# 0.25 gross margin; 0.229 * 0.5 = 0.1145 expected loss on plans of more than one payment.
_PROFIT = f"""{_CLEANED},
profit AS (
  SELECT installments, {_MEAN2} AS avg_purchase_amount, n AS transaction_count,
         CAST((c * 2500 + 5000) // 10000 AS DOUBLE) / 100.0 AS gross_profit,
         CAST((c * loss + 5000) // 10000 AS DOUBLE) / 100.0 AS expected_default_loss,
         CAST((c * (2500 - loss) + 5000) // 10000 AS DOUBLE) / 100.0 AS net_profit,
         CAST(2500 - loss AS DOUBLE) / 100.0 AS profit_margin_pct
  FROM (
    SELECT installments, {_SUMS}, CASE WHEN installments > 1 THEN 1145 ELSE 0 END AS loss
    FROM cleaned GROUP BY installments
  )
)"""


def oracle_sql() -> dict[str, str]:
    """DuckDB SQL with the same answer as each query."""
    top_performance = """
SELECT {key}, total_sales, transaction_count, mean_sale AS avg_transaction_value
FROM performance ORDER BY c DESC, {key} NULLS FIRST LIMIT 5"""
    by_average = "ORDER BY avg_cents DESC, merchant_name NULLS FIRST, state_id NULLS FIRST"
    distinct = "(count(DISTINCT {0}) + CAST(coalesce(max(CAST({0} IS NULL AS INTEGER)), 0) AS BIGINT))"

    sql = {
        "top_merchants_by_month_city": f"{_TASK1} SELECT * FROM task1",
        "avg_sales_by_merchant_state": f"{_TASK2} SELECT merchant_name, state_id, average_amount FROM task2",
        "top_hours_by_category": f"{_TASK3} SELECT category, CAST(hour AS VARCHAR) AS hour FROM task3",
        "popular_merchants_by_city": f"{_TASK4} SELECT * FROM popular",
        "city_category_sales": f"""{_CLEANED}
SELECT city_id, category, n AS transaction_count, c / 100.0 AS total_sales
FROM (SELECT city_id, category, {_SUMS} FROM cleaned GROUP BY ALL)""",
        "city_dominant_categories": f"{_TASK4} SELECT * FROM dominant",
        "recommendation_top_cities": _performance("city_id") + top_performance.format(key="city_id"),
        "recommendation_top_categories": _performance("category")
        + top_performance.format(key="category"),
        "monthly_sales_trends": f"{_CALENDAR} SELECT year, month, total_sales, transaction_count FROM monthly",
        "hourly_sales_patterns": f"{_CALENDAR} SELECT hour, total_sales, transaction_count FROM hourly",
        "installment_profitability_analysis": f"{_PROFIT} SELECT * FROM profit",
        "dataset_profile": f"""{_CLEANED}
SELECT count(*) AS total_records,
       {distinct.format("merchant_id")} AS unique_merchants,
       {distinct.format("city_id")} AS unique_cities,
       {distinct.format("state_id")} AS unique_states,
       {distinct.format("category")} AS unique_categories
FROM cleaned""",
        "task1_coverage": f"""{_TASK1}
SELECT count(*) AS result_rows, count(DISTINCT month) AS months,
       {distinct.format("city_id")} AS cities FROM task1""",
        "task3_coverage": f"""{_TASK3}
SELECT count(*) AS result_rows, {distinct.format("category")} AS categories FROM task3""",
        "task4_coverage": f"""{_TASK4}
SELECT 'popular_merchants_by_city' AS part, count(*) AS result_rows,
       {distinct.format("city_id")} AS cities FROM popular
UNION ALL
SELECT 'city_dominant_categories', count(*), {distinct.format("city_id")} FROM dominant""",
        "avg_sale_summary": f"""{_TASK2}
SELECT combinations, min_avg, max_avg,
       CAST((2 * s + combinations) // (2 * combinations) AS DOUBLE) / 100.0 AS overall_avg
FROM (SELECT count(*) AS combinations, min(average_amount) AS min_avg,
             max(average_amount) AS max_avg, CAST(sum(avg_cents) AS BIGINT) AS s FROM task2)""",
        "top_average_merchants": f"""{_TASK2}
SELECT merchant_name, state_id, average_amount FROM task2 {by_average} LIMIT 10""",
        "avg_sales_page": f"""{_TASK2}
SELECT substring(merchant_name, 1, 40) AS merchant, state_id,
       '$' || format('{{:,.2f}}', average_amount) AS average
FROM (SELECT * FROM task2 {by_average} LIMIT 20 OFFSET 10)""",
        "peak_hour_distribution": f"""{_TASK3}
SELECT hour, lpad(CAST(hour AS VARCHAR), 2, '0') || ':00-' || lpad(CAST(hour AS VARCHAR), 2, '0')
       || ':59' AS time_label, count(*) AS categories, repeat('█', count(*)) AS bar
FROM task3 GROUP BY hour""",
        "overall_popular_merchants": f"""{_TASK4}
SELECT * FROM popular WHERE rank = 1
ORDER BY transaction_count DESC, merchant_name NULLS FIRST, city_id NULLS FIRST LIMIT 5""",
        "city_podium": f"{_TASK4} SELECT * FROM popular WHERE rank <= 3",
        "category_dominance": f"""{_TASK4}
SELECT dominant_category, count(*) AS cities FROM dominant GROUP BY dominant_category""",
        "top_city_market_share": _performance("city_id") + """
SELECT top_c / 100.0 AS top_cities_sales, all_c / 100.0 AS total_sales,
       (top_c / 100.0) / (all_c / 100.0) * 100 AS market_share_pct
FROM (SELECT CAST(sum(c) FILTER (r <= 5) AS BIGINT) AS top_c, CAST(sum(c) AS BIGINT) AS all_c
      FROM (SELECT c, row_number() OVER (ORDER BY c DESC, city_id NULLS FIRST) AS r
            FROM performance))""",
        "monthly_trend_direction": f"""{_CALENDAR}
SELECT CAST(year AS VARCHAR) || '-' || lpad(CAST(month AS VARCHAR), 2, '0') AS year_month,
       total_sales, '$' || format('{{:,.0f}}', total_sales) AS sales_label, transaction_count,
       CASE WHEN lag(c) OVER w IS NULL THEN '' WHEN c > lag(c) OVER w THEN '↑' ELSE '↓' END AS trend
FROM (SELECT * FROM monthly ORDER BY year DESC, month DESC LIMIT 12)
WINDOW w AS (ORDER BY year, month)""",
        "peak_business_hours": f"""{_CALENDAR}
SELECT hour, total_sales, transaction_count FROM hourly ORDER BY c DESC, hour LIMIT 10""",
        "peak_hours_chart": f"""{_CALENDAR}
SELECT hour, lpad(CAST(hour AS VARCHAR), 2, '0') || ':00' AS time_label, total_sales,
       '$' || format('{{:,.0f}}', total_sales) AS sales_label, transaction_count, bar_length,
       repeat('█', bar_length) AS bar
FROM (SELECT *, CAST(floor(total_sales / max(total_sales) OVER () * 30) AS INTEGER) AS bar_length
      FROM (SELECT * FROM hourly ORDER BY c DESC, hour LIMIT 10))""",
        "best_installment_plan": f"""{_PROFIT}
SELECT installments, net_profit, profit_margin_pct FROM profit
ORDER BY net_profit DESC, installments NULLS FIRST LIMIT 1""",
        "raw_transactions": f"""{_TRANSACTIONS}
SELECT merchant_id, purchase_amount, purchase_date, raw_category AS category, installments,
       CAST(year(purchase_date) AS INTEGER) AS year, CAST(month(purchase_date) AS INTEGER) AS month
FROM tx""",
        "raw_merchants": f"{_MERCHANTS} SELECT * FROM merchants",
        "cleaned_transactions": f"{_CLEANED} SELECT * EXCLUDE (cents, hour) FROM cleaned",
        "sample_rows": f"""{_CLEANED} SELECT * EXCLUDE (cents, year, month, hour) FROM cleaned
ORDER BY purchase_date, merchant_id, installments, purchase_amount LIMIT 5""",
        "data_quality_report": f"""{_TRANSACTIONS},{_MERCHANTS},
checks AS (
  SELECT count(*) FILTER (merchant_id IS NULL) AS null_merchant_id,
         count(*) FILTER (purchase_amount < 0) AS negative_amount,
         count(*) FILTER (purchase_date > TIMESTAMP '{REPORT_TIME}') AS future_date,
         count(*) FILTER (abs(purchase_amount * 100 - round_even(purchase_amount * 100, 0)) > 1e-3) AS sub_cent_amount,
         count(*) FILTER (merchant_id IS NOT NULL AND NOT EXISTS (
           SELECT 1 FROM merchants WHERE merchants.merchant_id = tx.merchant_id)) AS unmatched_merchant
  FROM tx
)
SELECT "check", failing_rows FROM (
  UNPIVOT checks ON null_merchant_id, negative_amount, future_date, sub_cent_amount, unmatched_merchant
  INTO NAME "check" VALUE failing_rows)
UNION ALL
SELECT 'duplicate_merchant_id', count(*) - count(DISTINCT merchant_id) FROM merchants
UNION ALL
SELECT 'bad_merchant_field', count(*) FILTER (
  (c_nationkey IS NOT NULL AND TRY_CAST(CAST(c_nationkey AS VARCHAR) AS INTEGER) IS NULL)
  OR (n_regionkey IS NOT NULL AND TRY_CAST(CAST(n_regionkey AS VARCHAR) AS INTEGER) IS NULL))
FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey""",
    }
    checked = {name: f"WITH {text.strip()}" for name, text in sql.items()}
    if training_text is not None:
        checked.update(training_text.ORACLE_SQL)
        if corpus_pipeline.ORACLE_SQL is not None:
            checked["pipeline"] = corpus_pipeline.ORACLE_SQL
    return checked
