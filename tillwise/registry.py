"""All registered queries: name -> function of (spark, source folder)."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from tillwise.functions.numeric import round_half_up
from tillwise.functions.text import bare_statement, fenced_sql
from tillwise.functions.calendar import parse_wall_time
from tillwise.operators.cleaning import DEFAULT_PATTERN, clean, clean_report
from tillwise.operators.quality import foreign_key_check, primary_key_check
from tillwise.operators.selection import with_ntiles
from tillwise.operators.star import YEAR_MONTH, load_report
from tillwise.plans import feed, forecast, guard, reports, segments
from tillwise.sources import trade
from tillwise.sources.staging import new_path
from tillwise.warehouse import Warehouse

Query = Callable[[SparkSession, str], DataFrame]

# A statement on the star, as a model might write it.
UNITS_BY_QUARTER = """
WITH sold AS (
  SELECT c.country, d.year, d.quarter, SUM(f.quantity) AS units, COUNT(*) AS order_lines
  FROM fact_sales f
  JOIN dim_customer c ON f.customer_id = c.customer_id
  JOIN dim_date d ON f.date_key = d.date_key
  GROUP BY c.country, d.year, d.quarter
)
SELECT country, year, quarter, units, order_lines FROM sold;
"""


def dates_as_text(df: DataFrame) -> DataFrame:
    """Days and times in the text form the stored tables of the feed use."""
    texts = {
        name: F.col(name).cast("string") for name, kind in df.dtypes if kind in ("date", "timestamp_ntz")
    }
    return df.withColumns(texts) if texts else df


def rounded(df: DataFrame, digits: int, *columns: str) -> DataFrame:
    """Figures that depend on the summation order of doubles, rounded for comparison."""
    return df.withColumns({name: round_half_up(F.col(name), digits) for name in columns})


def _fixed_clusters(w: Warehouse) -> DataFrame:
    """Segments on a cluster column that any engine can compute."""
    rfm = w.rfm().withColumn("cluster", (F.col("customer_id") % 5).cast("int"))
    return segments.label_segments(rfm)


def _mixed_dates(raw: DataFrame) -> DataFrame:
    """The feed with its dates in many forms, by the quantity of the line."""
    at = parse_wall_time(F.col("InvoiceDate"), DEFAULT_PATTERN)
    forms = [
        F.date_format(at, form)
        for form in (
            "yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd'T'HH:mm:ss'Z'", "yyyy-MM-dd HH:mm:ss'.000'", "yyyy-MM-dd HH:mm:ss'+00:00'",
            "MMM d, yyyy HH:mm", "d-MMM-yyyy HH:mm", "yyyyMMdd HHmm", "d.M.yyyy H:mm", "M/d/yyyy h:mm a", "EEE, d MMMM yyyy HH:mm",
            "yyyyMMdd", "MMMM d yyyy",
        )
    ]
    form = F.pmod(F.col("Quantity"), F.lit(len(forms) + 1))
    text = F.when(at.isNull(), F.col("InvoiceDate"))
    for i, one in enumerate(forms):
        text = text.when(form == i, one)
    return raw.withColumn("InvoiceDate", text.otherwise(F.col("InvoiceDate")))


def _two_deliveries(w: Warehouse) -> DataFrame:
    """The feed in two deliveries that share some lines, appended one after the other."""
    part = F.pmod(F.crc32(F.concat_ws("/", "InvoiceNo", "StockCode")), F.lit(8))
    folder = new_path(w.spark, "feed")
    for delivery in (part <= 5, part >= 4):
        feed.append_feed(w.spark, w.raw().where(delivery), folder)
    return feed.read_feed(w.spark, folder)


def _daily(w: Warehouse) -> DataFrame:
    return forecast.daily_revenue(w.fact())


def _forecast(w: Warehouse, model: forecast.Model = forecast.fit_linear) -> DataFrame:
    return forecast.forecast_table(_daily(w), model=model)


def _guarded_run(w: Warehouse) -> DataFrame:
    w.star().register()
    outcome = guard.run_guarded(w.spark, "DROP TABLE fact_sales", UNITS_BY_QUARTER)
    return outcome.result.select(
        "*",
        F.lit(outcome.row_count).cast("bigint").alias("row_count"),
        F.lit(outcome.status).alias("status"),
    )


def _string_guards(w: Warehouse) -> DataFrame:
    text = F.col("stmt_text")
    return trade.statements(w.spark, w.folder).select(
        "stmt_id",
        bare_statement(text).alias("bare"),
        fenced_sql(text).alias("fenced"),
    ).withColumn("starts_well", F.col("bare").rlike(r"(?i)\A(SELECT|WITH)\b").cast("int"))


def _checked(w: Warehouse) -> DataFrame:
    found = guard.extract_sql(trade.statements(w.spark, w.folder), "stmt_text")
    return guard.check_statements(found, "sql_text").select(
        "stmt_id", "sql_text", F.col("is_safe").cast("int").alias("is_safe"), "reason"
    )


_QUERIES: dict[str, Callable[[Warehouse], DataFrame]] = {
    # feed and star
    "raw_feed": lambda w: w.raw(),
    "clean_sales": lambda w: w.clean(),
    "clean_report": lambda w: clean_report(w.raw()),
    "clean_mixed_dates": lambda w: clean(_mixed_dates(w.raw())),
    "append_dedup": _two_deliveries,
    "fact_sales": lambda w: w.fact().drop(YEAR_MONTH),
    "dim_customer": lambda w: w.star().customers,
    "dim_product": lambda w: w.star().products,
    "dim_date": lambda w: w.star().dates,
    "load_report": lambda w: load_report(w.star()),
    "dq_pk": lambda w: primary_key_check(w.star().tables()),
    "dq_fk": lambda w: foreign_key_check(w.star()),
    "date_parts": lambda w: reports.date_parts(w.star()),
    # reports
    "monthly_revenue": lambda w: reports.monthly_revenue(w.star()),
    "monthly_labelled": lambda w: reports.monthly_labelled(w.star()),
    "mom_growth": lambda w: reports.month_growth(w.star()),
    "seasonality": lambda w: reports.seasonality(w.star()),
    "top_products": lambda w: reports.top_products(w.star()),
    "top_descriptions": lambda w: reports.top_descriptions(w.star()).select("description", "revenue"),
    "top15_descriptions": lambda w: reports.top_descriptions(w.star(), 15),
    "sku_concentration": lambda w: reports.sku_concentration(w.star()),
    "revenue_by_country": lambda w: reports.revenue_by_country(w.star()),
    "top_countries": lambda w: reports.top_countries(w.star()),
    "country_qoq_drop": lambda w: reports.country_quarter_change(w.star()),
    "country_last_month": lambda w: reports.country_last_month(w.star()),
    "customer_orders": lambda w: w.customer_orders(),
    "spend_capped": lambda w: rounded(reports.spend_capped(w.customer_orders()), 6, "capped_spend"),
    "hist_orders": lambda w: rounded(
        reports.histogram(w.customer_orders(), "n_orders"), 6, "lower_edge", "upper_edge"
    ),
    "hist_spend": lambda w: rounded(
        reports.histogram(reports.spend_capped(w.customer_orders()), "capped_spend"),
        6, "lower_edge", "upper_edge",
    ),
    "cohort_retention": lambda w: reports.cohort_retention(w.star()),
    "kpis": lambda w: reports.kpis(w.star()),
    "key_stats": lambda w: reports.key_stats(w.star(), w.customer_orders()),
    # measures of the BI model
    "sales_wide": lambda w: reports.sales_wide(w.star()),
    "measures_by": lambda w: reports.measures_by_month_country(w.star()),
    "mom_growth_calendar": lambda w: reports.calendar_month_growth(w.star()),
    "ytd_revenue": lambda w: reports.year_to_date(w.star()),
    # customer value and segments
    "rfm_scores": lambda w: segments.rfm_scores(w.rfm()),
    "global_ntile": lambda w: with_ntiles(w.customer_orders(), 10, "customer_id", decile="total_spend").select(
        "customer_id", "total_spend", "decile"
    ),
    "rfm_base": lambda w: w.rfm(),
    "rfm_features": lambda w: rounded(segments.rfm_features(w.rfm()), 9, "frequency", "monetary"),
    "rfm_scaled": lambda w: rounded(segments.rfm_scaled(w.rfm()), 6, *segments.METRICS),
    "label_segments": lambda w: _fixed_clusters(w).select("customer_id", "cluster", "segment"),
    "segment_sizes": lambda w: segments.segment_sizes(_fixed_clusters(w)),
    "segment_profile": lambda w: segments.segment_profile(_fixed_clusters(w)),
    "segment_table": lambda w: segments.segment_table(_fixed_clusters(w)),
    "rfm_clusters": lambda w: w.segments(),
    "segment_by_country": lambda w: segments.segment_by_country(_fixed_clusters(w), w.star().customers),
    "segment_share": lambda w: rounded(segments.segment_share(_fixed_clusters(w)), 9, "customer_share", "monetary_share"),
    "at_risk_customers": lambda w: segments.at_risk_customers(_fixed_clusters(w)),
    # series and forecast
    "daily_revenue": lambda w: _daily(w),
    "daily_revenue_filled": lambda w: forecast.fill_days(_daily(w)),
    "holdout_split": lambda w: forecast.mark_holdout(forecast.fill_days(_daily(w))).withColumn(
        "is_test", F.col("is_test").cast("int")
    ),
    "future_frame": lambda w: forecast.future_frame(_daily(w), 90).withColumn(
        "is_future", F.col("is_future").cast("int")
    ),
    "forecast_linear": lambda w: rounded(
        forecast.fit_linear(forecast.fill_days(_daily(w), horizon=90)), 2, "yhat", "yhat_lower", "yhat_upper"
    ),
    "forecast_additive": lambda w: _forecast(w, forecast.fit_additive),
    "forecast_by_country": lambda w: rounded(
        forecast.forecast_table(w.daily_by_country(), keys=["country"]), 1, "forecast", "lower", "upper"
    ),
    "holdout_additive": lambda w: forecast.holdout_score(_daily(w), model=forecast.fit_additive),
    "forecast_table": lambda w: rounded(_forecast(w), 2, "forecast", "lower", "upper"),
    "forecast_total": lambda w: rounded(forecast.forecast_total(_forecast(w)), 2, "forecast_revenue"),
    "holdout_score": lambda w: rounded(forecast.holdout_score(_daily(w)), 4, "mae", "mape"),
    # statements and audit
    "string_guards": _string_guards,
    "sql_extract": lambda w: guard.extract_sql(trade.statements(w.spark, w.folder), "stmt_text").select(
        "stmt_id", "sql_text"
    ),
    "sql_guard": _checked,
    "guarded_run": _guarded_run,
    "result_preview": lambda w: guard.preview(
        w.star().customers.select("customer_id", "country"), (F.desc("customer_id"),)
    ),
    "audit_outcomes": lambda w: guard.audit_outcomes(trade.attempts(w.spark, w.folder)),
    "audit_append": lambda w: w.query_history(),
    "audit_recent": lambda w: guard.recent_history(w.query_history()),
}


def _bind(build: Callable[[Warehouse], DataFrame]) -> Query:
    return lambda spark, folder: dates_as_text(build(Warehouse(spark, folder)))


def queries() -> dict[str, Query]:
    return {name: _bind(build) for name, build in _QUERIES.items()}
