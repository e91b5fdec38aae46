"""The standing reports on the star schema.

Wherever a report joins a dimension, the fact is first added up to one row per key if
the report allows it. The join then meets unique keys on both sides, so a customer,
product or day holding a large share of the rows cannot pile up in one task, and Spark
picks the kind of join by the sizes it measures. Reports that need finer rows go
through ``join_lookup``, which checks the size of what it broadcasts and cuts up
frequent keys otherwise.
"""

from pyspark.sql import Column, DataFrame, Window, functions as F

from tillwise.functions.calendar import month_start, months_between_starts, period_label
from tillwise.functions.numeric import money_sum, money_total, ratio, round_half_up
from tillwise.operators.joins import join_lookup
from tillwise.operators.ranking import with_running_total
from tillwise.operators.selection import exact_quantiles
from tillwise.operators.star import STORED_ONLY, YEAR_MONTH, Star


MONTH = ("year", "month", "month_name")


def _daily_by_month(star: Star) -> DataFrame:
    """Revenue and lines per day next to the month of the day."""
    daily = star.fact.groupBy("date_key").agg(
        money_total("revenue").alias("amount"), F.count("revenue").alias("lines")
    )
    return daily.join(star.dates.select("date_key", *MONTH), "date_key")


def _last_day(star: Star) -> Column:
    """Latest day of the whole fact table, that is of its days. It goes into the plan as a literal."""
    return F.lit(star.dates.agg(F.max("date_key")).first()[0]).cast("date")


def _since(fact: DataFrame, day: Column) -> DataFrame:
    """Fact rows from a day on. A stored fact is read from the month of that day on; the
    filter by day skips row groups."""
    rows = fact.where(F.col("date_key") >= day)
    return rows.where(F.col(YEAR_MONTH) >= F.date_format(day, "yyyy-MM")) if YEAR_MONTH in fact.columns else rows


# --- monthly ----------------------------------------------------------------


def monthly_revenue(star: Star) -> DataFrame:
    """Revenue and orders per month."""
    days = star.dates.select("date_key", *MONTH)
    return (
        join_lookup(star.fact.select("date_key", "invoice_no", "revenue"), days, "date_key")
        .groupBy(*MONTH)
        .agg(
            round_half_up(money_sum("revenue"), 2).alias("monthly_revenue"),
            F.count_distinct("invoice_no").alias("orders"),
        )
        .orderBy("year", "month")
    )


def monthly_labelled(star: Star) -> DataFrame:
    """Revenue per month with a label such as 'Jan 2011'."""
    return (
        _daily_by_month(star)
        .groupBy(*MONTH)
        .agg(F.sum("amount").cast("double").alias("revenue"))
        .withColumn("period", period_label(F.col("month_name"), F.col("year")))
        .orderBy("year", "month")
    )


def month_growth(star: Star) -> DataFrame:
    """Growth in percent over the previous month that has sales.

    The window sees one row per month.
    """
    monthly = _daily_by_month(star).groupBy("year", "month").agg(F.sum("amount").cast("double").alias("total"))
    previous = F.lag("total").over(Window.orderBy("year", "month"))
    return (
        monthly.withColumn("previous", previous)
        .select(
            "year",
            "month",
            round_half_up(F.col("total"), 2).alias("revenue"),
            round_half_up(F.col("previous"), 2).alias("prev_month_revenue"),
            round_half_up(
                (F.col("total") - F.col("previous")) * 100.0 / F.nullif(F.col("previous"), F.lit(0.0)), 1
            ).alias("mom_growth_pct"),
        )
        .orderBy("year", "month")
    )


def seasonality(star: Star) -> DataFrame:
    """Mean line revenue and total per calendar month, all years together."""
    return (
        _daily_by_month(star)
        .groupBy("month_name", "month")
        .agg(
            ratio(F.sum("amount"), F.sum("lines")).alias("avg_line_revenue"),
            F.sum("amount").cast("double").alias("total_revenue"),
        )
        .orderBy("month")
    )


# --- products ---------------------------------------------------------------


def _sales_by_product(star: Star) -> DataFrame:
    sold = star.fact.groupBy("stock_code").agg(
        money_total("revenue").alias("amount"), F.sum("quantity").alias("units")
    )
    return sold.join(star.products.select("stock_code", "description"), "stock_code")


def top_products(star: Star, n: int = 10) -> DataFrame:
    """Best selling products by code and description."""
    return (
        _sales_by_product(star)
        .select(
            "stock_code",
            "description",
            round_half_up(F.col("amount").cast("double"), 2).alias("total_revenue"),
            F.col("units").alias("total_units"),
        )
        .orderBy(F.desc("total_revenue"), "stock_code")
        .limit(n)
    )


def top_descriptions(star: Star, n: int = 10) -> DataFrame:
    """Best selling descriptions; codes that share one are added up."""
    return (
        _sales_by_product(star)
        .groupBy("description")
        .agg(F.sum("amount").cast("double").alias("revenue"), F.sum("units").alias("units"))
        .orderBy(F.desc("revenue"), "description")
        .limit(n)
    )


def sku_concentration(star: Star) -> DataFrame:
    """Products by revenue with their cumulative share of all revenue."""
    sold = star.fact.groupBy("stock_code").agg(money_total("revenue").alias("amount"))
    running = with_running_total(
        sold, [F.desc("amount"), "stock_code"], "amount", "so_far", "overall"
    )
    return running.select(
        "stock_code",
        F.col("amount").cast("double").alias("revenue"),
        F.col("so_far").cast("double").alias("cumulative_revenue"),
        ratio(F.col("so_far"), F.col("overall")).alias("cumulative_share"),
    )


# --- countries --------------------------------------------------------------


def _spend_by_customer(star: Star) -> DataFrame:
    spent = star.fact.groupBy("customer_id").agg(money_total("revenue").alias("amount"))
    return spent.join(star.customers, "customer_id")


def revenue_by_country(star: Star) -> DataFrame:
    """Revenue, customers and revenue per customer by country.

    There is one row per customer before the last step, so counting rows counts
    distinct customers.
    """
    amount = F.sum("amount").cast("double")
    return (
        _spend_by_customer(star)
        .groupBy("country")
        .agg(
            round_half_up(amount, 2).alias("total_revenue"),
            F.count("customer_id").alias("customers"),
            round_half_up(ratio(amount, F.count("customer_id")), 2).alias("revenue_per_customer"),
        )
        .orderBy(F.desc("total_revenue"), "country")
    )


def top_countries(star: Star, n: int = 10) -> DataFrame:
    return (
        _spend_by_customer(star)
        .groupBy("country")
        .agg(F.sum("amount").cast("double").alias("revenue"))
        .orderBy(F.desc("revenue"), "country")
        .limit(n)
    )


def country_quarter_change(star: Star) -> DataFrame:
    """Revenue change per country in the last quarter of the data, largest drop first.

    The quarter is compared with the calendar quarter before it; a country without
    sales in one of the two counts as zero there.
    """
    last_quarter = F.trunc(_last_day(star), "quarter")
    quarter_before = F.add_months(last_quarter, -3)
    recent = (
        _since(star.fact, quarter_before)
        .groupBy("customer_id", F.trunc("date_key", "quarter").alias("quarter_start"))
        .agg(money_total("revenue").alias("amount"))
        .join(star.customers, "customer_id")
    )
    is_last = F.col("quarter_start") == last_quarter

    def total(condition: Column) -> Column:
        return F.coalesce(F.sum(F.when(condition, F.col("amount"))).cast("double"), F.lit(0.0))

    return (
        recent.groupBy("country")
        .agg(total(is_last).alias("revenue"), total(~is_last).alias("previous_revenue"))
        .withColumn("change", round_half_up(F.col("revenue") - F.col("previous_revenue"), 2))
        .orderBy("change", "country")
    )


def country_last_month(star: Star, country: str | None = None) -> DataFrame:
    """Sales per country, or of one country, in the last month of the data."""
    first_day = month_start(_last_day(star))
    spent = (
        _since(star.fact, first_day)
        .groupBy("customer_id")
        .agg(money_total("revenue").alias("amount"), F.count(F.lit(1)).alias("lines"))
    )
    customers = star.customers if country is None else star.customers.where(F.col("country") == country)
    return (
        spent.join(customers, "customer_id")
        .groupBy("country")
        .agg(
            F.sum("amount").cast("double").alias("total_sales"),
            F.count("customer_id").alias("customers"),
            F.sum("lines").alias("lines"),
        )
    )


# --- customers --------------------------------------------------------------


def customer_orders(star: Star) -> DataFrame:
    """Orders and spend per customer. Adding up per order first spreads a customer
    with a large share of the rows over many tasks."""
    orders = star.fact.groupBy("customer_id", "invoice_no").agg(money_total("revenue").alias("amount"))
    return orders.groupBy("customer_id").agg(
        F.count("invoice_no").alias("n_orders"),
        F.sum("amount").cast("double").alias("total_spend"),
    )


def spend_capped(customers: DataFrame, probability: float = 0.95) -> DataFrame:
    """Customer spend with values above the quantile brought down to it.

    ``customers`` is the result of :func:`customer_orders`.
    """
    cap = exact_quantiles(customers, {"cap": ("total_spend", probability)})["cap"]
    return customers.select(
        "customer_id", "total_spend", F.least(F.col("total_spend"), F.lit(cap).cast("double")).alias("capped_spend")
    )


def histogram(df: DataFrame, column: str, bins: int = 30) -> DataFrame:
    """Equal-width bins between the smallest and the largest value.

    The last bin includes the largest value. If all values are equal, the range is
    widened by a half on both sides, which puts them in the middle bin. Empty bins
    are listed with a count of zero.
    """
    lowest, highest = df.agg(F.min(column).cast("double"), F.max(column).cast("double")).first()
    if lowest is None:
        lowest, highest = 0.0, 1.0
    elif lowest == highest:
        lowest, highest = lowest - 0.5, highest + 0.5
    low, high = F.lit(lowest), F.lit(highest)
    value = F.col(column).cast("double")
    number = F.least(F.floor(F.lit(float(bins)) * (value - low) / (high - low)) + 1, F.lit(bins)).cast("int")
    filled = df.where(F.col(column).isNotNull()).groupBy(number.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    frame = df.sparkSession.range(1, bins + 1).select(F.col("id").cast("int").alias("bin"))
    width = (high - low) / F.lit(float(bins))
    return frame.join(filled, "bin", "left").select(
        "bin",
        (low + width * (F.col("bin") - 1)).alias("lower_edge"),
        (low + width * F.col("bin")).alias("upper_edge"),
        F.coalesce("n", F.lit(0)).cast("bigint").alias("customers"),
    )


def cohort_retention(star: Star) -> DataFrame:
    """Share of each first-purchase cohort that is active N months later.

    After ``distinct`` a customer has at most one row per month, so the window over
    one customer is bounded by the calendar. The size of a cohort is its activity at
    offset zero, which needs no further join.
    """
    active = star.fact.select("customer_id", month_start(F.col("date_key")).alias("active_month")).distinct()
    first = F.min("active_month").over(Window.partitionBy("customer_id"))
    counted = (
        active.withColumn("cohort", first)
        .groupBy("cohort", months_between_starts(F.col("active_month"), F.col("cohort")).alias("month_offset"))
        .agg(F.count("customer_id").alias("active_customers"))
    )
    at_start = F.when(F.col("month_offset") == 0, F.col("active_customers"))
    return (
        counted.withColumn("cohort_customers", F.max(at_start).over(Window.partitionBy("cohort")))
        .select(
            F.date_format("cohort", "yyyy-MM").alias("cohort_month"),
            "month_offset",
            "active_customers",
            "cohort_customers",
            round_half_up(F.col("active_customers") * 100.0 / F.col("cohort_customers"), 1).alias("retention_pct"),
        )
        .orderBy("cohort_month", "month_offset")
    )


# --- headline figures -------------------------------------------------------


def kpis(star: Star) -> DataFrame:
    """Total revenue, orders, active customers and average order value in one pass."""
    return measures(star.fact).withColumn("avg_order_value", F.coalesce("avg_order_value", F.lit(0.0)))


def measures(rows: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """Total revenue, total orders, active customers and average order value, for the
    whole input or per group. The average is blank where there are no orders.

    Lines are added up to one row per customer and order first. One row of each order is marked
    and counted, and one row is left of each customer, so nothing has to be multiplied to
    count two things that differ.
    """
    orders = rows.groupBy(*by, "customer_id", "invoice_no").agg(money_total("revenue").alias("amount"))
    in_order = Window.partitionBy(*by, "invoice_no").orderBy("customer_id")
    first = (F.row_number().over(in_order) == 1) & F.col("invoice_no").isNotNull()
    marked = orders.withColumn("marked", first.cast("bigint"))
    customers = marked.groupBy(*by, "customer_id").agg(F.sum("amount").alias("amount"), F.sum("marked").alias("orders"))
    return (
        customers.groupBy(*by)
        .agg(
            F.sum("amount").cast("double").alias("total_revenue"),
            F.coalesce(F.sum("orders"), F.lit(0)).alias("total_orders"),
            F.count("customer_id").alias("active_customers"),
        )
        .withColumn("avg_order_value", ratio(F.col("total_revenue"), F.col("total_orders")))
    )


# Of 2^12 registers; the standard error of a count is 1.04 / 2^6, that is 1.6 %.
SKETCH_BITS = 12


def measures_cube(star: Star) -> DataFrame:
    """Revenue, and sketches of orders and customers, by month and country: a small table that
    can be rolled up to any coarser grain."""
    located = join_lookup(
        star.fact.select("customer_id", "invoice_no", "date_key", "revenue"), star.customers, "customer_id"
    )
    return located.groupBy(month_start(F.col("date_key")).alias("first_day"), "country").agg(
        money_total("revenue").alias("amount"),
        F.hll_sketch_agg("invoice_no", SKETCH_BITS).alias("orders"),
        F.hll_sketch_agg("customer_id", SKETCH_BITS).alias("customers"),
    )


def roll_up(cube: DataFrame, *by: Column | str) -> DataFrame:
    """The measures at a coarser grain of the cube: revenue exactly, orders and customers within
    three standard errors of about 1.6 %, at a cost that does not depend on the lines."""
    merged = cube.groupBy(*by).agg(
        F.sum("amount").cast("double").alias("total_revenue"),
        F.hll_sketch_estimate(F.hll_union_agg("orders")).alias("total_orders"),
        F.hll_sketch_estimate(F.hll_union_agg("customers")).alias("active_customers"),
    )
    return merged.withColumn("avg_order_value", ratio(F.col("total_revenue"), F.col("total_orders")))


def key_stats(star: Star, customers: DataFrame) -> DataFrame:
    """Customers, medians, best month and best product in one row.

    ``customers`` is the result of :func:`customer_orders`. The first month wins a tie.
    """
    found = exact_quantiles(customers, {column: (column, 0.5) for column in ("n_orders", "total_spend")})
    medians = {column: F.lit(value).cast("double") for column, value in found.items()}
    nothing = {"period": None, "description": None, "revenue": None}
    best_month = monthly_labelled(star).orderBy(F.desc("revenue"), "year", "month").first() or nothing
    best_product = top_descriptions(star, 1).first() or nothing
    return customers.agg(F.count(F.lit(1)).alias("customers")).select(
        "customers",
        medians["n_orders"].alias("median_orders"),
        medians["total_spend"].alias("median_spend"),
        F.lit(best_month["period"]).cast("string").alias("best_month"),
        F.lit(best_month["revenue"]).cast("double").alias("best_month_revenue"),
        F.lit(best_product["description"]).cast("string").alias("best_product"),
        F.lit(best_product["revenue"]).cast("double").alias("best_product_revenue"),
    )


# --- model for BI tools -----------------------------------------------------


def sales_wide(star: Star) -> DataFrame:
    """Every fact row with the columns of its customer, product and day."""
    wide = join_lookup(star.fact.drop(*STORED_ONLY), star.customers, "customer_id")
    wide = join_lookup(wide, star.products, "stock_code", counted_on=star.fact)
    return join_lookup(wide, star.dates, "date_key", counted_on=star.fact)


def measures_by_month_country(star: Star) -> DataFrame:
    """The measures by year, month and country.

    Lines are added up to orders before the customer dimension is joined.
    """
    orders = star.fact.groupBy("customer_id", "invoice_no", month_start(F.col("date_key")).alias("first_day")).agg(
        money_total("revenue").alias("revenue")
    )
    located = join_lookup(orders, star.customers, "customer_id", counted_on=star.fact).select(
        F.year("first_day").alias("year"),
        F.month("first_day").alias("month"),
        "country",
        "customer_id",
        "invoice_no",
        "revenue",
    )
    return measures(located, ("year", "month", "country"))


def calendar_month_growth(star: Star) -> DataFrame:
    """Growth over the previous calendar month; blank where that month has no sales."""
    monthly = (
        _daily_by_month(star)
        .groupBy("year", "month")
        .agg(F.sum("amount").cast("double").alias("total_revenue"))
        .withColumn("first_day", F.make_date("year", "month", F.lit(1)))
    )
    previous = monthly.select(
        F.add_months("first_day", 1).alias("first_day"), F.col("total_revenue").alias("previous_month_revenue")
    )
    return monthly.join(previous, "first_day", "left").select(
        "year",
        "month",
        "total_revenue",
        "previous_month_revenue",
        ratio(F.col("total_revenue") - F.col("previous_month_revenue"), F.col("previous_month_revenue")).alias(
            "mom_growth"
        ),
    )


def year_to_date(star: Star) -> DataFrame:
    """Revenue from January up to each month; the window holds one year's months."""
    monthly = _daily_by_month(star).groupBy("year", "month").agg(F.sum("amount").alias("amount"))
    so_far = Window.partitionBy("year").orderBy("month").rowsBetween(Window.unboundedPreceding, 0)
    return monthly.select(
        "year",
        "month",
        F.col("amount").cast("double").alias("revenue"),
        F.sum("amount").over(so_far).cast("double").alias("ytd_revenue"),
    )


def date_parts(star: Star) -> DataFrame:
    """Lines per day with the day's date parts."""
    return (
        star.fact.groupBy("date_key")
        .agg(F.count(F.lit(1)).alias("lines"))
        .join(star.dates, "date_key")
        .select(
            F.date_format("date_key", "yyyy-MM-dd").alias("day"),
            F.date_format("date_key", "yyyy-MM").alias("year_month"),
            "year",
            "month",
            "quarter",
            "month_name",
            "day_of_week",
            "is_weekend",
            "lines",
        )
    )
