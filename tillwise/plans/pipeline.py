"""From the raw feed to stored tables: star, segments, forecast."""

from dataclasses import dataclass, field

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession, functions as F

from tillwise.functions.dates import order_of
from tillwise.operators.cleaning import MONTH_FIRST, Patterns, clean, clean_report
from tillwise.operators.star import YEAR_MONTH, Star, build_star, in_line_order, lines_before, load_report, with_line_ids
from tillwise.plans.forecast import Model, daily_revenue, fit_additive, forecast_table, forecast_total, holdout_score
from tillwise.plans.guard import create_history
from tillwise.plans.segments import rfm_base, segment_customers, segment_profile, segment_sizes
from tillwise.sources.files import normalise_headers, read_raw_csv, replace_table, table_exists, write_csv
from tillwise.sources.shared import SharedFolder
from tillwise.sources.snapshots import Conflict, Snapshot, commit, current, read_part, write_part
from tillwise.sources.staging import stage

TABLES = ("fact_sales", "dim_customer", "dim_product", "dim_date")

# Notes that a result was built from a version of the star.
_BUILT = "_built"


def commit_star(cleaned: DataFrame, folder: str) -> Snapshot:
    """Write the four tables next to those of the last version and switch to them at once.

    A refresh that fails before its end leaves the last version as it was. Of two refreshes
    at the same time the later commit counts. ``cleaned`` should be a written table.
    """
    spark = cleaned.sparkSession
    star = build_star(cleaned)
    fact = write_part(in_line_order(star.fact), folder, "fact_sales", (YEAR_MONTH,))
    parts = {
        "fact_sales": fact,
        "dim_customer": write_part(star.customers, folder, "dim_customer"),
        "dim_product": write_part(star.products, folder, "dim_product"),
        "dim_date": write_part(star.dates, folder, "dim_date"),
    }
    notes = {"fact_sales": {"lines_before": lines_before(read_part(spark, folder, "fact_sales", fact))}}
    while True:
        try:
            return commit(spark, current(spark, folder), replaced=parts, notes=notes)
        except Conflict:  # another version came in between: this one replaces it
            continue


def write_star(cleaned: DataFrame, folder: str, reset_audit: bool = False) -> Snapshot:
    """Replace the four tables. The audit log survives unless ``reset_audit``."""
    snapshot = commit_star(cleaned, folder)
    history = f"{folder}/query_history"
    spark = cleaned.sparkSession
    if reset_audit or not table_exists(spark, history):
        create_history(spark, history)
    return snapshot


def star_of(spark: SparkSession, snapshot: Snapshot) -> Star:
    """The four tables of one version."""
    fact, *dimensions = (snapshot.read(spark, name) for name in TABLES)
    return Star(with_line_ids(fact, snapshot.notes["fact_sales"]["lines_before"]), *dimensions)


def read_star(spark: SparkSession, folder: str) -> Star:
    """The star as of the last commit; it stays that one while others are written."""
    snapshot = current(spark, folder)
    if "fact_sales" not in snapshot.tables:
        raise FileNotFoundError(f"no star was committed in {folder}")
    return star_of(spark, snapshot)


@dataclass(frozen=True)
class Build:
    """What a run of the pipeline did: one message per step; the cleaning report of the
    feed if the star was built; and a few rows for each result that was built: ``tables`` (rows
    per table), ``segment_sizes``, ``segment_profile``, ``score`` of the model on held-out days,
    ``total`` of the days ahead."""

    log: list[str]
    cleaned: dict | None = None
    reports: dict[str, list[dict]] = field(default_factory=dict)


def build_all(
    spark: SparkSession,
    source: str | DataFrame,
    folder: str,
    patterns: Patterns | None = None,
    most_unreadable: float = 0.001,
    k: int = 5,
    horizon: int = 90,
    model: Model = fit_additive,
    holdout: int = 60,
) -> Build:
    """Build what is missing: star, then segments, then the forecast.

    ``source`` is the path of the raw CSV or the raw feed itself. Without ``patterns`` dates may
    have any form, and whether days or months come first is decided by the whole feed: one that
    holds both orders is refused, and the month comes first where nothing decides. A feed in
    which more than ``most_unreadable`` of the dates cannot be read is refused. Segments and forecast belong to the version of the star that
    they were built from, and are built again for another one. The model that forecasts is also
    scored. A failing forecast or score is reported and skipped, any other failure is raised.
    """
    log, cleaned, reports = [], None, {}
    files = SharedFolder(spark, folder)

    def rows(df: DataFrame) -> list[dict]:
        return [r.asDict() for r in df.collect()]

    snapshot = current(spark, folder)
    if all(name in snapshot.tables for name in TABLES):
        log.append("star: present")
    else:
        raw = read_raw_csv(spark, source) if isinstance(source, str) else source
        note = ""
        if patterns is None:
            decided = order_of(normalise_headers(raw), "InvoiceDate")
            patterns = decided or MONTH_FIRST
            note = f", dates {patterns.value}" + ("" if decided else " as nothing in the feed decides")
        cleaned = clean_report(raw, patterns).first().asDict()
        dated = cleaned["bad_date"] + cleaned["rows_after"]
        if cleaned["bad_date"] > most_unreadable * dated:
            raise ValueError(f"{cleaned['bad_date']} of {dated} dates are unreadable; pass the patterns of the feed")
        snapshot = write_star(stage(clean(raw, patterns), "clean"), folder)
        if cleaned["bad_date"]:
            note += f", {cleaned['bad_date']} of {dated} dates are unreadable"
        log.append(f"star: built from {cleaned['rows_after']} of {cleaned['rows_before']} rows{note}")
        reports["tables"] = rows(load_report(star_of(spark, snapshot)))
    star = star_of(spark, snapshot)

    def present(result: str) -> bool:
        return files.exists(f"{_BUILT}/{result}-{snapshot.number}")

    def built(result: str) -> None:
        files.claim(f"{_BUILT}/{result}-{snapshot.number}", "")
        log.append(f"{result}: built")

    if present("segments"):
        log.append("segments: present")
    else:
        segments = segment_customers(stage(rfm_base(star), "rfm"), k)
        replace_table(segments, f"{folder}/segments")
        segments = spark.read.parquet(f"{folder}/segments")
        write_csv(segments, f"{folder}/customer_segments.csv")
        reports["segment_sizes"], reports["segment_profile"] = rows(segment_sizes(segments)), rows(segment_profile(segments))
        built("segments")

    if present("forecast"):
        log.append("forecast: present")
    else:
        try:
            daily = stage(daily_revenue(star.fact), "daily")
            replace_table(forecast_table(daily, horizon, model=model), f"{folder}/forecast")
            forecast = spark.read.parquet(f"{folder}/forecast")
            write_csv(forecast, f"{folder}/forecast.csv")
            reports["total"] = rows(forecast_total(forecast))
            built("forecast")
        except PySparkException as failure:
            log.append(f"forecast: skipped ({str(failure)[-300:]})")
        else:
            try:
                reports["score"] = rows(holdout_score(daily, holdout, model=model))
            except PySparkException as failure:
                log.append(f"score: skipped ({str(failure)[-300:]})")
    return Build(log, cleaned, reports)
