"""The derived tables of one source folder, written once per application and reused.

As with any warehouse, the feed is cleaned and the star is built once and the reports
read the result. The tables lie in the staging folder, so they outlive executors.
"""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tillwise.operators.cleaning import clean
from tillwise.operators.star import Star
from tillwise.plans import forecast, guard, pipeline, reports, segments
from tillwise.sources import trade
from tillwise.sources.numbered import read_log
from tillwise.sources.staging import new_path, stage

_tables: dict[tuple, DataFrame | Star] = {}


class Warehouse:
    """Lazily written tables over one folder of order tables.

    ``version`` names the state of the folder: whoever changes the source passes another
    one and gets new tables. Nothing is listed to find that out.
    """

    def __init__(self, spark: SparkSession, folder: str, version: str = ""):
        self.spark = spark
        self.folder = folder
        self._key = (spark.sparkContext.applicationId, folder, version)

    def forget(self) -> None:
        """Drop the references to this folder's tables; the next use writes them anew."""
        for key in [key for key in _tables if key[:-1] == self._key]:
            del _tables[key]

    def _once(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        key = (*self._key, name)
        if key not in _tables:
            _tables[key] = stage(build(), name)
        return _tables[key]

    def raw(self) -> DataFrame:
        return trade.raw_sales(self.spark, self.folder)

    def clean(self) -> DataFrame:
        return self._once("clean", lambda: clean(self.raw()))

    def star(self) -> Star:
        """The star as the pipeline stores it, the fact by month."""
        key = (*self._key, "star")
        if key not in _tables:
            written = pipeline.commit_star(self.clean(), new_path(self.spark, "star"))
            _tables[key] = pipeline.star_of(self.spark, written)
        return _tables[key]

    def fact(self) -> DataFrame:
        return self.star().fact

    def customer_orders(self) -> DataFrame:
        return self._once("customer_orders", lambda: reports.customer_orders(self.star()))

    def rfm(self) -> DataFrame:
        return self._once("rfm", lambda: segments.rfm_base(self.star()))

    def segments(self) -> DataFrame:
        return self._once("segments", lambda: segments.segment_customers(self.rfm()))

    def daily_by_country(self) -> DataFrame:
        return self._once("daily_by_country", lambda: forecast.daily_revenue_by_country(self.star()))

    def query_history(self) -> DataFrame:
        """Audit log of all questions: the answered ones, then the failed ones."""
        key = (*self._key, "query_history")
        if key not in _tables:
            outcomes = self._once(
                "outcomes", lambda: guard.audit_outcomes(trade.attempts(self.spark, self.folder))
            )
            path = new_path(self.spark, "query_history")
            guard.create_history(self.spark, path)
            guard.append_history(outcomes.where("status <> 'error'"), path)
            guard.append_history(outcomes.where("status = 'error'"), path)
            _tables[key] = read_log(self.spark, path)
        return _tables[key]
