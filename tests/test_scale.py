import re

from frames import raw, raw_row
from pyspark.sql import functions as F

from tillwise.operators import cleaning, joins
from tillwise.warehouse import Warehouse


def test_duplicates_meet_where_the_parts_joined(spark, small, settings, monkeypatch):
    """Dropping duplicates shuffles the feed no second time after its last join."""
    settings(autoBroadcastJoinThreshold=-1, adaptive__autoBroadcastJoinThreshold=-1)
    monkeypatch.setattr(joins, "BROADCAST_ROWS", 0)
    plan = cleaning.clean(Warehouse(spark, small).raw())._jdf.queryExecution().executedPlan().toString()
    above = plan[plan.index("HashAggregate") : plan.index("SortMergeJoin [StockCode")]
    assert "Exchange" not in above


def test_dates_are_read_in_generated_code(spark):
    """No list function around the date, which would keep its expression out of generated code."""
    rows = [raw_row(when=t) for t in ("1/2/2020 8:26", "31/1/2020 8:26", "2020-01-03", "1/2/0000 8:26", "no date", None)]
    cleaned = cleaning.clean(raw(spark, *rows))
    plan = cleaned._jdf.queryExecution().executedPlan().toString()
    assert not re.search(r"filter\(array|array_compact", plan)
    found = cleaned.select(F.col("InvoiceDate").cast("string")).collect()
    assert sorted(r[0] for r in found) == ["2020-01-02 08:26:00", "2020-01-03 00:00:00"]
