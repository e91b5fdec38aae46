from datetime import date

from frames import fact, raw, raw_row, star

from tillwise.operators.cleaning import clean
from tillwise.operators.quality import foreign_key_check, primary_key_check
from tillwise.operators.star import build_star, dim_customer, dim_date, dim_product, number_lines


def test_modal_country_smallest_on_ties(spark):
    table = clean(raw(
        spark,
        raw_row(customer=1.0, country="B", stock="1"), raw_row(customer=1.0, country="A", stock="2"),
        raw_row(customer=2.0, country="A", stock="1"), raw_row(customer=2.0, country="B", stock="2"),
        raw_row(customer=2.0, country="B", stock="3"),
        raw_row(customer=3.0, country=None, stock="1"), raw_row(customer=3.0, country=None, stock="2"),
        raw_row(customer=3.0, country="Z", stock="3"),
        raw_row(customer=4.0, country=None),
    ))
    assert {r.customer_id: r.country for r in dim_customer(table).collect()} == {1: "A", 2: "B", 3: "Z", 4: None}


def test_product_description_and_mean_price_over_lines(spark):
    table = clean(raw(
        spark,
        raw_row(stock="A", text="x", price=1.0, quantity=100), raw_row(stock="A", text="y", price=2.0),
        raw_row(stock="A", text="y", price=6.0),
        raw_row(stock="B", text=None, price=5.0), raw_row(stock=None, text="lost"),
    ))
    rows = {r.stock_code: (r.description, r.unit_price_avg) for r in dim_product(table).collect()}
    assert rows == {"A": ("y", 3.0), "B": (None, 5.0)}
    assert build_star(table).fact.where("stock_code IS NULL").count() == 1


def test_date_attributes(spark):
    table = clean(raw(spark, raw_row(when="12/05/2010 23:59"), raw_row(when="12/05/2010 00:01"),
                      raw_row(when="04/01/2011 12:00")))
    rows = {r.date_key: tuple(r)[1:] for r in dim_date(table).collect()}
    assert rows == {
        date(2010, 12, 5): (2010, 12, "December", 4, "Sunday", 1),
        date(2011, 4, 1): (2011, 4, "April", 2, "Friday", 0),
    }


def test_line_numbers_run_in_time_order(spark):
    table = fact(spark, *[(str(i), "A", 1, f"2020-01-{1 + i % 28:02d}", 1, 1.0) for i in range(100)])
    rows = number_lines(table).orderBy("line_id").collect()
    assert [r.line_id for r in rows] == list(range(1, 101))
    assert [r.date_key for r in rows] == sorted(r.date_key for r in rows)


def test_key_checks_find_faults(spark):
    s = star(spark, ("1", "A", 1, "2020-01-01", 1, 1.0), ("1", "A", 1, "2020-01-01", 1, 1.0),
             ("2", "B", 2, "2020-01-02", 1, 1.0))
    broken = s.__class__(s.fact, s.customers.where("customer_id = 2"), s.products.union(s.products), s.dates)
    lost = {r.table_name: (r.orphan_keys, r.orphan_rows) for r in foreign_key_check(broken).collect()}
    assert lost == {"dim_customer": (1, 2), "dim_product": (0, 0), "dim_date": (0, 0)}
    tables = {**broken.tables(), "fact_sales": number_lines(s.fact)}
    held = {r.table_name: (r.row_count, r.repeated_keys) for r in primary_key_check(tables).collect()}
    assert held == {"fact_sales": (3, 0), "dim_customer": (1, 0), "dim_product": (4, 2), "dim_date": (2, 0)}
