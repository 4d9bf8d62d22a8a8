"""Row checks and metrics of sales files."""

import pytest
from pyspark.sql import functions as F

from tallyfold import schemas as S
from tallyfold.operators import rollup as R, sales_metrics as SM, sales_quality as SQ

HEADER = S.SALES_HEADER
GOOD = "2024-01-05,Lamp,Home,10.5,2,10.0"


def lines(spark, files):
    rows = [(path, i, v) for path, values in files.items() for i, v in enumerate(values, start=1)]
    return spark.createDataFrame(rows, "path string, line bigint, value string")


def errors(spark, *values):
    checked = SQ.check_sales(lines(spark, {"a.csv": [HEADER, *values]}))
    return {r["line"] - 2: r["error"] for r in checked.where("line > 1").collect()}


CASES = {
    GOOD: None,
    GOOD + "\r": None,
    "+2024-01-05,Lamp,Home,1e1,+2,0": None,
    "2024-01-05,,,1,1,100": None,
    '2024-01-05,"Lamp",Home,1,1,0': None,
    '2024-01-05,Lamp 27",Home,1,1,0': None,
    '2024-01-05,Lamp,"Home, garden",1,1,0': None,
    "": S.ERR_COLUMNS,
    "2024-01-05,Lamp,Home,1,1": S.ERR_COLUMNS,
    "2024-01-05,Lamp,Home,1,1,0,": S.ERR_COLUMNS,
    '2024-01-05,"Lamp, big",Home,1,1,0': S.ERR_COLUMNS,
    "2024-1-5,Lamp,Home,x,x,x": S.ERR_DATE,
    "2024,Lamp,Home,1,1,0": S.ERR_DATE,
    "2024-02-30,Lamp,Home,1,1,0": S.ERR_DATE,
    " 2024-01-05,Lamp,Home,1,1,0": S.ERR_DATE,
    "2024-01-05,Lamp,Home, 1,1,0": S.ERR_PRICE,
    "2024-01-05,Lamp,Home,1.,1,0": S.ERR_PRICE,
    "2024-01-05,Lamp,Home,.5,1,0": S.ERR_PRICE,
    "2024-01-05,Lamp,Home,NaN,1,0": S.ERR_PRICE,
    "2024-01-05,Lamp,Home,1d,1,0": S.ERR_PRICE,
    "2024-01-05,Lamp,Home,,abc,0": S.ERR_PRICE,
    "2024-01-05,Lamp,Home,-1,abc,0": S.ERR_QUANTITY,
    "2024-01-05,Lamp,Home,1,1.0,0": S.ERR_QUANTITY,
    "2024-01-05,Lamp,Home,1,99999999999999999999,0": None,
    "2024-01-05,Lamp,Home,1,100000000000000000000000000000000000000,0": S.ERR_QUANTITY,
    "2024-01-05,Lamp,Home,-1,0,x": S.ERR_DISCOUNT,
    "2024-01-05,Lamp,Home,-1,0,200": S.ERR_PRICE_SIGN,
    "2024-01-05,Lamp,Home,0,1,0": S.ERR_PRICE_SIGN,
    "2024-01-05,Lamp,Home,1,0,200": S.ERR_QUANTITY_SIGN,
    "2024-01-05,Lamp,Home,1,1,100.01": S.ERR_DISCOUNT_RANGE,
    "2024-01-05,Lamp,Home,1,1,-0.1": S.ERR_DISCOUNT_RANGE,
    '2024-01-05,Lamp,Ho"me,1,1,0': S.ERR_QUOTE,
    '2024-01-05,La"mp': S.ERR_QUOTE,
}


def test_first_failing_check_names_the_error(spark):
    found = errors(spark, *CASES)
    assert [found[i] for i in range(len(CASES))] == list(CASES.values())


def test_quotes(spark):
    values = ['2024-01-05,"Lamp "big" 27"",Home,1,1,0', '2024-01-05,Lamp,"Ho""me, x",1,1,0', '2024-01-05,Lamp,"H","1","1","0"']
    rows = SQ.check_sales(lines(spark, {"a.csv": [HEADER, *values]})).where("line > 1").orderBy("line").collect()
    assert [(r["product"], r["category"]) for r in rows] == [
        ('Lamp "big" 27', "Home"), ("Lamp", 'Ho"me, x'), ("Lamp", "H")]


def test_header(spark):
    quoted = ",".join(f'"{c}"' for c in HEADER.split(","))
    files = {
        "ok.csv": [HEADER, GOOD], "quoted.csv": [quoted, GOOD], "crlf.csv": [HEADER + "\r", GOOD + "\r"],
        "bad.csv": ["a,b", GOOD], "again.csv": [HEADER, HEADER], "only.csv": [HEADER],
    }
    checked = SQ.check_sales(lines(spark, files))
    rejects = {r["path"]: (r["line"], r["error"]) for r in SQ.sales_rejects(lines(spark, files)).collect()}
    assert rejects == {"bad.csv": (1, S.ERR_HEADER), "again.csv": (2, S.ERR_DATE)}
    assert {r["path"] for r in SQ.valid_sales(lines(spark, files)).collect()} == {"ok.csv", "quoted.csv", "crlf.csv"}
    status = {r["path"]: r["status"] for r in R.file_status(R.line_counts(checked), "csv").collect()}
    assert status == {
        "ok.csv": "ok", "quoted.csv": "ok", "crlf.csv": "ok", "bad.csv": "failed", "again.csv": "failed",
        "only.csv": "ok",
    }


def test_stray_quote_fails_the_file(spark):
    given = lines(spark, {"a.csv": [HEADER, GOOD, '2024-01-05,Lamp,"Home,1,1,0', "x"]})
    checked = SQ.check_sales(given)
    assert SQ.valid_sales(given).count() == 0
    assert [(r["line"], r["error"]) for r in SQ.sales_rejects(given).collect()] == [(None, S.ERR_QUOTE)]
    row = SM.sales_metrics(SM.sales_cube(checked)).first()
    assert (row["total_sales"], row["unique_products"], row["top_product"], row["date_from"]) == (0.0, 0, None, None)


def test_metrics_and_ties(spark):
    files = {
        "a.csv": [
            HEADER, "2024-03-31,Pen,Office,2,3,50", "2024-04-01,Ink,Office,1,3,0", "2024-04-02,Cup,Home,3,1,0",
            "2024-04-02,Mat,Home,3,1,0", "bad",
        ],
        "b.csv": [HEADER, "2024-01-01,Pen,Home,1,1,0"],
        "c.csv": [HEADER, "2024-01-01,Cap,Wear,4,1,25", "2024-01-02,Pen,Wear,1,1,0"],
    }
    checked = SQ.check_sales(lines(spark, files))
    cube = SM.sales_cube(checked)
    rows = {r["path"]: r.asDict() for r in SM.sales_metrics(cube).collect()}
    a = rows["a.csv"]
    assert a["total_sales"] == pytest.approx(12.0)
    assert (a["unique_products"], a["top_product"], a["top_product_units"]) == (4, "Ink", 3)
    assert (a["top_category"], a["top_category_revenue"]) == ("Home", 6.0)
    assert a["avg_discount_pct"] == 12.5
    # Chronological over a month border.
    assert (str(a["date_from"]), str(a["date_to"])) == ("2024-03-31", "2024-04-02")
    assert (a["n_valid"], a["n_reject"]) == (4, 1)
    # The same values from the single metrics.
    for metric in (
        SM.total_sales, SM.unique_products, SM.top_product, SM.top_category, SM.average_discount, SM.date_range,
    ):
        for row in metric(checked).collect():
            for name, value in row.asDict().items():
                assert rows[row["path"]][name] == value
    # Only clean files count; products are distinct over their union.
    totals = R.sales_totals(cube).first()
    assert (totals["total_sales"], totals["unique_products"]) == (5.0, 2)


def test_no_valid_row(spark):
    checked = SQ.check_sales(lines(spark, {"a.csv": [HEADER, "x"]}))
    row = SM.sales_metrics(SM.sales_cube(checked)).first()
    assert (row["total_sales"], row["avg_discount_pct"], row["top_category"]) == (0.0, 0.0, None)
    assert R.sales_totals(SM.sales_cube(checked)).first().asDict() == {"total_sales": 0.0, "unique_products": 0}


def test_hot_file_matches_brute_force(spark):
    """A third of all lines in one file, half of them one product."""
    rows = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, "hot.csv").otherwise(F.concat(F.lit("f"), F.col("id") % 97)).alias("path"),
        (F.col("id") + 2).alias("line"),
        F.concat(
            F.lit("2024-01-01,"),
            F.when(F.col("id") % 2 == 0, "Pen").otherwise(F.concat(F.lit("p"), F.col("id") % 1009)),
            F.lit(",c,1,"), (F.col("id") % 5 + 1).cast("string"), F.lit(",0"),
        ).alias("value"),
    )
    got = {r["path"]: r for r in SM.sales_metrics(SM.sales_cube(SQ.check_sales(rows))).collect()}
    units: dict = {}
    for i in range(30_000):
        path = "hot.csv" if i % 3 == 0 else f"f{i % 97}"
        product = "Pen" if i % 2 == 0 else f"p{i % 1009}"
        units.setdefault(path, {}).setdefault(product, 0)
        units[path][product] += i % 5 + 1
    assert len(got) == len(units)
    for path, products in units.items():
        best = min(products, key=lambda p: (-products[p], p))
        row = got[path]
        assert (row["top_product"], row["top_product_units"]) == (best, products[best])
        assert row["unique_products"] == len(products)
        assert row["total_sales"] == sum(products.values())


def test_wide_quantities_do_not_end_the_run(spark):
    wide = "9" * 38
    files = {
        "hot.csv": [HEADER, f"2024-01-01,Pen,Office,1,{wide},0", f"2024-01-01,Pen,Office,1,{wide},0", "2024-01-01,Ink,Office,1,1,0"],
        "one.csv": [HEADER, f"2024-01-01,Pen,Office,0.5,{wide},0"],
    }
    checked = SQ.check_sales(lines(spark, files))
    rows = {r["path"]: r for r in SM.sales_metrics(SM.sales_cube(checked)).collect()}
    # A sum of more than 38 digits is the largest, but has no exact number.
    assert (rows["hot.csv"]["top_product"], rows["hot.csv"]["top_product_units"]) == ("Pen", None)
    assert rows["one.csv"]["top_product_units"] == int(wide)
    assert rows["hot.csv"]["total_sales"] == pytest.approx(2e38) and rows["one.csv"]["total_sales"] == pytest.approx(5e37)
    assert {r["path"]: r["top_product"] for r in SM.top_product(checked).collect()} == {"hot.csv": "Pen", "one.csv": "Pen"}


def test_sums_do_not_depend_on_the_order(spark):
    values = ["0.1,3,0", "1234567.89,7,12.5", "0.7,1,33.3", "99999.99,3,0", "0.05,1,99.9"] * 40
    rows = [f"2024-01-01,P{i % 3},C,{v}" for i, v in enumerate(values)]
    found = set()
    for n in (1, 3, 7):
        checked = SQ.check_sales(lines(spark, {"a.csv": [HEADER, *(rows if n < 7 else rows[::-1])]}).repartition(n))
        found.add(tuple(SM.sales_metrics(SM.sales_cube(checked)).select("total_sales", "top_category_revenue", "avg_discount_pct").first()))
        found.add((SM.total_sales(checked).first()["total_sales"], SM.top_category(checked).first()["top_category_revenue"],
                   SM.average_discount(checked).first()["avg_discount_pct"]))
    assert len(found) == 1
