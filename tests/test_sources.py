from __future__ import annotations

import json
from datetime import date, datetime, timedelta
from decimal import Decimal
from functools import reduce

import pytest
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarnhouse.operators.filters import window_predicate
from tarnhouse.plans import entities as en
from tarnhouse.plans.silver import load_silver
from tarnhouse.plans.trips import trips_csv
from tarnhouse.sources import files as fs
from tarnhouse.sources.budget import join_path, scan_budget, unpivot_budget
from tarnhouse.sources.database import JdbcSource, ParquetSource, cut_points, scan_source_query, split_predicates
from tarnhouse.sources.entity import scan_entity
from tarnhouse.sources.lake import LakeTable

from .conftest import plan, rows


def put(path, text, encoding="utf-8"):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(text.encode(encoding))
    return str(path)


SHEET = """Budget \u20ac sheet,,,,
,,,,
,,,,
,,Forecast,Budget,Budget
,,2016,2016,2015
Category,Segment,Jan,Jan,Dec
Mix,All \u201cSeason\u201d,1.5,,3
Urban,Caf\u00e9,4,5,6.25
"""


def test_budget_sheet(spark, tmp_path):
    put(tmp_path / "b.csv", SHEET, "cp1252")
    raw = scan_budget(spark, str(tmp_path), "b.csv")
    assert raw.columns == ["Column1", "Column2", "Column3", "Column4", "Column5"]
    assert raw.count() == 8
    assert raw.head()[0] == "Budget \u20ac sheet"
    assert rows(unpivot_budget(spark, str(tmp_path), "b.csv")) == [
        ("Mix", "All \u201cSeason\u201d", "Budget", 2015, "Dec", 3.0),
        ("Mix", "All \u201cSeason\u201d", "Forecast", 2016, "Jan", 1.5),
        ("Urban", "Caf\u00e9", "Budget", 2015, "Dec", 6.25),
        ("Urban", "Caf\u00e9", "Budget", 2016, "Jan", 5.0),
        ("Urban", "Caf\u00e9", "Forecast", 2016, "Jan", 4.0),
    ]


def test_paths_take_the_separator_of_their_folder():
    assert join_path("http://host/a", "b") == "http://host/a/b"
    assert join_path("/lake/", "b") == "/lake/b"
    assert join_path("C:\\data", "b") == "C:\\data\\b"


PRODUCTS = """\ufeffProductId,ProductCode,Title,Description,ProductCategory,UnitCost,ListPrice,Color,MinimumAge,MaximumAge,ProductImageUrl
1,P1,Boat,"Fast, red.",Toys > Boats,12.5,32.95,"Red,White",21,,u1
2,P2,Kite,Flies.,Toys,13.5,"1,024.50",Blue,,12,u2
"""


def test_product_entity(spark, tmp_path):
    path = put(tmp_path / "p.csv", PRODUCTS)
    got = en.entity_product(fs.scan_csv_entity(spark, path))
    assert got.columns == [
        "ProductId", "ProductCode", "Product", "Description", "Category", "SubCategory",
        "UnitCost", "ListPrice", "Color", "MinimumAge", "MaximumAge", "ProductImageUrl",
    ]
    assert rows(got) == [
        (1, "P1", "Boat", "Fast, red.", "Toys", "Boats", 12, 33, "Red,White", 21, None, "u1"),
        (2, "P2", "Kite", "Flies.", "Toys", None, 14, 1024, "Blue", None, 12, "u2"),
    ]


def test_customer_and_sales_entities(spark):
    names = (
        "CustomerId FirstName LastName Company EmailAddress WorkPhone HomePhone Address City State "
        "Zipcode Gender BirthDate FirstPurchaseDate LastPurchaseDate"
    ).split()
    raw = spark.createDataFrame(
        [("7", "Ann", None, "c", "e", "w", "h", "1 Road", "Bari", "BA", "70100", "F", "1/31/1980 12:00:00 AM", "x", "y")],
        ", ".join(f"{n} string" for n in names),
    )
    assert rows(en.entity_customer(raw)) == [
        (7, "Ann", "1 Road", "Bari", "BA", 70100, "Female", date(1980, 1, 31), "x", "y")
    ]
    sales = spark.createDataFrame(
        [("1", "2", "30", "4", "5", "12/31/2020")],
        "Id string, Quantity string, SalesAmount string, InvoiceId string, ProductId string, InvoiceDate string",
    )
    assert rows(en.entity_sales(sales)) == [(1, 2, 30, 4, 5, "31/12/2020")]


def test_entity_model(spark, tmp_path):
    put(tmp_path / "data" / "a.csv", "2024-01-01,2024,Q1\n")
    put(tmp_path / "data" / "b.csv", "2024-04-01,2024,Q2\n")
    model = {
        "name": "m",
        "entities": [
            {
                "name": "Calendario",
                "attributes": [
                    {"name": "Date", "dataType": "date"},
                    {"name": "Year", "dataType": "int64"},
                    {"name": "Quarter", "dataType": "string"},
                ],
                "partitions": [{"location": str(tmp_path / "data" / f)} for f in ("a.csv", "b.csv")],
            }
        ],
    }
    path = put(tmp_path / "model.json", "\ufeff" + json.dumps(model, indent=1))
    df = scan_entity(spark, path, "Calendario")
    assert df.schema.simpleString() == "struct<Date:date,Year:bigint,Quarter:string>"
    assert rows(df) == [(date(2024, 1, 1), 2024, "Q1"), (date(2024, 4, 1), 2024, "Q2")]


def test_seed_dates(spark, tmp_path):
    path = put(tmp_path / "seed.csv", "full_moon_date\n2009-01-11\n2009-02-09\n")
    assert rows(fs.seed_dates(spark, path)) == [(date(2009, 1, 11),), (date(2009, 2, 9),)]


def test_typed_csv_view(spark, tmp_path):
    head = ",".join(f.split()[0] for f in fs.TRIP_SCHEMA.replace("(10,2)", "").split(", "))
    path = put(
        tmp_path / "t.csv",
        head + "\n1,2020-01-01 23:59:59,2020-01-02 00:10:00,2,1.5,1,N,1,2,1,5,0,0,0,0,0,7.85,0\n",
    )
    assert rows(trips_csv(spark, path)) == [
        (1, date(2020, 1, 1), date(2020, 1, 2), 2, Decimal("7.85"))
    ]


def test_silver_tables_are_text_and_globs_are_one_table(spark, tmp_path):
    put(tmp_path / "Colors.csv", "ColorID|ColorName\n1|Red\n2|\n")
    put(tmp_path / "SalesOrder" / "2013" / "a.csv", "OrderID|OrderDate\n1|2013-01-01\n")
    put(tmp_path / "SalesOrder" / "2014" / "b.csv", "OrderID|OrderDate\n2|2014-01-01\n3|2014-01-02\n")
    root = str(tmp_path / "silver")
    assert load_silver(spark, str(tmp_path), root, ["silver_Colors", "silver_SalesOrder"]) == {
        "silver_Colors": 2,
        "silver_SalesOrder": 3,
    }
    colors = LakeTable(spark, f"{root}/silver_Colors").read()
    assert {f.dataType.simpleString() for f in colors.schema} == {"string"}
    assert rows(colors) == [("1", "Red"), ("2", None)]


def test_jdbc_options():
    source = JdbcSource("jdbc:x:y", {"user": "reader"}, partitions=8)
    opts = source.options("Sales", "Orders", ("LastEditedWhen", date(2013, 1, 1), date(2013, 1, 8)))
    assert opts["dbtable"] == "Sales.Orders" and opts["user"] == "reader"
    assert (opts["partitionColumn"], opts["lowerBound"], opts["upperBound"]) == (
        "LastEditedWhen", "2013-01-01", "2013-01-08",
    )
    assert opts["numPartitions"] == "8" and opts["pushDownPredicate"] == "true"
    assert "partitionColumn" not in source.options("Sales", "Orders")


class Noted(JdbcSource):
    """A database of one table that notes what it is asked."""

    def __init__(self, rows, partitions=5):
        super().__init__("jdbc:none", partitions=partitions)
        object.__setattr__(self, "rows", rows)
        object.__setattr__(self, "asked", [])

    def load(self, spark, schema, table, predicates):
        self.asked.append(list(predicates))
        parts = [self.rows.filter(p) for p in predicates]
        return reduce(DataFrame.unionAll, parts)

    def query(self, spark, sql):
        self.asked.append(sql)
        self.rows.createOrReplaceTempView("noted")
        return spark.sql(sql.replace("s.t", "noted"))


@pytest.fixture(scope="module")
def source_rows(spark):
    times = [None, *[datetime(2013, 1, 1) + timedelta(hours=7 * k, microseconds=k) for k in range(60)]]
    data = [(None if k % 9 == 4 else k * k - 50, t, f"n{k}", Decimal(k) / 4) for k, t in enumerate(times * 2)]
    return spark.createDataFrame(data, "id long, at timestamp_ntz, name string, price decimal(9,2)")


@pytest.mark.parametrize("key", ["id", "price", "name", None])
@pytest.mark.parametrize("mark", ["at", None])
@pytest.mark.parametrize("window", [(date(2013, 1, 2), date(2013, 1, 8)), (date(2013, 1, 3), None), (None, date(2013, 1, 5)), (None, None)])
def test_a_source_is_read_in_parts_that_hold_each_row_once(spark, source_rows, key, mark, window):
    source = Noted(source_rows)
    start, end = window if mark else (None, None)
    df = scan_source_query(spark, source, "s", "t", mark, start, end, key)
    want = source_rows.filter(window_predicate(source_rows, mark, start, end)) if mark else source_rows
    assert rows(df) == rows(want)
    predicates = source.asked[-1]
    splits = mark or key in ("id", "price")
    assert len(predicates) == (5 if splits else 1)
    if not mark or not (start and end):  # what the window leaves open is looked up
        assert len(source.asked) > 1 or not (mark or key)
    # Whatever the window, no row of the table meets two of them.
    assert sum(source_rows.filter(p).count() for p in predicates) == source_rows.count()


def test_windows_bound_what_is_looked_up(spark, source_rows):
    source = Noted(source_rows)
    source.predicates(spark, "s", "t", "at", date(2013, 1, 3), None, "id")
    assert source.asked == ["SELECT MIN(id) AS low, MAX(id) AS high FROM s.t WHERE at >= '2013-01-03'"]
    source.predicates(spark, "s", "t", "at", datetime(2013, 1, 3), date(2013, 1, 9), "id")
    assert len(source.asked) == 1  # a closed window needs no look


def test_cut_points():
    assert cut_points(0, 100, 4) == [25, 50, 75]
    assert cut_points(1, 3, 10) == [2] and cut_points(1, 4, 3) == [2, 3] and cut_points(5, 5, 10) == []
    assert cut_points(date(2024, 1, 1), date(2024, 1, 3), 4) == [date(2024, 1, 2)]
    assert cut_points(datetime(2024, 1, 1), datetime(2024, 1, 2), 2) == [datetime(2024, 1, 1, 12)]
    assert cut_points(Decimal("-0.5"), Decimal("1.5"), 3) == [0, 1]
    assert split_predicates("k", []) == ["1 = 1"]
    assert split_predicates("k", [3]) == ["k < 3 OR k IS NULL", "k >= 3"]
    assert split_predicates("c", ["it's"])[1] == "c >= 'it''s'"


def test_the_reader_gets_the_predicates():
    calls = []

    class Reader:
        def jdbc(self, url, table, **rest):
            calls.append((url, table, rest))

    class Session:
        read = Reader()

    source = JdbcSource("jdbc:x:y", {"user": "reader"}, partitions=2)
    source.read(Session(), "Sales", "Orders", "LastEditedWhen", date(2013, 1, 1), date(2013, 1, 8), "OrderID")
    ((url, table, rest),) = calls
    assert (url, table) == ("jdbc:x:y", "Sales.Orders")
    assert rest["predicates"] == [
        "LastEditedWhen < '2013-01-04 12:00:00' OR LastEditedWhen IS NULL", "LastEditedWhen >= '2013-01-04 12:00:00'"
    ]
    assert rest["properties"]["user"] == "reader" and rest["properties"]["pushDownPredicate"] == "true"


def test_an_empty_source(spark, source_rows):
    none = source_rows.filter("false")
    for mark, key in (("at", "id"), (None, "id"), ("at", None), (None, None)):
        assert scan_source_query(spark, Noted(none), "s", "t", mark, None, None, key).collect() == []


def test_source_window_reaches_the_scan(spark, sf):
    source = ParquetSource(lambda schema, name: f"{sf}/{name}.parquet")
    df = scan_source_query(spark, source, "Sales", "orders", "o_orderdate", date(1996, 1, 1), datetime(1997, 1, 1, 12))
    text = plan(df)
    assert "GreaterThanOrEqual(o_orderdate,1996-01-01T00:00)" in text
    assert "LessThan(o_orderdate,1997-01-01T12:00)" in text


def test_reload_touches_only_its_partition(spark, tmp_path):
    path = str(tmp_path / "fact")
    df = spark.createDataFrame([(1, 2006), (2, 2007), (3, 2007), (4, 2008)], "v int, y int")
    fs.write_partitioned(df, path, "y")
    fs.reload_partition(spark.createDataFrame([(9, 2007)], "v int, y int"), path, "y")
    assert rows(spark.read.parquet(path)) == [(1, 2006), (4, 2008), (9, 2007)]


def test_exports_hold_the_same_rows(spark, tmp_path):
    df = spark.createDataFrame(
        [(1, datetime(2024, 1, 1, 2, 3, 4, 5), 'a "b", c', None)], "i int, t timestamp_ntz, s string, n string"
    )
    fs.export_csv(df, str(tmp_path / "c"))
    fs.export_parquet(df, str(tmp_path / "p"))
    assert rows(fs.scan_csv_typed(spark, str(tmp_path / "c"), df.schema)) == rows(df)
    assert rows(fs.scan_parquet(spark, str(tmp_path / "p"))) == rows(df)
    assert list((tmp_path / "p").glob("*.snappy.parquet"))


def test_drop_tables(spark, tmp_path):
    fs.ctas(spark.range(3), "t_keep", str(tmp_path / "a"))
    fs.ctas(spark.range(3), "t_drop", str(tmp_path / "b"))
    fs.drop_tables(spark, ["t_drop", "t_never"])
    assert spark.catalog.tableExists("t_keep") and not spark.catalog.tableExists("t_drop")
    assert fs.ctas(spark.table("t_keep").select((F.col("id") + 1).alias("id")), "t_next", str(tmp_path / "c")).count() == 3


def test_views_are_replaced(spark):
    fs.define_view(spark.range(2), "v")
    assert fs.define_view(spark.range(5), "v").count() == 5


def test_scratch_needs_a_shared_folder_on_a_cluster(monkeypatch):
    from tarnhouse import session

    class Conf:
        def __init__(self, values):
            self.values = values

        def get(self, key, default=None):
            return self.values.get(key, default)

    class Session:
        def __init__(self, **values):
            self.conf = Conf({k.replace("_", "."): v for k, v in values.items()})

    shared = Session(spark_checkpoint_dir="hdfs://shared/x/", spark_master="yarn")
    assert session.scratch_root(shared) == "hdfs://shared/x"
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.scratch_root(Session(spark_master="yarn"))


def written(tmp_path, name, text):
    path = tmp_path / name
    path.write_bytes(text.encode())
    return str(path)


def test_doubled_quotes_in_csv(spark, tmp_path):
    path = written(tmp_path, "q.csv", 'id,title,code\n1,"Say ""hi"", ok",X\n2,"a\\",Y\n')
    want = [(1, 'Say "hi", ok', "X"), (2, "a\\", "Y")]
    assert rows(fs.scan_csv_typed(spark, path, "id int, title string, code string")) == want
    as_text = [(str(i), t, c) for i, t, c in want]
    assert rows(fs.scan_csv_text(spark, path, ",")) == rows(fs.scan_csv_entity(spark, path)) == as_text
    out = str(tmp_path / "out")
    fs.export_csv(spark.createDataFrame(want[:1], "id int, title string, code string").coalesce(1), out)
    (part,) = (tmp_path / "out").glob("part-*.csv")
    assert part.read_text() == 'id,title,code\n1,"Say ""hi"", ok",X\n'


def test_csv_headers_and_values_are_checked(spark, tmp_path):
    swapped = written(tmp_path, "s.csv", "b,a\n1,2\n")
    with pytest.raises(Exception, match="header"):
        fs.scan_csv_typed(spark, swapped, "a int, b int").collect()
    bad = written(tmp_path, "b.csv", "a,b\n1,nope\n")
    with pytest.raises(Exception, match="nope|MALFORMED|malformed"):
        fs.scan_csv_typed(spark, bad, "a int, b int").collect()
    assert rows(fs.scan_csv_typed(spark, bad, "a int, b int", mode="PERMISSIVE")) == [(1, None)]
    folder = tmp_path / "many"
    folder.mkdir()
    written(folder, "1.csv", "a|b\nx|y\n")
    written(folder, "2.csv", "b|a\nx|y\n")
    with pytest.raises(Exception, match="header"):
        fs.scan_csv_text(spark, str(folder / "*.csv")).collect()
