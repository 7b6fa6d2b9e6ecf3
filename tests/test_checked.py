"""Strict scans of seeds and entities, and the rows that checked scans set aside."""

from __future__ import annotations

import json
from datetime import date

import pytest
from pyspark.sql import functions as F

from tarnhouse.sources import files as fs
from tarnhouse.sources.checked import first_lines, scan_csv_checked
from tarnhouse.sources.entity import scan_entity, scan_entity_checked

from .conftest import rows

SCHEMA = "id int, name string, day date, price decimal(9,2)"


def put(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text, encoding="utf-8")


def names_of(rejects):
    return rows(rejects.select("text", F.element_at(F.split("file", "/"), -1), "reason"))


@pytest.fixture()
def folder(tmp_path):
    put(tmp_path / "good.csv", 'id,name,day,price\n1,"a, ""b""",2024-01-01,1.50\n2,,,\n')
    put(tmp_path / "bad.csv", "id,name,day,price\nx,c,2024-01-02,1\n3,d,2024-13-01,one\n4,e\n5,f,2024-01-05,2,extra\n6,g,2024-01-06,3\n")
    put(tmp_path / "swapped.csv", "name,id,day,price\nh,7,2024-01-07,4\n8,i,2024-01-08,5\n")
    put(tmp_path / "Upper.csv", "ID,Name,DAY,Price\n9,j,2024-01-09,6\n")
    put(tmp_path / "short.csv", "id,name,day\n10,k,2024-01-10\n")
    put(tmp_path / "none.csv", "id,name,day,price\n")
    return str(tmp_path)


def test_rows_that_do_not_fit_are_set_aside(spark, folder):
    found = scan_csv_checked(spark, folder, SCHEMA)
    assert rows(found.rows.select("id", "name", "day")) == [
        (1, 'a, "b"', date(2024, 1, 1)), (2, None, None), (6, "g", date(2024, 1, 6)), (9, "j", date(2024, 1, 9)),
    ]
    assert names_of(found.rejects) == [
        ("10,k,2024-01-10", "short.csv", "header: id,name,day"),
        ("3,d,2024-13-01,one", "bad.csv", "day: 2024-13-01 is no date; price: one is no decimal(9,2)"),
        ("4,e", "bad.csv", "not 4 values"),
        ("5,f,2024-01-05,2,extra", "bad.csv", "not 4 values"),
        ("8,i,2024-01-08,5", "swapped.csv", "header: name,id,day,price"),
        ("h,7,2024-01-07,4", "swapped.csv", "header: name,id,day,price"),
        ("x,c,2024-01-02,1", "bad.csv", "id: x is no int"),
    ]


def test_no_row_is_lost_whatever_columns_are_asked_for(spark, folder):
    found = scan_csv_checked(spark, folder, SCHEMA)
    assert found.rows.count() == found.rows.select("id").count() == found.rows.select("name").count() == 4
    without_headers = scan_csv_checked(spark, f"{folder}/bad.csv", SCHEMA, header=False)
    assert (without_headers.rows.count(), without_headers.rejects.count()) == (1, 5)
    assert found.rows.agg(F.max("id")).first()[0] == 9
    assert found.rejects.count() == 7


def test_first_lines_of_files_read_in_pieces(spark, tmp_path):
    for k in range(3):
        put(tmp_path / f"{k}.csv", f"head{k},b\n" + "1,2\n" * 3000)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1kb")
    try:
        assert rows(first_lines(spark, str(tmp_path)).select("header")) == [("head0,b",), ("head1,b",), ("head2,b",)]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_seeds_are_strict(spark, tmp_path):
    put(tmp_path / "seed" / "a.csv", "full_moon_date\n2024-01-25\n")
    assert rows(fs.seed_dates(spark, str(tmp_path / "seed"))) == [(date(2024, 1, 25),)]
    put(tmp_path / "seed" / "b.csv", "full_moon_date\n25 January\n2024-02-24\n")
    with pytest.raises(Exception, match="MALFORMED|FAILED_READ_FILE"):
        fs.seed_dates(spark, str(tmp_path / "seed")).collect()
    found = scan_csv_checked(spark, str(tmp_path / "seed"), "full_moon_date date")
    assert rows(found.rows) == [(date(2024, 1, 25),), (date(2024, 2, 24),)]
    assert names_of(found.rejects) == [("25 January", "b.csv", "full_moon_date: 25 January is no date")]
    put(tmp_path / "other" / "a.csv", "new_moon_date\n2024-01-25\n")
    with pytest.raises(Exception, match="[Hh]eader"):
        fs.seed_dates(spark, str(tmp_path / "other")).collect()


def model(tmp_path, *folders):
    attributes = [{"name": "CustomerId", "dataType": "int64"}, {"name": "Born", "dataType": "date"}]
    partitions = [{"name": f, "location": str(tmp_path / f)} for f in folders]
    entity = {"name": "Customer", "attributes": attributes, "partitions": partitions}
    put(tmp_path / "model.json", json.dumps({"name": "Model", "entities": [entity]}))
    return str(tmp_path / "model.json")


def test_entities_are_strict(spark, tmp_path):
    put(tmp_path / "one" / "a.csv", "1,2001-02-03\n2,\n")
    put(tmp_path / "two" / "a.csv", "2003-01-01,3\n4,2004-05-06\n")
    assert rows(scan_entity(spark, model(tmp_path, "one"), "Customer")) == [(1, date(2001, 2, 3)), (2, None)]
    with pytest.raises(Exception, match="MALFORMED|FAILED_READ_FILE"):
        scan_entity(spark, model(tmp_path, "one", "two"), "Customer").collect()
    found = scan_entity_checked(spark, model(tmp_path, "one", "two"), "Customer")
    assert rows(found.rows.select("CustomerId")) == [(1,), (2,), (4,)]
    ((text, file, reason),) = names_of(found.rejects)
    assert (text, file) == ("2003-01-01,3", "a.csv") and "CustomerId: 2003-01-01 is no bigint" in reason


def test_entities_with_headers(spark, tmp_path):
    put(tmp_path / "one" / "a.csv", "CustomerId,Born\n1,2001-02-03\n")
    put(tmp_path / "two" / "b.csv", "Born,CustomerId\n2002-02-02,2\n")
    assert rows(scan_entity(spark, model(tmp_path, "one"), "Customer", header=True)) == [(1, date(2001, 2, 3))]
    with pytest.raises(Exception, match="[Hh]eader"):
        scan_entity(spark, model(tmp_path, "one", "two"), "Customer", header=True).collect()
    found = scan_entity_checked(spark, model(tmp_path, "one", "two"), "Customer", header=True)
    assert rows(found.rows) == [(1, date(2001, 2, 3))]
    assert names_of(found.rejects) == [("2002-02-02,2", "b.csv", "header: Born,CustomerId")]
