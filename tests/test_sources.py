import os

import pytest

from tessera.session import scratch_path
from tessera.sources import landing
from tessera.sources.testdata import TestData
from tessera.types import WEB_ORDER_DDL


def test_csv_keeps_spaces_and_nulls(spark):
    df = spark.createDataFrame([("C1", " User1@Example.COM "), ("C2", None)], "id string, email string")
    path = scratch_path(spark, "test/csv")
    landing.write_csv(df, path)
    back = landing.read_csv(spark, path)
    assert sorted(back.collect()) == sorted(df.collect())
    assert back.schema.simpleString() == "struct<id:string,email:string>"


def test_json_array_pages_and_malformed(spark):
    path = scratch_path(spark, "test/json_array")
    os.makedirs(path)
    with open(os.path.join(path, "p.json"), "w") as f:
        f.write('[{"web_order_id":"W1","email":"a@x","placed_at":"t","status":"s",'
                '"lines":[{"line_no":1,"product_id":"P","quantity":2,"unit_price":1.5}]},'
                '{"web_order_id":"W2","email":"b@x","placed_at":"t","status":"s","lines":[]}]\n')
        f.write('[{"web_order_id": broken\n')
        f.write('[{"web_order_id":"W3","email":"c@x","placed_at":"t","status":"s","lines":null}]\n')
    rows = landing.read_json_array(spark, path, WEB_ORDER_DDL)
    assert sorted(r.web_order_id for r in rows.collect()) == ["W1", "W2", "W3"]
    assert landing.malformed_pages(spark, path, WEB_ORDER_DDL).first().value == 1


def test_csv_with_declared_schema_checks_the_header(spark):
    df = spark.createDataFrame([("C1", "a")], "id string, email string")
    path = scratch_path(spark, "test/csv")
    landing.write_csv(df, path)
    assert landing.read_csv(spark, path, "id string, email string").collect() == df.collect()
    with pytest.raises(Exception, match="(?i)header"):
        landing.read_csv(spark, path, "email string, id string").collect()


def test_largest_basket_holds_several_lines(spark):
    """Every order is one document, its lines in line order."""
    t = TestData(spark, "/root/testdata/sf0.001")
    orders = t.web_orders().collect()
    assert len({o.web_order_id for o in orders}) == len(orders)
    assert max(len(o.lines) for o in orders) > 1
    assert all([l.line_no for l in o.lines] == sorted(l.line_no for l in o.lines) for o in orders)


def test_json_array_writer_round_trip(spark):
    df = spark.range(1234).selectExpr("CAST(id AS string) AS web_order_id", "'e' AS email",
                                      "'t' AS placed_at", "'s' AS status",
                                      "array(named_struct('line_no', 1, 'product_id', 'P', 'quantity', 2, "
                                      "'unit_price', CAST(1.25 AS decimal(19,4)))) AS lines")
    path = scratch_path(spark, "test/json_pages")
    landing.write_json_array_pages(df.repartition(3), path, page_rows=100)
    back = landing.read_json_array(spark, path, WEB_ORDER_DDL)
    assert back.count() == 1234
    pages = spark.read.text(path)
    assert pages.count() >= 13                       # at most 100 records per page
    assert back.agg({"lines": "count"}).collect()[0][0] == 1234
