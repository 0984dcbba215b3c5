import os

from tessera.session import scratch_path
from tessera.sources import landing
from tessera.sources.testdata import TestData
from tessera.streaming import ingest_feed, read_ingested
from tessera.types import POS_ORDERS_SCHEMA, WEB_ORDER_DDL

SF = "/root/testdata/sf0.001"


def test_availablenow_ingest_is_incremental(spark):
    t = TestData(spark, SF)
    root = scratch_path(spark, "test/stream")
    orders, web = t.pos_orders(), t.web_orders()
    n_orders, n_web = orders.count(), web.count()
    landing.write_json_lines(orders, os.path.join(root, "landing/pos/orders/2026-07-01"))
    landing.write_json_array_pages(web, os.path.join(root, "landing/web/orders/2026-07-01"))
    kw = dict(bronze_path=os.path.join(root, "bronze/pos_orders"), checkpoint=os.path.join(root, "ckpt/pos"))
    first = ingest_feed(spark, os.path.join(root, "landing/pos/orders"), "json_lines", POS_ORDERS_SCHEMA, **kw)
    assert first == {"rows": n_orders, "malformed_pages": 0}
    again = ingest_feed(spark, os.path.join(root, "landing/pos/orders"), "json_lines", POS_ORDERS_SCHEMA, **kw)
    assert again == {"rows": 0, "malformed_pages": 0}                                   # nothing new: nothing re-read
    landing.write_json_lines(orders, os.path.join(root, "landing/pos/orders/2026-07-02"))
    assert ingest_feed(spark, os.path.join(root, "landing/pos/orders"), "json_lines",
                       POS_ORDERS_SCHEMA, **kw)["rows"] == n_orders
    bronze = read_ingested(spark, kw["bronze_path"], POS_ORDERS_SCHEMA)
    assert bronze.count() == 2 * n_orders
    assert bronze.schema == POS_ORDERS_SCHEMA or [f.name for f in bronze.schema] == POS_ORDERS_SCHEMA.names
    w = ingest_feed(spark, os.path.join(root, "landing/web/orders"), "json_array", WEB_ORDER_DDL,
                    bronze_path=os.path.join(root, "bronze/web_orders"),
                    checkpoint=os.path.join(root, "ckpt/web"))
    assert w == {"rows": n_web, "malformed_pages": 0}


def test_malformed_pages_are_counted_and_batches_are_many(spark):
    root = scratch_path(spark, "test/stream")
    for day in range(4):
        os.makedirs(os.path.join(root, f"web/{day}"))
        with open(os.path.join(root, f"web/{day}/p.json"), "w") as f:
            f.write('[{"web_order_id":"W%d","email":"a","placed_at":"t","status":"s","lines":[]}]\n[{"broken\n[]\n' % day)
    got = ingest_feed(spark, os.path.join(root, "web"), "json_array", WEB_ORDER_DDL, os.path.join(root, "bronze"),
                      os.path.join(root, "ckpt"), files_per_batch=1)
    assert got == {"rows": 4, "malformed_pages": 4}
    rows = read_ingested(spark, os.path.join(root, "bronze"), WEB_ORDER_DDL).collect()
    assert sorted(r.web_order_id for r in rows) == ["W0", "W1", "W2", "W3"]
