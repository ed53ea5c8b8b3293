import datetime as dt

import pytest
from pyspark.sql import functions as F

from strata.plans import incremental, stored_fact
from strata.plans.incremental import IncrementalLayers
from strata.session import scratch_path

AT = [dt.datetime(2020, 1, d) for d in range(1, 9)]
ORDER = "orderID string, customerID string, employeeID string, orderDate string, requiredDate string, shippedDate string, shipperID string, freight string"
LINE = "orderID string, productID string, unitPrice string, quantity string, discount string"
CUSTOMER = "customerID string, companyName string, contactName string, contactTitle string, city string, country string"


def _raws(spark, at, orders=(), lines=()):
    stamp = F.lit(at).cast("timestamp")
    return {"orders": spark.createDataFrame([(str(o), "C1", "1", day, day, None, "1", freight) for o, day, freight in orders], ORDER)
            .withColumn("ingestion_timestamp", stamp),
            "order_details": spark.createDataFrame([(str(o), str(p), "2.00", str(q), "0") for o, p, q in lines], LINE)
            .withColumn("ingestion_timestamp", stamp)}


def _fact(layers):
    return sorted((r.orderid, r.product_id, r.order_quantity, str(r.freight), r._is_deleted) for r in layers.read_fact().collect())


def _ids(spark, *orders):
    return {"orders": spark.createDataFrame([(o,) for o in orders], "orderid long")}


def test_lines_wait_for_headers_and_changes_reach_the_fact(spark):
    layers = IncrementalLayers(spark, scratch_path(spark, "inc"), {}, n_buckets=4)
    layers.apply(0, AT[0], _raws(spark, AT[0], [(1, "2020-01-05", "1")], [(1, 1, 5), (2, 1, 7), (2, 2, 8)]))
    assert _fact(layers) == [(1, 1, 5, "1.00", False)]
    # a header for waiting lines, a new quantity, a repeat of what is there
    layers.apply(1, AT[1], _raws(spark, AT[1], [(2, "2020-02-05", "2")], [(1, 1, 6)]))
    assert _fact(layers) == [(1, 1, 6, "1.00", False), (2, 1, 7, "2.00", False), (2, 2, 8, "2.00", False)]
    changes = {(r.orderid, r._change) for r in layers.sales.changes("order_details").collect()}
    assert changes == {(1, "update")}
    # a delete, and the same batch again
    for _ in range(2):
        layers.apply(2, AT[2], _raws(spark, AT[2]), _ids(spark, 2, 77))
    assert _fact(layers)[1:] == [(2, 1, 7, "2.00", True), (2, 2, 8, "2.00", True)]
    assert [r.orderid for r in layers.sales.read("orders").collect()] == [1]
    # sent again, with another freight, it is back
    layers.apply(3, AT[3], _raws(spark, AT[3], [(2, "2020-03-05", "3")]))
    assert _fact(layers)[1:] == [(2, 1, 7, "3.00", False), (2, 2, 8, "3.00", False)]


def test_a_batch_that_stopped_behind_its_change_set_is_ended_by_the_next(spark, monkeypatch):
    path = scratch_path(spark, "inc")
    open_ = lambda: IncrementalLayers(spark, path, {}, n_buckets=4)
    open_().apply(0, AT[0], _raws(spark, AT[0], [(1, "2020-01-05", "1")], [(1, 1, 5)]))

    def stop(*_):
        raise OSError("stopped before the fact")

    with monkeypatch.context() as m:
        m.setattr(stored_fact, "upsert", stop)
        with pytest.raises(OSError):
            open_().apply(1, AT[1], _raws(spark, AT[1], [], [(1, 2, 9)]))
    assert len(_fact(open_())) == 1
    # the batch after it does not lose the lagging changes
    open_().apply(2, AT[2], _raws(spark, AT[2], [], [(1, 3, 4)]))
    assert [r[:3] for r in _fact(open_())] == [(1, 1, 5), (1, 2, 9), (1, 3, 4)]


def test_a_small_batch_reads_and_writes_its_buckets_and_months_only(spark):
    layers = IncrementalLayers(spark, scratch_path(spark, "inc"), {}, n_buckets=8)
    layers.apply(0, AT[0], _raws(spark, AT[0], [(o, f"2020-{o % 9 + 1:02d}-05", "1") for o in range(40)], [(o, 1, 5) for o in range(40)]))
    clean = dict(layers.sales.store.manifest()["tables"]["order_details"])
    fact = dict(layers.fact.manifest()["tables"]["fact_sales"])
    layers.apply(1, AT[1], _raws(spark, AT[1], [], [(3, 1, 6)]))
    changed = [b for b, c in layers.sales.store.manifest()["tables"]["order_details"].items() if clean.get(b) != c]
    assert changed == [str(b) for b in layers.sales.store.touched(spark.createDataFrame([(3,)], "orderid long"))]
    assert [b for b, c in layers.fact.manifest()["tables"]["fact_sales"].items() if fact.get(b) != c] == ["202004"]
    files = layers.sales.read("orders", [int(changed[0])]).inputFiles()
    assert files and all(f"_bucket={changed[0]}/" in f for f in files)


def test_history_takes_change_sets(spark):
    layers = IncrementalLayers(spark, scratch_path(spark, "inc"), {"customers": ["contacttitle"]}, n_buckets=4)

    def send(n, rows, gone=()):
        raw = spark.createDataFrame([(k, "N", "c", t, "x", "y") for k, t in rows], CUSTOMER)
        layers.apply(n, AT[n], {"customers": raw.withColumn("ingestion_timestamp", F.lit(AT[n]).cast("timestamp"))},
                     {"customers": spark.createDataFrame([(k,) for k in gone], "customerid string")})

    send(0, [("A", "one"), ("B", "one"), (None, "one")])
    send(1, [("A", "two"), ("B", "one")])
    send(2, [], ["B", "Z"])
    send(3, [])
    got = sorted(((r.customerid, r.contacttitle, r._effective_date.day, r._end_date and r._end_date.day)
                  for r in layers.read_history("customers").collect()), key=repr)
    assert got == sorted([("A", "one", 1, 2), ("A", "two", 2, None), ("B", "one", 1, 3), (None, "one", 1, None)], key=repr)
    assert incremental.CleanStore(spark, f"{layers.path}/customers", ["customers"], ["customerid"]).last_batch() == 3


def test_a_batch_stages_nothing_for_good_and_old_versions_can_go(spark, monkeypatch):
    from pathlib import Path

    from strata.session import shared_dir
    held = lambda: {p.name for p in Path(shared_dir(spark)).glob("strata/staged-*")}
    before, copies, frame = held(), [], type(spark.range(1))
    checkpoint = frame.checkpoint
    monkeypatch.setattr(frame, "checkpoint", lambda self, *a, **k: copies.append(1) or checkpoint(self, *a, **k))
    layers = IncrementalLayers(spark, scratch_path(spark, "inc"), {}, n_buckets=2)
    layers.apply(0, AT[2], _raws(spark, AT[2], [(1, "2020-01-05", "1"), (2, "2020-01-06", "1")], [(1, 1, 5), (2, 1, 5)]))
    # an older line loses, a deleted order stays away though the batch sends it
    layers.apply(1, AT[1], _raws(spark, AT[1], [(2, "2020-01-07", "4")], [(1, 1, 9), (1, 2, 3)]), _ids(spark, 2))
    assert {(r.orderid, r.productid, r._change) for r in layers.sales.changes("order_details").collect()} == {(1, 2, "insert")}
    assert [(r.orderid, str(r.freight), r._change) for r in layers.sales.changes("orders").collect()] == [(2, "1.00", "delete")]
    layers.vacuum(1)
    assert _fact(layers) == [(1, 1, 5, "1.00", False), (1, 2, 3, "1.00", False), (2, 1, 5, "1.00", True)]
    assert len(layers.fact._complete()) == len(layers.sales.store._complete()) == 1
    assert held() == before and not copies


def test_a_batch_writes_each_row_of_the_clean_tables_once(spark):
    layers = IncrementalLayers(spark, scratch_path(spark, "inc"), {}, n_buckets=2)
    layers.apply(0, AT[0], _raws(spark, AT[0], [(1, "2020-01-05", "1"), (2, "2020-01-06", "1")], [(1, 1, 5), (2, 1, 7)]))
    layers.apply(1, AT[1], _raws(spark, AT[1], [], [(1, 1, 6)]), _ids(spark, 2))
    tables = layers.sales.store.manifest()["tables"]
    assert set(tables) == {"orders", "order_details"}
    assert {(r.orderid, r._change) for r in layers.sales.changes("orders").collect()} == {(2, "delete")}
    assert {(r.orderid, r.quantity, r._change) for r in layers.sales.changes("order_details").collect()} == {(1, 6, "update")}
    assert [r.orderid for r in layers.sales.read("orders").collect()] == [1]
    # an older change set is not seen again, a row deleted then stays away
    layers.apply(2, AT[2], _raws(spark, AT[2], [], [(1, 2, 1)]))
    assert {(r.orderid, r.productid, r._change) for r in layers.sales.changes("order_details").collect()} == {(1, 2, "insert")}
    assert layers.sales.changes("orders").collect() == []
    assert [r.orderid for r in layers.sales.read("orders").collect()] == [1]
    line = layers.sales.read("order_details").where("productid = 1").first()
    assert line._change_hash == spark.sql("select md5('1|1|6|2.00|0.0000')").first()[0] and str(line.line_total) == "12.00"
    assert {(r.orderid, r.product_id): r._change_hash for r in layers.read_fact().collect()}[(1, 1)] == line._change_hash
