import contextlib
import io
import shutil

from pyspark.sql import functions as F

from strata.plans import storage
from strata.plans.layers import Layers
from strata.plans.warehouse import Warehouse, input_signature
from strata.session import scratch_path

SMALL = "/root/testdata/sf0.001"


def _formatted(df):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def test_partitioned_fact_prunes_folders(spark):
    path = scratch_path(spark, "fact")
    fact = Layers(spark, SMALL).fact_sales
    storage.write_fact(fact, path)
    back = storage.read_fact(spark, path, years=[1996], months=[3])
    text = _formatted(back)
    assert "PartitionFilters: [isnotnull(order_year" in text and "order_month" in text
    expect = fact.where((F.year("order_date") == 1996) & (F.month("order_date") == 3)).count()
    assert back.count() == expect > 0


def test_clustered_layout_keeps_rows(spark):
    path = scratch_path(spark, "fact-clustered")
    fact = Layers(spark, SMALL).fact_sales
    storage.write_fact(fact, path, cluster_by=["customer_id", "order_date"])
    assert storage.read_fact(spark, path).count() == fact.count()


def test_save_table_computes_statistics(spark):
    df = spark.read.parquet(f"{SMALL}/nation.parquet")
    storage.save_table(spark, df, "strata_test_nation", scratch_path(spark, "nation"),
                       analyze_columns=["n_regionkey"])
    stats = spark.sql("DESCRIBE EXTENDED strata_test_nation").where("col_name = 'Statistics'")
    assert "rows" in stats.first()["data_type"]
    col = spark.sql("DESCRIBE EXTENDED strata_test_nation n_regionkey").collect()
    assert any(r["info_name"] == "distinct_count" for r in col)
    spark.sql("DROP TABLE strata_test_nation")


def test_store_key_follows_the_inputs(spark, tmp_path):
    base = tmp_path / "sf"
    shutil.copytree(SMALL, base)
    before = input_signature(spark, str(base))
    assert before == input_signature(spark, str(base))
    (base / "orders.parquet").touch()
    after = input_signature(spark, str(base))
    assert before != after
    w = Warehouse(spark, str(base))
    assert w.fact_sales.count() == Layers(spark, str(base)).fact_sales.count()


def test_new_code_gets_a_new_store_and_a_stopped_build_is_not_seen(spark, monkeypatch):
    import pytest

    from strata.plans import warehouse
    from strata.plans.versioned import VersionedTable
    from strata.session import scratch_path
    small = "/root/testdata/sf0.001"
    first = warehouse.Warehouse(spark, small).root
    monkeypatch.setattr(warehouse, "plan_version", lambda: "other")
    assert warehouse.Warehouse(spark, small).root != first

    store = warehouse.Warehouse(spark, small, root=scratch_path(spark, "warehouse"))

    def stop(self, manifest, done):
        raise OSError("stopped before the manifest")

    with monkeypatch.context() as m:
        m.setattr(VersionedTable, "_mark", stop)
        with pytest.raises(OSError):
            store.build("shippers_clean")
    assert store.table("shippers_clean").folder() is None
    built = store.build("shippers_clean")
    assert store.build("shippers_clean") == built
    assert spark.read.parquet(built).count() == store.clean("shippers").count()
    assert store.build("shippers_clean", force=True) != built


def test_no_shared_folder_is_an_error_on_a_cluster():
    import types

    import pytest

    from strata import session

    def fake(master):
        sc = types.SimpleNamespace(master=master, getCheckpointDir=lambda: None, setCheckpointDir=lambda p: None)
        conf = types.SimpleNamespace(get=lambda k, d=None: d, set=lambda k, v: None)
        return types.SimpleNamespace(sparkContext=sc, conf=conf)

    for master in ("local-cluster[2,1,1024]", "yarn", "spark://host:7077"):
        with pytest.raises(session.NoSharedFolder):
            session.shared_dir(fake(master))
    assert session.shared_dir(fake("local[2]"))


def _fact_rows(spark, data):
    from pyspark.sql import functions as F
    return spark.createDataFrame(data, "orderid long, product_id long, order_date string, shipped string, v string").select(
        "orderid", "product_id", F.to_date("order_date").alias("order_date"), "shipped", "v",
        F.md5(F.col("v")).alias("_change_hash"), F.lit(False).alias("_is_deleted"))


FACT = [(1, 1, "2024-01-05", None, "a"), (2, 1, "2024-01-06", None, "b"), (3, 1, "2024-03-01", None, "c"), (None, None, None, None, "n")]


def _state(store):
    return sorted(((r.orderid, str(r.order_date), r.shipped, r.v, r._is_deleted) for r in store.read("fact_sales").collect()), key=repr)


def test_upsert_sees_headers_and_brings_deleted_lines_back(spark):
    from strata.plans import stored_fact as sf
    from strata.session import scratch_path
    store = sf.fact_store(spark, scratch_path(spark, "fact"), n_buckets=4)
    sf.create(store, _fact_rows(spark, FACT))
    # the order line's own hash is the same in all of these
    moved = [(1, 1, "2024-02-05", None, "a"), (2, 1, "2024-01-06", "s", "b")]
    assert sf.upsert(store, _fact_rows(spark, moved), batch_id=4) == [202401, 202402]
    assert sf.upsert(store, _fact_rows(spark, FACT), batch_id=4) == []          # that id was applied
    assert sf.upsert(store, _fact_rows(spark, moved)) == []                     # nothing new
    assert store.has_applied(4)
    all_keys = _fact_rows(spark, FACT).select("orderid")
    assert sf.soft_delete(store, all_keys.where("orderid = 2"), ["orderid"]) == [0, 202402, 202403]
    assert store.has_applied(4)                                                 # kept by commits without an id
    assert [r[4] for r in _state(store)] == [True, False, True, True]
    assert sf.upsert(store, _fact_rows(spark, [FACT[2]])) == [202403]           # sent again: back
    assert sf.soft_delete(store, all_keys, ["orderid"]) == [0, 202402]          # in the snapshot: back
    assert _state(store) == sorted([(1, "2024-02-05", None, "a", False), (2, "2024-01-06", "s", "b", False),
                                    (3, "2024-03-01", None, "c", False), (None, "None", None, "n", False)], key=repr)


def test_upsert_reads_only_the_buckets_and_months_it_touches(spark, monkeypatch):
    from strata.plans import stored_fact as sf
    from strata.plans.versioned import BucketStore
    from strata.session import scratch_path
    store = sf.fact_store(spark, scratch_path(spark, "fact"))
    sf.create(store, _fact_rows(spark, [(k, 1, f"2024-{k % 12 + 1:02d}-01", None, "x") for k in range(200)]))
    read, files = BucketStore.read, []

    def spy(self, table, buckets=None):
        df = read(self, table, buckets)
        files.extend(f.split("/data/")[1].split("/", 1)[1].rsplit("/", 1)[0] for f in df.inputFiles())
        return df

    monkeypatch.setattr(BucketStore, "read", spy)
    assert sf.upsert(store, _fact_rows(spark, [(5, 1, "2024-08-02", None, "x")])) == [202406, 202408]
    assert {f for f in files if f.startswith("fact")} == {"fact_sales/_bucket=202406", "fact_sales/_bucket=202408"}
    assert len({f for f in files if f.startswith("locator")}) == 1


def test_an_empty_fact_takes_rows(spark):
    from strata.plans import stored_fact as sf
    from strata.session import scratch_path
    store = sf.fact_store(spark, scratch_path(spark, "fact"))
    sf.create(store, _fact_rows(spark, []))
    assert _state(store) == [] and sf.soft_delete(store, _fact_rows(spark, FACT), ["orderid"]) == []
    assert sf.upsert(store, _fact_rows(spark, FACT[:1])) == [202401]
    assert _state(store) == [(1, "2024-01-05", None, "a", False)]


def test_hashes_travel_as_bytes_and_come_back_as_they_were(spark):
    from pyspark.sql import functions as F

    from strata.functions import hashing
    texts = ["0123456789abcdef" * 2, "0123456789ABCDEF" * 2, "0123456789abcdef" * 2 + "\n", "", "x", "\x01", "é", None]
    df = spark.createDataFrame([(i, t, b"ab") for i, t in enumerate(texts)], "i int, _change_hash string, fact_sales_sk binary")
    kinds = []

    def step(d):
        kinds.append(dict(d.dtypes)["_change_hash"])
        assert d.where("i = 0").select(F.octet_length("_change_hash")).first()[0] == 17
        return d.repartition(3)

    out = hashing.packed_during(df, step)
    assert kinds == ["binary"] and out.schema == df.schema
    assert [r._change_hash for r in out.orderBy("i").collect()] == texts


def test_stored_fact_has_the_hashes_of_the_computed_one_and_none_is_shuffled(spark, monkeypatch):
    from strata.plans import storage
    from strata.plans.layers import Layers
    from strata.plans.warehouse import Warehouse
    from strata.session import scratch_path
    base, dealt, during = "/root/testdata/sf0.001", [], storage.hashing.packed_during

    def spy(df, step):
        return during(df, lambda d: dealt.append(d.columns) or step(d))

    w = Warehouse(spark, base, root=scratch_path(spark, "warehouse"))
    w.build("order_details_clean"), w.build("orders_clean")
    monkeypatch.setattr(storage.hashing, "packed_during", spy)
    stored = w.fact_sales
    assert not {"fact_sales_sk", "_change_hash"} & set(dealt[-1])
    columns = ["orderid", "product_id", "fact_sales_sk", "_change_hash"]
    want = Layers(spark, base).fact_sales
    assert stored.columns == [*want.columns, *storage.PARTITION_COLUMNS]
    assert sorted(map(tuple, stored.select(*columns).collect())) == sorted(map(tuple, want.select(*columns).collect()))


def test_steps_leave_no_staged_rows_behind(spark, monkeypatch):
    from pathlib import Path

    from pyspark.sql import DataFrame

    from strata.plans import stored_fact as sf
    from strata.session import scratch_path, shared_dir
    held = lambda: {p.name for p in Path(shared_dir(spark)).glob("strata/staged-*")}
    before, copies, checkpoint = held(), [], DataFrame.checkpoint
    monkeypatch.setattr(type(spark.range(1)), "checkpoint", lambda self, *a, **k: copies.append(1) or checkpoint(self, *a, **k))
    store = sf.fact_store(spark, scratch_path(spark, "fact"), n_buckets=4)
    sf.create(store, _fact_rows(spark, FACT))
    sf.soft_delete(store, _fact_rows(spark, FACT[:2]), ["orderid"])
    sf.upsert(store, _fact_rows(spark, FACT))
    assert held() == before and not copies


def test_of_two_writers_one_must_begin_again(spark):
    import pytest
    from strata.plans.versioned import BucketStore, CommitConflict
    from strata.session import scratch_path
    path = scratch_path(spark, "store")
    rows = lambda ks: spark.createDataFrame([(k, "v") for k in ks], "k long, v string")
    one, two = BucketStore(spark, path, ["k"], 2), BucketStore(spark, path, ["k"], 2)
    assert one.read("t") is None and two.read("t") is None
    one.commit({"t": rows([1])}, [0, 1], batch_id=5)
    with pytest.raises(CommitConflict):
        two.commit({"t": rows([2])}, [0, 1])
    assert [r.k for r in BucketStore(spark, path, ["k"]).read("t").collect()] == [1]


def test_old_versions_expire(spark):
    from strata.plans import versioned
    from strata.session import scratch_path
    store = versioned.BucketStore(spark, scratch_path(spark, "store"), ["k"], 1)
    for n in range(2 * versioned.EXPIRE_EVERY):
        store.commit({"t": spark.createDataFrame([(1, n)], "k long, n long")}, [0])
    assert len(store._children(f"{store.path}/data")) == versioned.KEEP == len(store._complete())
    assert store.read("t").first().n == 2 * versioned.EXPIRE_EVERY - 1


def test_derived_hashes_are_stored_only_where_they_differ(spark):
    from strata.functions import hashing
    from strata.plans import stored_fact as sf
    from strata.session import scratch_path
    own = [None, "", "-", "=", "ab" * 16]
    df = spark.createDataFrame([(i, 1, 2, "3.00", h) for i, h in enumerate(own)] + [(9, 1, None, "3.00", "")],
                               "orderid long, product_id long, order_quantity int, unit_price string, _change_hash string")
    df = df.withColumns({"discount_rate": F.lit(0), "order_date": F.to_date(F.lit("2024-01-05")), "_is_deleted": F.lit(False),
                         "fact_sales_sk": hashing.surrogate_key(["orderid", "product_id"])})
    line = hashing.change_hash(["orderid", "product_id", "order_quantity", "unit_price", "discount_rate"])
    df = df.withColumn("_change_hash", F.when(F.col("orderid") == 9, line).otherwise(F.col("_change_hash")))
    store = sf.fact_store(spark, scratch_path(spark, "fact"), n_buckets=2)
    sf.create(store, df)
    columns = ["orderid", "fact_sales_sk", "_change_hash"]
    want = sorted(map(tuple, df.select(columns).collect()))
    state = lambda: sorted(map(tuple, store.read("fact_sales").select(columns).collect()))
    assert state() == want
    held = {r.orderid: r for r in store.as_stored().read("fact_sales").collect()}
    assert held[9]._change_hash is None and all(r.fact_sales_sk is None for r in held.values())
    # rows that stay, and changed ones, keep theirs through a rewrite of their month
    assert sf.upsert(store, df.where("orderid = 1").withColumn("unit_price", F.lit("4.00"))) == [202401]
    assert state() == want
    assert sf.upsert(store, df.where("orderid in (0, 9)")) == []
    assert sf.soft_delete(store, df.where("orderid != 2"), ["orderid"]) == [202401]
    assert state() == want


def test_stored_clean_tables_and_fact_hold_no_hashes(spark):
    from strata.plans.layers import Layers
    from strata.plans.warehouse import Warehouse
    from strata.session import scratch_path
    w = Warehouse(spark, SMALL, root=scratch_path(spark, "warehouse"))
    for name, key in (("order_details_clean", ["orderid", "productid"]), ("shippers_clean", ["shipperid"])):
        assert "_change_hash" not in spark.read.parquet(w.build(name)).columns
        got, want = w.clean(name[:-6]), Layers(spark, SMALL).clean(name[:-6])
        assert got.columns == want.columns
        assert sorted(map(tuple, got.select(*key, "_change_hash").collect())) == sorted(map(tuple, want.select(*key, "_change_hash").collect()))
    assert not {"fact_sales_sk", "_change_hash"} & set(spark.read.parquet(w.build("fact_sales")).columns)
