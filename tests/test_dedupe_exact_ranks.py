import random
from decimal import ROUND_HALF_UP, Decimal

from pyspark.sql import Window
from pyspark.sql import functions as F

from strata.functions.exact import pct, ratio
from strata.operators.dedupe import remove_duplicates
from strata.operators.ranks import top_by, with_global_rank
from tests.conftest import rows

SCHEMA = "k int, ts timestamp, a string, b int"


def _frame(spark, data):
    return spark.createDataFrame(data, SCHEMA)


def test_dedupe_first_and_last_with_total_order(spark):
    import datetime as dt
    t1, t2 = dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2)
    data = [(1, t1, "x", 5), (1, t2, "z", 1), (1, t2, "y", 9), (1, t2, None, 3),
            (2, t1, "a", 1), (2, t1, "a", 1),  # exact tie
            (None, t1, "n", 0)]                # null key is its own group
    df = _frame(spark, data)
    first = remove_duplicates(df, ["k"], "first", order_by=["-ts"])
    assert rows(first) == sorted([(1, t2, None, 3), (2, t1, "a", 1), (None, t1, "n", 0)], key=repr)
    last = remove_duplicates(df, ["k"], "last", order_by=["-ts"])
    assert (1, t1, "x", 5) in rows(last)


def test_dedupe_independent_of_input_order_and_partitioning(spark):
    random.seed(7)
    data = [(random.randint(0, 5), None, random.choice(["p", "q", None]), random.randint(0, 3))
            for _ in range(300)]
    a = rows(remove_duplicates(_frame(spark, data), ["k"]))
    random.shuffle(data)
    b = rows(remove_duplicates(_frame(spark, data).repartition(7), ["k"]))
    assert a == b


def test_dedupe_descending_text_falls_back_to_window(spark):
    df = spark.createDataFrame([(1, "a"), (1, "c"), (1, "b")], ["k", "s"])
    assert rows(remove_duplicates(df, ["k"], order_by=[("s", "desc")])) == [(1, "c")]


def test_dedupe_full_row(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (2, "b")], ["k", "s"])
    assert remove_duplicates(df).count() == 2


def _half_up(n, d, scale, factor=1):
    q = (Decimal(n) * factor / Decimal(d)).quantize(Decimal(1).scaleb(-scale), rounding=ROUND_HALF_UP)
    return q


def test_exact_ratio_matches_decimal_half_up(spark):
    random.seed(3)
    pairs = [(random.randint(-10**6, 10**6), random.randint(1, 9999)) for _ in range(400)]
    pairs += [(46, 8000), (1, 8), (-1, 8), (5, 1000), (0, 3), (7, 0)]
    df = spark.createDataFrame(pairs, "n long, d long")
    got = {(r["n"], r["d"]): r["p"] for r in df.select("n", "d", pct("n", "d").alias("p")).collect()}
    for n, d in pairs:
        assert got[(n, d)] == (None if d == 0 else _half_up(n, d, 2, 100)), (n, d)


def test_exact_ratio_with_decimal_inputs(spark):
    df = spark.createDataFrame([(Decimal("10.05"), 2)], "s decimal(12,2), c long")
    assert df.select(ratio("s", "c", scale=2, num_scale=2)).first()[0] == Decimal("5.03")


def test_global_rank_equals_window_rank(spark):
    random.seed(11)
    data = [(i, random.choice([None, 1, 2, 2, 3, 5, 5, 5, 8])) for i in range(500)]
    df = spark.createDataFrame(data, "id int, v int")
    ours = rows(with_global_rank(df, "v", "r"), "id", "r")
    ref = rows(df.withColumn("r", F.rank().over(Window.orderBy(F.col("v").desc_nulls_last()))),
               "id", "r")
    assert ours == ref


def test_top_by_keeps_ties(spark):
    df = spark.createDataFrame([(i, 10) for i in range(3)] + [(i, i - 3) for i in range(3, 10)],
                               "id int, v int")
    out = top_by(df, "v", 2, out="r")
    assert rows(out, "id", "r") == [(0, 1), (1, 1), (2, 1)]


def test_rank_among_equals_window_rank(spark):
    from strata.operators.ranks import with_rank_among
    random.seed(13)
    data = [(i, random.choice([None, 1, 2, 2, 3, 5, 5, 8, 13])) for i in range(400)]
    df = spark.createDataFrame(data, "id int, v int")
    ref = df.withColumn("r", F.rank().over(Window.orderBy(F.col("v").desc_nulls_last())))
    some = df.where("id % 3 = 0")
    got = rows(with_rank_among(some, df, "v", "r"), "id", "r")
    assert got == rows(ref.where("id % 3 = 0"), "id", "r")


def test_ratio_property(spark):
    from hypothesis import given, settings
    from hypothesis import strategies as st

    @settings(max_examples=25, deadline=None)
    @given(st.lists(st.tuples(st.integers(-10**12, 10**12), st.integers(-10**6, 10**6)),
                    min_size=1, max_size=20))
    def check(pairs):
        df = spark.createDataFrame(pairs, "n long, d long")
        got = [r[0] for r in df.select(ratio("n", "d", scale=3, factor=7)).collect()]
        for (n, d), g in zip(pairs, got):
            assert g == (None if d == 0 else _half_up_signed(n, d, 3, 7))

    check()


def _half_up_signed(n, d, scale, factor):
    from decimal import ROUND_HALF_UP
    return (Decimal(n) * factor / Decimal(d)).quantize(Decimal(1).scaleb(-scale),
                                                       rounding=ROUND_HALF_UP)
