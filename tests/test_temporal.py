"""Temporal join of two histories against a point-by-point version."""

import datetime as dt
import random

from pyspark.sql import functions as F

from strata.operators import sequence, temporal
from tests.conftest import rows

DAY = lambda n: None if n is None else dt.datetime(2024, 1, 1) + dt.timedelta(days=n)
LEFT = "id long, boss long, v string, _effective_date timestamp, _end_date timestamp"
RIGHT = "boss_id long, name string, _effective_date timestamp, _end_date timestamp"


def plain(left, right):
    """Cuts every left version at each change of its right side."""
    out = []
    for i, boss, v, a, z in left:
        mine = [r for r in right if boss is not None and r[0] == boss]
        cuts = sorted({t for r in mine for t in (r[2], r[3]) if t is not None and a < t and (z is None or t < z)} | {a})
        for s, e in zip(cuts, [*cuts[1:], z]):
            name = next((r[1] for r in mine if r[2] <= s and (r[3] is None or s < r[3])), None)
            out.append((i, boss, v, name, DAY(s), DAY(e), e is None))
    return sorted(out, key=repr)


def versions(rng, key, gaps):
    out, t = [], rng.randint(0, 20)
    for k in range(rng.randint(1, 5)):
        end = t + rng.randint(1, 30)
        out.append((key, f"n{key}.{k}", t, end if k < 4 or rng.random() < 0.5 else None))
        t = end + (rng.randint(1, 9) if gaps and rng.random() < 0.4 else 0)
    return out


def test_versions_split_where_the_other_side_changes(spark):
    rng = random.Random(4)
    right = [v for key in range(6) for v in versions(rng, key, gaps=True)]
    left = [(i, *x) for i in range(120) for x in (
        (0 if i % 3 else rng.randint(0, 8), f"v{i}", rng.randint(0, 40), None if i % 4 == 0 else rng.randint(41, 160)),)]
    left += [(200, None, "no boss", 3, 90), (201, 99, "unknown", 5, None), (202, 1, "a day", 30, 31)]
    df = temporal.temporal_join(
        spark.createDataFrame([(*x[:3], DAY(x[3]), DAY(x[4])) for x in left], LEFT),
        spark.createDataFrame([(*x[:2], DAY(x[2]), DAY(x[3])) for x in right], RIGHT), "boss", "boss_id", ["name"], ["id"])
    got = rows(df, "id", "boss", "v", "name", "_effective_date", "_end_date", "_is_current")
    assert got == plain(left, right)
    assert df.select("version_sk").distinct().count() == len(got)


def test_empty_sides(spark):
    left = spark.createDataFrame([(1, 1, "v", DAY(0), None)], LEFT)
    right = spark.createDataFrame([(1, "n", DAY(-5), None)], RIGHT)
    join = lambda a, b: rows(temporal.temporal_join(a, b, "boss", "boss_id", ["name"], ["id"]), "id", "name")
    assert join(left, right) == [(1, "n")]
    assert join(left, right.limit(0)) == [(1, None)]
    assert join(left.limit(0), right) == []


def test_numbered_within_a_hot_key(spark):
    df = spark.range(3000).select((F.col("id") % 10 > 6).cast("int").alias("k"), (F.col("id") * 7919 % 3001).alias("t"))
    out = sequence.numbered(df.repartition(8), ["k"], ["t"], "no").collect()
    for key in (0, 1):
        assert [r.no for r in sorted((r for r in out if r.k == key), key=lambda r: r.t)] == list(range(1, sum(r.k == key for r in out) + 1))
