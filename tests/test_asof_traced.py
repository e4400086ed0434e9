"""As-of joins and provenance against brute force, with hot keys."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

from strata.operators.asof import asof_join, both_times
from strata.operators.dedup import keep_one_traced
from strata.operators.nested import explode_path
from strata.operators.windows import ranges


def sides(spark, n=1200):
    rnd = random.Random(5)
    key = lambda: rnd.choice([1, 1, 2, 3, None])  # noqa: E731  # key 1 holds more than a third of all rows
    when = lambda: rnd.choice([None] + list(range(400)))
    left = [(i, key(), when()) for i in range(n)]
    right = [(key(), when(), rnd.choice([None, *range(5)]), f"r{i % 7}") for i in range(n // 4)]
    return (left, right, spark.createDataFrame(left, "id int, k int, t int").repartition(5),
            spark.createDataFrame(right, "k int, t int, v int, w string").repartition(3))


def brute(left, right):
    out = {}
    for i, k, t in left:
        fit = [(r[1], r[2] is not None, r[2] or 0, r[3]) for r in right if None not in (k, t) and r[0] == k and r[1] is not None and r[1] <= t]
        best = max(fit, default=None)
        out[i] = (None, None, None) if best is None else (best[2] if best[1] else None, best[3], best[0])
    return out


def test_asof_equals_brute_force_whatever_the_buckets(spark):
    left, right, l, r = sides(spark)
    want = brute(left, right)
    for bucket in (None, F.lit(0), F.floor(F.col("at") / 7), ranges(both_times(l, r, "t", "t"), "at", rows=50)):
        got = asof_join(l, r, ["k"], "t", "t", {"v": "v", "w": "w", "since": "t"}, bucket)
        assert got.columns == ["id", "k", "t", "v", "w", "since"]
        rows = got.collect()
        assert len(rows) == len(left)
        assert {x.id: (x.v, x.w, x.since) for x in rows} == want


def test_asof_of_nothing(spark):
    _, _, l, r = sides(spark, 40)
    assert asof_join(l.limit(0), r, ["k"], "t", "t", {"v": "v"}).count() == 0
    alone = asof_join(l, r.limit(0), ["k"], "t", "t", {"v": "v"}, F.col("at")).collect()
    assert len(alone) == 40 and {x.v for x in alone} == {None}


def test_asof_is_one_pass_without_a_range_join(spark):
    _, _, l, r = sides(spark, 40)
    text = asof_join(l, r, ["k"], "t", "t", {"v": "v"}, F.col("at"))._jdf.queryExecution().optimizedPlan().toString()
    assert "Cartesian" not in text and "Join Inner" not in text and text.count("Join LeftOuter") == 1


def test_traced_rows_name_their_document(spark):
    rnd = random.Random(3)
    rows = [(rnd.choice(["hot", "a", "b", None]), rnd.randrange(3), rnd.choice([None, 1, 2, 3, 4]), i) for i in range(500)]
    df = spark.createDataFrame(rows, "k string, v int, doc int, pos int").repartition(7)
    got = {r.k: (r.v, r.doc, r.pos, r.documents) for r in
           keep_one_traced(df, ["k"], ["v"], document=["doc"], place=["pos"]).collect()}
    want = {}
    for k in {r[0] for r in rows}:
        mine = [r for r in rows if r[0] == k]
        first = min(mine, key=lambda r: (r[1], r[2] is not None, r[2] or 0, r[3]))
        want[k] = (first[1], first[2], first[3], len({r[2] for r in mine}))
    assert got == want
    assert keep_one_traced(df.limit(0), ["k"], document=["doc"]).count() == 0


def test_place_survives_explode(spark):
    df = spark.createDataFrame([(1, ["x", None, "y"]), (2, []), (3, None)], "id int, a array<string>")
    assert [tuple(r) for r in explode_path(df, "a", "v", keep=("id",), place="at").orderBy("at").collect()] == [
        (1, 0, "x"), (1, 1, None), (1, 2, "y")]
