"""Schema tracking: nothing declared, nothing lost."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.streaming.tracked import (RESCUED, VERSION, ingest_tracked, merged, read_tracked, schema_of_lines, track,
                                      typed_lines, versions)


def lines(spark, *rows):
    return spark.createDataFrame([(r if isinstance(r, str) or r is None else json.dumps(r),) for r in rows], "value string")


def ddl(schema):
    return {f.name: f.dataType.simpleString() for f in schema}


def test_kinds_of_values_decide_the_type(spark):
    got = schema_of_lines(lines(spark, {"a": 1, "b": 1, "c": 1, "d": None, "e": {"x": 1}, "f": True, "g": 1},
                                {"a": 2, "b": 1.5, "c": "x", "d": None, "e": [1], "f": None, "g": True}, "no json", "[1]", "", None))
    assert ddl(got) == {"a": "bigint", "b": "double", "c": "string", "e": "string", "f": "boolean", "g": "string"}
    assert len(schema_of_lines(lines(spark, "", None))) == 0


def test_merge_only_adds_and_widens():
    known = T.StructType.fromDDL("b BIGINT, a STRING, n DOUBLE")
    seen = T.StructType.fromDDL("a BIGINT, b DOUBLE, c BOOLEAN, n STRING")
    assert ddl(merged(known, seen)) == {"b": "double", "a": "string", "n": "double", "c": "boolean"}
    assert merged(known, T.StructType()) == known
    clash = T.StructType([T.StructField(n, T.LongType()) for n in ("A", "X", "x", RESCUED, VERSION.upper())])
    assert merged(known, clash).names == ["b", "a", "n", "X"]


def test_what_does_not_fit_is_rescued(spark):
    schema = T.StructType.fromDDL("a BIGINT, s STRING, f DOUBLE, `x.y z` BOOLEAN")
    rows = typed_lines(lines(spark, {"a": 1, "s": "t", "f": 2, "x.y z": True}, {"a": "1", "s": {"k": [1, None]}, "f": 2.5},
                             {"a": 1.5, "new": [1], "A": 7, "none": None}, {"a": None}, "{}", "bad", "[1]", '{"a":1,"a":2}', "  "),
                       schema, 3).collect()
    assert [(r.a, r.s, r.f, r["x.y z"]) for r in rows] == [
        (1, "t", 2.0, True), (None, '{"k":[1,null]}', 2.5, None)] + [(None, None, None, None)] * 6
    assert [r[RESCUED] and (json.loads(r[RESCUED]) if r[RESCUED] != "bad" and '"a":2' not in r[RESCUED] else r[RESCUED]) for r in rows] == [
        None, {"a": "1"}, {"a": 1.5, "new": [1], "A": 7}, None, None, "bad", [1], '{"a":1,"a":2}']
    assert {r[VERSION] for r in rows} == {3}


def test_three_arrivals(spark, tmp_path):
    inbox, table, checkpoint = (str(tmp_path / n) for n in ("in", "table", "ckpt"))
    with pytest.raises(ValueError):
        read_tracked(spark, table, checkpoint)

    def arrive(*rows):
        lines(spark, *rows).coalesce(1).write.mode("append").text(inbox)
        return ingest_tracked(spark, inbox, table, checkpoint).rows

    assert arrive({"id": 1, "v": 10}) == 1
    assert arrive({"id": 2, "v": 0.5, "w": "n"}) == 1
    assert arrive({"id": "three", "v": 3, "W": 1}) == 1
    assert ingest_tracked(spark, inbox, table, checkpoint).rows == 0      # nothing new: no version, no row
    got = read_tracked(spark, table, checkpoint).orderBy(VERSION, F.col("id").asc_nulls_last()).collect()
    assert [(r.id, r.v, r.w, r[RESCUED] and json.loads(r[RESCUED]), r[VERSION]) for r in got] == [
        (1, 10.0, None, None, 1), (2, 0.5, "n", None, 2), (None, 3.0, None, {"id": "three", "W": 1}, 2)]
    assert [v for v, _, _ in versions(spark, checkpoint)][-1] == 2


def test_a_version_stored_before_a_crash_serves_the_rerun(spark, tmp_path):
    inbox, table, checkpoint = (str(tmp_path / n) for n in ("in", "table", "ckpt"))
    lines(spark, {"id": 1}).write.text(inbox)
    track(spark, inbox, checkpoint)                                       # the run dies before its stream starts
    assert ingest_tracked(spark, inbox, table, checkpoint).rows == 1
    assert [(r.id, r[RESCUED], r[VERSION]) for r in read_tracked(spark, table, checkpoint).collect()] == [(1, None, 1)]
