"""Selections, repairs and unions on small frames."""

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from matchloom.operators import cleaning as ops
from matchloom.operators.unions import MatchBundle, relaxed_union, union_bundles
from matchloom.schemas import DEFENSE_ALIASES, Field, declare

SLOW = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))


def test_missing_declared_column_is_an_error(spark):
    with pytest.raises(ValueError, match="b"):
        ops.select_declared(spark.range(1), ["id", "b"])


def test_empty_rows_are_counted(spark):
    df = spark.createDataFrame([(1, None, None), (None, 2.0, "x"), (None, None, "y")], "Gls int, xAG double, k string")
    seen = Observation("dropped")
    kept = ops.drop_empty_stat_rows(df, ["Gls", "xAG"], seen).collect()
    assert len(kept) == 2 and seen.get == {"dropped": 1}


def test_columns_with_dots_and_signs(spark):
    df = spark.createDataFrame([(1, 2, None), (None, 3, 4)], ["Def 3rd_Tackles", "Def.3rd_Tackles", "Tkl.Int"])
    out = ops.coalesce_aliases(df, DEFENSE_ALIASES)
    assert out.columns == ["Def 3rd_Tackles", "Tkl+Int"]
    assert [tuple(r) for r in out.collect()] == [(1, None), (3, 4)]


def test_conform_splits_rows(spark):
    fields = declare("n:L, d:DT, x:D?, s:S, z:L=0")
    rows = [
        ("1.0", "2020-01-02", "0.5", "a", None),
        ("1.5", "2020-01-02", "0.5", "a", "7"),
        ("1", "18000", "NaN", "a", "7"),
        ("q", "soon", "w", None, "e"),
    ]
    df = spark.createDataFrame(rows, "n string, d string, x string, s string, z string")
    good, bad = ops.conform(df, fields)
    assert [(r.n, str(r.d), r.x, r.z) for r in good.collect()] == [
        (1, "2020-01-02", 0.5, 0),
        (1, "2019-04-14", None, 7),
    ]
    why = {r.n: r.violations for r in bad.collect()}
    assert why == {"1.5": ["n: type"], "q": ["n: type", "d: type", "x: type", "s: null", "z: type"]}
    with pytest.raises(ValueError, match="extra"):
        ops.conform(df.withColumn("more", F.lit(1)), fields)


def test_frames_differ_counts_repeats(spark):
    a = spark.createDataFrame([(1,), (1,), (2,)], "x int")
    b = spark.createDataFrame([(1,), (2,), (2,)], "x int")
    assert not ops.frames_differ(a, a)
    assert ops.frames_differ(a, b)
    assert ops.frames_differ(a, a.select(F.col("x").cast("bigint")))


NESTED = "a int, m map<string,array<double>>, l array<string>, s struct<x:int,y:map<int,string>>"


def test_fingerprints_are_of_rows_and_not_of_their_order(spark):
    rows = [
        (1, {"p": [1.0, None], "q": None}, [None, "x"], (1, {1: "a", 2: "b"})),
        (1, {"p": [1.0, None], "q": None}, [None, "x"], (1, {1: "a", 2: "b"})),
        (None, {}, [], (None, None)),
        (None, None, None, None),
        (3, {"p": [0.0]}, ["x", None], (2, {})),
    ]
    turned = [(a, m and dict(reversed(m.items())), x, s and (s[0], s[1] and dict(reversed(s[1].items())))) for a, m, x, s in reversed(rows)]
    a, b = spark.createDataFrame(rows, NESTED), spark.createDataFrame(turned, NESTED).repartition(4)
    assert not ops.frames_differ(a, b.select("s", "l", "m", "a"))
    assert ops.frame_difference(a, b).isEmpty()
    changes = [
        (1, None, (1, {"p": [None, 1.0], "q": None}, [None, "x"], (1, {1: "a", 2: "b"}))),
        (2, None, (None, {}, [], None)),
        (2, None, (None, None, [], (None, None))),
        (2, None, (None, {}, None, (None, None))),
        (4, None, (3, {"p": [0.0]}, [None, "x"], (2, {}))),
        (4, None, (3, {"p": [0.0]}, ["x", None], (2, None))),
        (0, None, rows[4]),
    ]
    for place, _, row in changes:
        other = spark.createDataFrame([*rows[:place], row, *rows[place + 1 :]], NESTED)
        assert ops.frames_differ(a, other), row
        assert {r.surplus for r in ops.frame_difference(a, other).collect()} == {1, -1}
    assert not ops.frames_differ(spark.sql("select -0.0D x"), spark.sql("select 0.0D x"))
    assert not ops.frames_differ(a.where("false"), b.where("false")) and ops.frames_differ(a, a.where("false"))


def test_fingerprints_shuffle_no_rows(spark):
    df = spark.range(1000).selectExpr("id AS x", "id * 2 AS y")
    plan = ops.fingerprints(df)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange ") == 1 and "Exchange SinglePartition" in plan
    by_key = {r.y: r.rows for r in ops.fingerprints(df.withColumn("y", F.col("x") % 3), ["y"]).collect()}
    assert by_key == {0: 334, 1: 333, 2: 333}


def test_sentinels(spark):
    df = spark.createDataFrame([("NA_character_", 1), ("a NA_character_", 2), (None, 3)], "s string, n int")
    assert [r.s for r in ops.clean_sentinels(df).collect()] == ["", "a NA_character_", None]
    assert [r.s for r in ops.clean_sentinels(df, "substring").collect()] == ["", "a ", None]


def test_union_widens_types(spark):
    a = spark.createDataFrame([(1, True, "x")], "n int, b boolean, s string")
    b = spark.createDataFrame([(2.5, 3, 4)], "n double, b bigint, s int")
    out = relaxed_union([a, None, b, spark.sql("select date'2020-01-01' s, 1 extra")])
    assert out.dtypes == [("n", "double"), ("b", "bigint"), ("s", "string"), ("extra", "int")]
    assert {tuple(r) for r in out.collect()} == {
        (1.0, 1, "x", None),
        (2.5, 3, "4", None),
        (None, None, "2020-01-01", 1),
    }


@SLOW
@given(st.lists(st.lists(st.tuples(st.integers(0, 3), st.sampled_from("ab")), max_size=3), min_size=3, max_size=3))
def test_union_is_associative(spark, parts):
    kinds = ["int, s string", "double, t string", "string, s string"]
    cast = [int, float, str]
    a, b, c = (
        spark.createDataFrame([(to(n), s) for n, s in rows], "k " + kind)
        for rows, kind, to in zip(parts, kinds, cast)
    )
    left = relaxed_union([relaxed_union([a, b]), c])
    right = relaxed_union([a, relaxed_union([b, c])])
    assert dict(left.dtypes) == dict(right.dtypes)
    ends = [sorted(map(repr, f.select("s", "t").collect())) for f in (left, right)]
    assert ends[0] == ends[1]


def test_bundles(spark):
    one = MatchBundle(summary=spark.range(2), team={"misc": spark.range(1)})
    two = MatchBundle(lineups=spark.range(3), team={"misc": spark.range(4)}, player={"misc": spark.range(5)})
    both = union_bundles([one, None, two])
    assert both.summary.count() == 2 and both.lineups.count() == 3 and both.shooting is None
    assert both.team["misc"].count() == 5 and both.player["misc"].count() == 5
    assert union_bundles([None]).summary is None


def test_conform_keeps_long_numbers_exact(spark):
    fields = [Field("n", T.LongType()), Field("s", T.LongType())]
    df = spark.sql("SELECT 9007199254740993L AS n, '9007199254740993' AS s")
    good, bad = ops.conform(df, fields)
    assert [tuple(r) for r in good.collect()] == [(9007199254740993, 9007199254740993)] and bad.count() == 0
