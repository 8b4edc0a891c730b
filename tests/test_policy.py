import pytest
from pyspark.sql import functions as F

from gristmill.functions import policy as P
from gristmill.operators import ordering


def value(spark, expr):
    return spark.range(1).select(expr.alias("x")).first().x


def test_predicates(spark):
    lit = F.lit
    assert [value(spark, P.safe_path(lit(p))) for p in ("a/b", "/a", "a/../b", "a\\b", "", None)] == [True, False, False, False, False, False]
    point = lambda x, y: F.struct(lit(x).alias("x"), lit(y).alias("y"))
    assert value(spark, P.in_unit_square(F.array(point(0.0, 1.0)))) and not value(spark, P.in_unit_square(F.array(point(0.0, 1.1))))
    none = lit(None).cast("boolean")
    assert value(spark, P.admitted(none, lit(True), lit("ok"), ["ok"])) and not value(spark, P.admitted(lit(False), lit(True), lit("ok"), ["ok"])) and not value(spark, P.admitted(none, none, lit("ok"), ["ok"]))
    assert value(spark, P.context_labels(lit("field"), lit("near a road"), {"rural": (["field"], "farm"), "road": ([], r"\broad\b"), "city": (["town"], "street")})) == ["road", "rural"]
    assert [value(spark, P.supervision_role(n, a, p)) for n, a, p in ((lit(True), lit("x"), lit(True)), (none, lit("x"), lit(True)), (none, lit(None), lit(True)), (none, lit(None), none))] == ["negative", "abstention", "presence", "positive"]
    assert value(spark, P.class_labels(F.array(lit(1), lit(0), lit(1)), ["smoke", "fire"])) == ["fire", "smoke"]


def test_keys_and_scores(spark):
    lit = F.lit
    assert value(spark, P.mirrored_distance(lit(0), lit(255), lit(15), lit(255))) == 0 and value(spark, P.mirrored_distance(lit(0), lit(255), lit(15), lit(255), both=False)) == 4
    assert value(spark, P.mean_difference(F.array(lit(1), lit(5)), F.array(lit(2), lit(2)))) == 2
    names = spark.createDataFrame([("a10",), ("a9",), ("b1",)], "n string").orderBy(P.natural_key(F.col("n"))).collect()
    assert [r.n for r in names] == ["a9", "a10", "b1"]
    assert value(spark, P.event_key("d", F.array(lit("b"), lit("a"), lit("a")))) == value(spark, P.event_key("d", F.array(lit("a"), lit("b")))) != value(spark, P.event_key("e", F.array(lit("a"), lit("b"))))
    assert value(spark, P.block_id(lit("seq-0127"), 25)) == 5 and value(spark, P.block_id(lit("x"), 25)) is None
    assert value(spark, P.composite(lit(0.5), lit(-1.0))) == pytest.approx(0.35) and value(spark, P.disagreement(lit(1), lit(2), lit(1), lit(9))) == 2.0


def test_farthest(spark):
    df = spark.createDataFrame([("g", i, float(v)) for i, v in enumerate([5, 1, 9, 2])], "g string, id long, v double")
    got = ordering.farthest_picks(df, ["g"], [F.col("v"), F.col("id")], lambda s: F.abs(F.col("v") - s), "v", "id", 3)
    assert {r.id for r in got.collect()} == {1, 2, 0}
