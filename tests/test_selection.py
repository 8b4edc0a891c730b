from pyspark.sql import functions as F

from gristmill.operators import selection as S


def test_nearest_in_time(spark):
    a = spark.createDataFrame([("k", 1, 0.0), ("k", 2, 10.0), ("k", 3, 11.0), ("z", 9, 0.0)], "k string, id long, t double")
    b = spark.createDataFrame([("k", 1, 10.5), ("k", 2, 3.0), ("z", 9, 50.0)], "k string, id long, t double")
    got = {(r.a, r.b, r.gap) for r in S.nearest_in_time(a, b, "k", 5.0).collect()}
    assert got == {(2, 1, 0.5), (1, 2, 3.0)}


def test_match_boxes(spark):
    t = spark.createDataFrame([(1, 0, 1, [0.0, 0.0, 10.0, 10.0]), (1, 0, 2, [1.0, 0.0, 10.0, 10.0]), (2, 0, 3, [0.0, 0.0, 1.0, 1.0])], "image long, cls int, t long, box array<double>")
    p = spark.createDataFrame([(1, 0, 1, 0.9, [1.0, 0.0, 10.0, 10.0]), (1, 0, 2, 0.8, [1.0, 0.0, 10.0, 10.0]), (1, 0, 3, 0.7, [50.0, 0.0, 1.0, 1.0]), (2, 1, 4, 0.9, [0.0, 0.0, 1.0, 1.0])], "image long, cls int, p long, score double, box array<double>")
    assert {(r.image, r.p, r.t) for r in S.match_boxes(t, p, 0.5).collect()} == {(1, 1, 2), (1, 2, 1)}


def test_admission_and_caps(spark):
    c = spark.createDataFrame([("g", 1, 0), ("g", 2, 1), ("g", 3, 255), ("g", 4, -1), ("h", 5, 0)], "g string, id long, sig long")
    assert sorted(r.id for r in S.admitted(c, "g", ["id"], "sig", 2, 2).collect()) == [1, 3, 5]
    d = spark.createDataFrame([("a", i) for i in range(8)] + [("b", 10 + i) for i in range(2)] + [("c", 20)], "s string, id long")
    left = {r.s: r["count"] for r in S.capped_share(d, "s", [F.col("id")], 0.5).groupBy("s").count().collect()}
    assert left == {"a": 3, "b": 2, "c": 1}
    assert S.negative_budget(100, 20, 5) == int((0.12 * 120 - 0.88 * 5) / 0.88)


def test_closure_and_locks(spark):
    links = spark.createDataFrame([(1, "a"), (1, "b"), (2, "b"), (2, "c"), (3, "x"), (3, "y")], "set_id long, name string")
    assert {r.name for r in S.closure(spark.createDataFrame([("a",)], "name string"), links).collect()} == {"a", "b", "c"}
    members = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (3, "d"), (3, "e")], "component long, name string")
    locks = spark.createDataFrame([("a", "test"), ("d", "test"), ("e", "train")], "name string, split string")
    good, bad = S.locked_split(members, locks, F.lit("train"))
    assert {r.component: r.split for r in good.collect()} == {1: "test", 2: "train"} and [r.component for r in bad.collect()] == [3]


def test_reconciliation(spark):
    e = spark.createDataFrame([(1, "accept", "x"), (1, "reject", "weak"), (2, "accept", "x"), (2, "reject", "y"), (3, "reject", None), (4, None, None)], "id long, verdict string, reason string")
    assert {r.id: r.state for r in S.reconciled(e, "id", ["weak"]).collect()} == {1: "accepted", 2: "conflict", 3: "rejected", 4: "needs_review"}
    df = spark.createDataFrame([("a", None), ("a", "b"), (None, None)], "x string, y string")
    assert [tuple(r.s) for r in df.select(S.agreed(F.col("x"), F.col("y")).alias("s")).collect()] == [("a", "agreed"), (None, "conflict"), (None, "missing")]


def test_expressions(spark):
    t = "0 0.5 0.5 0.1 0.1\n9 0 0 0 0\n1 2 0 0 0\nx\n1 0 0 1 1"
    got = spark.createDataFrame([(t,)], "t string").select(S.yolo_boxes(F.col("t"), 2).alias("b")).first().b
    assert [(r.cls, r.box) for r in got] == [(0, [0.5, 0.5, 0.1, 0.1]), (1, [0.0, 0.0, 1.0, 1.0])]
    df = spark.createDataFrame([([], -400), ([1.0], -1), ([9.0], 0), ([1.0, 9.0], 5)], "a array<double>, s int")
    assert [(r.c, r.o) for r in df.select(S.size_class(F.col("a"), 2.0, 5.0).alias("c"), S.offset_role(F.col("s")).alias("o")).collect()] == [("none", "pre"), ("small", "ambiguous"), ("contextual", "ambiguous"), ("mixed", "post")]
    m = spark.createDataFrame([("r", "o", "a")] * 4 + [("r", "o", "b")] + [("r", "p", "c")], "role string, origin string, source string")
    mass = {r.source: r.mass for r in S.sampling_mass(m, "role", "origin", "source", {"r": 1.0}).collect()}
    assert abs(sum(mass.values()) - 1) < 1e-9 and abs(mass["a"] - 1 / 3) < 1e-9 and mass["c"] == 0.5
