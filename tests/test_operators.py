from __future__ import annotations

import re

from pyspark.sql import Window
from pyspark.sql import functions as F

from semesta.operators import merge, rank
from semesta.operators.grouping import cube_sets, grouping_sets, grouping_sets_by_entity, rollup_sets
from semesta.operators.keys import assign_keys, extend_keys
from semesta.operators.settled import settled
from tests.conftest import rows


def test_settled_keeps_rows_and_schema(spark):
    for size in (0, 3, 5000):
        data = spark.range(size).select(F.col("id"), F.col("id").cast("string").alias("name"))
        kept = settled(data)
        assert kept.schema.simpleString() == data.schema.simpleString()
        assert rows(kept) == rows(data)


def test_more_categories_than_any_small_table(spark):
    from semesta.sources import testbed

    part = spark.range(5000).select(F.format_string("type %05d", F.col("id") % 4500).alias("p_type"))
    numbered = testbed.kategori_buku(part)
    assert rows(numbered, "kategori_id", "nama_kategori") == sorted(
        ((n + 1, f"type {n:05d}") for n in range(4500)), key=repr
    )


def test_grand_total_on_no_rows(spark):
    nothing = spark.createDataFrame([], "s int, y string, v long")
    by_entity = grouping_sets_by_entity(nothing, ["y"], rollup_sets(["y"]), "s", "n", {"v": F.col("v")})
    assert rows(by_entity) == [(None, True, 0, None)]
    plain = grouping_sets(nothing.select("y", "v"), ["y"], [("y",), ()], {"v": F.sum("v")})
    assert rows(plain) == [(None, True, None)]


def test_ranks_equal_plain_windows(spark):
    data = spark.range(500).select("id", (F.col("id") % 7 % 4).alias("m"))
    everything = Window.orderBy(F.desc("m"))
    for operator, window in ((rank.dense_rank, F.dense_rank()), (rank.competition_rank, F.rank())):
        expected = data.withColumn("r", window.over(everything))
        assert rows(operator(data, "m", "r"), "id", "r") == rows(expected, "id", "r")


def test_row_number_equals_plain_window(spark):
    data = spark.range(500).select("id", (F.col("id") % 3).alias("p"), (F.col("id") % 5).alias("m"))
    window = Window.partitionBy("p").orderBy(F.desc("m"), "id")
    expected = data.withColumn("r", F.row_number().over(window))
    actual = rank.row_number(data, ["p"], "m", [F.col("id")], "r")
    assert rows(actual, "id", "r") == rows(expected, "id", "r")


def test_row_number_splits_one_large_partition(spark):
    """One partition with all rows is sorted per metric value, not in one task."""
    data = spark.range(2000).select("id", F.floor(F.col("id") / 5000).alias("p"), (F.col("id") % 50).alias("m"))
    actual = rank.row_number(data, ["p"], "m", [F.col("id")], "r")
    assert rows(actual, "r") == sorted([(n,) for n in range(1, 2001)], key=repr)
    plan = actual._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"Window \[row_number\(\)[^\n]*\], \[p#\d+L, m#\d+L\], \[id#", plan)


def _naive(df, grouping):
    return grouping.agg(
        F.countDistinct("s").alias("n"),
        F.sum("v").alias("v"),
        *((F.grouping(c) == 1).alias(f"total_{c}") for c in ("a", "b")),
    )


def test_grouping_sets_equal_cube_and_rollup(spark):
    data = spark.range(400).select(
        (F.col("id") % 37).alias("s"),
        (F.col("id") % 4).alias("a"),
        F.when(F.col("id") % 5 > 0, F.col("id") % 5).alias("b"),
        F.col("id").alias("v"),
    )
    columns = ["a", "b", "total_a", "total_b", "n", "v"]
    for sets, grouping in ((cube_sets, data.cube("a", "b")), (rollup_sets, data.rollup("a", "b"))):
        actual = grouping_sets_by_entity(data, ["a", "b"], sets(["a", "b"]), "s", "n", {"v": F.col("v")})
        assert rows(actual, *columns) == rows(_naive(data, grouping), *columns)


def test_grouping_sets_shuffle_rows_once(spark):
    """Only the entity shuffle is below the expansion; the other one carries partial results."""
    data = spark.range(400).select((F.col("id") % 37).alias("s"), (F.col("id") % 4).alias("a"), "id")
    df = grouping_sets_by_entity(data, ["a"], [("a",), ()], "s", "n", {"v": F.col("id")})
    assert df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 2


def test_grouping_sets_hold_no_row_per_entity_and_set(spark):
    """Above the expansion rows are grouped by their group only; an entity counts once in it, nulls as before."""
    data = spark.createDataFrame([(1, 1, 5), (1, 1, 6), (1, 2, 7), (2, 1, None), (None, 1, 3)], "s int, a int, v int")
    df = grouping_sets_by_entity(data, ["a"], [("a",), ()], "s", "n", {"v": F.col("v")})
    assert rows(df, "a", "total_a", "n", "v") == sorted([(1, False, 2, 14), (2, False, 1, 7), (None, True, 2, 21)], key=repr)
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    above = plan[: plan.index("Generate explode")]
    assert above.count("Aggregate [") == 1 and "s#" not in above.split("Aggregate [", 1)[1].split("]", 1)[0]


def test_keys_are_dense_and_follow_the_natural_key(spark):
    data = spark.range(1000).select(F.format_string("%04d", F.col("id")).alias("nim")).repartition(7)
    numbered = assign_keys(data, ["nim"], "sid", after=5)
    assert rows(numbered, "nim", "sid") == [(f"{n:04d}", n + 6) for n in range(1000)]
    assert dict(numbered.dtypes)["sid"] == "int"


def test_known_keys_stay(spark):
    known = spark.createDataFrame([(4, "b"), (9, "a")], "sid INT, nim STRING")
    extended = extend_keys(known, spark.createDataFrame([("d",), ("c",)], "nim STRING"), ["nim"], "sid")
    assert rows(extended, "nim", "sid") == [("a", 9), ("b", 4), ("c", 10), ("d", 11)]


def test_insert_if_absent_treats_null_as_absent(spark):
    existing = spark.createDataFrame([("x", None), ("y", 1)], "k STRING, j INT")
    source = spark.createDataFrame([("x", None), ("y", 1), ("z", 1)], "k STRING, j INT")
    assert rows(merge.insert_if_absent(source, existing, ["k", "j"])) == [("x", None), ("z", 1)]


def test_insert_or_ignore_keeps_the_existing_row(spark):
    existing = spark.createDataFrame([(1, "old")], "k INT, v STRING")
    batch = spark.createDataFrame([(1, "new"), (2, "new"), (2, "new")], "k INT, v STRING")
    assert rows(merge.insert_or_ignore(batch, existing, ["k"], ["v"])) == [(2, "new")]


def test_the_first_of_a_batch_wins_however_it_is_dealt_out(spark):
    """By arrival, nulls first, then by the other columns; rows with a NULL key equal no other."""
    existing = spark.createDataFrame([(1, 1, 0, "old")], "k INT, j INT, at INT, v STRING")
    batch = [(1, 1, 0, "late"), (2, 1, 5, "b"), (2, 1, 3, "c"), (2, 1, 3, "a"), (3, 1, 1, "x"), (3, 1, None, "y"),
             (None, 1, 1, "n"), (None, 1, 1, "n"), (4, None, 2, "m")]
    expected = sorted([(2, 1, 3, "a"), (3, 1, None, "y"), (None, 1, 1, "n"), (None, 1, 1, "n"), (4, None, 2, "m")], key=repr)
    for turn in range(3):
        dealt = spark.createDataFrame(batch[turn:] + batch[:turn], "k INT, j INT, at INT, v STRING").repartition(turn + 1)
        assert rows(merge.insert_or_ignore(dealt, existing, ["k", "j"], ["at"])) == expected


def test_replace_drops_impacted_keys_without_new_rows(spark):
    existing = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "k INT, v STRING")
    impacted = spark.createDataFrame([(1,), (2,)], "k INT")
    rebuilt = spark.createDataFrame([(1, "A")], "k INT, v STRING")
    assert rows(merge.replace(existing, impacted, rebuilt, "k")) == [(1, "A"), (3, "c")]
