import random

from pyspark.sql import functions as F

from facetforge.operators.ordering import batch_numbers, number_copies, number_rows, running_totals


def test_number_rows_is_a_global_order(spark):
    values = list(range(5000))
    random.Random(1).shuffle(values)
    df = spark.createDataFrame([(v,) for v in values], "v int").repartition(7)
    numbered = number_rows(df, [F.col("v").desc()]).collect()
    assert {r["v"]: r["row_number"] for r in numbered} == {v: 5000 - v for v in values}


def test_number_rows_of_nothing(spark):
    assert number_rows(spark.range(0), [F.col("id")]).count() == 0


def test_running_totals_match_brute_force(spark):
    draw = random.Random(2)
    values = [(i, draw.randrange(100)) for i in range(3000)]
    df = spark.createDataFrame(values, "k int, v long").repartition(5)
    got = {r["k"]: r["total"] for r in running_totals(df, [F.col("k")], {"total": F.col("v")}).collect()}
    total, wanted = 0, {}
    for k, v in values:
        total += v
        wanted[k] = total
    assert got == wanted


def test_running_totals_of_doubles_and_nulls(spark):
    values = [(3, 0.5, None), (1, 1.5, 2), (2, None, 7)]
    df = spark.createDataFrame(values, "k int, `a.b` double, n int")
    totals = {"x": F.col("`a.b`"), "y": F.col("n")}
    rows = running_totals(df, [F.col("k")], totals).orderBy("k").collect()
    assert [(r["x"], r["y"]) for r in rows] == [(1.5, 2), (1.5, 9), (2.0, 9)]
    assert running_totals(df.limit(0), [F.col("k")], totals).count() == 0


def test_the_ordered_table_is_not_shuffled_again(spark):
    df = spark.range(1000).repartition(5)
    done = running_totals(df, [F.col("id").desc()], {"total": F.col("id")})
    plan = done._jdf.queryExecution().executedPlan().toString()
    # Only the totals of the ranges move; the rows are read and joined by broadcast.
    streamed = plan[: plan.index("BroadcastExchange")]
    assert "BroadcastHashJoin" in streamed and "Exchange hashpartitioning" not in streamed


def test_51_rows_make_batches_of_25_25_1(spark):
    batches = batch_numbers(spark.range(51), [F.col("id")]).groupBy("batch_no").count()
    assert sorted(tuple(r) for r in batches.collect()) == [(1, 25), (2, 25), (3, 1)]


def test_copies_of_a_hot_row_are_numbered_in_runs(spark):
    rows = [("hot", None)] * 1000 + [("a", 1.0)] * 3 + [("b", None)]
    df = spark.createDataFrame(rows, "k string, v double")
    for run_length in (7, 100_000):
        numbered = number_copies(df, run_length=run_length).collect()
        got = sorted((r["k"], r["copy_no"]) for r in numbered)
        wanted = [("a", i) for i in (1, 2, 3)] + [("b", 1)] + [("hot", i) for i in range(1, 1001)]
        assert got == sorted(wanted)
