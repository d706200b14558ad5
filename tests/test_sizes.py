"""What has to hold so that queries on small files of many programs finish: work is dealt out, lines aren't broadcast, equal texts are worked on once."""

import pytest
from pyspark.sql import functions as F

from ladderlake.operators import blocks, programs
from ladderlake.operators.tables import spread
from ladderlake.plans import block_queries, program_queries
from ladderlake.programs import syntax

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ["split_by_size", "split_by_stage", "blocks_without_empty"])
def test_no_lines_are_broadcast(spark, name):
    plan = block_queries.QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastExchange" not in plan


@pytest.mark.parametrize("queries, names", [(block_queries, ["structure_ends", "clamped_depth", "meaningful_blocks"]), (program_queries, list(program_queries.QUERIES))])
def test_programs_are_dealt_out(spark, queries, names):
    for name in names:
        plan = queries.QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
        assert "REPARTITION_BY_NUM" in plan, name


def test_spread(spark):
    assert spread(spark.range(100).coalesce(1), "id").rdd.getNumPartitions() >= 4 * spark.sparkContext.defaultParallelism


def test_equal_texts_are_worked_on_once(spark):
    done = spark.sparkContext.accumulator(0)

    def make(code):
        done.add(1)
        yield (code,)

    df = spark.createDataFrame([(i, None if i % 3 == 0 else "x" * (i % 3)) for i in range(300)], "k int, code string").coalesce(1)
    got = programs._flat(df, ["k"], "same string", make).collect()
    assert {r["k"]: r["same"] for r in got} == {i: None if i % 3 == 0 else "x" * (i % 3) for i in range(300)}
    assert done.value == 3


def test_trees_are_the_callers_own():
    code = "PROGRAM p\nVAR a : INT; END_VAR\na := 1;\nEND_PROGRAM"
    one = syntax.trees(code)
    assert one == syntax.parse(code) and syntax.trees("a = 1;") == syntax.trees(None) == []
    one[0]["name"] = "q"
    assert syntax.trees(code) == syntax.parse(code)


def test_splits_keep_columns_and_blocks_that_are_short(spark):
    df = blocks.lines_of(spark.createDataFrame([(1, "a;\nb;"), (2, "IF stage = 1 THEN\n" * 2 + "x;\n" * 9), (3, "")], "k int, code string"))
    by_stage = blocks.split_by_stage(df, ["k"], 4).groupBy("k", "part").agg(F.count("*").alias("n"))
    assert {tuple(r) for r in by_stage.collect()} == {(1, 1, 2), (2, 2, 11), (3, 1, 1)}
    by_size = blocks.split_by_size(df, ["k"], 2, 4)
    assert by_size.columns == ["k", "ln", "line", "part"] and by_size.filter("k <> 2").select("k", "ln", "part").distinct().count() == 3
