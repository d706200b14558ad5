"""The generation loop as a stream with state: replays against the table form, over restarts, and what time ends."""

import json

import pytest

from ladderlake.plans import loop_queries
from ladderlake.streaming import loop

from .test_catalogue import con, same  # noqa: F401


@pytest.mark.parametrize("name", sorted(loop_queries.QUERIES))
def test_query(spark, con, name):  # noqa: F811
    same(spark, con, loop_queries, name)


def attempt(task, seq, passed, at):
    return {"task": task, "seq": seq, "code": f"{task}{seq}", "thought": "t", "passed": passed, "error": None if passed else f"e{seq}", "ts": f"2024-01-01T{at}:00Z"}


def seen(df):
    return sorted((r["kind"], r["task"], r["output"] or "", r["retries"], r["rejected"] or "", [(s["code"], s["error"]) for s in r["samples"] or []]) for r in df.collect())


def test_a_replay_over_restarts_is_the_table_form(spark, tmp_path):
    arrived, out, state = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "state")
    (tmp_path / "in").mkdir()
    batches = [
        [attempt("a", 1, False, "10:00"), attempt("b", 1, True, "10:00"), attempt("c", 2, False, "10:01"), attempt("c", 1, False, "10:00"), attempt("w", 1, False, "10:00")],
        [attempt("a", 2, False, "10:05"), attempt("b", 2, False, "10:05"), attempt("c", 3, False, "10:05")],
        [attempt("a", 3, True, "10:10"), attempt("c", 4, True, "10:10"), attempt("b", 3, True, "10:10")],
    ]
    for i, rows in enumerate(batches):
        (tmp_path / "in" / f"{i}.json").write_text("\n".join(map(json.dumps, rows)))
        loop.replay(loop.read_attempts(spark, arrived), out, state)
    table = spark.read.schema(loop.ATTEMPT).json(arrived)
    assert seen(spark.read.schema(loop.RECORD).parquet(out)) == seen(loop.records(table))
    assert seen(loop.records(table)) == [("dpo", "a", "a3", None, "a2", []), ("failed", "c", "", None, "", [("c1", "e1"), ("c2", "e2"), ("c3", "e3")]), ("sft", "a", "a3", 2, "", []), ("sft", "b", "b1", 0, "", [])]
    # a task that waits too long ends as failed, once time has gone on
    for i, at in enumerate(["15:00", "15:01"]):
        (tmp_path / "in" / f"z{i}.json").write_text(json.dumps(attempt(f"z{i}", 1, True, at)))
        loop.replay(loop.read_attempts(spark, arrived), out, state)
    assert ("failed", "w", "", None, "", [("w1", "e1")]) in seen(spark.read.schema(loop.RECORD).parquet(out))


def test_examples_are_the_last_ones(spark, tmp_path):
    from pyspark.sql import functions as F

    (tmp_path / "in").mkdir()
    got = []
    for i in range(3):
        rows = [{"kind": "sft", "task": f"{i}", "output": "x" * (300 + i)}] * 30 + [{"kind": "sft", "task": "short", "output": "x" * 200}, {"kind": "dpo", "task": "d", "output": "x" * 500}]
        (tmp_path / "in" / f"{i}.json").write_text("\n".join(map(json.dumps, rows)))
        records = spark.readStream.schema(loop.RECORD).json(str(tmp_path / "in"))
        loop.with_rocks(spark, lambda: loop.golden(records, F.lit("all")).writeStream.option("checkpointLocation", str(tmp_path / "state")).foreachBatch(lambda df, _: got.append(sorted((r["place"], r["task"]) for r in df.collect()))).trigger(availableNow=True).start().awaitTermination())
    last = [x for x in got if x][-1]
    assert [t for _, t in last] == ["1"] * 20 + ["2"] * 30
