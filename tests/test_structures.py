"""Structures: every query with SQL against DuckDB, and small programs by hand."""

import pytest

from ladderlake.operators import structures as S
from ladderlake.plans import structure_queries

from .test_catalogue import con, same  # noqa: F401


@pytest.mark.parametrize("name", sorted(structure_queries.QUERIES))
def test_query(spark, con, name):  # noqa: F811
    same(spark, con, structure_queries, name)


def program(spark, *texts):
    return spark.createDataFrame([("p", i, t) for i, t in enumerate(texts, 1)], "k string, ln int, line string")


def chosen(spark, *lns):
    return spark.createDataFrame([("p", n) for n in lns], "k string, ln int")


def lns(df):
    got = [r["ln"] for r in df.select("ln").collect()]
    assert len(got) == len(set(got))
    return sorted(got)


def test_statements_over_lines(spark):
    p = program(spark, "a := f(1,", "  2) (* ; *)", " + 3;", "b := (1; // x", "c := 2;", "d := 3", "")
    assert sorted((r["ln"], r["end_ln"]) for r in S.statement_ends(p, ["k"]).collect()) == [(1, 3), (2, 3), (3, 3), (4, 4), (5, 5), (6, 6), (7, 7)]


def test_repairs(spark):
    p = program(spark, "IF a THEN", "x := 1;", "ELSIF b THEN", "IF c", " THEN", "y := 1;", "ELSE", "END_IF;", "ELSE", "z := 1;", "END_IF;", "CASE s OF", "1:", "q := 1;", "END_CASE;", "CASE t OF", "r := 1;", "END_CASE;", "END_IF;", "IF open THEN")
    assert lns(S.repaired_ifs(chosen(spark, 6), p, ["k"])) == [3, 4, 6, 8, 11]
    assert lns(S.repaired_ifs(chosen(spark, 2), p, ["k"], end_ifs=False)) == [1, 2]
    assert lns(S.repaired_ifs(chosen(spark, 10), p, ["k"])) == [10]  # an ELSE's header goes to the next THEN, as an ELSIF's does
    assert lns(S.repaired_cases(chosen(spark, 12, 14, 16, 17, 18), p, ["k"])) == [12, 13, 14, 15, 17]
    assert lns(S.without_empty_cases(chosen(spark, 12, 15, 16, 18), p, ["k"])) == [12, 15]
    assert lns(S.heads_around(chosen(spark, 6), p, ["k"])) == [1, 4, 6]
    assert lns(S.repaired_ifs(chosen(spark), p, ["k"])) == []


def test_ifs_of_which_only_the_else_is_left(spark):
    p = program(spark, "  IF a AND", "  b THEN", "x := 1;", "ELSE", "y := 1;", "END_IF;", "IF c THEN", "z := 1;", "ELSE", "END_IF;", "u := 1;  ")
    text = lambda *n: S.rendered_positive(chosen(spark, *n), p, ["k"]).first()["text"]
    assert text(1, 2, 4, 5, 6, 11) == "  IF NOT(a AND b) THEN\ny := 1;\nEND_IF;\nu := 1;\n"
    assert text(1, 2, 3, 4, 5, 6) == "  IF a AND\n  b THEN\nx := 1;\nELSE\ny := 1;\nEND_IF;\n"
    assert text(7, 8, 9, 10) == "IF c THEN\nz := 1;\nELSE\nEND_IF;\n"


def test_ranges_that_hold_points(spark):
    import random

    rng = random.Random(4)
    ranges = [("p", a, a + rng.randrange(70), i) for i, a in enumerate(rng.sample(range(200), 60))]
    points = [("p", n) for n in range(200)]
    got = S.enclosing(spark.createDataFrame(points, "k string, ln int"), spark.createDataFrame(ranges, "k string, begin_ln int, end_ln int, i int"), ["k"])
    assert sorted((r["ln"], r["i"]) for r in got.collect()) == sorted((n, i) for _, n in points for _, a, b, i in ranges if a <= n <= b)


def test_names_used(spark):
    from pyspark.sql import functions as F

    from ladderlake.functions import code

    cases = {
        "t1(IN := start, PT => out, 5); y := t1.Q AND NOT done;": (["done", "out", "start", "t1", "y"], []),
        "x := MAX(a[i + 1], ABS(b.c)) + INT#3 + T#5s; // z\n(* w *) s := 'it f(x)';": (["a", "b", "i", "s", "x"], ["ABS", "MAX"]),
        "FOR i := 1 TO n BY 2 DO call(i); END_FOR; WHILE (k < 1e5) DO IF f(k) THEN g(); END_IF; END_WHILE;": (["i", "k", "n"], ["f"]),
        "": ([], []),
    }
    df = spark.createDataFrame([(t,) for t in cases], "t string").select("t", code.names_used(F.col("t")).alias("u"))
    assert {r["t"]: (r["u"]["variables"], r["u"]["functions"]) for r in df.collect()} == cases
