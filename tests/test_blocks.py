"""Queries on lines and standard functions against DuckDB; blocks, prompts and calls on small examples."""

import pytest
from pyspark.sql import functions as F

from ladderlake.functions import prompts, standard
from ladderlake.operators import blocks
from ladderlake.plans import block_queries, record_queries
from ladderlake.sources import records

from .test_catalogue import con, same  # noqa: F401


@pytest.mark.parametrize("name", sorted(block_queries.QUERIES))
def test_query(spark, con, name):  # noqa: F811
    same(spark, con, block_queries, name)


def test_arity_is_checked():
    with pytest.raises(ValueError):
        standard.call("ABS", F.lit(1), F.lit(2))
    with pytest.raises(ValueError):
        standard.call("TON", F.lit(1), F.lit(2))
    assert standard.signatures()["INT_TO_REAL"] == (1, 1) and len(standard.signatures()) > 250


def test_templates(spark):
    row = spark.range(1).select(F.lit("a").alias("x"), F.lit(None).cast("string").alias("n"))
    show = lambda t: row.select(prompts.template(t, x=F.col("x"), n=F.col("n")).alias("t")).first()["t"]
    assert show("[{{ x }}|{{n}}|{{ other }}]\n") == "[a|None|]"
    assert show("{% if x %}yes{% endif %}{% if n %}no{% endif %}{% if other %}no{% endif %}") == "yes"
    with pytest.raises(ValueError):
        show("{% if x %}")
    draws = spark.range(10).select(prompts.evolved(["A {{ task }}", "B {{ task }}"], F.lit("t"), F.col("id") / 10).alias("p")).collect()
    assert [r["p"] for r in draws] == ["A t"] * 4 + ["B t"] * 3 + ["t"] * 3


def test_rendered_blocks(spark):
    df = blocks.lines_of(spark.createDataFrame([(1, "a;\n  b;  \n\n")], "k int, code string"))
    assert blocks.rendered(df, ["k"]).first()["text"] == "a;\n  b;\n"


@pytest.mark.parametrize("name", sorted(record_queries.QUERIES))
def test_record_query(spark, con, name):  # noqa: F811
    same(spark, con, record_queries, name)


def test_json_arrays_and_lines_of_files(spark, tmp_path):
    (tmp_path / "in" / "deep").mkdir(parents=True)
    (tmp_path / "in" / "a.json").write_text('[{"task": "t1", "code": "x"}, {"task": "t2"}]')
    (tmp_path / "in" / "deep" / "b.json").write_text('{"task": "no list"}')
    (tmp_path / "in" / "c.json").write_text("[broken")
    (tmp_path / "in" / "d.txt").write_text('[{"task": "other ending"}]')
    got = records.read_json_arrays(spark, str(tmp_path / "in"), records.GOLDEN)
    assert sorted((r["src_stem"], r["place"], r["task"], r["code"]) for r in got.collect()) == [("a", 0, "t1", "x"), ("a", 1, "t2", None)]
    assert records.read_golden(spark, str(tmp_path / "in")).count() == 2
    (tmp_path / "l").mkdir()
    (tmp_path / "l" / "x.jsonl").write_text('{"a": 1}\n\nbad\n[2]\n')
    assert [(r["src_stem"], r["n"], r["array"]) for r in records.jsonl_to_arrays(spark, str(tmp_path / "l")).collect()] == [("x", 2, '[{"a": 1},\n[2]]')]
    (tmp_path / "t").write_text("  one \n\n two\n")
    assert sorted(r["task"] for r in records.read_tasks(spark, str(tmp_path / "t")).collect()) == ["one", "two"]
    (tmp_path / "p.xml").write_text("<a/>")
    assert records.read_xml(spark, str(tmp_path / "p.xml")).first()["xml"] == "<a/>"
    df = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3)], "src_stem string, n int")
    records.write_by_file(df, str(tmp_path / "out"))
    assert (tmp_path / "out" / "src_stem=a").exists() and spark.read.json(str(tmp_path / "out")).count() == 3
