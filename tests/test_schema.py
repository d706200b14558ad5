"""Types of JSON records by key."""

import pytest

from pyspark.sql import functions as F

from ladderlake.operators import schema
from ladderlake.plans import schema_queries
from ladderlake.sources import json_arrays

from .test_catalogue import con, same  # noqa: F401


@pytest.mark.parametrize("name", sorted(schema_queries.QUERIES))
def test_query(spark, con, name):  # noqa: F811
    same(spark, con, schema_queries, name)


def test_types_by_key(spark):
    lines = ['{"a": 1, "b": null}', '{"a": 2.5, "b": "x", "é": [1]}', "", '{"b": {"c": 1}}', '{"a": true, "b": null, "é": []}', "[1]", "3", "{bad", '{"a": 1, "b": {}}', None]
    df = spark.createDataFrame([("f", i, t) for i, t in enumerate(lines)] + [("g", 0, '{"a": "other file"}')], "file string, line int, text string")
    got = schema.drifts(schema.key_types(df, "file", "line", "text")).drop("preview").collect()
    assert sorted(map(tuple, got)) == [("f", 3, "b", "str", "dict"), ("f", 4, "a", "num", "bool"), ("f", 8, "a", "bool", "num")]
    assert sorted(map(tuple, schema.line_faults(df, "file", "line", "text").collect())) == [("f", 5, "not an object"), ("f", 6, "not an object"), ("f", 7, "not JSON")]


def test_arrays_are_those_of_one_dump_a_file(spark, tmp_path):
    import json
    import os

    path = str(tmp_path / "out")
    rows = [("a/b", "golden", i, f"é {i}\n", {"x": i} if i % 2 else None) for i in range(7)] + [("c", "golden", 0, None, {}), ("c", "bad one", 1, "", {"y": 1})]
    df = spark.createDataFrame(rows, "src_stem string, quality string, place int, text string, more map<string,int>").repartition(5)
    json_arrays.write_arrays(df, path)
    for stem, quality, name in [("a/b", "golden", "a%2Fb/golden.json"), ("c", "golden", "c/golden.json"), ("c", "bad one", "c/bad one.json")]:
        want = [{"text": r[3], "more": r[4]} for r in rows if r[:2] == (stem, quality)]
        assert open(f"{path}/{name}", encoding="utf-8").read() == json.dumps(want, ensure_ascii=False, indent=2)
    json_arrays.write_arrays(df.filter("src_stem = 'c'").drop("quality"), path, status=None, name="augmented_golden")
    assert sorted(os.path.relpath(os.path.join(d, f), path) for d, _, fs in os.walk(path) for f in fs if not f.startswith(".")) == ["c/augmented_golden.json"]
    with pytest.raises(Exception):
        json_arrays.write_arrays(df.withColumn("place", F.raise_error(F.lit("lost")).cast("int")), path)
    assert sorted(os.listdir(path)) == ["c"]


def test_a_cache_gives_what_is_asked_for_and_mends_what_is_broken(spark, tmp_path):
    import glob
    import os

    from ladderlake.sources import records

    path, made = str(tmp_path / "cache"), []

    def make(df):
        return df.select("*", F.length("code").alias("n"))

    def ask(*codes):
        got = records.cached(spark.createDataFrame([(c,) for c in codes], "code string").coalesce(1), path, "1", "code", make)
        return sorted((r["code"], r["n"]) for r in got.collect())

    assert ask("a", "bb", "a") == [("a", 1), ("bb", 2)]
    assert ask("ccc") == [("ccc", 3)]  # not what else is there
    files = lambda: {f for f in glob.glob(f"{path}/**/*.parquet", recursive=True) if os.path.getsize(f)}
    before = files()
    assert ask("a", "bb", "ccc") == [("a", 1), ("bb", 2), ("ccc", 3)]
    table = spark.read.parquet(f"{path}/version=1")
    assert table.count() == 3  # nothing was worked out again
    broken = next(f for f in before if spark.read.parquet(f).filter("code = 'ccc'").count())
    os.remove(os.path.join(os.path.dirname(broken), f".{os.path.basename(broken)}.crc"))
    open(broken, "wb").write(b"no parquet here, but some bytes")
    assert ask("a", "ccc") == [("a", 1), ("ccc", 3)]
    assert ask("bb") == [("bb", 2)] and not made
