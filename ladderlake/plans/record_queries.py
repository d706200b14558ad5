"""Queries through sinks, caches and registered functions, with SQL for what has to come back."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import registered
from ..operators import cleaning
from ..operators import programs as P
from ..sources import records as R
from .catalogue import D_STATUS, _code
from .program_queries import _given, _programs

QUERIES: dict = {}
ORACLE_SQL: dict = {}


def query(sql: str):
    def add(f):
        QUERIES[f.__name__], ORACLE_SQL[f.__name__] = f, sql
        return f

    return add


def _cleaned(spark, sf_dir):
    return cleaning.funneled(_code(spark, sf_dir).withColumn("src_stem", F.concat(F.lit("f"), F.col("p_partkey") % 5)))


@query(f"SELECT 'f' || (p_partkey % 5) AS src_stem, quality, count(*) AS n, CAST(sum(p_partkey) AS BIGINT) AS keys FROM {D_STATUS} s GROUP BY ALL")
def records_by_status(spark, sf_dir):
    """The funnel's records, written for each file and status and read again."""
    folder = R.work_folder(spark, "by-status")
    R.write_by_status(_cleaned(spark, sf_dir), folder)
    back = spark.read.schema("p_partkey long, code string, error string, was_repaired boolean, src_stem string, quality string").json(folder)
    return back.groupBy("src_stem", "quality").agg(F.count("*").alias("n"), F.sum("p_partkey").alias("keys"))


@query(f"SELECT CAST(5 AS BIGINT) AS processed_files, count(*) AS total_samples, count(*) FILTER (quality = 'golden') AS golden, count(*) FILTER (quality = 'syntax_error') AS syntax_error, count(*) FILTER (quality = 'basic_error') AS basic_error, count(*) FILTER (quality = 'empty') AS empty FROM {D_STATUS} s")
def funnel_counters(spark, sf_dir):
    return cleaning.counters(_cleaned(spark, sf_dir))


@query("SELECT user_id, count(*) AS n, '[' || string_agg('{\"e\":' || event_id || '}', ',' || chr(10) ORDER BY event_id) || ']' AS array FROM events WHERE event_id % 4 <> 3 GROUP BY user_id")
def jsonl_arrays(spark, sf_dir):
    """A file's lines as an array, without the lines that aren't JSON."""
    line = F.when(F.col("event_id") % 4 == 3, F.lit('{"e":')).otherwise(F.concat(F.lit(' {"e":'), "event_id", F.lit("} ")))
    lines = spark.read.parquet(f"{sf_dir}/events.parquet").select("user_id", "event_id", line.alias("line"))
    return R.arrays_of(lines, ["user_id"], "event_id")


@query("SELECT count(*) AS total_original, count(*) FILTER (p_partkey % 4 = 3) AS parse_errors, true AS adds_up, true AS some, true AS originals_stay FROM part")
def augment_counters(spark, sf_dir):
    """Originals next to their variants. How many variants differ is up to a seeded generator; at most three each."""
    records = _programs(spark, sf_dir).withColumnRenamed("code", "output")
    both = cleaning.with_variants(records, "p_partkey")
    parsed = P.parse(records.withColumnRenamed("output", "code"), ["p_partkey"])
    n = cleaning.variant_counters(both, parsed)
    stay = records.join(both.filter("NOT is_augmented"), ["p_partkey", "output"], "left_anti").count() == 0
    return n.select("total_original", "parse_errors", (F.col("total") == F.col("total_original") + F.col("total_augmented")).alias("adds_up"), F.col("total_augmented").between(1, 3 * (F.col("total_original") - F.col("parse_errors"))).alias("some"), F.lit(stay).alias("originals_stay"))


@query("SELECT kind, CAST(n AS BIGINT) AS n FROM (VALUES ('data', 2), ('control', 3)) v(kind, n)")
def pdg_cache(spark, sf_dir):
    """Edges between lines of the distinct programs, kept by their hash: the second call works out what the first one lacks."""
    folder = R.work_folder(spark, "pdg")
    make = lambda df: P.dependences(df, ["key"])
    code = _programs(spark, sf_dir)
    R.cached(code.filter("p_partkey % 4 < 2"), folder, "1", "code", make)
    edges = R.cached(code, folder, "1", "code", make).filter("src_line <> dst_line").select("key", "src_line", "dst_line", "kind").distinct()
    return edges.groupBy("kind").agg(F.count("*").alias("n"))


@query(_given("status, rd, wr, n_lines, n_calls", "(0, 'success', 'A', 'A,B', 5, 0)", "(1, 'success', 'A', 'B', 8, 2)", "(2, 'success', 'A,B', 'A', 6, 2)", "(3, 'fail', '', '', 3, 0)").replace("n_lines, n_calls FROM part", "CAST(n_lines AS BIGINT) AS n_lines, CAST(n_calls AS BIGINT) AS n_jumps FROM part"))
def sql_functions(spark, sf_dir):
    """What the registered functions give in SQL: reads, writes, lines, and jumps of the three-address code."""
    registered.register(spark)
    programs = _programs(spark, sf_dir)
    sql = """SELECT p_partkey, st_parse(code).status AS status, array_join(st_read_vars(code), ',') AS rd, array_join(st_write_vars(code), ',') AS wr FROM {programs}"""
    lines = spark.sql("SELECT p_partkey, count(*) AS n_lines FROM {programs}, LATERAL st_lines(code) GROUP BY p_partkey", programs=programs)
    jumps = spark.sql("SELECT p_partkey, count(*) AS n_jumps FROM {programs}, LATERAL st_ir(code) i WHERE i.op IN ('branch', 'goto') GROUP BY p_partkey", programs=programs)
    out = spark.sql(sql, programs=programs).join(lines.hint("merge"), "p_partkey").join(jumps.hint("merge"), "p_partkey", "left")
    return out.select("p_partkey", "status", "rd", "wr", "n_lines", F.coalesce("n_jumps", F.lit(0).cast("long")).alias("n_jumps"))
