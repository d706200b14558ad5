"""Queries of the operators on programs. The programs are four shapes picked by p_partkey; their SQL lists by hand what each shape has to give."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import programs as P
from ..operators.tables import spread

PROGRAMS = """SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN concat_ws(chr(10), 'PROGRAM p', 'VAR a, b : INT; END_VAR', 'a := 1;', 'b := a + 2;', 'END_PROGRAM') WHEN 1 THEN concat_ws(chr(10), 'PROGRAM p', 'VAR a, b : INT; END_VAR', 'IF a > 1 THEN', 'b := a;', 'ELSE', 'b := 2;', 'END_IF;', 'END_PROGRAM') WHEN 2 THEN concat_ws(chr(10), 'PROGRAM p', 'VAR a, b : INT; END_VAR', 'WHILE a < 5 DO', 'a := a + b;', 'END_WHILE;', 'END_PROGRAM') ELSE concat_ws(chr(10), 'PROGRAM p', 'a = 1;', 'END_PROGRAM') END AS code FROM {part}"""
QUERIES: dict = {}
ORACLE_SQL: dict = {}


def _given(columns: str, *rows: str) -> str:
    """SQL: each part's rows among those of its shape k."""
    return f"SELECT p_partkey, {columns} FROM part JOIN (VALUES {', '.join(rows)}) v(k, {columns}) ON p_partkey % 4 = k"


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


def _programs(spark, sf_dir):
    part = spread(spark.read.parquet(f"{sf_dir}/part.parquet").select("p_partkey"), "p_partkey")
    return spark.sql(PROGRAMS, part=part)


def _joined(*columns: str):
    return [F.array_join(c, ",").alias(c) for c in columns]


@query(_given("status, n_units", "(0, 'success', 1)", "(1, 'success', 1)", "(2, 'success', 1)", "(3, 'fail', 0)").replace("n_units FROM", "CAST(n_units AS BIGINT) AS n_units FROM", 1))
def st_parse_status(spark, sf_dir):
    return P.parse(_programs(spark, sf_dir), ["p_partkey"]).select("p_partkey", "status", "n_units")


_HEAD = "'PROGRAM p', 'VAR', '    a, b : INT;', 'END_VAR'"


@query(_given("unparsed", f"(0, concat_ws(chr(10), {_HEAD}, '    a := 1;', '    b := (a + 2);', 'END_PROGRAM'))", f"(1, concat_ws(chr(10), {_HEAD}, '    IF (a > 1) THEN', '        b := a;', '    ELSE', '        b := 2;', '    END_IF;', 'END_PROGRAM'))", f"(2, concat_ws(chr(10), {_HEAD}, '    WHILE (a < 5) DO', '        a := (a + b);', '    END_WHILE;', 'END_PROGRAM'))"))
def st_roundtrip(spark, sf_dir):
    return P.unparsed(_programs(spark, sf_dir), ["p_partkey"])


@query(_given("line, reads, writes", "(0, 3, '', 'A')", "(0, 4, 'A', 'B')", "(1, 3, 'A', 'B')", "(1, 4, 'A', 'B')", "(1, 6, '', 'B')", "(2, 3, 'A,B', 'A')", "(2, 4, 'A,B', 'A')"))
def st_accesses(spark, sf_dir):
    return P.accesses(_programs(spark, sf_dir), ["p_partkey"]).select("p_partkey", "line", *_joined("reads", "writes"))


@query(_given("name, storage, type", "(0, 'a', 'VAR', 'INT')", "(0, 'b', 'VAR', 'INT')", "(1, 'a', 'VAR', 'INT')", "(1, 'b', 'VAR', 'INT')", "(2, 'a', 'VAR', 'INT')", "(2, 'b', 'VAR', 'INT')"))
def st_symbols(spark, sf_dir):
    return P.symbols(_programs(spark, sf_dir), ["p_partkey"]).select("p_partkey", "name", "storage", "type")


@query(_given("op, line, block", "(0, 'assign', 3, 0)", "(0, 'binary', 4, 0)", "(0, 'assign', 4, 0)", "(0, 'end', 5, 0)", "(1, 'binary', 3, 0)", "(1, 'branch', 3, 0)", "(1, 'assign', 4, 1)", "(1, 'goto', 4, 1)", "(1, 'assign', 6, 2)", "(1, 'end', 8, 3)", "(2, 'binary', 3, 0)", "(2, 'branch', 3, 0)", "(2, 'binary', 4, 1)", "(2, 'assign', 4, 1)", "(2, 'goto', 3, 1)", "(2, 'end', 6, 2)"))
def st_instructions(spark, sf_dir):
    return P.instructions(_programs(spark, sf_dir), ["p_partkey"]).select("p_partkey", "op", "line", "block")


@query(_given("var, def_line, use_line", "(0, 'A', 3, 4)", "(2, 'A', 4, 3)", "(2, 'A', 4, 4)"))
def def_use_edges(spark, sf_dir):
    return P.def_use(_programs(spark, sf_dir), ["p_partkey"]).filter("var IN ('A', 'B')").select("p_partkey", "var", "def_line", "use_line")


@query(_given("src_line, dst_line, kind", "(0, 3, 4, 'data')", "(1, 3, 4, 'control')", "(1, 3, 6, 'control')", "(2, 4, 3, 'data')", "(2, 3, 4, 'control')"))
def pdg_edges(spark, sf_dir):
    e = P.dependences(_programs(spark, sf_dir), ["p_partkey"]).filter("src_line <> dst_line")
    return e.select("p_partkey", "src_line", "dst_line", "kind").distinct()


@query(_given("var, lines", "(0, 'A', '3')", "(0, 'B', '3,4')", "(1, 'B', '3,4,6')", "(2, 'A', '3,4')"))
def pdg_slice(spark, sf_dir):
    return P.slices(_programs(spark, sf_dir), ["p_partkey"]).select("p_partkey", "var", *_joined("lines"))


@query(_given("vars, lines", "(0, 'A,B', '3,4')", "(1, 'B', '3,4,6')", "(2, 'A', '3,4')"))
def block_cluster(spark, sf_dir):
    return P.clusters(_programs(spark, sf_dir), ["p_partkey"]).select("p_partkey", *_joined("vars", "lines"))


_DRAWN = "SELECT p_partkey, CAST(n_drawn AS BIGINT) AS n_drawn, CAST(n_skipped AS BIGINT) AS n_skipped, true AS sound FROM part JOIN (VALUES {}) v(k, n_drawn, n_skipped) ON p_partkey % 4 = k"


@query(_DRAWN.format("(0, 2, 0), (1, 1, 0), (2, 0, 1)"))
def fbd_xml(spark, sf_dir):
    return P.diagrams(_programs(spark, sf_dir), ["p_partkey"], "FBD").select("p_partkey", "n_drawn", "n_skipped", (F.size("faults") == 0).alias("sound"))


@query(_DRAWN.format("(0, 2, 0), (1, 0, 1), (2, 0, 1)"))
def ld_xml(spark, sf_dir):
    return P.diagrams(_programs(spark, sf_dir), ["p_partkey"], "LD").select("p_partkey", "n_drawn", "n_skipped", (F.size("faults") == 0).alias("sound"))


@query("SELECT p_partkey, CAST(n AS BIGINT) AS rungs, true AS sound FROM part JOIN (VALUES (0, 2), (1, 1), (2, 0)) v(k, n) ON p_partkey % 4 = k")
def fbd_to_ld(spark, sf_dir):
    fbd = P.diagrams(_programs(spark, sf_dir), ["p_partkey"], "FBD")
    return P.to_ladder(fbd, ["p_partkey"]).select("p_partkey", F.regexp_count("ladder", F.lit("<Rung ")).cast("long").alias("rungs"), (F.size("ladder_faults") == 0).alias("sound"))


@query()
def st_augment(spark, sf_dir):
    """Rows only: variants come from a seeded generator; tests hold their meaning."""
    return P.augment(_programs(spark, sf_dir), "p_partkey", ["p_partkey"])
