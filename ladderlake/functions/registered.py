"""Names for SQL: functions and table functions on program texts."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from ..programs import dependence, graphical, syntax, text


def _parsed(code: str | None) -> tuple[str, str | None, str | None]:
    if not code or not code.strip():
        return "empty", None, None
    try:
        return "success", None, json.dumps(syntax.parse(code), ensure_ascii=False)
    except syntax.SyntaxFault as e:
        return "fail", f"Syntax Errors:\n{e}", None


def _names(code: str | None, of) -> list[str]:
    return sorted({v for u in syntax.units_of(syntax.trees(code)) for s in u["body"] for v in of(s)})


def _diagram(code: str | None, language: str) -> str | None:
    trees = syntax.trees(code)
    return graphical.diagram(trees, language)[0] if syntax.units_of(trees) else None


def _batched(one):
    """one, for a batch: equal texts of a batch are worked on once."""

    def batch(codes: pd.Series) -> pd.Series:
        made = {c: one(c) for c in codes.unique()}
        return pd.Series([made[c] for c in codes], dtype=object)

    return batch


class Lines:
    """(ln, line) of a text."""

    def eval(self, code: str) -> Iterator[tuple]:
        yield from enumerate((code or "").split("\n"), 1)


class Tokens:
    """(kind, text, line, col) of a program; none if it holds something that is no token."""

    def eval(self, code: str) -> Iterator[tuple]:
        try:
            found = syntax.tokens(code or "")
        except syntax.SyntaxFault:
            return
        yield from ((t.type, t.text, t.line, t.column) for t in found if t.type != "end")


class Instructions:
    """(unit, idx, op, dest, line) of a program's three-address code."""

    def eval(self, code: str) -> Iterator[tuple]:
        for u in syntax.units_of(syntax.trees(code)):
            for r in dependence.Code(u).rows:
                yield u["name"], r["idx"], r["op"], r["dest"], r["line"]


class Dependences:
    """(unit, src_line, dst_line, kind) of the edges of a program's dependence graph."""

    def eval(self, code: str) -> Iterator[tuple]:
        for u in syntax.units_of(syntax.trees(code)):
            c = dependence.Code(u)
            for a, b, kind in dependence.pdg(c):
                yield u["name"], c.rows[a]["line"], c.rows[b]["line"], kind


def register(spark: SparkSession) -> None:
    """st_parse, st_read_vars, st_write_vars, st_unparse, st_fbd_xml, st_ld_xml work on Arrow batches; st_lines, st_tokens, st_ir, st_pdg are table functions for LATERAL joins."""
    plain = {
        "st_read_vars": ("array<string>", lambda code: _names(code, dependence.reads)),
        "st_write_vars": ("array<string>", lambda code: _names(code, dependence.writes)),
        "st_unparse": ("string", lambda code: text.unparse(t) if (t := syntax.trees(code)) else None),
        "st_fbd_xml": ("string", lambda code: _diagram(code, "FBD")),
        "st_ld_xml": ("string", lambda code: _diagram(code, "LD")),
    }
    for name, (kind, one) in plain.items():
        spark.udf.register(name, F.pandas_udf(_batched(one), kind))

    def parsed(codes: pd.Series) -> pd.DataFrame:
        made = {c: _parsed(c) for c in codes.unique()}
        return pd.DataFrame([made[c] for c in codes], columns=["status", "message", "ast"])

    spark.udf.register("st_parse", F.pandas_udf(parsed, "status string, message string, ast string"))
    for name, kind, schema in (("st_lines", Lines, "ln int, line string"), ("st_tokens", Tokens, "kind string, text string, line int, col int"), ("st_ir", Instructions, "unit string, idx int, op string, dest string, line int"), ("st_pdg", Dependences, "unit string, src_line int, dst_line int, kind string")):
        spark.udtf.register(name, F.udtf(kind, returnType=schema))
