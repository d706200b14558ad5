"""Operators on a column of Structured Text, in Arrow batches. Each row is worked on by itself, so nothing is shuffled.

Equal texts that a task meets among its last ones are worked on once. Tasks are those of the DataFrame: `tables.spread` deals out a
small file of many short programs.

All take a DataFrame with a text column `code`; `keep` names the columns that go along with each result row. A null or empty
text has status `empty` in `parse` and gives no rows in the others; so does a text that doesn't parse.
"""

from __future__ import annotations

import functools
import json
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from ..programs import dependence, graphical, rewrite, syntax, text

#: Texts worked on before their rows are handed over, so that a batch of long texts isn't held with all its results.
TEXTS_AT_ONCE = 64
#: Results that a task keeps for equal texts to come, and the length of the texts whose results are kept.
KEPT, KEPT_CHARS = 256, 4096


def _flat(df: DataFrame, keep: list[str], fields: str, make: Callable[..., Iterable[tuple]], inputs: tuple[str, ...] = ("code",)) -> DataFrame:
    """The rows that `make` draws from the inputs of each row, next to its kept columns."""
    from pyspark.sql.types import _parse_datatype_string

    new = _parse_datatype_string(fields)
    clash = set(keep) & set(new.names)
    if clash:
        raise ValueError(f"kept columns with names of results: {sorted(clash)}")
    schema = StructType([df.schema[k] for k in keep] + new.fields)
    arrow = to_arrow_schema(new)
    by_text = len(inputs) == 1

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept_rows = functools.lru_cache(KEPT)(lambda given: list(make(given)))
        for b in batches:
            for start in range(0, b.num_rows, TEXTS_AT_ONCE):
                part = b.slice(start, TEXTS_AT_ONCE)
                rows, source = [], []
                for i, given in enumerate(zip(*(part.column(c).to_pylist() for c in inputs))):
                    short = by_text and len(given[0] or "") <= KEPT_CHARS
                    for r in kept_rows(given[0]) if short else make(*given):
                        rows.append(r)
                        source.append(i)
                if rows:
                    kept = part.take(pa.array(source, pa.int64()))
                    cols = [pa.array([r[k] for r in rows], f.type) for k, f in enumerate(arrow)]
                    yield pa.RecordBatch.from_arrays([kept.column(k) for k in keep] + cols, [*keep, *new.names])

    return df.select(*dict.fromkeys([*keep, *inputs])).mapInArrow(work, schema)


def parse(df: DataFrame, keep: list[str]) -> DataFrame:
    """status (success, fail, empty), message, n_units and ast (JSON; null unless success). Text after the last unit is a fault."""

    def make(code):
        if not code or not code.strip():
            yield "empty", None, 0, None
            return
        try:
            trees = syntax.parse(code)
        except syntax.SyntaxFault as e:
            yield "fail", f"Syntax Errors:\n{e}", 0, None
            return
        yield "success", None, len(syntax.units_of(trees)), json.dumps(trees, ensure_ascii=False)

    return _flat(df, keep, "status string, message string, n_units long, ast string", make)


def checked(df: DataFrame, keep: list[str], code: Column) -> DataFrame:
    """df with `_fault`: the parser's message, or null where the code parses or is null."""

    def make(code):
        try:
            if code is not None:
                syntax.parse(code)
        except syntax.SyntaxFault as e:
            yield (f"Syntax Errors:\n{e}",)
        else:
            yield (None,)

    return _flat(df.withColumn("_to_parse", code), keep, "_fault string", make, ("_to_parse",))


def unparsed(df: DataFrame, keep: list[str]) -> DataFrame:
    """The text of each program's tree."""

    def make(code):
        trees = syntax.trees(code)
        if trees:
            yield (text.unparse(trees),)

    return _flat(df, keep, "unparsed string", make)


def symbols(df: DataFrame, keep: list[str]) -> DataFrame:
    """Declared variables of each unit."""

    def make(code):
        for u in syntax.units_of(syntax.trees(code)):
            for s in dependence.symbols(u):
                yield u["name"], s["name"], s["storage"], s["type"], s["is_fb"], s["line"]

    return _flat(df, keep, "unit string, name string, storage string, type string, is_fb boolean, line int", make)


def undeclared(df: DataFrame, keep: list[str]) -> DataFrame:
    """Per unit, the names that are used without a declaration."""

    def make(code):
        for u in syntax.units_of(syntax.trees(code)):
            yield u["name"], dependence.undeclared(u)

    return _flat(df, keep, "unit string, undeclared array<string>", make)


def accesses(df: DataFrame, keep: list[str]) -> DataFrame:
    """Per statement, at all depths in order: what it and the statements in it read and write (names in upper case)."""

    def make(code):
        for u in syntax.units_of(syntax.trees(code)):
            for k, s in enumerate(rewrite.statements(u["body"])):
                yield u["name"], k, s["line"], s["kind"], sorted(dependence.reads(s)), sorted(dependence.writes(s))

    return _flat(df, keep, "unit string, stmt int, line int, kind string, reads array<string>, writes array<string>", make)


def instructions(df: DataFrame, keep: list[str]) -> DataFrame:
    """Three-address code with the flow: successors, and the basic block of each instruction."""

    def make(code):
        for u in syntax.units_of(syntax.trees(code)):
            c = dependence.Code(u)
            succ = c.successors()
            for r, after, b in zip(c.rows, succ, dependence.blocks(succ)):
                yield u["name"], r["idx"], r["op"], r["dest"], r["args"], r["line"], after, b

    return _flat(df, keep, "unit string, idx int, op string, dest string, args array<string>, line int, successors array<int>, block int", make)


def def_use(df: DataFrame, keep: list[str]) -> DataFrame:
    """Definitions that reach a use."""

    def make(code):
        for u in syntax.units_of(syntax.trees(code)):
            c = dependence.Code(u)
            for d, x, v in dependence.def_use(c):
                yield u["name"], v, d, x, c.rows[d]["line"], c.rows[x]["line"]

    return _flat(df, keep, "unit string, var string, def_idx int, use_idx int, def_line int, use_line int", make)


def dependences(df: DataFrame, keep: list[str]) -> DataFrame:
    """Edges of the program dependence graph between instructions, with their lines."""

    def make(code):
        for u in syntax.units_of(syntax.trees(code)):
            c = dependence.Code(u)
            for a, b, kind in dependence.pdg(c):
                yield u["name"], a, b, kind, c.rows[a]["line"], c.rows[b]["line"]

    return _flat(df, keep, "unit string, src int, dst int, kind string, src_line int, dst_line int", make)


def slices(df: DataFrame, keep: list[str]) -> DataFrame:
    """Per unit and written variable: the lines that its value depends on, and these as a program that parses."""

    def make(code):
        for u in syntax.units_of(syntax.trees(code)):
            for s in dependence.slices(u):
                yield u["name"], s["var"], s["lines"], text.unit(s["unit"])

    return _flat(df, keep, "unit string, var string, lines array<int>, slice string", make)


def clusters(df: DataFrame, keep: list[str], share: float = 0.5) -> DataFrame:
    """Per unit: groups of slices that share statements."""

    def make(code):
        for u in syntax.units_of(syntax.trees(code)):
            for k, g in enumerate(dependence.cluster(dependence.slices(u), share)):
                yield u["name"], k, g["vars"], g["lines"], g["n_stmts"]

    return _flat(df, keep, "unit string, cluster int, vars array<string>, lines array<int>, n_stmts int", make)


def augment(df: DataFrame, key: str, keep: list[str], variants: int = 3, seed: int = 0) -> DataFrame:
    """Up to that many different variants of each program, none of them the program's own text. They depend on key and seed only."""

    def make(code, k):
        trees = syntax.trees(code)
        if not syntax.units_of(trees):
            return
        seen = {code.strip(), text.unparse(trees)}
        for n in range(variants):
            made = text.unparse(rewrite.variant(syntax.trees(code), f"{seed}/{k}/{n}"))
            if made not in seen:
                seen.add(made)
                yield n, made

    return _flat(df, keep, "variant int, augmented string", make, ("code", key))


def diagrams(df: DataFrame, keep: list[str], language: str = "FBD") -> DataFrame:
    """XML of each program in FBD or LD, how many top statements it draws, how many it can't, and faults of its structure."""

    def make(code):
        trees = syntax.trees(code)
        if syntax.units_of(trees):
            xml, drawn, skipped = graphical.diagram(trees, language)
            yield xml, drawn, skipped, graphical.faults(xml)

    return _flat(df, keep, "xml string, n_drawn long, n_skipped long, faults array<string>", make)


def to_ladder(df: DataFrame, keep: list[str]) -> DataFrame:
    """LD of a column `xml` of FBD projects, with faults of the structure. XML that isn't well-formed has a null `ladder` and a fault."""

    def make(xml):
        if xml:
            try:
                ladder = graphical.to_ladder(xml)
            except graphical.ET.ParseError as e:
                yield None, [f"FATAL: {e}"]
            else:
                yield ladder, graphical.faults(ladder)

    return _flat(df, keep, "ladder string, ladder_faults array<string>", make, ("xml",))
