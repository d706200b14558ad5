"""Operators on programs against an interpreter, brute force and hand-made cases; sources and streaming."""

import copy
import itertools
import json
import random

import duckdb
import pytest

from ladderlake.operators import programs as P
from ladderlake.plans import program_queries
from ladderlake.programs import dependence as D
from ladderlake.programs import graphical, rewrite, syntax, text

SF = "/root/testdata/sf0.001"
OPS = {"+": lambda a, b: a + b, "-": lambda a, b: a - b, "*": lambda a, b: a * b, "<": lambda a, b: a < b, ">": lambda a, b: a > b, "=": lambda a, b: a == b, "AND": lambda a, b: a and b, "OR": lambda a, b: a or b}


class Leave(Exception):
    pass


def value(e, env):
    k = e["kind"]
    if k == "literal":
        return {"TRUE": True, "FALSE": False}.get(e["text"].upper(), None) if e["text"].isalpha() else int(e["text"])
    if k == "name":
        return env.get(e["base"].upper(), 0)
    if k == "unary":
        return not value(e["of"], env) if e["op"] == "NOT" else -value(e["of"], env)
    return OPS[e["op"]](value(e["left"], env), value(e["right"], env))


def run(body, env):
    for s in body:
        k = s["kind"]
        if k == "assign":
            env[s["target"]["base"].upper()] = value(s["value"], env)
        elif k == "if":
            for b in s["branches"]:
                if value(b["cond"], env):
                    run(b["body"], env)
                    break
            else:
                run(s["orelse"] or [], env)
        elif k == "case":
            v = value(s["of"], env)
            for e in s["entries"]:
                if any(value(x[0], env) <= v <= value(x[-1], env) for x in e["labels"]):
                    run(e["body"], env)
                    break
            else:
                run(s["orelse"] or [], env)
        elif k == "for":
            v, stop, step = value(s["start"], env), value(s["stop"], env), value(s["step"], env) if s["step"] else 1
            env[s["var"].upper()] = v
            try:
                while (env[s["var"].upper()] <= stop) if step > 0 else (env[s["var"].upper()] >= stop):
                    run(s["body"], env)
                    env[s["var"].upper()] += step
            except Leave:
                pass
        elif k == "exit":
            raise Leave
        else:
            raise AssertionError(k)
    return env


def made(rng, depth=0):
    """Random statements without endless loops."""
    v = lambda: rng.choice(["aa", "bb", "cc", "dd"])
    x = lambda: rng.choice([v(), str(rng.randrange(4)), f"{v()} {rng.choice('+-*')} {v()}"])
    c = lambda: rng.choice([f"{v()} < {x()}", f"NOT ({v()} > 2)", f"{v()} = 1 OR {v()} > 1"])
    out = []
    for _ in range(rng.randrange(1, 4)):
        k = rng.randrange(7 if depth < 2 else 3)
        inner = lambda: made(rng, depth + 1)
        out.append([f"{v()} := {x()};"] * 3 + [f"IF {c()} THEN {inner()} ELSIF {c()} THEN {inner()} ELSE {inner()} END_IF;", f"IF {c()} THEN {inner()} ELSE {inner()} END_IF;", f"CASE {v()} OF 0, 2: {inner()} 3..5: {inner()} ELSE {inner()} END_CASE;", f"FOR i{depth} := 1 TO 3 DO {inner()} IF {c()} THEN EXIT; END_IF; END_FOR;"] if depth < 2 else [f"{v()} := {x()};"] * 3)
        out[-1] = out[-1][k]
    return "\n".join(out)


def program(seed):
    return f"PROGRAM p\nVAR aa, bb, cc, dd, i0, i1 : INT; END_VAR\n{made(random.Random(seed))}\nEND_PROGRAM"


def bare(x):
    if isinstance(x, dict):
        return {k: bare(v) for k, v in x.items() if k not in ("line", "end")}
    return [bare(v) for v in x] if isinstance(x, list) else x


INPUTS = [{"AA": a, "BB": b, "CC": c, "DD": 1} for a, b, c in itertools.product((0, 1, 3), repeat=3)]


@pytest.mark.parametrize("seed", range(40))
def test_round_trip_and_variants_compute_the_same(seed):
    trees = syntax.parse(program(seed))
    assert bare(syntax.parse(text.unparse(trees))) == bare(trees)
    before = copy.deepcopy(trees)
    for u in before:
        rng = random.Random(seed)
        for s in list(rewrite.statements(u["body"])):
            for e in syntax.expressions(s):
                rewrite.commute(e, rng)
            rewrite.invert(s, rng)
        rewrite.reorder(u["body"], rng)
    for env in INPUTS:
        assert run(before[0]["body"], dict(env)) == run(trees[0]["body"], dict(env))


@pytest.mark.parametrize("seed", range(40))
def test_slices_keep_the_value(seed):
    u = syntax.parse(program(seed))[0]
    for s in D.slices(u):
        again = syntax.parse(text.unit(s["unit"]))[0]
        for env in INPUTS:
            assert run(again["body"], dict(env)).get(s["var"]) == run(u["body"], dict(env)).get(s["var"])


@pytest.mark.parametrize("seed", range(20))
def test_flow_against_plain_search(seed):
    c = D.Code(syntax.parse(program(seed))[0])
    succ, rows = c.successors(), c.rows
    n = len(rows)

    def reach(a, without=-1):
        seen, todo = set(), [x for x in succ[a] if x != without]
        while todo:
            x = todo.pop()
            if x not in seen:
                seen.add(x)
                todo += [y for y in succ[x] if y != without]
        return seen

    pd = D.post_dominators(succ)
    for i in range(n):
        assert {y for y in range(n) if pd[i] >> y & 1} == {i} | {y for y in range(n) if y != i and i != n - 1 and n - 1 not in ({n - 1} & reach(i, y) if y != n - 1 else set())}
    for d, x, v in D.def_use(c):
        assert v in rows[d]["writes"] and v in rows[x]["reads"]
    for d in range(n):
        for v in rows[d]["writes"]:
            seen, todo, uses = set(), list(succ[d]), set()
            while todo:
                i = todo.pop()
                if i in seen:
                    continue
                seen.add(i)
                uses |= {i} if v in rows[i]["reads"] else set()
                if v not in rows[i]["writes"] or rows[i]["weak"]:
                    todo += succ[i]
            assert uses == {x for e, x, w in D.def_use(c) if e == d and w == v}


def test_rename_reaches_every_place():
    t = syntax.parse("FUNCTION_BLOCK f\nVAR Count : INT := Start; Start : INT; arr : ARRAY[1..Start] OF INT; Timer : TON; END_VAR\nVAR_EXTERNAL Outer : INT; END_VAR\nFOR Count := 1 TO 3 DO arr[COUNT] := Outer; END_FOR;\nTimer(IN := Timer.Q, PT := T#1s);\nEND_FUNCTION_BLOCK")
    rewrite.rename(t[0], random.Random(1), share=1.0)
    out = text.unparse(t)
    for name in ("Count", "COUNT", "Start", "arr", "Timer"):
        assert name not in out.replace("VAR_EXTERNAL", "")
    assert "Outer" in out and ".Q" in out and not D.undeclared(t[0])


@pytest.mark.parametrize("code", ["PROGRAM p x := ; END_PROGRAM", "PROGRAM p END_PROGRAM trailing", "some prose", "PROGRAM p IF a THEN END_PROGRAM", "PROGRAM p VAR x INT; END_VAR END_PROGRAM", "x := 'open", "PROGRAM p " + "IF a THEN " * 3000 + "END_PROGRAM", "PROGRAM p x := " + "(" * 3000 + "; END_PROGRAM", "PROGRAM", "TYPE", "CONFIGURATION c", "PROGRAM p f(a"])
def test_faults(code):
    with pytest.raises(syntax.SyntaxFault):
        syntax.parse(code)


def test_precedence():
    show = lambda e: text.expr(syntax.parse(f"PROGRAM p x := {e}; END_PROGRAM")[0]["body"][0]["value"])
    assert show("a * b / c / d") == "(a * (b / (c / d)))"
    assert show("a XOR b OR c AND NOT d") == "(a XOR (b OR (c AND (NOT d))))"
    assert show("-a ** b + c = d & e") == "((((-a) ** b) + c) = d)".join(["(", " AND e)"])


def test_constructs_and_diagrams():
    code = "TYPE Color : (Red, Green); Pt : STRUCT x : INT; END_STRUCT; END_TYPE\nVAR_GLOBAL CONSTANT G : INT := 1; END_VAR\nFUNCTION F1 : REAL\nVAR_INPUT a AT %IX0.0 : BOOL; END_VAR\na := b := c; p^.x[1, 2].y := INT#5; t(IN := a, NOT Q => q, ET => e); REPEAT RETURN; UNTIL a < b END_REPEAT; F1 := LIMIT(0, c, 16#FF) + 1.5E3; IF a < b THEN x := 1; ELSE x := 2; END_IF; c += 2;\nEND_FUNCTION\nCONFIGURATION c RESOURCE r ON x END_RESOURCE END_CONFIGURATION"
    trees = syntax.parse(code)
    assert [t["kind"] for t in trees] == ["types", "globals", "function"] and trees[0]["names"] == ["Color", "Pt"]
    assert bare(syntax.parse(text.unparse(trees))) == bare(trees)
    fbd, drawn, skipped = graphical.diagram(trees, "FBD")
    assert (drawn, skipped) == (7, 1) and not graphical.faults(fbd) and 'typeName="LT"' in fbd and "SEL" in fbd
    assert not graphical.faults(graphical.to_ladder(fbd))
    ld, drawn, skipped = graphical.diagram(trees, "LD")
    assert (drawn, skipped) == (6, 2) and not graphical.faults(ld)
    assert graphical.faults("<a") and graphical.faults("<a/>") and graphical.faults(fbd.replace('refConnectionPointOutId="2"', 'refConnectionPointOutId="999"'))
    assert D.writes({"kind": "call", "name": {"kind": "name", "base": "t", "access": []}, "args": []}) == {"T"}


def test_rows_without_programs(spark):
    df = spark.createDataFrame([(1, None), (2, ""), (3, "prose"), (4, "PROGRAM p END_PROGRAM"), (4, "PROGRAM p END_PROGRAM")], "id int, code string")
    got = sorted((r.id, r.status, r.n_units) for r in P.parse(df, ["id"]).collect())
    assert got == [(1, "empty", 0), (2, "empty", 0), (3, "fail", 0), (4, "success", 1), (4, "success", 1)]
    for f in (P.accesses, P.slices, P.def_use, P.clusters, P.symbols):
        assert f(df, ["id"]).count() == 0
    assert P.diagrams(df.limit(0), ["id"]).count() == 0
    assert {r.id for r in P.instructions(df, ["id"]).collect()} == {4}
    with pytest.raises(ValueError):
        P.parse(df.withColumnRenamed("id", "status"), ["status"])


def test_augment_is_repeatable(spark):
    df = spark.createDataFrame([(k, program(k)) for k in range(8)], "id int, code string")
    a, b = (sorted(map(tuple, P.augment(df.repartition(n), "id", ["id"]).collect())) for n in (1, 3))
    assert a == b and len({r[2] for r in a}) == len(a)


@pytest.mark.parametrize("name", sorted(program_queries.ORACLE_SQL))
def test_query(spark, name):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW part AS SELECT * FROM '{SF}/part.parquet'")
    got = program_queries.QUERIES[name](spark, SF)
    columns = sorted(got.columns)
    want = con.execute(f"SELECT {', '.join(columns)} FROM ({program_queries.ORACLE_SQL[name]})").fetchall()
    assert sorted(map(tuple, got.select(*columns).collect()), key=str) == sorted(want, key=str)


def test_records(spark, tmp_path):
    from ladderlake.sources import records as R

    (tmp_path / "a.ST").write_bytes("﻿PROGRAM p\r\nEND_PROGRAM".encode())
    assert [r.code for r in R.read_code(spark, str(tmp_path)).collect()] == ["PROGRAM p\nEND_PROGRAM"]
    rows = [{"prompt": "p", "chosen": None, "rejected": "r", "metadata": {"k": "v"}}, {"prompt": "é", "chosen": "", "rejected": None, "metadata": None}]
    R.write_jsonl(spark.createDataFrame(rows, R.DPO), str(tmp_path / "out"))
    back = R.read_jsonl(spark, str(tmp_path / "out"), R.DPO)
    assert sorted((r.prompt, r.chosen, r.rejected) for r in back.collect()) == [("p", None, "r"), ("é", "", None)]
    (tmp_path / "x.jsonl").write_text('{"prompt": "a"}\nbroken\n')
    assert {(r.prompt, r.bad_line) for r in R.read_jsonl(spark, str(tmp_path / "x.jsonl"), R.DPO).collect()} == {("a", None), (None, "broken")}
    (tmp_path / "y.json").write_text(json.dumps(rows))
    assert R.read_json_arrays(spark, str(tmp_path / "y.json"), R.DPO).count() == 2


def test_streamed_funnel(spark, tmp_path):
    from ladderlake.streaming import funnel as S

    good = "FUNCTION_BLOCK f\nVAR x : INT; END_VAR\nx := 1;\nEND_FUNCTION_BLOCK"
    folder = tmp_path / "in"
    folder.mkdir()
    for n, rows in enumerate([[("a", good), ("b", "import os"), ("a", good)], [("a", good), ("c", "x = y;")]]):
        (folder / f"{n}.json").write_text("".join(json.dumps({"task": t, "code": c, "ts": f"2024-01-01T00:00:0{n}"}) + "\n" for t, c in rows))
        S.write_stream(S.funnel(S.read_stream(spark, str(folder))), str(tmp_path / "out"), str(tmp_path / "ckpt"), once=True).awaitTermination()
    assert sorted((r.task, r.quality) for r in spark.read.parquet(str(tmp_path / "out")).collect()) == [("a", "golden"), ("b", "empty"), ("c", "basic_error")]
