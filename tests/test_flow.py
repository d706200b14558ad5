"""Flow of programs: every query with SQL against DuckDB, and solved sets against walks through random programs."""

import random

import duckdb
import pytest

from ladderlake.operators import flow
from ladderlake.plans import flow_queries

from .test_catalogue import con, same  # noqa: F401

SCHEMA = "k string, ip long, op string, label string, target string, other string, defs array<string>, uses array<string>, src int, node string"


@pytest.mark.parametrize("name", sorted(flow_queries.QUERIES))
def test_query(spark, con, name):  # noqa: F811
    same(spark, con, flow_queries, name)


def programs(seed, sizes):
    rng = random.Random(seed)
    out = []
    for p, n in enumerate(sizes):
        for ip in range(n):
            op = rng.choice(["branch", "goto", "assign", "assign", "assign", "assign"])
            to = lambda: f"L{min(n - 1, max(0, ip + rng.choice([-6, -3, 1, 2, 5, 9, 40])))}"
            v = lambda most: [f"v{rng.randrange(5)}" for _ in range(rng.randrange(most))]
            out.append((f"p{p}", ip, op, f"L{ip}", to() if op != "assign" else None, to() if op == "branch" else None, v(3) if op == "assign" else [], v(4), 1, "x"))
    return out


def plain(rows):
    by = {}
    for r in rows:
        by.setdefault(r[0], []).append(r)
    out = {"edges": set(), "du": set(), "pd": set(), "cd": set(), "slice": set()}
    for k, code in by.items():
        n = len(code)
        at = {r[3]: r[1] for r in code}
        succ = [{at[r[4]], at[r[5]]} if r[2] == "branch" else {at[r[4]]} if r[2] == "goto" else {r[1] + 1} & set(range(n)) for r in code]
        out["edges"] |= {(k, i, j) for i in range(n) for j in succ[i]}

        def walk(starts, through):
            seen, todo = set(), list(starts)
            while todo:
                x = todo.pop()
                if x not in seen:
                    seen.add(x)
                    todo += [y for y in succ[x]] if through(x) else []
            return seen

        data = set()
        for r in code:
            for v in set(r[6]):
                for x in walk(succ[r[1]], lambda x, v=v: v not in code[x][6]):
                    if v in code[x][7]:
                        out["du"].add((k, v, r[1], x))
                        data |= {(r[1], x)} if r[1] != x else set()
        ends = {i for i in range(n) if not succ[i]}
        pd = {i: {p for p in range(n) if p != i and not (walk([i], lambda x, p=p: x != p) - {p}) & ends} for i in range(n)}
        out["pd"] |= {(k, i, p) for i in range(n) for p in pd[i]}
        control = set()
        for r in code:
            if r[2] == "branch":
                control |= {(r[1], x) for x in walk([s for s in succ[r[1]]], lambda x, b=r[1]: x not in pd[b]) - pd[r[1]]}
        out["cd"] |= {(k, *e) for e in control}
        for v in {v for r in code for v in r[6]}:
            found = {r[1] for r in code if v in r[6]}
            while more := {a for a, b in data | control if b in found} - found:
                found |= more
            out["slice"] |= {(k, v, x) for x in found}
    return out


def rows_of(df, *cols):
    return [tuple(r) for r in df.select(*cols).collect()]


@pytest.mark.parametrize("seed", [1])
def test_sets_are_those_of_walks(spark, seed):
    rows = programs(seed, [1, 2, 5, 30])
    want = plain(rows)
    instr = spark.createDataFrame(rows, SCHEMA).repartition(3).cache()

    def check(name, df, *cols):
        got = rows_of(df, *cols)
        assert len(got) == len(set(got))
        assert set(got) == want[name], name

    check("edges", flow.edges(instr, ["k"]), "k", "src", "dst")
    check("du", flow.def_use(instr, ["k"]), "k", "var", "def_ip", "use_ip")
    check("pd", flow.postdominators(instr, ["k"]), "k", "ip", "by_ip")
    check("cd", flow.control_dependence(instr, ["k"]), "k", "src", "dst")
    seeds = flow.definitions(instr, ["k"]).withColumnRenamed("ip", "node")
    check("slice", flow.backward_slices(flow.dependences(instr, ["k"]), seeds, ["k"], "var"), "k", "var", "node")


def test_blocks_of_long_programs(spark, monkeypatch):
    monkeypatch.setattr(flow, "SPAN", 7)
    rows = programs(3, [60, 1, 20])
    instr = spark.createDataFrame(rows, SCHEMA)
    blocks, links = flow.blocks(instr, ["k"])
    edges = plain(rows)["edges"]
    lead = {(r[0], 0) for r in rows} | {(k, j) for k, i, j in edges if dict(((r[0], r[1]), r[2]) for r in rows)[k, i] != "assign"} | {(r[0], r[1] + 1) for r in rows if r[2] != "assign"}
    begins = sorted((k, ip) for k, ip in lead if any(r[0] == k and r[1] == ip for r in rows))
    of = {(r[0], r[1]): sum(1 for k, ip in begins if k == r[0] and ip <= r[1]) - 1 for r in rows}
    got = rows_of(blocks, "k", "block", "first_ip", "last_ip", "is_exit")
    assert {(k, b, f) for k, b, f, _, _ in got} == {(k, of[k, ip], ip) for k, ip in begins}
    last = {(k, b): e for k, b, _, e, _ in got}
    assert set(rows_of(links, "k", "src", "dst")) == {(k, of[k, i], of[k, j]) for k, i, j in edges if last[k, of[k, i]] == i}
    assert {(k, b) for k, b, *_, e in got if e} == {x for x, e in last.items() if not any(k == x[0] and i == e for k, i, _ in edges)}


def test_missing_labels_fail_and_empty_tables_are_empty(spark):
    with pytest.raises(Exception, match="unknown label: nowhere"):
        flow.edges(spark.createDataFrame([("p", 0, "goto", "a", "nowhere", None, [], [], 1, "x")], SCHEMA), ["k"]).collect()
    none = spark.createDataFrame([], SCHEMA)
    for f in (flow.edges, flow.def_use, flow.postdominators, flow.control_dependence, flow.dependences):
        assert f(none, ["k"]).collect() == []


def test_no_round_sends_a_table_through_the_driver(spark, tmp_path):
    """Every join is by sort, also those of small tables that the rounds would broadcast."""
    rows = spark.createDataFrame(programs(5, [12, 9]), SCHEMA)
    blocks, links = flow.blocks(rows, ["k"])
    facts = flow.reaching(rows, ["k"])
    for df in (flow.edges(rows, ["k"]), blocks, links, flow.gen_kill(rows, ["k"])[1], flow.def_use(rows, ["k"], facts), flow.nearest(flow.postdominators(rows, ["k"]), ["k"])):
        df.collect()
        assert "BroadcastExchange" not in df._jdf.queryExecution().executedPlan().toString()
