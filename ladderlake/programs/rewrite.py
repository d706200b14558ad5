"""Variants of programs that compute the same, drawn from a random generator that the caller seeds."""

from __future__ import annotations

import random

from . import syntax
from .dependence import reads, writes

COMMUTES = {"+", "*", "AND", "OR"}
#: Declared here but known outside, so never renamed. Fixed values.
SHARED = {"VAR_EXTERNAL", "VAR_GLOBAL"}


def _pure(e: dict) -> bool:
    return not any(x["kind"] == "invoke" for x in _walk(e))


def _walk(e: dict):
    todo = [e]
    while todo:
        x = todo.pop()
        yield x
        todo += [x[p] for p in ("left", "right", "of") if isinstance(x.get(p), dict)]
        todo += [a["value"] for a in x.get("args", ()) if a["value"]] + ([x["name"]] if x["kind"] == "invoke" else [])
        todo += [i for a in x.get("access", ()) if a[0] == "[" for i in a[1]]


def statements(body: list[dict]):
    for s in body:
        yield s
        for b in syntax.bodies(s):
            yield from statements(b)


def commute(e: dict, rng: random.Random) -> None:
    """Swaps the sides of half of the operations whose order doesn't matter; sides with calls stay."""
    for x in _walk(e):
        if x["kind"] == "binary" and x["op"] in COMMUTES and rng.random() < 0.5 and _pure(x["left"]) and _pure(x["right"]):
            x["left"], x["right"] = x["right"], x["left"]


def invert(s: dict, rng: random.Random) -> None:
    """IF c A ELSE B becomes IF NOT c B ELSE A, for half of those without ELSIF."""
    if s["kind"] == "if" and len(s["branches"]) == 1 and s["orelse"] and rng.random() < 0.5:
        b = s["branches"][0]
        s["branches"], s["orelse"] = [{"cond": {"kind": "unary", "op": "NOT", "of": b["cond"]}, "body": s["orelse"]}], b["body"]


def independent(a: dict, b: dict) -> bool:
    """Whether two statements can change places: no calls or jumps, no hazard."""
    barrier = lambda s: any(x["kind"] in ("call", "exit", "continue", "return") or not all(map(_pure, syntax.expressions(x))) for x in statements([s]))
    if barrier(a) or barrier(b):
        return False
    ra, wa, rb, wb = reads(a), writes(a), reads(b), writes(b)
    return not (wa & rb or ra & wb or wa & wb)


def reorder(body: list[dict], rng: random.Random) -> None:
    """As many tries as statements: a pair of neighbours that are independent is swapped with even odds."""
    for _ in range(len(body) if len(body) > 1 else 0):
        k = rng.randrange(len(body) - 1)
        if rng.random() < 0.5 and independent(body[k], body[k + 1]):
            body[k], body[k + 1] = body[k + 1], body[k]


def rename(unit: dict, rng: random.Random, share: float = 0.7) -> None:
    """Gives that share of the unit's own variables (longer than one letter, not all upper case) new names, at each place: declarations, types, counters, calls."""
    taken = {n.upper() for s in unit["sections"] for d in s["vars"] for n in d["names"]} | {unit["name"].upper()}
    for s in statements(unit["body"]):
        taken |= reads(s, False) | writes(s, False)
    new: dict[str, str] = {}
    for s in unit["sections"]:
        for n in (n for d in s["vars"] for n in d["names"]):
            if s["storage"] not in SHARED and len(n) > 1 and n != n.upper() and rng.random() < share:
                name = f"tmp_{rng.randrange(10000):04d}"
                while name.upper() in taken:
                    name = f"tmp_{rng.randrange(10 ** 8):08d}"
                taken.add(name.upper())
                new[n.upper()] = name
    swap = lambda n: new.get(n.upper(), n)
    for s in unit["sections"]:
        for d in s["vars"]:
            d["names"] = [swap(n) for n in d["names"]]
            for part in ("type", "init"):
                w = d[part] or []
                d[part] = [swap(x) if not k or w[k - 1] != "." else x for k, x in enumerate(w)] if d[part] else d[part]
    for s in statements(unit["body"]):
        if s["kind"] == "for":
            s["var"] = swap(s["var"])
        for e in syntax.expressions(s) + ([s["name"]] if s["kind"] == "call" else []):
            for x in _walk(e):
                if x["kind"] == "name":
                    x["base"] = swap(x["base"])


def variant(trees: list[dict], seed: str) -> list[dict]:
    """One variant of a text's trees. They are changed in place."""
    rng = random.Random(seed)
    for u in syntax.units_of(trees):
        for s in list(statements(u["body"])):
            for e in syntax.expressions(s):
                commute(e, rng)
            invert(s, rng)
            for b in syntax.bodies(s):
                reorder(b, rng)
        reorder(u["body"], rng)
        rename(u, rng)
    return trees
