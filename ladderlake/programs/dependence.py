"""Reads and writes of statements, three-address code, control flow, reaching definitions, dependences and slices.

Sets of instructions are integers used as bit sets. A write to a part of a variable doesn't end what was written before.
Calls write the variables bound by `=>` and the instance that is called.
"""

from __future__ import annotations

from . import syntax


def names(e: dict | None) -> set[str]:
    """Base names that an expression reads, upper-cased as names have no case."""
    out, todo = set(), [e] if e else []
    while todo:
        x = todo.pop()
        k = x["kind"]
        if k == "name":
            out.add(x["base"].upper())
            todo += [i for a in x["access"] if a[0] == "[" for i in a[1]]
        elif k == "unary":
            todo.append(x["of"])
        elif k == "binary":
            todo += [x["left"], x["right"]]
        elif k == "invoke":
            todo += [a["value"] for a in x["args"] if a["value"] and a["way"] != "=>"]
    return out


def _index_names(e: dict) -> set[str]:
    return set().union(*(names(i) for a in e["access"] if a[0] == "[" for i in a[1]), set())


def _outputs(args: list[dict]) -> list[dict]:
    return [a["value"] for a in args if a["way"] == "=>" and a["value"] and a["value"]["kind"] == "name"]


def reads(s: dict, deep: bool = True) -> set[str]:
    k, out = s["kind"], set()
    if k == "assign":
        out = names(s["value"]) | _index_names(s["target"]) | ({s["target"]["base"].upper()} if s["op"] in ("+=", "-=") else set())
    elif k == "call":
        out = {s["name"]["base"].upper()}.union(*(names(a["value"]) for a in s["args"] if a["value"] and a["way"] != "=>"))
    else:
        out = set().union(*map(names, syntax.expressions(s)), {s["var"].upper()} if k == "for" else set())
    return out.union(*(reads(x) for b in syntax.bodies(s) for x in b)) if deep else out


def writes(s: dict, deep: bool = True) -> set[str]:
    k, out = s["kind"], set()
    if k == "assign":
        out = {s["target"]["base"].upper()}
    elif k == "for":
        out = {s["var"].upper()}
    elif k == "call":
        out = {s["name"]["base"].upper()} | {v["base"].upper() for v in _outputs(s["args"])}
    for e in syntax.expressions(s):
        todo = [e]
        while todo:
            x = todo.pop()
            if x["kind"] == "invoke":
                out |= {v["base"].upper() for v in _outputs(x["args"])}
                todo += [a["value"] for a in x["args"] if a["value"]]
            todo += [x[p] for p in ("left", "right", "of") if isinstance(x.get(p), dict)]
    return out.union(*(writes(x) for b in syntax.bodies(s) for x in b)) if deep else out


class Code:
    """Instructions of a unit: dicts of op, dest, args (texts), reads, writes, weak (keeps earlier writes), line and stmt."""

    def __init__(self, unit: dict):
        self.rows: list[dict] = []
        self.labels: dict[str, int] = {}
        self.jumps: dict[int, list[str]] = {}
        self.stmts: list[dict] = []
        self.temps = 0
        self.fresh = 0
        self.block(unit["body"], None, None)
        self.emit("end", line=unit.get("end", unit["line"]))

    def emit(self, op, dest=None, args=(), reads=(), writes=(), weak=False, line=None, jumps=()):
        at = len(self.rows)
        stmt = len(self.stmts) - 1 if not self._open else self._open[-1]
        self.rows.append({"idx": at, "op": op, "dest": dest, "args": list(args), "reads": sorted(reads), "writes": sorted(writes), "weak": weak, "line": line or self._line, "stmt": stmt if op != "end" else -1})
        if jumps:
            self.jumps[at] = list(jumps)
        return at

    _open: list[int] = []
    _line = 0

    def label(self, stem: str) -> str:
        self.fresh += 1
        return f"{stem}_{self.fresh}"

    def place(self, label: str) -> None:
        self.labels[label] = len(self.rows)

    def value(self, e: dict) -> tuple[str, set]:
        """The operand that holds an expression, and the names it reads by itself."""
        k = e["kind"]
        if k == "literal":
            return e["text"], set()
        if k == "name":
            from .text import expr

            return expr(e), names(e)
        self_args, used = [], set()
        parts = [e["of"]] if k == "unary" else [e["left"], e["right"]] if k == "binary" else [a["value"] for a in e["args"] if a["value"] and a["way"] != "=>"]
        for p in parts:
            v, r = self.value(p)
            self_args.append(v)
            used |= r
        self.temps += 1
        t = f"t{self.temps}"
        outs = {v["base"].upper() for v in _outputs(e["args"])} if k == "invoke" else set()
        self.emit("call" if k == "invoke" else k, t, ([e["op"]] if k != "invoke" else [e["name"]["base"]]) + self_args, used, outs | {t}, bool(outs))
        return t, {t}

    def test(self, e: dict, yes: str, no: str) -> None:
        v, r = self.value(e)
        self.emit("branch", None, [v], r, jumps=(yes, no))

    def block(self, statements, leave, again) -> None:
        for s in statements:
            self.stmts.append(s)
            self._open = [*self._open, len(self.stmts) - 1]
            self._line = s["line"]
            self.statement(s, leave, again)
            self._open = self._open[:-1]

    def back(self, s: dict) -> None:
        self._line = s["line"]

    def statement(self, s: dict, leave, again) -> None:
        k = s["kind"]
        if k == "assign":
            v, r = self.value(s["value"])
            part = bool(s["target"]["access"]) or s["op"] in ("+=", "-=", "?=")
            from .text import expr

            self.emit("assign", expr(s["target"]), [s["op"], v], r | reads(s, False) - names(s["value"]), {s["target"]["base"].upper()}, part)
        elif k == "call":
            args, used = [], {s["name"]["base"].upper()}
            for a in s["args"]:
                if a["value"] and a["way"] != "=>":
                    v, r = self.value(a["value"])
                    args.append(f"{a['name']} := {v}" if a["name"] else v)
                    used |= r
            self.emit("call", None, [s["name"]["base"], *args], used, writes(s, False), True)
        elif k == "if":
            done = self.label("endif")
            for b in s["branches"]:
                yes, no = self.label("then"), self.label("else")
                self.test(b["cond"], yes, no)
                self.place(yes)
                self.block(b["body"], leave, again)
                self.emit("goto", jumps=(done,))
                self.place(no)
                self.back(s)
            self.block(s["orelse"] or [], leave, again)
            self.place(done)
        elif k == "case":
            done, (sel, used) = self.label("endcase"), self.value(s["of"])
            for e in s["entries"]:
                yes, no = self.label("when"), self.label("next")
                bounds = [self.value(x) for label in e["labels"] for x in label]
                self.emit("branch", None, [sel, *(b[0] for b in bounds)], used.union(*(b[1] for b in bounds)), jumps=(yes, no))
                self.place(yes)
                self.block(e["body"], leave, again)
                self.emit("goto", jumps=(done,))
                self.place(no)
                self.back(s)
            self.block(s["orelse"] or [], leave, again)
            self.place(done)
        elif k == "for":
            head, yes, step, done = (self.label(x) for x in ("for", "do", "step", "endfor"))
            var, key = s["var"], s["var"].upper()
            v, r = self.value(s["start"])
            self.emit("assign", var, [":=", v], r, {key})
            self.place(head)
            stop, used = self.value(s["stop"])
            by, by_used = self.value(s["step"]) if s["step"] else ("1", set())
            down = bool(s["step"]) and s["step"]["kind"] == "unary" and s["step"]["op"] == "-" and s["step"]["of"]["kind"] == "literal"
            known = not s["step"] or down or s["step"]["kind"] == "literal"
            self.emit("branch", None, [">=" if down else "<=" if known else f"<= or >= by the sign of {by}", var, stop], used | {key} | by_used, jumps=(yes, done))
            self.place(yes)
            self.block(s["body"], done, step)
            self.place(step)
            self.back(s)
            self.emit("binary", var, ["+", var, by], by_used | {key}, {key})
            self.emit("goto", jumps=(head,))
            self.place(done)
        elif k == "while":
            head, yes, done = (self.label(x) for x in ("while", "do", "endwhile"))
            self.place(head)
            self.test(s["cond"], yes, done)
            self.place(yes)
            self.block(s["body"], done, head)
            self.back(s)
            self.emit("goto", jumps=(head,))
            self.place(done)
        elif k == "repeat":
            head, check, done = (self.label(x) for x in ("repeat", "until", "endrepeat"))
            self.place(head)
            self.block(s["body"], done, check)
            self.place(check)
            self.back(s)
            self.test(s["cond"], done, head)
            self.place(done)
        else:
            target = {"exit": leave, "continue": again}.get(k)
            self.emit(k, jumps=(target or "end",))

    def successors(self) -> list[list[int]]:
        last = len(self.rows) - 1
        out = [sorted({self.labels.get(x, last) for x in self.jumps[i]}) if i in self.jumps else [i + 1] for i in range(last)]
        return out + [[]]


def _bits(x: int):
    while x:
        low = x & -x
        yield low.bit_length() - 1
        x ^= low


def _predecessors(succ: list[list[int]]) -> list[list[int]]:
    out = [[] for _ in succ]
    for a, after in enumerate(succ):
        for b in after:
            out[b].append(a)
    return out


def blocks(succ: list[list[int]]) -> list[int]:
    """Each instruction's basic block, numbered in order. Targets of jumps and what follows a jump lead a block."""
    n = len(succ)
    leads = {0} | {b for a, after in enumerate(succ) if after != [a + 1] for b in after} | {a + 1 for a, after in enumerate(succ) if after != [a + 1] and a + 1 < n}
    out, at = [], -1
    for i in range(n):
        at += i in leads
        out.append(at)
    return out


def def_use(code: Code) -> list[tuple[int, int, str]]:
    """(definition, use, name) where the definition reaches the use."""
    rows, succ = code.rows, code.successors()
    pred, of = _predecessors(succ), {}
    for r in rows:
        for v in r["writes"]:
            of[v] = of.get(v, 0) | 1 << r["idx"]
    kill = [0 if r["weak"] else sum(of[v] for v in r["writes"]) if len(r["writes"]) == 1 else 0 for r in rows]
    gen = [1 << r["idx"] if r["writes"] else 0 for r in rows]
    into, out = [0] * len(rows), gen[:]
    todo = list(range(len(rows) - 1, -1, -1))
    waiting = set(todo)
    while todo:
        i = todo.pop()
        waiting.discard(i)
        into[i] = 0
        for p in pred[i]:
            into[i] |= out[p]
        new = gen[i] | into[i] & ~kill[i]
        if new != out[i]:
            out[i] = new
            for x in succ[i]:
                if x not in waiting:
                    waiting.add(x)
                    todo.append(x)
    return [(d, r["idx"], v) for r in rows for v in r["reads"] for d in _bits(into[r["idx"]] & of.get(v, 0))]


def post_dominators(succ: list[list[int]]) -> list[int]:
    """Of each instruction, those that every path from it to the end passes, itself included. In an endless loop: all."""
    n, pred = len(succ), _predecessors(succ)
    everything = (1 << n) - 1
    pd = [everything] * n
    pd[n - 1] = 1 << (n - 1)
    todo, waiting = list(range(n - 1)), set(range(n - 1))
    while todo:
        i = todo.pop()
        waiting.discard(i)
        both = everything
        for x in succ[i]:
            both &= pd[x]
        new = both | 1 << i
        if new != pd[i]:
            pd[i] = new
            for p in pred[i]:
                if p not in waiting and p != n - 1:
                    waiting.add(p)
                    todo.append(p)
    return pd


def control(code: Code) -> list[tuple[int, int]]:
    """(branch, instruction whose execution it decides)."""
    succ = code.successors()
    pd, out = post_dominators(succ), set()
    for a, after in enumerate(succ):
        if len(after) > 1:
            for b in after:
                out |= {(a, y) for y in _bits(pd[b] & ~(pd[a] & ~(1 << a)))}
    return sorted(out)


def pdg(code: Code) -> list[tuple[int, int, str]]:
    """Program dependence edges (source, target, data or control), without loops of one instruction."""
    data = {(d, u, "data") for d, u, _ in def_use(code)}
    return sorted(e for e in data | {(a, b, "control") for a, b in control(code)} if e[0] != e[1])


def backward(edges: list[tuple[int, int, str]], start: set[int]) -> set[int]:
    """What the start depends on, itself included."""
    into: dict[int, list[int]] = {}
    for a, b, _ in edges:
        into.setdefault(b, []).append(a)
    seen, todo = set(start), list(start)
    while todo:
        for a in into.get(todo.pop(), ()):
            if a not in seen:
                seen.add(a)
                todo.append(a)
    return seen


def pruned(statements: list[dict], keep: set[int]) -> list[dict]:
    """The statements (by `id`) to keep with the ones around them; bodies and branches without any are dropped or left empty where the order of tests needs them."""
    out = []
    for s in statements:
        k = s["kind"]
        inner = [pruned(b, keep) for b in syntax.bodies(s)]
        if id(s) not in keep and not any(inner):
            continue
        s = dict(s)
        if k == "if":
            n = len(s["branches"])
            s["branches"] = [{**b, "body": x} for b, x in zip(s["branches"], inner)]
            s["orelse"] = (inner[n] or None) if len(inner) > n else None
            while len(s["branches"]) > 1 and not s["branches"][-1]["body"] and not s["orelse"]:
                s["branches"].pop()
        elif k == "case":
            n = len(s["entries"])
            s["entries"] = [{**e, "body": x} for e, x in zip(s["entries"], inner)]
            s["orelse"] = (inner[n] or None) if len(inner) > n else None
            if not s["orelse"]:
                s["entries"] = [e for e in s["entries"] if e["body"]] or s["entries"][:1]
        elif inner:
            s["body"] = inner[0]
        out.append(s)
    return out


def slices(unit: dict) -> list[dict]:
    """For each variable written by statements: the lines and the pruned unit that its final value depends on."""
    code = Code(unit)
    edges, out = pdg(code), []
    jumps = {r["idx"] for r in code.rows if r["op"] in ("exit", "continue", "return")}
    targets = sorted({v for s in unit["body"] for v in writes(s)})
    for v in targets:
        start = {r["idx"] for r in code.rows if v in r["writes"]}
        hit = backward(edges, start | jumps)
        stmts = {code.rows[i]["stmt"] for i in hit if code.rows[i]["stmt"] >= 0}
        body = pruned(unit["body"], {id(code.stmts[i]) for i in stmts})
        used = {v}.union(*(reads(s) | writes(s) for s in body))
        sections = [{**s, "vars": [{**d, "names": [n for n in d["names"] if n.upper() in used]} for d in s["vars"] if any(n.upper() in used for n in d["names"])]} for s in unit["sections"]]
        out.append({"var": v, "lines": sorted({code.stmts[i]["line"] for i in stmts}), "stmts": sorted(stmts), "unit": {**unit, "body": body, "sections": [s for s in sections if s["vars"]]}})
    return out


def cluster(found: list[dict], share: float = 0.5) -> list[dict]:
    """Slices joined greedily, in order: one joins the first group with which it has at least `share` of the smaller one's statements in common. The group then has the statements of both. Empty ones stay by themselves."""
    groups: list[dict] = []
    for s in found:
        mine = set(s["stmts"])
        fits = (g for g in groups if mine and g["stmts"] and len(g["stmts"] & mine) >= share * min(len(g["stmts"]), len(mine)))
        g = next(fits, None)
        if g is None:
            groups.append({"stmts": mine, "lines": set(s["lines"]), "vars": [s["var"]]})
        else:
            g["stmts"], g["lines"] = g["stmts"] | mine, g["lines"] | set(s["lines"])
            g["vars"].append(s["var"])
    return [{"vars": g["vars"], "lines": sorted(g["lines"]), "n_stmts": len(g["stmts"])} for g in groups]


def symbols(unit: dict) -> list[dict]:
    """Declared variables with their storage and type; is_fb by the type's name, as in the columns' `is_fb_type`."""
    from .text import words

    return [{"name": n, "storage": s["storage"], "type": words(d["type"]), "is_fb": d["type"][0].isupper() and d["type"][0].endswith("_FB"), "line": d["line"]} for s in unit["sections"] for d in s["vars"] for n in d["names"]]


def undeclared(unit: dict) -> list[str]:
    """Names that statements use and no section declares; the unit's own name is its result."""
    known = {x["name"].upper() for x in symbols(unit)} | {unit["name"].upper()}
    used = set().union(*(reads(s) | writes(s) for s in unit["body"]), set())
    return sorted(used - known)
