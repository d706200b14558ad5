"""Text of syntax trees, 4 spaces a level, each binary operation in parentheses, so that it parses to the same tree."""

from __future__ import annotations

_TIGHT_BEFORE, _TIGHT_AFTER = {",", ")", "]", "["}, {"(", "[", ".", "#", "^"}


def words(w: list[str]) -> str:
    out = ""
    for k, x in enumerate(w):
        glue = not out or x in _TIGHT_BEFORE or x in {".", ".."} or w[k - 1] in _TIGHT_AFTER or w[k - 1] == ".."
        out += x if glue else " " + x
    return out


def expr(e: dict) -> str:
    k = e["kind"]
    if k == "literal":
        return e["text"]
    if k == "name":
        parts = {".": lambda a: "." + a[1], "[": lambda a: "[" + ", ".join(map(expr, a[1])) + "]", "^": lambda a: "^"}
        return e["base"] + "".join(parts[a[0]](a) for a in e["access"])
    if k == "unary":
        return f"(NOT {expr(e['of'])})" if e["op"] == "NOT" else f"(-{expr(e['of'])})"
    if k == "binary":
        return f"({expr(e['left'])} {e['op']} {expr(e['right'])})"
    return f"{expr(e['name'])}({args(e['args'])})"


def args(given: list[dict]) -> str:
    one = lambda a: ("NOT " if a["negated"] else "") + (f"{a['name']} {a['way']} " if a["name"] else "") + (expr(a["value"]) if a["value"] else "")
    return ", ".join(one(a).rstrip() for a in given)


def body(statements: list[dict], depth: int = 0) -> list[str]:
    pad, out = "    " * depth, []
    for s in statements:
        k = s["kind"]
        inner = lambda x: body(x, depth + 1)
        if k == "assign":
            out.append(f"{pad}{expr(s['target'])} {s['op']} {expr(s['value'])};")
        elif k == "call":
            out.append(f"{pad}{expr(s['name'])}({args(s['args'])});")
        elif k == "if":
            for n, b in enumerate(s["branches"]):
                out += [f"{pad}{'ELSIF' if n else 'IF'} {expr(b['cond'])} THEN", *inner(b["body"])]
            out += ([f"{pad}ELSE", *inner(s["orelse"])] if s["orelse"] is not None else []) + [f"{pad}END_IF;"]
        elif k == "case":
            out.append(f"{pad}CASE {expr(s['of'])} OF")
            for e in s["entries"]:
                out += [f"{pad}    {', '.join('..'.join(map(expr, x)) for x in e['labels'])}:", *body(e["body"], depth + 2)]
            out += ([f"{pad}ELSE", *inner(s["orelse"])] if s["orelse"] is not None else []) + [f"{pad}END_CASE;"]
        elif k == "for":
            by = f" BY {expr(s['step'])}" if s["step"] else ""
            out += [f"{pad}FOR {s['var']} := {expr(s['start'])} TO {expr(s['stop'])}{by} DO", *inner(s["body"]), f"{pad}END_FOR;"]
        elif k == "while":
            out += [f"{pad}WHILE {expr(s['cond'])} DO", *inner(s["body"]), f"{pad}END_WHILE;"]
        elif k == "repeat":
            out += [f"{pad}REPEAT", *inner(s["body"]), f"{pad}UNTIL {expr(s['cond'])}", f"{pad}END_REPEAT;"]
        else:
            out.append(f"{pad}{k.upper()};")
    return out


def section(s: dict) -> list[str]:
    out = [" ".join([s["storage"], *s["qualifiers"]])]
    for v in s["vars"]:
        at = f" AT {v['at']}" if v["at"] else ""
        init = f" := {words(v['init'])}" if v["init"] else ""
        out.append(f"    {', '.join(v['names'])}{at} : {words(v['type'])}{init};")
    return out + ["END_VAR"]


def unit(u: dict) -> str:
    if u["kind"] == "types":
        return f"TYPE\n    {words(u['words'])}\nEND_TYPE"
    if u["kind"] == "globals":
        return "\n".join(line for s in u["sections"] for line in section(s))
    head = f"{u['kind'].upper()} {u['name']}" + (f" : {words(u['returns'])}" if u["returns"] else "")
    return "\n".join([head, *(line for s in u["sections"] for line in section(s)), *body(u["body"], 1), f"END_{u['kind'].upper()}"])


def unparse(trees: list[dict]) -> str:
    return "\n\n".join(map(unit, trees))
