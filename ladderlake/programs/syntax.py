"""Lexer and precedence-climbing parser of Structured Text.

A tree is made of dicts with a `kind`, so it goes to JSON as it is. Positions are 1-based lines. The whole text has to parse.
"""

from __future__ import annotations

import functools
import marshal
import re
from typing import NamedTuple

#: Words that can't be names. Fixed values.
KEYWORDS = set("PROGRAM END_PROGRAM FUNCTION END_FUNCTION FUNCTION_BLOCK END_FUNCTION_BLOCK TYPE END_TYPE STRUCT END_STRUCT CONFIGURATION END_CONFIGURATION VAR VAR_INPUT VAR_OUTPUT VAR_IN_OUT VAR_EXTERNAL VAR_GLOBAL VAR_TEMP END_VAR IF THEN ELSIF ELSE END_IF CASE OF END_CASE FOR TO BY DO END_FOR WHILE END_WHILE REPEAT UNTIL END_REPEAT EXIT CONTINUE RETURN NOT AND OR XOR MOD TRUE FALSE".split())
#: Bodies in other languages than statements begin with these. Fixed values.
OTHER_BODIES = {"INITIAL_STEP", "STEP", "TRANSITION", "ACTION"}
SECTIONS = {"VAR", "VAR_INPUT", "VAR_OUTPUT", "VAR_IN_OUT", "VAR_EXTERNAL", "VAR_GLOBAL", "VAR_TEMP"}
QUALIFIERS = {"CONSTANT", "RETAIN", "NON_RETAIN", "PUBLIC", "PRIVATE", "PROTECTED", "INTERNAL"}
#: Operator -> (strength, right-associative). MOD and / bind before *, to the right; OR binds before XOR. Fixed values.
BINARY = {"XOR": (1, False), "OR": (2, False), "AND": (3, False), "&": (3, False), "=": (4, False), "<>": (4, False), "<": (5, False), ">": (5, False), "<=": (5, False), ">=": (5, False), "+": (6, False), "-": (6, False), "*": (7, False), "MOD": (8, True), "/": (8, True), "**": (9, False)}
ASSIGN = {":=", "?=", "+=", "-=", "REF="}

_TOKEN = re.compile(
    r"""(?P<skip>[\s﻿]+|//[^\n]*|\(\*.*?\*\)|/\*.*?\*/|\{[^}\n]*\})
    |(?P<text>'(?:\$.|[^'$])*'|"(?:\$.|[^"$])*")
    |(?P<number>(?:L?DT|DATE_AND_TIME|L?TOD|TIME_OF_DAY|L?D|L?DATE)\#[\d:.\-]+|W?STRING\#(?:'(?:\$.|[^'$])*'|"(?:\$.|[^"$])*")|[A-Za-z_]\w*\#(?:\d+\#)?[+-]?\w+(?:\.\d\w*)?|\d+\#\w+|\d[\d_]*\.\d[\d_]*(?:[eE][+-]?\d+)?|\d[\d_]*(?:[eE][+-]?\d+)?)
    |(?P<word>[^\W\d]\w*|%[IQM][XBWDL*]?[\d.]*)
    |(?P<sign>:=|=>|<>|<=|>=|\*\*|\?=|\+=|-=|\.\.|[-+*/=<>&^:;,.()\[\]\#|])""",
    re.S | re.X | re.I,
)


class Token(NamedTuple):
    type: str
    text: str
    key: str
    line: int
    column: int


class SyntaxFault(Exception):
    """A text isn't a program; `str` has the line and column of the place."""


def tokens(code: str) -> list[Token]:
    out, at, line, start = [], 0, 1, 0
    while at < len(code):
        m = _TOKEN.match(code, at)
        if m is None:
            raise SyntaxFault(f"Line {line}:{at - start} - unknown character {code[at]!r}")
        kind, text = m.lastgroup, m.group()
        if kind != "skip":
            out.append(Token(kind, text, text.upper() if kind == "word" else text, line, at - start))
        if "\n" in text:
            line += text.count("\n")
            start = at + text.rindex("\n") + 1
        at = m.end()
    out.append(Token("end", "", "", line, at - start))
    return out


class _Parser:
    def __init__(self, code: str):
        self.tokens = tokens(code)
        self.i = 0

    @property
    def now(self) -> Token:
        return self.tokens[self.i]

    def fault(self, wanted: str):
        t = self.now
        return SyntaxFault(f"Line {t.line}:{t.column} - expected {wanted}, found {t.text or 'end of text'!r}")

    def at(self, *keys: str) -> bool:
        return self.now.type in ("word", "sign") and self.now.key in keys

    def next(self) -> Token:
        self.i += 1
        return self.tokens[self.i - 1]

    def take(self, *keys: str) -> Token | None:
        return self.next() if self.at(*keys) else None

    def need(self, *keys: str) -> Token:
        if not self.at(*keys):
            raise self.fault(" or ".join(keys))
        return self.next()

    def name(self) -> str:
        if self.now.type != "word" or self.now.key in KEYWORDS:
            raise self.fault("a name")
        return self.next().text

    # units

    def units(self) -> list[dict]:
        out = []
        while self.now.type != "end":
            if self.at("PROGRAM", "FUNCTION_BLOCK", "FUNCTION"):
                out.append(self.unit())
            elif self.at("TYPE"):
                out.append(self.types())
            elif self.at("VAR_GLOBAL"):
                out.append({"kind": "globals", "line": self.now.line, "sections": [self.section()]})
            elif self.take("CONFIGURATION"):
                while not self.at("END_CONFIGURATION"):
                    if self.next().type == "end":
                        self.i -= 1
                        raise self.fault("END_CONFIGURATION")
                self.next()
            elif not self.take(";"):
                raise self.fault("a program, function, function block, type or global list")
        return out

    def unit(self) -> dict:
        kind = self.next()
        u = {"kind": kind.key.lower(), "name": self.name(), "line": kind.line, "returns": None, "sections": [], "body": []}
        if kind.key == "FUNCTION" and self.take(":"):
            u["returns"] = self.type_words(SECTIONS | {";"}, stop_at_line=True)
            self.take(";")
        end = "END_" + kind.key
        while self.at(*SECTIONS):
            u["sections"].append(self.section())
        if self.at(*OTHER_BODIES):
            raise SyntaxFault(f"Line {self.now.line}:{self.now.column} - unsupported body language")
        u["body"] = self.statements(end)
        u["end"] = self.need(end).line
        return u

    def types(self) -> dict:
        line, words = self.need("TYPE").line, []
        names, fresh = [], True
        while not self.at("END_TYPE"):
            t = self.next()
            if t.type == "end":
                self.i -= 1
                raise self.fault("END_TYPE")
            if fresh and self.at(":") and t.type == "word":
                names.append(t.text)
            fresh = t.key in (";", "END_STRUCT")
            words.append(t.text)
            if t.key == "STRUCT":
                while not self.at("END_STRUCT") and self.now.type != "end":
                    words.append(self.next().text)
        self.next()
        return {"kind": "types", "line": line, "names": names, "words": words}

    def section(self) -> dict:
        head = self.next()
        s = {"storage": head.key, "qualifiers": [], "line": head.line, "vars": []}
        while self.at(*QUALIFIERS):
            s["qualifiers"].append(self.next().key)
        while not self.take("END_VAR"):
            if self.take(";"):
                continue
            line, names = self.now.line, [self.name()]
            while self.take(","):
                names.append(self.name())
            place = self.next().text if self.take("AT") else None
            self.need(":")
            kind = self.type_words({":=", ";"})
            init = self.type_words({";"}) if self.take(":=") else None
            self.need(";")
            s["vars"].append({"names": names, "at": place, "type": kind, "init": init, "line": line})
        return s

    def type_words(self, stops: set, stop_at_line: bool = False) -> list[str]:
        """The words up to a stop outside of brackets."""
        out, depth, line = [], 0, self.now.line
        while depth or not self.at(*stops):
            t = self.now
            if t.type == "end" or t.key == "END_VAR":
                raise self.fault(" or ".join(sorted(stops)))
            if stop_at_line and out and t.line != line and depth == 0 and not self.at("[", "("):
                break
            depth += (t.key in "([") - (t.key in ")]") if t.type == "sign" else 0
            out.append(self.next().text)
        if not out:
            raise self.fault("a type or value")
        return out

    # statements

    def statements(self, *ends: str) -> list[dict]:
        out = []
        while not self.at(*ends):
            if self.now.type == "end":
                raise self.fault(" or ".join(ends))
            if self.take(";"):
                continue
            first = self.i
            made = self.statement()
            for s in made:
                s["line"], s["end"] = self.tokens[first].line, self.tokens[self.i - 1].line
            out += made
        return out

    def statement(self) -> list[dict]:
        if self.take("IF"):
            branches, other = [self.branch("THEN", "ELSIF", "ELSE", "END_IF")], None
            while self.take("ELSIF"):
                branches.append(self.branch("THEN", "ELSIF", "ELSE", "END_IF"))
            if self.take("ELSE"):
                other = self.statements("END_IF")
            self.need("END_IF")
            out = {"kind": "if", "branches": branches, "orelse": other}
        elif self.take("CASE"):
            out = self.case()
        elif self.take("FOR"):
            out = {"kind": "for", "var": self.name()}
            self.need(":=")
            out["start"] = self.expression()
            self.need("TO")
            out["stop"] = self.expression()
            out["step"] = self.expression() if self.take("BY") else None
            self.need("DO")
            out["body"] = self.statements("END_FOR")
            self.need("END_FOR")
        elif self.take("WHILE"):
            b = self.branch("DO", "END_WHILE")
            self.need("END_WHILE")
            out = {"kind": "while", **b}
        elif self.take("REPEAT"):
            body = self.statements("UNTIL")
            self.need("UNTIL")
            out = {"kind": "repeat", "body": body, "cond": self.expression()}
            self.take(";")
            self.need("END_REPEAT")
        elif self.at("EXIT", "CONTINUE", "RETURN"):
            out = {"kind": self.next().key.lower()}
            self.need(";")
        else:
            return self.simple()
        self.take(";")
        return [out]

    def branch(self, opener: str, *ends: str) -> dict:
        cond = self.expression()
        self.need(opener)
        return {"cond": cond, "body": self.statements(*ends)}

    def case(self) -> dict:
        of, entries, other = self.expression(), [], None
        self.need("OF")
        while not self.at("ELSE", "END_CASE"):
            labels = [self.label()]
            while self.take(","):
                labels.append(self.label())
            self.need(":")
            entries.append({"labels": labels, "body": self.case_body()})
        if not entries:
            raise self.fault("a case label")
        if self.take("ELSE"):
            self.take(":")
            other = self.statements("END_CASE")
        self.need("END_CASE")
        return {"kind": "case", "of": of, "entries": entries, "orelse": other}

    def label(self) -> list[dict]:
        low = self.expression(6)
        return [low, self.expression(6)] if self.take("..") else [low]

    def case_body(self) -> list[dict]:
        """Statements up to the next label: a number, or names, ranges and commas up to a colon."""
        out = []
        while not self.at("ELSE", "END_CASE") and not self.at_label():
            if self.now.type == "end":
                raise self.fault("END_CASE")
            if self.take(";"):
                continue
            first = self.i
            made = self.statement()
            for s in made:
                s["line"], s["end"] = self.tokens[first].line, self.tokens[self.i - 1].line
            out += made
        return out

    def at_label(self) -> bool:
        if self.now.type == "number" or self.at("-"):
            return True
        k = self.i
        while self.tokens[k].type in ("number",) or (self.tokens[k].type == "word" and self.tokens[k].key not in KEYWORDS) or self.tokens[k].key in (",", "..", ".", "-"):
            k += 1
        return k > self.i and self.tokens[k].key == ":"

    def simple(self) -> list[dict]:
        target = self.variable()
        if self.take("("):
            args = self.arguments()
            self.need(";")
            return [{"kind": "call", "name": target, "args": args}]
        if self.now.key == "REF" and self.tokens[self.i + 1].key == "=":
            self.i += 2
            op, targets = "REF=", [target]
            value = self.expression()
        else:
            if not self.at(*ASSIGN):
                raise self.fault("an assignment or a call")
            op, targets = self.next().key, [target]
            value = self.expression()
            while op == ":=" and self.take(":="):
                if value["kind"] != "name":
                    raise self.fault("a variable before :=")
                targets.append(value)
                value = self.expression()
        self.need(";")
        chain = list(reversed(targets))
        return [{"kind": "assign", "op": op, "target": t, "value": value if k == 0 else chain[k - 1]} for k, t in enumerate(chain)]

    # expressions

    def expression(self, least: int = 1) -> dict:
        left = self.unary()
        while self.now.type in ("word", "sign") and self.now.key in BINARY:
            strength, right = BINARY[self.now.key]
            if strength < least:
                break
            op = self.next().key
            left = {"kind": "binary", "op": "AND" if op == "&" else op, "left": left, "right": self.expression(strength + (not right))}
        return left

    def unary(self) -> dict:
        if self.at("-", "+", "NOT"):
            op = self.next().key
            return self.unary() if op == "+" else {"kind": "unary", "op": op, "of": self.unary()}
        if self.take("("):
            inner = self.expression()
            self.need(")")
            return inner
        if self.now.type in ("number", "text") or self.at("TRUE", "FALSE"):
            return {"kind": "literal", "text": self.next().text}
        v = self.variable()
        return {"kind": "invoke", "name": v, "args": self.arguments()} if self.take("(") else v

    def variable(self) -> dict:
        """A name with its accesses in order: [".", field], ["[", indices] and ["^"]."""
        out = {"kind": "name", "base": self.name(), "access": []}
        while True:
            if self.take("."):
                part = self.next() if self.now.type in ("word", "number") else None
                if part is None:
                    raise self.fault("a field")
                out["access"].append([".", part.text])
            elif self.take("["):
                at = [self.expression()]
                while self.take(","):
                    at.append(self.expression())
                self.need("]")
                out["access"].append(["[", at])
            elif self.take("^"):
                out["access"].append(["^"])
            else:
                return out

    def arguments(self) -> list[dict]:
        out = []
        while not self.take(")"):
            if out:
                self.need(",")
            negated, name, way = None, None, None
            if self.at("NOT") and self.tokens[self.i + 2].key == "=>":
                negated = self.next()
            if self.now.type == "word" and self.tokens[self.i + 1].key in (":=", "=>"):
                name, way = self.next().text, self.next().key
            empty = way is not None and self.at(",", ")")
            out.append({"name": name, "way": way, "negated": negated is not None, "value": None if empty else self.expression()})
        return out


def parse(code: str) -> list[dict]:
    """The units of a text. Raises SyntaxFault."""
    try:
        return _Parser(code).units()
    except RecursionError:
        raise SyntaxFault("Line 1:0 - nested too deeply") from None
    except IndexError:
        raise SyntaxFault("Line 1:0 - unexpected end of text") from None


#: Texts up to this length whose trees a process keeps, packed, and how many of them.
KEPT_CHARS, KEPT = 4096, 256


def _packed(code: str) -> bytes:
    try:
        return marshal.dumps(parse(code))
    except SyntaxFault:
        return marshal.dumps([])


_kept = functools.lru_cache(KEPT)(_packed)


def trees(code: str | None) -> list[dict]:
    """The units of a text, the caller's own to change; none where it doesn't parse. Trees of equal texts are unpacked, not parsed again."""
    if not code:
        return []
    return marshal.loads((_kept if len(code) <= KEPT_CHARS else _packed)(code))


def bodies(s: dict) -> list[list[dict]]:
    """The statement lists right below a statement."""
    if s["kind"] == "if":
        return [b["body"] for b in s["branches"]] + ([s["orelse"]] if s["orelse"] is not None else [])
    if s["kind"] == "case":
        return [e["body"] for e in s["entries"]] + ([s["orelse"]] if s["orelse"] is not None else [])
    return [s["body"]] if s["kind"] in ("for", "while", "repeat") else []


def expressions(s: dict) -> list[dict]:
    """The expressions right in a statement, without those of its bodies."""
    k = s["kind"]
    if k == "assign":
        return [s["target"], s["value"]]
    if k == "if":
        return [b["cond"] for b in s["branches"]]
    if k == "case":
        return [s["of"]] + [x for e in s["entries"] for label in e["labels"] for x in label]
    if k == "for":
        return [s["start"], s["stop"]] + ([s["step"]] if s["step"] else [])
    if k in ("while", "repeat"):
        return [s["cond"]]
    return [a["value"] for a in s["args"] if a["value"]] if k == "call" else []


def units_of(trees: list[dict]) -> list[dict]:
    """Those of the trees that hold statements."""
    return [u for u in trees if "body" in u]
