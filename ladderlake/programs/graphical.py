"""Function block and ladder diagrams as XML, the way from the first to the second, and a structural check.

A network or rung is made of one statement. Those that a diagram can't hold (loops, CASE, jumps, other IFs) are counted, not drawn.
Identifiers start anew in each unit, so a unit's XML depends on nothing else.
"""

from __future__ import annotations

import xml.etree.ElementTree as ET

from .syntax import units_of
from .text import expr

#: Names of the format. Fixed values.
SPACE = "www.iec.ch/public/TC65SC65BWG7TF10"
XSI = "http://www.w3.org/2001/XMLSchema-instance"
UNIT_TAGS = {"program": "Program", "function": "Function", "function_block": "FunctionBlock"}
BLOCKS = {"+": "ADD", "-": "SUB", "*": "MUL", "/": "DIV", "MOD": "MOD", "**": "EXPT", "AND": "AND", "OR": "OR", "XOR": "XOR", "=": "EQ", "<>": "NE", "<": "LT", ">": "GT", "<=": "LE", ">=": "GE"}
RAIL_IDS_FROM = 90001
TYPE = f"{{{XSI}}}type"
ET.register_namespace("", SPACE)
ET.register_namespace("xsi", XSI)


def _tag(name: str) -> str:
    return f"{{{SPACE}}}{name}"


def _add(parent, name: str, /, **attributes):
    return ET.SubElement(parent, _tag(name), {k: str(v) for k, v in attributes.items()})


class _Drawing:
    """A body of networks (FBD) or rungs (LD)."""

    def __init__(self, content, language: str):
        self.content, self.ladder = content, language == "LD"
        self.ids, self.order, self.y, self.skipped = 0, 0, 0, 0

    def fresh(self) -> int:
        self.ids += 1
        return self.ids

    def object(self, kind: str, x: int, name: str | None = None, ladder: bool = False):
        o = _add(self.net, "LdObject" if ladder else "FbdObject")
        o.set(TYPE, kind)
        if name is not None:
            o.set("operand" if ladder else "typeName" if kind == "Block" else "identifier", name)
        o.set("globalId", f"OBJ_{self.fresh()}")
        self.y += 40
        _add(o, "RelPosition", x=x, y=self.y)
        return o

    def into(self, parent, source: int | None, y: int = 10) -> None:
        p = _add(parent, "ConnectionPointIn")
        _add(p, "RelPosition", x=0, y=y)
        if source is not None:
            _add(p, "Connection", refConnectionPointOutId=source)

    def out(self, parent, x: int = 40, y: int = 10) -> int:
        at = self.fresh()
        _add(_add(parent, "ConnectionPointOut", connectionPointOutId=at), "RelPosition", x=x, y=y)
        return at

    def source(self, name: str) -> int:
        return self.out(self.object("DataSource", 100, name))

    def sink(self, name: str, source: int) -> None:
        self.into(self.object("DataSink", 800, name), source)

    def block(self, kind: str, pins: list[tuple[str, int]], instance: str | None = None, outs=("OUT",)) -> list[int]:
        o = self.object("Block", 400, kind)
        if instance:
            o.set("instanceName", instance)
        box = _add(o, "InputVariables")
        for k, (pin, source) in enumerate(pins):
            self.into(_add(box, "InputVariable", parameterName=pin), source, 20 * k)
        box = _add(o, "OutputVariables")
        return [self.out(_add(box, "OutputVariable", parameterName=pin), 60, 20 * k) for k, pin in enumerate(outs)]

    def value(self, e: dict) -> int:
        k = e["kind"]
        if k in ("name", "literal"):
            return self.source(expr(e))
        if k == "unary":
            kind, inputs = ("NOT" if e["op"] == "NOT" else "NEG"), [("IN", e["of"])]
        elif k == "binary":
            kind, inputs = BLOCKS[e["op"]], [("IN1", e["left"]), ("IN2", e["right"])]
        else:
            kind, inputs = expr(e["name"]), [(a["name"] or f"IN{n}", a["value"]) for n, a in enumerate(e["args"], 1) if a["value"] and a["way"] != "=>"]
        return self.block(kind, [(pin, self.value(x)) for pin, x in inputs])[0]

    def powered(self, kind: str, inputs: list[tuple[str, int]], instance: str | None, outs: list[tuple[str, str]]) -> None:
        """A block between the rails."""
        rail = self.out(self.object("LeftPowerRail", 10, ladder=True))
        eno, *rest = self.block(kind, [("EN", rail), *inputs], instance, ["ENO", *(pin for pin, _ in outs)])
        for (_, name), at in zip(outs, rest):
            self.sink(name, at)
        self.into(self.object("RightPowerRail", 1000, ladder=True), eno)

    def statement(self, s: dict) -> bool:
        k = s["kind"]
        if k == "call":
            inputs = [(a["name"] or f"IN{n}", self.value(a["value"])) for n, a in enumerate(s["args"], 1) if a["value"] and a["way"] != "=>"]
            outs = [(a["name"], expr(a["value"])) for a in s["args"] if a["value"] and a["way"] == "=>"]
            if self.ladder:
                self.powered(expr(s["name"]), inputs, expr(s["name"]), outs)
            else:
                made = self.block(expr(s["name"]), inputs, expr(s["name"]), [p for p, _ in outs] or ["OUT"])
                for (_, name), at in zip(outs, made):
                    self.sink(name, at)
            return True
        if k == "assign" and s["op"] in (":=", "+=", "-="):
            v = s["value"] if s["op"] == ":=" else {"kind": "binary", "op": s["op"][0], "left": s["target"], "right": s["value"]}
            if not self.ladder:
                self.sink(expr(s["target"]), self.value(v))
            elif v["kind"] in ("name", "literal"):
                at = self.out(self.object("LeftPowerRail", 10, ladder=True))
                for kind, x, name in (("Contact", 200, expr(v)), ("Coil", 800, expr(s["target"]))):
                    o = self.object(kind, x, name, ladder=True)
                    self.into(o, at, 20)
                    at = self.out(o)
                self.into(self.object("RightPowerRail", 1000, ladder=True), at)
            else:
                kind = BLOCKS[v["op"]] if v["kind"] == "binary" else ("NOT" if v["op"] == "NOT" else "NEG") if v["kind"] == "unary" else expr(v["name"])
                parts = [v["left"], v["right"]] if v["kind"] == "binary" else [v["of"]] if v["kind"] == "unary" else [a["value"] for a in v["args"] if a["value"]]
                self.powered(kind, [(f"IN{n}", self.value(x)) for n, x in enumerate(parts, 1)], None, [("OUT", expr(s["target"]))])
            return True
        if k == "if" and not self.ladder and len(s["branches"]) == 1 and s["orelse"]:
            yes, no = s["branches"][0]["body"], s["orelse"]
            if len(yes) == len(no) == 1 and yes[0]["kind"] == no[0]["kind"] == "assign" and expr(yes[0]["target"]).upper() == expr(no[0]["target"]).upper() and yes[0]["op"] == no[0]["op"] == ":=":
                pins = [("G", self.value(s["branches"][0]["cond"])), ("IN0", self.value(no[0]["value"])), ("IN1", self.value(yes[0]["value"]))]
                self.sink(expr(yes[0]["target"]), self.block("SEL", pins)[0])
                return True
        return False

    def draw(self, body: list[dict]) -> None:
        for s in body:
            self.order += 1
            self.net = _add(self.content, "Rung" if self.ladder else "Network", evaluationOrder=self.order)
            if not self.statement(s):
                self.content.remove(self.net)
                self.order -= 1
                self.skipped += 1


def diagram(trees: list[dict], language: str) -> tuple[str, int, int]:
    """XML of the units in FBD or LD, how many statements it draws and how many it can't."""
    root = ET.Element(_tag("Project"), {"schemaVersion": "1.0"})
    _add(root, "FileHeader", companyName="ladderlake", productName="ladderlake", productVersion="1.0")
    head = _add(root, "ContentHeader", name="project", creationDateTime="2024-01-01T00:00:00")
    _add(_add(head, "CoordinateInfo"), f"{language.title()}Scaling", x=1, y=1)
    space, drawn, skipped = _add(_add(root, "Types"), "GlobalNamespace"), 0, 0
    for u in units_of(trees):
        content = _add(_add(_add(space, UNIT_TAGS[u["kind"]], name=u["name"]), "MainBody"), "BodyContent")
        content.set(TYPE, language)
        d = _Drawing(content, language)
        d.draw(u["body"])
        drawn, skipped = drawn + d.order, skipped + d.skipped
    _add(root, "Instances")
    return ET.tostring(root, encoding="unicode"), drawn, skipped


def to_ladder(xml: str) -> str:
    """FBD as LD: networks become rungs, sources contacts, sinks coils; blocks get EN and ENO; rails close each rung. Raises ET.ParseError."""
    root = ET.fromstring(xml)
    at = RAIL_IDS_FROM
    for scaling in root.iter(_tag("FbdScaling")):
        scaling.tag = _tag("LdScaling")
    for content in root.iter(_tag("BodyContent")):
        content.set(TYPE, "LD")
        for net in content.findall(_tag("Network")):
            net.tag = _tag("Rung")
            left, out = ET.Element(_tag("LdObject"), {TYPE: "LeftPowerRail", "globalId": f"OBJ_{at}"}), at + 1
            at += 2
            _add(left, "RelPosition", x=10, y=20)
            _add(_add(left, "ConnectionPointOut", connectionPointOutId=out), "RelPosition", x=10, y=20)
            ends = []
            for o in list(net):
                kind = o.get(TYPE)
                if kind in ("DataSource", "DataSink"):
                    o.tag, name = _tag("LdObject"), o.attrib.pop("identifier")
                    o.set(TYPE, "Contact" if kind == "DataSource" else "Coil")
                    o.set("operand", name)
                    if kind == "DataSource":
                        p = ET.Element(_tag("ConnectionPointIn"))
                        _add(p, "RelPosition", x=0, y=20)
                        _add(p, "Connection", refConnectionPointOutId=out)
                        o.insert(1, p)
                    else:
                        _add(_add(o, "ConnectionPointOut", connectionPointOutId=at), "RelPosition", x=20, y=20)
                        ends.append(at)
                        at += 1
                elif kind == "Block":
                    pin = ET.Element(_tag("InputVariable"), {"parameterName": "EN"})
                    p = _add(pin, "ConnectionPointIn")
                    _add(p, "RelPosition", x=0, y=0)
                    _add(p, "Connection", refConnectionPointOutId=out)
                    o.find(_tag("InputVariables")).insert(0, pin)
                    pin = ET.Element(_tag("OutputVariable"), {"parameterName": "ENO"})
                    _add(_add(pin, "ConnectionPointOut", connectionPointOutId=at), "RelPosition", x=0, y=0)
                    at += 1
                    o.find(_tag("OutputVariables")).insert(0, pin)
            right = ET.Element(_tag("LdObject"), {TYPE: "RightPowerRail", "globalId": f"OBJ_{at}"})
            at += 1
            _add(right, "RelPosition", x=1000, y=20)
            p = _add(right, "ConnectionPointIn")
            _add(p, "RelPosition", x=0, y=20)
            for e in ends or [out]:
                _add(p, "Connection", refConnectionPointOutId=e)
            net.insert(0, left)
            net.append(right)
    return ET.tostring(root, encoding="unicode")


def faults(xml: str) -> list[str]:
    """What is wrong with a project's structure: not well-formed, other elements, missing attributes, links to nothing, ids used twice. This isn't validation by a schema."""
    try:
        root = ET.fromstring(xml)
    except ET.ParseError as e:
        return [f"FATAL: {e}"]
    out = [] if root.tag == _tag("Project") else ["root is not a Project"]
    out += [f"{n} is missing" for n in ("FileHeader", "ContentHeader", "Types", "Instances") if root.find(_tag(n)) is None]
    for content in root.iter(_tag("BodyContent")):
        language = content.get(TYPE)
        if language not in ("FBD", "LD"):
            out.append(f"body language {language}")
        given, links, ids = [], [], []
        for net in content:
            if net.tag != _tag("Rung" if language == "LD" else "Network"):
                out.append(f"{net.tag.split('}')[-1]} in {language}")
            if not net.get("evaluationOrder"):
                out.append("evaluationOrder is missing")
            for o in net:
                ids.append(o.get("globalId"))
                if o.get(TYPE) in ("Contact", "Coil") and not o.get("operand"):
                    out.append("operand is missing")
                if o.get(TYPE) in ("DataSource", "DataSink") and not o.get("identifier"):
                    out.append("identifier is missing")
                if o.get(TYPE) == "Block" and not o.get("typeName"):
                    out.append("typeName is missing")
                given += [p.get("connectionPointOutId") for p in o.iter(_tag("ConnectionPointOut"))]
                links += [p.get("refConnectionPointOutId") for p in o.iter(_tag("Connection"))]
        out += [f"link to {x}, which is nothing" for x in sorted(set(links) - set(given), key=str)]
        out += ["a globalId is missing or used twice"] if None in ids or len(set(ids)) < len(ids) else []
        out += ["a connectionPointOutId is used twice"] if len(set(given)) < len(given) else []
    return out
