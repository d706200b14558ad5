"""Function block diagrams turned into ladders, over tables of objects and connections.

A body of FBD networks is read by Spark's XML functions into objects (body, net, place, kind, name, ...) and pins (body, net, place, pin, ...)
with the ids that they refer to. Each network becomes a rung between two power rails: a source a contact behind the left rail, a sink a
coil before the right one; a block stays, with EN behind the left rail and ENO. New ids follow on 90000 in order of networks and objects,
by a running sum. Rails and coils are linked by joins on their network, and a rung is written from its rows in order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: The name space of the format, where new ids begin, and where rails and pins stand.
NAMESPACE = "www.iec.ch/public/TC65SC65BWG7TF10"
FIRST_ID = 90_000
_AT = "RelPosition struct<_x:string,_y:string>"
_IN = f"ConnectionPointIn struct<{_AT},Connection:array<struct<_refConnectionPointOutId:string>>>".replace("RelPosition struct", "RelPosition:struct")
_OUT = f"ConnectionPointOut struct<_connectionPointOutId:string,{_AT}>".replace("RelPosition struct", "RelPosition:struct")
_OBJECT = ",".join(["_type:string", "_globalId:string", "_identifier:string", "_typeName:string", _AT.replace(" struct", ":struct", 1), _IN.replace(" struct", ":struct", 1), _OUT.replace(" struct", ":struct", 1), f"InputVariables:struct<InputVariable:array<struct<_parameterName:string,{_IN.replace(' struct', ':struct', 1)}>>>", f"OutputVariables:struct<OutputVariable:array<struct<_parameterName:string,{_OUT.replace(' struct', ':struct', 1)}>>>"])
BODY = f"Network array<struct<_evaluationOrder:string,FbdObject:array<struct<{_OBJECT}>>>>"


def networks(bodies: DataFrame, key: list[str], xml: str) -> DataFrame:
    """(key, net, order, objects): the networks of each FBD body (a BodyContent element) from 1."""
    doc = F.from_xml(F.col(xml), BODY, {"attributePrefix": "_", "ignoreNamespace": "true", "mode": "PERMISSIVE"})
    nets = bodies.select(*key, doc.alias("doc")).select(*key, F.posexplode("doc.Network").alias("net", "network"))
    return nets.select(*key, (F.col("net") + 1).alias("net"), F.col("network._evaluationOrder").alias("evaluation"), F.col("network.FbdObject").alias("objects"))


def objects(nets: DataFrame, key: list[str]) -> DataFrame:
    """(key, net, place, kind, object) from place 1."""
    each = nets.select(*key, "net", F.posexplode("objects").alias("place", "object"))
    return each.select(*key, "net", (F.col("place") + 1).alias("place"), F.col("object._type").alias("kind"), "object")


def pins(things: DataFrame, key: list[str]) -> DataFrame:
    """(key, net, place, pin, is_input, parameter, out_id, refs, at): an object's plain pins and its variables' in order. out_id is null for inputs; refs are the out_ids that an input is linked to, null for outputs."""
    refs = lambda c: F.coalesce(F.transform(c["Connection"], lambda x: x["_refConnectionPointOutId"]), F.array().cast("array<string>"))
    source = lambda c, p: F.struct(F.lit(True).alias("is_input"), p.alias("parameter"), F.lit(None).cast("string").alias("out_id"), refs(c).alias("refs"), c["RelPosition"].alias("at"))
    sink = lambda c, p: F.struct(F.lit(False).alias("is_input"), p.alias("parameter"), c["_connectionPointOutId"].alias("out_id"), F.lit(None).cast("array<string>").alias("refs"), c["RelPosition"].alias("at"))
    o, none = F.col("object"), F.lit(None).cast("string")
    plain = F.array_compact(F.array(F.when(o["ConnectionPointIn"].isNotNull(), source(o["ConnectionPointIn"], none)), F.when(o["ConnectionPointOut"].isNotNull(), sink(o["ConnectionPointOut"], none))))
    ins = F.coalesce(F.transform(o["InputVariables"]["InputVariable"], lambda v: source(v["ConnectionPointIn"], v["_parameterName"])), F.slice(plain, 1, 0))
    outs = F.coalesce(F.transform(o["OutputVariables"]["OutputVariable"], lambda v: sink(v["ConnectionPointOut"], v["_parameterName"])), F.slice(plain, 1, 0))
    return things.select(*key, "net", "place", F.posexplode(F.concat(plain, ins, outs)).alias("pin", "p")).select(*key, "net", "place", "pin", "p.*")


def links(all_pins: DataFrame, key: list[str]) -> DataFrame:
    """(key, net, src_place, src_pin, dst_place, dst_pin): inputs joined with the outputs of their body that they refer to."""
    wants = all_pins.filter("is_input").select(*key, "net", F.col("place").alias("dst_place"), F.col("pin").alias("dst_pin"), F.explode("refs").alias("out_id"))
    gives = all_pins.filter("NOT is_input").select(*key, "out_id", F.col("place").alias("src_place"), F.col("pin").alias("src_pin"))
    return wants.join(gives, [*key, "out_id"]).select(*key, "net", "src_place", "src_pin", "dst_place", "dst_pin")


def numbered(nets: DataFrame, things: DataFrame, key: list[str]) -> DataFrame:
    """(key, net, place, last_id): the last new id that each network (place 0: three, its rails' and the left rail's output) and object (a sink's or block's output: one) has taken."""
    takes = nets.select(*key, "net", F.lit(0).alias("place"), F.lit(3).alias("n")).unionByName(things.select(*key, "net", "place", F.when(F.col("kind").isin("DataSink", "Block"), 1).otherwise(0).alias("n")))
    return takes.select(*key, "net", "place", (FIRST_ID + F.sum("n").over(W.partitionBy(*key).orderBy("net", "place"))).alias("last_id"))


def _escaped(c: Column) -> Column:
    for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        c = F.replace(c, F.lit(a), F.lit(b))
    return c


def _attributes(**named: Column) -> Column:
    return F.concat(*[F.coalesce(F.concat(F.lit(f' {k.replace("__", ":")}="'), _escaped(v.cast("string")), F.lit('"')), F.lit("")) for k, v in named.items()])


def _at(x: Column, y: Column) -> Column:
    return F.concat(F.lit("<RelPosition"), _attributes(x=x, y=y), F.lit("/>"))


def _connection(ref: Column) -> Column:
    return F.concat(F.lit("<Connection"), _attributes(refConnectionPointOutId=ref), F.lit("/>"))


def _in(at: Column, refs: Column) -> Column:
    return F.concat(F.lit("<ConnectionPointIn>"), at, F.array_join(F.transform(refs, _connection), ""), F.lit("</ConnectionPointIn>"))


def _out(out_id: Column, at: Column) -> Column:
    return F.concat(F.lit("<ConnectionPointOut"), _attributes(connectionPointOutId=out_id), F.lit(">"), at, F.lit("</ConnectionPointOut>"))


def _tag(name: str, attributes: Column, inside: Column) -> Column:
    return F.concat(F.lit(f"<{name}"), attributes, F.lit(">"), inside, F.lit(f"</{name}>"))


def to_ladder(bodies: DataFrame, key: list[str], xml: str = "xml") -> DataFrame:
    """(key, ladder, n_rungs): each FBD body as an LD body."""
    nets = networks(bodies, key, xml)
    things = objects(nets, key)
    ids = numbered(nets, things, key)
    rails = ids.filter("place = 0").select(*key, "net", (F.col("last_id") - 2).alias("left_id"), (F.col("last_id") - 1).alias("left_out"), F.col("last_id").alias("right_id"))
    s, n = (lambda v: F.lit(str(v))), F.lit(None).cast("string")
    pin_xml = F.when(F.col("is_input"), _in(F.coalesce(_at(F.col("at._x"), F.col("at._y")), F.lit("")), F.col("refs"))).otherwise(_out(F.col("out_id"), F.coalesce(_at(F.col("at._x"), F.col("at._y")), F.lit(""))))
    written = F.when(F.col("parameter").isNull(), pin_xml).otherwise(_tag_if("InputVariable", "OutputVariable", pin_xml))
    own = pins(things, key).groupBy(*key, "net", "place").agg(*(F.array_sort(F.collect_list(F.when(w, F.struct("pin", written.alias("x"))))).alias(a) for a, w in (("plain_in", F.col("parameter").isNull() & F.col("is_input")), ("plain_out", F.col("parameter").isNull() & ~F.col("is_input")), ("ins", F.col("parameter").isNotNull() & F.col("is_input")), ("outs", F.col("parameter").isNotNull() & ~F.col("is_input")))))  # an object's pins
    text = lambda c: F.coalesce(F.array_join(F.transform(c, lambda p: p["x"]), ""), F.lit(""))
    t = things.join(rails, [*key, "net"]).join(ids, [*key, "net", "place"]).join(own, [*key, "net", "place"], "left")
    o, left, fresh = F.col("object"), F.col("left_out").cast("string"), F.col("last_id").cast("string")
    at = F.when(o["RelPosition"].isNotNull(), _at(o["RelPosition"]["_x"], o["RelPosition"]["_y"])).otherwise("")
    named = lambda kind: _attributes(globalId=o["_globalId"], xsi__type=s(kind), operand=F.coalesce(o["_identifier"], s("VAR")))
    contact = _tag("LdObject", named("Contact"), F.concat(at, _in(_at(s(0), s(10)), F.array(left)), text("plain_in"), text("plain_out")))
    coil = _tag("LdObject", named("Coil"), F.concat(at, text("plain_in"), text("plain_out"), _out(fresh, _at(s(20), s(10)))))
    en = F.concat(F.lit('<InputVariable parameterName="EN">'), _in(_at(s(0), s(0)), F.array(left)), F.lit("</InputVariable>"))
    eno = F.concat(F.lit('<OutputVariable parameterName="ENO">'), _out(fresh, _at(s(0), s(0))), F.lit("</OutputVariable>"))
    kept = _attributes(globalId=o["_globalId"], xsi__type=F.col("kind"), identifier=o["_identifier"], typeName=o["_typeName"])
    block = _tag("FbdObject", kept, F.concat(at, text("plain_in"), text("plain_out"), _tag("InputVariables", s(""), F.concat(en, text("ins"))), _tag("OutputVariables", s(""), F.concat(eno, text("outs")))))
    other = _tag("FbdObject", kept, F.concat(at, text("plain_in"), text("plain_out"), F.when(F.size("ins") > 0, _tag("InputVariables", s(""), text("ins"))).otherwise(""), F.when(F.size("outs") > 0, _tag("OutputVariables", s(""), text("outs"))).otherwise("")))
    element = F.when(F.col("kind") == "DataSource", contact).when(F.col("kind") == "DataSink", coil).when(F.col("kind") == "Block", block).otherwise(other)
    rows = t.select(*key, "net", "place", element.alias("element"), F.when(F.col("kind") == "DataSink", F.col("last_id")).alias("coil_out"))
    inner = rows.groupBy(*key, "net").agg(F.array_sort(F.collect_list(F.struct("place", "element"))).alias("elements"), F.array_sort(F.collect_list("coil_out")).alias("coils"))  # a network's objects
    r = nets.select(*key, "net", "evaluation").join(rails, [*key, "net"]).join(inner, [*key, "net"], "left")
    left_rail = _tag("LdObject", _attributes(globalId=F.concat(s("OBJ_"), "left_id"), xsi__type=s("LeftPowerRail")), F.concat(_at(s(10), s(50)), _out(left, _at(s(10), s(20)))))
    coils = F.coalesce(F.transform("coils", lambda c: c.cast("string")), F.array().cast("array<string>"))
    right_rail = _tag("LdObject", _attributes(globalId=F.concat(s("OBJ_"), "right_id"), xsi__type=s("RightPowerRail")), F.concat(_at(s(1000), s(50)), _in(_at(s(0), s(20)), coils)))
    rung = _tag("Rung", _attributes(evaluationOrder=F.col("evaluation")), F.concat(left_rail, F.coalesce(F.array_join(F.transform("elements", lambda e: e["element"]), ""), F.lit("")), right_rail))
    g = r.select(*key, "net", rung.alias("rung")).groupBy(*key).agg(F.array_sort(F.collect_list(F.struct("net", "rung"))).alias("rungs"))  # a body's rungs
    head = F.lit(f'<BodyContent xmlns="{NAMESPACE}" xmlns:xsi="http://www.w3.org/2001/XMLSchema-instance" xsi:type="LD">')
    out = g.select(*key, F.array_join(F.transform("rungs", lambda x: x["rung"]), "").alias("rungs"), F.size("rungs").cast("long").alias("n_rungs"))
    all_ = bodies.select(*key).join(out, key, "left")
    return all_.select(*key, F.concat(head, F.coalesce("rungs", F.lit("")), F.lit("</BodyContent>")).alias("ladder"), F.coalesce("n_rungs", F.lit(0).cast("long")).alias("n_rungs"))


def _tag_if(of_in: str, of_out: str, inside: Column) -> Column:
    name = F.when(F.col("is_input"), of_in).otherwise(of_out)
    return F.concat(F.lit("<"), name, _attributes(parameterName=F.col("parameter")), F.lit(">"), inside, F.lit("</"), name, F.lit(">"))
