"""Diagrams turned into ladders: XML against DuckDB's, links, and bodies without networks."""

import xml.etree.ElementTree as ET

import pytest

from ladderlake.operators import ladders
from ladderlake.plans import ladder_queries

from .test_catalogue import con, same  # noqa: F401

HEAD = f'<BodyContent xmlns="{ladders.NAMESPACE}" xmlns:xsi="http://www.w3.org/2001/XMLSchema-instance" xsi:type="FBD">'


@pytest.mark.parametrize("name", sorted(ladder_queries.QUERIES))
def test_query(spark, con, name):  # noqa: F811
    same(spark, con, ladder_queries, name)


def test_every_link_of_a_ladder_leads_to_an_output(spark):
    source = lambda i: f'<FbdObject globalId="S{i}" xsi:type="DataSource" identifier="s{i}"><ConnectionPointOut connectionPointOutId="{i}"/></FbdObject>'
    sink = lambda i: f'<FbdObject globalId="K{i}" xsi:type="DataSink" identifier="k{i}"><ConnectionPointIn><Connection refConnectionPointOutId="{i}"/></ConnectionPointIn></FbdObject>'
    block = '<FbdObject globalId="B" xsi:type="Block" typeName="F"/><FbdObject globalId="J" xsi:type="Jump"/>'
    df = spark.createDataFrame([(1, f"{HEAD}<Network>{source(1)}{source(2)}{sink(1)}{sink(2)}{sink(1)}</Network><Network>{block}</Network></BodyContent>"), (2, f"{HEAD}</BodyContent>"), (3, None)], "k int, xml string")
    got = {r["k"]: r for r in ladders.to_ladder(df, ["k"]).collect()}
    assert (got[1]["n_rungs"], got[2]["n_rungs"], got[3]["n_rungs"]) == (2, 0, 0)
    root = ET.fromstring(got[1]["ladder"])
    name = lambda e: e.tag.split("}")[1]
    outs = [e.get("connectionPointOutId") for e in root.iter() if name(e) == "ConnectionPointOut"]
    refs = [e.get("refConnectionPointOutId") for e in root.iter() if name(e) == "Connection"]
    assert len(outs) == len(set(outs)) == 8 and set(refs) <= set(outs)
    assert [len(list(rung)) for rung in root] == [7, 4]
    kinds = [o.get("{http://www.w3.org/2001/XMLSchema-instance}type") for o in root[0]]
    assert kinds == ["LeftPowerRail", "Contact", "Contact", "Coil", "Coil", "Coil", "RightPowerRail"]
    assert [c.get("refConnectionPointOutId") for c in root[0][-1].iter() if name(c) == "Connection"] == ["90004", "90005", "90006"]
    things = ladders.objects(ladders.networks(df, ["k"], "xml"), ["k"])
    assert sorted((r["src_place"], r["dst_place"]) for r in ladders.links(ladders.pins(things, ["k"]), ["k"]).collect()) == [(1, 3), (1, 5), (2, 4)]
