"""Diagrams of turns turned into ladders. A conversation is a body and a turn a network: a source, perhaps a block, a sink. The SQL writes the ladder from the same rules, text by text."""

from __future__ import annotations

from ..operators import ladders

QUERIES: dict = {}
ORACLE_SQL: dict = {}
V = "CAST({} AS VARCHAR(20))"
T, K = V.format("turn"), V.format("k % 7")
_BLOCK = "'<FbdObject globalId=\"B' || " + T + " || '\" xsi:type=\"Block\" typeName=\"ADD\">"
FBD = f"""SELECT conv_id, array_join(array_sort(collect_list(struct(turn, net))).net, '') AS nets FROM (SELECT conv_id, turn, '<Network evaluationOrder="' || {V.format('turn + 1')} || '"><FbdObject globalId="S' || {T} || '" xsi:type="DataSource" identifier="a&lt;' || {K} || '"><RelPosition x="1" y="2"/><ConnectionPointOut connectionPointOutId="' || {V.format('10 * turn + 1')} || '"><RelPosition x="3" y="4"/></ConnectionPointOut></FbdObject>'
 || CASE WHEN k % 3 = 0 THEN '<FbdObject globalId="B' || {T} || '" xsi:type="Block" typeName="ADD"><RelPosition x="5" y="6"/><InputVariables><InputVariable parameterName="IN1"><ConnectionPointIn><RelPosition x="0" y="1"/><Connection refConnectionPointOutId="' || {V.format('10 * turn + 1')} || '"/></ConnectionPointIn></InputVariable></InputVariables><OutputVariables><OutputVariable parameterName="OUT"><ConnectionPointOut connectionPointOutId="' || {V.format('10 * turn + 2')} || '"><RelPosition x="9" y="1"/></ConnectionPointOut></OutputVariable></OutputVariables></FbdObject>' ELSE '' END
 || '<FbdObject globalId="K' || {T} || '" xsi:type="DataSink"' || CASE WHEN k % 5 > 0 THEN ' identifier="b' || {K} || '"' ELSE '' END || '><RelPosition x="7" y="8"/><ConnectionPointIn><RelPosition x="0" y="5"/><Connection refConnectionPointOutId="' || {V.format('10 * turn + CASE WHEN k % 3 = 0 THEN 2 ELSE 1 END')} || '"/></ConnectionPointIn></FbdObject></Network>' AS net FROM (SELECT conv_id, turn, length(text) AS k FROM {{conversations}}) t) u GROUP BY conv_id"""
_I = lambda n: f"CAST(i + {n} AS VARCHAR)"  # noqa: E731  ids of a rung after those before it
SQL = f"""SELECT conv_id, '<BodyContent xmlns="{ladders.NAMESPACE}" xmlns:xsi="http://www.w3.org/2001/XMLSchema-instance" xsi:type="LD">' || string_agg(rung, '' ORDER BY turn) || '</BodyContent>' AS ladder, count(*) AS n_rungs FROM (
SELECT conv_id, turn, '<Rung evaluationOrder="' || (turn + 1) || '"><LdObject globalId="OBJ_' || {_I(1)} || '" xsi:type="LeftPowerRail"><RelPosition x="10" y="50"/><ConnectionPointOut connectionPointOutId="' || {_I(2)} || '"><RelPosition x="10" y="20"/></ConnectionPointOut></LdObject>'
 || '<LdObject globalId="S' || turn || '" xsi:type="Contact" operand="a&lt;' || k % 7 || '"><RelPosition x="1" y="2"/><ConnectionPointIn><RelPosition x="0" y="10"/><Connection refConnectionPointOutId="' || {_I(2)} || '"/></ConnectionPointIn><ConnectionPointOut connectionPointOutId="' || (10 * turn + 1) || '"><RelPosition x="3" y="4"/></ConnectionPointOut></LdObject>'
 || CASE WHEN k % 3 = 0 THEN '<FbdObject globalId="B' || turn || '" xsi:type="Block" typeName="ADD"><RelPosition x="5" y="6"/><InputVariables><InputVariable parameterName="EN"><ConnectionPointIn><RelPosition x="0" y="0"/><Connection refConnectionPointOutId="' || {_I(2)} || '"/></ConnectionPointIn></InputVariable><InputVariable parameterName="IN1"><ConnectionPointIn><RelPosition x="0" y="1"/><Connection refConnectionPointOutId="' || (10 * turn + 1) || '"/></ConnectionPointIn></InputVariable></InputVariables><OutputVariables><OutputVariable parameterName="ENO"><ConnectionPointOut connectionPointOutId="' || {_I(4)} || '"><RelPosition x="0" y="0"/></ConnectionPointOut></OutputVariable><OutputVariable parameterName="OUT"><ConnectionPointOut connectionPointOutId="' || (10 * turn + 2) || '"><RelPosition x="9" y="1"/></ConnectionPointOut></OutputVariable></OutputVariables></FbdObject>' ELSE '' END
 || '<LdObject globalId="K' || turn || '" xsi:type="Coil" operand="' || CASE WHEN k % 5 > 0 THEN 'b' || k % 7 ELSE 'VAR' END || '"><RelPosition x="7" y="8"/><ConnectionPointIn><RelPosition x="0" y="5"/><Connection refConnectionPointOutId="' || (10 * turn + CASE WHEN k % 3 = 0 THEN 2 ELSE 1 END) || '"/></ConnectionPointIn><ConnectionPointOut connectionPointOutId="' || CAST(i + n AS VARCHAR) || '"><RelPosition x="20" y="10"/></ConnectionPointOut></LdObject>'
 || '<LdObject globalId="OBJ_' || {_I(3)} || '" xsi:type="RightPowerRail"><RelPosition x="1000" y="50"/><ConnectionPointIn><RelPosition x="0" y="20"/><Connection refConnectionPointOutId="' || CAST(i + n AS VARCHAR) || '"/></ConnectionPointIn></LdObject></Rung>' AS rung
FROM (SELECT *, 90000 + coalesce(sum(n) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS i FROM (SELECT conv_id, turn, length(text) AS k, CASE WHEN length(text) % 3 = 0 THEN 5 ELSE 4 END AS n FROM conversations) t) u) v GROUP BY conv_id"""


def ladder_xml(spark, sf_dir):
    nets = spark.sql(FBD, conversations=spark.read.parquet(f"{sf_dir}/conversations.parquet"))
    head = f'<BodyContent xmlns="{ladders.NAMESPACE}" xmlns:xsi="http://www.w3.org/2001/XMLSchema-instance" xsi:type="FBD">'
    bodies = nets.selectExpr("conv_id", f"'{head}' || nets || '</BodyContent>' AS xml")
    return ladders.to_ladder(bodies, ["conv_id"]).select("conv_id", "ladder", "n_rungs")


QUERIES["ladder_xml"], ORACLE_SQL["ladder_xml"] = ladder_xml, SQL
