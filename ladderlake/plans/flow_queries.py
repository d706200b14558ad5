"""Queries on control flow, data flow and dependences. A conversation is a program and a turn an instruction; what it does, where it goes and which variables it touches follow from the length of its text. The SQL walks the paths one by one."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import flow as P

QUERIES: dict = {}
ORACLE_SQL: dict = {}
KEY = ["conv_id"]
INSTRUCTIONS = """SELECT conv_id, turn AS ip, line, CASE k % 5 WHEN 0 THEN 'branch' WHEN 1 THEN 'goto' ELSE 'assign' END AS op, 'L' || CAST(turn AS VARCHAR(20)) AS label,
  CASE WHEN k % 5 < 2 THEN 'L' || CAST((turn + CAST(floor(k / 5) AS BIGINT)) % n AS VARCHAR(20)) END AS target, CASE WHEN k % 5 = 0 THEN 'L' || CAST((turn * 3 + 1 + CAST(floor(k / 7) AS BIGINT)) % n AS VARCHAR(20)) END AS other,
  CASE WHEN k % 5 > 1 THEN 'v' || CAST(CAST(floor(k / 25) AS BIGINT) % 4 AS VARCHAR(20)) END AS d, 'v' || CAST(CAST(floor(k / 100) AS BIGINT) % 4 AS VARCHAR(20)) AS u1, 'v' || CAST((turn + k) % 4 AS VARCHAR(20)) AS u2
  FROM (SELECT conv_id, turn, CAST(floor(turn / 2) AS BIGINT) AS line, length(text) AS k, count(*) OVER (PARTITION BY conv_id) AS n FROM {conversations}) t"""
#: CTEs: instructions, edges; walks of definitions; which instructions reach an end, also without p; post-dominators; walks from branches; dependences.
D_I = f"i AS ({INSTRUCTIONS.replace('{conversations}', 'conversations')})"
D_E = "e AS (SELECT i.conv_id, i.ip AS src, l.ip AS dst FROM i JOIN i l ON l.conv_id = i.conv_id AND (l.label = i.target OR l.label = i.other) UNION SELECT a.conv_id, a.ip, b.ip FROM i a JOIN i b ON b.conv_id = a.conv_id AND b.ip = a.ip + 1 WHERE a.op = 'assign')"
D_B = "b AS (SELECT conv_id, ip, CAST(sum(leads) OVER (PARTITION BY conv_id ORDER BY ip) AS BIGINT) AS block FROM (SELECT i.conv_id, i.ip, CASE WHEN i.ip > 0 AND (EXISTS (SELECT 1 FROM i p WHERE p.conv_id = i.conv_id AND p.ip = i.ip - 1 AND p.op <> 'assign') OR EXISTS (SELECT 1 FROM i p JOIN e ON e.conv_id = p.conv_id AND e.src = p.ip WHERE p.conv_id = i.conv_id AND p.op <> 'assign' AND e.dst = i.ip)) THEN 1 ELSE 0 END AS leads FROM i) l)"
D_R = "r(conv_id, var, def_ip, at_ip) AS (SELECT i.conv_id, i.d, i.ip, e.dst FROM i JOIN e ON e.conv_id = i.conv_id AND e.src = i.ip WHERE i.d IS NOT NULL UNION SELECT r.conv_id, r.var, r.def_ip, e.dst FROM r JOIN i x ON x.conv_id = r.conv_id AND x.ip = r.at_ip AND x.d IS DISTINCT FROM r.var JOIN e ON e.conv_id = r.conv_id AND e.src = r.at_ip)"
D_DU = "du AS (SELECT r.conv_id, r.var, r.def_ip, r.at_ip AS use_ip FROM r JOIN i ON i.conv_id = r.conv_id AND i.ip = r.at_ip AND r.var IN (i.u1, i.u2))"
D_PD = """last AS (SELECT conv_id, ip FROM i WHERE NOT EXISTS (SELECT 1 FROM e WHERE e.conv_id = i.conv_id AND e.src = i.ip)),
can(conv_id, ip) AS (SELECT * FROM last UNION SELECT e.conv_id, e.src FROM can JOIN e ON e.conv_id = can.conv_id AND e.dst = can.ip),
without(conv_id, p, ip) AS (SELECT i.conv_id, i.ip, last.ip FROM i JOIN last ON last.conv_id = i.conv_id AND last.ip <> i.ip UNION SELECT e.conv_id, w.p, e.src FROM without w JOIN e ON e.conv_id = w.conv_id AND e.dst = w.ip AND e.src <> w.p),
pd AS (SELECT i.conv_id, i.ip, q.ip AS by_ip, EXISTS (SELECT 1 FROM can WHERE can.conv_id = i.conv_id AND can.ip = i.ip) AS ends FROM i JOIN i q ON q.conv_id = i.conv_id AND q.ip <> i.ip WHERE NOT EXISTS (SELECT 1 FROM without w WHERE w.conv_id = i.conv_id AND w.p = q.ip AND w.ip = i.ip))"""
D_CD = """c(conv_id, src, dst) AS (SELECT e.conv_id, e.src, e.dst FROM i JOIN e ON e.conv_id = i.conv_id AND e.src = i.ip WHERE i.op = 'branch' AND NOT EXISTS (SELECT 1 FROM pd WHERE pd.conv_id = e.conv_id AND pd.ip = e.src AND pd.by_ip = e.dst)
  UNION SELECT c.conv_id, c.src, e.dst FROM c JOIN e ON e.conv_id = c.conv_id AND e.src = c.dst WHERE NOT EXISTS (SELECT 1 FROM pd WHERE pd.conv_id = c.conv_id AND pd.ip = c.src AND pd.by_ip = e.dst))"""
D_DEP = "dep AS (SELECT DISTINCT conv_id, def_ip AS src, use_ip AS dst, 'data' AS kind FROM du WHERE def_ip <> use_ip UNION ALL SELECT conv_id, src, dst, 'control' FROM c)"


def query(*ctes: str, sql: str):
    def add(f):
        QUERIES[f.__name__] = f
        ORACLE_SQL[f.__name__] = f"WITH RECURSIVE {', '.join([D_I, *ctes])} {sql}"
        return f

    return add


def _instructions(spark, sf_dir):
    t = spark.sql(INSTRUCTIONS, conversations=spark.read.parquet(f"{sf_dir}/conversations.parquet"))
    return t.withColumn("defs", F.array_compact(F.array("d"))).withColumn("uses", F.array("u1", "u2")).drop("d", "u1", "u2")


@query(D_E, sql="SELECT conv_id, src, dst FROM e")
def flow_edges(spark, sf_dir):
    return P.edges(_instructions(spark, sf_dir), KEY).select("conv_id", "src", "dst")


@query(D_E, D_B, sql="""SELECT conv_id, block, first_ip, last_ip, coalesce(goes, '') AS goes FROM (SELECT conv_id, block, min(ip) AS first_ip, max(ip) AS last_ip FROM b GROUP BY conv_id, block) s LEFT JOIN (SELECT conv_id, block, string_agg(CAST(t AS VARCHAR), ',' ORDER BY t) AS goes FROM (SELECT DISTINCT x.conv_id, x.block, y.block AS t FROM b x JOIN e ON e.conv_id = x.conv_id AND e.src = x.ip JOIN b y ON y.conv_id = x.conv_id AND y.ip = e.dst
  WHERE NOT EXISTS (SELECT 1 FROM b z WHERE z.conv_id = x.conv_id AND z.block = x.block AND z.ip > x.ip)) u GROUP BY conv_id, block) g USING (conv_id, block)""")
def flow_blocks(spark, sf_dir):
    blocks, links = P.blocks(_instructions(spark, sf_dir), KEY)
    goes = links.groupBy("conv_id", F.col("src").alias("block")).agg(F.array_join(F.sort_array(F.collect_set("dst")), ",").alias("goes"))  # two at most
    return blocks.join(goes.hint("merge"), ["conv_id", "block"], "left").select("conv_id", "block", "first_ip", "last_ip", F.coalesce("goes", F.lit("")).alias("goes"))


@query(sql="SELECT a.conv_id, a.ip, a.d AS var, b.ip AS kills FROM i a JOIN i b ON b.conv_id = a.conv_id AND b.d = a.d AND b.ip <> a.ip")
def flow_kills(spark, sf_dir):
    _, kill = P.gen_kill(_instructions(spark, sf_dir), KEY)
    return P.members(kill, KEY, "kills").select("conv_id", F.col("node").alias("ip"), F.col("part").alias("var"), "kills")


@query(D_E, D_R, D_DU, sql="SELECT DISTINCT conv_id, var, def_ip, use_ip FROM du")
def flow_def_use(spark, sf_dir):
    return P.def_use(_instructions(spark, sf_dir), KEY)


@query(D_E, D_PD, sql="SELECT pd.conv_id, pd.ip, pd.by_ip, pd.ends, pd.ends AND coalesce(y.n, 0) = x.n - 1 AS is_nearest FROM pd JOIN (SELECT conv_id, ip, count(*) AS n FROM pd GROUP BY conv_id, ip) x ON x.conv_id = pd.conv_id AND x.ip = pd.ip LEFT JOIN (SELECT conv_id, ip, count(*) AS n FROM pd WHERE ends GROUP BY conv_id, ip) y ON y.conv_id = pd.conv_id AND y.ip = pd.by_ip")
def flow_postdominators(spark, sf_dir):
    return P.nearest(P.postdominators(_instructions(spark, sf_dir), KEY), KEY)


@query(D_E, D_R, D_DU, D_PD, D_CD, D_DEP, sql="SELECT conv_id, src, dst, kind FROM dep")
def flow_dependences(spark, sf_dir):
    return P.dependences(_instructions(spark, sf_dir), KEY).select("conv_id", "src", "dst", "kind")


@query(D_E, D_R, D_DU, D_PD, D_CD, D_DEP, "s(conv_id, var, ip) AS (SELECT conv_id, d, ip FROM i WHERE d IS NOT NULL UNION SELECT s.conv_id, s.var, dep.src FROM s JOIN dep ON dep.conv_id = s.conv_id AND dep.dst = s.ip)", sql="SELECT conv_id, var, n_instructions, lines FROM (SELECT conv_id, var, count(*) AS n_instructions FROM s GROUP BY conv_id, var) a JOIN (SELECT conv_id, var, string_agg(CAST(line AS VARCHAR), ',' ORDER BY line) AS lines FROM (SELECT DISTINCT s.conv_id, s.var, i.line FROM s JOIN i ON i.conv_id = s.conv_id AND i.ip = s.ip) t GROUP BY conv_id, var) b USING (conv_id, var)")
def flow_slices(spark, sf_dir):
    """For each variable of a program: what its definitions depend on, as instructions and as lines of two instructions."""
    instr = _instructions(spark, sf_dir)
    seeds = P.definitions(instr, KEY).select("conv_id", "var", F.col("ip").alias("node"))
    slices = P.backward_slices(P.dependences(instr, KEY), seeds, KEY, "var")
    places = instr.select("conv_id", F.col("ip").alias("node"), F.col("line").alias("statement"))
    lines = P.statements(slices, places, KEY).groupBy("conv_id", "var").agg(F.array_join(F.sort_array(F.collect_list("statement")), ",").alias("lines"))  # a program's lines
    return slices.groupBy("conv_id", "var").agg(F.count("*").alias("n_instructions")).join(lines.hint("merge"), ["conv_id", "var"])
