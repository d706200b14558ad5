"""Queries on the lines of programs, and on standard functions, with SQL that another engine runs."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import code as C
from ..functions import prompts as T
from ..functions import standard as S
from ..operators import blocks as B
from ..operators.structures import clamped_depth as clamped_depths
from ..operators.tables import spread

QUERIES: dict = {}
ORACLE_SQL: dict = {}

#: Programs of stages with loops, branches, comments and gaps, up to some hundred lines, by the remainders of the key.
STAGED = """SELECT p_partkey, 'x := 0;' || chr(10) || repeat('a := a + 1;' || chr(10), CAST(p_partkey % 13 AS INT)) || CASE WHEN p_partkey % 4 > 0 THEN 'IF stage = 1 THEN // IF' || chr(10) || repeat('  b := b + 1;' || chr(10), CAST(p_partkey % 6 AS INT)) || 'ELSIF b > 1 THEN' || chr(10) || 'END_IF;' || chr(10) ELSE '' END || repeat('FOR i := 1 TO 3 DO' || chr(10) || 'IF a > i THEN a := 0; END_IF;' || chr(10) || '(* gap *)' || chr(10) || 'END_FOR;' || chr(10), CAST(p_partkey % 5 AS INT)) || CASE WHEN p_partkey % 3 = 0 THEN 'IF a > 2 AND State = S.two THEN' || chr(10) || 'CASE a OF' || chr(10) || '1: a := 2;' || chr(10) || 'END_CASE;' || chr(10) || 'END_IF;' || chr(10) ELSE '' END || repeat('c := c - 1;' || chr(10) || chr(10), CAST(p_partkey % 9 AS INT)) || CASE p_partkey % 11 WHEN 0 THEN 'END_IF;' WHEN 1 THEN 'WHILE a > 0 DO' WHEN 2 THEN 'REPEAT a := 1; UNTIL TRUE END_REPEAT;' ELSE 'd := 1;' END AS code FROM {part}"""
D_STAGED = STAGED.replace("{part}", "part")
D_LINES = f"(SELECT p_partkey, unnest(string_split(code, chr(10))) AS line, generate_subscripts(string_split(code, chr(10)), 1) AS ln FROM ({D_STAGED}) c)"
D_CLEAN = f"(SELECT p_partkey, ln, line, upper(regexp_replace(regexp_replace(line, '//.*$', ''), '\\(\\*.*?\\*\\)', '', 'g')) AS u FROM {D_LINES} l)"
KEY = ["p_partkey"]


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


def _staged(spark, sf_dir):
    part = spread(spark.read.parquet(f"{sf_dir}/part.parquet").select(*KEY), *KEY)
    return B.lines_of(spark.sql(STAGED, part=part))


def _per_kind(kind: str) -> str:
    return f"SELECT p_partkey, ln, '{kind}' AS kind, regexp_matches(u, '^\\s*{kind}\\b') AS head, len(regexp_extract_all(u, '\\bEND_{kind}\\b')) AS ends FROM {D_CLEAN} q"


D_KINDS = "(" + " UNION ALL ".join(_per_kind(k) for k in ("IF", "FOR", "CASE", "WHILE", "REPEAT")) + ")"


@query(f"""WITH k AS (SELECT * FROM {D_KINDS} x WHERE head OR ends > 0), j AS (SELECT a.p_partkey, a.kind, a.ln, b.ln AS to_ln, b.ends, sum(CAST(b.head AS INT) - b.ends) OVER (PARTITION BY a.p_partkey, a.kind, a.ln ORDER BY b.ln) AS depth FROM k a JOIN k b ON a.p_partkey = b.p_partkey AND a.kind = b.kind AND b.ln >= a.ln WHERE a.head)
SELECT p_partkey, kind, CAST(ln AS BIGINT) AS ln, CAST(coalesce(min(CASE WHEN depth = 0 AND ends > 0 THEN to_ln END), ln) AS BIGINT) AS end_ln FROM j GROUP BY p_partkey, kind, ln""")
def structure_ends(spark, sf_dir):
    return B.structure_ends(_staged(spark, sf_dir), KEY).select("p_partkey", "kind", F.col("ln").cast("long").alias("ln"), F.col("end_ln").cast("long").alias("end_ln"))


def _parts(cut: str, least: int, whole: str) -> str:
    """SQL: cut (p_partkey, ln, seg) merged by size; lines of `whole` that no cut has are one part."""
    return f"""sized AS (SELECT p_partkey, seg, count(*) AS n FROM {cut} GROUP BY p_partkey, seg), numbered AS (SELECT *, sum(CASE WHEN n >= {least} OR seg = first_seg THEN 1 ELSE 0 END) OVER (PARTITION BY p_partkey ORDER BY seg) AS part FROM (SELECT *, min(seg) OVER (PARTITION BY p_partkey) AS first_seg FROM sized) s),
totals AS (SELECT p_partkey, part, sum(n) AS size FROM numbered GROUP BY p_partkey, part), best AS (SELECT p_partkey, max(size) AS biggest FROM totals GROUP BY p_partkey),
placed AS (SELECT c.p_partkey, c.ln, CASE WHEN biggest >= {least // 2} THEN n.part ELSE 1 END AS part FROM {cut} c JOIN numbered n USING (p_partkey, seg) JOIN totals t ON t.p_partkey = n.p_partkey AND t.part = n.part JOIN best b ON b.p_partkey = n.p_partkey WHERE t.size >= {least // 2} OR biggest < {least // 2} UNION ALL SELECT p_partkey, ln, 1 AS part FROM {whole} w)
SELECT p_partkey, CAST(part AS BIGINT) AS part, count(*) AS n_lines, CAST(min(ln) AS BIGINT) AS first_ln, CAST(max(ln) AS BIGINT) AS last_ln FROM placed GROUP BY p_partkey, part"""


def _summary(parts):
    return parts.groupBy("p_partkey", "part").agg(F.count("*").alias("n_lines"), F.min("ln").cast("long").alias("first_ln"), F.max("ln").cast("long").alias("last_ln"))


@query(rf"WITH m AS (SELECT p_partkey, ln, regexp_matches(upper(line), '\bIF\b.*\b(STAGE|STATE)\b\s*=\s*[\w.]+') AS mark, row_number() OVER (PARTITION BY p_partkey ORDER BY ln) AS i FROM {D_LINES} l), c AS (SELECT p_partkey, ln, sum(CASE WHEN mark OR i = 1 THEN 1 ELSE 0 END) OVER (PARTITION BY p_partkey ORDER BY ln) AS seg, bool_or(mark) OVER (PARTITION BY p_partkey) AS marked FROM m), cut AS (SELECT * FROM c WHERE marked), whole AS (SELECT * FROM c WHERE NOT marked), " + _parts("cut", 5, "whole"))
def split_by_stage(spark, sf_dir):
    return _summary(B.split_by_stage(_staged(spark, sf_dir), KEY))


D_DELTA = r"(CAST(regexp_matches(u, '^\s*(IF|CASE|FOR|WHILE|REPEAT)\b') AS INT) - len(regexp_extract_all(u, '\bEND_(?:IF|CASE|FOR|WHILE|REPEAT)\b')))"


@query(f"""WITH RECURSIVE l AS (SELECT p_partkey, ln, {D_DELTA} AS d, row_number() OVER (PARTITION BY p_partkey ORDER BY ln) AS i, count(*) OVER (PARTITION BY p_partkey) AS m FROM {D_CLEAN} q WHERE ln % 7 <> 3),
f AS (SELECT p_partkey, i, ln, CAST(1 AS BIGINT) AS seg, CAST(1 AS BIGINT) AS n, CAST(greatest(d, 0) AS BIGINT) AS depth FROM l WHERE i = 1 AND m > 12 UNION ALL
SELECT l.p_partkey, l.i, l.ln, f.seg + CASE WHEN f.depth = 0 AND ((l.ln <> f.ln + 1 AND f.n >= 4) OR f.n >= 12) THEN 1 ELSE 0 END, CASE WHEN f.depth = 0 AND ((l.ln <> f.ln + 1 AND f.n >= 4) OR f.n >= 12) THEN 1 ELSE f.n + 1 END, CAST(greatest(f.depth + l.d, 0) AS BIGINT) FROM f JOIN l ON l.p_partkey = f.p_partkey AND l.i = f.i + 1),
whole AS (SELECT p_partkey, ln FROM l WHERE m <= 12), """ + _parts("f", 4, "whole"))
def split_by_size(spark, sf_dir):
    return _summary(B.split_by_size(_staged(spark, sf_dir).filter("ln % 7 <> 3"), KEY, 4, 12))


@query(f"SELECT p_partkey, count(*) AS n_lines, min(d) >= 0 AND arg_max(d, ln) = 0 AS balanced, min(d) >= 0 AND arg_max(d, ln) = 0 AND count(*) >= 10 AS meaningful FROM (SELECT p_partkey, ln, sum({D_DELTA}) OVER (PARTITION BY p_partkey ORDER BY ln) AS d FROM {D_CLEAN} q) t GROUP BY p_partkey")
def meaningful_blocks(spark, sf_dir):
    return B.meaningful(_staged(spark, sf_dir), KEY)


@query(f"WITH RECURSIVE l AS (SELECT p_partkey, ln, {D_DELTA} AS d FROM {D_CLEAN} q), f AS (SELECT p_partkey, ln, CAST(greatest(d, 0) AS BIGINT) AS depth FROM l WHERE ln = 1 UNION ALL SELECT l.p_partkey, l.ln, CAST(greatest(f.depth + l.d, 0) AS BIGINT) FROM f JOIN l ON l.p_partkey = f.p_partkey AND l.ln = f.ln + 1) SELECT p_partkey, max(depth) AS deepest, sum(depth) AS total, arg_max(depth, ln) AS last FROM f GROUP BY p_partkey")
def clamped_depth(spark, sf_dir):
    d = clamped_depths(_staged(spark, sf_dir), KEY, C.ctrl_delta(F.col("line")))
    return d.groupBy("p_partkey").agg(F.max("depth").alias("deepest"), F.sum("depth").alias("total"), F.max_by("depth", "ln").alias("last"))


@query(f"SELECT class, count(*) AS n FROM (SELECT CASE WHEN t = '' THEN 'blank' WHEN t LIKE 'IF %' THEN 'if' WHEN t LIKE 'ELSIF %' THEN 'elsif' WHEN t = 'ELSE' OR t LIKE 'ELSE %' THEN 'else' WHEN t LIKE 'END\\_IF%' ESCAPE '\\' THEN 'end_if' WHEN NOT contains(t, ':=') AND contains(t, ':') THEN 'label' ELSE 'code' END AS class FROM (SELECT upper(trim(regexp_replace(regexp_replace(line, '\\(\\*.*?\\*\\)', '', 'g'), '//.*$', ''))) AS t FROM {D_LINES} l) x) y GROUP BY class")
def line_classes(spark, sf_dir):
    return _staged(spark, sf_dir).groupBy(C.line_class(F.col("line")).alias("class")).agg(F.count("*").alias("n"))


@query(f"""WITH k AS (SELECT * FROM {D_KINDS} x WHERE (head OR ends > 0) AND kind <> 'CASE'), j AS (SELECT a.p_partkey, a.kind, a.ln, b.ln AS to_ln, b.ends, sum(CAST(b.head AS INT) - b.ends) OVER (PARTITION BY a.p_partkey, a.kind, a.ln ORDER BY b.ln) AS depth FROM k a JOIN k b ON a.p_partkey = b.p_partkey AND a.kind = b.kind AND b.ln >= a.ln WHERE a.head),
e AS (SELECT p_partkey, kind, ln, coalesce(min(CASE WHEN depth = 0 AND ends > 0 THEN to_ln END), ln) AS end_ln FROM j GROUP BY p_partkey, kind, ln), b AS (SELECT p_partkey, ln, trim(u) <> '' AS full_line FROM {D_CLEAN} q WHERE ln % 5 <> 2),
g AS (SELECT e.p_partkey, e.ln, e.end_ln FROM e JOIN b h ON h.p_partkey = e.p_partkey AND h.ln = e.ln WHERE NOT EXISTS (SELECT 1 FROM b c WHERE c.p_partkey = e.p_partkey AND c.full_line AND c.ln > e.ln AND c.ln < e.end_ln))
SELECT b.p_partkey, count(*) AS n_lines, CAST(sum(b.ln) AS BIGINT) AS sum_ln FROM b WHERE NOT EXISTS (SELECT 1 FROM g WHERE g.p_partkey = b.p_partkey AND (g.ln = b.ln OR g.end_ln = b.ln)) GROUP BY b.p_partkey""")
def blocks_without_empty(spark, sf_dir):
    lines = _staged(spark, sf_dir)
    left = B.without_empty(lines.filter("ln % 5 <> 2"), lines, KEY, KEY)
    return left.groupBy("p_partkey").agg(F.count("*").alias("n_lines"), F.sum("ln").cast("long").alias("sum_ln"))


PROMPTS = {
    "system_prompt": "You write control programs.\n{% if golden_example %}\n[Example]\n{{ golden_example.task }}: {{ golden_example.code }}\n{% endif %}\n",
    "generation_template": 'Write a block for "{{ task }}".\n',
    "critique_template": "Task: {{ task }}\nCode: {{ code }}\n",
    "brainstorm_template": "{{ count }} tasks on {{topic}}",
}


@query("""SELECT conv_id, turn, 'You write control programs.' || chr(10) || CASE WHEN turn % 3 = 0 THEN chr(10) || '[Example]' || chr(10) || role || ': x := ' || turn || ';' || chr(10) ELSE '' END AS system_text, 'Write a block for "' || role || '".' AS task_text,
'Task: ' || role || chr(10) || 'Code: y;' AS critique, '10 tasks on ' || role AS brainstorm, '[Error: Prompt key ''nothing'' not found]' AS missing, 'user: Logic Error: r' || turn || '. Fix it.' AS feedback, CAST(4 AS BIGINT) AS n_messages FROM conversations""")
def prompt_messages(spark, sf_dir):
    c = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    golden = F.when(F.col("turn") % 3 == 0, F.struct(F.col("role").alias("task"), F.concat(F.lit("x := "), "turn", F.lit(";")).alias("code")))
    asked = T.chat(PROMPTS, "generate", task=F.col("role"), golden_example=golden)
    longer = T.with_feedback(asked, F.lit("y;"), F.lit("Logic"), F.concat(F.lit("r"), "turn"))
    m = c.select("conv_id", "turn", "role", longer.alias("m"))
    last = F.element_at("m", -1)
    return m.select(
        "conv_id", "turn", F.element_at("m", 1)["content"].alias("system_text"), F.element_at("m", 2)["content"].alias("task_text"), T.chat(PROMPTS, "critique", task=F.col("role"), code=F.lit("y;"))[0]["content"].alias("critique"),
        T.chat(PROMPTS, "brainstorm", topic=F.col("role"), count=F.lit(10))[0]["content"].alias("brainstorm"), T.render(PROMPTS, "nothing").alias("missing"), F.concat(last["role"], F.lit(": "), last["content"]).alias("feedback"), F.size("m").cast("long").alias("n_messages"),
    )


@query("SELECT family, count(*) AS n, CAST(sum(low) AS BIGINT) AS least, CAST(count(*) FILTER (high IS NULL) AS BIGINT) AS open_ended FROM (VALUES ('numeric', 11, 11, 0), ('arithmetic', 7, 13, 2), ('bit', 8, 15, 3), ('selection', 5, 13, 3), ('comparison', 6, 12, 5), ('string', 9, 22, 1), ('time', 9, 18, 0), ('blocks', 10, 23, 0)) v(family, m, low_sum, opens), LATERAL (SELECT CASE WHEN i = 1 THEN low_sum ELSE 0 END AS low, CASE WHEN i <= opens THEN NULL ELSE 1 END AS high FROM generate_series(1, m) g(i)) x GROUP BY family")
def function_table(spark, sf_dir):
    rows = [(family, name, low, high) for family, names in S.SIGNATURES.items() for name, (low, high) in names.items()]
    t = spark.createDataFrame(rows, "family string, name string, low int, high int")
    return t.groupBy("family").agg(F.count("*").alias("n"), F.sum("low").alias("least"), F.count_if(F.col("high").isNull()).alias("open_ended"))


@query("""SELECT l_orderkey, l_linenumber, CASE WHEN l_quantity > 127 THEN NULL ELSE CAST(l_quantity AS INTEGER) END AS to_sint, CAST(trunc(-l_extendedprice) AS BIGINT) AS cut, CAST(l_suppkey AS VARCHAR) AS to_string, l_linenumber % 2 <> 0 AS to_bool, TRY_CAST(l_returnflag AS INTEGER) AS no_int,
round(sqrt(l_quantity), 6) AS root, round(ln(l_quantity), 6) AS nat, round(log10(l_quantity), 6) AS dec, round(sin(l_quantity) + cos(l_quantity), 6) AS waves, abs(l_linenumber - 4) AS away FROM lineitem""")
def std_conversions_numeric(spark, sf_dir):
    li = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    q, c = F.col("l_quantity").cast("double"), S.call
    r = lambda x: F.round(x, 6)
    return li.select("l_orderkey", "l_linenumber", c("LREAL_TO_SINT", q).cast("int").alias("to_sint"), c("TRUNC", -F.col("l_extendedprice").cast("double")).alias("cut"), c("LINT_TO_STRING", F.col("l_suppkey")).alias("to_string"), c("DINT_TO_BOOL", F.col("l_linenumber") % 2).alias("to_bool"), c("STRING_TO_DINT", F.col("l_returnflag")).alias("no_int"), r(c("SQRT", q)).alias("root"), r(c("LN", q)).alias("nat"), r(c("LOG", q)).alias("dec"), r(c("ADD", c("SIN", q), c("COS", q))).alias("waves"), c("ABS", F.col("l_linenumber") - 4).alias("away"))


@query("""SELECT l_orderkey, l_linenumber, a + b + n AS s, a * b AS p, CASE WHEN n = 4 THEN NULL WHEN ((a - 50) < 0) <> ((n - 4) < 0) THEN -(abs(a - 50) // abs(n - 4)) ELSE abs(a - 50) // abs(n - 4) END AS q, CASE WHEN n = 4 THEN 0 ELSE a % (n - 4) END AS m, pow(CAST(n AS DOUBLE), 2) AS sq,
(a << n) & 4294967295 AS l, a >> n AS r, ((a << n) | (a >> (32 - n))) & 4294967295 AS turned, a & b AS x_and, a | b AS x_or, xor(a, b) AS x_xor, 4294967295 - a AS x_not,
CASE WHEN n > 3 THEN b ELSE a END AS sel, greatest(a, b, n) AS hi, least(a, b, n) AS lo, least(greatest(10, a), 60) AS lim, CASE n WHEN 1 THEN b WHEN 2 THEN 7 WHEN 0 THEN a END AS mux, a > b AND b > n AS falls, a <> b AS differs FROM (SELECT l_orderkey, l_linenumber, l_suppkey AS a, l_partkey % 100 AS b, CAST(l_linenumber AS BIGINT) AS n FROM lineitem) t""")
def std_arithmetic_bit_selection(spark, sf_dir):
    li = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select("l_orderkey", "l_linenumber", F.col("l_suppkey").alias("a"), (F.col("l_partkey") % 100).alias("b"), F.col("l_linenumber").cast("long").alias("n"))
    a, b, n, c = F.col("a"), F.col("b"), F.col("n"), S.call
    return li.select(
        "l_orderkey", "l_linenumber", c("ADD", a, b, n).alias("s"), c("MUL", a, b).alias("p"), c("DIV", a - 50, n - 4, whole=True).alias("q"), c("MOD", a, n - 4).alias("m"), c("EXPT", n, F.lit(2)).alias("sq"),
        c("SHL", a, n).alias("l"), c("SHR", a, n).alias("r"), c("ROL", a, n).alias("turned"), c("AND", a, b).alias("x_and"), c("OR", a, b).alias("x_or"), c("XOR", a, b).alias("x_xor"), c("NOT", a).alias("x_not"),
        c("SEL", n > 3, a, b).alias("sel"), c("MAX", a, b, n).alias("hi"), c("MIN", a, b, n).alias("lo"), c("LIMIT", F.lit(10), a, F.lit(60)).alias("lim"), c("MUX", n, a, b, F.lit(7)).alias("mux"), c("GT", a, b, n).alias("falls"), c("NE", a, b).alias("differs"),
    )


@query("""SELECT c_custkey, length(n) AS len, left(n, 4) AS l, right(n, 3) AS r, substr(n, 2, 5) AS m, n || '-' || n AS c, substr(n, 1, 3) || 'XY' || substr(n, 4) AS i, substr(n, 1, 1) || substr(n, 5) AS d, substr(n, 1, 1) || 'Z' || substr(n, 4) AS p, strpos(n, '#') AS f FROM (SELECT c_custkey, c_name AS n FROM customer) t""")
def std_strings(spark, sf_dir):
    n, c, i = F.col("c_name"), S.call, F.lit
    return spark.read.parquet(f"{sf_dir}/customer.parquet").select("c_custkey", c("LEN", n).cast("long").alias("len"), c("LEFT", n, i(4)).alias("l"), c("RIGHT", n, i(3)).alias("r"), c("MID", n, i(5), i(2)).alias("m"), c("CONCAT", n, i("-"), n).alias("c"), c("INSERT", n, i("XY"), i(3)).alias("i"), c("DELETE", n, i(3), i(2)).alias("d"), c("REPLACE", n, i("Z"), i(2), i(2)).alias("p"), c("FIND", n, i("#")).cast("long").alias("f"))


@query("""SELECT event_id, epoch_us(ts + INTERVAL 90 SECOND) - epoch_us(ts) AS later, epoch_us(ts - INTERVAL 1 HOUR) - epoch_us(ts) AS sooner, epoch_us(ts) - epoch_us(CAST(date_trunc('day', ts) AS TIMESTAMP)) AS of_day, CAST(date_diff('day', DATE '2020-02-28', CAST(ts AS DATE)) AS BIGINT) AS days, CAST(270000000 AS BIGINT) AS tripled, CAST(45000000 AS BIGINT) AS halved FROM events""")
def std_times(spark, sf_dir):
    e = spark.read.parquet(f"{sf_dir}/events.parquet")
    ts, t, c = F.col("ts"), F.expr("INTERVAL '90' SECOND"), S.call
    sec = lambda x: (x.cast("decimal(20,6)") * 1_000_000).cast("long")  # noqa: E731  microseconds
    return e.select(
        "event_id", sec(c("SUB_DT_DT", c("ADD_DT_TIME", ts, t), ts).cast("interval second")).alias("later"), sec(c("SUB_DT_DT", c("SUB_DT_TIME", ts, F.expr("INTERVAL '1' HOUR")), ts).cast("interval second")).alias("sooner"), sec(c("SUB_DT_DT", ts, c("CONCAT_DATE_TOD", ts.cast("date"), F.expr("INTERVAL '0' SECOND"))).cast("interval second")).alias("of_day"),
        F.extract(F.lit("DAY"), c("SUB_DATE_DATE", ts.cast("date"), F.lit("2020-02-28").cast("date"))).cast("long").alias("days"), sec(c("MULTIME", t, F.lit(3)).cast("interval second")).alias("tripled"), sec(c("DIVTIME", t, F.lit(2)).cast("interval second")).alias("halved"),
    )


D_CALLS = "(SELECT user_id, event_id, ts, value > 40 AS clk, event_type = 'purchase' AS reset, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS i FROM events)"


@query(f"""WITH RECURSIVE e AS (SELECT * FROM {D_CALLS} x), f AS (SELECT user_id, event_id, i, clk, clk AS up, NOT clk AS down, clk AS sr, clk AND NOT reset AS rs, CAST(CASE WHEN reset THEN 0 WHEN clk THEN 1 ELSE 0 END AS BIGINT) AS ctu, CAST(CASE WHEN reset THEN 3 ELSE 0 END AS BIGINT) AS ctd FROM e WHERE i = 1 UNION ALL
SELECT e.user_id, e.event_id, e.i, e.clk, e.clk AND NOT f.clk, NOT e.clk AND f.clk, e.clk OR (NOT e.reset AND f.sr), NOT e.reset AND (e.clk OR f.rs), CAST(CASE WHEN e.reset THEN 0 WHEN e.clk AND NOT f.clk AND f.ctu < 3 THEN f.ctu + 1 ELSE f.ctu END AS BIGINT), CAST(CASE WHEN e.reset THEN 3 WHEN e.clk AND NOT f.clk AND f.ctd > 0 THEN f.ctd - 1 ELSE f.ctd END AS BIGINT) FROM f JOIN e ON e.user_id = f.user_id AND e.i = f.i + 1)
SELECT event_id, up, down, sr, rs, ctu, ctu >= 3 AS ctu_q, ctd, ctd <= 0 AS ctd_q FROM f""")
def std_blocks(spark, sf_dir):
    e = spark.read.parquet(f"{sf_dir}/events.parquet").select("user_id", "event_id", (F.col("value") > 40).alias("clk"), (F.col("event_type") == "purchase").alias("reset"))
    clk, reset, three = F.col("clk"), F.col("reset"), F.lit(3).cast("long")
    calls = [("R_TRIG", {"clk": clk}, {"q": "up"}), ("F_TRIG", {"clk": clk}, {"q": "down"}), ("SR", {"s1": clk, "r": reset}, {"q1": "sr"}), ("RS", {"s": clk, "r1": reset}, {"q1": "rs"}), ("CTU", {"cu": clk, "r": reset, "pv": three}, {"cv": "ctu", "q": "ctu_q"}), ("CTD", {"cd": clk, "ld": reset, "pv": three}, {"cv": "ctd", "q": "ctd_q"})]
    for name, inputs, outputs in calls:
        e = S.blocks(e, ["user_id"], "event_id", name, **inputs).withColumnsRenamed(outputs)
    return e.drop("user_id", "clk", "reset")


@query(f"""WITH RECURSIVE e AS (SELECT user_id, ts, clk, row_number() OVER (PARTITION BY user_id ORDER BY ts) AS i FROM (SELECT user_id, ts, bool_or(clk) AS clk FROM {D_CALLS} x GROUP BY user_id, ts) y), f AS (SELECT user_id, ts, i, clk, ts AS since, clk AS ever FROM e WHERE i = 1 UNION ALL SELECT e.user_id, e.ts, e.i, e.clk, CASE WHEN e.clk = f.clk THEN f.since ELSE e.ts END, f.ever OR e.clk FROM f JOIN e ON e.user_id = f.user_id AND e.i = f.i + 1)
SELECT user_id, ts, clk AND ts - since >= INTERVAL 1 HOUR AS ton, CASE WHEN clk THEN least(epoch_us(ts) - epoch_us(since), 3600000000) ELSE 0 END AS ton_et, ever AND (clk OR ts - since < INTERVAL 1 HOUR) AS tof FROM f""")
def std_timers(spark, sf_dir):
    e = spark.read.parquet(f"{sf_dir}/events.parquet").groupBy("user_id", "ts").agg(F.bool_or(F.col("value") > 40).alias("clk"))
    inputs = {"signal": F.col("clk"), "pt": F.expr("INTERVAL '1' HOUR")}
    e = S.blocks(e, ["user_id"], "ts", "TON", **inputs).withColumnsRenamed({"q": "ton", "et": "ton_et"})
    e = S.blocks(e, ["user_id"], "ts", "TOF", **inputs).withColumnsRenamed({"q": "tof"})
    return e.select("user_id", "ts", "ton", (F.col("ton_et").cast("interval second").cast("decimal(20,6)") * 1_000_000).cast("long").alias("ton_et"), "tof")
