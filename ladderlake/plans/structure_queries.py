"""Queries on structures and statements of programs. Eight conversations are a program and a turn is a line, whose text follows from the length of the turn's; the block is every third line by that length. The SQL compares all lines of a program with all others."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import code as C
from ..operators import structures as S

QUERIES: dict = {}
ORACLE_SQL: dict = {}
KEY = ["program"]
TEXTS = ["IF a > 1 THEN", "IF b", "  AND c THEN // IF", "ELSIF d THEN", "ELSE", "END_IF;", "CASE s OF", "  7:", "END_CASE;", "x := f(1,", "  g(2));", "y := 1;", "(* note *)", "FOR i := 1 TO 3 DO", "END_FOR;", "IF (z) THEN q := 1; END_IF;", "  IF e THEN", "IF a > 1 THEN", "END_IF", "z := ((1;"]
LINES = f"""SELECT program, ln, chosen, CASE k % {len(TEXTS)} {' '.join(f"WHEN {i} THEN '{t}'" for i, t in enumerate(TEXTS))} END AS line FROM (SELECT CAST(floor(conv_id / 8) AS BIGINT) AS program, CAST(row_number() OVER (PARTITION BY floor(conv_id / 8) ORDER BY conv_id, turn) AS BIGINT) AS ln, length(text) AS k, length(text) % 3 = 0 AS chosen FROM {{conversations}}) t"""
D_L = rf"l AS (SELECT *, regexp_replace(regexp_replace(line, '//.*$', ''), '\(\*.*?\*\)', '', 'g') AS c FROM ({LINES.replace('{conversations}', 'conversations')}) s)"
#: Ends of structures by running depths, first lines with THEN, and ends of statements.
D_END = """ev AS (SELECT program, ln, kind, CAST(regexp_matches(c, '(?i)^\\s*' || kind || '\\b') AS INT) AS head, len(regexp_extract_all(c, '(?i)\\bEND_' || kind || '\\b')) AS ends FROM l, (VALUES ('IF'), ('CASE'), ('FOR')) k(kind)),
run AS (SELECT a.program, a.kind, a.ln, b.ln AS to_ln, b.ends, sum(b.head - b.ends) OVER (PARTITION BY a.program, a.kind, a.ln ORDER BY b.ln) AS depth FROM ev a JOIN ev b ON a.program = b.program AND a.kind = b.kind AND b.ln >= a.ln WHERE a.head = 1),
ends AS (SELECT program, kind, ln, coalesce(min(CASE WHEN depth = 0 AND ends > 0 THEN to_ln END), ln) AS end_ln FROM run GROUP BY program, kind, ln)"""
D_HEADER = "header AS (SELECT a.program, a.ln, coalesce(min(b.ln), a.ln) AS header_ln FROM l a LEFT JOIN l b ON b.program = a.program AND b.ln >= a.ln AND regexp_matches(b.c, '(?i)\\bTHEN\\b') GROUP BY a.program, a.ln)"
D_SEMI = "paren AS (SELECT a.program, a.ln, b.ln AS to_ln, contains(b.c, ';') AS has_semi, sum(len(regexp_extract_all(b.c, '\\(')) - len(regexp_extract_all(b.c, '\\)'))) OVER (PARTITION BY a.program, a.ln ORDER BY b.ln) AS depth FROM l a JOIN l b ON b.program = a.program AND b.ln >= a.ln), stmt AS (SELECT program, ln, coalesce(min(CASE WHEN has_semi AND depth <= 0 THEN to_ln END), ln) AS end_ln FROM paren GROUP BY program, ln)"
#: Branches of IFs by a stack: a line's open IFs are a list of their lines.
D_STACK = r"""u AS (SELECT program, ln, upper(trim(regexp_replace(regexp_replace(line, '\(\*.*?\*\)', '', 'g'), '//.*$', ''))) AS u FROM l),
st AS (SELECT program, ln, u, CASE WHEN u LIKE 'IF %' THEN [ln] ELSE [] END AS now, CAST(NULL AS BIGINT) AS mine FROM u WHERE ln = 1 UNION ALL
SELECT u.program, u.ln, u.u, CASE WHEN u.u LIKE 'IF %' THEN list_append(st.now, u.ln) WHEN u.u LIKE 'END\_IF%' ESCAPE '\' THEN st.now[:len(st.now) - 1] ELSE st.now END, CASE WHEN u.u LIKE 'END\_IF%' ESCAPE '\' OR u.u LIKE 'ELSIF %' OR u.u = 'ELSE' OR u.u LIKE 'ELSE %' THEN st.now[len(st.now)] END FROM st JOIN u ON u.program = st.program AND u.ln = st.ln + 1),
turns AS (SELECT program, ln AS if_ln, ln, false AS closes FROM u WHERE u LIKE 'IF %' UNION ALL SELECT program, mine, ln, u LIKE 'END\_IF%' ESCAPE '\' FROM st WHERE mine IS NOT NULL),
branch AS (SELECT t.program, t.if_ln, t.ln AS head_ln, h.header_ln + 1 AS body_begin, (SELECT min(n.ln) FROM turns n WHERE n.program = t.program AND n.if_ln = t.if_ln AND n.ln > t.ln) - 1 AS body_end, e.ln AS end_ln FROM turns t JOIN turns e ON e.program = t.program AND e.if_ln = t.if_ln AND e.closes JOIN header h ON h.program = t.program AND h.ln = t.ln WHERE NOT t.closes)"""
D_CASE = r"""lab AS (SELECT program, ln, (NOT contains(c, ':=') AND contains(c, ':')) OR regexp_matches(c, '(?i)^\s*ELSE\b') AS is_label, regexp_matches(c, '(?i)^\s*CASE\b') AS head, regexp_matches(c, '(?i)\bEND_CASE\b') AS fin, chosen FROM l),
point AS (SELECT a.program, a.ln, a.head, a.fin, a.is_label, (SELECT max(b.ln) FROM lab b WHERE b.program = a.program AND b.ln <= a.ln AND b.head) AS cs FROM lab a WHERE a.chosen AND (a.head OR a.fin OR a.is_label)),
region AS (SELECT p.program, p.cs, p.ln AS ce FROM point p WHERE fin AND cs < ln UNION SELECT p.program, p.cs, e.end_ln FROM point p JOIN ends e ON e.program = p.program AND e.kind = 'CASE' AND e.ln = p.cs WHERE NOT fin),
hit AS (SELECT r.*, EXISTS (SELECT 1 FROM lab x WHERE x.program = r.program AND x.ln > r.cs AND x.ln < r.ce AND x.is_label) AS sound FROM region r WHERE EXISTS (SELECT 1 FROM lab x WHERE x.program = r.program AND x.ln > r.cs AND x.ln < r.ce AND x.chosen)),
near AS (SELECT h.program, (SELECT max(y.ln) FROM lab y WHERE y.program = h.program AND y.ln > h.cs AND y.ln < x.ln AND y.is_label) AS ln FROM hit h JOIN lab x ON x.program = h.program AND x.ln > h.cs AND x.ln < h.ce AND x.chosen AND NOT x.is_label AND NOT x.head WHERE h.sound)"""


def query(*ctes: str, sql: str):
    def add(f):
        QUERIES[f.__name__] = f
        ORACLE_SQL[f.__name__] = f"WITH RECURSIVE {', '.join([D_L, *ctes])} {sql}"
        return f

    return add


def _lines(spark, sf_dir):
    lines = spark.sql(LINES, conversations=spark.read.parquet(f"{sf_dir}/conversations.parquet"))
    return lines.drop("chosen"), lines.filter("chosen").select("program", "ln")


@query(D_HEADER, D_SEMI, sql="SELECT program, ln, header_ln, end_ln AS semicolon_ln FROM header JOIN stmt USING (program, ln)")
def statement_spans(spark, sf_dir):
    lines, _ = _lines(spark, sf_dir)
    return S.header_ends(lines, KEY).join(S.statement_ends(lines, KEY).withColumnRenamed("end_ln", "semicolon_ln"), ["program", "ln"])


@query(D_END, D_HEADER, D_SEMI, sql="""SELECT program, ln FROM (SELECT l.program, l.ln, unnest(CASE WHEN e.kind = 'IF' THEN list_append(generate_series(l.ln, h.header_ln), e.end_ln) WHEN e.kind IS NOT NULL THEN [l.ln, e.end_ln] ELSE generate_series(l.ln, s.end_ln) END) AS x FROM l JOIN header h USING (program, ln) JOIN stmt s USING (program, ln) LEFT JOIN ends e USING (program, ln) WHERE l.chosen) t, LATERAL (SELECT x AS ln) y GROUP BY ALL""".replace("SELECT program, ln FROM (SELECT", "SELECT DISTINCT program, x AS ln FROM (SELECT", 1).replace(", LATERAL (SELECT x AS ln) y GROUP BY ALL", ""))
def statement_lines(spark, sf_dir):
    lines, block = _lines(spark, sf_dir)
    kind = F.upper(F.nullif(F.regexp_extract(C.clean_line(F.col("line")), S.HEADS, 1), F.lit("")))
    statements = block.join(lines, ["program", "ln"]).select("program", "ln", F.coalesce(kind, F.lit("plain")).alias("kind"))
    return S.extents(statements, lines, KEY)


@query(D_HEADER, sql=r"SELECT program, ln, header_ln, indent, trim(regexp_replace(CASE WHEN regexp_matches(whole, '(?i)\bTHEN\b') THEN regexp_extract(whole, '(?is)^(.*)\bTHEN\b', 1) ELSE whole END, '(?i)^\s*IF\b', '')) AS condition FROM (SELECT a.program, a.ln, h.header_ln, regexp_extract(a.line, '^\s*') AS indent, (SELECT string_agg(trim(b.c), ' ' ORDER BY b.ln) FROM l b WHERE b.program = a.program AND b.ln BETWEEN a.ln AND h.header_ln AND trim(b.c) <> '') AS whole FROM l a JOIN header h USING (program, ln) WHERE regexp_matches(a.c, '(?i)^\s*IF\b')) t")
def if_conditions(spark, sf_dir):
    lines, _ = _lines(spark, sf_dir)
    return S.if_conditions(lines, KEY)


@query(D_HEADER, D_STACK, sql="SELECT program, if_ln, head_ln, body_begin, body_end, end_ln FROM branch")
def if_branches(spark, sf_dir):
    lines, _ = _lines(spark, sf_dir)
    return S.if_branches(lines, KEY)


@query(D_HEADER, D_STACK, sql="SELECT program, ln FROM l WHERE chosen UNION SELECT program, unnest([head_ln, end_ln]) FROM branch b WHERE EXISTS (SELECT 1 FROM l WHERE l.program = b.program AND l.chosen AND l.ln BETWEEN b.body_begin AND b.body_end)")
def repaired_ifs(spark, sf_dir):
    lines, block = _lines(spark, sf_dir)
    return S.repaired_ifs(block, lines, KEY)


@query(D_END, D_CASE, sql="SELECT program, ln FROM l WHERE chosen AND NOT EXISTS (SELECT 1 FROM hit WHERE hit.program = l.program AND NOT hit.sound AND l.ln IN (hit.cs, hit.ce)) UNION SELECT program, unnest([cs, ce]) FROM hit WHERE sound UNION SELECT program, ln FROM near WHERE ln IS NOT NULL")
def repaired_cases(spark, sf_dir):
    lines, block = _lines(spark, sf_dir)
    return S.repaired_cases(block, lines, KEY)


@query(D_END, sql=r"SELECT program, ln FROM l WHERE chosen AND NOT EXISTS (SELECT 1 FROM ends e WHERE e.kind = 'CASE' AND e.program = l.program AND l.ln IN (e.ln, e.end_ln) AND EXISTS (SELECT 1 FROM l a WHERE a.program = e.program AND a.ln = e.ln AND a.chosen) AND EXISTS (SELECT 1 FROM l a WHERE a.program = e.program AND a.ln = e.end_ln AND a.chosen) AND NOT EXISTS (SELECT 1 FROM l a WHERE a.program = e.program AND a.ln > e.ln AND a.ln < e.end_ln AND ((NOT contains(a.c, ':=') AND contains(a.c, ':')) OR regexp_matches(a.c, '(?i)^\s*ELSE\b'))))")
def blocks_without_empty_cases(spark, sf_dir):
    lines, block = _lines(spark, sf_dir)
    return S.without_empty_cases(block, lines, KEY)


@query(D_END, sql="SELECT program, ln FROM l WHERE chosen UNION SELECT e.program, e.ln FROM ends e WHERE e.end_ln > e.ln AND EXISTS (SELECT 1 FROM l WHERE l.program = e.program AND l.chosen AND l.ln BETWEEN e.ln AND e.end_ln)")
def heads_around(spark, sf_dir):
    lines, block = _lines(spark, sf_dir)
    return S.heads_around(block, lines, KEY)


#: Variables and functions of each of TEXTS, by hand.
NAMES = ["a|", "b|", "c|", "d|", "|", "|", "s|", "|", "|", "x|f", "|", "y|", "|", "i|", "|", "q,z|", "e|", "a|", "|", "z|"]


@query(sql="SELECT program, ln, " + ", ".join(f"CASE k % {len(TEXTS)} {' '.join(f'WHEN {i} THEN {chr(39)}{n.split(chr(124))[part]}{chr(39)}' for i, n in enumerate(NAMES))} END AS {name}" for part, name in enumerate(("variables", "functions"))) + " FROM (SELECT CAST(floor(conv_id / 8) AS BIGINT) AS program, CAST(row_number() OVER (PARTITION BY floor(conv_id / 8) ORDER BY conv_id, turn) AS BIGINT) AS ln, length(text) AS k FROM conversations) t")
def names_used(spark, sf_dir):
    lines, _ = _lines(spark, sf_dir)
    used = lines.select("program", "ln", C.names_used(F.col("line")).alias("used"))
    return used.select("program", "ln", F.array_join("used.variables", ",").alias("variables"), F.array_join("used.functions", ",").alias("functions"))
