"""Queries over the tables and their SQL. Code texts, attempt logs and JSON values are derived from the tables by the SQL in SOURCES, which both engines read."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import code as C
from ..operators.cleaning import funneled

CODE = """SELECT p_partkey, CASE p_partkey % 7 WHEN 5 THEN 'Here:' || chr(10) || '```st' || chr(10) || code || chr(10) || '```' || chr(10) || 'done' WHEN 6 THEN '```' || code ELSE code END AS code FROM (
  SELECT p_partkey, CASE WHEN p_partkey % 11 = 0 THEN '  import os' WHEN p_partkey % 13 = 0 THEN '' ELSE
  'FUNCTION_BLOCK FB_' || CAST(p_partkey AS VARCHAR(20)) || chr(10) || 'VAR x : INT; y : INT; END_VAR' || chr(10) || CASE p_partkey % 6 WHEN 0 THEN 'x = y;' WHEN 1 THEN 'x := y; // copy' WHEN 2 THEN 'x : ARRAY[*] OF INT;' WHEN 3 THEN 'z := x; (* note: z' || chr(10) || ' *)' WHEN 4 THEN 'IF x > 1 THEN' || chr(10) || '  x := 2;' || chr(10) || 'END_IF;' ELSE 'IF x > 1 THEN' || chr(10) || 'WHILE y > 2 DO y := 1; END_WHILE;' END || chr(10) || CASE WHEN p_partkey % 9 = 0 THEN 'END_FB' ELSE 'END_FUNCTION_BLOCK' END END AS code FROM {part}) t"""
ATTEMPTS = "SELECT user_id AS task, event_id AS seq, 'c' || CAST(event_id % 97 AS VARCHAR(9)) AS code, event_type = 'purchase' AND user_id % 3 > 0 AS accepted, event_type = 'error' AS rejected, event_type, ts FROM {events}"
TYPED = "SELECT user_id AS f, event_id AS line, CASE event_id % 7 WHEN 0 THEN '1' WHEN 1 THEN '2.5' WHEN 2 THEN '\"s\"' WHEN 3 THEN 'null' WHEN 4 THEN 'true' WHEN 5 THEN '{\"k\":1}' ELSE '[1]' END AS v FROM {events}"


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def _sql(spark: SparkSession, sf_dir: str, sql: str, table: str) -> DataFrame:
    plain = sql.replace("{", "{{").replace("}", "}}").replace("{{%s}}" % table, "{%s}" % table)  # other braces are text
    return spark.sql(plain, **{table: _read(spark, sf_dir, table)})


def _code(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sql(spark, sf_dir, CODE, "part")


def _attempts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sql(spark, sf_dir, ATTEMPTS, "events")


def _duck(sql: str) -> str:
    for t in ("part", "events", "conversations", "documents", "labels"):
        sql = sql.replace("{%s}" % t, t)
    return sql


D_CODE, D_ATT, D_TYPED = f"({_duck(CODE)})", f"({_duck(ATTEMPTS)})", f"({_duck(TYPED)})"
STRIP = lambda x: f"regexp_replace({x}, '^\\s+|\\s+$', '', 'g')"
D_BODY = STRIP(r"CASE WHEN regexp_matches(code, '(?s)```[a-zA-Z]*\n.*?```') THEN regexp_extract(code, '(?s)```[a-zA-Z]*\n(.*?)```', 1) ELSE code END")
D_REPAIRED = rf"(SELECT p_partkey, CASE WHEN regexp_matches(b, '(?i)^(variables|import|def\s|class\s|#\s)') THEN '' ELSE b END AS code FROM (SELECT p_partkey, {D_BODY} AS b FROM {D_CODE} c) d)"
D_FAST = r"""CASE WHEN regexp_matches(code, '[\p{L}\p{N}_]\s*=\s*[\p{L}\p{N}_]+;') THEN 'Illegal assignment ''=''' WHEN NOT (contains(code, 'FUNCTION_BLOCK') AND contains(code, 'END_FUNCTION_BLOCK') AND contains(code, 'VAR') AND contains(code, 'END_VAR')) THEN 'Missing structure keywords' WHEN regexp_matches(upper(code), 'ARRAY ?\[\*\]') THEN 'Dynamic arrays not supported' ELSE 'Passed' END"""
D_PLAIN = r"regexp_replace(regexp_replace({0}, '(?s)\(\*.*?\*\)', '', 'g'), '//[^\n]*', '', 'g')"
#: What passes the rules but doesn't parse: an IF without its end (shape 5 of 6), and a fence that nothing closes (kind 6 of 7).
D_STATUS = f"(SELECT p_partkey, CASE WHEN code = '' THEN 'empty' WHEN {D_FAST} <> 'Passed' THEN 'basic_error' WHEN p_partkey % 6 = 5 OR p_partkey % 7 = 6 THEN 'syntax_error' ELSE 'golden' END AS quality FROM {D_REPAIRED} r)"
QUERIES: dict = {}
ORACLE_SQL: dict = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


@query(f"SELECT quality, count(*) AS n, round(100.0 * count(*) / sum(count(*)) OVER (), 2) AS pct FROM {D_STATUS} s GROUP BY quality")
def quality_funnel(spark, sf_dir):
    n = funneled(_code(spark, sf_dir)).groupBy("quality").agg(F.count("*").alias("n"))
    total = F.sum("n").over(W.partitionBy())  # over one row a status, four at most
    return n.select("quality", "n", F.round(F.lit(100.0) * F.col("n") / total, 2).alias("pct"))


@query(f"SELECT p_partkey, code FROM {D_REPAIRED} r")
def code_fence_repair(spark, sf_dir):
    return _code(spark, sf_dir).select("p_partkey", C.auto_repair(F.col("code")).alias("code"))


@query(rf"""SELECT p_partkey, upper(regexp_replace(code, '(?s)(''[^'']*''|"[^"]*")|//[^\n]*|\(\*.*?\*\)', '\1', 'g')) AS upper_code, {D_PLAIN.format('code')} AS plain FROM {D_CODE} c""")
def strip_comments(spark, sf_dir):
    c = F.col("code")
    return _code(spark, sf_dir).select("p_partkey", C.remove_comments(c).alias("upper_code"), C.strip_comments(c).alias("plain"))


@query(f"SELECT p_partkey, {D_FAST} AS message FROM {D_CODE} c")
def fast_validate(spark, sf_dir):
    return _code(spark, sf_dir).select("p_partkey", C.fast_validate(F.col("code")).alias("message"))


def _word(word: str, text: str = "p") -> str:
    return rf"len(regexp_extract_all(upper({text}), '\b{word}\b'))"


def _unequal(opens: str, closes: str) -> str:
    return f"WHEN {_word(opens)} <> {_word(closes)} THEN 'Structural imbalance: {opens}(' || {_word(opens)} || ') vs {closes}(' || {_word(closes)} || ')'"


D_STRICT = " ".join([
    "CASE WHEN regexp_matches(regexp_replace(p, '[:<>]=|==', '', 'g'), '=') THEN 'Assignment Error: Found ''='' instead of '':='' for assignment.'",
    _unequal("IF", "END_IF"), _unequal("CASE", "END_CASE"), _unequal("FOR", "END_FOR"), _unequal("WHILE", "END_WHILE"), _unequal("REPEAT", "UNTIL"),
    _unequal("FUNCTION_BLOCK", "END_FUNCTION_BLOCK"), _unequal("VAR", "END_VAR"), _unequal("VAR_INPUT", "END_VAR"), _unequal("VAR_OUTPUT", "END_VAR"),
    "WHEN NOT (contains(upper(p), 'FUNCTION_BLOCK') AND contains(upper(p), 'VAR') AND contains(upper(p), 'END_VAR') AND contains(upper(p), 'END_FUNCTION_BLOCK')) THEN 'Standard Structure Error: Missing FB or VAR declarations.'",
    "ELSE 'Passed All Strict Checks' END",
])
#: Programs with each kind of VAR section, REPEAT loops and comments, complete or not, by the remainders of the key.
STRICT = """SELECT p_partkey, CASE WHEN p_partkey % 2 = 0 THEN 'FUNCTION_BLOCK f' || chr(10) ELSE '' END || CASE p_partkey % 5 WHEN 0 THEN 'VAR_INPUT a : INT; END_VAR VAR b : INT; END_VAR VAR_OUTPUT c : INT; END_VAR' WHEN 1 THEN 'VAR_INPUT VAR_OUTPUT VAR END_VAR' WHEN 2 THEN '' WHEN 3 THEN 'VAR_INPUT VAR_OUTPUT' ELSE 'VAR a : INT; END_VAR' END || chr(10) || CASE p_partkey % 7 WHEN 0 THEN 'REPEAT a := a + 1; UNTIL a > 3 END_REPEAT;' WHEN 1 THEN 'IF a >= 1 THEN b := 2;' WHEN 2 THEN 'a = 1;' WHEN 3 THEN 'FOR a := 1 TO 3 DO END_FOR;' WHEN 4 THEN 'CASE a OF 1: b := 1; END_CASE' WHEN 5 THEN '(* IF *) WHILE a <> 1 DO END_WHILE' ELSE 'a := 1;' END || chr(10) || CASE WHEN p_partkey % 3 = 0 THEN '// end' || chr(10) ELSE '' END || CASE WHEN p_partkey % 2 = 0 THEN 'END_FUNCTION_BLOCK' ELSE '' END AS code FROM {part}"""
D_LEGACY_PLAIN = r"regexp_replace(code, '(?s)//.*|\(\*.*?\*\)', '', 'g')"


@query(f"SELECT p_partkey, {D_STRICT} AS message FROM (SELECT p_partkey, {D_LEGACY_PLAIN} AS p FROM ({_duck(STRICT)} UNION ALL SELECT -p_partkey, code FROM {D_CODE} c) x) q")
def strict_legacy_checks(spark, sf_dir):
    both = _sql(spark, sf_dir, STRICT, "part").unionAll(_code(spark, sf_dir).withColumn("p_partkey", -F.col("p_partkey")))
    return both.select("p_partkey", C.strict_validate(F.col("code")).alias("message"))


@query(rf"""SELECT p_partkey, CASE WHEN {_word('FOR')} <> {_word('END_FOR')} OR {_word('IF')} <> {_word('END_IF')} OR {_word('CASE')} <> {_word('END_CASE')} OR {_word('WHILE')} <> {_word('END_WHILE')} OR {_word('REPEAT')} <> {_word('END_REPEAT')} OR {_word('FUNCTION_BLOCK')} <> {_word('END_FUNCTION_BLOCK')} OR {_word('VAR')} + {_word('VAR_INPUT')} + {_word('VAR_OUTPUT')} <> {_word('END_VAR')} THEN 'unbalanced' WHEN regexp_matches(regexp_replace(p, '[:<>]=|==', '', 'g'), '=') THEN 'other' WHEN NOT (contains(upper(p), 'FUNCTION_BLOCK') AND contains(upper(p), 'END_VAR')) THEN 'other' ELSE 'passed' END AS verdict FROM (SELECT p_partkey, {D_PLAIN.format('code')} AS p FROM ({_duck(STRICT)}) x) q""")
def strict_checks(spark, sf_dir):
    """The corrected variant: comments by line, all kinds of VAR sections against END_VAR."""
    m = C.strict_validate(F.col("code"), legacy=False)
    plain = C.strip_comments(F.col("code"))
    verdict = F.when(C.imbalance(plain, C.PAIRS).isNotNull(), "unbalanced").when(m == "Passed All Strict Checks", "passed").otherwise("other")
    return _sql(spark, sf_dir, STRICT, "part").select("p_partkey", verdict.alias("verdict"))


@query(r"SELECT p_partkey, CASE WHEN regexp_matches(code, '\b\w+\s*=\s*\w+;') THEN 'Illegal assignment ''=' || chr(39) WHEN NOT (contains(code, 'FUNCTION_BLOCK') AND contains(code, 'END_VAR')) THEN 'Missing keywords' ELSE 'Passed' END AS message FROM (" + _duck(STRICT) + ") x")
def two_keyword_validate(spark, sf_dir):
    return _sql(spark, sf_dir, STRICT, "part").select("p_partkey", C.two_keyword_validate(F.col("code")).alias("message"))


D_DECL = r"list_sort(list_distinct(flatten(list_transform(regexp_extract_all(code, '(?is)VAR.*?END_VAR'), lambda b: regexp_extract_all(b, '(\w+)\s*:\s*\w+', 1)))))"
D_USED = r"list_distinct(list_concat(regexp_extract_all(code, '(\w+)\s*:=\s*\w+', 1), list_filter(regexp_extract_all(code, '\w+\s*:=\s*(\w+)', 1), lambda x: regexp_matches(x, '^[A-Za-z_]'))))"


@query(f"SELECT p_partkey, array_to_string({D_DECL}, ',') AS vars, len({D_DECL}) AS n FROM {D_CODE} c")
def declared_vars(spark, sf_dir):
    v = C.declared_vars(F.col("code"))
    return _code(spark, sf_dir).select("p_partkey", F.array_join(v, ",").alias("vars"), F.size(v).cast("long").alias("n"))


@query(f"SELECT p_partkey, array_to_string(u, ',') AS undefined, len(u) = 0 AS passed FROM (SELECT p_partkey, list_sort(list_filter({D_USED}, lambda x: NOT list_contains({D_DECL}, x))) AS u FROM {D_CODE} c) q")
def undefined_vars(spark, sf_dir):
    u = F.array_sort(F.array_except(C.used_vars(F.col("code")), C.declared_vars(F.col("code"))))
    return _code(spark, sf_dir).select("p_partkey", F.array_join(u, ",").alias("undefined"), (F.size(u) == 0).alias("passed"))


#: Replies around the length of a turn's text, and what is left of each.
WRAPPED = """SELECT conv_id, turn, CASE turn % 12 WHEN 0 THEN '<think>{x}</think> Sure: ```json' || chr(10) || '{"n":' || k || '}' || chr(10) || '```' WHEN 1 THEN '[1,' || k || ',]' WHEN 2 THEN 'x {"a":[1, 2,],} y' WHEN 3 THEN ' no json ' || role || ' ' WHEN 4 THEN '```st' || chr(10) || 'x := ' || k || ';' || chr(10) || '```' WHEN 5 THEN '} ' || k || ' {' WHEN 6 THEN '{"a": broken} [' || k || ', 2]' WHEN 7 THEN '[broken {"b": ' || k || '} x]' WHEN 8 THEN '{broken [' || k || ' x' || chr(9) || '} y]' WHEN 9 THEN '```JSON ```' WHEN 10 THEN 'a] ' || k || ' [b' ELSE '{' || k END AS raw FROM (SELECT conv_id, turn, role, CAST(length(text) AS VARCHAR(20)) AS k FROM {conversations}) t"""


@query("""SELECT conv_id, turn, CASE turn % 12 WHEN 0 THEN '{"n":' || k || '}' WHEN 1 THEN '[1,' || k || ']' WHEN 2 THEN '{"a":[1, 2]}' WHEN 3 THEN 'no json ' || role WHEN 4 THEN 'st' || chr(10) || 'x := ' || k || ';' WHEN 5 THEN '' WHEN 6 THEN '[' || k || ', 2]' WHEN 7 THEN '{"b": ' || k || '}' WHEN 8 THEN '{broken [' || k || ' x' || chr(9) || '}' WHEN 9 THEN '' WHEN 10 THEN '' ELSE '{' || k END AS clean FROM (SELECT conv_id, turn, role, CAST(length(text) AS VARCHAR) AS k FROM conversations) t""")
def llm_json_clean(spark, sf_dir):
    return _sql(spark, sf_dir, WRAPPED, "conversations").select("conv_id", "turn", C.clean_json(F.col("raw")).alias("clean"))


RAW_REPLY = """SELECT conv_id, turn, CASE turn % 8 WHEN 0 THEN 'Here: ```json' || chr(10) || '{"a": ' || turn || '}' || chr(10) || '```' WHEN 1 THEN '```' || chr(10) || '[1, 2]' || chr(10) || '```' WHEN 2 THEN 'x [1, {"b": 2}] y' WHEN 3 THEN 'nothing' WHEN 4 THEN '} {' WHEN 5 THEN '```JSON [] ```' WHEN 6 THEN '{ open' ELSE '' END AS raw FROM {conversations}"""


@query("SELECT conv_id, turn, CASE turn % 8 WHEN 0 THEN '{\"a\": ' || turn || '}' WHEN 1 THEN '[1, 2]' WHEN 2 THEN '{\"b\": 2}' WHEN 5 THEN '[]' ELSE '' END AS clean FROM conversations")
def llm_json_span(spark, sf_dir):
    return _sql(spark, sf_dir, RAW_REPLY, "conversations").select("conv_id", "turn", C.clean_json_span(F.col("raw")).alias("clean"))


HISTORY = "SELECT 'write for: ' || source || '-' || (doc_id % 10) AS instruction FROM {documents} WHERE doc_id % 3 = 0"
OUTPUT = "SELECT 'do it for: ' || 'src' || (doc_id % 20) || '-' || (doc_id % 10) AS instruction FROM {labels} WHERE quality = 0"


@query("SELECT k AS task, count(*) AS n FROM (SELECT source || '-' || (doc_id % 10) AS k FROM documents WHERE doc_id % 3 = 0 UNION ALL SELECT 'src' || (doc_id % 20) || '-' || (doc_id % 10) FROM labels WHERE quality = 0) t GROUP BY k")
def dedup_index(spark, sf_dir):
    """Tasks known from the history and from the output together."""
    both = _sql(spark, sf_dir, HISTORY, "documents").unionByName(_sql(spark, sf_dir, OUTPUT, "labels"))
    return both.groupBy(C.task_key(F.col("instruction")).alias("task")).agg(F.count("*").alias("n"))


@query("SELECT k AS task, count(*) AS n, min(doc_id) AS first_id FROM (SELECT split_part('write for: a for: ' || source || '-' || (doc_id % 100), 'for: ', -1) AS k, doc_id FROM documents) t WHERE k NOT IN (SELECT 'src' || (doc_id % 20) || '-' || (doc_id % 100) FROM labels WHERE quality = 0) GROUP BY k")
def task_dedup(spark, sf_dir):
    tasks = _read(spark, sf_dir, "documents").select("doc_id", C.task_key(F.concat(F.lit("write for: a for: "), "source", F.lit("-"), F.col("doc_id") % 100)).alias("task"))
    done = _read(spark, sf_dir, "labels").filter("quality = 0").select(F.concat(F.lit("src"), F.col("doc_id") % 20, F.lit("-"), F.col("doc_id") % 100).alias("task")).distinct()
    return tasks.join(done, "task", "left_anti").groupBy("task").agg(F.count("*").alias("n"), F.min("doc_id").alias("first_id"))


#: Replies: a list, an object with tasks, one without (its first field counts), empty tasks, a list with other types, no JSON, a number, text in tasks.
REPLIES = """SELECT conv_id, turn, CASE conv_id % 8 WHEN 0 THEN '["Explain ' || role || ' ' || turn || '", "short"]' WHEN 1 THEN '{"tasks": ["Control pump ' || turn || '", "x"], "zz": ["Ignored entirely"]}' WHEN 2 THEN '{"zeta": ["First of fields ' || turn || '"], "alpha": ["Second of fields"]}' WHEN 3 THEN '{"tasks": [], "b": ["Never the first one"]}' WHEN 4 THEN '[12345678901234, "Sort parcels ' || turn || '", null, ["nested list here"], true]' WHEN 5 THEN 'Sorry, no JSON here' WHEN 6 THEN '123456789012' ELSE '{"tasks": "a single long text"}' END AS reply FROM {conversations}"""


@query("SELECT conv_id, turn, CASE conv_id % 8 WHEN 0 THEN 'Explain ' || role || ' ' || turn WHEN 1 THEN 'Control pump ' || turn WHEN 2 THEN 'First of fields ' || turn ELSE 'Sort parcels ' || turn END AS task FROM conversations WHERE conv_id % 8 IN (0, 1, 2, 4)")
def task_filter(spark, sf_dir):
    r = _sql(spark, sf_dir, REPLIES, "conversations")
    return r.select("conv_id", "turn", F.explode(C.tasks_of(F.col("reply"))).alias("task"))


@query("SELECT doc_id, source FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE doc_id IS NOT NULL)")
def pending_resume(spark, sf_dir):
    return _read(spark, sf_dir, "documents").join(_read(spark, sf_dir, "labels").select("doc_id").distinct(), "doc_id", "left_anti").select("doc_id", "source")


@query("SELECT task, count(*) AS n FROM (SELECT trim(split_part(text, ' ', 1)) AS task FROM documents) t WHERE task <> '' AND task NOT IN (SELECT DISTINCT split_part(text, ' ', 1) FROM conversations WHERE text IS NOT NULL) GROUP BY task")
def pending_lines(spark, sf_dir):
    """Lines of a list of pending tasks, stripped, less the blank and the done ones."""
    lines = _read(spark, sf_dir, "documents").select(C.stripped(F.concat(F.lit("  "), F.substring_index("text", " ", 1), F.lit(" \t"))).alias("task")).filter("task <> ''")
    done = _read(spark, sf_dir, "conversations").select(F.substring_index("text", " ", 1).alias("task")).distinct()
    return lines.join(done, "task", "left_anti").groupBy("task").agg(F.count("*").alias("n"))


@query("SELECT doc_id, length(text) AS size FROM documents WHERE length(text) > 200 AND length(text) < 2000 ORDER BY doc_id DESC LIMIT 50")
def golden_fifo(spark, sf_dir):
    return _read(spark, sf_dir, "documents").select("doc_id", F.length("text").cast("long").alias("size")).filter("size > 200 AND size < 2000").orderBy(F.desc("doc_id")).limit(50)


@query("SELECT doc_id, (doc_id * 7919) % 1009 AS k FROM documents WHERE length(text) > 200 AND length(text) < 2000 ORDER BY 2, 1 LIMIT 3")
def golden_sample(spark, sf_dir):
    return _read(spark, sf_dir, "documents").filter(F.length("text").between(201, 1999)).select("doc_id", ((F.col("doc_id") * 7919) % 1009).alias("k")).orderBy("k", "doc_id").limit(3)


D_FIRST = f"(SELECT task, min(seq) AS seq FROM {D_ATT} a WHERE accepted GROUP BY task)"


def _first_pass(a: DataFrame) -> DataFrame:
    """Each task's first accepted attempt, with how many attempts went before and the last rejected one of these."""
    w = W.partitionBy("task").orderBy("seq")
    b = a.withColumn("retries", (F.row_number().over(w) - 1).cast("long")).withColumn("bad", F.last(F.when(F.col("rejected"), F.col("code")), ignorenulls=True).over(w))
    return b.filter("accepted").withColumn("k", F.row_number().over(w)).filter("k = 1").drop("k")


@query(f"SELECT s.task, a.code AS chosen, (SELECT arg_max(r.code, r.seq) FROM {D_ATT} r WHERE r.task = s.task AND r.rejected AND r.seq < s.seq) AS rejected_code FROM {D_FIRST} s JOIN {D_ATT} a ON a.task = s.task AND a.seq = s.seq WHERE EXISTS (SELECT 1 FROM {D_ATT} r WHERE r.task = s.task AND r.rejected AND r.seq < s.seq)")
def dpo_pairs(spark, sf_dir):
    return _first_pass(_attempts(spark, sf_dir)).filter("bad IS NOT NULL").select("task", F.col("code").alias("chosen"), F.col("bad").alias("rejected_code"))


@query(f"SELECT s.task, a.code AS output, (SELECT count(*) FROM {D_ATT} b WHERE b.task = s.task AND b.seq < s.seq) AS retries FROM {D_FIRST} s JOIN {D_ATT} a ON a.task = s.task AND a.seq = s.seq")
def sft_records(spark, sf_dir):
    return _first_pass(_attempts(spark, sf_dir)).select("task", F.col("code").alias("output"), "retries")


@query(f"SELECT task, count(*) FILTER (rejected) AS n_rejected, max(seq) AS last_seq, 'Max retries' AS final_reason FROM {D_ATT} a GROUP BY task HAVING NOT bool_or(accepted) AND bool_or(rejected)")
def failed_tasks(spark, sf_dir):
    return _attempts(spark, sf_dir).groupBy("task").agg(F.count_if("rejected").alias("n_rejected"), F.max("seq").alias("last_seq"), F.bool_or("accepted").alias("ok")).filter("NOT ok AND n_rejected > 0").select("task", "n_rejected", "last_seq", F.lit("Max retries").alias("final_reason"))


def _failures(spark, sf_dir) -> DataFrame:
    """Attempts of tasks that never passed; every 97th code is blank."""
    a = _attempts(spark, sf_dir)
    open_ = a.join(a.filter("accepted").select("task").distinct(), "task", "left_anti")
    return open_.select("task", "rejected", "seq", F.when(F.col("code") != "c0", F.col("code")).otherwise(" \n").alias("code"))


@query(f"SELECT task, seq, code AS output FROM {D_ATT} a WHERE rejected AND code <> 'c0' AND task NOT IN (SELECT task FROM {D_ATT} b WHERE accepted)")
def explode_rejects(spark, sf_dir):
    return _failures(spark, sf_dir).filter("rejected").filter(C.stripped(F.col("code")) != "").select("task", "seq", F.col("code").alias("output"))


@query(f"SELECT (SELECT count(*) FROM (SELECT task FROM {D_ATT} x GROUP BY task HAVING NOT bool_or(accepted)) y) AS total_entries, count(*) FILTER (code <> 'c0') AS extracted_samples, count(*) FILTER (code = 'c0') AS skipped_empty FROM {D_ATT} a WHERE rejected AND task NOT IN (SELECT task FROM {D_ATT} b WHERE accepted)")
def explode_counters(spark, sf_dir):
    blank = C.stripped(F.col("code")) == ""
    by_task = _failures(spark, sf_dir).groupBy("task").agg(F.count_if(F.col("rejected") & ~blank).alias("extracted"), F.count_if(F.col("rejected") & blank).alias("empty"))
    return by_task.agg(F.count("*").alias("total_entries"), F.sum("extracted").alias("extracted_samples"), F.sum("empty").alias("skipped_empty"))


@query(f"SELECT seq, 'Task ' || task AS prompt, '<TODO>' AS chosen, code AS rejected_code, 'matiec_compiler_error' AS rejected_reason, CASE WHEN seq % 3 = 0 THEN 'Unknown Error' ELSE event_type END AS reason FROM {D_ATT} a WHERE rejected AND seq % 5 <> 0 AND task % 4 <> 1")
def dpo_negatives(spark, sf_dir):
    a = _attempts(spark, sf_dir).withColumn("error", F.when(F.col("seq") % 3 != 0, F.col("event_type"))).withColumn("output", F.when(F.col("seq") % 5 != 0, F.col("code")).otherwise(""))
    a = a.withColumn("instruction", F.when(F.col("task") % 4 == 1, "").otherwise(F.concat(F.lit("Task "), "task")))
    kept = a.filter("rejected AND output <> '' AND instruction <> ''")
    return kept.select("seq", F.col("instruction").alias("prompt"), F.lit("<TODO>").alias("chosen"), F.col("output").alias("rejected_code"), F.lit("matiec_compiler_error").alias("rejected_reason"), F.coalesce("error", F.lit("Unknown Error")).alias("reason"))


#: Fixed value: the system text of exported records.
SYSTEM = "You are an expert PLC programmer specializing in IEC 61131-3 Structured Text."
D_THOUGHT = "CASE u.conv_id % 4 WHEN 0 THEN 'turn ' || u.turn WHEN 1 THEN '' WHEN 2 THEN 'own ' || u.turn END"


@query(f"SELECT u.conv_id, u.turn, u.text AS instruction, '' AS input, CASE WHEN {D_THOUGHT} <> '' THEN '<think>' || chr(10) || {D_THOUGHT} || chr(10) || '</think>' || chr(10) || chr(10) ELSE '' END || a.text AS output, '{SYSTEM}' AS system FROM conversations u JOIN conversations a ON a.conv_id = u.conv_id AND a.turn = u.turn + 1 AND a.role = 'assistant' WHERE u.role = 'user'")
def chat_to_alpaca(spark, sf_dir):
    """The thought is that of the metadata where they have the key (an empty one hides the entry's own), else the entry's own, else none."""
    c = _read(spark, sf_dir, "conversations")
    a = c.filter("role = 'assistant'").select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("answer"))
    kind = F.col("conv_id") % 4
    metadata = F.when(kind == 0, F.create_map(F.lit("thought"), F.concat(F.lit("turn "), "turn"))).when(kind == 1, F.create_map(F.lit("thought"), F.lit(""))).otherwise(F.create_map(F.lit("retries"), F.lit("0")))
    own = F.when(kind != 3, F.concat(F.lit("own "), "turn"))
    e = c.filter("role = 'user'").join(a, ["conv_id", "turn"]).withColumn("metadata", metadata).withColumn("own", own)
    thought = F.when(F.map_contains_key("metadata", F.lit("thought")), F.try_element_at("metadata", F.lit("thought"))).otherwise(F.col("own"))
    output = F.when(thought != "", F.concat(F.lit("<think>\n"), thought, F.lit("\n</think>\n\n"), "answer")).otherwise(F.col("answer"))
    return e.select("conv_id", "turn", F.col("text").alias("instruction"), F.lit("").alias("input"), output.alias("output"), F.lit(SYSTEM).alias("system"))


@query("SELECT doc_id, CASE WHEN (doc_id * 7919) % 100 < 30 THEN source ELSE 'Rewrite ' || source || ' ' || CASE doc_id % 4 WHEN 0 THEN 'with more constraints' WHEN 1 THEN 'with deeper reasoning' WHEN 2 THEN 'for a concrete plant' ELSE 'with error handling' END END AS prompt FROM documents")
def evolve_prompt(spark, sf_dir):
    how = F.element_at(F.array(*map(F.lit, ["with more constraints", "with deeper reasoning", "for a concrete plant", "with error handling"])), (F.col("doc_id") % 4 + 1).cast("int"))
    return _read(spark, sf_dir, "documents").select("doc_id", F.when((F.col("doc_id") * 7919) % 100 < 30, F.col("source")).otherwise(F.format_string("Rewrite %s %s", F.col("source"), how)).alias("prompt"))


#: Each text with what it is and how long it waits at the first attempt: every word of both lists, near misses, and one that holds both kinds.
MESSAGES = [
    ("HTTP 401", "fatal", None), ("Unauthorized", "fatal", None), ("Invalid API Key", "fatal", None), ("Incorrect API key given", "fatal", None), ("invalid_api_key", "fatal", None),
    ("Insufficient funds", "fatal", None), ("Quota exceeded", "fatal", None), ("No balance", "fatal", None), ("in arrears", "fatal", None), ("account suspended", "fatal", None),
    ("code 429", "rate_limit", 3), ("Rate limit hit", "rate_limit", 3), ("Too many requests", "rate_limit", 3), ("RPM limit exceeded", "rate_limit", 60),
    ("Please complete identity verification", "rate_limit", 60), ("403 Forbidden", "rate_limit", 60), ("429: rpm", "rate_limit", 60), ("Quota exceeded 429", "fatal", None),
    ("RPM limit", "other", None), ("Identity verification needed", "other", None), ("tpm reached", "other", None), ("timeout", "other", None), ("arrear", "other", None),
]
D_MESSAGES = "(VALUES " + ", ".join(f"({k}, '{m}', '{c}', {w if w else 'CAST(NULL AS INTEGER)'})" for k, (m, c, w) in enumerate(MESSAGES)) + ") m(k, message, kind, wait)"


@query(f"SELECT event_id, kind, CASE WHEN wait = 3 THEN 3 * (event_id % 3 + 1) ELSE wait END AS wait_s FROM events JOIN {D_MESSAGES} ON event_id % {len(MESSAGES)} = k")
def error_triage(spark, sf_dir):
    m = F.element_at(F.array(*[F.lit(m) for m, _, _ in MESSAGES]), (F.col("event_id") % len(MESSAGES) + 1).cast("int"))
    return _read(spark, sf_dir, "events").select("event_id", C.triage(m).alias("kind"), C.wait_seconds(m, F.col("event_id") % 3).alias("wait_s"))


D_CLASS = "CASE WHEN v IN ('1', '2.5') THEN 'num' WHEN v = '\"s\"' THEN 'str' WHEN v = 'true' THEN 'bool' WHEN v LIKE '{%' THEN 'dict' WHEN v = '[1]' THEN 'list' END"


@query(f"SELECT f, count(*) AS conflicts FROM (SELECT f, cls, lag(cls) OVER (PARTITION BY f ORDER BY line) AS prev FROM (SELECT f, line, {D_CLASS} AS cls FROM {D_TYPED} t) u WHERE cls IS NOT NULL) w WHERE prev <> cls GROUP BY f")
def json_schema_drift(spark, sf_dir):
    t = _sql(spark, sf_dir, TYPED, "events").select("f", "line", C.schema_class(F.try_parse_json("v")).alias("cls")).filter("cls IS NOT NULL")
    return t.withColumn("prev", F.lag("cls").over(W.partitionBy("f").orderBy("line"))).filter("prev <> cls").groupBy("f").agg(F.count("*").alias("conflicts"))


@query(f"SELECT f, line, CASE v WHEN 'null' THEN NULL WHEN '\"s\"' THEN 's' ELSE v END AS fixed, v NOT IN ('null', '\"s\"') AS changed FROM {D_TYPED} t")
def json_schema_fix(spark, sf_dir):
    t = _sql(spark, sf_dir, TYPED, "events").withColumn("x", F.try_parse_json("v"))
    cls = C.schema_class(F.col("x"))
    return t.select("f", "line", F.when(cls == "str", F.try_variant_get("x", "$", "string")).when(cls.isNotNull(), F.to_json("x")).alias("fixed"), (cls.isNotNull() & (cls != "str")).alias("changed"))


@query(r"SELECT doc_id AS keeper, k AS code FROM (SELECT doc_id, k, row_number() OVER (PARTITION BY k ORDER BY doc_id) AS r FROM (SELECT doc_id, regexp_replace(text, '[ \t\r\f\v]+(\n|$)', '\1', 'g') AS k FROM documents WHERE text <> '') t) u WHERE r = 1")
def dedup_blocks(spark, sf_dir):
    """The first block of each rendered text, whose lines are trimmed at the right; blocks without lines go. Equality is by SHA-256, so that no text is a shuffle's key."""
    d = _read(spark, sf_dir, "documents").filter("text <> ''").select("doc_id", F.regexp_replace("text", r"[^\S\n]+(\n|\z)", "$1").alias("code"))
    keep = d.select("doc_id", F.sha2("code", 256).alias("k")).groupBy("k").agg(F.min("doc_id").alias("doc_id")).select("doc_id")
    return d.join(keep, "doc_id", "left_semi").select(F.col("doc_id").alias("keeper"), "code")


D_LINES = f"(SELECT p_partkey, unnest(string_split(code, chr(10))) AS line, generate_subscripts(string_split(code, chr(10)), 1) AS ln FROM {D_CODE} c)"
D_DELTA = r"((CASE WHEN regexp_matches(u, '^\s*(IF|CASE|FOR|WHILE|REPEAT)\b') THEN 1 ELSE 0 END) - len(regexp_extract_all(u, '\bEND_(?:IF|CASE|FOR|WHILE|REPEAT)\b')))"
D_CLEAN_LINE = r"regexp_replace(regexp_replace({0}, '//.*$', ''), '\(\*.*?\*\)', '', 'g')"


def _lines(code: DataFrame) -> DataFrame:
    return code.select("p_partkey", F.posexplode(F.split("code", "\n")).alias("ln", "line")).withColumn("ln", (F.col("ln") + 1).cast("long"))


@query(f"SELECT p_partkey, count(*) AS n_lines, min(d) AS lowest, arg_max(d, ln) AS last, min(d) >= 0 AND arg_max(d, ln) = 0 AS balanced FROM (SELECT p_partkey, ln, CAST(sum(x) OVER (PARTITION BY p_partkey ORDER BY ln) AS BIGINT) AS d FROM (SELECT p_partkey, ln, {D_DELTA} AS x FROM (SELECT p_partkey, ln, upper({D_CLEAN_LINE.format('line')}) AS u FROM {D_LINES} l) a) b) c GROUP BY p_partkey")
def ctrl_depth(spark, sf_dir):
    d = F.sum(C.ctrl_delta(F.col("line"))).over(W.partitionBy("p_partkey").orderBy("ln"))
    g = _lines(_code(spark, sf_dir)).withColumn("d", d).groupBy("p_partkey").agg(F.count("*").alias("n_lines"), F.min("d").alias("lowest"), F.max_by("d", "ln").alias("last"))
    return g.withColumn("balanced", (F.col("lowest") >= 0) & (F.col("last") == 0))


@query("SELECT user_id, seg, count(*) AS n, min(event_id) AS first_id FROM (SELECT user_id, event_id, CAST(sum(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY event_id) AS BIGINT) AS seg FROM events) t GROUP BY user_id, seg")
def stage_segments(spark, sf_dir):
    seg = F.sum(F.when(F.col("event_type") == "purchase", 1).otherwise(0)).over(W.partitionBy("user_id").orderBy("event_id"))
    return _read(spark, sf_dir, "events").withColumn("seg", seg).groupBy("user_id", "seg").agg(F.count("*").alias("n"), F.min("event_id").alias("first_id"))


@query("SELECT event_type AS stage, count(*) AS n, count(*) FILTER (value < 5) AS failed, min(event_id) FILTER (value < 5) AS first_failure FROM events GROUP BY event_type")
def stage_report(spark, sf_dir):
    bad = F.col("value") < 5
    return _read(spark, sf_dir, "events").groupBy(F.col("event_type").alias("stage")).agg(F.count("*").alias("n"), F.count_if(bad).alias("failed"), F.min(F.when(bad, F.col("event_id"))).alias("first_failure"))


D_RW = "(SELECT l_orderkey, l_linenumber, ['v' || (l_suppkey % 5), 'v' || (l_partkey % 5)] AS reads, ['v' || (l_partkey % 4)] AS writes FROM lineitem)"


@query(f"SELECT a.l_orderkey, a.l_linenumber, len(list_intersect(a.writes, b.reads)) > 0 AS raw, len(list_intersect(a.reads, b.writes)) > 0 AS war, len(list_intersect(a.writes, b.writes)) > 0 AS waw FROM {D_RW} a JOIN {D_RW} b ON a.l_orderkey = b.l_orderkey AND b.l_linenumber = a.l_linenumber + 1")
def hazard_pairs(spark, sf_dir):
    v = lambda c, n: F.concat(F.lit("v"), F.col(c) % n)
    t = _read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", F.array(v("l_suppkey", 5), v("l_partkey", 5)).alias("reads"), F.array(v("l_partkey", 4)).alias("writes"))
    after = t.select("l_orderkey", (F.col("l_linenumber") - 1).alias("l_linenumber"), F.col("reads").alias("r2"), F.col("writes").alias("w2"))
    n = t.join(after, ["l_orderkey", "l_linenumber"])
    return n.select("l_orderkey", "l_linenumber", F.arrays_overlap("writes", "r2").alias("raw"), F.arrays_overlap("reads", "w2").alias("war"), F.arrays_overlap("writes", "w2").alias("waw"))


@query(f"SELECT quality, kind, count(*) AS n FROM (SELECT quality, p_partkey % 3 AS kind FROM {D_STATUS} s) t GROUP BY CUBE (quality, kind)")
def funnel_stats_cube(spark, sf_dir):
    return funneled(_code(spark, sf_dir)).withColumn("kind", F.col("p_partkey") % 3).cube("quality", "kind").agg(F.count("*").alias("n"))


#: Each text, what is left of it as a variable, and whether it names a type of function blocks.
NAMES = [
    ("true", None, False), ("False", None, False), ("-1.5e3", None, False), ("12", None, False), ("1_0", None, False), (".5", None, False), ("1.", None, False), ("nan", None, False), ("-Infinity", None, False), ("inf", None, False),
    (" x1 ", "x1", False), ("m_fb", "m_fb", False), ("M_FB", "M_FB", True), ("Timer_FB", "Timer_FB", False), ("_FB", "_FB", True), ("A_FBX", "A_FBX", False), ("1d", "1d", False), ("1__0", "1__0", False), ("arr[i]", "arr[i]", False), ("infinit", "infinit", False),
]
D_NAMES = "(VALUES " + ", ".join(f"({k}, {'CAST(NULL AS VARCHAR)' if v is None else repr(v)}, {str(b).lower()})" for k, (_, v, b) in enumerate(NAMES)) + ") n(k, var, is_fb)"


@query(f"SELECT event_id, var, is_fb FROM events JOIN {D_NAMES} ON event_id % {len(NAMES)} = k")
def normal_vars(spark, sf_dir):
    name = F.element_at(F.array(*[F.lit(x) for x, _, _ in NAMES]), (F.col("event_id") % len(NAMES) + 1).cast("int"))
    return _read(spark, sf_dir, "events").select("event_id", C.normal_var(name).alias("var"), C.is_fb_type(name).alias("is_fb"))


FILES = [("IEC61131_10_Ed1_0.xsd", "Ed1.0", "WARNING", "WARNING"), ("a/b/X_Ed2_1_3.xsd", "Ed2.1.3", "FATAL", "FATAL"), ("plain.xsd", None, "ERROR", "ERROR"), ("_Ed9", "Ed9", "NONE", "ERROR")]
D_FILES = "(VALUES " + ", ".join(f"({k}, {'CAST(NULL AS VARCHAR)' if v is None else repr(v)}, '{sev}')" for k, (_, v, _, sev) in enumerate(FILES)) + ") f(k, version, severity)"


@query(f"SELECT event_id, version, severity FROM events JOIN {D_FILES} ON event_id % {len(FILES)} = k")
def schema_versions(spark, sf_dir):
    pick = lambda i: F.element_at(F.array(*[F.lit(x[i]) for x in FILES]), (F.col("event_id") % len(FILES) + 1).cast("int"))
    return _read(spark, sf_dir, "events").select("event_id", C.schema_version(pick(0)).alias("version"), C.severity(pick(2)).alias("severity"))


@query("SELECT user_id, CAST(count(*) FILTER (value < 5) AS BIGINT) AS errors, CAST(count(*) FILTER (value >= 5 AND value < 20) AS BIGINT) AS warnings, array_to_string(list_slice(list(event_type || event_id ORDER BY event_id) FILTER (value < 20), 1, 5), ',') AS first_five FROM events GROUP BY user_id")
def severity_counts(spark, sf_dir):
    """Of each document: errors and warnings among its faults, and the first five by place. A document's faults are one validator's report."""
    e = _read(spark, sf_dir, "events").withColumn("severity", C.severity(F.when(F.col("value") >= 5, "WARNING").otherwise("ERROR")))
    fault = F.col("value") < 20
    w = W.partitionBy("user_id").orderBy("event_id")
    k = F.sum(fault.cast("int")).over(w)
    shown = e.withColumn("shown", F.when(fault & (k <= 5), F.struct("event_id", F.concat("event_type", F.col("event_id").cast("string")).alias("m"))))
    g = shown.groupBy("user_id").agg(F.count_if(fault & (F.col("severity") == "ERROR")).alias("errors"), F.count_if(fault & (F.col("severity") == "WARNING")).alias("warnings"), F.array_sort(F.collect_list("shown")).alias("five"))
    return g.select("user_id", "errors", "warnings", F.nullif(F.array_join(F.transform("five", lambda x: x["m"]), ","), F.lit("")).alias("first_five"))


@query("SELECT event_type AS batch, count(*) AS total, count(*) FILTER (event_id < coalesce(f, event_id + 1)) AS passed, CAST(CASE WHEN max(f) IS NULL THEN 0 ELSE 1 END AS BIGINT) AS failed FROM (SELECT *, min(CASE WHEN value < 5 THEN event_id END) OVER (PARTITION BY event_type) AS f FROM events) t GROUP BY event_type")
def batch_until_first_error(spark, sf_dir):
    """A batch's summary when validation stops at the first failure: the total still counts all."""
    e = _read(spark, sf_dir, "events")
    first = e.filter("value < 5").groupBy("event_type").agg(F.min("event_id").alias("f"))
    seen = e.join(F.broadcast(first), "event_type", "left")  # a row a batch
    return seen.groupBy(F.col("event_type").alias("batch")).agg(F.count("*").alias("total"), F.count_if(F.col("f").isNull() | (F.col("event_id") < F.col("f"))).alias("passed"), F.count_if(F.col("event_id") == F.col("f")).alias("failed"))
