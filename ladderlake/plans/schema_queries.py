"""Queries on the types of JSON records. A conversation is a file and a turn a line; the length of its text decides which keys the record has and what their values are. The SQL knows the types from the same rules, without JSON."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import schema as S
from ..sources.json_arrays import write_arrays
from ..sources.records import work_folder

QUERIES: dict = {}
ORACLE_SQL: dict = {}
K = "(SELECT conv_id AS f, turn AS line, length(text) AS k FROM {conversations})"
A, B = "CASE k % 4 WHEN 0 THEN '1' WHEN 1 THEN '2.5' WHEN 2 THEN '\"s\"' ELSE 'null' END", "CASE line % 3 WHEN 0 THEN 'true' WHEN 1 THEN '[1]' ELSE '{\"x\":1}' END"
RECORDS = f"SELECT f, line, CASE WHEN k % 11 = 0 THEN '{{\"a\": no' WHEN k % 13 = 0 THEN '[1,2]' WHEN k % 17 = 0 THEN '  ' ELSE ' {{\"a\":' || {A} || CASE WHEN k % 3 > 0 THEN ',\"b\":' || {B} ELSE '' END || CASE WHEN k % 5 = 0 THEN ',\"c d\":' || CAST(line AS VARCHAR(20)) WHEN k % 5 = 1 THEN ',\"c d\":\"' || repeat('long ', 20) || '\"' ELSE '' END || '}}' END AS record FROM {K} t"
D_K = K.replace("{conversations}", "conversations")
D_TYPES = f"""(SELECT f, line, 'a' AS key, CASE k % 4 WHEN 0 THEN 'num' WHEN 1 THEN 'num' WHEN 2 THEN 'str' END AS type, CASE k % 4 WHEN 0 THEN '1' WHEN 1 THEN '2.5' ELSE 's' END AS preview, k FROM {D_K} t UNION ALL SELECT f, line, 'b', CASE line % 3 WHEN 0 THEN 'bool' WHEN 1 THEN 'list' ELSE 'dict' END, {B}, k FROM {D_K} t WHERE k % 3 > 0
UNION ALL SELECT f, line, 'c d', CASE k % 5 WHEN 0 THEN 'num' ELSE 'str' END, CASE k % 5 WHEN 0 THEN CAST(line AS VARCHAR) ELSE repeat('long ', 12) END, k FROM {D_K} t WHERE k % 5 < 2)"""


def query(sql: str):
    def add(f):
        QUERIES[f.__name__], ORACLE_SQL[f.__name__] = f, sql
        return f

    return add


def _records(spark, sf_dir):
    braced = RECORDS.replace("{", "{{").replace("}", "}}").replace("{{conversations}}", "{conversations}")
    return spark.sql(braced, conversations=spark.read.parquet(f"{sf_dir}/conversations.parquet"))


@query(f"SELECT file, line, key, expected, actual, preview FROM (SELECT f AS file, line, key, lag(type) OVER (PARTITION BY f, key ORDER BY line) AS expected, type AS actual, preview FROM {D_TYPES} t WHERE type IS NOT NULL AND k % 11 > 0 AND k % 13 > 0 AND k % 17 > 0) u WHERE expected <> actual")
def json_key_drift(spark, sf_dir):
    return S.drifts(S.key_types(_records(spark, sf_dir), "f", "line", "record"))


@query(f"SELECT f AS file, line, CASE WHEN k % 11 = 0 THEN 'not JSON' ELSE 'not an object' END AS fault FROM {D_K} t WHERE k % 11 = 0 OR k % 13 = 0")
def json_line_faults(spark, sf_dir):
    return S.line_faults(_records(spark, sf_dir), "f", "line", "record")


D_STATUS = "CASE k % 3 WHEN 0 THEN 'golden' WHEN 1 THEN 'basic_error' ELSE 'syntax_error' END"


@query(f"SELECT CAST(CAST(floor(f / 100) AS BIGINT) AS VARCHAR) AS stem, {D_STATUS} AS quality, f AS conv_id, line AS turn, k FROM {D_K} t")
def arrays_by_status(spark, sf_dir):
    """Records written as one array a file and status, and read back from these."""
    path = work_folder(spark, "arrays")
    t = spark.sql(f"SELECT f AS conv_id, line AS turn, k, CAST(floor(f / 100) AS BIGINT) AS stem, {D_STATUS} AS quality, f * 1000000 + line AS place FROM {K}", conversations=spark.read.parquet(f"{sf_dir}/conversations.parquet"))
    write_arrays(t, path, stem="stem")
    back = spark.read.option("multiLine", True).option("recursiveFileLookup", True).schema("conv_id long, turn long, k int").json(path)
    place = F.split(F.col("_metadata.file_path"), "/")
    return back.select(F.element_at(place, -2).alias("stem"), F.regexp_replace(F.element_at(place, -1), r"\.json$", "").alias("quality"), "conv_id", "turn", "k")
