"""The generation loop over the turns of conversations as attempts: as a stream with state, and as a table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.records import work_folder
from ..streaming import loop

QUERIES: dict = {}
ORACLE_SQL: dict = {}
SQL = """WITH a AS (SELECT CAST(conv_id AS VARCHAR) AS task, turn, 'c' || turn || ' ' || length(text) AS code, length(text) % 4 = 0 AS passed, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS n FROM conversations),
t AS (SELECT *, min(CASE WHEN passed THEN n END) OVER (PARTITION BY task) AS won, count(*) OVER (PARTITION BY task) AS tries FROM a WHERE n <= 3)
SELECT 'sft' AS kind, task, code AS output, CAST(n - 1 AS INTEGER) AS retries, CAST(NULL AS VARCHAR) AS rejected, '' AS samples FROM t WHERE n = won
UNION ALL SELECT 'dpo', t.task, t.code, NULL, b.code, '' FROM t JOIN t b ON b.task = t.task AND b.n = t.n - 1 WHERE t.n = t.won
UNION ALL SELECT 'failed', task, NULL, NULL, NULL, string_agg(code || ':e' || turn, ',' ORDER BY n) FROM t WHERE won IS NULL AND tries = 3 GROUP BY task"""


def query(f):
    QUERIES[f.__name__], ORACLE_SQL[f.__name__] = f, SQL
    return f


def _attempts(c: DataFrame) -> DataFrame:
    k = F.length("text")
    code = F.concat(F.lit("c"), F.col("turn"), F.lit(" "), k)
    return c.select(F.col("conv_id").cast("string").alias("task"), F.col("turn").alias("seq"), code.alias("code"), F.lit("t").alias("thought"), (k % 4 == 0).alias("passed"), F.concat(F.lit("e"), F.col("turn")).alias("error"), F.timestamp_seconds(F.lit(1_700_000_000) + F.col("turn")).alias("ts"))


def _shown(records: DataFrame) -> DataFrame:
    samples = F.array_join(F.transform("samples", lambda s: F.concat(s["code"], F.lit(":"), s["error"])), ",")
    return records.select("kind", "task", "output", "retries", "rejected", F.coalesce(samples, F.lit("")).alias("samples"))


@query
def loop_stream(spark, sf_dir):
    """The stream takes all files there are, with its state in the shared folder; what it wrote is the result."""
    path, state = work_folder(spark, "records"), work_folder(spark, "state")
    schema = spark.read.parquet(f"{sf_dir}/conversations.parquet").schema
    loop.replay(_attempts(spark.readStream.schema(schema).parquet(f"{sf_dir}/conversations*.parquet")), path, state)
    return _shown(spark.read.schema(loop.RECORD).parquet(path))


@query
def loop_records(spark, sf_dir):
    return _shown(loop.records(_attempts(spark.read.parquet(f"{sf_dir}/conversations.parquet"))))
