"""Records of a generation loop from the stream of its attempts, with a task's tries, rejections and outcome as state.

An attempt has task, seq, code, thought, passed, error and ts. A task's first attempt that passes within `max_tries` ends it:
one `sft` record, and a `dpo` record of it against the last rejected code before it, if there is one. A task that hasn't passed after
`max_tries`, or that waits longer than the timeout for its next attempt, ends as one `failed` record with what was rejected, if
anything was. Attempts after the end change nothing. State goes when the watermark passes the timeout after a task's last attempt; attempts
that come later still begin the task anew.

`records` is the same over a table, without state. Over a replay in order both give the same rows, over restarts too.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

ATTEMPT = "task string, seq long, code string, thought string, passed boolean, error string, ts timestamp"
RECORD = "kind string, task string, output string, thought string, retries int, rejected string, samples array<struct<code:string,error:string>>"
#: Sizes between which a code may become an example, and how many examples there are.
GOLDEN_LENGTHS, GOLDEN_MOST = (200, 2000), 50
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
PROVIDER = "spark.sql.streaming.stateStore.providerClass"


def _rows(kinds: list[tuple]) -> pd.DataFrame:
    return pd.DataFrame(kinds, columns=["kind", "task", "output", "thought", "retries", "rejected", "samples"]).astype({"retries": "Int32"})


class Loop(StatefulProcessor):
    """By task: how many tries there were and whether it ended (a value), the rejected codes in order (a list, of max_tries at most)."""

    def __init__(self, max_tries: int, timeout_ms: int) -> None:
        self.max_tries, self.timeout_ms = max_tries, timeout_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.tries = handle.getValueState("tries", "n int, ended boolean")
        self.rejected = handle.getListState("rejected", "code string, error string")

    def _samples(self) -> list[dict]:
        return [{"code": c, "error": e} for c, e in self.rejected.get()]

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        n, ended = self.tries.get() if self.tries.exists() else (0, False)
        out, latest = [], None
        first = None
        for frame in rows:  # of a batch's attempts no more than the first max_tries count, however many there are
            latest = frame["ts"].max() if latest is None else max(latest, frame["ts"].max())
            first = (frame if first is None else pd.concat([first, frame])).sort_values("seq", kind="stable").head(self.max_tries)
        for r in first.itertuples(index=False):
            if ended:
                break
            if r.passed:
                samples = self._samples()
                out.append(("sft", key[0], r.code, r.thought, n, None, None))
                if samples:
                    out.append(("dpo", key[0], r.code, None, None, samples[-1]["code"], None))
                ended = True
            else:
                self.rejected.appendValue((r.code, r.error))
            n += 1
            if not ended and n >= self.max_tries:
                out.append(("failed", key[0], None, None, None, None, self._samples()))
                ended = True
        if ended:
            self.rejected.clear()
        self.tries.update((int(n), bool(ended)))
        for t in list(self.handle.listTimers()):
            self.handle.deleteTimer(t)
        self.handle.registerTimer(int(latest.timestamp() * 1000) + self.timeout_ms)
        yield _rows(out)

    def handleExpiredTimer(self, key: tuple, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        n, ended = self.tries.get()
        samples = self._samples()
        self.tries.clear()
        self.rejected.clear()
        yield _rows([("failed", key[0], None, None, None, None, samples)] if samples and not ended else [])


class Golden(StatefulProcessor):
    """By pool: its last GOLDEN_MOST examples, first in first out; each batch that brings one gives the pool as it is then."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.pool = handle.getListState("pool", "task string, code string")

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        pool = list(self.pool.get()) if self.pool.exists() else []
        for frame in rows:
            pool = (pool + [(r.task, r.output) for r in frame.itertuples(index=False)])[-GOLDEN_MOST:]
        self.pool.put(pool)
        yield pd.DataFrame([(key[0], i, t, c) for i, (t, c) in enumerate(pool)], columns=["pool", "place", "task", "code"])


def read_attempts(spark: SparkSession, path: str, files_at_once: int = 100) -> DataFrame:
    """Attempts in JSON lines that arrive in a folder."""
    return spark.readStream.schema(ATTEMPT).option("maxFilesPerTrigger", files_at_once).json(path)


def stream(attempts: DataFrame, max_tries: int = 3, delay: str = "1 hour", timeout_s: int = 3600) -> DataFrame:
    """RECORD of a stream of attempts. The session's state store has to be RocksDB's (see with_rocks)."""
    timed = attempts.withWatermark("ts", delay)
    return timed.groupBy("task").transformWithStateInPandas(Loop(max_tries, timeout_s * 1000), RECORD, "append", "EventTime")


def golden(records: DataFrame, pool) -> DataFrame:
    """(pool, place, task, code) of a stream of records: examples by the pool that a column names. The examples of a batch come in no order among themselves."""
    fit = records.filter("kind = 'sft'").filter((F.length("output") > GOLDEN_LENGTHS[0]) & (F.length("output") < GOLDEN_LENGTHS[1]))
    return fit.select(pool.alias("pool"), "task", "output").groupBy("pool").transformWithStateInPandas(Golden(), "pool string, place int, task string, code string", "append", "None")


def with_rocks(spark: SparkSession, run) -> None:
    """run() while the session's state store is RocksDB's; afterwards it is what it was."""
    before = spark.conf.get(PROVIDER, None)
    spark.conf.set(PROVIDER, ROCKS)
    try:
        run()
    finally:
        spark.conf.set(PROVIDER, before) if before else spark.conf.unset(PROVIDER)


def replay(attempts: DataFrame, path: str, checkpoint: str, **options) -> None:
    """Takes in what has arrived and writes the records as Parquet, each once, over restarts with the same checkpoint."""

    def run() -> None:
        q = stream(attempts, **options).writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()
        q.awaitTermination()
        if q.exception():
            raise q.exception()

    with_rocks(attempts.sparkSession, run)


def records(attempts: DataFrame, max_tries: int = 3, key: Sequence[str] = ("task",)) -> DataFrame:
    """RECORD of a table of attempts, without those tasks that are still waiting."""
    w = W.partitionBy(*key).orderBy("seq")
    a = attempts.withColumn("n", F.row_number().over(w)).filter(F.col("n") <= max_tries)
    won = a.groupBy(*key).agg(F.min(F.when(F.col("passed"), F.col("n"))).alias("won"), F.max("n").alias("tries"))
    a = a.join(won, list(key)).filter("won IS NULL OR n <= won")
    lost = F.array_sort(F.collect_list(F.when(~F.col("passed"), F.struct("n", "code", "error"))))  # max_tries at most
    g = a.groupBy(*key, "won", "tries").agg(lost.alias("lost"), F.max_by("code", "n").alias("output"), F.max_by("thought", "n").alias("thought"))
    none = lambda t: F.lit(None).cast(t)
    samples = "array<struct<code:string,error:string>>"
    sft = g.filter("won IS NOT NULL").select(F.lit("sft").alias("kind"), *key, "output", "thought", (F.col("won") - 1).cast("int").alias("retries"), none("string").alias("rejected"), none(samples).alias("samples"))
    dpo = g.filter("won > 1").select(F.lit("dpo").alias("kind"), *key, "output", none("string").alias("thought"), none("int").alias("retries"), F.element_at("lost", -1)["code"].alias("rejected"), none(samples).alias("samples"))
    failed = g.filter((F.col("tries") == max_tries) & F.col("won").isNull()).select(F.lit("failed").alias("kind"), *key, none("string").alias("output"), none("string").alias("thought"), none("int").alias("retries"), none("string").alias("rejected"), F.transform("lost", lambda x: F.struct(x["code"].alias("code"), x["error"].alias("error"))).alias("samples"))
    return sft.unionByName(dpo).unionByName(failed)
