"""Readers and writers of code folders and of record files."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Record schemas of training data.
SFT = "instruction string, input string, output string, metadata struct<thought:string,retries:int,evolution:string>"
DPO = "prompt string, chosen string, rejected string, metadata map<string,string>"
FAILED = "instruction string, rejected_samples array<struct<code:string,error:string>>, final_reason string, timestamp string"
GOLDEN = "task string, code string"


def work_folder(spark: SparkSession, name: str) -> str:
    """A new path in the folder of spark.checkpoint.dir, which all executors share; in local mode without one, in a temporary folder."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        base = "file://" + tempfile.mkdtemp(prefix="ladderlake-")
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def read_files(spark: SparkSession, path: str, pattern: str) -> DataFrame:
    """path, src_stem (the file's name without its ending) and text of each file below a folder whose name fits the pattern, such as *.json."""
    files = spark.read.text(path, wholetext=True, recursiveFileLookup=True, pathGlobFilter=pattern)
    name = F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1)
    return files.select(F.col("_metadata.file_path").alias("path"), F.regexp_replace(F.url_decode(name), r"\.[^.]*$", "").alias("src_stem"), F.col("value").alias("text"))


def read_code(spark: SparkSession, path: str, pattern: str = "*.[sS][tT]") -> DataFrame:
    """path and code of each file below a folder, without byte order mark, with \\n line ends."""
    return read_files(spark, path, pattern).select("path", F.regexp_replace(F.regexp_replace("text", "^﻿", ""), "\r\n?", "\n").alias("code"))


def read_jsonl(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A record a line. Lines that aren't such a record keep their text in `bad_line`, which is null else."""
    return spark.read.schema(f"{schema}, bad_line string").option("columnNameOfCorruptRecord", "bad_line").json(path)


def read_json_arrays(spark: SparkSession, path: str, schema: str, pattern: str = "*.json") -> DataFrame:
    """path, src_stem, place (from 0) and the fields of each record of files that are one JSON array each. A file that isn't one gives no rows. A file is read by one task, so large data belong in lines."""
    files = read_files(spark, path, pattern)
    items = F.from_json(F.when(F.ltrim("text").startswith("["), F.col("text")), f"array<struct<{', '.join(f'{n}:{t}' for n, t in _fields(schema))}>>")
    return files.select("path", "src_stem", F.posexplode(items).alias("place", "r")).select("path", "src_stem", "place", "r.*")


def _fields(schema: str) -> list[tuple[str, str]]:
    from pyspark.sql.types import StructType

    return [(f.name, f.dataType.simpleString()) for f in StructType.fromDDL(schema)]


def read_golden(spark: SparkSession, path: str) -> DataFrame:
    """task and code of the golden examples."""
    return read_json_arrays(spark, path, GOLDEN).select("task", "code")


def read_tasks(spark: SparkSession, path: str) -> DataFrame:
    """The tasks of a list, one a line, stripped, without blank lines."""
    return spark.read.text(path).select(F.regexp_replace("value", r"^\s+|\s+$", "").alias("task")).filter("task <> ''")


def read_xml(spark: SparkSession, path: str, pattern: str = "*.xml") -> DataFrame:
    """path and xml of each file below a folder. Documents that are at hand as text or bytes are a column already: bytes are decoded as UTF-8."""
    return read_files(spark, path, pattern).select("path", F.col("text").alias("xml"))


def write_jsonl(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """A record a line, null fields included."""
    df.write.mode(mode).option("ignoreNullFields", False).json(path)


def write_by_status(df: DataFrame, path: str, stem: str = "src_stem", status: str = "quality", mode: str = "overwrite") -> None:
    """JSON lines in a folder for each input file and status: src_stem=a/quality=golden/. With status, only files that have records of it appear."""
    df.repartition(F.col(stem), F.col(status), F.pmod(F.hash(*df.columns), F.lit(16))).write.mode(mode).option("ignoreNullFields", False).partitionBy(stem, status).json(path)


def write_by_file(df: DataFrame, path: str, stem: str = "src_stem", mode: str = "overwrite") -> None:
    """JSON lines in a folder for each input file, such as the augmented records next to their originals."""
    df.repartition(F.col(stem), F.pmod(F.hash(*df.columns), F.lit(16))).write.mode(mode).option("ignoreNullFields", False).partitionBy(stem).json(path)


def arrays_of(lines: DataFrame, key: list[str], order: str, record: str = "line") -> DataFrame:
    """(key, n, array): the JSON array of each key's lines in order, those that aren't JSON left out. An array is one value, so it is for files of a size that one task can hold."""
    good = lines.filter(F.try_parse_json(record).isNotNull())
    g = good.groupBy(*key).agg(F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), F.trim(record).alias("r")))).alias("rows"))
    return g.select(*key, F.size("rows").cast("long").alias("n"), F.concat(F.lit("["), F.array_join(F.transform("rows", lambda x: x["r"]), ",\n"), F.lit("]")).alias("array"))


def jsonl_to_arrays(spark: SparkSession, path: str, pattern: str = "*.jsonl") -> DataFrame:
    """(src_stem, n, array) of each file of JSON lines."""
    lines = read_files(spark, path, pattern).select("src_stem", F.posexplode(F.split("text", "\n")).alias("place", "line"))
    return arrays_of(lines, ["src_stem"], "place")


def cached(programs: DataFrame, path: str, version: str, code: str, make) -> DataFrame:
    """make(programs) with the column `key` (the code's SHA-256), for the programs that are asked for, kept as Parquet for each version: only what isn't there is worked out and added. make keeps the columns it is given next to its own, and gives a row or more for each program. Files that can't be read count as absent: what they held is worked out again, the other files stay."""
    spark = programs.sparkSession
    folder = f"{path}/version={version}"
    keyed = programs.select(F.sha2(F.col(code).cast("string"), 256).alias("key"), F.col(code).alias("code")).dropDuplicates(["key"])
    where = spark._jvm.org.apache.hadoop.fs.Path(folder)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(where)
    there = lambda: spark.read.schema(make(keyed).schema).option("ignoreCorruptFiles", True).parquet(folder)
    missing = keyed.join(there().select("key").distinct(), "key", "left_anti")
    make(missing).write.mode("append").parquet(folder)
    return there().join(keyed.select("key"), "key", "left_semi")
