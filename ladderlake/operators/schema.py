"""Types of JSON records key by key: where a key changes its type within a file, and which lines are no records."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import code as C


def _parsed(records: DataFrame, file: str, line: str, text: str) -> DataFrame:
    """Lines with content, as variants; what isn't JSON is null. A record that names a key twice isn't JSON here."""
    t = C.stripped(F.col(text))
    return records.select(F.col(file).alias("file"), F.col(line).alias("line"), t.alias("text")).filter("text <> ''").select("file", "line", F.try_parse_json("text").alias("record"))


def key_types(records: DataFrame, file: str, line: str, text: str) -> DataFrame:
    """(file, line, key, type, preview) of each value of each record that isn't null: num, str, bool, dict or list, and its first 60 characters."""
    objects = _parsed(records, file, line, text).filter(F.schema_of_variant("record").startswith("OBJECT"))
    each = objects.lateralJoin(objects.sparkSession.tvf.variant_explode(F.col("record").outer()))
    return each.select("file", "line", "key", C.schema_class(F.col("value")).alias("type"), F.left(F.col("value").cast("string"), F.lit(60)).alias("preview")).filter("type IS NOT NULL")


def drifts(types: DataFrame) -> DataFrame:
    """(file, line, key, expected, actual, preview): each value whose type isn't that of the key's last value in the file before it. Whole and broken numbers are one type; nulls and absent keys are passed over."""
    before = F.lag("type").over(W.partitionBy("file", "key").orderBy("line"))
    return types.withColumn("expected", before).filter("expected <> type").select("file", "line", "key", "expected", F.col("type").alias("actual"), "preview")


def line_faults(records: DataFrame, file: str, line: str, text: str) -> DataFrame:
    """(file, line, fault) of lines with content that aren't JSON objects."""
    p = _parsed(records, file, line, text)
    fault = F.when(F.col("record").isNull(), "not JSON").when(~F.schema_of_variant("record").startswith("OBJECT"), "not an object")
    return p.select("file", "line", fault.alias("fault")).filter("fault IS NOT NULL")
