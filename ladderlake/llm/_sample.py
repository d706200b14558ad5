"""Samples of a bounded size, drawn by a hash of id and text, so that rows of one id (or without one) aren't drawn all or none."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPAN = 1 << 52


def drawn(seed: int) -> Column:
    """A number in [0, SPAN) from the hash of doc_id and text."""
    return F.pmod(F.xxhash64("doc_id", "text", F.lit(seed)), F.lit(SPAN))


def least(rows: DataFrame, most: int, count: int) -> DataFrame:
    """(h): the `most` least distinct numbers h of rows, which have about `count` of them. Twice as many as are wanted pass a cut first, so the rest of the table is never sorted."""
    return rows.filter(F.col("h") < int(min(1.0, 2 * most / max(1, count)) * SPAN)).select("h").distinct().orderBy("h").limit(most)
