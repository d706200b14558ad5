"""Blocks of program lines: where structures end, cuts by stage and by size, what is worth keeping, and how a block is written out.

A table of lines has key columns, `ln` (from 1) and `line`. A block is a set of a program's lines: the same columns with a block's
number among the keys. All are windows over a key's lines, or folds over them as an array; a program is what bounds either.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from ..functions import code as C


def lines_of(programs: DataFrame, code: str = "code") -> DataFrame:
    """ln and line in place of the code."""
    rest = [c for c in programs.columns if c != code]
    return programs.select(*rest, F.posexplode(F.split(code, "\n")).alias("ln", "line")).withColumn("ln", F.col("ln") + 1)


def structure_ends(lines: DataFrame, key: list[str]) -> DataFrame:
    """(key, kind, ln, end_ln) of each line that begins a structure: the first line from there on at which the depth of its own kind is back and which has an END; without one, the line itself."""
    text = C.clean_line(F.col("line"))
    lines = lines.select(*key, "ln", "line").filter(text.rlike(rf"(?i)\b(END_)?({'|'.join(C.CONTROL)})\b"))
    kinds = F.explode(F.array(*[F.struct(F.lit(k).alias("kind"), C.head_of(F.regexp_replace(text, r"(?i)\bELSIF\b", "") if k == "IF" else text, k).alias("head"), C.ends_of(text, k).alias("ends")) for k in C.CONTROL]))
    each = lines.select(*key, "ln", kinds.alias("of_kind")).select(*key, "ln", "of_kind.*").filter("head OR ends > 0")
    after = F.sum(F.col("head").cast("long") - F.col("ends")).over(W.partitionBy(*key, "kind").orderBy("ln"))
    each = each.withColumn("after", after).withColumn("before", F.col("after") - F.col("head").cast("long") + F.col("ends"))
    # a head waits at the depth before it; a line that ends something arrives at the depth after it, and does so later than a head of the same line
    roles = F.explode(F.array(F.struct(F.col("head").alias("on"), F.col("before").alias("level"), F.lit(0).alias("turn")), F.struct((F.col("ends") > 0).alias("on"), F.col("after").alias("level"), F.lit(1).alias("turn"))))
    events = each.select(*key, "kind", "ln", roles.alias("role")).select(*key, "kind", "ln", "role.*").filter("on")
    later = W.partitionBy(*key, "kind", "level").orderBy("ln", "turn").rowsBetween(1, W.unboundedFollowing)
    found = events.withColumn("end_ln", F.first(F.when(F.col("turn") == 1, F.col("ln")), ignorenulls=True).over(later))
    return found.filter("turn = 0").select(*key, "kind", "ln", F.coalesce("end_ln", "ln").alias("end_ln"))


def _numbered(lines: DataFrame, key: list[str], begins: Column) -> DataFrame:
    return lines.withColumn("segment", F.sum(begins.cast("long")).over(W.partitionBy(*key).orderBy("ln")))


def _merged(cut: DataFrame, key: list[str], min_lines: int) -> DataFrame:
    """Segments of fewer than min_lines lines join the one before; what is still shorter than half of that goes, unless nothing would be left of the block. Windows over a key's lines, so no table of segments meets the lines in a join."""
    of, least = W.partitionBy(*key), max(1, min_lines // 2)
    first = F.row_number().over(W.partitionBy(*key, "segment").orderBy("ln")) == 1
    whole = (F.col("segment") == F.col("_first")) | (F.col("_n") >= min_lines)
    sized = cut.withColumn("_begins", first).withColumn("_n", F.count("*").over(W.partitionBy(*key, "segment"))).withColumn("_first", F.min("segment").over(of))
    parts = sized.withColumn("part", F.sum((F.col("_begins") & whole).cast("long")).over(of.orderBy("ln")))
    parts = parts.withColumn("_size", F.count("*").over(W.partitionBy(*key, "part"))).withColumn("_some", F.max("_size").over(of) >= least)
    # where nothing is long enough, the block stays as it was
    kept = parts.filter((F.col("_size") >= least) | ~F.col("_some")).withColumn("part", F.when(F.col("_some"), F.col("part")).otherwise(1))
    return kept.drop("segment", "_begins", "_n", "_first", "_size", "_some")


def split_by_stage(lines: DataFrame, key: list[str], min_lines: int = 5, names: tuple[str, ...] = ("stage", "state")) -> DataFrame:
    """lines with `part`: a line `IF ... stage = ...` begins a new one. A block without such a line is one part."""
    marker = F.upper("line").rlike("|".join(rf"\bIF\b.*\b{n.upper()}\b\s*=\s*[\w.]+" for n in names))
    # a block without a marker is one segment, which _merged keeps as part 1
    first = F.row_number().over(W.partitionBy(*key).orderBy("ln")) == 1
    return _merged(_numbered(lines.withColumn("_begins", first | F.coalesce(marker, F.lit(False))), key, F.col("_begins")).drop("_begins"), key, min_lines)


def split_by_size(lines: DataFrame, key: list[str], min_lines: int, max_lines: int) -> DataFrame:
    """lines with `part`: blocks of more than max_lines lines are cut at gaps once they have min_lines, and at max_lines, but nowhere inside a structure. A block is cut in one pass over its lines; one that isn't longer is one segment, which _merged keeps as part 1."""

    def cut_block(block: pa.Table) -> pa.Table:
        block = block.sort_by("ln")
        n, depth, last, segment, out = 0, 0, None, 0, []
        long = block.num_rows > max_lines
        for ln, delta in zip(block.column("ln").to_pylist(), block.column("delta").to_pylist()):
            if n == 0 or long and depth == 0 and (n >= max_lines or n >= min_lines and ln != last + 1):
                n, segment = 0, segment + 1
            n, depth, last = n + 1, max(depth + delta, 0), ln
            out.append(segment)
        return block.drop_columns(["delta"]).append_column("segment", pa.array(out, pa.int64()))

    of = lines.select(*key, "ln", "line", C.ctrl_delta(F.col("line")).alias("delta"))
    schema = StructType([*of.drop("delta").schema.fields, StructField("segment", LongType())])
    return _merged(of.groupBy(*key).applyInArrow(cut_block, schema), key, min_lines)


def meaningful(lines: DataFrame, key: list[str], min_lines: int = 10) -> DataFrame:
    """(key, n_lines, balanced, meaningful): structures open and close in order, and there are min_lines lines."""
    depth = F.sum(C.ctrl_delta(F.col("line"))).over(W.partitionBy(*key).orderBy("ln"))
    g = lines.withColumn("depth", depth).groupBy(*key).agg(F.count("*").alias("n_lines"), F.min("depth").alias("low"), F.max_by("depth", "ln").alias("last"))
    g = g.withColumn("balanced", (F.col("low") >= 0) & (F.col("last") == 0))
    return g.select(*key, "n_lines", "balanced", (F.col("balanced") & (F.col("n_lines") >= min_lines)).alias("meaningful"))


def without_empty(lines: DataFrame, program: DataFrame, program_key: list[str], key: list[str]) -> DataFrame:
    """A block's lines less the heads and ENDs of IFs and loops that hold none of its lines with content. program: the lines of the whole program, where ENDs are sought."""
    # joins by sort: a program's text is small in its file, its lines are not, so none of them is for a broadcast
    ends = structure_ends(program, program_key).filter("kind <> 'CASE'")
    here = lines.withColumn("_full", C.norm_line(F.col("line")) != "")
    full = here.filter("_full").groupBy(*key).agg(F.sort_array(F.collect_list("ln")).alias("full"))
    heads = here.select(*key, "ln").hint("merge").join(ends.hint("merge"), [*program_key, "ln"]).join(full.hint("merge"), key, "left")
    hollow = heads.filter(~F.coalesce(F.exists("full", lambda x: (x > F.col("ln")) & (x < F.col("end_ln"))), F.lit(False)))
    gone = hollow.select(*key, F.explode(F.array_distinct(F.array("ln", "end_ln"))).alias("ln")).distinct()
    return here.drop("_full").join(gone.hint("merge"), [*key, "ln"], "left_anti")


def rendered(lines: DataFrame, key: list[str]) -> DataFrame:
    """(key, text): the lines in order, trimmed at the end."""
    g = lines.groupBy(*key).agg(F.array_sort(F.collect_list(F.struct("ln", "line"))).alias("rows"))
    return g.select(*key, F.concat(F.regexp_replace(F.array_join(F.transform("rows", lambda r: r["line"]), "\n"), r"\s+\z", ""), F.lit("\n")).alias("text"))
