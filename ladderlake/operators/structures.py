"""Structures of programs as intervals of lines: what holds a line, how far a statement goes, and what a set of lines needs to stand alone.

A table of lines has key columns, `ln` (1, 2, ... without gaps in each program) and `line`; a block is a table of (key, ln) of chosen lines.
Depths are running sums; one that never falls below 0 is the sum less the least sum so far, or 0. IFs are matched to their ENDs
by depth: at one depth they alternate. Whether a range holds a chosen line is told by counts up to its two ends, and which
structures hold a line by a join on dyadic ranges, so no join compares all lines with all structures.

Windows go over a program's lines, so a program should fit a task; nothing else is bounded.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import code as C
from .blocks import structure_ends

#: Programs have fewer lines than 2 ** LEVELS.
LEVELS = 31
HEADS = r"(?i)^\s*(IF|CASE|FOR|WHILE|REPEAT)\b"


def _by(key: list[str], *more: str) -> W:
    return W.partitionBy(*key, *more).orderBy("ln")


def _from_here(key: list[str]) -> W:
    return _by(key).rowsBetween(0, W.unboundedFollowing)


def clamped_depth(lines: DataFrame, key: list[str], delta: Column) -> DataFrame:
    """lines with `depth` after each: delta is added, and what would be negative is 0."""
    total = F.sum(delta).over(_by(key))
    return lines.withColumn("depth", total).withColumn("depth", F.col("depth") - F.least(F.lit(0), F.min("depth").over(_by(key))))


def header_ends(lines: DataFrame, key: list[str]) -> DataFrame:
    """(key, ln, header_ln): of each line, the first from there on with THEN, or itself."""
    then = F.when(C.clean_line(F.col("line")).rlike(r"(?i)\bTHEN\b"), F.col("ln"))
    return lines.select(*key, "ln", F.coalesce(F.first(then, ignorenulls=True).over(_from_here(key)), F.col("ln")).alias("header_ln"))


def statement_ends(lines: DataFrame, key: list[str]) -> DataFrame:
    """(key, ln, end_ln): of each line, the first from there on with a semicolon at which no parenthesis opened since is open, or itself. Lines with semicolons meet each depth of a program once, so rows are lines times depths."""
    t = C.clean_line(F.col("line"))
    count = lambda c: F.regexp_count(t, F.lit(rf"\{c}")).cast("long")
    at = lines.select(*key, "ln", (count("(") - count(")")).alias("delta"), t.contains(";").alias("semi"))
    at = at.withColumn("after", F.sum("delta").over(_by(key))).withColumn("before", F.col("after") - F.col("delta"))
    levels = at.select(*key, F.col("before").alias("level")).distinct()
    stops = at.filter("semi").select(*key, "ln", "after").join(levels, key).filter("level >= after").select(*key, "level", "ln", F.lit(True).alias("stop"))
    starts = at.select(*key, F.col("before").alias("level"), "ln", F.lit(True).alias("start"))
    both = starts.join(stops, [*key, "level", "ln"], "full")
    end = F.first(F.when(F.col("stop"), F.col("ln")), ignorenulls=True).over(_by(key, "level").rowsBetween(0, W.unboundedFollowing))
    return both.withColumn("end_ln", end).filter("start").select(*key, "ln", F.coalesce("end_ln", "ln").alias("end_ln"))


def extents(statements: DataFrame, lines: DataFrame, key: list[str]) -> DataFrame:
    """(key, ln), each once: the lines of statements (key, ln, kind). Of an IF its header and END_IF, of other structures their first line and END, of all else the lines to its semicolon."""
    ends = structure_ends(lines, key).select(*key, "ln", "kind", "end_ln")
    s = statements.select(*key, "ln", "kind").join(header_ends(lines, key), [*key, "ln"]).join(statement_ends(lines, key).withColumnRenamed("end_ln", "semicolon_ln"), [*key, "ln"]).join(ends, [*key, "ln", "kind"], "left")
    run = F.when(F.col("kind") == "IF", F.col("header_ln")).when(F.col("kind").isin(*C.CONTROL), F.col("ln")).otherwise(F.col("semicolon_ln"))
    tail = F.when(F.col("kind").isin(*C.CONTROL), F.array(F.coalesce("end_ln", "ln"))).otherwise(F.array().cast("array<int>"))
    return s.select(*key, F.explode(F.concat(F.sequence("ln", run), tail)).alias("ln")).distinct()


def if_conditions(lines: DataFrame, key: list[str]) -> DataFrame:
    """(key, ln, header_ln, indent, condition) of lines that begin an IF: what stands between IF and the header's last THEN, without comments, its lines joined by a space."""
    t = C.clean_line(F.col("line"))
    heads = lines.filter(t.rlike(r"(?i)^\s*IF\b")).select(*key, "ln", F.regexp_extract("line", r"^\s*", 0).alias("indent")).join(header_ends(lines, key), [*key, "ln"])
    each = heads.select(*key, "ln", "header_ln", "indent", F.explode(F.sequence("ln", "header_ln")).alias("at_ln"))
    text = lines.select(*key, F.col("ln").alias("at_ln"), C.stripped(t).alias("text")).filter("text <> ''")
    parts = each.join(text, [*key, "at_ln"]).groupBy(*key, "ln", "header_ln", "indent").agg(F.array_sort(F.collect_list(F.struct("at_ln", "text"))).alias("parts"))  # a header's lines
    merged = C.stripped(F.regexp_replace(F.array_join(F.transform("parts", lambda p: p["text"]), " "), r"(?i)^\s*IF\b", ""))
    return parts.select(*key, "ln", "header_ln", "indent", C.stripped(F.regexp_replace(merged, r"(?is)\bTHEN\b(?!.*\bTHEN\b).*$", "")).alias("condition"))


def if_branches(lines: DataFrame, key: list[str]) -> DataFrame:
    """(key, if_ln, head_ln, body_begin, body_end, end_ln): the branches of each IF that an END_IF closes, by line classes. An END_IF without an open IF is passed over; ELSIF and ELSE belong to the innermost open IF. A body begins after the first THEN from its head on, of an ELSE too, so an ELSE with another IF after it has none."""
    kind = C.line_class(F.col("line"))
    at = lines.select(*key, "ln", kind.alias("kind")).filter("kind IN ('if', 'elsif', 'else', 'end_if')")
    opens = F.when(F.col("kind") == "if", 1).when(F.col("kind") == "end_if", -1).otherwise(0)
    at = clamped_depth(at, key, opens).withColumn("was", F.coalesce(F.lag("depth").over(_by(key)), F.lit(0)))
    at = at.withColumn("level", F.when(F.col("kind") == "end_if", F.col("was")).otherwise(F.col("depth"))).filter("level > 0")
    at = at.withColumn("if_ln", F.last(F.when(F.col("kind") == "if", F.col("ln")), ignorenulls=True).over(_by(key, "level")))
    mine = W.partitionBy(*key, "if_ln")
    at = at.withColumn("next_ln", F.lead("ln").over(mine.orderBy("ln"))).withColumn("end_ln", F.max(F.when(F.col("kind") == "end_if", F.col("ln"))).over(mine))
    heads = at.filter("kind <> 'end_if' AND end_ln IS NOT NULL").join(header_ends(lines, key), [*key, "ln"])
    return heads.select(*key, "if_ln", F.col("ln").alias("head_ln"), (F.col("header_ln") + 1).alias("body_begin"), (F.col("next_ln") - 1).alias("body_end"), "end_ln")


def chosen_before(block: DataFrame, lines: DataFrame, key: list[str]) -> DataFrame:
    """(key, ln, n): how many lines up to each line, from 0, are the block's."""
    every = lines.select(*key, "ln").unionByName(lines.select(*key).distinct().withColumn("ln", F.lit(0)))
    marked = every.join(block.select(*key, "ln").distinct().withColumn("is_chosen", F.lit(1)), [*key, "ln"], "left")
    return marked.select(*key, "ln", F.sum(F.coalesce("is_chosen", F.lit(0))).over(_by(key)).alias("n"))


def _with_chosen(ranges: DataFrame, begin: str, end: str, counts: DataFrame, key: list[str]) -> DataFrame:
    """The ranges that hold a chosen line."""
    low = counts.select(*key, (F.col("ln") + 1).alias(begin), F.col("n").alias("n_before"))
    high = counts.select(*key, F.col("ln").alias(end), F.col("n").alias("n_through"))
    return ranges.join(low, [*key, begin]).join(high, [*key, end]).filter("n_through > n_before").drop("n_before", "n_through")


def repaired_ifs(block: DataFrame, lines: DataFrame, key: list[str], end_ifs: bool = True) -> DataFrame:
    """(key, ln): the block, the heads of branches whose bodies hold a line of it and, with end_ifs, the END_IFs of these."""
    hit = _with_chosen(if_branches(lines, key), "body_begin", "body_end", chosen_before(block, lines, key), key)
    more = F.array("head_ln", "end_ln") if end_ifs else F.array("head_ln")
    return block.select(*key, "ln").unionByName(hit.select(*key, F.explode(more).alias("ln"))).distinct()


def _is_label(text: Column) -> Column:
    """Whether a cleaned line is a CASE's label or an ELSE."""
    return (~text.contains(":=") & text.contains(":")) | text.rlike(r"(?i)^\s*ELSE\b")


def case_regions(lines: DataFrame, key: list[str]) -> DataFrame:
    """(key, ln, end_ln, has_label) of lines that begin a CASE; end_ln is the line itself where nothing closes it. has_label: a label or ELSE stands inside."""
    t = C.clean_line(F.col("line"))
    ends = structure_ends(lines, key).filter("kind = 'CASE'").select(*key, "ln", "end_ln")
    labels = chosen_before(lines.filter(_is_label(C.stripped(t))), lines, key)
    inside = ends.withColumn("first_in", F.col("ln") + 1).withColumn("last_in", F.greatest(F.col("end_ln") - 1, F.col("ln")))
    some = _with_chosen(inside, "first_in", "last_in", labels, key).select(*key, "ln", F.lit(True).alias("has_label"))
    return ends.join(some, [*key, "ln"], "left").select(*key, "ln", "end_ln", F.coalesce("has_label", F.lit(False)).alias("has_label"))


def repaired_cases(block: DataFrame, lines: DataFrame, key: list[str], end_cases: bool = True, labels: bool = True) -> DataFrame:
    """(key, ln): the block with first line and END of each CASE that one of its lines points to and that holds another inside, and of those inside lines the nearest label above; a CASE without any label loses first line and END. A line points to a CASE by being its first line, an END_CASE, or a label below it. Each CASE is judged by the block as given, not by what another one adds or loses."""
    t = C.clean_line(F.col("line"))
    u = C.stripped(t)
    head, end, label = t.rlike(r"(?i)^\s*CASE\b"), u.rlike(r"(?i)\bEND_CASE\b") & ~t.rlike(r"(?i)^\s*CASE\b"), _is_label(u)
    case_ln = F.last(F.when(head, F.col("ln")), ignorenulls=True).over(_by(key))
    label_ln = F.last(F.when(label, F.col("ln")), ignorenulls=True).over(_by(key))
    at = lines.select(*key, "ln", head.alias("head"), end.alias("end"), (label & ~head & ~end).alias("label"), (label | u.rlike(r"(?i)\bCASE\b")).alias("is_own"), case_ln.alias("case_ln"), label_ln.alias("label_ln"))
    mine = block.select(*key, "ln").distinct().join(at, [*key, "ln"])
    regions = case_regions(lines, key)
    ended = mine.filter("end AND case_ln < ln").select(*key, F.col("case_ln").alias("case_begin"), F.col("ln").alias("case_end"))
    named = mine.filter("head OR label AND case_ln < ln").select(*key, F.col("case_ln").alias("case_begin")).distinct().join(regions.select(*key, F.col("ln").alias("case_begin"), F.col("end_ln").alias("case_end")), [*key, "case_begin"])
    found = ended.unionByName(named).distinct().filter("case_end > case_begin + 1").withColumn("first_in", F.col("case_begin") + 1).withColumn("last_in", F.col("case_end") - 1)
    found = _with_chosen(found, "first_in", "last_in", chosen_before(block, lines, key), key)
    sound = _with_chosen(found, "first_in", "last_in", chosen_before(lines.filter(_is_label(u)), lines, key), key)
    hollow = found.join(sound.select(*key, "case_begin", "case_end"), [*key, "case_begin", "case_end"], "left_anti")
    gone = hollow.select(*key, F.explode(F.array("case_begin", "case_end")).alias("ln"))
    out = block.select(*key, "ln").distinct().join(gone, [*key, "ln"], "left_anti")
    out = out.unionByName(sound.select(*key, F.explode(F.array("case_begin", "case_end") if end_cases else F.array("case_begin")).alias("ln")))
    if labels:
        inside = enclosing(mine.filter("NOT is_own AND label_ln IS NOT NULL"), sound.select(*key, F.col("first_in").alias("begin_ln"), F.col("last_in").alias("end_ln"), "case_begin"), key)
        out = out.unionByName(inside.filter("label_ln > case_begin").select(*key, F.col("label_ln").alias("ln")))
    return out.distinct()


def without_empty_cases(block: DataFrame, lines: DataFrame, key: list[str]) -> DataFrame:
    """The block less first line and END of each CASE, both its lines, inside which the program has neither label nor ELSE."""
    hollow = case_regions(lines, key).filter("NOT has_label").join(block.select(*key, "ln"), [*key, "ln"], "left_semi")
    hollow = hollow.join(block.select(*key, F.col("ln").alias("end_ln")), [*key, "end_ln"], "left_semi")
    return block.join(hollow.select(*key, F.explode(F.array("ln", "end_ln")).alias("ln")), [*key, "ln"], "left_anti")


def enclosing(points: DataFrame, ranges: DataFrame, key: list[str]) -> DataFrame:
    """points (key, ln, ...) with each range (key, begin_ln, end_ln, ...) that holds ln. A range is parted into dyadic ranges, of which a point is in one a size, so each pair meets once, by equality."""
    size = lambda k: F.lit(1 << k).cast("long")
    sizes = range(LEVELS)
    mine = F.explode(F.array(*[F.struct(F.lit(k).alias("size"), F.floor(F.col("ln") / size(k)).alias("place")) for k in sizes]))
    parts = []
    for k in sizes:
        low, high = F.ceil(F.col("begin_ln") / size(k)), F.floor((F.col("end_ln") + 1) / size(k))
        some = low < high
        parts += [F.when(some & (low % 2 == 1), F.struct(F.lit(k).alias("size"), low.alias("place"))), F.when(some & (high % 2 == 1) & ((low % 2 == 0) | (high - 1 > low)), F.struct(F.lit(k).alias("size"), (high - 1).alias("place")))]
    held = ranges.select("*", F.explode(F.array_compact(F.array(*parts))).alias("cell")).select(*ranges.columns, "cell.size", "cell.place")
    rows = points.select("*", mine.alias("cell")).select(*points.columns, "cell.size", "cell.place")
    return rows.join(held, [*key, "size", "place"]).drop("size", "place")


def heads_around(block: DataFrame, lines: DataFrame, key: list[str]) -> DataFrame:
    """(key, ln): the block and the first lines of all structures that hold a line of it."""
    ends = structure_ends(lines, key).filter("end_ln > ln").select(*key, F.col("ln").alias("begin_ln"), "end_ln")
    around = enclosing(block.select(*key, "ln"), ends, key)
    return block.select(*key, "ln").unionByName(around.select(*key, F.col("begin_ln").alias("ln"))).distinct()


def rendered_positive(block: DataFrame, lines: DataFrame, key: list[str]) -> DataFrame:
    """(key, text) of the block's lines in order. An IF of which only the ELSE has lines with content, and no ELSIF, is written as IF NOT(...) with these."""
    own = block.select(*key, "ln").distinct()
    t = C.clean_line(F.col("line"))
    full = C.norm_line(F.col("line")) != ""
    at = lines.select(*key, "ln", F.when(C.stripped(t).rlike(r"(?i)^ELSIF\b"), "elsif").when(C.stripped(t).rlike(r"(?i)^ELSE\b"), "else").alias("turn"))
    ends = structure_ends(lines, key).filter("kind = 'IF' AND end_ln > ln").select(*key, "ln", "end_ln")
    heads = if_conditions(lines, key).filter("condition <> ''").join(ends, [*key, "ln"]).join(own, [*key, "ln"], "left_semi")
    heads = heads.join(own.select(*key, F.col("ln").alias("end_ln")), [*key, "end_ln"], "left_semi")
    turn_ln = F.first(F.when(F.col("turn").isNotNull(), F.col("ln")), ignorenulls=True).over(_by(key).rowsBetween(1, W.unboundedFollowing))
    turns = at.select(*key, F.col("ln").alias("header_ln"), turn_ln.alias("else_ln"))
    elses = at.filter("turn = 'else'").select(*key, F.col("ln").alias("else_ln"))
    heads = heads.join(turns, [*key, "header_ln"]).filter("else_ln < end_ln").join(elses, [*key, "else_ln"], "left_semi")
    counts = chosen_before(own.join(lines.filter(full).select(*key, "ln"), [*key, "ln"], "left_semi"), lines, key)
    heads = heads.withColumn("then_begin", F.col("header_ln") + 1).withColumn("then_end", F.col("else_ln") - 1).withColumn("else_begin", F.col("else_ln") + 1).withColumn("else_end", F.col("end_ln") - 1)
    turned = _with_chosen(heads, "else_begin", "else_end", counts, key)
    used = _with_chosen(turned, "then_begin", "then_end", counts, key).select(*key, "ln")
    turned = turned.join(used, [*key, "ln"], "left_anti")
    # what is inside an IF that is turned isn't turned again
    inner = enclosing(turned.select(*key, "ln"), turned.select(*key, (F.col("ln") + 1).alias("begin_ln"), "end_ln"), key).select(*key, "ln")
    turned = turned.join(inner, [*key, "ln"], "left_anti")
    cut = enclosing(own, turned.select(*key, F.col("ln").alias("begin_ln"), F.col("else_ln").alias("end_ln")), key).select(*key, "ln")
    new = turned.select(*key, "ln", F.concat("indent", F.lit("IF NOT("), "condition", F.lit(") THEN")).alias("line"))
    kept = own.join(cut, [*key, "ln"], "left_anti").join(lines.select(*key, "ln", "line"), [*key, "ln"])
    rows = kept.unionByName(new).groupBy(*key).agg(F.array_sort(F.collect_list(F.struct("ln", "line"))).alias("rows"))  # a program's lines
    return rows.select(*key, F.concat(F.regexp_replace(F.array_join(F.transform("rows", lambda r: r["line"]), "\n"), r"\s+\z", ""), F.lit("\n")).alias("text"))
