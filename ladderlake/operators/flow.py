"""Control flow, data flow and dependences of many programs at once, as tables of edges and sets.

A table of instructions has key columns (the program), `ip` (0, 1, ... without gaps in each program), `op` (`branch`, `goto`, or anything
else), `label` (a name of the instruction, or null), `target` and `other` (where a branch goes, or a goto, by label), `defs` and `uses`
(arrays of variables).

Sets are bits: a row (key, node, part, word, bits) holds 64 members of a node's set. `flow_facts` solves in = OR of the predecessors' out,
out = gen | (in & ~kill) for all programs together: a round sends only the bits that are new over their edges; the last is that in
which none is. Reaching definitions, post-dominators (on the reversed edges, as complements) and control dependence are three uses of it.
Rounds grow with the longest way through a program, and each is written to the shared folder, so a lost executor costs one round.
Joins are by sort: a side that is broadcast goes through the driver, anew in each round.

Results of solved sets are tables in that folder. A program without instructions has no rows. Repeated (key, ip) aren't
allowed, nor key columns that are named like the columns of a result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..sources.records import work_folder
from .tables import delete, stored

#: Instructions whose running sum is taken in one step.
SPAN = 4096
EXIT = -1


def _bit(place: Column | str) -> Column:
    place = F.col(place) if isinstance(place, str) else place
    return F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(place, F.lit(64)).cast("int"))


def _word(place: Column | str) -> Column:
    place = F.col(place) if isinstance(place, str) else place
    return F.floor(place / 64)


def sets(rows: DataFrame, key: list[str], node: str, member: str, part: Column | None = None) -> DataFrame:
    """(key, node, part, word, bits) of rows that name a node and a member of its set."""
    part = F.lit("") if part is None else part
    return rows.groupBy(*key, F.col(node).cast("long").alias("node"), part.alias("part"), _word(member).alias("word")).agg(F.bit_or(_bit(member)).alias("bits"))


def members(facts: DataFrame, key: list[str], member: str) -> DataFrame:
    """(key, node, part, member): a row for each bit."""
    each = F.filter(F.sequence(F.lit(0), F.lit(63)), lambda k: F.call_function("shiftleft", F.lit(1).cast("long"), k).bitwiseAND(F.col("bits")) != 0)
    return facts.select(*key, "node", "part", "word", F.explode(each).alias("in_word")).select(*key, "node", "part", (F.col("word") * 64 + F.col("in_word")).alias(member))


def _less(bits: Column, gone: Column) -> Column:
    return bits.bitwiseAND(F.bitwise_not(F.coalesce(gone, F.lit(0).cast("long"))))


def flow_facts(edges: DataFrame, gen: DataFrame, kill: DataFrame, key: list[str]) -> DataFrame:
    """(key, node, part, word, bits) of the least sets `in`. edges: (key, src, dst); gen and kill: as the result."""
    spark = edges.sparkSession
    work = work_folder(spark, "flow")
    cell = [*key, "node", "part", "word"]
    edges = stored(edges.select(*key, "src", "dst"), f"{work}/edges")
    kill = stored(kill.select(*cell, F.col("bits").alias("killed")), f"{work}/kill")
    sent = stored(gen.select(*cell, "bits"), f"{work}/gen")
    past = lambda df: df.join(kill.hint("merge"), cell, "left").select(*cell, _less(F.col("bits"), F.col("killed")).alias("bits")).filter("bits <> 0")
    rounds: list[str] = []
    while True:
        new = edges.join(sent.withColumnRenamed("node", "src").hint("merge"), [*key, "src"]).groupBy(*key, F.col("dst").alias("node"), "part", "word").agg(F.bit_or("bits").alias("bits"))
        if rounds:
            seen = spark.read.parquet(*rounds).join(new.select(*cell).hint("merge"), cell, "left_semi").select(*cell, F.lit(0).cast("long").alias("bits"), F.col("bits").alias("old"))
            both = new.withColumn("old", F.lit(0).cast("long")).unionByName(seen).groupBy(*cell).agg(F.bit_or("bits").alias("bits"), F.bit_or("old").alias("old"))
            new = both.select(*cell, _less(F.col("bits"), F.col("old")).alias("bits")).filter("bits <> 0")
        fresh = stored(new, f"{work}/round-{len(rounds)}")
        if fresh.isEmpty():
            break
        rounds.append(f"{work}/round-{len(rounds)}")
        sent = past(fresh)
    known = spark.read.parquet(*rounds) if rounds else fresh
    out = stored(known.groupBy(*cell).agg(F.bit_or("bits").alias("bits")), work_folder(spark, "facts"))
    delete(spark, work)
    return out


def closure(edges: DataFrame, seeds: DataFrame, key: list[str], name: str) -> DataFrame:
    """(key, name, node): what the seeds (key, name, node) reach over edges (key, src, dst), themselves included, cycles or not. Semi-naive: a round joins only the pairs that the last one found, less all found before."""
    spark = edges.sparkSession
    work = work_folder(spark, "closure")
    pair = [*key, name, "node"]
    edges = stored(edges.select(*key, F.col("src").alias("node"), "dst").distinct(), f"{work}/edges")
    fresh = stored(seeds.select(*pair).distinct(), f"{work}/round-0")
    rounds = [f"{work}/round-0"]
    while True:
        step = fresh.join(edges.hint("merge"), [*key, "node"]).select(*key, name, F.col("dst").alias("node")).distinct()
        fresh = stored(step.join(spark.read.parquet(*rounds).hint("merge"), pair, "left_anti"), f"{work}/round-{len(rounds)}")
        if fresh.isEmpty():
            break
        rounds.append(f"{work}/round-{len(rounds)}")
    out = stored(spark.read.parquet(*rounds), work_folder(spark, "closure"))
    delete(spark, work)
    return out


def edges(instr: DataFrame, key: list[str]) -> DataFrame:
    """(key, src, dst), each once. A branch goes to its two labels, a goto to its one, all else to the next instruction if there is one. Of equal labels the last holds; a label that isn't there is an error."""
    labels = instr.filter("label IS NOT NULL").groupBy(*key, F.col("label").alias("to")).agg(F.max("ip").alias("dst"))
    wanted = F.when(F.col("op") == "branch", F.array("target", "other")).when(F.col("op") == "goto", F.array("target"))
    jumps = instr.filter("op IN ('branch', 'goto')").select(*key, F.col("ip").alias("src"), F.explode(wanted).alias("to"))
    found = F.when(F.col("dst").isNotNull(), F.col("dst")).otherwise(F.raise_error(F.concat(F.lit("unknown label: "), F.coalesce("to", F.lit("none")))).cast("long"))
    jumps = jumps.join(labels.hint("merge"), [*key, "to"], "left").select(*key, "src", found.alias("dst"))
    after = instr.select(*key, (F.col("ip") - 1).alias("src"), F.col("ip").alias("dst"))
    falls = instr.filter("op NOT IN ('branch', 'goto')").select(*key, F.col("ip").alias("src")).join(after.hint("merge"), [*key, "src"])
    return jumps.distinct().unionByName(falls)


def numbered_blocks(instr: DataFrame, flow: DataFrame, key: list[str]) -> DataFrame:
    """(key, ip, block): blocks from 0. One begins at the first instruction, where a jump goes and after each jump. The running count goes by spans of SPAN instructions, so no task counts through a whole program."""
    jumps = instr.filter("op IN ('branch', 'goto')").select(*key, F.col("ip").alias("src"))
    leaders = flow.join(jumps.hint("merge"), [*key, "src"], "left_semi").select(*key, F.col("dst").alias("ip")).unionByName(jumps.select(*key, (F.col("src") + 1).alias("ip"))).distinct().withColumn("leads", F.lit(1))
    at = instr.select(*key, "ip").join(leaders.hint("merge"), [*key, "ip"], "left").select(*key, "ip", F.when(F.col("ip") == 0, 0).otherwise(F.coalesce("leads", F.lit(0))).cast("long").alias("leads"), F.floor(F.col("ip") / SPAN).alias("span"))
    spans = at.groupBy(*key, "span").agg(F.sum("leads").alias("n"))
    before = spans.select(*key, "span", F.coalesce(F.sum("n").over(W.partitionBy(*key).orderBy("span").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    here = F.sum("leads").over(W.partitionBy(*key, "span").orderBy("ip"))
    return at.withColumn("here", here).join(before.hint("merge"), [*key, "span"]).select(*key, "ip", (F.col("here") + F.col("before")).alias("block"))


def blocks(instr: DataFrame, key: list[str]) -> tuple[DataFrame, DataFrame]:
    """((key, block, first_ip, last_ip, is_exit), (key, src, dst) between blocks, each once): an exit's last instruction goes nowhere."""
    flow = edges(instr, key)
    of = numbered_blocks(instr, flow, key)
    spans = of.groupBy(*key, "block").agg(F.min("ip").alias("first_ip"), F.max("ip").alias("last_ip"))
    leaving = spans.select(*key, F.col("block").alias("src"), F.col("last_ip").alias("ip")).join(flow.select(*key, F.col("src").alias("ip"), "dst").hint("merge"), [*key, "ip"])
    links = leaving.join(of.select(*key, F.col("ip").alias("dst"), F.col("block").alias("to")).hint("merge"), [*key, "dst"]).select(*key, "src", F.col("to").alias("dst")).distinct()
    goes = links.select(*key, F.col("src").alias("block")).distinct().withColumn("goes", F.lit(True))
    return spans.join(goes.hint("merge"), [*key, "block"], "left").select(*key, "block", "first_ip", "last_ip", F.col("goes").isNull().alias("is_exit")), links


def definitions(instr: DataFrame, key: list[str]) -> DataFrame:
    """(key, ip, var): each variable once an instruction."""
    return instr.select(*key, "ip", F.explode(F.array_distinct("defs")).alias("var")).filter("var IS NOT NULL")


def gen_kill(instr: DataFrame, key: list[str]) -> tuple[DataFrame, DataFrame]:
    """The definitions that an instruction makes, and the program's others of the same variables: sets by variable."""
    defs = definitions(instr, key)
    gen = sets(defs, key, "ip", "ip", F.col("var"))
    every = gen.groupBy(*key, "part", "word").agg(F.bit_or("bits").alias("all"))
    own = defs.select(*key, F.col("ip").alias("node"), F.col("var").alias("part")).join(every.hint("merge"), [*key, "part"])
    kill = own.select(*key, "node", "part", "word", F.when(F.col("word") == _word("node"), _less(F.col("all"), _bit("node"))).otherwise(F.col("all")).alias("bits")).filter("bits <> 0")
    return gen, kill


def reaching(instr: DataFrame, key: list[str], flow: DataFrame | None = None) -> DataFrame:
    """(key, node, part, word, bits): the definitions, by variable (part), that reach each instruction."""
    gen, kill = gen_kill(instr, key)
    return flow_facts(edges(instr, key) if flow is None else flow, gen, kill, key)


def def_use(instr: DataFrame, key: list[str], reach: DataFrame | None = None) -> DataFrame:
    """(key, var, def_ip, use_ip): each use with each definition that reaches it."""
    reach = reaching(instr, key) if reach is None else reach
    uses = instr.select(*key, F.col("ip").alias("node"), F.explode(F.array_distinct("uses")).alias("part"))
    found = members(reach.join(uses.hint("merge"), [*key, "node", "part"], "left_semi"), key, "def_ip")
    return found.select(*key, F.col("part").alias("var"), "def_ip", F.col("node").alias("use_ip"))


def _backwards(instr: DataFrame, flow: DataFrame, key: list[str]) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(edges, gen, kill) on the reversed edges, from EXIT through the ends: what a node's way to an end may miss, and (part `ends`) a mark that reaches all from where a way ends."""
    last = instr.select(*key, F.col("ip").alias("src")).join(flow.hint("merge"), [*key, "src"], "left_anti").select(*key, F.lit(EXIT).cast("long").alias("src"), F.col("src").alias("dst"))
    back = flow.select(*key, F.col("dst").alias("src"), F.col("src").alias("dst")).unionByName(last)
    every = sets(instr.withColumn("node", F.lit(EXIT)), key, "node", "ip")
    mark = every.filter("word = 0").withColumn("part", F.lit("ends")).withColumn("bits", F.lit(1).cast("long"))
    return back, every.unionByName(mark), sets(instr, key, "ip", "ip")


def postdominators(instr: DataFrame, key: list[str], facts: DataFrame | None = None) -> DataFrame:
    """(key, ip, by_ip, ends): every way from ip to an end of the program passes by_ip, other than ip. From where no way ends (ends is false), every instruction counts.

    Solved as complements: what an end lacks is all but itself, and a node lacks what any successor lacks, less itself."""
    facts = flow_facts(*_backwards(instr, edges(instr, key), key), key) if facts is None else facts
    lacks = facts.filter("part = ''").select(*key, "node", "word", F.col("bits").alias("gone"))
    ends = facts.filter("part = 'ends'").select(*key, "node", F.lit(True).alias("ends"))
    every = instr.groupBy(*key, _word("ip").alias("word")).agg(F.bit_or(_bit("ip")).alias("bits"))
    each = instr.select(*key, F.col("ip").alias("node")).join(every.hint("merge"), key)
    mine = F.when(F.col("word") == _word("node"), _bit("node")).otherwise(F.lit(0).cast("long"))
    left = each.join(lacks.hint("merge"), [*key, "node", "word"], "left").select(*key, "node", F.lit("").alias("part"), "word", _less(_less(F.col("bits"), F.col("gone")), mine).alias("bits")).filter("bits <> 0")
    return members(left, key, "by_ip").join(ends.hint("merge"), [*key, "node"], "left").select(*key, F.col("node").alias("ip"), "by_ip", F.coalesce("ends", F.lit(False)).alias("ends"))


def nearest(post: DataFrame, key: list[str]) -> DataFrame:
    """post with `is_nearest`: whether by_ip is ip's parent in the tree of post-dominators. Those of an instruction from which a way ends are a chain, so its parent has one fewer."""
    depth = post.filter("ends").groupBy(*key, "ip").agg(F.count("*").alias("depth"))
    up = post.join(depth.hint("merge"), [*key, "ip"], "left").join(depth.select(*key, F.col("ip").alias("by_ip"), F.col("depth").alias("up")).hint("merge"), [*key, "by_ip"], "left")
    return up.select(*key, "ip", "by_ip", "ends", (F.col("ends") & (F.coalesce("up", F.lit(0)) == F.col("depth") - 1)).alias("is_nearest"))


def control_dependence(instr: DataFrame, key: list[str], flow: DataFrame | None = None, post: DataFrame | None = None) -> DataFrame:
    """(key, src, dst): dst lies on a way from branch src that meets no other post-dominator of src before it; a branch that is met again depends on itself."""
    flow = stored(edges(instr, key), work_folder(instr.sparkSession, "edges")) if flow is None else flow
    post = postdominators(instr, key, flow_facts(*_backwards(instr, flow, key), key)) if post is None else post
    branches = instr.filter("op = 'branch'").select(*key, "ip")
    kill = sets(post.join(branches.hint("merge"), [*key, "ip"], "left_semi"), key, "by_ip", "ip")
    met = flow_facts(flow, sets(branches, key, "ip", "ip"), kill, key)
    live = met.join(kill.withColumnRenamed("bits", "killed").hint("merge"), [*key, "node", "part", "word"], "left").select(*key, "node", "part", "word", _less(F.col("bits"), F.col("killed")).alias("bits"))
    return members(live, key, "src").select(*key, "src", F.col("node").alias("dst"))


def dependences(instr: DataFrame, key: list[str]) -> DataFrame:
    """(key, src, dst, kind), each once: data from a definition to the uses that it reaches, other than its own; control from a branch. Definitions forwards and post-dominators backwards are solved in the same rounds."""
    instr = stored(instr.select(*key, "ip", "op", "label", "target", "other", "defs", "uses"), work_folder(instr.sparkSession, "instructions"))
    flow = stored(edges(instr, key), work_folder(instr.sparkSession, "edges"))
    ways = {"forwards": (flow, *gen_kill(instr, key)), "backwards": _backwards(instr, flow, key)}
    both = [one.withColumn("way", F.lit("forwards")).unionByName(two.withColumn("way", F.lit("backwards"))) for one, two in zip(*ways.values())]
    facts = flow_facts(*both, [*key, "way"])
    fore, back = (facts.filter(F.col("way") == w).drop("way") for w in ways)
    data = def_use(instr, key, fore).filter("def_ip <> use_ip").select(*key, F.col("def_ip").alias("src"), F.col("use_ip").alias("dst")).distinct()
    control = control_dependence(instr, key, flow, postdominators(instr, key, back))
    return data.withColumn("kind", F.lit("data")).unionByName(control.withColumn("kind", F.lit("control")))


def backward_slices(depends: DataFrame, seeds: DataFrame, key: list[str], name: str) -> DataFrame:
    """(key, name, node): the instructions on which the seeds (key, name, node) depend by any ways over (key, src, dst), themselves included."""
    return closure(depends.select(*key, F.col("dst").alias("src"), F.col("src").alias("dst")), seeds, key, name)


def statements(slices: DataFrame, places: DataFrame, key: list[str]) -> DataFrame:
    """Slices with the places (key, node, statement) of their instructions, each statement once: (key, ..., statement)."""
    rest = [c for c in slices.columns if c not in (*key, "node")]
    return slices.join(places.hint("merge"), [*key, "node"]).select(*key, *rest, "statement").distinct()
