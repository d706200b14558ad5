"""Consistent-hash sharding with virtual nodes and bounded loads.

Shards hold `vnodes` points each on a ring of hashes; a row belongs to the arc before the next point clockwise of its key's
hash. A shard takes at most its bound; what overflows continues clockwise to the next shard that has room. With slack 0 the
bounds are floor and ceil of rows / shards, so counts are at most one apart; with slack e a shard may hold up to
ceil((1 + e) * rows / shards) and fewer rows leave their arc's own shard, so fewer move when a shard is added.

Ids, sizes and hashes are written to the shared folder once. Only counts for each arc (shards * vnodes of them, whatever the
input) meet on the driver. Each row is then placed by its rank in its arc, where rows with equal keys stand side by side, so a
bound parts at most one group of them. Ranks come from counts of cells (arc, part of the arc), so no task ranks a whole
arc. A key with more than a thousandth of the rows (there are at most a thousand of these) has cells of its own, by salts of id and place of reading. Documents
don't move unless `carry` asks for their columns: one shuffle of ids and sizes.

Nulls: a null text has 0 bytes and lies with the empty ones; a null doc_id sorts first. Repeated rows each get a place of their own.
Empty table: empty result. Other columns are ignored, whatever their names; carried ones that are named like a result are left out.
Rings of more than 65,536 points raise an error: take fewer vnodes.
"""

from __future__ import annotations

import hashlib
import json
from bisect import bisect_left

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ._scratch import written

PARTS, SALTS = 4, 64
SPAN = 1 << 31
RESULTS = ("size", "text_crc32", "law", "shard", "slot", "home_shard")
#: Rows of about 40 bytes up to which a table of cells is broadcast.
FEW = 1_000_000


def ring(shards: int, vnodes: int) -> list[tuple[int, int]]:
    """(point, shard) clockwise; points are in [0, SPAN). A shard's points don't depend on how many shards there are."""
    points = {}
    for s in range(shards):
        for v in range(vnodes):
            points.setdefault(int.from_bytes(hashlib.sha256(f"{s}/{v}".encode()).digest()[:8], "big") % SPAN, s)
    return sorted(points.items())


def clockwise(points: list[tuple[int, int]], arc: int, shards: int) -> list[int]:
    """The shards in the order in which a key of the arc tries them."""
    seen: dict[int, None] = {}
    for i in range(len(points)):
        seen.setdefault(points[(arc + i) % len(points)][1])
        if len(seen) == shards:
            break
    return list(seen)


def bounds(rows: int, shards: int, slack: float) -> list[int]:
    if slack <= 0:
        return [rows // shards + (s < rows % shards) for s in range(shards)]
    return [-int(-(1 + slack) * rows // shards)] * shards


def allocate(counts: dict[int, int], points: list[tuple[int, int]], shards: int, slack: float = 0.0) -> list[dict]:
    """Pieces of arcs: rows [lo, hi) by rank in the arc go to the shard, where they begin at slot. First each shard takes of its own arcs what its bound allows, in ring order; then what is left over moves on clockwise."""
    room = bounds(sum(counts.values()), shards, slack)
    filled = [0] * shards
    out, over = [], []

    def take(arc: int, lo: int, n: int, s: int) -> int:
        got = min(n, room[s] - filled[s])
        if got > 0:
            out.append({"arc": arc, "lo": lo, "hi": lo + got, "shard": s, "slot": filled[s]})
            filled[s] += got
        return max(got, 0)

    for arc in sorted(counts):
        got = take(arc, 0, counts[arc], points[arc][1])
        if got < counts[arc]:
            over.append((arc, got, counts[arc] - got))
    for arc, lo, n in over:
        for s in clockwise(points, arc, shards)[1:]:
            got = take(arc, lo, n, s)
            lo, n = lo + got, n - got
            if not n:
                break
    return out


def shard(docs: DataFrame, shards: int = 24, vnodes: int = 64, slack: float = 0.0, id_col: str = "doc_id", text_col: str = "text", key: Column | None = None, carry: bool = False) -> DataFrame:
    """(id_col, size, text_crc32, law, shard, slot, home_shard): every row of docs with its shard, its place in it (from 0 without gaps) and the shard of its arc. key: what is hashed; by default the text, so that equal texts lie together as far as the bounds allow. carry: all columns of docs come along."""
    if shards * vnodes > 1 << 16:
        raise ValueError(f"{shards} shards of {vnodes} points each are more than 65,536 points")
    points = ring(shards, vnodes)
    text = F.col(text_col)
    others = [c for c in docs.columns if c not in (id_col, *RESULTS)] if carry else []
    slim = docs.select(
        F.col(id_col).alias("id"),
        (F.coalesce(F.octet_length(text), F.lit(0)) + 8).cast("long").alias("size"),
        F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("crc"),
        F.pmod(F.xxhash64(F.coalesce(text.cast("string"), F.lit("")) if key is None else key), F.lit(SPAN)).alias("at"),
        F.pmod(F.xxhash64(id_col, F.spark_partition_id()), F.lit(SALTS)).cast("int").alias("salt"),
        *(F.col("`" + c.replace("`", "``") + "`").alias(f"c{i}") for i, c in enumerate(others)),
    )
    slim = written(slim.withColumn("arc", _arc(F.col("at"), [p for p, _ in points])), "placed")
    total = slim.count()
    hot = slim.groupBy("at").agg(F.count("*").alias("n")).filter(F.col("n") * 1000 > total).select("at", F.col("at").alias("hot"))  # at most 999 rows
    slim = slim.join(F.broadcast(hot), "at", "left").withColumn("hot", F.coalesce("hot", F.lit(-1))).withColumn("salt", F.when(F.col("hot") >= 0, F.col("salt")).otherwise(0)).withColumn("part", F.pmod(F.shiftright("at", 3), F.lit(PARTS)).cast("int"))
    cell = ["arc", "part", "hot", "salt"]
    cells = written(slim.groupBy(*cell).agg(F.count("*").alias("n")), "cells")  # at most shards * vnodes * PARTS + 1000 * SALTS rows
    pieces = allocate({r["arc"]: r["n"] for r in cells.groupBy("arc").agg(F.sum("n").alias("n")).collect()}, points, shards, slack)
    small = F.broadcast if cells.count() <= FEW else (lambda df: df)
    before = F.coalesce(F.sum("n").over(W.partitionBy("arc").orderBy("part", "hot", "salt").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    in_cell = W.partitionBy(*cell).orderBy("at", F.col("id").asc_nulls_first(), "crc", "size")
    ranked = slim.withColumn("rank", F.row_number().over(in_cell) - 1).join(small(cells.select(*cell, before.alias("before"))), cell).withColumn("r", F.col("rank") + F.col("before"))
    table = docs.sparkSession.range(1).select(F.explode(F.from_json(F.lit(json.dumps(pieces)), "array<struct<arc:int,lo:bigint,hi:bigint,shard:int,slot:bigint>>")).alias("p"))
    by_arc = table.groupBy(F.col("p.arc").alias("arc")).agg(F.array_sort(F.collect_list(F.struct("p.lo", "p.hi", "p.shard", "p.slot"))).alias("pieces"))  # at most 65,536 rows; `shards` pieces an arc
    mine = F.element_at(F.filter("pieces", lambda p: (F.col("r") >= p["lo"]) & (F.col("r") < p["hi"])), 1)
    homes = F.element_at(F.array(*[F.lit(s) for _, s in points]), F.col("arc") + 1)
    return ranked.join(F.broadcast(by_arc), "arc").withColumn("p", mine).select(
        F.col("id").alias(id_col), *(F.col(f"c{i}").alias(c) for i, c in enumerate(others)), "size", F.col("crc").alias("text_crc32"), F.lit("rows" if slack <= 0 else "bounded").alias("law"), F.col("p.shard").alias("shard"), (F.col("p.slot") + F.col("r") - F.col("p.lo")).cast("long").alias("slot"), homes.cast("int").alias("home_shard")
    )


def _arc(at: Column, edges: list[int]) -> Column:
    """Number of the first point at or after `at`; past the last, 0. A coarse step gives the first candidate, a short scan the rest."""
    steps = 4 * len(edges)
    width = -(-SPAN // steps)
    begins = [bisect_left(edges, k * width) for k in range(steps + 1)]
    longest = max(b - a for a, b in zip(begins, begins[1:])) + 1
    points = F.array(*[F.lit(e) for e in [*edges, *[SPAN] * (longest + 1)]])
    first = F.element_at(F.array(*[F.lit(b) for b in begins]), (F.floor(at / width) + 1).cast("int"))
    near = F.slice(points, first + 1, longest + 1)
    found = first + F.aggregate(near, F.lit(0), lambda n, e: n + F.when(e < at, 1).otherwise(0))
    return F.pmod(found, F.lit(len(edges))).cast("int")


def op4_sharding(spark, sf_dir: str) -> DataFrame:
    """All documents in shards 0 to 23, counts at most one apart."""
    out = shard(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return out.withColumn("grown_shard", F.lit(None).cast("int")).select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard", "home_shard")
