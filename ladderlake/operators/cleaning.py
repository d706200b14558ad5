"""The cleaning funnel over code records: repair, rules, parser; its outputs by input file and status, and its counters."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import code as C
from . import programs as P


def funneled(records: DataFrame, code: str = "code") -> DataFrame:
    """records with the repaired code, quality (empty, basic_error, syntax_error, golden), error and was_repaired. Text that fails the rules isn't parsed. Works on streams, too: row by row, without a shuffle."""
    fixed = C.auto_repair(F.col(code))
    r = records.select(*[c for c in records.columns if c not in (code, "quality", "error", "was_repaired")], F.col(code).alias("_given"), fixed.alias(code))
    rule = C.fast_validate(F.col(code))
    r = r.withColumn("_rule", F.when(F.col(code) == "", "No code found").when(rule != "Passed", rule))
    checked = P.checked(r, [*r.columns], F.when(F.col("_rule").isNull(), F.col(code)))
    quality = F.when(F.col(code) == "", "empty").when(F.col("_rule").isNotNull(), "basic_error").when(F.col("_fault").isNotNull(), "syntax_error").otherwise("golden")
    return checked.withColumn("quality", quality).withColumn("error", F.coalesce("_rule", "_fault")).withColumn("was_repaired", ~F.col(code).eqNullSafe(F.col("_given"))).drop("_given", "_rule", "_fault")


def counters(cleaned: DataFrame, file: str = "src_stem") -> DataFrame:
    """One row: files with records, samples, and samples of each status."""
    status = ["golden", "syntax_error", "basic_error", "empty"]
    return cleaned.agg(F.count_distinct(file).alias("processed_files"), F.count("*").alias("total_samples"), *(F.count_if(F.col("quality") == s).alias(s) for s in status))


def with_variants(records: DataFrame, key: str, code: str = "output", variants: int = 3, seed: int = 0) -> DataFrame:
    """Every record as it is (is_augmented false), and next to it its variants (true) that differ from it."""
    made = P.augment(records.withColumnRenamed(code, "code"), key, [c if c != code else "code" for c in records.columns], variants, seed)
    made = made.select(*[F.col("augmented" if c == code else c).alias(c) for c in records.columns], F.lit(True).alias("is_augmented"))
    return records.withColumn("is_augmented", F.lit(False)).unionByName(made)


def variant_counters(augmented: DataFrame, parsed: DataFrame) -> DataFrame:
    """One row: originals, variants, originals that don't parse (parsed: status of each), and the total."""
    n = augmented.agg(F.count_if(~F.col("is_augmented")).alias("total_original"), F.count_if("is_augmented").alias("total_augmented"), F.count("*").alias("total"))
    return n.withColumn("parse_errors", F.lit(parsed.filter("status = 'fail'").count()))
