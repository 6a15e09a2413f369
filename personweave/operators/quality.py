"""Data tests, run summary and match quality."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def dq_not_null(df: DataFrame, columns: list[str], table: str = "") -> DataFrame:
    """Rows per rule that break it; all rules of a table in one pass."""
    counts = df.agg(*[F.count(F.when(F.col(c).isNull(), 1)).alias(c) for c in columns])
    rules = [F.struct(F.lit(f"{table}.{c} not null".lstrip(".")).alias("rule"), F.col(c).alias("failures")) for c in columns]
    return counts.select(F.explode(F.array(*rules)).alias("r")).select("r.*")


def dq_unique(df: DataFrame, column: str) -> DataFrame:
    """Values that occur more than once."""
    return (df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n"))
            .where(F.col("n") > 1))


def dq_unique_keys(df: DataFrame, keys: list[str], table: str, by: str | None = None) -> DataFrame:
    """`rule`, `failures`: values of each declared key that occur more than once, within each value of `by` if given."""
    rules = []
    for key in keys:
        name = F.lit(f"{table}.{key} unique") if by is None else F.concat(F.lit(f"{table} "), F.col(by), F.lit(f".{key} unique"))
        counts = df.where(F.col(key).isNotNull()).groupBy(name.alias("rule"), F.col(key).alias("_key")).agg(F.count(F.lit(1)).alias("n"))
        rules.append(counts.groupBy("rule").agg(F.count(F.when(F.col("n") > 1, 1)).alias("failures")))
    return reduce(DataFrame.unionByName, rules)


def check_schema(df: DataFrame, declared: dict[str, bool], source: str) -> DataFrame:
    """`source, field, problem, rows` for missing fields, wrong types, and nulls in fields declared not null."""
    spark, types = df.sparkSession, {f.name: f.dataType for f in df.schema.fields}
    static = [(source, c, "missing", None) for c in declared if c not in types]
    static += [(source, c, f"type {types[c].simpleString()}", None) for c in declared
               if c in types and not isinstance(types[c], T.StringType)]
    found = spark.createDataFrame(static, "source string, field string, problem string, rows long")
    required = [c for c, nullable in declared.items() if not nullable and c in types]
    if not required:
        return found
    nulls = dq_not_null(df, required).where(F.col("failures") > 0).select(
        F.lit(source).alias("source"), F.split_part("rule", F.lit(" "), F.lit(1)).alias("field"),
        F.lit("null").alias("problem"), F.col("failures").alias("rows"))
    return found.unionByName(nulls)


def _side_by_side(parts: list[DataFrame]) -> DataFrame:
    """One-row tables with different columns as one row."""
    names = [c for p in parts for c in p.columns]
    rows = [p.select(*[F.col(c) if c in p.columns else F.lit(None).cast("long").alias(c) for c in names]) for p in parts]
    return reduce(DataFrame.unionByName, rows).agg(*[F.max(c).alias(c) for c in names])


def run_summary(records: DataFrame, golden: DataFrame, failures: DataFrame | None = None) -> DataFrame:
    """One row: inputs, canonicals, merge rate, and health from the data tests (`rule`, `failures`)."""
    parts = [records.agg(F.count(F.lit(1)).alias("input_entities")), golden.agg(F.count(F.lit(1)).alias("canonicals"))]
    if failures is not None:
        parts.append(failures.agg(F.sum("failures").alias("failures")))
    broken = F.lit(0) if failures is None else F.coalesce("failures", F.lit(0))
    return _side_by_side(parts).select(
        F.lit("completed").alias("status"), F.when(broken == 0, "healthy").otherwise("check data").alias("health"),
        "input_entities", "canonicals",
        F.round(1 - F.col("canonicals") / F.col("input_entities"), 6).alias("merge_rate"))


def pair_quality(members: DataFrame, truth: DataFrame, key: str = "rec_id") -> DataFrame:
    """Precision, recall and F1 of record pairs in one entity against pairs of one true person.

    Pairs are counted from group sizes, never listed. `truth` has `key` and `person`.
    """
    both = members.select(key, "entity_id").join(truth.select(key, "person"), key)
    both = both.groupBy("entity_id", "person").agg(F.count(F.lit(1)).alias("n"))

    def pairs(sizes: DataFrame, name: str) -> DataFrame:
        return sizes.agg(F.expr("coalesce(sum(n * (n - 1) div 2), 0L)").alias(name))

    def by(group: str) -> DataFrame:
        return both.groupBy(group).agg(F.sum("n").alias("n"))

    out = _side_by_side([pairs(both, "true_positives"), pairs(by("entity_id"), "predicted"), pairs(by("person"), "actual")])
    hits, predicted, actual = F.col("true_positives"), F.col("predicted"), F.col("actual")
    return out.select(
        "true_positives", "predicted", "actual", F.round(F.try_divide(hits, predicted), 6).alias("precision"),
        F.round(F.try_divide(hits, actual), 6).alias("recall"),
        F.round(F.try_divide(2 * hits, predicted + actual), 6).alias("f1"))
