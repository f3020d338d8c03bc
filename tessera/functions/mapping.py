"""Canonical names by a rule table instead of a CASE chain.

Rules are rows ``(stage, value, output)``: ``pre`` rules match the name as it is, then the
name is lowered, then ``post`` rules match.  They are kept as a versioned table, one
partition a stage, so a run can name the version it used.  Rules of any number are applied
by an equi-join each stage (broadcast while they are measured to be small), and checked by
joins too."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators.joins import bounded_broadcast
from tessera.sinks.versioned import VersionedTable

STAGES = ("pre", "post")
SCHEMA = "stage string, value string, output string"


class BadRules(ValueError):
    pass


def rule_rows(spark: SparkSession, pre: dict | None = None, post: dict | None = None) -> DataFrame:
    """Rules given in code, as rows."""
    rows = [(stage, v, o) for stage, rules in zip(STAGES, (pre or {}, post or {})) for v, o in rules.items()]
    return spark.createDataFrame(rows, SCHEMA)


def check_rules(rules: DataFrame) -> None:
    """Raise ``BadRules`` if a value has two rules in a stage, a stage is unknown, a value or
    output is null, or a rule's output is another rule's input (a chain, whose result would
    hang on the order of the rules).  A rule may give its own value."""
    odd = rules.where(~F.coalesce(F.col("stage").isin(*STAGES), F.lit(False)) | F.col("value").isNull() | F.col("output").isNull()).first()
    if odd:
        raise BadRules(f"not a rule: {odd}")
    twice = rules.groupBy("stage", "value").agg(F.count(F.lit(1)).alias("n")).where("n > 1").first()
    if twice:
        raise BadRules(f"{twice['n']} {twice['stage']} rules for {twice['value']!r}")
    outputs = rules.where("output <> value").select("stage", F.col("output").alias("value"), F.col("value").alias("source"))
    inputs = rules.where("output <> value").select("stage", "value")
    chain = outputs.join(inputs, ["stage", "value"]).first()
    if chain:
        raise BadRules(f"the {chain['stage']} rule for {chain['source']!r} gives {chain['value']!r}, which has a rule too")


class RuleTable:
    """Versions of a rule table."""

    def __init__(self, spark: SparkSession, root: str):
        self.table = VersionedTable(spark, root)

    def replace(self, rules: DataFrame) -> int:
        """Check the rules and make them the newest version; returns its number."""
        check_rules(rules)
        return self.table.overwrite(rules.select("stage", "value", "output"), ["stage"])

    def rules(self, version: int | None = None) -> DataFrame:
        return self.table.read(version).select("stage", "value", "output")


def canonicalise_by_rules(df: DataFrame, column: str, rules: DataFrame, out: str | None = None) -> DataFrame:
    """``df`` with ``out`` (default: ``column`` itself): its name by the pre rules, lowered,
    then by the post rules; a name without a rule is kept, null stays null.

    Rules too many to broadcast are joined by a shuffle, in which the engine's skew handling
    splits a very frequent name; a name has one rule, so no row is multiplied."""
    name, result = "__tessera_name", "__tessera_output"
    target = out or column
    work = df.withColumn(name, F.col(f"`{column}`"))
    for stage in STAGES:
        own = rules.where(F.col("stage") == stage).select(F.col("value").alias(name), F.col("output").alias(result))
        side, _ = bounded_broadcast(own)
        named = F.coalesce(F.col(result), F.col(name))
        work = work.join(side, name, "left").withColumn(name, F.lower(named) if stage == "pre" else named).drop(result)
    kept = [F.col(f"`{c}`") if c != target else F.col(name).alias(target) for c in df.columns]
    return work.select(*kept, *([] if target in df.columns else [F.col(name).alias(target)]))
