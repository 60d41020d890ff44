"""Checks of tables and rows (Q1-Q8)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def validate(df: DataFrame, schema: T.StructType, required: list[str], dates: list[str] = (), column: str = "payload") -> tuple[DataFrame, DataFrame]:
    """Q1: JSON payloads parsed by schema; valid rows, and rejected ones with all their reasons.

    Required fields (dotted paths) must be present and not empty, date fields ISO dates if present.
    """
    parsed = df.withColumn("parsed", F.from_json(column, schema, {"mode": "PERMISSIVE"}))
    raw = {p: F.get_json_object(column, f"$.{p}") for p in {*required, *dates}}
    checks: list[Column] = [F.when(~F.coalesce(F.is_valid_json(column) if hasattr(F, "is_valid_json") else F.try_parse_json(column).isNotNull(), F.lit(False)), "not JSON")]
    checks += [F.when(F.coalesce(raw[p], F.lit("")) == "", f"missing {p}") for p in required]
    checks += [F.when(raw[p].isNotNull() & (raw[p] != "") & F.try_to_date(raw[p], "yyyy-MM-dd").isNull(), f"not a date: {p}") for p in dates]
    checked = parsed.withColumn("reasons", F.filter(F.array(*checks), lambda r: r.isNotNull()))
    return checked.where(F.size("reasons") == 0).drop("reasons"), checked.where(F.size("reasons") > 0).drop("parsed")


def extractor_schema(schema: T.StructType, without: str = "metadata") -> T.StructType:
    """Q2: the schema an extractor fills in: without authoritative metadata."""
    return T.StructType([f for f in schema if f.name != without])


def validate_config(cfg: DataFrame) -> DataFrame:
    """Q3: whether each schedule has five cron fields (null: none wanted)."""
    field = r"[\d*/,\-A-Za-z]+"
    return cfg.withColumn("cron_ok", F.coalesce(F.trim("cron").rlike(rf"^{field}(?:\s+{field}){{4}}$"), F.lit(True)))


def flag_review(rec: DataFrame, flagged: DataFrame, now: Column) -> DataFrame:
    """Q4: records flagged for review with a reason; flagged has (id, reason)."""
    f = flagged.select("id", F.col("reason").alias("f_reason"))
    hit = F.col("f_reason").isNotNull()
    new = {"requires_human_review": F.when(hit, True).otherwise(F.col("requires_human_review")), "review_reason": F.coalesce("f_reason", "review_reason"), "updated_at": F.when(hit, now).otherwise(F.col("updated_at"))}
    return rec.join(f, "id", "left").select(*[new[c].alias(c) if c in new else F.col(c) for c in rec.columns])


def rejects(attempted: DataFrame, done: DataFrame, reason: str) -> DataFrame:
    """Q5: attempted ids without a result."""
    return attempted.select("id").join(done.select("id"), "id", "left_anti").withColumn("reason", F.lit(reason))


def check_keys(tables: dict[str, tuple[DataFrame, list[str]]]) -> DataFrame:
    """Q6: (table, n_duplicates): keys that occur more than once; null keys don't count."""
    def one(name: str, df: DataFrame, keys: list[str]) -> DataFrame:
        return df.dropna(subset=keys).groupBy(*keys).count().agg(F.lit(name).alias("table_name"), F.count_if(F.col("count") > 1).alias("n_duplicates"))

    return reduce(DataFrame.unionAll, [one(n, *x) for n, x in tables.items()])


def check_refs(links: dict[str, tuple[DataFrame, str, DataFrame, str]]) -> DataFrame:
    """Q7: (link, n_missing): rows whose reference has no row."""
    def one(name: str, child: DataFrame, column: str, parent: DataFrame, key: str) -> DataFrame:
        missing = child.where(F.col(column).isNotNull()).select(F.col(column).alias("ref")).join(parent.select(F.col(key).alias("ref")), "ref", "left_anti")
        return missing.agg(F.lit(name).alias("link"), F.count("*").alias("n_missing"))

    return reduce(DataFrame.unionAll, [one(n, *x) for n, x in links.items()])


def validate_enquiries(df: DataFrame) -> DataFrame:
    """Q8: the first thing wrong with an enquiry (name, email, message), or null."""
    empty = lambda c: F.coalesce(F.trim(c), F.lit("")) == ""
    wrong = F.when(empty("name"), "name is required").when(empty("email"), "email is required").when(~F.trim("email").rlike(r"^[^@\s]+@[^@\s]+\.[^@\s]+$"), "email is invalid").when(empty("message"), "message is required")
    return df.withColumn("problem", wrong)
