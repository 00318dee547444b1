"""Checks: constraints of entities, quality scores, duplicate keys, coverage and references."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexmill.functions.scoring import quality_score
from lexmill.functions.text import filled, is_sha256, is_url, token_count
from lexmill.operators.profile import missing

REQUIRED = ("source_url", "sha256", "domain", "publisher")
DOMAINS = ("tax", "accounting", "reporting")
SHOWN = 5


def _present(rows: DataFrame, column: str) -> Column:
    return ~missing(rows, column)


def issue_counts(rows: DataFrame) -> DataFrame:
    """(records, missing, bad_urls, bad_hashes, bad_domains) in one pass."""
    bad = lambda c, test: F.count_if(_present(rows, c) & ~test(F.col(c))) if c in rows.columns else F.lit(0).cast("long")
    return rows.agg(
        F.count(F.lit(1)).alias("records"),
        F.coalesce(F.sum(sum((missing(rows, c).cast("int") for c in REQUIRED), F.lit(0))), F.lit(0)).cast("long").alias("missing"),
        bad("source_url", is_url).alias("bad_urls"),
        bad("sha256", is_sha256).alias("bad_hashes"),
        bad("domain", lambda c: c.isin(*DOMAINS)).alias("bad_domains"),
    )


def first_missing(rows: DataFrame, order: str, shown: int = SHOWN) -> DataFrame:
    """(ord, field) of the first missing required fields, by row, then field; ``order`` numbers rows from 0."""
    gaps = F.array_compact(F.array(*(F.when(missing(rows, c), F.struct(F.lit(i).alias("i"), F.lit(c).alias("field"))) for i, c in enumerate(REQUIRED))))
    found = rows.select(F.col(order).alias("ord"), F.explode(gaps).alias("g"))
    return found.orderBy("ord", "g.i").limit(shown).select("ord", "g.field")


def assess(rows: DataFrame, order: str) -> DataFrame:
    """One row: is_valid, quality_score, issues, recommendations, total_records."""
    gaps = first_missing(rows, order)
    listed = gaps.agg(F.transform(F.array_sort(F.collect_list(F.struct("ord", "field"))), lambda g: F.concat(F.lit("Record "), g["ord"].cast("string"), F.lit(" missing "), g["field"])).alias("gaps"))
    one = issue_counts(rows).join(F.broadcast(listed))
    kinds = (("bad_urls", "invalid URLs", "Fix invalid URLs"), ("bad_hashes", "invalid SHA256 hashes", "Fix invalid SHA256 hashes"), ("bad_domains", "invalid domains", "Use valid domains: tax, accounting, reporting"))
    found = F.array_compact(F.array(*(F.when(F.col(c) > 0, F.concat(F.lit("Found "), F.col(c).cast("string"), F.lit(f" {said}"))) for c, said, _ in kinds)))
    advice = F.array_compact(F.array(F.when(F.size("gaps") > 0, F.lit("Fill in missing required fields")), *(F.when(F.col(c) > 0, F.lit(said)) for c, _, said in kinds)))
    out = one.withColumns({"issues": F.concat("gaps", found), "advice": advice})
    out = out.withColumn("quality_score", F.when(F.col("records") > 0, quality_score(F.size("issues"), "records")).otherwise(0.0))
    usual = F.when(F.col("quality_score") >= 8, "Data quality is good").when(F.col("quality_score") >= 6, "Data quality is acceptable with minor improvements needed").otherwise("Data quality needs significant improvement")
    empty = F.col("records") == 0
    return out.select(
        (~empty & (F.size("issues") == 0)).alias("is_valid"),
        "quality_score",
        F.when(empty, F.array(F.lit("Dataset is empty"))).otherwise(F.col("issues")).alias("issues"),
        F.when(empty, F.array(F.lit("Add data to the dataset"))).when(F.size("advice") > 0, F.col("advice")).otherwise(F.array(usual)).alias("recommendations"),
        F.col("records").alias("total_records"),
    )


def section_issues(rows: DataFrame, least: int = 50, artifacts: bool = True) -> Column:
    """What is wrong with a section, as texts."""
    text = filled("text_plain")
    size = F.length(text)
    tokens = F.coalesce(F.col("token_count"), F.lit(0)) if "token_count" in rows.columns else token_count(text)
    tests = [
        F.when(size < least, F.concat(F.lit("Text too short: "), size.cast("string"), F.lit(f" chars (min: {least})"))),
        F.when(missing(rows, "source_url"), F.lit("Missing source URL")),
        *(F.when(missing(rows, c), F.lit(f"Missing required field: {c}")) for c in ("law_id", "section_id", "domain", "source_type")),
        F.when((tokens == 0) & (size > 0), F.lit("Zero token count for non-empty text")),
    ]
    if artifacts:
        tests.append(F.when(text.contains("🔗") | text.contains("Del paragraf"), F.lit("Contains navigation artifacts")))
    return F.array_compact(F.array(*tests))


# --- constraints ---------------------------------------------------------------------


@dataclass(frozen=True)
class Constraint:
    """``kind``: required, enum, regex, min_size (of an array) or min_length (of a text)."""

    field: str
    kind: str
    arg: object = None


def broken(rows: DataFrame, constraints: list[Constraint]) -> Column:
    """The constraints that a row breaks, as texts; optional fields may be null, columns may be absent."""
    tests = []
    for k in constraints:
        there = k.field.split(".")[0] in rows.columns
        c = F.col(k.field) if there else F.lit(None)
        if k.kind == "required":
            bad, said = c.isNull(), "is required"
        elif not there:
            continue
        elif k.kind == "enum":
            bad, said = ~c.isin(*k.arg), "has an unknown value"
        elif k.kind == "regex":
            bad, said = ~c.rlike(k.arg), f"doesn't match {k.arg}"
        elif k.kind == "min_size":
            bad, said = F.size(c) < k.arg, f"has fewer than {k.arg} entries"
        elif k.kind == "min_length":
            bad, said = F.length(c) < k.arg, f"is shorter than {k.arg}"
        else:
            raise ValueError(k.kind)
        tests.append(F.when(F.coalesce(bad, F.lit(False)), F.lit(f"{k.field} {said}")))
    return F.array_compact(F.array(*tests)) if tests else F.array().cast("array<string>")


def validate(rows: DataFrame, constraints: list[Constraint], order: str, shown: int = SHOWN) -> DataFrame:
    """One row: total, valid, invalid, success_rate and the first errors."""
    marked = rows.select(F.col(order).alias("ord"), broken(rows, constraints).alias("errors"))
    bad = F.size("errors") > 0
    first = marked.where(bad).orderBy("ord").limit(shown).agg(F.transform(F.array_sort(F.collect_list(F.struct("ord", "errors"))), lambda x: F.concat(F.lit("Item "), x["ord"].cast("string"), F.lit(": "), F.array_join(x["errors"], "; "))).alias("errors"))
    one = marked.agg(F.count(F.lit(1)).alias("total"), F.count_if(~bad).alias("valid"), F.count_if(bad).alias("invalid"))
    rate = F.when(F.col("total") > 0, F.col("valid") * 100.0 / F.col("total")).otherwise(0.0)
    return one.join(F.broadcast(first)).select("total", "valid", "invalid", rate.alias("success_rate"), "errors")


# --- keys and references -------------------------------------------------------------


def duplicate_keys(rows: DataFrame, *keys: str) -> DataFrame:
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def uncovered(expected: DataFrame, actual: DataFrame) -> DataFrame:
    """Expected values that don't occur."""
    return expected.subtract(actual)


def dangling(rows: DataFrame, reference: DataFrame, on: dict[str, str]) -> DataFrame:
    """Rows whose key has no counterpart; null keys are no references."""
    (own, other) = next(iter(on.items()))
    there = reference.select(F.col(other).alias(own)).distinct()
    return rows.where(F.col(own).isNotNull()).join(there, own, "left_anti")


def validate_accounts(accounts: DataFrame) -> list[str]:
    """What is wrong with a chart of accounts: equal ids, classes 1 to 8 that don't occur."""
    out = [f"Duplicate account IDs found: {r['account_id']}" for r in duplicate_keys(accounts, "account_id").orderBy("account_id").collect()]
    expected = accounts.sparkSession.createDataFrame([(str(i),) for i in range(1, 9)], "account_class string")
    gaps = [r[0] for r in uncovered(expected, accounts.select("account_class")).orderBy("account_class").collect()]
    return out + ([f"Missing account classes: {', '.join(gaps)}"] if gaps else [])


def validate_rules(rules: DataFrame, least: int = 15) -> list[str]:
    """What is wrong with business rules: equal ids, no sources, domains that don't occur, too few of them."""
    out = [f"Duplicate rule IDs found: {r['rule_id']}" for r in duplicate_keys(rules, "rule_id").orderBy("rule_id").collect()]
    bare = [r["rule_id"] for r in rules.where(F.coalesce(F.size("source_ids"), F.lit(0)) < 1).orderBy("rule_id").limit(SHOWN).collect()]
    out += [f"Rules without source citations: {', '.join(bare)}"] if bare else []
    expected = rules.sparkSession.createDataFrame([(d,) for d in ("tax", "accounting", "payroll")], "domain string")
    gaps = [r[0] for r in uncovered(expected, rules.select("domain")).orderBy("domain").collect()]
    out += [f"Missing rule domains: {', '.join(gaps)}"] if gaps else []
    n = rules.count()
    return out + ([f"Less than {least} rules found, got {n}"] if n < least else [])


def unknown_accounts(rules: DataFrame, accounts: DataFrame) -> DataFrame:
    """(rule_id, account_id) of actions that name an account which isn't in the chart."""
    actions = rules.select("rule_id", F.explode("actions").alias("a")).where(F.col("a.type").isin("set_account", "set_vat_account"))
    named = actions.select("rule_id", F.get_json_object(F.concat(F.lit('{"v":'), F.col("a.value"), F.lit("}")), "$.v").alias("account_id")).where("account_id <> ''")
    return dangling(named, accounts, {"account_id": "account_id"})
