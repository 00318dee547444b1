"""Seed tables: the chart of accounts, the business rules, standard rates and templates."""

from __future__ import annotations

import json
from functools import cache
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

RESOURCES = Path(__file__).parent.parent / "resources"

ACCOUNTS = (
    "account_id string, account_label string, account_class string, account_class_label string, account_group string, account_group_label string, "
    "description string, account_type string, normal_balance string, examples array<string>, related_vat_codes array<string>"
)
#: Values of conditions are of several types, so they are kept as JSON text and read as variants.
RULES = (
    "rule_id string, rule_name string, description string, category string, domain string, priority int, is_active boolean, "
    "conditions array<struct<field:string,operator:string,value:string>>, actions array<struct<type:string,value:string>>, "
    "source_ids array<string>, citations array<string>, examples array<struct<description:string,input:string,output:string>>, valid_from string, valid_to string"
)
TEMPLATES = "template_id string, system string, turns array<struct<user:string,assistant:string>>, ord int"


@cache
def _lines(name: str) -> tuple[str, ...]:
    return tuple(x for x in (RESOURCES / name).read_text(encoding="utf-8").split("\n") if x and not x.startswith("#"))


def accounts(spark: SparkSession) -> DataFrame:
    """The standard chart of accounts."""
    rows = []
    for line in _lines("chart_of_accounts.txt"):
        *texts, examples, codes = (x.strip() for x in line.split("|"))
        rows.append((*texts, *([x for x in part.split("; ") if x] for part in (examples, codes))))
    made = spark.createDataFrame(rows, ACCOUNTS)
    return made.withColumns({"is_standard": F.lit(True), "is_active": F.lit(True), "source_standard": F.lit("NS 4102"), "jurisdiction": F.lit("NO"), "last_updated": F.current_timestamp().cast("string")})


def business_rules(spark: SparkSession) -> DataFrame:
    """The business rules; ``value`` and the examples' input and output are JSON texts."""
    rows = []
    for line in _lines("business_rules.jsonl"):
        r = json.loads(line)
        as_json = lambda x: json.dumps(x, ensure_ascii=False)
        rows.append(
            (
                *(r.get(c) for c in ("rule_id", "rule_name", "description", "category", "domain")),
                r.get("priority", 100),
                r.get("is_active", True),
                [(c["field"], c["operator"], as_json(c["value"])) for c in r["conditions"]],
                [(a["type"], as_json(a["value"])) for a in r["actions"]],
                r["source_ids"],
                r.get("citations", []),
                [(e["description"], as_json(e["input"]), as_json(e["output"])) for e in r.get("examples", [])],
                r.get("valid_from"),
                r.get("valid_to"),
            )
        )
    return spark.createDataFrame(rows, RULES)


def templates(spark: SparkSession) -> DataFrame:
    """The conversation templates, in order."""
    found = [json.loads(x) for x in _lines("templates.jsonl")]
    return spark.createDataFrame([(t["template_id"], t["system"], [(u["user"], u["assistant"]) for u in t["turns"]], i) for i, t in enumerate(found)], TEMPLATES)


# The standard VAT rates, for use without a rates page.
_RATES = (("standard", "25%", 25.0, "Standard VAT rate: 25%"), ("lav", "15%", 15.0, "Reduced VAT rate: 15%"), ("lav", "12%", 12.0, "Reduced VAT rate: 12%"), ("null", "0%", 0.0, "Zero VAT rate: 0%"))


def standard_rates(spark: SparkSession) -> DataFrame:
    made = spark.createDataFrame(list(_RATES), "kind string, value string, percentage double, description string")
    return made.withColumns({"valid_from": F.lit("2024-01-01"), "valid_to": F.lit(None).cast("string"), "source_url": F.lit("https://www.skatteetaten.no/satser/merverdiavgift/"), "sha256": F.lit("")})
