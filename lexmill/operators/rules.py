"""The rule engine: conditions of business rules over transactions.

All conditions of a rule have to hold; of the rules that fit, the one with the smallest
priority number counts, then the smallest id.

``match`` is for a few given rules: they become column expressions, so that every transaction
is judged in one pass without a join.  ``match_table`` is for rules that are a table of any
size: an inverted index has each rule under the fields that it fixes and their values, all at
once, so a transaction meets just the rules whose fixed values are all its own; the other
conditions of these are then checked as data.  Its plan doesn't grow with the rules.
"""

from __future__ import annotations

import json
from functools import reduce

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

OPERATORS = ("equals", "not_equals", "contains", "not_contains", "in", "not_in", "greater_than", "less_than", "greater_equal", "less_equal")
_ACTIONS = {"set_account": ("account", "string"), "set_vat_code": ("vat_code", "string"), "set_vat_rate": ("vat_rate", "double"), "set_vat_account": ("vat_account", "string"), "set_posting_type": ("posting_type", "string"), "set_asset_category": ("asset_category", "string")}


def _value(value: object, kind: T.DataType) -> Column:
    if isinstance(kind, T.StringType):
        return F.lit(str(value).lower() if isinstance(value, bool) else str(value))
    return F.lit(value).try_cast(kind)


def condition(transactions: DataFrame, field: str, operator: str, value: object) -> Column:
    """Whether a transaction meets a condition; a field that is null or not there meets none.

    ``contains`` with a list means any of it, ``not_contains`` none of it.
    """
    if operator not in OPERATORS:
        raise ValueError(f"unknown operator {operator}")
    if field not in transactions.columns:
        return F.lit(False)
    c, kind = F.col(field), transactions.schema[field].dataType
    many = value if isinstance(value, list) else [value]
    if operator in ("equals", "not_equals"):
        held = c == _value(value, kind)
        held = ~held if operator == "not_equals" else held
    elif operator in ("in", "not_in"):
        held = c.isin(*(_value(v, kind) for v in many))
        held = ~held if operator == "not_in" else held
    elif operator in ("contains", "not_contains"):
        text = F.lower(c.cast("string"))
        held = reduce(lambda a, b: a | b, (text.contains(str(v).lower()) for v in many))
        held = ~held if operator == "not_contains" else held
    else:
        number, other = c.try_cast("double"), F.lit(float(value))
        held = {"greater_than": number > other, "less_than": number < other, "greater_equal": number >= other, "less_equal": number <= other}[operator]
    return F.coalesce(held, F.lit(False))


def match(transactions: DataFrame, rules: list[Row], on: str | None = None) -> DataFrame:
    """Adds the matching rule's id, priority and actions, or nulls.

    ``on`` is a date column, against which rules' validity is held.
    """
    fields = T.StructType([T.StructField("priority", T.IntegerType()), T.StructField("rule_id", T.StringType()), *(T.StructField(name, T._parse_datatype_string(kind)) for name, kind in _ACTIONS.values())])
    found = []
    for rule in rules:
        if rule["is_active"] is False:
            continue
        held = [condition(transactions, c["field"], c["operator"], json.loads(c["value"])) for c in rule["conditions"]]
        if on:
            held += [F.col(on) >= F.lit(rule["valid_from"]).cast("date")] if rule["valid_from"] else []
            held += [F.col(on) <= F.lit(rule["valid_to"]).cast("date")] if rule["valid_to"] else []
        actions = {a["type"]: json.loads(a["value"]) for a in reversed(rule["actions"])}
        said = [F.lit(actions.get(kind)).cast(to).alias(name) for kind, (name, to) in _ACTIONS.items()]
        row = F.struct(F.lit(rule["priority"]).cast("int").alias("priority"), F.lit(rule["rule_id"]).alias("rule_id"), *said)
        found.append(F.when(reduce(lambda a, b: a & b, held, F.lit(True)), row))
    best = F.array_min(F.array(*found)) if found else F.lit(None).cast(fields)
    out = transactions.withColumn("__rule", best.cast(fields))
    return out.select(*transactions.columns, *(F.col(f"__rule.{f.name}").alias(f.name) for f in fields))


# --- rules as data -------------------------------------------------------------------------

_BETWEEN = "\x1f"


def _canonical(value: Column, kind: T.DataType) -> Column:
    """A value, given as text, as the text that a column of this type would have."""
    if isinstance(kind, T.StringType):
        return value
    own = value.try_cast(kind)
    return (F.coalesce(own, value.try_cast("double").try_cast(kind)) if isinstance(kind, T.NumericType) else own).cast("string")


def _by_field(field: Column, value: Column, kinds: dict[str, T.DataType]) -> Column:
    out = F.lit(None).cast("string")
    for kind in sorted({k.simpleString() for k in kinds.values()}):
        names = [name for name, k in kinds.items() if k.simpleString() == kind]
        out = F.when(field.isin(*names), _canonical(value, T._parse_datatype_string(kind))).otherwise(out)
    return out


def _checks(kinds: dict[str, T.DataType]) -> Column:
    """Conditions with their values read: as text and as a list of texts of the field's type, in lower case, and as a number."""
    def one(c: Column) -> Column:
        whole = F.concat(F.lit('{"v":'), c["value"], F.lit("}"))
        text = F.get_json_object(whole, "$.v")
        many = F.startswith(F.ltrim(c["value"]), F.lit("["))
        plain = F.when(many, F.from_json(whole, "v array<string>")["v"]).otherwise(F.array(text))
        texts = F.transform(plain, lambda v: _by_field(c["field"], v, kinds))
        return F.struct(
            c["field"].alias("field"),
            F.when(c["operator"].isin(*OPERATORS), c["operator"]).otherwise(F.raise_error(F.concat(F.lit("unknown operator "), F.coalesce(c["operator"], F.lit("null"))))).cast("string").alias("operator"),
            F.get(texts, F.lit(0)).alias("text"),
            texts.alias("texts"),
            F.transform(plain, F.lower).alias("parts"),
            text.try_cast("double").alias("number"),
        )

    return F.transform("conditions", one)


def _action(kind: str) -> Column:
    """The value of a rule's first action of a kind, as text."""
    first = F.get(F.filter("actions", lambda a: a["type"] == kind), F.lit(0))
    return F.get_json_object(F.concat(F.lit('{"v":'), first["value"], F.lit("}")), "$.v")


def index(rules: DataFrame, kinds: dict[str, T.DataType]) -> DataFrame:
    """Active rules by the fields that they fix (``__fields``, ``__key``), with their conditions as data and what they say."""
    said = [_action(kind).try_cast(to).alias(name) for kind, (name, to) in _ACTIONS.items()]
    dates = [(F.col(c) if c in rules.columns else F.lit(None)).cast("string").try_cast("date").alias(c) for c in ("valid_from", "valid_to")]
    own = rules.where(F.coalesce("is_active", F.lit(True))).select(F.col("priority").cast("int").alias("priority"), "rule_id", *said, *dates, _checks(kinds).alias("__checks"))
    fixed = F.array_sort(F.filter("__checks", lambda c: (c["operator"] == "equals") & c["text"].isNotNull()))
    own = own.withColumn("__fixed", fixed)
    join = lambda f: F.array_join(F.transform("__fixed", f), _BETWEEN)
    return own.withColumns({"__fields": F.transform("__fixed", lambda c: c["field"]), "__key": join(lambda c: c["text"])}).drop("__fixed")


def _met(values: Column, c: Column) -> Column:
    """Whether the transaction whose ``values`` are given by field meets a condition."""
    v = F.element_at(values, c["field"])
    low, number = F.lower(v), v.try_cast("double")
    among, holds = F.array_contains(c["texts"], v), F.exists(c["parts"], lambda x: F.contains(low, x))
    tests = {"equals": v == c["text"], "not_equals": v != c["text"], "in": among, "not_in": ~among, "contains": holds, "not_contains": ~holds, "greater_than": number > c["number"], "less_than": number < c["number"], "greater_equal": number >= c["number"], "less_equal": number <= c["number"]}
    return F.coalesce(F.coalesce(*(F.when(c["operator"] == name, test) for name, test in tests.items())), F.lit(False))


def match_table(transactions: DataFrame, rules: DataFrame, row_id: str, on: str | None = None) -> DataFrame:
    """As ``match``, with rules as a table; ``row_id`` tells transactions apart.

    The fields that rules fix are few combinations, of which each transaction has a key each.
    Rules that fix none are checked against all transactions.
    """
    kinds = {f.name: f.dataType for f in transactions.schema if isinstance(f.dataType, T.AtomicType) and f.name != row_id}
    indexed = index(rules, kinds)
    combinations = indexed.agg(F.collect_set("__fields").alias("__all"))  # one row
    values = F.create_map(*(x for name, _ in kinds.items() for x in (F.lit(name), F.col(name).cast("string"))))
    rows = transactions.select(row_id, values.alias("__values"), (F.col(on).cast("date") if on else F.lit(None).cast("date")).alias("__day"))
    keyed = rows.join(F.broadcast(combinations)).select("*", F.explode("__all").alias("__fields")).drop("__all")
    parts = F.transform("__fields", lambda f: F.element_at("__values", f))
    # a null among the values, or a field that isn't there, meets nothing
    keyed = keyed.where(F.forall(parts, lambda p: p.isNotNull())).withColumn("__key", F.array_join(parts, _BETWEEN))
    holds = F.forall("__checks", lambda c: _met(F.col("__values"), c))
    if on:
        holds = holds & F.coalesce(F.col("__day") >= F.col("valid_from"), F.col("valid_from").isNull()) & F.coalesce(F.col("__day") <= F.col("valid_to"), F.col("valid_to").isNull())
    names = ["priority", "rule_id", *(name for name, _ in _ACTIONS.values())]
    found = keyed.join(indexed, ["__fields", "__key"]).where(holds)
    best = found.groupBy(row_id).agg(F.min(F.struct(*names)).alias("__rule"))
    return transactions.join(best, row_id, "left").select(*transactions.columns, *(F.col(f"__rule.{c}").alias(c) for c in names))
