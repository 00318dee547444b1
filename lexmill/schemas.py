"""Declared entities: their schemas, constraints and published descriptions."""

from __future__ import annotations

import json
from pathlib import Path

from pyspark.sql import types as T

from lexmill.operators.quality import Constraint

_LISTS = "validation_rules array<string>, technical_details array<string>"
_TAIL = "last_updated string, token_count int, crawl_freq string"

# Entities with their required fields before the bar and their optional ones behind it.
_ENTITIES = {
    "LawSection": (
        "law_id string, section_id string, section_label string, path string, heading string, text_plain string, source_url string, sha256 string, domain string, source_type string, publisher string, version string, jurisdiction string, law_title string, chapter string, chapter_no string",
        "effective_from string, effective_to string, section_no string, subsection_no string, paragraph_no string, text_length int, word_count int, has_citations boolean, has_amendments boolean, is_current boolean, " + _TAIL,
    ),
    "VatRate": ("rate_id string, rate_label string, rate_value double, description string, effective_from string, source_url string, sha256 string, domain string, source_type string, publisher string", "effective_to string, jurisdiction string, " + _TAIL),
    "SpecNode": ("node_id string, node_path string, node_label string, node_level int, description string, source_url string, sha256 string, publisher string", f"parent_id string, data_type string, cardinality string, example_value string, {_LISTS}, domain string, source_type string, version string, jurisdiction string, " + _TAIL),
    "AmeldingRule": ("rule_id string, category string, subcategory string, field_id string, field_label string, description string, source_url string, sha256 string, publisher string, version string", "data_type string, cardinality string, validation_rules array<string>, example_value string, domain string, source_type string, jurisdiction string, " + _TAIL),
    "QualityReport": ("overall_score double, completeness_score double, consistency_score double, accuracy_score double, timeliness_score double, total_records int, valid_records int, assessment_date string", "issues array<string>, recommendations array<string>"),
    "SilverMetadata": ("dataset_name string, version string, created_at string, total_files int, total_records int, domains array<string>, source_types array<string>, publishers array<string>, quality_score double", ""),
    "ChartOfAccountsEntry": ("account_id string, account_label string, account_class string, account_class_label string, description string, account_type string, normal_balance string", "account_group string, account_group_label string, is_standard boolean, is_active boolean, examples array<string>, related_vat_codes array<string>, source_standard string, jurisdiction string, last_updated string"),
    "BusinessRule": ("rule_id string, rule_name string, description string, category string, domain string, conditions array<struct<field:string,operator:string,value:string>>, actions array<struct<type:string,value:string>>, source_ids array<string>", "priority int, is_active boolean, citations array<string>, examples array<struct<description:string,input:string,output:string>>, valid_from string, valid_to string, jurisdiction string, created_at string, last_updated string"),
    "RuleExample": ("description string, input string, output string", ""),
    "GoldMessage": ("role string, content string", ""),
    "GoldTrainingSample": ("messages array<struct<role:string,content:string>>, metadata struct<domain:string,task:string,source_ids:array<string>,locale:string,split:string,rule_ids:array<string>,conversation_type:string,turns:int,created_at:string>", ""),
}
# Closed sets of values.
_ENUMS = {
    "ChartOfAccountsEntry": {"account_class": [str(i) for i in range(1, 9)], "account_class_label": ["Eiendeler", "Egenkapital og gjeld", "Inntekter", "Kostnader", "Finansposter"], "account_type": ["asset", "liability", "equity", "income", "expense"], "normal_balance": ["debit", "credit"]},
    "BusinessRule": {"category": ["expense", "income", "vat_calculation", "posting_logic", "transfer"], "domain": ["tax", "accounting", "reporting", "payroll"]},
    "GoldMessage": {"role": ["system", "user", "assistant"]},
}
_MORE = {
    "ChartOfAccountsEntry": [Constraint("account_id", "regex", r"^\d{4}$")],
    "BusinessRule": [Constraint("source_ids", "min_size", 1)],
    "GoldMessage": [Constraint("content", "min_length", 1)],
    "GoldTrainingSample": [Constraint("messages", "min_size", 2), Constraint("metadata.source_ids", "min_size", 1)],
}


def schema(entity: str) -> T.StructType:
    """An entity's schema; required fields aren't nullable."""
    needed, optional = (T.StructType.fromDDL(x) if x else T.StructType() for x in _ENTITIES[entity])
    return T.StructType([T.StructField(f.name, f.dataType, False) for f in needed] + list(optional))


def constraints(entity: str) -> list[Constraint]:
    """What a row of an entity has to meet."""
    out = [Constraint(f.name, "required") for f in schema(entity) if not f.nullable]
    out += [Constraint(field, "enum", values) for field, values in _ENUMS.get(entity, {}).items()]
    return out + _MORE.get(entity, [])


def entities() -> list[str]:
    return list(_ENTITIES)


_JSON = {"string": "string", "integer": "integer", "double": "number", "boolean": "boolean"}


def _json_type(kind: T.DataType) -> dict:
    if isinstance(kind, T.ArrayType):
        return {"type": "array", "items": _json_type(kind.elementType)}
    if isinstance(kind, T.StructType):
        return {"type": "object", "properties": {f.name: _json_type(f.dataType) for f in kind}}
    return {"type": _JSON[kind.typeName()]}


def json_schema(entity: str) -> dict:
    """An entity as JSON Schema, with its constraints."""
    own = schema(entity)
    made = {"title": entity, "type": "object", "properties": {f.name: _json_type(f.dataType) for f in own}, "required": [f.name for f in own if not f.nullable]}
    for k in constraints(entity):
        at = made["properties"].get(k.field)
        if at is not None and k.kind != "required":
            at[{"enum": "enum", "regex": "pattern", "min_size": "minItems", "min_length": "minLength"}[k.kind]] = k.arg
    return made


def export(folder: str) -> int:
    """Writes a file per entity; returns how many."""
    target = Path(folder)
    target.mkdir(parents=True, exist_ok=True)
    for name in entities():
        (target / f"{name}.schema.json").write_text(json.dumps(json_schema(name), indent=2, ensure_ascii=False), encoding="utf-8")
    return len(_ENTITIES)
