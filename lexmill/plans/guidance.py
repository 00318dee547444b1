"""Reporting rules from the blocks of guidance pages and forms."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexmill.functions import extract as X
from lexmill.functions.text import any_of, filled
from lexmill.plans.rates import _BLOCK_COLUMNS
from lexmill.plans.saft import MIN_CONTENT, MIN_ITEM, NAVIGATION, row_entries, row_text


def _none() -> Column:
    return F.array().cast("array<string>")


def _rules(rows: DataFrame, kept: list[str], page: list[str], name: str, **columns: Column) -> DataFrame:
    """Rules of one kind, numbered in the order of the page."""
    made = {
        "title": F.lit(""),
        "description": F.col("text"),
        "category": F.lit("general_guidance"),
        "applies_to": _none(),
        "requirements": _none(),
        "examples": _none(),
        "technical_details": _none(),
        "validation_rules": _none(),
        "field_mappings": F.create_map().cast("map<string,string>"),
        "business_rules": _none(),
        "priority": F.lit("medium"),
        "complexity": F.lit("low"),
    } | columns
    number = F.expr(f"row_number() over (partition by {', '.join(f'`{c}`' for c in page)} order by ord, part)")
    rows = rows.withColumn("__n", number)
    return rows.select(*kept, F.lit(name).alias("kind"), "ord", F.format_string(f"amelding_{name}_%03d", "__n").alias("rule_id"), *(c.alias(n) for n, c in made.items()))


def overview_rules(blocks: DataFrame, page: list[str]) -> DataFrame:
    """Rules of headings, lists, tables, forms and links; ``page`` identifies a page."""
    kept = [c for c in blocks.columns if c not in _BLOCK_COLUMNS]
    heads = blocks.where("kind = 'heading'").withColumn("text", F.col("text_plain"))
    heads = heads.where((F.length("text") > MIN_CONTENT) & ~any_of("heading", *NAVIGATION)).withColumns({"category": X.guidance_category("heading", "text"), "details": X.technical_details("text", with_standard=False)})
    out = _rules(
        heads, kept, page, "heading", title=F.col("heading"), category=F.col("category"), applies_to=X.guidance_applies_to("category"), requirements=X.guidance_requirements("text", "category"), examples=X.examples("text"),
        technical_details=F.col("details"), validation_rules=X.checks("text"), field_mappings=X.field_mappings("text"), business_rules=X.business_rules("text", with_demands=False), priority=X.guidance_priority("category"), complexity=X.guidance_complexity("text", "details"),
    )
    items = blocks.where("kind = 'list_item'").where((F.length("text") > MIN_ITEM) & any_of("context", "a-melding", "rapportering", "skjema", "frist", "krav")).withColumn("category", X.guidance_category("text", "context"))
    title = F.concat(F.lit("Regel "), (F.col("part") + 1).cast("string"), F.lit(": "), F.substring("text", 1, 50), F.lit("..."))
    out = out.unionByName(_rules(items, kept, page, "list", title=title, category=F.col("category"), applies_to=X.guidance_applies_to("category"), requirements=X.guidance_requirements("text", "category"), technical_details=X.technical_details("text", with_standard=False), priority=X.guidance_priority("category")))
    rows = blocks.where("kind = 'table_row' and part > 0 and size(cells) >= 2").withColumn("entries", row_entries()).where(any_of(row_text(F.col("entries")), "a-melding", "rapportering", "skjema"))
    rows = rows.withColumn("text", F.array_join(F.transform("entries", lambda p: F.concat(p["k"], F.lit(": "), p["v"])), " | "))
    first = F.get("entries", F.lit(0))["v"]
    out = out.unionByName(_rules(rows, kept, page, "table", title=F.concat(F.lit("Tabellregel: "), F.substring(first, 1, 30), F.lit("...")), category=F.lit("data_structure"), applies_to=F.array(F.lit("A-melding data")), requirements=X.requirements("text"), complexity=F.lit("medium")))
    fields = _named(blocks.where("kind = 'form_field'").where(any_of("context", "a-melding", "rapportering", "skjema")))
    fields = fields.withColumn("text", F.concat(F.lit("Felt '"), "name", F.lit("' av type '"), "type", F.when(F.col("needed"), "' (påkrevd)").otherwise("' (valgfri)")))
    said = F.concat(F.lit("Felt "), "name", F.when(F.col("needed"), " må fylles ut").otherwise(" er valgfri"))
    out = out.unionByName(_rules(fields, kept, page, "form", title=F.concat(F.lit("Skjemafelt: "), "name"), category=F.lit("form_guidance"), applies_to=F.array(F.lit("A-melding skjema")), requirements=F.array(said), priority=F.when(F.col("needed"), "high").otherwise("medium")))
    links = blocks.where("kind = 'link'").where(any_of("text", "a-melding", "rapportering", "skjema", "veiledning", "regel"))
    links = links.withColumns({"link": F.col("text"), "text": F.coalesce("context", "text")}).withColumn("category", X.guidance_category("link", "text"))
    return out.unionByName(_rules(links, kept, page, "link", title=F.concat(F.lit("Lenkeregel: "), "link"), category=F.col("category"), applies_to=X.guidance_applies_to("category"), requirements=X.guidance_requirements("text", "category")))


def _named(rows: DataFrame) -> DataFrame:
    get = lambda key, default="": F.coalesce(F.element_at("attrs", key), F.lit(default))
    return rows.withColumns({"name": get("name"), "type": get("type", "text"), "needed": F.element_at("attrs", F.lit("required")).isNotNull(), "pattern": get("pattern"), "most": get("maxlength"), "least": get("minlength")}).where("name <> ''")


# Strings that make their element a rule, with the rule's kind, title, category, reach, priority and complexity.
_HITS = (
    ("validation", "validering|valider|gyldig|ugyldig|feil|error", "Valideringsregel", "form_guidance", "A-melding data", "high", "medium"),
    ("submission", "frist|deadline|innlever|submission|måned|år", "Innleveringsregel", "submission_deadlines", "A-melding innlevering", "high", "low"),
    ("business", "beregn|kalkuler|formel|regel|logikk", "Forretningsregel", "business_logic", "A-melding beregninger", "high", "high"),
)


def form_rules(blocks: DataFrame, page: list[str], every_field: bool = False) -> DataFrame:
    """Rules of form fields, and of strings that speak of checks, deadlines and calculations.

    A field gives a rule only if it has a least length, unless ``every_field``.
    """
    kept = [c for c in blocks.columns if c not in _BLOCK_COLUMNS]
    fields = _named(blocks.where("kind = 'field'"))
    said = F.array_compact(
        F.array(
            F.when(F.col("needed"), F.concat(F.lit("Felt "), "name", F.lit(" er påkrevd"))),
            F.when(F.col("pattern") != "", F.concat(F.lit("Felt "), "name", F.lit(" må matche mønster: "), "pattern")),
            F.when(F.col("most") != "", F.concat(F.lit("Felt "), "name", F.lit(" kan maksimalt ha "), "most", F.lit(" tegn"))),
            F.when(F.col("least") != "", F.concat(F.lit("Felt "), "name", F.lit(" må ha minst "), "least", F.lit(" tegn"))),
        )
    )
    fields = fields.withColumns({"said": said, "text": F.coalesce("text", F.concat(F.lit("Felt "), "name"))})
    details = F.array(F.concat(F.lit("Type: "), "type"), F.concat(F.lit("Navn: "), "name"))
    rows = fields if every_field else fields.where("least <> ''")
    out = _rules(rows, kept, page, "field", title=F.concat(F.lit("Skjemafelt: "), "name"), category=F.lit("form_guidance"), applies_to=F.array(F.lit("A-melding skjema"), F.concat(F.lit("Felt "), "name")), requirements=F.col("said"), technical_details=details, validation_rules=F.col("said"), priority=F.when(F.col("needed"), "high").otherwise("medium"))
    for name, pattern, title, category, reach, priority, complexity in _HITS:
        hits = blocks.where("kind = 'string'").where(filled("raw").rlike(pattern) & (F.length("text") > MIN_CONTENT))
        out = out.unionByName(_rules(hits, kept, page, name, title=F.concat(F.lit(f"{title}: "), F.substring("text", 1, 50), F.lit("...")), category=F.lit(category), applies_to=F.array(F.lit(reach)), requirements=X.requirements("text"), priority=F.lit(priority), complexity=F.lit(complexity)))
    return out


def silver(rules: DataFrame) -> DataFrame:
    """Rules with the fields that the declared schema asks for."""
    return rules.withColumns({"subcategory": F.col("kind"), "field_id": F.col("rule_id"), "field_label": F.col("title"), "version": F.lit("current"), "domain": F.lit("reporting"), "source_type": F.lit("guidance"), "jurisdiction": F.lit("NO"), "publisher": F.lit("Skatteetaten"), "is_current": F.lit(True), "last_updated": F.current_timestamp().cast("string")})
