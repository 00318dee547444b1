"""Classification by ordered key words and extraction by patterns, as column expressions.

Key words are searched as parts of the lower-cased text, not as whole words.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lexmill.functions.text import C, _c, any_of, collapsed, filled, first_match, found_all, validity_dates

# --- VAT rates -----------------------------------------------------------------------

# Key words of categories of rates, tried in this order, with category and kind.
RATE_CATEGORIES = (
    (("næringsmidler", "mat", "food", "kjøtt", "fisk", "grønnsaker"), "food_products", "reduced"),
    (("vann", "avløp", "water", "sewage", "drikkevann"), "water_services", "reduced"),
    (("persontransport", "kinobilletter", "utleie", "transport", "kino", "idrett", "fornøyelse"), "transport_entertainment", "reduced"),
    (("alminnelig", "standard", "generell", "hoved"), "general_goods_services", "standard"),
    (("null", "zero", "fritatt", "unntatt"), "exempt_goods_services", "zero"),
)
# What is said of a rate of each category, around the percentage, and to what it applies.
RATE_TEXTS = {
    "food_products": ("Redusert MVA-sats for næringsmidler: ", "% - gjelder matvarer, drikkevarer og andre næringsmidler", ["Matvarer og drikkevarer", "Næringsmidler for menneskeforbruk", "Råvarer til matproduksjon", "Kjott, fisk, grønnsaker, frukt"]),
    "water_services": ("Redusert MVA-sats for vann- og avløpstjenester: ", "% - gjelder drikkevann, avløpshåndtering og vannforsyning", ["Drikkevann og vannforsyning", "Avløpshåndtering", "Vann- og avløpstjenester", "Renovasjon og avfallshåndtering"]),
    "transport_entertainment": ("Redusert MVA-sats for persontransport og underholdning: ", "% - gjelder persontransport, kinobilletter, hotellrom, idrettsarrangementer", ["Persontransport (buss, tog, fly)", "Kinobilletter og underholdning", "Hotellrom og overnatting", "Idrettsarrangementer og fornøyelsesparker"]),
    "general_goods_services": ("Standard MVA-sats: ", "% - gjelder de fleste varer og tjenester", ["De fleste varer og tjenester", "Generell omsetning", "Standard handel og tjenesteyting"]),
    "exempt_goods_services": ("Null MVA-sats: ", "% - gjelder eksport, enkelte helsetjenester og utdanningslitteratur", ["Eksport av varer og tjenester", "Enkelte helsetjenester", "Utdanningslitteratur", "Fritatte tjenester"]),
}
# Key words of kinds of rates in short texts, in this order.
RATE_KINDS = (
    (("standard", "ordinær", "hoved", "normal"), "standard"),
    (("lav", "reduced", "redusert", "lavere"), "lav"),
    (("null", "zero", "0%", "ingen", "fritatt"), "null"),
    (("høy", "high", "økt", "økning"), "høy"),
    (("mva", "merverdiavgift", "vat"), "mva"),
)
RATE_HEADERS = ("type", "sats", "rate", "kategori", "beskrivelse")
PERCENT = r"(?U)(\d+[,\s]*\d*)\s*%"


def rate_category(c: C) -> Column:
    return first_match([(any_of(c, *words), category) for words, category, _ in RATE_CATEGORIES], "general_goods_services")


def rate_kind(c: C) -> Column:
    return first_match([(any_of(c, *words), kind) for words, _, kind in RATE_CATEGORIES], "standard")


def short_rate_kind(c: C) -> Column:
    return first_match([(any_of(c, *words), kind) for words, kind in RATE_KINDS], "standard")


def rate_description(description: C, percent: C, category: C) -> Column:
    cases = [(_c(category) == name, F.concat(F.lit(before), _c(percent), F.lit(after))) for name, (before, after, _) in RATE_TEXTS.items()]
    return first_match(cases, F.concat(F.lit("MVA-sats: "), _c(percent), F.lit("% - "), collapsed(description)))


def rate_applies_to(category: C) -> Column:
    cases = [(_c(category) == name, F.array(*map(F.lit, said))) for name, (*_, said) in RATE_TEXTS.items()]
    return first_match(cases, F.array(F.lit("Generelle varer og tjenester")))


def rate_exceptions(c: C) -> Column:
    low = F.lower(filled(c))
    pattern = r"(?U)(?:unntatt|bortsett fra)\s+([^.]*)"
    return F.array_compact(
        F.array(
            F.when(low.rlike(pattern), F.trim(F.regexp_extract(low, pattern, 1))),
            F.when(low.contains("alkohol"), F.lit("Alkoholholdige drikkevarer har høyere sats")),
            F.when(low.contains("tobakk"), F.lit("Tobakksvarer har høyere sats")),
            F.when(low.contains("bil") & low.contains("transport"), F.lit("Godstransport har standard sats")),
        )
    )


def rate_notes(c: C) -> Column:
    text, pattern = filled(c), r"(?U)[*]\s*([^.]*)"
    long = F.when(F.length(text) > 100, F.concat(F.lit("Detaljert beskrivelse: "), F.substring(text, 1, 200), F.lit("..."))).otherwise("")
    return F.when(text.rlike(pattern), F.trim(F.regexp_extract(text, pattern, 1))).otherwise(long)


def percent_text(c: C) -> Column:
    """The digits before the first percent sign, with a point for a comma; null without one.

    Digits behind a point are taken alone: "12.5%" gives 5.  ``percent(..., decimal=True)``
    reads them whole.
    """
    found = F.regexp_extract(filled(c), PERCENT, 1)
    return F.when(found != "", F.replace(found, F.lit(","), F.lit(".")))


def percent(c: C, decimal: bool = False) -> Column:
    """The first percentage as a number; null if it can't be read."""
    if decimal:
        found = F.replace(F.regexp_extract(filled(c), r"(\d+(?:[.,]\d+)?)\s*%", 1), F.lit(","), F.lit("."))
        return F.when(found != "", found.try_cast("double"))
    return F.trim(percent_text(c)).try_cast("double")


def rate_of_cells(cells: C) -> Column:
    """(percent_text, percent, description) of a table row's cells: of the first cell with a readable percentage.

    The description is the first cell, or the other cells if the percentage stands in the first.
    """
    cells = _c(cells)
    read = F.transform(
        cells,
        lambda x, i: F.struct(
            percent_text(x).alias("percent_text"),
            percent(x).alias("percent"),
            F.when(i == 0, F.array_join(F.slice(cells, 2, F.greatest(F.size(cells) - 1, F.lit(0))), " ")).otherwise(F.get(cells, F.lit(0))).alias("description"),
        ),
    )
    return F.get(F.filter(read, lambda x: x["percent"].isNotNull()), F.lit(0))


def percent_context(c: C, reach: int = 100) -> Column:
    """The text around the start of the first percentage, ``reach`` characters to either side; null without one."""
    text = filled(c)
    at = F.length(F.regexp_extract(text, r"(?Us)^(.*?)\d+[,\s]*\d*\s*%", 1)) + 1
    start = F.greatest(at - reach, F.lit(1))
    return F.when(text.rlike(PERCENT), F.substring(text, start, at + reach - start))


def rate_of_text(c: C) -> Column:
    """(kind, value, percent, valid_from, valid_to, description) of a short text, or null."""
    text = filled(c)
    kind, dates = short_rate_kind(text), validity_dates(F.array(text))
    said = F.concat(F.initcap(kind), F.lit(" rate: "), percent_text(text), F.lit("%"))
    said = F.when(dates["valid_from"].isNotNull(), F.concat(said, F.lit(" (from "), dates["valid_from"], F.lit(")"))).otherwise(said)
    out = F.struct(kind.alias("kind"), F.concat(percent_text(text), F.lit("%")).alias("value"), percent(text).alias("percent"), dates["valid_from"].alias("valid_from"), dates["valid_to"].alias("valid_to"), said.alias("description"))
    return F.when(percent(text).isNotNull(), out)


# --- specifications ------------------------------------------------------------------

# Patterns of sentences that state something, tried on the lower-cased text.
VALIDATION = (r"må\s+([^.]*)", r"skal\s+([^.]*)", r"påkrevd\s+([^.]*)", r"obligatorisk\s+([^.]*)", r"valider\s+([^.]*)", r"kontroller\s+([^.]*)")
BUSINESS = (r"hvis\s+([^.]*)", r"dersom\s+([^.]*)", r"når\s+([^.]*)", r"regel\s*:?\s*([^.]*)", r"krav\s*:?\s*([^.]*)")
EXAMPLES = (r"eksempel\s*:?\s*([^.]*)", r"for eksempel\s*:?\s*([^.]*)", r"f\.eks\.\s*([^.]*)")
DEPENDENCIES = (r"avhenger\s+av\s+([^.]*)", r"krever\s+([^.]*)", r"må\s+ha\s+([^.]*)", r"forutsetter\s+([^.]*)")
TECHNICAL = (r"format\s*:?\s*([^.]*)", r"type\s*:?\s*([^.]*)", r"lengde\s*:?\s*([^.]*)", r"maksimalt\s*([^.]*)", r"minimalt\s*([^.]*)")
STANDARD = r"standard\s*:?\s*([^.]*)"
REQUIREMENTS = (r"må\s+([^.]*)", r"skal\s+([^.]*)", r"påkrevd\s+([^.]*)", r"obligatorisk\s+([^.]*)", r"krav\s+([^.]*)")
CHECKS = (r"valider\s+([^.]*)", r"kontroller\s+([^.]*)", r"sjekk\s+([^.]*)", r"gyldig\s+([^.]*)")
MAPPINGS = (r"(\w+)\s*→\s*(\w+)", r"(\w+)\s*til\s*(\w+)", r"(\w+)\s*mapper\s*til\s*(\w+)")


def statements(c: C, patterns: tuple[str, ...]) -> Column:
    """What follows each pattern up to the next period, trimmed, pattern after pattern."""
    return F.transform(found_all(F.lower(filled(c)), *(f"(?U){p}" for p in patterns), group=1), lambda x: F.trim(x))


def validation_rules(c: C) -> Column:
    return statements(c, VALIDATION)


def business_rules(c: C, with_demands: bool = True) -> Column:
    return statements(c, BUSINESS if with_demands else BUSINESS[:-1])


def examples(c: C) -> Column:
    """Examples; "for eksempel" is found by the shorter pattern too."""
    return statements(c, EXAMPLES)


def dependencies(c: C) -> Column:
    return statements(c, DEPENDENCIES)


def technical_details(c: C, with_standard: bool = True) -> Column:
    return statements(c, (*TECHNICAL, STANDARD) if with_standard else TECHNICAL)


def requirements(c: C) -> Column:
    return statements(c, REQUIREMENTS)


def checks(c: C) -> Column:
    return statements(c, CHECKS)


def field_mappings(c: C) -> Column:
    """A map of fields to fields; of equal keys the last one counts."""
    low = F.lower(filled(c))
    left, right = (found_all(low, *(f"(?U){p}" for p in MAPPINGS), group=g) for g in (1, 2))
    pairs = F.arrays_zip(left.alias("k"), right.alias("v"))
    last = F.filter(pairs, lambda x, i: F.size(F.filter(F.slice(pairs, i + 2, F.size(pairs)), lambda y: y["k"] == x["k"])) == 0)
    return F.map_from_entries(last)


# Synonyms of cardinalities.
OPTIONAL, ONCE = ("0..1", "0-1", "optional", "valgfri"), ("1..1", "1", "required", "påkrevd")
MANY, ANY = ("1..*", "1+", "one or more", "en eller flere"), ("0..*", "0+", "zero or more", "null eller flere")


def cardinality(c: C) -> Column:
    """The usual form of a cardinality; unknown ones stay, lower-cased."""
    low = F.lower(F.trim(filled(c)))
    cases = [(filled(c) == "", "1"), (low.isin(*OPTIONAL), "0..1"), (low.isin(*ONCE), "1"), (low.isin(*MANY), "1..*"), (low.isin(*ANY), "0..*")]
    return first_match(cases, low)


def document_cardinality(c: C) -> Column:
    """The usual form of a cardinality in documents; unknown ones are once."""
    text = F.trim(filled(c))
    cases = [
        (text.isin("1", "1..1", "1-1"), "1..1"),
        (text.isin("0..1", "0-1", "0,1"), "0..1"),
        (text.isin("1..*", "1-*", "1+", "1,*"), "1..*"),
        (text.isin("0..*", "0-*", "0,*", "*"), "0..*"),
        (text.contains("..") | text.contains("-"), F.replace(text, F.lit("-"), F.lit(".."))),
    ]
    return first_match(cases, "1..1")


def table_cardinality(c: C) -> Column:
    """The cardinality of a document's table cell, with U for unbounded; an empty one is once."""
    text = filled(c)
    cases = [(text.isin("0..U", "0..*"), "0..*"), (text.isin("1..U", "1..*"), "1..*"), (text.isin("0..1", "0-1"), "0..1"), (text.isin("1..1", "1-1", ""), "1..1")]
    return first_match(cases, text)


def node_path(c: C) -> Column:
    """A path without white space and the common prefixes."""
    out = F.regexp_replace(filled(c), r"(?U)\s+", "")
    return F.regexp_replace(F.regexp_replace(out, r"^saft\.", ""), r"^auditfile\.", "")


# Key words of data types and formats, tried in this order.
TYPES = ((("string", "text", "tekst"), "string"), (("integer", "int", "number", "tall"), "integer"), (("decimal", "float", "double", "desimal"), "decimal"), (("date", "dato", "time", "tid"), "date"), (("boolean", "bool", "true", "false"), "boolean"))
DOCUMENT_TYPES = ((("date", "dato", "time", "tid"), "date"), (("amount", "beløp", "sum", "money", "currency"), "decimal"), (("number", "tall", "count", "antall"), "integer"), (("boolean", "true", "false", "yes", "no"), "boolean"), (("complex", "group", "element", "container"), "complex"))
FORMATS = ((("xml", "xhtml"), "XML"), (("json", "javascript"), "JSON"), (("csv", "comma"), "CSV"), (("iso", "standard"), "ISO"))


def data_type(c: C) -> Column:
    return first_match([(any_of(c, *words), name) for words, name in TYPES], "string")


def document_data_type(c: C) -> Column:
    return first_match([(any_of(c, *words), name) for words, name in DOCUMENT_TYPES], "string")


def text_format(c: C) -> Column:
    return first_match([(any_of(c, *words), name) for words, name in FORMATS], "XML")


def type_format(c: C) -> Column:
    """The format that values of a data type have."""
    return first_match([(_c(c).isin("date", "datetime"), "ISO 8601"), (_c(c).isin("decimal", "float"), "Decimal"), (_c(c) == "integer", "Integer")], "String")


def document_type_format(c: C) -> Column:
    return first_match([(_c(c) == "date", "ISO 8601"), (_c(c) == "decimal", "Decimal"), (_c(c) == "integer", "Integer")], "String")


def path_priority(c: C) -> Column:
    cases = [(any_of(c, "header", "hoved", "main", "root"), "high"), (any_of(c, "required", "påkrevd", "mandatory"), "high"), (any_of(c, "optional", "valgfri"), "low")]
    return first_match(cases, "medium")


def text_complexity(c: C) -> Column:
    return first_match([(any_of(c, "beregn", "kalkuler", "formel", "regel", "logikk"), "high"), (any_of(c, "valider", "kontroller", "sjekk"), "medium")], "low")


def document_details(c: C) -> Column:
    """Length, pattern and format that a description states."""
    text = filled(c)
    stated = lambda name, pattern: F.when(text.rlike(pattern), F.concat(F.lit(f"{name}: "), F.regexp_extract(text, pattern, 1)))
    return F.array_compact(F.array(stated("Max length", r"(?iU)(\d+)\s*(?:characters?|chars?|tegn)"), stated("Pattern", r"(?iU)pattern[:\s]+([^\s,]+)"), stated("Format", r"(?iU)format[:\s]+([^\s,]+)")))


def document_rules(c: C) -> Column:
    return F.array_compact(
        F.array(
            F.when(any_of(c, "required", "obligatorisk"), F.lit("Field is required")),
            F.when(any_of(c, "unique", "unik"), F.lit("Value must be unique")),
            F.when(any_of(c, "not null", "ikke null"), F.lit("Value cannot be null")),
        )
    )


def document_examples(c: C) -> Column:
    patterns = (r"(?iU)example[:\s]+([^\n,]+)", r"(?iU)eksempel[:\s]+([^\n,]+)", r"(?iU)f\.eks\.\s+([^\n,]+)", r"(?iU)for example[:\s]+([^\n,]+)")
    return F.transform(found_all(c, *patterns, group=1), lambda x: F.trim(x))


# --- reporting guidance --------------------------------------------------------------

# Key words of categories of guidance, tried in this order; later ones are partly shadowed.
GUIDANCE = (
    (("skjema", "form", "felt", "input"), "form_guidance"),
    (("validering", "valider", "gyldig", "feil"), "form_guidance"),
    (("frist", "deadline", "innlever", "submission"), "submission_deadlines"),
    (("skjemafelt", "felt", "input", "field"), "form_guidance"),
    (("beregn", "kalkuler", "formel", "regel"), "salary_reporting"),
    (("data", "struktur", "format", "xml"), "form_guidance"),
    (("arbeidsgiver", "lønn", "skatt", "trekk"), "employer_obligations"),
    (("ansatt", "person", "navn", "fødselsnummer"), "salary_reporting"),
    (("trekk", "skatt", "avgift"), "tax_deductions"),
)
# To what rules of some categories apply, and what they demand besides.
APPLIES = {
    "form_field": ["A-melding skjema", "Skjemafelter", "Datainnsamling"],
    "validation": ["A-melding data", "Datavalidering", "Kvalitetskontroll"],
    "submission": ["A-melding innlevering", "Rapportering", "Frister"],
    "business_logic": ["A-melding beregninger", "Forretningsregler", "Logikk"],
    "data_structure": ["A-melding data", "Datastruktur", "Format"],
    "payroll": ["Lønnsdata", "Arbeidsgiver", "Skattetrekk"],
    "employee_data": ["Ansattdata", "Personopplysninger", "Identifikasjon"],
}
DEMANDS = {"form_field": "Alle påkrevde felter må fylles ut", "validation": "Data må valideres før innlevering", "submission": "Innlevering må skje innen frist"}


def guidance_category(heading: C, text: C) -> Column:
    both = F.concat_ws(" ", filled(heading), filled(text))
    return first_match([(any_of(both, *words), name) for words, name in GUIDANCE], "general_guidance")


def guidance_applies_to(category: C) -> Column:
    return first_match([(_c(category) == name, F.array(*map(F.lit, said))) for name, said in APPLIES.items()], F.array(F.lit("A-melding generelt")))


def guidance_requirements(c: C, category: C) -> Column:
    more = first_match([(_c(category) == name, F.array(F.lit(said))) for name, said in DEMANDS.items()], F.array().cast("array<string>"))
    return F.concat(requirements(c), more)


def guidance_priority(category: C) -> Column:
    return first_match([(_c(category).isin("validation", "submission", "form_field"), "high"), (_c(category).isin("business_logic", "data_structure"), "medium")], "low")


def guidance_complexity(c: C, details: C) -> Column:
    size = F.size(_c(details))
    return first_match([((size > 3) | any_of(c, "beregn", "kalkuler", "formel"), "high"), ((size > 1) | any_of(c, "valider", "kontroller"), "medium")], "low")


# --- families and rules --------------------------------------------------------------


def rule_family(c: C) -> Column:
    """The first two parts of a rule's id."""
    parts = F.split(filled(c), "_")
    return F.when(F.size(parts) >= 2, F.array_join(F.slice(parts, 1, 2), "_")).otherwise("unknown")


def rule_topic(c: C) -> Column:
    """The topic whose wordings suit a rule, by parts of its id."""
    cases = [(any_of(c, "hotel"), "hotel"), (any_of(c, "food", "meal"), "food"), (any_of(c, "transport", "fuel"), "transport"), (any_of(c, "equipment", "computer"), "equipment")]
    return first_match(cases, "office")


def section_pattern(c: C) -> Column:
    """The kind of a section's id."""
    upper = F.upper(filled(c))
    return first_match([(filled(c).contains("§"), "paragraph"), (upper.contains("KAPITTEL"), "chapter"), (upper.contains("ARTIKKEL"), "article")], "other")
