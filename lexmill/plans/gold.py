"""Training samples: glossary questions, posting proposals and template conversations.

A sample is a struct of messages and metadata.  Choices among wordings and amounts go by
hashes of keys, so they don't depend on partitions or on when they are made.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexmill.functions import extract as X
from lexmill.functions.scoring import rate_text, vat
from lexmill.functions.text import filled, first_match, is_procedural, term, truncated
from lexmill.operators.split import family_split, pick

LOCALE = "nb-NO"
# What the assistant is told for each task.
PROMPTS = {
    "tax": "Du er en norsk regnskapsassistent med ekspertise innen skatt og merverdiavgift. Svar kort og presist med kildehenvisninger.",
    "accounting": "Du er en norsk regnskapsassistent med ekspertise innen regnskap og bokføring. Svar kort og presist med kildehenvisninger.",
    "posting": "Du er en regnskapsassistent for norske bedrifter. Du hjelper med å kontere transaksjoner korrekt med riktig konto, MVA-kode og beregning av merverdiavgift.",
}
# Wordings of questions; descriptions of expenses by topic, the amount in place of {}; amounts.
QUESTIONS = ("Hva betyr '{}'?", "Forklar '{}'", "Hva er '{}'?")
DESCRIPTIONS = {
    "hotel": ("Hotellovernatting {} kr", "Hotel - forretningsreise", "Overnatting", "hotell", "Radisson Blu Oslo - 2 netter", "Hotell med frokost inkludert"),
    "food": ("Måltid {} kr", "Lunsj med kunde", "Mat og drikke", "restaurant", "Middag forretningsreise", "Lunch på forretningsreise"),
    "office": ("Kontorrekvisita {} kr", "Kontormateriale", "Skrivesaker", "kontorrekvisita", "Printer papir og blekkpatron", "Diverse kontorrekvisita"),
    "transport": ("Transport {} kr", "Drivstoff", "Bensin", "Parkering Oslo", "Bompenger", "Transport til kunde"),
    "equipment": ("Utstyr {} kr", "PC-utstyr", "Datamaskin", "utstyr", "Mus og tastatur", "Kontorpult"),
}
AMOUNTS = (500, 750, 1000, 1200, 1500, 1800, 2000, 2500, 3000, 3500, 4000, 5000, 7500, 10000, 15000)
# Names of topics in conversations, their labels, and contexts.
NAMES = {"hotel": ("hotellovernatting", "hotell", "overnatting", "hotellrom"), "food": ("måltid", "restaurant", "lunsj", "middag", "mat"), "office": ("kontorrekvisita", "kontormateriale", "skrivesaker", "kontorforsyninger"), "transport": ("transport", "drivstoff", "bensin", "taxi", "bompenger"), "equipment": ("utstyr", "datautstyr", "verktøy", "maskiner")}
LABELS = {"hotel": "hotellovernatting", "food": "måltid", "office": "kontorrekvisita", "transport": "transport", "equipment": "utstyr"}
CONTEXTS = ("en norsk forretningsreise", "forretningsrelatert", "en forretningsutgift", "en vanlig forretningskjøp", "fra en norsk leverandør")


def _message(role: str, content: Column) -> Column:
    return F.struct(F.lit(role).alias("role"), content.alias("content"))


def _metadata(domain: str, task: str, sources: Column, family: Column, rules: Column | None = None, kind: Column | None = None, turns: Column | None = None) -> Column:
    none = F.lit(None)
    return F.struct(
        F.lit(domain).alias("domain"),
        F.lit(task).alias("task"),
        sources.alias("source_ids"),
        F.lit(LOCALE).alias("locale"),
        family.alias("family_key"),
        (rules if rules is not None else none.cast("array<string>")).alias("rule_ids"),
        (kind if kind is not None else none.cast("string")).alias("conversation_type"),
        (turns if turns is not None else none.cast("int")).alias("turns"),
    )


def _asked(rows: DataFrame, prompt: str, question: Column, answer: Column, metadata: Column) -> DataFrame:
    messages = F.array(_message("system", F.lit(prompt)), _message("user", question), _message("assistant", answer))
    return rows.select(messages.alias("messages"), metadata.alias("metadata"))


def with_citation(text: Column, citation: Column) -> Column:
    """The text with the citation behind it, unless it ends so."""
    return F.when(text.endswith(citation) | (citation == ""), text).otherwise(F.concat(text, F.lit(" "), citation))


def tax_glossary(sections: DataFrame, seed: int = 42) -> DataFrame:
    """A question about each law section that defines something: of 100 to 3,000 characters, not procedural, with a term."""
    size = F.length(filled("text_plain"))
    rows = sections.where(size.between(100, 3000)).where(~is_procedural("text_plain")).withColumn("__term", term("heading")).where("__term is not null and __term <> ''")
    label = F.col("section_label") if "section_label" in sections.columns else F.lit("")
    label = F.when(filled(label) != "", label).otherwise(F.get(F.split(filled("heading"), r"\."), F.lit(0)))
    citation = F.concat(F.lit("["), label, F.lit(" "), filled("law_title"), F.lit("]"))
    shape = pick([q for q in QUESTIONS], F.col("law_id"), F.col("section_id"), seed=seed)
    question = F.replace(shape, F.lit("{}"), F.col("__term"))
    family = F.concat(F.coalesce("law_id", F.lit("unknown")), F.lit("_chapter_"), F.coalesce("chapter_no", F.lit("unknown")))
    source = F.concat_ws("_", F.coalesce("law_id", F.lit("unknown")), F.coalesce("section_id", F.lit("unknown")))
    return _asked(rows, PROMPTS["tax"], question, with_citation(truncated("text_plain", 250), citation), _metadata("tax", "glossary_define", F.array(source), family))


def account_glossary(accounts: DataFrame) -> DataFrame:
    """A question about each account."""
    rows = accounts.where((filled("account_id") != "") & (filled("account_label") != ""))
    shown = F.slice(F.coalesce("examples", F.array().cast("array<string>")), 1, 3)
    answer = F.concat(filled("description"), F.when(F.size(shown) > 0, F.concat(F.lit(" Eksempler: "), F.array_join(shown, ", "))).otherwise(""))
    citation = F.concat(F.lit("[NS 4102 konto "), "account_id", F.lit("]"))
    family = F.concat(F.lit("account_class_"), F.coalesce("account_class", F.lit("unknown")))
    source = F.concat(F.lit("chart_of_accounts_"), "account_id")
    return _asked(rows, PROMPTS["accounting"], F.concat(F.lit("Hva er konto "), "account_id", F.lit("?")), with_citation(answer, citation), _metadata("accounting", "glossary_define", F.array(source), family))


def node_glossary(nodes: DataFrame) -> DataFrame:
    """A question about each described node of the specification."""
    rows = nodes.where((filled("node_label") != "") & (F.length(filled("description")) >= 20))
    version = F.coalesce("version", F.lit("1.3")) if "version" in nodes.columns else F.lit("1.3")
    citation = F.concat(F.lit("[SAF-T "), version, F.lit(" "), "node_path", F.lit("]"))
    family = F.concat(F.lit("saft_level_"), F.coalesce(F.col("node_level").cast("string"), F.lit("0")))
    source = F.concat(F.lit("saft_"), F.coalesce("node_id", F.lit("unknown")))
    return _asked(rows, PROMPTS["accounting"], F.concat(F.lit("Hva er '"), "node_label", F.lit("' i SAF-T?")), with_citation(truncated("description", 200), citation), _metadata("accounting", "glossary_define", F.array(source), family))


def eligible_rules(rules: DataFrame) -> DataFrame:
    """Active rules with account, VAT rate and VAT code, each of the first action of its type."""
    action = lambda kind: F.get_json_object(F.concat(F.lit('{"v":'), F.get(F.filter("actions", lambda a: a["type"] == kind), F.lit(0))["value"], F.lit("}")), "$.v")
    rows = rules.where(F.coalesce("is_active", F.lit(True))).withColumns({"account": action("set_account"), "vat_rate": action("set_vat_rate").try_cast("double"), "vat_code": action("set_vat_code")})
    return rows.where("account is not null and vat_rate is not null and vat_code is not null")


def posting_text(account: Column, label: Column, code: Column, rate: Column, amount: Column, citation: Column) -> Column:
    """A posting proposal with its VAT."""
    money = lambda c: F.format_string("%.2f kr", c.cast("double"))
    parts = vat(amount, rate)
    lines = [
        F.lit("Kontering:"),
        F.concat(F.lit("- Konto: "), account, F.lit(" ("), label, F.lit(")")),
        F.concat(F.lit("- MVA-kode: "), code),
        F.concat(F.lit("- MVA-sats: "), rate_text(rate), F.lit("%")),
        F.concat(F.lit("- Beløp eksl. MVA: "), money(parts["net"])),
        F.concat(F.lit("- MVA-beløp: "), money(parts["vat"])),
        F.concat(F.lit("- Totalt: "), money(amount)),
        F.lit(""),
        F.concat(F.lit("["), citation, F.lit("]")),
    ]
    return F.concat_ws("\n", *lines)


def rule_variations(rules: DataFrame, variations: int = 15, seed: int = 42) -> DataFrame:
    """Amounts by descriptions of each eligible rule, ``variations`` at most, in a hashed order of the amounts."""
    rows = eligible_rules(rules).withColumn("topic", X.rule_topic("rule_id"))
    chosen = min(variations, len(AMOUNTS))
    wordings = max(1, variations // chosen + 1)
    order = lambda a: F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("rule_id"), a.cast("string")).cast("binary"))
    amounts = F.slice(F.array_sort(F.transform(F.array(*map(F.lit, AMOUNTS)), lambda a: F.struct(order(a).alias("h"), a.alias("amount")))), 1, chosen)
    shapes = first_match([(F.col("topic") == t, F.array(*map(F.lit, d[:wordings]))) for t, d in DESCRIPTIONS.items()], F.array().cast("array<string>"))
    rows = rows.withColumn("shapes", shapes).select("*", F.posexplode(amounts).alias("i", "a")).select("*", F.posexplode("shapes").alias("j", "shape"))
    rows = rows.where(F.col("i") * F.size("shapes") + F.col("j") < variations)  # the product's rank, without a window
    cited = F.when(F.size(F.coalesce("citations", F.array().cast("array<string>"))) > 0, F.get("citations", F.lit(0))).otherwise(F.concat(F.lit("Regel: "), "rule_name"))
    return rows.select("rule_id", "rule_name", "source_ids", "i", "j", F.replace("shape", F.lit("{}"), F.col("a.amount").cast("string")).alias("description"), F.col("a.amount").alias("amount"), "account", "vat_code", "vat_rate", cited.alias("citation"))


def rule_samples(rules: DataFrame, variations: int = 15, seed: int = 42) -> DataFrame:
    """Posting proposals for variations of the rules."""
    rows = rule_variations(rules, variations, seed)
    c = F.col
    answer = posting_text(c("account"), c("rule_name"), c("vat_code"), c("vat_rate"), c("amount"), c("citation"))
    return _asked(rows, PROMPTS["posting"], c("description"), answer, _metadata("accounting", "posting_proposal", c("source_ids"), X.rule_family("rule_id"), rules=F.array("rule_id")))


def filled_template(shape: Column, values: Column) -> Column:
    """A text with ``{key}`` replaced by the map's values."""
    return F.aggregate(F.map_entries(values), shape, lambda text, e: F.replace(text, F.concat(F.lit("{"), e["key"], F.lit("}")), e["value"]))


def conversations(templates: DataFrame, rules: DataFrame, per_template: int = 250, seed: int = 42) -> DataFrame:
    """Conversations from each template, with rules and values picked by hash.

    A pick of a rule that isn't eligible gives no conversation, as does a template with two
    lines if either pick isn't.
    """
    active = rules.where(F.coalesce("is_active", F.lit(True))).select("rule_id").withColumn("at", F.expr("row_number() over (order by rule_id) - 1"))
    n = active.count()
    if n == 0:
        return rule_samples(rules).limit(0)
    facts = eligible_rules(rules).select("rule_id", "rule_name", "account", "vat_rate", "vat_code", filled("description").alias("explanation"))
    numbered = active.join(facts, "rule_id")
    half = n // 2
    rows = templates.select("*", F.explode(F.sequence(F.lit(0), F.lit(per_template - 1))).alias("k"))
    two = F.col("template_id") == "multi_item"
    at = lambda *salt: F.conv(F.substring(F.md5(F.concat_ws(":", F.lit(str(seed)), "template_id", "k", *(F.lit(s) for s in salt)).cast("binary")), 1, 7), 16, 10).cast("int")
    rows = rows.withColumns({"p1": at("r1") % F.when(two, F.lit(max(half, 1))).otherwise(n), "p2": half + at("r2") % max(n - half, 1)})
    one = numbered.select(F.col("at").alias("p1"), F.struct("rule_id", "rule_name", "account", "vat_rate", "vat_code", "explanation").alias("r1"))
    other = numbered.select(F.col("at").alias("p2"), F.struct("rule_id", "rule_name", "account", "vat_rate", "vat_code", "explanation").alias("r2"))
    rows = rows.join(one, "p1").join(other, "p2", "left").where(~two | (F.col("r2").isNotNull() & F.lit(n >= 2)))
    amounts = F.array(*map(F.lit, AMOUNTS[:9]))

    def topic(rule: str) -> Column:
        name = F.lower(F.col(f"{rule}.rule_id"))
        cases = [(name.contains("hotel"), "hotel"), (name.contains("food") | name.contains("meal"), "food"), (name.contains("office"), "office"), (name.contains("transport"), "transport"), (name.contains("equipment"), "equipment")]
        return first_match(cases, "")

    def wording(rule: str) -> Column:
        lists = [(topic(rule) == t, F.get(F.array(*map(F.lit, v)), at(rule, "name") % len(v))) for t, v in NAMES.items()]
        return first_match(lists, "kostnad")

    label = lambda rule: first_match([(topic(rule) == t, v) for t, v in LABELS.items()], "diverse kostnad")
    rows = rows.withColumns({"a1": F.get(amounts, at("a1") % 9), "a2": F.get(amounts, at("a2") % 9)})
    vat1, vat2, sample = vat("a1", "r1.vat_rate"), vat("a2", "r2.vat_rate"), vat(F.lit(1000), "r1.vat_rate")
    number = lambda c: c.cast("string")
    values = {
        "category": wording("r1"), "category_label": label("r1"), "amount": number(F.col("a1")), "amount_ex_vat": number(vat1["net"]), "vat_amount": number(vat1["vat"]),
        "account": F.col("r1.account"), "account_label": F.col("r1.rule_name"), "vat_code": F.col("r1.vat_code"), "vat_rate": rate_text("r1.vat_rate"), "explanation": F.col("r1.explanation"),
        "context": F.get(F.array(*map(F.lit, CONTEXTS)), at("context") % len(CONTEXTS)), "example_amount": F.lit("1000"), "example_ex_vat": number(sample["net"]), "example_vat": number(sample["vat"]),
        "examples": F.lit("diverse forretningskostnader"), "wrong_account": F.lit("6300"), "correct_account": F.col("r1.account"),
        "category1": wording("r1"), "category1_label": label("r1"), "amount1": number(F.col("a1")), "amount1_ex_vat": number(vat1["net"]), "account1": F.col("r1.account"), "account1_label": F.col("r1.rule_name"), "vat_code1": F.col("r1.vat_code"), "vat_rate1": rate_text("r1.vat_rate"),
        "category2": wording("r2"), "category2_label": label("r2"), "amount2": number(F.col("a2")), "amount2_ex_vat": number(vat2["net"]), "account2": F.col("r2.account"), "account2_label": F.col("r2.rule_name"), "vat_code2": F.col("r2.vat_code"), "vat_rate2": rate_text("r2.vat_rate"),
    }
    rows = rows.withColumn("values", F.create_map(*(x for k, v in values.items() for x in (F.lit(k), F.coalesce(v, F.lit(""))))))
    said = F.flatten(F.transform("turns", lambda t: F.array(_message("user", filled_template(t["user"], F.col("values"))), _message("assistant", filled_template(t["assistant"], F.col("values"))))))
    messages = F.concat(F.array(_message("system", F.col("system"))), said)
    return rows.select(messages.alias("messages"), _metadata("accounting", "conversation", F.array("r1.rule_id"), F.col("template_id"), kind=F.col("template_id"), turns=F.size("turns")).alias("metadata"))


# --- export --------------------------------------------------------------------------


def split_samples(samples: DataFrame, ratio: float = 0.8, seed: int = 42) -> DataFrame:
    """Samples with ``metadata.split``; the samples of a family are on one side."""
    out = family_split(samples.withColumn("__fam", F.col("metadata.family_key")), "__fam", ratio, seed).drop("__fam")
    stamped = F.col("metadata").withField("split", F.col("split")).withField("created_at", F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss'Z'"))
    return out.withColumn("metadata", stamped)


def export(samples: DataFrame, path: str, ratio: float = 0.8, seed: int = 42) -> dict[str, int]:
    """Writes JSON lines to ``path/split=train`` and ``path/split=val``; returns how many."""
    split_samples(samples, ratio, seed).write.mode("overwrite").partitionBy("split").json(path)
    spark = samples.sparkSession
    found = {r["split"]: r["count"] for r in spark.read.schema("split string").json(path).groupBy("split").count().collect()}
    return {"total_generated": sum(found.values()), "train_samples": found.get("train", 0), "val_samples": found.get("val", 0)}


def sample_errors(messages: Column, metadata: Column) -> Column:
    """What is wrong with a training sample, as texts."""
    roles = F.array(*map(F.lit, ("system", "user", "assistant")))
    tests = (
        (F.coalesce(F.size(messages), F.lit(0)) < 2, "fewer than 2 messages"),
        (F.coalesce(F.get(messages, F.lit(0))["role"], F.lit("")) != "system", "first message isn't system"),
        (F.exists(messages, lambda m: ~F.coalesce(F.array_contains(roles, m["role"]), F.lit(False))), "unknown role"),
        (F.exists(messages, lambda m: F.length(filled(m["content"])) < 1), "empty message"),
        (~F.coalesce(metadata["domain"].isin("tax", "accounting", "reporting", "payroll"), F.lit(False)), "unknown domain"),
        (~F.coalesce(metadata["task"].isin("glossary_define", "posting_proposal", "conversation", "vat_question"), F.lit(False)), "unknown task"),
        (F.coalesce(F.size(metadata["source_ids"]), F.lit(0)) < 1, "no sources"),
    )
    return F.array_compact(F.array(*(F.when(F.coalesce(bad, F.lit(True)), F.lit(said)) for bad, said in tests)))


def rules_as_rows(rules: DataFrame) -> list:
    """The seed table of rules on the driver, for the rule engine."""
    return rules.orderBy("priority", "rule_id").collect()
