from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from lexmill.plans import gold, guidance, legal, rates, saft
from lexmill.sources import html, pdf, seeds


def blocks(spark, markup):
    return html.html_blocks(spark.createDataFrame([(1, markup)], "page int, html string"))


def test_nodes_nest(spark):
    nodes = {r["tag"]: r for r in html.html_nodes(spark.createDataFrame([(1, "<div id=a class='x y'><p>one<p>two<br></div>after")], "page int, html string")).collect()}
    assert nodes["div"]["classes"] == ["x", "y"] and nodes["div"]["node_id"] == "a"
    assert nodes["p"]["parent_pre"] == nodes["div"]["node_pre"] and nodes["p"]["text"] == "two"
    assert nodes["div"]["node_pre"] < nodes["br"]["node_pre"] < nodes["br"]["node_post"] < nodes["div"]["node_post"]


@pytest.mark.parametrize("markup", [None, "", "plain", "<p", "</p></b>", "<table><tr><td>x"])
def test_broken_pages_are_rows(spark, markup):
    assert blocks(spark, markup).where("kind = 'page' and error is null").count() == 1


def test_law_sections(spark):
    page = """<html><head><title>Lov X - Lovdata</title></head><body><h1 class="title">Merverdiavgiftsloven (mval.)</h1><div class="kapittel"><h2>Kapittel 3. Om ting</h2>
      <div class="morTag_p paragraf" id="PARAGRAF_3-1"><h3>§ 3-1. Omfang</h3><p>Loven gjelder for alle varer og tjenester i landet. Endret ved lov 20 juni 2014 nr. 1.</p></div>
      <div class="paragraf"><h3>§ 3-2 (Opphevet)</h3><p>Opphevet, ikr. 1 jan 2021.</p></div></div></body></html>"""
    rows = {r["section_id"]: r for r in legal.sections(blocks(spark, page), ["page"], {"source_id": "page"}).collect()}
    first, second = rows["PARAGRAF_3-1"], rows["§ 3-2"]
    assert first["path"] == "Kapittel 3 PARAGRAF_3-1" and first["chapter_no"] == "3" and not first["repealed"]
    assert first["law_title"] == "Merverdiavgiftsloven" and first["amendments"][0]["date"] == "2014-06-20"
    assert len(first["sha256"]) == 64 and first["text_plain"].endswith("i landet.")
    assert second["repealed"] and second["repeal_date"] == "2021-01-01"


def test_sections_of_plain_text(spark):
    rows = legal.parsed_sections(blocks(spark, "<body>§ 1-1 Formål\nLoven skal sikre inntekter.\n§ 1-2 Omfang\nkort\n</body>"), ["page"]).collect()
    assert [(r["section_id"], r["heading"]) for r in rows] == [("§ 1-1", "§ 1-1 Formål")]


def test_plain_metadata(spark):
    one = legal.plain_metadata(blocks(spark, "<h1 class='title'>Merverdiavgiftsloven</h1><h2>Kapittel 5. Avgiftsberegning</h2><p>Endret ved lov 1 juni 2020. Endret ved forskrift 2 mai 2021.</p>"), ["page"]).first()
    assert (one["law_title"], one["chapter"], one["repealed"]) == ("Merverdiavgiftsloven", "Kapittel 5. Avgiftsberegning", True)
    assert set(one["amended_dates"]) == {"1 juni 2020", "2 mai 2021"}
    bare = legal.plain_metadata(blocks(spark, "<p>Just some text</p>"), ["page"]).first()
    assert bare["law_title"] is None and not bare["repealed"]


def test_rates(spark):
    page = "<table><tr><th>Type</th><th>Sats</th></tr><tr><td>Standard</td><td>25%</td><td>01.01.2024</td></tr><tr><td>Mat, unntatt alkohol</td><td>15 %</td></tr><tr><td>Fritatt</td><td>0%</td></tr></table>"
    rows = rates.rates(blocks(spark, page)).orderBy("ord").collect()
    assert [(r["kind"], r["percentage"]) for r in rows] == [("standard", 25.0), ("reduced", 15.0), ("zero", 0.0)]
    assert "Standard" in rows[0]["description"] and rows[0]["valid_from"] == "2024-01-01"
    assert rows[1]["exceptions"] == ["alkohol", "Alkoholholdige drikkevarer har høyere sats"]
    assert rates.rates(blocks(spark, "")).count() == 0
    assert rates.rates(blocks(spark, "<p>25 % merverdiavgift</p>")).count() == 0
    assert rates.silver(rates.rates(blocks(spark, page))).first()["rate_value"] == 25.0


def test_spec_nodes(spark):
    page = "<main><h2>saft.Header felt</h2><p>Feltet må ha dato. Hvis tom, valider format: ISO.</p><h2>Cookie</h2><p>Vi bruker informasjonskapsler her.</p><ul><li>Element Konto er tall</li><li>kort</li></ul><pre>&lt;Account&gt;</pre></main>"
    rows = saft.page_nodes(blocks(spark, page)).collect()
    by = {r["part"]: r for r in rows}
    assert by[2]["node_path"] == "Header" and by[2]["validation_rules"][0] == "ha dato"
    assert by[3]["node_path"] == "Account" and by[3]["format"] == "XML"
    assert saft.silver(saft.documentation_nodes(blocks(spark, page))).first()["node_level"] == 1


def test_document_nodes(spark):
    table = [["Element", "Rep", "Description", "Type"], ["Company", "0..U", "Name, max 35 characters, required", ""], ["element", "1", "x", ""], [None, "1", "x", ""]]
    rows = spark.createDataFrame([("t", "", [table]), ("h", "Tag (0..1): Date of it\nOther | 1 | Amount", []), ("e", "X", [])], "path string, text string, tables array<array<array<string>>>")
    got = {r["node_path"]: r for r in saft.document_nodes(rows, "path", "path", {"h": "Header"}).collect()}
    assert got["Company"]["cardinality"] == "0..*" and got["Company"]["technical_details"] == ["Max length: 35"] and got["Company"]["validation_rules"] == ["Field is required"]
    assert got["Header.Tag"]["data_type"] == "date" and got["Header.Other"]["data_type"] == "decimal"


def test_documents_without_engines(spark):
    def broken(content):
        raise ValueError("no engine")

    rows = spark.createDataFrame([("a", b"x")], "path string, content binary")
    one = pdf.read_documents(rows, (broken, lambda c: "text"), lambda c: [[["a", None]]]).first()
    assert (one["text"], one["tables"], one["error"]) == ("text", [[["a", None]]], None)
    assert pdf.read_documents(rows, (broken,), broken).first()["error"].startswith("broken")


def test_guidance(spark):
    page = """<main><h2>Innlevering</h2><p>A-melding må leveres innen frist hver måned. Hvis for sent, beregn gebyr.</p><div>Krav til rapportering<ul><li>kort</li><li>Arbeidsgiver må melde lønn</li></ul></div>
      <table><tr><th>Felt</th><th>Krav</th></tr><tr><td>Navn</td><td>A-melding må ha navn</td></tr></table><form>skjema <label>Ditt navn</label><input name=n required minlength=2 maxlength=9><input name=m></form><a href=x>veiledning</a></main>"""
    found = guidance.overview_rules(blocks(spark, page), ["page"]).collect()
    assert {r["rule_id"] for r in found} >= {"amelding_heading_001", "amelding_list_001", "amelding_table_001", "amelding_form_001", "amelding_form_002", "amelding_link_001"}
    item = next(r for r in found if r["kind"] == "list")
    assert item["title"].startswith("Regel 2: Arbeidsgiver")
    forms = guidance.form_rules(blocks(spark, page), ["page"]).collect()
    field = next(r for r in forms if r["kind"] == "field")
    assert field["description"] == "Ditt navn" and field["requirements"][0] == "Felt n er påkrevd" and len([r for r in forms if r["kind"] == "field"]) == 1
    assert any("submission" in r["category"] for r in forms)
    every = guidance.form_rules(blocks(spark, page), ["page"], every_field=True)
    assert every.where("kind = 'field'").count() == 2


def test_markup_to_markup():
    assert html.display_html("<div class=x><script>y</script><a href='u' onclick='z'>t</a></div>") == '<div><a href="u">t</a></div>'
    assert html.section_html("<body><nav>n</nav><div id=p1>a<a href='/del-paragraf'>s</a></div></body>", "p1") == '<div id="p1">a</div>'
    assert html.section_html(None, "x") == ""


def test_gold_samples(spark):
    rules = seeds.business_rules(spark)
    assert gold.eligible_rules(rules).count() == 28
    samples = gold.rule_samples(rules)
    assert samples.count() == 420
    assert samples.where(F.size(gold.sample_errors(F.col("messages"), F.col("metadata"))) > 0).count() == 0
    accounts = gold.split_samples(gold.account_glossary(seeds.accounts(spark)))
    assert accounts.count() == 42 and accounts.groupBy("metadata.family_key").agg(F.count_distinct("split").alias("n")).where("n > 1").count() == 0
    talks = gold.conversations(seeds.templates(spark), rules, 20)
    assert talks.count() > 80 and talks.where(F.exists("messages", lambda m: m["content"].rlike(r"\{\w+\}"))).count() == 0
    assert sorted(map(json.dumps, talks.toJSON().collect())) == sorted(map(json.dumps, gold.conversations(seeds.templates(spark), rules, 20).toJSON().collect()))
    nodes = spark.createDataFrame([("n1", "Node", "A node with a long description", "1.30", "A.Node", 2)], "node_id string, node_label string, description string, version string, node_path string, node_level int")
    assert gold.node_glossary(nodes).first()["messages"][2]["content"].endswith("[SAF-T 1.30 A.Node]")


def test_tax_glossary(spark):
    rows = spark.createDataFrame([("l", "s1", "§ 1-1. Omfang", "x" * 120, "Lov"), ("l", "s2", "§ 1-2. Klage", "klage " * 30, "Lov"), ("l", "s3", "kort", "x" * 120, "Lov"), ("l", "s4", "§ 1-4. Kort", "x", "Lov")], "law_id string, section_id string, heading string, text_plain string, law_title string").withColumn("chapter_no", F.lit("1"))
    one = gold.tax_glossary(rows).collect()
    assert len(one) == 1 and one[0]["messages"][2]["content"].endswith("[§ 1-1 Lov]") and "'Omfang'" in one[0]["messages"][1]["content"]
