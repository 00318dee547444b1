from __future__ import annotations

import hashlib
import re

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lexmill.functions import extract as X
from lexmill.functions import scoring as S
from lexmill.functions import text as T

QUICK = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))


@pytest.mark.parametrize(
    "html, text",
    [
        ("<p>Hello <strong>world</strong>!</p>", "Hello world!"),
        ("<div><script>var x = 1;</script><style>p{}</style><p>Clean text here</p></div>", "Clean text here"),
        ("  Multiple   spaces\n\nand\t\ttabs  ", "Multiple spaces and tabs"),
        ("", ""),
        (None, ""),
    ],
)
def test_html_text(value, html, text):
    assert value(T.html_text("t"), t=html) == text


def test_hashes(value):
    same = {value(T.stable_hash("t", canonical=True), t=x) for x in ("  Hello   world  ", "hello world", "HELLO WORLD")}
    assert same == {hashlib.sha256(b"hello world").hexdigest()}
    assert value(T.stable_hash("t"), t=None) == value(T.escaped_hash("t"), t="") == ""
    want = "blåbær".encode().decode("unicode_escape")
    assert value(T.escaped_hash("t"), t="BLÅBÆR") == hashlib.sha256(want.encode()).hexdigest()


@QUICK
@given(st.text(alphabet="aB Å\t\n .", max_size=40))
def test_hash_ignores_case_and_space(value, text):
    want = re.sub(r"\s+", " ", text.lower()).strip()
    got = value(T.stable_hash("t", canonical=True), t=text)
    assert got == ("" if not text else hashlib.sha256(want.encode()).hexdigest())


def test_unicode(value):
    assert value(T.unicode_normalized("t"), t="ﬁn  tekst ") == "fin tekst"
    assert value(T.mojibake_fixed("t"), t="Ã¦rlig Ã¥r") == "ærlig år"
    assert value(T.section_text_cleaned("t"), t="Tekst [1] og (2) jf. § 3. Slutt.") == "Tekst og Slutt."


@pytest.mark.parametrize(
    "text, clean",
    [("Regel A. 🔗 Del paragraf", "Regel A."), ("12 Tekst 34", "Tekst"), ("A [Til toppen] B", "A B"), ("X <a href='y'>bort</a> z", "X z"), ("Innhold rettskilder og mer", "Innhold"), ("Noe. Endret ved lov 1", "Noe.")],
)
def test_legal_cleaned(value, text, clean):
    assert value(T.legal_cleaned("t"), t=text) == clean


@pytest.mark.parametrize("text, iso", [("16 juni 2023", "2023-06-16"), ("1 jan 2021", "2021-01-01"), ("i dag", "i dag"), ("3 foo 2020", "3 foo 2020"), (None, "")])
def test_norwegian_date(value, text, iso):
    assert value(T.norwegian_date("t"), t=text) == iso


def test_validity_dates(value):
    got = value(T.validity_dates("c"), c=["25 %", "01.02.2024", "3/4/2025", "5-6-2026"])
    assert (got["valid_from"], got["valid_to"]) == ("2024-02-01", "2026-06-05")
    assert value(T.validity_dates("c"), c=["2024-01-01"])["valid_from"] is None
    assert value(T.validity_dates("c", iso_aware=True), c=["2024-01-01"])["valid_from"] == "2024-01-01"
    assert value(T.validity_dates("c"), c=["99.99.2024"])["valid_from"] is None


def _truncate(text, tokens):
    n = tokens * 4
    if len(text) <= n:
        return text
    cut = text[:n].rsplit(".", 1)[0]
    return cut + "." if cut else text[:n] + "..."


def _preview(text, n):
    if len(text) <= n:
        return text
    head = text[:n]
    at = max(head.rfind("."), head.rfind(" "))
    return (head[: at + 1] if at > n * 0.7 else head) + "..."


@QUICK
@given(st.text(alphabet="ab. \n", max_size=60))
def test_cuts(value, text):
    assert value(T.truncated("t", 5), t=text) == _truncate(text, 5)
    assert value(T.preview("t", 20), t=text) == _preview(text, 20)


@pytest.mark.parametrize("heading, term", [("§ 1-1. Saklig virkeområde", "Saklig virkeområde"), ("Kapittel 3 Fradrag", "Fradrag"), ("Om merverdiavgift", "Om merverdiavgift"), ("kort", None), ("§ ", None), ("", None)])
def test_term(value, heading, term):
    assert value(T.term("t"), t=heading) == term


def test_citations(value):
    assert value(T.citations("t"), t="Se § 3-1 og § 3-1 i Merverdiavgifts-loven, lov-2009-06-19-58") == ["Merverdiavgifts-loven", "lov-2009-06-19-58", "§ 3-1"]
    assert value(T.has_citation("t"), t="x [§ 1-1 Lov om avgift]") and not value(T.has_citation("t"), t="[NS 4102 konto 1000]")
    assert value(T.has_citation("t", account_citations=True), t="[NS 4102 konto 1000]")


@pytest.mark.parametrize("c, want", [("1", "1..1"), ("0..1", "0..1"), ("1..*", "1..*"), ("0..*", "0..*"), ("0..U", "0..U"), ("1..U", "1..U"), ("invalid", "1..1")])
def test_document_cardinality(value, c, want):
    assert value(X.document_cardinality("c"), c=c) == want


@pytest.mark.parametrize("text, want", [("date field", "date"), ("amount field", "decimal"), ("count field", "integer"), ("boolean field", "boolean"), ("complex structure", "complex"), ("regular text", "string")])
def test_document_types(value, text, want):
    assert value(X.document_data_type("t"), t=text) == want


@pytest.mark.parametrize("c, want", [("", "1"), ("valgfri", "0..1"), ("1..1", "1"), ("1+", "1..*"), ("Zero or more", "0..*"), ("7", "7")])
def test_cardinality(value, c, want):
    assert value(X.cardinality("c"), c=c) == want


@pytest.mark.parametrize("text, want", [("25 %", 25.0), ("12,5 %", 12.5), ("12.5%", 5.0), ("ingen", None), (None, None)])
def test_percent(value, text, want):
    assert value(X.percent("t"), t=text) == want
    if text == "12.5%":
        assert value(X.percent("t", decimal=True), t=text) == 12.5


def test_rate_cells(value):
    got = value(X.rate_of_cells("c"), c=["Mat", "15 %", "x"])
    assert (got["percent"], got["description"]) == (15.0, "Mat")
    assert value(X.rate_of_cells("c"), c=["15 %", "a", "b"])["description"] == "a b"
    assert value(X.rate_of_cells("c"), c=["a", "b"]) is None
    text = "x" * 150 + " 25 % " + "y" * 150
    want = text[max(0, text.find("25 %") - 100) : text.find("25 %") + 100]
    assert value(X.percent_context("t"), t=text) == want
    said = value(X.rate_of_text("t"), t="redusert sats 15 % fra 01.01.2024")
    assert (said["kind"], said["value"], said["valid_from"]) == ("lav", "15 %", "2024-01-01")


def test_statements(value):
    text = "Feltet må ha verdi. Hvis tom, skal det feile. For eksempel 12. Krever id. Format: ISO. Se f.eks. dette."
    assert value(X.validation_rules("t"), t=text) == ["ha verdi", "det feile"]
    assert value(X.business_rules("t"), t=text) == ["tom, skal det feile"]
    assert value(X.examples("t"), t=text) == ["12", "12", "dette"]
    assert value(X.dependencies("t"), t=text) == ["id", "verdi"]
    assert value(X.technical_details("t"), t=text) == ["iso"]
    assert value(X.field_mappings("t"), t="Navn → kode. navn til felt") == {"navn": "felt"}


def test_vat_and_grades(value):
    assert tuple(value(S.vat(F.lit(1250), F.lit(25.0)))) == (1000.0, 250.0)
    assert value(S.rate_text(F.lit(25))) == "25.0"
    assert [value(S.length_score(F.lit(n))) for n in (10, 50, 100, 250, 251, 300, 301)] == [0.5, 0.8, 1.0, 1.0, 0.8, 0.8, 0.5]
    assert value(S.length_score(F.lit(260), 255)) == 0.5
    got = value(S.grade("p", "e", F.array(F.lit("Avgift"), F.lit("zz"))), p="avgift til staten", e="avgift til kommunen")
    assert got["accuracy"] == pytest.approx(0.5) and got["keywords"] == 0.5 and got["status"] == "fail"
    assert value(S.jaccard("p", "e"), p="", e="a") == 0.0


def test_families(value):
    assert value(X.rule_family("t"), t="expense_hotel_no_001") == "expense_hotel" and value(X.rule_family("t"), t="x") == "unknown"
    assert value(X.rule_topic("t"), t="expense_fuel_1") == "transport"
    assert value(T.is_url("t"), t="https://a.b/c") and not value(T.is_url("t"), t="no url")
