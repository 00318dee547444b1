"""VAT arithmetic, quality scores and grades of answers, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lexmill.functions.text import C, _c, filled, first_match, has_citation, token_count

#: Weights of accuracy, citation, length and key words in a grade.
WEIGHTS = (0.50, 0.25, 0.15, 0.10)
PASS, ACCEPTABLE = 0.90, 0.75


def vat(amount: C, rate: C) -> Column:
    """(net, vat) of an amount that includes VAT, each rounded to two decimals."""
    gross = _c(amount).cast("double")
    net = gross / (1 + _c(rate).cast("double") / 100)
    return F.struct(F.round(net, 2).alias("net"), F.round(gross - net, 2).alias("vat"))


def rate_text(c: C) -> Column:
    """A rate as it is printed: with one decimal at least."""
    return _c(c).cast("double").cast("string")


def quality_score(issues: C, records: C) -> Column:
    """From 10 down to 0 as issues grow to two for each record."""
    loss = _c(issues) / (_c(records) * 2) * 10
    return F.round(F.greatest(F.lit(0.0), 10 - loss), 2)


def success_rate(done: C, total: C) -> Column:
    return F.when(_c(total) > 0, _c(done) / _c(total) * 100).otherwise(0.0)


def length_score(tokens: C, most: C | int = 300) -> Column:
    n, top = _c(tokens), F.lit(most) if isinstance(most, int) else _c(most)
    return first_match([(n.between(100, 250), 1.0), (((n >= 50) & (n < 100)) | ((n > 250) & (n <= top)), 0.8)], 0.5)


def word_set(c: C) -> Column:
    return F.array_distinct(F.filter(F.split(F.lower(filled(c)), "[ \\t\\n\\x0B\\f\\r]+"), lambda x: x != ""))


def jaccard(a: C, b: C) -> Column:
    """Shared part of two texts' words; 0 if either has none."""
    x, y = word_set(a), word_set(b)
    return F.when((F.size(x) == 0) | (F.size(y) == 0), 0.0).otherwise(F.size(F.array_intersect(x, y)) / F.size(F.array_union(x, y)))


def keywords_found(text: C, keywords: C) -> Column:
    low = F.lower(filled(text))
    return F.size(F.filter(_c(keywords), lambda k: low.contains(F.lower(k))))


def keyword_share(text: C, keywords: C) -> Column:
    size = F.size(_c(keywords))
    return F.when(size > 0, keywords_found(text, keywords) / size).otherwise(1.0)


def status(overall: C) -> Column:
    return first_match([(_c(overall) >= PASS, "pass"), (_c(overall) >= ACCEPTABLE, "acceptable")], "fail")


def grade(predicted: C, expected: C, keywords: C, citation_required: C | bool = True, most: C | int = 300) -> Column:
    """(accuracy, citation, length, token_count, keywords, overall, status) of an answer."""
    needed = F.lit(citation_required) if isinstance(citation_required, bool) else _c(citation_required)
    accuracy = jaccard(predicted, expected)
    citation = F.when(~needed | has_citation(predicted), 1.0).otherwise(0.0)
    length = length_score(token_count(predicted), most)
    share = keyword_share(predicted, keywords)
    overall = accuracy * WEIGHTS[0] + citation * WEIGHTS[1] + length * WEIGHTS[2] + share * WEIGHTS[3]
    return F.struct(
        accuracy.alias("accuracy"),
        citation.alias("citation"),
        length.alias("length"),
        token_count(predicted).alias("token_count"),
        share.alias("keywords"),
        overall.alias("overall"),
        status(overall).alias("status"),
    )
