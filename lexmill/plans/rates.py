"""VAT rates from the blocks of a page."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexmill.functions import extract as X
from lexmill.functions.text import any_of, validity_dates

PUBLISHER = "Skatteetaten"


def _rates(rows: DataFrame, kept: list[str], percent_text: Column, percent: Column, description: Column, dates: Column | None, part: int) -> DataFrame:
    named = rows.select(*kept, "ord", F.lit(part).alias("part"), percent_text.alias("percent_text"), percent.alias("percentage"), description.alias("text"), (dates if dates is not None else F.struct(F.lit(None).cast("string").alias("valid_from"), F.lit(None).cast("string").alias("valid_to"))).alias("dates"))
    named = named.where("percentage is not null").withColumn("category", X.rate_category("text"))
    return named.select(
        *kept,
        "part",
        "ord",
        X.rate_kind("text").alias("kind"),
        F.concat("percent_text", F.lit("%")).alias("value"),
        "percentage",
        F.col("dates.valid_from").alias("valid_from"),
        F.col("dates.valid_to").alias("valid_to"),
        X.rate_description("text", "percent_text", "category").alias("description"),
        "category",
        X.rate_applies_to("category").alias("applies_to"),
        X.rate_exceptions("text").alias("exceptions"),
        X.rate_notes("text").alias("notes"),
        F.lit(PUBLISHER).alias("publisher"),
        F.lit(True).alias("is_current"),
    )


def header_like(cell: Column) -> Column:
    """Whether a first cell looks like a header; "sats" in a data row does too."""
    return any_of(cell, *X.RATE_HEADERS)


def rates(blocks: DataFrame, iso_dates: bool = False, skip_headers: bool = True) -> DataFrame:
    """A row per rate: of table rows, of blocks whose class speaks of rates and of links to rates.

    ``iso_dates`` reads dates that begin with the year; ``skip_headers`` can be turned off,
    as it also drops data rows that name a rate.
    """
    kept = [c for c in blocks.columns if c not in _BLOCK_COLUMNS]
    rows = blocks.where("kind = 'table_row' and size(cells) >= 2")
    if skip_headers:
        rows = rows.where(~header_like(F.get("cells", F.lit(0))))
    cell = X.rate_of_cells("cells")
    tables = _rates(rows, kept, cell["percent_text"], cell["percent"], cell["description"], validity_dates("cells", iso_dates), 0)
    texts = blocks.where("kind = 'rate_block'").where(any_of("text", "%", "prosent", "sats", "merverdiavgift"))
    texts = _rates(texts, kept, X.percent_text("text"), X.percent("text"), X.percent_context("text"), None, 1)
    links = blocks.where("kind = 'rate_link' and context is not null").where(any_of("text", "sats", "rate", "mva"))
    links = _rates(links, kept, X.percent_text("context"), X.percent("context"), X.percent_context("context"), None, 2)
    return tables.unionByName(texts).unionByName(links)


_BLOCK_COLUMNS = frozenset("kind ord part tag node_id heading text text_plain context raw chapter headers cells attrs error".split())


def silver(rates: DataFrame) -> DataFrame:
    """Rates with the fields that the declared schema asks for."""
    ident = F.concat_ws("_", F.lit("rate"), F.col("kind"), F.regexp_replace("value", "[^0-9.]", ""), F.col("part").cast("string"), F.col("ord").cast("string"))
    return rates.withColumns(
        {
            "rate_id": ident,
            "rate_label": F.concat_ws(" ", F.initcap("kind"), F.col("value")),
            "rate_value": F.col("percentage"),
            "effective_from": F.coalesce("valid_from", F.lit("")),
            "effective_to": F.col("valid_to"),
            "domain": F.lit("tax"),
            "source_type": F.lit("rates"),
            "jurisdiction": F.lit("NO"),
            "last_updated": F.current_timestamp().cast("string"),
        }
    )
