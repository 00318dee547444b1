"""URL filters (operator 6): association rules over URL tokens.

FP-growth finds the token combinations of URLs labelled ``block``.  Those that imply the
label with enough confidence and support over all labelled rows are kept, without any that
holds a smaller kept one.  A rule is indexed by its rarest token; a URL looks up each of its
tokens in that inverted index and checks the few rules found for containment.  Explicit
host/path rules, of which the longest that fits wins, go before the mined ones.

Rules have up to ``LONGEST`` tokens.  A token that implies the label alone is a rule by its
counts.  All others that block rows hold often enough go into the search for sets, from rows of
any length.  So that a long URL doesn't make every subset of its tokens a frequent set,
FP-growth gets the tokens of a row in transactions of ``LONGEST`` parts of ``PART`` tokens, one
for each choice of parts: every set stands in one of them, and no set is much longer.  Such
transactions count a set more than once, so what FP-growth finds frequent are candidates (none
that is frequent is missing), whose supports and confidences are counted over whole rows.

Only DataFrame functions and the JVM's FP-growth are used.  Up to ``LOCAL`` sets are one
constant with the rules of one token, of which there are at most 1 / support for each token that
a row has on average, and scoring needs no shuffle.  If there are more, all sets stay a table,
and URLs are joined with it by tokens.

Defined results: a null URL, or one without ``://``, has an empty host and path and no
tokens, is fitted by no rule and allowed; rows without a label aren't mined; without
labelled rows or rules every URL that no explicit rule fits is allowed; repeated rows count
and are judged each; of explicit rules of equal length the last one given wins; an empty
table gives no rows; columns of the input named as an output column are replaced.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass
from itertools import combinations

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexmill.llm import scratch

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Tokens of a rule, tokens of a part of a transaction, and rules of several tokens that are held in a constant; more are a table.
LONGEST, PART, LOCAL = 3, 3, 1 << 15
#: A rule holds for so many rows at least, in tables however small.
ROWS = 2


def _rest(url: Column) -> Column:
    """What follows the first ``://``; empty without one."""
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))


def host(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(_rest(url), r"^[^/?#]*", 0), F.lit("")), UPPER, LOWER)


def path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def query(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(_rest(url), r"^[^?#]*\?([^#]*)", 1), F.lit(""))


def tokens(url: Column) -> Column:
    """Distinct tokens: words of the host, parts of the path (numbers alike) and keys of the query."""
    words = F.transform(F.regexp_extract_all(host(url), F.lit("[a-z0-9]+"), 0), lambda x: F.concat(F.lit("h:"), x))
    parts = F.transform(
        F.regexp_extract_all(F.translate(path(url), UPPER, LOWER), F.lit("[^/.]+"), 0),
        lambda x: F.concat(F.lit("p:"), F.regexp_replace(x, "[0-9]+", "0")),
    )
    keys = F.transform(F.regexp_extract_all(query(url), F.lit("(?:^|&)([^=&]+)"), 1), lambda x: F.concat(F.lit("q:"), x))
    return F.array_distinct(F.concat(words, parts, keys))


@dataclass(frozen=True)
class Rules:
    """Mined rules, with their confidence and support, and their index: by a hash of the rarest token.

    ``more`` has the rules of several tokens (rule, token, n, hits), ``token`` being the rarest, if they are too many for ``rules``.
    """

    rules: tuple[tuple[tuple[str, ...], float, float], ...] = ()
    buckets: tuple[tuple[tuple[str, ...], ...], ...] = ()
    more: DataFrame | None = None


def _transactions(rows: DataFrame, longest: int) -> DataFrame:
    """(items) of each ``longest`` parts of the tokens ``own`` of a row; all of them, if there are no more parts."""
    parts = F.transform(F.sequence(F.lit(0), F.size("own") - 1, F.lit(PART)), lambda i: F.struct(i.alias("at"), F.slice("own", i + 1, PART).alias("own")))
    # a choice at a time, so that no row holds all of them
    chosen = rows.where(F.size("own") > longest * PART).select(parts.alias("parts"), F.lit(-1).alias("at"), F.array().cast("array<string>").alias("items"))
    for _ in range(longest):
        chosen = chosen.withColumn("part", F.explode(F.expr("filter(parts, p -> p.at > at)")))
        chosen = chosen.select("parts", F.col("part.at").alias("at"), F.concat("items", "part.own").alias("items"))
    return rows.where(F.size("own") <= longest * PART).select(F.col("own").alias("items")).unionByName(chosen.select("items"))


def _candidates(rows: DataFrame, weak: DataFrame, least: int, longest: int) -> DataFrame | None:
    """(rule, token) of two tokens of ``weak`` (token, n) and more that may be frequent among the rows to block, by FP-growth; ``token`` is the rarest."""
    apart = rows.where("label").select(F.monotonically_increasing_id().alias("row"), "items").select("row", F.explode("items").alias("token"))
    own = apart.join(weak, "token", "left_semi").groupBy("row").agg(F.array_sort(F.collect_list("token")).alias("own"))
    deals = scratch.save(_transactions(scratch.save(own.where(F.size("own") > 1)), longest))
    if not (dealt := deals.count()):
        return None
    # half a row less, as FP-growth rounds the product with the number of transactions up
    found = FPGrowth(itemsCol="items", minSupport=min(1.0, (least - 0.5) / dealt)).fit(deals).freqItemsets
    sets = scratch.save(found.where(F.size("items").between(2, longest) & (F.col("freq") >= least)).select(F.array_sort("items").alias("rule")).distinct())
    return sets.select("rule", F.explode("rule").alias("token")).join(weak.select("token", "n"), "token").groupBy("rule").agg(F.min(F.struct("n", "token"))["token"].alias("token"))


def _smallest(sets: DataFrame, longest: int) -> DataFrame:
    """The sets (rule) without any that holds a smaller one of those that are left."""
    kept = sets.where(F.size("rule") == 2)
    for k in range(3, longest + 1):
        own = sets.where(F.size("rule") == k)
        parts = F.explode(F.array(*(F.array(*(F.get("rule", F.lit(i)) for i in some)) for j in range(2, k) for some in combinations(range(k), j))))
        holding = own.select("rule", parts.alias("part")).join(kept.select(F.col("rule").alias("part")), "part", "left_semi").select("rule").distinct()
        kept = kept.unionByName(own.join(holding, "rule", "left_anti"))
    return kept


def _counted(rows: DataFrame, candidates: DataFrame) -> DataFrame:
    """(rule, n, hits) of each candidate (token, rule): the rows that hold it, and those of them to block."""
    at = rows.select("items", "label", F.explode("items").alias("token")).join(candidates, "token")
    held = at.where(F.size(F.array_except("rule", "items")) == 0)
    return held.groupBy("rule").agg(F.count(F.lit(1)).alias("n"), F.count_if("label").alias("hits"))


def mine(labelled: DataFrame, url: str = "url", label: str = "label", support: float = 0.001, confidence: float = 0.8, without: Sequence[str] = (), longest: int = LONGEST) -> Rules:
    """The pruned rules; ``label`` is true for URLs to block.

    Tokens of ``without`` don't take part: those that the label was made of.
    """
    own = F.array_except(tokens(F.col(url)), F.array(*map(F.lit, without)).cast("array<string>"))
    rows = labelled.where(F.col(label).isNotNull()).select(own.alias("items"), F.col(label).alias("label"))
    total = rows.count()
    least = max(ROWS, -int(-support * total // 1))
    counts = rows.select(F.explode("items").alias("token"), "label").groupBy("token").agg(F.count(F.lit(1)).alias("n"), F.count_if("label").alias("hits"))
    counts = scratch.save(counts.where(F.col("hits") >= least))
    good = F.col("hits") >= confidence * F.col("n")
    found = [((r["token"],), r["n"], r["hits"], r["token"]) for r in counts.where(good).collect()]  # at most 1 / support
    more = None
    if longest > 1 and (candidates := _candidates(rows, counts.where(~good).select("token", "n"), least, longest)) is not None:
        placed = scratch.save(candidates)
        sets = scratch.save(_counted(rows, placed).where(good & (F.col("hits") >= least)).join(placed, "rule"))
        more = scratch.save(_smallest(sets, longest))
        if more.count() <= LOCAL:
            found += [(tuple(r["rule"]), r["n"], r["hits"], r["token"]) for r in more.collect()]
            more = None
    found = sorted(found, key=lambda r: (len(r[0]), r[0]))
    size = max(1, 2 * len(found))
    spark = labelled.sparkSession
    at = {r["token"]: r["at"] for r in spark.createDataFrame([(t,) for t in {r[3] for r in found}], "token string").select("token", _bucket(F.col("token"), size).alias("at")).collect()}
    buckets: list[list[tuple[str, ...]]] = [[] for _ in range(size)]
    for rule, _, _, token in found:
        buckets[at[token]].append(rule)
    return Rules(tuple((rule, hits / n, hits / total) for rule, n, hits, _ in found), tuple(map(tuple, buckets)), more)


def _bucket(token: Column, size: int) -> Column:
    return F.pmod(F.xxhash64(token), F.lit(size)).cast("int")


def matches(url: Column, mined: Rules) -> Column:
    """Whether a mined rule's tokens are all among the URL's."""
    if not mined.rules:
        return F.lit(False)
    own = tokens(url)
    index = F.from_json(F.lit(json.dumps(mined.buckets)), "array<array<array<string>>>")
    return F.exists(own, lambda t: F.exists(F.get(index, _bucket(t, len(mined.buckets))), lambda r: F.size(F.array_except(r, own)) == 0))


def explicit(url: Column, rules: Sequence[tuple[str, str]]) -> tuple[Column, Column]:
    """The longest fitting of the (``host/path``, verdict) rules and its verdict, or nulls.

    A rule fits its host and all subdomains, if the URL's path starts with the rule's.
    """
    h, p = host(url), path(url)
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for text, said in sorted(rules, key=lambda x: len(x[0])):
        name, slash, rest = text.partition("/")
        fits = ((h == name) | h.endswith(f".{name}")) & p.startswith(slash + rest)
        rule, verdict = F.when(fits, F.lit(text)).otherwise(rule), F.when(fits, F.lit(said)).otherwise(verdict)
    return rule, verdict


def judge(urls: DataFrame, mined: Rules, rules: Sequence[tuple[str, str]] = (), url: str = "url") -> DataFrame:
    """Adds ``host``, ``path``, ``rule`` and ``verdict`` (allow or block)."""
    rule, said = explicit(F.col(url), rules)
    block, given = F.coalesce(matches(F.col(url), mined), F.lit(False)), urls.columns
    if mined.more is not None:
        # each URL once, and its rows by it
        own = urls.select(F.col(url).alias("__url")).distinct().withColumn("__own", tokens(F.col("__url")))
        found = own.withColumn("token", F.explode("__own")).join(mined.more.select("token", "rule"), "token").where(F.size(F.array_except("rule", "__own")) == 0).select("__url").distinct()
        urls = urls.join(found, F.col(url) == F.col("__url"), "left")
        block = block | F.col("__url").isNotNull()
    own = F.when(block, F.lit("block")).otherwise(F.lit("allow"))
    judged = {"host": host(F.col(url)), "path": path(F.col(url)), "rule": rule, "verdict": F.coalesce(said, own)}
    return urls.withColumns(judged).select(*given, *(c for c in judged if c not in given))
