"""Collocations, archives and importance resampling against plain versions, on small tables with nulls, empty and very long texts, ties, repeated rows and clashing columns."""

from __future__ import annotations

import base64
import gzip
import hashlib
import math
import random
import re
import zlib
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lexmill.llm import collocations, importance, scratch, warc

QUICK = settings(max_examples=25, deadline=None, suppress_health_check=list(HealthCheck))
LONG = " ".join(f"lang{i % 977}ord{i % 13}" for i in range(60_000))


# --- collocations --------------------------------------------------------------------------


PIECES, WORD = re.compile(r"[.,;:!?\x0A-\x0D]"), re.compile(r"[^\x20\x09]+")


def plain_collocations(rows, least, longest, top):
    grams, totals = {}, {}
    for lang, text in rows:
        lang = "und" if lang is None else lang
        low = re.sub("[A-Z]+", lambda m: m[0].lower(), text or "")
        for piece in PIECES.split(low):
            w = WORD.findall(piece)
            totals[lang] = totals.get(lang, 0) + len(w)
            for k in range(1, longest + 1):
                for i in range(len(w) - k + 1):
                    key = (lang, tuple(w[i : i + k]))
                    grams[key] = grams.get(key, 0) + 1
    out = {}
    frequent = {key: f for key, f in grams.items() if len(key[1]) > 1 and f >= least}
    for (lang, words_), a in frequent.items():
        m = len(words_)
        if any(g == lang and len(x) > m and f >= a and any(x[i : i + m] == words_ for i in range(len(x) - m + 1)) for (g, x), f in frequent.items()):
            continue
        cuts = [(1000 * a * totals[lang] // (grams[lang, words_[:k]] * grams[lang, words_[k:]]), k) for k in range(1, m)]
        score, k = min(cuts)
        out.setdefault(lang, []).append((-score, -a, " ".join(words_).encode(), grams[lang, words_[:k]], grams[lang, words_[k:]]))
    return {(lang, i + 1, p.decode(), -a, l, r, totals[lang], -s) for lang, rows in out.items() for i, (s, a, p, l, r) in enumerate(sorted(rows)[:top])}


def test_collocations_equal_a_plain_count(spark):
    rng = random.Random(5)
    vocabulary = ["a", "B", "cc", "Dé", "日本", "a-b", "x" * 300, "of"]
    rows = [(rng.choice(["en", "fr", None, "und", ""]), "".join(rng.choice(vocabulary) + rng.choice([" ", " ", " ", "\t ", ". ", ",", "\n", "\x0b"]) for _ in range(rng.randrange(80)))) for _ in range(120)]
    rows += [("en", None), ("en", ""), (None, " \t"), ("en", "a a a a a a a a"), ("en", "...")] + [("fr", "no place like home . no place like home")] * 7
    docs = spark.createDataFrame(rows, "lang string, text string").selectExpr("lang", "text", "1 as n", "2 as phrase", "3 as part")
    for top, width in ((15, 1 << 27), (1000, 64)):  # the second sketch admits everything
        got = collocations.mine(docs, least=6, longest=5, top=top, width=width)
        assert {tuple(r) for r in got.collect()} == plain_collocations(rows, 6, 5, top)
    assert {tuple(r) for r in collocations.mine(docs, least=9, longest=2, top=9).collect()} == plain_collocations(rows, 9, 2, 9)
    assert collocations.mine(docs.limit(0)).collect() == []


def test_collocations_of_long_texts_and_great_counts(spark):
    long = ", ".join(f"red car{i % 5} is not here" for i in range(90_000))
    got = {tuple(r) for r in collocations.mine(spark.createDataFrame([("en", long)] * 3, "lang string, text string"), least=100, top=50).collect()}
    assert got == plain_collocations([("en", long)] * 3, 100, 5, 50)
    # products beyond 64 bits stay exact
    a, n, left, right = 9_999_999_999_991, 99_999_999_999_973, 77_777_777_777_777, 9_999_999_999_993
    row = spark.range(1).select(F.call_function("div", collocations._exact(F.lit(1000), F.lit(a), F.lit(n)), collocations._exact(F.lit(left), F.lit(right))).cast("long").alias("v")).first()
    assert row["v"] == 1000 * a * n // (left * right)


def test_sketches_never_fall_short(spark):
    rows = [(f"w{i % 50} v{i % 7} u{i % 3}", "en") for i in range(2100)]
    texts = spark.createDataFrame(rows, "text string, lang string").repartition(3)
    bits = collocations.sketch(texts, 40, 3, None, 1 << 12)
    own = collocations._Words(pa.array([t for t, _ in rows]), pa.array([g for _, g in rows]))
    for length in (1, 2):
        at = np.flatnonzero(own.pairs()) if length == 2 else np.arange(len(own.starts))
        counters = own.counters(at, length, 1 << 12)
        text = [tuple(bytes(own.raw[own.starts[i + k] : own.ends[i + k]]) for k in range(length)) for i in at.tolist()]
        heavy = collocations._heavy(bits, counters)
        often = {p for p in set(text) if text.count(p) >= 40}
        assert often and all(h for p, h in zip(text, heavy.tolist(), strict=True) if p in often)


# --- WARC ----------------------------------------------------------------------------------


PAGES = [
    (1, "http://www.example.org/a?b=1#c", "<p>one</p>"),
    (2, "https://example.org/", "<p>one</p>"),
    (3, "https://Example.org:8080/x y\r\nz", "<p>é日</p>"),
    (4, None, None),
    (5, "nothing", ""),
    (6, "http://www.example.org/a?b=1#d", "z" * 300_000),
    (6, "http://www.example.org/a?b=1#d", "another"),
    (7, "http://q/", "same"),
    (7, "http://q/", "same"),
    (7, "http://q/", "same"),
    (None, "http://q/", "same"),
    (None, "http://r/", "alone"),
    (None, "http://r/", "pair"),
    (None, "http://s/", "pair"),
    (-9, "http://q/", "<p>one</p>"),
]


def plain_records(rows, least):
    by = {}
    for page, url, html in rows:
        by.setdefault(html or "", []).append((page is not None, page or 0, url is not None, url or ""))
    out = []
    for payload, own in by.items():
        raw = payload.encode()
        sha1 = base64.b32encode(hashlib.sha1(raw).digest()).decode()
        own.sort(reverse=True)
        for i, (known, page, *_) in enumerate(own):
            first = i == 0 or len(raw) < least
            out.append((page if known else None, len(raw), sha1, "response" if first else "revisit", None if first or not own[0][0] else own[0][1]))
    return sorted(out, key=repr)


@pytest.mark.parametrize(("least", "block", "file_bytes"), [(0, 1, 200), (5, 3, 1 << 20)])
def test_warc_is_read_back_by_its_index(spark, least, block, file_bytes):
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string").repartition(3).withColumns({c: F.lit("mine") for c in ("sha1", "first", "copy", "rows", "file", "key")})
    archive = warc.write(pages, least=least, block=block, file_bytes=file_bytes)
    back = warc.read(archive, warc.find(archive, pages), payload=True).collect()
    assert sorted((tuple(r)[0:1] + tuple(r)[2:6] for r in back), key=repr) == plain_records(PAGES, least)
    texts = {(warc.clean(u), warc.digest((h or "").encode())): (h or "").encode() for _, u, h in PAGES}
    assert all(bytes(r["payload"]) == texts[r["url"], r["payload_digest"]] for r in back if r["record_type"] == "response")
    # single pages, with some that were never captured
    asked = spark.createDataFrame([(u, p) for p, u, _ in PAGES[:3]] + [("http://no/", 1), ("http://www.example.org/a?b=1", 99), ("", None)], "url string, page_id long")
    assert sorted(r["page_id"] for r in warc.read(archive, warc.find(archive, asked)).collect()) == [1, 2, 3]


def test_warc_files_are_plain_archives(spark):
    pages = spark.createDataFrame([(i, f"http://h{i % 3}.example.org/{i}", f"<p>{i % 5}</p>") for i in range(40)], "page_id long, url string, html string")
    archive = warc.write(pages.coalesce(1), file_bytes=4000)
    folder = Path(archive.folder.removeprefix("file://"))
    files = sorted(folder.glob("*.warc.gz"))
    assert len(files) > 1 and len(list(folder.glob("*.cdx.gz"))) == len(archive.shards)
    kinds = [x for f in files for x in re.findall(rb"WARC-Type: (\w+)", gzip.decompress(f.read_bytes()))]
    assert (kinds.count(b"warcinfo"), kinds.count(b"response"), kinds.count(b"revisit")) == (len(files), 5, 35)
    places = warc.find(archive, pages).collect()
    assert len(places) == 40 and [r["key"] for r in places] == sorted(r["key"] for r in places)
    empty = warc.write(pages.limit(0))
    assert empty.shards == () and warc.read(empty, warc.find(empty, pages)).collect() == []


def test_a_damaged_record_is_noticed():
    data = warc.member(1, "http://a/", warc.digest(b"abc"), 3, b"abc")
    assert warc.parse(data)["payload"] == b"abc" and warc.url_key("https://U@b.C.org:1/p?q#r") == "org,c,b)/p?q"
    with pytest.raises(ValueError, match="digest"):
        warc.parse(warc.member(1, "http://a/", warc.digest(b"abd"), 3, b"abc"))


# --- importance resampling -----------------------------------------------------------------


def plain_sample(rows, target, percent, longest, n_buckets, seed, min_words):
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")

    def features(text):
        w = word.findall(re.sub("[A-Z]+", lambda m: m[0].lower(), text or ""))
        return len(w), [zlib.crc32(" ".join(w[i : i + k]).encode()) % n_buckets for k in range(1, longest + 1) for i in range(len(w) - k + 1)]

    own, aim = [features(t) for _, t in rows], [b for t in target for b in features(t)[1]]
    s, t = [0] * n_buckets, [0] * n_buckets
    for b in (b for _, f in own for b in f):
        s[b] += 1
    for b in aim:
        t[b] += 1
    gain = [math.floor(1000 * math.log((t[b] + 1) * (sum(s) + n_buckets) / ((s[b] + 1) * (sum(t) + n_buckets)))) for b in range(n_buckets)]
    out, able = [], []
    for (i, _), (n_words, f) in zip(rows, own, strict=True):
        weight = sum(gain[b] for b in f) // len(f) if f else 0
        score = None
        if i is not None:
            h = int(hashlib.sha256(f"{seed}:{i}".encode()).hexdigest()[:8], 16)
            score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        row = [i, len(f), weight, score, None]
        out.append(row)
        if score is not None and n_words >= min_words:
            able.append(row)
    able.sort(key=lambda r: (-r[3], r[0], r[2], r[1]))
    for k, row in enumerate(able[: percent * len(able) // 100]):
        row[4] = k + 1
    return sorted(map(tuple, out), key=repr)


@pytest.mark.parametrize(("percent", "longest"), [(10, 1), (37, 3), (100, 2), (0, 1)])
def test_importance_equals_a_plain_draw(spark, percent, longest):
    rng = random.Random(percent)
    vocabulary = ["a", "B", "cc", "Dé", "日本", "x-y", "9", "w" * 200, "of_the"]
    rows = [(rng.choice([i, -i, i << 40]), " ".join(rng.choice(vocabulary) for _ in range(rng.randrange(60)))) for i in range(150)]
    rows += [(7, "a a a a a"), (7, "a a a a a"), (7, "a a a a a"), (None, "b " * 30), (8, None), (9, ""), (10, LONG), (-(1 << 63), "a b c d e f"), ((1 << 63) - 1, "a b c d e f")]
    target = ["a cc of the", "Dé日本 9", None]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5).withColumns({c: F.lit("mine") for c in ("id", "rank", "weight", "at", "part")})
    got = importance.resample(docs, spark.createDataFrame([(t,) for t in target], "text string"), percent, longest, 97, 5, 4)
    assert sorted((tuple(r[c] for c in ("doc_id", "n_features", "weight", "score", "rank")) for r in got.collect()), key=repr) == plain_sample(rows, target, percent, longest, 97, 5, 4)


def test_importance_of_equal_rows_and_empty_tables(spark):
    rows = [(1, "a b c d")] * 25 + [(2, "a b c d")] * 5
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    target = spark.createDataFrame([("a b",)], "text string")
    for percent in (10, 50, 90):
        got = importance.resample(docs, target, percent, min_words=2).collect()
        assert sorted((tuple(r[c] for c in ("doc_id", "n_features", "weight", "score", "rank")) for r in got), key=repr) == plain_sample(rows, ["a b"], percent, 1, 10_000, 2024, 2)
    assert importance.resample(docs.limit(0), target).collect() == []
    assert {r["rank"] for r in importance.resample(docs, target.limit(0), min_words=9).collect()} == {None}


@QUICK
@given(st.lists(st.integers(-(1 << 63), (1 << 63) - 1) | st.integers(-3, 3), min_size=1, max_size=30), st.data())
def test_the_bits_of_a_key_are_in_its_order(values, data):
    for ascending in (True, False):
        assert sorted(values, reverse=not ascending) == [importance._as_value(b, ascending) for b in sorted(importance._as_bits(v, ascending) for v in values)]


def test_kth_key(spark):
    rng = random.Random(3)
    rows = [(rng.choice([-(1 << 62), 0, 5, 1 << 61, rng.randrange(100)]), rng.randrange(-4, 4)) for _ in range(300)]
    table = scratch.save(spark.createDataFrame(rows, "x long, y long"))
    order = sorted(rows, key=lambda r: (-r[0], r[1]))
    ranges = [(min(c), max(c)) for c in zip(*rows, strict=True)]
    for k in (1, 2, 57, 150, 299, 300):
        values, alike, taken = importance.kth_key(table, (("x", False), ("y", True)), ranges, k, digit=5)
        assert tuple(values) == order[k - 1][: len(values)]
        same = [i for i, r in enumerate(order) if r[: len(values)] == tuple(values)]
        assert alike == len(same) and taken == k - same[0]


def test_checksums_of_runs():
    texts = ["Ab  c-d é9", None, "", "x" * 500 + " y", "日本 z" * 40]
    for longest in (1, 4):
        found, owner, counts = importance.buckets(pa.array(texts), longest, 1 << 20)
        word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
        for i, t in enumerate(texts):
            w = word.findall(re.sub("[A-Z]+", lambda m: m[0].lower(), t or ""))
            want = [zlib.crc32(" ".join(w[j : j + k]).encode()) % (1 << 20) for k in range(1, longest + 1) for j in range(len(w) - k + 1)]
            assert counts[i] == len(w) and sorted(found[owner == i].tolist()) == sorted(want)
