"""Queries and the pipeline on the smallest tables, against SQL twins and plain versions."""

from __future__ import annotations

import hashlib
import re
import zlib
from pathlib import Path

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from lexmill.llm import minhash, queries, scratch, secrets

DATA = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not DATA.exists(), reason="no test tables")
SPLIT = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def texts():
    return dict(duckdb.sql(f"select doc_id, text from '{DATA}/documents.parquet'").fetchall())


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_oracles(spark, name):
    con = duckdb.connect()
    for path in DATA.glob("*.parquet"):
        con.sql(f"create view {path.stem} as select * from '{path}'")
    got = queries.QUERIES[name](spark, str(DATA))
    want = con.sql(queries.ORACLES[name])
    order = sorted(got.columns)
    assert sorted(want.columns) == order
    at = [want.columns.index(c) for c in order]
    assert sorted((tuple(r[c] for c in order) for r in got.collect()), key=repr) == sorted((tuple(r[i] for i in at) for r in want.fetchall()), key=repr)


def test_substring_query(spark, texts):
    first: dict[tuple, int] = {}
    got = {r["doc_id"]: r for r in queries.op3_substring_dedup(spark, str(DATA)).collect()}
    for i in sorted(texts):
        w = SPLIT.findall(texts[i] or "")
        gone = [False] * len(w)
        for k in range(len(w) - 12):
            if first.setdefault(tuple(w[k : k + 13]), i) < i:
                gone[k : k + 13] = [True] * 13
        kept = " ".join(x for x, g in zip(w, gone, strict=True) if not g)
        assert (got[i]["n_words"], got[i]["n_removed"], got[i]["kept_sha256"]) == (len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest())


def near_copies(texts, shingle):
    sets = {}
    for i, t in texts.items():
        w = SPLIT.findall(re.sub("[A-Z]+", lambda m: m[0].lower(), t or ""))
        sets[i] = {tuple(w[k : k + shingle]) for k in range(max(1, len(w) - shingle + 1))} if w else set()
    parent = {i: i for i in sets}

    def root(a):
        while parent[a] != a:
            a = parent[a]
        return a

    own = sorted(sets)
    for n, i in enumerate(own):
        for j in own[:n]:
            k = len(sets[i] & sets[j])
            if k and 100 * k >= 80 * (len(sets[i]) + len(sets[j]) - k):
                a, b = sorted((root(i), root(j)))
                parent[b] = a
    return sets, {i: root(i) for i in sets}


def test_near_dedup_query(spark, texts):
    sets, roots = near_copies(texts, 4)
    for r in queries.op4_near_dedup(spark, str(DATA)).collect():
        i = r["doc_id"]
        assert (r["n_shingles"], r["component_id"], r["kept"]) == (len(sets[i]), roots[i], roots[i] == i)


def test_decontamination_query(spark, texts):
    items = {i: SPLIT.findall((t or "").lower()) for i, t in duckdb.sql(f"select item_id, text from '{DATA}/benchmark.parquet'").fetchall()}
    grams: dict[tuple, set] = {}
    for i, w in items.items():
        for k in range(len(w) - 7):
            grams.setdefault(tuple(w[k : k + 8]), set()).add(i)
    want = {}
    for i, t in texts.items():
        w = SPLIT.findall((t or "").lower())
        if found := set().union(*(grams.get(tuple(w[k : k + 8]), set()) for k in range(len(w) - 7))):
            want[i] = found
    got = {r["doc_id"]: r["item_id"] for r in queries.op5_decontamination(spark, str(DATA)).collect()}
    assert set(got) == set(want) and all(got[i] in want[i] for i in got)


def test_vector_query(spark):
    rows = duckdb.sql(f"select vec_id, embedding from '{DATA}/embeddings.parquet'").fetchall()
    ids, x = np.array([r[0] for r in rows]), np.array([r[1] for r in rows], float)
    u = x / np.linalg.norm(x, axis=1)[:, None]
    got: dict[int, list] = {}
    for r in queries.op7_vector_search(spark, str(DATA)).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    hit = 0
    for k in np.flatnonzero(ids % 50 == 0):
        found = sorted(got[int(ids[k])])
        assert [r for r, *_ in found] == [1, 2, 3, 4, 5] and found == [(i + 1, *x[1:]) for i, x in enumerate(sorted(found, key=lambda x: (-x[2], x[1])))]
        d = u @ u[k]
        assert all(v != ids[k] and abs(score - d[np.flatnonzero(ids == v)[0]]) < 1e-9 for _, v, score in found)
        d[k] = -9
        hit += len(set(ids[np.lexsort((ids, -d))[:5]].tolist()) & {v for _, v, _ in found})
    assert len(got) == (ids % 50 == 0).sum() and hit >= 0.9 * 5 * len(got)


def test_secret_query(spark, tmp_path):
    """The query against plain patterns, also over texts that hold every kind."""
    good = "ghp_" + "a" * 30
    crc, tail = zlib.crc32(b"a" * 30), ""
    for _ in range(6):
        crc, digit = divmod(crc, 62)
        tail = secrets._B62[digit] + tail
    rows = [(1, f'x {good}{tail} token = "{"0a" * 20}"'), (2, None), (3, ""), (4, "AKIA" + "A" * 16 + " passwd: hunter2 é secret=12345"), (4, "passKword token: abcdefg"), (None, "API_KEY='k1234567'")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    patterns = {
        "assign": (r"""(?ia)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
        "access": ("AKIA[A-Z0-9]+", 0, 20),
        "hex": ("[0-9a-f]+", 0, 24),
    }
    for folder in (DATA, tmp_path):
        got = queries.op8_secret_scan(spark, str(folder)).collect()
        given = duckdb.sql(f"select doc_id, text from read_parquet('{folder}/documents.parquet{'' if folder == DATA else '/*.parquet'}')").fetchall()
        want = []
        for i, t in given:
            base = [(kind, *m.span()) for kind, (p, group, least) in patterns.items() for m in re.finditer(p, t or "") if len(m[group]) >= least]
            base.sort(key=lambda x: (x[1], list(patterns).index(x[0])))
            count = [sum(x[0] == kind for x in base) for kind in patterns]
            want.append((i, *count, hashlib.sha256(",".join(":".join(map(str, x)) for x in base).encode()).hexdigest()))
        assert sorted((tuple(r)[:5] for r in got), key=repr) == sorted(want, key=repr)
    assert {r["doc_id"]: r["spans"] for r in got}[1].startswith("forge:2:42,hex:6:37,assign:43:")


def plain_scores(texts, labels):
    """Regularised quadratic discriminant, text by text and without any of the operator's code."""

    def statistics(text):
        raw, words_ = (text or "").encode(), [x for x in SPLIT.findall(text or "")]
        triples = [tuple(words_[i : i + 3]) for i in range(len(words_) - 2)]
        part = lambda x: np.log((len(x) - len(set(x)) + 0.5) / (len(x) + 20))
        rate = lambda chars: np.log((sum(c in chars for c in raw) + 0.5) / (len(raw) + 20))
        groups = (range(0x41, 0x5B), range(0x30, 0x3A), b"!?", b"#$%&*+<=>@[\\]^_`{|}~/", b".,;:'\"()-", range(0x80, 0x100))
        return [np.log1p(len(words_)), np.log((len(raw) + 5) / (len(words_) + 1)), *(rate(set(g)) for g in groups), part(words_), part(triples), np.log1p(len(words_) / (raw.count(b"\n") + 1))]

    x = {i: np.array(statistics(t)) for i, t in texts.items()}
    classes = [np.array([x[i] for i, k in labels if k == c and i in x]) for c in (0, 1)]
    n = [len(c) for c in classes]
    covs = [np.cov(c.T, bias=True) for c in classes]
    pooled = sum(c * k for c, k in zip(covs, n, strict=True)) / sum(n)
    scale = np.sqrt(np.diag(pooled))
    out = {}
    for i, v in x.items():
        density = []
        for own, cov in zip(classes, covs, strict=True):
            shrunk = 0.98 * (0.65 * cov + 0.35 * pooled) / np.outer(scale, scale) + 0.02 * np.eye(len(v))
            z = (v - own.mean(axis=0)) / scale
            density.append(-0.5 * z @ np.linalg.solve(shrunk, z) - 0.5 * np.linalg.slogdet(shrunk)[1])
        out[i] = 1 / (1 + np.exp(-np.clip(np.log(n[1] / n[0]) + density[1] - density[0], -500, 500)))
    return out


def taught(labels):
    return [(i, k) for i, k in labels if zlib.crc32(str(i).encode()) % 3 != 1]


def test_quality_query(spark, texts):
    want = plain_scores(texts, taught(duckdb.sql(f"select doc_id, quality from '{DATA}/labels.parquet'").fetchall()))
    got = {r["doc_id"]: r for r in queries.op10_quality(spark, str(DATA)).collect()}
    assert set(got) == set(want)
    for i, r in got.items():
        assert abs(r["score"] - want[i]) < 1e-6 and r["predicted"] == int(r["score"] >= 0.5) and r["held_out"] == (zlib.crc32(str(i).encode()) % 3 == 1)


def test_held_out_accuracy(spark):
    labels = spark.read.parquet(f"{DATA}/labels.parquet")
    got = queries.op10_quality(spark, str(DATA)).join(labels, "doc_id").where("held_out").collect()
    assert len(got) > 10 and sum(r["predicted"] == r["quality"] for r in got) >= 0.9 * len(got)


def test_mix_query(spark):
    rows = queries.op2_source_mix(spark, str(DATA)).collect()
    at = {r["slot"]: r["source"] for r in rows}
    assert sorted(at) == list(range(len(at)))
    sources, seen = sorted({r["source"] for r in rows}), dict.fromkeys({r["source"] for r in rows}, 0)
    total = {s: list(at.values()).count(s) for s in sources}
    for t in range(len(at)):
        seen[at[t]] += 1
        assert all(abs(n - (t + 1) / len(sources)) < 1 for n in seen.values())
        if any(seen[s] == total[s] for s in sources):
            break


def test_pipeline(spark, texts):
    """Each stage against a plain version over what the stage before it kept."""
    columns = spark.read.parquet(f"{DATA}/documents.parquet").columns
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    benchmark = [SPLIT.findall((t or "").lower()) for (t,) in duckdb.sql(f"select text from '{DATA}/benchmark.parquet'").fetchall()]
    for name, stage in corpus_pipeline.STAGES:
        before = {r["doc_id"]: r["text"] for r in docs.collect()}
        docs = scratch.save(stage(spark, docs, str(DATA)))
        after = {r["doc_id"]: r["text"] for r in docs.collect()}
        assert set(after) <= set(before)
        if name != "mixing":
            assert docs.columns == columns
        if name == "quality":
            scores = plain_scores(before, taught(duckdb.sql(f"select doc_id, quality from '{DATA}/labels.parquet'").fetchall()))
            assert set(after) == {i for i, s in scores.items() if s >= 0.5}
        elif name == "near_dedup":
            roots = near_copies(before, 5)[1]
            assert set(after) == {i for i in before if roots[i] == i}
        elif name == "decontamination":
            grams = {tuple(w[k : k + 8]) for w in benchmark for k in range(len(w) - 7)}
            leaked = {i for i, t in before.items() if any(tuple(w[k : k + 8]) in grams for w in [SPLIT.findall((t or "").lower())] for k in range(len(w) - 7))}
            assert set(before) - set(after) == leaked
        elif name == "secrets":
            assert set(after) == set(before) and all(after[i] == before[i] for i in before if not secrets.find(before[i]))
            assert all(not secrets.find(t) for t in after.values())
        else:
            assert after == before
    got = corpus_pipeline.run(spark, str(DATA))
    assert got.drop("slot", "block", "place").exceptAll(docs.drop("slot", "block", "place")).count() == 0 and got.count() == docs.count()
    scratch.release(spark)


def test_stages_take_nulls_and_empty_tables(spark, tmp_path):
    for t in ("labels", "benchmark"):
        spark.read.parquet(f"{DATA}/{t}.parquet").write.parquet(str(tmp_path / f"{t}.parquet"))
    docs = spark.read.parquet(f"{DATA}/documents.parquet").limit(40)
    docs = docs.withColumns({"text": F.when(F.col("doc_id") % 5 == 0, None).otherwise(F.col("text")), "source": F.when(F.col("doc_id") % 3 == 0, None).otherwise(F.col("source")), "doc_id": F.when(F.col("doc_id") % 7 == 0, None).otherwise(F.col("doc_id"))})
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, str(tmp_path)).count() > 0
        assert stage(spark, docs.limit(0), str(tmp_path)).count() == 0
    assert minhash.link_components(docs).count() == 40


def test_stages_take_repeats_clashes_and_long_texts(spark, tmp_path):
    for t in ("labels", "benchmark"):
        spark.read.parquet(f"{DATA}/{t}.parquet").write.parquet(str(tmp_path / f"{t}.parquet"))
    docs = spark.read.parquet(f"{DATA}/documents.parquet").limit(60)
    long = F.concat(F.repeat(F.lit("eyJ<div>"), 100_000), F.lit(" "), F.repeat(F.lit("lorem ipsum "), 50_000))
    docs = docs.unionByName(docs).unionByName(docs.limit(2).withColumns({"doc_id": F.lit(7_000_000_000), "text": long}))
    clashes = ("id", "hash", "score", "predicted", "share", "item_id", "contaminated", "spans", "kept", "slot", "start", "key", "rng", "rank", "__own", "a b")
    docs = docs.withColumns({c: F.lit("mine") for c in clashes})
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, str(tmp_path))
        assert set(docs.columns) <= set(out.columns) and out.count() > 0
        if name != "mixing":
            assert out.columns == docs.columns and out.where("`a b` <> 'mine' or score <> 'mine' or share <> 'mine'").count() == 0


def test_near_dedup_of_rows_of_one_id(spark, tmp_path):
    words_ = [f"w{i}" for i in range(60)]
    rows = [(1, " ".join(words_)), (1, " ".join(words_)), (1, "another text of the same id that is like no other one"), (2, " ".join(words_[:59])), (0, "x " * 30), (None, " ".join(words_))]
    out = corpus_pipeline.near_dedup(spark, spark.createDataFrame(rows, "doc_id long, text string").withColumn("lang", F.lit("en")), "")
    assert sorted((tuple(r)[:2] for r in out.collect()), key=repr) == sorted([rows[0], rows[2], rows[4], rows[5]], key=repr)


def test_main_text_of_pages_without_an_article(spark, monkeypatch):
    """The given pages with nameless containers for article and menu: what the ratios tell apart."""
    from lexmill.llm import htmltext

    pages = spark.read.parquet(str(DATA / "pages.parquet"))
    plain = F.regexp_replace("html", "<(/?)(?:article|nav)>", "<$1div>")
    want = {r["page_id"]: r["text"] for r in htmltext.extract_text(pages).collect()}
    got = {r["page_id"]: r["text"] for r in htmltext.extract_text(pages.withColumn("html", plain)).collect()}
    same = sum(got[i] == want[i] for i in want)
    assert same >= 0.95 * len(want)
    assert all(want[i] in got[i] for i in want)
    texts = [r["h"] for r in pages.select(plain.alias("h")).collect()]
    true = [htmltext.extract(x) for x in texts]
    for some in (lambda lines, *_: np.ones(len(lines), bool), lambda lines, *_: np.arange(len(lines)) % 7 == 0):
        monkeypatch.setattr(htmltext, "content_lines", some)
        assert sum(htmltext.extract(x) != t for x, t in zip(texts, true, strict=True)) > 0.5 * len(texts)
