"""Operators that take the place of what one task, one driver or a whole history would do: against plain versions."""

from __future__ import annotations

import json
import random
import time
from collections import Counter
from datetime import date, datetime, timedelta

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexmill.operators import profile, quality, rules, temporal, tree
from lexmill.operators.checkstate import CheckState
from lexmill.operators.textindex import TextIndex
from lexmill.plans import gold
from lexmill.sources import files, html, ranges, seeds, web
from lexmill.streaming import events

QUICK = settings(max_examples=60, deadline=None, suppress_health_check=list(HealthCheck))

# --- large files ---------------------------------------------------------------------------


def _plain_transition(raw: bytes, string: int, escape: int) -> tuple[int, int, int]:
    depth = 0
    for c in raw.decode("latin-1"):
        depth += 0 if string else (c in "[{") - (c in "]}")
        if escape:
            escape = 0
        elif c == "\\":
            escape = 1
        elif c == '"':
            string = 1 - string
    return string, escape, depth


@QUICK
@given(st.text(alphabet='\\"[]{}a,é', max_size=40))
def test_a_range_read_from_every_beginning(text):
    raw = text.encode()
    got = ranges.transitions(np.frombuffer(raw, np.uint8))
    assert got == [_plain_transition(raw, state // 2, state % 2) for state in range(4)]


_ROW = st.fixed_dictionaries({"a": st.integers(-5, 5) | st.none(), "b": st.text(alphabet='\\"[]{},é\n日 x', max_size=12), "c": st.lists(st.fixed_dictionaries({"d": st.text(alphabet='"}]\\', max_size=4)}), max_size=3)})


def test_json_arrays_in_ranges_of_any_size(spark, tmp_path):
    schema = T.StructType.fromDDL("a int, b string, c array<struct<d:string>>")
    rng = random.Random(2)
    some = lambda: "".join(rng.choice('\\"[]{},é\n日 x') for _ in range(rng.randrange(12)))
    rows = [{"a": rng.choice([None, i]), "b": some(), "c": [{"d": some()} for _ in range(rng.randrange(3))]} for i in range(60)]
    rows.append({"a": 1, "b": "long " * 400, "c": []})
    (tmp_path / "x.json").write_text("  \n" + json.dumps(rows, ensure_ascii=False, indent=1) + "\n")
    (tmp_path / "y.json").write_text(json.dumps(rows[:7], separators=(",", ":")))
    want = sorted(json.dumps([r["a"], r["b"], [c["d"] for c in r["c"]]]) for r in rows + rows[:7])
    for size in (17, 64, 1 << 20):
        got = files.json_array(spark, str(tmp_path / "*.json"), schema, size=size).collect()
        assert sorted(json.dumps([r["a"], r["b"], [c["d"] for c in r["c"]]]) for r in got) == want
    at = ranges.array_objects(spark, str(tmp_path / "y.json"), size=40, ahead=8).orderBy("at").collect()
    assert [json.loads(r["text"]) for r in at] == rows[:7] and at[0]["at"] == 1


def test_short_ranges_share_tasks_and_read_little_behind_them(spark, tmp_path, monkeypatch):
    rows = [{"a": i, "b": "]},{" * 9} for i in range(9000)]
    for name in ("x", "y"):
        (tmp_path / f"{name}.json").write_text(json.dumps(rows))
    cut, tasks = ranges.ranges(spark, str(tmp_path / "*.json"), size=256)
    assert cut.count() > 3000 and cut.rdd.getNumPartitions() == tasks <= 3 * spark.sparkContext.defaultParallelism
    got = files.json_array(spark, str(tmp_path / "*.json"), T.StructType.fromDDL("a int"), size=4096)
    assert sorted(r["a"] for r in got.collect()) == sorted(2 * [r["a"] for r in rows])
    read, plain = [], ranges._bytes
    monkeypatch.setattr(ranges, "_bytes", lambda path, start, stop: read.append(stop - start) or plain(path, start, stop))
    path, size = f"file://{tmp_path}/x.json", (tmp_path / "x.json").stat().st_size
    begun = pa.RecordBatch.from_pylist([{"path": path, "k": 0, "start": 0, "stop": 4096, "state": 0, "depth": 0, "size": size}])
    assert sum(b.num_rows for b in ranges._objects(iter([begun]), 1 << 20)) > 60 and sum(read) <= 4096 + ranges._NEAR


@pytest.mark.parametrize("text", ["", "  ", '{"a": 1}', '[{"a": 1}', '[{"a": 1}]]', '[{"a": 1}, {"a": }]', '["{"]', "[1, 2]", '[{"a": "x]'])
def test_what_is_no_array_of_objects_has_no_rows(spark, tmp_path, text):
    (tmp_path / "x.json").write_text(text)
    (tmp_path / "good.json").write_text('[{"a": 7}]')
    got = files.json_array(spark, str(tmp_path / "*.json"), T.StructType.fromDDL("a int"), size=4).collect()
    assert [r["a"] for r in got] == [7]


def test_lines_of_split_files_are_numbered(spark, tmp_path):
    lines = ["# c" if i % 9 == 0 else "" if i % 5 == 0 else json.dumps({"a": i, "b": "é" * (i % 40)}) for i in range(1, 2000)]
    (tmp_path / "x.jsonl").write_text("\n".join(lines))
    (tmp_path / "y.jsonl").write_text("\n".join(lines[:50]) + "\n")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "3000")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        rows = files.json_lines(spark, str(tmp_path / "*.jsonl"), T.StructType.fromDDL("a int"), numbered=True)
        got = sorted((r["file"][-7:], r["line"], r["row"]["a"]) for r in rows.collect())
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
        spark.conf.unset("spark.sql.files.openCostInBytes")
    want = [(i, json.loads(x)["a"]) for i, x in enumerate(lines, 1) if x and not x.startswith("#")]
    assert got == sorted([("x.jsonl", i, a) for i, a in want] + [("y.jsonl", i, a) for i, a in want if i <= 50])


# --- dated versions ------------------------------------------------------------------------


def test_versions_in_force(spark):
    rng, start = random.Random(4), date(2020, 1, 1)
    versions = []
    for i in range(120):
        a = start + timedelta(days=rng.randrange(-3000, 3000))
        b = a + timedelta(days=rng.choice([0, 1, 15, 16, 17, 300, 4000, -1]))
        versions.append((i % 3, i, None if i % 17 == 0 else a, None if i % 13 == 0 else b))
    versions += [(0, 500, None, None), (None, 501, None, None)]
    rows = [(i, rng.choice([0, 1, 2, 7, None]), None if i % 50 == 0 else start + timedelta(days=rng.randrange(-4000, 4000))) for i in range(300)]
    df = spark.createDataFrame(rows, "id int, k int, day date")
    dated = spark.createDataFrame(versions, "k int, v int, valid_from date, valid_to date")
    holds = lambda k, day: [(f or date.min, v) for vk, v, f, t in versions if k is not None and vk == k and day and (f is None or f <= day) and (t is None or day <= t) and not (f and t and t < f)]
    got = {(r["id"], r["v"]) for r in temporal.holding(df, dated, ["k"], "day").collect()}
    assert got == {(i, v) for i, k, day in rows for _, v in holds(k, day)}
    best = {r["id"]: r["v"] for r in temporal.in_force(df, dated, ["k"], "day", "id", tie="v").collect()}
    assert best == {i: max(holds(k, day))[1] if holds(k, day) else None for i, k, day in rows}
    assert temporal.blocks(dated).groupBy("v").count().agg(F.max("count")).first()[0] <= temporal.SPREAD
    assert temporal.holding(df, dated.limit(0), ["k"], "day").count() == 0
    assert "Cartesian" not in temporal.holding(df, dated, ["k"], "day")._jdf.queryExecution().toString()


def test_days_are_cut_into_blocks_that_hold_no_others(spark):
    rng, first = random.Random(8), date(1, 1, 1)
    spans = [(0, 0), (0, 3652058), (719161, 719163)] + [(a := rng.randrange(3652059), min(3652058, a + rng.choice([0, 1, 6, 7, 8, 63, 700, 5000, 10**6]))) for _ in range(60)]
    df = spark.createDataFrame([(i, first + timedelta(days=a), first + timedelta(days=b)) for i, (a, b) in enumerate(spans)], "v int, valid_from date, valid_to date")
    days = {}
    for r in temporal.pieces(df).collect():
        width = 1 << (temporal.BITS * r["__level"])
        days.setdefault(r["v"], []).append((r["__block"] * width, r["__block"] * width + width))
    epoch = (date(1970, 1, 1) - first).days
    for i, (a, b) in enumerate(spans):
        own = sorted(days[i])
        assert own[0][0] + epoch == a and own[-1][1] + epoch == b + 1 and all(x[1] == y[0] for x, y in zip(own, own[1:], strict=False)) and len(own) < 14 * temporal.LEVELS


def test_rows_that_share_an_id_and_rows_without_one(spark):
    dated = spark.createDataFrame([(0, 1, date(2020, 1, 1), None), (0, 2, date(2021, 1, 1), None), (1, 3, None, date(2020, 6, 1))], "k int, v int, valid_from date, valid_to date")
    rows = [(7, 0, date(2020, 5, 5)), (7, 0, date(2021, 5, 5)), (8, 1, date(2020, 6, 1)), (8, 1, date(2020, 6, 2)), (None, 0, date(2022, 1, 1)), (9, 0, date(2019, 1, 1))]
    got = temporal.in_force(spark.createDataFrame(rows, "id int, k int, day date"), dated, ["k"], "day", "id", tie="v").collect()
    assert sorted((str(r["id"]), str(r["day"]), r["v"]) for r in got if r["v"]) == [("7", "2020-05-05", 2), ("7", "2021-05-05", 2), ("8", "2020-06-01", 3), ("8", "2020-06-02", 3)] and len(got) == 6


def test_rates_in_force_without_pairs(spark):
    n, began = 40_000, time.time()  # 1.6 billion pairs of rows and versions
    versions = spark.range(n).select(F.lit(0).alias("k"), F.col("id").alias("v"), F.expr("date_add(date'2000-01-01', cast(id % 700 as int))").alias("valid_from"), F.lit(None).cast("date").alias("valid_to"))
    rows = spark.range(n).select("id", F.lit(0).alias("k"), F.expr("date_add(date'2003-01-01', cast(id % 900 as int))").alias("day"))
    best = temporal.in_force(rows, versions, ["k"], "day", "id", tie="v").groupBy("v").count().collect()
    assert [tuple(r) for r in best] == [(n - 1 - (n - 1 - 699) % 700, n)]
    assert time.time() - began < 60


def test_sums_of_what_holds_equal_those_of_pairs(spark):
    rng, start = random.Random(14), date(2020, 1, 1)
    some = lambda far: start + timedelta(days=rng.randrange(-far, far))
    versions = [(rng.choice([0, 1, None]), rng.choice([0.25, 1.5, None]), rng.choice([None, some(900)]), rng.choice([None, some(900)])) for _ in range(200)]
    rows = [(i % 90, rng.choice([0, 1, 2, None]), rng.choice([None, some(1500), some(1500)])) for i in range(200)]
    df, dated = spark.createDataFrame(rows, "id int, k int, day date"), spark.createDataFrame(versions, "k int, rate double, valid_from date, valid_to date")
    want = temporal.holding(df, dated, ["k"], "day").groupBy("id").agg(F.count(F.lit(1)).alias("n"), F.sum("rate").alias("total")).collect()
    got = temporal.holding_sums(df, dated, ["k"], "day", "rate").groupBy("id").agg(F.sum("n").alias("n"), F.sum("total").alias("total")).collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, map(tuple, want))) and len(want) > 30
    assert temporal.holding_sums(df, dated.limit(0), ["k"], "day", "rate").count() == 0


def test_sums_of_rates_without_pairs(spark):
    n, began = 60_000, time.time()  # 3.6 billion pairs of rows and versions
    versions = spark.range(n).select(F.lit(0).alias("k"), F.lit(0.5).alias("rate"), F.expr("date_add(date'2000-01-01', cast(id % 700 as int))").alias("valid_from"), F.lit(None).cast("date").alias("valid_to"))
    rows = spark.range(n).select("id", F.lit(0).alias("k"), F.expr("date_add(date'2003-01-01', cast(id % 900 as int))").alias("day"))
    got = temporal.holding_sums(rows, versions, ["k"], "day", "rate").groupBy("n", "total").count().collect()
    assert [tuple(r) for r in got] == [(n, n / 2, n)] and time.time() - began < 30


# --- rules as data -------------------------------------------------------------------------


def test_rules_as_a_table_equal_rules_as_expressions(spark):
    rng = random.Random(9)
    fields = {"kind": ["a", "b", "c"], "country": ["NO", "SE"], "amount": [1.5, 20.0, 300.0], "n": [1, 2, 3], "open": [True, False], "note": ["Hotel in Oslo", "food", ""]}
    values = {"equals": lambda f: rng.choice(fields[f]), "not_equals": lambda f: rng.choice(fields[f]), "in": lambda f: rng.sample(fields[f], 2), "not_in": lambda f: rng.sample(fields[f], 1), "contains": lambda f: rng.choice(["hotel", "o", ["x", "FOOD"]]), "not_contains": lambda f: ["oslo", "z"], "greater_than": lambda f: rng.choice([1, 5.5]), "less_equal": lambda f: rng.choice([2, 20])}
    made = []
    for i in range(80):
        conditions = []
        for _ in range(rng.randrange(4)):
            operator = rng.choice(list(values))
            field = rng.choice(["amount", "n"] if operator in ("greater_than", "less_equal") else ["note", "kind"] if "contains" in operator else [*fields, "missing"])
            conditions.append((field, operator, json.dumps(values[operator](field if field != "missing" else "kind"))))
        if i % 3 == 0:
            conditions += [("kind", "equals", '"a"'), ("n", "equals", str(i % 4))]
        made.append((f"r{i:02}", rng.randrange(5), i % 10 != 0, conditions, [("set_account", f'"{i}"'), ("set_vat_rate", "25.0")], "2020-01-01" if i % 4 == 0 else None, "2020-12-31" if i % 5 == 0 else None))
    table = spark.createDataFrame(made, "rule_id string, priority int, is_active boolean, conditions array<struct<field:string,operator:string,value:string>>, actions array<struct<type:string,value:string>>, valid_from string, valid_to string")
    rows = [(i, *(rng.choice([*v, None]) for v in fields.values()), date(2020, 1, 1) + timedelta(days=rng.randrange(-200, 500))) for i in range(200)]
    df = spark.createDataFrame(rows, "id int, kind string, country string, amount double, n int, open boolean, note string, day date")
    for on in ("day", None):
        want = sorted(map(tuple, rules.match(df, table.collect(), on).collect()), key=repr)
        assert sorted(map(tuple, rules.match_table(df, table, "id", on).collect()), key=repr) == want
    seeded = seeds.business_rules(spark)
    spent = spark.createDataFrame([(1, "expense", "hotel", "NO", 1200.0), (2, "expense", "food", "NO", 20.0), (3, None, None, None, None)], "id int, transaction_type string, category string, country string, amount double")
    assert sorted(map(tuple, rules.match_table(spent, seeded, "id").collect()), key=repr) == sorted(map(tuple, rules.match(spent, gold.rules_as_rows(seeded)).collect()), key=repr)
    assert rules.match_table(spent, seeded.limit(0), "id").where("rule_id is null").count() == 3


# --- structural joins ----------------------------------------------------------------------


_PAGES = [
    "<div id=a><p>one <b>two</b> three</p><div id=b><label>L1</label><section><input name=x></section><h2>H</h2><p>p1</p><ul><li>i1<li>i2 <i>x</i></ul><h3>K</h3><p>p2</p></div><label>L2</label><input name=y><script>s</script></div>",
    "<main><div><div><div><a href=1>deep</a></div></div></div><template>t<p>in</p></template><p> </p></main>",
    "",
    None,
]


def test_structural_joins_equal_a_walk(spark):
    pages = spark.createDataFrame([(i, p) for i, p in enumerate(_PAGES)], "page int, html string")
    nodes = html.html_tree(pages).cache()
    full = tree.full_texts(nodes, ["page"]).cache()
    for kind in (["div"], ["div", "section", "ul"], ["nothing"]):
        got = tree.nearest_above(full, ["page"], F.col("tag").isin(*kind), F.col("node_pre"))
        above = {(r["page"], r["node_pre"]): r["above"] for r in got.collect()}
        for i, page in enumerate(_PAGES):
            root = html.parse(page or "")
            order = [r for r in sorted((r for r in full.collect() if r["page"] == i), key=lambda r: r["node_pre"])]
            walked = list(root.walk())
            assert [r["tag"] for r in order] == [n.tag for n in walked]
            number = {id(n): r["node_pre"] for n, r in zip(walked, order, strict=True)}
            for node, row in zip(walked, order, strict=True):
                near = node.above(*kind)
                assert above[i, row["node_pre"]] == (number[id(near)] if near else None)
                if node.tag not in ("script", "template") and not any(a.tag in ("script", "template") for a in node.ancestors()):
                    assert row["full_text"] == node.text()
    text = tree.nearest_above(full, ["page"], F.col("full_text").contains("H"), F.col("node_id"))
    assert text.where("tag = 'input' and page = 0").orderBy("node_pre").select("above").first()["above"] == "b"
    label = tree.last_before(full, ["page"], F.col("tag") == "label", F.col("full_text"))
    assert [r["before"] for r in label.where("tag = 'input'").orderBy("node_pre").collect()] == ["L1", "L2"]
    led = tree.leader(full, ["page"], F.col("tag").isin(*html.HEADINGS), F.col("full_text"))
    assert [(r["tag"], r["leader"]) for r in led.where("leader is not null").orderBy("node_pre").collect()] == [("p", "H"), ("ul", "H"), ("h3", "H"), ("p", "K")]


# --- frequent words ------------------------------------------------------------------------


@pytest.mark.parametrize("held", [4, 1 << 16])
def test_frequent_words_by_summaries(spark, held):
    rng = random.Random(6)
    texts = [" ".join(f"W{int(rng.paretovariate(0.7)) % 4000}" for _ in range(rng.randrange(60))) for _ in range(300)] + [None, "", " \t"]
    count = Counter(w.lower() for t in texts for w in (t or "").split())
    df = spark.createDataFrame([(t,) for t in texts], "text string").repartition(5)
    want = [(w, n) for w, n in sorted(count.items(), key=lambda x: (-x[1], x[0]))[:20] if len(w) > 2]
    assert [tuple(r) for r in profile.frequent_words(df, "text", 20, 2, held=held).collect()] == want
    same = spark.createDataFrame([(" ".join(f"word{i}" for i in range(500)),)] * 2, "text string")
    assert [tuple(r) for r in profile.frequent_words(same, "text", 3, 3, held=held).collect()] == [("word0", 2), ("word1", 2), ("word10", 2)]
    assert profile.frequent_words(df.limit(0), "text").collect() == []


# --- what is kept between runs ---------------------------------------------------------------


def test_text_index(spark, tmp_path):
    rng = random.Random(12)
    texts = [(i, "".join(rng.choice("abc ÆØ日") for _ in range(rng.randrange(60)))) for i in range(300)] + [(300, None), (301, ""), (302, "ab"), (None, "abc"), (303, "𝒳yz end"), (7, "twice"), (7, "twice")]
    df = spark.createDataFrame(texts, "doc long, t string")
    index = TextIndex(spark, str(tmp_path / "i"))
    assert index.search("abc").count() == 0
    index.append(df.where("doc % 2 = 0"), "even", "doc", "t")
    index.append(df.where("doc % 2 = 1"), "odd", "doc", "t")
    for asked in ("abc", "ab", "A", "æø", "c 日b", "𝒳YZ", "not there", "twice", ""):
        got = sorted((r["id"], r["text"]) for r in index.search(asked).collect())
        assert got == sorted((i, t) for i, t in texts if i is not None and t is not None and asked.lower() in t.lower()), asked
    assert index.candidates("𝒳yz").count() == 1
    index.append(df.where("doc = 1").withColumn("t", F.lit("new words")), "odd", "doc", "t")  # in place of the old ones
    assert [r["id"] for r in index.search("new w").collect()] == [1] and all(r["id"] % 2 == 0 for r in index.search("abc").collect())
    scans = index.search("new w")._jdf.queryExecution().optimizedPlan().toString()
    assert "id" in scans and index.segments() == ["even", "odd"]


def test_quality_of_changed_files_only(spark, tmp_path):
    rng = random.Random(3)
    make = lambda n, at: [(at + i, rng.choice(["", "x", "http://a/b", None]), rng.choice(["zz", "a" * 64, None]), rng.choice(["tax", "other", None]), rng.choice(["p", ""])) for i in range(n)]
    parts = {f"f{k}.parquet": make(20 + k, 100 * k) for k in range(4)}
    schema = "ord long, source_url string, sha256 string, domain string, publisher string"

    def put(name, rows):
        import pandas as pd

        pd.DataFrame(rows, columns=[c.split()[0] for c in schema.split(", ")]).to_parquet(tmp_path / "in" / name, index=False)

    (tmp_path / "in").mkdir()
    for name, rows in parts.items():
        put(name, rows)
    state = CheckState(spark, str(tmp_path / "s"), "ord", "sha256")

    def same():
        rows = spark.createDataFrame([r for own in parts.values() for r in own], schema)
        want, got = quality.issue_counts(rows).first(), state.assess().first()
        assert all(got[c] == want[c] for c in ("records", "missing", "bad_urls", "bad_hashes", "bad_domains"))
        assert got["quality_score"] == quality.assess(rows, "ord").first()["quality_score"]
        assert list(got["first_missing"]) == [f"Record {r['ord']} missing {r['field']}" for r in quality.first_missing(rows, "ord").collect()]
        assert sorted(r["n"] for r in state.repeated().collect()) == sorted(r["n"] for r in quality.duplicate_keys(rows, "sha256").collect())

    assert state.update(str(tmp_path / "in")) == 4
    same()
    parts["f2.parquet"] = make(31, 900)
    put("f2.parquet", parts["f2.parquet"])
    assert state.update(str(tmp_path / "in")) == 1 and state.update(str(tmp_path / "in")) == 0
    same()
    (tmp_path / "in" / "f0.parquet").unlink()
    del parts["f0.parquet"]
    assert state.update(str(tmp_path / "in")) == 0
    same()


def test_fetching_as_a_data_source(spark, tmp_path):
    urls = spark.createDataFrame([(f"http://Host{i % 5}/{i}",) for i in range(20)] + [(None,), ("http://host0/0",), ("http://Host1/1",)], "url string")
    web.prepare(urls, str(tmp_path / "u"), groups=3)
    spark.dataSource.register(web.Pages)
    read = spark.read.format("lexmill_pages").option("path", str(tmp_path / "u")).option("opener", "test_scale_pages:page").option("rate", "20")
    folder = tmp_path / "code"
    folder.mkdir()
    (folder / "test_scale_pages.py").write_text("def page(url):\n    if url.endswith('/3'):\n        raise OSError('gone')\n    return url.encode()\n")
    spark.sparkContext.addPyFile(str(folder / "test_scale_pages.py"))
    began = time.monotonic()
    rows = read.load().collect()
    assert time.monotonic() - began >= 3 / 20  # four pages of a host, one after another
    assert len(rows) == 21 and {r["host"] for r in rows} == {f"host{i}" for i in range(5)}
    assert all((bytes(r["content"]).decode() == r["url"]) if r["error"] is None else r["error"] == "OSError: gone" for r in rows)
    assert read.load().rdd.getNumPartitions() == len([f for f in (tmp_path / "u").iterdir() if f.name.startswith("host_group=")])
    # as a stream: each batch of URLs once
    web.prepare(urls.limit(4), str(tmp_path / "s" / "b1"), groups=2)
    (tmp_path / "s").mkdir(exist_ok=True)

    def run():
        live = spark.readStream.format("lexmill_pages").option("path", str(tmp_path / "s")).option("opener", "test_scale_pages:page").option("rate", "0").load()
        live.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "check")).trigger(availableNow=True).start().awaitTermination(60)
        return spark.read.parquet(str(tmp_path / "out")).count()

    assert run() == 4
    web.prepare(urls.where("url like '%/1_'"), str(tmp_path / "s" / "b2"), groups=2)
    assert run() == 14 and run() == 14


def test_last_value_before_across_blocks(spark):
    rng = random.Random(11)
    start = datetime(2024, 1, 1)
    rows = [(i, rng.choice([1, 1, 1, 2, None]), None if i % 40 == 0 else start + timedelta(hours=rng.randrange(24 * 20)), rng.choice([None, float(i)]), rng.random() < 0.3) for i in range(400)]
    df = spark.createDataFrame(rows, "event_id long, user_id long, ts timestamp, value double, hit boolean")
    seen, want = {}, {}
    for i, user, ts, value, hit in sorted(rows, key=lambda r: (r[2] is not None, r[2] or start, r[0])):
        want[i] = seen.get(user)
        if hit and value is not None:
            seen[user] = value
    for block in ("1 day", "1 hour", "365 days"):
        got = {r["event_id"]: r["last_seen"] for r in events.last_before(df, "hit", "value", block=block).collect()}
        assert got == want
