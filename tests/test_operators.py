from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from lexmill import schemas, settings
from lexmill.operators import capture, profile, quality, rules, split
from lexmill.operators.manifest import ROWS, Manifest
from lexmill.plans import evaluate, gold, jobs
from lexmill.settings import Settings
from lexmill.sources import catalog, fetch, files, seeds
from lexmill.streaming import capture as stream
from lexmill.streaming import events


def test_catalogue(spark, tmp_path):
    full = catalog.load(spark, Settings().sources_file)
    assert full.count() == 15 and catalog.by_domain(full, "TAX").count() == 8
    assert catalog.by_source_type(full, "law", "forskrift").count() == 9 and catalog.by_id_pattern(full, "SAFT").count() == 2
    assert catalog.by_publisher(full, "altinn").count() == 1 and catalog.by_crawl_frequency(full, "monthly").count() == 2
    assert catalog.by_id(full, "mva_rates").count() == 1 and catalog.by_condition(full, F.col("effective_from").isNull()).count() == 3
    (tmp_path / "s.csv").write_text("source_id,url,domain\na,u,tax\n,u,tax\na,v,tax\n")
    small = catalog.load(spark, str(tmp_path / "s.csv"))
    assert small.columns == list(catalog.COLUMNS) and catalog.with_defaults(small).first()["jurisdiction"] == "NO"
    assert catalog.lookup(small.withColumn("ord", F.monotonically_increasing_id())).collect()[0]["url"] == "v"
    assert catalog.load(spark, str(tmp_path / "none.csv")).count() == 0
    (tmp_path / "s.csv").write_text("source_id\nnew\n", encoding="utf-8")
    catalog.invalidate(spark, str(tmp_path / "s.csv"))
    assert [r["source_id"] for r in catalog.load(spark, str(tmp_path / "s.csv")).collect()] == ["new"]
    plans = {r["source_id"]: r["plan"] for r in full.select("source_id", catalog.route().alias("plan")).collect()}
    assert plans["mva_import"] is None and plans["saft_v1_30"] == "saft" and plans["mva_rates"] == "rates"


def test_json_files(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text('# comment\n\n{"a": 1}\nnot json\n{"a": 2}\n')
    schema = spark.createDataFrame([], "a int").schema
    rows = files.json_lines(spark, str(tmp_path / "*.jsonl"), schema, numbered=True).orderBy("line").collect()
    assert [(r["line"], r["row"]["a"] if r["row"] else None, r["bad"]) for r in rows] == [(3, 1, False), (4, None, True), (5, 2, False)]
    assert files.json_lines(spark, str(tmp_path / "a.jsonl"), schema).where("bad").count() == 1
    (tmp_path / "b.json").write_text('[{"a": 1}, {"a": 2}]')
    assert files.json_array(spark, str(tmp_path / "b.json"), schema).count() == 2
    assert files.json_array(spark, str(tmp_path / "none.json"), schema).count() == 0


def test_http_retries():
    from io import BytesIO
    from urllib.error import HTTPError, URLError

    calls, waits = [], []

    def opener(request, timeout):
        calls.append(request.get_header("User-agent"))
        if len(calls) < 3:
            raise HTTPError("u", 503, "busy", {}, None) if len(calls) == 1 else URLError("lost")
        return BytesIO(b"ok")

    assert fetch.http_get("http://x", opener=opener, sleep=waits.append) == b"ok" and waits == [0.5, 1.0]

    def gone(request, timeout):
        raise HTTPError("u", 404, "gone", {}, None)

    with pytest.raises(HTTPError):
        fetch.http_get("http://x", opener=gone, sleep=waits.append)


@pytest.fixture
def own(tmp_path):
    return Settings(data_dir=str(tmp_path / "data"))


def test_ingest_and_process(spark, own):
    sources = spark.createDataFrame([("law_a", "u1", "tax", "law"), ("r", "u2", "tax", "rates"), ("bad", "u3", "tax", "law")], "source_id string, url string, domain string, source_type string")
    for c in catalog.COLUMNS:
        sources = sources if c in sources.columns else sources.withColumn(c, F.lit(None).cast("string"))

    def get(url):
        if url == "u3":
            raise OSError("gone")
        return {"u1": "<div class='paragraf'><h2>§ 1-1. Test Section</h2><p>Some text of it</p></div>", "u2": "<table><tr><td>Mat</td><td>15 %</td></tr></table>"}[url].encode()

    first = jobs.ingest(spark, own, sources, get, "r1")
    assert (first.total, first.processed, first.failed, first.counts["changed"]) == (3, 2, 1, 2) and not first.success
    again = jobs.ingest(spark, own, sources.where("source_id <> 'bad'"), get, "r2")
    assert again.success and again.counts["changed"] == 0
    done = jobs.process(spark, own, sources)
    assert done.counts == {"law_sections": 1, "rate_table": 1, "amelding_rules": 0, "saft_v1_3_nodes": 0} and done.failed == 1
    section = spark.read.parquet(f"{own.silver}/law_sections").first()
    assert len(section["sha256"]) == 64 and section["source_url"] == "u1" and section["law_id"] == "law_a"
    assert jobs.validate_silver(spark, own)["file_details"]["rate_table"]["status"] == "valid"


def test_seeds(spark, own):
    assert jobs.validate_seeds(spark, own) != []
    assert jobs.seed(spark, own).counts == {"chart_of_accounts": 42, "business_rules": 30}
    assert jobs.validate_seeds(spark, own) == []
    accounts, rows = seeds.accounts(spark), seeds.business_rules(spark)
    assert quality.validate_accounts(accounts.where("account_class <> '8'").union(accounts.where("account_id = '1000'"))) == ["Duplicate account IDs found: 1000", "Missing account classes: 8"]
    assert any("Less than 15" in x for x in quality.validate_rules(rows.limit(3)))
    assert quality.unknown_accounts(rows, accounts.where("account_id <> '7140'")).count() == 1
    assert quality.validate(accounts, schemas.constraints("ChartOfAccountsEntry"), "account_id").first()["invalid"] == 0
    assert quality.validate(rows, schemas.constraints("BusinessRule"), "rule_id").first()["invalid"] == 0
    assert seeds.standard_rates(spark).count() == 4


def test_constraints(spark):
    rows = spark.createDataFrame([(1, "12a4", "1", None), (2, "1234", "9", "debit")], "i int, account_id string, account_class string, normal_balance string")
    one = quality.validate(rows, schemas.constraints("ChartOfAccountsEntry"), "i").first()
    assert one["invalid"] == 2 and "account_id doesn't match" in one["errors"][0] and "account_class has an unknown value" in one["errors"][1]
    assert schemas.json_schema("BusinessRule")["properties"]["source_ids"]["minItems"] == 1 and len(schemas.entities()) == 11


def test_quality(spark):
    rows = spark.createDataFrame([(0, "https://a/b", "a" * 64, "tax", "p"), (1, "bad", "zz", "x", "")], "i int, source_url string, sha256 string, domain string, publisher string")
    got = quality.assess(rows, "i").first()
    assert got["issues"] == ["Record 1 missing publisher", "Found 1 invalid URLs", "Found 1 invalid SHA256 hashes", "Found 1 invalid domains"] and got["quality_score"] == 0.0
    empty = quality.assess(rows.limit(0), "i").first()
    assert (empty["is_valid"], empty["quality_score"], empty["issues"]) == (False, 0.0, ["Dataset is empty"])
    assert quality.assess(rows.limit(1), "i").first()["recommendations"] == ["Data quality is good"]


def test_split_keeps_families_together(spark):
    rows = spark.range(500).select("id", (F.col("id") % 37).cast("string").alias("f")).withColumn("f", F.when(F.col("f") == "3", None).otherwise(F.col("f")))
    out = split.family_split(rows, "f", 0.8)
    assert out.count() == 500 and split.leaks(out, "f").count() == 0
    stats = {r["split"]: r["families"] for r in split.split_stats(out, "f").collect()}
    assert stats == {"train": 29, "val": 8}
    again = split.family_split(rows.repartition(7), "f", 0.8)
    assert out.exceptAll(again).count() == 0
    assert split.family_split(rows.limit(0), "f").count() == 0


def test_profile(spark):
    rows = spark.createDataFrame([("a", "x", "the the word", 1, ["q"]), ("a", None, "", 0, [])], "k string, s string, t string, n int, l array<string>")
    got = {(r["field"], r["value"]): r["n"] for r in profile.counts(rows, "k", "s").collect()}
    assert got == {("k", "a"): 2, ("s", "x"): 1, ("s", "unknown"): 1}
    full = {r["field"]: r["filled"] for r in profile.completeness(rows, "s", "t", "n", "l", "none").collect()}
    assert full == {"s": 1, "t": 1, "n": 1, "l": 1, "none": 0}
    assert [tuple(r) for r in profile.frequent_words(rows, "t", 2, 3).collect()] == [("word", 1)]
    assert profile.search(rows, "WORD", "t").count() == 1 and profile.search(rows, "1", "n").count() == 0


def test_rule_engine(spark):
    own = seeds.business_rules(spark).orderBy("priority", "rule_id").collect()
    rows = spark.createDataFrame([("expense", "hotel", "NO", 1200.0), ("expense", "nothing", "NO", 1.0)], "transaction_type string, category string, country string, amount double")
    got = rules.match(rows, own).collect()
    assert (got[0]["rule_id"], got[0]["account"], got[0]["vat_rate"]) == ("expense_hotel_no_001", "7140", 12.0) and got[1]["rule_id"] is None
    held = lambda op, v: rows.select(rules.condition(rows, "category", op, v).alias("h")).first()["h"]
    assert held("contains", ["zz", "OTE"]) and not held("not_contains", ["ote"]) and held("in", ["hotel", "x"]) and held("not_equals", "x")
    number = lambda op, v: rows.select(rules.condition(rows, "amount", op, v).alias("h")).first()["h"]
    assert number("greater_than", 1000) and number("less_equal", 1200) and not number("less_than", 1200) and not number("equals", 5)
    assert not rows.select(rules.condition(rows, "nope", "equals", 1).alias("h")).first()["h"]


GOLDEN = '{"messages": [{"role": "system", "content": "s"}, {"role": "user", "content": "q"}], "metadata": {"domain": "tax", "task": "glossary_define"}, "expected_output": "Avgift til staten [§ 1-1 Lov om x]", "eval_criteria": {"must_include": ["avgift", "mangler"], "citation_required": true, "max_tokens": 300}}\n'


def test_evaluation(spark, tmp_path):
    (tmp_path / "a_eval.jsonl").write_text("# c\n" + GOLDEN * 2)
    expected = jobs.evaluation(spark, str(tmp_path / "*_eval.jsonl"), None)
    # as expected is graded: accuracy and citation are 1, a short text 0.5, one of two key words
    assert expected["aggregate_metrics"]["overall_score"] == pytest.approx(0.5 + 0.25 + 0.5 * 0.15 + 0.5 * 0.10)
    assert expected["by_task"]["glossary_define"]["count"] == 2
    mocked = jobs.evaluation(spark, str(tmp_path / "*_eval.jsonl"))
    assert len(mocked["failed_samples"]) == 2 and mocked["sample_results"][1]["sample_id"] == "glossary_define_1"
    graded = evaluate.results(evaluate.load(spark, str(tmp_path / "*_eval.jsonl")), lambda q, s: "Avgift til staten [§ 1-1 Lov om x] mangler " + "ord " * 0)
    assert not evaluate.passes(graded) and jobs.evaluation(spark, str(tmp_path / "none*")) == {}


def test_export(spark, own, tmp_path):
    jobs.seed(spark, own)
    done = jobs.export(spark, own, "rules")
    assert done.counts["rule_application.total_generated"] == 420 and done.counts["rule_application.val_samples"] > 0
    assert jobs.validate_samples(spark, f"{own.gold}/rule_application/*/*.json").count() == 0
    (tmp_path / "bad.jsonl").write_text('{"messages": []}\nzz\n')
    assert jobs.validate_samples(spark, str(tmp_path / "bad.jsonl")).count() == 2
    assert gold.export(gold.rule_samples(seeds.business_rules(spark)), str(tmp_path / "g"))["total_generated"] == 420


def test_streamed_capture(spark, own, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "a.html").write_text("one")
    run = lambda: stream.capture_stream(stream.arriving_files(spark, str(folder)), own, str(tmp_path / "check")).awaitTermination(60)
    run()
    (folder / "b.html").write_text("two")
    run()
    log = Manifest(spark, f"{own.bronze}/manifest")
    assert [(r["source_id"], r["changed"]) for r in log.history().orderBy("source_id").collect()] == [("a", True), ("b", True)]
    sources = spark.createDataFrame([("a",), ("b",), ("c",)], "source_id string")
    assert [(r["source_id"], r["content"] and bytes(r["content"])) for r in jobs.bronze_pages(spark, own, sources).orderBy("source_id").collect()] == [("a", b"one"), ("b", b"two"), ("c", None)]


def _arrived(spark, folder, rows):
    made = [(k, "u", c if c is None else c.encode(), e, datetime(2024, 1, day)) for k, c, e, day in rows]
    spark.createDataFrame(made, "source_id string, url string, content binary, error string, modified_at timestamp").coalesce(1).write.mode("append").parquet(str(folder))


def test_streams_lose_and_repeat_nothing(spark, own, tmp_path, monkeypatch):
    log = Manifest(spark, f"{own.bronze}/manifest")

    def run(folder, check, **more):
        live = spark.readStream.schema("source_id string, url string, content binary, error string, modified_at timestamp").parquet(str(tmp_path / folder))
        stream.capture_stream(live, own, str(tmp_path / check), **more).awaitTermination(120)

    def last():
        pages = jobs.bronze_pages(spark, own, log.last().select("source_id"))
        return {r["source_id"]: bytes(r["content"]).decode() for r in pages.collect()}

    _arrived(spark, tmp_path / "x", [("a", "1", None, 2), ("e", None, "gone", 2), ("n", "", None, 2)])
    run("x", "c1")
    # a second stream with batches of the same numbers, into the same bronze
    _arrived(spark, tmp_path / "y", [("b", "1", None, 2), ("a", "0", None, 1)])
    run("y", "c2")
    assert last() == {"a": "1", "b": "1", "n": ""}
    # a crash after the contents and before the commit: the batch is repeated
    commit, calls = Manifest.commit, []

    def failing(self, rows, name):
        calls.append(name)
        raise OSError("lost")

    monkeypatch.setattr(Manifest, "commit", failing)
    _arrived(spark, tmp_path / "x", [("a", "2", None, 3), ("b", "2", None, 1), ("a", "1", None, 1)])
    with pytest.raises(Exception, match="lost"):
        run("x", "c1")
    assert last()["a"] == "1" and len(calls) == 1
    monkeypatch.setattr(Manifest, "commit", commit)
    run("x", "c1", commits=2)
    assert last() == {"a": "2", "b": "1", "n": ""} and log.commits() == [] and len(log.snapshots()) == 1
    # after a crash behind the commit nothing happens again
    rows = sorted((r["source_id"], r["changed"], r["stale"], r["success"]) for r in log.history().collect())
    assert log.has(calls[0])
    run("x", "c3")  # a new stream over the same files
    again = sorted((r["source_id"], r["changed"], r["stale"], r["success"]) for r in log.history().collect())
    assert last() == {"a": "2", "b": "1", "n": ""} and len(again) == len(rows) + 6
    assert [r for r in rows if r[0] == "a"] == [("a", False, True, True), ("a", False, True, True), ("a", True, False, True), ("a", True, False, True)]
    assert [r[1] for r in rows if r[0] == "e"] == [False]


def test_manifest_snapshots(spark, tmp_path):
    log = Manifest(spark, str(tmp_path / "m"))
    assert log.last().count() == 0 and not log.compact(1)

    def rows(*versions):
        made = [(k, None, None, ok, h, True, False, 1, None, run, None, datetime(2024, 1, day)) for k, h, run, day, ok in versions]
        return spark.createDataFrame(made, ROWS)

    log.commit(rows(("a", "h1", "r1", 1, True), ("b", "h1", "r1", 1, True)), "r1")
    log.commit(rows(("a", "h2", "r/2", 3, True), ("b", "h9", "r/2", 9, False)), "r/2")
    assert log.has("r/2") and log.commits() == ["r1", "r_2"]
    log.commit(rows(("z", "zz", "r1", 1, True)), "r1")  # a whole run stays as it is
    want = [("a", "h2", "r/2"), ("b", "h1", "r1")]
    known = lambda: sorted((r["source_id"], r["sha256"], r["content_run"]) for r in log.last().collect())
    assert known() == want and not log.compact(3) and log.compact(2) and known() == want and log.commits() == []
    log.commit(rows(("a", "h1", "r3", 2, True)), "r3")  # older than the snapshot's
    assert known() == want and log.compact(1) and known() == want and log.history().count() == 5
    (tmp_path / "m" / "log" / "torn").mkdir(parents=True)  # a commit that was cut off
    assert log.commits() == [] and known() == want
    (tmp_path / "m" / "claims" / "0000000003").write_text("")  # somebody else compacts
    log.commit(rows(("c", "h1", "r4", 2, True)), "r4")
    assert not log.compact(1) and log.commits() == ["r4"]


def test_streamed_windows(spark, tmp_path):
    rows = spark.sql("select id as event_id, timestamp'2024-01-01 00:00:00' + make_interval(0,0,0,0,0,cast(id * 7 as int)) as ts, id % 3 as user_id, 'x' as event_type, 1.0d as value from range(100)")
    rows.write.parquet(str(tmp_path / "e"))
    live = spark.readStream.schema(rows.schema).parquet(str(tmp_path / "e"))
    for name, made in (("tum", events.tumbling(live, delay="1 minute")), ("ses", events.sessions(live, delay="1 minute"))):
        made.writeStream.format("memory").queryName(name).outputMode("complete" if name == "tum" else "append").trigger(availableNow=True).start().awaitTermination(60)
    assert spark.table("tum").exceptAll(events.tumbling(rows)).count() == 0 and spark.table("tum").count() == events.tumbling(rows).count()
    assert events.sliding(rows).agg(F.sum("n")).first()[0] == 200
    assert events.deduplicated(rows, "user_id").count() == 3


def test_settings(tmp_path, monkeypatch):
    (tmp_path / "s.toml").write_text('[default]\ndata_dir = "d"\nhttp_timeout = 5\n[production]\nhttp_timeout = 60\n')
    assert settings.load(str(tmp_path / "s.toml"), "production").http_timeout == 60
    monkeypatch.setenv("LEXMILL_HTTP_TIMEOUT", "7")
    own = settings.load(str(tmp_path / "s.toml"))
    assert own.http_timeout == 7 and own.bronze == "d/bronze" and not own.remote and own.problems() == []
    assert Settings(split_ratio=2.0).problems() != []


def test_report(spark):
    from lexmill.plans import report

    rows = spark.createDataFrame([(0, "tax", "§ 1", "text <b>")], "o int, domain string, heading string, text_plain string")
    assert "text &lt;b&gt;" in report.page(rows, "o")
