"""Jobs: bronze ingestion, silver processing, seeds, exports, validation and evaluation.

Each job reads tables, writes tables and returns counts.  All sources of a job are one
table; a source that fails is a row of its manifest, and the others go on.
"""

from __future__ import annotations

import json
import time
from collections.abc import Callable
from dataclasses import asdict, dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexmill import schemas
from lexmill.operators import capture, quality
from lexmill.operators.manifest import Manifest, safe
from lexmill.plans import evaluate, gold, guidance, legal, rates, saft
from lexmill.settings import Settings
from lexmill.sources import catalog, fetch, pdf, seeds
from lexmill.sources.files import exists
from lexmill.sources.html import html_blocks


#: Failures that a result names; the manifest has them all.
SHOWN = 100


@dataclass
class Result:
    """What a job did; each failure counts once, and the first ``SHOWN`` are named."""

    name: str
    total: int = 0
    processed: int = 0
    failed: int = 0
    seconds: float = 0.0
    errors: list[str] = field(default_factory=list)
    counts: dict[str, int] = field(default_factory=dict)

    @property
    def success(self) -> bool:
        return self.failed == 0 and not self.errors

    @property
    def success_rate(self) -> float:
        return self.processed / self.total * 100 if self.total else 0.0

    def summary(self) -> str:
        lines = [f"{self.name}: {self.processed} of {self.total} processed, {self.failed} failed ({self.success_rate:.1f} %) in {self.seconds:.1f} s"]
        lines += [f"  {k}: {v}" for k, v in self.counts.items()] + [f"  error: {e}" for e in self.errors]
        return "\n".join(lines)

    def as_json(self) -> str:
        return json.dumps(asdict(self) | {"success": self.success, "success_rate": self.success_rate}, ensure_ascii=False)


def _timed(job: Callable[..., Result]) -> Callable[..., Result]:
    def run(*args: object, **more: object) -> Result:
        began = time.monotonic()
        out = job(*args, **more)
        out.seconds = time.monotonic() - began
        return out

    return run


@_timed
def ingest(spark: SparkSession, settings: Settings, sources: DataFrame, get: Callable[[str], bytes] = fetch.http_get, run_id: str | None = None, extension: str = "html") -> Result:
    """Fetches sources, writes what changed to the bronze contents and commits every outcome to the manifest."""
    run, manifest = run_id or str(int(time.time() * 1000)), Manifest(spark, f"{settings.bronze}/manifest")
    staged, path = f"{settings.bronze}/staging/{run}", f"{settings.bronze}/contents/{safe(run)}"
    fetch.fetch(sources, get).write.mode("overwrite").parquet(staged)  # each URL is fetched once
    rows = capture.capture(spark.read.parquet(staged), manifest.last(), settings.bronze, run, extension)
    rows.withColumn("content", F.when(F.col("changed"), F.col("content"))).write.mode("overwrite").parquet(path)
    rows = spark.read.parquet(path).drop("content")
    found = rows.agg(F.count(F.lit(1)), F.count_if("success"), F.count_if("changed")).first()
    errors = [f"{r['source_id']}: {r['error']}" for r in rows.where("not success").select("source_id", "error").orderBy("source_id").limit(SHOWN).collect()]
    manifest.commit(rows, run)
    manifest.compact()
    return Result("bronze", found[0], found[1], found[0] - found[1], errors=errors, counts={"changed": found[2]})


def bronze_pages(spark: SparkSession, settings: Settings, sources: DataFrame) -> DataFrame:
    """The last content of each source with its catalogue row; sources without one have a null content.

    Only the contents of the runs that wrote a last version are read.
    """
    last = Manifest(spark, f"{settings.bronze}/manifest").last().select("source_id", "sha256", F.col("content_run").alias("run_id"))
    runs = [r["run_id"] for r in last.where("run_id is not null").select("run_id").distinct().collect()]  # names of runs
    kept, paths = "source_id string, sha256 string, content binary, run_id string, captured_at timestamp", [f"{settings.bronze}/contents/{safe(run)}" for run in runs]
    contents = spark.read.schema(kept).parquet(*paths) if paths else spark.createDataFrame([], kept)
    own = contents.where("content is not null").join(last, ["source_id", "sha256", "run_id"], "left_semi")
    own = capture.latest(own, "source_id", "captured_at")  # a content may come twice in a batch
    return sources.join(own.select("source_id", F.col("sha256").alias("page_sha256"), "content"), "source_id", "left")


def page_blocks(pages: DataFrame) -> DataFrame:
    """The blocks of all pages that have a plan, with their catalogue columns: what every plan reads."""
    routed = catalog.with_defaults(pages).withColumns({"plan": catalog.route(), "html": F.decode("content", "UTF-8")}).where("content is not null and plan is not null")
    meta = ["source_id", "title", "url", "version", "jurisdiction", "effective_from", "effective_to", "domain", "source_type", "publisher", "crawl_freq", "plan", "page_sha256"]
    return html_blocks(routed.select(*(c for c in meta if c in routed.columns), "html"))


def silver_tables(blocks: DataFrame) -> dict[str, DataFrame]:
    """The silver tables of the blocks of pages."""
    plain = blocks.drop("title", "version", "jurisdiction", "effective_from", "effective_to", "domain", "source_type", "publisher", "crawl_freq")
    of = lambda rows, *plans: rows.where(F.col("plan").isin(*plans)).drop("plan")
    stamped = lambda rows: rows.withColumnsRenamed({"url": "source_url", "page_sha256": "sha256"})
    page = ["source_id", "url", "page_sha256"]
    overview = guidance.overview_rules(of(plain, "amelding_overview", "amelding"), page)
    forms = guidance.form_rules(of(plain, "amelding_forms", "amelding"), page)
    return {
        "law_sections": legal.sections(of(blocks, "legal").drop("page_sha256"), ["source_id"]).drop("source_id"),
        "rate_table": stamped(rates.silver(rates.rates(of(plain, "rates")))),
        "amelding_rules": stamped(guidance.silver(overview.unionByName(forms))),
        "saft_v1_3_nodes": stamped(saft.silver(saft.documentation_nodes(of(plain, "saft")))),
    }


@_timed
def process(spark: SparkSession, settings: Settings, sources: DataFrame, only: list[str] | None = None) -> Result:
    """Writes the silver tables of all sources with a plan."""
    pages = bronze_pages(spark, settings, sources)
    known = pages.select("source_id", catalog.route().alias("plan"), F.col("content").isNull().alias("lost")).where("plan is not null")
    total, lost = known.agg(F.count(F.lit(1)), F.count_if("lost")).first()
    out = Result("silver", total, total - lost, lost)
    out.errors = [f"{r['source_id']}: no bronze content" for r in known.where("lost").orderBy("source_id").limit(SHOWN).collect()]
    parsed = f"{settings.bronze}/blocks"
    page_blocks(pages).write.mode("overwrite").parquet(parsed)  # each page is parsed once, for all plans
    for name, rows in silver_tables(spark.read.parquet(parsed)).items():
        if only is None or name in only:
            path = f"{settings.silver}/{name}"
            rows.write.mode("overwrite").parquet(path)
            out.counts[name] = spark.read.parquet(path).count()
    return out


@_timed
def process_documents(spark: SparkSession, settings: Settings, get: Callable[[str], bytes] = fetch.http_get, engines: tuple = pdf.ENGINES, tables: Callable = pdf._plumber_tables) -> Result:
    """Nodes of the published documents of the specification."""
    rows = spark.createDataFrame([(name, pdf.BASE_URL + file) for name, (file, _) in pdf.DOCUMENTS.items()], "source_id string, url string")
    fetched = fetch.fetch(rows, get)
    read = pdf.read_documents(fetched.where("error is null").select(F.col("source_id").alias("path"), "content"), engines, tables)
    nodes = saft.document_nodes(read.drop("error"), "path", "path", {name: prefix for name, (_, prefix) in pdf.DOCUMENTS.items() if prefix})
    path = f"{settings.silver}/saft_document_nodes"
    nodes.write.mode("overwrite").parquet(path)
    bad = [f"{r[0]}: {r[1]}" for r in fetched.where("error is not null").select("source_id", "error").collect()]
    return Result("documents", len(pdf.DOCUMENTS), len(pdf.DOCUMENTS) - len(bad), len(bad), errors=bad, counts={"nodes": spark.read.parquet(path).count()})


@_timed
def seed(spark: SparkSession, settings: Settings) -> Result:
    """Writes the seed tables."""
    out = Result("seed")
    for name, rows in (("chart_of_accounts", seeds.accounts(spark)), ("business_rules", seeds.business_rules(spark))):
        rows.write.mode("overwrite").parquet(f"{settings.silver}/{name}")
        out.counts[name] = rows.count()
    out.total = out.processed = sum(out.counts.values())
    return out


def validate_seeds(spark: SparkSession, settings: Settings) -> list[str]:
    """What is wrong with the written seed tables; empty if nothing is."""
    paths = [f"{settings.silver}/{name}" for name in ("chart_of_accounts", "business_rules")]
    if not all(exists(spark, p) for p in paths):
        return ["Seed tables not found; run seed first"]
    accounts, rules = (spark.read.parquet(p) for p in paths)
    dangling = [f"Rule {r['rule_id']} references non-existent account: {r['account_id']}" for r in quality.unknown_accounts(rules, accounts).orderBy("rule_id").collect()]
    return quality.validate_accounts(accounts) + quality.validate_rules(rules) + dangling


SILVER_ENTITIES = {"law_sections": "LawSection", "saft_v1_3_nodes": "SpecNode", "amelding_rules": "AmeldingRule", "rate_table": "VatRate"}


def validate_silver(spark: SparkSession, settings: Settings) -> dict:
    """Per silver table its status, first errors and quality; and over the valid ones the mean score."""
    details: dict[str, dict] = {}
    for name, entity in SILVER_ENTITIES.items():
        path = f"{settings.silver}/{name}"
        if not exists(spark, path):
            details[name] = {"status": "missing", "errors": ["File not found"], "quality_score": 0.0}
            continue
        rows = spark.read.parquet(path).withColumn("__ord", F.monotonically_increasing_id())
        found = quality.validate(rows, schemas.constraints(entity), "__ord").first()
        if found["invalid"]:
            details[name] = {"status": "invalid", "errors": list(found["errors"]), "quality_score": 0.0, "total": found["total"], "invalid": found["invalid"]}
        else:
            said = quality.assess(rows, "__ord").first()
            details[name] = {"status": "valid", "errors": [], "quality_score": said["quality_score"], "quality_issues": list(said["issues"]), "recommendations": list(said["recommendations"])}
    valid = [d for d in details.values() if d["status"] == "valid"]
    return {
        "total_files": len(details),
        "valid_files": len(valid),
        "invalid_files": len(details) - len(valid),
        "validation_failed": len(valid) < len(details),
        "quality_issues": any(d["quality_issues"] for d in valid),
        "file_details": details,
        "overall_quality_score": sum(d["quality_score"] for d in valid) / len(valid) if valid else 0.0,
        "quality_recommendations": sorted({r for d in valid if d["quality_issues"] for r in d["recommendations"]}),
    }


@_timed
def export(spark: SparkSession, settings: Settings, what: str = "all", variations: int = 15, per_template: int = 250) -> Result:
    """Writes training samples: glossary (tax and accounting), rules, synthetic or all."""
    read = lambda name: spark.read.parquet(f"{settings.silver}/{name}") if exists(spark, f"{settings.silver}/{name}") else None
    made: dict[str, DataFrame | None] = {}
    if what in ("glossary", "all"):
        sections, accounts, nodes = read("law_sections"), read("chart_of_accounts"), read("saft_v1_3_nodes")
        made["tax_glossary"] = gold.tax_glossary(sections, settings.seed) if sections is not None else None
        parts = [f(t) for f, t in ((gold.account_glossary, accounts), (gold.node_glossary, nodes)) if t is not None]
        made["accounting_glossary"] = parts[0].unionByName(parts[1]) if len(parts) == 2 else parts[0] if parts else None
    rules = read("business_rules")
    if what in ("rules", "all"):
        made["rule_application"] = gold.rule_samples(rules, variations, settings.seed) if rules is not None else None
    if what in ("synthetic", "all"):
        made["conversations"] = gold.conversations(seeds.templates(spark), rules, per_template, settings.seed) if rules is not None else None
    out = Result(f"gold {what}")
    for name, samples in made.items():
        if samples is None:
            out.errors.append(f"{name}: no input")
            continue
        stats = gold.export(samples, f"{settings.gold}/{name}", settings.split_ratio, settings.seed)
        out.counts |= {f"{name}.{k}": v for k, v in stats.items()}
        out.total += stats["total_generated"]
    out.processed, out.failed = out.total, len(out.errors)
    return out


def validate_samples(spark: SparkSession, path: str) -> DataFrame:
    """(file, line, errors) of training samples that break a rule; lines that aren't JSON do too."""
    from lexmill.sources.files import json_lines

    rows = json_lines(spark, path, schemas.schema("GoldTrainingSample"), numbered=True)
    errors = F.when(F.col("bad"), F.array(F.lit("not JSON"))).otherwise(gold.sample_errors(F.col("row.messages"), F.col("row.metadata")))
    return rows.select("file", "line", errors.alias("errors")).where(F.size("errors") > 0)


def evaluation(spark: SparkSession, pattern: str, model: Callable[[str, str], str] | None = evaluate.mock, name: str = "mock", samples: str | None = None) -> dict:
    """The report of an evaluation; empty without samples.

    It holds the graded samples, unless they are to be written as the table ``samples``.
    """
    graded = evaluate.results(evaluate.load(spark, pattern), model).cache()
    rows = [r.asDict() for r in evaluate.metrics(graded).collect()]
    total = next((r for r in rows if r["task"] is None and r["domain"] is None), None)
    if not total or not total["count"]:
        return {}
    keep = lambda r: {k: r[k] for k in ("count", "overall_score", "accuracy", "pass_rate")}
    report = {
        "metadata": {"model": name, "total_samples": total["count"]},
        "aggregate_metrics": {k: total[k] for k in ("overall_score", "accuracy", "citation_coverage", "avg_length_tokens", "pass_rate")},
        "by_task": {r["task"]: keep(r) for r in rows if r["task"] is not None},
        "by_domain": {r["domain"]: keep(r) for r in rows if r["domain"] is not None},
    }
    if samples:
        graded.write.mode("overwrite").parquet(samples)
        report["sample_results"] = samples
        report["failed_samples"] = [r.asDict() for r in evaluate.failed(graded, SHOWN).collect()]
    else:
        report["sample_results"] = [r.asDict() for r in graded.orderBy("sample_no").collect()]
        report["failed_samples"] = [r for r in report["sample_results"] if r["status"] == "fail"]
    graded.unpersist()
    return report
