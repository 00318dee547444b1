"""Command line: seed, ingest, silver, all, list, documents, export, validate, eval, profile, search and schemas."""

from __future__ import annotations

import argparse
import json
import logging
import sys
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import functions as F

from lexmill import schemas, settings
from lexmill.operators import profile
from lexmill.plans import evaluate, jobs, report
from lexmill.session import session
from lexmill.sources import catalog, fetch
from lexmill.sources.files import exists

log = logging.getLogger("lexmill")


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="lexmill", description=__doc__)
    top.add_argument("--settings", help="TOML file")
    top.add_argument("--environment", default="default")
    top.add_argument("--master", help="Spark master, unless spark-submit gives it")
    commands = top.add_subparsers(dest="command", required=True)

    def command(name: str, text: str) -> argparse.ArgumentParser:
        return commands.add_parser(name, help=text, description=text)

    command("seed", "Write the chart of accounts and the business rules.").add_argument("--validate", action="store_true")
    for name, text in (("ingest", "Fetch sources; then process them unless --bronze-only."), ("all", "Seed, ingest and process."), ("list", "Show the sources.")):
        one = command(name, text)
        one.add_argument("--domain")
        one.add_argument("--freq")
        one.add_argument("--bronze-only", action="store_true")
        one.add_argument("--with-validation", action="store_true")
    command("silver", "Process what was fetched.").add_argument("--only", nargs="*")
    command("documents", "Fetch and read the specification's documents.")
    one = command("export", "Write training samples.")
    one.add_argument("what", choices=("glossary", "rules", "synthetic", "all"))
    one.add_argument("--split-ratio", type=float)
    one.add_argument("--variations-per-rule", type=int, default=15)
    one.add_argument("--conversations-per-template", type=int, default=250)
    one = command("validate", "Check silver tables, seed tables or training samples.")
    one.add_argument("what", choices=("silver", "seeds", "samples"))
    one.add_argument("--path", help="of samples")
    one.add_argument("--output")
    one = command("eval", "Grade answers.")
    one.add_argument("--files", required=True, help="JSON lines; may be a pattern")
    one.add_argument("--model-name", default="mock")
    one.add_argument("--use-expected", action="store_true")
    one.add_argument("--output")
    one = command("profile", "Profile a silver table.")
    one.add_argument("table")
    one.add_argument("--html", help="write a page instead")
    one.add_argument("--export", help="write the first rows as JSON lines")
    one.add_argument("--count", type=int, default=10)
    one = command("search", "Find rows of a silver table by a part of a text.")
    one.add_argument("table")
    one.add_argument("query")
    one.add_argument("--field", default="text_plain")
    one.add_argument("--limit", type=int, default=5)
    command("schemas", "Write the JSON Schemas of all entities.").add_argument("--output", default="schemas")
    return top


def _report(data: object, path: str | None) -> None:
    text = json.dumps(data, indent=2, ensure_ascii=False, default=str)
    if path:
        Path(path).parent.mkdir(parents=True, exist_ok=True)
        Path(path).write_text(text, encoding="utf-8")
    else:
        log.info("%s", text)


def main(argv: list[str] | None = None, get: Callable[[str], bytes] = fetch.http_get) -> int:
    """Runs a command; 0 if all went well."""
    args = parser().parse_args(argv)
    own = settings.load(args.settings, args.environment)
    logging.basicConfig(level=own.log_level, format="%(asctime)s %(levelname)s %(name)s %(message)s")
    if problems := own.problems():
        log.error("%s", "; ".join(problems))
        return 2
    if args.command == "schemas":
        log.info("%d schemas", schemas.export(args.output))
        return 0
    spark = session(args.master)

    def sources():  # noqa: ANN202
        rows = catalog.load(spark, own.sources_file)
        rows = catalog.by_domain(rows, args.domain) if args.domain else rows
        return catalog.by_crawl_frequency(rows, args.freq) if args.freq else rows

    def told(result: jobs.Result) -> bool:
        log.info("%s", result.summary())
        return result.success

    if args.command == "seed":
        good = told(jobs.seed(spark, own))
        bad = jobs.validate_seeds(spark, own) if args.validate else []
        for line in bad:
            log.error("%s", line)
        return int(not good or bool(bad))
    if args.command == "list":
        sources().orderBy("source_id").show(1000, truncate=False)
        return 0
    if args.command in ("ingest", "all"):
        good = told(jobs.seed(spark, own)) if args.command == "all" else True
        if not (good and told(jobs.ingest(spark, own, sources(), get))):
            return 1
        if args.bronze_only:
            return 0
        good = told(jobs.process(spark, own, sources()))
        if args.with_validation:
            found = jobs.validate_seeds(spark, own)
            _report(found, None)
            good = good and not found
        return int(not good)
    if args.command == "silver":
        return int(not told(jobs.process(spark, own, catalog.load(spark, own.sources_file), args.only)))
    if args.command == "documents":
        return int(not told(jobs.process_documents(spark, own, get)))
    if args.command == "export":
        from dataclasses import replace

        own = replace(own, split_ratio=args.split_ratio) if args.split_ratio else own
        return int(not told(jobs.export(spark, own, args.what, args.variations_per_rule, args.conversations_per_template)))
    if args.command == "validate":
        if args.what == "silver":
            found = jobs.validate_silver(spark, own)
            _report(found, args.output)
            return int(found["validation_failed"])
        if args.what == "seeds":
            bad = jobs.validate_seeds(spark, own)
        else:
            bad = [r.asDict() for r in jobs.validate_samples(spark, args.path or f"{own.gold}/*/*/*.json").limit(100).collect()]
        _report(bad, args.output)
        return int(bool(bad))
    if args.command == "eval":
        found = jobs.evaluation(spark, args.files, None if args.use_expected else evaluate.mock, args.model_name)
        _report(found or {"error": "no samples"}, args.output)
        return int(not found or found["aggregate_metrics"]["pass_rate"] < evaluate.GATE)
    path = f"{own.silver}/{args.table}"
    if not exists(spark, path):
        log.error("no table %s", path)
        return 1
    rows = spark.read.parquet(path).withColumn("__ord", F.monotonically_increasing_id())
    if args.command == "search":
        profile.head(profile.search(rows, args.query, args.field), ["__ord"], args.limit).drop("__ord").show(args.limit, truncate=80)
    elif args.html:
        text = args.__dict__.get("field") or ("text_plain" if "text_plain" in rows.columns else "description")
        Path(args.html).write_text(report.page(rows, "__ord", text=text), encoding="utf-8")
    elif args.export:
        profile.head(rows, ["__ord"], args.count).drop("__ord").coalesce(1).write.mode("overwrite").json(args.export)
    else:
        fields = [c for c in ("domain", "source_type", "publisher", "category", "kind", "priority", "complexity", "data_type", "cardinality", "law_id", "chapter") if c in rows.columns]
        profile.counts(rows, *fields).orderBy("field", F.desc("n"), "value").show(200, truncate=60)
        profile.completeness(rows, *(c for c in rows.columns if c != "__ord")).show(100, truncate=False)
    return 0


if __name__ == "__main__":
    sys.exit(main())
