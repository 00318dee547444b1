"""Registered queries of the core library that clean texts, read and write files, and run whole jobs.

Files are written to a folder of their own below the session's ``spark.checkpoint.dir``,
which driver and executors share, and read back by the reader that is put to the test.
Fetchers, PDF engines and pages are made from the given tables, so that nothing is left to
the network.
"""

from __future__ import annotations

import io
import json
import tempfile
import uuid
from collections.abc import Iterator
from functools import partial
from urllib.error import HTTPError

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lexmill import schemas, settings
from lexmill.functions import text as T
from lexmill.operators import manifest as manifest_log
from lexmill.operators.checkstate import CheckState
from lexmill.operators.manifest import Manifest
from lexmill.operators.textindex import TextIndex
from lexmill.plans import evaluate, gold, guidance, jobs, legal, report, saft
from lexmill.queries import planted, query, records, table
from lexmill.sources import catalog, fetch, files, html, pdf, seeds, web
from lexmill.streaming import capture


def _folder(spark: SparkSession) -> str:
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        shared = f"file://{tempfile.gettempdir()}/lexmill-queries"
    return f"{shared.rstrip('/')}/lexmill-{uuid.uuid4().hex}"


def _pages(spark: SparkSession, sf_dir: str, markup: str) -> DataFrame:
    """Blocks of the given pages with some markup planted before them."""
    return html.html_blocks(table(spark, sf_dir, "pages").select("page_id", F.expr(planted(markup)).alias("html")))


# --- cleaning ----------------------------------------------------------------------------

_LEGAL = "concat('12 Loven om ', page_id, ' gjelder [Til toppen] alle.\\nSe også § 4\\nGå til neste\\n🔗 Del paragraf\\nAndre ledd <b>', page_id, '</b> kr<img src=\"x\">.\\nRettskilder og mer\\nTredje ledd 7\\nEndret ved lov 1 juni 2020')"


@query("""
SELECT page_id, '12 Loven om ' || page_id || ' gjelder alle. Andre ledd ' || page_id || ' kr. Tredje ledd' AS legal, 'Fjerde ledd om ' || page_id || ' & andre' AS page,
  'Gjelder for ' || page_id || ', Og videre. Slutt' AS section, 'fiskeri ' || page_id || ' kr æå 1⁄2' AS repaired FROM pages
""")
def legal_text_cleaned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Legal texts behind the given pages, without navigation, notes and references, as text and as markup; broken letters put right."""
    number = F.col("page_id").cast("string")
    own = F.concat(F.coalesce("html", F.lit("")), F.lit(" ØØ "))
    last = lambda c: F.substring_index(c, "ØØ ", -1)
    return table(spark, sf_dir, "pages").select(
        "page_id",
        last(T.legal_cleaned(F.concat(own, F.expr(_LEGAL)))).alias("legal"),
        last(T.legal_html_text(F.concat(own, F.lit("<script>x</script><p>Fjerde ledd om "), number, F.lit(" &amp; andre</p>\nNavigasjon her")))).alias("page"),
        last(T.section_text_cleaned(F.concat(own, F.lit("Gjelder [12] for (3) "), number, F.lit(", jf. loven nr 2. Og videre. se kapittel 4. Slutt")))).alias("section"),
        last(T.unicode_normalized(F.concat(own, F.lit("ﬁskeri "), number, F.lit(" kr Ã¦Ã¥ ½")))).alias("repaired"),
    )


@query("""
SELECT page_id, '<div><a href="u' || page_id || '">t</a></div>' AS shown, '<div id="p' || page_id || '">a</div>' AS section FROM pages
""")
def page_markup_written(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Markup of pages for display, and that of one of their sections."""
    number = F.col("page_id").cast("string")
    shown = F.concat(F.lit("<div class=x><script>y</script><a href='u"), number, F.lit("' onclick='z'>t</a></div>"))
    page = F.concat(shown, F.lit("<div id=p"), number, F.lit(">a<a href='/del-paragraf'>s</a></div>"), F.coalesce("html", F.lit("")))
    whole = html.display_html_udf(page)
    written = F.when(~F.contains(whole, F.lit("<script")) & ~F.contains(whole, F.lit("<nav")) & F.contains(whole, F.lit("<article>")), F.regexp_extract(whole, "^(<div>.*?</div>)", 1))
    return table(spark, sf_dir, "pages").select("page_id", written.alias("shown"), html.section_html_udf(page, F.concat(F.lit("p"), number)).alias("section"))


@query("""
SELECT page_id, 'Lov ' || page_id AS law_title, 'Kapittel ' || (page_id % 9 + 1) || '. Avgift' AS chapter, true AS repealed, (page_id % 28 + 1) || ' juni 2020' AS amended FROM pages
""")
def page_plain_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Title, chapter and changes of law pages, as the older reading has them."""
    page = "concat('<h1 class=\"title\">Lov ', page_id, '</h1><h2>Kapittel ', page_id % 9 + 1, '. Avgift</h2><p>Endret ved lov ', page_id % 28 + 1, ' juni 2020.</p>')"
    found = legal.plain_metadata(_pages(spark, sf_dir, page), ["page_id"])
    return found.select("page_id", "law_title", "chapter", "repealed", F.array_join("amended_dates", "; ").alias("amended"))


# --- guidance, documents, samples ------------------------------------------------------------


@query("""
SELECT page_id, 'field' AS kind, 'amelding_field_001' AS rule_id, 'Skjemafelt: n' || page_id AS title, 'Ditt navn' AS description, 'high' AS priority,
  'Felt n' || page_id || ' er påkrevd; Felt n' || page_id || ' kan maksimalt ha 9 tegn; Felt n' || page_id || ' må ha minst 2 tegn' AS requirements FROM pages
UNION ALL
SELECT page_id, 'submission', 'amelding_submission_001', 'Innleveringsregel: Levering innen frist ' || page_id || '...', 'Levering innen frist ' || page_id, 'high', '' FROM pages
""")
def page_form_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rules of form fields, and of strings that speak of deadlines."""
    page = "concat('<main><form><label>Ditt navn</label><input name=n', page_id, ' required minlength=2 maxlength=9><input name=m></form><p>Levering innen frist ', page_id, '</p></main>')"
    found = guidance.form_rules(_pages(spark, sf_dir, page), ["page_id"])
    return found.select("page_id", "kind", "rule_id", "title", "description", "priority", F.array_join("requirements", "; ").alias("requirements"))


@query("""
SELECT page_id::VARCHAR AS path, 'El' || page_id AS node_path, '0..*' AS cardinality, 'Max length: ' || (page_id % 90 + 1) AS detail, 'Field is required' AS check FROM pages
UNION ALL SELECT page_id::VARCHAR, 'Sub' || page_id, '1..1', '', '' FROM pages WHERE page_id % 2 = 0
""")
def document_table_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nodes of documents' tables, whose columns their headers tell."""
    number = F.col("page_id").cast("string")
    row = lambda *cells: F.array(*(c if isinstance(c, Column) else F.lit(c) for c in cells))
    first = row(F.concat(F.lit("El"), number), "0..U", F.concat(F.lit("Name, max "), (F.col("page_id") % 90 + 1).cast("string"), F.lit(" characters, required")), "")
    second = F.when(F.col("page_id") % 2 == 0, row(F.concat(F.lit("Sub"), number), "1", "Other", ""))
    docs = table(spark, sf_dir, "pages").select(number.alias("path"), F.array(F.array_compact(F.array(row("Element", "Rep", "Description", "Type"), first, second, row("element", "1", "x", "")))).alias("tables"))
    found = saft.table_nodes(docs)
    return found.select("path", "node_path", "cardinality", F.coalesce(F.get("technical_details", F.lit(0)), F.lit("")).alias("detail"), F.coalesce(F.get("validation_rules", F.lit(0)), F.lit("")).alias("check"))


@query("""
SELECT page_id, 'Hva er konto ' || page_id || '?' AS account_question, 'Salg på ' || page_id || ' Eksempler: a, b, c [NS 4102 konto ' || page_id || ']' AS account_answer, 'account_class_' || (page_id % 8 + 1) AS account_family,
  'Hva er ''Node' || page_id || ''' i SAF-T?' AS node_question, 'A node with a long description [SAF-T 1.30 A.Node' || page_id || ']' AS node_answer, 'saft_level_2' AS node_family FROM pages
""")
def account_and_node_glossary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Questions about accounts and about nodes of the specification."""
    number = F.col("page_id").cast("string")
    pages = table(spark, sf_dir, "pages")
    accounts = pages.select(number.alias("account_id"), F.concat(F.lit("Konto "), number).alias("account_label"), (F.col("page_id") % 8 + 1).cast("string").alias("account_class"), F.concat(F.lit("Salg på "), number).alias("description"), F.array(*map(F.lit, "abcd")).alias("examples"))
    nodes = pages.select(number.alias("node_id"), F.concat(F.lit("Node"), number).alias("node_label"), F.lit("A node with a long description").alias("description"), F.lit("1.30").alias("version"), F.concat(F.lit("A.Node"), number).alias("node_path"), F.lit(2).alias("node_level"))

    def said(samples: DataFrame, name: str, prefix: str) -> DataFrame:
        source = F.replace(F.get("metadata.source_ids", F.lit(0)), F.lit(prefix), F.lit(""))
        return samples.select(source.cast("long").alias("page_id"), F.get("messages", F.lit(1))["content"].alias(f"{name}_question"), F.get("messages", F.lit(2))["content"].alias(f"{name}_answer"), F.col("metadata.family_key").alias(f"{name}_family"))

    return said(gold.account_glossary(accounts), "account", "chart_of_accounts_").join(said(gold.node_glossary(nodes), "node", "saft_"), "page_id")


#: Numbers, in the order of their ids, of the seed rules that lack an account, a rate or a code; fixed values.
_INELIGIBLE = (0, 29)


@query(f"""
WITH t(template_id, two) AS (VALUES ('expense_entry', false), ('vat_question', false), ('account_help', false), ('quick_posting', false), ('correction', false), ('multi_item', true)), k AS (SELECT template_id, two, unnest(range(0, 50)) AS k FROM t),
h AS (SELECT *, ('0x' || substr(md5('42:' || template_id || ':' || k || ':r1'), 1, 7))::INT AS h1, ('0x' || substr(md5('42:' || template_id || ':' || k || ':r2'), 1, 7))::INT AS h2 FROM k),
p AS (SELECT *, h1 % CASE WHEN two THEN 15 ELSE 30 END AS p1, 15 + h2 % 15 AS p2 FROM h)
SELECT template_id, count(*) AS n, 0::BIGINT AS unfilled FROM p WHERE p1 NOT IN ({", ".join(map(str, _INELIGIBLE))}) AND (NOT two OR p2 NOT IN ({", ".join(map(str, _INELIGIBLE))})) GROUP BY template_id
""")
def rule_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations from each template with rules picked by hash, and how many have a gap left."""
    talks = gold.conversations(seeds.templates(spark), seeds.business_rules(spark), 50)
    gap = F.exists("messages", lambda m: m["content"].rlike(r"\{\w+\}"))
    return talks.groupBy(F.col("metadata.family_key").alias("template_id")).agg(F.count(F.lit(1)).alias("n"), F.count_if(gap).alias("unfilled"))


# --- sources -------------------------------------------------------------------------------


@query("""
SELECT 'page_' || page_id AS source_id, url, 'unknown' AS domain, 'current' AS version, 'NO' AS jurisdiction, CASE WHEN page_id % 2 = 0 THEN 'law' ELSE 'unknown' END AS source_type FROM pages
""")
def csv_catalogue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A catalogue written as CSV with some of its columns, and read with defaults; a file that isn't there has no rows."""
    path = _folder(spark)
    rows = table(spark, sf_dir, "pages").select(F.concat(F.lit("page_"), F.col("page_id").cast("string")).alias("source_id"), "url", F.when(F.col("page_id") % 2 == 0, "law").alias("source_type"))
    rows.write.option("header", True).csv(path)
    found = catalog.load(spark, path).unionByName(catalog.load(spark, f"{path}-missing"))
    return catalog.with_defaults(found).select("source_id", "url", "domain", "version", "jurisdiction", "source_type")


@query("""
SELECT 'line' AS kind, doc_id AS id, CASE WHEN doc_id % 7 = 0 THEN NULL ELSE lang END AS name, doc_id % 7 = 0 AS bad FROM documents WHERE doc_id % 7 <> 0 AND doc_id % 10 <> 0
UNION ALL SELECT 'line', NULL, NULL, true FROM documents WHERE doc_id % 7 = 0 AND doc_id % 10 <> 0
UNION ALL SELECT 'array', n_nationkey, n_name, false FROM nation
""")
def json_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON lines, some of them comments, blank or no JSON, and the rows of a JSON array."""
    path = _folder(spark)
    docs, own = table(spark, sf_dir, "documents"), F.to_json(F.struct(F.col("doc_id").alias("id"), F.col("lang").alias("name")))
    line = F.when(F.col("doc_id") % 10 == 0, F.concat(F.lit("  # "), own)).when(F.col("doc_id") % 7 == 0, "{not json").otherwise(own)
    docs.select(F.explode(F.array(line, F.lit("  "))).alias("value")).write.text(f"{path}/lines")
    nations = table(spark, sf_dir, "nation").select(F.struct(F.col("n_nationkey").cast("long").alias("id"), F.col("n_name").alias("name")).alias("row"))
    nations.agg(F.to_json(F.collect_list("row")).alias("value")).write.text(f"{path}/array")
    row = schemas.T.StructType.fromDDL("id long, name string")
    lines = files.json_lines(spark, f"{path}/lines", row).select(F.lit("line").alias("kind"), "row.id", "row.name", "bad")
    array = files.json_array(spark, f"{path}/array", row).select(F.lit("array").alias("kind"), "id", "name", F.lit(False).alias("bad"))
    return lines.unionByName(array).unionByName(files.json_array(spark, f"{path}/missing", row).select(F.lit("array").alias("kind"), "id", "name", F.lit(False).alias("bad")))


@query("""
SELECT min(line) AS first_line, max(line) AS last_line, count(*) AS n, count(*) FILTER (bad) AS n_bad FROM (
  SELECT 2 * row_number() OVER (ORDER BY n_nationkey) - 1 AS line, n_nationkey % 7 = 0 AS bad FROM nation)
""")
def json_lines_numbered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of a file of samples with their numbers; every other one is blank."""
    path = _folder(spark)
    own = F.when(F.col("n_nationkey") % 7 == 0, "{").otherwise(F.to_json(F.struct("n_name")))
    rows = table(spark, sf_dir, "nation").select(F.struct("n_nationkey", own.alias("value")).alias("r"))
    rows.agg(F.array_join(F.transform(F.array_sort(F.collect_list("r")), lambda r: r["value"]), "\n\n").alias("value")).write.text(path)
    found = files.json_lines(spark, path, schemas.T.StructType.fromDDL("n_name string"), numbered=True)
    return found.agg(F.min("line").alias("first_line"), F.max("line").alias("last_line"), F.count(F.lit(1)).alias("n"), F.count_if("bad").alias("n_bad"))


def _as_one_file(path: str, name: str, between: tuple[str, str, str], rows: object) -> None:
    """One file of texts, written as they come: what stands before, between and after them."""
    from pyarrow import fs

    system, folder = fs.FileSystem.from_uri(path)
    system.create_dir(folder, recursive=True)
    with system.open_output_stream(f"{folder}/{name}") as f:
        f.write(between[0].encode())
        for i, r in enumerate(rows):
            f.write(((between[1] if i else "") + r["value"]).encode())
        f.write(between[2].encode())


def _as_arrays(folder: str, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A JSON array a task, a file of the values as they come; how many they are."""
    from pyarrow import fs
    from pyspark import TaskContext

    system, at = fs.FileSystem.from_uri(folder)
    system.create_dir(at, recursive=True)
    n = 0
    with system.open_output_stream(f"{at}/part-{TaskContext.get().partitionId():05d}.json") as f:
        f.write(b" [")
        for batch in batches:
            if values := batch.column("value").to_pylist():
                f.write((b"," if n else b"") + ",".join(values).encode())
                n += len(values)
        f.write(b"]\n")
    yield pa.RecordBatch.from_pydict({"n": pa.array([n], pa.int64())})


@query(r"""
SELECT o_orderkey AS id, o_orderpriority || ' "]},{\[' || o_orderstatus || '\' AS note, o_totalprice AS price, '{"a": "}' || o_custkey || '"}' AS part FROM orders
""")
def json_large_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All orders in JSON arrays without lines, a file for each task that reads orders, read in ranges that begin and end anywhere in them."""
    path = _folder(spark)
    note = F.concat("o_orderpriority", F.lit(' "]},{\\['), "o_orderstatus", F.lit("\\"))
    part = F.concat(F.lit('{"a": "}'), F.col("o_custkey").cast("string"), F.lit('"}'))
    row = F.struct(F.col("o_orderkey").alias("id"), note.alias("note"), F.col("o_totalprice").alias("price"), F.array(F.struct(part.alias("x"))).alias("parts"))
    table(spark, sf_dir, "orders").select(F.to_json(row).alias("value")).mapInArrow(partial(_as_arrays, path), "n long").agg(F.sum("n")).collect()
    kind = schemas.T.StructType.fromDDL("id long, note string, price double, parts array<struct<x:string>>")
    return files.json_array(spark, path, kind, size=1 << 16).select("id", "note", "price", F.get("parts", F.lit(0))["x"].alias("part"))


@query("""
WITH o AS (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) AS n, o_orderkey % 7 = 0 AS bad, o_orderkey % 10 = 3 AS note FROM orders)
SELECT 2 * n - 1 AS line, CASE WHEN bad THEN NULL ELSE o_orderkey END AS id, bad FROM o WHERE NOT note
""")
def lines_numbered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All orders as lines of one file, which is split, with their numbers; every other line is blank, some are comments or broken."""
    path, k = _folder(spark), F.col("o_orderkey")
    value = F.when(k % 10 == 3, "# note").when(k % 7 == 0, '{"id": ').otherwise(F.to_json(F.struct(k.alias("id"), "o_orderpriority")))
    ordered = table(spark, sf_dir, "orders").select("o_orderkey", value.alias("value")).repartitionByRange(1, "o_orderkey").sortWithinPartitions("o_orderkey")
    ordered.select("value").foreachPartition(partial(_as_one_file, path, "orders.jsonl", ("", "\n\n", "")))
    return files.json_lines(spark, path, schemas.T.StructType.fromDDL("id long"), numbered=True).select("line", "row.id", "bad")


# --- what is kept between runs ---------------------------------------------------------------


@query("SELECT doc_id, lang FROM documents WHERE contains(lower(text), 'license')")
def search_indexed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents that speak of a licence, by an index of trigrams that was made in two parts."""
    docs, index = table(spark, sf_dir, "documents").select("doc_id", "lang", "text"), TextIndex(spark, f"{_folder(spark)}/index")
    for segment in (0, 1):
        index.append(docs.where(F.col("doc_id") % 2 == segment), f"part{segment}", "doc_id")
    return docs.select("doc_id", "lang").join(index.search("LICENSE").select(F.col("id").alias("doc_id")), "doc_id", "left_semi")


_KEPT_SQL = """
WITH d AS (SELECT * FROM documents UNION ALL SELECT * FROM documents WHERE doc_id % 8 = 3),
r AS (SELECT CASE WHEN doc_id % 5 = 0 THEN '' WHEN doc_id % 5 = 1 THEN 'no url' ELSE 'https://x.org/' || doc_id END AS source_url,
  CASE WHEN doc_id % 7 = 0 THEN 'zz' ELSE sha256(text) END AS sha256, CASE WHEN lang = 'en' THEN 'tax' WHEN lang = 'de' THEN NULL ELSE lang END AS domain, source AS publisher FROM d)
"""


@query(
    _KEPT_SQL
    + """SELECT 8::BIGINT AS read_first, 1::BIGINT AS read_then, 0::BIGINT AS read_last, count(*) AS records,
  (count(*) FILTER (coalesce(source_url, '') = '') + count(*) FILTER (coalesce(sha256, '') = '') + count(*) FILTER (coalesce(domain, '') = '') + count(*) FILTER (coalesce(publisher, '') = ''))::BIGINT AS missing,
  count(*) FILTER (source_url <> '' AND NOT regexp_matches(source_url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]+')) AS bad_urls, count(*) FILTER (sha256 <> '' AND NOT regexp_matches(sha256, '^[a-f0-9]{64}$')) AS bad_hashes,
  count(*) FILTER (domain <> '' AND domain NOT IN ('tax', 'accounting', 'reporting')) AS bad_domains, (SELECT count(*) FROM (SELECT sha256 FROM r GROUP BY sha256 HAVING count(*) > 1)) AS repeated FROM r"""
)
def quality_by_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of records in eight files, then with one more, which alone is read."""
    path, docs = _folder(spark), records(spark, sf_dir)
    state = CheckState(spark, f"{path}-state", "doc_id", "sha256")
    for k in range(8):
        docs.where(F.col("doc_id") % 8 == k).coalesce(1).write.mode("append").parquet(path)
    first = state.update(path)
    docs.where(F.col("doc_id") % 8 == 3).coalesce(1).write.mode("append").parquet(path)
    then, last = state.update(path), state.update(path)
    counts = state.assess().select(F.lit(first).cast("long").alias("read_first"), F.lit(then).cast("long").alias("read_then"), F.lit(last).cast("long").alias("read_last"), "records", "missing", "bad_urls", "bad_hashes", "bad_domains")
    return counts.join(F.broadcast(state.repeated().agg(F.count(F.lit(1)).alias("repeated"))))


def file_get(url: str) -> bytes:
    """As the usual fetcher, but without waiting for a file that isn't there."""
    return fetch.http_get(url, sleep=lambda _: None)


@query("""
SELECT page_id, CASE WHEN page_id % 10 <> 7 THEN sha256(html) END AS sha256, page_id % 10 = 7 AS failed FROM pages
""")
def pages_by_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pages as files, fetched by URL through the data source; every tenth isn't there."""
    path, pages = _folder(spark), table(spark, sf_dir, "pages")
    name = F.concat(F.lit("p"), F.col("page_id").cast("string"))
    pages.where("page_id % 10 != 7").select(name.alias("name"), F.col("html").alias("content")).foreachPartition(partial(_written, path))
    root = path.removeprefix("file://").removeprefix("file:")
    web.prepare(pages.select(F.concat(F.lit(f"file://localhost{root}/"), name, F.lit(".html")).alias("url")), f"{path}-urls", host=F.regexp_extract("url", r"(\d)\.html$", 1))
    spark.dataSource.register(web.Pages)
    found = spark.read.format("lexmill_pages").option("path", f"{path}-urls").option("rate", "0").option("opener", "lexmill.job_queries:file_get").load()
    number = F.regexp_extract("url", r"/p(\d+)\.html$", 1).cast("long")
    return found.select(number.alias("page_id"), F.sha2("content", 256).alias("sha256"), F.col("error").isNotNull().alias("failed"))


def _first_engine(content: bytes) -> str:
    if len(content) % 3 == 0:
        raise ValueError("not for this engine")
    return "first" if len(content) % 3 == 1 else " "


def _second_engine(content: bytes) -> str:
    if len(content) % 2 == 0:
        raise ValueError("nor for this one")
    return "second"


def _tables(content: bytes) -> list:
    return [[["Element", "Type"], [str(len(content)), None]]] if len(content) % 5 == 0 else []


@query("""
WITH p AS (SELECT page_id::VARCHAR AS path, octet_length(encode(html)) AS n FROM pages),
t AS (SELECT path, n, CASE WHEN n % 3 = 1 THEN 'first' WHEN n % 2 = 1 THEN 'second' WHEN n % 3 = 2 THEN ' ' ELSE '' END AS text FROM p)
SELECT path, trim(text) AS text, CASE WHEN n % 5 = 0 THEN n::VARCHAR END AS cell, trim(text) = '' AND n % 5 <> 0 AS failed FROM t
""")
def document_engines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts of documents by the first engine that gives one, their tables, and which failed."""
    rows = table(spark, sf_dir, "pages").select(F.col("page_id").cast("string").alias("path"), F.col("html").cast("binary").alias("content"))
    found = pdf.read_documents(rows, (_first_engine, _second_engine), _tables)
    cell = F.get(F.get(F.get("tables", F.lit(0)), F.lit(1)), F.lit(0))
    return found.select("path", F.trim("text").alias("text"), cell.alias("cell"), F.col("error").isNotNull().alias("failed"))


class _Answers:
    """A server: a page that isn't there, one that comes at the third try, one that never comes."""

    def __init__(self) -> None:
        self.asked: dict[str, int] = {}

    def __call__(self, request: object, timeout: float) -> io.BytesIO:
        url = request.full_url
        kind = int(url.rsplit("/", 1)[1]) % 4
        self.asked[url] = self.asked.get(url, 0) + 1
        if kind == 1 or kind == 3 or kind == 2 and self.asked[url] <= 2:
            raise HTTPError(url, 404 if kind == 1 else 503, "no", {}, None)
        return io.BytesIO(f"{url} at {self.asked[url]}".encode())


def _get(url: str) -> bytes:
    return fetch.http_get(url, opener=_Answers(), sleep=lambda _: None)


@query("""
SELECT 'p' || page_id AS source_id, CASE page_id % 4 WHEN 0 THEN 'http://h/' || page_id || ' at 1' WHEN 2 THEN 'http://h/' || page_id || ' at 3' END AS content,
  CASE page_id % 4 WHEN 1 THEN 'HTTPError: HTTP Error 404: no' WHEN 3 THEN 'HTTPError: HTTP Error 503: no' END AS error FROM pages
""")
def fetched_with_retries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages fetched inside executors; server errors are tried again, and failures are rows."""
    number = F.col("page_id").cast("string")
    sources = table(spark, sf_dir, "pages").select(F.concat(F.lit("p"), number).alias("source_id"), F.concat(F.lit("http://h/"), number).alias("url"))
    return fetch.fetch(sources, _get).select("source_id", F.decode("content", "UTF-8").alias("content"), "error")


@query("""
SELECT * FROM (VALUES ('data_dir', 's3://b/x'), ('http_retries', '5'), ('http_timeout', '60'), ('remote', 'true'), ('split_ratio', '0.8'), ('problems', '0')) AS t(name, value)
""")
def settings_layers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Defaults under a file's section for all, under its section for an environment."""
    own = settings.load(str(seeds.RESOURCES / "settings.example.toml"), "production")
    found = {"data_dir": own.data_dir, "http_retries": own.http_retries, "http_timeout": own.http_timeout, "remote": str(own.remote).lower(), "split_ratio": own.split_ratio, "problems": len(own.problems())}
    return spark.createDataFrame([(k, str(v)) for k, v in found.items()], "name string, value string")


# --- jobs ----------------------------------------------------------------------------------

_PLANS = ("law", "rates", "guidance", "guidance", "spec")


def _page_of(url: str) -> bytes:
    """The page behind a made-up URL, ``mem://plan/number``; of every eleventh there is none."""
    _, _, plan, number = url.split("/")
    n = int(number)
    if n % 11 == 0:
        raise OSError("gone")
    law = f"<h1 class='title'>Lov {n}</h1><div class='kapittel'><h2>Kapittel 1. Om</h2><div class='paragraf'><h3>§ 1-1. Omfang</h3><p>Loven gjelder for alle varer og tjenester i landet, og sikrer at avgift beregnes på samme måte for alle som omsetter dem her.</p></div><div class='paragraf'><h3>§ 1-2. Unntak</h3><p>Kort unntak her.</p></div></div>"
    rates = f"<main><table><tr><th>Type</th><th>Sats</th></tr><tr><td>Mat</td><td>{n % 20 + 5} %</td></tr></table></main>"
    overview = "<main><h2>Innlevering</h2><p>A-melding må leveres innen utgangen av måneden.</p></main>"
    forms = "<main><form><input name=n required minlength=2></form></main>"
    spec = f"<main><h2>saft.Header{n} felt</h2><p>Feltet må ha dato og en beskrivelse av innholdet.</p></main>"
    return (law, rates, overview, forms, spec)[n % 5].encode() if plan == _PLANS[n % 5] else b""


def _sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, number = F.col("page_id"), F.col("page_id").cast("string")
    plan = F.get(F.array(*map(F.lit, _PLANS)), (k % 5).cast("int"))
    name = F.get(F.array(*map(F.lit, ("law_", "rates_", "amelding_overview_", "amelding_forms_", "saft_"))), (k % 5).cast("int"))
    given = {"source_id": F.concat(name, number), "url": F.concat(F.lit("mem://"), plan, F.lit("/"), number), "source_type": plan, "domain": F.lit("tax"), "publisher": F.lit("Staten"), "title": F.concat(F.lit("Lov "), number)}
    return table(spark, sf_dir, "pages").select(*(given.get(c, F.lit(None).cast("string")).alias(c) for c in catalog.COLUMNS))


@query("""
WITH k AS (SELECT page_id % 5 AS plan, page_id % 11 = 0 AS gone FROM pages)
SELECT 'bronze' AS job, 'total' AS name, count(*) AS n FROM k UNION ALL SELECT 'bronze', 'failed', count(*) FILTER (gone) FROM k UNION ALL SELECT 'bronze', 'changed', count(*) FILTER (NOT gone) FROM k
UNION ALL SELECT 'again', 'changed', 0 UNION ALL SELECT 'manifest', 'rows', 2 * count(*) FROM k
UNION ALL SELECT 'silver', 'total', count(*) FROM k UNION ALL SELECT 'silver', 'failed', count(*) FILTER (gone) FROM k
UNION ALL SELECT 'silver', 'law_sections', 2 * count(*) FILTER (plan = 0 AND NOT gone) FROM k UNION ALL SELECT 'silver', 'rate_table', count(*) FILTER (plan = 1 AND NOT gone) FROM k
UNION ALL SELECT 'silver', 'amelding_rules', count(*) FILTER (plan IN (2, 3) AND NOT gone) FROM k UNION ALL SELECT 'silver', 'saft_v1_3_nodes', count(*) FILTER (plan = 4 AND NOT gone) FROM k
UNION ALL SELECT 'valid', 'silver tables', 4 UNION ALL SELECT 'gold', 'tax_glossary', count(*) FILTER (plan = 0 AND NOT gone) FROM k
UNION ALL SELECT 'gold', 'accounting_glossary', 42 + count(*) FILTER (plan = 4 AND NOT gone) FROM k UNION ALL SELECT 'gold', 'rule_application', 420
UNION ALL SELECT 'gold', 'broken samples', 0 UNION ALL SELECT 'seed', 'chart_of_accounts', 42 UNION ALL SELECT 'seed', 'business_rules', 30 UNION ALL SELECT 'seed', 'problems', 0
""")
def all_jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Seeds, ingestion twice, processing, checks and exports: what each job counted."""
    own, sources = settings.Settings(data_dir=_folder(spark)), _sources(spark, sf_dir)
    out: list[tuple[str, str, int]] = []
    out += [("seed", k, n) for k, n in jobs.seed(spark, own).counts.items()] + [("seed", "problems", len(jobs.validate_seeds(spark, own)))]
    first, again = (jobs.ingest(spark, own, sources, _page_of, run) for run in ("r1", "r2"))
    out += [("bronze", "total", first.total), ("bronze", "failed", first.failed), ("bronze", "changed", first.counts["changed"]), ("again", "changed", again.counts["changed"])]
    out.append(("manifest", "rows", Manifest(spark, f"{own.bronze}/manifest").history().count()))
    done = jobs.process(spark, own, sources)
    out += [("silver", "total", done.total), ("silver", "failed", done.failed), *(("silver", k, n) for k, n in done.counts.items())]
    out.append(("valid", "silver tables", jobs.validate_silver(spark, own)["valid_files"]))
    made = [jobs.export(spark, own, what) for what in ("glossary", "rules")]
    out += [("gold", k.removesuffix(".total_generated"), n) for r in made for k, n in r.counts.items() if k.endswith(".total_generated")]
    broken = sum(jobs.validate_samples(spark, f"{own.gold}/{name}/split=*").count() for name in ("tax_glossary", "accounting_glossary", "rule_application"))
    return spark.createDataFrame([*out, ("gold", "broken samples", broken)], "job string, name string, n long")


_ASKED = "CASE WHEN page_id % 2 = 0 THEN 'glossary_define' ELSE 'posting_proposal' END"


@query(f"""
WITH s AS (SELECT {_ASKED} AS task, CASE WHEN page_id % 3 = 0 THEN 'tax' ELSE 'accounting' END AS domain FROM pages)
SELECT 'all' AS name, count(*) AS n, 1.0 AS accuracy FROM s UNION ALL SELECT task, count(*), 1.0 FROM s GROUP BY task UNION ALL SELECT domain, count(*), 1.0 FROM s GROUP BY domain
""")
def evaluation_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report of an evaluation over files of samples whose expected answers are graded."""
    path, k = _folder(spark), F.col("page_id")
    message = lambda role, content: F.struct(F.lit(role).alias("role"), content.alias("content"))
    metadata = F.struct(F.when(k % 3 == 0, "tax").otherwise("accounting").alias("domain"), F.expr(_ASKED).alias("task"), F.array(F.lit("s")).alias("source_ids"))
    rows = table(spark, sf_dir, "pages").select(F.array(message("system", F.lit("s")), message("user", F.col("url"))).alias("messages"), metadata.alias("metadata"), F.concat(F.lit("Svar om "), "url", F.lit(" [kilde]")).alias("expected_output"))
    rows.write.json(path)
    found = jobs.evaluation(spark, f"{path}/*.json", None, samples=f"{path}-graded")
    groups = {"all": {"count": found["metadata"]["total_samples"], **found["aggregate_metrics"]}} | found["by_task"] | found["by_domain"]
    return spark.createDataFrame([(name, v["count"], v["accuracy"]) for name, v in groups.items()], "name string, n long, accuracy double")


@query("""
SELECT 'p' || page_id AS source_id, true AS success, 1 AS outcomes, octet_length(encode(html))::BIGINT AS size_bytes, sha256(html) AS sha256 FROM pages
""")
def arriving_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pages as files that arrive in a folder, captured by a stream."""
    path, own = _folder(spark), settings.Settings(data_dir=_folder(spark))
    table(spark, sf_dir, "pages").select(F.concat(F.lit("p"), F.col("page_id").cast("string")).alias("name"), F.col("html").alias("content")).foreachPartition(partial(_written, path))
    capture.capture_stream(capture.arriving_files(spark, path), own, f"{path}-state").awaitTermination()
    rows = Manifest(spark, f"{own.bronze}/manifest").history()
    return rows.groupBy("source_id").agg(F.bool_and("success").alias("success"), F.count(F.lit(1)).cast("int").alias("outcomes"), F.max("size_bytes").alias("size_bytes"), F.max("sha256").alias("sha256"))


_VERSION = "page_id % 2 = 0 AND page_id % 3 = 0"


@query(f"""
SELECT 'p' || page_id AS source_id, sha256(CASE WHEN {_VERSION} THEN '2' ELSE '1' END || html) AS sha256, 1 + ({_VERSION})::INT AS changes, 1 AS contents FROM pages
""")
def captured_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Versions of the pages through three streams into one bronze: later ones, older ones that arrive late, known ones that arrive again.

    Even pages come by one stream, the others and some known ones by a second, and a third one
    reads the first one's files anew.  Each page has one last version in the end.
    """
    path, own = _folder(spark), settings.Settings(data_dir=_folder(spark))
    pages = table(spark, sf_dir, "pages").select("page_id", "html")

    def arrive(folder: str, version: int, some: str) -> None:
        content = F.concat(F.lit(str(version)), "html").cast("binary")
        made = pages.where(some).select(F.concat(F.lit("p"), F.col("page_id").cast("string")).alias("source_id"), F.lit("u").alias("url"), content.alias("content"), F.lit(None).cast("string").alias("error"), F.lit(f"2024-01-0{version + 1}").cast("timestamp").alias("modified_at"))
        made.write.mode("append").parquet(f"{path}/{folder}")

    def run(folder: str, checkpoint: str) -> None:
        live = spark.readStream.schema("source_id string, url string, content binary, error string, modified_at timestamp").parquet(f"{path}/{folder}")
        capture.capture_stream(live, own, f"{path}-{checkpoint}", commits=2).awaitTermination()

    arrive("a", 1, "page_id % 2 = 0")
    run("a", "first")
    arrive("a", 2, _VERSION)
    arrive("a", 0, "page_id % 2 = 0 and page_id % 5 = 0")
    run("a", "first")
    arrive("b", 1, "page_id % 2 = 1 or page_id % 10 = 0")
    run("b", "second")
    run("a", "third")
    manifest = Manifest(spark, f"{own.bronze}/manifest")
    changes = manifest.history().groupBy("source_id").agg(F.count_if("changed").cast("int").alias("changes"))
    sources = manifest.last().select("source_id")
    contents = jobs.bronze_pages(spark, own, sources).groupBy("source_id").agg(F.first(F.sha2("content", 256)).alias("sha256"), F.count(F.lit(1)).cast("int").alias("contents"))
    return contents.join(changes, "source_id")


@query("""
WITH o AS (SELECT 'c' || o_custkey AS source_id, o_orderdate AS t, sha256(o_orderkey::VARCHAR) AS h FROM orders)
SELECT source_id, max_by(h, (t, h)) AS sha256, max_by(strftime(t, '%Y'), (t, h)) AS run_id, count(*) AS outcomes FROM o GROUP BY source_id
""")
def manifest_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run for each year of the orders, compacted on the way: the last version of each customer, and all outcomes."""
    manifest, day = Manifest(spark, f"{_folder(spark)}/manifest"), F.col("o_orderdate")
    orders = table(spark, sf_dir, "orders")
    given = {"source_id": F.concat(F.lit("c"), F.col("o_custkey").cast("string")), "success": F.lit(True), "sha256": F.sha2(F.col("o_orderkey").cast("string").cast("binary"), 256), "changed": F.lit(True), "run_id": F.year(day).cast("string"), "captured_at": day}
    rows = orders.select(*(given.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in schemas.T.StructType.fromDDL(manifest_log.ROWS)))
    for year in range(*orders.agg(F.min(F.year(day)), F.max(F.year(day)) + 1).first()):  # a few years
        manifest.commit(rows.where(F.col("run_id") == str(year)), str(year))
        manifest.compact(3)
    outcomes = manifest.history().groupBy("source_id").agg(F.count(F.lit(1)).alias("outcomes"))
    return manifest.last().select("source_id", "sha256", "run_id").join(outcomes, "source_id")


def _written(path: str, rows: object) -> None:
    """Files outside Spark's own formats, one a row, by Arrow's file systems."""
    from pyarrow import fs

    system, folder = fs.FileSystem.from_uri(path)
    system.create_dir(folder, recursive=True)
    for r in rows:
        with system.open_output_stream(f"{folder}/{r['name']}.html") as f:
            f.write(r["content"].encode())


@query("SELECT * FROM (VALUES ('entities', 11), ('fields', 1), ('required', 1)) AS t(name, n)")
def schema_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The entities as JSON Schema: how many, and whether all have fields and required ones among them."""
    made = [json.loads(json.dumps(schemas.json_schema(name))) for name in schemas.entities()]
    rows = [("entities", len(made)), ("fields", int(all(m["properties"] for m in made))), ("required", int(all(set(m["required"]) <= set(m["properties"]) for m in made)))]
    return spark.createDataFrame(rows, "name string, n int")


@query("SELECT count(*) AS n, least(count(*), 100) AS cards, count(DISTINCT lang) AS bars, true AS filter FROM documents")
def profile_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The page of a table's profile: its size, sample cards, bars of a distribution and the filter over the cards."""
    docs = table(spark, sf_dir, "documents").select("doc_id", F.col("lang").alias("domain"), F.col("text").alias("text_plain"))
    made = report.page(docs, "doc_id", ("domain",))
    size = int(made.split("<p>", 1)[1].split(" ", 1)[0])
    return spark.createDataFrame([(size, made.count("<div class=card "), made.count("<div class=bar "), "oninput='pick" in made and "<select" in made)], "n long, cards long, bars long, filter boolean")
