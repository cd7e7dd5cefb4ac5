"""Registered queries of the mixture engine over the driver's tables, with their DuckDB oracles.

``documents`` stand in for records: a document's source is its file and (through its number) its cluster, its
n_chars its token count, its text and a newline its bytes. Regions are 4096 bytes here.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import settings
from .functions import columns
from .functions.store import Store
from .operators import aggregate, sample
from .operators.extract import extract
from .operators.validate import validated
from .plans import workplan
from .sources import jsonl, scratch
from .streaming import ledger

REVISION, SEED, REGION, GLOB = "rev-1", "tokenmix", 4096, "part_*.tokenized.jsonl"


def docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = spark.read.parquet(f"{sf_dir}/documents.parquet")
    cluster = (F.substring("source", 4, 9).cast("int") + 1).alias("cluster_id")
    return t.select("doc_id", "source", cluster, F.col("n_chars").alias("token_count"), F.octet_length("text").cast("long").alias("bytes"))


def _path() -> Column:
    return F.concat(F.lit("part_"), F.substring("source", 4, 9), F.lit(".tokenized.jsonl"))


def files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return docs(spark, sf_dir).groupBy(_path().alias("path")).agg(F.sum(F.col("bytes") + 1).alias("size"))


def items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return workplan.plan_items(files(spark, sf_dir), REVISION, SEED, REGION)


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """file, doc_id, cluster_id, token_count, record_start."""
    placed = docs(spark, sf_dir).select(_path().alias("file"), "doc_id", "cluster_id", "token_count", F.floor(F.col("doc_id") / 1000).alias("block"), "bytes")
    return jsonl.offsets(placed, "file", "block", "doc_id", F.col("bytes")).drop("block", "bytes")


def corpus(spark: SparkSession, sf_dir: str) -> tuple[str, dict]:
    """The documents' lines as JSONL files in a scratch folder, and the plan over its listing."""
    folder = scratch.folder(spark, "corpus")
    scratch.write_files(lines(spark, sf_dir).select(_path().alias("path"), F.col("doc_id").alias("at"), "value"), folder)
    found = sorted(tuple(r) for r in jsonl.listing(spark, folder, GLOB).collect())
    return folder, workplan.make(spark, found, settings.Corpus("documents", REVISION, GLOB, SEED, REGION))


def owned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the range source reads of that corpus, extracted: work_index, file, record_start, cluster_id, token_count."""
    folder, plan = corpus(spark, sf_dir)
    return extract(jsonl.ranges(spark, plan, folder=folder)).where("reason is null").drop("reason")


def _tokens() -> Column:
    n = (F.col("token_count") % 7 + 1).cast("int")
    return F.transform(F.sequence(F.lit(1), n), lambda i: (F.col("doc_id") * 31 + i * 17) % 50257)


def _line(cluster: Column | str, tokens: Column | str, count: Column | str) -> Column:
    parts = [F.lit(x) if isinstance(x, str) else x.cast("string") for x in (cluster, tokens, count)]
    return F.concat(F.lit('{"cluster_id": '), parts[0], F.lit(', "tokens": '), parts[1], F.lit(', "token_count": '), parts[2], F.lit("}"))


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    listed = F.concat(F.lit("["), F.array_join(_tokens().cast("array<string>"), ", "), F.lit("]"))
    d = docs(spark, sf_dir).withColumn("listed", listed).withColumn("n_tokens", F.col("token_count") % 7 + 1)
    return d.withColumn("value", _line(F.col("cluster_id"), F.col("listed"), F.col("n_tokens")))


def extraction_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    c, t, n = F.col("cluster_id").cast("string"), F.col("listed"), F.col("n_tokens").cast("string")
    kinds = [
        F.col("value"), F.lit(""), F.concat(F.lit('{"cluster_id": '), c, F.lit(', "token_count": '), n, F.lit(', "tokens": '), t, F.lit("}")),
        _line(c, F.lit('["cluster_id"]'), n), F.concat(F.lit('{"x": 1, '), F.substring("value", 2, 1 << 30)), _line(F.concat(c, F.lit(".0")), t, n), _line("21", t, n), _line(c, t, "0"),
        _line(c, t, F.concat(n, F.lit(', "x": 1'))), _line("true", t, n), _line(c, "7", n), _line(c, '[1],"x":[2]', n),
    ]
    return lines(spark, sf_dir).select("doc_id", F.element_at(F.array(*kinds), (F.col("doc_id") % 12 + 1).cast("int")).alias("value"))


EXTRACTION = [None, "not_object", "layout", "duplicate_key", "field_before_cluster_id", "field_before_tokens", "cluster_id_out_of_range", "token_count_not_positive", "field_after_token_count", "cluster_id_not_integer", "tokens_not_array", None]


def validation_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    c, t, n = F.col("cluster_id").cast("string"), F.col("listed"), F.col("n_tokens").cast("string")
    head = F.concat(F.lit('{"cluster_id": '), c)
    kinds = [
        F.col("value"), head, F.concat(F.lit('{"tokens": '), t, F.lit("}")), _line("true", t, n), _line("99", t, n), F.concat(head, F.lit("}")), _line(c, '{"a": 1}', n), _line(c, "[]", "0"),
        _line(c, "[1.0]", "1"), _line(c, "[50257]", "1"), _line(c, t, "null"), _line(c, t, "99"), F.concat(head, F.lit(', "tokens": '), t, F.lit("}")),
    ]
    return lines(spark, sf_dir).select("doc_id", "cluster_id", F.element_at(F.array(*kinds), (F.col("doc_id") % 13 + 1).cast("int")).alias("value"))


VALIDATION = [None, "json_parse_error", "missing_cluster_id", "cluster_id_not_integer", "cluster_id_out_of_range", "missing_tokens", "tokens_not_list", "tokens_empty", "token_not_integer", "token_out_of_range", "token_count_not_integer", "token_count_mismatch", None]


def _some(spark, sf_dir):
    """Totals with clusters 3 and 8 left out."""
    return aggregate.totals(docs(spark, sf_dir).where("cluster_id not in (3, 8)"))


def _totals(spark, sf_dir):
    return aggregate.totals(docs(spark, sf_dir))


def _bad_range(spark, sf_dir):
    p = items(spark, sf_dir)
    return p.withColumn("range_end", F.when(F.col("index") % 10 == 3, F.col("range_end") + 10**9).otherwise(F.col("range_end")))


def _bad_identity(spark, sf_dir):
    p = items(spark, sf_dir)
    return p.withColumn("work_item_id", F.when(F.col("index") % 10 == 4, F.concat("work_item_id", F.lit("x"))).otherwise(F.col("work_item_id")))


def _bad_index(spark, sf_dir):
    return items(spark, sf_dir).withColumn("index", F.when(F.col("index") >= 7, F.col("index") + 1).otherwise(F.col("index")))


def _gapped(spark, sf_dir):
    return items(spark, sf_dir).where(~((F.col("filename") == "part_3.tokenized.jsonl") & (F.col("range_start") == REGION)))


def _renamed(spark, sf_dir):
    return items(spark, sf_dir).withColumn("filename", F.when(F.col("index") % 25 == 0, F.concat(F.lit("other_"), "filename")).otherwise(F.col("filename")))


def _drifted(spark, sf_dir):
    f = files(spark, sf_dir).where("path != 'part_9.tokenized.jsonl'")
    return f.withColumn("size", F.when(F.col("path") == "part_4.tokenized.jsonl", F.col("size") + 5).otherwise(F.col("size")))


def q_weights_check(spark, sf_dir):
    t = _totals(spark, sf_dir)
    published = aggregate.weights(t).withColumn("weight", F.when(F.col("cluster") == "5", F.col("weight") + 1).otherwise(F.col("weight")))
    return aggregate.weights_verdicts(t, published)


def q_glob_filter(spark, sf_dir):
    t = spark.read.parquet(f"{sf_dir}/documents.parquet")
    names = [_path(), F.concat(F.lit("sub/"), _path()), F.concat(F.lit("PART_"), F.substring("source", 4, 9)), F.concat(_path(), F.lit(".gz"))]
    p = t.select("doc_id", F.element_at(F.array(*names), (F.col("doc_id") % 4 + 1).cast("int")).alias("path"))
    return p.withColumn("matches", columns.in_root(F.col("path"), GLOB))


def q_source_listing(spark, sf_dir):
    folder = scratch.folder(spark, "corpus")
    rows = lines(spark, sf_dir).select(_path().alias("path"), F.col("doc_id").alias("at"), "value")
    scratch.write_files(rows.unionByName(rows.withColumn("path", F.concat(F.lit("other_"), "path"))), folder)
    return jsonl.listing(spark, folder, GLOB)


def q_duplicate_ids(spark, sf_dir):
    p = items(spark, sf_dir)
    return workplan.duplicates(p.unionByName(p.where("index % 9 = 0")), "work_item_id")


def q_region_rollup(spark, sf_dir):
    region = F.floor(F.col("record_start") / REGION).alias("region")
    return owned(spark, sf_dir).groupBy("file", region).agg(F.count("*").alias("records"), F.sum("token_count").alias("tokens"), F.min("record_start").alias("first_start"))


def q_progress_fold(spark, sf_dir):
    """A whole scan, then the running totals of its ledger."""
    folder, plan = corpus(spark, sf_dir)
    run = scratch.folder(spark, "run")
    ledger.scan(spark, run, plan, batch_items=256, folder=folder)
    return ledger.progress_by_item(ledger.read(Store(spark, run), settings.Names.ledger, len(plan["work_items"])))


def q_resume_equivalence(spark, sf_dir):
    """A scan is interrupted halfway and resumed with another batch size; the totals are those of its report."""
    folder, plan = corpus(spark, sf_dir)
    run, half = scratch.folder(spark, "run"), len(plan["work_items"]) // 2
    try:
        ledger.scan(spark, run, plan, batch_items=256, stop_after=half, folder=folder)
    except ledger.Interrupted:
        made = ledger.scan(spark, run, plan, resume=True, batch_items=100, folder=folder)
    docs_of = made["all_cluster_document_counts"]
    return spark.createDataFrame([(int(c), n, docs_of[c]) for c, n in made["all_cluster_source_tokens"].items()], "cluster_id int, tokens long, docs long")


def q_jsonl_scan(spark, sf_dir):
    """Writes the lines as text, scans them again and totals what is extracted."""
    path = scratch.folder(spark, "jsonl")
    lines(spark, sf_dir).select("value").write.text(path)
    found = extract(jsonl.scan(spark, path).select("value")).where("reason is null")
    return aggregate.dense(aggregate.totals(found))


def q_crlf_trim(spark, sf_dir):
    ends = F.element_at(F.array(*map(F.lit, ("", "\r", "\r\r", "\rx"))), (F.col("doc_id") % 4 + 1).cast("int"))
    return docs(spark, sf_dir).select("doc_id", columns.without_cr(F.concat(F.lit("line "), F.col("doc_id").cast("string"), ends)).alias("value"))


def q_validation_verdicts(spark, sf_dir):
    v = validation_lines(spark, sf_dir).select("doc_id", validated(F.col("value")).alias("v"))
    return v.select("doc_id", "v.valid", "v.cluster_id", "v.rejection_reason", F.size("v.tokens").alias("n_tokens"))


def q_validation_reason_counts(spark, sf_dir):
    return q_validation_verdicts(spark, sf_dir).groupBy(F.coalesce("rejection_reason", F.lit("valid")).alias("reason")).agg(F.count("*").alias("n"))


def q_audit_sample(spark, sf_dir):
    return sample.by_hash(docs(spark, sf_dir).select("source", "doc_id", "cluster_id"), "source", "doc_id", 10)


def q_external_crosscheck(spark, sf_dir):
    t = _totals(spark, sf_dir)
    external = t.where("cluster_id != 2").select("cluster_id", F.when(F.col("cluster_id") == 6, F.col("docs") + 1).otherwise(F.col("docs")).alias("docs"))
    return aggregate.crosscheck(t, external)


def q_mixture_report(spark, sf_dir):
    folder, plan = corpus(spark, sf_dir)
    run = scratch.folder(spark, "run")
    made = ledger.scan(spark, run, plan, batch_items=256, folder=folder)
    weights = json.dumps(Store(spark, run).json(made["weights_file"]), sort_keys=True, separators=(",", ":"))
    row = (made["all_source_tokens"], made["accepted_source_tokens"], made["record_count"], made["source_bytes_scanned"], len(made["source_files"]), weights)
    return spark.createDataFrame([row], "all_tokens long, accepted_tokens long, records long, source_bytes long, source_files long, weights string")


def entry(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aggregate.dense(_totals(spark, sf_dir))


def queries():
    d, t, p, f = docs, _totals, items, files
    return {
        "cluster_totals": t,
        "cluster_totals_dense": lambda s, x: aggregate.dense(_some(s, x)),
        "grand_totals": lambda s, x: aggregate.grand(t(s, x)),
        "missing_clusters": lambda s, x: aggregate.missing(_some(s, x)),
        "positivity_check": lambda s, x: aggregate.positivity(t(s, x)),
        "mixture_weights": lambda s, x: aggregate.weights_json(t(s, x)),
        "weights_check": q_weights_check,
        "token_shares": lambda s, x: aggregate.token_shares(t(s, x)),
        "document_shares": lambda s, x: aggregate.document_shares(t(s, x)),
        "accepted_filter": lambda s, x: d(s, x).where(aggregate.is_accepted()).select("doc_id", "cluster_id", "token_count"),
        "cluster_domain_filter": lambda s, x: d(s, x).withColumn("cluster_id", F.col("cluster_id") + 5).where(aggregate.in_domain()).select("doc_id", "cluster_id"),
        "cluster_key_set_diff": lambda s, x: aggregate.key_difference(_some(s, x), t(s, x).where("cluster_id != 12")),
        "source_listing": q_source_listing,
        "glob_filter": q_glob_filter,
        "work_regions": lambda s, x: workplan.regions(f(s, x), REGION),
        "work_plan": p,
        "plan_coverage": lambda s, x: workplan.coverage_verdicts(_gapped(s, x), f(s, x)),
        "plan_range_check": lambda s, x: workplan.range_verdicts(_bad_range(s, x), f(s, x)),
        "plan_identity_check": lambda s, x: workplan.identity_verdicts(_bad_identity(s, x), REVISION),
        "plan_index_check": lambda s, x: workplan.index_verdicts(_bad_index(s, x)),
        "plan_source_join": lambda s, x: workplan.with_source(p(s, x), f(s, x)),
        "plan_unknown_files": lambda s, x: workplan.unknown_files(_renamed(s, x), f(s, x)),
        "duplicate_ids": q_duplicate_ids,
        "source_bytes_total": lambda s, x: f(s, x).agg(F.sum("size").alias("source_bytes"), F.count("*").alias("source_files")),
        "size_drift_check": lambda s, x: workplan.size_drift(f(s, x), _drifted(s, x)),
        "file_list_diff": lambda s, x: workplan.list_difference(f(s, x), _drifted(s, x)),
        "record_offsets": lambda s, x: records(s, x).select("file", "doc_id", "record_start"),
        "record_ownership": lambda s, x: owned(s, x).select("file", "record_start", "work_index", "cluster_id", "token_count"),
        "region_partial_agg": lambda s, x: aggregate.region_partials(owned(s, x)),
        "region_rollup": q_region_rollup,
        "prefix_coverage": lambda s, x: workplan.prefix_bytes(p(s, x)).select("index", "covered_bytes"),
        "progress_fold": q_progress_fold,
        "remaining_items": lambda s, x: workplan.remaining(p(s, x), 100),
        "resume_equivalence": q_resume_equivalence,
        "jsonl_scan": q_jsonl_scan,
        "crlf_trim": q_crlf_trim,
        "metadata_extract": lambda s, x: extract(extraction_lines(s, x)),
        "metadata_reject_reasons": lambda s, x: extract(extraction_lines(s, x)).groupBy(F.coalesce("reason", F.lit("accepted")).alias("reason")).agg(F.count("*").alias("n")),
        "validation_verdicts": q_validation_verdicts,
        "validation_reason_counts": q_validation_reason_counts,
        "audit_sample": q_audit_sample,
        "external_crosscheck": q_external_crosscheck,
        "mixture_report": q_mixture_report,
    }


_D = "d AS (SELECT doc_id, source, CAST(substring(source, 4) AS INTEGER) + 1 AS cluster_id, n_chars AS token_count, CAST(strlen(text) AS BIGINT) AS bytes FROM documents)"
_T = "t AS (SELECT cluster_id, CAST(sum(token_count) AS BIGINT) AS tokens, count(*) AS docs FROM d GROUP BY 1)"
_S = "s AS (SELECT * FROM t WHERE cluster_id NOT IN (3, 8))"
_C = "c AS (SELECT CAST(range AS INTEGER) AS cluster_id FROM range(1, 21))"
_E = "e AS (SELECT cluster_id, coalesce(tokens, 0) AS tokens, coalesce(docs, 0) AS docs FROM c LEFT JOIN t USING (cluster_id))"
_F = "f AS (SELECT 'part_' || substring(source, 4) || '.tokenized.jsonl' AS path, CAST(sum(bytes + 1) AS BIGINT) AS size FROM d GROUP BY 1)"
_R = f"r AS (SELECT path AS filename, size, unnest(range(0, size, {REGION})) AS range_start FROM f), rr AS (SELECT filename, size, range_start, least(range_start + {REGION}, size) AS range_end FROM r)"
_I = f"i AS (SELECT *, '{REVISION}:' || filename || ':' || range_start || ':' || range_end AS work_item_id FROM rr)"
_P = f"p AS (SELECT CAST(row_number() OVER (ORDER BY sha256('{SEED}' || chr(0) || work_item_id), work_item_id) - 1 AS INTEGER) AS \"index\", filename, range_start, range_end, work_item_id FROM i)"
_O = "o AS (SELECT 'part_' || substring(source, 4) || '.tokenized.jsonl' AS file, doc_id, cluster_id, token_count, CAST(coalesce(sum(bytes + 1) OVER (PARTITION BY source ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS record_start FROM d)"
#: The documents as JSONL lines, their files, and the plan over these.
_N = "token_count % 7 + 1"
_L = f"""l AS (SELECT doc_id, cluster_id, {_N} AS token_count, 'part_' || substring(source, 4) || '.tokenized.jsonl' AS file,
  CAST(strlen('{{"cluster_id": ' || cluster_id || ', "tokens": [' || array_to_string(list_transform(range(1, {_N} + 1), lambda i: (doc_id * 31 + i * 17) % 50257), ', ') || '], "token_count": ' || ({_N}) || '}}') + 1 AS BIGINT) AS bytes FROM d)"""
_LF = "f AS (SELECT file AS path, CAST(sum(bytes) AS BIGINT) AS size FROM l GROUP BY 1)"
_LO = "o AS (SELECT *, CAST(coalesce(sum(bytes) OVER (PARTITION BY file ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS record_start FROM l)"
_W = f"w AS (SELECT o.*, o.record_start // {REGION} AS region, p.\"index\" AS work_index FROM o JOIN p ON p.filename = o.file AND o.record_start >= p.range_start AND o.record_start < p.range_end)"
_LT = "t AS (SELECT cluster_id, CAST(sum(token_count) AS BIGINT) AS tokens, count(*) AS docs FROM l GROUP BY 1)"
_A = "cluster_id NOT IN (11)"
_Z = "z AS (SELECT path, CASE WHEN path = 'part_4.tokenized.jsonl' THEN size + 5 ELSE size END AS size FROM f WHERE path <> 'part_9.tokenized.jsonl')"


def _with(*ctes: str) -> str:
    return "WITH " + ", ".join(ctes) + " "


def _case(reasons: list, key: str, otherwise: str) -> str:
    return f"CASE doc_id % {len(reasons)} " + " ".join(f"WHEN {k} THEN '{r}'" for k, r in enumerate(reasons) if r) + f" ELSE {otherwise} END AS {key}"


def oracle_sql():
    plan = (_D, _F, _R, _I, _P)
    read = (_D, _L, _LF, _R, _I, _P, _LO, _W)
    weight = "'{' || string_agg('\"' || cluster_id || '\":' || tokens, ',' ORDER BY CAST(cluster_id AS VARCHAR)) || '}'"
    n_tokens = _N
    extracted = f"x AS (SELECT doc_id, cluster_id AS c, {n_tokens} AS n, {_case(EXTRACTION, 'reason', 'NULL')} FROM d)"
    judged = f"v AS (SELECT doc_id, cluster_id AS c, {n_tokens} AS n, {_case(VALIDATION, 'rejection_reason', 'NULL')} FROM d)"
    dense = "SELECT c.cluster_id, coalesce(tokens, 0) AS tokens, coalesce(docs, 0) AS docs FROM c LEFT JOIN {} USING (cluster_id)"
    side = "SELECT *, CAST(row_number() OVER (ORDER BY path, size) AS INTEGER) AS position FROM {}"
    return {
        "cluster_totals": _with(_D, _T) + "SELECT * FROM t",
        "cluster_totals_dense": _with(_D, _T, _S, _C) + dense.format("s"),
        "grand_totals": _with(_D, _T) + f"SELECT CAST(sum(tokens) AS BIGINT) AS all_tokens, CAST(sum(tokens) FILTER ({_A}) AS BIGINT) AS accepted_tokens, CAST(sum(tokens) FILTER (cluster_id = 11) AS BIGINT) AS excluded_tokens, CAST(sum(docs) AS BIGINT) AS records FROM t",
        "missing_clusters": _with(_D, _T, _S, _C) + "SELECT c.cluster_id FROM c LEFT JOIN s USING (cluster_id) WHERE coalesce(tokens, 0) <= 0",
        "positivity_check": _with(_D, _T, _C, _E) + "SELECT min(tokens) AS least_tokens, min(docs) AS least_docs, min(least(tokens, docs)) > 0 AS all_positive FROM e",
        "mixture_weights": _with(_D, _T, _C, _E) + f"SELECT {weight} AS weights FROM e WHERE {_A}",
        "weights_check": _with(_D, _T, _C, _E) + f"SELECT CAST(cluster_id AS VARCHAR) AS cluster, tokens AS expected, tokens + CASE WHEN cluster_id = 5 THEN 1 ELSE 0 END AS published, cluster_id <> 5 AS matches FROM e WHERE {_A}",
        "token_shares": _with(_D, _T, _C, _E) + f"SELECT cluster_id, tokens, round(100.0::DOUBLE * tokens / sum(tokens) OVER (), 6) AS percent_all, CASE WHEN {_A} THEN round(100.0::DOUBLE * tokens / sum(tokens) FILTER ({_A}) OVER (), 6) END AS percent_accepted FROM e",
        "document_shares": _with(_D, _T, _C, _E) + "SELECT cluster_id, docs, round(100.0::DOUBLE * docs / sum(docs) OVER (), 6) AS percent_docs FROM e",
        "accepted_filter": _with(_D) + f"SELECT doc_id, cluster_id, token_count FROM d WHERE {_A}",
        "cluster_domain_filter": _with(_D) + "SELECT doc_id, cluster_id + 5 AS cluster_id FROM d WHERE cluster_id + 5 BETWEEN 1 AND 20",
        "cluster_key_set_diff": _with(_D, _T, _S) + ", a AS (SELECT cluster_id FROM s), b AS (SELECT cluster_id FROM t WHERE cluster_id <> 12) SELECT cluster_id, 'left' AS side FROM (FROM a EXCEPT ALL FROM b) UNION ALL SELECT cluster_id, 'right' FROM (FROM b EXCEPT ALL FROM a)",
        "source_listing": _with(_D, _L, _LF) + "SELECT * FROM f",
        "glob_filter": "SELECT doc_id, CASE doc_id % 4 WHEN 0 THEN '' WHEN 1 THEN 'sub/' ELSE '' END || CASE WHEN doc_id % 4 = 2 THEN 'PART_' || substring(source, 4) ELSE 'part_' || substring(source, 4) || '.tokenized.jsonl' END || CASE WHEN doc_id % 4 = 3 THEN '.gz' ELSE '' END AS path, doc_id % 4 = 0 AS matches FROM documents",
        "work_regions": _with(_D, _F, _R) + "SELECT filename, range_start, range_end FROM rr",
        "work_plan": _with(*plan) + "SELECT * FROM p",
        "plan_coverage": _with(*plan) + f""", g AS (SELECT * FROM p WHERE NOT (filename = 'part_3.tokenized.jsonl' AND range_start = {REGION})),
          h AS (SELECT *, range_start = coalesce(lag(range_end) OVER (PARTITION BY filename ORDER BY range_start, range_end), 0) AS joined FROM g),
          j AS (SELECT filename, count(*) AS items, min(range_start) AS first_start, max(range_end) AS last_end, bool_and(joined) AS joined FROM h GROUP BY 1)
          SELECT path, coalesce(items, 0) AS items, first_start, last_end, coalesce(joined AND first_start = 0 AND last_end = size, false) AS covered FROM f LEFT JOIN j ON j.filename = f.path""",
        "plan_range_check": _with(*plan) + "SELECT \"index\", filename, range_start, range_end + CASE WHEN \"index\" % 10 = 3 THEN 1000000000 ELSE 0 END AS range_end, work_item_id, \"index\" % 10 <> 3 AS in_range FROM p",
        "plan_identity_check": _with(*plan) + "SELECT \"index\", filename, range_start, range_end, work_item_id || CASE WHEN \"index\" % 10 = 4 THEN 'x' ELSE '' END AS work_item_id, \"index\" % 10 <> 4 AS identity_ok FROM p",
        "plan_index_check": _with(*plan) + "SELECT CAST(\"index\" + CASE WHEN \"index\" >= 7 THEN 1 ELSE 0 END AS INTEGER) AS \"index\", filename, range_start, range_end, work_item_id, \"index\" < 7 AS index_ok FROM p",
        "plan_source_join": _with(*plan) + "SELECT p.*, f.size FROM p JOIN f ON p.filename = f.path",
        "plan_unknown_files": _with(*plan) + "SELECT \"index\", 'other_' || filename AS filename, range_start, range_end, work_item_id FROM p WHERE \"index\" % 25 = 0",
        "duplicate_ids": _with(*plan) + "SELECT work_item_id, 2::BIGINT AS n FROM p WHERE \"index\" % 9 = 0",
        "source_bytes_total": _with(_D, _F) + "SELECT CAST(sum(size) AS BIGINT) AS source_bytes, count(*) AS source_files FROM f",
        "size_drift_check": _with(_D, _F, _Z) + "SELECT f.path, f.size AS planned_size, z.size AS actual_size, f.size IS DISTINCT FROM z.size AS drifted FROM f LEFT JOIN z USING (path)",
        "file_list_diff": _with(_D, _F, _Z) + f", a AS ({side.format('f')}), b AS ({side.format('z')}) SELECT *, 'left' AS side FROM (FROM a EXCEPT ALL FROM b) UNION ALL SELECT *, 'right' FROM (FROM b EXCEPT ALL FROM a)",
        "record_offsets": _with(_D, _O) + "SELECT file, doc_id, record_start FROM o",
        "record_ownership": _with(*read) + "SELECT file, record_start, work_index, cluster_id, token_count FROM w",
        "region_partial_agg": _with(*read) + "SELECT work_index, cluster_id, CAST(sum(token_count) AS BIGINT) AS tokens, count(*) AS docs FROM w GROUP BY 1, 2",
        "region_rollup": _with(*read) + "SELECT file, region, count(*) AS records, CAST(sum(token_count) AS BIGINT) AS tokens, min(record_start) AS first_start FROM w GROUP BY 1, 2",
        "prefix_coverage": _with(*plan) + "SELECT \"index\", CAST(sum(range_end - range_start) OVER (ORDER BY \"index\") AS BIGINT) AS covered_bytes FROM p",
        "progress_fold": _with(*read) + ", q AS (SELECT work_index, sum(token_count) AS tokens, count(*) AS docs FROM w GROUP BY 1) SELECT \"index\" AS work_index, CAST(sum(coalesce(tokens, 0)) OVER (ORDER BY \"index\") AS BIGINT) AS running_tokens, CAST(sum(coalesce(docs, 0)) OVER (ORDER BY \"index\") AS BIGINT) AS running_docs, CAST(sum(range_end - range_start) OVER (ORDER BY \"index\") AS BIGINT) AS running_bytes FROM p LEFT JOIN q ON q.work_index = p.\"index\"",
        "remaining_items": _with(*plan) + "SELECT * FROM p WHERE \"index\" >= 100",
        "resume_equivalence": _with(_D, _L, _LT, _C) + dense.format("t"),
        "jsonl_scan": _with(_D, _C) + f", t AS (SELECT cluster_id, CAST(sum({n_tokens}) AS BIGINT) AS tokens, count(*) AS docs FROM d GROUP BY 1) " + dense.format("t"),
        "crlf_trim": "SELECT doc_id, 'line ' || doc_id || CASE doc_id % 4 WHEN 2 THEN chr(13) WHEN 3 THEN chr(13) || 'x' ELSE '' END AS value FROM documents",
        "metadata_extract": _with(_D, extracted) + "SELECT doc_id, CASE WHEN reason IS NULL THEN c END AS cluster_id, CASE WHEN reason IS NULL THEN n END AS token_count, reason FROM x",
        "metadata_reject_reasons": _with(_D, extracted) + "SELECT coalesce(reason, 'accepted') AS reason, count(*) AS n FROM x GROUP BY 1",
        "validation_verdicts": _with(_D, judged) + "SELECT doc_id, rejection_reason IS NULL AS valid, CAST(CASE WHEN doc_id % 13 = 4 THEN 99 WHEN doc_id % 13 IN (1, 2, 3) THEN NULL ELSE c END AS BIGINT) AS cluster_id, rejection_reason, CAST(CASE WHEN rejection_reason IS NULL THEN n END AS INTEGER) AS n_tokens FROM v",
        "validation_reason_counts": _with(_D, judged) + "SELECT coalesce(rejection_reason, 'valid') AS reason, count(*) AS n FROM v GROUP BY 1",
        "audit_sample": _with(_D) + f", h AS (SELECT source, doc_id, cluster_id, CAST(row_number() OVER (PARTITION BY source ORDER BY sha256('{sample.SEED}:' || source || ':' || doc_id), doc_id) AS INTEGER) AS sample_rank FROM d) SELECT * FROM h WHERE sample_rank <= 10",
        "external_crosscheck": _with(_D, _T, _C, _E) + "SELECT cluster_id, docs, CASE WHEN cluster_id = 2 THEN NULL WHEN cluster_id = 6 THEN docs + 1 ELSE docs END AS external_docs, cluster_id NOT IN (2, 6) AS agrees FROM e",
        "mixture_report": _with(_D, _L, _LT, _C, _E, _LF) + f"SELECT (SELECT CAST(sum(tokens) AS BIGINT) FROM e) AS all_tokens, (SELECT CAST(sum(tokens) AS BIGINT) FROM e WHERE {_A}) AS accepted_tokens, (SELECT CAST(sum(docs) AS BIGINT) FROM e) AS records, (SELECT CAST(sum(size) AS BIGINT) FROM f) AS source_bytes, (SELECT count(*) FROM f) AS source_files, (SELECT {weight} FROM e WHERE {_A}) AS weights",
    }
