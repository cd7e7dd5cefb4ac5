"""The mixture report, its weights, and the claims that a run's documents make about each other.

Every check of a run is a claim, a pair (what, whether it holds), so starting, resuming, finishing and verifying only differ
in the claims that they ask for.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

from pyspark.sql import SparkSession

from . import settings
from .functions import canonical
from .functions.store import Store
from .plans import workplan

Claims = Iterator[tuple[str, bool]]
CLUSTER_KEYS = {str(c) for c in settings.ALL_CLUSTERS}
#: What the documents of a run say about their plan, as (name there, name in the plan).
IDENTITY = (("dataset", "dataset"), ("revision", "revision"), ("source_glob", "source_glob"), ("work_plan_hash", "hash"))


def demand(claims: Claims, error=ValueError) -> None:
    for what, holds in claims:
        if not holds:
            raise error(what)


def header(plan: dict) -> dict:
    return {"schema_version": settings.SCAN_VERSION} | {mine: plan[its] for mine, its in IDENTITY}


def item_bytes(items: list[dict]) -> int:
    return sum(i["range_end"] - i["range_start"] for i in items)


def weights_of(tokens: dict) -> dict[str, int]:
    return {str(c): n for c, n in ((int(c), n) for c, n in tokens.items()) if c in settings.ACCEPTED_CLUSTERS}


def _counts(m) -> bool:
    return isinstance(m, dict) and m.keys() == CLUSTER_KEYS and all(type(n) is int and n >= 0 for n in m.values())


def progress_claims(plan: dict, progress) -> Claims:
    """That progress is of this plan and names a prefix of it."""
    if not isinstance(progress, dict):
        yield "progress is no object", False
    yield from ((f"progress belongs to another scan: {k}", progress.get(k) == v) for k, v in header(plan).items())
    done = progress.get("next_work_item_index")
    yield "progress names no prefix of the plan", type(done) is int and 0 <= done <= len(plan["work_items"])
    derived = {"completed_work_items": done, "source_bytes_covered": item_bytes(plan["work_items"][:done])}
    yield from ((f"progress contradicts its prefix: {k}", progress.get(k) == v) for k, v in derived.items())
    yield from ((f"progress has no valid {k}", _counts(progress.get(k))) for k in ("cluster_source_tokens", "cluster_document_counts"))
    yield "progress counts other records than its clusters", progress.get("record_count") == sum(progress["cluster_document_counts"].values())


def closing_claims(plan: dict, progress: dict) -> Claims:
    """What a scan must have found before it is reported."""
    yield "the scan has not covered its plan", progress["next_work_item_index"] == len(plan["work_items"])
    yield "the plan does not cover its files", progress["source_bytes_covered"] == sum(f["size"] for f in plan["source_files"])
    none = sorted(int(c) for c, n in progress["cluster_source_tokens"].items() if not n)
    yield f"no tokens were found for clusters {none}", not none


def documents(plan: dict, progress: dict, names: settings.Names = settings.Names()) -> dict[str, dict]:
    """The last documents of a scan by file name, in the order in which they are to be written."""
    tokens = progress["cluster_source_tokens"]
    weights = weights_of(tokens)
    said = header(plan) | {
        "complete": True, "source_files": plan["source_files"], "source_bytes_scanned": progress["source_bytes_covered"], "record_count": progress["record_count"],
        "all_cluster_source_tokens": tokens, "all_cluster_document_counts": progress["cluster_document_counts"], "all_source_tokens": sum(tokens.values()),
        "accepted_cluster_ids": list(settings.ACCEPTED_CLUSTERS), "excluded_cluster_ids": list(settings.EXCLUDED_CLUSTERS), "accepted_source_tokens": sum(weights.values()),
        "conditioning_rule": settings.RULE, "weights_file": names.weights, "weights_sha256": canonical.sha256(weights),
    }
    hashes = {"weights_sha256": said["weights_sha256"], "report_sha256": canonical.self_hash(said, "report_sha256")}
    return {names.weights: weights, names.report: said | hashes, names.progress: progress | hashes | {"complete": True}}


def finish(store: Store, plan: dict, progress: dict, names: settings.Names = settings.Names()) -> dict:
    """Writes what a finished scan leaves and returns the report; RuntimeError if it is not finished or found no tokens of a cluster."""
    demand(closing_claims(plan, progress), RuntimeError)
    made = documents(plan, progress, names)
    for name, payload in made.items():
        store.put(name, payload)
    return made[names.report]


def run_claims(store: Store, plan: dict, names: settings.Names = settings.Names()) -> Claims:
    """That the documents of a finished run are each other's, and those of the plan."""
    report, progress, weights = (store.json(n) for n in (names.report, names.progress, names.weights))
    yield "report is no object", isinstance(report, dict)
    yield "report self-hash", report.get("report_sha256") == canonical.self_hash(report, "report_sha256")
    yield from ((f"report and plan: {mine}", report.get(mine) == plan[its]) for mine, its in IDENTITY)
    yield "weights file hash", store.sha256(names.weights) == report.get("weights_sha256")
    yield from progress_claims(plan, progress)
    yield "completion", progress.get("complete") is True
    yield from ((f"progress and report: {k}", progress.get(k) == report.get(k)) for k in ("report_sha256", "weights_sha256", "record_count"))
    yield from closing_claims(plan, progress)
    # all that a report says follows from plan and progress
    expected = documents(plan, {k: v for k, v in progress.items() if k not in ("complete", "weights_sha256", "report_sha256")}, names)
    yield from ((f"report: {k}", report.get(k) == v) for k, v in expected[names.report].items())
    yield "weights", weights == expected[names.weights]
    yield "cluster documents", min(progress["cluster_document_counts"].values()) > 0


def verify(spark: SparkSession, folder: str, names: settings.Names = settings.Names(), artifacts: dict[str, str] | None = None) -> dict:
    """Checks a run's documents against each other, offline; ValueError names the first contradiction.

    artifacts: expected SHA-256 by file name (else those of a verification.json in folder, if there is one).
    """
    store = Store(spark, folder)
    plan = workplan.checked(spark, store.json(names.plan))
    if artifacts is None and store.exists("verification.json"):
        artifacts = store.json("verification.json")["artifact_sha256"]
    demand((f"{name} has another SHA-256", store.sha256(name) == digest) for name, digest in (artifacts or {}).items())
    demand(run_claims(store, plan, names))
    report = store.json(names.report)
    return {
        "status": "PASS", "source_files": len(plan["source_files"]), "work_items": len(plan["work_items"]), "records": report["record_count"], "all_source_tokens": report["all_source_tokens"],
        "accepted_source_tokens": report["accepted_source_tokens"], "weights_sha256": report["weights_sha256"], "report_self_hash": report["report_sha256"], "work_plan_self_hash": plan["hash"],
    }


def pretty(payload) -> str:
    return json.dumps(payload, indent=2, sort_keys=True)
