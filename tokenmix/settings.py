"""Domain constants and the identity of a corpus."""

from __future__ import annotations

from dataclasses import dataclass

# Fixed values of the domain.
ALL_CLUSTERS = tuple(range(1, 21))
EXCLUDED_CLUSTERS = (11,)
ACCEPTED_CLUSTERS = tuple(c for c in ALL_CLUSTERS if c not in EXCLUDED_CLUSTERS)
TOKEN_MIN, TOKEN_MAX = 0, 50256
REGION_BYTES = 256 << 20
BACK_CHUNK, AHEAD_CHUNK = 4 << 20, 8 << 20
PLAN_VERSION, SCAN_VERSION = 2, 1
HTTP_TIMEOUT, HTTP_ATTEMPTS, HTTP_BACKOFF, HTTP_BACKOFF_MOST = 60.0, 6, 1.5, 30.0


@dataclass(frozen=True)
class Corpus:
    """What a plan belongs to; every artifact names it."""

    dataset: str
    revision: str
    glob: str = "part_*.tokenized.jsonl"
    seed: str = "tokenmix"
    region_bytes: int = REGION_BYTES


@dataclass(frozen=True)
class Names:
    """Artifact file names of a run directory."""

    plan: str = "work_plan.json"
    progress: str = "mixture_progress.json"
    report: str = "mixture_report.json"
    weights: str = "mixture_weights.json"
    ledger: str = "ledger"


RULE = "Production weights are the exact released-corpus token totals for retained clusters, conditioned on excluding cluster 11."
