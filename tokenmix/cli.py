"""Command line: ``python -m tokenmix scan`` and ``python -m tokenmix verify``."""

from __future__ import annotations

import argparse
import logging
import os
import sys
from dataclasses import dataclass

from pyspark.sql import SparkSession

from . import report, settings
from .functions.store import Store
from .plans import workplan
from .sources import ranges
from .streaming import ledger


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="tokenmix", description="Exact cluster-token weights of a JSONL corpus.")
    sub = p.add_subparsers(dest="command", required=True)
    s = sub.add_parser("scan", help="scan a corpus and write report and weights")
    s.add_argument("--output-dir", required=True)
    s.add_argument("--resume", action="store_true")
    s.add_argument("--source-dir", help="folder with the source files")
    s.add_argument("--tree-url", help="JSON listing of a remote tree")
    s.add_argument("--file-url", help="URL of a remote file, with {path}")
    s.add_argument("--dataset", default="local")
    s.add_argument("--revision", default="local")
    s.add_argument("--glob", default=settings.Corpus.glob)
    s.add_argument("--seed", default=settings.Corpus.seed)
    s.add_argument("--workers", type=int, default=8, help="executor cores of a session that this command starts")
    s.add_argument("--max-in-flight-work-items", type=int, default=16, help="regions read at once, at most")
    s.add_argument("--checkpoint-every-work-items", type=int, default=1024, help="regions between two ledger commits")
    s.add_argument("--region-bytes", type=int, default=settings.REGION_BYTES)
    s.add_argument("--simulate-crash-after-work-items", type=int, default=None, help=argparse.SUPPRESS)
    v = sub.add_parser("verify", help="check the artifacts of a run")
    v.add_argument("results_dir", nargs="?", default="results")
    return p


def session(cores: int) -> SparkSession:
    return SparkSession.builder.appName("tokenmix").master(os.environ.get("SPARK_MASTER", f"local[{cores}]")).config("spark.sql.session.timeZone", "UTC").getOrCreate()


POSITIVE = ("workers", "max_in_flight_work_items", "checkpoint_every_work_items", "region_bytes")


@dataclass(frozen=True)
class Request:
    """A scan as asked for on the command line; nothing is read or written before it is valid."""

    folder: str
    resume: bool
    corpus: settings.Corpus
    source: dict
    tree_url: str | None
    batch: int
    in_flight: int
    stop_after: int | None

    @classmethod
    def of(cls, a: argparse.Namespace) -> "Request":
        wrong = [f"--{n.replace('_', '-')}" for n in POSITIVE if getattr(a, n) <= 0]
        if wrong:
            raise ValueError(f"{', '.join(wrong)} must be positive")
        if not a.source_dir and not a.file_url:
            raise ValueError("--source-dir or --file-url is needed")
        folder = a.source_dir and (a.source_dir if "://" in a.source_dir else os.path.abspath(a.source_dir))
        source = {"folder": folder} if folder else {"url": a.file_url}
        return cls(a.output_dir, a.resume, settings.Corpus(a.dataset, a.revision, a.glob, a.seed, a.region_bytes), source, a.tree_url, a.checkpoint_every_work_items, a.max_in_flight_work_items, a.simulate_crash_after_work_items)

    def files(self) -> list[tuple[str, int]]:
        return ranges.list_folder(self.source["folder"], self.corpus.glob) if "folder" in self.source else ranges.list_tree(self.tree_url, self.corpus.glob)

    def plan(self, store: Store) -> dict:
        """A resumed run's own plan, or a new one, saved."""
        c = self.corpus
        if self.resume:
            plan = workplan.checked(store.spark, store.json(settings.Names.plan))
            report.demand((f"the saved plan belongs to another {k}", plan[k] == v) for k, v in (("dataset", c.dataset), ("revision", c.revision), ("source_glob", c.glob)))
            return plan
        if store.exists(settings.Names.plan):
            raise FileExistsError(f"{store.url(settings.Names.plan)} exists; use --resume or another folder")
        plan = workplan.make(store.spark, self.files(), c)
        store.put(settings.Names.plan, plan)
        return plan


def run_scan(a: argparse.Namespace) -> dict:
    request = Request.of(a)
    store = Store(session(a.workers), request.folder)
    return ledger.scan(store.spark, request.folder, request.plan(store), resume=request.resume, batch_items=request.batch, in_flight=request.in_flight, stop_after=request.stop_after, **request.source)


def main(argv: list[str] | None = None) -> int:
    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(levelname)s %(message)s")
    logging.getLogger("py4j").setLevel(logging.WARNING)
    a = parser().parse_args(argv)
    if a.command == "verify":
        print(report.pretty(report.verify(session(2), a.results_dir)))
        return 0
    try:
        print(report.pretty(run_scan(a)))
        return 0
    except Exception as e:  # one line instead of a trace
        print(f"{type(e).__name__}: {e}", file=sys.stderr)
        return 1
