"""Full structural validation of records, with ordered reasons.

JSON typing must be Python's (the last of equal keys counts, NaN parses, 1.0 is no integer, whole numbers have no
bound), which the engine's own JSON functions don't offer; so this is an Arrow UDF: batches, no row-wise calls into the engine.
"""

from __future__ import annotations

import json

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import settings
from ..shipping import ship

VERDICT = "valid boolean, cluster_id long, tokens array<int>, rejection_reason string"
_TYPE = pa.struct([("valid", pa.bool_()), ("cluster_id", pa.int64()), ("tokens", pa.list_(pa.int32())), ("rejection_reason", pa.string())])


def _integer(x) -> bool:
    return type(x) is int


def verdict(raw: bytes | str | None) -> tuple[bool, int | None, list[int] | None, str | None]:
    """(valid, cluster_id, tokens, reason); the first rule broken gives the reason."""
    try:
        record = json.loads(raw)
    except (ValueError, TypeError, RecursionError):
        record = None
    if not isinstance(record, dict):
        return False, None, None, "json_parse_error"
    cluster, tokens = record.get("cluster_id"), record.get("tokens")
    if cluster is None:
        return False, None, None, "missing_cluster_id"
    if not _integer(cluster):
        return False, None, None, "cluster_id_not_integer"
    rules = (
        ("cluster_id_out_of_range", lambda: cluster in settings.ALL_CLUSTERS),
        ("missing_tokens", lambda: tokens is not None),
        ("tokens_not_list", lambda: isinstance(tokens, list)),
        ("tokens_empty", lambda: len(tokens) > 0),
    )
    fault = next((reason for reason, holds in rules if not holds()), None)
    if fault is None:
        wrong = next((t for t in tokens if not _integer(t) or not settings.TOKEN_MIN <= t <= settings.TOKEN_MAX), None)
        if wrong is not None or None in tokens:
            first = next(t for t in tokens if not _integer(t) or not settings.TOKEN_MIN <= t <= settings.TOKEN_MAX)
            fault = "token_out_of_range" if _integer(first) else "token_not_integer"
        elif "token_count" in record:
            count = record["token_count"]
            fault = "token_count_not_integer" if not _integer(count) else "token_count_mismatch" if count != len(tokens) else None
    if fault:
        return False, cluster, None, fault
    return True, cluster, tokens, None


def _fit(v):
    valid, cluster, tokens, reason = v
    if cluster is not None and not -(1 << 63) <= cluster < 1 << 63:
        cluster = None  # a declared divergence: the column is a BIGINT
    return {"valid": valid, "cluster_id": cluster, "tokens": tokens, "rejection_reason": reason}


def _validate(values: pa.Array) -> pa.Array:
    return pa.array([_fit(verdict(v)) for v in values.to_pylist()], _TYPE)


def validated(value: Column) -> Column:
    """struct<valid, cluster_id, tokens, rejection_reason>; value is text or bytes."""
    ship()
    return F.arrow_udf(_validate, VERDICT)(value)
