"""Two integers out of a record without reading its tokens, as column expressions.

A record must be ``{"cluster_id": int, "tokens": [...], "token_count": int}`` with these keys in this order and no
other field outside the brackets, which are not looked into. ``reason`` names the first rule that a record breaks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import settings

_EDGE, _SKIP, _INT = r"[ \t\n\r\x0B\f]*", r"[ \t\r\n]*", r"(-?[0-9]+)"
KEYS = ('"cluster_id"', '"tokens"', '"token_count"')
#: (reason if the pattern up to and with this part doesn't match, part)
_LADDER = (
    ("field_before_cluster_id", r"\{" + _EDGE + KEYS[0]),
    ("cluster_id_without_colon", _SKIP + ":"),
    ("cluster_id_not_integer", _SKIP + _INT),
    ("field_before_tokens", _EDGE + "," + _EDGE + KEYS[1]),
    ("tokens_without_colon", _SKIP + ":"),
    ("tokens_not_array", _SKIP + r"\["),
    ("field_before_token_count", r".*\]" + _EDGE + "," + _EDGE + KEYS[2]),
    ("token_count_without_colon", _SKIP + ":"),
    ("token_count_not_integer", _SKIP + _INT),
    ("field_after_token_count", _EDGE + r"\}\z"),
)
WHOLE = r"(?s)\A" + _EDGE + "".join(p for _, p in _LADDER)[: -len(r"\z")] + _EDGE + r"\z"


def _fields(value: Column) -> tuple[Column, Column, Column, Column]:
    """(regular, cluster_id, token_count, whether that is positive but no BIGINT) of records that have the layout."""
    regular = F.coalesce(value.rlike(WHOLE), F.lit(False)) & (F.regexp_count(value, F.lit("|".join(KEYS))) == 3)
    cluster = F.regexp_extract(value, WHOLE, 1).try_cast("long")
    count = F.regexp_extract(value, WHOLE, 2).try_cast("long")
    return regular, cluster, count, count.isNull() & ~F.regexp_extract(value, WHOLE, 2).startswith("-")


def _fault(value: Column) -> Column:
    """The reason of a record that hasn't the layout."""
    data = F.btrim(value, F.lit(" \t\n\r\x0b\f"))
    at = [F.instr(data, F.lit(k)) for k in KEYS]
    out = F.when(value.isNull() | ~(data.startswith("{") & data.endswith("}")), "not_object")
    out = out.when(~((at[0] > 1) & (at[0] < at[1]) & (at[1] < at[2])), "layout")
    out = out.when(F.regexp_count(data, F.lit("|".join(KEYS))) != 3, "duplicate_key")
    pattern = r"(?s)\A"
    for reason, part in _LADDER:
        pattern += part
        out = out.when(~data.rlike(pattern), reason)
    return out.otherwise("layout")


def extract(lines: DataFrame, value: str = "value") -> DataFrame:
    """lines without value, with cluster_id int, token_count long and reason string (null: accepted). Counts that no BIGINT holds are rejected as such."""
    v = F.col(value)
    regular, cluster, count, large = _fields(v)
    known = F.when(regular, F.struct(cluster.alias("cluster"), count.alias("count"), large.alias("large")))
    first, last = min(settings.ALL_CLUSTERS), max(settings.ALL_CLUSTERS)
    k, n = F.col("_k.cluster"), F.col("_k.count")
    reason = (
        F.when(F.col("_k").isNull(), _fault(v))
        .when(~F.coalesce(k.between(first, last), F.lit(False)), "cluster_id_out_of_range")
        .when(F.col("_k.large"), "token_count_beyond_64_bits")
        .when(~F.coalesce(n > 0, F.lit(False)), "token_count_not_positive")
    )
    rest = [c for c in lines.columns if c != value]
    return lines.withColumn("_k", known).withColumn("reason", reason).select(*rest, F.when(F.col("reason").isNull(), k).cast("int").alias("cluster_id"), F.when(F.col("reason").isNull(), n).alias("token_count"), "reason")
