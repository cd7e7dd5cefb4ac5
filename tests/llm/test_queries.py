"""Registered queries against their oracles, and the pipeline against the operators' plain counterparts."""

import hashlib

import numpy as np
import pytest

import corpus_pipeline
from tokenmix.llm import bpe, queries

from .test_dedup import plain_hits, plain_repeats
from .test_near import plain_classes

tokenizers = pytest.importorskip("tokenizers")


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_equals_oracle(spark, sf, duck, tmp_path, name):
    out = str(tmp_path / "out")
    queries.queries()[name](spark, sf).write.parquet(out)
    want, got = duck.sql(queries.oracle_sql()[name]), duck.sql(f"SELECT * FROM '{out}/*.parquet'")
    cols = sorted(want.columns)
    assert cols == sorted(got.columns)
    pick = ", ".join(f'"{c}"' for c in cols)
    key = lambda r: tuple((x is None, str(x)) for x in r)
    assert sorted(duck.sql(f"SELECT {pick} FROM want").fetchall(), key=key) == sorted(duck.sql(f"SELECT {pick} FROM got").fetchall(), key=key)


def test_one_query_per_operator():
    names = list(queries.queries())
    assert [n.split("_")[0] for n in names if n.startswith("op")] == [f"op{k}" for k in range(1, 11)] and "pipeline" in names


def test_repeats_query_equals_brute_force(spark, sf, duck):
    rows = duck.sql("SELECT doc_id, text FROM documents").fetchall()
    got = sorted(tuple(r) for r in queries.op7_repeats(spark, sf).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect())
    assert got == sorted(plain_repeats(rows))


def test_pipeline_stage_by_stage(spark, sf, duck, tmp_path):
    """Each stage keeps what it should, and run() gives what the stages give one after another."""
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns, made = docs.columns, {}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = {r["doc_id"]: r["text"] for r in docs.collect()}
        stage(spark, docs, sf).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        made[name] = (before, {r["doc_id"]: (r["text"] if "text" in docs.columns else r["n_tokens"]) for r in docs.collect()})
        if k < len(corpus_pipeline.STAGES) - 1:
            assert docs.columns == columns
    before, after = made["language_id"]
    assert set(after) == {i for i, t in before.items() if t and any(c.isalpha() for c in t)}
    before, after = made["simhash_near_dedup"]
    order = sorted(before)
    assert set(after) == {order[k] for k in set(plain_classes([before[i] for i in order]))} and all(after[i] == before[i] for i in after)
    before, after = made["suffix_array_dedup"]
    want = {r[0]: r for r in plain_repeats(list(before.items()))}
    assert set(after) == {i for i, r in want.items() if r[1] > r[2]} and all(after[i] == before[i] for i, r in want.items() if not r[2])
    before, after = made["benchmark_decontamination"]
    items = duck.sql("SELECT item_id, text FROM benchmark").fetchall()
    assert set(after) == {i for i, t in before.items() if not plain_hits(t, items)[1]}
    final = sorted(tuple(r) for r in docs.collect())
    before, _ = made["bpe_encode_decode"]
    tok = tokenizers.Tokenizer.from_file(bpe.vocabulary_path())
    want = []
    for i, text in sorted(before.items()):
        ids = tok.encode(text or "", add_special_tokens=False).ids
        plain = tok.decode(ids, skip_special_tokens=False)
        want.append((i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(plain.encode()).hexdigest()))
    assert final == want
    assert final == sorted(tuple(r) for r in corpus_pipeline.run(spark, sf).collect())


def test_pipeline_of_odd_and_no_rows(spark, odd, nothing, sf):
    for docs in (odd, nothing):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            docs = stage(spark, docs, sf)
            assert docs.columns == odd.columns
        docs.collect()
