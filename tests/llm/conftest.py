import glob
import os

import pytest

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def sf():
    if not os.path.isdir(SF):
        pytest.skip("no test tables")
    return SF


@pytest.fixture(scope="session")
def duck(sf):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for p in glob.glob(f"{sf}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(p)[:-8]} AS SELECT * FROM '{p}'")
    return con


#: Rows that every operator on documents must get over: nulls, empty and long texts, ties, repeated rows, clashing extra columns.
LONG = " ".join(f"word{i % 977} and {i % 31}" for i in range(12000)) + " end"
ODD = [
    (1, None, "en"), (2, "", "en"), (3, "   \n\t ", None), (4, "one", "de"), (5, "Two words", None), (5, "Two words", None), (None, "Two words", "en"), (7, LONG, "en"), (8, LONG, "en"), (9, LONG[:4000] + " changed " + LONG[4000:], None),
    (10, "Ünïcödé – 日本語 😀  x\x1c\x85y <|endoftext|> it's 12.5%", "fr"), (11, "a" * 450, "de"), (12, "1234 !!! 5678", "en"), (13, "\x00\x01 nul", None), (14, "LICENSE: Released under the MIT License.\n\nx y z", "en"),
]


@pytest.fixture
def odd(spark):
    rows = [(i, t, lang, "src0", None if t is None else len(t), 0.5, "k", 7, 8, *"bcdefghijklmno") for i, t, lang in ODD]
    clashing = ["component_id", "_tokenmix_block", "_tokenmix_matches", "_copies", "_text_hash", "_text_bytes", "_m", "_row", "row", "k", "i", "nth", "text_hash", "text_bytes"]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, score double, key string, blk long, fp long, " + ", ".join(f"{c} string" for c in clashing))


@pytest.fixture
def nothing(odd):
    return odd.limit(0)
