"""Plan, sources, extraction, validation, ledger, report, verifier and command line on small fixtures."""

import io
import json
import os

import pytest
from pyspark.sql import functions as F

from tokenmix import cli, report, settings
from tokenmix.functions import canonical, columns
from tokenmix.functions.store import Store
from tokenmix.operators import aggregate, sample
from tokenmix.operators.extract import extract
from tokenmix.operators.validate import validated, verdict
from tokenmix.plans import workplan
from tokenmix.sources import jsonl, ranges
from tokenmix.streaming import ledger

TOY = [("part_0.tokenized.jsonl", 1000), ("part_1.tokenized.jsonl", 2500), ("part_2.tokenized.jsonl", 150)]
CORPUS = settings.Corpus("repo", "rev-1", seed="seed-x", region_bytes=256)


def record(cluster, tokens, **more):
    return json.dumps({"cluster_id": cluster, "tokens": tokens, "token_count": len(tokens)} | more, separators=(",", ":")).encode()


# --- plan ---


def test_plan_golden_hash_and_order(spark):
    plan = workplan.make(spark, TOY[::-1], CORPUS)
    assert len(plan["work_items"]) == 15
    assert plan["hash"] == "cdf40a946946850e703818c638bab351cd1fc3ec24905210374129454f85dfb8"
    first = [(i["filename"][:6], i["range_start"], i["range_end"]) for i in plan["work_items"][:3]]
    assert first == [("part_1", 1280, 1536), ("part_1", 2048, 2304), ("part_1", 0, 256)]
    assert workplan.make(spark, TOY, CORPUS) == plan
    assert workplan.make(spark, TOY, settings.Corpus("repo", "rev-1", seed="seed-y", region_bytes=256))["hash"] != plan["hash"]


def test_plan_round_trip_and_tampering(spark, tmp_path):
    plan, path = workplan.make(spark, TOY, CORPUS), str(tmp_path / "work_plan.json")
    workplan.save(path, plan)
    assert workplan.load(spark, path) == plan
    canonical.write_json(path, plan | {"region_bytes": 512})
    with pytest.raises(ValueError, match="hash"):
        workplan.load(spark, path)

    def tampered(change):
        p = json.loads(json.dumps(plan))
        change(p)
        p["hash"] = workplan.plan_hash(p)
        canonical.write_json(path, p)
        with pytest.raises(ValueError) as e:
            workplan.load(spark, path)
        return str(e.value)

    assert "version" in tampered(lambda p: p.update(schema_version=1))
    assert "dense" in tampered(lambda p: p["work_items"].pop(4))
    assert "unknown" in tampered(lambda p: p["work_items"][2].update(filename="part_9.tokenized.jsonl"))
    assert "identity" in tampered(lambda p: p["work_items"][2].update(work_item_id="x"))
    assert "duplicate" in tampered(lambda p: p["source_files"].append(p["source_files"][0]))

    def moved(p):
        i = p["work_items"][0]
        i.update(range_end=i["range_end"] + 10**6, work_item_id=f"rev-1:{i['filename']}:{i['range_start']}:{i['range_end'] + 10**6}")

    assert "outside" in tampered(moved)

    def gap(p):
        i = p["work_items"][0]
        i.update(range_end=i["range_end"] - 1, work_item_id=f"rev-1:{i['filename']}:{i['range_start']}:{i['range_end'] - 1}")

    assert "gaps" in tampered(gap)


@pytest.mark.parametrize("files", [[], [("a", 0)], [("a", True)], [("a", 5), ("a", 5)]])
def test_plan_rejects_bad_files(spark, files):
    with pytest.raises(ValueError):
        workplan.make(spark, files, CORPUS)


def test_glob_is_case_sensitive_and_root_only(spark):
    names = ["part_1.tokenized.jsonl", "x/part_1.tokenized.jsonl", "PART_1.tokenized.jsonl", "part_.tokenized.jsonl.gz", "part_a b.tokenized.jsonl", "part_\n.tokenized.jsonl"]
    for glob in ("part_*.tokenized.jsonl", "part_[0-9].*", "part_?.tok*"):
        got = [r[0] for r in spark.createDataFrame([(n,) for n in names], "p string").select(columns.in_root(F.col("p"), glob)).collect()]
        assert got == [ranges.matches(n, glob) for n in names], glob


# --- ranges ---


def owned(data, start, end, **chunks):
    return list(ranges.owned_records(ranges.LocalRange(data), start, end, **chunks))


def by_split(data):
    out, at = [], 0
    for line in data.split(b"\n"):
        if at < len(data):
            out.append((at, line[:-1] if line.endswith(b"\r") else line))
        at += len(line) + 1
    return out


@pytest.mark.parametrize("region", [1, 16, 37, 64, 97, 128, 1024, 10**6])
@pytest.mark.parametrize("ahead", [3, 50, 1 << 20])
def test_every_line_is_owned_once(region, ahead):
    data = b"".join(record(k % 20 + 1, list(range(800 if k == 5 else k % 4 + 1))) + (b"\r\n" if k % 3 == 0 else b"\n") for k in range(40))
    data += b"\n\n\rlone\rcr\n" + b"last without newline"
    got = [r for s in range(0, len(data), region) for r in owned(data, s, min(s + region, len(data)), ahead=ahead)]
    assert got == by_split(data)


def test_giant_record_and_line_head(tmp_path):
    data = record(1, list(range(3000))) + b"\n" + record(2, [1, 2]) + b"\n"
    second = data.index(b"\n") + 1
    starts = [(s, r[0]) for s in range(0, len(data), 64) for r in owned(data, s, min(s + 64, len(data)))]
    assert starts == [(0, 0), (second // 64 * 64, second)]
    path = tmp_path / "f"
    path.write_bytes(data)
    for reader in (ranges.LocalRange(data), ranges.LocalRange(str(path))):
        assert ranges.line_head(reader, 500, 7) == 0 and ranges.line_head(reader, second + 3, 7) == second and ranges.line_head(reader, second, 5) == second
        assert reader.read_range(len(data), 5) == b"" and reader.read_range(len(data) - 2, 50) == data[-2:]
        for bad in ((-1, 1), (0, 0)):
            with pytest.raises(ValueError):
                reader.read_range(*bad)
    with pytest.raises(ValueError):
        owned(data, 5, 5)
    with pytest.raises(ValueError):
        owned(data, 0, 5, ahead=0)


class Answer(io.BytesIO):
    def __init__(self, data, status=206, said=""):
        super().__init__(data)
        self.status, self.headers = status, {"Content-Range": said}


def test_http_ranges_clamp_check_and_retry():
    asked, waits, answers = [], [], []

    def opener(request, timeout):
        asked.append(request.get_header("Range"))
        a = answers.pop(0)
        if isinstance(a, Exception):
            raise a
        return a

    r = ranges.HttpRange("http://x/f", 10, opener, waits.append)
    answers[:] = [Answer(b"789", said="bytes 7-9/10")]
    assert r.read_range(7, 100) == b"789" and asked == ["bytes=7-9"]
    answers[:] = [OSError("reset"), Answer(b"7", said="bytes 7-9/10"), Answer(b"789", 200, "bytes 7-9/10"), Answer(b"789", said="bytes 7-9/10")]
    assert r.read_range(7, 3) == b"789" and waits == [1.5, 3.0, 6.0]
    assert r.read_range(10, 1) == b"" and len(asked) == 5
    answers[:] = [OSError("down")] * 6
    with pytest.raises(RuntimeError, match="6 attempts"):
        r.read_range(0, 1)


def test_tree_listing_pages():
    pages = [{"tree": [{"type": "file", "path": "part_2.tokenized.jsonl", "size": 5}, {"type": "directory", "path": "part_x"}], "cursor": "a b"}, [{"type": "file", "path": "part_1.tokenized.jsonl", "size": 7}, {"type": "file", "path": "sub/part_1.tokenized.jsonl", "size": 7}]]
    urls = []

    def opener(request, timeout):
        urls.append(request.full_url)
        return Answer(json.dumps(pages[len(urls) - 1]).encode())

    assert ranges.list_tree("http://x/tree?r=1", "part_*.tokenized.jsonl", opener) == [("part_1.tokenized.jsonl", 7), ("part_2.tokenized.jsonl", 5)]
    assert urls[1].endswith("&cursor=a%20b")
    bad = lambda p: (lambda request, timeout: Answer(json.dumps(p).encode()))
    for p in ([], [{"type": "file", "path": "part_1.tokenized.jsonl", "size": 0}], {"x": 1}):
        with pytest.raises(RuntimeError):
            ranges.list_tree("http://x", "part_*.tokenized.jsonl", bad(p))


# --- records ---

EXTRACT = [
    (b'  { "cluster_id" : 12 , "tokens" : [1, 2, 3] , "token_count" : 3 }  ', (12, 3, None)),
    (b'{"cluster_id":1,"tokens":[1],"x":[2],"token_count":007}', (1, 7, None)),
    (b'{"cluster_id":1,"tokens":[99999999, oops],"token_count":9}', (1, 9, None)),
    (b'\x0b{"cluster_id":1\x0b,"tokens":[],"token_count":9}\x0c', (1, 9, None)),
    (b"", "not_object"), (b"[]", "not_object"), (b"{}", "layout"), (b'{"cluster_id":1,"tokens":[1]}', "layout"), (b'{"token_count":0,"cluster_id":1,"tokens":[1]}', "layout"),
    (b'{"cluster_id":1,"tokens":["cluster_id"],"token_count":1}', "duplicate_key"), (b'{"cluster_id":1,"cluster_id":2,"tokens":[1],"token_count":1}', "duplicate_key"),
    (b'{"x":1,"cluster_id":1,"tokens":[1],"token_count":1}', "field_before_cluster_id"), (b'{"cluster_id" 1,"tokens":[1],"token_count":1}', "cluster_id_without_colon"),
    (b'{"cluster_id":\x0b1,"tokens":[1],"token_count":1}', "cluster_id_not_integer"), (b'{"cluster_id":+5,"tokens":[1],"token_count":1}', "cluster_id_not_integer"), (b'{"cluster_id":"1","tokens":[1],"token_count":1}', "cluster_id_not_integer"),
    (b'{"cluster_id":1.0,"tokens":[1],"token_count":1}', "field_before_tokens"), (b'{"cluster_id":1e0,"tokens":[1],"token_count":1}', "field_before_tokens"), (b'{"cluster_id":1,"tokens":{},"token_count":1}', "tokens_not_array"),
    (b'{"cluster_id":1,"tokens":[1],"x":1,"token_count":1}', "field_before_token_count"), (b'{"cluster_id":1,"tokens":[1],"token_count":null}', "token_count_not_integer"), (b'{"cluster_id":1,"tokens":[1],"token_count":1,"x":1}', "field_after_token_count"),
    (b'{"cluster_id":21,"tokens":[1],"token_count":1}', "cluster_id_out_of_range"), (b'{"cluster_id":-1,"tokens":[1],"token_count":1}', "cluster_id_out_of_range"), (b'{"cluster_id":1,"tokens":[1],"token_count":0}', "token_count_not_positive"),
    (b'{"cluster_id":1,"tokens":[1],"token_count":99999999999999999999}', "token_count_beyond_64_bits"), (b'{"cluster_id":1,"tokens":[1],"token_count":-99999999999999999999}', "token_count_not_positive"), ("﻿".encode() + b'{"cluster_id":1,"tokens":[1],"token_count":1}', "not_object"),
]


def test_extraction_rules(spark):
    rows = spark.createDataFrame([(k, v.decode()) for k, (v, _) in enumerate(EXTRACT)] + [(99, None)], "k int, value string")
    got = {r["k"]: r for r in extract(rows).collect()}
    for k, (raw, want) in enumerate(EXTRACT):
        assert (got[k]["cluster_id"], got[k]["token_count"], got[k]["reason"]) == (want if isinstance(want, tuple) else (None, None, want)), raw
    assert got[99]["reason"] == "not_object"


VERDICTS = [
    (record(3, [1, 2]), None), (record(11, [0, 50256]), None), (b'{"tokens":[5],"cluster_id":2,"more":1}', None), (b"{", "json_parse_error"), (b"[1]", "json_parse_error"), (b'{"a":1} x', "json_parse_error"), (b"", "json_parse_error"),
    (b'{"tokens":[1]}', "missing_cluster_id"), (b'{"cluster_id":null}', "missing_cluster_id"), (b'{"cluster_id":true}', "cluster_id_not_integer"), (b'{"cluster_id":1.0}', "cluster_id_not_integer"), (b'{"cluster_id":0}', "cluster_id_out_of_range"),
    (b'{"cluster_id":99999999999999999999}', "cluster_id_out_of_range"), (b'{"cluster_id":1}', "missing_tokens"), (b'{"cluster_id":1,"tokens":5}', "tokens_not_list"), (b'{"cluster_id":1,"tokens":[]}', "tokens_empty"),
    (b'{"cluster_id":1,"tokens":[1,null,60000]}', "token_not_integer"), (b'{"cluster_id":1,"tokens":[1,60000,null]}', "token_out_of_range"), (b'{"cluster_id":1,"tokens":[NaN]}', "token_not_integer"), (b'{"cluster_id":1,"tokens":[-1]}', "token_out_of_range"),
    (b'{"cluster_id":1,"tokens":[1],"token_count":null}', "token_count_not_integer"), (b'{"cluster_id":1,"tokens":[1],"token_count":2}', "token_count_mismatch"), (b'{"cluster_id":5,"cluster_id":6,"tokens":[1]}', None),
]


def test_validation_rules(spark):
    for raw, reason in VERDICTS:
        assert verdict(raw)[3] == reason and verdict(raw)[0] == (reason is None), raw
    rows = spark.createDataFrame([(k, bytearray(v)) for k, (v, _) in enumerate(VERDICTS)] + [(99, None)], "k int, value binary")
    got = {r["k"]: r["v"] for r in rows.select("k", validated(F.col("value")).alias("v")).collect()}
    assert {k: v["rejection_reason"] for k, v in got.items()} == {k: r for k, (_, r) in enumerate(VERDICTS)} | {99: "json_parse_error"}
    assert got[1]["tokens"] == [0, 50256] and got[12]["cluster_id"] is None


def test_canonical_json_and_golden_weights(tmp_path):
    tokens = dict(enumerate((3063924776, 4582654670, 5771522873, 12797349739, 6563519102, 70958523234, 64041261564, 3818960760, 2978940628, 26975813961, 5072074227, 78310785713, 2561634721, 834424339, 804163375, 27851136242, 26785891472, 7392477294, 3836811747, 1862658535), 1))
    path = str(tmp_path / "w.json")
    canonical.write_json(path, report.weights_of(tokens))
    assert canonical.file_sha256(path) == "76e82e22760adcac59c7294fe9bac11358f5a8b7a26035aae64c3f2e6fa1acb7"
    assert canonical.canonical({"b": "ü", "a": 1}, ("a",)) == '{\n  "b": "ü"\n}\n'.encode()
    assert os.listdir(tmp_path) == ["w.json"] and canonical.read_json(path)["20"] == 1862658535


# --- scans ---


@pytest.fixture
def corpus(tmp_path):
    folder = tmp_path / "src"
    folder.mkdir()
    (folder / "part_0.tokenized.jsonl").write_bytes(b"".join(record(c, list(range(c + 1))) + b"\n" for c in range(1, 21)))
    (folder / "ignored.txt").write_bytes(b"x")
    return str(folder)


def plan_of(spark, folder, region=97):
    return workplan.make(spark, ranges.list_folder(folder, CORPUS.glob), settings.Corpus("repo", "rev-1", seed="seed-x", region_bytes=region))


def test_scan_totals_and_verification(spark, corpus, tmp_path):
    plan, out = plan_of(spark, corpus), str(tmp_path / "out")
    workplan.save(f"{out}/work_plan.json", plan)
    made = ledger.scan(spark, out, plan, batch_items=7, folder=corpus)
    assert (made["all_source_tokens"], made["accepted_source_tokens"], made["record_count"]) == (230, 218, 20)
    assert "11" not in canonical.read_json(f"{out}/mixture_weights.json")
    assert report.verify(spark, out)["status"] == "PASS"
    assert ledger.scan(spark, out, plan, resume=True, folder="/nowhere") == made
    with pytest.raises(FileExistsError):
        ledger.scan(spark, out, plan, folder=corpus)
    for name, field, value in (("mixture_report.json", "record_count", 21), ("mixture_progress.json", "source_bytes_covered", 1), ("mixture_weights.json", "3", 5), ("work_plan.json", "region_bytes", 98)):
        kept = canonical.read_json(f"{out}/{name}")
        canonical.write_json(f"{out}/{name}", kept | {field: value})
        with pytest.raises(ValueError):
            report.verify(spark, out)
        canonical.write_json(f"{out}/{name}", kept)
    assert report.verify(spark, out, artifacts={"work_plan.json": canonical.file_sha256(f"{out}/work_plan.json")})["records"] == 20


def test_interrupted_scan_goes_on_to_the_same_bytes(spark, corpus, tmp_path):
    plan = plan_of(spark, corpus)
    a, b = str(tmp_path / "a"), str(tmp_path / "b")
    ledger.scan(spark, a, plan, batch_items=100, folder=corpus)
    with pytest.raises(ledger.Interrupted):
        ledger.scan(spark, b, plan, batch_items=3, stop_after=2, folder=corpus)
    ledger.append(Store(spark, b), "ledger", plan, plan["work_items"][2:4], folder=corpus)  # appended but not counted
    ledger.scan(spark, b, plan, resume=True, batch_items=4, folder=corpus)
    for name in ("mixture_report.json", "mixture_weights.json"):
        assert open(f"{a}/{name}", "rb").read() == open(f"{b}/{name}", "rb").read()
    state = canonical.read_json(f"{b}/mixture_progress.json")
    for k, v in (("work_plan_hash", "x"), ("next_work_item_index", True), ("completed_work_items", 1), ("source_bytes_covered", 0), ("cluster_source_tokens", {}), ("cluster_document_counts", ledger.empty_map() | {"1": -1})):
        with pytest.raises(ValueError):
            ledger.check_state(state | {k: v}, plan)


def test_runs_in_a_folder_of_another_file_system(spark, corpus, tmp_path):
    """Documents and ledger through Hadoop's file system: crash, resume with another batch size, the same bytes."""
    plan, a, b = plan_of(spark, corpus), str(tmp_path / "a"), f"file://{tmp_path}/b"
    ledger.scan(spark, a, plan, batch_items=100, folder=corpus)
    with pytest.raises(ledger.Interrupted):
        ledger.scan(spark, b, plan, batch_items=2, stop_after=4, in_flight=1, folder=f"file://{corpus}")
    assert Store(spark, b).json("mixture_progress.json")["next_work_item_index"] == 4
    made = ledger.scan(spark, b, plan, resume=True, batch_items=3, in_flight=2, folder=f"file://{corpus}")
    assert Store(spark, a).read("mixture_report.json") == Store(spark, b).read("mixture_report.json") and made["record_count"] == 20
    Store(spark, b).put("work_plan.json", plan)
    assert report.verify(spark, b)["status"] == "PASS"
    with pytest.raises(FileNotFoundError):
        Store(spark, b).json("nothing.json")
    assert Store(spark, b).children("nothing") == [] and [n for n in os.listdir(tmp_path / "b") if n.endswith(".tmp")] == []


def test_a_ledger_that_lacks_a_batch_is_refused(spark, corpus, tmp_path):
    plan, out = plan_of(spark, corpus), str(tmp_path / "r")
    with pytest.raises(ledger.Interrupted):
        ledger.scan(spark, out, plan, batch_items=2, stop_after=4, folder=corpus)
    store = Store(spark, out)
    store.drop("ledger/" + store.children("ledger")[0])
    with pytest.raises(ValueError, match="add up"):
        ledger.scan(spark, out, plan, resume=True, folder=corpus)


def test_at_most_so_many_regions_at_once_and_a_reader_of_ones_own(spark, corpus):
    plan = plan_of(spark, corpus)
    data = open(f"{corpus}/part_0.tokenized.jsonl", "rb").read()
    mine = jsonl.ranges(spark, plan, reader=lambda path, size: ranges.LocalRange(data))
    assert mine.rdd.getNumPartitions() == len(plan["work_items"]) and mine.coalesce(3).rdd.getNumPartitions() == 3
    rows = lambda df: sorted((r["work_index"], r["record_start"], bytes(r["value"])) for r in df.collect())
    assert rows(mine) == rows(jsonl.ranges(spark, plan, folder=corpus)) == rows(jsonl.ranges(spark, plan, folder=f"file://{corpus}")) and mine.count() == 20
    with pytest.raises(ValueError):
        jsonl.ranges(spark, plan, folder=corpus, url="http://x/{path}")
    assert ranges.list_folder(f"file://{corpus}", CORPUS.glob) == ranges.list_folder(corpus, CORPUS.glob)


def test_empty_plans_are_refused(spark, corpus, tmp_path):
    plan = plan_of(spark, corpus) | {"source_files": [], "work_items": []}
    path = str(tmp_path / "plan.json")
    workplan.save(path, plan | {"hash": canonical.self_hash(plan, "hash")})
    with pytest.raises(ValueError, match="empty"):
        workplan.load(spark, path)


def test_record_at_any_byte():
    data = b"first\n\nthird one\r\nlast"
    reader = ranges.LocalRange(data)
    want = {k: (0, b"first") if k < 6 else (6, b"") if k < 7 else (7, b"third one") if k < 18 else (18, b"last") for k in range(len(data))}
    assert {k: ranges.record_at(reader, k, 3, 4) for k in range(len(data))} == want
    with pytest.raises(ValueError):
        ranges.record_at(reader, len(data))


def test_bad_record_stops_the_scan_and_is_named(spark, tmp_path):
    folder = tmp_path / "src"
    folder.mkdir()
    (folder / "part_bad.tokenized.jsonl").write_bytes(b'{"cluster_id":1,"tokens":[1]}\n' + b"".join(record(c, [1]) + b"\n" for c in range(1, 20)))
    plan = plan_of(spark, str(folder), 100)
    with pytest.raises(ledger.BadRecord, match="part_bad.tokenized.jsonl:0: layout"):
        ledger.scan(spark, str(tmp_path / "o"), plan, folder=str(folder))
    (folder / "part_bad.tokenized.jsonl").write_bytes(b"".join(record(c, [1]) + b"\n" for c in range(1, 20)))
    with pytest.raises(RuntimeError, match=r"\[20\]"):
        ledger.scan(spark, str(tmp_path / "p"), plan_of(spark, str(folder), 100), folder=str(folder))


def test_size_drift_stops_the_scan(spark, corpus, tmp_path):
    plan = plan_of(spark, corpus)
    with open(f"{corpus}/part_0.tokenized.jsonl", "ab") as f:
        f.write(b"x")
    with pytest.raises(Exception, match="changed"):
        jsonl.ranges(spark, plan, folder=corpus).count()


def test_streaming_ledger(spark, corpus, tmp_path):
    plan = plan_of(spark, corpus)
    items = workplan.items_frame(spark, plan)
    for k in range(3):
        items.where(f"index % 3 = {k}").coalesce(1).write.mode("append").parquet(str(tmp_path / "batches"))
    ledger.stream(spark, str(tmp_path / "batches"), str(tmp_path), str(tmp_path / "ck"), plan, folder=corpus).awaitTermination(120)
    got = {r["cluster_id"]: r["tokens"] for r in ledger.fold(ledger.read(Store(spark, str(tmp_path)), "ledger", 10**6)).collect()}
    assert got == {c: c + 1 for c in range(1, 21)}


def test_text_scan_and_range_scan_agree(spark, corpus):
    with open(f"{corpus}/part_0.tokenized.jsonl", "ab") as f:
        f.write(b"\n\rx\r\n" + record(1, [1]))
    text = {(r["file"], r["record_start"], r["value"]) for r in jsonl.with_offsets(spark, corpus, CORPUS.glob).collect()}
    got = {(r["file"], r["record_start"], bytes(r["value"]).decode()) for r in jsonl.ranges(spark, plan_of(spark, corpus), folder=corpus).collect()}
    assert text == got and len(got) == 23
    assert jsonl.scan(spark, corpus, CORPUS.glob).count() == 23
    assert [tuple(r) for r in jsonl.listing(spark, corpus, CORPUS.glob).collect()] == ranges.list_folder(corpus, CORPUS.glob)


def test_audit_sample(spark, corpus):
    rows = sample.audit(jsonl.ranges(spark, plan_of(spark, corpus), folder=corpus), 5).collect()
    assert len(rows) == 5 and all(r["valid"] for r in rows)


def test_aggregates_of_nothing(spark):
    t = aggregate.totals(spark.createDataFrame([], "cluster_id int, token_count long"))
    assert aggregate.dense(t).count() == 20 and aggregate.missing(t).count() == 20
    assert tuple(aggregate.grand(t).collect()[0]) == (0, 0, 0, 0) and not aggregate.positivity(t).collect()[0]["all_positive"]


def test_command_line(spark, corpus, tmp_path, capsys):
    out = str(tmp_path / "run")
    args = ["scan", "--output-dir", out, "--source-dir", corpus, "--region-bytes", "97", "--checkpoint-every-work-items", "2"]
    assert cli.main([*args, "--simulate-crash-after-work-items", "4"]) == 1 and "Interrupted" in capsys.readouterr().err
    assert cli.main(args) == 1 and "exists" in capsys.readouterr().err
    assert cli.main([*args, "--resume", "--dataset", "other"]) == 1
    assert cli.main([*args, "--resume"]) == 0
    assert json.loads(capsys.readouterr().out)["record_count"] == 20
    assert cli.main([*args[:-2], "--workers", "0"]) == 1
    assert cli.main(["verify", out]) == 0 and '"status": "PASS"' in capsys.readouterr().out
