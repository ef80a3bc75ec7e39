"""Files of every kind: structural scan of JSON, a corpus from a tree, heads, counts. Plain Python tells what to expect."""

import csv
import gzip
import hashlib
import io
import json
import os
import random

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from chatloom.operators import inventory, validate
from chatloom.plans import corpus
from chatloom.sources import corpus_sink, corpus_source, heads, json_ranges, paths, readers

ANSWER = "an answer that is long enough"


def record(i):
    return {"prompt": f"question {i} é", "response": ANSWER}


@pytest.fixture
def small_splits(spark):
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def put(path, data):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "wb") as f:
        f.write(data if isinstance(data, bytes) else data.encode())


# -- the structural scan -----------------------------------------------------------------------


def scanned(blocks):
    """What the two passes make of a file that is cut into these blocks of pieces; None if it is bad."""
    states, in_string, depth = [json_ranges.summary(b) for b in blocks], False, 0
    listed = next((s[3] for s in states if s[3]), "") == "["
    out, held, bad, closed = [], [], False, False
    for k, (block, (odd, outside, inside, _)) in enumerate(zip(blocks, states)):
        for kind, text in json_ranges.cut(block, k == 0, in_string, depth, listed):
            if kind == json_ranges.WHOLE:
                out.append(text)
            elif kind == json_ranges.TAIL:
                held = [text]
            elif kind == json_ranges.MIDDLE:
                held.append(text)
            elif kind == json_ranges.HEAD:
                out.append("".join([*held, text]))
                held = []
            elif kind == json_ranges.BAD:
                bad = True
            else:
                closed = True
        depth += inside if in_string else outside
        in_string ^= odd
    if not listed:
        out = ["".join(held)]
    elif held or not closed:
        bad = True
    try:
        return None if bad else [json.loads(x) for x in out]
    except ValueError:
        return None


def value(rng, depth=0):
    k = rng.random()
    if k < 0.3 or depth > 3:
        return rng.choice(["a", "},", '"},{"', "\\", "[", "]", '{"x":[', "é\n", '\\"},', 1, None, True, 2.5, ""])
    if k < 0.6:
        return [value(rng, depth + 1) for _ in range(rng.randint(0, 3))]
    return {str(i): value(rng, depth + 1) for i in range(rng.randint(0, 3))}


@pytest.mark.parametrize("seed", range(4))
def test_cuts_at_every_piece(seed):
    """Any value, sound or broken, cut nowhere, at every separator and at some, is what json.loads says."""
    rng = random.Random(seed)
    for _ in range(700):
        v = [value(rng) for _ in range(rng.randint(0, 6))] if rng.random() < 0.5 else value(rng)
        text = json.dumps(v, indent=rng.choice([None, 1]), ensure_ascii=rng.random() < 0.5)
        if rng.random() < 0.3:
            at = rng.randrange(len(text) + 1)
            text = text[:at] + rng.choice(["", ",", "]", "}", '"', "x", "\\"]) + text[at + rng.randint(0, 2) :]
        try:
            want = json.loads(text)
            want = want if isinstance(want, list) else [want]
        except ValueError:
            want = None
        first, *rest = text.split(json_ranges.SEPARATOR)
        pieces = [first, *(json_ranges.SEPARATOR + p for p in rest)]
        for cuts in (set(), set(range(len(pieces))), {rng.randrange(len(pieces) + 1) for _ in range(3)}):
            blocks = [[]]
            for i, p in enumerate(pieces):
                if i in cuts and blocks[-1]:
                    blocks.append([])
                blocks[-1].append(p)
            assert scanned(blocks) == want, text


@pytest.mark.parametrize("shuffled", [False, True])
def test_one_line_lists_are_read_by_many_tasks(spark, tmp_path, small_splits, monkeypatch, shuffled):
    if shuffled:
        monkeypatch.setattr(paths, "BROADCAST_BLOCKS", 0)
    data = [{"i": i, "t": 'x},{"\\' * (i % 7) + "é", "n": [{"a": {}}, {"b": [{}]}]} for i in range(120)]
    put(f"{tmp_path}/a b/c [1]{{x}}+%20.json", json.dumps(data))
    put(f"{tmp_path}/one.json.gz", gzip.compress(json.dumps({"k": data}, indent=1).encode()))
    put(f"{tmp_path}/bad.json", json.dumps(data)[:-1])
    put(f"{tmp_path}/after.json", json.dumps(data) + " x")
    put(f"{tmp_path}/empty.json", "")
    put(f"{tmp_path}/none.json", " [ ] ")
    put(f"{tmp_path}/long.json", json.dumps(["y" * 5000, {"z": "w" * 5000}, 1]))
    found = json_ranges.values(spark, str(tmp_path), paths.any_case((".json", ".json.gz")))
    assert {r.file_path.rsplit("/", 1)[-1] for r in json_ranges.bad_files(found).collect()} == {"bad.json", "after.json"}
    blocks = {r.file_path.rsplit("/", 1)[-1]: r.n for r in json_ranges.block_starts(spark, str(tmp_path)).groupBy("file_path").agg(F.count("*").alias("n")).collect()}
    assert blocks["c [1]{x}+%20.json"] > 8 and blocks["bad.json"] > 8
    rows = json_ranges.records(spark, str(tmp_path), paths.any_case((".json", ".json.gz"))).collect()
    by_file = {}
    for r in sorted(rows, key=lambda r: (r.block, r.place)):
        by_file.setdefault(r.file_path.rsplit("/", 1)[-1], []).append(json.loads(r.raw))
    assert by_file == {"c [1]{x}+%20.json": data, "one.json.gz": [{"k": data}], "long.json": ["y" * 5000, {"z": "w" * 5000}, 1]}


# -- a corpus from a tree ----------------------------------------------------------------------


def tree(root):
    put(f"{root}/cat/own__ds/a b.jsonl", "\n".join(json.dumps(record(i)) for i in range(5)) + "\r\n\n \t\n{bad\n" + json.dumps(record(99)))
    put(f"{root}/cat/own__ds/sub/z.JSONL.gz", gzip.compress("\n".join(json.dumps(record(i)) for i in range(3, 8)).encode()))
    put(f"{root}/cat/own__ds/sub-1/n.ndjson", json.dumps(record(50)).encode() + b"\xff\n" + json.dumps({"messages": []}).encode() + b"\n")
    put(f"{root}/cat/own__ds-2/x{{1}}.json", json.dumps([record(i) for i in range(6, 40)], ensure_ascii=False))
    put(f"{root}/cat/own__ds-2/bad.json", '[{"prompt": 1},')
    put(f"{root}/cat/own__ds-2/lone.json", json.dumps(record(60), indent=2))
    put(f"{root}/cat/own__ds-2/note.md", "no data")
    put(f"{root}/cat/own__csv/q [1].csv", f'question,answer\n"line\nbreak, yes",{ANSWER}\n"say ""q2""",{ANSWER}\n,\n')
    put(f"{root}/cat/own__csv/r.csv", f"prompt,other,output\nq3,x,{ANSWER}\n")
    put(f"{root}/cat/own__csv/s.csv", f'"pro\nmpt",input,output\nx,only input,{ANSWER}\n')
    os.makedirs(f"{root}/cat/own__pq")
    pq.write_table(pa.table({"instruction": ["i1", "i2"], "output": [ANSWER, ANSWER]}), f"{root}/cat/own__pq/a.parquet")
    pq.write_table(pa.table({"messages": [[{"role": "user", "from": None, "content": "hi there"}, {"role": "assistant", "from": None, "content": ANSWER}], [{"role": None, "from": "user", "content": "x"}]], "output": pa.array([None, None], pa.int32())}), f"{root}/cat/own__pq/b.parquet")
    said = [{"type": "message", "message": {"role": "user", "content": [{"type": "text", "text": "do it now please"}]}}, {"type": "tool"}, {"type": "message", "message": {"role": "assistant", "content": ANSWER}}]
    put(f"{root}/cat/mondk__agentic-coding-traces/s1.jsonl", "\n".join(map(json.dumps, said)) + "\n{cut")
    put(f"{root}/cat/mondk__agentic-coding-traces/s2.jsonl", '{"type":"tool"}\n')
    turns = [("b", 2, "output", ANSWER), ("b", 1, "input", "second"), ("a", 1, "instruction", "first"), ("b", 0, "input", "also"), ("a", 2, "odd", "x")]
    put(f"{root}/cat/HydraLM__python-code-instructions-18k-alpaca-standardized/t.json", json.dumps([dict(zip(("conversation_id", "message_id", "message_type", "message"), t)) for t in turns]))
    put(f"{root}/other/own__ds/a.jsonl", json.dumps(record(1)))
    put(f"{root}/_skip/own__ds/a.jsonl", json.dumps(record(1)))
    put(f"{root}/cat/own__ds/.cache/a.jsonl", json.dumps(record(1)))
    put(f"{root}/cat/stray.jsonl", json.dumps(record(1)))


def plain(root):
    """(dataset, file, reject, first user text) in the order of a sorted walk."""
    out, seen = [], {}
    for category in ("cat", "other"):
        seen[category] = set()
        for dataset in sorted(os.listdir(f"{root}/{category}")):
            found = []
            for folder, _, names in os.walk(f"{root}/{category}/{dataset}"):
                if ".cache" not in folder:
                    found += [os.path.join(folder, n).split("/") for n in names if not n.endswith(".md")]
            for parts in sorted(found) if os.path.isdir(f"{root}/{category}/{dataset}") else []:
                path = "/".join(parts)
                data = open(path, "rb").read()
                text = (gzip.decompress(data) if path.lower().endswith(".gz") else data).decode("utf-8", "ignore") if ".parquet" not in path else ""
                name = path.lower().removesuffix(".gz")
                if name.endswith(("jsonl", "ndjson")):
                    raws = [x for x in text.splitlines() if x.strip()]
                elif name.endswith("json"):
                    try:
                        v = json.loads(text)
                    except ValueError:
                        continue
                    raws = [json.dumps(x) for x in (v if isinstance(v, list) else [v])]
                elif name.endswith("csv"):
                    raws = [json.dumps(x) for x in csv.DictReader(io.StringIO(text))]
                else:
                    raws = [json.dumps(x) for x in pq.read_table(path).to_pylist()]
                for reject, said in judged(dataset, raws):
                    if reject is None and str(said) in seen[category]:
                        reject = "duplicate"
                    seen[category].add(str(said))
                    out.append((dataset, parts[-1], reject, None if reject not in (None, "duplicate") else said[0]))
    return out


def judged(dataset, raws):
    """(reject, texts) by record, for the shapes that tree() writes; sessions and grouped files by file."""
    rows = []
    for raw in raws:
        try:
            rows.append(json.loads(raw))
        except ValueError:
            rows.append(None)
    if dataset.startswith("mondk"):
        turns = [r["message"] for r in rows if r and r["type"] == "message"]
        said = [m["content"] if isinstance(m["content"], str) else m["content"][0]["text"] for m in turns]
        return [(None, said) if said else ("unsupported_schema", [])]
    if dataset.startswith("HydraLM"):
        return [(None, ["first\n\nalso\n\nsecond", ANSWER])]
    out = []
    for r in rows:
        if r is None:
            out.append(("malformed_json", []))
        elif "messages" in r and r["messages"] is not None:
            good = r["messages"] and r["messages"][0]["role"] is not None
            out.append((None, [m["content"] for m in r["messages"]]) if good else ("empty", []))
        else:
            ask = [r[k] for k in ("instruction", "prompt", "question", "input") if r.get(k)]
            answer = [r[k] for k in ("output", "response", "answer") if r.get(k)]
            out.append((None, [ask[0].strip(), answer[0]]) if ask and answer else ("unsupported_schema", []))
    return out


@pytest.mark.parametrize("splits", ["whole", "small"])
def test_a_tree_of_mixed_files(spark, tmp_path, splits, request):
    if splits == "small":
        request.getfixturevalue("small_splits")
    root = f"{tmp_path}/raw data [x]"
    tree(root)
    done = corpus.formatted_tree(spark, root, min_chars=5, max_chars=0)
    rows = done.orderBy(*corpus_source.ORDER).collect()
    got = [(r.dataset.replace("/", "__", 1), r.file_path.rsplit("/", 1)[-1], r.reject, None if r.reject not in (None, "duplicate") else r.messages[0]["content"]) for r in rows]
    assert got == plain(root)
    assert {(r.file_path.rsplit("/", 1)[-1], r.reason) for r in corpus_source.skipped(spark, root).collect()} == {("note.md", "unsupported file type"), ("bad.json", "malformed JSON")}
    excluded = spark.createDataFrame([("own/ds", "why")], "dataset string, reason string")
    assert {r.dataset for r in corpus.formatted_tree(spark, root, excluded).select("dataset").distinct().collect()} & {"own/ds"} == set()


def test_raw_text_is_not_shuffled(spark, tmp_path):
    """Between the scan of JSON lines and the records there is no exchange but the broadcast of the blocks."""
    put(f"{tmp_path}/c/o__d/a.jsonl", "\n".join(json.dumps(record(i)) for i in range(50)))
    plan = readers.jsonl(spark, f"{tmp_path}/c")._jdf.queryExecution().executedPlan().toString()
    shuffles = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    assert shuffles and "BroadcastExchange" in plan and not any("value" in line for line in shuffles)
    lines = readers.jsonl(spark, f"{tmp_path}/c")
    assert [r.line_no for r in lines.orderBy("line_no").collect()] == list(range(50))


def test_a_large_file_in_small_splits(spark, tmp_path, small_splits):
    """100,000 lines in one file: every line once, in order, whatever the splits; no task holds more than its split."""
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(1 << 19))
    lines = [json.dumps(record(i % 60_000)) for i in range(100_000)]
    put(f"{tmp_path}/cat/o__d/big.jsonl", "\n".join(lines))
    done = corpus.formatted_tree(spark, str(tmp_path), min_chars=5, max_chars=0)
    counts = {r.reject: r["count"] for r in done.groupBy("reject").count().collect()}
    assert counts == {None: 60_000, "duplicate": 40_000}
    assert done.where("reject is null").agg(F.max("line_no")).first()[0] == 59_999


# -- heads and counts --------------------------------------------------------------------------


def test_heads_read_little(spark, tmp_path):
    big = [record(i) | {"pad": "p" * 500} for i in range(20_000)]
    put(f"{tmp_path}/a b.json", json.dumps(big))
    put(f"{tmp_path}/c.jsonl", "\n\n" + "\r\n".join(map(json.dumps, big)))
    put(f"{tmp_path}/d.jsonl.gz", gzip.compress("\n".join(map(json.dumps, big)).encode(), 1))
    put(f"{tmp_path}/e.json", json.dumps({"one": "object"}))
    put(f"{tmp_path}/f.json", '{"x": 1}\n{"x": 2}\n{"x": 3}\n{"x": 4}\n')
    put(f"{tmp_path}/g.csv", 'a,b\n"1\n1",2\n3,4\n')
    put(f"{tmp_path}/h.json", " \n [1, 2.5, \"x\"]")
    put(f"{tmp_path}/i.json", "")
    pq.write_table(pa.table({"k": range(50_000)}), f"{tmp_path}/j.parquet", row_group_size=1000)
    with pa.ipc.new_file(f"{tmp_path}/k.arrow", pa.schema([("k", pa.int64()), ("s", pa.string())])) as w:
        for at in range(3):
            w.write_table(pa.table({"k": [at] * 4, "s": ["x"] * 4}))
    catalog = readers.file_catalog(spark, str(tmp_path))
    rows = heads.first_records(catalog).collect()
    got = {}
    for r in rows:
        got.setdefault(r.path.rsplit("/", 1)[-1], []).append(json.loads(r.raw))
        assert r.bytes_read < 1 << 20
    assert got == {
        "a b.json": big[:3], "c.jsonl": big[:3], "d.jsonl.gz": big[:3], "e.json": [{"one": "object"}], "f.json": [{"x": 1}, {"x": 2}, {"x": 3}],
        "g.csv": [{"a": "1\n1", "b": "2"}, {"a": "3", "b": "4"}], "h.json": [1, 2.5, "x"], "j.parquet": [{"k": 0}, {"k": 1}, {"k": 2}], "k.arrow": [{"k": 0, "s": "x"}] * 3,
    }
    limited = readers.array_or_lines(spark, str(tmp_path), limit=2).groupBy("file_path").count().collect()
    assert {r.file_path.rsplit("/", 1)[-1]: r["count"] for r in limited} == {"a b.json": 2, "c.jsonl": 2, "d.jsonl.gz": 2, "e.json": 1, "f.json": 2, "h.json": 2}
    counts = {r.file_path.rsplit("/", 1)[-1]: r.records for r in inventory.record_counts(spark, catalog, files=4).collect()}
    assert counts == {"a b.json": 20_000, "c.jsonl": 20_000, "d.jsonl.gz": 20_000, "f.json": 4, "g.csv": 3, "h.json": 3, "j.parquet": 50_000, "k.arrow": 12}
    assert catalog.join(inventory.record_counts(spark, catalog), F.col("path") == F.col("file_path")).count() == 8
    assert inventory.field_names(spark, f"{tmp_path}/a b.json") == ["pad", "prompt", "response"]


def test_counts_of_objects(spark, tmp_path):
    put(f"{tmp_path}/a.json", json.dumps({"z": 1, "m": [1, 2, 3], "a": [1]}))
    put(f"{tmp_path}/b.json", json.dumps({"z": "[1, 2]"}))
    put(f"{tmp_path}/c.json", '{"data": []}')
    counts = {r.file_path[-6:]: r.records for r in inventory.record_counts(spark, readers.file_catalog(spark, str(tmp_path))).collect()}
    assert counts == {"a.json": 3, "c.json": 0}


def test_arrays_or_lines_with_odd_names(spark, tmp_path):
    put(f"{tmp_path}/a b.json", '[{"x": 1}, {"x": 2}]')
    put(f"{tmp_path}/c[d]{{e}}.json", '{"x": 3}\n{"x": 4}')
    put(f"{tmp_path}/50%+.jsonl", '\n{"x": 5}')
    got = sorted((r.file_path.rsplit("/", 1)[-1], r.line_no, json.loads(r.raw)["x"]) for r in readers.array_or_lines(spark, str(tmp_path)).collect())
    assert got == [("50%+.jsonl", 1, 5), ("a b.json", 0, 1), ("a b.json", 1, 2), ("c[d]{e}.json", 0, 3), ("c[d]{e}.json", 1, 4)]


# -- the transactional sink --------------------------------------------------------------------


def annotated(spark, n=300):
    rows = [(i, "cat é/1" if i % 3 else "b", f"d{i % 2}", [("user", f"question {i % 250}"), ("assistant", "long enough é\n" * (i % 9))]) for i in range(n)]
    rows.append((n, "only rejects", "d9", [("user", "x")]))
    df = spark.createDataFrame(rows, "i long, category string, dataset string, messages array<struct<role:string,content:string>>")
    return validate.annotate(df.repartition(5), ["i"], ["category"], min_chars=30, max_chars=90, val_fraction=0.3)


def test_corpus_sink(spark, tmp_path):
    path, rows = str(tmp_path / "corpus [1]"), annotated(spark)
    manifest = corpus_sink.write_corpus(rows, path, ["i"], {"seed": 42, "min_chars": 30})
    want = {(r.category, r.dataset): r for r in validate.reject_counts(rows, ["category", "dataset"]).collect()}
    kept = sorted(rows.where("reject is null").collect(), key=lambda r: r.i)
    assert [c["category"] for c in manifest["categories"]] == ["b", "cat é/1", "only rejects"]
    for c in manifest["categories"]:
        assert (c["seed"], c["min_chars"]) == (42, 30)
        for d in c["per_dataset"]:
            r = want[c["category"], d["dataset"]]
            assert (d["raw"], d["accepted"], d["rejects"]) == (r.raw, r.accepted, {x: r[x] for x in validate.REJECTS})
        own = [r for r in kept if r.category == c["category"]]
        pairs = sorted((r.total_chars, r.dataset) for r in own)
        assert [(x["chars"], x["dataset"]) for x in c["longest_records"]] == pairs[::-1][:20] and [(x["chars"], x["dataset"]) for x in c["shortest_records"]] == pairs[:20]
        for split in ("train", "val"):
            lines = [json.dumps({"messages": [{"role": m.role, "content": m.content} for m in r.messages]}, ensure_ascii=False) for r in own if r.split == split]
            data = b"".join(open(f"{path}/{f['name']}", "rb").read() for f in c[f"{split}_files"])
            assert data.decode() == "".join(x + "\n" for x in lines) and c[f"{split}_lines"] == len(lines) and c[f"{split}_bytes"] == len(data)
            assert all(f["sha256"] == hashlib.sha256(open(f"{path}/{f['name']}", "rb").read()).hexdigest() for f in c[f"{split}_files"])
            found = corpus_sink.read_corpus(spark, path, c["category"], split)
            assert sorted(r.value for r in found.collect()) == sorted(lines)


def test_a_failed_write_leaves_the_old_corpus(spark, tmp_path):
    path = str(tmp_path / "c")
    corpus_sink.write_corpus(annotated(spark, 60), path, ["i"])
    before, folders = corpus_sink.read_manifest(path), set(os.listdir(path))
    late = annotated(spark).withColumn("dataset", F.when(F.col("i") == 250, F.raise_error(F.lit("killed")).cast("string")).otherwise(F.col("dataset")))
    with pytest.raises(Exception, match="killed"):
        corpus_sink.write_corpus(late, path, ["i"])
    assert corpus_sink.read_manifest(path) == before and set(os.listdir(path)) == folders
    after = corpus_sink.write_corpus(annotated(spark), path, ["i"])
    assert corpus_sink.read_manifest(path) == after != before
    (only,) = [c for c in after["categories"] if c["category"] == "only rejects"]
    assert only["train_lines"] == 0 and corpus_sink.read_corpus(spark, path, "only rejects", "train").count() == 0
    with pytest.raises(FileNotFoundError):
        corpus_sink.read_manifest(str(tmp_path / "none"))
