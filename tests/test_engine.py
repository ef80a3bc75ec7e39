"""Behaviour of the engine on small made-up rows."""

import gzip
import json
import os

import pytest
from pyspark.sql import functions as F

from chatloom.functions import text as T
from chatloom.operators import adapters, dedup, inventory, joins, mix, template, validate, windows
from chatloom.plans import corpus, recipes
from chatloom.sources import config, readers, sinks
from chatloom.sources.arrow_ipc import ArrowIpc

MESSAGES = "array<struct<role:string,content:string>>"


def one(spark, column, **values):
    schema = ", ".join(f"{k} string" for k in values) or "x int"
    return spark.createDataFrame([tuple(values.values()) or (1,)], schema).select(column.alias("v")).first()["v"]


def adapted(spark, *records):
    rows = spark.createDataFrame([(i, r if isinstance(r, str) else json.dumps(r)) for i, r in enumerate(records)], "line_no int, raw string")
    messages, reject = adapters.adapted(F.col("raw"))
    return [(r.m, r.r) for r in rows.select("line_no", messages.alias("m"), reject.alias("r")).orderBy("line_no").collect()]


def said(messages):
    return None if messages is None else [(m["role"], m["content"]) for m in messages]


@pytest.mark.parametrize("given, wanted", [(None, ""), ("a\r\nb\rc", "a\nb\nc"), ("a\n\n\n\nb", "a\n\nb"), ("  x  ", "x"), ("\x1fx\t\n", "x"), ("", "")])
def test_normalize(spark, given, wanted):
    assert one(spark, T.normalize(F.col("x")), x=given) == wanted


def test_normalize_list(spark):
    df = spark.createDataFrame([(["x", None, "y"],)], "x array<string>")
    assert df.select(T.normalize_list(F.col("x"))).first()[0] == "x\n\ny"


@pytest.mark.parametrize("given, wanted", [(" Human ", "user"), ("GPT", "assistant"), ("bot", "assistant"), ("tool", "tool"), ("narrator", ""), (None, "")])
def test_role(spark, given, wanted):
    assert one(spark, T.role(F.col("x")), x=given) == wanted


def test_adapters(spark):
    chat = [{"role": "user", "content": "hi"}, {"from": "gpt", "value": "yo"}, {"role": "assistant", "content": [{"type": "text", "text": "a"}, "b", {"image": 1}]}]
    cases = [
        ({"messages": chat}, [("user", "hi"), ("assistant", "yo"), ("assistant", "a\nb")]),
        ({"content": "text only", "conversations": [{"from": "human", "value": " q "}, {"from": "gpt", "value": "a"}]}, [("user", "q"), ("assistant", "a")]),
        ({"messages": [{"role": "narrator", "content": "x"}]}, []),
        ({"messages": []}, []),
        (["id", {"content": [{"message": "a", "agent": "x"}, {"message": "b", "agent": "y"}]}], [("user", "a"), ("assistant", "b")]),
        ({"vars": {"question": "q", "answer": "a"}}, [("user", "q"), ("assistant", "a")]),
        ({"goal": "g", "step_instructions": ["one", " ", "three"]}, [("user", "g"), ("assistant", "1. one\n3. three")]),
        ({"instruction": "", "question": "q", "output": 0, "answer": "a"}, [("user", "q"), ("assistant", "a")]),
        ({"instruction": "do", "input": "this", "output": "done"}, [("user", "do\n\nthis"), ("assistant", "done")]),
        ({"input": "only", "output": "done"}, [("user", "only"), ("assistant", "done")]),
    ]
    for (given, wanted), (got, reject) in zip(cases, adapted(spark, *(c[0] for c in cases))):
        assert said(got) == wanted and reject is None, given
    assert [r for _, r in adapted(spark, {"foo": "bar"}, "{not json}", '"text"', {"__malformed__": "x"})] == ["unsupported_schema", "malformed_json", "unsupported_schema", "malformed_json"]


def test_reject_taxonomy(spark):
    long = "x" * 60
    records = [
        {"messages": [{"role": "user", "content": "hi"}, {"role": "assistant", "content": "ok"}]},
        {"foo": "bar"},
        {"messages": [{"role": "user", "content": long}]},
        {"messages": []},
        "{not json}",
        {"messages": [{"role": "narrator", "content": long}]},
        {"messages": [{"role": "user", "content": long * 10}, {"role": "assistant", "content": long}]},
        {"prompt": "q" * 40, "response": "a" * 40},
        {"prompt": "q" * 40, "response": "a" * 40},
        {"prompt": "q" * 40, "response": "a" * 40},
    ]
    raw = spark.createDataFrame([("d", "f", i, r if isinstance(r, str) else json.dumps(r)) for i, r in enumerate(records)], "dataset string, file_path string, line_no long, raw string")
    done = corpus.formatted(raw, ["file_path", "line_no"], min_chars=50, max_chars=600)
    assert [r.reject for r in done.orderBy("line_no").collect()] == ["too_short", "unsupported_schema", "missing_field", "empty", "malformed_json", "empty", "too_long", None, "duplicate", "duplicate"]
    counts = validate.reject_counts(done, ["dataset"]).first()
    assert counts.raw == counts.accepted + sum(counts[r] for r in validate.REJECTS)
    assert counts.accepted == 1 and counts.duplicate == 2


def test_unknown_role_in_canonical_messages(spark):
    df = spark.createDataFrame([(1, [("robot", "hi")]), (2, None)], f"id int, messages {MESSAGES}")
    assert [r.reject for r in validate.annotate(df, ["id"]).orderBy("id").collect()] == ["unsupported_schema", "empty"]


def test_split_is_stable_and_dedup_idempotent(spark):
    rows = spark.range(200).select("id", T.record(None, F.concat(F.lit("question "), "id"), F.lit("a fixed answer of some length")).alias("messages"))
    a = {r.id: r.split for r in validate.annotate(rows, ["id"], val_fraction=0.05).collect()}
    b = {r.id: r.split for r in validate.annotate(rows.repartition(7).orderBy(F.rand(1)), ["id"], val_fraction=0.05).collect()}
    assert a == b and set(a.values()) == {"train", "val"}
    twice = rows.union(rows.withColumn("id", F.col("id") + 1000))
    kept = validate.annotate(twice, ["id"]).where("reject is null")
    assert kept.count() == 200 and kept.agg(F.max("id")).first()[0] == 199
    assert validate.annotate(kept.select("id", "messages"), ["id"]).where("reject is null").count() == 200


def test_prefix_is_not_the_key(spark):
    rows = spark.range(50).select("id", T.record(None, F.lit("q" * 300), F.concat(F.lit("a" * 300), "id")).alias("messages"))
    assert validate.annotate(rows, ["id"]).where("is_dup").count() == 0


def test_strict_key_is_blake2b(spark):
    import hashlib

    df = spark.createDataFrame([([("user", "hä"), ("assistant", "ok")],)], f"messages {MESSAGES}")
    payload = json.dumps({"seed": 42, "messages": [{"role": "user", "content": "hä"}, {"role": "assistant", "content": "ok"}]}, ensure_ascii=False, sort_keys=True)
    assert corpus.strict_keys(df).first().strict_key == hashlib.blake2b(payload.encode(), digest_size=16).hexdigest()
    assert corpus.canonical_json(df).first().line == json.dumps({"messages": [{"role": "user", "content": "hä"}, {"role": "assistant", "content": "ok"}]}, ensure_ascii=False)


@pytest.mark.parametrize(
    "sizes, wholes, extras, final",
    [((435_000, 100_000), (4, 1), (35_000, 0), 535_000), ((243_000, 190_000, 100_000), (2, 1, 1), (43_000, 90_000, 0), 533_000), ((5000, 5000, 5000), (1, 1, 1), (0, 0, 0), 15_000), ((1000, 435), (2, 1), (130, 0), 1435)],
)
def test_mix_plan(spark, sizes, wholes, extras, final):
    plan = mix.mix_plan(spark.createDataFrame([(f"d{i}", n) for i, n in enumerate(sizes)], "dataset string, n long"))
    rows = plan.orderBy("rank").collect()
    assert tuple(r.whole for r in rows) == wholes and tuple(r.extra for r in rows) == extras
    assert rows[0].final_total == final


def test_mix_uses_every_row_once_and_depends_on_the_seed(spark):
    rows = spark.range(1435).select("id", F.when(F.col("id") < 1000, "a").otherwise("b").alias("dataset"))
    plan = mix.mix_plan(rows.groupBy("dataset").agg(F.count("*").alias("n")))
    order = lambda seed: [r.id for r in mix.mixed(rows, plan, "dataset", ["id"], seed).orderBy("mix_key").collect()]
    a = order(1)
    assert a == order(1) and a != order(2) and sorted(a) == list(range(1435))
    assert mix.conservation(mix.mixed(rows, plan, "dataset", ["id"]), plan, ["id"]).first().ok
    head = a[:1305]
    assert sum(i < 1000 for i in head) == 870 and all(300 > sum(i < 1000 for i in head[k : k + 300]) > 150 for k in (0, 300, 600, 900))


@pytest.mark.parametrize("sizes", [[], [("a", 1), ("a", 2)], [("a", 0), ("b", 2)]])
def test_mix_plan_errors(spark, sizes):
    with pytest.raises(ValueError):
        mix.check_plan(mix.mix_plan(spark.createDataFrame(sizes, "dataset string, n long")))


def test_gates_and_plan(spark):
    assert one(spark, F.array_join(validate.hub_gate(F.lit(5), F.lit(""), F.lit(False), F.lit(0), 10), ",")) == "low_downloads,no_license,no_readme,no_data_files"
    assert one(spark, F.size(validate.hub_gate(F.lit(50), F.lit("mit"), F.lit(True), F.lit(1), 10))) == 0
    assert [one(spark, validate.oversized(F.lit(x).cast("long"), 500, bypass)) for x, bypass in ((499, False), (501, False), (2048, True), (None, False))] == [False, True, False, False]
    rows = [("policy", "ok", False, 200, 200, False), (None, "ok", False, None, 50, False), (None, "ok", False, 5000, 1, False), (None, "ok", True, 200, 200, False), (None, "ok", False, 200, None, False), (None, "ok", False, None, None, False), (None, "ok", False, 200, 200, True)]
    df = spark.createDataFrame(rows, "skip_reason string, status string, gated boolean, api_bytes long, declared_bytes long, on_disk boolean")
    got = [r.p for r in df.select(validate.download_action({c: F.col(c) for c in df.columns}, 100, 1000).alias("p")).collect()]
    assert [p.action for p in got] == ["skip", "skip", "skip", "skip", "download", "download", "skip"]
    assert one(spark, validate.reason_group(F.lit("too_large (5000)"))) == "too_large"
    assert one(spark, validate.license_family(F.lit("Apache-2.0 with notes"))) == "apache-2.0"
    assert [one(spark, validate.schema_family(F.array(*map(F.lit, k)))) for k in (["messages"], ["tools"], ["prompt", "response"], ["text"], ["code"], ["text", "label"], ["prompt"], ["zzz"])] == ["chat", "tool_calls", "instruction_response", "text_only", "code_only", "classification", "instruction_response", "unknown"]


def test_joins(spark):
    parents = spark.createDataFrame([(1, None, "old", 0), (1, None, "new", 1), (2, 1, "reply", 2), (3, 1, "new", 3), (4, 9, "lost", 4), (5, 1, " ", 5)], "id int, parent int, body string, ord int")
    got = recipes.replies(parents, "id", "parent", "body", ["ord"], keep=["id"]).collect()
    assert [(r.id, said(r.messages)) for r in got] == [(2, [("user", "new"), ("assistant", "reply")])]
    experts = joins.by_expert(spark.createDataFrame([("a",), ("b",)], "category string"), "category", {"x": ["a"], "y": ["a", "b"], "all": ["*"]})
    assert sorted((r.expert, r.category) for r in experts.collect()) == [("all", "a"), ("all", "b"), ("x", "a"), ("y", "a"), ("y", "b")]
    new = dedup.new_only(spark.range(5).select(F.col("id").cast("string").alias("k")), spark.createDataFrame([("1",), ("3",)], "k string"), "k")
    assert sorted(r.k for r in new.collect()) == ["0", "2", "4"]


def test_windows(spark):
    rows = spark.range(100).select("id", F.lit(10).alias("size"))
    assert windows.byte_budget(rows, 95, ["id"], F.col("size")).count() == 10
    lines = spark.createDataFrame([("f", 0, "## A"), ("f", 1, "x"), ("f", 2, "## B"), ("f", 3, "y")], "file string, n int, text string")
    heading = F.nullif(F.regexp_extract("text", "^## (.+)$", 1), F.lit(""))
    assert [r.section for r in windows.carried(lines, heading, "section", ["file"], ["n"]).orderBy("n").collect()] == ["A", "A", "B", "B"]


@pytest.mark.parametrize("partitions", [1, 7, 40])
def test_carried_in_two_levels(spark, partitions):
    rows = [("f", i, f"## {i}" if i % 37 == 5 else "x") for i in range(400)] + [("g", 0, "y"), (None, 1, "## z"), (None, 2, "y")]
    df = spark.createDataFrame(rows, "file string, n int, text string").repartition(partitions)
    heading = F.nullif(F.regexp_extract("text", "^## (.+)$", 1), F.lit(""))
    got = {(r.file, r.n): r.section for r in windows.carried(df, heading, "section", ["file"], ["n"]).collect()}
    want, last = {}, {}
    for file, n, text in rows:
        last[file] = text[3:] if text.startswith("## ") else last.get(file)
        want[file, n] = last[file]
    assert got == want


def test_a_small_budget_reads_little(spark, tmp_path):
    """Of 20,000 rows a budget of 1 % measures a few percent, each up to four times (its slice, the bounds of the range
    partitions, these themselves), and takes the rows that a whole sort would."""
    spark.range(20_000).select("id", F.concat(F.lit("t"), F.col("id")).alias("t")).write.parquet(str(tmp_path / "r"))
    measured = spark.sparkContext.accumulator(0)

    @F.udf("long")
    def size(t):
        measured.add(1)
        return len(t)

    rows = spark.read.parquet(str(tmp_path / "r"))
    got = [r.id for r in windows.byte_budget(rows, 1000, ["id"], size(F.col("t"))).orderBy("id").collect()]
    total = 0
    want = []
    for i in range(20_000):
        if total >= 1000:
            break
        want.append(i)
        total += len(f"t{i}")
    assert got == want and measured.value < 3000
    for budget in (0, 1, 10**9):
        assert windows.byte_budget(rows, budget, ["id"], F.length("t")).count() == {0: 0, 1: 1, 10**9: 20_000}[budget]
    odd = spark.createDataFrame([(None, 5), (None, 5), ("b", 5), ("a", 5)], "k string, n int")
    assert sorted(str(r.k) for r in windows.byte_budget(odd, 12, ["k"], F.col("n")).collect()) == ["None", "None", "a"]
    assert windows.byte_budget(odd.where("false"), 12, ["k"], F.col("n")).count() == 0


def test_ordered_digest(spark):
    import hashlib

    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    rows = [("a", i, f"line {i}") for i in range(30)] + [("b", 0, "x"), (None, 0, "y")]
    make = lambda r, n: spark.createDataFrame(r, "g string, i int, t string").repartition(n)
    digest = lambda r, n, **kw: {x.g: (x.n_lines, x.digest) for x in windows.ordered_digest(make(r, n), F.col("t"), ["g"], ["i"], 4, **kw).collect()}
    level = [sha(t) for _, _, t in rows[:30]]
    for _ in range(3):
        level = [sha("".join(level[k : k + 4])) for k in range(0, len(level), 4)]
    got = digest(rows, 1)
    assert got["a"] == (30, level[0]) and got["b"] == (1, sha(sha(sha(sha("x"))))) and set(got) == {"a", "b", None}
    assert digest(rows, 9) == got
    swapped = [*rows[:3], ("a", 3, "line 4"), ("a", 4, "line 3"), *rows[5:]]
    assert digest(swapped, 2)["a"] != got["a"] and digest(swapped, 2)["b"] == got["b"] and digest([], 1) == {}
    with pytest.raises(Exception, match="more lines"):
        digest(rows, 1, levels=2)


def test_ordered_digest_with_an_open_top(spark):
    import hashlib

    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    rows = [("a", i, f"line {i}") for i in range(70)] + [("b", 0, "x")]
    df = spark.createDataFrame(rows, "g string, i int, t string").repartition(5)
    digest = lambda levels: {x.g: (x.n_lines, x.digest) for x in windows.ordered_digest(df, F.col("t"), ["g"], ["i"], 4, levels, open_top=True).collect()}
    lines = [sha(t) for _, _, t in rows[:70]]
    fours = [sha("".join(lines[k : k + 4])) for k in range(0, 70, 4)]
    sixteens = [sha("".join(fours[k : k + 4])) for k in range(0, len(fours), 4)]
    assert len(sixteens) == 5  # more than a run holds
    assert digest(3) == {"a": (70, sha("".join(sixteens))), "b": (1, sha(sha(sha(sha("x")))))}
    assert digest(2)["a"] == (70, sha("".join(fours))) and digest(1)["a"] == (70, sha("".join(lines)))
    assert digest(4)["a"] == (70, sha(sha("".join(sixteens[:4])) + sha(sixteens[4])))


def test_walk_does_not_enter_skipped_directories(spark, tmp_path):
    from chatloom.sources import heads

    for name in ("a/b c/x.txt", "a/.hidden", "a/.git/objects/y", "z [1]/w", ".git/q", "top"):
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_text(name)
    found = {r.path.removeprefix(f"{tmp_path}/"): r["size"] for r in heads.walk(spark, str(tmp_path)).collect()}
    assert found == {n: len(n) for n in ("a/b c/x.txt", "a/.hidden", "z [1]/w", "top")}
    assert heads.walk(spark, str(tmp_path / "none")).count() == 0


def test_template_and_tokens(spark):
    df = spark.createDataFrame([([("user", "hi"), ("assistant", "yo"), ("user", "again"), ("assistant", "fine")],)], f"messages {MESSAGES}")
    text = df.select(template.render(F.col("messages"))).first()[0]
    assert text.count("<|im_start|>") == 4 and text.count("<think>") == 1 and text.index("<think>") > text.index("again")
    tokens = template.tokenize_chat(df, template.whitespace_tokenizer, 8192)
    r = tokens.first()
    learned = "".join(chr(t) for t in r.labels if t != template.IGNORED)
    assert learned == "yo<|im_end|>fine<|im_end|>" and r.assistant_tokens == len(learned) and len(r.input_ids) == r.full_length == len(text)
    assert template.drop_all_masked(template.tokenize_chat(df, template.whitespace_tokenizer, 5)).count() == 0
    assert template.truncation_stats(tokens.withColumn("c", F.lit(1)), ["c"], 10).first().truncated == 1.0


def by_prefixes(tokenizer, turns, learn):
    """ids and mask by the longest common prefix of encodings with and without a turn: quadratic, and plain."""

    def common(a, b):
        return next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))

    text, spans = "", []
    last = max((i for i, m in enumerate(turns) if m[0] == "user"), default=-1)
    for i, (who, said) in enumerate(turns):
        begin = text + f"{template.START}{who}\n" + (template.THINK if who == "assistant" and i > last else "")
        text = begin + said + template.END + "\n"
        if who == "assistant":
            spans.append((begin, begin + said + template.END))
    ids = tokenizer(text)
    mask = [False] * len(ids)
    for begin, end in spans if learn == "all" else [(b, text) for b, _ in spans[-1:]]:
        for k in range(common(ids, tokenizer(begin)), common(ids, tokenizer(end))):
            mask[k] = True
    return ids, mask


@pytest.mark.parametrize("learn", ["all", "last"])
@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json", None])
def test_span_masks_by_offsets(spark, name, learn):
    """Equal to the longest-prefix masks for real tokenizers, on the driver's conversations and on odd ones."""
    import os

    tokenizer = template.FileTokenizer(os.path.join("/opt/tokenizers", name)) if name else template.whitespace_tokenizer
    odd = [[("user", "a")], [("assistant", "b")], [], [("system", "s"), ("user", "é漢👍"), ("assistant", " two\n\nlines "), ("user", ""), ("assistant", "")], [("assistant", "x"), ("user", "y")], [("user", "q"), ("assistant", "z" * 3000)]]
    rows = spark.createDataFrame([(i, m, "x") for i, m in enumerate(odd)], f"conv_id long, messages {MESSAGES}, parts string")
    real = corpus.conversations(spark.read.parquet("/root/testdata/sf0.001/conversations.parquet")).withColumn("parts", F.lit("x")).withColumn("conv_id", F.col("conv_id") + 100)
    got = template.tokenize_chat(rows.unionByName(real).repartition(3), tokenizer, 2000, learn=learn)
    assert got.columns[:3] == ["conv_id", "messages", "parts"]
    for r in got.collect():
        ids, mask = by_prefixes(tokenizer, [(m.role, m.content) for m in r.messages], learn)
        assert r.full_length == len(ids) and r.input_ids == ids[:2000] and r.attention_mask == [1] * len(ids[:2000])
        learned = [t != template.IGNORED for t in r.labels]
        assert r.assistant_tokens == sum(learned) and all(t == i for t, i, k in zip(r.labels, ids, learned) if k)
        if name == "byte_bpe_50k.json":
            # it encodes line feeds at the end of a text in another way than before a word, so the prefixes without a
            # turn part with the template's last line feeds, which are no part of the turn
            assert all(k or not m or ids[i] in (198, 628) for i, (k, m) in enumerate(zip(learned, mask))) and all(m for k, m in zip(learned, mask) if k), r.conv_id
        else:
            assert learned == mask[:2000], r.conv_id


def test_round_trip_of_what_is_learned(spark):
    """The text under the mask, decoded, is what the assistant said, with its end markers."""
    from tokenizers import Tokenizer

    path = "/opt/tokenizers/byte_bpe_50k.json"
    conv = corpus.conversations(spark.read.parquet("/root/testdata/sf0.001/conversations.parquet"))
    plain = Tokenizer.from_file(path)
    for r in template.tokenize_chat(conv, template.FileTokenizer(path), 1 << 30).collect():
        learned = plain.decode([t for t in r.labels if t != template.IGNORED])
        assert learned == "".join(m.content + template.END for m in r.messages if m.role == "assistant")


def test_recipes(spark):
    vuln = spark.createDataFrame([("abc", "net", None, "overflow", "r1")], "introducing_commit string, subsystem string, subsystem_path string, bug_type string, related_fixes string")
    got = [said(r.messages) for r in recipes.vulnerabilities(vuln).collect()]
    assert got[0][0][1] == "Why is commit abc in net (net) considered vulnerable?" and got[0][1][1].endswith("before being fixed, and it is related to r1.")
    assert got[1][0][1] == "How was the overflow in net fixed?"
    raw = lambda *records: spark.createDataFrame([(json.dumps(r),) for r in records], "raw string")
    assert recipes.commits(raw({"fixing_commit": "f"}, {"subject": "s", "body": "b"}, {"subject": "s"}, {"z": 1})).count() == 4
    got = [said(r.messages) for r in recipes.crashes(raw({"crash_report": "boom", "final_patch_diff": "d", "title": "t"}, {"bug": "b", "fix": "f"}, {"z": 1})).collect()]
    assert got[0][0][1].startswith("How do you fix this kernel crash?\n\nt\n(subsystem: unknown subsystem)") and got[1][1][1] == "f" and json.loads(got[2][1][1]) == {"z": 1}
    sessions = raw({"messages": json.dumps([{"role": "USER", "content": "a"}, {"role": "narrator", "content": "b"}, {"role": "assistant", "content": "c"}])}, {"original_python_code": "code", "entry_point": "e", "module_name": "m"}, {"x": 1})
    assert [said(r.messages) for r in recipes.agent_sessions(sessions).collect()] == [[("user", "a"), ("assistant", "c")], [("system", "You are a GPU kernel optimization expert."), ("user", "Optimize this kernel: e (module m)"), ("assistant", "code")]]
    odd = spark.createDataFrame([("q", "a", "b"), (None, "both", "b")], "`The question` string, `Answer of question` string, `answer` string")
    assert [said(r.messages) for r in recipes.fuzzy_questions(odd).collect()] == [[("user", "q"), ("assistant", "a")], [("user", "both"), ("assistant", "b")]]
    assert recipes.nothing(odd).count() == 0
    fixes = spark.createDataFrame([("c", "f", "CWE-1")], "code string, code_fixed string, cwe_id string")
    labels = spark.createDataFrame([("c", "xss"), ("c", "")], "code string, label string")
    assert recipes.security_union(fixes, labels, raw({"messages": [{"role": "user", "content": "q"}]}), "s").count() == 3
    files = spark.createDataFrame([("p.py", " x ")], "path string, body string")
    assert recipes.snippets(files, F.lit("python")).first().source_path == "p.py"


def test_sources(spark, tmp_path):
    base = tmp_path / "data" / "cat" / "owner__name"
    base.mkdir(parents=True)
    (base / "a.jsonl").write_text("".join(f'{{"n": {i}}}\n\n' for i in range(3000)))
    with gzip.open(base / "b.jsonl.gz", "wt") as f:
        f.write('{"n": 1}\n{bad\n')
    (base / "c.json").write_text('[{"x": 1}, {"x": 2}]')
    (base / "d.json").write_text("{broken")
    (base / "e.csv").write_text('q,a\n"line\nbreak",2\n')
    (base / "f.bin").write_text("x")
    (base / ".cache").mkdir()
    (base / ".cache" / "g.jsonl").write_text("{}")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8k")
    lines = readers.jsonl(spark, str(base / "a.jsonl"))
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert [json.loads(r.raw)["n"] * 2 == r.line_no for r in lines.orderBy("line_no").collect()] == [True] * 3000
    assert readers.jsonl(spark, str(base / "b.jsonl.gz")).count() == 2 and readers.tolerant(readers.jsonl(spark, str(base / "b.jsonl.gz"))).count() == 1
    assert readers.whole_json(spark, [str(base / "c.json"), str(base / "d.json")]).count() == 3
    assert readers.array_or_lines(spark, str(base / "c.json")).count() == 2
    assert readers.csv(spark, str(base / "e.csv")).first().q == "line\nbreak"
    catalog = readers.file_catalog(spark, str(tmp_path / "data"), readers.DATA_SUFFIXES)
    assert catalog.count() == 5
    assert readers.skipped_files(readers.file_catalog(spark, str(tmp_path / "data"))).count() == 1
    tags = readers.tagged(readers.jsonl(spark, str(base / "a.jsonl")), str(tmp_path / "data")).first()
    assert (tags.category, tags.dataset) == ("cat", "owner/name")
    (tmp_path / "list.md").write_text("# t\n## chat\n- a/b - 1.5 GB, x\n- c/d\n## code\n- a/b — 2 MB\n")
    got = {r.id: (r.category, r.declared_bytes) for r in readers.source_list(readers.text_lines(spark, str(tmp_path / "list.md"))).collect()}
    assert got == {"a/b": ("chat", int(1.5 * 2**30)), "c/d": ("chat", None)}
    (tmp_path / "ids.txt").write_text("category: one\na/b # note\na/b\n## two\nc/d\n")
    assert [(r.id, r.category) for r in readers.id_list(readers.text_lines(spark, str(tmp_path / "ids.txt"))).orderBy("line_no").collect()] == [("a/b", "one"), ("a/b", "one"), ("c/d", "two")]
    (tmp_path / "log.txt").write_text("OK a/b 10 s\nFAIL c/d\nOK a/b 12\n")
    assert [(r.id, r.bytes) for r in readers.run_log(readers.text_lines(spark, str(tmp_path / "log.txt"))).collect()] == [("a/b", 12)]


def test_arrow_source(spark, tmp_path):
    import pyarrow as pa

    t = pa.table({"a": [1, 2, 3], "b": ["x", "y", None]})
    with pa.OSFile(str(tmp_path / "f.arrow"), "wb") as f, pa.ipc.new_file(f, t.schema) as w:
        w.write_table(t)
    with pa.OSFile(str(tmp_path / "s.arrow"), "wb") as f, pa.ipc.new_stream(f, t.schema) as w:
        w.write_table(t)
    spark.dataSource.register(ArrowIpc)
    df = spark.read.format("arrow_ipc").load(str(tmp_path))
    assert df.count() == 6 and df.where("b is null").count() == 2
    assert spark.read.format("arrow_ipc").load(f"file://{tmp_path}").count() == spark.read.format("arrow_ipc").load(f"file:{tmp_path}").count() == 6
    assert spark.read.format("arrow_ipc").load(str(tmp_path / "s.arrow")).count() == 3 == spark.read.format("arrow_ipc").load(str(tmp_path / "s*.arrow")).count()


def test_sinks(spark, tmp_path):
    rows = spark.range(20).select("id", F.lit("c").alias("category"), T.record(None, F.concat(F.lit("question "), "id"), F.lit("a fixed answer of some length")).alias("messages"))
    done = validate.annotate(rows, ["id"], val_fraction=0.3)
    sinks.corpus_jsonl(done, str(tmp_path / "out"))
    back = spark.read.text(str(tmp_path / "out"))
    assert back.count() == 20 and set(r.split for r in back.select("split").distinct().collect()) == {"train", "val"}
    assert json.loads(back.first().value)["messages"][0]["role"] == "user"
    old = spark.createDataFrame([("a", 1), ("b", 2)], "category string, n int")
    new = spark.createDataFrame([("b", 3)], "category string, n int")
    assert sorted((r.category, r.n) for r in sinks.upserted_report(old, new).collect()) == [("a", 1), ("b", 3)]
    assert "| a | 1 |" in sinks.markdown_table(old)
    assert one(spark, sinks.card(F.lit("t"), F.lit("mit"), F.lit(20_000), F.lit(2048), F.lit("b"))).startswith("---\nlicense: mit\nsize_categories:\n- 10K<n<100K")


def test_config(tmp_path):
    (tmp_path / "c.md").write_text("# C\n## S\nname: 'x' # note\nn: 3\nflag: yes\nempty: []\nlist:\n- a\n- `b`\nother:\n- c\npath: sub/dir\n")
    c = config.Config.load(str(tmp_path / "c.md"))
    assert (c.text("name"), c.number("n", kind=int), c.flag("flag"), c.items("empty"), c.items("list"), c.items("other")) == ("x", 3, True, [], ["a", "b"], ["c"])
    assert c.path("path") == tmp_path / "sub/dir" and c.text("missing", "d") == "d"
    for bad in (lambda: c.text("missing"), lambda: c.number("name"), lambda: c.flag("name"), lambda: c.text("list"), lambda: config.Config.load(str(tmp_path / "no.md"))):
        with pytest.raises(config.ConfigError):
            bad()


def test_stream_equals_batch(spark, tmp_path):
    from chatloom.streaming.incremental import format_stream

    source, out = tmp_path / "in", tmp_path / "out"
    source.mkdir()
    record = lambda i: json.dumps({"prompt": f"question number {i} of some length", "response": "an answer of some length"}) + "\n"
    (source / "a.jsonl").write_text("".join(record(i % 7) for i in range(20)) + "{bad\n")
    format_stream(spark, str(source), str(out), str(tmp_path / "cp")).awaitTermination(120)
    (source / "b.jsonl").write_text("".join(record(i) for i in range(12)))
    format_stream(spark, str(source), str(out), str(tmp_path / "cp")).awaitTermination(120)
    kept = spark.read.parquet(f"{out}/records")
    assert kept.count() == 12 and kept.select("dedup_key").distinct().count() == 12


def test_stream_state_does_not_read_its_history(spark, tmp_path):
    """Twenty micro-batches: each looks up its own keys, and the counters come with the progress."""
    import os

    from chatloom.streaming.incremental import format_stream

    source, out = tmp_path / "in [x]", tmp_path / "out"
    source.mkdir()
    record = lambda i: json.dumps({"prompt": f"question number {i} of some length", "response": "an answer of some length"}) + "\n"
    for k in range(20):  # five new keys, five of the file before, one bad line
        (source / f"{k:02}.jsonl").write_text("".join(record(i) for i in range(5 * k, 5 * k + 10)) + "{bad\n\n")
        os.utime(source / f"{k:02}.jsonl", (1_700_000_000 + k, 1_700_000_000 + k))  # the order in which files are taken
    before = spark.conf.get("spark.sql.streaming.stateStore.providerClass", None)
    query = format_stream(spark, str(source), str(out), str(tmp_path / "cp"), max_files=1)
    query.awaitTermination(300)
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass", None) == before
    steps = [p for p in query.recentProgress if p["numInputRows"]]
    assert [p["stateOperators"][0]["numRowsUpdated"] for p in steps] == [10] + [5] * 19
    assert [p["observedMetrics"]["kept"]["accepted"] for p in steps] == [10] + [5] * 19
    assert all((p["observedMetrics"]["read"]["raw"], p["observedMetrics"]["read"]["malformed_json"]) == (11, 1) for p in steps)
    # nothing but the batch's own file is read
    assert all(len(p["sources"]) == 1 and p["numInputRows"] == 12 for p in steps)
    kept = spark.read.parquet(f"{out}/records")
    assert kept.count() == 105 and kept.select("dedup_key").distinct().count() == 105
    batch = corpus.formatted(readers.jsonl(spark, str(source).replace("[", "\\[").replace("]", "\\]")).withColumn("dataset", F.lit("d")), ["file_path", "line_no"])
    assert {r.dedup_key for r in batch.where("reject is null").collect()} == {r.dedup_key for r in kept.collect()}
    # a repeated batch overwrites itself
    format_stream(spark, str(source), str(out), str(tmp_path / "cp"), max_files=1).awaitTermination(120)
    assert spark.read.parquet(f"{out}/records").count() == 105


def test_counts_come_with_the_job(spark):
    from pyspark.sql import Observation

    rows = raw_rows(spark)
    done = corpus.formatted(rows, ["file_path", "line_no"])
    seen = Observation("counts")
    reasons = [F.count_if(F.col("reject") == r).alias(r) for r in validate.REJECTS]
    done.observe(seen, F.count(F.lit(1)).alias("raw"), F.count_if(F.col("reject").isNull()).alias("accepted"), *reasons).write.format("noop").mode("overwrite").save()
    want = validate.reject_counts(done, []).first().asDict()
    assert seen.get == {k: want[k] for k in seen.get} and seen.get["duplicate"] == 20


def test_inventory(spark, tmp_path):
    from chatloom.operators import inventory

    (tmp_path / "d").mkdir()
    (tmp_path / "d" / "a.jsonl").write_text('{"b": 1, "a": 2}\n{"b": 2}\n')
    (tmp_path / "d" / "b.json").write_text('[{"x": 1}]')
    (tmp_path / "d" / "c.csv").write_text("q\n1\n2\n3\n")
    (tmp_path / "d" / "d.bin").write_text("xxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxx")
    catalog = readers.file_catalog(spark, str(tmp_path / "d"))
    counts = {r.file_path.rsplit("/", 1)[-1]: r.records for r in inventory.record_counts(spark, catalog).collect()}
    assert counts == {"a.jsonl": 2, "b.json": 1, "c.csv": 3} and inventory.has_files(catalog)
    assert inventory.field_names(spark, str(tmp_path / "d" / "a.jsonl")) == ["a", "b"]
    assert inventory.format_histogram(catalog, F.lit("x")).first().formats[".bin"] == 1
    small, large = inventory.pruned(catalog, 40)
    assert (small.count(), large.count()) == (3, 1)
    assert inventory.directory_sizes(catalog, F.lit("d")).first().files == 4
    (tmp_path / "cache.json").write_text('[{"id": "a/b", "stars": 5, "reasons": []}, {"id": "c/d", "stars": 1, "reasons": ["low_stars"]}]')
    plan = spark.createDataFrame([("a/b",), ("c/d",)], "id string")
    got = {r.id: (r.meta_source, r.stars) for r in inventory.with_cached(plan, inventory.metadata_cache(spark, str(tmp_path / "cache.json")), "id", ["stars"]).collect()}
    assert got == {"a/b": ("cache", 5), "c/d": ("lookup", None)}
    assert "updated" in inventory.status({"ok": 1}, str(tmp_path / "s.json")) and "## sizes" in inventory.report("t", {"sizes": inventory.directory_sizes(catalog, F.lit("d"))})


def fake_search(query):
    return [{"id": f"{query}/{k}", "downloads": 10 * k, "license": "mit", "has_readme": True, "data_files": k} for k in range(3)]


def test_hub_source(spark):
    import os

    from chatloom.sources.hub import HubMetadata

    spark.sparkContext.environment["PYTHONPATH"] = os.path.dirname(os.path.dirname(os.path.abspath(__file__))) + "/tests"
    spark.dataSource.register(HubMetadata)
    rows = spark.read.format("hub_metadata").option("client", "test_engine:fake_search").option("queries", "a, b").load()
    gate = validate.hub_gate(F.col("downloads"), F.col("license"), F.col("has_readme"), F.col("data_files"), 10)
    assert rows.count() == 6 and rows.where(F.size(gate) == 0).count() == 4
    with pytest.raises(Exception, match="name a client"):
        spark.read.format("hub_metadata").load().count()


def raw_rows(spark, n=60, partitions=5):
    rows = [(json.dumps({"prompt": f"question {i % 40} of the corpus", "response": "an answer that is long enough é\x0b"}), f"f{i % 3}", i, "cat", "big" if i % 4 else "small") for i in range(n)]
    return spark.createDataFrame([*rows, ('{"prompt": "first", "prompt": "the last of two prompts", "response": "an answer of some length"}', "g", 0, "cat", "big"), ("{cut", "g", 1, "cat", "big")], "raw string, file_path string, line_no long, category string, dataset string").repartition(partitions)


def test_repeated_keys_take_the_last(spark):
    spark.conf.set("spark.sql.variant.allowDuplicateKeys", "false")
    done = corpus.formatted(raw_rows(spark), ["file_path", "line_no"]).where("file_path = 'g'")
    assert {r.line_no: (r.reject, r.messages[0].content if r.messages else None) for r in done.collect()} == {0: (None, "the last of two prompts"), 1: ("malformed_json", None)}


def test_sink_writes_the_same_bytes_in_every_run(spark, tmp_path):
    written = []
    for k in (1, 3, 11):
        spark.conf.set("spark.sql.shuffle.partitions", str(k))
        done = corpus.formatted(raw_rows(spark, partitions=k), ["file_path", "line_no"], val_fraction=0.3)
        sinks.corpus_jsonl(done, str(tmp_path / str(k)), order=("file_path", "line_no"))
        written.append({split: b"".join(f.read_bytes() for f in sorted((tmp_path / str(k) / "category=cat" / f"split={split}").glob("part-*"))) for split in ("train", "val")})
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert written[0] == written[1] == written[2] and all(written[0].values())
    assert all(line == json.dumps(json.loads(line), ensure_ascii=False) for line in written[0]["train"].decode().split("\n") if line)


def test_max_records_of_each_dataset(spark):
    full = corpus.formatted(raw_rows(spark), ["file_path", "line_no"])
    some = corpus.formatted(raw_rows(spark), ["file_path", "line_no"], max_records=5)
    key = lambda r: (r.file_path, r.line_no)
    want = {d: sorted(key(r) for r in full.where((F.col("dataset") == d) & F.col("reject").isNull()).collect())[:5] for d in ("big", "small")}
    assert {d: sorted(key(r) for r in some.where((F.col("dataset") == d) & F.col("reject").isNull()).collect()) for d in want} == want
    assert some.where("reject is not null").count() == full.where("reject is not null").count() and some.columns == full.columns


def test_strict_keys_of_all_rows(spark):
    import hashlib

    done = corpus.strict_keys(corpus.formatted(raw_rows(spark), ["file_path", "line_no"]).where("reject is null"))
    for r in done.collect():
        payload = {"seed": 42, "messages": [m.asDict() for m in r.messages]}
        assert r.strict_key == hashlib.blake2b(json.dumps(payload, ensure_ascii=False, sort_keys=True).encode(), digest_size=16).hexdigest()


def test_a_single_dataset_keeps_its_order(spark):
    rows = spark.range(500).select("id", F.lit("only").alias("dataset"))
    plan = mix.mix_plan(rows.groupBy("dataset").agg(F.count("*").alias("n")))
    out = mix.positions(mix.mixed(rows.repartition(7), plan, "dataset", ["id"]))
    assert [r.id for r in out.orderBy("position").collect()] == list(range(500)) and out.agg(F.max("position")).first()[0] == 500


def test_a_mix_is_written_in_its_order(spark, tmp_path):
    """Files in the order of their names hold the mix in its order."""
    rows = spark.range(300).select("id", F.when(F.col("id") % 3 == 0, "a").otherwise("b").alias("dataset"))
    out = mix.mixed(rows.repartition(5), mix.mix_plan(rows.groupBy("dataset").agg(F.count("*").alias("n"))), "dataset", ["id"])
    mix.write_order(out).select(F.col("id").cast("string").alias("value")).write.text(str(tmp_path / "mix"))
    read = readers.text_lines(spark, str(tmp_path / "mix"))
    assert [int(r.text) for r in read.orderBy("file_path", "line_no").collect()] == [r.id for r in mix.positions(out).orderBy("position").collect()]


def test_readers_without_size_limits(spark, tmp_path):
    (tmp_path / "a.json").write_text(' [{"x": 1},\n\n {"x":\n 2}]')
    (tmp_path / "b.json").write_text('{"x": 3}\n\n{"x": 4}\n{bad\n')
    (tmp_path / "c.json").write_text('{"x": "' + "y" * 2000 + '"}')
    got = sorted((r.file_path[-6:], r.line_no, r.raw[:8]) for r in readers.array_or_lines(spark, str(tmp_path)).collect())
    assert got == [("a.json", 0, '{"x":1}'), ("a.json", 1, '{"x":2}'), ("b.json", 0, '{"x": 3}'), ("b.json", 2, '{"x": 4}'), ("b.json", 3, "{bad"), ("c.json", 0, '{"x": "y')]
    assert readers.array_or_lines(spark, str(tmp_path), limit=1).count() == 3
    _, reject = adapters.adapted(F.col("raw"))
    assert [r[0] for r in readers.whole_json(spark, str(tmp_path / "b.json")).select(reject).collect()] == ["malformed_json"]
    assert readers.whole_json(spark, str(tmp_path / "c.json")).count() == 1
    catalog = readers.file_catalog(spark, str(tmp_path))
    counts = {r.file_path[-6:]: r.records for r in inventory.record_counts(spark, catalog, files=1).collect()}
    assert counts == {"a.json": 2, "b.json": 3}  # b does not parse and has three lines, c holds no list
    assert {r.body for r in readers.file_bodies(spark, str(tmp_path / "a.json")).collect()} == {(tmp_path / "a.json").read_text()}
    hashed = readers.with_hash(spark.read.format("binaryFile").load(str(tmp_path / "a.json"))).first()
    import hashlib

    assert hashed.sha256 == hashlib.sha256((tmp_path / "a.json").read_bytes()).hexdigest()


def test_samples_and_logs(spark, tmp_path):
    rows = spark.createDataFrame([('{"a": 1}',)], "raw string")
    sinks.sampled_jsonl(rows, str(tmp_path / "s"), rows.agg(F.count("*").alias("records")))
    assert spark.read.text(str(tmp_path / "s" / "sample")).first().value == '{"a": 1}' and spark.read.json(str(tmp_path / "s" / "sample_info")).first().records == 1
    inventory.logged("one\nline", str(tmp_path / "log"))
    inventory.logged("two", str(tmp_path / "log"))
    assert [x.split(" ", 1)[1] for x in (tmp_path / "log").read_text().splitlines()] == ["one line", "two"]
    texts = spark.createDataFrame([([("user", "q")],), ([("user", None)],)], "messages array<struct<role:string,content:string>>")
    assert inventory.only_text(texts.limit(1)) and not inventory.only_text(spark.createDataFrame([([1],)], "messages array<int>"))
    token = template.pandas_tokenizer(os.path.join("/opt/tokenizers", "word_bpe_49k.json"))
    tokens = template.tokenize_chat(spark.createDataFrame([([("user", "hello there"), ("assistant", "good day")],)], "messages array<struct<role:string,content:string>>"), token, 64).first()
    kept = [t for t, k in zip(tokens.input_ids, tokens.labels) if k != template.IGNORED]
    assert 0 < len(kept) == tokens.assistant_tokens < len(tokens.input_ids) and kept[:2] == token("good day")[:2]
