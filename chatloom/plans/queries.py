"""The engine's operators as named queries on the driver tables, each beside its DuckDB equivalent."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import dedup_key, human_bytes, message, multiset_digest, normalize, record, redact, size_bytes, split_of, total_chars
from ..operators import adapters, dedup, joins, mix, profile, template, validate, windows
from ..session import table
from ..sources.readers import is_priority, priority_walk
from . import corpus, recipes

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLES[f.__name__] = sql
        return f

    return add


# Limits under which every reject branch fires on the driver tables.
LIMITS = {"min_chars": 1000, "max_chars": 4000, "val_fraction": 0.2, "seed": 42}
_BUCKET = "('0x' || substr(key, 1, 16))::UBIGINT % 1000000"


def _conv(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus.conversations(table(spark, sf_dir, "conversations"))


def _texts(messages: str = "messages") -> list[Column]:
    return [F.element_at(messages, -2)["content"].alias("user_text"), F.element_at(messages, -1)["content"].alias("assistant_text")]


# -- conversations -----------------------------------------------------------------------------

_CONV = """WITH c AS (SELECT conv_id, string_agg(role || chr(31) || text, chr(30) ORDER BY turn) AS canon, sum(length(text)) AS total,
  bool_or(role = 'user') AS u, bool_or(role = 'assistant') AS a FROM conversations GROUP BY conv_id),
k AS (SELECT *, sha256('42' || chr(31) || canon) AS key, CASE WHEN NOT u OR NOT a THEN 'missing_field' WHEN total < 1000 THEN 'too_short' WHEN total > 4000 THEN 'too_long' END AS early FROM c),
r AS (SELECT *, CASE WHEN early IS NOT NULL THEN early WHEN row_number() OVER (PARTITION BY early, key ORDER BY conv_id) > 1 THEN 'duplicate' END AS reject FROM k)
"""


@query(_CONV + f"SELECT reject, CASE WHEN reject IS NULL THEN CASE WHEN {_BUCKET} < 200000 THEN 'val' ELSE 'train' END END AS split, count(*) AS n FROM r GROUP BY ALL")
def conv_reject_split_counts(spark, sf_dir):
    done = validate.annotate(_conv(spark, sf_dir), ["conv_id"], **LIMITS)
    return done.groupBy("reject", "split").agg(F.count("*").alias("n"))


@query("""SELECT conv_id, count(*) AS n_messages, arg_min(role, turn) AS first_role, sum(length(text))::BIGINT AS total_chars FROM conversations GROUP BY conv_id""")
def conv_canonical_shape(spark, sf_dir):
    m = F.col("messages")
    return _conv(spark, sf_dir).select("conv_id", F.size(m).cast("long").alias("n_messages"), F.get(m, F.lit(0))["role"].alias("first_role"), total_chars(m).cast("long").alias("total_chars"))


@query("""WITH l AS (SELECT *, lag(role) OVER w AS before, row_number() OVER w - 1 AS i FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn)),
v AS (SELECT conv_id, count(*) FILTER (role = 'system' AND i > 0) AS late_system, (count(*) FILTER (role = 'user') = 0)::INT AS no_user,
  (count(*) FILTER (role = 'assistant') = 0)::INT AS no_assistant, (arg_min(role, i) = 'assistant')::INT AS starts_assistant, (arg_max(role, i) = 'user')::INT AS ends_user,
  count(*) FILTER (role = before) AS repeated_role FROM l GROUP BY conv_id)
SELECT *, late_system + no_user + no_assistant + starts_assistant + ends_user + repeated_role = 0 AS clean FROM v""")
def conv_contract_violations(spark, sf_dir):
    shown = ["late_system", "no_user", "no_assistant", "starts_assistant", "ends_user", "repeated_role"]
    return validate.contract_totals(_conv(spark, sf_dir), ["conv_id"]).select("conv_id", *(F.col(c).cast("long").alias(c) for c in shown), "clean")


@query("""SELECT count(*) AS rows, count(*) FILTER (NOT u) AS no_user, count(*) FILTER (NOT a) AS no_assistant, count(*) FILTER (s) AS late_system FROM (
  SELECT conv_id, bool_or(role = 'user') AS u, bool_or(role = 'assistant') AS a, bool_or(role = 'system' AND turn > 0) AS s FROM conversations GROUP BY conv_id)""")
def conv_contract_report(spark, sf_dir):
    v = validate.violations(F.col("messages"))
    some = _conv(spark, sf_dir).select(*(v[k].alias(k) for k in ("no_user", "no_assistant", "late_system")))
    return some.agg(F.count("*").alias("rows"), *(F.count_if(F.col(k) > 0).alias(k) for k in some.columns))


@query("""SELECT coalesce(w, 'ok') AS first_violation, count(*) AS n FROM (
  SELECT conv_id, CASE WHEN NOT bool_or(role = 'user') THEN 'no user' WHEN NOT bool_or(role = 'assistant') THEN 'no assistant' END AS w FROM conversations GROUP BY conv_id) GROUP BY ALL""")
def conv_first_violation(spark, sf_dir):
    found = _conv(spark, sf_dir).select(F.coalesce(validate.first_violation(F.col("messages")), F.lit("ok")).alias("first_violation"))
    return profile.histogram(found, "first_violation")


@query("""WITH m AS (SELECT *, CASE WHEN role = 'user' AND lag(role) OVER w = 'user' THEN 0 ELSE 1 END AS new FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn)),
g AS (SELECT *, sum(new) OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS island FROM m)
SELECT conv_id, island::BIGINT AS island, any_value(role) AS role, sha256(string_agg(text, chr(10) || chr(10) ORDER BY turn)) AS content_sha256, count(*) AS n_turns FROM g GROUP BY conv_id, island""")
def conv_adjacent_user_merge(spark, sf_dir):
    # Users in every third turn, so that neighbours exist.
    merged = adapters.merged_turns(table(spark, sf_dir, "conversations"), "conv_id", "turn", "role", "text")
    return merged.select("conv_id", F.col("island").cast("long").alias("island"), "role", F.sha2("content", 256).alias("content_sha256"), "n_turns")


@query("""SELECT conv_id, coalesce(max(turn) FILTER (role = 'user'), -1) AS last_user_idx, count(*) - 1 - coalesce(max(turn) FILTER (role = 'user'), -1) AS n_after FROM conversations GROUP BY conv_id""")
def conv_last_user_index(spark, sf_dir):
    last = windows.last_index(F.col("messages"))
    return _conv(spark, sf_dir).select("conv_id", last.cast("long").alias("last_user_idx"), (F.size("messages") - 1 - last).cast("long").alias("n_after"))


_RENDER = """WITH l AS (SELECT conv_id, coalesce(max(turn) FILTER (role = 'user'), -1) AS u FROM conversations GROUP BY conv_id),
t AS (SELECT conv_id, string_agg('<|im_start|>' || role || chr(10) || CASE WHEN role = 'assistant' AND turn > u THEN '<think>' || chr(10) || chr(10) || '</think>' || chr(10) || chr(10) ELSE '' END || text || '<|im_end|>' || chr(10), '' ORDER BY turn) AS x
  FROM conversations JOIN l USING (conv_id) GROUP BY conv_id) """


@query(_RENDER + "SELECT conv_id, sha256(x) AS rendered_sha256, length(x) AS rendered_chars FROM t")
def conv_render_template(spark, sf_dir):
    text = template.render(F.col("messages"))
    return _conv(spark, sf_dir).select("conv_id", F.sha2(text, 256).alias("rendered_sha256"), F.length(text).cast("long").alias("rendered_chars"))


@query("""WITH m AS (SELECT *, length(text) % 7 = 0 AS marked FROM conversations)
SELECT conv_id, count(*) + count(*) FILTER (marked) AS n_start, count(*) AS n_end, true AS starts, NOT bool_or(marked) AS counts, NOT bool_or(marked) AS content_clean, bool_or(role = 'assistant' AND (marked OR text <> '')) AS has_assistant FROM m GROUP BY conv_id""")
def conv_special_token_check(spark, sf_dir):
    """Conversations in which some texts, by their lengths, hold a turn marker, so that the checks fail on them."""
    turns = table(spark, sf_dir, "conversations").withColumn("text", F.when(F.length("text") % 7 == 0, F.concat("text", F.lit(template.START))).otherwise(F.col("text")))
    text = template.render(F.col("messages"))
    checks = template.check_render(F.col("messages"), text)
    return corpus.conversations(turns).select("conv_id", template.occurrences(text, template.START).cast("long").alias("n_start"), template.occurrences(text, template.END).cast("long").alias("n_end"), *(c.alias(k) for k, c in checks.items()))


_TOKENS = """WITH l AS (SELECT conv_id, coalesce(max(turn) FILTER (role = 'user'), -1) AS u FROM conversations GROUP BY conv_id),
t AS (SELECT conv_id, turn, role, 13 + length(role) + CASE WHEN role = 'assistant' AND turn > u THEN 19 ELSE 0 END AS head, length(text) + 10 AS said FROM conversations JOIN l USING (conv_id)),
a AS (SELECT *, sum(head + said + 1) OVER (PARTITION BY conv_id ORDER BY turn) - said - 1 AS p FROM t),
g AS (SELECT conv_id, sum(head + said + 1)::BIGINT AS full_length, coalesce(sum(least(greatest({n} - p, 0), said)) FILTER (role = 'assistant'), 0)::BIGINT AS assistant_tokens FROM a GROUP BY conv_id) """


@query(_TOKENS.format(n=2048) + "SELECT 'conversations' AS corpus, count(*) AS rows, round(avg((full_length > 2048)::INT), 6) AS truncated, round(avg((assistant_tokens = 0)::INT), 6) AS all_masked, round(avg(least(1.0::DOUBLE, 2048::DOUBLE / greatest(full_length, 1))), 6) AS kept_share, avg((full_length > 2048)::INT) <= 0.05 AS passes FROM g")
def conv_tokenize_stats(spark, sf_dir):
    tokens = template.tokenize_chat(_conv(spark, sf_dir), template.whitespace_tokenizer, 2048)
    stats = template.truncation_stats(tokens.withColumn("corpus", F.lit("conversations")), ["corpus"], 2048)
    return stats.select("corpus", "rows", *(F.round(c, 6).alias(c) for c in ("truncated", "all_masked", "kept_share")), "passes")


@query(_TOKENS.format(n=512) + "SELECT conv_id, assistant_tokens, full_length FROM g WHERE assistant_tokens > 0")
def conv_tokens_kept(spark, sf_dir):
    tokens = template.tokenize_chat(_conv(spark, sf_dir), template.whitespace_tokenizer, 512)
    return template.drop_all_masked(tokens).select("conv_id", *(F.col(c).cast("long").alias(c) for c in ("assistant_tokens", "full_length")))


@query()
def conv_span_tokens(spark, sf_dir):
    """Ids and assistant masks of all conversations under a real tokenizer, as digests."""
    import public_tokenizers

    tokens = template.tokenize_chat(_conv(spark, sf_dir), template.FileTokenizer(public_tokenizers.path("byte_bpe_50k.json")), 4096)
    joined = lambda c: F.sha2(F.array_join(F.col(c).cast("array<string>"), ","), 256).alias(f"{c}_sha256")
    return tokens.select("conv_id", joined("input_ids"), joined("labels"), F.col("assistant_tokens").cast("long").alias("assistant_tokens"), F.col("full_length").cast("long").alias("full_length"))


@query("""WITH f AS (SELECT conv_id, arg_min(lower(text), turn) FILTER (role = 'user') AS p FROM conversations GROUP BY conv_id)
SELECT CASE WHEN contains(p, 'zu') OR contains(p, 'der ') THEN 'german' WHEN contains(p, ' the ') THEN 'english' ELSE 'other' END AS expert, count(*) AS n FROM f WHERE p IS NOT NULL GROUP BY ALL""")
def route_prompts(spark, sf_dir):
    first = F.get(F.filter("messages", lambda m: m["role"] == "user"), F.lit(0))["content"]
    rules = [("german", ("zu", "der ")), ("english", (" the ",))]
    prompts = _conv(spark, sf_dir).select(first.alias("prompt")).where("prompt is not null")
    return profile.histogram(prompts.select(joins.route(F.col("prompt"), rules, "other").alias("expert")), "expert")


@query("""WITH m AS (SELECT conv_id * 1000 + turn AS id, turn, role, text FROM conversations)
SELECT a.id, b.text AS user_text, a.text AS assistant_text FROM m a JOIN m b ON a.turn > 0 AND b.id = a.id - 1 WHERE a.text <> '' AND b.text <> '' AND a.text <> b.text""")
def recipe_reply_pairs(spark, sf_dir):
    rows = table(spark, sf_dir, "conversations").select((F.col("conv_id") * 1000 + F.col("turn")).alias("id"), F.when(F.col("turn") > 0, F.col("conv_id") * 1000 + F.col("turn") - 1).alias("reply_to"), "turn", "text")
    return recipes.replies(rows, "id", "reply_to", "text", ["turn"], keep=["id"]).select("id", *_texts())


@query("""WITH r AS (SELECT conv_id, string_agg(CASE role WHEN 'assistant' THEN 'assistant' WHEN 'user' THEN 'user' ELSE 'system' END || chr(31) || text, chr(30) ORDER BY turn) AS x, count(*) AS n FROM conversations GROUP BY conv_id)
SELECT conv_id, n AS n_messages, sha256(x) AS sha256 FROM r""")
def adapter_message_list(spark, sf_dir):
    """Rows to JSON records with foreign key names and role aliases, and back through the adapters."""
    from ..functions.text import canonical_text

    alias = F.when(F.col("role") == "assistant", "gpt").when(F.col("role") == "user", "Human ").otherwise(F.col("role"))
    rows = table(spark, sf_dir, "conversations").select("conv_id", F.struct("turn", alias.alias("from"), F.col("text").alias("value")).alias("t"))
    raw = rows.groupBy("conv_id").agg(F.array_sort(F.collect_list("t")).alias("t")).select("conv_id", F.to_json(F.struct(F.transform("t", lambda t: F.struct(t["from"].alias("from"), t["value"].alias("value"))).alias("conversations"))).alias("raw"))
    messages, _ = adapters.adapted(F.col("raw"))
    done = raw.withColumn("messages", messages)
    return done.select("conv_id", F.size("messages").cast("long").alias("n_messages"), F.sha2(canonical_text(F.col("messages")), 256).alias("sha256"))


@query("""WITH c AS (SELECT conv_id, string_agg(CASE role WHEN 'system' THEN 'user' ELSE role END || '=' || text, chr(30) ORDER BY turn) AS x FROM conversations WHERE turn % 2 = 0 GROUP BY conv_id)
SELECT conv_id, sha256(x) AS sha256 FROM c""")
def adapter_session_events(spark, sf_dir):
    """One file a conversation: events of type 'message' count, others do not."""
    role = F.when(F.col("role") == "system", "human").otherwise(F.col("role"))
    blocks = F.array(F.struct(F.lit("text").alias("type"), F.col("text").alias("text")))
    event = F.struct(F.when(F.col("turn") % 2 == 0, "message").otherwise("summary").alias("type"), F.struct(role.alias("role"), blocks.alias("content")).alias("message"))
    rows = table(spark, sf_dir, "conversations").select(F.col("conv_id").alias("file_path"), F.col("turn").alias("line_no"), F.to_json(event).alias("raw"))
    text = F.array_join(F.transform("messages", lambda m: F.concat(m["role"], F.lit("="), m["content"])), "\x1e")
    return adapters.session_messages(rows).select(F.col("file_path").alias("conv_id"), F.sha2(text, 256).alias("sha256"))


@query("""WITH r AS (SELECT conv_id, string_agg(CASE WHEN i = 1 THEN 'user' ELSE 'assistant' END || chr(31) || text, chr(30) ORDER BY turn) AS x
  FROM (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS i FROM conversations WHERE text <> '') GROUP BY conv_id) SELECT conv_id, sha256(x) AS sha256 FROM r""")
def adapter_topical(spark, sf_dir):
    """[id, {content: [{message, agent}]}] with agents of unknown names: the first is the user, the rest assistants."""
    from ..functions.text import canonical_text

    said = F.struct("turn", F.col("text").alias("message"), F.concat(F.lit("agent_"), F.col("turn") % 2).alias("agent"))
    rows = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.array_sort(F.collect_list(said)).alias("t"))
    body = F.to_json(F.struct(F.transform("t", lambda t: F.struct(t["message"].alias("message"), t["agent"].alias("agent"))).alias("content")))
    messages, _ = adapters.adapted(F.concat(F.lit('["c'), "conv_id", F.lit('", '), body, F.lit("]")))
    return rows.withColumn("messages", messages).where("messages is not null").select("conv_id", F.sha2(canonical_text(F.col("messages")), 256).alias("sha256"))


@query("""SELECT c_custkey, CASE WHEN c_custkey % 7 > 0 THEN 'who is ' || c_name END AS user_text, CASE WHEN c_custkey % 7 > 0 THEN c_mktsegment END AS assistant_text, CASE WHEN c_custkey % 7 = 0 THEN 'unsupported_schema' END AS reject FROM customer""")
def adapter_question_vars(spark, sf_dir):
    """{vars: {question, answer}}; without an answer the record has no known shape."""
    inner = F.struct(F.concat(F.lit("who is "), "c_name").alias("question"), F.when(F.col("c_custkey") % 7 > 0, F.col("c_mktsegment")).alias("answer"))
    messages, reject = adapters.adapted(F.to_json(F.struct(inner.alias("vars"))))
    done = table(spark, sf_dir, "customer").select("c_custkey", messages.alias("messages"), reject.alias("reject"))
    return done.select("c_custkey", F.try_element_at("messages", F.lit(1))["content"].alias("user_text"), F.try_element_at("messages", F.lit(2))["content"].alias("assistant_text"), "reject")


@query("""SELECT o_orderkey, CASE k WHEN 0 THEN 'malformed_json' WHEN 3 THEN 'unsupported_schema' WHEN 5 THEN 'malformed_json' END AS reject,
CASE k WHEN 1 THEN 'ask ' || o_custkey WHEN 2 THEN 'reach ' || o_orderstatus WHEN 4 THEN 'last ' || o_custkey END AS user_text,
CASE k WHEN 1 THEN 'say ' || o_orderstatus WHEN 2 THEN '1. first' || chr(10) || '3. then ' || o_custkey WHEN 4 THEN 'r' END AS assistant_text FROM (SELECT *, o_orderkey % 6 AS k FROM orders)""")
def adapter_mixed_shapes(spark, sf_dir):
    """Records of six shapes in one column: cut JSON, pairs, goal and steps, unknown keys, repeated keys (the last counts), and marked ones."""
    from ..functions.variant import lenient

    lenient(spark)
    k, who, state = F.col("o_orderkey") % 6, F.col("o_custkey").cast("string"), F.col("o_orderstatus")
    shapes = [
        F.lit('{"prompt": "cut'),
        F.concat(F.lit('{"prompt": "ask '), who, F.lit('", "response": "say '), state, F.lit('"}')),
        F.concat(F.lit('{"goal": "reach '), state, F.lit('", "step_instructions": ["first", " ", "then '), who, F.lit('"]}')),
        F.lit('{"left": 1, "right": [2]}'),
        F.concat(F.lit('{"question": "first", "question": "last '), who, F.lit('", "answer": "r"}')),
        F.lit('{"__malformed__": true, "prompt": "p", "response": "r"}'),
    ]
    raw = F.get(F.array(*shapes), k.cast("int"))
    messages, reject = adapters.adapted(raw)
    done = table(spark, sf_dir, "orders").select("o_orderkey", messages.alias("messages"), reject.alias("reject"))
    return done.select("o_orderkey", "reject", F.try_element_at("messages", F.lit(1))["content"].alias("user_text"), F.try_element_at("messages", F.lit(2))["content"].alias("assistant_text"))


@query("""SELECT doc_id, source || CASE WHEN doc_id % 2 = 0 THEN chr(10) || lang ELSE '' END AS user_text, sha256(text) AS assistant_sha256 FROM documents""")
def adapter_instruction_record(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").select("doc_id", F.col("source").alias("prompt"), F.lit("").alias("instruction"), F.when(F.col("doc_id") % 2 == 0, F.col("lang")).alias("input"), F.col("text").alias("output"))
    done = rows.select("doc_id", adapters.instruction_record(rows).alias("messages")).select("doc_id", *_texts())
    return done.select("doc_id", "user_text", F.sha2("assistant_text", 256).alias("assistant_sha256"))


@query(r"""SELECT c_name || '/' || c_mktsegment AS id, regexp_matches(c_name || '/' || c_mktsegment, '^[A-Za-z0-9][A-Za-z0-9._-]*/[A-Za-z0-9._-]+$') AS valid, false AS bare_valid, regexp_matches('_' || c_name || '/x y', '^[A-Za-z0-9][A-Za-z0-9._-]*/[A-Za-z0-9._-]+$') AS odd_valid FROM customer""")
def id_shapes(spark, sf_dir):
    from ..functions.text import is_id

    made = F.concat("c_name", F.lit("/"), "c_mktsegment")
    return table(spark, sf_dir, "customer").select(made.alias("id"), is_id(made).alias("valid"), is_id(F.col("c_name")).alias("bare_valid"), is_id(F.concat(F.lit("_"), "c_name", F.lit("/x y"))).alias("odd_valid"))


# -- documents ---------------------------------------------------------------------------------

_DOC = """WITH d AS (SELECT doc_id, lang, source, text, 'user' || chr(31) || 'Write a text from ' || source || '.' || chr(30) || 'assistant' || chr(31) || text AS canon, length('Write a text from ' || source || '.') + length(text) AS total FROM documents),
k AS (SELECT *, sha256('42' || chr(31) || canon) AS key, CASE WHEN total < 300 THEN 'too_short' WHEN total > 20000 THEN 'too_long' END AS early FROM d),
r AS (SELECT *, CASE WHEN early IS NOT NULL THEN early WHEN row_number() OVER (PARTITION BY lang, early, key ORDER BY doc_id) > 1 THEN 'duplicate' END AS reject FROM k),
s AS (SELECT *, CASE WHEN reject IS NULL THEN CASE WHEN """ + _BUCKET + """ < 100000 THEN 'val' ELSE 'train' END END AS split FROM r)
"""


def _doc_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    user = F.concat(F.lit("Write a text from "), F.col("source"), F.lit("."))
    return table(spark, sf_dir, "documents").withColumn("messages", record(None, user, F.col("text")))


def _doc_annotated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validate.annotate(_doc_records(spark, sf_dir), ["doc_id"], ["lang"], min_chars=300, max_chars=20_000, val_fraction=0.1, seed=42)


_NORM = r"""regexp_replace(regexp_replace(regexp_replace(replace(replace(chr(9) || ' ' || replace(text, '. ', '.' || chr(13) || chr(10) || chr(13) || chr(10) || chr(13)) || chr(160) || chr(10), chr(13) || chr(10), chr(10)), chr(13), chr(10)), '\n{3,}', chr(10) || chr(10), 'g'), '^[\s\x{0b}\x{1c}-\x{1f}\x{85}\x{a0}]+', ''), '[\s\x{0b}\x{1c}-\x{1f}\x{85}\x{a0}]+$', '')"""


@query(f"SELECT doc_id, length({_NORM}) AS norm_len, sha256({_NORM}) AS norm_sha256 FROM documents")
def doc_normalize(spark, sf_dir):
    messy = F.concat(F.lit("\t "), F.replace("text", F.lit(". "), F.lit(".\r\n\r\n\r")), F.lit(" \n"))
    text = normalize(messy)
    return table(spark, sf_dir, "documents").select("doc_id", F.length(text).cast("long").alias("norm_len"), F.sha2(text, 256).alias("norm_sha256"))


@query("""WITH n AS (SELECT lang, sha256(text) AS h, row_number() OVER (PARTITION BY lang ORDER BY doc_id, sha256(text)) - 1 AS n FROM documents),
a AS (SELECT lang, n // 64 AS n, sha256(string_agg(h, '' ORDER BY n)) AS h FROM n GROUP BY ALL), b AS (SELECT lang, n // 64 AS n, sha256(string_agg(h, '' ORDER BY n)) AS h FROM a GROUP BY ALL),
c AS (SELECT lang, sha256(string_agg(h, '' ORDER BY n)) AS digest FROM b GROUP BY ALL)
SELECT c.lang, count(*) AS n_lines, digest FROM c JOIN documents ON c.lang IS NOT DISTINCT FROM documents.lang GROUP BY ALL""")
def doc_ordered_digest(spark, sf_dir):
    """A digest of each language's texts in order, in three levels: two of runs of 64, and one of all that is left, a digest for 4096 texts."""
    return windows.ordered_digest(table(spark, sf_dir, "documents"), F.col("text"), ["lang"], ["doc_id"], 64, 3, open_top=True)


@query("SELECT min(doc_id) AS doc_id FROM documents GROUP BY text")
def doc_exact_dedup(spark, sf_dir):
    keyed = table(spark, sf_dir, "documents").select("doc_id", F.sha2("text", 256).alias("key"))
    return dedup.mark_duplicates(keyed, "key", ["doc_id"], []).where("not is_dup").select("doc_id")


@query("""WITH r AS (SELECT source, row_number() OVER (PARTITION BY text ORDER BY doc_id) AS k FROM documents)
SELECT source, count(*) AS raw, count(*) FILTER (k = 1) AS accepted, count(*) FILTER (k > 1) AS duplicate FROM r GROUP BY source""")
def doc_dup_by_source(spark, sf_dir):
    keyed = table(spark, sf_dir, "documents").select("doc_id", "source", F.sha2("text", 256).alias("key"))
    marked = dedup.mark_duplicates(keyed, "key", ["doc_id"], [])
    return marked.groupBy("source").agg(F.count("*").alias("raw"), F.count_if(~F.col("is_dup")).alias("accepted"), F.count_if("is_dup").alias("duplicate"))


@query(f"SELECT lang, count(*) FILTER ({_BUCKET} >= 20000) AS train, count(*) FILTER ({_BUCKET} < 20000) AS val FROM (SELECT lang, sha256('42' || chr(31) || 'user' || chr(31) || 'Write a text from ' || source || '.' || chr(30) || 'assistant' || chr(31) || text) AS key FROM documents) GROUP BY lang")
def doc_split_train_val(spark, sf_dir):
    split = split_of(dedup_key(F.col("messages")), 0.02)
    rows = _doc_records(spark, sf_dir).select("lang", split.alias("split"))
    return rows.groupBy("lang").agg(F.count_if(F.col("split") == "train").alias("train"), F.count_if(F.col("split") == "val").alias("val"))


_BAG = "sha256(count({k}) || '|' || " + " || '|' || ".join(f"sum(('0x' || substr({{k}}, {1 + 15 * i}, 15))::UBIGINT::HUGEINT)" for i in range(4)) + ")"


@query(_DOC + """SELECT lang, count(*) AS raw, count(*) FILTER (reject IS NULL) AS accepted, count(*) FILTER (split = 'train') AS train, count(*) FILTER (split = 'val') AS val,
  count(*) FILTER (reject = 'too_short') AS too_short, count(*) FILTER (reject = 'too_long') AS too_long, count(*) FILTER (reject = 'duplicate') AS duplicate, """ + _BAG.format(k="ok") + """ AS fingerprint
FROM (SELECT *, CASE WHEN reject IS NULL THEN key END AS ok FROM s) GROUP BY lang""")
def doc_manifest(spark, sf_dir):
    return profile.manifest(_doc_annotated(spark, sf_dir), ["lang"]).select("lang", "raw", "accepted", "train", "val", "too_short", "too_long", "duplicate", "fingerprint")


@query(_DOC + "SELECT source, count(*) AS raw, count(*) FILTER (reject IS NULL) AS accepted, count(*) FILTER (reject = 'too_short') AS too_short, count(*) FILTER (reject = 'too_long') AS too_long, count(*) FILTER (reject = 'duplicate') AS duplicate FROM s GROUP BY source")
def doc_reject_taxonomy(spark, sf_dir):
    return validate.reject_counts(_doc_annotated(spark, sf_dir), ["source"]).select("source", "raw", "accepted", "too_short", "too_long", "duplicate")


@query("SELECT CASE WHEN grouping(lang) = 1 THEN 'TOTAL' ELSE lang END AS lang, sum(n)::BIGINT AS n, sum(chars)::BIGINT AS chars FROM (SELECT lang, 1 AS n, n_chars AS chars FROM documents) GROUP BY ROLLUP (lang)")
def doc_report_totals(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").select("lang", F.lit(1).alias("n"), F.col("n_chars").alias("chars"))
    return profile.with_total(rows, "lang", "n", "chars")


@query("""(SELECT 'longest' AS side, n_chars AS length, source || '/' || doc_id AS name FROM documents ORDER BY n_chars DESC, name DESC LIMIT 20)
UNION ALL (SELECT 'shortest', n_chars, source || '/' || doc_id AS name FROM documents ORDER BY n_chars, name LIMIT 20)""")
def doc_longest_shortest(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").select("n_chars", F.concat("source", F.lit("/"), "doc_id").alias("name"))
    return profile.longest_and_shortest(rows, "n_chars", "name").select("side", "length", "name")


@query("SELECT lang, doc_id FROM (SELECT lang, doc_id, row_number() OVER (PARTITION BY lang ORDER BY doc_id) AS k FROM documents WHERE n_chars >= 1000) WHERE k <= 7")
def doc_max_records_head(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").where("n_chars >= 1000").select("lang", "doc_id")
    return windows.head(rows, 7, ["doc_id"], ["lang"])


@query("SELECT doc_id, bytes::BIGINT AS bytes, cum_bytes::BIGINT AS cum_bytes FROM (SELECT doc_id, strlen(text) + 1 AS bytes, sum(strlen(text) + 1) OVER (ORDER BY doc_id) AS cum_bytes FROM documents) WHERE cum_bytes - bytes < 500000")
def doc_byte_budget(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").select("doc_id", (F.octet_length("text") + 1).alias("size"))
    return windows.byte_budget(rows, 500_000, ["doc_id"], F.col("size")).select("doc_id", "bytes", "cum_bytes")


@query(r"SELECT doc_id, left(regexp_replace(text, '\b[A-Za-z0-9+/=_-]{40,}\b', '<REDACTED>', 'g'), 200) AS preview FROM documents")
def doc_redact_preview(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", redact(F.col("text")).alias("preview"))


@query("SELECT lang, count(*) AS datasets, count(*) AS records, sum(n_chars)::BIGINT AS bytes, CASE WHEN count(*) < 500 THEN 'LOW' ELSE '' END AS flag FROM documents GROUP BY lang")
def doc_low_resource_flag(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").select("lang", F.lit(1).cast("long").alias("records"), "n_chars")
    return profile.inventory(rows, "lang", "records", "n_chars")


@query("""SELECT source, count(*) AS files, CASE WHEN sum(n_chars) < 1024 THEN sum(n_chars) || ' B' WHEN sum(n_chars) < 1048576 THEN printf('%.1f KB', sum(n_chars) / 1024.0) ELSE printf('%.1f MB', sum(n_chars) / 1048576.0) END AS size FROM documents GROUP BY source""")
def source_human_sizes(spark, sf_dir):
    return table(spark, sf_dir, "documents").groupBy("source").agg(F.count("*").alias("files"), human_bytes(F.sum("n_chars")).alias("size"))


@query("SELECT source, lang, doc_id FROM (SELECT *, row_number() OVER (PARTITION BY source, lang ORDER BY n_chars DESC, doc_id) AS k FROM documents) WHERE k <= 3")
def doc_first_k_check(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").select("source", "lang", "doc_id", "n_chars")
    return windows.head(rows, 3, [F.col("n_chars").desc(), "doc_id"], ["source", "lang"]).drop("n_chars")


@query("SELECT lang, " + _BAG.format(k="k") + " AS digest, count(*) AS n FROM (SELECT lang, sha256(text) AS k FROM documents) GROUP BY lang")
def doc_content_digest(spark, sf_dir):
    return table(spark, sf_dir, "documents").groupBy("lang").agg(multiset_digest(F.sha2("text", 256)).alias("digest"), F.count("*").alias("n"))


@query("""SELECT doc_id, 'q' || (doc_id % 7) AS user_text, string_agg(i || '. ' || trim(s), chr(10) ORDER BY i) AS assistant_text FROM (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS s, generate_subscripts(string_split(text, chr(10)), 1) AS i FROM documents) WHERE trim(s) <> '' GROUP BY doc_id""")
def adapter_goal_steps(spark, sf_dir):
    plan = adapters.numbered(F.split("text", "\n"))
    rows = table(spark, sf_dir, "documents").select("doc_id", F.concat(F.lit("q"), F.col("doc_id") % 7).alias("user_text"), plan.alias("assistant_text"))
    return rows.where("assistant_text <> ''")


@query("""SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN 'ask ' || source WHEN doc_id % 3 = 1 THEN 'q ' || lang ELSE lang END || CASE WHEN doc_id % 2 = 0 AND NOT (doc_id % 3 = 2) THEN chr(10) || chr(10) || lang ELSE '' END AS user_text, text AS assistant_text FROM documents
WHERE NOT (doc_id % 3 = 2 AND doc_id % 2 = 1)""")
def adapter_alias_pair(spark, sf_dir):
    k = F.col("doc_id")
    rows = table(spark, sf_dir, "documents").select(
        "doc_id",
        F.when(k % 3 == 0, F.concat(F.lit("ask "), "source")).when(k % 3 == 1, "").alias("instruction"),
        F.when(k % 3 == 1, F.concat(F.lit("q "), "lang")).alias("question"),
        F.when(k % 2 == 0, F.col("lang")).alias("input"),
        F.when(k % 5 > 0, F.col("text")).otherwise("").alias("response"),
        F.when(k % 5 == 0, F.col("text")).alias("answer"),
    )
    return rows.withColumn("messages", adapters.alias_pair_columns(rows)).where("messages is not null").select("doc_id", *_texts())


@query("SELECT doc_id, n FROM (SELECT doc_id, CASE WHEN doc_id % 4 = 3 THEN NULL ELSE 2 END AS n FROM documents) WHERE n IS NOT NULL")
def adapter_strict(spark, sf_dir):
    who = F.when(F.col("doc_id") % 4 == 3, "narrator").otherwise(" User ")
    rows = table(spark, sf_dir, "documents").select("doc_id", adapters.strict(F.array(message(who, F.col("text")), message(F.lit("ASSISTANT"), F.col("source")))).alias("messages"))
    return rows.where("messages is not null").select("doc_id", F.size("messages").cast("long").alias("n"))


# -- mixing ------------------------------------------------------------------------------------

_PLAN = """WITH z AS (SELECT lang AS dataset, count(*) AS n FROM documents GROUP BY lang),
s AS (SELECT *, min(n) OVER () AS smallest FROM z), w AS (SELECT *, greatest(1, n // smallest) AS whole FROM s),
p AS (SELECT *, whole * smallest AS whole_rows, n - whole * smallest AS extra, row_number() OVER (ORDER BY n DESC, dataset) - 1 AS rank FROM w)
"""


def _mix(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    docs = table(spark, sf_dir, "documents").select("doc_id", F.col("lang").alias("dataset"))
    plan = mix.mix_plan(docs.groupBy("dataset").agg(F.count("*").alias("n")))
    return docs, plan


@query(_PLAN + "SELECT dataset, n, whole::BIGINT AS whole, whole_rows::BIGINT AS whole_rows, extra::BIGINT AS extra, rank::BIGINT AS rank, sum(whole_rows) OVER ()::BIGINT AS whole_total, sum(extra) OVER ()::BIGINT AS extra_total FROM p")
def mix_plan(spark, sf_dir):
    plan = _mix(spark, sf_dir)[1]
    return plan.select("dataset", "n", *(F.col(c).cast("long").alias(c) for c in ("whole", "whole_rows", "extra", "rank", "whole_total", "extra_total")))


@query(_PLAN + """, o AS (SELECT doc_id, lang AS dataset, row_number() OVER (PARTITION BY lang ORDER BY doc_id) - 1 AS i FROM documents),
m AS (SELECT doc_id, dataset, CASE WHEN i < whole_rows THEN 'whole' ELSE 'extra' END AS part,
  CASE WHEN i < whole_rows THEN (i + ('0x' || substr(sha256('42|' || dataset || '|' || i || '|'), 1, 8))::UBIGINT::DOUBLE / 4294967296.0) / whole_rows ELSE 2 + rank + i / n END AS k FROM o JOIN p USING (dataset))
SELECT doc_id, dataset, part, row_number() OVER (ORDER BY k) AS position FROM m""")
def mix_order(spark, sf_dir):
    docs, plan = _mix(spark, sf_dir)
    return mix.positions(mix.mixed(docs, plan, "dataset", ["doc_id"])).select("doc_id", "dataset", "part", "position")


@query("SELECT count(*) AS expected, count(*) AS actual, count(DISTINCT doc_id) AS distinct_rows, count(*) = count(DISTINCT doc_id) AS ok FROM documents")
def mix_conservation(spark, sf_dir):
    docs, plan = _mix(spark, sf_dir)
    return mix.conservation(mix.mixed(docs, plan, "dataset", ["doc_id"]), plan, ["doc_id"])


@query("""WITH e(expert, lang) AS (VALUES ('romance', 'fr'), ('romance', 'es'), ('germanic', 'de'), ('germanic', 'en'), ('latin', 'es')),
a AS (SELECT expert FROM e JOIN documents USING (lang) UNION ALL SELECT 'general' FROM documents) SELECT expert, count(*) AS n FROM a GROUP BY expert""")
def expert_concat(spark, sf_dir):
    experts = {"romance": ["fr", "es"], "germanic": ["de", "en"], "latin": ["es"], "general": ["*"]}
    return joins.by_expert(table(spark, sf_dir, "documents").select("lang"), "lang", experts).groupBy("expert").agg(F.count("*").alias("n"))


@query("SELECT part_name, count(*) AS n FROM (SELECT 'benchmark' AS part_name FROM benchmark UNION ALL SELECT 'documents' FROM documents UNION ALL SELECT 'pages' FROM pages) GROUP BY part_name")
def corpora_concat(spark, sf_dir):
    parts = [(n, table(spark, sf_dir, n).select(F.col(c).alias("text"))) for n, c in (("documents", "text"), ("benchmark", "text"), ("pages", "html"))]
    return mix.concatenated(*parts).groupBy("part_name").agg(F.count("*").alias("n"))


# -- recipes -----------------------------------------------------------------------------------


@query("""WITH l AS (SELECT doc_id % 40 AS item_id, doc_id, CASE WHEN quality = 1 AND toxic = 0 THEN 'compile-pass' ELSE 'fail' END AS bucket, toxic AS errors, quality AS ex5, doc_id % 3 AS arm FROM labels),
f AS (SELECT item_id, arg_min({'b': bucket, 'e': errors, 'x': ex5, 'a': arm}, doc_id) FILTER (bucket = 'compile-pass') AS good, arg_min({'b': bucket, 'e': errors, 'x': ex5, 'a': arm}, doc_id) AS any1 FROM l GROUP BY item_id)
SELECT b.item_id, text AS user_text, CASE WHEN good IS NOT NULL THEN 'The reference implementation compiled and passed validation (bucket=compile-pass, errors=0, ex5_exists=' || good.x || ', arm=' || good.a || ').'
  ELSE 'The reference implementation did not compile cleanly in this release (bucket=' || coalesce(any1.b, 'None') || ', errors=' || coalesce(any1.e::VARCHAR, 'None') || ').' END AS assistant_text FROM benchmark b LEFT JOIN f ON b.item_id = f.item_id""")
def recipe_prompt_verdict(spark, sf_dir):
    bucket = F.when((F.col("quality") == 1) & (F.col("toxic") == 0), "compile-pass").otherwise("fail")
    verdicts = table(spark, sf_dir, "labels").select((F.col("doc_id") % 40).alias("item_id"), F.col("doc_id").alias("ord"), bucket.alias("bucket"), F.col("toxic").alias("errors"), F.col("quality").alias("ex5_exists"), (F.col("doc_id") % 3).alias("arm"))
    prompts = table(spark, sf_dir, "benchmark").select("item_id", F.col("text").alias("prompt"), F.col("item_id").alias("ord"))
    return recipes.prompt_verdicts(prompts, verdicts, order=["ord"], keep=["item_id"]).select("item_id", *_texts())


@query("""WITH o AS (SELECT o_orderkey, o_orderpriority AS s, CASE WHEN o_orderstatus = 'O' THEN 'defect' ELSE o_orderstatus END AS b, o_custkey::VARCHAR AS c FROM orders)
SELECT o_orderkey, 'Why is commit ' || c || ' in ' || s || ' (' || s || ') considered vulnerable?' AS user_text, 'Commit ' || c || ' introduced a ' || b || ' in ' || s || ' (' || s || '). Severity hint: unknown. CVE: none assigned. The defect survived ? days before being fixed.' || CASE WHEN o_orderkey % 2 = 0 THEN ' Signals: k' || (o_orderkey % 9) || '.' ELSE '' END AS assistant_text FROM o
UNION ALL SELECT o_orderkey, 'How was the ' || b || ' in ' || s || ' fixed?', 'Commit ? fixed it: "(no subject)" by an unknown author. It touched ? file(s), adding ? and removing ? line(s).' FROM o""")
def recipe_two_per_row(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").select(
        "o_orderkey", F.col("o_orderpriority").alias("subsystem"), F.when(F.col("o_orderstatus") != "O", F.col("o_orderstatus")).otherwise("").alias("bug_type"), F.col("o_custkey").cast("string").alias("introducing_commit"), F.when(F.col("o_orderkey") % 2 == 0, F.concat(F.lit("k"), F.col("o_orderkey") % 9)).alias("keywords")
    )
    return recipes.vulnerabilities(rows, keep=["o_orderkey"]).select("o_orderkey", *_texts())


@query(r"""WITH p AS (SELECT page_id, trim(regexp_replace(html, '\n{3,}', chr(10) || chr(10), 'g'), ' ' || chr(10) || chr(9)) AS code, regexp_extract(url, '^[a-z]+://([^/]+)', 1) AS repo, coalesce(nullif(regexp_replace(url, '^[a-z]+://[^/]+/', ''), ''), 'module.py') AS path FROM pages)
SELECT page_id, 'Write Python code that implements ' || string_split(path, '/')[-1] || ' from ' || repo || ' (path: ' || path || ').' AS user_text, sha256('# ' || path || ' (from ' || repo || ', license: unknown)' || chr(10) || chr(10) || code) AS assistant_sha256 FROM p WHERE code <> ''""")
def recipe_code_header(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select("page_id", F.col("html").alias("content"), F.regexp_extract("url", "^[a-z]+://([^/]+)", 1).alias("repo_name"), F.regexp_replace("url", "^[a-z]+://[^/]+/", "").alias("path"))
    done = recipes.code_files(pages, keep=["page_id"]).select("page_id", *_texts())
    return done.select("page_id", "user_text", F.sha2("assistant_text", 256).alias("assistant_sha256"))


@query("""SELECT n_nationkey, 'What does the Linux ioctl ' || n_regionkey || ' do?' AS user_text, 'ioctl ' || n_regionkey || ': code=' || n_regionkey || ', n_nationkey=' || n_nationkey || ', name=' || n_name ||
  CASE WHEN r.r_regionkey IS NOT NULL THEN chr(10) || chr(10) || 'Handler: code=' || r.r_regionkey || ', r_name=' || r_name ELSE '' END AS assistant_text
FROM nation LEFT JOIN (SELECT * FROM region WHERE r_regionkey <> 2) r ON n_regionkey = r_regionkey""")
def recipe_keyvalue_left_join(spark, sf_dir):
    codes = table(spark, sf_dir, "nation").select(F.col("n_regionkey").alias("code"), "n_nationkey", F.col("n_name").alias("name"))
    handlers = table(spark, sf_dir, "region").where("r_regionkey <> 2").select(F.col("r_regionkey").alias("code"), "r_name", F.col("r_regionkey").alias("ord"))
    return recipes.code_handlers(codes, handlers, ("ioctl_code", "code", "name"), ["ord"], keep=["n_nationkey"]).select("n_nationkey", *_texts())


@query("""WITH f AS (SELECT p_partkey, p_size % 2 AS Result, list_filter([CASE WHEN p_size > 10 THEN 'SEND_SMS' END, CASE WHEN p_size > 20 THEN 'INTERNET' END, CASE WHEN p_size > 30 THEN 'CAMERA' END, CASE WHEN p_partkey % 3 = 0 THEN 'INSTALL_PACKAGES' END], lambda x: x IS NOT NULL) AS s FROM part)
SELECT p_partkey, 'Classify this Android app from its requested permissions:' || chr(10) || array_to_string(list_transform(s, lambda x: '- ' || x), chr(10)) AS user_text,
  'This app is ' || CASE WHEN Result = 1 THEN 'malware' ELSE 'benign' END || '. It requests ' || len(s) || ' permissions' || CASE WHEN list_contains(s, 'SEND_SMS') OR list_contains(s, 'CAMERA') THEN ', including the high-risk ones: ' || array_to_string(list_filter(s, lambda x: x <> 'INTERNET'), ', ') ELSE '' END || '.' AS assistant_text
FROM f WHERE len(s) > 0""")
def recipe_wide_flags(spark, sf_dir):
    one = lambda c: c.cast("int").cast("string")
    rows = table(spark, sf_dir, "part").select(
        "p_partkey", one(F.col("p_size") > 10).alias("SEND_SMS"), one(F.col("p_size") > 20).alias("INTERNET"), one(F.col("p_size") > 30).alias("CAMERA"), one(F.col("p_partkey") % 3 == 0).alias("INSTALL_PACKAGES"), (F.col("p_size") % 2).cast("string").alias("Result")
    )
    return recipes.wide_flags(rows, ["SEND_SMS", "INTERNET", "CAMERA", "INSTALL_PACKAGES"], "Result", keep=["p_partkey"]).select("p_partkey", *_texts())


@query("""SELECT event_id, 'What was the ' || event_type || ' u' || user_id || ' economic event?' AS user_text, 'Impact: ' || event_type || '. Actual: ' || CASE WHEN user_id % 2 = 0 THEN 'a' || user_id ELSE 'n/a' END || ', Forecast: n/a, Previous: n/a.' AS assistant_text FROM events""")
def recipe_calendar(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select("event_id", F.col("event_type").alias("Currency"), F.concat(F.lit("u"), "user_id").alias("Event"), F.col("event_type").alias("Impact"), F.when(F.col("user_id") % 2 == 0, F.concat(F.lit("a"), "user_id")).alias("Actual"))
    return recipes.calendar(rows, keep=["event_id"]).select("event_id", *_texts())


@query("""SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN source || chr(10) || chr(10) || lang ELSE source END AS user_text, sha256(text) AS assistant_sha256 FROM documents""")
def recipe_instructions(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").select("doc_id", F.col("source").alias("instruction"), F.when(F.col("doc_id") % 2 == 0, F.col("lang")).alias("input"), F.col("text").alias("output"))
    return recipes.instructions(rows, keep=["doc_id"]).select("doc_id", *_texts()).select("doc_id", "user_text", F.sha2("assistant_text", 256).alias("assistant_sha256"))


@query("""SELECT p_partkey, 'What does this Linux kernel assembly for ' || CASE WHEN p_size > 25 THEN p_brand ELSE 'this function' END || ' (unknown file) do?' || chr(10) || chr(10) || p_name AS user_text, p_type || CASE WHEN p_size % 2 = 0 THEN chr(10) || chr(10) || 'Commit: c' || p_size ELSE '' END AS assistant_text FROM part""")
def recipe_assembly(spark, sf_dir):
    rows = table(spark, sf_dir, "part").select("p_partkey", F.col("p_name").alias("asm"), F.col("p_type").alias("explanation"), F.when(F.col("p_size") > 25, F.col("p_brand")).alias("func_name"), F.when(F.col("p_size") % 2 == 0, F.concat(F.lit("c"), "p_size")).alias("commit_message"))
    return recipes.assembly(rows, keep=["p_partkey"]).select("p_partkey", *_texts())


@query("""SELECT o_orderkey, 'Review this change in ' || CASE WHEN o_orderkey % 2 = 0 THEN 'a pull request' ELSE o_orderpriority END || ' (unknown file, ' || o_orderstatus || ').' || chr(10) || chr(10) || o_orderpriority AS user_text,
'Comment type: None. Author: ' || o_custkey || '. Line ' || (o_orderkey % 100) || '.' || CASE WHEN o_orderkey % 3 = 0 THEN chr(10) || chr(10) || 'Suggested after:' || chr(10) || 'fix ' || o_custkey ELSE '' END AS assistant_text FROM orders""")
def recipe_code_review(spark, sf_dir):
    k = F.col("o_orderkey")
    rows = table(spark, sf_dir, "orders").select(
        "o_orderkey", F.col("o_orderpriority").alias("before_code"), F.when(k % 3 == 0, F.concat(F.lit("fix "), "o_custkey")).alias("after_code"), F.when(k % 2 == 0, "").otherwise(F.col("o_orderpriority")).alias("pr_title"), F.col("o_orderstatus").alias("language"), F.col("o_custkey").cast("string").alias("author_username"), (k % 100).cast("string").alias("comment_line")
    )
    return recipes.code_reviews(rows, keep=["o_orderkey"]).select("o_orderkey", *_texts())


@query(r"""SELECT p_partkey, 'Analyze this Linux kernel commit for vulnerability relevance and explain the change.' || chr(10) || chr(10) || 'Subject: ' || p_name || CASE WHEN p_size % 2 = 0 THEN chr(10) || chr(10) || 'Body:' || chr(10) || p_type ELSE '' END AS user_text,
p_name || chr(10) || chr(10) || 'Commit h' || p_partkey || ' by ' || CASE WHEN p_size > 25 THEN p_brand ELSE 'unknown' END || ' (' || p_size || ' file(s), +?/-?).' || chr(10) || chr(10) || 'diff ' || p_brand AS assistant_text FROM part WHERE p_partkey % 3 > 0
UNION ALL SELECT p_partkey, 'Explain this kernel vulnerability record.', '{"note":"' || p_name || '"}' FROM part WHERE p_partkey % 3 = 0""")
def recipe_commits(spark, sf_dir):
    """Commits with a diff, and records of other keys as their JSON."""
    k = F.col("p_partkey")
    commit = F.struct(F.col("p_name").alias("subject"), F.when(F.col("p_size") % 2 == 0, F.col("p_type")).alias("body"), F.concat(F.lit("diff "), "p_brand").alias("diff_raw"), F.concat(F.lit("h"), k).alias("hash"), F.when(F.col("p_size") > 25, F.col("p_brand")).alias("author_name"), F.col("p_size").alias("files_changed"))
    rows = table(spark, sf_dir, "part").select("p_partkey", F.when(k % 3 > 0, F.to_json(commit)).otherwise(F.to_json(F.struct(F.col("p_name").alias("note")))).alias("raw"))
    return recipes.commits(rows, keep=["p_partkey"]).select("p_partkey", *_texts())


@query(r"""SELECT p_partkey, CASE k WHEN 0 THEN 'How do you fix this kernel crash?' || chr(10) || chr(10) || p_name || chr(10) || '(subsystem: ' || CASE WHEN p_size > 25 THEN p_brand ELSE 'unknown subsystem' END || ')' || chr(10) || chr(10) || 'oops ' || p_type
  WHEN 1 THEN 'How do you fix this kernel crash?' || chr(10) || chr(10) || p_name WHEN 2 THEN 'q' || p_partkey ELSE 'How do you fix this kernel crash?' END AS user_text,
CASE k WHEN 0 THEN 'note ' || p_type || chr(10) || chr(10) || 'diff ' || p_size || chr(10) || chr(10) || '(patch went through ' || p_size || ' revisions.)' WHEN 1 THEN 'patch ' || p_brand WHEN 2 THEN 'a' || p_size ELSE '{"other":"' || p_name || '"}' END AS assistant_text FROM (SELECT *, p_partkey % 4 AS k FROM part)""")
def recipe_crashes(spark, sf_dir):
    """Crash reports with their patches, crash and fix pairs, message lists, and other records."""
    k = F.col("p_partkey") % 4
    report = F.struct(F.col("p_name").alias("title"), F.when(F.col("p_size") > 25, F.col("p_brand")).alias("subsystem"), F.concat(F.lit("oops "), "p_type").alias("crash_report"), F.concat(F.lit("note "), "p_type").alias("fix_commit_message"), F.concat(F.lit("diff "), "p_size").alias("final_patch_diff"), F.col("p_size").alias("num_patch_versions"))
    pair = F.struct(F.col("p_name").alias("bug"), F.concat(F.lit("patch "), "p_brand").alias("fix"))
    turn = lambda who, c: F.struct(F.lit(who).alias("role"), c.alias("content"))
    chat = F.struct(F.array(turn("human", F.concat(F.lit("q"), "p_partkey")), turn("gpt", F.concat(F.lit("a"), "p_size"))).alias("messages"))
    raw = F.when(k == 0, F.to_json(report)).when(k == 1, F.to_json(pair)).when(k == 2, F.to_json(chat)).otherwise(F.to_json(F.struct(F.col("p_name").alias("other"))))
    return recipes.crashes(table(spark, sf_dir, "part").select("p_partkey", raw.alias("raw")), keep=["p_partkey"]).select("p_partkey", *_texts())


@query("""WITH r AS (SELECT conv_id, string_agg(role || chr(31) || text, chr(30) ORDER BY turn) AS x FROM conversations WHERE role IN ('system', 'user', 'assistant') AND text <> '' GROUP BY conv_id) SELECT conv_id, sha256(x) AS sha256 FROM r""")
def recipe_agent_sessions(spark, sf_dir):
    """Messages as JSON text inside the record, in every second one as a list; turns of another role are skipped."""
    from ..functions.text import canonical_text

    rows = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", F.upper("role").alias("role"), F.col("text").alias("content")))).alias("t"))
    turns = F.concat(F.transform("t", lambda t: F.struct(t["role"].alias("role"), t["content"].alias("content"))), F.array(F.struct(F.lit("narrator").alias("role"), F.lit("n").alias("content"))))
    raw = F.when(F.col("conv_id") % 2 == 0, F.to_json(F.struct(turns.alias("messages")))).otherwise(F.to_json(F.struct(F.to_json(turns).alias("messages"))))
    done = recipes.agent_sessions(rows.select("conv_id", raw.alias("raw")), keep=["conv_id"])
    return done.select("conv_id", F.sha2(canonical_text(F.col("messages")), 256).alias("sha256"))


@query(r"""SELECT 'Review this ' || p_brand || ' code for security vulnerabilities and fix it.' || chr(10) || chr(10) || p_name AS user_text, CASE WHEN p_size % 2 = 0 THEN 'CWE-' || p_size ELSE 'unknown CWE' END || CASE WHEN p_size > 25 THEN ' (A0' || (p_size % 9) || ')' ELSE '' END || chr(10) || chr(10) || 'Fixed code:' || chr(10) || p_type AS assistant_text FROM part
UNION ALL SELECT 'Which vulnerability class does this code exhibit?' || chr(10) || chr(10) || s_name, 's' || s_nationkey FROM supplier
UNION ALL SELECT 'q' || n_nationkey, n_name FROM nation""")
def recipe_security_union(spark, sf_dir):
    """Fix pairs, labelled code and chats in one corpus."""
    size = F.col("p_size")
    fixes = table(spark, sf_dir, "part").select(F.col("p_name").alias("code"), F.col("p_type").alias("code_fixed"), F.col("p_brand").alias("language"), F.when(size % 2 == 0, F.concat(F.lit("CWE-"), size)).alias("cwe_id"), F.when(size > 25, F.concat(F.lit("A0"), size % 9)).alias("owasp"))
    labels = table(spark, sf_dir, "supplier").select(F.col("s_name").alias("code"), F.concat(F.lit("s"), "s_nationkey").alias("label"))
    turn = lambda who, c: F.struct(F.lit(who).alias("role"), c.alias("content"))
    chats = table(spark, sf_dir, "nation").select(F.to_json(F.struct(F.array(turn("user", F.concat(F.lit("q"), "n_nationkey")), turn("assistant", F.col("n_name"))).alias("messages"))).alias("raw"))
    return recipes.security_union(fixes, labels, chats, "s").select(*_texts())


@query("""SELECT c_custkey, 'question of ' || c_name AS user_text, CASE WHEN c_custkey % 4 > 0 THEN 'answer ' || c_mktsegment ELSE 'x' END AS assistant_text FROM customer""")
def recipe_fuzzy_questions(spark, sf_dir):
    rows = table(spark, sf_dir, "customer").select("c_custkey", F.concat(F.lit("question of "), "c_name").alias("My Question"), F.when(F.col("c_custkey") % 4 > 0, F.concat(F.lit("answer "), "c_mktsegment")).alias("Final Answer"), F.lit("x").alias("Other answer"))
    return recipes.fuzzy_questions(rows, keep=["c_custkey"]).select("c_custkey", *_texts())


@query("""SELECT page_id, 'mit' AS repo, CASE WHEN page_id % 3 = 0 THEN 'Show me the MQL5 header for f' || page_id || ' from repo.' WHEN page_id % 3 = 1 THEN 'Write an MQL5 EA or script that implements f' || page_id || ' (from repo).' ELSE 'What does the MQL5 project repo do, and how is it used?' END AS user_text FROM pages WHERE page_id % 5 > 0""")
def recipe_repo_sources(spark, sf_dir):
    k = F.col("page_id")
    path = F.when(k % 3 == 0, F.concat(F.lit("src/f"), k, F.lit(".mqh"))).when(k % 3 == 1, F.concat(F.lit("f"), k, F.lit(".MQ5"))).otherwise("docs/README.md")
    files = table(spark, sf_dir, "pages").select("page_id", path.alias("path"), F.col("html").alias("body"), F.when(k % 5 > 0, "owner__repo").otherwise("old__repo").alias("repo"))
    old = spark.createDataFrame([("old__repo",)], "repo string")
    return recipes.repo_sources(files, exclude=old, keep=["page_id"]).select("page_id", F.lit("mit").alias("repo"), F.col("messages")[0]["content"].alias("user_text"))


@query("""SELECT page_id, CASE WHEN page_id % 4 = 0 THEN 'How do I configure m' || page_id || ' for the Galaxy A04s (device/samsung/a04s/m' || page_id || '.mk)?' WHEN page_id % 4 = 1 THEN 'Show me the C source for m' || page_id || '.  (path: drivers/m' || page_id || '.c)' ELSE 'Show me the Exynos850 kernel driver for m' || page_id || ' (kernel/samsung/exynos850/m' || page_id || '.h).' END AS user_text
FROM pages WHERE page_id % 4 < 3 AND length(html) <= 5000""")
def recipe_tree_sources(spark, sf_dir):
    k = F.col("page_id")
    path = F.when(k % 4 == 0, F.concat(F.lit("device/samsung/a04s/m"), k, F.lit(".mk"))).when(k % 4 == 1, F.concat(F.lit("drivers/m"), k, F.lit(".c"))).when(k % 4 == 2, F.concat(F.lit("kernel/samsung/exynos850/m"), k, F.lit(".h"))).otherwise("x.bin")
    files = table(spark, sf_dir, "pages").select("page_id", path.alias("path"), F.col("html").alias("body"))
    return recipes.tree_sources(files, 5000, keep=["page_id"]).select("page_id", F.col("messages")[0]["content"].alias("user_text"))


# -- joins, gates and plans -----------------------------------------------------------------------


@query("SELECT doc_id, coalesce('q' || quality, 'uncategorized') AS category FROM documents LEFT JOIN labels USING (doc_id)")
def join_category_default(spark, sf_dir):
    lookup = table(spark, sf_dir, "labels").select("doc_id", F.concat(F.lit("q"), "quality").alias("category"))
    return joins.with_default(table(spark, sf_dir, "documents").select("doc_id"), lookup, "doc_id", "category", "uncategorized")


@query("SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def join_on_disk_anti(spark, sf_dir):
    return joins.missing_from(table(spark, sf_dir, "documents").select("doc_id"), table(spark, sf_dir, "labels"), "doc_id")


@query("""SELECT source, e.reason AS exclusion, count(*) AS n FROM documents LEFT JOIN (VALUES ('src1', 'prompts only'), ('src4', 'no answers')) e(source, reason) USING (source) GROUP BY ALL""")
def join_exclusion_reason(spark, sf_dir):
    listed = spark.createDataFrame([("src1", "prompts only"), ("src4", "no answers")], "source string, reason string")
    marked = validate.excluded_by(table(spark, sf_dir, "documents").select("source"), listed, "source")
    return marked.groupBy("source", "exclusion").agg(F.count("*").alias("n"))


_SKIP = "CASE WHEN o_custkey % 50 = 0 THEN 'skip list: policy' WHEN o_orderpriority = '1-URGENT' AND o_custkey % 3 = 0 THEN 'not_found' WHEN o_custkey % 11 = 0 THEN 'gated' WHEN o_totalprice > 300000 THEN 'too_large (' || round(o_totalprice)::BIGINT || ')' WHEN o_totalprice < 20000 THEN 'too_small (' || round(o_totalprice)::BIGINT || ')' WHEN o_orderkey % 7 = 0 THEN 'already_downloaded' ELSE 'ok' END"


@query(f"SELECT CASE WHEN r = 'ok' THEN 'download' ELSE 'skip' END AS action, trim(string_split(string_split(r, ' (')[1], ':')[1]) AS reason, count(*) AS n, sum(size)::BIGINT AS bytes FROM (SELECT {_SKIP} AS r, round(o_totalprice)::BIGINT AS size FROM orders) GROUP BY ALL")
def plan_decisions(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    size = F.col("o_totalprice")
    c = {
        "skip_reason": F.when(F.col("o_custkey") % 50 == 0, "policy"), "status": F.when((F.col("o_orderpriority") == "1-URGENT") & (F.col("o_custkey") % 3 == 0), "not_found").otherwise("ok"), "gated": F.col("o_custkey") % 11 == 0,
        "api_bytes": F.when(F.col("o_orderkey") % 2 == 0, size), "declared_bytes": size, "on_disk": F.col("o_orderkey") % 7 == 0,
    }
    planned = o.select(validate.download_action(c, 20_000, 300_000).alias("p"), F.round(size).cast("long").alias("size"))
    return planned.groupBy(F.col("p.action").alias("action"), validate.reason_group(F.col("p.reason")).alias("reason")).agg(F.count("*").alias("n"), F.sum("size").alias("bytes"))


@query("""SELECT s_suppkey, concat_ws(',', CASE WHEN s_acctbal < 2000 THEN 'low_downloads' END, CASE WHEN s_nationkey % 4 = 0 THEN 'no_license' END, CASE WHEN s_suppkey % 5 = 0 THEN 'no_readme' END, CASE WHEN s_suppkey % 7 = 0 THEN 'no_data_files' END) AS reasons,
  concat_ws(',', CASE WHEN s_suppkey % 6 = 0 THEN 'gated' END, CASE WHEN s_acctbal > 8000 THEN 'dataset_too_large' END, CASE WHEN s_acctbal > 9000 THEN 'file_too_large' END) AS guards FROM supplier""")
def gate_reasons(spark, sf_dir):
    k = F.col("s_suppkey")
    gate = validate.hub_gate(F.col("s_acctbal"), F.when(F.col("s_nationkey") % 4 != 0, "mit"), k % 5 != 0, k % 7, 2000)
    guards = validate.size_guards(k % 6 == 0, F.col("s_acctbal"), F.col("s_acctbal") - 1000, 8000, 8000)
    return table(spark, sf_dir, "supplier").select("s_suppkey", F.array_join(gate, ",").alias("reasons"), F.array_join(guards, ",").alias("guards"))


@query("""SELECT c_custkey, concat_ws(',', CASE WHEN c_acctbal < 1000 THEN 'low_stars' END, CASE WHEN c_nationkey % 5 = 0 THEN 'no_license' END, CASE WHEN c_custkey % 9 = 0 THEN 'no_description' END, CASE WHEN c_custkey % 8 = 0 THEN 'archived' END, CASE WHEN c_custkey % 10 = 0 THEN 'fork' END, CASE WHEN c_acctbal > 9000 THEN 'too_large' END, CASE WHEN contains(lower(c_mktsegment), 'auto') THEN 'policy_query' END) AS reasons FROM customer""")
def search_gate_reasons(spark, sf_dir):
    k = F.col("c_custkey")
    found = validate.search_gate(F.col("c_acctbal"), F.when(F.col("c_nationkey") % 5 != 0, "mit"), F.when(k % 9 != 0, "d"), k % 8 == 0, k % 10 == 0, F.col("c_acctbal"), F.col("c_mktsegment"), 1000, 9000, ("auto",))
    return table(spark, sf_dir, "customer").select("c_custkey", F.array_join(found, ",").alias("reasons"))


@query("SELECT user_id, max(value) AS value, array_to_string(list_sort(list(DISTINCT event_type)), ',') AS reasons, count(*) AS hits FROM events GROUP BY user_id")
def candidate_merge(spark, sf_dir):
    found = profile.merged_hits(table(spark, sf_dir, "events"), "user_id", "value", "event_type")
    return found.select("user_id", "value", F.array_join("reasons", ",").alias("reasons"), "hits")


@query("SELECT user_id, max(value) AS value FROM events GROUP BY user_id HAVING max(value) >= 10 ORDER BY value DESC, user_id LIMIT 400")
def top_candidates(spark, sf_dir):
    merged = profile.merged_hits(table(spark, sf_dir, "events").where("value >= 10"), "user_id", "value", "event_type")
    return windows.head(merged.select("user_id", "value"), 400, [F.col("value").desc(), "user_id"])


@query("""WITH k AS (SELECT event_type, unnest(json_keys(props)) AS key FROM events), u AS (SELECT event_type, array_to_string(list_sort(list(DISTINCT key)), ',') AS keys FROM k GROUP BY event_type)
SELECT event_type, keys, 'unknown' AS family FROM u""")
def survey_keys_family(spark, sf_dir):
    found = profile.key_union(table(spark, sf_dir, "events"), "props", ["event_type"])
    return found.select("event_type", F.array_join("keys", ",").alias("keys"), validate.schema_family(F.col("keys")).alias("family"))


@query("""WITH r AS (SELECT event_type, props, row_number() OVER (PARTITION BY event_type ORDER BY event_id) AS k FROM events), s AS (SELECT * FROM r WHERE k <= 3),
c AS (SELECT event_type, count(*) AS sampled FROM s GROUP BY event_type), u AS (SELECT DISTINCT event_type, unnest(json_keys(props)) AS key FROM s)
SELECT event_type, sampled, (SELECT array_to_string(list_sort(list(key)), ',') FROM u WHERE u.event_type = c.event_type) AS keys FROM c""")
def survey_samples(spark, sf_dir):
    found = profile.survey_rows(table(spark, sf_dir, "events"), "props", ["event_type"], ["event_id"])
    return found.select("event_type", "sampled", F.array_join("keys", ",").alias("keys"))


@query("""WITH f AS (SELECT user_id, event_id, CASE WHEN event_id % 3 = 0 THEN 'chat' WHEN event_id % 3 = 1 THEN 'text_only' ELSE 'unknown' END AS family FROM events),
c AS (SELECT user_id, family, count(*) AS n, min(event_id) AS first FROM f GROUP BY ALL)
SELECT user_id, family, files FROM (SELECT user_id, family, sum(n) OVER (PARTITION BY user_id)::BIGINT AS files, row_number() OVER (PARTITION BY user_id ORDER BY n DESC, first) AS k FROM c) WHERE k = 1""")
def family_vote(spark, sf_dir):
    keys = F.when(F.col("event_id") % 3 == 0, F.array(F.lit("messages"))).when(F.col("event_id") % 3 == 1, F.array(F.lit("text"))).otherwise(F.array(F.lit("z")))
    files = table(spark, sf_dir, "events").select("user_id", F.col("event_id").alias("file_ord"), validate.schema_family(keys).alias("family"))
    return profile.family_vote(files, ["user_id"])


@query("""SELECT doc_id, CASE doc_id % 5 WHEN 0 THEN 'classification only' WHEN 1 THEN 'raw corpus' END AS why FROM documents""")
def exclusion_heuristics(spark, sf_dir):
    k = F.col("doc_id") % 5
    keys = F.when(k == 0, F.array(F.lit("Text"), F.lit("label"))).when(k == 1, F.array(F.lit("text"), F.lit("id"))).when(k == 2, F.array(F.lit("prompt"), F.lit("label"))).when(k == 3, F.array(F.lit("messages"))).otherwise(F.array(F.lit("question"), F.lit("answer")))
    return table(spark, sf_dir, "documents").select("doc_id", validate.exclusion_heuristic(keys).alias("why"))


@query("""SELECT event_type, count(*) FILTER (user_id % 3 = 0) AS ok, count(*) FILTER (user_id % 3 = 1) AS skipped, count(*) FILTER (user_id % 3 = 2) AS failed, coalesce(sum(event_id) FILTER (user_id % 3 = 0), 0)::BIGINT AS bytes FROM events GROUP BY event_type""")
def status_counters(spark, sf_dir):
    k = F.col("user_id") % 3
    log = table(spark, sf_dir, "events").select("event_type", F.when(k == 0, "ok").when(k == 1, "skipped").otherwise("failed").alias("action"), F.col("event_id").alias("bytes"))
    return profile.status_counters(log, ["event_type"])


@query(f"SELECT trim(string_split(string_split(r, ' (')[1], ':')[1]) AS reason, count(*) AS n FROM (SELECT {_SKIP} AS r FROM orders) WHERE r <> 'ok' GROUP BY ALL")
def skip_histogram(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    size = F.col("o_totalprice")
    c = {"skip_reason": F.when(F.col("o_custkey") % 50 == 0, "policy"), "status": F.when((F.col("o_orderpriority") == "1-URGENT") & (F.col("o_custkey") % 3 == 0), "not_found"), "gated": F.col("o_custkey") % 11 == 0, "api_bytes": size, "declared_bytes": size, "on_disk": F.col("o_orderkey") % 7 == 0}
    planned = o.select(validate.download_action(c, 20_000, 300_000).alias("p")).where("p.action = 'skip'")
    return profile.skip_histogram(planned.select(F.col("p.reason").alias("reason")))


@query("""SELECT url, contains(url, 'https://') AND starts_with(url, 'https://') AS priority FROM pages ORDER BY starts_with(url, 'https://') DESC, url LIMIT 60""")
def priority_walk_query(spark, sf_dir):
    found = priority_walk(table(spark, sf_dir, "pages").select("url"), ("https://",), 60, "url")
    return found.select("url", is_priority(F.col("url"), ("https://",)).alias("priority"))


QUERIES["priority_walk"] = QUERIES.pop("priority_walk_query")
ORACLES["priority_walk"] = ORACLES.pop("priority_walk_query")


@query(r"""SELECT lower(regexp_extract(string_split(regexp_replace(url, '[?#].*$', ''), '/')[-1], '^.+(\.[^.]+)$', 1)) AS suffix, count(*) AS n FROM pages GROUP BY ALL ORDER BY n DESC, suffix LIMIT 8""")
def suffix_histogram(spark, sf_dir):
    return profile.suffix_histogram(table(spark, sf_dir, "pages").select(F.regexp_replace("url", "[?#].*$", "").alias("path")))


@query("""SELECT lang, count(*) AS n, CASE WHEN count(*) >= 1000000 THEN '1M<n' WHEN count(*) >= 100000 THEN '100K<n<1M' WHEN count(*) >= 10000 THEN '10K<n<100K' ELSE 'n<10K' END AS bucket,
  CASE lang WHEN 'en' THEN 'mit' WHEN 'de' THEN 'apache-2.0' WHEN 'fr' THEN 'cc-by-sa-4.0' ELSE 'other' END AS license FROM documents GROUP BY lang""")
def license_size_bucket(spark, sf_dir):
    named = F.when(F.col("lang") == "en", "MIT").when(F.col("lang") == "de", "apache-2.0-with-exception").when(F.col("lang") == "fr", "CC-BY-SA-4.0").otherwise("custom")
    counts = table(spark, sf_dir, "documents").groupBy("lang").agg(F.count("*").alias("n"))
    return counts.select("lang", "n", validate.size_bucket(F.col("n")).alias("bucket"), validate.license_family(named).alias("license"))


@query("""SELECT l_orderkey, l_linenumber, (l_partkey - l_suppkey) AS gap FROM lineitem WHERE l_partkey > 1.35 * l_suppkey""")
def size_gaps(spark, sf_dir):
    return profile.size_gaps(table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"), "l_partkey", "l_suppkey").select("l_orderkey", "l_linenumber", "gap")


@query("SELECT DISTINCT 'src' || (doc_id % 30) AS id FROM documents WHERE 'src' || (doc_id % 30) NOT IN (SELECT source FROM documents)")
def list_append(spark, sf_dir):
    from ..sources.sinks import new_ids

    docs = table(spark, sf_dir, "documents")
    return new_ids(docs.select(F.concat(F.lit("src"), F.col("doc_id") % 30).alias("id")), docs.select(F.col("source").alias("id")))


@query("""SELECT p_partkey, CASE p_size % 4 WHEN 0 THEN p_size WHEN 1 THEN p_size * 1024 WHEN 2 THEN (p_size || '.5')::DOUBLE * 1048576 ELSE NULL END::BIGINT AS bytes FROM part""")
def size_text_bytes(spark, sf_dir):
    k = F.col("p_size")
    text = F.when(k % 4 == 0, F.concat(F.lit("about "), k, F.lit(" B"))).when(k % 4 == 1, F.concat(k, F.lit("kb"))).when(k % 4 == 2, F.concat(F.lit("~"), k, F.lit(".5 MB, zipped"))).otherwise("large")
    return table(spark, sf_dir, "part").select("p_partkey", size_bytes(text).alias("bytes"))


@query("SELECT lang, min_rows, n FROM (SELECT lang, 30 AS min_rows, count(*) AS n FROM documents WHERE lang IN ('en', 'de') GROUP BY lang)")
def category_filter(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").where(F.col("lang").isin("en", "de"))
    return rows.groupBy("lang").agg(F.count("*").alias("n")).select("lang", F.lit(30).alias("min_rows"), "n")


@query(_DOC + "SELECT split, count(*) AS n, sum(total)::BIGINT AS chars FROM s WHERE reject IS NULL GROUP BY split")
def corpus_line_counts(spark, sf_dir):
    done = _doc_annotated(spark, sf_dir).where("reject is null")
    return done.groupBy("split").agg(F.count("*").alias("n"), F.sum("total_chars").alias("chars"))


@query("SELECT label, count(*) AS n, min(len(embedding)) AS least, max(len(embedding)) AS most FROM embeddings GROUP BY label")
def vector_profile(spark, sf_dir):
    return table(spark, sf_dir, "embeddings").groupBy("label").agg(F.count("*").alias("n"), F.min(F.size("embedding")).cast("long").alias("least"), F.max(F.size("embedding")).cast("long").alias("most"))


@query()
def conv_strict_keys(spark, sf_dir):
    return corpus.strict_keys(_conv(spark, sf_dir)).select("conv_id", "strict_key")


@query()
def conv_canonical_json(spark, sf_dir):
    return corpus.canonical_json(_conv(spark, sf_dir)).select("conv_id", "line")


