"""Record adapters: raw records of several shapes to canonical messages.

Each adapter is a Column over a VARIANT (or plain columns) giving array<struct<role, content>>,
an empty array for a record that has a message list without content, or null if it does not apply.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import variant as V
from ..functions.text import first_truthy, message, normalize, record, role, strip

MESSAGES = "array<struct<role:string,content:string>>"

# Aliases in the order in which they are tried.
PROMPT_ALIASES = (
    "instruction", "instructions", "prompt", "question", "query", "input", "task", "problem", "request", "human", "user",
    "Open-ended Verifiable Question", "Question Text",
)
RESPONSE_ALIASES = (
    "output", "response", "answer", "completion", "solution", "assistant", "gpt", "target", "Response", "Gold Answer",
    "Complex_CoT", "Reasonings", "self_answer", "raw_response",
)
MESSAGE_KEYS = ("messages", "conversations", "conversation", "dialog", "dialogue", "chat", "trace", "content")
#: Of these, an empty list marks the record as empty.
EMPTY_KEYS = MESSAGE_KEYS[:3]
#: Datasets whose files are conversations as a whole, with the mode of file_conversations(). Fixed values.
FILE_MODES = {"mondk/agentic-coding-traces": "session", "HydraLM/python-code-instructions-18k-alpaca-standardized": "grouped"}
ROLE_KEYS = ("role", "from", "message_type")
CONTENT_KEYS = ("content", "message", "value")


def no_messages() -> Column:
    return F.array().cast(MESSAGES)


def _first_present(v: Column, names: tuple[str, ...]) -> Column:
    return F.coalesce(*(V.key(v, n) for n in names))


def list_messages(v: Column) -> Column:
    """A list of turn objects. Null if a turn is no object or has an unknown role, or nothing remains."""

    def turn(x: Column) -> Column:
        return F.struct((V.kind(x) == "object").alias("ok"), role(V.text_of(_first_present(x, ROLE_KEYS))).alias("role"), normalize(V.content_text(_first_present(x, CONTENT_KEYS))).alias("content"))

    def checked(turns: Column) -> Column:
        bad = F.exists(turns, lambda t: ~F.coalesce(t["ok"], F.lit(False)) | (t["role"] == ""))
        kept = F.transform(F.filter(turns, lambda t: t["content"] != ""), lambda t: message(t["role"], t["content"]))
        return F.when(~bad, V.let(kept, lambda k: F.when(F.size(k) > 0, k)))

    return V.let(F.transform(V.items(v), turn), checked)


def message_keys(v: Column) -> Column:
    """The first of MESSAGE_KEYS whose list gives messages; an empty array if there are only empty ones."""

    def look(value: Column, counts_empty: Column) -> Column:
        objects = F.coalesce(V.kind(F.get(V.items(value), F.lit(0))) == "object", F.lit(False))
        hollow = counts_empty & F.coalesce(F.size(V.items(value)) == 0, F.lit(False))
        return F.struct(F.when(objects, list_messages(value)).alias("found"), (objects | hollow).alias("empty"))

    values = F.array(*(F.struct(V.key(v, n).alias("v"), F.lit(n in EMPTY_KEYS).alias("e")) for n in MESSAGE_KEYS))
    looked = F.transform(F.filter(values, lambda x: V.kind(x["v"]) == "array"), lambda x: look(x["v"], x["e"]))

    def choose(all_keys: Column) -> Column:
        found = F.get(F.filter(all_keys, lambda x: x["found"].isNotNull()), F.lit(0))["found"]
        return F.coalesce(found, F.when(F.exists(all_keys, lambda x: x["empty"]), no_messages()))

    return V.let(looked, choose)


def topical(v: Column) -> Column:
    """[id, {"content": [{"message", "agent"}]}]: unknown agents are user first and assistant after."""
    body = F.get(V.items(v), F.lit(1))
    shaped = (F.size(V.items(v)) == 2) & (V.kind(body) == "object") & (V.kind(V.key(body, "content")) == "array")
    turns = F.transform(V.items(V.key(body, "content")), lambda t: message(role(V.text_of(V.key(t, "agent"))), normalize(V.content_text(V.key(t, "message")))))
    spoken = F.filter(turns, lambda t: t["content"] != "")
    named = F.transform(spoken, lambda t, i: message(F.when(t["role"] != "", t["role"]).when(i == 0, "user").otherwise("assistant"), t["content"]))
    return F.when(shaped & (F.size(named) > 0), named)


def question_vars(v: Column) -> Column:
    q, a = V.get(v, "$.vars.question"), V.get(v, "$.vars.answer")
    return F.when(V.is_truthy(q) & V.is_truthy(a), record(None, V.normalize_value(q), V.normalize_value(a)))


def numbered(steps: Column) -> Column:
    """A numbered list of an array of texts; blanks are left out but keep their numbers."""
    lines = F.transform(steps, lambda s, i: F.when(normalize(s) != "", F.concat((i + 1).cast("string"), F.lit(". "), normalize(s))))
    return F.array_join(F.filter(lines, lambda x: x.isNotNull()), "\n")


def goal_steps(v: Column) -> Column:
    goal, steps = V.key(v, "goal"), V.key(v, "step_instructions")
    plan = numbered(F.transform(V.items(steps), V.text_of))
    return F.when(V.is_truthy(goal) & V.is_truthy(steps) & (F.coalesce(plan, F.lit("")) != ""), record(None, V.normalize_value(goal), plan))


def alias_pair(v: Column) -> Column:
    """The first truthy prompt and response; additional_instructions or input is appended if it differs."""

    def first(names: tuple[str, ...]) -> Column:
        return F.get(F.filter(F.array(*(V.key(v, n) for n in names)), V.is_truthy), F.lit(0))

    parts = F.struct(V.let(first(PROMPT_ALIASES), V.normalize_value).alias("user"), V.let(first(RESPONSE_ALIASES), V.normalize_value).alias("answer"), V.let(first(("additional_instructions", "input")), lambda m: F.when(V.kind(m) == "string", V.text_of(m))).alias("extra"))
    have = F.struct(first(PROMPT_ALIASES).isNotNull().alias("p"), first(RESPONSE_ALIASES).isNotNull().alias("r"))

    def pair(x: Column) -> Column:
        full = F.when((strip(x["extra"]) != "") & (strip(x["extra"]) != x["user"]), F.concat(x["user"], F.lit("\n\n"), normalize(x["extra"]))).otherwise(x["user"])
        return record(None, full, x["answer"])

    return F.when(have["p"] & have["r"], V.let(parts, pair))


def alias_pair_columns(df: DataFrame, prompts: tuple[str, ...] = PROMPT_ALIASES, answers: tuple[str, ...] = RESPONSE_ALIASES) -> Column:
    """alias_pair over flat text columns, so that scans stay columnar and pruned."""
    have = lambda names: [F.col(f"`{n}`") for n in names if n in df.columns] or [F.lit(None).cast("string")]
    prompt, answer = first_truthy(*have(prompts)), first_truthy(*have(answers))
    extra = strip(F.coalesce(first_truthy(*have(("additional_instructions", "input"))), F.lit("")))
    user = normalize(prompt)
    full = F.when((extra != "") & (extra != user), F.concat(user, F.lit("\n\n"), normalize(extra))).otherwise(user)
    return F.when(prompt.isNotNull() & answer.isNotNull(), record(None, full, normalize(answer)))


def from_record(v: Column) -> Column:
    """All adapters in order: topical lists, message lists, vars, goal and steps, alias pairs."""
    def chosen(listed: Column) -> Column:
        return F.coalesce(F.when(F.size(listed) > 0, listed), question_vars(v), goal_steps(v), alias_pair(v), listed)

    return F.when(V.kind(v) == "array", topical(v)).when(V.kind(v) == "object", V.let(message_keys(v), chosen))


def adapted_record(raw: Column) -> Column:
    """struct(messages, reject) of one raw JSON line: reject is malformed_json, unsupported_schema, or null.
    An unknown role inside a message list leaves an empty record, which validation rejects as empty."""

    def both(v: Column) -> Column:
        malformed = v.isNull() | V.key(v, "__malformed__").isNotNull()
        return V.let(F.when(~malformed, from_record(v)), lambda m: F.struct(m.alias("messages"), F.when(malformed, "malformed_json").when(m.isNull(), "unsupported_schema").alias("reject")))

    return V.let(V.parse(raw), both)


def adapted(raw: Column) -> tuple[Column, Column]:
    """(messages, reject) of adapted_record()."""
    found = adapted_record(raw)
    return found["messages"], found["reject"]


def session_turn(v: Column) -> Column:
    """The turn of one event of a session file; null for events that are no message of a user or an assistant."""
    said = V.let(F.struct(role(V.get(v, "$.message.role", "string")).alias("role"), normalize(V.content_text(V.get(v, "$.message.content"))).alias("content")), lambda m: F.when(m["role"].isin("user", "assistant") & (m["content"] != ""), m))
    return F.when(V.get(v, "$.type", "string") == "message", said)


def grouped_turn(v: Column) -> Column:
    """The turn of one row of a file of messages; null for an unknown role or an empty text."""
    turn = F.struct(role(V.text_of(V.key(v, "message_type"))).alias("role"), V.normalize_value(V.key(v, "message")).alias("content"))
    return V.let(turn, lambda m: F.when((m["role"] != "") & (m["content"] != ""), m))


def file_conversations(rows: DataFrame, by: list[str], order: list[str], mode: str, raw_col: str = "raw") -> DataFrame:
    """One conversation for each file: `by` and messages, null if the file has no turn. The mode says how the rows
    of a file are turns: 'session' in their order, 'grouped' by conversation_id and message_id, with adjacent user
    turns joined. Only turns are shuffled, not the rows."""
    v, place = V.parse(F.col(raw_col)), [F.col(c) for c in order]
    if mode == "grouped":
        number = F.coalesce(V.get(v, "$.message_id", "long"), F.lit(0))
        place = [F.coalesce(V.text_of(V.key(v, "conversation_id")), F.lit("")), number, *place]
        turn = F.when(V.kind(v) == "object", grouped_turn(v))
    else:
        turn = session_turn(v)
    known = rows.select(*by, F.struct(*(c.alias(f"_{i}") for i, c in enumerate(place))).alias("place"), turn.alias("turn"))
    kept = F.collect_list(F.when(F.col("turn").isNotNull(), F.struct("place", "turn")))
    turns = F.transform(F.array_sort("t"), lambda t: message(t["turn"]["role"], t["turn"]["content"]))
    said = known.groupBy(*by).agg(kept.alias("t")).select(*by, (merge_adjacent(turns) if mode == "grouped" else turns).alias("messages"))
    return said.withColumn("messages", F.when(F.size("messages") > 0, F.col("messages")))


def session_messages(rows: DataFrame, file_col: str = "file_path", line_col: str = "line_no", raw_col: str = "raw") -> DataFrame:
    """One conversation per session file: its events of type 'message' by a user or an assistant."""
    return file_conversations(rows, [file_col], [line_col], "session", raw_col).where("messages is not null")


def grouped_messages(rows: DataFrame, group_col: str, order_col: str, role_col: str, text_col: str) -> DataFrame:
    """One conversation per group, ordered; adjacent user turns are joined by a blank line."""
    turn = F.struct(F.col(order_col).alias("n"), role(F.col(role_col)).alias("role"), normalize(F.col(text_col)).alias("content"))
    kept = rows.select(F.col(group_col), turn.alias("t")).where((F.col("t.role") != "") & (F.col("t.content") != ""))
    ordered = kept.groupBy(group_col).agg(F.array_sort(F.collect_list("t")).alias("t"))
    return ordered.select(group_col, merge_adjacent(F.transform("t", lambda t: message(t["role"], t["content"]))).alias("messages"))


def merge_adjacent(messages: Column, who: str = "user") -> Column:
    def add(acc: Column, m: Column) -> Column:
        last = F.element_at(acc, -1)
        joined = F.concat(F.slice(acc, F.lit(1), F.size(acc) - 1), F.array(message(last["role"], F.concat(last["content"], F.lit("\n\n"), m["content"]))))
        return F.when((F.size(acc) > 0) & (m["role"] == who) & (F.try_element_at(acc, F.lit(-1))["role"] == who), joined).otherwise(F.concat(acc, F.array(m))).cast(MESSAGES)

    return F.aggregate(messages, no_messages(), add)


def merged_turns(rows: DataFrame, group_col: str, order_col: str, role_col: str, text_col: str, who: str = "user") -> DataFrame:
    """merge_adjacent as gaps and islands over rows, for conversations too long for one row:
    group, island, role, content, n_turns."""
    w = Window.partitionBy(group_col).orderBy(order_col)
    new = ~((F.col(role_col) == who) & (F.lag(role_col).over(w) == who))
    marked = rows.withColumn("_new", F.coalesce(new, F.lit(True)).cast("int")).withColumn("island", F.sum("_new").over(w) - 1)
    ordered = F.array_sort(F.collect_list(F.struct(order_col, text_col)))
    return marked.groupBy(group_col, "island").agg(F.first(role_col).alias("role"), F.array_join(F.transform(ordered, lambda t: t[text_col]), "\n\n").alias("content"), F.count("*").alias("n_turns"))


def strict(messages: Column) -> Column:
    """Lower-cased roles and stripped texts; null if a role is unknown or a text is empty."""
    clean = F.transform(messages, lambda m: message(F.lower(strip(m["role"])), strip(m["content"])))
    bad = F.exists(clean, lambda m: ~m["role"].isin("system", "user", "assistant", "tool") | (m["content"] == "") | m["content"].isNull())
    return F.when(~bad, clean)


def instruction_record(df: DataFrame) -> Column:
    """The older training shape: messages as they are, else instruction or prompt, input and output."""
    have = lambda n: F.col(n) if n in df.columns else F.lit(None).cast("string")
    user = F.coalesce(first_truthy(have("instruction"), have("prompt")), F.lit(""))
    more = F.coalesce(have("input"), F.lit(""))
    pair = record(None, F.when(more != "", F.concat(user, F.lit("\n"), more)).otherwise(user), F.coalesce(have("output"), F.lit("")))
    return F.coalesce(F.col("messages"), pair) if "messages" in df.columns else pair
