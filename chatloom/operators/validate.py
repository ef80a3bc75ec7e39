"""Validation with a reject taxonomy, contract checks and gates."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import dedup_key, message, normalize, split_of, total_chars

# Reject reasons in reporting order.
REJECTS = ("too_short", "too_long", "empty", "missing_field", "malformed_json", "unsupported_schema", "duplicate", "template_mismatch")
ROLES = ("system", "user", "assistant", "tool")
MIN_CHARS, MAX_CHARS, VAL_FRACTION, SEED = 32, 64_000, 0.02, 42


def cleaned(messages: Column) -> Column:
    """Normalised turns without the empty ones."""
    turns = F.transform(messages, lambda m: message(m["role"], normalize(m["content"])))
    return F.filter(turns, lambda m: m["content"] != "")


def reject_reason(messages: Column, clean: Column, min_chars: int = MIN_CHARS, max_chars: int = MAX_CHARS, roles: tuple = ROLES) -> Column:
    """The first rule that a conversation breaks, or null. max_chars 0: no upper bound."""
    first_system = F.coalesce(F.get(clean, F.lit(0))["role"] == "system", F.lit(False))
    body = F.when(first_system, F.slice(clean, F.lit(2), F.greatest(F.size(clean) - 1, F.lit(0)))).otherwise(clean)
    has = lambda who: F.exists(body, lambda m: m["role"] == who)
    total = total_chars(clean)
    reason = (
        F.when(F.exists(messages, lambda m: ~F.coalesce(m["role"].isin(*roles), F.lit(False))), "unsupported_schema")
        .when(F.size(clean) == 0, "empty")
        .when(~has("user") | ~has("assistant"), "missing_field")
        .when(total < min_chars, "too_short")
    )
    return reason.when(total > max_chars, "too_long") if max_chars else reason


def annotate(
    records: DataFrame, order: list[str], scope: list[str] | None = None, min_chars: int = MIN_CHARS, max_chars: int = MAX_CHARS, val_fraction: float = VAL_FRACTION, seed: int = SEED, dedup: bool = True, early: str | None = None
) -> DataFrame:
    """records with `messages` to annotated records: messages (cleaned), n_messages, total_chars, reject,
    dedup_key, is_dup, split. order: columns that say which of equal records comes first; scope: columns
    within which equal records are duplicates; early: a column with reject reasons found before."""
    from .dedup import mark_duplicates

    raw = records.withColumnRenamed("messages", "_given").withColumn("_raw", F.coalesce("_given", F.array().cast("array<struct<role:string,content:string>>")))
    # The generator keeps the columns below from normalising the texts again, each for itself.
    clean = raw.select("*", F.inline(F.array(F.struct(cleaned(F.col("_raw")).alias("messages"))))).drop("_given")
    clean = clean.select(*records.columns, "_raw")
    reason = reject_reason(F.col("_raw"), F.col("messages"), min_chars, max_chars)
    if early:
        reason = F.coalesce(F.col(early), reason)
    ready = clean.withColumn("reject", reason).withColumn("n_messages", F.size("messages")).withColumn("total_chars", total_chars(F.col("messages")))
    keyed = ready.drop("_raw", *([early] if early and early != "reject" else [])).withColumn("dedup_key", F.when(F.col("reject").isNull(), dedup_key(F.col("messages"), seed)))
    marked = mark_duplicates(keyed, "dedup_key", order, scope or []) if dedup else keyed.withColumn("is_dup", F.lit(False))
    return marked.withColumn("reject", F.when(F.col("is_dup"), "duplicate").otherwise(F.col("reject"))).withColumn("split", F.when(F.col("reject").isNull(), split_of(F.col("dedup_key"), val_fraction)))


def reject_counts(annotated: DataFrame, by: list[str]) -> DataFrame:
    """raw, accepted, train, val and one dense column per reject reason."""
    return annotated.groupBy(*by).agg(
        F.count("*").alias("raw"), F.count_if(F.col("reject").isNull()).alias("accepted"), F.count_if(F.col("split") == "train").alias("train"), F.count_if(F.col("split") == "val").alias("val"), *(F.count_if(F.col("reject") == r).alias(r) for r in REJECTS)
    )


def observed_counts(annotated: DataFrame, name: str) -> DataFrame:
    """The same rows; whoever runs them gets the counts as an observation of this name: raw, accepted and each reject
    reason, without a job of their own."""
    reasons = [F.count_if(F.col("reject") == r).alias(r) for r in REJECTS]
    return annotated.observe(name, F.count(F.lit(1)).alias("raw"), F.count_if(F.col("reject").isNull()).alias("accepted"), *reasons)


def violations(messages: Column, roles: tuple = ROLES) -> dict[str, Column]:
    """Counters of the record contract, by name, for a canonical record."""
    some = F.coalesce(messages, F.array().cast("array<struct<role:string,content:string>>"))
    count = lambda f: F.size(F.filter(some, f))
    first = F.get(some, F.lit(0))["role"]
    last = F.try_element_at(some, F.lit(-1))["role"]
    pairs = F.zip_with(F.slice(some, F.lit(1), F.greatest(F.size(some) - 1, F.lit(0))), F.slice(some, F.lit(2), F.greatest(F.size(some) - 1, F.lit(0))), lambda a, b: F.when(a["role"] == b["role"], 1).otherwise(0))
    return {
        "not_messages": messages.isNull().cast("int"),
        "no_messages": (messages.isNotNull() & (F.size(some) == 0)).cast("int"),
        "bad_role": count(lambda m: ~F.coalesce(m["role"].isin(*roles), F.lit(False))),
        "null_content": count(lambda m: m["content"].isNull()),
        "blank_content": count(lambda m: F.coalesce(normalize(m["content"]) == "", F.lit(False)) & m["content"].isNotNull()),
        "not_normal": count(lambda m: m["content"].isNotNull() & (m["content"] != normalize(m["content"]))),
        "late_system": F.size(F.filter(F.transform(some, lambda m, i: F.struct(m["role"].alias("role"), i.alias("i"))), lambda x: (x["role"] == "system") & (x["i"] > 0))),
        "no_user": (F.size(some) > 0).cast("int") * (count(lambda m: m["role"] == "user") == 0).cast("int"),
        "no_assistant": (F.size(some) > 0).cast("int") * (count(lambda m: m["role"] == "assistant") == 0).cast("int"),
        "starts_assistant": F.coalesce((first == "assistant").cast("int"), F.lit(0)),
        "ends_user": F.coalesce((last == "user").cast("int"), F.lit(0)),
        "repeated_role": F.aggregate(pairs, F.lit(0), lambda a, x: a + x),
    }


def contract_totals(df: DataFrame, by: list[str], messages: str = "messages") -> DataFrame:
    """Summed violation counters, the number of rows and whether all are zero."""
    found = violations(F.col(messages))
    sums = df.select(*by, *(c.alias(k) for k, c in found.items())).groupBy(*by).agg(F.count("*").alias("rows"), *(F.sum(k).alias(k) for k in found))
    return sums.withColumn("clean", reduce(lambda a, b: a + b, (F.col(k) for k in found)) == 0)


def first_violation(messages: Column, roles: tuple = ROLES) -> Column:
    """The first broken rule of a record, or null; a short form of the contract for local checks."""
    some = F.coalesce(messages, F.array().cast("array<struct<role:string,content:string>>"))
    return (
        F.when(messages.isNull(), "no messages")
        .when(F.size(some) == 0, "empty messages")
        .when(F.exists(some, lambda m: ~F.coalesce(m["role"].isin(*roles), F.lit(False))), "bad role")
        .when(F.exists(some, lambda m: m["content"].isNull()), "content not text")
        .when(F.exists(some, lambda m: normalize(m["content"]) == ""), "blank content")
        .when(~F.exists(some, lambda m: m["role"] == "user"), "no user")
        .when(~F.exists(some, lambda m: m["role"] == "assistant"), "no assistant")
    )


def reasons(*rules: tuple[Column, str]) -> Column:
    """The names of all rules that hold, in order: the gate passes if there are none."""
    return F.filter(F.array(*(F.when(F.coalesce(c, F.lit(False)), F.lit(name)) for c, name in rules)), lambda x: x.isNotNull())


def oversized(size: Column, limit: int, bypass: bool = False) -> Column:
    """Strictly above the limit; an unknown size never is."""
    return F.lit(False) if bypass else F.coalesce(size > limit, F.lit(False))


def hub_gate(downloads: Column, license_id: Column, has_readme: Column, data_files: Column, min_downloads: int) -> Column:
    return reasons(
        (F.coalesce(downloads, F.lit(0)) < min_downloads, "low_downloads"),
        (F.coalesce(license_id, F.lit("")) == "", "no_license"),
        (~F.coalesce(has_readme, F.lit(False)), "no_readme"),
        (F.coalesce(data_files, F.lit(0)) == 0, "no_data_files"),
    )


def size_guards(gated: Column, total: Column, largest: Column, max_total: int, max_file: int, bypass: bool = False) -> Column:
    """All guards that hold; take the first element for the first-failing form. bypass: sizes only."""
    return reasons((gated, "gated"), (oversized(total, max_total, bypass), "dataset_too_large"), (oversized(largest, max_file, bypass), "file_too_large"))


def repo_gate(stars: Column, license_id: Column, description: Column, min_stars: int, has_readme: Column | None = None) -> Column:
    more = [] if has_readme is None else [(~F.coalesce(has_readme, F.lit(False)), "no_readme")]
    return reasons((F.coalesce(stars, F.lit(0)) < min_stars, "low_stars"), (F.coalesce(license_id, F.lit("")) == "", "no_license"), (F.coalesce(description, F.lit("")) == "", "no_description"), *more)


def search_gate(stars: Column, license_id: Column, description: Column, archived: Column, fork: Column, size_kb: Column, query: Column, min_stars: int, max_kb: int, markers: tuple[str, ...]) -> Column:
    """repo_gate and: archived, fork, too large, or found by a query that policy keeps out."""
    marked = reduce(lambda a, b: a | b, (F.contains(F.lower(query), F.lit(m)) for m in markers), F.lit(False))
    return F.concat(repo_gate(stars, license_id, description, min_stars), reasons((archived, "archived"), (fork, "fork"), (oversized(size_kb, max_kb), "too_large"), (marked, "policy_query")))


def download_action(df_cols: dict[str, Column], min_bytes: int, max_bytes: int) -> Column:
    """struct(action, reason). df_cols: skip_reason, status, gated, api_bytes, declared_bytes, on_disk. Sizes are compared
    as they are given, and rounded only where a reason shows them."""
    c = df_cols
    size = F.coalesce(c["api_bytes"], c["declared_bytes"])
    shown = F.round(size).cast("long").cast("string")
    skip = lambda r: F.struct(F.lit("skip").alias("action"), (r if isinstance(r, Column) else F.lit(r)).alias("reason"))
    return (
        F.when(c["skip_reason"].isNotNull(), skip(F.concat(F.lit("skip list: "), c["skip_reason"])))
        .when(c["status"] == "not_found", skip("not_found"))
        .when(c["status"] == "unauthorized", skip("unauthorized"))
        .when(c["status"] == "api_error", skip("api_error"))
        .when(F.coalesce(c["gated"], F.lit(False)), skip("gated"))
        .when(size > max_bytes, skip(F.concat(F.lit("too_large ("), shown, F.lit(")"))))
        .when(size < min_bytes, skip(F.concat(F.lit("too_small ("), shown, F.lit(")"))))
        .when(F.coalesce(c["on_disk"], F.lit(False)), skip("already_downloaded"))
        .otherwise(F.struct(F.lit("download").alias("action"), F.lit("ok").alias("reason")))
    )


def reason_group(reason: Column) -> Column:
    """A reason without its detail: cut at ' (' and at ':'."""
    return F.split_part(F.split_part(reason, F.lit(" ("), F.lit(1)), F.lit(":"), F.lit(1))


def excluded_by(df: DataFrame, exclusions: DataFrame, on: str) -> DataFrame:
    """Adds `exclusion`, the reason why the row's key is excluded, or null. Spark broadcasts a small list."""
    return df.join(exclusions.select(on, F.col("reason").alias("exclusion")).dropDuplicates([on]), on, "left")


# License families and size buckets.
LICENSES = ("apache-2.0", "mit", "bsd-3-clause", "bsd-2-clause", "gpl-3.0", "gpl-2.0", "lgpl-3.0", "agpl-3.0", "mpl-2.0", "cc-by-4.0", "cc-by-sa-4.0", "cc-by-nc-4.0", "cc0-1.0", "unlicense", "openrail", "odc-by")


def license_family(value: Column, known: tuple[str, ...] = LICENSES) -> Column:
    """Exact, else the longest known prefix, else 'other'."""
    low = F.lower(F.coalesce(value, F.lit("")))
    out = F.when(low.isin(*known), low)
    for k in sorted(known, key=lambda k: (-len(k), k)):
        out = out.when(F.startswith(low, F.lit(k)), F.lit(k))
    return out.otherwise("other")


def size_bucket(n: Column) -> Column:
    return F.when(n >= 1_000_000, "1M<n").when(n >= 100_000, "100K<n<1M").when(n >= 10_000, "10K<n<100K").otherwise("n<10K")


# Key sets of record families, tried in order.
FAMILIES = (
    ("chat", ("messages", "conversations", "conversation", "dialog", "dialogue", "chat", "turns")),
    ("tool_calls", ("tools", "tool_calls", "functions", "function_call")),
)
_PROMPTS = ("instruction", "instructions", "prompt", "question", "query", "input", "task", "problem")
_ANSWERS = ("output", "response", "answer", "completion", "solution", "target")
_TEXTS = ("text", "content", "body", "document")
_CODES = ("code", "source", "func", "snippet")
_LABELS = ("label", "labels", "class", "category", "target_label")


def schema_family(keys: Column) -> Column:
    """The family of a record from its top-level keys (an array of texts)."""
    low = F.transform(keys, F.lower)
    has = lambda names: F.arrays_overlap(low, F.array(*map(F.lit, names)))
    out = F.when(keys.isNull() | (F.size(keys) == 0), "no_data")
    for name, names in FAMILIES:
        out = out.when(has(names), name)
    return (
        out.when(has(_PROMPTS) & has(_ANSWERS), "instruction_response")
        .when(has(_LABELS) & (has(_TEXTS) | has(_CODES)), "classification")
        .when(has(_TEXTS), "text_only")
        .when(has(_CODES), "code_only")
        .when(has(_LABELS), "classification")
        .when(has(_PROMPTS), "instruction_response")
        .otherwise("unknown")
    )


def exclusion_heuristic(keys: Column) -> Column:
    """Why a dataset with only these keys cannot be formatted, or null."""
    low = F.transform(keys, F.lower)
    only = lambda names: (F.size(low) > 0) & (F.size(F.array_except(low, F.array(*map(F.lit, names)))) == 0)
    has = lambda names: F.arrays_overlap(low, F.array(*map(F.lit, names)))
    return F.when(has(_LABELS) & ~has(_PROMPTS) & ~has(_ANSWERS), "classification only").when(only((*_TEXTS, *_CODES, "id", "url", "path", "meta", "metadata")), "raw corpus")
