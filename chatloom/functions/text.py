"""Column functions: text normalisation, roles, digests, splits, sizes and paths."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Role aliases.
ROLE_ALIASES = {
    "human": "user", "user": "user", "prompt": "user", "instruction": "user", "input": "user",
    "agent": "assistant", "assistant": "assistant", "gpt": "assistant", "bot": "assistant", "output": "assistant",
    "system": "system", "tool": "tool",
}

#: Unicode white space plus the information separators, as Python's str.strip takes them.
_BLANK = r"[\s\x1c-\x1f]"
#: Separate fields and records in the text that is hashed; see dedup_key.
UNIT, RECORD = "\x1f", "\x1e"
# What counts as a long token in a preview.
LONG_TOKEN = r"\b[A-Za-z0-9+/=_-]{40,}\b"
# Size units.
_UNITS = ("B", "KB", "MB", "GB", "TB")
# What an owner/name id looks like.
ID_PATTERN = r"^[A-Za-z0-9][A-Za-z0-9._-]*/[A-Za-z0-9._-]+$"


def strip(text: Column) -> Column:
    return F.regexp_replace(text, f"(?U)^{_BLANK}+|{_BLANK}+$", "")


def normalize(text: Column) -> Column:
    """Null to empty, line ends to LF, three or more LF to two, stripped."""
    unified = F.regexp_replace(F.coalesce(text.cast("string"), F.lit("")), "\r\n?", "\n")
    return strip(F.regexp_replace(unified, "\n{3,}", "\n\n"))


def normalize_list(texts: Column) -> Column:
    """A list of texts: each normalised, joined by LF, and normalised again."""
    return normalize(F.array_join(F.transform(texts, normalize), "\n"))


def role(value: Column) -> Column:
    """The canonical role of an alias, or an empty string."""
    aliases = F.create_map(*[F.lit(x) for pair in ROLE_ALIASES.items() for x in pair])
    return F.coalesce(F.try_element_at(aliases, F.lower(strip(F.coalesce(value.cast("string"), F.lit(""))))), F.lit(""))


def message(role_value: Column, content: Column) -> Column:
    return F.struct(role_value.alias("role"), content.alias("content"))


def record(system: Column | None, user: Column, assistant: Column) -> Column:
    """A canonical conversation of one exchange; an empty or null system turn is left out."""
    turns = F.array(message(F.lit("user"), user), message(F.lit("assistant"), assistant))
    if system is None:
        return turns
    return F.when(F.coalesce(system, F.lit("")) != "", F.concat(F.array(message(F.lit("system"), system)), turns)).otherwise(turns)


def truthy(value: Column) -> Column:
    """A text or null if it is empty: for first-truthy choices with coalesce."""
    return F.nullif(value, F.lit(""))


def first_truthy(*values: Column) -> Column:
    return F.coalesce(*(truthy(v) for v in values))


def total_chars(messages: Column) -> Column:
    return F.aggregate(messages, F.lit(0), lambda acc, m: acc + F.length(m["content"]))


def canonical_text(messages: Column) -> Column:
    """The turns as one string: role, unit separator, content, joined by record separators."""
    return F.array_join(F.transform(messages, lambda m: F.concat(m["role"], F.lit(UNIT), m["content"])), RECORD)


def dedup_key(messages: Column, seed: int = 42) -> Column:
    """64 hex digits over seed and whole record; never over a prefix."""
    return F.sha2(F.concat(F.lit(f"{seed}{UNIT}"), canonical_text(messages)), 256)


def multiset_digest(key: Column) -> Column:
    """An aggregate: the digest of a bag of hex keys, the same in any order. Sums of four 60-bit parts and
    the count combine before their shuffle, so a group of any size costs one row."""
    parts = [F.sum(F.conv(F.substring(key, 1 + 15 * k, 15), 16, 10).cast("decimal(20,0)")).cast("string") for k in range(4)]
    return F.when(F.count(key) > 0, F.sha2(F.concat_ws("|", F.count(key).cast("string"), *parts), 256))


def digest_bucket(key: Column, buckets: int = 1_000_000) -> Column:
    """The first eight digest bytes, big-endian and unsigned, modulo buckets."""
    return (F.conv(F.substring(key, 1, 16), 16, 10).cast("decimal(20,0)") % buckets).cast("int")


def split_of(key: Column, val_fraction: float) -> Column:
    threshold = int(val_fraction * 1_000_000)
    if val_fraction <= 0:
        return F.lit("train")
    return F.when(digest_bucket(key) < threshold, "val").otherwise("train")


def redact(text: Column, keep: int = 200) -> Column:
    return F.substring(F.regexp_replace(text, LONG_TOKEN, "<REDACTED>"), 1, keep)


def human_bytes(n: Column) -> Column:
    """12.3 KB and the like; 1024-based, whole bytes as they are, 'unknown' for null. Ties round to even."""
    out = F.when(n.isNull(), F.lit("unknown")).when(n < 1024, F.format_string("%d B", n.cast("long")))
    for k, unit in enumerate(_UNITS[1:-1], 1):
        out = out.when(n < 1024 ** (k + 1), F.format_string(f"%.1f {unit}", F.bround(n / F.lit(float(1024**k)), 1)))
    return out.otherwise(F.format_string(f"%.1f {_UNITS[-1]}", F.bround(n / F.lit(float(1024 ** (len(_UNITS) - 1))), 1)))


def size_bytes(text: Column) -> Column:
    """Bytes of a text like '1.5 GB'; null if there is none."""
    number = F.regexp_extract(text, r"(?i)([0-9]+(?:\.[0-9]+)?)\s*([KMGT]?B)\b", 1)
    unit = F.upper(F.regexp_extract(text, r"(?i)([0-9]+(?:\.[0-9]+)?)\s*([KMGT]?B)\b", 2))
    factor = F.lit(None).cast("double")
    for k, u in enumerate(_UNITS):
        factor = F.when(unit == u, F.lit(float(1024**k))).otherwise(factor)
    return F.when(number != "", F.floor(number.cast("double") * factor).cast("long"))


def path_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def path_suffix(path: Column) -> Column:
    """The lower-cased last suffix with its dot, or an empty string; a leading dot is not one."""
    return F.lower(F.regexp_extract(path_name(path), r"^.+(\.[^.]+)$", 1))


def path_stem(path: Column) -> Column:
    return F.regexp_replace(path_name(path), r"^(.+)\.[^.]+$", "$1")


def is_id(text: Column) -> Column:
    """Whether a text is an owner/name id."""
    return F.coalesce(F.rlike(text, F.lit(ID_PATTERN)), F.lit(False))


def dataset_id(directory: Column) -> Column:
    """owner__name to owner/name, at the first double underscore only."""
    return F.regexp_replace(directory, r"^(.*?)__", "$1/")


def fill(template: str, **values: Column) -> Column:
    """A format string with {name} fields as a concatenation of columns; null fields become empty."""
    import string

    parts = []
    for literal, name, _, _ in string.Formatter().parse(template):
        if literal:
            parts.append(F.lit(literal))
        if name is not None:
            parts.append(F.coalesce(values[name].cast("string"), F.lit("")))
    return F.concat(*parts)


def suffix_if(value: Column, template: str) -> Column:
    """The template filled with {v} if the value is neither null nor empty, else nothing."""
    return F.when(F.coalesce(value.cast("string"), F.lit("")) != "", fill(template, v=value)).otherwise(F.lit(""))
