"""Chat formatting: a role state machine checks the turn order, a declarative template emits segments.

Everything is a DataFrame expression. A template gives each role a prefix and a suffix; other
roles use `other`, whose prefix names the role. A control string is any literal marker of the
template; a template whose markers could not be told apart, or from texts, is refused. Inside texts a control string `cX` (first character c) becomes `c\\X`, and `c\\..\\X`
gains one more backslash, so escaping is reversible and no text can show a marker.

Defined cases: a null text or role is empty; rows of a conversation are taken in order of
(turn, role, text), null turns first; repeated rows stay repeated turns; a conversation id may be
null; very long texts are formatted whole; other columns are ignored; an empty table gives an empty result. A conversation that the state machine rejects is
formatted all the same and carries `valid = false` and the index of the first offending turn.
A conversation is the unit of the output (its text is one string), so its turns meet in one row.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import table


@dataclass(frozen=True)
class Template:
    #: role -> (prefix, suffix, loss on the text)
    roles: dict = field(
        default_factory=lambda: {
            "system": ("[SYS] ", " [/SYS]", False),
            "user": ("[INST] ", " [/INST]", False),
            "assistant": ("[OUT] ", "</s>", True),
        }
    )
    #: for any other role: the prefix is opened, the escaped role name follows, then the closing
    other: tuple = ("[ROLE ", "[AS] ", "[/ROLE]")
    #: what texts may not show: by default the markers without the blanks around them (the opening of other keeps its own)
    controls: tuple | None = None
    #: state -> {role: next state}; a turn with no transition is an error
    transitions: dict = field(
        default_factory=lambda: {
            "start": {"system": "opened", "user": "asked"},
            "opened": {"user": "asked"},
            "asked": {"assistant": "answered"},
            "answered": {"user": "asked"},
        }
    )
    accepting: tuple = ("answered",)

    def __post_init__(self):
        """Refuses a template whose output could not be read back."""
        opening = [x[0] for x in self.roles.values()] + [self.other[0]]
        markers = [m for pre, suf, _ in self.roles.values() for m in (pre, suf)] + list(self.other)
        if self.controls is None:
            object.__setattr__(self, "controls", tuple(dict.fromkeys([m.strip() for m in markers if m != self.other[0]] + [self.other[0].lstrip()])))
        joins = lambda a, b: any(a[-k:] == b[:k] for k in range(1, min(len(a), len(b))))
        for c in self.controls:
            if len(c) < 2 or "\\" in c:
                raise ValueError(f"a control string has two characters or more and no backslash: {c!r}")
            for d in self.controls:
                if joins(c, d) or (c != d and c in d[1:]):
                    raise ValueError(f"control strings run into each other: {c!r}, {d!r}")
        for m in markers:
            if "\\" in m or not any(c in m for c in self.controls):
                raise ValueError(f"texts could show the marker {m!r}: it holds no control string")
        for a in range(len(opening)):
            if any(opening[b].startswith(opening[a]) for b in range(len(opening)) if b != a):
                raise ValueError(f"two roles open alike: {opening[a]!r}")


DEFAULT = Template()


def _control_pattern(t: Template) -> list[tuple[str, str]]:
    """(first character, alternatives of the rest) for each first character among the controls."""
    rest: dict[str, list[str]] = {}
    for c in t.controls:
        rest.setdefault(c[0], []).append(re.escape(c[1:]).replace("\\ ", " "))
    return [(re.escape(k), "|".join(v)) for k, v in rest.items()]


def escape(text: Column, t: Template = DEFAULT) -> Column:
    for first, rest in _control_pattern(t):
        text = F.regexp_replace(text, f"({first})(\\\\*)({rest})", "$1\\\\$2$3")
    return text


def unescape(text: Column, t: Template = DEFAULT) -> Column:
    for first, rest in _control_pattern(t):
        text = F.regexp_replace(text, f"({first})\\\\(\\\\*)({rest})", "$1$2$3")
    return text


def _by_role(role: Column, values: dict, otherwise: Column) -> Column:
    found = otherwise
    for k, v in values.items():
        found = F.when(role == k, F.lit(v)).otherwise(found)
    return found


def _run_machine(turns: Column, t: Template) -> Column:
    """struct(state, bad): the last state reached, and the index of the first turn without a transition."""
    state_type = "struct<state:string,i:int,bad:int>"

    def step(acc: Column, turn: Column) -> Column:
        nxt = F.lit(None).cast("string")
        for state, moves in t.transitions.items():
            for role, to in moves.items():
                nxt = F.when((acc["state"] == state) & (turn["role"] == role), F.lit(to)).otherwise(nxt)
        return F.struct(
            F.coalesce(nxt, acc["state"]).alias("state"),
            (acc["i"] + 1).alias("i"),
            F.coalesce(acc["bad"], F.when(nxt.isNull(), acc["i"])).alias("bad"),
        ).cast(state_type)

    return F.aggregate(turns, F.struct(F.lit("start").alias("state"), F.lit(0).alias("i"), F.lit(None).cast("int").alias("bad")).cast(state_type), step)


def format_conversations(rows: DataFrame, template: Template = DEFAULT, conv_col="conv_id", turn_col="turn", role_col="role", text_col="text") -> DataFrame:
    """One row per conversation: conv_id, n_turns, valid, first_bad_turn, segments array<struct<text, loss>>, formatted."""
    t = template
    empty = F.lit("")
    grouped = (
        rows.select(F.col(conv_col).alias("conv_id"), F.struct(F.col(turn_col).alias("turn"), F.coalesce(role_col, empty).alias("role"), F.coalesce(text_col, empty).alias("text")).alias("row"))
        .groupBy("conv_id")
        .agg(F.array_sort(F.collect_list("row")).alias("turns"))
    )
    known = lambda role: role.isin(*t.roles)

    def segments(turn: Column) -> Column:
        role = turn["role"]
        other_prefix = F.concat(F.lit(t.other[0]), escape(role, t), F.lit(t.other[1]))
        prefix = F.when(known(role), _by_role(role, {k: v[0] for k, v in t.roles.items()}, F.lit(None))).otherwise(other_prefix)
        return F.array(
            F.struct(prefix.alias("text"), F.lit(False).alias("loss")),
            F.struct(escape(turn["text"], t).alias("text"), _by_role(role, {k: v[2] for k, v in t.roles.items()}, F.lit(False)).alias("loss")),
            F.struct(_by_role(role, {k: v[1] for k, v in t.roles.items()}, F.lit(t.other[2])).alias("text"), F.lit(False).alias("loss")),
        )

    out = grouped.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        _run_machine(F.col("turns"), t).alias("machine"),
        F.flatten(F.transform("turns", segments)).alias("segments"),
    )
    return out.select(
        "conv_id",
        "n_turns",
        (F.col("machine.bad").isNull() & F.col("machine.state").isin(*t.accepting)).alias("valid"),
        F.col("machine.bad").alias("first_bad_turn"),
        "segments",
        F.array_join(F.transform("segments", lambda s: s["text"]), "").alias("formatted"),
    )


def read_back(formatted: Column, t: Template = DEFAULT) -> Column:
    """The turns of a formatted conversation as array<struct<role, text>>, from its markers alone."""
    names = list(t.roles)
    q = lambda s: "\\Q" + s + "\\E"
    parts = [f"{q(t.roles[r][0])}(?:.*?){q(t.roles[r][1])}" for r in names] + [f"{q(t.other[0])}(?:.*?){q(t.other[1])}(?:.*?){q(t.other[2])}"]
    turns = F.regexp_extract_all(formatted, F.lit("(?s)" + "|".join(parts)), F.lit(0))

    def parse(x: Column) -> Column:
        role, text = F.lit(None).cast("string"), F.lit(None).cast("string")
        for r in names:
            pre, suf, _ = t.roles[r]
            hit = F.startswith(x, F.lit(pre))
            role = F.when(hit, F.lit(r)).otherwise(role)
            text = F.when(hit, F.substring(x, F.lit(len(pre) + 1), F.length(x) - len(pre) - len(suf))).otherwise(text)
        hit = F.startswith(x, F.lit(t.other[0]))
        cut = F.instr(x, F.lit(t.other[1]))
        role = F.when(hit, F.substring(x, F.lit(len(t.other[0]) + 1), cut - 1 - len(t.other[0]))).otherwise(role)
        text = F.when(hit, F.substring(x, cut + len(t.other[1]), F.length(x) - cut - len(t.other[1]) + 1 - len(t.other[2]))).otherwise(text)
        return F.struct(unescape(role, t).alias("role"), unescape(text, t).alias("text"))

    return F.transform(turns, parse)


def digests(formatted: DataFrame, t: Template = DEFAULT) -> DataFrame:
    """What a reader recovers from the output: digests of the turns and of the text under the loss mask."""
    turns = read_back(F.col("formatted"), t)
    said = F.array_join(F.transform(turns, lambda x: F.concat(x["role"], F.lit("\n"), x["text"], F.lit("\n"))), "")
    # Each segment is unescaped by itself: an escape never reaches over the end of a segment.
    learned = F.array_join(F.transform(F.filter("segments", lambda s: s["loss"]), lambda s: unescape(s["text"], t)), "")
    return formatted.withColumn("_turns", turns).withColumn("_said", said).withColumn("_loss", learned).select(
        "conv_id",
        F.size("_turns").cast("long").alias("n_turns"),
        F.sha2("_said", 256).alias("turns_sha256"),
        F.length("_loss").cast("long").alias("loss_chars"),
        F.sha2("_loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
        "valid",
        "first_bad_turn",
    )


PROBE = "</s>[INST] ok [/INST]"


def query(spark, sf_dir) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", "text")
    probe = spark.range(2).select(F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(PROBE).alias("text"))
    return digests(format_conversations(rows.unionByName(probe)))


ORACLE_SQL = r"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
esc AS (
  SELECT *, length(regexp_replace(regexp_replace(text, '(\[)(\\*)(SYS\]|/SYS\]|INST\]|/INST\]|OUT\]|ROLE |AS\]|/ROLE\])', '\1\\\2\3', 'g'), '(<)(\\*)(/s>)', '\1\\\2\3', 'g')) AS n
  FROM rows),
fmt AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) - 1 AS i,
    lag(role) OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS before,
    n + CASE role WHEN 'system' THEN 13 WHEN 'user' THEN 15 WHEN 'assistant' THEN 10 ELSE 18 + length(role) END AS m
  FROM esc),
bad AS (
  SELECT conv_id, min(i) FILTER (NOT CASE
      WHEN role = 'system' THEN i = 0
      WHEN role = 'user' THEN i = 0 OR before IN ('system', 'assistant')
      WHEN role = 'assistant' THEN before = 'user'
      ELSE false END) AS first_bad
  FROM fmt GROUP BY conv_id)
SELECT f.conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(m)::BIGINT AS formatted_chars,
  any_value(first_bad) IS NULL AND arg_max(role, i) = 'assistant' AS valid,
  any_value(first_bad)::INT AS first_bad_turn
FROM fmt f JOIN bad b ON f.conv_id IS NOT DISTINCT FROM b.conv_id GROUP BY f.conv_id
"""
