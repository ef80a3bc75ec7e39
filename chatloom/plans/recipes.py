"""Recipes: DataFrame -> DataFrame functions from the rows of a known shape to canonical records.

Every recipe returns the columns `keep` of its input and `messages`. Sentences are format strings
(fixed values) filled by `fill`; rows that lack what a recipe needs are left out.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import variant as V
from ..functions.text import fill, first_truthy, message, normalize, path_name, path_stem, path_suffix, record, strip, suffix_if
from ..operators.adapters import list_messages, no_messages
from ..operators.joins import first_passing, key_values, last_wins, missing_from, reply_pairs, with_list

CAP_REPORT, CAP_JSON = 6000, 20_000


def _have(df: DataFrame, name: str) -> Column:
    return F.col(f"`{name}`") if name in df.columns else F.lit(None).cast("string")


def _or(value: Column, default: str) -> Column:
    return F.coalesce(first_truthy(value.cast("string")), F.lit(default))


def _out(df: DataFrame, messages: Column, keep: list[str] | None) -> DataFrame:
    return df.select(*(keep or []), messages.alias("messages")).where(F.col("messages").isNotNull())


# -- reply pairs -----------------------------------------------------------------------------


def replies(df: DataFrame, id_col: str, parent_col: str, body_col: str, order: list[str], system: str | None = None, keep: list[str] | None = None) -> DataFrame:
    pairs = reply_pairs(df, id_col, parent_col, normalize(F.col(body_col)), order)
    return _out(pairs, record(None if system is None else F.lit(system), F.col("question"), F.col("answer")), keep)


# -- one row, two questions ------------------------------------------------------------------

# Questions and answers; vulnerabilities() has the defaults of their parts.
VULN_WHY = "Why is commit {intro} in {subsystem} ({path}) considered vulnerable?"
VULN_BECAUSE = "Commit {intro} introduced a {bug} in {path} ({subsystem}). Severity hint: {severity}. CVE: {cve}. The defect survived {days} days before being fixed"
VULN_HOW = "How was the {bug} in {path} fixed?"
VULN_BY = 'Commit {fix} fixed it: "{subject}" by {author}. It touched {files} file(s), adding {ins} and removing {dels} line(s).'


def vulnerabilities(df: DataFrame, keep: list[str] | None = None) -> DataFrame:
    subsystem = F.coalesce(first_truthy(_have(df, "subsystem"), _have(df, "subsystem_path")), F.lit("the kernel"))
    v = {
        "subsystem": subsystem, "path": F.coalesce(first_truthy(_have(df, "subsystem_path")), subsystem), "bug": _or(_have(df, "bug_type"), "defect"), "severity": _or(_have(df, "severity_hint"), "unknown"),
        "cve": _or(_have(df, "cve_id"), "none assigned"), "intro": _or(_have(df, "introducing_commit"), "?"), "days": _or(_have(df, "lifetime_days"), "?"), "fix": _or(_have(df, "fixing_commit"), "?"),
        "subject": _or(_have(df, "fix_subject"), "(no subject)"), "author": _or(_have(df, "fix_author"), "an unknown author"), "files": _or(_have(df, "files_changed"), "?"), "ins": _or(_have(df, "insertions"), "?"), "dels": _or(_have(df, "deletions"), "?"),
    }
    because = F.concat(fill(VULN_BECAUSE, **v), suffix_if(_have(df, "related_fixes"), ", and it is related to {v}"), F.lit("."), suffix_if(_have(df, "keywords"), " Signals: {v}."))
    fixed = F.concat(fill(VULN_BY, **v), suffix_if(_have(df, "stable_versions"), " Backported to stable {v}."))
    both = F.array(record(None, fill(VULN_WHY, **v), because), record(None, fill(VULN_HOW, **v), fixed))
    return df.select(*(keep or []), F.explode(both).alias("messages"))


# -- dispatch by the keys of a JSON record ------------------------------------------------------

# Questions and answers, and below the caps of their parts.
COMMIT_ASK = "Analyze this Linux kernel commit for vulnerability relevance and explain the change.\n\nSubject: {subject}"
COMMIT_SAY = "{subject}\n\nCommit {hash} by {author} ({files} file(s), +{ins}/-{dels})."
CRASH_ASK = "How do you fix this kernel crash?"
CRASH_HEAD = CRASH_ASK + "\n\n{title}\n(subsystem: {subsystem})\n\n{report}"
RECORD_ASK = "Explain this kernel vulnerability record."


def _text(v: Column, name: str) -> Column:
    return normalize(V.text_of(V.key(v, name)))


def _truthy_key(v: Column, *names: str) -> Column:
    return F.coalesce(*(F.when(V.is_truthy(V.key(v, n)), V.text_of(V.key(v, n))) for n in names))


def commits(df: DataFrame, raw: str = "raw", keep: list[str] | None = None) -> DataFrame:
    """Vulnerability rows, commits with a body or diff, and anything else as its JSON."""
    from pyspark.sql.types import StringType, StructField, StructType

    fields = "subsystem subsystem_path bug_type severity_hint cve_id introducing_commit lifetime_days fixing_commit fix_subject fix_author files_changed insertions deletions related_fixes keywords stable_versions".split()
    parsed = df.withColumn("_v", V.parse(F.col(raw)))
    v = F.col("_v")
    is_vuln = V.key(v, "fixing_commit").isNotNull()
    flat = parsed.where(is_vuln).withColumn("_f", F.from_json(raw, StructType([StructField(n, StringType()) for n in fields]))).select(*(keep or []), "_f.*")
    subject, body, diff = _text(v, "subject"), _text(v, "body"), _text(v, "diff_raw")
    is_commit = F.coalesce(_truthy_key(v, "diff_raw", "subject").isNotNull(), F.lit(False))
    ask = F.concat(fill(COMMIT_ASK, subject=subject), suffix_if(body, "\n\nBody:\n{v}"))
    named = {"subject": subject, "hash": _truthy_key(v, "abbreviated_hash", "hash"), "author": F.coalesce(_truthy_key(v, "author_name"), F.lit("unknown"))}
    counts = {k: F.coalesce(V.text_of(V.key(v, n)), F.lit("?")) for k, n in (("files", "files_changed"), ("ins", "insertions"), ("dels", "deletions"))}
    say = F.concat(fill(COMMIT_SAY, **named, **counts), suffix_if(V.text_of(V.key(v, "label")), " Label: {v}."), suffix_if(diff, "\n\n{v}"))
    other = record(None, F.lit(RECORD_ASK), F.substring(raw, 1, CAP_JSON))
    rest = parsed.where(~is_vuln & v.isNotNull())
    some = F.when(~is_commit, other).when((diff != "") | (body != ""), record(None, ask, say))
    return vulnerabilities(flat, keep).unionByName(_out(rest, some, keep))


def crashes(df: DataFrame, raw: str = "raw", keep: list[str] | None = None) -> DataFrame:
    """Message lists, crash reports with their patches, crash and fix pairs, else the JSON."""
    parsed = df.withColumn("_v", V.parse(F.col(raw))).where("_v is not null")
    v = F.col("_v")
    listed = F.coalesce(list_messages(V.key(v, "messages")), list_messages(V.key(v, "conversations")))
    patch, note = _text(v, "final_patch_diff"), _text(v, "fix_commit_message")
    reported = V.is_truthy(V.key(v, "crash_report")) & (V.is_truthy(V.key(v, "final_patch_diff")) | V.is_truthy(V.key(v, "fix_commit_message")))
    head = {"title": F.coalesce(F.nullif(_text(v, "title"), F.lit("")), F.lit("a kernel crash")), "subsystem": F.coalesce(_truthy_key(v, "subsystem"), F.lit("unknown subsystem")), "report": F.substring(_text(v, "crash_report"), 1, CAP_REPORT)}
    said = strip(F.concat(note, F.lit("\n\n"), patch, suffix_if(_truthy_key(v, "num_patch_versions"), "\n\n(patch went through {v} revisions.)"), F.when(V.is_truthy(V.key(v, "has_discussion")), " Reviewer discussion is included.").otherwise("")))
    crash, fix = _truthy_key(v, "crash", "bug", "title", "subject"), _truthy_key(v, "fix", "patch", "diff", "solution")
    pair = record(None, F.concat(F.lit(CRASH_ASK + "\n\n"), F.substring(normalize(crash), 1, CAP_REPORT)), normalize(fix))
    other = record(None, F.lit(CRASH_ASK), F.substring(raw, 1, CAP_JSON))
    out = F.coalesce(listed, F.when(reported & (said != ""), record(None, fill(CRASH_HEAD, **head), said)), F.when(crash.isNotNull() & fix.isNotNull(), pair), other)
    return _out(parsed, out, keep)


def agent_sessions(df: DataFrame, raw: str = "raw", keep: list[str] | None = None) -> DataFrame:
    """Messages as a list or as JSON text inside the record; turns of other roles are skipped."""
    parsed = df.withColumn("_v", V.parse(F.col(raw)))
    inner = V.key(F.col("_v"), "messages")
    turns = V.items(F.when(V.kind(inner) == "string", V.parse(V.get(inner, "$", "string"))).otherwise(inner))
    said = F.transform(turns, lambda t: message(F.lower(V.get(t, "$.role", "string")), normalize(V.text_of(V.get(t, "$.content")))))
    kept = F.filter(said, lambda m: m["role"].isin("system", "user", "assistant") & (m["content"] != ""))
    v = F.col("_v")
    code = V.is_truthy(V.key(v, "original_python_code"))
    ask = fill("Optimize this kernel: {entry} (module {module})", entry=V.text_of(V.key(v, "entry_point")), module=V.text_of(V.key(v, "module_name")))
    fallback = F.when(code, record(F.lit("You are a GPU kernel optimization expert."), ask, _text(v, "original_python_code")))
    return _out(parsed, F.when(F.size(F.coalesce(kept, no_messages())) > 0, kept).otherwise(fallback), keep)


# -- joins -----------------------------------------------------------------------------------

PASSED = "The reference implementation compiled and passed validation (bucket=compile-pass, errors=0, ex5_exists={built}, arm={arm})."
NOT_PASSED = "The reference implementation did not compile cleanly in this release (bucket={bucket}, errors={errors})."


def prompt_verdicts(prompts: DataFrame, verdicts: DataFrame, key: str = "item_id", prompt: str = "prompt", order: list[str] | None = None, keep: list[str] | None = None) -> DataFrame:
    """verdicts: key, bucket, errors, ex5_exists, arm and order columns. The first passing verdict, else the first."""
    joined = with_list(last_wins(prompts, key, order), verdicts, key, order or ["ord"], "_verdicts")
    one = first_passing(F.col("_verdicts"), lambda r: r["bucket"] == "compile-pass")
    text = lambda c: F.coalesce(c.cast("string"), F.lit("None"))
    said = F.when(F.coalesce(one["bucket"] == "compile-pass", F.lit(False)), fill(PASSED, built=text(one["ex5_exists"]), arm=text(one["arm"]))).otherwise(fill(NOT_PASSED, bucket=text(one["bucket"]), errors=text(one["errors"])))
    return _out(joined, record(None, normalize(F.col(prompt)), said), keep)


def code_handlers(codes: DataFrame, handlers: DataFrame, keys: tuple[str, ...], order: list[str], keep: list[str] | None = None) -> DataFrame:
    """Codes with all their columns as k=v, and the last handler of the same key."""
    named = lambda df: first_truthy(*(_have(df, k).cast("string") for k in keys))
    right = last_wins(handlers.withColumn("_key", named(handlers)).where("_key is not null"), "_key", order)
    shown = key_values(right, [c for c in handlers.columns if c not in order])
    joined = codes.withColumn("_key", named(codes)).where("_key is not null").join(right.select("_key", shown.alias("_handler")), "_key", "left")
    answer = F.concat(fill("ioctl {k}: ", k=F.col("_key")), key_values(codes, codes.columns), suffix_if(F.col("_handler"), "\n\nHandler: {v}"))
    return _out(joined, record(None, fill("What does the Linux ioctl {k} do?", k=F.col("_key")), answer), keep)


# -- source files ------------------------------------------------------------------------------

# What a suffix is called, and the question for it.
MQL_KINDS = {".mq5": "EA or script", ".mqh": "include header", ".mq4": "legacy EA"}
TREE_ASKS = {
    ".java": "Show me the Android 16 framework code for {module}.",
    ".kt": "Show me the Android 16 Kotlin code for {module}.",
    ".bp": "Write the Android.bp for {module}.",
    ".mk": "Write the Android.mk for {module}.",
    ".c": "Show me the C source for {module}.",
    ".h": "Show me the C header for {module}.",
    ".cpp": "Show me the C++ source for {module}.",
    ".te": "What SELinux rules does the A04s need for {module}?",
    ".rc": "Show me the init .rc definition for {module}.",
    ".sh": "Show me the shell script {module}.",
    ".py": "Show me the Python tool {module}.",
}
TREE_PREFIX_ASKS = {
    "device/samsung/a04s": "How do I configure {module} for the Galaxy A04s ({path})?",
    "kernel/samsung/exynos850": "Show me the Exynos850 kernel driver for {module} ({path}).",
    "vendor/samsung/a04s": "How is {module} configured in the A04s vendor tree ({path})?",
}


def repo_sources(files: DataFrame, path: str = "path", body: str = "body", repo: str = "repo", system: str | None = None, exclude: DataFrame | None = None, keep: list[str] | None = None) -> DataFrame:
    """Source files and readmes of repositories; `exclude` lists repositories to leave out."""
    rows = files if exclude is None else missing_from(files, exclude, repo)
    suffix, text, name = path_suffix(F.col(path)), normalize(F.col(body)), F.regexp_replace(repo, "^.*?__", "")
    v = {"stem": path_stem(F.col(path)), "name": name}
    ask = F.when(suffix == ".mqh", fill("Show me the MQL5 header for {stem} from {name}.", **v))
    for s, kind in MQL_KINDS.items():
        if s != ".mqh":
            ask = ask.when(suffix == s, fill("Write an MQL5 " + kind + " that implements {stem} (from {name}).", **v))
    ask = ask.when(F.lower(path_name(F.col(path))) == "readme.md", fill("What does the MQL5 project {name} do, and how is it used?", **v))
    good = ask.isNotNull() & (text != "") & ~F.contains(path, F.lit("/.git/"))
    return _out(rows, F.when(good, record(None if system is None else F.lit(system), ask, text)), keep)


def tree_sources(files: DataFrame, max_chars: int, path: str = "path", body: str = "body", keep: list[str] | None = None) -> DataFrame:
    """Files of a source tree; three prefixes have questions of their own, others by suffix."""
    rel, text = F.col(path), normalize(F.col(body))
    v = {"module": path_stem(rel), "path": rel}
    by_suffix = F.lit(None).cast("string")
    for s, t in TREE_ASKS.items():
        by_suffix = F.when(path_suffix(rel) == s, fill(t + "  (path: {path})", **v)).otherwise(by_suffix)
    ask = by_suffix
    for p, t in reversed(TREE_PREFIX_ASKS.items()):
        ask = F.when(by_suffix.isNotNull() & F.startswith(rel, F.lit(p)), fill(t, **v)).otherwise(ask)
    return _out(files, F.when(ask.isNotNull() & (text != "") & (F.length(text) <= max_chars), record(None, ask, text)), keep)


def code_files(df: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """content, repo_name, path, license: code under a header line."""
    code, repo, rel = normalize(_have(df, "content")), _or(_have(df, "repo_name"), "a Python project"), _or(_have(df, "path"), "module.py")
    ask = fill("Write Python code that implements {name} from {repo} (path: {path}).", name=path_name(rel), repo=repo, path=rel)
    say = fill("# {path} (from {repo}, license: {license})\n\n{code}", path=rel, repo=repo, license=_or(_have(df, "license"), "unknown"), code=code)
    return _out(df, F.when(code != "", record(None, ask, say)), keep)


def snippets(files: DataFrame, kind: Column, path: str = "path", body: str = "body", keep: list[str] | None = None) -> DataFrame:
    """'Explain this file' over stripped bodies, with where they came from."""
    text = strip(F.coalesce(body, F.lit("")))
    rows = files.withColumn("source_path", F.col(path)).withColumn("kind", kind)
    return _out(rows, F.when(text != "", record(None, F.lit("Explain this file"), text)), [*(keep or []), "source_path", "kind"])


# -- flat rows ---------------------------------------------------------------------------------


def fuzzy_questions(df: DataFrame, system: str | None = None, keep: list[str] | None = None) -> DataFrame:
    """The first columns, in file order, whose names hold 'question' and 'answer'. Of the non-null
    values a question comes first: a name with both words is one unless a question was found."""
    asks = [c for c in df.columns if "question" in c.lower()]
    question = F.coalesce(*(F.col(f"`{c}`") for c in asks)) if asks else F.lit(None).cast("string")
    answer = F.lit(None).cast("string")
    for k in reversed(range(len(df.columns))):
        c = df.columns[k]
        if "answer" not in c.lower():
            continue
        if "question" in c.lower():  # an answer only where an earlier column was the question
            earlier = [x for x in df.columns[:k] if "question" in x.lower()]
            known = F.coalesce(*(F.col(f"`{x}`") for x in earlier)).isNotNull() if earlier else F.lit(False)
            answer = F.coalesce(F.when(known, F.col(f"`{c}`")), answer)
        else:
            answer = F.coalesce(F.col(f"`{c}`"), answer)
    good = (F.coalesce(question, F.lit("")) != "") & (F.coalesce(answer, F.lit("")) != "")
    return _out(df, F.when(good, record(None if system is None else F.lit(system), normalize(question), normalize(answer))), keep)


def instructions(df: DataFrame, system: str = "You are a Linux kernel expert.", keep: list[str] | None = None) -> DataFrame:
    ask, more, say = (normalize(_have(df, c)) for c in ("instruction", "input", "output"))
    user = F.when(more != "", F.concat(ask, F.lit("\n\n"), more)).otherwise(ask)
    return _out(df, F.when((ask != "") & (say != ""), record(F.lit(system), user, say)), keep)


def assembly(df: DataFrame, keep: list[str] | None = None) -> DataFrame:
    asm, why, note = (normalize(_have(df, c)) for c in ("asm", "explanation", "commit_message"))
    ask = fill("What does this Linux kernel assembly for {func} ({file}) do?\n\n{asm}", func=_or(_have(df, "func_name"), "this function"), file=F.coalesce(_have(df, "filename"), F.lit("unknown file")), asm=asm)
    return _out(df, F.when((asm != "") & (why != ""), record(None, ask, F.concat(why, suffix_if(note, "\n\nCommit: {v}")))), keep)


def code_reviews(df: DataFrame, keep: list[str] | None = None) -> DataFrame:
    before, context = normalize(_have(df, "before_code")), normalize(_have(df, "diff_context"))
    ask = fill("Review this change in {title} ({file}, {language}).\n\n{code}", title=_or(_have(df, "pr_title"), "a pull request"), file=F.coalesce(_have(df, "file_path"), F.lit("unknown file")), language=F.coalesce(_have(df, "language"), F.lit("unknown")), code=first_truthy(context, before))
    text = lambda c: F.coalesce(_have(df, c).cast("string"), F.lit("None"))
    say = fill("Comment type: {kind}. Author: {author}. Line {line}.", kind=text("comment_type"), author=text("author_username"), line=text("comment_line"))
    after = F.when(F.coalesce(_have(df, "after_code"), F.lit("")) != "", F.concat(F.lit("\n\nSuggested after:\n"), normalize(_have(df, "after_code")))).otherwise(F.lit(""))
    return _out(df, F.when(before != "", record(None, ask, F.concat(say, after))), keep)


def security_fixes(df: DataFrame, system: str, keep: list[str] | None = None) -> DataFrame:
    code, fixed = normalize(_have(df, "code")), normalize(_have(df, "code_fixed"))
    ask = fill("Review this {language} code for security vulnerabilities and fix it.\n\n{code}", language=_have(df, "language"), code=code)
    say = F.concat(_or(_have(df, "cwe_id"), "unknown CWE"), suffix_if(_have(df, "owasp"), " ({v})"), suffix_if(fixed, "\n\nFixed code:\n{v}"))
    return _out(df, F.when(code != "", record(F.lit(system), ask, say)), keep)


def security_labels(df: DataFrame, system: str, keep: list[str] | None = None) -> DataFrame:
    code, label = normalize(_have(df, "code")), normalize(_have(df, "label"))
    return _out(df, F.when((code != "") & (label != ""), record(F.lit(system), F.concat(F.lit("Which vulnerability class does this code exhibit?\n\n"), code), label)), keep)


def security_union(fixes: DataFrame, labels: DataFrame, chats: DataFrame, system: str) -> DataFrame:
    """Fix pairs, labelled code, and chats (raw JSON) passed through."""
    v = V.parse(F.col("raw"))
    passed = chats.select(F.coalesce(list_messages(V.key(v, "messages")), list_messages(V.key(v, "conversations"))).alias("messages")).where("messages is not null")
    return security_fixes(fixes, system).unionByName(security_labels(labels, system)).unionByName(passed)


# Parts of permission names that are called high-risk; the last two do not by
# themselves bring the clause up.
RISKS = ("SMS", "CALL", "LOCATION", "CAMERA", "READ_CONTACTS", "RECORD_AUDIO", "INSTALL")
SHOWN_PERMISSIONS = 40


def wide_flags(df: DataFrame, flags: list[str], label: str, system: str = "You are an Android malware analyst.", keep: list[str] | None = None) -> DataFrame:
    """One-hot columns as a list of what is set, and a decoded label."""
    named = F.array_compact(F.array(*(F.when(F.trim(F.col(f"`{c}`").cast("string")).isin("1", "1.0"), F.lit(c)) for c in flags)))
    rows = df.withColumn("_set", named)
    got, value = F.col("_set"), F.trim(F.col(label).cast("string"))
    holds = lambda p, risks: _any_of([F.contains(p, F.lit(r)) for r in risks])
    risky = F.filter(got, lambda p: holds(p, RISKS))
    ask = F.concat(F.lit("Classify this Android app from its requested permissions:\n"), F.array_join(F.transform(F.slice(got, 1, SHOWN_PERMISSIONS), lambda p: F.concat(F.lit("- "), p)), "\n"))
    clause = F.when(F.exists(got, lambda p: holds(p, RISKS[:5])), F.concat(F.lit(", including the high-risk ones: "), F.array_join(risky, ", "))).otherwise(F.lit(""))
    say = F.concat(fill("This app is {verdict}. It requests {n} permissions", verdict=F.when(value.isin("1", "1.0"), "malware").otherwise("benign"), n=F.size(got)), clause, F.lit("."))
    return _out(rows, F.when((F.size(got) > 0) & value.isin("0", "1", "0.0", "1.0"), record(F.lit(system), ask, say)), keep)


def _any_of(conditions: list[Column]) -> Column:
    out = conditions[0]
    for c in conditions[1:]:
        out = out | c
    return out


def calendar(df: DataFrame, keep: list[str] | None = None) -> DataFrame:
    currency, event, detail = _have(df, "Currency"), _have(df, "Event"), normalize(_have(df, "Detail"))
    ask = F.concat(fill("What was the {c} {e} economic event", c=currency, e=event), suffix_if(_have(df, "DateTime"), " at {v}"), F.lit("?"))
    values = {k.lower(): _or(_have(df, k), "n/a") for k in ("Actual", "Forecast", "Previous")}
    say = F.concat(fill("Impact: {impact}. Actual: {actual}, Forecast: {forecast}, Previous: {previous}.", impact=F.coalesce(_have(df, "Impact"), F.lit("unknown")), **values), suffix_if(detail, "\n\n{v}"))
    good = (F.coalesce(currency, F.lit("")) != "") & (F.coalesce(event, F.lit("")) != "")
    return _out(df, F.when(good, record(F.lit("You are an MQL5 algorithmic-trading developer."), ask, say)), keep)


def nothing(df: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """For sources known to hold nothing that can be formatted."""
    return df.select(*(keep or []), no_messages().alias("messages")).limit(0)


#: Recipes that take one DataFrame, by name; add your own.
RECIPES: dict[str, Callable[..., DataFrame]] = {
    "replies": replies, "vulnerabilities": vulnerabilities, "commits": commits, "crashes": crashes, "agent_sessions": agent_sessions, "repo_sources": repo_sources, "tree_sources": tree_sources, "code_files": code_files, "snippets": snippets,
    "fuzzy_questions": fuzzy_questions, "instructions": instructions, "assembly": assembly, "code_reviews": code_reviews, "security_fixes": security_fixes, "security_labels": security_labels, "wide_flags": wide_flags, "calendar": calendar, "nothing": nothing,
    "prompt_verdicts": prompt_verdicts, "code_handlers": code_handlers, "security_union": security_union,
}

__all__ = ["RECIPES", *RECIPES]
