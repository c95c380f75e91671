"""Admission of prompt rows: validity, reasons of rejection, revisions."""

from __future__ import annotations

import json
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import pandas_udf

from gradeloom.functions.extract import choice_answer
from gradeloom.functions.ids import digest
from gradeloom.functions.schema import malformed, unsatisfiable
from gradeloom.operators.selection import first_per_key

#: The domains, in the order in which tables show them.
DOMAINS = ["math", "knowledge", "logic", "grounding", "quality", "instruction", "multiturn", "structure", "python", "long_context"]


def invalid_reason() -> Column:
    """First violated rule of a canonical row, null if there is none. Labels must be spelled exactly."""
    missing = lambda c: F.col(c).isNull() | (F.col(c) == "")
    rules = [(missing(c), f"no {c}") for c in ("id", "family_id", "task", "domain", "verifier", "source")]
    rules += [
        (F.expr("messages is null or size(messages) = 0"), "no messages"), (~F.col("domain").isin(DOMAINS), "unknown domain"),
        (F.expr("element_at(messages, -1).role is distinct from 'user'"), "last role"), (F.expr("not forall(messages, m -> m.role in ('system', 'user', 'assistant') and m.content is not null)"), "message"),
    ]
    out = F.when(rules[0][0], rules[0][1])
    for cond, name in rules[1:]:
        out = out.when(cond, name)
    return out


#: A text that declines, one that tries to change the model's role, one that forbids an answer.
REFUSAL = r"(?iU)\b(?:I|we)\s+(?:cannot|can't|won't|will not|am unable to|are unable to)\s+(?:assist|help|provide|comply|answer)\b"
META_PROMPT = r"(?iU)\b(?:do anything now|do nothing now|jailbreak|as DAN|be a DNN)\b"
NO_ANSWER = r"(?iU)\b(?:you|the assistant|the model|chatgpt)\s+(?:(?:must|should|will)\s+not|cannot|can't)\s+(?:answer|respond|comply)\b"
#: Verifiers whose prompts are screened as well; others may quote what they like.
OPEN_ENDED = ("quality", "rubric", "instruction", "structure", "calendar")


def rejection_reason() -> Column:
    """First reason to reject a row, null if it is admitted: a reference that declines, an earlier answer that does, and, for
    open-ended verifiers, a prompt that changes the role, forbids an answer, or quotes a refusal."""
    gold = F.try_parse_json("verification")
    declines = lambda path: F.coalesce((F.schema_of_variant(F.try_variant_get(gold, path, "variant")) == "STRING") & F.try_variant_get(gold, path, "string").rlike(REFUSAL), F.lit(False))
    said = F.exists("messages", lambda m: (m.role == "assistant") & F.coalesce(m.content.rlike(REFUSAL), F.lit(False)))
    text = F.array_join(F.transform("messages", lambda m: F.coalesce(m.content, F.lit(""))), "\n")
    opened = F.col("verifier").isin(*OPEN_ENDED)
    return (
        F.when(declines("$.answer") | declines("$.reference"), "refusal_reference_target").when(said, "refusal_in_conversation_history").when(opened & text.rlike(META_PROMPT), "adversarial_meta_prompt")
        .when(opened & text.rlike(NO_ANSWER), "explicit_nonanswer_instruction").when(opened & text.rlike(REFUSAL), "quoted_refusal_example_requires_review")
    )


def preflight_reason(known_instructions: Sequence[str] | None = None) -> Column:
    """Why a row of a verifier cannot be graded, null if it can: an instruction that isn't among the known ones (all are, if
    null), a rubric without checks or with criteria other than YES and NO, a schema that is none, a calendar with a constraint of
    another kind. Only rows with a schema are sent to Python."""
    gold = F.try_parse_json("verification")
    at = lambda path, of: F.try_variant_get(gold, path, of)
    ids = F.concat(F.coalesce(at("$.ids", "array<string>"), F.array().cast("array<string>")), F.coalesce(F.flatten(F.transform("turns", lambda t: t.ids)), F.array().cast("array<string>")))
    unknown = F.lit(None).cast("string") if known_instructions is None else F.get(F.filter(ids, lambda i: ~i.isin(*known_instructions)), F.lit(0))
    criteria = at("$.checks", "array<struct<pass_criteria:string>>")
    bad_rubric = criteria.isNull() | (F.size(criteria) < 1) | F.exists(criteria, lambda c: ~F.coalesce(c["pass_criteria"], F.lit("YES")).isin("YES", "NO"))
    events = F.map_values(F.coalesce(at("$.calendar", "map<string,struct<constraint:string>>"), at("$", "map<string,struct<constraint:string>>")))
    odd_event = F.exists(events, lambda e: (F.coalesce(e["constraint"], F.lit("")) != "") & ~e["constraint"].rlike("^(?:before|after|between|at) "))
    return (
        F.when((F.col("verifier") == "instruction") & unknown.isNotNull(), F.concat(F.lit("unsupported_instruction:"), unknown)).when((F.col("verifier") == "rubric") & F.coalesce(bad_rubric, F.lit(True)), "invalid_rubric")
        .when((F.col("verifier") == "calendar") & F.coalesce(odd_event, F.lit(False)), "unsupported_calendar_constraint")
        .when(_schema_problem(F.when(F.col("verifier") == "structure", F.to_json(at("$.schema", "variant")))).isNotNull(), "malformed_published_schema")
    )


@pandas_udf(T.StringType())
def _schema_problem(s: pd.Series) -> pd.Series:
    return s.map(lambda x: None if x is None or x == "null" else malformed(json.loads(x)))


@pandas_udf(T.StringType())
def _unsatisfiable(kind: pd.Series, schema: pd.Series) -> pd.Series:
    return pd.Series([None if x is None or x == "null" else unsatisfiable((k or "").lower(), json.loads(x)) for k, x in zip(kind, schema)], index=kind.index, dtype=object)


def quarantine_reason() -> Column:
    """Why no response can pass a structure row, null if one can; other rows are not looked at."""
    gold = F.when(F.col("verifier") == "structure", F.try_parse_json("verification"))
    return _unsatisfiable(F.try_variant_get(gold, "$.format", "string"), F.to_json(F.try_variant_get(gold, "$.schema", "variant")))


@pandas_udf(T.BooleanType())
def _round_trips(answer: pd.Series, labels: pd.Series, pattern: pd.Series) -> pd.Series:
    def one(a, ls, p) -> bool:
        ls = [] if ls is None else [str(x) for x in ls]
        texts = [f"Final answer: {a}", f"Answer: {a}", f"\\boxed{{{a}}}"]
        return any(choice_answer(t, ls, p) == (a, True) for t in texts)

    return pd.Series([one(*x) for x in zip(answer, labels, [None if p is None or p != p else p for p in pattern])], index=answer.index)


def choice_excluded() -> Column:
    """Whether the right answer of a choice row scores in none of the usual spellings; null for other rows."""
    gold = F.when(F.col("verifier") == "choice", F.try_parse_json("verification"))
    at = lambda path, of: F.try_variant_get(gold, path, of)
    return F.when(F.col("verifier") == "choice", ~_round_trips(at("$.answer", "string"), at("$.labels", "array<string>"), at("$.output_regex", "string")))


#: Fixed value: rows whose window is only a label of the prompt's length say so.
NOMINAL = "nominal published prompt-length profile"


def context_limit(model_context: Column | int) -> Column:
    """The window that counts for a row: the model's, or the row's own if that is smaller and no mere label."""
    model = F.lit(model_context) if isinstance(model_context, int) else model_context
    return F.when(F.coalesce(F.col("bucket_semantics").startswith(NOMINAL), F.lit(False)), model).otherwise(F.least(model, F.col("context_window")))


def response_budget(everywhere: int = 0, by_task: dict[str, int] | None = None, by_domain: dict[str, int] | None = None) -> Column:
    """Tokens for an answer: one number for all, else the task's, the domain's, the row's; null where none is positive."""
    pick = lambda table, c: F.try_element_at(F.create_map(*[F.lit(x) for kv in table.items() for x in kv]), c) if table else F.lit(None).cast("int")
    got = F.coalesce(F.nullif(F.lit(everywhere), F.lit(0)), F.nullif(pick(by_task, F.col("task")), F.lit(0)), F.nullif(pick(by_domain, F.lower(F.trim("domain"))), F.lit(0)), F.col("max_new_tokens"))
    return F.when(got > 0, got)


def admitted_context(prompt_tokens: Column, budget: Column, limit: Column) -> Column:
    """Whether prompt and answer fit the window; false where one of them isn't known."""
    return F.coalesce(prompt_tokens + budget <= limit, F.lit(False))


def choice_problem(answer: Column, labels: Column) -> Column:
    """Whether a choice row cannot be graded: fewer than two labels, a repeated one, or a gold answer that is none."""
    return F.coalesce((F.size(labels) < 2) | (F.size(F.array_distinct(labels)) < F.size(labels)) | ~F.array_contains(labels, answer), F.lit(True))


def repair_pattern(df: DataFrame, old: str, new: str) -> tuple[DataFrame, DataFrame]:
    """(rows, changes): `old` replaced by `new` in the verification text; changed rows get a new id, listed with the old one."""
    text = F.replace(F.col("verification"), F.lit(old), F.lit(new))
    changed = F.coalesce(text != F.col("verification"), F.lit(False))
    rows = df.withColumn("_v", text).withColumn("_id", F.when(changed, F.sha2(F.concat(F.lit("repair:"), F.col("id"), F.lit(digest([old, new]))), 256)).otherwise(F.col("id")))
    changes = rows.filter(F.col("_id") != F.col("id")).select(F.col("id").alias("old_id"), F.col("_id").alias("new_id"))
    return rows.withColumn("verification", F.col("_v")).withColumn("id", F.col("_id")).drop("_v", "_id"), changes


def quarantine(df: DataFrame, reason: Column) -> tuple[DataFrame, DataFrame]:
    """(kept, quarantined with `reason`)."""
    marked = df.withColumn("reason", reason)
    return marked.filter("reason is null").drop("reason"), marked.filter("reason is not null")


def screened(df: DataFrame) -> DataFrame:
    """Valid, admitted rows, the first delivery of each id and then of each family."""
    fine = df.filter(invalid_reason().isNull() & rejection_reason().isNull())
    return first_per_key(first_per_key(fine, "id", ["loaded_at"]), "family_id", ["created_at", "id"])
