"""Grading in two stages: rules first, an injected judge for what they cannot decide."""

from __future__ import annotations

import csv
import io
import json
import re
import tomllib
from collections.abc import Callable, Iterator
from fractions import Fraction
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gradeloom.functions import extract as X
from gradeloom.functions import schema as S
from gradeloom.functions.schedule import verify_schedule

#: How much a verifier needs the judge, from never to for every answer.
JUDGE_USES = ("none", "on_miss", "to_pass", "always")
JUDGE_USE = {"math": "none", "choice": "none", "instruction": "none", "retrieval": "none", "calendar": "none", "humanevalplus": "none", "apps": "none", "exact": "none", "alias": "on_miss", "structure": "to_pass", "grounded": "always", "equivalence": "always", "quality": "always", "rubric": "always"}
#: What a prompt says when it wants a final line, and the policy that wants exactly one box.
FINAL_LINE, ONE_BOX = "End with 'Final answer:", "explicit_final_box_v2"
#: Formats of structured answers.
FORMATS = ("json", "yaml", "xml", "toml", "csv")

GRADE = "status string, score double, passed boolean, reason string, needs_judge boolean, components string"


def judge_use(verifier: Column, domain: Column) -> Column:
    """How much a row needs the judge; 'exact' does on a miss in the domain of logic; null for an unknown verifier."""
    table = F.create_map(*[F.lit(x) for kv in JUDGE_USE.items() for x in kv])
    return F.when((verifier == "exact") & (F.lower(F.trim(domain)) == "logic"), "on_miss").otherwise(F.try_element_at(table, verifier))


def judge_use_by_task(rows: DataFrame) -> DataFrame:
    """Per task the most that any of its rows needs the judge (columns task, verifier, domain)."""
    names = F.array(*map(F.lit, JUDGE_USES))
    at = F.array_position(names, judge_use(F.col("verifier"), F.col("domain")))
    return rows.groupBy("task").agg(F.max(F.nullif(at, F.lit(0))).alias("_at")).select("task", F.try_element_at(names, F.col("_at").cast("int")).alias("judge_use"))


def number(text: str) -> Fraction | None:
    """Value of a numeral, fraction, percentage or LaTeX fraction; the symbolic part of equality is left to an injected function."""
    t = re.sub(r"\\(?:left|right|,|;|!|\$)|[\s$]|(?<=\d),(?=\d{3}\b)", "", text)
    t = re.sub(r"\\[dt]?frac\{(-?[\d.]+)\}\{(-?[\d.]+)\}", r"\1/\2", t).rstrip(".")
    pct = t.endswith(("%", "\\%"))
    try:
        got = Fraction(t.rstrip("%\\"))
    except (ValueError, ZeroDivisionError):
        return None
    return got / 100 if pct else got


def same_math(a: str, b: str) -> bool:
    x, y = number(a), number(b)
    return x == y if x is not None and y is not None else re.sub(r"\s+", "", a) == re.sub(r"\s+", "", b)


def _valid(score: float, passed: bool | None, reason: str | None, **components) -> tuple:
    return ("valid", float(score), passed, reason, False, json.dumps(components, ensure_ascii=False, sort_keys=True) if components else None)


def _verdict(ok: bool, **components) -> tuple:
    return _valid(ok, bool(ok), None if ok else "wrong answer", **components)


def _error(why: str) -> tuple:
    return ("error", None, None, why, False, None)


def _pending(why: str = "judge", **components) -> tuple:
    """A row for the next stage; its components tell what the judge has to look at."""
    return ("pending", None, None, why, True, json.dumps(components, ensure_ascii=False, sort_keys=True) if components else None)


def rule_grade(verifier: str, verification: str | None, binary: bool | None, prompt: str | None, text: str | None, finish: str | None, domain: str | None = None, task: str | None = None,
               instructions: Callable | None = None, run_code: Callable | None = None) -> tuple:
    """(status, score, passed, reason, needs_judge, components) of one response. Gates in order: reasoning that never ends
    (finish 'stop'), a finish reason that is neither stop nor length (error), the token limit, an empty response, a missing
    final line, a missing box; then the verifier's rule. An error is never a score of 0; a missing text is an error.
    instructions(id, kwargs, text, prompt) -> bool and run_code(verification, program) -> bool are injected; without them
    such rows are 'outside'."""
    miss = False if binary is not False else None
    if text is None:
        return _error("no text")
    body = X.answer_text(text)
    if finish == "stop" and body is None:
        return _valid(0, miss, "unfinished reasoning", failure="unfinished_reasoning", incomplete=True)
    if finish not in ("stop", "length"):
        return _error(f"finish {finish}")
    if finish == "length":
        return _valid(0, miss, "truncated", failure="candidate_truncated")
    if not body.strip():
        return _valid(0, miss, "empty", failure="empty_response")
    prompt = prompt or ""
    if FINAL_LINE in prompt and not X.final_line(body):
        return _valid(0, False, "format missing", failure="format missing: final line")
    try:
        meta = json.loads(verification) if verification else {}
        pattern = meta.get("output_regex")
        if verifier == "equivalence" and not pattern and "\\boxed" in prompt:
            pattern = X.BOX_PATTERN
            if not X.extract_final(body, pattern):
                return _valid(0, False, "format missing", failure="format missing: box")
        rule = _RULES.get(verifier)
        if rule is None:
            return _error(f"verifier {verifier}")
        return rule(meta, body, prompt, pattern, domain=domain, task=task, instructions=instructions, run_code=run_code)
    except TimeoutError:
        return _error("pattern: too slow")
    except (KeyError, TypeError, ValueError, AttributeError, LookupError, RuntimeError, re.error) as e:
        return _error(f"verification: {type(e).__name__}")


def _math(meta, body, prompt, pattern, **_):
    boxes = re.findall(r"\\boxed\s*\{", body)
    if meta.get("answer_policy") == ONE_BOX and len(boxes) != 1:
        return _valid(0, False, "wrong answer", extracted="not exactly one box")
    got = X.last_boxed(body) if boxes and not pattern else X.extract_final(body, pattern)
    return _verdict(same_math(got or "", str(meta["answer"])), extracted=got)


def _choice(meta, body, prompt, pattern, task=None, **_):
    labels, gold = [str(x) for x in meta["labels"]], str(meta["answer"])
    if task == "mcqa" and (gold not in labels or len(set(labels)) != len(labels) or len(labels) < 2):
        return _error("choice metadata")
    got, asked = X.choice_answer(body, labels, pattern)
    if not asked:
        return _valid(X.OTHER_FORMAT if got == gold else 0, False, "other format" if got == gold else "wrong answer", extracted=got, requested_format=False)
    return _verdict(got == gold, extracted=got)


def _alias(meta, body, prompt, pattern, **_):
    final = X.extract_final(body, pattern) or ""
    em, f1 = X.exact_match(final, meta["aliases"]), X.answer_f1(final, meta["aliases"])
    # more than the bare answer may contradict it: only that is decided here
    return _verdict(True, answer_em=1, answer_f1=f1) if em and body.strip() == final.strip() else _pending(answer_em=int(em), answer_f1=f1)


def _grounded(meta, body, prompt, pattern, **_):
    final = X.extract_final(body, pattern) or ""
    return _pending(answer_em=int(X.exact_match(final, meta["aliases"])), answer_f1=X.answer_f1(final, meta["aliases"]))


def _exact(meta, body, prompt, pattern, domain=None, **_):
    bare = lambda s: s.casefold().strip("(). ")
    got = X.extract_final(body, pattern) or ""
    ok = bare(got) == bare(str(meta["answer"]).strip())
    return _pending(extracted=got) if not ok and domain == "logic" else _verdict(ok, extracted=got)


def _equivalence(meta, body, prompt, pattern, **_):
    if pattern:
        got = X.extract_final(body, pattern)
    else:
        block = X.final_block(body)
        got = X.unemphasize(block) if block and block.strip() else body.strip()
    return _pending(extracted=got) if got else _valid(0, False, "wrong answer", failure="answer_extraction")


def _retrieval(meta, body, prompt, pattern, **_):
    block = X.final_block(body)
    where = (block if block and block.strip() else body).casefold()
    hits = [str(t).casefold() in where for t in meta["targets"]]
    if not hits:
        return _error("no targets")
    return _verdict(any(hits) if meta.get("any_alias") else all(hits), recall=sum(hits) / len(hits))


def _calendar(meta, body, prompt, pattern, **_):
    for part in X.structured_candidates(body):
        try:
            events = json.loads(part)
        except ValueError:
            continue
        return _verdict(verify_schedule(meta.get("calendar", meta), events), extracted_from_prose=part.strip() != body.strip())
    return _verdict(False)


def _structure(meta, body, prompt, pattern, **_):
    kind, schema = str(meta["format"]).lower(), meta.get("schema")
    if kind not in FORMATS:
        return _error(f"format {kind}")
    for part in X.structured_candidates(body, kind):
        try:
            value = parse_structured(part, kind, schema)
        except Exception:  # whatever a parser raises says that this is no data of the format
            continue
        if not schema and kind != "xml" and not isinstance(value, (dict, list)):
            continue
        if schema and (why := S.invalid(value, schema)):
            return _valid(0, False, "schema mismatch", schema=False, detail=why)
        return _pending(syntax=True, data=part)
    return _valid(0, False, "syntax", syntax=False)


def _instruction(meta, body, prompt, pattern, instructions=None, **_):
    if not meta["ids"] or len(meta["ids"]) != len(meta["kwargs"]):
        return _error("instruction metadata")
    if instructions is None:
        return _pending("outside")
    checks = [bool(instructions(i, {k: v for k, v in (kw or {}).items() if v is not None}, body, prompt)) for i, kw in zip(meta["ids"], meta["kwargs"])]
    return _verdict(all(checks), checks=checks, fraction_passed=sum(checks) / len(checks))


def _code(meta, body, prompt, pattern, run_code=None, **_):
    program, where = X.candidate_code(body, meta.get("entry_point"))
    if "code block" in prompt and where == "whole":
        return _valid(0, False, "format missing", failure="format missing: code block")
    program = X.with_helpers(meta.get("prompt"), meta.get("entry_point"), program)
    problem = X.code_problem(program, meta.get("entry_point"))
    found = {"syntax_error": True} if problem == "syntax" else {"defines_entry_point": problem is None} if meta.get("entry_point") else {}
    if run_code is None:
        return _pending("outside", source=where, **found)
    ok = bool(run_code(meta, program))
    return _verdict(ok, execution_status="passed" if ok else "failed", source=where, **found)


def _rubric(meta, body, prompt, pattern, **_):
    return _pending(checks=len(meta["checks"])) if meta["checks"] else _error("no checks")


def _quality(meta, body, prompt, pattern, **_):
    return _pending(rubric=meta.get("rubric"))


_RULES: dict[str, Callable[..., tuple]] = {"math": _math, "choice": _choice, "alias": _alias, "grounded": _grounded, "exact": _exact, "equivalence": _equivalence, "retrieval": _retrieval, "calendar": _calendar, "structure": _structure, "instruction": _instruction, "humanevalplus": _code, "apps": _code, "rubric": _rubric, "quality": _quality}


def parse_structured(text: str, kind: str, schema: dict | None = None):
    """The data that a text is in a format, CSV cells typed by the schema; raises if it is none."""
    if kind == "json":
        return json.loads(text)
    if kind == "toml":
        return tomllib.loads(text)
    if kind == "yaml":
        import yaml

        return yaml.safe_load(text)
    if kind == "xml":
        if "<!DOCTYPE" in text or "<!ENTITY" in text:
            raise ValueError("entities are refused")
        return ElementTree.fromstring(text)
    rows = list(csv.DictReader(io.StringIO(text), strict=True))
    if not rows:
        raise ValueError("no rows")
    return S.typed_rows(rows, schema) if schema else rows


_INPUT = ("verifier", "verification", "binary", "prompt", "text", "finish", "domain", "task")


def _keyed(df: DataFrame, keys: list[str]) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.select(*keys).schema) + ", " + GRADE


def _frame(pdf: pd.DataFrame, keys: list[str], got: list[tuple]) -> pd.DataFrame:
    return pd.concat([pdf[keys].reset_index(drop=True), pd.DataFrame(got, columns=["status", "score", "passed", "reason", "needs_judge", "components"])], axis=1)


def grade(responses: DataFrame, keys: list[str], instructions: Callable | None = None, run_code: Callable | None = None) -> DataFrame:
    """Stage one, without judge: keys and the grade of each response (columns verifier, verification, binary, prompt,
    text, finish, domain, and task if there is one). Rows stay where they are; other columns are not read."""
    have = [(F.col(c) if c in responses.columns else F.lit(None).cast("string")).alias(f"_in_{c}") for c in _INPUT]  # keys may have the same names

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            cols = [[None if x is None or x is pd.NA or x != x else x for x in pdf[f"_in_{c}"]] for c in _INPUT]
            yield _frame(pdf, keys, [rule_grade(*row, instructions=instructions, run_code=run_code) for row in zip(*cols)])

    return responses.select(*keys, *have).mapInPandas(run, _keyed(responses, keys))


#: Fields of a judgment, by kind.
_FIELDS = {True: {"score", "mandatory_pass", "reason"}, False: {"verdict", "reason"}}


def parse_judgment(reply: str, quality: bool, finish: str = "stop") -> dict:
    """The fields of a judge's reply, checked: exactly those of its kind, a reason with content, a score from 1 to 5."""
    if finish != "stop":
        raise ValueError("the judge was cut off")
    v = X.reply_json(reply)
    if not isinstance(v, dict) or set(v) != _FIELDS[quality] or not isinstance(v["reason"], str) or not v["reason"].strip():
        raise ValueError("other fields than a judgment has")
    if quality:
        return {**v, "score": X.judged_score(v["score"]), "mandatory_pass": X.judged_boolean(v["mandatory_pass"])}
    return {**v, "verdict": X.judged_boolean(v["verdict"])}


def judged(quality: bool, v: dict) -> tuple:
    """The grade of a judgment: a verdict passes or not; a quality score is scaled to 0 to 1 and passes nothing."""
    if quality:
        fine = v["mandatory_pass"]
        return _valid((v["score"] - 1) / 4 if fine else 0, None, None if fine else "mandatory check failed", acceptability=fine and v["score"] >= 4, mandatory_pass=fine)
    return _verdict(v["verdict"])


#: Fixed value: what a judge is told after a reply that cannot be read; the case itself never changes.
AGAIN = "Your last reply could not be read. Judge the same case again and reply with one JSON object of the fields asked for, nothing else."


def judge(pending: DataFrame, keys: list[str], ask: Callable[[list[dict]], list[dict]], attempts: int = 3, budget: int = 8192, most: int | None = None, context: int = 32768) -> DataFrame:
    """Stage two, on the rows that need it. ask gets a batch of rows, each with `budget` (tokens it may use) and `note` (null,
    or AGAIN), and returns replies {text, finish, prompt_tokens?}, or null where no reply came.

    A reply that was cut off is asked for again with twice the budget, up to `most` and as far as the context holds it; one
    that cannot be read with AGAIN. After the last attempt the row is an error, 'unanswered' if any attempt got no reply, else
    'ungradable'; never a 0. Write the result keyed by `keys`: a retried task may ask twice."""
    most = most or budget
    if attempts < 1 or most < budget:
        raise ValueError("attempts or budgets")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = [{**r, "budget": budget, "note": None} for r in pdf.to_dict("records")]
            got: list[tuple] = [_error("ungradable")] * len(rows)
            todo = list(range(len(rows)))
            for _ in range(attempts):
                left = []
                for i, reply in zip(todo, ask([rows[i] for i in todo]) if todo else []):
                    quality = rows[i].get("verifier") == "quality"
                    if reply is None:
                        got[i] = _error("unanswered")
                        left.append(i)
                        continue
                    try:
                        got[i] = judged(quality, parse_judgment(reply["text"], quality, reply.get("finish", "stop")))
                    except (ValueError, KeyError, TypeError):
                        left.append(i)
                        if reply.get("finish") == "length":
                            more = min(2 * rows[i]["budget"], most)
                            rows[i]["budget"] = more if (reply.get("prompt_tokens") or 0) + more <= context else rows[i]["budget"]
                        else:
                            rows[i]["note"] = AGAIN
                todo = left
            yield _frame(pdf, keys, got)

    return pending.mapInPandas(run, _keyed(pending, keys))


def trajectory_grade(turns: DataFrame, keys: list[str], expected: str | None = None) -> DataFrame:
    """One grade per conversation from those of its turns (columns turn, status, score, passed, capped): passed only if every
    turn is, with the share of turn scores. A conversation of one turn keeps its turn's grade; an error in a turn is an error
    of the whole. With `expected` (a column of turns that there should be), one that ends early without a capped last turn is
    an error, too."""
    last = F.max_by("capped", "turn")
    n = F.count("*")
    short = (n < F.max(expected)) & ~F.coalesce(last, F.lit(False)) if expected else F.lit(False)
    every = F.every(F.coalesce("passed", F.lit(False)))
    bad = F.count_if(F.coalesce(F.col("status") != "valid", F.lit(True))) > 0
    fine = ~bad & ~short
    one = n == 1
    return turns.groupBy(*keys).agg(
        F.when(fine, "valid").otherwise("error").alias("status"), F.when(fine, F.when(one, F.max("score")).otherwise(every.cast("double"))).alias("score"),
        F.when(fine, F.when(one, F.max("passed")).otherwise(every)).alias("passed"), F.when(fine & ~one, F.avg("score")).alias("turn_fraction"), n.alias("turns"),
    )


def grown_conversation(messages: Column, turns: Column, at: Column) -> Column:
    """The conversation that turn `at` (from 0) was asked with: the messages, then each earlier answer and the user's next turn.
    turns: array of structs with `answer` and `message` (the user's turn, unused for the first)."""
    said = lambda role, c: F.struct(F.lit(role).alias("role"), c.alias("content"))
    pairs = F.transform(F.slice(turns, F.lit(1), at), lambda t, i: F.array(said("assistant", t.answer), said("user", F.get(turns, i + 1).message)))
    return F.concat(messages, F.flatten(pairs))
