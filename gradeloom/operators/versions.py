"""Versions of a data set and of a run: revisions, repairs, audits of splits, regrading, calibration, and frozen identities."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator, Mapping, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gradeloom.functions.ids import digest, json_digest, string_digest
from gradeloom.operators import grading, metrics, overlap, selection
from gradeloom.operators.screening import choice_problem, rejection_reason

#: The revision's name, tokens for an answer by domain, and what is added to prompts of mathematics.
REVISION = "quality-first-v2"
CAPS = {"math": 16384, "knowledge": 8192, "logic": 16384, "grounding": 8192, "quality": 16384, "instruction": 8192, "multiturn": 8192, "structure": 8192, "python": 16384}
BOX_END = "\nEnd with exactly one unambiguous final answer in \\boxed{...}. Do not give alternative final answers."
LONG_RESERVE, RETRIEVAL_CAP, WINDOW = 8192, 4096, 131072
NOMINAL_LABEL = "nominal published prompt-length profile; actual prompt tokens reported separately"
#: The repair's name, the pattern that lost a backslash, the right one, and the other one that is known.
REPAIR = "quality-v3-mcqa-extraction"
BROKEN_BOX, RIGHT_BOX, ANSWER_LINE = r"\boxed\{\s*([A-Za-z0-9])\s*\}", r"\\boxed\{\s*([A-Za-z0-9])\s*\}", r"Answer\s*:\s*(?!Answer)\s*([A-Za-z0-9])\s*"
#: Verifiers that a judge decides; one answer in HELD_OUT_OF is kept for the final check.
JUDGED = ("quality", "rubric", "alias", "grounded", "equivalence", "structure")
_DEMO = re.compile(r"\nlabel: \d+\n\n")


def issue(generated_task: str = "biggen", structured_task: str = "structeval") -> Column:
    """Why a row is set aside before a revision, null if it isn't: the stratum whose references need review, and prompts that ask
    to extract from something given."""
    text = F.array_join(F.transform("messages", lambda m: F.coalesce(m.content, F.lit(""))), "\n")
    return F.when((F.col("task") == generated_task) & (F.col("stratum") == "planning/reward_modeling"), "reference_and_environment_consistency_requires_review").when(
        (F.col("task") == structured_task) & text.rlike(r"(?iU)\bextract\w*\b") & text.rlike(r"(?iU)\b(?:given|provided|input|description)\b"), "extraction_source_presence_requires_review"
    )


def trimmed_demonstrations(text: str, fits: Callable[[str], bool]) -> tuple[str | None, int]:
    """(text, demonstrations removed): a prompt of header, whole demonstrations and query, cut after the most leading ones that
    fit; null if its parts cannot be told apart or nothing fits."""
    head, blank, body = text.partition("\n\n")
    ends = [m.end() for m in _DEMO.finditer(body)]
    query = body[ends[-1] :] if ends else ""
    if not blank or not query.strip():
        return None, 0
    demos = [body[a : b - 2] for a, b in zip([0, *ends], ends)]
    build = lambda n: "\n\n".join([head, *demos[:n], query])
    low, high = 0, len(demos)  # build(low) fits, or low is 0
    while low < high:
        mid = (low + high + 1) // 2
        low, high = (mid, high) if fits(build(mid)) else (low, mid - 1)
    return (build(low), len(demos) - low) if low else (None, 0)


def revise(rows: DataFrame, count_tokens: Callable[[list[list[dict]]], list[int]], window: int = WINDOW, reserve: int = LONG_RESERVE) -> tuple[DataFrame, DataFrame]:
    """(rows, set aside). Rows get a new id, the old one as source_record_id, a budget by domain and the window; prompts of
    mathematics the box instruction. Of long contexts, whole demonstrations are removed until prompt and answer fit; one that
    does not fit is set aside with its reason, as are rows with an issue. count_tokens(list of conversations) is injected and
    called on long contexts only."""
    if reserve < 1:
        raise ValueError("reserve")
    marked = rows.withColumn("_why", issue())
    out = marked.filter("_why is null").drop("_why")
    low = F.lower(F.trim("domain"))
    caps = F.create_map(*[F.lit(x) for kv in CAPS.items() for x in kv])
    is_long = low == "long_context"
    math = F.col("verifier") == "math"
    n = F.size("messages")
    ended = F.transform("messages", lambda m, i: F.struct(m.role.alias("role"), F.when(math & (i == n - 1), F.concat(m.content, F.lit(BOX_END))).otherwise(m.content).alias("content")))
    policy = F.when(math, F.regexp_replace("verification", r"\}\s*$", F.lit(',"answer_policy":"' + grading.ONE_BOX + '"}'))).otherwise(F.col("verification"))
    cap = F.when(is_long, F.when(F.col("verifier") == "retrieval", min(RETRIEVAL_CAP, reserve)).otherwise(reserve)).otherwise(F.try_element_at(caps, low))
    new = out.withColumn("source_record_id", F.col("id")).withColumn("data_policy", F.lit(REVISION)).withColumn("messages", ended).withColumn("verification", policy).withColumn("max_new_tokens", cap.cast("int"))
    new = new.withColumn("context_window", F.lit(window)).withColumn("bucket_semantics", F.when(is_long, NOMINAL_LABEL).otherwise(F.col("bucket_semantics")) if "bucket_semantics" in rows.columns else F.when(is_long, NOMINAL_LABEL))
    schema = T.StructType([*new.schema.fields, T.StructField("removed_demonstrations", T.IntegerType()), T.StructField("reference_prompt_tokens", T.IntegerType()), T.StructField("_why", T.StringType())])

    def fit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            removed, tokens, why, said = [], [], [], []
            for m, c, stratum in zip(pdf["messages"], pdf["max_new_tokens"], pdf["stratum"]):
                m = [{"role": x["role"], "content": x["content"]} for x in m]
                size = lambda text: count_tokens([[{**m[0], "content": text}, *m[1:]]])[0]  # noqa: B023, E731
                count, gone, reason = count_tokens([m])[0], 0, None
                if count + c > window and stratum == "icl":
                    text, gone = trimmed_demonstrations(m[0]["content"], lambda t: size(t) + c <= window)  # noqa: B023
                    if text is not None:
                        m[0]["content"], count = text, size(text)
                    elif not _DEMO.search(m[0]["content"].partition("\n\n")[2]):
                        reason = "ICL_demonstration_boundaries_require_review"
                removed.append(gone)
                tokens.append(count)
                said.append(m)
                why.append(reason or ("high_reasoning_budget_exceeds_native_window" if count + c > window else None))
            yield pdf.assign(messages=said, removed_demonstrations=removed, reference_prompt_tokens=tokens, _why=why)

    plain = new.filter(~F.coalesce(is_long, F.lit(False))).withColumn("removed_demonstrations", F.lit(None).cast("int")).withColumn("reference_prompt_tokens", F.lit(None).cast("int")).withColumn("_why", F.lit(None).cast("string"))
    fitted = plain.unionByName(new.filter(is_long).mapInPandas(fit, schema))
    ident = F.concat(F.lit("["), F.to_json(F.array("source_record_id")), F.lit(","), F.to_json("messages"), F.lit(f',"{REVISION}",'), F.col("max_new_tokens").cast("string"), F.lit(f",{window}]"))
    kept = fitted.filter("_why is null").drop("_why").withColumn("id", json_digest(ident))
    aside = marked.filter("_why is not null").select("id", "task", F.col("_why").alias("reason")).unionByName(fitted.filter("_why is not null").select(F.col("source_record_id").alias("id"), "task", F.col("_why").alias("reason")))
    return kept, aside


def repair_choices(rows: DataFrame, task: str = "mcqa") -> tuple[DataFrame, DataFrame, DataFrame]:
    """(rows, changes, set aside) of multiple-choice extraction: rows whose gold or labels are broken are set aside; the pattern
    that lost a backslash is put right, with a new id. A row of the task with an unknown pattern is an error (raise_error), as a
    repair must not guess."""
    gold = F.try_parse_json("verification")
    at = lambda p, of: F.try_variant_get(gold, p, of)
    mine = F.col("task") == task
    d = rows.withColumn("_bad", mine & choice_problem(at("$.answer", "string"), at("$.labels", "array<string>"))).withColumn("_p", F.when(mine, at("$.output_regex", "string")))
    d = d.withColumn("_broken", F.coalesce(F.col("_p") == BROKEN_BOX, F.lit(False)))
    known = ~mine | F.coalesce(F.col("_p").isin(BROKEN_BOX, RIGHT_BOX, ANSWER_LINE), F.lit(False))
    esc = lambda s: s.replace("\\", "\\\\")
    right = F.when(~known, F.raise_error(F.lit("unrecognized choice metadata"))).when(F.col("_broken"), F.replace(F.col("verification"), F.lit(esc(BROKEN_BOX)), F.lit(esc(RIGHT_BOX)))).otherwise(F.col("verification"))
    new = d.filter(~F.coalesce("_bad", F.lit(False))).withColumn("verification", right).withColumn("_old", F.col("id")).withColumn("id", F.when(F.col("_broken"), json_digest(F.to_json(F.array("id", F.lit(REPAIR), "verification")))).otherwise(F.col("id")))
    drop = ("_bad", "_p", "_broken")
    return new.drop(*drop, "_old"), new.filter("_broken").select(F.col("_old").alias("old_id"), F.col("id").alias("new_id")), d.filter("_bad").select("id", F.lit("invalid_gold_or_duplicate_option_labels").alias("reason"))


def uncompilable(rows: DataFrame) -> DataFrame:
    """Ids whose extraction pattern does not compile."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import regex

        def bad(p: str) -> bool:
            try:
                regex.compile(p)
            except regex.error:
                return True
            return False

        for pdf in batches:
            yield pdf.loc[[bad(p) for p in pdf["p"]], ["id"]]

    p = F.get_json_object("verification", "$.output_regex")
    return rows.select("id", p.alias("p")).filter("p is not null").mapInPandas(run, "id string")


def choice_round_trip(rows: DataFrame, task: str = "mcqa") -> DataFrame:
    """Per row of the task, whether every label in its asked format scores as it must: 1 for gold, else 0; a stray mention of gold
    before a wrong label, an empty text and a cut-off right answer score 0. `id`, `passed`."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import json

        for pdf in batches:
            ok = []
            for v in pdf["verification"]:
                meta = json.loads(v)
                labels, answer, box = meta["labels"], str(meta["answer"]), meta.get("output_regex") == RIGHT_BOX
                show = lambda x: f"Answer: \\boxed{{{x}}}" if box else f"Answer: {x}"  # noqa: B023, E731
                score = lambda text, finish="stop": grading.rule_grade("choice", v, True, "", text, finish, task=task)[1]  # noqa: B023, E731
                wrong = next((x for x in labels if x != answer), None)
                ok.append(wrong is not None and all(score(show(x)) == (x == answer) for x in labels) and not score(f"Much about {answer}\n{show(wrong)}") and not score("") and not score(f"oxed{{{answer}}}") and not score(show(answer), "length"))
            yield pdf[["id"]].assign(passed=ok)

    return rows.filter(F.col("task") == task).select("id", "verification").mapInPandas(run, "id string, passed boolean")


def audit_splits(rows: DataFrame, keys: str = "family_keys") -> tuple[DataFrame, DataFrame]:
    """(splits, overlaps): per split its rows, distinct ids, rows that screening would reject and long contexts; and the family
    keys that two splits share. A data set passes if ids are distinct, nothing is screened out or shared, and only main_test
    has long contexts."""
    bad, long = rejection_reason().isNotNull(), F.lower(F.trim("domain")) == "long_context"
    out = rows.groupBy("split").agg(F.count("*").alias("rows"), F.countDistinct("id").alias("ids"), F.count_if(bad).alias("screened"), F.count_if(long).alias("long_contexts"))
    fine = (F.col("rows") == F.col("ids")) & (F.col("screened") == 0) & ((F.col("split") == "main_test") | (F.col("long_contexts") == 0))
    return out.withColumn("passed", fine), overlap.overlap_counts(rows, "split", keys)


def screened_pool(pool: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(pool, excluded): a reserved pool without the rows that screening rejects, which are listed with their reason."""
    marked = pool.withColumn("reason", rejection_reason())
    return marked.filter("reason is null").drop("reason"), marked.filter("reason is not null").select("id", "reason")


def row_hash(rows: DataFrame, line: str = "line") -> DataFrame:
    return rows.withColumn("row_hash", json_digest(F.col(line)))


#: Fields of a scoring request.
REQUEST_FIELDS = ("request_id", "protocol_id", "split", "row_id", "row_hash", "response")


def attach_gold(requests: DataFrame, rows: DataFrame, protocol: str, excluded: DataFrame | None = None) -> DataFrame:
    """Requests with their row's gold (verifier, verification, binary, messages, domain, task) and `reason` why they cannot be
    graded, null if they can: another protocol, an unknown row or one that changed, a quarantined one, one of several turns, a
    response without text, or one that did not end. rows: split, id, row_hash, the gold columns, turns. A row is attached to any
    number of requests; requests stay where they are if rows are few."""
    from gradeloom.session import small

    gold = rows.select(F.col("split").alias("_split"), F.col("id").alias("_id"), F.col("row_hash").alias("_hash"), F.coalesce(F.size("turns") > 0, F.lit(False)).alias("_many"), "verifier", "verification", "binary", "messages", "domain", "task")
    if excluded is not None:
        gold = gold.join(small(excluded.select(F.col("id").alias("_id"), F.lit(True).alias("_out")).distinct()), "_id", "left")
    else:
        gold = gold.withColumn("_out", F.lit(None).cast("boolean"))
    d = requests.join(small(gold), (F.col("split") == F.col("_split")) & (F.col("row_id") == F.col("_id")), "left")
    size = F.length("request_id")
    reason = (
        F.when(~F.col("protocol_id").eqNullSafe(F.lit(protocol)), "protocol changed").when(~F.coalesce(size.between(1, 512), F.lit(False)), "request identity")
        .when(F.col("_id").isNull() | ~F.col("row_hash").eqNullSafe(F.col("_hash")), "unknown or changed row").when(F.coalesce("_out", F.lit(False)), "quarantined").when(F.col("_many"), "several turns")
        .when(F.col("response.text").isNull(), "no text").when(~F.coalesce(F.col("response.finish_reason").isin("stop", "length"), F.lit(False)), "not a completion")
    )
    return d.withColumn("reason", reason).drop("_split", "_id", "_hash", "_many", "_out")


def fingerprint(config: Mapping, rows_hash: str, code_hash: str) -> str:
    """Identity of a run: it may be resumed only under the same one."""
    return digest([dict(config), rows_hash, code_hash])


def protocol_id(manifest: Mapping, protocol: Mapping, code_hash: str, excluded: Mapping[str, str]) -> str:
    """Identity under which scores may be compared."""
    return digest({"manifest": dict(manifest), "protocol": dict(protocol), "code": code_hash, "excluded_rows": dict(excluded)})


def code_hash(package: str = "gradeloom") -> str:
    """Digest of a package's source files by name."""
    import hashlib
    import importlib
    from pathlib import Path

    root = Path(importlib.import_module(package).__file__).parent
    return digest({str(p.relative_to(root)): hashlib.sha256(p.read_bytes()).hexdigest() for p in sorted(root.rglob("*.py"))})


def regrade(turns: DataFrame, rows: DataFrame, source_run: str, instructions: Callable | None = None, run_code: Callable | None = None) -> tuple[DataFrame, DataFrame]:
    """(turn grades, sample grades) of stored responses, nothing is generated. turns: id, sample, turn, text, finish. rows: id,
    verifier, verification, binary, messages, turns, domain, task. A turn of a conversation of several is graded by its own rules;
    a sample with fewer turns than its row is an error unless its last turn was cut off. Both carry `source_run`."""
    many = F.coalesce(F.greatest(F.size("turns"), F.lit(1)), F.lit(1))
    gold = rows.select("id", "verifier", "verification", "binary", F.lower(F.trim("domain")).alias("domain"), "task", F.try_element_at("messages", F.lit(-1))["content"].alias("_last"), "turns", many.alias("expected"))
    d = turns.join(gold, "id")
    own = F.get("turns", F.col("turn"))
    rules = F.concat(F.lit('{"ids":'), F.to_json(own["ids"]), F.lit(',"kwargs":['), F.array_join(F.transform(own["kwargs"], lambda k: F.coalesce(k, F.lit("null"))), ","), F.lit("]}"))
    d = d.withColumn("verification", F.when(own.isNotNull(), rules).otherwise(F.col("verification"))).withColumn("prompt", F.when(own.isNotNull() & (F.col("turn") > 0), own["message"]).otherwise(F.col("_last"))).withColumn("capped", F.col("finish") == "length")
    per_turn = grading.grade(d, ["id", "sample", "turn", "expected", "capped"], instructions, run_code).withColumn("source_run", F.lit(source_run))
    return per_turn, grading.trajectory_grade(per_turn, ["id", "sample"], "expected").withColumn("source_run", F.lit(source_run))


def review_cases(answers: DataFrame, limit: int = 400) -> tuple[DataFrame, DataFrame]:
    """(blinded cases, private grades) for a review: judged answers, each with a case id (hash of id, sample and text) and a role by
    its family ('heldout' or 'development'), drawn round-robin over domains in the order of the hash of their case ids. answers:
    id, sample, family_id, domain, task, verifier, messages, verification, text, finish, status, score, passed."""
    case = json_digest(F.concat(F.lit("["), _quoted("id"), F.lit(","), F.col("sample").cast("string"), F.lit(","), _quoted("text"), F.lit("]")))
    d = answers.filter(F.col("verifier").isin(*JUDGED) & F.col("text").isNotNull()).withColumn("case_id", case).withColumn("role", F.when(selection.held_out(F.col("family_id")), "heldout").otherwise("development"))
    chosen = selection.balanced(d, "domain", string_digest(F.col("case_id")), "case_id", limit)
    return chosen.select("case_id", "family_id", "domain", "task", "role", "messages", "verification", "verifier", "text", "finish", "pick"), chosen.select("case_id", "status", "score", "passed")


def _quoted(c: str) -> Column:
    j = F.to_json(F.array(c))
    return F.substr(j, F.lit(2), F.length(j) - 2)


def calibration_report(cases: DataFrame, grades: DataFrame, reviews: DataFrame) -> DataFrame:
    """Per domain and role: reviewed and pending cases, invalid grades, false accepts among negatives with the upper bound of
    their rate, false rejects among positives, mean absolute error of scores, issues with references. cases: case_id, domain,
    role; grades: case_id, status, score, passed; reviews: case_id, status, reviewer_id, rationale, expected_pass, expected_score,
    reference_issue, one row per case at most. A case without a full review is pending and counts for nothing else."""
    d = cases.select("case_id", "domain", "role").join(grades.withColumnRenamed("status", "grade_status"), "case_id", "left").join(reviews.withColumnRenamed("status", "review_status"), "case_id", "left")
    c = F.col
    done = F.coalesce((c("review_status") == "reviewed") & (F.coalesce(c("reviewer_id"), F.lit("")) != "") & (F.coalesce(c("rationale"), F.lit("")) != ""), F.lit(False))
    neg, pos = done & ~c("expected_pass"), done & c("expected_pass")
    err = F.when(done & (c("grade_status") == "valid"), F.abs(c("score") - c("expected_score")))
    out = d.groupBy("domain", "role").agg(
        F.count_if(done).alias("reviewed"), F.count_if(~done).alias("pending"), F.count_if(done & ~F.coalesce(c("grade_status") == "valid", F.lit(False))).alias("invalid"), F.count_if(neg).alias("negatives"), F.count_if(neg & c("passed")).alias("false_accepts"),
        F.count_if(pos).alias("positives"), F.count_if(pos & ~c("passed")).alias("false_rejects"), F.avg(err).alias("mae"), F.count_if(done & (F.coalesce(c("reference_issue"), F.lit("")) != "")).alias("reference_issues"),
    )
    return out.withColumn("false_accept_rate", c("false_accepts") / F.nullif(c("negatives").cast("double"), F.lit(0.0))).withColumn("false_accept_upper", metrics.wilson_upper(c("false_accepts"), c("negatives")))


def audit_references(rows: DataFrame, run_code: Callable, attempts: int = 3) -> DataFrame:
    """Whether a published solution of each program row passes its own tests: `id`, `tried`, `passed`; the first `attempts`
    solutions are tried until one does."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import json

        for pdf in batches:
            tried, passed = [], []
            for kind, v in zip(pdf["verifier"], pdf["verification"]):
                meta = json.loads(v)
                programs = [meta.get("prompt", "") + meta.get("canonical_solution", "")] if kind == "humanevalplus" else meta.get("reference_solutions", [])[:attempts]
                n = ok = 0
                for p in programs:
                    n += 1
                    if run_code(meta, p):
                        ok = 1
                        break
                tried.append(n)
                passed.append(bool(ok))
            yield pdf[["id"]].assign(tried=tried, passed=passed)

    return rows.filter(F.col("verifier").isin("humanevalplus", "apps")).select("id", "verifier", "verification").mapInPandas(run, "id string, tried int, passed boolean")


def audit_scorer(cases: DataFrame, expected: str = "expected", **injected) -> DataFrame:
    """Fixed cases against what the rules give: the columns of grading.grade and `case`, `expected`; `matches` is null where the
    judge has to decide."""
    got = grading.grade(cases, ["case", expected], **injected)
    return got.withColumn("matches", F.when(F.col("status") == "valid", F.col("score") == F.col(expected)).when(F.col("status") == "error", F.lit(False)))


def removed_lists(df: DataFrame, column: str, lists: Sequence[Sequence[str]]) -> DataFrame:
    """df without the rows whose list equals one of the given lists as a whole."""
    if not lists:
        return df
    known = F.array(*[F.array(*map(F.lit, x)) if x else F.array().cast("array<string>") for x in lists])
    return df.filter(~F.coalesce(F.array_contains(known, F.col(column)), F.lit(False)))
