"""Long-context prompts: templates of retrieval tasks, whole passages within a token budget, demonstrations with permuted labels."""

from __future__ import annotations

import random
from collections.abc import Callable, Iterator, Sequence
from itertools import zip_longest

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gradeloom.functions.ids import digest, family_of, json_digest
from gradeloom.operators.rubrics import spread_quota

#: Tasks of retrieval, lengths, prompts of the whole profile, the share of retrieval in it.
RETRIEVAL = ("niah_single_1", "niah_single_2", "niah_single_3", "niah_multikey_1", "niah_multivalue", "niah_multiquery", "vt", "cwe", "fwe", "qa_1")
LENGTHS, PROFILE, RETRIEVAL_SHARE = (4096, 8192, 16384, 32768, 65536, 131072), 436, 0.6
SEVERAL = ("niah_multivalue", "niah_multiquery")
#: Tokens for the answer, tokens that a prompt's frame may take, share of the length that a prompt must fill.
ANSWER, FRAME, LEAST_FILL = 256, 64, 0.65
#: Texts of the prompts.
RAG_START = "Use the supplied documents to answer the question. Give only the short answer.\n\n"
ICL_START = 'Use the provided text-to-label mapping. Output only "label: <number>".\n\n'
ICL_PATTERN = r"label:\s*(\d+)\s*$"


def quotas(lengths: Sequence[int] = LENGTHS, total: int = PROFILE) -> dict[tuple[int, str], int]:
    """Prompts per length and task: the total evenly over lengths, of each the retrieval share evenly over its tasks as far as
    whole numbers go, and what is left to rag and icl, icl taking the odd one."""
    if len(set(lengths)) < len(lengths) or set(lengths) - set(LENGTHS):
        raise ValueError("lengths")
    out = {}
    for length, budget in spread_quota(total, list(map(str, lengths))).items():
        each = int(budget * RETRIEVAL_SHARE) // len(RETRIEVAL)
        left = budget - each * len(RETRIEVAL)
        out |= {(int(length), t): each for t in RETRIEVAL} | {(int(length), "rag"): left // 2, (int(length), "icl"): left - left // 2}
    return out


def retrieval_prompt(task: Column) -> Column:
    """The prompt of a retrieval task from its columns context, query, type_needle_v, example, question."""
    c = lambda n: F.coalesce(F.col(n), F.lit(""))
    ask = F.when(task.isin(*SEVERAL), "are all").otherwise("is")
    needle = F.concat(F.lit("Some special magic "), c("type_needle_v"), F.lit(" are hidden within the following text. Make sure to memorize it.\n"), c("context"), F.lit("\nWhat "), ask, F.lit(" the special magic "), c("type_needle_v"), F.lit(" for "), c("query"), F.lit(" mentioned in the provided text?"))
    return (
        F.when(task.startswith("niah"), needle)
        .when(task == "vt", F.concat(c("example"), F.lit("\nMemorize and track the chains of variable assignment.\n"), c("context"), F.lit("\nFind all variables assigned the value "), c("query"), F.lit(".")))
        .when(task == "cwe", F.concat(c("example"), F.lit("\n"), c("context"), F.lit("\nWhat are the 10 most common words in the above list?")))
        .when(task == "fwe", F.concat(c("context"), F.lit("\nIgnore the dots. What are the three most frequently appeared coded words? Give only the words.")))
        .otherwise(F.concat(F.lit("Answer based only on the given documents. Give only the short answer.\n\n"), c("context"), F.lit("\nQuestion: "), c("question")))
    )


def retrieval_rows(raw: DataFrame, task: str = "task", ordinal: str = "ordinal") -> DataFrame:
    """prompt, family_text and verification of retrieval rows: targets are the answers (or outputs), any of which is enough for
    questions about documents."""
    t = F.col(task)
    qa = t.startswith("qa")
    family = F.when(qa, F.col("question")).otherwise(F.concat(F.lit("RULER/"), t, F.lit("/"), F.coalesce(F.col("index").cast("string"), F.col(ordinal).cast("string"))))
    gold = F.to_json(F.struct(F.coalesce("answer", "outputs").alias("targets"), qa.alias("any_alias")))
    return raw.withColumn("prompt", retrieval_prompt(t)).withColumn("family_text", family).withColumn("verification", gold).withColumn("verifier", F.lit("retrieval"))


def _passage(c: Column) -> Column:
    return F.concat(F.lit("Document (Title: "), c["title"], F.lit("): "), c["text"])


def rag_rows(raw: DataFrame, length: int, token_counts: Callable[[pd.Series], pd.Series]) -> DataFrame:
    """Questions with the leading whole passages that fit the length. `reason` for rows of which no kept passage has the answer.
    raw: question, answers, ctxs array<struct<title, text>>, positive_ctxs array<struct<text>>. token_counts: a pandas UDF from
    array<string> to array<int>; the sums and the cut are built-in expressions."""
    texts = F.transform("ctxs", lambda c: F.concat(_passage(c), F.lit("\n\n")))
    frame = F.concat(F.lit(RAG_START + "\nQuestion: "), F.col("question"))
    d = raw.withColumn("_n", token_counts(F.concat(F.array(frame), texts)))
    # the running size up to each passage; the first overflow ends the list
    fits = F.transform("ctxs", lambda c, i: F.aggregate(F.slice("_n", F.lit(1), i + 2), F.lit(ANSWER + FRAME), lambda a, x: a + x) <= length)
    kept = F.aggregate(fits, F.struct(F.lit(0).alias("n"), F.lit(True).alias("on")), lambda a, f: F.struct((a["n"] + (a["on"] & f).cast("int")).alias("n"), (a["on"] & f).alias("on")), lambda a: a["n"])
    d = d.withColumn("_kept", kept).withColumn("_ctxs", F.slice("ctxs", F.lit(1), F.col("_kept")))
    gold = F.transform("positive_ctxs", lambda c: c["text"])
    supported = F.exists("_ctxs", lambda c: F.array_contains(gold, c["text"]))
    prompt = F.concat(F.lit(RAG_START), F.array_join(F.transform("_ctxs", _passage), "\n\n"), F.lit("\nQuestion: "), F.col("question"))
    verification = F.to_json(F.struct(F.col("answers").alias("aliases"), "question"))
    return d.withColumn("prompt", prompt).withColumn("family_text", F.col("question")).withColumn("verification", verification).withColumn("verifier", F.lit("alias")).withColumn("reason", F.when(~F.coalesce(supported, F.lit(False)), "unanswerable_selected_context")).drop("_n", "_ctxs", "_kept")


def demonstration_order(question: str, pool: dict[int, list[str]], classes: int) -> tuple[list[int], list[tuple[int, str]]]:
    """(number shown for each class, demonstrations) for one question: seeded by its digest. Classes are drawn in turn, in a new
    order each round, every demonstration once."""
    draw = random.Random(int(digest(question)[:8], 16) + 42)
    shown = list(range(classes))
    draw.shuffle(shown)
    mixed = {c: draw.sample(texts, len(texts)) for c, texts in pool.items()}
    out: list[tuple[int, str]] = []
    for texts in zip_longest(*mixed.values()):
        now = dict(zip(mixed, texts))
        order = list(mixed)
        draw.shuffle(order)
        out += [(c, now[c]) for c in order if now[c] is not None]
    return shown, out


def icl_rows(raw: DataFrame, demonstrations: Sequence[tuple[str, int]], length: int, count_tokens: Callable[[list[str]], list[int]]) -> DataFrame:
    """Questions (text, label) behind as many whole demonstrations as the length holds, with labels renamed per question. The
    demonstrations are a fixed set of examples, sent to the tasks; one that equals the question is passed over."""
    pool: dict[int, list[str]] = {}
    for text, label in demonstrations:
        pool.setdefault(label, []).append(text)
    classes = 1 + max(pool, default=-1)
    sent = raw.sparkSession.sparkContext.broadcast((pool, classes))
    schema = T.StructType([*raw.schema.fields, *[T.StructField(n, T.StringType()) for n in ("prompt", "family_text", "verification", "verifier")]])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import json

        pool, classes = sent.value
        for pdf in batches:
            prompts, gold = [], []
            for text, label in zip(pdf["text"], pdf["label"]):
                shown, demos = demonstration_order(text, pool, classes)
                same = text.strip().casefold()
                lines = [f"{t}\nlabel: {shown[c]}" for c, t in demos if t.strip().casefold() != same]
                size, kept = count_tokens([ICL_START + "\n\n" + text])[0] + ANSWER + FRAME, []
                for line, n in zip(lines, count_tokens([f"{x}\n\n" for x in lines])):
                    size += n
                    if size > length:
                        break
                    kept.append(line)
                prompts.append(ICL_START + "\n\n".join(kept) + "\n\n" + text)
                gold.append(json.dumps({"answer": str(shown[label]), "output_regex": ICL_PATTERN}))
            yield pdf.assign(prompt=prompts, family_text=pdf["text"], verification=gold, verifier="exact")

    return raw.mapInPandas(run, schema)


def admitted(rows: DataFrame, length: int, prompt_tokens: str = "prompt_tokens") -> DataFrame:
    """rows with `reason` where prompt and answer do not fit the length, or the prompt fills less than LEAST_FILL of it."""
    n = F.col(prompt_tokens)
    out = F.when(F.coalesce((n + ANSWER > length) | (n < LEAST_FILL * length), F.lit(True)), "outside_bucket")
    return rows.withColumn("reason", F.coalesce("reason", out) if "reason" in rows.columns else out)


def long_rows(rows: DataFrame, task: str, name: str, length: int, repo: str, revision: str, ordinal: str = "ordinal") -> DataFrame:
    """Canonical rows of prompts that were admitted."""
    ident = json_digest(F.concat(F.lit(f'["{task}",'), F.col(ordinal).cast("string"), F.lit(f',"{revision}",'), F.substr(F.to_json(F.array("prompt")), F.lit(2), F.length(F.to_json(F.array("prompt"))) - 2), F.lit("]")))
    return rows.filter("reason is null").select(
        ident.alias("id"), family_of(F.col("family_text")).alias("family_id"), "family_text", F.lit(task).alias("task"), F.lit("long_context").alias("domain"), F.lit(name).alias("stratum"), F.array(F.struct(F.lit("user").alias("role"), F.col("prompt").alias("content"))).alias("messages"),
        "verifier", "verification", F.lit(True).alias("binary"), F.lit(ANSWER).alias("max_new_tokens"), F.lit(length).alias("context_window"), F.lit(length).alias("length_bucket"), F.col("prompt_tokens").alias("reference_prompt_tokens"),
        F.to_json(F.struct(F.lit(repo).alias("repo"), F.lit(revision).alias("revision"), F.col(ordinal).alias("row_id"))).alias("source"),
    )
