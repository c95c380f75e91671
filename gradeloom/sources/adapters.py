"""Raw source rows to canonical prompts: one projection per kind of source, as column expressions over parsed JSON."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gradeloom.functions.ids import family_of, json_digest

#: What is added to prompts.
CHOICE_END = "\nYou may reason. End with 'Final answer: X' where X is one option label."
SHORT_END = "\nEnd with 'Final answer: <short answer>'."
ANSWER_END = "\nEnd with 'Final answer: <answer>'."
PROGRAM_END = "\nReturn a complete Python program using stdin/stdout in one python code block."
FUNCTION_START = "Complete this Python function. Return the complete function (including its signature and any imports) in one python code block.\n\n"
PASSAGES_START = "Use only the supplied passages.\n\n"
#: The rubric of chat prompts.
CHAT_CRITERIA = "Fulfill the actual request accurately, coherently and completely; obey essential constraints. No redundant repeated list items. Do not reward verbosity."
#: Categories, capabilities and tasks that are left out, and those that are let in.
EXCLUDED_CATEGORY = "(?i)safety|identity|refus|abstain"
EXCLUDED_CAPABILITIES = ("safety", "tool_usage", "multilingual", "reasoning", "knowledge")
EXCLUDED_TASKS = ("revision_with_tools", "executable_actions", "alignment", "false_presupposition")
EXACT_PUZZLES = ("aiw", "leg_counting", "number_filtering", "string_splitting", "string_synthesis", "acre", "self_reference")
FORMATS = ("json", "yaml", "xml", "csv", "toml")
LISTS, PLANS = r"(?iU)\b(list|enumerate)\b", r"(?iU)\b(plan|itinerary|schedule)\b"
#: Texts that want the model to decline.
DECLINING = r"(?iU)\b(refuse to answer|refusal|abstain from answering|decline to (?:answer|comply)|should not answer|must not answer|cannot (?:answer|provide|assist)|unable to (?:answer|provide|assist)|insufficient information to answer)\b"
#: Tokens for an answer, by domain.
LONG_ANSWERS, LONG_CAP, CAP = ("math", "logic", "quality", "python"), 4096, 2048
#: Names of an id, in the order in which they count.
ID_NAMES = ("uuid", "id", "question_id", "key", "task_id")
SHORTEST, LONGEST = 8, 100_000


@dataclass(frozen=True)
class Spec:
    """Where rows come from."""

    task: str
    repo: str
    config: str | None
    split: str
    kind: str
    domain: str


MESSAGES = "array<struct<role:string,content:string>>"
TURNS = "array<struct<message:string,ids:array<string>,kwargs:array<string>>>"


def text_at(path: str, v: str = "_v") -> Column:
    """The value at a path of the raw row as text; null where there is none."""
    return F.try_variant_get(F.col(v), path, "string")


def list_at(path: str, of: str = "string", v: str = "_v") -> Column:
    return F.try_variant_get(F.col(v), path, f"array<{of}>")


def part_at(path: str, v: str = "_v") -> Column:
    return F.try_variant_get(F.col(v), path, "variant")


def _kind_of(c: Column) -> Column:
    return F.schema_of_variant(c)


def json_at(path: str) -> Column:
    """The JSON text at a path."""
    return F.to_json(part_at(path))


def user_turn(text: Column) -> Column:
    """A conversation of one user turn."""
    return F.array(F.struct(F.lit("user").alias("role"), text.alias("content")))


def answer_after_marks(c: Column) -> Column:
    """Text after the last #### of a worked solution."""
    return F.trim(F.element_at(F.split(c, "####"), -1))


def render_options(labels: Column, texts: Column) -> Column:
    """'\\nA. text' for each option, by position, as far as both go."""
    n = F.least(F.size(labels), F.size(texts))
    return F.array_join(F.transform(F.slice(F.arrays_zip(labels.alias("l"), texts.alias("t")), F.lit(1), n), lambda o: F.concat(F.lit("\n"), o["l"], F.lit(". "), o["t"])), "")


def render_passages(titles: Column, sentences: Column) -> Column:
    """Title and joined sentences of each passage, blank lines between."""
    return F.array_join(F.zip_with(titles, sentences, lambda t, s: F.concat(t, F.lit("\n"), F.array_join(s, " "))), "\n\n")


def render_conversation(messages: Column) -> Column:
    """role: content lines."""
    return F.array_join(F.transform(messages, lambda m: F.concat(m.role, F.lit(": "), F.coalesce(m.content, F.lit("")))), "\n")


def contents(messages: Column) -> Column:
    return F.array_join(F.transform(messages, lambda m: F.coalesce(m.content, F.lit(""))), "\n")


def first_present(*cols: Column) -> Column:
    """Row id: the first of the candidates that is present."""
    return F.coalesce(*[c.cast("string") for c in cols])


def rule_stratum(ids: Column) -> Column:
    """Family of the first instruction id, before the colon."""
    return F.substring_index(F.get(ids, F.lit(0)), ":", 1)


def route(text: Column) -> Column:
    """lists before plans before chat."""
    return F.when(text.rlike(LISTS), "lists").when(text.rlike(PLANS), "plans").otherwise("chat")


def decode_kwargs(c: Column) -> Column:
    """A JSON list whose items may be JSON texts themselves, as an array of JSON objects."""
    items = F.from_json(c, "array<string>")
    return F.transform(items, lambda x: F.when(x.startswith('"'), F.from_json(F.concat(F.lit("["), x, F.lit("]")), "array<string>")[0]).otherwise(x))


def chat_messages() -> tuple[Column, Column]:
    """(messages, reason): a prompt that is a text, or a list of turns whose contents are texts or lists of text parts."""
    src = F.coalesce(part_at("$.responses_create_params.input"), part_at("$.prompt"))
    turns = F.try_variant_get(src, "$", "array<variant>")
    parts = lambda m: F.try_variant_get(m, "$.content", "array<struct<type:string,text:string>>")
    one = lambda m: F.struct(
        F.coalesce(F.try_variant_get(m, "$.role", "string"), F.lit("user")).alias("role"),
        F.coalesce(F.when(parts(m).isNotNull(), F.array_join(F.transform(parts(m), lambda p: F.coalesce(p["text"], F.lit(""))), "\n")), F.try_variant_get(m, "$.content", "string"), F.lit("")).alias("content"),
    )
    odd = F.exists(turns, lambda m: F.coalesce(F.exists(parts(m), lambda p: ~F.coalesce(p["type"].isin("text", "input_text"), F.lit(False))), F.lit(False)))
    plain = _kind_of(src) == "STRING"
    got = F.when(plain, user_turn(F.try_variant_get(src, "$", "string"))).otherwise(F.transform(turns, one))
    return got, F.when(~plain & turns.isNull() & src.isNotNull(), "unsupported_prompt").when(odd, "nontext")


def _case(*rules: tuple[Column, str]) -> Column:
    out = F.lit(None).cast("string")
    for cond, name in reversed(rules):
        out = F.when(F.coalesce(cond, F.lit(False)), F.lit(name)).otherwise(out)
    return out


def _last(messages: Column) -> Column:
    return F.try_element_at(messages, F.lit(-1))["content"]


def _question() -> Column:
    return F.coalesce(text_at("$.question"), text_at("$.problem"), text_at("$.input"), F.lit(""))


#: A kind gives: messages, verifier, verification (JSON text), and where they differ from the default: prompt (of the
#: family), stratum, binary, turns, reason.
Parts = dict[str, Column]


def _struct(optional: tuple[str, ...] = (), **fields: Column) -> Column:
    """JSON of the fields; null if one that isn't optional is null: then the raw row lacks what its kind needs."""
    whole = reduce(lambda a, b: a & b, [c.isNotNull() for n, c in fields.items() if n not in optional], F.lit(True))
    return F.when(whole, F.to_json(F.struct(*[c.alias(n) for n, c in fields.items()])))


def _gsm() -> Parts:
    return {"verifier": F.lit("math"), "verification": _struct(answer=answer_after_marks(text_at("$.answer")))}


def _math() -> Parts:
    level = F.concat(F.coalesce(text_at("$.subject"), F.lit("math")), F.lit("/"), F.coalesce(text_at("$.level"), F.lit("")))
    return {"verifier": F.lit("math"), "verification": _struct(answer=text_at("$.answer")), "stratum": level}


def _with_gold(kind: str) -> Callable[[], Parts]:
    def build() -> Parts:
        msgs, odd = chat_messages()
        gold = text_at("$.expected_answer")
        options = F.coalesce(list_at("$.options", "map<string,string>"), F.array().cast("array<map<string,string>>"))
        labels = F.flatten(F.transform(options, lambda o: F.map_keys(F.map_filter(o, lambda _, x: x.isNotNull()))))
        rules = [(odd.isNotNull(), "nontext"), (F.coalesce(text_at("$._hf_question_placeholder"), F.lit("false")).isin("true", "1") | (F.coalesce(gold, F.lit("")) == ""), "placeholder_or_missing_gold")]
        if kind == "mcqa":
            rules += [(F.size(labels) == 0, "missing_option_labels"), (~F.array_contains(labels, gold) | (F.size(F.array_distinct(labels)) < F.size(labels)) | (F.size(labels) < 2), "invalid_gold_or_duplicate_option_labels")]
        judged = F.lit("equivalence") if kind == "openqa" else F.when(F.coalesce(text_at("$.verifier_type"), F.lit("")).contains("judge"), "equivalence").otherwise("math")
        fields = {"answer": gold, "output_regex": text_at("$.template_metadata.output_regex")} | ({"labels": labels} if kind == "mcqa" else {})
        asked = F.coalesce(F.nullif(text_at("$.question"), F.lit("")), F.nullif(text_at("$.problem"), F.lit("")), _last(msgs))
        return {"messages": msgs, "prompt": asked, "verifier": F.lit("choice") if kind == "mcqa" else judged, "verification": F.coalesce(_struct(("output_regex",), **fields), F.lit("{}")), "stratum": F.coalesce(text_at("$.metadata.topic"), F.lit("default")), "reason": _case(*rules)}

    return build


def _choices(labels: Column, options: Column, gold: Column, stratum: Column | None = None) -> Parts:
    q = F.concat(_question(), render_options(labels, options), F.lit(CHOICE_END))
    return {"messages": user_turn(q), "verifier": F.lit("choice"), "verification": _struct(answer=gold, labels=labels)} | ({"stratum": stratum} if stratum is not None else {})


def _arc() -> Parts:
    return _choices(list_at("$.choices.label"), list_at("$.choices.text"), text_at("$.answerKey"))


def _mmlu() -> Parts:
    options = list_at("$.options")
    return _choices(F.slice(F.split(F.lit("A,B,C,D,E,F,G,H,I,J"), ","), F.lit(1), F.size(options)), options, text_at("$.answer"), text_at("$.category"))


def _trivia() -> Parts:
    return {"messages": user_turn(F.concat(_question(), F.lit(SHORT_END))), "verifier": F.lit("alias"), "verification": _struct(aliases=list_at("$.answer.aliases"))}


def _hotpot() -> Parts:
    passages = render_passages(list_at("$.context.title"), list_at("$.context.sentences", "array<string>"))
    q = F.concat(F.lit(PASSAGES_START), passages, F.lit("\n\nQuestion: "), _question(), F.lit(SHORT_END))
    return {"messages": user_turn(q), "verifier": F.lit("grounded"), "verification": _struct(aliases=F.when(text_at("$.answer").isNotNull(), F.array(text_at("$.answer")))), "stratum": F.coalesce(text_at("$.type"), F.lit("default"))}


def _chat(kind: str) -> Callable[[], Parts]:
    def build() -> Parts:
        msgs, odd = chat_messages()
        rules = [(odd.isNotNull(), "nontext"), (F.coalesce(text_at("$.category"), F.lit("")).rlike(EXCLUDED_CATEGORY), "excluded_category"), (route(_last(msgs)) != kind, "other_quality_route")]
        return {"messages": msgs, "prompt": contents(msgs), "verifier": F.lit("quality"), "binary": F.lit(False), "verification": _struct(rubric=F.struct(F.lit(CHAT_CRITERIA).alias("criteria"))), "reason": _case(*rules)}

    return build


def _biggen() -> Parts:
    said = F.array(F.struct(F.lit("system").alias("role"), text_at("$.system_prompt").alias("content")), F.struct(F.lit("user").alias("role"), text_at("$.input").alias("content")))
    rules = [(text_at("$.capability").isin(*EXCLUDED_CAPABILITIES), "other_capability"), (text_at("$.task").isin(*EXCLUDED_TASKS), "excluded_tool_or_abstention_task")]
    gold = F.concat(F.lit('{"reference":'), json_at("$.reference_answer"), F.lit(',"rubric":'), json_at("$.score_rubric"), F.lit("}"))
    return {"messages": said, "verifier": F.lit("quality"), "binary": F.lit(False), "verification": gold, "stratum": F.concat(text_at("$.capability"), F.lit("/"), text_at("$.task")), "reason": _case(*rules)}


def _asked_by_user(msgs: Column) -> Column:
    return contents(F.filter(msgs, lambda m: m.role == "user"))


def _nchallenge() -> Parts:
    msgs, odd = chat_messages()
    return {"messages": msgs, "prompt": _asked_by_user(msgs), "verifier": F.lit("rubric"), "verification": F.concat(F.lit('{"checks":'), json_at("$.llm_judge"), F.lit("}")), "reason": odd}


def _challenge() -> Parts:
    msgs = F.transform(F.arrays_zip(list_at("$.conversation.role").alias("role"), list_at("$.conversation.content").alias("content")), lambda m: F.struct(m["role"].alias("role"), m["content"].alias("content")))
    check = F.struct(text_at("$.target_question").alias("content"), text_at("$.pass_criteria").alias("pass_criteria"))
    return {"messages": msgs, "prompt": _asked_by_user(msgs), "verifier": F.lit("rubric"), "verification": _struct(checks=F.when(text_at("$.target_question").isNotNull() & text_at("$.pass_criteria").isNotNull(), F.array(check))), "stratum": text_at("$.axis")}


def _instruction() -> Parts:
    msgs, odd = chat_messages()
    rules = F.concat(F.lit('{"ids":'), json_at("$.instruction_id_list"), F.lit(',"kwargs":'), json_at("$.kwargs"), F.lit("}"))
    return {"messages": msgs, "prompt": contents(msgs), "verifier": F.lit("instruction"), "verification": rules, "stratum": rule_stratum(list_at("$.instruction_id_list")), "reason": odd}


def _multiif() -> Parts:
    """Three turns, each a JSON text for its message, its rule ids and its arguments."""
    turn = lambda i: F.struct(
        F.get_json_object(text_at(f"$.turn_{i}_prompt"), "$.content").alias("message"), F.from_json(text_at(f"$.turn_{i}_instruction_id_list"), "array<string>").alias("ids"), decode_kwargs(text_at(f"$.turn_{i}_kwargs")).alias("kwargs"))
    first = turn(1)
    rules = F.concat(F.lit('{"ids":'), F.to_json(first["ids"]), F.lit(',"kwargs":['), F.array_join(first["kwargs"], ","), F.lit("]}"))
    return {"messages": user_turn(first["message"]), "prompt": first["message"], "verifier": F.lit("instruction"), "verification": rules, "turns": F.array(turn(1), turn(2), turn(3)), "reason": _case((F.coalesce(text_at("$.language"), F.lit("")) != "English", "non_english"))}


def _nstruct() -> Parts:
    msgs, odd = chat_messages()
    kind = F.lower(text_at("$.schema_type"))
    rules = [(odd.isNotNull(), "nontext"), (F.try_parse_json(text_at("$.schema_str")).isNull(), "schema_str"), (kind == "xml", "xml_schema_adapter_pending"), (~kind.isin(*FORMATS), "unsupported_format")]
    gold = F.concat(F.lit('{"schema":'), F.to_json(F.try_parse_json(text_at("$.schema_str"))), F.lit(',"format":"'), kind, F.lit('"}'))
    return {"messages": msgs, "prompt": contents(msgs), "verifier": F.lit("structure"), "verification": gold, "stratum": kind, "reason": _case(*rules)}


def _struct_eval() -> Parts:
    kind = F.lower(text_at("$.output_type"))
    rules = [(F.coalesce(text_at("$.rendering"), F.lit("false")).isin("true", "1"), "rendered_format"), (~kind.isin(*FORMATS), "unsupported_format")]
    gold = F.concat(F.lit('{"format":"'), kind, F.lit('","requirements":'), F.coalesce(json_at("$.raw_output_metric"), F.lit("[]")), F.lit("}"))
    return {"messages": user_turn(text_at("$.query")), "prompt": text_at("$.query"), "verifier": F.lit("structure"), "verification": gold, "stratum": kind, "reason": _case(*rules)}


def _bbh() -> Parts:
    return {"messages": user_turn(F.concat(text_at("$.input"), F.lit(ANSWER_END))), "prompt": text_at("$.input"), "verifier": F.lit("exact"), "verification": _struct(answer=text_at("$.target"))}


def _reasoning() -> Parts:
    msgs, odd = chat_messages()
    puzzle = text_at("$.metadata.source_dataset")
    rules = [(~F.coalesce(puzzle.isin(*EXACT_PUZZLES), F.lit(False)), "reasoning_task_not_allowlisted"), (odd.isNotNull(), "nontext")]
    gold = F.concat(F.lit('{"answer":'), json_at("$.answer"), F.lit(',"native_metadata":'), json_at("$.metadata"), F.lit("}"))
    return {"messages": msgs, "verifier": F.lit("exact"), "verification": gold, "stratum": puzzle, "reason": _case(*rules)}


def _calendar() -> Parts:
    msgs, odd = chat_messages()
    state = json_at("$.exp_cal_state")
    rules = [(odd.isNotNull(), "nontext"), (F.coalesce(state, F.lit("{}")).isin("{}", "null"), "empty_calendar")]
    return {"messages": msgs, "prompt": contents(msgs), "verifier": F.lit("calendar"), "verification": F.concat(F.lit('{"calendar":'), state, F.lit("}")), "reason": _case(*rules)}


def _apps() -> Parts:
    tests = F.try_parse_json(text_at("$.input_output"))
    size = F.size(F.coalesce(F.try_variant_get(tests, "$.inputs", "array<variant>"), F.array().cast("array<variant>")))
    rules = [((size == 0) | (F.coalesce(F.try_variant_get(tests, "$.fn_name", "string"), F.lit("")) != "") | (text_at("$.difficulty") == "competition"), "code_scope_or_tests")]
    gold = F.concat(F.lit('{"tests":'), F.to_json(tests), F.lit(',"reference_solutions":'), F.to_json(F.try_parse_json(text_at("$.solutions"))), F.lit("}"))
    return {"messages": user_turn(F.concat(text_at("$.question"), F.lit(PROGRAM_END))), "verifier": F.lit("apps"), "verification": gold, "stratum": text_at("$.difficulty"), "reason": _case(*rules)}


def _humanevalplus() -> Parts:
    return {"messages": user_turn(F.concat(F.lit(FUNCTION_START), text_at("$.prompt"))), "prompt": text_at("$.prompt"), "verifier": F.lit("humanevalplus"), "verification": F.col("raw")}


KINDS: dict[str, Callable[[], Parts]] = {
    "gsm": _gsm, "math": _math, "nmath": _with_gold("nmath"), "openqa": _with_gold("openqa"), "mcqa": _with_gold("mcqa"), "arc": _arc, "mmlu": _mmlu, "trivia": _trivia, "hotpot": _hotpot,
    "chat": _chat("chat"), "lists": _chat("lists"), "plans": _chat("plans"), "biggen": _biggen, "nchallenge": _nchallenge, "challenge": _challenge, "instruction": _instruction, "multiif": _multiif,
    "nstruct": _nstruct, "struct": _struct_eval, "bbh": _bbh, "reasoning": _reasoning, "calendar": _calendar, "apps": _apps, "humanevalplus": _humanevalplus,
}


def adapt(df: DataFrame, spec: Spec, revision: str, raw: str = "raw", ordinal: str = "ordinal") -> DataFrame:
    """Canonical rows of a source of one kind, with `reason` (null for rows that are admitted; rows with one are kept, so that
    they can be counted). df: `raw`, a JSON object per row as text, and `ordinal`, its place in the source, which stands in
    where a row names no id. A text that is no object, or lacks what its kind needs, is 'malformed'. Nothing is shuffled
    and, but for families of texts outside of ASCII, nothing leaves the JVM."""
    if spec.kind not in KINDS:
        raise ValueError(f"kind {spec.kind}")
    d = df.select(F.col(raw).alias("raw"), F.col(ordinal).cast("string").alias("_ordinal")).withColumn("_v", F.try_parse_json("raw"))
    parts = {"messages": user_turn(_question()), "prompt": _question(), "stratum": F.lit("default"), "binary": F.lit(True), "turns": F.lit(None).cast(TURNS), "reason": F.lit(None).cast("string")} | KINDS[spec.kind]()
    d = d.select("_v", "_ordinal", *[c.alias(f"_{n}") for n, c in parts.items()])
    content = contents(F.col("_messages"))
    tools = part_at("$.responses_create_params.tools")
    late = _case(
        (F.col("_v").isNull() | F.col("_verification").isNull() | F.col("_messages").isNull(), "malformed"), (F.to_json(tools).isNotNull() & ~F.to_json(tools).isin("[]", "null", "{}", '""', "false"), "tool_dependent"),
        ((F.size("_messages") < 1) | (F.try_element_at("_messages", F.lit(-1))["role"] != "user") | F.exists("_messages", lambda m: F.coalesce(m.content, F.lit("")) == ""), "invalid_conversation"),
        (F.concat(content, F.col("_verification")).rlike(DECLINING), "refusal_target_candidate"), (~F.length(content).between(SHORTEST, LONGEST), "length_or_empty"),
    )
    rid = first_present(*[text_at(f"$.{n}") for n in ID_NAMES], F.col("_ordinal"))
    of = lambda *cs: F.array(*[F.lit(c).cast("string") if not isinstance(c, Column) else c for c in cs])
    return d.withColumn("_rid", rid).select(
        json_digest(F.to_json(of(spec.task, spec.repo, revision, spec.config, spec.split, F.col("_rid")))).alias("id"), family_of(F.col("_prompt")).alias("family_id"), F.col("_prompt").alias("family_text"),
        F.lit(spec.task).alias("task"), F.lit(spec.domain).alias("domain"), F.col("_stratum").alias("stratum"), F.col("_messages").alias("messages"), F.col("_verifier").alias("verifier"), F.col("_verification").alias("verification"),
        F.col("_binary").alias("binary"), F.lit(LONG_CAP if spec.domain in LONG_ANSWERS else CAP).alias("max_new_tokens"), F.col("_turns").alias("turns"),
        F.to_json(F.struct(F.lit(spec.repo).alias("repo"), F.lit(revision).alias("revision"), F.lit(spec.config).cast("string").alias("config"), F.lit(spec.split).alias("split"), F.col("_rid").alias("row_id"))).alias("source"),
        F.coalesce("_reason", late).alias("reason"),
    )


def rejections(adapted: DataFrame) -> DataFrame:
    """Rows per reason; the admitted ones have none."""
    return adapted.groupBy("reason").agg(F.count("*").alias("n"))
