"""Queries of the source adapters: raw rows are built from the tables, one query per kind, with the SQL of what comes out."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gradeloom.plans.registry import query
from gradeloom.sources import adapters, long_context

REVISION = "r1"
_POOL, _SPLITS = "heldout_pool", "splits"


def _adapted(t, name: str, raw: str, kind: str, domain: str, gold: str) -> DataFrame:
    """id, stratum, verifier, content of all turns, a part of the verification, and the reason, of raw rows given as SQL."""
    src = t(_POOL).select(F.expr(raw).alias("raw"), F.col("item_id").alias("ordinal"))
    rows = adapters.adapt(src, adapters.Spec(name, "lab/" + name, None, "train", kind, domain), REVISION)
    return rows.select("id", "stratum", "verifier", adapters.contents(F.col("messages")).alias("content"), F.get_json_object("verification", gold).alias("gold"), "reason")


def _register(kind: str, domain: str, raw: str, gold: str, content: str, gold_sql: str, stratum: str = "'default'", verifier: str = "", reason: str = "NULL", rid: str = "item_id") -> None:
    """raw: SQL expression of the JSON of a raw row, the same for both engines. The rest is DuckDB's view of the result."""
    name = f"raw_{kind}"
    late = f"""CASE WHEN content = '' THEN 'invalid_conversation' WHEN regexp_matches(content, {_DECLINING}, 'i') THEN 'refusal_target_candidate' WHEN length(content) < 8 OR length(content) > 100000 THEN 'length_or_empty' END"""
    sql = f"""WITH x AS (SELECT *, {content} AS content FROM heldout_pool)
SELECT sha256('["{name}","lab/{name}","{REVISION}",null,"train","' || {rid} || '"]') AS id, {stratum} AS stratum, {verifier} AS verifier, content, {gold_sql} AS gold, coalesce({reason}, {late}) AS reason FROM x"""

    def run(t) -> DataFrame:
        return _adapted(t, name, raw, kind, domain, gold)

    run.__name__ = f"q_adapt_{kind}"
    query(sql)(run)


_DECLINING = "'" + adapters.DECLINING.replace("(?iU)", "") + "'"
_Q = "question"
_CHAT = "to_json(named_struct('prompt', question, 'category', task, 'id', concat('c', item_id)))"
_IN = "to_json(named_struct('responses_create_params', named_struct('input', array(named_struct('role', 'system', 'content', 'Be exact.'), named_struct('role', 'user', 'content', question)))"
_END = lambda s: "|| " + " || ".join(f"chr(10) || '{p}'" for p in s.replace("'", "''").split("\n")[1:])
_ROUTE = r"CASE WHEN regexp_matches(content, '\b(list|enumerate)\b', 'i') THEN 'lists' WHEN regexp_matches(content, '\b(plan|itinerary|schedule)\b', 'i') THEN 'plans' ELSE 'chat' END"

_register("gsm", "math", "to_json(named_struct('question', question, 'answer', concat('steps #### ', answer)))", "$.answer", _Q, "trim(answer)", verifier="'math'")
_register("math", "math", "to_json(named_struct('problem', question, 'answer', answer, 'subject', task, 'level', item_id % 5))", "$.answer", _Q, "answer", "task || '/' || (item_id % 5)", "'math'")
_register("nmath", "math", f"{_IN}, 'expected_answer', if(item_id % 7 = 0, '', answer), 'verifier_type', if(item_id % 2 = 0, 'judge-v1', 'rule')))", "$.answer", "'Be exact.' || chr(10) || question", "CASE WHEN item_id % 7 = 0 THEN '' ELSE answer END",
          verifier="CASE WHEN item_id % 2 = 0 THEN 'equivalence' ELSE 'math' END", reason="CASE WHEN item_id % 7 = 0 THEN 'placeholder_or_missing_gold' END")
_register("openqa", "knowledge", "to_json(named_struct('prompt', question, 'expected_answer', answer, 'metadata', named_struct('topic', domain)))", "$.answer", _Q, "answer", "domain", "'equivalence'")
_register("mcqa", "knowledge", "to_json(named_struct('prompt', question, 'expected_answer', if(item_id % 3 = 0, 'D', 'B'), 'options', array(map('A', 'x'), map('B', 'y'), if(item_id % 5 = 0, map('B', 'z'), map('C', 'z'))), 'uuid', concat('u', item_id)))", "$.labels", _Q,
          """CASE WHEN item_id % 5 = 0 THEN '["A","B","B"]' ELSE '["A","B","C"]' END""", verifier="'choice'", reason="CASE WHEN item_id % 3 = 0 OR item_id % 5 = 0 THEN 'invalid_gold_or_duplicate_option_labels' END", rid="'u' || item_id")  # fmt: skip
_register("arc", "knowledge", "to_json(named_struct('question', question, 'choices', named_struct('label', array('A', 'B'), 'text', array(answer, domain)), 'answerKey', 'A', 'id', concat('a', item_id)))", "$.answer",
          f"question || chr(10) || 'A. ' || answer || chr(10) || 'B. ' || domain {_END(adapters.CHOICE_END)}", "'A'", verifier="'choice'", rid="'a' || item_id")
_register("mmlu", "knowledge", "to_json(named_struct('question', question, 'options', array(answer, domain, task), 'answer', 'C', 'category', lang, 'question_id', item_id))", "$.labels",
          f"question || chr(10) || 'A. ' || answer || chr(10) || 'B. ' || domain || chr(10) || 'C. ' || task {_END(adapters.CHOICE_END)}", """'["A","B","C"]'""", "lang", "'choice'")
_register("trivia", "knowledge", "to_json(named_struct('question', question, 'answer', named_struct('aliases', array(answer, upper(answer)))))", "$.aliases[0]", f"question {_END(adapters.SHORT_END)}", "answer", verifier="'alias'")
_register("hotpot", "grounding", "to_json(named_struct('question', 'Who?', 'answer', answer, 'type', lang, 'context', named_struct('title', array(task, domain), 'sentences', array(array(question, 'End.'), array('More.')))))", "$.aliases[0]",
          f"'Use only the supplied passages.' || chr(10) || chr(10) || task || chr(10) || question || ' End.' || chr(10) || chr(10) || domain || chr(10) || 'More.' || chr(10) || chr(10) || 'Question: Who?' {_END(adapters.SHORT_END)}", "answer", "lang", "'grounded'")
for _k in ("chat", "lists", "plans"):
    _register(_k, "quality", _CHAT.replace("task", "if(item_id % 11 = 0, 'Safety first', task)"), "$.rubric.criteria", _Q, f"'{adapters.CHAT_CRITERIA}'", verifier="'quality'", reason=f"CASE WHEN item_id % 11 = 0 THEN 'excluded_category' WHEN {_ROUTE} <> '{_k}' THEN 'other_quality_route' END", rid="'c' || item_id")
_register("biggen", "quality", "to_json(named_struct('system_prompt', 'Help.', 'input', question, 'reference_answer', answer, 'score_rubric', named_struct('a', 1), 'capability', if(item_id % 4 = 0, 'safety', 'planning'), 'task', if(item_id % 6 = 1, 'alignment', 'travel')))", "$.reference",
          "'Help.' || chr(10) || question", "answer", "CASE WHEN item_id % 4 = 0 THEN 'safety' ELSE 'planning' END || '/' || CASE WHEN item_id % 6 = 1 THEN 'alignment' ELSE 'travel' END", "'quality'",
          "CASE WHEN item_id % 4 = 0 THEN 'other_capability' WHEN item_id % 6 = 1 THEN 'excluded_tool_or_abstention_task' END")
_register("nchallenge", "multiturn", f"{_IN}, 'llm_judge', array(named_struct('content', answer, 'pass_criteria', 'YES'))))", "$.checks[0].content", "'Be exact.' || chr(10) || question", "answer", verifier="'rubric'")
_register("challenge", "multiturn", "to_json(named_struct('conversation', named_struct('role', array('user', 'assistant', 'user'), 'content', array('Hello there', 'Yes?', question)), 'target_question', answer, 'pass_criteria', 'NO', 'axis', domain))", "$.checks[0].pass_criteria",
          "'Hello there' || chr(10) || 'Yes?' || chr(10) || question", "'NO'", "domain", "'rubric'")
_register("instruction", "instruction", "to_json(named_struct('prompt', question, 'instruction_id_list', array('length:words', 'keywords:include'), 'kwargs', array(map('n', 3), map('n', 4)), 'key', item_id))", "$.ids[1]", _Q, "'keywords:include'", "'length'", "'instruction'")
_TURN = lambda i: f"'turn_{i}_prompt', to_json(named_struct('role', 'user', 'content', concat(question, ' {i}'))), 'turn_{i}_instruction_id_list', '[\"a:{i}\"]', 'turn_{i}_kwargs', '[{{\"n\": {i}}}]'"
_register("multiif", "multiturn", f"to_json(named_struct('language', if(lang = 'en', 'English', 'Other'), {_TURN(1)}, {_TURN(2)}, {_TURN(3)}))", "$.ids[0]", "question || ' 1'", "'a:1'", verifier="'instruction'", reason="CASE WHEN lang <> 'en' THEN 'non_english' END")
_register("nstruct", "structure", "to_json(named_struct('prompt', question, 'schema_type', if(item_id % 4 = 0, 'XML', if(item_id % 4 = 1, 'html', 'JSON')), 'schema_str', '{\"type\":\"object\"}'))", "$.schema.type", _Q, "'object'", "CASE item_id % 4 WHEN 0 THEN 'xml' WHEN 1 THEN 'html' ELSE 'json' END", "'structure'",
          "CASE item_id % 4 WHEN 0 THEN 'xml_schema_adapter_pending' WHEN 1 THEN 'unsupported_format' END")
_register("struct", "structure", "to_json(named_struct('query', question, 'rendering', item_id % 5 = 0, 'output_type', if(item_id % 3 = 0, 'SVG', 'YAML'), 'raw_output_metric', array(answer)))", "$.requirements[0]", _Q, "answer", "CASE WHEN item_id % 3 = 0 THEN 'svg' ELSE 'yaml' END", "'structure'",
          "CASE WHEN item_id % 5 = 0 THEN 'rendered_format' WHEN item_id % 3 = 0 THEN 'unsupported_format' END")
_register("bbh", "logic", "to_json(named_struct('input', question, 'target', answer))", "$.answer", f"question {_END(adapters.ANSWER_END)}", "answer", verifier="'exact'")
_register("reasoning", "logic", f"{_IN}, 'answer', answer, 'metadata', named_struct('source_dataset', if(item_id % 2 = 0, 'aiw', 'sudoku'))))", "$.native_metadata.source_dataset", "'Be exact.' || chr(10) || question", "CASE WHEN item_id % 2 = 0 THEN 'aiw' ELSE 'sudoku' END",
          "CASE WHEN item_id % 2 = 0 THEN 'aiw' ELSE 'sudoku' END", "'exact'", "CASE WHEN item_id % 2 = 1 THEN 'reasoning_task_not_allowlisted' END")
_register("calendar", "logic", f"{_IN}, 'exp_cal_state', if(item_id % 3 = 0, cast(map() as map<string,string>), map('1', 'x'))))", "$.calendar.1", "'Be exact.' || chr(10) || question", "CASE WHEN item_id % 3 <> 0 THEN 'x' END", verifier="'calendar'", reason="CASE WHEN item_id % 3 = 0 THEN 'empty_calendar' END")
_register("apps", "python", "to_json(named_struct('question', question, 'input_output', if(item_id % 3 = 0, '{\"inputs\":[\"1\"],\"outputs\":[\"2\"],\"fn_name\":\"f\"}', '{\"inputs\":[\"1\"],\"outputs\":[\"2\"]}'), 'solutions', '[\"print(2)\"]', 'difficulty', if(item_id % 5 = 0, 'competition', 'intro')))", "$.tests.outputs[0]",
          f"question {_END(adapters.PROGRAM_END)}", "'2'", "CASE WHEN item_id % 5 = 0 THEN 'competition' ELSE 'intro' END", "'apps'", "CASE WHEN item_id % 3 = 0 OR item_id % 5 = 0 THEN 'code_scope_or_tests' END")
_register("humanevalplus", "python", "to_json(named_struct('task_id', concat('F/', item_id), 'prompt', question, 'entry_point', 'solve'))", "$.entry_point", "'" + adapters.FUNCTION_START.strip().replace("'", "''") + "' || chr(10) || chr(10) || question", "'solve'", verifier="'humanevalplus'", rid="'F/' || item_id")


_RETRIEVAL_RAW = "item_id as ordinal, array('niah_single_1', 'niah_multivalue', 'vt', 'cwe', 'fwe', 'qa_1')[item_id % 6] as task, question as context, 'code' as type_needle_v, domain as query, 'Example.' as example, answer as question, item_id as index, array(answer) as answer, cast(null as array<string>) as outputs"


@query("""WITH x AS (SELECT item_id, item_id % 6 AS k, question AS c, domain AS q, answer AS a FROM heldout_pool)
SELECT item_id AS ordinal, CASE k WHEN 0 THEN 'Some special magic code are hidden within the following text. Make sure to memorize it.' || chr(10) || c || chr(10) || 'What is the special magic code for ' || q || ' mentioned in the provided text?'
 WHEN 1 THEN 'Some special magic code are hidden within the following text. Make sure to memorize it.' || chr(10) || c || chr(10) || 'What are all the special magic code for ' || q || ' mentioned in the provided text?'
 WHEN 2 THEN 'Example.' || chr(10) || 'Memorize and track the chains of variable assignment.' || chr(10) || c || chr(10) || 'Find all variables assigned the value ' || q || '.' WHEN 3 THEN 'Example.' || chr(10) || c || chr(10) || 'What are the 10 most common words in the above list?'
 WHEN 4 THEN c || chr(10) || 'Ignore the dots. What are the three most frequently appeared coded words? Give only the words.' ELSE 'Answer based only on the given documents. Give only the short answer.' || chr(10) || chr(10) || c || chr(10) || 'Question: ' || a END AS prompt,
 CASE k WHEN 5 THEN a ELSE 'RULER/' || ['niah_single_1', 'niah_multivalue', 'vt', 'cwe', 'fwe', 'qa_1'][k + 1] || '/' || item_id END AS family_text, k = 5 AS any_alias FROM x""")
def q_long_retrieval(t):
    rows = long_context.retrieval_rows(t(_POOL).selectExpr(*_split_top(_RETRIEVAL_RAW)))
    return rows.select("ordinal", "prompt", "family_text", F.get_json_object("verification", "$.any_alias").cast("boolean").alias("any_alias"))


def _split_top(text: str) -> list[str]:
    """Select items of a list, split at commas outside of brackets."""
    out, depth, last = [], 0, 0
    for i, ch in enumerate(text):
        depth += (ch in "([") - (ch in ")]")
        if ch == "," and not depth:
            out.append(text[last:i])
            last = i + 1
    return [*out, text[last:]]


@query("""WITH x AS (SELECT item_id, question, answer, len(string_split('Document (Title: ' || task || '): ' || question, ' ')) AS n1, len(string_split('Document (Title: ' || domain || '): ' || answer, ' ')) AS n2, len(string_split('Use the supplied documents to answer the question. Give only the short answer.' || chr(10) || chr(10) || chr(10) || 'Question: ' || answer, ' ')) AS f,
 'Document (Title: ' || task || '): ' || question AS p1, 'Document (Title: ' || domain || '): ' || answer AS p2 FROM heldout_pool), y AS (SELECT *, f + 320 + n1 <= 400 AS k1, f + 320 + n1 <= 400 AND f + 320 + n1 + n2 <= 400 AS k2 FROM x)
SELECT item_id, 'Use the supplied documents to answer the question. Give only the short answer.' || chr(10) || chr(10) || CASE WHEN k2 THEN p1 || chr(10) || chr(10) || p2 WHEN k1 THEN p1 ELSE '' END || chr(10) || 'Question: ' || answer AS prompt, CASE WHEN NOT k1 THEN 'unanswerable_selected_context' END AS reason FROM y""")
def q_long_rag(t):
    """Passages within a budget of 400 blank-separated words."""
    from pyspark.sql.functions import pandas_udf
    from pyspark.sql.types import ArrayType, IntegerType

    raw = t(_POOL).select("item_id", F.col("answer").alias("question"), F.array("answer").alias("answers"), F.array(F.struct(F.col("task").alias("title"), F.col("question").alias("text")), F.struct(F.col("domain").alias("title"), F.col("answer").alias("text"))).alias("ctxs"), F.array(F.struct(F.col("question").alias("text"))).alias("positive_ctxs"))
    count = pandas_udf(lambda s: s.map(lambda xs: [len(x.split(" ")) for x in xs]), ArrayType(IntegerType()))
    return long_context.rag_rows(raw, 400, count).select("item_id", "prompt", "reason")


@query()
def q_long_icl(t):
    """Demonstrations from ten invented classes, in 600 words."""
    demos = [(f"example {i} of class {i % 10}", i % 10) for i in range(60)]
    raw = t(_POOL).select("item_id", F.col("answer").alias("text"), (F.col("item_id") % 10).cast("int").alias("label"))
    return long_context.icl_rows(raw, demos, 600, lambda xs: [len(x.split()) for x in xs]).select("item_id", "prompt", "verification")


@query("SELECT * FROM (VALUES " + ", ".join(f"({n}, '{k}', {73 * (i < 4) + 72 * (i >= 4)})" for i, n in enumerate(long_context.LENGTHS) for k in ("total",)) + ") AS v(length_bucket, part, prompts)")
def q_long_quotas(t):
    q = long_context.quotas()
    rows = [(n, "total", sum(v for (m, _), v in q.items() if m == n)) for n in long_context.LENGTHS]
    return t(_POOL).sparkSession.createDataFrame(rows, "length_bucket int, part string, prompts int")
