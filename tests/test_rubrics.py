import pytest

from gradeloom.functions import schema as S
from gradeloom.operators import rubrics as R


def test_verdicts_and_score():
    assert R.verdicts('{"verdicts": [true, "false"]}', 2) == [True, False]
    for bad, n, finish in (('{"verdicts": [true]}', 2, "stop"), ('{"verdicts": [1]}', 1, "stop"), ('{"verdicts": [true]}', 1, "length")):
        with pytest.raises(ValueError):
            R.verdicts(bad, n, finish)
    checks = [{"pass_criteria": "YES"}, {"pass_criteria": "NO", "source": "user", "is_misalignment_check": True}]
    assert R.rubric_score(checks, [True, True]) == (1.0, 1.0) and R.rubric_score(checks, [True, False]) == (0.0, 0.5)


def test_schema_contradiction():
    assert S.contradiction({"type": "object", "required": ["a"], "properties": {"b": {}}, "additionalProperties": False})
    assert S.contradiction({"type": "string", "const": 1}) and S.contradiction({"type": "integer", "enum": ["a", True]})
    assert S.contradiction({"required": ["a"], "properties": {"a": {"$ref": "#/defs/x"}}}) and S.contradiction({"properties": {"a": {"anyOf": [{"$ref": "#/no"}]}}})
    assert S.contradiction({"type": "array", "minItems": 1, "items": {"const": 1, "type": "string"}}) and S.contradiction({"type": "object", "required": ["a"], "allOf": [{"properties": {"a": {"type": "null", "const": 0}}}]})
    assert S.contradiction({"type": "object", "required": ["ab"], "patternProperties": {"^a": {}}, "additionalProperties": False}) is None
    cyc = {"required": ["a"], "properties": {"a": {"$ref": "#"}}}
    assert S.contradiction(cyc) is None and S.contradiction({"properties": {"a": {"type": "string", "const": 1}}}) is None and S.contradiction(True) is None


def test_quota_prefix_admission():
    assert R.spread_quota(7, ["a", "b", "c"]) == {"a": 3, "b": 2, "c": 2} and R.spread_quota(3, []) == {}
    assert R.largest_prefix(list("abcdef"), lambda x: len(x) <= 4) == 4 and R.largest_prefix([], lambda x: True) == 0
    assert R.admission_order([5, 8, 3, 2], [2, 2, 2, 2], 10) == [0, 2, 3, 1] or R.admission_order([5, 8, 3, 2], [2, 2, 2, 2], 10)[0] == 0
    assert sorted(R.admission_order([5, 9, *[1] * 20], [3] * 22, 10, bypass=2)) == list(range(22))
    with pytest.raises(ValueError):
        R.admission_order([11], [1], 10)


def test_schema_validation():
    s = {"type": "object", "required": ["n"], "properties": {"n": {"type": "integer", "minimum": 2}, "tags": {"type": "array", "items": {"enum": ["a", "b"]}, "uniqueItems": True}, "o": {"oneOf": [{"type": "string"}, {"type": "null"}]}, "again": {"$ref": "#"}}, "additionalProperties": False}
    ok = [{"n": 2}, {"n": 3.0, "tags": ["a", "b"], "o": None, "again": {"n": 9}}]
    bad = [{}, {"n": 1}, {"n": True}, {"n": 2, "tags": ["a", "a"]}, {"n": 2, "tags": ["c"]}, {"n": 2, "o": 1}, {"n": 2, "x": 1}, {"n": 2, "again": {"n": 0}}, []]
    assert not any(S.invalid(v, s) for v in ok) and all(S.invalid(v, s) for v in bad)
    assert S.malformed(s) is None and S.malformed({"type": "text"}) and S.malformed({"properties": {"a": 1}}) and S.malformed({"required": "a"})
    assert S.unsatisfiable("csv", {"type": "array", "items": {"type": "object", "properties": {"a": {"type": "object", "properties": {}}}}}) and S.unsatisfiable("toml", {"type": "array"}) and S.unsatisfiable("json", s) is None
    assert S.typed_rows([{"n": "4", "b": "TRUE", "z": ""}], {"type": "object", "properties": {"n": {"type": ["null", "integer"]}, "b": {"type": "boolean"}, "z": {"type": "null"}}}) == {"n": 4, "b": True, "z": None}


def test_rubric_stage(spark):
    assert R.rubric_question("Conversation ... Does the model's final response satisfy this criterion? Is it short? Expected answer: YES") == "Does the model's final response satisfy this criterion? Is it short?" and R.rubric_question("Is it?") == "Is it?"
    one = '{"checks": [{"content": "a?", "pass_criteria": "YES"}, {"content": "b?", "pass_criteria": "NO"}]}'
    many = '{"checks": [{"content": "a?"}, {"content": "b?"}, {"content": "c?", "pass_criteria": "NO"}]}'
    df = spark.createDataFrame([(1, [("user", "q")], "t", one), (2, [("user", "q")], "t", many), (3, [("user", "q")], "bad", one)], "k int, messages array<struct<role:string,content:string>>, text string, verification string")

    def ask(batch):
        out = []
        for said in batch:
            case = said[1]["content"]
            if '"bad"' in case:
                out.append({"text": "?"})
            elif "criteria" in case:
                out.append({"text": '```json\n{"verdicts": [true, true, false], "reason": "r"}\n```'})
            else:
                out.append({"text": '{"verdict": %s, "reason": "r"}' % ("true" if "a?" in case else "false")})
        return out

    got = {r.k: (r.status, r.score, r.passed) for r in R.grade_rubrics(df, ["k"], ask).collect()}
    assert got == {1: ("valid", 1.0, True), 2: ("valid", 1.0, True), 3: ("error", None, None)}
