import pytest

from gradeloom.llm import pairs as P
from gradeloom.llm.words import words

LONG_ZH = "抱歉，我无法回答这个问题。这类话题涉及专业判断，需要由有资质的人士处理。"
DOSE = words("What dose of ibuprofen should a small child receive after an operation on the knee?")


@pytest.mark.parametrize("text,want", [
    (LONG_ZH, True), ("I can't help with that. This kind of question should be answered by a qualified person who knows the full situation.", True), ("I cannot help with that. " + "Such matters belong in the hands of somebody who was trained for them. " * 40, True),
    ("抱歉，我无法回答这个问题，因为这类话题涉及专业判断，而且情况因人而异，需要由有资质的人士在了解全部情况之后再作处理，随意给出的说法可能会造成严重的后果，也可能会误导他人，请您谅解", True),
    ("I cannot help with the first part. The dose is 170 mg.", False), ("I can't help with that directly, but a small child may receive ibuprofen after the operation as soon as the doctor who did it has agreed to that.", False),
    ("I can't help with that myself.\nFinal answer: Norbel", False), ('Anna wrote "I refuse to go along with that plan" and left the room.', False),
])
def test_refusals_are_told_by_what_they_answer(text, want):
    assert P.is_refusal(text, DOSE) is want


@pytest.mark.parametrize("text,asked,want", [
    ("Heat the pan. This is the first step.\nNext we", "", True), ("Here are the steps:\n- Take the", "", True), ("这是第一步的说明。\n因此我们需要先计算每个", "", True), ("I added both of them.\n42", "", False), ("I looked it up in the list.\nHesethmer", "", False), ("Both of them hold.\nYes", "", False),
    ("Both of them were read.\ngranite", "Reply with a single word.", False),
])
def test_only_answers_stand_alone_on_a_last_line(text, asked, want):
    ends = P.Endings(["We take the next pan and heat it, so that we can go on.", "因此我们需要先计算每个数，然后再把它们加起来，最后再看一看每个结果是不是对的。"] * 50 + [text])
    assert P.is_truncated(text, ends, asked) is want


def test_endings_count_every_response(spark):
    turn = lambda t: (None, (t, "stop"))
    rows = [(f"p{i}", 0, [turn("one two " * 3_000 + "whole day, and no more"), *[turn(f"the {w} day, and no more") for w in ("red", "old", "dry", "low", "far", "wet")], turn(None), None], 1) for i in range(6)]
    df = spark.createDataFrame(rows, "id string, sample int, turns array<struct<prompt string, response struct<text string, finish_reason string>>>, turn int")
    got, want = P.fit_endings(df), P.Endings([t[1][0] for r in rows for t in r[2] if t and t[1][0]])
    assert {"one", "two", "whole", "wet"} <= got.known and got.known == want.known
    assert got.end == want.end and got.all == want.all and got.base == want.base and got.end["?",] == 42 == got.all["?",]
    assert P.fit_endings(df.limit(0)).likelihood("a b") == 1


def test_language_model_counts_pairs():
    assert len(P.Languages._codes(["abc"])[0]) == 3 + 2 + 1


def test_hot_prompts_are_spread(spark, monkeypatch):
    monkeypatch.setattr(P, "HOT_TURNS", 10)
    splits = spark.createDataFrame([("hot", "en", 1, [("user", "How many red boxes does the old shop keep after noon?")], None), ("cold", "en", 1, [("user", "Which river runs behind the green mill?")], None)], "id string, language string, loaded_at int, messages array<struct<role string, content string>>, turns array<struct<message string>>")
    said = lambda q: [(None, (q, "stop"))]
    rows = [("hot", i, said("How many red boxes does the old shop keep after noon?")) for i in range(60)] + [("cold", 0, said("Which river runs behind the green mill?")), ("gone", 0, said("Nothing is known of it."))]
    df = spark.createDataFrame(rows, "id string, sample int, turns array<struct<prompt array<struct<role string, content string>>, response struct<text string, finish_reason string>>>")
    got = {(r.id, r.sample): r.defect for r in P.pair_defects(df, splits).collect()}
    assert got == {("hot", i): "copy" for i in range(60)} | {("cold", 0): "copy"}
