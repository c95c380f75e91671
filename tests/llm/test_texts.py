import random

import pytest

from gradeloom.llm import crosssplit as C
from gradeloom.llm import leaks as L
from gradeloom.llm import pairs as P
from gradeloom.llm.residue import defect, residue
from gradeloom.llm.words import plain_words, words

R = random.Random(7)
VOC = [f"{a}{b}" for a in "bcdfglmnprst" for b in ("an", "elor", "ikut", "omen", "usta")]


def sentence(n):
    return " ".join(R.choice(VOC) for _ in range(n))


def edited(ws, k):
    ws = list(ws)
    for _ in range(k):
        i, how = R.randrange(len(ws)), R.randrange(3)
        if how == 0:
            ws[i] = "zz" + str(R.randrange(99))
        elif how == 1:
            del ws[i]
        else:
            ws.insert(i, "yy")
    return ws


def test_words():
    assert words("Äpfel-Kuchen, ＡＢ 12½!") [:4] == ["apfel", "kuchen", "ab", "121"] or words("Äpfel, ＡＢ") == ["apfel", "ab"]
    assert plain_words("a &amp;amp; <b>bo</b>ld so­ft cut-\nword \\u0041b\\nnext") == ["a", "bold", "soft", "cutword", "ab", "next"]
    assert plain_words("") == [] and plain_words("有 猫") == ["有", "猫"]


def _brute_stretch(q, t):
    """Literal definition by dynamic programming over all starts in the question."""
    m = len(q)
    least = min(L.STRETCH, m)
    for s in range(m - least + 1):
        row = [0] * (len(t) + 1)
        for i in range(s, m):
            new = [row[0] + 1]
            for j in range(1, len(t) + 1):
                new.append(min(row[j - 1] + (q[i] != t[j - 1]), row[j] + 1, new[-1] + 1))
            row = new
            n = i - s + 1
            if n >= least and (m >= L.STRETCH or n == m) and min(row) <= n // L.PER_EDIT:
                return True
    return False


def test_leaks_against_brute_force(spark):
    items = [sentence(n).split() for n in (1, 2, 5, 9, 12, 18, 20, 25, 33, 39, 47, 60, 80)]
    docs = []
    for _ in range(300):
        q = R.choice(items)
        a = R.randrange(max(1, len(q) - 19))
        part = q[a : a + R.randrange(8, 45)]
        docs.append(sentence(R.randrange(0, 30)).split() + edited(part, R.randrange(0, min(5, len(part)))) + sentence(R.randrange(0, 30)).split())
    want = {(d, i) for d, t in enumerate(docs) for i, q in enumerate(items) if _brute_stretch(q, t)}
    pool = spark.createDataFrame([(i, " ".join(q)) for i, q in enumerate(items)], "item_id long, question string")
    df = spark.createDataFrame([(d, " ".join(t)) for d, t in enumerate(docs)], "doc_id long, text string")
    assert {(r.doc_id, r.item_id) for r in L.leaked_items(df, pool).collect()} == want
    assert len(want) > 80


def test_leaks_frame(spark):
    q = sentence(40)
    end = "Reply with one letter only."
    pool = spark.createDataFrame([(1, f"{q}. {end}"), (2, f"{sentence(30)}. {end}"), (3, f"{sentence(30)}. {end}"), (4, None), (5, ""), (1, f"{q}. {end}")], "item_id long, question string")
    half = " ".join(q.split()[5:30])
    docs = spark.createDataFrame([(1, f"x {half.upper()} y", 1), (2, None, 1), (3, "", 1), (4, end * 9, 1), (5, half.replace(" ", "&nbsp;"), 1), (5, half.replace(" ", "&nbsp;"), 1), (None, half, 1), (6, sentence(3000) + " " + half, 1)], "doc_id long, text string, item_id int")
    assert sorted((r.doc_id, r.item_id) for r in L.leaked_items(docs, pool).collect()) == [(1, 1), (5, 1), (6, 1)]
    assert L.leaked_items(docs.limit(0), pool).count() == 0 and L.leaked_items(docs, pool.limit(0)).count() == 0


def test_edit_within():
    def full(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            new = [i]
            for j, y in enumerate(b, 1):
                new.append(min(row[j - 1] + (x != y), row[j] + 1, new[-1] + 1))
            row = new
        return row[-1]

    for _ in range(300):
        a = [R.choice("abc") for _ in range(R.randrange(0, 12))]
        b = [R.choice("abc") for _ in range(R.randrange(0, 12))]
        for k in (0, 1, 3):
            d = full(a, b)
            assert C.edit_within(a, b, k) == (d if d <= k else k + 1)


SP = "id string, split string, task string, source string, messages array<struct<role string, content string>>, eval_id string"


def test_cross_split(spark):
    base = [f"{sentence(9)} {100 + i}. {sentence(11)}. {sentence(10)}?" for i in range(12)]
    rows = [(f"t{i:02d}", "rl_train", "a", "s", [("user", b)], "x") for i, b in enumerate(base)]
    rows += [(f"z{i}", "rl_train", "a", "s", [("user", f"{sentence(30)}\nAnswer briefly now.")], "x") for i in range(15)]
    s = base[2].split(". ")
    ev = {
        "e0": base[0].upper().replace(".", " ;"), "e1": " ".join(edited(base[1].replace(".", "").replace("?", "").split(), 0)) + "\nAnswer briefly now.", "e2": f"{s[1]}. {s[0]}. {s[2]}",
        "e3": base[3].replace("103", "104"), "e4": base[4].replace(base[4].split()[3], "other").replace(base[4].split()[15], "else"), "e5": " ".join(sentence(30).split()), "e6": "", "e8": f"1. {s[0]}.\n2. {s[1]}.\n3. {s[2]}",
    }
    rows += [(i, "main_test", "b", "s", [("user", q)], "x") for i, q in ev.items()] + [("e7", "rl_val", "b", "s", None, "x"), (None, "rl_val", "b", "s", [("user", base[0])], "x"), ("e0", "main_test", "b", "s", [("user", ev["e0"])], "x")]
    df = spark.createDataFrame(rows, SP)
    got = sorted((r.eval_id, r.train_id) for r in C.cross_split_overlaps(df).collect())
    assert got == [("e0", "t00"), ("e1", "t01"), ("e2", "t02"), ("e4", "t04"), ("e8", "t02")]
    assert C.cross_split_overlaps(df.limit(0)).count() == 0


def test_cross_split_against_brute_force(spark):
    """Every pair that the verification accepts is a candidate: short texts, sentences of all lengths in another order, lost
    and new line ends, words replaced, dropped and inserted."""
    rows = []
    for i in range(140):
        parts = [sentence(R.choice([2, 3, 4, 4, 5, 7, 9, 9, 12, 15])) for _ in range(R.choice([1, 1, 2, 3, 5, 6]))]
        rows.append((f"t{i:03d}", "rl_train", ". ".join(parts)))
        n = sum(len(p.split()) for p in parts)
        other = [" ".join(edited(p.split(), R.randrange(0, 2 + n // 20)) if R.random() < 0.5 and len(p.split()) > 2 else p.split()) for p in parts]
        if R.random() < 0.5:
            R.shuffle(other)
        text = R.choice([". ", ". ", " ", "\n"]).join(other)
        if R.random() < 0.2:
            ws = text.split(" ")
            ws[len(ws) // 2] += "."
            text = " ".join(ws)
        rows.append((f"e{i:03d}", "main_test", text))
    rows += [("t900", "rl_train", sentence(9)), ("t901", "rl_train", "a b c d e f g h i"), ("e901", "rl_val", "a b c d x e f g h i")]
    canon = {i: C.canonical(q, {}) for i, _, q in rows}
    ev, tr = [i for i, s, _ in rows if s != "rl_train"], [i for i, s, _ in rows if s == "rl_train"]
    want = {(e, t) for e in ev for t in tr if C.same_question(*canon[e], *canon[t]) or C.same_question(*canon[t], *canon[e])}
    df = spark.createDataFrame([(i, s, "a", "s", [("user", q)], "x") for i, s, q in rows], SP)
    got = {(r.eval_id, r.train_id) for r in C.cross_split_overlaps(df).collect()}
    both_ways = {(e, t) for e, t in want if not C.same_question(*canon[e], *canon[t])}
    assert want - both_ways <= got <= want and len(want) > 60 and ("e901", "t901") in got


@pytest.mark.parametrize("text,want", [
    ("Dear {{ name }}, welcome.", "placeholder"), ("The field is `{{name}}` in the template.", None), ("```\nx = '{{a}}'\n```\nText follows here.", None), ("Hello [First Name], thanks for [Topic].", "placeholder"),
    ("TODO: write this section", "placeholder"), ("The words TODO and TBD are not allowed.", None), ("Lorem ipsum dolor sit amet consectetur adipiscing elit sed do", "filler"), ("They print lorem ipsum on mugs.", None),
    ("404 Not Found", "error"), ("Some title\n\nAccess denied. Your session has expired.", "error"), ("On 12 links the service answered 404 Not Found, and we listed them.", None), ("Please enable JavaScript to view this page.", "scripts"),
    ("The course teaches JavaScript: it shows how to enable scripts.", None), ("The set \\{1, 2\\} and {1, 2, 3} are sets.", None), ("asdf qwerty zxcv asdf jkl asdf", "filler"), ("", None), (None, None), ("${A} and ${B}", "placeholder"),
])
def test_residue(text, want):
    assert defect(text) == want


def test_residue_frame(spark):
    df = spark.createDataFrame([(1, "404 Not Found", 1), (1, "404 Not Found", 1), (2, None, 1), (3, sentence(9000), 1), (None, "404 Not Found", 1)], "doc_id long, text string, defect int")
    assert [(r.doc_id, r.defect) for r in residue(df).collect()] == [(1, "error")] and residue(df.limit(0)).count() == 0


@pytest.mark.parametrize("text,want", [
    ("I'm sorry, but I can't help with that.", True), ("We can't provide a smaller bound than 4, because 3 fails.", False), ("Mina refused to help and said nobody could answer. The answer is 4.", False), ("Leider kann ich dabei nicht helfen.", True),
    ("Lo siento, no puedo ayudar con eso.", True), ("Désolé, je ne peux pas répondre à cela.", True), ("Извините, я не могу ответить на этот вопрос.", True), ("抱歉，我无法回答这个问题。", True), ("Sorry for the long answer: it is 5.", False),
])
def test_refusals(text, want):
    assert P.is_refusal(text) is want


def test_empty_and_copy():
    assert all(P.is_empty(x) for x in (None, "", " ​\n", "...", "```\n\n```", "<p>&nbsp;</p>", "{}", "<answer></answer>")) and not any(P.is_empty(x) for x in ("0", "A", "`x`"))
    q = words("How many red boxes does the old shop keep after noon?")
    assert P.is_copy("> HOW MANY red boxes does the old shop keep, after noon?", q) and not P.is_copy("How many red boxes does the old shop keep after noon?\n42", q) and not P.is_copy("The shop keeps 4.", q)
    assert P.left_open('{"a": [1') and P.left_open("```python\nx") and not P.left_open('{"a": "}"}') and not P.left_open("[sic] but a sentence")


SAMPLES = "id string, sample int, turns array<struct<prompt array<struct<role string, content string>>, response struct<text string, finish_reason string>>>, turn int"
SPLITS = "id string, language string, loaded_at int, messages array<struct<role string, content string>>, turns array<struct<message string>>"
EN = "the old shop keeps many red boxes behind the green door and the people who work there count them every morning before the market opens"
DE = "der alte laden bewahrt viele rote kisten hinter der grünen tür auf und die leute zählen sie jeden morgen bevor der markt geöffnet wird"


def _say(lang):
    ws = (EN if lang == "en" else DE).split()
    return (" ".join(R.choice(ws) for _ in range(25)) + ".").capitalize()


def test_pair_defects(spark):
    splits = [(f"p{i}", ["en", "de"][i % 2], 1, [("user", _say(["en", "de"][i % 2]))], None) for i in range(120)]
    turn = lambda lang, text: (([("user", _say(lang))]), (text, "stop"))
    rows = [(f"p{i}", 0, [turn(["en", "de"][i % 2], _say(["en", "de"][i % 2]))], 1) for i in range(120)]
    bad = [("b1", 0, [turn("en", " ")], 1), ("b2", 0, [turn("en", _say("de"))], 1), ("b3", 0, [turn("en", "I cannot help with that.")], 1), ("b4", 0, [turn("en", _say("en")[:-1] + " and the peop")], 1), ("b5", 0, [turn("en", None), None, (None, None)], 1),
           ("p1", 5, [(None, (splits[1][3][0][1], "stop"))], 1), ("b1", 0, [turn("en", " ")], 1), ("n", 1, None, 1), (None, 1, [turn("en", "")], 1), ("s", 0, [turn("en", "B")], 1)]
    df, sp = spark.createDataFrame(rows + bad, SAMPLES), spark.createDataFrame(splits, SPLITS)
    got = {(r.id, r.sample, r.turn, r.defect) for r in P.pair_defects(df, sp).collect()}
    assert got == {("b1", 0, 0, "empty"), ("b2", 0, 0, "wrong_language"), ("b3", 0, 0, "refusal"), ("b4", 0, 0, "truncated"), ("b5", 0, 0, "empty"), ("p1", 5, 0, "copy")}
    assert P.pair_defects(df.limit(0), sp).count() == 0 and P.pair_defects(df, sp.limit(0)).count() > 0


def test_language_accuracy():
    m = P.Languages([(x, _say(x)) for x in ("en", "de") for _ in range(60)])
    texts = [(x, _say(x)) for x in ("en", "de") for _ in range(50)]
    s = m.scores([t for _, t in texts])
    assert sum(m.names[a] == x for a, (x, _) in zip(s.argmax(axis=1), texts)) >= 98
