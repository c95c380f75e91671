import pytest

from gradeloom.llm.residue import defect


@pytest.mark.parametrize("text,want", [
    ("Some text.\n\n\n\n\nDear {{ name }}, welcome here.", "placeholder"), ("Some text.\r\n\r\n\r\nDear {{ name }}, welcome.", "placeholder"), ("Anna (Berlin) wrote to {{customer}} about it.", "placeholder"), ("return the form to {{customer}} by Friday.", "placeholder"),
    ("if you agree, {{customer}}, do the following:", "placeholder"), ("class {{subject}} starts at noon for all of us.", "placeholder"), ("    Dear {{customer}},\n    we thank you for coming.", "placeholder"),
    ("x = '{{a}}'\ny = f(x)", None), ("Use this:\n\n    {{ name }}\n\nin the page.", None), ('def f(a):\n    return "{name}".format(a)\n', None),
])
def test_only_lines_of_code_are_masked(text, want):
    assert defect(text) == want


@pytest.mark.parametrize("text,want", [
    ("We met with [Company Name] last week to talk.", "placeholder"), ("The party is on [DATE] at noon.", "placeholder"), ("Name: [Visitor]", "placeholder"), ("客户是【姓名】，请注意。", "placeholder"), ("Bonjour «firstname», bienvenue.", "placeholder"), ("You owe us {0} for the last month.", "placeholder"),
    ("Il a dit «oui» et il est parti.", None), ("The set {0} is closed.", None), ("As shown by [Smith] the bound holds.", None), ("【标题】这是一个标题", None), ("The field [DATE] stands for a token.", None),
    ("My page\n\nLorem ipsum dolor sit amet.", "filler"), ('He wrote "lorem ipsum dolor sit amet" there on the wall.', None),
    ("您访问的页面不存在，可能已经被移动或者删除，也可能是您输入的地址有误，请您检查地址之后再试一次，或者返回首页继续浏览", "error"),
])
def test_single_fields_short_filler_and_long_notices(text, want):
    assert defect(text) == want


def test_density_and_explanations():
    filling = " ".join(f"The {x} measures its own length before noon and after." for x in ("lamp", "river", "wall", "coat", "horse") * 100)
    assert defect(filling + " As [Smith] and [Jones] wrote, it holds. ") is None and defect("As [Smith] told [Jones], it holds.") == "placeholder"
    assert defect(filling + " Dear {{ name }}, we thank you. " + filling) == "placeholder"
    assert defect("In the template syntax {{ name }} is replaced by the value of the variable. Try it out.") is None
    assert defect("With Jinja you write {{ user }} and it gets rendered as text. The rest of the lesson follows.") is None
    assert defect("lorem " * 3 + "ipsum dolor amet sed do eiusmod tempor") == "filler" and defect("no no no no no no no no no") == "filler" and defect("1 1 1 1 1 1 1 1 1 1") is None
