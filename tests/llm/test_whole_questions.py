from gradeloom.llm import crosssplit as C

SP = "id string, split string, task string, source string, messages array<struct<role string, content string>>"


def test_short_sentences_boundaries_and_digit_groups(spark):
    pairs = [
        ("Bring four green boxes. Nine old men walked along the quiet harbor today. Who of them saw the ship first?", "Bring four blue boxes. Nine old men walked along the quiet harbor today. Who of them heard the ship first?"),
        ("Take two small stones. Which one of them weighs more at dawn?", "Take two small stones. Which one of them weighs most at dawn?"),
        ("Who sold the old grey house near the river bank?", "Who sold the old house near the river bank?"),
        ("Who wrote the long letter to Anna last week?", "Who wrote the very long letter to Anna last week?"),
        ("How many of the 1,000 red boxes were left behind in the shop?", "How many of the 1000 red boxes were left behind in the shop?"),
    ]
    rows = [(f"{side}{i}", split, "a", "s", [("user", p[k])]) for i, p in enumerate(pairs) for k, (side, split) in enumerate((("t", "rl_train"), ("e", "main_test")))]
    got = {(r.train_id, r.eval_id) for r in C.cross_split_overlaps(spark.createDataFrame(rows, SP)).collect()}
    assert got == {(f"t{i}", f"e{i}") for i in range(len(pairs))}


def test_one_segment_stays_intact():
    for spans in ([9, 9], [4, 8], [4, 9, 7], [1, 8], [3, 7], [5] * 6, [30], [9] * 10):
        n = sum(spans)
        starts = [sum(spans[:i]) for i in range(len(spans))]
        assert len([p for p in C.pieces([f"w{i}" for i in range(n)], starts) if p[0] != "="]) > n // 9
    assert C.canonical("1,000 and 1.000.000 or 1.000 and 12,5", {})[0] == ["1000", "and", "1000000", "or", "1", "000", "and", "12", "5"]
