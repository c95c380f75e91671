from gradeloom.operators import overlap


def test_classes_from_eight_tenths_short_and_chinese(spark):
    w = [f"w{i}" for i in range(50)]
    zh = "因为昨天下午港口的风很大所以三艘旧船都没有按时离开码头，船长只好在灯塔下面等到天亮"
    rows = [(1, " ".join(w)), (2, " ".join([*w[:45], *"vwxyz"])), (3, "one two three four five six"), (4, "One, two: three four five six!"), (5, zh), (6, zh[:-1] + "黑"), (7, "one two"), (8, ""), (9, None)]
    got = {r.id: r.links for r in overlap.near_classes(spark.createDataFrame(rows, "id long, text string"), "id", "text").collect()}
    assert got == {1: 1, 2: 1, 3: 1, 4: 1, 5: 1, 6: 1, 7: 0, 8: 0}
