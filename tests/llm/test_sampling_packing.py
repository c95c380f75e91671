from collections import Counter

import numpy as np
import pytest

from gradeloom.llm import packing as P
from gradeloom.llm import sampling as S

SPLITS = "id string, domain string, task string, stratum string, loaded_at int, _l string"
TARGETS = "target_level string, category string, target_share double, sample_fraction double, min_rows int"


def splits(spark, n=3000):
    rows = [(f"id{i}", ["math", " Math ", "logic", None][i % 4], "t1" if i % 10 < 4 else "t-2", None if i % 7 == 0 else f"s{i % 3}", 1, "x") for i in range(n)]
    rows += rows[:50] + [(None, "math", "t1", "s1", 1, "x")]
    return spark.createDataFrame(rows, SPLITS)


def targets(spark):
    return spark.createDataFrame([("domain", "math", 0.7, 0.1, 5), ("domain", "Logic", 0.3, 0.1, 5), ("domain", "python", 0.0, 0.1, 5), ("task", "t1", 0.5, 0.1, 5), ("task", "T 2", 0.5, 0.1, 5)], TARGETS)


def test_proportions_floors_and_report(spark):
    sample, report = S.proportional_sample(splits(spark), targets(spark))
    r = {(x.target_level, x.category): x for x in report.collect()}
    n = sample.count()
    assert abs(n - 300) <= 45 and sample.select("id").distinct().count() == n
    assert r["domain", "math"].available == 1500 and abs(r["domain", "math"].selected - 210) < 25 and abs(r["task", "T 2"].selected - 150) < 30
    assert not r["domain", "python"].attainable and r["domain", "python"].available == 0
    again, _ = S.proportional_sample(splits(spark).repartition(7), targets(spark))
    assert {x.id for x in sample.collect()} == {x.id for x in again.collect()}


def test_proportions_of_nothing(spark):
    sample, report = S.proportional_sample(splits(spark).limit(0), targets(spark))
    assert sample.count() == 0 and {x.available for x in report.collect()} == {0}
    few = spark.createDataFrame([("a", "math", "t1", "s", 1, "x"), ("b", "logic", "t1", "s", 1, "x")], SPLITS)
    sample, report = S.proportional_sample(few, targets(spark))
    assert sample.count() == 2  # floors take all there is


def test_fit_meets_margins():
    counts = np.array([500.0, 300, 200, 10])
    p = S.least_shortfall(counts, [np.array([0, 0, 1, 1]), np.array([0, 1, 0, 1])], [np.array([60.0, 40]), np.array([70.0, 30])], 100)
    got = p * counts
    assert abs(got[0] + got[1] - 60) < 1 and abs(got[0] + got[2] - 70) < 1 and abs(got.sum() - 100) < 0.1 and (p <= 1).all()


def test_fit_with_targets_in_conflict():
    """Domain a may only come from task x, yet x is wanted less than a: 20 rows are lacking whatever is drawn, and no more."""
    counts = np.array([400.0, 300, 300])
    domain, task = np.array([0, 1, 1]), np.array([0, 1, 2])
    goals = [np.array([60.0, 40]), np.array([40.0, 40, 20])]
    p = S.least_shortfall(counts, [domain, task], goals, 100)
    lack = sum(np.maximum(0, g - np.bincount(m, p * counts)).sum() for m, g in zip([domain, task], goals))
    assert abs(lack - 20) < 0.5 and abs((p * counts).sum() - 100) < 0.1
    assert p.min() >= 0.9 * S.LEAST_RATE * 0.1  # nobody is left out for good
    # a category without rows, one wanted whole, and one cell for all
    assert S.least_shortfall(np.array([10.0, 5.0]), [np.array([0, 1])], [np.array([3.0, 5.0])], 8.0)[1] > 0.98
    assert S.least_shortfall(np.array([7.0]), [np.array([-1])], [np.zeros(0)], 3.0)[0] == pytest.approx(3 / 7)
    assert S.least_shortfall(np.zeros(0), [np.zeros(0, int)], [np.zeros(0)], 0.0).size == 0


def test_consistent_sample_only_grows(spark):
    rows = [(f"r{i}", "rl_train" if i % 5 else "rl_val", i % 4 + 1, "clash") for i in range(4000)] + [("r1", "RL_TRAIN ", 3, "clash"), (None, "rl_val", 1, None), ("z", None, None, None)]
    df = spark.createDataFrame(rows, "id string, split string, data_revision int, weight string")
    w = spark.createDataFrame([("rl_train", 1, 1.0), ("rl_train", 2, 0.5), ("rl_train", 3, 2.0), ("rl_val", 1, 3.0)], "category string, revision int, weight double")
    take = lambda d: {x.id: x for x in S.consistent_sample(d, w, 0.1)[0].collect()}
    every = take(df)
    assert 400 < len(every) < 1000 and "z" not in every
    for part in ("data_revision <= 1", "data_revision <= 3", "id > 'r2'"):
        assert set(take(df.filter(part))) <= set(every)
    assert set(take(df.filter("data_revision <= 2"))) == {i for i, x in every.items() if x.since <= 2}
    assert set(take(df.union(df).repartition(9))) == set(every) and take(df.limit(0)) == {}
    _, state = S.consistent_sample(df, w, 0.1)
    lower = spark.createDataFrame([("rl_train", 1, 0.01), ("rl_val", 1, 0.01)], "category string, revision int, weight double")
    assert {x.id for x in S.consistent_sample(df, lower, 0.1, state=state)[0].collect()} == set(every)


@pytest.mark.parametrize("seed", [1, 2])
def test_best_fit_keeps_all_capacities(seed):
    r = np.random.default_rng(seed)
    n = r.integers(1, 1000, 400)
    b = P.best_fit(np.stack([n / 1000, np.full(400, 1 / 8), (n / 1000) ** 2 / 0.8], axis=1))
    for k in set(b):
        inside = n[b == k]
        assert inside.sum() <= 1000 and len(inside) <= 8 and (len(inside) == 1 or (inside.astype(float) ** 2).sum() <= 0.8 * 1000 * 1000 + 1e-6)
    assert len(set(b)) <= np.ceil(n.sum() / 1000) * 1.16 + 1
    assert any(n[b == k].sum() > 895 and (b == k).sum() == 1 for k in set(b))  # a record beyond the attention capacity stands alone


def test_pack(spark):
    rows = [(f"a{i}", 300 + i % 500, 2048) for i in range(900)] + [("long", 5000, 2048), ("exact", 4096, 2048), ("null", None, 2048), ("zero", 0, 2048), ("neg", -3, 2048), ("nokind", 100, None), (None, 5, 2048), ("long", 5000, 2048)]
    df = spark.createDataFrame(rows, "id string, max_new_tokens int, length_bucket int")
    got = P.pack(df).collect()
    per = Counter()
    for x in got:
        if x.container:
            per[x.container] += x.tokens
            assert x.kind == 2048
    assert max(per.values()) <= 2048 and sum(per.values()) / (2048 * len(per)) > 0.93
    pieces = {i: sorted(x.tokens for x in got if x.id == i) for i in ("long", "exact")}
    assert pieces == {"long": [904, 2048, 2048], "exact": [2048, 2048]}
    assert {x.id for x in got if x.container is None} == {"null", "zero", "neg", "nokind"} and None not in {x.id for x in got}
    assert {x.id for x in got if x.pieces > 1} == {"long", "exact"}
    assert Counter(x.id for x in got)["a1"] == 1
    f = P.fill_report(P.pack(df)).first()
    assert f.divided == 2 and f.filled > 0.93
    assert P.pack(df.limit(0)).count() == 0
    x = P.limits(P.pack(df)).first()
    assert (x.records, x.over_tokens, x.over_items, x.over_attention, x.divided_in_vain, x.lost_pieces) == (902, 0, 0, 0, 0, 0)
    tight = P.limits(P.pack(df, max_items=3, max_attention=0.3), 3, 0.3).first()
    assert (tight.records, tight.over_items, tight.over_attention) == (902, 0, 0)
