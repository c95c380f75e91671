"""Queries of the subpackage by name, and SQL for those that SQL can express on whole tables."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gradeloom.llm import crosssplit, grouping, leaks, mixing, packing, pairs, residue, sampling, wordpiece
from gradeloom.session import table

#: Folder of the public tokenizer files; a parameter of the deployment.
TOKENIZERS = os.environ.get("GRADELOOM_TOKENIZERS", "/opt/tokenizers")
RANKS = f"{TOKENIZERS}/byte_bpe_50k.tiktoken"
#: Problem 2: weights of the splits from a revision on, and the constant.
WEIGHTS = [("rl_train", 1, 1.0), ("rl_train", 2, 0.8), ("rl_train", 3, 1.25), ("rl_train", 4, 1.1), ("rl_val", 1, 4.0), ("rl_val", 3, 3.0), ("main_test", 1, 2.0), ("main_test", 2, 4.0), ("main_test", 4, 2.0)]
CONSTANT = 0.08


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    """Categories whose target can't be met, from the report of the sampling operator."""
    _, report = sampling.proportional_sample(table(spark, d, "splits"), table(spark, d, "share_targets"))
    return report.filter("not attainable").select("target_level", "category").distinct()


def p1_sample(spark: SparkSession, d: str) -> DataFrame:
    return sampling.proportional_sample(table(spark, d, "splits"), table(spark, d, "share_targets"))[0]


def p1_report(spark: SparkSession, d: str) -> DataFrame:
    return sampling.proportional_sample(table(spark, d, "splits"), table(spark, d, "share_targets"))[1]


def p1_shortfall(spark: SparkSession, d: str) -> DataFrame:
    """Per level: categories that are met, that could be met by themselves, and the rows that attainable ones lack."""
    _, report = sampling.proportional_sample(table(spark, d, "splits"), table(spark, d, "share_targets"))
    lack = F.sum(F.when(F.col("attainable"), F.col("short_by")))
    return report.groupBy("target_level").agg(F.count("*").alias("categories"), F.count_if("met").alias("met"), F.count_if("attainable").alias("attainable"), lack.alias("short_by"), F.sum("selected").alias("selected"))


def _p2(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    weights = spark.createDataFrame(WEIGHTS, "category string, revision int, weight double")
    return sampling.consistent_sample(table(spark, d, "splits"), weights, CONSTANT)


def p2_sample(spark: SparkSession, d: str) -> DataFrame:
    return _p2(spark, d)[0]


def p2_weights(spark: SparkSession, d: str) -> DataFrame:
    return _p2(spark, d)[1]


def p3_token_budget(spark: SparkSession, d: str) -> DataFrame:
    return wordpiece.token_budget(table(spark, d, "splits"), table(spark, d, "documents"), table(spark, d, "token_pieces"))


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    return pairs.pair_defects(table(spark, d, "samples"), table(spark, d, "splits"))


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    found = crosssplit.cross_split_overlaps(table(spark, d, "splits"))
    return found.select(F.least("train_id", "eval_id").alias("id_a"), F.greatest("train_id", "eval_id").alias("id_b")).distinct()


def p5_report(spark: SparkSession, d: str) -> DataFrame:
    """Overlapping evaluation records and pairs per split, task and repository of both sides."""
    return crosssplit.overlap_report(table(spark, d, "splits"), wordpiece.repository)


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    """Records that the packing had to divide."""
    return packing.pack(table(spark, d, "splits")).filter("pieces > 1").select("id").distinct()


def p6_containers(spark: SparkSession, d: str) -> DataFrame:
    return packing.pack(table(spark, d, "splits"))


def p6_fill(spark: SparkSession, d: str) -> DataFrame:
    return packing.fill_report(packing.pack(table(spark, d, "splits")))


def p6_limits(spark: SparkSession, d: str) -> DataFrame:
    """No capacity is exceeded, no record divided in vain or lost."""
    return packing.limits(packing.pack(table(spark, d, "splits")))


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    return grouping.tied_families(table(spark, d, "splits"))


def p7_assignment(spark: SparkSession, d: str) -> DataFrame:
    return grouping.grouped_split(table(spark, d, "splits"))


def p7_report(spark: SparkSession, d: str) -> DataFrame:
    s = table(spark, d, "splits")
    return grouping.split_report(s, grouping.grouped_split(s))


def p7_broken(spark: SparkSession, d: str) -> DataFrame:
    """No family lies in two splits, and every record in one."""
    s = table(spark, d, "splits")
    return grouping.broken_ties(s, grouping.grouped_split(s))


def p8_found(spark: SparkSession, d: str) -> DataFrame:
    return leaks.leaked_items(table(spark, d, "documents"), table(spark, d, "heldout_pool"))


def p8_report(spark: SparkSession, d: str) -> DataFrame:
    """Leaked items with the number of documents that hold them."""
    found = p8_found(spark, d).groupBy("item_id").agg(F.count("*").alias("documents"))
    return found.join(table(spark, d, "heldout_pool").select("item_id", "task", "lang").distinct(), "item_id")


def p9_found(spark: SparkSession, d: str) -> DataFrame:
    _, report = mixing.mix(table(spark, d, "documents"), table(spark, d, "mix_targets"), RANKS)
    return report.filter("falls_short").select("source").distinct()


def p9_report(spark: SparkSession, d: str) -> DataFrame:
    return mixing.mix(table(spark, d, "documents"), table(spark, d, "mix_targets"), RANKS)[1]


def p9_shares(spark: SparkSession, d: str) -> DataFrame:
    """Shares of a mix whose size lets every source with documents keep its weight."""
    _, report = mixing.mix(table(spark, d, "documents"), table(spark, d, "mix_targets"), RANKS, keep_shares=True)
    mixed = F.sum(F.when(F.col("tokens") > 0, F.col("target_weight"))).over(Window.partitionBy())  # one row per target
    return report.select("source", "target_weight", (F.col("target_weight") / mixed).alias("target_share"), "share", "used")


def p9_mix(spark: SparkSession, d: str) -> DataFrame:
    return mixing.shuffled_copies(mixing.mix(table(spark, d, "documents"), table(spark, d, "mix_targets"), RANKS)[0])


def p10_found(spark: SparkSession, d: str) -> DataFrame:
    return residue.residue(table(spark, d, "documents")).select("doc_id")


def p10_report(spark: SparkSession, d: str) -> DataFrame:
    """Documents per kind of defect."""
    return residue.residue(table(spark, d, "documents")).groupBy("defect").agg(F.count("*").alias("documents"))


def queries():
    names = "p1_found p1_sample p1_report p1_shortfall p2_sample p2_weights p3_token_budget p4_found p5_found p5_report p6_found p6_containers p6_fill p6_limits p7_found p7_assignment p7_report p7_broken p8_found p8_report p9_found p9_report p9_shares p9_mix p10_found p10_report"
    return {n: globals()[n] for n in names.split()}


_KEY = r"nullif(regexp_replace(lower({0}), '[\s\-_]+', '', 'g'), '')"
_HASH = "CAST(('0x' || substr(sha256({0}), 1, 13)) AS BIGINT)"

_P2 = f"""
WITH w(category, revision, w) AS (VALUES {", ".join(f"('{c}', {r}, {x}::DOUBLE)" for c, r, x in WEIGHTS)}),
m AS (SELECT category, revision, max(w) OVER (PARTITION BY category ORDER BY revision) AS weight FROM w WHERE revision <= (SELECT max(coalesce(data_revision, 0)) FROM splits)),
r AS (SELECT id, coalesce(data_revision, 0) AS rev, lower(trim(split)) AS category, {_HASH.format("id")} AS h FROM splits WHERE id IS NOT NULL)
"""


def oracle_sql() -> dict[str, str]:
    return {
        "p1_found": f"""
WITH ids AS (SELECT id, min(struct_pack(domain := domain, task := task, stratum := stratum)) AS l FROM splits WHERE id IS NOT NULL GROUP BY id),
lab AS (SELECT 'domain' AS lv, {_KEY.format("l.domain")} AS k FROM ids UNION ALL SELECT 'task', {_KEY.format("l.task")} FROM ids UNION ALL SELECT 'stratum', {_KEY.format("l.stratum")} FROM ids),
have AS (SELECT lv, k, count(*) AS n FROM lab GROUP BY ALL), total AS (SELECT count(*) AS n FROM ids)
SELECT DISTINCT t.target_level, t.category FROM share_targets t CROSS JOIN total LEFT JOIN have h ON h.lv = t.target_level AND h.k = {_KEY.format("t.category")}
WHERE coalesce(h.n, 0) < greatest(t.min_rows, t.target_share * t.sample_fraction * total.n)""",
        "p2_sample": _P2
        + f"""SELECT id, min(rev) AS revision, least(1.0::DOUBLE, max(weight) * {CONSTANT}::DOUBLE) AS probability, min(greatest(revision, rev)) AS since
FROM r JOIN m USING (category) WHERE h < least(1.0::DOUBLE, weight * {CONSTANT}::DOUBLE) * 4503599627370496.0::DOUBLE GROUP BY id""",
        "p2_weights": _P2 + "SELECT category, max(weight) AS weight FROM m GROUP BY category",
        "p6_found": "SELECT DISTINCT id FROM splits WHERE id IS NOT NULL AND length_bucket IS NOT NULL AND max_new_tokens > length_bucket AND length_bucket > 0",
        "p6_limits": """
WITH r AS (SELECT id, max(struct_pack(n := max_new_tokens::BIGINT, k := length_bucket::BIGINT)) AS x FROM splits WHERE id IS NOT NULL GROUP BY id)
SELECT x.k AS kind, count(*) AS records, 0::BIGINT AS divided_in_vain, 0::BIGINT AS lost_pieces, sum(x.n)::BIGINT AS tokens, 0::BIGINT AS over_tokens, 0::BIGINT AS over_items, 0::BIGINT AS over_attention FROM r WHERE x.n > 0 AND x.k > 0 GROUP BY 1""",
        "p7_broken": "SELECT count(DISTINCT id) AS records, count(DISTINCT id) AS ids, 0::BIGINT AS crossed FROM splits WHERE id IS NOT NULL",
        "p7_found": """
WITH RECURSIVE fam AS (SELECT DISTINCT nullif(lower(trim(family_id)), '') AS a, nullif(lower(trim(x.alias)), '') AS b FROM splits, unnest(family_aliases) AS x(alias)),
e AS (SELECT a, b FROM fam WHERE a IS NOT NULL AND b IS NOT NULL AND a <> b UNION SELECT b, a FROM fam WHERE a IS NOT NULL AND b IS NOT NULL AND a <> b),
reach(x, y) AS (SELECT a, a FROM e UNION SELECT r.x, e.b FROM reach r JOIN e ON e.a = r.y),
root AS (SELECT x AS node, min(y) AS root FROM reach GROUP BY x),
t AS (SELECT DISTINCT root, family_id FROM splits JOIN root ON node = lower(trim(family_id))),
g AS (SELECT root, min(family_id) AS group_id FROM t GROUP BY root HAVING count(*) >= 2)
SELECT group_id, family_id FROM t JOIN g USING (root)""",
    }
