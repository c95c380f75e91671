"""Filling containers of fixed capacity."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gradeloom.functions.labels import hash_unit
from gradeloom.session import BROADCAST_ROWS, cut, small

#: Items one task packs at a time; the loss is at most one part-filled container per so many items.
GROUP = 4_000
#: A container that is less full than this is packed again with those of other groups.
NEARLY = 0.95


#: Weights of tokens, items and attention cost in the score of a bin.
WEIGHTS = np.array([1.0, 0.25, 1.0])


def best_fit(demand: np.ndarray) -> np.ndarray:
    """Bin number of each item by vector best fit. demand: a row per item with its tokens, pieces and attention cost as shares
    of a bin's capacities. Largest first, an item goes to the bin that has room in every respect and the largest weighted dot
    product of the item's demand and the inverse of what the bin has left, ties to the smallest residual: the bin that it
    leaves fullest where it matters to the item. An item too large for an empty bin in one respect has a bin of its own."""
    order = np.lexsort((np.arange(len(demand)), -demand[:, 2], -demand[:, 0]))
    bins = np.empty(len(demand), int)
    left = np.empty((len(demand), 3))
    used = 0
    for i in order:
        d = demand[i]
        fits = np.flatnonzero((left[:used] >= d - 1e-12).all(axis=1))
        if len(fits):
            room = left[fits]
            score = (WEIGHTS * d / np.maximum(room, 1e-9)).sum(axis=1) - 1e-3 * np.linalg.norm(room - d, axis=1)
            b = fits[int(np.argmax(score))]
        else:
            b = used
            used += 1
            left[b] = 1.0
        left[b] -= d
        bins[i] = b
    return bins


def pack(df: DataFrame, length: str = "max_new_tokens", kind: str = "length_bucket", id_col: str = "id", max_items: int = 128, max_attention: float = 0.8) -> DataFrame:
    """A row per piece: id, kind, piece (from 0), pieces, tokens, container. Method: vector best-fit under three capacities per
    container: `kind` tokens, max_items pieces and an attention cost (sum of squared lengths) of max_attention x kind^2. Below 1
    the last keeps long records from sharing a container with much else; a record that alone costs more has one to itself.

    Repeated deliveries of an id count once (the largest length and kind). A record longer than its container is cut
    into full containers and a rest that is packed as an item; no other record is divided. Full pieces fill a container
    alone and need no packing. A record without a positive length or kind cannot be placed: it stays with tokens 0,
    pieces 0 and a null container. Null ids are dropped; an empty table gives no rows.

    Scale: records are hashed into groups of about GROUP items per kind, a hot kind into many, each packed on its own; the
    containers of all groups that are less than NEARLY full are packed again, as items with the sums of their demands, by the
    same best fit."""
    rows = df.filter(F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("id")).agg(F.max(F.struct(F.col(length).cast("long").alias("n"), F.col(kind).cast("long").alias("k"))).alias("x"))
    rows = rows.select("id", F.coalesce("x.n", F.lit(0)).alias("n"), F.col("x.k").alias("kind"))
    ok = (F.col("n") > 0) & F.coalesce(F.col("kind") > 0, F.lit(False))
    none = rows.filter(~ok).select("id", "kind", F.lit(0).alias("piece"), F.lit(0).alias("pieces"), F.lit(0).cast("long").alias("tokens"), F.lit(None).cast("string").alias("container"))
    cuts = rows.filter(ok).withColumn("whole", F.floor(F.col("n") / F.col("kind")).cast("int")).withColumn("rest", F.col("n") % F.col("kind"))
    cuts = cuts.withColumn("pieces", F.col("whole") + (F.col("rest") > 0).cast("int"))
    full = cuts.filter("whole > 0").select("id", "kind", F.explode(F.sequence(F.lit(0), F.col("whole") - 1)).alias("piece"), "pieces", F.col("kind").alias("tokens"))
    full = full.withColumn("container", F.concat_ws("/", F.col("kind").cast("string"), F.lit("full"), "id", F.col("piece").cast("string")))
    items = cut(cuts.filter("rest > 0").select("id", "kind", F.col("whole").alias("piece"), "pieces", F.col("rest").alias("tokens"), hash_unit(F.lit("p6"), "id").alias("h")), "p6items")
    groups = items.groupBy("kind").agg(F.ceil(F.count("*") / F.lit(GROUP)).alias("groups"))
    items = items.join(small(groups), "kind").withColumn("g", (F.col("h") % F.col("groups")).cast("long")).drop("h", "groups")

    def bins(tokens: pd.Series, n: pd.Series | int, cost: pd.Series, cap: int) -> np.ndarray:
        return best_fit(np.stack([tokens / cap, np.broadcast_to(n, len(tokens)) / max_items, cost / (max_attention * cap * cap)], axis=1).astype(float))

    def first(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("id", kind="stable")
        cap = int(pdf["kind"].iloc[0])
        b = bins(pdf["tokens"], 1, pdf["tokens"].astype(float) ** 2, cap)
        return pdf.assign(container=[f"{cap}/{g}/{x}" for g, x in zip(pdf["g"], b)])[["id", "kind", "piece", "pieces", "tokens", "container"]]

    once = cut(items.groupBy("kind", "g").applyInPandas(first, "id string, kind long, piece int, pieces int, tokens long, container string"), "p6once")
    loose = once.groupBy("kind", "container").agg(F.sum("tokens").alias("tokens"), F.count("*").alias("n"), F.sum(F.col("tokens").cast("double") * F.col("tokens")).alias("cost")).filter(F.col("tokens") < F.lit(NEARLY) * F.col("kind"))
    loose = cut(loose, "p6loose")
    shares = loose.groupBy("kind").agg(F.ceil(F.count("*") / F.lit(GROUP)).alias("groups"))
    loose = loose.join(small(shares), "kind").withColumn("g", F.pmod(F.xxhash64("container"), F.col("groups")))

    def second(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("container", kind="stable")
        b = bins(pdf["tokens"], pdf["n"].to_numpy(), pdf["cost"], int(pdf["kind"].iloc[0]))
        names = pdf.groupby(b)["container"].transform("min")
        return pd.DataFrame({"container": pdf["container"], "joined": names})

    moved = loose.groupBy("kind", "g").applyInPandas(second, "container string, joined string").filter("container <> joined")
    moved = cut(moved, "p6moved")
    joined = moved if moved.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else moved.hint("merge")  # AQE must not broadcast a side that grows with the data
    packed = once.join(joined, "container", "left").select("id", "kind", "piece", "pieces", "tokens", F.coalesce("joined", "container").alias("container"))
    return packed.unionByName(full).unionByName(none)


def limits(packed: DataFrame, max_items: int = 128, max_attention: float = 0.8) -> DataFrame:
    """Per kind what was placed, and the containers in which a capacity is exceeded (none may be; a single piece may cost what it
    costs), and records divided although they fit."""
    placed = packed.filter("container is not null")
    one = placed.groupBy("kind", "container").agg(F.sum("tokens").alias("tokens"), F.count("*").alias("n"), F.sum(F.col("tokens").cast("double") * F.col("tokens")).alias("cost"))
    over = one.groupBy("kind").agg(
        F.sum("tokens").alias("tokens"), F.count_if(F.col("tokens") > F.col("kind")).alias("over_tokens"), F.count_if(F.col("n") > max_items).alias("over_items"),
        F.count_if((F.col("n") > 1) & (F.col("cost") > (max_attention + 1e-9) * F.col("kind") * F.col("kind"))).alias("over_attention"),
    )
    whole = placed.groupBy("kind", "id").agg(F.sum("tokens").alias("t"), F.max("pieces").alias("p"), F.count("*").alias("n"))
    records = whole.groupBy("kind").agg(F.count("*").alias("records"), F.count_if((F.col("p") > 1) & (F.col("t") <= F.col("kind"))).alias("divided_in_vain"), F.count_if(F.col("p") != F.col("n")).alias("lost_pieces"))
    return records.join(over, "kind")


def fill_report(packed: DataFrame) -> DataFrame:
    """Per kind: containers, tokens, the share of their capacity that is filled, and divided records."""
    placed = packed.filter("container is not null")
    one = placed.groupBy("kind", "container").agg(F.sum("tokens").alias("tokens"))
    cut_up = placed.filter("pieces > 1").groupBy("kind").agg(F.countDistinct("id").alias("divided"))
    return one.groupBy("kind").agg(F.count("*").alias("containers"), F.sum("tokens").alias("tokens")).withColumn("filled", F.col("tokens") / (F.col("containers") * F.col("kind"))).join(cut_up, "kind", "left").fillna(0, ["divided"])
