"""The same question in different splits: an edit-distance segment join over words."""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterator
from functools import cache, reduce
from operator import or_

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gradeloom.llm.words import fold, words
from gradeloom.session import cut, small

#: Words per allowed edit, and most words of a segment.
PER_EDIT, SEGMENT = 10, 5
#: A closing line is a standing instruction when it ends different texts, one for every so many records and at least FEWEST.
ONE_IN, FEWEST = 200, 5
#: Words of a closing line that count; a longer one is no instruction on how to answer.
LONGEST_LINE = 60
_STOP = re.compile(r"(?<=[.?!。？！])\s+|(?<=[。？！])|\n+")
#: Digits in groups of three; a single point may be a decimal sign.
_GROUPED = re.compile(r"(?<![\d.,])\d{1,3}(?:(?:[,，'’\u00a0\u2009\u202f]\d{3})+|(?:\.\d{3}){2,})(?!\d|[.,]\d{3}(?!\d))")
_LIST = re.compile(r"(?m)^\s*\d{1,3}\s*[.):]\s+")


def h64(text: str) -> int:
    return int.from_bytes(hashlib.blake2b(text.encode(), digest_size=8).digest(), "big", signed=True)


def canonical(text: str, endings: dict[int, list[tuple[str, ...]]]) -> tuple[list[str], list[int]]:
    """Words of a question without list numbers and closing instruction, and where its sentences start."""
    lines = _GROUPED.sub(lambda m: "".join(filter(str.isdigit, m.group())), _LIST.sub("", text))
    ws, starts = [], []
    for part in _STOP.split(lines):
        w = words(part)
        if w:
            # a piece of fewer words than a segment goes on with the sentence before
            if not starts or len(w) >= SEGMENT:
                starts.append(len(ws))
            ws += w
    for e in endings.get(ws[-1], ()) if ws else ():
        if len(e) < len(ws) and tuple(ws[-len(e) :]) == e:
            ws = ws[: -len(e)]
            break
    return ws, [s for s in starts if s < len(ws)]


def numbers(ws: list[str]) -> list[str]:
    return sorted(w for w in ws if any(c.isdigit() for c in w))


def _without_marks(found: list[str]) -> Counter:
    """Numbers without the run 1, 2, 3 ... of a list whose signs were lost."""
    c = Counter(found)
    k = 0
    while c[str(k + 1)]:
        k += 1
    if k >= 2:
        c.subtract(str(i) for i in range(1, k + 1))
    return +c


def signature(ws: list[str]) -> int:
    """Hash of the numbers of a text, but for those of one digit (they may be marks of a list)."""
    return h64(" ".join(n for n in numbers(ws) if len(n) > 1 or not n.isdigit()))


def edit_within(a: list[str], b: list[str], k: int) -> int:
    """Edit distance in words by dynamic programming in a band of 2k+1 diagonals; k+1 if it is larger than k."""
    n, m = len(a), len(b)
    if abs(n - m) > k:
        return k + 1
    far = k + 1
    row = {j: j for j in range(min(m, k) + 1)}
    for i in range(1, n + 1):
        new = {}
        for j in range(max(0, i - k), min(m, i + k) + 1):
            best = row.get(j, far) + 1
            if j:
                best = min(best, new.get(j - 1, far) + 1, row.get(j - 1, far) + (a[i - 1] != b[j - 1]))
            else:
                best = i
            new[j] = min(best, far)
        if min(new.values()) > k:
            return far
        row = new
    return row.get(m, far)


def _inside(s: list[str], t: list[str | None]) -> tuple[int, int, int]:
    """(edits, start, end) of the best place of s inside t."""
    m = len(t)
    row = [(0, j) for j in range(m + 1)]
    for i, w in enumerate(s, 1):
        new = [(i, 0)]
        for j in range(1, m + 1):
            d, at = row[j - 1]
            best = (d + (w != t[j - 1]), at)
            d, at = row[j]
            best = min(best, (d + 1, at))
            d, at = new[j - 1]
            new.append(min(best, (d + 1, at)))
        row = new
    end = min(range(m + 1), key=lambda j: (row[j][0], j))
    return row[end][0], row[end][1], end


def same_question(a: list[str], a_starts: list[int], b: list[str], b_starts: list[int]) -> bool:
    """Whether b is a with at most one word in ten replaced, dropped or inserted, the same numbers, and its sentences in
    any order."""
    k = max(len(a), len(b)) // PER_EDIT
    ca, cb = Counter(a), Counter(b)
    if max((ca - cb).total(), (cb - ca).total()) > k:  # no alignment can do with fewer edits
        return False
    na, nb = numbers(a), numbers(b)
    if na != nb and _without_marks(na) != Counter(nb) and _without_marks(nb) != Counter(na) and _without_marks(na) != _without_marks(nb):
        return False
    if edit_within(a, b, k) <= k:
        return True
    if len(b_starts) > len(a_starts):
        a, a_starts, b = b, b_starts, a
    if len(a_starts) < 2:
        return False
    edits, rest = 0, list(b)
    spans = sorted((a[s:e] for s, e in zip(a_starts, [*a_starts[1:], len(a)])), key=len, reverse=True)
    for s in spans:
        if not rest:
            edits += len(s)
            continue
        d, lo, hi = _inside(s, rest)
        if d >= len(s):
            edits += len(s)
            continue
        edits += d
        # what stood on both sides of a sentence does not become one text: a mark that equals no word stays between
        rest = rest[:lo] + [None] + rest[hi:]
        if edits > k:
            return False
    return edits + sum(w is not None for w in rest) <= k


def piece_length(n: int, starts: list[int]) -> int:
    """Words of a segment of a text: the most, up to SEGMENT, that give one segment more than there may be edits, when no
    segment crosses a sentence. The longest text that it can pair with has n/0.9 words, so n//9 edits."""
    spans = [e - s for s, e in zip(starts, [*starts[1:], n])]
    return next(x for x in range(SEGMENT, 0, -1) if x == 1 or sum(s // x for s in spans) > n // (PER_EDIT - 1))


def pieces(ws: list[str], starts: list[int]) -> list[tuple[str, int, int, int]]:
    """(words, place in the text, in its sentence, and before the sentence's end) of each segment. Each edit spoils one segment at most, so one stays
    intact. Texts of less than PER_EDIT words allow no edit among themselves and are one key; one of PER_EDIT - 1 may also
    pair with a longer one."""
    out = [(f"={' '.join(sorted(ws))}", 0, 0, 0)] if len(ws) < PER_EDIT else []
    if len(ws) >= PER_EDIT - 1:
        x = piece_length(len(ws), starts)
        out += [(" ".join(ws[i : i + x]), i, i - s, e - i) for s, e in zip(starts, [*starts[1:], len(ws)]) for i in range(s, e - x + 1, x)]
    return out


def substrings(ws: list[str], starts: list[int], lengths: set[int]) -> list[tuple[str, int, int, int]]:
    """Where a segment of one of the lengths may stand in the other text; which places are allowed is told by `allowed`."""
    out = [(f"={' '.join(sorted(ws))}", 0, 0, 0)] if len(ws) < PER_EDIT else []
    spans = np.diff([*starts, len(ws)])
    of, to = np.repeat(starts, spans).tolist(), np.repeat([*starts[1:], len(ws)], spans).tolist()
    return out + [(" ".join(ws[i : i + x]), i, i - of[i], to[i] - i) for x in lengths if len(ws) >= PER_EDIT - 1 for i in range(len(ws) - x + 1)]


def allowed():
    """Condition on a segment of text 1 and its place in text 2: the place in the text differs by no more than there may be
    edits (the sentences stand in the same order), or the place within the sentence, from its start or its end, does (they
    do not), or the texts show different numbers of sentences: then it may stand anywhere."""
    far = F.greatest("n1", "n2") / F.lit(PER_EDIT)
    near = lambda c: F.abs(F.col(f"{c}1") - F.col(f"{c}2")) <= far
    return near("p") | near("s") | near("r") | (F.col("c1") != F.col("c2"))


def size_band(n: int) -> int:
    """Texts that can be the same question are in the same or in neighbouring bands."""
    return int(math.log(max(n, 1)) / -math.log(1 - 1 / PER_EDIT))


def partner_lengths(used: dict[int, int], m: int) -> set[int]:
    """Segment lengths of the texts that a text of m words may pair with; used: per number of words, the lengths as bits."""
    k = m // (PER_EDIT - 1)
    bits = reduce(or_, (used.get(n, 0) for n in range(m - k, m + k + 1) if abs(n - m) <= max(n, m) // PER_EDIT), 0)
    return {x for x in range(1, SEGMENT + 1) if bits >> x & 1}


def standing_lines(df: DataFrame, text: str) -> list[list[str]]:
    """Closing lines that end one different text per ONE_IN records or more (so there are at most ONE_IN of them), as words."""
    whole = F.trim(F.col(text))
    last = F.substring_index(whole, "\n", -1)
    body, line = F.left(whole, F.length(whole) - F.length(last)), F.lower(F.trim(last))
    every = df.filter(F.length(whole) > 0).count()
    lines = df.filter(F.col(text).contains("\n")).select(line.alias("line"), F.xxhash64(body).alias("h")).filter(F.size(F.split("line", " ")) <= LONGEST_LINE)
    # two steps: a line that closes a third of all texts is counted in many parts
    parts = lines.distinct().groupBy("line", F.pmod("h", F.lit(64)).alias("part")).count()
    found = parts.groupBy("line").agg(F.sum("count").alias("n")).filter(F.col("n") >= max(FEWEST, every / ONE_IN)).collect()
    return [words(r.line) for r in found]


def overlap_classes(df: DataFrame, train: str = "rl_train", evals: tuple[str, ...] = ("rl_val", "main_test")) -> tuple[DataFrame, DataFrame]:
    """(pairs, members). pairs: `e`, `t`, classes of records with the same canonical question, one of evaluation records and
    one of training records, that are the same question exactly or nearly. members: `text_id` (the class), `is_eval`, `id`,
    `split`, `task`, `source`, a row per record. Copies are members of their class and multiply no pairs. Nearly: the same words and numbers apart from case, punctuation,
    character forms, layout, list numbers, order of sentences and the standing answer instruction on the closing line,
    with at most one word in ten replaced, dropped or inserted.

    Method: edit-distance segment join, on distinct canonical texts, so that copies meet once. The numbers must be equal,
    so their hash is part of the join key, as is a band of lengths. Texts are cut into one segment more than there may be
    edits, and matched with the substrings of the other side at allowed positions: evaluation segments in training texts
    and, since only one side may show where sentences end, training segments in evaluation texts. Pairs are verified with
    banded dynamic programming (per sentence if the order differs). Repeated deliveries count once; null ids, messages or
    contents match nothing; empty tables give no rows."""
    last = F.expr("element_at(filter(messages, m -> m.role = 'user'), -1).content")
    wanted = df.filter(F.col("id").isNotNull() & F.col("split").isin(train, *evals)).select("id", "split", "task", "source", last.alias("q")).filter("q is not null")
    endings: dict[int, list[tuple[str, ...]]] = {}
    for e in sorted(standing_lines(wanted, "q"), key=len, reverse=True):
        if e:
            endings.setdefault(e[-1], []).append(tuple(e))
    sent = df.sparkSession.sparkContext.broadcast(endings)

    def features(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for i, s, t, o, q in zip(pdf["id"], pdf["split"], pdf["task"], pdf["source"], pdf["q"]):
                ws, starts = canonical(q, sent.value)
                if ws:
                    body = " ".join(ws)
                    rows.append((i, s != train, s, t, o, signature(ws), h64(body + "|" + ",".join(map(str, starts))), body, starts))
            yield pd.DataFrame(rows, columns=["id", "is_eval", "split", "task", "source", "sig", "text_id", "body", "starts"])

    feats = cut(wanted.mapInPandas(features, "id string, is_eval boolean, split string, task string, source string, sig long, text_id long, body string, starts array<int>"), "p5feats")
    sigs = feats.filter("is_eval").select("sig").distinct()
    texts = lambda f: f.select("text_id", "sig", "body", "starts").dropDuplicates(["text_id"])
    ev = cut(texts(feats.filter("is_eval")), "p5eval")
    tr = cut(texts(feats.filter("not is_eval").join(small(sigs), "sig", "left_semi")), "p5train")

    def lengths(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            sizes = [(n := body.count(" ") + 1, piece_length(n, list(starts))) for body, starts in zip(pdf["body"], pdf["starts"])]
            yield pd.DataFrame(sorted(set(sizes)), columns=["n", "x"])

    def used_by(side: DataFrame) -> dict[int, int]:
        used: dict[int, int] = {}
        for r in side.select("body", "starts").mapInPandas(lengths, "n int, x int").distinct().collect():  # at most SEGMENT rows per number of words
            used[r.n] = used.get(r.n, 0) | 1 << r.x
        return used

    def keys(side: DataFrame, which: str, used: dict[int, int] | None) -> DataFrame:
        """Segments (used is None) or the substrings that segments of the other side may equal. The side of the segments is
        the one that is copied to the neighbouring bands of length."""

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            of = cache(lambda m: partner_lengths(used, m)) if used is not None else None
            for pdf in batches:
                ids, sizes, counts, rows = [], [], [], []
                for i, sig, body, starts in zip(pdf["text_id"], pdf["sig"], pdf["body"], pdf["starts"]):
                    ws, starts = body.split(" "), list(starts)
                    band = size_band(len(ws))
                    for b in (band - 1, band, band + 1) if used is None else (band,):
                        found = [(h64(f"{sig}|{b}|{p}"), *at) for p, *at in (pieces(ws, starts) if used is None else substrings(ws, starts, of(len(ws))))]
                        rows += found
                        ids += [i] * len(found)
                        sizes += [len(ws)] * len(found)
                        counts += [len(starts)] * len(found)
                k, p, s, r = np.array(rows, np.int64).reshape(-1, 4).T
                yield pd.DataFrame({"text_id": np.array(ids, np.int64), "k": k, "n": np.array(sizes, np.int32), "p": p.astype(np.int32), "s": s.astype(np.int32), "r": r.astype(np.int32), "c": np.array(counts, np.int32)})

        d = side.mapInPandas(run, "text_id long, k long, n int, p int, s int, r int, c int")
        return d.select("k", F.col("text_id").alias(which), *[F.col(c).alias(f"{c}{1 if used is None else 2}") for c in ("n", "p", "s", "r", "c")])

    fits = F.abs(F.col("n1") - F.col("n2")) <= F.greatest("n1", "n2") / F.lit(PER_EDIT)
    ahead = keys(ev, "e", None).join(keys(tr, "t", used_by(ev)), "k").filter(fits & allowed())
    back = keys(tr, "t", None).join(keys(ev, "e", used_by(tr)), "k").filter(fits & allowed())
    pairs = ahead.select("e", "t").union(back.select("e", "t")).distinct()
    both = pairs.join(ev.select(F.col("text_id").alias("e"), F.col("body").alias("eb"), F.col("starts").alias("es")), "e").join(tr.select(F.col("text_id").alias("t"), F.col("body").alias("tb"), F.col("starts").alias("ts")), "t")

    def verify(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            ok = [same_question(x.split(" "), list(xs), y.split(" "), list(ys)) for x, xs, y, ys in zip(pdf["eb"], pdf["es"], pdf["tb"], pdf["ts"])]
            yield pdf.loc[ok, ["e", "t"]]

    same = cut(both.mapInPandas(verify, "e long, t long").distinct(), "p5same")
    members = feats.groupBy("is_eval", "id", "text_id").agg(F.min(F.struct("split", "task", "source")).alias("x"))
    return same, members.select("text_id", "is_eval", "id", "x.*")


def cross_split_overlaps(df: DataFrame, train: str = "rl_train", evals: tuple[str, ...] = ("rl_val", "main_test")) -> DataFrame:
    """`train_id`, `eval_id`, and splits, tasks and sources of both: each evaluation record whose question (the last user
    message) stands in training, exactly or nearly, with every such training record. This multiplies copies out;
    overlap_classes does not, see there for the method and what counts as near."""
    same, members = overlap_classes(df, train, evals)
    side = lambda p, is_eval: members.filter(F.col("is_eval") == is_eval).select(F.col("text_id").alias(p[0]), *[F.col(c).alias(f"{p}_{c}") for c in ("id", "split", "task", "source")])
    return same.join(side("eval", True), "e").join(side("train", False), "t").drop("e", "t").distinct()


def overlap_report(df: DataFrame, label) -> DataFrame:
    """Overlapping evaluation records and pairs per split, task and source of both sides, from the classes: nothing is
    multiplied out. label: the source column to the name it is reported under."""
    same, members = overlap_classes(df)
    side = lambda p, is_eval: members.filter(F.col("is_eval") == is_eval).groupBy(F.col("text_id").alias(p[0]), *[F.col(c).alias(f"{p}_{c}") for c in ("split", "task")], label(F.col("source")).alias(f"{p}_source")).agg(F.count("*").alias(f"n_{p}"))
    both = same.join(side("eval", True), "e").join(side("train", False).drop("train_split"), "t")
    per = both.groupBy("e", "eval_split", "eval_task", "eval_source", "train_task", "train_source").agg(F.max("n_eval").alias("records"), F.sum(F.col("n_eval") * F.col("n_train")).alias("pairs"))
    return per.groupBy("eval_split", "eval_task", "eval_source", "train_task", "train_source").agg(F.sum("records").alias("records"), F.sum("pairs").alias("pairs"))
