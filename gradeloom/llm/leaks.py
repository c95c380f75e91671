"""Passages of evaluation items inside documents: a positional inverted index over the corpus and its phrase search."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gradeloom.llm.words import plain_words, undress, words
from gradeloom.session import cut, small

#: Words that a stretch must have (or the whole question, if it is shorter), and words per allowed edit.
STRETCH, PER_EDIT = 20, 10
#: Words of a term, i.e. of an entry of the index.
TERM = 5
#: Terms that are intact in some STRETCH-word window of any qualifying stretch, edits in it at most, and terms that must agree.
#: Two edits spoil 10 of the 16 terms of a window. Only stretches of 30 to 39 words can have three edits in every window; these
#: then lie within 10 words, so the first window starts with 10 words without any, and 6 terms.
INTACT, WORST, AGREE = 6, 3, 2
#: Bits of the table by which documents leave out terms that no item has. Its size is fixed; more items only make it denser.
BITS = 1 << 24
#: A closing sentence is a standing instruction when it ends one item in so many, and at least FEWEST items.
ONE_IN, FEWEST = 200, 3
#: Offsets are counted in cells of this width, two neighbouring ones together: edits shift them by less than that.
CELL = 4
#: Candidates of one document that are verified in one row.
TOGETHER = 500
_SENTENCE = re.compile(r"(?<=[.?!。？！])\s+|\n+")


def terms(ws: list[str], memo: dict[str, int], n: int = TERM) -> np.ndarray:
    """Hash of each run of n words, by position; memo holds hashes of words."""
    code = np.empty(len(ws), np.uint64)
    for i, w in enumerate(ws):
        h = memo.get(w)
        if h is None:
            if len(memo) > 500_000:  # bounds a worker's memory only
                memo.clear()
            h = memo[w] = xxhash.xxh64_intdigest(w)
        code[i] = h
    if len(code) < n:
        return np.zeros(0, np.int64)
    with np.errstate(over="ignore"):
        out = code[: len(code) - n + 1].copy()
        for k in range(1, n):
            out = out * np.uint64(0x9E3779B97F4A7C15) + code[k : len(code) - n + 1 + k]
        out ^= out >> np.uint64(29)
    return out.view(np.int64)


def questions(pool: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(item_id, q) and (q, body): the distinct questions as words without a standing closing instruction. A closing
    sentence is one if it ends at least one question in ONE_IN (so there are at most ONE_IN of them) and FEWEST."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for i, text in zip(pdf["item_id"], pdf["question"]):
                plain = undress(text)
                parts = [p for p in _SENTENCE.split(plain.strip()) if p.strip()]
                rows.append((i, " ".join(words(plain)), " ".join(words(parts[-1])) if len(parts) > 1 else ""))
            yield pd.DataFrame(rows, columns=["item_id", "body", "last"])

    rows = pool.filter("item_id is not null and question is not null").select("item_id", "question").distinct()
    rows = cut(rows.mapInPandas(run, "item_id long, body string, last string"), "p8questions")
    least = max(FEWEST, -(-rows.count() // ONE_IN))
    ends = rows.filter("last <> '' and last <> body").groupBy("last").agg(F.countDistinct("body").alias("n")).filter(F.col("n") >= least).select("last", F.lit(True).alias("standing"))
    short = F.when(F.col("standing"), F.expr("left(body, length(body) - length(last) - 1)")).otherwise(F.col("body"))
    rows = rows.join(F.broadcast(ends), "last", "left").select("item_id", short.alias("body")).filter("body <> ''")  # ends: at most ONE_IN rows
    rows = cut(rows.select("item_id", "body", F.xxhash64("body").alias("q")), "p8items")
    return rows.select("item_id", "q").distinct(), rows.select("q", "body").dropDuplicates(["q"])


def question_terms(asked: DataFrame) -> DataFrame:
    """q, m (words), off, term: all terms of each question; one of fewer words than a term is a term itself."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        memo: dict[str, int] = {}
        for pdf in batches:
            q, m, off, term = [], [], [], []
            for i, body in zip(pdf["q"], pdf["body"]):
                ws = body.split(" ")
                t = terms(ws, memo, min(TERM, len(ws)))
                q.append(np.full(len(t), i))
                m.append(np.full(len(t), len(ws)))
                off.append(np.arange(len(t)))
                term.append(t)
            yield pd.DataFrame({"q": np.concatenate(q), "m": np.concatenate(m), "off": np.concatenate(off), "term": np.concatenate(term)}) if q else pd.DataFrame({"q": [], "m": [], "off": [], "term": []})

    return asked.mapInPandas(run, "q long, m int, off int, term long")


def postings(documents: DataFrame, asked_terms: DataFrame) -> DataFrame:
    """doc_id, pos, term: the positional index of the documents, written once as a table. It holds the terms that some
    question has, and few others: a table of BITS bits goes to the tasks, whatever the number of questions."""
    cell = F.pmod("term", F.lit(BITS))
    parts = asked_terms.select(cell.alias("c")).groupBy((F.col("c") / F.lit(64)).cast("int").alias("at")).agg(F.bit_or(F.expr("shiftleft(1L, cast(c % 64 as int))")).alias("bits")).collect()  # at most BITS / 64 rows
    table = np.zeros(BITS // 64, np.uint64)
    for r in parts:
        table[r.at] = np.int64(r.bits).view(np.uint64)
    sizes = {TERM, *(r.n for r in asked_terms.filter(F.col("m") < TERM).select(F.col("m").alias("n")).distinct().collect())}
    spark = documents.sparkSession
    sent = spark.sparkContext.broadcast((np.unpackbits(table.view(np.uint8), bitorder="little"), sorted(sizes)))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known, lengths = sent.value
        memo: dict[str, int] = {}
        for pdf in batches:
            ids, at, found = [], [], []
            for i, text in zip(pdf["doc_id"], pdf["text"]):
                ws = plain_words(text)
                for n in lengths:
                    t = terms(ws, memo, n)
                    hit = np.flatnonzero(known[t & (BITS - 1)])
                    if len(hit):
                        ids.append(np.full(len(hit), i))
                        at.append(hit)
                        found.append(t[hit])
            if ids:
                yield pd.DataFrame({"doc_id": np.concatenate(ids), "pos": np.concatenate(at), "term": np.concatenate(found)})

    rows = documents.filter("doc_id is not null and text is not null").select("doc_id", "text")
    return cut(rows.mapInPandas(run, "doc_id long, pos int, term long"), "p8postings")


def rarest(frequency: np.ndarray, m: int) -> np.ndarray:
    """Which terms of a question of m words are looked up, by their frequencies in the corpus. Of the terms of a window of any
    qualifying stretch INTACT are intact, so AGREE of any that leave out INTACT - AGREE of the window: the rarest so many of every
    window are enough. A shorter question is one window, of which each edit spoils TERM terms at most."""
    f = frequency + np.arange(len(frequency)) * 1e-9
    keep = np.zeros(len(f), bool)
    if m < STRETCH:
        n = min(len(f), TERM * (m // PER_EDIT) + AGREE)
        keep[np.argpartition(f, n - 1)[:n]] = True
        return keep
    width = STRETCH - TERM + 1
    n = width - INTACT + AGREE
    limit = np.partition(np.lib.stride_tricks.sliding_window_view(f, width), n - 1, axis=1)[:, n - 1]
    ceiling = np.full(len(f), -1.0)  # a term is kept if it is among the n rarest of some window that holds it
    for k in range(width):
        np.maximum(ceiling[k : k + len(limit)], limit, out=ceiling[k : k + len(limit)])
    return f <= ceiling


def looked_up(asked_terms: DataFrame, index: DataFrame) -> DataFrame:
    """q, m, off, term of the rarest terms of each question that occur at all, by the counts of the whole index."""
    counts = index.groupBy("term").agg(F.count("*").alias("n"))
    per = asked_terms.join(counts, "term", "left").groupBy("q", "m").agg(F.sort_array(F.collect_list(F.struct("off", "term", F.coalesce("n", F.lit(0)).alias("n")))).alias("t"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for q, m, t in zip(pdf["q"], pdf["m"], pdf["t"]):
                n = np.array([x["n"] for x in t], float)
                rows += [(q, m, t[k]["off"], t[k]["term"]) for k in np.flatnonzero(rarest(n, m) & (n > 0))]
            yield pd.DataFrame(rows, columns=["q", "m", "off", "term"])

    return cut(per.mapInPandas(run, "q long, m int, off int, term long"), "p8terms")


def needed(m: Column) -> Column:
    """How many of the looked-up terms of a question of m words are intact wherever it stands."""
    few = F.greatest(m - TERM + 1, F.lit(1)) - F.floor(m / F.lit(PER_EDIT)) * TERM
    return F.when(m >= STRETCH, F.lit(AGREE)).otherwise(F.least(F.lit(AGREE), few))


def agreeing(index: DataFrame, wanted: DataFrame) -> DataFrame:
    """doc_id, q, lows: where (offsets from low to low + 2 CELL) enough of the looked-up terms of a question stand in a document.
    Lists are intersected by their offsets: pos - off differs by WORST at most within a window, so two neighbouring cells hold it
    all. A group holds what one document has of one question."""
    hits = index.join(small(wanted), "term").select("doc_id", "q", "m", F.struct(F.floor((F.col("pos") - F.col("off")) / F.lit(CELL)).cast("int").alias("c"), "off").alias("h"))
    per = hits.groupBy("doc_id", "q", "m").agg(F.collect_list("h").alias("h")).filter(F.size("h") >= needed(F.col("m")))
    cells = F.array_distinct(F.transform("h", lambda x: x.c))
    offs = lambda c: F.array_distinct(F.transform(F.filter("h", lambda x: (x.c == c) | (x.c == c + 1)), lambda x: x.off))
    enough = per.withColumn("cells", F.array_union(cells, F.transform(cells, lambda c: c - 1))).withColumn("need", needed(F.col("m")))
    return enough.select("doc_id", "q", F.transform(F.filter("cells", lambda c: F.size(offs(c)) >= F.col("need")), lambda c: c * CELL).alias("lows")).filter("size(lows) > 0")


def _reach(a: np.ndarray, b: np.ndarray, edits: int) -> list[int]:
    """reach[e]: most words of a that can be consumed from the left with e edits against a prefix of b."""
    n, m = len(a), len(b)
    out, front = [], {}
    for e in range(edits + 1):
        new = {}
        for d in range(-e, e + 1):
            best = 0 if e == 0 else -1
            if d in front:
                best = max(best, front[d] + 1)  # replaced
            if d + 1 in front:
                best = max(best, front[d + 1] + 1)  # dropped from the document
            if d - 1 in front:
                best = max(best, front[d - 1])  # inserted into the document
            best = min(best, n)
            j = best + d
            if best < 0 or j < 0 or j > m:
                continue
            while best < n and j < m and a[best] == b[j]:
                best += 1
                j += 1
            new[d] = best
        out.append(max([*new.values(), out[-1] if out else 0]))
        front = new
        if out[-1] >= n:
            out += [n] * (edits - e)
            break
    return out


def _stretch(q: np.ndarray, t: np.ndarray, i: int, j: int, n: int) -> bool:
    """Whether a stretch of q around the n equal words q[i:i+n] and t[j:j+n] qualifies."""
    m = len(q)
    most, least = m // PER_EDIT, min(m, STRETCH)
    right, left = _reach(q[i + n :], t[j + n :], most), _reach(q[:i][::-1], t[:j][::-1], most)
    return any(n + r + x >= max(least, PER_EDIT * (a + b)) for a, r in enumerate(right) for b, x in enumerate(left) if a + b <= most)


def holds(q: np.ndarray, t: np.ndarray, low: int) -> bool:
    """Whether the words t hold a qualifying stretch of the question q around an offset in the cells from low on. Windows in
    which too few terms are intact at these offsets are out; in the others each run of equal words is tried, and its ends
    are found by edit distance."""
    m, n = len(q), min(TERM, len(q))
    at = np.arange(m) + np.arange(low, low + 2 * CELL)[:, None]
    same = (t[np.clip(at, 0, len(t) - 1)] == q) & (at >= 0) & (at < len(t))
    term = same[:, : m - n + 1].copy()
    for k in range(1, n):
        term &= same[:, k : m - n + 1 + k]
    intact = np.concatenate([[0], np.cumsum(term.any(axis=0))])
    width = min(m, STRETCH) - n + 1
    fine = np.flatnonzero(intact[width:] - intact[:-width] >= (INTACT if m >= STRETCH else max(1, width - n * (m // PER_EDIT))))
    if not len(fine):
        return False
    slack = m // PER_EDIT + 1
    for d in np.flatnonzero(term.any(axis=1)):
        edge = np.flatnonzero(np.diff(np.concatenate([[0], same[d].view(np.int8), [0]])))
        start = max(0, low + int(d) - slack)
        for s, e in zip(edge[::2], edge[1::2]):
            if e - s >= n and s < fine[-1] + STRETCH and e > fine[0] and _stretch(q, t[start : low + d + m + slack], s, s + low + d - start, e - s):
                return True
    return False


def leaked_items(documents: DataFrame, pool: DataFrame) -> DataFrame:
    """`doc_id`, `item_id`: documents that hold a stretch of at least 20 words of an item's question (or all of it) with
    at most one word in ten replaced, dropped or inserted; case, punctuation, accents, character forms, markup, escapes,
    invisible characters, line breaks and hyphenation do not count. Standing answer instructions (closing sentences of one
    item in ONE_IN) are no part of a question.

    Method: distributed positional inverted index. Postings of five-word terms of the corpus are stored as a table; counts
    over the whole corpus tell the rarest terms of each question; their lists are joined by term and intersected by offset;
    documents with enough terms at one place are read again and verified by edit distance in words. The terms looked up
    leave out no qualifying stretch (see `rarest`). No item, posting or document is collected; broadcast are a bit table of
    fixed size and, only if counted to be small, the terms that are looked up.

    Null texts, ids or questions match nothing, as do questions without words; repeated rows count once; a question of one or
    two words is looked up as such; empty tables give no rows."""
    items, asked = questions(pool)
    every = cut(question_terms(asked), "p8all")
    index = postings(documents, every)
    bands = agreeing(index, looked_up(every, index))
    part = F.floor(F.row_number().over(Window.partitionBy("doc_id").orderBy("q")) / F.lit(TOGETHER))
    found = bands.join(small(asked), "q").withColumn("part", part).groupBy("doc_id", "part").agg(F.collect_list(F.struct("q", "body", "lows")).alias("c"))
    found = cut(found, "p8found")
    texts = documents.filter("doc_id is not null and text is not null").select("doc_id", "text").join(small(found.select("doc_id").distinct()), "doc_id", "left_semi")

    def verify(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for i, text, c in zip(pdf["doc_id"], pdf["text"], pdf["c"]):
                code: dict[str, int] = {}
                t = np.array([code.setdefault(w, len(code)) for w in plain_words(text)], np.int64)
                for x in c:
                    q = np.array([code.get(w, -1) for w in x["body"].split(" ")], np.int64)
                    if any(holds(q, t, int(low)) for low in x["lows"]):
                        rows.append((i, x["q"]))
            yield pd.DataFrame(rows, columns=["doc_id", "q"]).astype("int64")

    same = texts.join(found, "doc_id").mapInPandas(verify, "doc_id long, q long").distinct()
    return same.join(small(items), "q").select("doc_id", "item_id").distinct()
