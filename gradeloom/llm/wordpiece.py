"""Longest-match subword counts in linear time."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gradeloom.functions.labels import label_key, language_code

_CJK = "㐀-䶿一-鿿豈-﫿"
_SPLIT = re.compile(r"[^\W_]+|[^\w\s]|_")
_WORDS_CJK = re.compile(f"[{_CJK}]|[^\\W_{_CJK}]+|[^\\w\\s]|_")


class LongestMatch:
    """Greedy longest-match-first subword counter: a trie over all pieces with failure links; each node knows how many
    pieces are emitted when a match cannot go on there, so a word is counted in one pass without looking back."""

    def __init__(self, pieces: Iterable[str], unknown: str = "[UNK]", mark: str = "##", longest_word: int = 100):
        """longest_word: words of more characters count as one unknown piece, as published tokenizers do."""
        words = [p for p in pieces if p and p != unknown]
        self.longest_word = longest_word
        self.child: list[dict[str, int]] = [{}, {}]  # 0: start of a word, 1: after the continuation mark
        self.is_piece = [False, False]
        parent, depth = [(-1, ""), (-1, "")], [0, 0]
        for w in words:
            at, body = (1, w[len(mark):]) if w.startswith(mark) and len(w) > len(mark) else (0, w)
            for ch in body:
                nxt = self.child[at].get(ch)
                if nxt is None:
                    nxt = len(self.child)
                    self.child[at][ch] = nxt
                    self.child.append({})
                    self.is_piece.append(False)
                    parent.append((at, ch))
                    depth.append(depth[at] + 1)
                at = nxt
            self.is_piece[at] = True
        n = len(self.child)
        self.fail, self.emit = [-1] * n, [0] * n
        for v in sorted(range(2, n), key=depth.__getitem__):
            if self.is_piece[v]:
                self.fail[v], self.emit[v] = 1, 1
                continue
            u, ch = parent[v]
            z, got = self.fail[u], self.emit[u]
            while z != -1 and ch not in self.child[z]:
                got += self.emit[z]
                z = self.fail[z]
            if z != -1:
                self.fail[v], self.emit[v] = self.child[z][ch], got
        self._memo: dict[str, int] = {}

    def count(self, word: str) -> int:
        """Pieces of one word; 1 if it can't be split into pieces."""
        if len(word) > self.longest_word:
            return 1
        at, got = 0, 0
        for ch in word:
            nxt = self.child[at].get(ch)
            while nxt is None:
                if self.fail[at] == -1:
                    return 1
                got += self.emit[at]
                at = self.fail[at]
                nxt = self.child[at].get(ch)
            at = nxt
        while at != 1:
            if self.fail[at] == -1:
                return 1
            got += self.emit[at]
            at = self.fail[at]
        return got

    def count_text(self, text: str | None) -> int:
        """Pieces of a text: lower case, split at blanks, punctuation and ideographs; control and format characters fall away."""
        if not text:
            return 0
        text = text.lower()
        if text.isascii():
            words = _SPLIT.findall(text)
        else:
            text = unicodedata.normalize("NFC", text)
            words = []
            for w in _WORDS_CJK.findall(text):
                if len(w) == 1 and not w.isalnum() and unicodedata.category(w) in ("Cc", "Cf"):
                    continue
                words.append(w)
        memo, got = self._memo, 0
        for w in words:
            n = memo.get(w)
            if n is None:
                if len(memo) >= 500_000:  # bounds a worker's memory only; counts do not depend on it
                    memo.clear()
                n = memo[w] = self.count(w)
            got += n
        return got


def with_token_counts(df: DataFrame, keys: list[str], text: str, pieces: list[str], many: bool = False) -> DataFrame:
    """keys of df and `tokens`, the exact count over the whole text (or over all strings of an array if many). Null
    texts hold 0 tokens. Nothing is shuffled: one pass over Arrow batches, one automaton per task."""
    schema = df.select(*keys).schema.add("tokens", "long")
    sent = pieces if hasattr(pieces, "value") else df.sparkSession.sparkContext.broadcast(pieces)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counter = LongestMatch(sent.value)
        for pdf in batches:
            if many:
                got = [0 if x is None else sum(counter.count_text(t) for t in x) for x in pdf["_text"]]
            else:
                got = [counter.count_text(t) for t in pdf["_text"]]
            out = pdf[keys].copy()
            out["tokens"] = got
            yield out

    return df.select(*keys, F.col(text).alias("_text") if isinstance(text, str) else text.alias("_text")).mapInPandas(run, schema)


def repository(source: Column) -> Column:
    """The repository of a source that is a JSON object with `repo`, or the bare name itself."""
    name = F.trim(source)
    return F.when(name.startswith("{"), F.get_json_object(name, "$.repo")).otherwise(name)


def token_budget(splits: DataFrame, documents: DataFrame, pieces: DataFrame, max_pieces: int = 1_000_000) -> DataFrame:
    """Tokens by table, source, language, domain and task: `rows`, `tokens`, `mean_tokens`. Method: trie with failure
    links and precomputed emissions. The vocabulary (at most max_pieces rows, else an error) goes to the workers.

    splits count by repository, language code, domain and task over all message contents of an id, documents by source,
    language code and domain. Repeated deliveries of an id count once. Labels that differ only in case, blanks, hyphens
    or underscores are one group; null labels are 'unknown', documents have the task ''. Null texts count as rows of 0
    tokens, rows without id are left out, empty tables give no groups."""
    vocabulary = [r.piece for r in pieces.select("piece").limit(max_pieces + 1).collect() if r.piece]
    if len(vocabulary) > max_pieces:
        raise ValueError(f"more than {max_pieces} pieces")
    vocabulary = splits.sparkSession.sparkContext.broadcast(vocabulary)  # once for both tables
    unknown = lambda c: F.coalesce(c, F.lit("unknown"))
    s = splits.filter("id is not null").select("id", repository(F.col("source")).alias("source"), "language", "domain", "task", F.expr("transform(messages, m -> m.content)").alias("_c"))
    s = with_token_counts(s, ["id", "source", "language", "domain", "task"], "_c", vocabulary, many=True)
    s = s.groupBy(F.xxhash64("id").alias("h"), "id").agg(F.max(F.struct("tokens", "source", "language", "domain", "task")).alias("x")).select(
        F.lit("splits").alias("table"), unknown(F.lower(F.trim(F.col("x.source")))).alias("source"), language_code(F.col("x.language")).alias("language"), unknown(label_key(F.col("x.domain"))).alias("domain"), unknown(label_key(F.col("x.task"))).alias("task"), F.col("x.tokens").alias("tokens"))
    d = with_token_counts(documents.filter("doc_id is not null").select("doc_id", "source", "lang", "domain", "text"), ["doc_id", "source", "lang", "domain"], "text", vocabulary)
    d = d.groupBy("doc_id").agg(F.max(F.struct("tokens", "source", "lang", "domain")).alias("x")).select(
        F.lit("documents").alias("table"), unknown(label_key(F.col("x.source"))).alias("source"), language_code(F.col("x.lang")).alias("language"), unknown(label_key(F.col("x.domain"))).alias("domain"), F.lit("").alias("task"), F.col("x.tokens").alias("tokens"))
    return s.unionByName(d).groupBy("table", "source", "language", "domain", "task").agg(F.count("*").alias("rows"), F.sum("tokens").alias("tokens"), F.avg("tokens").alias("mean_tokens"))
