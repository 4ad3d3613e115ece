"""Exact token counts of texts and of all their prefixes.

Method: prefix dynamic programming. For every prefix of a word (in bytes) the table
holds the last token of the prefix's encoding and the number of its tokens. A token that
ends at a prefix is the last one there exactly if its neighbour, the last token of the
prefix in front of it, may stand before it: byte-pair merging of the two side by side
would not join anything across their border. One token per prefix passes that test, so
the table is filled left to right without any merging of the text. A document's count
at a prefix is the sum over the words before it plus the table's entry for the started
word, so truncation and budget questions are answered by look-up. The tables of all distinct
words of an Arrow batch are filled together.

Spark deals out the rows; the vocabulary (a few MB) is broadcast; nothing is shuffled.

Cases: null text counts as empty (no tokens); special strings inside a text count as
one token, as in the library's default; repeated rows give repeated results; an empty
table gives an empty table; columns named like a result column are replaced. A budget
of 0 or less keeps nothing.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from faceoff.llm.common import small_arrow_batches, text_of, without
from faceoff.llm.vocab import LETTERS, LONG_WORD, IntMap, Vocabulary, broadcast_vocabulary, distinct, in_worker, spread, string_bytes


class PrefixTable:
    """Counts of tokens at prefixes for a byte-level vocabulary that keeps white space."""

    #: Fixed value: how the vocabulary's file cuts text into words (here for usual characters).
    WORDS = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{LETTERS}]+| ?[0-9]+| ?[^\s{LETTERS}0-9]+|\s+(?!\S)|\s+")

    def __init__(self, spec: str):
        self.vocab = v = Vocabulary(spec)
        named = [(i, bytes(v.byte_of[c] for c in name)) for i, name in enumerate(v.names) if name and name not in v.added]
        #: a tree of the tokens' bytes: (node, byte) -> node, and the token that ends at a node
        child: dict[int, int] = {}
        token = [-1]
        for i, raw in named:
            if v.merge_one(raw) != [i]:
                continue  # merging never leaves this token
            node = 0
            for b in raw:
                key = node << 8 | b
                if key not in child:
                    child[key] = len(token)
                    token.append(-1)
                node = child[key]
            token[node] = i
        self.child = IntMap(list(child), list(child.values()))
        self.token = np.array(token, np.int64)
        #: id of a token -> rank of the merge that makes it (a byte has none)
        self.made: dict[int, int] = {}
        for packed in v.pairs.values():
            self.made.setdefault(packed & int(v.mask), packed >> int(v.bits))
        self.edges: dict[tuple[int, int], list[tuple[int, float]]] = {}
        #: (token, token) -> 1 if the second may follow the first, else 0
        self.follows = IntMap()

    def _edge(self, token: int, side: int) -> list[tuple[int, float]]:
        """Parts that ever lie at one edge of a token while it is merged (side 0: the left
        edge), with the rank of the merge that uses each up."""
        out = self.edges.get((token, side))
        if out is None:
            part, used = token, float("inf")
            out = self.edges[token, side] = [(part, used)]
            while (cut := self.vocab.split.get(part)) is not None:
                used, part = self.made[part], cut[side]
                out.append((part, used))
        return out

    def may_follow(self, a: int, b: int) -> bool:
        """True if merging the bytes of ``a`` and ``b`` together leaves just ``a`` and ``b``.

        Merges run in the order of their ranks. A part at the right edge of ``a`` and one
        at the left edge of ``b`` join if their merge comes before both are used up; of
        equal merges the left one is first."""
        bits, get = int(self.vocab.bits), self.vocab.pairs.get
        left = self._edge(b, 0)
        for x, x_used in self._edge(a, 1):
            for y, y_used in left:
                joint = get(x << bits | y)
                if joint is not None and (joint >> bits) < x_used and (joint >> bits) <= y_used:
                    return False
        return True

    def _follows(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        key = a << self.vocab.bits | b
        got = self.follows.get(key)
        new = np.unique(key[got < 0])
        if len(new):
            mask, bits = int(self.vocab.mask), int(self.vocab.bits)
            self.follows.put(new, np.array([self.may_follow(k >> bits, k & mask) for k in new.tolist()], np.int64))
            got = self.follows.get(key)
        return got == 1

    def tables(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """For distinct words the number of tokens at each of their prefixes: all tables one
        after the other (a word of n bytes has n + 1 items), and where each begins."""
        raw, at = string_bytes(words)
        length = np.diff(at)
        starts = np.concatenate([[0], np.cumsum(length + 1)])
        out = np.zeros(starts[-1], np.int32)
        low = 0
        for high in (4, 8, 12, 16, 24, 32, 64, LONG_WORD, max(LONG_WORD, int(length.max(initial=0)))):
            rows = np.flatnonzero((length > low) & (length <= high))
            low = high
            rows = rows[np.argsort(-length[rows], kind="stable")]
            step = max(1, (1 << 21) // (high + 1))
            for k in range(0, len(rows), step):
                part = rows[k : k + step]
                count = self._fill(raw, at[part], length[part])
                sizes = length[part] + 1
                out[spread(starts[part], sizes)] = count[np.arange(count.shape[1]) < sizes[:, None]]
        return out, starts

    def _fill(self, raw: np.ndarray, begin: np.ndarray, length: np.ndarray) -> np.ndarray:
        """The tables of words (longest first), one word a row: from every prefix on, every
        token that starts there is tried as the last token of a longer prefix."""
        n, width = len(length), int(length[0])
        count = np.zeros((n, width + 1), np.int32)
        last = np.zeros((n, width + 1), np.int64)
        for i in range(width):
            row = np.arange(np.searchsorted(-length, -i, "left"))
            node = np.zeros(len(row), np.int64)
            for j in range(i, width):
                longer = length[row] > j
                row, node = row[longer], node[longer]
                node = self.child.get(node << 8 | raw[begin[row] + j].astype(np.int64))
                row, node = row[node >= 0], node[node >= 0]
                if not len(row):
                    break
                token = self.token[node]
                open_ = (token >= 0) & (count[row, j + 1] == 0)
                r, t = row[open_], token[open_]
                if i:
                    fit = self._follows(last[r, i], t)
                    r, t = r[fit], t[fit]
                last[r, j + 1] = t
                count[r, j + 1] = count[r, i] + 1
        return count

    def count(self, texts: list[str | None]) -> np.ndarray:
        """Tokens of whole texts: the sum of the tables' last entries of their words."""
        out = np.zeros(len(texts), np.int64)
        for words, docs, counts in self.vocab.batches(texts, self.WORDS, lower=False):
            if not words:
                continue
            known, code = distinct(words)
            table, starts = self.tables(known)
            whole = table[starts[1:] - 1]
            for s in self.vocab.added:
                if (i := known.index(pa.scalar(s, known.type)).as_py()) >= 0:
                    whole[i] = 1
            ends = np.concatenate([[0], np.cumsum(whole[code], dtype=np.int64)])[np.concatenate([[0], np.cumsum(counts)])]
            np.add.at(out, docs, np.diff(ends))
        return out

    def prefixes(self, text: str | None) -> list[int]:
        """The number of tokens of every prefix of a text, by code points: item k is the
        count of ``text[:k]`` by itself."""
        text = text or ""
        words = self.vocab.words(text, self.WORDS, lower=False)
        if not words:
            return [0]
        spaces = [a + b for a, b in zip(words, words[1:]) if a.isspace() and (b.isspace() or b[0] == " ")]
        known, _ = distinct([*words, *spaces, "'"])
        flat, starts = self.tables(known)
        tables = {w: flat[starts[k] : starts[k + 1]] for k, w in enumerate(known.to_pylist())}
        out, base, before = [0], 0, ""
        for w in words:
            if w in self.vocab.added:  # a started special string is ordinary text
                done = text[: len(out) - 1]
                out += self.count([done + w[:k] for k in range(1, len(w))]).tolist()
                base += 1
                out.append(base)
                before = ""
                continue
            at = np.cumsum([len(c.encode("utf-8")) for c in w])
            here = (base + tables[w][at]).tolist()
            if before.isspace() and (w.isspace() or w[0] == " "):
                # a prefix that ends in white space ends in one run of it
                run, start = tables[before + w], base - int(tables[before][-1])
                skip, blanks = len(before.encode("utf-8")), len(w) if w.isspace() else 1
                here[:blanks] = (start + run[skip + at[:blanks]]).tolist()
            elif w in ("'re", "'ve", "'ll"):
                here[1] = base + int(tables["'"][-1]) + 1
            out += here
            base += int(tables[w][-1])
            before = w
        return out


def _udf(spark: SparkSession, vocabulary: str, kind: str, make):
    spec = broadcast_vocabulary(spark, vocabulary)
    small_arrow_batches(spark)

    @F.arrow_udf(kind)
    def by_prefix_table(text: pa.Array) -> pa.Array:
        return make(in_worker(PrefixTable, spec), text.to_pylist())

    return by_prefix_table


def count_tokens(docs: DataFrame, vocabulary: str, limit: int, text: str = "text") -> DataFrame:
    """``docs`` with ``n_bytes``, ``n_tokens`` (long) and ``over_limit`` (boolean)."""
    spark = docs.sparkSession
    docs = without(docs, "n_bytes", "n_tokens", "over_limit")
    count = _udf(spark, vocabulary, "long", lambda t, texts: pa.array(t.count(texts), pa.int64()))
    out = (docs.withColumn("n_bytes", F.octet_length(text_of(docs, text)).cast("long"))
           .withColumn("n_tokens", count(text_of(docs, text))))
    return out.withColumn("over_limit", F.col("n_tokens") > F.lit(limit))


def prefix_counts(docs: DataFrame, vocabulary: str, text: str = "text") -> DataFrame:
    """``docs`` with ``prefix_tokens`` (array of int): item k is the number of tokens of the first k code points."""
    spark = docs.sparkSession
    docs = without(docs, "prefix_tokens")
    table = _udf(spark, vocabulary, "array<int>",
                 lambda t, texts: pa.array([t.prefixes(s) for s in texts], pa.list_(pa.int32())))
    return docs.withColumn("prefix_tokens", table(text_of(docs, text)))


def truncate(with_prefixes: DataFrame, budget: int, text: str = "text") -> DataFrame:
    """The output of ``prefix_counts`` with ``fit_chars`` and ``fit_text``: the longest
    prefix of at most ``budget`` tokens, read from the table without encoding again."""
    df = without(with_prefixes, "fit_chars", "fit_text")
    fits = F.transform(df["prefix_tokens"], lambda c, i: F.when(c <= budget, i).otherwise(0))
    df = df.withColumn("fit_chars", F.array_max(fits))
    return df.withColumn("fit_text", F.substring(text_of(df, text), F.lit(1), F.col("fit_chars")))
