"""Removal of repeated passages by suffix arrays.

Every byte of a text (in UTF-8) goes that is covered by a string of ``WIDTH`` bytes which
also starts anywhere else, in the same document or another. Matches never cross
documents and are judged on the input. Method:

1. Strings of equal content are brought together. Every position of a text has the hash of
   its next ``GRAM`` bytes; the least hash inside a string of WIDTH bytes (of equal ones
   the last) is its *anchor*, which depends on the string's content alone. The
   consecutive strings of one anchor form a *slice*, so a text is a sequence of slices,
   two to every WIDTH bytes or so. Strings can only be equal if their anchors are.
2. Slices are counted by anchor and content, before they are shuffled. An anchor that
   occurs once ends here, without its bytes ever being moved. Slices with equal content
   repeat each other as a whole.
3. What is left are different slices of one anchor, which may overlap in part: the ends of
   repeated passages. The strings of a slice are told apart by where the anchor lies in
   them, in ``CELLS`` cells of neighbouring starts. All strings of a cell contain the same window, nearly as
   long as they are, so they can only be equal to strings of a cell with an equal window. A cell without such a
   partner ends here; of the others only the symbols before and after the window are kept, and one name stands for
   the window. Cells are dealt into shards by the window, and each shard's
   suffix array is built by induced sorting: suffixes are classified, the substrings
   between leftmost smaller ones are sorted, recursively where they are equal, and the
   array is induced from them. Permuted common prefixes of a string's length are repeats.
   A window with over ``CROWD`` cells (a passage in very many contexts) is too much for one shard: its cells
   are halved, which adds symbols to the window and parts the crowd, until every part fits.
4. The repeated starts of a document are gathered as ranges and cut out of its text.

Documents are known by id and a hash of their text; the text travels twice, to cut
cells and to cut the repeats. Intermediate tables are written to the shared folder and deleted
when their last reader is done.

With ``words`` set, passages of that many words go as well, however short the words are:
the same method runs over the words of a text, each one symbol, its hash, instead of its
bytes. Words lie between ``common.WORD_SEPARATORS``; which ones separate them doesn't matter.

Cases: null text counts as empty; texts shorter than WIDTH bytes stay as they are;
repeated rows repeat each other; the remaining bytes are given as binary, since a cut may
fall inside a character, and as text without the damaged characters; an empty table
gives an empty table; columns named like a result column are replaced.
"""

from __future__ import annotations

from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from faceoff.llm.common import discard, small_arrow_batches, text_of, without, written
from faceoff.llm.neardup import BASE, INVERSE, _mix, _powers
from faceoff.llm.suffixes import repeated_starts

WIDTH, GRAM = 400, 128
#: Cells that the strings of a slice fall into, symbols in a shard (about), and the cells of one window in a shard.
CELLS = 8
SHARD = 1 << 19
CROWD = 2_000
#: Passages as the words of a text: that many words in a gram.
WORD_GRAM = 16

_VALUE = np.random.default_rng(77).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


class _Hashes:
    """Hashes of any stretches of a text, given as bytes or as hashes of words."""

    def __init__(self, raw: np.ndarray):
        self.sum = np.zeros(len(raw) + 1, np.uint64)
        np.cumsum((_VALUE[raw] if raw.dtype == np.uint8 else raw) * _powers(BASE, len(raw)), out=self.sum[1:])
        self.back = _powers(INVERSE, len(raw) + 1)

    def of(self, start: np.ndarray, size) -> np.ndarray:
        return _mix((self.sum[start + size] - self.sum[start]) * self.back[start] + np.uint64(1) * np.asarray(size, np.uint64))


def _least_ahead(h: np.ndarray, w: int) -> np.ndarray:
    """The least of every ``w`` neighbours."""
    m, have = h, 1
    while 2 * have <= w:
        m = np.minimum(m[:-have], m[have:])
        have *= 2
    return np.minimum(m[: len(h) - w + 1], m[w - have : w - have + len(h) - w + 1])


def slices(raw: np.ndarray, width: int, size: int) -> tuple[np.ndarray, ...]:
    """Slices of a text: hash of the anchor (of a gram of ``size``), first start, last start, hash of the content, place of the anchor."""
    n = len(raw) - width + 1
    if n <= 0:
        return tuple(np.zeros(0, t) for t in (np.uint64, np.int64, np.int64, np.uint64, np.int64))
    hashes = _Hashes(raw)
    w = width - size + 1
    gram = hashes.of(np.arange(n + w - 1), size)
    least = _least_ahead(gram, w)
    # a gram is an anchor if it equals the least of some string around it
    reach = np.zeros(n + 2 * (w - 1), np.uint64)
    reach[w - 1 : w - 1 + n] = least
    best = ~_least_ahead(~reach, w)
    cand = np.flatnonzero(gram == best)
    # of each string: the last anchor in it whose gram is the string's least
    order = np.searchsorted(cand, np.arange(n) + w - 1, "right") - 1
    at = cand[order]
    while len(bad := np.flatnonzero(gram[at] != least)):
        order[bad] -= 1
        at[bad] = cand[order[bad]]
    first = np.flatnonzero(np.diff(at, prepend=-1))
    last = np.append(first[1:], n) - 1
    return gram[at[first]], first, last, hashes.of(first, last - first + width), at[first]


def _word_spans(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Byte ranges of the words of a text."""
    apart = (raw == 32) | ((raw >= 9) & (raw <= 13))
    edge = np.flatnonzero(np.diff((~apart).astype(np.int8), prepend=0, append=0))
    return edge[::2], edge[1::2]


def _symbols(text: str, words: bool) -> np.ndarray:
    """The bytes of a text, or the hashes of its words."""
    raw = np.frombuffer(text.encode("utf-8"), np.uint8)
    if not words:
        return raw
    start, end = _word_spans(raw)
    return _Hashes(raw).of(start, end - start)


SLICES = "doc_id long, mark long, anchor long, first int, last int, content long, at int"


def _read(batches, width: int, gram: int, words: bool):
    """Task: texts -> their slices."""
    for batch in batches:
        for lo in range(0, batch.num_rows, 200):
            part = batch.slice(lo, 200)
            got = [slices(_symbols(t, words), width, gram) for t in part.column("text").to_pylist()]
            n = [len(g[0]) for g in got]
            if not sum(n):
                continue
            row = np.repeat(np.arange(len(n)), n)
            col = lambda k, t: np.concatenate([g[k] for g in got]).astype(t)
            yield pa.RecordBatch.from_arrays([
                part.column("doc_id").take(pa.array(row)), part.column("mark").take(pa.array(row)),
                pa.array(np.concatenate([g[0] for g in got]).view(np.int64)), pa.array(col(1, np.int32)), pa.array(col(2, np.int32)),
                pa.array(np.concatenate([g[3] for g in got]).view(np.int64)), pa.array(col(4, np.int32))],
                ["doc_id", "mark", "anchor", "first", "last", "content", "at"])


CUT = "doc_id long, mark long, first int, step int, window long, before binary, after binary"


def cells(raw: np.ndarray, wanted: list[dict], width: int, step: int) -> list[tuple]:
    """Cells (first start, hash of the window, symbols before the window, symbols after it) of slices of a text.

    The strings of cell k begin ``k * step`` to ``(k + 1) * step - 1`` symbols before the anchor, as far as
    the slice has them; their window is what all of these would have in common."""
    hashes = _Hashes(raw)
    first, last, at, anchor = (np.array([w[c] for w in wanted], np.int64) for c in ("first", "last", "at", "anchor"))
    out = []
    for k in range(CELLS):
        begin, end = at - k * step, at - (k + 1) * step + 1 + width
        lo, hi = np.maximum(first, at - (k + 1) * step + 1), np.minimum(last, begin)
        some = np.flatnonzero(lo <= hi)
        if len(some):
            name = _mix(hashes.of(begin[some], width - step + 1) ^ _mix(anchor[some].view(np.uint64) + np.uint64(k))).view(np.int64)
            for i, window in zip(some.tolist(), name.tolist()):
                out.append((int(lo[i]), window, raw[lo[i] : begin[i]].tobytes(), raw[end[i] : hi[i] + width].tobytes()))
    return out


def _cut(batches, width: int, gram: int, words: bool):
    """Task: texts with a list of slices -> the cells of the slices."""
    step = -(-(width - gram + 1) // CELLS)
    for batch in batches:
        for lo in range(0, batch.num_rows, 50):
            part = batch.slice(lo, 50)
            rows = []
            for doc, mark, text, wanted in zip(*(part.column(c).to_pylist() for c in ("doc_id", "mark", "text", "wanted"))):
                rows += [(doc, mark, first, step, *rest) for first, *rest in cells(_symbols(text, words), wanted, width, step)]
            if rows:
                types = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.binary(), pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], ["doc_id", "mark", "first", "step", "window", "before", "after"])


def halved(crowd: DataFrame, words: bool) -> DataFrame:
    """The two halves of cells: strings that begin early share the end of what was before the window, the others the
    beginning of what was after it; these symbols join the window."""
    unit = 8 if words else 1
    step, before, after = F.col("step"), F.octet_length("before") / unit, F.octet_length("after") / unit
    half = F.ceil(step / 2).cast("int")
    more = (step - half) * unit
    size = lambda c: F.octet_length(c)
    left = lambda c, n: F.substring(c, F.lit(1), n.cast("int"))
    rest = lambda c, n: F.substring(c, (n + 1).cast("int"), size(c))
    name = lambda side, added: F.xxhash64("window", F.lit(side), added)
    early = crowd.where(before >= step - half).select(
        "doc_id", "mark", "first", half.alias("step"), name(0, rest("before", size("before") - more)).alias("window"),
        left("before", size("before") - more).alias("before"), left("after", F.least(size("after"), (half - 1) * unit)).alias("after"))
    kept = F.least(size("before"), (step - 1 - half) * unit)
    late = crowd.where(after >= half).select(
        "doc_id", "mark", (F.col("first") + F.greatest(F.lit(0), half - (step - 1 - before))).cast("int").alias("first"), (step - half).alias("step"),
        name(1, left("after", half * unit)).alias("window"), rest("before", size("before") - kept).alias("before"), rest("after", half * unit).alias("after"))
    return early.unionByName(late)


STARTS = "doc_id long, mark long, first int, last int"


def _starts(rows: list[tuple]) -> pa.Table:
    cols = list(zip(*rows)) if rows else [[], [], [], []]
    return pa.table([pa.array(c, t) for c, t in zip(cols, [pa.int64(), pa.int64(), pa.int32(), pa.int32()])], ["doc_id", "mark", "first", "last"])


def _runs(flags: np.ndarray) -> list[tuple[int, int]]:
    edge = np.flatnonzero(np.diff(flags.astype(np.int8), prepend=0, append=0))
    return list(zip(edge[::2].tolist(), (edge[1::2] - 1).tolist()))


def _shard(table: pa.Table, words: bool) -> pa.Table:
    """Task: cells of one step -> ranges of starts that are repeated among them.

    The text of the suffix array has a cell after the other: what is before its window, the window's
    name in digits (symbols of their own), and what is after it."""
    step = table.column("step")[0].as_py()
    kind = np.uint64 if words else np.uint8
    sides = [[np.frombuffer(d, kind) for d in table.column(c).to_pylist()] for c in ("before", "after")]
    alphabet = 257
    if words:
        kinds, rank = np.unique(np.concatenate(sides[0] + sides[1]), return_inverse=True)
        parts = np.split(rank, np.cumsum([len(d) for d in sides[0] + sides[1]])[:-1])
        sides, alphabet = [parts[: table.num_rows], parts[table.num_rows :]], len(kinds) + 1
    names, number = np.unique(table.column("window").to_numpy(), return_inverse=True)
    n_digits = max(1, -(-(len(names) - 1).bit_length() // 8))
    digits = alphabet + ((number[:, None] >> (8 * np.arange(n_digits))) & 255)
    size = [np.array([len(d) for d in side], np.int64) for side in sides]
    at = np.concatenate([[0], np.cumsum(size[0] + size[1] + n_digits + 1)])
    t = np.zeros(at[-1], np.int64)  # 0 between cells
    for a, x, d, y in zip(at.tolist(), sides[0], digits, sides[1]):
        a, b = a + len(x), a + len(x) + n_digits
        t[a - len(x) : a] = x
        t[a - len(x) : a] += 1
        t[a:b] = d
        t[b : b + len(y)] = y
        t[b : b + len(y)] += 1
    hit = repeated_starts(t, alphabet + 256, step - 1 + n_digits)
    n_starts = size[0] - (step - 1) + size[1] + 1
    out = []
    for a, n, doc, mark, first in zip(at.tolist(), n_starts.tolist(), *(table.column(c).to_pylist() for c in ("doc_id", "mark", "first"))):
        own = hit[a : a + n]
        if own.any():
            out += [(doc, mark, first + x, first + y) for x, y in _runs(own)]
    return _starts(out)


def _sorted_shards(found: DataFrame, words: bool) -> DataFrame:
    """Repeated starts among cells that share windows, by suffix arrays of shards."""
    symbols = found.agg(F.sum(2 * F.col("step"))).first()[0]
    n_shards = max(1, -(-(symbols or 0) // SHARD))
    in_shard = partial(_shard, words=words)
    dealt = found.withColumn("shard", F.pmod(F.xxhash64("window"), F.lit(n_shards))).repartition(max(1, n_shards // 2), "shard", "step")
    return dealt.groupBy("shard", "step").applyInArrow(lambda t: in_shard(t), STARTS)


def shared_cells(found: DataFrame) -> DataFrame:
    """Cells whose window is not the only one of its kind, with ``n``, the number of cells that have it."""
    n = found.groupBy(F.col("window").alias("_w")).agg(F.count("*").alias("n")).where("n > 1")
    return found.drop("n").join(n, F.col("window") == F.col("_w")).drop("_w")


def repeated_ranges(texts: DataFrame, width: int, gram: int, words: bool = False) -> DataFrame:
    """Ranges of starts of repeated strings (doc_id, mark, first, last) of texts (doc_id, mark, text);
    starts and width count bytes or words."""
    spark = texts.sparkSession
    read, cut_out = partial(_read, width=width, gram=gram, words=words), partial(_cut, width=width, gram=gram, words=words)
    found = written(spark, texts.mapInArrow(read, SLICES), "slices")
    kinds = found.groupBy("anchor", "content").agg(F.count("*").alias("n"), F.min(F.struct("doc_id", "mark", "first")).alias("one"))
    kinds = written(spark, kinds, "kinds")
    anchors = kinds.groupBy("anchor").agg(F.sum("n").alias("all_n"), F.count("*").alias("n_kinds")).where("all_n > 1").drop("all_n")
    shared = written(spark, kinds.join(anchors, "anchor"), "shared")
    met = written(spark, found.join(shared, ["anchor", "content"]), "met")
    discard(found, kinds, shared)
    whole = written(spark, met.where("n > 1").select("doc_id", "mark", "first", "last"), "whole")
    # one slice of each content suffices to be compared with the others
    alone = met.where("n_kinds > 1").where(F.struct("doc_id", "mark", "first").eqNullSafe(F.col("one")))
    wanted = alone.groupBy("doc_id", "mark").agg(F.sort_array(F.collect_list(F.struct("first", "last", "at", "anchor"))).alias("wanted"))
    wanted = wanted.select(F.struct("doc_id", "mark").alias("_k"), "wanted")
    cut = texts.join(wanted, F.struct(texts["doc_id"], texts["mark"]).eqNullSafe(F.col("_k"))).select("doc_id", "mark", "text", "wanted")
    cut = written(spark, cut.mapInArrow(cut_out, CUT), "cells")
    discard(met)
    out = whole
    while True:
        open_ = written(spark, shared_cells(cut), "open-cells")
        discard(cut)
        one = F.col("step") == 1  # the window is the string
        out = out.unionByName(written(spark, open_.where(one).select("doc_id", "mark", "first", F.col("first").alias("last")), "strings"))
        out = out.unionByName(written(spark, _sorted_shards(open_.where(~one & (F.col("n") <= CROWD)), words), "partly"))
        crowd = open_.where(~one & (F.col("n") > CROWD))
        if crowd.isEmpty():
            discard(open_)
            return out
        cut = written(spark, halved(crowd, words), "halves")
        discard(open_)


def _byte_ranges(raw: bytes, ranges: list[dict], width: int, words: int | None) -> list[tuple[int, int]]:
    """Ranges of repeated starts -> the byte ranges that are covered, ascending."""
    spans = [(r["first"], r["last"] + width) for r in ranges if not r["words"]]
    if len(spans) < len(ranges):
        start, end = _word_spans(np.frombuffer(raw, np.uint8))
        spans += [(int(start[r["first"]]), int(end[r["last"] + words - 1])) for r in ranges if r["words"]]
    return sorted(spans)


def _remove(batches, width: int, words: int | None):
    """Task: texts with repeated ranges -> spans and what is left."""
    for batch in batches:
        spans_out, kept_out, size_out = [], [], []
        for text, ranges in zip(batch.column("text").to_pylist(), batch.column("ranges").to_pylist()):
            raw = text.encode("utf-8")
            spans: list[list[int]] = []
            for first, end in _byte_ranges(raw, ranges or [], width, words):
                if spans and first <= spans[-1][1]:
                    spans[-1][1] = max(spans[-1][1], end)
                else:
                    spans.append([first, end])
            edges = [0, *[x for s in spans for x in s], len(raw)]
            kept_out.append(b"".join(raw[a:b] for a, b in zip(edges[::2], edges[1::2])))
            spans_out.append([{"start": a, "end": b} for a, b in spans])
            size_out.append(len(raw))
        yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(size_out, pa.int64()),
                                          pa.array(spans_out, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
                                          pa.array(kept_out, pa.binary()), pa.array([k.decode("utf-8", "ignore") for k in kept_out], pa.string())],
                                         ["row", "n_bytes", "spans", "kept", "kept_text"])


def remove_repeats(docs: DataFrame, text: str = "text", words: int | None = None) -> DataFrame:
    """``docs`` with ``n_bytes``, ``spans`` (removed byte ranges), ``kept`` (remaining bytes) and
    with ``kept_text`` (remaining text; a character that a cut went through is left out).
    Strings of WIDTH bytes that repeat go and, if given, passages of ``words`` words that do."""
    if words is not None and words < 2:
        raise ValueError("words: a passage has two words at least")
    spark = docs.sparkSession
    small_arrow_batches(spark, 500)
    docs = without(docs, "n_bytes", "spans", "kept", "kept_text", "_row")
    mark = F.xxhash64(text_of(docs, text))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), mark.alias("mark"), text_of(docs, text).alias("text"))
    ranges = repeated_ranges(texts, WIDTH, GRAM).withColumn("words", F.lit(False))
    if words is not None:
        by_word = repeated_ranges(texts, words, min(WORD_GRAM, words - 1), True)
        ranges = ranges.unionByName(by_word.withColumn("words", F.lit(True)))
    ranges = ranges.groupBy("doc_id", "mark").agg(F.collect_set(F.struct("first", "last", "words")).alias("ranges"))
    ranges = written(spark, ranges.select(F.struct("doc_id", "mark").alias("_k"), "ranges"), "ranges")
    d = docs.withColumn("_row", F.struct(F.col("doc_id").cast("long").alias("doc_id"), mark.alias("mark")))
    d = d.join(ranges, F.col("_row").eqNullSafe(F.col("_k")), "left").drop("_k")
    rest = [c for c in docs.columns if c != text]
    d = d.select(F.struct(*[F.col(f"`{c}`") for c in rest]).alias("row"), text_of(d, text).alias("text"), "ranges")
    kinds = "n_bytes long, spans array<struct<start: long, end: long>>, kept binary, kept_text string"
    out = d.mapInArrow(partial(_remove, width=WIDTH, words=words), f"row {d.schema['row'].dataType.simpleString()}, {kinds}")
    return out.select("row.*", "n_bytes", "spans", "kept", "kept_text")
