"""Public vocabularies in tasks: integer look-up tables, cutting of texts into words and
byte-pair merging of many words at once."""

from __future__ import annotations

import hashlib
import heapq
import json
import re
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import SparkSession
from tokenizers import Tokenizer

#: Words of more bytes than this are merged with a heap.
LONG_WORD = 128
#: Characters of text that are worked on at a time; a longer text is cut at spaces.
PIECE = 1 << 22
NO_MERGE = np.int64(1) << np.int64(62)

#: Characters that every Unicode version in use treats alike: ASCII without the
#: separators U+001C to U+001F, letters of Latin-1 and Latin Extended-A (without the
#: dotted capital I) and common signs.
LETTERS = "A-Za-zÀ-ÖØ-öø-įı-ſ"
SIGNS = "¡-©«-±´¶-¸»¿‐-‧"
UNUSUAL = re.compile(f"[^\x00-\x1b\x20-\x7f{LETTERS}{SIGNS}]")
CUT = re.compile(r"(?<=\S) (?=\S)")


class IntMap:
    """Map from int64 keys (0 or more) to int64 values: open addressing over numpy arrays."""

    def __init__(self, keys=(), values=(), missing: int = -1):
        self.missing, self.used = missing, 0
        self._room(1024)
        self.put(np.asarray(keys, np.int64), np.asarray(values, np.int64))

    def _room(self, n: int) -> None:
        self.bits = max(10, int(4 * n).bit_length())
        self.keys = np.full(1 << self.bits, -1, np.int64)
        self.values = np.full(1 << self.bits, self.missing, np.int64)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def put(self, keys: np.ndarray, values: np.ndarray) -> None:
        """Add distinct keys that are not in the map."""
        if 2 * (self.used + len(keys)) > len(self.keys):
            old = self.keys >= 0
            keys, values = np.concatenate([self.keys[old], keys]), np.concatenate([self.values[old], values])
            self._room(2 * len(keys))
            self.used = 0
        self.used += len(keys)
        slot, last = self._slot(keys), (1 << self.bits) - 1
        while len(keys):
            free = self.keys[slot] < 0
            self.keys[slot[free]] = keys[free]
            placed = self.keys[slot] == keys
            self.values[slot[placed]] = values[placed]
            keys, values, slot = keys[~placed], values[~placed], (slot[~placed] + 1) & last

    def get(self, keys: np.ndarray) -> np.ndarray:
        slot, last = self._slot(keys), (1 << self.bits) - 1
        found = self.keys[slot]
        out = np.where(found == keys, self.values[slot], self.missing)
        rest = np.flatnonzero((found != keys) & (found >= 0))
        while len(rest):
            slot[rest] = at = (slot[rest] + 1) & last
            found = self.keys[at]
            hit = found == keys[rest]
            out[rest[hit]] = self.values[at[hit]]
            rest = rest[~hit & (found >= 0)]
        return out


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies: a
    byte that is a printable Latin-1 character stands for itself, the others are
    numbered upwards from U+0100."""
    own = {*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(0x100, 0x200))
    return [chr(b) if b in own else chr(next(spare)) for b in range(256)]


class Vocabulary:
    """Tokens and merge ranks of a ``tokenizers`` JSON file of kind BPE over byte symbols."""

    def __init__(self, spec: str):
        d = json.loads(spec)
        model = d["model"]
        if model["type"] != "BPE" or model.get("dropout") or model.get("continuing_subword_prefix"):
            raise ValueError("only plain BPE vocabularies are supported")
        vocab: dict[str, int] = model["vocab"]
        suffix = model.get("end_of_word_suffix") or ""
        self.library = Tokenizer.from_str(spec)
        self.added = {t["content"]: t["id"] for t in d.get("added_tokens", [])}
        names = {i: t for t, i in vocab.items()} | {i: t for t, i in self.added.items()}
        self.size = max(names) + 1
        self.names = [names.get(i, "") for i in range(self.size)]
        self.bits = np.int64(self.size.bit_length())
        self.mask = (np.int64(1) << self.bits) - np.int64(1)
        symbols = byte_symbols()
        self.byte_of = {s: b for b, s in enumerate(symbols)}
        self.inner = np.array([vocab[s] for s in symbols], np.int64)
        self.last = np.array([vocab[s + suffix] for s in symbols], np.int64)
        #: (left id, right id) in one integer -> (rank of the merge, id of the merged part) in one integer
        self.pairs: dict[int, int] = {}
        self.split: dict[int, tuple[int, int]] = {}
        bits = int(self.bits)
        for rank, m in enumerate(model["merges"]):
            a, b = m if isinstance(m, list) else m.split(" ")
            self.pairs.setdefault(vocab[a] << bits | vocab[b], rank << bits | vocab[a + b])
            self.split.setdefault(vocab[a + b], (vocab[a], vocab[b]))
        self.ranks = IntMap(list(self.pairs), list(self.pairs.values()), int(NO_MERGE))
        added = sorted(self.added, key=len, reverse=True)
        self.special = re.compile("(" + "|".join(map(re.escape, added)) + ")") if added else None

    # -- cutting ------------------------------------------------------------------

    def words(self, text: str, pattern: re.Pattern, lower: bool) -> list[str]:
        """The words of a text; a special string of the vocabulary is one word.

        Texts of usual characters are cut by ``pattern``. For any other text the
        installed library's own normaliser and cutter decide, since tables of letters
        differ between Unicode versions.
        """
        if self.special is not None and "<" in text and self.special.search(text):
            parts = self.special.split(text)
            return list(chain.from_iterable([s] if k % 2 else self._words(s, pattern, lower) for k, s in enumerate(parts) if s))
        return self._words(text, pattern, lower)

    def _words(self, text: str, pattern: re.Pattern, lower: bool) -> list[str]:
        if UNUSUAL.search(text):
            lib = self.library
            norm = lib.normalizer.normalize_str(text) if lib.normalizer else text
            of = self.byte_of
            return [bytes([of[c] for c in w]).decode("utf-8") for w, _ in lib.pre_tokenizer.pre_tokenize_str(norm)]
        return pattern.findall(text.lower() if lower else text)

    def batches(self, texts: list[str | None], pattern: re.Pattern, lower: bool):
        """Words of texts, about ``PIECE`` characters at a time.

        Yields (words, docs, counts): the words in order, and how many of them belong to
        each of the texts numbered by ``docs`` (a long text is in several batches).
        """
        words, docs, counts, held = [], [], [], 0
        for d, text in enumerate(texts):
            for piece in pieces(text or ""):
                got = self.words(piece, pattern, lower)
                words += got
                docs.append(d)
                counts.append(len(got))
                held += len(piece)
                if held >= PIECE:
                    yield words, np.array(docs), np.array(counts)
                    words, docs, counts, held = [], [], [], 0
        if docs:
            yield words, np.array(docs), np.array(counts)

    # -- merging ------------------------------------------------------------------

    def merge(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of distinct words: all ids one after the other, and where each word's begin."""
        raw, at = string_bytes(words)
        length = np.diff(at)
        n = len(length)
        out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []  # words, number of ids, ids
        low = 0
        for high in (4, 8, 12, 16, 24, 32, 64, LONG_WORD):
            rows = np.flatnonzero((length > low) & (length <= high))
            low = high
            for k in range(0, len(rows), 1 << 16):
                out.append(self._merge_short(raw, at, rows[k : k + (1 << 16)], high))
        for r in np.flatnonzero(length > LONG_WORD):
            w = bytes(raw[at[r] : at[r + 1]])
            ids = [self.added[s]] if (s := w.decode("utf-8")) in self.added else self.merge_one(w)
            out.append((np.array([r]), np.array([len(ids)]), np.array(ids, np.int64)))
        size = np.zeros(n, np.int64)
        for rows, sizes, _ in out:
            size[rows] = sizes
        starts = np.concatenate([[0], np.cumsum(size)])
        ids = np.empty(starts[-1], np.uint32)
        for rows, sizes, got in out:
            ids[spread(starts[rows], sizes)] = got
        return self._special(words, ids, starts)

    def _special(self, words: pa.Array, ids: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        hit = {i: self.added[s] for s in self.added if (i := words.index(pa.scalar(s, words.type)).as_py()) >= 0}
        if not hit:
            return ids, starts
        size = np.diff(starts)
        keep = np.ones(len(ids), bool)
        for i, token in hit.items():
            ids[starts[i]] = token
            keep[starts[i] + 1 : starts[i + 1]] = False
            size[i] = 1
        return ids[keep], np.concatenate([[0], np.cumsum(size)])

    def _merge_short(self, raw, at, rows, width):
        """Words of up to ``width`` bytes as rows of two matrices: the ids of their parts
        and the ranks of neighbouring parts. In every round each row's least rank is
        found, its boundary deleted and the ranks beside it refreshed."""
        n, col = len(rows), np.arange(width)
        length = (at[rows + 1] - at[rows]).astype(np.int64)
        there = col < length[:, None]
        cell = np.minimum(at[rows][:, None] + col, len(raw) - 1)
        ids = np.where(there, np.where(col == length[:, None] - 1, self.last[raw[cell]], self.inner[raw[cell]]), -1)
        ranks = np.full((n, width), NO_MERGE)
        ranks[:, :-1] = self._ranks(ids[:, :-1], ids[:, 1:])
        done_rows, done_ids = [], []
        rows = rows.copy()
        while True:
            i = ranks.argmin(axis=1)
            line = np.arange(len(rows))
            least = ranks[line, i]
            still = least < NO_MERGE
            if not still.all():
                done_rows.append(rows[~still])
                done_ids.append(ids[~still])
                rows, ids, ranks, i, least = rows[still], ids[still], ranks[still], i[still], least[still]
                line = np.arange(len(rows))
            if not len(rows):
                break
            new = least & self.mask
            right = col[:-1] > i[:, None]
            ids[:, :-1] = np.where(right, ids[:, 1:], ids[:, :-1])
            ids[:, -1] = -1
            ids[line, i] = new
            ranks[:, :-1] = np.where(col[:-1] >= i[:, None], ranks[:, 1:], ranks[:, :-1])
            after = np.where(i + 1 < width, ids[line, np.minimum(i + 1, width - 1)], -1)
            ranks[line, i] = self._ranks(new, after)
            inside = i > 0
            ranks[line[inside], i[inside] - 1] = self._ranks(ids[line[inside], i[inside] - 1], new[inside])
        rows, ids = np.concatenate(done_rows), np.concatenate(done_ids)
        return rows, (ids >= 0).sum(axis=1), ids[ids >= 0]

    def _ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        known = (left >= 0) & (right >= 0)
        out = np.full(left.shape, NO_MERGE)
        out[known] = self.ranks.get(left[known] << self.bits | right[known])
        return out

    def merge_one(self, word: bytes) -> list[int]:
        """Ids of one word of any length, merged with a heap."""
        bits, mask, rank_of, n = int(self.bits), int(self.mask), self.pairs.get, len(word)
        ids = [int(self.inner[b]) for b in word]
        ids[-1] = int(self.last[word[-1]])
        before, after = list(range(-1, n - 1)), [*range(1, n), -1]
        heap = [(r, i, ids[i], ids[i + 1]) for i in range(n - 1) if (r := rank_of(ids[i] << bits | ids[i + 1])) is not None]
        heapq.heapify(heap)
        while heap:
            r, i, a, b = heapq.heappop(heap)
            j = after[i]
            if ids[i] != a or j < 0 or ids[j] != b:
                continue
            ids[i], ids[j], after[i] = r & mask, -1, after[j]
            if after[i] >= 0:
                before[after[i]] = i
            for x, y in ((before[i], i), (i, after[i])):
                if x >= 0 and y >= 0 and (r := rank_of(ids[x] << bits | ids[y])) is not None:
                    heapq.heappush(heap, (r, x, ids[x], ids[y]))
        return [x for x in ids if x >= 0]


def pieces(text: str) -> list[str]:
    """A text cut into parts of about ``PIECE`` characters, each cut in front of a single
    space between two words, where no word of a vocabulary can reach across."""
    if len(text) <= PIECE:
        return [text]
    out, start = [], 0
    while (m := CUT.search(text, start + PIECE)) is not None:
        out.append(text[start : m.start()])
        start = m.start()
    return [*out, text[start:]]


def string_bytes(a: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string array without nulls."""
    a = a.cast(pa.large_string())
    at = np.frombuffer(a.buffers()[1], np.int64)[a.offset : a.offset + len(a) + 1]
    raw = np.frombuffer(a.buffers()[2] or b"\0", np.uint8)
    return (raw if len(raw) else np.zeros(1, np.uint8)), at


def spread(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Positions start, start + 1, ... (``size`` of them) for every start, one after the other."""
    ends = np.cumsum(sizes)
    if not len(ends):
        return np.zeros(0, np.int64)
    return np.arange(ends[-1]) + np.repeat(starts - (ends - sizes), sizes)


def distinct(words: list[str]) -> tuple[pa.Array, np.ndarray]:
    """The distinct words, and for each word the number of its distinct one."""
    d = pa.array(words, pa.large_string()).dictionary_encode()
    return d.dictionary, d.indices.to_numpy(zero_copy_only=False).astype(np.int64)


def broadcast_vocabulary(spark: SparkSession, path: str):
    """The vocabulary file (a few MB, independent of the data) for all executors."""
    with open(path, encoding="utf-8") as f:
        spec = f.read()
    return spark.sparkContext.broadcast((hashlib.sha256(spec.encode()).hexdigest(), spec))


_READY: dict[tuple[str, str], object] = {}


def in_worker(kind, spec):
    """One object of a kind for each vocabulary in a Python worker, kept between batches and tasks."""
    key = (kind.__name__, spec.value[0])
    if key not in _READY:
        _READY[key] = kind(spec.value[1])
    return _READY[key]
