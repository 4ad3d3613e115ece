"""Near-duplicate documents by MinHash with sequential Bayesian verification.

Two documents are linked if the sets of their word shingles have a share of common
elements of ``SIMILAR`` per cent or more. Method:

1. Every text is read once: the set of its shingles (64-bit hashes), a digest of the set,
   and a MinHash signature. Documents with equal sets are one node from here on.
2. Signatures are cut into bands; nodes with an equal band share a bucket. With BANDS
   bands of ROWS values a pair of likeness 0.8 shares no bucket with probability
   (1 - 0.8 ** ROWS) ** BANDS, below 1e-6.
3. A candidate pair's signatures are compared in batches of ``BATCH`` values. After each
   batch the posterior of the likeness (uniform prior) is Beta(equal + 1, unequal + 1);
   the pair is dropped as soon as the probability of 0.8 or more is below ``MISS``.
4. Survivors are verified exactly on their full sets.

Only components are asked for, so a bucket's pairs are not all formed. First every node is
compared with one pivot of its buckets, then with the pivots of all its buckets, then with
pivots drawn at random; nodes that are already connected are left out. A large group of
near copies is mostly one component by then. What is left are the pairs of one bucket
between different components: a bucket's signatures are packed into blocks of bounded
size, two blocks at a time meet in a task, and step 3 is done there for every pair in the first of
the buckets it shares. The task gives out the nodes of surviving pairs, each once a bucket. Blocks of
these meet again with their full sets, step 3 tells the pairs, step 4 verifies them, and links come out. So no
link between components is lost to a group's size, and no rows are made of its pairs.

Pairs and buckets are joined and aggregated by Spark; hot buckets are aggregated before
the shuffle, and their blocks are dealt by (bucket, pair of blocks). Texts travel once, and only to fetch the sets
of nodes that share a bucket. Intermediate tables are written to the shared folder and
deleted when their last reader is done.

Cases: null text counts as empty; a text without words has an empty set and is linked with
nothing (component_id is its own id); with fewer words than a shingle the whole sequence
is the only shingle; repeated rows fall into one component; a null id is never the
smallest unless a component has no other (its component_id is null then, kept is null);
an empty table gives an empty table; columns named like a result column are replaced.
"""

from __future__ import annotations

import hashlib
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType

from faceoff.llm.common import discard, doc_key, small_arrow_batches, text_of, written
from faceoff.llm.components import components

BANDS, ROWS = 28, 4
HASHES = BANDS * ROWS
SIMILAR = 80
BATCH, MISS = 16, 1e-7
#: Rounds of pivots drawn at random, and the size of a block in the last comparison.
MORE_PIVOTS = 2
BLOCK, BLOCK_SHINGLES = 256, 400_000
#: Pairs whose signatures a task compares at a time.
PAIRS = 1 << 16
#: Bytes of text that a task hashes at a time (a longer text by itself).
PIECE = 1 << 22

_RNG = np.random.default_rng(20240229)
BYTE_VALUE = _RNG.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
BYTE_VALUE[ord("A") : ord("Z") + 1] = BYTE_VALUE[ord("a") : ord("z") + 1]
IS_BLANK = np.zeros(256, bool)
IS_BLANK[[0x20, *range(0x09, 0x0E)]] = True
FACTOR = _RNG.integers(1, 1 << 63, HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
SHIFT = _RNG.integers(1, 1 << 63, HASHES, dtype=np.uint64)
PLACE = _RNG.integers(1, 1 << 63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(32))


def _powers(base: int, n: int) -> np.ndarray:
    p = np.full(n, base, np.uint64)
    p[:1] = 1
    return np.multiply.accumulate(p)


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the words of texts (A-Z as a-z), one text after the other, and
    where each text's words begin (one more at the end)."""
    raw = np.frombuffer(b" ".join([*texts, b""]) or b" ", np.uint8)
    blank = IS_BLANK[raw]
    edge = np.flatnonzero(np.diff(blank, prepend=True, append=True))
    start, end = edge[::2], edge[1::2]
    part = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum(BYTE_VALUE[raw] * _powers(BASE, len(raw)), out=part[1:])
    h = _mix((part[end] - part[start]) * _powers(INVERSE, len(raw))[start])
    text_start = np.concatenate([[0], np.cumsum([len(t) + 1 for t in texts])])
    return h, np.searchsorted(start, text_start)


def shingle_sets(texts: list[str | None], size: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    out: list[np.ndarray] = []
    held: list[bytes] = []
    total = 0

    def flush():
        if not held:
            return
        h, at = word_hashes(held)
        joined = np.zeros(max(0, len(h) - size + 1), np.uint64)
        for k in range(size):
            joined += h[k : k + len(joined)] * PLACE[k]
        joined = _mix(joined)
        for a, b in zip(at[:-1].tolist(), at[1:].tolist()):
            if b - a >= size:
                out.append(np.unique(joined[a : b - size + 1]))
            elif b > a:
                short = (h[a:b] * PLACE[size : size + b - a]).sum(dtype=np.uint64) + np.uint64(b - a)
                out.append(_mix(np.array([short], np.uint64)))
            else:
                out.append(np.zeros(0, np.uint64))
        held.clear()

    for t in texts:
        held.append((t or "").encode("utf-8"))
        total += len(held[-1])
        if total > PIECE:
            flush()
            total = 0
    flush()
    return out


def signature(hashes: np.ndarray) -> np.ndarray:
    """Least value of every hash function over a set: 32 bits each."""
    least = np.full(HASHES, 0xFFFFFFFF, np.uint64)
    for k in range(0, len(hashes), 2048):
        block = (hashes[k : k + 2048, None] * FACTOR + SHIFT) >> np.uint64(32)
        np.minimum(least, block.min(axis=0), out=least)
    return least.astype(np.uint32)


def least_equal(n: int, similar: int = SIMILAR, miss: float = MISS) -> int:
    """The fewest equal values among ``n`` with which a pair stays a candidate: below,
    the posterior probability of a likeness of ``similar`` per cent or more, which is
    the chance of at most that many successes in n + 1 trials, is under ``miss``."""
    p, below = similar / 100, 0.0
    for m in range(n + 1):
        below += comb(n + 1, m) * p**m * (1 - p) ** (n + 1 - m)
        if below >= miss:
            return m
    return n


NEEDED = [least_equal(n) for n in range(BATCH, HASHES + 1, BATCH)]


def may_be_similar(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For rows of signatures: do they survive every batch."""
    alive, equal = np.arange(len(a)), np.zeros(len(a), np.int64)
    for k, needed in enumerate(NEEDED):
        cut = slice(k * BATCH, (k + 1) * BATCH)
        equal[alive] += (a[alive, cut] == b[alive, cut]).sum(axis=1)
        alive = alive[equal[alive] >= needed]
    out = np.zeros(len(a), bool)
    out[alive] = True
    return out


@F.arrow_udf(BooleanType())
def _survives(a: pa.Array, b: pa.Array) -> pa.Array:
    if not len(a):
        return pa.array([], pa.bool_())
    sigs = [np.frombuffer(b"".join(x.to_pylist()), np.uint32).reshape(-1, HASHES) for x in (a, b)]
    return pa.array(may_be_similar(*sigs))


def _alike(x: bytes, y: bytes) -> bool:
    """The exact test of two full sets."""
    x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
    if 100 * min(len(x), len(y)) < SIMILAR * max(len(x), len(y)):
        return False
    both = len(np.intersect1d(x, y, assume_unique=True))
    return 100 * both >= SIMILAR * (len(x) + len(y) - both)


@F.arrow_udf(BooleanType())
def _linked(a: pa.Array, b: pa.Array) -> pa.Array:
    return pa.array([_alike(x, y) for x, y in zip(a.to_pylist(), b.to_pylist())], pa.bool_())


def candidates(x: list[dict], y: list[dict], band: int) -> np.ndarray:
    """Pairs (i, j) of the nodes of two blocks of a bucket that are in different components, survive the
    sequential test and share no band before this one."""
    sx, sy = (np.frombuffer(b"".join(m["signature"] for m in z), np.uint32).reshape(-1, HASHES) for z in (x, y))
    codes = {c: k for k, c in enumerate({m["comp"] for z in (x, y) for m in z})}
    cx, cy = (np.array([codes[m["comp"]] for m in z], np.int64) for z in (x, y))
    alive = np.argwhere(cx[:, None] != cy)
    equal = np.zeros(len(alive), np.int64)
    for k, needed in enumerate(NEEDED):
        cut = slice(k * BATCH, (k + 1) * BATCH)
        for lo in range(0, len(alive), PAIRS):
            part = alive[lo : lo + PAIRS]
            equal[lo : lo + PAIRS] += (sx[part[:, 0], cut] == sy[part[:, 1], cut]).sum(axis=1)
        stay = equal >= needed
        alive, equal = alive[stay], equal[stay]
    if len(alive) and band:
        same = (sx[alive[:, 0], : band * ROWS] == sy[alive[:, 1], : band * ROWS]).reshape(len(alive), band, ROWS)
        alive = alive[~same.all(axis=2).any(axis=1)]
    return alive


def links_between(x: list[dict], y: list[dict], pairs: np.ndarray) -> list[tuple[bytes, bytes]]:
    """The linked ones of pairs (i, j), verified on full sets; one for each node and component is enough."""
    out, seen = [], set()
    for i, j in pairs.tolist():
        key = (i, y[j]["comp"])
        if key not in seen and _alike(x[i]["shingles"], y[j]["shingles"]):
            seen.add(key)
            out.append((x[i]["node"], y[j]["node"]))
    return out


def _meeting(batches):
    """The rows of a task: a bucket, two of its blocks (or one, to be compared with itself) and their candidate pairs."""
    for batch in batches:
        for r in range(batch.num_rows):
            bucket, i, j, band = (batch.column(c)[r].as_py() for c in ("bucket", "i", "j", "band"))
            members = batch.column("members")[r].as_py()
            x = [m for m in members if m["block"] == i]
            y = x if i == j else [m for m in members if m["block"] == j]
            pairs = candidates(x, y, band)
            yield bucket, x, y, pairs[pairs[:, 0] < pairs[:, 1]] if i == j else pairs


def _open_nodes(batches):
    """Task: pairs of blocks of signatures -> the nodes of candidate pairs, with the bucket of the pair."""
    for bucket, x, y, pairs in _meeting(batches):
        nodes = {x[i]["node"] for i in set(pairs[:, 0].tolist())} | {y[j]["node"] for j in set(pairs[:, 1].tolist())}
        yield pa.RecordBatch.from_arrays([pa.array([bucket] * len(nodes), pa.int64()), pa.array(sorted(nodes), pa.binary())], ["bucket", "node"])


def _between(batches):
    """Task: pairs of blocks of signatures and sets -> links between components."""
    for _, x, y, pairs in _meeting(batches):
        got = links_between(x, y, pairs)
        yield pa.RecordBatch.from_arrays([pa.array([a for a, _ in got], pa.binary()), pa.array([b for _, b in got], pa.binary())], ["a", "b"])


def meetings(members: DataFrame, size: int, *values: DataFrame) -> DataFrame:
    """Members (bucket, band, node, comp, n) of each bucket that has several components, with their
    ``values`` (tables by node), in blocks of about ``size`` nodes and ``BLOCK_SHINGLES`` shingles; every two blocks of a
    bucket and every block by itself are a row (bucket, i, j, band, members)."""
    mixed = members.groupBy("bucket").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.count("*").alias("c"), F.sum("n").alias("s"))
    blocks = F.greatest(F.lit(1), F.ceil(F.greatest(F.col("c") / size, F.col("s") / BLOCK_SHINGLES))).cast("int")
    mixed = mixed.where("lo <> hi").select("bucket", blocks.alias("blocks"))
    m = members.join(mixed, "bucket").withColumn("block", (F.xxhash64("node").bitwiseAND(F.lit((1 << 62) - 1)) % F.col("blocks")).cast("int"))
    for v in values:
        m = m.join(v, "node")
    m = m.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    m = m.withColumn("i", F.least("block", "other")).withColumn("j", F.greatest("block", "other"))
    held = F.struct("block", "node", "comp", *[v.columns[1] for v in values])
    return m.groupBy("bucket", "i", "j").agg(F.first("band").alias("band"), F.collect_list(held).alias("members"))


def _digest(s: np.ndarray) -> bytes:
    return hashlib.blake2b(s.tobytes(), digest_size=16).digest()


def _sets(size: int):
    """Task of the first reading: texts -> id, mark, n_shingles, node, signature."""
    def run(batches):
        for batch in batches:
            sets = shingle_sets(batch.column("text").to_pylist(), size)
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"), batch.column("mark"), pa.array([len(s) for s in sets], pa.int64()),
                pa.array([_digest(s) if len(s) else None for s in sets], pa.binary()),
                pa.array([signature(s).tobytes() if len(s) else None for s in sets], pa.binary()),
            ], ["doc_id", "mark", "n_shingles", "node", "signature"])
    return run


def _full_sets(size: int):
    """Task of the second reading: text and node -> node and full set."""
    def run(batches):
        for batch in batches:
            sets = shingle_sets(batch.column("text").to_pylist(), size)
            keep = [(n, s.tobytes()) for n, s in zip(batch.column("node").to_pylist(), sets) if _digest(s) == n]
            yield pa.RecordBatch.from_arrays([pa.array([n for n, _ in keep], pa.binary()), pa.array([s for _, s in keep], pa.binary())], ["node", "shingles"])
    return run


def near_duplicates(docs: DataFrame, size: int, text: str = "text") -> DataFrame:
    """One row per document: doc_id, mark (hash of its text), n_shingles, component (the least
    digest of a set in it, null without words), component_id and kept."""
    spark = docs.sparkSession
    small_arrow_batches(spark)
    key = doc_key(docs, text)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of(docs, text).alias("text"), key["_mark"].alias("mark"))
    read = texts.mapInArrow(_sets(size), "doc_id long, mark long, n_shingles long, node binary, signature binary")
    read = written(spark, read, "signatures")
    nodes = (read.where("node IS NOT NULL").groupBy("node")
             .agg(F.min(F.struct("doc_id", "mark")).alias("one"), F.first("n_shingles").alias("n"), F.first("signature").alias("signature")))
    nodes = written(spark, nodes, "nodes")
    slim = written(spark, read.drop("signature"), "documents")
    discard(read)

    band = lambda k: F.struct(F.lit(k).alias("band"), F.xxhash64(F.lit(k), F.substring("signature", k * ROWS * 4 + 1, ROWS * 4)).alias("bucket"))
    buckets = nodes.select("node", "n", F.explode(F.array(*[band(k) for k in range(BANDS)])).alias("b")).select("node", "n", "b.*")
    shared = buckets.groupBy("bucket").agg(F.count("*").alias("c"), F.min("node").alias("pivot")).where("c > 1").drop("c")
    members = written(spark, buckets.join(shared, "bucket"), "buckets")  # bucket, band, node, n, pivot

    wanted = members.select("node").distinct().join(nodes.drop("n"), "node")
    wanted = written(spark, wanted, "wanted")
    discard(nodes)
    names = list(key)
    fetch = wanted.select("node", *[v.alias(k) for k, v in {
        "_id": F.coalesce("one.doc_id", F.lit(0).cast("long")), "_no_id": F.col("one.doc_id").isNull(), "_mark": F.col("one.mark")}.items()])
    # one shuffle of the texts: repeated rows go where the join has put them
    sets = docs.select(text_of(docs, text).alias("text"), *[v.alias(k) for k, v in key.items()]).join(fetch, names).dropDuplicates(names)
    sets = sets.select("text", "node").mapInArrow(_full_sets(size), "node binary, shingles binary")
    sets = written(spark, sets, "sets")
    signatures = wanted.select("node", "signature")

    def verify(pairs: DataFrame, what: str) -> DataFrame:
        """The linked ones among pairs (a, b): signatures first, then the full sets of survivors."""
        def both(p: DataFrame, t: DataFrame) -> DataFrame:
            value = t.columns[1]
            x, y = t.toDF("a", "va"), t.toDF("b", "vb")
            return p.join(x, "a").join(y, "b").select("a", "b", F.col("va"), F.col("vb")).withColumnsRenamed({"va": f"{value}_a", "vb": f"{value}_b"})
        alive = written(spark, both(pairs, signatures).where(_survives("signature_a", "signature_b")).select("a", "b"), f"{what}-survivors")
        needed = alive.select(F.explode(F.array("a", "b")).alias("node")).distinct()
        needed = written(spark, sets.join(needed, "node", "left_semi"), f"{what}-sets")
        out = written(spark, both(alive, needed).where(_linked("shingles_a", "shingles_b")).select("a", "b"), f"{what}-links")
        discard(alive, needed)
        return out

    # every node with the least of its pivots
    star = members.where("node <> pivot").select(F.col("pivot").alias("a"), F.col("node").alias("b"))
    first = written(spark, star.groupBy("b").agg(F.min("a").alias("a")).select("a", "b"), "pairs-1")
    links = verify(first, "pairs-1")
    comp = components(links)

    def with_comp(df: DataFrame, column: str, name: str, comp: DataFrame) -> DataFrame:
        c = comp.select(F.col("node").alias(column), F.col("comp").alias("_c"))
        return df.join(c, column, "left").withColumn(name, F.coalesce("_c", column)).drop("_c")

    # nodes with the other pivots of their buckets, if not connected with them yet
    rest = with_comp(with_comp(star.distinct(), "a", "ca", comp), "b", "cb", comp).where("ca <> cb").select("a", "b")
    second = written(spark, rest.join(first, ["a", "b"], "left_anti"), "pairs-2")
    links = links.unionByName(verify(second, "pairs-2"))
    discard(first, second, comp)
    comp = components(links)
    # further pivots, drawn anew in every round among the nodes of a bucket, for those not connected with them
    for number in range(MORE_PIVOTS):
        open_ = with_comp(members, "node", "comp", comp)
        draw = F.min(F.struct(F.xxhash64("node", F.lit(number)).alias("h"), "node", "comp")).alias("draw")
        drawn = open_.groupBy("bucket").agg(draw, F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo <> hi")
        near = open_.join(drawn.select("bucket", "draw"), "bucket").where(F.col("comp") != F.col("draw.comp"))
        near = written(spark, near.select(F.col("draw.node").alias("a"), F.col("node").alias("b")).distinct(), f"pairs-3-{number}")
        links = links.unionByName(verify(near, f"pairs-3-{number}"))
        discard(near, comp)
        comp = components(links)
    # all other pairs of a bucket between different components, block against block: signatures, then sets
    open_ = written(spark, with_comp(members.drop("pivot"), "node", "comp", comp), "open")
    discard(members, comp)
    left = meetings(open_, BLOCK, signatures).mapInArrow(_open_nodes, "bucket long, node binary").distinct()
    left = written(spark, left, "open-nodes")
    # a pair is a candidate in one bucket only, so a set goes where its node has a pair
    needed = sets.join(left.select("node").distinct(), "node", "left_semi")
    found = meetings(open_.join(left, ["bucket", "node"], "left_semi"), BLOCK, signatures, needed)
    found = written(spark, found.mapInArrow(_between, "a binary, b binary").distinct(), "pairs-4-links")
    discard(open_, left, sets, wanted)
    comp = components(links.unionByName(found))

    d = with_comp(slim, "node", "comp", comp)
    least = written(spark, d.where("comp IS NOT NULL").groupBy("comp").agg(F.min("doc_id").alias("component_id")), "least")
    d = d.join(least, "comp", "left")
    d = d.withColumn("component_id", F.when(F.col("comp").isNull(), F.col("doc_id")).otherwise(F.col("component_id")))
    return d.select("doc_id", "mark", "n_shingles", F.col("comp").alias("component"), "component_id", (F.col("doc_id") == F.col("component_id")).alias("kept"))


def keep_one(docs: DataFrame, size: int, text: str = "text") -> DataFrame:
    """The rows of ``docs`` without near duplicates: of each component the document of the
    smallest id stays (of equal ids one); documents without words all stay."""
    spark = docs.sparkSession
    found = written(spark, near_duplicates(docs, size, text), "components")
    key = doc_key(docs, text)
    named = found.select("component", F.coalesce("doc_id", F.lit(0).cast("long")).alias("_id"), F.col("doc_id").isNull().alias("_no_id"), F.col("mark").alias("_mark"))
    first = F.min(F.struct("_no_id", "_id", "_mark")).alias("k")
    stay = named.where("component IS NOT NULL").groupBy("component").agg(first).select("k._id", "k._no_id", "k._mark", F.lit(True).alias("_one"))
    stay = stay.unionByName(named.where("component IS NULL").select(*key).distinct().withColumn("_one", F.lit(False)))
    stay = written(spark, stay, "stay")
    discard(found)
    d = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), *[v.alias(k) for k, v in key.items()]).join(stay, list(key))
    # of repeated rows one stays; the shuffle of the join serves the window too
    n = F.row_number().over(Window.partitionBy(*key).orderBy(F.xxhash64("row")))
    return d.withColumn("_n", n).where((F.col("_n") == 1) | ~F.col("_one")).select("row.*")
