"""Document fingerprints by one-permutation MinHash, and pairs of neighbouring documents.

Method: the hash of every word shingle falls into one of ``BINS`` bins by its top bits and
each bin keeps its least hash (one pass, one hash function). An empty bin borrows from
another bin, found by optimal densification: it probes bins in an order of its own, drawn
by a hash of (bin, attempt), until one is not empty. Of every bin only the ``BITS`` low
bits are stored, packed into long integers. Equal low bits by chance are corrected for:
with a share m of equal bins the likeness is (m - c) / (1 - c), c = 2 to the power -BITS,
cut off at 0.

Only DataFrame functions are used; sets are made in place, document by document, and
texts are shuffled only to meet their neighbour (``with_next``): by ranges of ids of
equal size, so that a hot source or group of copies does not gather in one task.

Cases: null text counts as empty; a text of fewer words than a shingle is one shingle;
without words the set is empty, its fingerprint all zeros, its likeness 1 to another
empty set and 0 to any other; equal texts have equal fingerprints; repeated ids are
ordered by text; a null id comes first; the last document's neighbour is the first one
(itself, if it is alone); an empty table gives an empty table.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from faceoff.llm.common import WORD_SEPARATORS, text_of, without

SHINGLE = 5
BIN_BITS, BITS = 7, 8
BINS = 1 << BIN_BITS
#: Attempts of a bin that are tried one by one; further ones are looked through together.
FIRST_ATTEMPTS = 6
BLANKS = " \t\n\x0b\x0c\r"


def _probe(i, attempt: int):
    """The bin that empty bin ``i`` probes at an attempt: by a hash of (bin, attempt)."""
    return F.pmod(F.xxhash64(i, F.lit(attempt)), F.lit(BINS)).cast("int")


def bins(text: Column) -> dict[str, Column]:
    """Steps from a text to its densified bins: names and columns, each over the one before."""
    words, h, v = F.col("_w"), F.col("_h"), F.col("_v")
    width = 64 - BIN_BITS
    n = F.size(words)
    shingle = lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(SHINGLE)])
    hashed = (F.when(F.get(words, F.lit(0)) == "", F.array().cast("array<bigint>"))
              .when(n < SHINGLE, F.array(F.xxhash64(words)))
              .otherwise(F.transform(F.sequence(F.lit(0), n - SHINGLE), shingle)))
    # one mark at the upper end of every bin: after sorting, the first item of a bin is its
    # least hash, or the mark if the bin is empty
    marks = F.array(*[F.lit(((i - BINS // 2 + 1) << width) - 1) for i in range(BINS)])
    bin_of = lambda x: F.shiftright(x, width)
    first = F.filter(h, lambda x, i: (i == 0) | (bin_of(x) != bin_of(F.get(h, F.greatest(i - 1, F.lit(0))))))
    least = F.transform(first, lambda x, i: F.when(x != F.element_at(marks, i + 1), x))
    # beyond the first attempts: of the bins that are not empty, the one whose hash with
    # the probing bin is least, which is a draw of the same kind
    drawn = lambda i: F.array_min(F.transform(F.filter(F.transform(v, lambda y, j: F.when(y.isNotNull(), j)), lambda j: j.isNotNull()),
                                              lambda j: F.struct(F.xxhash64(i, j, F.lit(-1)), j.alias("j"))))["j"]
    filled = lambda x, i: F.coalesce(x, *[F.get(v, _probe(i, a)) for a in range(FIRST_ATTEMPTS)], F.get(v, drawn(i)))
    return {"_w": F.split(F.btrim(text, F.lit(BLANKS)), WORD_SEPARATORS), "_h": F.sort_array(F.concat(hashed, marks)),
            "_v": least, "_f": F.transform(v, filled)}


def packed(filled: Column) -> Column:
    """The low bits of all bins in long integers, 64 / BITS bins to each; all zeros for an empty set."""
    per = 64 // BITS
    mask = F.lit((1 << BITS) - 1).cast("long")
    part = lambda k, b: F.shiftleft(F.coalesce(F.get(filled, F.lit(k * per + b)), F.lit(0)).bitwiseAND(mask), b * BITS)
    return F.array(*[reduce(lambda x, y: x.bitwiseOR(y), [part(k, b) for b in range(per)]) for k in range(BINS // per)])


def fingerprint(df: DataFrame, text: str, into: str) -> DataFrame:
    """``df`` with the fingerprint of a text column: struct of ``bits`` (array of long) and ``empty``."""
    d = without(df, "_w", "_h", "_v", "_f", into)
    for name, column in bins(text_of(d, text)).items():
        d = d.withColumn(name, column)
    empty = F.get("_f", F.lit(0)).isNull()
    return d.withColumn(into, F.struct(packed(F.col("_f")).alias("bits"), empty.alias("empty"))).drop("_w", "_h", "_v", "_f")


def as_string(print_: Column) -> Column:
    return F.array_join(F.transform(print_["bits"], lambda x: F.lpad(F.lower(F.hex(x)), 16, "0")), "")


def likeness(a: Column, b: Column) -> Column:
    """Estimated share of common shingles (0 to 1) of two fingerprints."""
    low = 0x0101010101010101
    def differing(x, y):
        z = x.bitwiseXOR(y)
        for shift in (4, 2, 1):  # folds the bits of every byte into its lowest one
            z = z.bitwiseOR(F.shiftrightunsigned(z, shift).bitwiseAND(F.lit(low * ((1 << (8 - shift)) - 1))))
        return F.bit_count(z.bitwiseAND(F.lit(low)))
    n = F.aggregate(F.zip_with(a["bits"], b["bits"], differing), F.lit(0), lambda s, x: s + x)
    chance = 2.0 ** -BITS
    share = (F.lit(BINS) - n) / F.lit(float(BINS))
    estimate = F.greatest(F.lit(0.0), (share - chance) / (1 - chance))
    return F.when(a["empty"] & b["empty"], 1.0).when(a["empty"] | b["empty"], 0.0).otherwise(estimate)


def id_ranges(docs: DataFrame, n_ranges: int) -> Column:
    """The number of a document's range, for ranges of ids that hold about equally many
    documents (split points from approximate quantiles; a null id is in the first)."""
    key = F.col("doc_id")
    shares = [i / n_ranges for i in range(1, n_ranges)]
    cuts = sorted({int(c) for c in docs.where(key.isNotNull()).approxQuantile("doc_id", shares, 0.2 / n_ranges)}) if shares else []
    if not cuts:
        return F.lit(0)
    longs = lambda xs: F.array(*[F.lit(x).cast("long") for x in xs])
    # how many split points are passed: first in steps, then within a step
    step = max(1, int(len(cuts) ** 0.5))
    passed = lambda xs: F.size(F.filter(xs, lambda c: c <= key))
    steps = cuts[step - 1 :: step]
    coarse = passed(longs(steps)) * step
    return F.when(key.isNull(), 0).otherwise(coarse + passed(F.slice(longs(cuts), coarse + 1, F.lit(step))))


def with_next(docs: DataFrame, *names: str) -> DataFrame:
    """``docs`` with ``next_<name>`` for the named columns (the text is ``text``): their
    values in the document of the next higher id.

    Documents are dealt into ranges of ids; each range also gets a copy of the first
    document of the following one, so every document meets its neighbour within its
    range. What reaches the driver are split points and the first id of each range.
    """
    n_ranges = 4 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    d = without(docs, *[f"next_{n}" for n in names], "_range", "_copy", "_at")
    number = id_ranges(d, n_ranges)
    least = d.groupBy(number.alias("r")).agg(F.min(F.struct("doc_id")).alias("k")).collect()  # a row a range
    least = sorted((r["r"], r["k"]["doc_id"]) for r in least)
    if not least:
        return d.select("*", *[d[n].alias(f"next_{n}") for n in names])
    size = least[-1][0] + 1
    first, to = [None] * size, [None] * size
    for k, (r, key) in enumerate(least):
        first[r], to[r] = key, least[k - 1][0]
    longs = lambda xs: F.array(*[F.lit(x).cast("long") for x in xs])
    d = d.withColumn("_range", number)
    place = lambda r, copy: F.struct(r.cast("int").alias("r"), F.lit(copy).alias("copy"))
    is_first = F.col("doc_id").eqNullSafe(F.get(longs(first), F.col("_range")))
    before = F.get(longs(to), F.col("_range"))
    # the very first document follows the last one
    extra = F.when(is_first, F.when(F.col("_range") == least[0][0], place(before, 2)).otherwise(place(before, 1)))
    d = d.withColumn("_at", F.explode(F.array_compact(F.array(place(F.col("_range"), 0), extra))))
    w = Window.partitionBy("_at.r").orderBy((F.col("_at.copy") == 2), F.col("doc_id").asc_nulls_first(), text_of(d), "_at.copy")
    d = d.select(*[c for c in d.columns], *[F.lead(n).over(w).alias(f"next_{n}") for n in names])
    return d.where(F.col("_at.copy") == 0).drop("_range", "_at")


def edited(text: Column, following: Column) -> Column:
    """A text whose last half is replaced by the beginning of another one."""
    n = F.length(text)
    half = F.floor(n / 2).cast("int")
    return F.concat(F.substr(text, F.lit(1), n - half), F.substr(following, F.lit(1), half))
