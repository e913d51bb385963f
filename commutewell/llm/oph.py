"""Document fingerprints by one-permutation MinHash, all in DataFrame expressions.

Every run of five words is hashed once. The hash's top bits name one of ``BINS`` bins, each bin keeps its
least hash. An empty bin takes the value of another one by optimal densification: universal hashes of (bin,
attempt) name bins until one is not empty; after ``ATTEMPTS`` the non-empty bin with the least hash of (bin,
other) is taken, which is the same uniform choice. Only the low ``BITS`` bits of each value are kept, packed as
one hexadecimal digit per bin. Values that agree by chance are corrected for: of bins that differ, one in
2^BITS agrees.

Defined results: a NULL text counts as empty; a text without words has the fingerprint '' and likeness 1 to
another one, 0 to any other text; rows are in order of (doc_id, text), so the document after a repeated row is
its copy; rows without an id follow one another by their text's hash; the only document is followed by itself;
an empty table gives an empty result. Only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

import string
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BINS = 256
BITS = 4
WORDS = 5
ATTEMPTS = 4
BUCKET_ROWS = 512
RANGES = 4096  # quantiles of the ids, at most
_GROUP = 64
_SHIFT = 64 - BINS.bit_length() + 1
_SPACE = " \t\n\x0b\f\r"


def bound(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is computed once: an array of one element binds it to a name."""
    return F.element_at(F.transform(F.array(value), body), 1)


def shingle_hashes(text: Column) -> Column:
    """A 64-bit hash of every run of WORDS words; of fewer words, one of the whole sequence."""
    lower = F.translate(text, string.ascii_uppercase, string.ascii_lowercase)
    words = F.split(F.btrim(lower, F.lit(_SPACE)), r"[\x20\x09-\x0D]+")

    def runs(h: Column) -> Column:
        return F.transform(
            F.sequence(F.lit(0), F.size(h) - WORDS), lambda i: F.xxhash64(*[F.get(h, i + k) for k in range(WORDS)])
        )

    hashed = lambda h: F.when(F.size(h) >= WORDS, runs(h)).otherwise(F.array(F.xxhash64(h)))
    return bound(F.transform(words, lambda w: F.xxhash64(w)), hashed)


def _bin(value: Column) -> Column:
    return F.shiftright(value, _SHIFT)


_FIRST = -BINS // 2  # the hashes are signed, so are the bins
_ENDS = [((b + 1) << _SHIFT) - 1 for b in range(_FIRST, _FIRST + BINS)]  # the greatest value of each bin marks it empty


def minima(hashes: Column) -> Column:
    """The least hash of every bin in bin order; an empty bin has its greatest value."""
    ordered = F.sort_array(F.concat(hashes, F.array(*[F.lit(e).cast("long") for e in _ENDS])))
    first = lambda s: F.filter(s, lambda v, i: (i == 0) | (_bin(v) != _bin(F.get(s, i - 1))))
    return bound(ordered, first)


def densified(least: Column) -> Column:
    """Every empty bin filled from another one."""
    rest = (1 << _SHIFT) - 1
    empty = lambda v: v.bitwiseAND(F.lit(rest)) == rest

    def fill(least: Column) -> Column:
        def at(v: Column, i: Column) -> Column:
            out = F.when(~empty(v), v)
            for attempt in range(ATTEMPTS):
                other = F.get(least, F.pmod(F.xxhash64(i, F.lit(attempt)), F.lit(BINS)).cast("int"))
                out = out.when(~empty(other), other)
            ranked = F.transform(F.filter(least, lambda o: ~empty(o)), lambda o: F.struct(F.xxhash64(i, _bin(o)).alias("h"), o.alias("o")))
            return out.otherwise(F.array_min(ranked)["o"])

        return F.transform(least, at)

    return bound(least, fill)


def fingerprint(text: Column) -> Column:
    """The low bits of every bin; no elements for a text without words."""
    low = lambda v: F.transform(v, lambda x: x.bitwiseAND(F.lit((1 << BITS) - 1)).cast("byte"))
    return F.when(F.btrim(text, F.lit(_SPACE)) == "", F.array().cast("array<byte>")).otherwise(low(densified(minima(shingle_hashes(text)))))


def packed(bits: Column) -> Column:
    return F.array_join(F.transform(bits, lambda b: F.substring(F.lit("0123456789abcdef"), b.cast("int") + 1, F.lit(1))), "")


def likeness(a: Column, b: Column) -> Column:
    """Share of equal bins, less what agrees by chance."""
    equal = F.aggregate(F.zip_with(a, b, lambda x, y: F.when(x == y, 1).otherwise(0)), F.lit(0), lambda s, x: s + x)
    chance = 2.0**-BITS
    estimate = (equal / float(BINS) - chance) / (1 - chance)
    return F.when((F.size(a) == 0) | (F.size(b) == 0), (F.size(a) == F.size(b)).cast("double")).otherwise(
        F.greatest(F.lit(0.0), F.least(F.lit(1.0), estimate))
    )


def _buckets(docs: DataFrame, bucket_rows: int) -> Callable[[Column, Column], tuple[Column, Column]]:
    """The bucket (range, part) of an id and a text.

    Ranges hold about equally many rows, whatever the ids: their ends are quantiles of the ids, at most RANGES of
    them. In a large table a range has several parts of equal widths. Rows without an id are dealt by their text.
    """
    n = docs.count()
    ranges = max(1, min(RANGES, -(-n // bucket_rows)))
    parts = max(1, -(-n // (bucket_rows * ranges)))
    shares = [i / ranges for i in range(1, ranges)]
    ends = docs.agg(
        F.min("doc_id").cast("long").alias("low"), F.max("doc_id").cast("long").alias("high"),
        F.percentile_approx(F.col("doc_id").cast("long"), [0.0, *shares], 10 * RANGES).alias("ends"),
    ).first()
    ends = [] if ends.low is None else [ends.low, *sorted(set(ends.ends[1:]) - {ends.low}), ends.high + 1]
    groups = [ends[i : i + _GROUP] for i in range(0, len(ends), _GROUP)]
    longs = lambda values: F.array(*map(F.lit, values)).cast("array<long>")

    def bucket(doc_id: Column, text: Column) -> tuple[Column, Column]:
        by_text = lambda seed, n: F.pmod(F.xxhash64(text, F.lit(seed)), F.lit(n))
        if not groups:
            return -1 - by_text(0, ranges), by_text(1, parts)
        # Among the firsts of the groups, then within one group: the last end at or below the id.
        up_to = lambda values: F.size(F.filter(values, lambda e: e <= doc_id))
        group = up_to(longs([g[0] for g in groups])) - 1
        place = group * _GROUP + up_to(F.get(F.array(*map(longs, groups)), group)) - 1
        if parts == 1:
            part = F.lit(0)
        else:
            low, high = F.get(longs(ends), place), F.get(longs(ends), place + 1)
            part = F.floor((doc_id - low) / F.greatest(F.lit(1), F.ceil((high - low) / parts)))
        return F.coalesce(place, -1 - by_text(0, ranges)).cast("long"), F.when(doc_id.isNull(), by_text(1, parts)).otherwise(part).cast("long")

    return bucket


def in_order(docs: DataFrame, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """doc_id, text, bits and the next row's text and bits (next_text, next_bits).

    Rows are dealt to buckets of about ``bucket_rows`` ids that follow one another, in one shuffle. Within a bucket
    the next row is a window function away; a bucket's last row gets the first row of the next bucket, one row
    per bucket through a small shuffle. The buckets are put in order range by range; only the at most 2 * RANGES
    ranges are sorted in one place.
    """
    dealt = _buckets(docs, bucket_rows)
    text = F.coalesce(F.col("text"), F.lit(""))
    range_, part = dealt(F.col("doc_id"), text)
    rows = docs.select("doc_id", text.alias("text"), range_.alias("range"), part.alias("part"))
    here = Window.partitionBy("range", "part").orderBy("doc_id", "text")
    firsts = rows.withColumn("nr", F.row_number().over(here)).filter("nr = 1").select("range", "part", F.col("text").alias("first_text"))

    buckets = docs.select(range_.alias("range"), part.alias("part")).distinct()
    in_range = F.lag("part").over(Window.partitionBy("range").orderBy("part"))
    lasts = buckets.groupBy("range").agg(F.max("part").alias("last"))
    everywhere = Window.orderBy("range")
    whole = everywhere.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    kept = F.struct(F.col("range").alias("r"), F.col("last").alias("p"))
    lasts = lasts.select("range", F.coalesce(F.lag(kept).over(everywhere), F.last(kept).over(whole)).alias("earlier"))
    before = buckets.withColumn("earlier_part", in_range).join(lasts, "range").select(
        "range", "part",
        F.when(F.col("earlier_part").isNull(), F.col("earlier.r")).otherwise(F.col("range")).alias("r"),
        F.coalesce("earlier_part", "earlier.p").alias("p"),
    )
    firsts = firsts.join(before, ["range", "part"]).select(
        F.col("r").alias("range"), F.col("p").alias("part"), "first_text", fingerprint(F.col("first_text")).alias("first_bits")
    )
    led = rows.withColumn("bits", fingerprint(F.col("text")))
    led = led.withColumn("next_text", F.lead("text").over(here)).withColumn("next_bits", F.lead("bits").over(here))
    return led.join(firsts, ["range", "part"]).select(
        "doc_id", "text", "bits",
        F.coalesce("next_text", "first_text").alias("next_text"), F.coalesce("next_bits", "first_bits").alias("next_bits"),
    )


def fingerprints(docs: DataFrame) -> DataFrame:
    """Fingerprints of all texts and of their edited forms, with the likeness of neighbours."""
    half = F.floor(F.col("n_chars") / 2).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), F.col("n_chars").cast("int") - half), F.substring("next_text", F.lit(1), half))
    rows = in_order(docs).withColumn("n_chars", F.length("text").cast("long")).withColumn("edited", edited)
    rows = rows.withColumn("edited_bits", fingerprint(F.col("edited")))
    return rows.select(
        "doc_id", "n_chars",
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        packed(F.col("bits")).alias("fingerprint"),
        packed(F.col("edited_bits")).alias("edited_fingerprint"),
        likeness(F.col("bits"), F.col("edited_bits")).alias("near_edited"),
        likeness(F.col("bits"), F.col("next_bits")).alias("near_next"),
    )
