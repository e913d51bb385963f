"""Near-duplicate groups by MinHash.

1. Every text gives its set of distinct shingles of ``SHINGLE`` words (64-bit hashes), ``BANDS * ROWS`` minima
   of universal hash functions, and one key per band. Texts with the same set form a class; only classes go on.
2. In each band, classes with the same key form a bucket. Each is paired with the smallest of its bucket.
3. A pair's signatures are compared, and what passes is confirmed on the full sets.
4. A bucket whose members are not all connected by then is not settled: two members may be linked without
   being linked to its smallest one. Such buckets are joined to clusters, clusters are cut to blocks of bounded
   size, and pairs of blocks are compared inside tasks. Pairs within one component are skipped; only links
   that join two components come out.
5. Components come from alternating large-star and small-star.

A link of similarity 0.75 shares no band with probability (1 - 0.75^4)^32 = 5e-6. The signature test lets
pass what lies five deviations below the threshold. No bucket, cluster or partner list is capped.

Defined results: a text without words (or NULL) has no shingles and is linked with nothing; repeated rows are
members of one class; a row without an id links others like any other, but is never kept and names no component;
no rows give no rows; only
``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from commutewell.llm.common import ascii_words, stored
from commutewell.llm.components import components

SHINGLE = 5
BANDS, ROWS = 32, 4
HASHES = BANDS * ROWS
SHARED, OF = 75, 100  # linked: OF * intersection >= SHARED * union
PASS = SHARED / OF - 5 * (SHARED / OF * (1 - SHARED / OF) / HASHES) ** 0.5
BLOCK_CLASSES, BLOCK_SHINGLES = 128, 250_000


# --- Shingles and signatures of one text ----------------------------------------------------------


def _mixed(x: np.ndarray) -> np.ndarray:
    for _ in range(2):
        x ^= x >> np.uint64(32)
        x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    return x


def shingles(text: str | None) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the runs of SHINGLE words; of fewer words, the whole sequence."""
    import xxhash

    words = ascii_words(text)
    if not words:
        return np.empty(0, np.uint64)
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    size = min(SHINGLE, len(words))
    runs = np.zeros(len(words) - size + 1, np.uint64)
    for i in range(size):
        runs = _mixed(runs * np.uint64(0x9E3779B97F4A7C15) + hashes[i : i + len(runs)] + np.uint64(1))
    return np.unique(runs)


_RNG = np.random.default_rng(20)
_A = _RNG.integers(0, 2**63, HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_B = _RNG.integers(0, 2**63, HASHES, dtype=np.uint64)


def minima(runs: np.ndarray) -> np.ndarray:
    """The least value of each universal hash function (multiply and shift) over a set that isn't empty."""
    out = np.full(HASHES, 2**32 - 1, np.uint64)
    for at in range(0, len(runs), 1024):
        np.minimum(out, ((runs[at : at + 1024, None] * _A + _B) >> np.uint64(32)).min(axis=0), out=out)
    return out.astype("<u4")


def band_keys(signature: np.ndarray) -> np.ndarray:
    keys = np.arange(1, BANDS + 1, dtype=np.uint64)
    for column in signature.reshape(BANDS, ROWS).T:
        keys = _mixed(keys * np.uint64(0x9E3779B97F4A7C15) + column)
    return keys.view(np.int64)


def set_key(runs: np.ndarray) -> bytes | None:
    import xxhash

    return xxhash.xxh3_128_digest(runs.tobytes()) if len(runs) else None


def linked(a: np.ndarray, b: np.ndarray) -> bool:
    if min(len(a), len(b)) * OF < SHARED * max(len(a), len(b)):
        return False
    both = len(np.intersect1d(a, b, assume_unique=True))
    return OF * both >= SHARED * (len(a) + len(b) - both)


# --- Steps ----------------------------------------------------------------------------------------


def row_key() -> Column:
    """Names a row by its id and text, so that rows without an id and texts under one id are told apart."""
    text = F.coalesce("text", F.lit(""))
    return F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("-")), F.xxhash64("text").cast("string"), F.octet_length(text).cast("string"))


def sketches(docs: DataFrame) -> DataFrame:
    """doc_id, row_key, n_shingles, set_key and bands (NULL without words) of every row."""
    schema = T.StructType([docs.schema["doc_id"], *T.StructType.fromDDL("row_key string, n_shingles long, set_key binary, bands array<long>")])

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, keys, bands = [], [], []
            for text in batch.column(1):
                runs = shingles(text.as_py())
                counts.append(len(runs))
                keys.append(set_key(runs))
                bands.append(band_keys(minima(runs)) if len(runs) else None)
            columns = [batch.column(0), batch.column(2), pa.array(counts, pa.int64()), pa.array(keys, pa.binary()), pa.array(bands, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return docs.select("doc_id", "text", row_key().alias("row_key")).mapInArrow(sketch, schema)


def classes_of(sketch: DataFrame) -> DataFrame:
    """One row per distinct set: cnum (a number), set_key, bands, and id (if any row has one) and key of its first row."""
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("doc"), F.col("row_key").alias("key")))
    return (
        sketch.filter("set_key IS NOT NULL")
        .groupBy("set_key")
        .agg(first.alias("first"), F.first("bands").alias("bands"))
        .select("set_key", "bands", F.col("first.doc").alias("first_doc"), F.col("first.key").alias("first_key"))
        .withColumn("cnum", F.monotonically_increasing_id())
    )


def bucket_members(classes: DataFrame) -> DataFrame:
    """band, cnum and the smallest cnum (head) of every bucket with more than one class."""
    bands = classes.select(F.explode("bands").alias("band"), "cnum")
    heads = bands.groupBy("band").agg(F.min("cnum").alias("head"), F.count("*").alias("n")).filter("n > 1").drop("n")
    return bands.join(stored(heads, "heads"), "band")


def full_sets(docs: DataFrame, classes: DataFrame, members: DataFrame) -> DataFrame:
    """cnum, n, signature and shingles of every class in ``members``, from the text of its first row."""
    wanted = classes.join(members.select("cnum").distinct(), "cnum", "left_semi").select(
        "cnum", "set_key", F.col("first_key").alias("row_key")
    )
    # Repeated rows have one key: each text once.
    texts = docs.select(row_key().alias("row_key"), "text").join(wanted, "row_key").groupBy("row_key", "cnum", "set_key", "text").agg(F.lit(0))

    def expand(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for cnum, key, text in zip(*(batch.column(c) for c in ("cnum", "set_key", "text"))):
                runs = shingles(text.as_py())
                if set_key(runs) == key.as_py():
                    rows.append((cnum.as_py(), len(runs), minima(runs).tobytes(), runs.tobytes()))
            columns = list(zip(*rows)) or [(), (), (), ()]
            types = (pa.int64(), pa.int64(), pa.binary(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=["cnum", "n", "signature", "runs"])

    return texts.mapInArrow(expand, "cnum long, n long, signature binary, runs binary")


def confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (u, v) whose signatures pass and whose full sets are linked."""
    a = sets.select(F.col("cnum").alias("u"), F.col("signature").alias("su"), F.col("runs").alias("ru"))
    b = sets.select(F.col("cnum").alias("v"), F.col("signature").alias("sv"), F.col("runs").alias("rv"))

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            signature = lambda c: np.frombuffer(b"".join(batch.column(c).to_pylist()), "<u4").reshape(-1, HASHES)  # noqa: E731,B023
            alike = np.nonzero((signature("su") == signature("sv")).mean(axis=1) >= PASS)[0]
            runs = lambda c, i: np.frombuffer(batch.column(c)[int(i)].as_buffer(), np.uint64)  # noqa: E731,B023
            keep = [int(i) for i in alike if linked(runs("ru", i), runs("rv", i))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(c).take(pa.array(keep, pa.int64())) for c in ("u", "v")], names=["u", "v"]
            )

    return pairs.join(a, "u").join(b, "v").select("u", "v", "su", "ru", "sv", "rv").mapInArrow(verify, "u long, v long")


def unsettled(members: DataFrame, component: DataFrame) -> DataFrame:
    """band, cnum, head and group (component so far) of the buckets that hold more than one component."""
    placed = stored(
        members.join(component.select(F.col("node").alias("cnum"), "component"), "cnum", "left").select(
            "band", "cnum", "head", F.coalesce("component", "cnum").alias("group")
        ),
        "placed",
    )
    mixed = placed.groupBy("band").agg(F.min("group").alias("a"), F.max("group").alias("b")).filter("a <> b").select("band")
    return placed.join(stored(mixed, "mixed"), "band")


def cross_links(open_members: DataFrame, sets: DataFrame) -> DataFrame:
    """Links between different components of the same cluster of unsettled buckets.

    A cluster is cut by hash to blocks; every unordered pair of blocks is a cell of its own, so memory is
    bounded by two blocks. In a cell, a link that its own earlier links imply is not tested.
    """
    cluster = components(open_members.select(F.col("cnum").alias("u"), F.col("head").alias("v")))
    nodes = stored(
        open_members.select("cnum", "group").distinct().join(cluster.withColumnRenamed("node", "cnum"), "cnum").join(sets.select("cnum", "n").distinct(), "cnum"),
        "clusters",
    )
    widths = nodes.groupBy("component").agg(
        F.ceil(F.greatest(F.count("*") / BLOCK_CLASSES, F.sum("n") / BLOCK_SHINGLES)).cast("int").alias("width")
    )
    block = F.pmod(F.xxhash64("cnum"), F.col("width")).cast("int")
    cells = (
        nodes.join(stored(widths, "widths"), "component")
        .select("component", "cnum", "group", block.alias("block"), F.explode(F.sequence(F.lit(0), F.col("width") - 1)).alias("other"))
        .select("component", "cnum", "group", "block", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"))
    )

    def compare(key, frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.drop_duplicates("cnum").sort_values("cnum")
        i, j = key[1], key[2]
        numbers, block = frame["cnum"].to_numpy(), frame["block"].to_numpy()
        parent = {g: g for g in frame["group"]}

        def root(x):
            while parent[x] != x:
                parent[x] = parent[parent[x]]
                x = parent[x]
            return x

        groups = frame["group"].tolist()
        signatures = np.frombuffer(b"".join(frame["signature"]), "<u4").reshape(-1, HASHES)
        runs = [np.frombuffer(r, np.uint64) for r in frame["runs"]]
        left = np.nonzero(block == i)[0]
        right = np.nonzero(block == j)[0]
        found = []
        for a in left:
            others = right[right > a] if i == j else right
            alike = others[(signatures[others] == signatures[a]).mean(axis=1) >= PASS]
            for b in alike:
                x, y = root(groups[a]), root(groups[b])
                if x != y and linked(runs[a], runs[b]):
                    parent[x] = y
                    found.append((numbers[a], numbers[b]))
        return pd.DataFrame(found, columns=["u", "v"], dtype="int64")

    return cells.join(sets, "cnum").groupBy("component", "i", "j").applyInPandas(compare, "u long, v long")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id and kept of every row of ``docs``, with its row_key and group (NULL without words)."""
    sketch = stored(sketches(docs), "sketches")
    classes = stored(classes_of(sketch), "classes")
    members = stored(bucket_members(classes), "members")
    sets = stored(full_sets(docs, classes, members), "sets")
    pairs = members.filter("cnum <> head").select(F.col("cnum").alias("u"), F.col("head").alias("v")).distinct()
    links = stored(confirmed(pairs, sets), "links")
    settled = stored(components(links), "components")
    more = cross_links(stored(unsettled(members, settled), "unsettled"), sets)
    # What is settled already is a star; with the cross links it gives the final components.
    links = stored(settled.select(F.col("node").alias("u"), F.col("component").alias("v")).unionByName(more), "all-links")
    final = stored(components(links), "components")
    labels = classes.select("cnum", "set_key", "first_doc").join(final.withColumnRenamed("node", "cnum"), "cnum", "left")
    labels = stored(labels.withColumn("component", F.coalesce("component", "cnum")), "labels")
    least = stored(labels.groupBy("component").agg(F.min("first_doc").alias("component_id")), "least")
    named = stored(labels.join(least, "component").select("set_key", "component_id", F.col("component").alias("group")), "named")
    return sketch.join(named, "set_key", "left").select(
        "doc_id",
        "n_shingles",
        F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"),
        "row_key",
        "group",
    ).select(
        "doc_id", "n_shingles", "component_id", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)).alias("kept"), "row_key", "group"
    )


def one_per_group(docs: DataFrame, result: DataFrame) -> DataFrame:
    """One row of every group in ``result``, all columns of ``docs``; texts without words all stay, a repeated row once.

    The row with the smallest id stays, of a group without ids any text of it. Rows are named by id and text, so a
    text that shares its id with another one stands for itself.
    """
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row_key")).alias("first")
    winners = result.filter("group IS NOT NULL").groupBy("group").agg(first).select("first.row_key")
    wordless = result.filter("group IS NULL").select("row_key").distinct()
    rows = docs.select(row_key().alias("row_key"), F.struct("*").alias("row"))
    kept = rows.join(stored(winners.unionByName(wordless), "kept"), "row_key").groupBy("row_key").agg(F.first("row").alias("row"))
    return kept.select("row.*")
