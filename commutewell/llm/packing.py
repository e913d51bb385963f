"""Best-fit packing of token pieces by a grouping genetic algorithm on islands.

Documents become token ids and are cut to at most ``CAPACITY`` tokens; a piece of full length is a sequence
of its own. All other pieces are dealt into blocks of about ``BLOCK_ITEMS``: by hash, or, where the order of the
documents counts, in runs that follow one another (``in_order``). A block is bred on
``ISLANDS`` islands, each a task of its own: crossover injects whole well-filled bins of one parent into the
other, bins that would hold a piece twice are dissolved, and the displaced pieces go where they fit best.
Between epochs every island sends its elite to the next one. The best packing of a block wins; bins it fills
badly are pooled over all blocks and bred once more. With ``in_order`` only ``POOLED`` blocks in a row share a pool, and
``sequence_id`` rises with the place of the documents: any stretch of sequences holds documents of one stretch,
to about ``POOLED`` blocks.

No task sees more than a block, and the driver only sees counts.

Defined results: a NULL or empty text is the single end id; repeated rows are packed each; ties between equal
packings go to the lower island; an empty table gives an empty result; only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

import random
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from commutewell.llm.common import stored

CAPACITY = 2048
END_ID = 0
BLOCK_ITEMS = 2048
POOLED = 4  # blocks in a row
ISLANDS = 2
EPOCHS = 2
POPULATION = 6
CHILDREN = 8  # bred on an island in one epoch
ELITE = 2
WELL_FILLED = 0.98
SPECIAL = "<|endoftext|>"

_INDIVIDUAL = (
    "block long, island int, rank int, bins int, squares double, row_ids array<long>, lengths array<int>, bin_of array<int>"
)


# --- Tokens and pieces ----------------------------------------------------------------------------


def encoder(path: str | None = None):
    """Byte-level BPE from a rank file; the same ids as the JSON form of that vocabulary, at a third of its time."""
    import base64

    import public_tokenizers
    import tiktoken

    with open(path or public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
    return tiktoken.Encoding(
        "byte_bpe", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={SPECIAL: len(ranks)}
    )


def token_ids(encode, text: str | None) -> np.ndarray:
    ids = encode.encode_to_numpy(text, allowed_special="all") if text else ()
    return np.append(np.asarray(ids, "<u4"), np.uint32(END_ID)).astype("<u4")


def cuts(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of ``n`` ids: full pieces, before them what is left over."""
    first = n % capacity or min(n, capacity)
    return [(0, first), *((start, capacity) for start in range(first, n, capacity))]


def pieces(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY, file: Column | None = None, row: Column | None = None) -> DataFrame:
    """doc_id, piece, start, length and ids_crc32 of every piece, with the document's file and row where they are given."""
    names = ["doc_id", "piece", "start", "length", "ids_crc32", "file", "row"]
    schema = T.StructType([docs.schema["doc_id"], *T.StructType.fromDDL("piece int, start long, length long, ids_crc32 long, file string, row long")])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path)
        for batch in batches:
            ids, rows = [], []
            for doc_id, text, file_, row_ in zip(batch.column(0).to_pylist(), batch.column(1), *(batch.column(c).to_pylist() for c in (2, 3))):
                tokens = token_ids(encode, text.as_py())
                for k, (start, length) in enumerate(cuts(len(tokens), capacity)):
                    ids.append(doc_id)
                    rows.append((k, start, length, zlib.crc32(tokens[start : start + length].tobytes()), file_, row_))
            columns = list(zip(*rows)) or [()] * 6
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(ids, batch.schema.field(0).type),
                    pa.array(columns[0], pa.int32()),
                    *(pa.array(c, pa.int64()) for c in columns[1:4]),
                    pa.array(columns[4], pa.string()),
                    pa.array(columns[5], pa.int64()),
                ],
                names=names,
            )

    none = F.lit(None)
    file, row = none if file is None else file, none if row is None else row
    cut_ = docs.select("doc_id", "text", file.cast("string").alias("file"), row.cast("long").alias("row")).mapInArrow(cut, schema)
    return cut_ if file is not none else cut_.drop("file", "row")


def in_rows(cut: DataFrame, chunk: int = 1024) -> DataFrame:
    """``cut`` with row_id, gapless from 0, by file, row and piece. Rows are counted in chunks of a file."""
    cut = cut.withColumn("chunk", F.floor(F.col("row") / chunk))
    sizes = cut.groupBy("file", "chunk").agg(F.count("*").alias("n"))
    files = sizes.groupBy("file").agg(F.sum("n").alias("all"))
    # One line per file, then one per chunk of a file.
    ahead = files.select("file", (F.sum("all").over(Window.orderBy("file")) - F.col("all")).alias("ahead"))
    inside = F.sum("n").over(Window.partitionBy("file").orderBy("chunk")) - F.col("n")
    starts = sizes.select("file", "chunk", inside.alias("inside")).join(ahead, "file")
    starts = starts.select("file", "chunk", (F.col("ahead") + F.col("inside")).alias("first"))
    nr = F.row_number().over(Window.partitionBy("file", "chunk").orderBy("row", "piece")) - 1
    return cut.withColumn("nr", nr).join(starts, ["file", "chunk"]).withColumn("row_id", F.col("first") + F.col("nr")).drop("file", "row", "chunk", "first", "nr")


# --- One island -----------------------------------------------------------------------------------

Bins = list[list[int]]


def best_fit(order, sizes, bins: Bins, capacity: int) -> Bins:
    """``bins`` with the items of ``order`` added, each where the least room stays."""
    room = sorted((capacity - sum(sizes[i] for i in b), n) for n, b in enumerate(bins))
    bins = [list(b) for b in bins]
    for item in order:
        at = bisect_left(room, (sizes[item], -1))
        if at == len(room):
            left, n = capacity, len(bins)
            bins.append([])
        else:
            left, n = room.pop(at)
        bins[n].append(item)
        insort(room, (left - sizes[item], n))
    return bins


def fitness(bins: Bins, sizes, capacity: int) -> tuple[int, float]:
    """Larger is better: fewer bins first, then bins that are either full or nearly empty."""
    return -len(bins), sum((sum(sizes[i] for i in b) / capacity) ** 2 for b in bins)


def crossover(mother: Bins, father: Bins, sizes, capacity: int, rng: random.Random) -> Bins:
    """The mother with some of the father's best bins as a whole."""
    ranked = sorted(father, key=lambda b: -sum(sizes[i] for i in b))
    donors = [b for b in ranked[: max(1, len(ranked) // 2)] if rng.random() < 0.5] or ranked[:1]
    injected = {i for b in donors for i in b}
    kept, displaced = [], []
    for b in mother:
        if injected.isdisjoint(b):
            kept.append(b)
        else:
            displaced += [i for i in b if i not in injected]
    kept.sort(key=lambda b: sum(sizes[i] for i in b))
    for b in kept[: rng.randint(0, 3)]:  # mutation: the emptiest bins are dissolved
        displaced += b
        kept = kept[1:]
    displaced.sort(key=lambda i: -sizes[i])
    return best_fit(displaced, sizes, donors + kept, capacity)


def founders(sizes, capacity: int, rng: random.Random) -> list[Bins]:
    """Best fit over falling sizes, then over more and more shuffled orders."""
    out = []
    for k in range(POPULATION):
        order = sorted(range(len(sizes)), key=lambda i: -sizes[i] * (1 + 0.1 * k * rng.random()))
        out.append(best_fit(order, sizes, [], capacity))
        if len(out[-1]) == -(-sum(sizes) // capacity):
            break  # no packing has fewer bins
    return out


def bred(population: list[Bins], sizes, capacity: int, rng: random.Random) -> list[Bins]:
    score = lambda bins: fitness(bins, sizes, capacity)
    least = -(-sum(sizes) // capacity)
    population = sorted(population, key=score, reverse=True)
    for _ in range(CHILDREN):
        if len(population) < 2 or len(population[0]) <= least:
            break
        mother, father = rng.sample(population, 2)
        population.append(crossover(mother, father, sizes, capacity, rng))
        population = sorted(population, key=score, reverse=True)[:POPULATION]
    return population


def _individuals(block, island, ids, sizes, population, capacity) -> pd.DataFrame:
    rows = []
    for rank, bins in enumerate(population):
        bin_of = np.empty(len(sizes), np.int32)
        for n, b in enumerate(bins):
            bin_of[b] = n
        count, squares = fitness(bins, sizes, capacity)
        rows.append((block, island, rank, -count, squares, ids, sizes, bin_of))
    return pd.DataFrame(rows, columns=["block", "island", "rank", "bins", "squares", "row_ids", "lengths", "bin_of"])


# --- Islands in Spark -----------------------------------------------------------------------------


def packed(items: DataFrame, capacity: int = CAPACITY, block_items: int = BLOCK_ITEMS, in_order: bool = False, pool: Column | None = None) -> DataFrame:
    """row_id, block, bin, offset and fill for every (row_id, length) of ``items``; ``pool`` are the blocks, if given."""
    blocks = max(1, -(-items.count() // block_items))
    block = F.pmod(F.xxhash64("row_id"), F.lit(blocks))
    if pool is not None:
        block = pool
    elif in_order and blocks > 1:
        # Runs of row_id with about as many items each: counted in fine steps, then cut. One line per step.
        ends = items.agg(F.min("row_id").alias("low"), F.max("row_id").alias("high")).first()
        step = F.floor((F.col("row_id") - ends.low) / max(1, (ends.high - ends.low) // (blocks * 32)))
        steps = items.groupBy(step.alias("step")).agg(F.count("*").alias("n"))
        run = F.floor((F.sum("n").over(Window.orderBy("step")) - F.col("n")) / block_items)
        items = items.withColumn("step", step).join(steps.select("step", run.alias("run")), "step").drop("step")
        block = F.col("run")

    def settle(key, frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("row_id")
        block, island = int(key[0]), int(key[1])
        ids, sizes = frame["row_id"].to_numpy(), frame["length"].astype(int).tolist()
        rng = random.Random(f"{block}-{island}")
        return _individuals(block, island, ids, sizes, bred(founders(sizes, capacity, rng), sizes, capacity, rng), capacity)

    def evolve(epoch):
        def of(key, frame: pd.DataFrame) -> pd.DataFrame:
            frame = frame.sort_values(["bins", "squares", "home", "rank"])
            block, island = int(key[0]), int(key[1])
            ids, sizes = np.asarray(frame["row_ids"].iloc[0]), [int(x) for x in frame["lengths"].iloc[0]]
            population = []
            for bin_of in frame["bin_of"]:
                bins: Bins = [[] for _ in range(max(bin_of) + 1)]
                for i, n in enumerate(bin_of):
                    bins[n].append(i)
                population.append(bins)
            rng = random.Random(f"{block}-{island}-{epoch}")
            return _individuals(block, island, ids, sizes, bred(population, sizes, capacity, rng), capacity)

        return of

    population = (
        items.withColumn("block", block)
        .withColumn("island", F.explode(F.array(*map(F.lit, range(ISLANDS)))))
        .groupBy("block", "island")
        .applyInPandas(settle, _INDIVIDUAL)
    )
    for epoch in range(1, EPOCHS):
        population = stored(population, f"islands-{epoch}").withColumn("home", F.col("island"))
        migrants = population.filter(F.col("rank") < ELITE).withColumn("island", (F.col("island") + 1) % ISLANDS)
        population = population.unionByName(migrants).groupBy("block", "island").applyInPandas(evolve(epoch), _INDIVIDUAL)
    best = Window.partitionBy("block").orderBy("bins", F.desc("squares"), "island", "rank")
    item = F.explode(F.arrays_zip("row_ids", "bin_of", "lengths")).alias("item")
    in_bin = Window.partitionBy("block", "bin")
    return (
        population.withColumn("place", F.row_number().over(best))
        .filter("place = 1")
        .select("block", item)
        .select("block", F.col("item.row_ids").alias("row_id"), F.col("item.bin_of").alias("bin"), F.col("item.lengths").cast("long").alias("length"))
        .withColumn("offset", F.sum("length").over(in_bin.orderBy("row_id")) - F.col("length"))
        .withColumn("fill", F.sum("length").over(in_bin))
    )


def pack(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY, block_items: int = BLOCK_ITEMS, in_order: bool = False) -> DataFrame:
    """Every piece of ``docs`` with the sequence that holds it and its place there.

    With ``in_order``, ``docs`` are files whose names and rows are in the order that the sequences are to follow.
    """
    if in_order:
        cut = pieces(docs, path, capacity, F.col("_metadata.file_name"), F.col("_metadata.row_index"))
        cut = stored(in_rows(stored(cut, "cut")), "pieces")
    else:
        cut = stored(pieces(docs, path, capacity).withColumn("row_id", F.monotonically_increasing_id()), "pieces")
    short = cut.filter(F.col("length") < capacity).select("row_id", "length")
    first = stored(packed(short, capacity, block_items, in_order), "packed")
    well = F.col("fill") >= int(WELL_FILLED * capacity)
    pool = F.floor(F.col("home") / POOLED) if in_order else None
    again = packed(first.filter(~well).select("row_id", "length", F.col("block").alias("home")), capacity, block_items, in_order, pool)
    columns = ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    alone = cut.filter(F.col("length") >= capacity)
    zero = F.lit(0).cast("long").alias("offset")
    if in_order:
        # A sequence stands at its first piece, which no other sequence holds.
        home = lambda *bin_: F.min("row_id").over(Window.partitionBy(*bin_)).alias("sequence_id")
        places = first.filter(well).select("row_id", home("block", "bin"), "offset").unionByName(again.select("row_id", home("block", "bin"), "offset"))
        alone = alone.select("*", F.col("row_id").alias("sequence_id"), zero)
    else:
        number = lambda turn: F.shiftleft(F.col("block"), 21) * 2 + F.col("bin") * 2 + turn
        places = first.filter(well).select("row_id", number(0).alias("sequence_id"), "offset").unionByName(
            again.select("row_id", number(1).alias("sequence_id"), "offset")
        )
        alone = alone.select("*", (-1 - F.col("row_id")).alias("sequence_id"), zero)
    return cut.join(places, "row_id").select(columns).unionByName(alone.select(columns))
