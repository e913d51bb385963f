"""Mixing sources to target weights by Pfair scheduling.

Every source's rows are numbered in a fixed shuffled order and cut to blocks of ``BLOCK_ROWS``. Time runs in
turns, one block each, and in frames of ``FRAME`` turns. A source's turns in a frame are its target weight's share,
rounded up or down; only sources whose share is below one turn get more than it, one turn, from all others in proportion.
Block k of a source with q turns in a frame is released at turn floor(k * FRAME / q) and due before turn
ceil((k + 1) * FRAME / q); in each turn the released block with the earliest deadline goes, ties to the first
source by name. As the turns of all sources fill the frame exactly, no deadline is missed and no source is
ever a whole block away from its share. All of a frame's windows end with it, so frames are alike and can be
filled side by side.

When a source runs out, the rest share its turns by their own weights: a new phase with a schedule of its own
begins. No row is dropped or repeated.

Everything is DataFrame operations. The driver holds one count per source; the schedule is a table of at most
``FRAME`` turns per phase, and there are at most as many phases as sources.

Defined results: NULL is a source of its own; sources without a weight get ``default``; a weight that is not
positive is an error, as are more sources than turns in a frame; repeated rows are placed each; an empty table
gives an empty result; rows come back whole, with extra columns of any name.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

BLOCK_ROWS = 16
FRAME = 10_000
CHUNK_ROWS = 512
MOST_CHUNKS = 65_536
TEMPERATURE = 0.5


def source_key() -> Column:
    """The source's name with a mark before it, so that NULL has a key of its own."""
    return F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit("-"))


def tempered(counts: dict[str, int], temperature: float = TEMPERATURE) -> dict[str, float]:
    """Weights by row counts to a power below 1: small sources are seen more often than their size says."""
    return {key: n**temperature for key, n in counts.items()}


def turns_of(weights: dict[str, float], frame: int = FRAME) -> dict[str, int]:
    """Whole turns of a frame by largest remainder; sources with a share below one turn get one."""
    if any(w <= 0 for w in weights.values()) or len(weights) > frame:
        raise ValueError("weights must be positive, and no more than the turns of a frame")
    given = list(weights.values())
    shared = [w for w in given if (frame - sum(o < w for o in given)) * w >= sum(o for o in given if o >= w)]
    total, turns = sum(shared), frame - (len(given) - len(shared))
    exact = {k: max(1.0, turns * w / total) if w in shared else 1.0 for k, w in weights.items()}
    out = {k: int(x) for k, x in exact.items()}
    for k in sorted(exact, key=lambda k: (int(exact[k]) - exact[k], k))[: frame - sum(out.values())]:
        out[k] += 1
    return out


def phases_of(blocks: dict[str, int], weights: dict[str, float], frame: int = FRAME) -> list[dict]:
    """Phase by phase, every source's turns in a frame, its first block, and the phase's first turn."""
    left, phases, turn = {k: n for k, n in sorted(blocks.items()) if n}, [], 0
    done = dict.fromkeys(left, 0)
    while left:
        turns = turns_of({k: weights[k] for k in left}, frame)
        # Full frames as long as every source can fill its turns, then one frame in which some end.
        frames = 1 + min(left[k] // turns[k] for k in left)
        for k in left:
            phases.append({"phase": len(phases), "key": k, "turns": turns[k], "first": done[k], "turn": turn})
        turn += frames * frame
        for k in list(left):
            used = min(left[k], frames * turns[k])
            done[k], left[k] = done[k] + used, left[k] - used
            if not left[k]:
                del left[k]
    return phases


def _phase_table(spark: SparkSession, phases: list[dict]) -> DataFrame:
    """The phases as rows, from one literal: no more than a line per source and phase."""
    schema = "array<struct<phase:int,key:string,turns:int,first:bigint,turn:bigint>>"
    return spark.range(1).select(F.inline(F.from_json(F.lit(json.dumps(phases)), schema)))


def schedule(phases: DataFrame, frame: int = FRAME) -> DataFrame:
    """(turn, key, k, slot) of one frame of every phase: earliest deadline first among released blocks.

    A fold over the turns of a frame: its state is the next block of each source and the order so far.
    """
    window = lambda k, q: (F.floor(k * frame / q), F.ceil((k + 1) * frame / q))
    jobs = phases.groupBy("turn").agg(F.array_sort(F.collect_list(F.struct("key", "turns"))).alias("sources"))

    def step(state: Column, at: Column) -> Column:
        def candidate(source: Column, i: Column) -> Column:
            k = F.element_at(state["next"], i + 1)
            release, deadline = window(k, source["turns"])
            return F.when((k < source["turns"]) & (release <= at), F.struct(deadline.alias("deadline"), i.alias("i"), k.alias("k")))

        def advanced(best: Column) -> Column:
            return F.struct(
                F.transform(state["next"], lambda k, i: F.when(i == best["i"], k + 1).otherwise(k)).alias("next"),
                F.concat(state["order"], F.array(F.struct(best["i"].alias("i"), best["k"].alias("k"), at.alias("slot")))).alias("order"),
            )

        # The array of one element binds the chosen block to a name, so that it is searched once a turn.
        return F.element_at(F.transform(F.array(F.array_min(F.transform(F.col("sources"), candidate))), advanced), 1)

    start = F.struct(
        F.transform("sources", lambda s: F.lit(0)).alias("next"),
        F.expr("CAST(array() AS array<struct<i:int,k:int,slot:int>>)").alias("order"),
    )
    order = F.aggregate(F.sequence(F.lit(0), F.lit(frame - 1)), start, step, lambda state: state["order"])
    return jobs.select("turn", "sources", F.explode(order).alias("o")).select(
        "turn", F.element_at("sources", F.col("o.i") + 1)["key"].alias("key"), F.col("o.k").alias("k"), F.col("o.slot").alias("slot")
    )


def mix(docs: DataFrame, weights: dict[str | None, float] | None = None, default: float = 1.0, block_rows: int = BLOCK_ROWS, frame: int = FRAME) -> DataFrame:
    """``row`` (the whole row), block, release, deadline, turn and place; the mixed order is by (turn, place).

    Without ``weights``, a source's weight is its number of rows to the power TEMPERATURE.
    """
    spark = docs.sparkSession
    counts = {r.key: r.n for r in docs.groupBy(source_key().alias("key")).agg(F.count("*").alias("n")).collect()}
    if weights is None:
        target = tempered(counts)
    else:
        named = {("-" if k is None else f"={k}"): w for k, w in weights.items()}
        target = {k: named.get(k, default) for k in counts}
    phases = _phase_table(spark, phases_of({k: -(-n // block_rows) for k, n in counts.items()}, target, frame))

    # Rows are numbered in chunks dealt by hash, so a large source is spread over many tasks.
    chunks = min(MOST_CHUNKS, max(1, sum(counts.values()) // CHUNK_ROWS))
    spread = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.col("text"), F.lit("")))
    rows = docs.select(F.struct("*").alias("row"), source_key().alias("key"), "doc_id", spread.alias("spread")).withColumn(
        "chunk", F.pmod(F.conv(F.substring("spread", 1, 8), 16, 10).cast("long"), F.lit(chunks)).cast("int")
    )
    sizes = rows.groupBy("key", "chunk").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy("key").orderBy("chunk")) - F.col("n")
    numbered = rows.withColumn("nr", F.row_number().over(Window.partitionBy("key", "chunk").orderBy("spread", "doc_id")) - 1)
    numbered = numbered.join(sizes.select("key", "chunk", before.alias("before")), ["key", "chunk"])
    numbered = numbered.withColumn("nr", F.col("nr") + F.col("before")).withColumn("block", F.floor(F.col("nr") / block_rows))

    # One line per source: its phases in order. The last one that starts at or before a block is the block's own.
    courses = phases.groupBy("key").agg(F.array_sort(F.collect_list(F.struct("first", "turn", "turns"))).alias("course"))
    current = F.element_at(F.filter("course", lambda p: p["first"] <= F.col("block")), -1)
    timed = numbered.join(F.broadcast(courses), "key").withColumn("now", current)
    inside = F.col("block") - F.col("now.first")
    timed = timed.select(
        "row", "key", "block", (F.col("nr") - F.col("block") * block_rows).cast("int").alias("place"),
        F.col("now.turn").alias("start"), F.col("now.turns").alias("q"),
        F.floor(inside / F.col("now.turns")).alias("f"), (inside % F.col("now.turns")).cast("int").alias("k"),
    )
    plan = schedule(phases, frame).select(F.col("turn").alias("start"), "key", "k", "slot")
    base = F.col("start") + F.col("f") * frame
    return timed.join(F.broadcast(plan), ["start", "key", "k"]).select(
        "row", "block",
        (base + F.floor(F.col("k") * frame / F.col("q"))).alias("release"),
        (base + F.ceil((F.col("k") + 1) * frame / F.col("q"))).alias("deadline"),
        (base + F.col("slot")).alias("turn"), "place",
    )


def mixed_rows(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` in mixed order: files and rows follow the schedule."""
    placed = mix(docs)
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return placed.repartitionByRange(parts, "turn", "place").sortWithinPartitions("turn", "place").select("row.*")
