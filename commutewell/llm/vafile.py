"""Exact top-k search with vector-approximation files.

Vectors become whole numbers, floor(64 * x). Every dimension's range is cut to ``CELLS`` cells; an approximation
holds one cell number per dimension. Rows are dealt by hash to data blocks and, where they are queries, to query
blocks; each pair of blocks is a task of its own, bounded in size. There the approximations are scanned for
an upper and a lower bound of every inner product. A query's exact vectors are then read in the order of their
upper bounds, until the next bound is below the kth score found. The blocks' answers meet in a top-k per query
that is cut before its shuffle.

Bounds are floats, widened by what rounding can amount to; products of exact vectors are whole numbers, computed in
64 bits where they surely fit and with unlimited digits elsewhere.

Defined results: vectors that are NULL, empty, or hold a NULL or non-finite component take no part, nor do rows
without an id; every other row is a candidate, and a query if its id says so, also where ids are repeated; only a
query's own row is none of its candidates; a score beyond 64 bits is given as 2^63 - 1 with its sign; vectors are
compared with those of the same length only; ties go to the smaller id; fewer than k candidates are all returned.
Only ``vec_id`` and ``embedding`` are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from commutewell.llm.common import stored

SCALE = 64
LONG = 2**63 - 1
ROUNDING = 2.0**-50  # above the relative error of one float operation, with room for the bounds' own
CELLS = 32
TOP = 20
DATA_BLOCK = 4096
QUERY_BLOCK = 1024
READ = 64  # exact vectors read at a time


def whole_vectors(vectors: DataFrame) -> DataFrame:
    """row (a number), vec_id, dims and v (whole numbers as little-endian doubles) of the rows that take part."""

    def convert(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, dims, out = [], [], []
            for vec_id, vector in zip(batch.column(0).to_pylist(), batch.column(1)):
                values = vector.values
                if vec_id is None or values is None or not len(values) or values.null_count:
                    continue
                x = np.floor(SCALE * values.to_numpy(zero_copy_only=False).astype(np.float64))
                if np.isfinite(x).all():
                    ids.append(vec_id)
                    dims.append(len(x))
                    out.append(x.astype("<f8").tobytes())
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(dims, pa.int32()), pa.array(out, pa.binary())], names=["vec_id", "dims", "v"]
            )

    rows = vectors.select(F.col("vec_id").cast("long"), "embedding").mapInArrow(convert, "vec_id long, dims int, v binary")
    return rows.withColumn("row", F.monotonically_increasing_id())


def ranges(whole: DataFrame) -> DataFrame:
    """dims with the least and greatest value of each dimension, one row per vector length."""

    def span(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = np.asarray(batch.column(0))
            for n in np.unique(dims):
                x = _matrix([batch.column(1)[int(i)].as_py() for i in np.nonzero(dims == n)[0]])
                lows, highs = x.min(axis=0), x.max(axis=0)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([int(n)] * int(n), pa.int32()), pa.array(range(n), pa.int32()), pa.array(lows), pa.array(highs)],
                    names=["dims", "at", "low", "high"],
                )

    spans = whole.select("dims", "v").mapInArrow(span, "dims int, at int, low double, high double")
    per_dim = spans.groupBy("dims", "at").agg(F.min("low").alias("low"), F.max("high").alias("high"))
    in_order = F.array_sort(F.collect_list(F.struct("at", "low", "high")))
    return per_dim.groupBy("dims").agg(in_order.alias("s")).select("dims", F.col("s.low").alias("low"), F.col("s.high").alias("high"))


def _matrix(vectors: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(vectors), "<f8").reshape(len(vectors), -1)


def _width(low: np.ndarray, high: np.ndarray) -> np.ndarray:
    return np.maximum(1.0, np.ceil((high - low + 1) / CELLS))


def approximations(whole: DataFrame) -> DataFrame:
    """``whole`` with the cell number of each dimension (cells) and what the numbers mean (low, width)."""

    def quantise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cells, widths = [], []
            for v, low, high in zip(*(batch.column(c) for c in ("v", "low", "high"))):
                low, high = (np.asarray(x.values) for x in (low, high))
                width = _width(low, high)
                cell = np.floor((np.frombuffer(v.as_py(), "<f8") - low) / width)
                cells.append(np.clip(cell, 0, CELLS - 1).astype(np.uint8).tobytes())
                widths.append(width)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("row", "vec_id", "dims", "v", "low")), pa.array(widths, pa.list_(pa.float64())), pa.array(cells, pa.binary())],
                names=["row", "vec_id", "dims", "v", "low", "width", "cells"],
            )

    known = whole.join(ranges(whole), "dims").select("row", "vec_id", "dims", "v", "low", "high")
    return known.mapInArrow(quantise, "row long, vec_id long, dims int, v binary, low array<double>, width array<double>, cells binary")


def products(vectors: np.ndarray, query: np.ndarray) -> np.ndarray:
    """The inner products of whole vectors with ``query``, exact; beyond 64 bits 2^63 - 1 with the sign."""
    if np.abs(vectors).max(initial=0) * np.abs(query).max(initial=0) * len(query) < 2.0**62:
        return vectors.astype(np.int64) @ query.astype(np.int64)
    whole = [int(y) for y in query]
    exact = (sum(int(x) * y for x, y in zip(v, whole)) for v in vectors)
    return np.array([max(-LONG, min(LONG, s)) for s in exact], np.int64)


def search_block(rows, ids, vectors, cells, low, width, query_rows, queries, k: int) -> list[tuple[int, int, int]]:
    """(query's row, vec_id, score) of the k best of one data block for each query of one query block."""
    floor = low + cells.astype(np.float64) * width
    slack = ROUNDING * (np.abs(floor) + CELLS * width + np.abs(low))
    floor, ceiling = floor - slack, floor + width + slack
    largest = np.maximum(np.abs(floor), np.abs(ceiling)).max(axis=1)
    out = []
    for at in range(0, len(queries), 128):
        part = queries[at : at + 128]
        up, down = np.maximum(part, 0), np.minimum(part, 0)
        error = ROUNDING * (part.shape[1] + 2) * np.outer(np.abs(part).sum(axis=1), largest)
        upper = up @ ceiling.T + down @ floor.T + error
        lower = up @ floor.T + down @ ceiling.T - error
        for n, query_row in enumerate(query_rows[at : at + 128]):
            # The scan: what lies below the kth lower bound can't be an answer. One more, as the query's own row is no
            # candidate. Bounds beyond 64 bits are cut as scores are.
            low_n, high_n = np.clip(lower[n], -(2.0**63), 2.0**63), np.clip(upper[n], -(2.0**63), 2.0**63)
            certain = np.partition(low_n, -(k + 1))[-(k + 1)] if len(ids) > k + 1 else -np.inf
            near = np.nonzero((high_n >= certain) & (rows != query_row))[0]
            near = near[np.argsort(-upper[n][near], kind="stable")]
            bounds = upper[n][near]
            scores, read = np.empty(0, np.int64), 0
            while read < len(near):
                exact = products(vectors[near[read : read + READ]], queries[at + n])
                scores, read = np.append(scores, exact), read + READ
                if read < len(near) and len(scores) >= k and np.partition(scores, -k)[-k] > bounds[read]:
                    break
            found = near[: len(scores)]
            best = np.lexsort((ids[found], -scores))[:k]
            out += [(int(query_row), int(ids[found[b]]), int(scores[b])) for b in best]
    return out


def top_k(vectors: DataFrame, is_query: Column, k: int = TOP, data_block: int = DATA_BLOCK, query_block: int = QUERY_BLOCK) -> DataFrame:
    """query_id, rank, vec_id and score of the k best rows for every row that ``is_query`` (over vec_id) holds for."""
    whole = stored(whole_vectors(vectors), "whole")
    file = stored(approximations(whole), "approximations")
    sizes = file.agg(F.count("*").alias("n"), F.count_if(is_query).alias("q")).first()
    rows, columns = max(1, -(-sizes.n // data_block)), max(1, -(-sizes.q // query_block))
    block = lambda n: F.pmod(F.xxhash64("row"), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    data = file.withColumn("i", block(rows)).withColumn("j", every(columns))
    asked = file.filter(is_query).select("row", "dims", "v").withColumn("j", block(columns)).withColumn("i", every(rows))

    def search(key, d: pd.DataFrame, q: pd.DataFrame) -> pd.DataFrame:
        found = []
        if len(d) and len(q):
            cells = np.frombuffer(b"".join(d["cells"]), np.uint8).reshape(len(d), -1)
            found = search_block(
                d["row"].to_numpy(), d["vec_id"].to_numpy(), _matrix(list(d["v"])), cells, np.asarray(d["low"].iloc[0]), np.asarray(d["width"].iloc[0]),
                q["row"].to_numpy(), _matrix(list(q["v"])), k,
            )
        return pd.DataFrame(found, columns=["query_row", "vec_id", "score"], dtype="int64")

    keys = ("dims", "i", "j")
    found = data.groupBy(*keys).cogroup(asked.groupBy(*keys)).applyInPandas(search, "query_row long, vec_id long, score long")
    best = Window.partitionBy("query_row").orderBy(F.desc("score"), "vec_id")
    found = found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
    names = file.filter(is_query).select(F.col("row").alias("query_row"), F.col("vec_id").alias("query_id"))
    return found.join(names, "query_row").select("query_id", "rank", "vec_id", "score")
