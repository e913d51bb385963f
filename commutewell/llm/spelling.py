"""Spelling variants by a bit-sliced position index.

1. Words are counted over all texts; a word goes on with ``MIN_COUNT`` occurrences.
2. Two words at one error share their first or their last half, as the error lies in the other one. Every word
   goes to the buckets of its halves, once for the length that it has and once for the length below, where it may
   be the longer word of a pair. Only the rest beside the shared half is still to be compared.
3. In a bucket every (position, letter) has a bitset over the bucket's words. One word's letters drive the
   recurrences for all words at a time: the sets without an error, with one replaced letter, and with one letter
   more, the last one read at positions shifted by one.
4. Buckets with more than ``BLOCK`` words are cut by hash to blocks, and the words of each block run against the
   index of each block; every pair of blocks is a cell of its own, so memory is bounded by two blocks. No bucket is
   capped.
5. A word's form is its most frequent near word, if that is ``RATIO`` times as frequent; forms are followed to the
   last one by doubling.

Defined results: no text gives no words; a NULL id is written as empty text in the checksum; repeated rows count
as often as they occur; an empty table gives an empty result; only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from commutewell.llm.common import stored

MIN_LENGTH, MIN_COUNT = 7, 2
RATIO = 10
DROP = 31  # of so many runs one loses a letter, by the checksum of id and run
BLOCK = 8192  # words of a bucket that one bitset covers
RUN = f"[A-Za-zÀ-ÿ]{{{MIN_LENGTH},}}"


def words(docs: DataFrame) -> DataFrame:
    """word and n: every word of at least MIN_LENGTH letters that occurs MIN_COUNT times.

    A run only loses letters, so shorter runs are never looked at.
    """
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    runs = docs.select("doc_id", F.explode(F.regexp_extract_all("text", F.lit(RUN), F.lit(0))).alias("run"))
    run = F.translate("run", upper, upper.lower())
    runs = runs.select(run.alias("run"), F.crc32(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), run).cast("binary")).alias("h"))
    at = (F.col("h") % F.length("run")).cast("int")
    shorter = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))
    word = F.when(F.col("h") % DROP == 0, shorter).otherwise(F.col("run")).alias("word")
    return runs.select(word).filter(F.length("word") >= MIN_LENGTH).groupBy("word").agg(F.count("*").alias("n")).filter(F.col("n") >= MIN_COUNT)


def members(vocabulary: DataFrame) -> DataFrame:
    """bucket, word and n: each word in the buckets where its near words are.

    A bucket is named by the shorter length of its pairs, the side and the half that its words share.
    """
    length = F.length("word")
    entries = []
    for shorter in (length, length - 1):
        half = F.floor(shorter / 2).cast("int")
        tail = (shorter - half).cast("int")
        name = lambda side, text: F.concat(shorter.cast("string"), F.lit(side), text)  # noqa: B023,E731
        entries.append(F.when(shorter >= MIN_LENGTH, name("<", F.substring("word", F.lit(1), half))))
        entries.append(F.when(shorter >= MIN_LENGTH, name(">", F.substring("word", length - tail + 1, tail))))
    return vocabulary.select(F.explode(F.array_compact(F.array(*entries))).alias("bucket"), "word", "n")


def cells(member: DataFrame, block: int) -> DataFrame:
    """The members (bucket, i, j, block, word, n) of every pair of blocks i <= j of a bucket with more than one word."""
    sizes = member.groupBy("bucket").agg(F.count("*").alias("size")).filter("size > 1")
    width = F.ceil(F.col("size") / block).cast("int")
    dealt = member.join(sizes, "bucket").select(
        "bucket", "word", "n", width.alias("width"), F.pmod(F.xxhash64("word"), width.cast("long")).cast("int").alias("block")
    )
    other = F.explode(F.sequence(F.lit(0), F.col("width") - 1)).alias("other")
    return dealt.select("bucket", "word", "n", "block", other).select(
        "bucket", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "word", "n"
    )


class Index:
    """Bitsets of texts per (position, letter) and per length; bit k stands for the k-th text."""

    def __init__(self, texts: list[str]):
        self.letters: dict[tuple[int, str], int] = {}
        self.lengths: dict[int, int] = {}
        self.all = (1 << len(texts)) - 1
        bits: dict[tuple[int, str], list[int]] = {}
        sizes: dict[int, list[int]] = {}
        for k, text in enumerate(texts):
            sizes.setdefault(len(text), []).append(k)
            for entry in enumerate(text):
                bits.setdefault(entry, []).append(k)
        for target, lists in ((self.letters, bits), (self.lengths, sizes)):
            for entry, numbers in lists.items():
                target[entry] = self._bitset(numbers)

    @staticmethod
    def _bitset(numbers: list[int]) -> int:
        if numbers[-1] < 512:
            out = 0
            for k in numbers:
                out |= 1 << k
            return out
        out = bytearray(numbers[-1] // 8 + 1)
        for k in numbers:
            out[k >> 3] |= 1 << (k & 7)
        return int.from_bytes(out, "little")

    def near(self, text: str) -> tuple[int, int]:
        """The texts that differ from ``text`` by one replaced letter, and those with one letter more."""
        get = self.letters.get
        same, replaced, longer = self.all, 0, 0
        for at, letter in enumerate(text):
            here = get((at, letter), 0)
            longer = (longer | same) & get((at + 1, letter), 0)
            replaced = (replaced & here) | (same & ~here)
            same &= here
            if not (same | replaced | longer):
                return 0, 0
        size = self.lengths.get
        return replaced & size(len(text), 0), (longer | same) & size(len(text) + 1, 0)


def numbers_of(bits: int) -> Iterator[int]:
    while bits:
        low = bits & -bits
        yield low.bit_length() - 1
        bits ^= low


def near_in_cell(bucket: str, blocks: list[list[tuple[str, int]]]) -> dict[str, tuple[int, int, str]]:
    """Per word the number of its near words in the cell, and the best of them as (-n, word).

    ``blocks`` are one block, compared with itself, or two, compared with each other. A pair that shares both halves
    is found in the bucket of the first half only.
    """
    side = min((i for i in (bucket.find("<"), bucket.find(">")) if i > 0))
    shorter, half = int(bucket[:side]), len(bucket) - side - 1
    front = bucket[side] == "<"
    head = shorter // 2
    rest = (lambda w: w[half:]) if front else (lambda w: w[: len(w) - half])
    found: dict[str, tuple[int, int, str]] = {}

    def credit(word: str, near: str, n: int) -> None:
        count, best, form = found.get(word, (0, 1, ""))
        found[word] = (count + 1, *min((best, form), (-n, near)))

    indexes = [Index([rest(w) for w, _ in block]) for block in blocks]
    for block, index, others in ((blocks[0], indexes[-1], blocks[-1]), (blocks[-1], indexes[0], blocks[0]))[: len(blocks)]:
        for word, n in block:
            if len(word) != shorter:
                continue
            replaced, longer = index.near(rest(word))
            for bits, both in ((replaced, False), (longer, True)):
                for k in numbers_of(bits):
                    near, near_n = others[k]
                    if front or near[:head] != word[:head]:
                        credit(word, near, near_n)
                        if both:
                            credit(near, word, n)
    return found


def neighbours(vocabulary: DataFrame, block: int = BLOCK) -> DataFrame:
    """word, n_near, and near and near_n of the most frequent near word, for every word that has one."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (row for batch in batches for row in zip(*(c.to_pylist() for c in batch.columns)))
        out = []
        for (bucket, i, j), cell in groupby(rows, lambda r: r[:3]):
            blocks: dict[int, list[tuple[str, int]]] = {k: [] for k in ((i,) if i == j else (i, j))}
            for _, _, _, k, word, n in cell:
                blocks[k].append((word, n))
            if all(blocks.values()):
                out += [(word, count, near, -best) for word, (count, best, near) in near_in_cell(bucket, list(blocks.values())).items()]
            if len(out) >= 10_000:
                yield batch_of(out)
                out = []
        yield batch_of(out)

    def batch_of(rows: list) -> pa.RecordBatch:
        columns = list(zip(*rows)) or [(), (), (), ()]
        types = (pa.string(), pa.int64(), pa.string(), pa.int64())
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=["word", "n_near", "near", "near_n"])

    cell = ["bucket", "i", "j"]
    dealt = cells(members(vocabulary), block).repartition(*cell).sortWithinPartitions(*cell)
    parts = dealt.select(*cell, "block", "word", "n").mapInArrow(compare, "word string, n_near long, near string, near_n long")
    best = F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best")
    sums = parts.groupBy("word").agg(F.sum("n_near").alias("n_near"), best)
    return sums.select("word", "n_near", F.col("best.near").alias("near"), (-F.col("best.less")).alias("near_n"))


def roots(forms: DataFrame) -> DataFrame:
    """word and root: the last of the forms (word, form) that follow from a word.

    Every form is RATIO times as frequent as the word before it, so a chain is short and has no circle.
    """
    current = stored(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        ahead = current.select(F.col("word").alias("root"), F.col("root").alias("far"))
        step = stored(current.join(ahead, "root", "left").select("word", F.coalesce("far", "root").alias("root"), F.col("far").isNotNull().alias("moved")), "roots")
        current = step.select("word", "root")
        if step.filter("moved").isEmpty():
            return current


def variants(docs: DataFrame) -> DataFrame:
    """word, form, root, n, n_near and form_n of every word of ``docs``."""
    vocabulary = stored(words(docs), "vocabulary")
    near = stored(neighbours(vocabulary), "neighbours")
    joined = vocabulary.join(near, "word", "left")
    is_form = F.col("near_n") >= RATIO * F.col("n")
    formed = stored(
        joined.select(
            "word", F.when(is_form, F.col("near")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(is_form, F.col("near_n")).alias("form_n"),
        ),
        "forms",
    )
    root = roots(formed.filter("form IS NOT NULL"))
    out = formed.join(root, "word", "left")
    return out.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
