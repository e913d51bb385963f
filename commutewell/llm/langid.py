"""Language identification, words first, with backoff to character n-grams.

A text's words are looked up in per-language log frequencies. A word that no language knows is scored by its
longest character n-grams that are known, n falling from ``GRAM`` to 1. Scores are weighted by the word's
count in the whole text; the best language wins.

The model is learned from a hash sample of the labelled rows, about ``TRAIN_DOCS`` per language and ``TRAIN_ROWS``
in all, whole texts. No language is left out for its rank: with more of them each has fewer rows.
Of what occurs more than once, it keeps per language the ``WORDS`` most frequent words and the ``GRAMS`` most
frequent n-grams of each length.
These parameters bound what the driver collects and broadcasts, whatever the size of the corpus. An entry holds only
the languages that know it, so the model grows with what the languages know, not with their square.

Defined results: a NULL text, or one without a letter, is ``und`` with score 0; so is every text when nothing
can be learned. Equal scores go to the first language by name. NULL languages teach nothing. Only ``doc_id``,
``text`` and ``lang`` are read, and the last two only where stated.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from commutewell.llm.common import stored

UNKNOWN = "und"
TRAIN_DOCS = 1500
TRAIN_ROWS = 200_000
COPIED = 100_000  # languages whose sizes are copied to all executors
WORDS = 20_000
GRAMS = 4_000
GRAM = 4
BACKOFF = math.log(0.4)  # cost of each step to shorter n-grams
CACHE = 50_000  # scored unseen words that a worker remembers
LEAST = 0.4  # score below which a text counts as none of the languages
SHARPNESS = 30  # words that count towards the score's certainty, at most

_WORD = re.compile(r"[^\W\d_]+")


def held_out(doc_id: Column, parts: int, part: int) -> Column:
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(parts)) == part


def words_of(text: str | None) -> Counter:
    return Counter(_WORD.findall(text.lower())) if text else Counter()


def grams_of(word: str, n: int) -> list[str]:
    padded = f" {word} "
    return [padded[i : i + n] for i in range(len(padded) - n + 1)] if n > 1 else list(word)


def training_rows(docs: DataFrame, per_language: int = TRAIN_DOCS, in_all: int = TRAIN_ROWS) -> DataFrame:
    """(lang, text) of about ``per_language`` rows of each language, ``in_all`` at most, chosen by the id's hash.

    The sizes, one short line a language, are copied to all executors while they are counted to be at most ``COPIED``
    lines: a shuffle by language would move every text to a few tasks before the draw. With more languages
    than that Spark chooses the join.
    """
    labelled = docs.filter("lang IS NOT NULL AND text IS NOT NULL")
    sizes = labelled.groupBy("lang").agg(F.count("*").alias("n"))
    fair = per_language if (languages := sizes.count()) * per_language <= in_all else in_all / languages
    draw = F.pmod(F.xxhash64(F.lit("lang"), "doc_id"), F.lit(1_000_000)) / 1_000_000
    share = sizes.select("lang", (F.lit(fair) / F.col("n")).alias("share"))
    drawn = labelled.select("lang", "text", draw.alias("draw"))
    if languages <= COPIED:
        return drawn.join(F.broadcast(share), "lang").filter("draw < share").select("lang", "text")
    return drawn.join(share, "lang").filter("draw < share").select("lang", "text")


def counted(rows: DataFrame) -> DataFrame:
    """(lang, n, item, count): words as n = 0, character n-grams otherwise; each batch is counted before the shuffle."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            items: Counter = Counter()
            for lang, text in zip(batch.column(0), batch.column(1)):
                lang = lang.as_py()
                for word, k in words_of(text.as_py()).items():
                    items[lang, 0, word] += k
                    for n in range(1, GRAM + 1):
                        for gram in grams_of(word, n):
                            items[lang, n, gram] += k
            columns = list(zip(*((*key, k) for key, k in items.items()))) or [(), (), (), ()]
            types = (pa.string(), pa.int32(), pa.string(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=["lang", "n", "item", "k"])

    found = rows.select("lang", "text").mapInArrow(count, "lang string, n int, item string, k long")
    return found.groupBy("lang", "n", "item").agg(F.sum("k").alias("k"))


class Model:
    """Languages, and per word or n-gram the languages that know it with their log frequency above the floor.

    ``floor`` is each language's log frequency of what it does not know, by length.
    """

    def __init__(self, rows, totals):
        self.languages = sorted({lang for lang, _ in totals})
        at = {lang: i for i, lang in enumerate(self.languages)}
        self.floor = {
            n: [math.log(0.5 / (1 + totals.get((lang, n), 0))) for lang in self.languages] for n in range(GRAM + 1)
        }
        self.tables: list[dict[str, list[tuple[int, float]]]] = [{} for _ in range(GRAM + 1)]
        for lang, n, item, k in rows:
            gain = math.log(k / totals[lang, n]) - self.floor[n][at[lang]]
            self.tables[n].setdefault(item, []).append((at[lang], gain))
        self.cache: dict[str, tuple[int, list[tuple[int, float]]] | None] = {}

    def unseen(self, word: str) -> tuple[int, list[tuple[int, float]]] | None:
        """The length of the longest n-grams known and their mean gains; None if not one character is known."""
        for n in range(GRAM, 0, -1):
            known = [e for gram in grams_of(word, n) if (e := self.tables[n].get(gram))]
            if known:
                gains: dict[int, float] = {}
                for entry in known:
                    for i, gain in entry:
                        gains[i] = gains.get(i, 0.0) + gain / len(known)
                return n, sorted(gains.items())
        return None

    def entry(self, word: str) -> tuple[int, list[tuple[int, float]]] | None:
        if (known := self.tables[0].get(word)) is not None:
            return 0, known
        if word not in self.cache:
            if len(self.cache) >= CACHE:
                self.cache.clear()
            self.cache[word] = self.unseen(word)
        return self.cache[word]

    def predict(self, text: str | None) -> tuple[str, float]:
        words = words_of(text)
        if not words or not self.languages or not any(map(str.isalpha, text)):
            return UNKNOWN, 0.0
        gains, by_length = [0.0] * len(self.languages), [0] * (GRAM + 1)
        for word, k in words.items():
            if (entry := self.entry(word)) is not None:
                by_length[entry[0]] += k
                for i, gain in entry[1]:
                    gains[i] += k * gain
        # The cost of backing off is the same for all languages.
        cost = BACKOFF * sum(k * (GRAM - n + 1) for n, k in enumerate(by_length) if n)
        sums = [g + cost + sum(k * self.floor[n][i] for n, k in enumerate(by_length) if k) for i, g in enumerate(gains)]
        best, n = max(range(len(sums)), key=lambda i: (sums[i], -i)), sum(by_length)
        scale = min(n, SHARPNESS) / max(n, 1)
        return self.languages[best], 1 / sum(math.exp(max(-700.0, (x - sums[best]) * scale)) for x in sums)


def train(docs: DataFrame, per_language: int = TRAIN_DOCS, words: int = WORDS, grams: int = GRAMS) -> Model:
    """The model of the labelled rows in ``docs``; the driver collects at most words + GRAM * grams lines a language."""
    counts = stored(counted(training_rows(docs, per_language)), "lang-counts")
    totals = {(r.lang, r.n): r.total for r in counts.groupBy("lang", "n").agg(F.sum("k").alias("total")).collect()}
    rank = F.row_number().over(Window.partitionBy("lang", "n").orderBy(F.desc("k"), "item"))
    often = counts.filter("k > 1").withColumn("rank", rank)
    kept = often.filter(f"n = 0 AND rank <= {words}").unionByName(often.filter(f"n > 0 AND rank <= {grams}"))
    return Model([(r.lang, r.n, r.item, r.k) for r in kept.collect()], totals)


def predictions(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, lang_pred and score of every row; only the text is looked at."""
    spark = docs.sparkSession
    schema = T.StructType([docs.schema["doc_id"], *T.StructType.fromDDL("lang_pred string, score double")])
    shared = spark.sparkContext.broadcast(vars(model))  # bounded by WORDS and GRAMS

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Model([], {})
        vars(known).update(shared.value)
        predict = known.predict
        for batch in batches:
            found = [predict(text.as_py()) for text in batch.column(1)]
            columns = list(zip(*found)) or [(), ()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(columns[0], pa.string()), pa.array(columns[1], pa.float64())], names=schema.names
            )

    return docs.select("doc_id", "text").mapInArrow(label, schema)


def identify(docs: DataFrame, parts: int = 3, part: int = 1) -> DataFrame:
    """Predictions for all rows, learned only from those outside the held-out part."""
    model = train(docs.filter(~F.coalesce(held_out(F.col("doc_id"), parts, part), F.lit(False))))
    return predictions(docs, model).select(
        "doc_id", F.coalesce(held_out(F.col("doc_id"), parts, part), F.lit(False)).alias("held_out"), "lang_pred", "score"
    )


def accepted(docs: DataFrame, model: Model, languages: Iterable[str] | None = None, least: float = LEAST) -> DataFrame:
    """The rows of ``docs``, all columns, that are in one of ``languages`` (default: any the model knows) by a score of at least ``least``.

    Texts without a letter go. Where no language could be learned, nothing can be told and all rows stay.
    """
    if not model.languages:
        return docs
    wanted = set(model.languages if languages is None else languages)
    shared = docs.sparkSession.sparkContext.broadcast(vars(model))

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Model([], {})
        vars(known).update(shared.value)
        for batch in batches:
            found = (known.predict(text.as_py()) for text in batch.column("text"))
            yield batch.filter(pa.array([lang in wanted and score >= least for lang, score in found], pa.bool_()))

    return docs.mapInArrow(keep, docs.schema)
