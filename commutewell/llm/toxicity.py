"""Toxicity by a weighted lexicon, matched with Aho-Corasick on folded text.

Folding lowers the case, replaces letters that look alike and digits that stand for letters inside words, and
splits the text into words. The lexicon holds word beginnings and whole words with weights; exceptions are
words and pairs of words that contain an entry but are harmless. A text's weighted matches, without those in
exceptions, are divided by its number of words; a logistic curve over the logarithm of that density is the
score.

Everything is learned from a hash sample of about ``TRAIN_DOCS`` distinct labelled texts per class. Entries are
chosen by greedy cover: each must lie in texts of the toxic class that few entries cover yet, and hardly in any
others. The sample's texts stay in Spark; the driver holds terms, numbers and densities. Then the whole texts of all
rows are scored in Spark.

Defined results: NULL and empty texts score the curve's value at density 0; without labels of both classes,
or if they teach no entry, every score is 0; repeated rows count once in training and are scored each; NULL labels teach nothing. Only
``doc_id`` and ``text`` of the documents are read.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from commutewell.llm.common import stored
from commutewell.llm.langid import held_out

TRAIN_DOCS = 2500
MIN_TEXTS = 5  # toxic texts that an entry must occur in,
MIN_SHARE = 0.015  # and its share of all of them
PURITY = 0.98  # share of the toxic class among an entry's texts, each class weighted alike
DEPTH = 5  # entries after which a toxic text counts as covered
MIN_NEW = 3  # texts not yet covered that a further entry must occur in
CLEAN_COST = 3  # what a share of the clean texts costs against the same share of toxic ones
PREFIXES = range(4, 9)
CONTEXTS = 2  # harmless texts that make an exception

# Letters that look like Latin ones, by the Latin letter; i and l share one class with the digit 1.
ALIKE = {
    "a": "аαⱥ4@", "b": "ьβ8", "c": "сϲ¢", "d": "ԁ", "e": "еєε3€", "g": "ɡ9", "h": "һհ", "i": "іιїı1l!|", "j": "јʝ",
    "k": "кκ", "m": "мϻ", "n": "пη", "o": "оοօ0", "p": "рρ", "q": "ԛ", "r": "гᴦ", "s": "ѕꜱ5$", "t": "тτ7+", "u": "υս",
    "v": "νѵ", "w": "ԝω", "x": "хχ", "y": "уγү", "z": "ᴢ2",
}
_FOLD = str.maketrans({alike: letter for letter, all_ in ALIKE.items() for alike in all_})
_TOKEN = re.compile(r"[^\W_]+(?:[@$!|+€¢][^\W_]+)*")
_LETTER = re.compile(r"[^\W\d_]")


def folded(text: str | None) -> list[str]:
    """The words of a text in folded form; numbers without a letter stay numbers."""
    if not text:
        return []
    text = text.lower()
    if not text.isascii():
        text = unicodedata.normalize("NFKC", text)
    out = text.translate(_FOLD)
    if len(out) == len(text) and any(c in text for c in "0123456789@$!|+€¢"):
        return [out[m.start() : m.end()] if _LETTER.search(m[0]) else m[0] for m in _TOKEN.finditer(text)]
    return _TOKEN.findall(out)


def terms_of(words: list[str]) -> set[str]:
    """What may become an entry: " word " and " beginning"."""
    out = set()
    for word in set(words):
        out.add(f" {word} ")
        for n in PREFIXES:
            if n <= len(word):
                out.add(f" {word[:n]}")
    return out


class Lexicon:
    """Weighted entries, exceptions and the curve from density to score."""

    def __init__(self, weights: dict[str, float], exceptions: set[str], slope: float = 0.0, shift: float = -700.0):
        self.weights, self.exceptions, self.slope, self.shift = weights, exceptions, slope, shift
        self._automaton = None

    def automaton(self):
        if self._automaton is None:
            import ahocorasick

            self._automaton = ahocorasick.Automaton()
            for entry, weight in self.weights.items():
                self._automaton.add_word(entry, (len(entry), weight))
            for phrase in self.exceptions:
                if phrase not in self.weights:
                    self._automaton.add_word(phrase, (len(phrase), None))
            if len(self._automaton):
                self._automaton.make_automaton()
        return self._automaton

    def matches(self, words: list[str]) -> list[tuple[int, int, float]]:
        """(start, end, weight) of the entries found outside exceptions."""
        automaton = self.automaton()
        if not words or not len(automaton):
            return []
        found, harmless = [], []
        for last, (size, weight) in automaton.iter(f" {' '.join(words)} "):
            (harmless if weight is None else found).append((last + 1 - size, last + 1, weight))
        return [m for m in found if not any(a <= m[0] and m[1] <= b for a, b, _ in harmless)]

    def density(self, words: list[str]) -> float:
        """Weight found per hundred words; of entries that start at the same place only the heaviest counts."""
        best: dict[int, float] = {}
        for start, _, weight in self.matches(words):
            best[start] = max(weight, best.get(start, 0.0))
        return 100 * sum(best.values()) / len(words) if words else 0.0

    def curve(self, density: float) -> float:
        x = self.slope * math.log(density + 1e-3) + self.shift
        return 1 / (1 + math.exp(-max(-700.0, min(700.0, x))))

    def score(self, text: str | None) -> float:
        return self.curve(self.density(folded(text)))


def fitted_curve(densities: list[float], labels: list[int]) -> tuple[float, float]:
    """Logistic regression on log density, each class weighted alike, by Newton's method with a small ridge."""
    xs = [math.log(d + 1e-3) for d in densities]
    share = {y: 0.5 / max(1, labels.count(y)) for y in (0, 1)}
    a = b = 0.0
    for _ in range(50):
        ga, gb, haa, hab, hbb = -1e-3 * a, -1e-3 * b, 1e-3, 0.0, 1e-3
        for x, y in zip(xs, labels):
            p = 1 / (1 + math.exp(-max(-700.0, min(700.0, a * x + b))))
            w, h = share[y], share[y] * p * (1 - p)
            ga, gb = ga + w * (y - p) * x, gb + w * (y - p)
            haa, hab, hbb = haa + h * x * x, hab + h * x, hbb + h
        det = haa * hbb - hab * hab
        a, b = a + (hbb * ga - hab * gb) / det, b + (haa * gb - hab * ga) / det
    return a, b


def training_texts(docs: DataFrame, labels: DataFrame, per_class: int = TRAIN_DOCS) -> DataFrame:
    """(toxic, text) of about ``per_class`` distinct labelled texts of each class.

    Ids are drawn by hash; at most a few thousand are left, so they are broadcast to the texts.
    """
    known = labels.filter("toxic IN (0, 1) AND doc_id IS NOT NULL").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    share = F.broadcast(known.groupBy("toxic").agg((F.lit(per_class) / F.count("*")).alias("share")))  # two lines
    draw = F.pmod(F.xxhash64(F.lit("toxic"), "doc_id"), F.lit(1_000_000)) / 1_000_000
    drawn = known.join(share, "toxic").filter(draw < F.col("share")).select("doc_id", "toxic")
    texts = docs.filter("text IS NOT NULL").select("doc_id", "text").join(F.broadcast(drawn), "doc_id")
    return texts.groupBy("text").agg(F.max("toxic").alias("toxic"))


def term_counts(texts: DataFrame) -> DataFrame:
    """(term, clean, toxic): in how many texts of each class a term occurs."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            both: tuple[Counter, Counter] = (Counter(), Counter())
            for text, toxic in zip(batch.column(0), batch.column(1)):
                both[toxic.as_py()].update(terms_of(folded(text.as_py())))
            terms = list(both[0].keys() | both[1].keys())
            counts = [pa.array([side[t] for t in terms], pa.int64()) for side in both]
            yield pa.RecordBatch.from_arrays([pa.array(terms, pa.string()), *counts], names=["term", "clean", "toxic"])

    found = texts.select("text", F.col("toxic").cast("int")).mapInArrow(count, "term string, clean long, toxic long")
    return found.groupBy("term").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))


def chosen(candidates: dict[str, tuple[int, int]], cover: list[set[str]], sizes: tuple[int, int]) -> dict[str, float]:
    """Entries by greedy cover of the toxic texts, with their smoothed log odds as weight.

    Each step takes the entry with the most texts that are covered less than DEPTH times, less its cost in
    clean texts; ties go to the longer one. What an entry makes redundant, because it lies in the other or
    the other in it, is no longer a candidate.
    """
    depth = [0] * len(cover)
    texts: dict[str, set[int]] = {}
    for n, terms in enumerate(cover):
        for term in terms:
            texts.setdefault(term, set()).add(n)
    gain = lambda t: len(texts[t]) / sizes[1] - CLEAN_COST * candidates[t][0] / sizes[0]
    out: dict[str, float] = {}
    while texts:
        term = max(texts, key=lambda t: (gain(t), len(t), t))
        if len(texts[term]) < MIN_NEW or gain(term) <= 0:
            break
        clean, toxic = candidates[term]
        out[term] = math.log((toxic + 0.5) / (sizes[1] + 1)) - math.log((clean + 0.5) / (sizes[0] + 1))
        covered = set()
        for n in texts.pop(term):
            depth[n] += 1
            if depth[n] == DEPTH:
                covered.add(n)
        texts = {t: now - covered for t, now in texts.items() if not (t.startswith(term) or term.startswith(t))}
        texts = {t: now for t, now in texts.items() if now}
    return out


def contexts_of(lexicon: Lexicon, words: list[str]) -> set[str]:
    """Words around the entries found, and pairs of words with the one before or after."""
    out = set()
    line = f" {' '.join(words)} "
    for start, end, _ in lexicon.matches(words):
        stop = line.index(" ", max(end - 1, start + 1))
        out.add(line[start : stop + 1])
        before, after = line.rfind(" ", 0, start), line.find(" ", stop + 1)
        if before >= 0 and start > 0:
            out.add(line[before : stop + 1])
        if after > 0:
            out.add(line[start : after + 1])
    return out


def per_text(texts: DataFrame, prepare: Callable[[], Callable[[list[str]], Iterable]], kind: pa.DataType, ddl: str) -> DataFrame:
    """(toxic, text_nr, value) for what the function that ``prepare`` gives makes of a text's folded words.

    ``prepare`` runs once a task; the texts stay where they are.
    """

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        values = prepare()
        for batch in batches:
            labels, numbers, found = [], [], []
            for text, toxic, number in zip(batch.column(0), batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                for value in values(folded(text.as_py())):
                    labels.append(toxic)
                    numbers.append(number)
                    found.append(value)
            yield pa.RecordBatch.from_arrays(
                [pa.array(labels, pa.int32()), pa.array(numbers, pa.int64()), pa.array(found, kind)], names=["toxic", "text_nr", "value"]
            )

    return texts.select("text", F.col("toxic").cast("int"), "text_nr").mapInArrow(each, f"toxic int, text_nr long, value {ddl}")


def exceptions_of(texts: DataFrame, lexicon: Lexicon, sizes: dict[int, int]) -> set[str]:
    """Contexts of entries that occur in clean texts and, for their number, hardly in toxic ones."""
    weights, exceptions = lexicon.weights, lexicon.exceptions

    def contexts():
        own = Lexicon(weights, exceptions)
        return lambda words: sorted(contexts_of(own, words))

    counts = per_text(texts, contexts, pa.string(), "string").groupBy("value").agg(
        F.count_if(F.col("toxic") == 0).alias("clean"), F.count_if(F.col("toxic") == 1).alias("toxic")
    )
    harmless = (F.col("clean") >= CONTEXTS) & (F.col("clean") / sizes[0] > 4 * (F.col("toxic") + 0.5) / sizes[1])
    return {r.value for r in counts.filter(harmless).collect()} - set(weights)


def train(docs: DataFrame, labels: DataFrame, per_class: int = TRAIN_DOCS) -> Lexicon:
    """The lexicon of the labelled documents.

    The sample's texts stay on the executors, however long they are. The driver collects terms that lie in
    MIN_SHARE of the toxic texts, their numbers by text, harmless contexts of entries, and one density per text.
    """
    texts = stored(training_texts(docs, labels, per_class).withColumn("text_nr", F.monotonically_increasing_id()), "toxic-sample")
    sizes = {r.toxic: r["count"] for r in texts.groupBy("toxic").count().collect()}
    if not sizes.get(0) or not sizes.get(1):
        return Lexicon({}, set())
    pure = F.col("toxic") / sizes[1] >= PURITY * (F.col("toxic") / sizes[1] + F.col("clean") / sizes[0])
    least = max(MIN_TEXTS, MIN_SHARE * sizes[1])
    candidates = {r.term: (r.clean, r.toxic) for r in term_counts(texts).filter(pure & (F.col("toxic") >= least)).collect()}
    terms = sorted(candidates)
    number = {term: n for n, term in enumerate(terms)}
    known = lambda: lambda words: sorted(number[t] for t in terms_of(words) if t in number)
    cover: dict[int, set[str]] = {}
    for r in per_text(texts.filter("toxic = 1"), known, pa.int32(), "int").toLocalIterator():
        cover.setdefault(r.text_nr, set()).add(terms[r.value])
    weights = chosen(candidates, list(cover.values()), (sizes[0], sizes[1]))
    if not weights:
        return Lexicon({}, set())
    exceptions = exceptions_of(texts, Lexicon(weights, set()), sizes)

    def density():
        own = Lexicon(weights, exceptions)
        return lambda words: [own.density(words)]

    found = [(r.value, r.toxic) for r in per_text(texts, density, pa.float64(), "double").collect()]
    slope, shift = fitted_curve([d for d, _ in found], [y for _, y in found])
    return Lexicon(weights, exceptions, slope, shift)


def scores(docs: DataFrame, lexicon: Lexicon) -> DataFrame:
    """doc_id, score and predicted of every row; only the text is looked at."""
    schema = T.StructType([docs.schema["doc_id"], *T.StructType.fromDDL("score double, predicted int")])
    parts = (lexicon.weights, lexicon.exceptions, lexicon.slope, lexicon.shift)
    shared = docs.sparkSession.sparkContext.broadcast(parts)  # bounded by the sample: every entry covers MIN_NEW new texts of it

    def rate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score = Lexicon(*shared.value).score
        for batch in batches:
            found = [score(text.as_py()) for text in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(found, pa.float64()), pa.array([int(x >= 0.5) for x in found], pa.int32())],
                names=schema.names,
            )

    return docs.select("doc_id", "text").mapInArrow(rate, schema)


def rate(docs: DataFrame, labels: DataFrame, parts: int = 5, part: int = 0) -> DataFrame:
    """Scores of all rows, learned only from labels outside the held-out part."""
    out = lambda: F.coalesce(held_out(F.col("doc_id"), parts, part), F.lit(False))
    lexicon = train(docs, labels.filter(~out()))
    return scores(docs, lexicon).select("doc_id", out().alias("held_out"), "score", "predicted")


def accepted(docs: DataFrame, lexicon: Lexicon) -> DataFrame:
    """The rows of ``docs``, all columns, that are not predicted to be toxic."""
    parts = (lexicon.weights, lexicon.exceptions, lexicon.slope, lexicon.shift)
    shared = docs.sparkSession.sparkContext.broadcast(parts)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score = Lexicon(*shared.value).score
        for batch in batches:
            yield batch.filter(pa.array([score(text.as_py()) < 0.5 for text in batch.column("text")], pa.bool_()))

    return docs.mapInArrow(keep, docs.schema)
