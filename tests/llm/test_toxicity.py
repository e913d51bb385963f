"""The weighted lexicon: folding, exceptions, held-out accuracy, odd rows."""

import random
import zlib

import pytest
from llm_fixtures import documents, odd  # noqa: F401
from llm_words import prose

from commutewell.llm import toxicity
from commutewell.llm.toxicity import Lexicon, folded

BAD = ("grobnik", "zlotrap", "snarfuk")


def corpus(n=600):
    rng = random.Random(6)
    docs, labels = [], []
    for i in range(n):
        words = prose(rng, ("en", "fr", "de")[i % 3], rng.choice((15, 60))).split()
        toxic = int(i % 5 == 0)
        if toxic:
            for _ in range(2):
                bad = rng.choice(BAD)
                words.insert(rng.randrange(len(words)), bad.replace("o", "0").upper() if i % 3 == 0 else bad)
        docs.append((i, " ".join(words), None, None, None))
        labels.append((i, 1, toxic))
    return docs, labels


def test_held_out_accuracy(documents, spark):
    docs, labels = corpus()
    got = {r.doc_id: r for r in toxicity.rate(documents(docs), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).collect()}
    assert all(got[i].held_out == (zlib.crc32(str(i).encode()) % 5 == 0) for i in got)
    held = [(got[i].predicted, toxic) for i, _, toxic in labels if got[i].held_out]
    assert sum(a == b for a, b in held) / len(held) > 0.97
    assert all(r.predicted == (r.score >= 0.5) and 0 <= r.score <= 1 for r in got.values())


@pytest.mark.parametrize("text", ["loser", "LOSER", "l0ser", "1oser", "lo5er", "lоsеr", "ｌｏｓｅｒ", "L0S3R"])
def test_folding(text):
    assert folded(text) == folded("loser")


def test_numbers_stay_numbers():
    assert folded("in 2019, 42 of them") == ["in", "2019", "42", "of", "them"]


def test_entries_match_at_word_beginnings_and_exceptions_take_matches_back():
    lexicon = Lexicon({" tras": 2.0, " scum ": 3.0}, {" trash can "}, 1.0, 0.0)
    assert [w for *_, w in lexicon.matches(folded("that trashy scum"))] == [2.0, 3.0]
    assert lexicon.matches(folded("a trash can")) == []
    assert lexicon.matches(folded("extras scumbag")) == []
    assert lexicon.density(folded("scum " + "word " * 99)) == pytest.approx(3.0)
    assert lexicon.density([]) == 0


def test_exceptions_are_learned(documents, spark):
    docs, labels = corpus()
    rng = random.Random(9)
    for i in range(1000, 1120):
        docs.append((i, prose(rng, "en", 20) + f" grobnik engine{'s' * (i % 2)} " + prose(rng, "en", 5 + i % 9), None, None, None))
        labels.append((i, 1, 0))
    lexicon = toxicity.train(documents(docs), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    assert lexicon.score("my old grobnik engine is loud") < 0.5 < lexicon.score("you zlotrap of a man")


def test_odd_rows(odd, spark):
    labels = spark.createDataFrame([(1, 1, 1), (5, 1, 0), (5, 1, None), (None, 1, 1), (6, 0, 1), (7, None, 0)], "doc_id long, quality int, toxic int")
    assert toxicity.rate(odd, labels).count() == odd.count()
    nothing = toxicity.rate(odd, labels.limit(0)).collect()
    assert {r.score for r in nothing} == {0.0} or max(r.score for r in nothing) < 1e-9
    assert toxicity.rate(odd.limit(0), labels).count() == 0
    assert toxicity.accepted(odd, Lexicon({}, set())).columns == odd.columns
