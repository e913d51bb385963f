"""Language identification: held-out accuracy, backoff, odd rows."""

import random
import zlib

import pytest

from llm_fixtures import documents, odd  # noqa: F401
from llm_words import prose

from commutewell.llm import langid


def labelled(n=240):
    rng = random.Random(8)
    rows = []
    for i in range(n):
        lang = ("en", "fr", "de")[i % 3]
        text = prose(rng, lang, rng.choice((3, 20, 80)))
        rows.append((i, text.upper() if i % 7 == 0 else text, lang, "a", len(text)))
    return rows


def test_held_out_accuracy_and_parts(documents):
    rows = labelled()
    got = {r.doc_id: r for r in langid.identify(documents(rows)).collect()}
    assert len(got) == len(rows)
    assert all(got[i].held_out == (zlib.crc32(str(i).encode()) % 3 == 1) for i, *_ in rows)
    held = [r for r in rows if got[r[0]].held_out]
    right = sum(got[i].lang_pred == lang for i, _, lang, *_ in held)
    assert right / len(held) > 0.97
    assert all(0 <= r.score <= 1 for r in got.values())


def test_labels_of_the_held_out_part_teach_nothing(documents):
    rows = labelled()
    wrong = [(i, t, "xx" if zlib.crc32(str(i).encode()) % 3 == 1 else lang, s, n) for i, t, lang, s, n in rows]
    a = langid.identify(documents(rows)).select("doc_id", "lang_pred", "score").collect()
    b = langid.identify(documents(wrong)).select("doc_id", "lang_pred", "score").collect()
    assert sorted(map(tuple, a)) == sorted(map(tuple, b))


def test_unseen_words_back_off_to_shorter_grams():
    rows = [("en", 0, "hello", 10), ("fr", 0, "bonjour", 10), ("en", 4, " hel", 5), ("fr", 2, "jo", 5), ("en", 1, "q", 2)]
    totals = {(lang, n): 20 for lang in ("en", "fr") for n in range(5)}
    model = langid.Model(rows, totals)
    assert model.predict("helium")[0] == "en"  # a 4-gram
    assert model.predict("xjox")[0] == "fr"  # a 2-gram
    assert model.predict("q")[0] == "en"  # a letter
    assert model.unseen("zzz") is None
    assert model.predict("½ ² 12")[0] == "und" and model.predict("½ q")[0] == "en"
    assert model.predict("hello hello bonjour")[0] == "en"
    assert model.predict("hello bonjour")[0] == "en"  # a tie goes to the first by name


def test_no_language_is_left_out(documents):
    """Six hundred labels, each with its own words, are all predicted; a bound on all rows thins every language alike."""
    rows = [(600 * j + i, f"w{chr(97 + i % 26)}{chr(97 + i // 26)}q " * 4, f"l{i:03}", None, 0) for i in range(600) for j in range(3)]
    docs = documents(rows)
    model = langid.train(docs)
    assert len(model.languages) == 600
    assert max(len(e) for e in model.tables[0].values()) == 1  # entries hold the languages that know them, no others
    got = {r.doc_id: r.lang_pred for r in langid.predictions(docs, model).collect()}
    assert all(got[i] == lang for i, _, lang, *_ in rows)
    assert langid.training_rows(docs, in_all=600).count() < 900


def test_sparse_scores_equal_dense_ones():
    """The score of a text against a plain sum over all languages and words."""
    import math

    rng = random.Random(3)
    langs, items = ["a", "b", "c"], ["uno", "dos", "tres", "zwei"]
    rows = [(lang, 0, w, rng.randint(2, 9)) for lang in langs for w in items if rng.random() < 0.7]
    totals = {(lang, n): 50 for lang in langs for n in range(5)}
    model, known = langid.Model(rows, totals), {(lang, w): k for lang, _, w, k in rows}
    for _ in range(20):
        words = [rng.choice(items) for _ in range(rng.randint(1, 12))]
        words = [w for w in words if any((lang, w) in known for lang in langs)] or [rows[0][2]]
        dense = {lang: sum(math.log(known[lang, w] / 50 if (lang, w) in known else 0.5 / 51) for w in words) for lang in langs}
        top = max(dense.values())
        got, score = model.predict(" ".join(words))
        assert dense[got] == pytest.approx(top) and score == pytest.approx(1 / sum(math.exp(x - top) for x in dense.values()))


def test_odd_rows(odd):
    got = langid.identify(odd).collect()
    assert len(got) == odd.count()
    by = {r.doc_id: r for r in got if r.doc_id is not None}
    assert all(by[i].lang_pred == "und" and by[i].score == 0 for i in (1, 2, 3, 4))
    assert by[9].lang_pred in ("en", "fr", "de")
    kept = langid.accepted(odd, langid.train(odd))
    assert kept.columns == odd.columns
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id is not None) == [5, 6, 7, 7, 8, 9, 10]


def test_nothing_to_learn_from_and_empty_table(odd, documents):
    docs = documents([(1, "some text", None, None, None)])
    assert [tuple(r)[2:] for r in langid.identify(docs).collect()] == [("und", 0.0)]
    assert langid.identify(odd.limit(0)).count() == 0


def test_acceptance_needs_the_model(documents):
    """Wanted languages and a least score decide; where nothing could be learned all rows stay."""
    import random

    from llm_words import prose

    rng = random.Random(4)
    rows = [(i, prose(rng, lang, 40), lang, None, 0) for i, lang in enumerate(["en", "de", "fr"] * 40)] + [(200, "123", None, None, 0)]
    docs = documents(rows)
    model = langid.train(docs)
    assert langid.accepted(docs, model).count() == 120
    assert {r.lang for r in langid.accepted(docs, model, ["en", "fr"]).collect()} == {"en", "fr"}
    assert langid.accepted(docs, model, least=1.1).count() == 0
    unlabelled = documents([(i, t, None, s, n) for i, t, _, s, n in rows])
    assert langid.accepted(unlabelled, langid.train(unlabelled)).count() == 121


def test_no_text_is_shuffled_by_language(documents):
    plan = langid.training_rows(documents(labelled()))._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan and "ShuffledHashJoin" not in plan


def test_more_languages_than_are_copied_give_the_same_rows(documents, monkeypatch):
    rows = documents([(i, f"text {i}", f"l{i % 40}", "a", 6) for i in range(400)])
    few = sorted(map(tuple, langid.training_rows(rows, 5, 100).collect()))
    monkeypatch.setattr(langid, "COPIED", 3)
    assert few and sorted(map(tuple, langid.training_rows(rows, 5, 100).collect())) == few
