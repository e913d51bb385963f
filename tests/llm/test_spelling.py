import random
import re
import zlib
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from llm_fixtures import documents, odd, odd_rows  # noqa: F401

from commutewell.llm import spelling


def one_error(a, b):
    """Do two words differ by exactly one inserted, deleted or replaced letter?"""
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(a) + 1 == len(b) and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute_words(rows):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    count = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(lower)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            count[run[: h % len(run)] + run[h % len(run) + 1 :] if h % 31 == 0 else run] += 1
    return {w: n for w, n in count.items() if len(w) >= 7 and n >= 2}


def brute_force(words):
    out = []
    forms, near_of = {}, {w: [v for v in words if one_error(v, w)] for w in words}
    for w, near in near_of.items():
        best = min(near, key=lambda v: (-words[v], v), default=None)
        forms[w] = best if best and words[best] >= 10 * words[w] else None
    for w, n in words.items():
        root = w
        while forms[root]:
            root = forms[root]
        out.append((w, forms[w], root, n, len(near_of[w]), words[forms[w]] if forms[w] else None))
    return sorted(out)


def results(df):
    return sorted(map(tuple, df.collect()))


def errors(rng, word):
    at = rng.randrange(len(word) + 1)
    kind = rng.randrange(3)
    letter = rng.choice("abcdeé")
    return word[:at] + ("" if kind == 0 else letter) + word[at + (kind < 2) :]


def misspelt(rng, letters, n):
    """Words, their variants and the variants of those, over few letters so that many are near."""
    words = []
    for _ in range(n):
        word = "".join(rng.choice(letters) for _ in range(rng.randrange(6, 12)))
        words += [word] * rng.choice((2, 30, 400))
        for _ in range(4):
            near = errors(rng, word)
            words += [near] * rng.choice((1, 2, 25)) + [errors(rng, near)] * 2
    rng.shuffle(words)
    return words


@pytest.mark.parametrize("letters", ["ab", "abcdeé"])
def test_equals_brute_force(documents, letters):
    rng = random.Random(len(letters))
    words = misspelt(rng, letters, 40)
    texts = [" ".join(w.upper() if rng.random() < 0.1 and w.isascii() else w for w in words[i : i + 50]) for i in range(0, len(words), 50)]
    rows = [(i, text) for i, text in enumerate(texts)]
    want = brute_force(brute_words(rows))
    assert results(spelling.variants(documents([(i, t, None, None, 0) for i, t in rows]))) == want
    assert any(form and root != form for _, form, root, *_ in want), "no chain of forms"


def test_blocks_of_a_hot_bucket(spark, documents):
    """Words that all share their first half, cut to many blocks: the same neighbours as in one."""
    rng = random.Random(3)
    words = {"abcd" + "".join(rng.choice("xy") for _ in range(rng.choice((4, 5)))): rng.randrange(2, 99) for _ in range(60)}
    vocabulary = spark.createDataFrame(list(words.items()), "word string, n long")
    want = sorted((w, near, form and words[form]) for w, _, _, _, near, _ in brute_force(words) for form in [min((v for v in words if one_error(v, w)), key=lambda v: (-words[v], v), default=None)] if near)
    for block in (7, 1000):
        got = sorted((r.word, r.n_near, r.near_n) for r in spelling.neighbours(vocabulary, block).collect())
        assert got == want


def test_odd_rows(odd, documents):
    assert results(spelling.variants(odd)) == brute_force(brute_words([r[:2] for r in odd_rows()]))
    assert spelling.variants(documents([])).collect() == []
    assert spelling.variants(documents([(1, None, None, None, None)])).collect() == []


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text("ab", max_size=5), min_size=1, max_size=80, unique=True), st.text("ab", max_size=5))
def test_recurrences(texts, word):
    replaced, longer = spelling.Index(texts).near(word)
    got = {texts[k] for k in spelling.numbers_of(replaced | longer)}
    assert got == {t for t in texts if len(t) in (len(word), len(word) + 1) and one_error(t, word)}
