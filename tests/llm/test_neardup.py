"""Near-duplicate groups and connected components against brute force."""

import random
from itertools import combinations

import pytest

from llm_fixtures import corpus, documents, odd  # noqa: F401

from commutewell.llm import neardup
from commutewell.llm.common import ascii_words
from commutewell.llm.components import components


def shingles(text):
    words = ascii_words(text)
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def least_reachable(nodes, links):
    parent = {n: n for n in nodes}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        x, y = sorted((root(a), root(b)))
        parent[y] = x
    return {n: root(n) for n in nodes}


def brute_force(rows):
    sets = {i: shingles(t) for i, t in rows}
    links = [
        (a, b) for a, b in combinations(sets, 2)
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])
    ]
    least = least_reachable(sets, links)
    return sorted((i, len(s), least[i], least[i] == i) for i, s in sets.items())


def result(df):
    return sorted(tuple(r) for r in df.select("doc_id", "n_shingles", "component_id", "kept").collect())


def test_groups_equal_brute_force(documents, corpus):
    docs = documents([(i, t, "en", "a", len(t)) for i, t in corpus])
    assert result(neardup.near_duplicates(docs)) == brute_force(corpus)


def test_links_between_members_that_their_bucket_head_does_not_link(documents, monkeypatch):
    monkeypatch.setattr(neardup, "BLOCK_CLASSES", 4)
    rng = random.Random(5)
    base = [f"w{i}" for i in range(200)]
    rows = []
    for i in range(40):  # about as far from the base as the threshold, in every direction
        text = list(base)
        for _ in range(rng.choice((2, 4, 6, 8))):
            text[rng.randrange(200)] = f"x{i}-{rng.random()}"
        rows.append((i, " ".join(text)))
    docs = documents([(i, t, None, None, None) for i, t in rows])
    assert result(neardup.near_duplicates(docs)) == brute_force(rows)


def test_odd_rows(odd):
    got = {r.doc_id: tuple(r)[1:4] for r in neardup.near_duplicates(odd).collect() if r.doc_id is not None}
    assert got[1] == (0, 1, True) and got[2] == (0, 2, True) and got[3] == (0, 3, True)
    assert got[5] == (1, 5, True)
    assert got[6][1:] == (6, True) and got[7][1:] == (6, False) and got[8][1:] == (6, False)
    assert neardup.near_duplicates(odd).count() == odd.count()
    kept = neardup.one_per_group(odd, neardup.near_duplicates(odd))
    assert kept.columns == odd.columns
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id is not None) == [1, 2, 3, 4, 5, 6, 9, 10]


def test_repeated_rows_are_one_document(documents):
    row = (3, "a b c d e f g h", "en", "a", 15)
    docs = documents([row, row])
    assert neardup.one_per_group(docs, neardup.near_duplicates(docs)).count() == 1


def test_empty_table(odd):
    assert neardup.near_duplicates(odd.limit(0)).count() == 0


@pytest.mark.parametrize("seed", range(2))
def test_components_equal_union_find(spark, seed):
    rng = random.Random(seed)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(180)] + [(500 + i, 501 + i) for i in range(40)]
    links += [(900, 1000 + i) for i in range(50)] + [(7, 7)]
    nodes = {n for link in links for n in link if link[0] != link[1]}
    want = least_reachable(nodes, [x for x in links if x[0] != x[1]])
    got = components(spark.createDataFrame(links, "u long, v long")).collect()
    assert {r.node: r.component for r in got} == want and len(got) == len(want)


def test_components_of_no_links(spark):
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_universal_minima_estimate_similarity():
    rng = random.Random(1)
    a = [f"w{rng.randrange(10**6)}" for _ in range(800)]
    b = a[:600] + [f"w{rng.randrange(10**6)}" for _ in range(200)]
    x, y = neardup.shingles(" ".join(a)), neardup.shingles(" ".join(b))
    true = len(set(x) & set(y)) / len(set(x) | set(y))
    assert abs((neardup.minima(x) == neardup.minima(y)).mean() - true) < 0.15


def near_copies(n_words, *changes):
    """A text and versions of it with the given words changed."""
    words = [f"w{i}" for i in range(n_words)]
    return [" ".join(f"x{i}" if i in change else w for i, w in enumerate(words)) for change in ((), *changes)]


@pytest.mark.parametrize("middle", [3, None])
def test_links_through_a_text_without_an_id(documents, middle):
    """The first and the last text are linked through the middle one only, which may have no id."""
    a, b, c = near_copies(120, {20, 60}, {20, 60, 90, 110})
    got = neardup.near_duplicates(documents([(1, a, None, None, 0), (middle, b, None, None, 0), (2, c, None, None, 0)])).collect()
    assert {r.component_id for r in got} == {1}


def test_one_row_of_each_group_whatever_its_id(documents):
    a, b = near_copies(60, {30})
    other, third = "quite another text of some more words than five", "a third one that has no copy at all here"
    rows = [(1, a), (2, b), (2, other), (None, a), (None, third), (None, third), (5, None), (5, None), (None, "")]
    docs = documents([(i, t, None, None, 0) for i, t in rows])
    kept = neardup.one_per_group(docs, neardup.near_duplicates(docs))
    assert kept.columns == docs.columns
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=repr) == sorted([(1, a), (2, other), (None, third), (5, None), (None, "")], key=repr)
