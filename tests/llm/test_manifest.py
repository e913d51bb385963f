import hashlib
import zlib
from collections import defaultdict

import pytest

from llm_fixtures import documents, odd, odd_rows  # noqa: F401

from commutewell.llm import manifest


def sha(text):
    return hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest()


def leaf(doc_id, text, lang, source, n_chars):
    values = (doc_id, source, lang, n_chars, text)
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def tree(nodes):
    """Levels of a tree from its leaves to its root."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        level = levels[-1]
        levels.append([sha("".join(level[i : i + 2])) for i in range(0, len(level), 2)])
    return levels


def siblings(levels, pos):
    """Of each level below the root: the sibling and whether it is on the left, or nothing."""
    out = []
    for level in levels[:-1]:
        other = pos ^ 1
        out.append((level[other], other < pos) if other < len(level) else ("", False))
        pos >>= 1
    return out


def brute_force(rows):
    groups = defaultdict(list)
    for row in rows:
        groups[(row[2] is not None, (row[2] or "").encode())].append(row)
    order = sorted(groups)
    trees, members = {}, {}
    for key in order:
        members[key] = sorted(groups[key], key=lambda r: (r[0] is not None, r[0] or 0, leaf(*r)))
        trees[key] = tree([leaf(*r) for r in members[key]])
    top = tree([trees[key][-1][0] for key in order])
    out = []
    for at, key in enumerate(order):
        for pos, row in enumerate(members[key]):
            path = siblings(trees[key], pos) + siblings(top, at)
            found = row
            if row[0] is not None and row[4] is not None and zlib.crc32(str(row[0]).encode()) % 7 == 0:
                found = (*row[:4], row[4] + 1)
            node = leaf(*found)
            for other, left in path:
                node = sha(other + node if left else node + other)
            root = top[-1][0]
            out.append((row[0], leaf(*row), trees[key][-1][0], root, sha("".join(o for o, _ in path)), node, node == root))
    return sorted(out, key=repr)


def results(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_odd_rows(odd, documents):
    assert results(manifest.manifest(odd)) == brute_force(odd_rows())
    assert manifest.manifest(documents([])).collect() == []


@pytest.mark.parametrize("span", [2, 10])
def test_trees_of_all_heights(documents, monkeypatch, span):
    """Languages of 1, 2, 3, ... rows, odd runs at every level, trees higher than what is built at a time."""
    monkeypatch.setattr(manifest, "SPAN", span)
    sizes = {None: 5, "": 1, "a": 1, "b": 2, "é": 3, "c": 33, "B": 97, "-": 4}
    rows = [(1000 * g + i, f"text {i}", lang, None, i if i % 3 else None) for g, (lang, n) in enumerate(sizes.items()) for i in range(n)]
    got = results(manifest.manifest(documents(rows)))
    assert got == brute_force(rows)
    verified = {doc_id: ok for doc_id, *_, ok in got}
    assert {i for i, ok in verified.items() if not ok} == {r[0] for r in rows if r[4] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0}


def test_repeated_rows_and_one_row(documents):
    rows = [(i // 3, "same", "en", "s", 4) for i in range(20)] + [(None, "x", "en", None, 1)] * 3
    assert results(manifest.manifest(documents(rows))) == brute_force(rows)
    assert results(manifest.manifest(documents(rows[:1]))) == brute_force(rows[:1])


def test_any_change_moves_the_root(documents):
    rows = [(i, f"text {i}", "en", None, 1) for i in range(30)]
    root = manifest.manifest(documents(rows)).first().root
    for n, change in ((3, (3, "text 3", "en", "s", 1)), (29, (29, "text 29 ", "en", None, 1)), (0, (0, "text 0", None, None, 1))):
        assert manifest.manifest(documents(rows[:n] + [change] + rows[n + 1 :])).first().root != root
