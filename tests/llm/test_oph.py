"""One-permutation fingerprints: edits, estimates, order."""

import hashlib

from llm_fixtures import corpus, documents, odd  # noqa: F401

from commutewell.llm import oph
from commutewell.llm.common import ascii_words


def similarity(a, b):
    def shingles(t):
        w = ascii_words(t)
        return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()

    a, b = shingles(a), shingles(b)
    return len(a & b) / len(a | b) if a | b else 1.0


def test_edits_and_estimates(documents, corpus):
    docs = documents([(7 * i, t, None, None, None) for i, t in corpus])
    got = sorted(oph.fingerprints(docs).collect(), key=lambda r: r.doc_id)
    texts = [t for _, t in corpus]
    errors = []
    for n, r in enumerate(got):
        text, after = texts[n], texts[(n + 1) % len(texts)]
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        assert (r.doc_id, r.n_chars) == (7 * n, len(text))
        assert r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        if min(len(text.split()), len(after.split())) >= 40:  # sets of a few shingles leave much to chance
            errors += [abs(r.near_edited - similarity(text, edited)), abs(r.near_next - similarity(text, after))]
    assert len(errors) > 100 and sum(errors) / len(errors) < 0.04 and max(errors) < 0.25
    prints = {}
    for n, r in enumerate(got):
        prints.setdefault(texts[n], set()).add(r.fingerprint)
        assert len(r.fingerprint) == oph.BINS
    assert all(len(p) == 1 for p in prints.values())


def test_bucket_borders(documents):
    rows = [(i * i, f"text number {i} " * 3, None, None, None) for i in range(200)]
    got = {r.doc_id: (r.text, r.next_text) for r in oph.in_order(documents(rows), bucket_rows=8).collect()}
    for n, (i, text, *_) in enumerate(rows):
        assert got[i] == (text, rows[(n + 1) % len(rows)][1])


def test_buckets_are_even_whatever_the_ids(documents, monkeypatch):
    """One far id, and more rows than ranges: about equal buckets, the order as it is."""
    from pyspark.sql import functions as F

    monkeypatch.setattr(oph, "RANGES", 8)
    rows = [(i, f"text {i}", None, None, None) for i in range(1999)] + [(10**15, "far", None, None, None)]
    docs = documents(rows)
    a, b = oph._buckets(docs, 32)(F.col("doc_id"), F.col("text"))
    sizes = [r["count"] for r in docs.groupBy(a.alias("a"), b.alias("b")).count().collect()]
    assert sum(sizes) == 2000 and max(sizes) <= 300  # the far id widens its own range of 250 rows only
    assert sorted(sizes)[len(sizes) // 2] <= 2 * 32
    got = {r.doc_id: r.next_text for r in oph.in_order(docs, bucket_rows=32).collect()}
    assert got == {rows[n][0]: rows[(n + 1) % 2000][1] for n in range(2000)}


def test_rows_without_ids_follow_one_another(documents):
    """All rows have one next row, each is next once, with and without any id."""
    for rows in ([(None, f"t{i}", None, None, None) for i in range(60)], [(i if i % 3 else None, f"t{i}", None, None, None) for i in range(60)]):
        got = oph.in_order(documents(rows), bucket_rows=8).collect()
        assert sorted(r.text for r in got) == sorted(r.next_text for r in got) == sorted(r[1] for r in rows)


def test_densification_leaves_no_bin_empty(spark):
    from pyspark.sql import functions as F

    df = spark.createDataFrame([("only three words",), (" ".join(f"w{i}" for i in range(30)),)], "text string")
    rows = df.select(oph.minima(oph.shingle_hashes(F.col("text"))).alias("m"), oph.densified(oph.minima(oph.shingle_hashes(F.col("text")))).alias("d")).collect()
    mark = (1 << oph._SHIFT) - 1
    for r in rows:
        filled = {v for v in r.m if v & mark != mark}
        assert len(r.m) == len(r.d) == oph.BINS and set(r.d) == filled
    assert len({v for v in rows[0].m if v & mark != mark}) == 1


def test_no_python_in_the_plan(odd):
    plan = oph.fingerprints(odd)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_odd_rows_and_empty_table(odd):
    got = oph.fingerprints(odd).collect()
    assert len(got) == odd.count()
    by = {r.doc_id: r for r in got if r.doc_id is not None}
    assert [by[i].fingerprint for i in (1, 2, 3)] == ["", "", ""] and by[1].near_next == 1.0
    assert by[6].fingerprint == by[7].fingerprint == by[8].fingerprint and by[6].near_next == 1.0
    assert all(0 <= x <= 1 for r in got for x in (r.near_edited, r.near_next))
    assert oph.fingerprints(odd.limit(0)).count() == 0


def test_only_document_is_followed_by_itself(documents):
    r = oph.fingerprints(documents([(5, "abcd", None, None, None)])).first()
    assert r.edited_sha256 == hashlib.sha256(b"abab").hexdigest() and r.near_next == 1.0
