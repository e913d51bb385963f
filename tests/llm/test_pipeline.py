"""The stages in order, their columns, and the registered queries."""

import os
import re

import check_queries
import pytest

from llm_fixtures import documents, odd  # noqa: F401

import __spark_entry__ as entry
import corpus_pipeline
from commutewell.llm.common import stored

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
OPS = [n for n in entry.queries() if re.match(r"op\d+_", n)]


def test_one_query_per_operator():
    assert [int(n[2:].split("_")[0]) for n in OPS] == list(range(1, 14))
    assert "pipeline" in entry.queries()


def test_stages_keep_the_columns_and_their_decisions(spark, odd, tmp_path):
    spark.createDataFrame([(6, 1, 0), (9, 1, 1)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    docs, seen = odd, []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stored(stage(spark, docs, str(tmp_path)), name)
        assert docs.columns == odd.columns
        seen.append(sorted(r.doc_id for r in docs.collect() if r.doc_id is not None))
    assert seen[0] == [5, 6, 7, 7, 8, 9, 10] and seen[1] == seen[0]
    assert seen[2] == seen[3] == [5, 6, 9, 10]
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, str(tmp_path)).collect()
    assert {r.doc_id for r in packed} == {None, 5, 6, 9, 10}


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
def test_run_reaches_the_end(spark):
    rows = corpus_pipeline.run(spark, SF).collect()
    assert rows and max(r.offset + r.length for r in rows) <= 2048


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
@pytest.mark.parametrize("name", OPS)
def test_query_equals_its_sql(spark, name):
    assert check_queries.compare(spark, check_queries.oracle(SF), name, SF) is None


def test_sequences_follow_the_mixture(spark, documents):
    """Every stretch of sequences holds the sources as the mixed rows of that stretch do."""
    import random

    from llm_words import prose

    from commutewell.llm import mixing, packing

    rng = random.Random(5)
    rows = [(i, prose(rng, "en", 4 + i % 60), "en", "small" if i % 12 == 0 else "big", 1) for i in range(4000)]
    docs = stored(mixing.mixed_rows(documents(rows)), "mixed-test")
    order = [r[0] for r in mixing.mix(documents(rows)).orderBy("turn", "place").select("row.doc_id").collect()]
    at = {doc: n for n, doc in enumerate(order)}
    got = packing.pack(docs, capacity=256, block_items=50, in_order=True).orderBy("sequence_id", "offset").collect()
    assert sorted({r.doc_id for r in got}) == sorted(at)
    held = {}
    for r in got:
        held.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in held.values():
        assert all(a + n == b for (a, n), (b, _) in zip(sorted(places), sorted(places)[1:])) and sum(n for _, n in places) <= 256
    pieces = [at[r.doc_id] / len(order) for r in got]
    assert max(abs(place - n / len(pieces)) for n, place in enumerate(pieces)) < 0.2
    small = {i for i, *_, source, _ in rows if source == "small"}
    for stop in range(len(pieces) // 10, len(pieces), len(pieces) // 10):
        share = sum(r.doc_id in small for r in got[:stop]) / stop
        mixed = sum(doc in small for doc in order[: round(stop * len(order) / len(pieces))]) / round(stop * len(order) / len(pieces))
        assert abs(share - mixed) < 0.05
