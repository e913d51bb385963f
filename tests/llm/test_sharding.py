"""Virtual slots: loads, places, edits of the map."""

import random
import zlib

from llm_fixtures import documents, odd  # noqa: F401

from commutewell.llm import sharding


def shards_of(docs, tmp_path, **kw):
    return sharding.shard(docs, f"file://{tmp_path}/map", **kw).collect()


def check(got, rows):
    assert sorted((repr(r.doc_id), r.size, r.text_crc32) for r in got) == sorted(
        (repr(i), len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t, *_ in rows
    )
    held = {}
    for r in got:
        held.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(places) == list(range(len(places))) for places in held.values())


def test_sizes_are_near_equal_and_places_gapless(documents, tmp_path):
    rng = random.Random(3)
    rows = [(i, "é" * rng.randrange(400), None, None, None) for i in range(1200)]
    got = shards_of(documents(rows), tmp_path, shards=6)
    check(got, rows)
    loads = [sum(r.size for r in got if r.shard == s) for s in range(6)]
    assert max(loads) - min(loads) < 0.01 * sum(loads) / 6


def test_a_slot_never_leaves_its_shard(documents, tmp_path):
    rows = [(i, "x" * (i % 90), None, None, None) for i in range(500)]
    got = shards_of(documents(rows), tmp_path, slots=64, shards=5)
    check(got, rows)
    assert len({(r.virtual_slot, r.shard) for r in got}) == len({r.virtual_slot for r in got})


def test_odd_rows_and_empty_table(odd, tmp_path):
    check(shards_of(odd, tmp_path / "a"), [tuple(r)[:2] for r in odd.collect()])
    assert shards_of(odd.limit(0), tmp_path / "b") == []


def test_versions_are_kept(spark, tmp_path):
    path = f"file://{tmp_path}/m"
    sharding.write_map(spark, path, 0, [0, 1, 0, 1], [5, 6, 7, 8])
    sharding.write_map(spark, path, 1, [0, 1, 1, 1], [5, 6, 7, 8])
    assert sorted(map(tuple, sharding.read_map(spark, path, 0).collect())) == [(0, 0, 0), (1, 1, 0), (2, 0, 5), (3, 1, 6)]
    assert sorted(map(tuple, sharding.read_map(spark, path, 1).collect())) == [(0, 0, 0), (1, 1, 0), (2, 1, 6), (3, 1, 13)]


def test_rebalancing_edits_only_what_helps():
    even = [s % 4 for s in range(40)]
    assert sharding.rebalanced(even, [10] * 40, 4) == even
    grown = sharding.rebalanced([0, 0, 0, 0, 1, 1], [7, 1, 5, 3, 2, 2], 2)
    loads = [sum(s for s, o in zip([7, 1, 5, 3, 2, 2], grown) if o == shard) for shard in (0, 1)]
    assert abs(loads[0] - loads[1]) <= 2
    assert sharding.rebalanced([0] * 5, [0, 0, 100, 0, 0], 3) == [0] * 5  # one slot can't be split
