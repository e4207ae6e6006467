import zlib
from collections import Counter

import pytest

from hooklens.llm import sharding
from tests.llm.helpers import HARD, documents


@pytest.mark.parametrize("rows_per_bucket", [4, 1024])
def test_mixture_sizes_and_slots(spark, monkeypatch, rows_per_bucket):
    monkeypatch.setattr(sharding, "LEAST_BUCKET", rows_per_bucket)
    monkeypatch.setattr(sharding, "bucket_rows", lambda rows: rows_per_bucket)
    rows = [(i, f"text {i % 50}", "en", "hot" if i % 3 == 0 else f"s{i % 7}") for i in range(403)]
    found = sharding.shard_documents(documents(spark, rows)).collect()
    assert sorted(r.doc_id for r in found) == list(range(403))
    shards = Counter(r.shard for r in found)
    assert set(shards) == set(range(8)) and max(shards.values()) - min(shards.values()) <= 1
    for shard, n in shards.items():
        assert sorted(r.slot for r in found if r.shard == shard) == list(range(n))
    for source, n in Counter(r.source for r in found).items():
        share = [sum(r.source == source and r.shard == k for r in found) for k in range(8)]
        assert max(share) - min(share) <= 2
    again = sharding.shard_documents(documents(spark, rows[::-1]).repartition(5)).collect()
    assert {(r.doc_id, r.shard, r.slot) for r in found} == {(r.doc_id, r.shard, r.slot) for r in again}


def test_ranks_match_plain_python(spark):
    rows = [(i, "t", None, "a" if i % 4 else "b") for i in range(40)]
    found = sharding.shard_documents(documents(spark, rows), shards=1).collect()
    order = [r.source for r in sorted(found, key=lambda r: r.slot)]
    n = Counter(order)
    seen = Counter()
    keys = []
    for s in order:
        seen[s] += 1
        keys.append(((2 * seen[s] - 1) / (2 * n[s]), "+" + s))
    assert keys == sorted(keys)


def test_hard_rows(spark):
    found = sharding.shard_documents(documents(spark, HARD)).collect()
    assert len(found) == len(HARD)
    by_id = {}
    for i, t, *_ in HARD:
        by_id[i] = (len((t or "").encode()) + 1, zlib.crc32((t or "").encode()))
    assert all((r.size, r.text_crc32) == by_id[r.doc_id] and r.law == "rows" and r.grown_shard is None for r in found)
    assert sharding.shard_documents(documents(spark, [])).count() == 0
