import random

import numpy as np
import pytest
import xxhash

from hooklens.llm import simhash
from tests.llm.helpers import HARD, WORDS, documents, lower


def plain_print(text):
    words = WORDS.findall(lower(text))
    if not words:
        return 0
    size = min(3, len(words))
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i : i + size]).encode(), 42) for i in range(len(words) - size + 1)]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain(prints):
    """Components over all pairs, as the smallest position."""
    parent = list(range(len(prints)))

    def find(a):
        while parent[a] != a:
            a = parent[a]
        return a

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 3:
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(prints))]


def expected(rows):
    prints = [plain_print(t) for _, t, *_ in rows]
    roots = plain(prints)
    least = {}
    for r, root in zip(rows, roots):
        if r[0] is not None:
            least[root] = min(least.get(root, r[0]), r[0])
    return sorted(((r[0], f"{p:016x}", least.get(root)) for r, p, root in zip(rows, prints, roots)), key=str)


def found(spark, rows):
    got = simhash.near_duplicates(documents(spark, rows)).collect()
    return sorted(((r.doc_id, r.fingerprint, r.component_id) for r in got), key=str)


def test_hard_rows_and_id_extremes(spark):
    least, most = -(2**63), 2**63 - 1
    rows = HARD + [(least, "some words of its own here", "en", "a"), (most, "Some words of its own here", "en", "a")]
    assert found(spark, rows) == expected(rows)
    assert found(spark, []) == []


def test_rows_without_an_id(spark):
    rows = [(None, "only these nameless words", "en", "a"), (None, None, "en", "a"), (4, "", "en", "a")]
    got = found(spark, rows)
    assert got == expected(rows)
    assert (None, "0000000000000000", 4) in got


def test_edited_texts_against_all_pairs(spark):
    rng, rows, ids = random.Random(7), [], iter(random.Random(8).sample(range(10**6), 300))
    for size in (4, 30, 300):
        base = [f"w{size}x{rng.randrange(400)}" for _ in range(size)]
        for _ in range(60):
            words = list(base)
            for _ in range(rng.randint(0, max(1, size // 30))):
                words[rng.randrange(size)] = f"z{rng.randrange(99)}"
            rows.append((next(ids), " ".join(words), "en", "s"))
    assert found(spark, rows) == expected(rows)


def close(centre, rng, bits):
    for b in rng.sample(range(64), bits):
        centre ^= 1 << b
    return centre


def roots_of(spark, prints):
    table = spark.createDataFrame([(int(np.uint64(p).view(np.int64)),) for p in prints], "fp long")
    labels = {r.node: r.label for r in simhash.components(simhash.join_edges(table)).collect()}
    signed = [int(np.uint64(p).view(np.int64)) for p in prints]
    return [labels.get(s, s) for s in signed]


def same_groups(a, b):
    return len(set(zip(a, b))) == len(set(a)) == len(set(b))


@pytest.mark.parametrize("crowd", [2048, 40, 5])
def test_links_of_crowded_buckets(spark, crowd, monkeypatch):
    """Hot halves at every level: a dense ball, one shared half, and random prints."""
    monkeypatch.setattr(simhash, "CROWD", crowd)
    rng = random.Random(crowd)
    prints = {rng.getrandbits(64) for _ in range(150)}
    centre = rng.getrandbits(64)
    prints |= {close(centre, rng, rng.randint(0, 6)) for _ in range(150)}
    half = rng.getrandbits(32) << 32
    prints |= {half | rng.getrandbits(32) for _ in range(100)}
    quarter = half | rng.getrandbits(16) << 16
    prints |= {quarter | rng.getrandbits(16) for _ in range(100)}
    prints |= {quarter | rng.getrandbits(8) << 3 for _ in range(100)}
    prints = sorted(prints)
    assert same_groups(roots_of(spark, prints), plain(prints))


def test_every_pair_of_three_bits_meets_once():
    rng = random.Random(3)
    for _ in range(300):
        a = rng.getrandbits(64)
        b = close(a, rng, rng.randint(1, 3))
        met = 0
        for v in range(64):
            width, upper, bit = 32, v < 32, v % 32
            cut = [(p >> 32 if upper else p & 0xFFFFFFFF) & ~(1 << bit) for p in (a, b)]
            need = int(simhash._wildcards(np.array([v << 32]), np.array([0]), 1)[0])
            met += cut[0] == cut[1] and (a ^ b) & need == need
        assert 1 <= met <= 2


def test_tree_edges_are_few():
    prints = np.array([1 << i for i in range(60)], dtype=np.uint64)
    x, y = simhash._tree(prints, np.uint64(0))
    assert len(x) == 59 and max(np.unique(np.concatenate((x, y)), return_counts=True)[1]) <= 3
