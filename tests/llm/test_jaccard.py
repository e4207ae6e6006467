import random

import pytest

from hooklens.llm import jaccard
from tests.llm.helpers import HARD, WORDS, documents, lower


def shingles(text):
    words = WORDS.findall(lower(text))
    return frozenset(tuple(words[i : i + 5]) for i in range(len(words) - 4)) if len(words) >= 5 else frozenset([tuple(words)] if words else [])


def plain(rows):
    """component by document position, over all pairs."""
    sets = [shingles(t) for _, t, *_ in rows]
    parent = list(range(len(rows)))

    def find(a):
        while parent[a] != a:
            a = parent[a]
        return a

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and rows[i][0] is not None and rows[j][0] is not None and 100 * both >= 75 * (len(sets[i]) + len(sets[j]) - both):
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    groups = {}
    for i, r in enumerate(rows):
        groups.setdefault(find(i), []).append(r[0])
    return sorted(
        ((r[0], len(sets[i]), None if r[0] is None else min(groups[find(i)])) for i, r in enumerate(rows)), key=str
    )


def found(spark, rows):
    got = jaccard.near_duplicates(documents(spark, rows)).collect()
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=str)


def edited(words, rng, changes):
    words = list(words)
    for _ in range(changes):
        words[rng.randrange(len(words))] = f"z{rng.randrange(10**6)}"
    return " ".join(words)


@pytest.mark.parametrize("seed", [1, 2])
def test_components_match_all_pairs(spark, seed, monkeypatch):
    # small chunks and bucket parts, so that their borders are met
    monkeypatch.setattr(jaccard, "CHUNK_TOKENS", 700)
    rng = random.Random(seed)
    passage = [f"p{i}" for i in range(40)]
    rows, ids = [], iter(rng.sample(range(5000), 400))
    for size in (6, 8, 12, 30, 80, 200):
        base = [f"b{size}x{rng.randrange(200)}" for _ in range(size)]
        rows += [(next(ids), edited(base, rng, rng.randint(0, max(1, size // 14))), "en", "s") for _ in range(20)]
    # one large group of chained near copies, copies of one text, and texts around a common passage
    base = [f"g{i}" for i in range(100)]
    for _ in range(60):
        base = edited(base, rng, 1).split(" ")
        rows.append((next(ids), " ".join(base).upper(), "en", "s"))
    rows += [(next(ids), "exact copy of the very same seven words", "en", "s") for _ in range(30)]
    rows += [(next(ids), " ".join(passage + [f"o{rng.randrange(10**6)}" for _ in range(rng.randint(5, 60))]), "en", "s") for _ in range(60)]
    rows += [(next(ids), t, None, None) for t in ("", None, "one", "ONE", "one two", " one\ttwo ", "one two three four five")]
    assert found(spark, rows) == plain(rows)


def test_hard_rows(spark):
    assert found(spark, HARD) == plain(HARD)


def test_empty_table_and_class_ids(spark):
    assert jaccard.near_duplicates(documents(spark, [])).count() == 0
    rows = jaccard.near_duplicates(documents(spark, [(5, "a b c d e f", "x", "y"), (3, "A B c d e f", "x", "y"), (4, "q", "x", "y")])).collect()
    assert {(r.doc_id, r.class_id, r.component_id) for r in rows} == {(5, 3, 3), (3, 3, 3), (4, 4, 4)}


def test_prefix_bounds():
    for n in range(1, 400):
        need = -(-75 * n // 100)
        assert jaccard.least_shared(n) == need and jaccard.prefix_size(n) == n - need + 1
        q, own = jaccard._long_prefix(n, 75)
        for other in range(need, n * 4 // 3 + 1):
            more = min(max(1, int(jaccard.EXTRA * n)), max(1, int(jaccard.EXTRA * other)))
            assert own <= more and q <= n


def test_id_extremes(spark):
    """The least and the greatest id, in one slice and as partners."""
    least, most = -(2**63), 2**63 - 1
    text = "some eight words that are all quite common"
    rows = [(5, text, "en", "a"), (least, text.upper(), "en", "a"), (most, text, "en", "a"), (0, "alone here", "en", "a")]
    assert found(spark, rows) == plain(rows)
    assert {c for i, _, c in found(spark, rows) if i != 0} == {least}


def test_a_passage_of_many_texts_makes_no_candidates(spark, monkeypatch):
    """Texts around one passage share the tokens of their prefixes, but own too many to link; those that link do."""
    counts = []
    intersected = jaccard.intersected

    def counted(lists, *rest):
        counts.append(sum(len(r.ys) for r in lists.select("ys").collect()))
        return intersected(lists, *rest)

    monkeypatch.setattr(jaccard, "intersected", counted)
    passage = [f"p{i}" for i in range(40)]
    # own tokens are shared by nine texts at most; those of a row link, those of different rows do not
    texts = [" ".join(passage + [f"r{i // 9}x{j}" for j in range(6)] + [f"c{i % 9}x{j}" for j in range(6)]) for i in range(81)]
    rows = [(i, t, "en", "s") for i, t in enumerate(texts)]
    assert found(spark, rows) == plain(rows)
    assert sum(counts) < 16 * len(rows)


def test_a_chunk_names_a_node_once(spark, monkeypatch):
    """Many of a group do not link; further rounds of leaders, and a look-up of sets that does not grow with pairs."""
    seen = []

    def kept(df, name):
        made = written(df, name)
        seen.extend([made] if name == "intersected" else [])
        return made

    written = jaccard.written
    monkeypatch.setattr(jaccard, "written", kept)
    monkeypatch.setattr(jaccard, "CHUNK_TOKENS", 2000)
    monkeypatch.setattr(jaccard, "LEADERS", (4, 16))
    monkeypatch.setattr(jaccard, "CROWDED", 0)
    rng = random.Random(5)
    base = [f"w{i}" for i in range(120)]
    rows = [(i, edited(base, rng, rng.randint(2, 5)), "en", "s") for i in range(160)]
    assert found(spark, rows) == plain(rows)
    assert len(seen) > 3
    for left in seen:
        pairs = [y for r in left.filter("x IS NOT NULL").collect() for y in r.ys]
        once = [y for r in left.filter("x IS NULL").collect() for y in r.ys]
        assert sorted(once) == sorted(set(pairs))
    assert len(pairs) > 5 * len(once)
