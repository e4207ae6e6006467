import math
import random
import re
from collections import Counter

import pytest

from hooklens.llm import lexical
from tests.llm.helpers import HARD, documents, lower

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def plain(rows, items, top=10):
    docs = [(i, TERM.findall(lower(t))) for i, t, *_ in rows]
    n_docs, n_terms = sum(1 for _, t in docs if t), sum(len(t) for _, t in docs)
    df = Counter(term for _, t in docs for term in set(t))
    out = []
    for item_id, text in items:
        asked, scored = Counter(TERM.findall(lower(text))), []
        for doc_id, terms in docs:
            tf, score = Counter(terms), 0
            m = 25 + 75 * len(terms) * n_docs // n_terms if n_terms else 0
            for term, times in asked.items():
                if tf[term]:
                    w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[term] + 1)))
                    score += times * w * (10**9 * tf[term] // (1000 * tf[term] + 8 * m))
            if score > 0:
                scored.append((-score, doc_id is None, doc_id or 0, doc_id))
        out += [(item_id, r + 1, s[3], -s[0]) for r, s in enumerate(sorted(scored)[:top])]
    return sorted(out, key=str)


def found(spark, rows, items):
    table = spark.createDataFrame(items, "item_id long, text string")
    got = lexical.search(documents(spark, rows), table).collect()
    return sorted(((r.item_id, r["rank"], r.doc_id, r.score) for r in got), key=str)


ITEMS = [
    (1, "Same WORD end, seven"), (2, None), (3, ""), (4, "nowhere to be found"), (5, "été naïve 日本 🙂🙂 é"),
    (5, "same same same one one"), (None, "ten words now"), (6, "x" * 70000), (-(2**63), "İstanbul endoftext 日本"),
]


def test_hard_rows(spark):
    assert found(spark, HARD, ITEMS) == plain(HARD, ITEMS)
    assert found(spark, [], ITEMS) == [] and found(spark, HARD, []) == []
    nothing = [(1, None, "en", "a"), (2, "...", "en", "a")]
    assert found(spark, nothing, ITEMS) == []


@pytest.mark.parametrize("block,cells", [(2_000_000, 1 << 20), (120, 40)])
def test_against_every_document(spark, block, cells, monkeypatch):
    """Ties, repeated rows and overlapping terms; blocks and score tables of any size."""
    monkeypatch.setattr(lexical, "BLOCK_BYTES", block)
    monkeypatch.setattr(lexical, "_CELLS", cells)
    rng = random.Random(block)
    vocabulary = ["a", "b", "ab", "abc", "b2", "c", "été", " x", "日", "the", "the1", "z9"]
    text = lambda n: rng.choice([" ", "-", "\n\n", "., "]).join(rng.choices(vocabulary, k=n))
    rows = [(rng.randrange(60), text(rng.randint(0, 12)), "en", "s") for _ in range(150)]
    rows += [(1000 + i, "The a-b", "en", "s") for i in range(30)] + [(None, "the A b", "en", "s")] * 3
    items = [(i, text(rng.randint(1, 6))) for i in range(12)] + [(3, "the a b")]
    assert found(spark, rows, items) == plain(rows, items)


def test_boundaries():
    assert lexical.boundaries("Ab-Cé_x".encode()) == b" ab c\xc3\xa9 x "
    block = lexical.Block.of([(1, b"a b a"), (2, b"ab")])
    assert {block.terms[t]: n for t, n in block.found(lexical.boundaries(b"a b ab a  xa aab b")).items()} == {b"a": 2, b"b": 2, b"ab": 1}
