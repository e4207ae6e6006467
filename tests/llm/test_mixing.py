from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from hooklens.llm import mixing
from tests.llm.helpers import HARD, WORDS, documents

DIMS = ("source", "lang", "topic")


def rows_of(n=600):
    return [
        (i, "w " * (1 + i * 37 % 900), ("en", "fr", "de", None)[i % 7 % 4], "hot" if i % 3 == 0 else f"s{i % 5}") for i in range(n)
    ]


def plain_rake(cells, targets, rounds):
    total = sum(cells.values())
    weight = {c: t / total for c, t in cells.items()}
    shares = {}
    for k, d in enumerate(targets):
        sums = defaultdict(float)
        for c, t in cells.items():
            sums[c[k]] += t
        wanted = targets[d]
        raw = {v: (wanted.get(v, 0.0) if isinstance(wanted, dict) else s**wanted) for v, s in sums.items()}
        whole = sum(raw.values())
        shares[k] = {v: r / whole for v, r in raw.items()}
    for _ in range(rounds):
        for k in shares:
            sums = defaultdict(float)
            for c, w in weight.items():
                sums[c[k]] += w
            weight = {c: w * shares[k][c[k]] / sums[c[k]] if sums[c[k]] else 0.0 for c, w in weight.items()}
    whole = sum(weight.values())
    return {c: w / whole / (cells[c] / total) for c, w in weight.items()}


@pytest.mark.parametrize("targets", [
    {"source": 0.5, "lang": 0.5, "topic": 0.5},
    {"source": {"hot": 1.0, "s1": 1.0, "s2": 2.0, "gone": 5.0}, "lang": 0.0},
])
def test_weights_match_plain_fitting(spark, targets):
    rows = mixing.mix(documents(spark, rows_of()), targets).collect()
    cells = defaultdict(int)
    key = lambda r: tuple("(none)" if r[d] is None else r[d] for d in targets)
    for r in rows:
        assert r.n_tokens == len(WORDS.findall(r.text or ""))
        cells[key(r)] += r.n_tokens
    want = plain_rake(cells, targets, 40)
    for r in rows:
        assert r.cell_weight == pytest.approx(want[key(r)], rel=2e-2, abs=2e-3)
        assert r.probability == pytest.approx(min(1.0, 0.5 * r.cell_weight))
        assert r.weight == pytest.approx(max(1.0, 0.5 * r.cell_weight))


def test_sample_follows_probabilities_and_seed(spark):
    docs = documents(spark, rows_of(3000))
    rows = mixing.mix(docs, rate=0.4).collect()
    expected = sum(r.probability for r in rows)
    drawn = sum(r.sampled for r in rows)
    assert abs(drawn - expected) < 4 * sum(r.probability * (1 - r.probability) for r in rows) ** 0.5
    assert all(r.sampled for r in rows if r.probability == 1.0)
    again = mixing.mix(docs.repartition(7), rate=0.4).collect()
    assert {(r.doc_id, r.sampled) for r in again} == {(r.doc_id, r.sampled) for r in rows}
    other = mixing.mix(docs, rate=0.4, seed=2).collect()
    assert {(r.doc_id, r.sampled) for r in other} != {(r.doc_id, r.sampled) for r in rows}


def test_hard_rows_and_empty_table(spark):
    rows = mixing.mix(documents(spark, HARD)).collect()
    assert len(rows) == len(HARD) and all(r.probability is not None and 0 <= r.probability <= 1 for r in rows)
    twice = [r.sampled for r in rows if r.doc_id == 5]
    assert len(set(twice)) == 1
    assert mixing.mix(documents(spark, [])).count() == 0
    clash = documents(spark, [(0, "a b", "x", "y")]).withColumnRenamed("n_chars", "Weight")
    assert mixing.mix(clash).first().n_tokens == 2


def test_own_topic_and_uncut_probabilities(spark):
    rows = [(i, "word " * (3 + i % 50), "en" if i % 9 else "fr", "a" if i % 3 else "b") for i in range(400)]
    docs = documents(spark, rows).withColumn("Topic", F.when(F.col("doc_id") % 7 == 0, "rare").otherwise("T"))
    kept = mixing.mix(docs, targets={"lang": 0.2, "topic": 0.5}, rate=0.9, cut=False).collect()
    assert {r.topic for r in kept} == {"rare", "T"} and len(kept) == 400
    assert max(r.probability for r in kept) <= 1.0 + 1e-12 and {r.weight for r in kept} == {1.0}
    assert max(r.probability for r in kept) > 0.999
    total = sum(r.n_tokens * r.probability for r in kept)
    share = sum(r.n_tokens * r.probability for r in kept if r.lang == "fr") / total
    tokens = {lang: sum(r.n_tokens for r in kept if r.lang == lang) for lang in ("en", "fr")}
    assert abs(share - tokens["fr"] ** 0.2 / (tokens["fr"] ** 0.2 + tokens["en"] ** 0.2)) < 1e-3
