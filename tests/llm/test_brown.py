import math
import zlib
from collections import Counter

import numpy as np
import pytest

from hooklens.llm import brown, queries
from tests.llm.helpers import HARD, WORDS, documents, lower


def words(text):
    return WORDS.findall(lower(text)) + [None]


@pytest.mark.parametrize("clustered", [3, 200_000])
def test_counts_base_and_known(spark, monkeypatch, clustered):
    monkeypatch.setattr(brown, "MAX_HEAD", clustered)
    docs = documents(spark, HARD + [(20 + i, f"the cat {i} sat on the mat {i % 3}", "en", "s") for i in range(40)])
    train = docs.filter("doc_id is not null and doc_id % 3 <> 1")
    rows = brown.score(docs, brown.train(train, passes=3)).collect()
    count = Counter(w for r in train.collect() for w in words(r.text))
    n, v = sum(count.values()), len(count)
    texts = Counter((r.doc_id, zlib.crc32((r.text or "").encode())) for r in docs.collect())
    assert len(rows) == sum(texts.values())
    by_id = {r.doc_id: r.text for r in docs.collect()}
    for r in rows:
        own = words(by_id[r.doc_id])
        base = sum(math.log10((count[w] + 1) / (n + v + 1)) for w in own)
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(own), sum(count[w] > 0 for w in own), n)
        assert r.base_score == pytest.approx(base, rel=1e-9) and r.score < 0
        assert r.perplexity == pytest.approx(10 ** (-r.score / r.n_tokens))


def classes_of(trained):
    """Word: (class, count), of the head and of the vocabulary table."""
    m, out = trained.model, {}
    for row in trained.vocabulary.collect():
        names = bytes(row["words"]).split(b"\n") if row["words"] else []
        for word, own, count in zip(names, brown.unpack(row["classes"], "u2"), brown.unpack(row["counts"], "i8")):
            n = m.number.get(word)
            out[word.decode()] = (int(own) if n is None else int(m.classes[n]), int(count))
    return out


SMALL = [(i, " ".join(f"w{(i * k * k) % 23}" for k in range(12)) + f" only{i} pair{i // 2}", None, None) for i in range(40)]


@pytest.mark.parametrize("head", [5, 200_000])
def test_model_against_plain_python(spark, monkeypatch, head):
    """Scores, recomputed word by word from the classes alone; every word seen twice has a class, others none."""
    monkeypatch.setattr(brown, "MAX_HEAD", head)
    docs = documents(spark, SMALL + HARD)
    trained = brown.train(docs.filter("doc_id % 5 <> 0"), classes=4, passes=4)
    own = classes_of(trained)
    assert (len(trained.model.number) < 6) == (head == 5)
    assert all((c == brown.RARE) == (n == 1) for c, n in own.values())
    kinds = len(trained.model.transition)
    texts = [words(r.text) for r in docs.filter("doc_id % 5 <> 0").collect()]
    kind = lambda w: brown.END if w is None else own.get(w, (brown.RARE, 0))[0]
    count = Counter(w for t in texts for w in t)
    pairs = Counter((kind(a), kind(b)) for t in texts for a, b in zip([None] + t, t))
    tokens, out = Counter(), Counter()
    for w, n in count.items():
        tokens[kind(w)] += n
    for (a, _), n in pairs.items():
        out[a] += n
    total, once = sum(count.values()), sum(n == 1 for w, n in count.items() if w is not None)

    def probability(before, w):
        a, b = kind(before), kind(w)
        prior = (tokens[b] + 1) / (total + kinds)
        step = (pairs[a, b] + brown.PRIOR * prior) / (out[a] + brown.PRIOR)
        if w is None:
            emit = 1.0
        elif b == brown.RARE:
            emit = (count[w] + 1) / (tokens[b] + once + 1)
        else:
            emit = count[w] / tokens[b]
        return brown.CLASS_WEIGHT * step * emit + (1 - brown.CLASS_WEIGHT) * (count[w] + 1) / (total + len(count) + 1)

    wanted = Counter()
    for r in docs.collect():
        text = words(r.text)
        value = sum(math.log10(probability(a, b)) for a, b in zip([None] + text, text))
        wanted[r.doc_id, round(value, 6)] += 1
    assert Counter((r.doc_id, round(r.score, 6)) for r in brown.score(docs, trained).collect()) == wanted
    assert np.allclose(trained.model.transition.sum(axis=1), 1.0)
    for c in range(brown.FIRST, kinds):
        inside = [n for k, n in own.values() if k == c]
        assert not inside or sum(inside) == tokens[c]


def test_best_class_of_few_contexts():
    rng = np.random.default_rng(3)
    matrix = rng.integers(0, 50, (9, 9)).astype(float)
    dense = rng.integers(0, 3, (40, 18)).astype(float)
    dense[:, 4] += 1
    own = rng.integers(brown.RARE, 9, 40)
    owner, cell = np.nonzero(dense)
    got = brown._best_sparse(own, owner, cell, dense[owner, cell], matrix)
    assert (got == brown._best_class(own, dense[:, :9], dense[:, 9:], matrix)).all()


def test_rest_takes_the_class_of_its_neighbours(spark, monkeypatch):
    """Words too rare for the head, each between words of one kind: they join the words that stand there, too."""
    rng = np.random.default_rng(5)
    rows = []
    for i in range(300):
        line = [f"{'ab'[k % 2]}{rng.integers(6)}" for k in range(30)]
        line[10] = f"rest-a{i % 100}"
        line[15] = f"rest-b{i % 100}"
        rows.append((i, " ".join(line), None, None))
    monkeypatch.setattr(brown, "MAX_HEAD", 1000)
    trained = brown.train(documents(spark, rows), classes=2, passes=8)
    assert not any(w.startswith(b"rest") for w in trained.model.number) and 0 <= trained.moved <= 1
    own = classes_of(trained)
    for side in "ab":
        head = {c for w, (c, _) in own.items() if w[0] == side}
        assert len(head) == 1
        rest = [c for w, (c, _) in own.items() if w.startswith(f"rest-{side}")]
        assert len(rest) == 100 and sum(c in head for c in rest) >= 95


def test_classes_find_alternation(spark):
    """Words of two kinds take turns, so a class bigram tells the kind of the next word."""
    rng = np.random.default_rng(4)
    texts = [" ".join(f"{'ab'[k % 2]}{rng.integers(20)}" for k in range(40)) for _ in range(150)]
    docs = documents(spark, [(i, t, None, None) for i, t in enumerate(texts)])
    trained = brown.train(docs.filter("doc_id < 120"), classes=4, passes=8)
    rows = brown.score(docs.filter("doc_id >= 120"), trained).collect()
    gain = sum(r.score - r.base_score for r in rows) / sum(r.n_tokens for r in rows)
    assert gain > 0.7 * math.log10(2)
    kinds = {}
    for word, number in trained.model.number.items():
        kinds.setdefault(int(trained.model.classes[number]), set()).add(word[:1])
    assert all(len(k) == 1 for k in kinds.values())


def test_nothing_to_learn(spark):
    none = documents(spark, [])
    rows = brown.score(documents(spark, HARD), brown.train(none)).collect()
    assert len(rows) == len(HARD) and all(r.n_known == 0 and r.train_tokens == 0 for r in rows)
    assert brown.score(none, brown.train(documents(spark, HARD))).count() == 0


def test_id_extremes(spark):
    rows = [(i, "some words of a text", "en", "a") for i in (-(2**63), 2**63 - 1, 0, None)]
    docs = documents(spark, rows)
    got = brown.score(docs, brown.train(docs)).collect()
    assert sorted((r.doc_id for r in got), key=str) == sorted((r[0] for r in rows), key=str)


def test_training_texts_become_blocks_once(spark, monkeypatch, tmp_path):
    rng = np.random.default_rng(7)
    rows = [(i, " ".join(f"w{rng.integers(60)}" for _ in range(30)), "en", "a") for i in range(60)]
    rows += [(None, "w1 w2 w1", "en", "a"), (61, None, "en", "a"), (3, "w5 new words", "en", "a")]
    documents(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    made = brown.blocks_of
    counts = []
    monkeypatch.setattr(brown, "blocks_of", lambda docs, *a: (counts.append(docs.count()), made(docs, *a))[1])
    got = queries.op1_brown_classes(spark, str(tmp_path)).collect()
    assert len(counts) == 2 and sum(counts) == len(rows) == len(got)
    trained = brown.train(documents(spark, rows), classes=4, passes=2)
    asked = [tuple(r) for r in brown.score(documents(spark, rows), trained).collect()]
    assert sorted(map(str, asked)) == sorted(str(tuple(r)) for r in brown.score_trained(trained).collect())


def test_sums_of_keys_let_go_of_their_parts():
    keys = [np.array([5, 2, 5], dtype=np.int64), np.zeros(0, np.int64), np.array([2**40, 2], dtype=np.int64)]
    values = [np.array([2**32 - 1, 2, 3], dtype=np.uint32), np.zeros(0, np.uint32), np.array([7, 1], dtype=np.uint32)]
    key, total = brown._summed(keys, values)
    assert key.tolist() == [2, 5, 2**40] and total.tolist() == [3, 2**32 + 2, 7] and not keys and not values
    assert [len(x) for x in brown._summed([np.zeros(0, np.int64)], [np.zeros(0, np.uint32)])] == [0, 0]


def test_a_scoring_task_has_one_worker(spark):
    """Looked-up blocks are scored where they are told; the words stay off the executors."""
    docs = documents(spark, SMALL + HARD)
    trained = brown.train(docs, classes=4, passes=2)
    plans = [s._jdf.queryExecution().optimizedPlan().toString() for s in (brown.score(docs, trained), brown.score_trained(trained))]
    assert [p.split("FlatMapCoGroupsInArrow")[0].count("MapInArrow") for p in plans] == [0, 1]
    assert brown._for_scores(docs, trained.model).value.number == {}


@pytest.mark.parametrize("tables", [0, 1, 2])
def test_workers_give_memory_back(monkeypatch, tables):
    events = []
    monkeypatch.setattr(brown, "_give_back", lambda: events.append("back"))

    def batchwise(batches):
        for b in batches:
            events.append("work")
            yield b

    grouped = brown._thrifty(batchwise if not tables else lambda *t: events.append("work") or t, tables)
    if tables:
        assert grouped(*range(tables)) == tuple(range(tables)) and events == ["work", "back"]
    else:
        assert list(grouped(iter([1, 2]))) == [1, 2] and events == ["work", "work", "back"]


def test_bigram_sums_hold_few_copies():
    """Counts of many blocks are summed in a few times the room of their keys."""
    import tracemalloc

    import pyarrow as pa

    rng = np.random.default_rng(2)
    parts = [np.sort(rng.integers(0, 2**40, 20_000)) for _ in range(20)]
    row = lambda k: (7, brown.pack(k), brown.pack(np.ones(len(k), np.int64)), brown.pack(k[:1]), brown.pack(np.array([3])))
    table = pa.Table.from_batches([brown._batch([row(k) for k in parts], brown._PAIR_NAMES, brown._PAIR_KINDS)])
    tracemalloc.start()
    made = brown._pair_adder(table)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    key, n = np.unique(np.concatenate(parts), return_counts=True)
    assert (brown.unpack(made["following"][0].as_py(), "i8") == key).all() and (brown.unpack(made["following_n"][0].as_py(), "i8") == n).all()
    assert brown.unpack(made["preceding_n"][0].as_py(), "i8").sum() == 60 and made["bucket"][0].as_py() == 7
    assert peak < 6.5 * 8 * sum(map(len, parts))
