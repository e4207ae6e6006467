import glob
import hashlib
import os

import pyarrow.parquet as pq

import corpus_pipeline
from hooklens.llm import bytebpe
from hooklens.session import shared_dir
from tests.llm.helpers import HARD, documents

PROSE = "the {0} of the river and the {0} in the town was a {0} that people from all over the land came to see on that day number {1}"


def test_stages_and_their_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "near_duplicates", "secrets", "mixture", "tokens"]


def test_each_stage_takes_effect(spark):
    texts = {i: PROSE.format("bridge stone arch "[: 5 + i], i * i) + f" at place {i * 17} near house {i * 31} by road {i * 13}" for i in range(12)}
    rows = [(i, t, "en", "a" if i % 2 else "b") for i, t in texts.items()]
    rows += [(20, texts[3], "en", "a"), (21, "too few words", "en", "a"), (22, texts[4] + " password=hunter22xyz", "en", "c")]
    docs = documents(spark, rows + HARD)
    stages = dict(corpus_pipeline.STAGES)
    kept = corpus_pipeline.written(stages["quality"](spark, docs, ""), "t")
    assert kept.columns == docs.columns
    ids = {r.doc_id for r in kept.collect()}
    assert 21 not in ids and 20 in ids and 22 in ids and {1, 2, 3} & {r.doc_id for r in kept.collect() if not r.text} == set()
    single = corpus_pipeline.written(stages["near_duplicates"](spark, kept, ""), "t")
    left = {r.doc_id for r in single.collect()}
    assert 20 not in left and 3 in left and single.columns == docs.columns
    clean = corpus_pipeline.written(stages["secrets"](spark, single, ""), "t")
    assert clean.count() == single.count() and clean.columns == docs.columns
    assert all("hunter22" not in r.text and r.n_chars == len(r.text) for r in clean.collect())
    mixed = corpus_pipeline.written(stages["mixture"](spark, clean, ""), "t")
    assert mixed.count() <= clean.count() and mixed.columns == docs.columns
    out = stages["tokens"](spark, mixed, "").collect()
    own = bytebpe.codec(bytebpe.VOCABULARY, None)
    by_id = {r.doc_id: r.text for r in mixed.collect()}
    assert len(out) == mixed.count()
    for r in out:
        assert r.exact and bytes(r.ids) == own.encode([by_id[r.doc_id]])[0] and r.n_tokens == len(r.ids) // 4


def test_empty_table(spark):
    docs = documents(spark, [])
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.written(stage(spark, docs, ""), f"t-{name}")
    assert docs.count() == 0
    assert hashlib.sha256(b"").hexdigest()  # nothing was made up


def test_tokens_run_one_python_step_at_a_time(spark):
    rows = documents(spark, [(1, "a text", "en", "a"), (2, None, "en", "a")])
    out = corpus_pipeline.tokens(spark, rows, "")
    assert out._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 1
    assert sorted((r.doc_id, r.n_tokens, r.exact) for r in out.collect()) == [(1, 2, True), (2, 0, True)]


def test_encoder_sends_a_text_once(spark):
    rows = documents(spark, [(1, "a text", "en", "a"), (2, None, "en", "a")])
    encoded = bytebpe.encode(rows, offsets=False)
    sent = encoded._jdf.queryExecution().optimizedPlan().toString().split("MapInArrow")[1]
    assert "coalesce(text" not in sent and "_text" not in sent
    assert encoded.columns == [*rows.columns, "ids", "n_tokens", "n_split"]
    assert {r.doc_id: (r.text, r.n_tokens) for r in encoded.collect()} == {1: ("a text", 2), 2: (None, 0)}


def folders(spark):
    at = f"{shared_dir(spark)}/hooklens"
    return {d: os.path.join(at, d) for d in (os.listdir(at) if os.path.isdir(at) else [])}


def test_large_tables_go_once_read(spark):
    """Sets, their prefixes and edges are not on the disk beside what later stages write."""
    base = [f"w{i}" for i in range(40)]
    texts = [" ".join(base[: 36 + i % 3] + [f"own{i}"]) for i in range(12)] + [f"alone {i} with a few other words of it {i * 7}" for i in range(5)]
    docs = documents(spark, [(i, t, "en", "a") for i, t in enumerate(texts)])
    before = folders(spark)
    out = corpus_pipeline.near_duplicates(spark, docs, "")
    left = {d.rsplit("-", 1)[0] for d in set(folders(spark)) - set(before)}
    assert not left & {"classes", "sets", "orders", "prefixes", "buckets", "edges", "hubs", "labels", "best"}
    assert sorted(r.doc_id for r in out.collect()) == [0, *range(12, 17)]


def test_encoded_texts_are_written_small(spark):
    before = folders(spark)
    rows = [(i, f"a text {i} " * 50, "en", "a") for i in range(20)]
    out = corpus_pipeline.tokens(spark, documents(spark, rows), "").collect()
    assert len(out) == 20 and all(r.exact for r in out)
    made = [p for d, p in folders(spark).items() if d not in before and d.startswith("encoded-")]
    files = [pq.read_metadata(f) for p in made for f in glob.glob(f"{p}/*.parquet")]
    kinds = {g.column(c).compression for m in files for g in map(m.row_group, range(m.num_row_groups)) for c in range(g.num_columns)}
    assert kinds == {"ZSTD"}
