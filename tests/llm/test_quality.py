import re
from collections import Counter

from hooklens.llm import quality
from tests.llm.helpers import HARD, WORDS, documents


def plain(text):
    text = text or ""
    words = WORDS.findall(text)
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    times = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if times[w] > 1 for k in range(5)}
    lines = [x for x in text.split("\n") if WORDS.search(x)]
    return (
        len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered),
    )


def test_metrics_match_plain_python(spark):
    texts = [t for _, t, *_ in HARD] + [
        "a b c d e f a b c d e", "a b c d e a b c d e a b c d e", "x a b c d e y a b c d e z", "# * $ % & | < >",
        "l1 w\nl1 w\nl1 w\n\n \nl2", "a a a a a a", "a a a a a", "  b", "a\x0bb\x0cc\rd",
    ]
    rows = quality.judge(documents(spark, [(i, t, None, None) for i, t in enumerate(texts)])).collect()
    assert len(rows) == len(texts)
    for r in rows:
        got = (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words)
        assert got == plain(r.text), r.text
        assert r.base_failed == (r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words)
        assert not (r.base_failed and r.kept)


def test_rules_reject_junk_and_keep_prose(spark):
    prose = "The quick brown fox jumps over the lazy dog and runs to the river, where it drinks of the water."
    junk = " ".join(w + "%%%" for w in prose.split())
    shout = " ".join(w + "!!" for w in prose.upper().split())
    rows = {r.doc_id: r for r in quality.judge(documents(spark, [(0, prose, "en", "a"), (1, junk, "en", "a"), (2, shout, "en", "a")])).collect()}
    assert rows[0].kept and rows[0].failed_rules == []
    assert not rows[1].kept and rows[1].failed_rules == ["symbols"]
    assert not rows[2].kept and rows[2].failed_rules == ["shouting"]


def test_clashing_columns_and_empty_table(spark):
    docs = documents(spark, [(0, "a b", "en", "s")]).withColumnsRenamed({"lang": "N_Words", "source": "kept"})
    row = quality.judge(docs).first()
    assert row.n_words == 2 and row.kept is False
    assert quality.judge(documents(spark, [])).count() == 0


def test_one_projection_without_python_or_shuffle(spark):
    plan = quality.judge(documents(spark, []))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan and "Arrow" not in plan


def test_passing_is_the_verdict_made_once(spark):
    docs = documents(spark, HARD + [(50 + i, f"The {i} cats and a dog of the house are in it now, they said.", "en", "a") for i in range(5)])
    want = sorted(((r.doc_id, r.text) for r in quality.judge(docs).filter("kept").collect()), key=str)
    found = quality.passing(docs)
    assert want and sorted(((r.doc_id, r.text) for r in found.collect()), key=str) == want and found.columns == docs.columns
    plan = found._jdf.queryExecution().executedPlan().toString()
    judged = quality.judge(docs)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("regexp_extract_all") == judged.count("regexp_extract_all")
