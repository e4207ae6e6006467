import random

import numpy as np

from hooklens.llm import langid
from tests.llm.helpers import HARD, documents


def phrases(text, sample):
    """Greedy longest matches by plain substring search."""
    count, start = 1, 0
    end = 0
    while end < len(text):
        if text[start : end + 1] in sample:
            end += 1
        else:
            count += 1
            start = end if text[end] in sample else end + 1
            end += 1
    return count


def test_automaton_parses_like_substring_search():
    rng = random.Random(3)
    for _ in range(30):
        sample = "".join(rng.choices("abc ", k=60))
        text = "".join(rng.choices("abcd ", k=90))
        code = {c: i for i, c in enumerate("abcd ")}
        automaton = langid.Automaton([code[c] for c in sample], 5)
        grid = np.array([[code[c]] for c in text], dtype=np.int32)
        assert automaton.phrases(grid)[0] == phrases(text, sample)


def test_symbols():
    found, owner = langid.symbols_of(["Ab--C1 d", "", "É"])
    assert "".join(map(chr, found)) == "ab c d é "
    assert owner.tolist() == [0] * 7 + [2, 2] or owner.tolist()[:6] == [0] * 6


LETTERS = {"xx": "aeiourst", "yy": "bdgklmnz", "zz": "éàçwvqph"}


def words(lang, n, seed):
    rng = random.Random(seed)
    return " ".join("".join(rng.choices(LETTERS[lang] + "aeio", k=rng.randint(2, 8))) for _ in range(n))


def test_held_out_accuracy_and_hard_rows(spark):
    train = documents(spark, [(i, words(lang, 60, i * 7 + k), lang, "s") for i in range(12) for k, lang in enumerate(LETTERS)])
    samples = langid.learn_samples(train.unionByName(documents(spark, [(99, None, "xx", None), (98, "123", "qq", None), (97, "abc", None, None)])))
    assert [name for name, _ in samples] == ["xx", "yy", "zz"]
    test = [(i, words(lang, 30, 1000 + i), lang, None) for i, lang in enumerate(list(LETTERS) * 5)]
    rows = langid.identify(documents(spark, test), samples).collect()
    assert all(r.lang_pred == r.lang for r in rows) and all(0 <= r.score <= 1 for r in rows)
    hard = langid.identify(documents(spark, HARD), samples).collect()
    assert len(hard) == len(HARD)
    for r in hard:
        blank = not any(c.isalpha() for c in r.text or "")
        assert (r.lang_pred == "und") == blank and (r.score == 0.0) == blank
    # the language column is no input
    other = langid.identify(documents(spark, [(i, t, None, "q") for i, t, *_ in test]), samples).collect()
    assert {r.doc_id: (r.lang_pred, r.score) for r in other} == {r.doc_id: (r.lang_pred, r.score) for r in rows}


def test_nothing_to_learn_and_empty_table(spark):
    none = langid.learn_samples(documents(spark, [(0, "abc", None, None)]))
    assert none == () and langid.identify(documents(spark, [(0, "abc", None, None)]), none).first().lang_pred == "und"
    assert langid.identify(documents(spark, []), none).count() == 0
    clash = documents(spark, [(0, "abc", "x", "y")]).withColumnsRenamed({"lang": "Lang_Pred", "source": "score"})
    assert langid.identify(clash, (("x", "abc"),)).first().lang_pred == "x"
