import numpy as np
import pytest

from hooklens.llm import multiset as m
from tests.llm.helpers import HARD, documents, sha


def of(*texts):
    return m.vectors([t.encode() for t in texts])


def test_order_independent_and_incremental():
    a, b, c = "first para\n", "second one here\n\n", "third é 🙂 x y z\n"
    assert (of(a + b + c) == of(c + a + b)).all()
    assert not (of(a + b) == of(a + b + b)).all()
    assert (m.add(of(a + b), of(c)) == of(a + c + b)).all()
    assert (m.add(of(a + b + c), of(b), -1) == of(c + a)).all()
    assert (m.add(of(a), of(a), -1) == of("")).all()
    assert not (of("x y z") == of("x y zz")).all()


def test_position_and_company_do_not_matter():
    texts = ["alpha beta gamma delta", "", "one\ntwo three four five", "x" * 70000 + " tail of words", "alpha beta gamma delta"]
    together = of(*texts)
    for i, t in enumerate(texts):
        assert (together[i] == of(t)[0]).all()
    assert (together[0] == together[4]).all()


def test_likeness_follows_shared_text():
    words = [f"w{i}" for i in range(2000)]
    base = " ".join(words)
    near = " ".join(words[:1500] + [f"v{i}" for i in range(500)])
    far = " ".join(f"u{i}" for i in range(2000))
    got = m.likeness(of(base, base, base), of(base, near, far))
    assert got[0] == 1.0 and abs(got[1] - 0.75) < 0.12 and got[2] < 0.2
    assert m.likeness(of("", "a"), of("", "")).tolist() == [1.0, 0.0]


def study(rows):
    """(id, text) in order of id (null first) and text, each with the next one."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    out = []
    for i, (doc_id, text) in enumerate(rows):
        following = rows[(i + 1) % len(rows)][1]
        quarter = len(text) // 4
        edited = text[: len(text) - quarter] + following[:quarter]
        own, new, nxt = of(text, edited, following)[:, None, :]
        out.append((
            doc_id, len(text), sha(edited), own.tobytes(), new.tobytes(), float(m.likeness(own, new)[0]), float(m.likeness(own, nxt)[0]),
        ))
    return sorted(out, key=str)


@pytest.mark.parametrize("parts", [1, 3, 40])
def test_study_matches_plain_python(spark, parts):
    rows = [(i, t, lang, s) for i, t, lang, s in HARD] + [(100 + 7 * i, f"line {i}\n" * (i % 9) + "tail " * i, "en", "s") for i in range(60)]
    got = sorted((
        (r.doc_id, r.n_chars, r.edited_sha256, bytes(r.fingerprint), bytes(r.edited_fingerprint), r.near_edited, r.near_next)
        for r in m.edit_study(spark, documents(spark, rows), parts).collect()
    ), key=str)
    assert got == study([(i, t or "") for i, t, *_ in rows])


def test_empty_single_and_fingerprint_column(spark):
    assert m.edit_study(spark, documents(spark, [])).count() == 0
    one = m.edit_study(spark, documents(spark, [(3, "a b c d e f g h", None, None)])).first()
    assert one.near_next == 1.0
    rows = m.fingerprint(documents(spark, HARD)).collect()
    assert {(r.doc_id, bytes(r.fingerprint)) for r in rows} == {(i, of(t or "")[0].tobytes()) for i, t, *_ in HARD}


def test_counters_do_not_wrap():
    """70,000 and 40,000 repeats of a line: far more than 16 bits hold."""
    line = "some very common line of words\n"
    many, more, few = of(line * 65536, line * 65535, line * 32768)[:, None]
    assert m.likeness(many, more)[0] > 0.999 and 0.7 < m.likeness(many, few)[0] < 0.9
    assert not (many == m.add(many, many, -1)).all()
