import base64
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from hooklens.llm import bytebpe
from tests.llm.helpers import HARD, documents


@pytest.fixture(scope="module")
def plain():
    with open(public_tokenizers.path(bytebpe.VOCABULARY), "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_ids_offsets_and_round_trip(spark, plain):
    texts = [t for _, t, *_ in HARD] + ["🙂🙂é", "  a   b\n\n", "don't we'LL 12½Ⅷ", "\x85 x᠎", "aaaa" * 50]
    docs = documents(spark, [(i, t, None, None) for i, t in enumerate(texts)])
    encoded = bytebpe.encode(docs)
    for r in encoded.collect():
        text = r.text or ""
        assert r.ids == plain.encode_ordinary(text) and r.n_tokens == len(r.ids)
        if not r.ids:
            continue
        # every token covers the characters it has bytes of
        data, at, split = text.encode(), 0, 0
        for token, start, end in zip(r.ids, r.starts, r.ends):
            stop = at + len(plain.decode_single_token_bytes(token))
            assert start == len(data[:at].decode(errors="ignore")) and end == len((data[:stop] + b"").decode(errors="replace"))
            whole = text[start:end].encode()
            split += whole != data[at:stop]
            at = stop
        assert at == len(data) and r.n_split == split
    back = {r.doc_id: (bytes(r.decoded), bytes(r.ids_packed)) for r in bytebpe.decode(encoded).collect()}
    assert len(back) == len(texts)
    for i, t in enumerate(texts):
        assert back[i] == ((t or "").encode(), np.array(plain.encode_ordinary(t or ""), dtype="<u4").tobytes())


def test_random_texts(plain):
    rng = random.Random(5)
    parts = ["a", " ", "  ", "\n", "'s", "'S", "1", "é", "日", "🙂", "̀", "_", "!", "the", "tion", "​", "\x00", "²"]
    texts = ["".join(rng.choices(parts, k=rng.randint(0, 30))) for _ in range(3000)]
    own = bytebpe.codec(bytebpe.VOCABULARY, None)
    for text, ids in zip(texts, own.encode(texts)):
        assert np.frombuffer(ids, dtype="<u4").tolist() == plain.encode_ordinary(text)
        assert own.decode(np.frombuffer(ids, dtype="<u4")) == text.encode()


def test_pieces_match_for_every_character(plain):
    """The pattern's character classes agree with those of the reference encoder, for all of Unicode."""
    own = bytebpe.codec(bytebpe.VOCABULARY, None)
    texts = [f"a{chr(c)}1{chr(c)} {chr(c)}{chr(c)}!{chr(c)}  b" for c in range(0x30000) if not 0xD800 <= c < 0xE000]
    for start in range(0, len(texts), 5000):
        part = texts[start : start + 5000]
        for text, ids in zip(part, own.encode(part)):
            assert np.frombuffer(ids, dtype="<u4").tolist() == plain.encode_ordinary(text), ascii(text)


def test_empty_table_and_clashing_columns(spark):
    assert bytebpe.decode(bytebpe.encode(documents(spark, []))).count() == 0
    docs = documents(spark, [(0, "hi", "x", "y")]).withColumnsRenamed({"lang": "IDS", "source": "n_tokens"})
    row = bytebpe.decode(bytebpe.encode(docs, offsets=False)).first()
    assert bytes(row.decoded) == b"hi" and row.n_chars == 2
