import random

import public_tokenizers as P
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from trovespark.llm import bytebpe

PATH = P.path("byte_bpe_50k.tiktoken")
BPE = bytebpe.coder(PATH)
LIB = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=BPE.ranks, special_tokens={})


def ids(text):
    return bytebpe.EncodedText(BPE, text, P.PATTERN).ids


def test_pattern_is_the_vocabulary_s():
    assert bytebpe.FULL_FORM == P.PATTERN


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=60))
def test_same_ids_as_library(text):
    assert ids(text) == LIB.encode_ordinary(text)
    assert BPE.decode(ids(text)) == text.encode()


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="aeinorst hl'=-\n 0é", max_size=80), st.text(alphabet="aeinorst h='\n", max_size=20), st.integers(0, 80), st.integers(0, 20))
def test_edits_and_appends(text, new, begin, size):
    held = bytebpe.EncodedText(BPE, text, P.PATTERN)
    begin = min(begin, len(text))
    end = min(len(text), begin + size)
    held.edit(begin, end, new)
    assert held.text == text[:begin] + new + text[end:]
    assert held.ids == LIB.encode_ordinary(held.text)
    held.append(new)
    assert held.ids == LIB.encode_ordinary(held.text)


def test_piece_edit_stops_near_the_edit():
    rnd = random.Random(1)
    piece = bytes(rnd.choice(b"abcdefghiknorst") for _ in range(3000))
    last = BPE.prefixes(piece)
    calls = []
    plain = BPE.compatible
    BPE.compatible = lambda a, b: calls.append(1) or plain(a, b)
    try:
        edited, new = BPE.edit(piece, last, 700, 703, b"xyz")
    finally:
        del BPE.compatible
    assert new == BPE.prefixes(edited) and len(calls) < 6000
    assert BPE.tokens(edited, new) == LIB._core_bpe.encode_single_piece(edited)


def test_every_row_and_odd_rows(spark):
    rows = [(1, "The the"), (1, "The the"), (2, None), (3, ""), (None, "x"), (4, "=" * 5000 + " é" * 300)]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("doc_id", "text", "1 as n_tokens", "2 as TEXT")
    got = sorted(bytebpe.encode(df, PATH, with_ids=True).collect(), key=str)
    assert len(got) == 6
    for r in got:
        text = next((t for d, t in rows if d == r.doc_id), "") or ""
        assert r.ids == LIB.encode_ordinary(text) and r.n_tokens == len(r.ids)
    assert bytebpe.encode(df.limit(0), PATH).count() == 0
    back = {r.doc_id: bytes(r.bytes) for r in bytebpe.decode(bytebpe.encode(df, PATH, with_ids=True), PATH).collect()}
    assert back[4] == rows[-1][1].encode() and back[2] == b""
