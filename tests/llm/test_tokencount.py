import numpy as np
import public_tokenizers as P
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer
from trovespark.llm import tokencount

PATH = P.path("word_bpe_49k.json")
LIB = Tokenizer.from_file(PATH)
COUNTS = tokencount.Splitter(PATH)


def expected(text):
    return len(LIB.encode(text, add_special_tokens=False).ids)


@settings(max_examples=400, deadline=None)
@given(st.one_of(st.text(max_size=60), st.text(alphabet="aeinorst'lmdsÉé²½ \x1c\x85\xa0\t\n<|>09ßİΣ", max_size=60)))
def test_same_count_as_library(text):
    assert COUNTS.count(text) == expected(text)


def test_fast_way_agrees_on_each_code_point():
    assert COUNTS.plain
    for cp in range(tokencount.PLAIN_BELOW):
        for text in (f"the{chr(cp)}the {chr(cp)}{chr(cp)} x", f"{chr(cp)}'s 1{chr(cp)}"):
            assert COUNTS.count(text) == expected(text), hex(cp)


def test_odd_rows(spark):
    rows = [(1, "The <|endoftext|> the"), (1, "The <|endoftext|> the"), (2, None), (3, ""), (None, " \n"), (4, "the cat " * 3000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("doc_id", "text", "1 as n_tokens", "2 as Text")
    got = tokencount.count_tokens(df, PATH).collect()
    assert sorted((r.doc_id or 0, r.n_tokens) for r in got) == sorted((d or 0, expected(t or "")) for d, t in rows)
    assert {r.doc_id: r.over_limit for r in got}[4] and {r.doc_id: r.n_bytes for r in got}[2] == 0
    assert tokencount.count_tokens(df.limit(0), PATH).count() == 0


UNTOUCHED = Tokenizer.from_file(PATH)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from(["<|startoftext|>", "<|endoftext|>", "<|ENDOFTEXT|>", "<|endof", "text|>", "'s", " ", "\n", "the", "é", "\u0301", "世"]), max_size=8).map("".join))
def test_special_strings_count_as_in_the_library_by_default(text):
    assert COUNTS.count(text) == len(UNTOUCHED.encode(text, add_special_tokens=False).ids)


def test_special_strings_in_rows(spark):
    df = spark.createDataFrame([(1, "a <|startoftext|> b"), (2, "<|endoftext|>"), (3, "<|endoftext|>" * 2048)], "doc_id long, text string")
    got = {r.doc_id: (r.n_tokens, r.over_limit) for r in tokencount.count_tokens(df, PATH, 2048).collect()}
    assert got == {1: (3, False), 2: (1, False), 3: (2048, False)}


def test_same_counts_however_blocks_and_buckets_are_cut(spark, monkeypatch):
    rows = [(i, f"the cat{i % 7} sat on <|endoftext|> mats{i} " * (i % 4)) for i in range(120)] + [(None, None), (7, "x" * 5000), (8, "é世\u0301 the")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    for block, bucket in ((2000, 2_000_000), (7, 20)):
        monkeypatch.setattr(tokencount, "BLOCK_ROWS", block)
        monkeypatch.setattr(tokencount, "BUCKET_SIZE", bucket)
        got = tokencount.count_tokens(df, PATH).collect()
        assert sorted((r.doc_id or -1, r.n_bytes, r.n_tokens) for r in got) == sorted((d or -1, len((t or "").encode()), expected(t or "")) for d, t in rows)


def test_buckets_share_all_keys():
    keys = np.array([0, 1, 1 << 31, (1 << 32) - 1], np.uint64)
    for buckets in (1, 2, 3, 1000):
        cut = tokencount._buckets(keys, buckets)
        assert cut[0] == 0 and cut[-1] == 4 and (np.diff(cut) >= 0).all()
