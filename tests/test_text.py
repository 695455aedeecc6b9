import hashlib
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from trovespark.functions import answers, ids, text


def one(spark, value, make, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(make(F.col("x")).alias("y")).first().y


def test_fixed_keys(spark):
    row = spark.createDataFrame([("q1", "hello world")], "q string, t string").select(text.claim_key(F.col("q"), F.col("t")).alias("k")).first()
    assert row.k == "6ecf7c5aedc0fb1fb615e547bc4ab67cf96cf3c5" == hashlib.sha1(b"q1\0hello world").hexdigest()
    for texts in (["Beta claim, two.", "Alpha claim!"], ["Alpha claim!", "Beta claim, two."]):
        assert one(spark, texts, text.member_hash, "array<string>") == "eb230ea79e38dee7"
    assert one(spark, "  A-B,  c!! ", text.normal) == "a b c"
    for t in ("Here is the combined statement: Facts stand.", "Combined statement: Facts stand.", "Facts stand."):
        assert one(spark, t, text.without_preamble) == "Facts stand."


def test_ids(spark):
    for x, want in ((None, ""), ("  ", ""), ("http://www.ncbi.nlm.nih.gov/pubmed/123", "123"), ("https://PubMed.ncbi.nlm.nih.gov/77/", "77"), (" a1 ", "a1")):
        assert one(spark, x, ids.doc_id) == want
    for x, want in (("http://x/pubmed/12/", "12"), ("http://x/y", None), ("d5", "d5"), (" ", None)):
        assert one(spark, x, ids.listed_doc_id) == want
    for x in ("12345#body_007", "12345#abstract", "12345"):
        assert one(spark, x, ids.parent) == "12345"
    assert one(spark, "stage1_b1_top10_rrf_pool5", ids.split_of_run) == "b1" and one(spark, "x", ids.split_of_run) is None
    row = spark.createDataFrame([([], ["a", "b"], None)], "a array<string>, b array<string>, c array<string>").select(ids.ranked_ids(F.col("a"), F.col("b"), F.col("c")).alias("y")).first()
    assert row.y == ["a", "b"]


def test_codes_and_seeds(spark):
    assert one(spark, "0066101", text.digit_chunks) == ["0066", "101"]
    assert one(spark, "see ABC-0066101 now", text.with_codes_for_query) == "see ABC-0066101 now abc 0066 101 abc 0066 101"
    assert one(spark, "p53 IL-12 IL 12", text.with_codes_for_index).endswith("\n\n12 il il 12 il-12 il12")
    assert one(spark, None, text.with_codes_for_query) == ""
    for q, want in (("What  is the role of X??", "the role of X"), ("List ?", "List ?".rstrip("?").strip()), ("Which are genes?", "genes"), ("Whatever", "Whatever"), (None, "")):
        assert one(spark, q, text.seed_query) == want


def test_prose_and_spaces(spark):
    assert not one(spark, "Home\nNews\nAll\nOne two three four five", text.is_prose)
    assert not one(spark, "four words are few", text.is_prose) and one(spark, "five words are enough here", text.is_prose)
    assert one(spark, "a  b   c\n d ", text.plain_spaces) == "a b c\n d"
    assert one(spark, "One two. Three!  Four\nfive", text.sentences) == ["One two.", "Three!", "Four", "five"]


def test_sentence_list():
    t = "Dr. Smith came at 5 p.m. on Monday to the big hall. He said (e.g. this) that it works well. Short. \n\nA new paragraph begins with some words here."
    assert answers.sentence_list(t) == ["Dr. Smith came at 5 p.m. on Monday to the big hall.", "He said (e.g. this) that it works well. Short.", "A new paragraph begins with some words here."]
    assert answers.sentence_list("") == [] and answers.sentence_list(None) == []


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet='ab.A !?\n1"(', max_size=80))
def test_sentences_lose_nothing(t):
    assert "".join("".join(answers.sentence_list(t)).split()) == re.sub(r"\s", "", t) or re.search(r"[.!?][\)\"”’]", t)


def test_claims_and_answers():
    assert answers.claim_list('```json\n{"claims": ["One two three.", "one two THREE", "no", 5, "Four five six"]}\n```') == ["One two three.", "Four five six"]
    assert answers.claim_list('say {"claims": ["a b c"]} ok') == ["a b c"] and answers.claim_list("nothing") is None and answers.claim_list(None) is None
    assert answers.first_object('x {"a": "}\\"{", "b": {}} y') == '{"a": "}\\"{", "b": {}}'
    ok = '{"ideal_answer": "i", "evidence_ids": ["e"], "exact_answer": %s}'
    assert answers.checked_answer(ok % '" YES "', "yesno")["exact_yesno"] == "yes"
    assert answers.checked_answer(ok % '["a", "b"]', "list")["exact_list"] == [["a"], ["b"]]
    assert answers.checked_answer(ok % '[["a", "b"]]', "factoid")["exact_list"] == [["a", "b"]]
    assert answers.checked_answer(ok % "[]", "list")["exact_list"] == [] and "exact_list" not in answers.checked_answer(ok % "[]", "summary")
    for raw, kind in (("", None), ("no json", None), ('{"ideal_answer": 1, "evidence_ids": []}', None), ('{"ideal_answer": "x"}', None), (ok % '"maybe"', "yesno"), (ok % "[1]", "list"), ('{"ideal_answer": "x", "evidence_ids": []}', "yesno"), ("{", None)):
        with pytest.raises(ValueError):
            answers.checked_answer(raw, kind)
