import hashlib
import re

from hypothesis import given, settings
from hypothesis import strategies as st
from trovespark.frames import pick
from trovespark.llm import pii

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def plain(text):
    out = [(m.start(), 0, m.end()) for m in EMAIL.finditer(text)]
    out += [(m.start(), 1, m.end()) for m in IP.finditer(text) if all(int(p) <= 255 for p in m[0].split("."))]
    for m in CARD.finditer(text):
        d = re.sub("[ -]", "", m[0])
        doubled = [int(c) * (1 + i % 2) for i, c in enumerate(d[::-1])]
        if 12 <= len(d) <= 19 and sum(x // 10 + x % 10 for x in doubled) % 10 == 0:
            out.append((m.start(), 2, m.end()))
    out += [(m.start(), 3, m.end()) for m in PHONE.finditer(text) if 9 <= len(re.sub("[^0-9]", "", m[0])) <= 15]
    return sorted(out)


@settings(max_examples=1500, deadline=None)
@given(st.text(alphabet="ab.@-+ 0145(%é", max_size=40))
def test_base_is_the_patterns(text):
    assert pii.detect(text) == plain(text)
    base, found = pii.spans(text)
    assert set(base) <= set(found)


def kinds(text):
    return [(pii.KINDS[k], text[a:b]) for a, k, b in pii.spans(text)[1]]


def test_disguises():
    assert kinds("mail john.doe (at) example (dot) com now") == [("email", "john.doe (at) example (dot) com")]
    assert kinds("mail john [at] mail [dot] example.org!") == [("email", "john [at] mail [dot] example.org")]
    assert kinds("reach me: jane dot doe at example dot com, ok") == [("email", "jane dot doe at example dot com")]
    assert kinds("mаil me: аnna@exаmple.com") [-1] == ("email", "аnna@exаmple.com")
    assert kinds("ｊｏｅ＠ｅｘａｍｐｌｅ．ｃｏｍ") == [("email", "ｊｏｅ＠ｅｘａｍｐｌｅ．ｃｏｍ")]
    assert kinds("x jo​hn@exam​ple.com y")[-1] == ("email", "jo​hn@exam​ple.com")
    assert kinds("call plus one five five five one two three four five six seven now") == [("phone", "plus one five five five one two three four five six seven")]
    assert kinds("ip one nine two dot one six eight dot one dot five.") == [("ip", "one nine two dot one six eight dot one dot five")]
    assert kinds("card 4111 llll 1111 1111") == [("card", "4111 llll 1111 1111")]
    assert kinds("card ４１１１１１１１１１１１１１１１") == [("card", "４１１１１１１１１１１１１１１１")]


def test_clean_prose_stays_clean():
    for text in (
        "He looked at the dot and smiled at them. One two three, go at once.",
        "Look at spot dot and line. A six pack (at noon) costs 12.50.",
        "Почта пришла в шесть. The number one two three four is short.",
        "un deux trois quatre cinq",
    ):
        assert kinds(text) == []


def test_mapping_back_covers_whole_disguise():
    step = pii.Rewritten("ab--cd(at)e", [(2, 4, ""), (6, 10, "@")])
    assert step.text == "abcd@e"
    assert [step.back(i, i + 1) for i in range(6)] == [(0, 1), (1, 2), (4, 5), (5, 6), (6, 10), (10, 11)]


def test_long_texts_take_linear_time():
    for text in ("a" * 400_000, "1" * 400_000, "1." * 200_000, "+1 " * 130_000, "a@" * 200_000, "one " * 100_000, "(at) " * 80_000, "dot " * 100_000, "l" * 300_000):
        pii.spans(text)


def test_rows(spark):
    rows = [(1, "a@b.co and 1.2.3.4"), (1, "a@b.co and 1.2.3.4"), (2, None), (3, ""), (None, "x (at) y (dot) com")]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("doc_id", "text", "1 as spans", "2 as Text", "cast(0 as bigint) n_chars")
    got = {(r.doc_id, r.spans): r for r in pii.find(df, with_text=True).collect()}
    assert got[1, "email:0:6,ip:11:18"].redacted == "<EMAIL> and <IP>" and got[1, "email:0:6,ip:11:18"].n_ip == 1
    assert got[2, ""].redacted is None and got[2, ""].base_sha256 == hashlib.sha256(b"").hexdigest() == got[None, "email:0:18"].base_sha256
    assert pii.find(df).count() == 5 and pii.find(df.limit(0)).count() == 0
    clean = pii.redact(pick(df, doc_id="bigint", text="string", n_chars="bigint")).collect()
    assert sorted((r.text or "", r.n_chars) for r in clean if r.text)[0] == ("<EMAIL>", 7)


def test_bare_words_of_every_language():
    for text in ("juan arroba ejemplo punto com", "hans bei beispiel punkt de", "john.doe at example.com", "jane at host dot online", "marie arobase exemple point fr", "juan arroba ejemplo.com"):
        assert kinds(f"so: {text}, ok") == [("email", text)], text


def test_bare_words_in_clean_prose():
    for text in (
        "We stopped at this point in time. Prices at example.com rose; visit us at example.org today.",
        "Il passe chez le point de vente. Er blieb bei diesem Punkt in Berlin. Look at point in line.",
        "Pesa una arroba de trigo y punto. At noon he left.",
    ):
        assert kinds(text) == [], text


def test_numbers_of_words_and_figures():
    assert kinds("call +1 five five five 123 4567 now") == [("phone", "+1 five five five 123 4567")]
    assert kinds("card 4111 one one one one 1111 1111 ok") == [("card", "4111 one one one one 1111 1111")]
    assert kinds("ip 192 dot 168 dot one dot 5.") == [("ip", "192 dot 168 dot one dot 5")]
    assert kinds("call +1 555 123 4567 one time") == [("phone", "+1 555 123 4567")]
    assert kinds("le 10.0.0.1 un jour") == [("ip", "10.0.0.1")]
    assert kinds("In 2020 one of 12 pages, two of 300.") == []


def test_local_parts_of_any_length():
    for dots in (3, 40, 400):
        local = " dot ".join(f"part{i}" for i in range(dots))
        text = f"write to {local} at example dot com now"
        plain, found = pii.spans(text)
        at = text.index("part0")
        assert not plain and (at, 0, text.index(" now")) in found
