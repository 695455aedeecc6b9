import zlib

import numpy as np
from trovespark.llm import langid

WORDS = {
    "en": "the of and to in that is was for with house water people which their from they have this",
    "de": "der die und das ist nicht von mit sich auf eine haus wasser leute welche über für auch wird",
    "fr": "le la les des et est dans pour que une maison eau gens qui sont avec plus nous cette",
    "es": "el la los de y en que es por una casa agua gente con para como más pero sus",
    "it": "il la che di e un per con non sono casa acqua gente come più della anche questo nella",
    "pl": "w na i z się nie jest że dom woda ludzie który przez dla jak tak tylko może już",
}


def text(lang, seed, n=40):
    rng = np.random.default_rng(seed)
    return " ".join(rng.choice(WORDS[lang].split(), n))


def test_codewords_stand_apart():
    assert langid.codewords(1).shape == (1, 1) and langid.codewords(4).shape == (4, 7)
    for n in (2, 3, 5, 8, 20):
        code = langid.codewords(n)
        apart = (code.shape[1] - code @ code.T) / 2 + 999 * np.eye(n)
        assert apart.min() >= 1 and set(np.unique(code)) <= {-1, 1}
        assert (np.abs(code.sum(0)) < n).all()


def test_grams_by_brute_force():
    def brute(t):
        marked = ["".join(w) for w in "".join(c.lower() if c.isalpha() else " " for c in t).split()]
        return sum(len(w) + len(w) + 1 for w in marked), marked

    for t in ("ab", "Ab, c!", "12", "  x  ", "été 2 mots"):
        got = [f for f, _ in langid.grams([t])]
        n1 = sum(len(w) for w in brute(t)[1])
        assert len(got[0]) == n1 if got else n1 == 0
    one = [sorted(f.tolist()) for f, _ in langid.grams(["ab cd"])]
    two = [sorted(f.tolist()) for f, _ in langid.grams(["AB%%  cd!!"])]
    assert len(one) == len(two)


def test_held_out_accuracy_and_rows(spark):
    rows = []
    for i in range(900):
        lang = list(WORDS)[i % 6]
        rows.append((i, text(lang, i), lang if i % 7 else None))
    rows += [(5000, None, "en"), (5001, "", "en"), (5002, "123 !!", "fr"), (None, text("de", 1), "de"), (3, rows[3][1], rows[3][2]), (5003, text("es", 9, 60_000), None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").selectExpr("*", "1 as score", "2 as LANG")
    got = langid.label(df).collect()
    assert len(got) == len(rows)
    by = {r.doc_id: r for r in got}
    right = [by[i].lang_pred == list(WORDS)[i % 6] for i in range(900) if by[i].held_out]
    assert len(right) > 150 and np.mean(right) > 0.98
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got if r.doc_id is not None)
    for odd in (5000, 5001, 5002):
        assert by[odd].lang_pred == "und" and by[odd].score == 0 and by[odd].ambiguous
    assert by[None].lang_pred == "de" and by[5003].lang_pred == "es" and all(0 <= r.score <= 1 for r in got)


def test_ambiguity_is_flagged(spark):
    rows = [(i, text("en" if i % 2 else "de", i), "en" if i % 2 else "de") for i in range(200)]
    model = langid.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    means, _ = langid.score([text("en", 1), text("de", 1)], model.weights)
    assert not model.decode(means)[2].any()
    assert model.decode((-model.shift / model.slope)[None])[2][0]


def test_no_labels_or_one(spark):
    df = spark.createDataFrame([(1, "abc", None), (2, "def", "en")], "doc_id long, text string, lang string")
    assert {r.lang_pred for r in langid.label(df.where("doc_id = 1")).collect()} == {"und"}
    model = langid.fit(df)
    assert {r.lang_pred for r in langid.predict(df, model).collect()} == {"en"}
    assert langid.label(df.limit(0)).count() == 0


def test_score_does_not_depend_on_neighbours():
    weights = np.random.default_rng(0).normal(size=(langid.OFFSETS[-1], 3)).astype(np.float32)
    texts = [text("en", 1), "", " x", text("fr", 2), "été", "!!"]
    together, n = langid.score(texts, weights)
    for i, t in enumerate(texts):
        alone, m = langid.score([t], weights)
        assert np.allclose(alone[0], together[i], atol=1e-12) and m[0] == n[i]


def brute_grams(text):
    """Every gram of one to four characters of each word with its edges, by hand: (length, characters)."""
    out = []
    for word in "".join(c.lower() if c.isalpha() else " " for c in text).split():
        edged = f" {word} "
        for n in (1, 2, 3, 4):
            source = word if n == 1 else edged
            out += [(n, source[i : i + n]) for i in range(len(source) - n + 1)]
    return out


def test_features_tell_the_same_grams_apart_as_by_hand():
    texts = ["the cat sat", "The  CAT, sat!", "das Haus", "été à la mer", "a", "ab abc abcd abcde"]
    for t in texts:
        features = np.concatenate([f for f, _ in langid.grams([t])])
        by_hand = brute_grams(t)
        assert len(features) == len(by_hand), t
        # equal grams have equal numbers: the multisets have the same shape
        shape = lambda xs: sorted(np.unique(xs, return_counts=True)[1].tolist())
        assert shape(features) == shape([f"{n}{g}" for n, g in by_hand]), t


def test_decoding_by_brute_force():
    rng = np.random.default_rng(3)
    for n in (2, 3, 5, 9):
        code = langid.codewords(n)
        bits = code.shape[1]
        trust = rng.random((n, bits)) + 0.1
        model = langid.Model([f"l{i}" for i in range(n)], code, np.zeros((1, bits)), rng.random(bits) + 0.5, rng.normal(size=bits), trust / trust.sum(1, keepdims=True))
        means = rng.normal(size=(50, bits))
        best, share, near = model.decode(means)
        for row in range(50):
            far = [sum(model.trust[i, j] * np.log1p(np.exp(-(means[row, j] * model.slope[j] + model.shift[j]) * code[i, j])) for j in range(bits)) for i in range(n)]
            first, second = sorted(far)[:2]
            assert best[row] == int(np.argmin(far)) and near[row] == (second - first < langid.AMBIGUOUS)
            assert abs(share[row] - 1 / sum(np.exp(-(x - first) * bits) for x in far)) < 1e-9


def test_many_languages_are_bounded(spark):
    rows = [(i, f"word{i % 40} " * 3 + chr(97 + i % 26) * 5, f"l{i % 40:02d}") for i in range(400)]
    model = langid.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"), most_languages=8)
    assert model.languages == [f"l{i:02d}" for i in range(8)]
