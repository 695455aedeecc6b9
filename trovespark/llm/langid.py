"""Language identification by error-correcting output codes over character n-grams.

Each language gets a codeword of bits. For each bit a binary n-gram classifier (class-balanced log-odds of hashed
n-grams, one to four characters long with word edges) says which half of the languages a text comes from; its mean
log-odds a gram is turned into a margin by a logistic fit on labelled texts that its counts have not seen. Decoding is
loss-weighted: a language's distance is the sum over bits of the classifier's weight for that language times the
logistic loss of its margin against the codeword's bit. The nearest codeword wins; a text is ambiguous if another
codeword is nearly as near.

Learning takes a bounded sample: at most about `per_language` labelled texts of each language (and `most_texts` in all),
chosen by a hash of their ids. Prediction reads whole texts and nothing but the text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType
from trovespark.frames import pick, slices

#: Hash buckets for n-grams of one, two, three and four characters.
BUCKETS = (1 << 12, 1 << 14, 1 << 15, 1 << 15)
OFFSETS = tuple(int(x) for x in np.cumsum((0, *BUCKETS)))
MIX = np.uint32(0x9E3779B1)
UNKNOWN = "und"
#: A margin of distances below which the two nearest codewords count as equally near.
AMBIGUOUS = 0.02
CHUNK = 1 << 18


@cache
def letters() -> np.ndarray:
    """Each code point's letter in lower case, 0 for what is no letter."""
    table = np.zeros(0x110000, np.uint32)
    for cp in range(0x110000):
        c = chr(cp)
        if c.isalpha():
            low = c.lower()
            table[cp] = ord(low) if len(low) == 1 else cp
    return table


def codewords(n: int, seed: int = 7) -> np.ndarray:
    """n codewords of +1 and -1: all splits into two halves for up to five languages, else the random code, of many
    drawn, whose nearest rows (and nearest columns or their opposites) lie furthest apart."""
    if n < 2:
        return np.ones((n, 1), np.float32)
    if n <= 5:
        bits = [[1] + [1 if split >> i & 1 else -1 for i in range(n - 1)] for split in range(2 ** (n - 1) - 1)]
        return np.array(bits, np.float32).T.copy()
    rng, size, best, score = np.random.default_rng(seed), int(np.ceil(10 * np.log2(n))), None, (-1, -1)
    for _ in range(200):
        code = rng.choice(np.array([-1, 1], np.float32), (n, size))
        rows = (size - code @ code.T) / 2 + size * np.eye(n)
        columns = np.abs(code.T @ code) - n * np.eye(size)
        if np.abs(code.sum(0)).max() < n and (now := (rows.min(), n - columns.max())) > score:
            best, score = code, now
    return best


def grams(texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Feature numbers of all n-grams of all texts with the number of the text they are in, in chunks.

    Letters are lowered and everything else is one edge mark; grams are of one word with its edges, so what separates
    words (digits, signs, white space) and how much of it makes no difference.
    """
    at = 0
    while at < len(texts):
        size, upto = 0, at
        while upto < len(texts) and (size == 0 or size + len(texts[upto]) < CHUNK):
            size += len(texts[upto])
            upto += 1
        group = texts[at:upto]
        lengths = np.array([len(t) + 1 for t in group])
        lengths[0] += 1
        points = np.frombuffer("\n".join(["", *group, ""]).encode("utf-32-le", "replace"), np.uint32)
        owner = np.repeat(np.arange(at, upto, dtype=np.int32), lengths)
        kept = letters()[np.minimum(points, 0x10FFFF)]
        keep = kept > 0
        keep[1:] |= kept[:-1] > 0
        keep[0] = True
        kept, owner = kept[keep], owner[keep]
        letter = kept > 0
        h = np.zeros(len(kept), np.uint32)
        whole = np.ones(len(kept), bool)
        for n, buckets in enumerate(BUCKETS):
            if len(kept) <= n:
                break
            here = kept[n:]
            h = (h[: len(here)] + here + np.uint32(1)) * MIX
            h ^= h >> np.uint32(15)
            # a gram may begin and end with an edge but not go over one, nor be one alone
            whole = whole[: len(here)] & (letter[n:] if n == 0 else letter[n - 1 : len(kept) - 1] if n > 1 else (letter[1:] | letter[:-1]))
            fine = whole if n else letter
            yield (h[fine] & np.uint32(buckets - 1)).astype(np.int64) + OFFSETS[n], owner[n:][fine]
            if n == 0:
                whole = np.ones(len(kept), bool)
        at = upto


def score(texts: list[str], weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Mean weight a gram for each text and bit, and the number of grams."""
    total = np.zeros((len(texts), weights.shape[1]), np.float64)
    count = np.zeros(len(texts), np.int64)
    for features, owner in grams(texts):
        if not len(features):
            continue
        starts = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
        at = owner[starts]
        total[at] += np.add.reduceat(weights[features], starts, axis=0, dtype=np.float64)
        count[at] += np.diff(np.r_[starts, len(features)])
    return total / np.maximum(count, 1)[:, None], count


@dataclass
class Model:
    languages: list[str]
    code: np.ndarray  # languages x bits, +1 and -1
    weights: np.ndarray  # features x bits
    slope: np.ndarray  # of each bit
    shift: np.ndarray
    trust: np.ndarray  # languages x bits, each row sums to 1

    def decode(self, means: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Nearest language, its share of the likelihood that distances stand for, and ambiguity, for each row."""
        margin = np.clip(means * self.slope + self.shift, -30, 30)
        loss = np.log1p(np.exp(-margin[:, None, :] * self.code[None]))
        distance = (loss * self.trust[None]).sum(2)
        order = np.argsort(distance, axis=1, kind="stable")
        best = order[:, 0]
        likely = np.exp(-(distance - distance.min(1, keepdims=True)) * self.code.shape[1])
        share = 1 / likely.sum(1)
        near = np.zeros(len(best), bool)
        if len(self.languages) > 1:
            rows = np.arange(len(best))
            near = distance[rows, order[:, 1]] - distance[rows, best] < AMBIGUOUS
        return best, share, near


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Slope and shift of a weighted logistic fit of y (+1, -1) on x, with a little shrinkage, by Newton steps."""
    scale = float(np.sqrt((weight * x * x).sum() / weight.sum())) or 1.0
    z, theta = np.stack([x / scale, np.ones_like(x)], 1), np.array([1.0, 0.0])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(z @ theta, -30, 30)))
        slope = z.T @ (weight * (p - (y > 0))) + 1e-3 * weight.sum() * theta
        bend = (z * (weight * p * (1 - p))[:, None]).T @ z + 1e-3 * weight.sum() * np.eye(2)
        step = np.linalg.solve(bend, slope)
        theta -= step
        if np.abs(step).max() < 1e-9:
            break
    return float(theta[0] / scale), float(theta[1])


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        langs, texts = batch.column(0).to_pylist(), [t or "" for t in batch.column(1).to_pylist()]
        names = sorted(set(langs))
        number = np.array([names.index(x) for x in langs], np.int64)
        found = [np.zeros(0, np.int64), *(number[owner] * OFFSETS[-1] + features for features, owner in grams(texts))]
        key, n = np.unique(np.concatenate(found), return_counts=True)
        where, feature = np.divmod(key, OFFSETS[-1])
        yield pa.RecordBatch.from_arrays([pa.array([names[i] for i in where], pa.string()), pa.array(feature, pa.int32()), pa.array(n, pa.int64())], ["lang", "feature", "n"])


def _means(batches: Iterator[pa.RecordBatch], weights) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        means, count = score([t or "" for t in batch.column(1).to_pylist()], weights.value)
        kept = np.flatnonzero(count > 0)
        yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(kept)), pa.array(list(means[kept]), pa.list_(pa.float64()))], ["lang", "means"])


def fit(labelled: DataFrame, per_language: int = 1000, most_texts: int = 20_000, most_languages: int = 500) -> Model | None:
    """A model from `labelled` (doc_id, text, lang), None if no text has a label.

    Half of the sample gives the n-gram counts, the other half the logistic fits and the weights for decoding. Of more
    than `most_languages` labels those with the most texts are learnt (ties to the first in order): the driver and every
    task hold a row of weights a language.
    """
    spark = labelled.sparkSession
    rows = pick(labelled, doc_id="bigint", text="string", lang="string").where("lang is not null and text is not null")
    sizes = {r.lang: r["count"] for r in rows.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(most_languages).collect()}
    if not sizes:
        return None
    share = max(1, min(per_language, most_texts // len(sizes)))
    odds = spark.createDataFrame([(k, min(1 << 20, (share << 20) // n)) for k, n in sizes.items()], "lang string, odds bigint")
    place = F.xxhash64(F.lit("langid"), "doc_id")
    sample = rows.join(F.broadcast(odds), "lang").where(F.pmod(place, F.lit(1 << 20)) < F.col("odds"))
    half = F.pmod(F.shiftright(place, 20), F.lit(2))
    languages = sorted(sizes)
    code = codewords(len(languages))
    tally = sample.where((half == 0) | (F.col("odds") == 1 << 20)).select("lang", "text").mapInArrow(_counts, "lang string, feature int, n bigint")
    table = np.zeros((len(languages), OFFSETS[-1]))
    got = tally.groupBy("lang", "feature").agg(F.sum("n").alias("n")).toPandas()
    np.add.at(table, (np.searchsorted(languages, got.lang), got.feature.to_numpy(np.int64)), got.n.to_numpy(np.float64))
    likely = np.zeros_like(table)
    for a, b in zip(OFFSETS, OFFSETS[1:]):  # each order is a distribution of its own
        part = table[:, a:b] + 0.5
        likely[:, a:b] = part / part.sum(1, keepdims=True)
    weights = np.zeros((OFFSETS[-1], code.shape[1]), np.float32)
    for j in range(code.shape[1]):
        if (code[:, j] > 0).any() and (code[:, j] < 0).any():
            weights[:, j] = np.log(likely[code[:, j] > 0].mean(0) / likely[code[:, j] < 0].mean(0))
    sent = spark.sparkContext.broadcast(weights)
    seen = sample.where((half == 1) | (F.col("odds") == 1 << 20)).select("lang", "text").mapInArrow(lambda b: _means(b, sent), "lang string, means array<double>").toPandas()
    sent.unpersist()
    means = np.array(list(seen.means), np.float64).reshape(-1, code.shape[1])
    number = np.searchsorted(languages, seen.lang.to_numpy(str)) if len(seen) else np.zeros(0, np.int64)
    balance = 1 / np.maximum(np.bincount(number, minlength=len(languages)), 1)[number]
    slope, shift = np.ones(code.shape[1]), np.zeros(code.shape[1])
    trust = np.ones_like(code, np.float64)
    for j in range(code.shape[1]):
        y = code[number, j]
        if (y > 0).any() and (y < 0).any():
            slope[j], shift[j] = _logistic(means[:, j], y, balance)
            right = (means[:, j] * slope[j] + shift[j]) * y > 0
            for i in range(len(languages)):
                if (own := number == i).any():
                    trust[i, j] = right[own].mean()
    trust = np.maximum(trust, 0.05)
    return Model(languages, code, weights, slope, shift, trust / trust.sum(1, keepdims=True))


def _predict(batches: Iterator[pa.RecordBatch], sent) -> Iterator[pa.RecordBatch]:
    model = sent.value
    for batch in slices(batches):
        texts = [t or "" for t in batch.column(1).to_pylist()]
        means, count = score(texts, model.weights)
        best, share, near = model.decode(means)
        known = count > 0
        names = [model.languages[i] if k else UNKNOWN for i, k in zip(best, known)]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(names, pa.string()), pa.array(np.where(known, share, 0.0)), pa.array(near | ~known)], ["doc_id", "lang_pred", "score", "ambiguous"])


def predict(docs: DataFrame, model: Model | None) -> DataFrame:
    """doc_id, lang_pred, score (0 to 1) and ambiguous for every whole text; no shuffle.

    A null text, or one without a letter, is `und` with score 0 and ambiguous, as is every text if there is no model.
    Ties go to the language first in order. Repeated rows give repeated rows, an empty table none; other columns are left
    out whatever their names.
    """
    rows = pick(docs, doc_id="bigint", text="string")
    if model is None:
        return rows.select("doc_id", F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"), F.lit(True).alias("ambiguous"))
    sent = docs.sparkSession.sparkContext.broadcast(model)
    return rows.mapInArrow(lambda batches: _predict(batches, sent), "doc_id bigint, lang_pred string, score double, ambiguous boolean")


def _relabel(batches: Iterator[pa.RecordBatch], sent, text_at: int, lang_at: int) -> Iterator[pa.RecordBatch]:
    model = sent.value
    for batch in slices(batches):
        means, count = score([t or "" for t in batch.column(text_at).to_pylist()], model.weights)
        names = [model.languages[i] if n else UNKNOWN for i, n in zip(model.decode(means)[0], count)]
        yield batch.set_column(lang_at, batch.schema.field(lang_at), pa.array(names, pa.string()))


def label_rows(docs: DataFrame, model: Model | None) -> DataFrame:
    """The rows of `docs` with `lang` set to the predicted one (`und` as in `predict`); no shuffle."""
    if model is None:
        return docs.withColumn("lang", F.lit(UNKNOWN))
    sent, names = docs.sparkSession.sparkContext.broadcast(model), docs.columns
    schema = StructType([StructField(f.name, f.dataType) for f in docs.schema])
    return docs.mapInArrow(lambda b: _relabel(b, sent, names.index("text"), names.index("lang")), schema)


def held_out(doc_id: Column, parts: int, part: int) -> Column:
    """Whether crc32 of the id as text leaves `part` on division by `parts`; a null id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % parts == part


def label(docs: DataFrame, parts: int = 4, part: int = 2, **limits: int) -> DataFrame:
    """doc_id, held_out, lang_pred, score, ambiguous: learnt from labelled rows that aren't held out, said of all."""
    rows = pick(docs, doc_id="bigint", text="string", lang="string")
    model = fit(rows.where(~held_out(F.col("doc_id"), parts, part)), **limits)
    return predict(rows, model).select("doc_id", held_out(F.col("doc_id"), parts, part).alias("held_out"), "lang_pred", "score", "ambiguous")
