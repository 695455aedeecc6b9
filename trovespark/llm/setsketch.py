"""Near-duplicate documents by SetSketch registers.

A sketch register is the exponentially spaced, truncated minimum of an exponential hash over a document's shingles: how
many steps of a factor b the smallest value lies below one, cut to 16 bits. Registers of a union are the largest of both
(mergeable), and equal ones are the likelier the more two sets overlap (locality-sensitive). So

1. documents with equal shingle sets become one class, before anything is compared;
2. registers are cut into bands; classes that share a band's registers are candidates;
3. a candidate pair's Jaccard is estimated from its registers jointly, by maximum likelihood over the numbers of larger,
   smaller and equal ones; clearly unlike pairs go;
4. what is left is verified on full sets, first of the shingles' numbers, then of the words themselves, and links make
   components.

Buckets of up to `SMALL` classes are paired by a join. In larger ones (many near copies of one text) pairs are never
rows. First each member is compared with its bucket's hub, the smallest id: that is linear, and links most of a group.
Buckets whose members are then of one component are done. The others are cut into blocks bounded in bytes, each pair of
blocks is compared in memory, most alike pairs first, and only pairs that nothing connects yet are looked at. There a pair
is dealt with in the first band that it shares, once.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from trovespark.frames import materialise, pick, release, slices
from trovespark.llm.components import components
from trovespark.llm.words import mixed, shingles, word_numbers

#: Rows in a band and bands. At a Jaccard of 0.8 a pair shares no band with a chance of (1 - 0.8^6)^40 = 5e-6.
ROWS, BANDS = 6, 40
REGISTERS = ROWS * BANDS
#: Base of the spacing, rate of the exponentials, and the largest register.
BASE, RATE, TOP = 1.001, 20.0, (1 << 16) - 1
#: An estimate so many standard deviations below the threshold is taken for unlike (chance of a wrong one: 3e-5).
DEVIATIONS = 4.0
SMALL = 8
BLOCK_BYTES = 24 << 20
#: Ids up to this many are broadcast to fetch their documents, or leave them out; more are joined by shuffle.
BROADCAST_IDS = 2_000_000


@cache
def _multipliers() -> np.ndarray:
    return np.random.default_rng(20210101).integers(0, 1 << 31, REGISTERS, dtype=np.uint32)[:, None] * np.uint32(2) + np.uint32(1)


def registers(found: np.ndarray) -> np.ndarray:
    """The sketch of a set of 64-bit numbers, zeros for the empty set."""
    if not len(found):
        return np.zeros(REGISTERS, np.uint16)
    short = (mixed(found) >> np.uint64(32)).astype(np.uint32)
    least = np.full(REGISTERS, 0xFFFFFFFF, np.uint32)
    for i in range(0, len(short), 2048):
        np.minimum(least, (short[None, i : i + 2048] * _multipliers()).min(1), out=least)
    value = -np.log1p(-(least + 0.5) / 2.0**32) / RATE
    return np.clip(np.floor(1 - np.log(value) / np.log(BASE)), 0, TOP).astype(np.uint16)


def merged(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The sketch of the union of two sets."""
    return np.maximum(a, b)


def bands(sketch: np.ndarray) -> np.ndarray:
    """A 64-bit key for each band, different for equal registers in different bands."""
    key = np.arange(1, BANDS + 1, dtype=np.uint64)
    for column in sketch.reshape(BANDS, ROWS).T.astype(np.uint64):
        key = mixed(key * np.uint64(0x9E3779B97F4A7C15) + column)
    return key.astype(np.int64)


def estimate(larger: np.ndarray, smaller: np.ndarray, size_a: np.ndarray, size_b: np.ndarray) -> np.ndarray:
    """Most likely Jaccard of pairs whose first sketch has so many larger and smaller registers, sizes being known.

    A register is larger in the first with probability p(u - vJ) and smaller with p(v - uJ), where u and v are the
    sets' shares of both sizes and p(x) = -log_b(1 - x(b-1)/b); the log-likelihood is concave in J, so a ternary search
    finds its top.
    """
    u = size_a / (size_a + size_b)
    v, log_b, step = 1 - u, np.log(BASE), (BASE - 1) / BASE
    equal = REGISTERS - larger - smaller

    def likely(j: np.ndarray) -> np.ndarray:
        up = -np.log1p(-np.maximum(u - v * j, 0) * step) / log_b
        down = -np.log1p(-np.maximum(v - u * j, 0) * step) / log_b
        return larger * np.log(np.maximum(up, 1e-12)) + smaller * np.log(np.maximum(down, 1e-12)) + equal * np.log(np.maximum(1 - up - down, 1e-12))

    low, high = np.zeros_like(u), np.minimum(u / v, v / u)
    for _ in range(40):
        a, b = low + (high - low) / 3, high - (high - low) / 3
        better = likely(a) < likely(b)
        low, high = np.where(better, a, low), np.where(better, high, b)
    return (low + high) / 2


def hopeful(a: np.ndarray, b: np.ndarray, size_a: np.ndarray, size_b: np.ndarray, percent: int) -> np.ndarray:
    """Which pairs (rows of registers) may reach the threshold, by size and by joint estimate."""
    fits = 100 * np.minimum(size_a, size_b) >= percent * np.maximum(size_a, size_b)
    floor = percent / 100 - DEVIATIONS * np.sqrt(percent / 100 * (1 - percent / 100) / REGISTERS)
    at = np.flatnonzero(fits)
    if len(at):
        x, y = a[at].astype(np.int32), b[at].astype(np.int32)
        fits[at] = estimate((x > y).sum(1).astype(float), (x < y).sum(1).astype(float), size_a[at].astype(float), size_b[at].astype(float)) >= floor
    return fits


def linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """Whether two sorted sets' Jaccard reaches the threshold, exactly."""
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= percent * (len(a) + len(b) - both)


def word_shingles(text: str | None, width: int) -> set[tuple[bytes, ...]]:
    """A text's distinct shingles as words, not numbers. Bytes are split and lowered in ASCII alone, as words are defined."""
    found = (text or "").encode("utf-8", "surrogatepass").lower().split()
    return set(zip(*(found[i:] for i in range(min(width, len(found)))))) if found else set()


def linked_words(a: set, b: set, percent: int) -> bool:
    """Whether two sets of shingles reach the threshold, exactly."""
    both = len(a & b)
    return 100 * both >= percent * (len(a) + len(b) - both)


def set_name(text: str | None, width: int) -> bytes:
    """A digest of a text's set of shingles, as words."""
    return xxhash.xxh3_128_digest(b"\n".join(sorted(map(b" ".join, word_shingles(text, width)))))


def _sets(texts: list[str | None], width: int) -> list[np.ndarray]:
    numbers, starts = word_numbers([t or "" for t in texts])
    return [shingles(numbers[a:b], width) for a, b in zip(starts, starts[1:])]


def _sketches(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        texts = batch.column(1).to_pylist()
        found = _sets(texts, width)
        keys = [bands(registers(s)) if len(s) else [] for s in found]
        names = [set_name(t, width) if len(s) else None for s, t in zip(found, texts)]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([len(s) for s in found], pa.int64()), pa.array(names, pa.binary()), pa.array(keys, pa.list_(pa.int64()))], ["doc_id", "n", "set_id", "bands"])


def _full(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        found = _sets(batch.column(1).to_pylist(), width)
        columns = [[len(s) for s in found], [registers(s).tobytes() for s in found], [s.tobytes() for s in found]]
        yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, k) for c, k in zip(columns, (pa.int64(), pa.binary(), pa.binary()))), batch.column(1)], ["id", "n", "registers", "shingles", "text"])


def sized(ids: DataFrame) -> DataFrame:
    """The same ids, marked for broadcast unless they are many. Spark's own estimate goes by bytes, so that a slightly larger
    table would have all the texts it is joined to dealt anew."""
    return F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids


def _full_sets(docs: DataFrame, ids: DataFrame, width: int) -> DataFrame:
    """id, n, registers, shingles and text of the documents with these ids, from their whole texts."""
    chosen = docs.join(sized(ids), docs.doc_id == ids.id, "left_semi")
    return chosen.mapInArrow(lambda b: _full(b, width), "id bigint, n bigint, registers binary, shingles binary, text string")


def _rows(column: pa.Array, kind: type) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(len(column), -1) if len(column) else np.zeros((0, REGISTERS), kind)


def _screen(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, 2000):
        a, b = _rows(batch.column(2), np.uint16), _rows(batch.column(3), np.uint16)
        fits = hopeful(a, b, batch.column(4).to_numpy(), batch.column(5).to_numpy(), percent)
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["a", "b"]).filter(pa.array(fits))


def _verify(batches: Iterator[pa.RecordBatch], percent: int, width: int) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, 2000):
        said = [linked(np.frombuffer(x.as_py(), np.uint64), np.frombuffer(y.as_py(), np.uint64), percent) for x, y in zip(batch.column(2), batch.column(3))]
        said = [ok and linked_words(word_shingles(x.as_py(), width), word_shingles(y.as_py(), width), percent) for ok, x, y in zip(said, batch.column(4), batch.column(5))]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["a", "b"]).filter(pa.array(said, pa.bool_()))


def _compare(group: pd.DataFrame, percent: int, width: int) -> pd.DataFrame:
    """Links between the members of two blocks of a bucket: enough to connect what the pairs dealt with here connect.

    What verified links connect comes as a star around its smallest id, so that the buckets of one group of copies give
    much the same rows.
    """
    first_block, second_block = int(group["first"].iloc[0]), int(group["second"].iloc[0])
    group = group.sort_values("id", kind="stable").reset_index(drop=True)
    sketch = np.frombuffer(b"".join(group.registers), np.uint16).reshape(len(group), REGISTERS)
    size, band = group.n.to_numpy(), int(group.band.iloc[0])
    left = np.flatnonzero(group.block == first_block)
    right = left if first_block == second_block else np.flatnonzero(group.block == second_block)
    shaped = sketch.reshape(len(group), BANDS, ROWS)
    found: list[tuple[float, int, int]] = []
    floor = percent / 100 - DEVIATIONS * np.sqrt(percent / 100 * (1 - percent / 100) / REGISTERS)
    ids, component = group.id.to_numpy(), group.component.to_numpy()
    for i in left:
        others = right[right > i] if first_block == second_block else right
        others = others[component[others] != component[i]]
        others = others[100 * np.minimum(size[others], size[i]) >= percent * np.maximum(size[others], size[i])]
        if not len(others):
            continue
        if band:
            others = others[~(shaped[others, :band] == shaped[i, :band]).all(2).any(1)]
        x, y = sketch[i].astype(np.int32), sketch[others].astype(np.int32)
        likeness = estimate((x > y).sum(1).astype(float), (x < y).sum(1).astype(float), np.full(len(others), float(size[i])), size[others].astype(float))
        keep = likeness >= floor
        found += zip(-likeness[keep], np.full(keep.sum(), i), others[keep])
    sets, texts = [np.frombuffer(s, np.uint64) for s in group.shingles], group.text.tolist()
    root = pd.Series(range(len(group))).groupby(component).transform("first").tolist()  # what is connected already

    def top(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    before = [top(i) for i in range(len(group))]
    for _, i, j in sorted(found):
        if top(i) != top(j) and linked(sets[i], sets[j], percent) and linked_words(word_shingles(texts[i], width), word_shingles(texts[j], width), percent):
            i, j = top(i), top(j)
            root[max(i, j)] = min(i, j)
    out = [(ids[top(i)], ids[i]) for i in range(len(ids)) if top(i) != i and before[i] == i]
    return pd.DataFrame(out, columns=["a", "b"]).astype({"a": "int64", "b": "int64"})


def _paired(pairs: DataFrame, sets: DataFrame, *columns: str) -> DataFrame:
    """Pairs (a, b) with the named columns of both members, those of a first."""
    for side in ("a", "b"):
        pairs = pairs.join(sets.select(F.col("id").alias(side), *(F.col(c).alias(f"{c}_{side}") for c in columns)), side)
    return pairs.select("a", "b", *(f"{c}_{s}" for c in columns for s in ("a", "b")))


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every row; documents whose word shingles' Jaccard is at least `percent`
    hundredths are linked, and component_id is the smallest doc_id that links reach.

    A null or empty text, or one without words, has no shingles and is linked with nothing; one with fewer words than
    `width` has them all as one shingle. Rows that repeat a doc_id are one document with several texts (linked to what
    any of them is linked to). A row with a null doc_id is linked with nothing: its component_id and kept are null. An
    empty table gives none; other columns are left out whatever their names.
    """
    rows = pick(docs, doc_id="bigint", text="string")
    sketches = materialise(rows.mapInArrow(lambda b: _sketches(b, width), "doc_id bigint, n bigint, set_id binary, bands array<bigint>"), "sketches")
    named = sketches.where("n > 0 and doc_id is not null")
    classes = named.groupBy("set_id").agg(F.min("doc_id").alias("rep"))
    member = materialise(named.select("doc_id", "n", "set_id").distinct().join(classes, "set_id").select("doc_id", "n", "set_id", "rep"), "members")
    own = member.where("doc_id = rep").select("rep", "set_id")
    one = named.join(own, (named.doc_id == own.rep) & (named.set_id == own.set_id)).select("rep", "n", "bands").distinct()
    keys = materialise(one.select("rep", "n", F.posexplode("bands").alias("band", "key")), "bands")
    keys_by = keys.repartition("key")  # dealt once, for the counts and for the rows that they pick
    shared = keys_by.groupBy("key").agg(F.count(F.lit(1)).alias("many"), F.sum(F.col("n") * 16 + REGISTERS * 2).alias("bytes")).where("many > 1")
    buckets = materialise(keys_by.join(shared, "key").select(F.col("rep").alias("id"), "band", "key", "many", "bytes"), "buckets")
    release(keys)
    sets = materialise(_full_sets(rows, buckets.select("id").distinct(), width), "sets")

    small = buckets.where(F.col("many") <= SMALL).select("key", "id")
    pairs = small.select("key", F.col("id").alias("a")).join(small.select("key", F.col("id").alias("b")), "key").where("a < b").select("a", "b").distinct()
    large = buckets.where(F.col("many") > SMALL)
    hubs = large.groupBy("key").agg(F.min("id").alias("a"))
    spokes = large.join(hubs, "key").where("id != a").select("a", F.col("id").alias("b"))
    hopes = _paired(pairs.union(spokes).distinct(), sets, "registers", "n").mapInArrow(lambda b: _screen(b, percent), "a bigint, b bigint")
    found = _paired(hopes, sets, "shingles", "text").mapInArrow(lambda b: _verify(b, percent, width), "a bigint, b bigint")
    several = member.groupBy("doc_id").agg(F.min("rep").alias("low"), F.max("rep").alias("high")).where("low < high")
    same = member.join(several, "doc_id").select(F.col("low").alias("a"), F.col("rep").alias("b"))
    early = components(found.union(same))

    named_large = large.join(early, large.id == early.node, "left").select("key", "band", "id", "bytes", F.coalesce("component", "id").alias("component"))
    mixed_keys = named_large.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low < high").select("key")
    blocks = F.ceil(F.col("bytes") / BLOCK_BYTES).cast("int")
    rest = named_large.join(mixed_keys, "key").withColumn("block", F.pmod(F.xxhash64("id"), blocks).cast("int"))
    rest = rest.withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
    rest = rest.select("key", "band", "id", "component", "block", F.least("block", "other").alias("first"), F.greatest("block", "other").alias("second")).join(sets, "id")
    more = rest.groupBy("key", "first", "second").applyInPandas(lambda g: _compare(g, percent, width), "a bigint, b bigint")
    joined = components(early.select(F.col("node").alias("a"), F.col("component").alias("b")).union(more))
    release(buckets, sets, early)
    labels = member.select("doc_id", "rep").groupBy("doc_id").agg(F.min("rep").alias("rep"))
    labels = labels.join(joined, labels.rep == joined.node, "left").select(F.col("doc_id").alias("_doc"), F.coalesce("component", "rep").alias("_component"))
    component = F.coalesce("_component", "doc_id")
    rows = sketches.select("doc_id", "n").join(labels, sketches.doc_id == labels._doc, "left")
    out = materialise(rows.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"), (F.col("doc_id") == component).alias("kept")), "near-duplicates")
    release(sketches, member, joined)
    return out
