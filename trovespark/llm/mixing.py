"""Mixing overlapping sources to target weights by min-cost flow.

Documents are aggregated by membership pattern: the set of sources that a document belongs to. A pattern can give its
words once, twice and so on up to a most number of repeats, each repeat costing more than the one before (a convex cost,
so that repeats come only when fresh words run out). Min-cost flow routes that capacity from the patterns to the quotas
of the sources they belong to. Each pattern then takes its documents whole as often as the flow fills, and of one more
round a seeded share: those whose hash lies below a cutoff that a radix search over hash buckets finds, exact to one
bucket of 2^-36 of the pattern, without ordering documents or gathering them.

The driver holds one row for each pattern and source; `max_patterns` is checked and an excess is an error, not a cut.
"""

from __future__ import annotations

import heapq
import json
from collections import defaultdict
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from trovespark.frames import materialise, pick, release

WORD = r"[^\x20\x09-\x0D]+"
#: Bits of the seeded hash, found in rounds of so many.
BITS, ROUND = 36, 12

Pattern = tuple[str | None, ...]


def shares(sizes: dict[str | None, int], weights: tuple[int, ...] = (5, 2, 1), amount: float = 1.5, most: float = 2.0) -> dict[str | None, float]:
    """Target words for each source: weights in turn by code point (null last) share `amount` times all words; a target
    stops at `most` times its source, the excess being shared again by weight until none is above."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    limit = {s: most * sizes[s] for s in order}
    left, open_, out = amount * sum(sizes.values()), list(order), {}
    while open_:
        total = sum(weight[s] for s in open_)
        full = [s for s in open_ if left * weight[s] / total > limit[s]]
        if not full:
            out |= {s: left * weight[s] / total for s in open_}
            break
        for s in full:
            out[s] = limit[s]
        left -= sum(limit[s] for s in full)
        open_ = [s for s in open_ if s not in out]
    return out


def route(capacity: dict[Pattern, int], quotas: dict[str | None, int], repeats: int) -> dict[tuple[Pattern, str | None], int]:
    """Words that flow from each pattern to each of its sources: as much as fits, at least cost.

    The n-th use of a pattern's words costs n - 1 a word. Cheapest augmenting paths (Dijkstra with potentials), each as
    wide as it can be; ties go to the pattern and source first in order, so the same input gives the same flow.
    """
    patterns = sorted(capacity, key=lambda p: json.dumps(p))
    sources = sorted(quotas, key=lambda s: (s is None, s or ""))
    begin, end = 0, 1
    node = {("p", p): 2 + i for i, p in enumerate(patterns)} | {("s", s): 2 + len(patterns) + i for i, s in enumerate(sources)}
    to, room, cost, out = [], [], [], defaultdict(list)

    def arc(a: int, b: int, most: int, price: int) -> int:
        for x, y, m, c in ((a, b, most, price), (b, a, 0, -price)):
            out[x].append(len(to))
            to.append(y)
            room.append(m)
            cost.append(c)
        return len(to) - 2

    routes = {}
    for p in patterns:
        for r in range(repeats):
            arc(begin, node["p", p], capacity[p], r)
        for s in p:
            if s in quotas:
                routes[p, s] = arc(node["p", p], node["s", s], repeats * capacity[p], 0)
    for s in sources:
        arc(node["s", s], end, quotas[s], 0)
    potential = defaultdict(int)
    while True:
        far, via, heap = {begin: 0}, {}, [(0, begin)]
        while heap:
            d, a = heapq.heappop(heap)
            if d > far[a]:
                continue
            for e in out[a]:
                if room[e] > 0 and (n := d + cost[e] + potential[a] - potential[to[e]]) < far.get(to[e], n + 1):
                    far[to[e]], via[to[e]] = n, e
                    heapq.heappush(heap, (n, to[e]))
        if end not in far:
            break
        for a in far:
            potential[a] += far[a]
        path, at = [], end
        while at != begin:
            path.append(via[at])
            at = to[via[at] ^ 1]
        width = min(room[e] for e in path)
        for e in path:
            room[e] -= width
            room[e ^ 1] += width
    return {k: room[e ^ 1] for k, e in routes.items() if room[e ^ 1]}


def size_of(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def pattern_of(sources: Column) -> Column:
    """An array of sources as a key: JSON of its distinct members in order (null last)."""
    return F.to_json(F.array_sort(F.array_distinct(sources)))


def draw(doc_id: Column, text: Column, seed: int) -> Column:
    """The document's seeded place, uniform over 2^BITS: rows without an id, or that share one, differ by their texts."""
    return F.pmod(F.xxhash64(F.lit(seed), doc_id, text), F.lit(1 << BITS))


@dataclass
class Mix:
    """A fitted mix: for each pattern how often its documents are taken whole, and below which draw once more."""

    seed: int
    source_size: dict[str | None, int]
    target: dict[str | None, float]
    flow: dict[tuple[Pattern, str | None], int]
    whole: dict[str, int]
    cutoff: dict[str, int]

    def repeats(self, spark, docs: DataFrame, place: Column, pattern: str) -> DataFrame:
        """`docs` with `repeats`, by a broadcast of one row for each pattern."""
        rows = [(k, self.whole[k], self.cutoff[k]) for k in self.whole]
        table = F.broadcast(spark.createDataFrame(rows, "_pattern string, _whole int, _cutoff bigint"))
        more = (place < F.col("_cutoff")).cast("int")
        joined = docs.join(table, F.col(pattern) == F.col("_pattern"), "left")
        return joined.withColumn("repeats", F.coalesce(F.col("_whole") + more, F.lit(0))).drop("_pattern", "_whole", "_cutoff")


def fit(sizes: DataFrame, quotas, repeats: int = 2, seed: int = 0, max_patterns: int = 100_000) -> Mix:
    """A Mix for `sizes` (place, pattern, size); `quotas` maps the words of each source to its target words."""
    spark = sizes.sparkSession
    found = sizes.groupBy("pattern").agg(F.sum("size").alias("size")).limit(max_patterns + 1).collect()
    if len(found) > max_patterns:
        raise ValueError(f"more than {max_patterns} membership patterns; raise max_patterns or merge sources")
    keys = {tuple(json.loads(r.pattern)): r.pattern for r in found}
    capacity = {tuple(json.loads(r.pattern)): int(r.size) for r in found}
    source_size: dict[str | None, int] = defaultdict(int)
    for p, n in capacity.items():
        for s in p:
            source_size[s] += n
    target = quotas(dict(source_size))
    flow = route(capacity, {s: round(t) for s, t in target.items()}, repeats)
    words: dict[Pattern, int] = defaultdict(int)
    for (p, _), n in flow.items():
        words[p] += n
    whole = {keys[p]: words[p] // n if n else 0 for p, n in capacity.items()}
    need = {keys[p]: words[p] % n for p, n in capacity.items() if n and words[p] % n}
    cutoff = dict.fromkeys(whole, 0)
    cut = {k: (0, n) for k, n in need.items()}  # bucket so far, words still wanted from it
    for done in range(ROUND, BITS + 1, ROUND):
        if not cut:
            break
        state = F.broadcast(spark.createDataFrame([(k, b, n) for k, (b, n) in cut.items()], "_pattern string, _bucket bigint, _need bigint"))
        place = F.col("place")
        inside = sizes.join(state, (F.col("pattern") == F.col("_pattern")) & (F.shiftright(place, BITS - done + ROUND) == F.col("_bucket")))
        buckets = inside.groupBy("pattern", "_need", F.shiftright(place, BITS - done).alias("bucket")).agg(F.sum("size").alias("size"))
        running = buckets.withColumn("upto", F.sum("size").over(Window.partitionBy("pattern").orderBy("bucket")))
        edge = running.where("upto >= _need").groupBy("pattern").agg(F.min(F.struct("bucket", "size", "upto")).alias("e")).collect()
        last = done == BITS
        for r in edge:
            before = int(r.e.upto - r.e.size)
            left = cut[r.pattern][1] - before
            if last:
                cutoff[r.pattern] = r.e.bucket + (2 * left >= r.e.size)
            else:
                cut[r.pattern] = (r.e.bucket, left)
    return Mix(seed, dict(source_size), target, flow, whole, cutoff)


def mix(docs: DataFrame, weights: tuple[int, ...] = (5, 2, 1), amount: float = 1.5, repeats: int = 2, seed: int = 0) -> DataFrame:
    """doc_id, size, source_size, target, taken, source, repeats of every document, mixed to weighted sources.

    A null text has size 0 and takes 0; a null source is a source of its own, last in order. Rows equal in
    doc_id and text are drawn together. A document is taken whole 0 to `repeats` times. An empty table gives none; other columns are left
    out whatever their names. Only (doc_id, source, size, place) rows are kept between passes, as a table in the shared folder.
    """
    spark = docs.sparkSession
    rows = pick(docs, doc_id="bigint", text="string", source="string")
    sizes = materialise(rows.select("doc_id", "source", pattern_of(F.array("source")).alias("pattern"), size_of(F.col("text")).alias("size"), draw(F.col("doc_id"), F.col("text"), seed).alias("place")), "mix-sizes")
    fitted = fit(sizes, lambda of: shares(of, weights, amount, repeats), repeats, seed)
    if not fitted.whole:
        release(sizes)
        return spark.createDataFrame([], "doc_id bigint, size bigint, source_size bigint, target double, taken bigint, source string, repeats int")
    info = [(k, fitted.source_size[s], float(fitted.target[s])) for k in fitted.whole for s in json.loads(k)]
    table = F.broadcast(spark.createDataFrame(info, "_key string, source_size bigint, target double"))
    rows = fitted.repeats(spark, sizes, F.col("place"), "pattern").join(table, F.col("pattern") == F.col("_key"), "left")
    out = materialise(rows.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("repeats")).alias("taken"), "source", "repeats"), "mix")
    release(sizes)
    return out


def mixed_documents(docs: DataFrame, weights: tuple[int, ...] = (5, 2, 1), amount: float = 1.5, repeats: int = 2, seed: int = 0) -> DataFrame:
    """The rows of `docs` as often as the mix takes them, with the same columns. A null doc_id counts as any other; of
    columns that share a name but for case the one spelled `doc_id`, `text` or `source` counts. An empty table gives none.
    """
    names = docs.columns
    plain = docs.toDF(*[f"_in{i}" for i in range(len(names))])
    of = {c: F.col(f"_in{names.index(c)}") for c in ("doc_id", "text", "source")}
    rows = plain.withColumn("_key", pattern_of(F.array(of["source"]))).withColumn("_place", draw(of["doc_id"], of["text"], seed))
    sizes = materialise(rows.select(F.col("_key").alias("pattern"), F.col("_place").alias("place"), size_of(of["text"]).alias("size")), "mix-sizes")
    fitted = fit(sizes, lambda found: shares(found, weights, amount, repeats), repeats, seed)
    release(sizes)
    if not fitted.whole:
        return docs
    taken = fitted.repeats(docs.sparkSession, rows, F.col("_place"), "_key").where("repeats > 0")
    return taken.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("repeats")))).select(*[f"_in{i}" for i in range(len(names))]).toDF(*names)
