"""Hierarchical Pitman-Yor language model over words, trained on all texts and scoring all texts.

Restaurants. Each context has a restaurant whose dishes are the words that follow it; all of them share one parent, the
root. Every word of the training texts is a context of its own, however rare; the end of a text stands for the begin of
the next as a context. A table in a context's restaurant is a customer of the root. The root's own base has no atoms: each
word has one table there, and what the root keeps for further tables is the probability of the one unknown word.

Gibbs sweeps. Two kinds of auxiliary numbers make all cells (a word in a context) independent of each other, so that a
sweep is exact however the cells are dealt to tasks: for each context a gamma number of shape strength / discount + its
tables, and the root's distribution itself, whose masses are gamma numbers of shape tables - root discount (and, for the
unknown word, root strength + root discount * words). Given them a cell of n customers has t tables with probability
proportional to S(n, t) opens^t, where opens = discount * the context's number * the word's mass; `stirling.draw` draws
from that exactly for every n, with no need of the sweep before. Strengths and discounts are fitted to the seatings of the
burn-in by Newton steps and stay fixed while predictive probabilities are averaged over the sampling sweeps.

Layout. Texts become token blocks once. Words are dealt to groups by hash, and a group numbers its words. Cells lie in a
grid of parts: a part has the contexts of one row of groups and the words of one column. So neither a frequent word nor a
frequent context is in one part, and a sweep exchanges one number a word and part: parts tell groups the tables of their
words as contexts and as dishes, and get the totals back. The driver holds one number a group and the sums.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from trovespark.frames import materialise, pick, release, slices
from trovespark.llm.langid import held_out
from trovespark.llm.packed import pack, unpack
from trovespark.llm.stirling import draw, log_gamma, log_numbers
from trovespark.llm.words import word_numbers

#: Tokens in a block (a longer text is a block of its own), training tokens in a part, and words of blocks in a group.
BLOCK_TOKENS, PART_TOKENS, GROUP_WORDS = 1_000_000, 5_000_000, 3_000_000
#: The end of a text as a token, its begin as a context.
END = np.uint64(0x1F0E_D0C0_FFEE_0001)
LOW = (1 << 32) - 1
BURN_IN, SAMPLES = 6, 4
NONE = np.iinfo(np.uint32).max

BLOCKS = "block bigint, doc_ids array<bigint>, held binary, starts binary, words binary, train binary, low binary, high binary"
KINDS = {"int": pa.int32(), "bigint": pa.int64(), "double": pa.float64(), "binary": pa.binary(), "array<bigint>": pa.list_(pa.int64()), "array<double>": pa.list_(pa.float64())}


def _names(schema: str) -> list[str]:
    return [c.split()[0] for c in schema.split(", ")]


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [()] * len(_names(schema))
    return pa.RecordBatch.from_arrays([pa.array(c, KINDS[f.split()[1]]) for c, f in zip(columns, schema.split(", "))], _names(schema))


def _frame(rows: list[tuple], schema: str) -> pd.DataFrame:
    return pd.DataFrame(rows, columns=_names(schema))


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in slices(batches, 1):
        yield {name: batch.column(j)[0].as_py() for j, name in enumerate(batch.schema.names)}


def _join(column, kind: type) -> np.ndarray:
    return np.concatenate([unpack(x, kind) for x in column]) if len(column) else np.zeros(0, kind)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    base, made = TaskContext.get().partitionId() << 32, 0
    for batch in slices(batches, 2000):
        ids, held, texts = batch.column(0).to_pylist(), batch.column(1).to_numpy(zero_copy_only=False).astype(np.uint8), batch.column(2).to_pylist()
        at = 0
        while at < len(texts):
            size, upto = 0, at
            while upto < len(texts) and (size == 0 or size + len(texts[upto] or "") < 6 * BLOCK_TOKENS):
                size += len(texts[upto] or "")
                upto += 1
            numbers, starts = word_numbers([t or "" for t in texts[at:upto]])
            ends = starts[1:] + np.arange(len(starts) - 1)
            tokens = np.empty(len(numbers) + len(ends), np.uint64)
            is_end = np.zeros(len(tokens), bool)
            is_end[ends] = True
            tokens[is_end], tokens[~is_end] = END, numbers
            starts = np.r_[0, ends + 1].astype(np.int64)
            trained = np.repeat(held[at:upto] == 0, np.diff(starts))
            words, place, count = np.unique(tokens, return_inverse=True, return_counts=True)
            train = np.bincount(place[trained], minlength=len(words))
            order = np.argsort(-count, kind="stable")
            rank = np.empty(len(order), np.uint32)
            rank[order] = np.arange(len(order), dtype=np.uint32)
            local = rank[place]
            row = (base + made, ids[at:upto], held[at:upto].tobytes(), starts.tobytes(), words[order].tobytes(), pack(train[order].astype(np.uint32)), pack((local & 0xFFFF).astype(np.uint16)), pack((local >> 16).astype(np.uint16)))
            yield _batch([row], BLOCKS)
            at, made = upto, made + 1


@dataclass
class Block:
    """A token block: tokens as local word numbers, the texts they make up, and which texts are held out."""

    tokens: np.ndarray
    starts: np.ndarray
    held: np.ndarray

    @classmethod
    def read(cls, row) -> Block:
        low, high = unpack(row["low"], np.uint16), unpack(row["high"], np.uint16)
        return cls(low.astype(np.int64) | high.astype(np.int64) << 16, np.frombuffer(row["starts"], np.int64), np.frombuffer(row["held"], np.uint8) > 0)

    def pairs(self) -> tuple[np.ndarray, np.ndarray]:
        """Distinct (context, word) pairs as context << 32 | word, sorted, and each token's place in them. A token's
        context is the token before it, which at the begin of a text is an end (for the first one the block's last)."""
        return np.unique(np.roll(self.tokens, 1) << 32 | self.tokens, return_inverse=True)


@dataclass
class Grid:
    """How words are dealt: group = hash modulo groups, row or column of the grid = group modulo side."""

    side: int
    sizes: np.ndarray  # training words of each group

    def groups(self, line: int) -> range:
        return range(line, len(self.sizes), self.side)

    @property
    def offsets(self) -> np.ndarray:
        """Where in its row or column a group's words begin."""
        out = np.zeros(len(self.sizes), np.int64)
        for line in range(min(self.side, len(out))):
            out[line :: self.side] = np.cumsum(self.sizes[line :: self.side]) - self.sizes[line :: self.side]
        return out

    def pieces(self, line: int, values: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        """A line's values by group."""
        at = 0
        for group in self.groups(line):
            yield group, values[at : at + self.sizes[group]]
            at += self.sizes[group]

    def width(self, line: int) -> int:
        return int(self.sizes[line :: self.side].sum())

    def placed(self, group: np.ndarray, rank: np.ndarray, pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of a block's pairs those of two training words, in order of their parts: their places in `pairs`, their parts,
        and their keys (context << 32 | word, numbered within row and column)."""
        line, at = group % self.side, self.offsets[group] + rank - 1
        context, word = pairs >> 32, pairs & LOW
        own = np.flatnonzero((rank[context] > 0) & (rank[word] > 0))
        part = line[context[own]] * self.side + line[word[own]]
        key = at[context[own]] << 32 | at[word[own]]
        order = np.lexsort((key, part))
        return own[order], part[order], key[order]


NAMES = "owner int, block bigint, words binary, train binary"
NUMBERS = "owner int, block bigint, rank binary, counts binary, size bigint, total bigint"


def _name(batches: Iterator[pa.RecordBatch], groups: int) -> Iterator[pa.RecordBatch]:
    """A block's words and training counts for each group."""
    for row in _rows(batches):
        words, train = np.frombuffer(row["words"], np.uint64), unpack(row["train"], np.uint32)
        group = (words % np.uint64(groups)).astype(np.int64)
        order = np.argsort(group, kind="stable")
        cut = np.searchsorted(group[order], np.arange(groups + 1))
        for g, (a, b) in enumerate(zip(cut, cut[1:])):
            if a < b:
                yield _batch([(g, row["block"], words[order[a:b]].tobytes(), pack(train[order[a:b]]))], NAMES)


def _number(group: pd.DataFrame) -> pd.DataFrame:
    """A group's training words numbered from 1 by falling count (0: not in training): for each block the numbers and
    counts of its words in order, and in a row without a block the counts by number."""
    owner = int(group["owner"].iloc[0])
    words, place = np.unique(np.frombuffer(b"".join(group["words"]), np.uint64), return_inverse=True)
    counts = np.bincount(place, weights=_join(group["train"], np.uint32), minlength=len(words)).astype(np.uint64)
    order = np.argsort(-counts.astype(np.int64), kind="stable")
    known = int((counts > 0).sum())
    rank = np.empty(len(words), np.uint32)
    rank[order] = np.arange(1, len(words) + 1)
    rank[counts == 0] = 0
    cut = np.cumsum([0, *(len(w) // 8 for w in group["words"])])
    rows = [(owner, int(b), pack(rank[place[x:y]]), pack(counts[place[x:y]]), 0, 0) for b, x, y in zip(group["block"], cut, cut[1:])]
    rows.append((owner, None, b"", pack(counts[order[:known]]), known, int(counts.sum())))
    return _frame(rows, NUMBERS).astype({"block": "Int64"})


#: Numbered blocks (kind 0) and what they ask of each part (kind 1: contexts, words and training counts of its pairs).
NUMBERED = "kind int, part int, block bigint, doc_ids array<bigint>, held binary, starts binary, low binary, high binary, a binary, b binary, c binary"


def _ask(block: pd.DataFrame, numbers: pd.DataFrame, grid: Grid) -> pd.DataFrame:
    out, groups = [], len(grid.sizes)
    numbers = numbers.sort_values("owner", kind="stable")
    for row in block.to_dict("records"):
        group = (np.frombuffer(row["words"], np.uint64) % np.uint64(groups)).astype(np.int64)
        order = np.argsort(group, kind="stable")
        rank, counts = np.zeros(len(group), np.int64), np.zeros(len(group), np.uint64)
        rank[order], counts[order] = _join(numbers["rank"], np.uint32), _join(numbers["counts"], np.uint64)
        tokens = Block.read(row)
        pairs, place = tokens.pairs()
        n = np.bincount(place[np.repeat(~tokens.held, np.diff(tokens.starts))], minlength=len(pairs))
        own, part, key = grid.placed(group, rank, pairs)
        edges = np.flatnonzero(np.diff(part, prepend=-1, append=-1)).tolist()
        for a, b in zip(edges, edges[1:]):
            context = np.diff(key[a:b] >> 32, prepend=0).astype(np.uint32)
            out.append((1, int(part[a]), row["block"], None, None, None, None, None, pack(context), pack((key[a:b] & LOW).astype(np.uint32)), pack(n[own[a:b]].astype(np.uint32))))
        out.append((0, 0, row["block"], list(row["doc_ids"]), row["held"], row["starts"], row["low"], row["high"], pack(group.astype(np.uint32)), pack(rank.astype(np.uint32)), pack(counts)))
    return _frame(out, NUMBERED)


PARTS = "part int, context binary, word binary, n binary, blocks binary, places binary"


def _keys(context: bytes, word: bytes) -> np.ndarray:
    return np.cumsum(unpack(context, np.uint32).astype(np.int64)) << 32 | unpack(word, np.uint32)


def _part(group: pd.DataFrame) -> pd.DataFrame:
    """One part: its cells with training customers, and where in them the pairs of each block are (NONE: in no training
    text)."""
    group = group.sort_values("block", kind="stable")
    asked = [_keys(a, b) for a, b in zip(group["a"], group["b"])]
    cells, place = np.unique(np.concatenate(asked), return_inverse=True)
    n = np.bincount(place, weights=_join(group["c"], np.uint32), minlength=len(cells)).astype(np.uint32)
    seen = n > 0
    number = np.where(seen, np.cumsum(seen) - 1, NONE).astype(np.uint32)
    cells = cells[seen]
    blocks = np.array([[b, len(k)] for b, k in zip(group["block"], asked)], np.int64)
    return _frame([(int(group["part"].iloc[0]), pack(np.diff(cells >> 32, prepend=0).astype(np.uint32)), pack((cells & LOW).astype(np.uint32)), pack(n[seen]), pack(blocks), pack(number[place]))], PARTS)


@dataclass
class Rooms:
    """What all parts know: numbers."""

    words: int  # distinct training words
    tokens: int
    discount: float
    strength: float
    root_discount: float
    root_strength: float
    root_customers: float = 0.0
    masses: float = 1.0  # sum of the root's gamma numbers in force

    @property
    def unknown(self) -> float:
        return (self.root_strength + self.root_discount * self.words) / (self.root_strength + self.root_customers)

    def root(self, customers: np.ndarray) -> np.ndarray:
        """The root's probability of words with so many customers there (0: the unknown word)."""
        return np.where(customers > 0, (customers - self.root_discount) / (self.root_strength + self.root_customers), self.unknown)

    @property
    def trials(self) -> list[Rooms]:
        """The present values, then each discount and strength a step lower and higher, for the Newton steps."""
        out = [self]
        for name, low, high in (("discount", *_around(self.discount)), ("strength", self.strength / 2, self.strength * 2), ("root_discount", *_around(self.root_discount))):
            out += [replace(self, **{name: low}), replace(self, **{name: high})]
        return out


def _around(discount: float) -> tuple[float, float]:
    step = min(0.02, (1 - discount) / 3, discount / 3)
    return discount - step, discount + step


def _likely_contexts(rooms: Rooms, customers: np.ndarray, tables: np.ndarray) -> float:
    """Log-likelihood of how many tables contexts' restaurants have, but for their dishes."""
    d, s = rooms.discount, rooms.strength
    return float(((tables - 1) * np.log(d) + log_gamma(s / d + tables) - log_gamma(s / d + 1) - log_gamma(s + customers) + log_gamma(s + 1)).sum())


def _likely_root(rooms: Rooms, spread: float) -> float:
    """Log-likelihood of the root's seating; `spread` is the words' share of it."""
    d, s, n = rooms.root_discount, rooms.root_strength, rooms.words
    return float((n - 1) * np.log(d) + log_gamma(s / d + n) - log_gamma(s / d + 1) - log_gamma(s + rooms.root_customers) + log_gamma(s + 1) + spread)


def _top(low: float, mid: float, high: float, most: float = 3.0) -> float:
    """How many steps from the middle a parabola through three values has its top, at most `most`."""
    bend = low - 2 * mid + high
    slope = (high - low) / 2
    if bend >= 0:
        return most * float(np.sign(slope))
    return float(np.clip(-slope / bend, -most, most))


def refitted(rooms: Rooms, cells: list[float], contexts: list[float], spread: list[float], customers: float) -> Rooms:
    """Rooms with discounts and strengths a Newton step nearer to the most likely ones of the present seating.

    `cells` has the cells' log-likelihood for the discount and a step around it, `contexts` that of contexts' restaurants
    for the discount, around it, and around the strength, `spread` the root's share of words for its discount and around.
    """
    now = replace(rooms, root_customers=customers)
    trials = now.trials
    around = [cells[i] + contexts[i] for i in range(3)]
    discount = now.discount + _top(around[1], around[0], around[2]) * (trials[2].discount - now.discount)
    strength = now.strength * 2 ** _top(contexts[3], contexts[0], contexts[4])
    root = [_likely_root(t, s) for t, s in zip((trials[0], trials[5], trials[6]), spread)]
    root_discount = now.root_discount + _top(root[1], root[0], root[2]) * (trials[6].root_discount - now.root_discount)
    around = [_likely_root(replace(now, root_strength=now.root_strength * f), spread[0]) for f in (0.5, 1, 2)]
    root_strength = now.root_strength * 2 ** _top(*around)
    return replace(now, discount=float(np.clip(discount, 0.02, 0.98)), strength=float(np.clip(strength, 0.01, 1e4)), root_discount=float(np.clip(root_discount, 0.02, 0.98)), root_strength=float(np.clip(root_strength, 0.01, 1e9)))


def readiness(tables: np.ndarray, group: int, sweep: int, rooms: Rooms) -> np.ndarray:
    """The contexts' gamma numbers, the same wherever a group's contexts with these tables are looked at."""
    return np.random.default_rng((sweep, group, 0)).standard_gamma(rooms.strength / rooms.discount + tables)


def masses(customers: np.ndarray, group: int, sweep: int, rooms: Rooms) -> np.ndarray:
    """The gamma numbers of the root's words, likewise."""
    return np.random.default_rng((sweep, group, 1)).standard_gamma(customers - rooms.root_discount)


#: Tables told to a group (owner >= 0), drawn tables (owner -1) and log-likelihoods (owner -2) of a part.
TOLD = "part int, owner int, as_word int, tables binary, stats array<double>"
TOTALS = "owner int, as_context binary, as_word binary, stats array<double>"


def _told(part: int, context: np.ndarray, word: np.ndarray, tables: np.ndarray, grid: Grid) -> Iterator[tuple]:
    for as_word, line, at in ((0, part // grid.side, context), (1, part % grid.side, word)):
        for group, values in grid.pieces(line, np.bincount(at, weights=tables, minlength=grid.width(line)).astype(np.uint64)):
            yield part, group, as_word, pack(values), None


def _first(batches: Iterator[pa.RecordBatch], grid: Grid) -> Iterator[pa.RecordBatch]:
    """One table a cell; how many cells have one and two customers."""
    for row in _rows(batches):
        key, n = _keys(row["context"], row["word"]), unpack(row["n"], np.uint32)
        out = list(_told(row["part"], key >> 32, key & LOW, np.ones(len(key)), grid))
        yield _batch([*out, (row["part"], -2, 0, b"", [float((n == 1).sum()), float((n == 2).sum()), 0.0])], TOLD)


def _sweep(part: pd.DataFrame, replies: pd.DataFrame, grid: Grid, rooms: Rooms, sweep: int, burning: bool) -> pd.DataFrame:
    out = []
    for row in part.to_dict("records"):
        key, n = _keys(row["context"], row["word"]), unpack(row["n"], np.uint32).astype(np.int64)
        lines = []
        for as_word, drawn in ((0, readiness), (1, masses)):
            own = replies[replies["as_word"] == as_word].sort_values("owner")
            lines.append(np.concatenate([np.zeros(0), *(drawn(unpack(t, np.uint64).astype(float), int(g), sweep, rooms) for g, t in zip(own["owner"], own["tables"]))]))
        context, word = key >> 32, key & LOW
        opens = rooms.discount * lines[0][context] * (lines[1][word] / rooms.masses)
        tables = draw(n, opens, rooms.discount, np.random.default_rng((sweep, int(row["part"]), 2)))
        out += _told(int(row["part"]), context, word, tables, grid)
        if burning:
            kinds, times = np.unique(n << 32 | tables, return_counts=True)
            stats = [float((log_numbers(kinds >> 32, kinds & LOW, t.discount) * times).sum()) for t in rooms.trials[:3]]
            out.append((int(row["part"]), -2, 0, b"", stats))
        else:
            out.append((int(row["part"]), -1, 0, pack(tables.astype(np.uint32)), None))
    return _frame(out, TOLD)


def _total(told: pd.DataFrame, names: pd.DataFrame, rooms: Rooms) -> pd.DataFrame:
    """A group's tables as contexts and as words, and the log-likelihoods that the Newton steps compare."""
    out = []
    for owner, counts in zip(names["owner"], names["counts"]):
        counts = unpack(counts, np.uint64).astype(float)
        tables = []
        for as_word in (0, 1):
            sums = np.zeros(len(counts), np.uint64)
            for t in told["tables"][told["as_word"] == as_word]:
                sums += unpack(t, np.uint64)
            tables.append(sums)
        context, word = tables[0].astype(float), tables[1].astype(float)
        trials = rooms.trials
        stats = [_likely_contexts(t, counts, context) for t in trials[:5]] if len(counts) else [0.0] * 5
        stats += [float((log_gamma(word - t.root_discount) - log_gamma(1 - t.root_discount)).sum()) for t in (trials[0], trials[5], trials[6])]
        stats += [float(word.sum()), float((word == 1).sum()), float((word == 2).sum())]
        out.append((int(owner), pack(tables[0]), pack(tables[1]), stats))
    return _frame(out, TOTALS)


def _mass(batches: Iterator[pa.RecordBatch], rooms: Rooms, sweep: int) -> Iterator[pa.RecordBatch]:
    """The sum of each group's masses as a sweep draws them."""
    for row in _rows(batches):
        yield _batch([(float(masses(unpack(row["as_word"], np.uint64).astype(float), row["owner"], sweep, rooms).sum()),)], "a double")


ANSWER = "block bigint, kind int, owner int, a binary, b binary"


def _cell_answers(part: pd.DataFrame, drawn: pd.DataFrame) -> pd.DataFrame:
    """For each block in order its pairs' customers and tables, summed over the samples."""
    out = []
    for row in part.to_dict("records"):
        n = np.r_[unpack(row["n"], np.uint32), np.uint32(0)]
        tables = np.zeros(len(n), np.uint32)
        for t in drawn["tables"]:
            tables[:-1] += unpack(t, np.uint32)
        place, at = np.minimum(unpack(row["places"], np.uint32), len(n) - 1), 0
        for block, size in unpack(row["blocks"], np.int64).reshape(-1, 2):
            own = place[at : at + size]
            out.append((int(block), 0, int(row["part"]), pack(n[own]), pack(tables[own])))
            at += size
    return _frame(out, ANSWER)


def _word_answers(numbers: pd.DataFrame, totals: pd.DataFrame) -> pd.DataFrame:
    """For each block in order its words' tables as contexts and as words, sample after sample."""
    out, totals = [], totals.sort_values("sweep")
    states = [[np.r_[np.uint64(0), unpack(t, np.uint64)] for t in totals[c]] for c in ("as_context", "as_word")]
    for owner, block, rank in zip(numbers["owner"], numbers["block"], numbers["rank"]):
        rank = unpack(rank, np.uint32)
        out.append((int(block), 1, int(owner), *(pack(np.stack([t[rank] for t in state], 1)) for state in states)))
    return _frame(out, ANSWER)


SCORED = "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, base_score double, score double"


def _score(blocks: pd.DataFrame, answers: pd.DataFrame, grid: Grid, samples: list[Rooms]) -> pd.DataFrame:
    out, rooms = [], samples[0]
    cells, words = (answers[answers["kind"] == k].sort_values("owner", kind="stable") for k in (0, 1))
    for row in blocks.to_dict("records"):
        block, group, rank, counts = Block.read(row), unpack(row["a"], np.uint32).astype(np.int64), unpack(row["b"], np.uint32).astype(np.int64), unpack(row["c"], np.uint64).astype(float)
        pairs, place = block.pairs()
        own, _, _ = grid.placed(group, rank, pairs)
        n, tables = np.zeros(len(pairs)), np.zeros(len(pairs))
        n[own], tables[own] = _join(cells["a"], np.uint32), _join(cells["b"], np.uint32)
        by_group = np.argsort(group, kind="stable")
        as_context, as_word = np.zeros((2, len(group), len(samples)))
        for state, column in ((as_context, "a"), (as_word, "b")):
            state[by_group] = _join(words[column], np.uint64).reshape(-1, len(samples))
        context, word = pairs >> 32, pairs & LOW
        p = n - rooms.discount * tables / len(samples)
        for i, sample in enumerate(samples):
            p += (sample.strength + sample.discount * as_context[context, i]) * sample.root(as_word[word, i]) / len(samples)
        log_p = np.log10(p / (rooms.strength + counts[context]))[place]
        base = np.log10((counts + 0.5) / (rooms.tokens + 0.5 * (rooms.words + 1)))[block.tokens]
        first, size = block.starts[:-1], np.diff(block.starts)
        known = np.add.reduceat((counts > 0)[block.tokens].astype(np.int64), first)
        out.append(pd.DataFrame({"doc_id": pd.array(list(row["doc_ids"]), "Int64"), "held_out": block.held, "n_tokens": size, "n_known": known, "base_score": np.add.reduceat(base, first), "score": np.add.reduceat(log_p, first)}))
    return pd.concat(out) if out else _frame([], SCORED)


def _sums(rows: DataFrame, size: int) -> list[float]:
    """The sums of an array column of so many numbers, over all rows."""
    found = rows.agg(*(F.sum(F.get("stats", F.lit(i))).alias(f"s{i}") for i in range(size))).first()
    return [float(x or 0.0) for x in found]


def _discount(ones: float, twos: float) -> float:
    return float(np.clip(ones / (ones + 2 * twos), 0.1, 0.95)) if ones else 0.5


def _sizes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Training tokens of each block."""
    for row in _rows(batches):
        yield _batch([(int(np.diff(np.frombuffer(row["starts"], np.int64))[np.frombuffer(row["held"], np.uint8) == 0].sum()),)], "n bigint")


class Training:
    """The model's tables while it is trained, and the state of each sampling sweep."""

    def __init__(self, blocks: DataFrame):
        words = blocks.agg(F.sum(F.length("words") / 8)).first()[0] or 0
        tokens = blocks.select("held", "starts").mapInArrow(_sizes, "n bigint").agg(F.sum("n")).first()[0] or 0
        self.side = max(1, math.ceil(math.sqrt(tokens / PART_TOKENS)))
        groups = self.side * max(1, math.ceil(words / (self.side * GROUP_WORDS)))
        named = blocks.select("block", "words", "train").mapInArrow(lambda b: _name(b, groups), NAMES)
        self.numbers = materialise(named.groupBy("owner").applyInPandas(_number, NUMBERS), "lm-numbers")
        self.names = self.numbers.where("block is null").select("owner", "counts")
        self.per_block = self.numbers.where("block is not null").select("owner", "block", "rank", "counts")
        found, sizes = self.numbers.where("block is null").select("owner", "size", "total").collect(), np.zeros(groups, np.int64)
        for r in found:
            sizes[r.owner] = r["size"]
        self.grid = grid = Grid(self.side, sizes)
        self.rooms = Rooms(int(sizes.sum()), sum(int(r.total) for r in found), 0.5, 0.5, 0.5, 10.0)
        asked = blocks.groupBy("block").cogroup(self.per_block.groupBy("block")).applyInPandas(lambda b, n: _ask(b, n, grid), NUMBERED)
        self.numbered = materialise(asked, "lm-numbered", by="kind")
        pairs = self.numbered.where("kind = 1").select("part", "block", "a", "b", "c")
        self.parts = materialise(pairs.groupBy("part").applyInPandas(_part, PARTS), "lm-parts")
        self.cells = self.parts.select("part", "context", "word", "n")
        self.samples: list[Rooms] = []
        self.drawn: list[DataFrame] = []
        self.totals: list[DataFrame] = []
        told = materialise(self.cells.mapInArrow(lambda b: _first(b, grid), TOLD), "lm-told")
        ones, twos, _ = _sums(told.where("owner = -2"), 3)
        self.rooms.discount = _discount(ones, twos)
        self.now, stats = self._totals(told)
        self.rooms = replace(self.rooms, root_discount=_discount(stats[9], stats[10]), root_customers=stats[8])
        release(told)

    def _totals(self, told: DataFrame) -> tuple[DataFrame, list[float]]:
        rooms, own = self.rooms, told.where("owner >= 0").select("owner", "as_word", "tables")
        totals = materialise(own.groupBy("owner").cogroup(self.names.groupBy("owner")).applyInPandas(lambda t, n: _total(t, n, rooms), TOTALS), "lm-totals")
        return totals, _sums(totals, 11)

    def sweep(self, number: int, burning: bool) -> None:
        """Draws all tables anew; refits while burning in, else keeps the seating for the average."""
        rooms, grid, side = self.rooms, self.grid, self.side
        drawn = self.now.select("owner", "as_word").mapInArrow(lambda b: _mass(b, rooms, number), "a double").agg(F.sum("a")).first()[0]
        rest = np.random.default_rng((number, 3)).standard_gamma(rooms.root_strength + rooms.root_discount * rooms.words)
        rooms = replace(rooms, masses=float(drawn or 0.0) + rest)
        line, along = F.col("owner") % side, F.sequence(F.lit(0), F.lit(side - 1))
        as_context = self.now.select(F.explode(F.transform(along, lambda j: line * side + j)).alias("part"), "owner", F.lit(0).alias("as_word"), F.col("as_context").alias("tables"))
        as_word = self.now.select(F.explode(F.transform(along, lambda i: i * side + line)).alias("part"), "owner", F.lit(1).alias("as_word"), F.col("as_word").alias("tables"))
        replies = as_context.unionByName(as_word)
        swept = self.cells.groupBy("part").cogroup(replies.groupBy("part")).applyInPandas(lambda p, r: _sweep(p, r, grid, rooms, number, burning), TOLD)
        told, before = materialise(swept, "lm-told"), self.now
        self.now, stats = self._totals(told)
        self.rooms = replace(rooms, root_customers=stats[8])
        if burning:
            self.rooms = refitted(self.rooms, _sums(told.where("owner = -2"), 3), stats[:5], stats[5:8], stats[8])
            release(told)
        else:
            self.samples.append(self.rooms)
            self.drawn.append(told)
            self.totals.append(self.now)
        if all(before is not t for t in self.totals):
            release(before)

    def answers(self) -> DataFrame:
        """What each block needs to know of its pairs and words, from all samples."""
        drawn = self.drawn[0].where("owner = -1").select("part", "tables")
        for more in self.drawn[1:]:
            drawn = drawn.union(more.where("owner = -1").select("part", "tables"))
        states = [t.select("owner", F.lit(i).alias("sweep"), "as_context", "as_word") for i, t in enumerate(self.totals)]
        totals = states[0]
        for more in states[1:]:
            totals = totals.union(more)
        cells = self.parts.select("part", "n", "blocks", "places").groupBy("part").cogroup(drawn.groupBy("part")).applyInPandas(_cell_answers, ANSWER)
        words = self.per_block.select("owner", "block", "rank").groupBy("owner").cogroup(totals.groupBy("owner")).applyInPandas(_word_answers, ANSWER)
        return cells.union(words)

    def release(self) -> None:
        release(self.numbers, self.numbered, self.parts, self.now, *self.drawn, *self.totals[:-1])


def score(docs: DataFrame, parts: int = 5, part: int = 1, burn_in: int = BURN_IN, samples: int = SAMPLES) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every whole text.

    Texts whose crc32(doc_id as text) leaves `part` on division by `parts` are held out; the model learns from all
    others. A null text counts as empty: one token, the end. Rows that repeat are learnt and scored as often as they
    stand there; a null doc_id counts as empty text for the split. If no text is left to learn from, every word is
    unknown: base and score are those of a uniform choice among one. An empty table gives none; other columns are left
    out whatever their names. There are no ties to break: a word's number decides its place and equal texts score alike
    but for the text before them in their block, whose end is always their context.
    """
    rows = pick(docs, doc_id="bigint", text="string")
    rows = rows.select("doc_id", held_out(F.col("doc_id"), parts, part).alias("held"), "text")
    blocks = materialise(rows.mapInArrow(_blocks, BLOCKS), "lm-blocks")
    model = Training(blocks)
    release(blocks)
    for i in range(burn_in + samples):
        model.sweep(i + 1, i < burn_in)
    grid, taken = model.grid, model.samples
    numbered = model.numbered.where("kind = 0").select("block", "doc_ids", "held", "starts", "low", "high", "a", "b", "c")
    scored = numbered.groupBy("block").cogroup(model.answers().groupBy("block")).applyInPandas(lambda b, a: _score(b, a, grid, taken), SCORED)
    out = materialise(scored, "lm-scores")
    model.release()
    return out.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(model.rooms.tokens).cast("bigint").alias("train_tokens"), "base_score", "score")


def perplexity(scores: DataFrame) -> DataFrame:
    """held_out, n_tokens and perplexity a token of the model and of the base, from `score`'s rows; one row for each kind
    of text there is, so none for an empty table. Other columns do no harm."""
    rows = pick(scores, held_out="boolean", n_tokens="bigint", score="double", base_score="double")
    total = rows.groupBy("held_out").agg(*(F.sum(c).alias(c) for c in ("n_tokens", "score", "base_score")))
    power = lambda c: F.pow(F.lit(10.0), -F.col(c) / F.col("n_tokens"))
    return total.select("held_out", "n_tokens", power("score").alias("perplexity"), power("base_score").alias("base_perplexity"))
