"""Token counts from pre-token frequencies, without materialising ids.

A tokenizer of this kind takes its added tokens (special strings) out of the text, one token each, splits the normalised
rest into pre-tokens and never merges across them. So a text's count is the number of its added tokens and the sum, over
its distinct pre-tokens, of frequency times pieces.

1. Blocks of rows become per-document frequencies of pre-tokens numbered within the block, and the list of those.
2. The lists are dealt to buckets by hash. A bucket has all that the corpus asks about a pre-token, counts its pieces once
   by the library's model, and replies to each block with one small number for each pre-token it sent.
3. Blocks join the replies to their frequencies and sum.

A block sends a pre-token once however often it occurs, and buckets grow in number with what is sent, so no pre-token is
hot. Lists and frequencies travel packed.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter, defaultdict
from collections.abc import Callable, Iterator
from functools import cache
from itertools import accumulate

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer, pre_tokenizers
from trovespark.frames import materialise, pick, release, slices
from trovespark.llm.packed import pack, unpack

#: The splitting pattern of lower-casing word tokenizers, for which texts of Latin letters have a faster way.
WORD_FORM = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: Below this code point texts are in normal form C and split alike in every Unicode version.
PLAIN_BELOW = 0x250
#: Rows in a block and pre-tokens sent to a bucket, about.
BLOCK_ROWS, BUCKET_SIZE = 2000, 2_000_000


def _plain_split() -> Callable[[str], list[str]]:
    chars = [chr(i) for i in range(PLAIN_BELOW)]
    kinds = {k: "".join(re.escape(c) for c in chars if regex.match(p, c)) for k, p in (("L", r"\p{L}"), ("N", r"\p{N}"), ("S", r"\s"))}
    return re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[{kinds['L']}]+|[{kinds['N']}]|[^{kinds['S']}{kinds['L']}{kinds['N']}]+").findall


class Splitter:
    """A tokenizer file's rules for cutting texts, and its model for counting the pieces of a pre-token."""

    def __init__(self, path: str):
        self.library = Tokenizer.from_file(path)
        added = self.library.get_added_tokens_decoder().values()
        longest_first = sorted((t.content for t in added), key=len, reverse=True)
        self.added = re.compile("|".join(map(re.escape, longest_first))) if longest_first else None
        #: Whether added tokens are found in the text as it is; those with other rules are left to the library.
        self.literal = not any(t.normalized or t.single_word or t.lstrip or t.rstrip for t in added)
        self.bytelevel = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        split = self.library.pre_tokenizer
        self.plain = _plain_split() if WORD_FORM.replace("\\", "\\\\") in open(path, encoding="utf-8").read() else None
        self.outside = re.compile(f"[^\\x00-\\u{PLAIN_BELOW - 1:04x}]").search
        self.control = re.compile(r"[\x00-\x08\x0e-\x1f\x7f]").search
        self.normalise = self.library.normalizer.normalize_str if self.library.normalizer else str
        self.split = lambda text: [piece for piece, _ in split.pre_tokenize_str(text)]

    def pieces(self, pre_token: str) -> int:
        return len(self.library.model.tokenize(pre_token))

    def frequencies(self, text: str) -> Counter:
        """The text's pre-tokens, as the model takes them, with their frequencies."""
        if self.plain and not self.outside(text) and not self.outside(lower := text.lower()):
            plain = Counter(self.plain(lower))
            if text.isascii() and not self.control(text):
                return plain
            return Counter({self.as_bytes(word): n for word, n in plain.items()})
        return Counter(self.split(self.normalise(text)))

    @cache
    def as_bytes(self, word: str) -> str:
        return word if word.isascii() and word.isprintable() else "".join(piece for piece, _ in self.bytelevel.pre_tokenize_str(word))

    def cut(self, text: str) -> tuple[int, Counter]:
        """The number of added tokens in a text, and the frequencies of the pre-tokens in the rest. Added tokens with
        rules of their own for what is around them leave the whole text to the library."""
        if not self.literal:
            return len(self.library.encode(text, add_special_tokens=False)), Counter()
        if not self.added or not self.added.search(text):
            return 0, self.frequencies(text)
        rest, frequencies = self.added.split(text), Counter()
        for part in filter(None, rest):
            frequencies.update(self.frequencies(part))
        return len(rest) - 1, frequencies

    def count(self, text: str) -> int:
        """A single text's count, by the same parts."""
        added, frequencies = self.cut(text)
        return added + sum(n * self.pieces(pre_token) for pre_token, n in frequencies.items())


@cache
def _splitter(path: str) -> Splitter:
    return Splitter(path)


BLOCKS = "block bigint, doc_ids array<bigint>, bytes binary, added binary, distinct binary, numbers binary, frequencies binary, keys binary, lengths binary, strings binary"
ASKS = "bucket int, block bigint, lengths binary, strings binary"
REPLIES = "block bigint, bucket int, pieces binary"
COUNTS = "doc_id bigint, n_bytes bigint, n_tokens bigint, over_limit boolean"


def _blocks(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    """Each block's documents with their frequencies, and its pre-tokens in order of their hashes."""
    splitter, block = _splitter(path), TaskContext.get().partitionId() << 32
    for batch in slices(batches, BLOCK_ROWS):
        number: defaultdict[str, int] = defaultdict()
        number.default_factory = number.__len__
        sizes, added, distinct, numbers, frequencies = [], [], [], [], []
        for value in batch.column(1):
            text = value.as_py() or ""
            special, found = splitter.cut(text)
            sizes.append(len(text.encode()))
            added.append(special)
            distinct.append(len(found))
            numbers.append(np.fromiter(map(number.__getitem__, found), np.uint32, len(found)))
            frequencies.append(np.fromiter(found.values(), np.uint32, len(found)))
        strings = [s.encode() for s in number]
        keys = np.fromiter(map(zlib.crc32, strings), np.uint32, len(strings))
        order = np.argsort(keys, kind="stable")
        place = np.empty(len(order), np.uint32)
        place[order] = np.arange(len(order), dtype=np.uint32)
        numbers = place[np.concatenate(numbers)] if strings else np.zeros(0, np.uint32)
        ordered = [strings[i] for i in order.tolist()]
        row = (
            block, batch.column(0).to_pylist(), pack(np.array(sizes, np.int64)), pack(np.array(added, np.uint32)), pack(np.array(distinct, np.uint32)), pack(numbers),
            pack(np.concatenate(frequencies)), pack(np.diff(keys[order], prepend=np.uint32(0))), pack(np.array([len(s) for s in ordered], np.uint32)), pack(np.frombuffer(b"".join(ordered), np.uint8)),
        )
        kinds = [pa.int64(), pa.list_(pa.int64()), *[pa.binary()] * 8]
        yield pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, kinds)], [c.split()[0] for c in BLOCKS.split(", ")])
        block += 1


def _buckets(keys: np.ndarray, buckets: int) -> np.ndarray:
    """Where in ascending keys each bucket's share of all keys begins (one entry more)."""
    edges = np.array([-(-(b << 32) // buckets) for b in range(buckets + 1)], np.uint64)
    return np.searchsorted(keys.astype(np.uint64), edges)


def _asks(batches: Iterator[pa.RecordBatch], buckets: int) -> Iterator[pa.RecordBatch]:
    """A block's pre-tokens for each bucket."""
    for batch in slices(batches, 1):
        block, keys, lengths, strings = (batch.column(c)[0].as_py() for c in ("block", "keys", "lengths", "strings"))
        cut = _buckets(np.cumsum(unpack(keys, np.uint32), dtype=np.uint64), buckets)
        lengths, strings = unpack(lengths, np.uint32), unpack(strings, np.uint8)
        at = np.r_[0, np.cumsum(lengths, dtype=np.int64)]
        own = [(b, block, pack(lengths[x:y]), pack(strings[at[x] : at[y]])) for b, (x, y) in enumerate(zip(cut, cut[1:])) if x < y]
        columns = list(zip(*own)) if own else [()] * 4
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, (pa.int32(), pa.int64(), pa.binary(), pa.binary()))], [c.split()[0] for c in ASKS.split(", ")])


def _pieces(group: pd.DataFrame, path: str) -> pd.DataFrame:
    """A bucket's replies: each distinct pre-token is counted once."""
    splitter, known, rows = _splitter(path), {}, []
    for bucket, block, lengths, strings in zip(group["bucket"], group["block"], group["lengths"], group["strings"]):
        data, at = unpack(strings, np.uint8).tobytes(), [0, *accumulate(unpack(lengths, np.uint32).tolist())]
        out = np.empty(len(at) - 1, np.uint32)
        for i, (a, b) in enumerate(zip(at, at[1:])):
            n = known.get(s := data[a:b])
            if n is None:
                n = known[s] = splitter.pieces(s.decode())
            out[i] = n
        rows.append((int(block), int(bucket), pack(out)))
    return pd.DataFrame(rows, columns=[c.split()[0] for c in REPLIES.split(", ")])


def _sum(blocks: pd.DataFrame, replies: pd.DataFrame, limit: int) -> pd.DataFrame:
    replies, out = replies.sort_values("bucket", kind="stable"), []
    pieces = np.concatenate([np.zeros(0, np.uint32), *(unpack(p, np.uint32) for p in replies["pieces"])]).astype(np.int64)
    for row in blocks.to_dict("records"):
        each = unpack(row["frequencies"], np.uint32) * pieces[unpack(row["numbers"], np.uint32)]
        upto = np.r_[0, np.cumsum(each)][np.r_[0, np.cumsum(unpack(row["distinct"], np.uint32), dtype=np.int64)]]
        tokens = unpack(row["added"], np.uint32) + np.diff(upto)
        out.append(pd.DataFrame({"doc_id": pd.array(list(row["doc_ids"]), "Int64"), "n_bytes": unpack(row["bytes"], np.int64), "n_tokens": tokens, "over_limit": tokens > limit}))
    return pd.concat(out) if out else pd.DataFrame({c.split()[0]: [] for c in COUNTS.split(", ")})


def count_tokens(docs: DataFrame, tokenizer_path: str, limit: int = 2048) -> DataFrame:
    """doc_id, n_bytes (UTF-8), n_tokens and over_limit (n_tokens > limit) of every whole text.

    The tokenizer file must have a pre-tokenizer, as pieces then never cross pre-tokens. A null text counts as empty (no
    bytes, no tokens), repeated rows give repeated rows, an empty table gives none; other columns are left out whatever
    their names. Texts of any length are counted whole.
    """
    rows = pick(docs, doc_id="bigint", text="string")
    blocks = materialise(rows.mapInArrow(lambda b: _blocks(b, tokenizer_path), BLOCKS), "token-frequencies")
    sent = blocks.select("lengths").mapInArrow(_sent, "n bigint").agg(F.sum("n")).first()[0] or 0
    buckets = max(1, math.ceil(sent / BUCKET_SIZE))
    asks = blocks.select("block", "keys", "lengths", "strings").mapInArrow(lambda b: _asks(b, buckets), ASKS)
    replies = asks.groupBy("bucket").applyInPandas(lambda g: _pieces(g, tokenizer_path), REPLIES)
    own = blocks.select("block", "doc_ids", "bytes", "added", "distinct", "numbers", "frequencies")
    out = materialise(own.groupBy("block").cogroup(replies.groupBy("block")).applyInPandas(lambda b, r: _sum(b, r, limit), COUNTS), "token-counts")
    release(blocks)
    return out


def _sent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How many pre-tokens each block sends."""
    for batch in slices(batches, 100):
        yield pa.RecordBatch.from_arrays([pa.array([len(unpack(v.as_py(), np.uint32)) for v in batch.column(0)], pa.int64())], ["n"])
