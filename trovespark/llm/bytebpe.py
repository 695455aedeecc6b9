"""Byte-level BPE encoding and decoding by dynamic programming over byte prefixes.

Every prefix of a piece has one encoding, and every prefix of an encoding is itself an encoding. So the encoding of a
prefix is known from its last token alone: the one token that ends there and is *compatible* with the last token of the
shorter prefix that it leaves. Storing that token for each prefix gives the encoding by walking back, an exact append by
carrying on, and an exact re-encoding of an edited piece by carrying on until the stored tokens agree again.

Two tokens are compatible if no merge ever crosses their boundary. While merges run, the right edge of the left token
goes through the chain of its right halves, each alive until the merge that consumes it; likewise the left edge of the
right token. A crossing merge of rank m happens if and only if two such edges are joined by a merge of rank m before
either is consumed (of equal ranks the one further left comes first).
"""

from __future__ import annotations

import base64
import hashlib
import re
from array import array
from collections.abc import Iterable, Iterator
from functools import cache
from itertools import chain

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from trovespark.frames import pick, slices

#: The ASCII form of the usual splitting pattern. It gives the same pieces on ASCII texts and is found by a faster engine.
ASCII_FORM = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?[A-Za-z]+| ?[0-9]+| ?[^\sA-Za-z0-9]+|\s+(?!\S)|\s+", re.ASCII)
FULL_FORM = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
NEVER = 1 << 62


class PrefixBpe:
    """Encoder for a rank table: token bytes to rank, ranks being ids; every single byte must be a token."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.bytes_of = [b""] * (max(ranks.values(), default=-1) + 1)
        self.joins: dict[tuple[int, int], int] = {}
        self.longest_by_end = [0] * 256
        for token, rank in ranks.items():
            self.bytes_of[rank] = token
            self.longest_by_end[token[-1]] = max(self.longest_by_end[token[-1]], len(token))
            for i in range(1, len(token)):
                left, right = ranks.get(token[:i]), ranks.get(token[i:])
                if left is not None and right is not None:
                    self.joins[left, right] = rank
        self.longest = max(self.longest_by_end)
        self._halves: dict[int, tuple[int, int] | None] = {}
        self._right: dict[int, list[tuple[int, int]]] = {}
        self._left: dict[int, list[tuple[int, int]]] = {}
        self._fits: dict[int, bool] = {}
        self._fits_before: dict[int, bool] = {}

    def halves(self, token: int) -> tuple[int, int] | None:
        """The two tokens whose merge makes `token`, (-1, -1) for a single byte, None if merges never make it."""
        if token not in self._halves:
            parts = [self.ranks[bytes([b])] for b in self.bytes_of[token]]
            if len(parts) == 1:
                self._halves[token] = (-1, -1)
                return -1, -1
            while len(parts) > 2:
                rank, at = min(((self.joins.get((a, b), NEVER), i) for i, (a, b) in enumerate(zip(parts, parts[1:]))))
                if rank == NEVER:
                    break
                parts[at : at + 2] = [rank]
            whole = len(parts) == 2 and self.joins.get((parts[0], parts[1])) == token
            self._halves[token] = (parts[0], parts[1]) if whole else None
        return self._halves[token]

    def _edges(self, token: int, side: int) -> list[tuple[int, int]]:
        """The tokens at one edge of `token` while it is built, each with the rank of the merge that consumes it."""
        edges, until = [], NEVER
        while token != -1:
            edges.append((token, until))
            token, until = self.halves(token)[side], token
        return edges

    def compatible(self, left: int, right: int) -> bool:
        """Whether `left` then `right` is the encoding of their joined bytes."""
        pair = left << 32 | right
        known = self._fits.get(pair)
        if known is not None:
            return known
        known = self._fits_before.get(pair)
        if known is None:
            if left not in self._right:
                self._right[left] = self._edges(left, 1)
            if right not in self._left:
                self._left[right] = self._edges(right, 0)
            known, joins = True, self.joins
            for a, a_until in self._right[left]:
                for b, b_until in self._left[right]:
                    rank = joins.get((a, b))
                    if rank is not None and rank < a_until and rank <= b_until:
                        known = False
        if len(self._fits) >= 250_000:  # bounded memory; what is still in use comes back from the part before
            self._fits, self._fits_before = {}, self._fits
        self._fits[pair] = known
        return known

    def append(self, piece: bytes, last: list[int], more: bytes, old: list[int] = (), same_from: int = 0) -> list[int]:
        """`last` (the last token of each prefix of `piece`) carried on over `more`, in place.

        `old`: stored tokens of a piece that ends in the same bytes as this one from `same_from` on; once the new tokens
        agree with them there over the longest token's length, the rest is taken from the old ones.
        """
        text, ranks, done = piece + more, self.ranks, len(piece)
        agreed, shift = 0, len(old) - len(text)
        for end in range(done + 1, len(text) + 1):
            for begin in range(max(0, end - self.longest_by_end[text[end - 1]]), end):
                token = ranks.get(text[begin:end])
                if token is not None and (begin == 0 or self.compatible(last[begin - 1], token)) and self.halves(token) is not None:
                    last.append(token)
                    break
            if old:
                agreed = agreed + 1 if end > same_from and old[end + shift - 1] == last[-1] else 0
                if agreed >= self.longest:
                    last.extend(old[end + shift :])
                    break
        return last

    def prefixes(self, piece: bytes) -> list[int]:
        return self.append(b"", [], piece)

    def edit(self, piece: bytes, last: list[int], begin: int, end: int, new: bytes) -> tuple[bytes, list[int]]:
        """The piece with bytes begin..end replaced, and its prefix tokens, computed only near the edit."""
        edited = piece[:begin] + new + piece[end:]
        keep = last[:begin]
        return edited, self.append(piece[:begin], keep, edited[begin:], last, begin + len(new))

    def tokens(self, piece: bytes, last: list[int]) -> list[int]:
        out, end = [], len(piece)
        while end:
            out.append(last[end - 1])
            end -= len(self.bytes_of[out[-1]])
        return out[::-1]

    def encode_piece(self, piece: bytes) -> list[int]:
        whole = self.ranks.get(piece)
        if whole is not None:  # a piece that is a token stays whole, as rank-table encoders have it
            return [whole]
        return self.tokens(piece, self.prefixes(piece))

    def decode(self, ids: Iterable[int]) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))


class EncodedText:
    """A text held with its pieces, whose appends and edits re-encode only the pieces that change."""

    def __init__(self, coder: PrefixBpe, text: str = "", pattern: str = FULL_FORM):
        self.coder, self.pattern, self.text = coder, regex.compile(pattern), text
        self.spans = [m.span() for m in self.pattern.finditer(text)]
        self.tokens = [coder.encode_piece(text[a:b].encode()) for a, b in self.spans]

    @property
    def ids(self) -> list[int]:
        return list(chain.from_iterable(self.tokens))

    def append(self, more: str) -> None:
        self.edit(len(self.text), len(self.text), more)

    def edit(self, begin: int, end: int, new: str) -> None:
        """Replaces characters begin..end. A piece depends only on the text from its start on, so matching starts at the
        piece before the edit (before the white space that leads to it) and stops where an old piece starts again."""
        old, text = self.text, self.text[:begin] + new + self.text[end:]
        safe = begin
        while safe and old[safe - 1].isspace():
            safe -= 1
        first = next((i for i, (_, b) in enumerate(self.spans) if b >= safe), len(self.spans))
        at = self.spans[first][0] if first < len(self.spans) else (self.spans[-1][1] if self.spans else 0)
        at = min(at, begin)
        shift, starts = len(text) - len(old), {a: i for i, (a, _) in enumerate(self.spans)}
        spans, tokens, tail = self.spans[:first], self.tokens[:first], len(self.spans)
        while at < len(text):
            same = starts.get(at - shift) if at >= begin + len(new) else None
            if same is not None:
                tail = same
                break
            m = self.pattern.match(text, at)
            if m is None:
                at += 1
                continue
            spans.append(m.span())
            tokens.append(self.coder.encode_piece(m[0].encode()))
            at = m.end()
        self.spans = spans + [(a + shift, b + shift) for a, b in self.spans[tail:]]
        self.tokens = tokens + self.tokens[tail:]
        self.text = text


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


@cache
def coder(path: str) -> PrefixBpe:
    return PrefixBpe(read_ranks(path))


class _Pieces(dict):
    """Ids of each distinct piece as little-endian bytes. When full, its entries become the part before; those still in
    use come back from there, the others go. Only speed depends on it."""

    FULL = 120_000

    def __init__(self, bpe: PrefixBpe):
        self.bpe, self.before = bpe, {}

    def __missing__(self, piece: str) -> bytes:
        ids = self.before.get(piece)
        if ids is None:
            ids = array("I", self.bpe.encode_piece(piece.encode())).tobytes()
        if len(piece) <= 64:
            if len(self) >= self.FULL:
                self.before = dict(self)
                self.clear()
            self[piece] = ids
        return ids


@cache
def _pieces(path: str) -> _Pieces:
    return _Pieces(coder(path))


def encode_batches(batches: Iterator[pa.RecordBatch], path: str, pattern: str, with_ids: bool) -> Iterator[pa.RecordBatch]:
    bpe, pieces = coder(path), _pieces(path)
    full = regex.compile(pattern).findall
    quick = ASCII_FORM.findall if pattern == FULL_FORM else full
    for batch in slices(batches, 1000):
        counts, id_sums, text_sums, all_ids = [], [], [], []
        for value in batch.column(1):
            text = value.as_py() or ""
            raw = b"".join(map(pieces.__getitem__, (quick if text.isascii() else full)(text)))
            ids = array("I", raw)
            counts.append(len(ids))
            id_sums.append(hashlib.sha256(raw).hexdigest())
            text_sums.append(hashlib.sha256(bpe.decode(ids)).hexdigest())
            if with_ids:
                all_ids.append(pa.array(ids, pa.int32()))
        columns = [batch.column(0), pa.array(counts, pa.int64()), pa.array(id_sums, pa.string()), pa.array(text_sums, pa.string())]
        if with_ids:
            columns.append(pa.ListArray.from_arrays(pa.array([0, *_running(counts)], pa.int32()), pa.concat_arrays(all_ids) if all_ids else pa.array([], pa.int32())))
        yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", *(["ids"] if with_ids else [])])


def _running(counts: list[int]) -> Iterator[int]:
    total = 0
    for n in counts:
        yield (total := total + n)


def encode(docs: DataFrame, ranks_path: str, pattern: str = FULL_FORM, with_ids: bool = False) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 (and ids: array<int>) of every whole text; no shuffle.

    A null text counts as empty: 0 tokens and the digest of no bytes. Repeated rows give repeated rows, a null doc_id
    stays null, an empty table gives none, and other columns are left out whatever their names. Long texts are encoded
    piece by piece; a long piece costs its length times the longest token.
    """
    schema = "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * with_ids
    return pick(docs, doc_id="bigint", text="string").mapInArrow(lambda batches: encode_batches(batches, ranks_path, pattern, with_ids), schema)


def decode_batches(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    bpe = coder(path)
    for batch in batches:
        texts = [bpe.decode(ids.as_py() or []) for ids in batch.column(1)]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.binary())], ["doc_id", "bytes"])


def decode(encoded: DataFrame, ranks_path: str) -> DataFrame:
    """doc_id and the bytes that `ids` stand for; null ids give no bytes. Repeated rows give repeated rows, an empty table
    none; other columns are left out whatever their names. An id beyond the vocabulary is an error."""
    return pick(encoded, doc_id="bigint", ids="array<int>").mapInArrow(lambda batches: decode_batches(batches, ranks_path), "doc_id bigint, bytes binary")
