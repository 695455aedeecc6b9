"""Personal data: plain identifiers, and disguised ones found through offset-preserving transducers.

A chain of transducers rewrites a text: look-alike characters to ASCII, spelled digits to digits, at/dot disguises to
signs. Each records which source characters every rewritten stretch stands for, so that a span found in the rewritten
text maps back, transducer by transducer, to the characters of the source. The same detectors run on both texts. Spans of
the plain text always stay; the rewritten text only adds those that touch something rewritten.

Detectors take time in proportion to the text: they are anchored at the sign that an identifier must have, or chunk
chains that can't overlap, so a megabyte of digits or letters costs no more than a megabyte of prose.
"""

from __future__ import annotations

import hashlib
import re
import unicodedata
from bisect import bisect_right
from collections.abc import Iterator
from functools import cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import StructField, StructType
from trovespark.frames import pick, slices

KINDS = ("email", "ip", "card", "phone")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
DOTTED = re.compile(r"[0-9]+(?:\.[0-9]+)*")
DIGITS = re.compile(r"[0-9](?:[ -]?[0-9])+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
ANY_DIGIT = re.compile("[0-9]").search


def emails(text: str) -> Iterator[tuple[int, int]]:
    done, at = 0, text.find("@")
    while at >= 0:
        domain, begin = DOMAIN.match(text, at + 1), at
        if domain:
            while begin > done and text[begin - 1] in LOCAL:
                begin -= 1
            if begin < at:
                yield begin, domain.end()
                done = domain.end()
        at = text.find("@", max(done, at + 1))


def ips(text: str) -> Iterator[tuple[int, int]]:
    for chain in DOTTED.finditer(text):
        if text.find(".", chain.start(), chain.end()) < 0:
            continue
        parts, at = chain[0].split("."), chain.start()
        for i in range(0, len(parts) - 3, 4):
            four = parts[i : i + 4]
            size = sum(map(len, four)) + 3
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in four):
                yield at, at + size
            at += size + 1


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        n = int(c) << (i & 1)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def cards(text: str) -> Iterator[tuple[int, int]]:
    for m in DIGITS.finditer(text):
        if m.end() - m.start() <= 37:
            digits = m[0].replace(" ", "").replace("-", "")
            if 12 <= len(digits) <= 19 and luhn(digits):
                yield m.span()


def phones(text: str) -> Iterator[tuple[int, int]]:
    for m in PHONE.finditer(text):
        if 9 <= sum(c.isdigit() for c in m[0]) <= 15:
            yield m.span()


def detect(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of every plain identifier, sorted."""
    found = []
    if "@" in text:
        found += [(a, 0, b) for a, b in emails(text)]
    if ANY_DIGIT(text):
        found += [(a, 1, b) for a, b in ips(text)]
        found += [(a, 2, b) for a, b in cards(text)]
        if "+" in text:
            found += [(a, 3, b) for a, b in phones(text)]
    return sorted(found)


class Rewritten:
    """A text after some stretches were replaced, able to map spans of it back to the text before."""

    def __init__(self, text: str, edits: list[tuple[int, int, str]]):
        parts, at, length = [], 0, 0
        self.begins, self.ends, self.sources = [], [], []
        for begin, end, new in edits:
            parts += (text[at:begin], new)
            length += begin - at
            self.begins.append(length)
            length += len(new)
            self.ends.append(length)
            self.sources.append((begin, end))
            at = end
        self.text = "".join([*parts, text[at:]])

    def _place(self, at: int, side: int) -> int:
        i = bisect_right(self.begins, at) - 1
        while i >= 0 and self.begins[i] == self.ends[i]:  # deletions hold no character
            i -= 1
        if i >= 0 and at < self.ends[i]:
            return self.sources[i][side]
        i = bisect_right(self.ends, at) - 1
        return (at if i < 0 else self.sources[i][1] + at - self.ends[i]) + side

    def back(self, begin: int, end: int) -> tuple[int, int]:
        """The source span of characters begin..end of the rewritten text."""
        return self._place(begin, 0), self._place(end - 1, 1)


# Letters of other scripts that look like ASCII letters, signs that look like ASCII signs, digit words,
# at/dot words, and common top-level domains.
LOOKALIKES = {
    "а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "х": "x", "у": "y", "і": "i", "ј": "j", "ѕ": "s", "һ": "h", "ԁ": "d", "ԛ": "q", "ԝ": "w", "ӏ": "l",
    "А": "A", "В": "B", "Е": "E", "К": "K", "М": "M", "Н": "H", "О": "O", "Р": "P", "С": "C", "Т": "T", "Х": "X", "У": "Y", "І": "I", "Ј": "J", "Ѕ": "S",
    "α": "a", "ο": "o", "ν": "v", "ρ": "p", "ι": "i", "κ": "k", "υ": "u", "χ": "x", "γ": "y",
    "Α": "A", "Β": "B", "Ε": "E", "Ζ": "Z", "Η": "H", "Ι": "I", "Κ": "K", "Μ": "M", "Ν": "N", "Ο": "O", "Ρ": "P", "Τ": "T", "Υ": "Y", "Χ": "X",
    "ɑ": "a", "ɡ": "g", "ı": "i", "‐": "-", "‑": "-", "‒": "-", "–": "-", "—": "-", "−": "-", "․": ".", "。": ".", "。": ".", "٫": ".",
}
DIGIT_WORDS = {
    "zero": 0, "oh": 0, "one": 1, "two": 2, "three": 3, "four": 4, "five": 5, "six": 6, "seven": 7, "eight": 8, "nine": 9,
    "zéro": 0, "un": 1, "deux": 2, "trois": 3, "quatre": 4, "cinq": 5, "sept": 7, "huit": 8, "neuf": 9,
    "null": 0, "eins": 1, "zwei": 2, "drei": 3, "vier": 4, "fünf": 5, "sechs": 6, "sieben": 7, "acht": 8, "neun": 9,
    "cero": 0, "uno": 1, "dos": 2, "tres": 3, "cuatro": 4, "cinco": 5, "seis": 6, "siete": 7, "ocho": 8, "nueve": 9,
}
AT_WORDS = "at|arroba|arobase|chez|bei"
DOT_WORDS = "dot|punkt|point|punto"
TOP_DOMAINS = frozenset("com org net edu gov mil int info biz io ai dev app co me eu de fr es it uk us ca au ch at be nl se no dk fi pl pt ru cn jp in br mx ar cl pe ve uy ec za nz ie cz gr ro hu bg hr rs ua tr kr tw hk sg il online site shop store xyz tech cloud blog live news club top pro world email name museum agency digital studio space website".split())
#: Bare at-words with the bare dot-words they stand with (all, where the word means nothing else), and words that no
#: address has after one.
BARE = {"at": {"dot"}, "bei": {"punkt", "dot"}, "chez": {"point", "dot"}, "arroba": set(DOT_WORDS.split("|")), "arobase": set(DOT_WORDS.split("|"))}
NO_HOST = frozenset("the a an this that these any some each every which what one some our your my le la les un une ce cet cette ces mon son der die das dem den diesem dieser einem einer jedem el los las este esta ese esa".split())

#: Characters that the first transducer may rewrite: soft hyphen, no-break space, and all beyond the Latin letters.
UNUSUAL = re.compile("[ ­ıɐ-\U0010ffff]")
DIGIT_TOKEN = re.compile(rf"[0-9]+|\b(?:{'|'.join(sorted(DIGIT_WORDS, key=len, reverse=True))})\b", re.IGNORECASE)
DIGIT_WORD = re.compile(rf"\b(?:{'|'.join(sorted(DIGIT_WORDS, key=len, reverse=True))})\b", re.IGNORECASE)
BETWEEN = re.compile(r"[ \t\n,-]{1,3}")
DOT_BETWEEN = re.compile(rf"[ \t\n]+(?:{DOT_WORDS})[ \t\n]+|[ \t\n]*\.[ \t\n]*", re.IGNORECASE)
PLUS_BEFORE = re.compile(r"(?:\bplus\b|\+)[ \t\n,:-]{0,3}$", re.IGNORECASE)
DIGIT_LETTERS = re.compile(r"(?<![A-Za-z0-9])\+?[0-9OoIl](?:[ ().-]{0,2}[0-9OoIl]){7,}(?![A-Za-z0-9])")
FOREIGN_DOTS = frozenset(DOT_WORDS.split("|")) - {"dot"}
AT = re.compile(rf"(?P<shut>[ \t]*[\[({{<][ \t]*(?:{AT_WORDS}|@)[ \t]*[\])}}>][ \t]*)|(?P<word>[ \t]+(?:{AT_WORDS})[ \t]+)|(?P<sign>[ \t]*@[ \t]*)", re.IGNORECASE)
DOT = rf"(?:[ \t]*[\[({{<][ \t]*(?:{DOT_WORDS}|\.)[ \t]*[\])}}>][ \t]*|[ \t]+(?:{DOT_WORDS})[ \t]+|\.)"
DOT_AT = re.compile(DOT, re.IGNORECASE)
DISGUISED_DOMAIN = re.compile(rf"[A-Za-z0-9-]+(?:{DOT}[A-Za-z0-9-]+)+", re.IGNORECASE)
LOCAL_DOT = DOT.replace(rf"[ \t]+(?:{DOT_WORDS})[ \t]+", r"[ \t]+(?:dot|punto|punkt)[ \t]+")
DISGUISED_LOCAL = re.compile(rf"[A-Za-z0-9_%+-]+(?:{LOCAL_DOT}[A-Za-z0-9_%+-]+)*$", re.IGNORECASE)
MAY_HIDE = re.compile(rf"[\[({{<][ \t]*(?:{AT_WORDS}|@|{DOT_WORDS})[ \t]*[\])}}>]|[ \t]dot[ \t]|[ \t](?:{AT_WORDS})[ \t]+[A-Za-z0-9-]+(?:\.[A-Za-z0-9]|[ \t]+(?:{DOT_WORDS})[ \t])|@[A-Za-z0-9.-]+[ \t]+(?:{DOT_WORDS})[ \t]", re.IGNORECASE)
MARKED = re.compile(r"[A-Za-z].*[._+0-9]|[._+0-9].*[A-Za-z]")
#: How far to the left a local part is looked for at first; one that reaches that far is looked for twice as far.
LOCAL_ROOM = 160


@cache
def plain_form(char: str) -> str | None:
    """What a character is rewritten to, None if it stays."""
    if char in LOOKALIKES:
        return LOOKALIKES[char]
    kind = unicodedata.category(char)
    if kind == "Cf":
        return ""
    if kind == "Nd":
        return str(unicodedata.decimal(char))
    if kind == "Zs":
        return " "
    form = unicodedata.normalize("NFKC", char)
    form = LOOKALIKES.get(form, form)
    return form if form != char and form.isascii() and form.strip() else None


def lookalike_edits(text: str) -> list[tuple[int, int, str]]:
    edits = []
    for m in UNUSUAL.finditer(text):
        new = plain_form(m[0])
        if new is not None:
            edits.append((m.start(), m.end(), new))
    return edits


def digits_of(token: str) -> str:
    return token if token.isdigit() else str(DIGIT_WORDS[token.lower()])


def spelled_edits(text: str) -> list[tuple[int, int, str]]:
    """Runs of digit words and figures with four or more digits become digits; what separates two of them goes, or becomes
    the dot it says. Figures of plain identifiers are in no run, so that a word beside one doesn't join it."""
    edits: list[tuple[int, int, str]] = []
    if not DIGIT_WORD.search(text):
        return edits
    runs: list[list[re.Match]] = []
    taken = detect(text)
    ends = [0] * len(taken)  # furthest end of the spans so far
    for i, (_, _, end) in enumerate(taken):
        ends[i] = max(end, ends[i - 1] if i else 0)
    starts = [begin for begin, _, _ in taken]
    for m in DIGIT_TOKEN.finditer(text):
        if (i := bisect_right(starts, m.start())) and m.start() < ends[i - 1] and m[0].isdigit():
            runs.append([])
            continue
        if runs and runs[-1]:
            gap = text[runs[-1][-1].end() : m.start()]
            if len(gap) <= 12 and (BETWEEN.fullmatch(gap) or DOT_BETWEEN.fullmatch(gap)):
                runs[-1].append(m)
                continue
        runs.append([m])
    for run in runs:
        if all(m[0].isdigit() for m in run) or sum(len(m[0]) if m[0].isdigit() else 1 for m in run) < 4:
            continue
        plus = PLUS_BEFORE.search(text[max(0, run[0].start() - 10) : run[0].start()])
        begin = run[0].start() - (len(plus[0]) if plus else 0)
        if edits and begin < edits[-1][1]:
            begin, plus = run[0].start(), None
        for i, m in enumerate(run):
            lead = "+" * bool(plus) if not i else "." * bool(DOT_BETWEEN.fullmatch(text[run[i - 1].end() : m.start()]))
            if lead:
                edits.append((begin if not i else run[i - 1].end(), m.start(), lead))
                edits.append((m.start(), m.end(), digits_of(m[0])))
            else:
                edits.append((run[i - 1].end() if i else m.start(), m.end(), digits_of(m[0])))
    return edits


def letter_edits(text: str) -> list[tuple[int, int, str]]:
    """O, o, I and l inside numbers become 0 and 1 where digits are in the majority."""
    edits = []
    for m in DIGIT_LETTERS.finditer(text):
        digits = sum(c.isdigit() for c in m[0])
        letters = [i for i, c in enumerate(m[0], m.start()) if c.isalpha()]
        if letters and digits > 2 * len(letters):
            edits += [(i, i + 1, "0" if text[i] in "Oo" else "1") for i in letters]
    return edits


def address_edits(text: str) -> list[tuple[int, int, str]]:
    """At and dot disguises become signs, only where a whole address results.

    In brackets a disguise speaks for itself; the bare words of all languages count only before a domain whose last label
    is a common top-level domain, and whose dots are disguised in the same language; before a plain domain, words that
    mean nothing else count, others only after a local part with a sign or figure in it ('john.doe at example.com').
    """
    edits, done = [], 0
    if not MAY_HIDE.search(text):
        return edits
    for at in AT.finditer(text):
        if at.start() < done:
            continue
        domain = DISGUISED_DOMAIN.match(text, at.end())
        if not domain:
            continue
        dots = list(DOT_AT.finditer(domain[0]))
        while dots and not re.fullmatch(r"[A-Za-z]{2,24}", last := re.split(r"[ \t\[({<]", domain[0][dots[-1].end() :])[0]):
            dots.pop()
        word = at["word"] and at[0].strip().lower()
        if word and re.match(r"[A-Za-z0-9-]+", domain[0])[0].lower() in NO_HOST:
            continue
        bare = [d[0].strip().lower() for d in dots]
        if word and not set(bare) & set(DOT_WORDS.split("|")) <= BARE[word]:
            continue
        while dots and not word and bare[-1] in FOREIGN_DOTS and last.lower() not in TOP_DOMAINS:
            dots.pop(), bare.pop()
            last = re.split(r"[ \t\[({<]", domain[0][dots[-1].end() :])[0] if dots else ""
        if not dots:
            continue
        stop = domain.start() + dots[-1].end() + len(last)
        hidden = any(d[0] != "." for d in dots)
        common = last.lower() in TOP_DOMAINS
        if word and not common or at["sign"] and not (hidden or at[0] != "@") or at["sign"] and at[0] != "@" and not common:
            continue
        reach, local = LOCAL_ROOM, None
        while True:
            room = max(done, at.start() - reach)
            local = DISGUISED_LOCAL.search(text[room : at.start()])
            if not local or local.start() > 24 or room == done:  # a disguised dot may begin at the edge
                break
            reach *= 2
        if not local:
            continue
        begin = room + local.start()
        if word in ("at", "bei", "chez") and not hidden and not MARKED.search(local[0]):
            continue
        for d in DOT_AT.finditer(text, begin, at.start()):
            if d[0] != ".":
                edits.append((d.start(), d.end(), "."))
        if at[0] != "@":
            edits.append((at.start(), at.end(), "@"))
        for d in dots:
            if d[0] != ".":
                edits.append((domain.start() + d.start(), domain.start() + d.end(), "."))
        done = stop
    return edits


TRANSDUCERS = (lookalike_edits, spelled_edits, letter_edits, address_edits)


def hidden(text: str, plain: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """(start, kind, end) of identifiers that only the rewritten text shows."""
    steps, now = [], text
    for transducer in TRANSDUCERS:
        if edits := transducer(now):
            steps.append(Rewritten(now, edits))
            now = steps[-1].text
    if not steps:
        return []
    added = set()
    for begin, kind, end in detect(now):
        a, b = begin, end
        for step in reversed(steps):
            a, b = step.back(a, b)
        if text[a:b] != now[begin:end] and not any(k == kind and x <= a and b <= y for x, k, y in plain):
            added.add((a, kind, b))
    return sorted(added)


def spans(text: str) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
    """The plain spans, and all spans."""
    plain = detect(text)
    return plain, sorted({*plain, *hidden(text, plain)})


def said(found: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[kind]}:{begin}:{end}" for begin, kind, end in found)


def redacted(text: str, found: list[tuple[int, int, int]]) -> str:
    """The text with each stretch of touching spans replaced by the first one's kind in angle brackets."""
    parts, at, merged = [], 0, []
    for begin, kind, end in found:
        if merged and begin < merged[-1][2]:
            merged[-1][2] = max(end, merged[-1][2])
        else:
            merged.append([begin, kind, end])
    for begin, kind, end in merged:
        parts += (text[at:begin], f"<{KINDS[kind].upper()}>")
        at = end
    return "".join([*parts, text[at:]])


def find_batches(batches: Iterator[pa.RecordBatch], with_text: bool) -> Iterator[pa.RecordBatch]:
    names = ["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans", *(["redacted"] if with_text else [])]
    for batch in slices(batches, 1000):
        rows = []
        for value in batch.column(1):
            text = value.as_py()
            plain, found = spans(text or "")
            counts = [sum(k == i for _, k, _ in found) for i in range(len(KINDS))]
            rows.append((*counts, hashlib.sha256(said(plain).encode()).hexdigest(), said(found), *([text and redacted(text, found)] if with_text else [])))
        columns = list(zip(*rows)) or [()] * (len(names) - 1)
        kinds = [pa.int64()] * 4 + [pa.string()] * (len(names) - 5)
        yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, k) for c, k in zip(columns, kinds))], names)


def find(docs: DataFrame, with_text: bool = False) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256 and spans of every whole text (and its redacted form).

    Counts and `spans` have all spans, plain and disguised, as kind:start:end in code points of the source; base_sha256
    is the digest of the plain ones alone. A null text has none (its redacted form is null); repeated rows give repeated
    rows, an empty table none; other columns are left out whatever their names. No shuffle.
    """
    schema = "doc_id bigint, n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, base_sha256 string, spans string" + ", redacted string" * with_text
    return pick(docs, doc_id="bigint", text="string").mapInArrow(lambda batches: find_batches(batches, with_text), schema)


def redact_batches(batches: Iterator[pa.RecordBatch], text_at: int, n_chars_at: int) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, 1000):
        texts = [value.as_py() for value in batch.column(text_at)]
        new = [t and redacted(t, spans(t)[1]) for t in texts]
        batch = batch.set_column(text_at, batch.schema.field(text_at), pa.array(new, pa.string()))
        if n_chars_at >= 0:
            batch = batch.set_column(n_chars_at, batch.schema.field(n_chars_at), pa.array([None if t is None else len(t) for t in new], pa.int64()))
        yield batch


def redact(docs: DataFrame) -> DataFrame:
    """The same rows and columns with every span of `text` replaced by its kind, and n_chars counted again."""
    names = docs.columns
    schema = StructType([StructField(f.name, f.dataType) for f in docs.schema])
    return docs.mapInArrow(lambda batches: redact_batches(batches, names.index("text"), names.index("n_chars") if "n_chars" in names else -1), schema)
