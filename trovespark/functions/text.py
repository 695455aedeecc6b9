"""Text rules as column expressions: normal forms, tokens, code terms, seed queries, sentences, prose tests."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from trovespark.functions.ids import blank_to_null, strip

WORD = r"[\p{L}\p{N}]+"
#: Letters, an optional dash, digits: product and gene codes.
CODE = r"(?<![\p{L}\p{N}_])([A-Za-z]{2,12})\s*[-–]?\s*(\d{2,})(?![\p{L}\p{N}_])"
# Question openings that a feedback seed goes without, the first that fits.
OPENINGS = (
    r"what\s+is", r"what\s+are", r"what\s+was", r"what\s+were", r"what\s+does", r"which\s+(?:is|are)", r"when\s+(?:is|was)", r"how\s+many", r"list", r"describe", r"define",
)
# An instruction echo at the start of a summary, and words that say nothing about a claim.
PREAMBLE = r"(?is)^\s*(?:here(?:'s| is| are)|the combined|combined statement|sure[,:]?|below is)\b[^:]*:\s*"
STOP = """a an the this that these those and or but nor so yet for of to in on at
by with from as is are was were be been being it its it's they them their there here he she
his her you your we our i me my do does did done has have had having not no can could may
might must shall should will would about into over under out up down off than then when
where which who whom whose what why how also such more most many much some any each both few
per if because while during between within without across after before above below only very
just both either neither via using use used one two per e g i e etc vs""".split()
#: Spaces of all scripts but the plain one, and line and paragraph separators.
WIDE_SPACE = r"[\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"


def words(x: Column) -> Column:
    """Lower-case runs of letters and digits of any script."""
    return F.regexp_extract_all(F.lower(x), F.lit(WORD), F.lit(0))


def slot_words(x: Column) -> Column:
    return F.regexp_extract_all(F.lower(F.coalesce(x, F.lit(""))), F.lit("[a-z0-9]+"), F.lit(0))


def content_words(x: Column) -> Column:
    """The distinct words of two or more characters that aren't stop words."""
    return F.array_distinct(F.filter(slot_words(x), lambda w: (F.length(w) > 1) & ~w.isin(STOP)))


def window_words(x: Column) -> Column:
    """Words of ASCII letters and digits, all else separating them."""
    return F.filter(F.split(F.regexp_replace(F.lower(x), r"[^a-zA-Z0-9\s]", " "), r"\s+"), lambda w: w != "")


def word_count(x: Column) -> Column:
    return F.size(F.filter(F.split(x, r"\s+"), lambda w: w != ""))


def normal(x: Column) -> Column:
    """Lower case with everything but letters, digits and underscores as single spaces."""
    return F.trim(F.regexp_replace(F.lower(x), r"[^\p{L}\p{N}_]+", " "))


def claim_key(qid: Column, text: Column) -> Column:
    """The cache key of a context: SHA-1 of query id, a zero byte and the text."""
    return F.sha1(F.concat(qid.cast("binary"), F.lit(bytearray(1)), text.cast("binary")))


def member_hash(texts: Column) -> Column:
    """16 hex digits that name a set of claims whatever their order."""
    return F.substring(F.sha1(F.array_join(F.array_sort(F.transform(texts, normal)), "\n")), 1, 16)


def without_preamble(x: Column) -> Column:
    return strip(F.regexp_replace(x, PREAMBLE, ""))


def plain_spaces(x: Column) -> Column:
    """Wide spaces become plain ones, runs of plain ones become one, and the ends go."""
    return F.trim(F.regexp_replace(F.regexp_replace(x, WIDE_SPACE, " "), " {2,}", " "))


def digit_chunks(x: Column) -> Column:
    return F.regexp_extract_all(x, F.lit(".{1,4}"), F.lit(0))


def code_terms(x: Column) -> Column:
    """Extra terms for each code: its letters; five digits or more in chunks of four, alone and behind the letters;
    fewer digits alone and joined to the letters in three ways."""
    letters, digits = (F.regexp_extract_all(x, F.lit(CODE), F.lit(i)) for i in (1, 2))

    def terms(pair: Column) -> Column:
        p, d = F.lower(pair["letters"]), pair["digits"]
        chunks = digit_chunks(d)
        return F.when(F.length(d) >= 5, F.concat(F.array(p), chunks, F.array(F.concat_ws(" ", p, F.array_join(chunks, " "))))).otherwise(
            F.array(p, d, F.concat(p, d), F.concat(p, F.lit("-"), d), F.concat(p, F.lit(" "), d))
        )

    return F.flatten(F.transform(F.arrays_zip(letters.alias("letters"), digits.alias("digits")), terms))


def _extended(x: Column, terms: Column, gap: str) -> Column:
    return F.when(F.size(terms) > 0, F.concat(x, F.lit(gap), F.array_join(terms, " "))).otherwise(x)


def with_codes_for_index(x: Column) -> Column:
    """A document with its code terms once each, in order, as a paragraph of their own."""
    return _extended(x, F.array_sort(F.array_distinct(code_terms(x))), "\n\n")


def with_codes_for_query(x: Column) -> Column:
    """A query with its code terms behind it, repeated as often as they come."""
    x = F.coalesce(x, F.lit(""))
    return _extended(x, code_terms(x), " ")


def seed_query(x: Column) -> Column:
    """A query without its question opening and question marks; one that would be left empty stays whole."""
    raw = F.coalesce(x, F.lit(""))
    flat = F.regexp_replace(F.regexp_replace(strip(raw), r"\s+", " "), r"[ ?]+$", "")
    bare = F.trim(F.regexp_replace(flat, rf"(?i)^\s*(?:{'|'.join(OPENINGS)})\s+", ""))
    return F.when(bare != "", bare).otherwise(strip(F.regexp_replace(raw, r"[?]+$", "")))


def sentences(x: Column) -> Column:
    """Sentences in column terms: lines, cut behind a full stop, exclamation or question mark that white space follows."""
    cut = F.regexp_replace(F.coalesce(x, F.lit("")), r"([.!?])\s+", "$1\n")
    return F.filter(F.transform(F.split(cut, r"\n+"), strip), lambda s: s != "")


def is_prose(sentence: Column) -> Column:
    """Not a list (several lines, most of fewer than four words) and not a fragment (fewer than five words)."""
    lines = F.filter(F.transform(F.split(sentence, "\n"), strip), lambda s: s != "")
    short = F.filter(lines, lambda s: word_count(s) < 4)
    listed = (F.size(lines) > 1) & (F.size(short) / F.size(lines) > 0.5)
    return ~listed & (word_count(sentence) >= 5)


def index_text(title: Column, text: Column) -> Column:
    """Title and text as they are indexed: two lines apart."""
    return strip(F.concat_ws("\n\n", blank_to_null(title), blank_to_null(text)))


def dense_text(title: Column, text: Column, mesh: Column | None = None) -> Column:
    """As indexed, with the subject terms (what follows each colon) behind."""
    parts = [blank_to_null(title), blank_to_null(text)]
    if mesh is not None:
        terms = F.filter(F.transform(F.split(mesh, ";"), lambda m: strip(F.when(F.contains(m, F.lit(":")), F.regexp_replace(m, "^[^:]*:", "")).otherwise(m))), lambda m: m != "")
        parts.append(F.when(F.size(terms) > 0, F.concat(F.lit("MeSH: "), F.array_join(terms, "; "))))
    return F.concat_ws("\n\n", *parts)


def rerank_text(title: Column, text: Column) -> Column:
    return F.concat_ws(" ", blank_to_null(title), blank_to_null(text))


def context_text(title: Column, text: Column) -> Column:
    return plain_spaces(F.concat_ws(". ", blank_to_null(title), blank_to_null(text)))


def clipped(x: Column, most: int) -> Column:
    """The text, or its first characters and three dots."""
    return F.when(F.length(x) > most, F.concat(F.substring(x, 1, most), F.lit("..."))).otherwise(x)


def with_seed(topics):
    """Topics (qid, query) that ask by their seed: the query as given is kept as query_raw."""
    return topics.withColumn("query_raw", F.col("query")).withColumn("query", seed_query(F.col("query")))
