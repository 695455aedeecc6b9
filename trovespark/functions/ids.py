"""Identifiers: document ids in links, chunk ids and their parents, split names in run names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SPACE = r"[\s\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
#: Metadata keys that give a query's answer away; evidence records never carry them.
ORACLE_KEYS = ("documents", "snippets", "ideal_answer", "exact_answer", "concepts", "triples", "answer_ready", "asq_challenge")


def strip(x: Column) -> Column:
    """Without white space (of any script) at both ends."""
    return F.regexp_replace(x, f"^{SPACE}+|{SPACE}+$", "")


def blank_to_null(x: Column) -> Column:
    return F.when(strip(x) != "", strip(x))


def doc_id(x: Column) -> Column:
    """The article number of a link, else the trimmed value; null and blank give ''."""
    number = lambda pattern: F.nullif(F.regexp_extract(x, pattern, 1), F.lit(""))
    return F.coalesce(number(r"(?i)/pubmed/(\d+)"), number(r"(?i)pubmed\.ncbi\.nlm\.nih\.gov/(\d+)"), strip(x), F.lit(""))


def listed_doc_id(x: Column) -> Column:
    """The id of an entry of a `documents` list: links must end in an article number or they give null."""
    number = F.nullif(F.regexp_extract(x, r"pubmed/(\d+)/?$", 1), F.lit(""))
    return F.when(F.lower(strip(x)).startswith("http"), number).otherwise(blank_to_null(x))


def parent(docno: Column) -> Column:
    """A chunk's document: what stands before the first '#'."""
    return F.substring_index(docno, "#", 1)


def ranked_ids(doc_ids: Column, docnos: Column, documents: Column) -> Column:
    """A record's ranked ids: the first of three lists that isn't empty, else an empty one."""
    some = lambda xs: F.when(F.size(xs) > 0, xs)
    listed = F.filter(F.transform(documents, listed_doc_id), lambda x: x.isNotNull())
    return F.coalesce(some(doc_ids), some(docnos), some(listed), F.array().cast("array<string>"))


def first_ids(ids: Column, k: int) -> Column:
    """The first k ids; all if k is not positive."""
    return F.slice(ids, 1, k) if k > 0 else ids


def query_id(given: Column, index: Column) -> Column:
    return F.coalesce(blank_to_null(given), index.cast("string"))


def split_of_run(name: Column) -> Column:
    """The split that a run's name holds between its stage and its cut-off."""
    return F.nullif(F.regexp_extract(name, r"stage1_(.+)_top\d+", 1), F.lit(""))


def rerank_name(name: Column) -> Column:
    """The name of the rerank run that a fused run came from."""
    return F.regexp_replace(name, r"_rrf_pool.*$", "")


def role_of(run: Column, train: list[str], test: list[str]) -> Column:
    """train, test or other, by the split names that a run's name contains."""
    any_of = lambda stems: F.exists(F.array(*map(F.lit, stems)), lambda s: F.contains(run, s)) if stems else F.lit(False)
    return F.when(any_of(train), "train").when(any_of(test), "test").otherwise("other")


def safe_name(name: Column) -> Column:
    """A file name: everything but letters, digits, dot, dash and underscore as one underscore."""
    return F.regexp_replace(strip(name), r"[^A-Za-z0-9._-]+", "_")


def short_label(run: Column, most: int = 24) -> Column:
    """A run's name for a plot: its split if the name holds one, else the name, cut in the middle where it is too long."""
    name = F.coalesce(split_of_run(run), run)
    half = (most - 1) // 2
    return F.when(F.length(name) <= most, name).otherwise(F.concat(F.substring(name, 1, half), F.lit("~"), F.right(name, F.lit(half))))
