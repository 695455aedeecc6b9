"""SpotSigs document fingerprints, in DataFrame functions only.

Common words (of four languages) are anchors: where a content word follows one, the anchor with that and the next content
word is a signature. Prose is full of anchors and boilerplate is not, so signatures follow the prose. A fingerprint is
the sorted set of a text's signatures as 64-bit numbers; two are as alike as their Jaccard.

Near pairs are found by set length: lengths are partitioned so that a set can only match sets of its own partition and
of the next, only as many of its rarest signatures are looked up as a match must share, and what remains is compared.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from trovespark.frames import materialise, pick

# The commonest words of English, German, French and Spanish.
COMMON = sorted(
    set(
        """the of and a to in is was that it for on with as be by this are from at or an not have had but they his her she he which you were all we can
        der die das und ist nicht von zu den mit sich auf für im dem ein eine auch als an es war wird bei aus nach um am sind wie
        le la les de des du et un une en est que qui dans pour pas au aux par sur plus ce il elle se ne sont avec son
        el los las del y que por con para su al lo como más pero sus le ya o este sí porque esta entre cuando""".split()
    )
)
WORD = r"[\p{L}\p{M}\p{N}]+"
MARK = "~"


def _bound(value: Column, use) -> Column:
    """`use(value)`, with `value` worked out once however often `use` refers to it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def signatures(text: Column) -> Column:
    """The text's sorted distinct signatures (array<bigint>).

    A text without an anchored chain is signed by its pairs of neighbouring words, one without words by itself; only an
    empty text has no signature.
    """
    words = F.regexp_extract_all(F.lower(text), F.lit(WORD), F.lit(0))
    marked = F.transform(words, lambda w: F.when(w.isin(COMMON), F.concat(F.lit(MARK), w)).otherwise(w))

    def chained(all_: Column) -> Column:
        placed = F.transform(all_, lambda w, i: F.struct(w.alias("w"), F.get(all_, i - 1).alias("before")))

        def sign(content: Column) -> Column:  # the content words alone, so the next one is the next entry
            def one(x: Column, j: Column) -> Column:
                return F.when(x["before"].startswith(MARK), F.xxhash64(x["before"], x["w"], F.coalesce(F.get(content, j + 1)["w"], F.lit(""))))

            return F.filter(F.transform(content, one), lambda s: s.isNotNull())

        return _bound(F.filter(placed, lambda x: ~x["w"].startswith(MARK)), sign)

    def either(all_: Column) -> Column:
        def fallback(found: Column) -> Column:
            pairs = F.transform(all_, lambda w, i: F.xxhash64(w, F.coalesce(F.get(all_, i + 1), F.lit(""))))
            whole = F.when(F.length(text) > 0, F.array(F.xxhash64(text))).otherwise(F.array().cast("array<bigint>"))
            return F.when(F.size(found) > 0, found).when(F.size(all_) > 0, pairs).otherwise(whole)

        return _bound(chained(all_), fallback)

    return F.sort_array(F.array_distinct(_bound(marked, either)))


def as_string(found: Column) -> Column:
    return F.array_join(F.transform(found, lambda s: F.hex(s)), ",")


def likeness(a: Column, b: Column) -> Column:
    """Jaccard of two sets of signatures: 1 for two empty ones."""
    return _bound(
        F.size(F.array_intersect(a, b)),
        lambda both: F.when(F.size(a) + F.size(b) == 0, F.lit(1.0)).otherwise(both.cast("double") / (F.size(a) + F.size(b) - both)),
    )


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, text (null: empty), signatures of every row."""
    rows = pick(docs, doc_id="bigint", text="string").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    return rows.select("doc_id", "text", signatures(F.col("text")).alias("signatures"))


#: Rows in a stretch of ids, and knots of the id distribution by which stretches are laid out.
STRETCH_ROWS, KNOTS = 1000, 64
#: Stretches that a knot's span may have; a power of two.
SPAN = 1 << 40


def opening(text: Column) -> Column:
    """The first six bytes of a text as a number that grows with the text's order."""
    return F.conv(F.rpad(F.hex(F.substring(text.cast("binary"), 1, 6)), 12, "0"), 16, 10).cast("bigint")


def _stretch(ids: DataFrame, size: int) -> Column:
    """The stretch of a row of (doc_id, begins), a number that falls as rows follow each other: by descending id (null ids
    last), equal ids by text.

    The span between two knots of the id distribution is cut into equal parts. An id that several knots fall on, or the
    null id, may have many rows; its rows are cut by how their texts begin, between knots of all texts' openings.
    """
    fractions = [i / KNOTS for i in range(KNOTS + 1)]
    knots, openings, nulls = ids.agg(F.percentile_approx("doc_id", fractions, 10_000), F.percentile_approx("begins", fractions, 10_000), F.sum(F.col("doc_id").isNull().cast("int"))).first()
    knots, each = [int(k) for k in knots or ()], max(1, math.ceil(size / STRETCH_ROWS / KNOTS))

    def between(value: Column, edges: list[int], parts: int, apart: int) -> Column:
        """apart * the span that a value lies in + its part of the span, in ascending order."""
        out = F.lit(0).cast("bigint")
        for i, (a, b) in enumerate(zip(edges, edges[1:])):
            inside = F.floor((value - a) / F.lit(float(max(1, b - a))) * parts)
            out = F.when(value >= a, F.lit(i * apart) + F.greatest(F.least(inside, F.lit(parts - 1)), F.lit(0))).otherwise(out)
        return out

    cuts = sorted({int(o) for o in openings or ()})
    later = len(cuts) * each + 1 - between(F.col("begins"), cuts, each, each)  # texts ascend while stretches fall
    edges = sorted(set(knots))
    hot = [a for a in edges if knots.count(a) > 1]
    stretch = (between(F.col("doc_id"), edges, each, each) + 1) * SPAN
    for a in hot:  # before the rest of the span that it opens, as ids descend
        stretch = F.when(F.col("doc_id") == a, F.lit((edges.index(a) * each + 1) * SPAN - SPAN // 2) + later).otherwise(stretch)
    if (nulls or 0) <= STRETCH_ROWS:
        later = F.lit(0)
    return F.when(F.col("doc_id").isNull(), later - SPAN).otherwise(stretch).cast("bigint")


def with_next(rows: DataFrame, size: int) -> DataFrame:
    """`rows` (doc_id, text, signatures; `size` of them) with next_text and next_signatures of the row that follows by
    descending doc_id (null ids last, equal ids by text), the last being followed by the first.

    Rows are laid out in stretches of about equal size, rows of one id too, and each stretch is ordered on its own; the
    first row of a stretch is also sent, as a guest, behind the last row of the stretch before. So texts are shuffled once,
    and the driver holds two numbers for each stretch.
    """
    spark = rows.sparkSession
    begun = rows.withColumn("begins", opening(F.col("text")))
    placed = begun.withColumn("stretch", _stretch(begun.select("doc_id", "begins"), size))
    head = F.max(F.struct("doc_id", (-F.col("begins")).alias("o")))
    heads = sorted(((r.stretch, r["head"]["doc_id"], -r["head"]["o"]) for r in placed.select("doc_id", "begins", "stretch").groupBy("stretch").agg(head.alias("head")).collect()), key=lambda h: -h[0])
    if not heads:
        return rows.withColumn("next_text", F.col("text")).withColumn("next_signatures", F.col("signatures"))
    hosts = [(heads[i - 1][0], *h) for i, h in enumerate(heads)]  # the first stretch is guest of the last
    visit = F.broadcast(spark.createDataFrame(hosts, "host bigint, _from bigint, _head bigint, _begins bigint"))
    same = (F.col("stretch") == F.col("_from")) & F.col("doc_id").eqNullSafe(F.col("_head")) & (F.col("begins") == F.col("_begins"))
    one = placed.select("doc_id", "text", "begins", "stretch").join(visit, same).groupBy("host").agg(F.min("text").alias("text"))
    guests = one.select(F.lit(None).cast("bigint").alias("doc_id"), "text", signatures(F.col("text")).alias("signatures"), F.lit(None).cast("bigint").alias("begins"), F.col("host").alias("stretch"), F.lit(True).alias("guest"))
    both = placed.withColumn("guest", F.lit(False)).unionByName(guests)
    order = Window.partitionBy("stretch").orderBy("guest", F.col("doc_id").desc_nulls_last(), "text")
    led = both.withColumn("next_text", F.lead("text").over(order)).withColumn("next_signatures", F.lead("signatures").over(order))
    return led.where("not guest").drop("guest", "stretch", "begins")


def edit_report(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next of every row.

    The edited text is the text whose last floor(n_chars / 2) code points are replaced by the first as many (or all) of
    the next row's. A null text counts as empty; a table of one row has itself as next; an empty table gives none; other
    columns are left out whatever their names.
    """
    size = pick(docs, doc_id="bigint").count()
    led = with_next(fingerprints(docs), size)
    n, half = F.length("text"), F.floor(F.length("text") / 2).cast("int")
    edited = F.concat(F.substring(F.col("text"), F.lit(1), n - half), F.substring(F.col("next_text"), F.lit(1), half))
    rows = led.select("doc_id", n.cast("bigint").alias("n_chars"), "signatures", "next_signatures", edited.alias("edited"))
    rows = rows.withColumn("edited_signatures", signatures(F.col("edited")))
    return rows.select(
        "doc_id",
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        as_string(F.col("signatures")).alias("fingerprint"),
        as_string(F.col("edited_signatures")).alias("edited_fingerprint"),
        likeness(F.col("signatures"), F.col("edited_signatures")).alias("near_edited"),
        likeness(F.col("signatures"), F.col("next_signatures")).alias("near_next"),
    )


def near_pairs(docs: DataFrame, threshold: float = 0.8) -> tuple[DataFrame, DataFrame]:
    """Pairs (a, b, likeness) of fingerprint classes whose likeness reaches the threshold, and membership (doc_id, class).

    A class is all documents with equal fingerprints, named by its smallest doc_id; documents without a signature are in
    none. Lengths are partitioned so that one partition's longest is below its shortest over the threshold: a set meets
    its own partition and the next. Of a set of n signatures the n - ceil(threshold n) + 1 rarest are looked up, for two
    sets that reach the threshold share one of those; equally rare ones go by their numbers. Rows with a null id take no
    part, a null text counts as empty, repeated rows are one member each. An empty table gives two empty ones; other columns
    are left out whatever their names.
    """
    prints = materialise(fingerprints(docs).where("doc_id is not null and size(signatures) > 0").select("doc_id", "signatures"), "spotsigs")
    classes = materialise(prints.groupBy("signatures").agg(F.min("doc_id").alias("class")), "spotsig-classes")
    membership = prints.join(classes, "signatures").select("doc_id", "class")
    terms = classes.select("class", F.size("signatures").alias("n"), F.explode("signatures").alias("s"))
    rarity = terms.groupBy("s").agg(F.count(F.lit(1)).alias("df"))
    partition = F.floor(F.log("n") / F.lit(-math.log(threshold)) + 1e-9).cast("int")
    wanted = F.col("n") - F.ceil(F.col("n") * threshold - 1e-9) + 1
    rarest = Window.partitionBy("class").orderBy("df", "s")
    looked = terms.join(rarity.where("df > 1"), "s").withColumn("r", F.row_number().over(rarest) + F.lit(0))
    unshared = terms.join(rarity.where("df = 1"), "s").groupBy("class").agg(F.count(F.lit(1)).alias("alone"))
    looked = looked.join(unshared, "class", "left").where(F.col("r") + F.coalesce("alone", F.lit(0)) <= wanted).select("class", "n", "s", partition.alias("part"))
    left = looked.select(F.col("class").alias("a"), F.col("n").alias("n_a"), "s", F.explode(F.array("part", F.col("part") + 1)).alias("part"), F.col("part").alias("own"))
    right = looked.select(F.col("class").alias("b"), F.col("n").alias("n_b"), "s", "part")
    met = left.join(right, ["s", "part"]).where((F.col("part") > F.col("own")) | (F.col("a") < F.col("b")))
    met = met.where(F.least("n_a", "n_b") >= threshold * F.greatest("n_a", "n_b") - 1e-9).select("a", "b").distinct()
    sets = classes.select(F.col("class"), "signatures")
    both = met.join(sets.select(F.col("class").alias("a"), F.col("signatures").alias("x")), "a").join(sets.select(F.col("class").alias("b"), F.col("signatures").alias("y")), "b")
    pairs = both.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), likeness(F.col("x"), F.col("y")).alias("likeness"))
    return pairs.where(F.col("likeness") >= threshold), membership
