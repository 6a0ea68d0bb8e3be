"""How far the sources of a language differ in their words.

A source of a language has a share of each term that is kept, in billionths,
with two occurrences added to each. The divergence of two sources is the sum
over all kept terms of floor((p - q)^2 / (p + q)). Most terms are in few
sources, so it is priced from supports: a histogram of a source's counts prices
its terms against a source without them, one constant prices the terms that
neither has, and only for terms that both have, met by joining their postings,
is the price put right.
"""

from __future__ import annotations

import sys
from collections import Counter

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import broadcastable, materialize, pick, sized_slices

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Shares are told in so many parts.
PARTS = 1_000_000_000
#: Occurrences that each kept term has in advance.
PRIOR = 2
#: Terms that a task counts before it hands its counts on.
HELD = 200_000
#: Bytes that separate terms become blanks and A-Z a-z; all others, those of UTF-8 sequences among them, stay.
_FOLD = bytes(b if b >= 128 or 97 <= b <= 122 else b + 32 if 65 <= b <= 90 else 32 for b in range(256))


def terms(text: bytes) -> list[bytes]:
    """The runs of ASCII letters and other code points above 127 of a text in UTF-8, with A-Z lower-cased."""
    return text.translate(_FOLD).split()


def counts(docs: DataFrame) -> DataFrame:
    """``lang, source, term, n, docs``: occurrences and documents, added up over tasks (``docs``: lang, source, text)."""

    def run(batches):
        n: dict[tuple, Counter] = {}
        docs: dict[tuple, Counter] = {}

        def told():
            for group in n:
                t = list(n[group])  # the empty term stands for the source itself
                cols = [pa.array([group[0]] * len(t), pa.string()), pa.array([group[1]] * len(t), pa.string()), pa.array(t, pa.binary()).cast(pa.string()), pa.array(list(n[group].values()), pa.int64()), pa.array([docs[group][x] for x in t], pa.int64())]
                yield pa.RecordBatch.from_arrays(cols, names=["lang", "source", "term", "n", "docs"])

        for b in sized_slices(batches, 2):
            for lang, source, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).cast(pa.binary()).to_pylist()):
                seen = Counter(terms(text))
                n.setdefault((lang, source), Counter({b"": 0})).update(seen)
                docs.setdefault((lang, source), Counter({b"": 0})).update(seen.keys())
            if sum(map(len, n.values())) > HELD:
                yield from told()
                n, docs = {}, {}
        yield from told()

    each = docs.mapInArrow(run, "lang string, source string, term string, n long, docs long")
    return each.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def _div(a: Column, b: Column) -> Column:
    """Whole-number quotient of longs."""
    return F.call_function("div", a, b)


def share(count: Column, total: Column, kept: Column) -> Column:
    """1 + floor(PARTS * (count + PRIOR) / (total + PRIOR * kept)), in two steps that 64 bits hold up to 9 * 10^13 occurrences."""
    top, low = (count + PRIOR) * 100_000, F.greatest(total + PRIOR * kept, F.lit(1))
    return 1 + _div(top, low) * (PARTS // 100_000) + _div(top % low * (PARTS // 100_000), low)


def gap(p: Column, q: Column) -> Column:
    """floor((p - q)^2 / (p + q)); shares are below 2^31, so 64 bits hold the square."""
    return _div((p - q) * (p - q), p + q)


def _with_groups(df: DataFrame, groups: DataFrame, *on: str) -> DataFrame:
    """Joined with the (few) sources; with a count of them decides whether they are broadcast."""
    return df.join(broadcastable(groups, 100_000), list(on))


def pair_values(postings: DataFrame, groups: DataFrame) -> DataFrame:
    """``lang, source, item, value`` for every two sources of a language, in both orders.

    ``postings``: lang, source, term, p, zero, one row for each term that a
    source has; ``groups``: lang, source, size, kept, terms, zero, one for each source.
    """
    other = groups.select("lang", F.col("source").alias("item"), F.col("zero").alias("other"), F.col("terms").alias("others"))
    apart = "source != item"
    counted = postings.groupBy("lang", "source", "p").agg(F.count("*").alias("often"))
    one = _with_groups(counted, other, "lang").where(apart).groupBy("lang", "source", "item").agg(F.sum(F.col("often") * gap(F.col("p"), F.col("other"))).alias("value"))
    none = _with_groups(groups, other, "lang").where(apart).select("lang", "source", "item", ((F.col("kept") - F.col("terms") - F.col("others")) * F.when(F.col("kept") > 0, gap(F.col("zero"), F.col("other"))).otherwise(0)).alias("value"))
    right = postings.select("lang", "term", F.col("source").alias("item"), F.col("p").alias("q"), F.col("zero").alias("other"))
    p, q, zero, rest = (F.col(c) for c in ("p", "q", "zero", "other"))
    both = postings.select("lang", "source", "term", "p", "zero").join(right, ["lang", "term"]).where("source < item")
    both = both.groupBy("lang", "source", "item").agg(F.sum(gap(p, q) - gap(p, rest) - gap(zero, q) + gap(zero, rest)).alias("value"))
    turned = lambda d: d.select("lang", F.col("item").alias("source"), F.col("source").alias("item"), "value")
    parts = none.unionByName(one).unionByName(turned(one)).unionByName(both).unionByName(turned(both))
    return parts.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))


def audit(docs: DataFrame, min_docs: int = 10, top: int = 10) -> DataFrame:
    """``lang, source, part, item, value, rank``: how far sources of a language are apart, and by which terms a source stands out.

    Part ``pair`` has a row for each other source of the language, part ``term``
    the ``top`` terms that a source has more of than its language, by value and then by UTF-8.
    Terms of at least ``min_docs`` documents of a language are kept. Null
    text, lang and source are empty ones; repeated rows count each; a source without terms has
    its pairs; no documents give no rows. Other columns are ignored.
    """
    empty = F.lit("")
    all_counts = materialize(counts(pick(docs, "lang", "source", "text").select(*[F.coalesce(c, empty).alias(c) for c in ("lang", "source", "text")])))
    words = all_counts.where("term != ''")
    kept = materialize(words.groupBy("lang", "term").agg(F.sum("n").alias("of_lang"), F.sum("docs").alias("d")).where(F.col("d") >= min_docs).drop("d"))
    langs = kept.groupBy("lang").agg(F.count("*").alias("kept"), F.sum("of_lang").alias("lang_size"))
    found = words.join(kept, ["lang", "term"]).select("lang", "source", "term", "n", "of_lang")
    sizes = found.groupBy("lang", "source").agg(F.sum("n").alias("size"), F.count("*").alias("terms"))
    groups = all_counts.where("term = ''").select("lang", "source").join(sizes, ["lang", "source"], "left").join(langs, "lang", "left").na.fill(0)
    groups = materialize(groups.withColumn("zero", share(F.lit(0).cast("long"), F.col("size"), F.col("kept"))))
    sized = _with_groups(found, groups, "lang", "source")
    postings = materialize(sized.select("lang", "source", "term", share(F.col("n"), F.col("size"), F.col("kept")).alias("p"), "zero", share(F.col("of_lang"), F.col("lang_size"), F.col("kept")).alias("q")))
    more = postings.where("p > q").select("lang", "source", F.col("term").alias("item"), gap(F.col("p"), F.col("q")).alias("value"))
    place = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")).alias("rank")
    parts = ("pair", pair_values(postings, groups).select("*", place)), ("term", more.select("*", place).where(F.col("rank") <= top))
    one, two = (d.select("lang", "source", F.lit(name).alias("part"), "item", "value", "rank") for name, d in parts)
    return one.unionByName(two)
