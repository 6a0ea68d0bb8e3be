"""Secret scans with corpus-wide ownership frequency.

Three base kinds of span (assignments, access keys, long hex strings) are found
in every whole text. A fourth kind, ``bare``, is a long run of letters, digits
and signs with both a letter and a digit that touches no base span: a candidate,
nothing more. All candidates are hashed, and for each hash the distinct
repositories and distinct owners that hold it are counted over the whole corpus.
A value that many owners share, or that is in many repositories, is a widely
copied example; a value of few owners in few repositories looks live. Bare candidates become spans only when they look live; base spans
stay whatever the counts, which only tell examples from live-looking ones.

Only DataFrame and SQL functions: positions come from the lengths of what a
regular expression matches and of what lies between the matches. The values
themselves are hashed where they are found and never leave the scan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize, pick

#: kind, expression, group that holds the secret, least length of it; in order of output. An expression
#: with the length in it gives the same spans: its matches are maximal runs of one class of characters.
KINDS = [
    ("assign", r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 1, 6),
    ("access", r"AKIA[A-Z0-9]+", 0, 20),
    ("hex", r"[0-9a-f]{24,}", 0, 24),
    ("bare", r"[A-Za-z0-9+/_=-]{28,}", 0, 28),
]
#: Matches of a text that are walked together.
BLOCK = 64
#: A value that as many owners hold, or that is in as many repositories, is an example.
MANY_OWNERS, MANY_REPOS = 3, 6


def spans(text: Column, no: int) -> Column:
    """Structs (start, no, end, value) of one kind's leftmost non-overlapping matches, in code points."""
    _, regex, group, least = KINDS[no]
    pairs = "array<struct<start:int,end:int>>"
    matches = F.regexp_extract_all(text, F.lit(regex), F.lit(0))
    values = F.regexp_extract_all(text, F.lit(regex), F.lit(1)) if group else matches
    # one more gap than matches: the last has no hit and ends the walk
    pieces = F.arrays_zip(F.split(text, regex, -1).alias("gap"), matches.alias("hit"))
    length = lambda x: F.length(x["gap"]) + F.coalesce(F.length(x["hit"]), F.lit(0))

    def step(acc: Column, x: Column) -> Column:
        end = acc["at"] + length(x)
        more = F.concat(acc["out"], F.array(F.struct((acc["at"] + F.length(x["gap"])).alias("start"), end.alias("end"))))
        return F.struct(end.alias("at"), F.when(x["hit"].isNull(), acc["out"]).otherwise(more).alias("out"))

    def walked(p: Column) -> Column:
        """Block by block of matches, each from where it begins: an array that grows is copied within a block only."""
        blocks = F.sequence(F.lit(0), F.floor((F.size(p) - 1) / BLOCK).cast("int"))
        of = lambda c: F.slice(p, c * BLOCK + 1, F.lit(BLOCK))
        sizes = F.transform(blocks, lambda c: F.aggregate(of(c), F.lit(0), lambda n, x: n + length(x)))
        empty = F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("all"))
        begins = F.aggregate(sizes, empty, lambda acc, n: F.struct((acc["at"] + n).alias("at"), F.concat(acc["all"], F.array(acc["at"])).alias("all")))["all"]
        zero = lambda at: F.struct(at.alias("at"), F.array().cast(pairs).alias("out"))
        return F.flatten(F.zip_with(begins, blocks, lambda at, c: F.aggregate(of(c), zero(at), step, lambda acc: acc["out"])))

    walk = F.transform(F.array(pieces), walked)[0]
    both = F.zip_with(walk, values, lambda s, v: F.struct(s["start"].alias("start"), F.lit(no).alias("no"), s["end"].alias("end"), v.alias("value")))
    long = F.filter(both, lambda s: F.length(s["value"]) >= least)
    hashed = F.transform(long, lambda s: F.struct(s["start"].alias("start"), s["no"].alias("no"), s["end"].alias("end"), F.sha2(s["value"].cast("binary"), 256).alias("h"), (s["value"].rlike("[0-9]") & s["value"].rlike("[A-Za-z]")).alias("mixed")))
    none = F.array().cast("array<struct<start:int,no:int,end:int,h:string,mixed:boolean>>")
    return F.when(F.coalesce(text.rlike(regex), F.lit(False)), hashed).otherwise(none)


def scan(docs: DataFrame, owner: str, repository: str) -> DataFrame:
    """``doc_id, key, owner, repo, base, bare`` of each row: its spans, without any text."""
    t = pick(docs, "doc_id", "text", owner, repository).toDF("doc_id", "text", "owner", "repo")
    t = t.withColumn("key", F.xxhash64("text"))
    t = t.select("doc_id", "key", "owner", "repo", F.array_sort(F.concat(*[spans(F.col("text"), k) for k in range(3)])).alias("base"), spans(F.col("text"), 3).alias("bare"))
    apart = F.filter("bare", lambda b: b["mixed"] & ~F.exists("base", lambda s: (s["start"] < b["end"]) & (b["start"] < s["end"])))
    return t.withColumn("bare", apart)


def ownership(candidates: DataFrame) -> DataFrame:
    """``h, n_owners, n_repos`` of each value hash, from ``h, owner, repo``: distinct ones, counted step by step."""
    each = candidates.select("h", "owner", "repo").distinct()
    per_owner = each.groupBy("h", "owner").agg(F.count("*").alias("r"))
    return per_owner.groupBy("h").agg(F.count("*").alias("n_owners"), F.sum("r").alias("n_repos"))


def find(docs: DataFrame, owner: str = "source", repository: str = "lang", many: int = MANY_OWNERS, many_repos: int = MANY_REPOS) -> DataFrame:
    """One row per document: ``doc_id, base, spans, n_live, n_examples``.

    ``base`` and ``spans`` are arrays of (start, no, end, h, mixed), sorted by
    start, then kind. A repository is a value of ``repository`` at one owner;
    null owners and repositories count as one each. Null and empty texts have
    no spans; repeated rows each get theirs; an empty table gives no rows.
    """
    rows = materialize(scan(docs, owner, repository))
    cands = rows.select("doc_id", "key", "owner", "repo", F.explode(F.concat("base", "bare")).alias("s")).select("doc_id", "key", "owner", "repo", "s", F.col("s.h").alias("h"))
    known = cands.drop("owner", "repo").distinct().join(ownership(cands), "h")
    live = (F.col("n_owners") < many) & (F.col("n_repos") < many_repos)
    added = F.array_sort(F.collect_set(F.when(live & (F.col("s.no") == 3), F.col("s"))))
    per = known.groupBy("doc_id", "key").agg(added.alias("added"), F.count_if(live & (F.col("s.no") < 3)).alias("n_live"), F.count_if(~live).alias("n_examples"))
    per = per.withColumnsRenamed({"doc_id": "id2", "key": "key2"})
    out = rows.join(per, rows["doc_id"].eqNullSafe(per["id2"]) & (rows["key"] == per["key2"]), "left")
    every = F.when(F.col("added").isNull(), F.col("base")).otherwise(F.array_sort(F.concat("base", "added")))
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long")
    return out.select("doc_id", "base", every.alias("spans"), zero("n_live").alias("n_live"), zero("n_examples").alias("n_examples"))


def rendered(spans_: str) -> Column:
    """kind:start:end of an array of spans, comma-joined."""
    names = F.array(*[F.lit(k[0]) for k in KINDS])
    return F.array_join(F.transform(spans_, lambda s: F.concat_ws(":", F.element_at(names, s["no"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")


def of_kind(spans_: str, no: int) -> Column:
    return F.size(F.filter(spans_, lambda s: s["no"] == no)).cast("long")
