"""URL filters by association rules.

URLs are sets of tokens (the host's last label, its last two, further labels
with their place, words of labels that have several, path segments, query keys,
file extension); nothing is said by two of them. From labelled URLs, FP-growth
mines token combinations together with the label tokens; combinations that
predict ``block`` or ``allow`` with enough support and confidence, and more surely
than any of their parts, become rules. A rule is filed in an inverted index under
its rarest token; a URL's tokens fetch the rules, which are verified as subsets,
and the surest one decides.

Only DataFrame functions and Spark's own FP-growth are used.
"""

from __future__ import annotations

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import broadcastable, materialize

#: (host suffix, path prefix, verdict)
Rule = tuple[str, str, str]
MIN_SUPPORT, MIN_CONFIDENCE, MIN_GAIN = 0.002, 0.8, 0.02
#: A combination is in so many labelled rows at least, however few there are; and has at most so many tokens.
MIN_ROWS, MAX_TOKENS = 5, 4
MAX_LABELLED = 200_000
#: FP-growth mines rows of at most so many tokens.
SHORT = 16
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a URL; both empty for null or without ``://``."""
    rest = F.when(F.instr(url, "://") > 0, F.expr("substring({0}, instr({0}, '://') + 3)".format("__url")))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    blank = lambda c: F.coalesce(c, F.lit(""))
    return blank(F.translate(host, UPPER, LOWER)), blank(path)


def split_url(df: DataFrame, url: str = "url") -> DataFrame:
    """``df`` with ``host`` and ``path``."""
    host, path = host_path(F.col("__url"))
    return df.withColumn("__url", F.col(url)).withColumn("host", host).withColumn("path", path).drop("__url")


def tokens(host: Column, path: Column, url: Column) -> Column:
    """The distinct tokens of a URL, sorted."""
    labels = F.reverse(F.split(host, r"\."))
    last = F.when(labels[0] != "", F.array(F.concat(F.lit("h0="), labels[0]))).otherwise(F.array())
    pair = F.when(F.size(labels) >= 2, F.array(F.concat(F.lit("hh="), labels[1], F.lit("."), labels[0]))).otherwise(F.array())
    placed = F.when(F.size(labels) > 2, F.transform(F.slice(labels, F.lit(3), F.size(labels) - 2), lambda x, i: F.concat(F.lit("h"), (i + 2).cast("string"), F.lit("="), x))).otherwise(F.array())
    several = F.filter(labels, lambda x: x.rlike("[a-z0-9][^a-z0-9]+[a-z0-9]"))
    words = F.transform(F.flatten(F.transform(several, lambda x: F.regexp_extract_all(x, F.lit("[a-z0-9]+"), F.lit(0)))), lambda x: F.concat(F.lit("w="), x))
    segments = F.filter(F.split(path, "/"), lambda x: x != "")
    first = F.when(F.size(segments) >= 1, F.array(F.concat(F.lit("p1="), segments[0]))).otherwise(F.array())
    inner = F.when(F.size(segments) > 1, F.transform(F.slice(segments, F.lit(2), F.size(segments) - 1), lambda x: F.concat(F.lit("p="), F.regexp_replace(x, "[0-9]+", "0")))).otherwise(F.array())
    ext = F.transform(F.regexp_extract_all(path, F.lit(r"\.([A-Za-z0-9]+)$"), F.lit(1)), lambda x: F.concat(F.lit("x="), x))
    keys = F.transform(F.regexp_extract_all(F.coalesce(url, F.lit("")), F.lit(r"[?&]([^=&#?]+)="), F.lit(1)), lambda x: F.concat(F.lit("q="), x))
    strings = lambda c: c.cast("array<string>")
    return F.array_sort(F.array_distinct(F.concat(*[strings(c) for c in (last, pair, placed, words, first, inner, ext, keys)])))


def fitting_rule(host: Column, path: Column, rules: list[Rule]) -> Column:
    """The longest (by host and path together) of the rules that fit, as a struct (rule, verdict), or null."""
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for h, p, verdict in sorted(rules, key=lambda r: (len(r[0]) + len(r[1]), len(r[0]))):
        fits = ((host == h) | host.endswith(f".{h}")) & path.startswith(p)
        out = F.when(fits, F.struct(F.lit(h + p).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


def alike(items: DataFrame) -> DataFrame:
    """``t, rep, count``: each token with the least one of those that are in exactly the same rows (``toks, verdict``), and in how many.

    Two sums over hashes of the rows name the rows that a token is in; equal rows have equal tokens.
    """
    row = items.select("toks", F.xxhash64("toks", "verdict").cast("decimal(38,0)").alias("x"), F.xxhash64("verdict", "toks").cast("decimal(38,0)").alias("y"))
    each = row.select(F.explode("toks").alias("t"), "x", "y").groupBy("t").agg(F.count("*").alias("count"), F.sum("x").alias("x"), F.sum("y").alias("y"))
    reps = each.groupBy("count", "x", "y").agg(F.min("t").alias("rep"))
    return each.join(reps, ["count", "x", "y"]).select("t", "rep", "count")


def grown(items: DataFrame, n: int, share: float, min_confidence: float, max_tokens: int) -> DataFrame:
    """``antecedent, verdict, confidence, support`` by FP-growth over ``items`` (tokens and ``=verdict``)."""
    model = FPGrowth(itemsCol="items", minSupport=share, minConfidence=min_confidence).fit(items)
    found = model.associationRules.where(F.col("consequent")[0].startswith("=") & (F.size("antecedent") <= max_tokens) & ~F.exists("antecedent", lambda t: t.startswith("=")))
    return found.select(F.array_sort("antecedent").alias("antecedent"), F.substr(F.col("consequent")[0], F.lit(2)).alias("verdict"), "confidence", "support")


def levelled(items: DataFrame, n: int, share: float, min_confidence: float, max_tokens: int) -> DataFrame:
    """The same token by token, so that no combination of over ``max_tokens`` tokens is ever made.

    A frequent combination of a row grows by the row's later tokens; what is
    not frequent with its verdict goes before the next step.
    """
    rows = items.select(F.xxhash64("items").alias("r"), F.element_at("items", -1).alias("v"), F.slice("items", F.lit(1), F.size("items") - 1).alias("toks")).groupBy("r", "v", "toks").agg(F.count("*").alias("m"))
    rows = materialize(rows)
    cur = rows.select("r", "v", "m", "toks", F.explode("toks").alias("t")).withColumn("antecedent", F.array("t"))
    out = None
    for size in range(1, max_tokens + 1):
        had = cur.groupBy("antecedent").agg(F.sum("m").alias("n"))
        often = materialize(cur.groupBy("antecedent", "v").agg(F.sum("m").alias("k")).where(F.col("k") >= share * n - 1e-6).join(had, "antecedent"))
        told = often.select("antecedent", F.substr("v", F.lit(2)).alias("verdict"), (F.col("k") / F.col("n")).alias("confidence"), (F.col("k") / F.lit(n)).alias("support")).where(F.col("confidence") >= min_confidence)
        out = told if out is None else out.unionByName(told)
        if size < max_tokens:
            kept = materialize(cur.join(broadcastable(often.select("antecedent").distinct(), 100_000), "antecedent", "left_semi"))
            later = F.filter("toks", lambda x: x > F.col("t"))
            cur = kept.select("r", "v", "m", "toks", "antecedent", F.explode(later).alias("t")).withColumn("antecedent", F.concat("antecedent", F.array("t")))
    return out


def mine(labelled: DataFrame, min_support: float = MIN_SUPPORT, min_confidence: float = MIN_CONFIDENCE, max_labelled: int = MAX_LABELLED, min_rows: int = MIN_ROWS, max_tokens: int = MAX_TOKENS) -> DataFrame:
    """Rules ``antecedent, verdict, confidence, support, alike`` from ``toks, verdict`` rows.

    Fits on at most ``max_labelled`` rows, those first in hash order of their
    tokens. A combination is frequent that a ``min_support`` share of the rows
    has, and ``min_rows`` of them at least, so few labels give few rules and not
    every combination of theirs; rules have at most ``max_tokens`` tokens.
    Tokens that are rarer are in no rule and taken out before, as are those that
    nearly every URL has. Tokens that are in the same rows, as those of a
    template, count as one; ``alike`` has for each token of a rule those that it stands
    for. FP-growth tells every combination of a row, which ends soon for rows of up to
    ``SHORT`` such tokens; where a row has more the combinations are grown token by
    token, up to ``max_tokens``. No labels, no rules.
    """
    schema = "antecedent array<string>, verdict string, confidence double, support double, alike array<array<string>>"
    spark = labelled.sparkSession
    use = labelled.select("toks", "verdict").orderBy(F.xxhash64("toks", "verdict"), F.array_join("toks", " ")).limit(max_labelled)
    items = materialize(use)
    n = items.count()
    if not n:
        return spark.createDataFrame([], schema)
    share = min(1.0, max(min_support, min_rows / n))
    # at most the mean number of tokens a row over the share, each a short string
    same = materialize(alike(items).where((F.col("count") >= share * n - 1e-6) & (F.col("count") <= 0.95 * n)))
    seen = same.where("t = rep").agg(F.coalesce(F.collect_set("t"), F.array().cast("array<string>")).alias("some"))
    lean = materialize(items.select(F.concat(F.array_intersect("toks", seen.scalar()), F.array(F.concat(F.lit("="), "verdict"))).alias("items")))
    longest = lean.agg(F.max(F.size("items"))).first()[0] - 1
    rules = materialize((grown if longest <= SHORT else levelled)(lean, n, share, min_confidence, max_tokens))
    # prune: a rule has to be surer than each rule on a part of its tokens that says the same
    parts = rules.select(F.explode("antecedent").alias("drop"), "antecedent", "verdict", "confidence").withColumn("part", F.array_except("antecedent", F.array("drop")))
    small = rules.select(F.col("antecedent").alias("part"), "verdict", F.col("confidence").alias("had"))
    beaten = parts.join(small, ["part", "verdict"]).where(F.col("confidence") < F.col("had") + MIN_GAIN).select("antecedent", "verdict").distinct()
    left = rules.join(beaten, ["antecedent", "verdict"], "left_anti")
    groups = same.groupBy("rep").agg(F.array_sort(F.collect_list("t")).alias("alike"))
    named = left.select("antecedent", "verdict", F.posexplode("antecedent").alias("at", "rep")).join(groups, "rep").groupBy("antecedent", "verdict").agg(F.transform(F.array_sort(F.collect_list(F.struct("at", "alike"))), lambda x: x["alike"]).alias("alike"))
    return left.join(named, ["antecedent", "verdict"])


def index(rules: DataFrame, urls: DataFrame) -> DataFrame:
    """The rules with ``token``, the rarest of their tokens among ``urls`` (column ``toks``), as the index key."""
    numbered = rules.withColumn("rule_no", F.xxhash64("antecedent", "verdict"))
    wanted = numbered.select(F.explode("antecedent").alias("token")).distinct()
    freq = urls.select(F.explode("toks").alias("token")).join(broadcastable(materialize(wanted), 100_000), "token").groupBy("token").agg(F.count("*").alias("n"))
    posted = numbered.select("*", F.explode("antecedent").alias("token")).join(freq, "token", "left").groupBy("rule_no").agg(F.min_by("token", F.struct(F.coalesce("n", F.lit(0)), "token")).alias("token"))
    return numbered.join(posted, "rule_no")


def judge(urls: DataFrame, rules: DataFrame, default: str = "allow") -> DataFrame:
    """``toks, mined`` for each distinct token set of ``urls`` (column ``toks``): the verdict of its surest rule.

    Ties go to the longer, then the better supported rule, then ``block``;
    without a rule the verdict is ``default``.
    """
    distinct = urls.select("toks").distinct().withColumn("id", F.xxhash64("toks"))
    posted = broadcastable(materialize(index(rules, urls).drop("alike")), 20_000)
    said = distinct.select("id", F.explode("toks").alias("token"))
    # a token counts as the one that stands for it
    stands = rules.select(F.explode(F.arrays_zip("antecedent", "alike")).alias("x")).select(F.col("x.antecedent").alias("rep"), F.explode("x.alike").alias("token")).distinct().where("rep != token")
    stands = materialize(stands)
    own = distinct.select("id", "toks")
    if not stands.isEmpty():
        said = said.join(broadcastable(stands, 100_000), "token", "left").select("id", F.coalesce("rep", "token").alias("token")).distinct()
        own = said.groupBy("id").agg(F.collect_set("token").alias("toks"))
    asked = said.join(posted, "token").join(own, "id").where(F.size(F.array_except("antecedent", "toks")) == 0)
    best = asked.groupBy("id").agg(F.max_by("verdict", F.struct("confidence", F.size("antecedent"), "support", "verdict")).alias("mined"))
    return distinct.join(best, "id", "left").select("toks", F.coalesce("mined", F.lit(default)).alias("mined"))


def filter_urls(pages: DataFrame, rules: list[Rule], labelled: DataFrame | None = None, url: str = "url") -> DataFrame:
    """All rows of ``pages`` with ``host, path, rule, verdict, mined``.

    ``rules`` decide where one fits; else the mined association rules do.
    ``labelled`` (url, verdict) are the examples to mine from; where there is
    none, they are the rows that a rule fits, labelled with its verdict. Null
    and malformed URLs have an empty host and path and fit no rule of a host;
    equal URLs get equal verdicts; an empty table gives no rows.
    """
    rows = split_url(pages, url)
    rows = rows.withColumn("toks", tokens(F.col("host"), F.col("path"), F.col(url))).withColumn("fit", fitting_rule(F.col("host"), F.col("path"), rules))
    rows = materialize(rows)
    if labelled is None:
        known = rows.where("fit is not null").select("toks", F.col("fit.verdict").alias("verdict"))
    else:
        known = split_url(labelled).select(tokens(F.col("host"), F.col("path"), F.col("url")).alias("toks"), "verdict")
    mined = judge(rows, mine(known))
    out = rows.join(mined, "toks")
    return out.withColumn("rule", F.col("fit.rule")).withColumn("verdict", F.coalesce("fit.verdict", "mined")).drop("fit", "toks")
