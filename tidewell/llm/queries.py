"""The opN queries over the synthetic tables and, where SQL can say it, their oracles."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import decontam, divergence, html_extract, line_dedup, media, mixing, parity_join, quality, secrets, simhash, toxicity, url_rules, whitening
from .common import pick


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents mixed: 150 % of all words, weights 5, 2, 1, at most twice a source."""
    return mixing.mixed(_table(spark, sf_dir, "documents"))


OP1_SQL = r"""
WITH base AS (SELECT doc_id, source AS src, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size, md5('mix:' || coalesce(doc_id::VARCHAR, '')) AS k FROM {docs}),
s0 AS (SELECT src, sum(size)::BIGINT AS source_size FROM base GROUP BY src),
s1 AS (SELECT *, row_number() OVER (ORDER BY src NULLS LAST) - 1 AS no FROM s0),
s2 AS (SELECT *, CASE no % 3 WHEN 0 THEN 5.0 WHEN 1 THEN 2.0 ELSE 1.0 END::DOUBLE AS w, 2.0::DOUBLE * source_size AS cap FROM s1),
s3 AS (SELECT *, coalesce(sum(cap) OVER before, 0) AS capped, coalesce(sum(w) OVER before, 0) AS spent, sum(source_size) OVER () AS total, sum(w) OVER () AS weight
       FROM s2 WINDOW before AS (ORDER BY cap / w, no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
s4 AS (SELECT *, (1.5::DOUBLE * total - capped) / (weight - spent) AS level FROM s3),
s5 AS (SELECT *, (SELECT level FROM s4 WHERE level * w <= cap ORDER BY cap / w, no LIMIT 1) AS held FROM s4),
s AS (SELECT src, source_size, least(cap, coalesce(held * w, cap)) AS target FROM s5),
q AS (SELECT *, least(floor(target + 0.5), 2 * source_size)::BIGINT AS quota FROM s),
d AS (SELECT base.doc_id, base.size, q.source_size, q.target, q.quota,
             coalesce(sum(base.size) OVER (PARTITION BY q.src ORDER BY base.k, base.doc_id, base.size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS a
      FROM base JOIN q ON base.src IS NOT DISTINCT FROM q.src)
SELECT doc_id, size, source_size, target,
       (greatest(0, least(a + size, quota) - a) + greatest(0, least(a + size, quota - source_size) - a))::BIGINT AS taken FROM d
"""


def op2_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page, with weights learned from pages whose markup names it."""
    pages = pick(_table(spark, sf_dir, "pages"), "page_id", "url", "html")
    out = html_extract.extract_all(pages, html_extract.fit(pages))
    return out.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines whose key is in at least ten documents are gone from every document."""
    out = line_dedup.drop_lines(pick(_table(spark, sf_dir, "documents"), "doc_id", "text"), min_docs=10)
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


OP3_SQL = """
WITH docs AS (SELECT doc_id, row_number() OVER () AS r, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
lines AS (SELECT doc_id, r, unnest(ls) AS line, generate_subscripts(ls, 1) AS i FROM docs),
keyed AS (SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k FROM lines),
often AS (SELECT k FROM keyed WHERE k <> '' GROUP BY k HAVING count(DISTINCT r) >= 10)
SELECT any_value(doc_id) AS doc_id, count(*)::BIGINT AS n_lines, count(often.k)::BIGINT AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (often.k IS NULL), '')) AS kept_sha256
FROM keyed LEFT JOIN often ON keyed.k = often.k GROUP BY r
"""


def op4_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every whole text as an ISO media container, and what is read back from it."""
    docs = pick(_table(spark, sf_dir, "documents"), "doc_id", "text").withColumn("n_bytes", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long"))
    seen = media.inspect(media.store(docs).drop("text"))
    return seen.select("doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature")


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row for each document and class of benchmark items that it holds, whatever their numbers and names."""
    out = decontam.contaminations(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return out.select("doc_id", "item_id", "n_items", F.col("item_words").cast("long").alias("item_words"), "n_windows", "covered")


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every whole text, learned from the labelled rows that are not held out."""
    held_out = toxicity.held_out(3, 1)
    labels = pick(_table(spark, sf_dir, "labels"), "doc_id", "quality").where(~held_out).withColumnRenamed("quality", "label")
    scored = quality.classify(_table(spark, sf_dir, "documents"), labels)
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op7_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every whole text; owners are sources, repositories their languages."""
    found = secrets.find(_table(spark, sf_dir, "documents"))
    base = secrets.rendered("base")
    return found.select(
        "doc_id", secrets.of_kind("base", 0).alias("n_assign"), secrets.of_kind("base", 1).alias("n_access"), secrets.of_kind("base", 2).alias("n_hex"),
        F.sha2(base.cast("binary"), 256).alias("base_sha256"), secrets.rendered("spans").alias("spans"), "n_live", "n_examples",
    )


def _op7_sql() -> str:
    parts = []
    for no, (kind, regex, group, least) in enumerate(secrets.KINDS):
        rx = "'" + regex.replace("'", "''") + "'"
        parts.append(f"""SELECT r, {no} AS no, '{kind}' AS kind, unnest(regexp_extract_all(t, {rx}, {group})) AS v, unnest(regexp_extract_all(t, {rx})) AS m, unnest(regexp_split_to_array(t, {rx})[:-2]) AS g, unnest(range(len(regexp_extract_all(t, {rx})))) AS i, {least} AS least FROM d WHERE regexp_matches(t, {rx})""")
    union = " UNION ALL ".join(parts)
    return f"""
WITH d AS (SELECT doc_id, source, lang, coalesce(text, '') AS t, row_number() OVER () AS r FROM documents),
u AS ({union}),
p AS (SELECT *, (sum(length(g) + length(m)) OVER (PARTITION BY r, no ORDER BY i))::BIGINT AS e FROM u),
c AS (SELECT r, no, kind, e - length(m) AS s, e, v FROM p WHERE length(v) >= least),
b AS (SELECT * FROM c WHERE no < 3),
x AS (SELECT * FROM c WHERE no = 3 AND regexp_matches(v, '[0-9]') AND regexp_matches(v, '[A-Za-z]') AND NOT EXISTS (SELECT 1 FROM b WHERE b.r = c.r AND b.s < c.e AND c.s < b.e)),
a AS (SELECT * FROM b UNION ALL SELECT * FROM x),
o AS (SELECT v, count(DISTINCT coalesce(source, chr(0))) AS owners, count(DISTINCT (coalesce(source, chr(0)), coalesce(lang, chr(0)))) AS repos FROM a JOIN d USING (r) GROUP BY v),
k AS (SELECT a.*, owners < {secrets.MANY_OWNERS} AND repos < {secrets.MANY_REPOS} AS live FROM a JOIN o USING (v)),
g AS (SELECT r, count(*) FILTER (no = 0) AS n0, count(*) FILTER (no = 1) AS n1, count(*) FILTER (no = 2) AS n2,
             string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, no) FILTER (no < 3) AS base,
             string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, no) FILTER (no < 3 OR live) AS spans,
             count(*) FILTER (no < 3 AND live) AS n_live, count(*) FILTER (NOT live) AS n_examples FROM k GROUP BY r)
SELECT doc_id, coalesce(n0, 0)::BIGINT AS n_assign, coalesce(n1, 0)::BIGINT AS n_access, coalesce(n2, 0)::BIGINT AS n_hex, sha256(coalesce(base, '')) AS base_sha256,
       coalesce(spans, '') AS spans, coalesce(n_live, 0)::BIGINT AS n_live, coalesce(n_examples, 0)::BIGINT AS n_examples FROM d LEFT JOIN g USING (r)
"""


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every whole text, learned from the labelled rows that are not held out."""
    docs = pick(_table(spark, sf_dir, "documents"), "doc_id", "text")
    model = toxicity.fit(docs, toxicity.training_labels(_table(spark, sf_dir, "labels"), "toxic"))
    scored = toxicity.score(docs, model)
    return scored.select("doc_id", toxicity.held_out(5, 0).alias("held_out"), F.col("tox_score").alias("score"), (F.col("tox_score") >= 0.5).cast("int").alias("predicted"))


#: host, path, verdict
URL_RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"), ("net", "/es/", "block"), ("net", "/fr/", "block")]


def op9_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict on every page's url: the longest fitting rule's, else that of the mined token combinations."""
    out = url_rules.filter_urls(pick(_table(spark, sf_dir, "pages"), "page_id", "url"), URL_RULES)
    return out.select("page_id", "host", "path", "rule", "verdict")


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-duplicate class of every document."""
    return simhash.classes(_table(spark, sf_dir, "documents"), most=3, shingle=3)


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four whitened components of every vector, fitted on all distinct ones."""
    return whitening.whiten(_table(spark, sf_dir, "embeddings"), most=4)


def op12_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How far the sources of each language are apart, and the terms that tell each from its language."""
    return divergence.audit(_table(spark, sf_dir, "documents"), min_docs=10, top=10)


OP12_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                  regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS ts FROM documents),
w AS (SELECT r, lang, source, unnest(ts) AS term FROM d),
g AS (SELECT DISTINCT lang, source FROM d),
kept AS (SELECT lang, term, count(*) AS of_lang FROM w GROUP BY lang, term HAVING count(DISTINCT r) >= 10),
c AS (SELECT w.lang, w.source, w.term, count(*) AS n FROM w JOIN kept USING (lang, term) GROUP BY ALL),
v AS (SELECT lang, count(*) AS kept, sum(of_lang)::BIGINT AS n FROM kept GROUP BY lang),
s AS (SELECT lang, source, sum(n)::BIGINT AS n FROM c GROUP BY ALL),
p AS (SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n, 1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 2)) // (coalesce(s.n, 0) + 2 * v.kept) AS p,
             1 + (1000000000::HUGEINT * (k.of_lang + 2)) // (v.n + 2 * v.kept) AS q
      FROM g JOIN kept k USING (lang) JOIN v USING (lang) LEFT JOIN s USING (lang, source) LEFT JOIN c USING (lang, source, term)),
pairs AS (SELECT a.lang, a.source, b.source AS item, coalesce(sum((x.p - y.p) * (x.p - y.p) // (x.p + y.p)), 0)::BIGINT AS value
          FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN p x ON x.lang = a.lang AND x.source = a.source
          LEFT JOIN p y ON y.lang = b.lang AND y.source = b.source AND y.term = x.term GROUP BY ALL),
terms AS (SELECT lang, source, term AS item, ((p - q) * (p - q) // (p + q))::BIGINT AS value FROM p WHERE n > 0 AND p > q),
o AS (SELECT lang, source, 'pair' AS part, item, value, row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) AS rank FROM pairs
      UNION ALL SELECT lang, source, 'term', item, value, row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) FROM terms)
SELECT lang, source, part, item, value, rank::INTEGER AS rank FROM o WHERE part = 'pair' OR rank <= 10
"""


def op13_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Classes of documents whose distinct three-word shingles have a similarity of 0.9 or more."""
    return parity_join.classes(_table(spark, sf_dir, "documents"), similarity=(90, 100), shingle=3)


OP13_SQL = r"""
WITH RECURSIVE d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
e AS (SELECT r, array_to_string(w[i:i + 2], ' ') AS s FROM (SELECT r, w, unnest(range(1, greatest(1, len(w) - 2) + 1)) AS i FROM d WHERE len(w) > 0)),
t AS (SELECT r, list_sort(list(DISTINCT s)) AS t FROM e GROUP BY r),
n AS (SELECT r, len(t) AS n, min(r) OVER (PARTITION BY t) AS node FROM t),
u AS (SELECT DISTINCT e.r AS node, e.s, n.n FROM e JOIN n ON n.r = e.r AND n.node = e.r),
p AS (SELECT a.node AS x, b.node AS y, a.n + b.n AS size, count(*) AS common FROM u a JOIN u b ON a.s = b.s AND a.node < b.node AND 100 * least(a.n, b.n) >= 90 * greatest(a.n, b.n) GROUP BY ALL),
l AS (SELECT x, y FROM p WHERE 100 * common >= 90 * (size - common) UNION ALL SELECT y, x FROM p WHERE 100 * common >= 90 * (size - common)),
far AS (SELECT DISTINCT x AS a, x AS b FROM l UNION SELECT far.a, l.y FROM far JOIN l ON far.b = l.x),
root AS (SELECT a AS node, min(b) AS root FROM far GROUP BY a),
m AS (SELECT n.r, n.n, coalesce(root.root, n.node) AS root FROM n LEFT JOIN root USING (node)),
low AS (SELECT m.root, min(d.doc_id) AS component_id FROM m JOIN d USING (r) GROUP BY m.root)
SELECT d.doc_id, coalesce(m.n, 0)::BIGINT AS n_shingles, CASE WHEN m.r IS NULL THEN d.doc_id ELSE low.component_id END AS component_id
FROM d LEFT JOIN m USING (r) LEFT JOIN low ON low.root = m.root
"""


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_mixing": op1_mixing,
    "op2_html_extraction": op2_html_extraction,
    "op3_line_dedup": op3_line_dedup,
    "op4_media": op4_media,
    "op5_decontamination": op5_decontamination,
    "op6_quality": op6_quality,
    "op7_secrets": op7_secrets,
    "op8_toxicity": op8_toxicity,
    "op9_url_rules": op9_url_rules,
    "op10_simhash": op10_simhash,
    "op11_whitening": op11_whitening,
    "op12_divergence": op12_divergence,
    "op13_jaccard_join": op13_jaccard_join,
}

ORACLES: dict[str, str] = {
    "op1_mixing": OP1_SQL.format(docs="documents"),
    "op3_line_dedup": OP3_SQL,
    "op7_secrets": _op7_sql(),
    "op12_divergence": OP12_SQL,
    "op13_jaccard_join": OP13_SQL,
}
