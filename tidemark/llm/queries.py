"""The registered queries of the corpus operators and the SQL each is checked against."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.llm import alignment, bilinear, bitsliced, bpe, hard_negatives, langid, license_scan, packing, quality_classifier, simhash, url_filter, warc
from tidemark.llm.common import table
from tidemark.llm.quality_rules import quality_rules
from tidemark.session import scratch_path

QUERIES, SQL = {}, {}


# host/path rules and their verdicts.
URL_RULES = {
    "com/": "allow", "example.com/en/": "block", "www.example.com/en/": "allow", "net/es/": "block", "net/fr/": "block",
}


def op1_url_filter(spark, folder):
    """Verdict on every page's URL."""
    return url_filter.url_verdicts(table(spark, folder, "pages"), URL_RULES).drop("score")


def _url_filter_sql() -> str:
    """The rules, both models and the calibration, level by level."""
    longest = sorted(URL_RULES, key=len, reverse=True)
    fits = {
        r: "(host = '{0}' OR host LIKE '%.{0}') AND starts_with(path, '/{2}')".format(*r.partition("/")) for r in longest
    }
    case = lambda value: "CASE " + " ".join(f"WHEN {fits[r]} THEN '{value(r)}'" for r in longest) + " END"
    levels, before = [], {"a": "1.0 / 128", "r": "1.0 / 128"}
    for k in range(1, 5):
        levels.append(f"""t{k} AS (
  SELECT right(run, {k}) AS tail, sum(a) AS ac, sum(r) AS rc FROM c0 GROUP BY 1
), x{k} AS (
  SELECT left(tail, {k - 1}) AS context, sum(ac) AS an, sum(rc) AS rn,
    count(*) FILTER (ac > 0) AS ad, count(*) FILTER (rc > 0) AS rd FROM t{k} GROUP BY 1
), l{k} AS (
  SELECT p.run, {", ".join(f"CASE WHEN {c}n = 0 THEN {before[c]} ELSE ({c}c + {c}d * ({before[c]})) / ({c}n + {c}d) END AS p{c}" for c in "ar")}
  FROM {"c0" if k == 1 else f"l{k - 1}"} p JOIN t{k} ON tail = right(p.run, {k}) JOIN x{k} ON context = left(right(p.run, {k}), {k - 1})
)""")
        before = {"a": "p.pa", "r": "p.pr"}
    nl = ",\n"
    return f"""
WITH u AS (
  SELECT page_id, translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 1), ''),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 2), '') AS path
  FROM pages
), j AS (
  SELECT *, {case(lambda r: r)} AS rule, {case(lambda r: URL_RULES[r])} AS ruled FROM u
), d AS (
  SELECT host, path, any_value(ruled) AS v, count(*) AS n FROM j WHERE host <> '' OR path <> '' GROUP BY 1, 2
), g AS (
  SELECT host, path, v, n, substr(repeat(chr(2), 3) || host || path || chr(3), i, 4) AS run
  FROM (SELECT *, unnest(range(1, length(host || path) + 2)) AS i FROM d)
), c0 AS (
  SELECT run, CAST(coalesce(sum(n) FILTER (v = 'allow'), 0) AS DOUBLE) AS a,
    CAST(coalesce(sum(n) FILTER (v = 'block'), 0) AS DOUBLE) AS r FROM g GROUP BY 1
), {nl.join(levels)}, s AS (
  SELECT host, path, v, n, avg(log2(pa) - log2(pr)) AS score FROM g JOIN l4 USING (run) GROUP BY 1, 2, 3, 4
), b AS (
  SELECT CAST(floor(greatest(-8.0, least(8.0, score)) / 0.01) AS INTEGER) AS bin,
    coalesce(sum(n) FILTER (v = 'allow'), 0) AS allow, coalesce(sum(n) FILTER (v = 'block'), 0) AS block
  FROM s WHERE v IS NOT NULL GROUP BY 1
), e AS (
  SELECT CASE WHEN lead(bin) OVER w IS NULL THEN bin + 1 ELSE greatest(bin + 1, least(0, lead(bin) OVER w)) END AS border,
    sum(allow) OVER w / sum(allow) OVER () + (sum(block) OVER () - sum(block) OVER w) / sum(block) OVER () AS error
  FROM b WHERE (SELECT sum(allow) > 0 AND sum(block) > 0 FROM b) WINDOW w AS (ORDER BY bin)
  UNION ALL SELECT min(bin), 1.0 FROM b HAVING min(bin) IS NOT NULL AND sum(allow) > 0 AND sum(block) > 0
), best AS (
  SELECT coalesce((SELECT border FROM e ORDER BY error, abs(border), border LIMIT 1), 0) * 0.01 AS least
)
SELECT page_id, j.host, j.path, rule,
  coalesce(ruled, CASE WHEN score >= (SELECT least FROM best) THEN 'allow' ELSE 'block' END) AS verdict
FROM j LEFT JOIN s ON j.host = s.host AND j.path = s.path
"""


QUERIES["op1_url_filter"] = op1_url_filter
SQL["op1_url_filter"] = _url_filter_sql()


def op2_bpe(spark, folder):
    """Token count and digests of the ids and of the decoded text of every document."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return bpe.encode_decode(docs, digests=True)


QUERIES["op2_bpe"] = op2_bpe


def op3_quality_classifier(spark, folder):
    """Posterior quality of every document; its source is the host, the language section the path."""
    docs = table(spark, folder, "documents")
    labels = table(spark, folder, "labels")
    return quality_classifier.classify(docs, labels, F.col("source"), F.col("lang"))


QUERIES["op3_quality_classifier"] = op3_quality_classifier


def op4_license_scan(spark, folder):
    """Every paragraph of the documents that states a licence."""
    return license_scan.license_scan(table(spark, folder, "documents").select("doc_id", "text"))


QUERIES["op4_license_scan"] = op4_license_scan


def op5_warc(spark, folder):
    """One WARC record per page, as read back from the archives."""
    return warc.round_trip(table(spark, folder, "pages"), scratch_path(spark, "warc"), min_bytes=0)


QUERIES["op5_warc"] = op5_warc
SQL["op5_warc"] = """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS h FROM pages
), d AS (
  SELECT page_id, CAST(strlen(html) AS BIGINT) AS payload_bytes, array_to_string(list_transform(range(0, 32), lambda k:
    substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
      1 + (CAST('0x' || substr(h, 1 + 5 * (k // 4), 5) AS INTEGER) >> (15 - 5 * (k % 4))) % 32, 1)), '') AS payload_digest
  FROM p
), m AS (
  SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS last FROM d
)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id = last THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> last THEN last END AS refers_to
FROM m
"""


def op6_simhash(spark, folder):
    """Fingerprint and near-duplicate component of every document."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    groups = simhash.simhash_groups(docs, size=4, distance=4)
    return groups.select(
        F.col("id").alias("doc_id"), simhash.fingerprint_text(F.col("fp")).alias("fingerprint"),
        F.col("component").alias("component_id"),
    )


QUERIES["op6_simhash"] = op6_simhash


def op7_packing(spark, folder):
    """Every document's pieces placed in sequences of at most 2048 tokens."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return packing.pack(docs, capacity=2048)


QUERIES["op7_packing"] = op7_packing


def op8_language_id(spark, folder):
    """Language of every document, learned from the documents not held out."""
    docs = table(spark, folder, "documents").select("doc_id", "text", "lang")
    return langid.identify(docs)


QUERIES["op8_language_id"] = op8_language_id


def op9_quality_rules(spark, folder):
    """Measurements and verdicts of the current policy for every document."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return quality_rules(docs).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        "failed",
    )


QUERIES["op9_quality_rules"] = op9_quality_rules
SQL["op9_quality_rules"] = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text,
    list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM documents
), win AS (
  SELECT doc_id, i, array_to_string(w[i:i + 7], ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 6)) AS i FROM d WHERE len(w) >= 8)
), twice AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS c FROM win) WHERE c > 1
), covered AS (
  SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + 8)) AS p FROM twice) GROUP BY 1
), m AS (
  SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words,
    CAST(len(array_to_string(w, '')) AS BIGINT) AS word_chars,
    CAST(len(text) - len(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
    CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
    CAST(len(lines) AS BIGINT) AS n_lines, CAST(coalesce(c.n, 0) AS BIGINT) AS n_repeat_words,
    CAST(len(regexp_replace(text, '[^\p{L}]', '', 'g')) AS BIGINT) AS n_letters,
    CAST(len(regexp_replace(text, '[^\p{Lu}]', '', 'g')) AS BIGINT) AS n_capitals,
    CAST(len(list_filter(w, lambda x: suffix(x, '!!'))) AS BIGINT) AS n_bang_words
  FROM d LEFT JOIN covered c ON d.doc_id = c.doc_id
), f AS (
  SELECT *, CAST(
    CASE WHEN n_words < 20 THEN 1 ELSE 0 END
    + CASE WHEN 100 * n_repeat_words > 30 * n_words THEN 2 ELSE 0 END
    + CASE WHEN 10 * n_symbols > word_chars THEN 4 ELSE 0 END
    + CASE WHEN 100 * n_dup_lines > 60 * n_lines THEN 8 ELSE 0 END
    + CASE WHEN word_chars < 2 * n_words OR word_chars > 15 * n_words THEN 16 ELSE 0 END
    + CASE WHEN 2 * n_capitals > n_letters THEN 32 ELSE 0 END
    + CASE WHEN 3 * n_bang_words > n_words THEN 64 ELSE 0 END
    + CASE WHEN 2 * n_letters < word_chars THEN 128 ELSE 0 END AS BIGINT) AS failed
  FROM m
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  failed & 3 <> 0 AS base_failed, failed = 0 AS kept, failed
FROM f
"""


def op10_exact_top_k(spark, folder):
    """The five rows with the largest inner products for every fiftieth vector."""
    vectors = table(spark, folder, "embeddings").select("vec_id", "embedding")
    return bitsliced.top_k(vectors, F.col("id") % 50 == 0, k=5)


QUERIES["op10_exact_top_k"] = op10_exact_top_k
SQL["op10_exact_top_k"] = """
WITH v AS (
  SELECT vec_id, CAST(list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS DOUBLE[]) AS q FROM embeddings
), s AS (
  SELECT a.vec_id AS query_id, b.vec_id, CAST(list_dot_product(a.q, b.q) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0
), r AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS n FROM s
)
SELECT query_id, CAST(n AS INTEGER) AS rank, vec_id, score FROM r WHERE n <= 5
"""


def op11_language_scores(spark, folder):
    """Log-probabilities of every document by word counts and by the log-bilinear model."""
    return bilinear.language_scores(table(spark, folder, "documents").select("doc_id", "text"))


QUERIES["op11_language_scores"] = op11_language_scores


def op12_hard_negatives(spark, folder):
    """Five rows of other labels just below each of the five nearest rows of every hundredth vector's label."""
    vectors = table(spark, folder, "embeddings")
    label = F.expr("CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END")
    return hard_negatives.hard_negatives(vectors, F.col("id") % 100 == 0, label)


QUERIES["op12_hard_negatives"] = op12_hard_negatives
SQL["op12_hard_negatives"] = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    CAST(list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS DOUBLE[]) AS q
  FROM embeddings
  WHERE label IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)
), s AS (
  SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, CAST(list_dot_product(a.q, b.q) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0
), p AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
), n AS (
  SELECT anchor_id, positive_id, vec_id AS negative_id, positive_score, score AS negative_score,
    CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank
  FROM p JOIN s USING (anchor_id)
  WHERE NOT same AND 80 * positive_score <= 100 * score AND score <= positive_score
)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 5
"""


def op13_alignment(spark, folder):
    """Groups, links and corpus-wide link counts of two tokenizers over every document."""
    return alignment.alignment_counts(table(spark, folder, "documents").select("doc_id", "text"))


QUERIES["op13_alignment"] = op13_alignment
