"""The registered queries of this package, one per operator, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierline.llm import (
    byte_bpe,
    decontam,
    divergence,
    html_text,
    language,
    orchard,
    pii,
    quality_rules,
    ring,
    simhash,
    sketch,
    token_file,
    url_reputation,
)
from tierline.llm.common import table
from tierline.session import scratch_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


@query
def op9_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe.document_digests(
        table(spark, sf_dir, "documents"),
        public_tokenizers.path("byte_bpe_multi_50k.tiktoken"),
        public_tokenizers.PATTERN,
    )


@query
def op3_token_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "token-file")
    token_file.tokenize_to_file(
        table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), end_id=1, path=path
    )
    return token_file.read_token_file(spark, path, with_ids=False)


@query
def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id")


@query
def op8_bottom_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = sketch.with_next_sketch(table(spark, sf_dir, "documents"))
    half = F.floor(F.length("text") / 2).cast("int")
    edited = F.concat(F.left("text", F.length("text") - half), F.left("next_text", half))
    rows = rows.select("doc_id", "sketch", "next_sketch", F.length("text").cast("long").alias("n_chars"), edited.alias("edited"))
    rows = rows.select("*", sketch.sketch("edited").alias("edited_sketch"))
    return rows.select(
        "doc_id",
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        sketch.to_text("sketch").alias("fingerprint"),
        sketch.to_text("edited_sketch").alias("edited_fingerprint"),
        sketch.resemblance("sketch", "edited_sketch").alias("near_edited"),
        sketch.resemblance("sketch", "next_sketch").alias("near_next"),
    )


@query
def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.overlaps(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


#: Without seeds: every alignment that enough equal words support, its best stretch of 13 words.
ORACLE["op4_decontamination"] = """
WITH d AS (
  SELECT doc_id, list_filter(regexp_split_to_array(lower(text), '[^\\p{L}\\p{N}]+'), lambda x: x <> '') AS w FROM documents
), i AS (
  SELECT min(item_id) AS item_id, w, len(w) AS n, least(len(w), 13) AS l
  FROM (SELECT item_id, list_filter(regexp_split_to_array(lower(text), '[^\\p{L}\\p{N}]+'), lambda x: x <> '') AS w FROM benchmark)
  WHERE len(w) >= 5 GROUP BY w
), dw AS (SELECT doc_id, unnest(w) AS word, unnest(range(len(w))) AS pos FROM d),
iw AS (SELECT item_id, n, l, unnest(w) AS word, unnest(range(n)) AS pos FROM i),
aligned AS (
  SELECT dw.doc_id, iw.item_id, iw.n, iw.l, dw.pos - iw.pos AS b, list(iw.pos) AS equal
  FROM dw JOIN iw USING (word) GROUP BY ALL HAVING count(*) >= ceil(0.8 * iw.l)
), stretches AS (
  SELECT *, unnest(range(n - l + 1)) AS s FROM aligned
), counted AS (
  SELECT doc_id, item_id, b, s, l, len(list_filter(equal, lambda x: x >= s AND x < s + l)) AS e FROM stretches
)
SELECT doc_id, item_id, CAST(b + s AS INTEGER) AS doc_word, CAST(s AS INTEGER) AS item_word, CAST(l AS INTEGER) AS n_words,
       CAST(e AS INTEGER) AS n_equal
FROM counted WHERE e >= ceil(0.8 * l)
QUALIFY row_number() OVER (PARTITION BY doc_id, item_id ORDER BY e DESC, s, b) = 1
"""


@query
def op6_ring_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = ring.shard_texts(table(spark, sf_dir, "documents"), shards=24)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit(ring.LAW).alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


@query
def op5_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = language.train(docs, language.training_label())
    rows = language.identify(docs.select("doc_id", "text"), model)
    return rows.select("doc_id", language.held_out().alias("held_out"), "lang_pred", "score")


@query
def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = pii.detect(docs, pii.train(docs)).drop("text")
    return found.select(
        "doc_id",
        *(pii.count_kind("base_spans", kind).alias(f"n_{kind}") for kind in pii.KINDS),
        F.sha2(pii.span_text("base_spans"), 256).alias("base_sha256"),
        pii.span_text("spans").alias("spans"),
    )


#: Rules that go before the estimate.
URL_RULES = {
    "org/": "allow",
    "example.org/es/": "block",
    "example.org/en/1": "block",
    "com/fr/": "allow",
    "com/de/": "block",
}


@query
def op1_url_reputation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A page shows the document whose id is in its path (``/lang/id``); that document's labels are the outcome."""
    pages, labels = table(spark, sf_dir, "pages"), table(spark, sf_dir, "labels")
    shown = F.regexp_extract(url_reputation.url_path(F.col("url")), "^/[^/]*/([0-9]{1,18})", 1).try_cast("long")
    outcomes = pages.select("url", shown.alias("shown")).join(labels, F.col("shown") == labels["doc_id"])
    bad = url_reputation.any_bad(F.col("quality") == 0, F.col("toxic") == 1)
    judged = url_reputation.judge_urls(
        pages, outcomes.select("url", bad.alias("bad")), URL_RULES, suffixes=url_reputation.PUBLIC_SUFFIXES
    )
    return judged.select("page_id", "host", "path", "rule", "verdict")


def _suffix_labels_sql() -> str:
    """Number of labels of the host's longest public suffix; one where none of the list fits."""
    cases = []
    for k in sorted({s.count(".") + 1 for s in url_reputation.PUBLIC_SUFFIXES}, reverse=True):
        names = ", ".join(f"'{s}'" for s in sorted(url_reputation.PUBLIC_SUFFIXES) if s.count(".") + 1 == k)
        cases.append(f"WHEN array_to_string(list_slice(l, -{k}, -1), '.') IN ({names}) THEN {k}")
    return f"CASE {' '.join(cases)} ELSE 1 END"


ORACLE["op1_url_reputation"] = """
WITH cut AS (
  SELECT page_id, CASE WHEN position('://' IN url) > 0 THEN substr(url, position('://' IN url) + 3) ELSE '' END AS rest
  FROM pages
), p AS (
  SELECT page_id,
         translate(regexp_extract(coalesce(rest, ''), '^[^/?#]*', 0), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(coalesce(rest, ''), '^[^/?#]*([^?#]*)', 1) AS path
  FROM cut
), outcome AS (
  SELECT p.host, CASE WHEN coalesce(l.quality = 0, l.toxic = 1) IS NULL THEN NULL
                      WHEN coalesce(l.quality = 0, FALSE) OR coalesce(l.toxic = 1, FALSE) THEN 1 ELSE 0 END AS bad
  FROM p JOIN labels l ON try_cast(nullif(regexp_extract(p.path, '^/[^/]*/([0-9]{1,18})', 1), '') AS BIGINT) = l.doc_id
), hosts AS (
  SELECT host, count(bad) AS n, coalesce(sum(bad), 0) AS bad
  FROM (SELECT host, bad FROM outcome UNION ALL SELECT host, NULL FROM p) GROUP BY host
), cut_hosts AS (
  SELECT *, string_split(host, '.') AS l FROM hosts
), h AS (
  SELECT host, n, bad, array_to_string(list_slice(l, -(k + 1), -1), '.') AS domain, array_to_string(list_slice(l, -k, -1), '.') AS suffix
  FROM (SELECT *, @labels@ AS k FROM cut_hosts)
), top AS (SELECT (coalesce(sum(bad), 0) + 1.0) / (coalesce(sum(n), 0) + 2.0) AS m FROM h),
s0 AS (SELECT suffix, sum(n) AS n, sum(bad) AS bad, any_value(top.m) AS prior FROM h, top GROUP BY suffix),
s1 AS (SELECT coalesce(sum(CASE WHEN n > 1 THEN n * pow(bad / n - prior, 2) - prior * (1 - prior) END)
                / nullif(sum(CASE WHEN n > 1 THEN (n - 1) * prior * (1 - prior) END), 0), 0) AS share FROM s0),
s2 AS (SELECT CASE WHEN share <= 1.0 / 1001 THEN 1000.0 ELSE greatest(1.0, 1 / share - 1) END AS k FROM s1),
s AS (SELECT suffix, (bad + k * prior) / (n + k) AS m FROM s0, s2),
d0 AS (SELECT h.domain, h.suffix, sum(h.n) AS n, sum(h.bad) AS bad, any_value(s.m) AS prior
       FROM h JOIN s USING (suffix) GROUP BY h.domain, h.suffix),
d1 AS (SELECT coalesce(sum(CASE WHEN n > 1 THEN n * pow(bad / n - prior, 2) - prior * (1 - prior) END)
                / nullif(sum(CASE WHEN n > 1 THEN (n - 1) * prior * (1 - prior) END), 0), 0) AS share FROM d0),
d2 AS (SELECT CASE WHEN share <= 1.0 / 1001 THEN 1000.0 ELSE greatest(1.0, 1 / share - 1) END AS k FROM d1),
d AS (SELECT domain, (bad + k * prior) / (n + k) AS m FROM d0, d2),
m0 AS (SELECT h.host, h.n, h.bad, d.m AS prior FROM h JOIN d USING (domain)),
m1 AS (SELECT coalesce(sum(CASE WHEN n > 1 THEN n * pow(bad / n - prior, 2) - prior * (1 - prior) END)
                / nullif(sum(CASE WHEN n > 1 THEN (n - 1) * prior * (1 - prior) END), 0), 0) AS share FROM m0),
m2 AS (SELECT CASE WHEN share <= 1.0 / 1001 THEN 1000.0 ELSE greatest(1.0, 1 / share - 1) END AS k FROM m1),
m AS (SELECT host, (bad + k * prior) / (n + k) AS mean, n + k AS weight FROM m0, m2),
r AS (
  SELECT p.page_id, p.host, p.path, m.mean - 1.645 * sqrt(m.mean * (1 - m.mean) / (m.weight + 1)) AS bound,
         CASE WHEN (p.host = 'example.org' OR p.host LIKE '%.example.org') AND starts_with(p.path, '/en/1') THEN 'example.org/en/1'
              WHEN (p.host = 'example.org' OR p.host LIKE '%.example.org') AND starts_with(p.path, '/es/') THEN 'example.org/es/'
              WHEN (p.host = 'com' OR p.host LIKE '%.com') AND starts_with(p.path, '/de/') THEN 'com/de/'
              WHEN (p.host = 'com' OR p.host LIKE '%.com') AND starts_with(p.path, '/fr/') THEN 'com/fr/'
              WHEN (p.host = 'org' OR p.host LIKE '%.org') AND starts_with(p.path, '/') THEN 'org/' END AS rule
  FROM p LEFT JOIN m USING (host)
)
SELECT page_id, host, path, rule,
       CASE rule WHEN 'org/' THEN 'allow' WHEN 'example.org/es/' THEN 'block' WHEN 'example.org/en/1' THEN 'block'
                 WHEN 'com/fr/' THEN 'allow' WHEN 'com/de/' THEN 'block'
                 ELSE CASE WHEN bound > 0.5 THEN 'block' ELSE 'allow' END END AS verdict
FROM r
""".replace("@labels@", _suffix_labels_sql())


@query
def op10_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract_text(table(spark, sf_dir, "pages")).select("page_id", "url", "text", "n_chars", "n_repeated")


@query
def op13_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = quality_rules.measured(table(spark, sf_dir, "documents").select("doc_id", "text"))
    rows = quality_rules.verdicts(rows)
    return rows.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        quality_rules.base_failed().alias("base_failed"), "kept", F.array_join("failed_rules", ",").alias("failed_rules"),
    )


def _quality_sql() -> str:
    stop = ", ".join(f"'{w}'" for w in sorted({w for words in quality_rules.STOP_WORDS.values() for w in words.split()}))
    tests = []
    for r in quality_rules.RULES:
        value, scale = (f"1000 * {r.measure}", r.of) if r.of else (r.measure, "1")
        sides = [f"{value} {sign} {bound} * {scale}" for sign, bound in (("<", r.at_least), (">", r.at_most)) if bound is not None]
        tests.append(f"CASE WHEN ({' OR '.join(sides)})" + (f" AND {r.of} > 0" if r.of else "") + f" THEN '{r.name}' END")
    return rf"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents
), w AS (
  SELECT r, doc_id, t, list_filter(regexp_split_to_array(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w,
         list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l
  FROM d
), places AS (
  SELECT r, w, unnest(range(len(w) - 2)) AS i FROM w WHERE len(w) > 2
), spread AS (
  SELECT r, i, w[i + 1] AS a, w[i + 2] AS b, w[i + 3] AS c FROM places
), again AS (
  SELECT r, i FROM spread QUALIFY count(*) OVER (PARTITION BY r, a, b, c) > 1
), covered AS (
  SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest([i, i + 1, i + 2]) AS p FROM again) GROUP BY r
), m AS (
  SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words,
         CAST(length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g')) AS BIGINT) AS word_chars,
         CAST(length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g')) AS BIGINT) AS n_symbols,
         len(l) AS n_lines, CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines,
         CAST(length(list_aggregate(list_concat([''], l), 'string_agg', '')) AS BIGINT) AS line_chars,
         CAST(length(list_aggregate(list_concat([''], l), 'string_agg', ''))
              - length(list_aggregate(list_concat([''], list_distinct(l)), 'string_agg', '')) AS BIGINT) AS dup_line_chars,
         CAST(coalesce(n, 0) AS BIGINT) AS n_repeat_words,
         len(list_filter(w, lambda x: lower(x) IN ({stop}))) AS n_stop_words,
         len(list_filter(w, lambda x: regexp_matches(x, '\p{{L}}'))) AS n_lettered_words,
         len(list_filter(l, lambda x: regexp_matches(x, '^[\x20\t]*[-*•‣·]'))) AS n_bullet_lines,
         len(list_filter(l, lambda x: regexp_matches(x, '([.][.][.]|…)[\x20\t\r]*$'))) AS n_open_lines
  FROM w LEFT JOIN covered USING (r)
), judged AS (
  SELECT *, list_filter([{", ".join(tests)}], lambda x: x IS NOT NULL) AS failed FROM m
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed, len(failed) = 0 AS kept,
       array_to_string(failed, ',') AS failed_rules
FROM judged
"""


ORACLE["op13_quality_rules"] = _quality_sql()


@query
def op11_orchard_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return orchard.cluster_vectors(table(spark, sf_dir, "embeddings"))


def _cluster_sql() -> str:
    """Every round as its own pair of tables: all distances, then floors of exact means."""
    steps = []
    for r in range(orchard.ROUNDS + 1):
        steps.append(f"""a{r} AS MATERIALIZED (
  SELECT r, vec_id, x, c, d FROM (
    SELECT v.r, v.vec_id, v.x, c.c,
           CAST(list_sum(list_transform(list_zip(v.x, c.x), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS BIGINT) AS d
    FROM v, c{r} c
  ) QUALIFY row_number() OVER (PARTITION BY r ORDER BY d, c) = 1
)""")
        if r < orchard.ROUNDS:
            steps.append(f"""c{r + 1} AS MATERIALIZED (
  SELECT c.c, coalesce(m.x, c.x) AS x FROM c{r} c LEFT JOIN (
    SELECT c, list(f ORDER BY i) AS x FROM (
      SELECT c, i, CAST(floor(sum(e) / count(*)) AS BIGINT) AS f
      FROM (SELECT c, unnest(x) AS e, unnest(range({orchard.SIZE})) AS i FROM a{r}) GROUP BY c, i
    ) GROUP BY c
  ) m USING (c)
)""")
    last = orchard.ROUNDS
    return f"""
WITH v AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id,
         list_transform(embedding, lambda x: CAST(floor({orchard.SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS x
  FROM embeddings
  WHERE len(embedding) = {orchard.SIZE} AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {orchard.SIZE}
), c0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY sha256('{orchard.SEED}:' || vec_id), x) - 1 AS c, x FROM v
  QUALIFY row_number() OVER (ORDER BY sha256('{orchard.SEED}:' || vec_id), x) <= {orchard.CLUSTERS}
), {", ".join(steps)}
SELECT vec_id, CAST(c AS INTEGER) AS cluster, d AS distance, CAST(sum(d) OVER (PARTITION BY c) AS BIGINT) AS cluster_inertia,
       CAST(sum(d) OVER () AS BIGINT) AS inertia, sha256(array_to_string(x, ',')) AS centroid_sha256
FROM (SELECT a.vec_id, a.c, a.d, c.x FROM a{last} a JOIN c{last} c USING (c))
"""


ORACLE["op11_orchard_clusters"] = _cluster_sql()


@query
def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents"))


ORACLE["op12_source_divergence"] = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w
  FROM documents
), t AS (
  SELECT r, lang, source, term, count(*) AS n FROM (SELECT r, lang, source, unnest(w) AS term FROM d) GROUP BY ALL
), kept AS (
  SELECT lang, term, sum(n) AS n FROM t GROUP BY lang, term HAVING count(*) >= 30
), v AS (SELECT lang, count(*) AS v, sum(n) AS total FROM kept GROUP BY lang),
g AS (SELECT DISTINCT lang, source FROM d),
c AS (
  SELECT g.lang, g.source, k.term, k.n AS ln, coalesce(x.n, 0) AS n
  FROM g JOIN kept k USING (lang)
  LEFT JOIN (SELECT lang, source, term, sum(n) AS n FROM t GROUP BY ALL) x ON x.lang = g.lang AND x.source = g.source AND x.term = k.term
), p AS (
  SELECT c.lang, source, term, n, CAST(1 + (1000000000 * (n + 5)) // (sum(n) OVER (PARTITION BY c.lang, source) + 5 * v.v) AS BIGINT) AS p,
         CAST(1 + (1000000000 * (ln + 5)) // (v.total + 5 * v.v) AS BIGINT) AS q
  FROM c JOIN v USING (lang)
), pairs AS (
  SELECT a.lang, a.source, b.source AS item, CAST(coalesce(s.value, 0) AS BIGINT) AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN (
    SELECT x.lang, x.source, y.source AS item, sum(abs(x.p - y.p)) AS value
    FROM p x JOIN p y ON x.lang = y.lang AND x.term = y.term GROUP BY ALL
  ) s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
)
SELECT lang, source, 'pair' AS part, item, value,
       CAST(row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) AS INTEGER) AS rank
FROM pairs
UNION ALL
SELECT lang, source, 'term', term, p - q,
       CAST(row_number() OVER (PARTITION BY lang, source ORDER BY p - q DESC, term) AS INTEGER) AS rank
FROM p WHERE n > 0 AND p > q QUALIFY rank <= 50
"""
