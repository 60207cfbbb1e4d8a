"""The registered queries ``opN_<name>``, each operator over its whole table, and the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from starmart.llm import (
    decontam,
    hyperminhash,
    langid,
    licenses,
    mixing,
    phrases,
    quality,
    sharding,
    simhash,
    suffix_dedup,
    syncmers,
    warc,
    whitening,
)
from starmart.llm.common import LOWER, UPPER, held_out, read
from starmart.llm.quality import THRESHOLD

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """With the removed spans and the text that is left (null where a cut through a character left no UTF-8)."""
    return suffix_dedup.without_repeats(read(spark, sf_dir, "documents")).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"),
        F.try_validate_utf8(F.col("kept").cast("string")).alias("kept_text"), "spans",
    )


@query
def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(read(spark, sf_dir, "documents")).drop("text", "n_chars")


@query
def op3_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(read(spark, sf_dir, "documents")).drop("spans")


@query
def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(read(spark, sf_dir, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "digest_ok"
    )


@query
def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.linked(read(spark, sf_dir, "documents"))


@query
def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    model = quality.fit(docs, read(spark, sf_dir, "labels"))
    scored = quality.score(docs.select("doc_id", "text", "n_chars"), model, THRESHOLD)
    return scored.select("doc_id", held_out().alias("held_out"), "score", "predicted")


@query
def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.matches(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark")).drop("key")


@query
def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    found = langid.predict(docs, langid.fit(docs))
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score", "accepted")


@query
def op9_syncmers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return syncmers.fingerprints(read(spark, sf_dir, "documents"))


@query
def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.place(read(spark, sf_dir, "documents")).select("doc_id", "slot", "shard_no", "shard")


@query
def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(read(spark, sf_dir, "embeddings"))


@query
def op12_hyperminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hyperminhash.linked(read(spark, sf_dir, "documents"))


@query
def op13_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(read(spark, sf_dir, "documents"))


QUERIES["pipeline"] = corpus_pipeline.run

_PAIRS = ", ".join(
    f"({i}, {str(is_base).lower()}, '{label}', {len(w) - 1}, {q}, '{w[q]}', '{w[q + 1]}')"
    for i, (w, is_base, label) in enumerate(
        [(t.split(), True, label) for t, label in licenses.BASE.items()] + [(t.split(), False, label) for label, t in licenses.NOTICES.items()]
    )
    for q in range(len(w) - 1)
)

ORACLES["op3_licenses"] = rf"""
WITH RECURSIVE pairs(template, is_base, label, n_pairs, q, t0, t1) AS (VALUES {_PAIRS}),
docs AS (
  SELECT row_number() OVER () AS r, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents
),
hits AS (
  SELECT r, template, is_base, label, n_pairs, q, i - 1 AS p
  FROM (SELECT r, i, w[i] AS w0, w[i + 1] AS w1 FROM (SELECT r, w, unnest(range(1, len(w))) AS i FROM docs WHERE len(w) > 1) y) x
  JOIN pairs ON w0 = t0 AND w1 = t1
),
exact AS (
  SELECT r, label, p - q AS first, 1.0::DOUBLE AS share, true AS exact
  FROM hits WHERE is_base GROUP BY r, template, label, n_pairs, p - q HAVING count(*) = n_pairs
),
inside AS (
  SELECT * FROM (SELECT *, unnest([p // n_pairs - 2, p // n_pairs - 1, p // n_pairs]) AS win FROM hits WHERE NOT is_base) x WHERE win >= 0
),
runs AS (
  SELECT r, template, win, diagonal, sum(CASE WHEN gap <= 3 THEN 0 ELSE 1 END) OVER (PARTITION BY r, template, win ORDER BY diagonal) AS run
  FROM (SELECT r, template, win, d AS diagonal, d - lag(d) OVER (PARTITION BY r, template, win ORDER BY d) AS gap
        FROM (SELECT DISTINCT r, template, win, p - q AS d FROM inside) y) x
),
numbered AS (SELECT i.*, run FROM inside i JOIN runs USING (r, template, win) WHERE runs.diagonal = i.p - i.q),
solid AS (SELECT * FROM numbered SEMI JOIN (
  SELECT r, template, win, run FROM numbered GROUP BY ALL HAVING count(DISTINCT q) >= 3) k USING (r, template, win, run)),
likely AS (SELECT * FROM solid SEMI JOIN (
  SELECT r, template, win FROM solid GROUP BY r, template, win, n_pairs HAVING count(DISTINCT q) >= 0.6 * n_pairs) k USING (r, template, win)),
chain(r, template, win, p, q, n) AS (
  SELECT r, template, win, p, q, 1 FROM likely
  UNION
  SELECT c.r, c.template, c.win, h.p, h.q, c.n + 1 FROM chain c
  JOIN likely h ON h.r = c.r AND h.template = c.template AND h.win = c.win AND h.p > c.p AND h.q > c.q
),
windows AS (
  SELECT r, template, label, win, n, n / n_pairs::DOUBLE AS share
  FROM (SELECT r, template, win, max(n) AS n FROM chain GROUP BY ALL) x JOIN (SELECT DISTINCT template, label, n_pairs FROM pairs) y USING (template)
  WHERE n >= 0.6 * n_pairs
),
loose AS (
  SELECT r, label, NULL AS first, share, false AS exact FROM windows a WHERE NOT EXISTS (
    SELECT 1 FROM windows b WHERE a.r = b.r AND a.template = b.template AND a.win <> b.win AND abs(a.win - b.win) <= 2
      AND (b.n > a.n OR (b.n = a.n AND b.win < a.win)))
),
found AS (SELECT * FROM exact UNION ALL SELECT * FROM loose)
SELECT doc_id, len(w)::BIGINT AS n_words, count(*) FILTER (exact) AS n_base,
  (min(first) FILTER (exact))::BIGINT AS first_word, (max(first) FILTER (exact))::BIGINT AS last_word,
  coalesce(string_agg(DISTINCT label, ',' ORDER BY label) FILTER (exact), '') AS base_labels,
  coalesce(string_agg(DISTINCT label, ',' ORDER BY label) FILTER (label IS NOT NULL), '') AS labels,
  coalesce(max(share), 0.0::DOUBLE) AS score, count(*) FILTER (label IS NOT NULL) AS n_spans
FROM docs LEFT JOIN found USING (r) GROUP BY r, doc_id, w
"""

# base32 of a SHA-1 in hexadecimal: five digits are four letters
ORACLES["op4_warc"] = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS hex FROM pages),
firsts AS (SELECT hex, min(page_id) AS first FROM p GROUP BY hex)
SELECT page_id, strlen(html)::BIGINT AS payload_bytes,
  array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    1 + ((('0x' || substr(hex, 1 + 5 * (i // 4)::INT, 5))::BIGINT >> (15 - 5 * (i % 4))::INT) & 31)::INT, 1)), '') AS payload_digest,
  CASE WHEN page_id > first THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN page_id > first THEN first END AS refers_to,
  true AS digest_ok
FROM p JOIN firsts USING (hex)
"""

_TABLE = ",".join(map(str, sharding.fill_table()))

ORACLES["op10_sharding"] = f"""
WITH t AS (SELECT [{_TABLE}] AS cells),
d AS (
  SELECT doc_id, (('0x' || substr(md5(coalesce('k' || doc_id::VARCHAR, 't' || coalesce(text, ''))), 1, 12))::BIGINT
    % {sharding.TABLE_SIZE})::INT AS slot
  FROM documents
)
SELECT doc_id, slot, cells[slot + 1] AS shard_no, 'shard-' || lpad(cells[slot + 1]::VARCHAR, 3, '0') AS shard FROM d, t
"""

ORACLES["op12_hyperminhash"] = rf"""
WITH RECURSIVE words AS (
  SELECT row_number() OVER () AS r, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x20\x09-\x0D]+') AS w
  FROM documents
),
shingles AS (
  SELECT DISTINCT r, array_to_string(list_slice(w, i, i + 3), ' ') AS s
  FROM (SELECT r, w, unnest(range(1, greatest(len(w) - 3, 1) + 1)) AS i FROM words WHERE len(w) > 0) x
),
sizes AS (SELECT r, count(*) AS n FROM shingles GROUP BY r),
pairs AS (SELECT a.r AS a, b.r AS b, count(*) AS shared FROM shingles a JOIN shingles b ON a.s = b.s AND a.r <> b.r GROUP BY ALL),
edges AS (
  SELECT a, b FROM pairs JOIN sizes x ON x.r = a JOIN sizes y ON y.r = b WHERE 100 * shared >= 80 * (x.n + y.n - shared)
),
reach(a, b) AS (SELECT a, b FROM edges UNION SELECT reach.a, edges.b FROM reach JOIN edges ON reach.b = edges.a),
least AS (SELECT a AS r, min(doc_id) AS least FROM reach JOIN words ON words.r = reach.b GROUP BY a)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, least(doc_id, least) AS component_id, doc_id = least(doc_id, least) AS kept
FROM words LEFT JOIN sizes USING (r) LEFT JOIN least USING (r)
"""

_GRAMS = " UNION ALL ".join(
    f"SELECT lang, {k} AS k, list_slice(w, i, i + {k - 1}) AS p FROM (SELECT lang, w, unnest(range(1, len(w) - {k - 2})) AS i FROM pieces) x"
    for k in range(1, phrases.LONGEST + 1)
)

ORACLES["op13_phrases"] = rf"""
WITH pieces AS (
  SELECT lang, regexp_extract_all(piece, '[^ 	]+') AS w
  FROM (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_extract_all(
    translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^.,;:!?
-
]+')) AS piece FROM documents) x
),
f AS (SELECT lang, k, p, count(*) AS f FROM ({_GRAMS}) x GROUP BY ALL),
totals AS (SELECT lang, sum(f)::BIGINT AS n FROM f WHERE k = 1 GROUP BY lang),
cand AS (SELECT lang, k, p, f AS a FROM f WHERE k > 1 AND f >= {phrases.LEAST}),
inner_ AS (
  SELECT lang, list_slice(p, i, i + m - 1) AS p, max(a) AS longer
  FROM (SELECT *, unnest(range(1, k - m + 2)) AS i FROM (SELECT *, unnest(range(2, k)) AS m FROM cand) x) y GROUP BY ALL
),
cuts AS (
  SELECT c.lang, c.p, c.a, c.cut, l.f AS l, r.f AS r, n,
    ((1000::HUGEINT * c.a * n) // (l.f::HUGEINT * r.f))::BIGINT AS score
  FROM (
    SELECT cand.*, unnest(range(1, k)) AS cut FROM cand LEFT JOIN inner_ USING (lang, p)
    WHERE longer IS NULL OR 100 * longer < 100 * a
  ) c
  JOIN f l ON l.lang = c.lang AND l.p = list_slice(c.p, 1, c.cut)
  JOIN f r ON r.lang = c.lang AND r.p = list_slice(c.p, c.cut + 1, c.k)
  JOIN totals t ON t.lang = c.lang
),
best AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, p ORDER BY score, cut) = 1),
ranked AS (
  SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, array_to_string(p, ' ')) AS rank,
    array_to_string(p, ' ') AS phrase, a, l, r, n, score
  FROM best
)
SELECT * FROM ranked WHERE rank <= {phrases.FIRST_ROWS}
"""
