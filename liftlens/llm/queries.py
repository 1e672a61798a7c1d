"""The registered queries of the text operators and the SQL of those that have one."""

from __future__ import annotations

from liftlens.llm import (
    codebooks, decontaminate, importance, language_id, mixing, near_dedup, neighbours, pieces,
    secrets, suffix_dedup, suffix_tree_lm, token_counts, toxicity)
from liftlens.llm.common import table


def op1_mix_sources(spark, sf_dir):
    return mixing.words_taken(mixing.mix(table(spark, sf_dir, "documents")))


def op2_token_counts(spark, sf_dir):
    return token_counts.count(table(spark, sf_dir, "documents"))


def op3_secret_scan(spark, sf_dir):
    return secrets.digest(table(spark, sf_dir, "documents"))


def op4_repeated_strings(spark, sf_dir):
    return suffix_dedup.removed(table(spark, sf_dir, "documents"))


def op5_benchmark_leaks(spark, sf_dir):
    return decontaminate.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op6_suffix_tree_scores(spark, sf_dir):
    return suffix_tree_lm.scores(table(spark, sf_dir, "documents"))


def op7_near_duplicates(spark, sf_dir):
    return near_dedup.classes(table(spark, sf_dir, "documents"))


def op8_nearest_vectors(spark, sf_dir):
    return neighbours.search(table(spark, sf_dir, "embeddings"))


def op9_language(spark, sf_dir):
    return language_id.identify(table(spark, sf_dir, "documents"))


def op10_toxicity(spark, sf_dir):
    return toxicity.scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_importance_sample(spark, sf_dir):
    return importance.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_vector_codes(spark, sf_dir):
    return codebooks.codes(table(spark, sf_dir, "embeddings"))


def op13_piece_ids(spark, sf_dir):
    return pieces.digest(table(spark, sf_dir, "documents"))


def _rounds_sql(rounds: int) -> str:
    """Lloyd's rounds over `part(rid, p, v)` from the entries `book0(p, e, v)`."""
    out = []
    for i in range(rounds + 1):
        out.append(f"""
near{i} AS MATERIALIZED (
  SELECT rid, p, arg_min(e, (d, e)) AS e, min(d) AS d FROM (
    SELECT a.rid, a.p, b.e, list_sum(list_transform(list_zip(a.v, b.v), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS d
    FROM part a JOIN book{i} b USING (p)) GROUP BY rid, p)""")
        if i < rounds:
            out.append(f"""
sum{i} AS (
  SELECT n.p, n.e, j, CAST(floor(CAST(sum(a.v[j]) AS DOUBLE) / count(*)) AS BIGINT) AS m
  FROM near{i} n JOIN part a USING (rid, p), unnest(range(1, len(a.v) + 1)) AS u(j) GROUP BY n.p, n.e, j),
book{i + 1} AS MATERIALIZED (
  SELECT b.p, b.e, coalesce(m.v, b.v) AS v FROM book{i} b
  LEFT JOIN (SELECT p, e, list(m ORDER BY j) AS v FROM sum{i} GROUP BY p, e) m USING (p, e))""")
    return ",".join(out)


QUERIES = {f.__name__: f for f in (
    op1_mix_sources, op2_token_counts, op3_secret_scan, op4_repeated_strings,
    op5_benchmark_leaks, op6_suffix_tree_scores, op7_near_duplicates, op8_nearest_vectors,
    op9_language, op10_toxicity, op11_importance_sample, op12_vector_codes, op13_piece_ids)}

ORACLE = {
    "op1_mix_sources": r"""
WITH sized AS (
  SELECT row_number() OVER () AS rid, doc_id, source, md5(coalesce(CAST(doc_id AS VARCHAR), '')) AS h,
         CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size
  FROM documents),
per AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         row_number() OVER (ORDER BY source IS NULL, source) AS sid
  FROM sized GROUP BY source),
weighed AS (
  SELECT *, CASE (sid - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS w FROM per),
filled AS (
  SELECT *, CAST(sum(source_size) OVER () AS BIGINT) AS everything,
         CAST(coalesce(sum(source_size) OVER (ORDER BY source_size / w, sid
              ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS capped,
         CAST(sum(w) OVER (ORDER BY source_size / w, sid
              ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS BIGINT) AS open_w
  FROM weighed),
tested AS (
  SELECT *, 3 * everything - 4 * capped AS words_left,
         w * (3 * everything - 4 * capped) >= 4 * source_size * open_w AS is_capped FROM filled),
shared AS (
  SELECT words_left AS share_left, open_w AS share_w FROM tested WHERE NOT is_capped
  ORDER BY source_size / w, sid LIMIT 1),
aimed AS (
  SELECT t.sid, t.source, t.source_size,
         CASE WHEN is_capped THEN source_size * 2.0::DOUBLE
              ELSE (w * share_left)::DOUBLE / (share_w * 2.0::DOUBLE) END AS target
  FROM tested t LEFT JOIN shared ON true),
placed AS (
  SELECT d.*, a.sid, a.source_size, a.target, CAST(floor(a.target) AS BIGINT) AS quota,
         CAST(sum(d.size) OVER (PARTITION BY d.source ORDER BY h, doc_id, d.size
              ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) - d.size AS begun
  FROM sized d JOIN aimed a ON d.source IS NOT DISTINCT FROM a.source),
grid AS (
  SELECT sid, slots, CAST(sum(slots) OVER (ORDER BY sid) AS BIGINT) - slots AS first_cell,
         CAST(greatest(1, ceil(log2(greatest(1, sum(slots) OVER ())))) AS INTEGER) AS bits
  FROM (SELECT sid, (CAST(floor(target) AS BIGINT) + 1023) // 1024 AS slots FROM aimed)),
slotted AS (
  SELECT sid, slot, row_number() OVER (PARTITION BY sid ORDER BY slot) - 1 AS rank FROM (
    SELECT sid, CAST(list_sum(list_transform(range(bits), lambda i:
             ((cell >> i) & 1) << (bits - 1 - i))) AS BIGINT) AS slot
    FROM (SELECT sid, bits, unnest(range(first_cell, first_cell + slots)) AS cell FROM grid))),
pieces AS (
  SELECT rid, sid, start, stop, unnest(range(start // 1024, (stop - 1) // 1024 + 1)) AS rank FROM (
    SELECT rid, sid, begun + c * source_size AS start, least(quota, begun + c * source_size + size) AS stop
    FROM placed, (VALUES (0), (1)) AS copies(c))
  WHERE stop > start),
held AS (
  SELECT rid, CAST(sum(least(stop, (rank + 1) * 1024) - greatest(start, rank * 1024)) AS BIGINT) AS taken,
         count(*) AS n_pieces, min(slot) AS first_slot
  FROM pieces JOIN slotted USING (sid, rank) GROUP BY rid)
SELECT doc_id, source, size, source_size, target, coalesce(taken, 0) AS taken,
       coalesce(n_pieces, 0) AS n_pieces, first_slot
FROM placed LEFT JOIN held USING (rid)""",
    "op11_importance_sample": r"""
WITH crc0 AS (
  SELECT list(c ORDER BY i) AS tbl FROM (
    SELECT i, list_reduce(list_prepend(i, range(8)), lambda c, k:
             CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c
    FROM range(256) AS t(i))),
texts AS (
  SELECT 0 AS side, row_number() OVER () AS rid, doc_id, text FROM documents
  UNION ALL SELECT 1, row_number() OVER (), NULL, text FROM benchmark),
worded AS (
  SELECT side, rid, doc_id, regexp_extract_all(translate(coalesce(text, ''),
           'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM texts),
grams AS (
  SELECT side, rid, unnest(list_concat(w,
           list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]),
           list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]))) AS f
  FROM worded),
counted AS (SELECT side, rid, f, count(*) AS n FROM grams GROUP BY side, rid, f),
hashed AS MATERIALIZED (
  SELECT f, xor(list_reduce(list_prepend(4294967295,
             list_transform(range(1, len(h), 2), lambda i: CAST(('0x' || h[i:i + 1]) AS BIGINT))),
             lambda c, b: xor(c >> 8, tbl[1 + (xor(c, b) & 255)])), 4294967295) % 10000 AS bucket
  FROM (SELECT DISTINCT f, hex(encode(f)) AS h FROM counted), crc0),
placed AS MATERIALIZED (SELECT side, rid, bucket, sum(n) AS n FROM counted JOIN hashed USING (f) GROUP BY ALL),
totals AS (SELECT side, bucket, sum(n) AS n FROM placed GROUP BY side, bucket),
gains AS (
  SELECT b AS bucket, CAST(floor(1000 * ln(((coalesce(t.n, 0) + 1)::DOUBLE * (s_all + 10000)) /
           ((coalesce(s.n, 0) + 1)::DOUBLE * (t_all + 10000)))) AS BIGINT) AS gain
  FROM range(10000) AS r(b)
  LEFT JOIN (SELECT * FROM totals WHERE side = 0) s ON s.bucket = b
  LEFT JOIN (SELECT * FROM totals WHERE side = 1) t ON t.bucket = b,
  (SELECT CAST(coalesce(sum(n) FILTER (side = 0), 0) AS DOUBLE) AS s_all,
          CAST(coalesce(sum(n) FILTER (side = 1), 0) AS DOUBLE) AS t_all FROM totals)),
weighed AS (
  SELECT doc_id, len(w) AS n_words, CAST(coalesce(n, 0) AS BIGINT) AS n_features,
         CAST(coalesce(weight, 0) AS BIGINT) AS weight,
         CAST(('0x' || sha256('42:' || coalesce(CAST(doc_id AS VARCHAR), ''))[1:8]) AS BIGINT) AS h
  FROM worded LEFT JOIN (
    SELECT rid, sum(n) AS n, sum(n * gain) AS weight FROM placed JOIN gains USING (bucket)
    WHERE side = 0 GROUP BY rid) USING (rid) WHERE side = 0),
scored AS (
  SELECT *, weight + CAST(floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296))) AS BIGINT) AS score
  FROM weighed),
ranked AS (
  SELECT *, count(*) FILTER (n_words >= 20) OVER () AS able,
         row_number() OVER (PARTITION BY n_words >= 20
           ORDER BY score DESC, doc_id NULLS LAST, n_features, weight) AS r
  FROM scored)
SELECT doc_id, n_features, weight, score,
       CASE WHEN n_words >= 20 AND r <= able * 5 // 100 THEN r END AS rank
FROM ranked""",
    "op12_vector_codes": """
WITH kept AS (
  SELECT row_number() OVER (ORDER BY vec_id NULLS LAST, embedding) AS rid, vec_id, label, embedding
  FROM embeddings WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: isfinite(x))) = len(embedding)),
part AS MATERIALIZED (
  SELECT rid, p, list_transform(
           embedding[p * len(embedding) // 8 + 1:(p + 1) * len(embedding) // 8],
           lambda x: CAST(floor(4096 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM kept, range(8) AS t(p)),
book0 AS (SELECT p, rid - 1 AS e, v FROM part WHERE rid <= 16),""" + _rounds_sql(6) + """,
coded AS (
  SELECT vec_id, label, string_agg(printf('%02x', e), '' ORDER BY p) AS code, CAST(sum(d) AS BIGINT) AS error
  FROM near6 JOIN kept USING (rid) GROUP BY rid, vec_id, label)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
       (SELECT sha256(string_agg(array_to_string(v, ','), ',' ORDER BY p, e)) FROM book6) AS codebooks_sha256
FROM coded""",
}
