"""The registered queries of the corpus operators: thin digests of their outputs over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tramloom.llm import balltree, collocations, decontamination, html, languages, lines, mixing, negatives, secrets, simhash, substrings, toxicity, warc


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _sha256(text: str):
    return F.sha2(F.coalesce(F.col(text), F.lit("")).cast("binary"), 256)


def op1_cube_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    mix = mixing.mix_sources(table(spark, sf_dir, "documents"))
    return mix.select("doc_id", "source", "size", "source_size", "target", "copies", "taken")


def op2_simhash_bktree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_classes(table(spark, sf_dir, "documents"))


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = substrings.dedup_substrings(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return cut.select("doc_id", "n_words", "n_removed", _sha256("text").alias("kept_sha256"))


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = lines.dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return kept.select("doc_id", "n_lines", "n_dropped", _sha256("text").alias("kept_sha256"))


def op5_html_consensus(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = html.extract_main_text(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return pages.select("page_id", "url", F.col("main_text").alias("text"), "n_chars")


def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan_secrets(table(spark, sf_dir, "documents"))
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")
    return found.select(
        "doc_id",
        *[count(i).alias(f"n_{kind}") for i, kind in enumerate(secrets.KINDS[:3])],
        F.sha2(secrets.joined(F.col("base")).cast("binary"), 256).alias("base_sha256"),
        secrets.joined(F.concat("base", "random")).alias("spans"),
    )


def op7_balltree_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return balltree.top_k(vectors, F.col("vec_id") % 50 == 0)


def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def op9_toxicity_gru(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = toxicity.score_toxicity(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels"))
    return scored.select("doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op10_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archived_pages(table(spark, sf_dir, "pages"))


def op11_strassen_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    ident, label = F.col("vec_id"), F.col("label")
    moved = F.when(ident % 7 == 0, (label + 1) % 10).otherwise(label)
    return negatives.mine_negatives(table(spark, sf_dir, "embeddings"), ident % 100 == 0, label=moved)


def op12_ppm_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")), F.lit(4)) == 2
    found = languages.predict_languages(table(spark, sf_dir, "documents").select("doc_id", "text", "lang"), trained=~held_out)
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.mine_collocations(table(spark, sf_dir, "documents").select("doc_id", "text", "lang")).drop("first_doc")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    own = (op1_cube_mix, op2_simhash_bktree, op3_substring_dedup, op4_line_dedup, op5_html_consensus, op6_secret_scan, op7_balltree_topk, op8_decontaminate, op9_toxicity_gru, op10_warc_revisits, op11_strassen_negatives, op12_ppm_language, op13_collocations)
    return {f.__name__: f for f in own}


_SPACES = r"' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
_LOWER = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"

OP3_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT r, unnest(range(1, len(w) - 33)) AS i, w FROM d WHERE len(w) >= 35),
g AS (SELECT r, i, sha256(array_to_string(w[i : i + 34], ' ')) AS k FROM s),
rep AS (SELECT k FROM g GROUP BY k HAVING count(*) > 1),
hit AS (SELECT DISTINCT r, unnest(range(i, i + 35)) AS p FROM g WHERE k IN (SELECT k FROM rep)),
kept AS (SELECT d.r, list(w[x.p] ORDER BY x.p) AS kw FROM d, LATERAL (SELECT unnest(range(1, len(w) + 1)) AS p) x
  LEFT JOIN hit ON hit.r = d.r AND hit.p = x.p WHERE hit.p IS NULL GROUP BY d.r)
SELECT d.doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(len(kw), 0))::BIGINT AS n_removed,
  sha256(coalesce(array_to_string(kw, ' '), '')) AS kept_sha256
FROM d LEFT JOIN kept USING (r)
"""

OP4_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
l AS (SELECT r, doc_id, generate_subscripts(lines, 1) AS i, unnest(lines) AS line FROM d),
k AS (SELECT r, doc_id, i, line, translate(trim(line, {_SPACES}), {_LOWER}) AS key FROM l),
rep AS (SELECT key, max(doc_id) AS keeper FROM (SELECT DISTINCT r, doc_id, key FROM k WHERE length(key) >= 40) GROUP BY key HAVING count(*) >= 5)
SELECT any_value(k.doc_id) AS doc_id, count(*)::BIGINT AS n_lines,
  count(*) FILTER (WHERE rep.key IS NOT NULL AND k.doc_id <> keeper)::BIGINT AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE rep.key IS NULL OR k.doc_id = keeper), '')) AS kept_sha256
FROM k LEFT JOIN rep USING (key) GROUP BY r
"""

OP7_SQL = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.e, c.e)::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id AND len(q.e) = len(c.e))
SELECT query_id, (row_number() OVER w)::INTEGER AS rank, vec_id, score FROM s
WINDOW w AS (PARTITION BY query_id ORDER BY score DESC, vec_id) QUALIFY row_number() OVER w <= 5
"""

OP8_SQL = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), {_LOWER}), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), {_LOWER}), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
win AS (SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[i : i + 9], ' ') AS k
  FROM b, LATERAL (SELECT unnest(range(1, greatest(2, len(w) - 8))) AS i) x WHERE len(w) > 0),
lens AS (SELECT DISTINCT n FROM win),
g AS (SELECT r, n, i, array_to_string(w[i : i + n - 1], ' ') AS k FROM d, lens, LATERAL (SELECT unnest(range(1, len(w) - n + 2)) AS i) x WHERE len(w) >= n),
hit AS (SELECT r, g.n, i, item_id FROM g JOIN win ON win.k = g.k AND win.n = g.n),
words AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS p FROM hit) GROUP BY r),
items AS (SELECT r, count(*) AS n_items, string_agg(id, ',' ORDER BY id COLLATE C) AS ids FROM (SELECT DISTINCT r, item_id::VARCHAR AS id FROM hit WHERE item_id IS NOT NULL) GROUP BY r)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM d LEFT JOIN words USING (r) LEFT JOIN items USING (r)
"""

OP10_SQL = """
WITH p AS (SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS payload_bytes, sha1(coalesce(html, '')) AS x FROM pages),
d AS (SELECT page_id, payload_bytes, array_to_string(list_transform(range(32), lambda i:
  substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (('0x' || substr(x, 5 * (i // 4) + 1, 5))::INTEGER >> (15 - 5 * (i % 4))::INTEGER) % 32 + 1, 1)), '') AS payload_digest FROM p),
m AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS top FROM d)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id IS DISTINCT FROM top THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN page_id IS DISTINCT FROM top THEN top END AS refers_to
FROM m
"""


OP11_SQL = """
WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e
  FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
  AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS anchor_id, c.vec_id, c.label = a.label AS same, list_dot_product(a.e, c.e)::BIGINT AS score
  FROM v a JOIN v c ON a.vec_id % 100 = 0 AND c.vec_id <> a.vec_id AND len(a.e) = len(c.e)),
p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT anchor_id, positive_id, (row_number() OVER w)::INTEGER AS rank, s.vec_id AS negative_id, positive_score, s.score AS negative_score
FROM p JOIN s USING (anchor_id) WHERE NOT same AND 80 * positive_score <= 100 * score AND 100 * score <= 100 * positive_score
WINDOW w AS (PARTITION BY anchor_id, positive_id ORDER BY s.score DESC, s.vec_id) QUALIFY row_number() OVER w <= 5
"""


OP13_SQL = rf"""
WITH p AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), {_LOWER}), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM p),
total AS (SELECT lang, sum(len(ws))::BIGINT AS n FROM w GROUP BY lang),
g AS (SELECT lang, words, array_to_string(ws[i : i + words - 1], ' ') AS phrase, count(*) AS f
  FROM (SELECT lang, ws, words, unnest(range(1, len(ws) - words + 2)) AS i FROM w, (VALUES (1), (2), (3)) t(words) WHERE len(ws) >= words)
  GROUP BY lang, words, phrase HAVING count(*) >= 10),
cand AS (SELECT lang, words, phrase, f AS a, string_split(phrase, ' ') AS ws FROM g WHERE words >= 2),
cut AS (SELECT *, unnest(range(1, words)) AS k FROM cand),
scored AS (SELECT c.lang, c.phrase, a, k, x.f AS l, y.f AS r, (1000000::HUGEINT * a * a // (x.f::HUGEINT * y.f))::BIGINT AS score
  FROM cut c JOIN g x ON x.lang = c.lang AND x.words = k AND x.phrase = array_to_string(ws[1 : k], ' ')
  JOIN g y ON y.lang = c.lang AND y.words = c.words - k AND y.phrase = array_to_string(ws[k + 1 : c.words], ' ')),
best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
longer AS (SELECT lang, array_to_string(ws[i : i + 1], ' ') AS phrase, max(a) AS top FROM (SELECT *, unnest([1, 2]) AS i FROM cand WHERE words = 3) GROUP BY ALL)
SELECT lang, row_number() OVER o AS rank, phrase, a, l, r, n, score
FROM best LEFT JOIN longer USING (lang, phrase) JOIN total USING (lang) WHERE top IS NULL OR 100 * top < 50 * a
WINDOW o AS (PARTITION BY lang ORDER BY score DESC, a DESC, phrase COLLATE C) QUALIFY row_number() OVER o <= 2000
"""


def oracle_sql() -> dict[str, str]:
    """DuckDB SQL of those queries that SQL can express; the others are tested against brute force."""
    return {"op3_substring_dedup": OP3_SQL, "op4_line_dedup": OP4_SQL, "op7_balltree_topk": OP7_SQL, "op8_decontaminate": OP8_SQL, "op10_warc_revisits": OP10_SQL, "op11_strassen_negatives": OP11_SQL, "op13_collocations": OP13_SQL}
