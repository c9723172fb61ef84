"""The training-data queries and, where SQL can express them, the statements they are checked against."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.llm.collocations import collocations
from tidewell.llm.common import table
from tidewell.llm.decontaminate import contamination
from tidewell.llm.exact_dedup import exact_duplicates
from tidewell.llm.html_text import extract_text
from tidewell.llm.jaccard_join import near_duplicates
from tidewell.llm.language_id import held_out, identify_languages
from tidewell.llm.mixing import repetitions
from tidewell.llm.ranked_search import ranked_search
from tidewell.llm.secret_scan import scan_secrets
from tidewell.llm.substring_dedup import remove_repeats
from tidewell.llm.token_output import written_order
from tidewell.llm.url_filter import filter_urls
from tidewell.llm.vector_search import search_vectors


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_urls(table(spark, sf_dir, "pages"), table(spark, sf_dir, "labels"))


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = identify_languages(docs.select("doc_id", "text"), docs.where(~held_out()))
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", F.col("lang_score").alias("score"))


def op3_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    taken = repetitions(table(spark, sf_dir, "documents"))
    return taken.select(
        "doc_id", F.col("mix_size").alias("size"), F.col("mix_source_size").alias("source_size"), F.col("mix_target").alias("target"), (F.col("mix_size") * F.col("mix_copies")).alias("taken")
    )


def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan_secrets(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_assign", "n_access", "n_hex", F.sha2("base_spans", 256).alias("base_sha256"), F.col("all_spans").alias("spans"))


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = remove_repeats(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op6_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items", F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), "contaminated")


def op8_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = extract_text(table(spark, sf_dir, "pages"))
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_duplicates(table(spark, sf_dir, "documents"))


def op10_training_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    return written_order(table(spark, sf_dir, "documents"))


def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_vector_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search_vectors(table(spark, sf_dir, "embeddings"))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))


#: Fixed values of the mix are stated again here on purpose: the statement is independent of the operator.
OP3_SQL = r"""
WITH RECURSIVE docs AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS size,
         ('0x' || substr(md5('7|' || coalesce(doc_id::varchar, '') || '|' || md5(coalesce(text, ''))), 1, 13))::BIGINT / pow(16.0, 13) AS draw
  FROM documents),
sources AS (
  SELECT source, sum(size)::BIGINT AS source_size FROM docs GROUP BY source),
ranked AS (
  SELECT *, ((row_number() OVER (ORDER BY encode(source) NULLS LAST) - 1) % 3 + 1)::DOUBLE AS weight, sum(source_size) OVER () AS total FROM sources),
rounds(n, level, last) AS (
  SELECT 0, 0.0::DOUBLE, -1.0::DOUBLE
  UNION ALL
  SELECT n + 1, coalesce((SELECT (any_value(total) - 3 * coalesce(sum(source_size) FILTER (n > 0 AND weight * level >= 3 * source_size), 0))
                                 / nullif(sum(weight) FILTER (n = 0 OR weight * level < 3 * source_size), 0) FROM ranked), level), level
  FROM rounds WHERE level > last),
final AS (SELECT max(level) AS level FROM rounds),
plan AS (
  SELECT source, source_size, CASE WHEN weight * level >= 3 * source_size THEN 3.0 * source_size ELSE weight * level END::DOUBLE AS target FROM ranked, final),
rated AS (SELECT *, CASE WHEN source_size > 0 THEN least(target / source_size, 3.0) ELSE 0.0 END AS rate FROM plan)
SELECT d.doc_id, d.size::BIGINT AS size, r.source_size, r.target, (d.size * (floor(r.rate) + CASE WHEN d.draw < r.rate - floor(r.rate) THEN 1 ELSE 0 END))::BIGINT AS taken
FROM docs d JOIN rated r ON d.source IS NOT DISTINCT FROM r.source
"""

OP5_SQL = r"""
WITH docs AS (SELECT doc_id, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS w FROM documents),
windows AS (SELECT doc_id, s, sha256(array_to_string(w[s : s + 19], ' ')) AS body FROM (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS s FROM docs WHERE len(w) >= 20)),
later AS (SELECT doc_id, s FROM windows QUALIFY row_number() OVER (PARTITION BY body ORDER BY doc_id, s) > 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(s, s + 20)) AS place FROM later),
words AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS place FROM docs),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY place) AS body, count(*) AS n FROM words ANTI JOIN gone USING (doc_id, place) GROUP BY doc_id)
SELECT doc_id, len(w) AS n_words, len(w) - coalesce(n, 0) AS n_removed, sha256(coalesce(body, '')) AS kept_sha256 FROM docs LEFT JOIN kept USING (doc_id)
"""

#: All pairs that share a shingle are counted; the smallest reachable class names the group.
OP6_SQL = r"""
WITH RECURSIVE classes AS (SELECT DISTINCT md5(coalesce(text, '')) AS class_id, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS w FROM documents),
shingles AS (SELECT DISTINCT class_id, md5(array_to_string(w[s : s + 4], ' ')) AS body FROM (SELECT class_id, w, unnest(range(1, greatest(1, len(w) - 4) + 1)) AS s FROM classes WHERE len(w) > 0)),
sizes AS (SELECT class_id, count(*) AS n FROM shingles GROUP BY class_id),
shared AS (SELECT a.class_id AS one, b.class_id AS other, count(*) AS n FROM shingles a JOIN shingles b ON a.body = b.body AND a.class_id <> b.class_id GROUP BY ALL),
pairs AS (SELECT one, other FROM shared s JOIN sizes a ON a.class_id = one JOIN sizes b ON b.class_id = other WHERE s.n * 1.8 >= (a.n + b.n) * 0.8),
links AS (SELECT one AS class_id, count(*) AS links FROM pairs GROUP BY one),
reach(class_id, seen) AS (SELECT class_id, class_id FROM classes UNION SELECT r.class_id, p.other FROM reach r JOIN pairs p ON p.one = r.seen),
groups AS (SELECT class_id, min(seen) AS group_id FROM reach GROUP BY class_id)
SELECT doc_id, class_id, coalesce(links, 0) AS links, group_id FROM (SELECT doc_id, md5(coalesce(text, '')) AS class_id FROM documents) JOIN groups USING (class_id) LEFT JOIN links USING (class_id)
"""

#: Independent of the operator: every document window of each length is written out and compared.
OP7_SQL = r"""
WITH items AS (
  SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
windows AS (
  SELECT DISTINCT item_id, least(13, len(w)) AS n, array_to_string(w[s : s + 12], ' ') AS body
  FROM (SELECT item_id, w, unnest(range(1, greatest(1, len(w) - 12) + 1)) AS s FROM items WHERE len(w) > 0)),
docs AS (
  SELECT doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w FROM documents),
places AS (
  SELECT doc_id, n, unnest(range(1, len(w) - n + 2)) AS s, w FROM docs, (SELECT DISTINCT n FROM windows) WHERE len(w) >= n),
found AS (
  SELECT p.doc_id, p.s, p.n, x.item_id FROM (SELECT doc_id, n, s, array_to_string(w[s : s + n - 1], ' ') AS body FROM places) p JOIN windows x ON x.n = p.n AND x.body = p.body),
hits AS (
  SELECT doc_id, count(DISTINCT place) AS n_hit FROM (SELECT doc_id, unnest(range(s, s + n)) AS place FROM found) GROUP BY doc_id),
owners AS (
  SELECT doc_id, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS items FROM found GROUP BY doc_id)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM docs LEFT JOIN hits USING (doc_id) LEFT JOIN owners USING (doc_id)
"""

OP9_SQL = """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size, doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
"""

#: Every document that shares a term with an item is scored.
OP11_SQL = r"""
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
filled AS (SELECT r, doc_id, len(w) AS n, w FROM docs WHERE len(w) > 0),
stats AS (SELECT count(*)::BIGINT AS nn, sum(n)::BIGINT AS ll FROM filled),
tfs AS (SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(w) AS term FROM filled) GROUP BY ALL),
weights AS (SELECT term, floor(1000 * ln((2 * any_value(nn) + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS weight FROM tfs, stats GROUP BY term),
asked AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
scored AS (
  SELECT item_id, r, doc_id, sum(weight * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + ((50 * n * nn) // ll)))))::BIGINT AS score
  FROM asked JOIN tfs USING (term) JOIN weights USING (term) JOIN filled USING (r), stats GROUP BY ALL)
SELECT item_id, (row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id))::INTEGER AS rank, doc_id, score FROM scored WHERE score > 0 QUALIFY rank <= 50
"""

#: All pairs of queries and rows, in doubles that are exact for these vectors.
OP12_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT::DOUBLE) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
pairs AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.e, c.e)::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id AND len(q.e) = len(c.e))
SELECT query_id, (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id))::INTEGER AS rank, vec_id, score FROM pairs QUALIFY rank <= 5
"""

#: All n-grams of whole pieces are written out and counted, without chunks.
OP13_SQL = r"""
WITH docs AS (SELECT coalesce(lang, 'und') AS lang, string_split_regex(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]') AS p FROM documents),
pieces AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM (SELECT lang, unnest(p) AS piece FROM docs)),
grams AS (
  SELECT lang, k, array_to_string(w[s : s + k - 1], ' ') AS phrase, count(*) AS f
  FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS s FROM pieces, (VALUES (1), (2), (3)) sizes(k) WHERE len(w) >= k) GROUP BY ALL),
totals AS (SELECT lang, sum(f)::BIGINT AS n FROM grams WHERE k = 1 GROUP BY lang),
candidates AS (SELECT lang, k AS size, phrase, f AS a, string_split(phrase, ' ') AS w FROM grams WHERE k > 1 AND f >= 10),
cuts AS (
  SELECT c.lang, c.phrase, c.size, c.a, c.k, x.f AS l, y.f AS r, 1000000::HUGEINT * c.a * c.a // (x.f::HUGEINT * y.f) AS score
  FROM (SELECT *, unnest(range(1, size)) AS k FROM candidates) c
  JOIN grams x ON x.lang = c.lang AND x.phrase = array_to_string(c.w[: c.k], ' ') JOIN grams y ON y.lang = c.lang AND y.phrase = array_to_string(c.w[c.k + 1 :], ' ')),
best AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
inside AS (SELECT lang, array_to_string(w[s : s + 1], ' ') AS phrase, max(a) AS longer FROM (SELECT lang, w, a, unnest([1, 2]) AS s FROM candidates WHERE size = 3) GROUP BY ALL),
kept AS (SELECT b.* FROM best b LEFT JOIN inside i USING (lang, phrase) WHERE i.longer IS NULL OR 100 * i.longer < 50 * b.a)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank, phrase, a, l, r, n, score::BIGINT AS score
FROM kept JOIN totals USING (lang) QUALIFY rank <= 2000
"""

QUERIES = {
    "op1_url_filter": op1_url_filter,
    "op2_language_id": op2_language_id,
    "op3_mix_sources": op3_mix_sources,
    "op4_secret_scan": op4_secret_scan,
    "op5_substring_dedup": op5_substring_dedup,
    "op6_jaccard_join": op6_jaccard_join,
    "op7_decontaminate": op7_decontaminate,
    "op8_html_text": op8_html_text,
    "op9_exact_dedup": op9_exact_dedup,
    "op10_training_order": op10_training_order,
    "op11_ranked_search": op11_ranked_search,
    "op12_vector_search": op12_vector_search,
    "op13_collocations": op13_collocations,
}
ORACLES = {"op3_mix_sources": OP3_SQL, "op5_substring_dedup": OP5_SQL, "op6_jaccard_join": OP6_SQL, "op7_decontaminate": OP7_SQL, "op9_exact_dedup": OP9_SQL, "op11_ranked_search": OP11_SQL, "op12_vector_search": OP12_SQL, "op13_collocations": OP13_SQL}
