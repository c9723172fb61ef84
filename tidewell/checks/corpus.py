"""Corpus and retrieval queries with their check SQL."""

from __future__ import annotations

from html.entities import html5

from pyspark.sql import functions as F

from tidewell.checks.catalog import query
from tidewell.checks.ctes import cte, rnd, sql
from tidewell.functions import text as tx
from tidewell.operators.knn import knn_topk
from tidewell.plans import corpus, retrieval
from tidewell.sources.star import Star

WS = tx.WS
LINES = r"\r\n|[\n\r\x0b\x0c\x1c-\x1e\x85\x{2028}\x{2029}]"


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


ENTITY_MAP = "MAP {" + ", ".join(f"{quoted('&' + k)}: {quoted(v)}" for k, v in sorted(html5.items())) + "}"
cte("entity_names", f"SELECT {ENTITY_MAP} AS m")


def unescape(c: str) -> str:
    token = "CASE WHEN t = '&' OR t[1] <> '&' THEN t WHEN t LIKE '&#%' THEN chr(CAST(regexp_extract(t, '[0-9]+') AS INTEGER)) ELSE COALESCE(m[t], t) END"
    return f"CASE WHEN contains({c}, '&') THEN list_aggregate(list_transform(regexp_extract_all({c}, '&#[0-9]+;?|&[A-Za-z][A-Za-z0-9]*;?|[^&]+|&'), lambda t: {token}), 'string_agg', '') ELSE {c} END"


def re_all(c: str, pattern: str, to: str) -> str:
    return f"regexp_replace({c}, '{pattern}', '{to}', 'g')"


def strip_markup(c: str) -> str:
    c = re_all(c, "<[^>]+>", " ")
    c = re_all(c, rf'\b[a-zA-Z_-]{{2,}}[{WS}]*=[{WS}]*"[^"]*"', " ")
    return re_all(c, rf"\b[a-zA-Z_-]{{2,}}[{WS}]*=[{WS}]*''[^'']*''", " ")


def strip_ws(c: str) -> str:
    return re_all(c, rf"^[{WS}]+|[{WS}]+$", "")


def squeeze(c: str) -> str:
    return strip_ws(re_all(c, rf"[{WS}]+", " "))


def document_sql(c: str) -> str:
    c = strip_markup(f"replace({c}, chr(65279), ' ')")
    c = re_all(c, r"[\x00-\x08\x0B\x0C\x0E-\x1F\x7F]", " ")
    c = re_all(re_all(re_all(c, r"[\t\r]+", " "), " {2,}", " "), r"\n{3,}", "\n\n")
    return strip_ws(f"replace({c}, chr(65533), ' ')")


def flat_sql(c: str) -> str:
    c = re_all(re_all(strip_markup(c), "[#*_`]+", " "), "={2,}|-{2,}|_{2,}", " ")
    return squeeze(f"replace({re_all(c, r'[\x00-\x1F\x7F]', ' ')}, chr(65533), ' ')")


def section_sql(c: str) -> str:
    lines = f"list_filter(list_transform(regexp_split_to_array({c}, '{LINES}'), lambda l: {strip_ws('l')}), lambda l: l <> '')"
    heads = "list_filter(lines[1:8], lambda l: l[1] = '#')"
    return f"(SELECT CASE WHEN len(lines) = 0 THEN 'unknown' WHEN len({heads}) > 0 THEN {strip_ws('regexp_replace(' + heads + '[1], ' + quoted('^#+') + ', ' + quoted('') + ')')} ELSE left(lines[1], 80) END FROM (SELECT {lines} AS lines))"


cte("decoded_corpus", f"SELECT name, owner, confidentiality, {unescape('text')} AS text FROM corpus CROSS JOIN entity_names")
cte("clean_corpus", f"SELECT * FROM (SELECT name, owner, confidentiality, {document_sql('text')} AS text FROM decoded_corpus) WHERE text <> ''")
cte("fixed_chunks", """
SELECT name, owner, confidentiality, idx, substring(text, idx * 850 + 1, 1000) AS content
FROM (SELECT *, UNNEST(range(0, GREATEST(CAST(ceil((length(text) - 150) / 850e0) AS BIGINT), 1))) AS idx FROM clean_corpus)
""")
cte("described_chunks", f"SELECT name || ':0:' || idx AS chunk_id, name AS source, 1 AS page, owner, confidentiality, {section_sql('content')} AS section, content FROM fixed_chunks")


def clean(s: Star):
    return corpus.sanitize_documents(s.corpus())


def described(s: Star):
    return corpus.chunk_metadata(corpus.chunk_fixed(clean(s)))


@query("sanitize_documents", sql("SELECT * FROM clean_corpus"))
def _(s: Star):
    return clean(s)


@query("sanitize_flat", sql(f"SELECT name, {flat_sql('text')} AS text FROM decoded_corpus"))
def _(s: Star):
    return s.corpus().select("name", tx.sanitize_flat("text").alias("text"))


@query("fn_html", sql(f"SELECT page_id, {strip_ws(strip_markup('body'))} AS body FROM (SELECT page_id, {unescape('html')} AS body FROM pages CROSS JOIN entity_names)"))
def _(s: Star):
    return s.texts("pages").select("page_id", tx.strip_ws(tx.strip_markup(tx.unescape_html("html"))).alias("body"))


def chunk_levels(size: int, overlap: int, separators: tuple[str, ...]) -> str:
    """Recursive chunks as sets. A level cuts the spans that are still too long at one separator; neighbouring short pieces are a run.
    Runs are packed by a recursion over their chunks, which reads where pieces start and end; nothing is read piece by piece."""
    parts = ["open_0 AS (SELECT name, 0::BIGINT AS lo, length(text) AS n FROM clean_corpus)"]
    for i, sep in enumerate(separators):
        mark, wide = " || ".join(f"chr({ord(c)})" for c in sep), len(sep)
        parts.append(f"""span_{i} AS (SELECT o.name, lo, n, substring(text, lo + 1, n) AS body FROM open_{i} o JOIN clean_corpus c ON c.name = o.name),
cut_{i} AS (
  SELECT name, lo AS span, k, CASE WHEN k > 1 THEN {wide} ELSE 0 END + length(piece) AS n FROM (
    SELECT name, lo, unnest(string_split(body, {mark})) AS piece, unnest(range(1, len(string_split(body, {mark})) + 1)) AS k FROM span_{i} WHERE contains(body, {mark}))),
placed_{i} AS (
  SELECT name, span, pos, n, SUM(CASE WHEN n >= {size} THEN 1 ELSE 0 END) OVER (PARTITION BY name, span ORDER BY pos) AS run FROM (
    SELECT name, span, n, (span + COALESCE(SUM(n) OVER (PARTITION BY name, span ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::BIGINT AS pos FROM cut_{i})
  WHERE n > 0),
open_{i + 1} AS (SELECT name, pos AS lo, n FROM placed_{i} WHERE n >= {size} UNION ALL SELECT name, lo, n FROM span_{i} WHERE NOT contains(body, {mark}))""")
    runs = " UNION ALL ".join(f"SELECT name, list(pos ORDER BY pos) AS starts, list(pos + n ORDER BY pos) AS ends FROM placed_{i} WHERE n < {size} GROUP BY name, span, run" for i in range(len(separators)))
    step = size - overlap
    parts.append(f"""runs AS ({runs}),
filled AS (
  SELECT name, starts, ends, starts[1] AS lo, list_max(list_filter(ends, lambda e: e <= starts[1] + {size})) AS hi FROM runs
  UNION ALL
  SELECT name, starts, ends, lo, list_max(list_filter(ends, lambda e: e <= lo + {size})) AS hi FROM (
    SELECT name, starts, ends, list_min(list_filter(starts, lambda x: x >= hi - {overlap} AND x >= list_min(list_filter(ends, lambda e: e > hi)) - {size})) AS lo
    FROM filled WHERE hi < list_max(ends))),
uncut AS (
  SELECT name, lo + {step} * unnest(range(0, GREATEST(CAST(ceil((n - {overlap}) / {step}e0) AS BIGINT), 1))) AS pos, lo + n AS hi FROM open_{len(separators)}),
spans AS (SELECT name, lo, hi FROM filled UNION ALL SELECT name, pos, LEAST(pos + {size}, hi) FROM uncut)""")
    body = f"SELECT c.name, owner, confidentiality, lo, {strip_ws('substring(text, lo + 1, hi - lo)')} AS content FROM spans s JOIN clean_corpus c ON c.name = s.name"
    return "WITH " + ",\n".join(parts) + f"\nSELECT name, owner, confidentiality, row_number() OVER (PARTITION BY name ORDER BY lo) - 1 AS idx, content FROM ({body}) WHERE content <> ''"


# Separators from coarse to fine.
@query("chunk_documents", sql(chunk_levels(1000, 150, ("\n\n", "\n", "。", ".", " ")), recursive=True))
def _(s: Star):
    return corpus.chunk_documents(clean(s))


@query("chunk_fixed", sql("SELECT * FROM fixed_chunks"))
def _(s: Star):
    return corpus.chunk_fixed(clean(s))


@query("chunk_metadata", sql("SELECT * FROM described_chunks"))
def _(s: Star):
    return described(s)


@query("chunk_preview", sql("SELECT chunk_id, source, page, owner, confidentiality, section, left(content, 500) AS content FROM described_chunks ORDER BY chunk_id LIMIT 200"))
def _(s: Star):
    return corpus.chunk_preview(described(s))


@query("guess_section", sql(f"SELECT name, {section_sql('text')} AS section FROM clean_corpus"))
def _(s: Star):
    return clean(s).select("name", tx.guess_section("text").alias("section"))


@query("metadata_filter", sql("SELECT chunk_id, owner, confidentiality FROM described_chunks WHERE owner = 'src3' AND confidentiality IN ('public', 'internal') AND confidentiality = 'public'"))
def _(s: Star):
    return corpus.metadata_filter(described(s), "src3", "public", ("public", "internal")).select("chunk_id", "owner", "confidentiality")


MARKDOWN = rf"""
SELECT name, list_aggregate(list_filter(list_transform(regexp_split_to_array(text, '{LINES}'),
       lambda l: {squeeze("replace(replace(regexp_replace(" + strip_ws('l') + rf", '^(?:[-*+][{WS}]+|[0-9]+[.)][{WS}]+)', ''), '**', ''), '__', '')")}), lambda l: l <> ''), 'string_agg', chr(10)) AS plain FROM clean_corpus
"""


@query("markdown_to_plain", sql(MARKDOWN))
def _(s: Star):
    return clean(s).select("name", F.nullif(tx.markdown_to_plain("text"), F.lit("")).alias("plain"))


# --- retrieval ------------------------------------------------------------------------------------------

# Intents made of syllables that occur in the shared texts.
HINTS = ((("heren", "tion"), ("that", "Thou", "ble")), (("schul", "eau"), ("lich", "ment", "keit", "ier")))
FOCUS = ((("heren", "zzz"), ("that", "ble", "keit", "schein")), (("the",), ("hein", "ier")))
TOP_K, POOL_K = 4, 20


def contains_any(c: str, terms) -> str:
    return "(" + " OR ".join(f"contains({c}, {quoted(t)})" for t in terms) + ")"


def hits(c: str, terms) -> str:
    return "(" + " + ".join(f"CAST(contains({c}, {quoted(t)}) AS INTEGER)" for t in terms) + ")"


EXPAND = "[trim(rewritten), trim(question)]" + "".join(
    f" || CASE WHEN {contains_any('question', a)} THEN [question || {quoted(' ' + ' '.join(r))}, {quoted(' '.join(r))}] ELSE []::VARCHAR[] END" for a, r in HINTS
)


@query("expand_queries", sql(f"""
SELECT query_id, ROW_NUMBER() OVER (PARTITION BY query_id ORDER BY first_at) - 1 AS variant, search_text FROM (
  SELECT query_id, search_text, MIN(pos) AS first_at FROM (
    SELECT query_id, UNNEST(texts) AS search_text, generate_subscripts(texts, 1) AS pos FROM (
      SELECT query_id, list_filter(list_transform({EXPAND}, lambda t: {squeeze('t')}), lambda t: t <> '') AS texts FROM questions)) GROUP BY 1, 2)
"""))
def _(s: Star):
    return retrieval.expand_queries(s.questions(), HINTS)


cte("knn_layer", f"""
SELECT query_id, variant, chunk_id, {rnd('distance', 6)} AS distance, rank_no FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY query_id, variant ORDER BY distance, chunk_id) AS rank_no FROM (
    SELECT query_id, variant, chunk_id, list_sum(list_transform(list_zip(q.embedding, k.embedding), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS distance
    FROM question_vectors q CROSS JOIN knowledge k)) WHERE rank_no <= {POOL_K}
""")
cte("pool_layer", f"""
SELECT query_id, chunk_id, MAX(GREATEST(0.35::DOUBLE, 0.95::DOUBLE - CAST(rank_no - 1 AS DOUBLE) * (0.6::DOUBLE / {POOL_K - 1}e0))) AS score FROM knn_layer GROUP BY 1, 2
""")
LEX = "LEAST(0.18::DOUBLE, 0.04::DOUBLE * len(list_filter(regexp_extract_all(lower(question), '[\\x{4e00}-\\x{9fff}]{2,}|[a-z0-9]{3,}')[1:10], lambda t: contains(lower(text), t))))"
KEY = "GREATEST(0e0, " + ", ".join(
    f"CASE WHEN ({contains_any('question', a)} OR {contains_any('lower(question)', [x.lower() for x in r])}) AND {hits('lower(text)', [x.lower() for x in r])} > 0 THEN LEAST(0.16::DOUBLE, 0.06::DOUBLE + 0.03::DOUBLE * {hits('lower(text)', [x.lower() for x in r])}) ELSE 0e0 END"
    for a, r in HINTS
) + ")"
cte("bonus_layer", f"SELECT p.query_id, q.question, k.*, p.score AS base, {LEX} AS lexical, {KEY} AS keyword FROM pool_layer p JOIN questions q ON p.query_id = q.query_id JOIN knowledge k ON p.chunk_id = k.chunk_id")
cte("fused_layer", f"""
SELECT query_id, question, chunk_id, text, source, page, section, score, rank_no FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY query_id ORDER BY score DESC, chunk_id) AS rank_no FROM (
    SELECT *, GREATEST(0e0, LEAST(1e0, base + (keyword + lexical))) AS score FROM bonus_layer)) WHERE rank_no <= {TOP_K}
""")


def relax_sql(minimum: float) -> str:
    low = max(0.15, minimum - 0.12)
    return f"SELECT * FROM fused_layer f WHERE score >= CASE WHEN (SELECT MAX(score) FROM fused_layer g WHERE g.query_id = f.query_id) >= {minimum}::DOUBLE THEN {minimum}::DOUBLE ELSE {low}::DOUBLE END"


cte("kept_layer", relax_sql(0.9))


def focus_case() -> str:
    cases = []
    for a, r in FOCUS:
        terms = [t.lower() for t in (*a, *r)]
        named = f"({contains_any('question', a)} OR {contains_any('lower(question)', [x.lower() for x in r])})"
        cases.append(f"WHEN {named} THEN {hits('flat', terms)} >= {2 if len(terms) >= 6 else 1}")
    return "CASE " + " ".join(cases) + " ELSE TRUE END"


cte("focus_layer", f"""
SELECT * EXCLUDE (flat, focused, anyone) FROM (SELECT *, bool_or(focused) OVER (PARTITION BY query_id) AS anyone FROM (
  SELECT *, {focus_case()} AS focused FROM (SELECT *, lower({flat_sql('text')}) AS flat FROM kept_layer))) WHERE focused OR NOT anyone
""")


def neighbours(s: Star):
    return knn_topk(s.question_vectors(), s.knowledge(), POOL_K, ["query_id", "variant"], "chunk_id")


def pool(s: Star):
    place = retrieval.rank_score(F.col("rank_no") - 1, F.lit(POOL_K))
    return retrieval.best_per_chunk(neighbours(s).withColumn("score", place))


def candidates(s: Star):
    entries = s.knowledge().drop("embedding")
    return pool(s).join(s.questions().select("query_id", "question"), "query_id").join(entries, "chunk_id")


def fused(s: Star):
    return retrieval.fuse_results(candidates(s), TOP_K, HINTS).select("query_id", "question", "chunk_id", "text", "source", "page", "section", "score", "rank_no")


def kept(s: Star):
    return retrieval.threshold_relax(fused(s), 0.9)


def focused(s: Star):
    return retrieval.focus_filter(kept(s), FOCUS)


@query("knn_topk", sql("SELECT * FROM knn_layer"))
def _(s: Star):
    return neighbours(s)


@query("knn_topk_cosine", sql(f"""
SELECT query_id, variant, chunk_id, {rnd('distance', 6)} AS distance, rank_no FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY query_id, variant ORDER BY distance, chunk_id) AS rank_no FROM (
  SELECT a.query_id, a.variant, b.vec_id AS chunk_id,
         1 - list_dot_product(a.embedding, b.embedding) / (sqrt(list_dot_product(a.embedding, a.embedding)) * sqrt(list_dot_product(b.embedding, b.embedding))) AS distance
  FROM question_vectors a CROSS JOIN vectors b)) WHERE rank_no <= 5
"""))
def _(s: Star):
    near = knn_topk(s.question_vectors(), s.vectors().withColumnRenamed("vec_id", "chunk_id"), 5, ["query_id", "variant"], "chunk_id", "cosine", query_block=256, vector_block=256)
    return near.withColumn("distance", F.col("distance") + F.lit(0.0))


@query("rank_score", sql("SELECT * FROM pool_layer"))
def _(s: Star):
    return pool(s)


@query("lexical_bonus", sql("SELECT query_id, chunk_id, lexical FROM bonus_layer"))
def _(s: Star):
    return candidates(s).select("query_id", "chunk_id", retrieval.lexical_bonus(F.col("question"), F.col("text")).alias("lexical"))


@query("keyword_bonus", sql("SELECT query_id, chunk_id, keyword FROM bonus_layer"))
def _(s: Star):
    return candidates(s).select("query_id", "chunk_id", retrieval.keyword_bonus(F.col("question"), F.col("text"), HINTS).alias("keyword"))


@query("fuse_results", sql("SELECT query_id, chunk_id, score, rank_no FROM fused_layer"))
def _(s: Star):
    return fused(s).select("query_id", "chunk_id", "score", "rank_no")


@query("threshold_relax", sql("SELECT query_id, chunk_id, score FROM kept_layer"))
def _(s: Star):
    return kept(s).select("query_id", "chunk_id", "score")


@query("focus_filter", sql("SELECT query_id, chunk_id, score FROM focus_layer"))
def _(s: Star):
    return focused(s).select("query_id", "chunk_id", "score")


@query("citations", sql("SELECT query_id, chunk_id, source, page, section, score, left(text, 260) AS snippet FROM focus_layer"))
def _(s: Star):
    return retrieval.citations(focused(s))


@query("query_confidence", sql(f"""
SELECT q.query_id, COALESCE({rnd('mean', 4)}, 0) AS confidence, COALESCE(n, 0) AS citation_cnt FROM questions q
LEFT JOIN (SELECT query_id, CAST(SUM(CAST(score AS DECIMAL(18,12))) AS DOUBLE) / COUNT(*) AS mean, COUNT(*) AS n FROM focus_layer GROUP BY 1) f ON q.query_id = f.query_id
"""))
def _(s: Star):
    return retrieval.query_confidence(s.questions(), focused(s))


@query("render_context", sql(f"""
SELECT query_id, string_agg('[C' || n || '] source=' || source || ' page=' || page || ' section=' || section || ' score=' || CAST(CAST({rnd('score', 3)} AS DECIMAL(6,3)) AS VARCHAR) || chr(10) || {flat_sql('text')}, chr(10) || chr(10) ORDER BY n) AS context
FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY query_id ORDER BY score DESC, chunk_id) AS n FROM focus_layer) GROUP BY 1
"""))
def _(s: Star):
    return retrieval.render_context(focused(s))


# Every other part of the policy sentence depends on the document, so facts are found, missing or repeated.
cte("policy_text", """
SELECT doc_id, text || ' Employees receive ' || (n_chars % 30) || ' days annual leave. Standard hours are Monday to Friday, 0' || (n_chars % 10) || ':00 to 18:00.'
       || CASE WHEN lang = 'en' THEN ' Purchases above ' || n_chars || ',000 CNY require department head approval. Standard payment terms are Net ' || (doc_id % 90) || '.' ELSE '' END AS text FROM documents
""")


def fact_sql(name: str) -> str:
    patterns = retrieval.POLICY_FACTS[name]
    return "COALESCE(" + ", ".join(f"NULLIF(regexp_extract(text, '{p}', {group}), '')" for p, group in patterns) + f") AS {name}"


@query("policy_fact_extract", sql(f"SELECT doc_id, {', '.join(fact_sql(n) for n in retrieval.POLICY_FACTS)} FROM policy_text"))
def _(s: Star):
    n, d = F.col("n_chars"), F.col("doc_id")
    english = F.concat(
        F.lit(" Purchases above "), n.cast("string"), F.lit(",000 CNY require department head approval. Standard payment terms are Net "), F.pmod(d, F.lit(90)).cast("string"), F.lit(".")
    )
    text = F.concat(
        "text", F.lit(" Employees receive "), F.pmod(n, F.lit(30)).cast("string"), F.lit(" days annual leave. Standard hours are Monday to Friday, 0"),
        F.pmod(n, F.lit(10)).cast("string"), F.lit(":00 to 18:00."), F.when(F.col("lang") == "en", english).otherwise(""),
    )
    docs = s.texts("documents").select("doc_id", text.alias("text"))
    return docs.select("doc_id", *[c.alias(name) for name, c in retrieval.policy_facts().items()])


WORD_CHAR = r"[\p{L}\p{M}\p{Nd}\p{Pc}]"
NUMBER = r"^(\p{Nd}+(?:\.\p{Nd}+)?)"
cte("answer_flat", f"""
SELECT request_id, flat, {squeeze(re_all(re_all('flat', r'\[C[0-9]+\]', ''), '[#*_`]+', ' '))} AS body
FROM (SELECT request_id, {flat_sql('t')} AS flat FROM (SELECT request_id, {unescape('a')} AS t FROM (SELECT request_id, COALESCE(answer, '') AS a FROM qa_audit) CROSS JOIN entity_names))
""")


def folded(source: str, text: str, start: str, unit: str, gap: str) -> str:
    """Stuttered units folded one by one from the left: `start` finds the places i of `rest` where a unit begins that comes again after
    `gap`, `unit` gives it at place i. Each step moves all up to the end of the repeats from `rest` to `done`."""
    length = f"(length(unit) + {len(gap)})"
    return f"""
SELECT request_id, 0 AS step, '' AS done, {text} AS rest FROM {source}
UNION ALL
SELECT request_id, step + 1, done || left(rest, i - 1) || unit,
       substr(rest, i + length(unit) + {length} * list_max(list_filter(range(1, length(rest) // {length} + 1), lambda n: starts_with(substr(rest, i + length(unit)), repeat('{gap}' || unit, n)))))
FROM (SELECT *, {unit.format(i='i')} AS unit FROM (SELECT *, list_min(list_filter(range(1, length(rest) + 1), lambda i: {start})) AS i FROM {{name}}) WHERE i IS NOT NULL)
"""


NUMBER_AT = f"regexp_extract(substr(rest, {{i}}), '{NUMBER.replace('{', '{{').replace('}', '}}')}', 1)"
AGAIN_AT = "list_filter([6, 5, 4, 3, 2], lambda n: substr(rest, {i} + n, n) = substr(rest, {i}, n) AND regexp_full_match(substr(rest, {i}, n), '[" + tx.HAN.replace("{", "{{").replace("}", "}}") + "]+'))[1]"
numbers = folded(
    "answer_flat", "body",
    f"regexp_matches(rest, '\\p{{Nd}} \\p{{Nd}}') AND regexp_matches(substr(rest, i, 1), '\\p{{Nd}}') AND NOT regexp_matches(substr(done || rest, length(done) + i - 1, 1), '{WORD_CHAR}')"
    f" AND starts_with(substr(rest, i + length({NUMBER_AT.format(i='i')})), ' ' || {NUMBER_AT.format(i='i')})",
    NUMBER_AT, " ",
)
phrases = folded("unstuttered", "body", f"regexp_matches(rest, '[{tx.HAN}]{{4}}') AND {AGAIN_AT.format(i='i')} IS NOT NULL", f"substr(rest, {{i}}, {AGAIN_AT})", "")
cte("number_folds", numbers.replace("{name}", "number_folds"))
cte("unstuttered", "SELECT request_id, arg_max(done || rest, step) AS body FROM number_folds GROUP BY request_id")
cte("phrase_folds", phrases.replace("{name}", "phrase_folds"))
MARKS = "body"
for mark in "。！？；，":
    MARKS = re_all(MARKS, f"{mark}+", mark)


@query("answer_normalize", sql(f"""
SELECT request_id, CASE WHEN flat = '' THEN '{tx.FALLBACK_ANSWER}' WHEN body = '' OR regexp_matches(body, '[。！？]$') THEN body ELSE body || '。' END AS answer
FROM (SELECT request_id, flat FROM answer_flat) JOIN (SELECT request_id, {MARKS} AS body FROM (SELECT request_id, arg_max(done || rest, step) AS body FROM phrase_folds GROUP BY request_id)) USING (request_id)
""", recursive=True))
def _(s: Star):
    return s.qa_audit().select("request_id", tx.normalize_answer("answer").alias("answer"))


FLAT = squeeze("COALESCE(answer, '')")
WINDOW = rf"regexp_extract(flat, '^(?:[{WS}]*[^{WS}]){{240}}')"
cte("fit_base", rf"""
SELECT request_id, flat, length({re_all('flat', f'[{WS}]+', '')}) AS visible, {WINDOW} AS win, regexp_extract({WINDOW}, '^(?s:.*)[。！？；]') AS sentence
FROM (SELECT request_id, {FLAT} AS flat FROM qa_audit)
""")


@query("answer_fit_length", sql("""
SELECT request_id, CASE WHEN visible <= 240 THEN flat WHEN length(sentence) > 60 THEN sentence WHEN regexp_matches(win, '[。！？]$') THEN win
       ELSE left(win, length(win) - 1) || '。' END AS answer FROM fit_base
"""))
def _(s: Star):
    return s.qa_audit().select("request_id", tx.fit_answer("answer").alias("answer"))


# Repetition without back-references: a piece equals what follows it, looked for at every place and length.
AGAIN = "len(list_filter(range(1, length(compact)::BIGINT + 1), lambda i: len(list_filter(range(4, 13), lambda n: i + 2 * n - 1 <= length(compact) AND substr(compact, i, n) = substr(compact, i + n, n))) > 0)) > 0"
DAYS = (
    f"len(list_filter(range(1, length(a)::BIGINT + 1), lambda i: len(list_filter(range(2, 13), lambda n: regexp_full_match(substr(a, i, n), '[0-9]+[{WS}]*天')"
    " AND len(list_filter(range(0, 7), lambda g: substr(a, i + n + g, n) = substr(a, i, n))) > 0)) > 0)) > 0"
)


@query("answer_quality_flag", sql(f"""
SELECT request_id, a = '' OR (regexp_matches('问题 ' || question, '[{tx.HAN}]') AND (
       compact = '' OR length(regexp_replace(compact, '[^A-Za-z]', '', 'g')) > 0.30::DOUBLE * length(compact) OR (contains(a, '天') AND {DAYS}) OR regexp_matches(a, '[0-9]{{3}}')
       OR contains(a, '助手') OR contains(lower(a), 'assistant') OR regexp_matches(a, '[0-9][{WS}]*,[{WS}]*[0-9]') OR {AGAIN})) AS low_quality
FROM (SELECT request_id, question, COALESCE(answer, '') AS a, {re_all("COALESCE(answer, '')", f'[{WS}]+', '')} AS compact FROM qa_audit)
"""))
def _(s: Star):
    return s.qa_audit().select("request_id", tx.low_quality_answer(F.concat(F.lit("问题 "), "question"), "answer").alias("low_quality"))


@query("qa_audit_metrics", sql(f"""
SELECT COUNT(*) AS total_queries, COALESCE({rnd('CAST(SUM(latency_ms) AS DOUBLE) / COUNT(latency_ms)', 2)}, 0) AS avg_latency_ms,
       COALESCE({rnd('CAST(SUM(CAST(confidence AS DECIMAL(18,6))) AS DOUBLE) / COUNT(confidence)', 4)}, 0) AS avg_confidence FROM qa_audit
"""))
def _(s: Star):
    return retrieval.qa_audit_metrics(s.qa_audit())
