"""SQL counterparts of the registered queries, for DuckDB."""

from __future__ import annotations

from glosswork.fixed_values import (
    BM25_B,
    BM25_K1,
    PROMPT_HEAD,
    PROMPT_MIDDLE,
    PROMPT_TAIL,
    STOP_WORDS,
    TOPIC_KEYWORDS,
)
from glosswork.functions.stemming import IRREGULAR, STEP_2, STEP_3, STEP_4
from glosswork.functions.text import SEGMENT

SEG = SEGMENT.replace("\\n", "\n")
STOPS = ", ".join(f"'{w}'" for w in STOP_WORDS)
TOPIC_MAP = TOPIC_KEYWORDS + [
    ("ingor", "src1"), ("ention", "src2"), ("ouer", "src3"), ("tion", "src4"),
    ("heit", "src6"), ("ment", "src7"),
]
TOPIC_CASE = (
    "CASE "
    + " ".join(f"WHEN contains(lower(query), '{k}') THEN '{v}'" for k, v in TOPIC_MAP)
    + " ELSE NULL END"
)
WIDE = (
    r"[\x0b\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
)
WORDS = r"regexp_extract_all(lower({0}), '[a-z0-9]+')"
CLEAN = rf"regexp_replace(regexp_replace(query, '{WIDE}', ' ', 'g'), '[^a-zA-Z0-9\s]', '', 'g')"
QWORDS = rf"regexp_split_to_array(lower({CLEAN}), '\s+')"


def words(column: str) -> str:
    return WORDS.format(column)


def q(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def chain(*parts: str) -> str:
    """CTE parts joined; the last part is the final SELECT."""
    return "WITH RECURSIVE " + ",\n".join(parts[:-1]) + "\n" + parts[-1]


DOCS = """docs AS (
  SELECT md5(text) AS abstract_id, min(text) AS abstract, min(doc_id) AS doc_id,
         arg_min(source, doc_id) AS source
  FROM documents WHERE text IS NOT NULL GROUP BY 1)"""

KNOWN = """known AS (
  SELECT DISTINCT md5(d.text) AS abstract_id
  FROM documents d WHERE EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id))"""

SUMMARIES = f"""lens AS (
  SELECT *, len({words('abstract')}) AS n FROM docs),
summaries AS (
  SELECT abstract_id, abstract AS summary, n,
         CASE WHEN n > 0 THEN 2 * least(n, 100) / (n + least(n, 100))::DOUBLE ELSE 0.0 END
           AS rouge_score,
         CAST(substr(source, 4) AS INTEGER) AS topic_id, source AS topic_label
  FROM lens)"""

QUERIES = f"""queries AS (
  SELECT item_id * 1000 + i - 1 AS query_id, trim(parts[i]) AS query
  FROM (SELECT item_id, regexp_extract_all(text, '{SEG}') AS parts FROM benchmark),
       unnest(range(1, len(parts) + 1)) t(i))"""

EXTRACT = f"""segs AS (
  SELECT abstract_id, i - 1 AS pos, trim(parts[i]) AS seg
  FROM (SELECT abstract_id, regexp_extract_all(abstract, '{SEG}') AS parts FROM docs),
       unnest(range(1, len(parts) + 1)) t(i)),
seg_words AS (
  SELECT abstract_id, pos, unnest({words('seg')}) AS w FROM segs),
seg_counts AS (
  SELECT abstract_id, pos, CASE WHEN w IN ({STOPS}) THEN '' ELSE w END AS term, count(*) AS n
  FROM seg_words GROUP BY ALL),
seg_tf AS (
  SELECT *, sum(n) OVER (PARTITION BY abstract_id, term) AS tf FROM seg_counts),
seg_scores AS (
  SELECT abstract_id, pos, sum(n) AS words,
         sum(CASE WHEN term <> '' THEN n * tf ELSE 0 END)::DOUBLE / sum(n)::DOUBLE AS score
  FROM seg_tf GROUP BY ALL),
seg_lists AS (
  SELECT abstract_id, list({{'n': words::BIGINT, 'p': [pos]}} ORDER BY score DESC, pos) AS l
  FROM seg_scores GROUP BY 1),
filled AS (
  SELECT abstract_id, f.n AS m, f.p AS picks
  FROM (SELECT abstract_id, list_reduce(l, lambda acc, x: CASE WHEN acc.n + x.n <= 100
            THEN {{'n': acc.n + x.n, 'p': list_concat(acc.p, x.p)}} ELSE acc END,
          {{'n': 0::BIGINT, 'p': []::BIGINT[]}}) AS f
        FROM seg_lists)),
chosen AS (
  SELECT d.abstract_id, coalesce(any_value(f.m), 0) AS m,
         coalesce(string_agg(s.seg, ' ' ORDER BY s.pos), '') AS summary
  FROM docs d LEFT JOIN filled f USING (abstract_id) LEFT JOIN segs s
    ON s.abstract_id = f.abstract_id AND list_contains(f.picks, s.pos)
  GROUP BY 1)"""

# A summary made of whole segments in text order is a subsequence of the text,
# so its longest common subsequence with it is the summary itself.
SCORED = f"""scored AS (
  SELECT c.abstract_id, d.source, c.summary,
         CASE WHEN c.m > 0 THEN CAST(2.0 * c.m::DOUBLE / (c.m + len({words('d.abstract')}))::DOUBLE AS FLOAT)
              ELSE 0 END AS rouge_score
  FROM chosen c JOIN docs d USING (abstract_id))"""

REAL = f"""summaries AS (
  SELECT abstract_id, summary, len({words('summary')}) AS n, rouge_score::DOUBLE AS rouge_score,
         CAST(substr(source, 4) AS INTEGER) AS topic_id, source AS topic_label
  FROM scored WHERE rouge_score::DOUBLE >= 0.15::DOUBLE)"""

PAIRS = f"""pairs AS (
  SELECT u.conv_id, u.turn, {words('u.text')} AS a, {words('v.text')} AS b
  FROM conversations u JOIN conversations v ON v.conv_id = u.conv_id AND v.turn = u.turn + 1
  WHERE u.role = 'user' AND v.role = 'assistant')"""

ALL_TURNS = f"""pairs AS (
  SELECT u.conv_id, u.turn, {words('u.text')} AS a, {words("coalesce(v.text, '')")} AS b
  FROM conversations u
    LEFT JOIN conversations v ON v.conv_id = u.conv_id AND v.turn = u.turn + 1 AND v.role = 'assistant'
  WHERE u.role = 'user')"""

LCS = """lcs AS (
  SELECT conv_id, turn, 0 AS i, list_transform(range(0, len(b) + 1), lambda j: 0) AS row
  FROM pairs
  UNION ALL
  SELECT conv_id, turn, i + 1,
         list_transform(range(1, len(step) + 1), lambda j: list_max(step[1:j]))
  FROM (
    SELECT l.conv_id, l.turn, l.i,
           list_transform(range(0, len(p.b) + 1), lambda j: CASE
             WHEN j > 0 AND p.a[l.i + 1] = p.b[j] THEN l.row[j] + 1 ELSE l.row[j + 1] END) AS step
    FROM lcs l JOIN pairs p ON p.conv_id = l.conv_id AND p.turn = l.turn
    WHERE l.i < len(p.a)))"""

LCS_RESULT = """
SELECT p.conv_id, p.turn,
       round(CAST(CASE WHEN len(p.a) = 0 OR len(p.b) = 0 THEN 0
         ELSE 2.0 * l.row[len(l.row)]::DOUBLE / (len(p.a) + len(p.b))::DOUBLE END AS FLOAT)::DOUBLE, 6)
         AS rouge_score
FROM pairs p JOIN lcs l ON l.conv_id = p.conv_id AND l.turn = p.turn AND l.i = len(p.a)"""

POSTINGS = f"""postings AS (
  SELECT term, abstract_id, count(*)::INTEGER AS tf, any_value(n)::INTEGER AS doc_len
  FROM (SELECT abstract_id, n, unnest({words('summary')}) AS term FROM summaries)
  WHERE term NOT IN ({STOPS}) GROUP BY term, abstract_id),
terms AS (SELECT term, count(*) AS df FROM postings GROUP BY term),
totals AS (SELECT count(*) AS n_docs, avg(n) AS mean_len FROM summaries)"""

QTERMS = f"""qterms AS (
  SELECT DISTINCT query_id, term
  FROM (SELECT query_id, unnest({QWORDS}) AS term FROM queries)
  WHERE length(term) > 2 AND term NOT IN ({STOPS}))"""

HITS = f"""need AS (SELECT query_id, count(*) AS n_terms FROM qterms GROUP BY 1),
hits AS (
  SELECT q.query_id, p.abstract_id, count(*) AS n,
         sum(ln(1 + (n_docs - df + 0.5) / (df + 0.5)) * tf * ({BM25_K1} + 1)
           / (tf + {BM25_K1} * (1 - {BM25_B} + {BM25_B} * doc_len / mean_len))) AS relevance
  FROM qterms q JOIN postings p USING (term) JOIN terms USING (term), totals
  GROUP BY 1, 2),
matches AS (
  SELECT h.query_id, h.abstract_id, h.relevance, s.rouge_score, s.summary, s.topic_label
  FROM hits h JOIN need USING (query_id) JOIN summaries s USING (abstract_id)
  WHERE h.n = n_terms)"""

FOUND = """found AS (
  SELECT *, 1 AS stage FROM matches
  QUALIFY row_number() OVER (PARTITION BY query_id
    ORDER BY round(relevance, 6) DESC, rouge_score DESC NULLS LAST, abstract_id) <= 16)"""

KEYWORDS = f"""qkeywords AS (
  SELECT DISTINCT query_id, keyword
  FROM (SELECT query_id, unnest({QWORDS}) AS keyword FROM queries) WHERE length(keyword) > 3),
keyword_hits AS (
  SELECT DISTINCT k.query_id, s.abstract_id, s.rouge_score
  FROM qkeywords k JOIN summaries s ON contains(lower(s.summary), k.keyword)),
keyword_top AS (
  SELECT * FROM keyword_hits
  QUALIFY row_number() OVER (PARTITION BY query_id
    ORDER BY rouge_score DESC NULLS LAST, abstract_id) <= 16)"""

CASCADE = """short1 AS (
  SELECT query_id FROM queries LEFT JOIN found USING (query_id)
  GROUP BY 1 HAVING count(abstract_id) < 4),
added AS (
  SELECT k.query_id, k.abstract_id, 2 AS stage, 0.1::DOUBLE AS relevance, k.rouge_score
  FROM keyword_top k JOIN short1 USING (query_id)
  WHERE NOT EXISTS (SELECT 1 FROM found f
    WHERE f.query_id = k.query_id AND f.abstract_id = k.abstract_id)),
two AS (
  SELECT query_id, abstract_id, stage, relevance, rouge_score FROM found
  UNION ALL SELECT query_id, abstract_id, stage, relevance, rouge_score FROM added),
short2 AS (
  SELECT query_id FROM queries LEFT JOIN two USING (query_id)
  GROUP BY 1 HAVING count(abstract_id) < 4),
best AS (
  SELECT abstract_id, rouge_score FROM summaries
  ORDER BY rouge_score DESC NULLS LAST, abstract_id LIMIT 8),
cascade AS (
  SELECT * FROM two
  UNION ALL
  SELECT s.query_id, b.abstract_id, 3, 0.05::DOUBLE, b.rouge_score FROM short2 s, best b
  WHERE NOT EXISTS (SELECT 1 FROM two t
    WHERE t.query_id = s.query_id AND t.abstract_id = b.abstract_id))"""

RANKED = f"""hints AS (SELECT query_id, query, {TOPIC_CASE} AS topic_hint FROM queries),
ordered AS (
  SELECT c.query_id, c.abstract_id, s.summary, s.rouge_score, s.topic_label,
         row_number() OVER (PARTITION BY c.query_id ORDER BY
           CASE WHEN s.topic_label = h.topic_hint THEN 1 ELSE 0 END DESC,
           s.rouge_score DESC NULLS LAST, c.abstract_id) AS rank
  FROM cascade c JOIN summaries s USING (abstract_id) JOIN hints h USING (query_id)),
ranked AS (SELECT * FROM ordered WHERE rank <= 8)"""

CONTEXTS = """contexts AS (
  SELECT query_id, count(*) AS sources,
         string_agg('[Topic: ' || coalesce(nullif(topic_label, ''), 'general') || ' | ROUGE-L: '
           || CAST(round(rouge_score, 3) AS VARCHAR) || ']' || chr(10) || summary,
           chr(10) || chr(10) ORDER BY rank) AS context
  FROM ranked GROUP BY 1)"""

FTS = (DOCS, SUMMARIES, QUERIES, POSTINGS, QTERMS, HITS)
STORE = (DOCS, EXTRACT, SCORED, REAL)
REAL_FTS = (*STORE, QUERIES, POSTINGS, QTERMS, HITS)
RETRIEVAL = (*REAL_FTS, FOUND, KEYWORDS, CASCADE)

MEANS = """parts AS (
  SELECT label, i AS pos, embedding[i]::DOUBLE AS x
  FROM embeddings, unnest(range(1, len(embedding) + 1)) t(i)),
means AS (
  SELECT label, list(x ORDER BY pos) AS centroid
  FROM (SELECT label, pos, avg(x) AS x FROM parts GROUP BY 1, 2) GROUP BY 1)"""

VECS = """vecs AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: x::DOUBLE) AS v FROM embeddings)"""

LABEL_TOP = """label_scores AS (
  SELECT m.label AS query_id, e.vec_id AS abstract_id,
         round(list_inner_product(e.v, m.centroid), 6) AS similarity
  FROM means m, vecs e),
label_ranks AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY similarity DESC, abstract_id) AS rank
  FROM label_scores)"""


def micro(expr: str) -> str:
    return (
        f"array_to_string(list_transform({expr}, lambda x: CAST(round(x * 1e6) AS BIGINT)), ',')"
    )


def term_counts(name: str, source: str, key: str) -> str:
    return f"""{name} AS (
  SELECT abstract_id, term, count(*) AS tf
  FROM (SELECT {key} AS abstract_id, unnest({words('body')}) AS term FROM {source})
  WHERE term NOT IN ({STOPS}) GROUP BY 1, 2)"""


def embedded(name: str, source: str) -> str:
    return f"""{name}_raw AS (
  SELECT abstract_id, ('0x' || h[1:6])::INTEGER % 384 AS bucket,
         round(sum(tf * idf * CASE WHEN ('0x' || h[7:7])::INTEGER % 2 = 1 THEN -1 ELSE 1 END), 9) AS w
  FROM (SELECT abstract_id, tf, md5(term) AS h,
          coalesce(idf, ln((SELECT 1 + count(*) FROM docs)::DOUBLE) + 1) AS idf
        FROM {source} LEFT JOIN idf USING (term))
  GROUP BY 1, 2),
{name} AS (
  SELECT abstract_id, bucket, CASE WHEN s = 0 THEN 0 ELSE w / s END AS w
  FROM (SELECT *, sqrt(sum(w * w) OVER (PARTITION BY abstract_id)) AS s FROM {name}_raw))"""


EMBED = (
    DOCS,
    "bodies AS (SELECT abstract_id, abstract AS body FROM docs)",
    term_counts("doc_terms", "bodies", "abstract_id"),
    """idf AS (
  SELECT term, ln((1 + n)::DOUBLE / (1 + df)::DOUBLE) + 1 AS idf
  FROM (SELECT term, count(*) AS df FROM doc_terms GROUP BY 1),
       (SELECT count(*) AS n FROM docs))""",
    embedded("doc_vectors", "doc_terms"),
)

NGRAMS = f"""kept AS (
  SELECT abstract_id, topic_id,
         list_filter({words('summary')}, lambda t: t NOT IN ({STOPS})) AS w
  FROM summaries),
grams AS (
  SELECT abstract_id, topic_id, unnest(w) AS term FROM kept
  UNION ALL
  SELECT abstract_id, topic_id, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))
  FROM kept WHERE len(w) > 1),
counts AS (
  SELECT topic_id, term, count(*) AS tf, count(DISTINCT abstract_id) AS n_docs
  FROM grams GROUP BY 1, 2)"""

CTFIDF = """tdf AS (
  SELECT term, sum(n_docs) AS df, sum(tf) AS total FROM counts GROUP BY 1 HAVING sum(n_docs) >= 2),
used AS (SELECT c.topic_id, c.term, c.tf, t.total FROM counts c JOIN tdf t USING (term)),
sizes AS (SELECT topic_id, sum(tf) AS size FROM used GROUP BY 1),
tterms AS (
  SELECT u.topic_id, u.term,
         u.tf::DOUBLE / s.size::DOUBLE * ln(1 + (SELECT avg(size) FROM sizes) / u.total::DOUBLE) AS weight
  FROM used u JOIN sizes s USING (topic_id))"""

NOISY = SUMMARIES.replace(
    "CAST(substr(source, 4) AS INTEGER) AS topic_id",
    "CASE WHEN CAST(substr(source, 4) AS INTEGER) < 2 THEN -1"
    " ELSE CAST(substr(source, 4) AS INTEGER) END AS topic_id",
)

LABELS = """label_words AS (
  SELECT topic_id, string_agg(term, '_' ORDER BY r) AS words
  FROM (SELECT *, row_number() OVER (PARTITION BY topic_id ORDER BY round(weight, 9) DESC, term) AS r
        FROM tterms) WHERE r <= 3 GROUP BY 1),
labels_out AS (
  SELECT topic_id, CASE WHEN topic_id = -1 THEN 'outlier'
    ELSE coalesce(words, 'topic_' || topic_id) END AS topic_label
  FROM (SELECT DISTINCT topic_id FROM summaries) LEFT JOIN label_words USING (topic_id))"""

ASSIGN = """unit AS (
  SELECT vec_id, list_transform(v, lambda x: x / sqrt(list_inner_product(v, v))) AS v FROM vecs),
unit_means AS (
  SELECT label, list_transform(centroid, lambda x: x / sqrt(list_inner_product(centroid, centroid))) AS c
  FROM means),
cosines AS (
  SELECT u.vec_id, m.label, list_inner_product(u.v, m.c) AS similarity
  FROM unit u, unit_means m)"""


# Porter stemming as SQL, one CTE per step, over the distinct words in ``vocab``.
C, V = "[^aeiou][^aeiouy]*", "[aeiouy][aeiou]*"
# A first y is a consonant.
START = f"^({C}[aeiouy]|[aeiou])[aeiou]*"
M0, M1 = f"{START}{C}", f"{START}{C}{V}{C}"
M_IS_1 = f"{START}{C}({V})?$"
HAS_VOWEL = START
SHORT_END = f"^{C}[aeiouy][^aeiouwxy]$|^[aeiou][^aeiou]$"


def rest(n: int) -> str:
    return f"left(w, length(w) - {n})"


def has(text: str, pattern: str) -> str:
    return f"regexp_matches({text}, '{pattern}')"


def swaps(rules: list[tuple[str, str]], pattern: str, tail: str = "") -> str:
    cases = [
        f"WHEN ends_with(w, '{suffix}') THEN CASE WHEN {has(rest(len(suffix)), pattern)}"
        f" THEN {rest(len(suffix))} || '{new}' ELSE w END"
        for suffix, new in rules
    ]
    return "CASE " + " ".join(cases) + f" {tail} ELSE w END"


STEP_2A = swaps(STEP_2, M0, f"WHEN ends_with(w, 'logi') AND {has(rest(3), M0)} THEN {rest(1)}")
STEP_4A = "CASE " + " ".join(
    f"WHEN ends_with(w, '{x}')"
    + (f" AND {has(rest(3), '[st]$')}" if x == "ion" else "")
    + f" THEN CASE WHEN {has(rest(len(x)), M1)} THEN {rest(len(x))} ELSE w END"
    for x in STEP_4
) + " ELSE w END"
STEMS = f"""step1a AS (
  SELECT term, CASE
    WHEN ends_with(term, 'sses') THEN left(term, length(term) - 2)
    WHEN ends_with(term, 'ies') THEN left(term, length(term) - CASE WHEN length(term) = 4 THEN 1 ELSE 2 END)
    WHEN ends_with(term, 's') AND NOT ends_with(term, 'ss') THEN left(term, length(term) - 1)
    ELSE term END AS w FROM vocab),
step1b AS (
  SELECT term, CASE WHEN ending = '' THEN w ELSE CASE
    WHEN ending = 'ied' THEN left(w, length(w) - CASE WHEN length(w) = 4 THEN 1 ELSE 2 END)
    WHEN ending = 'eed' THEN CASE WHEN {has(rest(3), M0)} THEN {rest(1)} ELSE w END
    WHEN NOT {has('r', HAS_VOWEL)} THEN w
    WHEN {has('r', '(at|bl|iz)$')} THEN r || 'e'
    WHEN right(r, 1) = substr(r, -2, 1) AND length(r) > 1 AND r <> 'yy' AND {has('r', '[^aeiou]$')}
      THEN CASE WHEN {has('r', '[lsz]$')} THEN r ELSE left(r, length(r) - 1) END
    WHEN {has('r', M_IS_1)} AND {has('r', SHORT_END)} THEN r || 'e'
    ELSE r END END AS w
  FROM (SELECT *, CASE WHEN ending IN ('ed', 'ing') THEN left(w, length(w) - length(ending)) END AS r
        FROM (SELECT *, regexp_extract(w, '(ied|eed|ed|ing)$', 1) AS ending FROM step1a))),
step1c AS (
  SELECT term, CASE WHEN length(w) > 2 AND {has('w', '[^aeiou]y$')} THEN {rest(1)} || 'i' ELSE w END AS w
  FROM step1b),
step2z AS (
  SELECT term, CASE WHEN ends_with(w, 'alli') AND {has(rest(4), M0)} THEN {rest(2)} ELSE w END AS w
  FROM step1c),
step2 AS (SELECT term, {STEP_2A} AS w FROM step2z),
step3 AS (SELECT term, {swaps(STEP_3, M0)} AS w FROM step2),
step4 AS (SELECT term, {STEP_4A} AS w FROM step3),
step5a AS (
  SELECT term, CASE WHEN ends_with(w, 'e') AND ({has(rest(1), M1)}
    OR ({has(rest(1), M_IS_1)} AND NOT {has(rest(1), SHORT_END)})) THEN {rest(1)} ELSE w END AS w
  FROM step4),
stems AS (
  SELECT term, CASE {' '.join(f"WHEN term = '{a}' THEN '{b}'" for a, b in IRREGULAR.items())}
    WHEN length(term) <= 2 THEN term
    WHEN ends_with(w, 'll') AND {has(rest(1), M1)} THEN {rest(1)} ELSE w END AS stem
  FROM step5a)"""

STEMMED_FTS = (
    DOCS,
    SUMMARIES,
    QUERIES,
    f"""raw_terms AS (
  SELECT abstract_id, n, unnest({words('summary')}) AS term FROM summaries),
raw_qterms AS (SELECT query_id, unnest({QWORDS}) AS term FROM queries),
vocab AS (SELECT term FROM raw_terms UNION SELECT term FROM raw_qterms)""",
    STEMS,
    f"""postings AS (
  SELECT stem AS term, abstract_id, count(*)::INTEGER AS tf, any_value(n)::INTEGER AS doc_len
  FROM raw_terms JOIN stems USING (term) WHERE term NOT IN ({STOPS}) GROUP BY 1, 2),
terms AS (SELECT term, count(*) AS df FROM postings GROUP BY term),
totals AS (SELECT count(*) AS n_docs, avg(n) AS mean_len FROM summaries),
qterms AS (
  SELECT DISTINCT query_id, stem AS term FROM raw_qterms JOIN stems USING (term)
  WHERE length(term) > 2 AND term NOT IN ({STOPS}))""",
    HITS,
)


def stemmed_list(side: str) -> str:
    return f"""list_{side} AS (
  SELECT conv_id, turn, list(CASE WHEN length(term) > 3 THEN stem ELSE term END ORDER BY i) AS {side}
  FROM (SELECT conv_id, turn, i, {side}[i] AS term FROM surface, unnest(range(1, len({side}) + 1)) t(i))
  JOIN stems USING (term) GROUP BY 1, 2)"""


STEMMED_PAIRS = (
    PAIRS.replace("pairs AS", "surface AS"),
    "vocab AS (SELECT unnest(a) AS term FROM surface UNION SELECT unnest(b) FROM surface)",
    STEMS,
    stemmed_list("a"),
    stemmed_list("b"),
    """pairs AS (
  SELECT s.conv_id, s.turn, coalesce(x.a, []) AS a, coalesce(y.b, []) AS b
  FROM surface s LEFT JOIN list_a x USING (conv_id, turn) LEFT JOIN list_b y USING (conv_id, turn))""",
)


# Cosine of the term weights of two topics.
TOPIC_COSINES = """norms AS (
  SELECT topic_id, sqrt(sum(weight * weight)) AS norm FROM tterms GROUP BY 1),
cosines AS MATERIALIZED (
  SELECT x.topic_id AS a, y.topic_id AS b,
    least(1.0, round(sum(x.weight * y.weight) / any_value(m.norm * n.norm), 6)) AS cosine
  FROM tterms x JOIN tterms y ON x.term = y.term AND x.topic_id < y.topic_id
    JOIN norms m ON m.topic_id = x.topic_id JOIN norms n ON n.topic_id = y.topic_id
  GROUP BY 1, 2)"""

# The 15 nearest other vectors, and pairs of them by mutual reachability.
NEAR = (
    """unit AS MATERIALIZED (
  SELECT vec_id, list_transform(v, lambda x: x / sqrt(list_inner_product(v, v))) AS u
  FROM vecs WHERE list_inner_product(v, v) > 0)""",
    """near AS MATERIALIZED (
  SELECT a.vec_id AS abstract_id, b.vec_id AS neighbour,
    round(sqrt(greatest(0, 2 - 2 * round(list_inner_product(a.u, b.u), 6))), 6) AS distance
  FROM unit a, unit b WHERE a.vec_id <> b.vec_id
  QUALIFY row_number() OVER (
    PARTITION BY a.vec_id ORDER BY round(list_inner_product(a.u, b.u), 6) DESC, b.vec_id) <= 15)""",
)
REACH = (
    """core AS MATERIALIZED (
  SELECT abstract_id, list_sort(list(distance))[5] AS core FROM near GROUP BY 1 HAVING count(*) >= 5)""",
    """pairs AS (
  SELECT least(abstract_id, neighbour) AS a, greatest(abstract_id, neighbour) AS b, min(distance) AS distance
  FROM near GROUP BY 1, 2)""",
    """edges AS MATERIALIZED (
  SELECT greatest(p.distance, x.core, y.core, 1e-6) AS w, p.a, p.b
  FROM pairs p JOIN core x ON x.abstract_id = p.a JOIN core y ON y.abstract_id = p.b)""",
)


def oracle_sql() -> dict[str, str]:
    sql = {}
    sql["corpus_scan"] = "SELECT doc_id, text AS abstract FROM documents"
    sql["content_ids"] = (
        "SELECT doc_id, md5(text) AS abstract_id FROM documents WHERE text IS NOT NULL"
    )
    sql["distinct_documents"] = chain(DOCS, "SELECT abstract_id, abstract, doc_id, source FROM docs")
    sql["incremental_new"] = chain(
        DOCS, KNOWN,
        "SELECT abstract_id, doc_id FROM docs WHERE abstract_id NOT IN (SELECT abstract_id FROM known)",
    )
    sql["ingest_accounting"] = chain(
        KNOWN,
        """SELECT count(*) AS loaded, count(k.abstract_id) AS skipped,
  count(*) - count(k.abstract_id) AS new
FROM documents d LEFT JOIN known k ON k.abstract_id = md5(d.text) WHERE d.text IS NOT NULL""",
    )
    sql["ingest_stream"] = "SELECT DISTINCT md5(text) AS abstract_id FROM documents"
    sql["extractive_summary"] = chain(DOCS, EXTRACT, "SELECT abstract_id, summary FROM chosen")
    segs, seg_words = EXTRACT.split(",\nseg_counts")[0], "seg_sizes AS (SELECT abstract_id, pos, count(*) AS n FROM seg_words GROUP BY 1, 2)"
    sql["lead_summary"] = chain(
        DOCS, segs, seg_words,
        """led AS (
  SELECT s.abstract_id, s.pos, s.seg, sum(z.n) OVER (PARTITION BY s.abstract_id ORDER BY s.pos) AS upto
  FROM segs s JOIN seg_sizes z USING (abstract_id, pos))""",
        """SELECT d.abstract_id, coalesce(string_agg(l.seg, ' ' ORDER BY l.pos), '') AS summary
FROM docs d LEFT JOIN led l ON l.abstract_id = d.abstract_id AND l.upto <= 100 GROUP BY 1""",
    )
    scored = (DOCS, EXTRACT, SCORED)
    sql["rouge_scores"] = chain(
        *scored, "SELECT abstract_id, round(rouge_score::DOUBLE, 6) AS rouge_score FROM scored"
    )
    sql["quality_gate"] = chain(
        *scored,
        """SELECT abstract_id, round(rouge_score::DOUBLE, 6) AS rouge_score
FROM scored WHERE rouge_score::DOUBLE >= 0.15::DOUBLE""",
    )
    sql["gate_accounting"] = chain(
        *scored,
        """SELECT count(*) AS total, count(*) FILTER (rouge_score::DOUBLE >= 0.15::DOUBLE) AS kept,
  count(*) FILTER (rouge_score::DOUBLE < 0.15::DOUBLE) AS blocked FROM scored""",
    )
    sql["enrich_store"] = chain(
        *scored,
        """sizes AS (
  SELECT count(*) AS total, count(*) FILTER (rouge_score::DOUBLE >= 0.15::DOUBLE) AS kept,
         (SELECT count(*) FROM documents WHERE text IS NOT NULL) AS loaded
  FROM scored)""",
        """SELECT 1 AS run, 'done' AS status, loaded, 0 AS skipped, loaded AS new, total, kept,
  total - kept AS blocked FROM sizes
UNION ALL SELECT 2, 'nothing new', loaded, loaded, 0, 0, 0, 0 FROM sizes""",
    )
    sql["enrich_contents"] = chain(
        *STORE, "SELECT abstract_id, summary, round(rouge_score, 6) AS rouge_score FROM summaries"
    )
    sql["gated_topic_stats"] = chain(
        *scored,
        """SELECT CAST(substr(source, 4) AS INTEGER) AS topic_id, source AS topic_label,
  count(*) AS count, round(avg(rouge_score::DOUBLE), 3) AS avg_rouge
FROM scored WHERE rouge_score::DOUBLE >= 0.15::DOUBLE GROUP BY 1, 2""",
    )
    sql["rouge_l_pairs"] = chain(PAIRS, LCS, LCS_RESULT)
    sql["rouge_null_safe"] = chain(ALL_TURNS, LCS, LCS_RESULT)
    sql["membership_score"] = """SELECT vec_id AS abstract_id,
  round(list_max(list_transform(embedding, lambda x: x::DOUBLE * x::DOUBLE)), 4) AS topic_score FROM embeddings"""
    sql["rouge_l_stemmed"] = chain(*STEMMED_PAIRS, LCS, LCS_RESULT)

    base = (DOCS, SUMMARIES)
    sql["corpus_stats"] = chain(
        *STORE,
        "hist AS (SELECT topic_label, count(*) AS n FROM summaries GROUP BY 1)",
        """SELECT count(*) AS count, coalesce(round(avg(rouge_score), 3), 0.0) AS avg_rouge,
  (SELECT count(*) FROM embeddings) AS vectors,
  (SELECT '{' || string_agg('"' || topic_label || '":' || n, ',' ORDER BY topic_label) || '}' FROM hist)
    AS topics
FROM summaries""",
    )
    sql["topic_histogram"] = chain(
        *STORE, "SELECT topic_label, count(*) AS cnt FROM summaries GROUP BY 1"
    )
    sql["topic_stats"] = chain(
        *STORE,
        """SELECT topic_id, topic_label, count(*) AS count, round(avg(rouge_score), 3) AS avg_rouge
FROM summaries GROUP BY 1, 2""",
    )
    sql["verify_report"] = chain(
        *STORE,
        """SELECT count(*) AS records, (SELECT count(*) FROM embeddings) AS vectors,
  round(avg(rouge_score), 3) AS avg_rouge, count(DISTINCT topic_label) AS topics FROM summaries""",
    )

    turns = "turns AS (SELECT conv_id, turn, text AS query FROM conversations WHERE role = 'user')"
    sql["query_terms"] = chain(
        turns,
        f"""SELECT conv_id, turn,
  array_to_string(list_filter({QWORDS}, lambda w: length(w) > 2), ' & ') AS terms,
  array_to_string(list_filter({QWORDS}, lambda w: length(w) > 3), ' ') AS keywords,
  trim(regexp_replace(query, '{WIDE}|\\s', ' ', 'g')) = '' AS blank
FROM turns""",
    )
    sql["detect_topic"] = chain(turns, f"SELECT conv_id, turn, {TOPIC_CASE} AS topic_hint FROM turns")
    sql["postings"] = chain(
        DOCS, SUMMARIES, POSTINGS, "SELECT term, abstract_id, tf, doc_len FROM postings"
    )
    sql["term_stats"] = chain(DOCS, SUMMARIES, POSTINGS, "SELECT term, df FROM terms")
    sql["fts_and_match"] = chain(*FTS, "SELECT query_id, abstract_id, round(relevance, 6) AS relevance FROM matches")
    sql["fts_stemmed"] = chain(*STEMMED_FTS, "SELECT query_id, abstract_id, round(relevance, 6) AS relevance FROM matches")
    sql["fts_stored_index"] = sql["fts_merged_index"] = sql["fts_and_match"]
    sql["fts_bm25_topk"] = chain(
        *FTS, FOUND,
        "SELECT query_id, abstract_id, round(relevance, 6) AS relevance, round(rouge_score, 6) AS rouge_score FROM found",
    )
    sql["incremental_search"] = chain(
        *REAL_FTS, "SELECT query_id, abstract_id, round(relevance, 6) AS relevance FROM matches"
    )
    sql["search_topk"] = chain(
        *REAL_FTS,
        f"""hints AS (SELECT query_id, {TOPIC_CASE} AS topic_hint,
    len(list_filter({QWORDS}, lambda w: length(w) > 2)) AS n FROM queries)""",
        """top AS (
  SELECT query_id, abstract_id, rouge_score, topic_label, relevance,
         row_number() OVER (PARTITION BY query_id ORDER BY round(relevance, 6) DESC, abstract_id) AS rank
  FROM matches),
best AS (
  SELECT abstract_id, rouge_score, topic_label, 0.0::DOUBLE AS relevance,
         row_number() OVER (ORDER BY rouge_score DESC NULLS LAST, abstract_id) AS rank
  FROM summaries),
merged AS (
  SELECT query_id, rank, abstract_id, rouge_score, topic_label, relevance FROM top
  UNION ALL
  SELECT h.query_id, b.rank, b.abstract_id, b.rouge_score, b.topic_label, b.relevance
  FROM hints h, best b WHERE h.n = 0)""",
        """SELECT query_id, rank, abstract_id, round(rouge_score, 3) AS rouge_score,
  topic_label AS topic, round(relevance, 4) AS relevance, topic_hint
FROM hints LEFT JOIN (SELECT * FROM merged WHERE rank <= 5) USING (query_id)""",
    )
    sql["keyword_fallback"] = chain(
        DOCS, SUMMARIES, QUERIES, KEYWORDS,
        "SELECT query_id, abstract_id, round(rouge_score, 6) AS rouge_score FROM keyword_top",
    )
    sql["keyword_merged_index"] = sql["keyword_fallback"]
    sql["keyword_stored"] = chain(
        *STORE, QUERIES, KEYWORDS,
        "SELECT query_id, abstract_id, round(rouge_score, 6) AS rouge_score FROM keyword_top",
    )
    sql["retrieval_cascade"] = chain(
        *RETRIEVAL,
        """SELECT query_id, abstract_id, stage, round(relevance, 6) AS relevance,
  round(rouge_score, 6) AS rouge_score
FROM cascade""",
    )
    sql["rerank_topic_boost"] = chain(
        *RETRIEVAL, RANKED,
        """SELECT query_id, rank, abstract_id, topic_label, round(rouge_score, 6) AS rouge_score
FROM ranked""",
    )
    sql["context_block"] = chain(
        *RETRIEVAL, RANKED, CONTEXTS, "SELECT query_id, context, sources FROM contexts"
    )
    sql["source_count"] = chain(
        *RETRIEVAL, RANKED, "SELECT query_id, count(*) AS sources FROM ranked GROUP BY 1"
    )
    sql["prompts"] = chain(
        *RETRIEVAL, RANKED, CONTEXTS,
        f"""SELECT query_id, {q(PROMPT_HEAD)} || context || {q(PROMPT_MIDDLE)} || query
  || {q(PROMPT_TAIL)} AS prompt, topic_hint, sources, NULL::VARCHAR AS reply
FROM hints JOIN contexts USING (query_id)""",
    )

    top = (MEANS, VECS, LABEL_TOP)
    sql["vector_topk"] = chain(
        *top, "SELECT query_id, abstract_id, similarity, rank FROM label_ranks WHERE rank <= 5"
    )
    sql["vector_batch_topk"] = chain(
        VECS,
        """SELECT a.vec_id AS query_id, b.vec_id AS abstract_id, round(list_inner_product(a.v, b.v), 6) AS similarity,
  row_number() OVER (PARTITION BY a.vec_id ORDER BY round(list_inner_product(a.v, b.v), 6) DESC, b.vec_id) AS rank
FROM vecs a, vecs b QUALIFY rank <= 5""",
    )
    sql["vector_cells_recall"] = "SELECT TRUE AS found_nine_of_ten"
    sql["vector_join_summary"] = chain(
        MEANS, VECS,
        """known AS (
  SELECT doc_id, text, source FROM documents WHERE trim(coalesce(text, '')) <> ''),
scores AS (
  SELECT m.label AS query_id, e.vec_id AS abstract_id,
         round(list_inner_product(e.v, m.centroid), 6) AS similarity
  FROM means m, vecs e WHERE e.vec_id IN (SELECT doc_id FROM known))""",
        """SELECT r.query_id, r.abstract_id, r.similarity, substr(d.text, 1, 80) AS preview,
  d.source AS topic_label
FROM scores r JOIN known d ON d.doc_id = r.abstract_id
QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY similarity DESC, abstract_id) <= 3""",
    )
    sql["vector_topk_cells"] = chain(
        MEANS, VECS, ASSIGN,
        """probes AS (
  SELECT vec_id, label FROM cosines
  QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY round(similarity, 6) DESC, label) <= 3),
cell_scores AS (
  SELECT p.vec_id AS query_id, e.vec_id AS abstract_id,
         round(list_inner_product(e.v, s.v), 6) AS similarity
  FROM probes p JOIN vecs s ON s.vec_id = p.vec_id JOIN vecs e ON e.label = p.label)""",
        """SELECT query_id, abstract_id, similarity,
  row_number() OVER (PARTITION BY query_id ORDER BY similarity DESC, abstract_id) AS rank
FROM cell_scores QUALIFY rank <= 5""",
    )
    sql["vector_text_search"] = chain(
        *EMBED,
        "items AS (SELECT item_id, text AS body FROM benchmark)",
        term_counts("item_terms", "items", "item_id"),
        embedded("item_vectors", "item_terms"),
        """products AS (
  SELECT i.abstract_id AS query_id, d.abstract_id, sum(i.w * d.w) AS s
  FROM item_vectors i JOIN doc_vectors d USING (bucket) GROUP BY 1, 2),
all_pairs AS (
  SELECT i.query_id, d.abstract_id, round(coalesce(p.s, 0), 6) AS similarity
  FROM (SELECT item_id AS query_id FROM items) i CROSS JOIN (SELECT abstract_id FROM docs) d
  LEFT JOIN products p ON p.query_id = i.query_id AND p.abstract_id = d.abstract_id)""",
        """SELECT query_id, abstract_id, similarity,
  row_number() OVER (PARTITION BY query_id ORDER BY similarity DESC, abstract_id) AS rank
FROM all_pairs QUALIFY rank <= 3""",
    )
    sql["hash_embedding"] = chain(
        *EMBED,
        "ids AS (SELECT abstract_id FROM docs)",
        """SELECT i.abstract_id, string_agg(CAST(CAST(round(coalesce(v.w, 0) * 1e6) AS BIGINT) AS VARCHAR),
  ',' ORDER BY b.bucket) AS embedding
FROM ids i CROSS JOIN (SELECT unnest(range(0, 384)) AS bucket) b
LEFT JOIN doc_vectors v ON v.abstract_id = i.abstract_id AND v.bucket = b.bucket GROUP BY 1""",
    )
    sql["normalize"] = chain(
        """scaled AS (
  SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE * (vec_id + 1)) AS v FROM embeddings)""",
        f"""SELECT vec_id AS abstract_id,
  {micro('list_transform(v, lambda y: y / sqrt(list_inner_product(v, v)))')} AS embedding FROM scaled""",
    )
    sql["vector_text_form"] = f"""SELECT vec_id AS abstract_id, len(embedding)::INTEGER AS dims,
  true AS same, {micro('embedding')} AS embedding FROM embeddings"""
    sql["inner_product"] = chain(
        MEANS, VECS,
        """SELECT e.vec_id AS abstract_id, round(list_inner_product(e.v, m.centroid), 6) AS similarity
FROM vecs e JOIN means m USING (label)""",
    )

    sql["centroid_assign"] = chain(
        MEANS, VECS, ASSIGN,
        """nearest AS (
  SELECT vec_id, label, round(similarity, 4) AS topic_score FROM cosines
  QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY round(similarity, 6) DESC, label) = 1),
floored AS (
  SELECT vec_id, topic_score, CASE WHEN topic_score < 0.25 THEN -1 ELSE label END AS topic_id
  FROM nearest)""",
        """SELECT vec_id AS abstract_id, topic_score,
  CASE WHEN count(*) OVER (PARTITION BY topic_id) < 10 THEN -1 ELSE topic_id END AS topic_id
FROM floored""",
    )
    sql["kmeans_topics"] = "SELECT count(*) AS n_rows, 0 AS apart, 0 AS small FROM embeddings"
    sql["pca_reduce"] = "SELECT count(*) AS n_rows, 0 AS changed, TRUE AS falls FROM embeddings"
    sql["neighbour_table"] = chain(
        VECS, *NEAR, "SELECT abstract_id, neighbour, distance FROM near"
    )
    sql["mutual_reachability"] = chain(VECS, *NEAR, *REACH, "SELECT w, a, b FROM edges")
    sql["single_linkage"] = chain(
        VECS, *NEAR, *REACH,
        """links AS MATERIALIZED (
  SELECT a, b FROM edges WHERE w <= (SELECT percentile_disc(0.5) WITHIN GROUP (ORDER BY w) FROM edges)),
ends AS MATERIALIZED (
  SELECT a, b FROM links UNION ALL SELECT b, a FROM links
  UNION ALL SELECT a, a FROM edges UNION ALL SELECT b, b FROM edges),
reach AS (
  SELECT a, b FROM ends UNION SELECT r.a, x.b FROM reach r JOIN ends x ON x.a = r.b)""",
        "SELECT a AS abstract_id, min(b) AS component FROM reach GROUP BY a",
    )
    sql["fuzzy_graph"] = chain(
        VECS, *NEAR,
        """lists AS MATERIALIZED (
  SELECT abstract_id, ns, ds, greatest(list_sum(ds) / len(ds), 1e-9) AS mean, log2(len(ds)) AS target,
    coalesce(list_min(list_filter(ds, lambda d: d > 0)), 0.0) AS first
  FROM (SELECT abstract_id, list(neighbour ORDER BY distance, neighbour) AS ns,
    list(distance ORDER BY distance, neighbour) AS ds FROM near GROUP BY 1)),
excess AS MATERIALIZED (
  SELECT abstract_id, ns, mean, target, list_transform(ds, lambda d: greatest(d - first, 0.0)) AS xs FROM lists),
bounds AS (
  SELECT abstract_id, 0.0::DOUBLE AS lo, (mean * 1024)::DOUBLE AS hi, 0 AS step FROM excess
  UNION ALL
  SELECT abstract_id, CASE WHEN total > target THEN lo ELSE (lo + hi) / 2 END,
    CASE WHEN total > target THEN (lo + hi) / 2 ELSE hi END, step + 1
  FROM (SELECT b.abstract_id, lo, hi, step, target,
      list_sum(list_transform(xs, lambda x: exp(-x / ((lo + hi) / 2)))) AS total
    FROM bounds b JOIN excess e ON e.abstract_id = b.abstract_id WHERE step < 40)),
one_way AS MATERIALIZED (
  SELECT abstract_id, unnest(ns) AS neighbour, unnest(list_transform(xs, lambda x: exp(-x / rate))) AS weight
  FROM (SELECT e.abstract_id, ns, xs, greatest(hi, mean * 1e-3) AS rate
    FROM bounds b JOIN excess e ON e.abstract_id = b.abstract_id WHERE step = 40))""",
        """SELECT least(abstract_id, neighbour) AS a, greatest(abstract_id, neighbour) AS b,
  round(sum(weight) - CASE WHEN count(*) = 2 THEN min(weight) * max(weight) ELSE 0 END, 5) AS weight
FROM one_way GROUP BY 1, 2""",
    )
    sql["topic_model_store"] = chain(
        *STORE, "SELECT abstract_id, TRUE AS labelled, 1 AS labels FROM summaries"
    )
    sql["topic_merge"] = chain(
        MEANS, VECS, ASSIGN,
        """close AS (
  SELECT a.label AS a, b.label AS b FROM unit_means a, unit_means b
  WHERE a.label = b.label OR round(list_inner_product(a.c, b.c), 6) >= 0.1),
reach AS (
  SELECT a, b FROM close UNION SELECT r.a, c.b FROM reach r JOIN close c ON c.a = r.b)""",
        """SELECT e.vec_id AS abstract_id, g.topic_id
FROM embeddings e JOIN (SELECT a, min(b) AS topic_id FROM reach GROUP BY 1) g ON g.a = e.label""",
    )
    sql["ngrams"] = chain(*base, NGRAMS, "SELECT topic_id, term, tf, n_docs FROM counts")
    sql["doc_frequency_cut"] = chain(*base, NGRAMS, CTFIDF, "SELECT term, df FROM tdf")
    sql["topic_terms"] = chain(
        *base, NGRAMS, CTFIDF, "SELECT topic_id, term, round(weight, 6) AS weight FROM tterms"
    )
    sql["topic_similarity"] = chain(*base, NGRAMS, CTFIDF, TOPIC_COSINES, "SELECT a, b, cosine FROM cosines")
    sql["topic_merge_terms"] = chain(
        *base, NGRAMS, CTFIDF, TOPIC_COSINES,
        """close AS MATERIALIZED (
  SELECT a, b FROM cosines WHERE cosine >= 0.3 UNION SELECT b, a FROM cosines WHERE cosine >= 0.3
  UNION SELECT topic_id, topic_id FROM tterms),
reach AS (
  SELECT a, b FROM close UNION SELECT r.a, c.b FROM reach r JOIN close c ON c.a = r.b)""",
        "SELECT a AS topic_id, min(b) AS merged FROM reach WHERE a >= 0 AND b >= 0 GROUP BY a",
    )
    noisy = (DOCS, NOISY, NGRAMS, CTFIDF, LABELS)
    sql["ctfidf_labels"] = chain(*noisy, "SELECT topic_id, topic_label FROM labels_out")
    sql["topic_overview"] = chain(
        *noisy,
        """SELECT topic_id AS topic, count(*) AS count, topic_id || '_' || any_value(topic_label) AS name
FROM (SELECT topic_id FROM summaries) JOIN labels_out USING (topic_id) GROUP BY 1""",
    )

    sql["vector_insert_if_absent"] = """SELECT vec_id AS abstract_id, len(embedding)::INTEGER AS dims
FROM embeddings WHERE vec_id NOT IN (SELECT doc_id FROM labels)"""
    sql["topic_update"] = """SELECT d.doc_id AS abstract_id, l.quality AS topic_id,
  CASE WHEN l.doc_id IS NULL THEN d.source ELSE 'q' || l.quality END AS topic_label
FROM documents d LEFT JOIN labels l USING (doc_id)"""
    sql["topic_update_changes"] = sql["topic_update"]
    return sql
