"""SQL with the same meaning as the registered queries, for checking them in DuckDB."""

from __future__ import annotations

from folioscope.operators.bm25 import B, K1
from folioscope.plans.queries import INDEX_KEYWORDS, KEYWORDS, QUESTION

# The separators of functions.text, as the SQL engine's regular expressions write them.
SPACES = (
    r"\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
)
WORD = f"[^{SPACES}]+"


def _words(text: str) -> str:
    return f"regexp_extract_all({text}, '{WORD}')"


def _strip(text: str) -> str:
    return rf"regexp_replace({text}, '^[{SPACES}]+|[{SPACES}]+\z', '', 'g')"


def _iso(value: str) -> str:
    return f"strftime({value}, '%Y-%m-%dT%H:%M:%S')"


PAGES = f"""p AS (
  SELECT source AS source_file, page_number, (page_number - 1) // 20 AS chunk_id, doc_id AS document_id,
         text, len({_words('text')}) AS word_count, length(text) AS char_count,
         TIMESTAMP '2024-01-01 00:00:00' + to_seconds(doc_id) AS created_at
  FROM (SELECT source, doc_id, coalesce(text, '') AS text,
               row_number() OVER (PARTITION BY source ORDER BY doc_id) AS page_number
        FROM documents)
)"""

CHUNKS = """c AS (
  SELECT source_file, chunk_id, min(page_number) AS start_page, max(page_number) AS end_page,
         count(*) AS page_count, sum(word_count)::BIGINT AS word_count,
         (sum(char_count) + count(*) - 1)::BIGINT AS char_count,
         string_agg(text, chr(10) ORDER BY page_number) AS text
  FROM p GROUP BY source_file, chunk_id
)"""

MANIFEST = """m AS (
  SELECT source_file, i AS chunk_id, printf('chunk_%04d', i) AS path, i * 20 + 1 AS start_page,
         least((i + 1) * 20, total_pages) AS end_page,
         least((i + 1) * 20, total_pages) - i * 20 AS page_count
  FROM (SELECT source_file, total_pages, unnest(range((total_pages + 19) // 20)) AS i
        FROM (SELECT source AS source_file, count(*) AS total_pages FROM documents GROUP BY source))
)"""

BOOKS = """b AS (
  SELECT source_file, count(*) AS num_chunks, sum(page_count)::BIGINT AS total_pages,
         sum(word_count)::BIGINT AS total_word_count
  FROM c GROUP BY source_file
)"""


# Pages left when odd ones replace sources, and others are deleted.
COUNTED = """k AS (
  SELECT * FROM p
  WHERE NOT (source_file LIKE 'src1_' AND page_number % 2 = 0) AND NOT (source_file = 'src3' OR page_number % 4 = 2)
)"""


def _with(*parts: str) -> str:
    return "WITH " + ",\n".join(parts) + "\n"


def _embedded(name: str, rows: str, key: str) -> str:
    """CTEs ``<name>``: the non-zero elements of the hashed word vectors of ``rows``
    (a relation with ``key`` and ``text``) and ``<name>_norm``."""
    return f"""{name}_count AS (
  SELECT {key}, ('0x' || substr(md5(word), 1, 4))::INTEGER % 384 AS bucket, count(*) AS n
  FROM (SELECT {key}, unnest({_words('lower(text)')}) AS word FROM {rows})
  GROUP BY {key}, bucket
), {name} AS (
  SELECT {key}, bucket,
         CAST(CAST(n / sqrt(sum(n * n) OVER (PARTITION BY {key})) AS FLOAT) AS DOUBLE) AS weight
  FROM {name}_count
), {name}_norm AS (
  SELECT {key}, sqrt(sum(weight * weight)) AS length FROM {name} GROUP BY {key}
)"""


def _hits(k: int, threshold: float | None = None) -> str:
    """CTE ``hits`` of queries ``q`` over pages ``d`` (both from :func:`_embedded`). Every
    page takes part, also one without a common word."""
    kept = f"WHERE exact >= {threshold}" if threshold is not None else ""
    return f"""shared AS (
  SELECT query_id, document_id, sum(q.weight * d.weight) AS product
  FROM q JOIN d USING (bucket) GROUP BY query_id, document_id
), scored AS (
  SELECT n.query_id, p.source_file, p.page_number, p.text,
         coalesce(s.product, 0) / (n.length * o.length) AS exact
  FROM q_norm n CROSS JOIN p JOIN d_norm o USING (document_id)
  LEFT JOIN shared s ON s.query_id = n.query_id AND s.document_id = p.document_id
), hits AS (
  SELECT *, row_number() OVER (
    PARTITION BY query_id ORDER BY similarity DESC NULLS LAST, source_file, page_number) AS rank
  FROM (SELECT *, round(exact, 6) AS similarity FROM scored {kept})
  QUALIFY rank <= {k}
)"""


QUESTIONS = _embedded("q", "(SELECT item_id AS query_id, text FROM benchmark)", "query_id")
EMBEDDED_PAGES = _embedded("d", "p", "document_id")

FORMS = f"""w AS (SELECT item_id, {_words('text')} AS w FROM benchmark),
f AS (
  SELECT item_id, item_id * 3 AS query_id, array_to_string(w, ' ') AS text FROM w
  UNION ALL SELECT item_id, item_id * 3 + 1, array_to_string(w[1:len(w) // 2], ' ') FROM w
  UNION ALL SELECT item_id, item_id * 3 + 2, array_to_string(w[len(w) // 2 + 1:], ' ') FROM w
)"""


def _cosine(a: str, b: str) -> str:
    return f"list_cosine_similarity({a}::DOUBLE[], {b}::DOUBLE[])"


PAGES_WITH_VECTORS = f"""pe AS (
  SELECT p.*, {_cosine('e.embedding', 'q.embedding')} AS exact
  FROM p CROSS JOIN (SELECT embedding FROM embeddings WHERE vec_id = 0) q
  LEFT JOIN embeddings e ON e.vec_id = p.document_id
)"""

HTML = "coalesce(html, '')"
for _pattern in (r"(?is)<script\b.*?</script\s*>", r"(?is)<style\b.*?</style\s*>", r"(?s)<!--.*?-->", r"(?s)<[^>]*>"):
    HTML = f"regexp_replace({HTML}, '{_pattern}', ' ', 'g')"
for _entity, _character in (
    ("&nbsp;", " "),
    ("&lt;", "<"),
    ("&gt;", ">"),
    ("&quot;", '"'),
    ("&#39;", "''"),
    ("&copy;", "©"),
    ("&middot;", "·"),
    ("&amp;", "&"),
):
    HTML = f"replace({HTML}, '{_entity}', '{_character}')"
HTML = _strip(f"regexp_replace({HTML}, '[{SPACES}]+', ' ', 'g')")

_ANY = " OR ".join(f"text ILIKE '%{keyword}%'" for keyword in KEYWORDS[1:])
_DIGEST = "md5(text) AS text_md5, length(text) AS text_chars"


def _snippet(text: str, limit: int) -> str:
    return f"substr({text}, 1, {limit}) || '...'"


_ANY_INDEXED = " OR ".join(f"text ILIKE '%{keyword}%'" for keyword in INDEX_KEYWORDS[1:6])

#: CTE ``bm``: the score of every page that has a word of the question.
BM25 = f"""pw AS (
  SELECT source_file, page_number, word, count(*) AS times, any_value(word_count) AS length
  FROM (SELECT source_file, page_number, word_count, unnest({_words('lower(text)')}) AS word FROM p)
  GROUP BY source_file, page_number, word
), qw AS (
  SELECT word, count(*) AS asked FROM (SELECT unnest({_words(f"lower('{QUESTION}')")}) AS word) GROUP BY word
), every AS (SELECT count(*) AS pages, avg(word_count) AS mean FROM p
), df AS (SELECT word, count(*) AS held FROM pw GROUP BY word
), bm AS (
  SELECT source_file, page_number,
         round(sum(asked * ln(1 + (pages - held + 0.5::DOUBLE) / (held + 0.5::DOUBLE))
                   * times * ({K1}::DOUBLE + 1) / (times + {K1}::DOUBLE * (1 - {B}::DOUBLE + {B}::DOUBLE * length / mean))), 6) AS score
  FROM pw JOIN qw USING (word) JOIN df USING (word) CROSS JOIN every
  GROUP BY source_file, page_number
)"""

_FLAT = "replace(" + _strip("text") + ", chr(10), ' ')"

ORACLES: dict[str, str] = {
    "page_table": _with(PAGES)
    + f"""SELECT source_file, page_number, chunk_id, document_id, word_count, char_count,
       md5(text) AS text_md5, {_iso('created_at')} AS created_at FROM p""",
    "page_metrics": _with(PAGES) + "SELECT source_file, page_number, word_count, char_count FROM p",
    "html_page_text": f"""SELECT page_id, {_DIGEST}, len({_words('text')}) AS word_count
FROM (SELECT page_id, {HTML} AS text FROM pages)""",
    "text_truncate": f"""SELECT document_id, {_DIGEST}
FROM (SELECT doc_id AS document_id, substr(coalesce(text, ''), 1, 5000) AS text FROM documents)""",
    "search_snippets": f"""SELECT doc_id AS document_id, {_snippet(_FLAT, 200)} AS flat_200,
       {_snippet('text', 200)} AS raw_200, {_snippet('text', 150)} AS raw_150,
       {_snippet('text', 100)} AS raw_100
FROM (SELECT doc_id, coalesce(text, '') AS text FROM documents)""",
    "chunk_assign": _with(PAGES) + "SELECT source_file, page_number, chunk_id FROM p",
    "chunk_by_words": _with(PAGES)
    + """SELECT source_file, page_number, words_before, words_before // 2000 AS chunk_id
FROM (SELECT source_file, page_number, coalesce(sum(word_count) OVER (
        PARTITION BY source_file ORDER BY page_number
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS words_before FROM p)""",
    "chunk_greedily": "WITH RECURSIVE "
    + PAGES
    + """, w AS MATERIALIZED (SELECT source_file, page_number, word_count FROM p),
g AS (
  SELECT source_file, page_number, word_count AS used, 0::BIGINT AS chunk_id FROM w WHERE page_number = 1
  UNION ALL
  SELECT w.source_file, w.page_number, CASE WHEN used + word_count > 2000 THEN word_count ELSE used + word_count END,
         CASE WHEN used + word_count > 2000 THEN chunk_id + 1 ELSE chunk_id END
  FROM g JOIN w ON w.source_file = g.source_file AND w.page_number = g.page_number + 1
)
SELECT source_file, page_number, chunk_id,
       coalesce(sum(word_count) OVER (PARTITION BY source_file ORDER BY page_number
                                      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS words_before
FROM g JOIN w USING (source_file, page_number)""",
    "page_text_files": _with(PAGES)
    + """SELECT row_number() OVER (ORDER BY document_id) AS place, word_count, char_count, md5(text) AS text_md5 FROM p""",
    "chunk_manifest": _with(MANIFEST) + "SELECT * FROM m",
    "manifest_from_counts": _with(MANIFEST) + "SELECT * FROM m",
    "manifest_header": """SELECT source AS source_file, count(*) AS total_pages, 20::BIGINT AS chunk_size,
       (count(*) + 19) // 20 AS num_chunks FROM documents GROUP BY source""",
    "manifest_join_pages": _with(PAGES, MANIFEST)
    + """SELECT source_file, m.chunk_id, start_page, end_page, page_number, word_count, char_count
FROM m JOIN p USING (source_file) WHERE page_number BETWEEN start_page AND end_page""",
    "chunk_metrics": _with(PAGES, CHUNKS) + "SELECT * EXCLUDE (text) FROM c",
    "document_chunks": _with(PAGES, CHUNKS)
    + "SELECT source_file, chunk_id, start_page, end_page, word_count, char_count FROM c",
    "chunk_status": _with(MANIFEST)
    + """SELECT source_file, chunk_id,
       CASE WHEN chunk_id % 7 <> 3 THEN 'results/source_file=' || source_file END AS result_path,
       CASE WHEN chunk_id % 7 <> 3 THEN 'done' ELSE 'missing' END AS status FROM m""",
    "chunk_full_text": _with(PAGES, CHUNKS)
    + f"SELECT source_file, chunk_id, word_count, char_count, {_DIGEST} FROM c",
    "chunk_pages_nested": _with(PAGES)
    + "SELECT source_file, chunk_id, page_number, word_count, char_count, md5(text) AS text_md5 FROM p",
    "book_totals": _with(PAGES, CHUNKS, BOOKS) + "SELECT * FROM b",
    "book_totals_from_manifest": _with(PAGES, CHUNKS)
    + """SELECT source_file, count(*) AS num_chunks, sum(page_count)::BIGINT AS total_pages,
       coalesce(sum(word_count) FILTER (chunk_id % 7 <> 3), 0)::BIGINT AS total_word_count
FROM c GROUP BY source_file""",
    "book_nested": _with(PAGES, CHUNKS, BOOKS)
    + """SELECT source_file, chunk_id // 8 AS part, (num_chunks + 7) // 8 AS num_parts, num_chunks,
       total_pages, total_word_count, chunk_id % 8 AS position, chunk_id, start_page, end_page,
       word_count, md5(text) AS text_md5
FROM c JOIN b USING (source_file)""",
    "chunk_report": _with(PAGES, CHUNKS)
    + """SELECT source_file, chunk_id, start_page, end_page, word_count, char_count,
       printf('Chunk %02d: Pages %3d-%3d | ', chunk_id, start_page, end_page)
       || lpad(format('{:,}', word_count), 6, ' ') || ' words | '
       || lpad(format('{:,}', char_count), 7, ' ') || ' chars' AS line
FROM c""",
    "chunk_json_roundtrip": _with(PAGES, CHUNKS)
    + """SELECT source_file, printf('chunk_%04d', chunk_id) AS chunk_path, chunk_id, start_page, end_page,
       page_count, word_count, char_count, md5(text) AS text_md5 FROM c""",
    "store_page_embeddings": _with(PAGES, EMBEDDED_PAGES)
    + """SELECT document_id, page_number, chunk_id, word_count, char_count,
       md5(text) AS text_md5, length(text) AS text_chars,
       coalesce(used, 0) AS used_buckets, coalesce(largest, 0) AS largest_weight
FROM p LEFT JOIN (SELECT document_id, count(*) AS used, round(max(weight), 6) AS largest
                  FROM d GROUP BY document_id) USING (document_id)""",
    "store_chunk_embeddings": _with(
        PAGES,
        CHUNKS,
        "ct AS (SELECT *, source_file || '/' || chunk_id AS chunk_key FROM c)",
        _embedded("d", "ct", "chunk_key"),
    )
    + """SELECT source_file, chunk_id, start_page AS page_number, word_count, char_count,
       md5(text) AS text_md5, length(text) AS text_chars,
       coalesce(used, 0) AS used_buckets, coalesce(largest, 0) AS largest_weight
FROM ct LEFT JOIN (SELECT chunk_key, count(*) AS used, round(max(weight), 6) AS largest
                   FROM d GROUP BY chunk_key) USING (chunk_key)""",
    "delete_sources": _with(PAGES)
    + "SELECT source_file, page_number, word_count FROM p WHERE source_file NOT LIKE 'src1_'",
    "first_page_of_source": _with(PAGES)
    + f"""SELECT source_file, page_number, word_count, {_DIGEST}
FROM p WHERE source_file = 'src7' ORDER BY page_number LIMIT 1""",
    "pages_with_document": _with(PAGES, CHUNKS)
    + """SELECT source_file, p.chunk_id, page_number, start_page, end_page, p.word_count,
       c.word_count AS chunk_word_count
FROM p JOIN c USING (source_file, chunk_id)""",
    "list_documents": "SELECT source AS source_file, count(*) AS pages FROM documents GROUP BY source",
    "table_stats": _with(PAGES)
    + """SELECT count(*) AS total_pages, count(DISTINCT source_file) AS unique_documents,
       coalesce(sum(word_count), 0)::BIGINT AS total_words FROM p""",
    "document_summary": _with(PAGES)
    + """SELECT source_file AS document_id, count(*) AS total_pages, sum(word_count)::BIGINT AS total_words,
       sum(char_count)::BIGINT AS total_chars
FROM p WHERE source_file = 'src3' GROUP BY source_file""",
    "recent_pages": _with(PAGES)
    + f"""SELECT source_file, page_number, chunk_id, word_count, {_iso('created_at')} AS created_at,
       row_number() OVER (ORDER BY created_at DESC, source_file, page_number) AS rank
FROM p QUALIFY rank <= 10""",
    "keyword_any": _with(PAGES)
    + f"""SELECT source_file, page_number, {_snippet('text', 100)} AS snippet
FROM p WHERE {_ANY} ORDER BY source_file, page_number LIMIT 10""",
    "keyword_each": _with(PAGES)
    + f"""SELECT keyword, source_file, page_number, {_snippet('text', 200)} AS snippet,
       row_number() OVER (PARTITION BY keyword ORDER BY source_file, page_number) AS rank
FROM p JOIN (SELECT unnest({KEYWORDS}) AS keyword) k ON text ILIKE '%' || keyword || '%'
QUALIFY rank <= 10""",
    "keyword_index_any": _with(PAGES)
    + f"""SELECT source_file, page_number, {_snippet('text', 100)} AS snippet
FROM p WHERE {_ANY_INDEXED} ORDER BY source_file, page_number LIMIT 25""",
    "keyword_index_each": _with(PAGES)
    + f"""SELECT keyword, source_file, page_number, {_snippet('text', 200)} AS snippet,
       row_number() OVER (PARTITION BY keyword ORDER BY source_file, page_number) AS rank
FROM p JOIN (SELECT unnest({INDEX_KEYWORDS}) AS keyword) k ON text ILIKE '%' || keyword || '%'
QUALIFY rank <= 10""",
    "word_scores": _with(PAGES, BM25) + "SELECT * FROM bm",
    "word_search": _with(PAGES, BM25)
    + """SELECT *, row_number() OVER (ORDER BY score DESC, source_file, page_number) AS rank FROM bm
QUALIFY rank <= 50""",
    "word_search_in_source": _with(PAGES, BM25)
    + """SELECT *, row_number() OVER (ORDER BY score DESC, page_number) AS rank FROM bm
WHERE source_file = 'src5' QUALIFY rank <= 10""",
    "embed_hash": _with(_embedded("d", "(SELECT doc_id, coalesce(text, '') AS text FROM documents)", "doc_id"))
    + "SELECT doc_id, bucket::BIGINT AS bucket, round(weight, 6) AS weight FROM d",
    "vector_normalize": """SELECT vec_id, position,
       round(CAST(CAST(v[position + 1] / CASE WHEN length > 0 THEN length ELSE 1 END AS FLOAT) AS DOUBLE), 6) AS x
FROM (SELECT vec_id, v, sqrt(list_sum(list_transform(v, lambda y: y * y))) AS length,
             unnest(range(len(v))) AS position
      FROM (SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings))""",
    "vector_dim_check": """SELECT len(embedding) AS dimension, count(*) AS vectors,
       count(*) FILTER (len(embedding) <> 64) AS wrong_dimension,
       count(*) FILTER (len(list_filter(embedding, lambda x: NOT isfinite(x))) > 0) AS not_finite,
       count(*) FILTER (len(list_filter(embedding, lambda x: x <> 0)) = 0) AS zero
FROM embeddings GROUP BY len(embedding)""",
    "cosine_pairs": f"""SELECT vec_id, round(near, 6) AS sim_second, round(far, 6) AS sim_third,
       near > far AS second_is_closer
FROM (SELECT a.vec_id, {_cosine('a.embedding', 'b.embedding')} AS near,
             {_cosine('a.embedding', 'c.embedding')} AS far
      FROM embeddings a JOIN embeddings b ON b.vec_id = a.vec_id + 1
      JOIN embeddings c ON c.vec_id = a.vec_id + 2)""",
    "semantic_topk": f"""SELECT row_number() OVER (ORDER BY similarity DESC NULLS LAST, vec_id) AS rank,
       vec_id, label::BIGINT AS label, similarity
FROM (SELECT vec_id, label, round({_cosine('embedding', 'q')}, 6) AS similarity
      FROM embeddings, (SELECT embedding AS q FROM embeddings WHERE vec_id = 0))
QUALIFY rank <= 5""",
    "topk_in_source": _with(PAGES, PAGES_WITH_VECTORS)
    + """SELECT source_file, page_number, chunk_id, word_count, round(exact, 6) AS similarity,
       row_number() OVER (ORDER BY round(exact, 6) DESC NULLS LAST, source_file, page_number) AS rank
FROM pe WHERE source_file = 'src5' QUALIFY rank <= 10""",
    "semantic_threshold": _with(PAGES, PAGES_WITH_VECTORS)
    + f"""SELECT source_file, page_number, chunk_id, word_count, round(exact, 6) AS similarity,
       md5(text) AS text_md5, {_iso('created_at')} AS created_at,
       row_number() OVER (ORDER BY round(exact, 6) DESC NULLS LAST, source_file, page_number) AS rank
FROM pe WHERE exact >= 0.2 QUALIFY rank <= 20""",
    "semantic_batch_topk": _with(PAGES, QUESTIONS, EMBEDDED_PAGES, _hits(5))
    + "SELECT query_id, source_file, page_number, rank, similarity FROM hits",
    "batch_topk_in_source": _with(PAGES, QUESTIONS, EMBEDDED_PAGES)
    + """, shared AS (
  SELECT query_id, document_id, sum(q.weight * d.weight) AS product
  FROM q JOIN d USING (bucket) GROUP BY query_id, document_id
), scored AS (
  SELECT n.query_id, p.source_file, p.page_number,
         round(coalesce(s.product, 0) / (n.length * o.length), 6) AS similarity
  FROM q_norm n CROSS JOIN p JOIN d_norm o USING (document_id)
  LEFT JOIN shared s ON s.query_id = n.query_id AND s.document_id = p.document_id
  WHERE n.query_id % 5 = 0 OR p.source_file = 'src' || (n.query_id % 21)
)
SELECT query_id, source_file, page_number, similarity, row_number() OVER (
    PARTITION BY query_id ORDER BY similarity DESC NULLS LAST, source_file, page_number) AS rank
FROM scored QUALIFY rank <= 3""",
    "compare_results": _with(PAGES, QUESTIONS, EMBEDDED_PAGES, _hits(5, 0.5))
    + """SELECT item_id AS query_id, count(rank) AS num_results,
       coalesce(round(avg(coalesce(similarity, 0)) FILTER (rank IS NOT NULL), 6), 0) AS avg_similarity,
       arg_min(source_file, rank) AS top_source_file, arg_min(page_number, rank) AS top_page_number,
       arg_min(similarity, rank) AS top_similarity
FROM benchmark LEFT JOIN hits ON query_id = item_id GROUP BY item_id""",
    "rag_context": _with(PAGES, QUESTIONS, EMBEDDED_PAGES, _hits(3))
    + """SELECT query_id, num_results, md5(prompt) AS text_md5, length(prompt) AS text_chars
FROM (SELECT query_id, num_results,
             'Context: ' || context || chr(10) || 'Question: ' || text || chr(10) || 'Answer:' AS prompt
      FROM (SELECT query_id, count(*) AS num_results, string_agg(text, chr(10) ORDER BY rank) AS context
            FROM hits GROUP BY query_id) JOIN benchmark ON item_id = query_id)""",
    "precision_at_k": f"""WITH x AS (
  SELECT label, unnest(range(len(embedding))) AS pos, unnest(embedding::DOUBLE[]) AS v FROM embeddings
), m AS (SELECT label, pos, avg(v) AS v FROM x GROUP BY label, pos),
q AS (SELECT label AS query_id, list(v ORDER BY pos) AS embedding FROM m GROUP BY label),
hits AS (
  SELECT query_id, label,
         row_number() OVER (PARTITION BY query_id ORDER BY round({_cosine('e.embedding', 'q.embedding')}, 6)
                            DESC NULLS LAST, vec_id) AS rank
  FROM embeddings e CROSS JOIN q QUALIFY rank <= 3
)
SELECT query_id::BIGINT AS query_id, query_id::BIGINT AS expected_label, count(*) AS num_results,
       round(avg((label = query_id)::INTEGER), 6) AS precision,
       bool_or(rank = 1 AND label = query_id) AS top_hit_right
FROM hits GROUP BY query_id""",
    "query_agreement": _with(PAGES, FORMS, _embedded("q", "f", "query_id"), EMBEDDED_PAGES, _hits(1))
    + """SELECT item_id, count(*) AS num_queries, count(DISTINCT (source_file, page_number)) AS top_rows,
       count(DISTINCT (source_file, page_number)) = 1 AS agree
FROM hits JOIN f USING (query_id) GROUP BY item_id""",
    "similar_pages": f"""SELECT query_id, vec_id, similarity,
       row_number() OVER (PARTITION BY query_id ORDER BY similarity DESC NULLS LAST, vec_id) AS rank
FROM (SELECT a.vec_id AS query_id, b.vec_id, round({_cosine('a.embedding', 'b.embedding')}, 6) AS similarity
      FROM embeddings a JOIN embeddings b ON a.vec_id <> b.vec_id)
QUALIFY rank <= 3""",
    "hybrid_search": _with(
        PAGES,
        _embedded("q", f"(SELECT 0 AS query_id, '{QUESTION}' AS text)", "query_id"),
        EMBEDDED_PAGES,
        _hits(1_000_000_000),
        BM25,
    )
    + """, worded AS (
  SELECT source_file, page_number, row_number() OVER (ORDER BY score DESC, source_file, page_number) AS rank FROM bm
), fused AS (
  SELECT source_file, page_number,
         round(coalesce(1.0::DOUBLE / (60 + h.rank), 0) + coalesce(1.0::DOUBLE / (60 + w.rank), 0), 9) AS score
  FROM hits h FULL JOIN worded w USING (source_file, page_number)
)
SELECT *, row_number() OVER (ORDER BY score DESC, source_file, page_number) AS rank
FROM fused QUALIFY rank <= 10""",
    "incremental_ingest": _with(
        "a AS (SELECT source, doc_id, coalesce(text, '') AS text FROM documents)", _embedded("d", "a", "doc_id")
    )
    + f"""SELECT source AS source_file, doc_id + 1 AS page_number, doc_id // 20 AS chunk_id,
       len({_words('text')}) AS word_count, length(text) AS char_count, md5(text) AS text_md5,
       coalesce(used, 0) AS used_buckets, coalesce(largest, 0) AS largest_weight
FROM a LEFT JOIN (SELECT doc_id, count(*) AS used, round(max(weight), 6) AS largest FROM d GROUP BY doc_id)
     USING (doc_id)""",
    "book_merge_stream": _with(PAGES, CHUNKS, BOOKS)
    + "SELECT * FROM b WHERE source_file NOT LIKE '%3' OR num_chunks = 1",
    "topic_words": f"""WITH n AS (
  SELECT lang AS topic, word, count(*) AS n
  FROM (SELECT lang, unnest({_words("lower(coalesce(text, ''))")}) AS word FROM documents) GROUP BY lang, word
), s AS (SELECT topic, sum(n) AS size FROM n GROUP BY topic), w AS (SELECT word, sum(n) AS every FROM n GROUP BY word)
, x AS (
  SELECT topic, word, round(n.n::DOUBLE / size * ln(1 + mean / every), 9) AS weight
  FROM n JOIN s USING (topic) JOIN w USING (word) CROSS JOIN (SELECT avg(size) AS mean FROM s)
)
SELECT *, row_number() OVER (PARTITION BY topic ORDER BY weight DESC, word) AS rank FROM x QUALIFY rank <= 20""",
    "kept_vectors": _with(PAGES, EMBEDDED_PAGES)
    + """SELECT source_file, page_number, coalesce(used, 0) AS used_buckets, coalesce(largest, 0) AS largest_weight
FROM p LEFT JOIN (SELECT document_id, count(*) AS used, round(max(weight), 6) AS largest FROM d GROUP BY document_id)
     USING (document_id)""",
    "running_totals": _with(PAGES)
    + """SELECT source_file, count(*) AS total_pages, sum(word_count)::BIGINT AS total_words,
       sum(char_count)::BIGINT AS total_chars FROM p GROUP BY source_file""",
    "store_replace": _with(PAGES)
    + """SELECT source_file, page_number, word_count,
       md5(CASE WHEN source_file LIKE 'src1_' THEN replace(text, ' ', '_') ELSE text END) AS text_md5
FROM p WHERE source_file NOT LIKE 'src1_' OR page_number % 2 = 1""",
    "store_append": _with(PAGES)
    + """SELECT source_file, page_number, word_count, md5(text) AS text_md5 FROM p
UNION ALL SELECT source_file || '/more', page_number, word_count, md5(replace(text, ' ', '_')) FROM p WHERE page_number % 5 = 0""",
    "store_delete": _with(PAGES)
    + """SELECT source_file, page_number, word_count, md5(text) AS text_md5 FROM p
WHERE NOT (source_file = 'src3' OR page_number % 4 = 2)""",
    "table_stats_kept": _with(PAGES, COUNTED)
    + """SELECT count(*) AS total_pages, count(DISTINCT source_file) AS unique_documents,
       coalesce(sum(word_count), 0)::BIGINT AS total_words FROM k""",
    "list_documents_kept": _with(PAGES, COUNTED) + "SELECT source_file, count(*) AS pages FROM k GROUP BY source_file",
    "page_sizes_kept": _with(PAGES, COUNTED)
    + """SELECT length(bin(word_count)) AS size_class, count(*) AS pages, sum(word_count)::BIGINT AS words
FROM k GROUP BY size_class""",
    "manifest_roundtrip": _with(MANIFEST)
    + """SELECT source_file, sum(page_count) OVER (PARTITION BY source_file)::BIGINT AS total_pages,
       count(*) OVER (PARTITION BY source_file) AS num_chunks, chunk_id, path, start_page, end_page, page_count
FROM m""",
    "book_roundtrip": _with(PAGES, CHUNKS, BOOKS)
    + """SELECT source_file, num_chunks, total_pages, total_word_count, chunk_id, md5(text) AS text_md5
FROM c JOIN b USING (source_file)""",
}
ORACLES["approx_topk"] = ORACLES["semantic_topk"]
ORACLES["cell_members"] = "SELECT vec_id, 1::BIGINT AS cells, 1::BIGINT AS rows FROM embeddings"
ORACLES["topic_clusters"] = "SELECT vec_id, 10::BIGINT AS topics, true AS nearest FROM embeddings"
ORACLES["similar_pages_cells"] = ORACLES["similar_pages"]
ORACLES["similar_pages_blocks"] = ORACLES["similar_pages"]
