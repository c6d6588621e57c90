"""SQL that states the result of the catalogue's queries, runnable by DuckDB."""

from __future__ import annotations

# Fixed values, stated here a second time so that the SQL does not follow the code.
CHAT_MODEL = "mixtral-8x7b-32768"
SYSTEM_TEXT = (
    "You are a highly advanced assistant. You receive a prompt from a user and relevant "
    "excerpts extracted from a text document. You then answer truthfully to the best of "
    "your ability. If you do not know the answer, your response is I don't know."
)
BEFORE_EXCERPTS = (
    "Based on the retrieved information from the document, here are the relevant excerpts:"
)
AFTER_EXCERPTS = (
    "Please provide a comprehensive answer to the user's question, integrating insights from "
    "these excerpts and your general knowledge."
)

WS = r"[\s\x0B\x{85}\p{Z}]+"


def _words(text: str) -> str:
    return f"list_filter(string_split_regex({text}, '{WS}'), lambda w: w <> '')"


def _quote(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _hash(word: str) -> str:
    return f"('0x' || substr(md5({word}), 1, 9))::BIGINT"


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


SIGN = "CASE WHEN h % 16 < 8 THEN 1 ELSE -1 END"

# Word chunks of the documents, 300 words with 80 of overlap.
CHUNKS = f"""
split AS (SELECT doc_id, lang, source, {_words('text')} AS w FROM documents),
numbered AS (
  SELECT *, unnest(range(0, CASE WHEN len(w) = 0 THEN 0
    ELSE 1 + CAST(ceil(greatest(len(w) - 300, 0) / 220.0) AS BIGINT) END)) AS chunk_no
  FROM split),
chunks AS (
  SELECT doc_id, chunk_no, lang, source, doc_id * 1048576 + chunk_no AS id,
    array_to_string(w[chunk_no * 220 + 1 : chunk_no * 220 + 300], ' ') AS text
  FROM numbered)"""

QUESTIONS = """
questions AS (
  SELECT conv_id * 1048576 + turn AS query_id, text FROM conversations WHERE role = 'user')"""


def _embedding(table: str, key: str, name: str) -> str:
    """CTE ``name``: dense hashed vectors of ``table``, with their squared norm."""
    return f"""
{name}_words AS (SELECT {key}, unnest({_words('text')}) AS w FROM {table}),
{name}_sums AS (
  SELECT {key}, (h >> 4) % 64 AS b, sum({SIGN}) AS v
  FROM (SELECT {key}, {_hash('w')} AS h FROM {name}_words) GROUP BY ALL),
{name} AS (
  SELECT k.{key}, list(coalesce(s.v, 0)::DOUBLE ORDER BY d.b) AS e,
    sum(coalesce(s.v, 0)::DOUBLE * coalesce(s.v, 0)) AS n
  FROM {table} k CROSS JOIN (SELECT unnest(range(64)) AS b) d
  LEFT JOIN {name}_sums s ON s.{key} = k.{key} AND s.b = d.b
  GROUP BY k.{key})"""


def _topk(points: str) -> str:
    return f"""
scored AS (
  SELECT q.query_id, p.id,
    round(list_dot_product(q.e, p.e) / nullif(sqrt(q.n * p.n), 0), 6) AS score
  FROM asked q CROSS JOIN {points} p),
hits AS (
  SELECT query_id, id, score, rank FROM (
    SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, id) AS rank
    FROM scored WHERE score IS NOT NULL) WHERE rank <= 3)"""


def _vocab(table: str, text: str = "text") -> str:
    return f"""
vocab_counts AS (
  SELECT token, count(*) AS n FROM (SELECT unnest({_words(text)}) AS token FROM {table})
  GROUP BY token),
vocab_top AS (
  SELECT token, row_number() OVER (ORDER BY n DESC, token) AS r FROM vocab_counts),
vocab AS (
  SELECT token, 999 + r AS id FROM vocab_top
  WHERE token NOT IN ('[PAD]', '[UNK]', '[CLS]', '[SEP]')
  UNION ALL
  SELECT * FROM (VALUES ('[PAD]', 0), ('[UNK]', 100), ('[CLS]', 101), ('[SEP]', 102)) t(token, id))"""


def _encoded(table: str, key: str, text: str = "text") -> str:
    """CTE ``encoded``: plain word ids per key; a text without words has an empty list."""
    return f"""
positions AS (
  SELECT {key}, unnest(w) AS token, unnest(range(1, len(w) + 1)) AS pos
  FROM (SELECT {key}, {_words(text)} AS w FROM {table})),
encoded AS (
  SELECT t.{key}, coalesce(x.ids, []) AS ids FROM {table} t LEFT JOIN (
    SELECT {key}, list(coalesce(v.id, 100) ORDER BY pos) AS ids
    FROM positions p LEFT JOIN vocab v ON v.token = p.token GROUP BY {key}) x
  ON x.{key} = t.{key})"""


KEYED = "keyed AS (SELECT *, conv_id * 1048576 + turn AS seq_id FROM conversations)"
MODEL = (
    "(['7b-open-chat-3.5', '7b-zephyr-b', 'mixtral', '7b-chat'])[conv_id % 4 + 1]"
)
PIECES = r"""
found AS (
  SELECT conv_id * 1048576 + turn AS seq_id, regexp_extract_all(text, '\s*\S{1,4}') AS p
  FROM conversations WHERE role = 'assistant'),
pieces AS (
  SELECT seq_id, unnest(range(0, len(p))) AS pos, unnest(p) AS piece FROM found)"""

FORMATTED = f"""
users AS (
  SELECT conv_id, turn, text, {MODEL} AS model,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS n
  FROM conversations WHERE role = 'user'),
formatted AS (
  SELECT conv_id, turn, model, CASE model
    WHEN '7b-open-chat-3.5' THEN 'GPT4 Correct User: ' || text || '<|end_of_turn|>GPT4 Correct Assistant:'
    WHEN '7b-zephyr-b' THEN CASE WHEN n = 1 THEN '<|system|>' || chr(10) || '</s>' || chr(10) ELSE '' END
      || '<|user|>' || chr(10) || text || '</s>' || chr(10) || '<|assistant|>'
    WHEN 'mixtral' THEN '[INST] ' || text || ' [/INST]'
    ELSE text END AS prompt
  FROM users)"""

ASSEMBLED = _with(
    PIECES,
    r"""
flagged AS (
  SELECT *, CASE WHEN regexp_matches(piece, '[\p{L}\p{N}]$') THEN 1 ELSE 0 END AS ends
  FROM pieces),
grouped AS (
  SELECT *, coalesce(sum(ends) OVER (PARTITION BY seq_id ORDER BY pos
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS emit_no FROM flagged)""",
) + """
SELECT seq_id, emit_no, string_agg(piece, '' ORDER BY pos) AS text
FROM grouped GROUP BY seq_id, emit_no"""

POINTS = _with(CHUNKS, _embedding("chunks", "id", "vectors")) + """
SELECT c.id, array_to_string(list_transform(v.e, lambda x: x::INTEGER), ' ') AS embedding,
  c.text AS txt_chunk, c.source
FROM chunks c JOIN vectors v ON v.id = c.id"""


def _message(role: str, content: str) -> str:
    return f"""'{{"role":"{role}","content":' || to_json({content}) || '}}'"""


def _request(messages: list[str]) -> str:
    listed = " || ',' || ".join(messages)
    return (
        f"""'{{"messages":[' || {listed} || '],"model":"{CHAT_MODEL}",'"""
        f""" || '"temperature":0.8,"max_tokens":4000,"top_p":1,"stop":null,"stream":false}}'"""
    )


def _rag_messages(question: str, context: str) -> list[str]:
    filled = f"{_quote(BEFORE_EXCERPTS)} || {context} || {_quote(AFTER_EXCERPTS)}"
    return [
        _message("system", _quote(SYSTEM_TEXT)),
        _message("user", question),
        _message("system", f"({filled})"),
    ]


def _size(size: str) -> str:
    def scaled(unit: int, name: str) -> str:
        cents = f"(({size} + {unit // 200}) // {unit // 100})"
        return f"({cents} // 100) || '.' || lpad(({cents} % 100)::VARCHAR, 2, '0') || '{name}'"

    return f"""CASE WHEN {size} < 1000 THEN {size} || 'B'
      WHEN {size} < 1000000 THEN {scaled(1_000, 'KB')}
      WHEN {size} < 1000000000 THEN {scaled(1_000_000, 'MB')}
      ELSE {scaled(1_000_000_000, 'GB')} END"""


ORACLES: dict[str, str] = {
    "read_documents": "SELECT doc_id, text, source FROM documents",
    "source_name": r"""
SELECT page_id, CASE WHEN name = '' THEN NULL
  WHEN regexp_matches(name, '^.+\.[^.]*$') THEN regexp_extract(name, '^(.+)\.[^.]*$', 1)
  ELSE name END AS source
FROM (SELECT page_id, regexp_extract(regexp_replace(url, '\?.*', ''), '([^/]*)$', 1) AS name
      FROM pages)""",
    "recreate_collection": "SELECT vec_id AS id, label::VARCHAR AS txt_chunk FROM embeddings",
    "list_collections": "SELECT DISTINCT role AS name FROM conversations",
    "upsert_points": """
WITH again AS (SELECT unnest([vec_id, vec_id + 1000000000]) AS id FROM embeddings WHERE label > 4)
SELECT vec_id AS id, 'old' AS state FROM embeddings WHERE vec_id NOT IN (SELECT id FROM again)
UNION ALL SELECT id, 'new' AS state FROM again""",
    "make_points": POINTS,
    "append_history": """
SELECT conv_id, turn, role, text FROM conversations WHERE role IN ('system', 'user', 'assistant')""",
    "write_requests": _with(QUESTIONS)
    + f"SELECT {_request([_message('user', 'text')])} AS body FROM questions",
    "read_responses": "SELECT text AS content FROM conversations WHERE role = 'assistant'",
    "drop_empty_lines": r"""
WITH spaced AS (
  SELECT doc_id, replace(replace(text, '. ', '.' || chr(13) || chr(10) || chr(13) || chr(10)),
    '? ', '?' || chr(10) || chr(10)) AS text FROM documents)
SELECT doc_id, array_to_string(
  list_filter(string_split_regex(text, '\r?\n'), lambda x: x <> ''), chr(10)) AS text
FROM spaced""",
    "project_hits": """
SELECT event_id AS id, value AS score, props AS payload FROM events
WHERE event_type NOT IN ('error', 'view')""",
    "wrap_payload": """
SELECT 'benchmark' AS origin, item_id AS id, text AS txt_chunk, 'benchmark' AS source,
  NULL::VARCHAR AS k FROM benchmark
UNION ALL
SELECT 'events', event_id, NULL, NULL, regexp_extract(props, '"k": ?([0-9]+)', 1) FROM events""",
    "payload_text": "SELECT conv_id, turn, text FROM conversations WHERE role <> 'system'",
    "search_where": _with(
        CHUNKS, QUESTIONS, "english AS (SELECT * FROM chunks WHERE lang = 'en')",
        _embedding("english", "id", "vectors"), _embedding("questions", "query_id", "asked"),
        _topk("vectors"),
    ) + "SELECT * FROM hits",
    "word_chunks": _with(CHUNKS) + "SELECT doc_id, chunk_no, text FROM chunks",
    "char_window_chunks": """
WITH n AS (
  SELECT doc_id, text, unnest(range(0, CASE WHEN length(text) < 400 THEN 0
    ELSE (length(text) - 400) // 320 + 1 END)) AS chunk_no FROM documents)
SELECT doc_id, chunk_no, substring(text, chunk_no * 320 + 1, 400) AS text FROM n""",
    "token_window_chunks": _with(
        _vocab("documents"), _encoded("documents", "doc_id"),
        """
windows AS (
  SELECT doc_id, ids, unnest(range(0, CAST(ceil(len(ids) / 410.0) AS BIGINT))) AS chunk_no
  FROM encoded),
cut AS (SELECT doc_id, chunk_no, ids[chunk_no * 410 + 1 : chunk_no * 410 + 510] AS w FROM windows)""",
    ) + """
SELECT doc_id, chunk_no,
  array_to_string(list_concat([101], w, [102], list_transform(range(510 - len(w)), lambda x: 0)), ' ')
    AS ids,
  array_to_string(list_concat(list_transform(range(len(w) + 2), lambda x: 1),
    list_transform(range(510 - len(w)), lambda x: 0)), ' ') AS mask
FROM cut""",
    "pad_batch": _with(
        KEYED, _vocab("keyed"), _encoded("keyed", "seq_id"),
        """
sized AS (SELECT seq_id // 1048576 AS conv_id, seq_id, list_concat([101], ids, [102]) AS ids FROM encoded),
longest AS (SELECT *, max(len(ids)) OVER (PARTITION BY conv_id) AS most FROM sized)""",
    ) + """
SELECT conv_id, seq_id, array_to_string(
  list_concat(ids, list_transform(range(most - len(ids)), lambda x: 0)), ' ') AS ids FROM longest""",
    "build_vocab": _with(_vocab("documents")) + "SELECT token, id::BIGINT AS id FROM vocab",
    "encode_corpus": _with(_vocab("documents"), _encoded("documents", "doc_id")) + """
SELECT doc_id, array_to_string(list_concat([101], ids, [102]), ' ') AS ids FROM encoded""",
    "decode_corpus": _with(
        _vocab("documents"),
        f"positions AS (SELECT doc_id, unnest(w) AS token, unnest(range(len(w))) AS pos"
        f" FROM (SELECT doc_id, {_words('text')} AS w FROM documents))",
    ) + """
SELECT d.doc_id, coalesce(x.text, '') AS text FROM documents d LEFT JOIN (
  SELECT p.doc_id, string_agg(p.token, ' ' ORDER BY p.pos) AS text
  FROM positions p JOIN vocab v ON v.token = p.token AND v.id >= 1000 GROUP BY p.doc_id) x
ON x.doc_id = d.doc_id""",
    "whole_vocab": _with(
        _vocab("documents"), _encoded("documents", "doc_id")
    ) + f"""
SELECT e.doc_id, array_to_string(list_concat([101], e.ids, [102]), ' ') AS ids,
  array_to_string({_words('d.text')}, ' ') AS text
FROM encoded e JOIN documents d ON d.doc_id = e.doc_id""",
    "token_listing": _with(
        "marked AS (SELECT conv_id * 1048576 + turn AS seq_id,"
        " replace(text, chr(10), ' <0x0A> ▁') AS text FROM conversations)",
        _vocab("marked"), _encoded("marked", "seq_id"),
        """
listed AS (
  SELECT seq_id, unnest(l) AS id, unnest(range(len(l))) AS pos
  FROM (SELECT seq_id, list_concat([101], ids, [102]) AS l FROM encoded))""",
    ) + """
SELECT l.seq_id, l.pos, l.id::BIGINT AS id,
  replace(replace(v.token, '▁', ' '), '<0x0A>', chr(10)) AS token
FROM listed l JOIN vocab v ON v.id = l.id""",
    "strip_prompt": f"""
SELECT u.conv_id, u.turn, array_to_string({_words('a.text')}, ' ') AS answer
FROM conversations u JOIN conversations a
  ON a.conv_id = u.conv_id AND a.turn = u.turn + 1 AND a.role = 'assistant'
WHERE u.role = 'user'""",
    "fit_context": f"""
WITH s AS (SELECT doc_id, {_words('text')} AS w FROM documents)
SELECT doc_id,
  array_to_string(CASE WHEN len(w) > 402 THEN w[len(w) - 401 :] ELSE w END, ' ') AS budget,
  array_to_string(CASE WHEN len(w) > 402 THEN w[len(w) - least(len(w), len(w) - 402) + 1 :]
    ELSE w END, ' ') AS as_written
FROM s""",
    "cut_at_eos": f"""
WITH m AS (
  SELECT conv_id, turn, text, CASE conv_id % 5 WHEN 0 THEN '<|end_of_turn|>' WHEN 4 THEN '<eos>'
    ELSE '</s>' END AS eos
  FROM conversations WHERE role = 'assistant'),
t AS (SELECT conv_id, turn, eos, {_words("replace(text, '.', ' ' || eos)")} AS w FROM m)
SELECT conv_id, turn, array_to_string(
  w[1 : least(12, coalesce(nullif(list_position(w, eos), 0), 12))], ' ') AS text
FROM t""",
    "embed_chunks": _with(CHUNKS, _embedding("chunks", "id", "vectors")) + """
SELECT c.doc_id, c.chunk_no,
  array_to_string(list_transform(v.e, lambda x: x::INTEGER), ' ') AS embedding
FROM chunks c JOIN vectors v ON v.id = c.id""",
    "embed_with_model": _with(CHUNKS, """
counts AS (
  SELECT doc_id, chunk_no, i, length(text) - length(replace(text, chr((97 + i)::INTEGER), '')) AS n
  FROM chunks, (SELECT unnest(range(26)) AS i)),
sums AS (
  SELECT doc_id, chunk_no, j, sum(n * ((i * 7 + j * 13) % 11 - 5))::BIGINT AS v
  FROM counts, (SELECT unnest(range(16)) AS j) GROUP BY ALL)""") + """
SELECT doc_id, chunk_no, string_agg(v::VARCHAR, ' ' ORDER BY j) AS embedding
FROM sums GROUP BY doc_id, chunk_no""",
    "window_vectors": _with(
        _vocab("documents"), _encoded("documents", "doc_id"),
        """
starts AS (
  SELECT doc_id, ids, unnest(range(0, CAST(ceil(len(ids) / 410.0) AS BIGINT))) AS chunk_no
  FROM encoded),
listed AS (
  SELECT doc_id * 1048576 + chunk_no AS key, unnest(w) AS token_id, unnest(range(len(w))) AS pos
  FROM (SELECT doc_id, chunk_no, ids[chunk_no * 410 + 1 : chunk_no * 410 + 510] AS w FROM starts)),
windows AS (
  SELECT l.key, coalesce(string_agg(v.token, ' ' ORDER BY l.pos), '') AS text
  FROM listed l LEFT JOIN vocab v ON v.id = l.token_id AND v.id >= 1000 GROUP BY l.key)""",
        _embedding("windows", "key", "vectors"),
    ) + """
SELECT key // 1048576 AS doc_id, key % 1048576 AS chunk_no,
  array_to_string(list_transform(e, lambda x: x::INTEGER), ' ') AS embedding FROM vectors""",
    "embed_queries": _with(QUESTIONS, _embedding("questions", "query_id", "asked")) + """
SELECT query_id, array_to_string(list_transform(e, lambda x: x::INTEGER), ' ') AS embedding
FROM asked""",
    "mean_pool": """
SELECT label::BIGINT AS label, dim, round(avg(x::DOUBLE), 6) AS value FROM (
  SELECT label, unnest(embedding) AS x, unnest(range(len(embedding))) AS dim FROM embeddings)
GROUP BY label, dim""",
    "l2_normalize": _with(CHUNKS, _embedding("chunks", "id", "vectors"), """
flat AS (
  SELECT id, unnest(e) AS x, unnest(range(64)) AS dim, n FROM vectors)""") + """
SELECT id // 1048576 AS doc_id, id % 1048576 AS chunk_no, dim, round(x / nullif(sqrt(n), 0), 6) AS value
FROM flat""",
    "cosine_similarity": """
WITH flat AS (
  SELECT vec_id, label, unnest(embedding)::DOUBLE AS x, unnest(range(len(embedding))) AS dim
  FROM embeddings),
means AS (SELECT label, dim, avg(x) AS m FROM flat GROUP BY label, dim)
SELECT vec_id, round(sum(x * m) / sqrt(sum(x * x) * sum(m * m)), 6) AS score
FROM flat JOIN means USING (label, dim) GROUP BY vec_id""",
    "topk_cosine": _with(
        CHUNKS, QUESTIONS, _embedding("chunks", "id", "vectors"),
        _embedding("questions", "query_id", "asked"), _topk("vectors"),
    ) + "SELECT * FROM hits",
    "topk_coded": _with(
        CHUNKS, QUESTIONS, _embedding("chunks", "id", "vectors"),
        _embedding("questions", "query_id", "asked"), _topk("vectors"),
    ) + "SELECT * FROM hits",
    "search_collection": _with(
        CHUNKS, QUESTIONS, "english AS (SELECT * FROM chunks WHERE lang = 'en')",
        _embedding("english", "id", "vectors"), _embedding("questions", "query_id", "asked"),
        _topk("vectors"),
    ) + """
SELECT h.query_id, h.id, h.score, h.rank, e.text AS txt_chunk, e.source
FROM hits h JOIN english e ON e.id = h.id""",
    "topk_cosine_sparse": _with(
        CHUNKS, QUESTIONS,
        *[
            f"""
{name}_words AS (SELECT {key}, unnest({_words('text')}) AS w FROM {table}),
{name} AS (
  SELECT {key}, (h >> 4) % 262144 AS b, sum({SIGN})::DOUBLE AS v
  FROM (SELECT {key}, {_hash('w')} AS h FROM {name}_words) GROUP BY ALL),
{name}_norms AS (SELECT {key}, sum(v * v) AS n FROM {name} GROUP BY ALL)"""
            for table, key, name in (("chunks", "id", "p"), ("questions", "query_id", "q"))
        ],
        """
dots AS (
  SELECT q.query_id, p.id, sum(q.v * p.v) AS dot FROM q JOIN p ON p.b = q.b GROUP BY ALL),
scored AS (
  SELECT qn.query_id, pn.id, round(coalesce(d.dot, 0) / nullif(sqrt(qn.n * pn.n), 0), 6) AS score
  FROM q_norms qn CROSS JOIN p_norms pn
  LEFT JOIN dots d ON d.query_id = qn.query_id AND d.id = pn.id)""",
    ) + """
SELECT query_id, id, score, rank FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, id) AS rank
  FROM scored WHERE score IS NOT NULL) WHERE rank <= 3""",
    "pairwise_similarity": """
SELECT a.vec_id AS i, b.vec_id AS j,
  round(list_dot_product(a.e, b.e) / sqrt(list_dot_product(a.e, a.e) * list_dot_product(b.e, b.e)), 6)
    AS score
FROM (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings) a
JOIN (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings) b ON a.vec_id < b.vec_id
ORDER BY score DESC, i, j LIMIT 5""",
    # Exact where the table fits one bucket; beyond, links may be missing.
    "similar_pairs_approx": """
WITH e AS (
  SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
), c AS (
  SELECT min(vec_id) AS class_id, e, list_dot_product(e, e) AS n FROM e GROUP BY e
), l AS (
  SELECT a.class_id, count(*) AS links FROM c a JOIN c b
    ON a.class_id <> b.class_id AND a.n > 0 AND b.n > 0
    AND round(list_dot_product(a.e, b.e) / sqrt(a.n * b.n), 6) >= 0.4
  GROUP BY a.class_id
)
SELECT e.vec_id AS id, c.class_id, coalesce(l.links, 0) AS links
FROM e JOIN c USING (e) LEFT JOIN l USING (class_id)""",
    "similar_texts": _with(_embedding("benchmark", "item_id", "vectors")) + """
SELECT i, j, score, a.text AS text_i, b.text AS text_j FROM (
  SELECT x.item_id AS i, y.item_id AS j,
    round(list_dot_product(x.e, y.e) / nullif(sqrt(x.n * y.n), 0), 6) AS score
  FROM vectors x JOIN vectors y ON x.item_id < y.item_id
  ORDER BY score DESC, i, j LIMIT 5)
JOIN benchmark a ON a.item_id = i JOIN benchmark b ON b.item_id = j""",
    "quantize_vectors": """
WITH s AS (
  SELECT vec_id, embedding::DOUBLE[] AS e,
    list_max(list_transform(embedding::DOUBLE[], lambda x: abs(x))) / 127 AS scale FROM embeddings),
c AS (
  SELECT *, list_transform(e, lambda x:
    greatest(-127, least(127, round_even(x / scale, 0)))::INTEGER) AS codes FROM s),
r AS (SELECT *, list_transform(codes, lambda x: x * scale) AS back FROM c)
SELECT vec_id, array_to_string(codes, ' ') AS codes, round(scale, 9) AS scale,
  round(list_dot_product(e, back)
    / sqrt(list_dot_product(e, e) * list_dot_product(back, back)), 6) AS kept
FROM r""",
    "context_text": """
SELECT q.query_id, coalesce(h.context, '') AS context
FROM (SELECT DISTINCT conv_id AS query_id FROM conversations) q LEFT JOIN (
  SELECT conv_id, string_agg(text, chr(10) ORDER BY turn) AS context
  FROM conversations WHERE role = 'assistant' GROUP BY conv_id) h ON h.conv_id = q.query_id""",
    "fill_template": f"""
SELECT item_id, {_quote(BEFORE_EXCERPTS)} || text || {_quote(AFTER_EXCERPTS)} AS filled,
  {_quote(BEFORE_EXCERPTS)} || text || {_quote(AFTER_EXCERPTS[1:])} AS legacy, NULL::VARCHAR AS missing
FROM benchmark""",
    "set_user_message": _with(QUESTIONS) + """
SELECT query_id, 'system' AS first_role, 'user' AS role, text AS content FROM questions""",
    "chat_request": _with(QUESTIONS)
    + f"SELECT query_id, {_request(_rag_messages('text', _quote('excerpt')))} AS body FROM questions",
    "minimal_request": f"""
SELECT item_id, '{{"messages":[' || {_message('system', "'Answer truthfully.'")} || ','
  || {_message('user', 'text')} || ','
  || {_message('system', "('Excerpts: ' || text || ' Answer from them.')")}
  || '],"model":"{CHAT_MODEL}"}}' AS body FROM benchmark""",
    "chat_response": """
SELECT conv_id, turn, 0::BIGINT AS choice, text AS content FROM conversations WHERE role <> 'system'
UNION ALL
SELECT conv_id, turn, 1, 'second' FROM conversations WHERE role <> 'system'""",
    "stream_deltas": _with(PIECES) + """
SELECT seq_id, string_agg(piece, '' ORDER BY pos) AS text FROM pieces GROUP BY seq_id""",
    "stream_deltas_stream": _with(PIECES) + """
SELECT seq_id, string_agg(piece, '' ORDER BY pos) AS text FROM pieces GROUP BY seq_id""",
    "validate_structured": "SELECT conv_id, turn, role = 'user' AS is_valid FROM conversations",
    "format_chat_turn": _with(FORMATTED) + "SELECT conv_id, turn, model, prompt FROM formatted",
    "chat_messages": """
SELECT conv_id, string_agg('<|im_start|>' || role || chr(10) || text || '<|im_end|>' || chr(10), ''
  ORDER BY turn) || '<|im_start|>assistant' || chr(10) AS prompt
FROM conversations GROUP BY conv_id""",
    "chat_history": _with(
        KEYED, "turns AS (SELECT * FROM keyed WHERE role IN ('user', 'assistant'))",
        _vocab("turns"), _encoded("turns", "seq_id"),
        """
wrapped AS (
  SELECT seq_id // 1048576 AS conv_id, seq_id % 1048576 AS turn,
    list_concat([101], ids, [102]) AS ids FROM encoded),
past AS (
  SELECT conv_id, turn, flatten(list(ids) OVER (PARTITION BY conv_id ORDER BY turn
    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)) AS h FROM wrapped)""",
    ) + """
SELECT conv_id, turn, array_to_string(h[greatest(len(h) - 255, 1) :], ' ') AS history FROM past""",
    "chat_context": _with(
        FORMATTED, _vocab("conversations"),
        """
said AS (
  SELECT conv_id, turn, 'user' AS role, prompt AS text FROM formatted
  UNION ALL
  SELECT conv_id, turn, role, text FROM conversations WHERE role = 'assistant'),
keyed AS (SELECT *, conv_id * 1048576 + turn AS seq_id FROM said)""",
        _encoded("keyed", "seq_id"),
        """
wrapped AS (
  SELECT k.conv_id, k.turn, k.role, list_concat([101], e.ids, [102]) AS ids
  FROM encoded e JOIN keyed k ON k.seq_id = e.seq_id),
past AS (
  SELECT conv_id, turn, role, flatten(list(ids) OVER (PARTITION BY conv_id ORDER BY turn
    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)) AS h FROM wrapped)""",
    ) + """
SELECT conv_id, turn, array_to_string(h[greatest(len(h) - 401, 1) :], ' ') AS ids
FROM past WHERE role = 'user'""",
    "json_map_values": """
SELECT DISTINCT regexp_extract(url, '^https?://([^/]+)/', 1) AS value FROM pages""",
    "assemble_text": ASSEMBLED,
    "assemble_text_stream": ASSEMBLED,
    "ingest_stream": POINTS,
    "format_size": f"""
SELECT doc_id, {_size('n_chars')} AS chars, {_size('(n_chars * n_chars * (doc_id + 1))')} AS scaled
FROM documents""",
    "total_size": f"""
SELECT source, items, bytes, {_size('bytes')} AS size FROM (
  SELECT source, count(*) AS items, sum(n_chars * 18 // 32)::BIGINT AS bytes
  FROM documents GROUP BY source)""",
    "throughput": """
SELECT event_type, count(*) AS items,
  round(date_diff('microsecond', min(ts), max(ts)) / 1e6, 3) AS seconds,
  round(count(*) / nullif(date_diff('microsecond', min(ts), max(ts)) / 1e6, 0), 6) AS per_second
FROM events GROUP BY event_type""",
    "job_counters": _with(CHUNKS) + """
SELECT 'documents' AS place, count(*) AS items, sum(length(text))::BIGINT AS letters FROM documents
UNION ALL SELECT 'chunks', count(*), sum(length(text))::BIGINT FROM chunks""",
    "rag_prompts": _with(
        CHUNKS, QUESTIONS, _embedding("chunks", "id", "vectors"),
        _embedding("questions", "query_id", "asked"), _topk("vectors"),
        """
contexts AS (
  SELECT h.query_id, string_agg(c.text, chr(10) ORDER BY h.rank) AS context
  FROM hits h JOIN chunks c ON c.id = h.id GROUP BY h.query_id),
filled AS (
  SELECT q.query_id, q.text, coalesce(c.context, '') AS context
  FROM questions q LEFT JOIN contexts c ON c.query_id = q.query_id)""",
    ) + f"SELECT query_id, context, {_request(_rag_messages('text', 'context'))} AS body FROM filled",
}
