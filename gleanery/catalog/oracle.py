"""The SQL each registered query is checked against, in DuckDB's dialect.

Written independently of the Spark side: page text by a chain of replacements instead
of a tag stack, word hashes by arithmetic, nearest vectors by comparing all pairs, link
walks by a recursive query.
"""

from __future__ import annotations

from gleanery.catalog.inputs import TEMPLATE

ORACLE: dict[str, str] = {}


def _with(*ctes: str) -> str:
    return "WITH RECURSIVE " + ",\n".join(ctes) + "\n"


# URLs ------------------------------------------------------------------------------

URL_KEY = r"""translate(regexp_replace({0}, '^https?://', ''), '<>:"/\|?*', '_________')"""
HOST = r"""nullif(lower(regexp_extract({0}, '(?i)^https?://(?:[^/?#@]*@)?([^/?#:]+)', 1)), '')"""

ORACLE["url_keys"] = f"SELECT page_id, {URL_KEY.format('url')} AS url_key FROM pages"
ORACLE["url_hosts"] = f"SELECT page_id, {HOST.format('url')} AS host FROM pages"
ORACLE["extract_urls_from_messages"] = rf"""
SELECT page_id, (generate_subscripts(urls, 1) - 1)::INTEGER AS pos, unnest(urls) AS url FROM (
  SELECT page_id, regexp_extract_all('Index ' || url || ', <' || url || '> and "' || url || '"; also (www.'
    || {HOST.format('url')} || '/x.) thanks', '\bhttps?://[^\s<>"]+|www\.[^\s<>"]+\b') AS urls FROM pages)"""

# page text -------------------------------------------------------------------------

_BLOCK = "regexp_replace({0}, '(?is)<" + "{1}" + r"\b.*?(</" + "{1}" + r"\s*>|$)', chr(1), 'g')"


def _text_nodes(html: str) -> str:
    body = f"regexp_replace({html}, '(?is)^.*?<body[^>]*>', '')"
    for tag in ("script", "style", "footer", "header", "nav"):
        body = _BLOCK.format(body, tag)
    body = rf"regexp_replace({body}, '(?s)<!--.*?-->', chr(1), 'g')"
    body = rf"regexp_replace({body}, '(?s)<[^>]*>', chr(1), 'g')"
    for name, sign in (("copy", "©"), ("middot", "·"), ("quot", '"'), ("lt", "<"), ("gt", ">"), ("amp", "&")):
        body = f"regexp_replace({body}, '&{name};?', '{sign}', 'g')"
    nodes = rf"list_transform(string_split({body}, chr(1)), lambda n: regexp_replace(n, '^\s+|\s+$', '', 'g'))"
    return f"CASE WHEN regexp_matches({html}, '(?i)<body') THEN array_to_string(list_filter({nodes}, lambda n: n <> ''), chr(10)) ELSE '' END"


def _clean(text: str) -> str:
    flat = rf"regexp_replace(regexp_replace({text}, '\\[tn]', ' ', 'g'), '\s+', ' ', 'g')"
    return rf"trim(regexp_replace({flat}, '\[\d+\]', '', 'g'))"


ORACLE["extract_page_text"] = f"SELECT page_id, {_text_nodes('html')} AS text FROM pages"
ORACLE["clean_document_text"] = rf"""
SELECT doc_id, {_clean(r"raw")} AS text FROM (
  SELECT doc_id, chr(9) || ' \t' || text || ' [' || doc_id || '] \n\n ' || replace(text, ' ', ' ' || chr(10) || ' ') || '[7][x] ' AS raw
  FROM documents)"""


def _chunks(source: str, key: str, name: str = "chunks") -> str:
    """CTE: chunks of ``source({key}, text)``."""
    return rf"""{name} AS (
  SELECT {key}, s.i::INTEGER AS "offset", array_to_string(words[s.i * 384 + 1 : s.i * 384 + 512], ' ') AS chunk
  FROM (SELECT *, list_filter(regexp_split_to_array(text, '\s+'), lambda w: w <> '') AS words FROM {source}),
       LATERAL (SELECT unnest(range(0, ((len(words) + 383) // 384)::BIGINT)) AS i) s)"""


ORACLE["chunk_documents"] = _with(_chunks("documents", "doc_id")) + 'SELECT doc_id, "offset", chunk FROM chunks'

# captures --------------------------------------------------------------------------

EVENTS = r"""captures AS (
  SELECT page_id AS ingest_seq, url, 1704067200000 + (page_id * 7919) % 1000003 * 1000 AS ts, html,
         regexp_extract(url, '^https?://[^/]+/([a-z]+)/', 1) AS user_id FROM pages)"""
RECRAWLS = "recrawls AS (SELECT * REPLACE (regexp_extract(url, '^https?://[^/]+/[a-z]+', 0) AS url) FROM captures)"
JUDGED = r"""judged AS (
  SELECT *, CASE WHEN contains(html, '</body>') THEN 'ok' WHEN contains(url, '?') THEN 'malformed_json'
                 WHEN contains(url, '#') THEN 'fetch_error' ELSE 'missing_userId' END AS reason FROM {0})"""
KEYED = f"keyed AS (SELECT *, {URL_KEY.format('url')} AS url_key FROM recrawls)"
KEYED_OK = f"keyed AS (SELECT *, {URL_KEY.format('url')} AS url_key FROM judged WHERE reason = 'ok')"
LATEST = "latest AS (SELECT * FROM keyed QUALIFY row_number() OVER (PARTITION BY url_key ORDER BY ingest_seq DESC) = 1)"


def _texts(source: str, columns: str, name: str = "texts") -> str:
    return f"{name} AS (SELECT {columns}, {_clean(_text_nodes('html'))} AS text FROM {source})"


ORACLE["judged_page_events"] = _with(EVENTS, JUDGED.format("captures")) + "SELECT ingest_seq, reason FROM judged"
ORACLE["page_event_transport"] = _with(EVENTS) + "SELECT ingest_seq, url, ts, html, user_id FROM captures"
ORACLE["page_document_rows"] = (
    _with(EVENTS, f"keyed AS (SELECT *, {URL_KEY.format('url')} AS url_key FROM captures)", _texts("keyed", "url_key"), _chunks("texts", "url_key"))
    + """SELECT url_key || '_' || "offset" AS id, url_key, "offset", chunk FROM chunks"""
)
ORACLE["latest_page_snapshots"] = _with(EVENTS, RECRAWLS, KEYED, LATEST) + "SELECT url_key, url, ts, html FROM latest"
_LOG = "SELECT url_key, url, arg_max(ts, ingest_seq) AS ts FROM keyed GROUP BY url_key, url"
ORACLE["page_crawl_log"] = _with(EVENTS, RECRAWLS, KEYED) + _LOG
ORACLE["latest_documents_by_id"] = _with(EVENTS, RECRAWLS, KEYED, _texts("keyed", "url_key, ingest_seq"), _chunks("texts", "url_key, ingest_seq")) + """
SELECT url_key || '_' || "offset" AS id, "offset", chunk FROM chunks
QUALIFY row_number() OVER (PARTITION BY url_key, "offset" ORDER BY ingest_seq DESC) = 1"""
_EDGES = """SELECT DISTINCT url_key || '_' || "offset" AS document_id, user_id FROM chunks"""
ORACLE["ownership_of_pages"] = _with(EVENTS, RECRAWLS, KEYED, _texts("keyed", "url_key, user_id"), _chunks("texts", "url_key, user_id")) + _EDGES

_INDEX = (
    EVENTS,
    RECRAWLS,
    # the section URLs have neither query nor fragment, so a cut-off capture lost its user
    JUDGED.format("recrawls"),
    KEYED_OK,
    LATEST,
)
_DOCUMENTS = (*_INDEX, _texts("latest", "url_key"), _chunks("texts", "url_key"))
for _name in ("indexed_documents", "streamed_documents", "reindexed_documents"):
    ORACLE[_name] = _with(*_DOCUMENTS) + """SELECT url_key || '_' || "offset" AS id, url_key, "offset", chunk FROM chunks"""
ORACLE["indexed_snapshots"] = _with(*_INDEX) + "SELECT url_key, url, ts, html FROM latest"
ORACLE["indexed_crawl_log"] = _with(*_INDEX) + _LOG
ORACLE["indexed_ownership"] = _with(*_INDEX, _texts("keyed", "url_key, user_id"), _chunks("texts", "url_key, user_id")) + _EDGES

ORACLE["imported_pages"] = _with(EVENTS, f"keyed AS (SELECT *, {URL_KEY.format('url')} AS url_key FROM captures)", LATEST, f"log AS ({_LOG})") + """
SELECT url_key, arg_max(log.url, log.ts) AS url, max(log.ts) AS ts, chr(10) || any_value(html) || chr(13) || chr(10) || 'ü' || chr(10) AS html, count(*) AS urls
FROM latest JOIN log USING (url_key) GROUP BY url_key"""
ORACLE["unnumbered_captures"] = _with(
    EVENTS, RECRAWLS, KEYED,
    "delivered AS (SELECT *, unnest([0] || CASE WHEN ingest_seq % 5 = 0 THEN [1] ELSE [] END || CASE WHEN ingest_seq % 3 = 0 THEN [2] ELSE [] END) AS delivery FROM keyed)",
    "newest AS (SELECT * FROM delivered QUALIFY row_number() OVER (PARTITION BY url_key, url ORDER BY delivery DESC, ingest_seq DESC) = 1)",
) + """
SELECT url_key, url, ts, '<body>delivery ' || delivery || ' of ' || ingest_seq || CASE delivery WHEN 1 THEN '</body>' ELSE '' END AS html, ts AS logged
FROM newest QUALIFY row_number() OVER (PARTITION BY url_key ORDER BY delivery DESC, ingest_seq DESC) = 1"""

_TWINS = f"SELECT {URL_KEY.format('url')} || '_0' AS id, max(page_id) AS last FROM pages GROUP BY 1"
ORACLE["interleaved_runs_documents"] = f"SELECT id, 'write 2 of ' || last AS chunk FROM ({_TWINS})"
ORACLE["compacted_snapshots_documents"] = f"SELECT id, last::VARCHAR AS chunk FROM ({_TWINS})"
ORACLE["merged_buckets_documents"] = _with(
    f"twins AS (SELECT {URL_KEY.format('url')} AS url_key, page_id FROM pages)",
    "batches AS (SELECT url_key, max(page_id) AS first, max(page_id) FILTER (page_id % 2 = 0) AS second, max(page_id) FILTER (page_id % 3 = 0) AS third FROM twins GROUP BY url_key)",
    "pages_left AS (SELECT url_key, coalesce(third, second, first) AS last, CASE WHEN third IS NOT NULL THEN 1 WHEN second IS NOT NULL THEN 900 ELSE 600 END AS n FROM batches)",
) + """
SELECT url_key || '_' || i AS id, CASE WHEN i * 384 + 512 >= n THEN last::VARCHAR ELSE 'w' END AS last_word
FROM (SELECT *, unnest(range(0, ((n + 383) // 384)::BIGINT)) AS i FROM pages_left)"""
ORACLE["fetched_records"] = """
SELECT url, page_id AS ts, CASE WHEN page_id % 3 = 0 THEN url ELSE 'crawler' END AS user_id, 'ok' AS reason FROM pages"""

# links -----------------------------------------------------------------------------

LINKS = r"""links AS (
  SELECT *, unnest(hrefs) AS href, (generate_subscripts(hrefs, 1) - 1)::INTEGER AS pos FROM (
    SELECT * EXCLUDE (html), list_transform(regexp_extract_all(html, '(?i)<a\s[^>]*?href\s*=\s*("[^"]*"|''[^'']*'')', 1),
      lambda h: replace(h[2:len(h) - 1], '&amp;', '&')) AS hrefs FROM {0}))"""
TARGETS = r"""targets AS (
  SELECT *, CASE WHEN href[1] = '/' THEN regexp_extract(url, '^https?://[^/]*', 0) ||
      array_to_string(list_transform(string_split(href, ''), lambda c:
        CASE WHEN regexp_matches(c, '[^\x21-\x7e]|["<>`{}]') THEN url_encode(c) ELSE c END), '')
    ELSE href END AS target FROM links WHERE href[1] = '/' OR href[1:4] = 'http')"""
EDGES = f"edges AS (SELECT DISTINCT url, target FROM targets WHERE {HOST.format('target')} = {HOST.format('url')})"
SITE = rf"""own_links AS (SELECT * FROM ({LINKS.format('pages')[len('links AS ('):-1]})),
own_edges AS ({EDGES[len('edges AS ('):-1].replace('FROM targets', f"FROM ({TARGETS[len('targets AS ('):-1].replace('FROM links', 'FROM own_links')})")}),
site AS (SELECT url, html FROM pages UNION ALL
  SELECT target, '<a href=''' || replace(min(url), '&', '&amp;') || '''>back</a><a href=''#''>top</a>' FROM own_edges GROUP BY target)"""

ORACLE["page_links"] = _with(LINKS.format("pages")) + "SELECT page_id, pos, href FROM links"
ORACLE["resolved_page_links"] = _with(LINKS.format("pages"), TARGETS) + "SELECT page_id, pos, target FROM targets"
ORACLE["same_host_links"] = (
    _with(SITE, LINKS.format("site"), TARGETS)
    + f"SELECT url, pos, target FROM targets WHERE {HOST.format('target')} = {HOST.format('url')}"
)


def _walk(seeds: str) -> str:
    return f"""walk AS (
  SELECT url AS seed, url, 1 AS depth, max_depth FROM ({seeds}) WHERE url IN (SELECT url FROM site)
  UNION SELECT w.seed, e.target, w.depth + 1, max_depth FROM walk w JOIN edges e ON e.url = w.url
  WHERE w.depth < max_depth AND e.target IN (SELECT url FROM site)),
reach AS (SELECT seed, url, min(depth)::INTEGER AS depth FROM walk GROUP BY seed, url),
frontier AS (SELECT seed, url, target, (depth + 1)::INTEGER AS depth FROM reach JOIN edges USING (url)
  WHERE target NOT IN (SELECT url FROM site))"""


ORACLE["crawl_reach_depth_4"] = (
    _with(SITE, LINKS.format("site"), TARGETS, EDGES, _walk("SELECT url, 4 AS max_depth FROM pages")) + "SELECT * FROM reach"
)
ORACLE["crawl_frontier_depth_1"] = (
    _with("site AS (SELECT url, html FROM pages)", LINKS.format("site"), TARGETS, EDGES, _walk("SELECT url, 1 AS max_depth FROM pages"))
    + "SELECT * FROM frontier"
)
_SEEDS = "SELECT url, CASE user_id WHEN 'fr' THEN 1 ELSE 2 END AS max_depth FROM captures WHERE user_id <> 'en'"
ORACLE["crawl_plans"] = _with(EVENTS, SITE, LINKS.format("site"), TARGETS, EDGES, _walk(_SEEDS)) + f"""
SELECT 'seed' AS step, url AS seed, url, NULL::VARCHAR AS target, max_depth AS depth FROM ({_SEEDS})
UNION ALL SELECT 'reach', seed, url, NULL, depth FROM reach
UNION ALL SELECT 'fetch', seed, url, target, depth FROM frontier"""
_SECTIONS = """SELECT DISTINCT url, 2 AS max_depth FROM (
    SELECT regexp_extract(url, '^https?://[^/]+/[a-z]+', 0) AS url FROM captures UNION ALL SELECT url FROM captures WHERE user_id = 'de')
  WHERE url <> ''"""
ORACLE["crawl_fetches"] = _with(EVENTS, "site AS (SELECT url, html FROM pages)", LINKS.format("site"), TARGETS, EDGES, _walk(_SECTIONS)) + f"""
SELECT url AS seed, NULL::VARCHAR AS url, url AS target, 1 AS depth FROM ({_SECTIONS}) WHERE url NOT IN (SELECT url FROM pages)
UNION ALL SELECT seed, url, target, depth FROM frontier WHERE depth <= 2"""
ORACLE["entity_links"] = """
SELECT page_id, 0 AS pos, '/s?a=' || page_id || '&region=eu&section=2&copy=3' || chr(172) || chr(169) || '&x=1&y=2' AS href FROM pages"""
ORACLE["valid_crawl_requests"] = r"""
SELECT url, CASE WHEN depth >= 1 THEN depth END AS depth, CASE WHEN depth >= 1 THEN 'ok' ELSE 'invalid_depth' END AS reason
FROM (SELECT url, nullif(regexp_extract(url, '[?&]page=(\d+)', 1), '')::INTEGER - 1 AS depth FROM pages)"""

# vectors ---------------------------------------------------------------------------


def _distance(a: str, b: str) -> str:
    return f"list_sum(list_transform(list_zip({a}, {b}), lambda p: (p[1]::DOUBLE - p[2]::DOUBLE) * (p[1]::DOUBLE - p[2]::DOUBLE)))"


def _nearest(pairs: str) -> str:
    """CTE: the 7 nearest of ``pairs(qid, document_id, a, b)``."""
    return f"""hits AS (SELECT qid, rank::INTEGER AS rank, document_id, dist FROM (
  SELECT *, row_number() OVER (PARTITION BY qid ORDER BY dist, document_id) AS rank
  FROM (SELECT qid, document_id, {_distance('a', 'b')} AS dist FROM ({pairs}))) WHERE rank <= 7)"""


ORACLE["vector_gaps"] = (
    f"SELECT e.vec_id, {_distance('e.embedding', 'n.embedding')} AS dist FROM embeddings e JOIN embeddings n ON n.vec_id = e.vec_id + 1"
)
_OWNED = "owned AS (SELECT DISTINCT event_id % (SELECT count(*) FROM embeddings) AS vec_id, user_id FROM events)"
ORACLE["user_vectors"] = _with(_OWNED) + "SELECT vec_id::VARCHAR AS id FROM owned WHERE user_id = 8"
ORACLE["nearest_vectors"] = (
    _with(_nearest("SELECT q.vec_id::VARCHAR AS qid, d.vec_id::VARCHAR AS document_id, q.embedding AS a, d.embedding AS b FROM embeddings q, embeddings d"))
    + "SELECT * FROM hits"
)
_SCOPED = _nearest("""SELECT q.vec_id::VARCHAR AS qid, d.vec_id::VARCHAR AS document_id, q.embedding AS a, d.embedding AS b
    FROM embeddings q JOIN embeddings d ON q.label = 0 OR (q.vec_id, d.vec_id) IN (SELECT user_id, vec_id FROM owned)""")
ORACLE["nearest_owned_vectors"] = _with(_OWNED, _SCOPED) + "SELECT * FROM hits"

_DOC_HITS = "found AS (SELECT qid, rank, source AS url_key, text AS chunk FROM hits JOIN documents ON doc_id::VARCHAR = document_id)"
_ASKED = "asked AS (SELECT vec_id::VARCHAR AS qid, 'What about ' || vec_id || '?' AS prompt FROM embeddings)"
_BEFORE, _BETWEEN, _AFTER = (f"'{part}'" for part in TEMPLATE.split("{}"))


def _contexts(source: str = "found") -> str:
    return f"contexts AS (SELECT qid, string_agg(chunk, chr(10) || chr(10) ORDER BY rank) AS context FROM {source} GROUP BY qid)"


_EVIDENCE = "evidence AS (SELECT qid, string_agg(chunk, chr(10) ORDER BY rank) AS chunks, string_agg(url_key, chr(10) ORDER BY rank) AS urls FROM found GROUP BY qid)"
ORACLE["assembled_contexts"] = _with(_OWNED, _SCOPED, _DOC_HITS, _ASKED, _contexts()) + f"""
SELECT qid, prompt, coalesce(context, '') AS context,
       {_BEFORE} || coalesce(context, '') || {_BETWEEN} || prompt || {_AFTER} AS model_input
FROM asked LEFT JOIN contexts USING (qid)"""
ORACLE["hit_evidence"] = _with(_OWNED, _SCOPED, _DOC_HITS, _EVIDENCE) + "SELECT * FROM evidence"
ORACLE["answer_blocks"] = _with(_OWNED, _SCOPED, _DOC_HITS, _ASKED, _EVIDENCE) + """
SELECT qid, '🧠 Answer:' || chr(10) || upper(prompt) || chr(10) || chr(10) || '⏳ URL:' || chr(10) || coalesce(urls, '')
  || chr(10) || chr(10) AS block FROM asked LEFT JOIN evidence USING (qid)"""

# hashed word embedding -------------------------------------------------------------
# 32-bit Murmur3 (seed 42) of each word's UTF-8 bytes, modulo 384, in plain arithmetic.

_M32 = "4294967295::UBIGINT"


def _rotl(x: str, r: int) -> str:
    return f"((({x}) << {r}) | (({x}) >> {32 - r})) & {_M32}"


def _mix_k(k: str) -> str:
    first = f"(({k}) * 3432918353::UBIGINT) & {_M32}"
    return f"(({_rotl(first, 15)}) * 461845907::UBIGINT) & {_M32}"


def _vectors(source: str, key: str, name: str = "weights") -> tuple[str, ...]:
    """CTEs: non-zero embedding entries of ``source({key}, txt)``."""
    digit = lambda at: f"(instr('0123456789ABCDEF', h[({at}):({at})]) - 1)"
    byte = lambda i: f"({digit(f'2 * ({i}) + 1')} * 16 + {digit(f'2 * ({i}) + 2')})::UBIGINT"
    block = f"{byte('4 * b')} + {byte('4 * b + 1')} * 256 + {byte('4 * b + 2')} * 65536 + {byte('4 * b + 3')} * 16777216"
    tail = f"list_sum(list_transform(range(n // 4 * 4, n), lambda t: ({byte('t')} << (8 * (t % 4))::INTEGER)::BIGINT))::UBIGINT"
    shift_mul = lambda x, r, c: f"(xor({x}, {x} >> {r}) * {c}::UBIGINT) & {_M32}"
    return (
        rf"{name}_tok AS MATERIALIZED (SELECT {key}, unnest(regexp_split_to_array(lower(txt), '\s+')) AS w FROM {source})",
        f"{name}_vocab AS (SELECT w, hex(encode(w)) AS h, octet_length(encode(w))::BIGINT AS n FROM (SELECT DISTINCT w FROM {name}_tok WHERE w <> ''))",
        f"{name}_blocks AS (SELECT w, n, list_transform(range(0, n // 4), lambda b: {_mix_k(block)}) AS ks, coalesce({tail}, 0::UBIGINT) AS t FROM {name}_vocab)",
        f"""{name}_h1 AS (SELECT w, n, t, list_reduce(list_prepend(42::UBIGINT, ks),
          lambda hh, k: ((({_rotl('xor(hh, k)', 13)}) * 5 + 3864292196::UBIGINT) & {_M32})) AS h1 FROM {name}_blocks)""",
        f"{name}_h2 AS (SELECT w, xor(CASE WHEN n % 4 > 0 THEN xor(h1, {_mix_k('t')}) ELSE h1 END, n::UBIGINT) AS x FROM {name}_h1)",
        f"{name}_h3 AS (SELECT w, {shift_mul('x', 16, 2246822507)} AS x FROM {name}_h2)",
        f"{name}_h4 AS (SELECT w, {shift_mul('x', 13, 3266489909)} AS x FROM {name}_h3)",
        f"{name}_h5 AS (SELECT w, xor(x, x >> 16)::BIGINT AS x FROM {name}_h4)",
        f"{name}_hash AS (SELECT w, (((CASE WHEN x >= 2147483648 THEN x - 4294967296 ELSE x END) % 384 + 384) % 384)::INTEGER AS bucket FROM {name}_h5)",
        f"{name}_tf AS (SELECT {key}, bucket, count(*)::DOUBLE AS tf FROM {name}_tok JOIN {name}_hash USING (w) GROUP BY {key}, bucket)",
        f"{name} AS (SELECT {key}, bucket, (tf / sqrt(sum(tf * tf) OVER (PARTITION BY {key})))::FLOAT AS weight FROM {name}_tf)",
    )


def _dense(source: str, weights: str, key: str, name: str) -> str:
    return f"""{name} AS MATERIALIZED (SELECT {key}, list(coalesce(weight, 0::FLOAT) ORDER BY bucket) AS v
  FROM (SELECT {key}, bucket FROM (SELECT {key} FROM {source}), (SELECT unnest(range(0, 384))::INTEGER AS bucket))
  LEFT JOIN {weights} USING ({key}, bucket) GROUP BY {key})"""


_QUESTIONS = """questions AS (SELECT conv_id || '-' || turn AS qid, CASE WHEN role = 'user' THEN text ELSE '' END AS prompt,
  ['', 'en', 'fr', 'de', 'es'][conv_id % 5 + 1] AS user_id FROM conversations),
asked AS (SELECT *, prompt AS txt FROM questions WHERE prompt <> '')"""
ORACLE["non_empty_questions"] = _with(_QUESTIONS) + "SELECT qid, prompt, user_id FROM asked"
ORACLE["embed_questions"] = _with(_QUESTIONS, *_vectors("asked", "qid")) + "SELECT qid, bucket, weight FROM weights"
ORACLE["embed_document_chunks"] = (
    _with(_chunks("documents", "doc_id"), """named AS (SELECT doc_id || '_' || "offset" AS id, chunk AS txt FROM chunks)""", *_vectors("named", "id"))
    + "SELECT id, bucket, weight FROM weights"
)
_RETRIEVED = (
    EVENTS,
    f"keyed AS (SELECT *, {URL_KEY.format('url')} AS url_key FROM captures)",
    LATEST,
    _texts("latest", "url_key"),
    _chunks("texts", "url_key"),
    """docs AS MATERIALIZED (SELECT url_key || '_' || "offset" AS document_id, url_key, chunk, chunk AS txt FROM chunks)""",
    _texts("keyed", "url_key, user_id", "all_texts"),
    _chunks("all_texts", "url_key, user_id", "all_chunks"),
    f"owned AS MATERIALIZED ({_EDGES.replace('FROM chunks', 'FROM all_chunks')})",
    _QUESTIONS,
    *_vectors("asked", "qid", "qw"),
    *_vectors("docs", "document_id", "dw"),
    _dense("asked", "qw", "qid", "qv"),
    _dense("docs", "dw", "document_id", "dv"),
    _nearest("""SELECT qid, document_id, qv.v AS a, dv.v AS b FROM asked JOIN qv USING (qid), dv
      WHERE user_id = '' OR (document_id, user_id) IN (SELECT document_id, user_id FROM owned)"""),
    "found AS (SELECT * FROM hits JOIN docs USING (document_id))",
)
for _name in ("retrieved_hits", "served_hits"):
    ORACLE[_name] = _with(*_RETRIEVED) + "SELECT qid, rank, document_id, url_key, chunk, dist FROM found"
ORACLE["retrieval_prompts"] = _with(*_RETRIEVED, _contexts(), _EVIDENCE) + f"""
SELECT qid, prompt, {_BEFORE} || coalesce(context, '') || {_BETWEEN} || prompt || {_AFTER} AS model_input,
       coalesce(chunks, '') AS chunks, coalesce(urls, '') AS urls
FROM asked LEFT JOIN contexts USING (qid) LEFT JOIN evidence USING (qid)"""

# conversations ---------------------------------------------------------------------

_PAIRS = """pairs AS (SELECT conv_id, turn, text AS user_prompt, next_text AS model_response FROM (
  SELECT *, lead(role) OVER w AS next_role, lead(text) OVER w AS next_text FROM conversations
  WINDOW w AS (PARTITION BY conv_id ORDER BY turn)) WHERE role = 'user' AND next_role = 'assistant')"""
for _name in ("paired_turns", "paired_turns_short_spans"):
    ORACLE[_name] = _with(_PAIRS) + "SELECT * FROM pairs"
ORACLE["turns_to_last_user"] = """
SELECT conv_id, turn, role, text FROM conversations JOIN (
  SELECT conv_id, max(turn) AS cut FROM conversations WHERE role = 'user' GROUP BY conv_id) USING (conv_id) WHERE turn <= cut"""
_CHATS = """chats AS (SELECT conv_id || '-' || turn AS id, user_prompt, model_response,
  1704067200000000 + conv_id * 60000123 + turn AS micros, conv_id * 1000000 + turn AS seq FROM pairs)"""
ORACLE["chat_event_transport"] = _with(_PAIRS, _CHATS) + "SELECT id, user_prompt, model_response, micros, seq FROM chats"
for _name in ("stored_conversations", "streamed_conversations"):
    ORACLE[_name] = _with(_PAIRS, _CHATS) + "SELECT id, user_prompt, model_response, micros FROM chats"
ORACLE["chat_event_ids"] = _with(_PAIRS, _CHATS) + r"""
SELECT seq, id, md5(json_object('user_prompt', user_prompt, 'model_response', model_response,
  'timestamp', strftime(make_timestamp(micros), '%Y-%m-%d %H:%M:%S.%f'))::VARCHAR) AS digest FROM chats"""
ORACLE["judged_chat_events"] = """
SELECT conv_id || '-' || turn AS id, CASE WHEN role = 'user' THEN text END AS user_prompt,
       CASE role WHEN 'user' THEN 'ok' WHEN 'system' THEN 'malformed_json' ELSE 'missing_user_prompt' END AS reason
FROM conversations"""
