"""DuckDB SQL for the queries of the document jobs, on the driver's tables."""

from __future__ import annotations

# The white space of docsync.functions.text in RE2's notation.
IN = r"\x{0009}-\x{000d}\x{001c}-\x{0020}\x{0085}\x{00a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
WS = f"[{IN}]"
N = "chr(10)"


def strip(x: str) -> str:
    return f"regexp_replace({x}, '^{WS}+|{WS}+$', '', 'g')"


def collapse(x: str) -> str:
    return f"trim(regexp_replace({x}, '{WS}+', ' ', 'g'))"


def newlines(x: str) -> str:
    return rf"regexp_replace({x}, '\r\n?', {N}, 'g')"


def path(suffix: str) -> str:
    return f"('/docs/' || coalesce(source, 'none') || '/' || doc_id || {suffix})"


MD = "'.md'"
BLANK = rf"'\n{WS}*\n+'"
LINES = f"string_split(text, {N})"


def numbered(rows: str, order: str = "pos", page: str = "1") -> str:
    """Rows (source_path, pos, text, ...) without the blank ones, numbered in each file."""
    return f"SELECT source_path, row_number() OVER (PARTITION BY source_path ORDER BY {order}) AS paragraph_num, {page}::BIGINT AS page_num, text FROM ({rows}) WHERE length(text) > 0"


def exploded(source: str, array: str, text: str = "t", keep: str = "") -> str:
    """A row per element of an array, with its place from 0."""
    return f"SELECT source_path, {keep} pos, {text} AS text FROM (SELECT source_path, {keep} unnest(arr) AS t, generate_subscripts(arr, 1) - 1 AS pos FROM (SELECT *, {array} AS arr FROM {source}))"


def md_files(suffix: str) -> str:
    return f"""(SELECT {path(suffix)} AS source_path, CASE WHEN doc_id % 2 = 0 THEN '---' || {N} || 'lang: ' || coalesce(lang, '') || {N} || '---' || {N} ELSE '' END
  || replace(text, {N}, {N} || {N}) AS raw FROM documents)"""


CLOSE = f"instr(substr(raw, 5), {N} || '---' || {N})"
NO_FRONT = f"CASE WHEN starts_with(raw, '---' || {N}) AND {CLOSE} > 0 THEN substr(raw, {CLOSE} + 9) ELSE raw END"


def md_paragraphs(suffix: str) -> str:
    return numbered(exploded(md_files(suffix), f"string_split_regex({strip(NO_FRONT)}, {BLANK})", collapse("t")))


MD_PARAGRAPHS = md_paragraphs(MD)

STAMP = "strftime(ts, '%Y-%m-%d %H:%M:%S')"
VALUE = "floor(value * 100)::BIGINT"
LINE = f"""CASE WHEN event_id % 7 = 0 THEN concat_ws(' ', 'plain', event_type, {VALUE}) ELSE {STAMP} || ' | [' || upper(event_type) || '] |  value=' || {VALUE} || ' ' || coalesce(props, '') END"""
LOG_RE = rf"'^(.+?){WS}*\|{WS}*\[(.+?)\]{WS}*\|{WS}*(.+)$'"
LOG_PARAGRAPHS = numbered(
    f"""SELECT '/logs/' || user_id || '.log' AS source_path, ts, event_id, {collapse(rf"regexp_replace({LINE}, {LOG_RE}, '\1 [\2] \3')")} AS text FROM events""", "ts, event_id"
)
_FIELD = lambda i: f"CASE WHEN regexp_matches({LINE}, {LOG_RE}) THEN regexp_extract({LINE}, {LOG_RE}, {i}) END"
LOG_FIELDS = f"SELECT event_id, {_FIELD(1)} AS line_time, {_FIELD(2)} AS level, {_FIELD(3)} AS message FROM events"

_MARK = "CASE WHEN i % 5 = 0 THEN chr(12) WHEN i % 5 = 1 THEN chr(13) || chr(13) WHEN i % 5 = 2 THEN chr(7) ELSE chr(13) END"
WORD_FILES = f"""(SELECT {path("'.doc'")} AS source_path, array_to_string(list_transform({LINES}, lambda x, i:
  CASE WHEN i % 3 = 0 THEN chr(11) ELSE '' END || x || CASE WHEN i % 4 = 0 THEN chr(19) ELSE '' END || {_MARK}), '') AS raw_text FROM documents)"""
_CLEAN = strip(r"regexp_replace(replace(t, chr(11), ' '), '[\x00-\x08\x0a\x0e-\x1f]', '', 'g')")
DOC_PARAGRAPHS = rf"""
WITH pages AS (SELECT source_path, unnest(arr) AS page_text, generate_subscripts(arr, 1) AS page FROM (SELECT source_path, string_split(raw_text, chr(12)) AS arr FROM {WORD_FILES})),
segments AS (SELECT source_path, page, unnest(arr) AS t, generate_subscripts(arr, 1) AS seg FROM (SELECT *, string_split_regex(page_text, '[\r\x07]') AS arr FROM pages)),
counted AS (SELECT source_path, page, row_number() OVER (PARTITION BY source_path ORDER BY page, seg) AS paragraph_num, {_CLEAN} AS text FROM segments)
SELECT source_path, paragraph_num, page::BIGINT AS page_num, text FROM counted WHERE length(text) > 0
"""

_WITH_BLANKS = f"flatten(list_transform({LINES}, lambda x, i: CASE WHEN i % 5 = 0 THEN [x, ' '] ELSE [x] END))"
DOCX_PARAGRAPHS = f"""
WITH paras AS (SELECT source_path, pos + 1 AS n, text FROM ({exploded(f"(SELECT *, {path(chr(39) + '.docx' + chr(39))} AS source_path FROM documents)", _WITH_BLANKS)})),
counted AS (SELECT source_path, n AS paragraph_num, 1 + sum(CASE WHEN n % 9 = 0 THEN 1 ELSE 0 END) OVER w
  + sum(CASE WHEN n % 5 = 0 THEN 1 ELSE 0 END) OVER w - CASE WHEN n % 5 = 0 THEN 1 ELSE 0 END AS page_num, {strip("text")} AS text
  FROM paras WINDOW w AS (PARTITION BY source_path ORDER BY n))
SELECT source_path, paragraph_num::BIGINT AS paragraph_num, page_num::BIGINT AS page_num, text FROM counted WHERE length(text) > 0
"""

PDF_PAGES = f"""(SELECT source_path, p + (p - 1) // 3 AS page_num, array_to_string(lines[p * 5 - 4 : p * 5], {N} || {N}) AS raw_text
  FROM (SELECT {path("'.pdf'")} AS source_path, {LINES} AS lines, unnest(range(1, ceil(len({LINES}) / 5.0)::BIGINT + 1)) AS p FROM documents))"""
PDF_PARAGRAPHS = numbered(exploded(PDF_PAGES, f"string_split_regex({strip('raw_text')}, {BLANK})", collapse("t"), keep="page_num,"), "page_num, pos", "page_num")

_VISIBLE = lambda x: rf"regexp_replace({x}, '[\x00-\x08\x0b\x0c\x0e-\x1f\x7f-\x{{9f}}]|\p{{Cf}}', '', 'g')"
MAILS = f"""(SELECT '/mail/' || conv_id || '-' || turn || '.msg' AS source_path, 'Talk ' || conv_id AS subject, {strip("coalesce(role, '')")} AS sender, 'team' AS "to",
  CASE WHEN turn % 2 = 0 THEN 'cc' || turn ELSE '' END AS cc, '' AS bcc, '2026-01-0' || (turn % 9 + 1) AS date,
  CASE WHEN turn % 3 = 0 THEN ['a.txt', 'b' || turn] ELSE []::VARCHAR[] END AS attachments,
  CASE WHEN conv_id % 10 = 0 THEN array_to_string(list_filter(list_transform(string_split(coalesce(text, ''), {N}), lambda x: {strip("x")}), lambda x: x <> ''), {N}) ELSE {strip(f"replace(replace(coalesce(text, ''), '. ', '.' || chr(8203) || chr(173) || ' '), {N}, {N} || {N})")} END AS body
  FROM conversations)"""
_HEAD = f"""concat_ws({N}, 'Subject: ' || subject, CASE WHEN sender <> '' THEN 'From: ' || sender END, 'To: ' || "to", CASE WHEN cc <> '' THEN 'Cc: ' || cc END, 'Date: ' || date,
  CASE WHEN len(attachments) > 0 THEN 'Attachments: ' || array_to_string(attachments, ', ') END)"""
MSG_PARAGRAPHS = numbered(
    exploded(MAILS, f"string_split_regex({strip(_VISIBLE(newlines(f'concat_ws({N} || {N}, {_HEAD}, nullif(body, {chr(39) * 2}))')))}, {BLANK})", collapse("t"))
)
MSG_METADATA = f"""SELECT source_path, subject AS mail_subject, sender AS mail_sender, "to" AS mail_to, cc AS mail_cc, bcc AS mail_bcc, date AS mail_date,
  array_to_string(attachments, '; ') AS mail_attachments FROM {MAILS}"""

# Elements stay open until an end tag of their name, so that a paragraph ends where fewer of them are open than at its start, or with the article.
_PLAIN = {"&quot;": chr(34), "&lt;": "<", "&gt;": ">", "&copy;": "©", "&middot;": "·"}
_UNESCAPED = "t"
for _name, _char in _PLAIN.items():
    _UNESCAPED = f"replace({_UNESCAPED}, '{_name}', '{_char}')"
_UNESCAPED = f"regexp_replace({_UNESCAPED}, '&amp;?', '&', 'g')"
HTML_PARAGRAPHS = rf"""
WITH tokens AS (SELECT page_id, unnest(arr) AS t, generate_subscripts(arr, 1) AS pos FROM (
  SELECT page_id, regexp_extract_all(html, '(?is)<!--.*?-->|<script.*?</script>|<style.*?</style>|<[^>]*>|[^<]+') AS arr FROM pages)),
marked AS (SELECT *, CASE WHEN t LIKE '<%' THEN lower(regexp_extract(t, '^</?([a-zA-Z0-9]+)', 1)) ELSE '' END AS name, t LIKE '</%' AS ending FROM tokens),
inside AS (SELECT *, max(CASE WHEN name = 'article' AND ending THEN pos END) OVER p AS stop FROM marked
  WINDOW p AS (PARTITION BY page_id) QUALIFY pos > min(CASE WHEN name = 'article' THEN pos END) OVER p AND pos <= stop),
deep AS (SELECT *, sum(CASE WHEN ending THEN -1 ELSE 1 END) OVER (PARTITION BY page_id, name ORDER BY pos) AS depth FROM inside WHERE name IN ('h1', 'p')),
blocks AS (SELECT o.page_id, o.pos, o.name, min(coalesce(c.pos, o.stop)) AS last FROM deep o LEFT JOIN deep c ON c.page_id = o.page_id AND c.name = o.name AND c.pos > o.pos AND c.depth < o.depth
  WHERE NOT o.ending GROUP BY ALL),
texts AS (SELECT page_id, pos, {strip(_UNESCAPED)} AS text FROM marked WHERE name = '' AND length({strip("t")}) > 0),
filled AS (SELECT b.page_id, b.pos, b.name, {collapse("string_agg(x.text, ' ' ORDER BY x.pos)")} AS block FROM blocks b JOIN texts x ON x.page_id = b.page_id AND x.pos > b.pos AND x.pos < b.last GROUP BY ALL),
headed AS (SELECT *, last_value(CASE WHEN name = 'h1' THEN block END IGNORE NULLS) OVER (PARTITION BY page_id ORDER BY pos) AS section FROM filled WHERE length(block) > 0),
titles AS (SELECT page_id, {collapse(_UNESCAPED)} AS title FROM (SELECT page_id, regexp_extract(html, '<title>(.*?)</title>', 1) AS t FROM pages))
SELECT '/pages/' || page_id || '.html' AS source_path, row_number() OVER (PARTITION BY page_id ORDER BY pos) AS paragraph_num, 1::BIGINT AS page_num,
  concat_ws(' ', CASE WHEN title <> '' THEN 'Title: ' || title || '.' END, CASE WHEN section <> '' THEN 'Section: ' || section || '.' END, block) AS text FROM headed JOIN titles USING (page_id)
"""
HTML_TITLES = f"""SELECT '/pages/' || page_id || '.html' AS source_path, {collapse(_UNESCAPED)} AS title FROM (SELECT page_id, regexp_extract(html, '<title>(.*?)</title>', 1) AS t FROM pages)"""

HEADING_BLOCKS = f"""(SELECT source_path, pos, text AS block_text, CASE WHEN pos % 3 = 0 THEN 1 + (doc_id + pos) % 6 END AS level,
  CASE WHEN doc_id % 2 = 0 THEN source ELSE '' END AS title FROM ({exploded(f"(SELECT *, {path(chr(39) + '.html' + chr(39))} AS source_path FROM documents)", LINES, keep="doc_id, source,")}))"""
_LAST = ", ".join(f"max(CASE WHEN level = {k} THEN pos END) OVER w AS p{k}, arg_max(block_text, CASE WHEN level = {k} THEN pos END) OVER w AS t{k}" for k in range(1, 7))
_PARTS = ", ".join(
    "CASE WHEN p{k} > {above} THEN t{k} END".format(k=k, above="greatest(-1, " + ", ".join(f"coalesce(p{j}, -1)" for j in range(1, k)) + ")" if k > 1 else "-1") for k in range(1, 7)
)
HEADING_PATH = f"""
WITH blocks AS (SELECT * FROM {HEADING_BLOCKS} WHERE length(block_text) > 0),
latest AS (SELECT *, {_LAST} FROM blocks WINDOW w AS (PARTITION BY source_path ORDER BY pos)),
pathed AS (SELECT *, concat_ws(' > ', {_PARTS}) AS heading_path FROM latest)
SELECT source_path, row_number() OVER (PARTITION BY source_path ORDER BY pos) AS paragraph_num, 1::BIGINT AS page_num,
  concat_ws(' ', CASE WHEN title <> '' THEN 'Title: ' || title || '.' END, CASE WHEN heading_path <> '' THEN 'Section: ' || heading_path || '.' END, block_text) AS text FROM pathed
"""

_PAGE = path("'.html'")
_PAGE_LINES = exploded(f"(SELECT *, {_PAGE} AS source_path FROM documents WHERE text IS NOT NULL)", LINES, keep="doc_id, source,")
_PAGE_TITLE = f"CASE WHEN doc_id % 2 = 0 THEN {collapse("coalesce(source, '')")} ELSE '' END AS title"
VARIED = f"""
WITH found AS (SELECT source_path, pos, ['h2', 'p', 'li', 'td', 'blockquote', 'figcaption'][pos % 9 + 1] AS tag, {collapse("text")} AS block_text, {_PAGE_TITLE} FROM ({_PAGE_LINES}) WHERE pos % 9 < 6),
blocks AS (SELECT source_path, row_number() OVER (PARTITION BY source_path ORDER BY pos) - 1 AS pos, tag, block_text, title FROM found WHERE length(block_text) > 0)
SELECT source_path, pos::BIGINT AS pos, tag, block_text, title FROM blocks
UNION ALL SELECT {_PAGE}, 0, NULL, NULL, {_PAGE_TITLE} FROM documents WHERE text IS NOT NULL AND {_PAGE} NOT IN (SELECT source_path FROM blocks)
"""
DOC_LINES = f"(SELECT source_path, pos + 1 AS paragraph_num, text FROM ({exploded(f'(SELECT *, {path(MD)} AS source_path FROM documents)', LINES)}))"
_SENTENCES = rf"list_filter(string_split(regexp_replace({collapse('text')}, '([.!?]) +', '\1' || chr(1), 'g'), chr(1)), lambda s: length(s) > 0)"
SENTENCES = f"SELECT source_path, paragraph_num::BIGINT AS paragraph_num, 1::BIGINT AS page_num, (generate_subscripts(arr, 1) - 1)::BIGINT AS sent_idx, unnest(arr) AS sentence FROM (SELECT *, {_SENTENCES} AS arr FROM {DOC_LINES})"


def token_windows(paragraphs: str, size: int, overlap: int, token: str = f"{WS}*[^{IN}]+|{WS}+") -> str:
    """Windows over the tokens of (source_path, paragraph_num, page_num, text)."""
    step = size - overlap
    return f"""
SELECT source_path, k::BIGINT AS chunk_index, array_to_string(list_transform(stream[k * {step} + 1 : k * {step} + {size}], lambda x: x.t), '') AS text,
  stream[k * {step} + 1].p::BIGINT AS paragraph_num, stream[k * {step} + 1].g::BIGINT AS page_num
FROM (SELECT source_path, stream, unnest(range(0, 1 + greatest(0, ceil((len(stream) - {size}) / {step}.0))::BIGINT)) AS k FROM (
  SELECT source_path, flatten(list(list_transform(tokens, lambda t: struct_pack(t := t, p := paragraph_num, g := page_num)) ORDER BY paragraph_num)) AS stream FROM (
    SELECT source_path, paragraph_num, page_num, list_append(regexp_extract_all(text, '{token}'), ' ') AS tokens FROM ({paragraphs})) GROUP BY source_path))
"""


LINE_PARAGRAPHS = f"SELECT source_path, paragraph_num, 1 AS page_num, text FROM {DOC_LINES}"
TOKEN_CHUNKS = token_windows(LINE_PARAGRAPHS, 50, 8)

SUFFIX = "CASE WHEN doc_id % 50 = 7 THEN '.txt' WHEN doc_id % 50 = 9 THEN '.MD' ELSE '.md' END"
STORED_SUFFIX = "CASE WHEN doc_id % 50 = 9 THEN '.MD' ELSE '.md' END"
SIGNATURE = "(n_chars || ':' || (1700000000 + doc_id) * 1000000000)"
LISTING = f"(SELECT {path(SUFFIX)} AS source_path, doc_id || {SUFFIX} AS source_name, '.md' AS suffix, {SIGNATURE} AS file_signature FROM documents WHERE doc_id % 10 <> 0 AND doc_id % 50 <> 7)"
COLLECTION = f"""(SELECT CASE WHEN doc_id % 100 = 15 THEN NULL WHEN doc_id % 100 = 16 THEN '' ELSE doc_id || '-' || i END AS chunk_id,
  CASE WHEN doc_id % 100 = 5 THEN NULL WHEN doc_id % 100 = 6 THEN '' ELSE {path(STORED_SUFFIX)} END AS source_path,
  CASE WHEN doc_id % 10 = 2 THEN '1:1' WHEN doc_id % 10 = 3 AND i = 0 THEN NULL WHEN doc_id % 10 = 4 AND i = doc_id % 4 THEN '2:2' ELSE {SIGNATURE} END AS file_signature,
  i::BIGINT AS chunk_index, array_to_string({LINES}[i * each + 1 : (i + 1) * each], {N}) AS text, 1::BIGINT AS paragraph_num, 1::BIGINT AS page_num, doc_id || {STORED_SUFFIX} AS source_name
  FROM (SELECT *, ceil(len({LINES}) / (doc_id % 4 + 1.0))::BIGINT AS each, unnest(range(0, doc_id % 4 + 1)) AS i FROM documents WHERE doc_id % 10 <> 1))"""
STORED = f"""(SELECT source_path, count(*) AS old_chunks, count(DISTINCT coalesce(file_signature, '?')) AS sigs, min(coalesce(file_signature, '?')) AS sig
  FROM {COLLECTION} WHERE chunk_id <> '' AND source_path <> '' GROUP BY source_path)"""
PLAN = f"""SELECT coalesce(f.source_path, s.source_path) AS source_path, CASE WHEN f.source_path IS NULL THEN 'removed' WHEN s.source_path IS NULL THEN 'new'
  WHEN s.sigs = 1 AND s.sig = f.file_signature THEN 'unchanged' ELSE 'changed' END AS action, coalesce(s.old_chunks, 0)::BIGINT AS old_chunks, f.file_signature
  FROM {LISTING} f FULL JOIN {STORED} s ON f.source_path = s.source_path"""
CHUNK_ID = "sha256(source_path || chr(1) || file_signature || chr(1) || chunk_index)"

MD_TOKEN_CHUNKS = f"""
WITH windows AS ({token_windows(MD_PARAGRAPHS, 500, 75)})
SELECT {CHUNK_ID} AS chunk_id, source_path, file_signature, chunk_index, text, paragraph_num, page_num, source_name FROM windows JOIN {LISTING} USING (source_path)
"""
APPLY = f"""
WITH plan AS ({PLAN}), before AS (SELECT * FROM {COLLECTION}),
kept AS (SELECT * FROM before WHERE coalesce(chunk_id, '') = '' OR coalesce(source_path, '') = '' OR source_path NOT IN (SELECT source_path FROM plan WHERE action IN ('removed', 'changed'))),
windows AS ({token_windows(md_paragraphs(STORED_SUFFIX), 500, 75)}),
fresh AS (SELECT {CHUNK_ID} AS chunk_id, source_path, file_signature, chunk_index, text, paragraph_num, page_num, source_name FROM windows JOIN {LISTING} USING (source_path)
  WHERE source_path IN (SELECT source_path FROM plan WHERE action IN ('new', 'changed')))
SELECT chunk_id, source_path, file_signature, chunk_index, text, paragraph_num, page_num, source_name FROM kept UNION ALL BY NAME SELECT * FROM fresh
"""
SUMMARY = f"""
SELECT (SELECT count(*) FROM {LISTING}) AS local_files, (SELECT count(*) FROM {COLLECTION} WHERE chunk_id <> '') AS remote_docs,
  count(*) FILTER (WHERE action = 'removed') AS removed_paths, count(*) FILTER (WHERE action IN ('new', 'changed')) AS added_or_updated_files,
  coalesce(sum(old_chunks) FILTER (WHERE action IN ('removed', 'changed')), 0)::BIGINT AS deleted_chunks FROM ({PLAN})
"""
SUFFIXES = [".docx", ".doc", ".pdf", ".md", ".html", ".htm", ".msg", ".log", ".txt"]
ANY_SUFFIX = f"{SUFFIXES}[doc_id % 9 + 1]"
ROUTES = """CASE suffix WHEN '.md' THEN 'markdown' WHEN '.log' THEN 'log' WHEN '.html' THEN 'html' WHEN '.htm' THEN 'html' WHEN '.pdf' THEN 'paged' WHEN '.doc' THEN 'word_text'
  WHEN '.docx' THEN 'word_paragraphs' WHEN '.msg' THEN 'messages' END"""
ROUTED = f"""SELECT *, {ROUTES} AS route FROM (SELECT {path(f"CASE WHEN doc_id % 4 = 0 THEN upper({ANY_SUFFIX}) ELSE {ANY_SUFFIX} END")} AS source_path, {ANY_SUFFIX} AS suffix FROM documents) WHERE suffix <> '.txt'"""
DISTINCT_FILES = f"""SELECT source_path, max(file_signature) AS file_signature FROM (SELECT source_path, file_signature FROM {LISTING}
  UNION ALL SELECT source_path, '9' || file_signature FROM {LISTING} WHERE split_part(file_signature, ':', 1)::BIGINT % 3 = 0) GROUP BY source_path"""
NORMALISED = f"SELECT chunk_id, source_path, chunk_index, 0::BIGINT AS n_attrs FROM {COLLECTION} WHERE chunk_id <> ''"
_KEY = "regexp_extract(source_path, '([0-9]+)[.]', 1)::BIGINT"
PASS = f"""SELECT 'log' AS kind, {_KEY} AS key, chunk_index, text, paragraph_num, page_num FROM ({token_windows(LOG_PARAGRAPHS, 500, 75)})
  UNION ALL SELECT 'htm', {_KEY}, chunk_index, text, paragraph_num, page_num FROM ({token_windows(HTML_PARAGRAPHS, 500, 75)})"""
PASS_RUNS = f"""WITH files AS (SELECT (SELECT count(DISTINCT user_id) FROM events) + (SELECT count(*) FROM pages) AS n), made AS (SELECT count(*) AS c FROM ({PASS}))
  SELECT n AS local_files, 0::BIGINT AS remote_docs, 0::BIGINT AS removed_paths, n AS added_or_updated_files, 0::BIGINT AS deleted_chunks, c AS added_chunks, 1::BIGINT AS version, NULL::VARCHAR AS error FROM files, made
  UNION ALL SELECT n, c, 0, 0, 0, 0, 1, NULL FROM files, made"""
_FILES = "SELECT DISTINCT 'log' AS kind, user_id AS key FROM events UNION ALL SELECT 'htm', page_id FROM pages"
WALKED = f"SELECT kind, key, count(*) AS n_files, count(*) AS n_signed FROM ({_FILES}) GROUP BY kind, key"
QUARANTINE = f"""SELECT kind, key, CASE key % 7 WHEN 0 THEN 'read missing' WHEN 1 THEN 'read unreadable' ELSE 'published' END AS outcome FROM ({_FILES})
  WHERE key % 7 < 2 OR (kind, key) IN (SELECT kind, key FROM ({PASS}))"""
CHANGES = f"""WITH f AS ({_FILES}) SELECT kind, key, 0::BIGINT AS listing, 'added' AS change FROM f UNION ALL SELECT kind, key, 1, 'removed' FROM f WHERE key % 3 = 0
  UNION ALL SELECT kind, key, 2, 'added' FROM f WHERE kind = 'htm' AND key % 6 = 0"""
SMALL_CHUNKS = token_windows(LINE_PARAGRAPHS, 5, 1)

_SLOT = "(('0x' || substr(md5(w), 1, 4))::BIGINT % 32)"
SEMANTIC = f"""
sents AS ({SENTENCES}),
contexts AS (SELECT *, concat_ws(' ', lag(sentence) OVER w, sentence, lead(sentence) OVER w) AS context FROM sents WINDOW w AS (PARTITION BY source_path, paragraph_num ORDER BY sent_idx)),
vectors AS (SELECT *, list_transform(range(0, 32), lambda d: len(list_filter(slots, lambda s: s = d))::DOUBLE) AS v FROM (
  SELECT *, list_transform(list_filter(string_split_regex(lower(context), '[^a-z0-9]+'), lambda w: length(w) > 0), lambda w: {_SLOT}) AS slots FROM contexts)),
pairs AS (SELECT *, lead(v) OVER (PARTITION BY source_path, paragraph_num ORDER BY sent_idx) AS u FROM vectors),
dists AS (SELECT *, CASE WHEN u IS NOT NULL THEN round(1 - CASE WHEN list_sum(v) > 0 AND list_sum(u) > 0
  THEN list_dot_product(v, u) / (sqrt(list_dot_product(v, v)) * sqrt(list_dot_product(u, u))) ELSE 0.0 END, 9) + 0.0 END AS distance FROM pairs),
cuts AS (SELECT *, coalesce(distance > round(quantile_cont(distance, 0.7) OVER (PARTITION BY source_path, paragraph_num), 9), false) AS cut FROM dists)"""
SEMANTIC_BREAKS = f"WITH {SEMANTIC} SELECT source_path, paragraph_num, sent_idx, round(distance, 6) + 0.0 AS distance, cut FROM cuts"


def repair(nodes: str) -> str:
    """Common table expressions that end in ``repaired``; ``nodes`` (source_path, node, text, paragraph_num, page_num)."""
    return f"""
pieces AS (SELECT source_path, node, min_node, unnest(arr) AS piece, generate_subscripts(arr, 1) AS i FROM (SELECT *, min(node) OVER (PARTITION BY source_path) AS min_node, {_SENTENCES} AS arr FROM {nodes})),
flagged AS (SELECT *, regexp_matches(piece, '[.!?]$')::INT AS ended FROM pieces),
spans AS (SELECT *, coalesce(sum(ended) OVER (PARTITION BY source_path ORDER BY node, i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS sentence FROM flagged),
wholes AS (SELECT source_path, sentence, string_agg(piece, ' ' ORDER BY node, i) AS text, max(node) AS end_node, max(ended) AS ended, min(min_node) AS min_node FROM spans GROUP BY source_path, sentence),
homes AS (SELECT source_path, sentence, text, CASE WHEN ended = 1 THEN end_node ELSE coalesce(max(CASE WHEN ended = 1 THEN end_node END) OVER (PARTITION BY source_path), min_node) END AS node FROM wholes),
texts AS (SELECT source_path, node, string_agg(text, ' ' ORDER BY sentence) AS text FROM homes GROUP BY source_path, node),
repaired AS (SELECT t.source_path, t.node, t.text, n.paragraph_num, n.page_num FROM texts t JOIN {nodes} n ON t.source_path = n.source_path AND t.node = n.node)"""


SEMANTIC_CHUNKS = f"""
WITH {SEMANTIC},
parts AS (SELECT *, coalesce(sum(cut::INT) OVER (PARTITION BY source_path, paragraph_num ORDER BY sent_idx ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS part FROM cuts),
nodes AS (SELECT source_path, row_number() OVER (PARTITION BY source_path ORDER BY paragraph_num, part) - 1 AS node, text, paragraph_num, 1 AS page_num FROM (
  SELECT source_path, paragraph_num, part, string_agg(sentence, ' ' ORDER BY sent_idx) AS text FROM parts GROUP BY source_path, paragraph_num, part)),
{repair("nodes")}
SELECT source_path, (row_number() OVER (PARTITION BY source_path ORDER BY node) - 1)::BIGINT AS chunk_index, text, paragraph_num::BIGINT AS paragraph_num, page_num::BIGINT AS page_num FROM repaired WHERE length(text) > 0
"""
REPAIR = f"""
WITH nodes AS (SELECT source_path, paragraph_num - 1 AS node, text, paragraph_num, 1 AS page_num FROM {DOC_LINES}), {repair("nodes")}
SELECT source_path, node::BIGINT AS node, text, paragraph_num::BIGINT AS paragraph_num, page_num::BIGINT AS page_num FROM repaired
"""


def oracle_sql() -> dict[str, str]:
    return {
        "md_paragraphs": MD_PARAGRAPHS,
        "log_paragraphs": LOG_PARAGRAPHS,
        "log_fields": LOG_FIELDS,
        "doc_paragraphs": DOC_PARAGRAPHS,
        "docx_paragraphs": DOCX_PARAGRAPHS,
        "pdf_paragraphs": PDF_PARAGRAPHS,
        "msg_paragraphs": MSG_PARAGRAPHS,
        "msg_metadata": MSG_METADATA,
        "html_paragraphs": HTML_PARAGRAPHS,
        "html_titles": HTML_TITLES,
        "html_varied_blocks": VARIED,
        "heading_path": HEADING_PATH,
        "sentences": SENTENCES,
        "token_chunks": TOKEN_CHUNKS,
        "md_token_chunks": MD_TOKEN_CHUNKS,
        "semantic_breaks": SEMANTIC_BREAKS,
        "semantic_chunks": SEMANTIC_CHUNKS,
        "repair_boundaries": REPAIR,
        "file_signatures": f"SELECT * FROM {LISTING}",
        "sync_plan": PLAN,
        "sync_plan_in_order": f"SELECT * FROM ({PLAN}) ORDER BY action <> 'removed', source_path",
        "sync_removed": f"SELECT source_path, old_chunks FROM ({PLAN}) WHERE action = 'removed'",
        "sync_new": f"SELECT source_path, file_signature FROM ({PLAN}) WHERE action = 'new'",
        "sync_changed": f"SELECT source_path, old_chunks, file_signature FROM ({PLAN}) WHERE action = 'changed'",
        "sync_apply": APPLY,
        "sync_summary": SUMMARY,
        "sync_pass": PASS,
        "sync_pass_runs": PASS_RUNS,
        "coder_chunks": token_windows(LINE_PARAGRAPHS, 50, 8, "(?s).{1,4}"),
        "model_breaks": SEMANTIC_BREAKS,
        "streamed_files": PASS,
        "folder_changes": CHANGES,
        "sync_quarantine": QUARANTINE,
        "walked_files": WALKED,
        "distinct_files": DISTINCT_FILES,
        "normalised_rows": NORMALISED,
        "routed_files": ROUTED,
        "html_chunks": token_windows(HTML_PARAGRAPHS, 60, 9),
        "log_chunks": token_windows(LOG_PARAGRAPHS, 60, 9),
        "pdf_chunks": token_windows(PDF_PARAGRAPHS, 60, 9),
        "docx_chunks": token_windows(DOCX_PARAGRAPHS, 60, 9),
        "doc_chunks": token_windows(DOC_PARAGRAPHS, 60, 9),
        "msg_chunks": token_windows(MSG_PARAGRAPHS, 60, 9),
        "ingest_batches": f"SELECT source_path, count(*) AS n_chunks, ceil(count(*) / 200.0)::BIGINT AS n_batches FROM ({SMALL_CHUNKS}) GROUP BY source_path",
        "chunk_batches": f"SELECT source_path, chunk_index // 200 + 1 AS batch, count(*) AS n_chunks, min(chunk_index) AS first_chunk FROM ({SMALL_CHUNKS}) GROUP BY 1, 2",
    }
