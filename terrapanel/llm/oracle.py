"""SQL (DuckDB) of the corpus queries that SQL can express, written from their contracts.

Without SQL: encoding (op2), fingerprints (op5) and packing (op9) need the tokenizer or hashing, the
language models (op7) are fitted, and the term counts of op8 are tested by hand-made cases.
"""

_WORDS = r"""
text_ AS (SELECT doc_id, coalesce(text, '') AS text, coalesce(source, '') AS host FROM documents),
list_ AS (SELECT doc_id, regexp_extract_all({text}, '[^\x20\x09-\x0D]+') AS ws FROM text_),
word_ AS (SELECT doc_id, unnest(ws) AS word, generate_subscripts(ws, 1) AS p FROM list_)"""


def _windows(n: int) -> str:
    return f"""
span_ AS (
  SELECT doc_id, p, string_agg(word, ' ') OVER w AS span, count(*) OVER w AS n FROM word_
  WINDOW w AS (PARTITION BY doc_id ORDER BY p ROWS BETWEEN CURRENT ROW AND {n - 1} FOLLOWING)),
window_ AS (SELECT doc_id, p, span FROM span_ WHERE n = {n})"""


_SUBSTRINGS = f"""
WITH {_WORDS.format(text="text")}, {_windows(13)},
first_ AS (SELECT span, min(doc_id) AS first FROM window_ GROUP BY span),
gone_ AS (
  SELECT DISTINCT w.doc_id, unnest(range(w.p, w.p + 13)) AS p
  FROM window_ w JOIN first_ f ON f.span = w.span WHERE f.first < w.doc_id),
kept_ AS (
  SELECT w.doc_id, count(g.p) AS n_removed, count(*) AS n_words,
         coalesce(string_agg(w.word, ' ' ORDER BY w.p) FILTER (WHERE g.p IS NULL), '') AS kept
  FROM word_ w LEFT JOIN gone_ g ON g.doc_id = w.doc_id AND g.p = w.p GROUP BY w.doc_id)
SELECT t.doc_id, coalesce(k.n_words, 0) AS n_words, coalesce(k.n_removed, 0) AS n_removed,
       sha256(coalesce(k.kept, '')) AS kept_sha256
FROM text_ t LEFT JOIN kept_ k ON k.doc_id = t.doc_id"""

_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

_NEAR = f"""
WITH RECURSIVE {_WORDS.format(text=_LOWER)}, {_windows(5)},
shingle_ AS (
  SELECT DISTINCT doc_id, span FROM window_
  UNION ALL SELECT doc_id, array_to_string(ws, ' ') FROM list_ WHERE len(ws) BETWEEN 1 AND 4),
size_ AS (SELECT doc_id, count(*) AS n FROM shingle_ GROUP BY doc_id),
both_ AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n FROM shingle_ a JOIN shingle_ b ON a.span = b.span AND a.doc_id < b.doc_id
  GROUP BY a.doc_id, b.doc_id),
link_ AS (
  SELECT a, b FROM both_ JOIN size_ x ON x.doc_id = a JOIN size_ y ON y.doc_id = b
  WHERE 100 * both_.n >= 75 * (x.n + y.n - both_.n)),
side_ AS (SELECT a, b FROM link_ UNION ALL SELECT b, a FROM link_),
reach_ AS (SELECT doc_id, doc_id AS other FROM text_ UNION SELECT r.doc_id, s.b FROM reach_ r JOIN side_ s ON s.a = r.other),
least_ AS (SELECT doc_id, min(other) AS component_id FROM reach_ GROUP BY doc_id)
SELECT l.doc_id, coalesce(s.n, 0) AS n_shingles, l.component_id, l.doc_id = l.component_id AS kept
FROM least_ l LEFT JOIN size_ s ON s.doc_id = l.doc_id"""

_QUALITY = rf"""
WITH {_WORDS.format(text="text")}, {_windows(5)},
twice_ AS (SELECT doc_id, span FROM window_ GROUP BY doc_id, span HAVING count(*) > 1),
repeat_ AS (
  SELECT doc_id, count(DISTINCT p) AS n FROM (
    SELECT w.doc_id, unnest(range(w.p, w.p + 5)) AS p FROM window_ w JOIN twice_ t ON t.doc_id = w.doc_id AND t.span = w.span)
  GROUP BY doc_id),
chars_ AS (SELECT doc_id, count(*) AS n_words, sum(length(word)) AS word_chars FROM word_ GROUP BY doc_id),
line_ AS (
  SELECT doc_id, host, line, len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS n,
         regexp_replace(trim(regexp_replace(lower(line), '\s+', ' ', 'g')), '[0-9]+', '0', 'g') AS norm
  FROM (SELECT doc_id, host, unnest(string_split(text, chr(10))) AS line FROM text_)),
full_ AS (SELECT * FROM line_ WHERE n > 0),
dup_ AS (SELECT doc_id, count(*) - count(DISTINCT line) AS n FROM full_ GROUP BY doc_id),
host_ AS (SELECT host, count(DISTINCT doc_id) AS n FROM text_ GROUP BY host),
common_ AS (
  SELECT f.host, f.norm FROM full_ f JOIN host_ h ON h.host = f.host
  GROUP BY f.host, f.norm, h.n HAVING count(DISTINCT f.doc_id) > 10 AND count(DISTINCT f.doc_id) > 0.01 * h.n),
gone_ AS (
  SELECT f.doc_id, count(DISTINCT f.norm) AS lines, sum(f.n) AS words
  FROM full_ f JOIN common_ c ON c.host = f.host AND c.norm = f.norm GROUP BY f.doc_id),
base_ AS (
  SELECT t.doc_id, coalesce(c.n_words, 0) AS n_words, coalesce(c.word_chars, 0) AS word_chars,
         len(regexp_extract_all(t.text, '[#*$%&|<>]')) AS n_symbols, coalesce(d.n, 0) AS n_dup_lines,
         coalesce(r.n, 0) AS n_repeat_words, coalesce(g.lines, 0) AS lines, coalesce(g.words, 0) AS words
  FROM text_ t LEFT JOIN chars_ c ON c.doc_id = t.doc_id LEFT JOIN dup_ d ON d.doc_id = t.doc_id
  LEFT JOIN repeat_ r ON r.doc_id = t.doc_id LEFT JOIN gone_ g ON g.doc_id = t.doc_id),
failed_ AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM base_)
SELECT doc_id, n_words, CAST(word_chars AS BIGINT) AS word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND 100 * (n_words - words) >= 50 * n_words AS kept,
       lines AS n_lines_removed, CAST(words AS BIGINT) AS n_words_removed
FROM failed_"""

_CONTROLS = ["<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "[ROLE]", "[/ROLE]"]
_STARTS = sorted({c[:k] for c in _CONTROLS for k in range(1, len(c))})
_ESCAPES = " + ".join(f"(length(text) - length(replace(text, '{c}', ''))) // {len(c)}" for c in ["\\", *_CONTROLS])
_OPEN_END = " OR ".join(f"ends_with(text, '{s}')" for s in _STARTS)

_CHAT = f"""
WITH all_ AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
turn_ AS (
  SELECT *, lag(role) OVER w AS before, row_number() OVER w AS n,
         7 + CASE role WHEN 'system' THEN 15 WHEN 'user' THEN 13 ELSE 0 END
           + length(text) + {_ESCAPES} + CASE WHEN {_OPEN_END} THEN 1 ELSE 0 END AS chars
  FROM all_ WINDOW w AS (PARTITION BY conv_id ORDER BY turn, role, text))
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY n)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY n) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(chars) AS BIGINT) AS formatted_chars,
       bool_and(coalesce(before, 'start') || ' ' || role IN
         ('start system', 'start user', 'system user', 'user assistant', 'assistant user'))
         AND arg_max(role, n) = 'assistant' AS valid
FROM turn_ GROUP BY conv_id"""

_CRC_STEP = "CASE WHEN {0} % 2 = 1 THEN xor({0} >> 1, 3988292384) ELSE {0} >> 1 END"

_CRC_TABLE = f"""
round_ AS (
  SELECT 0 AS k, i AS byte, CAST(i AS BIGINT) AS c FROM range(256) r(i)
  UNION ALL SELECT k + 1, byte, {_CRC_STEP.format("c")} FROM round_ WHERE k < 8),
table_ AS (SELECT list(c ORDER BY byte) AS t FROM round_ WHERE k = 8)"""


def _crc32(text: str) -> str:
    return f"""xor(list_reduce(list_transform(regexp_extract_all(hex(encode({text})), '..'),
             lambda h: CAST('0x' || h AS BIGINT)),
             lambda c, b: xor(t[xor(c, b) % 256 + 1], c >> 8), CAST(4294967295 AS BIGINT)), 4294967295)"""


_SHARDS = f"""
WITH RECURSIVE {_CRC_TABLE},
size_ AS (
  SELECT doc_id, CAST(coalesce(strlen(text), 0) + 1 AS BIGINT) AS size,
         {_crc32("coalesce(text, '')")} AS text_crc32
  FROM documents, table_),
sum_ AS (SELECT *, sum(size) OVER (ORDER BY doc_id) - size AS before, sum(size) OVER () AS total FROM size_),
shard_ AS (SELECT *, least(CAST((16 * (2 * before + size)) // (2 * total) AS INT), 15) AS shard FROM sum_)
SELECT doc_id, size, text_crc32, 'bytes' AS law, shard,
       row_number() OVER (PARTITION BY shard ORDER BY doc_id) - 1 AS slot, CAST(NULL AS INT) AS grown_shard
FROM shard_"""



def _field(value: str) -> str:
    return f"coalesce(CAST(strlen(CAST({value} AS VARCHAR)) AS VARCHAR) || ':' || CAST({value} AS VARCHAR), '-')"


def _leaf(text: str) -> str:
    return "sha256(" + " || ".join(map(_field, ["doc_id", "source", "lang", "n_chars", text])) + ")"


def _tree(nodes: str, start: str) -> str:
    """All levels of a forest of 16-ary trees, and the siblings of each node."""
    return f"""
{nodes}_ AS (
  {start}
  UNION ALL SELECT tree, level + 1, r // 16, (n + 15) // 16, sha256(string_agg(h, '' ORDER BY r))
  FROM {nodes}_ WHERE n > 1 GROUP BY tree, level, r // 16, n),
{nodes}_side_ AS (
  SELECT tree, level, r,
         coalesce(string_agg(h, '') OVER (PARTITION BY tree, level, r // 16 ORDER BY r ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS lefts,
         coalesce(string_agg(h, '') OVER (PARTITION BY tree, level, r // 16 ORDER BY r ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS rights
  FROM {nodes}_ WHERE n > 1)"""


def _climb(name: str, nodes: str, start: str) -> str:
    return f"""
{name}_ AS (
  {start}
  UNION ALL SELECT c.doc_id, c.source, c.leaf, c.tree, c.level + 1, c.r // 16, sha256(s.lefts || c.f || s.rights), c.proof || s.lefts || s.rights
  FROM {name}_ c JOIN {nodes}_side_ s ON s.tree IS NOT DISTINCT FROM c.tree AND s.level = c.level AND s.r = c.r),
{name}_end_ AS (
  SELECT c.*, n.h AS top FROM {name}_ c JOIN {nodes}_ n ON n.tree IS NOT DISTINCT FROM c.tree AND n.level = c.level AND n.n = 1)"""


_MANIFEST = f"""
WITH RECURSIVE {_CRC_TABLE},
leaf_ AS (
  SELECT doc_id, source, {_leaf("text")} AS leaf,
         CASE WHEN {_crc32("CAST(doc_id AS VARCHAR)")} % 5 = 0 THEN {_leaf("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} END AS other
  FROM documents, table_),
rank_ AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS r, count(*) OVER (PARTITION BY source) AS n FROM leaf_),
{_tree("node", "SELECT source AS tree, 0 AS level, r, n, leaf AS h FROM rank_")},
sub_ AS (
  SELECT tree, h, row_number() OVER (ORDER BY tree NULLS FIRST) - 1 AS r, count(*) OVER () AS n FROM node_ WHERE n = 1),
{_tree("forest", "SELECT 0 AS tree, 0 AS level, r, n, h FROM sub_")},
{_climb("low", "node", "SELECT doc_id, source, leaf, source AS tree, 0 AS level, r, coalesce(other, leaf) AS f, '' AS proof FROM rank_")},
{_climb("high", "forest", "SELECT l.doc_id, l.top AS source, l.leaf, 0 AS tree, 0 AS level, s.r, l.f, l.proof FROM low_end_ l JOIN sub_ s ON s.tree IS NOT DISTINCT FROM l.tree")}
SELECT doc_id, leaf, source AS subroot, top AS root, sha256(proof) AS proof_sha256, f AS folded_root, f = top AS verified FROM high_end_"""

_TRIE = f"""
WITH RECURSIVE {_CRC_TABLE},
turn_ AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST,
           sha256(CAST(strlen(coalesce(role, '')) AS VARCHAR) || ':' || coalesce(role, '') || coalesce(text, ''))) AS p
  FROM conversations WHERE conv_id IS NOT NULL),
conv_ AS (
  SELECT c AS conv_id, c - c % 5 AS base, {_crc32("CAST(c AS VARCHAR)")} % 9 AS h
  FROM (SELECT DISTINCT conv_id AS c FROM conversations WHERE conv_id IS NOT NULL), table_),
built_ AS (
  SELECT conv_id, role, text, row_number() OVER (PARTITION BY conv_id ORDER BY own, p) AS d FROM (
    SELECT c.conv_id, t.role, t.text, t.p, 0 AS own FROM conv_ c JOIN turn_ t ON t.conv_id = c.base AND t.p <= c.h
    UNION ALL SELECT c.conv_id, t.role, t.text, t.p, 1 FROM conv_ c JOIN turn_ t ON t.conv_id = c.conv_id AND t.p > c.h)),
length_ AS (SELECT c.conv_id, count(b.d) AS n FROM conv_ c LEFT JOIN built_ b ON b.conv_id = c.conv_id GROUP BY c.conv_id),
prefix_ AS (
  SELECT conv_id, CAST(0 AS BIGINT) AS d, '' AS key, '' AS parent, CAST(0 AS BIGINT) AS size FROM conv_
  UNION ALL
  SELECT p.conv_id, p.d + 1, sha256(p.key || sha256(b.role) || sha256(b.text)), p.key, CAST(strlen(b.text) AS BIGINT)
  FROM prefix_ p JOIN built_ b ON b.conv_id = p.conv_id AND b.d = p.d + 1),
node_ AS (SELECT key, any_value(parent) AS parent, d, any_value(size) AS size, count(*) AS n, min(conv_id) AS least FROM prefix_ GROUP BY key, d),
kid_ AS (SELECT parent, count(*) AS n FROM node_ WHERE d > 0 GROUP BY parent),
full_ AS (SELECT x.*, coalesce(k.n, 0) AS kids FROM node_ x LEFT JOIN kid_ k ON k.parent = x.key),
up_ AS (
  SELECT key AS top, key, parent, d, kids, (n - 1) * size AS saved FROM full_
  UNION ALL SELECT f.key, u.key, f.parent, f.d, u.kids, u.saved FROM up_ u JOIN full_ f ON f.key = u.parent AND u.d > 0),
sum_ AS (SELECT top, count(*) FILTER (WHERE kids = 0) AS leaves, sum(saved) AS saved FROM up_ GROUP BY top),
end_ AS (
  SELECT p.key, string_agg(CAST(p.conv_id AS VARCHAR), ',' ORDER BY p.conv_id) AS ids
  FROM prefix_ p JOIN length_ l ON l.conv_id = p.conv_id AND l.n = p.d GROUP BY p.key)
SELECT f.least AS conv_id, f.d AS depth, q.least AS parent_conv_id, f.n AS n_convs, f.kids AS n_children,
       s.leaves AS n_leaves, CAST(s.saved AS BIGINT) AS saved_tokens, sha256(coalesce(e.ids, '')) AS ends_sha256
FROM full_ f JOIN sum_ s ON s.top = f.key LEFT JOIN end_ e ON e.key = f.key LEFT JOIN node_ q ON q.key = f.parent AND f.d > 0"""

_VECTORS = """
WITH RECURSIVE vec_ AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS v FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
link_ AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM vec_ a JOIN vec_ b ON a.label = b.label AND a.vec_id <> b.vec_id
    AND len(a.v) = len(b.v) AND list_cosine_similarity(a.v, b.v) >= 0.98),
reach_ AS (SELECT vec_id, vec_id AS other FROM embeddings UNION SELECT r.vec_id, l.b FROM reach_ r JOIN link_ l ON l.a = r.other),
least_ AS (SELECT vec_id, min(other) AS component_id FROM reach_ GROUP BY vec_id),
count_ AS (SELECT a, count(*) AS n FROM link_ GROUP BY a)
SELECT l.vec_id, coalesce(c.n, 0) AS n_links, l.component_id, l.vec_id = l.component_id AS kept
FROM least_ l LEFT JOIN count_ c ON c.a = l.vec_id"""

LLM_ORACLE: dict[str, str] = {
    "op1_substring_dedup": _SUBSTRINGS,
    "op3_chat_format": _CHAT,
    "op4_near_duplicates": _NEAR,
    "op6_quality_lines": _QUALITY,
    "op10_byte_shards": _SHARDS,
    "op11_prefix_trie": _TRIE,
    "op12_embedding_near_dedup": _VECTORS,
    "op13_merkle_manifest": _MANIFEST,
}
