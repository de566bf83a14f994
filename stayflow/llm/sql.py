"""Results of the corpus queries stated in DuckDB's SQL, where SQL of a usable speed can state them."""

from __future__ import annotations


def crc32(text: str) -> str:
    """Unsigned CRC-32 of the UTF-8 bytes of a text expression, bit by bit."""
    bit = "xor(s >> 1, 3988292384 * (s & 1))"
    byte = f"list_reduce([xor(c, b)] || [0, 0, 0, 0, 0, 0, 0, 0], lambda s, _: {bit})"
    digits = f"hex(encode({text}))"
    values = f"list_transform(range(1, 1 + length({digits}), 2), lambda i: CAST('0x' || substr({digits}, i, 2) AS BIGINT))"
    return f"xor(list_reduce([4294967295] || {values}, lambda c, b: {byte}), 4294967295)"


# op6: all pairs of vectors, and the smallest id that links lead to
EMBEDDINGS = """WITH RECURSIVE parts AS (
  SELECT vec_id, unnest(embedding)::DOUBLE AS x FROM embeddings),
good AS (
  SELECT vec_id FROM embeddings WHERE embedding IS NOT NULL AND vec_id NOT IN (SELECT vec_id FROM parts WHERE x IS NULL OR NOT isfinite(x))),
vectors AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings SEMI JOIN good USING (vec_id) WHERE list_max(list_transform(embedding, lambda x: abs(x))) > 0),
links AS (
  SELECT a.vec_id AS u, b.vec_id AS w FROM vectors a JOIN vectors b ON a.vec_id <> b.vec_id AND list_cosine_similarity(a.v, b.v) >= 0.95),
reach AS (
  SELECT vec_id AS x, vec_id AS root FROM embeddings UNION SELECT l.u, r.root FROM reach r JOIN links l ON l.w = r.x),
roots AS (SELECT x, min(root) AS root FROM reach GROUP BY x),
degrees AS (SELECT u, count(*) AS n FROM links GROUP BY u)
SELECT vec_id, coalesce(n, 0) AS n_links, root AS component_id, vec_id = root AS kept
FROM embeddings JOIN roots ON x = vec_id LEFT JOIN degrees ON u = vec_id"""

# op11: words one edit apart share what is left when the same letter goes
VARIANTS = f"""WITH RECURSIVE runs AS (
  SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS owner,
    unnest(regexp_extract_all(text, '[A-Za-z\\x{{00C0}}-\\x{{00FF}}]+')) AS run FROM documents),
lower_runs AS (
  SELECT owner, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run FROM runs WHERE length(run) >= 7),
coded AS (SELECT owner, run, count(*) AS n, {crc32("owner || ':' || run")} AS h FROM lower_runs GROUP BY owner, run),
cut AS (
  SELECT CASE WHEN h % 31 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, n FROM coded),
words AS (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM cut WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2),
shorter AS (
  SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest FROM (SELECT *, unnest(range(1, length(word) + 1)) AS i FROM words)),
near AS (
  SELECT a.word, b.word AS other, b.n FROM shorter a JOIN shorter b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
  UNION SELECT s.word, w.word, w.n FROM shorter s JOIN words w ON w.word = s.rest
  UNION SELECT w.word, s.word, s.n FROM shorter s JOIN words w ON w.word = s.rest),
best AS (SELECT word, count(*) AS n_near, max(n) AS top FROM near GROUP BY word),
forms AS (
  SELECT w.word, w.n, coalesce(b.n_near, 0) AS n_near, CASE WHEN b.top >= 10 * w.n THEN b.top END AS form_n,
    CASE WHEN b.top >= 10 * w.n THEN (SELECT min(x.other) FROM near x WHERE x.word = w.word AND x.n = b.top) END AS form
  FROM words w LEFT JOIN best b ON b.word = w.word),
steps AS (
  SELECT word, word AS at, form AS ahead FROM forms
  UNION ALL SELECT s.word, f.word, f.form FROM steps s JOIN forms f ON f.word = s.ahead)
SELECT f.word, f.form, s.at AS root, f.n, f.n_near, f.form_n FROM forms f JOIN steps s ON s.word = f.word AND s.ahead IS NULL"""


def _escaped(text: str) -> str:
    """A backslash behind the first character of what reads as a mark, also where backslashes stand there."""
    angles = rf"regexp_replace({text}, '<(\\*/?s>)', '<\\\1', 'g')"
    return rf"regexp_replace({angles}, '\[(\\*/?INST\])', '[\\\1', 'g')"


# op12: roles and texts in order; 17 characters of marks around each turn and 3 in front
CHAT = f"""WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]')),
learned AS (SELECT *, CASE WHEN role = 'assistant' THEN text ELSE '' END AS loss FROM turns)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  CAST(sum(length(loss)) AS BIGINT) AS loss_chars, sha256(string_agg(loss, '' ORDER BY turn NULLS FIRST, role, text)) AS loss_sha256,
  CAST(3 + sum(17 + length({_escaped("role")}) + length({_escaped("text")})) AS BIGINT) AS formatted_chars
FROM learned GROUP BY conv_id"""

# op13: prefixes as lists; a node's subtree is what lists it among its own prefixes
TRIE = f"""WITH turns AS (
  SELECT conv_id, list({{'role': coalesce(role, ''), 'text': coalesce(text, '')}} ORDER BY turn NULLS FIRST) AS own
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
coded AS (SELECT conv_id, own, {crc32("CAST(conv_id AS VARCHAR)")} % 6 AS h FROM turns),
rebuilt AS (
  SELECT c.conv_id, coalesce(b.own[1 : c.h], []) || c.own[c.h + 1 :] AS turns
  FROM coded c LEFT JOIN turns b ON b.conv_id = c.conv_id - (c.conv_id % 100 + 100) % 100),
prefixes AS (
  SELECT conv_id, d AS depth, turns[1 : d] AS prefix, CASE WHEN d > 0 THEN length(turns[d].text) ELSE 0 END AS n_chars, d = len(turns) AS ends
  FROM (SELECT *, unnest(range(0, len(turns) + 1)) AS d FROM rebuilt)),
named AS (SELECT *, min(conv_id) OVER (PARTITION BY depth, prefix) AS node FROM prefixes),
nodes AS (
  SELECT node, depth, count(*) AS n_convs, any_value(n_chars) AS n_chars,
    sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (ends), '')) AS ends_sha256
  FROM named GROUP BY node, depth),
placed AS (
  SELECT n.*, p.node AS parent FROM nodes n LEFT JOIN named p ON p.conv_id = n.node AND p.depth = n.depth - 1),
counted AS (
  SELECT n.*, (SELECT count(*) FROM placed c WHERE c.parent = n.node AND c.depth = n.depth + 1) AS n_children FROM placed n),
totals AS (
  SELECT a.node, a.depth, count(*) FILTER (c.n_children = 0) AS n_leaves, sum((c.n_convs - 1) * c.n_chars) AS saved
  FROM counted c JOIN named a ON a.conv_id = c.node AND a.depth <= c.depth GROUP BY a.node, a.depth)
SELECT c.node AS conv_id, c.depth, c.parent AS parent_conv_id, c.n_convs, c.n_children, t.n_leaves, CAST(t.saved AS BIGINT) AS saved_tokens, c.ends_sha256
FROM counted c JOIN totals t ON t.node = c.node AND t.depth = c.depth"""

SQL = {
    "op6_embeddings": EMBEDDINGS,
    "op11_spelling_variants": VARIANTS,
    "op12_chat_format": CHAT,
    "op13_prefix_trie": TRIE,
}
