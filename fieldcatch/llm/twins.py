"""SQL for DuckDB that registered queries must agree with."""

from __future__ import annotations

from fieldcatch.llm.license_index import TEMPLATES
from fieldcatch.llm.secret_index import RULES


def _quoted(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _secrets() -> str:
    parts = []
    for rank, rule in enumerate(RULES):
        pattern = _quoted(rule.pattern)
        parts.append(f"""
SELECT rid, {rank} AS rank, '{rule.kind}' AS kind, {str(rule.base).lower()} AS base, s AS start, s + hit_len AS stop
FROM (
  SELECT rid, val_len, hit_len, i,
    sum(gap_len) OVER w + coalesce(sum(hit_len) OVER (PARTITION BY rid ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS s
  FROM (
    SELECT rid, unnest(range(1, len(hits) + 1)) AS i,
      unnest([length(x) FOR x IN gaps[1:len(hits)]]) AS gap_len,
      unnest([length(x) FOR x IN hits]) AS hit_len, unnest([length(x) FOR x IN vals]) AS val_len
    FROM (
      SELECT rid, regexp_split_to_array(text, {pattern}) AS gaps,
        regexp_extract_all(text, {pattern}) AS hits, regexp_extract_all(text, {pattern}, {rule.group}) AS vals
      FROM d WHERE regexp_matches(text, {pattern})
    )
  )
  WINDOW w AS (PARTITION BY rid ORDER BY i)
) WHERE val_len >= {rule.least}""")
    return f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text FROM documents),
spans AS ({' UNION ALL '.join(parts)}),
joined AS (
  SELECT rid,
    count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access,
    count(*) FILTER (kind = 'hex') AS n_hex,
    string_agg(concat_ws(':', kind, start::BIGINT, stop::BIGINT), ',' ORDER BY start, rank) FILTER (base) AS base_list,
    string_agg(concat_ws(':', kind, start::BIGINT, stop::BIGINT), ',' ORDER BY start, rank) AS all_list
  FROM spans GROUP BY rid
)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
  sha256(coalesce(base_list, '')) AS base_sha256, coalesce(all_list, '') AS spans
FROM d LEFT JOIN joined USING (rid)"""


def _licenses() -> str:
    parts = []
    for t in TEMPLATES:
        first, end = t.span
        key = " AND ".join(f"words[o + {i + 1}] = {_quoted(t.words[i])}" for i in range(first, end))
        hits = " + ".join(
            f"coalesce((words[CASE WHEN o + {i + 1} > 0 THEN o + {i + 1} END] = {_quoted(w)})::INT, 0)"
            for i, w in enumerate(t.words)
        )
        parts.append(f"""
SELECT rid, {_quoted(t.label)} AS label, {str(t.base).lower()} AS base, o + {first} AS spot, ({hits}) / {float(len(t.words))} AS share
FROM (SELECT rid, words, unnest(range(-{first}, len(words) - {end - 1})) AS o FROM d
      WHERE list_contains(words, {_quoted(t.words[first])}))
WHERE {key}""")
    return f"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS words
  FROM documents
),
found AS ({' UNION ALL '.join(parts)}),
joined AS (
  SELECT rid, count(*) FILTER (base) AS n_base, min(spot) FILTER (base) AS first_word, max(spot) FILTER (base) AS last_word,
    string_agg(DISTINCT label, ',' ORDER BY label) FILTER (base) AS base_labels,
    string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(share) AS score
  FROM found GROUP BY rid
)
SELECT doc_id, len(words) AS n_words, coalesce(n_base, 0) AS n_base, first_word::BIGINT AS first_word,
  last_word::BIGINT AS last_word, coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
  coalesce(score, 0)::DOUBLE AS score
FROM d LEFT JOIN joined USING (rid)"""


#: Each run of eight words beside its place; runs that occur twice cover their words.
QUALITY = r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text FROM documents),
w AS (
  SELECT rid, doc_id, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words,
    regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g') AS solid,
    [x FOR x IN string_split(text, chr(10)) IF regexp_matches(x, '[^\x20\x09-\x0D]')] AS lines
  FROM d
),
runs AS (
  SELECT rid, i, array_to_string(words[i:i + 7], ' ') AS run
  FROM (SELECT rid, words, unnest(range(1, len(words) - 6)) AS i FROM w)
),
twice AS (SELECT rid, i FROM runs QUALIFY count(*) OVER (PARTITION BY rid, run) > 1),
covered AS (
  SELECT rid, sum(least(8, coalesce(step, 8))) AS n
  FROM (SELECT rid, i - lag(i) OVER (PARTITION BY rid ORDER BY i) AS step FROM twice) GROUP BY rid
),
m AS (
  SELECT rid, doc_id, len(words)::BIGINT AS n_words, length(solid)::BIGINT AS word_chars,
    length(regexp_replace(solid, '[^#*$%&|<>]+', '', 'g'))::BIGINT AS n_symbols,
    (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
    coalesce(n, 0)::BIGINT AS n_repeat_words,
    length(regexp_replace(solid, '[^0-9]+', '', 'g')) AS digits,
    length(regexp_replace(solid, '[^A-Z]+', '', 'g')) AS capitals,
    len([i FOR i IN range(1, len(words)) IF words[i] = words[i + 1]]) AS stutter
  FROM w LEFT JOIN covered USING (rid)
),
b AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT (base_failed OR n_symbols * 4 > n_words OR n_dup_lines * 10 > n_words OR word_chars < n_words * 2
       OR word_chars > n_words * 20 OR digits * 2 > word_chars OR capitals * 2 > word_chars
       OR stutter * 3 > n_words) AS kept
FROM b"""

TOP_K = """
WITH v AS (
  SELECT DISTINCT vec_id, [floor(256 * x::DOUBLE) FOR x IN embedding] AS vec FROM embeddings
  WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.vec, c.vec)::BIGINT AS score
  FROM v AS q JOIN v AS c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id AND len(q.vec) = len(c.vec)
)
SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank, vec_id, score
FROM scored QUALIFY rank <= 5"""

#: The table of crc32, made from its rule.
_CRC_TABLE = """crc AS (
  SELECT list(v ORDER BY i) AS t FROM (
    SELECT i, list_reduce(list_concat([i], range(8)), lambda c, k: xor(c >> 1, (c & 1) * 3988292384)) AS v
    FROM range(256) AS r(i)
  )
)"""


def _crc32(codes: str) -> str:
    """SQL for the crc32 of a list of byte values, with the table `crc` at hand."""
    return (f"xor(list_reduce(list_concat([4294967295], {codes}), "
            "lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295)")


#: Letters of the runs take one byte, or two that begin with 195.
_BYTES = "flatten([CASE WHEN ord(c) < 128 THEN [ord(c)] ELSE [195, ord(c) - 64] END FOR c IN string_split({text}, '')])"

VARIANTS = f"""
WITH RECURSIVE {_CRC_TABLE},
runs AS (
  SELECT coalesce(doc_id::VARCHAR, '') || ':' AS owner, run, count(*) AS k FROM (
    SELECT doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run FROM documents
  ) WHERE length(run) >= 6 GROUP BY ALL
),
hashed AS (SELECT run, k, {_crc32(_BYTES.format(text="owner || run"))} AS h FROM runs, crc),
v AS (
  SELECT word, sum(k)::BIGINT AS n FROM (
    SELECT k, CASE WHEN h % 199 = 0 THEN run[:h % length(run)] || run[h % length(run) + 2:] ELSE run END AS word FROM hashed
  ) WHERE length(word) >= 6 GROUP BY word HAVING sum(k) >= 5
),
cut AS (SELECT word, i, word[:i - 1] || word[i + 1:] AS rest FROM (SELECT word, unnest(range(1, length(word) + 1)) AS i FROM v)),
pairs AS (
  SELECT a.word, b.word AS near FROM cut AS a JOIN cut AS b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
  UNION SELECT word, rest FROM cut WHERE rest IN (SELECT word FROM v)
  UNION SELECT rest, word FROM cut WHERE rest IN (SELECT word FROM v)
),
best AS (
  SELECT word, count(*) AS n_near, first(near ORDER BY n DESC, near) AS near, max(n) AS near_n
  FROM (SELECT pairs.word, near, n FROM pairs JOIN v ON v.word = near) GROUP BY word
),
formed AS (
  SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN near_n >= 5 * n THEN near END AS form,
    CASE WHEN near_n >= 5 * n THEN near_n END AS form_n
  FROM v LEFT JOIN best USING (word)
),
walk AS (
  SELECT word, word AS root FROM formed
  UNION ALL SELECT walk.word, formed.form FROM walk JOIN formed ON formed.word = walk.root WHERE formed.form IS NOT NULL
)
SELECT formed.word, form, walk.root, n, n_near, form_n
FROM formed JOIN walk ON walk.word = formed.word
WHERE walk.root IN (SELECT word FROM formed WHERE form IS NULL)"""


def _record(text: str) -> str:
    values = ["doc_id", "source", "lang", "n_chars", text]
    return "sha256(" + " || ".join(f"coalesce(strlen({v}::VARCHAR) || ':' || {v}::VARCHAR, '-')" for v in values) + ")"


#: Trees level by level; `c` is the number of nodes of a level. Tree 0 stands on the subroots.
MANIFEST = f"""
WITH RECURSIVE {_CRC_TABLE},
d AS (
  SELECT row_number() OVER () AS rid, doc_id, source, {_record('text')} AS leaf,
    CASE WHEN {_crc32("[ord(c) FOR c IN string_split(doc_id::VARCHAR, '')]")} % 2 = 0
      THEN {_record("replace(text, chr(10), '')")} ELSE {_record('text')} END AS shown
  FROM documents, crc
),
ranked AS (SELECT source, row_number() OVER (ORDER BY source IS NOT NULL, source) AS tree FROM (SELECT DISTINCT source FROM d)),
placed AS (
  SELECT d.*, tree, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS LAST, leaf, shown) - 1 AS i,
    count(*) OVER (PARTITION BY tree) AS c
  FROM d JOIN ranked ON d.source IS NOT DISTINCT FROM ranked.source
),
low AS (
  SELECT tree, 0 AS l, i, c, leaf AS h FROM placed
  UNION ALL SELECT tree, l + 1, i // 3, (c + 2) // 3, sha256(string_agg(h, '' ORDER BY i))
  FROM low WHERE c > 1 GROUP BY tree, l, i // 3, c
),
high AS (
  SELECT 0 AS tree, 0 AS l, tree - 1 AS i, count(*) OVER () AS c, h FROM low WHERE c = 1
  UNION ALL SELECT tree, l + 1, i // 3, (c + 2) // 3, sha256(string_agg(h, '' ORDER BY i))
  FROM high WHERE c > 1 GROUP BY tree, l, i // 3, c
),
nodes AS (SELECT * FROM low UNION ALL SELECT * FROM high),
steps AS (
  SELECT a.tree, a.l, a.i, coalesce(string_agg(b.h, '' ORDER BY b.i) FILTER (b.i < a.i), '') AS before,
    coalesce(string_agg(b.h, '' ORDER BY b.i) FILTER (b.i > a.i), '') AS behind,
    CASE WHEN a.tree > 0 AND a.c <= 3 THEN 0 ELSE a.tree END AS up_tree,
    CASE WHEN a.tree > 0 AND a.c <= 3 THEN 0 ELSE a.l + 1 END AS up_l,
    CASE WHEN a.tree > 0 AND a.c <= 3 THEN a.tree - 1 ELSE a.i // 3 END AS up_i
  FROM nodes AS a JOIN nodes AS b ON a.tree = b.tree AND a.l = b.l AND a.i // 3 = b.i // 3
  WHERE a.c > 1 GROUP BY a.tree, a.l, a.i, a.c
),
walk AS (
  SELECT rid, CASE WHEN c = 1 THEN 0 ELSE tree END AS tree, 0 AS l, CASE WHEN c = 1 THEN tree - 1 ELSE i END AS i,
    shown AS h, '' AS proof FROM placed
  UNION ALL SELECT rid, up_tree, up_l, up_i, sha256(before || h || behind), proof || before || behind
  FROM walk JOIN steps USING (tree, l, i)
),
ends AS (SELECT rid, h AS folded_root, sha256(proof) AS proof_sha256 FROM walk WHERE tree = 0 AND l = (SELECT l FROM high WHERE c = 1))
SELECT doc_id, leaf, subroots.h AS subroot, top.h AS root, proof_sha256, folded_root, folded_root = top.h AS verified
FROM placed JOIN (SELECT tree, h FROM low WHERE c = 1) AS subroots USING (tree) JOIN ends USING (rid),
  (SELECT h FROM high WHERE c = 1) AS top"""

#: The exact join. The index may miss links near the threshold; on tables where it finds all, both agree.
NEAR_VECTORS = """
WITH RECURSIVE v AS (
  SELECT row_number() OVER () AS rid, vec_id, [x::DOUBLE FOR x IN embedding] AS vec,
    vec_id IS NOT NULL AND coalesce(len(embedding), 0) > 0 AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
      AND len([x FOR x IN embedding IF x <> 0]) > 0 AS sound
  FROM embeddings
),
s AS (SELECT rid, vec_id, vec, sqrt(list_inner_product(vec, vec)) AS size FROM v WHERE sound),
links AS (
  SELECT a.rid, b.rid AS other FROM s AS a JOIN s AS b
  ON a.rid <> b.rid AND len(a.vec) = len(b.vec) AND list_inner_product(a.vec, b.vec) / (a.size * b.size) >= 0.95
),
reach AS (SELECT rid, rid AS at FROM v UNION SELECT reach.rid, links.other FROM reach JOIN links ON links.rid = reach.at),
ends AS (SELECT reach.rid, min(vec_id) AS component_id FROM reach JOIN v ON v.rid = reach.at GROUP BY reach.rid)
SELECT vec_id, (SELECT count(*) FROM links WHERE links.rid = v.rid) AS n_links, component_id,
  vec_id IS NOT DISTINCT FROM component_id AS kept
FROM v JOIN ends USING (rid)"""

SECRETS = _secrets()
LICENSES = _licenses()
