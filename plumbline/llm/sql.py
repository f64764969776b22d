"""DuckDB SQL for the queries that SQL can express on whole tables."""

from __future__ import annotations

from . import licenses, quality

_IN = lambda words: ", ".join(f"'{w}'" for w in dict.fromkeys(words))  # noqa: E731


def op2_sql() -> str:
    known = ", ".join(f"('{v}', '{k}')" for v, k in licenses.known_sentences())
    names = ", ".join(f"('{rule.replace('*', '')}', '{name}')" for rule, name in licenses.RULES)
    part = "trim(regexp_replace(lower(s), '[^a-z0-9]+', ' ', 'g'))"
    return f"""
WITH known(sentence, mark) AS (VALUES {known}), names(rule, name) AS (VALUES {names}),
parts AS (SELECT doc_id, unnest(regexp_split_to_array(coalesce(text, ''), '{licenses.BREAK}')) AS s, generate_subscripts(regexp_split_to_array(coalesce(text, ''), '{licenses.BREAK}'), 1) AS i FROM documents),
marked AS (SELECT doc_id, string_agg(coalesce(mark, '-'), '' ORDER BY i) AS marks FROM parts LEFT JOIN known ON {part} = sentence GROUP BY doc_id),
found AS (SELECT doc_id, marks, list_transform(regexp_extract_all(marks, '{licenses.MATCH}'), lambda m: replace(m, '-', '')) AS f FROM marked),
each AS (SELECT doc_id, unnest(f) AS rule, generate_subscripts(f, 1) AS i FROM found),
named AS (SELECT doc_id, string_agg(name, ',' ORDER BY i) AS licenses, string_agg(rule, ',' ORDER BY i) AS matched FROM each JOIN names USING (rule) GROUP BY doc_id)
SELECT doc_id, CAST(length(replace(marks, '-', '')) AS BIGINT) AS n_known, coalesce(licenses, '') AS licenses, coalesce(matched, '') AS matched
FROM found LEFT JOIN named USING (doc_id)"""


def op4_sql() -> str:
    sep = r"[\x20\x09-\x0D]"
    tests = " AND ".join(f"(n_words < {n} OR {m} {op} {limit})" for m, low, high, n in quality.THRESHOLDS for op, limit in ((">=", low), ("<=", high)) if limit is not None)
    return f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT doc_id, text, list_filter(regexp_split_to_array(text, '{sep}+'), lambda x: x <> '') AS words,
             list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS lines FROM d),
grams AS (SELECT doc_id, unnest(range(1, len(words) - 3)) AS i, words FROM w WHERE len(words) >= 5),
g AS (SELECT doc_id, i, array_to_string(words[i:i + 4], ' ') AS gram FROM grams),
many AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, gram) AS n FROM g) WHERE n > 1),
cover AS (SELECT doc_id, sum(least(5, i - coalesce(prev, -9))) AS n_repeat FROM (SELECT doc_id, i, lag(i) OVER (PARTITION BY doc_id ORDER BY i) AS prev FROM many) GROUP BY doc_id),
m AS (SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(length(regexp_replace(text, '{sep}', '', 'g')) AS BIGINT) AS word_chars,
             CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
             CAST(len(lines) AS BIGINT) AS n_lines, CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
             CAST(coalesce(n_repeat, 0) AS BIGINT) AS n_repeat_words,
             CAST(len(list_filter(words, lambda x: rtrim(lower(x), '.,;:!?') IN ({_IN(quality.STOP_WORDS)}))) AS BIGINT) AS n_stop_words,
             CAST(len(list_filter(words, lambda x, i: i > 1 AND x = words[i - 1])) AS BIGINT) AS n_same_next
      FROM w LEFT JOIN cover USING (doc_id)),
r AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
             CASE WHEN n_words > 0 THEN word_chars / n_words ELSE 0 END AS mean_word_chars, CASE WHEN n_words > 0 THEN n_symbols / n_words ELSE 0 END AS symbol_ratio,
             CASE WHEN n_words > 0 THEN n_stop_words / n_words ELSE 0 END AS stop_ratio, CASE WHEN n_words > 0 THEN n_same_next / n_words ELSE 0 END AS same_next_ratio, CASE WHEN n_lines > 0 THEN n_dup_lines / n_lines ELSE 0 END AS dup_line_ratio FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_same_next, n_stop_words, base_failed, NOT base_failed AND {tests} AS kept FROM r"""


def op5_sql() -> str:
    """Pairs within a label by plain comparison, components by a recursive walk."""
    return """
WITH RECURSIVE v AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
ok AS (SELECT vec_id, label, e FROM v WHERE label IS NOT NULL AND e IS NOT NULL AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(e, lambda x: x <> 0)) > 0),
n AS (SELECT *, sqrt(list_inner_product(e, e)) AS norm FROM ok),
links AS (SELECT a.vec_id AS a, b.vec_id AS b FROM n a JOIN n b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e) WHERE list_inner_product(a.e, b.e) / (a.norm * b.norm) >= 0.98),
reach AS (SELECT vec_id AS a, vec_id AS b FROM v UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
top AS (SELECT a AS vec_id, min(b) AS component_id FROM reach GROUP BY a),
cnt AS (SELECT a AS vec_id, count(*) AS n FROM links GROUP BY a)
SELECT v.vec_id, CAST(coalesce(cnt.n, 0) AS BIGINT) AS n_links, component_id, v.vec_id = component_id AS kept
FROM v JOIN top USING (vec_id) LEFT JOIN cnt USING (vec_id)"""


def op12_sql() -> str:
    """Every conversation's prefixes as lists of digests; sums over a subtree by the prefixes of each node's smallest member. CRC-32 bit by bit."""
    step = "list_reduce([xor(a, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda c, z: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END)"
    return f"""
WITH t AS (SELECT conv_id AS c, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS i,
                  md5(concat(length(coalesce(role, '')), ':', coalesce(role, ''), coalesce(text, ''))) AS h, CAST(strlen(coalesce(text, '')) AS BIGINT) AS b FROM conversations WHERE conv_id IS NOT NULL),
ids AS (SELECT c, CAST(xor(list_reduce(list_transform(string_split(CAST(c AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT)), lambda a, b: {step}, CAST(4294967295 AS BIGINT)), 4294967295) % 9 AS BIGINT) AS h FROM (SELECT DISTINCT c FROM t)),
turns AS (SELECT ids.c, t.i, t.h, t.b, 0 AS own FROM ids JOIN t ON t.c = ids.c - ids.c % 5 AND t.i <= ids.h UNION ALL SELECT ids.c, t.i, t.h, t.b, 1 FROM ids JOIN t ON t.c = ids.c AND t.i > ids.h),
placed AS (SELECT c, row_number() OVER w AS depth, list(h) OVER w AS hs, b FROM turns WINDOW w AS (PARTITION BY c ORDER BY own, i)),
steps AS (SELECT c, depth, md5(array_to_string(hs, '')) AS node, CASE WHEN depth > 1 THEN md5(array_to_string(hs[1:depth - 1], '')) ELSE '' END AS up, b FROM placed UNION ALL SELECT c, 0, '', NULL, 0 FROM ids),
nodes AS (SELECT node, depth, any_value(up) AS up, min(c) AS conv_id, count(*) AS n, max(b) AS b FROM steps GROUP BY node, depth),
kids AS (SELECT up, depth - 1 AS depth, count(*) AS n_children FROM nodes WHERE up IS NOT NULL GROUP BY up, depth),
whole AS (SELECT nodes.*, coalesce(n_children, 0) AS n_children FROM nodes LEFT JOIN kids ON kids.up = nodes.node AND kids.depth = nodes.depth),
sums AS (SELECT s.node, s.depth, count(*) FILTER (WHERE w.n_children = 0) AS n_leaves, sum((w.n - 1) * w.b) AS saved FROM whole w JOIN steps s ON s.c = w.conv_id AND s.depth <= w.depth GROUP BY s.node, s.depth),
last AS (SELECT c, max(depth) AS depth, arg_max(node, depth) AS node FROM steps GROUP BY c),
ends AS (SELECT node, depth, sha256(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c)) AS digest FROM last GROUP BY node, depth)
SELECT w.conv_id, CAST(w.depth AS BIGINT) AS depth, p.conv_id AS parent_conv_id, CAST(w.n AS BIGINT) AS n_convs, CAST(w.n_children AS BIGINT) AS n_children, CAST(s.n_leaves AS BIGINT) AS n_leaves,
       CAST(s.saved AS BIGINT) AS saved_tokens, coalesce(e.digest, sha256('')) AS ends_sha256
FROM whole w JOIN sums s ON s.node = w.node AND s.depth = w.depth LEFT JOIN nodes p ON p.node = w.up AND p.depth = w.depth - 1 LEFT JOIN ends e ON e.node = w.node AND e.depth = w.depth"""


def op13_sql() -> str:
    hashed = ", ".join(f"CAST('0x' || substr(h, {8 * k + 1}, 8) AS BIGINT) AS h{k + 1}" for k in range(4))
    return rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, sha256('42:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
t AS (SELECT doc_id, text, regexp_extract_all(text, '[ 	-]*[^ 	-]+|[ 	-]+') AS u, {hashed} FROM d),
n AS (SELECT *, CAST(len(u) AS BIGINT) AS n, least(h1 % (len(u) + 1), h2 % (len(u) + 1)) AS a, greatest(h1 % (len(u) + 1), h2 % (len(u) + 1)) AS b FROM t),
f AS (SELECT doc_id, text, n, CASE WHEN text = '' OR regexp_matches(text, '<[PSM]>') OR h3 % 100 >= 50 THEN 'plain' WHEN h4 % 100 < 80 THEN 'spm' ELSE 'psm' END AS form,
             coalesce(array_to_string(u[1:a], ''), '') AS prefix, coalesce(array_to_string(u[a + 1:b], ''), '') AS middle, coalesce(array_to_string(u[b + 1:n], ''), '') AS suffix FROM n)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN CAST(length(prefix) AS BIGINT) END AS prefix_chars, CASE WHEN form <> 'plain' THEN CAST(length(middle) AS BIGINT) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
       sha256(CASE form WHEN 'plain' THEN text ELSE prefix || middle || suffix END) AS restored_sha256
FROM f"""


ORACLES = {"op2_licenses": op2_sql(), "op4_quality": op4_sql(), "op5_embeddings": op5_sql(), "op12_prefix_trie": op12_sql(), "op13_fim": op13_sql()}
