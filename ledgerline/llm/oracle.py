"""SQL counterparts of the queries that SQL can express."""

from __future__ import annotations

from .licenses import EQUIVALENT, KNOWN

WORDS = "[x FOR x IN regexp_split_to_array(coalesce({0}, ''), '[\\x20\\x09-\\x0D]+') IF x <> '']"
BREAK = r"[^\x20\x09-\x0D]"

RULES = f"""
WITH docs AS (
    SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS text, {WORDS.format("text")} AS w FROM documents
), lines AS (
    SELECT r, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines
    FROM (SELECT r, unnest(string_split(text, chr(10))) AS line FROM docs) WHERE regexp_matches(line, '{BREAK}') GROUP BY r
), windows AS (
    SELECT r, i, array_to_string(w[i : i + 4], ' ') AS g FROM (SELECT r, w, unnest(range(1, len(w) - 3)) AS i FROM docs)
), twice AS (
    SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS n FROM windows) WHERE n > 1
), repeated AS (
    SELECT r, count(DISTINCT i + k) AS n_repeat_words FROM twice, range(5) t(k) GROUP BY r
), measured AS (
    SELECT doc_id, source, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
        CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
        coalesce(n_lines, 0) AS n_lines, coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words,
        len(w) < 10 OR 100 * coalesce(n_repeat_words, 0) > 20 * len(w) AS base_failed
    FROM docs LEFT JOIN lines USING (r) LEFT JOIN repeated USING (r)
), judged AS (
    SELECT *, base_failed OR 10 * n_symbols > n_words OR 10 * n_dup_lines > 3 * n_lines OR word_chars < 2 * n_words AS rule_failed FROM measured
), hosts AS (
    SELECT source, CAST(count(*) AS DOUBLE) AS n, CAST(count(*) FILTER (rule_failed) AS DOUBLE) AS f
    FROM judged WHERE source IS NOT NULL GROUP BY source
), others AS (  -- what each host is held against
    SELECT source, n, f, sum(n) OVER () - n AS o, sum(f) OVER () - f AS of, sum(f * f / n) OVER () - f * f / n AS oq, count(*) OVER () - 1 AS oh FROM hosts
), means AS (
    SELECT *, (of + 0.5) / (o + 1) AS m FROM others WHERE o > 0
), spread AS (
    SELECT *, m * (1 - m) AS c, oq / o - m * m - m * (1 - m) * oh / o AS between_ FROM means
), prior AS (
    SELECT *, CASE WHEN between_ > 0 THEN least(greatest(c / between_ - 1, 1.0), 100.0) ELSE 100.0 END AS k FROM spread
), verdicts AS (
    SELECT source, (f + m * k) / (n + k) > greatest(m + 3 * sqrt(c / (k + 1)), 0.2) AS host_failed FROM prior
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    NOT base_failed AND NOT coalesce(host_failed, false) AS kept, n_lines, rule_failed
FROM judged LEFT JOIN verdicts USING (source)
"""

MIXING = f"""
WITH docs AS (
    SELECT doc_id, source, CAST(len({WORDS.format("text")}) AS BIGINT) AS size,
        CAST('0x' || md5(coalesce(CAST(doc_id AS VARCHAR), ''))[1:15] AS BIGINT) AS h FROM documents
), sources AS (
    SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
        [5, 2, 1][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS weight FROM docs GROUP BY source
), ordered AS (  -- sources reach their limit in this order
    SELECT *, 3 * source_size AS lim, coalesce(sum(3 * source_size) OVER before, 0) AS fixed, sum(weight) OVER upwards AS open
    FROM sources
    WINDOW before AS (ORDER BY 3.0 * source_size / weight, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
        upwards AS (ORDER BY 3.0 * source_size / weight, source ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)
), shared AS (
    SELECT max(((SELECT sum(source_size) FROM sources) - fixed) / open) AS share FROM ordered
), aims AS (
    SELECT source, source_size, least(share * weight, CAST(lim AS DOUBLE)) AS target FROM ordered, shared
), plans AS (
    SELECT *, CASE WHEN source_size > 0 THEN least(CAST(floor(target / source_size) AS BIGINT), 3) ELSE 0 END AS times FROM aims
), run AS (
    SELECT d.source, d.h, sum(d.size) AS here FROM docs d WHERE size > 0 GROUP BY d.source, d.h
), upto AS (
    SELECT source, h, here, sum(here) OVER (PARTITION BY source ORDER BY h) AS u FROM run
), edge AS (
    SELECT p.source, min_by(u.h, u.h) AS h, min_by(u.u, u.h) AS u, min_by(u.here, u.h) AS here, any_value(p.target - p.times * p.source_size) AS budget
    FROM plans p JOIN upto u ON u.source IS NOT DISTINCT FROM p.source WHERE u.u > p.target - p.times * p.source_size GROUP BY p.source
), marks AS (
    SELECT source, h + CASE WHEN u - budget < budget - (u - here) THEN 1 ELSE 0 END AS threshold FROM edge
)
SELECT doc_id, size, source_size, target, CAST(size * (times + CASE WHEN h < coalesce(threshold, 0) THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM docs d JOIN plans p ON d.source IS NOT DISTINCT FROM p.source LEFT JOIN marks m ON m.source IS NOT DISTINCT FROM p.source
"""


def _quoted(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _canonical(text: str) -> str:
    out = rf"regexp_replace(lower({text}), '(?m)^[^a-z0-9\n]*(copyright|copr|\(c\)|©)[^\n]{{0,12}}[0-9]{{4}}[^\n]*$', '', 'g')"
    out = rf"' ' || regexp_replace({out}, '[\s\x{{a0}}]+', ' ', 'g') || ' '"
    for given, one in EQUIVALENT:
        out = f"replace({out}, {_quoted(given)}, {_quoted(one)})"
    return rf"regexp_replace({out}, '[^\p{{L}}\p{{N}}]+', '', 'g')"


def _digest(text: str) -> str:
    return f"CASE WHEN {_canonical(text)} <> '' THEN md5({_canonical(text)}) END"


LICENSES = f"""
WITH given(license_id, text) AS (VALUES {", ".join(f"({_quoted(i)}, {_quoted(t)})" for i, t in KNOWN)}
), known AS (
    SELECT {_digest("text")} AS digest, min(license_id) AS license_id FROM given GROUP BY 1
), docs AS (
    SELECT row_number() OVER () AS r, doc_id, text, {_digest("text")} AS digest FROM documents
), lines AS (
    SELECT DISTINCT r, license_id FROM (SELECT r, unnest(string_split(text, chr(10))) AS line FROM docs) l JOIN known k ON k.digest = {_digest("line")}
), notices AS (
    SELECT r, string_agg(license_id, ',' ORDER BY license_id) AS notices FROM lines GROUP BY r
)
SELECT doc_id, docs.digest, license_id, notices FROM docs LEFT JOIN known USING (digest) LEFT JOIN notices USING (r)
"""

#: Unsigned CRC-32 of a text, bit by bit.
CRC32 = """xor(list_reduce([ascii(x) FOR x IN string_split({0}, '')], lambda c, b: list_reduce(list_prepend(xor(c, b), range(8)),
    lambda y, i: xor(y >> 1, (y & 1) * 3988292384)), 4294967295), 4294967295)"""


def _framed(*values: str) -> str:
    texts = [f"CAST({v} AS VARCHAR)" for v in values]
    return " || ".join(f"coalesce(CAST(strlen({t}) AS VARCHAR) || ':' || {t}, '-')" for t in texts)


MANIFEST = f"""
WITH RECURSIVE docs AS MATERIALIZED (
    SELECT row_number() OVER () AS r, doc_id, coalesce('=' || lang, '-') AS tree,
        sha256({_framed("doc_id", "source", "lang", "n_chars", "text")}) AS leaf,
        sha256({_framed("doc_id", "source", "lang", f"CASE WHEN {CRC32.format('CAST(doc_id AS VARCHAR)')} % 7 = 0 THEN n_chars + 1 ELSE n_chars END", "text")}) AS shown
    FROM documents
), leaves AS MATERIALIZED (
    SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf, r) - 1 AS pos, count(*) OVER (PARTITION BY tree) AS n FROM docs
), up AS (  -- every level of every tree
    SELECT 0 AS level, tree, pos, n, leaf AS node FROM leaves
    UNION ALL
    SELECT level + 1, tree, pos // 2, (n + 1) // 2, pair FROM (
        SELECT *, sha256(node || coalesce(lead(node) OVER (PARTITION BY tree ORDER BY pos), '')) AS pair FROM up WHERE n > 1
    ) WHERE pos % 2 = 0
), subroots AS (
    SELECT tree, node, row_number() OVER (ORDER BY tree) - 1 AS pos, count(*) OVER () AS n FROM up WHERE n = 1
), top AS (
    SELECT 0 AS level, pos, n, node FROM subroots
    UNION ALL
    SELECT level + 1, pos // 2, (n + 1) // 2, pair FROM (
        SELECT *, sha256(node || coalesce(lead(node) OVER (ORDER BY pos), '')) AS pair FROM top WHERE n > 1
    ) WHERE pos % 2 = 0
), steps AS (
    SELECT r, level AS step, leaves.pos >> level AS own, up.pos, up.node
    FROM leaves JOIN up ON up.tree = leaves.tree AND up.n > 1 AND up.pos >> 1 = leaves.pos >> (level + 1)
    UNION ALL
    SELECT r, 1000 + level, subroots.pos >> level, top.pos, top.node
    FROM leaves JOIN subroots USING (tree) JOIN top ON top.n > 1 AND top.pos >> 1 = subroots.pos >> (level + 1)
), path AS (
    SELECT r, row_number() OVER (PARTITION BY r ORDER BY step) AS k, coalesce(max(node) FILTER (WHERE pos < own), '') AS l, coalesce(max(node) FILTER (WHERE pos > own), '') AS g
    FROM steps GROUP BY r, step
), fold AS (
    SELECT r, 0 AS k, shown AS node FROM docs
    UNION ALL
    SELECT r, path.k, sha256(l || node || g) FROM fold JOIN path USING (r) WHERE path.k = fold.k + 1
), folded AS (
    SELECT r, max_by(node, k) AS folded_root FROM fold GROUP BY r
), proofs AS (
    SELECT r, sha256(string_agg(l || g, '' ORDER BY k)) AS proof_sha256 FROM path GROUP BY r
)
SELECT doc_id, leaf, subroots.node AS subroot, top.node AS root, coalesce(proof_sha256, sha256('')) AS proof_sha256, folded_root, folded_root = top.node AS verified
FROM docs JOIN subroots USING (tree) JOIN top ON top.n = 1 JOIN folded USING (r) LEFT JOIN proofs USING (r)
"""

TRIE = f"""
WITH turns AS (
    SELECT conv_id, list({{role: coalesce(role, ''), text: coalesce(text, '')}} ORDER BY turn NULLS FIRST, sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) AS own
    FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id
), heads AS (
    SELECT c.conv_id, c.own, b.own AS head, {CRC32.format("CAST(c.conv_id AS VARCHAR)")} % 6 AS h FROM turns c LEFT JOIN turns b ON b.conv_id = c.conv_id - c.conv_id % 100
), rebuilt AS (
    SELECT conv_id, list_concat(coalesce(head[1:h], []), own[h + 1:]) AS t FROM heads
), begun AS (  -- each conversation at each depth
    SELECT conv_id, len(t) AS n, depth, t[1:depth] AS path, CASE WHEN depth > 0 THEN length(t[depth].text) ELSE 0 END AS size
    FROM (SELECT conv_id, t, unnest(range(len(t) + 1)) AS depth FROM rebuilt)
), nodes AS (
    SELECT depth, path, min(conv_id) AS node, count(*) AS n_convs, any_value(size) AS size, max(n) = depth AS is_leaf,
        sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE n = depth), '')) AS ends_sha256
    FROM begun GROUP BY depth, path
), spots AS (
    SELECT conv_id, depth, node FROM begun JOIN nodes USING (depth, path)
), above AS (  -- each node with every node on its path, itself included
    SELECT spots.node, spots.depth, below.node AS of, below.depth AS of_depth, below.n_convs, below.size, below.is_leaf
    FROM nodes below JOIN spots ON spots.conv_id = below.node AND spots.depth <= below.depth
), sums AS (
    SELECT node, depth, count(*) FILTER (WHERE is_leaf) AS n_leaves, sum((n_convs - 1) * size) AS saved_tokens, count(*) FILTER (WHERE of_depth = depth + 1) AS n_children
    FROM above GROUP BY node, depth
)
SELECT node AS conv_id, depth, parent.node AS parent_conv_id, n_convs, n_children, n_leaves, CAST(saved_tokens AS BIGINT) AS saved_tokens, ends_sha256
FROM nodes JOIN sums USING (node, depth) LEFT JOIN (SELECT conv_id AS c, depth + 1 AS d, node FROM spots) parent ON parent.c = nodes.node AND parent.d = nodes.depth
"""

JACCARD = f"""
WITH RECURSIVE docs AS (
    SELECT row_number() OVER () AS r, doc_id, {WORDS.format("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} AS w FROM documents
), shingles AS (
    SELECT DISTINCT r, array_to_string(w[i : i + 3], ' ') AS g
    FROM (SELECT r, w, unnest(range(1, greatest(len(w) - 3, 1) + 1)) AS i FROM docs WHERE len(w) > 0)
), sets AS (
    SELECT r, count(*) AS n, string_agg(g, chr(10) ORDER BY g) AS s FROM shingles GROUP BY r
), classes AS (  -- rows of one set, by the first of them
    SELECT r, n, min(r) OVER (PARTITION BY s) AS c FROM sets
), members AS (
    SELECT c, any_value(n) AS n, count(*) AS copies FROM classes GROUP BY c
), meets AS (
    SELECT a.r AS a, b.r AS b, count(*) AS common FROM shingles a JOIN shingles b ON a.g = b.g AND a.r < b.r
    WHERE a.r IN (SELECT c FROM members) AND b.r IN (SELECT c FROM members) GROUP BY a.r, b.r
), links AS (
    SELECT a, b FROM meets JOIN members x ON x.c = a JOIN members y ON y.c = b WHERE 100 * common >= 85 * (x.n + y.n - common)
), both_ways AS (
    SELECT a, b FROM links UNION ALL SELECT b, a FROM links
), reach AS (
    SELECT c AS a, c AS b FROM members UNION SELECT reach.a, both_ways.b FROM reach JOIN both_ways ON both_ways.a = reach.b
), least_id AS (
    SELECT reach.a AS c, min(doc_id) AS component_id FROM reach JOIN classes ON classes.c = reach.b JOIN docs USING (r) GROUP BY reach.a
), degrees AS (
    SELECT a AS c, sum(copies) AS others FROM both_ways JOIN members ON c = b GROUP BY a
)
SELECT doc_id, coalesce(classes.n, 0) AS n_shingles, coalesce(component_id, doc_id) AS component_id,
    CAST(coalesce(copies - 1 + coalesce(others, 0), 0) AS BIGINT) AS n_links
FROM docs LEFT JOIN classes USING (r) LEFT JOIN members USING (c) LEFT JOIN least_id USING (c) LEFT JOIN degrees USING (c)
"""

TOP = """
WITH vectors AS (
    SELECT row_number() OVER () AS r, vec_id, [floor(256 * CAST(x AS DOUBLE)) FOR x IN embedding] AS c
    FROM embeddings WHERE vec_id IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
    SELECT q.r, q.vec_id AS query_id, v.vec_id, CAST(list_inner_product(q.c, v.c) AS BIGINT) AS score
    FROM vectors q JOIN vectors v ON q.r <> v.r AND len(q.c) = len(v.c) WHERE q.vec_id % 50 = 0
)
SELECT query_id, CAST(row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM scored QUALIFY rank <= 5
"""

REPEATS = f"""
WITH docs AS (
    SELECT row_number() OVER () AS r, doc_id, {WORDS.format("text")} AS w FROM documents
), windows AS (
    SELECT r, doc_id, i, array_to_string(w[i : i + 12], ' ') AS g FROM (SELECT r, doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM docs)
), earlier AS (
    SELECT r, i FROM windows JOIN (SELECT g, min(doc_id) AS least FROM windows GROUP BY g) USING (g) WHERE doc_id > least OR doc_id IS NULL AND least IS NOT NULL
), gone AS (
    SELECT DISTINCT r, i + k AS i FROM earlier, range(13) t(k)
), kept AS (
    SELECT r, string_agg(word, ' ' ORDER BY i) AS text, count(*) AS n
    FROM (SELECT r, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i FROM docs) ANTI JOIN gone USING (r, i) GROUP BY r
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed, sha256(coalesce(kept.text, '')) AS kept_sha256
FROM docs LEFT JOIN kept USING (r)
"""

ORACLE: dict[str, str] = {
    "op1_ngram_jaccard": JACCARD,
    "op4_exact_top_k": TOP,
    "op9_substring_dedup": REPEATS,
    "op12_merkle_manifest": MANIFEST,
    "op13_prefix_trie": TRIE,
    "op5_host_quality_rules": RULES,
    "op6_source_mixing": MIXING,
    "op7_license_scan": LICENSES,
}
