"""SQL of the longer oracles, for DuckDB."""

# Unsigned CRC-32 of a short text of ASCII characters: per character eight steps of
# the shift register (3988292384 is the polynomial, bits reversed).
_CRC32 = """
    xor(list_reduce(
        list_prepend(4294967295::BIGINT, [ascii(x)::BIGINT FOR x IN string_split({text}, '')]),
        lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[], lambda r, i: xor(r >> 1, 3988292384 * (r & 1)))
    ), 4294967295)
"""


def _crc32(text: str) -> str:
    return _CRC32.format(text=text)


def _field(value: str) -> str:
    return f"coalesce(strlen({value}::VARCHAR)::VARCHAR || ':' || {value}::VARCHAR, '-')"


def _leaf(text: str) -> str:
    return "sha256(" + " || ".join(map(_field, ("doc_id", "source", "lang", "n_chars", text))) + ")"


_A_Z, _a_z = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# Trees: one for each language, and -1 over their subroots. A leaf's way up
# follows ranks divided by 8, first in its own tree, then in that one.
OP11_SQL = f"""
    WITH RECURSIVE
    d AS (
        SELECT *, {_leaf("text")} AS leaf,
               CASE WHEN {_crc32("doc_id::VARCHAR")} % 3 = 0 THEN {_leaf(f"translate(text, '{_A_Z}', '{_a_z}')")} END AS shown
        FROM documents
    ),
    placed AS (
        SELECT doc_id, leaf, coalesce(shown, leaf) AS shown,
               dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS tree,
               row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS rank,
               count(*) OVER (PARTITION BY lang) AS n
        FROM d
    ),
    nodes AS (
        SELECT tree, 0 AS height, rank, n, leaf AS digest FROM placed
        UNION ALL
        SELECT tree, height + 1, rank // 8, (n + 7) // 8, sha256(string_agg(digest, '' ORDER BY rank))
        FROM nodes WHERE n > 1 GROUP BY ALL
    ),
    subroots AS (SELECT tree, height, digest FROM nodes WHERE n = 1),
    upper AS (
        SELECT 0 AS height, tree AS rank, (SELECT count(*) FROM subroots) AS n, digest FROM subroots
        UNION ALL
        SELECT height + 1, rank // 8, (n + 7) // 8, sha256(string_agg(digest, '' ORDER BY rank)) FROM upper WHERE n > 1 GROUP BY ALL
    ),
    root AS (SELECT digest AS root, height FROM upper WHERE n = 1),
    steps AS (
        SELECT tree, height, rank, n, digest FROM nodes WHERE n > 1
        UNION ALL
        SELECT -1, height, rank, n, digest FROM upper WHERE n > 1
    ),
    up AS (
        SELECT p.doc_id, p.leaf, p.tree, p.rank AS leaf_rank, 0 AS step, p.tree AS inside, 0 AS height, p.rank, p.shown AS folded, '' AS siblings
        FROM placed p
        UNION ALL
        SELECT u.doc_id, u.leaf, u.tree, u.leaf_rank, u.step + 1, u.inside, u.height + 1, u.rank // 8,
               sha256(coalesce(string_agg(s.digest, '' ORDER BY s.rank) FILTER (s.rank < u.rank), '') || u.folded
                      || coalesce(string_agg(s.digest, '' ORDER BY s.rank) FILTER (s.rank > u.rank), '')),
               u.siblings || coalesce(string_agg(s.digest, '' ORDER BY s.rank) FILTER (s.rank <> u.rank), '')
        FROM (
            -- At the top of its own tree a leaf goes on as a node of tree -1.
            SELECT v.* REPLACE (
                CASE WHEN v.inside >= 0 AND v.height = t.height THEN -1 ELSE v.inside END AS inside,
                CASE WHEN v.inside >= 0 AND v.height = t.height THEN 0 ELSE v.height END AS height,
                CASE WHEN v.inside >= 0 AND v.height = t.height THEN v.tree ELSE v.rank END AS rank)
            FROM up v JOIN subroots t ON t.tree = v.tree
        ) u JOIN steps s ON s.tree = u.inside AND s.height = u.height AND s.rank // 8 = u.rank // 8
        GROUP BY u.doc_id, u.leaf, u.tree, u.leaf_rank, u.step, u.inside, u.height, u.rank, u.folded, u.siblings
    )
    SELECT u.doc_id, u.leaf, t.digest AS subroot, r.root, sha256(u.siblings) AS proof_sha256, u.folded AS folded_root, u.folded = r.root AS verified
    FROM up u JOIN subroots t ON t.tree = u.tree CROSS JOIN root r
    WHERE u.step = t.height + r.height
"""

# A prefix is named by the text of its turns with their lengths. A node's ancestors
# are the prefixes of its smallest member.
OP13_SQL = f"""
    WITH
    t AS (
        SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text,
               row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS place
        FROM conversations WHERE conv_id IS NOT NULL
    ),
    convs AS (SELECT c, c - c % 100 AS base, {_crc32("c::VARCHAR")} % 6 AS h FROM (SELECT DISTINCT c FROM t)),
    heads AS (SELECT v.c, count(t.place) AS head FROM convs v LEFT JOIN t ON t.c = v.base AND t.place <= v.h GROUP BY v.c),
    rebuilt AS (
        SELECT v.c, t.place AS depth, role, text FROM convs v JOIN t ON t.c = v.base AND t.place <= v.h
        UNION ALL
        SELECT v.c, heads.head + t.place - v.h, role, text FROM convs v JOIN heads ON heads.c = v.c JOIN t ON t.c = v.c AND t.place > v.h
    ),
    prefix AS (
        SELECT c, depth, strlen(text) AS n, length(text) AS chars,
               string_agg(strlen(role)::VARCHAR || ':' || role || strlen(text)::VARCHAR || ':' || text, '') OVER (PARTITION BY c ORDER BY depth) AS name
        FROM rebuilt
        UNION ALL SELECT c, 0, 0, 0, '' FROM convs
    ),
    lengths AS (SELECT c, max(depth) AS length FROM prefix GROUP BY c),
    nodes AS (
        SELECT name, depth, min(prefix.c) AS conv, count(*) AS n_convs, any_value(chars) AS chars,
               sha256(coalesce(string_agg(prefix.c::VARCHAR, ',' ORDER BY prefix.c) FILTER (depth = length), '')) AS ends
        FROM prefix JOIN lengths ON lengths.c = prefix.c GROUP BY name, depth
    ),
    links AS (
        SELECT n.conv, n.depth, up.conv AS parent
        FROM nodes n LEFT JOIN prefix p ON p.c = n.conv AND p.depth = n.depth - 1 LEFT JOIN nodes up ON up.name = p.name AND up.depth = p.depth
    ),
    children AS (SELECT parent AS conv, depth - 1 AS depth, count(*) AS k FROM links WHERE parent IS NOT NULL GROUP BY ALL),
    below AS (
        SELECT top.conv, top.depth, count(*) FILTER (children.k IS NULL) AS n_leaves, sum((n.n_convs - 1) * n.chars)::BIGINT AS saved
        FROM nodes n JOIN prefix p ON p.c = n.conv AND p.depth <= n.depth
        JOIN nodes top ON top.name = p.name AND top.depth = p.depth
        LEFT JOIN children ON children.conv = n.conv AND children.depth = n.depth
        GROUP BY top.conv, top.depth
    )
    SELECT n.conv AS conv_id, n.depth::BIGINT AS depth, links.parent AS parent_conv_id, n.n_convs, coalesce(children.k, 0) AS n_children,
           below.n_leaves, below.saved AS saved_tokens, n.ends AS ends_sha256
    FROM nodes n JOIN links ON links.conv = n.conv AND links.depth = n.depth JOIN below ON below.conv = n.conv AND below.depth = n.depth
    LEFT JOIN children ON children.conv = n.conv AND children.depth = n.depth
"""
