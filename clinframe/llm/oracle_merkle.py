"""DuckDB SQL for the Merkle manifest: whole trees level by level, without blocks or witnesses."""

_FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def _leaf(text: str) -> str:
    values = [text if c == "text" else f"{c}::varchar" for c in _FIELDS]
    return "sha256(" + " || ".join(f"coalesce(strlen({v}) || ':' || {v}, '-')" for v in values) + ")"


_TAMPERED = "CASE WHEN hit THEN translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') ELSE text END"

# CRC-32 bit by bit: each byte is taken in, then eight shifts (-1) with the polynomial.
_CRC32 = """xor(4294967295, list_reduce(
    list_prepend(4294967295::bigint, flatten(list_transform(string_split(doc_id::varchar, ''), lambda c: list_prepend(ord(c)::bigint, [-1::bigint, -1, -1, -1, -1, -1, -1, -1])))),
    lambda c, s: CASE WHEN s >= 0 THEN xor(c, s) WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384::bigint) ELSE c >> 1 END))"""


def _tree(name: str, start: str) -> str:
    return f"""
{name}(key, level, pos, node, n) AS (
    SELECT key, 0, pos, node, n FROM {start}
    UNION ALL
    SELECT key, level + 1, pos // 16, sha256(string_agg(node, '' ORDER BY pos)), (n + 15) // 16
    FROM {name} WHERE n > 1 GROUP BY key, level, pos // 16, n),
{name}_siblings AS (
    SELECT key, level, pos,
        coalesce(string_agg(node, '') OVER (PARTITION BY key, level, pos // 16 ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS before,
        coalesce(string_agg(node, '') OVER (PARTITION BY key, level, pos // 16 ORDER BY pos ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS after
    FROM {name} WHERE n > 1)"""


MERKLE_SQL = f"""
WITH RECURSIVE marked AS (SELECT *, coalesce({_CRC32} % 5 = 0, false) AS hit FROM documents),
hashed AS (SELECT doc_id, source AS key, {_leaf("text")} AS node, {_leaf(f"({_TAMPERED})")} AS changed FROM marked),
leaves AS (SELECT *, row_number() OVER (PARTITION BY key ORDER BY doc_id NULLS FIRST, node) - 1 AS pos, count(*) OVER (PARTITION BY key) AS n FROM hashed),
{_tree("tree", "leaves")},
groups AS (SELECT '' AS key, key AS source, node, row_number() OVER (ORDER BY key NULLS FIRST) - 1 AS pos, count(*) OVER () AS n FROM tree WHERE n = 1),
{_tree("crown", "groups")},
steps AS (
    SELECT l.key, l.pos, s.level, s.before, s.after FROM leaves l JOIN tree_siblings s
    ON l.key IS NOT DISTINCT FROM s.key AND s.pos = l.pos // (16 ** s.level)::bigint
    UNION ALL
    SELECT l.key, l.pos, 1000 + s.level, s.before, s.after FROM leaves l JOIN groups g ON l.key IS NOT DISTINCT FROM g.source
    JOIN crown_siblings s ON s.pos = g.pos // (16 ** s.level)::bigint),
paths AS (SELECT key, pos, sha256(string_agg(before || after, '' ORDER BY level)) AS proof, list(before || '|' || after ORDER BY level) AS path
    FROM steps GROUP BY key, pos)
SELECT l.doc_id, l.node AS leaf, g.node AS subroot, r.node AS root, coalesce(p.proof, sha256('')) AS proof_sha256,
    list_reduce(list_prepend(l.changed, coalesce(p.path, [])), lambda a, w: sha256(split_part(w, '|', 1) || a || split_part(w, '|', 2))) AS folded_root,
    folded_root = r.node AS verified
FROM leaves l JOIN groups g ON l.key IS NOT DISTINCT FROM g.source CROSS JOIN (SELECT node FROM crown WHERE n = 1) r
LEFT JOIN paths p ON l.key IS NOT DISTINCT FROM p.key AND l.pos = p.pos
"""
