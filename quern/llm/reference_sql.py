"""SQL of another engine (DuckDB) for queries of this folder that need more than a few lines of it."""

from __future__ import annotations

_FULL = 4294967295


def crc32(text: str) -> str:
    """The checksum of an ASCII text: each byte is mixed in by eight shifts of the reflected polynomial."""
    shifted = "list_reduce(range(0, 8), lambda c, k: xor(c >> 1, 3988292384 * (c & 1)), xor(a, b))"
    codes = f"list_transform(string_split({text}, ''), lambda x: CAST(ascii(x) AS BIGINT))"
    return f"xor(list_reduce({codes}, lambda a, b: {shifted}, CAST({_FULL} AS BIGINT)), {_FULL})"


_BLANKS = "chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
_IMPOSSIBLE = "{'c': 1000000, 's': 'Z'}"


def conversation_repair() -> str:
    """Costs and edits of what follows, by state, carried backwards over the rows of each conversation."""

    def option(letter: str, cost: str, state: int, when: str = "true") -> str:
        return f"CASE WHEN {when} THEN {{'c': f.s{state}.c + {cost}, 's': '{letter}' || f.s{state}.s}} ELSE {_IMPOSSIBLE} END"

    after, kept = (2, 2, 3, 2), {0: {"s": 1, "u": 2}, 1: {"u": 2}, 2: {"a": 3}, 3: {"u": 2}}
    steps = []
    for state in range(4):
        found = [option("D", "2", state), option("R", "1 + r.cut", after[state], "NOT r.bound")]
        found += [option("K", "r.cut", to, f"NOT r.bound AND r.initial = '{c}'") for c, to in kept[state].items()]
        steps.append(f"list_min([{', '.join(found)}]) AS s{state}")
    one, two = "{{'c': o.s{0}.c + 5, 's': 'I' || o.s{0}.s}}", "{{'c': o.s{0}.c + 10, 's': 'II' || o.s{0}.s}}"
    ways = [["o.s0", one.format(2), two.format(3)], ["o.s1", one.format(2), two.format(3)], ["o.s2", one.format(3)], ["o.s3", one.format(2)]]
    inserted = ", ".join(f"list_min([{', '.join(w)}]) AS s{s}" for s, w in enumerate(ways))
    return f"""
WITH RECURSIVE sound AS (
    SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
           {crc32("coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ')")} % 20 AS kind
    FROM conversations
), damaged AS (
    SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
           CASE WHEN kind = 1 THEN '' WHEN kind = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
           unnest(range(0, CASE WHEN kind = 0 THEN 0 WHEN kind = 3 THEN 2 ELSE 1 END)) AS copy
    FROM sound
), placed AS (
    SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i,
           row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) AS nth,
           rtrim(text, {_BLANKS}) AS bare, left(role, 1) AS initial
    FROM damaged
), marked AS (
    SELECT *, CASE WHEN bare = '' THEN 'blank' WHEN nth > 1 THEN 'duplicate'
                   WHEN right(bare, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault,
           lag(initial) OVER (PARTITION BY conv_id ORDER BY i) AS earlier
    FROM placed
), edited AS (
    SELECT conv_id, i, role, text, initial, fault IN ('blank', 'duplicate') AS bound,
           CASE WHEN fault = 'truncated' THEN 5 ELSE 0 END AS cut
    FROM marked
), back AS (
    SELECT conv_id, count(*) + 1 AS i, {{'c': 0, 's': ''}} AS s0, {{'c': 10, 's': 'II'}} AS s1,
           {{'c': 5, 's': 'I'}} AS s2, {{'c': 0, 's': ''}} AS s3
    FROM edited GROUP BY conv_id
    UNION ALL
    SELECT conv_id, i, {inserted}
    FROM (
        SELECT r.conv_id, r.i, {", ".join(steps)}
        FROM back f JOIN edited r ON r.conv_id IS NOT DISTINCT FROM f.conv_id AND r.i = f.i - 1
    ) AS o
), best AS (
    SELECT conv_id, s0.c AS cost, s0.s AS audit, length(s0.s) - length(replace(s0.s, 'D', '')) AS deleted
    FROM back WHERE i = 1
), letters AS (
    SELECT conv_id, audit, (length(audit) - deleted) % 2 AS odd, unnest(range(1, length(audit) + 1)) AS p FROM best
), written AS (
    SELECT conv_id, p, odd, audit[p] AS letter,
           length(replace(audit[1:p], 'I', '')) AS i, length(replace(audit[1:p], 'D', '')) AS k
    FROM letters
), lines AS (
    SELECT w.conv_id, w.p,
           CASE WHEN letter = 'K' THEN r.role WHEN (k - odd) % 2 = 1 THEN 'user' ELSE 'assistant' END || ':'
           || CASE WHEN letter = 'I' THEN '' ELSE r.text END AS line
    FROM written w LEFT JOIN edited r ON r.conv_id IS NOT DISTINCT FROM w.conv_id AND r.i = w.i
    WHERE letter <> 'D'
), texts AS (
    SELECT conv_id, string_agg(line, chr(10) ORDER BY p) AS text FROM lines GROUP BY conv_id
), counted AS (
    SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
           count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
           count(*) FILTER (fault = 'truncated') AS truncated,
           count(*) FILTER (i > 1 AND earlier || initial NOT IN ('su', 'ua', 'au')) AS illegal
    FROM marked GROUP BY conv_id
)
SELECT o.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, CAST(coalesce(cost, 0) AS BIGINT) AS cost,
       coalesce(audit, '') AS audit, sha256(coalesce(t.text, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) AS o
LEFT JOIN counted c ON c.conv_id IS NOT DISTINCT FROM o.conv_id
LEFT JOIN best b ON b.conv_id IS NOT DISTINCT FROM o.conv_id
LEFT JOIN texts t ON t.conv_id IS NOT DISTINCT FROM o.conv_id
"""


def merkle_manifest(tree_levels: int = 9, top_levels: int = 4) -> str:
    """Trees of up to 8 to the ``tree_levels`` leaves and as many groups as ``top_levels`` allow, level by level."""

    def field(value: str) -> str:
        text = f"CAST({value} AS VARCHAR)"
        return f"coalesce(CAST(strlen({text}) AS VARCHAR) || ':' || {text}, '-')"

    def leaf(text: str) -> str:
        return "sha256(" + " || ".join(field(v) for v in ("doc_id", "source", "lang", "n_chars", text)) + ")"

    def level(name: str, k: int, key: str) -> str:
        """Nodes of a level with the members of their run on either side, and the level above."""
        run = f"OVER (PARTITION BY {key}, i // 8 ORDER BY i ROWS BETWEEN "
        return f"""{name}{k}_beside AS (
    SELECT *, coalesce(string_agg(h, '') {run}UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,
           coalesce(string_agg(h, '') {run}1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r
    FROM {name}{k} WHERE n > 1
), {name}{k + 1} AS (
    SELECT {key}, i // 8 AS i, (n + 7) // 8 AS n, sha256(string_agg(h, '' ORDER BY i)) AS h
    FROM {name}{k} WHERE n > 1 GROUP BY {key}, i // 8, n
)"""

    def roots(name: str, most: int, key: str) -> str:
        return " UNION ALL ".join(f"SELECT {key}, h FROM {name}{k} WHERE n = 1" for k in range(most + 1))

    lowered = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    parts = [f"""leaves AS (
    SELECT doc_id, lang, leaf, CASE WHEN {crc32("CAST(doc_id AS VARCHAR)")} % 3 = 0 THEN other ELSE leaf END AS used,
           row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i,
           count(*) OVER (PARTITION BY lang) AS n, dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS tree
    FROM (SELECT doc_id, lang, {leaf("text")} AS leaf, {leaf(lowered)} AS other FROM documents) AS d
), node0 AS (SELECT tree, i, n, leaf AS h FROM leaves)"""]  # fmt: skip
    parts += [level("node", k, "tree") for k in range(tree_levels)]
    parts += [f"subroots AS ({roots('node', tree_levels, 'tree')})",
              "top0 AS (SELECT 0 AS one, tree AS i, count(*) OVER () AS n, h FROM subroots)"]
    parts += [level("top", k, "one") for k in range(top_levels)]
    parts += [f"root AS ({roots('top', top_levels, 'one')})"]
    before, way = "leaves", [("node", k, f"a.tree = b.tree AND a.i // {8**k} = b.i") for k in range(tree_levels)]
    way += [("top", k, f"a.tree // {8**k} = b.i") for k in range(top_levels)]
    for step, (name, k, same) in enumerate(way):
        used, proof = ("a.used", "''") if step == 0 else ("a.used", "a.proof")
        parts.append(f"""path{step} AS (
    SELECT a.* EXCLUDE (used{'' if step == 0 else ', proof'}), {proof} || coalesce(b.l || b.r, '') AS proof,
           CASE WHEN b.l IS NULL THEN {used} ELSE sha256(b.l || {used} || b.r) END AS used
    FROM {before} a LEFT JOIN {name}{k}_beside b ON {same}
)""")
        before = f"path{step}"
    return "WITH " + ",\n".join(parts) + f"""
SELECT p.doc_id, p.leaf, s.h AS subroot, t.h AS root, sha256(p.proof) AS proof_sha256, p.used AS folded_root,
       p.used = t.h AS verified
FROM {before} p JOIN subroots s ON s.tree = p.tree CROSS JOIN root t
"""
