"""The DuckDB statement of the Merkle manifest, written level by level."""

from __future__ import annotations

#: Levels that the statement goes up in a source's tree (16**6 rows) and in the dataset's (16**3 sources).
SOURCE_LEVELS, TOP_LEVELS = 6, 3


def _field(x: str) -> str:
    return f"CASE WHEN {x} IS NULL THEN '-' ELSE octet_length(encode(CAST({x} AS VARCHAR))) || ':' || {x} END"


def _leaf(text: str) -> str:
    return "sha256(" + " || ".join(_field(x) for x in ("doc_id", "source", "lang", "n_chars", text)) + ")"


def _climb(name: str, levels: int) -> str:
    """Views name0 (tree, i, h) .. name<levels>, each with the siblings before (b) and after (a); a tree of one node stays."""
    out = []
    for k in range(levels + 1):  # name0 is given
        if k:
            low = f"{name}{k - 1}s"
            out.append(
                f"{name}{k} AS (SELECT tree, i // 16 AS i, CASE WHEN max(n) > 1 THEN sha256(string_agg(h, '' ORDER BY i)) ELSE max(h) END AS h FROM {low} GROUP BY tree, i // 16)"
            )
        run = "PARTITION BY tree, i // 16 ORDER BY i ROWS BETWEEN"
        out.append(
            f"{name}{k}s AS (SELECT *, count(*) OVER (PARTITION BY tree) AS n, coalesce(string_agg(h, '') OVER ({run} UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS b, "
            f"coalesce(string_agg(h, '') OVER ({run} 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS a FROM {name}{k})"
        )
    return ",\n".join(out)


def _folds(levels: list[str]) -> str:
    """Views f1..: proof so far and fold so far, after each level."""
    out = []
    for k, (low, tree, i) in enumerate(levels):
        out.append(
            f"f{k + 1} AS (SELECT f{k}.* REPLACE (p || CASE WHEN s.n > 1 THEN s.b || s.a ELSE '' END AS p, CASE WHEN s.n > 1 THEN sha256(s.b || c || s.a) ELSE c END AS c) "
            f"FROM f{k} JOIN {low} s ON s.tree = f{k}.{tree} AND s.i = {i})"
        )
    return ",\n".join(out)


#: crc32 (polynomial 0xEDB88320) of a doc_id's decimal text.
CRC = """xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT))),
    lambda c, x: list_reduce(list_prepend(xor(c, x), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]), lambda v, z: CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END)), 4294967295)"""

_LEVELS = [(f"s{k}s", "tree", f"f{k}.i // {16**k}") for k in range(SOURCE_LEVELS)]
_TOPS = [(f"t{k}s", "top", f"f{SOURCE_LEVELS + k}.place // {16**k}") for k in range(TOP_LEVELS)]

MERKLE_SQL = f"""
WITH l AS (
  SELECT doc_id, coalesce('s' || source, 'n') AS tree, {_leaf("text")} AS leaf,
    CASE WHEN {CRC} % 5 = 0 THEN {_leaf("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} END AS changed
  FROM documents
), o AS (
  SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i FROM l
), s0 AS (SELECT tree, i, leaf AS h FROM o),
{_climb("s", SOURCE_LEVELS)},
sub AS (SELECT tree, h AS subroot, row_number() OVER (ORDER BY encode(tree)) - 1 AS place FROM s{SOURCE_LEVELS}),
t0 AS (SELECT 'top' AS tree, place AS i, subroot AS h FROM sub),
{_climb("t", TOP_LEVELS)},
f0 AS (SELECT o.*, sub.subroot, sub.place, 'top' AS top, '' AS p, coalesce(changed, leaf) AS c FROM o JOIN sub USING (tree)),
{_folds(_LEVELS + _TOPS)}
SELECT doc_id, leaf, subroot, h AS root, sha256(p) AS proof_sha256, c AS folded_root, c = h AS verified
FROM f{SOURCE_LEVELS + TOP_LEVELS}, t{TOP_LEVELS}
"""
