"""The Merkle manifest of documents in DuckDB SQL: a table for each level, as many as any number of 64-bit ranks needs here."""

from __future__ import annotations

LEVELS = 10  # 8 to the power 10 rows of a group

# CRC-32 of a decimal number's text; 3988292384 is the reversed polynomial, a fixed value.
CRC32 = """xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, [unicode(c)::BIGINT FOR c IN string_split(doc_id::VARCHAR, '')]),
  lambda c, b: list_reduce(list_prepend(xor(c, b), range(8)),
    lambda x, k: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)))"""


def _field(value: str) -> str:
    return f"coalesce(strlen({value}::VARCHAR) || ':' || {value}::VARCHAR, '-')"


def _leaf(text: str) -> str:
    return "sha256(" + " || ".join(map(_field, ("doc_id", "source", "lang", "n_chars", text))) + ")"


def _tree(name: str) -> str:
    """Tables {name}0.. (grp, rank, n, digest, before, after), each from the one below; {name}0 must have grp, rank, n, digest."""
    out = []
    for k in range(LEVELS):
        run = "PARTITION BY grp, rank // 8 ORDER BY rank ROWS BETWEEN"
        out.append(f"""{name}s{k} AS (SELECT *,
          coalesce(string_agg(digest, '') OVER ({run} UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS before,
          coalesce(string_agg(digest, '') OVER ({run} 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS after FROM {name}{k})""")
        out.append(f"""{name}{k + 1} AS (SELECT grp, rank // 8 AS rank, (any_value(n) + 7) // 8 AS n,
          CASE WHEN any_value(n) > 1 THEN sha256(string_agg(digest, '' ORDER BY rank)) ELSE any_value(digest) END AS digest
          FROM {name}{k} GROUP BY grp, rank // 8)""")
    return ",\n".join(out)


def _path(name: str, rows: str, done: str) -> tuple[str, str]:
    """Tables that fold ``digest`` and collect ``proof`` of the rows with grp and rank, level by level."""
    out, before = [], rows
    for k in range(LEVELS):
        out.append(f"""{done}{k} AS (SELECT r.* REPLACE (r.rank // 8 AS rank,
          CASE WHEN s.n > 1 THEN sha256(s.before || r.digest || s.after) ELSE r.digest END AS digest,
          CASE WHEN s.n > 1 THEN r.proof || s.before || s.after ELSE r.proof END AS proof)
          FROM {before} r JOIN {name}s{k} s ON s.grp = r.grp AND s.rank = r.rank)""")
        before = f"{done}{k}"
    return ",\n".join(out), before


def report() -> str:
    up, ends = _path("t", "first", "u")
    over, last = _path("g", "second", "w")
    return f"""
    WITH docs AS (SELECT *, coalesce('=' || lang, '') AS grp FROM documents),
    leaves AS (SELECT doc_id, grp, {_leaf("text")} AS leaf,
      CASE WHEN doc_id IS NOT NULL AND {CRC32} % 3 = 0
        THEN {_leaf("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} ELSE {_leaf("text")} END AS tampered
      FROM docs),
    placed AS (SELECT *, row_number() OVER (PARTITION BY grp ORDER BY doc_id NULLS FIRST, leaf) - 1 AS rank,
      count(*) OVER (PARTITION BY grp) AS n FROM leaves),
    t0 AS (SELECT grp, rank, n, leaf AS digest FROM placed),
    {_tree("t")},
    g0 AS (SELECT 'all' AS grp, row_number() OVER (ORDER BY grp) - 1 AS rank, count(*) OVER () AS n, digest, grp AS name
           FROM t{LEVELS}),
    {_tree("g")},
    first AS (SELECT doc_id, grp, leaf, rank, tampered AS digest, '' AS proof FROM placed),
    {up},
    second AS (SELECT u.* REPLACE ('all' AS grp, g0.rank AS rank), g0.digest AS subroot FROM {ends} u JOIN g0 ON g0.name = u.grp),
    {over}
    SELECT doc_id, leaf, subroot, g{LEVELS}.digest AS root, sha256(proof) AS proof_sha256, w.digest AS folded_root,
      w.digest = g{LEVELS}.digest AS verified
    FROM {last} w, g{LEVELS}
    """
