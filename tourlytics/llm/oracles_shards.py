"""DuckDB SQL of the sharding query."""

from __future__ import annotations

_BITS = 5
_AXES = ("lang", "source", "n_chars")


def _crc_table() -> str:
    entry = "x"
    for _ in range(8):
        entry = f"(CASE WHEN {entry} & 1 = 1 THEN xor({entry} >> 1, 3988292384) ELSE {entry} >> 1 END)"
    return f"(SELECT list({entry} ORDER BY x) FROM (SELECT range::BIGINT AS x FROM range(256)))"


def _curve() -> str:
    """Index on the curve of (a0, a1, a2) of table c, as a chain of common tables."""
    last, out = "c", []
    for plane in range(_BITS - 1, 0, -1):
        q, low = 1 << plane, (1 << plane) - 1
        for axis in range(3):
            table = f"s{plane}{axis}"
            apart = f"(xor(a0, a{axis}) & {low})"
            first = f"CASE WHEN a{axis} & {q} <> 0 THEN xor(a0, {low}) ELSE xor(a0, {apart}) END AS a0"
            mine = "" if axis == 0 else f", CASE WHEN a{axis} & {q} <> 0 THEN a{axis} ELSE xor(a{axis}, {apart}) END AS a{axis}"
            rest = "".join(f", a{k}" for k in (1, 2) if k != axis)
            out.append(f"{table} AS (SELECT doc_id, size, crc, {first}{mine}{rest} FROM {last})")
            last = table
    out.append(f"gray AS (SELECT doc_id, size, crc, a0, xor(a0, a1) AS a1, xor(xor(a0, a1), a2) AS a2 FROM {last})")
    flip = "0"
    for plane in range(_BITS - 1, 0, -1):
        flip = f"xor({flip}, CASE WHEN a2 & {1 << plane} <> 0 THEN {(1 << plane) - 1} ELSE 0 END)"
    out.append(f"flip AS (SELECT *, {flip} AS t FROM gray)")
    woven = " + ".join(
        f"(((xor(a{axis}, t) >> {plane}) & 1) << {3 * plane + 2 - axis})" for plane in range(_BITS) for axis in range(3)
    )
    out.append(f"h AS (SELECT doc_id, size, crc, {woven} AS curve FROM flip)")
    return ",\n".join(out)


def _cell(axis: str) -> str:
    value = axis if axis == "n_chars" else f"left({axis}, 64)"
    return f"((rank() OVER (ORDER BY {value} NULLS FIRST) - 1) * {1 << _BITS} // count(*) OVER ())"


SHARDS = f"""WITH tab AS (SELECT {_crc_table()} AS ks),
b AS (SELECT *, CAST(octet_length(encode(coalesce(text, ''))) + 1 AS BIGINT) AS size,
  [('0x' || x)::BIGINT FOR x IN regexp_extract_all(hex(encode(coalesce(text, ''))), '..')] AS bytes FROM documents),
c AS (SELECT doc_id, size,
  xor(list_reduce(bytes, lambda a, x: xor(a >> 8, ks[(xor(a, x) & 255) + 1]), 4294967295::BIGINT), 4294967295) AS crc,
  {", ".join(f"{_cell(name)} AS a{at}" for at, name in enumerate(_AXES))} FROM b, tab),
{_curve()},
r AS (SELECT *, row_number() OVER (ORDER BY curve, crc, doc_id NULLS FIRST, size) - 1 AS rk, count(*) OVER () AS n FROM h)
SELECT doc_id, size, crc AS text_crc32, 'rows' AS law, CAST(rk * 16 // n AS INT) AS shard,
  rk - ((rk * 16 // n) * n + 15) // 16 AS slot, CAST(NULL AS INT) AS grown_shard FROM r"""


def _field(value: str) -> str:
    return f"coalesce(octet_length(encode({value}::VARCHAR)) || ':' || {value}::VARCHAR, '-')"


def _leaf(n_chars: str) -> str:
    return f"sha256({' || '.join(_field(c) for c in ('doc_id', 'source', 'lang', n_chars, 'text'))})"


#: Nodes by level: (t: tree, k: level, p: place, d: digest, n: nodes of the level).
_LEVELS = """SELECT t, k + 1, p // 2, sha256(string_agg(d, '' ORDER BY p)), (any_value(n) + 1) // 2
  FROM {up} WHERE n > 1 GROUP BY t, k, p // 2"""

_CRC = "xor(list_reduce([('0x' || x)::BIGINT FOR x IN regexp_extract_all(hex(encode(doc_id::VARCHAR)), '..')], lambda a, x: xor(a >> 8, ks[(xor(a, x) & 255) + 1]), 4294967295::BIGINT), 4294967295)"

MANIFEST = f"""WITH RECURSIVE tab AS (SELECT {_crc_table()} AS ks),
l AS (SELECT doc_id, lang, {_leaf("n_chars")} AS leaf,
  CASE WHEN {_CRC} % 7 = 0 THEN {_leaf("(n_chars + 1)")} END AS seen FROM documents, tab),
o AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS p,
  count(*) OVER (PARTITION BY lang) AS n, dense_rank() OVER (ORDER BY lang NULLS FIRST) AS t FROM l),
up AS (SELECT t, 0 AS k, p, leaf AS d, n FROM o UNION ALL {_LEVELS.format(up="up")}),
sub AS (SELECT t, max(k) AS top, arg_max(d, k) AS subroot FROM up GROUP BY t),
over AS (SELECT 0 AS t, 0 AS k, t - 1 AS p, subroot AS d, count(*) OVER () AS n FROM sub UNION ALL {_LEVELS.format(up="over")}),
root AS (SELECT max(k) AS top, arg_max(d, k) AS root FROM over),
steps AS (SELECT o.t, o.p, u.k, coalesce(s.d, '') AS d, CASE WHEN s.p < u.p THEN 1 ELSE 0 END AS lft
  FROM o JOIN up u ON u.t = o.t AND u.p = o.p >> u.k AND u.n > 1
  LEFT JOIN up s ON s.t = u.t AND s.k = u.k AND s.p = xor(u.p, 1)
  UNION ALL SELECT o.t, o.p, sub.top + v.k, coalesce(s.d, ''), CASE WHEN s.p < v.p THEN 1 ELSE 0 END
  FROM o JOIN sub ON sub.t = o.t JOIN over v ON v.p = (o.t - 1) >> v.k AND v.n > 1
  LEFT JOIN over s ON s.k = v.k AND s.p = xor(v.p, 1)),
ways AS (SELECT t, p, list(d ORDER BY k) AS ds, list(lft ORDER BY k) AS ls FROM steps GROUP BY t, p),
fold AS (SELECT o.t, o.p, 1 AS i, coalesce(seen, leaf) AS d FROM o
  UNION ALL SELECT f.t, f.p, f.i + 1, sha256(CASE WHEN ls[i] = 1 THEN ds[i] || d ELSE d || ds[i] END)
  FROM fold f JOIN ways w ON w.t = f.t AND w.p = f.p WHERE f.i <= len(ds)),
ended AS (SELECT t, p, arg_max(d, i) AS folded_root FROM fold GROUP BY t, p)
SELECT doc_id, leaf, subroot, root, sha256(coalesce(array_to_string(ds, ''), '')) AS proof_sha256, folded_root,
  folded_root = root AS verified
FROM o JOIN sub ON sub.t = o.t CROSS JOIN root JOIN ended e ON e.t = o.t AND e.p = o.p
LEFT JOIN ways w ON w.t = o.t AND w.p = o.p"""
