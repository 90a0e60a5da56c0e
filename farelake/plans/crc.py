"""CRC-32 in DuckDB's SQL, for checks of queries that place rows by it."""

from __future__ import annotations

#: A common table expression ``crc_table(t)``: the 256 entries of the reflected CRC-32, from its polynomial.
CRC_TABLE_SQL = """crc_table AS (
    SELECT list(list_reduce([i] || range(8), lambda v, k: CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END) ORDER BY i) AS t
    FROM range(256) r(i))"""


def crc32_sql(text: str) -> str:
    """The CRC-32 of the UTF-8 of ``text``, whose characters are below U+0800; needs ``crc_table``."""
    as_bytes = f"""flatten(list_transform(string_split({text}, ''), lambda c:
        CASE WHEN ord(c) < 128 THEN [ord(c)::BIGINT] ELSE [192 + (ord(c) >> 6)::BIGINT, 128 + (ord(c) & 63)::BIGINT] END))"""
    step = "lambda s, b: xor(s >> 8, t[(xor(s, b) & 255) + 1])"
    return f"xor(list_reduce([4294967295::BIGINT] || {as_bytes}, {step}), 4294967295)"
