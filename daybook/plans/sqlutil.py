"""DuckDB SQL snippets shared by the oracles (they only build query text)."""

from __future__ import annotations


# RE2 class of the characters that Java does not count as white space.
NOT_BLANK = (r"[^\x09-\x0D\x1C-\x20\x{1680}\x{2000}-\x{2006}\x{2008}-\x{200A}\x{2028}\x{2029}\x{205F}\x{3000}]")


def jh(e: str) -> str:
    """Java ``String.hashCode`` of a VARCHAR expression in DuckDB SQL (BMP text)."""
    return (f"(CASE WHEN {e} IS NULL THEN NULL WHEN {e} = '' THEN CAST(0 AS BIGINT) ELSE "
            f"(list_reduce(list_transform(string_split({e}, ''), lambda x: CAST(unicode(x) AS BIGINT)), "
            f"lambda a, b: (a * 31 + b) % 4294967296, CAST(0 AS BIGINT)) + 2147483648) % 4294967296 - 2147483648 END)")


def cc_sql(name: str, vertices: str, edges: str) -> str:
    """CTEs computing ``{name}(id, comp)``: min-label connected components of the
    vertex query ``vertices(id)`` and edge query ``edges(src, dst)``. Needs
    ``WITH RECURSIVE``."""
    return f"""
    {name}_v AS (SELECT id FROM ({vertices}) UNION SELECT src FROM ({edges}) UNION SELECT dst FROM ({edges})),
    {name}_e AS (SELECT src AS s, dst AS d FROM ({edges}) UNION SELECT dst, src FROM ({edges})),
    {name}(id, comp) USING KEY (id) AS (
      SELECT id, id FROM {name}_v WHERE id IS NOT NULL
      UNION
      SELECT e.d AS id, min(c.comp) AS comp FROM {name} c JOIN {name}_e e ON c.id = e.s
      LEFT JOIN recurring.{name} r ON r.id = e.d
      GROUP BY e.d, r.comp HAVING min(c.comp) < coalesce(r.comp, 9223372036854775807))"""


def geohash_sql(lat: str, lng: str, precision: int = 5) -> str:
    """Geohash of two DOUBLE expressions in DuckDB SQL (null when out of range)."""
    nbits = 5 * precision
    lng_bits, lat_bits = (nbits + 1) // 2, nbits // 2
    la = f"least(CAST(floor(({lat} + 90.0) / 180.0 * {1 << lat_bits}) AS BIGINT), {(1 << lat_bits) - 1})"
    lo = f"least(CAST(floor(({lng} + 180.0) / 360.0 * {1 << lng_bits}) AS BIGINT), {(1 << lng_bits) - 1})"
    terms = []
    for i in range(nbits):
        src, width = (lo, lng_bits) if i % 2 == 0 else (la, lat_bits)
        terms.append(f"(((({src}) >> {width - 1 - i // 2}) & 1) << {nbits - 1 - i})")
    code = "(" + " + ".join(terms) + ")"
    chars = " || ".join(
        f"substr('0123456789bcdefghjkmnpqrstuvwxyz', CAST(((({code}) >> {5 * (precision - 1 - j)}) & 31) + 1 AS INTEGER), 1)"
        for j in range(precision))
    return (f"(CASE WHEN {lat} BETWEEN -90.0 AND 90.0 AND {lng} BETWEEN -180.0 AND 180.0 "
            f"THEN {chars} END)")


def hashing_tf_bucket(e: str, n: int) -> str:
    """The index that Spark's ``HashingTF`` gives a VARCHAR expression, in DuckDB SQL:
    32-bit Murmur3 of its UTF-8 bytes (seed 42), modulo ``n``."""
    m = 4294967296

    def mul(a: str, b: int) -> str:
        return f"(({a}) * CAST({b} AS UBIGINT) % {m})"

    def rotl(a: str, r: int) -> str:
        return f"((({a}) << {r}) % {m} | (({a}) >> {32 - r}))"

    def byte(pos: str) -> str:
        return f"CAST('0x' || substr(hex({e}), 2 * ({pos}) + 1, 2) AS UBIGINT)"

    def mixed(k: str) -> str:  # with an inner list so that each step is written once
        step1 = f"list_transform([{k}], lambda k0: {mul('k0', 3432918353)})"
        step2 = f"list_transform({step1}, lambda k1: {rotl('k1', 15)})"
        return f"list_transform({step2}, lambda k2: {mul('k2', 461845907)})[1]"

    block = " + ".join(f"{byte(f'4 * i + {j}')} * {256**j}" for j in range(4))
    blocks = f"list_transform(range(0, strlen({e}) // 4), lambda i: {mixed(block)})"
    step = (f"list_transform(list_transform([xor(h, k)], lambda x: {rotl('x', 13)}), "
            f"lambda y: (y * 5 + CAST(3864292196 AS UBIGINT)) % {m})[1]")
    body = f"list_reduce({blocks}, lambda h, k: {step}, CAST(42 AS UBIGINT))"
    full = f"strlen({e}) // 4 * 4"
    tail = " + ".join(f"(CASE WHEN strlen({e}) > {full} + {j} THEN {byte(f'{full} + {j}')} * {256**j} ELSE 0 END)" for j in range(3))
    h = f"[xor(xor({body}, {mixed(f'CAST({tail} AS UBIGINT)')}), CAST(strlen({e}) AS UBIGINT))]"
    for shift, factor in ((16, 2246822507), (13, 3266489909), (16, None)):
        h = f"list_transform({h}, lambda z: xor(z, z >> {shift}))"
        if factor:
            h = f"list_transform({h}, lambda z: {mul('z', factor)})"
    signed = f"(CAST({h}[1] AS BIGINT) + 2147483648) % {m} - 2147483648"
    return f"((({signed}) % {n} + {n}) % {n})"
