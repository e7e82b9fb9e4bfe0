"""Pieces of SQL that several oracles share."""

from __future__ import annotations


def _nibble_table() -> list[int]:
    """Remainders of the 16 half bytes for the reflected polynomial of CRC-32."""
    out = []
    for n in range(16):
        for _ in range(4):
            n = n >> 1 ^ (0xEDB88320 if n & 1 else 0)
        out.append(n)
    return out


def crc32_sql(text: str) -> str:
    """Unsigned CRC-32 of a string's UTF-8 bytes, a half byte at a time."""
    digits = f"hex(encode({text}))"
    # low half of each byte first
    halves = f"list_transform(range(0, strlen({text}) * 2), lambda i: ('0x' || substr({digits}, 2 * (i // 2) + 2 - i % 2, 1))::BIGINT)"
    table = "[" + ", ".join(f"{x}::BIGINT" for x in _nibble_table()) + "]"
    step = f"lambda c, h: xor(c >> 4, {table}[((xor(c, h)) & 15) + 1])"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {halves}), {step}), 4294967295::BIGINT)"
