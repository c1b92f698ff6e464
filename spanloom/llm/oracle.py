"""DuckDB expressions that the operators' SQL shares."""


def crc_sql(text: str) -> str:
    """Unsigned CRC-32 of an ASCII text that isn't empty."""
    codes = f"list_transform(string_split({text}, ''), lambda c: ord(c)::BIGINT)"
    step = "list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, z: xor(x >> 1, 3988292384 * (x & 1)))"
    return f"xor(list_reduce(list_concat([4294967295::BIGINT], {codes}), lambda c, b: {step}), 4294967295)"


def ascii_lower(text: str) -> str:
    return f"translate({text}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
