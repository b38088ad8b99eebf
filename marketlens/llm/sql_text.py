"""Pieces of DuckDB SQL for the queries of this subpackage."""

#: Unsigned CRC-32 of an ASCII text; ``.format`` puts the text's expression in.
CRC32 = ("xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split({0}, ''), lambda x: ascii(x)::BIGINT)), "
         "lambda c, b: xor(c >> 8, list_reduce(list_prepend(xor(c, b) & 255, [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]), "
         "lambda d, i: CASE WHEN d & 1 = 1 THEN xor(d >> 1, 3988292384::BIGINT) ELSE d >> 1 END))), 4294967295::BIGINT)")
