"""Zstandard with raw-content dictionaries, for the two operators that classify by compressed length."""

from __future__ import annotations

from collections.abc import Iterator

import zstandard


#: Folds ASCII letters to lower case and all other ASCII characters to spaces; bytes of other letters stay.
LETTERS_ONLY = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


class Coder:
    """Compressed lengths of texts given what a dictionary holds."""

    def __init__(self, content: bytes, level: int = 3, window_log: int = 17):
        if len(content) < 8:
            content = content.ljust(8)
        parameters = zstandard.ZstdCompressionParameters.from_level(level, window_log=window_log, min_match=4, write_content_size=0, write_checksum=0, write_dict_id=0)
        data = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        data.precompute_compress(compression_params=parameters)
        self._compressor = zstandard.ZstdCompressor(dict_data=data, compression_params=parameters)

    def size(self, piece: bytes) -> int:
        return len(self._compressor.compress(piece))

    def sizes(self, pieces: list[bytes]) -> list[int]:
        compress = self._compressor.compress
        return [len(compress(x)) for x in pieces]


def windows(text: bytes, width: int) -> Iterator[bytes]:
    """The whole text in pieces of about ``width`` bytes that end at white space where there is any near."""
    at, n = 0, len(text)
    while at < n:
        to = at + width
        if to < n:
            space = max(text.rfind(b" ", at + width // 2, to), text.rfind(b"\n", at + width // 2, to))
            to = space + 1 if space >= 0 else to
        yield text[at:to]
        at = to
