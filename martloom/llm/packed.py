"""Columns of whole numbers and of words as compressed bytes, for rows that stand for many values."""

from __future__ import annotations

import numpy as np
import zstandard


def pack_ints(values: np.ndarray) -> bytes:
    """Whole numbers from 0 in little space: all lowest bytes, then the next ones, compressed."""
    planes = np.ascontiguousarray(values, dtype="<u8").view(np.uint8).reshape(-1, 8).T
    used = 8 if not len(values) else max(1, (int(values.max()).bit_length() + 7) // 8)
    return bytes([used]) + zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(planes[:used]).tobytes())


def unpack_ints(packed: bytes) -> np.ndarray:
    used = packed[0]
    data = np.frombuffer(zstandard.ZstdDecompressor().decompress(packed[1:]), dtype=np.uint8)
    planes = data.reshape(used, -1)
    out = np.zeros((planes.shape[1], 8), dtype=np.uint8)
    out[:, :used] = planes.T
    return out.view("<u8").ravel().astype(np.int64)


def pack_words(words: list[bytes]) -> tuple[bytes, bytes]:
    """The words in a row, and their lengths."""
    sizes = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    return zstandard.ZstdCompressor(level=1).compress(b"".join(words)), pack_ints(sizes)


def unpack_words(body: bytes, sizes: bytes) -> list[bytes]:
    data = zstandard.ZstdDecompressor().decompress(body)
    ends = np.cumsum(unpack_ints(sizes)).tolist()
    return [data[a:b] for a, b in zip([0, *ends], ends)]
