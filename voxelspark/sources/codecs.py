"""Chunk codecs: gzip, zlib, zstd, and the Blosc container with byte or bit shuffle; CRC-32C."""

from __future__ import annotations

import gzip
import struct
import zlib

import numpy as np

#: Compressors by their number in a Blosc header.
BLOSC_COMPRESSORS = ("blosclz", "lz4", "snappy", "zlib", "zstd")


def _crc_table() -> list[int]:
    """Of the Castagnoli polynomial, reflected."""
    out = []
    for n in range(256):
        for _ in range(8):
            n = n >> 1 ^ (0x82F63B78 if n & 1 else 0)
        out.append(n)
    return out


_CRC = _crc_table()


def crc32c(data: bytes) -> int:
    crc = 0xFFFFFFFF
    for b in data:
        crc = _CRC[(crc ^ b) & 255] ^ crc >> 8
    return crc ^ 0xFFFFFFFF


def _zstd(data: bytes) -> bytes:
    import zstandard

    return zstandard.ZstdDecompressor().decompressobj().decompress(data)


def _unpack(data: bytes, name: str, size: int) -> bytes:
    if name == "zstd":
        return _zstd(data)
    if name == "zlib":
        return zlib.decompress(data)
    if name in ("lz4", "snappy"):
        import pyarrow as pa

        return pa.decompress(data, size, "lz4_raw" if name == "lz4" else name, asbytes=True)
    raise ValueError(f"Blosc compressor {name} is not supported")


def _unshuffle(block: bytes, size: int, bits: bool) -> bytes:
    """Elements of ``size`` bytes from planes of their bytes, or of their bits. What does not fill whole elements (of bits:
    groups of eight) stands as it is."""
    n = len(block) // size
    if bits and n % 8:
        return block
    data = np.frombuffer(block[: n * size], np.uint8)
    if bits:
        planes = np.unpackbits(data.reshape(8 * size, n // 8), axis=1, bitorder="little")
        whole = np.packbits(planes.T, axis=1, bitorder="little")
    else:
        whole = data.reshape(size, n).T
    return np.ascontiguousarray(whole).tobytes() + block[n * size :]


def _shuffle_bits(data: bytes, size: int) -> bytes:
    n = len(data) // size
    if n % 8:
        return data
    bits = np.unpackbits(np.frombuffer(data[: n * size], np.uint8).reshape(n, size), axis=1, bitorder="little")
    return np.packbits(np.ascontiguousarray(bits.T), axis=1, bitorder="little").tobytes() + data[n * size :]


def blosc_decode(data: bytes) -> bytes:
    """The contents of a Blosc (version 1) buffer."""
    _, _, flags, size, n_bytes, block_bytes, n_stored = struct.unpack_from("<BBBBIII", data)
    if n_stored > len(data):
        raise ValueError("the Blosc buffer is cut")
    if flags & 2:  # stored as it is
        return data[16 : 16 + n_bytes]
    name = BLOSC_COMPRESSORS[flags >> 5]
    n_blocks = -(-n_bytes // block_bytes) if n_bytes else 0
    starts = struct.unpack_from(f"<{n_blocks}I", data, 16)
    out = []
    for k, at in enumerate(starts):
        own = min(block_bytes, n_bytes - k * block_bytes)
        splits = size if not flags & 0x10 and own == block_bytes else 1
        parts = []
        for _ in range(splits):
            (stored,) = struct.unpack_from("<i", data, at)
            part = data[at + 4 : at + 4 + stored]
            parts.append(part if stored == own // splits else _unpack(part, name, own // splits))
            at += 4 + stored
        block = b"".join(parts)
        if flags & 4:
            block = _unshuffle(block, size, True)
        elif flags & 1 and size > 1:
            block = _unshuffle(block, size, False)
        out.append(block)
    return b"".join(out)


def blosc_encode(data: bytes, size: int, level: int = 5) -> bytes:
    """A Blosc buffer of one block, with bit shuffle and zstd."""
    import zstandard

    packed = zstandard.ZstdCompressor(level=level).compress(_shuffle_bits(data, size))
    if len(packed) + 24 >= len(data) + 16:
        return struct.pack("<BBBBIII", 2, 1, 4 << 5 | 0x10 | 2, size, len(data), len(data), len(data) + 16) + data
    return struct.pack("<BBBBIIIIi", 2, 1, 4 << 5 | 0x10 | 4, size, len(data), len(data), len(packed) + 24, 20, len(packed)) + packed


def decode(data: bytes, codec: str) -> bytes:
    if not codec:
        return data
    if codec == "gzip":
        return gzip.decompress(data)
    if codec == "zlib":
        return zlib.decompress(data)
    if codec == "zstd":
        return _zstd(data)
    if codec == "blosc":
        return blosc_decode(data)
    raise ValueError(f"codec {codec} is not supported")


def encode(data: bytes, codec: str, size: int, level: int = 5) -> bytes:
    if codec == "zstd":
        import zstandard

        return zstandard.ZstdCompressor(level=level).compress(data)
    if codec == "blosc":
        return blosc_encode(data, size, level)
    if not codec:
        return data
    raise ValueError(f"codec {codec} is not written")
