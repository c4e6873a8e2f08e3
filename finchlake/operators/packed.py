"""Arrays of numbers or bytes in one compressed string of bytes, for rows that hold much."""

from __future__ import annotations

import struct

import numpy as np
import pyarrow as pa

HEAD = "<2sqq"     # kind of the numbers, bytes before and after compression
LEVEL = 5


def packed(*arrays: np.ndarray | bytes, level: int = LEVEL) -> bytes:
    """Arrays of fractions or of numbers not below 0, these as narrow as they fit, or bytes; one after the other."""
    codec, out = pa.Codec("zstd", compression_level=level), []
    for a in arrays:
        kind = "u1"
        if isinstance(a, np.ndarray):
            kind = "f8" if a.dtype.kind == "f" else np.min_scalar_type(int(a.max()) if len(a) else 0).str[1:]
            a = a.astype(kind).tobytes()
        small = codec.compress(a, asbytes=True)
        out += [struct.pack(HEAD, kind.encode(), len(a), len(small)), small]
    return b"".join(out)


def unpacked(blob: bytes) -> list[np.ndarray]:
    codec, out, at, head = pa.Codec("zstd"), [], 0, struct.calcsize(HEAD)
    while at < len(blob):
        kind, size, small = struct.unpack_from(HEAD, blob, at)
        raw = codec.decompress(blob[at + head:at + head + small], decompressed_size=size) if size else b""
        out.append(np.frombuffer(raw, dtype=kind.decode()))
        at += head + small
    return out
