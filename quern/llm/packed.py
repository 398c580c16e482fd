"""Arrays of unsigned numbers as compressed bytes, for rows that carry many of them."""

from __future__ import annotations

import numpy as np
import pyarrow as pa


def packed(arrays: list[np.ndarray]) -> bytes:
    """Equal bytes of neighbouring numbers side by side, then compressed: high bytes of small numbers cost nothing."""
    head = np.array([x for a in arrays for x in (a.itemsize, len(a))], np.uint64).tobytes()
    planes = b"".join(np.ascontiguousarray(np.ascontiguousarray(a).view(np.uint8).reshape(-1, a.itemsize).T).tobytes() for a in arrays)
    raw = len(arrays).to_bytes(8, "little") + head + planes
    return len(raw).to_bytes(8, "little") + pa.Codec("zstd", compression_level=1).compress(raw, asbytes=True)


def unpacked(data: bytes) -> list[np.ndarray]:
    raw = pa.Codec("zstd").decompress(data[8:], int.from_bytes(data[:8], "little"), asbytes=True)
    count = int.from_bytes(raw[:8], "little")
    head = np.frombuffer(raw, np.uint64, 2 * count, 8).astype(int)
    place, out = 8 + 16 * count, []
    for size, n in zip(head[::2], head[1::2], strict=True):
        planes = np.frombuffer(raw, np.uint8, size * n, place).reshape(size, n)
        out.append(np.ascontiguousarray(planes.T).view(f"<u{size}").ravel() if n else np.empty(0, f"<u{size}"))
        place += size * n
    return out
