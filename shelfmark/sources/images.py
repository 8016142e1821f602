"""Images as bytes: their kind, their size from the header, and whether a flyer page can be in them. Nothing is decoded."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructType

# What a flyer's page has at least, and the kinds that are taken.
LEAST_BYTES, LEAST_SIDE = 10_000, 300
KINDS = ("image/jpeg", "image/png", "image/webp")

#: JPEG markers that stand alone, and those of a frame's header, which has the size.
ALONE = {0x01, *range(0xD0, 0xDA)}
FRAMES = set(range(0xC0, 0xD0)) - {0xC4, 0xC8, 0xCC}


def kind_of(data: bytes) -> str | None:
    if data[:3] == b"\xff\xd8\xff":
        return "image/jpeg"
    if data[:8] == b"\x89PNG\r\n\x1a\n":
        return "image/png"
    return "image/webp" if data[:4] == b"RIFF" and data[8:12] == b"WEBP" else None


def _jpeg(data: bytes) -> tuple[int, int] | None:
    """Segment by segment to the first frame header."""
    at = 2
    while at + 4 <= len(data):
        if data[at] != 0xFF:
            return None
        marker = data[at + 1]
        if marker == 0xFF:  # fill
            at += 1
        elif marker in ALONE:
            at += 2
        elif marker in FRAMES:
            if at + 9 > len(data):
                return None
            return int.from_bytes(data[at + 7 : at + 9]), int.from_bytes(data[at + 5 : at + 7])
        else:
            at += 2 + int.from_bytes(data[at + 2 : at + 4])
    return None


def _webp(data: bytes) -> tuple[int, int] | None:
    """The first chunk: lossy, lossless or extended."""
    kind, body = data[12:16], data[20:]
    if kind == b"VP8 " and len(body) >= 10 and body[3:6] == b"\x9d\x01\x2a":
        return int.from_bytes(body[6:8], "little") & 0x3FFF, int.from_bytes(body[8:10], "little") & 0x3FFF
    if kind == b"VP8L" and len(body) >= 5 and body[0] == 0x2F:
        bits = int.from_bytes(body[1:5], "little")
        return (bits & 0x3FFF) + 1, (bits >> 14 & 0x3FFF) + 1
    if kind == b"VP8X" and len(body) >= 10:
        return int.from_bytes(body[4:7], "little") + 1, int.from_bytes(body[7:10], "little") + 1
    return None


def size_of(data: bytes) -> tuple[int, int] | None:
    """Width and height by the header; None for what is no image of a known kind, or ends too early."""
    kind = kind_of(data)
    if kind == "image/png":
        return (int.from_bytes(data[16:20]), int.from_bytes(data[20:24])) if len(data) >= 24 and data[12:16] == b"IHDR" else None
    return _jpeg(data) if kind == "image/jpeg" else _webp(data) if kind == "image/webp" else None


def fault_of(data: bytes, content_type: str | None) -> str | None:
    """Why fetched bytes are no flyer's page, or None."""
    kind = (content_type or "").split(";")[0].strip().lower()
    if kind and not kind.startswith("image/"):
        return f"non-image content-type: {kind}"
    size = size_of(data)
    if size is None:
        return f"unsupported image magic: {kind_of(data)}"
    if len(data) < LEAST_BYTES or min(size) < LEAST_SIDE:
        return f"implausibly small flyer image: {len(data)} bytes, {size[0]} x {size[1]}"
    return None


@F.pandas_udf(StructType().add("width", LongType()).add("height", LongType()))
def _sizes(content: pd.Series) -> pd.DataFrame:
    found = [(size_of(bytes(c)) if c is not None else None) or (None, None) for c in content]
    return pd.DataFrame(found, columns=["width", "height"], dtype="Int64")


def image_size(content: Column) -> Column:
    """struct(width, height), null where the header has none."""
    return _sizes(content)
