"""Images and models behind small seams: header parsing, and batch calls to injected clients."""

from __future__ import annotations

import struct
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, FloatType, StructType

from ..schemas import schema


def header(data: bytes | None) -> tuple[str | None, int | None, int | None]:
    """(type, width, height) of a PNG, GIF, JPEG or BMP from its header; nulls if it is none."""
    d = data or b""
    if d[:8] == b"\x89PNG\r\n\x1a\n" and len(d) >= 24:
        return "image/png", *struct.unpack(">II", d[16:24])
    if d[:6] in (b"GIF87a", b"GIF89a") and len(d) >= 10:
        return "image/gif", *struct.unpack("<HH", d[6:10])
    if d[:2] == b"BM" and len(d) >= 26:
        w, h = struct.unpack("<ii", d[18:26])
        return "image/bmp", w, abs(h)
    if d[:3] == b"\xff\xd8\xff":
        at = 2
        while at + 9 < len(d):
            if d[at] != 0xFF:
                break
            kind = d[at + 1]
            if kind == 0xFF:
                at += 1
            elif 0xC0 <= kind <= 0xCF and kind not in (0xC4, 0xC8, 0xCC):
                h, w = struct.unpack(">HH", d[at + 5 : at + 9])
                return "image/jpeg", w, h
            else:
                at += 2 + struct.unpack(">H", d[at + 2 : at + 4])[0]
        return "image/jpeg", None, None
    return None, None, None


@F.pandas_udf(schema("mime string, width bigint, height bigint"))
def inspect(data: pd.Series) -> pd.DataFrame:
    """Type and size of images, by their headers."""
    return pd.DataFrame([header(x) for x in data], columns=["mime", "width", "height"])


def call_model(rows: DataFrame, prompt: str, client: Callable[[list[str]], list[str | None]], reply: str = "reply", batch: int = 32) -> DataFrame:
    """``rows`` with a model's reply to each prompt; ``client`` answers a batch, with None for a failure, which passes the row on without one."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            said: list[str | None] = []
            for at in range(0, len(f), batch):
                part = f[prompt].iloc[at : at + batch].tolist()
                try:
                    got = client(part)
                except Exception:  # a failed call is a row without a reply, by contract
                    got = [None] * len(part)
                said += got
            yield f.assign(**{reply: said})

    return rows.mapInPandas(run, StructType([*rows.schema.fields]).add(reply, "string"))


def call_once(rows: DataFrame, keys: list[str], prompt: str, client: Callable[[list[str]], list[str | None]], reply: str = "reply") -> DataFrame:
    """The same, asking once for each distinct key and joining the replies back."""
    asked = rows.groupBy(*keys).agg(F.min(prompt).alias("_prompt"))
    asked = call_model(asked, "_prompt", client, reply).drop("_prompt")
    return rows.join(asked, keys, "left")


def embed(rows: DataFrame, text: str, backend: Callable[[list[str]], list[list[float]]], size: int, vector: str = "embedding", batch: int = 16) -> DataFrame:
    """``rows`` with the vectors that ``backend`` gives; one of another length stops the query."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            made: list[list[float]] = []
            for at in range(0, len(f), batch):
                made += backend(f[text].iloc[at : at + batch].tolist())
            if any(len(v) != size for v in made):
                raise ValueError("vector of another length")
            yield f.assign(**{vector: made})

    return rows.mapInPandas(run, _with(rows, vector))


def _with(rows: DataFrame, vector: str):
    return StructType([*rows.schema.fields]).add(vector, ArrayType(FloatType()))
