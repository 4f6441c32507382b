"""Helpers on frames that the operators share."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The six separators of words: space, and tab to carriage return.
SEPARATORS = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def pick(docs: DataFrame, *names: str) -> DataFrame:
    """The named columns, found by exact name; of several with one name the first. Other columns, whatever they
    are called, stay out of the way."""
    positions = [docs.columns.index(n) for n in names]
    plain = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])
    return plain.select(*[F.col(f"c{p}").alias(n) for p, n in zip(positions, names, strict=True)])


def kept_columns(docs: DataFrame, added: tuple[str, ...]) -> tuple[DataFrame, list[str], list[str]]:
    """`docs` under names c0, c1, ... that clash with nothing; the internal and the outer names of the columns to
    return. An input column named like an added one gives way to it."""
    inner = [f"c{i}" for i in range(len(docs.columns))]
    outer = list(docs.columns)
    keep = [i for i, n in enumerate(outer) if n not in added and n not in outer[:i]]
    return docs.toDF(*inner), [inner[i] for i in keep], [outer[i] for i in keep]


def ascii_lower(text: Column) -> Column:
    """A-Z lowered and nothing else, unlike `lower`."""
    return F.translate(text, UPPER, LOWER)


def hash_unit(*parts: Column) -> Column:
    """52 bits of MD5 over the parts as a whole number below 2^52; nulls count as empty."""
    joined = F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts])
    return F.conv(F.substring(F.md5(joined.cast("binary")), 1, 13), 16, 10).cast("long")


def byte_view(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of an Arrow column of texts in one array, and where each text starts; nulls are empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = pc.fill_null(texts.cast(pa.large_binary()), b"")
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    if data is None or not len(texts):
        return np.zeros(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def in_blocks(batches: Iterator[pa.RecordBatch], most_bytes: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """Arrow batches cut to runs of rows with about `most_bytes` of column `text`; a longer text has its own block."""
    for batch in batches:
        lengths = pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy(zero_copy_only=False)
        start = size = 0
        for row, n in enumerate(lengths.tolist()):
            if size and size + n > most_bytes:
                yield batch.slice(start, row - start)
                start, size = row, 0
            size += n
        if batch.num_rows > start:
            yield batch.slice(start)
