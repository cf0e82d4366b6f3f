"""What the operators share: narrow inputs and the split by document id."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from surveyloom.functions import quote

#: Fixed value: the white space of the text contracts, [\x20\x09-\x0D].
BLANKS = b" \t\n\x0b\x0c\r"


def texts_of(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, text as UTF-8 bytes); every other column is left behind, so none can clash."""
    return docs.select(quote(doc_id).alias("doc_id"), quote(text).cast("binary").alias("text"))


def fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; null for a null id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % folds


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le"), np.uint32)


def parts_of(text: str, points: np.ndarray, edges: np.ndarray) -> pa.LargeStringArray:
    """The parts of a text between places of its code points; the first place is 0, the last the end."""
    raw = text.encode()
    if len(raw) > len(points):
        sizes = np.ones(len(points), np.uint8)
        for more in (0x80, 0x800, 0x10000):
            sizes += points >= more
        edges = np.append(0, np.cumsum(sizes, dtype=np.int64))[edges]
    return pa.LargeStringArray.from_buffers(len(edges) - 1, pa.py_buffer(edges.astype(np.int64)), pa.py_buffer(raw))


def joined_ids(parts: pa.LargeStringArray, ids_of: Callable[[list[str]], list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """(ids of all parts one after the other, where each part's start and the last one's end).

    ``ids_of`` gets the distinct parts and gives their ids as 32-bit numbers.
    """
    coded = parts.dictionary_encode()
    raws = ids_of(coded.dictionary.to_numpy(zero_copy_only=False).tolist())
    ends = np.cumsum(np.fromiter(map(len, raws), np.int64, len(raws))) // 4
    flat = pa.array(np.frombuffer(b"".join(raws), np.uint32))
    lists = pa.LargeListArray.from_arrays(pa.array(np.append(0, ends)), flat).take(coded.indices)
    return lists.values.to_numpy(), lists.offsets.to_numpy()
