"""Exchange between homes (groups of documents) and buckets (ranges of hash values).

What all documents know about a key - an anchor, an n-gram - has to meet in one place, and the answer has to return to
every document with that key. Documents are therefore dealt into homes by document id. A home combines equal keys and
sends each bucket one packed block; a bucket answers each home with one packed block. A key that a third of all
documents hold is one entry for each home, not one for each document, so no bucket grows with the copies.

Blocks are columns of numbers, transposed to byte planes and compressed: sorted hashes and small numbers shrink.
"""

from __future__ import annotations

import math
import struct
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

HOME, BUCKET, BLOCK = "__home", "__bucket", "__block"
#: One block from a home to a bucket or back.
BLOCKS = f"{BUCKET} int, {HOME} int, {BLOCK} binary"
_ARROW = pa.schema([(BUCKET, pa.int32()), (HOME, pa.int32()), (BLOCK, pa.binary())])


def pack(*columns: np.ndarray) -> bytes:
    out = [struct.pack("<H", len(columns))]
    for c in columns:
        c = np.ascontiguousarray(c)
        kind = c.dtype.str.encode()
        out.append(struct.pack("<B", len(kind)) + kind + struct.pack("<Q", len(c)))
        out.append(np.ascontiguousarray(c.view(np.uint8).reshape(len(c), c.dtype.itemsize).T).tobytes() if len(c) else b"")
    return zstandard.ZstdCompressor(level=1).compress(b"".join(out))


def unpack(block: bytes) -> list[np.ndarray]:
    data, out = zstandard.ZstdDecompressor().decompress(block), []
    at = 2
    for _ in range(struct.unpack_from("<H", data)[0]):
        wide = data[at]
        kind = np.dtype(data[at + 1:at + 1 + wide].decode())
        n = struct.unpack_from("<Q", data, at + 1 + wide)[0]
        at += 9 + wide
        planes = np.frombuffer(data, np.uint8, n * kind.itemsize, at).reshape(kind.itemsize, n)
        out.append(np.ascontiguousarray(planes.T).reshape(-1).view(kind))
        at += n * kind.itemsize
    return out


def gather(table: pa.Table) -> tuple[np.ndarray, list[list[np.ndarray]]]:
    """The homes (or buckets' rows) of a group and their unpacked blocks, ordered so that reruns agree."""
    order = np.lexsort((table[BUCKET].to_numpy(), table[HOME].to_numpy()))
    blocks = table[BLOCK]
    return table[HOME].to_numpy()[order], [unpack(blocks[int(i)].as_py()) for i in order]


def blocks_table(rows: Iterable[tuple[int, int, bytes]]) -> pa.Table:
    rows = list(rows)
    columns = zip(*rows, strict=True) if rows else ([], [], [])
    return pa.Table.from_arrays([pa.array(list(c), f.type) for c, f in zip(columns, _ARROW, strict=True)], schema=_ARROW)


def bucket_count(docs: DataFrame) -> int:
    """A power of two, at least twice the shuffle partitions, so that buckets spread over all of them."""
    return 1 << max(1, math.ceil(math.log2(2 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))))


def to_buckets(home: int, keys: np.ndarray, columns: list[np.ndarray], buckets: int,
               all_buckets: bool = False) -> list[tuple[int, int, bytes]]:
    """Blocks of sorted 64-bit keys and their columns, cut by the keys' highest bits."""
    shift = np.uint64(64 - (buckets.bit_length() - 1))
    cuts = np.searchsorted(keys, np.arange(buckets, dtype=np.uint64) << shift).tolist() + [len(keys)]
    return [(b, home, pack(keys[x:y], *(c[x:y] for c in columns)))
            for b, (x, y) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)) if y > x or all_buckets]


def with_homes(docs: DataFrame, home_bytes: int, like: DataFrame | None = None, by: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Rows dealt by doc_id, or the columns `by`, into homes of about home_bytes of text each; `like`, if given, has the texts.

    The number of homes follows from the total size of all texts. Every use of the result in one plan reads the same
    exchange.
    """
    total = (like or docs).agg(F.sum(F.octet_length("text"))).first()[0] or 0
    homes = max(1, math.ceil(total / home_bytes))
    return docs.withColumn(HOME, F.pmod(F.xxhash64(*by), F.lit(homes)).cast("int"))


def spread(blocks: DataFrame) -> DataFrame:
    """Blocks dealt by bucket over all shuffle partitions. Their work is not in proportion to their few bytes, so the
    number is given, and adaptive execution leaves it."""
    return blocks.repartition(int(blocks.sparkSession.conf.get("spark.sql.shuffle.partitions")), BUCKET)
