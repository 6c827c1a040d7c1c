"""Document fingerprints from prefix polynomial hashes.

A text's code points are summed up as a polynomial, modulo two primes below 2**31, and the sums of all prefixes are
kept: two modular arrays. The hash of any span is then a difference of two entries, divided by a power of the base. So
spans of any length, of one text or two, are compared in constant time; the longest common extension of two places is a
binary search over lengths; and spans of an edited text, which is put together from two texts, have hashes that are put
together from theirs.

A fingerprint is the hash of the whole text and a sketch: all spans of `width` code points are dealt into slots by their
hash, and each slot keeps a byte of its smallest. The share of equal bytes estimates how many of their spans two texts have in common;
likeness is that as twice the common part over the sum of both (Dice).

Each document is paired with the next one of a global order. Texts move once, into ranges of that order; a range is read
row by row, holding two texts, and the pairs across ranges are made from one first and one last row a range.

Cases: null text is empty; texts shorter than a span are one span; empty texts are alike, and unlike any other. The
order is descending doc_id, null ids last, then the text's hash; repeated rows follow each other. A single document is
its own next one. An empty table gives an empty result; further columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hazeworks.llm.saving import saved

U = np.uint64
#: Primes and bases of the two arrays.
_FIELDS = ((2147483647, 1103515245), (2147483629, 1566083941))
_powers: list[tuple[np.ndarray, np.ndarray]] = []


def powers(n: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each field the powers 0..n of the base and of its inverse."""
    if not _powers or len(_powers[0][0]) <= n:
        _powers.clear()
        for prime, base in _FIELDS:
            both = []
            for b in (base, pow(base, -1, prime)):
                p = np.ones(1, U)
                while len(p) <= n:
                    p = np.concatenate([p, p * U(pow(b, len(p), prime)) % U(prime)])
                both.append(p)
            _powers.append((both[0], both[1]))
    return _powers


class Prefixes:
    """The modular prefix arrays of a text."""

    def __init__(self, text: str):
        points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(U) + U(1)
        self.n = len(points)
        self.sums = []
        for (prime, _), (up, _) in zip(_FIELDS, powers(self.n + 1), strict=True):
            sums = np.zeros(self.n + 1, U)
            np.cumsum(points * up[:self.n] % U(prime), out=sums[1:])
            self.sums.append(sums % U(prime))

    def field(self, which: int, start, end):
        """The hash in one field, of arrays of spans or of one."""
        prime = U(_FIELDS[which][0])
        sums, down = self.sums[which], powers(self.n + 1)[which][1]
        return (sums[end] + prime - sums[start]) % prime * down[start] % prime

    def spans(self, start, end):
        """62 bits for each span [start, end)."""
        return self.field(0, start, end) << U(31) | self.field(1, start, end)

    def extension(self, start: np.ndarray, other: Prefixes, other_start: np.ndarray) -> np.ndarray:
        """For places of both texts, how many code points from there on are equal: a binary search over lengths."""
        start, other_start = np.asarray(start, np.int64), np.asarray(other_start, np.int64)
        least = np.zeros(len(start), np.int64)
        most = np.minimum(self.n - start, other.n - other_start)
        while np.any(least < most):
            middle = (least + most + 1) // 2
            same = self.spans(start, start + middle) == other.spans(other_start, other_start + middle)
            least, most = np.where(same, middle, least), np.where(same, most, middle - 1)
        return least


def joined(first: Prefixes, start, end, second: Prefixes, length):
    """Hashes of the spans [start, end) of one text followed by the first `length` code points of another."""
    out = []
    for which, (prime, _) in enumerate(_FIELDS):
        up = powers(max(first.n, second.n) + 1)[which][0]
        out.append((first.field(which, start, end) + up[end - start] * second.field(which, np.zeros_like(length), length)) % U(
            prime))
    return out[0] << U(31) | out[1]


def scattered(values: np.ndarray) -> np.ndarray:
    """Spread the bits (with the constants of the SplitMix64 finalizer)."""
    x = (values ^ (values >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


_NONE = U(0xFFFFFFFFFFFFFFFF)


def smallest(spans: np.ndarray, slots: int) -> np.ndarray:
    """The smallest value of each slot."""
    out = np.full(slots, _NONE, U)
    values = scattered(spans)
    np.minimum.at(out, (values % U(slots)).astype(np.int64), values // U(slots))
    return out


def sketch(least: np.ndarray) -> bytes:
    """A byte of each slot's smallest value; 0 for an empty slot."""
    return np.where(least == _NONE, U(0), least % U(255) + U(1)).astype(np.uint8).tobytes()


def likeness(a: bytes, b: bytes) -> float:
    """Of two fingerprints: 1 for equal ones, else from the share of slots that agree beyond chance."""
    if a == b:
        return 1.0
    x, y = np.frombuffer(a, np.uint8)[8:], np.frombuffer(b, np.uint8)[8:]
    used = int(((x > 0) | (y > 0)).sum())
    if not used:
        return 0.0
    share = max(0.0, (int(((x == y) & (x > 0)).sum()) / used - 1 / 255) / (1 - 1 / 255))
    return 2 * share / (1 + share)


class Document:
    """A text with its prefix arrays, span hashes and fingerprint."""

    def __init__(self, doc_id: int | None, text: str, width: int, slots: int):
        self.doc_id, self.text, self.width, self.slots = doc_id, text, width, slots
        self.prefixes = Prefixes(text)
        n = self.prefixes.n
        at = np.arange(max(0, n - width + 1))
        self.spans = self.prefixes.spans(at, at + width)
        self.kept = n - n // 3
        inside = max(0, self.kept - width + 1)  # spans of the part that an edit keeps
        self.kept_least = smallest(self.spans[:inside], slots)
        least = np.minimum(self.kept_least, smallest(self.spans[inside:], slots))
        whole = self.prefixes.spans(0, n)
        if 0 < n < width:
            least = smallest(np.array([whole], U), slots)
        self.fingerprint = int(whole).to_bytes(8, "big") + sketch(least)

    def edited(self, following: Document) -> tuple[str, bytes, int]:
        """The edited text, its fingerprint, and how many code points it has in common with the text from the start."""
        kept, taken, width = self.kept, min(self.prefixes.n - self.kept, following.prefixes.n), self.width
        text = self.text[:kept] + following.text[:taken]
        least = np.minimum(self.kept_least, smallest(following.spans[:max(0, taken - width + 1)], self.slots))
        start = np.arange(max(0, kept - width + 1), min(kept, kept + taken - width + 1))  # spans across the joint
        if len(start):
            crossing = joined(self.prefixes, start, np.full(len(start), kept), following.prefixes, start + width - kept)
            least = np.minimum(least, smallest(crossing, self.slots))
        whole = joined(self.prefixes, np.zeros(1, np.int64), np.array([kept]), following.prefixes, np.array([taken]))
        if 0 < kept + taken < width:
            least = smallest(whole, self.slots)
        same = int(self.prefixes.extension([kept], following.prefixes, [0])[0])
        return text, int(whole[0]).to_bytes(8, "big") + sketch(least), kept + min(same, taken)


_PAIR = ("n_chars long, edited_sha256 binary, fingerprint binary, edited_fingerprint binary, near_edited double, "
         "near_next double, common_edited long, common_next long")
_FIELDS_OUT = ["doc_id", *[c.split()[0] for c in _PAIR.split(", ")]]


def compared(own: Document, following: Document) -> tuple:
    text, fingerprint, common = own.edited(following)
    return (own.doc_id, own.prefixes.n, hashlib.sha256(text.encode("utf-8", "surrogatepass")).digest(), own.fingerprint,
            fingerprint, likeness(own.fingerprint, fingerprint), likeness(own.fingerprint, following.fingerprint), common,
            int(own.prefixes.extension([0], following.prefixes, [0])[0]))


_TYPES = [pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary(), pa.float64(), pa.float64(), pa.int64(), pa.int64()]


def columns(rows: list[tuple], types: list[pa.DataType], names: list[str]) -> pa.RecordBatch:
    values = zip(*rows, strict=True) if rows else ((),) * len(types)
    return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(values, types, strict=True)], names)


def along(width: int, slots: int) -> Callable:
    """Over the sorted rows of a range: every row with the next; the range's first and last row as texts."""
    names, types = [*_FIELDS_OUT, "edge", "part", "text"], [*_TYPES, pa.string(), pa.int32(), pa.string()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, part, nothing = None, TaskContext.get().partitionId(), (None,) * (len(_TYPES) - 1)
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                following = Document(doc_id, text or "", width, slots)
                if own is None:
                    rows.append((doc_id, *nothing, "first", part, following.text))
                else:
                    rows.append((*compared(own, following), None, None, None))
                own = following
            yield columns(rows, types, names)
        if own is not None:
            yield columns([(own.doc_id, *nothing, "last", part, own.text)], types, names)

    return run


def across(width: int, slots: int) -> Callable:
    """Over rows with a text and the next one's."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = zip(*[batch.column(c).to_pylist() for c in ("doc_id", "text", "next_text")], strict=True)
            yield columns([compared(Document(i, a, width, slots), Document(None, b, width, slots)) for i, a, b in rows],
                          _TYPES, _FIELDS_OUT)

    return run


def fingerprints(docs: DataFrame, width: int = 20, slots: int = 128) -> DataFrame:
    """Per document: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next (see the
    module), and common_edited and common_next: how many code points the edited text and the next one's share with the
    document's from the start."""
    ranges = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # Rows of one id and text are told apart by where they were read, so that they too can be in several ranges.
    order = [F.desc_nulls_last("doc_id"), F.asc("__hash"), F.asc("__row")]
    placed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("__hash"),
                         F.monotonically_increasing_id().alias("__row"))
    sorted_ = placed.repartitionByRange(ranges, *order).sortWithinPartitions(*order).select("doc_id", "text")
    # Saved, as ranges that were computed again may have other borders.
    rows = saved(sorted_.mapInArrow(along(width, slots), f"doc_id long, {_PAIR}, edge string, part int, text string"))
    firsts = rows.where("edge = 'first'").select(F.col("part").alias("next_part"), F.col("text").alias("next_text"))
    lasts = rows.where("edge = 'last'").select("part", "doc_id", "text")
    parts = lasts.select("part")  # a number for each range
    after = parts.select("part", F.coalesce(
        F.lead("part").over(Window.orderBy("part")), F.min("part").over(Window.partitionBy())).alias("next_part"))
    pairs = lasts.join(after, "part").join(firsts, "next_part").select("doc_id", "text", "next_text")
    every = rows.where("edge IS NULL").select(*_FIELDS_OUT).unionByName(
        pairs.mapInArrow(across(width, slots), f"doc_id long, {_PAIR}"))
    return every.withColumns({c: F.lower(F.hex(c)) for c in ("edited_sha256", "fingerprint", "edited_fingerprint")})
