"""WARC archives of pages, and their capture index by external merge.

Writing: a record per page, payload the html in UTF-8. Of records with equal payloads of at least `least` bytes, the one
with the smallest page_id is a response, the others are revisits that refer to it; smaller payloads are always
responses. Records are text up to their last byte (the payload is), and two line ends close each record; so Spark's text
writer writes them, to whatever store the folder is in, one compressed archive per task.

Reading: Spark's text source cuts archives at record starts, and a task takes records one after another, so that an
archive may have any size; memory is bounded by the largest record. A payload that holds a record start is put together
again by its length. Payload digests are verified. Captures are sorted by URL key and timestamp in runs of bounded rows
and bytes, and the runs are stored as a Parquet table. Archives are parsed once; all that follows reads the runs.

Merging: every so many rows of each run are samples of its order, and bounds taken from them deal the runs into ranges of
(URL key, timestamp, page); a URL with very many captures is spread over ranges by time. What a run has in a range is
cut into blocks. Spark sorts blocks (not captures) by the capture that the block before ended with: just the order in
which a merge uses blocks up. A loser tree therefore takes its next block from the front of the stream, and a task
holds one block per run, whatever the range's size. Ranges in order are the capture histories of all URLs in order.

Cases: null html counts as empty, null url as an empty URL; control characters in a URL are percent-encoded in the
archive and restored; a null page_id is never smaller than another, and its record is a response; repeated rows are
records of their own, and none is a revisit of itself; an empty table gives an empty result. `offset` is a record's place
in its decompressed archive.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Callable, Iterable, Iterator
from urllib.parse import urlsplit

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CAPTURES = ("page_id bigint, url string, url_key string, captured string, payload_bytes bigint, payload_digest string, "
            "record_type string, refers_to bigint, archive string, offset bigint")
RUNS = CAPTURES + ", run bigint, place bigint"
BLOCKS = ("range int, run string, last boolean, after_key string, after_captured string, after_none boolean, "
          "after_page bigint, archive string, after_offset bigint, rows binary")
_END = "\r\n"
_START = b"WARC/1.1\r\n"
_NEXT = b"\r\n\r\n" + _START
_TYPES = {"bigint": pa.int64(), "int": pa.int32(), "boolean": pa.bool_(), "string": pa.string(), "binary": pa.binary()}


def _schema(columns: str) -> pa.Schema:
    return pa.schema([(name, _TYPES[kind]) for name, kind in (c.split() for c in columns.split(", "))])


_CAPTURES, _RUNS, _BLOCKS = _schema(CAPTURES), _schema(RUNS), _schema(BLOCKS)


def url_key(url: str) -> str:
    """The host's labels from the last to the first, then path and query, without scheme, port and fragment."""
    try:
        parts = urlsplit(url)
        host = (parts.hostname or "").removeprefix("www.")
    except ValueError:
        return url
    query = f"?{parts.query}" if parts.query else ""
    return ",".join(reversed(host.split("."))) + ")" + (parts.path or "/").lower() + query.lower()


def records(pages: DataFrame, least: int = 100, started: int = 1_600_000_000) -> DataFrame:
    """(record): the WARC record of each page. A page without a capture time counts as taken page_id seconds after
    `started`."""
    html, url = F.coalesce("html", F.lit("")), F.coalesce("url", F.lit(""))
    plain = pages.select("page_id", html.alias("html"), url.alias("url"), F.sha2(html, 256).alias("digest"),
                         F.octet_length(html).cast("long").alias("size"))
    skinny = plain.select("page_id", "digest", "size").where(F.col("size") >= least)
    first = skinny.groupBy("digest").agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    later = skinny.join(first.select("digest", "first"), "digest").where(F.col("page_id") > F.col("first"))
    later = later.groupBy("page_id", "digest").agg(F.min("first").alias("first"))
    # Only ids and digests meet by digest; the html moves once, by page.
    all_ = plain.join(later, ["page_id", "digest"], "left")
    repeated = F.col("first").isNotNull()
    escaped = F.regexp_replace(F.regexp_replace(F.regexp_replace("url", "%", "%25"), "\r", "%0D"), "\n", "%0A")
    lines = [
        F.lit("WARC/1.1"),
        F.concat(F.lit("WARC-Type: "), F.when(repeated, "revisit").otherwise("response")),
        F.concat(F.lit("WARC-Record-ID: <urn:page:"), F.coalesce(F.col("page_id").cast("string"), F.lit("")), F.lit(">")),
        F.concat(F.lit("WARC-Date: "), F.date_format(
            F.timestamp_seconds(F.lit(started) + F.coalesce("page_id", F.lit(0))), "yyyy-MM-dd'T'HH:mm:ss'Z'")),
        F.concat(F.lit("WARC-Target-URI: "), escaped),
        F.concat(F.lit("WARC-Payload-Digest: sha256:"), F.col("digest")),
        F.concat(F.lit("Payload-Length: "), F.col("size")),
        F.when(repeated, F.concat(F.lit("WARC-Refers-To: <urn:page:"), F.col("first"), F.lit(">"), F.lit(_END), F.lit(
            "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"))),
        F.lit("Content-Type: text/html; charset=utf-8"),
        F.concat(F.lit("Content-Length: "), F.when(repeated, 0).otherwise(F.col("size"))),
    ]
    head = F.concat_ws(_END, *lines)
    return all_.select(F.concat(head, F.lit(_END * 2), F.when(repeated, "").otherwise(F.col("html"))).alias("record"))


def write(pages: DataFrame, folder: str, least: int = 100, records_per_archive: int = 50_000) -> None:
    records(pages, least).write.option("lineSep", _END * 2).option("compression", "gzip").option(
        "maxRecordsPerFile", records_per_archive).text(folder)


def parse(pieces: Iterable[tuple[str, bytes]]) -> Iterator[tuple[str, int, dict[str, str], bytes]]:
    """Archive, offset, header and block of every record, from archives that were cut at record starts.

    A payload may hold a record start too, even one that overlaps the next record's: a record takes further pieces until
    its block has the length that its header tells, and what is left begins the next record.
    """
    archive, at, held, size, need = "", 0, [], 0, 0
    for name, piece in pieces:
        if name != archive:
            if held:
                raise ValueError(f"{archive}: the record at {at} is cut off")
            if not piece.startswith(_START):
                raise ValueError(f"{name}: no record at 0")
            archive, at, piece = name, 0, piece[len(_START):]
        elif held:
            piece = _NEXT + piece
        held.append(piece)
        size += len(piece)
        while held:
            if not need:
                body = b"".join(held)
                held, end = [body], body.index(b"\r\n\r\n")
                header = dict(line.split(": ", 1) for line in body[:end].decode("utf-8").split(_END))
                need = end + 4 + int(header["Content-Length"])
            if size < need:
                break
            body = b"".join(held)
            yield archive, at, header, body[body.index(b"\r\n\r\n") + 4:need]
            left = body[need:]
            at += len(_START) + need + 4
            if left in (b"", b"\r\n\r\n"):
                held, size = [], 0
            elif left.startswith(_NEXT):
                held, size = [left[len(_NEXT):]], len(left) - len(_NEXT)
            else:
                raise ValueError(f"{archive}: no record at {at}")
            need = 0
    if held:
        raise ValueError(f"{archive}: the record at {at} is cut off")


def _number(name: str | None) -> int | None:
    digits = (name or "").removeprefix("<urn:page:").removesuffix(">")
    return int(digits) if digits else None


def capture(archive: str, offset: int, header: dict[str, str], block: bytes) -> tuple:
    kind, digest = header["WARC-Type"], header["WARC-Payload-Digest"].removeprefix("sha256:")
    size = int(header["Payload-Length"])
    if kind == "response" and (len(block) != size or hashlib.sha256(block).hexdigest() != digest):
        raise ValueError(f"{archive}: the record at {offset} is damaged")
    url = header["WARC-Target-URI"].replace("%0A", "\n").replace("%0D", "\r").replace("%25", "%")
    return (_number(header["WARC-Record-ID"]), url, url_key(url), header["WARC-Date"], size, digest, kind,
            _number(header.get("WARC-Refers-To")), archive, offset)


def order(row: tuple) -> tuple:
    return row[2], row[3], row[0] is None, row[0] or 0, row[8], row[9]


class LoserTree:
    """Merges sorted runs: inner nodes keep the loser of each match, so that the next winner is found by one path.

    `runs` has the first block of every run; `more(run)` gives its next one, or an empty list after the last.
    """

    def __init__(self, runs: list[list[tuple]], more: Callable[[int], list[tuple]] = lambda run: []):
        self.runs, self.at, self.more = runs, [0] * len(runs), more
        self.size = 1 << max(0, (len(runs) - 1).bit_length())
        self.heads = [self._head(i) for i in range(self.size)]
        self.losers = [0] * self.size
        winners = [0] * self.size + list(range(self.size))
        for node in range(self.size - 1, 0, -1):
            a, b = winners[2 * node], winners[2 * node + 1]
            winners[node], self.losers[node] = (a, b) if self.heads[a] <= self.heads[b] else (b, a)
        self.winner = winners[1] if self.size > 1 else 0

    def _head(self, run: int) -> tuple:
        """The key of a run's next row; a run that is used up comes after all others."""
        if run < len(self.runs):
            if self.at[run] == len(self.runs[run]) > 0:
                self.runs[run], self.at[run] = self.more(run), 0
            if self.runs[run]:
                return (0, order(self.runs[run][self.at[run]]))
        return (1,)

    def __iter__(self) -> Iterator[tuple]:
        while self.heads[self.winner][0] == 0:
            run = self.winner
            yield self.runs[run][self.at[run]]
            self.at[run] += 1
            self.heads[run] = self._head(run)
            node = (run + self.size) >> 1
            while node:
                if self.heads[self.losers[node]] < self.heads[run]:
                    self.losers[node], run = run, self.losers[node]
                node >>= 1
            self.winner = run


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [()] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def _rows(batch: pa.RecordBatch) -> list[tuple]:
    return list(zip(*(column.to_pylist() for column in batch.columns), strict=True))


def read_runs(spark: SparkSession, folder: str, most: int = 20_000, most_bytes: int = 16 << 20) -> DataFrame:
    """The captures of all archives of a folder in sorted runs. A run has captures of one archive, at most `most`, and
    is closed when its URLs have `most_bytes`; `run` is its number in the archive and `place` a row's in the run."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, archive, number, size = [], "", 0, 0

        def closed() -> pa.RecordBatch:
            return _batch([(*row, number, i) for i, row in enumerate(sorted(held, key=order))], _RUNS)

        pieces = ((name.as_py(), piece.as_py()) for batch in batches
                  for name, piece in zip(batch.column("name"), batch.column("piece"), strict=True))
        for name, *record in parse(pieces):
            if held and (name != archive or len(held) == most or size >= most_bytes):
                yield closed()
                held, number, size = [], number + 1 if name == archive else 0, 0
            archive = name
            held.append(capture(name, *record))
            size += len(held[-1][1])
        if held:
            yield closed()

    # Compressed files are not split, so one task reads an archive's pieces, in order.
    pieces = spark.read.option("lineSep", _NEXT.decode()).option("pathGlobFilter", "part-*.gz").text(folder)
    return pieces.select(F.col("_metadata.file_name").alias("name"), F.col("value").cast("binary").alias("piece")).mapInArrow(
        run, RUNS)


def _bounds(runs: DataFrame, ranges: int, each: int, letters: int = 256) -> list[tuple]:
    """Up to ranges - 1 bounds in the order of captures, from about `each` samples a range. A long URL key is cut to a
    number of letters: that moves a bound, and changes nothing else."""
    step = max(1, runs.count() // (ranges * each))
    start = F.pmod(F.crc32(F.concat_ws(":", "archive", "run").cast("binary")), F.lit(step))
    sample = runs.where(F.col("place") % step == start)
    keys = sorted((r["url_key"], r["captured"], r["page_id"] is None, r["page_id"] or 0, r["archive"], r["offset"]) for r in
                  sample.select(F.substring("url_key", 1, letters).alias("url_key"), "captured", "page_id", "archive",
                                "offset").collect())
    return [keys[i * len(keys) // ranges] for i in range(1, ranges)] if keys else []


def _blocks(runs: DataFrame, bounds: list[tuple], most: int, most_bytes: int = 64 << 10) -> DataFrame:
    """Sorted runs, cut at the bounds of ranges and into blocks that know which capture the block before ended with."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, of, was, name = None, None, 0, ""

        def closed(last: bool) -> tuple:
            (name, number), after, rows, _ = held
            key, captured, none, page, archive, offset = after or (None, None, None, None, rows[0][8], None)
            packed = _batch([r[:len(_CAPTURES)] for r in rows], _CAPTURES).serialize().to_pybytes()
            return number, name, last, key, captured, none, page, archive, offset, packed

        for batch in batches:
            rows, labels, out = _rows(batch), [], []
            for row in rows:
                if row[8:9] + row[10:11] != of or row[11] <= was:
                    of, name = row[8:9] + row[10:11], f"{row[8]}:{row[10]}:{row[11]}"
                was = row[11]
                labels.append((name, bisect_right(bounds, order(row))))
            start = size = 0
            for end in range(1, len(rows) + 1):
                size += len(rows[end - 1][1])
                if end < len(rows) and labels[end] == labels[start] and end - start < most and size < most_bytes:
                    continue
                goes_on = held is not None and held[0] == labels[start]
                if held:
                    out.append(closed(not goes_on))
                held = labels[start], held[3] if goes_on else None, rows[start:end], order(rows[end - 1])
                start, size = end, 0
            yield _batch(out, _BLOCKS)
        if held:
            yield _batch([closed(True)], _BLOCKS)

    return runs.mapInArrow(run, BLOCKS)


def merged(runs: DataFrame, ranges: int | None = None, block: int = 64, each: int = 32) -> DataFrame:
    """All captures of stored runs, ordered by URL key and timestamp, over ranges (by default one per shuffle partition)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks = ((name.as_py(), last.as_py(), key.is_valid, rows.as_py()) for batch in batches for name, last, key, rows in
                  zip(*(batch.column(c) for c in ("run", "last", "after_key", "rows")), strict=True))

        def unpacked(rows: bytes) -> list[tuple]:
            return _rows(pa.ipc.read_record_batch(pa.py_buffer(rows), _CAPTURES))

        names, ends, firsts, ahead = [], [], [], None
        for name, last, follows, rows in blocks:
            if follows:
                ahead = name, last, rows
                break
            names.append(name)
            ends.append(last)
            firsts.append(unpacked(rows))

        def more(i: int) -> list[tuple]:
            nonlocal ahead
            if ends[i]:
                return []
            (name, ends[i], rows), ahead = ahead or ("", True, b""), None
            if name != names[i]:
                raise ValueError(f"expected a block of {names[i]}, not of {name}")
            for name, last, _, rows_after in blocks:
                ahead = name, last, rows_after
                break
            return unpacked(rows)

        out = []
        for row in LoserTree(firsts, more):
            out.append(row)
            if len(out) == 10_000:
                yield _batch(out, _CAPTURES)
                out = []
        yield _batch(out, _CAPTURES)

    ranges = ranges or int(runs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    blocks = _blocks(runs, _bounds(runs, ranges, each), block).repartitionById(ranges, "range")
    # What comes first in a run follows no capture (null) and is sorted to the front.
    after = [F.asc_nulls_first("after_key"), "after_captured", "after_none", "after_page", "archive", "after_offset"]
    return blocks.sortWithinPartitions(*after).mapInArrow(run, CAPTURES)


def archived(pages: DataFrame, folder: str, least: int = 100) -> DataFrame:
    """Writes the pages' archives to a folder, reads them back into stored runs, and returns the merged captures."""
    spark = pages.sparkSession
    write(pages, f"{folder}/archives", least)
    read_runs(spark, f"{folder}/archives").write.parquet(f"{folder}/runs")
    return merged(spark.read.parquet(f"{folder}/runs"))
