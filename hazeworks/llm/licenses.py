"""License scan: fuzzy search for short notices.

Pigeonhole: a notice that may be found with e errors is split into e + 1 pieces; wherever it occurs with at most e
errors, one piece occurs exactly. An automaton over all pieces locates candidates in one pass over the words of a text
(lower-cased A-Z, joined by one space); the regex library's bounded-error matching then verifies the whole notice around
each candidate, and reports errors and span.

Besides, base phrases are counted exactly, wherever their words stand consecutively.

Words are runs of [^\x00-\x2F\x3A-\x60\x7B-\x7F]. Cases: null text counts as empty; texts without words have no place,
no label and score 0; repeated rows are reported each; an empty table gives an empty result.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from hazeworks.llm.text import utf8

#: Base phrases and their labels.
BASE = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}
#: Notices to find with errors, as their words, and their labels.
NOTICES = {
    "licensed under the apache license version 2 0": "apache-2.0",
    "under the terms of the gnu general public license": "gpl",
    "under the terms of the gnu lesser general public license": "lgpl",
    "permission is hereby granted free of charge to any person obtaining a copy": "mit",
    "released under the mit license": "mit",
    "redistribution and use in source and binary forms": "bsd",
    "licensed under cc by nc 4 0": "cc-by-nc",
    "licensed under cc by sa 4 0": "cc-by-sa",
    "licensed under cc by 4 0": "cc-by",
    "licensed under the mozilla public license": "mpl",
    "this is free and unencumbered software released into the public domain": "unlicense",
    "all rights reserved": "all-rights-reserved",
}
SCAN = ("doc_id bigint, n_words bigint, n_base bigint, first_word bigint, last_word bigint, base_labels string, "
        "labels string, score double, spans array<struct<label: string, first_word: bigint, last_word: bigint, "
        "errors: int>>")

_TABLE = bytes(b + 0x20 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20
               for b in range(256))


def errors_of(notice: str) -> int:
    """One in ten letters, as long as pieces keep six letters."""
    return max(0, min(len(notice) // 10, len(notice) // 6 - 1))


@lru_cache(maxsize=4)
def tools(notices: tuple[tuple[str, str], ...]):
    """The automaton over pieces, each with its notices and offsets; and the notices' patterns."""
    pieces: dict[str, list[tuple[int, int]]] = {}
    patterns = []
    for i, (notice, _) in enumerate(notices):
        e = errors_of(notice)
        cuts = [len(notice) * k // (e + 1) for k in range(e + 2)]
        for x, y in zip(cuts[:-1], cuts[1:], strict=True):
            pieces.setdefault(notice[x:y], []).append((i, x))
        patterns.append(regex.compile(f"(?b)(?:{regex.escape(notice, literal_spaces=True)}){{e<={e}}}"))
    automaton = ahocorasick.Automaton()
    for piece, places in pieces.items():
        automaton.add_word(piece, (len(piece), places))
    automaton.make_automaton()
    return automaton, patterns


def fuzzy(line: str, notices: tuple[tuple[str, str], ...]) -> list[tuple[int, int, int, int]]:
    """(notice, start, end, errors) of all verified places: of those of a notice that overlap, the one with the fewest
    errors, then the first."""
    if not notices:
        return []
    automaton, patterns = tools(notices)
    windows: dict[int, set[tuple[int, int]]] = {}
    for end, (size, places) in automaton.iter(line):
        for i, offset in places:
            notice = notices[i][0]
            e = errors_of(notice)
            low = end + 1 - size - offset - e
            windows.setdefault(i, set()).add((max(0, low), min(len(line), low + len(notice) + 2 * e)))
    out = []
    for i, spans in windows.items():
        least = len(notices[i][0]) - errors_of(notices[i][0])
        found: list[tuple[int, int, int, int, int]] = []

        seen: dict[str, tuple[int, int, int] | None] = {}  # a window's text decides what is found in it

        def search(low: int, high: int) -> None:
            if high - low < least:
                return
            part = line[low:high]
            if part not in seen:
                if len(seen) >= 1 << 14:
                    seen.clear()
                m = patterns[i].search(part)
                seen[part] = m and (sum(m.fuzzy_counts), m.start(), m.end())
            if seen[part]:
                errors, x, y = seen[part]
                heapq.heappush(found, (errors, low + x, low + y, low, high))

        for low, high in spans:
            search(low, high)
        size = len(notices[i][0]) + errors_of(notices[i][0])
        taken: dict[int, list[tuple[int, int]]] = {}  # by start // size: a place overlaps those of three entries at most
        while found:
            errors, x, y, low, high = heapq.heappop(found)
            near = [t for b in range(x // size - 1, x // size + 2) for t in taken.get(b, ()) if t[0] < y and x < t[1]]
            if not near:
                taken.setdefault(x // size, []).append((x, y))
                out.append((i, x, y, errors))
            else:
                # what of the window lies on both sides of the better place
                x, y = min(near)
                search(low, min(x, high))
                search(max(low, y), high)
    return sorted(out, key=lambda m: m[1:])


def scan_text(text: bytes, notices: tuple[tuple[str, str], ...]) -> tuple:
    words = text.translate(_TABLE).split()
    line = (b" " + b" ".join(words) + b" ").decode("utf-8")
    places, base = [], set()
    spaces = np.flatnonzero(np.frombuffer(line.encode("utf-32-le"), np.uint32) == 0x20)

    def word_at(places: list[int]) -> list[int]:
        """For places in the line, the index of the word there or before."""
        return (np.searchsorted(spaces, places, "right") - 1).tolist()

    for phrase, label in BASE.items():
        needle, at = f" {phrase} ", -1
        while (at := line.find(needle, at + 1)) >= 0:
            places.append(at)
            base.add(label)
    places = word_at(places)
    labels, spans, best = set(base), [], 1.0 if base else 0.0
    found = fuzzy(line, notices)
    firsts, lasts = word_at([x for _, x, _, _ in found]), word_at([max(x, y - 2) for _, x, y, _ in found])
    for (i, _, _, errors), first, last in zip(found, firsts, lasts, strict=True):
        notice, label = notices[i]
        labels.add(label)
        spans.append({"label": label, "first_word": max(0, first), "last_word": max(0, last), "errors": errors})
        best = max(best, 1 - errors / len(notice))
    return (len(words), len(places), min(places, default=None), max(places, default=None),
            ",".join(sorted(base)), ",".join(sorted(labels)), best, spans)


def scan(docs: DataFrame, notices: dict[str, str] | None = None) -> DataFrame:
    """Per document: counts and labels as in SCAN, with the span, in words, of every notice found."""
    chosen = tuple((notices or NOTICES).items())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.float64(), pa.list_(
            pa.struct([("label", pa.string()), ("first_word", pa.int64()), ("last_word", pa.int64()),
                       ("errors", pa.int32())])))
        for batch in batches:
            data, offsets = utf8(batch.column("text"))
            data = data.tobytes()
            rows = [scan_text(data[x:y], chosen) for x, y in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]
            columns = list(zip(*rows, strict=True)) or [()] * 8
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").cast(pa.int64()), *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True))],
                [p.split()[0] for p in ("doc_id n_words n_base first_word last_word base_labels labels score "
                                        "spans").split()])

    return docs.select("doc_id", "text").mapInArrow(run, SCAN)
