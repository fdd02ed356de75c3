"""License scan: fuzzy search for short notices in whole texts.

Every notice allows ``k`` edits. A text that holds the notice with at most
``k`` edits holds one of its ``k + 1`` pieces unchanged (pigeonhole), so one
Aho-Corasick pass over the normalised text finds all candidate places; the
``regex`` library then matches the notice with the bounded error inside the
candidate window and gives the span. A notice with ``k = 0`` has one piece,
the whole of it between word boundaries.

Normalised text: A-Z lower-cased, words joined by one space. The work on a
text is linear in its length, a partition streams through Arrow batches, and
there is no shuffle.

Defined cases: a null text counts as empty; an empty text has no hits and the
score 0; repeated rows each get their own row; an empty table gives an empty
result; only the named id and text columns are read, so other columns with any
name are no matter.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_batches


@dataclass(frozen=True)
class Notice:
    label: str
    text: str        # lower-case words joined by one space
    max_edits: int   # 0: whole words only
    base: bool = False


# The three base phrases with their labels.
BASE_NOTICES = (
    Notice("cc-by", "cc by", 0, True),
    Notice("gpl", "general public license", 0, True),
    Notice("reserved", "all rights reserved", 0, True),
)
# Short notices found with edits.
FUZZY_NOTICES = (
    Notice("apache-2.0", "licensed under the apache license version 2 0", 4),
    Notice("mit", "released under the mit license", 2),
    Notice("mit", "permission is hereby granted free of charge to any person", 5),
    Notice("bsd", "redistribution and use in source and binary forms", 4),
    Notice("gpl", "gnu general public license", 2),
    Notice("lgpl", "gnu lesser general public license", 2),
    Notice("mpl-2.0", "mozilla public license version 2 0", 3),
    Notice("cc", "creative commons attribution", 2),
    Notice("cc-by-nc", "licensed under cc by nc", 2),
    Notice("reserved", "all rights reserved", 1),
    Notice("unlicense", "released into the public domain", 2),
)
NOTICES = BASE_NOTICES + FUZZY_NOTICES

HITS_SCHEMA = ("n_words long, hits array<struct<label:string, base:boolean, word:long, "
               "start:long, end:long, edits:int, score:double>>")

_KEEP = set(range(0x30, 0x3A)) | set(range(0x61, 0x7B)) | set(range(0x80, 0x100))
_TO_SPACE = bytes(b if b in _KEEP else 0x20 for b in range(256))
_WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def pieces(text: str, k: int) -> list[tuple[int, str]]:
    """``text`` cut into ``k + 1`` nearly equal pieces, with their offsets."""
    cuts = [len(text) * i // (k + 1) for i in range(k + 2)]
    return [(a, text[a:b]) for a, b in zip(cuts, cuts[1:])]


@lru_cache(maxsize=4)
def matcher(notices: tuple[Notice, ...]):
    """The seed automaton and the verifying pattern of each notice."""
    import ahocorasick
    import regex

    seeds: dict[str, list[tuple[int, int]]] = {}
    bodies, patterns = [], []
    for n, notice in enumerate(notices):
        body = notice.text if notice.max_edits else f" {notice.text} "
        bodies.append(body)
        patterns.append(regex.compile(f"(?b)(?:{regex.escape(body, literal_spaces=True)}){{e<={notice.max_edits}}}"))
        for offset, piece in pieces(body, notice.max_edits):
            seeds.setdefault(piece, []).append((n, offset))
    automaton = ahocorasick.Automaton()
    for piece, uses in seeds.items():
        automaton.add_word(piece, (len(piece), uses))
    automaton.make_automaton()
    return automaton, bodies, patterns


def normalise(text: str | None) -> list[bytes]:
    """The words of a text, A-Z lower-cased, as UTF-8."""
    return (text or "").encode().lower().translate(_TO_SPACE).split()


def find(words: list[bytes], notices: tuple[Notice, ...]) -> list[tuple[int, int, int, int]]:
    """``(notice, start, end, edits)`` in the joined words; one entry per place."""
    automaton, bodies, patterns = matcher(notices)
    text = (b" " + b" ".join(words) + b" ").decode()  # edits count characters
    places: dict[int, set[int]] = {}
    for last, (length, uses) in automaton.iter(text):
        for n, offset in uses:
            places.setdefault(n, set()).add(last - length + 1 - offset)
    found = []
    for n, starts in places.items():
        k, size = notices[n].max_edits, len(bodies[n])
        if not k:
            found += [(n, at + 1, at + size - 1, 0) for at in sorted(starts) if patterns[n].fullmatch(text, at, at + size)]
            continue
        seen: dict[int, tuple[int, int]] = {}
        recent: deque[int] = deque()  # starts, in the order found, that a new one can still be near to
        for at in sorted(starts):
            # A place with up to k edits starts at most k away from where the
            # piece says.
            low, high = max(0, at - k), min(len(text), at + size + k)
            window = text[low:high]
            if m := patterns[n].search(window):
                start, end, edits = low + m.start(), low + m.end(), sum(m.fuzzy_counts)
                # A match starts between at - k and at + 2 k.
                while recent and recent[0] < at - 3 * k:
                    recent.popleft()
                near = next((s for s in recent if abs(s - start) <= 2 * k), None)
                if near is None or edits < seen[near][1]:
                    if near is not None:
                        recent.remove(near)
                        del seen[near]
                    seen[start] = (end, edits)
                    recent.append(start)
        found += [(n, s, e, d) for s, (e, d) in seen.items()]
    return sorted((n, s, e, d) for n, s, e, d in found)


def hits_of(text: str | None, notices: tuple[Notice, ...] = NOTICES) -> tuple[int, list[dict]]:
    """Word count and hits of one text; spans are characters of the text itself."""
    words = normalise(text)
    found = find(words, notices)
    if not found:
        return len(words), []
    import regex

    spans = [m.span() for m in regex.finditer(_WORD, text)]
    sizes = [len(w.decode()) for w in words]
    starts, at = [], 1
    for size in sizes:
        starts.append(at)
        at += size + 1
    out = []
    from bisect import bisect_right
    for n, start, end, edits in found:
        first = max(0, bisect_right(starts, start + (start < starts[0])) - 1)
        if start >= starts[first] + sizes[first] and first + 1 < len(words):
            first += 1  # the match begins in the gap before the next word
        last = max(first, bisect_right(starts, max(start, end - 1)) - 1)
        size = len(notices[n].text)
        out.append({"label": notices[n].label, "base": notices[n].base, "word": first,
                    "start": spans[first][0], "end": spans[last][1], "edits": edits,
                    "score": 1.0 - edits / size})
    return len(words), sorted(out, key=lambda h: (h["word"], h["label"], not h["base"]))


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  notices: tuple[Notice, ...] = NOTICES) -> DataFrame:
    """One row per document: ``id_col``, ``n_words`` and ``hits`` (label, first
    word, character span, edits, score of each place), in word order."""
    src = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    id_type = dict(src.dtypes)["id"]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hit = pa.struct([("label", pa.string()), ("base", pa.bool_()), ("word", pa.int64()), ("start", pa.int64()),
                         ("end", pa.int64()), ("edits", pa.int32()), ("score", pa.float64())])
        for b in batches:
            rows = [hits_of(t, notices) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([n for n, _ in rows], pa.int64()), pa.array([h for _, h in rows], pa.list_(hit))],
                names=["id", "n_words", "hits"])

    return map_batches(src, scan, f"id {id_type}, {HITS_SCHEMA}").withColumnRenamed("id", id_col)


def license_summary(scanned: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Digest of ``scan_licenses``: base places, their first and last word,
    label lists, and the best match's share of unedited characters."""
    base = F.filter("hits", lambda h: h["base"])

    def names(hits):
        return F.array_join(F.array_sort(F.array_distinct(F.transform(hits, lambda h: h["label"]))), ",")

    return scanned.select(
        id_col, "n_words",
        F.size(base).cast("long").alias("n_base"),
        F.array_min(F.transform(base, lambda h: h["word"])).alias("first_word"),
        F.array_max(F.transform(base, lambda h: h["word"])).alias("last_word"),
        names(base).alias("base_labels"),
        names(F.col("hits")).alias("labels"),
        F.coalesce(F.array_max(F.transform("hits", lambda h: h["score"])), F.lit(0.0)).alias("score"))
