"""License scans: phrases word by word, and short notices within a bounded edit distance.

A notice of length m that occurs with at most k edits holds one of its k + 1 pieces
unchanged. Pieces are searched as plain bytes; around each hit the regex library matches
the whole notice with at most k errors and gives its span. Texts are compared as words
(A-Z in lower case, runs without ASCII punctuation or space) joined by one space; edits
count bytes of UTF-8.

Rows: a null or empty text has no words, no labels and score 0; null or repeated ids are
judged row by row; texts are searched whole; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesight.llm import text as T
from salesight.llm.tables import map_batches, records

#: Phrase and its label.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}
#: Notices searched with errors, and their labels.
NOTICES = {
    "released under the mit license": "mit-notice",
    "licensed under the apache license version 2 0": "apache-2.0-notice",
    "licensed under cc by nc 4 0": "cc-by-nc-notice",
    "this work is licensed under the gnu general public license version 3": "gpl-3-notice",
    "permission is hereby granted free of charge to any person obtaining a copy": "mit-grant",
    "redistribution and use in source and binary forms with or without modification": "bsd-grant",
    "this program is free software you can redistribute it and or modify it": "gpl-grant",
    "licensed under the creative commons attribution 4 0 international license": "cc-by-4.0-notice",
    "subject to the terms of the mozilla public license": "mpl-notice",
}
#: One error is allowed for so many characters of a notice, up to the most.
CHARS_PER_ERROR = 10
MOST_ERRORS = 4

SCHEMA = (
    "doc_id bigint, n_words bigint, n_base bigint, first_word bigint, last_word bigint, "
    "base_labels array<string>, "
    "notices array<struct<label:string,start_word:bigint,end_word:bigint,edits:int>>, score double"
)


class Notice(NamedTuple):
    label: str
    words: bytes
    errors: int
    pieces: list[tuple[int, bytes]]  # offset, bytes
    pattern: regex.Pattern


def notice(words: str, label: str) -> Notice:
    raw = words.encode()
    errors = min(MOST_ERRORS, len(raw) // CHARS_PER_ERROR)
    cuts = [round(i * len(raw) / (errors + 1)) for i in range(errors + 2)]
    pieces = [(a, raw[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)]
    pattern = regex.compile(b"(?b)(?:" + regex.escape(raw, special_only=True) + b"){e<=%d}" % errors)
    return Notice(label, raw, errors, pieces, pattern)


def phrase_places(hashes: np.ndarray, rows: np.ndarray, phrase: str) -> np.ndarray:
    """Words of the chunk at which a phrase's words stand consecutively within one row."""
    data = np.frombuffer(phrase.encode(), np.uint8)
    found = T.words(T.Chunk(0, 1, data, np.array([0, len(data)])), T.ALNUM)
    wanted = T.word_hashes(data, found)
    at = np.flatnonzero(hashes[: max(0, len(hashes) - len(wanted) + 1)] == wanted[0])
    for k in range(1, len(wanted)):
        at = at[hashes[at + k] == wanted[k]]
    row = np.searchsorted(rows, at, "right")
    return at[at + len(wanted) <= rows[row]]


def spans(sought: Notice, buffer: bytes) -> list[tuple[int, int, int]]:
    """Start, end and edits of the notice's places in words joined by spaces, in one row each."""
    low = {}
    for offset, piece in sought.pieces:
        at = buffer.find(piece)
        while at >= 0:
            start = max(0, at - offset - sought.errors)
            start = buffer.rfind(b"\n", start, at) + 1 or start
            end = at - offset + len(sought.words) + sought.errors
            end = (buffer.find(b"\n", at, end) + 1 or min(len(buffer), end) + 1) - 1
            low[start] = max(low.get(start, 0), end)
            at = buffer.find(piece, at + 1)
    found: dict[tuple[int, int], int] = {}
    for start, end in sorted(low.items()):
        at = buffer.find(sought.words, start, end)
        if at >= 0:
            found[at, at + len(sought.words)] = 0
        elif match := sought.pattern.search(buffer, start, end):
            found[match.span()] = sum(match.fuzzy_counts)
    kept: list[tuple[int, int, int]] = []
    for (start, end), edits in sorted(found.items(), key=lambda f: (f[1], f[0])):
        if all(end <= s or e <= start for s, e, _ in kept):
            kept.append((start, end, edits))
    return sorted(kept)


def scan(
    docs: DataFrame, phrases: dict[str, str] = PHRASES, notices: dict[str, str] = NOTICES
) -> DataFrame:
    """Per row: words, places of phrases, notices with label, first and last word and edits.

    ``score`` is the best notice's share of unchanged characters, or 0.5 where phrases
    stand without a notice, or 0.
    """
    texts = list(notices.items())

    def step(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        sought = [notice(words, label) for words, label in texts]
        made: list[dict] = []
        for chunk in T.chunks(batch.column(1)):
            made += scan_chunk(chunk, phrases, sought)
        if made:
            plain = pa.RecordBatch.from_pylist(made, RESULT)
            yield records(doc_id=batch.column(0), **{n: plain.column(n) for n in plain.schema.names})

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return map_batches(rows, step, SCHEMA)


RESULT = pa.schema(
    [
        ("n_words", pa.int64()), ("n_base", pa.int64()), ("first_word", pa.int64()), ("last_word", pa.int64()),
        ("base_labels", pa.list_(pa.string())),
        ("notices", pa.list_(pa.struct([("label", pa.string()), ("start_word", pa.int64()), ("end_word", pa.int64()), ("edits", pa.int32())]))),
        ("score", pa.float64()),
    ]
)


def scan_chunk(chunk: T.Chunk, phrases: dict[str, str], sought: list[Notice]) -> list[dict]:
    data = T.LOWER[chunk.data]
    found = T.words(chunk._replace(data=data), T.ALNUM)
    hashes = T.word_hashes(data, found)
    rows = [
        {"n_words": int(n), "n_base": 0, "first_word": None, "last_word": None, "base_labels": [], "notices": [], "score": 0.0}
        for n in np.diff(found.rows)
    ]
    for phrase, label in phrases.items():
        for at in phrase_places(hashes, found.rows, phrase).tolist():
            r = int(np.searchsorted(found.rows, at, "right")) - 1
            row, word = rows[r], at - int(found.rows[r])
            row["n_base"] += 1
            row["first_word"] = word if row["first_word"] is None else min(word, row["first_word"])
            row["last_word"] = word if row["last_word"] is None else max(word, row["last_word"])
            row["base_labels"] = sorted({*row["base_labels"], label})
            row["score"] = 0.5
    buffer, starts = T.joined(data, found)
    plain = buffer.tobytes()
    for one in sought:
        for start, end, edits in spans(one, plain):
            first = max(0, int(np.searchsorted(starts, start, "right")) - 1)
            last = int(np.searchsorted(starts, end, "left")) - 1
            r = int(np.searchsorted(found.rows, first, "right")) - 1
            base = int(found.rows[r])
            rows[r]["notices"].append(
                {"label": one.label, "start_word": first - base, "end_word": last - base, "edits": edits}
            )
            rows[r]["score"] = max(rows[r]["score"], 1.0 - edits / len(one.words))
    return rows
