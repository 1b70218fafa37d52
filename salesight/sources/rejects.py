"""Scan CSV files of differing columns; lines that do not fit come out as rejects.

Every line of every file is a row, a reject, a header or blank, so none is lost without
a trace. Files are read as lines and parsed by Spark's CSV functions with the header of
their own file; columns are brought together by name, and a column that a file does not
have is NULL there.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.prepare import SALES_TYPES, cast_columns, snake_case
from .staging import stage

FIELDS = "number of fields"
BROKEN = "_broken"
MARK = "<end>"
BYTE_ORDER_MARK = "﻿"


class Scan(NamedTuple):
    rows: DataFrame
    rejects: DataFrame


def _lines(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    paths = path if isinstance(path, str) else list(path)
    return spark.read.text(paths).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block_start"),
        F.regexp_replace("value", f"^{BYTE_ORDER_MARK}", "").alias("line"),
    )


def file_headers(lines: DataFrame) -> DataFrame:
    """The first line of each file: one row per file, combined before it is shuffled."""
    placed = lines.withColumn("place", F.monotonically_increasing_id())
    first = placed.where(F.col("block_start") == 0).groupBy("file")
    return first.agg(F.min_by("line", "place").alias("header"))


def _names(header: str, separator: str) -> list[str]:
    names = [snake_case(part.strip().strip('"')) for part in header.split(separator)]
    if len(set(names)) < len(names) or "" in names:
        raise ValueError(f"a header has empty or repeated names: {header!r}")
    return names


def _parsed(header: str, columns: Sequence[str], separator: str) -> Column:
    """A line by one header: all columns as ``_c0``, ``_c1``, ... and whether it is broken.

    A mark is added as one more field. It is read back at its place only if the line has as
    many fields as the header and no quote is left open.
    """
    names = _names(header, separator)
    places = [f"_f{i}" for i in range(len(names) + 2)]
    marked = F.concat("line", F.lit(separator + MARK))
    values = F.from_csv(marked, ", ".join(f"{p} string" for p in places), {"sep": separator})
    end, more = (values.getField(p) for p in places[len(names) :])
    found = [
        (values.getField(places[names.index(c)]) if c in names else F.lit(None).cast("string")).alias(f"_c{i}")
        for i, c in enumerate(columns)
    ]
    whole = end.eqNullSafe(F.lit(MARK)) & more.isNull()
    return F.struct(*found, (~whole).alias(BROKEN))


def scan_with_rejects(
    spark: SparkSession,
    path: str | Sequence[str],
    types: Mapping[str, str] = SALES_TYPES,
    separator: str = ",",
) -> Scan:
    """Typed rows of all files, and the lines that are none: file, line and reason.

    A line is rejected for its number of fields (an unclosed quote shows in that, too), or
    for values that are there but not of their type, which the reason names. Empty values
    are NULL, no reason to reject. A line that equals its file's header is a header wherever
    it stands, as in files put together from others; blank lines are skipped. A record is one
    line: quoted line breaks give rejects. Columns are named in snake case, in the order in
    which they first appear among the headers, sorted; a file without a line adds nothing.

    The files are read once more for their first lines. The driver sees each distinct
    header, never one entry per file; all else stays in built-in functions.
    """
    lines = _lines(spark, path)
    headers = stage(file_headers(lines.where(F.trim("line") != "")), "headers").frame
    layouts = sorted(r[0] for r in headers.select("header").distinct().collect())
    columns = list(dict.fromkeys(c for h in layouts for c in _names(h, separator)))
    if not columns:
        raise ValueError("no file has a header")
    named = lines.join(headers, "file").where((F.col("line") != F.col("header")) & (F.trim("line") != ""))
    structs = [F.when(F.col("header") == h, _parsed(h, columns, separator)) for h in layouts]
    # Generated rather than projected, so that a line is parsed once and not per column.
    parsed = named.select("file", "line", F.inline(F.array(F.coalesce(*structs))))

    typed = {f"_c{i}": types[c] for i, c in enumerate(columns) if c in types}
    cast = cast_columns(parsed.withColumns({f"_text{c}": F.col(c) for c in typed}), typed)
    wrong = [
        F.when(F.col(c).isNull() & (F.trim(f"_text{c}") != ""), F.lit(f"{columns[int(c[2:])]} is not {kind}"))
        for c, kind in typed.items()
    ]
    values = F.concat_ws("; ", *wrong) if wrong else F.lit("")
    reason = F.when(F.col(BROKEN), F.lit(FIELDS)).when(values != "", values)
    judged = cast.withColumn("_reason", reason)
    return Scan(
        judged.where(F.col("_reason").isNull()).select(*[F.col(f"_c{i}").alias(c) for i, c in enumerate(columns)]),
        judged.where(F.col("_reason").isNotNull()).select("file", "line", F.col("_reason").alias("reason")),
    )
