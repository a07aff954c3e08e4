"""Flat JSON feed files of any size: one list, opened by many tasks at the bounds of its objects.

Where a range of bytes lies in the list depends on all bytes before it, but only through three
numbers: whether a string is open, how deep the brackets are nested, and how many objects came before.
A first pass gives for each range, for either state of the string, how it changes them; composing
these along a file is a short fold over its ranges. In a second pass each task opens the objects that
begin in its range, reading on past its end for the last of them. Neither holds more than a range
and one object.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, functions as F

from roadpulse.schemas import FLAT_OBJECT
from roadpulse.session import materialise

RANGE_BYTES = 32 << 20
MOST_TASKS = 1 << 15            # of one pass, which takes 32 MB or several ranges to a task, one after another
_TASKS_A_CORE = 4               # at least, as long as there are as many ranges
_STEP = 1 << 20                 # bytes read at a time past the end of a range
_OPEN, _CLOSE, _COMMA = 1, -1, 2
_KIND = np.zeros(256, dtype=np.int8)
_KIND[list(b"[{")], _KIND[list(b"]}")], _KIND[list(b",")] = _OPEN, _CLOSE, _COMMA
_QUOTE, _BACKSLASH, _LIST = b'"'[0], b"\\"[0], b"["[0]
_BLANK = b" \t\r\n\xef\xbb\xbf"

_RANGES = "file string, size long, start long, stop long"
_CHANGES = _RANGES + (", is_list boolean, flips boolean, deeper array<long>, depths array<array<long>>, "
                      "commas array<array<long>>")
_STATES = _RANGES + ", in_string boolean, depth long, before long, reason string"


def _open(uri: str):
    """A file of Spark's, as tasks reach it."""
    if uri.startswith(("file:", "/")):
        return fs.LocalFileSystem().open_input_file(re.sub("^file:/+", "/", uri))
    files, path = fs.FileSystem.from_uri(uri)
    return files.open_input_file(path)


def _is_escaped(file, start: int) -> bool:
    """Whether an odd number of backslashes stands right before a place."""
    count = 0
    while start > 0:
        low = max(0, start - 4096)
        part = file.read_at(start - low, low)
        run = len(part) - len(part.rstrip(b"\\"))
        count += run
        if run < len(part):
            break
        start = low
    return count % 2 == 1


def _quotes(data: np.ndarray, escaped: bool) -> np.ndarray:
    """The places of quotes that open or close a string."""
    found = np.flatnonzero(data == _QUOTE)
    slashes = np.flatnonzero(data == _BACKSLASH)
    if len(slashes):
        starts = np.flatnonzero(np.diff(slashes, prepend=-2) > 1)
        sizes = np.diff([*starts, len(slashes)])
        first, after = slashes[starts], slashes[starts] + sizes
        odd = (sizes + (escaped & (first == 0))) % 2 == 1
        found = np.setdiff1d(found, after[odd], assume_unique=True)
        escaped = escaped and first[0] != 0
    return found[found != 0] if escaped else found


class _Marks:
    """Brackets and commas of some bytes, and the string state at each, given that of the first byte."""

    def __init__(self, data: bytes, escaped: bool) -> None:
        self.data = np.frombuffer(bytearray(data), dtype=np.uint8)
        quotes = _quotes(self.data, escaped)
        self.flips = len(quotes) % 2 == 1
        kinds = _KIND[self.data]
        self.at = np.flatnonzero(kinds)
        self.kind = kinds[self.at]
        self.open = np.searchsorted(quotes, self.at) % 2 == 1

    def outside(self, in_string: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Places, kinds, and depths behind each (from 0), of what lies outside strings."""
        real = self.open == in_string
        at, kind = self.at[real], self.kind[real]
        return at, kind, np.cumsum(np.where(kind == _COMMA, 0, kind), dtype=np.int64)


def _change(data: bytes, escaped: bool) -> tuple:
    marks = _Marks(data, escaped)
    deeper, depths, commas = [], [], []
    for in_string in (False, True):
        _, kind, depth = marks.outside(in_string)
        deeper.append(int(depth[-1]) if len(depth) else 0)
        found, n = np.unique(depth[kind == _COMMA], return_counts=True)
        depths.append(found.tolist())
        commas.append(n.tolist())
    return bool(marks.flips), deeper, depths, commas


def _changes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    columns = re.findall(r"(?:^|, )(\w+) ", _CHANGES)
    for batch in batches:
        out = []
        for row in batch.itertuples(index=False):
            with _open(row.file) as file:
                data = file.read_at(row.stop - row.start, row.start)
                is_list = row.start > 0 or file.read_at(min(row.size, _STEP), 0).lstrip(_BLANK)[:1] == b"["
                out.append((*row, is_list, *_change(data, _is_escaped(file, row.start))))
        if out:
            yield pd.DataFrame(out, columns=columns)


def _states(rows: pd.DataFrame) -> pd.DataFrame:
    """The state each range of a file begins with, and what is wrong with the file, if anything."""
    rows = rows.sort_values("start")
    in_string, depth, before, out = False, 0, 0, []
    for row in rows.itertuples(index=False):
        out.append((row.file, row.size, row.start, row.stop, in_string, depth, before))
        s = int(in_string)
        before += sum(n for d, n in zip(row.depths[s], row.commas[s]) if depth + d == 1)
        depth += row.deeper[s]
        in_string ^= row.flips
    out = pd.DataFrame(out, columns=["file", "size", "start", "stop", "in_string", "depth", "before"])
    broken = in_string or depth != 0
    out["reason"] = "malformed" if broken else None if rows["is_list"].iloc[0] else "no_list"
    return out


def _objects_in(file, row) -> Iterator[tuple[int, str]]:
    """(pos, text) of the objects whose bracket or comma before them lies in the range."""
    data, at, end = b"", row.start, row.stop
    in_string, depth, index = row.in_string, row.depth, row.before
    held: tuple[int, int] | None = None         # place in `data` and index of the object being read
    escaped = _is_escaped(file, at)
    while at < row.size:
        block = file.read_at((end if at < end else min(row.size, at + _STEP)) - at, at)
        offset, past = len(data), at >= end
        marks = _Marks(block, escaped)
        places, kinds, depths = marks.outside(in_string)
        depths = depths + depth
        begins = (kinds == _OPEN) & (depths == 1) & (marks.data[places] == _LIST)
        commas = (kinds == _COMMA) & (depths == 1)
        ends = (kinds == _CLOSE) & (depths == 0)
        data += block
        for i in np.flatnonzero(begins | commas | ends):
            place = offset + int(places[i])
            if held is not None:
                yield held[1], data[held[0]:place].decode("utf-8", "replace").strip()
                held = None
            if past:
                return
            if not ends[i]:
                index += int(commas[i])
                held = place + 1, index
        if held is None:
            if past or at + len(block) >= end:
                return
            data = b""
        else:
            data, held = data[held[0]:], (0, held[1])
        in_string ^= marks.flips
        depth += int((depths[-1] - depth) if len(depths) else 0)
        at += len(block)
        trailing = len(block) - len(block.rstrip(b"\\"))
        escaped = (trailing + (escaped if trailing == len(block) else 0)) % 2 == 1


def _objects(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    held, chars = [], 0
    for batch in batches:
        for row in batch.itertuples(index=False):
            with _open(row.file) as file:
                for pos, text in _objects_in(file, row):
                    if text:
                        held.append((row.file, pos, text))
                        chars += len(text)
                    if chars > _STEP:
                        yield pd.DataFrame(held, columns=["file", "pos", "o"])
                        held, chars = [], 0
    if held:
        yield pd.DataFrame(held, columns=["file", "pos", "o"])


def flat_ranges(
    spark: SparkSession, path: str | list[str], file_filter: str = "*.json", range_bytes: int = RANGE_BYTES,
) -> DataFrame:
    """The ranges of all files with the state each begins in; `reason` for files that can't be used.

    A file whose brackets or strings don't close is `malformed`, one that is no list `no_list`; the
    objects of a list are not looked into here. Empty files have no ranges. The first pass runs here,
    and its result, a short row for each range, is written.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", file_filter).load(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("size")).filter("size > 0")
    start = F.explode(F.sequence(F.lit(0).cast("long"), F.col("size") - 1, F.lit(range_bytes).cast("long")))
    ranges = files.select("file", "size", start.alias("start")).withColumn(
        "stop", F.least(F.col("start") + range_bytes, F.col("size")))
    return materialise(_dealt(ranges).mapInPandas(_changes, _CHANGES).groupBy("file").applyInPandas(_states, _STATES))


def _dealt(ranges: DataFrame) -> DataFrame:
    """Ranges dealt to tasks by their bytes: of rows this small Spark would make one task, and a task for each short
    range costs more than its work."""
    n, size = ranges.agg(F.count("*"), F.coalesce(F.sum(F.col("stop") - F.col("start")), F.lit(0))).first()
    least = _TASKS_A_CORE * ranges.sparkSession.sparkContext.defaultParallelism
    return ranges.repartition(max(1, min(n, max(-(-size // RANGE_BYTES), least), MOST_TASKS)))


def unusable_flat_files(ranges: DataFrame) -> DataFrame:
    return ranges.filter(F.col("reason").isNotNull() & (F.col("start") == 0)).select("file", "reason")


def read_flat_ranges(ranges: DataFrame) -> DataFrame:
    """The objects of all usable files as (file, pos, o), an object's JSON text and place in its list."""
    return _dealt(ranges.filter(F.col("reason").isNull())).mapInPandas(_objects, "file string, pos long, o string")


def read_large_flat_feed(
    spark: SparkSession, path: str | list[str], file_filter: str = "*.json", range_bytes: int = RANGE_BYTES,
) -> DataFrame:
    """The rows of `feeds.read_flat_feed`, for files too large for one task."""
    objects = read_flat_ranges(flat_ranges(spark, path, file_filter, range_bytes))
    return objects.select("file", "pos", F.from_json("o", FLAT_OBJECT).alias("o")).select("file", "pos", "o.*")
