"""What is wrong with CSV files, found by reading each of them once, in pieces.

A record is judged as the CSV reader of the tasks sees it: quoted fields may hold
line breaks, a quote inside a quoted field is doubled.
"""

from __future__ import annotations

import csv
import io
import sys
from collections.abc import Iterator
from urllib.parse import quote

import pandas as pd
from pyspark import cloudpickle

#: characters of a field: a quoted field that is longer counts as never closed, which bounds memory
LONGEST_FIELD = 1 << 24
NOT_TEXT, UNCLOSED, NUL = "not UTF-8", "unclosed quote", "NUL character"
#: first bytes of files that are no UTF-8 text as a whole (fixed values of the formats)
MAGIC = [
    (b"\x1f\x8b", "compressed (gzip)"), (b"BZh", "compressed (bzip2)"), (b"\x28\xb5\x2f\xfd", "compressed (zstd)"),
    (b"PK\x03\x04", "compressed (zip)"), (b"\xff\xfe", "UTF-16"), (b"\xfe\xff", "UTF-16"),
]


def open_file(path: str) -> io.BufferedReader:
    """A file by the path that Spark lists, decoded."""
    from pyarrow import fs

    if path.startswith("file:"):
        system, inner = fs.LocalFileSystem(), "/" + path.removeprefix("file:").lstrip("/")
    else:
        system, inner = fs.FileSystem.from_uri(quote(path, safe="/:@?=&") if "://" in path else path)
    return io.BufferedReader(system.open_input_file(inner), 1 << 20)


def _damage(raw: bytes) -> str | None:
    if b"\0" in raw:
        return NUL
    try:
        raw.decode("utf-8")
    except UnicodeDecodeError:
        return NOT_TEXT
    return None


def _closed(stream, line: bytes) -> tuple[bytes, bool]:
    """The record that begins with a line, and whether its quotes are closed; then the stream is behind the record."""
    if b'"' not in line:
        return line, True
    parts, open_at_end = [line], False

    def lines():
        nonlocal open_at_end
        yield line.decode("latin-1")  # quotes and line ends are the same bytes, whatever the text
        for more in stream:
            parts.append(more)
            yield more.decode("latin-1")
        open_at_end = True  # another line is asked for only inside quotes

    try:
        next(csv.reader(lines()), None)
    except csv.Error as error:
        open_at_end = "limit" in str(error)
    return b"".join(parts), not open_at_end


def records(path: str) -> Iterator[tuple[bytes, str | None]]:
    """Records of a file with what damages them.

    A record whose quote is never closed would take all that follows with it: only its
    first line is given, as damaged, and reading goes on behind that line.  Empty
    lines are no records.
    """
    csv.field_size_limit(LONGEST_FIELD)
    with open_file(path) as stream:
        first = True
        while line := stream.readline():
            if first:
                line, first = line.removeprefix(b"\xef\xbb\xbf"), False
            behind = stream.tell()
            raw, closed = _closed(stream, line)
            if not closed:
                stream.seek(behind)
                raw = line
            raw = raw.rstrip(b"\r\n")
            if raw:
                yield raw, UNCLOSED if not closed else _damage(raw)


def _names(raw: bytes) -> list[str]:
    return next(csv.reader(io.StringIO(raw.decode("utf-8"), newline="")), [])


def survey_files(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """A row per file: its header or why it can't be read, its bytes, its records, and those that are damaged."""
    for batch in batches:
        found = []
        for path in batch["path"]:
            header, reason, n_bytes, n_records, n_damaged = None, None, None, None, None
            try:
                with open_file(path) as stream:
                    head = stream.read(4)
                    n_bytes = stream.seek(0, io.SEEK_END)
                reason = next((why for magic, why in MAGIC if head.startswith(magic)), None)
                if reason is None:
                    n_records = n_damaged = 0
                    every = records(path)
                    raw, damage = next(every, (b"", None))
                    names = [] if damage else _names(raw)
                    if damage:
                        reason = f"header: {damage}"
                    elif not any(n.strip() for n in names):
                        reason = "no header line"
                    elif len(set(names)) != len(names):
                        reason = "repeated column name"
                    else:
                        header = "\x1f".join(names)
                    for raw, damage in every:
                        n_records += 1
                        n_damaged += damage is not None
            except Exception as error:  # any failure makes the file unreadable, not the load
                header, reason = None, f"{type(error).__name__}: {error}"
            found.append((path, header, reason, n_bytes, n_records, n_damaged))
        out = pd.DataFrame(found, columns=["path", "header", "reason", "n_bytes", "n_records", "n_damaged"])
        yield out.astype({c: "Int64" for c in ("n_bytes", "n_records", "n_damaged")})


SURVEY = "path string, header string, reason string, n_bytes long, n_records long, n_damaged long"
RECORDS = "path string, header string, text string, damage string"


def read_records(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Every record but the header of damaged files (path, header), a thousand rows at a time."""
    for batch in batches:
        for path, header in zip(batch["path"], batch["header"]):
            every, rows = records(path), []
            next(every, None)
            for raw, damage in every:
                rows.append((path, header, raw.replace(b"\0", b"").decode("utf-8", "replace"), damage))
                if len(rows) == 1000:
                    yield pd.DataFrame(rows, columns=["path", "header", "text", "damage"])
                    rows = []
            yield pd.DataFrame(rows, columns=["path", "header", "text", "damage"])


# tasks get these functions with the job, so workers need no installed package
cloudpickle.register_pickle_by_value(sys.modules[__name__])
