"""Byte-range readers, the listing of a remote tree, and the records that a byte range owns."""

from __future__ import annotations

import fnmatch
import http.client
import json
import logging
import os
import time
import urllib.error
import urllib.parse
import urllib.request
from collections.abc import Callable, Iterator
from typing import Protocol

from .. import settings

LOG = logging.getLogger(__name__)
AGENT = "tokenmix/1.0"
TRANSIENT = (OSError, http.client.HTTPException, RuntimeError)  # URLError, timeouts and resets are OSErrors


class RangeReader(Protocol):
    def file_size(self) -> int: ...

    def read_range(self, offset: int, length: int) -> bytes: ...


def retried(action: Callable, what: str, errors=TRANSIENT, attempts: int = settings.HTTP_ATTEMPTS, sleep=time.sleep):
    """action(), again after growing delays; RuntimeError with the last cause when all attempts failed."""
    for k in range(attempts):
        try:
            return action()
        except errors as e:
            if k + 1 == attempts:
                raise RuntimeError(f"{what} failed after {attempts} attempts: {type(e).__name__}: {e}") from e
            delay = min(settings.HTTP_BACKOFF_MOST, settings.HTTP_BACKOFF * 2**k)
            LOG.warning("%s: attempt %d of %d failed (%s: %s), again in %.1f s", what, k + 1, attempts, type(e).__name__, e, delay)
            sleep(delay)


def _asked(offset: int, length: int) -> None:
    if offset < 0 or length <= 0:
        raise ValueError(f"invalid range: offset {offset}, length {length}")


class LocalRange:
    """A reader over bytes or a file."""

    def __init__(self, data: bytes | str | os.PathLike):
        self.data = data
        self.size = len(data) if isinstance(data, bytes) else os.stat(data).st_size

    def file_size(self) -> int:
        return self.size

    def read_range(self, offset: int, length: int) -> bytes:
        _asked(offset, length)
        if offset >= self.size:
            return b""
        if isinstance(self.data, bytes):
            return self.data[offset : offset + length]
        with open(self.data, "rb") as f:
            f.seek(offset)
            return f.read(min(length, self.size - offset))


class FsRange:
    """A reader over a file of any store that pyarrow knows by URL (file, hdfs, s3, gs)."""

    def __init__(self, url: str):
        from pyarrow import fs

        self.fs, self.path = fs.FileSystem.from_uri(url)
        self.size = self.fs.get_file_info(self.path).size or 0

    def file_size(self) -> int:
        return self.size

    def read_range(self, offset: int, length: int) -> bytes:
        _asked(offset, length)
        if offset >= self.size:
            return b""
        with self.fs.open_input_file(self.path) as f:
            f.seek(offset)
            return f.read(min(length, self.size - offset))


class HttpRange:
    """A reader over HTTP ranges. An answer counts only with status 206, the exact Content-Range and the exact length."""

    def __init__(self, url: str, size: int, opener=None, sleep=time.sleep):
        self.url, self.size, self.opener, self.sleep = url, size, opener or urllib.request.urlopen, sleep

    def file_size(self) -> int:
        return self.size

    def read_range(self, offset: int, length: int) -> bytes:
        _asked(offset, length)
        if offset >= self.size:
            return b""
        last = min(offset + length, self.size) - 1
        request = urllib.request.Request(self.url, headers={"Range": f"bytes={offset}-{last}", "Accept-Encoding": "identity", "User-Agent": AGENT})

        def once() -> bytes:
            with self.opener(request, timeout=settings.HTTP_TIMEOUT) as answer:
                data, status, said = answer.read(), answer.status, answer.headers.get("Content-Range", "")
            wanted = f"bytes {offset}-{last}/{self.size}"
            if status != 206 or said != wanted or len(data) != last - offset + 1:
                raise RuntimeError(f"wanted 206 with {wanted}, got {status} with {said!r} and {len(data)} bytes")
            return data

        return retried(once, f"range read of {self.url}", sleep=self.sleep)


def matches(path: str, glob: str) -> bool:
    return "/" not in path and fnmatch.fnmatchcase(path, glob)


def list_tree(url: str, glob: str, opener=None, sleep=time.sleep) -> list[tuple[str, int]]:
    """(path, size) of the root files of a paged JSON tree, sorted by path.

    A page is a list of entries, or an object with ``tree`` and perhaps a ``cursor`` for the next page.
    """
    opener, found, cursor = opener or urllib.request.urlopen, [], None
    while True:
        page_url = url if not cursor else f"{url}{'&' if '?' in url else '?'}cursor={urllib.parse.quote(cursor)}"

        def once(page_url=page_url):
            with opener(urllib.request.Request(page_url, headers={"User-Agent": AGENT}), timeout=settings.HTTP_TIMEOUT) as answer:
                return json.loads(answer.read().decode())

        page = retried(once, "source tree", (*TRANSIENT, json.JSONDecodeError), sleep=sleep)
        entries = page.get("tree") if isinstance(page, dict) else page
        if not isinstance(entries, list) or not all(isinstance(e, dict) for e in entries):
            raise RuntimeError(f"unexpected source tree at {page_url}")
        for e in entries:
            path, size = e.get("path"), e.get("size")
            if e.get("type") == "file" and isinstance(path, str) and matches(path, glob):
                if not isinstance(size, int) or size <= 0:
                    raise RuntimeError(f"no valid size for {path!r}")
                found.append((path, size))
        cursor = page.get("cursor") if isinstance(page, dict) else None
        if not cursor:
            break
    if not found:
        raise RuntimeError(f"no root file matches {glob!r}")
    return sorted(found)


def list_folder(folder: str, glob: str) -> list[tuple[str, int]]:
    """(path, size) of the matching files of a folder (path or URL)."""
    if "://" in folder:
        from pyarrow import fs

        store, base = fs.FileSystem.from_uri(folder)
        every = [(i.base_name, i.size) for i in store.get_file_info(fs.FileSelector(base)) if i.is_file]
    else:
        every = [(e.name, e.stat().st_size) for e in os.scandir(folder) if e.is_file()]
    found = sorted((name, size) for name, size in every if matches(name, glob))
    if not found:
        raise RuntimeError(f"no root file matches {glob!r}")
    return found


def line_head(reader: RangeReader, start: int, chunk: int) -> int:
    """First byte of the line that holds byte start (or that begins there)."""
    high = start
    while high:
        low = max(0, high - chunk)
        at = reader.read_range(low, high - low).rfind(b"\n")
        if at >= 0:
            return low + at + 1
        high = low
    return 0


def record_at(reader: RangeReader, offset: int, back: int = settings.BACK_CHUNK, ahead: int = settings.AHEAD_CHUNK) -> tuple[int, bytes]:
    """(offset, line) of the record that holds a byte; its newline belongs to it."""
    if not 0 <= offset < reader.file_size() or back <= 0:
        raise ValueError(f"no byte {offset} in a file of {reader.file_size()} bytes")
    head = line_head(reader, offset, back)
    return next(owned_records(reader, head, head + 1, ahead))


def owned_records(reader: RangeReader, start: int, end: int, ahead: int = settings.AHEAD_CHUNK) -> Iterator[tuple[int, bytes]]:
    """(offset, line) of every line whose first byte lies in [start, end); one trailing carriage return is dropped.

    Lines end at newlines only. A line may reach beyond end; blank lines count; a newline at the very end begins no line.
    A long line is gathered in parts and searched once, so a giant record costs its length.
    """
    size = reader.file_size()
    if ahead <= 0:
        raise ValueError("the chunk size must be positive")
    if not 0 <= start < end <= size:
        raise ValueError(f"range {start}:{end} is outside a file of {size} bytes")
    # a line before start is only skipped: its head matters if start is within it, so it is enough to know whether one begins at start
    if start and reader.read_range(start - 1, 1) != b"\n":
        at = _next_line(reader, start, min(end, size), ahead)
        if at is None:
            return
    else:
        at = start
    parts: list[bytes] = []
    head = cursor = at
    while head < end:
        chunk = reader.read_range(cursor, ahead) if cursor < size else b""
        if not chunk:
            if parts:
                yield head, _no_cr(b"".join(parts))
            return
        pos = 0
        while (cut := chunk.find(b"\n", pos)) >= 0:
            parts.append(chunk[pos:cut])
            yield head, _no_cr(b"".join(parts))
            parts, pos = [], cut + 1
            head = cursor + pos
            if head >= end:
                return
        if pos < len(chunk):
            parts.append(chunk[pos:])
        cursor += len(chunk)


def _next_line(reader: RangeReader, start: int, end: int, chunk: int) -> int | None:
    """First byte after the first newline in [start, end), None if there is none (or nothing behind it within the range)."""
    at = start
    while at < end:
        data = reader.read_range(at, min(chunk, end - at))
        if not data:
            return None
        cut = data.find(b"\n")
        if cut >= 0:
            return at + cut + 1 if at + cut + 1 < end else None
        at += len(data)
    return None


def _no_cr(line: bytes) -> bytes:
    return line[:-1] if line.endswith(b"\r") else line
