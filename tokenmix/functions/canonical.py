"""Canonical JSON, hashes and atomic files for the small artifacts at the driver."""

from __future__ import annotations

import hashlib
import json
import os
import tempfile


def canonical(payload, exclude: tuple[str, ...] = ()) -> bytes:
    """Two-space indented, key-sorted, unescaped UTF-8 with a final newline."""
    if exclude:
        payload = {k: v for k, v in payload.items() if k not in exclude}
    return (json.dumps(payload, indent=2, sort_keys=True, ensure_ascii=False) + "\n").encode()


def sha256(payload) -> str:
    """Of the payload's canonical bytes, which are those of its file."""
    return hashlib.sha256(canonical(payload)).hexdigest()


def self_hash(payload: dict, field: str) -> str:
    """SHA-256 of the payload without its own hash field."""
    return hashlib.sha256(canonical(payload, (field,))).hexdigest()


def file_sha256(path: str) -> str:
    with open(path, "rb") as f:
        return hashlib.file_digest(f, "sha256").hexdigest()


def write_json(path: str, payload, sort_keys: bool = True) -> None:
    """Replaces path as a whole: temporary file, sync, rename, sync of the folder."""
    folder = os.path.dirname(os.path.abspath(path))
    os.makedirs(folder, exist_ok=True)
    data = canonical(payload) if sort_keys else (json.dumps(payload, indent=2, ensure_ascii=False) + "\n").encode()
    handle, temporary = tempfile.mkstemp(dir=folder, prefix=os.path.basename(path), suffix=".tmp")
    try:
        with os.fdopen(handle, "wb") as f:
            f.write(data)
            f.flush()
            os.fsync(f.fileno())
        os.chmod(temporary, 0o644)
        os.replace(temporary, path)
    except BaseException:
        if os.path.exists(temporary):
            os.unlink(temporary)
        raise
    directory = os.open(folder, os.O_RDONLY)
    try:
        os.fsync(directory)
    finally:
        os.close(directory)


def read_json(path: str):
    with open(path, encoding="utf-8") as f:
        return json.load(f)
