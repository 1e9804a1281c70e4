"""Binary files in the shared folder, written by tasks: whole or not at all."""

from __future__ import annotations

import uuid

from pyarrow import fs


def _at(base: str) -> tuple[fs.FileSystem, str]:
    system, path = fs.FileSystem.from_uri(base)
    return system, path.rstrip("/")


def write_whole(base: str, name: str, parts) -> None:
    """Write under a name of this attempt, then move into place: a lost task leaves no half file under ``name``."""
    system, folder = _at(base)
    system.create_dir(folder, recursive=True)
    attempt = f"{folder}/_{name}.{uuid.uuid4().hex}"
    with system.open_output_stream(attempt) as out:
        for part in parts:
            out.write(part)
    system.move(attempt, f"{folder}/{name}")


def read_whole(base: str, name: str) -> bytes:
    system, folder = _at(base)
    with system.open_input_stream(f"{folder}/{name}") as f:
        return f.read()


def read_range(base: str, name: str, begin: int, size: int) -> bytes:
    system, folder = _at(base)
    with system.open_input_file(f"{folder}/{name}") as f:
        return f.read_at(size, begin)
