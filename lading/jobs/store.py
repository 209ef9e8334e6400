"""Access to object bodies from inside tasks."""

from __future__ import annotations

import os
import re
import uuid
from collections.abc import Callable
from contextlib import suppress

from pyarrow import fs

# Objects that one task works on at once, where a call goes over a network.
CALLS_AT_ONCE = 10

# Stores on which a write shows up piece by piece; there a body is written beside its final
# place and renamed. On the others an object appears only when its stream is closed.
_RENAMING = ("local", "hdfs")

# Names of bodies still being written; reserved, and the only ones a listing leaves out.
_UNFINISHED = re.compile(r"\.[0-9a-f]{32}\.lading-part")


class ObjectRoot:
    """Objects below one root URI (``file:``, ``hdfs://``, ``s3a://``, ``gs://``, ...)."""

    def __init__(self, uri: str):
        self.uri = uri.rstrip("/")
        if "://" not in uri:
            uri = uri.removeprefix("file:")
        uri = uri.replace("s3a://", "s3://", 1) if uri.startswith("s3a://") else uri
        if uri.startswith("/"):
            self.files, self.base = fs.LocalFileSystem(), uri.rstrip("/")
        else:
            self.files, base = fs.FileSystem.from_uri(uri)
            self.base = base.rstrip("/")
        self.renames = self.files.type_name in _RENAMING
        # Waiting for a network overlaps; calls of a local file system only get into each other's way.
        self.calls = 1 if self.files.type_name == "local" else CALLS_AT_ONCE

    def path(self, key: str) -> str:
        if self.renames and (key.endswith("/") or {"", ".", ".."} & set(key.split("/"))):
            raise ValueError(f"key {key!r} is no file name on this store")
        return f"{self.base}/{key}"

    def chunks(self, key: str, size: int):
        """The body in pieces of at most ``size`` bytes."""
        with self.files.open_input_stream(self.path(key)) as stream:
            while piece := stream.read(size):
                yield piece

    def ranged(self, key: str, offset: int, length: int, size: int):
        """``length`` bytes from ``offset`` on, in pieces of at most ``size`` bytes."""
        with self.files.open_input_file(self.path(key)) as file:
            stop = offset + length
            while offset < stop:
                piece = file.read_at(min(size, stop - offset), offset)
                if not piece:
                    raise OSError(f"{key!r} ends before byte {stop}")
                yield piece
                offset += len(piece)

    def scan(self, folder: str, wanted: Callable[[str], bool] = lambda name: True):
        """Of names that are ``wanted``: (name, whether it is a folder, size, time in microseconds) of what lies straight below
        ``folder`` ("" is the root). On a local file system one after the other, as they are found;
        other stores hand out a folder at once. What goes away meanwhile is left out."""
        place = f"{self.base}/{folder}".rstrip("/") or "/"
        if self.files.type_name == "local":
            with os.scandir(place) as found:
                for entry in found:
                    with suppress(FileNotFoundError):
                        # A name costs nothing to look at, the rest a call.
                        if wanted(entry.name) and not _UNFINISHED.fullmatch(entry.name):
                            about = entry.stat()
                            is_folder = entry.is_dir()
                            yield (entry.name, is_folder, 0 if is_folder else about.st_size,
                                   about.st_mtime_ns // 1000)
            return
        for info in self.files.get_file_info(fs.FileSelector(place)):
            if wanted(info.base_name) and not _UNFINISHED.fullmatch(info.base_name):
                yield (info.base_name, info.type == fs.FileType.Directory, info.size or 0,
                       (info.mtime_ns or 0) // 1000)

    def entries(self, folder: str):
        """(name, whether it is a folder) of what lies straight below ``folder``."""
        for name, is_folder, *_ in self.scan(folder):
            yield name, is_folder

    def write(self, key: str, pieces, headers: dict[str, str] | None = None) -> int:
        """Replaces the whole object; readers never see a part of it."""
        path = self.path(key)
        folder = path.rpartition("/")[0]
        place = f"{folder}/.{uuid.uuid4().hex}.lading-part" if self.renames else path
        written = 0
        try:
            with self._opened(place, folder, headers) as stream:
                for piece in pieces:
                    stream.write(piece)
                    written += len(piece)
            if self.renames:
                self.files.move(place, path)
        except BaseException:
            if self.renames:
                with suppress(OSError):
                    self.files.delete_file(place)
            raise
        return written

    def _opened(self, place: str, folder: str, headers: dict[str, str] | None):
        """A stream to ``place``; only a missing folder is made, as most are there."""
        if self.files.type_name == "local":
            with suppress(FileNotFoundError):
                return self.files.open_output_stream(place, metadata=headers or None)
        if self.renames:
            self.files.create_dir(folder, recursive=True)
        return self.files.open_output_stream(place, metadata=headers or None)

    # An object may also be written by several tasks. Its parts gather in a staged place that
    # is reserved for the upload, and appear as the object in one step. Where the store is a file
    # system that all tasks write to, parts go to their offsets in one staged file, which is then
    # renamed; on other stores they are objects below the staged place, which one task puts
    # together. Writing a part twice is harmless: it is the same bytes at the same place.

    def _staged(self, key: str, upload: str) -> str:
        return f"{self.path(key).rpartition('/')[0]}/.{upload}.lading-part"

    def write_part(self, key: str, upload: str, number: int, offset: int, pieces) -> int:
        """Writes one part of an upload (32 hex digits); the bytes written."""
        staged, written = self._staged(key, upload), 0
        if self.files.type_name != "local":
            place = f"{staged}/{number:08d}"
            if self.renames:
                self.files.create_dir(staged, recursive=True)
            with self.files.open_output_stream(place) as stream:
                for piece in pieces:
                    stream.write(piece)
                    written += len(piece)
            return written
        try:
            file = os.open(staged, os.O_RDWR | os.O_CREAT, 0o666)
        except FileNotFoundError:
            os.makedirs(os.path.dirname(staged), exist_ok=True)
            file = os.open(staged, os.O_RDWR | os.O_CREAT, 0o666)
        try:
            for piece in pieces:
                view = memoryview(piece)
                while view:
                    done = os.pwrite(file, view, offset + written)
                    written += done
                    view = view[done:]
        finally:
            os.close(file)
        return written

    def finish(self, key: str, upload: str, parts: int, size: int, piece_bytes: int,
               headers: dict[str, str] | None = None) -> None:
        """Makes the staged parts the object. A repeat after success finds it done."""
        staged, path = self._staged(key, upload), self.path(key)
        if self.files.type_name == "local":
            if not os.path.exists(staged) and os.path.exists(path) and os.path.getsize(path) == size:
                return
            if os.path.getsize(staged) != size:
                raise OSError(f"{key!r} has {os.path.getsize(staged)} of {size} bytes")
            self.files.move(staged, path)
            return
        names = [f"{staged}/{number:08d}" for number in range(1, parts + 1)]
        infos = self.files.get_file_info(names)
        if all(i.type == fs.FileType.NotFound for i in infos):
            info = self.files.get_file_info(path)
            if info.type == fs.FileType.File and info.size == size:
                return
        if sum(i.size or 0 for i in infos) != size:
            raise OSError(f"the parts of {key!r} have not {size} bytes")

        def pieces():
            for name in names:
                with self.files.open_input_stream(name) as stream:
                    while piece := stream.read(piece_bytes):
                        yield piece

        self.write(key, pieces(), headers)
        self.abort(key, upload)

    def abort(self, key: str, upload: str) -> None:
        """Removes what an upload has staged."""
        staged = self._staged(key, upload)
        with suppress(FileNotFoundError):
            if self.files.type_name == "local":
                os.remove(staged)
            else:
                self.files.delete_dir(staged)

    def same_store(self, other: ObjectRoot) -> bool:
        return self.files.type_name == other.files.type_name and self.files.equals(other.files)

    def copy_to(self, key: str, other: ObjectRoot, other_key: str) -> bool:
        """Copies inside one object store, without moving bytes through this process.

        False on stores where a copy shows up piece by piece; there it is written and renamed.
        """
        if self.renames:
            return False
        self.files.copy_file(self.path(key), other.path(other_key))
        return True

    def exists(self, key: str) -> bool:
        return self.files.get_file_info(self.path(key)).type != fs.FileType.NotFound

    def delete(self, key: str) -> None:
        """Removing what is not there is no error."""
        with suppress(FileNotFoundError):
            self.files.delete_file(self.path(key))
