"""Files of any store that pyarrow reaches, for the data sources that read them in pieces."""

from __future__ import annotations

from pyarrow import fs


def file_system(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a URI or a plain path, and the path in it."""
    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


def files(path: str, suffix: str = "") -> list[fs.FileInfo]:
    """A file, or the files of a folder that end in ``suffix`` and aren't hidden, by name; a path that isn't there is an error."""
    system, inner = file_system(path)
    info = system.get_file_info(inner)
    if info.type == fs.FileType.NotFound:
        raise FileNotFoundError(path)
    if info.is_file:
        return [info]
    found = [x for x in system.get_file_info(fs.FileSelector(inner)) if x.is_file and x.path.endswith(suffix) and not x.base_name.startswith(("_", "."))]
    return sorted(found, key=lambda x: x.path)
