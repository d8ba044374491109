"""Files in shared storage from tasks and data sources, through pyarrow's file systems."""

from __future__ import annotations


def open_fs(uri: str):
    """(file system, path) of a plain path or any scheme that pyarrow knows (file, hdfs, s3, gs, viewfs)."""
    from pyarrow import fs

    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + uri[5:].lstrip("/")
    if "://" not in uri:
        return fs.LocalFileSystem(), uri
    return fs.FileSystem.from_uri(uri)


def put(uri: str, data: bytes) -> None:
    """Write through a temporary name, then rename: a reader sees the whole file or none."""
    import uuid

    fs, path = open_fs(uri)
    fs.create_dir(path.rsplit("/", 1)[0], recursive=True)
    part = f"{path}.{uuid.uuid4().hex}.tmp"
    with fs.open_output_stream(part, compression=None) as out:
        out.write(data)
    fs.move(part, path)


def get(uri: str, start: int = 0, length: int | None = None) -> bytes:
    fs, path = open_fs(uri)
    with fs.open_input_file(path) as f:
        left = f.size() - start
        return f.read_at(max(0, left if length is None else min(length, left)), start)


def names(uri: str) -> list[str]:
    """Names of the files in a folder, sorted; none if it does not exist. Temporary names are left out."""
    from pyarrow import fs as pafs

    fs, path = open_fs(uri)
    found = fs.get_file_info(pafs.FileSelector(path, allow_not_found=True))
    return sorted(f.base_name for f in found if f.type == pafs.FileType.File and not f.base_name.endswith(".tmp"))
