"""Files on whatever store a path or URL names, for code that runs in tasks."""

from __future__ import annotations

import json
import uuid

from pyarrow import fs as arrow_fs


def filesystem(path: str) -> tuple[arrow_fs.FileSystem, str]:
    """The store of a path or URL and the path inside it; Hadoop's spellings are known."""
    if path.startswith("s3a://"):
        path = "s3://" + path[len("s3a://") :]
    elif path.startswith("file:") and not path.startswith("file://"):
        path = path[len("file:") :]
    return arrow_fs.FileSystem.from_uri(path)


def write_whole(path: str, data: bytes) -> None:
    """Write a small file so that nobody ever sees a part of it."""
    files, place = filesystem(path)
    files.create_dir(place.rsplit("/", 1)[0], recursive=True)
    hidden = f"{place.rsplit('/', 1)[0]}/.{uuid.uuid4().hex}"
    with files.open_output_stream(hidden) as out:
        out.write(data)
    files.move(hidden, place)


def exists(path: str) -> bool:
    files, place = filesystem(path)
    return files.get_file_info(place).type != arrow_fs.FileType.NotFound


def read_json(path: str) -> list[dict]:
    """The JSON files of a folder in the order of their names; none if it isn't there."""
    files, place = filesystem(path)
    selector = arrow_fs.FileSelector(place, allow_not_found=True)
    names = sorted(f.path for f in files.get_file_info(selector) if f.base_name.endswith(".json") and not f.base_name.startswith("."))
    found = []
    for name in names:
        with files.open_input_stream(name) as source:
            found.append(json.loads(source.read()))
    return found


def delete_folder(path: str) -> None:
    """Delete a folder if it is there."""
    files, place = filesystem(path)
    if files.get_file_info(place).type == arrow_fs.FileType.Directory:
        files.delete_dir(place)


def folders_in(path: str) -> list[str]:
    """Names of the folders in a folder."""
    files, place = filesystem(path)
    found = files.get_file_info(arrow_fs.FileSelector(place, allow_not_found=True))
    return [f.base_name for f in found if f.type == arrow_fs.FileType.Directory]
