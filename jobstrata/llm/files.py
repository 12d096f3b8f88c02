"""Files of a task in the folder that all executors share."""

from __future__ import annotations

import uuid

from pyarrow import fs


def filesystem(path: str):
    """The file system of a path or URI, and the path inside it."""
    if "://" not in path and not path.startswith("/"):
        path = path.replace("file:", "file://", 1)  # Hadoop writes file:/folder
    return fs.FileSystem.from_uri(path)


def fresh(folder: str, part: int, ending: str):
    """Create a file under a name no other attempt uses; its path and the open stream."""
    path = f"{folder.rstrip('/')}/part-{part:06d}-{uuid.uuid4().hex}.{ending}"
    place, inner = filesystem(path)
    place.create_dir(inner.rpartition("/")[0], recursive=True)
    return path, place.open_output_stream(inner, compression=None)  # no guess from the name


class RangeReader:
    """Reads byte ranges of many files, holding a few of them open."""

    def __init__(self, most: int = 32):
        self.most, self.open = most, {}

    def read(self, path: str, offset: int, length: int) -> bytes:
        if path not in self.open:
            if len(self.open) >= self.most:
                self.open.pop(next(iter(self.open))).close()
            place, inner = filesystem(path)
            self.open[path] = place.open_input_file(inner)
        file = self.open[path]
        file.seek(offset)
        return file.read(length)

    def size(self, path: str) -> int:
        self.read(path, 0, 0)
        return self.open[path].size()

    def close(self) -> None:
        for file in self.open.values():
            file.close()
        self.open = {}
