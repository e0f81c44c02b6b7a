"""Objects of a store by name: a folder of any file system that Hadoop knows, so a bucket as well as a disk.

Single objects are handled from the driver, as calls of a store are; whole sets of objects are read by ``files.listing``
and the binary reader and written by the writers of DataFrames.
"""

from __future__ import annotations

import json

from pyspark.sql import SparkSession

from graniteflow.functions.paths import CONTENT_TYPES


class ObjectStore:
    """put, get, info, copy, move and delete of objects below ``root``. Names are paths without a leading slash."""

    def __init__(self, spark: SparkSession, root: str):
        self.jvm, self.conf = spark._jvm, spark._jsc.hadoopConfiguration()
        self.hadoop = self.jvm.org.apache.hadoop.fs
        self.root = root.rstrip("/")
        self.fs = self.hadoop.Path(self.root).getFileSystem(self.conf)

    def path(self, name: str):
        parts = name.strip("/").split("/")
        if not name.strip("/") or ".." in parts:
            raise ValueError(f"not a name of an object: {name!r}")
        return self.hadoop.Path(f"{self.root}/{'/'.join(parts)}")

    def put(self, name: str, data: bytes) -> int:
        """Write an object, over the one that is there; its size."""
        out = self.fs.create(self.path(name), True)
        try:
            out.write(bytearray(data))
        finally:
            out.close()
        return len(data)

    def put_json(self, name: str, value) -> int:
        return self.put(name, json.dumps(value, ensure_ascii=False, sort_keys=True).encode())

    def get(self, name: str) -> bytes | None:
        """The bytes of an object, None where there is none."""
        if not self.exists(name):
            return None
        source = self.fs.open(self.path(name))
        try:
            return bytes(self.jvm.org.apache.commons.io.IOUtils.toByteArray(source))
        finally:
            source.close()

    def get_json(self, name: str):
        data = self.get(name)
        return None if data is None else json.loads(data)

    def exists(self, name: str) -> bool:
        return bool(self.fs.exists(self.path(name)))

    def info(self, name: str) -> dict | None:
        """Name, size and content type of an object, None where there is none."""
        if not self.exists(name):
            return None
        ext = name.rsplit(".", 1)[-1].lower() if "." in name else ""
        return {"name": name, "size": self.fs.getFileStatus(self.path(name)).getLen(), "content_type": CONTENT_TYPES.get(ext, "application/octet-stream")}

    def copy(self, name: str, to: str) -> bool:
        """Copy an object; False where there is none."""
        if not self.exists(name):
            return False
        target = self.path(to)
        self.fs.mkdirs(target.getParent())
        return bool(self.hadoop.FileUtil.copy(self.fs, self.path(name), self.fs, target, False, True, self.conf))

    def move(self, name: str, to: str) -> bool:
        """Copy, then delete; False where there is no such object."""
        return self.copy(name, to) and (name == to or self.delete(name))

    def delete(self, name: str) -> bool:
        """Delete one object; False where there is none."""
        return bool(self.exists(name) and self.fs.delete(self.path(name), False))

    def listing(self, prefix: str = "", most: int = 0) -> list[tuple[str, int]]:
        """(name, size) of the objects whose names start with a prefix, in order of name; 0 means all."""
        folder = prefix.rsplit("/", 1)[0] if "/" in prefix else ""
        start = self.hadoop.Path(f"{self.root}/{folder}" if folder else self.root)
        out: list[tuple[str, int]] = []
        if self.fs.exists(start):
            files, base = self.fs.listFiles(start, True), self.fs.getFileStatus(self.hadoop.Path(self.root)).getPath().toString()
            while files.hasNext():
                f = files.next()
                name = f.getPath().toString()[len(base) + 1 :]
                if name.startswith(prefix) and not name.endswith(".crc"):
                    out.append((name, f.getLen()))
        out.sort()
        return out[:most] if most else out

    def delete_prefix(self, prefix: str) -> int:
        """Delete the objects whose names start with a prefix; their number. An empty prefix is refused."""
        if not prefix.strip("/"):
            raise ValueError("a prefix is needed")
        return sum(self.delete(name) for name, _ in self.listing(prefix))

    def size(self) -> int:
        """Bytes of all objects."""
        return sum(n for _, n in self.listing())

    def folders(self) -> list[str]:
        """Names of the folders right below the root."""
        at = self.hadoop.Path(self.root)
        return sorted(f.getPath().getName() for f in self.fs.listStatus(at) if f.isDirectory()) if self.fs.exists(at) else []

    def delete_folder(self, name: str) -> bool:
        """Delete a folder and all below it in one call; False where there is none."""
        return bool(self.exists(name) and self.fs.delete(self.path(name), True))
