"""Archive expansion (A10, A11, Q11): archive rows → member rows, in memory.

The one Python step of the describe stage: ``mapInPandas`` opens each archive
with ``tarfile`` / ``zipfile`` inside the task and emits one row per regular
member that is wanted.  Tars (and the inner tar of a ``.gem``) are streamed,
zips are read through a seekable file, so one member body is in memory at a
time, besides a batch of at most about ``BATCH_BYTES`` on its way to the JVM.
Nothing is written to disk and member names are data, never paths.

* only regular files; links, devices and directories are skipped;
* no limit on members, sizes or ratios: padding cannot hide a file;
* a member that does not fit a cell or cannot be read leaves a row with ``error`` set, and
  the members after it are read all the same: a tar goes on at the next header that holds, a
  zip without its directory is read by its members' own headers (a row of null
  ``member`` with ``error`` tells what was lost);
* an archive that cannot be read to its end leaves such a row, too;
* an archive read to its end closes with a row of null ``member`` and ``error``.

``.gem`` files are outer tars whose ``*data.tar.gz`` member holds the tree.
"""

from __future__ import annotations

import io
import struct
import tarfile
import zipfile
import zlib
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pkgsift.session import ship_package

MEMBER_COLUMNS = "member string, size bigint, content binary, error string"

BATCH_BYTES = 64 * 1024 * 1024
#: A cell of a row holds at most this many bytes (Spark's array limit, less a margin).
CELL_BYTES = (1 << 31) - (1 << 20)


def _kind(name: str) -> str | None:
    n = name.lower()
    if n.endswith(".gem"):
        return "gem"
    if n.endswith((".zip", ".whl")):
        return "zip"
    if n.endswith((".tar.gz", ".tgz", ".tar")):
        return "tar"
    return None


Member = tuple[str | None, int | None, bytes | None, str | None]
#: What reading a damaged member raises.
DAMAGE = (tarfile.TarError, zipfile.BadZipFile, zlib.error, EOFError, OSError, NotImplementedError, RuntimeError)


def _member(name: str, size: int, open_body) -> Member:
    """One member's row; if its body cannot be read, its error stands for it."""
    if size > CELL_BYTES:
        return name, size, None, "member does not fit a cell"
    try:
        with open_body() as f:
            body = f.read(CELL_BYTES + 1)
    except DAMAGE as e:
        return name, size, None, f"{type(e).__name__}: {e}"[:500]
    if len(body) > CELL_BYTES:  # the header's size may lie
        return name, size, None, "member does not fit a cell"
    return name, len(body), body, None


class _Block(tarfile.TarInfo):
    """Headers that also note on their archive how many bytes were none."""

    @classmethod
    def fromtarfile(cls, tar):
        try:
            return super().fromtarfile(tar)
        except tarfile.InvalidHeaderError:
            tar.lost = getattr(tar, "lost", 0) + tarfile.BLOCKSIZE
            raise


def _lost(size: int, before: str) -> Member:
    return None, size, None, f"damaged: {size} bytes without a header before {before}"


def _tar_members(source, mode: str, wanted) -> Iterator[Member]:
    """Members in order.  A damaged header is skipped block by block up to the next
    one that holds, and an error row tells how much was lost."""
    with tarfile.open(fileobj=source, mode=mode, tarinfo=_Block, ignore_zeros=True) as tar:
        for m in tar:
            name = m.name.removeprefix("./")
            if getattr(tar, "lost", 0):
                yield _lost(tar.lost, name)
                tar.lost = 0
            if m.isreg() and wanted(name):
                yield _member(name, m.size, lambda m=m: tar.extractfile(m))
            tar.members = []  # read once, in order: headers passed are not kept, nor the archive by them
        if getattr(tar, "lost", 0):
            yield _lost(tar.lost, "the end")


def _zip_members(source, wanted) -> Iterator[Member]:
    """Members by the central directory, or without one by their own headers."""
    try:
        z = zipfile.ZipFile(source)
    except zipfile.BadZipFile as e:
        yield None, None, None, f"{type(e).__name__}: {e}"[:500]
        yield from _local_members(source, wanted)
        return
    with z:
        for info in z.infolist():
            name = info.filename.removeprefix("./")
            if not info.is_dir() and wanted(name):
                yield _member(name, info.file_size, lambda info=info: z.open(info))


_LOCAL = struct.Struct("<4s5H3I2H")
_CHUNK = 1 << 20


def _local_members(source, wanted) -> Iterator[Member]:
    """Members of a zip file found by their local headers, read one after the other.

    A deflated body tells its own end; a stored one without a size ends at the
    next signature.  Bytes that begin no header are passed over."""
    at = 0
    while (at := _find(source, at, b"PK\x03\x04")) >= 0:
        source.seek(at)
        head = source.read(_LOCAL.size)
        if len(head) < _LOCAL.size:
            return
        _, _, flags, method, _, _, crc, packed, size, n_name, n_extra = _LOCAL.unpack(head)
        raw = source.read(n_name)
        name = raw.decode("utf-8" if flags & 0x800 else "cp437", "replace").removeprefix("./")
        body_at = at + _LOCAL.size + n_name + n_extra
        if name.endswith("/") or method not in (0, 8) or len(raw) < n_name:
            at += 4
            continue
        body, end = _local_body(source, body_at, method, packed if not flags & 8 else None)
        at = max(end, at + 4)
        if body is None:
            if wanted(name):
                yield name, size, None, "damaged body"
        elif wanted(name):
            fits = len(body) <= CELL_BYTES
            whole = bool(flags & 8) or zlib.crc32(body) == crc
            yield name, len(body), body if fits and whole else None, None if fits and whole else "damaged body" if fits else "member does not fit a cell"


def _local_body(source, at: int, method: int, packed: int | None) -> tuple[bytes | None, int]:
    """(bytes, place after them) of one body; None if it does not unpack."""
    source.seek(at)
    if method == 0:
        end = at + packed if packed is not None else _find(source, at, b"PK")
        source.seek(at)
        body = source.read(min(end - at if end >= 0 else CELL_BYTES + 1, CELL_BYTES + 1))
        return body, at + len(body)
    z, out, size, read = zlib.decompressobj(-15), [], 0, 0
    while not z.eof and size <= CELL_BYTES and (data := source.read(_CHUNK)):
        read += len(data)
        try:
            out.append(z.decompress(data, CELL_BYTES + 1))
        except zlib.error:
            return None, at
        size += len(out[-1])
    return (b"".join(out) if z.eof else None), at + read - len(z.unused_data) if z.eof else at


def _find(source, at: int, mark: bytes) -> int:
    """The next place of ``mark`` from ``at`` on, or -1."""
    source.seek(at)
    held = b""
    while data := source.read(_CHUNK):
        held += data
        if (k := held.find(mark)) >= 0:
            return at + k
        at += max(0, len(held) - len(mark) + 1)
        held = held[-(len(mark) - 1):]
    return -1


def _gem_members(source, wanted) -> Iterator[Member]:
    with tarfile.open(fileobj=source, mode="r|*", ignore_zeros=True) as outer:
        for m in outer:
            if m.isreg() and m.name.endswith("data.tar.gz"):
                yield from _tar_members(outer.extractfile(m), "r|gz", wanted)
                return
    raise ValueError("no data.tar.gz in the gem")


def archive_members(path: str, source, suffixes: tuple[str, ...] | None = None) -> Iterator[Member]:
    """(name, size, body, error) of the wanted members; ``source`` is a binary
    file, seekable for zips.  ``suffixes`` None wants every member."""
    def wanted(name: str) -> bool:
        return suffixes is None or name.endswith(suffixes)

    kind = _kind(path)
    if kind == "zip":
        return _zip_members(source, wanted)
    if kind == "gem":
        return _gem_members(source, wanted)
    if kind == "tar":
        return _tar_members(source, "r|*", wanted)
    raise ValueError("not an archive name")


def _expander(keys: list[str], open_source: Callable, suffixes):
    """mapInPandas body: archive rows → key columns + member rows."""
    cols = [*keys, "member", "size", "content", "error"]

    def expand(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows, held = [], 0
        for pdf in batches:
            for row in pdf.to_dict("records"):
                key = tuple(row[k] for k in keys)
                try:
                    whole = True
                    with open_source(row) as source:
                        for name, size, body, error in archive_members(row["path"], source, suffixes):
                            whole = whole and name is not None
                            rows.append((*key, name, size, body, error))
                            held += len(body or b"") + 256
                            if held >= BATCH_BYTES:  # bounded batches back to the JVM
                                yield pd.DataFrame(rows, columns=cols)
                                rows, held = [], 0
                    if whole:
                        rows.append((*key, None, None, None, None))
                except Exception as e:  # an unreadable or broken archive: a marker row
                    rows.append((*key, None, None, None, f"{type(e).__name__}: {e}"[:500]))
            if rows:
                yield pd.DataFrame(rows, columns=cols)
                rows, held = [], 0

    return expand


def _schema(df: DataFrame, keys: list[str]) -> str:
    kinds = dict(df.dtypes)
    return ", ".join([*(f"`{k}` {kinds[k]}" for k in keys), MEMBER_COLUMNS])


def expand_archives(archives: DataFrame, suffixes: tuple[str, ...] | None = None) -> DataFrame:
    """(path, bytes, key columns) archive rows → (path, key columns, member, size,
    content, error)."""
    ship_package(archives.sparkSession)
    keys = [c for c in archives.columns if c != "bytes"]

    def open_bytes(row):
        if row["bytes"] is None:
            raise ValueError("unreadable")
        return io.BytesIO(row["bytes"])

    return archives.mapInPandas(_expander(keys, open_bytes, suffixes), _schema(archives, keys))


def expand_archives_at(spark: SparkSession, root: str, listing: DataFrame | None = None,
                       suffixes: tuple[str, ...] | None = None) -> DataFrame:
    """The same for archives of a tree: chosen rows with a ``path`` below ``root``
    (by default all archives) are opened and expanded in the same task."""
    from pkgsift.sources.tree import ARCHIVE_GLOB, _fs, list_tree

    ship_package(spark)
    chosen = list_tree(spark, root, ARCHIVE_GLOB).select("path") if listing is None else listing

    def open_path(row):
        fs, base = _fs(root)
        full = f"{base}/{row['path']}"
        return fs.open_input_file(full) if _kind(row["path"]) == "zip" else fs.open_input_stream(full, compression=None)

    return chosen.mapInPandas(_expander(chosen.columns, open_path, suffixes), _schema(chosen, chosen.columns))


def members_as_files(members: DataFrame) -> DataFrame:
    """Member rows → (package, version, archive, rel_path, size, content, from_archive)
    for archives stored at ``pkg/ver/.../name.ext``."""
    parts = F.split(F.col("path"), "/")
    from pkgsift.functions.evidence import decode_text
    return (members.where(F.col("error").isNull() & F.col("member").isNotNull() & (F.size(parts) >= 3))
            .select(parts[0].alias("package"), parts[1].alias("version"),
                    F.col("path").alias("archive"), F.col("member").alias("rel_path"),
                    "size", decode_text(F.col("content")).alias("content"),
                    F.lit(True).alias("from_archive")))
