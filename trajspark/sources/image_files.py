"""Image sizes from file headers.

Only files that are named are opened, and only their heads are read. Keep the table as parquet if
the same images are priced again: `refresh_image_dims` then opens what is new or changed only.
"""

import struct

import pandas as pd
from pyspark.sql import DataFrame, functions as F, types as T

from trajspark.functions import images as I
from trajspark.sources.lineage import cut_lineage

SIZE = T.StructType([T.StructField("width", T.LongType()), T.StructField("height", T.LongType())])
HEAD = 1 << 16           # bytes of a file that are read first
# Start-of-frame markers that carry a size.
JPEG_FRAMES = frozenset(range(0xC0, 0xD0)) - {0xC4, 0xC8, 0xCC}


def _webp_size(content):
    kind, body = content[12:16], content[20:30]
    if kind == b"VP8X":
        return tuple(int.from_bytes(body[i:i + 3], "little") + 1 for i in (4, 7))
    if kind == b"VP8L" and body[:1] == b"\x2f":
        bits = int.from_bytes(body[1:5], "little")
        return (bits & 0x3FFF) + 1, (bits >> 14 & 0x3FFF) + 1
    if kind == b"VP8 " and body[3:6] == b"\x9d\x01\x2a":
        return tuple(x & 0x3FFF for x in struct.unpack("<HH", body[6:10]))
    return None


def header_size(content):
    """(width, height) of a JPEG, GIF, BMP or WebP header, or None."""
    if content[:6] in (b"GIF87a", b"GIF89a") and len(content) >= 10:
        return struct.unpack("<HH", content[6:10])
    if content[:2] == b"BM" and len(content) >= 26:
        width, height = struct.unpack("<ii", content[18:26])
        return width, abs(height)
    if content[:4] == b"RIFF" and content[8:12] == b"WEBP" and len(content) >= 30:
        return _webp_size(content)
    if content[:2] != b"\xff\xd8":
        return None
    at = 2
    while at + 9 <= len(content):
        if content[at] != 0xFF:
            return None
        marker = content[at + 1]
        if marker == 0xFF:
            at += 1
        elif marker in JPEG_FRAMES:
            height, width = struct.unpack(">HH", content[at + 5:at + 9])
            return width, height
        elif marker == 0x01 or 0xD0 <= marker <= 0xD8:
            at += 2
        else:
            at += 2 + struct.unpack(">H", content[at + 2:at + 4])[0]
    return None


@F.pandas_udf(SIZE)
def _other_size(contents: pd.Series) -> pd.DataFrame:
    sizes = [header_size(c) if c is not None else None for c in contents]
    return pd.DataFrame({"width": pd.array([s and s[0] for s in sizes], "Int64"),
                         "height": pd.array([s and s[1] for s in sizes], "Int64")})


def _place(path, systems):
    """(file system, place in it) of a plain path or a URI; one client per authority."""
    import re
    from pyarrow import fs
    match = re.match(r"([A-Za-z][A-Za-z0-9+.-]*):(//([^/]*))?(/.*)$", path)
    scheme, host = (match[1].lower(), match[3] or "") if match else ("file", "")
    if (scheme, host) not in systems:
        systems[scheme, host] = ((fs.LocalFileSystem(), "") if scheme == "file"
                                 else fs.FileSystem.from_uri(f"{match[1]}://{host}/"))
    system, base = systems[scheme, host]
    return system, base.rstrip("/") + (match[4] if match else path)


def _head(system, place):
    """The first bytes of a file: enough for its size, or all of it if there is none."""
    with system.open_input_stream(place) as stream:
        content = stream.read(HEAD)
        while content[:2] == b"\xff\xd8" and header_size(content) is None:
            more = stream.read(len(content))
            if not more:
                break
            content += more
    return content


def _heads(batches):
    import pyarrow as pa
    systems = {}
    for batch in batches:
        paths = batch.column(0).to_pylist()
        for k in range(0, len(paths), 128):
            found = {}
            for path in paths[k:k + 128]:
                try:
                    found[path] = _head(*_place(path, systems))
                except FileNotFoundError:
                    pass
                except OSError:
                    found[path] = b""
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(found), pa.string()), pa.array(list(found.values()), pa.binary())],
                ["path", "content"])


def image_dims(files: DataFrame) -> DataFrame:
    """path, width, height, status from (path, content).

    PNG headers are read by native expressions; only other formats are sent to Python.
    """
    png = I.is_png(F.col("content"))
    sized = files.select(
        "path", png.alias("png"),
        F.when(png, I.png_width(F.col("content"))).alias("w"),
        F.when(png, I.png_height(F.col("content"))).alias("h"),
        _other_size(F.when(~png, F.col("content"))).alias("other"))
    width, height = F.coalesce("w", "other.width"), F.coalesce("h", "other.height")
    readable = (width > 0) & (height > 0)
    return sized.select("path", F.when(readable, width).alias("width"),
                        F.when(readable, height).alias("height"),
                        F.when(readable, I.OK).otherwise(I.CORRUPT).alias("status"))


def read_image_dims(paths: DataFrame, path="path", partitions=None) -> DataFrame:
    """Sizes of the files that `paths` names, once per distinct path: path, width, height, status.

    Paths are plain or URIs of any file system the workers' Arrow can open, and come back as
    they were given. Only the head of a file is read. A file that is not there has no row; one
    that is empty, unreadable or no image has the status `corrupt`.
    """
    wanted = paths.select(F.col(path).cast("string").alias("path")).filter(
        F.col("path").isNotNull()).distinct()
    if partitions:
        wanted = wanted.repartition(partitions)
    return image_dims(wanted.mapInArrow(_heads, "path string, content binary"))


NEW, CHANGED, UNCHANGED, DELETED = "new", "changed", "unchanged", "deleted"


def _stats(batches):
    """Size and time of change of the files that are there; none is opened."""
    import pyarrow as pa
    from pyarrow import fs
    systems = {}
    for batch in batches:
        rows = []
        for path in batch.column(0).to_pylist():
            system, place = _place(path, systems)
            info = system.get_file_info(place)
            if info.type == fs.FileType.File:
                rows.append((path, info.size, info.mtime_ns))
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[k] for r in rows], t) for k, t in enumerate(
                (pa.string(), pa.int64(), pa.int64()))], ["path", "size", "modified"])


def stat_files(paths: DataFrame, path="path") -> DataFrame:
    """path, size and modified (nanoseconds) of every file named and there, once each."""
    wanted = paths.select(F.col(path).cast("string").alias("path")).filter(
        F.col("path").isNotNull()).distinct()
    return wanted.mapInArrow(_stats, "path string, size bigint, modified bigint")


def dims_changes(stored: DataFrame, stats: DataFrame) -> DataFrame:
    """path, size, modified and change of every path on either side: new, changed, unchanged or
    deleted, by size and time. A stored path without them, or stored more than once with different
    ones, counts as changed."""
    known = stored.filter("path is not null").groupBy("path").agg(
        F.when((F.min("size") == F.max("size")) & (F.count("size") == F.count("*")), F.max("size"))
        .alias("old_size"),
        F.when((F.min("modified") == F.max("modified")) & (F.count("modified") == F.count("*")),
               F.max("modified")).alias("old_modified"), F.lit(True).alias("known"))
    same = (F.col("size") == F.col("old_size")) & (F.col("modified") == F.col("old_modified"))
    change = (F.when(F.col("size").isNull(), DELETED).when(F.col("known").isNull(), NEW)
              .when(same, UNCHANGED).otherwise(CHANGED))
    return known.join(stats, "path", "full").select("path", "size", "modified",
                                                    change.alias("change"))


def refresh_image_dims(stored: DataFrame, paths: DataFrame | None = None, path="path"):
    """(dims, changes): a stored table of sizes brought up to date, for all its paths and those
    that `paths` names besides.

    `dims` has path, width, height, status, size and modified; start from an empty table of these.
    Every file is asked for its size and time of change, but only new and changed ones are opened;
    rows of deleted files are gone. `changes` tells all paths apart. A file that is written anew
    while this runs keeps the older time, so the next refresh finds it; one that keeps both size and
    time is taken for unchanged. Write the result to a folder of its own, not over `stored`.
    """
    named = stored.select("path")
    if paths is not None:
        named = named.union(paths.select(F.col(path).cast("string")))
    # What the file system says now is asked once; only paths and numbers are kept.
    changes = cut_lineage(dims_changes(stored, stat_files(named)))
    again = changes.filter(F.col("change").isin(NEW, CHANGED))
    opened = image_dims(again.select("path").mapInArrow(_heads, "path string, content binary"))
    opened = opened.join(again.select("path", "size", "modified"), "path")
    kept = stored.join(changes.filter(F.col("change") == UNCHANGED).select("path"), "path",
                       "left_semi").dropDuplicates(["path"])
    columns = ["path", "width", "height", "status", "size", "modified"]
    return kept.select(*columns).unionByName(opened.select(*columns)), changes.select("path", "change")
