"""WARC archives with a two-level capture index.

``write`` puts pages into WARC/1.1 files of gzip members, one per record. A payload that
several pages share is written once; the other pages' records revisit it. The files lie in a
folder all tasks share, under names no other attempt of a task uses: what counts
are the captures that the finished tasks list, so a task that runs again leaves
nothing but a file nobody reads.

``index`` sorts captures by a key of their URL with the host reversed, so that a site and
its subdomains lie together, into shards. A shard is one file of compressed blocks of
lines; its sparse directory, the first key and the byte range of each block, stands at
its end. ``lookup`` binary-searches the shards' bounds, a shard's directory, and the lines
of a block; only those blocks are read. ``fetch`` reads the records' byte ranges, those
that lie together in one go.

Files are read and written by ``pyarrow.fs``: the folder may be on any store it knows.
"""

from __future__ import annotations

import hashlib
import json
import struct
import urllib.parse
import uuid
import zlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pagetables.llm.common import maybe_in
from pagetables.session import fresh_path, materialize


@dataclass(frozen=True)
class Archive:
    """Payloads of ``least`` bytes and more are written once. A file is closed beyond
    ``file_bytes``; a block has ``block_lines`` lines, a shard about ``shard_lines``.
    Ranges of up to ``read_bytes`` are read at once, over gaps of up to ``gap_bytes``.
    ``date`` is that of the captures."""

    least: int = 100
    file_bytes: int = 256 << 20
    block_lines: int = 3000
    shard_lines: int = 1 << 18
    read_bytes: int = 8 << 20
    gap_bytes: int = 64 << 10
    level: int = 6
    date: str = "1970-01-01T00:00:00Z"


CAPTURE = "key string, page_id long, url string, digest string, bytes long, type string, file string, offset long, length long"
_NAMES = [f.split()[0] for f in CAPTURE.split(", ")]
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def url_key(url: Column) -> Column:
    """``org,example,www)/path?query``: the host in lower case and reversed, without
    scheme and fragment. A URL without ``://`` has its whole text after an empty host;
    null is ``)``."""
    whole = F.regexp_replace(F.coalesce(url, F.lit("")), r"(?s)#.*$", "")
    host = F.regexp_extract(whole, r"(?s)^[^:/?]*://([^/?]*)", 1)
    rest = F.regexp_replace(whole, r"(?s)^[^:/?]*://[^/?]*", "")
    return F.concat(F.array_join(F.reverse(F.split(F.lower(host), r"\.")), ","), F.lit(")"), rest)


def store(place: str) -> tuple[pyarrow.fs.FileSystem, str]:
    """The file system of a folder and the folder's path there."""
    return pyarrow.fs.FileSystem.from_uri(place) if "://" in place or place.startswith("file:") else (
        pyarrow.fs.LocalFileSystem(),
        place,
    )


def _record(fields: list[tuple[str, str | None]], block: bytes, level: int) -> bytes:
    """A record as a gzip member."""
    head = "".join(f"{k}: {v}\r\n" for k, v in [*fields, ("Content-Length", str(len(block)))] if v is not None)
    packer = zlib.compressobj(level, zlib.DEFLATED, 31)
    return packer.compress(b"WARC/1.1\r\n" + head.encode() + b"\r\n" + block + b"\r\n\r\n") + packer.flush()


def _id(page_id: int | None, digest: str) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}:{digest}>"


def page_record(
    page_id: int | None, url: str | None, payload: bytes | None, digest: str, size: int, first: int | None, rule: Archive
) -> bytes:
    """A response, or a revisit of page ``first`` where the payload is None."""
    target = None if url is None else urllib.parse.quote(url, safe="".join(map(chr, range(0x21, 0x7F))))
    fields = [
        ("WARC-Type", "revisit" if payload is None else "response"),
        ("WARC-Record-ID", _id(page_id, digest)),
        ("WARC-Date", rule.date),
        ("WARC-Target-URI", target),
        ("WARC-Payload-Digest", f"sha256:{digest}"),
        ("Content-Type", "application/http;msgtype=response"),
    ]
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html;charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    if payload is None:
        fields += [("WARC-Refers-To", _id(first, digest)), ("WARC-Profile", PROFILE), ("WARC-Truncated", "length")]
    return _record(fields, head + (payload or b""), rule.level)


def read_record(member: bytes) -> tuple[dict[str, str], dict[str, str], bytes]:
    """A record's fields, its HTTP fields (names in lower case) and its payload."""
    whole = zlib.decompress(member, 31)
    head, _, block = whole.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = block[: int(fields["Content-Length"])]
    if not fields.get("Content-Type", "").startswith("application/http"):
        return fields, {}, block
    http, _, payload = block.partition(b"\r\n\r\n")
    return fields, {k.lower(): v for k, v in (x.split(": ", 1) for x in http.decode().split("\r\n")[1:])}, payload


class _Files:
    """WARC files of one task, each closed beyond a size."""

    def __init__(self, folder: str, rule: Archive) -> None:
        self.fs, self.folder = store(folder)
        self.rule, self.out, self.name, self.at = rule, None, "", 0
        self.fs.create_dir(self.folder, recursive=True)

    def put(self, member: bytes) -> tuple[str, int, int]:
        """Append a member; its file's name, offset and length."""
        if self.out is None:
            self.name, self.at = f"pages-{uuid.uuid4().hex}.warc.gz", 0
            self.out = self.fs.open_output_stream(f"{self.folder}/{self.name}", compression=None)
            fields = [
                ("WARC-Type", "warcinfo"),
                ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid4()}>"),
                ("WARC-Date", self.rule.date),
                ("WARC-Filename", self.name),
                ("Content-Type", "application/warc-fields"),
            ]
            self._append(_record(fields, b"format: WARC File Format 1.1\r\n", self.rule.level))
        place = self.name, self.at, len(member)
        self._append(member)
        if self.at > self.rule.file_bytes:
            self.close()
        return place

    def _append(self, member: bytes) -> None:
        self.out.write(member)
        self.at += len(member)

    def close(self) -> None:
        if self.out is not None:
            self.out.close()
            self.out = None


def _firsts(pages: DataFrame, rule: Archive) -> DataFrame:
    """``digest``, ``first`` and ``pages`` of payloads that pages of several ids share."""
    shared = pages.filter(F.col("bytes") >= rule.least).groupBy("digest").agg(
        F.min("page_id").alias("first"), F.max("page_id").alias("last"), F.count("*").alias("pages"), F.count("page_id").alias("ids")
    )
    several = (F.col("first") < F.col("last")) | ((F.col("ids") > 0) & (F.col("ids") < F.col("pages")))
    return shared.filter(several).select("digest", "first", "pages")


def _with_first(pages: DataFrame, firsts: DataFrame) -> DataFrame:
    """``pages`` with the page to revisit, ``refers_to``, and a payload only for responses.

    A payload that over a thousandth of all these pages share is looked up in place: there are
    under a thousand of them. Of the other pages only those that may share
    their payload move, dealt by it.
    """
    differs = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    revisits = differs & (F.col("bytes") >= F.col("least"))
    shown = [c for c in pages.columns if c not in ("payload", "least")]
    decided = [F.when(revisits, F.col("first")).alias("refers_to"), F.when(~revisits, F.col("payload")).alias("payload")]
    total = firsts.agg(F.sum("pages")).first()[0] or 0
    heavy = firsts.filter(F.col("pages") * 1000 > total).select("digest", "first", F.lit(True).alias("heavy"))
    light = firsts.filter(F.col("pages") * 1000 <= total).select("digest", "first")
    in_place = pages.join(F.broadcast(heavy), "digest", "left")
    flagged = maybe_in(in_place, F.col("digest"), light.select("digest"), "maybe")
    stay = flagged.filter("not maybe or heavy is not null").select(*shown, *decided)
    move = flagged.filter("maybe and heavy is null").drop("first").join(light, "digest", "left")
    move = move.select(*shown, *decided)
    return stay.unionByName(move)


def write(
    pages: DataFrame,
    folder: str,
    page_id: str = "page_id",
    url: str = "url",
    payload: str = "html",
    rule: Archive = Archive(),
) -> DataFrame:
    """Write a record per row of ``pages`` into ``folder``; its captures (see ``CAPTURE``).

    Of pages whose payloads are equal and of ``least`` bytes or more, the one of smallest id is
    the response; the others revisit it. Rows with that same id (repeated rows) are all
    responses; rows without an id revisit, or are responses if no page with an id has their
    payload. A null payload is empty, a null URL has no target. An empty table writes no
    file. Other columns are not read.
    """
    body = F.coalesce(F.col(f"`{payload}`").cast("binary"), F.lit(b""))
    facts = pages.select(
        F.col(f"`{page_id}`").cast("long").alias("page_id"),
        F.col(f"`{url}`").alias("url"),
        url_key(F.col(f"`{url}`")).alias("key"),
        body.alias("payload"),
        F.octet_length(body).cast("long").alias("bytes"),
        F.sha2(body, 256).alias("digest"),
        F.lit(rule.least).alias("least"),
    )
    firsts = materialize(_firsts(facts.select("page_id", "bytes", "digest"), rule), "first-pages")
    rows = _with_first(facts, firsts).select("page_id", "url", "key", "payload", "bytes", "digest", "refers_to")

    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files = None
        for batch in batches:
            files = files or _Files(folder, rule)
            found = []
            for i in range(batch.num_rows):
                page, address, key, body, size, digest, first = (c[i].as_py() for c in batch.columns)
                member = page_record(page, address, body, digest, size, first, rule)
                kind = "response" if body is not None else "revisit"
                found.append((key, page, address, digest, size, kind, *files.put(member)))
            if found:
                columns = [pa.array(c, t) for c, t in zip(zip(*found, strict=True), types, strict=True)]
                yield pa.RecordBatch.from_arrays(columns, names=_NAMES)
        if files:
            files.close()

    types = [pa.int64() if f.endswith(" long") else pa.string() for f in CAPTURE.split(", ")]
    return materialize(rows.mapInArrow(put, CAPTURE), "captures")


_FOOT = "<qq"  # where a shard's directory begins, and how long it is


def index(captures: DataFrame, folder: str, rule: Archive = Archive()) -> DataFrame:
    """Write the captures' index into ``folder``; its shards: ``file``, ``first``, ``last``,
    ``lines``, in no order. Ties of a key go by page id and place; a key with many captures goes over
    several blocks and shards. No captures, no shards."""
    spark = captures.sparkSession
    shards = max(spark.sparkContext.defaultParallelism, -(-captures.count() // rule.shard_lines))
    order = ["key", "page_id", "file", "offset"]
    ranged = captures.select(_NAMES).repartitionByRange(shards, *order).sortWithinPartitions(*order)

    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, at, lines, directory, first, last, total = None, 0, [], [], None, None, 0

        def close_block() -> int:
            block = zlib.compress("\n".join(line for _, line in lines).encode(), 6)
            out.write(block)
            directory.append((lines[0][0], at, len(block)))
            lines.clear()
            return at + len(block)

        for batch in batches:
            for row in batch.to_pylist():
                if out is None:
                    fs, root = store(folder)
                    fs.create_dir(root, recursive=True)
                    name, first = f"shard-{uuid.uuid4().hex}.cdx", row["key"]
                    out = fs.open_output_stream(f"{root}/{name}", compression=None)
                last, total = row["key"], total + 1
                lines.append((last, json.dumps(list(row.values()), ensure_ascii=False)))
                if len(lines) >= rule.block_lines:
                    at = close_block()
        if out is not None:
            if lines:
                at = close_block()
            listed = zlib.compress(json.dumps(directory).encode(), 6)
            out.write(listed + struct.pack(_FOOT, at, len(listed)))
            out.close()
            yield pa.RecordBatch.from_pydict({"file": [name], "first": [first], "last": [last], "lines": [total]})

    return materialize(ranged.mapInArrow(put, "file string, first string, last string, lines long"), "shards")


class _Shard:
    """A shard's sparse directory, and the block that was read last."""

    def __init__(self, fs: pyarrow.fs.FileSystem, path: str) -> None:
        self.file = fs.open_input_file(path)
        foot = struct.calcsize(_FOOT)
        begin, length = struct.unpack(_FOOT, self.file.read_at(foot, self.file.size() - foot))
        self.blocks = json.loads(zlib.decompress(self.file.read_at(length, begin)))
        self.firsts = [b[0] for b in self.blocks]
        self.read, self.lines, self.keys = -1, [], []

    def _open(self, i: int) -> None:
        if self.read != i:
            _, offset, length = self.blocks[i]
            self.lines = [json.loads(x) for x in zlib.decompress(self.file.read_at(length, offset)).decode().split("\n")]
            self.keys, self.read = [x[0] for x in self.lines], i

    def find(self, key: str) -> Iterator[list]:
        """The lines of a key: from the block before the first that begins with it."""
        i = max(0, bisect_left(self.firsts, key) - 1)
        while i < len(self.blocks) and self.firsts[i] <= key:
            self._open(i)
            yield from self.lines[bisect_left(self.keys, key) : bisect_right(self.keys, key)]
            i += 1

    def close(self) -> None:
        self.file.close()


def lookup(keys: DataFrame, shards: DataFrame, folder: str, key: str = "key") -> DataFrame:
    """All captures (see ``CAPTURE``) of the keys; a repeated key counts once, a null one
    never, and one without captures gives no rows.

    The shards' bounds go to all tasks, one row per shard. A key that goes over several
    shards is sought in each of them by itself.
    """
    # Keys compare as code points here and as UTF-8 in Spark, which is the same order.
    bounds = sorted((r["first"], r["last"], r["file"]) for r in shards.select("first", "last", "file").collect())
    firsts, lasts = [b[0] for b in bounds], [b[1] for b in bounds]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for k in batch.column(0).to_pylist():
                found.extend((s, k) for s in range(bisect_left(lasts, k), bisect_right(firsts, k)))
            yield pa.RecordBatch.from_pydict(
                {"shard": pa.array([s for s, _ in found], pa.int32()), "key": pa.array([k for _, k in found], pa.string())}
            )

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = store(folder)
        number, shard = None, None
        for batch in batches:
            found = []
            for s, k in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if s != number:
                    if shard:
                        shard.close()
                    number, shard = s, _Shard(fs, f"{root}/{bounds[s][2]}")
                found.extend(shard.find(k))
                if len(found) >= 10_000:
                    yield rows(found)
                    found = []
            if found:
                yield rows(found)
        if shard:
            shard.close()

    def rows(found: list[list]) -> pa.RecordBatch:
        columns = [pa.array(c, t) for c, t in zip(zip(*found, strict=True), types, strict=True)]
        return pa.RecordBatch.from_arrays(columns, names=_NAMES)

    types = [pa.int64() if f.endswith(" long") else pa.string() for f in CAPTURE.split(", ")]
    asked = keys.select(F.col(f"`{key}`").cast("string").alias("key")).filter("key is not null").distinct()
    placed = asked.mapInArrow(place, "shard int, key string")
    return placed.repartitionByRange("shard", "key").sortWithinPartitions("shard", "key").mapInArrow(find, CAPTURE)


def fetch(captures: DataFrame, folder: str, rule: Archive = Archive(), with_payload: bool = True) -> DataFrame:
    """The captures' records as they stand in the archive: ``page_id``, ``url`` (the target:
    spaces, control characters and letters beyond ASCII are percent-encoded), ``type``,
    ``digest`` (computed for responses, as stated for revisits), ``bytes`` (of the full
    payload), ``refers_to`` and, if asked for, ``payload`` (null for revisits).

    Captures are dealt out by stretches of their files and read in order, so that
    many that lie together cost one read. A response whose payload is not the one
    that its record states fails the job.
    """
    stretch = F.floor(F.col("offset") / rule.read_bytes)
    placed = captures.select("file", "offset", "length", stretch.alias("stretch"))
    # By number: places are small, and a few tasks would do for them, but not for what they name.
    tasks = int(captures.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = placed.repartition(tasks, "file", "stretch").sortWithinPartitions("file", "offset").drop("stretch")

    def get(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = store(folder)
        name, file = None, None
        for batch in batches:
            places = list(zip(*(c.to_pylist() for c in batch.columns), strict=True))
            i = 0
            while i < len(places):
                j, end = i, places[i][1] + places[i][2]
                while (
                    j + 1 < len(places)
                    and places[j + 1][0] == places[i][0]
                    and places[j + 1][1] - end <= rule.gap_bytes
                    and places[j + 1][1] + places[j + 1][2] - places[i][1] <= rule.read_bytes
                ):
                    j += 1
                    end = max(end, places[j][1] + places[j][2])
                if places[i][0] != name:
                    if file:
                        file.close()
                    name = places[i][0]
                    file = fs.open_input_file(f"{root}/{name}")
                data = file.read_at(end - places[i][1], places[i][1])
                found = [_shown(data[o - places[i][1] : o - places[i][1] + n]) for _, o, n in places[i : j + 1]]
                columns = [pa.array(c, t) for c, t in zip(zip(*found, strict=True), types, strict=True)]
                yield pa.RecordBatch.from_arrays(columns[: len(names)], names=names)
                i = j + 1
        if file:
            file.close()

    names = ["page_id", "url", "type", "digest", "bytes", "refers_to"] + ["payload"] * with_payload
    types = [pa.int64(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.binary()]
    schema = "page_id long, url string, type string, digest string, bytes long, refers_to long" + ", payload binary" * with_payload
    return placed.mapInArrow(get, schema)


def _shown(member: bytes) -> tuple:
    fields, http, payload = read_record(member)
    stated = fields["WARC-Payload-Digest"].removeprefix("sha256:")
    own, size = fields["WARC-Record-ID"].split(":")[2], int(http["content-length"])
    url = fields.get("WARC-Target-URI")
    if fields["WARC-Type"] == "revisit":
        first = fields["WARC-Refers-To"].split(":")[2]
        return int(own) if own else None, url, "revisit", stated, size, int(first) if first else None, None
    digest = hashlib.sha256(payload).hexdigest()
    if digest != stated or len(payload) != size:
        raise ValueError(f"record {fields['WARC-Record-ID']} holds another payload than it states")
    return int(own) if own else None, url, "response", digest, size, None, payload


def new_folder(spark: SparkSession) -> str:
    """A folder for one archive, where all executors can reach it."""
    return fresh_path(spark, "warc")
