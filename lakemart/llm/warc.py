"""Pages as WARC archives, written record by record and read back from byte ranges.

Writing. Each record is a gzip member of its own, made on the workers; Spark's
text writer puts the bytes into files, so a task that is lost or run twice
leaves nothing behind. The writer's line separator is an empty gzip member, so
a file is a plain sequence of members. Of records with equal payloads one is
the response and the others are revisits that name it and carry no payload.

Reading. Spark's text reader cuts files into byte ranges and, with the gzip
magic as its separator, gives each task the pieces that begin inside its range.
A piece is a candidate member: it counts once it decodes from its gzip header
to its checksum and begins with a WARC version line. The magic can also occur
inside a member; the pieces around it are then joined until the member is
complete. Where such a member goes on in the next range, its pieces meet in a
second, narrow step.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections import deque
from collections.abc import Iterator
from itertools import chain
from urllib.parse import quote, unquote

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lakemart.llm.common import map_batches, materialize, on_workers, small

# The first three bytes of a member, and a member without content.
MAGIC = b"\x1f\x8b\x08"
EMPTY_MEMBER = MAGIC + b"\0\0\0\0\0\0\x03\x03\0" + b"\0" * 8
IDENTICAL = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP_HEAD = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {}\r\n\r\n"
DATE = "2024-01-01T00:00:00Z"

#: Bytes of members that one row of the writer holds; a larger record is a row of its own.
CHUNK = 1 << 22

_READ = "key string, record_type string, uri string, payload_bytes bigint, payload_digest string, refers_to string, payload binary"
_FIELDS = ["key", "record_type", "uri", "payload_bytes", "payload_digest", "refers_to", "payload"]
_LOOSE = "file string, block bigint, place bigint, opens boolean, raw binary"


def digest_column(payload: Column) -> Column:
    """Upper-case base32 of the SHA-1 of a binary column: eight digits for every ten of the hexadecimal form."""
    five = [F.lpad(F.conv(F.substring(F.sha1(payload), 1 + 10 * i, 10), 16, 32), 8, "0") for i in range(4)]
    return F.translate(F.concat(*five), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def _safe(text: str) -> str:
    """A header value on one line: control characters are percent-encoded."""
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", text)


def _identity(key: str | None, digest: str) -> str:
    made = hashlib.sha256(f"{'' if key is None else 'k' + key}\n{digest}".encode()).digest()
    return f"<urn:uuid:{uuid.UUID(bytes=made[:16], version=5)}>"


def _member(headers: list[tuple[str, str]], block: bytes, level: int) -> bytes:
    head = "".join(f"{name}: {value}\r\n" for name, value in headers)
    squeeze = zlib.compressobj(level, zlib.DEFLATED, 31)
    out = squeeze.compress(f"WARC/1.1\r\n{head}Content-Length: {len(block)}\r\n\r\n".encode())
    return out + squeeze.compress(block + b"\r\n\r\n") + squeeze.flush()


def _page(row: dict, date: str, level: int) -> bytes:
    key, payload, digest, first = row["key"], row["payload"], row["digest"], row["first"]
    headers = [("WARC-Type", "revisit" if row["revisits"] else "response"), ("WARC-Record-ID", _identity(key, digest)), ("WARC-Date", date)]
    if row["uri"] is not None:
        headers.append(("WARC-Target-URI", _safe(row["uri"])))
    if key is not None:
        headers.append(("Row-Key", quote(key)))
    headers += [("WARC-Payload-Digest", f"sha1:{digest}"), ("Content-Type", "application/http; msgtype=response")]
    block = HTTP_HEAD.format(len(payload)).encode()
    if not row["revisits"]:
        return _member(headers, block + payload, level)
    headers += [("WARC-Profile", IDENTICAL), ("WARC-Refers-To", _identity(first, digest)), ("Refers-To-Key", quote(first))]
    return _member(headers, block, level)


def plan_records(
    pages: DataFrame, key: str = "page_id", url: str = "url", payload: str = "html", least_bytes: int = 0
) -> DataFrame:
    """``key, uri, payload, digest, first, revisits`` of every row.

    Payloads are equal when their SHA-256 is. ``first`` is the least key among
    the rows of a repeated payload of at least ``least_bytes`` bytes; the other
    rows of it revisit that one. Rows that share the least key, and rows of
    payloads without any key, are responses.
    """
    body = F.coalesce(F.col(f"`{payload}`").cast("binary"), F.lit(b""))
    rows = pages.select(F.col(f"`{key}`").alias("_key"), F.col(f"`{url}`").cast("string").alias("uri"), body.alias("payload"))
    rows = rows.withColumn("same", F.unhex(F.sha2("payload", 256)))
    least = rows.where(F.length("payload") >= least_bytes).groupBy("same").agg(F.min("_key").alias("_first"), F.count("*").alias("c"))
    least = materialize(least.where("c > 1 AND _first IS NOT NULL").drop("c"), "warc-repeated")
    joined = rows.join(small(least), "same", "left")
    # A missing key is never the least one: such a row revisits.
    revisits = F.col("_first").isNotNull() & ~F.col("_key").eqNullSafe(F.col("_first"))
    return joined.select(
        F.col("_key").cast("string").alias("key"), "uri", "payload", digest_column(F.col("payload")).alias("digest"),
        F.col("_first").cast("string").alias("first"), revisits.alias("revisits"),
    )


def write_archives(
    pages: DataFrame,
    path: str,
    key: str = "page_id",
    url: str = "url",
    payload: str = "html",
    least_bytes: int = 0,
    date: str = DATE,
    level: int = 6,
) -> None:
    """Write one WARC/1.1 record per row of ``pages`` into the new folder ``path``.

    The payload is the text in UTF-8 (or the bytes of a binary column); null is
    empty. A null url leaves the target out, a null key the row key. Equal rows
    are records of their own with equal record ids. Control characters of a url
    are percent-encoded. Other columns are not written. An empty table gives
    files without page records.
    """
    rows = plan_records(pages, key, url, payload, least_bytes)
    on_workers(pages.sparkSession)

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        info = [("WARC-Type", "warcinfo"), ("WARC-Record-ID", _identity(None, "")), ("WARC-Date", date), ("Content-Type", "application/warc-fields")]
        held = [_member(info, b"format: WARC File Format 1.1\r\n", level)]
        size = len(held[0])

        def chunk() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([b"".join(held)], pa.binary())], ["value"])

        for batch in batches:
            for i in range(batch.num_rows):
                member = _page(batch.slice(i, 1).to_pylist()[0], date, level)
                if held and size + len(member) > CHUNK:
                    yield chunk()
                    held, size = [], 0
                held.append(member)
                size += len(member)
        if held:
            yield chunk()

    files = rows.mapInArrow(build, "value binary").select(F.col("value").cast("string"))
    writer = files.write.mode("errorifexists").option("compression", "none")
    # Both options are read as ISO-8859-1, so that each character stands for one byte.
    writer.option("encoding", "ISO-8859-1").option("lineSep", EMPTY_MEMBER.decode("latin-1")).text(path)


def _records(content: bytes, with_payload: bool) -> Iterator[tuple]:
    """The records of a decoded member, as values of ``_FIELDS``; what cannot be read ends it."""
    at = 0
    while content.startswith(b"WARC/", at):
        end = content.find(b"\r\n\r\n", at)
        if end < 0:
            return
        lines = content[at:end].decode("utf-8", "replace").split("\r\n")[1:]
        named = {name.strip().lower(): value.strip() for name, _, value in (line.partition(":") for line in lines)}
        length = named.get("content-length", "")
        if not length.isdigit():
            return
        block = content[end + 4 : end + 4 + int(length)]
        at = end + 8 + int(length)
        kind = named.get("warc-type", "")
        split = block.find(b"\r\n\r\n") if named.get("content-type", "").startswith("application/http") else -4
        payload, head = block[split + 4 :], block[: max(split, 0)]
        size, digest = len(payload), base64.b32encode(hashlib.sha1(payload).digest()).decode()
        if kind == "revisit":
            told = re.search(rb"(?im)^content-length:\s*(\d+)", head)
            size = int(told[1]) if told else None
            digest = named.get("warc-payload-digest", "").rpartition(":")[2] or None
        key, refers = named.get("row-key"), named.get("refers-to-key")
        yield (
            None if key is None else unquote(key), kind, named.get("warc-target-uri"), size, digest,
            None if refers is None else unquote(refers), payload if with_payload and kind != "revisit" else None,
        )


class _Member:
    """A member that is being decoded piece by piece."""

    def __init__(self) -> None:
        self.raw: list[bytes] = []
        self.content: list[bytes] = []
        self.inflate = zlib.decompressobj(31)

    def feed(self, piece: bytes) -> bool:
        """Whether the member can still be sound with this piece; a bad piece leaves the object unusable."""
        try:
            self.content.append(self.inflate.decompress(piece))
        except zlib.error:
            return False
        self.raw.append(piece)
        start = b"".join(self.content)[:5] if len(self.content[0]) < 5 else self.content[0][:5]
        return start == b"WARC/" or (self.done and not start) or (not self.done and b"WARC/".startswith(start))

    @property
    def done(self) -> bool:
        return self.inflate.eof


class _Range:
    """The pieces of one byte range, settled in order into whole members and loose pieces.

    A member goes on with the next piece while that decodes. If one fails, its
    first piece is loose and the others are tried anew. Yields ``(content,
    None, False)`` or ``(None, piece, opens)``, where ``opens`` marks a loose
    piece that surely begins a member which goes on in the next range.
    """

    def __init__(self) -> None:
        self.run: list[tuple[int, bytes]] = []
        self.member: _Member | None = None
        self.sure = False

    def feed(self, *pieces: tuple[int, bytes]) -> Iterator[tuple]:
        waiting = deque(pieces)
        while waiting:
            self.member = self.member or _Member()
            self.run.append(waiting.popleft())
            if not self.member.feed(self.run[-1][1]):
                first, *rest = self.run
                yield None, first, False
                waiting.extendleft(reversed(rest))
                self.run, self.member, self.sure = [], None, False
            elif self.member.done:
                content = b"".join(self.member.content)
                if content or self.sure:
                    yield content, None, False
                else:  # an empty member inside of one that goes on from the range before looks the same
                    for piece in self.run:
                        yield None, piece, False
                self.run, self.member, self.sure = [], None, self.sure or bool(content)

    def end(self) -> Iterator[tuple]:
        """The range goes on in the next one."""
        for i, piece in enumerate(self.run):
            yield None, piece, self.sure and i == 0

    def close(self) -> Iterator[tuple]:
        """Nothing follows."""
        while self.run:
            first, *rest = self.run
            self.run, self.member = [], None
            yield None, first, False
            yield from self.feed(*rest)


def _pieces(spark: SparkSession, path: str) -> DataFrame:
    """Candidate members: what stands between two gzip magics, in the range that it begins in."""
    names = ["piece", "file_path", "file_block_start"]
    reader = spark.read.option("encoding", "ISO-8859-1").option("lineSep", MAGIC.decode("latin-1"))
    found = reader.option("pathGlobFilter", "*[!z]").text(path).select(F.col("value").cast("binary").alias("piece"), *[f"_metadata.{c}" for c in names[1:]])
    # By this name Spark's text reader unpacks a file instead of handing out its bytes.
    packed = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path).select("path", "content")

    def cut(batch: pa.RecordBatch) -> pa.Table:
        rows = [(p, f) for f, content in zip(*(batch.column(i).to_pylist() for i in range(2))) for p in content.split(MAGIC)]
        columns = [pa.array([p for p, _ in rows], pa.binary()), pa.array([f for _, f in rows], pa.string()), pa.array([0] * len(rows), pa.int64())]
        return pa.table(columns, names)

    return found.unionByName(map_batches(packed, "piece binary, file_path string, file_block_start bigint", cut, rows=1))


def read_archives(spark: SparkSession, path: str, with_payload: bool = True) -> DataFrame:
    """Every record of the gzip WARC files in ``path``.

    ``key`` and ``refers_to`` are the row keys as text, ``record_type`` the WARC
    type, ``payload_bytes`` and ``payload_digest`` those of the full payload: of
    a response computed from what was read, of a revisit as its headers tell.
    ``payload`` is null for revisits, and everywhere without ``with_payload``.
    Bytes that belong to no sound member are passed over; a member that holds a
    stored WARC member inside it and crosses a range shows both. A file
    whose name ends in ``.gz`` is one range of up to 2 GB, as Spark splits none
    of that name; other names that end in z are not read.
    """
    on_workers(spark)
    names = [*_FIELDS, "file", "block", "place", "opens", "raw"]
    schema = f"{_READ}, {_LOOSE}"
    kinds = pa.schema(
        [
            ("key", pa.string()), ("record_type", pa.string()), ("uri", pa.string()), ("payload_bytes", pa.int64()),
            ("payload_digest", pa.string()), ("refers_to", pa.string()), ("payload", pa.binary()), ("file", pa.string()),
            ("block", pa.int64()), ("place", pa.int64()), ("opens", pa.bool_()), ("raw", pa.binary()),
        ]
    )

    def table(rows: list[tuple]) -> pa.RecordBatch:
        columns = zip(*rows)
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, kinds)], names)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, size, now, place, pieces = [], 0, None, 0, _Range()

        def take(settled: Iterator[tuple]) -> None:
            nonlocal size
            for content, piece, opens in settled:
                if piece is None:
                    rows.extend((*r, None, None, None, None, None) for r in _records(content, with_payload))
                    size += len(content) if with_payload else 200
                else:
                    rows.append((*[None] * len(_FIELDS), *now, piece[0], opens, piece[1]))
                    size += len(piece[1])

        for batch in batches:
            for i in range(batch.num_rows):
                raw, file, block = (batch.column(c)[i].as_py() for c in range(3))
                if (file, block) != now:
                    take(pieces.end())
                    now, place, pieces = (file, block), 0, _Range()
                    if block == 0:  # before the first magic of a file
                        continue
                take(pieces.feed((place, MAGIC + raw)))
                place += 1
                if size > CHUNK and rows:
                    yield table(rows)
                    rows, size = [], 0
        take(pieces.end())
        if rows:
            yield table(rows)

    found = materialize(_pieces(spark, path).mapInArrow(read, schema), "warc-read")
    records = found.where("raw IS NULL").select(*_FIELDS)
    loose = found.where("raw IS NOT NULL").select("file", "block", "place", "opens", "raw")
    if loose.limit(1).count() == 0:
        return records
    # Each member that opens at the end of a range, with the loose pieces up to the next; mostly there are none.
    order = Window.partitionBy("file").orderBy("block", "place")
    opened = F.last(F.when(F.col("opens"), F.struct("block", "place")), ignorenulls=True).over(order)
    parts = F.transform(F.sort_array(F.collect_list(F.struct("block", "place", "raw"))), lambda p: p["raw"])
    groups = loose.withColumn("_opened", opened).groupBy("file", "_opened").agg(parts.alias("parts"))

    def mend(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = []
        for parts in batch.column(0).to_pylist():
            pieces = _Range()
            for content, _, _ in chain(pieces.feed(*enumerate(parts)), pieces.close()):
                if content is not None:
                    rows += [(*r, None, None, None, None, None) for r in _records(content, with_payload)]
        made = table(rows) if rows else pa.RecordBatch.from_pylist([], kinds)
        return made.select(_FIELDS)

    return records.unionByName(map_batches(groups.select("parts"), _READ, mend, rows=64))


def restore_payloads(records: DataFrame) -> DataFrame:
    """Page records with the payload of the response that each revisit names, by key and digest."""
    pages = records.where(F.col("record_type").isin("response", "revisit"))
    held = pages.where("record_type = 'response'").groupBy("key", "payload_digest").agg(F.first("payload").alias("_held"))
    held = held.withColumnRenamed("key", "_at").withColumnRenamed("payload_digest", "_digest")
    back = pages.join(held, (F.col("refers_to") == F.col("_at")) & (F.col("payload_digest") == F.col("_digest")), "left")
    return back.select(*[F.coalesce("payload", "_held").alias(c) if c == "payload" else c for c in records.columns])
