"""WARC archives: written by tasks, and read in byte ranges that need no index.

Every record is a gzip member of its own. ``read`` cuts archives into byte ranges; a task
looks for the gzip magic from the start of its range, takes a place for a member only if
its beginning decodes to a WARC header and records follow it without a gap, and owns all
records that start inside its range, reading past the end of it for the last one. From
record to record it follows the members. An archive inside a payload is so not read as one,
unless it holds ``LINKS`` records, unpacked, and a range begins inside it.

A null html is an empty payload; a null url is left out. Payloads of under 100 bytes are
all responses. Of larger equal ones those with the smallest page_id are (several rows may
repeat it), and the others, null ids included, are revisits of it; where no row has an id
all are responses. An empty table gives no archive and no rows. Other columns are ignored.

Tasks write under names of their own. What counts is the manifest that Spark commits, so
files of lost or repeated attempts are never read. Archives are opened with ``pyarrow.fs``,
so the folder may be on any store that it knows (file, hdfs, s3, gs).
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from smeltery.llm.shared import written
from smeltery.session import shared_folder

MAGIC = b"\x1f\x8b\x08"
LEAST_SHARED = 100
SPLIT_BYTES = 32 << 20
FILE_BYTES = 1 << 30
_STEP = 1 << 20
_HEAD = 1 << 16
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def _record_id(page_id: object) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page_id}')}>"


def record(
    page_id: object, url: str | None, payload: bytes, digest: str, refers_to: object = None
) -> bytes:
    """One gzip member; with ``refers_to`` a revisit, which has no payload of its own."""
    kept = b"" if refers_to is not None else payload
    http = (
        "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
        f"Content-Length: {len(payload)}\r\n\r\n"
    ).encode()
    fields = [
        ("WARC-Type", "response" if refers_to is None else "revisit"),
        ("WARC-Record-ID", _record_id(page_id) if page_id is not None else uuid.uuid4().urn),
        ("WARC-Date", "2024-01-01T00:00:00Z"),
        ("WARC-Payload-Digest", f"sha256:{digest}"),
        ("Content-Type", "application/http;msgtype=response"),
        ("Content-Length", str(len(http) + len(kept))),
        ("X-Payload-Length", str(len(payload))),
    ]
    if url is not None:
        fields.append(("WARC-Target-URI", quote(url, safe="%/:=&?~#+!$,;'@()*[]")))
    if page_id is not None:
        fields.append(("X-Page-Id", str(page_id)))
    if refers_to is not None:
        fields += [("WARC-Refers-To", _record_id(refers_to)), ("WARC-Profile", _PROFILE)]
        fields.append(("X-Refers-To-Page", str(refers_to)))
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + "\r\n"
    packer = zlib.compressobj(4, zlib.DEFLATED, 31)
    return packer.compress(head.encode() + http + kept + b"\r\n\r\n") + packer.flush()


def with_referents(pages: DataFrame) -> DataFrame:
    """``pages`` (page_id, url, html) with digest and the page that a revisit refers to.

    Sizes and digests are grouped before html moves; a digest that many pages share is one
    row per task there, and the join may split it.
    """
    digest = F.sha2(F.coalesce("html", F.lit("")).cast("binary"), 256)
    own = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html"))
    own = own.withColumn("digest", digest)
    large = F.octet_length("html") >= LEAST_SHARED
    firsts = (
        own.where(large)
        .groupBy("digest")
        .agg(F.min("page_id").alias("first_page"), F.count("*").alias("n"))
        .where("n > 1")
        .select("digest", "first_page")
    )
    first = F.when(~F.col("page_id").eqNullSafe(F.col("first_page")), F.col("first_page"))
    return own.join(firsts, "digest", "left").select(
        "page_id", "url", "html", "digest", first.alias("refers_to")
    )


def write(pages: DataFrame, folder: str | None = None) -> DataFrame:
    """Write archives of ``pages``; the manifest has path and size of each."""
    target = (folder or shared_folder(pages.sparkSession)).rstrip("/")

    def archive(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        store, base = fs.FileSystem.from_uri(target)
        name, out = None, None

        def closed() -> pa.RecordBatch:
            size = out.tell()
            out.close()
            return pa.RecordBatch.from_pydict({"path": [f"{target}/{name}"], "size": [size]})

        for batch in batches:
            for row in batch.to_pylist():
                if out is None:
                    store.create_dir(base, recursive=True)
                    name = f"{uuid.uuid4().hex}.warc.gz"
                    out = store.open_output_stream(f"{base}/{name}", compression=None)
                payload = row["html"].encode()
                out.write(
                    record(row["page_id"], row["url"], payload, row["digest"], row["refers_to"])
                )
                if out.tell() >= FILE_BYTES:
                    yield closed()
                    out = None
        if out is not None:
            yield closed()

    return written(with_referents(pages).mapInArrow(archive, "path string, size long"))


#: Records that must follow each other where a task begins to read.
LINKS = 8


def members(file, size: int, start: int, end: int) -> Iterator[tuple[int, bytes]]:
    """Offset and content of the records that start in [start, end).

    Where a record does not follow another one, a payload may hold bytes that look like one:
    it is taken for one only if ``LINKS`` records, or all up to the end of the file, follow
    each other from there.
    """
    at, follows = start, start == 0
    while at < end:
        found = _next_magic(file, size, at, end)
        if found is None:
            return
        if not (follows and found == at) and not _chained(file, size, found):
            at, follows = found + 1, False
            continue
        content, after = _decoded(file, size, found)
        if content is None:
            at, follows = found + 1, False
        else:
            yield found, content
            at, follows = after, True


def _chained(file, size: int, at: int) -> bool:
    """Whether a record begins at ``at`` and is followed by others without a gap."""
    for _ in range(LINKS):
        if at == size:
            return True
        try:
            content, after = _decoded(file, size, at)
        except ValueError:
            return True  # it begins as a record does: its reader tells of the damage
        if content is None:
            return False
        at = after
    return True


def _next_magic(file, size: int, at: int, end: int) -> int | None:
    while at < end:
        file.seek(at)
        block = file.read(min(_STEP, size - at))
        found = block.find(MAGIC)
        if found >= 0:
            return at + found if at + found < end else None
        if at + len(block) >= size:
            return None
        at += len(block) - len(MAGIC) + 1
    return None


def _decoded(file, size: int, at: int) -> tuple[bytes | None, int]:
    """The member at ``at`` and where it ends, or None where no record begins."""
    inflate, parts, position, step = zlib.decompressobj(31), [], at, _HEAD
    file.seek(at)
    while not inflate.eof:
        block = file.read(min(step, size - position))
        position += len(block)
        if not parts and not _begins(block):
            return None, at
        try:
            content = inflate.decompress(block)
        except zlib.error:
            content = None
        if content is None or (not block and not inflate.eof):
            raise ValueError(f"the record at byte {at} is damaged")
        parts.append(content)
        step = _STEP
    return b"".join(parts), position - len(inflate.unused_data)


def _begins(block: bytes) -> bool:
    """Whether a block's first bytes are those of a record, whatever comes behind them."""
    start = b"WARC/1."
    try:
        return zlib.decompressobj(31).decompress(block, len(start)) == start
    except zlib.error:
        return False


def parsed(content: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields in lower case, and the payload."""
    head, _, rest = content.partition(b"\r\n\r\n")
    lines = head.decode("utf-8").split("\r\n")[1:]
    fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}
    block = rest[: int(fields.get("content-length", 0))]
    if fields.get("content-type", "").startswith("application/http"):
        block = block.partition(b"\r\n\r\n")[2]
    return fields, block


def read(manifest: DataFrame, split_bytes: int = SPLIT_BYTES, with_payload: bool = True) -> DataFrame:
    """A row per record of the archives in ``manifest`` (path, size).

    Payload digests are taken again from what was read; a record whose digest differs from
    its header ends the job. ``n_bytes`` is the size of the full payload.
    """
    totals = manifest.agg(F.sum(F.ceil(F.col("size") / split_bytes))).first()[0] or 0
    ranges = manifest.where("size > 0").select(
        "path", "size", F.explode(F.sequence(F.lit(0), F.col("size") - 1, F.lit(split_bytes))).alias("low")
    )
    schema = "path string, offset long, record_type string, uri string, page_id string"
    schema += ", refers_to string, digest string, n_bytes long"
    schema += ", payload binary" if with_payload else ""

    def taken(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        for batch in batches:
            for row in batch.to_pylist():
                store, path = fs.FileSystem.from_uri(row["path"])
                rows, held = [], 0
                with store.open_input_file(path) as file:
                    end = min(row["low"] + split_bytes, row["size"])
                    for offset, content in members(file, row["size"], row["low"], end):
                        rows.append(_row(row["path"], offset, content, with_payload))
                        held += len(content) if with_payload else 200
                        if held > _STEP:
                            yield _batch(rows, with_payload)
                            rows, held = [], 0
                if rows:
                    yield _batch(rows, with_payload)

    return ranges.repartition(max(1, int(totals)), "path", "low").mapInArrow(taken, schema)


def _row(path: str, offset: int, content: bytes, with_payload: bool) -> dict:
    fields, payload = parsed(content)
    digest = fields.get("warc-payload-digest", "").removeprefix("sha256:")
    revisit = fields["warc-type"] == "revisit"
    if not revisit and digest != hashlib.sha256(payload).hexdigest():
        raise ValueError(f"{path}: the payload at byte {offset} is not what its digest says")
    row = {
        "path": path,
        "offset": offset,
        "record_type": fields["warc-type"],
        "uri": fields.get("warc-target-uri"),
        "page_id": fields.get("x-page-id"),
        "refers_to": fields.get("x-refers-to-page"),
        "digest": digest,
        "n_bytes": int(fields.get("x-payload-length", len(payload))),
    }
    return row | ({"payload": payload} if with_payload else {})


def _batch(rows: list[dict], with_payload: bool) -> pa.RecordBatch:
    text, number = pa.string(), pa.int64()
    kinds = {"path": text, "offset": number, "record_type": text, "uri": text, "page_id": text}
    kinds |= {"refers_to": text, "digest": text, "n_bytes": number}
    kinds |= {"payload": pa.binary()} if with_payload else {}
    return pa.RecordBatch.from_pylist(rows, schema=pa.schema(list(kinds.items())))
