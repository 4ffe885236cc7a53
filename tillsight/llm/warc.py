"""Pages in WARC archives, found again through a two-level capture index.

Archives hold one gzip member per record. A payload that several pages share
is stored once; the other pages are revisit records. The index is sorted by
reversed-host URL key and cut into compressed blocks; a sparse directory has
the first key of each block. A look-up searches the directory, then the block,
and then reads just the bytes of its record.
"""

from __future__ import annotations

import base64
import hashlib
import json
import math
import re
import uuid
import zlib
from bisect import bisect_left, bisect_right
from itertools import batched
from urllib.parse import quote, urlsplit

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillsight.llm.texts import pieces
from tillsight.workspace import cut_lineage, fresh_folder

#: Shorter payloads are stored again every time.
LEAST_SHARED_BYTES = 1_000
ARCHIVE_BYTES = 64 << 20
BLOCK_LINES = 3_000
CAPTURES_PER_INDEX_FILE = 200_000
#: Index files at most, which bounds the list of their first keys that is broadcast.
MOST_INDEX_FILES = 10_000
_SALTS = 8
_DATE = "1970-01-01T00:00:00Z"
_NO_ID = -(2**63)
_CAPTURE = "url_key string, page_id bigint, archive string, start bigint, length bigint"
_ENTRY = pa.schema([
    ("url_key", pa.string()), ("page_id", pa.int64()), ("archive", pa.string()),
    ("start", pa.int64()), ("length", pa.int64()),
])


def url_key(url: str | None) -> str:
    """Reversed host, then path and query: ``com,example,www)/a?b``; what cannot be parsed stays as it is."""
    try:
        parts = urlsplit(url or "")
        host, port = (parts.hostname or "").rstrip("."), parts.port
    except ValueError:
        return url or ""
    if not host:
        return url or ""
    port = f":{port}" if port not in (None, 80, 443) else ""
    query = f"?{parts.query}" if parts.query else ""
    return ",".join(reversed(host.split("."))) + port + ")" + (parts.path or "/") + query


def _record(kind: str, page_id, url, payload: bytes, digest: str, refers_to, date: str) -> bytes:
    """One record as a gzip member. A revisit keeps the HTTP head but not the payload."""
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
    block = head.encode() + (payload if kind == "response" else b"")
    lines = [
        "WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>",
        f"WARC-Date: {date}", f"WARC-Target-URI: {quote(url or '', safe=_URI_SAFE)}",
        f"WARC-Payload-Digest: sha1:{base64.b32encode(bytes.fromhex(digest)).decode()}",
        "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}",
    ]
    if kind == "revisit":
        lines += [
            "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
            f"WARC-Refers-To: <urn:page:{refers_to}>",
        ]
    packer = zlib.compressobj(1, zlib.DEFLATED, 31)
    whole = "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"
    return packer.compress(whole) + packer.flush()


_URI_SAFE = "/:?#[]@!$&'()*+,;=%~"


def _parsed(member: bytes) -> dict:
    """Page, type, payload size, digest and reference of a record read back."""
    data = zlib.decompress(member, 31)
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    page = lambda text: int(n) if (n := text[len("<urn:page:") : -1]) else None
    stated = base64.b32decode(fields["WARC-Payload-Digest"].removeprefix("sha1:")).hex()
    kind = fields["WARC-Type"]
    if kind == "response":
        digest = hashlib.sha1(payload).hexdigest()
        if digest != stated:
            raise ValueError(f"payload of page {fields['WARC-Record-ID']} does not match its digest")
        size = len(payload)
    else:
        size = int(re.search(rb"\r\nContent-Length: (\d+)", http)[1])
    return {
        "page_id": page(fields["WARC-Record-ID"]), "payload_bytes": size, "payload_digest": stated,
        "record_type": kind, "refers_to": page(fields["WARC-Refers-To"]) if kind == "revisit" else None,
    }


def with_revisits(pages: DataFrame, least: int = LEAST_SHARED_BYTES) -> DataFrame:
    """Pages with ``digest``, and ``refers_to`` where an equal payload has a larger page_id."""
    rows = pages.select(
        F.col("page_id").cast("bigint").alias("page_id"), F.col("url").cast("string").alias("url"),
        F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"),
    )
    rows = rows.withColumn("digest", F.sha1("html")).withColumn("size", F.octet_length("html"))
    large = rows.filter(F.col("size") >= least).select("page_id", "digest", "size").filter("page_id is not null")
    shared = (
        large.groupBy("digest", "size")
        .agg(F.max("page_id").alias("response"), F.min("page_id").alias("other"))
        .filter("response > other")
        .withColumn("salt", F.explode(F.array(*[F.lit(i) for i in range(_SALTS)])))
    )
    salt = F.pmod(F.xxhash64("page_id"), F.lit(_SALTS)).cast("int")
    revisits = (
        large.withColumn("salt", salt)
        .join(shared, ["digest", "size", "salt"])
        .filter("page_id < response")
        .select("page_id", "digest", F.col("response").alias("refers_to"))
        .distinct()
    )
    return rows.join(revisits, ["page_id", "digest"], "left")


def write_archives(pages: DataFrame, folder: str, date: str = _DATE, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Writes the records; returns where each is.

    Every task writes files of its own name, and only the rows of the tasks
    that succeeded name them, so retried tasks do no harm.
    """

    def run(batches):
        store, root = _store(folder)
        store.create_dir(root)
        out, name, at = None, "", 0
        for piece in pieces(batches, "html"):
            rows = []
            for row in piece.to_pylist():
                if out is None or at >= archive_bytes:
                    if out is not None:
                        out.close()
                    name, at = f"{uuid.uuid4().hex}.warc.gz", 0
                    out = store.open_output_stream(f"{root}/{name}", compression=None)
                kind = "response" if row["refers_to"] is None else "revisit"
                member = _record(
                    kind, row["page_id"], row["url"], row["html"].encode(), row["digest"], row["refers_to"], date
                )
                out.write(member)
                page = _NO_ID if row["page_id"] is None else row["page_id"]
                rows.append((url_key(row["url"]), page, f"{folder}/{name}", at, len(member)))
                at += len(member)
            yield pa.RecordBatch.from_arrays(
                [pa.array(x, f.type) for x, f in zip(zip(*rows), _ENTRY)], schema=_ENTRY
            )
        if out is not None:
            out.close()

    return cut_lineage(with_revisits(pages).mapInArrow(run, _CAPTURE), "captures")


def build_index(captures: DataFrame, folder: str) -> DataFrame:
    """Writes sorted blocks of entries; returns the directory, a row per block."""
    files = min(MOST_INDEX_FILES, max(1, math.ceil(captures.count() / CAPTURES_PER_INDEX_FILE)))

    def run(batches):
        store, root = _store(folder)
        store.create_dir(root)
        rows = (tuple(row.values()) for batch in batches for row in batch.to_pylist())
        name, out, at, directory = f"{uuid.uuid4().hex}.cdx", None, 0, []
        for block in batched(rows, BLOCK_LINES):
            out = out or store.open_output_stream(f"{root}/{name}", compression=None)
            data = zlib.compress(json.dumps(block).encode())
            out.write(data)
            directory.append((f"{folder}/{name}", at, len(data), block[0][0], block[0][1]))
            at += len(data)
        if out is not None:
            out.close()
            columns = [pa.array(x) for x in zip(*directory)]
            yield pa.record_batch(columns, names=["index_file", "start", "length", "first_key", "first_page"])

    ordered = captures.repartitionByRange(files, "url_key", "page_id").sortWithinPartitions("url_key", "page_id")
    return cut_lineage(
        ordered.mapInArrow(run, "index_file string, start bigint, length bigint, first_key string, first_page bigint"),
        "index-directory",
    )


def _store(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path) if ":/" in path else (fs.LocalFileSystem(), path)


def _opened(path: str) -> pa.NativeFile:
    store, inner = _store(path)
    return store.open_input_file(inner)


def _order(key: str, page: int) -> tuple[bytes, int]:
    """Keys in the order Spark sorts strings by."""
    return key.encode(), page


def _search_index_file(keys: pa.Table, directory: pa.Table) -> pa.Table:
    """The entries of the wanted keys; each block that is needed is read once."""
    found = []
    if keys.num_rows and directory.num_rows:
        blocks = sorted(directory.to_pylist(), key=lambda b: _order(b["first_key"], b["first_page"]))
        firsts = [_order(b["first_key"], b["first_page"]) for b in blocks]
        path = blocks[0]["index_file"]
        with _opened(path) as file:
            open_at, entries, orders = -1, [], []
            for wanted in sorted(map(_order, keys["url_key"].to_pylist(), keys["page_id"].to_pylist())):
                # a key's entries may begin in the block before the one that starts with it
                at = max(0, bisect_left(firsts, wanted) - 1)
                while at < len(blocks) and firsts[at] <= wanted:
                    if at != open_at:
                        data = file.read_at(blocks[at]["length"], blocks[at]["start"])
                        entries, open_at = json.loads(zlib.decompress(data)), at
                        orders = [_order(key, page) for key, page, *_ in entries]
                    found += entries[bisect_left(orders, wanted) : bisect_right(orders, wanted)]
                    at += 1
    columns = list(zip(*found)) or [[]] * len(_ENTRY)
    return pa.table([pa.array(x, f.type) for x, f in zip(columns, _ENTRY)], schema=_ENTRY)


def look_up(wanted: DataFrame, directory: DataFrame) -> DataFrame:
    """Captures of the wanted (url_key, page_id), wherever they are.

    The first key of each index file sends a key to its file; there the rows
    of the directory and then the block are searched.
    """
    spark = wanted.sparkSession
    tops = directory.groupBy("index_file").agg(F.min(F.struct("first_key", "first_page")).alias("first")).collect()
    tops = sorted((_order(*row["first"]), row["index_file"]) for row in tops)
    bounds = spark.sparkContext.broadcast(([top[0] for top in tops], [top[1] for top in tops]))

    def send(batches):
        firsts, names = bounds.value
        for batch in batches:
            at = [
                bisect_right(firsts, _order(key, page)) - 1
                for key, page in zip(batch["url_key"].to_pylist(), batch["page_id"].to_pylist())
            ]
            files = [names[i] if i >= 0 else None for i in at]
            yield pa.RecordBatch.from_arrays(
                [batch["url_key"], batch["page_id"], pa.array(files, pa.string())],
                names=["url_key", "page_id", "index_file"],
            )

    sent = wanted.select("url_key", "page_id").distinct().mapInArrow(
        send, "url_key string, page_id bigint, index_file string"
    )
    return (
        sent.filter("index_file is not null")
        .groupBy("index_file")
        .cogroup(directory.groupBy("index_file"))
        .applyInArrow(_search_index_file, _CAPTURE)
    )


def read_records(located: DataFrame) -> DataFrame:
    """Reads just the bytes of each record and what it says, archive by archive."""

    def run(batches):
        path, file = None, None
        for batch in batches:
            rows = []
            for archive, start, length in zip(*(batch[n].to_pylist() for n in ("archive", "start", "length"))):
                if archive != path:
                    if file is not None:
                        file.close()
                    path = archive
                    file = _opened(path)
                rows.append(_parsed(file.read_at(length, start)))
            if rows:
                yield pa.RecordBatch.from_pylist(rows, schema=pa.schema([
                    ("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
                    ("record_type", pa.string()), ("refers_to", pa.int64()),
                ]))
        if file is not None:
            file.close()

    dealt = located.repartition("archive").sortWithinPartitions("archive", "start")
    return dealt.mapInArrow(
        run,
        "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint",
    )


def wanted_keys(pages: DataFrame) -> DataFrame:
    """The keys under which pages are indexed."""

    def run(batches):
        for batch in batches:
            keys = [url_key(url) for url in batch["url"].to_pylist()]
            yield pa.record_batch([pa.array(keys, pa.string()), batch["page_id"]], names=["url_key", "page_id"])

    ids = F.coalesce(F.col("page_id").cast("bigint"), F.lit(_NO_ID)).alias("page_id")
    return pages.select(F.col("url").cast("string").alias("url"), ids).mapInArrow(
        run, "url_key string, page_id bigint"
    )


def archived_and_read_back(pages: DataFrame) -> DataFrame:
    """Every page written, looked up through the index and read again.

    A null html is an empty payload; a null url is indexed under an empty key.
    A row without a page_id is a response always, and comes back with a null
    id. Rows that share an id come back one by one.
    """
    folder = fresh_folder(pages.sparkSession, "warc")
    captures = write_archives(pages, f"{folder}/archives")
    directory = build_index(captures, f"{folder}/index")
    return read_records(look_up(wanted_keys(pages), directory))
