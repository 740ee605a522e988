"""WARC archives of pages, and a normaliser for archives that are one gzip stream.

An archive compressed as one stream can only be read from its start. :func:`normalise` inflates each such file once, cuts the
stream into records, rewrites every record as a gzip member of its own and writes a sidecar index beside the archive: one
JSON line per record with the offset and length of its member. :func:`fetch` then reads single records by their place.

* :func:`plan` decides which pages are stored: of equal payloads of ``least`` bytes or more the one with the largest id is
  a response, the others are revisits that name it. Only digests and ids are grouped, in two steps, and the join back goes by
  digest and a salt, so copies of one page are dealt to many tasks.
* :func:`write_streams` packs records into archives of about ``ARCHIVE`` compressed bytes, each one gzip stream.
* :func:`normalise` reads any archives, whatever their gzip members, with a buffer of one record.
* :func:`read` scans normalised archives member by member; :func:`read_index` reads the sidecars.

Files are written by Spark's own committed writer to any file system that it knows. Its text source ends each row with a
separator, so the separator is the zero byte that a gzip member of less than 16 MB ends with; after a larger member an
empty one follows. A folder has ``kind=warc`` and ``kind=index`` with one folder per archive.

Defined results: a null html is an empty payload. A page without id has a record id made of its digest and address, and is
a revisit if a page with an id has the same large payload. Rows that repeat the largest id are responses all. Repeated rows
have a record each. A null address has no WARC-Target-URI; characters that a header cannot hold are percent-encoded.
Payloads of equal SHA-1 and length count as equal. A file that breaks off keeps its whole records, and the break is
an index line of type ``damaged``. Columns other than id, address and html are ignored. An empty table has no archives.
"""

from __future__ import annotations

import base64
import hashlib
import json
import re
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from comparo import session
from comparo.llm.common import job_conf, materialize, slices

ARCHIVE = 32 << 20
LEAST = 1000
SALTS = 1024
STEP = 1 << 14
LEVEL = 6
DATE = "1970-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
# archives are large rows: a batch of Arrow's default size would hold many
FEW_ARCHIVES = {"spark.sql.execution.arrow.maxBytesPerBatch": str(ARCHIVE // 2)}
RECORDS = ("page_id long, uri string, record_type string, refers_to long, payload_bytes long, payload_digest string, "
           "intact boolean, archive string, offset long, length long, payload binary")
LINES = "archive string, offset long, length long, type string, id string, uri string, digest string"


# --------------------------------------------------------------------------- records and gzip members

def record(headers: dict[str, str], block: bytes) -> bytes:
    head = "".join(f"{name}: {value}\r\n" for name, value in headers.items() if value is not None)
    return f"WARC/1.1\r\n{head}Content-Length: {len(block)}\r\n\r\n".encode() + block + b"\r\n\r\n"


def page_record(page_id: int | None, url: str | None, payload: bytes | None, size: int, digest: str,
                refers_to: int | None, date: str = DATE) -> bytes:
    """A response with its payload, or a revisit, which has the HTTP head only."""
    uri = None if url is None else quote(url, safe="".join(map(chr, range(33, 127))))
    name = f"page:{page_id}" if page_id is not None else f"sha1:{digest}:{hashlib.sha1((url or '').encode()).hexdigest()}"
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    again = refers_to is not None
    return record({
        "WARC-Type": "revisit" if again else "response", "WARC-Record-ID": f"<urn:{name}>", "WARC-Date": date,
        "WARC-Target-URI": uri, "WARC-Payload-Digest": "sha1:" + base64.b32encode(bytes.fromhex(digest)).decode(),
        "WARC-Refers-To": f"<urn:page:{refers_to}>" if again else None, "WARC-Profile": PROFILE if again else None,
        "Content-Type": "application/http; msgtype=response"}, http if again else http + payload)


def member(data: bytes, level: int = LEVEL) -> bytes:
    packer = zlib.compressobj(level, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


def sealed(data: bytes) -> bytes:
    """``data`` without its last byte, which is zero, as the writer puts it back."""
    return data[:-1] if data.endswith(b"\0") else data + member(b"")[:-1]


class Damaged(ValueError):
    """A gzip stream or a record that breaks off or is none."""


def inflated(data: bytes, step: int = STEP) -> Iterator[tuple[int, int, bytes]]:
    """(offset of the member, end of it if this is its last piece else 0, piece) of the members of a gzip file. Zero bytes
    between members are padding."""
    view, at = memoryview(data), 0
    while at < len(view):
        if view[at] == 0:
            at += 1
            continue
        start, stream, rest = at, zlib.decompressobj(31), b""
        while not stream.eof:
            source = rest or view[at:at + step]
            at += 0 if rest else len(source)
            try:
                piece = stream.decompress(source, 16 * step)
            except zlib.error as error:
                raise Damaged(str(error)) from error
            rest = stream.unconsumed_tail
            if not stream.eof and not len(source) and not piece:
                raise Damaged("the stream breaks off")
            at -= len(stream.unused_data)
            yield start, at if stream.eof else 0, piece


def parse_head(head: bytes) -> dict[str, str]:
    """Header fields by lower-case name."""
    first, *lines = head.decode("utf-8", "replace").split("\r\n")
    if not first.startswith("WARC/"):
        raise Damaged("no WARC record")
    return {n.strip().lower(): v.strip() for n, _, v in (line.partition(":") for line in lines)}


def records(pieces: Iterator[bytes]) -> Iterator[tuple[dict[str, str], bytes, int]]:
    """(fields, whole record, start of its block) one after the other; the buffer holds one record and a piece."""
    buffer, pieces = bytearray(), iter(pieces)

    def fill(found) -> bool:
        while not found():
            piece = next(pieces, None)
            if piece is None:
                return False
            buffer.extend(piece)
        return True

    while fill(lambda: len(buffer)):
        searched = 0

        def head_ends() -> bool:
            nonlocal searched
            at = buffer.find(b"\r\n\r\n", max(0, searched - 3))
            searched = len(buffer) if at < 0 else at
            return at >= 0
        if not fill(head_ends):
            raise Damaged("a record breaks off")
        fields = parse_head(bytes(buffer[:searched]))
        length = fields.get("content-length", "")
        if not length.isdecimal():
            raise Damaged("a record has no length")
        size = searched + 4 + int(length) + 4
        if not fill(lambda: len(buffer) >= size):
            raise Damaged("a record breaks off")
        yield fields, bytes(buffer[:size]), searched + 4
        del buffer[:size]


# --------------------------------------------------------------------------- tables

def plan(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
         least: int = LEAST) -> DataFrame:
    """(page_id, url, payload, size, digest, refers_to): refers_to is the response's id for revisits, else null; a
    revisit has no payload."""
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"),
                        F.coalesce(F.col(html_col).cast("string").cast("binary"), F.lit(b"")).alias("payload"))
    rows = rows.select("page_id", "url", "payload", F.length("payload").cast("long").alias("size"),
                       F.sha1("payload").alias("digest"),
                       F.pmod(F.xxhash64("page_id", "url"), F.lit(SALTS)).cast("int").alias("salt"))
    pairs = (rows.where(F.col("size") >= least).groupBy("digest", "size", "salt")
             .agg(F.max("page_id").alias("head"), F.count(F.lit(1)).alias("n")))
    pairs = materialize(pairs, "payload_digests")
    heads = (pairs.groupBy("digest", "size").agg(F.max("head").alias("head"), F.sum("n").alias("n"))
             .where("n > 1 AND head IS NOT NULL"))
    placed = pairs.select("digest", "size", "salt").join(heads.drop("n"), ["digest", "size"])
    # copies grow with the pages, so neither side is broadcast; the salt keeps one payload's rows apart
    met = rows.join(placed.hint("merge"), ["digest", "size", "salt"], "left")
    refers_to = F.when(~F.col("page_id").eqNullSafe(F.col("head")), F.col("head"))
    return met.select("page_id", "url", F.when(refers_to.isNull(), F.col("payload")).alias("payload"), "size", "digest",
                      refers_to.alias("refers_to"))


def _store(files: DataFrame, folder: str, *by: str) -> None:
    """Write rows (``by``, data) as files, one per row; data comes from :func:`sealed`."""
    with job_conf(files.sparkSession, FEW_ARCHIVES):
        (files.select(*by, F.col("data").cast("string").alias("value")).write.partitionBy(*by)
         .option("lineSep", "\0").option("compression", "none").text(folder))


def write_streams(planned: DataFrame, folder: str, limit: int = ARCHIVE, level: int = LEVEL) -> None:
    """The records of :func:`plan` as archives that are each one gzip stream of about ``limit`` bytes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        task, number, out, size = TaskContext.get().partitionId(), 0, None, 0

        def file() -> pa.RecordBatch:
            out.append(packer.flush())
            return pa.RecordBatch.from_arrays([pa.array([f"{task:06d}-{number:04d}"]),
                                               pa.array([sealed(b"".join(out))], pa.binary())], names=["archive", "data"])

        for batch in slices(batches):
            names = ("page_id", "url", "payload", "size", "digest", "refers_to")
            for row in zip(*(batch.column(batch.schema.get_field_index(n)).to_pylist() for n in names)):
                if out is None:
                    packer = zlib.compressobj(level, zlib.DEFLATED, 31)
                    info = f"software: comparo\r\nformat: WARC File Format 1.1\r\npart: {task}-{number}\r\n".encode()
                    out = [packer.compress(record({"WARC-Type": "warcinfo", "WARC-Date": DATE,
                                                   "WARC-Record-ID": f"<urn:part:{task}-{number}>",
                                                   "Content-Type": "application/warc-fields"}, info))]
                    size = 0
                out.append(packer.compress(page_record(*row)))
                size += len(out[-1])
                if size >= limit:
                    yield file()
                    number, out = number + 1, None
        if out is not None:
            yield file()

    _store(planned.mapInArrow(run, "archive string, data binary"), folder, "archive")


def archives(spark: SparkSession, folder: str, pattern: str = "*") -> DataFrame:
    """(archive, content) of the files below ``folder``: named by their archive folder, else by their file name."""
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern)
             .load(folder))
    named = F.regexp_extract("path", "/archive=([^/]+)/", 1)
    return files.select(F.when(named != "", named).otherwise(F.regexp_extract("path", "([^/]+)$", 1)).alias("archive"),
                        "content")


def normalise(source: DataFrame, folder: str, level: int = LEVEL) -> None:
    """Rewrite the archives (archive, content) with a gzip member per record, each with its sidecar index."""
    def rewritten(content: bytes) -> tuple[bytes, bytes]:
        out, lines, offset = [], [], 0
        try:
            for fields, whole, _ in records(piece for *_, piece in inflated(content)):
                out.append(member(whole, level))
                lines.append({"offset": offset, "length": len(out[-1]), "type": fields.get("warc-type"),
                              "id": fields.get("warc-record-id"), "uri": fields.get("warc-target-uri"),
                              "digest": fields.get("warc-payload-digest")})
                offset += len(out[-1])
        except Damaged as error:
            lines.append({"offset": offset, "length": 0, "type": "damaged", "id": str(error)})
        return b"".join(out), "".join(json.dumps(line) + "\n" for line in lines).encode()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1):
            archive = batch.column("archive")[0].as_py()
            for kind, data in zip(("warc", "index"), rewritten(batch.column("content")[0].as_py())):
                data = data if kind == "warc" else member(data)
                yield pa.RecordBatch.from_arrays([pa.array([kind]), pa.array([archive]), pa.array([sealed(data)], pa.binary())],
                                                 names=["kind", "archive", "data"])

    _store(source.mapInArrow(run, "kind string, archive string, data binary"), folder, "kind", "archive")


def read_index(spark: SparkSession, folder: str) -> DataFrame:
    """The lines of all sidecars below ``folder``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [part.split()[0] for part in LINES.split(", ")]
        for batch in slices(batches, 1):
            archive = batch.column("archive")[0].as_py()
            data = b"".join(piece for *_, piece in inflated(batch.column("content")[0].as_py()))
            lines = [json.loads(line) for line in data.splitlines()]
            yield pa.RecordBatch.from_arrays(
                [pa.array([archive if n == "archive" else line.get(n) for line in lines],
                          pa.int64() if n in ("offset", "length") else pa.string()) for n in names], names=names)

    return archives(spark, f"{folder}/kind=index").mapInArrow(run, LINES)


PAGE = re.compile(r"<urn:page:(-?\d+)>")


def page_row(fields: dict[str, str], whole: bytes, start: int) -> dict | None:
    """The columns of a page's record; None for other records."""
    kind = fields.get("warc-type")
    if kind not in ("response", "revisit"):
        return None
    at = whole.index(b"\r\n\r\n", start) + 4
    payload = whole[at:-4]
    declared = base64.b32decode(fields["warc-payload-digest"].removeprefix("sha1:")).hex()
    if kind == "response":
        size, digest = len(payload), hashlib.sha1(payload).hexdigest()
    else:
        http = dict(line.lower().split(b":", 1) for line in whole[start:at - 4].split(b"\r\n")[1:])
        size, digest, payload = int(http[b"content-length"]), declared, None
    number = lambda field: int(m[1]) if (m := PAGE.fullmatch(fields.get(field, ""))) else None
    return {"page_id": number("warc-record-id"), "uri": fields.get("warc-target-uri"), "record_type": kind,
            "refers_to": number("warc-refers-to"), "payload_bytes": size, "payload_digest": digest,
            "intact": digest == declared, "payload": payload}


def _page_batch(rows: list[dict]) -> pa.RecordBatch:
    types = {"long": pa.int64(), "string": pa.string(), "boolean": pa.bool_(), "binary": pa.binary()}
    fields = [part.split() for part in RECORDS.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array([r[n] for r in rows], types[t]) for n, t in fields],
                                      names=[n for n, _ in fields])


def read(spark: SparkSession, folder: str, payloads: bool = False) -> DataFrame:
    """A row per page record of the normalised archives below ``folder``, with the place of its member; ``payloads`` asks for
    the payloads too (null for revisits)."""
    def found(archive: str, content: bytes) -> Iterator[dict]:
        pieces = []
        for offset, end, piece in inflated(content):
            pieces.append(piece)
            if end:
                for fields, whole, start in records(pieces):
                    row = page_row(fields, whole, start)
                    if row:
                        row |= {"archive": archive, "offset": offset, "length": end - offset}
                        yield row if payloads else row | {"payload": None}
                pieces = []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1):
            rows = []
            for row in found(batch.column("archive")[0].as_py(), batch.column("content")[0].as_py()):
                rows.append(row)
                if len(rows) == 256:
                    yield _page_batch(rows)
                    rows = []
            yield _page_batch(rows)

    return archives(spark, f"{folder}/kind=warc").mapInArrow(run, RECORDS)


def fetch(spark: SparkSession, folder: str, wanted: DataFrame) -> DataFrame:
    """The records of ``wanted`` (archive, offset, length), lines of the index, inflating nothing else."""
    places = wanted.groupBy("archive").agg(F.collect_list(F.struct("offset", "length")).alias("places"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1):
            content, rows = batch.column("content")[0].as_buffer(), []
            archive = batch.column("archive")[0].as_py()
            for place in batch.column("places")[0].as_py():
                raw = zlib.decompress(content[place["offset"]:place["offset"] + place["length"]], 31)
                row = next((page_row(*found) for found in records([raw])), None)
                if row:
                    rows.append(row | {"archive": archive} | place)
            yield _page_batch(rows)

    found = archives(spark, f"{folder}/kind=warc").join(places, "archive")
    return found.mapInArrow(run, RECORDS)


def round_trip(pages: DataFrame, folder: str | None = None, **columns) -> DataFrame:
    """Write ``pages`` as one-stream archives, normalise them below ``folder`` and read the records back (written out)."""
    spark = pages.sparkSession
    folder = folder or session.shared_path(spark, "warc")
    planned = plan(pages, **columns)
    streams = session.shared_path(spark, "warc_streams")
    write_streams(planned, streams)
    made = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(streams)
    if made.select("path").isEmpty():
        return spark.createDataFrame([], RECORDS)
    normalise(archives(spark, streams), folder)
    drop_folder(spark, streams)
    return materialize(read(spark, folder), "warc_records", FEW_ARCHIVES)


def drop_folder(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
