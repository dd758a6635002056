"""Legacy archive converter: ARC files of version 1 or 2 to WARC 1.1, with revisit records for repeated payloads.

An ARC file opens with a version block; the version decides how many fields a record's header line holds.
The last field is the declared length of the content, which is read byte by byte as declared.  The converter
synthesises what WARC asks for and ARC lacks: record identifiers (a name-based UUID of file and position),
timestamps in ISO form, record types and payload digests (SHA-256).

Four steps, each a distributed job over files of about one input split:

1. ``write_arc``    pages -> ARC files, one gzip member per record (the test tables hold no archives)
2. ``arc_index``    one row per record: place, page, payload length and digest
3. ``write_warc``   the converter; of equal payloads of ``least`` bytes or more, the record with the smallest
   page is the response and the others revisit it.  The smallest comes from a partial aggregate, so a payload
   with a third of all records costs one row per task; the decisions reach the files sorted, as a stream
4. ``read_warc``    one row per record of the WARC files, digests checked against the payloads

Tasks hold one record at a time and rename their file at the end, so a repeated task replaces it whole.

Null html counts as empty; a null or empty url is written as ``-``, blanks in a url as %-escapes.  A null page
id comes last among equals and is no one's target.  Rows that repeat the smallest page id are responses too.
"""

from __future__ import annotations

import contextlib
import gzip
import hashlib
import io
import itertools
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from creatorlens.llm.common import filesystem, shared_folder, table, written

#: The header lines of the two versions of the format.
FIELDS = {
    1: ["URL", "IP-address", "Archive-date", "Content-type", "Archive-length"],
    2: ["URL", "IP-address", "Archive-date", "Content-type", "Result-code", "Checksum", "Location", "Offset",
        "Filename", "Archive-length"],
}
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
LEAST = 100


# ---------------------------------------------------------------- files

@contextlib.contextmanager
def writer(folder: str, name: str):
    """``put(bytes)`` appends one gzip member; the file takes its name when all went well."""
    fs, at = filesystem(folder)
    fs.create_dir(at, recursive=True)
    own = f"{at}/.{name}-{uuid.uuid4().hex}"
    with fs.open_output_stream(own, compression=None) as out:
        def put(*parts: bytes) -> int:
            packer = zlib.compressobj(1, zlib.DEFLATED, 31)
            return sum(out.write(x) for x in [*(packer.compress(p) for p in parts), packer.flush()])
        yield put
    fs.move(own, f"{at}/{name}")


@contextlib.contextmanager
def reader(folder: str, name: str):
    """A buffered stream of the file's bytes, unpacked if its name ends in .gz."""
    fs, at = filesystem(folder)
    with fs.open_input_stream(f"{at}/{name}", compression=None) as raw:
        yield io.BufferedReader(gzip.GzipFile(fileobj=raw), 1 << 18) if name.endswith(".gz") else io.BufferedReader(raw, 1 << 18)


# ---------------------------------------------------------------- ARC

def plain_url(url: str | None) -> str:
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url or "") or "-"


def arc_version_block(name: str, version: int, date: str) -> bytes:
    body = f"{version} 0 -\n{' '.join(FIELDS[version])}\n\n".encode()
    values = {"URL": f"filedesc://{name}", "IP-address": "0.0.0.0", "Archive-date": date, "Content-type": "text/plain",
              "Result-code": "200", "Filename": name, "Offset": "0", "Archive-length": str(len(body))}
    return " ".join(values.get(f, "-") for f in FIELDS[version]).encode() + b"\n" + body


def arc_header(version: int, url: str, date: str, kind: str, name: str, offset: int, length: int) -> bytes:
    values = {"URL": url, "IP-address": "0.0.0.0", "Archive-date": date, "Content-type": kind, "Result-code": "200",
              "Filename": name, "Offset": str(offset), "Archive-length": str(length)}
    return " ".join(values.get(f, "-") for f in FIELDS[version]).encode() + b"\n"


def http_block(page: str, body: bytes) -> bytes:
    return (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nX-Page-Id: {page}\r\n"
            f"Content-Length: {len(body)}\r\n\r\n").encode() + body


def arc_records(stream, name: str) -> Iterator[tuple[dict, bytes]]:
    """(header fields, content) of every record after the version block."""
    fields = FIELDS[1]
    for number in itertools.count():
        line = stream.readline()
        while line in (b"\n", b"\r\n"):
            line = stream.readline()
        if not line:
            return
        values = line.decode("utf-8", "replace").rstrip("\r\n").split(" ")
        if number == 0 and len(values) in (5, 10):
            fields = FIELDS[1 if len(values) == 5 else 2]
        if len(values) < len(fields) or not values[-1].isdigit():
            raise ValueError(f"{name}: record {number} has no header line of {len(fields)} fields: {line[:80]!r}")
        extra = len(values) - len(fields)  # blanks in an old file's url
        values = [" ".join(values[:extra + 1]), *values[extra + 1:]]
        header = dict(zip(fields, values))
        content = stream.read(int(header["Archive-length"]))
        if len(content) != int(header["Archive-length"]):
            raise ValueError(f"{name}: record {number} ends after {len(content)} of {header['Archive-length']} bytes")
        if number == 0 and header["URL"].startswith("filedesc:"):
            version = content.split(b" ", 1)[0]
            fields = FIELDS.get(int(version) if version.isdigit() else 1, FIELDS[1])
            continue
        yield header, content


def http_parts(content: bytes) -> tuple[bytes, bytes]:
    """Header and payload of an HTTP response; other contents are all payload."""
    if not content.startswith(b"HTTP/"):
        return b"", content
    head, blank, body = content.partition(b"\r\n\r\n")
    return head + blank, body


def head_field(head: bytes, name: bytes) -> str | None:
    found = re.search(rb"(?im)^" + re.escape(name) + rb":[ \t]*(.*?)\r?$", head)
    return found[1].decode() if found else None


def write_arc(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
              date: str = "20000101000000") -> list[str]:
    """One ARC file per partition, of version 1 and 2 by turns; returns the files' names (one per partition)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        name, version = f"part-{part:05d}.arc.gz", 1 + part % 2
        batches = (b for b in batches if b.num_rows)
        first = next(batches, None)
        if first is None:
            return
        with writer(folder, name) as put:
            offset = put(arc_version_block(name, version, date))
            for batch in itertools.chain([first], batches):
                for i in range(batch.num_rows):
                    page, url, html = (c[i].as_py() for c in batch.columns)
                    block = http_block("" if page is None else str(page), (html or "").encode())
                    offset += put(arc_header(version, plain_url(url), date, "text/html", name, offset, len(block)), block, b"\n")
        yield pa.RecordBatch.from_arrays([pa.array([name])], names=["file"])

    rows = pages.select(id_col, url_col, html_col).mapInArrow(run, "file string").collect()  # one row per file
    return sorted(r.file for r in rows)


def files_frame(spark: SparkSession, names: list[str]) -> DataFrame:
    if not names:
        return spark.createDataFrame([], "file string")
    return spark.createDataFrame([(n,) for n in names], "file string").repartition(len(names))


def arc_index(files: DataFrame, folder: str) -> DataFrame:
    """(file, record, page, payload_bytes, payload_digest) of every record."""
    schema = pa.schema([("file", pa.string()), ("record", pa.int64()), ("page", pa.string()),
                        ("payload_bytes", pa.int64()), ("payload_digest", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for name in (n for b in batches for n in b.column(0).to_pylist()):
            with reader(folder, name) as stream:
                records = enumerate(arc_records(stream, name))
                while rows := list(itertools.islice(((name, i, *_payload(c)) for i, (_, c) in records), 2000)):
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    return files.mapInArrow(run, "file string, record long, page string, payload_bytes long, payload_digest string")


def _payload(content: bytes) -> tuple[str | None, int, str]:
    head, body = http_parts(content)
    return head_field(head, b"X-Page-Id") or None, len(body), hashlib.sha256(body).hexdigest()


# ---------------------------------------------------------------- WARC

def record_id(name: str, record: int) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{name}#{record}')}>"


def iso_date(date: str) -> str:
    date = (date + "00000000000000")[:14] if date.isdigit() else "19700101000000"
    return f"{date[:4]}-{date[4:6]}-{date[6:8]}T{date[8:10]}:{date[10:12]}:{date[12:14]}Z"


def warc_record(kind: str, fields: list[tuple[str, str]], block: bytes) -> tuple[bytes, bytes, bytes]:
    lines = [("WARC-Type", kind), *fields, ("Content-Length", str(len(block)))]
    return "".join(["WARC/1.1\r\n", *(f"{k}: {v}\r\n" for k, v in lines), "\r\n"]).encode(), block, b"\r\n\r\n"


def revisits(index: DataFrame, id_type: str, least: int = LEAST) -> DataFrame:
    """(file, record, to_file, to_record, to_page) of the records that revisit another."""
    page = F.col("page").cast(id_type)
    place = F.struct(page.isNull().alias("none"), page.alias("page"), "file", "record")
    index = index.filter(F.col("payload_bytes") >= least)
    first = (index.groupBy("payload_digest").agg(F.min(place).alias("to"), F.count("*").alias("n"))
             .filter((F.col("n") > 1) & F.col("to.page").isNotNull()).select("payload_digest", "to"))
    return (index.join(first, "payload_digest")
            .filter(~page.eqNullSafe(F.col("to.page")))
            .select("file", "record", F.col("to.file").alias("to_file"), F.col("to.record").alias("to_record"),
                    F.col("to.page").cast("string").alias("to_page")))


def write_warc(files: DataFrame, arc_folder: str, folder: str, revisiting: DataFrame, count: int) -> list[str]:
    """Convert every ARC file into one WARC file; returns the files' names (one per file).

    A task reads an ARC file and, in step with it, the sorted stream of its records that revisit another.
    """
    marks = files.select("file", F.lit(-1).cast("long").alias("record"), F.lit(None).cast("string").alias("to_file"),
                         F.lit(None).cast("long").alias("to_record"), F.lit(None).cast("string").alias("to_page"))
    rows = marks.unionByName(revisiting).repartition(max(count, 1), "file").sortWithinPartitions("file", "record")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stream = (r for b in batches for r in zip(*(c.to_pylist() for c in b.columns)))
        for name, own in itertools.groupby(stream, key=lambda r: r[0]):
            next(own)  # the file's mark
            out = re.sub(r"\.arc(\.gz)?$", "", name) + ".warc.gz"
            with reader(arc_folder, name) as arc, writer(folder, out) as put:
                info = f"software: creatorlens\r\nformat: WARC File Format 1.1\r\nconverted-from: {name}\r\n".encode()
                put(*warc_record("warcinfo", [("WARC-Record-ID", record_id(out, -1)), ("WARC-Date", "1970-01-01T00:00:00Z"),
                                              ("WARC-Filename", out), ("Content-Type", "application/warc-fields")], info))
                ahead = next(own, None)
                for number, (header, content) in enumerate(arc_records(arc, name)):
                    head, body = http_parts(content)
                    fields = [("WARC-Record-ID", record_id(name, number)), ("WARC-Date", iso_date(header["Archive-date"])),
                              ("WARC-Target-URI", header["URL"]), ("WARC-IP-Address", header["IP-address"]),
                              ("WARC-Payload-Digest", f"sha256:{hashlib.sha256(body).hexdigest()}")]
                    if ahead and ahead[1] == number:
                        _, _, to_file, to_record, to_page = ahead
                        ahead = next(own, None)
                        fields += [("WARC-Profile", REVISIT), ("WARC-Refers-To", record_id(to_file, to_record)),
                                   ("X-Refers-To-Page", to_page), ("X-Payload-Length", str(len(body))),
                                   ("Content-Type", "application/http;msgtype=response")]
                        put(*warc_record("revisit", fields, head))
                    else:
                        kind = ("response", "application/http;msgtype=response") if head else ("resource", header["Content-type"])
                        put(*warc_record(kind[0], [*fields, ("Content-Type", kind[1])], content))
            yield pa.RecordBatch.from_arrays([pa.array([out])], names=["file"])

    return sorted(r.file for r in rows.mapInArrow(run, "file string").collect())  # one row per file


def warc_records(stream, name: str) -> Iterator[tuple[dict, bytes]]:
    """(named fields in lower case, block) of every record."""
    while line := stream.readline():
        if line in (b"\r\n", b"\n"):
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"{name}: no record starts with {line[:80]!r}")
        fields = {}
        while (line := stream.readline()).rstrip(b"\r\n"):
            key, _, value = line.decode("utf-8", "replace").partition(":")
            fields[key.strip().lower()] = value.strip()
        block = stream.read(int(fields["content-length"]))
        if len(block) != int(fields["content-length"]):
            raise ValueError(f"{name}: a record ends early")
        yield fields, block


def read_warc(files: DataFrame, folder: str) -> DataFrame:
    """(record_id, target_uri, warc_date, page, payload_bytes, payload_digest, record_type, refers_to) of every
    record but the file's own description."""
    names = ["record_id", "target_uri", "warc_date", "page", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    schema = pa.schema([(n, pa.int64() if n == "payload_bytes" else pa.string()) for n in names])

    def row(fields: dict, block: bytes, name: str) -> tuple:
        head, body = http_parts(block)
        digest = fields["warc-payload-digest"].removeprefix("sha256:")
        if fields["warc-type"] == "revisit":
            size = int(fields["x-payload-length"])
        else:
            size = len(body)
            if hashlib.sha256(body).hexdigest() != digest:
                raise ValueError(f"{name}: {fields['warc-record-id']} fails its digest")
        return (fields["warc-record-id"], fields["warc-target-uri"], fields["warc-date"], head_field(head, b"X-Page-Id") or None,
                size, digest, fields["warc-type"], fields.get("x-refers-to-page"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for name in (n for b in batches for n in b.column(0).to_pylist()):
            with reader(folder, name) as stream:
                found = (row(f, b, name) for f, b in warc_records(stream, name) if f["warc-type"] != "warcinfo")
                while rows := list(itertools.islice(found, 2000)):
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    return files.mapInArrow(run, ", ".join(f"{n} {'long' if n == 'payload_bytes' else 'string'}" for n in names))


def convert(spark: SparkSession, arc_folder: str, names: list[str], folder: str, id_type: str = "long",
            least: int = LEAST) -> list[str]:
    """The whole converter: ARC files to WARC files."""
    index = written(arc_index(files_frame(spark, names), arc_folder), "arc-index")
    return write_warc(files_frame(spark, names), arc_folder, folder, revisits(index, id_type, least), len(names))


def op9_warc(spark, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    arcs, warcs = shared_folder(spark, "arc"), shared_folder(spark, "warc")
    names = convert(spark, arcs, write_arc(pages, arcs), warcs)
    out = read_warc(files_frame(spark, names), warcs)
    return out.select(F.col("page").cast("long").alias("page_id"), "payload_bytes", "payload_digest", "record_type",
                      F.col("refers_to").cast("long").alias("refers_to"))


SQL = """
WITH p AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest
  FROM pages),
m AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first FROM p)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 100 AND first IS NOT NULL AND page_id IS DISTINCT FROM first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 100 AND page_id IS DISTINCT FROM first THEN first END AS refers_to
FROM m
"""
