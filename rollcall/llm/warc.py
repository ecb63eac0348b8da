"""Web archives in Zstandard: a dictionary in the leading skippable frame, then one frame for each record.

Tasks write archives into the shared folder under names of their own attempt and return a manifest row for each; only archives in the
manifest are read, so a task that runs again leaves nothing behind that counts. Readers decode frame by frame and validate each record.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import checkpointed, clean_text, shared_folder

REVISIT_BYTES = 1000
#: An archive ends with the record that takes it past so many bytes.
ARCHIVE_BYTES = 64 << 20
#: A dictionary is trained on the first records of an archive: so many, or so many bytes.
DICTIONARY_BYTES, DICTIONARY_RECORDS, SAMPLE_BYTES, LEVEL = 32 << 10, 300, 16 << 20, 3
# Fixed values of the formats.
DICTIONARY_MAGIC, ZSTD_MAGIC, TRAINED_MAGIC = 0x184D2A5D, b"\x28\xb5\x2f\xfd", b"\x37\xa4\x30\xec"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
NEEDED = ("WARC-Type", "WARC-Record-ID", "WARC-Date", "Content-Length")
DATE = "2024-01-01T00:00:00Z"


def opened(folder: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(folder)


def record_id(page) -> str:
    return f"<urn:page:{'null' if page is None else page}>"


def page_of(record: str) -> int | None:
    name = record.removeprefix("<urn:page:").removesuffix(">")
    return None if name == "null" else int(name)


def record_bytes(page, url: str, payload: bytes, digest: str, refers_to: int | None, revisit: bool) -> bytes:
    """A response record, or a revisit record without the payload. The HTTP header has the length of the payload in both."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if revisit else http + payload
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: {record_id(page)}",
        f"WARC-Date: {DATE}",
        f"WARC-Target-URI: {quote(url, safe='%/:=&?~#+!$,;@()*[]')}",
        f"WARC-Payload-Digest: sha1:{base64.b32encode(bytes.fromhex(digest)).decode()}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if revisit:
        lines += [f"WARC-Profile: {REVISIT_PROFILE}", f"WARC-Refers-To: {record_id(refers_to)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def archive_head(samples: list[bytes]) -> tuple[bytes, object]:
    """The leading frame with a dictionary trained on some records, and a compressor; where there is too little to learn from, the records'
    own beginnings are the dictionary."""
    import zstandard

    try:
        size = max(256, min(DICTIONARY_BYTES, sum(map(len, samples)) // 16))
        dictionary = zstandard.train_dictionary(size, samples, level=LEVEL)
    except zstandard.ZstdError:
        own = b"".join(r[: DICTIONARY_BYTES // len(samples)] for r in samples)
        dictionary = zstandard.ZstdCompressionDict(own, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    packed = zstandard.ZstdCompressor(level=LEVEL).compress(dictionary.as_bytes())
    dictionary.precompute_compress(level=LEVEL)
    return struct.pack("<II", DICTIONARY_MAGIC, len(packed)) + packed, zstandard.ZstdCompressor(dict_data=dictionary, write_checksum=True)


def roles(pages: DataFrame) -> DataFrame:
    """``pages`` (``page``, ``url``, ``payload``) with ``__digest``, ``__bytes``, ``__revisit`` and ``__refers_to``."""
    hashed = pages.select(F.col("page").alias("__page"), F.sha1("payload").alias("__digest"), F.octet_length("payload").alias("__bytes"))
    repeated = (
        hashed.where(F.col("__bytes") >= REVISIT_BYTES)
        .groupBy(F.col("__digest").alias("__same"), F.col("__bytes").alias("__long"))
        .agg(F.max("__page").alias("__refers_to"), F.count(F.lit(1)).alias("__n"))
        .where("__n > 1")
        .drop("__n")
    )
    own = pages.withColumns({"__digest": F.sha1("payload"), "__bytes": F.octet_length("payload")})
    joined = own.join(repeated, (own["__digest"] == repeated["__same"]) & (own["__bytes"] == repeated["__long"]), "left")
    return joined.withColumn("__revisit", F.col("__same").isNotNull() & ~F.col("page").eqNullSafe(F.col("__refers_to")))


def write_archives(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html") -> DataFrame:
    """Write a record for each row and return the manifest: ``archive`` (path), ``bytes`` and ``records``.

    Of rows with equal payloads of at least REVISIT_BYTES, the one with the largest id is a response and the others revisit it (rows
    that repeat the largest id are responses too; a null id is never the largest unless all are null); smaller payloads are always
    responses. Null payloads and addresses are empty; of very long payloads a task holds one record, and at most SAMPLE_BYTES of records
    besides while it collects what the dictionary learns from. An empty table writes nothing. Ids are whole numbers; other columns, whatever
    their names, are not written.
    """
    folder = f"{shared_folder(pages.sparkSession)}/warc-{uuid.uuid4().hex}"
    if "://" not in folder and not folder.startswith("/"):
        folder = "/" + folder.removeprefix("file:").lstrip("/")
    folder = folder.replace("file:/", "file:///", 1) if folder.startswith("file:/") and not folder.startswith("file:///") else folder
    own = pages.select(F.col(id_col).alias("page"), clean_text(F.col(url_col).cast("string")).alias("url"), clean_text(payload_col).alias("payload"))
    rows = roles(own).select("page", "url", F.col("payload").cast("binary").alias("payload"), "__digest", "__refers_to", "__revisit")

    def run(batches):
        where, root = opened(folder)
        where.create_dir(root, recursive=True)
        attempt, archives = TaskContext.get().taskAttemptId(), 0
        out, size, records, samples, compressor, name = None, 0, 0, [], None, ""

        def begin():
            nonlocal out, size, records, compressor, name, archives
            name = f"{root}/part-{attempt}-{archives}.warc.zst"
            archives += 1
            out = where.open_output_stream(name, compression=None)
            head, compressor = archive_head(samples)
            out.write(head)
            size, records = len(head), 0

        def put(record):
            nonlocal size, records
            frame = compressor.compress(record)
            out.write(frame)
            size += len(frame)
            records += 1

        def close():
            out.close()
            return pa.RecordBatch.from_pydict({"archive": [name], "bytes": pa.array([size], pa.int64()), "records": pa.array([records], pa.int64())})

        for batch in batches:
            for values in zip(*(batch.column(i).to_pylist() for i in range(6))):
                record = record_bytes(*values)
                if out is None:
                    samples.append(record)
                    if len(samples) < DICTIONARY_RECORDS and sum(map(len, samples)) < SAMPLE_BYTES:
                        continue
                    begin()
                    for r in samples:
                        put(r)
                else:
                    put(record)
                if size >= ARCHIVE_BYTES:
                    yield close()
                    out, samples = None, []
        if out is None and samples:
            begin()
            for r in samples:
                put(r)
        if out is not None:
            yield close()

    return checkpointed(rows.mapInArrow(run, "archive string, bytes long, records long"))


def frames(stream, chunk: int = 1 << 20) -> Iterator[tuple[int, bytes]]:
    """Where each frame of an archive begins, and what it holds decoded; the dictionary is taken from the leading frame."""
    import zstandard

    data, at, base = stream.read(chunk), 0, 0

    def more(need: int) -> bool:
        nonlocal data, at, base
        while len(data) - at < need:
            got = stream.read(max(chunk, need))
            if not got:
                return False
            data, base, at = data[at:] + got, base + at, 0
        return True

    decoder = zstandard.ZstdDecompressor()
    if more(8) and struct.unpack("<I", data[:4])[0] == DICTIONARY_MAGIC:
        size = struct.unpack("<I", data[4:8])[0]
        if not more(8 + size):
            raise ValueError("the dictionary frame is cut short")
        dictionary = data[8 : 8 + size]
        if dictionary[:4] == ZSTD_MAGIC:
            dictionary = decoder.decompress(dictionary)
        trained = dictionary[:4] == TRAINED_MAGIC
        kind = zstandard.DICT_TYPE_FULLDICT if trained else zstandard.DICT_TYPE_RAWCONTENT
        decoder = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(dictionary, dict_type=kind))
        at = 8 + size
    while more(1):
        begin, one, parts = base + at, decoder.decompressobj(), []
        while not one.eof:
            if not more(1):
                raise ValueError(f"the frame at {begin} is cut short")
            part = data[at : at + (32 << 10)]
            parts.append(one.decompress(part))
            at += len(part) - len(one.unused_data)
        yield begin, b"".join(parts)


def parse_record(data: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields and block of a record; raises ValueError for what is not one whole record."""
    head, cut, rest = data.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not cut or lines[0] not in ("WARC/1.0", "WARC/1.1"):
        raise ValueError("no record header")
    fields = {}
    for line in lines[1:]:
        name, colon, value = line.partition(":")
        if not colon or not name.strip():
            raise ValueError(f"not a header line: {line[:80]!r}")
        fields[name.strip()] = value.strip()
    for name in NEEDED:
        if name not in fields:
            raise ValueError(f"{name} is missing")
    if not fields["Content-Length"].isdigit():
        raise ValueError("Content-Length is no number")
    length = int(fields["Content-Length"])
    if len(rest) != length + 4 or rest[length:] != b"\r\n\r\n":
        raise ValueError(f"the block has {len(rest) - 4} bytes, its header says {length}")
    return fields, rest[:length]


def page_row(data: bytes) -> dict:
    """What a response or revisit record says about its page."""
    fields, block = parse_record(data)
    http, cut, payload = block.partition(b"\r\n\r\n")
    said = [line.partition(b":")[2].strip() for line in http.split(b"\r\n")[1:] if line.lower().startswith(b"content-length:")]
    if not cut or len(said) != 1 or not said[0].isdigit():
        raise ValueError("no HTTP header with one length")
    digest = base64.b32decode(fields["WARC-Payload-Digest"].removeprefix("sha1:")).hex()
    revisit = fields["WARC-Type"] == "revisit"
    if not revisit and (len(payload) != int(said[0]) or hashlib.sha1(payload).hexdigest() != digest):
        raise ValueError("the payload does not fit its length or digest")
    if revisit and (payload or "WARC-Refers-To" not in fields):
        raise ValueError("not a revisit")
    return {
        "page_id": page_of(fields["WARC-Record-ID"]),
        "url": fields.get("WARC-Target-URI"),
        "payload_bytes": int(said[0]),
        "payload_digest": digest,
        "record_type": fields["WARC-Type"],
        "refers_to": page_of(fields["WARC-Refers-To"]) if revisit else None,
        "payload": None if revisit else payload,
    }


def read_archives(manifest: DataFrame, payloads: bool = False) -> DataFrame:
    """A row for each record of the archives: ``archive``, ``position``, page id, address, lengths, digest, type, the page it refers
    to and, if asked for, the payload. A record or frame that does not hold together stops the read with its archive and position."""
    names = ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to", *["payload"] * payloads]
    kinds = {"page_id": pa.int64(), "payload_bytes": pa.int64(), "refers_to": pa.int64(), "payload": pa.binary()}
    uri = shared_folder(manifest.sparkSession)
    remote = "://" in uri and not uri.startswith("file:")

    def batch_of(path, rows):
        columns = {"archive": [path] * len(rows), "position": pa.array([p for p, _ in rows], pa.int64())}
        return pa.RecordBatch.from_pydict(columns | {n: pa.array([r[n] for _, r in rows], kinds.get(n, pa.string())) for n in names})

    def run(batches):
        where = fs.FileSystem.from_uri(uri)[0] if remote else fs.LocalFileSystem()
        for batch in batches:
            for path, records in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                rows, size, seen = [], 0, 0
                with where.open_input_stream(path, compression=None) as stream:
                    for position, data in frames(stream):
                        try:
                            rows.append((position, page_row(data)))
                        except ValueError as error:
                            raise ValueError(f"{path}, at {position}: {error}") from None
                        size += len(data) * payloads + 200
                        seen += 1
                        if size > 8 << 20:
                            yield batch_of(path, rows)
                            rows, size = [], 0
                if seen != records:
                    raise ValueError(f"{path} has {seen} records, the manifest says {records}")
                if rows:
                    yield batch_of(path, rows)

    schema = "archive string, position long, page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long"
    manifest = manifest.select("archive", "records")
    # An archive is a task's work: as many tasks as archives.
    return manifest.repartition(max(1, manifest.count())).mapInArrow(run, schema + ", payload binary" * payloads)
