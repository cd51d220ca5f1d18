"""WARC archives compressed with Zstandard: one frame per record, the dictionary in a leading skippable frame."""

from __future__ import annotations

import base64
import hashlib
import io
import struct
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seekframe.llm.common import fresh, new_folder, open_store, settle, small

# Fixed values of the public formats: the magic number of the frame with the dictionary, that of a Zstandard frame,
# and the profile of a record that refers to an earlier one with the same payload.
DICTIONARY_MAGIC, FRAME_MAGIC = 0x184D2A5D, 0xFD2FB528
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
VERSION = b"WARC/1.1"
REQUIRED = ("warc-record-id", "content-length", "warc-date", "warc-type")

#: Size at which a writer closes an archive and opens the next.
ARCHIVE_BYTES = 64 << 20
#: The dictionary is trained on at most so many pages, on a piece of so many characters of each: the one bound, for training alone.
DICTIONARY_PAGES, DICTIONARY_PIECE, DICTIONARY_BYTES = 400, 1 << 15, 1 << 15
DATE = "2024-01-01T00:00:00Z"


def digest(payload: bytes) -> str:
    """Bare upper-case base32 of the SHA-1."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _http(length: int) -> bytes:
    return b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % length


def _record(kind: str, record_id: str, uri: str | None, payload_digest: str, block: bytes, refers_to: str | None) -> bytes:
    head = [("WARC-Type", kind), ("WARC-Record-ID", f"<{record_id}>"), ("WARC-Date", DATE)]
    if uri is not None:
        head.append(("WARC-Target-URI", "".join(uri.splitlines())))
    head += [("WARC-Payload-Digest", f"sha1:{payload_digest}"), ("WARC-Block-Digest", f"sha1:{digest(block)}")]
    if refers_to is not None:
        head += [("WARC-Profile", PROFILE), ("WARC-Refers-To", f"<{refers_to}>")]
    head += [("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    return b"\r\n".join([VERSION, *(f"{k}: {v}".encode() for k, v in head), b"", block, b"", b""])


def response(record_id: str, uri: str | None, payload: bytes) -> bytes:
    return _record("response", record_id, uri, digest(payload), _http(len(payload)) + payload, None)


def revisit(record_id: str, uri: str | None, payload_bytes: int, payload_digest: str, refers_to: str) -> bytes:
    """A record that has the HTTP header with the payload's length and the payload's digest, but not the payload."""
    return _record("revisit", record_id, uri, payload_digest, _http(payload_bytes), refers_to)


def parse(raw: bytes) -> dict:
    """Fields of one decoded record: headers (lower-case names), block, payload (None for a revisit), payload_bytes.

    Raises ValueError where the version, a required header, a length, a digest or the end is wrong.
    """
    head, found, rest = raw.partition(b"\r\n\r\n")
    lines = head.split(b"\r\n")
    if not found or lines[0] != VERSION:
        raise ValueError("not a WARC record")
    headers: dict[str, str] = {}
    for line in lines[1:]:
        name, colon, value = line.decode("utf-8").partition(":")
        if not colon:
            raise ValueError(f"header line without a colon: {line[:80]!r}")
        headers[name.strip().lower()] = value.strip()
    if missing := [x for x in REQUIRED if x not in headers]:
        raise ValueError(f"no {', '.join(missing)}")
    if not headers["content-length"].isdigit() or len(rest) != int(headers["content-length"]) + 4:
        raise ValueError(f"block of {len(rest) - 4} bytes, Content-Length {headers['content-length']}")
    if rest[-4:] != b"\r\n\r\n":
        raise ValueError("a record must end in two line ends")
    block = rest[:-4]
    http, found, payload = block.partition(b"\r\n\r\n")
    fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(b":") for x in http.split(b"\r\n")[1:])}
    length = fields.get(b"content-length", b"")
    if not found or not length.isdigit():
        raise ValueError("no HTTP header with a Content-Length")
    if headers.get("warc-block-digest", f"sha1:{digest(block)}") != f"sha1:{digest(block)}":
        raise ValueError("wrong block digest")
    if headers["warc-type"] == "response":
        if len(payload) != int(length) or headers.get("warc-payload-digest") != f"sha1:{digest(payload)}":
            raise ValueError("wrong payload length or digest")
    elif headers["warc-type"] == "revisit":
        if payload or "warc-refers-to" not in headers or not headers.get("warc-payload-digest", "").startswith("sha1:"):
            raise ValueError("a revisit needs WARC-Refers-To, a payload digest and no payload")
    return {"headers": headers, "payload": payload if headers["warc-type"] == "response" else None, "payload_bytes": int(length)}


class Writer:
    """Writes one archive: the dictionary first, then each record in a frame of its own."""

    def __init__(self, path: str, dictionary: bytes):
        store, where = open_store(path)
        self.path, self.records, self.bytes = path, 0, 0
        self.out = store.open_output_stream(where, compression=None)  # the name would choose a second compression
        self.packer = zstandard.ZstdCompressor(level=3, dict_data=zstandard.ZstdCompressionDict(dictionary), write_content_size=True, write_checksum=True)
        packed = zstandard.ZstdCompressor(level=19).compress(dictionary)
        self.put(struct.pack("<II", DICTIONARY_MAGIC, len(packed)) + packed)

    def put(self, data: bytes) -> None:
        self.out.write(data)
        self.bytes += len(data)

    def add(self, raw: bytes) -> None:
        self.put(self.packer.compress(raw))
        self.records += 1

    def close(self) -> tuple[str, int, int]:
        self.out.close()
        return self.path, self.records, self.bytes


def read(stream: io.RawIOBase, chunk: int = 1 << 20) -> Iterator[bytes]:
    """Decoded records of one archive, one at a time: memory is bounded by the largest record, not the archive."""
    buffer = stream.read(8)
    dictionary = None
    if len(buffer) == 8 and struct.unpack("<I", buffer[:4])[0] == DICTIONARY_MAGIC:
        (length,) = struct.unpack("<I", buffer[4:])
        held = stream.read(length)
        if len(held) != length:
            raise ValueError("the dictionary is cut short")
        if held[:4] == struct.pack("<I", FRAME_MAGIC):
            held = zstandard.ZstdDecompressor().decompressobj().decompress(held)
        dictionary, buffer = zstandard.ZstdCompressionDict(held), b""
    unpacker = zstandard.ZstdDecompressor(dict_data=dictionary)
    while True:
        if not buffer and not (buffer := stream.read(chunk)):
            return
        frame, parts = unpacker.decompressobj(), []
        while not frame.eof:
            if not buffer and not (buffer := stream.read(chunk)):
                raise ValueError("the last frame is cut short")
            parts.append(frame.decompress(buffer))
            buffer = frame.unused_data if frame.eof else b""
        yield b"".join(parts)


def train(pages: DataFrame, html_col: str) -> bytes:
    """A dictionary from a bounded sample of pages of any length, drawn by a hash of their content.

    Of each sampled page one piece is used, from a place that the hash names. Where there is too little to train on,
    or the trainer finds nothing to share, the dictionary is the start of the sample as it is, after an HTTP header.
    """
    html = F.coalesce(F.col(html_col).cast("string"), F.lit(""))
    h = F.xxhash64(html)
    begin = F.pmod(h, F.greatest(F.char_length(html) - DICTIONARY_PIECE + 1, F.lit(1)).cast("long")).cast("int") + 1
    hashed = pages.select(h.alias("h"), F.substr(html, begin, F.lit(DICTIONARY_PIECE)).alias("piece"))
    # hashes alone find the bound; only the pieces below it, each once, come to the driver
    bound = hashed.select("h").distinct().orderBy("h").limit(DICTIONARY_PAGES).agg(F.max("h").alias("h")).first().h
    pieces = [] if bound is None else [r.piece.encode() for r in hashed.where(F.col("h") <= bound).groupBy("h").agg(F.min("piece").alias("piece")).orderBy("h").collect() if r.piece]
    size = min(DICTIONARY_BYTES, sum(map(len, pieces)) // 8)
    if size >= 1024:
        try:
            return zstandard.train_dictionary(size, pieces).as_bytes()
        except zstandard.ZstdError:  # the trainer refuses samples in which it finds nothing to share
            pass
    return (_http(0) + b"".join(pieces))[:DICTIONARY_BYTES]


class Archives:
    """The archives that one task writes, one after the other; each is closed at ``most`` bytes. Record ids are numbered on."""

    def __init__(self, folder: str, tag: str, dictionary: bytes, most: int):
        task = TaskContext.get()
        # a task that is run again writes archives of new names, with the same records in them
        self.name, self.tag = f"{folder}/{tag}{task.partitionId():06d}-{task.taskAttemptId()}", f"{tag}{task.partitionId()}"
        self.dictionary, self.most, self.n, self.writer, self.done = dictionary, most, 0, None, []

    def next_id(self, page: int | None) -> str:
        self.n += 1
        return f"urn:page:{'' if page is None else page}:{self.tag}:{self.n}"

    def add(self, raw: bytes) -> None:
        if self.writer is None:
            self.writer = Writer(f"{self.name}-{len(self.done):04d}.warc.zst", self.dictionary)
        self.writer.add(raw)
        if self.writer.bytes >= self.most:
            self.close()

    def close(self) -> None:
        if self.writer is not None:
            self.done.append(self.writer.close())
            self.writer = None


def write_archives(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", least_bytes: int = 0, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write one record for every row of pages; (path, records, bytes) of each archive written.

    Of rows with equal payloads of at least ``least_bytes`` bytes those with the largest id are responses (all of them,
    if several rows share that id) and the others revisits that refer to one of them (a null id is smaller than any);
    all others are responses. A null payload is an empty one. Repeated rows give a record each; every record has an id
    of its own. Other columns are ignored. Very long payloads are one record. An empty table gives no archive.

    Rows aren't shuffled unless there are very many different repeated payloads: what is grouped are digests, and the
    groups with more than one id are few or are joined on an exchange that can be split. Responses are written first;
    a revisit's archive is written when the record that it refers to has its id.
    """
    spark = pages.sparkSession
    folder = new_folder(spark, "warc")
    dictionary = train(pages, html_col)
    html = F.coalesce(F.col(html_col).cast("string"), F.lit(""))
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), html.alias("html"), F.sha1(html).alias("digest"))
    repeated = rows.where(F.octet_length("html") >= least_bytes).groupBy("digest").agg(F.max("page_id").alias("first"), F.count(F.lit(1)).alias("n"))
    repeated = small(repeated.where("n > 1 and first is not null").select(fresh("digest", "string").alias("of"), "first"), "warc-repeated")
    marked = rows.join(repeated, F.col("digest") == F.col("of"), "left").select("page_id", "url", "digest", "html", F.when(F.octet_length("html") >= least_bytes, F.col("first")).alias("first"))
    names = ["path", "records", "bytes", "page_id", "url", "digest", "payload_bytes", "record"]
    kinds = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string()]
    schema = "path string, records long, bytes long, page_id long, url string, digest string, payload_bytes long, record string"

    def table_of(out: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names)

    def responses(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Writes responses; gives rows of three kinds: archives, records that others refer to, and rows still to be revisits."""
        archives = Archives(folder, "r", dictionary, archive_bytes)
        for b in batches:
            out: list[tuple] = []
            for page, url, hashed, text, first in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist(), b.column(3), b.column(4).to_pylist()):
                payload = text.as_py().encode("utf-8", "surrogatepass")
                if first is not None and (page is None or page < first):
                    out.append((None, None, None, page, url, hashed, len(payload), None))
                    continue
                record = archives.next_id(page)
                archives.add(response(record, url, payload))
                if first is not None:
                    out.append((None, None, None, None, None, hashed, None, record))
            if out:
                yield table_of(out)
        archives.close()
        if archives.done:
            yield table_of([(*x, None, None, None, None, None) for x in archives.done])

    def revisits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        archives = Archives(folder, "v", dictionary, archive_bytes)
        for b in batches:
            for page, url, hashed, size, record in zip(*(c.to_pylist() for c in b.columns)):
                archives.add(revisit(archives.next_id(page), url, size, base64.b32encode(bytes.fromhex(hashed)).decode(), record))
        archives.close()
        if archives.done:
            yield table_of([(*x, None, None, None, None, None) for x in archives.done])

    written, _ = settle(marked.mapInArrow(responses, schema), "warc-responses")
    manifest = written.where("path is not null").select("path", "records", "bytes")
    due = written.where("path is null and record is null")
    if due.isEmpty():
        return manifest
    known = small(written.where("record is not null").groupBy("digest").agg(F.min("record").alias("record")), "warc-known").select(fresh("digest", "string").alias("of"), "record")
    again = due.select("page_id", "url", "digest", "payload_bytes").join(known, F.col("digest") == F.col("of")).select("page_id", "url", "digest", "payload_bytes", "record")
    return manifest.union(settle(again.mapInArrow(revisits, schema), "warc-revisits")[0].select("path", "records", "bytes"))


def read_archives(paths: DataFrame) -> DataFrame:
    """(record_id, record_type, target_uri, refers_to, payload_digest, payload_bytes, html) of every record of paths(path).

    html is null for a revisit. Headers, lengths and digests are checked; a wrong one raises an error that names the
    archive and the record's number. Records are read one frame at a time.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["record_id", "record_type", "target_uri", "refers_to", "payload_digest", "payload_bytes", "html"]
        kinds = [pa.string()] * 5 + [pa.int64(), pa.string()]
        for b in batches:
            for path in b.column(0).to_pylist():
                store, where = open_store(path)
                out, held = [], 0
                with store.open_input_stream(where, compression=None) as stream:
                    for n, raw in enumerate(read(stream)):
                        try:
                            got = parse(raw)
                        except ValueError as e:
                            raise ValueError(f"{path}, record {n}: {e}") from e
                        h = got["headers"]
                        text = None if got["payload"] is None else got["payload"].decode("utf-8", "surrogatepass")
                        out.append((h["warc-record-id"].strip("<>"), h["warc-type"], h.get("warc-target-uri"), h.get("warc-refers-to", "").strip("<>") or None, h["warc-payload-digest"].removeprefix("sha1:"), got["payload_bytes"], text))
                        held += len(raw)
                        if held > 4 << 20:
                            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names)
                            out, held = [], 0
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names)

    spread = paths.select("path").repartition(int(paths.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return spread.mapInArrow(run, "record_id string, record_type string, target_uri string, refers_to string, payload_digest string, payload_bytes long, html string")


def round_trip(spark: SparkSession, pages: DataFrame, **how) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to) as read back from the archives of pages."""
    back = read_archives(write_archives(pages, **how))
    page = lambda c: F.expr(f"try_cast(split_part({c}, ':', 3) as bigint)")
    return back.select(page("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", page("refers_to").alias("refers_to"))
