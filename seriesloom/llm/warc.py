"""WARC archives compressed with Zstandard: one frame per record, the dictionary in a leading skippable frame.

Layout of a file: a skippable frame (magic 0x184D2A5D, length, dictionary, itself compressed) and then one frame for each
record, compressed with that dictionary. Any frame can be decoded alone once the dictionary is known.
"""

from __future__ import annotations

import hashlib
import io
import struct
from collections.abc import Iterator
from datetime import datetime, timezone

import pyarrow as pa
import pyarrow.fs as pafs
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from seriesloom.llm.common import written

# Fixed values of the formats.
DICTIONARY_MAGIC = 0x184D2A5D
FRAME_MAGIC = b"\x28\xb5\x2f\xfd"
VERSION = b"WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

#: Bytes read from an archive at once.
PIECE = 65_536
#: Payloads from this size on are stored once.
LEAST_SHARED = 100
#: Rows and bytes of the sample that the dictionary is made from, and its size.
SAMPLE_ROWS, SAMPLE_BYTES, DICTIONARY_BYTES = 400, 16_384, 65_536
#: Compressed bytes after which a task starts another file.
FILE_BYTES = 256 * 2**20
#: Copies of each row of repeated digests, so that rows of a hot digest go to as many tasks.
SALTS = 32

RECORD = (
    "file string, page_id bigint, url string, record_type string, refers_to bigint, payload_digest string, "
    "payload binary, error string"
)


class Malformed(ValueError):
    """An archive that breaks the format."""


# -- one record ------------------------------------------------------------------------------


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, when: str) -> bytes:
    """A response record with its payload, or a revisit record without one."""
    revisit = refers_to is not None
    uri = "".join(c for c in url or "" if c > " ") or f"urn:page:{page_id}"
    lines = [
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>",
        f"WARC-Date: {when}",
        f"WARC-Target-URI: {uri}",
        f"WARC-Payload-Digest: sha256:{digest}",
    ]
    if revisit:
        lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <urn:page:{refers_to}>"]
    head = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
    block = head + (b"" if revisit else payload)
    lines += ["Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}"]
    return VERSION + b"\r\n" + "\r\n".join(lines).encode("utf-8", "surrogatepass") + b"\r\n\r\n" + block + b"\r\n\r\n"


def _page(value: str | None) -> int | None:
    if value is None:
        return None
    if not (value.startswith("<urn:page:") and value.endswith(">")):
        raise Malformed(f"record id {value!r}")
    return int(value[10:-1]) if value != "<urn:page:>" else None


def parse(raw: bytes) -> tuple:
    """(page_id, url, type, refers_to, digest, payload) of one decoded frame; Malformed if it is not one whole record."""
    if not raw.startswith(VERSION + b"\r\n"):
        raise Malformed("no version line")
    end = raw.find(b"\r\n\r\n")
    if end < 0:
        raise Malformed("headers do not end")
    fields: dict[str, str] = {}
    for line in raw[len(VERSION) + 2 : end].decode("utf-8", "surrogatepass").split("\r\n"):
        name, colon, value = line.partition(":")
        if not colon or name.strip() != name or not name:
            raise Malformed(f"header line {line[:80]!r}")
        if name.lower() in fields:
            raise Malformed(f"header {name} twice")
        fields[name.lower()] = value.strip()
    for name in ("warc-type", "warc-record-id", "warc-date", "content-length", "warc-payload-digest", "warc-target-uri"):
        if name not in fields:
            raise Malformed(f"no {name}")
    kind, size = fields["warc-type"], fields["content-length"]
    if kind not in ("response", "revisit"):
        raise Malformed(f"type {kind}")
    if not size.isdigit() or end + 4 + int(size) + 4 != len(raw) or raw[-4:] != b"\r\n\r\n":
        raise Malformed("the length does not fit the frame")
    block = raw[end + 4 : -4]
    head = block.find(b"\r\n\r\n")
    if not block.startswith(b"HTTP/") or head < 0:
        raise Malformed("no HTTP head")
    digest, payload, refers = fields["warc-payload-digest"], block[head + 4 :], _page(fields.get("warc-refers-to"))
    if not digest.startswith("sha256:") or len(digest) != 71:
        raise Malformed("digest form")
    if kind == "response":
        if hashlib.sha256(payload).hexdigest() != digest[7:]:
            raise Malformed("the digest does not fit the payload")
    elif payload or refers is None or fields.get("warc-profile") != PROFILE:
        raise Malformed("a revisit holds a payload or does not say what it refers to")
    return _page(fields["warc-record-id"]), fields["warc-target-uri"], kind, refers, digest[7:], payload if kind == "response" else None


# -- one file --------------------------------------------------------------------------------


def header(dictionary: bytes) -> bytes:
    packed = zstandard.ZstdCompressor(level=9).compress(dictionary) if dictionary else b""
    return struct.pack("<II", DICTIONARY_MAGIC, len(packed)) + packed


def frames(data) -> Iterator[bytes]:
    """The decoded frames of an archive, given as bytes or an open binary stream. The dictionary may be compressed, raw or absent.

    The stream is read in pieces: what is held is one piece and one record, whatever the size of the file.
    """
    source = io.BytesIO(data) if isinstance(data, bytes) else data
    held, dictionary = source.read(8), None
    if len(held) == 8 and struct.unpack("<I", held[:4])[0] == DICTIONARY_MAGIC:
        size = struct.unpack("<I", held[4:])[0]
        raw, held = source.read(size), b""
        if len(raw) != size:
            raise Malformed("the dictionary is cut off")
        if raw[:4] == FRAME_MAGIC:
            raw = zstandard.ZstdDecompressor().decompress(raw)
        dictionary = zstandard.ZstdCompressionDict(raw) if raw else None
    decoder = zstandard.ZstdDecompressor(dict_data=dictionary) if dictionary else zstandard.ZstdDecompressor()
    while held := held if len(held) >= 4 else held + source.read(PIECE):
        if held[:4] != FRAME_MAGIC:
            raise Malformed(f"no frame where one should start: {held[:4]!r}")
        one, parts = decoder.decompressobj(), []
        try:
            while not one.eof:
                held = held or source.read(PIECE)
                if not held:
                    raise Malformed("the last frame is cut off")
                parts.append(one.decompress(held))
                held = one.unused_data
        except zstandard.ZstdError as e:
            raise Malformed(str(e)) from e
        yield b"".join(parts)


def _uri(path: str) -> str:
    """The path under the scheme that Arrow knows: s3a and s3n are Spark's names of s3, a plain path is a file."""
    scheme, colon, rest = path.partition(":/")
    if not colon:
        return f"file://{path}"
    return f"s3:/{rest}" if scheme in ("s3a", "s3n") else path


def _filesystem(path: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(_uri(path)) if ":/" in path else (pafs.LocalFileSystem(), path)


# -- tables ----------------------------------------------------------------------------------


def train(pages: DataFrame, html: str = "html", rows: int = SAMPLE_ROWS, size: int = DICTIONARY_BYTES) -> bytes:
    """A dictionary from at most ``rows`` pages, the first SAMPLE_BYTES signs of each; none where they are too few to train on."""
    sample = pages.where(F.length(html) > 0).select(F.substring(html, 1, SAMPLE_BYTES).alias("t")).limit(rows).collect()
    try:
        return zstandard.train_dictionary(size, [r.t.encode("utf-8", "surrogatepass") for r in sample]).as_bytes() if len(sample) >= 20 else b""
    except zstandard.ZstdError:
        return b""


def planned(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """Each page with its payload, digest and the page it revisits (null: it is a response).

    Digests found more than once are few beside the pages; they are joined back with a salt, so a hot one is spread.
    """
    p = pages.select(pages[page_id].cast("bigint").alias("page_id"), pages[url].alias("url"), F.coalesce(pages[html], F.lit("")).alias("html"))
    p = p.withColumn("digest", F.sha2("html", 256)).withColumn("shared", F.octet_length("html") >= LEAST_SHARED)
    repeated = (
        p.where("shared").groupBy("digest").agg(F.min("page_id").alias("first_id"), F.count("*").alias("n"))
        .where("n > 1 AND first_id IS NOT NULL")
        .select(F.col("digest").alias("digest_of"), "first_id", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt_of"))
    )
    salt = F.pmod(F.xxhash64("page_id"), F.lit(SALTS)).cast("int")
    joined = p.withColumn("salt", salt).join(repeated, (F.col("digest") == F.col("digest_of")) & (F.col("salt") == F.col("salt_of")) & F.col("shared"), "left")
    return joined.select("page_id", "url", "html", "digest", F.when(F.coalesce(F.col("page_id"), F.col("first_id") - 1) != F.col("first_id"), F.col("first_id")).alias("refers_to"))


def write(pages: DataFrame, folder: str, page_id: str = "page_id", url: str = "url", html: str = "html", level: int = 3, file_bytes: int = FILE_BYTES) -> str:
    """Archive every row below ``folder``, files of about ``file_bytes``, at least one for each task, and return the folder.

    Of rows with equal payloads of at least LEAST_SHARED bytes the one with the smallest page_id is a response and the others revisit
    it; rows that share that smallest id (repeated rows) are all responses. A null page_id gets an empty id and counts as larger
    than any; where a group has only null ids, all are responses. Null html is an empty payload, null url an urn of the page.
    The table ``_files`` below the folder names the files of the attempts that Spark committed: a task that runs again writes files of
    its own, and those of the lost attempt are not listed. Other columns are not read.
    """
    spark = pages.sparkSession
    dictionary = spark.sparkContext.broadcast(train(pages, html))
    when = datetime.now(timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task = TaskContext.get()
        fs, base = _filesystem(folder)
        fs.create_dir(base, recursive=True)
        raw = dictionary.value
        shared = zstandard.ZstdCompressionDict(raw) if raw else None
        encoder = zstandard.ZstdCompressor(level=level, dict_data=shared, write_checksum=True) if shared else zstandard.ZstdCompressor(level=level, write_checksum=True)
        records = (
            encoder.compress(record(page, address, text.encode("utf-8", "surrogatepass"), digest, refers, when))
            for b in batches for page, address, text, digest, refers in zip(*(b.column(i).to_pylist() for i in range(5)))
        )
        found, n, frame = [], [], next(records, None)
        while frame is not None or not found:
            name = f"part-{task.partitionId():06d}-{task.taskAttemptId()}-{len(found):04d}.warc.zst"
            rows = 0
            with fs.open_output_stream(f"{base}/{name}", compression=None) as out:
                size = out.write(header(raw))
                while frame is not None and size < file_bytes:
                    size, rows, frame = size + out.write(frame), rows + 1, next(records, None)
            found.append(name)
            n.append(rows)
        yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(n, pa.int64())], ["file", "n"])

    files = planned(pages, page_id, url, html).mapInArrow(run, "file string, n bigint")
    files.write.mode("overwrite").parquet(f"{folder}/_files")
    return folder


def archives(spark: SparkSession, folder: str) -> DataFrame:
    """The paths of the archives of a folder, spread over tasks: those that ``write`` lists, else every .warc.zst below it."""
    fs, base = _filesystem(folder)
    if fs.get_file_info(f"{base}/_files").type == pafs.FileType.NotFound:
        return spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.zst").load(folder).select("path")
    # A few small rows a task; the partitions are as many as the files, so that no task gets many of them.
    listed = spark.read.schema("file string, n bigint").parquet(f"{folder}/_files").where("n > 0")
    return listed.select(F.concat(F.lit(f"{folder}/"), "file").alias("path")).repartition(max(1, listed.count()), "path")


def read(spark: SparkSession, folder: str, errors: str = "raise") -> DataFrame:
    """The records of all archives below ``folder``: file, page_id, url, record_type, refers_to, payload_digest, payload, error.

    Each frame must be one record with whole headers, a fitting length and digest. ``errors="raise"`` ends the query at the first fault;
    ``"flag"`` gives one row with the fault and goes on with the next record, or the next file where the frames themselves are broken.
    Archives are read as streams, so their size is not bounded. A folder without archives gives no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [c.split()[0] for c in RECORD.split(", ")]
        kinds = [pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.binary(), pa.string()]

        def flush(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

        for path in (p for b in batches for p in b.column(0).to_pylist()):
            rows, held = [], 0
            fs, place = _filesystem(path)
            with fs.open_input_stream(place, compression=None) as stream:
                found = frames(stream)
                while True:
                    try:
                        raw = next(found)
                    except StopIteration:
                        break
                    except Malformed as e:
                        if errors == "raise":
                            raise
                        rows.append((path, *[None] * 6, str(e)))
                        break
                    try:
                        rows.append((path, *parse(raw), None))
                    except Malformed as e:
                        if errors == "raise":
                            raise
                        rows.append((path, *[None] * 6, str(e)))
                    held += len(raw)
                    if held > 8_000_000:
                        yield flush(rows)
                        rows, held = [], 0
            if rows:
                yield flush(rows)

    return archives(spark, folder).mapInArrow(run, RECORD)


def resolved(records: DataFrame) -> DataFrame:
    """Records with payload_bytes of the full payload: a revisit takes it from the response that it refers to.

    Raises where that response is missing or has another digest. Records with an error have none. The archives are read once: what is
    needed of a record, without its payload, is written and serves revisits, targets and responses.
    """
    slim = written(records.select("page_id", "url", "record_type", "refers_to", "payload_digest", F.octet_length("payload").cast("bigint").alias("own_bytes")))
    wanted = slim.where("refers_to IS NOT NULL").select(F.col("refers_to").alias("wanted_id")).distinct()
    targets = (
        slim.where("record_type = 'response'").join(wanted, F.col("page_id") == F.col("wanted_id"), "left_semi")
        .groupBy(F.col("page_id").alias("target_id"), F.col("payload_digest").alias("target_digest")).agg(F.min("own_bytes").alias("target_bytes"))
        .withColumn("target_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    )
    salt = F.pmod(F.xxhash64("page_id"), F.lit(SALTS)).cast("int")
    joined = slim.withColumn("salt", salt).join(
        targets, (F.col("refers_to") == F.col("target_id")) & (F.col("payload_digest") == F.col("target_digest")) & (F.col("salt") == F.col("target_salt")), "left"
    )
    missing = F.raise_error(F.concat(F.lit("no response for revisit "), F.col("page_id").cast("string")))
    size: Column = F.when(F.coalesce(F.col("record_type"), F.lit("response")) == "response", F.col("own_bytes")).otherwise(F.coalesce("target_bytes", missing.cast("bigint")))
    return joined.select("page_id", "url", "record_type", "refers_to", "payload_digest", size.alias("payload_bytes"))
