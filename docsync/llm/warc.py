"""WARC archives, dictionary-compressed: a record a page, read back by frames.

An archive is a Zstandard dictionary in a leading skippable frame, then one
frame a record, so any record can be read by its offset.  The dictionary is
built once from a bounded sample of the records to be archived; every archive
carries it, so none needs another file.

Payloads that occur twice or more and are large enough are written once, as the
response of the largest page id; the others become revisit records that refer to
it.  A revisit keeps the HTTP head, whose Content-Length tells the payload's size.

Each task writes its archives under names no other attempt uses, and hands the
names over in rows; only names that Spark has committed are read, so what a lost
attempt leaves behind is never seen.  Files go through ``pyarrow.fs``, which
takes the shared folder's own scheme.
"""

from __future__ import annotations

import base64
import hashlib
import io
import struct
import uuid
from collections.abc import Iterator

import pandas as pd
import pyarrow.fs
import zstandard
from pyspark.sql import DataFrame, functions as F

from docsync.llm.common import shared_folder, ship, uniform, written

#: Smaller payloads are never deduplicated.
LEAST_REVISIT = 1000
DICTIONARY_MAGIC = 0x184D2A5D
DICTIONARY_BYTES = 64 << 10
#: The dictionary's sample: so many records at most, of each so many characters.
SAMPLE_RECORDS = 1000
SAMPLE_CHARACTERS = 8192
LEVEL = 6
#: A new archive is begun past so many compressed bytes.
ARCHIVE_BYTES = 64 << 20
_HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {}\r\n\r\n"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_PAGE = "urn:page:"


def _file_system(uri: str) -> tuple[pyarrow.fs.FileSystem, str]:
    # Spark also writes a local path as file:/path or as the path alone.
    return pyarrow.fs.FileSystem.from_uri(uri if "://" in uri else "file://" + uri.removeprefix("file:"))


def _record(page_id, url: str | None, html: str | None, kind: str, refers_to) -> bytes:
    """A WARC record; ids and addresses go into headers without line breaks."""
    payload = (html or "").encode("utf-8", "surrogatepass")
    sha1 = base64.b32encode(hashlib.sha1(payload).digest()).decode()
    block = _HTTP.format(len(payload)).encode() + (payload if kind == "response" else b"")
    head = [
        "WARC/1.1",
        f"WARC-Type: {kind}",
        f"WARC-Record-ID: <{_PAGE}{'' if page_id is None or pd.isna(page_id) else int(page_id)}>",
        "WARC-Date: 1970-01-01T00:00:00Z",
        f"WARC-Target-URI: {(url or '').encode('ascii', 'backslashreplace').decode().translate({13: '%0D', 10: '%0A'})}",
        "Content-Type: application/http; msgtype=response",
        f"WARC-Payload-Digest: sha1:{sha1}",
    ]
    if kind == "revisit":
        head += [f"WARC-Profile: {_PROFILE}", f"WARC-Refers-To: <{_PAGE}{int(refers_to)}>"]
    head.append(f"Content-Length: {len(block)}")
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def train_dictionary(pages: DataFrame, html_column: str = "html") -> bytes:
    """A dictionary from the sample: of the different payloads with the least hashes, a
    piece of ``SAMPLE_CHARACTERS`` each from anywhere in them.  Too few or too alike to
    train on, they are themselves the dictionary's content; without records it is empty."""
    html = pages.select(F.coalesce(F.col(html_column), F.lit("")).alias("html")).where("html <> ''").withColumn("order", F.md5("html"))
    different = html.select("order").distinct().count()
    if not different:
        return b""
    start = 1 + F.floor(uniform("piece", F.col("order")) * F.greatest(F.length("html") - SAMPLE_CHARACTERS + 1, F.lit(1)))
    pieces = html.select("order", F.substring("html", start.cast("int"), F.lit(SAMPLE_CHARACTERS)).alias("html"), uniform(F.col("order")).alias("drawn"))
    # Payloads with small hashes, about twice as many as wanted: tasks find few, the driver gets few.
    share, sample = 2.0 * SAMPLE_RECORDS / different, []
    while len(sample) < min(SAMPLE_RECORDS, different):
        sample = pieces.where(F.col("drawn") < share).groupBy("order").agg(F.min("html").alias("html")).orderBy("order").limit(SAMPLE_RECORDS).collect()
        share *= 2
    records = [_record(0, "", row.html, "response", None) for row in sample]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, records).as_bytes()
    except (zstandard.ZstdError, ValueError):
        return b"".join(records)[:DICTIONARY_BYTES]


def _as_dictionary(content: bytes) -> zstandard.ZstdCompressionDict | None:
    return zstandard.ZstdCompressionDict(content) if content else None


def read_archive(uri: str) -> Iterator[tuple[dict[str, str], dict[str, str], bytes]]:
    """(WARC headers, HTTP headers, payload) of each record, one in memory at a time."""
    system, path = _file_system(uri)
    with system.open_input_stream(path, compression=None) as file:
        head = file.read(8)
        if len(head) < 8:
            return
        magic, size = struct.unpack("<II", head)
        if magic != DICTIONARY_MAGIC:
            raise ValueError(f"{uri} does not begin with a dictionary")
        dictionary = _as_dictionary(file.read(size))
        reader = io.BufferedReader(zstandard.ZstdDecompressor(dict_data=dictionary).stream_reader(file, read_across_frames=True), 1 << 16)
        while line := reader.readline():
            if line.strip() != b"WARC/1.1":
                raise ValueError(f"{uri}: a record was expected, not {line[:40]!r}")
            headers = _headers(reader)
            block = io.BytesIO(reader.read(int(headers["Content-Length"])))
            block.readline()
            http = _headers(block)
            if reader.read(4) != b"\r\n\r\n":
                raise ValueError(f"{uri}: a record is cut short")
            yield headers, http, block.read()


def _headers(stream) -> dict[str, str]:
    out = {}
    while line := stream.readline().rstrip(b"\r\n"):
        name, _, value = line.decode().partition(":")
        out[name] = value.strip()
    return out


class _Archive:
    """One file being written; a name of its own."""

    def __init__(self, folder: str, dictionary: bytes):
        self.uri, self.size, self.records = f"{folder}/{uuid.uuid4().hex}.warc.zst", 0, 0
        system, path = _file_system(self.uri)
        system.create_dir(path.rpartition("/")[0], recursive=True)
        self.file = system.open_output_stream(path, compression=None)  # the name alone would compress it once more
        self.compress = zstandard.ZstdCompressor(level=LEVEL, dict_data=_as_dictionary(dictionary), write_checksum=True).compress
        self.file.write(struct.pack("<II", DICTIONARY_MAGIC, len(dictionary)) + dictionary)

    def write(self, record: bytes) -> None:
        self.size += self.file.write(self.compress(record)) or 0
        self.records += 1


def write_archives(
    pages: DataFrame, folder: str, id_column: str = "page_id", url_column: str = "url", html_column: str = "html"
) -> DataFrame:
    """Write every row as a record; (archive, records) a file.

    A null text is the empty payload, a null url the empty one.  Rows repeated with the
    largest id of their payload are all responses.  A null id is never the largest; if all
    ids of a payload are null, all are responses.  No rows write no archives.
    """
    ship(pages.sparkSession)
    rows = pages.select(F.col(id_column).cast("long").alias("page_id"), F.col(url_column).alias("url"), F.col(html_column).alias("html"))
    sized = rows.where(F.octet_length("html") >= LEAST_REVISIT).select("page_id", F.sha1("html").alias("digest"))
    # Written, so that Spark may split the rows of a payload that very many share.
    repeated = written(
        sized.groupBy("digest").agg(F.max("page_id").alias("keeper"), F.count("*").alias("n")).where("n > 1 AND keeper IS NOT NULL").select("digest", "keeper"),
        "payloads",
    )
    named = rows.withColumn("digest", F.when(F.octet_length("html") >= LEAST_REVISIT, F.sha1("html"))).join(repeated, "digest", "left")
    revisit = F.col("keeper").isNotNull() & (F.col("page_id").isNull() | (F.col("page_id") < F.col("keeper")))
    typed = named.select("page_id", "url", "html", F.when(revisit, F.col("keeper")).alias("refers_to"))
    dictionary = train_dictionary(pages, html_column)

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        archive = None
        for batch in batches:
            for page_id, url, html, refers in zip(batch["page_id"], batch["url"], batch["html"], batch["refers_to"]):
                archive = archive or _Archive(folder, dictionary)
                kind = "response" if pd.isna(refers) else "revisit"
                archive.write(_record(page_id, url, html, kind, refers))
                if archive.size >= ARCHIVE_BYTES:
                    archive.file.close()
                    yield pd.DataFrame({"archive": [archive.uri], "records": [archive.records]})
                    archive = None
        if archive:
            archive.file.close()
            yield pd.DataFrame({"archive": [archive.uri], "records": [archive.records]})

    text = lambda c: F.col(c).cast("string").alias(c)  # noqa: E731  ids as text: 64 bits would not pass a null in pandas
    return written(typed.select(text("page_id"), "url", "html", text("refers_to")).mapInPandas(write, "archive string, records long"), "manifest")


def _page(header: str | None) -> str | None:
    name = (header or "").strip("<>").removeprefix(_PAGE)
    return name or None


def read_archives(archives: DataFrame) -> DataFrame:
    """(page_id, url, record_type, payload_bytes, payload_digest, refers_to) of every
    record; a response whose payload does not have the digest it claims is an error."""

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for uri in batch["archive"]:
                held = []
                for headers, http, payload in read_archive(uri):
                    digest = base64.b32decode(headers["WARC-Payload-Digest"].removeprefix("sha1:")).hex()
                    size = int(http["Content-Length"])
                    kind = headers["WARC-Type"]
                    if kind == "response" and (len(payload) != size or hashlib.sha1(payload).hexdigest() != digest):
                        raise ValueError(f"{uri}: {headers['WARC-Record-ID']} is damaged")
                    held.append((_page(headers["WARC-Record-ID"]), headers["WARC-Target-URI"], kind, size, digest, _page(headers.get("WARC-Refers-To"))))
                    if len(held) == 5000:
                        yield pd.DataFrame(held, columns=_READ)
                        held = []
                if held:
                    yield pd.DataFrame(held, columns=_READ)

    ship(archives.sparkSession)
    # An archive a task: names are few and dealt out before any is opened.
    dealt = archives.select("archive").repartition(F.col("archive"))
    schema = "page_id string, url string, record_type string, payload_bytes long, payload_digest string, refers_to string"
    return dealt.mapInPandas(read, schema).withColumns({c: F.col(c).cast("long") for c in ("page_id", "refers_to")})


_READ = ["page_id", "url", "record_type", "payload_bytes", "payload_digest", "refers_to"]


def round_trip(pages: DataFrame, folder: str | None = None) -> DataFrame:
    """Archive all pages and read them back."""
    return read_archives(write_archives(pages, folder or shared_folder(pages.sparkSession, "archives")))


def digest(records: DataFrame) -> DataFrame:
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
