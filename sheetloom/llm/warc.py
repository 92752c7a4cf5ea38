"""WARC archives: a deterministic sharded writer, and a reader.

Pages are range-sorted by id into shards. The bounds come from ids chosen by their hash, so they depend on the pages
alone, not on partitions or on the cluster. Each shard is written as gzip members, one a record, into files that end once they
exceed ``roll_bytes`` compressed. Headers, record ids, dates and digests are made anew from the page alone, so a task that runs twice writes the same bytes.
A file is written under a temporary name and moved to its own when complete; the manifest, a table
with every file's size and digest, is written last, and readers open only what it lists.

Of pages with equal payloads of at least ``min_payload`` bytes the one with the smallest id is a response, others are revisits
that refer to it. Which ones is found on ids and digests alone, and this travels to the writer beside the
pages, so payloads are shuffled once.

Null payloads are empty, null addresses leave out their header. Null ids are responses. Of repeated rows of one id the first is the response.
An empty table gives an archive without files. Files are opened with ``pyarrow.fs``, so the folder can be in any store it knows
(local or shared disk, HDFS, S3, GCS). Only id, address and payload columns are read.
"""

import base64
import gzip
import hashlib
import io
import re
import uuid

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MIN_PAYLOAD = 0
SHARD_BYTES = 16 << 20  # payload bytes of a shard; for 100 TB a gigabyte is a good size
ROLL_BYTES = 8 << 20
READ_BYTES = 32 << 20  # compressed bytes that a reading task takes, or one file
DATE = "2026-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
MANIFEST = "file string, shard long, number int, records long, bytes long, sha256 string"
_SPACE = 64  # ids looked at for each bound


def _store(folder: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(re.sub(r"^file:/(?!/)", "file:///", folder))


def digest_of(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _record(kind: str, headers: list[tuple[str, object]], block: bytes) -> bytes:
    lines = [("WARC-Type", kind), *headers, ("WARC-Block-Digest", f"sha1:{digest_of(block)}"), ("Content-Length", len(block))]
    head = "WARC/1.1\r\n" + "".join(f"{name}: {value}\r\n" for name, value in lines) + "\r\n"
    return head.encode("utf-8", "surrogatepass") + block + b"\r\n\r\n"


def record_id(page, digest: str, number: int = 0) -> str:
    return f"<{uuid.uuid5(uuid.NAMESPACE_URL, f'{page}/{digest}/{number}').urn}>"


def page_record(page, url: str | None, payload: bytes, digest: str, refers_to, number: int) -> bytes:
    """``number`` tells apart repeated rows of one page; ``refers_to`` is the response's page for a revisit."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    headers = [("WARC-Record-ID", record_id(page, digest, number)), ("WARC-Date", DATE)]
    if url is not None:
        headers.append(("WARC-Target-URI", re.sub(r"[\x00-\x20\x7f\x85  %]", lambda m: "".join(f"%{b:02X}" for b in m[0].encode()), url)))
    headers += [("WARC-Payload-Digest", f"sha1:{digest}"), ("Content-Type", "application/http;msgtype=response"), ("Page-Id", "" if page is None else page)]
    if refers_to is None:
        return _record("response", headers, http + payload)
    headers += [("WARC-Profile", PROFILE), ("WARC-Refers-To", record_id(refers_to, digest)), ("Refers-To-Page-Id", refers_to)]
    return _record("revisit", headers, http)


class ShardWriter:
    """The files of one shard, rolled by compressed size."""

    def __init__(self, folder: str, shard: int, roll_bytes: int):
        self.store, self.path = _store(folder)
        self.shard, self.roll_bytes, self.number = shard, roll_bytes, 0
        self.stream = None

    def add(self, record: bytes):
        """The manifest row of a file, if this record ended one."""
        if self.stream is None:
            self.name = f"shard-{self.shard:08d}-{self.number:05d}.warc.gz"
            self.temporary = f"{self.path}/_temporary/{uuid.uuid4().hex}"
            self.store.create_dir(f"{self.path}/_temporary", recursive=True)
            self.stream = self.store.open_output_stream(self.temporary, compression=None)
            self.bytes, self.records, self.sum = 0, 0, hashlib.sha256()
            self._put(_record("warcinfo", [("WARC-Record-ID", record_id(self.name, "")), ("WARC-Date", DATE), ("WARC-Filename", self.name), ("Content-Type", "application/warc-fields")], b"format: WARC File Format 1.1\r\n"))
        self._put(record)
        self.records += 1
        return self.close() if self.bytes >= self.roll_bytes else None

    def _put(self, record: bytes):
        member = gzip.compress(record, 6, mtime=0)
        self.stream.write(member)
        self.sum.update(member)
        self.bytes += len(member)

    def close(self):
        if self.stream is None:
            return None
        self.stream.close()
        self.stream = None
        self.store.create_dir(f"{self.path}/data", recursive=True)
        final = f"{self.path}/data/{self.name}"
        try:
            self.store.move(self.temporary, final)
        except OSError:  # some stores don't replace; another run of this task has written the same bytes
            if self.store.get_file_info(final).size != self.bytes:
                raise
            self.store.delete_file(self.temporary)
        self.number += 1
        return self.name, self.shard, self.number - 1, self.records, self.bytes, self.sum.hexdigest()


def write_archive(pages: DataFrame, folder: str, key: str = "page_id", url: str = "url", payload: str = "html", min_payload: int = MIN_PAYLOAD, shard_bytes: int = SHARD_BYTES, roll_bytes: int = ROLL_BYTES) -> DataFrame:
    """Write ``pages`` below ``folder`` and return the manifest, which is stored there too."""
    rows = pages.select(F.col(key).cast("long").alias("page"), F.col(url).cast("string").alias("url"), F.encode(F.coalesce(F.col(payload).cast("string"), F.lit("")), "UTF-8").alias("payload"))
    keys = rows.select("page", F.octet_length("payload").alias("size"), F.sha1("payload").alias("digest"))
    alike = keys.filter((F.col("size") >= min_payload) & F.col("page").isNotNull())
    firsts = alike.groupBy("digest").agg(F.min("page").alias("first"), F.count("*").alias("n")).filter("n > 1").drop("n")
    revisits = alike.join(firsts, "digest").select("page", "digest", "first").distinct()

    total = keys.agg(F.count("*").alias("n"), F.coalesce(F.sum("size"), F.lit(0)).alias("size")).first()
    shards = max(1, -(-total["size"] // shard_bytes))
    looked = max(1, total["n"] // (shards * _SPACE))
    ids = np.array(sorted(r["page"] for r in keys.filter(F.col("page").isNotNull() & (F.pmod(F.xxhash64("page"), F.lit(looked)) == 0)).select("page").collect()), np.int64)
    bounds = ids[[len(ids) * k // shards for k in range(1, shards)]] if len(ids) else ids

    @F.pandas_udf("long")
    def shard_of(found: pd.Series) -> pd.Series:
        known = found.notna().to_numpy()
        out = np.zeros(len(found), np.int64)
        out[known] = np.searchsorted(bounds, found[known].to_numpy(np.int64), "right")
        return pd.Series(out)

    none = F.lit(None)
    told = revisits.select("page", F.lit(0).alias("kind"), none.cast("string").alias("url"), none.cast("binary").alias("payload"), "digest", "first")
    shown = rows.select("page", F.lit(1).alias("kind"), "url", "payload", none.cast("string").alias("digest"), none.cast("long").alias("first"))
    dealt = told.union(shown).withColumn("shard", shard_of("page"))
    dealt = dealt.repartition("shard").sortWithinPartitions("shard", "page", "kind", "url", "payload")

    def write(frames):
        writer, page, refers, numbers = None, None, {}, {}
        for frame in frames:
            done = []
            for now, kind, address, content, hexed, first, shard in zip(*(frame[c] for c in ("page", "kind", "url", "payload", "digest", "first", "shard"))):
                now = None if pd.isna(now) else int(now)
                if writer is None or shard != writer.shard:
                    done += [writer.close()] if writer else []
                    writer = ShardWriter(folder, int(shard), roll_bytes)
                if now != page or now is None:
                    page, refers, numbers = now, {}, {} if now is not None else numbers
                if kind == 0:
                    refers[hexed] = int(first)
                    continue
                digest = digest_of(content)
                number = numbers[digest] = numbers.get(digest, -1) + 1
                refers_to = refers.get(base64.b32decode(digest).hex())
                if refers_to == page and number == 0:
                    refers_to = None
                done.append(writer.add(page_record(page, address, content, digest, refers_to, number)))
            yield pd.DataFrame([d for d in done if d], columns=["file", "shard", "number", "records", "bytes", "sha256"])
        if writer and (last := writer.close()):
            yield pd.DataFrame([last], columns=["file", "shard", "number", "records", "bytes", "sha256"])

    dealt.mapInPandas(write, MANIFEST).write.parquet(f"{folder}/manifest")
    return pages.sparkSession.read.schema(MANIFEST).parquet(f"{folder}/manifest")


def _members(stream):
    """Headers and block of each record of an uncompressed stream."""
    while line := stream.readline():
        if not line.strip():
            continue
        headers = {}
        while (line := stream.readline().rstrip(b"\r\n")):
            name, _, value = line.partition(b":")
            headers[name.decode().lower()] = value.strip().decode("utf-8", "surrogatepass")
        yield headers, stream.read(int(headers["content-length"]))


def read_archive(spark: SparkSession, folder: str, task_bytes: int = READ_BYTES) -> DataFrame:
    """``(page_id, url, payload_bytes, payload_digest, record_type, refers_to, payload)`` of every page record; files and records that don't match their digests raise."""
    schema = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, payload string"

    def read(frames):
        store, path = _store(folder)
        for frame in frames:
            for name, size, digest in zip(frame["file"], frame["bytes"], frame["sha256"]):
                with store.open_input_stream(f"{path}/data/{name}", compression=None) as file:
                    packed = file.read()
                if len(packed) != size or hashlib.sha256(packed).hexdigest() != digest:
                    raise ValueError(f"{name} is not what the manifest lists")
                out = []
                for headers, block in _members(io.BufferedReader(gzip.GzipFile(fileobj=io.BytesIO(packed)))):
                    if headers["warc-block-digest"] != f"sha1:{digest_of(block)}":
                        raise ValueError(f"a record of {name} is damaged")
                    kind = headers["warc-type"]
                    if kind not in ("response", "revisit"):
                        continue
                    head, _, payload = block.partition(b"\r\n\r\n")
                    length = int(re.search(rb"(?i)\r\ncontent-length: *(\d+)", head)[1])
                    stated = headers["warc-payload-digest"].removeprefix("sha1:")
                    if kind == "response" and (len(payload) != length or digest_of(payload) != stated):
                        raise ValueError(f"a payload in {name} is damaged")
                    page, refers = headers["page-id"], headers.get("refers-to-page-id")
                    address = headers.get("warc-target-uri")
                    address = address if address is None else re.sub(r"(?:%[0-9A-F]{2})+", lambda m: bytes.fromhex(m[0].replace("%", "")).decode(), address)
                    out.append((int(page) if page else None, address, length, stated, kind, int(refers) if refers else None, payload.decode() if kind == "response" else None))
                yield pd.DataFrame(out, columns=["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to", "payload"]).astype({"page_id": "Int64", "refers_to": "Int64"})

    manifest = spark.read.schema(MANIFEST).parquet(f"{folder}/manifest")
    # A count, as adaptive execution would put the few bytes of names into one task, however much they stand for.
    total = manifest.agg(F.count("*").alias("files"), F.coalesce(F.sum("bytes"), F.lit(0)).alias("bytes")).first()
    tasks = max(1, min(total["files"], max(spark.sparkContext.defaultParallelism, -(-total["bytes"] // task_bytes))))
    return manifest.select("file", "bytes", "sha256").repartitionByRange(tasks, "file").mapInPandas(read, schema)
