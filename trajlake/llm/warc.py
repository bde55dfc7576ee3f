"""WARC archives compressed with Zstandard: one frame per record, the dictionary in a leading skippable frame.

``write`` gives every page a record. Of pages with equal payloads the one with the smallest id (then
URL) is a response with the payload; the others are revisits, which hold its HTTP header alone and name the response.
Groups are found on digests, ids and URLs only, pre-aggregated by row before they meet by digest; pages are then joined with the
groups of more than one. If these are few they are copied to every task, otherwise payloads are shuffled once by digest,
except for groups of over a thousandth of all rows, at most a thousand, which are copied. Each task writes archives of
bounded size into the shared folder under names of its own; only those in the manifest count, so lost tasks may run again.

``read`` streams archives, one a task at a time, and never holds more than a record. The frame's end is found from its
block headers, so a damaged frame costs one record and reading goes on after it. The dictionary, plain or compressed itself,
comes from the leading skippable frame; other skippable frames are passed over. Checked are: that a frame decodes, holds one record
and nothing after it, the version line, the form of the fields, the mandatory ones, Content-Length against the bytes
there are, the HTTP header's length against the payload, and both digests. What is wrong is named in ``issue``; nothing raises.

Cases: a null payload is empty; a null id is the largest of a group; rows equal in id, URL and payload are one response and revisits of
it; payloads below ``least`` bytes are all responses; characters that a header may not hold are percent-encoded in a URL, and a null URL is
replaced by the record's id; an empty table writes no archive and reads as no record.
"""

from __future__ import annotations

import base64
import datetime
import hashlib
import re
import struct
import urllib.parse
import uuid
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trajlake.llm.workspace import shared_dir, written

#: Fixed values of the format: the magic numbers of a frame, of skippable frames, of the dictionary's and of a trained dictionary.
FRAME, SKIPPABLE, DICTIONARY_FRAME, TRAINED = 0xFD2FB528, range(0x184D2A50, 0x184D2A60), 0x184D2A5D, 0xEC30A437
#: Fixed values of the format: fields that every record has.
MANDATORY = ("WARC-Record-ID", "Content-Length", "WARC-Date", "WARC-Type")
#: An archive is closed when it has this many bytes.
ARCHIVE_BYTES = 64 << 20
#: Payload bytes and payloads from which an archive's dictionary is trained, and its size.
SAMPLE_BYTES, SAMPLES, DICTIONARY_BYTES = 1 << 20, 256, 16 << 10
#: Groups of equal payloads that may be copied to every task.
FEW_GROUPS = 500_000
MANIFEST = "uri string, records long, bytes long"
_CHUNK = 1 << 20
_FIELD = re.compile(rb"([!#$%&'*+\-.^_`|~0-9A-Za-z]+):[ \t]*([^\r\n]*)")


def digest(raw: bytes) -> str:
    """Upper-case base32 SHA-1."""
    return base64.b32encode(hashlib.sha1(raw).digest()).decode()


# --- writing


def groups(pages: DataFrame) -> DataFrame:
    """key, n, first_id, first_url and times (rows equal to the first) of payloads that occur more than once; pages: page_id, url, key."""
    rows = pages.groupBy("key", "page_id", "url").agg(F.count("*").alias("times"))
    order = F.struct(F.col("page_id").isNull().alias("none"), "page_id", F.col("url").isNull().alias("bare"), "url", "times")
    met = rows.groupBy("key").agg(F.sum("times").alias("n"), F.min(order).alias("first")).where("n > 1")
    return met.select("key", "n", F.col("first.page_id").alias("first_id"), F.col("first.url").alias("first_url"), F.col("first.times").alias("times"))


def _records(pages: DataFrame, least: int, few: int) -> DataFrame:
    """page_id, url, payload (null for a revisit), payload_bytes, sha1, grouped, first_id and first_url of each record to write."""
    large = F.octet_length("payload") >= least
    keyed = pages.withColumn("key", F.when(large, F.unhex(F.sha2("payload", 256))))
    twice = written(groups(keyed.where("key is not null").select("page_id", "url", "key")))
    if twice.count() <= few:
        placed = keyed.join(F.broadcast(twice), "key", "left")
    else:
        most = twice.where(F.col("n") * 1000 > keyed.count())  # at most a thousand groups
        some = keyed.join(F.broadcast(most), "key", "left")
        rest = twice.join(F.broadcast(most.select("key")), "key", "left_anti")
        placed = some.where("n is not null").unionByName(some.where("n is null").select(*keyed.columns).join(rest, "key", "left"), allowMissingColumns=True)
    first = F.col("page_id").eqNullSafe(F.col("first_id")) & F.col("url").eqNullSafe(F.col("first_url"))
    grouped = F.col("n").isNotNull()
    single = placed.where(~(grouped & first & (F.col("times") > 1)))
    columns = [F.octet_length("payload").cast("long").alias("payload_bytes"), F.when(grouped, F.sha1("payload")).alias("sha1"), grouped.alias("grouped"), "first_id", "first_url"]
    records = single.select("page_id", "url", F.when(~grouped | first, F.col("payload")).alias("payload"), *columns)
    again = twice.where("times > 1")
    if again.isEmpty():
        return records
    alike = placed.where(grouped & first & (F.col("times") > 1)).select("page_id", "url", "payload", *columns, "times", "key")
    own = alike.groupBy("key").agg(*[F.first(c).alias(c) for c in alike.columns if c != "key"])
    own = own.select(*records.columns, "times")
    thousands = own.select(*[F.lit(None).cast("string").alias(c) if c == "payload" else c for c in records.columns], "times", F.explode(F.sequence(F.lit(0).cast("long"), F.expr("(times - 2) div 10000"))).alias("at"))
    spread = thousands.repartition(200)
    copies = spread.select(*records.columns, F.explode(F.sequence(F.col("at") * 10000 + 2, F.least("times", F.col("at") * 10000 + 10001))).alias("copy"))
    return records.unionByName(own.select(*records.columns)).unionByName(copies.select(*records.columns))


def _uri(url: str | None, otherwise: str) -> str:
    return urllib.parse.quote(url, safe="%/:=&?~#+!$,;'@()*[]") if url else otherwise


def _named(page_id: int | None, tag: str) -> str:
    return f"urn:trajlake:page:{'none' if page_id is None else page_id}:{tag}"


def _tag(url: str | None, sha1: str) -> str:
    return hashlib.sha1(f"{sha1} {'' if url is None else 'u' + url}".encode()).hexdigest()[:24]


def record(kind: str, record_id: str, fields: dict[str, str], block: bytes) -> bytes:
    """A record with its fields, in the order given, after the mandatory ones."""
    own = {"WARC-Type": kind, "WARC-Record-ID": f"<{record_id}>", **fields, "WARC-Block-Digest": f"sha1:{digest(block)}", "Content-Length": str(len(block))}
    return b"WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in own.items()).encode() + b"\r\n" + block + b"\r\n\r\n"


def page_record(row: dict, date: str) -> bytes:
    """The record of one row of ``_records``."""
    response = row["payload"] is not None
    payload = row["payload"].encode() if response else b""
    sha1 = hashlib.sha1(payload).hexdigest() if response else row["sha1"]
    name = _named(row["page_id"], _tag(row["url"], sha1) if response and row["grouped"] else uuid.uuid4().hex)
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {row['payload_bytes']}\r\n\r\n".encode()
    fields = {"WARC-Target-URI": _uri(row["url"], name), "WARC-Date": date, "Content-Type": "application/http; msgtype=response", "WARC-Payload-Digest": "sha1:" + base64.b32encode(bytes.fromhex(sha1)).decode()}
    if not response:
        fields |= {"WARC-Profile": "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", "WARC-Refers-To": f"<{_named(row['first_id'], _tag(row['first_url'], sha1))}>", "WARC-Refers-To-Target-URI": _uri(row["first_url"], name)}
    return record("response" if response else "revisit", name, fields, http + payload)


def dictionary(samples: list[bytes]) -> zstandard.ZstdCompressionDict:
    """Trained on the samples; if they are too few or too alike, their bytes themselves."""
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples, k=256, d=8)
    except zstandard.ZstdError:
        return zstandard.ZstdCompressionDict(b"".join(samples)[:DICTIONARY_BYTES].ljust(8, b"\0"), dict_type=zstandard.DICT_TYPE_RAWCONTENT)


class _Archive:
    """An open archive: its dictionary frame, then one frame per record."""

    def __init__(self, store: fs.FileSystem, folder: str, uri: str, samples: list[bytes]):
        name = f"{uuid.uuid4().hex}.warc.zst"
        self.uri, self.out, self.records, self.bytes = f"{uri}/{name}", store.open_output_stream(f"{folder}/{name}"), 0, 0
        own = dictionary(samples)
        plain = zstandard.ZstdCompressor(level=9).compress(own.as_bytes())
        self.frames = zstandard.ZstdCompressor(level=3, dict_data=own, write_content_size=True, write_checksum=True)
        self._put(struct.pack("<II", DICTIONARY_FRAME, len(plain)) + plain)

    def _put(self, raw: bytes) -> None:
        self.out.write(raw)
        self.bytes += len(raw)

    def add(self, raw: bytes) -> None:
        self._put(self.frames.compress(raw))
        self.records += 1

    def close(self) -> tuple[str, int, int]:
        self.out.close()
        return self.uri, self.records, self.bytes


def write(df: DataFrame, path: str | None = None, least: int = 0, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", few: int = FEW_GROUPS) -> DataFrame:
    """Write the archives; return the manifest (uri, records, bytes), itself kept as Parquet in the same folder."""
    spark = df.sparkSession
    root = path or shared_dir(spark)
    date = datetime.datetime.now(datetime.UTC).strftime("%Y-%m-%dT%H:%M:%SZ")
    pages = df.select(df[id_col].cast("long").alias("page_id"), df[url_col].cast("string").alias("url"), F.coalesce(df[payload_col].cast("string"), F.lit("")).alias("payload"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, folder = fs.FileSystem.from_uri(f"{root}/archives")
        store.create_dir(folder, recursive=True)
        archive, waiting, size, done = None, [], 0, []

        def opened() -> _Archive:
            return _Archive(store, folder, f"{root}/archives", waiting)

        for batch in batches:
            for k in range(batch.num_rows):
                raw = page_record({c: batch.column(j)[k].as_py() for j, c in enumerate(batch.schema.names)}, date)
                if archive is None:
                    waiting.append(raw)
                    size += len(raw)
                    if size < SAMPLE_BYTES and len(waiting) < SAMPLES:
                        continue
                    archive = opened()
                    for r in waiting:
                        archive.add(r)
                    waiting, size = [], 0
                else:
                    archive.add(raw)
                if archive.bytes >= ARCHIVE_BYTES:
                    done.append(archive.close())
                    archive = None
        if waiting:
            archive = opened()
            for r in waiting:
                archive.add(r)
        if archive is not None:
            done.append(archive.close())
        yield pa.RecordBatch.from_arrays([pa.array([d[j] for d in done], t) for j, t in enumerate((pa.string(), pa.int64(), pa.int64()))], names=["uri", "records", "bytes"])

    _records(pages, least, few).mapInArrow(run, MANIFEST).write.parquet(f"{root}/manifest")
    return spark.read.schema(MANIFEST).parquet(f"{root}/manifest")


# --- reading


class _Buffer:
    """A stream that is looked ahead into; ``base`` is the place of its first byte held."""

    def __init__(self, stream):
        self.stream, self.held, self.base, self.ended = stream, bytearray(), 0, False

    def has(self, n: int) -> bool:
        while len(self.held) < n and not self.ended:
            more = self.stream.read(_CHUNK)
            self.ended = not more
            self.held += more
        return len(self.held) >= n

    def take(self, n: int) -> bytes:
        out = bytes(self.held[:n])
        del self.held[:n]
        self.base += len(out)
        return out


def _frame_length(b: _Buffer) -> int | None:
    """Bytes of the frame at the buffer's start, from its header and its blocks' headers; None if it ends too early."""
    if not b.has(5):
        return None
    kind = b.held[4]
    single = kind >> 5 & 1
    at = 5 + (0 if single else 1) + (0, 1, 2, 4)[kind & 3] + (1 if single and not kind >> 6 else (0, 2, 4, 8)[kind >> 6])
    while True:
        if not b.has(at + 3):
            return None
        head = int.from_bytes(b.held[at : at + 3], "little")
        at += 3 + (1 if head >> 1 & 3 == 1 else head >> 3)
        if head & 1:
            break
    at += 4 * (kind >> 2 & 1)
    return at if b.has(at) else None


def frames(stream) -> Iterator[tuple[int, bytes | None, str | None]]:
    """Place, content and issue of every frame that is a record; the leading dictionary is loaded for those after it."""
    b, decoder, lost = _Buffer(stream), zstandard.ZstdDecompressor(), None
    while b.has(1):
        at = b.base
        magic = int.from_bytes(b.held[:4], "little") if b.has(4) else 0
        if magic in SKIPPABLE and b.has(8):
            size = int.from_bytes(b.held[4:8], "little")
            if not b.has(8 + size):
                yield at, None, "truncated"
                return
            content = b.take(8 + size)[8:]
            if at == 0 and magic == DICTIONARY_FRAME:
                try:
                    if content[:4] == struct.pack("<I", FRAME):
                        content = zstandard.ZstdDecompressor().decompressobj().decompress(content)
                    decoder = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(content))
                except zstandard.ZstdError:
                    lost = "dictionary"
            continue
        if magic != FRAME:
            yield at, None, "frame"
            return
        size = _frame_length(b)
        if size is None:
            yield at, None, "truncated"
            return
        raw = b.take(size)
        try:
            one = decoder.decompressobj()
            content = one.decompress(raw)
            yield at, content if one.eof else None, None if one.eof else "frame"
        except zstandard.ZstdError:
            yield at, None, lost or "frame"


def parsed(raw: bytes) -> dict:
    """Fields, block and issue of one record."""
    out: dict = {"fields": {}, "block": b"", "issue": None}
    head, gap, rest = raw.partition(b"\r\n\r\n")
    lines = head.split(b"\r\n")
    if not gap or lines[0] not in (b"WARC/1.0", b"WARC/1.1"):
        return out | {"issue": "version" if gap else "header"}
    names: list[str] = []
    for line in lines[1:]:
        if line[:1] in (b" ", b"\t") and names:  # a folded value
            out["fields"][names[-1]] += " " + line.strip().decode("utf-8", "replace")
            continue
        m = _FIELD.fullmatch(line)
        if not m:
            return out | {"issue": "header"}
        names.append(m[1].decode().lower())
        out["fields"][names[-1]] = m[2].decode("utf-8", "replace").strip()
    if any(f.lower() not in out["fields"] for f in MANDATORY) or any(names.count(f.lower()) > 1 for f in MANDATORY):
        return out | {"issue": "header"}
    said = out["fields"]["content-length"]
    if not (said.isascii() and said.isdigit()) or len(rest) != int(said) + 4:
        return out | {"issue": "length"}
    if rest[-4:] != b"\r\n\r\n":
        return out | {"issue": "trailer"}
    return out | {"block": rest[:-4]}


def described(raw: bytes) -> dict:
    """What ``read`` returns of one record."""
    p = parsed(raw)
    f, block, issue = p["fields"], p["block"], p["issue"]

    def bare(name: str) -> str | None:
        return f[name].removeprefix("<").removesuffix(">") if name in f else None

    out = {"record_id": bare("warc-record-id"), "record_type": f.get("warc-type"), "target_uri": bare("warc-target-uri"), "date": f.get("warc-date"), "content_type": f.get("content-type"), "refers_to": bare("warc-refers-to")}
    payload, said = block, None
    if issue is None and (f.get("content-type") or "").startswith("application/http"):
        http, gap, payload = block.partition(b"\r\n\r\n")
        lengths = re.findall(rb"(?im)^content-length:[ \t]*(\d+)[ \t]*\r?$", http)
        said = int(lengths[0]) if lengths else None
        issue = None if gap else "http"
    revisit = f.get("warc-type") == "revisit"
    if issue is None and not revisit and said is not None and said != len(payload):
        issue = "http_length"
    own = digest(payload)
    for name, computed in (("warc-block-digest", digest(block)), ("warc-payload-digest", None if revisit else own)):
        if issue is None and computed and f.get(name, "").lower().startswith("sha1:") and f[name][5:].upper() != computed:
            issue = "digest"
    if revisit:
        named = f.get("warc-payload-digest", "")
        return out | {"payload": None, "payload_bytes": said, "payload_digest": named[5:].upper() if named.lower().startswith("sha1:") else None, "issue": issue}
    return out | {"payload": payload, "payload_bytes": len(payload), "payload_digest": own, "issue": issue}


_READ = {"record_id": pa.string(), "record_type": pa.string(), "target_uri": pa.string(), "date": pa.string(), "content_type": pa.string(), "refers_to": pa.string(), "payload_bytes": pa.int64(), "payload_digest": pa.string(), "issue": pa.string()}


def archives(spark: SparkSession, path: str) -> DataFrame:
    """uri of every archive below a folder; contents are not read."""
    return spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.zst").option("recursiveFileLookup", "true").load(path).select(F.col("path").alias("uri"))


def read(files: DataFrame, payloads: bool = True, batch_bytes: int = 8 << 20) -> DataFrame:
    """uri, place, record_id, record_type, target_uri, date, content_type, refers_to, payload_bytes, payload_digest, issue and, if asked, payload.

    ``files`` has the column uri, an archive each; a task streams one after the other. The store must be one that pyarrow opens.
    """
    kinds = _READ | ({"payload": pa.binary()} if payloads else {})
    names = ["uri", "place", *kinds]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flush() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([h[n] for h in held], t) for n, t in zip(names, (pa.string(), pa.int64(), *kinds.values()), strict=True)], names=names)

        for batch in batches:
            for uri in batch.column(0).to_pylist():
                store, place = fs.FileSystem.from_uri(re.sub(r"^file:/(?!/)", "file:///", uri))
                held, size = [], 0
                with store.open_input_stream(place) as stream:
                    for at, content, issue in frames(stream):
                        one = dict.fromkeys(kinds) | {"issue": issue} if content is None else described(content)
                        held.append({"uri": uri, "place": at, **one})
                        size += 200 + (len(content) if content and payloads else 0)
                        if size >= batch_bytes:
                            yield flush()
                            held, size = [], 0
                if held:
                    yield flush()

    sql = {pa.string(): "string", pa.int64(): "long", pa.binary(): "binary"}
    count = max(1, min(files.count(), 10_000))
    schema = "uri string, place long, " + ", ".join(f"{n} {sql[t]}" for n, t in kinds.items())
    return files.select("uri").repartition(count, "uri").mapInArrow(run, schema)
