"""WARC archives with a two-level capture index.

Each task writes its pages as gzip records into archive files; a payload crosses the
network once, to meet the smallest id of its digest. Only the capture lines (key, file,
offset, length) are sorted, by reversed-host key; each range of keys becomes an index file of
compressed blocks. The first key of each block goes to a sparse directory per index file. A look-up finds the index file
by its first key, the block by binary search in that file's directory, reads the
block's byte range and then the records' byte ranges.

Of the records with equal payloads of a least size, the one with the smallest id
is a response; the others are revisits that carry headers only.

Files go below the shared folder under names of their own per attempt; only the
names that a finished task returns are used, so lost or repeated tasks do no harm.

Defined results: null html is an empty payload, a null url an empty key. Rows
with the same id are captures of their own; those with the smallest id of their
payload are all responses. A null id never refers to another record. An empty
table gives no files.
"""

from __future__ import annotations

import bisect
import gzip
import hashlib
import json
import uuid
import zlib

import pandas as pd
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .store import folder, written

MIN_REVISIT_BYTES = 100
BLOCK_LINES = 512
FILE_BYTES = 256 << 20       # an archive file is closed beyond this
DATE = "2000-01-01T00:00:00Z"
NEAR = 1 << 16               # records closer than this are read as one range

PLACE = "part string, first_key string, blocks string, lines long"


def surt(url: Column) -> Column:
    """Sort-friendly key: reversed host, then path and query; scheme, www and fragment go."""
    bare = F.regexp_replace(F.regexp_replace(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://", ""), "#.*$", "")
    host = F.lower(F.regexp_extract(bare, r"^([^/?]*)", 1))
    rest = F.substring(bare, F.length(host) + 1, F.length(bare))
    names = F.reverse(F.split(F.regexp_replace(host, r"^www\.", ""), r"\."))
    return F.concat(F.array_join(names, ","), F.lit(")"), rest)


def _record(row) -> bytes:
    """One record as its own gzip member."""
    payload = row.payload.encode()
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    head = ["WARC/1.1", f"WARC-Type: {row.record_type}", f"WARC-Record-ID: {record_id(row.page_id)}",
            f"WARC-Date: {DATE}", f"WARC-Target-URI: {json.dumps(row.url)[1:-1]}",
            f"WARC-Payload-Digest: sha256:{row.digest}"]
    block = http
    if row.record_type == "revisit":
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                 f"WARC-Refers-To: {record_id(row.refers_to)}"]
    else:
        block += payload
    head += ["Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}"]
    return gzip.compress("\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n", 3, mtime=0)


def record_id(page_id) -> str:
    return f"<urn:page:{'' if page_id is None or pd.isna(page_id) else int(page_id)}>"


def _id_of(urn: str) -> int | None:
    number = urn.removeprefix("<urn:page:").removesuffix(">")
    return int(number) if number else None


def parse_record(member: bytes) -> dict:
    """Headers and payload facts of one gzip member."""
    raw = zlib.decompress(member, 31)
    head, _, block = raw.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = block[:int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    length = int(dict(x.split(": ", 1) for x in http.decode().split("\r\n")[1:])["Content-Length"])
    revisit = fields["WARC-Type"] == "revisit"
    return {"page_id": _id_of(fields["WARC-Record-ID"]), "url": json.loads(f'"{fields["WARC-Target-URI"]}"'),
            "record_type": fields["WARC-Type"], "payload_bytes": length if revisit else len(payload),
            "payload_digest": fields["WARC-Payload-Digest"].removeprefix("sha256:") if revisit
            else hashlib.sha256(payload).hexdigest(),
            "refers_to": _id_of(fields["WARC-Refers-To"]) if revisit else None,
            "payload": None if revisit else payload.decode()}


def _open(root: str):
    """File system and path of a folder given as URI or path."""
    return pafs.FileSystem.from_uri(root)


class _Files:
    """Appends to one output file after another below ``root``."""

    def __init__(self, root: str, kind: str, most: int | None = None):
        self.fs, self.base = _open(root)
        self.fs.create_dir(self.base, recursive=True)
        self.kind, self.most, self.out = kind, most, None

    def add(self, data: bytes) -> tuple[str, int]:
        """Name and offset of where ``data`` went."""
        if self.out is not None and self.most and self.at >= self.most:
            self.close()
        if self.out is None:
            self.name, self.at = f"{uuid.uuid4().hex}.{self.kind}", 0
            self.out = self.fs.open_output_stream(f"{self.base}/{self.name}", compression=None)
        where = self.name, self.at
        self.out.write(data)
        self.at += len(data)
        return where

    def close(self) -> None:
        if self.out is not None:
            self.out.close()
            self.out = None


def capture_key(surt_key: Column, page_id: Column) -> Column:
    """Sort key of a capture: the url's key, a blank, the id in fixed width."""
    return F.concat(surt_key, F.lit(" "), F.lpad(F.coalesce(page_id.cast("string"), F.lit("")), 20, "0"))


def write_archive(pages: DataFrame, min_revisit_bytes: int = MIN_REVISIT_BYTES) -> tuple[str, DataFrame]:
    """Write ``pages`` (page_id, url, html); the archive's folder and its index files.

    The index files are rows (part, first_key, blocks, lines): a file's name, the
    key it begins with, its sparse directory as JSON (first key, offset, length of
    each block) and its number of captures.
    """
    spark = pages.sparkSession
    root = folder(spark, "warc")
    payload = F.coalesce(F.col("html"), F.lit(""))
    rows = pages.select("page_id", F.coalesce("url", F.lit("")).alias("url"), payload.alias("payload"),
                        F.sha2(payload, 256).alias("digest"), capture_key(surt(F.col("url")), F.col("page_id")).alias("key"))
    twice = (rows.where(F.octet_length("payload") >= min_revisit_bytes).groupBy("digest")
             .agg(F.min("page_id").alias("first"), F.count("*").alias("n")).where("n > 1").drop("n"))
    later = F.col("page_id") > F.col("first")
    # the payload moves to its digest at every size of the table, and no further
    rows = rows.join(twice.hint("merge"), "digest", "left").select(
        "page_id", "url", F.when(later, F.lit("revisit")).otherwise(F.lit("response")).alias("record_type"),
        "payload", "digest", "key", F.when(later, F.col("first")).alias("refers_to"))

    def write(batches):
        archive = _Files(root, "warc.gz", FILE_BYTES)
        for batch in batches:
            out = []
            for row in batch.itertuples(index=False):
                data = _record(row)
                out.append((row.key, *archive.add(data), len(data)))
            yield pd.DataFrame(out, columns=["key", "file", "at", "length"])
        archive.close()

    # the lines of finished tasks, written; files of tasks that were lost are in no line
    lines = written(rows.mapInPandas(write, "key string, file string, at long, length long"), "warc-captures")

    def write_index(batches):
        index, directory, lines, first, name, n = _Files(root, "cdx.gz"), [], [], None, None, 0

        def flush():
            data = gzip.compress("".join(lines).encode(), 6, mtime=0)
            at = index.add(data)[1]
            directory.append([first, at, len(data)])
            lines.clear()

        for batch in batches:
            for row in batch.itertuples(index=False):
                first = row.key if not lines else first
                lines.append(json.dumps([row.key, row.file, row.at, row.length]) + "\n")
                n += 1
                if len(lines) >= BLOCK_LINES:
                    flush()
        if lines:
            flush()
        if n:
            name = index.name
        index.close()
        if n:
            yield pd.DataFrame({"part": [name], "first_key": [directory[0][0]], "blocks": [json.dumps(directory)],
                                "lines": [n]})

    order = ["key", "file", "at"]
    return root, written(lines.repartitionByRange(*order).sortWithinPartitions(*order).mapInPandas(write_index, PLACE), "warc-index")


def read_captures(root: str, index: DataFrame, wanted: DataFrame) -> DataFrame:
    """The captures of ``wanted`` (key): all facts of their records, through the index.

    A key without blank and id stands for every capture of its url. The first
    keys of the index files, one per writing task, are what every task gets.
    """
    firsts = sorted((r["first_key"], r["part"]) for r in index.select("first_key", "part").collect())
    if not firsts:
        return wanted.sparkSession.createDataFrame([], CAPTURE)
    shared = wanted.sparkSession.sparkContext.broadcast(firsts)

    def route(batches):
        keys, parts = [k for k, _ in shared.value], [p for _, p in shared.value]
        for batch in batches:
            out = []
            for key in batch["key"]:
                a = max(bisect.bisect_left(keys, key) - 1, 0)
                if a + 1 < len(keys) and keys[a + 1] == key:
                    a += 1
                b = a + 1
                while " " not in key and b < len(keys) and keys[b].startswith(key + " "):
                    b += 1
                out += [(parts[i], key) for i in range(a, b)]
            yield pd.DataFrame(out, columns=["part", "key"])

    routed = wanted.select("key").mapInPandas(route, "part string, key string").withColumn("blocks", F.lit(None).cast("string"))
    # a part's directory goes before its keys, once
    directories = index.select("part", F.lit(None).cast("string").alias("key"), "blocks")
    return (routed.unionByName(directories).repartition("part").sortWithinPartitions("part", F.col("key").asc_nulls_first())
            .mapInPandas(lambda it: _fetch(root, it), CAPTURE))


CAPTURE = ("page_id long, url string, record_type string, payload_bytes long, payload_digest string, refers_to long, "
           "payload string")


def _fetch(root: str, batches):
    fs, base = _open(root)
    blocks: list = []
    for batch in batches:
        for part, rows in batch.groupby("part", sort=False):
            if rows["blocks"].iloc[0] is not None:
                blocks = json.loads(rows["blocks"].iloc[0])
                rows = rows.iloc[1:]
            if not len(rows):
                continue
            firsts = [b[0] for b in blocks]
            need: dict[int, list[str]] = {}
            for key in rows["key"]:
                at = max(bisect.bisect_left(firsts, key) - 1, 0)
                while at < len(blocks) and (firsts[at] <= key or firsts[at].startswith(key + " ")):
                    need.setdefault(at, []).append(key)
                    at += 1
                    if at < len(blocks) and " " in key and firsts[at] > key:
                        break
            hits = []
            with fs.open_input_file(f"{base}/{part}") as file:
                for at, keys in sorted(need.items()):
                    _, offset, length = blocks[at]
                    wanted = set(keys)
                    for line in zlib.decompress(file.read_at(length, offset), 31).decode().splitlines():
                        key, *place = json.loads(line)
                        if key in wanted or key.rsplit(" ", 1)[0] in wanted:
                            hits.append(tuple(place))
            yield from _records(fs, base, hits)


def _records(fs, base, hits):
    """Frames of the records at ``hits`` (file, offset, length), near ones read together."""
    hits.sort()
    i = 0
    while i < len(hits):
        name, start, length = hits[i]
        j, end = i + 1, start + length
        while j < len(hits) and hits[j][0] == name and hits[j][1] <= end + NEAR and hits[j][1] - start < 8 * NEAR:
            end = max(end, hits[j][1] + hits[j][2])
            j += 1
        with fs.open_input_file(f"{base}/{name}") as file:
            data = file.read_at(end - start, start)
        frame = pd.DataFrame([parse_record(data[at - start:at - start + n]) for _, at, n in hits[i:j]])
        for c in ("page_id", "refers_to"):
            frame[c] = pd.array(frame[c], "Int64")
        yield frame
        i = j


def op8_warc_index(spark, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html")
    root, index = write_archive(pages)
    keys = pages.select(capture_key(surt(F.col("url")), F.col("page_id")).alias("key")).distinct()
    return read_captures(root, index, keys).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
