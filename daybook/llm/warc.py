"""WARC archives with a two-level capture index.

Archives are gzip members one after the other, a record each, written where the pages lie.
The index has two levels: lines ``reversed-host key, page, archive, offset, length``, sorted
over the whole corpus and packed into compressed blocks, and a sparse directory with each
block's first key and place. A lookup finds its part of the index by bisection of the parts'
first keys (at most ``MAX_PARTS``), its blocks by bisection of that part's directory, its
lines by bisection of the block, and reads from the archives only the byte ranges named there.

Files go through ``pyarrow.fs`` (local or mounted folders, HDFS, S3, GCS). A task writes under
fresh names, and only names that its committed rows carry are ever read, so a lost or repeated
task leaves an unused file at most.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from typing import NamedTuple
from urllib.parse import quote, unquote

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daybook.llm.common import drop, save, text_or_empty
from daybook.operators.joins import BROADCAST_BYTES, measured_bytes, salted_join, top_hot_keys
from daybook.sources.session import checkpoint_dir

# Bytes after which a task begins another archive.
ARCHIVE_BYTES = 256 << 20
# Lines of an index block, and characters after which it is closed early.
BLOCK_LINES, BLOCK_CHARS = 3000, 1 << 20
# Captures of an index part, the most parts there are, and characters of a part's first key
# that are broadcast: 64 MB at most (a key cut there only makes a lookup read one part more).
PART_CAPTURES, MAX_PARTS, HEAD_CHARS = 20_000, 1 << 16, 256
# Lookups of a part that one task takes, bytes of neighbouring records read at once, and bytes
# of records that a reading task gets.
TASK_LOOKUPS, READ_BYTES, TASK_BYTES = 50_000, 4 << 20, 64 << 20
# Records handed on together.
OUT_BYTES = 4 << 20
# Fixed values of the format.
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_SAFE = "".join(map(chr, range(33, 127))).replace("%", "")


def _store(uri: str) -> tuple[pafs.FileSystem, str]:
    scheme, _, rest = uri.partition(":")
    if "/" in scheme or not rest:
        return pafs.LocalFileSystem(), uri
    if scheme == "file":
        return pafs.LocalFileSystem(), "/" + unquote(rest).lstrip("/")
    return pafs.FileSystem.from_uri(re.sub("^s3[an]:", "s3:", uri))


def url_key(url: Column) -> Column:
    """Sort key of a URL: host labels reversed, then path and query; no scheme, user, port,
    fragment or ``www.``; lower-case host. Null gives the empty key."""
    u = F.coalesce(url.cast("string"), F.lit(""))
    plain = F.regexp_replace(u, r"(?s)#.*$", "")
    host = F.lower(F.regexp_extract(plain, r"(?s)^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?@]*@)?([^/?:]*)", 1))
    rest = F.regexp_replace(plain, r"(?s)^[A-Za-z][A-Za-z0-9+.-]*://[^/?]*", "")
    turned = F.array_join(F.reverse(F.split(F.regexp_replace(host, r"^www\.", ""), r"\.")), ",")
    return F.when(host == "", plain).otherwise(F.concat(turned, F.lit(")"), rest))


# ------------------------------------------------------------------- records
class Record(NamedTuple):
    """A record read back; ``payload`` is None for a revisit."""

    kind: str
    page: str | None
    url: str | None
    payload_bytes: int
    digest: str
    refers_to: str | None
    payload: bytes | None


def _field(s: str) -> str:
    return quote(s, safe=_SAFE)


def _record_id(page: str | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page} {digest}')}>"


def write_record(kind: str, page: str | None, url: str | None, size: int, digest: str, refers_to: str | None,
                 payload: bytes, date: str) -> bytes:
    """One WARC record, uncompressed. A revisit keeps the HTTP headers, without the payload."""
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % size
    if kind == "response":
        block += payload
    head = [("WARC-Type", kind), ("WARC-Record-ID", _record_id(page, digest)), ("WARC-Date", date)]
    if url is not None:
        head.append(("WARC-Target-URI", _field(url)))
    if page is not None:
        head.append(("Page-ID", _field(page)))
    head.append(("WARC-Payload-Digest", f"sha1:{digest}"))
    if kind == "revisit":
        head += [("WARC-Profile", _PROFILE), ("WARC-Refers-To", _record_id(refers_to, digest)), ("Refers-To-Page-ID", _field(refers_to or ""))]
    head += [("Content-Type", "application/http;msgtype=response"), ("Content-Length", str(len(block)))]
    return "WARC/1.1\r\n{}\r\n\r\n".format("\r\n".join(f"{k}: {v}" for k, v in head)).encode() + block + b"\r\n\r\n"


def read_record(member: bytes) -> Record:
    """A record from its gzip member; one whose lengths or digest don't hold is an error."""
    raw = zlib.decompress(member, wbits=31)
    head, _, rest = raw.partition(b"\r\n\r\n")
    version, *lines = head.decode().split("\r\n")
    fields = dict(x.split(": ", 1) for x in lines)
    block = rest[:int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(re.search(rb"Content-Length: (\d+)", http)[1])
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    whole = fields["WARC-Type"] == "response"
    if version != "WARC/1.1" or rest[len(block):] != b"\r\n\r\n" or whole and (len(payload) != size or digest != _digest(payload)):
        raise ValueError(f"damaged record {fields.get('WARC-Record-ID')}")
    page, url, refers = (None if fields.get(k) is None else unquote(fields[k]) for k in ("Page-ID", "WARC-Target-URI", "Refers-To-Page-ID"))
    return Record(fields["WARC-Type"], page, url, size, digest, refers, payload if whole else None)


def _digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


# ------------------------------------------------------------------- writing
def plan_records(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", min_bytes: int = 0) -> DataFrame:
    """``page, url, html, bytes, sha1, refers_to`` of every row. ``refers_to``: null for a
    response, else the smallest id among the rows of equal payload.

    Equal payloads agree in SHA-1, length and a second hash. Payloads under ``min_bytes``
    are responses all. Rows that repeat the smallest id of their payload are responses too,
    as are rows without an id if no row of their payload has one.
    """
    kind = pages.schema[id_col].dataType
    p = pages.select(pages[id_col].alias("page"), pages[url_col].cast("string").alias("url"), text_or_empty(html_col).alias("html"))
    p = p.withColumns({"bytes": F.octet_length("html").cast("long"), "sha1": F.sha1(F.col("html").cast("binary"))})
    p = p.withColumn("payload", F.struct("sha1", "bytes", F.xxhash64("html").alias("x")))
    groups = (p.where(F.col("bytes") >= min_bytes).groupBy("payload").agg(F.count(F.lit(1)).alias("n"), F.min("page").alias("first"))
              .where((F.col("n") > 1) & F.col("first").isNotNull()))
    groups = save(groups)  # payloads that occur more than once
    if measured_bytes(groups.select("payload.sha1", "payload.bytes", "payload.x", "first")) <= BROADCAST_BYTES:
        out = p.join(F.broadcast(groups.drop("n")), "payload", "left")  # no page moves
    else:
        out = salted_join(p, groups.drop("n"), "payload", top_hot_keys(groups, ["payload"], "n"))
    refers = F.when(~F.col("page").eqNullSafe(F.col("first")), F.col("first")).cast(kind)
    return out.select("page", "url", "html", "bytes", "sha1", refers.alias("refers_to"))


def _archiver(folder: str, archive_bytes: int, date: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, path = _store(folder)
        sink, name, at = None, "", 0
        try:
            for batch in batches:
                keys = [_field(k) for k in batch.column("key").to_pylist()]
                names, starts, sizes = [], [], []
                for page, url, html, size, sha1, refers in zip(*(batch.column(k) for k in ("page", "url", "html", "bytes", "sha1", "refers_to"))):
                    if sink is None or at >= archive_bytes:
                        if sink is not None:
                            sink.close()
                        name, at = f"{uuid.uuid4().hex}.warc.gz", 0
                        sink = fs.open_output_stream(f"{path}/{name}", compression=None)
                    refers = refers.as_py()
                    record = write_record("response" if refers is None else "revisit", page.as_py(), url.as_py(), size.as_py(),
                                          base64.b32encode(bytes.fromhex(sha1.as_py())).decode(), refers, (html.as_py() or "").encode(), date)
                    packer = zlib.compressobj(3, wbits=31)
                    member = packer.compress(record) + packer.flush()
                    sink.write(member)
                    names.append(name)
                    starts.append(at)
                    sizes.append(len(member))
                    at += len(member)
                yield pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), batch.column("page"), pa.array(names, pa.string()), pa.array(starts, pa.int64()),
                                                  pa.array(sizes, pa.int64())], names=["key", "page", "archive", "start", "size"])
        finally:
            if sink is not None:
                sink.close()
    return run


def write_archives(records: DataFrame, folder: str, archive_bytes: int = ARCHIVE_BYTES, date: str = "1970-01-01T00:00:00Z") -> DataFrame:
    """Writes the rows of ``plan_records`` into archives in ``folder`` and returns their
    captures: ``key, page, archive, start, size`` (the byte range of the record's member).
    The key is percent-encoded, so its order is the same here and in the index lines."""
    fs, path = _store(folder)
    fs.create_dir(path)
    whole = F.col("refers_to").isNull()
    r = records.select(url_key(F.col("url")).alias("key"), F.col("page").cast("string").alias("page"), "url", F.when(whole, F.col("html")).alias("html"),
                       "bytes", "sha1", F.col("refers_to").cast("string").alias("refers_to"))
    return save(r.mapInArrow(_archiver(folder, archive_bytes, date), "key string, page string, archive string, start bigint, size bigint"))


# --------------------------------------------------------------------- index
def _line(key: str, page: str | None, archive: str, start: int, size: int) -> str:
    return f"{key}\t{'' if page is None else '=' + _field(page)}\t{archive}\t{start}\t{size}"


def _indexer(folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, path = _store(folder)
        name, at, sink = f"{uuid.uuid4().hex}.idx", 0, None
        heads, starts, sizes = [], [], []
        lines: list[str] = []
        chars, first = 0, ""

        def close_block() -> None:
            nonlocal at, sink, chars
            if not lines:
                return
            sink = sink or fs.open_output_stream(f"{path}/{name}", compression=None)
            packed = zlib.compress("\n".join(lines).encode())
            sink.write(packed)
            heads.append(first)
            starts.append(at)
            sizes.append(len(packed))
            at += len(packed)
            chars = 0
            lines.clear()

        for batch in batches:
            for row in zip(*(batch.column(k).to_pylist() for k in ("key", "page", "archive", "start", "size"))):
                if not lines:
                    first = row[0]
                lines.append(_line(*row))
                chars += len(lines[-1])
                if len(lines) >= BLOCK_LINES or chars >= BLOCK_CHARS:
                    close_block()
        close_block()
        if sink is not None:
            sink.close()
            yield pa.RecordBatch.from_arrays(
                [pa.array([TaskContext.get().partitionId()], pa.int32()), pa.array([name]), pa.array([heads], pa.list_(pa.string())), pa.array([starts], pa.list_(pa.int64())), pa.array([sizes], pa.list_(pa.int64()))],
                names=["place", "part", "heads", "starts", "sizes"])
    return run


def write_index(captures: DataFrame, folder: str, part_captures: int = PART_CAPTURES) -> DataFrame:
    """Sorts the captures by key and writes them as compressed blocks into ``folder``, one
    file a part. Returns the sparse directory, a row a part: ``place`` (its number in the
    order of keys), ``part`` (its file) and the ``heads`` (first keys), ``starts`` and ``sizes`` of its blocks. A key with very many
    captures goes over as many blocks and parts as it fills."""
    fs, path = _store(folder)
    fs.create_dir(path)
    n = captures.count()
    parts = max(1, min(MAX_PARTS, -(-n // part_captures)))
    order = ["key", "page", "archive", "start"]
    c = captures.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    return save(c.mapInArrow(_indexer(folder), "place int, part string, heads array<string>, starts array<bigint>, sizes array<bigint>"))


def _part_finder(heads: list[tuple[str, str]]):
    cut = [h[:HEAD_CHARS] for h, _ in heads]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, parts = [], []
            for key in map(_field, batch.column(0).to_pylist()):
                k = key[:HEAD_CHARS]
                for p in range(max(0, bisect_left(cut, k) - 1), bisect_right(cut, k)):
                    keys.append(key)
                    parts.append(heads[p][1])
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), pa.array(parts, pa.string())], names=["key", "part"])
    return run


def _searcher(folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, path = _store(folder)
        part, source, heads, starts, sizes = None, None, [], [], []
        number, lines, keys = -1, [], []
        for batch in batches:
            out = []
            for k, name, h, s, z in zip(*(batch.column(k).to_pylist() for k in ("key", "part", "heads", "starts", "sizes"))):
                if h is not None:
                    if source is not None:
                        source.close()
                    part, heads, starts, sizes, number = name, h, s, z, -1
                    source = fs.open_input_file(f"{path}/{part}")
                    continue
                for b in range(max(0, bisect_left(heads, k) - 1), bisect_right(heads, k)):
                    if b != number:
                        lines = zlib.decompress(source.read_at(sizes[b], starts[b])).decode().split("\n")
                        keys, number = [x.partition("\t")[0] for x in lines], b
                    for x in lines[bisect_left(keys, k):bisect_right(keys, k)]:
                        _, page, archive, start, size = x.split("\t")
                        out.append((unquote(k), unquote(page[1:]) if page else None, archive, int(start), int(size)))
            cols = list(zip(*out)) if out else [()] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64()))],
                                             names=["key", "page", "archive", "start", "size"])
        if source is not None:
            source.close()
    return run


def _tasks(df: DataFrame, n: int) -> int:
    """``n`` pieces of work as a number of partitions: no more than a shuffle has, several
    for each core."""
    spark = df.sparkSession
    most = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 4 * spark.sparkContext.defaultParallelism)
    return max(1, min(n, most))


def lookup(keys: DataFrame, directory: DataFrame, folder: str, key_col: str = "key") -> DataFrame:
    """The captures of each different key in ``key_col``: ``key, page, archive, start, size``.
    Keys that the index doesn't hold, and null, give no rows. Many lookups that fall into
    one part are dealt over several tasks, each with that part's directory."""
    # parts that begin with the same key are told apart by their place
    tops = [(r.head, r.part) for r in sorted(directory.select("place", F.col("heads")[0].substr(1, HEAD_CHARS).alias("head"), "part").collect())]
    asked = keys.select(F.col(key_col).cast("string").alias("key")).where("key IS NOT NULL").distinct()
    found = save(asked.mapInArrow(_part_finder(tops), "key string, part string"))
    counts = save(found.groupBy("part").agg(F.ceil(F.count(F.lit(1)) / TASK_LOOKUPS).alias("tasks")))  # MAX_PARTS rows at most
    deal, n = F.broadcast(counts), counts.agg(F.sum("tasks")).first()[0] or 1
    none = [F.lit(None).cast(directory.schema[c].dataType).alias(c) for c in ("heads", "starts", "sizes")]
    asks = found.join(deal, "part").select("part", F.pmod(F.xxhash64("key"), F.col("tasks")).alias("task"), "key", *none)
    dirs = directory.join(deal, "part").select("part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("tasks") - 1)).alias("task"),
                                               F.lit(None).cast("string").alias("key"), "heads", "starts", "sizes")
    # a number of its own: the work is in the reading, which the size of these rows doesn't tell
    both = dirs.unionByName(asks).repartition(_tasks(keys, n), "part", "task").sortWithinPartitions("part", "task", "key")  # a directory before its lookups
    return both.mapInArrow(_searcher(folder), "key string, page string, archive string, start bigint, size bigint")


# ------------------------------------------------------------------- reading
def _reader(folder: str, payloads: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, path = _store(folder)
        kinds = [pa.string(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.binary()]

        def rows(got: list[Record]) -> pa.RecordBatch:
            cols = list(zip(*got)) if got else [()] * len(kinds)
            if not payloads:
                cols[-1] = [None] * len(got)
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds)], names=["record_type", "page", "url", "payload_bytes", "payload_digest", "refers_to", "payload"])

        name, source = None, None
        for batch in batches:
            want = list(zip(*(batch.column(k).to_pylist() for k in ("archive", "start", "size"))))
            got, held, a = [], 0, 0
            while a < len(want):
                b, end = a + 1, want[a][1] + want[a][2]  # neighbouring records are one range
                while b < len(want) and want[b][0] == want[a][0] and want[b][1] == end and end - want[a][1] < READ_BYTES:
                    end += want[b][2]
                    b += 1
                if want[a][0] != name:
                    if source is not None:
                        source.close()
                    name, source = want[a][0], fs.open_input_file(f"{path}/{want[a][0]}")
                raw = source.read_at(end - want[a][1], want[a][1])
                for _, start, size in want[a:b]:
                    at = start - want[a][1]
                    got.append(read_record(raw[at:at + size]))
                    held += len(got[-1].payload or b"") if payloads else 0
                    if held > OUT_BYTES:
                        yield rows(got)
                        got, held = [], 0
                a = b
            yield rows(got)
        if source is not None:
            source.close()
    return run


def read_ranges(captures: DataFrame, folder: str, payloads: bool = True) -> DataFrame:
    """The records at the captures' byte ranges: ``record_type, page, url, payload_bytes,
    payload_digest, refers_to, payload`` (null for revisits, and without ``payloads``).
    Ranges are dealt by archive and stretch and read in order; a damaged record is an error."""
    c = captures.select("archive", "start", "size").withColumn("stretch", F.expr(f"start div {READ_BYTES}"))
    stored = save(c)
    total = stored.agg(F.sum("size")).first()[0] or 0
    # several tasks a core however little there is, and no more than TASK_BYTES each
    n = max(_tasks(stored, -(-total // READ_BYTES)), -(-total // TASK_BYTES))
    c = stored.repartition(n, "archive", "stretch").sortWithinPartitions("archive", "start")
    return c.mapInArrow(_reader(folder, payloads), "record_type string, page string, url string, payload_bytes bigint, "
                                                   "payload_digest string, refers_to string, payload binary")


def archive_pages(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", min_bytes: int = 0,
                  folder: str | None = None, archive_bytes: int = ARCHIVE_BYTES, part_captures: int = PART_CAPTURES,
                  payloads: bool = True) -> DataFrame:
    """Writes every row of ``pages`` as a WARC record, indexes the archives, looks every URL up
    in the index and reads its records back: ``page_id, url, payload_bytes, payload_digest,
    record_type, refers_to, payload``, one row per row of ``pages``.

    The payload is the html in UTF-8 (null: empty), its digest the base32 SHA-1; both are of
    the whole payload, for revisits too. ``plan_records`` says which record is a response.
    Null and repeated ids and URLs are rows as they come (a null URL is indexed under the
    empty key); texts are never cut; an empty table gives no rows; other columns, whatever
    their names, are not read. URLs come back as written, control characters and all.
    ``folder``: where archives and index are kept, in the checkpoint folder by default.
    """
    spark = pages.sparkSession
    folder = folder or f"{checkpoint_dir(spark).rstrip('/')}/llm-warc-{uuid.uuid4().hex}"
    kind = pages.schema[id_col].dataType
    captures = write_archives(plan_records(pages, id_col, url_col, html_col, min_bytes), f"{folder}/archives", archive_bytes)
    directory = write_index(captures, f"{folder}/index", part_captures)
    drop(captures)
    keys = pages.select(url_key(pages[url_col]).alias("key"))
    out = read_ranges(lookup(keys, directory, f"{folder}/index"), f"{folder}/archives", payloads)
    return out.select(F.col("page").cast(kind).alias(id_col), F.col("url").alias(url_col), "payload_bytes", "payload_digest", "record_type",
                      F.col("refers_to").cast(kind).alias("refers_to"), "payload")
