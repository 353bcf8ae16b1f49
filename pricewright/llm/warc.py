"""WARC archives of captures and the merge of their indexes.

Each task writes one archive of gzip members, one per record, and returns its index
as a run sorted by URL key and time. The runs are cut into ranges by sampled
splitters; each range merges its slices of all runs with a loser tree. Ranges follow
one another, so the whole is one ordered history of captures. Index rows name the
archive of the attempt that was committed, so a repeated task leaves no trace but an
unnamed file.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pricewright.llm.common import bounded_batches, salted_left_join, salts_of_large_keys
from pricewright.session import staged

LEAST_REVISIT_BYTES = 1000
CAPTURE_TIME = "20200101000000"  # where captures have no time of their own
# Parts of an address, and record identifiers.
SCHEME = "^[A-Za-z][A-Za-z0-9+.-]*://"
RECORD = "urn:x-capture:"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

_INDEX = pa.schema([
    ("run", pa.int32()), ("at", pa.int64()), ("page_id", pa.int64()), ("urlkey", pa.string()), ("taken", pa.string()),
    ("file", pa.string()), ("offset", pa.int64()), ("length", pa.int64())])
_INDEX_DDL = "run int, at long, page_id long, urlkey string, taken string, file string, offset long, length long"


def url_key(url: Column) -> Column:
    """Host labels in reverse order, then path and query: ``http://www.a.org/x?y#z`` is ``org,a)/x?y``.

    Scheme, user, port, a leading ``www`` and the fragment go. What is no such address stays as it is.
    """
    address = F.coalesce(url, F.lit(""))
    host = F.lower(F.regexp_extract(address, SCHEME + "([^/?#]*)", 1))
    host = F.regexp_replace(F.regexp_replace(F.regexp_replace(host, "^.*@", ""), ":[0-9]*$", ""), r"^www[0-9]*\.", "")
    rest = F.regexp_extract(address, SCHEME + "[^/?#]*([^#]*)", 1)
    labels = F.array_join(F.reverse(F.split(host, r"\.")), ",")
    return F.when(address.rlike(SCHEME), F.concat(labels, F.lit(")"), F.when(rest == "", "/").otherwise(rest))).otherwise(
        address)


def utc_digits(taken: Column) -> Column:
    """A timestamp as ``yyyyMMddHHmmss`` in UTC; null is ``CAPTURE_TIME``."""
    seconds = F.unix_seconds(taken)
    day = F.date_add(F.lit("1970-01-01").cast("date"), F.floor(seconds / 86400).cast("int"))
    rest = F.pmod(seconds, F.lit(86400))
    parts = [F.lpad(F.floor(part).cast("string"), 2, "0") for part in (rest / 3600, rest % 3600 / 60, rest % 60)]
    return F.coalesce(F.concat(F.date_format(day, "yyyyMMdd"), *parts), F.lit(CAPTURE_TIME))


def _record(kind: str, page_id, url, taken: str, digest: str, size: int, refers, payload: bytes) -> bytes:
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    block = http + payload
    date = f"{taken[:4]}-{taken[4:6]}-{taken[6:8]}T{taken[8:10]}:{taken[10:12]}:{taken[12:14]}Z"
    sha = base64.b32encode(bytes.fromhex(digest)).decode()
    lines = [
        "WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <{RECORD}{'none' if page_id is None else page_id}>",
        f"WARC-Date: {date}", f"WARC-Payload-Digest: sha1:{sha}"]
    if url is not None:
        lines.append(f"WARC-Target-URI: {' '.join(url.split())}")
    if kind == "revisit":
        lines += [f"WARC-Refers-To: <{RECORD}{refers}>", f"WARC-Profile: {PROFILE}"]
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}", "", ""]
    return "\r\n".join(lines).encode() + block + b"\r\n\r\n"


def _member(record: bytes) -> bytes:
    deflate = zlib.compressobj(5, zlib.DEFLATED, 31)
    return deflate.compress(record) + deflate.flush()


def _archives(folder: str):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        run = TaskContext.get().partitionId()
        store, root = fs.FileSystem.from_uri(folder)
        name = f"{run:06d}-{uuid.uuid4().hex}.warc.gz"
        index, offset = [], 0
        with store.open_output_stream(f"{root}/{name}", compression=None) as out:
            for batch in batches:
                for row in batch.to_pylist():
                    payload = row["html"].encode()
                    size = len(payload)
                    first = row["stays"] is None or row["stays"] == row["page_id"]
                    member = _member(_record(
                        "response" if first else "revisit", row["page_id"], row["url"], row["taken"], row["digest"],
                        size, row["stays"], payload if first else b""))
                    out.write(member)
                    index.append((row["urlkey"], row["taken"], row["page_id"], offset, len(member)))
                    offset += len(member)
        if not index:
            store.delete_file(f"{root}/{name}")
            return
        index.sort(key=lambda row: (row[0].encode(), row[1], row[2] is not None, row[2]))  # the sorted run
        keys, times, pages, offsets, lengths = zip(*index, strict=True)
        count = len(index)
        yield pa.RecordBatch.from_arrays([
            pa.array([run] * count, pa.int32()), pa.array(range(count), pa.int64()), pa.array(pages, pa.int64()),
            pa.array(keys, pa.string()), pa.array(times, pa.string()), pa.array([name] * count),
            pa.array(offsets, pa.int64()), pa.array(lengths, pa.int64())], schema=_INDEX)

    return write


def write_archives(pages: DataFrame, folder: str, least_bytes: int = LEAST_REVISIT_BYTES, taken: Column | None = None,
                   key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """Write archives to ``folder`` (shared by all executors) and return their sorted index runs.

    Of equal payloads of at least ``least_bytes``, the record with the largest
    identifier holds the payload and the others are revisits of it. Null HTML is an
    empty payload, a null address has no target line and sorts as ''. ``taken`` is a
    timestamp, written in UTC whatever the session's zone; without it all captures have
    one fixed time, and captures of equal time are in order of their identifiers. Rows that repeat an
    identifier get a record each. An empty table gives no archive and an empty index.
    """
    bounded_batches(pages.sparkSession)
    fs.FileSystem.from_uri(folder)[0].create_dir(fs.FileSystem.from_uri(folder)[1], recursive=True)
    page = F.col(key).cast("long")
    time = utc_digits(taken) if taken is not None else F.lit(CAPTURE_TIME)
    payload = F.coalesce(F.col(html).cast("string"), F.lit(""))
    rows = pages.select(
        page.alias("page_id"), F.col(url).cast("string").alias("url"), payload.alias("html"),
        time.alias("taken"),
    ).withColumns({
        "urlkey": url_key(F.col("url")), "digest": F.sha1(F.encode("html", "UTF-8")), "size": F.octet_length("html")})
    # sha-1 for the record; a longer digest decides which payloads are equal
    large = rows.filter(F.col("size") >= least_bytes)
    equal = large.groupBy(F.sha2(F.encode("html", "UTF-8"), 256).alias("same")).agg(
        F.max("page_id").alias("stays"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    equal = staged(equal, "payloads")
    keyed = large.withColumn("same", F.sha2(F.encode("html", "UTF-8"), 256))
    met = salted_left_join(keyed, equal.drop("n"), "same", salts_of_large_keys(equal, "same", "n"), "page_id")
    small = rows.filter(F.col("size") < least_bytes).withColumn("stays", F.lit(None).cast("long"))  # meets nothing
    columns = ["page_id", "url", "html", "taken", "urlkey", "digest", "stays"]
    decided = met.select(*columns).union(small.select(*columns))
    return staged(decided.mapInArrow(_archives(folder), _INDEX_DDL), "index-runs")


class LoserTree:
    """Smallest head of several sorted lists; each step replays one path from leaf to root."""

    def __init__(self, lists: list[list]):
        self.lists = lists
        self.at = [0] * len(lists)
        self.losers = [-1] * max(1, len(lists))
        self.winner = -1
        for source in range(len(lists)):
            self._build(source)

    def _less(self, a: int, b: int) -> bool:
        """Whether the head of list ``a`` comes before that of ``b``; a list at its end comes last."""
        if self.at[a] >= len(self.lists[a]):
            return False
        if self.at[b] >= len(self.lists[b]):
            return True
        left, right = self.lists[a][self.at[a]], self.lists[b][self.at[b]]
        return left < right if left != right else a < b

    def _build(self, source: int) -> None:
        node = (source + len(self.lists)) // 2
        while node:
            rival = self.losers[node]
            if rival < 0:  # the first to arrive waits for its rival
                self.losers[node] = source
                return
            if self._less(rival, source):
                self.losers[node], source = source, rival
            node //= 2
        self.winner = source

    def __iter__(self):
        while self.lists and self.at[self.winner] < len(self.lists[self.winner]):
            source = self.winner
            yield source, self.at[source]
            self.at[source] += 1
            node = (source + len(self.lists)) // 2
            while node:
                if self._less(self.losers[node], source):
                    self.losers[node], source = source, self.losers[node]
                node //= 2
            self.winner = source


_MERGED_DDL = "part int, place long, seen long, edge_rows long, " + _INDEX_DDL


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    part = TaskContext.get().partitionId()
    tables = [pa.Table.from_batches([batch]) for batch in batches if len(batch)]
    if not tables:
        return
    rows = pa.concat_tables(tables).combine_chunks()
    runs, at = rows["run"].to_numpy(), rows["at"].to_numpy()
    order = np.lexsort((at, runs))  # slices of runs, each as its task sorted it
    rows = rows.take(pa.array(order))
    bounds = np.flatnonzero(np.diff(runs[order], prepend=-1))
    keys = [(key.encode(), time, page is not None, page or 0) for key, time, page in zip(
        rows["urlkey"].to_pylist(), rows["taken"].to_pylist(), rows["page_id"].to_pylist(), strict=True)]
    lists = [keys[a:b] for a, b in zip(bounds, [*bounds[1:], len(keys)], strict=True)]
    merged = [int(bounds[source]) + step for source, step in LoserTree(lists)]
    out = rows.take(pa.array(merged, pa.int64()))
    names = np.array([keys[i][0] for i in merged], dtype=object)
    count = len(names)
    starts = np.flatnonzero(np.concatenate([[True], names[1:] != names[:-1]]))
    sizes = np.diff(np.append(starts, count))
    seen = np.arange(count) - np.repeat(starts, sizes)
    edge_rows = np.zeros(count, dtype=np.int64)
    edge_rows[starts[0]], edge_rows[starts[-1]] = sizes[0], sizes[-1]
    columns = [pa.array(np.full(count, part, dtype=np.int32)), pa.array(np.arange(count)), pa.array(seen),
               pa.array(edge_rows, mask=edge_rows == 0)]
    yield pa.Table.from_arrays(
        [*columns, *[out[name].combine_chunks() for name in _INDEX.names]],
        names=["part", "place", "seen", "edge_rows", *_INDEX.names]).combine_chunks().to_batches()[0]


def merged_index(runs: DataFrame) -> DataFrame:
    """The runs as one history: ``index_place`` in the whole order, ``capture_no`` among captures of a URL key.

    Both count from 0. Order: URL key (by bytes), time, identifier, null first. A key
    with any number of captures may be cut into several ranges.
    """
    ranges = runs.repartitionByRange("urlkey", "taken", "page_id")
    merged = staged(ranges.mapInArrow(_merge, _MERGED_DDL), "index")
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = merged.groupBy("part").agg(F.count(F.lit(1)).alias("rows")).select(
        "part", F.coalesce(F.sum("rows").over(earlier), F.lit(0)).alias("before"))
    by_key = Window.partitionBy("urlkey").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    edges = merged.filter("edge_rows IS NOT NULL").select(
        "part", "urlkey", F.coalesce(F.sum("edge_rows").over(by_key), F.lit(0)).alias("carried"))
    # at most two rows per range, and one: both broadcasts are bounded by the number of ranges
    return (
        merged.join(F.broadcast(parts), "part").join(F.broadcast(edges), ["part", "urlkey"], "left")
        .withColumn("index_place", F.col("before") + F.col("place"))
        .withColumn("capture_no", F.col("seen") + F.coalesce("carried", F.lit(0)))
        .select("index_place", "capture_no", "urlkey", "taken", "page_id", "file", "offset", "length")
    )


def _read(folder: str):
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = fs.FileSystem.from_uri(folder)
        name, source = None, None
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                if row["file"] != name:
                    name, source = row["file"], store.open_input_file(f"{root}/{row['file']}")
                source.seek(row["offset"])
                record = zlib.decompress(source.read(row["length"]), 31)
                head, _, rest = record.partition(b"\r\n\r\n")
                fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
                block = rest[:int(fields["Content-Length"])]
                if rest[len(block):] != b"\r\n\r\n" or len(block) != int(fields["Content-Length"]):
                    raise ValueError(f"{name} at {row['offset']}: a damaged record")
                http, _, payload = block.partition(b"\r\n\r\n")
                size = int(http.rpartition(b"Content-Length: ")[2])
                digest = base64.b32decode(fields["WARC-Payload-Digest"].removeprefix("sha1:")).hex()
                kind = fields["WARC-Type"]
                if kind == "response" and (len(payload) != size or hashlib.sha1(payload).hexdigest() != digest):
                    raise ValueError(f"{name} at {row['offset']}: the payload is not what was written")
                page, refers = (fields.get(field, "none").strip("<>").rpartition(":")[2]
                                for field in ("WARC-Record-ID", "WARC-Refers-To"))
                out.append((row["file"], row["offset"], None if page == "none" else int(page), size, digest, kind,
                            None if refers == "none" else int(refers), payload if kind == "response" else None))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(values, kind) for values, kind in zip(
                    zip(*out, strict=True), (pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(),
                                             pa.int64(), pa.binary()), strict=True)],
                    names=["file", "offset", "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to",
                           "payload"])

    return read


def read_archives(index: DataFrame, folder: str) -> DataFrame:
    """Records by their place in the archives: identifier, payload, its size and digest, type and what it revisits."""
    files = max(1, index.select("file").distinct().count())
    rows = index.select("file", "offset", "length").repartition(files, "file").sortWithinPartitions("file", "offset")
    return rows.mapInArrow(_read(folder), "file string, offset long, page_id long, payload_bytes long, "
                           "payload_digest string, record_type string, refers_to long, payload binary")
