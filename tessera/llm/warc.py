"""WARC archives and their capture index by external merge.

Archives: one record a page, written by Spark's text writer with the record
separator (two CRLF) as its line separator, gzip-compressed; any store Spark
reaches will do. A page whose payload of ``REVISIT`` bytes or more equals
another's is a revisit record without payload, referring to the record of the
largest ``page_id`` with that payload.

Index: each archive, read back and parsed by its Content-Lengths, gives a run
of captures sorted by URL key, time and page. Runs are cut at sampled range
bounds of that whole key (so one URL with very many captures spans several
ranges); each range merges its slices of all runs with a loser tree. Range and
position give the global order, one URL's captures stand together by time.

Edge cases: a null html is an empty payload; a null URL has an empty key and
no target header; CR and LF in a URL are written as %0D and %0A; rows repeating
the largest page_id of a payload are all responses; a null page_id is a revisit
if another page has its payload; extra columns are ignored; an empty table
gives no capture. A task holds one archive or one range.
"""

from __future__ import annotations

import hashlib
import zlib
from bisect import bisect_right
from urllib.parse import urlsplit

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import materialise, partitions, ship_code

REVISIT = 1000
CRLF = "\r\n"
#: Start of the capture times of tables without one, and keys sampled a range.
EPOCH, SAMPLE = 1_704_067_200, 40

CAPTURE = ("run string, place long, url_key string, captured string, page_id long, url string, record_offset long, record_bytes long, "
           "payload_bytes long, payload_digest string, record_type string, refers_to long")
_KEY = ("url_key", "captured", "page_id")


def capture_time(page_id: Column) -> Column:
    """A time for each page of a table that has none: a second a page_id from 2024 on, as a WARC date."""
    at = F.timestamp_seconds(F.lit(EPOCH) + F.pmod(F.coalesce(page_id, F.lit(0)), F.lit(10 ** 9)))
    return F.date_format(F.to_utc_timestamp(at, F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss'Z'")


def with_revisits(pages: DataFrame, least: int = REVISIT) -> DataFrame:
    """``pages(page_id, url, html)`` with payload_bytes, payload_digest and refers_to (null: a response)."""
    sized = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                         F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"))
    sized = sized.withColumn("payload_bytes", F.octet_length("html").cast("long")).withColumn("payload_digest", F.sha1(F.col("html").cast("binary")))
    shared = (sized.where(F.col("payload_bytes") >= least).groupBy("payload_digest")
              .agg(F.max("page_id").alias("last"), F.count(F.lit(1)).alias("n")).where("n > 1").select("payload_digest", "last"))
    # written first: the planner then knows whether the payloads that repeat fit a broadcast
    shared = materialise(shared, "warc-shared")
    rows = sized.join(shared, "payload_digest", "left")
    other = F.col("page_id").isNull() | (F.col("page_id") != F.col("last"))
    return rows.select("page_id", "url", "html", "payload_bytes", "payload_digest",
                       F.when((F.col("payload_bytes") >= least) & other, F.col("last")).alias("refers_to"))


def record(captured: Column | None = None) -> Column:
    """The text of a row's WARC record, without the two CRLF that end it."""
    revisit = F.col("refers_to").isNotNull()

    def name(page_id):
        return F.concat(F.lit("<urn:page:"), F.coalesce(page_id.cast("string"), F.lit("null")), F.lit(">"))

    def header(key, value):
        return F.concat(F.lit(f"{key}: "), value, F.lit(CRLF))

    nothing = F.lit("")
    url = F.replace(F.replace(F.col("url"), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    block = F.concat(F.lit("HTTP/1.1 200 OK" + CRLF + "Content-Type: text/html; charset=utf-8" + CRLF),
                     header("Content-Length", F.col("payload_bytes").cast("string")), F.lit(CRLF),
                     F.when(revisit, nothing).otherwise(F.col("html")))
    return F.concat(
        F.lit("WARC/1.1" + CRLF), header("WARC-Type", F.when(revisit, F.lit("revisit")).otherwise(F.lit("response"))),
        header("WARC-Record-ID", name(F.col("page_id"))),
        header("WARC-Date", capture_time(F.col("page_id")) if captured is None else captured),
        F.when(F.col("url").isNull(), nothing).otherwise(header("WARC-Target-URI", url)),
        header("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("payload_digest"))),
        F.when(revisit, F.concat(header("WARC-Refers-To", name(F.col("refers_to"))), header(
            "WARC-Profile", F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")))).otherwise(nothing),
        header("Content-Type", F.lit("application/http;msgtype=response")),
        header("Content-Length", F.octet_length(block).cast("string")), F.lit(CRLF), block)


def write_archives(pages: DataFrame, path: str, least: int = REVISIT, captured: Column | None = None) -> None:
    (with_revisits(pages, least).select(record(captured).alias("value"))
     .write.option("lineSep", CRLF * 2).option("compression", "gzip").text(path))


def url_key(url: str | None) -> str:
    """Host parts from the last to the first, then path and query; no scheme, port, user or fragment."""
    if not url:
        return ""
    try:
        parts = urlsplit(url.strip())
        host = (parts.hostname or "").removeprefix("www.")
    except ValueError:
        return url
    return ",".join(reversed(host.split("."))) + ")" + (parts.path or "/") + (f"?{parts.query}" if parts.query else "")


def records(data: bytes):
    """(offset, length, headers, block) of each record of an archive's bytes."""
    at = 0
    while at < len(data):
        end = data.index(b"\r\n\r\n", at)
        first, *lines = data[at:end].decode().split(CRLF)
        if not first.startswith("WARC/"):
            raise ValueError(f"no record at byte {at}")
        headers = {k.lower(): v for k, v in (line.split(": ", 1) for line in lines)}
        n = int(headers["content-length"])
        block = data[end + 4:end + 4 + n]
        if data[end + 4 + n:end + 8 + n] != b"\r\n\r\n":
            raise ValueError(f"the record at byte {at} doesn't end where it says")
        yield at, end + 8 + n - at, headers, block
        at = end + 8 + n


def _page(name: str | None) -> int | None:
    name = (name or "").removeprefix("<urn:page:").removesuffix(">")
    return int(name) if name not in ("", "null") else None


def _rank(capture):
    """Order of captures: URL key, time, page (null first)."""
    key, captured, page = capture
    return key, captured, page is not None, page or 0


def captures(data: bytes, run: str) -> list[tuple]:
    """The sorted run of an archive (columns as in CAPTURE); payloads are checked against their digests."""
    found = []
    for offset, size, headers, block in records(data):
        head, _, payload = block.partition(b"\r\n\r\n")
        digest = headers["warc-payload-digest"].removeprefix("sha1:")
        length = int(dict(x.lower().split(": ", 1) for x in head.decode().split(CRLF)[1:])["content-length"])
        kind = headers["warc-type"]
        if kind == "response" and (len(payload) != length or hashlib.sha1(payload).hexdigest() != digest):
            raise ValueError(f"the payload at byte {offset} of {run} isn't what its headers say")
        url = headers.get("warc-target-uri")
        found.append((url_key(url), headers["warc-date"], _page(headers["warc-record-id"]), url, offset, size, length, digest, kind,
                      _page(headers.get("warc-refers-to"))))
    found.sort(key=lambda c: _rank(c[:3]))
    return [(run, i, *c) for i, c in enumerate(found)]


class LoserTree:
    """Merge of sorted lists by a tournament tree: an inner node keeps the loser of its match, the winner goes up."""

    def __init__(self, runs: list[list], key):
        self.runs, self.key = [r for r in runs if r], key
        self.at = [0] * len(self.runs)
        self.head = [key(r[0]) for r in self.runs]      # None: the run is used up
        n = len(self.runs)
        self.losers = [-1] * n
        self.winner = self._play(1) if n else -1

    def _beats(self, a: int, b: int) -> bool:
        x, y = self.head[a], self.head[b]
        return y is None or (x is not None and (x, a) < (y, b))     # equal keys: the earlier run

    def _play(self, node: int) -> int:
        """Winner below a node; nodes len(runs) and up are the runs."""
        n = len(self.runs)
        if node >= n:
            return node - n
        a, b = self._play(2 * node), self._play(2 * node + 1)
        win, lose = (a, b) if self._beats(a, b) else (b, a)
        self.losers[node] = lose
        return win

    def __iter__(self):
        n = len(self.runs)
        while n and self.head[self.winner] is not None:
            w = self.winner
            yield self.runs[w][self.at[w]]
            self.at[w] += 1
            self.head[w] = self.key(self.runs[w][self.at[w]]) if self.at[w] < len(self.runs[w]) else None
            node = (w + n) // 2
            while node >= 1:
                if self._beats(self.losers[node], w):
                    w, self.losers[node] = self.losers[node], w
                node //= 2
            self.winner = w


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    """The sorted run of captures of each archive under ``path``."""
    def parse(batches):
        import pyarrow as pa

        for batch in batches:
            for name, content in zip(batch.column(0), batch.column(1)):
                inflate, data = zlib.decompressobj(31), []
                rest = content.as_buffer().to_pybytes()
                while rest:                                   # an archive may be several gzip members
                    data.append(inflate.decompress(rest))
                    rest, inflate = inflate.unused_data, zlib.decompressobj(31)
                run = captures(b"".join(data), name.as_py().rpartition("/")[2])
                for low in range(0, len(run), 10_000):
                    yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*run[low:low + 10_000]), kinds())], names=names)

    ship_code(spark)
    names = [c.split()[0] for c in CAPTURE.split(", ")]

    def kinds():
        import pyarrow as pa

        return [{"string": pa.string(), "long": pa.int64()}[c.split()[1]] for c in CAPTURE.split(", ")]

    files = spark.read.format("binaryFile").schema("path string, modificationTime timestamp, length long, content binary").load(path)
    return files.select("path", "content").mapInArrow(parse, CAPTURE)


def merged_index(runs: DataFrame) -> DataFrame:
    """All captures of ``runs`` with index_range and index_place, their global order."""
    spark = runs.sparkSession
    ship_code(spark)
    runs = materialise(runs, "warc-runs")
    ranges, rows = partitions(spark), runs.count()
    # range bounds as in any range partitioning: a bounded sample of keys
    share = min(1.0, SAMPLE * ranges / max(rows, 1))
    sample = sorted(_rank(tuple(r)) for r in runs.select(*_KEY).sample(share, 11).collect())
    bounds = [sample[i * len(sample) // ranges] for i in range(1, ranges)] if sample else []
    names = [c.split()[0] for c in CAPTURE.split(", ")]

    def cut(batches):
        import pyarrow as pa

        for batch in batches:
            keys = zip(*(batch.column(names.index(c)).to_pylist() for c in _KEY))
            yield pa.RecordBatch.from_arrays([pa.array([bisect_right(bounds, _rank(k)) for k in keys], pa.int32()), *batch.columns],
                                             names=["index_range", *names])

    def merge(table):
        import pyarrow as pa

        rows = {n: table[n].to_pylist() for n in ("run", "place", *_KEY)}
        parts: dict[str, list] = {}
        for i in sorted(range(len(rows["run"])), key=lambda i: (rows["run"][i], rows["place"][i])):
            parts.setdefault(rows["run"][i], []).append(i)
        keys = [_rank(k) for k in zip(*(rows[c] for c in _KEY))]
        order = list(LoserTree([parts[r] for r in sorted(parts)], keys.__getitem__))
        return table.take(pa.array(order, pa.int64())).append_column("index_place", pa.array(range(len(order)), pa.int64()))

    return (runs.mapInArrow(cut, f"index_range int, {CAPTURE}").groupBy("index_range")
            .applyInArrow(merge, f"index_range int, {CAPTURE}, index_place long"))
