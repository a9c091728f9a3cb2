"""Token counts through a digest cache.

The cache is a Parquet table of ``(tokenizer, content, n_tokens)``, partitioned
by ``tokenizer``: the digest of the library, its version and the vocabulary
file. ``content`` is the digest of a text as the tokenizer's own normalizer
leaves it (of the text itself where there is none, or where an added token
stands in it, which is looked for before normalizing). Equal digests have
equal ids, so a text is encoded only if its digest has no stored count, and
once however many rows hold it; what was encoded is appended to the cache.

Digests are taken in the scan and written; the distinct ones are joined to the
stored counts. Texts move only for misses: if these are few (``BROADCAST``
bytes, measured) they are sent to the scan, otherwise copies meet within their
task before the shuffle by digest. Counts go back to the rows with
``spread_join``, so that a text that fills a third of the table is no hot task.
An append is complete or absent file by file, each row of it is right on its
own, and rows stored twice (two runs at once, a run that failed half way) are
taken once, so a lost executor or driver costs only encoding.

Special strings inside texts are handled as the library does by default;
nothing is added, cut off or padded. Edge cases: a null text is empty (no bytes
or tokens); repeated rows get equal results; kept columns may have any name; an
empty table gives no row and stores nothing; a long text is encoded whole.
"""

from __future__ import annotations

import hashlib
import os
from importlib.metadata import version as library_version

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.common import materialise, ship_code, spread_join

SCHEMA = "content binary, n_tokens long, tokenizer string"
#: Bytes of missing digests up to which they are broadcast (with their overhead in a hash table).
BROADCAST, DIGEST_BYTES = 16 << 20, 96
#: Characters that are encoded at a time.
SLICE = 1 << 19


class Counter:
    """Counts and normalized content of a vocabulary file: ``.json`` by tokenizers, ``.model`` by sentencepiece."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"   # Spark runs one task a core
        self.json = path.endswith(".json")
        if self.json:
            from tokenizers import Tokenizer

            self.model = Tokenizer.from_file(path)
            self.model.no_truncation()
            self.model.no_padding()
            self.added = [t.content for t in self.model.get_added_tokens_decoder().values()]
        else:
            from sentencepiece import SentencePieceProcessor

            self.model = SentencePieceProcessor(model_file=path)

    @property
    def normalizes(self) -> bool:
        return not self.json or self.model.normalizer is not None

    def digest(self, text: str) -> bytes:
        if not self.json:
            return hashlib.sha256(self.model.normalize(text).encode()).digest()
        plain = self.model.normalizer.normalize_str(text) if self.normalizes else text
        if plain != text and any(t in text or t in plain for t in self.added):
            return hashlib.sha256(b"\xff" + text.encode()).digest()     # no text starts with this byte
        return hashlib.sha256(plain.encode()).digest()

    def counts(self, texts: list[str]) -> list[int]:
        if not self.json:
            return [len(x) for x in self.model.encode(texts, num_threads=1)]
        return [len(e) for e in self.model.encode_batch_fast(texts, add_special_tokens=False)]


_counters: dict[str, Counter] = {}


def counter(path: str) -> Counter:
    """The worker's counter of a vocabulary file (kept between tasks)."""
    if path not in _counters:
        _counters[path] = Counter(path)
    return _counters[path]


def tokenizer_version(path: str) -> str:
    """Digest of what decides a text's tokens: library, its version, vocabulary file."""
    library = "tokenizers" if path.endswith(".json") else "sentencepiece"
    h = hashlib.sha256(f"{library} {library_version(library)}\n".encode())
    with open(path, "rb") as f:
        h.update(f.read())
    return h.hexdigest()


def slices(texts: list[str], most: int = SLICE):
    """Runs ``(low, high)`` of texts of about ``most`` characters, one text at least."""
    low = held = 0
    for i, t in enumerate(texts):
        held += len(t)
        if held >= most:
            yield low, i + 1
            low, held = i + 1, 0
    if low < len(texts):
        yield low, len(texts)


def stored_counts(spark: SparkSession, cache: str, tokenizer: str) -> DataFrame:
    """``content, n_tokens`` that the cache holds for a tokenizer version, each digest once; makes the cache if there is none."""
    spark.createDataFrame([], SCHEMA).write.mode("append").partitionBy("tokenizer").parquet(cache)
    held = spark.read.schema(SCHEMA).parquet(cache).where(F.col("tokenizer") == tokenizer)
    return held.groupBy("content").agg(F.max("n_tokens").alias("n_tokens"))


def with_digest(docs: DataFrame, path: str, keep: tuple[str, ...]) -> DataFrame:
    """``row`` (struct of ``keep``), ``content``, ``text`` of every row."""
    rows = docs.select(F.struct(*keep).alias("row"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    if not counter(path).normalizes:
        return rows.select("row", F.unhex(F.sha2(F.col("text").cast("binary"), 256)).alias("content"), "text")

    def run(batches):
        import pyarrow as pa

        own = counter(path)
        for batch in batches:
            for low in range(0, batch.num_rows, 256):
                some = batch.slice(low, 256)
                digests = [own.digest(t) for t in some.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([some.column(0), pa.array(digests, pa.binary()), some.column(1)], names=["row", "content", "text"])

    return rows.mapInArrow(run, T.StructType([rows.schema["row"]]).add("content", "binary").add("text", "string"))


def encoded(texts: DataFrame, path: str) -> DataFrame:
    """``content, n_tokens`` of ``texts(content, text)``."""
    def run(batches):
        import pyarrow as pa

        own = counter(path)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                some = batch.slice(at, 256)
                rows = some.column(1).to_pylist()
                n = [k for low, high in slices(rows) for k in own.counts(rows[low:high])]
                yield pa.RecordBatch.from_arrays([some.column(0), pa.array(n, pa.int64())], names=["content", "n_tokens"])

    return texts.mapInArrow(run, "content binary, n_tokens long")


def count_tokens(docs: DataFrame, tokenizer: str, cache: str, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Columns ``row`` (struct of ``keep``), ``n_bytes`` and ``n_tokens`` of every row of ``docs(text, ...)``.

    ``tokenizer``: vocabulary file (at the same place on every machine); ``cache``: path of the cache, shared by all machines.
    """
    spark = docs.sparkSession
    ship_code(spark)
    version = tokenizer_version(tokenizer)
    digested = with_digest(docs, tokenizer, keep)
    named = materialise(digested.select("row", "content", F.octet_length("text").cast("long").alias("n_bytes")), "token-digests")
    asked = named.select("content").distinct()
    missing = materialise(asked.join(stored_counts(spark, cache, version), "content", "left_anti"), "token-misses")
    n = missing.count()
    if n:
        texts = digested.select("content", "text")
        few = n * DIGEST_BYTES <= BROADCAST
        if few:
            texts = texts.join(F.broadcast(missing), "content", "left_semi")
        once = texts.groupBy("content").agg(F.first("text").alias("text"))      # copies meet in their task first
        if not few:
            once = once.join(missing, "content", "left_semi")
        encoded(once, tokenizer).withColumn("tokenizer", F.lit(version)).write.mode("append").partitionBy("tokenizer").parquet(cache)
    return spread_join(named, stored_counts(spark, cache, version), "content").select("row", "n_bytes", "n_tokens")
