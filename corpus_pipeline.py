"""Corpus pipeline: language ID, SimHash near-dedup, mixing, packing.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and
returns a DataFrame, which is written as Parquet and reread as the next one's
``docs``. Every stage works on all that its predecessor kept and returns the
columns of ``documents``; the last returns packed pieces. Nulls, empty texts,
repeated rows, extra columns and empty tables are treated as each operator's
docstring says; rows keep their columns and, where nothing removes them, their
repetitions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
#: Bits a byte under the best language from which a text is in none of them. Running text takes 2 to 3, random letters and digits 6 and more.
FOREIGN_BITS = 6.0
#: Bytes that a text is judged by at least; they must also be half of the text's.
JUDGED_BYTES = 64


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Out go the texts without a letter and those that no language compresses.

    The rate is that of the bytes that say something: not the first three, and
    not those of characters that no learned text holds. A text too short to
    judge, or written mostly in such characters, stays, and so does one of which
    more than half of the words are below the rate (a sentence with a key in it);
    so does any text with a letter if nothing could be learned.
    """
    from tessera.llm.ppm import predict, train

    own = docs.select(*COLUMNS)
    learned = train(own)
    if learned is None:
        return own.where(F.col("text").cast("string").rlike(r"\p{L}"))
    found = predict(own, learned, keep=COLUMNS, evidence=FOREIGN_BITS)
    judged = (F.col("judged_bytes") >= JUDGED_BYTES) & (2 * F.col("judged_bytes") >= F.col("n_bytes"))
    foreign = judged & (F.col("judged_bits") >= FOREIGN_BITS * F.col("judged_bytes")) & (F.col("dear_words") >= 0.5)
    return found.where((F.col("lang_pred") != "und") & ~foreign).select(*COLUMNS)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each SimHash component: that of the smallest doc_id (of rows repeating it, or if all ids are null, the one of least name).

    A row's name is the hash of its columns, so rows of one name are the same. Winners are found among names;
    whole texts move once, to meet them, and only repeats of winners meet each other.
    """
    from tessera.llm.common import materialise
    from tessera.llm.simhash import near_duplicates

    named = docs.select(*COLUMNS).withColumn("doc_id", F.col("doc_id").cast("long")).withColumn("key", F.xxhash64(*COLUMNS))
    found = materialise(near_duplicates(named, keep=("doc_id", "key"), named=True), "dedup-components")
    first = found.groupBy("component_fp").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "key")).alias("m"))
    repeated = found.groupBy("key").agg(F.count(F.lit(1)).alias("rows")).where("rows > 1")
    winners = first.select(F.col("m.key").alias("key"))
    # tables of their own: Spark knows their sizes, and sends the few repeated names to the texts
    once = materialise(winners.join(repeated, "key", "left_anti"), "dedup-once")
    several = materialise(winners.join(repeated, "key", "left_semi"), "dedup-several")
    kept = named.join(once, "key", "left_semi")
    again = named.join(several, "key", "left_semi").dropDuplicates(["key"])
    return kept.select(*COLUMNS).union(again.select(*COLUMNS))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it; only repeated rows are numbered."""
    from tessera.llm.common import materialise
    from tessera.llm.mixing import mix, numbered, row_names

    own = docs.select(*COLUMNS)
    copies = materialise(mix(own).select("key", "n", "copies"), "mixing-copies")
    repeated = copies.where("n > 1").select("key").distinct()
    named = row_names(own)
    once = named.join(copies.where("copies > 0").join(repeated, "key", "left_anti").drop("n"), "key")
    many = numbered(named.join(repeated, "key", "left_semi")).join(copies.where("copies > 0"), ["key", "n"])
    rows = once.select(*COLUMNS, "copies").union(many.select(*COLUMNS, "copies"))
    return rows.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))).select(*COLUMNS)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of at most 1024 tokens."""
    from tessera.llm.packing import pack_documents
    from tessera.llm.queries import vocabulary

    return pack_documents(docs, vocabulary("byte_bpe_50k.json"), end_id=0)


STAGES = [("language ID", language), ("SimHash near-dedup", near_dedup), ("mixing sources", mixing), ("packing", packing)]

#: Dependent rounding, code lengths and packing can't be written in SQL; tests/llm holds run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    from tessera.llm.common import materialise, table

    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        out = stage(spark, docs, sf_dir)
        docs = out if i == len(STAGES) - 1 else materialise(out, f"pipeline-{i}")
    return docs
