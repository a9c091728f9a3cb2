"""Registered queries of the training-data operators, with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import materialise, table
from tessera.llm.filter_audit import ORACLE_SQL as AUDIT_SQL
from tessera.llm.fim import ORACLE_SQL as FIM_SQL
from tessera.llm.lm_score import ORACLE_SQL as LM_SQL
from tessera.session import scratch_path


def vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_stupid_backoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stupid-backoff score of every document under the counts of all others."""
    from tessera.llm.lm_score import MICRO, score_documents

    scored = score_documents(table(spark, sf_dir, "documents"))
    used = [F.get("used", F.lit(i)).alias(n) for i, n in enumerate(("unseen", "unigrams", "bigrams", "trigrams"))]
    # the same division of whole numbers as in the SQL
    mean = F.round(F.col("log_score") * MICRO) / MICRO / F.col("n_words")
    return scored.select("doc_id", "n_words", "log_score", F.when(F.col("n_words") > 0, mean).alias("mean_log_score"), *used)


def op2_repair_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of all documents written as Re-Pair shards and read back."""
    from tessera.llm.repair import read_tokens, write_tokens

    path = scratch_path(spark, "tokens")
    write_tokens(table(spark, sf_dir, "documents"), path, vocabulary("word_bpe_49k.json"), end_id=1)
    return read_tokens(spark, path).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op3_va_file_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact top 5 by integer inner product for every vector whose id is divisible by 50, against all."""
    from tessera.llm.va_search import top_k

    vectors = table(spark, sf_dir, "embeddings")
    return top_k(vectors, vectors.where(F.col("vec_id") % 50 == 0))


def op4_warc_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages written as WARC records, read back, and merged into one capture index."""
    from tessera.llm.warc import merged_index, read_runs, write_archives

    path = scratch_path(spark, "warc")
    write_archives(table(spark, sf_dir, "pages"), path)
    return merged_index(read_runs(spark, path)).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url_key", "captured", "index_range", "index_place")


def op5_sequence_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of at most 1024 tokens."""
    from tessera.llm.packing import pack_documents

    pieces = pack_documents(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"), end_id=0, roomy=True)
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op6_pruned_graph_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links of cosine 0.95 and more between all vectors, and their components."""
    from tessera.llm.ann_dedup import near_duplicates

    return near_duplicates(table(spark, sf_dir, "embeddings"))


def op7_ppm_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document by PPM code length, learned from the documents not held out."""
    from tessera.llm.ppm import held_out, predict, train

    docs = table(spark, sf_dir, "documents")
    return predict(docs, train(docs)).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "bits_per_byte")


def op8_pivotal_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Copies of all documents that bring the sources to their target words."""
    from tessera.llm.mixing import mix

    return mix(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "copies")


def op9_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and one of control strings, formatted, written, and read back."""
    from tessera.llm.chat import format_conversations, loss_text, read_turns, text_parts

    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    control = "</s>[INST] ok [/INST]"
    probe = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
                                  F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(control).alias("text"))
    messages = rows.unionByName(probe).withColumn("parts", text_parts(F.col("text"))).drop("text")
    out = materialise(format_conversations(messages), "chat")
    out = out.withColumn("turns", read_turns(F.col("formatted"))).withColumn("loss", loss_text(F.col("formatted"), F.col("loss_spans")))
    said = F.concat_ws("", F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["content"], F.lit("\n"))))
    return out.select("conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(said, 256).alias("turns_sha256"),
                      F.length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"),
                      F.length("formatted").cast("long").alias("formatted_chars"), "expanded_tokens")


def op10_simhash_popcount(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash fingerprint and near-duplicate component of every document."""
    from tessera.llm.simhash import near_duplicates

    return near_duplicates(table(spark, sf_dir, "documents"))


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What five text filters remove, alone and in every order, in each language of all documents."""
    from tessera.llm.filter_audit import audit, checked

    return audit(checked(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")))


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents cut into prefix, middle and suffix, put in order, and put together again."""
    from tessera.llm.fim import fill_in_middle, restored

    out = fill_in_middle(table(spark, sf_dir, "documents"))
    return out.select("row.doc_id", "n", "form", F.col("prefix_end").alias("prefix_chars"), (F.col("middle_end") - F.col("prefix_end")).alias("middle_chars"),
                      F.sha2("output", 256).alias("output_sha256"), F.sha2(restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"))


def op13_token_cache(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts of all documents through a new digest cache."""
    from tessera.llm.token_cache import count_tokens

    counted = count_tokens(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"), scratch_path(spark, "token-cache"))
    return counted.select("row.doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > 1024).alias("over_limit"))


QUERIES = {f.__name__: f for f in (
    op1_stupid_backoff, op2_repair_tokens, op3_va_file_search, op4_warc_index, op5_sequence_packing, op6_pruned_graph_dedup, op7_ppm_language, op8_pivotal_mixing,
    op9_chat_format, op10_simhash_popcount,
    op11_filter_audit, op12_fill_in_middle, op13_token_cache)}
ORACLE: dict[str, str] = {"op1_stupid_backoff": LM_SQL, "op11_filter_audit": AUDIT_SQL, "op12_fill_in_middle": FIM_SQL}
