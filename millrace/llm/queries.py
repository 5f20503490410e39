"""Registered queries of the ten operators: thin, with production parameters, over whole
tables.  Digest columns are derived from the operators' own outputs."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import alignment, bpe, decontaminate, langid, linededup, neighbours, packing, repeats, sharding, simhash, urlrules, warc, whitening
from millrace.scratch import new_path

QUERIES = {}
ORACLES = {}

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
BYTE_RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
LISTED = (
    urlrules.Listed("allow", "org", "/"),
    urlrules.Listed("block", "example.org", "/es/"),
    urlrules.Listed("block", "example.org", "/en/1"),
    urlrules.Listed("allow", "com", "/fr/"),
    urlrules.Listed("block", "com", "/de/"),
)


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_line_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return linededup.dedup(docs).select("doc_id", "n_lines", "n_dropped", "text")


ORACLES["op1_line_templates"] = linededup.ORACLE


@query
def op4_kdtree(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return neighbours.nearest(vectors, vectors.where("vec_id % 50 = 0"), 5)


@query
def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = new_path(spark, "warc")
    warc.write(table(spark, sf_dir, "pages"), root)
    return warc.read(spark, root, payloads=False).select(
        F.col("key").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to")


@query
def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    both = docs.select("doc_id", bpe.round_trip(spark, RANKS, public_tokenizers.PATTERN)("text").alias("x"))
    return both.select("doc_id", bpe.count(F.col("x.ids")).alias("n_tokens"), F.sha2("x.ids", 256).alias("ids_sha256"),
                       F.sha2("x.decoded", 256).alias("decoded_sha256"))


@query
def op7_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    # a page was made from the document whose id ends its path; that document's label is the page's
    made_from = F.expr(r"try_cast(regexp_extract(url, '/([0-9]+)(\\.html)?/?([?#].*)?$', 1) AS BIGINT)")
    labels = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("made_from"), F.expr("toxic = 1 OR quality = 0").alias("blocked"))
    labelled = pages.withColumn("made_from", made_from).join(labels, "made_from")
    return urlrules.judge(pages, "url", LISTED, urlrules.mine(labelled, "url", "blocked"))


@query
def op8_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    predict = langid.learned(docs)
    found = docs.select("doc_id", langid.held_out("doc_id").alias("held_out"), predict("text").alias("found"))
    return found.select("doc_id", "held_out", F.col("found.lang").alias("lang_pred"), F.col("found.score").alias("score"))


@query
def op9_propagation(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = sharding.equal_texts(table(spark, sf_dir, "documents").select("doc_id", "text"))
    links = sharding.star_links(docs, "node", "digest")
    placed = sharding.assign(docs.select("node"), links, 24)
    return docs.join(placed, "node").select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


@query
def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return simhash.groups(docs).select("doc_id", simhash.hexadecimal(F.col("fp")).alias("fingerprint"), "component_id")


@query
def op3_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = repeats.dedup(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return cut.select("doc_id", "n_bytes", (F.col("n_bytes") - F.octet_length("kept")).alias("n_removed"),
                      F.size("starts").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


@query
def op2_latent(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate.find(docs, table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "item_id", "cosine", "lcs", "answered")


@query
def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return alignment.align(spark, docs, BYTE_RANKS, public_tokenizers.PATTERN, PIECES, digest=True)


@query
def op12_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    pieces = packing.pack(spark, docs, BYTE_RANKS, public_tokenizers.PATTERN, {"<|endoftext|>": 50256}, end_id=1)
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


@query
def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"), 4)
