"""A corpus pipeline of five operators; every stage works on all rows that the stage before has kept."""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kerbsight.llm import huffman, mixing, ngram_jaccard, quality, simhash_scan
from kerbsight.llm.store import Scratch, is_small
from kerbsight.session import scratch_root

c = F.col
TOKENIZER = "word_bpe_49k.json"
#: fewer than the operator's own, as the executors' heaps have grown in the stages before
CACHED_WORDS = 250_000


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the classifier, fitted on the labelled ones among them, does not reject."""
    return quality.keep_good(docs, _table(spark, sf_dir, "labels"))


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near copies: the one with the smallest doc_id (null last), then text, source and other columns.

    Groups are groups of rows: rows with the same doc_id, or with none, are documents of their own, and a row without a near
    copy stays whatever its doc_id. Rows without words stay. Where a doc_id names one row only, it decides about the row;
    rows with repeated or null ids are told apart by the names of their shingle sets."""
    scratch = Scratch(spark)
    members, roots = ngram_jaccard.jaccard_links(docs)
    named = members.where("sig is not null").join(roots, "sig", "left").withColumn("root", F.coalesce("root", "sig"))
    groups = named.groupBy("root").agg(F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("times")).where("times > 1")
    copies = scratch.keep(named.join(groups, "root").select("doc_id", "sig", "root", "least"), "near-copies")
    found, seen = scratch.keep(copies.where(c("doc_id") != c("least")).select("doc_id").distinct(), "copied-ids", rows=F.count(F.lit(1)))
    found = F.broadcast(found) if is_small(seen["rows"], 16) else found
    repeated = docs.where("doc_id is not null").groupBy("doc_id").agg(F.count(F.lit(1)).alias("times")).where("times > 1").select("doc_id")
    repeated, seen = scratch.keep(repeated, "repeated-ids", rows=F.count(F.lit(1)))
    if not seen["rows"] and not members.where("doc_id is null").head(1):
        return docs.join(found, "doc_id", "left_anti").select(docs.columns)
    repeated = F.broadcast(repeated) if is_small(seen["rows"], 16) else repeated
    single = docs.where("doc_id is not null").join(repeated, "doc_id", "left_anti").join(found, "doc_id", "left_anti").select(docs.columns)
    shared = docs.join(repeated, "doc_id", "left_semi").select(docs.columns).unionByName(docs.where("doc_id is null"))
    sets = copies.select(c("sig").alias("_sig"), c("root").alias("_root"), c("least").alias("_least")).distinct()
    shared = ngram_jaccard.with_set_names(shared, "_sig").join(sets, "_sig", "left")
    alone = shared.where("_root is null").select(docs.columns)
    row = F.struct("text", "source", *[x for x in docs.columns if x not in ("text", "source")])
    first = shared.where(c("_root").isNotNull() & c("doc_id").eqNullSafe(c("_least"))).groupBy("_root").agg(F.min(row).alias("_row"))
    return single.unionByName(alone).unionByName(first.select("_row.*").select(docs.columns))


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that hold no passage of the benchmark."""
    return simhash_scan.without_benchmark(docs, _table(spark, sf_dir, "benchmark"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: a row for each time that a document is taken, its text cut to the words taken where a target ends.

    Documents that the mix does not take leave; those that it takes twice are there twice."""
    return mixing.mixed_documents(docs)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix as token ids in the binary format, and what reading the files back gives for every document."""
    files = f"{scratch_root(spark)}/kerbsight/token-files-{uuid.uuid4().hex}"
    huffman.write_ids(docs, public_tokenizers.path(TOKENIZER), files, CACHED_WORDS)
    return huffman.id_digests(spark, files)


STAGES = [
    ("quality", good_quality),
    ("near duplicates", one_of_each_group),
    ("decontamination", without_benchmark),
    ("mixing", mixed),
    ("token ids", token_ids),
]

#: The classifier's fit and the tokenizer are beyond SQL; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written and read again as the next stage's documents."""
    scratch = Scratch(spark)
    docs = _table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = scratch.keep(stage(spark, docs, sf_dir), f"pipeline-{k}")
    return docs
