"""Queries of problems 3, 4 (in ``jet_queries``) and 6 to 8 over documents, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyforge.llm import jet_queries, packing, residue, tokens
from tallyforge.session import cut_lineage, read_table


def p6_ids(spark: SparkSession, sf: str) -> DataFrame:
    """Token ids of every text by byte_bpe_50k."""
    return tokens.encode(read_table(spark, sf, "documents"))


def _packed(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    containers = read_table(spark, sf, "containers")
    docs = read_table(spark, sf, "documents")
    names = [r.tokenizer for r in containers.select("tokenizer").distinct().collect()]  # fixed, a row per container
    sized = [tokens.encode(docs, tokenizer=t, counts_only=True).withColumn("tokenizer", F.lit(t)) for t in sorted(names)]
    every = sized[0]
    for more in sized[1:]:
        every = every.unionByName(more)
    return packing.pack(cut_lineage(every), containers), containers


def p7_packed(spark: SparkSession, sf: str) -> DataFrame:
    """The bin of every text, or of every part of a text that alone exceeds the capacity, in each container."""
    return _packed(spark, sf)[0]


def p7_report(spark: SparkSession, sf: str) -> DataFrame:
    """Bins used per container, and how full they are."""
    return packing.pack_report(*_packed(spark, sf))


def p8_found(spark: SparkSession, sf: str) -> DataFrame:
    """The documents that hold residue."""
    return residue.residue(read_table(spark, sf, "documents")).select("doc_id")


def p8_labels(spark: SparkSession, sf: str) -> DataFrame:
    """The documents that hold residue, with its kinds."""
    return residue.residue(read_table(spark, sf, "documents"))


def p8_kept(spark: SparkSession, sf: str) -> DataFrame:
    """Id and length of the documents that remain."""
    docs = read_table(spark, sf, "documents")
    return residue.without_residue(docs, residue.residue(docs)).select("doc_id", F.length("text").alias("length"))


QUERIES = jet_queries.QUERIES | {f.__name__: f for f in (p6_ids, p7_packed, p7_report, p8_found, p8_labels, p8_kept)}

#: SQL cannot express the queries over documents; the tests compare them with other libraries and brute force.
SQL: dict[str, str] = dict(jet_queries.SQL)
