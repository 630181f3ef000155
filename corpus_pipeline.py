"""Corpus pipeline: quality filter, exact dedup, SimHash near-dedup, source mixing, best-fit packing.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; its rows, written and read again, are the next
stage's documents. A document is a row; decisions are joined back by id and a hash of the text, so that one id with
two texts is two documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import WORD, save
from tessera.llm.exact_dedup import exact_dedup
from tessera.llm.mixing import mix
from tessera.llm.packing import pack_documents
from tessera.llm.quality import quality_scores
from tessera.llm.queries import TOKENIZER
from tessera.llm.simhash import near_dedup

#: Up to so many (id, hash) pairs, 16 bytes each, are broadcast; more are joined by a shuffle.
BROADCAST_PAIRS = 300_000


def _bounded(pairs: DataFrame) -> DataFrame:
    return F.broadcast(pairs) if pairs.count() <= BROADCAST_PAIRS else pairs


def _with(docs: DataFrame, pairs: DataFrame, how: str) -> DataFrame:
    """Documents, each as one struct column `_doc` so that no names clash, joined with pairs by id and text hash."""
    packed = docs.select(F.struct(*docs.columns).alias("_doc"))
    same = F.col("_doc.doc_id").eqNullSafe(F.col("_id")) & (F.xxhash64("_doc.text") == F.col("_hash"))
    return packed.join(pairs, same, how)


def _only(docs: DataFrame, pairs: DataFrame, how: str) -> DataFrame:
    """The documents that a semi or anti join with pairs leaves."""
    return _with(docs, pairs, how).select("_doc.*")


def _one_each(docs: DataFrame, keys: list[str]) -> DataFrame:
    """Of rows with equal keys the smallest, by all columns."""
    rest = [c for c in docs.columns if c not in keys]
    rows = docs.groupBy(*keys).agg(F.min(F.struct(*rest)).alias("_rest")) if rest else docs.distinct()
    return rows.select(*[F.col(f"_rest.`{c}`").alias(c) if c in rest else F.col(c) for c in docs.columns])


def _decided(docs: DataFrame, decisions: DataFrame, one_of_repeats: bool) -> DataFrame:
    """docs without the rows that decisions (_id, _hash, _kept; a row for each document) reject.

    one_of_repeats: of rows repeated with one id and text, the smallest by all columns stays.
    """
    decisions = save(decisions, "decisions")
    dropped = save(decisions.where("not _kept").select("_id", "_hash").distinct(), "dropped")
    stay = _only(docs, _bounded(dropped), "left_anti")
    if not one_of_repeats:
        return stay
    repeats = decisions.where("_kept").groupBy("_id", "_hash").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    repeats = _bounded(save(repeats.select("_id", "_hash"), "repeats"))
    once = _one_each(_only(stay, repeats, "left_semi"), ["doc_id", "text"])
    return _only(stay, repeats, "left_anti").unionByName(once)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops what the quality classifier rejects."""
    scores = quality_scores(docs)
    return _decided(docs, scores.select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"), F.col("kept").alias("_kept")), False)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the largest doc_id stays."""
    groups = exact_dedup(docs)
    return _decided(docs, groups.select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"), F.col("kept").alias("_kept")), True)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts linked by five-word shingles at a similarity of 0.8 or more the smallest doc_id stays."""
    groups = near_dedup(docs)
    return _decided(docs, groups.select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"), F.col("kept").alias("_kept")), True)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeats, cuts and orders documents as the mix takes them.

    A document of `size` words of which the mix takes q * size + r stays as q whole rows and, for r > 0, a row of its
    first r words (joined by one space, n_chars to match); one that is not taken goes. Rows are written in the order
    of the schedule's slots. Rows repeated with one id, text and source are one document that is taken for all of them.
    """
    keyed = docs.select("doc_id", "text", "source", F.xxhash64("text").alias("_hash"), F.col("source").alias("_source"))
    takes = (
        mix(keyed, carry=("_hash", "_source"))
        .groupBy(F.col("doc_id").alias("_id"), "_hash", "_source", F.col("size").alias("_size"))
        .agg(
            F.sum("taken").alias("_taken"),
            F.count(F.lit(1)).alias("_rows"),
            F.min("first_slot").alias("_first"),
            F.max("pass_slots").alias("_pass"),
        )
        .where("_taken > 0")
    )
    takes = save(takes, "takes")
    repeats = _bounded(save(takes.where("_rows > 1").select("_id", "_hash"), "repeats"))
    once = _only(docs, repeats, "left_anti").unionByName(_one_each(_only(docs, repeats, "left_semi"), ["doc_id", "text", "source"]))
    rows = _with(once, takes, "inner").where(F.col("_doc.source").eqNullSafe(F.col("_source")))
    rows = rows.withColumn("_part", F.expr("explode(sequence(1, _taken div _size + if(_taken % _size > 0, 1, 0)))"))
    cut = F.col("_part") > F.expr("_taken div _size")
    start = F.array_join(F.slice(F.regexp_extract_all("_doc.text", F.lit(WORD), F.lit(0)), F.lit(1), F.expr("cast(_taken % _size as int)")), " ")
    rows = rows.withColumn("_text", F.when(cut, start).otherwise(F.col("_doc.text")))
    new = {"text": F.col("_text"), "n_chars": F.when(cut, F.length("_text").cast("long")).otherwise(F.col("_doc.n_chars"))}
    ordered = rows.orderBy(F.col("_first") + (F.col("_part") - 1) * F.col("_pass"), "_id", "_hash", "_part")
    return ordered.select(*[new.get(c, F.col(f"_doc.`{c}`")).alias(c) for c in docs.columns])


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs the tokens of all documents into sequences of 2048."""
    return pack_documents(docs, TOKENIZER)


STAGES = [
    ("quality classifier", quality),
    ("exact dedup", exact),
    ("SimHash near-dedup", near),
    ("source mixing", mixing),
    ("best-fit packing", packing),
]

#: SQL can express neither the fitted classifier nor the tokenizer; the tests hold the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = save(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
