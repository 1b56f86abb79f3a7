"""The corpus pipeline: documents through five stages, each written and read again.

A stage is a name and a function of (spark, docs, sf_dir); it works on all documents that the one before kept,
and all but the last return the columns of documents.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelkit.llm import line_dedup, mixing, quality_rules, sentencepiece_codec, simhash
from panelkit.llm.queries import domain
from panelkit.sources.staging import stage

# Every domain, language and source weighs the same, and 95 % of the words are taken, once at most.
WEIGHTS, SHARE = {}, 0.95

# Columns that stages use; all others go through under names that no operator has.
USED = ("doc_id", "text", "lang", "source", "n_chars")
Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _own_names(step: Stage) -> Stage:
    """``step``, whose operators never meet further columns of the documents by their names."""

    @wraps(step)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        names = {c: c if c in USED else f"__further{i}" for i, c in enumerate(docs.columns)}
        done = step(spark, docs.select(*[docs[f"`{c}`"].alias(n) for c, n in names.items()]), sf_dir)
        return done.select(*[F.col(n).alias(c) for c, n in names.items()])

    return run


@_own_names
def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    judged = quality_rules.verdicts(quality_rules.ledger(docs, docs.columns))
    return judged.filter("kept").select(*docs.columns)


@_own_names
def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that repeat earlier ones, short ones too, or a copy would leave its heading behind;
    ``n_chars`` follows the text. Documents that lose all their lines are copies of what stays elsewhere and go."""
    rest = line_dedup.dedup_lines(docs, short=True)
    left = rest.filter((F.col("n_dropped") == 0) | F.col("text").rlike(r"\S"))
    return left.withColumn("n_chars", F.length("text").cast("bigint")).select(*docs.columns)


def _row(docs: DataFrame) -> Column:
    """A hash of a row's values and of which are null: rows that repeat an id, or have none, are told apart by it. Maps
    have no hash and are read as JSON."""
    kinds = {f.name: f.dataType.simpleString() for f in docs.schema.fields}
    columns = [docs[c] if "map<" not in kind else F.to_json(F.struct(docs[c])) for c, kind in kinds.items()]
    return F.xxhash64(*columns, *[docs[c].isNull() for c in kinds])


@_own_names
def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near copies: the one with the smallest id, null last; of rows that repeat an id, the
    one with the smallest hash, and of equal rows one."""
    hashed = docs.withColumn("__hash", _row(docs))
    # rows without an id are copies like others, so the operator gets an id that is never null
    place = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", F.col("__hash").alias("hash"))
    verdicts = simhash.near_duplicates(hashed.select(place.alias("doc_id"), "text"))
    rows = verdicts.groupBy(F.col("doc_id.doc_id").alias("__id"), F.col("doc_id.hash").alias("__row"))
    judged = rows.agg(F.bool_and("kept").alias("__kept"), F.count(F.lit(1)).alias("__n"))
    judged = stage(judged.filter("not __kept or __n > 1"), "copies")
    same = hashed["doc_id"].eqNullSafe(F.col("__id")) & (F.col("__hash") == F.col("__row"))
    # only rows that are kept and come again are shuffled with their texts
    once = hashed.join(judged, same, "left_anti")
    again = hashed.join(judged.filter("__kept"), same, "left_semi")
    return once.unionByName(again.dropDuplicates(["doc_id", "__hash"])).select(*docs.columns)


def _leaf(path: Column) -> Column:
    return F.xxhash64(F.to_json(path))


@_own_names
def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the target weights take, as often as they take them. Rows that repeat id, text and leaf are one
    document here, taken as often as all of them together."""
    mixed = mixing.mix(docs.withColumn("domain", domain()), weights=WEIGHTS, share=SHARE)
    key = [F.col("doc_id").alias("__id"), _leaf(F.col("path")).alias("__of"), F.col("row").alias("__row")]
    by_row = mixed.groupBy(*key).agg(F.sum("epochs").alias("__epochs"), F.count(F.lit(1)).alias("__n"))
    # written first, so that its size is known before the texts would be shuffled for the join
    taken = stage(by_row.filter("__epochs > 0"), "taken")
    path = F.array(domain(), *[F.col(c).cast("string") for c in mixing.LEVELS[1:]])
    worded = docs.filter(F.col("text").rlike(r"\S")).withColumns({"__leaf": _leaf(path), "__text": F.md5("text")})
    same = worded["doc_id"].eqNullSafe(F.col("__id")) & (F.col("__leaf") == F.col("__of")) & (F.col("__text") == F.col("__row"))
    kept = worded.join(taken, same)
    again = kept.filter("__n > 1").dropDuplicates(["doc_id", "__leaf", "__text"])
    kept = kept.filter("__n = 1").unionByName(again)
    copies = F.explode(F.sequence(F.lit(1), F.col("__epochs").cast("int")))
    return kept.withColumn("__copy", copies).select(*docs.columns)


def pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of the documents, encoded and decoded again."""
    return sentencepiece_codec.codec_digests(docs, public_tokenizers.path("piece_bpe_32k.model"))


STAGES = [
    ("quality rules", quality),
    ("line dedup", lines),
    ("simhash near-dedup", near_duplicates),
    ("mixing to target weights", mixture),
    ("sentencepiece encoding", pieces),
]
# SimHash needs XXH64, which DuckDB does not have; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; each stage's rows are written to the shared folder and read back."""
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, step) in enumerate(STAGES):
        rows = step(spark, rows, sf_dir)
        rows = stage(rows, f"stage{k}") if k < len(STAGES) - 1 else rows
    return rows
