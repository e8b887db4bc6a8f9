"""The corpus pipeline: five operators in a row over the table of documents.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read
again as the documents of the next. All but the last return the columns of the documents.

Rows without an id or text pass the filters. An empty table stays empty.
"""

from __future__ import annotations

from collections.abc import Iterable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablestream.llm import bpe, minhash, mixing, repeats, toxicity
from tablestream.llm.common import held_out, n_words, read
from tablestream.session import run_dir


def _free(docs: DataFrame, name: str) -> str:
    """A column name that the documents don't have."""
    while name in docs.columns:
        name = f"_{name}"
    return name


def _apart(docs: DataFrame, names: Iterable[str]) -> tuple[DataFrame, dict[str, str]]:
    """The documents with other names for columns that an operator would replace, and the way back."""
    other = {name: _free(docs, name) for name in names if name in docs.columns}
    return docs.withColumnsRenamed(other), {new: old for old, new in other.items()}


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is below 0.5, by a model of the labels that op1 learns from."""
    labels = read(spark, sf_dir, "labels").filter(~held_out(F.col("doc_id"), 5, 0))
    model = toxicity.fit(docs, labels)
    rows, back = _apart(docs, toxicity.NEW)
    return toxicity.score(rows, model).filter("toxic_score < 0.5").select(*rows.columns).withColumnsRenamed(back)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row, of the least document, of each group of near-duplicates; one of rows that are repeated.

    Rows count by id and text: another text under the id of a copy stays."""
    key = _free(docs, "_key")
    text = F.xxhash64("text")
    found = minhash.near_duplicates(docs.select("doc_id", "text", text.alias(key)), carry=key)
    stays = found.filter("kept AND group IS NOT NULL").groupBy(F.col("group").alias("_of")).agg(F.min(key).alias("_stays"))
    # All rows of a group but the one that stays; rows without shingles are in no group.
    gone = found.join(stays, F.col("group") == F.col("_of")).filter(~F.col("kept") | (F.col(key) != F.col("_stays")))
    gone = gone.select("doc_id", key).distinct()
    kept = docs.withColumn(key, text).join(gone, ["doc_id", key], "left_anti").select(*docs.columns)
    if kept.groupBy("doc_id").count().filter("count > 1 AND doc_id IS NOT NULL").isEmpty():
        return kept
    single = kept.filter("doc_id IS NOT NULL").dropDuplicates(["doc_id", "text"])
    return single.unionByName(kept.filter("doc_id IS NULL"))


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages that also stand in earlier documents."""
    rows, back = _apart(docs, repeats.NEW)
    cut = repeats.without_repeats(rows)
    if "n_chars" in docs.columns:
        shorter = F.col("n_removed") > 0
        kind = docs.schema["n_chars"].dataType
        cut = cut.withColumn("n_chars", F.when(shorter, F.length("text")).otherwise(F.col("n_chars")).cast(kind))
    return cut.select(*rows.columns).withColumnsRenamed(back)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    # Numbered once, in a table: both uses below must see the same numbers.
    row, copy = _free(docs, "_row"), _free(docs, "_copy")
    path = run_dir(spark, "numbered")
    docs.withColumn(row, F.monotonically_increasing_id()).write.parquet(path)
    rows = spark.read.parquet(path)
    narrow = rows.select(F.col(row).alias("row"), "doc_id", "source", n_words(F.col("text")).alias("size"))
    taken = mixing.mix(narrow, F.col("size")).filter("copies > 0").select(F.col("row").alias(row), F.col("copies").alias(copy))
    again = F.explode(F.sequence(F.lit(1), F.col(copy)))
    return rows.join(taken, row).withColumn(copy, again).select(*docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, and whether they decode to its bytes."""
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    encoded = bpe.encode(docs.select("doc_id", "source", "text"), ranks, public_tokenizers.PATTERN)
    same = bpe.decoded(F.col("ids"), ranks) == F.coalesce("text", F.lit("")).cast("binary")
    return encoded.select(
        "doc_id", "source", F.size("ids").cast("long").alias("n_tokens"), "ids", same.alias("decodes")
    )


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("repeated_passages", cut_repeats),
    ("mixture", mix_sources),
    ("byte_bpe", encode),
]

#: Learned scores and fitted rates have no counterpart in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = run_dir(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
