"""From raw documents to token ids: five stages over ``documents``, each written as Parquet and read again.

Each stage takes (spark, docs, sf_dir) and works on all that the one before it kept. All but the last give documents'
columns. With an empty table every stage gives an empty table.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricefold.llm import byte_bpe, decontaminate, ngram_join, quality_rules, quality_vote
from pricefold.llm.common import stored, table
from pricefold.llm.queries import BPE_FILE

NEAR = ngram_join.Rule(words=5, over=4, under=5)


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the labelled neighbours take for good ones."""
    voters = quality_vote.fit(docs, table(spark, sf_dir, "labels"))
    return quality_vote.with_score(docs, voters).where("predicted = 1").select(*docs.columns)


def rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no quality rule rejects, with cutoffs from the labelled ones among them.

    Statistics come first, for the cutoffs, and again where the documents lie: cheaper than moving texts to a verdict."""
    numbers = stored(quality_rules.with_statistics(docs.select("doc_id", "text")).drop("text"), "rules")
    cutoffs = quality_rules.calibrate(numbers.join(table(spark, sf_dir, "labels").select("doc_id", "quality"), "doc_id"))
    judged = quality_rules.judge(quality_rules.with_statistics(docs.select(F.struct("*").alias("row"), "text")), cutoffs)
    # the number keeps the filter above the statistics; pushed below, it would work each of them out anew wherever it occurs
    return judged.withColumn("at", F.monotonically_increasing_id()).where("kept AND at >= 0").select("row.*")


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (five-word shingles, J of 0.8 or more): the one with the smallest id."""
    return ngram_join.one_of_each(docs, ngram_join.link_components(docs, rule=NEAR, content=True))


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that leak no benchmark item."""
    return decontaminate.without_leaks(docs, decontaminate.find_leaks(docs, table(spark, sf_dir, "benchmark")))


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens and the ids (little-endian unsigned 32-bit), with digests of the ids and of the decoded bytes."""
    out = byte_bpe.encode_documents(docs.select("doc_id", "text"), public_tokenizers.path(BPE_FILE), public_tokenizers.PATTERN, decode=True)
    return out.select("doc_id", "n_tokens", "ids", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("quality classifier", quality_classifier),
    ("quality rules", rules),
    ("n-gram Jaccard join", one_of_each),
    ("benchmark decontamination", decontaminated),
    ("byte-level BPE", token_ids),
]

#: SQL can't express the classifier and what follows from it.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
