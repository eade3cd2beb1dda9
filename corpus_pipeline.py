"""A corpus pipeline of five stages over ``documents``: quality, near duplicates,
benchmark leaks, secrets, and encoding.

Each stage takes all that its predecessor kept and returns the columns of ``documents``
(other columns go), but for the last, which returns what encoding gives.  Rows with a
null id are kept by the near duplicates; rows that repeat an id are judged each by its
own text, so that none goes for what another holds; of rows that repeat id and text one
is enough, where the text has words; null and empty texts pass all stages that do not
reject them; very long texts are worked on whole; an empty table passes through.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarrystone.llm import decontaminate, near_dup, piece_bpe, quality, secret_scan
from quarrystone.llm.common import materialise, table

#: Least Jaccard similarity in % at which word shingles make two documents near duplicates here.
NEAR_PERCENT = 80
COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
#: Ids up to which those to leave out are broadcast; more are joined by a shuffle.
BROADCAST_ROWS = 1_000_000


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier predicts to be good."""
    docs = docs.select(*COLUMNS)
    model = quality.fit_on(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    scored = quality.score(docs, model, keep=COLUMNS)
    return scored.where("predicted = 1").select(*COLUMNS)


def keep_one_of_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near duplicates (``NEAR_PERCENT`` or more): the one with the smallest id."""
    docs = docs.select(*COLUMNS)
    row = "doc_id"
    if docs.where("doc_id is not null").groupBy("doc_id").count().where("count > 1").limit(1).count():
        # ids that repeat name no row: rows are numbered in the order of their ids
        row = "_row"
        # by their place, too, so that a row that very many repeat is no single task
        order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text"), F.col(row)]
        dealt = docs.withColumn(row, F.monotonically_increasing_id()).repartitionByRange(*order).sortWithinPartitions(*order)
        docs = materialise(spark, dealt.withColumn(row, F.when(F.col("doc_id").isNotNull(), F.monotonically_increasing_id())))
    found = materialise(spark, near_dup.near_duplicates(docs.select(F.col(row).alias("doc_id"), "text"), NEAR_PERCENT))
    gone = found.where("not kept").select(F.col("doc_id").alias(row))
    gone = F.broadcast(gone) if gone.count() <= BROADCAST_ROWS else gone
    return docs.join(gone, row, "left_anti").select(*COLUMNS)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.drop_contaminated(docs.select(*COLUMNS), table(spark, sf_dir, "benchmark"))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with a placeholder for each secret and ``n_chars`` of the new text."""
    out = secret_scan.redact(secret_scan.scan_secrets(docs.select(*COLUMNS)))
    changed = F.size("secret_spans") > 0
    return out.withColumn("n_chars", F.when(changed, F.char_length("text").cast("long")).otherwise(F.col("n_chars"))).select(*COLUMNS)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of each document, their digests, and the digest of the decoded text."""
    return piece_bpe.encode_texts(docs, piece_bpe.default_model())


STAGES = [
    ("quality classifier", keep_good),
    ("near duplicates", keep_one_of_near),
    ("benchmark decontamination", drop_leaks),
    ("secret scan", redact_secrets),
    ("piece encoding", encode),
]

#: No SQL states a fitted classifier, latent retrieval or piece encoding.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(spark, stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
