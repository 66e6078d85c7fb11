"""Documents on their way to training sequences: five stages, each written and read again.

Toxic documents go; of near-duplicates one stays; documents that hold benchmark items go; personal
data is replaced by its kind; what is left is packed into sequences.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from depotstar.llm import decontaminate, packing, pii, simhash, toxicity
from depotstar.llm.common import table
from depotstar.llm.queries import tokenizer_file
from depotstar.session import stage


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity is below 0.7; the model is fitted on the labels of `docs`."""
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    own = "_" + max([*docs.columns, "score"], key=len)  # no column has this name
    return toxicity.score(docs, model, own).where(F.col(f"`{own}`") < 0.7).select(*docs.columns)


def _numbered(docs: DataFrame) -> tuple[DataFrame, str]:
    """`docs` staged with a column that numbers its rows, and the name of that column."""
    own = "_" + max([*docs.columns, "row"], key=len)  # no column has this name
    return stage(docs.withColumn(own, F.monotonically_increasing_id()), "numbered"), own


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group at two bits of three-word fingerprints, one row: that of the smallest doc_id.

    Rows with equal doc_id, or none, are told apart by their number; those without doc_id are last.
    """
    rows, own = _numbered(docs)
    rank = F.struct(
        F.col("doc_id").isNull().alias("unnamed"), F.col("doc_id").alias("doc_id"), F.col(own).alias("row")
    )
    groups = simhash.near_duplicates(
        rows.select(rank.alias("rank"), "text"), shingle=3, max_distance=2, id_column="rank"
    )
    gone = groups.where("id.row <> component_id.row").select(F.col("id.row").alias(own))
    return rows.join(gone, own, "left_anti").select(*docs.columns)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that hold no benchmark item; each is judged by its own text, whatever its doc_id.

    Rows go by a digest of their text, so equal texts are one document.
    """
    items = table(spark, sf_dir, "benchmark")
    own = "_" + max([*docs.columns, "digest"], key=len)  # no column has this name
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.withColumn(own, F.unhex(F.sha2(text.cast("binary"), 256)))
    bad = decontaminate.contained(rows, items, shingle=5, threshold=0.8, id_column=own)
    return rows.join(bad.select(F.col("doc").alias(own)).distinct(), own, "left_anti").select(*docs.columns)


def redact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by its kind; n_chars is that of the new text."""
    given = pii.redact(docs)
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        given = given.withColumn("n_chars", F.char_length("text").cast(kind))
    return given.select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences of 2048 tokens."""
    return packing.pack(docs, tokenizer_file("byte_bpe_50k.json"), capacity=2048)


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash_near_dedup", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("pii", redact),
    ("packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of `sf_dir`, each written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)


#: Learned scores, fingerprints and packing are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None
