"""The corpus pipeline: documents without toxic ones, near copies, benchmark passages and secrets, packed into sequences.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor kept; its result is written as Parquet and read
again as the next one's docs. All but the last return the columns of documents; n_chars follows the text where it changes.
Defined results for nulls, ties, repeated rows, empty tables and further columns are those of the operators.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.llm.decontamination import contamination, without
from ledgerlake.llm.near_dedup import near_duplicates
from ledgerlake.llm.packing import pack, padded
from ledgerlake.llm.secrets import redacted, scan
from ledgerlake.llm.storage import stored
from ledgerlake.llm.toxicity import held_out, scored, train

#: The result is made by models, signatures and a tokenizer: no SQL gives it. It is tested against plain versions.
ORACLE_SQL = None


def _tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def _with_text(rows: DataFrame, text: F.Column) -> DataFrame:
    """The columns of `row` with another text, and n_chars to match."""
    columns = rows.schema["row"].dataType.names
    new = {"text": text, "n_chars": F.length(text).cast("long")}
    changed = rows.select(F.col("row"), *(new[c].alias(f"new_{c}") for c in new if c in columns))
    return changed.select(*(F.col(f"new_{c}").alias(c) if c in new else F.col("row")[c].alias(c) for c in columns))


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the model predicts as toxic go."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = train(docs, labels, ~held_out(F.col("doc_id")))
    return scored(docs, model).filter("predicted = 0").select("row.*")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near copies stays: the one with the smallest id, one without id only if none there has an id."""
    # Rows are told apart by a number of their own, so that repeated and missing ids are deduplicated like all others.
    rows = stored(docs.select(F.struct("*").alias("row"), F.monotonically_increasing_id().alias("node")), "numbered", long_rows=True)
    found = near_duplicates(rows.select(F.col("node").alias("doc_id"), "row.text"), words=4, percent=80)
    ids = rows.select("node", F.col("row.doc_id").cast("long").alias("id"))
    members = stored(found.select(F.col("doc_id").alias("node"), "component_id").join(ids, "node"), "members")
    first = members.groupBy("component_id").agg(F.min(F.struct(F.col("id").isNull().alias("without"), "id", "node")).alias("first"))
    copies = stored(members.select("node").join(first.select("first.node"), "node", "left_anti"), "copies")
    return rows.join(copies, "node", "left_anti").select("row.*")


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of the benchmark are cut out; a document that consists of them goes."""
    rows = contamination(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    rows = rows.filter("n_hit = 0 or n_hit < n_words")
    return _with_text(rows, without(F.col("row.text"), F.col("spans")))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are masked."""
    return _with_text(scan(docs), redacted(F.col("row.text"), F.col("spans")))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of 4096 token ids, with the documents that each holds."""
    return padded(pack(docs, _tokenizer()))


STAGES = [
    ("toxicity", toxicity),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("secrets", secrets),
    ("packing", packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline_{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
