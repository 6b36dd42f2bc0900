"""The corpus pipeline: toxicity, near duplicates, repeated passages, benchmark passages, packing.

Each stage takes the documents that the one before kept and returns the same columns, the last one
the pieces of packed sequences. Between stages the documents are a Parquet table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import MapType, VariantType

from shoprec.llm.common import spool, table
from shoprec.llm.decontamination import contamination
from shoprec.llm.jaccard import jaccard_components
from shoprec.llm.packing import pack
from shoprec.llm.suffix_dedup import remove_repeats
from shoprec.llm.toxicity import learn, without_toxic

#: Words of a shingle and percent of similarity from which documents are near duplicates.
SHINGLE, SIMILAR = 5, 80
TOKENIZER = "byte_bpe_50k.json"


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier chain does not reject.

    A text's probability decides, so rows with equal texts, repeated or null ids go or stay alike; a
    null or empty text is judged as one without words. An empty table gives an empty one.
    """
    return without_toxic(docs, learn(docs, table(spark, sf_dir, "labels")))


_KEY, _ROW = "__row_key_of_stage", "__row_of_stage"


def keyed(docs: DataFrame) -> DataFrame:
    """The rows with a key of their id and text. Decisions depend on nothing else, so rows
    with a null or repeated id are told apart, and rows equal in both are judged alike."""
    return docs.withColumn(_KEY, F.xxhash64(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), "text"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of similar documents, one with the smallest id, a null id last.

    Documents without words are similar to nothing and stay. Of rows equal in id and text that one
    stays whose other columns come first in order; those without id and words are no repeats
    of each other and all stay. An empty table gives an empty one.
    """
    rows = keyed(docs)
    found = jaccard_components(rows, n=SHINGLE, percent=SIMILAR, id_col=_KEY)
    named = (
        found.select(F.col("doc_id").alias(_KEY), F.col("component_id").alias("group")).distinct()
        .join(rows.select(_KEY, "doc_id").distinct(), _KEY)
    )
    first = F.min(F.struct(F.col("doc_id").isNull().alias("nameless"), F.col("doc_id"), F.col(_KEY).alias("key")))
    kept = named.groupBy("group").agg(first.alias("first")).select(F.col("first.key").alias(_KEY))
    blank = F.col("doc_id").isNull() & ~F.coalesce(F.col("text"), F.lit("")).rlike(r"[^\x20\x09-\x0D]")
    # Repeats are folded in each task before they meet, so a row that comes very often is a few rows there.
    others = [f.name for f in docs.schema if f.name not in ("doc_id", "text") and not isinstance(f.dataType, (MapType, VariantType))]
    whole = F.struct(*docs.columns)
    single = rows.where(~blank).groupBy(_KEY).agg(
        (F.min_by(whole, F.struct(*others)) if others else F.first(whole)).alias(_ROW)
    )
    one = single.join(kept, _KEY).select(*[F.col(_ROW)[c].alias(c) for c in docs.columns])
    return one.unionByName(rows.where(blank).select(*docs.columns))


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the bytes of strings of 200 bytes that occur elsewhere too.

    Every row stays, with what is left of its text; `n_chars` follows. A null text counts as empty
    and becomes it. Repeated rows lose what they share, each of them. An empty table gives an empty one.
    """
    others = [c for c in docs.columns if c not in ("text", "n_chars")]
    cut = remove_repeats(docs, length=200, carry=others)
    made = {"text": F.col("kept")}
    if "n_chars" in docs.columns:
        made["n_chars"] = F.char_length("kept").cast(docs.schema["n_chars"].dataType)
    return cut.select(*[(made[c] if c in made else F.col("carried")[c]).alias(c) for c in docs.columns])


def benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item in a half or more of its words.

    Rows are judged by id and text: equal ones alike, those that share an id or have none each for
    itself. A null or empty text holds nothing and stays. An empty table gives an empty one.
    """
    rows = keyed(docs)
    found = contamination(rows, table(spark, sf_dir, "benchmark"), id_col=_KEY)
    hit = found.select(F.col("doc_id").alias(_KEY)).distinct()
    return rows.join(hit, _KEY, "left_anti").select(*docs.columns)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents and their places in sequences of 1024 tokens.

    Every row is packed, repeated ones as often as they come; a null or empty text is its end id.
    Pieces carry the ids of their documents, null ones too. An empty table gives no pieces.
    """
    import public_tokenizers

    return pack(docs, public_tokenizers.path(TOKENIZER))


STAGES = [
    ("toxicity", toxicity),
    ("ngram_jaccard_join", near_duplicates),
    ("suffix_array_dedup", repeated_passages),
    ("benchmark_decontamination", benchmark_passages),
    ("best_fit_packing", packing),
]
#: Tokens, hashes and learned weights are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = spool(docs, name)
    return docs
