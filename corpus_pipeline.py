"""From raw documents to packed training sequences, stage by stage.

Each stage gets all rows the one before it kept; all but the last return the columns of documents.
"""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratebook.llm import decontamination, ngram_join, packing, suffix_dedup, toxicity
from ratebook.llm.queries import VOCABULARY, fold, table
from ratebook.llm.rows import row_key
from ratebook.operators.storage import new_folder, stored

# Byte strings cut out of a text may leave parts of a character; no SQL writes these stages.
ORACLE_SQL = None
_KEY = "_row_key"


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.withColumn(_KEY, row_key("doc_id", "text"))


def _aside(docs: DataFrame) -> tuple[DataFrame, list[str], list]:
    """Documents whose other columns have names no operator uses, these, and all as they were."""
    names = {c: c if c in ("doc_id", "text") else f"_aside_{i}" for i, c in enumerate(docs.columns)}
    renamed = docs.select(*[F.col(f"`{c}`").alias(n) for c, n in names.items()])
    others = [n for c, n in names.items() if n != c]
    return renamed, others, [F.col(n).alias(c) for c, n in names.items()]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model predicts to be toxic go."""
    given, others, back = _aside(docs)
    found = toxicity.toxicity(
        given, table(spark, sf_dir, "labels"), fold(5) == 0, carried=("text", *others)
    )
    return found.where("predicted = 0").select(*back)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of linked documents the one with the least doc_id stays, once; null ids yield to others.

    Of equal ids the least key decides. Rows without words link with nothing and all stay.
    """
    found = stored(
        ngram_join.jaccard_components(docs).select("doc_id", "key", "component"), "linked"
    )
    least = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "key"))
    linked = found.where("component is not null")
    first = linked.groupBy("component").agg(least.alias("least")).select(F.col("least.key").alias(_KEY))
    alone = found.where("component is null").select(F.col("key").alias(_KEY)).distinct()
    kept = _keyed(docs).join(first, _KEY).dropDuplicates([_KEY])
    return kept.unionByName(_keyed(docs).join(alone, _KEY, "left_semi")).select(docs.columns)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated byte strings are cut out of the texts; a text that is cut whole goes with its row.

    Bytes of a character that was cut through are left out; n_chars follows the text.
    """
    given, others, back = _aside(docs)
    found = suffix_dedup.dedup_strings(given, carried=tuple(others))
    text = F.try_validate_utf8("kept")
    cut = (
        found.where("n_removed = 0 or n_removed < n_bytes")
        .withColumn("text", F.coalesce(text, F.expr("replace(make_valid_utf8(kept), '\\uFFFD', '')")))
        .select(*back)
    )
    if "n_chars" not in docs.columns:
        return cut
    return cut.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go."""
    found = decontamination.contamination(docs, table(spark, sf_dir, "benchmark"))
    hit = found.where("contaminated").select(F.col("key").alias(_KEY)).distinct()
    return _keyed(docs).join(hit, _KEY, "left_anti").select(docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every remaining document's token pieces with their place in a sequence."""
    return packing.pack(docs, VOCABULARY)


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("ngram_jaccard_join", one_of_each_group),
    ("suffix_array_dedup", cut_repeats),
    ("benchmark_decontamination", drop_contaminated),
    ("best_fit_packing", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows; each stage is written as Parquet and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = new_folder(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
