"""The corpus pipeline: raw documents to token ids.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; its rows are written as Parquet and
read again as the next stage's documents.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from webgrain.llm import common
from webgrain.llm.decontaminate import mark
from webgrain.llm.neardup import near_duplicates
from webgrain.llm.pieces import encode_and_decode
from webgrain.llm.quality import judged
from webgrain.llm.secrets import mask
from webgrain.session import ship


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that the rules reject: failed counts, or histograms far from those of
    their language. Null and empty texts are rejected."""
    ship(spark)
    return judged(docs).filter("_out.kept").select(*common.unpacked(docs.columns))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the least id of each group of near duplicates (five-word shingles,
    similarity 0.8), and one of rows equal in id and text. Rows without id or shingles stay."""
    ship(spark)
    found = near_duplicates(docs, words=5, percent=80)
    gone = found.filter("not kept").select(F.col("doc_id").cast(docs.schema["doc_id"].dataType)).distinct()
    rest = docs.join(gone, "doc_id", "left_anti")
    return rest.dropDuplicates(["doc_id", "text"]).select(*docs.columns)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that hold a benchmark item, also with other numbers, names or units."""
    ship(spark)
    return mark(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")).filter("size(items) = 0").select(*docs.columns)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces every secret in the texts; all documents stay."""
    ship(spark)
    return mask(docs, common.fresh(spark, "ledger"), length="n_chars" if "n_chars" in docs.columns else None)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Adds the token ids and their number; the text is what the ids decode to."""
    import public_tokenizers

    ship(spark)
    return encode_and_decode(docs, public_tokenizers.path("piece_bpe_32k.model"))


STAGES = [
    ("quality rules", quality_rules),
    ("MinHash near-dedup", near_dedup),
    ("benchmark decontamination", decontaminate),
    ("secret scans", mask_secrets),
    ("SentencePiece encoding and decoding", tokenize),
]

# SQL cannot express the link search and the tokenizer; the stages are tested against brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to ``documents``, each written to the shared folder and read again."""
    docs = common.documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = common.stored(stage(spark, docs, sf_dir), name.split(" ")[0].lower())
    return STAGES[-1][1](spark, docs, sf_dir)
