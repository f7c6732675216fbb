"""A corpus pipeline: documents in, token files out, each stage written as Parquet and read again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rastercube.llm import copies, decontam, mixing, tokens, toxicity
from rastercube.llm.shared import cut

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity classifier does not reject; it learns from the labelled ones among them.

    A row stays if its whole text's score is below 0.5. Null and empty texts score what no word
    scores; very long ones are scored in blocks; repeated rows and rows without id are judged
    each by its text, and equal texts alike. Without labels of both classes every row stays, unless
    all labels say toxic. An empty table gives none. Columns beyond those of documents go.
    """
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = toxicity.fit(docs, labels)
    return toxicity.score_documents(docs.select(*COLUMNS), model).filter("predicted = 0").select(*COLUMNS)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of near copies, one row: that with the least doc_id, nulls last.

    Near copies have fingerprints within three bits, or sets of five-word shingles with a
    Jaccard similarity of 0.8 or more.
    Of rows with the same doc_id, or without one, the least hash of all columns decides; of
    wholly equal rows one stays. Every component keeps one row, whatever its ids are. Null and
    empty texts are one component; a text of fewer than five words is one shingle; very long
    texts are hashed whole, in slabs. An empty table gives none. Columns beyond those of
    documents go before rows are compared.
    """
    return copies.one_of_each(docs.select(*COLUMNS), similarity=0.8, radius=3)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no ten-word window of a benchmark item occurs.

    Null texts and texts without words stay; very long ones are searched whole, in pieces;
    repeated rows stay or go together; with an empty benchmark all stay. An empty table gives
    none. Columns beyond those of documents go.
    """
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontam.find_contamination(docs.select(*COLUMNS), benchmark, size=10).filter("size(items) = 0").select(*COLUMNS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The curriculum's stream: a row for each copy that the mix takes of a document.

    Documents that the mix takes no copy of leave here; those without words have no size to
    mix and stay once. Every row has positions of its own, also without a doc_id or with one
    that another row has. A very long document is taken or not as a whole. The rows are not
    sorted by position: the next stage writes in the order of doc_id, as its format has it, so a
    sort of all texts would be lost (op6 ranks the copies without moving texts). An empty
    table gives none. Columns beyond those of documents go.
    """
    mix = mixing.curriculum(docs.select(*COLUMNS), carry=["text", "lang", "n_chars"])
    taken = F.when(F.col("size") == 0, 1).otherwise(F.size("positions"))
    return mix.withColumn("_copies", taken).filter("_copies > 0").withColumn("_c", F.explode(F.sequence(F.lit(1), "_copies"))).select(*COLUMNS)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of all documents, and where in them each one is.

    doc_id, start, n_tokens, ids_crc32 of every row, in ascending doc_id, nulls first; copies of
    a document stand next to each other. A null text is its end id alone; a very long one is
    encoded whole. An empty table gives none. Other columns than doc_id and text are ignored.
    """
    return tokens.token_index(docs).select("doc_id", "start", "n_tokens", "ids_crc32")


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash near-dedup", one_of_each_group),
    ("benchmark decontamination", drop_contaminated),
    ("mixing", mix_sources),
    ("token ids", tokenize),
]

#: The classifier and the tokenizer have no SQL form; tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to documents; each stage reads what the one before has written."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir), "stage-" + name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
