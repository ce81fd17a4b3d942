"""A training corpus in five stages: what is toxic goes, one of each group of like documents
stays, benchmark items are removed, sources are mixed, token files are written.

Every stage takes and returns the columns of documents; the last returns what it reads back
from the token files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlens.llm import decontaminate, jaccard_join, mixing, token_files, toxicity
from marketlens.llm.naming import unused
from marketlens.llm.queries import table, tokenizer_path
from marketlens.llm.sizes import small_side
from marketlens.session import stored

TOXIC_FROM = 0.7
# ids of documents left out, 8 bytes each; beyond this the join shuffles
BROADCAST_IDS = 1_000_000
# text of one call of the encoder: the executors still hold what the stages before took
SLICE_BYTES = 1 << 20


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored below the threshold."""
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model).where(F.col("score") < TOXIC_FROM).select(*docs.columns)


def drop_alike(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of smallest id of each group linked by shingles.

    Rows whose id is null or occurs again are told apart by numbers of their own, above all
    ids, so each is judged by its own text: of copies one stays, unlike texts all stay.
    """
    docs, number = _numbered(docs)
    classes = jaccard_join.jaccard_join(docs, id_col=number).select(F.col("doc_id").alias(number), "component_id")
    others = classes.where(F.col(number) != F.col("component_id")).select(number)
    return docs.join(small_side(others, BROADCAST_IDS, "alike"), number, "left_anti").drop(number)


def _numbered(docs: DataFrame) -> tuple[DataFrame, str]:
    """`docs` with a column, named in return, that has another value in every row: the id, or
    a greater number where the id is null or occurs again. Such rows are stored."""
    number, shared = unused(docs, "_number"), unused(docs, "_shared")
    ids = docs.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"))
    repeated = stored(ids.where("n > 1 or doc_id is null").select(F.col("doc_id").alias(shared)), "repeated")
    numbered = docs.withColumn(number, F.col("doc_id"))
    if not repeated.limit(1).count():
        return numbered, number
    again = F.col("doc_id").eqNullSafe(F.col(shared))
    side = small_side(repeated, BROADCAST_IDS, "repeated")
    greatest = docs.agg(F.coalesce(F.max("doc_id"), F.lit(0))).first()[0]
    own = stored(docs.join(side, again, "left_semi").withColumn(number, F.monotonically_increasing_id()), "numbered")
    own = own.withColumn(number, F.col(number) + F.lit(greatest + 1))
    return numbered.join(side, again, "left_anti").unionByName(own), number


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mixture takes them."""
    return mixing.mix(docs)


def write_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files, and per document what is read back: doc_id, start, n_tokens, ids_crc32."""
    return token_files.token_digests(docs, tokenizer_path(), SLICE_BYTES)


STAGES = [
    ("toxicity", drop_toxic),
    ("ngram_jaccard", drop_alike),
    ("decontamination", drop_benchmark),
    ("mixing", mix_sources),
    ("token_files", write_tokens),
]

# the fitted model of the first stage and the tokenizer have no SQL counterpart
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table, each one's result stored for the next.

    Null and empty texts pass all stages but the mixture, which takes documents by their
    words; repeated rows and null ids are kept apart by their texts (see `drop_alike`); an
    empty table gives no rows; other columns than those of documents pass unchanged.
    """
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
