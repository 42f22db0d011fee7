"""The corpus pipeline: five stages, each on all that the one before kept.

A stage takes (spark, docs, sf_dir) and returns a DataFrame; `run` writes it as Parquet in the shared folder and reads it
back as the next one's docs. All but the last return the columns of documents. No stage can be told in SQL as a whole
(trained trees, hashes of token ids), so ORACLE_SQL is None; tests/llm hold brute-force versions of operators, not of `run`.

1. quality: documents that the classifier rejects go.
2. ngram_join: of each group of documents linked at five words and 0.8 the one with the smallest doc_id stays.
3. suffix_dedup: bytes of passages that an earlier document has are cut out of the text; every document stays.
4. decontaminate: documents that hold a benchmark item go.
5. bpe: token ids of each text as digests, and the digest of the decoded bytes.

Rows with a null doc_id are carried along. Stages 1, 2 and 4 take each row as a document of its own, also where doc_ids are
null (the largest) or repeated; of equal doc_ids in a group one row stays. Stage 3 doesn't cut repeats between rows of one
doc_id. A null text counts as empty and stays null; all columns stay, whatever their names are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgerline.llm import bpe, decontaminate, ngram_join, quality, suffix_dedup
from ledgerline.llm.storage import forget, materialise

#: Stage 2 links near copies by five words and 0.8; four words and 85 % are the contract of the query op2_ngram_join alone.
SHINGLE_WORDS = 5
SHINGLE_PERCENT = 80
TOKENIZER = "byte_bpe_multi_50k.tiktoken"
ORACLE_SQL = None


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep_good(docs, _table(spark, sf_dir, "labels"))


def keep_one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return ngram_join.one_of_each(docs, size=SHINGLE_WORDS, percent=SHINGLE_PERCENT)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return suffix_dedup.dedup_texts(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.clean(docs, _table(spark, sf_dir, "benchmark"))


def tokenise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return bpe.digests(docs, public_tokenizers.path(TOKENIZER), public_tokenizers.PATTERN)


STAGES = [
    ("quality", keep_good),
    ("ngram_join", keep_one_of_each_group),
    ("suffix_dedup", cut_repeats),
    ("decontaminate", drop_contaminated),
    ("bpe", tokenise),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = _table(spark, sf_dir, "documents"), []
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), f"pipeline-{name}")
        forget(*before)
        before = [docs]
    return docs
