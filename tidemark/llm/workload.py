"""The registered queries of this package: each operator over its whole table, with production parameters."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import byte_bpe, fill_middle, imatch, jaccard, language, leaks, line_chunks, main_text, personal, quality, secrets, toxicity, whitening
from tidemark.llm.common import documents, pick, table

TOKENIZER = "byte_bpe_multi_50k.tiktoken"


def op1_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document, learned from the documents that are not held out."""
    docs = documents(spark, sf_dir)
    held = language.held_out(F.col("doc_id"))
    taught = pick(docs, doc_id="doc_id", lang="lang", text="text").where(~held).select("lang", "text")
    found = language.identify(docs, language.profiles(taught))
    return found.select("doc_id", held.alias("held_out"), "lang_pred", "score", "distance")


def op2_personal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data of every document."""
    return personal.scan(documents(spark, sf_dir))


def op3_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document; a document is a repository of its source."""
    return secrets.scan(documents(spark, sf_dir))


def op4_line_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the line chunks, and the runs of lines, that another one holds already."""
    return line_chunks.remove_repeated(documents(spark, sf_dir)).select("doc_id", "text", "n_removed")


def op5_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of documents linked by a Jaccard similarity of 0.85 of their 4-word shingles."""
    return jaccard.near_duplicates(documents(spark, sf_dir), jaccard.Rule(words=4, share=85, per=100))


def op6_imatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document and of its half-edited text."""
    docs = documents(spark, sf_dir)
    return imatch.robustness(docs, imatch.lexicon(pick(docs, text="text")))


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document by weak labels."""
    return quality.classify(documents(spark, sf_dir))


def op8_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The benchmark items that stand in each document."""
    return leaks.find(documents(spark, sf_dir), table(spark, sf_dir, "benchmark"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document, learned from the labels that are not held out."""
    docs = documents(spark, sf_dir)
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2
    labels = pick(table(spark, sf_dir, "labels"), doc_id="doc_id", toxic="toxic").where(~held)
    terms, weights = toxicity.learn(pick(docs, doc_id="doc_id", text="text"), labels)
    found = toxicity.score(docs, terms, weights)
    return found.select("doc_id", held.alias("held_out"), "score", "predicted", "n_matches")


def byte_bpe_digest(spark: SparkSession, docs: DataFrame) -> DataFrame:
    content = byte_bpe.load(spark, public_tokenizers.path(TOKENIZER))
    return byte_bpe.digest(byte_bpe.encode_decode(docs, content, public_tokenizers.PATTERN))


def op10_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of every document, and the bytes they decode to, as digests."""
    return byte_bpe_digest(spark, documents(spark, sf_dir))


def op11_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document cut at two line ends and put together anew, as digests."""
    return fill_middle.digest(fill_middle.transform(documents(spark, sf_dir)))


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every embedding on the first 32 principal components, whitened."""
    vectors = table(spark, sf_dir, "embeddings")
    return whitening.report(vectors, whitening.fit(vectors, 32))


def op13_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page, learned from the pages that mark theirs."""
    pages = table(spark, sf_dir, "pages")
    return main_text.extract(pages, main_text.learn(pages)).select("page_id", "url", "text", "n_chars")


QUERIES = {
    "op1_language": op1_language,
    "op2_personal": op2_personal,
    "op3_secrets": op3_secrets,
    "op4_line_chunks": op4_line_chunks,
    "op5_jaccard": op5_jaccard,
    "op6_imatch": op6_imatch,
    "op7_quality": op7_quality,
    "op8_leaks": op8_leaks,
    "op9_toxicity": op9_toxicity,
    "op10_byte_bpe": op10_byte_bpe,
    "op11_fill_middle": op11_fill_middle,
    "op12_whitening": op12_whitening,
    "op13_main_text": op13_main_text,
}
SQL: dict[str, str] = {"op11_fill_middle": fill_middle.SQL, "op13_main_text": main_text.SQL}
