"""The registered queries of this folder: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from plumbline.llm import decontaminate, factors, language, lexical, maintext, mixing, oracles, prefixes, secrets, simhash, suffixes, tokens, topk, toxicity
from plumbline.session import use_local_shared_dir

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = dict(oracles.ORACLES)


def query(fn):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        use_local_shared_dir(spark)
        return fn(lambda table: spark.read.parquet(f"{sf_dir}/{table}.parquet"))

    run.__name__, run.__doc__ = fn.__name__, fn.__doc__
    QUERIES[fn.__name__] = run
    return fn


@query
def op1_mixing(read):
    """How many words of each document a mixture of the sources takes."""
    return mixing.mix_counts(read("documents"))


@query
def op2_toxicity(read):
    """Toxicity of every document from its nearest labelled examples."""
    return toxicity.toxicity(read("documents"), read("labels"))


@query
def op3_decontaminate(read):
    """Words of documents inside any ten-word window of a benchmark item."""
    return decontaminate.contaminated(read("documents"), read("benchmark"))


@query
def op4_simhash(read):
    """SimHash fingerprints of all documents and their components at two bits."""
    return simhash.simhash_digest(read("documents"))


@query
def op5_topk(read):
    """The five largest inner products of every fiftieth vector with all others."""
    return topk.every_fiftieth(read("embeddings"))


@query
def op6_language(read):
    """Language of every document."""
    return language.predictions(read("documents"), tokens.vocabulary_path("piece_bpe_32k.model"))


@query
def op7_secrets(read):
    """Secrets in every document, weak candidates linked to their complements."""
    return secrets.secret_digest(read("documents"))


@query
def op8_suffixes(read):
    """Bytes of documents in 100-byte strings that start earlier."""
    return suffixes.byte_digest(read("documents"))


@query
def op9_factors(read):
    """Words of documents in 20-word windows that start earlier."""
    return factors.word_digest(read("documents"))


@query
def op10_tokens(read):
    """Token ids of all documents, written in document order and read back."""
    return tokens.token_digest(read("documents"), tokens.vocabulary_path())


@query
def op11_maintext(read):
    """The article's text of every page."""
    return maintext.main_text(read("pages").select("page_id", "url", "html"))


@query
def op12_prefixes(read):
    """Every distinct prefix of the rebuilt conversations."""
    return prefixes.trie_digest(read("conversations"))


@query
def op13_lexical(read):
    """The ten best documents of every benchmark item."""
    return lexical.ranked(read("documents"), read("benchmark"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages of the corpus pipeline."""
    use_local_shared_dir(spark)
    return corpus_pipeline.run(spark, sf_dir)


QUERIES["pipeline"] = pipeline
