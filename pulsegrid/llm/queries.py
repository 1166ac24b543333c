"""The registered queries of this subpackage, with production parameters."""

from __future__ import annotations

from pyspark.sql import functions as F

from . import bisectors, compact_windows, decontam, gru_lm, langid, mixing, mtree, pigeonring, rns_gemm, rp_forest, tokenbin, toxicity, zipwarc
from .common import table


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op1_mixing(spark, sf_dir):
    return mixing.mix_documents(table(spark, sf_dir, "documents"))


def op2_decontamination(spark, sf_dir):
    return decontam.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op3_token_files(spark, sf_dir):
    return tokenbin.token_table(table(spark, sf_dir, "documents"), tokenizer_path())


def op4_langid(spark, sf_dir):
    return langid.identify(table(spark, sf_dir, "documents"))


def op5_lm_scoring(spark, sf_dir):
    return gru_lm.score_documents(table(spark, sf_dir, "documents"))


def op6_warc(spark, sf_dir):
    return zipwarc.archive(table(spark, sf_dir, "pages"))


def op7_passages(spark, sf_dir):
    return compact_windows.repeated_passages(table(spark, sf_dir, "documents"))


def op8_topk(spark, sf_dir):
    rows = table(spark, sf_dir, "embeddings")
    return mtree.top_k(rows, rows.where("vec_id % 100 = 0"), k=10)


def op9_simhash(spark, sf_dir):
    return pigeonring.near_duplicates(table(spark, sf_dir, "documents"))


def op10_toxicity(spark, sf_dir):
    return toxicity.score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_hard_negatives(spark, sf_dir):
    rows = table(spark, sf_dir, "embeddings")
    own = F.col("label").cast("long")
    label = F.when(F.col("vec_id") % 7 == 0, (own + 1) % 10).otherwise(own)
    return rns_gemm.hard_negatives(rows, anchors=F.col("vec_id") % 50 == 0, label=label)


def op12_forest(spark, sf_dir):
    rows = table(spark, sf_dir, "embeddings")
    return rp_forest.nearest(rows, rows.where("vec_id % 20 = 0"), k=20)


def op13_clusters(spark, sf_dir):
    return bisectors.clusters(table(spark, sf_dir, "embeddings"))


QUERIES = {
    "op1_mixing": op1_mixing,
    "op2_decontamination": op2_decontamination,
    "op3_token_files": op3_token_files,
    "op4_langid": op4_langid,
    "op5_lm_scoring": op5_lm_scoring,
    "op6_warc": op6_warc,
    "op7_passages": op7_passages,
    "op8_topk": op8_topk,
    "op9_simhash": op9_simhash,
    "op10_toxicity": op10_toxicity,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_forest": op12_forest,
    "op13_clusters": op13_clusters,
}

#: DuckDB SQL; the other queries are tested against brute force, exact round
#: trips or held-out rows (tests/llm).
ORACLE = {
    "op1_mixing": mixing.ORACLE, "op6_warc": zipwarc.ORACLE, "op8_topk": mtree.ORACLE,
    "op11_hard_negatives": rns_gemm.ORACLE, "op13_clusters": bisectors.ORACLE,
}
