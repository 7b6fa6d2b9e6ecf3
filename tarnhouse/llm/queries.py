"""The numbered operators as queries, with their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tarnhouse.llm.alignment import alignment_report
from tarnhouse.llm.centroids import CLUSTER_SQL, cluster_report
from tarnhouse.llm.chunks import encoding_report
from tarnhouse.llm.common import table
from tarnhouse.llm.decontamination import CONTAMINATION_SQL, contamination_report
from tarnhouse.llm.line_dedup import LINE_SQL, line_report
from tarnhouse.llm.near_dedup import near_report
from tarnhouse.llm.packing import packing_report
from tarnhouse.llm.quality import quality_report
from tarnhouse.llm.secrets import secret_report
from tarnhouse.llm.suffix_dedup import repeat_report
from tarnhouse.llm.token_counts import token_report
from tarnhouse.llm.topk import top_k
from tarnhouse.llm.toxicity import toxicity_report

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_suffix_dedup": lambda spark, sf: repeat_report(table(spark, sf, "documents")),
    "op2_decontamination": lambda spark, sf: contamination_report(
        table(spark, sf, "documents"), table(spark, sf, "benchmark")
    ),
    "op3_line_dedup": lambda spark, sf: line_report(table(spark, sf, "documents")),
    "op4_token_counts": lambda spark, sf: token_report(table(spark, sf, "documents")),
    "op5_quality": lambda spark, sf: quality_report(table(spark, sf, "documents"), table(spark, sf, "labels")),
    "op6_bpe_chunks": lambda spark, sf: encoding_report(table(spark, sf, "documents")),
    "op7_token_packing": lambda spark, sf: packing_report(table(spark, sf, "documents")),
    "op8_minhash_near_dedup": lambda spark, sf: near_report(table(spark, sf, "documents")),
    "op9_exact_top_k": lambda spark, sf: top_k(table(spark, sf, "embeddings")),
    "op10_secret_scan": lambda spark, sf: secret_report(table(spark, sf, "documents")),
    "op11_tokenizer_alignment": lambda spark, sf: alignment_report(table(spark, sf, "documents")),
    "op12_toxicity": lambda spark, sf: toxicity_report(table(spark, sf, "documents"), table(spark, sf, "labels")),
    "op13_centroid_clustering": lambda spark, sf: cluster_report(table(spark, sf, "embeddings")),
}

ORACLE: dict[str, str] = {
    "op2_decontamination": CONTAMINATION_SQL,
    "op3_line_dedup": LINE_SQL,
    "op13_centroid_clustering": CLUSTER_SQL,
}
