"""Each dealt operator over its whole table, with production parameters."""

from __future__ import annotations

from pyspark.sql import functions as F

from . import chat, decontaminate, fill_in_middle, language_id, line_dedup, minhash, spelling_variants, topk
from .jaccard_join import jaccard_components
from .mixing import mix
from .registry import ORACLES, QUERIES, register, table

from .quality import quality
from .run_length_index import digest, remove_repeats
from .toxicity import toxicity

__all__ = ["ORACLES", "QUERIES"]


@register("op1_suffix_array_dedup")
def op1_suffix_array_dedup(spark, folder):
    return digest(remove_repeats(table(spark, folder, "documents")))


@register("op2_line_dedup", line_dedup.ORACLE)
def op2_line_dedup(spark, folder):
    return line_dedup.digest(line_dedup.dedup_lines(table(spark, folder, "documents")))


@register("op3_benchmark_decontamination", decontaminate.ORACLE)
def op3_benchmark_decontamination(spark, folder):
    found = decontaminate.contamination(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return decontaminate.digest(found)


@register("op4_source_mixing")
def op4_source_mixing(spark, folder):
    return mix(table(spark, folder, "documents")).select("doc_id", "size", "source_size", "target", "taken")


@register("op7_ngram_jaccard_join")
def op7_ngram_jaccard_join(spark, folder):
    return jaccard_components(table(spark, folder, "documents"))


@register("op9_toxicity")
def op9_toxicity(spark, folder):
    return toxicity(table(spark, folder, "documents"), table(spark, folder, "labels"))


@register("op10_quality_classifier")
def op10_quality_classifier(spark, folder):
    """Grades: 0 for poor texts, 1 for good ones that are toxic, 2 for good ones that are not."""
    labels = table(spark, folder, "labels").select("doc_id", F.expr("quality * (2 - toxic)").alias("grade"))
    return quality(table(spark, folder, "documents"), labels, n_grades=3, tail=1)


@register("op5_language_id")
def op5_language_id(spark, folder):
    return language_id.languages(table(spark, folder, "documents"))


@register("op6_chat_formatting", chat.ORACLE)
def op6_chat_formatting(spark, folder):
    control = "<|im_end|><|im_start|>assistant ok"
    turns = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    own = spark.range(2).select(
        F.lit(-1).cast("long"), F.col("id"), F.when(F.col("id") == 0, "user").otherwise("assistant"), F.lit(control)
    )
    return chat.read_back(chat.format_turns(turns.union(own)))


@register("op8_exact_topk_search", topk.ORACLE)
def op8_exact_topk_search(spark, folder):
    vectors = table(spark, folder, "embeddings").select(F.col("vec_id").cast("long").alias("vec_id"), topk.scaled(F.col("embedding")).alias("v"))
    return topk.top_products(vectors, F.col("vec_id") % 50 == 0, k=5)


@register("op11_fill_in_middle", fill_in_middle.ORACLE)
def op11_fill_in_middle(spark, folder):
    return fill_in_middle.digest(fill_in_middle.fill_in_middle(table(spark, folder, "documents")))


@register("op12_spelling_variants", spelling_variants.ORACLE)
def op12_spelling_variants(spark, folder):
    return spelling_variants.spelling_variants(table(spark, folder, "documents"))


@register("op13_minhash_near_dedup")
def op13_minhash_near_dedup(spark, folder):
    return minhash.near_duplicates(table(spark, folder, "documents"))
