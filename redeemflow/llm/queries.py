"""Registered queries of the text operators, with DuckDB SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from redeemflow.llm.common import table
from redeemflow.llm.oracles import SQL

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}

#: host, path, verdict of the query's rules
URL_RULES = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"),
             ("com", "/fr/", "allow"), ("com", "/de/", "block")]


def register(fn):
    QUERIES[fn.__name__] = fn
    return fn


def tokenizer_files():
    import public_tokenizers as public

    from redeemflow.llm.packing import Files
    return Files(public.path("byte_bpe_50k.json"), public.path("byte_bpe_50k.tiktoken"), public.PATTERN)


@register
def op1_toxicity_chain(spark, d):
    from redeemflow.llm.toxicity import chain
    return chain(table(spark, d, "documents"), table(spark, d, "labels"), threshold=0.3)


@register
def op2_url_filter(spark, d):
    from redeemflow.llm.url_filters import filter_urls
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return filter_urls(table(spark, d, "pages"), rules)


@register
def op3_decontamination(spark, d):
    from redeemflow.llm.decontam import contamination
    return contamination(table(spark, d, "documents"), table(spark, d, "benchmark"))


@register
def op4_quality_classifier(spark, d):
    from redeemflow.llm.quality import classify
    return classify(table(spark, d, "documents"), table(spark, d, "labels"), threshold=0.3)


@register
def op5_simhash_dedup(spark, d):
    from redeemflow.llm.simhash import group
    return group(table(spark, d, "documents"), shingle=3, distance=3).select("doc_id", "fingerprint", "component_id")


@register
def op6_chat_format(spark, d):
    from redeemflow.llm.chat import expand, read_back
    own = "</s>[INST] ok [/INST]"
    probe = spark.createDataFrame([(-1, 0, "user", own), (-1, 1, "assistant", own)],
                                  "conv_id long, turn long, role string, text string")
    return read_back(expand(table(spark, d, "conversations").select("conv_id", "turn", "role", "text")
                            .unionByName(probe)))


@register
def op7_quality_rules(spark, d):
    from redeemflow.llm.quality_rules import judge
    return judge(table(spark, d, "documents"), table(spark, d, "labels"))


@register
def op8_html_extract(spark, d):
    from redeemflow.llm.html_extract import extract
    return extract(table(spark, d, "pages"))


@register
def op9_suffix_dedup(spark, d):
    from redeemflow.llm.suffix import report
    return report(table(spark, d, "documents"), width=50)


@register
def op10_packing(spark, d):
    from redeemflow.llm.packing import pack
    return pack(table(spark, d, "documents"), tokenizer_files())


@register
def op11_conversation_repair(spark, d):
    from redeemflow.llm.conversation_repair import damage, report
    conversations = table(spark, d, "conversations")
    return report(damage(conversations), conversations.select("conv_id"))


@register
def op12_token_counts(spark, d):
    import public_tokenizers as public

    from redeemflow.llm.token_counts import token_counts
    return token_counts(table(spark, d, "documents"), public.path("piece_bpe_32k.model"), limit=4096)


@register
def op13_embedding_whitening(spark, d):
    from redeemflow.llm.whitening import whiten
    return whiten(table(spark, d, "embeddings"), components=4, scale=256)


ORACLE: dict[str, str] = {k: v for k, v in SQL.items() if k in QUERIES}
