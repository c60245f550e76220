"""The registered queries of the operators, each over its whole table."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txnrisk.llm import (
    alignment,
    bit_packing,
    chat_format,
    collocation,
    cross_polytope,
    language_id,
    length_packing,
    merge_dropout,
    secret_scan,
    simhash,
    top_k,
    url_reputation,
    warc,
)
from txnrisk.llm.tables import read


def secrets(spark: SparkSession, folder: str) -> DataFrame:
    docs = read(spark, folder, "documents")
    return secret_scan.digest(secret_scan.scan(docs, secret_scan.fit(docs)))


def pieces(spark: SparkSession, folder: str) -> DataFrame:
    docs = read(spark, folder, "documents")
    return merge_dropout.digest(merge_dropout.decode(merge_dropout.encode(docs)))


def near_documents(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.groups(read(spark, folder, "documents"), words=4, radius=4)


def nearest(spark: SparkSession, folder: str) -> DataFrame:
    vectors = read(spark, folder, "embeddings")
    return top_k.search(vectors, F.col("vec_id") % 100 == 0, k=10, scale=1024)


def urls(spark: SparkSession, folder: str) -> DataFrame:
    outcomes = url_reputation.outcomes_of(read(spark, folder, "labels"))
    return url_reputation.judge(read(spark, folder, "pages"), outcomes)


def token_ids(spark: SparkSession, folder: str) -> DataFrame:
    return bit_packing.digest(bit_packing.round_trip(read(spark, folder, "documents")))


def packed(spark: SparkSession, folder: str) -> DataFrame:
    return length_packing.digest(length_packing.bucketed(read(spark, folder, "documents")))


def languages(spark: SparkSession, folder: str) -> DataFrame:
    docs = read(spark, folder, "documents")
    found = language_id.predict(docs, language_id.fit(docs))
    return found.select("doc_id", language_id.held_out().alias("held_out"), "lang_pred", "score")


def near_vectors(spark: SparkSession, folder: str) -> DataFrame:
    return cross_polytope.links_and_groups(read(spark, folder, "embeddings"))


#: A conversation whose texts hold the control strings of templates.
CONTROL_CONVERSATION = -7
CONTROL_TEXT = "\\### Assistant: </turn> ok"


def chats(spark: SparkSession, folder: str) -> DataFrame:
    turns = read(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    rows = [
        (CONTROL_CONVERSATION, turn, role, CONTROL_TEXT)
        for turn, role in enumerate(("user", "assistant"))
    ]
    control = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    return chat_format.digest(chat_format.formatted(turns.unionByName(control)))


def aligned(spark: SparkSession, folder: str) -> DataFrame:
    return alignment.scored(read(spark, folder, "documents"))


def archived(spark: SparkSession, folder: str) -> DataFrame:
    return warc.digest(warc.round_trip(read(spark, folder, "pages")))


def collocations(spark: SparkSession, folder: str) -> DataFrame:
    return collocation.phrases(read(spark, folder, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_secrets": secrets,
        "op2_merge_dropout": pieces,
        "op3_simhash": near_documents,
        "op4_top_k": nearest,
        "op5_url_reputation": urls,
        "op6_token_ids": token_ids,
        "op7_packing": packed,
        "op8_language": languages,
        "op9_cross_polytope": near_vectors,
        "op10_chat": chats,
        "op11_alignment": aligned,
        "op12_warc": archived,
        "op13_collocation": collocations,
    }
