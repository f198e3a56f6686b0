"""The registered queries of these operators and their SQL."""

from __future__ import annotations

import string
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from smeltery.llm import (
    decontaminate,
    divergence,
    language,
    lines,
    merkle,
    near_duplicates,
    packing,
    simhash,
    spelling,
    sql,
    suffix_array,
    suffix_trees,
    toxicity,
    warc,
)
from smeltery.llm.shared import remainder, table


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents", "doc_id", "text")
    held_out = (remainder("doc_id", 5) == 0).alias("held_out")
    labels = table(spark, sf_dir, "labels", "doc_id", "toxic").where(remainder("doc_id", 5) != 0)
    model = toxicity.fit(documents, labels)
    scored = toxicity.score(documents.select("doc_id", held_out, "text"), model)
    return scored.select("doc_id", "held_out", "score", "predicted")


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row for each document and benchmark item that is in it."""
    documents = table(spark, sf_dir, "documents", "doc_id", "text")
    found = decontaminate.marked(documents, table(spark, sf_dir, "benchmark", "item_id", "text"))
    return found.select("doc_id", F.explode("items").alias("item")).select(
        "doc_id", "item.item_id", "item.distance"
    )


def op3_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = lines.deduplicated(table(spark, sf_dir, "documents", "doc_id", "text"))
    digest = F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256)
    return kept.select("doc_id", "n_lines", "n_removed", digest.alias("kept_sha256"))


def op4_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents", "doc_id", "text", "lang")
    judged = divergence.judge(documents)
    first = ["doc_id", *divergence.BASE, "kept"]
    return judged.select(*first, *(c for c in judged.columns if c not in (*first, "text", "lang")))


def op5_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates.marked(table(spark, sf_dir, "documents", "doc_id", "text"))


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages", "page_id", "url", "html")
    records = warc.read(warc.write(pages), with_payload=False)
    kind = pages.schema["page_id"].dataType
    return records.select(
        F.col("page_id").cast(kind).alias("page_id"),
        F.col("n_bytes").alias("payload_bytes"),
        F.col("digest").alias("payload_digest"),
        "record_type",
        F.col("refers_to").cast(kind).alias("refers_to"),
    )


def op7_suffix_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents", "doc_id", "text")
    return suffix_array.deduplicated(documents, with_bytes=False)


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents", "doc_id", "text"))


def op9_suffix_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents", "doc_id", "text")
    return suffix_trees.deduplicated(documents, with_text=False)


def op10_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents", "doc_id", "text", "lang")
    profiles = language.learn(documents.where(remainder("doc_id", 3) != 1))
    held_out = (remainder("doc_id", 3) == 1).alias("held_out")
    return language.predict(documents.select("doc_id", held_out, "text"), profiles)


def op11_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.marked(table(spark, sf_dir, "documents", "doc_id", "text"))


def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.grouped(table(spark, sf_dir, "documents", "doc_id", "text"))


def op13_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The manifest of ``documents``, checked against rows of which a third lost their capitals."""
    documents = table(spark, sf_dir, "documents", *merkle.FIELDS)
    lowered = F.translate("text", string.ascii_uppercase, string.ascii_lowercase)
    tampered = merkle.leaf_of(*(lowered if c == "text" else F.col(c) for c in merkle.FIELDS))
    drawn = F.col("doc_id").isNotNull() & (remainder("doc_id", 3) == 0)
    found = F.when(drawn, tampered).otherwise(merkle.leaf_of(*map(F.col, merkle.FIELDS)))
    return merkle.manifest(documents, found=found, with_proof=False)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_toxicity": op1_toxicity,
    "op2_decontaminate": op2_decontaminate,
    "op3_lines": op3_lines,
    "op4_divergence": op4_divergence,
    "op5_near_duplicates": op5_near_duplicates,
    "op6_warc": op6_warc,
    "op7_suffix_array": op7_suffix_array,
    "op8_packing": op8_packing,
    "op9_suffix_trees": op9_suffix_trees,
    "op10_language": op10_language,
    "op11_simhash": op11_simhash,
    "op12_spelling": op12_spelling,
    "op13_merkle": op13_merkle,
}
SQL: dict[str, str] = {
    "op5_near_duplicates": r"""
        with recursive cut as (
            select doc_id, regexp_extract_all(translate(coalesce(text, ''),
                       'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                       '[^\x20\x09-\x0D]+') as w from documents),
        sets as (
            select distinct doc_id, unnest(case when len(w) < 4
                then [array_to_string(w, ' ')]
                else list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' '))
                end) as g from cut where len(w) > 0),
        sizes as (select doc_id, count(*) as n from sets group by 1),
        common as (
            select a.doc_id as x, b.doc_id as y, count(*) as c
            from sets a join sets b on a.g = b.g and a.doc_id < b.doc_id group by 1, 2),
        links as (
            select x, y from common join sizes p on p.doc_id = x join sizes q on q.doc_id = y
            where 100 * c >= 80 * (p.n + q.n - c)),
        both_ways as (select x, y from links union all select y, x from links),
        reach as (
            select doc_id, doc_id as r from documents
            union select reach.doc_id, y from reach join both_ways on r = x),
        component as (select doc_id, min(r) as component_id from reach group by 1)
        select d.doc_id, coalesce(n, 0) as n_shingles, component_id,
               d.doc_id = component_id as kept
        from documents d join component using (doc_id) left join sizes using (doc_id)""",
    "op6_warc": """
        with payload as (
            select page_id, strlen(coalesce(html, '')) as payload_bytes,
                   sha256(coalesce(html, '')) as payload_digest from pages),
        first as (
            select *, min(page_id) over (partition by payload_digest) as least,
                   payload_bytes >= 100 and count(*) over (partition by payload_digest) > 1
                   as shared from payload),
        told as (
            select *, shared and least is not null and page_id is distinct from least
                   as again from first)
        select page_id, payload_bytes, payload_digest,
               case when again then 'revisit' else 'response' end as record_type,
               case when again then least end as refers_to from told""",
    "op9_suffix_trees": r"""
        with cut as (
            select doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w
            from documents),
        windows as (
            select doc_id, unnest(range(1, len(w) - 18)) as i, w from cut where len(w) >= 20),
        named as (select doc_id, i, array_to_string(w[i:i + 19], ' ') as g from windows),
        ranked as (
            select doc_id, i, row_number() over (partition by g order by doc_id, i) as k from named),
        gone as (
            select distinct doc_id, i + j as i from ranked, range(0, 20) t(j) where k > 1),
        word as (select doc_id, unnest(w) as word, unnest(range(1, len(w) + 1)) as i from cut),
        kept as (
            select doc_id, string_agg(word, ' ' order by i) as t, count(*) as n
            from word anti join gone using (doc_id, i) group by 1)
        select c.doc_id, len(w)::bigint as n_words, len(w) - coalesce(n, 0) as n_removed,
               sha256(coalesce(t, '')) as kept_sha256
        from cut c left join kept using (doc_id)""",
    "op12_spelling": sql.SPELLING,
    "op13_merkle": sql.merkle(),
}
