"""Queries of the text and clustering problems over the test tables, and the SQL beside them where SQL can say it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from strataloom.llm import bpe, clusters, generated_files, keyword_pages, name_links, packing
from strataloom.session import checkpointed, table


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return generated_files.machine_made(table(spark, d, "repo_file"), table(spark, d, "file_hacker_commit")).select("owner_repo", "file_path").distinct()


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    groups = clusters.chained_groups(clusters.count_vectors(table(spark, d, "commit_stat_log")))
    return groups.select(groups["head_id"].alias("head_log_id"), groups["member_id"].alias("member_log_id"))


def p4_clusters(spark: SparkSession, d: str) -> DataFrame:
    return clusters.density_clusters(clusters.count_vectors(table(spark, d, "commit_stat_log")))


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    return name_links.same_person(table(spark, d, "dev_alias"))


def p7_members(spark: SparkSession, d: str) -> DataFrame:
    return name_links.person_members(table(spark, d, "dev_alias"))


def p8_ids(spark: SparkSession, d: str) -> DataFrame:
    return bpe.token_ids(table(spark, d, "documents"))


def p8_round_trip(spark: SparkSession, d: str) -> DataFrame:
    return bpe.texts_of(bpe.token_ids(table(spark, d, "documents")))


def p9_packed(spark: SparkSession, d: str) -> DataFrame:
    return packing.packed(packing.token_counts(table(spark, d, "documents")), table(spark, d, "pack_container"))


def p9_fill(spark: SparkSession, d: str) -> DataFrame:
    return packing.fill_report(p9_packed(spark, d), table(spark, d, "pack_container"))


def p9_faults(spark: SparkSession, d: str) -> DataFrame:
    sizes, kinds = checkpointed(packing.token_counts(table(spark, d, "documents"))), table(spark, d, "pack_container")
    return packing.packing_faults(checkpointed(packing.packed(sizes, kinds)), sizes, kinds)


def p10_found(spark: SparkSession, d: str) -> DataFrame:
    return keyword_pages.keyword_pages(table(spark, d, "documents")).select("doc_id").distinct()


QUERIES = {
    "p3_found": p3_found,
    "p4_found": p4_found,
    "p4_clusters": p4_clusters,
    "p7_found": p7_found,
    "p7_members": p7_members,
    "p8_ids": p8_ids,
    "p8_round_trip": p8_round_trip,
    "p9_packed": p9_packed,
    "p9_fill": p9_fill,
    "p9_faults": p9_faults,
    "p10_found": p10_found,
}
ORACLES = {
    "p9_faults": "select container_kind, (select count(*) from documents) as n_items, 0 as wrong_sums, 0 as needless_splits, 0 as misplaced, 0 as overfull from (select distinct container_kind from pack_container)",
    "p8_round_trip": "select doc_id, coalesce(text, '') as text from documents",
}
