"""The queries of the training-data operators and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tamarack.llm import bpe, language, names, near_duplicates, packing, pii, quota_sample, spam, splits


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "p1_found": splits.p1_found,
        "p1_splits": splits.p1_splits,
        "p1_shares": splits.p1_shares,
        "p2_found": quota_sample.p2_found,
        "p2_report": quota_sample.p2_report,
        "p2_sample": quota_sample.p2_sample,
        "p3_found": names.p3_found,
        "p3_entities": names.p3_entities,
        "p4_found": language.p4_found,
        "p4_languages": language.p4_languages,
        "p5_found": near_duplicates.p5_found,
        "p5_groups": near_duplicates.p5_groups,
        "p6_found": pii.p6_found,
        "p6_masked": pii.p6_masked,
        "p7_ids": bpe.p7_ids,
        "p8_packed": packing.p8_packed,
        "p8_fill": packing.p8_fill,
        "p9_found": spam.p9_found,
        "p9_scores": spam.p9_scores,
    }


_TIED = """RECURSIVE parts AS (SELECT DISTINCT doc_id, unnest(list_filter([CASE WHEN trim(coalesce(near_dup_cluster, '')) <> '' THEN 'c:' || near_dup_cluster END]
      || list_transform(string_split(coalesce(org, ''), ' / '), lambda x: CASE WHEN trim(x) <> '' THEN 'o:' || x END), lambda x: x IS NOT NULL)) AS k FROM corpus_fixture),
  keys AS (SELECT doc_id, k, min(k) OVER (PARTITION BY doc_id) AS least FROM parts),
  edges AS (SELECT least AS a, k AS b FROM keys UNION SELECT k, least FROM keys),
  reach AS (SELECT a AS k, a AS r FROM edges UNION SELECT e.b, reach.r FROM reach JOIN edges e ON reach.k = e.a),
  comp AS (SELECT k, min(r) AS c FROM reach GROUP BY 1),
  tied AS (SELECT DISTINCT doc_id, c FROM keys JOIN comp USING (k))"""

_NEEDS = """units AS (SELECT t, count(DISTINCT CASE WHEN trim(coalesce(near_dup_cluster, '')) = '' THEN 'r:' || doc_id ELSE 'c:' || near_dup_cluster END) AS units
    FROM (SELECT *, regexp_replace(lower(trim(topic_seed)), '[ -]', '_', 'g') AS t FROM corpus_fixture) WHERE t <> '' GROUP BY 1),
  needs AS (SELECT DISTINCT plan_id, regexp_replace(lower(trim(topic_seed)), '[ -]', '_', 'g') AS topic_seed, greatest(target_share * sample_rows, min_rows) AS need FROM topic_targets)"""


def oracle_sql() -> dict[str, str]:
    return {
        "p1_found": f"WITH {_TIED} SELECT doc_id, min(doc_id) OVER (PARTITION BY c) AS group_id FROM tied QUALIFY count(*) OVER (PARTITION BY c) > 1",
        "p2_found": f"WITH {_NEEDS} SELECT plan_id, n.topic_seed FROM needs n LEFT JOIN units u ON u.t = n.topic_seed WHERE coalesce(units, 0) < need",
    }
