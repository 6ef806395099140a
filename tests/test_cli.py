from __future__ import annotations

import pytest

from tamarack import cli


def test_stages(spark, tmp_path, capsys):
    docs, corpus, gold, manifest = (str(tmp_path / n) for n in ("docs", "corpus", "gold", "manifest"))
    spark.createDataFrame([("a", "HEADING\n" + "w " * 200, "Org", "policy"), ("b", "HEADING\n" + "w " * 200, "Org", "policy")], "doc_id string, text string, organization string, source_type string").write.parquet(docs)
    rows = [(f"d{k:02d}", "o", "card", f"t{k % 2}", "", "x", "en") for k in range(20)]
    spark.createDataFrame(rows, "doc_id string, org string, card_text string, topic_seed string, near_dup_cluster string, stakeholder_type string, language string").write.parquet(corpus)
    spark.createDataFrame([("d01",)], "doc_id string").write.parquet(gold)
    spark.createDataFrame([("d02", "d03")], "doc_id string, duplicate_of string").write.parquet(manifest)
    assert cli.run(spark, ["clean", "--documents", docs, "--out", str(tmp_path / "c")]) == 0
    assert spark.read.parquet(str(tmp_path / "c")).count() == 2
    assert cli.run(spark, ["dedupe", "--documents", docs, "--dry-run"]) == 0
    assert cli.run(spark, ["chunk", "--documents", docs, "--out", str(tmp_path / "k"), "--rebuild"]) == 0
    assert spark.read.json(str(tmp_path / "k")).count() == 2
    assert cli.run(spark, ["split", "--corpus", corpus, "--gold", gold, "--manifest", manifest, "--check"]) == 0
    assert cli.run(spark, ["gold", "--corpus", corpus, "--limit", "3", "--dry-run"]) == 0
    assert cli.run(spark, ["report", "--corpus", corpus]) == 0
    assert "gold: 3 rows" in capsys.readouterr().out
    with pytest.raises(SystemExit):
        cli.run(spark, ["nothing"])
