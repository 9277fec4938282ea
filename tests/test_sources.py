"""Sources and sinks on small files."""

import json

import pytest

from textloom.sources import io


def test_suffixes_and_phases(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "id long, text string")
    io.save_dataset(df, f"{tmp_path}/one")
    (tmp_path / "two.json").write_text(json.dumps([{"id": 1}, {"id": 2}, {"id": 3}]))
    (tmp_path / "three.jsonl").write_text('{"id": 1}\n{"id": 2}\n')
    (tmp_path / "four.csv").write_text("id,text\n1,x\n")
    (tmp_path / "bad").mkdir()
    (tmp_path / "_hidden").mkdir()
    got = io.scan_phase(spark, str(tmp_path))
    assert {k: v.count() for k, v in got.items()} == {"one": 2, "two": 3, "three": 2, "four": 1}
    assert io.scan_phase(spark, f"{tmp_path}/none") == {}
    assert io.first_existing(spark, [f"{tmp_path}/none", f"{tmp_path}/two.json"]) == f"{tmp_path}/two.json"
    assert io.first_existing(spark, [f"{tmp_path}/none"]) is None


def test_config_is_flat():
    c = io.CorpusConfig.of({"a": {"quality_threshold": 0.9, "target_languages": ["xml"]}, "quality_threshold": 0.1, "other": 1})
    assert (c.quality_threshold, c.target_languages, c.coherence_threshold) == (0.9, ("xml",), 0.6)


def test_reports(spark, tmp_path):
    a, b = spark.createDataFrame([(1, "x")], "id long, k string"), spark.createDataFrame([(2, 0.5)], "id long, score double")
    io.write_rows([a, b], f"{tmp_path}/out.csv")
    assert sorted((r.id, r.k, r.score) for r in io.read_dataset(spark, f"{tmp_path}/out.csv").collect()) == [("1", "x", None), ("2", None, "0.5")]
    assert json.loads(io.export_catalog(a)) == [{"id": 1, "k": "x"}]
    assert io.markdown_report("T", a) == "# T\n\n| id | k |\n|---|---|\n| 1 | x |\n"
    with pytest.raises(ValueError):
        io.export_catalog(a, "xml")
