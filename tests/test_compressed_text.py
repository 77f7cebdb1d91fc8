from pathlib import Path

from data import gold
from farevalue.operators import publish
from farevalue.plans.catalog import write_raw
from farevalue.plans.star_schema import single_fare_envelopes
from farevalue.sources.readers import REJECTED, read_envelopes


def test_documents_are_written_compressed_and_read_back(spark, tmp_path):
    source, target = str(tmp_path / "gold"), str(tmp_path / "serving")
    gold(spark, {}, {"flight_id": "f2"}).write.parquet(source)
    assert publish.publish(spark, source, target).documents == 2
    files = [f for f in Path(target).rglob("part-*") if "documents" in f.parts]
    assert files and all(f.name.endswith(".gz") for f in files)
    ids = sorted(r["_id"] for r in publish.read_documents(spark, target).collect())
    assert ids == ["f1", "f2"]


def test_raw_envelopes_are_written_compressed_and_read_back(spark, tmp_path):
    path = str(tmp_path / "raw")
    write_raw(single_fare_envelopes(gold(spark, {}, {"flight_id": "f2"})), path)
    assert all(f.name.endswith(".json.gz") for f in Path(path).glob("part-*"))
    rows = read_envelopes(spark, path).collect()
    assert len(rows) == 2 and all(r[REJECTED] is None for r in rows)
