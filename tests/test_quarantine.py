"""Records in are records loaded and records refused."""

from pyspark.sql import functions as F

from tidemark.sources.quarantine import load_or_quarantine, replay

SCHEMA = "id bigint, name string, price double"


def files(tmp_path, suffix, *texts):
    for i, text in enumerate(texts):
        (tmp_path / f"f{i}.{suffix}").write_text(text)
    return str(tmp_path)


def test_json_records_are_loaded_or_kept_with_their_file(spark, tmp_path):
    path = files(
        tmp_path, "json",
        '{"id": 1, "name": "a", "price": 2.5}\n\n{"id": 2, "name": "b"\n',
        '{"id": 3, "price": "dear"}\nnot json\n{"id": 4, "name": null, "extra": 1}\n',
    )
    loaded, refused = load_or_quarantine(spark, path, SCHEMA, "json")
    assert sorted(tuple(r) for r in loaded.collect()) == [(1, "a", 2.5), (4, None, None)]
    kept = sorted((r.file[-7:], r.record, r.split_start) for r in refused.collect())
    assert kept == [("f0.json", '{"id": 2, "name": "b"', 0), ("f1.json", "not json", 0), ("f1.json", '{"id": 3, "price": "dear"}', 0)]

    again, left = replay(refused, lambda r: F.when(r.startswith("{"), F.concat(F.regexp_replace(r, "}$", ""), F.lit("}"))), SCHEMA)
    assert [tuple(r) for r in again.collect()] == [(2, "b", None)]
    assert left.columns == refused.columns
    assert sorted(r.record for r in left.collect()) == ["not json", '{"id": 3, "price": "dear"}']


def test_csv_records_of_other_width_or_type_are_kept(spark, tmp_path):
    path = files(tmp_path, "csv", "id,name,price\n1,a,2.5\n2,b\n3,c,4,5\nx,d,1\n5,,\n", "id,name,price\n")
    loaded, refused = load_or_quarantine(spark, path, SCHEMA, "csv", {"header": "true"})
    assert sorted(tuple(r) for r in loaded.collect()) == [(1, "a", 2.5), (5, None, None)]
    assert sorted(r.record for r in refused.collect()) == ["2,b", "3,c,4,5", "x,d,1"]


def test_files_without_records(spark, tmp_path):
    loaded, refused = load_or_quarantine(spark, files(tmp_path, "json", ""), SCHEMA, "json")
    assert (loaded.count(), refused.count(), loaded.columns) == (0, 0, ["id", "name", "price"])
    assert replay(refused, lambda r: r, SCHEMA)[0].count() == 0
