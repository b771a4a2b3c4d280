import json

import pytest
from pyspark.sql import functions as F

from tidemark.plans import partitioned_job
from tidemark.session import spark_session
from tidemark.sources import scans, sinks


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_from_files_takes_matching_names_only(spark, tmp_path):
    (tmp_path / "2021-01-13-a.json").write_text('{"id": 1}\n')
    (tmp_path / "2021-01-13-b.json").write_text('{"id": 2}\n')
    (tmp_path / "2021-01-14-a.json").write_text('{"id": 3}\n')
    assert rows(scans.from_files(spark, str(tmp_path), "2021-01-13-*", "json")) == [(1,), (2,)]


def test_json_lines_keep_nested_text(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"device": "x", "ecommerce": "{\\"price\\": 2}"}\n')
    df = scans.json_lines(spark, str(tmp_path), "device string, ecommerce string")
    assert df.select(F.from_json("ecommerce", "price int")["price"]).first()[0] == 2


def test_json_array_documents(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps([{"id": 1}, {"id": 2}]))
    assert rows(scans.json_array(spark, str(tmp_path), "id int")) == [(1,), (2,)]


def test_csv_with_header(spark, tmp_path):
    (tmp_path / "a.csv").write_text("a,b\n1,x\n")
    assert scans.csv_with_header(spark, str(tmp_path)).first().asDict() == {"a": "1", "b": "x"}


def test_stage_is_trimmed_quoted_and_positional(spark, tmp_path):
    (tmp_path / "a.csv").write_text('h1,h2,h3\n  a , "b,c" ,3\n')
    assert rows(scans.stage_files(spark, str(tmp_path), 3)) == [("a", "b,c", "3")]


def test_each_file_has_its_own_separator(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,place\n" + "".join(f'{k},"x|{k}"\n' for k in range(40)))
    (tmp_path / "b.txt").write_text("place|id\n" + "".join(f"a, b, {k}|{k}\n" for k in range(100, 130)))
    found = {r.id: r.place for r in scans.discovered_files(spark, str(tmp_path)).collect()}
    assert found == {k: f"x|{k}" for k in range(40)} | {k: f"a, b, {k}" for k in range(100, 130)}


@pytest.mark.parametrize("separator", [",", "|", ";", "\t"])
def test_separator_and_types_are_discovered(spark, tmp_path, separator):
    lines = [["id", "place, x" if separator != "," else "place", "price"], ["1", "a", "1.5"], ["2", "b", "2.5"]]
    (tmp_path / "f.txt").write_text("\n".join(separator.join(x) for x in lines) + "\n")
    df = scans.discovered_files(spark, str(tmp_path))
    assert [r.separator for r in scans.file_separators(spark, str(tmp_path)).collect()] == [separator]
    assert [kind for _, kind in df.dtypes] == ["int", "string", "double"]
    assert rows(df) == [(1, "a", 1.5), (2, "b", 2.5)]


def test_stage_listing_reads_no_content(spark, tmp_path, plan):
    (tmp_path / "sub").mkdir()
    (tmp_path / "sub" / "a.csv").write_text("12345")
    (tmp_path / "b.csv").write_text("1")
    listing = scans.stage_listing(spark, str(tmp_path))
    assert sorted(r["size"] for r in listing.collect()) == [1, 5]
    assert "content" not in plan(listing).split("ReadSchema")[1]


def test_envelope_keeps_undecodable_bodies(spark):
    bodies = spark.createDataFrame(
        [(1, '{"id": "a", "n": 2}'), (2, "{broken"), (3, None), (4, '{"id": "b"}')], "seq int, body string"
    )
    decoded = scans.envelope(bodies, "id string, n int").orderBy("seq").collect()
    assert [tuple(r) for r in decoded] == [
        (1, "a", 2, None), (2, None, None, "{broken"), (3, None, None, None), (4, "b", None, None)
    ]


def test_column_metadata_orders_and_falls_back(spark):
    spark.sql("DROP TABLE IF EXISTS meta_live")
    spark.sql("CREATE TABLE meta_live (a INT, p STRING, b DOUBLE) USING parquet PARTITIONED BY (p)")
    known = {
        "meta_live": [{"name": "a", "type": "x", "description": "first"}],
        "meta_gone": [{"name": "z", "type": "bigint"}],
    }
    found = scans.column_metadata(spark, ["meta_live", "meta_gone", "meta_unknown"], known)
    assert rows(found.select("table_name", "position", "column_name", "data_type")) == [
        ("meta_gone", 1, "z", "bigint"),
        ("meta_live", 1, "a", "int"), ("meta_live", 2, "b", "double"), ("meta_live", 3, "p", "string"),
    ]
    assert found.filter("column_name = 'a'").first().description == "first"
    assert scans.catalog_table(spark, "default", "meta_live").columns == ["a", "b", "p"]


def test_partitioned_job_appends_and_prunes(spark, tmp_path, plan):
    (tmp_path / "in").mkdir()
    stamps = ["2024-01-05T10:00:00", "2024-01-05T11:00:00", "2024-02-01T00:00:00"]
    (tmp_path / "in" / "2024-a.json").write_text("\n".join(json.dumps({"id": i, "created_at": s}) for i, s in enumerate(stamps)))
    out = str(tmp_path / "out")
    schema = "id int, created_at timestamp"
    for limit in (None, 16):
        partitioned_job.run(spark, str(tmp_path / "in"), "2024", "json", out, "parquet", schema, max_tasks=limit)
    back = spark.read.parquet(out)
    assert back.count() == 6
    january = back.filter("year = 2024 AND month = 1 AND day = 5")
    assert january.count() == 4
    assert "PartitionFilters: [isnotnull(year" in plan(january)


def test_single_export_has_no_header(spark, tmp_path):
    sinks.export_single_csv(spark.createDataFrame([("a", 1), ("b", 2)], "k string, n int"), str(tmp_path / "k"))
    files = list((tmp_path / "k").glob("part-*.csv"))
    assert len(files) == 1 and files[0].read_text() == "a,1\nb,2\n"


def test_table_writes(spark):
    for name in ("w_target", "w_copy"):
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    stage = spark.createDataFrame([("a", "1"), ("b", "2")], "c1 string, c2 string")
    columns = [("c2", "bigint", "n"), ("c1", "string", "k")]
    sinks.copy_into(stage, columns, "w_target")
    sinks.copy_into(stage, columns, "w_target")
    assert spark.table("w_target").count() == 4
    one = spark.createDataFrame([("c", 3)], "k string, n bigint")
    sinks.insert_append(one, "w_target")
    sinks.insert_append(one, "w_target")
    assert spark.table("w_target").count() == 6
    sinks.insert_overwrite(one, "w_target")
    sinks.insert_overwrite(one, "w_target")
    assert rows(spark.table("w_target").select("k", "n")) == [("c", 3)]
    sinks.create_or_replace(spark.createDataFrame([(1.5,)], "x double"), "w_copy")
    sinks.create_or_replace(one, "w_copy")
    assert spark.table("w_copy").columns == ["k", "n"]
    sinks.truncate(spark, "w_copy")
    assert spark.table("w_copy").count() == 0 and spark.table("w_copy").columns == ["k", "n"]


def test_split_write_covers_every_row(spark, tmp_path):
    df = spark.createDataFrame([(1, True), (2, False), (3, None)], "id int, ok boolean")
    sinks.split_write(df, F.col("ok"), str(tmp_path / "p"), str(tmp_path / "f"))
    read = lambda side: sorted(r.id for r in spark.read.schema("id int").json(str(tmp_path / side)).collect())
    assert (read("p"), read("f")) == ([1], [2, 3])


def test_puts_replace_by_key_and_replay(spark, tmp_path):
    path, schema = str(tmp_path / "puts"), "id string, n int"
    assert sinks.read_puts(spark, path, schema, ["id"]).count() == 0
    first = spark.createDataFrame([("a", 1), ("b", 2)], schema)
    second = spark.createDataFrame([("b", 3), ("c", 4)], schema)
    sinks.put_batch(first, path, 0)
    sinks.put_batch(second, path, 1)
    sinks.put_batch(first, path, 0)
    expected = [("a", 1), ("b", 3), ("c", 4)]
    assert rows(sinks.read_puts(spark, path, schema, ["id"])) == expected
    assert rows(sinks.compact_puts(spark, path, schema, ["id"], str(tmp_path / "base"))) == expected


def test_unknown_environment_is_refused():
    with pytest.raises(ValueError):
        spark_session("TEST", "x")


def test_overwrite_touches_only_its_partitions(spark, tmp_path):
    """Files of other partitions keep name and time; a NULL partition and an empty batch are fine."""
    path = str(tmp_path / "months")
    frame = lambda data: spark.createDataFrame(data, "month string, n int")
    files = lambda: {(r.month, r.file, r.modified) for r in sinks.partition_files(spark, path, "month").collect()}
    sinks.overwrite_partitions(frame([("2024-01", 1), ("2024-02", 2), (None, 3)]), path, ["month"])
    before = files()
    for _ in range(2):
        sinks.overwrite_partitions(frame([("2024-02", 20), ("2024-03", 30)]), path, ["month"])
    after = files()
    kept = {f for f in before if f[0] != "2024-02"}
    assert kept < after and {f for f in after - kept if f[0] not in ("2024-02", "2024-03")} == set()
    assert not {f for f in before if f[0] == "2024-02"} & after
    read = lambda: sorted(((r.month or "", r.n) for r in spark.read.schema("n int, month string").parquet(path).collect()))
    assert read() == [("", 3), ("2024-01", 1), ("2024-02", 20), ("2024-03", 30)]
    sinks.overwrite_partitions(frame([]), path, ["month"])
    assert files() == after
