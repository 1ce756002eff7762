import uuid

import pytest
from helpers import values
from pyspark.sql import functions as F

from quern import staging
from quern.frames import Splits
from quern.sources import csv, jdbc, tables


def test_columns_bind_by_position_and_quotes_are_kept(spark, tmp_path):
    path = tmp_path / "a.csv"
    path.write_bytes(b'ID,CAT\r\n1,"x"\r\n2,R \r\n3,\r\n4,no newline')
    got = csv.read_positional(spark, str(path), "key int, label string")
    assert values(got) == [(1, '"x"'), (2, "R "), (3, None), (4, "no newline")]


def test_quoted_files(spark, tmp_path):
    path = tmp_path / "a.csv"
    path.write_text('a,b\n1,"x, ""y"""\n2,\n')
    assert values(csv.read_positional(spark, str(path), "a int, b string", quoted=True)) == [(1, 'x, "y"'), (2, None)]
    assert csv.read_inferred(spark, str(path)).dtypes == [("a", "int"), ("b", "string")]
    assert csv.read_text_columns(spark, str(path)).dtypes == [("a", "string"), ("b", "string")]


def test_a_value_of_the_wrong_type_fails_the_load(spark, tmp_path):
    (tmp_path / "a.csv").write_text("a\nx\n")
    with pytest.raises(Exception):
        csv.read_positional(spark, str(tmp_path / "a.csv"), "a int").collect()


def test_written_files(spark, tmp_path):
    df = spark.createDataFrame([(1, None, "é,\"")], "a int, b string, c string").coalesce(1)
    csv.write_csv(df, str(tmp_path / "out"))
    text = next((tmp_path / "out").glob("part-*")).read_text(encoding="utf-8")
    assert text == 'a,b,c\n1,,"é,"""\n'


def test_export_names_its_parts(spark, tmp_path):
    df = spark.range(3)
    assert csv.export(df, f"{tmp_path}/all.CSV") == [f"{tmp_path}/all.csv"]
    paths = csv.export(Splits(df, df, df), f"{tmp_path}/part")
    assert paths == [f"{tmp_path}/part_{k}.csv" for k in ("train", "validation", "test")]
    assert spark.read.csv(paths[2], header=True).count() == 3


def test_store_and_audit(spark, tmp_path):
    store, audit = tables.Store(str(tmp_path)), tables.LoadAudit()
    for rows in (5, 3):  # the second load replaces the first
        audit.run("silver", "t", spark.range(rows), lambda df: store.refresh(df, "silver", "t", ("id",)))
    assert store.read(spark, "silver", "t").count() == 3
    with pytest.raises(Exception):
        audit.run("silver", "bad", spark.range(3).select(F.expr("1 div (id - id)")), lambda df: df.collect())
    got = audit.frame(spark).collect()
    assert [(r["table"], r["rows"], r["status"]) for r in got] == [
        ("t", 5, "loaded"), ("t", 3, "loaded"), ("bad", None, "failed"),
    ]
    assert "DIVIDE_BY_ZERO" in got[2]["error"] and audit.total_seconds() > 0


def test_tables_loaded_side_by_side(spark, tmp_path):
    store, audit = tables.Store(str(tmp_path)), tables.LoadAudit()
    audit.run_all("bronze", {f"t{i}": spark.range(i) for i in range(1, 6)}, store.refresh)
    assert sorted((r.table, r.rows) for r in audit.records) == [(f"t{i}", i) for i in range(1, 6)]
    assert store.read(spark, "bronze", "t4").count() == 4
    broken = spark.range(1).select(F.expr("1 div (id - id)"))
    with pytest.raises(Exception, match="DIVIDE_BY_ZERO"):
        audit.run_all("bronze", {"fine": spark.range(1), "broken": broken}, store.refresh)
    assert {r.table: r.status for r in audit.records[5:]} == {"fine": "loaded", "broken": "failed"}


def test_layers_tables_and_views(spark):
    layer = "layer_" + uuid.uuid4().hex[:8]
    tables.create_layers(spark, [layer])
    try:
        tables.recreate_table(spark, f"{layer}.t", "a int")
        tables.append_table(spark.createDataFrame([(1,)], "a int"), f"{layer}.t")
        tables.append_table(spark.createDataFrame([(2,)], "a int"), f"{layer}.t")
        assert values(spark.table(f"{layer}.t")) == [(1,), (2,)]
        tables.append_table(spark.createDataFrame([(3,)], "a int"), f"{layer}.t", truncate=True)
        assert values(spark.table(f"{layer}.t")) == [(3,)]
        tables.publish_view(spark.table(f"{layer}.t"), "gold_view")
        assert spark.sql("select * from gold_view").count() == 1
    finally:
        spark.sql(f"drop database {layer} cascade")


def test_database_options():
    database = jdbc.Database("jdbc:x:y", "me", "secret")
    assert database.options() == {"url": "jdbc:x:y", "user": "me", "password": "secret"}
    assert "secret" not in repr(database)


def test_staged_rows_are_read_from_the_shared_folder(spark):
    df = staging.staged(spark.range(10))
    assert df.count() == 10
    assert df.inputFiles()[0].replace("file://", "").startswith(staging.shared_folder(spark).replace("file://", ""))
    small = staging.checkpointed(spark.range(3))
    assert small.count() == 3


def test_blanks_and_line_breaks_survive(spark, tmp_path):
    rows = [(1, "  padded  "), (2, "two\nlines"), (3, 'a "quote", and\r\nmore')]
    path = str(tmp_path / "out.csv")
    csv.write_csv(spark.createDataFrame(rows, "a int, b string"), path)
    assert values(csv.read_positional(spark, path, "a int, b string", quoted=True)) == rows
    assert values(csv.read_inferred(spark, path)) == rows
    assert [r[1] for r in values(csv.read_text_columns(spark, path))] == [b for _, b in rows]


def test_batch_time_is_not_the_sum_of_loads_side_by_side(spark):
    import time

    audit = tables.LoadAudit()
    slow = {f"t{i}": spark.range(1) for i in range(4)}

    def refresh(df, layer, table):
        time.sleep(0.5)
        df.collect()

    audit.run_all("bronze", slow, refresh)
    assert 0.5 <= audit.total_seconds() < sum(r.seconds for r in audit.records)
    assert all(r.started <= r.ended for r in audit.records)


def awkward_csv(chance, rows, end):
    """Lines of a file whose quoted values hold quotes, commas and line breaks of both kinds; some reach over many lines."""
    parts = ["a", "é", ",", '""', "\n", "\r\n", "\n\n", "word ", '"",""\n', "x" * 30]
    lines = ["id,text,more" + end]
    for i in range(rows):
        text = "".join(chance.choices(parts, k=chance.randrange(0, 12)))
        if chance.random() < 0.05:
            text = "long\n" * 200
        lines.append(f'{i},"{text}",{chance.choice(["", "plain", chr(34) + "quo,ted" + chr(34)])}{end}')
    return "".join(lines)


@pytest.mark.parametrize("size", ["400", "5000", "128m"])
def test_records_are_found_in_any_ranges(spark, tmp_path, size):
    import csv as library
    import io
    import random

    texts = [awkward_csv(random.Random(k), 150, end) for k, end in enumerate(("\n", "\r\n", "\n"))]
    for k, text in enumerate(texts):
        (tmp_path / f"f{k}.csv").write_bytes(text.encode())
    want = sorted(tuple(r) for t in texts for r in list(library.reader(io.StringIO(t, newline="")))[1:])
    schema = "id int, text string, more string"
    # Spark's own reader takes a whole file in one task; it turns the line breaks of values into one kind.
    plain = [str(tmp_path / f"f{k}.csv") for k in (0, 2)]
    same = values(csv.read_positional(spark, plain, schema, quoted=True, multi_line=True))
    old = {c: spark.conf.get(c) for c in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    spark.conf.set("spark.sql.files.openCostInBytes", "10")
    try:
        got = csv.read_positional(spark, str(tmp_path), schema, quoted=True)
        assert sorted((str(a), b or "", c or "") for a, b, c in got.collect()) == want and len(want) == 450
        assert values(csv.read_positional(spark, plain, schema, quoted=True)) == same
        texts = csv.read_text_columns(spark, str(tmp_path))
        assert texts.dtypes == [("id", "string"), ("text", "string"), ("more", "string")]
        assert sorted((a, b or "", c or "") for a, b, c in texts.collect()) == want
    finally:
        for name, value in old.items():
            spark.conf.set(name, value)


def test_names_and_ends_of_files(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes("﻿a,,b,A\r\n1,2,\"x\r\ny\",4".encode())
    got = csv.read_inferred(spark, str(tmp_path / "a.csv"))
    assert got.dtypes == [("a0", "int"), ("_c1", "int"), ("b", "string"), ("A3", "int")]
    assert values(got) == [(1, 2, "x\r\ny", 4)]
    (tmp_path / "b.csv").write_text("a,b\n")
    assert csv.read_text_columns(spark, str(tmp_path / "b.csv")).columns == ["a", "b"]
    assert csv.read_positional(spark, str(tmp_path / "b.csv"), "a int", quoted=True).count() == 0
