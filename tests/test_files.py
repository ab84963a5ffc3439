"""S1-S6, S9-S11 on files shaped like the real ones."""

import csv
import json
from pathlib import Path

import pytest

from pyspark.sql import functions as F

from jobsieve import constants as C
from jobsieve.sources import files


def put(folder: Path, name: str, content: str) -> str:
    path = folder / name
    path.write_bytes(content.encode("utf-8"))
    return str(path)


def test_lists(spark, tmp_path):
    customers = put(tmp_path, "customers.csv", '﻿company_name,company_website\r\n"Big, ""Co""\nLtd",www.Big.com\r\n\r\nNo Site,\r\n,x.com/\r\nno  site,\r\n')
    active = put(tmp_path, "current jobs.csv", "id,external_url,company_name,company_website\r\n1,https://A.com/x/,Act,act.com\r\n2,,Act,\r\n")
    keys = files.read_list_keys(spark, {
        "customers": customers, "active": active, "blacklist": str(tmp_path / "none.csv"), "churned": str(tmp_path / "none2.csv"),
    })
    assert sorted(tuple(r) for r in keys.collect()) == [
        ("active", "domain", "act.com"), ("active", "name", "act"), ("active", "url", "https://A.com/x"), ("customers", "domain", "big.com"),
        ("customers", "domain", "x.com"), ("customers", "name", 'big, "co" ltd'), ("customers", "name", "no site"),
    ]


def test_keywords(spark, tmp_path):
    path = put(tmp_path, "irrelevant names.csv", "irrelevant_names\r\nCAD\r\n  Lab   Technician \r\n\"\"\r\n")
    assert sorted(r.keyword for r in files.read_keywords(spark, path).collect()) == ["cad", "lab technician"]
    assert files.read_keywords(spark, str(tmp_path / "none.csv")).count() == 0
    with pytest.raises(ValueError, match="irrelevant_names"):
        files.read_keywords(spark, put(tmp_path, "bad.csv", "x\r\n1\r\n"))


def test_company_domains(spark, tmp_path):
    path = put(tmp_path, "companies.csv", "﻿company_domain\r\nb.com\r\nhttps://www.A.com/x\r\nb.com/\r\n\r\na.com\r\n" + "".join(f"c{i}.com\r\n" for i in range(9)))
    got = files.read_company_domains(spark, path, 5).orderBy("ord").collect()
    assert [r.company_domain for r in got] == ["b.com", "a.com", "c0.com", "c1.com", "c2.com"]
    assert files.read_company_domains(spark, path).count() == 11
    assert files.read_company_domains(spark, str(tmp_path / "none.csv")).count() == 0
    with pytest.raises(ValueError, match="company_domain"):
        files.read_company_domains(spark, put(tmp_path, "bad.csv", "x\r\n1\r\n"))


def test_career_pages(spark, tmp_path):
    path = put(tmp_path, "pages.csv", "career_page\r\nhttps://www.x.com/jobs/\r\nx.com/jobs\r\nhttps://www.x.com/jobs\r\nhttpfoo.com\r\n\r\n,\r\ny.com\r\n")
    got = files.read_career_pages(spark, path).orderBy("ord").collect()
    assert [(r.company_domain, r.career_page) for r in got] == [("x.com", "https://www.x.com/jobs"), ("x.com", "https://x.com/jobs"), ("y.com", "https://y.com")]
    assert [r.career_page for r in files.read_career_pages(spark, path, 1).collect()] == ["https://www.x.com/jobs"]
    assert files.read_career_pages(spark, str(tmp_path / "none.csv")).isEmpty()


def test_csv_and_json_outputs(spark, tmp_path):
    rows = [('a "quoted", b', "line\nbreak", "", None), ("é", "x", "y", "z")]
    df = spark.createDataFrame(rows, "a string, b string, c string, d string").coalesce(1)
    files.write_csv(df, str(tmp_path / "out"), ["d", "a", "b", "c"])
    part = next((tmp_path / "out").glob("part-*"))
    with part.open(newline="", encoding="utf-8") as f:
        assert list(csv.reader(f)) == [["d", "a", "b", "c"], ["", 'a "quoted", b', "line\nbreak", ""], ["z", "é", "x", "y"]]
    files.write_trace(df.fillna(""), str(tmp_path / "trace"))
    lines = next((tmp_path / "trace").glob("part-*")).read_text(encoding="utf-8").splitlines()
    assert json.loads(lines[0]) == {"a": 'a "quoted", b', "b": "line\nbreak", "c": "", "d": ""}


def test_rows_are_numbered_across_files(spark, tmp_path):
    folder = tmp_path / "lists"
    folder.mkdir()
    names = [f"d{i % 37}.com" for i in range(200)]
    for k in range(8):
        own = names[k * 25 : (k + 1) * 25]
        put(folder, f"part-{k}.csv", "company_domain,note\n" + "".join(f'{n},"two\nlines"\n' for n in own))
    first = {}
    for i, name in enumerate(names):
        first.setdefault(name, i)
    for size in ("128m", "100", "400"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        try:
            got = {r.company_domain: r.ord for r in files.read_company_domains(spark, str(folder)).collect()}
            assert got == first
            lines = spark.read.csv(str(folder), header=False)  # files that are split
            ords = [r.ord for r in files.numbered(lines).select("ord").collect()]
            assert sorted(ords) == list(range(len(ords)))
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_answer_table(spark, tmp_path):
    spark.createDataFrame([("job", "u", "{}")], "stage string, url string, response_text string").write.parquet(str(tmp_path / "a"))
    row = files.read_answers(spark, str(tmp_path / "a")).first()
    assert (row.stage, row.render_pass, row.answered_ord) == ("job", None, None)


def test_bucketed_tables_join_in_place(spark, tmp_path):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = spark.range(500).select(F.concat(F.lit("u"), "id").alias("url"), F.col("id").alias("x"))
        table = files.bucketed(df, str(tmp_path), "t", "url")
        joined = spark.range(400, 600).select(F.concat(F.lit("u"), "id").alias("k")).join(table, F.col("k") == F.col("url"), "left")
        assert joined.filter("x is not null").count() == 100
        plan = joined._jdf.queryExecution().toString()
        assert plan.split("== Physical Plan ==")[1].count("Exchange hashpartitioning") == 1
        assert not [t for t in spark.catalog.listTables() if t.name.startswith("jobsieve_")]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_output_columns():
    assert len(C.JOB_COLUMNS) == 15 and C.JOB_COLUMNS[0] == "List" and len(C.SKIP_COLUMNS) == 8


def test_rows_of_one_small_file_are_dealt_over_all_tasks(spark, tmp_path):
    spark.range(400).coalesce(1).write.parquet(str(tmp_path / "small"))
    rows = files.spread(spark.read.parquet(str(tmp_path / "small")))
    sizes = [n for n in rows.rdd.mapPartitions(lambda part: [sum(1 for _ in part)]).collect()]
    assert len(sizes) >= 4 and max(sizes) < 200
    assert sorted(r.id for r in rows.collect()) == list(range(400))
