import duckdb
from pyspark.sql import functions as F

from eventwatch.llm import lines, queries
from conftest_sql import oracle_rows
from fixtures import empty, frame, rows

BAR = "Subscribe to our newsletter"


def test_boilerplate_goes_and_copies_stay(spark):
    data = [(i, f"{BAR}\nbody {i} with far more than enough words to be the larger part of it all\n  {BAR}  \nend {i}", "en", f"s{i % 12}", 10, None, None) for i in range(60)]
    data += [(100 + i, "whole copy first line\nwhole copy second line", "en", f"s{i % 12}", 1, None, None) for i in range(24)]
    data += [(200 + i, "few sites line\nmore of my own text %d" % i, "en", f"s{i % 9}", 1, None, None) for i in range(40)]
    data += [(300, f"{BAR}\nno site of its own, but a long enough text", "en", None, 1, None, None)]
    got = {r.doc_id: r for r in lines.remove_boilerplate(frame(spark, data)).collect()}
    assert set(got) == {d[0] for d in data}
    for i in range(60):
        assert got[i].text == f"body {i} with far more than enough words to be the larger part of it all\nend {i}" and got[i].n_chars == len(got[i].text)
    assert all(got[100 + i].text == "whole copy first line\nwhole copy second line" for i in range(24))
    assert all(got[200 + i].text.startswith("few sites line") for i in range(40))
    assert got[300].text == "no site of its own, but a long enough text"


def test_short_pages_under_much_boilerplate_are_cut(spark):
    bars = f"{BAR}\nAll offers of the whole week at a glance"
    data = [(i, f"{bars}\nown {i}", "en", f"s{i % 12}", 1, None, None) for i in range(60)]
    data += [(100 + i, bars, "en", f"s{i % 12}", 1, None, None) for i in range(12)]
    got = {r.doc_id: r for r in lines.remove_boilerplate(frame(spark, data)).collect()}
    assert all(got[i].text == f"own {i}" and got[i].n_chars == len(f"own {i}") for i in range(60))
    assert all(got[100 + i].text == bars for i in range(12)) and len(got) == 72


def test_near_threshold_counts_are_exact(spark):
    data = [(f"line {n}", f"site {s}") for n in (8, 9, 10, 11, 12, 40) for s in range(n) for _ in range(3)]
    df = spark.createDataFrame(data, "l string, s string").select(F.xxhash64("l").alias("h"), F.xxhash64("s").alias("site"))
    want = {r[0] for r in df.groupBy("h").agg(F.countDistinct("site").alias("n")).where("n >= 10").collect()}
    assert {r[0] for r in lines.boilerplate(df, 10).collect()} == want


def test_odd_rows(spark):
    got = lines.remove_boilerplate(frame(spark)).collect()
    assert sorted(map(str, got)) == sorted(map(str, frame(spark).collect())) and len(got) == len(rows())
    assert lines.remove_boilerplate(empty(spark)).count() == 0
    assert lines.remove_boilerplate(frame(spark)).columns == frame(spark).columns


def test_a_clashing_column_stays(spark):
    df = frame(spark, [(1, "a\nb", "en", "s", 1, "x", "y")]).withColumnRenamed("Text_", "Lines")
    got = lines.with_kept_lines(df)
    assert got.columns == [*df.columns, "lines_"] and got.first()["Lines"] == "x" and got.first()["lines_"].n_lines == 2


def test_query_and_sql_on_pages_of_mostly_boilerplate(spark, tmp_path):
    """Short pages lose their bars, however little is left; pages of bars alone stay whole."""
    bars = f"{BAR}\n  All offers of the whole week at a glance "
    data = [(i, f"{bars}\n\nown {i}", f"s{i % 12}") for i in range(30)]
    data += [(100 + i, bars, f"s{i}") for i in range(12)] + [(200, None, None), (201, "", "s"), (202, f"{BAR}\nx", None), (None, f"{bars}\ny", "s")]
    spark.createDataFrame(data, "doc_id long, text string, source string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r for r in queries.op4_lines(spark, str(tmp_path)).collect()}
    want = duckdb.connect().sql(lines.ORACLE.replace("FROM documents", f"FROM read_parquet('{tmp_path}/documents.parquet/*.parquet')")).fetchall()
    assert {i: (r.n_lines, r.n_removed, r.kept_sha256) for i, r in got.items()} == {w[0]: w[1:] for w in want} and len(want) == len(data)
    assert [got[0].n_removed, got[100].n_removed, got[202].n_removed, got[None].n_removed] == [2, 0, 1, 2]


def test_query_equals_sql(spark):
    got, want = oracle_rows(spark, "op4_lines")
    assert got == want and len(got) == 200
