import pytest

from gleanwork.operators import index
from gleanwork.sources import records, stores

TAGGED = """.I 003
.T
a title
.A
somebody
.W
first line
second line .
.I 001
.W
.I 010
.W
only one line
with .W inside
.I 2
.W
last record
"""


def test_tagged_records(spark, tmp_path):
    (tmp_path / "docs.txt").write_text(TAGGED)
    got = {r["doc_id"]: r["text"] for r in records.read_documents(spark, str(tmp_path / "docs.txt")).collect()}
    assert got == {
        3: "first line\nsecond line .",
        1: "",
        10: "only one line\nwith .W inside",
        2: "last record",
    }


def test_query_numbers_are_positions(spark, tmp_path):
    (tmp_path / "q.txt").write_text(TAGGED)
    rows = records.read_queries(spark, str(tmp_path / "q.txt")).orderBy("query_id").collect()
    assert [(r["query_id"], r["source_id"]) for r in rows] == [(1, "001"), (2, "2"), (3, "003"), (4, "010")]


def test_judgments(spark, tmp_path):
    (tmp_path / "rel.txt").write_text("1 184 2 \n1 29  -1\n2 5 4\n2 5 4 \n\n225 1400 3\n")
    rows = records.read_judgments(spark, str(tmp_path / "rel.txt")).collect()
    assert sorted(tuple(r) for r in rows) == [(1, 29, -1), (1, 184, 2), (2, 5, 4), (2, 5, 4), (225, 1400, 3)]


def test_run_check(spark, tmp_path):
    (tmp_path / "run.txt").write_text("1 2 0.5 \n1 3 1e-05 \nx 3 0.1\n1 4 high\n1 5\n2 7 -0.25 \n")
    path = str(tmp_path / "run.txt")
    good, bad = records.check_run(spark, path)
    assert sorted(tuple(r) for r in good.collect()) == [(1, 2, 0.5), (1, 3, 1e-05), (2, 7, -0.25)]
    assert sorted(r["line"] for r in bad.collect()) == ["1 4 high", "1 5", "x 3 0.1"]
    with pytest.raises(ValueError):
        records.read_run(spark, path)
    assert records.read_run(spark, path, strict=False).count() == 3


def test_run_round_trip(spark, tmp_path):
    run = spark.createDataFrame(
        [(2, 1, 0.25), (1, 9, 0.5), (1, 3, 0.5), (1, 4, 0.75)], "query_id bigint, doc_id bigint, score double"
    )
    path = str(tmp_path / "run")
    records.write_run(run, path)
    lines = [
        line for part in sorted((tmp_path / "run").glob("part-*")) for line in part.read_text().splitlines()
    ]
    assert lines == ["1 4 0.75 ", "1 3 0.5 ", "1 9 0.5 ", "2 1 0.25 "]
    assert sorted(map(tuple, records.read_run(spark, path).collect())) == sorted(map(tuple, run.collect()))


def test_run_lines_are_split_once(spark, tmp_path):
    """A filter repeats the expressions of its conditions; the split is not to be among them."""
    (tmp_path / "run.txt").write_text("1 2 0.5 \n")
    good, _ = records.check_run(spark, str(tmp_path / "run.txt"))
    plan = good._jdf.queryExecution().executedPlan().toString()
    assert plan.count("split(") == 1


def test_strict_reading_is_one_job(spark, tmp_path):
    """The check reads all files at once and quotes the first bad line."""
    path = str(tmp_path / "run")
    lines = spark.range(0, 64, numPartitions=16).selectExpr("concat(id, ' 1 0.5 ') as value")
    lines.write.text(path)
    before = spark.conf.get("spark.sql.files.openCostInBytes")
    # One split per file, so that a job over a few splits would not see them all.
    spark.conf.set("spark.sql.files.openCostInBytes", "1g")
    spark.sparkContext.setJobGroup("strict", "strict")
    try:
        assert records.read_run(spark, path).count() == 64
        spark.sparkContext.setJobGroup("first", "first")
        bad = spark.range(0, 64, numPartitions=16).selectExpr("concat(id, if(id < 40, ' 1 0.5', ' x')) as value")
        bad.write.text(path + "-bad")
        files = sorted((tmp_path / "run-bad").glob("part-*"))
        assert len(files) == 16
        with pytest.raises(ValueError, match="'4[0-3] x'|'[4-6][0-9] x'"):
            records.read_run(spark, path + "-bad")
    finally:
        spark.conf.set("spark.sql.files.openCostInBytes", before)
        spark.sparkContext._jsc.clearJobGroup()
    tracker = spark.sparkContext.statusTracker()
    # The check is a map and a reduce side; the count adds two more.
    assert len(tracker.getJobIdsForGroup("strict")) <= 4


def test_index_csv_round_trip(spark, tmp_path):
    counts = spark.createDataFrame(
        [(d, t, 1) for t, ds in {'qu"ote': [1], "a,b": [2, 3], "flow": [1, 2, 9]}.items() for d in ds],
        "doc_id bigint, term string, tf bigint",
    )
    made = index.inverted_index(counts, block_size=4)
    stores.write_index_csv(made, str(tmp_path / "i"))
    back = stores.read_index_csv(spark, str(tmp_path / "i"))
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, made.collect()))
    numbers = spark.read.option("header", True).option("escape", '"').csv(str(tmp_path / "i"))
    rows = sorted(((int(r["row_no"]), r["Term"], r["Document"]) for r in numbers.collect()))
    assert rows[0] == (0, "a,b", "[2, 3]") and [n for n, _, _ in rows] == [0, 1, 2, 3]


def test_table_csv(spark, tmp_path):
    (tmp_path / "t.csv").write_text("id,age,delay,kind\n1,33,NaN,a\n2,41,2.5,b\n3,,1.5,\n")
    table = stores.read_table_csv(spark, str(tmp_path / "t.csv"))
    assert [f.dataType.simpleString() for f in table.schema] == ["int", "int", "double", "string"]
    assert [r["delay"] for r in table.orderBy("id").collect()] == [None, 2.5, 1.5]


def test_tagged_file_with_windows_line_ends(spark, tmp_path):
    path = tmp_path / "crlf"
    path.write_bytes(b".I 1\r\n.W\r\nfirst line\r\nsecond\r\n.I 2\r\n.T\r\nx\r\n.W\r\n.I 3\r\n.W\r\nlast")
    rows = records.read_documents(spark, str(path)).orderBy("doc_id").collect()
    assert [tuple(r) for r in rows] == [(1, "first line\nsecond"), (2, ""), (3, "last")]


def test_judgment_lines_need_three_numbers(spark, tmp_path):
    path = tmp_path / "judgments"
    path.write_text("1 2  3 \n1 2 3 4\n5 6\n1 99999999999999999999 2\n7 8 -1\n")
    rows, rejected = records.check_judgments(spark, str(path))
    assert sorted(tuple(r) for r in rows.collect()) == [(1, 2, 3), (7, 8, -1)]
    assert rejected.count() == 3
    with pytest.raises(ValueError):
        records.read_judgments(spark, str(path))


def test_run_lines_with_numbers_that_do_not_fit(spark, tmp_path):
    path = tmp_path / "run"
    path.write_text("99999999999999999999 3 0.4\n1 2 0.5\n")
    rows, rejected = records.check_run(spark, str(path))
    assert [tuple(r) for r in rows.collect()] == [(1, 2, 0.5)]
    assert rejected.count() == 1


def test_index_without_blocks(spark, tmp_path):
    path = tmp_path / "index"
    path.write_text(',Term,Document\n0,flow,"[3, 65540, 7]"\n1,wing,[2]\n')
    rows = stores.read_index_csv(spark, str(path)).collect()
    assert sorted((r[0], r[1], sorted(r[2])) for r in rows) == [
        ("flow", 0, [3, 7]),
        ("flow", 1, [65540]),
        ("wing", 0, [2]),
    ]
    path = tmp_path / "broken"
    path.write_text(",Term,Document\n0,flow,none\n")
    with pytest.raises(Exception, match="no list of documents"):
        stores.read_index_csv(spark, str(path)).collect()


def test_table_csv_quotes_and_missing_marks(spark, tmp_path):
    path = tmp_path / "table"
    path.write_text('id,said,n,x\n1,"he said ""hi, x""",4,0.5\n2,"two\nlines",NA,\n3,null,9999999999,nan\n')
    table = stores.read_table_csv(spark, str(path))
    assert [t for _, t in table.dtypes] == ["int", "string", "bigint", "double"]
    rows = [tuple(r) for r in table.orderBy("id").collect()]
    assert rows == [
        (1, 'he said "hi, x"', 4, 0.5),
        (2, "two\nlines", None, None),
        (3, None, 9999999999, None),
    ]
