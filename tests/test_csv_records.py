"""Quoted line breaks in CSV files that are read in many splits."""

import random

import pytest

from tenderlens import sources
from tenderlens.sources import csv_records as csv_module
from tenderlens.sources.csv_records import csv_records


def cell(draw):
    text = "".join(draw.choices(["a", "é", ",", '"', "\n", "\r\n", " ", "x" * 40, ""], k=draw.randint(0, 6)))
    plain = not any(c in text for c in ',"\n\r')
    return text if plain and draw.random() < 0.5 else '"' + text.replace('"', '""') + '"'


def rows_shuffled(plan):
    """Rows written by each shuffle of lines in an executed plan."""
    found, todo = [], [plan]
    while todo:
        node = todo.pop()
        name = node.nodeName()
        if name.startswith("AdaptiveSparkPlan"):
            todo.append(node.executedPlan())
            continue
        if name.endswith("QueryStage"):
            todo.append(node.plan())
            continue
        if name == "Exchange" and "value" in node.output().mkString(","):
            found.append(node.metrics().apply("shuffleRecordsWritten").value())
        todo += [node.children().apply(i) for i in range(node.children().size())]
    return found


def written(path, seed, end, rows=150):
    draw = random.Random(seed)
    lines = ["id,first,second"] + [f"{i},{cell(draw)},{cell(draw)}" for i in range(rows)]
    # A field over several splits, and blank lines between records.
    lines.insert(30, '900,"' + ("long line\n" * 300) + '",z')
    lines.insert(60, "")
    path.write_bytes((end.join(lines) + (end if seed % 2 else "")).encode())


@pytest.fixture
def small_splits(spark):
    """Splits of 700 bytes, so that quoted fields cross many of them."""
    before = spark.conf.get("spark.sql.files.maxPartitionBytes"), spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    yield spark
    spark.conf.set("spark.sql.files.maxPartitionBytes", before[0])
    spark.conf.set("spark.sql.files.openCostInBytes", before[1])


@pytest.mark.parametrize("seed, end", [(1, "\n"), (2, "\n"), (3, "\r\n")])
def test_same_rows_as_whole_files(small_splits, tmp_path, seed, end):
    spark = small_splits
    folder = tmp_path / "many"
    folder.mkdir()
    for i in range(2):
        written(folder / f"part{i}.csv", seed + 10 * i, end)
    assert spark.read.text(str(folder), lineSep="\n").rdd.getNumPartitions() > 12
    whole = sources.read_raw_csv(spark, str(folder), whole_files=True)
    split = sources.read_raw_csv(spark, str(folder))
    assert split.columns == whole.columns == ["id", "first", "second"]
    # Spark's reader turns line breaks in fields into line feeds where records end with CR LF.
    one, two = (sorted(repr(r).replace("\\r\\n", "\\n") for r in df.collect()) for df in (whole, split))
    assert len(two) == 2 * 151
    assert two == one


@pytest.mark.parametrize("bits", [0, 1, 2])
@pytest.mark.parametrize("seed, end", [(4, "\n"), (5, "\r\n")])
def test_same_rows_whatever_the_chunks(small_splits, tmp_path, monkeypatch, seed, end, bits):
    monkeypatch.setattr(csv_module, "_CHUNK_BITS", bits)
    test_same_rows_as_whole_files(small_splits, tmp_path, seed, end)


def test_lines_of_plain_chunks_are_not_shuffled(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(csv_module, "_CHUNK_BITS", 4)
    lines = ["a,b"] + [f'{i},"x"' for i in range(900)]
    lines[500] = '499,"x\ny"'
    (tmp_path / "a.csv").write_text("\n".join(lines) + "\n")
    got = sources.read_raw_csv(spark, str(tmp_path / "a.csv"))
    assert sorted(map(tuple, got.collect())) == sorted((str(i), "x\ny" if i == 499 else "x") for i in range(900))
    shuffled = rows_shuffled(got._jdf.queryExecution().executedPlan())
    assert max(shuffled) <= 2 * 16  # the first chunk and the one with the line break


def test_only_edges_are_put_together(small_splits, tmp_path):
    written(tmp_path / "a.csv", 5, "\n")
    records = csv_records(small_splits, str(tmp_path / "a.csv"))
    assert records.where("first").count() == 1
    assert records.count() == 152


@pytest.mark.parametrize("content, rows", [
    ("a,b", []), ("a,b\n", []), ("a,b\n1,2", [("1", "2")]), ("a,b\n\n1,2\n\n", [("1", "2")]),
    ('a,b\n"1\n2",\n', [("1\n2", None)]), ('"a\nc",b\n1,"""x"""\n', [("1", '"x"')]), ("a,b\n1\n1,2,3\n", [("1", None), ("1", "2")]),
])
def test_small_files(spark, tmp_path, content, rows):
    (tmp_path / "a.csv").write_text(content)
    for whole in (False, True):
        got = sources.read_raw_csv(spark, str(tmp_path / "a.csv"), whole_files=whole)
        assert sorted(map(tuple, got.collect()), key=repr) == sorted(rows, key=repr)


def test_missing_file(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        sources.read_raw_csv(spark, str(tmp_path / "none.csv"))


def test_each_record_is_parsed_once(spark, tmp_path):
    (tmp_path / "a.csv").write_text("a,b,c\n1,2,3\n4,5,6\n")
    got = sources.read_raw_csv(spark, str(tmp_path / "a.csv")).where("a > 1 and b > 1").select("a", "b", "c")
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_csv") == 1
    assert [tuple(r) for r in got.collect()] == [("4", "5", "6")]
