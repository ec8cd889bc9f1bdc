"""Multi-line CSV cut by many tasks, against the one-task reader."""

import csv
import io
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from ratingscope.sources import read_csv
from ratingscope.sources.records import _Cutter, inside_after


def rows_of(df):
    return sorted(map(str, df.collect()))


@pytest.fixture
def small_pieces(spark):
    """Files are cut every few hundred bytes."""
    names = ["spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes"]
    before = {n: spark.conf.get(n) for n in names}
    for n in names:
        spark.conf.set(n, "300")
    yield
    for n, v in before.items():
        spark.conf.set(n, v)


def written(path, text):
    path.mkdir()
    (path / "a.csv").write_text(text, encoding="utf-8", newline="")
    return str(path)


def field(rng):
    pool = ["", "a", "b c", "é", "line\nbreak", "\n", "\n\n", 'say ""hi""', "x,y", "'", "tab\t", "end\r\nof"]
    return "".join(rng.choice(pool) for _ in range(rng.randrange(4)))


@pytest.mark.parametrize("seed", range(4))
def test_equals_the_one_task_reader(spark, tmp_path, small_pieces, seed):
    rng = random.Random(seed)
    out = io.StringIO()
    writer = csv.writer(out, quoting=csv.QUOTE_ALL if seed % 2 else csv.QUOTE_MINIMAL, lineterminator="\r\n" if seed == 3 else "\n")
    writer.writerow(["id", "text", "more"])
    for i in range(400):
        writer.writerow([i, field(rng).replace('""', '"'), field(rng).replace('""', '"')])
    path = written(tmp_path / "x", out.getvalue())
    one = read_csv(spark, path, multiline=True)
    many = read_csv(spark, path, multiline=True, parallel=True)
    assert many.columns == one.columns and rows_of(many) == rows_of(one)
    assert one.rdd.getNumPartitions() == 1


@pytest.mark.parametrize("broken", ['7,"open', '7,5" wide,x', '7,"shut"tail,x\n8,"a ""b"" c",y', '"9"",a\n,b",c', "", "\n\n"])
@pytest.mark.parametrize("end", ["\n", ""])
def test_broken_quotes(spark, tmp_path, small_pieces, broken, end):
    good = "".join(f'{i},"t {i}\nnext, line",z\n' for i in range(60))
    path = written(tmp_path / "x", f"id,text,more\n{good}{broken}\n{good}1,2,3{end}")
    assert rows_of(read_csv(spark, path, multiline=True, parallel=True)) == rows_of(read_csv(spark, path, multiline=True))


def test_more_than_one_file_and_piece(spark, tmp_path, small_pieces):
    path = written(tmp_path / "x", "id,text\n" + '1,"a\nb"\n' * 200)
    (tmp_path / "x" / "b.csv").write_text("id,text\n" + '2,"' + "long\n" * 400 + '"\n')
    (tmp_path / "x" / "c.csv").write_text("id,text\n")
    many = read_csv(spark, path, multiline=True, parallel=True)
    assert rows_of(many) == rows_of(read_csv(spark, path, multiline=True)) and many.count() == 201
    scan = spark.read.text(path)
    assert scan.rdd.getNumPartitions() > 5


def test_a_header_that_differs_is_an_error(spark, tmp_path):
    path = written(tmp_path / "x", "id,text\n1,a\n")
    (tmp_path / "x" / "b.csv").write_text("id,other\n2,b\n")
    with pytest.raises(Exception, match="header of"):
        read_csv(spark, path, multiline=True, parallel=True).collect()
    with pytest.raises(ValueError):
        read_csv(spark, path, parallel=True)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet='a,"\n', max_size=40), st.integers(0, 40))
def test_pieces_come_to_the_whole(text, cut):
    """The state after a piece, by its own guess, leads on like the state of the whole text."""
    lines = text.split("\n")
    cut = min(cut, len(lines))
    state = False
    for line in lines:
        state = inside_after(line, state, ",")
    middle = False
    for line in lines[:cut]:
        middle = inside_after(line, middle, ",")
    cutter = _Cutter(middle)
    for n, line in enumerate(lines[cut:]):
        cutter.line(line, ",", n)
    assert cutter.inside == state
