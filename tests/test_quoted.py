import random
import tracemalloc
import zipfile

import pytest
from frames import rows
from pyspark.sql import functions as F

from aforo.sources import files, quoted, trade


@pytest.fixture
def split(spark):
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    yield lambda size: spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
    spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def quoted_field(text):
    return '"' + text.replace('"', '""') + '"'


def table(seed, n):
    r = random.Random(seed)
    pieces = ["a", "\n", '"', ";", "\r\n", "ñ", " x ", "\n\n", "word " * 10]
    return [(str(i), "".join(r.choice(pieces) for _ in range(r.randint(1, 12))) + "z", "t") for i in range(n)]


@pytest.mark.parametrize("size", [150, 2000, 1 << 20])
@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_quoted_line_ends_at_any_split(spark, tmp_path, split, size, end):
    data = [table(s, 25) for s in range(2)]
    for s, part in enumerate(data):
        body = end.join(f"{a};{quoted_field(b)};{c}" for a, b, c in part)
        (tmp_path / f"Importaciones_{s}.txt").write_bytes((body + end * (s % 2)).encode())
    split(size)
    got = trade.read_trade(spark, str(tmp_path), ["a", "b", "c"])
    assert rows(got) == sorted((r for part in data for r in part), key=repr)


def test_a_record_over_many_splits(spark, tmp_path, split):
    long = "line\n" * 120
    (tmp_path / "t.txt").write_text(f'1;"{long}";x\n2;plain;y\n')
    split(50)
    assert rows(trade.read_trade(spark, str(tmp_path), ["a", "b", "c"])) == [("1", long, "x"), ("2", "plain", "y")]
    parity = quoted.split_parity(spark, str(tmp_path))
    assert parity.where("inside").count() > 10


def test_plain_files_go_to_the_own_reader(spark, tmp_path):
    (tmp_path / "t.txt").write_text('1;"a;b"\n2;c\n')
    got = trade.read_trade(spark, str(tmp_path), ["a", "b"])
    assert "FileScan csv" in got._jdf.queryExecution().executedPlan().toString()
    assert rows(got) == [("1", "a;b"), ("2", "c")]
    assert rows(trade.read_trade(spark, str(tmp_path), ["a", "b"], quoted_line_ends=True)) == rows(got)


def test_an_unclosed_quote_and_wrong_fields_fail(spark, tmp_path, split):
    (tmp_path / "t.txt").write_text('1;"a\nb"\n2;"open\n3;c\n')
    with pytest.raises(ValueError, match="not closed in .*t.txt"):
        trade.read_trade(spark, str(tmp_path), ["a", "b"])
    (tmp_path / "t.txt").write_text('1;"a\nb"\n2;c;d\n')
    with pytest.raises(Exception, match="(?i)malformed"):
        trade.read_trade(spark, str(tmp_path), ["a", "b"]).collect()
    (tmp_path / "t.txt").write_text('1;"' + "a\n" * 500 + '"\n2;c\n')
    with pytest.raises(Exception, match="malformed record: more than 100 characters"):
        quoted.read_records(spark, str(tmp_path), longest=100).collect()


def test_an_unclosed_quote_in_a_large_member_fails_early(spark, tmp_path):
    """A member of 8 MB: the reader stops within the bound of one record and holds no more than that."""
    with zipfile.ZipFile(tmp_path / "import_2021.zip", "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("Importaciones.txt", '1;a;b\n2;"open;b\n' + "3;plain text;b\n" * 600_000)
    found = files.trade_paths(spark, str(tmp_path))
    with pytest.raises(Exception, match="malformed record: .*fields are due"):
        trade.read_trade_archives(spark, found, "Import", ["x", "y", "z"]).write.format("noop").mode("overwrite").save()

    def lines():
        yield '2;"open;b\n'
        while True:
            yield "3;plain text;b\n"

    tracemalloc.start()
    with pytest.raises(ValueError, match="malformed"):
        list(trade._records(lines(), 3))
    assert tracemalloc.get_traced_memory()[1] < 12 * quoted.LONGEST_RECORD
    tracemalloc.stop()
    with pytest.raises(ValueError, match="5 fields"):
        list(trade._records(iter(['1;"a\n', 'b";c;d;e\n', "never reached\n"]), 3))


def test_long_lines_come_in_pieces():
    import io

    text = io.StringIO("a" * 3_000_000 + "\nb\n", newline="")
    assert list(trade._records(trade._lines(text), None, 1 << 22)) == ["a" * 3_000_000, "b"]
    assert list(trade._records(iter(['1;"x;\n', 'y"\r\n', "2;z"]), 2)) == ['1;"x;\ny"', "2;z"]


def test_landed_records_keep_their_archive(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "import_2021.zip", "w") as z:
        z.writestr("Importaciones.txt", "1;a\n")
    found = files.trade_paths(spark, str(tmp_path))
    got = trade.read_trade_archives(spark, found, "Import", ["x", "y"], keep=["path"])
    assert got.columns == ["path", "x", "y"] and got.where(F.col("path").endswith("import_2021.zip")).count() == 1


def test_small_splits_share_tasks(spark, tmp_path, split, monkeypatch):
    """Hundreds of splits, as many of them beginning inside quotes, are read by a few tasks, and so is what they leave."""
    data = [(str(i), f"line\nof {i}\n" * 9, "x") for i in range(400)]
    (tmp_path / "t.txt").write_text("".join(f"{a};{quoted_field(b)};{c}\n" for a, b, c in data))
    split(99)
    assert spark.read.text(str(tmp_path)).rdd.getNumPartitions() > 400
    few, made, stage = spark.sparkContext.defaultParallelism, [], quoted.staged

    def staged(df, name):
        made.append(df.rdd.getNumPartitions())
        return stage(df, name)

    monkeypatch.setattr(quoted, "staged", staged)
    monkeypatch.setattr(trade, "staged", staged)
    got = trade.read_trade(spark, str(tmp_path), ["a", "b", "c"])
    assert quoted.split_parity(spark, str(tmp_path)).where("inside").count() > 300
    assert len(made) == 2 and max(made) <= few and got.rdd.getNumPartitions() <= 2 * few
    assert rows(got) == sorted(data, key=repr)
