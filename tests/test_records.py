"""Quoted records with line breaks, from files read in pieces."""

import random

import pytest

from finchlake.sources import labelled as src
from finchlake.sources.records import tsv_records

PIECES = "spark.sql.files.maxPartitionBytes"


@pytest.fixture
def small_pieces(spark):
    old, cost = spark.conf.get(PIECES), spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set(PIECES, "2000")
    spark.conf.set("spark.sql.files.openCostInBytes", "100")
    yield
    spark.conf.set(PIECES, old)
    spark.conf.set("spark.sql.files.openCostInBytes", cost)


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_pieces_equal_whole_files(spark, tmp_path, small_pieces):
    rnd = random.Random(5)
    alphabet = ["a", "b c", '"', '""', "\n", "\n\n", "\t", "x" * 40, "\r\n", "é😀", ",", '"\n', "\n\"\""]
    rows = [(i, rnd.choice(["pos", "neg", ""]), "".join(rnd.choices(alphabet, k=rnd.randint(0, 14)))) for i in range(900)]
    rows += [(900, "pos", 'q"\n' * 3000), (901, "neg", "\n" * 5000), (902, "pos", "plain")]   # longer than a piece
    df = spark.createDataFrame(rows, "id long, label string, text string")
    path = str(tmp_path / "rows")
    src.write_labelled(df.coalesce(1), path)
    assert spark.read.text(path).rdd.getNumPartitions() > 20
    got = rows_of(src.read_labelled_pieces(spark, path))
    assert got == rows_of(src.read_labelled_with_id(spark, path)) and len(got) == len(rows)


def test_loose_quotes_and_endings(spark, tmp_path):
    raw = '1\tpos\the said "hi\n2\tneg\t"a\nb ""c"" \n"\n\n3\tpos\t5" and 6"\r\n4\t"n\ng"\tlast'
    (tmp_path / "a.tsv").write_bytes(raw.encode())
    (tmp_path / "empty.tsv").write_bytes(b"")
    assert sorted(r["value"] for r in tsv_records(spark, str(tmp_path)).collect()) == [
        '1\tpos\the said "hi', '2\tneg\t"a\nb ""c"" \n"', '3\tpos\t5" and 6"', '4\t"n\ng"\tlast']
    assert rows_of(src.read_labelled_pieces(spark, str(tmp_path))) == [
        (1, "pos", 'he said "hi'), (2, "neg", 'a\nb "c" \n'), (3, "pos", '5" and 6"'), (4, "n\ng", "last")]


def test_open_quotes_end_with_their_file(spark, tmp_path):
    (tmp_path / "a.tsv").write_text('1\tpos\t"never closed\nmore')
    (tmp_path / "b.tsv").write_text("2\tneg\tplain\n")
    assert sorted(r["value"] for r in tsv_records(spark, str(tmp_path)).collect()) == [
        '1\tpos\t"never closed\nmore', "2\tneg\tplain"]
