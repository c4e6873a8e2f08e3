"""Key ranges over numbers and text, and an operator on keys that are text."""

import random

import pytest

from finchlake.llm import common
from finchlake.llm.order_minhash import order_minhash


def keys(seed=3, n=700):
    rnd = random.Random(seed)
    made = {"doc-" + "".join(rnd.choices("aäz09😀|\"\\", k=rnd.randint(0, 6))) for _ in range(n)}
    return sorted(made, key=lambda k: k.encode("utf-8"))


@pytest.mark.parametrize("kind", ["string", "long", "date"])
def test_parts_rise_with_the_key(spark, kind):
    if kind == "date":
        df = spark.sql("SELECT date_add(date'2020-01-01', CAST(id AS int)) AS `the key` FROM range(500) UNION ALL SELECT NULL")
    else:
        values = keys() if kind == "string" else list(range(-100, 500))
        df = spark.createDataFrame([(v,) for v in values * 2 + [None]], f"`the key` {kind}")
    rows = common.key_ranges(df, "the key", 16)(df).collect()
    known = [r for r in rows if r["the key"] is not None]
    order = sorted(known, key=lambda r: r["the key"].encode("utf-8") if kind == "string" else r["the key"])
    parts = [r["part"] for r in order]
    assert parts == sorted(parts) and len(set(parts)) > 12 and {r["part"] for r in rows if r["the key"] is None} == {0}
    assert max(parts.count(p) for p in set(parts)) < len(parts) / 8


def test_one_key_and_no_rows(spark):
    for rows in ([], [("a",)] * 20, [(None,)]):
        df = spark.createDataFrame(rows, "k string")
        got = common.key_ranges(df, "k", 5)(df).collect()
        assert len(got) == len(rows) and len({r["part"] for r in got}) <= 1


def test_count_grows_with_the_rows(spark, monkeypatch):
    assert common.range_count(spark.range(100), 8) == 8
    monkeypatch.setattr(common, "ROWS_PER_RANGE", 5)
    assert common.range_count(spark.range(100), 8) == 20


def test_fingerprints_by_text_keys_equal_those_by_numbers(spark):
    names, rnd = keys(), random.Random(1)
    texts = ["".join(rnd.choices("abcdef ", k=rnd.randint(0, 60))) for _ in names]
    rows = [(i, name, t) for i, (name, t) in enumerate(zip(names, texts))]
    df = spark.createDataFrame(rows, "n long, name string, text string")
    by_name = {r["name"]: tuple(r)[1:] for r in order_minhash(df.drop("n"), "name", "text").collect()}
    by_number = {names[r["n"]]: tuple(r)[1:] for r in order_minhash(df.drop("name"), "n", "text").collect()}
    assert by_name == by_number and len(by_name) == len(rows)
