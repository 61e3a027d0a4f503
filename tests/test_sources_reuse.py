"""Quoted records over several tasks, and scopes that release what they own."""

import os
import random

from pyspark.sql import functions as F

from conftest import rows
from kestrel.plans import all_queries
from kestrel.session import ensure_checkpoint_dir, materialise, persist, result_of, reuse
from kestrel.sources import files as fs


def _one_task(spark, path, schema):
    return spark.read.schema(schema).option("multiLine", True).option("quote", '"').option("escape", '"').csv(path)


def test_quoted_records_are_read_by_several_tasks(spark, tmp_path):
    rng = random.Random(5)
    path = tmp_path / "texts"
    path.mkdir()
    for n in range(2):
        with open(path / f"part{n}.csv", "w", encoding="utf-8") as f:
            for i in range(3000):
                text = rng.choice(["plain", "two\nlines", "a \"quoted\" word", "comma, and\n\n\"blank\" line", "é\nà", "x" * 50, "", "\n" * rng.randrange(1, 400)])
                f.write('"' + text.replace('"', '""') + f'",{i % 3}' + rng.choice(["\n", "\n", "\n\n"]))
            f.write('"the last, without a line end",9')
    schema = "text string, label int"
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    want = rows(_one_task(spark, str(path), schema).select(F.coalesce("text", F.lit("null")).alias("text"), "label"))
    assert len(want) == 6002
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
        spark.conf.set("spark.sql.files.openCostInBytes", "1")
        assert spark.read.text(str(path)).rdd.getNumPartitions() > 20
        got = fs.scan_labelled_text(spark, str(path), ["text", "label"])
        assert rows(got.select(F.coalesce("text", F.lit("null")).alias("text"), "label")) == want
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert rows(fs.scan_labelled_text(spark, str(path), ["text", "label"]).select(F.coalesce("text", F.lit("null")).alias("text"), "label")) == want


def test_empty_quoted_file(spark, tmp_path):
    (tmp_path / "none.csv").write_text("")
    assert fs.scan_labelled_text(spark, str(tmp_path / "none.csv"), ["text", "label"]).collect() == []


def _persisted(spark):
    return len(spark.sparkContext._jsc.getPersistentRDDs())


def _tables(spark):
    where = os.path.join(ensure_checkpoint_dir(spark).removeprefix("file:"), "tables")
    return set(os.listdir(where)) if os.path.isdir(where) else set()


def test_a_scope_releases_frames_and_tables(spark):
    frames, tables = _persisted(spark), _tables(spark)
    with reuse(spark):
        p = persist(spark.range(10))
        t = materialise(spark.range(5), "five")
        assert p.count() == 10 and t.count() == 5
        assert _persisted(spark) == frames + 1 and len(_tables(spark)) == len(tables) + 1
        with reuse(spark):
            persist(spark.range(3)).count()
        assert _persisted(spark) == frames + 1
    assert _persisted(spark) == frames and _tables(spark) == tables


def test_results_outlive_what_they_stand_on(spark):
    tables = _tables(spark)
    with reuse(spark):
        out = result_of(spark, lambda: materialise(spark.range(7), "seven").where("id > 2"))
        assert rows(out) == [(3,), (4,), (5,), (6,)]
        assert {t.split("-")[0] for t in _tables(spark) - tables} == {"result"}
    assert _tables(spark) == tables


def test_queries_leave_nothing_but_their_result(spark, small_dir):
    for key in ("cached_scan", "retrieve_tf", "linear_regression", "scan_labelled_text"):
        frames, tables = _persisted(spark), _tables(spark)
        all_queries()[key](spark, small_dir).collect()
        assert _persisted(spark) == frames, key
        assert all(t.startswith("result-") for t in _tables(spark) - tables), key
