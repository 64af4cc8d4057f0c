"""Several writers to one table of records."""

import threading

import pytest
from pyspark.sql import functions as F

from cadastre.sources import commits
from cadastre.sources.register import RegistrationError

SCHEMA = "k string, n int, who string"


def add(spark, folder, who, keys, rule=None, **options):
    rule = F.lit(None).cast("string") if rule is None else rule
    rows = spark.createDataFrame([(k, i, who) for i, k in enumerate(keys)], SCHEMA)
    return commits.commit_records(rows, folder, ["k"], ["n"], rule, **options)


def held(spark, folder):
    schema = spark.createDataFrame([], SCHEMA).schema
    return sorted((r["k"], r["who"]) for r in commits.committed(spark, folder, schema).collect())


def test_keys_are_added_once(spark, tmp_path):
    folder = str(tmp_path / "t")
    assert held(spark, folder) == []
    got = add(spark, folder, "a", ["x", "y", "x", None, None])
    assert sorted(map(str, ((r["k"], r["refusal"]) for r in got.collect()))) == sorted(
        map(str, [("x", None), ("y", None), ("x", "exists"), (None, None), (None, "exists")]))
    got = add(spark, f"file:{folder}", "b", ["y", "z"], rule=F.when(F.col("k") == "z", "bad"))
    assert {r["k"]: r["refusal"] for r in got.collect()} == {"y": "exists", "z": "bad"}
    assert len(commits.commits(spark, folder)) == 1  # nothing to add is no commit
    with pytest.raises(RegistrationError, match="exists"):
        add(spark, folder, "c", ["x", "new"], strict=True)
    assert commits.committed(spark, folder, got.drop("refusal").schema).count() == 3


def test_a_writer_that_was_overtaken_checks_again(spark, tmp_path, monkeypatch):
    folder, real, once = str(tmp_path / "t"), commits.claim, []

    def late(session, path, text):
        if not once:
            once.append(path)
            add(session, folder, "other", ["x", "only other"])
        return real(session, path, text)

    monkeypatch.setattr(commits, "claim", late)
    got = {r["k"]: r["refusal"] for r in add(spark, folder, "me", ["x", "only me"]).collect()}
    assert got == {"x": "exists", "only me": None}
    assert held(spark, folder) == [("only me", "me"), ("only other", "other"), ("x", "other")]
    assert len(list((tmp_path / "t/data").iterdir())) == 2  # what was taken back is gone
    monkeypatch.setattr(commits, "claim", lambda *x: False)
    with pytest.raises(commits.CommitError):
        add(spark, folder, "never", ["q"], attempts=2)


def test_writers_at_the_same_time(spark, tmp_path):
    folder, failed = str(tmp_path / "t"), []

    def write(who):
        try:
            add(spark, folder, who, ["shared", f"own {who}"])
        except Exception as e:
            failed.append(e)

    threads = [threading.Thread(target=write, args=(f"w{i}",)) for i in range(4)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    keys = [k for k, _ in held(spark, folder)]
    assert not failed and sorted(keys) == ["own w0", "own w1", "own w2", "own w3", "shared"]


def test_only_one_claims(spark, tmp_path):
    place = str(tmp_path / "log" / "1")
    assert commits.claim(spark, place, "a") and not commits.claim(spark, place, "b")
    assert (tmp_path / "log" / "1").read_text() == "a" and len(list((tmp_path / "log").iterdir())) == 1


def test_claim_by_rename(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(commits, "_local", lambda folder: None)
    place = f"file://{tmp_path}/log/1"
    assert commits.claim(spark, place, "a") and not commits.claim(spark, place, "b")
    assert (tmp_path / "log" / "1").read_text() == "a"
