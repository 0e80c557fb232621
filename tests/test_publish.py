"""K8: the tables of a run appear together; M7: a rerun skips what is finished."""

import datetime as dt

import pytest

from panelgrowth.plans import job
from panelgrowth.sinks import publish
from panelgrowth.sinks.publish import Run, fingerprint, read_published
from panelgrowth.sinks.writers import SinkTarget, write_reports
from panelgrowth.sources.analog import write_analog_landing

SF = "/root/testdata/sf0.001"
AS_OF = dt.date(2001, 12, 1)
HOW = {"over_threshold": 49.0, "under_threshold": 40.0}
TABLES = ["national_rankings_t", "state_rankings", "msa_rankings", "msa_rankings_over", "msa_rankings_under"]


@pytest.fixture(scope="module")
def landing(spark):
    return write_analog_landing(spark, SF)


def rows(df):
    return sorted(map(repr, df.collect()))


def plain(spark, landing, target, **how):
    job.run_monthly(spark, *job.build_panels(spark, *landing), target, AS_OF, **HOW, **how)
    return {t: rows(spark.read.parquet(target.path(t))) for t in [*TABLES, "date_ref_t"]}


def test_published_tables_equal_the_plain_job(spark, landing, tmp_path):
    want = plain(spark, landing, SinkTarget("parquet", str(tmp_path / "plain")))
    target = SinkTarget("parquet", str(tmp_path / "out"))
    job.run_published(spark, *landing, target, AS_OF, **HOW)
    assert {t: rows(read_published(spark, target, t)) for t in want} == want


def test_a_fault_between_two_tables_leaves_the_old_set(spark, landing, tmp_path, monkeypatch):
    target = SinkTarget("parquet", str(tmp_path / "out"))
    job.run_published(spark, *landing, target, dt.date(2001, 6, 1), **HOW)
    old = {t: rows(read_published(spark, target, t)) for t in TABLES}

    def failing(reports, to, **how):
        if "msa_rankings_under" in reports:
            raise OSError("the disk is gone")
        write_reports(reports, to, **how)

    monkeypatch.setattr(job, "write_reports", failing)
    with pytest.raises(OSError):
        job.run_published(spark, *landing, target, AS_OF, **HOW)
    assert {t: rows(read_published(spark, target, t)) for t in TABLES} == old

    # the rerun reads no facts: neither feed is opened
    monkeypatch.setattr(job, "write_reports", write_reports)
    monkeypatch.setattr(job, "read_facts", lambda *a, **b: pytest.fail("the facts were read again"))
    run = job.run_published(spark, *landing, target, AS_OF, **HOW)
    monkeypatch.undo()
    want = plain(spark, landing, SinkTarget("parquet", str(tmp_path / "plain")))
    assert {t: rows(read_published(spark, target, t)) for t in want} == want
    # finished: a further call writes nothing
    state = spark.read.parquet(f"{target.base}/_state").count()
    assert job.run_published(spark, *landing, target, AS_OF, **HOW) == run
    assert spark.read.parquet(f"{target.base}/_state").count() == state
    assert spark.read.parquet(f"{target.base}/_published").count() == 2


@pytest.mark.parametrize("how", [{"sections": ["states", "msa"]}, {"sections": ["national"], "index": True},
                                 {"scope": "frame", "sections": ["msa_under"], "sort": True}])
def test_some_sections(spark, landing, tmp_path, how):
    target, other = SinkTarget("parquet", str(tmp_path / "out")), SinkTarget("parquet", str(tmp_path / "plain"))
    job.run_published(spark, *landing, target, AS_OF, **HOW, **how)
    job.run_monthly(spark, *job.build_panels(spark, *landing), other, AS_OF, **HOW, **how)
    tables = {"states": "state_rankings", "msa": "msa_rankings", "national": "national_rankings_t", "msa_under": "msa_rankings_under"}
    for s in [*how["sections"], None]:
        t = tables[s] if s else "date_ref_t"
        assert rows(read_published(spark, target, t)) == rows(spark.read.parquet(other.path(t)))
    with pytest.raises(ValueError, match="not among"):
        read_published(spark, target, "msa_rankings_over")


def test_fingerprint(spark, tmp_path):
    a, b = tmp_path / "a.txt", tmp_path / "b.txt"
    a.write_text("one")
    b.write_text("two")
    first = fingerprint(spark, [str(a), str(b)], k=1)
    assert first == fingerprint(spark, [str(b), str(a)], k=1) and first != fingerprint(spark, [str(a), str(b)], k=2)
    assert first != fingerprint(spark, [str(a)], k=1)
    b.write_text("three")
    assert first != fingerprint(spark, [str(a), str(b)], k=1)


def test_notes(spark, tmp_path):
    target = SinkTarget("parquet", str(tmp_path))
    with pytest.raises(ValueError, match="nothing was published"):
        read_published(spark, target, "t")
    run = Run(spark, target, "r1")
    with pytest.raises(ValueError, match="not finished"):
        run.publish(["t"])
    run.write("t", lambda to: spark.range(3).write.parquet(to.path("t")))
    run.write("t", lambda to: pytest.fail("written twice"))
    # a lost attempt left files of its own; the next one does not see them
    lost = Run(spark, target, "r2")
    spark.range(9).write.parquet(lost.staged().path("t"))
    again = Run(spark, target, "r2")
    assert not again.has("t") and Run(spark, target, "r1").has("t")
    again.write("t", lambda to: spark.range(4).write.parquet(to.path("t")))
    run.publish(["t"])
    assert read_published(spark, target, "t").count() == 3
    again.publish(["t"])
    assert read_published(spark, target, "t").count() == 4
    with pytest.raises(ValueError, match="file target"):
        Run(spark, SinkTarget("jdbc", url="jdbc:none"), "r")
    assert publish._latest(spark, target) == (2, "r2")
