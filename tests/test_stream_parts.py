"""A stream of numbered parts that ends midway and goes on."""

import pytest

import docketflow as d
from docketflow.streaming import jobs

SITE = "https://www.sec.gov/Archives/"


def filings(spark, batch, n):
    rows = [
        (f"CO {i}", "10-K" if i % 4 else "8-K", str(i), "2020-03-01", f"edgar/data/{i}/b{batch}-{i}.txt", 2020, "QTR1",
         f"2020_QTR{batch}_company.idx", i)
        for i in range(n)
    ]
    return spark.createDataFrame(rows, d.FILING)


@pytest.fixture
def landed(spark, tmp_path):
    """Three files of filings, and pages for most of them."""
    source = str(tmp_path / "in")
    pages = []
    for batch, n in ((1, 30), (2, 41), (3, 17)):
        filings(spark, batch, n).coalesce(1).write.mode("append").parquet(source)
        pages += [(f"{SITE}edgar/data/{i}/b{batch}-{i}.txt", 1, 200, f"<p>{batch} {i}</p>") for i in range(n) if i % 5]
    wanted = {(f"2020_QTR{b}_company.idx", i) for b, n in ((1, 30), (2, 41), (3, 17)) for i in range(n) if i % 4}
    return source, spark.createDataFrame(pages, d.RESPONSE), wanted


def run(spark, landed, tmp_path, **options):
    source, responses, _ = landed
    return d.stream_fetch(spark, source, responses, str(tmp_path / "out"), str(tmp_path / "at"), per_part=4, files_per_batch=1, **options)


def check(spark, landed, tmp_path):
    out = spark.read.parquet(str(tmp_path / "out")).collect()
    assert sorted((r.sourcefile, r.line_no) for r in out) == sorted(landed[2])
    parts = {}
    for r in out:
        parts.setdefault(r.part, []).append(r)
        assert (r.filing_text is not None) == (r.line_no % 5 > 0) == (r.status == "✅ Success")
    assert sorted(parts) == list(range(len(parts)))
    assert all(len({r.batch for r in own}) == 1 for own in parts.values())
    assert all(sum(r.filing_text is not None for r in own) <= 4 for own in parts.values())
    # Parts go on from batch to batch in order.
    first = {}
    for r in out:
        first[r.batch] = min(first.get(r.batch, r.part), r.part)
    assert sorted(first) == [0, 1, 2] and sorted(first.values()) == [first[b] for b in sorted(first)]


@pytest.mark.parametrize("when", ["before", "after"])
def test_a_run_ended_midway_loses_and_repeats_nothing(spark, landed, tmp_path, monkeypatch, when):
    real, calls = jobs.numbered_outcomes, []

    def failing(*arguments):
        calls.append(arguments)
        numbered, tables = real(*arguments)
        if len(calls) == 2:
            if when == "after":
                # The batch is written, but the stream does not come to note it.
                real_records(numbered).write.mode("overwrite").parquet(str(tmp_path / "out") + "/batch=1")
            raise RuntimeError("executor lost")
        return numbered, tables

    real_records = jobs.outcome_records
    monkeypatch.setattr(jobs, "numbered_outcomes", failing)
    with pytest.raises(Exception, match="executor lost"):
        run(spark, landed, tmp_path)
    monkeypatch.undo()
    run(spark, landed, tmp_path)
    check(spark, landed, tmp_path)
    before = spark.read.parquet(str(tmp_path / "out")).count()
    run(spark, landed, tmp_path)
    assert spark.read.parquet(str(tmp_path / "out")).count() == before


def test_a_batch_without_annual_filings_leaves_no_part(spark, landed, tmp_path):
    run(spark, landed, tmp_path)
    filings(spark, 4, 1).write.mode("append").parquet(landed[0])
    run(spark, landed, tmp_path)
    check(spark, landed, tmp_path)
