import pytest

from lotflow.operators.receipts import first_receipt, first_receipt_incremental
from lotflow.plans.jobs import run_first_receipts
from lotflow.sources.tables import of_client, read_work
from lotflow.streaming.receipts import stream_first_receipts


def _line(mblnr, zeile="1", matnr="M", charg="C", shkzg="S", mjahr="2020", **more):
    return dict(mjahr=mjahr, mblnr=mblnr, zeile=zeile, matnr=matnr, charg=charg, shkzg=shkzg, **more)


def _head(mblnr, cpudt, cputm="080000", mjahr="2020", **more):
    return dict(mjahr=mjahr, mblnr=mblnr, cpudt=cpudt, cputm=cputm, budat=cpudt, **more)


def test_earliest_receipt_by_date_time_year_document_item(table, rows):
    lines = table(
        "mseg", _line("D1"), _line("D2"), _line("D3"), _line("D4", "2", "N"), _line("D4", "1", "N"),
        _line("D0", shkzg="H"), _line("D5", charg=" "),
    )
    headers = table(
        "mkpf", _head("D0", "20200101"), _head("D1", "20200301", "120000"), _head("D2", "20200301", "090000"),
        _head("D3", "20200302"), _head("D4", "20200401"), _head("D5", "20200501"),
    )
    got = rows(first_receipt(lines, headers), "matnr", "charg", "mblnr", "zeile", "cpudt")
    # the issue of January does not count; the blank batch is a batch of its own
    assert got == [
        ("M", " ", "D5", "1", "20200501"), ("M", "C", "D2", "1", "20200301"), ("N", "C", "D4", "1", "20200401"),
    ]


def test_other_client_is_filtered_out(table, rows):
    lines = table("mseg", _line("D1"), _line("D2", matnr="X", mandt="999"))
    assert rows(of_client(lines), "matnr") == [("M",)]


def test_one_row_per_batch_where_a_rank_would_tie(table):
    lines = table("mseg", _line("D1"), _line("D1"))
    assert first_receipt(lines, table("mkpf", _head("D1", "20200101"))).count() == 1


def test_incremental_takes_new_batches_from_the_watermark_on(table, rows):
    stored = table("mch1x", dict(matnr="M", charg="C", mblnr="D1", cpudt="20200301"))
    lines = table("mseg", _line("D0"), _line("D2"), _line("D3", matnr="N"), _line("L0", matnr="LATE"))
    headers = table(
        "mkpf", _head("D0", "20200101"), _head("D2", "20200302"), _head("D3", "20200301"), _head("L0", "20200201")
    )
    # the stored batch keeps its receipt, the late document is lost, the watermark day itself is included
    assert rows(first_receipt_incremental(stored, lines, headers), "matnr", "mblnr") == [("N", "D3")]


def test_an_empty_index_loads_everything(table, rows):
    lines, headers = table("mseg", _line("D1")), table("mkpf", _head("D1", "20200101"))
    assert rows(first_receipt_incremental(table("mch1x"), lines, headers), "matnr") == [("M",)]


def test_job_appends_and_reruns_to_the_same_table(spark, table, rows, tmp_path):
    work = str(tmp_path)
    lines = table("mseg", _line("D1"), _line("D2", matnr="N"))
    early, all_heads = table("mkpf", _head("D1", "20200101")), table("mkpf", _head("D1", "20200101"), _head("D2", "20200102"))
    assert rows(run_first_receipts(spark, work, lines, early), "matnr") == [("M",)]
    first = rows(run_first_receipts(spark, work, lines, all_heads))
    assert rows(run_first_receipts(spark, work, lines, all_heads)) == first
    assert [r[0] for r in first] == ["M", "N"]


@pytest.mark.parametrize("part", ["Partial", "Final"])
def test_rank_filter_runs_before_the_shuffle(table, part):
    plan = first_receipt(table("mseg", _line("D1")), table("mkpf", _head("D1", "20200101")))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in text and part in text


def test_stream_loads_new_files_only(spark, table, rows, tmp_path):
    lines, heads, work = str(tmp_path / "mseg"), str(tmp_path / "mkpf"), str(tmp_path / "work")

    def arrive(doc, day, matnr):
        table("mkpf", _head(doc, day)).write.mode("append").parquet(heads)
        table("mseg", _line(doc, matnr=matnr), _line(doc, "2", "other", mandt="999")).write.mode("append").parquet(lines)
        stream_first_receipts(spark, lines, heads, work, str(tmp_path / "check")).awaitTermination()
        return rows(read_work(spark, work, "mch1x"), "matnr", "mblnr")

    assert arrive("D1", "20200101", "M") == [("M", "D1")]
    assert arrive("D2", "20200102", "N") == [("M", "D1"), ("N", "D2")]
    assert arrive("D3", "20200103", "M") == [("M", "D1"), ("N", "D2")]
