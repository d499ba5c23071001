"""First receipts from documents in any order, and what a correction changes elsewhere."""

import random
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from lotflow.operators.allocation import correct_lots, stock_lots
from lotflow.operators.monthend import billing_trace, correct_trace, replace_period
from lotflow.operators.orders import correct_edges, order_edges
from lotflow.operators.receipts import INDEX_COLUMNS, corrected, first_receipt, receipt_lines
from lotflow.plans.jobs import compact_receipts, corrected_index, run_receipt_corrections
from lotflow.sources.tables import read_work
from lotflow.streaming.documents import load_documents, stream_receipts


def documents(seed, count=40):
    """Documents of one to three lines over few batches; some share date and time."""
    random.seed(seed)
    lines, heads = [], []
    for i in range(count):
        doc = dict(mjahr=random.choice(["2019", "2020"]), mblnr=f"D{i:03d}")
        day = f"2020010{random.randint(1, 5)}"
        heads.append(dict(doc, cpudt=day, cputm=random.choice(["080000", "120000"]), budat=day))
        for z in range(random.randint(1, 3)):
            batch = dict(matnr=random.choice("MN"), charg=random.choice(["C1", "C2", "C3", None]))
            lines.append(dict(doc, zeile=str(z), shkzg=random.choice("SSSH"), werks="481A", aufnr=f"O{i % 7}", **batch))
    return lines, heads


def test_any_order_of_loads_gives_the_index_of_all_documents(spark, table, rows, tmp_path):
    lines, heads = documents(1)
    want = rows(first_receipt(table("mseg", *lines), table("mkpf", *heads)))
    order, held = random.sample(range(len(heads)), len(heads)), {}
    for i in range(0, len(order), 14):
        some = [heads[j] for j in order[i : i + 14]]
        arrived = receipt_lines(table("mseg", *lines), table("mkpf", *some))
        for _ in range(2):
            changes = run_receipt_corrections(spark, str(tmp_path), arrived).collect()
            # what is taken back is what was there
            for r in changes:
                if r.change == "-":
                    assert held[r.matnr, r.charg] == tuple(r[c] for c in INDEX_COLUMNS)
            held |= {(r.matnr, r.charg): tuple(r[c] for c in INDEX_COLUMNS) for r in changes if r.change == "+"}
        # the second time changes nothing
        assert changes == []
    assert rows(corrected_index(spark, str(tmp_path))) == want == sorted(held.values(), key=str)
    grown = read_work(spark, str(tmp_path), "mch1x_log").count()
    compact_receipts(spark, str(tmp_path))
    assert read_work(spark, str(tmp_path), "mch1x_log").count() == len(want) <= grown
    assert rows(corrected_index(spark, str(tmp_path))) == want
    assert run_receipt_corrections(spark, str(tmp_path), arrived).collect() == []


@pytest.fixture
def few_partitions(spark):
    """Every state partition costs a process per micro-batch."""
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", "8")


def test_stream_of_shuffled_files(spark, table, rows, tmp_path, few_partitions):
    """Each document's header and lines come in files of their own, in any order, over several runs."""
    lines, heads = documents(3, 24)
    paths = [str(tmp_path / name) for name in ("mseg", "mkpf", "work", "check")]
    files = [("mseg", lines[i : i + 14]) for i in range(0, len(lines), 14)] + [("mkpf", heads[i : i + 8]) for i in range(0, 24, 8)]
    random.shuffle(files)
    # both folders have to exist when the stream starts
    for name, path in zip(("mseg", "mkpf"), paths):
        table(name).write.parquet(path)
    seen = []
    for i in range(0, len(files), 3):
        for name, part in files[i : i + 3]:
            table(name, *part).write.mode("append").parquet(paths[name == "mkpf"])
        stream_receipts(spark, *paths, files=2, changed=lambda c, n: seen.extend(c.collect())).awaitTermination()
    want = rows(first_receipt(table("mseg", *lines), table("mkpf", *heads)))
    assert rows(corrected_index(spark, paths[2])) == want
    left = {}
    for r in seen:
        if r.change == "+":
            left[r.matnr, r.charg] = tuple(r[c] for c in INDEX_COLUMNS)
    assert sorted(left.values(), key=str) == want


def test_late_header_brings_its_lines(spark, table, rows, tmp_path, few_partitions):
    paths = [str(tmp_path / name) for name in ("mseg", "mkpf", "work", "check")]
    doc = dict(mjahr="2020", mblnr="D1")
    table("mkpf").write.parquet(paths[1])
    table("mseg", dict(doc, zeile="1", matnr="M", charg="C", shkzg="S")).write.parquet(paths[0])
    stream_receipts(spark, *paths).awaitTermination()
    assert rows(corrected_index(spark, paths[2])) == []
    table("mkpf", dict(doc, cpudt="20200102", cputm="1", budat="20200102")).write.mode("append").parquet(paths[1])
    stream_receipts(spark, *paths).awaitTermination()
    assert rows(corrected_index(spark, paths[2]), "matnr", "mblnr") == [("M", "D1")]
    # a line of the same document, later still
    table("mseg", dict(doc, zeile="2", matnr="N", charg="C", shkzg="S")).write.mode("append").parquet(paths[0])
    stream_receipts(spark, *paths).awaitTermination()
    assert rows(corrected_index(spark, paths[2]), "matnr", "zeile") == [("M", "1"), ("N", "2")]


def test_changes_reach_lots_billing_and_edges(spark, table, rows, tmp_path):
    work = str(tmp_path)
    lines = [
        dict(mjahr="2020", mblnr="D1", zeile="1", matnr="M", charg="C", shkzg="S", werks="481A", aufnr="P1"),
        dict(mjahr="2020", mblnr="D2", zeile="1", matnr="M", charg="C", shkzg="S", werks="111A", aufnr="P2"),
        dict(mjahr="2020", mblnr="D3", zeile="1", matnr="N", charg="C", shkzg="S", werks="481A", aufnr="P3"),
    ]
    heads = [dict(mjahr="2020", mblnr=f"D{i}", cpudt=d, cputm="1", budat=d) for i, d in ((1, "20200301"), (2, "20200201"), (3, "20200101"))]
    mseg = table("mseg", *lines)
    run_receipt_corrections(spark, work, receipt_lines(mseg, table("mkpf", heads[0], heads[2])))
    index = corrected_index(spark, work)
    before = spark.createDataFrame(index.collect(), index.schema)

    stock = table("mchbx", *[dict(matnr=m, charg="C", werks="101A", uuid=m, bal_qty=1) for m in ("M", "N")])
    ledger = dict(paledger="01", vrgar="F")
    billed = table("ce13058", *[dict(ledger, perio=p, vtweg="PH", artnr=m, rbeln="R", rposn=m, belnr=p) for p in ("1", "2", "3") for m in ("M", "N")][:5])
    items = table("vbrp", *[dict(vbeln="R", posnr=m, charg="C", fkimg=1) for m in ("M", "N")])
    posted = table("aufm", *[dict(aufnr=a, matnr=m, charg="C") for a, m in (("O1", "M"), ("O2", "N"), ("O1", "N"))])
    closed = table("jest", *[dict(objnr=f"ORO{i}", stat="I0046") for i in (1, 2)])

    lots, edges = stock_lots(stock, before, mseg), order_edges(posted, closed, before)
    trace = billing_trace(billed, items, before)
    # period 1 is released
    stored = trace.withColumn("rldat", F.when(trace.perio == "1", "20200401").otherwise(" "))

    changes = run_receipt_corrections(spark, work, receipt_lines(mseg, table("mkpf", heads[1])))
    assert rows(changes, "change", "matnr", "mblnr") == [("+", "M", "D2"), ("-", "M", "D1")]
    now, changed = corrected_index(spark, work), corrected(changes)
    assert rows(correct_lots(lots, mseg, changed)) == rows(stock_lots(stock, now, mseg).select(*lots.columns))
    assert rows(correct_edges(edges, posted, closed, now, changed)) == rows(order_edges(posted, closed, now))
    redone = correct_trace(stored, changed)
    assert {r.perio for r in redone.collect()} == {"2", "3"}
    after = replace_period(stored, redone)
    full = {r.rid: r for r in billing_trace(billed, items, now).collect()}
    for r in after.collect():
        if r.perio == "1":
            assert r.aufnr in ("P1", "P3")
        else:
            assert r.asDict() == full[r.rid].asDict()


def test_a_micro_batch_that_comes_again_changes_nothing(spark, table, rows, tmp_path):
    work = str(tmp_path)
    doc, late = dict(mjahr="2020", mblnr="D1"), dict(mjahr="2020", mblnr="D2")
    lines = table("mseg", dict(doc, zeile="1", matnr="M", charg="C", shkzg="S"), dict(late, zeile="1", matnr="N", charg="C", shkzg="S"))
    heads = table("mkpf", dict(doc, cpudt="20200102", cputm="1", budat="20200102"))
    batch = lines.withColumn("is_header", F.lit(False)).unionByName(heads.withColumn("is_header", F.lit(True)), allowMissingColumns=True)
    assert rows(load_documents(spark, work, batch, "c", 0), "change", "matnr") == [("+", "M")]
    for _ in range(2):
        assert rows(load_documents(spark, work, batch, "c", 0)) == []
        assert rows(read_work(spark, work, "mseg_waiting"), "mblnr") == [("D2",)]
        assert rows(read_work(spark, work, "mkpf_known"), "mblnr") == [("D1",)]
    # headers go after their time, and lines that come then wait
    again = batch.where("NOT is_header AND mblnr = 'D1'").withColumn("zeile", F.lit("2")).withColumn("matnr", F.lit("O"))
    assert rows(load_documents(spark, work, again, "c", 1, keep=timedelta(days=1)), "matnr") == [("O",)]
    assert rows(load_documents(spark, work, again.withColumn("matnr", F.lit("P")), "c", 2, keep=timedelta(0))) == []
    assert rows(read_work(spark, work, "mseg_waiting"), "mblnr", "matnr") == [("D1", "P"), ("D2", "N")]
    late_head = table("mkpf", dict(late, cpudt="20200103", cputm="1", budat="20200103")).withColumn("is_header", F.lit(True))
    late_head = batch.where("false").unionByName(late_head, allowMissingColumns=True)
    assert rows(load_documents(spark, work, late_head, "other", 0), "matnr") == [("N",)]


def test_documents_are_joined_without_python_rows(spark, table, tmp_path, monkeypatch):
    """A micro-batch is joined by Spark; no process is called per document."""
    paths = [str(tmp_path / name) for name in ("mseg", "mkpf", "work", "check")]
    for name, path in zip(("mseg", "mkpf"), paths):
        table(name, dict(mjahr="2020", mblnr="D1")).write.parquet(path)
    query = stream_receipts(spark, *paths)
    query.awaitTermination()
    assert not query.lastProgress.stateOperators
