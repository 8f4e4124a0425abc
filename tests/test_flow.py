"""The whole document flow over a hand-written tree."""

import datetime
import pathlib
import time

import pytest
from lawloom.operators import unify as U
from lawloom.operators.chunking import chunk_documents
from lawloom.operators.embed import embed_hashing
from lawloom.operators.splits import text_rows
from lawloom.plans import flow
from lawloom.sources.xmltree import text_files, unmatched_names
from pyspark.sql import functions as F
from tree import build, put_status, put_text, status, text


@pytest.fixture(scope="module")
def landed(spark, tmp_path_factory):
    root, out = build(tmp_path_factory.mktemp("tree")), str(tmp_path_factory.mktemp("out"))
    flow.land(spark, root, out)
    flow.upsert_landed(spark, out, f"{out}/tables")
    return root, out


def test_tables_and_quarantine(spark, landed):
    _, out = landed
    bills = spark.read.parquet(f"{out}/tables/billstatus")
    assert sorted(r["legis_id"] for r in bills.collect()) == [
        "117-hr-1", "117-hr-2", "117-hr-3", "117-hr-4", *(f"118-hr-{n}" for n in range(10, 15))
    ]
    first = bills.where("legis_id = '117-hr-1'").first()
    assert first["scrape_path"] == "data/117/bills/hr/hr1/fdsys_billstatus.xml"
    assert first["lastmod"] == datetime.datetime(2024, 1, 1)
    bad = {r["scrape_path"].split("/")[-2]: r["violations"] for r in flow.quarantined(spark, out, "billstatus").collect()}
    assert bad == {
        "hr5": ["number:differs"], "hr6": ["malformed"], "hr7": ["introduced_date:missing"], "hr8": ["lastmod:missing"],
        "hr9": ["text_versions[].url:several"], "odd": ["scrape_path:form"],
    }
    texts = spark.read.parquet(f"{out}/tables/textversion")
    assert {r["tv_id"]: r["root_tag"] for r in texts.where("legis_id = '117-hr-1'").collect()} == {
        "117-hr-1-ih-dtd": "bill", "117-hr-1-eh-dtd": "bill", "117-hr-1-eh-uslm": "bill"
    }
    law = texts.where("legis_class = 'plaw'").first()
    assert (law["tv_id"], law["legis_id"], law["legis_version"]) == ("117-publ-9-plaw-dtd", "117-publ-9", "plaw")
    assert [r["violations"] for r in flow.quarantined(spark, out, "textversion").collect()] == [["root_tag:unknown"]]


def test_reading_text(spark, landed):
    _, out = landed
    texts = spark.read.parquet(f"{out}/tables/textversion")
    assert texts.where("tv_id = '117-hr-1-ih-dtd'").first()["tv_txt"] == "First\n\nOldtext & more second one"
    assert texts.where("tv_id = '117-hr-1-eh-dtd'").first()["tv_txt"] == "First\n\nNew text"


def test_unmatched_names(spark, landed):
    root, _ = landed
    rows = {r["file_name"]: r["n"] for r in unmatched_names(text_files(spark, root)).collect()}
    assert rows == {"OTHER-117hr1.xml": 1, "fdsys_billstatus.xml": 15}


def unified(spark, out, **kw):
    return U.unify(
        spark.read.parquet(f"{out}/tables/billstatus"), spark.read.parquet(f"{out}/tables/textversion"), text_columns=("tv_txt",), **kw
    )


def test_unified_traps(spark, landed):
    _, out = landed
    rows = {r["legis_id"]: r["tvs"] for r in unified(spark, out).collect()}
    # No text, uslm only, and law ids vanish.
    assert set(rows) == {"117-hr-1", "117-hr-2", *(f"118-hr-{n}" for n in range(10, 15))}
    # Newest first; a version listed twice is there twice.
    assert [(t["tv_id"], t["bs_tv"]["type"]) for t in rows["117-hr-1"]] == [
        ("117-hr-1-eh-dtd", "EH"), ("117-hr-1-eh-dtd", "EH again"), ("117-hr-1-ih-dtd", "IH")
    ]
    # Equal lastmod: by tv_id.
    assert [t["tv_id"] for t in rows["117-hr-2"]] == ["117-hr-2-eh-dtd", "117-hr-2-ih-dtd"]


def test_one_row_per_bill_for_every_consumer(spark, landed):
    _, out = landed
    rows = unified(spark, out)
    bills = rows.count()
    assert rows.select("legis_id").distinct().count() == bills
    assert rows.agg(F.max(F.size("tvs"))).first()[0] == 3
    assert text_rows(rows).count() == bills
    assert chunk_documents(rows).select("legis_id").distinct().count() == chunk_documents(rows).count()


def test_newest_version_is_first_of_unified(spark, landed):
    _, out = landed
    whole = {r["legis_id"]: r["tvs"][0]["tv_id"] for r in unified(spark, out).collect()}
    assert {r["legis_id"]: r["tvs"][0]["tv_id"] for r in flow.first_versions(spark, f"{out}/tables").collect()} == whole


def test_export_texts_chunks_and_search(spark, landed):
    _, out = landed
    tables = f"{out}/tables"
    flow.write_unified(spark, tables, out)
    exported = spark.read.parquet(f"{out}/unified")
    assert dict(exported.dtypes)["lastmod"] == "string" and exported.first()["lastmod"] == "2024-01-01 00:00:00"
    assert {r["congress_num"]: r["n"] for r in exported.groupBy("congress_num").agg(F.count("*").alias("n")).collect()} == {117: 2, 118: 5}

    flow.write_texts(spark, tables, out)
    # Parity is counted before the blank text of hr12 drops.
    assert {r["legis_id"]: r["split"] for r in spark.read.parquet(f"{out}/texts").collect()} == {
        "117-hr-1": "train", "117-hr-2": "train", "118-hr-10": "validation", "118-hr-11": "test", "118-hr-13": "test", "118-hr-14": "validation"
    }

    flow.write_chunks(spark, tables, out, [(12, 4)])
    chunks = spark.read.parquet(f"{out}/chunks-s12-o4")
    assert chunks.where("legis_id = '117-hr-1'").count() > 1
    vecs = embed_hashing(chunks)
    bills = spark.read.parquet(f"{tables}/billstatus").where("size(bs.sponsors) > 0")
    record = flow.search_records(vecs, bills).where("id = '117-hr-1-eh-dtd-0'").first()
    meta = record["metadata"]
    assert (meta["sponsor_full_name"], meta["subjects"], meta["cosponsor_bioguide_ids"]) == ("Rep. Poe, Ann [D-MA-2]", "Tax|Air", "")
    assert (meta["legis_num"], meta["chunk_index"], meta["policy_area"]) == ("1", "0", "Health")
    assert flow.search_records(vecs, bills).where("id like '117-hr-2%'").first()["metadata"]["policy_area"] == "None"

    members = spark.createDataFrame(
        [(117, "M001", 2, 0.5, 0.1, 0.2, 0.3), (117, "M001", 1, 0.4, 0.1, 0.2, 0.3), (118, "X", 1, 0.9, 0.1, 0.2, 0.3)],
        "congress int, bioguide_id string, icpsr int, nominate_dim1 double, nominate_dim2 double, nokken_poole_dim1 double, nokken_poole_dim2 double",
    )
    rows = flow.export_records(chunks, bills, members)
    assert rows.count() == chunks.join(bills, "legis_id").count()
    one = rows.where("legis_id = '117-hr-1'").first()
    assert one["congress_gov_url"] == "https://www.congress.gov/bill/117th-congress/house-bill/1"
    assert (one["sponsor_party"], one["sponsor_state"], one["subjects"], one["update_date"]) == ("D", "MA", "Air | Tax", "2023-01-11")
    assert one["nominate_dim1"] == 0.4  # the first of two member rows
    assert rows.where("legis_id = '118-hr-10'").first()["nominate_dim1"] is None

    asked = spark.createDataFrame([("q1", "body 13"), ("q2", "New text")], "query_id string, text string")
    contexts = {r["query_id"]: (r["context"], r["n"]) for r in flow.answer_context(asked, vecs, k=3).collect()}
    assert contexts["q1"][1] == 3 and contexts["q1"][0].startswith("Snippet 0\nLegislation ID: 118-hr-13\n ... ")
    assert " ... New text ...\n\nSnippet 1\n" in contexts["q2"][0] and "Snippet 2\n" in contexts["q2"][0]


def test_second_arrival_updates(spark, landed, tmp_path):
    root, _ = landed
    tables = str(tmp_path / "t")
    flow.land(spark, root, str(tmp_path / "first"))
    flow.upsert_landed(spark, str(tmp_path / "first"), tables)
    untouched = [p.name for p in (tmp_path / "t/billstatus/congress_num=118").glob("*.parquet")]
    root = str(tmp_path / "more")
    put_status(root, 1, status(1).replace("Bill 1", "Older"), lastmod="2020-01-01T00:00:00Z")
    put_status(root, 2, status(2).replace("Bill 2", "Newer"), lastmod="2025-01-01T00:00:00Z")
    put_text(root, "BILLS-117hr3ih.xml", text("Third", "late"), "2024-01-01T00:00:00Z")
    flow.land(spark, root, str(tmp_path / "second"))
    flow.upsert_landed(spark, str(tmp_path / "second"), tables)
    titles = {r["legis_id"]: r["title"] for r in spark.read.parquet(f"{tables}/billstatus").select("legis_id", "bs.title").collect()}
    assert (titles["117-hr-1"], titles["117-hr-2"], len(titles)) == ("Bill 1", "Newer", 9)
    assert spark.read.parquet(f"{tables}/textversion").where("tv_id = '117-hr-3-ih-dtd'").count() == 1
    # The other congress was not rewritten.
    assert [p.name for p in (tmp_path / "t/billstatus/congress_num=118").glob("*.parquet")] == untouched


def test_arrivals_equal_the_whole_tree(spark, tmp_path):
    root, out, state = build(tmp_path / "tree"), str(tmp_path / "log"), str(tmp_path / "state")
    flow.ingest_arrivals(spark, root, out, state)
    put_status(root, 20, status(20), lastmod="2024-01-01T00:00:00Z")
    put_text(root, "BILLS-117hr20ih.xml", text("Late", "x"), "2024-01-01T00:00:00Z")
    flow.ingest_arrivals(spark, root, out, state)
    flow.land(spark, root, str(tmp_path / "landed"))
    for name, key in (("billstatus", "legis_id"), ("textversion", "tv_id")):
        whole = flow.arrived(spark, str(tmp_path / "landed"), name)
        got = flow.ingested(spark, out, name).select(whole.columns)
        assert {tuple(map(str, r)) for r in got.collect()} == {tuple(map(str, r)) for r in whole.collect()}
        assert got.where(f"{key} like '117-hr-20%'").count() == 1


def test_changed_and_late_files_are_read_again(spark, tmp_path):
    root, out, state = build(tmp_path / "tree"), str(tmp_path / "log"), str(tmp_path / "state")
    put_status(root, 30, status(30), lastmod="2024-01-01T00:00:00Z")
    put_status(root, 31, status(31))
    side = next(p for p in pathlib.Path(root).rglob("*lastmod.txt") if "31" in str(p))
    late = side.read_text()
    side.unlink()
    flow.ingest_arrivals(spark, root, out, state)
    assert flow.ingested(spark, out, "billstatus").where("legis_id = '117-hr-31'").count() == 0
    batches = len(list((tmp_path / "log/billstatus").glob("ingest_batch=*")))
    flow.ingest_arrivals(spark, root, out, state)  # nothing is new: no batch
    assert len(list((tmp_path / "log/billstatus").glob("ingest_batch=*"))) == batches
    time.sleep(0.05)
    put_status(root, 30, status(30).replace("Bill 30", "Changed"), lastmod="2025-01-01T00:00:00Z")
    side.write_text(late)
    flow.ingest_arrivals(spark, root, out, state)
    titles = {r["legis_id"]: r["title"] for r in flow.ingested(spark, out, "billstatus").select("legis_id", "bs.title").collect()}
    assert titles["117-hr-30"] == "Changed" and "117-hr-31" in titles
