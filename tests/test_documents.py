"""Documents: nesting, malformed values, archives, layout."""

import json
import os
import zipfile
from pathlib import Path

import pytest
from conftest import plan
from pyspark.sql import Row
from pyspark.sql import functions as F

from ledgerstrata import sources
from ledgerstrata.operators import bronze
from ledgerstrata.sources.archive import MEMBER_SCHEMA
from ledgerstrata.testbed import filings
from ledgerstrata.testbed.workspace import Workspace, workspace

SF = "/root/testdata/sf0.001"


def fact(**changes):
    base = dict(
        end="2023-12-31", val=100, accn="a-1", fy=2023, fp="FY", form="10-K", filed="2024-02-01"
    )
    return {**base, **changes}


def document(cik=7, concepts=None, **extra):
    doc = {"cik": cik, "entityName": f"Company {cik}", **extra}
    if concepts is not None:
        doc["facts"] = {"us-gaap": concepts}
    return doc


def assets(*facts, unit="USD"):
    return {"Assets": {"units": {unit: list(facts)}}}


def read(spark, scratch, *documents):
    path = Path(scratch) / "docs.json"
    path.write_text("\n".join(json.dumps(d) for d in documents))
    return sources.read_documents(spark, str(path))


def test_flatten_keeps_every_level(spark, scratch):
    concepts = {
        "Assets": {"units": {"USD": [fact(), fact(fy=2022)], "EUR": [fact()]}},
        "Shares": {"units": {"shares": [fact(val=5)]}},
    }
    rows = bronze.flatten_facts(read(spark, scratch, document(concepts=concepts))).collect()
    assert sorted((r.concept, r.unit, r.fiscal_year, r.value) for r in rows) == [
        ("Assets", "EUR", 2023, 100.0),
        ("Assets", "USD", 2022, 100.0),
        ("Assets", "USD", 2023, 100.0),
        ("Shares", "shares", 2023, 5.0),
    ]


def test_documents_without_facts_give_no_rows(spark, scratch):
    docs = read(
        spark, scratch, document(1), document(2, concepts={}), document(3, {"Assets": {"units": {}}})
    )
    assert bronze.flatten_facts(docs).count() == 0
    assert bronze.extract_companies(docs).count() == 3


def test_company_attributes_are_optional(spark, scratch):
    docs = read(
        spark,
        scratch,
        document(1),
        document(2, tickers=["AB", "AB-P"], exchanges=["NYSE"]),
        document("12345678901", tickers=[]),
    )
    rows = {r.cik: r for r in bronze.extract_companies(docs).collect()}
    assert rows["1"].ticker is None and rows["1"].exchange is None
    assert (rows["2"].ticker, rows["2"].exchange) == ("AB", "NYSE")
    assert rows["1"].cik_padded == "0000000001"
    # Longer ids are cut to ten characters, as left padding does.
    assert rows["12345678901"].cik_padded == "1234567890"
    assert rows["12345678901"].ticker is None


def test_bad_values_are_flagged_not_fatal(spark, scratch):
    docs = read(
        spark,
        scratch,
        document(
            concepts=assets(
                fact(),
                fact(val="n/a"),
                fact(val=None),
                fact(fy=None),
                fact(fy="year"),
                fact(fy=1800),
                fact(fy=2101),
                fact(fy=1900),
                fact(fy=2100),
                fact(val=1.5e10),
            )
        ),
    )
    rows = bronze.extract_financials(docs).collect()
    assert len(rows) == 10
    assert sum(r.has_null_critical for r in rows) == 4
    assert sorted(r.fiscal_year for r in rows if r.invalid_fiscal_year) == [1800, 2101]
    passed = [r for r in rows if r.data_quality_passed]
    assert sorted((r.fiscal_year, r.value) for r in passed) == [
        (1900, 100.0),
        (2023, 100.0),
        (2023, 1.5e10),
        (2100, 100.0),
    ]
    assert {r.year_quarter for r in rows if r.fiscal_year is None} == {None}


def test_units_and_forms_are_parameters(spark, scratch):
    concepts = {
        "EarningsPerShareBasic": {"units": {"USD/shares": [fact(val=2.5)]}},
        "Assets": {"units": {"USD": [fact(), fact(form="S-1")]}},
    }
    docs = read(spark, scratch, document(concepts=concepts))
    assert bronze.extract_financials(docs).count() == 1
    wide = bronze.extract_financials(docs, units=["USD", "USD/shares"], forms=["10-K", "S-1"])
    assert wide.count() == 3
    by_concept = {r.concept: r.statement_type for r in wide.collect()}
    assert by_concept == {
        "EarningsPerShareBasic": "income_statement",
        "Assets": "balance_sheet",
    }


def test_one_document_per_file(spark, scratch):
    folder = Path(scratch) / "filings" / "0000000007" / "a-1"
    folder.mkdir(parents=True)
    (folder / "facts.json").write_text(json.dumps(document(concepts=assets(fact())), indent=2))
    docs = sources.read_documents(spark, scratch, multiline=True, glob="*.json")
    (row,) = sources.with_layout(docs.select("cik", "_metadata.file_path"), "file_path").collect()
    assert (row.layout, row.layout_cik, row.layout_accession, row.file_name) == (
        "filings",
        "0000000007",
        "a-1",
        "facts.json",
    )


def test_archive_members_are_read_once_by_several_tasks(spark, scratch):
    for number in range(2):
        with zipfile.ZipFile(f"{scratch}/part{number}.zip", "w", zipfile.ZIP_DEFLATED) as archive:
            archive.writestr("notes.txt", "not a document")
            for i in range(20):
                cik = number * 20 + i
                archive.writestr(
                    f"CIK{cik:010d}.json", json.dumps(document(cik, assets(fact(val=cik))))
                )
    members = sources.read_archive(spark, scratch, chunk_bytes=400, tasks=6)
    docs = sources.parse_documents(members)
    rows = bronze.flatten_facts(docs).collect()
    assert sorted(r.value for r in rows) == [float(i) for i in range(40)]
    assert members.select("member").distinct().count() == 40
    used = members.selectExpr("spark_partition_id() AS p").distinct().count()
    assert used > 1
    single = sources.read_archive(spark, f"{scratch}/part0.zip")
    assert single.count() == 20


def test_reading_archives_plans_no_job_and_no_shuffle(spark, scratch):
    os.makedirs(f"{scratch}/2024/a")
    os.makedirs(f"{scratch}/2023")
    for name, cik in (("2024/one", 1), ("2024/a/two", 2), ("2023/three", 3), ("2024/.hidden", 4)):
        with zipfile.ZipFile(f"{scratch}/{name}.zip", "w") as archive:
            archive.writestr("d.json", json.dumps(document(cik, assets(fact(val=cik)))))
    tracker = spark.sparkContext.statusTracker()
    before = tracker.getJobIdsForGroup(None)
    members = sources.read_archive(spark, scratch)
    text = plan(members.select("doc_json"))
    assert "Exchange" not in text and "zip_members" in text
    assert tracker.getJobIdsForGroup(None) == before
    assert members.schema == spark.createDataFrame([], MEMBER_SCHEMA).schema

    def ids(path):
        rows = sources.parse_documents(sources.read_archive(spark, path)).select("cik").collect()
        return sorted(r.cik for r in rows)

    assert ids(scratch) == ["1", "2", "3"] and ids(f"{scratch}/20*4") == ["1", "2"]
    assert ids(f"file:{scratch}/2024/*.zip") == ["1"] and ids(f"file://{scratch}/202[3]") == ["3"]
    assert ids([f"{scratch}/2023/three.zip", f"{scratch}/2024/a"]) == ["2", "3"]
    with pytest.raises(Exception, match="missing"):
        sources.read_archive(spark, f"{scratch}/missing").count()


def test_oversized_member_has_its_own_chunk(spark, scratch):
    with zipfile.ZipFile(f"{scratch}/all.zip", "w") as archive:
        for name, size in [("a", 10), ("b", 1000), ("c", 10), ("d", 10)]:
            archive.writestr(f"{name}.json", "x" * size)
    chunks = sources.list_members(spark, f"{scratch}/all.zip", chunk_bytes=100).collect()
    assert [(c.first_member, c.members, c.chunk_bytes) for c in chunks] == [
        (0, 1, 10),
        (1, 1, 1000),
        (2, 2, 20),
    ]


@pytest.mark.parametrize(
    "path, expected",
    [
        (sources.bulk_path("facts.zip", 2024), ("bulk", 2024, None, None, None, "facts.zip")),
        (sources.bulk_path("facts.zip"), ("bulk", None, None, None, None, "facts.zip")),
        (
            sources.daily_index_path(2024, 3, 5, "form.idx"),
            ("daily-index", 2024, "2024-03-05", None, None, "form.idx"),
        ),
        (
            sources.filings_path("0000320193", "0000320193-24-1", "x.json"),
            ("filings", None, None, "0000320193", "0000320193-24-1", "x.json"),
        ),
        ("elsewhere/file.json", (None, None, None, None, None, None)),
    ],
)
def test_layout_round_trip(spark, path, expected):
    df = spark.createDataFrame([Row(path=f"s3a://lake/raw/{path}")])
    (row,) = sources.with_layout(df, "path").drop("path").collect()
    day = row.index_date.isoformat() if row.index_date else None
    assert (row[0], row[1], day, *row[3:]) == expected


def test_layout_glob_limits_the_listing(spark, scratch):
    for year, month in [(2023, 12), (2024, 1), (2024, 2)]:
        folder = Path(scratch) / sources.daily_index_path(year, month, 5, "docs")
        folder.mkdir(parents=True)
        (folder / "docs.json").write_text(json.dumps(document(year * 100 + month)))

    def found(**part):
        path = f"{scratch}/{sources.layout_glob('daily-index', **part)}"
        return sorted(r.cik for r in sources.read_documents(spark, path).collect())

    assert found() == ["202312", "202401", "202402"]
    assert found(year=2024) == ["202401", "202402"]
    assert found(year=2024, month=2, day=5) == ["202402"]
    assert sources.layout_glob("bulk", year=2024) == "bulk/2024/*"
    assert sources.layout_glob("filings", cik="7") == "filings/7/*/*"
    with pytest.raises(ValueError):
        sources.layout_glob("elsewhere")


def test_nesting_round_trip(spark):
    """Long rows -> nested documents -> flatten gives back the same rows."""
    back = bronze.flatten_facts(workspace(spark, SF).documents()).drop("start_date")
    long = filings.reported_facts(spark, SF).select(*back.columns)
    assert back.exceptAll(long).count() == 0
    assert long.exceptAll(back).count() == 0


def test_documents_are_nested_where_their_rows_are(spark):
    """Only period rows are shuffled, and the cut-off copies come from the same pass."""
    company = filings.companies(spark, SF)
    docs = filings.with_broken_copies(filings.nest_documents(filings.reported_facts(spark, SF), company))
    text = plan(docs)
    assert not [line for line in text.splitlines() if "Exchange" in line and "concept" in line]
    assert "Union" not in text and text.count("lineitem.parquet") == 1
    rows = docs.collect()
    whole = {r.cik: r.doc_json for r in rows if r.doc_json.endswith("}}}") or int(r.cik) % 7 != 3}
    cut = {r.cik: r.doc_json for r in rows if r.doc_json != whole[r.cik]}
    assert sorted(cut) == sorted(cik for cik in whole if int(cik) % 7 == 3)
    assert all(text == whole[cik][: len(whole[cik]) // 2] for cik, text in cut.items())
    ws = workspace(spark, SF)
    assert {r.f.rsplit(".", 1)[-1] for r in ws.landed_documents().select("_metadata.file_name").toDF("f").collect()} == {"gz"}


def test_documents_are_made_without_sorting_their_long_rows(spark, scratch, monkeypatch):
    """The landed documents hold the same facts, gathered as period rows only."""
    company = filings.companies(spark, SF)
    docs = filings.documents(spark, SF)

    def back(texts, name):
        texts.select("doc_json").write.text(f"{scratch}/{name}")
        return bronze.flatten_facts(sources.valid_documents(sources.read_documents(spark, f"{scratch}/{name}")))

    new, old = back(docs, "new"), back(filings.nest_documents(filings.reported_facts(spark, SF), company), "old")
    assert new.count() == old.count() and new.exceptAll(old).count() == old.exceptAll(new).count() == 0
    lines = plan(docs).splitlines()
    spread = next(i for i, line in enumerate(lines) if "PaymentsToAcquirePropertyPlantAndEquipment" in line)
    # What sorts and groups stands below the step that spreads the facts.
    assert not [line for line in lines[:spread] if any(word in line for word in ("Sort", "Aggregate", "Exchange"))]
    monkeypatch.setattr(filings, "reported_facts", None)
    assert Workspace(spark, SF, f"{scratch}/lake").landed_documents().count() == docs.count() + 1


def test_fixture_counts(spark):
    """Counts of the mapping on the larger tables (see FIXTURES.md, section 5)."""
    ws = workspace(spark, "/root/testdata/sf0.01")
    assert bronze.flatten_facts(ws.documents()).count() == 86_765
    raw = ws.table("raw_financials")
    assert raw.count() == 85_820
    assert raw.where("data_quality_passed").count() == 84_595
    assert ws.table("fact_financials").count() == 83_195
    metrics = ws.table("company_metrics")
    assert metrics.count() == 3_500
    assert metrics.where("current_liabilities = 0").count() == 218


def test_observed_quality_counts(spark, scratch):
    from ledgerstrata.plans import medallion

    docs = read(spark, scratch, document(concepts=assets(fact(), fact(val=None))))
    counts = medallion.build_bronze(spark, docs, f"{scratch}/lake")
    assert counts == {"total_count": 2, "passed_count": 1}


def test_layers_lie_under_the_checkpoint_folder(spark, scratch):
    from ledgerstrata.testbed.workspace import shared_root

    class Session:
        def __init__(self, master, folder):
            self.conf = type("Conf", (), {"get": lambda _, key, default: folder})()
            self.sparkContext = type("Context", (), {"master": master})()

    assert shared_root(Session("spark://host", "hdfs:///shared/")) == "hdfs:///shared"
    assert shared_root(Session("local[2]", None)).startswith("/")
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_root(Session("spark://host", None))


def test_damaged_archives_are_reported_not_fatal(spark, scratch):
    good = json.dumps(document(7, assets(fact())))
    zipfile.ZipFile(f"{scratch}/empty.zip", "w").close()
    with zipfile.ZipFile(f"{scratch}/one.zip", "w") as archive:
        archive.writestr("a.json", good)
    with zipfile.ZipFile(f"{scratch}/text.zip", "w") as archive:
        archive.writestr("latin.json", b'{"cik": 8, "entityName": "\xe9"}')
        archive.writestr("cut.json", good[: len(good) // 2])
        archive.writestr("b.json", json.dumps(document(9)))
    whole = Path(f"{scratch}/one.zip").read_bytes()
    Path(f"{scratch}/cut.zip").write_bytes(whole[: len(whole) // 2])
    Path(f"{scratch}/tiny.zip").write_bytes(b"PK")
    for tasks in (None, 1, 7):
        members = sources.read_archive(spark, scratch, tasks=tasks)
        docs = sources.parse_documents(members)
        assert sorted(r.cik for r in sources.valid_documents(docs).collect()) == ["7", "9"]
        counts = sources.count_documents(docs).first()
        # Two archives and two members; an empty archive is nothing to report.
        assert (counts.documents, counts.with_id, counts.rejected) == (6, 2, 4)
    reasons = {r.member: r.error for r in members.where("error IS NOT NULL").collect()}
    assert "UnicodeDecodeError" in reasons["latin.json"] and "BadZipFile" in reasons[None]
    listed = sources.list_members(spark, scratch).collect()
    assert sorted(r.members for r in listed) == [0, 0, 1, 3]


def test_broken_documents_are_counted_and_kept_out(spark, scratch):
    from ledgerstrata.plans import medallion
    from ledgerstrata.sources import read_table

    path = Path(scratch) / "docs.json"
    text = json.dumps(document(7, assets(fact())))
    path.write_text("\n".join([text, text[:40], json.dumps(document(8))]))
    docs = sources.read_documents(spark, str(path))
    counts = sources.count_documents(docs).first()
    assert (counts.documents, counts.with_id, counts.rejected) == (3, 2, 1)
    medallion.build_bronze(spark, docs, f"{scratch}/lake")
    assert sorted(r.cik for r in read_table(spark, f"{scratch}/lake", "raw_companies").collect()) == ["7", "8"]
    rejected = spark.read.parquet(f"{scratch}/lake/bronze/rejected_documents").collect()
    assert [r.corrupt_document for r in rejected] == [text[:40]]


def test_period_rows_cross_the_network_once_after_their_sums(spark):
    """Full years, company attributes and long rows come from one deal by company."""
    lines = plan(filings.reported_facts(spark, SF)).splitlines()
    dealt = [line for line in lines if "Exchange hashpartitioning(cik" in line]
    assert sum("REPARTITION_BY_NUM" in line for line in dealt) == 1 and len(dealt) == 2  # periods and companies
    assert len([line for line in lines if "Exchange hashpartitioning(l_suppkey" in line]) == 1


def test_derived_columns_are_added_after_the_shuffle(spark, scratch):
    docs = sources.valid_documents(read(spark, scratch, document(concepts=assets(fact(), fact(fy=1800), fact(fy=None)))))
    rows = bronze.extract_financials(docs, by_year=True)
    above, below = plan(rows).split("REBALANCE_PARTITIONS_BY_COL")
    assert "year_quarter" in above and "lpad" in above
    assert "year_quarter" not in below and "lpad" not in below
    apart = bronze.extract_financials(docs)
    assert rows.columns == apart.columns and sorted(rows.collect(), key=str) == sorted(apart.collect(), key=str)
    assert rows.count() == 3


def test_packed_rows_ask_for_more_ranges(spark, scratch, monkeypatch):
    """Packed files hold many times fewer bytes than a task has to sort."""
    from ledgerstrata.plans import medallion

    asked = []
    monkeypatch.setattr(medallion, "stored_bytes", lambda *_: 2 << 30)
    monkeypatch.setattr(medallion, "read_table", lambda *_: None)
    monkeypatch.setattr(medallion, "save", lambda *_, **__: None)
    for name in ("build_fact_financials", "build_fact_submissions"):
        monkeypatch.setattr(medallion.facts, name, lambda _, ranges: asked.append(ranges))
    medallion.build_facts(spark, scratch)
    assert asked == [128, 128]


def test_tasks_stay_small_where_shuffle_partitions_are_few(spark, scratch, monkeypatch):
    """Neither landing, unchecked rows nor silver grow their tasks with the input."""
    from ledgerstrata.operators import facts
    from ledgerstrata.plans import medallion

    monkeypatch.setattr(filings, "TASK_COMPANIES", 1)
    text = plan(filings.documents(spark, SF))
    assert "hashpartitioning(cik" in text and ", 10), REPARTITION_BY_NUM" in text

    asked, saved = [], []
    with monkeypatch.context() as patched:
        patched.setattr(medallion, "stored_bytes", lambda *_: 32 << 20)
        patched.setattr(medallion, "read_table", lambda *_: None)
        patched.setattr(medallion, "save", lambda *_, **__: None)
        for name in ("build_fact_financials", "build_fact_submissions"):
            patched.setattr(medallion.facts, name, lambda _, ranges: asked.append(ranges))
        medallion.build_facts(spark, scratch)
    # Two ranges of eight tasks, more than the eight shuffle partitions of the session.
    assert asked == [2, 2]
    rows = spark.range(10).select(F.col("id").alias("cik"))
    assert f", {2 * facts.TASKS_PER_RANGE})" in plan(facts.in_ranges(rows, 2, ["cik"]))

    advisory, files = "spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(advisory), spark.conf.get(files)
    save = medallion.save

    def noting(*args, **options):
        saved.append((spark.conf.get(advisory), spark.conf.get(files)))
        save(*args, **options)

    monkeypatch.setattr(medallion, "save", noting)
    medallion.build_bronze(spark, read(spark, scratch, document(concepts=assets(fact()))), f"{scratch}/lake")
    assert {int(x) for pair in saved for x in pair} == {medallion.TASK_BYTES}
    assert (spark.conf.get(advisory), spark.conf.get(files)) == before
    assert [medallion._bytes(x) for x in ("67108864b", "64MB", "16k", "1m", "5")] == [64 << 20, 64 << 20, 16 << 10, 1 << 20, 5]


def test_unchecked_rows_are_stored_without_a_shuffle(spark, scratch, monkeypatch):
    """Tasks unnest row groups of the landed documents and keep what they made."""
    import pyarrow.parquet as pq

    from ledgerstrata.plans import medallion
    from ledgerstrata.sources import read_table

    plans, save = {}, medallion.save

    def noting(rows, root, name, **options):
        plans[name] = plan(rows)
        save(rows, root, name, **options)

    monkeypatch.setattr(medallion, "save", noting)
    monkeypatch.setattr(medallion, "GROUP_BYTES", 1 << 10)
    reported = [fact(fy=year, end=f"{year}-12-31") for year in (2020, 2021, 2022, 1800)]
    Path(f"{scratch}/docs.json").write_text("\n".join(json.dumps(document(i, assets(*reported))) for i in range(500)))
    docs = sources.read_documents(spark, f"{scratch}/docs.json")
    counts = medallion.build_bronze(spark, docs, f"{scratch}/lake")
    assert "Exchange" not in plans["raw_financials"] and "REBALANCE" not in plans["raw_financials"]
    assert counts == {"total_count": 2000, "passed_count": 1500}
    stored = read_table(spark, f"{scratch}/lake", "raw_financials")
    by_year = {r.fiscal_year: r["count"] for r in stored.groupBy("fiscal_year").count().collect()}
    assert by_year == {2020: 500, 2021: 500, 2022: 500, 1800: 500}
    groups = [pq.read_metadata(f).num_row_groups for f in Path(f"{scratch}/lake/landing/documents").glob("*.parquet")]
    assert max(groups) > 1


def test_layers_drop_their_shuffles_when_they_are_stored(spark, scratch, monkeypatch):
    from ledgerstrata.plans import medallion

    before, seen, save = spark.conf.get(medallion.CLEANUP), [], medallion.save

    def noting(rows, root, name, **options):
        seen.append(spark.conf.get(medallion.CLEANUP))
        save(rows, root, name, **options)

    monkeypatch.setattr(medallion, "save", noting)
    docs = read(spark, scratch, document(concepts=assets(fact())))
    medallion.build_bronze(spark, docs, f"{scratch}/lake")
    medallion.build_silver(spark, f"{scratch}/lake")
    assert len(seen) == 7 and set(seen) == {"true"}
    assert spark.conf.get(medallion.CLEANUP) == before == "false"
