"""Hand-computed results on a small contract set, and equivalence of the two staging plans."""

import datetime
import json
from functools import partial
from itertools import takewhile

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from ratebook.operators import skew, storage
from ratebook.operators.history import apply_snapshot, merge_snapshot, read_history
from ratebook import queries, schemas
from ratebook.operators.quality import run_checks
from ratebook.plans import build, checks, history, intermediate, marts, staging
from ratebook.plans.extraction import extract_contracts, split_table
from ratebook.plans.validation import validate
from ratebook.sources import contracts as files
from ratebook.sources import tables, testdata
from ratebook.sources.seeds import read_seed

D = datetime.date
AS_OF = D(2024, 7, 1)
FOLDER = "/root/testdata/sf0.001"


def _rate(category, code, kind, amount, day=None, unit=None, modifier=None):
    return {
        "service_category": category,
        "cpt_code": code,
        "rate_type": kind,
        "rate_amount": amount,
        "effective_date": day,
        "rate_unit": unit,
        "modifier": modifier,
    }


RECORDS = [
    {
        "contract_id": "C1",
        "payer_name": " Acme Health ",
        "payer_id": "acme1 ",
        "provider_npi": "1111111111",
        "provider_name": "North\tClinic",
        "effective_date": "2024-01-01",
        "termination_date": "2025-12-31",
        "rate_schedules": [
            _rate("inpatient", "900", "per_diem", 450, "2024-02-01", "day"),
            _rate("inpatient", "901", "PER_DIEM", 550, "", None, " M1 "),
            _rate("lab ", "100", "Percentage", 85, "null"),
            _rate(None, None, "fee_schedule", 15),
            _rate("lab", "102", "fee_schedule", 0),
            _rate("lab", "103", "fee_schedule", None),
        ],
        "amendments": [
            {"amendment_id": "A2", "amendment_date": "2024-09-01", "description": " bonus "},
            {"amendment_date": "2024-06-01", "rate_changes": "5% "},
        ],
        "extraction_metadata": {"confidence_score": 0.95, "source_file": "in/c1.pdf"},
    },
    {
        "contract_id": "C2",
        "payer_name": "Acme",
        "payer_id": "ACME1",
        "provider_npi": "1111111111",
        "provider_name": "A Clinic",
        "effective_date": "2023-01-01",
        "termination_date": "2023-12-31",
        "rate_schedules": [_rate("INPATIENT", "900", "CASE_RATE", 100)],
        "amendments": [],
    },
    {
        "contract_id": "C3",
        "payer_name": "Beta",
        "payer_id": "B-001",
        "provider_npi": "2222222222",
        "provider_name": "Metro\tGeneral\tHospital",
        "effective_date": None,
        "termination_date": None,
        "rate_schedules": [],
        "amendments": [],
        "extraction_metadata": {"confidence_score": 0.6, "source_file": "in/c3.pdf"},
    },
    {"contract_id": None, "payer_id": "X", "rate_schedules": [_rate("LAB", "1", "x", 5)]},
]


@pytest.fixture(scope="module")
def raw(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("records")
    for i, record in enumerate(RECORDS):
        sub = folder / f"payer={i}"
        sub.mkdir()
        (sub / f"r{i}.json").write_text(json.dumps(record, indent=2))
    return files.with_load_time(files.read_contracts(spark, str(folder)))


@pytest.fixture(scope="module")
def built(spark, raw):
    return build.build(build.stage(raw), AS_OF)


def _rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


def test_staged_contracts(built):
    got = _rows(built["stg_contracts"], "contract_id", "payer_name", "payer_id", "provider_name")
    assert got == [
        ("C1", "Acme Health", "ACME1", "North Clinic"),
        ("C2", "Acme", "ACME1", "A Clinic"),
        ("C3", "Beta", "B-001", "Metro General Hospital"),
    ]


def test_staged_rates(built):
    columns = ["rate_line_number", "service_category", "cpt_code", "rate_type", "rate_unit"]
    got = _rows(built["stg_rate_schedules"].where("contract_id = 'C1'"), *columns)
    assert got == [
        (1, "INPATIENT", "900", "PER_DIEM", "DAY"),
        (2, "INPATIENT", "901", "PER_DIEM", "EACH"),
        (3, "LAB", "100", "PERCENTAGE", "EACH"),
        (4, None, None, "FEE_SCHEDULE", "EACH"),
    ]
    days = _rows(built["stg_rate_schedules"], "contract_id", "rate_line_number", "rate_effective_date")
    assert ("C1", 1, D(2024, 2, 1)) in days and ("C1", 2, D(2024, 1, 1)) in days


def test_staged_amendments(built):
    got = _rows(
        built["stg_amendments"], "amendment_sequence", "amendment_id", "amendment_effective_date"
    )
    assert got == [(1, "AMD-C1-1", D(2024, 6, 1)), (2, "A2", D(2024, 9, 1))]


def test_enriched_contracts(built):
    got = _rows(
        built["int_contracts_enriched"],
        "contract_id",
        "contract_status",
        "contract_duration_days",
        "rate_schedule_count",
        F.col("total_rate_value").cast("double"),
        F.col("avg_rate_amount").cast("double"),
        "amendment_count",
        "last_amendment_date",
    )
    assert got == [
        ("C1", "ACTIVE", 730, 4, 1100.0, 275.0, 2, D(2024, 9, 1)),
        ("C2", "EXPIRED", 364, 1, 100.0, 100.0, 0, None),
        ("C3", "UNKNOWN", None, 0, None, None, 0, None),
    ]


def test_dimensions(built):
    assert _rows(built["dim_provider"], "provider_npi", "provider_name", "provider_status") == [
        ("1111111111", "A Clinic", "ACTIVE"),
        ("2222222222", "Metro General Hospital", "INACTIVE"),
    ]
    assert _rows(built["dim_payer"], "payer_id", "payer_name", "total_contracts", "payer_status") == [
        ("ACME1", "Acme Health", 2, "ACTIVE"),
        ("ACME1", "Acme", 2, "ACTIVE"),
        ("B-001", "Beta", 1, "ACTIVE"),
    ]
    assert built["dim_service"].count() == 3
    assert built["dim_date"].count() == 4017


def test_fact_keeps_the_fan_out_of_payer_names(built):
    fact = built["fact_contracted_rates"]
    got = fact.groupBy("contract_id").count().collect()
    assert {r[0]: r[1] for r in got} == {"C1": 8, "C2": 2}
    line = fact.where("cpt_code = '100'").first()
    assert float(line.normalized_rate) == 0.85
    assert line.effective_date_key == 20240101 and line.termination_date_key == 20251231
    assert fact.where("cpt_code IS NULL").first().service_key is None


def test_reference_tables_change_only_their_columns(spark, raw, built):
    payers = spark.createDataFrame(
        [("B-001", "Beta", "HMO", "CA", "u")],
        "payer_id string, payer_name string, payer_type string, payer_state string, payer_website string",
    )
    categories = spark.createDataFrame(
        [("Inpatient", "Inpatient care", "Stays")],
        "category_code string, category_name string, description string",
    )
    other = build.build(build.stage(raw), AS_OF, payers, categories)
    assert _rows(other["dim_payer"], "payer_id", "payer_type")[-1] == ("B-001", "HMO")
    assert _rows(other["dim_service"].where("cpt_code = '900'"), "category_name") == [
        ("Inpatient care",)
    ]
    names = _rows(other["fact_contracted_rates"], "service_category", "service_category_name")
    assert ("INPATIENT", "Inpatient care") in names and ("LAB", "LAB") in names
    assert other["fact_contracted_rates"].count() == built["fact_contracted_rates"].count()


def _stable(df):
    keep = [c for c in df.columns if not c.startswith("_")]
    return sorted((tuple(r) for r in df.select(keep).collect()), key=repr)


def test_both_staging_plans_agree(spark):
    """Numbering inside the row equals the window, and equals the slices for hot contracts."""
    documents = testdata.contract_documents(spark, FOLDER).where("contract_id < 'CON-2'")
    contracts = staging.stg_contracts(files.with_load_time(documents))
    narrow = staging.numbered_rates_of_unique_contracts(contracts)
    lines = staging.rate_lines(contracts)
    wide = staging.stg_rate_schedules(lines)
    sliced = staging.stg_rate_schedules(lines, hot=dict.fromkeys(["CON-100", "CON-101", "CON-102"], 3))
    assert _stable(narrow) == _stable(wide) == _stable(sliced)
    narrow = staging.numbered_amendments_of_unique_contracts(contracts)
    lines = staging.amendment_lines(contracts)
    assert _stable(narrow) == _stable(staging.stg_amendments(lines))
    assert _stable(narrow) == _stable(staging.stg_amendments(lines, hot={"CON-102": 1, "CON-12": 1}))
    plan = narrow._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in plan


def test_one_repeated_id_leaves_the_others_unshuffled(spark):
    documents = testdata.contract_documents(spark, FOLDER)
    raw = files.with_load_time(documents.unionByName(documents.where("contract_id = 'CON-1'")))
    contracts = staging.stg_contracts(raw)
    repeated = build.repeated_contracts(contracts)
    assert [r[0] for r in repeated.collect()] == ["CON-1"]
    usual, again = build.split_by(contracts, repeated)
    assert (usual.count(), again.count()) == (documents.count() - 1, 2)
    staged = build.stage(raw)
    for lines in (
        staging.numbered_rates_of_unique_contracts(usual),
        staging.numbered_amendments_of_unique_contracts(usual),
        intermediate.int_rates_normalized(build.split_by(staged.rates, repeated)[0]),
    ):
        plan = lines._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan
    wide = staging.stg_rate_schedules(staging.rate_lines(contracts))
    assert _stable(staged.rates) == _stable(wide)


def test_hot_contract_gives_the_same_tables(spark):
    """One contract holds a third of all documents; every hot path is taken."""
    documents = testdata.contract_documents(spark, FOLDER).where("contract_id < 'CON-11'")
    some = F.col("contract_id").isin("CON-1", "CON-10", "CON-100", "CON-101", "CON-102")
    documents = documents.withColumn(
        "contract_id", F.when(some, F.lit("CON-HOT")).otherwise(F.col("contract_id"))
    )
    raw = files.with_load_time(documents, F.lit("2024-01-01").cast("timestamp"))
    plain = build.stage(raw)
    hot = build.stage(raw, min_hot_rows=3)
    assert not plain.hot_rates
    assert "CON-HOT" in {r.key for r in hot.hot_rates.table.collect()}
    assert [r.key for r in hot.hot_contracts.table.collect()] == ["CON-HOT"]
    assert [r[0] for r in plain.repeated.collect()] == ["CON-HOT"]
    expected, got = build.build(plain, AS_OF), build.build(hot, AS_OF)
    for name in (
        "stg_rate_schedules",
        "stg_amendments",
        "int_contracts_enriched",
        "int_rates_normalized",
        "fact_contracted_rates",
    ):
        assert _stable(expected[name]) == _stable(got[name]), name


def test_keys_do_not_depend_on_partitions(spark):
    documents = testdata.contract_documents(spark, FOLDER).where("contract_id < 'CON-2'")
    contracts = staging.stg_contracts(files.with_load_time(documents))
    lines = staging.rate_lines(contracts)
    few = _stable(staging.stg_rate_schedules(lines.coalesce(1)))
    many = _stable(staging.stg_rate_schedules(lines.repartition(13, "rate_type")))
    assert few == many


def test_quality_report(spark, built):
    empty = spark.createDataFrame(
        [("P", None, "ODD"), ("P", "x", None)], "payer_id string, payer_name string, payer_type string"
    )
    categories = spark.createDataFrame([("A", "a")], "category_code string, category_name string")
    report = build.quality_report(built, empty, categories)
    found = {(r.test, r.table_name, r.column_name): r.failures for r in report.collect()}
    assert len(found) == 58 and {r.severity for r in report.collect()} == {"warn"}
    assert {k: n for k, n in found.items() if n} == {
        ("not_null", "stg_contracts", "effective_date"): 1,
        ("not_null", "stg_contracts", "termination_date"): 1,
        ("accepted_values", "int_contracts_enriched", "contract_status"): 1,
        ("unique", "dim_payer", "payer_key"): 1,
        ("unique", "dim_payer", "payer_id"): 1,
        ("unique", "fact_contracted_rates", "rate_key"): 5,
        ("unique", "ref_payers", "payer_id"): 1,
        ("not_null", "ref_payers", "payer_name"): 1,
        ("accepted_values", "ref_payers", "payer_type"): 1,
    }


def test_relationship_check_counts_rows(spark):
    child = spark.createDataFrame([("a",), ("b",), ("b",), (None,)], "k string")
    parent = spark.createDataFrame([("a",), ("a",)], "p string")
    check = checks.relationship("child", "k", "parent", "p")
    assert run_checks({"child": child, "parent": parent}, [check]).first().failures == 2


def test_history(spark, built):
    enriched = built["int_contracts_enriched"]
    t1, t2, t3 = (datetime.datetime(2024, m, 1) for m in (1, 2, 3))
    one = history.contract_history(None, enriched, t1)
    assert one.count() == 3 and one.where("dbt_valid_to IS NULL").count() == 3
    assert history.contract_history(one, enriched, t2).count() == 3

    changed = enriched.where("contract_id <> 'C2'").withColumn(
        "payer_name", F.when(F.col("contract_id") == "C1", "New").otherwise(F.col("payer_name"))
    )
    two = history.contract_history(one, changed, t2)
    got_columns = ("contract_id", "payer_name", "dbt_valid_from", "dbt_valid_to")
    got = _rows(two, *got_columns)
    assert got == sorted(
        [
            ("C1", "Acme Health", t1, t2),
            ("C1", "New", t2, None),
            ("C2", "Acme", t1, None),
            ("C3", "Beta", t1, None),
        ],
        key=repr,
    )
    hot = {"C1": 5, "C3": 2}
    assert _rows(history.contract_history(one, changed, t2, hot), *got_columns) == got
    three = history.contract_history(two, changed, t3)
    assert _rows(three, "contract_id", "dbt_valid_to") == _rows(two, "contract_id", "dbt_valid_to")


def test_validation(spark, raw):
    got = {r.contract_id: (r.is_valid, r.errors) for r in validate(raw).collect()}
    assert got["C2"][0] and got["C2"][1] == []
    assert got["C1"][1] == [
        "rate_schedules.4.rate_amount: Input should be greater than 0",
        "rate_schedules.5.rate_amount: Input should be a valid number",
        "amendments.1.amendment_id: Input should be a valid string",
        "extraction_metadata.extracted_at: Input should be a valid string",
    ]
    assert got["C3"][1][0] == "effective_date: Input should be a valid string"
    assert got[None][1][0] == "contract_id: Input should be a valid string"
    coerced = validate(raw, coerce=True).where("contract_id IS NULL").first()
    assert coerced.rate_schedules[0].rate_type == "FEE_SCHEDULE"


def test_extraction_of_one_document(spark):
    text = (
        "Contract Number: AB-77\nPayer: Acme Blue Cross\nProvider: St. Mary, Medical Center\n"
        "NPI: 12345678901\nEffective Date: 1/2/69\nExpires: 3-4-2025\n"
        "Amendment No. 1: new rates effective: 5/6/24 \nAmendment #2\n" + "x" * 600
    )
    tables_ = [
        (["Service Category", "CPT Code", "Rate", "Rate Type", "Fee"],
         [["LAB", "1", "$1,000.50", "X", "$7"], ["LAB", "2"], ["LAB", "3", "", "", "n/a"]]),
        (["Name"], [["1"]]),
    ]
    df = spark.createDataFrame([("in/a.pdf", text, tables_), ("in/b.pdf", "", None)], schemas.DOCUMENT_TEXT)
    at = F.lit("2024-01-15 10:30:00").cast("timestamp")
    full, blank = extract_contracts(df, at).orderBy("extraction_metadata.source_file").collect()
    assert full.contract_id == "AB-77" and full.payer_name == "Acme Blue Cross"
    assert full.payer_id == "AB-001" and full.provider_npi == "1234567890"
    assert full.provider_name == "St. Mary, Medical Center"
    assert (full.effective_date, full.termination_date) == ("1969-01-02", "2025-03-04")
    rates = [(r.service_category, r.cpt_code, r.rate_type, r.rate_amount) for r in full.rate_schedules]
    assert rates == [("LAB", "1", "FEE_SCHEDULE", 7.0)]
    first, second = full.amendments
    assert (first.amendment_id, first.effective_date) == ("AMD-1", "2024-05-06")
    assert (second.amendment_id, second.description) == ("AMD-2", "x" * 500)
    assert float(full.extraction_metadata.confidence_score) == 1.0
    assert blank.contract_id.startswith("CTR-20240115103000-") and blank.rate_schedules == []
    assert float(blank.extraction_metadata.confidence_score) == 0.15
    plain = extract_contracts(df, at, tables_available=False).collect()
    scores = sorted(float(r.extraction_metadata.confidence_score) for r in plain)
    assert scores == [0.105, 0.595] and all(r.amendments == [] for r in plain)


def test_split_table(spark):
    df = spark.createDataFrame([([["H", "I"], ["1", "2"], ["3"]],), ([],)], "cells array<array<string>>")
    got = [r[0].asDict() for r in df.select(split_table(F.col("cells"))).collect()]
    assert got == [{"headers": ["H", "I"], "rows": [["1", "2"], ["3"]]}, {"headers": [], "rows": []}]


def test_corrupt_json_is_kept(spark, tmp_path):
    (tmp_path / "bad.json").write_text('{"contract_id": ')
    (tmp_path / "good.json").write_text('{"contract_id": "G", "unknown": 1}')
    got = files.read_contracts(spark, str(tmp_path), keep_corrupt=True).cache()
    assert got.where("_corrupt_record IS NOT NULL").count() == 1
    assert got.where("contract_id = 'G'").count() == 1


def test_json_layout(spark, raw, tmp_path):
    path = str(tmp_path / "contracts")
    files.write_contracts(raw.drop("loaded_at"), path, D(2030, 1, 1))
    paths = {r.path.split("/contracts/")[1].rsplit("/", 1)[0] for r in files.list_objects(spark, path, ".json").collect()}
    assert "payer=B-001/contract_date=2030-01-01" in paths
    assert files.read_contracts(spark, path, multi_line=False).count() == 4


def test_pdf_files(spark, tmp_path):
    for name in ("a.pdf", "b.PDF", "c.txt"):
        (tmp_path / name).write_bytes(b"%PDF")
    got = files.pdf_files(spark, str(tmp_path)).select("path", "length").collect()
    assert sorted(r.path.rsplit("/", 1)[1] for r in got) == ["a.pdf", "b.PDF"]
    assert files.list_objects(spark, str(tmp_path)).count() == 3
    assert files.list_objects(spark, str(tmp_path), ".txt").count() == 1


def test_schemaless_nested_columns(spark, raw):
    """Variant columns give the same staging tables as declared ones."""
    loose = raw
    for name in ("rate_schedules", "amendments", "extraction_metadata"):
        loose = loose.withColumn(name, F.to_variant_object(F.col(name)))
    assert loose.schema["amendments"].dataType.typeName() == "variant"
    typed = files.with_declared_types(loose)
    for name in ("rate_schedules", "amendments", "extraction_metadata"):
        assert typed.schema[name].dataType == raw.schema[name].dataType
    assert _stable(staging.rate_lines(staging.stg_contracts(typed))) == _stable(
        staging.rate_lines(staging.stg_contracts(raw))
    )
    assert files.with_declared_types(raw).schema == raw.schema


def test_loading_twice_adds_nothing(spark, raw, tmp_path):
    path = str(tmp_path / "raw")
    known = raw.where("extraction_metadata.source_file IS NOT NULL")
    files.append_raw(known.where("contract_id = 'C1'").drop("loaded_at"), path)
    assert files.read_raw(spark, path).count() == 1
    files.append_raw(known.drop("loaded_at"), path)
    files.append_raw(known.drop("loaded_at"), path)
    assert files.read_raw(spark, path).count() == 2
    unnamed = raw.where("extraction_metadata.source_file IS NULL").drop("loaded_at")
    files.append_raw(unnamed, path)
    assert files.read_raw(spark, path).count() == 4


def test_seeds(spark, tmp_path):
    (tmp_path / "ref_payers.csv").write_text(
        "payer_id,payer_name,payer_type,payer_state,payer_website\n"
        + f"{'P' * 60},Acme,HMO,CA,https://example.com\n"
    )
    row = read_seed(spark, str(tmp_path), "ref_payers").first()
    assert len(row.payer_id) == 50 and row.payer_type == "HMO"


def test_tables_and_layout(spark, built):
    assert tables.layer("dim_payer") == "marts" and tables.layer("stg_contracts") == "staging"
    clustered = tables.clustered(built["fact_contracted_rates"])
    assert clustered.count() == built["fact_contracted_rates"].count()
    plan = clustered._jdf.queryExecution().executedPlan().toString()
    assert "REBALANCE_PARTITIONS_BY_COL" in plan
    fact = built["fact_contracted_rates"]
    for buckets in (0, 4):
        tables.save_fact(fact, buckets=buckets)
        assert spark.table("marts.fact_contracted_rates").count() == fact.count()
    tables.save_table(built["dim_payer"], "dim_payer")
    assert tables.load_table(spark, "dim_payer").count() == 3
    tables.save_view(built["dim_date"], "days_view")
    assert spark.table("days_view").count() == 4017


def test_deduped_dimensions(spark, raw):
    contracts = staging.stg_contracts(raw)
    payers = marts.dim_payer(contracts, as_of=AS_OF, dedupe=True)
    assert _rows(payers, "payer_id", "payer_name") == [("ACME1", "Acme"), ("B-001", "Beta")]


def test_status_needs_no_join_for_unique_contracts(spark, built):
    rates, enriched = built["stg_rate_schedules"], built["int_contracts_enriched"]
    joined = intermediate.int_rates_normalized(rates, enriched, as_of=AS_OF)
    assert _stable(joined) == _stable(built["int_rates_normalized"])


def test_history_of_repeated_keys_adds_nothing_for_equal_loads(spark):
    schema = "k string, v string"
    rows = [("a", "1"), ("a", "2"), ("b", "1"), ("b", "1"), ("c", None)]
    load = spark.createDataFrame(rows, schema)
    days = [datetime.datetime(2024, 1, d) for d in (1, 2, 3)]
    one = apply_snapshot(None, load, "k", ["v"], days[0])
    two = apply_snapshot(one, load, "k", ["v"], days[1])
    assert two.count() == 5 and two.where("dbt_valid_to is not null").count() == 0
    changed = spark.createDataFrame([("a", "2"), ("a", "3"), ("c", None)], schema)
    three = apply_snapshot(two, changed, "k", ["v"], days[2])
    closed = three.where("dbt_valid_to is not null").select("k", "v").collect()
    assert [tuple(r) for r in closed] == [("a", "1")]
    assert three.count() == 6
    assert apply_snapshot(three, changed, "k", ["v"], days[2]).count() == 6


def test_latest_load(spark):
    raw = spark.sql(
        """SELECT * FROM VALUES ('a', TIMESTAMP '2024-01-01', 'old', array(1)),
             ('a', TIMESTAMP '2024-01-02', 'new', array(2, 3)), ('a', TIMESTAMP '2024-01-02', 'new', array(2, 3)),
             ('b', TIMESTAMP '2024-01-01', 'x', NULL), ('b', NULL, 'z', NULL)
           AS t(contract_id, loaded_at, payer_name, lines)"""
    )
    got = sorted((r.contract_id, r.payer_name, r.lines) for r in build.latest_of_each(raw).collect())
    assert got == [("a", "new", [2, 3]), ("b", "x", None)]
    assert build.latest_of_each(raw.limit(0)).count() == 0


def test_no_date_without_its_key(spark):
    """The calendar of the fact covers all dates of the contracts."""
    fact = queries.fact_contracted_rates(spark, FOLDER)
    assert fact.where("rate_effective_date IS NOT NULL AND effective_date_key IS NULL").count() == 0
    late = "contract_termination_date IS NOT NULL AND termination_date_key IS NULL"
    assert fact.where(late).count() == 0


def test_bucketed_tables_join_and_group_without_a_shuffle(spark):
    totals = queries.published_contract_totals(spark, FOLDER)
    plan = totals._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Exchange" not in plan
    assert totals.count() > 1000


def _below(plan, node):
    """The part of a plan below the first node of that name, which is indented deeper."""
    lines = plan.split("\n")
    first = next(i for i, line in enumerate(lines) if node in line)
    depth = lines[first].index(node)
    deeper = takewhile(lambda line: not line[: depth + 1].strip(" :+-"), lines[first + 1 :])
    return "\n".join(deeper)


def test_lines_are_shuffled_without_keys(spark, monkeypatch):
    staged = queries._staged(spark, FOLDER)
    usual = queries._fact(spark, FOLDER, staged)
    dealt = queries._fact(spark, FOLDER, staged, 4)
    plan = dealt._jdf.queryExecution().optimizedPlan().toString()
    assert "_key#" not in _below(plan, "RebalancePartitions")
    assert _rows(dealt, *dealt.columns) == _rows(usual, *usual.columns)
    spark.sql("CREATE DATABASE IF NOT EXISTS marts")
    tables.save_fact(dealt, buckets=4, deal=False)
    files = spark.table("marts.fact_contracted_rates").select("_metadata.file_name").distinct()
    buckets = files.select(F.regexp_extract("file_name", r"_(\d{5})\.", 1)).distinct()
    assert files.count() == buckets.count() == 4

    monkeypatch.setattr(marts, "is_small", lambda table: False)
    monkeypatch.setattr(marts, "lookup_join", partial(skew.lookup_join, max_bytes=1))
    large = queries._fact(spark, FOLDER, staged)
    plan = large._jdf.queryExecution().optimizedPlan().toString()
    assert "unhex" in plan and "md5" not in _below(plan, "Join")
    assert _rows(large, *large.columns) == _rows(usual, *usual.columns)


def test_pdf_files_are_streamed_in_few_batches_listed_by_few_tasks(spark, tmp_path, monkeypatch):
    pages = spark.range(1800).selectExpr("id AS page_id", "concat('u', id) AS url", "'x' AS html")
    pages.write.parquet(f"{tmp_path}/pages.parquet")
    monkeypatch.setattr(queries, "new_folder", lambda _, name: str(tmp_path / name))
    found = queries.pdf_bytes(spark, str(tmp_path))
    assert found.where("streamed_bytes = bytes AND listed").count() == found.count() == 1200
    assert len(list((tmp_path / "sizes").glob("batch_id=*"))) == 1
    listing = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
    monkeypatch.setattr(queries.ingest, "list_in_few_tasks", lambda s: s.conf.set(listing, "7"))
    queries.ingest.pdf_stream(spark, str(tmp_path / "objects"))
    assert spark.conf.get(listing) == "7"
    spark.conf.unset(listing)


def test_a_small_load_rewrites_few_files_of_the_history(spark, tmp_path):
    path, days = str(tmp_path / "history"), [datetime.datetime(2024, m, 1) for m in (1, 2, 3)]
    load = spark.range(20_000).selectExpr("id AS k", "id % 7 AS v").unionByName(
        spark.createDataFrame([(None, 1)], "k long, v long")
    )
    merge_snapshot(path, load, "k", ["v"], days[0], ranges=100)
    before = {f.relative_to(tmp_path) for f in (tmp_path / "history/open").rglob("*.parquet")}
    changed = spark.range(7_000, 7_200).selectExpr("id AS k", "id % 5 AS v")
    for _ in range(2):  # the second is the same load again
        merge_snapshot(path, changed, "k", ["v"], days[1], ranges=100)
        after = {f.relative_to(tmp_path) for f in (tmp_path / "history/open").rglob("*.parquet")}
        assert len(before) > 90 and len(before - after) <= 3
        whole = apply_snapshot(
            apply_snapshot(None, load, "k", ["v"], days[0]), changed, "k", ["v"], days[1]
        )
        assert _rows(read_history(spark, path), *whole.columns) == _rows(whole, *whole.columns)
    merge_snapshot(path, changed, "k", ["v"], days[2], ranges=100)
    assert read_history(spark, path).count() == whole.count()


def test_a_history_is_compared_by_one_shuffle_at_any_size(spark):
    """Small tables too: else what is shuffled grows faster than the tables."""
    days = [datetime.datetime(2024, 1, d) for d in (1, 2)]
    rows = [("a", "x"), ("a", "y"), ("a", "y"), ("b", None), ("c", "z"), (None, "n")]
    load = spark.createDataFrame(rows, "k string, v string")
    changed = spark.createDataFrame([("a", "y"), ("b", "w"), ("d", None), (None, "n")], "k string, v string")
    one = apply_snapshot(None, load, "k", ["v"], days[0])
    two = apply_snapshot(one, changed, "k", ["v"], days[1])
    plan = two._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Join" not in plan
    found = [(r.k, r.v, r.dbt_valid_from.day, r.dbt_valid_to and r.dbt_valid_to.day) for r in two.collect()]
    assert sorted(found, key=repr) == sorted(
        [
            ("a", "x", 1, 2),
            ("a", "y", 1, None),
            ("a", "y", 1, None),
            ("b", None, 1, 2),
            ("b", "w", 2, None),
            ("c", "z", 1, None),
            ("d", None, 2, None),
            (None, "n", 1, None),
            (None, "n", 2, None),
        ],
        key=repr,
    )
    # a hot key is compared by joins, with the same result
    hot = apply_snapshot(one, changed, "k", ["v"], days[1], {"a": 3})
    assert sorted(map(tuple, hot.collect()), key=repr) == sorted(map(tuple, two.collect()), key=repr)


def test_documents_are_dealt_before_they_are_combined(spark):
    """No task sorts all the whole documents it has read."""
    from ratebook.sources import contracts as files

    rows = [("C1", ("f",)), ("C1", ("f",)), ("C2", (None,)), ("C2", (None,))]
    df = spark.createDataFrame(rows, "contract_id string, extraction_metadata struct<source_file:string>")
    new = files.new_contracts(df, None)
    lines = new._jdf.queryExecution().sparkPlan().toString().splitlines()
    places = [i for i, line in enumerate(lines) if "Exchange" in line or "Aggregate" in line]
    assert len(places) == 3 and "Exchange hashpartitioning(_document" in lines[places[-1]]
    assert sorted(r.contract_id for r in new.collect()) == ["C1", "C2"]


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _headers(spark):
    """Contracts of few providers and payers: NULL ids, names that differ, one id that repeats."""
    return spark.range(60).selectExpr(
        "concat('C', id DIV (CASE WHEN id < 2 THEN 2 ELSE 1 END)) AS contract_id",
        "CASE WHEN id % 7 = 3 THEN NULL ELSE concat('N', id % 5) END AS provider_npi",
        "CASE WHEN id % 4 = 1 THEN NULL ELSE concat('Clinic ', id % 3) END AS provider_name",
        "CASE WHEN id % 6 = 2 THEN NULL ELSE concat('P', id % 4) END AS payer_id",
        "concat('Payer ', id % 4) AS payer_name",
        "date_add(date'2024-01-01', int(id)) AS effective_date",
        "CASE WHEN id % 5 <> 0 THEN date_add(date'2024-06-01', int(id)) END AS termination_date",
    )


def test_provider_names_are_not_sorted_with_the_rows(spark):
    headers = _headers(spark)
    found = marts.dim_provider(headers, AS_OF)
    # a minimum of texts is computed over sorted rows: the distinct names only, not the contracts
    sorting = [line for line in _plan(found).split("\n") if "SortAggregate" in line]
    assert sorting and not any("effective_date" in line for line in sorting)
    wanted = {}
    for r in headers.where("provider_npi IS NOT NULL").collect():
        wanted.setdefault(r.provider_npi, []).append(r)
    assert found.count() == len(wanted)
    for row in found.collect():
        rows = wanted[row.provider_npi]
        assert row.provider_name == min(r.provider_name for r in rows if r.provider_name)
        assert row.total_contracts == len({r.contract_id for r in rows})
        assert row.unique_payers == len({r.payer_id for r in rows if r.payer_id})
        assert row.first_contract_date == min(r.effective_date for r in rows)
        ends = [r.termination_date for r in rows if r.termination_date]
        assert row.latest_contract_end == max(ends, default=None)


@pytest.mark.parametrize("dimension", [marts.dim_provider, marts.dim_payer])
def test_contracts_known_to_be_unique_are_counted_without_expanding_rows(spark, dimension):
    headers = _headers(spark).dropDuplicates(["contract_id"])
    counted = dimension(headers, as_of=AS_OF, unique_ids=True)
    assert "Expand" not in _plan(counted)
    drop = "_created_at"
    assert sorted(map(str, counted.drop(drop).collect())) == sorted(
        map(str, dimension(headers, as_of=AS_OF).drop(drop).collect())
    )


def test_lines_are_read_in_several_splits_for_each_core(spark):
    name = "spark.sql.files.minPartitionNum"
    spark.conf.unset(name)
    try:
        build.stage(files.with_load_time(files.declared(testdata.contract_documents(spark, FOLDER))))
        assert int(spark.conf.get(name)) == 4 * spark.sparkContext.defaultParallelism
        spark.conf.set(name, "3")
        storage.read_in_small_splits(spark)
        assert spark.conf.get(name) == "3"
    finally:
        spark.conf.unset(name)
    rows = spark.range(0, 400_000, 1, 1).selectExpr("md5(string(id)) AS k")
    lines = storage.stored(rows, "lines", 1_000_000)
    (file,) = lines.inputFiles()
    assert pq.ParquetFile(file.removeprefix("file://")).metadata.num_row_groups > 4
    assert lines.count() == 400_000


def test_of_large_services_only_unusual_codes_are_joined(spark, monkeypatch):
    """A code of several rows, of none or with another key is listed; the other keys are computed."""
    import hashlib

    def key(code):
        return hashlib.md5(code.encode()).hexdigest()

    rows = [("A", key("A")), ("B", key("B")), ("B", key("B")), ("C", "other"), ("E", key("E"))]
    services = spark.createDataFrame(rows, "cpt_code string, service_key string")
    codes = ["A", "A", "B", "C", "D", None]
    fields = """rate_schedule_id string, contract_id string, payer_id string, provider_npi string,
        rate_line_number bigint, cpt_code string, rate_amount decimal(12,2), normalized_rate decimal(12,2),
        rate_type string, rate_unit string, rate_modifier string, rate_status string,
        contract_status string, service_category string, service_category_name string, description string,
        rate_effective_date date, contract_effective_date date, contract_termination_date date,
        _loaded_at timestamp"""
    lines = [(f"{i:032x}", f"C{i}", "p", "n", i, c, *[None] * 14) for i, c in enumerate(codes)]
    rates = spark.createDataFrame(lines, fields)
    providers = spark.createDataFrame([("pk", "n")], "provider_key string, provider_npi string")
    payers = spark.createDataFrame([("yk", "p")], "payer_key string, payer_id string")
    dates = spark.createDataFrame([], "full_date date, date_key int")

    def fact():
        made = marts.fact_contracted_rates(rates, providers, payers, services, dates, buckets=2)
        return sorted(map(tuple, made.select("rate_key", "cpt_code", "service_key").collect()), key=repr)

    monkeypatch.setattr(marts, "is_small", lambda table: True)
    expected = fact()
    assert [r[1:] for r in sorted(expected, key=lambda r: repr(r[1:]))] == [
        ("A", key("A")), ("A", key("A")), ("B", key("B")), ("B", key("B")), ("C", "other"), ("D", None), (None, None)
    ]
    # the listed codes are few, whatever the services are
    listed = []
    whole = marts._listed_services
    monkeypatch.setattr(marts, "_listed_services", lambda *a: listed.append(whole(*a)) or listed[0])
    monkeypatch.setattr(marts, "is_small", lambda table: "_listed" in table.columns)
    assert fact() == expected
    assert sorted((r.cpt_code, r.service_key) for r in listed[0].collect() if r.cpt_code != "D") == [
        ("B", key("B")), ("B", key("B")), ("C", "other")
    ]
    assert listed[0].where("cpt_code = 'D' AND service_key IS NULL").count() == 1
    # nor does it matter if these are many
    listed.clear()
    monkeypatch.setattr(marts, "is_small", lambda table: False)
    assert fact() == expected
