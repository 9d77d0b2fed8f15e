from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from namebridge.config import MatchConfig
from namebridge.contracts import CLIENT_RAW, check
from namebridge.operators.ingest import ingest_clients, ingest_internal, rejected_clients
from namebridge.operators.normalise import clean_clients, clean_internal
from namebridge.operators.register import entities_for_matching, silver_entities, silver_relationships
from namebridge.plans import queries
from namebridge.sources.csv_files import read_register_csv, read_upload_csv
from namebridge.sources.export import export_bundle
from namebridge.sources.headers import normalise_header, unique_headers
from namebridge.sources.tables import TableStore, scratch_dir


def upload(spark, folder, text, name="f.csv"):
    (folder / name).write_text(text, encoding="utf-8")
    return read_upload_csv(spark, str(folder / name))


def test_headers():
    names = {"LEI": "lei", "lei ": "lei", "\ufeffLEI": "lei", "Client  (Name)": "client_name", "###": "unnamed"}
    assert {n: normalise_header(n) for n in names} == names
    assert unique_headers(["a", "A", "a_2", "##", "!!"]) == ["a", "a_2", "a_2_2", "unnamed", "unnamed_2"]


def test_name_only_upload(spark, tmp_path, rows):
    got = ingest_clients(upload(spark, tmp_path, "client_name\nApple\nApple Asia Ltd\n"))
    fields = ["submitted_name", "country", "registration_number", "lei", "address"]
    assert rows(got, *fields) == [("Apple", *[None] * 4), ("Apple Asia Ltd", *[None] * 4)]
    assert got.columns == ["client_entity_id", *fields, "client_source", "ingestion_timestamp"]
    assert got.first().client_source.endswith("f.csv")


def test_messy_upload(spark, tmp_path, rows):
    text = (
        "\ufeffCLIENT NAME, Country ,lei,LEI \n"
        " Apple ,US,,\n Apple ,US,,\nApple,,,\n  ,US,,\n,FR,L1,\n\"A, B\",GB,L2,L3\n"
    )
    table = upload(spark, tmp_path, text)
    assert table.columns[:4] == ["client_name", "country", "lei", "lei_2"]
    got = rows(ingest_clients(table), "submitted_name", "country", "lei")
    assert got == [("A, B", "GB", "L2"), ("Apple", "US", None), ("Apple", None, None)]
    rejected = rows(rejected_clients(table), "client_name", "country", "reject_reason")
    assert rejected == [("  ", "US", "blank_client_name"), (None, "FR", "missing_client_name")]


def test_ids_are_the_same_under_any_partitioning(spark, tmp_path, rows):
    table = upload(spark, tmp_path, "client_name\n" + "\n".join(f"Name {i}" for i in range(200)))
    once = rows(ingest_clients(table), "client_entity_id", "submitted_name")
    assert rows(ingest_clients(table.repartition(9)), "client_entity_id", "submitted_name") == once
    assert len({i for i, _ in once}) == 200


def test_mandatory_columns(spark, tmp_path):
    with pytest.raises(ValueError, match="client_name"):
        ingest_clients(upload(spark, tmp_path, "name\nApple\n"))
    with pytest.raises(ValueError, match="legal_name"):
        ingest_internal(upload(spark, tmp_path, "name\nApple\n"))


def test_internal_upload_in_the_older_form(spark, tmp_path, rows):
    got = ingest_internal(upload(spark, tmp_path, "risk_entity_id,client_name,risk_rating\n I1 , Apple ,Low\n"))
    assert rows(got) == [("I1", "Apple", None, None, None, None, "Low", None)]
    newer = ingest_internal(upload(spark, tmp_path, "legal_name,client_name\nApple,Other\n", "g.csv"))
    row = newer.first()
    assert row.legal_name == "Apple" and row.internal_entity_id.startswith("I") and len(row.internal_entity_id) == 33
    assert clean_internal(newer).first().clean_name == "apple"


LEI_FILE = '''LEI,Entity.LegalName,Entity.LegalAddress.FirstAddressLine,Entity.LegalAddress.City,Entity.LegalAddress.Country
L1,"Apple ""The"" Inc","1 Main
Street",Cupertino,US
L1,"Apple ""The"" Inc","1 Main
Street",Cupertino,US
L2,Plain,,,
,No key,,,US
'''
RR_FILE = '''Relationship.StartNode.NodeID,Relationship.EndNode.NodeID,Relationship.RelationshipType,Relationship.RelationshipStatus,Relationship.Period.1.startDate
L1,P1,T,ACTIVE,2018-01-15T00:00:00.000Z
L1,P1,T,ACTIVE,2018-01-15T00:00:00.000Z
L1,P2,T,ACTIVE,not a date
L1,,T,ACTIVE,2018-01-15
,P1,T,ACTIVE,2018-01-15
'''


def test_register_entities(spark, tmp_path, rows):
    (tmp_path / "lei.csv").write_text(LEI_FILE)
    bronze = read_register_csv(spark, str(tmp_path), partitions=3)
    assert bronze.count() == 4 and bronze.rdd.getNumPartitions() == 3
    silver = silver_entities(bronze)
    assert len(silver.columns) == 14
    assert rows(silver, "lei", "legal_name", "legal_address", "legal_form") == [
        ("L1", 'Apple "The" Inc', "1 Main\nStreet Cupertino US", None), ("L2", "Plain", "", None)
    ]
    assert entities_for_matching(silver).columns == [
        "lei", "legal_name", "country", "jurisdiction", "registration_number", "entity_status",
        "registration_status", "legal_form", "address",
    ]


def test_register_relationships(spark, tmp_path, rows):
    (tmp_path / "rr.csv").write_text(RR_FILE)
    silver = silver_relationships(read_register_csv(spark, str(tmp_path)))
    assert rows(silver, "child_lei", "parent_lei", "period_start", "period_end") == [
        ("L1", "P1", date(2018, 1, 15), None), ("L1", "P2", None, None)
    ]


def test_the_latest_load_wins(spark):
    early, late = datetime(2024, 1, 1), datetime(2024, 2, 1)
    bronze = spark.createDataFrame(
        [("L1", "Zeta", "f", late), ("L1", "Alpha", "f", early), ("L2", "B", "f", late), ("L2", "A", "f", late)],
        "LEI string, `Entity.LegalName` string, _source_file string, _bronze_loaded_at timestamp",
    )
    for table in (bronze, bronze.repartition(4)):
        got = {r.lei: r.legal_name for r in silver_entities(table).collect()}
        assert got == {"L1": "Zeta", "L2": "A"}


def test_register_without_source_file_is_shuffled_once_and_sorted_once(spark, rows):
    """The path of the file is long in memory; a caller who does not want it does not sort it."""
    late = datetime(2024, 2, 1)
    bronze = spark.createDataFrame(
        [("L1", "B", late), ("L1", "A", late), ("L1", "A", late), (None, "C", late)],
        "LEI string, `Entity.LegalName` string, _bronze_loaded_at timestamp",
    )
    silver = silver_entities(bronze)
    assert "_source_file" not in silver.columns and rows(silver, "lei", "legal_name") == [("L1", "A")]
    plan = silver._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Partial" not in plan


def test_register_files_of_the_queries_are_compressed(spark):
    path = queries._as_file(spark.createDataFrame([("a\nb",)] * 500, "v string"), "gz", ["V"], "gzip")
    back = read_register_csv(spark, path)
    assert all(f.endswith(".csv.gz") for f in back.inputFiles())
    assert back.count() == 500 and back.first().V == "a\nb"


def test_contract_violation_is_named(spark):
    table = spark.createDataFrame([("C1", 5)], "client_entity_id string, submitted_name int")
    with pytest.raises(ValueError, match=r"submitted_name string \(found int\).*lei string \(found nothing\)"):
        check(table, CLIENT_RAW, "Clients")
    with pytest.raises(ValueError, match="Clients needs"):
        clean_clients(table)


def test_store_in_the_catalog_with_tags(spark):
    store = TableStore(spark, database="stage_test")
    store.create_database()
    try:
        assert store.write("t", spark.range(3), {"data_layer": "bronze"}).count() == 3
        assert store.write("t", spark.range(2), {"data_layer": "bronze"}).count() == 2
        properties = {r.key: r.value for r in spark.sql("SHOW TBLPROPERTIES stage_test.t").collect()}
        assert properties["data_layer"] == "bronze"
    finally:
        spark.sql("DROP DATABASE stage_test CASCADE")
    with pytest.raises(ValueError, match="either"):
        TableStore(spark)


def test_scratch_lies_in_the_checkpoint_folder(spark):
    first, second = scratch_dir(spark, "x"), scratch_dir(spark, "x")
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    assert first.startswith(f"{root.rstrip('/')}/x-") and first != second


@pytest.mark.parametrize("rows", [None, 3])
def test_export_writes_all_rows_unless_asked(spark, tmp_path, rows):
    table = spark.range(10).select(F.format_string("%02d", "id").alias("k"), F.lit('a "quoted", text').alias("v"))
    name = "a_table_name_longer_than_thirty_one_characters"
    paths = export_bundle({name: table.repartition(5)}, str(tmp_path), MatchConfig(export_rows=rows), {name: ["k"]})
    assert paths[name].endswith("/" + name)
    back = spark.read.option("header", True).option("escape", '"').csv(paths[name]).orderBy("k").collect()
    assert [tuple(r) for r in back] == [(f"0{i}", 'a "quoted", text') for i in range(rows or 10)]
