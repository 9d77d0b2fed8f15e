"""Silver tables of the register: entities and relationship edges."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from namebridge.operators.blocking import spread_rows

_LINEAGE = ["_source_file", "_bronze_loaded_at"]

# Column names of the register files.
_ENTITY_COLUMNS = {
    "legal_name_language": "Entity.LegalName.xmllang",
    "country": "Entity.LegalAddress.Country",
    "hq_country": "Entity.HeadquartersAddress.Country",
    "legal_jurisdiction": "Entity.LegalJurisdiction",
    "registration_authority_id": "Entity.RegistrationAuthority.RegistrationAuthorityID",
    "registration_number": "Entity.RegistrationAuthority.RegistrationAuthorityEntityID",
    "legal_form": "Entity.LegalForm.EntityLegalFormCode",
    "entity_status": "Entity.EntityStatus",
    "registration_status": "Registration.RegistrationStatus",
}
_ADDRESS_PARTS = [
    "Entity.LegalAddress.FirstAddressLine",
    "Entity.LegalAddress.AdditionalAddressLine.1",
    "Entity.LegalAddress.City",
    "Entity.LegalAddress.Region",
    "Entity.LegalAddress.PostalCode",
    "Entity.LegalAddress.Country",
]
_EDGE_COLUMNS = {
    "child_lei": "Relationship.StartNode.NodeID",
    "parent_lei": "Relationship.EndNode.NodeID",
    "relationship_type": "Relationship.RelationshipType",
    "relationship_status": "Relationship.RelationshipStatus",
}


def column(name: str) -> Column:
    """A column whose name may hold dots."""
    return F.col(f"`{name}`")


def optional_column(df: DataFrame, name: str, as_type: str = "string") -> Column:
    """The column, or a typed null if the file lacks it; text that is no date becomes null."""
    if name not in df.columns:
        return F.lit(None).cast(as_type)
    return column(name) if as_type == "string" else column(name).try_cast(as_type)


def keep_one(df: DataFrame, key: list[str]) -> DataFrame:
    """One row per key, always the same: the latest load, then the least by all other columns.

    Copies of a register shrink to a small part in the shuffle but not in the sort, so partitions are not merged by bytes.
    """
    rest = [c for c in df.columns if c not in (*key, *_LINEAGE)]
    source = [c for c in df.columns if c == "_source_file"]
    order = Window.partitionBy(*key).orderBy(F.desc("_bronze_loaded_at"), *rest, *source)
    return spread_rows(df, *key).withColumn("_n", F.row_number().over(order)).filter("_n = 1").drop("_n")


def _lineage(bronze: DataFrame) -> list[str]:
    """The load time, and the source file unless the caller has dropped it."""
    return [c for c in _LINEAGE if c in bronze.columns]


def silver_entities(lei_bronze: DataFrame) -> DataFrame:
    optional = [optional_column(lei_bronze, source).alias(name) for name, source in _ENTITY_COLUMNS.items()]
    address = F.concat_ws(" ", *[optional_column(lei_bronze, part) for part in _ADDRESS_PARTS])
    selected = lei_bronze.select(
        F.col("LEI").alias("lei"),
        column("Entity.LegalName").alias("legal_name"),
        *optional,
        address.alias("legal_address"),
        *_lineage(lei_bronze),
    )
    return keep_one(selected.filter(F.col("lei").isNotNull()), ["lei"])


def entities_for_matching(entities: DataFrame) -> DataFrame:
    return entities.select(
        "lei", "legal_name", "country", F.col("legal_jurisdiction").alias("jurisdiction"), "registration_number",
        "entity_status", "registration_status", "legal_form", F.col("legal_address").alias("address"),
    )


def silver_relationships(rr_bronze: DataFrame) -> DataFrame:
    selected = rr_bronze.select(
        *[column(source).alias(name) for name, source in _EDGE_COLUMNS.items()],
        optional_column(rr_bronze, "Relationship.Period.1.startDate", "date").alias("period_start"),
        optional_column(rr_bronze, "Relationship.Period.1.endDate", "date").alias("period_end"),
        *_lineage(rr_bronze),
    )
    given = selected.filter(F.col("child_lei").isNotNull() & F.col("parent_lei").isNotNull())
    return keep_one(given, ["child_lei", "parent_lei", "relationship_type"])


def relationships_for_matching(relationships: DataFrame) -> DataFrame:
    return relationships.drop(*_LINEAGE)
