"""Stage tables over the fixture views, written once per application and input folder.

The workflow keeps every stage as a table that the next steps read; so do the queries.
"""

from __future__ import annotations

from collections.abc import Hashable
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from namebridge.config import MatchConfig
from namebridge.operators.best_candidates import best_candidates
from namebridge.operators.hierarchy import enrich_hierarchy
from namebridge.operators.normalise import clean_clients, clean_internal, clean_reference
from namebridge.operators.ranking import match_results
from namebridge.operators.register_index import RegisterIndex
from namebridge.plans.fixtures import views
from namebridge.sources.tables import materialise

#: Edit-distance similarity: the form of the score that plain SQL can check.
LEV = MatchConfig(similarity="levenshtein")


class Stages:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.views = views(spark, sf_dir)
        self._tables: dict[Hashable, DataFrame] = {}
        self._index: RegisterIndex | None = None

    def _table(self, key: Hashable, build) -> DataFrame:
        if key not in self._tables:
            self._tables[key] = materialise(build(), key if isinstance(key, str) else key[0])
        return self._tables[key]

    def index(self) -> RegisterIndex:
        """The register prepared for matching, as a refresh of the register leaves it."""
        if self._index is None:
            self._index = RegisterIndex.scratch(self.reference())
        return self._index

    def clients(self) -> DataFrame:
        return self._table("clients", lambda: clean_clients(self.views["fx_clients"]))

    def reference(self) -> DataFrame:
        return self._table("reference", lambda: clean_reference(self.views["fx_entities"]))

    def internal(self) -> DataFrame:
        return self._table("internal", lambda: clean_internal(self.views["fx_internal"]))

    def entities(self) -> DataFrame:
        return self.reference().select("lei", "legal_name")

    def edges(self) -> DataFrame:
        return self._table(
            "edges",
            lambda: self.views["fx_relationships"].withColumns({
                "period_start": F.col("period_start").try_cast("date"),
                "period_end": F.lit(None).cast("date"),
            }),
        )

    def ranked(self, config: MatchConfig) -> DataFrame:
        return self._table(
            ("ranked", config),
            lambda: best_candidates(self.clients(), self.reference(), config, index=self.index()),
        )

    def matches(self, config: MatchConfig) -> DataFrame:
        return match_results(self.ranked(config), config, self.clients())

    def hierarchy(self, config: MatchConfig) -> DataFrame:
        return self._table(
            ("hierarchy", config),
            lambda: enrich_hierarchy(self.matches(config), self.edges(), self.entities(), config),
        )


@lru_cache(maxsize=8)
def _stages(application: str, sf_dir: str, spark: SparkSession) -> Stages:
    return Stages(spark, sf_dir)


def stages(spark: SparkSession, sf_dir: str) -> Stages:
    return _stages(spark.sparkContext.applicationId, str(sf_dir), spark)
