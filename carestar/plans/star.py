"""The star build: dims -> lookups -> key validation -> fact -> bridges.

``StarBuild`` memoises every intermediate DataFrame. Given a ``store`` (a shared
folder), each table is written there as Parquet when it is first asked for and
read back, so a question pays for the tables it names, its scans are pruned and
filtered, and lineage ends at files that every executor can read. Without a
store everything stays one lazy plan.
"""

from __future__ import annotations

import os
from collections.abc import Mapping
from dataclasses import dataclass, field
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from carestar.operators import bridges as BR
from carestar.operators import dims as DM
from carestar.operators import fact as FA
from carestar.operators import lookups as LU
from carestar.operators import rejects as R
from carestar.operators.calendar import build_dim_date
from carestar.sources import sinks


@dataclass
class Params:
    as_of: str = "2025-01-01"                 # CURDATE() of the run, fixed for repeatability
    loaded_at: str = "2025-01-01 02:00:00"    # etl_loaded_date stamp
    calendar_start: str = "2020-01-01"
    calendar_end: str = "2030-12-31"
    fiscal_start_month: int = 1
    since: str = "2022-01-01"                 # question filter (timestamp >=)
    batch_id: str = "BATCH"
    check_dates: bool = False                 # optional MISSING_DATE reject
    fold_case: bool = False                   # T12: match type names case-insensitively

    @property
    def since_year(self) -> int:
        return int(self.since[:4])


# Parameters for the driver's test tables (orders span 1995-2001).
TEST_PARAMS = Params(calendar_start="1995-01-01", calendar_end="2002-12-31", since="1996-01-01",
                     batch_id="TEST_BATCH")


def stored(df: DataFrame, path: str | None, partition_by: list[str] | None = None) -> DataFrame:
    """``df``, or its written copy at ``path``."""
    if path is None:
        return df
    schema = df.schema
    sinks.write_table(df, path, partition_by)
    return df.sparkSession.read.schema(schema).parquet(path)


class LazyTables(Mapping):
    """Tables that are derived, and written to the store if there is one, when they are first named.

    ``unwritten``: tables that are selections of something stored already; a second copy would only cost its writing.
    """

    def __init__(self, makers: dict, store: str | None = None, unwritten: tuple[str, ...] = ()):
        self._makers, self._store, self._unwritten, self._made = makers, store, unwritten, {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._made:
            path = self._store and name not in self._unwritten and os.path.join(self._store, name)
            self._made[name] = stored(self._makers[name](), path or None)
        return self._made[name]

    def __iter__(self):
        return iter(self._makers)

    def __len__(self) -> int:
        return len(self._makers)


@dataclass
class StarBuild:
    """Star build over the OLTP tables; ``store`` is a shared folder for the tables, or None for one lazy plan."""
    spark: SparkSession
    oltp: Mapping[str, DataFrame]
    params: Params = field(default_factory=Params)
    store: str | None = None

    def _kept(self, name: str, df: DataFrame, partition_by: list[str] | None = None) -> DataFrame:
        return stored(df, self.store and os.path.join(self.store, name), partition_by)

    # ---- dimensions -------------------------------------------------------
    @cached_property
    def dim_date(self) -> DataFrame:
        p = self.params
        return self._kept("dim_date", build_dim_date(self.spark, p.calendar_start, p.calendar_end, p.fiscal_start_month))

    @cached_property
    def dim_specialty(self) -> DataFrame:
        return self._kept("dim_specialty", DM.build_dim_specialty(self.oltp["specialties"]))

    @cached_property
    def dim_department(self) -> DataFrame:
        return self._kept("dim_department", DM.build_dim_department(self.oltp["departments"]))

    @cached_property
    def dim_encounter_type(self) -> DataFrame:
        return self._kept("dim_encounter_type", DM.build_dim_encounter_type(self.spark))

    @cached_property
    def dim_diagnosis(self) -> DataFrame:
        return self._kept("dim_diagnosis", DM.build_dim_diagnosis(self.oltp["diagnoses"]))

    @cached_property
    def dim_procedure(self) -> DataFrame:
        return self._kept("dim_procedure", DM.build_dim_procedure(self.oltp["procedures"]))

    @cached_property
    def dim_patient(self) -> DataFrame:
        return self._kept("dim_patient", DM.build_dim_patient(self.oltp["patients"], self.params.as_of))

    @cached_property
    def dim_provider(self) -> DataFrame:
        return self._kept("dim_provider", DM.build_dim_provider(self.oltp["providers"], self.oltp["specialties"]))

    # ---- lookups and pre-aggregates ----------------------------------------
    @cached_property
    def provider_lookup(self) -> DataFrame:
        return self._kept("provider_lookup", LU.provider_lookup(self.oltp["providers"], self.dim_provider, self.dim_specialty))

    @cached_property
    def measures(self) -> DataFrame:
        o = self.oltp
        return LU.encounter_measures(o["encounter_diagnoses"], o["encounter_procedures"], o["billing"])

    @cached_property
    def resolved_encounters(self) -> DataFrame:
        return self._kept("resolved_encounters", FA.resolve_encounters(
            self.oltp["encounters"], LU.patient_lookup(self.dim_patient), self.provider_lookup,
            LU.department_lookup(self.dim_department), LU.encounter_type_lookup(self.dim_encounter_type),
            self.params.fold_case))

    # ---- fact and bridges ------------------------------------------------
    @cached_property
    def fact(self) -> DataFrame:
        dd = self.dim_date if self.params.check_dates else None
        fact = FA.build_fact(self.resolved_encounters, self.measures, self.params.loaded_at, dd)
        if self.store is None:
            return fact
        return self._kept("fact_encounters", FA.by_year(fact), ["date_year"])

    @cached_property
    def encounter_lookup(self) -> DataFrame:
        return BR.encounter_lookup(self.fact)

    @cached_property
    def resolved_diagnoses(self) -> DataFrame:
        # not stored, nor are the procedures: bridge and rejects need a pass each, which moves less than a copy of all links
        return BR.resolve_links(self.oltp["encounter_diagnoses"], self.encounter_lookup, self.dim_diagnosis,
                                "diagnosis_id", "diagnosis_key")

    @cached_property
    def resolved_procedures(self) -> DataFrame:
        return BR.resolve_links(self.oltp["encounter_procedures"], self.encounter_lookup, self.dim_procedure,
                                "procedure_id", "procedure_key")

    @cached_property
    def bridge_diagnoses(self) -> DataFrame:
        return self._kept("bridge_diagnoses", BR.build_bridge_diagnoses(self.resolved_diagnoses))

    @cached_property
    def bridge_procedures(self) -> DataFrame:
        largest = self.store and self.fact.agg(F.max("procedure_count")).first()[0]
        return self._kept("bridge_procedures", BR.build_bridge_procedures(self.resolved_procedures, largest))

    # ---- rejects -------------------------------------------------------------
    @cached_property
    def patient_rejects(self) -> DataFrame:
        return DM.patient_rejects(self.oltp["patients"], self.params.as_of)

    @cached_property
    def provider_rejects(self) -> DataFrame:
        return DM.provider_rejects(self.oltp["providers"], self.oltp["specialties"])

    @cached_property
    def encounter_rejects(self) -> DataFrame:
        out = FA.encounter_rejects(self.resolved_encounters)
        if self.params.check_dates:
            out = out.unionByName(FA.missing_date_rejects(self.resolved_encounters, self.dim_date))
        return out

    @cached_property
    def errors(self) -> DataFrame:
        """``etl_error_records`` rows of the run (cascade order: patients, providers,
        encounters, diagnosis links, procedure links)."""
        return self._kept("errors", R.quarantine(self.params.batch_id, self.patient_rejects, self.provider_rejects,
                                      self.encounter_rejects, BR.diagnosis_rejects(self.resolved_diagnoses),
                                      BR.procedure_rejects(self.resolved_procedures)))

    def tables(self) -> Mapping[str, DataFrame]:
        """The star tables; each is built when it is first named."""
        return LazyTables({
            "dim_date": lambda: self.dim_date, "dim_patient": lambda: self.dim_patient,
            "dim_provider": lambda: self.dim_provider, "dim_specialty": lambda: self.dim_specialty,
            "dim_department": lambda: self.dim_department, "dim_encounter_type": lambda: self.dim_encounter_type,
            "dim_diagnosis": lambda: self.dim_diagnosis, "dim_procedure": lambda: self.dim_procedure,
            "fact_encounters": lambda: self.fact, "bridge_encounter_diagnoses": lambda: self.bridge_diagnoses,
            "bridge_encounter_procedures": lambda: self.bridge_procedures,
        })
