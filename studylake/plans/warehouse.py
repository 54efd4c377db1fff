"""Warehouse build: cleaned rows → organizations, studies and bridge tables
with dense surrogate keys.

Plan shape (one range shuffle for the fact):
  raw ─ range shuffle and sort by source_row_index ─ clean (projection)
  ─ written once as Parquet with partition and position ─ study_id ─┬─ studies ⋈ organizations
                          └─ bridges (their own column only; ids by a running
                             sum within groups of studies)
  organizations: hash aggregate (partial agg map-side) → sorted by first row → org_id
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import clean as C
from ..operators import keys as K
from ..operators import normalize as N
from ..operators.load import write_table
from ..schemas import BRIDGE_SOURCE, BRIDGES, RAW_COLUMNS
from ..session import staging_path
from ..sources import fixtures
from ..sources.union import ORDER

SITE = ["facility", "city", "state", "country", "zip_code"]


class Warehouse:
    """Lazily built warehouse tables. Each property is built once; keyed
    tables trigger their (bounded) key jobs when first touched."""

    def __init__(self, cleaned: DataFrame, locations: DataFrame | None = None, pinned: bool = False,
                 landed: bool = False):
        """``cleaned``: cleaned study rows. ``pinned=True``: they are already
        written in ``source_row_index`` order (see ``from_raw``). ``landed=True``:
        in the order of several sources (see ``from_landed``)."""
        self.cleaned = cleaned
        self._pinned = pinned
        self._landed = landed
        self._locations_src = locations

    @classmethod
    def from_raw(cls, raw: DataFrame, locations: DataFrame | None = None,
                 clean=C.clean_raw, **kw) -> Warehouse:
        """Pin the raw rows by ``source_row_index`` (which cleaning never
        changes) and clean after the shuffle, inside the write, so the range
        sampling pass reads raw rows only and cleaning runs once."""
        pinned = K.pin_sorted(raw, ["source_row_index"], then=clean)
        return cls(pinned, locations, pinned=True, **kw)

    @classmethod
    def from_landed(cls, landed: DataFrame, sites: DataFrame | None = None) -> Warehouse:
        """Readable records of several sources (``union.land``), pinned in the
        order of sources, files and places; their row keys follow from that order.
        ``sites``: site rows by ``__source`` and ``source_row_index`` (the source's
        own index), besides those that studies carry."""
        def clean(d):
            return C.clean_raw_counted(d, RAW_COLUMNS).drop(*ORDER[2:], "__reason", "__text")
        pinned = K.pin_sorted(landed.filter("__reason IS NULL"), ORDER, then=clean)
        return cls(pinned, sites, pinned=True, landed=True)

    @classmethod
    def from_landed_in_place(cls, landed: DataFrame, n: int, sites: DataFrame | None = None) -> Warehouse:
        """``from_landed`` with about ``n`` rows pinned where they were landed, if that is their
        order (it is not where they have an index); ``K.LOT`` and ``K.AT`` tell where."""
        def clean(d):
            return C.clean_raw_counted(d, RAW_COLUMNS).drop("__reason", "__text")
        indexed = not landed.filter("__index IS NOT NULL").isEmpty()
        keyed = K.number_in_place(landed.filter("__reason IS NULL"), n, ORDER, ["__source", "__file", "__block"], "study_id",
                                  then=clean, sort=indexed)
        keyed.df = keyed.df.drop(*ORDER[2:]).withColumn("source_row_index", F.col("study_id") - 1)
        w = cls(keyed.df.drop("study_id", "source_row_index"), sites, pinned=True, landed=True)
        w._keyed_rows = keyed
        return w

    @classmethod
    def from_sf(cls, spark: SparkSession, sf_dir: str) -> Warehouse:
        return cls.from_raw(fixtures.raw_studies(spark, sf_dir),
                            fixtures.raw_locations(spark, sf_dir))

    # -- dimension -------------------------------------------------------
    @cached_property
    def organizations_all(self) -> DataFrame:
        """N7 output, null name included. Read from the pinned fact (already
        cleaned and written), so the source is not cleaned twice, and staged:
        the key's sampling pass reads the names alone, and its partitions
        follow the bytes of the names, not those of the fact."""
        path = staging_path(self.cleaned.sparkSession, "organizations")
        write_table(N.extract_orgs(self._keyed_rows.df), path)
        return self.cleaned.sparkSession.read.parquet(path)

    @cached_property
    def _orgs_keyed(self) -> K.Keyed:
        return K.org_keys(self.organizations_all)

    @property
    def organizations(self) -> DataFrame:
        return self._orgs_keyed.df.select("org_id", "org_name", "org_class")

    # -- fact --------------------------------------------------------------
    @cached_property
    def _keyed_rows(self) -> K.Keyed:
        """Cleaned rows with study_id, in source_row_index order."""
        if self._pinned:
            keyed = K.number_pinned(self.cleaned, "study_id")
            if self._landed:
                keyed.df = keyed.df.withColumn("source_row_index", F.col("study_id") - 1)
            return keyed
        return K.study_keys(self.cleaned)

    @cached_property
    def studies(self) -> DataFrame:
        fact = C.build_studies(self._keyed_rows.df)
        with_org = K.resolve_org_id(fact, self.organizations)
        cols = ["study_id", "org_id"] + [c for c in fact.columns if c != "study_id"]
        return with_org.select(*cols)

    # -- bridges -----------------------------------------------------------
    def bridge(self, name: str) -> DataFrame:
        _, value_col, sep = BRIDGES[name]
        src = BRIDGE_SOURCE[name]
        rows = self._keyed_rows.df.select("study_id", "source_row_index", src)
        keyed = K.child_key(rows, "study_id", N.tokens(src, sep), value_col)
        return keyed.select("id", "study_id", value_col, "source_row_index", "pos")

    @cached_property
    def conditions(self) -> DataFrame:
        return self.bridge("conditions")

    @cached_property
    def interventions(self) -> DataFrame:
        return self.bridge("interventions")

    @cached_property
    def age_groups(self) -> DataFrame:
        return self.bridge("age_groups")

    @cached_property
    def mesh_terms(self) -> DataFrame:
        return self.bridge("mesh_terms")

    @cached_property
    def _sites(self) -> DataFrame:
        """Site rows that come beside the studies, each with its study's id (null
        where there is no such study), written once: the loaded rows and the
        rejected ones are both read from it."""
        if self._locations_src is None:
            raise ValueError("no location source bound")
        rows = self._keyed_rows.df
        if self._landed:
            ids = rows.select("__source", F.col("__index").alias("source_row_index"), "study_id").filter("source_row_index IS NOT NULL")
            # an index that stands on several records belongs to the first of them
            ids = ids.groupBy("__source", "source_row_index").agg(F.min("study_id").alias("study_id"))
            joined = self._locations_src.join(ids, ["__source", "source_row_index"], "left")
        else:
            joined = self._locations_src.join(rows.select("source_row_index", "study_id"), "source_row_index", "left")
        path = staging_path(self.cleaned.sparkSession, "sites")
        write_table(joined, path)
        return self.cleaned.sparkSession.read.schema(joined.schema).parquet(path)

    def _nested_sites(self, *keep: str) -> DataFrame:
        own = [F.col(f"loc.{c}").alias(a) for c, a in zip(["facility", "city", "state", "country", "zip"], SITE)]
        rows = self._keyed_rows.df.select("study_id", "_locations")
        return K.child_key(rows, "study_id", F.col("_locations"), "loc").select("id", "study_id", *keep, *own)

    @cached_property
    def locations(self) -> DataFrame:
        """L4: site rows with their study ids (unmapped ones are
        ``locations_rejected``). Sites of a study follow their position, where
        the source has one, and then their own columns, so ids are the same in
        every run. Sites that only studies carry are numbered without a sort."""
        if self._locations_src is None and self._landed:
            return self._nested_sites()
        sites = self._sites.filter("study_id IS NOT NULL")
        place = ["site_pos"] if "site_pos" in sites.columns or self._landed else []
        if place and place[0] not in sites.columns:
            sites = sites.withColumn("site_pos", F.lit(None).cast("int"))
        sites = sites.select("study_id", *place, *SITE)
        if self._landed:
            sites = sites.unionByName(self._nested_sites("pos").withColumnRenamed("pos", "site_pos").drop("id"))
        return K.dense_key(sites, ["study_id", *place, *SITE], "id").df.select("id", "study_id", *SITE)

    @property
    def locations_rejected(self) -> DataFrame:
        """K6: site rows whose study is not in the run."""
        return self._sites.filter("study_id IS NULL").drop("study_id")

    def table(self, name: str) -> DataFrame:
        """A table by its name in the warehouse."""
        if name in ("organizations", "studies"):
            return getattr(self, name)
        if name == "study_locations":
            return self.locations
        own = next(k for k, (t, _, _) in BRIDGES.items() if t == name)
        return getattr(self, own).select("id", "study_id", BRIDGES[own][1])

    def tables(self) -> dict[str, DataFrame]:
        """All tables but the sites."""
        return {n: self.table(n) for n in ["organizations", "studies", *[t for t, _, _ in BRIDGES.values()]]}
