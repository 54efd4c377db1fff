"""Landed JSON pages of a study registry API.

Each page document is ``{studies: [...], totalCount, nextPageToken}``; pages
land as files, one document per line, or one per file over many lines
(``multi_line``). A page is read with its studies as raw text, and each study
is parsed alone: a study with a badly typed or broken field is reported with
its id and file and costs its neighbours nothing. Flattening is plain
nested-field access (missing level → null).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import PAGE_JSON_SCHEMA, STUDY_JSON_SCHEMA

P = "study.protocolSection"


def _g(path: str) -> Column:
    return F.col(f"{P}.{path}")


def read_pages(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """Page documents with their studies as raw text, ``_corrupt_record`` for
    unreadable ones, and where each came from: its file, the block of the file
    and its place there."""
    return placed((spark.read.schema(PAGE_JSON_SCHEMA).option("mode", "PERMISSIVE").option("multiLine", multi_line)
                   .option("columnNameOfCorruptRecord", "_corrupt_record").json(path)))


def placed(pages: DataFrame) -> DataFrame:
    """The file, block and row of each record of a file scan."""
    return pages.withColumns({"file": F.col("_metadata.file_path"), "block": F.col("_metadata.file_block_start"),
                              "row": F.monotonically_increasing_id()})


def _parsed(pages: DataFrame) -> DataFrame:
    """One row per study: its raw text, its struct (with ``_corrupt_record``
    where it could not be read in full), its page's totalCount and place. A page
    that could not be read is one row with no raw text."""
    schema = T.StructType([*STUDY_JSON_SCHEMA.fields, T.StructField("_corrupt_record", T.StringType())])
    raw = pages.select("file", "block", "row", "totalCount", F.col("_corrupt_record").alias("page_text"),
                       F.posexplode_outer("studies").alias("pos", "raw"))
    # said of the text alone: a filter on what was parsed would parse every study twice
    raw = raw.filter("raw IS NOT NULL OR page_text IS NOT NULL")
    study = F.from_json("raw", schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"})
    unread = F.col("study").isNull() | F.col("study._corrupt_record").isNotNull()
    return raw.withColumn("study", study).withColumn("bad", unread).withColumn("reason", F.when(
        F.col("raw").isNotNull() & unread, "unreadable study").when(
        F.col("raw").isNull(), "unreadable page"))


def bad_records(pages: DataFrame) -> DataFrame:
    """What could not be read: studies, by id, and whole pages, each with
    its file, the reason and its text, from one scan."""
    return _parsed(pages).filter("reason IS NOT NULL").select(
        F.get_json_object("raw", "$.protocolSection.identificationModule.nctId").alias("nct_id"),
        "file", "reason", F.coalesce("raw", "page_text").alias("text"))


def ordered_studies(pages: DataFrame) -> DataFrame:
    """Readable and unreadable studies in one pass: the flat columns, the place
    (file, block, row, pos), and for unreadable ones the reason and text."""
    keep = {"file": F.col("file"), "block": F.col("block"), "row": F.col("row"), "pos": F.col("pos"),
            "reason": F.col("reason"), "text": F.when(F.col("reason").isNotNull(), F.coalesce("raw", "page_text"))}
    return flatten_studies(_parsed(pages), keep=keep)


def scan_json_pages(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """One row per readable study (``study`` struct) with its page's
    totalCount. With ``bad_records`` this accounts for every study."""
    return _parsed(read_pages(spark, path, multi_line)).filter("NOT bad").select("study", "totalCount")


def join_scalars(arr: Column, sep: str) -> Column:
    """Array of strings → joined text; null/missing array → '' (null
    elements skipped)."""
    return F.concat_ws(sep, arr)


def join_field(arr: Column, field: str, sep: str) -> Column:
    """Array of structs → one field joined, empty/missing values dropped."""
    vals = F.transform(arr, lambda x: x[field])
    return F.concat_ws(sep, F.filter(vals, lambda v: v.isNotNull() & (v != "")))


def flatten_studies(studies: DataFrame, with_profile_fields: bool = False, keep: dict[str, Column] | None = None) -> DataFrame:
    """J1 (+ J6): the 16 export columns, nct_id, enrollment, data_source and
    the nested site list ``_locations``; ``keep`` adds columns."""
    interventions = _g("armsInterventionsModule.interventions")
    cols = [
        _g("identificationModule.organization.fullName").alias("org_name"),
        _g("identificationModule.organization.class").alias("org_class"),
        _g("sponsorCollaboratorsModule.responsibleParty.type").alias("responsible_party"),
        _g("identificationModule.briefTitle").alias("brief_title"),
        _g("identificationModule.officialTitle").alias("full_title"),
        _g("statusModule.overallStatus").alias("overall_status"),
        _g("statusModule.startDateStruct.date").alias("start_date"),
        join_scalars(_g("eligibilityModule.stdAges"), " ").alias("standard_age"),
        join_scalars(_g("conditionsModule.conditions"), ", ").alias("conditions"),
        _g("designModule.designInfo.primaryPurpose").alias("primary_purpose"),
        join_field(interventions, "name", ", ").alias("interventions"),
        join_field(interventions, "description", " | ").alias("intervention_description"),
        _g("designModule.studyType").alias("study_type"),
        join_scalars(_g("designModule.phases"), ", ").alias("phases"),
        join_field(_g("outcomesModule.primaryOutcomes"), "measure", " | ").alias("outcome_measure"),
        join_scalars(_g("conditionsModule.keywords"), ", ").alias("mesh"),
        _g("identificationModule.nctId").alias("nct_id"),
        _g("designModule.enrollmentInfo.count").alias("enrollment"),
        F.lit("api").alias("data_source"),
        _g("contactsLocationsModule.locations").alias("_locations"),
    ]
    if with_profile_fields:
        cols += [
            _g("statusModule.startDateStruct.type").alias("start_date_type"),
            _g("designModule.enrollmentInfo.type").alias("enrollment_type"),
            join_field(interventions, "type", ", ").alias("intervention_types"),
            _g("eligibilityModule.minimumAge").alias("minimum_age"),
            _g("eligibilityModule.maximumAge").alias("maximum_age"),
            _g("eligibilityModule.sex").alias("sex"),
            _g("sponsorCollaboratorsModule.leadSponsor.name").alias("lead_sponsor_name"),
            _g("sponsorCollaboratorsModule.leadSponsor.class").alias("lead_sponsor_class"),
        ]
    return studies.select(*cols, *[c.alias(n) for n, c in (keep or {}).items()])


def explode_locations(flat: DataFrame, key: str = "nct_id", with_position: bool = False) -> DataFrame:
    """One row per site; studies without sites produce no row. With
    ``with_position`` the site's place in its study is ``site_pos``."""
    place = ["site_pos"] if with_position else []
    return flat.select(key, F.posexplode("_locations").alias("site_pos", "loc")).select(
        key, *place, F.col("loc.facility").alias("facility"), F.col("loc.city").alias("city"),
        F.col("loc.state").alias("state"), F.col("loc.country").alias("country"),
        F.col("loc.zip").alias("zip_code"))


def filter_studies(studies: DataFrame, condition: str | None = None, status: str | None = None,
                   phase: str | None = None) -> DataFrame:
    """Source-side filters on the parsed studies, before they are flattened:
    condition substring (within one condition, which may hold a comma), exact
    status, phase membership."""
    out = studies
    if condition:
        out = out.filter(F.exists(_g("conditionsModule.conditions"), lambda c: c.contains(condition)))
    if status:
        out = out.filter(_g("statusModule.overallStatus") == status)
    if phase:
        out = out.filter(F.array_contains(_g("designModule.phases"), phase))
    return out


def limit_studies(flat: DataFrame, n: int, key: str = "nct_id") -> DataFrame:
    """Cap on studies, deterministic by key (top-n, bounded heap)."""
    return flat.orderBy(key).limit(n)


def fill_rates(flat: DataFrame, skip: tuple[str, ...] = ("_locations",)) -> DataFrame:
    """Non-null count and integer-floor percent per column, one pass."""
    cols = [c for c in flat.columns if c not in skip]
    wide = flat.agg(F.count(F.lit(1)).alias("__n"), *[F.count(c).alias(c) for c in cols])
    long = wide.unpivot(["__n"], cols, "column_name", "non_null")
    return long.select("column_name", "non_null",
                       F.floor(F.col("non_null") * 100 / F.nullif(F.col("__n"), F.lit(0)))
                       .cast("bigint").alias("fill_pct"))


def json_text_field(df: DataFrame, col: str, path: str, out: str) -> DataFrame:
    """A field out of a JSON text column."""
    return df.withColumn(out, F.get_json_object(F.col(col), path))


# -- landing pages built from the shared tables (test/bench input) -------------

def build_pages(raw: DataFrame, locations: DataFrame | None, page_size: int = 100, ordered: bool = False, waves=None,
                rows: DataFrame | None = None) -> DataFrame:
    """Nest raw study rows into page documents. Pages group studies by
    ``source_row_index div page_size`` (at most ``page_size`` per page);
    ``ordered`` pages are written to files in that order. Without ``locations``
    the rows have their ``page`` and ``sites`` and are dealt by ranges of pages
    (``fixtures.raw_studies_by_page``). ``waves``: a narrow transformation that gives
    each row its ``wave``, or one row for each of several; pages are made for each
    wave, from one exchange of the raw rows. ``rows``: the same studies, where they
    are counted with less work."""
    def arr(c, rx):
        return F.split(F.col(c), rx)
    r = raw
    if locations is not None:
        locs = locations.repartition("source_row_index").groupBy("source_row_index").agg(
            F.array_sort(F.collect_list(F.struct(F.col("facility"), F.col("city"), F.col("state"),
                                                 F.col("country"), F.col("zip_code").alias("zip")))).alias("sites"))
        # the plain rows are exchanged, by page, and nested after it
        r = raw.join(locs, "source_row_index", "left").withColumn("page", F.floor(F.col("source_row_index") / page_size).cast("long"))
        r = r.repartitionByRange("page") if ordered else r.repartition("page")
    by = ["page"] if waves is None else ["wave", "page"]
    r = r if waves is None else waves(r)
    nct = F.concat(F.lit("NCT"), F.lpad(F.col("source_row_index").cast("string"), 8, "0"))
    names = arr("interventions", ", ")
    study = F.struct(F.struct(
        F.struct(nct.alias("nctId"), F.col("brief_title").alias("briefTitle"),
                 F.col("full_title").alias("officialTitle"),
                 F.struct(F.col("org_name").alias("fullName"),
                          F.col("org_class").alias("class")).alias("organization"))
        .alias("identificationModule"),
        F.struct(F.col("overall_status").alias("overallStatus"),
                 F.struct(F.col("start_date").alias("date"), F.lit("ACTUAL").alias("type"))
                 .alias("startDateStruct")).alias("statusModule"),
        F.struct(F.col("study_type").alias("studyType"), arr("phases", ", ").alias("phases"),
                 F.struct(F.col("primary_purpose").alias("primaryPurpose")).alias("designInfo"),
                 F.struct((F.col("source_row_index") % 500).cast("int").alias("count"),
                          F.lit("ESTIMATED").alias("type")).alias("enrollmentInfo"))
        .alias("designModule"),
        F.struct(arr("conditions", ",, ").alias("conditions"), arr("mesh", ",").alias("keywords"))
        .alias("conditionsModule"),
        F.struct(F.transform(names, lambda n: F.struct(
            F.lit("DRUG").alias("type"), n.alias("name"),
            F.col("intervention_description").alias("description"))).alias("interventions"))
        .alias("armsInterventionsModule"),
        F.struct(F.lit("18 Years").alias("minimumAge"), F.lit(None).cast("string").alias("maximumAge"),
                 F.lit("ALL").alias("sex"), arr("standard_age", " +").alias("stdAges"))
        .alias("eligibilityModule"),
        F.struct(F.array(F.struct(F.col("outcome_measure").alias("measure"))).alias("primaryOutcomes"))
        .alias("outcomesModule"),
        F.struct(F.struct(F.col("responsible_party").alias("type")).alias("responsibleParty"),
                 F.struct(F.col("org_name").alias("name"), F.col("org_class").alias("class"))
                 .alias("leadSponsor")).alias("sponsorCollaboratorsModule"),
        F.struct(F.col("sites").alias("locations")).alias("contactsLocationsModule"),
    ).alias("protocolSection")).alias("study")
    counted = raw if rows is None else rows
    if waves is None:
        total = F.lit(counted.count())
    else:  # as many rows as there are waves
        counts = waves(counted).groupBy("wave").count().collect()
        total = F.coalesce(*[F.when(F.col("wave") == n["wave"], F.lit(n["count"])) for n in counts], F.lit(0))
    pages = r.select(*by, F.col("source_row_index").alias("k"), study).groupBy(*by).agg(
        F.transform(F.array_sort(F.collect_list(F.struct("k", "study"))), lambda s: s["study"])
        .alias("studies"))
    if ordered:
        pages = pages.sortWithinPartitions(*by)
    return pages.select("studies", total.cast("long").alias("totalCount"),
                        F.concat(F.lit("p"), (F.col("page") + 1).cast("string")).alias("nextPageToken"), *by[:-1])


def write_pages(pages: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Land pages, compressed: as plain text they take some twelve times the bytes.
    Pages of several waves go to folders of their own, ``wave=<name>``."""
    w = pages.write.mode(mode).option("compression", "gzip")
    (w.partitionBy("wave") if "wave" in pages.columns else w).json(path)
