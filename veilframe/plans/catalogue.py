"""Every query of the library with its SQL, by name."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import values as V
from ..operators import predicates as P
from ..operators import regions as R
from ..operators.actions import Engine, as_wide, group_values
from ..operators.pixels import count_kept, mask_frames
from ..operators.recipe import Recipe
from ..operators.selectors import Field, Selector, selected, value_matches
from ..sources import views
from ..sources.scratch import shared_dir
from ..sources.views import FIELDS, FIELDS_SQL, INST_SQL, elements, inst, table
from ..streaming.stream import append_first, audit_counts, first_only, latest, read_latest, rewrite, run_available, stream_table
from . import batch

SALT = "unit-test-salt"
META = [Field(n, t, v, h) for n, t, v, h in FIELDS]

_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Registers a function under its name, with its SQL."""

    def add(f):
        _QUERIES[f.__name__] = f
        if sql:
            _SQL[f.__name__] = sql
        return f

    return add


def queries() -> dict:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)


def over_inst(select: str, more: str = "") -> str:
    return f"WITH {INST_SQL}{', ' + more if more else ''} {select}"


# Scans.


@query(over_inst("SELECT src_path, row_number() OVER (ORDER BY src_path) AS n FROM inst"))
def scan_sorted_paths(spark, sf_dir):
    """Sorted discovery; the rank comes from the range-sorted partitions, not from one window task."""
    return views.ranked(inst(spark, sf_dir).select("src_path"), "src_path", "n")


@query(over_inst("SELECT src_path, SOPClassUID FROM inst"))
def scan_pruned_header(spark, sf_dir):
    return inst(spark, sf_dir).select("src_path", "SOPClassUID")


# Gates and statuses.

_SOP = "SOPClassUID IN ('1.2.840.10008.5.1.4.1.1.3.1', '1.2.840.10008.5.1.4.1.1.6.1')"
_RSF = "len(list_filter(regions, lambda r: r.rsf IN (1, 2, 3))) > 0"


@query(over_inst(f"SELECT src_path, SOPClassUID FROM inst WHERE {_SOP}"))
def gate_sop(spark, sf_dir):
    return inst(spark, sf_dir).where(F.col("SOPClassUID").isin(*batch.ALLOWED_SOP)).select("src_path", "SOPClassUID")


@query(over_inst("SELECT src_path, len(regions)::INT AS n_regions FROM inst WHERE len(regions) > 0"))
def gate_regions(spark, sf_dir):
    return inst(spark, sf_dir).where(R.has_regions(F.col("regions"))).select("src_path", F.size("regions").alias("n_regions"))


@query(over_inst(f"SELECT src_path, rsf FROM inst WHERE {_RSF}"))
def gate_rsf(spark, sf_dir):
    return inst(spark, sf_dir).where(R.any_format(F.col("regions"))).select("src_path", "rsf")


_BOXES = """list_filter([{'x0': greatest(0, least(r.x0, n_cols - 1)), 'y0': greatest(0, least(r.y0, n_rows - 1)),
   'x1': greatest(0, least(r.x1, n_cols - 1)), 'y1': greatest(0, least(r.y1, n_rows - 1))} FOR r IN regions IF r.rsf IN (1, 2, 3)],
   lambda b: b.x1 - b.x0 >= 10 AND b.y1 - b.y0 >= 10)"""


def _offset_sql(digest: str) -> str:
    fold = "0::BIGINT"
    for i in range(8):
        fold = f"(({fold}) * 4294967296 + ('0x' || substr({digest}, {8 * i + 1}, 8))::BIGINT) % 365"
    return f"(CASE WHEN substr({digest}, 64, 1) IN ('1','3','5','7','9','b','d','f') THEN -1 ELSE 1 END * (({fold}) + 1))::INT"


def _shift_sql(date: str, days: str) -> str:
    return f"strftime(strptime({date}, '%Y%m%d')::DATE + {days}, '%Y%m%d')"


_HASHED = f"""hashed AS (SELECT *, substr(sha256('{SALT}' || PatientID), 1, 16) AS pid FROM inst),
seeded AS (SELECT *, sha256('{SALT}|' || pid) AS h FROM hashed),
moved AS (SELECT *, {_offset_sql("h")} AS offset_days FROM seeded),
dated AS (SELECT *, {_shift_sql("StudyDate", "offset_days")} AS study2, strptime(PatientBirthDate, '%Y%m%d')::DATE + offset_days AS birth2 FROM moved),
capped AS (SELECT *, strftime(greatest(birth2, (strptime(study2, '%Y%m%d')::DATE - INTERVAL 89 YEAR)::DATE), '%Y%m%d') AS birth3 FROM dated)"""
_STATUS = f"CASE WHEN NOT {_SOP} THEN 'skipped_disallowed_sop' WHEN len(regions) = 0 THEN 'skipped_no_ultrasound_regions' WHEN NOT {_RSF} THEN 'skipped_disallowed_region_spatial_format' WHEN len({_BOXES}) = 0 THEN 'pixel_fail' ELSE 'success' END"


@query(over_inst(f"SELECT src_path, pid AS PatientID, study2 AS StudyDate, birth3 AS PatientBirthDate, {_STATUS} AS status FROM capped", _HASHED))
def status_chain(spark, sf_dir):
    """The minimum slice: gates, hashed id, shifted study, capped birth date, status. One projection chain over the joins."""
    rows = inst(spark, sf_dir)
    true = F.lit(True)
    pixels = F.size(R.clipped(F.col("regions"), F.col("n_cols"), F.col("n_rows"))) > 0
    rows = rows.withColumn("status", batch.status(true, F.col("SOPClassUID"), F.col("regions"), true, true, pixels))
    return batch.surrogates(rows, SALT).select("src_path", "PatientID", "StudyDate", "PatientBirthDate", "status")


@query(over_inst(f"SELECT {_STATUS} AS status, count(*) AS n FROM inst GROUP BY 1"))
def status_counts(spark, sf_dir):
    true = F.lit(True)
    pixels = F.size(R.clipped(F.col("regions"), F.col("n_cols"), F.col("n_rows"))) > 0
    return inst(spark, sf_dir).groupBy(batch.status(true, F.col("SOPClassUID"), F.col("regions"), true, true, pixels).alias("status")).agg(F.count("*").alias("n"))


# Predicates.


def _predicate(name: str, field: str, value: str | None, sql: str) -> None:
    def run(spark, sf_dir):
        text = f"FORMAT dicom\n%filter f\nLABEL x\n{name} {field} {value or ''}\n"
        line = Recipe.parse(text).filters["f"][0].lines[0]
        rows = inst(spark, sf_dir)
        return rows.where(P.line_column(line, lambda f: F.col(f))).select("src_path", field)

    run.__name__ = f"pred_{name}"
    run.__doc__ = f"Records where {field} {name} {value or ''}".strip() + ", with missing and empty values told apart."
    query(over_inst(f"SELECT src_path, {field} FROM inst WHERE {sql}"))(run)


_predicate("contains", "Manufacturer", "vingmed|phil", "coalesce(regexp_matches(trim(Manufacturer), '(?i)vingmed|phil'), false)")
_predicate("notcontains", "Manufacturer", "vingmed|phil", "NOT coalesce(regexp_matches(trim(Manufacturer), '(?i)vingmed|phil'), false)")
_predicate("equals", "ManufacturerModelName", "SEQUOIA", "coalesce(lower(trim(ManufacturerModelName)) = 'sequoia', false)")
_predicate("notequals", "Manufacturer", "acuson", "NOT coalesce(lower(trim(Manufacturer)) = 'acuson', false)")
_predicate("missing", "Manufacturer", None, "Manufacturer IS NULL")
_predicate("present", "Manufacturer", None, "Manufacturer IS NOT NULL")
_predicate("empty", "ManufacturerModelName", None, "ManufacturerModelName = ''")

_RECIPE = """FORMAT dicom
%filter graylist
LABEL Chained tests
contains Manufacturer vingmed || equals Modality US + contains StudyDescription PROMO
coordinates 0,0,640,40
LABEL Two lines
equals Modality US
+ contains SeriesDescription URGENT|HIGH
coordinates all
keepcoordinates from:regions
%filter blacklist
LABEL Inline or
contains Manufacturer acuson + contains SeriesDescription low || missing Manufacturer
ctpcoordinates 0,0,100,20
%filter whitelist
LABEL Only boxes
keepcoordinates 10,10,200,200
LABEL Nothing
"""
_LABELS = {
    ("graylist", "Chained tests"): "(coalesce(regexp_matches(Manufacturer, '(?i)vingmed'), false) OR lower(Modality) = 'us') AND regexp_matches(StudyDescription, '(?i)PROMO')",
    ("graylist", "Two lines"): "lower(Modality) = 'us' AND regexp_matches(SeriesDescription, '(?i)URGENT|HIGH')",
    ("blacklist", "Inline or"): "(coalesce(regexp_matches(Manufacturer, '(?i)acuson'), false) AND regexp_matches(SeriesDescription, '(?i)low')) OR Manufacturer IS NULL",
    ("whitelist", "Only boxes"): "true",
}


def _label(group: str, name: str):
    return next(x for x in Recipe.parse(_RECIPE).filters[group] if x.name == name)


def _label_query(key: str, group: str, name: str) -> None:
    def run(spark, sf_dir):
        rows = inst(spark, sf_dir)
        return rows.where(P.label_column(_label(group, name), lambda f: F.col(f))).select("src_path")

    run.__name__ = key
    run.__doc__ = f"Records that the label {name!r} matches."
    query(over_inst(f"SELECT src_path FROM inst WHERE {_LABELS[group, name]}"))(run)


_label_query("pred_fold_no_precedence", "graylist", "Chained tests")
_label_query("label_and_lines", "graylist", "Two lines")
_label_query("label_inline_or", "blacklist", "Inline or")
_label_query("label_coords_only", "whitelist", "Only boxes")

#: Written by hand, as the report must have them.
_REASONS = {
    ("graylist", "Chained tests"): "Manufacturer contains vingmed or Modality equals US and StudyDescription contains PROMO",
    ("graylist", "Two lines"): "and Modality equals US SeriesDescription contains URGENT|HIGH",
    ("blacklist", "Inline or"): "Manufacturer contains acuson and SeriesDescription contains low or Manufacturer missing ",
    ("whitelist", "Only boxes"): "Only boxes",
}
_HITS = " UNION ALL ".join(f"SELECT src_path, '{g}' AS grp, '{n}' AS label, '{_REASONS[g, n]}' AS reason FROM inst WHERE {sql}" for (g, n), sql in _LABELS.items())


@query(over_inst(_HITS))
def verdict_findings(spark, sf_dir):
    """One row for each label that matches a record."""
    found = P.findings(Recipe.parse(_RECIPE), lambda f: F.col(f))
    return inst(spark, sf_dir).select("src_path", F.explode(found).alias("f")).select("src_path", "f.*")


_STRICT = " OR ".join(f"({sql})" for (g, _), sql in _LABELS.items() if g != "whitelist")


@query(over_inst(f"SELECT ({_STRICT}) AS flagged, count(*) AS n FROM inst GROUP BY 1"))
def verdict_partition(spark, sf_dir):
    """Clean and flagged records, by the gray and black lists."""
    recipe = Recipe.parse(_RECIPE.split("%filter whitelist")[0])
    flagged = F.size(P.findings(recipe, lambda f: F.col(f))) > 0
    return inst(spark, sf_dir).groupBy(flagged.alias("flagged")).agg(F.count("*").alias("n"))


@query("SELECT * FROM (VALUES " + ", ".join(f"('{g}', '{n}', '{r}')" for (g, n), r in _REASONS.items()) + ") AS t(grp, label, reason)")
def reason_string(spark, sf_dir):
    """The reason of each label, a constant of the compiled recipe."""
    rows = [(g, x.name, x.reason()) for g, labels in Recipe.parse(_RECIPE).filters.items() for x in labels if x.boxes or x.lines]
    return spark.createDataFrame(rows, "grp string, label string, reason string")


# Selectors, over the tall form.


def _selector(key: str, expression: str, sql: str) -> None:
    def run(spark, sf_dir):
        tall = elements(inst(spark, sf_dir))
        hit = selected(F.col("elements"), Selector.parse(expression))
        return tall.select("src_path", F.explode(hit).alias("e")).groupBy(F.col("e.keyword").alias("keyword")).agg(F.count("*").alias("n"))

    run.__name__ = key
    run.__doc__ = f"Fields that {expression!r} selects, with their number."
    query(over_inst(f"SELECT keyword, count(*) AS n FROM fields WHERE {sql} GROUP BY keyword", FIELDS_SQL))(run)


_selector("sel_exact", "(0010,0020)", "stripped = '00100020'")
_selector("sel_contains", "contains:^study|00100030", "regexp_matches(keyword, '(?i)^study') OR stripped = '00100030'")
_selector("sel_startswith", "startswith:Patient", "regexp_matches(keyword, '(?i)^Patient')")
_selector("sel_endswith", "endswith:UID", "regexp_matches(keyword, '(?i)UID$')")
_selector("sel_except", "except:Patient|Study", "NOT regexp_matches(keyword, '(?i)Patient|Study')")
_selector("sel_vr", "select:VR:UI", "vr = 'UI'")
_selector("sel_group", "select:GROUP:0010", "grp = 16")


# Actions.

def _engine(header: str, **options) -> Engine:
    return Engine(Recipe.parse("FORMAT dicom\n%header\n" + header), salt=SALT, **options)


def _action(key: str, header: str, select: dict[str, str], more: str = "", source: str = "inst", shapes: dict[str, int] | None = None, **options) -> None:
    """A recipe as two queries, wide and tall. shapes: columns with random values, of which so many characters are fixed."""
    columns = list(select)
    shown = lambda: [F.substring(c, 1, shapes[c]).alias(c) if c in (shapes or {}) else F.col(c) for c in columns]

    def run(spark, sf_dir):
        rows = _engine(header, **options).wide(inst(spark, sf_dir), META)
        return rows.select("src_path", *shown())

    def tall(spark, sf_dir):
        return as_wide(_engine(header, **options).tall(elements(inst(spark, sf_dir))), columns).select("src_path", *shown())

    sql = over_inst(f"SELECT src_path, {', '.join(f'{v} AS {k}' for k, v in select.items())} FROM {source}", more)
    for f, name in ((run, key), (tall, f"tall_{key}")):
        f.__name__ = name
        f.__doc__ = f"The recipe, in {'tall' if f is tall else 'wide'} form: " + "; ".join(header.strip().splitlines())
        query(sql)(f)


_action("act_add", "ADD PatientIdentityRemoved YES\nADD Manufacturer unknown\n", {"PatientIdentityRemoved": "'YES'", "Manufacturer": "'unknown'"})
_action("act_blank", "BLANK Manufacturer\nBLANK PatientName\n", {"Manufacturer": "CASE WHEN Manufacturer IS NOT NULL THEN '' END", "PatientName": "''"})
_action("act_keep", "KEEP PatientName\nREMOVE all\n", {"PatientName": "PatientName", "PatientID": "NULL::VARCHAR", "StudyDate": "NULL::VARCHAR"})
_action("act_replace", "REPLACE Manufacturer ANON\nREPLACE startswith:Patient X\n", {"Manufacturer": "CASE WHEN Manufacturer IS NOT NULL THEN 'ANON' END", "PatientID": "'X'", "PatientName": "'X'", "PatientBirthDate": "'X'"})
_action("act_remove", "REMOVE OperatorsName\nREMOVE contains:Description\n", {"OperatorsName": "NULL::VARCHAR", "StudyDescription": "NULL::VARCHAR", "SeriesDescription": "NULL::VARCHAR", "PatientName": "PatientName"})
_action("act_jitter", "JITTER StudyDate 5\nJITTER PatientBirthDate -31\nJITTER PatientName 3\n", {"StudyDate": _shift_sql("StudyDate", "5"), "PatientBirthDate": _shift_sql("PatientBirthDate", "(-31)"), "PatientName": "PatientName"})
_action("act_remove_protected", "REMOVE all\nREPLACE PatientID gone\nJITTER StudyDate 1\n", {"PatientID": "'gone'", "StudyDate": _shift_sql("StudyDate", "1"), "PatientName": "NULL::VARCHAR"})
_action("act_keep_guard", "REPLACE PatientName X\nBLANK StudyDate\nJITTER StudyDate 3\nKEEP PatientName\nKEEP StudyDate\nADD PatientName new\n", {"PatientName": "'new'", "StudyDate": "StudyDate"})
_action(
    "act_remove_conditional",
    "REMOVE all func:is_name\n",
    {"PatientName": "NULL::VARCHAR", "OperatorsName": "NULL::VARCHAR", "PatientID": "PatientID"},
    functions={"is_name": lambda v, f, get, x: F.lit(f.vr == "PN") & v.isNotNull()},
)
_action("act_convert", "REPLACE InstanceNumber abc\nADD Rows abc\nADD Columns 7\n", {"InstanceNumber": "'abc'", "Rows": "''", "Columns": "'7'"})
_action("act_jitter_salted", "REPLACE StudyDate deid_func:jitter\n", {"StudyDate": _shift_sql("StudyDate", _offset_sql("sha256('" + SALT + "|' || PatientID)"))})
_action(
    "act_shapes",
    "REPLACE endswith:UID deid_func:pydicom_uuid stable_remapping=false\nREPLACE PatientName deid_func:suffix_uuid\n",
    {"PatientName": "'patientname-'", "SOPInstanceUID": "'2.25.'"},
    shapes={"PatientName": 12, "SOPInstanceUID": 5},
)

#: What each first action leaves for each second one, on a date of 20230101; values 20221128 and 20221129, shifts 5 and 4.
_KINDS = ("ADD", "BLANK", "JITTER", "KEEP", "REPLACE", "REMOVE")
_VALUES = {"ADD": ("20221128", "20221129"), "REPLACE": ("20221128", "20221129"), "JITTER": ("5", "4")}
MATRIX = {
    "ADD": ("'20221129'", "''", _shift_sql("'20221128'", "4"), "'20221128'", "'20221129'", "NULL"),
    "BLANK": ("'20221129'", "''", "''", "StudyDate", "'20221129'", "NULL"),
    "JITTER": ("'20221129'", "''", _shift_sql("StudyDate", "9"), "StudyDate", "'20221129'", _shift_sql("StudyDate", "5")),
    "KEEP": ("'20221129'", "StudyDate", "StudyDate", "StudyDate", "StudyDate", "StudyDate"),
    "REPLACE": ("'20221129'", "''", _shift_sql("'20221128'", "4"), "StudyDate", "'20221129'", "'20221128'"),
    "REMOVE": ("'20221129'", "NULL", _shift_sql("StudyDate", "4"), "StudyDate", "'20221129'", "NULL"),
}


def matrix_recipe(first: str, second: str) -> str:
    word = lambda kind, k: f"{kind} StudyDate {_VALUES[kind][k]}" if kind in _VALUES else f"{kind} StudyDate"
    return f"{word(first, 0)}\n{word(second, 1)}\n"


@query(over_inst("SELECT src_path, " + ", ".join(f"({MATRIX[a][j]})::VARCHAR AS {a.lower()}_{b.lower()}" for a in _KINDS for j, b in enumerate(_KINDS)) + " FROM inst"))
def act_matrix_36(spark, sf_dir):
    """All pairs of actions on one date, 36 recipes in one pass over the records."""
    rows = inst(spark, sf_dir).select("src_path", "StudyDate")
    for a in _KINDS:
        for b in _KINDS:
            name = f"{a.lower()}_{b.lower()}"
            rows = rows.withColumn(name, F.col("StudyDate"))
            recipe = _engine(matrix_recipe(a, b).replace("StudyDate", name))
            rows = recipe.wide(rows, [Field(name, "00080020", "DA", "Study Date")])
    return rows.drop("StudyDate")


# Values.


@query(
    over_inst(
        "SELECT src_path, coalesce(CASE WHEN PatientID::BIGINT % 2 = 0 THEN 'anon-' || PatientID END, PatientID) AS PatientID FROM inst"
    )
)
def val_var_lookup(spark, sf_dir):
    """Replacement ids by left join; a patient without one keeps the id (the action has no effect)."""
    ids = views.identifiers(spark, sf_dir)
    rows = inst(spark, sf_dir).join(ids, "PatientID", "left")
    return _engine("REPLACE PatientID var:new_id\n", variables={"new_id": "new_id"}).wide(rows, META).select("src_path", "PatientID")


_GROUPS = "FORMAT dicom\n%values operators\nSPLIT OperatorsName by='#';minlength=4\n%values makers\nFIELD startswith:Manufacturer\n%fields dates\nFIELD endswith:Date\n%header\n"


@query(over_inst("SELECT src_path, array_to_string(list_sort(list_filter(list_distinct(string_split(OperatorsName, '#')), lambda x: len(x) >= 4)), '|') AS parts FROM inst"))
def val_group_split(spark, sf_dir):
    """The parts of the operators' names of four characters or more."""
    rules = Recipe.parse(_GROUPS).values["operators"]
    found = group_values(rules, lambda s: [F.col(m.keyword) for m in META if s.picks(m)])
    return inst(spark, sf_dir).select("src_path", F.array_join(F.array_sort(found), "|").alias("parts"))


@query(over_inst("SELECT src_path, array_to_string(list_sort(list_distinct(list_filter([Manufacturer, ManufacturerModelName], lambda x: x IS NOT NULL AND x <> ''))), '|') AS found FROM inst"))
def val_group_field(spark, sf_dir):
    """The distinct non-empty values of the maker's fields."""
    rules = Recipe.parse(_GROUPS).values["makers"]
    found = group_values(rules, lambda s: [F.col(m.keyword) for m in META if s.picks(m)])
    return inst(spark, sf_dir).select("src_path", F.array_join(F.array_sort(found), "|").alias("found"))


@query(
    over_inst(
        "SELECT src_path, CASE WHEN Manufacturer IS NOT NULL THEN '' END AS Manufacturer, CASE WHEN ManufacturerModelName <> '' THEN '' ELSE ManufacturerModelName END AS ManufacturerModelName, PatientName, "
        "CASE WHEN StudyDate IS NOT NULL THEN '19000101' END AS StudyDate, '19000101' AS PatientBirthDate FROM inst"
    )
)
def val_values_match(spark, sf_dir):
    """Blank whatever holds a value of a group; replace a list of fields."""
    engine = Engine(Recipe.parse(_GROUPS + "BLANK values:makers\nREPLACE fields:dates 19000101\n"), salt=SALT)
    return engine.wide(inst(spark, sf_dir), META).select("src_path", "Manufacturer", "ManufacturerModelName", "PatientName", "StudyDate", "PatientBirthDate")


# Functions.


@query(over_inst(f"SELECT src_path, substr(sha256('{SALT}' || PatientID), 1, 16) AS id_hash FROM inst"))
def fn_id_hash(spark, sf_dir):
    return inst(spark, sf_dir).select("src_path", V.id_hash(F.col("PatientID"), SALT).alias("id_hash"))


@query(f"SELECT c_custkey, {_offset_sql('h')} AS offset_days FROM (SELECT c_custkey, sha256('{SALT}|' || c_custkey) AS h FROM customer)")
def fn_day_offset(spark, sf_dir):
    return table(spark, sf_dir, "customer").select("c_custkey", V.day_offset(F.col("c_custkey").cast("string"), SALT).alias("offset_days"))


@query(over_inst(f"SELECT src_path, {_shift_sql('StudyDate', _offset_sql('h'))} AS StudyDate FROM (SELECT *, sha256('{SALT}|' || PatientID) AS h FROM inst)"))
def fn_jitter(spark, sf_dir):
    return _engine("REPLACE StudyDate deid_func:jitter\n").wide(inst(spark, sf_dir), META).select("src_path", "StudyDate")


@query(over_inst("SELECT src_path, study2 AS StudyDate, birth3 AS PatientBirthDate FROM capped", _HASHED))
def fn_birth_cap89(spark, sf_dir):
    header = "REPLACE PatientID deid_func:id_hash\nREPLACE StudyDate deid_func:jitter\nREPLACE PatientBirthDate deid_func:jitter_birthdate_cap_89\n"
    return _engine(header).wide(inst(spark, sf_dir), META).select("src_path", "StudyDate", "PatientBirthDate")


@query("SELECT event_id, strftime(ts + INTERVAL 3 DAY, '%Y%m%d%H%M%S') || '.' || strftime(ts, '%f') || CASE WHEN user_id % 2 = 0 THEN '+0100' ELSE '' END AS moved FROM events")
def fn_jitter_dt(spark, sf_dir):
    """Date-times with and without a zone, moved by three days."""
    text = F.concat(F.date_format("ts", "yyyyMMddHHmmss.SSSSSS"), F.when(F.col("user_id") % 2 == 0, "+0100").otherwise(""))
    return table(spark, sf_dir, "events").select("event_id", V.shift_datetime(text, F.lit(3)).alias("moved"))


@query()
def fn_uid_stable(spark, sf_dir):
    """Derived ids: decimal digits of a 512-bit digest, too wide for SQL numbers."""
    return inst(spark, sf_dir).select("src_path", V.stable_uid(F.col("SOPInstanceUID")).alias("uid"))


@query()
def fn_uid_salted(spark, sf_dir):
    return inst(spark, sf_dir).select("src_path", V.stable_uid(F.col("SOPInstanceUID"), SALT).alias("uid"))


@query("SELECT c_custkey, 36 AS plain, 46 AS suffixed, true AS under_root FROM customer")
def fn_uuid_random(spark, sf_dir):
    """Random ids have no fixed values; their shapes have."""
    rows = table(spark, sf_dir, "customer").select("c_custkey", V.random_uuid().alias("a"), V.suffixed_uuid("PatientID").alias("b"), V.random_uid().alias("c"))
    return rows.select("c_custkey", F.length("a").alias("plain"), F.length("b").alias("suffixed"), (F.col("c").rlike(r"^1\.2\.826\.\d+$") & (F.length("c") <= 64)).alias("under_root"))


@query(
    over_inst(
        "SELECT src_path, PatientID AS patient_dir, StudyInstanceUID AS study_dir, lpad(SeriesNumber, 3, '0') AS series_dir, "
        "lpad(InstanceNumber, 5, '0') || CASE WHEN count(*) OVER (PARTITION BY PatientID, StudyInstanceUID, SeriesNumber, InstanceNumber) > 1 THEN '-' || SOPInstanceUID ELSE '' END || '.dcm' AS instance_filename FROM inst"
    )
)
def fn_path_layout(spark, sf_dir):
    return batch.layout(inst(spark, sf_dir)).select("src_path", "patient_dir", "study_dir", "series_dir", "instance_filename")


@query("SELECT o_orderkey, printf('%03d', o_orderkey) AS three, printf('%05d', o_orderkey) AS five FROM orders")
def fn_zero_pad(spark, sf_dir):
    return table(spark, sf_dir, "orders").select("o_orderkey", V.zero_pad(F.col("o_orderkey"), 3).alias("three"), V.zero_pad(F.col("o_orderkey"), 5).alias("five"))


@query("SELECT event_id, trunc(value)::BIGINT AS whole, NULL::BIGINT AS none FROM events")
def fn_as_int(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", V.as_int(F.concat(F.lit(" "), F.col("value").cast("string"), F.lit(" "))).alias("whole"), V.as_int(F.col("event_type")).alias("none"))


@query(over_inst("SELECT src_path, replace(coalesce(nullif(trim(ManufacturerModelName), ''), 'UNKNOWN'), '/', '_') AS model_dir, replace(src_path, '/', '_') AS flat FROM inst"))
def fn_sanitize(spark, sf_dir):
    return inst(spark, sf_dir).select("src_path", V.sanitize(F.col("ManufacturerModelName")).alias("model_dir"), V.sanitize(F.col("src_path")).alias("flat"))


_BUFFER = "CASE WHEN upper(Manufacturer) = 'GE VINGMED ULTRASOUND' AND upper(ManufacturerModelName) = 'VIVID E9' THEN 0.04 WHEN upper(Manufacturer) = 'ACUSON' AND upper(ManufacturerModelName) = 'SEQUOIA' THEN 0.03 ELSE 0.0 END::DOUBLE"


@query(over_inst(f"SELECT src_path, {_BUFFER} AS buffer, CASE WHEN upper(trim(Manufacturer)) = 'PHILIPS' THEN 0.07 ELSE 0.01 END::DOUBLE AS fallback FROM inst"))
def buf_lookup_cascade(spark, sf_dir):
    """The built-in table, and one with wildcards only."""
    own = (("PHILIPS", "*", 0.07), ("*", "*", 0.01))
    made, model = F.col("Manufacturer"), F.col("ManufacturerModelName")
    return inst(spark, sf_dir).select("src_path", V.buffer_share(made, model).alias("buffer"), V.buffer_share(made, model, table=own).alias("fallback"))


# Boxes.


def _box_text(boxes):
    return F.array_join(F.transform(boxes, lambda b: F.concat_ws(",", b["x0"], b["y0"], b["x1"], b["y1"])), ";")


_TEXT = "array_to_string([concat_ws(',', b.x0, b.y0, b.x1, b.y1) FOR b IN {}], ';')"
_BAND = f"least(n_rows - 1, greatest(1, list_min([b.y0 FOR b IN {_BOXES}]) + round_even({_BUFFER} * n_rows, 0)::INT))"


def _clipped():
    return R.clipped(F.col("regions"), F.col("n_cols"), F.col("n_rows"))


@query(over_inst(f"SELECT src_path, len([r FOR r IN regions IF r.rsf IN (1, 2, 3)])::INT AS allowed, len({_BOXES})::INT AS usable FROM inst"))
def box_filter(spark, sf_dir):
    allowed = F.filter("regions", lambda r: F.coalesce(r["rsf"].isin(1, 2, 3), F.lit(False)))
    return inst(spark, sf_dir).select("src_path", F.size(allowed).alias("allowed"), F.size(_clipped()).alias("usable"))


@query(over_inst(f"SELECT src_path, {_TEXT.format(_BOXES)} AS boxes FROM inst"))
def box_clip(spark, sf_dir):
    return inst(spark, sf_dir).select("src_path", _box_text(_clipped()).alias("boxes"))


def _band():
    return R.top_band(_clipped(), F.col("n_cols"), F.col("n_rows"), V.buffer_share(F.col("Manufacturer"), F.col("ManufacturerModelName")))


@query(over_inst(f"SELECT src_path, CASE WHEN len({_BOXES}) > 0 AND {_BAND} < n_rows - 1 THEN concat_ws(',', 0, {_BAND}, n_cols, n_rows) ELSE '' END AS band FROM inst"))
def box_top_band(spark, sf_dir):
    return inst(spark, sf_dir).select("src_path", _box_text(_band()).alias("band"))


@query(over_inst(f"SELECT src_path, concat_ws(';', concat_ws(',', 0, 0, n_cols, n_rows), nullif({_TEXT.format(_BOXES)}, '')) AS boxes FROM inst"))
def box_keep_expand(spark, sf_dir):
    """`all` masked, then the usable regions kept."""
    boxes = F.concat(F.array(R.literal_box(0, "all", F.col("n_cols"), F.col("n_rows"))), _clipped())
    return inst(spark, sf_dir).select("src_path", _box_text(boxes).alias("boxes"))


_MEET = f"[b FOR b IN [{{'x0': b.x0, 'y0': greatest(b.y0, {_BAND}), 'x1': b.x1, 'y1': b.y1}} FOR b IN {_BOXES}] IF b.y1 > b.y0]"


@query(over_inst(f"SELECT src_path, CASE WHEN len({_BOXES}) > 0 AND {_BAND} < n_rows - 1 THEN {_TEXT.format(_MEET)} ELSE '' END AS boxes FROM inst"))
def box_strict_intersect(spark, sf_dir):
    return inst(spark, sf_dir).select("src_path", _box_text(R.intersection(_band(), _clipped())).alias("boxes"))


@query(
    over_inst(
        f"SELECT src_path, px, py, CASE WHEN len(list_filter(boxes, lambda b: b.x0 <= px AND px < b.x1 AND b.y0 <= py AND py < b.y1)) > 0 THEN 1 ELSE 0 END AS kept FROM (SELECT src_path, {_BOXES} AS boxes FROM inst), (VALUES (0, 0), (15, 10), (320, 200), (620, 470)) AS p(px, py)"
    )
)
def mask_point_last_wins(spark, sf_dir):
    """Everything masked, then regions kept: the last box over a point decides."""
    boxes = F.concat(F.array(R.literal_box(0, "all", F.col("n_cols"), F.col("n_rows"))), _clipped())
    points = F.array(*[F.struct(F.lit(x).alias("px"), F.lit(y).alias("py")) for x, y in ((0, 0), (15, 10), (320, 200), (620, 470))])
    rows = inst(spark, sf_dir).select("src_path", boxes.alias("boxes")).select("src_path", "boxes", F.explode(points).alias("p"))
    outside = R.kept_at(F.col("boxes"), F.col("p.px"), F.col("p.py"))
    return rows.select("src_path", "p.px", "p.py", outside.alias("kept"))


_EACH = f"list_transform({_BOXES}, lambda b: (b.x1 - b.x0) * (b.y1 - b.y0))"
#: At most two boxes of a record are usable, so the union is their sum without what they share.
_SHARED = "CASE WHEN len(u) = 2 THEN greatest(0, least(u[1].x1, u[2].x1) - greatest(u[1].x0, u[2].x0)) * greatest(0, least(u[1].y1, u[2].y1) - greatest(u[1].y0, u[2].y0)) ELSE 0 END"


@query(over_inst(f"SELECT src_path, (coalesce(list_sum(each), 0) - {_SHARED})::BIGINT AS covered FROM (SELECT src_path, {_BOXES} AS u, {_EACH} AS each FROM inst)"))
def mask_area(spark, sf_dir):
    """Pixels in the usable regions of a record, those in two of them once."""
    return inst(spark, sf_dir).select("src_path", _clipped().alias("boxes")).select("src_path", R.union_area(F.col("boxes")).alias("covered"))


# Log, resume, reports.


def _log(spark, sf_dir):
    """A log with repeated rows: each record twice, in the order of keys."""
    rows = inst(spark, sf_dir).select("src_path", "k1", "k2")
    return rows.withColumn("attempt", F.explode(F.array(F.lit(1), F.lit(2)))).withColumn("seq", F.col("k1") * 100 + F.col("k2") * 10 + F.col("attempt"))


_LOG_SQL = "log AS (SELECT src_path, k1, k2, attempt, k1 * 100 + k2 * 10 + attempt AS seq FROM inst, (VALUES (1), (2)) AS a(attempt))"


@query(over_inst("SELECT src_path, min(seq) AS seq FROM log GROUP BY src_path", _LOG_SQL))
def log_dedupe_first(spark, sf_dir):
    """The first row of each file."""
    return batch.first_rows(_log(spark, sf_dir), "seq").select("src_path", "seq")


@query(over_inst("SELECT src_path FROM inst WHERE src_path NOT IN (SELECT src_path FROM inst WHERE k1 % 3 = 0)"))
def log_resume_anti(spark, sf_dir):
    rows = inst(spark, sf_dir).select("src_path", "k1")
    log = rows.where("k1 % 3 = 0").select("src_path", F.lit("success").alias("status"))
    return batch.plan_work(rows, log.unionByName(log)).select("src_path")


@query("SELECT user_id, event_id, n, coalesce(epoch(ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id)), 0)::BIGINT AS since FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS n FROM events)")
def log_interval_rate(spark, sf_dir):
    """Completions so far and seconds since the last one, for each worker; half a second goes to the even number.

    Times have no zone, so their difference is taken as it stands, never by way of the session's zone.
    """
    at = Window.partitionBy("user_id").orderBy(F.asc_nulls_last("ts"), F.asc_nulls_last("event_id"))
    events = table(spark, sf_dir, "events")
    gap = (F.col("ts") - F.lag("ts").over(at)).cast("interval second").cast("decimal(19,6)")
    rest = gap % 86400
    # Days and the rest are added as doubles, as SQL does: over centuries that decides what is a half.
    since = F.rint((gap - rest).cast("double") + rest.cast("double")).cast("bigint")
    return events.select("user_id", "event_id", F.row_number().over(at).cast("bigint").alias("n"), F.coalesce(since, F.lit(0)).alias("since"))


@query(over_inst("SELECT StudyInstanceUID, SeriesNumber, InstanceNumber, count(*) AS n FROM inst GROUP BY ALL HAVING count(*) > 1"))
def collision_detect(spark, sf_dir):
    """Instances that one output name would be given to."""
    return inst(spark, sf_dir).groupBy("StudyInstanceUID", "SeriesNumber", "InstanceNumber").agg(F.count("*").alias("n")).where("n > 1")


@query(over_inst("SELECT src_path, ((row_number() OVER (ORDER BY src_path) - 1) % 5)::BIGINT AS worker FROM inst"))
def worker_modulo(spark, sf_dir):
    """Files dealt to five workers in the order of their paths."""
    ranked = views.ranked(inst(spark, sf_dir).select("src_path"), "src_path", "n")
    return ranked.select("src_path", ((F.col("n") - 1) % 5).alias("worker"))


@query(over_inst("SELECT keyword, min(stripped) AS tag, count(*) AS n FROM fields GROUP BY keyword", FIELDS_SQL))
def tag_census(spark, sf_dir):
    """Distinct fields over all records, in tag order."""
    flat = elements(inst(spark, sf_dir)).select(F.explode("elements").alias("e"))
    return flat.groupBy(F.col("e.keyword").alias("keyword")).agg(F.min("e.stripped").alias("tag"), F.count("*").alias("n")).orderBy("tag")


@query(over_inst("SELECT src_path, replace(concat_ws('^', PatientID, Manufacturer, SOPClassUID), ',', '^') AS joined, n_rows::VARCHAR AS n_rows FROM inst"))
def export_wide_csv(spark, sf_dir):
    """Wide report rows: multiple values joined by ^, commas out."""
    return inst(spark, sf_dir).select("src_path", F.translate(F.concat_ws("^", "PatientID", "Manufacturer", "SOPClassUID"), ",\n", "^").alias("joined"), F.col("n_rows").cast("string").alias("n_rows"))


# Text and JSON.


@query("SELECT doc_id, regexp_replace(text, '[A-Za-z0-9._]+@[A-Za-z0-9.]+', '[mail]', 'g') AS text, regexp_matches(text, '[A-Za-z0-9._]+@[A-Za-z0-9.]+') AS hit FROM documents")
def text_values_redact(spark, sf_dir):
    """Value patterns masked in free text."""
    pattern = r"[A-Za-z0-9._]+@[A-Za-z0-9.]+"
    return table(spark, sf_dir, "documents").select("doc_id", F.regexp_replace("text", pattern, "[mail]").alias("text"), F.col("text").rlike(pattern).alias("hit"))


@query("SELECT event_id, '{\"k\":' || (json_extract_string(props, '$.k')::BIGINT + 1) || ',\"redacted\":true}' AS props FROM events")
def json_props_rewrite(spark, sf_dir):
    """A field of a nested JSON value rewritten, another added."""
    got = F.from_json("props", "k bigint")
    return table(spark, sf_dir, "events").select("event_id", F.to_json(F.struct((got["k"] + 1).alias("k"), F.lit(True).alias("redacted"))).alias("props"))


# Tall form and bytes.

_ECHO = """REPLACE PatientID deid_func:id_hash
REPLACE StudyDate deid_func:jitter
REPLACE PatientBirthDate deid_func:jitter_birthdate_cap_89
BLANK PatientName
REMOVE OperatorsName
REMOVE contains:Description
ADD PatientIdentityRemoved YES
"""


@query(over_inst("SELECT src_path, pid AS PatientID, study2 AS StudyDate, birth3 AS PatientBirthDate, '' AS PatientName, NULL::VARCHAR AS OperatorsName, NULL::VARCHAR AS StudyDescription, Manufacturer, 'YES' AS PatientIdentityRemoved FROM capped", _HASHED))
def tall_roundtrip(spark, sf_dir):
    """The tall form of a whole recipe, as columns again; it must equal the wide form."""
    tall = _engine(_ECHO).tall(elements(inst(spark, sf_dir)))
    return as_wide(tall, ["PatientID", "StudyDate", "PatientBirthDate", "PatientName", "OperatorsName", "StudyDescription", "Manufacturer", "PatientIdentityRemoved"])


@query(over_inst("SELECT src_path, pid AS PatientID, study2 AS StudyDate, birth3 AS PatientBirthDate, '' AS PatientName, NULL::VARCHAR AS OperatorsName, NULL::VARCHAR AS StudyDescription, Manufacturer, 'YES' AS PatientIdentityRemoved FROM capped", _HASHED))
def recipe_wide(spark, sf_dir):
    """The same recipe in wide form: fused projections with a barrier before each function."""
    rows = _engine(_ECHO).wide(inst(spark, sf_dir), META)
    return rows.select("src_path", "PatientID", "StudyDate", "PatientBirthDate", "PatientName", "OperatorsName", "StudyDescription", "Manufacturer", "PatientIdentityRemoved")


@query("SELECT conv_id, turn, len(list_filter(['user', 'assistant'], lambda w: contains(lower(text), w))) > 0 AS hit FROM conversations")
def text_value_list(spark, sf_dir):
    """Texts that hold a value of a list, as literals."""
    wanted = F.array(F.lit("user"), F.lit("assistant"))
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", value_matches(F.col("text"), wanted).alias("hit"))


@query(over_inst("SELECT src_path, (48 * 64 - greatest(0, least(48, y0)) * 64)::BIGINT AS kept FROM inst"))
def pixels_mask_apply(spark, sf_dir):
    """Frames of 48 x 64 bytes, all ones, with the rows above y0 masked; counted again from the masked bytes."""
    frame = F.lit(bytes([1]) * (48 * 64))
    boxes = F.array(R.box(0, 0, 0, 64, F.greatest(F.lit(0), F.col("y0"))))
    rows = inst(spark, sf_dir).select("src_path", F.lit(48).alias("n_rows"), F.lit(64).alias("n_cols"), boxes.alias("boxes"), frame.alias("pixels"))
    return mask_frames(rows).select("src_path", count_kept(F.col("pixels")).alias("kept"))


_SMALL = 64, 48
_CLEAN = """FORMAT dicom
%filter graylist
LABEL Ultrasound by its regions
equals Modality US
coordinates all
keepcoordinates from:regions
%filter blacklist
LABEL Corner of one maker
contains Manufacturer philips
ctpcoordinates 0,0,10,5
"""
_TINY = """tiny AS (SELECT src_path, Modality, Manufacturer,
  CASE WHEN no_regions THEN [] ELSE list_filter([
    {'x0': 10, 'y0': greatest(0, least(47, y0)), 'x1': 44, 'y1': 18, 'ok': rsf IN (1, 2, 3)},
    {'x0': 0, 'y0': 20, 'x1': 63, 'y1': 47, 'ok': true}], lambda b: b.ok AND b.x1 - b.x0 >= 10 AND b.y1 - b.y0 >= 10) END AS u FROM inst),
sized AS (SELECT *, coalesce(list_sum(list_transform(u, lambda b: (b.x1 - b.x0) * (b.y1 - b.y0))), 0) AS inside FROM tiny)"""


@query(
    over_inst(
        "SELECT src_path, (CASE WHEN Modality = 'US' THEN inside - CASE WHEN coalesce(regexp_matches(Manufacturer, '(?i)philips'), false) THEN coalesce(list_sum(list_transform(u, lambda b: greatest(0, least(10, b.x1) - b.x0) * greatest(0, least(5, b.y1) - b.y0))), 0) ELSE 0 END "
        "WHEN coalesce(regexp_matches(Manufacturer, '(?i)philips'), false) THEN 48 * 64 - 50 ELSE 48 * 64 END)::BIGINT AS kept, ((Modality = 'US')::INT + coalesce(regexp_matches(Manufacturer, '(?i)philips'), false)::INT) AS labels FROM sized",
        _TINY,
    )
)
def pixels_clean_recipe(spark, sf_dir):
    """From the recipe to masked pixels: labels match, their boxes (literal, `all`, `from:` a field) paint in order, frames are masked and counted again."""
    width, height = _SMALL
    region = lambda rsf, x0, y0, x1, y1: F.struct(*[c.cast("int").alias(n) for n, c in (("rsf", rsf), ("rdt", F.lit(1)), ("x0", x0), ("y0", y0), ("x1", x1), ("y1", y1))])
    both = F.array(region(F.col("rsf"), F.lit(10), F.col("y0"), F.lit(44), F.lit(18)), region(F.lit(2), F.lit(-136), F.lit(20), F.lit(114), F.lit(88)))
    rows = inst(spark, sf_dir).select(
        "src_path", "Modality", "Manufacturer", F.lit(height).alias("n_rows"), F.lit(width).alias("n_cols"),
        F.when(F.col("no_regions"), F.slice(both, 1, 0)).otherwise(both).alias("regions"), F.lit(bytes([1]) * (width * height)).alias("pixels"),
    )
    done = batch.clean_frames(rows, Recipe.parse(_CLEAN))
    return done.select("src_path", count_kept(F.col("pixels")).alias("kept"), F.size("findings").alias("labels"))


@query(over_inst(f"SELECT src_path, concat_ws(';', '0:' || concat_ws(',', 0, 0, n_cols, n_rows), nullif(array_to_string(['1:' || concat_ws(',', b.x0, b.y0, b.x1, b.y1) FOR b IN {_BOXES}], ';'), '')) AS boxes FROM inst"))
def box_from_field(spark, sf_dir):
    """A label's `coordinates all` and `keepcoordinates from:regions`, resolved for each record."""
    found = R.label_boxes(_label("graylist", "Two lines"), lambda n: F.col(n), F.col("n_cols"), F.col("n_rows"))
    return inst(spark, sf_dir).select("src_path", F.array_join(F.transform(found, lambda b: F.concat_ws(":", b["keep"], F.concat_ws(",", b["x0"], b["y0"], b["x1"], b["y1"]))), ";").alias("boxes"))


def _streamed(spark, stream, key):
    """Runs a stream to its end into a table of the shared folder, and reads that."""
    root = f"{shared_dir(spark)}/stream-{uuid.uuid4().hex}"
    run_available(first_only(stream, key), f"{root}/checkpoint", append_first(f"{root}/out", key))
    return spark.read.parquet(f"{root}/out").drop("batch")


@query("SELECT o_orderkey, '' AS o_orderpriority, strftime(o_orderdate::DATE + 3, '%Y%m%d') AS StudyDate FROM orders")
def stream_header_rewrite(spark, sf_dir):
    """A compiled recipe on a file stream of orders."""
    orders = stream_table(spark, f"{sf_dir}/orders.parquet").select("o_orderkey", "o_orderpriority", F.date_format("o_orderdate", "yyyyMMdd").alias("StudyDate"))
    engine = _engine("BLANK o_orderpriority\nJITTER StudyDate 3\n")
    out = rewrite(orders, engine, [Field("o_orderpriority"), Field("StudyDate", "00080020", "DA")])
    return _streamed(spark, out, "o_orderkey")


@query("SELECT date_trunc('hour', ts) AS start, event_type, count(*) AS n FROM events GROUP BY ALL")
def audit_window(spark, sf_dir):
    """The windowed audit as a batch over the same function; a stream adds the watermark's delay only."""
    return audit_counts(table(spark, sf_dir, "events")).withColumn("start", F.col("start").cast("timestamp_ntz"))


@query("SELECT date_trunc('hour', ts) AS start, event_type, count(*) AS n FROM events GROUP BY ALL")
def stream_audit_window(spark, sf_dir):
    """Hourly windows of the event stream; those still open when it ends are there with what they have."""
    events = stream_table(spark, f"{sf_dir}/events.parquet").withColumn("ts", F.col("ts").cast("timestamp"))
    root = f"{shared_dir(spark)}/stream-{uuid.uuid4().hex}"
    run_available(audit_counts(events), f"{root}/checkpoint", latest(f"{root}/out"), mode="update")
    return read_latest(spark, f"{root}/out", "start", "event_type").withColumn("start", F.col("start").cast("timestamp_ntz"))
