"""Value functions: salted surrogates, date shifts, conversions and look-ups, as columns.

All but the big-integer UIDs stay in the JVM. The digest of a day offset is folded in
eight unrolled steps, because lambdas over its characters are several times slower.
"""

from __future__ import annotations

import hashlib
import os

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Share of the frame height added above the top region, by manufacturer and model.
BUFFERS = (
    ("ACUSON", "CYPRESS", 0.08),
    ("GE HEALTHCARE", "VIVID I", 0.05),
    ("GE ULTRASOUND", "VIVID T8", 0.05),
    ("GE VINGMED ULTRASOUND", "VIVID E9", 0.04),
    ("GE VINGMED ULTRASOUND", "VIVID E95", 0.03),
    ("GE VINGMED ULTRASOUND", "VIVID T9", 0.03),
    ("GE VINGMED ULTRASOUND", "VIVID7", 0.05),
    ("GEMS ULTRASOUND", "VIVID7", 0.06),
    ("GEMS ULTRASOUND", "VIVID I", 0.04),
    ("GEMS ULTRASOUND", "VIVID Q", 0.04),
    ("ACUSON", "SEQUOIA", 0.03),
)
#: Fixed value: prefix of derived unique ids.
UID_PREFIX = "2.25."
FLOAT_VRS = ("FL", "FD")
INT_VRS = ("SL", "SS", "SV", "UL", "US", "UV")
BINARY_VRS = ("OB", "OD", "OF", "OL", "OV", "OW", "UN")


def salt_from_environment() -> str:
    """The secret; a run without it must fail at once rather than give weak surrogates."""
    salt = os.environ.get("SECRET_SALT")
    if not salt:
        raise ValueError("SECRET_SALT is not set")
    return salt


def id_hash(value: Column, salt: str) -> Column:
    """Leading 16 hexadecimal digits of the salted digest."""
    return F.substring(F.sha2(F.concat(F.lit(salt), value).cast("binary"), 256), 1, 16)


def offset_digest(patient: Column, salt: str) -> Column:
    """What a patient's offset is folded from; make it a column where the offset is wanted for many dates."""
    return F.sha2(F.concat(F.lit(salt), F.lit("|"), patient).cast("binary"), 256)


def offset_of(digest: Column) -> Column:
    """Days in +-[1, 365] from a digest, which is read nine times."""
    rest = F.lit(0).cast("bigint")
    for i in range(8):
        rest = (rest * (1 << 32) + F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("bigint")) % 365
    odd = F.substring(digest, 64, 1).isin(*"13579bdf")
    return (F.when(odd, -1).otherwise(1) * (rest + 1)).cast("int")


def day_offset(patient: Column, salt: str) -> Column:
    """Days in +-[1, 365], the same for all dates of a patient."""
    return offset_of(offset_digest(patient, salt))


def parse_date(value: Column) -> Column:
    """yyyyMMdd or null; never throws."""
    return F.when(F.length(value) == 8, F.try_to_date(value, "yyyyMMdd"))


def shift_date(value: Column, days: Column) -> Column:
    """A DA value moved by so many days; null if it is no date."""
    return F.date_format(F.date_add(parse_date(value), days), "yyyyMMdd")


def shift_datetime(value: Column, days: Column) -> Column:
    """A DT value moved by so many days: six fraction digits always, the zone only if there was one."""
    parts = F.regexp_extract(value, r"^(\d{8})(\d{6})(?:\.(\d{1,6}))?([+-]\d{4})?$", 1)
    clock = F.regexp_extract(value, r"^(\d{8})(\d{6})(?:\.(\d{1,6}))?([+-]\d{4})?$", 2)
    part = F.regexp_extract(value, r"^(\d{8})(\d{6})(?:\.(\d{1,6}))?([+-]\d{4})?$", 3)
    zone = F.regexp_extract(value, r"^(\d{8})(\d{6})(?:\.(\d{1,6}))?([+-]\d{4})?$", 4)
    return F.concat(shift_date(parts, days), clock, F.lit("."), F.rpad(part, 6, "0"), zone)


def shift(value: Column, days: Column, vr: str | Column) -> Column:
    """Moved by VR (known, or a column): DA, DT, or for others the first of the formats that fits."""
    if isinstance(vr, Column):
        return F.when(vr == "DA", shift(value, days, "DA")).when(vr == "DT", shift(value, days, "DT")).otherwise(shift(value, days, ""))
    if vr == "DA":
        return shift_date(value, days)
    if vr == "DT":
        return shift_datetime(value, days)
    dashed = F.date_format(F.date_add(F.try_to_date(value, "yyyy-MM-dd"), days), "yyyyMMdd")
    return F.coalesce(shift_datetime(value, days), shift_date(value, days), dashed)


def birth_date_cap(birth: Column, days: Column, shifted_study: Column, years: int = 89) -> Column:
    """The shifted birth date, but no earlier than so many years before the (already shifted) study."""
    moved = F.date_add(parse_date(birth), days)
    # greatest() skips nulls: without a study date the shift alone holds.
    return F.when(moved.isNotNull(), F.date_format(F.greatest(moved, F.add_months(parse_date(shifted_study), -12 * years)), "yyyyMMdd"))


def _uid(value: str | None, salt: str, prefix: str) -> str | None:
    return None if value is None else (prefix + str(int.from_bytes(hashlib.sha512((value + salt).encode()).digest(), "big")))[:64]


def stable_uid(value: Column, salt: str = "", prefix: str = UID_PREFIX) -> Column:
    """A unique id from the decimal digits of a 512-bit digest, 64 characters at most."""

    @F.pandas_udf("string")
    def digits(values: pd.Series) -> pd.Series:
        known = {v: _uid(v, salt, prefix) for v in values.unique()}
        return values.map(known.get)

    return digits(value)


def stable_uids(values: Column, salt: str = "", prefix: str = UID_PREFIX) -> Column:
    """The same for an array: Python functions are not allowed inside a lambda."""

    @F.pandas_udf("array<string>")
    def digits(rows: pd.Series) -> pd.Series:
        return rows.map(lambda row: None if row is None else [_uid(v, salt, prefix) for v in row])

    return digits(values)


def random_uuid() -> Column:
    return F.uuid()


def suffixed_uuid(field: str | Column) -> Column:
    return F.concat(F.lower(field if isinstance(field, Column) else F.lit(field)), F.lit("-"), F.uuid())


def random_uid(root: str = "1.2.826") -> Column:
    """A random id under a root; built from two random longs."""
    digits = F.concat(F.abs(F.xxhash64(F.uuid())).cast("string"), F.abs(F.xxhash64(F.uuid())).cast("string"))
    return F.substring(F.concat(F.lit(root + "."), digits), 1, 64)


def convert(value: Column, vr: str | Column) -> Column:
    """A replacement as the field's VR takes it; what cannot be converted is blank, never the old value."""
    if isinstance(vr, Column):
        return F.when(vr.isin(*FLOAT_VRS), convert(value, "FL")).when(vr == "UV", convert(value, "UV")).when(vr.isin(*INT_VRS), convert(value, "SL")).otherwise(value)
    if vr in FLOAT_VRS:
        return F.coalesce(value.try_cast("double").cast("string"), F.lit(""))
    if vr in INT_VRS:
        return F.coalesce(value.try_cast("decimal(20,0)" if vr == "UV" else "bigint").cast("string"), F.lit(""))
    return value


def sanitize(value: Column, default: str = "UNKNOWN") -> Column:
    """A path part: blank becomes the default, slashes become underscores."""
    return F.translate(F.coalesce(F.nullif(F.trim(value), F.lit("")), F.lit(default)), "/\\", "__")


def safe_text(value: Column, default: str = "") -> Column:
    return F.coalesce(value.cast("string"), F.lit(default))


def as_int(value: Column) -> Column:
    """Whole number of a text, cut towards zero; null if it is none."""
    return F.trim(value).try_cast("double").try_cast("bigint")


def zero_pad(value: Column, width: int) -> Column:
    """At least so many digits; longer numbers stay whole."""
    return F.format_string(f"%0{width}d", value)


def distinct_sorted(values: Column) -> Column:
    """Distinct whole numbers in order, joined by commas."""
    return F.array_join(F.array_sort(F.array_distinct(F.filter(values, lambda x: x.isNotNull()))).cast("array<string>"), ",")


def buffer_share(manufacturer: Column, model: Column, override: float | None = None, table=BUFFERS, default: float = 0.0) -> Column:
    """Exact pair, then the manufacturer's wildcard, then the global one, then the default."""
    if override is not None:
        if not 0 <= override <= 1:
            raise ValueError("the override must be in [0, 1]")
        return F.lit(float(override))
    known = F.create_map(*[F.lit(x) for m, o, share in table for x in (f"{m}\n{o}", float(share))])
    norm = lambda x: F.upper(F.trim(F.coalesce(x, F.lit(""))))
    keys = (F.concat_ws("\n", norm(manufacturer), norm(model)), F.concat_ws("\n", norm(manufacturer), F.lit("*")), F.lit("*\n*"))
    return F.coalesce(*[F.try_element_at(known, k) for k in keys], F.lit(default))


def split_values(value: Column, by: str, min_length: int = 1) -> Column:
    """Parts of a value split at a literal, of a least length; null gives none."""
    quoted = "".join("\\" + c if not c.isalnum() and c != " " else c for c in by)
    parts = F.split(F.coalesce(value, F.lit("")), quoted)
    return F.filter(parts, lambda x: (F.length(x) >= min_length) & (x != ""))
