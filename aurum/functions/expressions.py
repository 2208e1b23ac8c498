"""Column expressions used by every layer.

All are built from ``pyspark.sql.functions`` so they stay inside whole-stage
codegen; none calls back into Python. Each takes column names or Columns and
returns a Column, so they compose freely in ``select``/``withColumns``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from aurum import config

# A decimal number as text: optional sign, integer digits, optional point and
# fraction digits (either part may be empty, but not without a point: ".5", "5.", ".").
_DECIMAL_TEXT = r"^[+-]?(?:[0-9]+(?:\.[0-9]*)?|\.[0-9]*)\z"
# What a non-ANSI string-to-number cast strips around a value: ASCII space and
# control characters (0x00-0x20 and 0x7F).
CAST_TRIM_CHARS = "".join(chr(c) for c in [*range(0x00, 0x21), 0x7F])


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def safe_int(c) -> Column:
    """Text -> int exactly as a non-ANSI cast reads it, but never throwing.

    Surrounding spaces/control characters are ignored; the value is the
    signed integer part (``"7.9"`` -> 7, ``"-.5"`` -> 0, ``"."`` -> 0), the
    fraction must be digits; exponents, suffixes and overflow give NULL.
    """
    t = F.btrim(_col(c).cast("string"), F.lit(CAST_TRIM_CHARS))
    # The integer part, with a zero in front of a bare sign or point.
    whole = F.substring_index(t, ".", 1)
    return F.when(t.rlike(_DECIMAL_TEXT), F.when(whole.isin("", "+", "-"), F.lit(0)).otherwise(whole.try_cast("int")))


def safe_date(c, fmt: str = "yyyy-MM-dd") -> Column:
    """Text -> date with ``fmt``; NULL for malformed or impossible dates.

    Same result as the non-ANSI ``to_date`` under the default (corrected)
    parser: the whole text must match ``fmt`` (``2026-2-3``, ``2026-02-30``
    and trailing text give NULL), and it never throws.
    """
    return F.try_to_date(_col(c), fmt)


def _normalised_code(c) -> Column:
    return F.lower(F.trim(_col(c)))


def code_is_blank(c) -> Column:
    """NULL, empty or only spaces (never NULL itself)."""
    return _col(c).isNull() | (F.trim(_col(c)) == "")


def code_is_negative(c, negatives=config.NEGATIVE_CODES) -> Column:
    return F.coalesce(_normalised_code(c).isin(list(negatives)), F.lit(False))


def code_is_positive(c, positives=config.POSITIVE_CODES) -> Column:
    return F.coalesce(_normalised_code(c).isin(list(positives)), F.lit(False))


def finding_label(c, negatives=config.NEGATIVE_CODES, positives=config.POSITIVE_CODES,
                  blank_label: str = config.LABEL_NEGATIVE) -> Column:
    """Three-way harmonised finding label for a vendor code column."""
    return (
        F.when(code_is_blank(c), F.lit(blank_label))
        .when(code_is_negative(c, negatives), F.lit(config.LABEL_NEGATIVE))
        .when(code_is_positive(c, positives), F.lit(config.LABEL_POSITIVE))
        .otherwise(F.lit(config.LABEL_PENDING))
    )


def finding_needs_review(c, negatives=config.NEGATIVE_CODES,
                         positives=config.POSITIVE_CODES) -> Column:
    """True when the code is outside the known vocabulary; never NULL."""
    return ~(code_is_blank(c) | code_is_negative(c, negatives) | code_is_positive(c, positives))


def finding_label_binary(c, positives=config.POSITIVE_CODES) -> Column:
    """Two-way label used by the upload preview: positive or not."""
    return F.when(code_is_positive(c, positives), F.lit(config.LABEL_POSITIVE)) \
        .otherwise(F.lit(config.LABEL_NEGATIVE))


def finding_needs_review_binary(c, recognised=config.BINARY_RECOGNISED_CODES) -> Column:
    """Preview review flag: lower-cased (untrimmed) code not in ``recognised``.

    A missing code counts as unrecognised, as it does in the preview.
    """
    return ~F.coalesce(F.lower(_col(c)).isin(list(recognised)), F.lit(False))


def surrogate_key(c, salt: str | None = None, hex_chars: int = 16) -> Column:
    """Deterministic pseudonym: first ``hex_chars`` of SHA-256 (NULL stays NULL).

    ``salt`` (a secret kept outside the data) defeats dictionary attacks on
    small identifier spaces; the default keeps parity with unsalted keys.
    """
    src = _col(c) if salt is None else F.concat(F.lit(salt), _col(c))
    return F.substring(F.sha2(src.cast("string"), 256), 1, hex_chars)


def uri_is_valid(c, prefix: str = "s3://") -> Column:
    """Case-sensitive scheme check; flags only, never filters."""
    return _col(c).startswith(prefix)


def title_case(c) -> Column:
    return F.initcap(F.trim(_col(c)))


def upper_trim(c) -> Column:
    return F.upper(F.trim(_col(c)))


def ehr_from_site(c, choc_vendor: str = "Cerner", other_vendor: str = "Epic") -> Column:
    return F.when(F.upper(_col(c)) == "CHOC", F.lit(choc_vendor)).otherwise(F.lit(other_vendor))


def hash_pointer(c, base: str) -> Column:
    """Stable opaque pointer ``<base>scan_<MD5[:8]>.dcm`` derived from a key."""
    return F.concat(F.lit(base), F.lit("scan_"),
                    F.upper(F.substring(F.md5(_col(c).cast("string")), 1, 8)), F.lit(".dcm"))


def confirmation_id(content, prefix: str = "TX-", hex_chars: int = 6) -> Column:
    """Upload confirmation id from payload bytes (or text): TX-<MD5[:6]>."""
    return F.concat(F.lit(prefix), F.upper(F.substring(F.md5(_col(content)), 1, hex_chars)))


def site_partition_key(c) -> Column:
    """Storage-safe site key: space -> '_', '/' -> '-'."""
    return F.translate(_col(c), " /", "_-")


def upload_stamp(c) -> Column:
    """``<name>_<YYYYMMDDTHHMMSSZ><ext>`` -> the timestamp text (or NULL)."""
    return F.nullif(F.regexp_extract(_col(c), config.UPLOAD_TS_PATTERN, 1), F.lit(""))


def upload_time(c) -> Column:
    """Upload instant encoded in a landed file name, as a UTC wall-clock
    ``timestamp_ntz``; NULL when the name carries no valid stamp."""
    # Built from its digits, so the result does not depend on the session
    # time zone (no DST gaps); impossible dates give NULL.
    stamp = upload_stamp(c)

    def part(start: int, length: int) -> Column:
        return F.substring(stamp, start, length).cast("int")

    return F.try_make_timestamp_ntz(part(1, 4), part(5, 2), part(7, 2), part(10, 2), part(12, 2),
                                    part(14, 2))


def upload_base_name(c) -> Column:
    """File name without the upload stamp and extension."""
    return F.regexp_replace(F.regexp_replace(_col(c), config.UPLOAD_TS_PATTERN, ""),
                            r"\.[^./]+$", "")


def landed_object_name(path_col) -> Column:
    """Name of the landed object a file belongs to: the last path segment
    carrying an upload stamp (a stamped file, or a stamped folder of part
    files, also as a ``key=<name>`` partition folder), else the file name."""
    p = _col(path_col)
    stamped = F.regexp_extract(p, r"([^/=]*_\d{8}T\d{6}Z[^/]*)(/[^/]*)?$", 1)
    return F.when(stamped != "", stamped).otherwise(file_name_of(p))


def file_name_of(path_col) -> Column:
    """Last path segment of a file URI."""
    return F.regexp_extract(_col(path_col), r"([^/]+)$", 1)


def uniform01(seed: int, stream: str, *cols) -> Column:
    """Deterministic pseudo-random number in [0, 1) from (seed, stream, cols).

    Uses the first 32 bits of an MD5 so the same value can be computed by any
    SQL engine; independent of partitioning and task retries.
    """
    key = F.concat_ws(":", F.lit(str(seed)), F.lit(stream), *[_col(c).cast("string") for c in cols])
    bits = F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("bigint")
    return bits / F.lit(4294967296.0)
