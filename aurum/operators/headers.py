"""Per-site header harmonisation and the site-native view.

Sites deliver the same facts under different headers. Inputs are read by
header (never by position), renamed to canonical names and unioned by name;
columns a site lacks become typed NULLs or caller-supplied defaults.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aurum import config
from aurum.operators.clean import fill_missing_columns
from aurum.operators.dedup import ordinal_within


def rename_headers(df: DataFrame, renames: Mapping[str, str] = config.HEADER_RENAMES) -> DataFrame:
    """Rename site headers to canonical names.

    Fails when two input columns would map to the same canonical name (for
    example a file carrying both ``cerner_id`` and ``epic_id``), rather than
    silently keeping one.
    """
    targets: dict[str, str] = {}
    for c in df.columns:
        t = renames.get(c, c)
        if t in targets and targets[t] != c:
            raise ValueError(f"columns {targets[t]!r} and {c!r} both map to {t!r}")
        targets[t] = c
    mapping = {c: renames[c] for c in df.columns if c in renames and renames[c] != c}
    return df.withColumnsRenamed(mapping) if mapping else df


def harmonize_headers(frames: Sequence[DataFrame], renames: Mapping[str, str] = config.HEADER_RENAMES,
                      defaults: Mapping[str, object] | None = None,
                      columns: Sequence[str] = config.CANONICAL_UPLOAD_COLUMNS) -> DataFrame:
    """Rename each site frame, union by name, fill absent columns, project
    the canonical columns (in order), and the corrupt-record column if a frame
    has one."""
    if not frames:
        raise ValueError("no input frames")
    out = None
    for f in frames:
        r = rename_headers(f, renames)
        out = r if out is None else out.unionByName(r, allowMissingColumns=True)
    fill = {c: None for c in columns}
    if defaults:
        fill.update(defaults)
    out = fill_missing_columns(out, fill)
    if defaults:
        # Defaults also replace NULLs in columns that only some sites carry.
        out = out.withColumns({c: F.coalesce(F.col(c), F.lit(v).cast(out.schema[c].dataType))
                               for c, v in defaults.items() if v is not None})
    kept = [c for c in (config.CORRUPT_COLUMN,) if c in out.columns and c not in columns]
    return out.select(*columns, *kept)


def native_ids(canonical: DataFrame, order_cols: Sequence[str] = ("ssn", "scan_date"),
               site_col: str = "site_location", width: int = 5,
               site_headers: Mapping[str, Mapping] = config.SITE_NATIVE_HEADERS) -> DataFrame:
    """Add ``native_id_column`` and an ordinal ``native_id`` (``C00000``,
    ``E00000``, ...) numbered 0.. per site in ``order_cols`` order.

    The ordinal is computed without gathering a site into one task, so a site
    holding most of the rows still spreads over the whole cluster.
    """
    site_u = F.upper(F.trim(F.col(site_col)))
    numbered = ordinal_within(canonical.withColumn("_site", site_u), order_cols=list(order_cols),
                              group_cols=["_site"], name="_ord")
    prefix = F.lit("E")
    id_col = F.lit("epic_id")
    for site, spec in site_headers.items():
        prefix = F.when(F.col("_site") == site, F.lit(spec["id_prefix"])).otherwise(prefix)
        id_col = F.when(F.col("_site") == site, F.lit(spec["id_column"])).otherwise(id_col)
    return numbered.withColumns({
        "native_id_column": id_col,
        "native_id": F.concat(prefix, F.format_string(f"%0{width}d", F.col("_ord"))),
    }).drop("_site", "_ord")


def site_native_view(canonical: DataFrame, site: str, order_cols: Sequence[str] = ("ssn", "scan_date"),
                     site_col: str = "site_location", width: int = 5,
                     site_headers: Mapping[str, Mapping] = config.SITE_NATIVE_HEADERS) -> DataFrame:
    """One site's rows under that site's native headers, led by its ordinal
    id column (``cerner_id = C00000..`` for CHOC, ``epic_id = E00000..``
    otherwise)."""
    spec = site_headers[site.upper()]
    one = canonical.where(F.upper(F.trim(F.col(site_col))) == site.upper())
    numbered = ordinal_within(one, order_cols=list(order_cols), name="_ord")
    renamed = numbered.withColumnsRenamed(dict(spec["renames"]))
    native_cols = [spec["renames"].get(c, c) for c in canonical.columns]
    ident = F.concat(F.lit(spec["id_prefix"]), F.format_string(f"%0{width}d", F.col("_ord")))
    return renamed.select(ident.alias(spec["id_column"]), *native_cols)
