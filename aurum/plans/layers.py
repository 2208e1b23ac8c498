"""Bronze -> Silver -> Gold compositions.

All are lazy. These wire the operators in the order the medallion defines; the
run driver in ``aurum.plans.run`` decides what is materialised and where.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from aurum.operators import clean, dedup, deid, join


def silver_metadata(bronze_metadata: DataFrame, **kw) -> DataFrame:
    return clean.clean_metadata(bronze_metadata, **kw)


def silver_manifest(bronze_manifest: DataFrame, **kw) -> DataFrame:
    return clean.clean_manifest(bronze_manifest, **kw)


def silver_latest(silver_meta: DataFrame, tiebreakers: Sequence[str] = ("encounter_id",),
                  key: str = "ssn", order_col: str = "scan_date") -> DataFrame:
    """One record per patient: the latest scan (NULL dates last)."""
    tb = [t for t in tiebreakers if t in silver_meta.columns]
    return dedup.keep_latest(silver_meta, key, order_col, tb)


def silver_joined(bronze_metadata: DataFrame, bronze_manifest: DataFrame,
                  tiebreakers: Sequence[str] = ("encounter_id",), key: str = "ssn") -> DataFrame:
    """Clean both sides, keep the latest record per patient, join imaging.

    The join is salted: a patient with very many scans is spread over several
    tasks by a sketch of the manifest's keys, and since the deduplicated side
    is dealt out anew by key and salt, adaptive execution can split both sides
    of the join further.
    """
    meta = silver_latest(silver_metadata(bronze_metadata), tiebreakers, key)
    return join.salted_join_manifest(meta, silver_manifest(bronze_manifest), key)


def gold_dataset(silver: DataFrame, salt: str | None = None,
                 extra_drop: Sequence[str] = ("encounter_id",), pointer_base: str | None = None) -> DataFrame:
    """Gold research dataset (de-identified, canonical column order)."""
    return deid.gold_research(silver, salt=salt, extra_drop=extra_drop, pointer_base=pointer_base)
