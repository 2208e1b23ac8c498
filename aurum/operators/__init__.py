"""DataFrame -> DataFrame operators.

* ``clean``   – key filters, trims, safe typing, code harmonisation, quality flags
* ``dedup``   – keep-latest per key, dedup statistics, skew-safe ordinals
* ``join``    – metadata x manifest join, reconciliation, unmatched ids, ledger lookup
* ``deid``    – surrogate keys, date generalisation, purge/order, Gold projections
* ``stats``   – cleaning stats, cohort summary, distributions, DQ and PHI audits
* ``headers`` – per-site header harmonisation, native ids and site-native views
"""
