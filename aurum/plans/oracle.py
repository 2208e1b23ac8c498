"""Independent DuckDB SQL for each registered query.

Written directly against the benchmark views (``orders``, ``customer``,
``events``, ``documents``, ...). Shared CTEs rebuild the clinical fixture and
the Silver/Gold layers in plain SQL; each query then selects from them with
the same column names as the Spark result.
"""

from __future__ import annotations

# Spark semantics spelled out in DuckDB SQL.
_CAST_TRIM = "chr(0)" + "".join(f" || chr({c})" for c in [*range(0x01, 0x21), 0x7F])


def _safe_int(x: str) -> str:
    t = f"trim({x}, {_CAST_TRIM})"
    digits = f"regexp_extract({t}, '^[+-]?([0-9]*)', 1)"
    return (f"case when regexp_matches({t}, '^[+-]?[0-9]*(\\.[0-9]*)?$') and regexp_matches({t}, '[0-9.]') "
            f"then case when {digits} = '' then 0 "
            f"else try_cast(regexp_extract({t}, '^([+-]?)', 1) || {digits} as integer) end end")


def _safe_date(x: str) -> str:
    return (f"case when regexp_matches({x}, '^[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}$') "
            f"then cast(try_strptime({x}, '%Y-%m-%d') as date) end")


def _blank(x: str) -> str:
    return f"({x} is null or trim({x}) = '')"


def _neg(x: str) -> str:
    return f"coalesce(lower(trim({x})) in ('-1', 'na', 'n/a', 'none'), false)"


def _pos(x: str) -> str:
    return f"coalesce(lower(trim({x})) in ('1', 'positive'), false)"


def _label(x: str) -> str:
    return (f"case when {_blank(x)} then 'No Lesion Detected' when {_neg(x)} then 'No Lesion Detected' "
            f"when {_pos(x)} then 'Lesion Detected' else 'Pending Radiologist Review' end")


def _review(x: str) -> str:
    return f"(not ({_blank(x)} or {_neg(x)} or {_pos(x)}))"


def _initcap_word(x: str) -> str:
    return f"(upper(left(trim({x}), 1)) || lower(substr(trim({x}), 2)))"


def _u(stream: str, col: str, seed: int = 42) -> str:
    return f"(('0x' || substr(md5('{seed}:{stream}:' || cast({col} as varchar)), 1, 8))::bigint / 4294967296.0)"


FIXTURE_CTES = f"""
fx_metadata as (
  select case when o_orderkey % 97 = 0 then null
              else '999-' || cast(o_custkey % 90 + 10 as varchar) || '-' || printf('%06d', o_custkey) end as ssn,
         case when o_orderkey % 53 = 0 then 'unk' when o_orderkey % 59 = 0 then null
              else ' ' || cast(5 + o_custkey % 14 as varchar) end as age,
         case when o_orderkey % 20 < 11 then 'CHOC' when o_orderkey % 41 = 0 then null else ' Rady ' end as site_location,
         case when o_orderkey % 20 < 11 then 'Cerner' else 'Epic' end as ehr_system,
         case o_orderkey % 10 when 0 then '1' when 1 then '-1' when 2 then 'NA' when 3 then 'Positive '
              when 4 then null when 5 then '  ' when 6 then 'n/a' when 7 then 'POSITIVE' when 8 then 'None'
              else 'EQUIVOCAL' end as lesion_status_code,
         case when o_orderkey % 61 = 0 then '2026-13-40' when o_orderkey % 67 = 0 then null
              else cast(cast(o_orderdate as date) as varchar) end as scan_date,
         o_orderkey as encounter_id
  from orders),
fx_manifest as (
  select '999-' || cast(c_custkey % 90 + 10 as varchar) || '-' || printf('%06d', c_custkey) as ssn,
         case when c_custkey % 31 = 0 then null
              when c_custkey % 11 = 0 then 'http://host/' || cast(c_custkey as varchar) || '.dcm'
              else 's3://bucket/imaging/' || cast(c_custkey as varchar) || '_scan' || cast(k as varchar) || '.dcm'
         end as dicom_s3_uri,
         case when c_custkey % 3 = 0 then ' mri ' else 'Ct' end as modality,
         'BRAIN ' as body_region
  from (select c_custkey, unnest(case when c_custkey % 5 = 0 then [1, 2] else [1] end) as k
        from customer where c_custkey % 13 <> 0) s),
sm0 as (
  select trim(ssn) as ssn, {_safe_int('age')} as age, upper(trim(site_location)) as site_location,
         trim(ehr_system) as ehr_system, trim(lesion_status_code) as lesion_status_code,
         {_safe_date('trim(scan_date)')} as scan_date, encounter_id,
         {_label('lesion_status_code')} as lesion_label,
         {_review('lesion_status_code')} as lesion_code_requires_review
  from fx_metadata where ssn is not null),
smq as (select *, (age is null or scan_date is null) as has_data_quality_flag from sm0),
sl as (
  select * exclude (rn) from (
    select *, row_number() over (partition by ssn order by scan_date desc nulls last, encounter_id desc) as rn
    from smq) z where rn = 1),
sf as (
  select trim(ssn) as ssn, dicom_s3_uri, upper(trim(modality)) as modality,
         {_initcap_word('body_region')} as body_region,
         starts_with(dicom_s3_uri, 's3://') as uri_format_valid
  from fx_manifest where ssn is not null and dicom_s3_uri is not null),
sj as (
  select sl.*, sf.dicom_s3_uri as imaging_s3_uri, sf.modality, sf.body_region, sf.uri_format_valid
  from sl join sf on sl.ssn = sf.ssn),
g as (
  select substr(sha256(ssn), 1, 16) as subject_surrogate_id, age, site_location, ehr_system,
         cast(year(scan_date) as integer) as enrollment_year, lesion_label, lesion_code_requires_review,
         imaging_s3_uri, modality, body_region
  from sj),
synth0 as (
  select c_custkey as participant,
         '999-' || cast(cast(floor({_u('mid', 'c_custkey')} * 90) + 10 as integer) as varchar) || '-'
             || printf('%04d', c_custkey) as ssn,
         cast(cast(5 + floor({_u('age', 'c_custkey')} * 14) as integer) as varchar) as age,
         case when {_u('site', 'c_custkey')} < 0.55 then 'CHOC' else 'Rady' end as site_location,
         {_u('positive', 'c_custkey')} < 0.2 as pos,
         ('0x' || substr(md5('42:missing:' || cast(c_custkey as varchar)), 1, 8))::bigint as miss,
         cast(date '2026-01-01' + cast(floor({_u('date', 'c_custkey')} * 365) as integer) as varchar) as scan_date
  from customer),
synth as (
  select ssn, age, site_location,
         case when site_location = 'CHOC' then 'Cerner' else 'Epic' end as ehr_system,
         case when row_number() over (order by miss, participant) - 1
                   < (select cast(floor(count(*) * 0.05) as bigint) from customer) then null
              when site_location = 'CHOC' then case when pos then '1' else '-1' end
              else case when pos then 'Positive' else 'NA' end end as lesion_status_code,
         scan_date
  from synth0)
"""


def _q(body: str) -> str:
    return f"with {FIXTURE_CTES.strip()}\n{body.strip()}"


_GOLD_STRING_COLS = ["subject_surrogate_id", "site_location", "ehr_system", "lesion_label",
                     "imaging_s3_uri", "modality", "body_region"]
_GOLD_OTHER_COLS = ["age", "enrollment_year", "lesion_code_requires_review"]


def _phi_audit_sql() -> str:
    parts = [f"select '{c}' as column_name, false as forbidden_name, "
             f"count_if(regexp_matches({c}, '\\d{{3}}-\\d{{2}}-\\d{{4,}}'))::bigint as identifier_values from g"
             for c in _GOLD_STRING_COLS]
    parts += [f"select '{c}' as column_name, false as forbidden_name, 0::bigint as identifier_values"
              for c in _GOLD_OTHER_COLS]
    return "\nunion all\n".join(parts)


ORACLE: dict[str, str] = {
    "lineage_append": _q("""
        select *, '2026-06-23T13:18:04Z' as ingested_at, 'landing/metadata/fx_metadata.csv' as source_file,
               '2026-06-23' as pipeline_run_date from fx_metadata"""),
    "required_key_filter": _q("select * from fx_metadata where ssn is not null"),
    "trim_columns": _q("""
        select trim(ssn) as ssn, age, trim(site_location) as site_location, trim(ehr_system) as ehr_system,
               trim(lesion_status_code) as lesion_status_code, trim(scan_date) as scan_date, encounter_id
        from fx_metadata"""),
    "safe_int_cast": _q(f"select encounter_id, age as age_raw, {_safe_int('age')} as age from fx_metadata"),
    "safe_date_parse": _q(f"""
        select encounter_id, scan_date as scan_date_raw, {_safe_date('trim(scan_date)')} as scan_date
        from fx_metadata"""),
    "site_upper": _q("select encounter_id, upper(trim(site_location)) as site_location from fx_metadata"),
    "code_harmonize": _q(f"""
        select encounter_id, lesion_status_code, {_label('lesion_status_code')} as lesion_label
        from fx_metadata"""),
    "code_review_flag": _q(f"""
        select encounter_id, lesion_status_code, {_review('lesion_status_code')} as lesion_code_requires_review
        from fx_metadata"""),
    "code_harmonize_binary": _q(f"""
        select encounter_id, lesion_status_code,
               case when {_pos('lesion_status_code')} then 'Lesion Detected' else 'No Lesion Detected' end
                   as lesion_label,
               not coalesce(lower(lesion_status_code) in ('1', '-1', 'positive', 'none', 'na'), false)
                   as lesion_code_requires_review
        from fx_metadata"""),
    "quality_flag": _q("select encounter_id, age, scan_date, has_data_quality_flag from smq"),
    "silver_metadata": _q("select * from smq"),
    "manifest_clean": _q("""
        select ssn, dicom_s3_uri, upper(trim(modality)) as modality
        from fx_manifest where ssn is not null and dicom_s3_uri is not null"""),
    "silver_manifest": _q("select * from sf"),
    "initcap_region": _q(f"""
        select ssn, body_region as body_region_raw, {_initcap_word('body_region')} as body_region
        from fx_manifest"""),
    "uri_flag": _q("""
        select ssn, dicom_s3_uri, starts_with(dicom_s3_uri, 's3://') as uri_format_valid from fx_manifest"""),
    "derive_ehr": _q("""
        select encounter_id, site_location,
               case when upper(site_location) = 'CHOC' then 'Cerner' else 'Epic' end as ehr_system
        from smq"""),
    "hash_pointer": _q("""
        select ssn, 's3://imaging-pointers/imaging/scan_' || upper(substr(md5(ssn), 1, 8)) || '.dcm'
               as imaging_pointer from sl"""),
    "mask_key": _q("select encounter_id, substr(sha256(ssn), 1, 16) as subject_surrogate_id from smq"),
    "reduce_date": _q("select encounter_id, cast(year(scan_date) as integer) as enrollment_year from smq"),
    "column_purge": _q("""
        select ssn, age, site_location, ehr_system, scan_date, encounter_id, lesion_label,
               lesion_code_requires_review, imaging_s3_uri, modality, body_region from sj"""),
    "column_order": _q("""
        select substr(sha256(ssn), 1, 16) as subject_surrogate_id, age, site_location, ehr_system,
               cast(year(scan_date) as integer) as enrollment_year, lesion_label, lesion_code_requires_review,
               imaging_s3_uri, modality, body_region, lesion_status_code, encounter_id,
               has_data_quality_flag, uri_format_valid from sj"""),
    "gold_preview": _q("""
        select substr(sha256(ssn), 1, 16) as surrogate_id, age, ehr_system, site_location,
               cast(year(scan_date) as integer) as enrollment_year, lesion_label,
               's3://imaging-pointers/imaging/scan_' || upper(substr(md5(ssn), 1, 8)) || '.dcm' as s3_dicom_path
        from sl"""),
    "filter_flagged": _q("select * from g where lesion_code_requires_review"),
    "fill_missing_columns": _q("""
        select encounter_id, ssn, 'CHOC' as site_location, age, scan_date,
               cast(null as varchar) as raw_lesion_status from fx_metadata"""),
    "site_native_view": _q("""
        select 'C' || printf('%05d', row_number() over (order by encounter_id) - 1) as cerner_id,
               ssn, site_location, age, scan_date, lesion_status_code, encounter_id
        from fx_metadata where upper(trim(site_location)) = 'CHOC'"""),
    "confirmation_id": """
        select doc_id, 'TX-' || upper(substr(md5(text), 1, 6)) as tx_id from documents""",
    "dedup_latest": _q("select * from sl"),
    "dedup_latest_str": _q("""
        select * exclude (rn) from (
          select *, row_number() over (partition by ssn order by scan_date desc nulls last,
                                       encounter_id desc) as rn
          from fx_metadata) z where rn = 1"""),
    "silver_join": _q("""
        select m.*, f.dicom_s3_uri as imaging_s3_uri, f.modality, f.body_region, f.uri_format_valid
        from sl m join sf f on m.ssn = f.ssn"""),
    "silver_joined": _q("select * from sj"),
    "join_reconcile": _q("""
        select (select count(distinct ssn) from sl)::bigint as metadata_ids,
               (select count(distinct ssn) from sf)::bigint as manifest_ids,
               (select count(*) from sj)::bigint as joined_rows,
               greatest(0, least((select count(distinct ssn) from sl), (select count(distinct ssn) from sf))
                           - (select count(*) from sj))::bigint as unmatched_min_formula,
               (select count(distinct ssn) from sl
                 where not exists (select 1 from sf where sf.ssn = sl.ssn))::bigint as metadata_only_ids,
               (select count(distinct ssn) from sf
                 where not exists (select 1 from sl where sl.ssn = sf.ssn))::bigint as manifest_only_ids"""),
    "join_unmatched": _q("""
        select distinct ssn, 'metadata_only' as side from sl
          where not exists (select 1 from sf where sf.ssn = sl.ssn)
        union all
        select distinct ssn, 'manifest_only' as side from sf
          where not exists (select 1 from sl where sl.ssn = sf.ssn)"""),
    "preview_head": _q("select * from fx_metadata order by encounter_id limit 5"),
    "gold_research": _q("select * from g"),
    "clean_stats": _q("""
        select count(*) as total,
               count_if(lesion_label = 'Lesion Detected') as lesion,
               count_if(lesion_label = 'No Lesion Detected') as no_lesion,
               count_if(lesion_label = 'Pending Radiologist Review') as pending,
               count_if(lesion_code_requires_review) as review,
               count_if(has_data_quality_flag) as quality_flagged
        from smq"""),
    "cohort_summary": _q("""
        select site_location, lesion_label, count(subject_surrogate_id) as subject_count,
               avg(age) as mean_age, min(age) as min_age, max(age) as max_age,
               sum(cast(lesion_code_requires_review as integer))::bigint as flagged_for_review
        from g group by site_location, lesion_label order by site_location, lesion_label"""),
    "label_distribution": _q("""
        select lesion_label, count(*) as n,
               round(count(*)::double / sum(count(*)) over () * 100, 2) as pct
        from g group by lesion_label"""),
    "age_distribution": _q("""
        select site_location, count(*) as n, avg(age) as mean_age,
               round(stddev_samp(age), 6) as stddev_age, quantile_disc(age, 0.25) as p25_age,
               quantile_disc(age, 0.5) as median_age, quantile_disc(age, 0.75) as p75_age
        from g group by site_location order by site_location"""),
    "distinct_sites": _q("select distinct site_location from sj where site_location is not null"),
    "dedup_stats": _q("""
        select (select count(*) from smq) as rows_before, (select count(*) from sl) as rows_after,
               (select count(*) from smq) - (select count(*) from sl) as dropped"""),
    "invalid_uri_count": _q("select count(*) as rows, count_if(not uri_format_valid) as invalid_uri from sf"),
    "dq_audit": _q("""
        select site_location, lesion_status_code, count(*) as rows,
               count_if(lesion_code_requires_review) as review_rows,
               count_if(has_data_quality_flag) as quality_rows,
               count_if(age is null) as missing_age, count_if(scan_date is null) as missing_date
        from smq where lesion_code_requires_review or has_data_quality_flag
        group by site_location, lesion_status_code"""),
    "phi_audit": _q(_phi_audit_sql()),
    "dedup_latest_orders": """
        select * exclude (rn) from (
          select *, row_number() over (partition by o_custkey order by o_orderdate desc nulls last,
                                       o_orderkey desc) as rn
          from orders) z where rn = 1""",
    "mask_key_events": """
        select event_id, substr(sha256(cast(user_id as varchar)), 1, 16) as user_surrogate_id,
               cast(year(ts) as integer) as event_year from events""",
    "synth_metadata": _q("select * from synth"),
    "synth_manifest": _q("""
        select ssn, 's3://clinical-bronze/imaging/' || ssn || '_scan1.dcm' as dicom_s3_uri,
               'MRI' as modality, 'Brain' as body_region from synth"""),
    "source_profile": _q("""
        select rows, choc_rows, rady_rows, positive, missing, negative,
               round(positive::double / rows * 100, 2) as positive_pct,
               round(negative::double / rows * 100, 2) as negative_pct,
               round(missing::double / rows * 100, 2) as missing_pct
        from (select count(*) as rows, count_if(site_location = 'CHOC') as choc_rows,
                     count_if(site_location = 'Rady') as rady_rows,
                     count_if(lesion_status_code in ('1', 'Positive')) as positive,
                     count_if(lesion_status_code is null) as missing,
                     count(*) - count_if(lesion_status_code in ('1', 'Positive'))
                              - count_if(lesion_status_code is null) as negative
              from synth) t"""),
}

ORACLE["age_distribution_lineitem"] = """
    select l_returnflag, count(*) as n, avg(l_quantity) as mean_age,
           round(stddev_samp(l_quantity), 6) as stddev_age, quantile_disc(l_quantity, 0.25) as p25_age,
           quantile_disc(l_quantity, 0.5) as median_age, quantile_disc(l_quantity, 0.75) as p75_age
    from lineitem group by l_returnflag"""


def _csv_line(cols: list[str]) -> str:
    return "concat_ws(',', " + ", ".join(f"coalesce({c}, '')" for c in cols) + ")"


_RAW_META = ["ssn", "age", "site_location", "ehr_system", "lesion_status_code", "scan_date"]
_SITE_KEY = "replace(replace(site_location, ' ', '_'), '/', '-')"
_UPLOAD_TS = "_([0-9]{8}T[0-9]{6}Z)(\\.[^./]+)?$"

ORACLE.update({
    "bronze_csv_scan": _q("select * from fx_metadata"),
    "corrupt_audit": _q(f"""
        select ssn, age, site_location, ehr_system, lesion_status_code,
               case when encounter_id % 101 = 0 then null else scan_date end as scan_date,
               case when encounter_id % 101 = 0 then {_csv_line(_RAW_META[:-1])}
                    else {_csv_line(_RAW_META)} || ',extra' end as _corrupt_record
        from fx_metadata where encounter_id % 101 = 0 or encounter_id % 103 = 0"""),
    "ingest_row_count": _q("""
        select '2026-06-23' as pipeline_run_date, count(*) as rows,
               count_if(encounter_id % 101 = 0 or encounter_id % 103 = 0) as corrupt_rows
        from fx_metadata"""),
    "bronze_metadata": _q("""
        select ssn, age, site_location, ehr_system, lesion_status_code, scan_date, encounter_id,
               '2026-06-23T13:18:04Z' as ingested_at, '2026-06-23' as pipeline_run_date,
               true as source_is_csv, cast(null as varchar) as _corrupt_record
        from fx_metadata"""),
    "bronze_manifest": _q("""
        select ssn, dicom_s3_uri, modality, body_region,
               '2026-06-23T13:18:04Z' as ingested_at, '2026-06-23' as pipeline_run_date,
               true as source_is_csv, cast(null as varchar) as _corrupt_record
        from fx_manifest"""),
    "header_harmonize": _q("""
        , bad as (
          select encounter_id % 101 = 0 as short, coalesce(site_location = 'CHOC', false) as choc,
                 cast(encounter_id as varchar) as e
          from fx_metadata where encounter_id % 101 = 0 or encounter_id % 103 = 0)
        select ssn, site_location, age, scan_date, lesion_status_code as raw_lesion_status,
               cast(null as varchar) as _corrupt_record from fx_metadata
        union all
        select case when short then case when choc then null else e end when choc then 'c' else 'b' end,
               case when short then case when choc then null else 'short' end when choc then 'e' else 'a' end,
               case when short then null when choc then 'd' else 'c' end,
               case when short then case when choc then e end when choc then 'b' else 'd' end,
               case when short then case when choc then 'short' end when choc then 'a' else 'e' end,
               case when short then 'short,' || e else 'a,b,c,d,e,' || e end
        from bad"""),
    "bronze_roundtrip": ORACLE["lineage_append"],
    "bronze_partition_overwrite": _q("""
        select *, '2026-06-22' as pipeline_run_date from fx_metadata
        union all
        select *, '2026-06-23' as pipeline_run_date from fx_metadata"""),
    "silver_partition_export": _q(f"select *, {_SITE_KEY} as site_key from sj where site_location is not null"),
    "site_pruned_read": _q(f"""
        select *, {_SITE_KEY} as site_key from sj
        where site_location is not null and {_SITE_KEY} = 'CHOC'"""),
    "silver_roundtrip": _q("select * from sj"),
    "gold_ml_export": _q("""
        select subject_surrogate_id as surrogate_id, age, ehr_system, site_location, lesion_label,
               imaging_s3_uri as s3_dicom_path from g"""),
    "landing_scan": _q("select * from fx_metadata"),
    "newest_snapshot": _q("select * from fx_metadata where encounter_id % 2 = 1"),
    "landing_name_parts": f"""
        select o_orderkey, file_name,
               regexp_replace(regexp_replace(file_name, '{_UPLOAD_TS}', ''), '\\.[^./]+$', '') as base_name,
               cast(try_strptime(nullif(regexp_extract(file_name, '{_UPLOAD_TS}', 1), ''),
                                 '%Y%m%dT%H%M%SZ') as timestamp) as uploaded_at
        from (select o_orderkey,
                     case when o_orderkey % 7 = 0 then 'extract_' || cast(o_orderkey as varchar) || '.csv'
                          else 'extract_' || cast(o_orderkey as varchar) || '_'
                               || strftime(o_orderdate, '%Y%m%dT%H%M%SZ') || '.csv' end as file_name
              from orders) t""",
    "incremental_ingest": _q("""
        select ssn, age, site_location, ehr_system, lesion_status_code, scan_date, encounter_id,
               true as source_is_csv, cast(null as varchar) as _corrupt_record from fx_metadata"""),
    "run_metrics": _q(r"""
        select '2026-06-23T13:18:04Z' as run_timestamp, '2026-06-23' as pipeline_run_date,
               (select count(*) from fx_metadata) as bronze_metadata_rows,
               0::bigint as bronze_metadata_corrupt_rows,
               (select count(*) from fx_manifest) as bronze_manifest_rows,
               0::bigint as bronze_manifest_corrupt_rows,
               (select count(*) from smq) as silver_metadata_rows,
               (select count_if(lesion_label = 'Lesion Detected') from smq) as lesion_detected,
               (select count_if(lesion_label = 'No Lesion Detected') from smq) as no_lesion_detected,
               (select count_if(lesion_label = 'Pending Radiologist Review') from smq) as pending_review,
               (select count_if(lesion_code_requires_review) from smq) as review_flagged,
               (select count(*) from smq) - (select count(*) from sl) as dedup_dropped,
               (select count(*) from sf) as silver_manifest_rows,
               (select count_if(not uri_format_valid) from sf) as manifest_invalid_uri_rows,
               (select count(*) from sj) as silver_joined_rows,
               (select count(*) from sj where site_location is null) as silver_rows_without_site,
               (select count(distinct ssn) from sl) as metadata_ids,
               (select count(distinct ssn) from sf) as manifest_ids,
               greatest(0, least((select count(distinct ssn) from sl), (select count(distinct ssn) from sf))
                           - (select count(*) from sj))::bigint as silver_unmatched_count,
               (select count(distinct ssn) from sl
                 where not exists (select 1 from sf where sf.ssn = sl.ssn)) as metadata_only_ids,
               (select count(distinct ssn) from sf
                 where not exists (select 1 from sl where sl.ssn = sf.ssn)) as manifest_only_ids,
               (select count(*) from g) as gold_rows,
               (select count(*) from g where lesion_code_requires_review) as gold_flagged_for_review,
               (select count_if(regexp_matches(imaging_s3_uri, '\d{3}-\d{2}-\d{4,}'))
                  + count_if(regexp_matches(subject_surrogate_id, '\d{3}-\d{2}-\d{4,}'))
                  + count_if(regexp_matches(site_location, '\d{3}-\d{2}-\d{4,}'))
                  + count_if(regexp_matches(ehr_system, '\d{3}-\d{2}-\d{4,}'))
                  + count_if(regexp_matches(lesion_label, '\d{3}-\d{2}-\d{4,}'))
                  + count_if(regexp_matches(modality, '\d{3}-\d{2}-\d{4,}'))
                  + count_if(regexp_matches(body_region, '\d{3}-\d{2}-\d{4,}'))
                from g)::bigint as gold_identifier_values"""),
    "lineage_trace": _q("""
        , up0 as (select * from fx_metadata where site_location = 'CHOC' and encounter_id < 100000)
        select 'landed' as stage, ssn as record_key,
               md5(concat_ws('|', ssn, age, site_location, ehr_system, lesion_status_code, scan_date,
                             cast(encounter_id as varchar))) as payload_md5 from up0
        union all
        select 'bronze' as stage, ssn as record_key,
               md5(concat_ws('|', ssn, age, site_location, ehr_system, lesion_status_code, scan_date,
                             cast(encounter_id as varchar))) from up0
        union all
        select 'silver' as stage, ssn as record_key,
               md5(concat_ws('|', ssn, cast(age as varchar), site_location, cast(scan_date as varchar),
                             lesion_label, imaging_s3_uri)) from sj
          where ssn in (select trim(ssn) from up0 where ssn is not null)
        union all
        select 'gold' as stage, subject_surrogate_id as record_key,
               md5(concat_ws('|', subject_surrogate_id, cast(age as varchar), site_location,
                             cast(enrollment_year as varchar), lesion_label, imaging_s3_uri)) from g
          where subject_surrogate_id in (select substr(sha256(trim(ssn)), 1, 16) from up0
                                         where ssn is not null)"""),
})


_SYNTH_SJ = """
ssj as (
  select trim(s.ssn) as ssn, s.age::integer as age, upper(trim(s.site_location)) as site_location,
         s.scan_date::date as scan_date, s.lesion_status_code,
         's3://clinical-bronze/imaging/' || s.ssn || '_scan1.dcm' as imaging_s3_uri
  from synth s)"""


def _qs(body: str) -> str:
    return f"with {FIXTURE_CTES.strip()},{_SYNTH_SJ.strip()}\n{body.strip()}"


_SYNTH_GOLD_STRING = ["subject_surrogate_id", "site_location", "ehr_system", "lesion_label", "imaging_s3_uri",
                      "modality", "body_region"]

ORACLE.update({
    "phi_audit_synth": _qs("\nunion all\n".join(
        [f"select '{c}' as column_name, false as forbidden_name, "
         f"{'(select count(*) from ssj)' if c == 'imaging_s3_uri' else '0'}::bigint as identifier_values"
         for c in _SYNTH_GOLD_STRING]
        + [f"select '{c}' as column_name, false as forbidden_name, 0::bigint as identifier_values"
           for c in ("age", "enrollment_year", "lesion_code_requires_review")])),
    "phi_key_leak": _qs("select count_if(contains(imaging_s3_uri, ssn)) as imaging_s3_uri_contains_key from ssj"),
    "phi_raw_keys": _qs(r"""
        select 'imaging_s3_uri' as column_name, count(distinct t.token) as leaked_keys, count(*) as leaked_values
        from (select unnest(regexp_extract_all(imaging_s3_uri, '\d{3}-\d{2}-\d{4,}')) as token from ssj) t
        where t.token in (select trim(ssn) from ssj) having count(*) > 0"""),
    "gold_pointer_rewrite": _qs(f"""
        select substr(sha256(ssn), 1, 16) as subject_surrogate_id, age, site_location,
               case when site_location = 'CHOC' then 'Cerner' else 'Epic' end as ehr_system,
               cast(year(scan_date) as integer) as enrollment_year,
               {_label('lesion_status_code')} as lesion_label,
               {_review('lesion_status_code')} as lesion_code_requires_review,
               's3://imaging-pointers/imaging/scan_' || upper(substr(md5(ssn), 1, 8)) || '.dcm' as imaging_s3_uri,
               'MRI' as modality, 'Brain' as body_region
        from ssj"""),
    "output_locations": _q("""
        select 'bronze' as layer, 'metadata' as name, 'bronze_metadata' as folder, '2026-06-23' as partition,
               count(*) as rows, true as has_bytes from fx_metadata
        union all
        select 'silver', 'clinical_imaging_joined', 'silver', replace(replace(site_location, ' ', '_'), '/', '-') as k,
               count(*), true
        from sj where site_location is not null group by k
        union all
        select 'gold', 'research_dataset', 'gold_research', null, count(*), true from g"""),
    "cohort_summary_export": ORACLE["cohort_summary"],
    "required_columns": _q("select count(*) as rows, 'required columns missing from Silver dataset' as error from sj"),
})


ORACLE["synth_run_metrics"] = _q(rf"""
    select '2026-06-23T13:18:04Z' as run_timestamp, '2026-06-23' as pipeline_run_date,
           count(*) as bronze_metadata_rows, 0::bigint as bronze_metadata_corrupt_rows,
           count(*) as bronze_manifest_rows, 0::bigint as bronze_manifest_corrupt_rows,
           count(*) as silver_metadata_rows,
           count_if({_label('lesion_status_code')} = 'Lesion Detected') as lesion_detected,
           count_if({_label('lesion_status_code')} = 'No Lesion Detected') as no_lesion_detected,
           count_if({_label('lesion_status_code')} = 'Pending Radiologist Review') as pending_review,
           count_if({_review('lesion_status_code')}) as review_flagged,
           0::bigint as dedup_dropped,
           count(*) as silver_manifest_rows, 0::bigint as manifest_invalid_uri_rows,
           count(*) as silver_joined_rows, 0::bigint as silver_rows_without_site,
           count(distinct ssn) as metadata_ids, count(distinct ssn) as manifest_ids,
           0::bigint as silver_unmatched_count, 0::bigint as metadata_only_ids, 0::bigint as manifest_only_ids,
           count(*) as gold_rows,
           count_if({_review('lesion_status_code')}) as gold_flagged_for_review,
           count_if(regexp_matches('s3://clinical-bronze/imaging/' || ssn || '_scan1.dcm',
                                   '\d{{3}}-\d{{2}}-\d{{4,}}')) as gold_identifier_values
    from synth""")



def _bigint_count_if(sql: str) -> str:
    """Wrap every ``count_if(...)`` in a BIGINT cast (DuckDB may widen it to
    HUGEINT, Spark returns BIGINT)."""
    out, i = [], 0
    while True:
        j = sql.find("count_if(", i)
        if j < 0:
            out.append(sql[i:])
            return "".join(out)
        depth, k = 0, j + len("count_if")
        while True:
            if sql[k] == "(":
                depth += 1
            elif sql[k] == ")":
                depth -= 1
                if depth == 0:
                    break
            k += 1
        out.append(sql[i:j])
        out.append(f"cast({sql[j:k + 1]} as bigint)")
        i = k + 1


ORACLE["dedup_incremental"] = ORACLE["dedup_latest"]
ORACLE["dedup_bucketed"] = ORACLE["dedup_incremental"]
ORACLE["gold_incremental"] = ORACLE["gold_research"]
ORACLE["gold_two_dialects"] = ORACLE["gold_research"]
ORACLE["gold_streaming"] = ORACLE["gold_research"]
ORACLE["registered_gold"] = ORACLE["gold_research"]
ORACLE["newest_run_metrics"] = ORACLE["run_metrics"]

ORACLE = {k: _bigint_count_if(v) for k, v in ORACLE.items()}


_META_LINE = ("concat_ws(',', coalesce(ssn, ''), coalesce(age, ''), coalesce(site_location, ''), "
              "coalesce(ehr_system, ''), coalesce(lesion_status_code, ''), coalesce(scan_date, ''), "
              "cast(encounter_id as varchar))")
_MAN_LINE = ("concat_ws(',', coalesce(ssn, ''), coalesce(dicom_s3_uri, ''), coalesce(modality, ''), "
             "coalesce(body_region, ''))")
_META_HDR = "ssn,age,site_location,ehr_system,lesion_status_code,scan_date,encounter_id"
_MAN_HDR = "ssn,dicom_s3_uri,modality,body_region"

_BUCKET = "printf('%04d', ({k}) // 100000)"

_UPLOADS = f"""
meta_up as (
  select case when site_location = 'CHOC' then 'choc' else 'rady' end as site,
         {_BUCKET.format(k="encounter_id")} as b, {_META_LINE} as line
  from fx_metadata),
man_up as (
  select {_BUCKET.format(k="cast(split_part(ssn, '-', 3) as bigint)")} as b, {_MAN_LINE} as line
  from fx_manifest),
uploads as (
  select site || '_extract_' || b || '_20260623T131804Z.csv' as file_name,
         case when site = 'choc' then 'CHOC' else 'Rady' end as affiliation,
         'Clinical Metadata Extract' as dataset_type, 'metadata' as object_prefix,
         '{_META_HDR}' || chr(10) || string_agg(line, chr(10) order by line) || chr(10) as body
  from meta_up group by site, b
  union all
  select 'dicom_manifest_' || b || '_20260623T131804Z.csv', 'Rady', 'DICOM Imaging Manifest', 'dicom',
         '{_MAN_HDR}' || chr(10) || string_agg(line, chr(10) order by line) || chr(10)
  from man_up group by b),
ledger as (
  select 'TX-' || upper(substr(md5(body), 1, 6)) as tx_id, md5(body) as content_md5,
         'Site coordinator' as submitter, affiliation, dataset_type, object_prefix,
         timestamp '2026-06-23 13:18:04' as uploaded_at, file_name, strlen(body) as bytes
  from uploads)"""


def _ql(body: str) -> str:
    return f"with {FIXTURE_CTES.strip()},{_UPLOADS.strip()}\n{body.strip()}"


ORACLE.update({
    "landing_ledger": _ql("""
        select tx_id, content_md5, submitter, affiliation, dataset_type, object_prefix, uploaded_at, file_name
        from ledger"""),
    "landing_catalog": _ql("""
        select file_name as object_name, submitter, affiliation, round(bytes / 1024, 2) as size_kb from ledger"""),
    "ledger_lookup": _ql("""
        select tx_id as requested_id, tx_id, true as found, file_name, affiliation from ledger
        union all
        select 'TX-UNKNOWN-' || l.tx_id as requested_id, d.tx_id, false as found, d.file_name, d.affiliation
        from ledger l, (select * from ledger where tx_id = (select min(tx_id) from ledger
                                                            where object_prefix = 'metadata')) d"""),
})
ORACLE["run_ledger"] = ORACLE["landing_ledger"]
