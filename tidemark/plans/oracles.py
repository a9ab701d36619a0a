"""The registered queries again as SQL for DuckDB, written apart from the Spark code."""

from __future__ import annotations

from tidemark.functions.text import WHITE_SPACE
from tidemark.sources import words

NAMESPACE_HEX = "a1b2c3d4e5f67890abcdef1234567890"
BATCH = 500


def key_of(number: str) -> str:
    """Version 5 UUID of an integer expression."""
    digest = f"sha1(from_hex('{NAMESPACE_HEX}') || encode(({number})::VARCHAR))"
    return (
        f"(substr({digest}, 1, 8) || '-' || substr({digest}, 9, 4) || '-5' || "
        f"substr({digest}, 14, 3) || '-' || "
        f"translate(substr({digest}, 17, 1), '0123456789abcdef', '89ab89ab89ab89ab') || "
        f"substr({digest}, 18, 3) || '-' || substr({digest}, 21, 12))"
    )


WS = "'" + WHITE_SPACE + "'"

PERSON = f"""
person AS (
  SELECT c_custkey AS id,
         CASE WHEN c_acctbal < 0 THEN '  ' ELSE split_part(c_name, '#', 1) END AS "first",
         CASE WHEN c_acctbal < 0 THEN NULL ELSE split_part(c_name, '#', 2) END AS "last",
         lower(c_mktsegment) || '.' || c_custkey || '@email.com' AS email,
         c_mktsegment AS segment, c_nationkey AS nation, c_acctbal AS balance
  FROM customer),
merged AS (
  SELECT *, trim(concat_ws(' ', trim("first", {WS}), trim("last", {WS})), {WS}) AS full_name
  FROM person),
checked AS (
  SELECT *, CASE WHEN full_name = '' THEN
    'transform id=' || id || ': full_name is empty (both first and last are blank)' END AS error
  FROM merged),
valid AS (
  SELECT id, {key_of('id')} AS person_uuid, substr(full_name, 1, 100) AS full_name,
         substr(email, 1, 100) AS email, segment AS market_segment, nation AS nation_id, balance
  FROM checked WHERE error IS NULL),
moved AS (SELECT * FROM valid WHERE market_segment = 'BUILDING'),
half AS (
  SELECT min(id) + (max(id) - min(id)) // 4 AS a, max(id) - (max(id) - min(id)) // 4 AS b
  FROM person)
"""

# The third of the key range that an id lies in.
BOUNDS = "(SELECT min(id) AS lo, max(id) AS hi FROM person)"
THIRD = "CASE WHEN id <= lo + (hi - lo) // 3 THEN 1 WHEN id <= lo + (hi - lo) * 2 // 3 THEN 2 ELSE 3 END"

TARGET = "person_uuid, full_name, email, market_segment, nation_id, balance"

LEDGER = """
ledger AS (
  SELECT user_id AS job_id, event_id AS seq, ts AS "at", value, props,
         CASE WHEN event_type = 'purchase' AND event_id % 4 = 0 THEN 'rolled_back'
           WHEN event_type = 'signup' THEN 'pending' WHEN event_type = 'view' THEN 'running'
           WHEN event_type = 'click' THEN 'paused' WHEN event_type = 'purchase' THEN 'completed'
           WHEN event_type = 'error' THEN 'failed' END AS status
  FROM events),
runs AS (
  SELECT job_id AS pair, seq AS run, status, "at" AS created_at,
         CAST(json_extract(props, '$.k') AS BIGINT) AS last_id, value < 10 AS dry_run
  FROM ledger),
state AS (
  SELECT job_id, arg_max(status, seq) AS status, count(*) AS n_events, max(seq) AS last_seq,
         min("at") AS created_at, max("at") AS updated_at
  FROM ledger GROUP BY job_id)
"""

LINES = f"""
lines AS (
  SELECT {key_of('l_orderkey')} AS order_uuid, l_orderkey, l_linenumber, l_partkey, l_suppkey,
         l_quantity, l_extendedprice
  FROM lineitem),
moved AS (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F')
"""

BATCHED = f"""
batched AS (
  SELECT id, error, (row_number() OVER (ORDER BY id) - 1) // {BATCH} AS batch_no FROM checked),
metrics AS (
  SELECT batch_no, count(*) AS processed, count_if(error IS NULL)::BIGINT AS valid,
         count(error) AS rejected, min(id) AS first_id, max(id) AS last_id
  FROM batched GROUP BY batch_no)
"""

ORDER_BATCHES = f"""
batched AS (
  SELECT o_orderkey, o_custkey, (row_number() OVER (ORDER BY o_orderkey) - 1) // {BATCH} AS batch_no
  FROM orders)
"""


def entry_of(values: list[str], number: str) -> str:
    """Look-up by position as a CASE over the remainder."""
    cases = " ".join(f"WHEN {i} THEN '{v}'" for i, v in enumerate(values))
    return f"CASE ({number}) % {len(values)} {cases} END"


def phone(number: str, operators: int, shift: int = 0, digits_shift: int = 0) -> str:
    return (
        f"concat('08', ({number} + {shift}) % {operators} + 1, "
        f"lpad((({number} + {digits_shift}) % 9000000 + 1000000)::VARCHAR, 8, '0'))"
    )


def day(start: str, number: str) -> str:
    return f"CAST(DATE '{start}' + to_days(({number})::INTEGER) AS DATE)"


def patients(number: str) -> str:
    n = number
    first = entry_of(words.PATIENT_FIRST, n)
    return f"""
      {n} AS id_pasien, {first} AS nama_depan, {entry_of(words.SURNAMES, n)} AS nama_belakang,
      {day('1940-01-01', f'{n} % 30000')} AS tanggal_lahir,
      CASE {n} % 2 WHEN 0 THEN 'Laki-laki' ELSE 'Perempuan' END AS jenis_kelamin,
      concat(lower({first}), '.', {n}, '@email.com') AS email,
      {phone(n, 3)} AS no_telepon,
      concat('Jl. ', {entry_of(words.STREETS, n)}, ' No. ', {n} % 200 + 1, ', RT.',
             lpad(({n} % 20 + 1)::VARCHAR, 3, '0'), '/RW.', lpad(({n} % 15 + 1)::VARCHAR, 3, '0')
      ) AS alamat,
      {entry_of(words.CITIES, n)} AS kota, {entry_of(words.PROVINCES, n)} AS provinsi,
      lpad(({n} % 99999 + 10000)::VARCHAR, 5, '0') AS kode_pos,
      {entry_of(words.BLOOD_GROUPS, n)} AS golongan_darah,
      concat({entry_of(words.CONTACT_FIRST, f'{n} + 7')}, ' ',
             {entry_of(words.SURNAMES[:20], f'{n} + 13')}) AS kontak_darurat,
      {phone(n, 3, 5000, 3000)} AS no_kontak_darurat,
      {day('2010-01-01', f'{n} % 5475')} AS tanggal_registrasi
    """


def doctors(number: str) -> str:
    n = number
    first = entry_of(words.DOCTOR_FIRST, n)
    return f"""
      {n} AS id_dokter, {first} AS nama_depan, {entry_of(words.SURNAMES[:25], n)} AS nama_belakang,
      {entry_of(words.SPECIALTIES, n)} AS spesialisasi,
      concat('dr.', lower({first}), {n}, '@rumahsakit.co.id') AS email,
      {phone(n, 2)} AS no_telepon, concat('SIP/', lpad({n}::VARCHAR, 8, '0'), '/2024') AS no_sip,
      ({n} % 35 + 1)::INTEGER AS tahun_pengalaman, {entry_of(words.DEPARTMENTS, n)} AS departemen,
      {day('2000-01-01', f'{n} % 9125')} AS tanggal_bergabung
    """


ORDER_MIDDLE = "(SELECT (min(o_orderkey) + max(o_orderkey)) // 2 FROM orders)"

ORACLES = {
    "snapshot_scan": "SELECT c_custkey, c_name, c_mktsegment FROM customer",
    "incremental_extract": f"SELECT * FROM orders WHERE o_orderkey > {ORDER_MIDDLE}",
    "remaining_count": f"""
        SELECT count(o_orderkey) AS remaining FROM orders WHERE o_orderkey > {ORDER_MIDDLE}""",
    "range_filter_count": """
        WITH half AS (
          SELECT min(o_orderkey) + (max(o_orderkey) - min(o_orderkey)) // 4 AS a,
                 max(o_orderkey) - (max(o_orderkey) - min(o_orderkey)) // 4 AS b FROM orders)
        SELECT count(*) AS n_rows FROM orders, half WHERE o_orderkey BETWEEN a AND b""",
    "table_counts": """
        SELECT 'customers' AS info, count(*) AS n_rows, count(c_custkey) AS n_keys FROM customer
        UNION ALL SELECT 'suppliers', count(*), count(s_suppkey) FROM supplier""",
    "batch_assign": f"WITH {ORDER_BATCHES} SELECT * FROM batched",
    "nth_batch": f"WITH {ORDER_BATCHES} SELECT o_orderkey, o_custkey FROM batched WHERE batch_no = 3",
    "batch_metrics": f"WITH {PERSON}, {BATCHED} SELECT * FROM metrics",
    "progress_fold": f"""
        WITH {PERSON}, {BATCHED}
        SELECT count(*) AS batches, sum(processed)::BIGINT AS processed, sum(valid)::BIGINT AS valid,
               sum(rejected)::BIGINT AS rejected, min(first_id) AS first_id, max(last_id) AS last_id
        FROM metrics""",
    "progress_percentage": f"""
        WITH {PERSON}, {BATCHED}, running AS (
          SELECT batch_no, (sum(processed) OVER (ORDER BY batch_no))::BIGINT AS processed,
                 (SELECT count(*) FROM person) AS total FROM metrics)
        SELECT *, processed / total * 100 AS percentage FROM running""",
    "surrogate_key": f"SELECT o_orderkey, {key_of('o_orderkey')} AS order_uuid FROM orders",
    "uuid_is_valid": f"""
        WITH {PERSON}, keys AS (SELECT id, balance, {key_of('id')} AS k FROM person), given AS (
          SELECT id, CASE WHEN balance < 0 THEN substr(k, 1, 13) || substr(k, 15) ELSE k END AS key
          FROM keys)
        SELECT id, key, regexp_full_match(
          key, '[0-9a-f]{{8}}-[0-9a-f]{{4}}-[0-9a-f]{{4}}-[0-9a-f]{{4}}-[0-9a-f]{{12}}') AS is_valid
        FROM given""",
    "random_job_ids": """
        SELECT count(*) AS jobs, count(*) AS distinct_ids, count(*) AS valid_ids FROM orders""",
    "merge_name": f"WITH {PERSON} SELECT id, full_name FROM merged",
    "transform_rename": f"""
        WITH {PERSON}
        SELECT id, substr(email, 1, 100) AS email, segment AS market_segment, nation AS nation_id,
               balance
        FROM person""",
    "valid_rows": f"WITH {PERSON} SELECT {TARGET} FROM valid",
    "rejected_rows": f"WITH {PERSON} SELECT id, error FROM checked WHERE error IS NOT NULL",
    "limit_rejects": """
        WITH checked AS (
          SELECT doc_id, CASE WHEN length(text) > 2000 THEN 'body holds more than 2000 characters'
                   WHEN length(lang) > 2 THEN 'language holds more than 2 characters'
                   WHEN coalesce(length(text) < 200, true) OR source IS NULL
                   THEN 'origin has no value' END AS problem
          FROM documents)
        SELECT doc_id AS id, 'transform doc_id=' || doc_id || ': ' || problem AS error
        FROM checked WHERE problem IS NOT NULL""",
    "surviving_source_rows": f"""
        WITH {PERSON} SELECT person.* FROM person
        WHERE id NOT IN (SELECT id FROM checked WHERE error IS NOT NULL)""",
    "truncate_text": """
        SELECT doc_id, substr(text, 1, 100) AS text_100, length(text)::INTEGER AS n_text
        FROM documents""",
    "trim_unicode": f"""
        WITH padded AS (
          SELECT doc_id, chr(160) || ' ' || chr(9) || text || ' ' || chr(10) || chr(12288) AS t
          FROM documents)
        SELECT doc_id, trim(t, {WS}) AS trimmed, length(t)::INTEGER AS n_before FROM padded""",
    "insert_if_absent": f"""
        WITH {LINES}, ranked AS (
          SELECT *, row_number() OVER (PARTITION BY order_uuid ORDER BY l_linenumber, l_partkey,
                 l_suppkey, l_quantity, l_extendedprice) AS rn FROM lines)
        SELECT order_uuid, l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity,
               l_extendedprice
        FROM ranked WHERE rn = 1 AND l_orderkey NOT IN (SELECT o_orderkey FROM moved)""",
    "load_counts": f"""
        WITH {LINES}, counts AS (
          SELECT count(*) AS staged,
                 count(DISTINCT l_orderkey) FILTER (
                   WHERE l_orderkey NOT IN (SELECT o_orderkey FROM moved)) AS inserted
          FROM lines)
        SELECT staged, inserted, staged - inserted AS skipped FROM counts""",
    "dry_run_counts": f"""
        WITH {PERSON} SELECT count(*) AS inserted, 0::BIGINT AS skipped FROM valid""",
    "replay_is_noop": f"""
        WITH {PERSON}, counts AS (
          SELECT (SELECT count(*) FROM valid) AS staged,
                 (SELECT count(*) FROM valid WHERE id NOT IN (SELECT id FROM moved)) AS fresh)
        SELECT 'first' AS run, staged, fresh AS inserted, staged - fresh AS skipped FROM counts
        UNION ALL SELECT 'second', staged, 0, staged FROM counts""",
    "resume_equivalence": f"WITH {PERSON} SELECT {TARGET} FROM valid",
    "rollback_remaining": f"""
        WITH {PERSON} SELECT {TARGET} FROM moved, half WHERE id NOT BETWEEN a AND b""",
    "rollback_deleted_count": f"""
        WITH {PERSON} SELECT count(*) AS deleted FROM moved, half WHERE id BETWEEN a AND b""",
    "validate_counts": f"""
        WITH {PERSON}, counts AS (
          SELECT (SELECT count(*) FROM person, half WHERE id BETWEEN a AND b) AS source_count,
                 (SELECT count(*) FROM valid, half WHERE id BETWEEN a AND b) AS target_count,
                 (SELECT count(error) FROM checked, half WHERE id BETWEEN a AND b) AS rejected)
        SELECT source_count, target_count, source_count - target_count AS missing,
               source_count = target_count AS is_consistent, rejected
        FROM counts""",
    "reconcile_rows": """
        WITH target AS (
          SELECT o_orderkey, o_totalprice + CASE WHEN o_orderkey % 1009 = 5 THEN 1.0 ELSE 0.0 END AS o_totalprice
          FROM orders WHERE o_orderkey % 997 <> 3
          UNION ALL
          SELECT -o_orderkey - 1, o_totalprice FROM orders WHERE o_orderkey % 1013 = 7)
        SELECT coalesce(s.o_orderkey, t.o_orderkey) AS row_key,
               CASE WHEN t.o_orderkey IS NULL THEN 'missing' WHEN s.o_orderkey IS NULL THEN 'extra'
                    ELSE 'changed' END AS difference
        FROM orders s FULL JOIN target t ON s.o_orderkey = t.o_orderkey
        WHERE s.o_orderkey IS NULL OR t.o_orderkey IS NULL OR s.o_totalprice <> t.o_totalprice""",
    "key_duplicates": """
        SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem
        GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""",
    "active_duplicates": """
        SELECT o_custkey, count(*) AS n FROM orders WHERE o_orderstatus IN ('O', 'P')
        GROUP BY o_custkey HAVING count(*) > 1""",
    "constraint_violations": """
        SELECT 'part' AS table_name, p_partkey AS row_id, 'p_name' AS column_name,
               'too long' AS problem, length(p_name)::INTEGER AS n_chars
        FROM part WHERE length(p_name) > 10
        UNION ALL SELECT 'part', p_partkey, 'p_brand', 'too long', length(p_brand)::INTEGER
        FROM part WHERE length(p_brand) > 7
        UNION ALL SELECT 'part', p_partkey, 'p_type', 'null', NULL::INTEGER FROM part WHERE p_type IS NULL
        UNION ALL SELECT 'documents', doc_id, 'text', 'too long', length(text)::INTEGER
        FROM documents WHERE length(text) > 2000
        UNION ALL SELECT 'documents', doc_id, 'lang', 'too long', length(lang)::INTEGER
        FROM documents WHERE length(lang) > 2
        UNION ALL SELECT 'documents', doc_id, 'source', 'null', NULL::INTEGER
        FROM documents WHERE coalesce(length(text) < 200, true) OR source IS NULL""",
    "ledger_latest_state": f"WITH {LEDGER} SELECT * FROM state",
    "ledger_status_times": f"""
        WITH {LEDGER}
        SELECT job_id, min("at") FILTER (WHERE status = 'running') AS first_started_at,
               max("at") FILTER (WHERE status = 'running') AS started_at,
               max("at") FILTER (WHERE status = 'completed') AS completed_at,
               max("at") FILTER (WHERE status = 'failed') AS failed_at,
               max("at") FILTER (WHERE status = 'rolled_back') AS rolled_back_at
        FROM ledger GROUP BY job_id""",
    "ledger_list_by_status": f"""
        WITH {LEDGER} SELECT * FROM state WHERE status = 'completed'
        ORDER BY created_at DESC, job_id""",
    "ledger_bad_transitions": f"""
        WITH {LEDGER}, changes AS (
          SELECT job_id, seq, status,
                 coalesce(lag(status) OVER (PARTITION BY job_id ORDER BY seq), 'none')
                   AS previous_status
          FROM ledger WHERE status IS NOT NULL)
        SELECT job_id, seq, previous_status, status FROM changes
        WHERE previous_status || '>' || status NOT IN (
          'none>pending', 'pending>running', 'running>paused', 'running>completed',
          'running>failed', 'paused>running', 'failed>running', 'paused>rolled_back',
          'completed>rolled_back', 'failed>rolled_back')""",
    "latest_completed": f"""
        WITH {LEDGER}
        SELECT pair, max(run) AS run, arg_max(created_at, run) AS created_at,
               arg_max(last_id, run) AS last_id
        FROM runs WHERE status = 'completed' GROUP BY pair""",
    "resume_point": f"""
        WITH {LEDGER}
        SELECT pair, arg_max(last_id, run) AS resume_after
        FROM runs WHERE status = 'completed' AND NOT dry_run GROUP BY pair""",
    "error_log_json": f"""
        WITH {PERSON}, {BATCHED}
        SELECT batch_no, to_json(list({{'id': id, 'error': error}} ORDER BY id))::VARCHAR AS errors,
               count(*) AS total
        FROM batched WHERE error IS NOT NULL GROUP BY batch_no""",
    "error_log_parse": f"""
        WITH {LEDGER} SELECT job_id, seq AS id, props AS error FROM ledger WHERE status = 'failed'""",
    "gen_series": """
        SELECT unnest(range((SELECT min(o_orderkey) FROM orders),
                            (SELECT max(o_orderkey) + 1 FROM orders))) AS n""",
    "gen_patients": f"SELECT {patients('o_orderkey')} FROM orders",
    "gen_doctors": f"SELECT {doctors('p_partkey')} FROM part",
    "gen_postcode": f"""
        WITH whole AS (SELECT o_orderkey, floor(o_totalprice)::BIGINT AS n FROM orders)
        SELECT o_orderkey, lpad((n % 99999 + 10000)::VARCHAR, 5, '0') AS kode_pos,
               {phone('n', 3)} AS telepon
        FROM whole""",
    "gen_dates": f"""
        SELECT o_orderkey, {day('1940-01-01', 'o_orderkey % 30000')} AS tanggal_lahir,
               {day('2010-01-01', 'o_orderkey % 5475')} AS tanggal_registrasi
        FROM orders""",
    "seed_growth_counts": """
        WITH counts AS (
          SELECT (SELECT count(c_custkey) FROM customer) AS before_count,
                 (SELECT count(DISTINCT o_orderkey) FROM orders
                  WHERE o_orderkey NOT IN (SELECT c_custkey FROM customer)) AS added)
        SELECT before_count, added, before_count + added AS after_count FROM counts""",
    "migrate_job": f"""
        WITH {PERSON}, counts AS (
          SELECT count(*) AS n, count(error) AS bad, min(id) AS a, max(id) AS b FROM checked)
        SELECT 'completed' AS status, dry_run, NULL::BIGINT AS start_after, n AS total_records,
               n AS processed, n - bad AS success, bad AS failed, 0::BIGINT AS skipped,
               a AS first_processed_id, b AS last_processed_id
        FROM counts, (VALUES (true), (false)) AS d(dry_run)
        UNION ALL SELECT 'completed', false, b, 0, 0, 0, 0, 0, NULL, NULL FROM counts""",
    "migrate_target": f"WITH {PERSON} SELECT {TARGET} FROM valid",
    "migrate_sliced": f"""
        WITH {PERSON}, ordered AS (
          SELECT id, error, row_number() OVER (ORDER BY id) AS n, (count(*) OVER () + 2) // 3 AS size
          FROM checked),
        states AS (
          SELECT status, count(*) AS processed, count(error) AS failed, min(id) AS a, max(id) AS b
          FROM ordered, (VALUES ('paused'), ('completed')) AS s(status)
          WHERE n <= size OR status = 'completed' GROUP BY status)
        SELECT status, (SELECT count(*) FROM person) AS total_records, processed,
               processed - failed AS success, failed, 0::BIGINT AS skipped,
               a AS first_processed_id, b AS last_processed_id
        FROM states""",
    "ensure_orders": """
        SELECT true AS seeded, false AS seeded_again, count(o_orderkey) AS n_rows FROM orders""",
    "target_ranges": f"""
        WITH {PERSON}, thirds AS (SELECT *, {THIRD} AS third FROM checked, {BOUNDS})
        SELECT min(id) AS first_id, max(id) AS last_id, count(*) - count(error) AS n_rows
        FROM thirds GROUP BY third""",
    "rollback_middle": f"""
        WITH {PERSON}, thirds AS (SELECT *, {THIRD} AS third FROM valid, {BOUNDS})
        SELECT {TARGET} FROM thirds WHERE third <> 2""",
    "slice_assign": f"""
        WITH numbered AS (
          SELECT o_custkey AS k, row_number() OVER (ORDER BY o_custkey) - 1 AS n FROM orders),
        slices AS (
          SELECT k, count(*) AS n_rows,
                 coalesce(min(n // {BATCH}) FILTER (WHERE n % {BATCH} = {BATCH - 1}), min(n // {BATCH})) AS slice_no
          FROM numbered GROUP BY k)
        SELECT slice_no, CAST(sum(n_rows) AS BIGINT) AS n_rows, min(k) AS first_id, max(k) AS last_id
        FROM slices GROUP BY slice_no""",
    "stream_stopped": f"""
        WITH {PERSON}
        SELECT status, count(*) AS processed, count(*) - count(error) AS success, count(error) AS failed,
               0::BIGINT AS bad_changes
        FROM checked, (VALUES ('paused'), ('completed')) AS s(status)
        WHERE id % 4 = 0 OR status = 'completed' GROUP BY status""",
    "stream_migrate": f"WITH {PERSON} SELECT {TARGET} FROM valid",
    "stream_by_file": f"""
        WITH {PERSON}
        SELECT 'completed' AS status, count(*) AS total_records, count(*) AS processed,
               count(error) AS failed, 100::DOUBLE AS percentage, 4::BIGINT AS loads
        FROM checked""",
}
