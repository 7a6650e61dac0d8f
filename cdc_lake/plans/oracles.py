"""The registered queries as plain SQL over the same tables, written independently of the operators."""

from __future__ import annotations

FEED = """
feed AS (
  SELECT
    CASE WHEN event_id % 97 <> 0 THEN event_id // 3 END AS id,
    CASE WHEN event_id % 89 <> 0 THEN CASE WHEN event_id % 13 = 5 THEN -1 - user_id ELSE user_id END END AS employee_id,
    CASE WHEN event_id % 83 <> 0 THEN epoch_us(ts) END AS start_timestamp,
    CASE event_type
      WHEN 'click' THEN 'Commute to work - Marche/running'
      WHEN 'view' THEN 'Commute to work - Vélo/Trottinette/Autres'
      WHEN 'purchase' THEN 'Runing'
      WHEN 'signup' THEN 'Tennis'
      ELSE CASE event_id % 5 WHEN 0 THEN '' WHEN 1 THEN NULL ELSE 'Natation' END
    END AS sport_type,
    CASE WHEN event_type <> 'signup' THEN CAST(floor(value * 300) AS INTEGER) - 100 END AS distance,
    CAST((event_id % 60) * 63 AS INTEGER) AS elapsed_time,
    props AS details,
    CASE event_id % 7 WHEN 6 THEN 'true' WHEN 5 THEN NULL ELSE 'false' END AS __deleted,
    CAST((CASE WHEN event_id % 97 <> 0 THEN event_id // 3 ELSE event_id END) % 8 AS INTEGER) AS kafka_partition,
    event_id * 2 AS kafka_offset,
    event_id % 3 AS wave
  FROM events
),
timed AS (
  SELECT *, strftime(make_timestamp(start_timestamp), '%Y-%m-%d %H:%M:%S') AS start_datetime FROM feed
),
bronze AS (
  SELECT id, employee_id, start_timestamp, sport_type, distance, elapsed_time, details, __deleted,
         start_datetime, kafka_partition, kafka_offset
  FROM timed
)"""

STAFF = """
staff AS (
  SELECT c_custkey AS employee_id, c_name AS nom, 'P' || c_nationkey AS prenom, c_mktsegment AS bu,
         CASE WHEN c_acctbal > 5000 THEN 'CDI' ELSE 'CDD' END AS type_de_contrat,
         CASE c_mktsegment
           WHEN 'MACHINERY' THEN 'Marche/running'
           WHEN 'BUILDING' THEN 'Vélo/Trottinette/Autres'
           WHEN 'AUTOMOBILE' THEN 'véhicule thermique/électrique'
           WHEN 'FURNITURE' THEN NULL
           ELSE 'Transports en commun'
         END AS transport_mode,
         CASE c_nationkey % 3 WHEN 1 THEN 'Runing' WHEN 2 THEN 'Tennis' END AS external_sport,
         CAST(floor(c_acctbal) AS INTEGER) AS salaire_brut,
         c_nationkey
  FROM customer
)"""

BROKEN = {
    "id_null": "id IS NULL",
    "employee_id_null": "employee_id IS NULL",
    "sport_type_null": "sport_type IS NULL OR sport_type = ''",
    "elapsed_time_invalid": "elapsed_time IS NULL OR elapsed_time <= 0",
    "start_datetime_null": "start_datetime IS NULL",
    "distance_negative": "coalesce(distance, 0) < 0",
    "distance_outlier_marche": "coalesce(distance, 0) > 15000 AND coalesce(sport_type, '') LIKE '%Marche/running%'",
    "distance_outlier_vélo": "coalesce(distance, 0) > 25000 AND coalesce(sport_type, '') LIKE '%Vélo/Trottinette/Autres%'",
}

_REASON = ", ".join(f"CASE WHEN {test} THEN '{name}' END" for name, test in BROKEN.items())


def _tagged(source: str, reason: str = f"concat_ws(', ', {_REASON})") -> str:
    return f"tagged AS (SELECT *, {reason} AS rejection_reason FROM {source})"


TAGGED = f"{FEED}, {_tagged('bronze')}"
CLEAN = f"{TAGGED}, clean AS (SELECT * EXCLUDE (rejection_reason) FROM tagged WHERE rejection_reason = '')"
KNOWN = f"""{CLEAN}, {STAFF},
known AS (SELECT * FROM clean WHERE employee_id IN (SELECT employee_id FROM staff)),
orphans AS (
  SELECT *, 'employee_id_not_in_reference' AS rejection_reason FROM clean
  WHERE employee_id NOT IN (SELECT employee_id FROM staff)
),
quarantine AS (SELECT * FROM tagged WHERE rejection_reason <> '')"""

_SILVER_COLUMNS = """id, employee_id, start_datetime, sport_type, distance, elapsed_time, details,
         coalesce(starts_with(sport_type, 'Commute to work'), false) AS is_commute"""


def _latest(name: str, source: str) -> str:
    return f"""{name} AS (
  SELECT {_SILVER_COLUMNS}, __deleted FROM {source}
  QUALIFY row_number() OVER (PARTITION BY id ORDER BY kafka_offset DESC) = 1
)"""


_ACTIVE = "__deleted IS DISTINCT FROM 'true'"
SILVER = f"""{KNOWN}, {_latest('changes', 'known')},
silver AS (SELECT * EXCLUDE (__deleted) FROM changes WHERE {_ACTIVE})"""
GOLD = f"""{SILVER},
stats AS (
  SELECT employee_id,
         count(*) AS total_activities,
         count(*) FILTER (WHERE is_commute) AS total_commute_activities,
         count(*) FILTER (WHERE NOT is_commute) AS total_external_activities,
         CAST(coalesce(sum(distance), 0) AS BIGINT) AS total_distance_m,
         CAST(coalesce(sum(elapsed_time), 0) AS BIGINT) AS total_elapsed_time_s
  FROM silver GROUP BY employee_id
),
totals AS (
  SELECT s.* EXCLUDE (c_nationkey),
         coalesce(total_activities, 0) AS total_activities,
         coalesce(total_commute_activities, 0) AS total_commute_activities,
         coalesce(total_external_activities, 0) AS total_external_activities,
         coalesce(total_distance_m, 0) AS total_distance_m,
         coalesce(total_elapsed_time_s, 0) AS total_elapsed_time_s
  FROM staff s LEFT JOIN stats USING (employee_id)
),
gold AS (
  SELECT *,
         coalesce(transport_mode IN ('Marche/running', 'Vélo/Trottinette/Autres'), false)
           AND total_commute_activities > 0 AS is_eligible_prime_sportive,
         total_external_activities >= 15 AS is_eligible_journees_bien_etre
  FROM totals
)"""

# Deletes need an id and nothing else; they pass the key check too.
EXEMPT = f"""{FEED}, {STAFF},
{_tagged('bronze', f"CASE WHEN __deleted IS NOT DISTINCT FROM 'true' THEN CASE WHEN id IS NULL THEN 'id_null' ELSE '' END ELSE concat_ws(', ', {_REASON}) END")},
valid AS (
  SELECT * FROM tagged WHERE rejection_reason = ''
  AND (__deleted IS NOT DISTINCT FROM 'true' OR employee_id IN (SELECT employee_id FROM staff))
),
{_latest('changes', 'valid')}"""

DEDUP_FIRST = f"""{FEED}, {STAFF},
newest AS (SELECT * FROM bronze QUALIFY row_number() OVER (PARTITION BY id ORDER BY kafka_offset DESC) = 1),
{_tagged('newest')},
valid AS (
  SELECT * FROM tagged WHERE rejection_reason = '' AND employee_id IN (SELECT employee_id FROM staff)
),
{_latest('changes', 'valid')}"""

_VALUES = ["employee_id", "start_datetime", "sport_type", "distance", "elapsed_time", "details", "is_commute"]


def _merge(differs: str) -> str:
    """Target: first versions. Changes: later versions. The merge clause by clause, as unions."""
    test = " OR ".join(f"t.{c} {differs} n.{c}" for c in _VALUES)
    new = ", ".join(["n.id", *(f"n.{c}" for c in _VALUES)])
    return f"""WITH {KNOWN},
{_latest('early', "(SELECT * FROM known WHERE kafka_offset // 2 % 3 = 0)")},
{_latest('late', "(SELECT * FROM known WHERE kafka_offset // 2 % 3 > 0)")},
target AS (SELECT * EXCLUDE (__deleted) FROM early WHERE {_ACTIVE})
SELECT t.* FROM target t WHERE NOT EXISTS (SELECT 1 FROM late n WHERE n.id = t.id)
UNION ALL
SELECT t.* FROM target t JOIN late n ON n.id = t.id
WHERE n.__deleted IS DISTINCT FROM 'true' AND NOT coalesce({test}, false)
UNION ALL
SELECT {new} FROM target t JOIN late n ON n.id = t.id
WHERE n.__deleted IS DISTINCT FROM 'true' AND coalesce({test}, false)
UNION ALL
SELECT {new} FROM late n
WHERE n.__deleted IS DISTINCT FROM 'true' AND NOT EXISTS (SELECT 1 FROM target t WHERE t.id = n.id)"""


LANDED = f"""{FEED},
landed AS (
  SELECT * FROM bronze
  UNION ALL
  SELECT NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, kafka_partition, kafka_offset + 1
  FROM bronze WHERE __deleted = 'true'
)"""

_PEOPLE = f"""{STAFF},
sports AS (
  SELECT CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN -1 - c_custkey ELSE c_custkey END AS employee_id,
         CASE c_nationkey % 3 WHEN 1 THEN 'Runing' WHEN 2 THEN 'Tennis' END AS external_sport
  FROM customer
),
joined AS (
  SELECT s.* EXCLUDE (external_sport), sports.external_sport FROM staff s LEFT JOIN sports USING (employee_id)
),
people AS (
  SELECT employee_id, transport_mode, external_sport AS sport_practice,
         CASE WHEN employee_id = 0 AND transport_mode IS NULL THEN 'employee_id, transport_mode'
              WHEN employee_id = 0 THEN 'employee_id'
              WHEN transport_mode IS NULL THEN 'transport_mode' ELSE '' END AS invalid
  FROM joined
),
valid_people AS (
  SELECT employee_id, transport_mode, sport_practice,
         sport_practice IS NOT NULL AS plays,
         coalesce(transport_mode IN ('Marche/running', 'Vélo/Trottinette/Autres'), false) AS moves
  FROM people WHERE invalid = ''
),
labelled AS (
  SELECT *, CASE WHEN plays AND moves THEN 'both' WHEN plays THEN 'sport_only'
                 WHEN moves THEN 'transport_only' ELSE 'none' END AS cohort
  FROM valid_people
)"""

_REFERENCE = f"""WITH {_PEOPLE}
SELECT employee_id, nom, prenom, '1990-07-06' AS date_de_naissance, bu,
       '2020-12-14' AS date_d_embauche, salaire_brut, type_de_contrat, c_nationkey AS nombre_de_jours_de_cp,
       c_nationkey || ' rue "du Port", 34000' AS adresse_du_domicile, transport_mode, external_sport
FROM joined"""

NOTES = f"""{FEED},
notes AS (
  SELECT id AS activity_id, employee_id, sport_type, distance, elapsed_time,
         make_timestamp(nullif(start_timestamp, 0)) AS start_timestamp, details,
         coalesce(__deleted = 'true', false) AS is_deleted, kafka_offset
  FROM feed
)"""


def _messages(source: str, note: str) -> str:
    return f"""described AS (
  SELECT *,
         CASE WHEN is_deleted THEN 'Activité supprimée — Employé ' ELSE 'Dernière activité sportive — Employé ' END
           || coalesce(CAST(employee_id AS VARCHAR), 'None') AS title,
         CASE WHEN NOT is_deleted THEN
           '**Sport :** ' || coalesce(sport_type, 'None')
           || chr(10) || '**Date :** ' || coalesce(strftime(start_timestamp, '%d/%m/%Y à %H:%M'), 'date inconnue')
           || chr(10) || '**Distance :** ' || coalesce(distance, 0) || ' m'
           || chr(10) || '**Durée :** ' || format('{{:.1f}}', coalesce(elapsed_time, 0) / 60.0::DOUBLE) || ' min'
           || chr(10) || '**Détails :** ' || coalesce(details, 'None') || {note}
         END AS description,
         CASE WHEN is_deleted THEN 15158332 ELSE 3066993 END AS color
  FROM {source}
),
messages AS (
  SELECT *, CAST(CASE WHEN is_deleted
      THEN json_object('embeds', json_array(json_object('title', title, 'color', color)))
      ELSE json_object('embeds', json_array(json_object('title', title, 'description', description, 'color', color)))
    END AS VARCHAR) AS body
  FROM described
)"""


_NOTE = "chr(10) || '*(' || total_in_batch || ' activité(s) dans ce lot)*'"
LAST = f"""{NOTES},
last AS (
  SELECT * EXCLUDE (kafka_offset), (SELECT count(*) FROM notes) AS total_in_batch FROM notes
  ORDER BY kafka_offset DESC LIMIT 1
),
{_messages('last', _NOTE)}"""

_TIME_TEXT = "strftime(start_timestamp, '%Y-%m-%d %H:%M:%S.%f') AS start_timestamp"
_TOTALS = (
    "total_activities, total_commute_activities, total_external_activities, total_distance_m, total_elapsed_time_s"
)

# What is rejected under "newest first": of each id the newest version, and all rows without an id.
DEDUP_REJECTS = f"""{FEED}, {STAFF},
newest AS (SELECT * FROM bronze WHERE id IS NULL OR kafka_offset = (SELECT max(b.kafka_offset) FROM bronze b WHERE b.id = bronze.id)),
{_tagged('newest')}
SELECT id, employee_id, kafka_offset, rejection_reason FROM tagged WHERE rejection_reason <> ''
UNION ALL
SELECT id, employee_id, kafka_offset, 'employee_id_not_in_reference' FROM tagged
WHERE rejection_reason = '' AND employee_id NOT IN (SELECT employee_id FROM staff)"""

_FAULT = "kafka_offset // 2 % 11 IN (3, 4)"
_KINDS = {
    "id": "BIGINT", "employee_id": "BIGINT", "start_timestamp": "BIGINT", "sport_type": "STRING", "elapsed_time": "BIGINT",
    "details": "STRING", "__deleted": "STRING",
}
_SENT_AS_TEXT = "kafka_offset // 2 % 17 = 2 AND kafka_offset // 2 % 13 <> 1"
FIELDS_FOUND = " UNION ALL ".join([
    *(f"SELECT wave, '{c}' AS field, '{kind}' AS kind, true AS known FROM sound WHERE {c} IS NOT NULL" for c, kind in _KINDS.items()),
    f"SELECT wave, 'distance', CASE WHEN {_SENT_AS_TEXT} THEN 'STRING' ELSE 'BIGINT' END, true FROM sound WHERE distance IS NOT NULL",
    "SELECT wave, 'shoe_size', 'BIGINT', false FROM sound WHERE kafka_offset // 2 % 13 = 1",
])

ORACLES: dict[str, str] = {
    "payload_malformed": f"""WITH {FEED}
SELECT kafka_partition AS partition, kafka_offset AS "offset", 'payload_malformed' AS rejection_reason,
       CASE WHEN kafka_offset // 2 % 11 = 3 THEN '{{"id":' || kafka_offset || ',"elapsed' ELSE '[1, 2]' END AS payload
FROM feed WHERE {_FAULT}""",
    "payload_fields": f"""WITH {FEED}, sound AS (SELECT * FROM feed WHERE NOT {_FAULT}), found AS ({FIELDS_FOUND})
SELECT CAST(wave AS INTEGER) AS wave, field, kind, known, count(*) AS records FROM found GROUP BY ALL""",
    "bronze_republished": f"WITH {LANDED} SELECT * FROM landed",
    "batch_reports": f"""WITH {LANDED}, {STAFF}, {_tagged('landed')}, reasons AS (
  SELECT CAST(kafka_offset // 2 % 3 AS INTEGER) AS batch_id,
    CASE WHEN rejection_reason = '' AND employee_id NOT IN (SELECT employee_id FROM staff) THEN 'employee_id_not_in_reference'
         ELSE rejection_reason END AS reason
  FROM tagged
)
SELECT batch_id, rule, count(*) AS records
FROM (SELECT batch_id, unnest(string_split(reason, ', ')) AS rule FROM reasons WHERE reason <> '') GROUP BY batch_id, rule""",
    "table_counts": """SELECT 'events' AS name, count(*) AS records FROM events UNION ALL SELECT 'customer', count(*) FROM customer
UNION ALL SELECT 'orders', count(*) FROM orders UNION ALL SELECT 'lineitem', count(*) FROM lineitem UNION ALL SELECT 'nowhere', -1""",
    "reference_broken": """SELECT CASE WHEN c_custkey % 19 = 3 THEN 'no. ' || c_custkey ELSE CAST(c_custkey AS VARCHAR) END AS id_text,
  concat_ws(', ', CASE WHEN c_custkey % 19 = 3 THEN 'ID salarié' END, CASE WHEN c_custkey % 7 = 3 THEN 'Salaire brut' END) AS columns
FROM customer WHERE c_custkey % 19 = 3 OR c_custkey % 7 = 3""",
    "quarantine_dedup_first": f"WITH {DEDUP_REJECTS}",
    "silver_replayed_batches": f"WITH {SILVER} SELECT * FROM silver",
    "silver_merge_buckets": f"WITH {SILVER} SELECT * FROM silver",
    "silver_merge_partitions": f"WITH {SILVER} SELECT * FROM silver",
    "silver_newest": f"WITH {SILVER} SELECT * FROM silver",
    "silver_newest_merged": f"WITH {SILVER} SELECT * FROM silver",
    "silver_late_staff": f"WITH {SILVER} SELECT * FROM silver",
    "bronze_compacted": f"WITH {LANDED} SELECT * FROM landed",
    "quarantine_compacted": f"""WITH {KNOWN}
SELECT id, employee_id, kafka_offset, rejection_reason, CAST(kafka_offset // 2 % 3 AS INTEGER) AS batch_id
FROM (SELECT * FROM quarantine UNION ALL BY NAME SELECT * FROM orphans)""",
    "gold_incremental": f"WITH {GOLD} SELECT * FROM gold",
    "medallion_refresh": f"""WITH {GOLD}
SELECT * REPLACE (CASE WHEN bu <> 'HOUSEHOLD' THEN external_sport END AS external_sport) FROM gold""",
    "bronze_status": f"""WITH {LANDED}
SELECT 'landed' AS place, count(*) AS records, count(*) > 0 AS has_data FROM landed
UNION ALL SELECT 'missing', -1, false""",
    "staff_files": f"""WITH {_PEOPLE}
SELECT CAST(employee_id AS VARCHAR) AS employee_id, transport_mode, external_sport AS sport_practice FROM joined""",
    "cohort_run": f"""WITH {_PEOPLE}, staffed AS (
  SELECT external_sport IS NOT NULL OR coalesce(transport_mode IN ('Marche/running', 'Vélo/Trottinette/Autres'), false) AS inside
  FROM joined
)
SELECT count(*) AS total_employees, count(*) FILTER (WHERE inside) AS eligible_employees,
       count(*) FILTER (WHERE inside) AS rows_written, true AS success, CAST(NULL AS VARCHAR) AS error FROM staffed""",
    "cohort_frames": f"WITH {_PEOPLE} SELECT employee_id, cohort AS frame FROM labelled WHERE cohort <> 'none'",
    "write_counts": f"""WITH {SILVER}
SELECT 1 AS step, count(*) AS reported, count(*) AS found FROM silver
UNION ALL SELECT 2, count(*), count(*) FROM silver WHERE is_commute""",
    "no_reference_keys": f"""WITH {CLEAN}
SELECT 'passed' AS part, count(*) AS records FROM clean UNION ALL SELECT 'orphans', 0""",
    "null_key_offenders": f"""WITH {FEED}
SELECT least(count(*), 10) AS shown, count(*) > 0 AS all_null FROM bronze WHERE employee_id IS NULL""",
    "ingest_stamps": f"""WITH {LANDED}
SELECT count(*) AS records, 0 AS unstamped, true AS one_stamp_per_delivery FROM landed""",
    "gold_eligibility": f"WITH {GOLD} SELECT * FROM gold",
    "activity_stats": f"WITH {GOLD} SELECT * FROM stats",
    "employee_totals": f"WITH {GOLD} SELECT employee_id, {_TOTALS} FROM totals",
    "prime_flag": f"""WITH {GOLD}
SELECT employee_id, transport_mode, total_commute_activities, is_eligible_prime_sportive FROM gold""",
    "wellness_flag": f"""WITH {GOLD}
SELECT employee_id, total_external_activities, is_eligible_journees_bien_etre FROM gold""",
    "gold_report": f"""WITH {GOLD}
SELECT count(*) AS employees, count(*) FILTER (WHERE is_eligible_prime_sportive) AS eligible_prime,
       count(*) FILTER (WHERE is_eligible_journees_bien_etre) AS eligible_wellness FROM gold""",
    "gold_publish": f"WITH {GOLD} SELECT * FROM gold",
    "dq_rule_flags": f"""WITH {FEED}
SELECT kafka_offset, {", ".join(f'({test}) AS "{name}"' for name, test in BROKEN.items())} FROM bronze""",
    "dq_tagged": f"WITH {TAGGED} SELECT id, employee_id, kafka_offset, rejection_reason FROM tagged",
    "dq_clean": f"WITH {CLEAN} SELECT * FROM clean",
    "dq_quarantine": f"WITH {KNOWN} SELECT * FROM quarantine",
    "dq_rule_summary": f"""WITH {KNOWN}
SELECT rule, count(*) AS records
FROM (SELECT unnest(string_split(rejection_reason, ', ')) AS rule FROM quarantine) GROUP BY rule""",
    "fk_valid": f"WITH {KNOWN} SELECT * FROM known",
    "fk_orphans": f"WITH {KNOWN} SELECT * FROM orphans",
    "fk_valid_bitmap": f"WITH {KNOWN} SELECT * FROM known",
    "fk_orphans_bitmap": f"WITH {KNOWN} SELECT * EXCLUDE (rejection_reason) FROM orphans",
    "all_rejected": f"WITH {KNOWN} SELECT * FROM quarantine UNION ALL BY NAME SELECT * FROM orphans",
    "rejects_union": f"""WITH {KNOWN}
SELECT id, kafka_offset, details, rejection_reason FROM quarantine
UNION ALL SELECT id, kafka_offset, NULL, rejection_reason FROM orphans""",
    "quarantine_history": f"""WITH {KNOWN}
SELECT id, employee_id, kafka_offset, rejection_reason, CAST(kafka_offset // 2 % 3 AS INTEGER) AS batch_id
FROM (SELECT * FROM quarantine UNION ALL BY NAME SELECT * FROM orphans)""",
    "bronze_profile": f"""WITH {FEED}
SELECT count(*) AS records, count(*) FILTER (WHERE id IS NULL) AS null_ids,
       count(*) FILTER (WHERE employee_id IS NULL) AS null_employees FROM bronze""",
    "null_key_report": f"""WITH {FEED}
SELECT count(*) AS records, count(*) FILTER (WHERE employee_id IS NULL) AS null_keys FROM bronze""",
    "known_keys": f"WITH {FEED} SELECT DISTINCT employee_id FROM bronze",
    "epoch_datetime": f"WITH {FEED} SELECT kafka_offset, start_timestamp, start_datetime FROM timed",
    "commute_flag": f"""WITH {FEED}
SELECT kafka_offset, sport_type, coalesce(starts_with(sport_type, 'Commute to work'), false) AS is_commute FROM feed""",
    "cdc_parse_json": f"""WITH {LANDED}
SELECT * EXCLUDE (kafka_partition, kafka_offset), kafka_partition AS partition, kafka_offset AS offset FROM landed""",
    "cdc_latest": f"""WITH {FEED}
SELECT * FROM bronze QUALIFY row_number() OVER (PARTITION BY id ORDER BY kafka_offset DESC) = 1""",
    "cdc_active": f"WITH {FEED} SELECT * FROM bronze WHERE {_ACTIVE}",
    "silver_projection": f"WITH {SILVER} SELECT * FROM changes",
    "silver_initial": f"WITH {SILVER} SELECT * FROM silver",
    "silver_exempt_deletes": f"WITH {EXEMPT} SELECT * EXCLUDE (__deleted) FROM changes WHERE {_ACTIVE}",
    "silver_dedup_first": f"WITH {DEDUP_FIRST} SELECT * EXCLUDE (__deleted) FROM changes WHERE {_ACTIVE}",
    "silver_merge_parity": _merge("<>"),
    "silver_merge_nullsafe": _merge("IS DISTINCT FROM"),
    "reference_join": _REFERENCE,
    "reference_csv": _REFERENCE,
    "employees_valid": f"WITH {_PEOPLE} SELECT employee_id, transport_mode, sport_practice FROM valid_people",
    "employees_invalid": f"WITH {_PEOPLE} SELECT employee_id, sport_practice, invalid FROM people WHERE invalid <> ''",
    "eligible_employees": f"""WITH {_PEOPLE}
SELECT employee_id, transport_mode, sport_practice FROM valid_people WHERE plays OR moves""",
    "cohort_split": f"WITH {_PEOPLE} SELECT employee_id, cohort FROM labelled",
    "cohort_shares": f"""WITH {_PEOPLE},
names AS (SELECT unnest(['transport_only', 'both', 'sport_only', 'none']) AS cohort)
SELECT cohort, count(employee_id) AS employees,
       count(employee_id) * 100.0::DOUBLE / nullif((SELECT count(*) FROM labelled), 0) AS share_pct
FROM names LEFT JOIN labelled USING (cohort) GROUP BY cohort""",
    "notify_rows": f"""WITH {NOTES}
SELECT activity_id, employee_id, sport_type, distance, elapsed_time, {_TIME_TEXT}, details, is_deleted,
       kafka_offset AS offset FROM notes""",
    "notify_latest": f"WITH {LAST} SELECT * REPLACE ({_TIME_TEXT.removesuffix(' AS start_timestamp')} AS start_timestamp) FROM messages",
    "notify_payload": f"""WITH {NOTES}, {_messages('notes', "''")}
SELECT kafka_offset, title, description, color, body FROM messages""",
    "bronze_stream": f"WITH {LANDED} SELECT * FROM landed",
    "silver_incremental": f"WITH {SILVER} SELECT * FROM silver",
    "notification_stream": f"WITH {LAST} SELECT activity_id, total_in_batch, title, color, body FROM messages",
}
