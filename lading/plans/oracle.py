"""The registered queries restated in SQL for DuckDB, to check the Spark results against."""

from __future__ import annotations

from lading.plans.derived import AS_OF, VIEWS, duckdb_text

_STEPS = {
    "source": """
        SELECT p.pickup_id, p.customer_id, c.customer_name,
               coalesce(p.pickup_address, c.address) AS address,
               coalesce(p.pickup_town, c.town) AS town,
               p.created_date, c.customer_id IS NOT NULL AS customer_found
        FROM pickup_input p LEFT JOIN customer_input c ON p.customer_id = c.customer_id""",
    # The cleaning runs over pickups and over the customers themselves.
    "cust_source": """
        SELECT customer_id AS pickup_id, customer_id, customer_name, address, town,
               NULL AS created_date, true AS customer_found
        FROM customer_input""",
    "towns": """
        SELECT * REPLACE (replace(regexp_replace(nullif(town, ''), '0([0-9])', '\\1'), chr(9), '') AS town)
        FROM {source}""",
    "zeros": """
        SELECT * EXCLUDE (tail) REPLACE (
            replace(CASE WHEN tail IS NULL THEN address
                         ELSE replace(address, tail, regexp_replace(tail, '0([0-9])', '\\1')) END, chr(9), '') AS address)
        FROM (SELECT *, nullif(regexp_extract(address, ',[^,]*$'), '') AS tail FROM {towns})""",
    "no_town": """
        SELECT * EXCLUDE (address, town, t), t AS town, address AS orig_address,
               replace(trim(replace(replace(address, t, ''), replace(t, ' ', ''), '')), ',,', ',') AS cln_address
        FROM (SELECT *, replace(town, ',', '') AS t FROM {zeros})""",
    "no_commas": """
        SELECT * REPLACE (
            replace(rtrim(regexp_replace(
                nullif(trim(regexp_replace(nullif(cln_address, ''), ',$', '')), ''), ',$', '')), '.', '') AS cln_address)
        FROM {no_town}""",
    "raw_street": """
        SELECT *, regexp_extract(cln_address, ',[^,]*$') AS street FROM {no_commas}""",
    "streets": """
        SELECT *, CASE WHEN length(rtrim(street)) > 0 THEN 'Y' ELSE 'N' END AS has_street
        FROM (
            SELECT * REPLACE (
                replace(trim(replace(replace(
                    regexp_replace(nullif(trim(replace(cln_address, street, '')), ''), ',$', ''),
                    chr(13), ''), chr(10), '')), chr(9), '') AS cln_address,
                replace(trim(replace(replace(
                    substring(nullif(street, ''), 2), chr(13), ''), chr(10), '')), chr(9), '') AS street)
            FROM {raw_street}
        )""",
    "prefixes": """
        SELECT * EXCLUDE (t1, t2),
               CASE WHEN instr(t2, ' ') = 0 THEN '' ELSE trim(left(t2, instr(t2, ' '))) END AS prefix3,
               CASE WHEN instr(t2, ' ') = 0 THEN trim(t2) ELSE trim(substring(t2, instr(t2, ' '))) END AS prefix4
        FROM (
            SELECT *,
                   CASE WHEN instr(t1, ' ') = 0 THEN '' ELSE trim(left(t1, instr(t1, ' '))) END AS prefix2,
                   CASE WHEN instr(t1, ' ') = 0 THEN trim(t1) ELSE trim(substring(t1, instr(t1, ' '))) END AS t2
            FROM (
                SELECT *,
                       CASE WHEN instr(cln_address, ' ') = 0 THEN ''
                            ELSE trim(left(cln_address, instr(cln_address, ' '))) END AS prefix1,
                       CASE WHEN instr(cln_address, ' ') = 0 THEN trim(cln_address)
                            ELSE trim(substring(cln_address, instr(cln_address, ' '))) END AS t1
                FROM {streets}
            )
        )""",
    "fields": """
        SELECT * EXCLUDE (town, street, d1, d2, joined),
               town AS city,
               CASE WHEN has_street = 'Y' AND length(rtrim(joined)) <= 30
                    THEN concat(prefix1, ' ', prefix2, ' ', prefix3)
                    WHEN has_street = 'Y' THEN cln_address
                    WHEN concat(prefix2, prefix3, prefix4) = '' AND cln_address IS NOT NULL THEN NULL
                    WHEN NOT d1 AND NOT d2 THEN NULL
                    WHEN d2 THEN concat(prefix1, ' ', prefix2)
                    WHEN d1 AND length(prefix3) > 1
                         AND (length(prefix2) <= 1 OR prefix2 IN ('FLOOR', 'TOWER', 'LANE'))
                    THEN concat(prefix1, ' ', prefix2)
                    ELSE prefix1 END AS building,
               trim(CASE WHEN has_street = 'Y' AND length(rtrim(joined)) <= 30 THEN joined
                    WHEN has_street = 'Y' THEN street
                    WHEN concat(prefix2, prefix3, prefix4) = '' AND cln_address IS NOT NULL THEN prefix1
                    WHEN NOT d1 AND NOT d2
                    THEN trim(concat(prefix1, ' ', prefix2)) || ' ' || trim(concat(prefix3, ' ', prefix4))
                    WHEN d2 OR (d1 AND length(prefix3) > 1 AND length(prefix2) <= 1)
                    THEN concat(prefix3, ' ', prefix4)
                    ELSE trim(concat(prefix2, ' ', prefix3)) || ' ' || prefix4 END) AS street
        FROM (
            SELECT *, regexp_matches(prefix1, '[0-9]') AS d1, regexp_matches(prefix2, '[0-9]') AS d2,
                   concat(prefix4, ' ', street) AS joined
            FROM {prefixes}
        )""",
    "pdf_named": """
        SELECT a.detain_hawb_id AS id, h.created_date,
               strftime(h.created_date, '%Y-%m') AS folder,
               concat(CASE WHEN left(a.atchmnt_name, 1) IN ('_', '.', '/') THEN '-' END,
                      replace(a.atchmnt_name, '/', '_'), '-', a.detain_hawb_id, '.pdf') AS file_name,
               a.atchmnt_data AS content
        FROM attachment_input a
        JOIN header_input h ON a.detain_hawb_id = h.detain_hawb_id
            AND rtrim(coalesce(a.atch_is_printed, 'NO')) = 'YES'
        LEFT JOIN attachment_ledger l ON l.id = a.detain_hawb_id
        WHERE l.id IS NULL""",
    "pdf_all_named": """
        SELECT a.detain_hawb_id AS id, strftime(h.created_date, '%Y-%m') AS folder,
               concat(CASE WHEN left(a.atchmnt_name, 1) IN ('_', '.', '/') THEN '-' END,
                      replace(a.atchmnt_name, '/', '_'), '-', a.detain_hawb_id, '.pdf') AS file_name,
               count(*) OVER (PARTITION BY a.detain_hawb_id) AS copies
        FROM (SELECT * FROM attachment_input UNION ALL SELECT * FROM attachment_twin_input) a
        JOIN header_input h ON a.detain_hawb_id = h.detain_hawb_id
        WHERE rtrim(a.atch_is_printed) = 'YES'
          AND a.detain_hawb_id NOT IN (SELECT id FROM attachment_ledger)""",
    "jpeg_named": """
        SELECT id, folder, content,
               concat(left(digest, 8), '-', substring(digest, 9, 4), '-', substring(digest, 13, 4), '-',
                      substring(digest, 17, 4), '-', right(digest, 12), '.jpg') AS file_name
        FROM (
            SELECT s.cour_delivery_id AS id, strftime(s.created_date, '%Y-%m') AS folder,
                   upper(md5(concat('signature-', s.cour_delivery_id))) AS digest,
                   try(from_base64(s.signature)) AS content
            FROM shipment_input s LEFT JOIN shipment_ledger l ON l.id = s.cour_delivery_id
            WHERE l.id IS NULL AND rtrim(s.rec_status) = 'DE' AND s.cour_delivery_id IS NOT NULL
        )""",
    "jpeg_accepted": "SELECT * FROM jpeg_named WHERE folder IS NOT NULL",
    "jpeg_written": "SELECT * FROM jpeg_accepted WHERE content IS NOT NULL",
    "jpeg_batched": """
        SELECT id, folder, file_name,
               CAST((row_number() OVER (ORDER BY id) - 1) // 500 AS BIGINT) AS batch_id
        FROM jpeg_accepted""",
    "cust_match": """
        SELECT customer_id, customer_name, upper(trim(customer_name)) AS match_name, building, street, city
        FROM cust_fields""",
    "cust_walk": """
        SELECT *, CASE WHEN length(rtrim(match_name)) > 0
                        AND (length(rtrim(building)) > 0 OR length(rtrim(street)) > 0)
                       THEN min(customer_id) OVER (PARTITION BY match_name, building, street, city,
                            coalesce(length(rtrim(match_name)) > 0, false)
                            AND coalesce(length(rtrim(building)) > 0 OR length(rtrim(street)) > 0, false))
                       ELSE customer_id END AS survivor_id
        FROM cust_match""",
    "repointed": """
        SELECT p.pickup_id, coalesce(w.survivor_id, p.customer_id) AS customer_id
        FROM pickup_input p LEFT JOIN cust_walk w ON w.customer_id = p.customer_id""",
}

_CLEANING = ["towns", "zeros", "no_town", "no_commas", "raw_street", "streets", "prefixes", "fields"]


def _ctes() -> dict[str, str]:
    ctes = {name: duckdb_text(name) for name in VIEWS}
    for prefix in ("", "cust_"):
        names = {step: prefix + step for step in ["source", *_CLEANING]}
        ctes[names["source"]] = _STEPS[names["source"]]
        for step in _CLEANING:
            ctes[names[step]] = _STEPS[step].format(**names)
    for name, text in _STEPS.items():
        if name not in _CLEANING:
            ctes.setdefault(name, text)
    return ctes


_CLEANED = """pickup_id, customer_id, customer_name, cln_address, prefix1, prefix2, prefix3, prefix4,
              building, street, city, has_street, orig_address"""

_FINAL = {
    "address_source": """
        SELECT pickup_id, customer_id, customer_name, address, town, customer_found FROM source""",
    "town_zero_strip": "SELECT pickup_id, town FROM towns",
    "address_zero_strip": "SELECT pickup_id, address FROM zeros",
    "remove_town": "SELECT pickup_id, cln_address, town, orig_address FROM no_town",
    "strip_trailing_commas": "SELECT pickup_id, cln_address FROM no_commas",
    "street_extract": "SELECT pickup_id, cln_address, street FROM raw_street",
    "street_finish": "SELECT pickup_id, cln_address, street, has_street FROM streets",
    "prefix_split": "SELECT pickup_id, prefix1, prefix2, prefix3, prefix4 FROM prefixes",
    "building_street": "SELECT pickup_id, building, street, city, has_street FROM fields",
    "pickup_clean": f"SELECT {_CLEANED} FROM fields WHERE customer_found",
    "overlong_report": f"""
        SELECT {_CLEANED.replace("street, city", "replace(street, '  ', '') AS street, trim(city) AS city")}
        FROM fields
        WHERE customer_found
          AND (length(rtrim(building)) > 35 OR length(rtrim(street)) > 30 OR length(rtrim(city)) > 30)
          AND CAST(created_date AS DATE) >= CAST(DATE '{AS_OF}' - INTERVAL 6 MONTH AS DATE)""",
    "pdf_candidates": "SELECT id, folder, file_name FROM pdf_named",
    "jpeg_candidates": "SELECT id, folder, file_name FROM jpeg_named",
    "duplicate_id_quarantine": """
        SELECT id, folder, file_name, 'duplicate_id' AS reason FROM pdf_all_named WHERE copies > 1""",
    "single_id_manifest": "SELECT id, folder, file_name FROM pdf_all_named WHERE copies = 1",
    "signature_quarantine": """
        SELECT id, folder, file_name,
               CASE WHEN folder IS NULL THEN 'no_created_date' ELSE 'no_payload' END AS reason
        FROM jpeg_named WHERE folder IS NULL OR content IS NULL
        UNION ALL
        SELECT NULL AS id, NULL AS folder, NULL AS file_name, 'no_id' AS reason
        FROM shipment_input WHERE cour_delivery_id IS NULL AND rtrim(rec_status) = 'DE'""",
    "export_folders": "SELECT folder, count(*) AS n_files FROM jpeg_accepted GROUP BY folder",
    "candidate_numbers": """
        SELECT id, folder, row_number() OVER (ORDER BY id) AS row_number FROM jpeg_named""",
    "batch_range": """
        SELECT * FROM (SELECT id, folder, row_number() OVER (ORDER BY id) AS row_number FROM jpeg_named)
        WHERE row_number BETWEEN 1 AND 500""",
    "export_paths": "SELECT id, concat('/exports/', folder, '/', file_name) AS path FROM jpeg_accepted",
    "export_batches": "SELECT id, folder, file_name, batch_id FROM jpeg_batched",
    "pdf_payload": """
        SELECT id, folder, file_name, octet_length(content) AS n_bytes, md5(content) AS md5 FROM pdf_named""",
    "jpeg_payload": """
        SELECT id, folder, file_name, octet_length(content) AS n_bytes, md5(content) AS md5 FROM jpeg_written""",
    "export_summary": """
        SELECT count(*) AS n_files, CAST(sum(octet_length(content)) AS BIGINT) AS n_bytes FROM jpeg_written""",
    "export_ledger": """
        SELECT id, document_name FROM shipment_ledger
        UNION ALL SELECT id, file_name AS document_name FROM jpeg_written""",
    "batched_export_ledger": """
        SELECT id, document_name FROM shipment_ledger
        UNION ALL SELECT id, file_name AS document_name FROM jpeg_written""",
    "run_progress": """
        SELECT 'closed' AS state, (SELECT count(*) FROM jpeg_accepted) AS planned,
               count(*) AS n_files, CAST(sum(octet_length(content)) AS BIGINT) AS n_bytes FROM jpeg_written""",
    "resume_candidates": """
        SELECT id, folder, file_name FROM jpeg_named
        WHERE id NOT IN (SELECT id FROM jpeg_batched WHERE batch_id = 0)""",
    "signature_writeback": """
        SELECT s.cour_delivery_id, s.rec_status, coalesce(l.document_name, s.signature) AS signature
        FROM shipment_input s LEFT JOIN shipment_ledger l ON l.id = s.cour_delivery_id""",
    "signature_published": """
        SELECT s.cour_delivery_id, s.rec_status, coalesce(l.document_name, s.signature) AS signature
        FROM shipment_input s LEFT JOIN shipment_ledger l ON l.id = s.cour_delivery_id""",
    "attachment_writeback": """
        SELECT a.detain_hawb_id, l.document_name AS atchmnt_data,
               CASE WHEN l.id IS NULL THEN md5(a.atchmnt_data) END AS remaining_md5
        FROM attachment_input a LEFT JOIN attachment_ledger l ON l.id = a.detain_hawb_id""",
    "blob_roundtrip": """
        SELECT folder, file_name, octet_length(content) AS n_bytes, md5(content) AS md5 FROM pdf_named""",
    "signature_roundtrip": """
        SELECT folder, file_name, octet_length(content) AS n_bytes, md5(content) AS md5 FROM jpeg_written""",
    "customer_clean": "SELECT customer_id, customer_name, match_name, building, street, city FROM cust_match",
    "customer_crosswalk": "SELECT customer_id AS old_id, survivor_id FROM cust_walk",
    "customer_survivors": """
        SELECT customer_id, customer_name, match_name, building, street, city
        FROM cust_walk WHERE customer_id = survivor_id""",
    "customers_without_duplicates": """
        SELECT customer_id, customer_name, address, town FROM customer_input
        WHERE customer_id IN (SELECT customer_id FROM cust_walk WHERE customer_id = survivor_id)""",
    "pickup_repointed": "SELECT pickup_id, customer_id FROM repointed",
    "references_repointed": """
        SELECT r.table_name, r.row_id, r.column_name, coalesce(w.survivor_id, r.customer_id) AS customer_id
        FROM (
            SELECT 'pickups' AS table_name, pickup_id AS row_id, 'customer_id' AS column_name, customer_id
            FROM pickup_input
            UNION ALL SELECT 'parcels', parcel_id, 'sender_id', sender_id FROM parcel_input
            UNION ALL SELECT 'parcels', parcel_id, 'receiver_id', receiver_id FROM parcel_input
        ) r LEFT JOIN cust_walk w ON w.customer_id = r.customer_id""",
    "lost_references": """
        SELECT 'pickups' AS table_name, 'customer_id' AS column_name, count(*) AS n_lost
        FROM pickup_input WHERE customer_id IN (SELECT customer_id FROM cust_walk WHERE customer_id <> survivor_id)
        UNION ALL
        SELECT 'parcels', 'sender_id', count(*) FROM parcel_input WHERE sender_id IN (SELECT customer_id FROM cust_walk WHERE customer_id <> survivor_id)
        UNION ALL
        SELECT 'parcels', 'receiver_id', count(*) FROM parcel_input WHERE receiver_id IN (SELECT customer_id FROM cust_walk WHERE customer_id <> survivor_id)""",
    "lost_pickups": """
        SELECT count(*) FILTER (r.customer_id NOT IN (SELECT customer_id FROM cust_walk WHERE customer_id = survivor_id))
                   AS n_lost,
               count(*) FILTER (p.customer_id NOT IN (SELECT customer_id FROM cust_walk WHERE customer_id = survivor_id))
                   AS n_lost_unmoved
        FROM pickup_input p
        JOIN customer_input c ON c.customer_id = p.customer_id
        JOIN repointed r ON r.pickup_id = p.pickup_id""",
}


def _used(text: str, ctes: dict[str, str]) -> list[str]:
    """Names of the steps a text needs, directly or through others, in defining order."""
    needed: set[str] = set()
    open_texts = [text]
    while open_texts:
        words = set(open_texts.pop().replace("(", " ").replace(")", " ").replace(",", " ").split())
        for name in (words & ctes.keys()) - needed:
            needed.add(name)
            open_texts.append(ctes[name])
    return [name for name in ctes if name in needed]


def oracle_sql() -> dict[str, str]:
    ctes = _ctes()
    statements = {}
    for name, text in _FINAL.items():
        steps = ",\n".join(f"{step} AS ({ctes[step]})" for step in _used(text, ctes))
        statements[name] = f"WITH {steps}\n{text}"
    return statements
