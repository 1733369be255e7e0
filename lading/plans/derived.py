"""Input tables of the jobs, derived from the given order, customer, event and page tables.

Each view is one SELECT that both Spark and DuckDB accept once ``dialect`` has
filled in the few spellings that differ. There is nothing random in them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = ("customer", "orders", "events", "pages")
AS_OF = "2001-08-01"
LEDGER_TIME = "TIMESTAMP '2020-01-01 00:00:00'"

SPARK = {"bytes_of_html": "encode(html, 'UTF-8')", "base64_of_props": "base64(encode(props, 'UTF-8'))"}
DUCKDB = {"bytes_of_html": "encode(html)", "base64_of_props": "to_base64(encode(props))"}


def _address(k: str, town: str) -> str:
    """One of 17 address shapes; 17 shares no factor with the other cycles over ``k``."""
    return f"""CASE {k} % 17
        WHEN 0 THEN concat({k} % 90 + 1, '/1 GREGORY RD, ', {town})
        WHEN 1 THEN concat('NO ', {k} % 300, ', WARD PL, ', {town})
        WHEN 2 THEN concat({k} % 500, ' T B JAYAH MW')
        WHEN 3 THEN concat({k} % 70, ' FLOOR GALLE ROAD COLPETTY')
        WHEN 4 THEN {town}
        WHEN 5 THEN concat('X ', {k} % 9, ',,,,,,')
        WHEN 6 THEN concat({k} % 20, ' A, B  C')
        WHEN 7 THEN concat('NO ', {k} % 400, ' ROAD')
        WHEN 8 THEN 'MAIN STREET'
        WHEN 9 THEN concat({k} % 40, ' A, SIR CHITTAMPALAM A GARDINER MAWATHA, ', {town})
        WHEN 10 THEN concat('8', chr(9), 'LAKE ', {k} % 30, ' RD', chr(13), chr(10))
        WHEN 11 THEN concat('UNIT ', {k} % 60, ' LEVEL 3 NORTH WING OF THE OLD TRADE CENTRE, ',
                            'SIR CHITTAMPALAM A GARDINER MAWATHA,', {town}, ' 05')
        WHEN 12 THEN ''
        WHEN 13 THEN concat({k} % 80, ' GALLE ROAD,, GALLE.')
        WHEN 14 THEN concat({k} % 60, ' 2/1 ST. JOHN''S S RD')
        WHEN 15 THEN ', FOO'
        ELSE concat({k} % 50, ' TOWER BLOCK 7,ST 0', {k} % 9, ',ST 0', {k} % 9)
    END"""


def _town(k: str) -> str:
    return f"""CASE {k} % 7
        WHEN 0 THEN concat('COLOMBO 0', {k} % 9 + 1)
        WHEN 1 THEN 'COLOMBO 10'
        WHEN 2 THEN 'GALLE'
        WHEN 3 THEN CASE WHEN {k} % 3 = 0 THEN '' ELSE ' KANDY ' END
        WHEN 4 THEN 'COLOMBO 100'
        WHEN 5 THEN concat('KAN,DY', chr(9))
        ELSE concat('NATION_', {k} % 25)
    END"""


# Every tenth customer repeats the one before it.
_SAME = "c_custkey - CASE WHEN c_custkey % 10 = 9 THEN 1 ELSE 0 END"

VIEWS = {
    "customer_input": f"""
        SELECT customer_id, customer_name, {_address("k", "own_town")} AS address, own_town AS town
        FROM (
            SELECT customer_id, customer_name, k, {_town("k")} AS own_town
            FROM (
                SELECT c_custkey AS customer_id,
                       CASE WHEN c_custkey % 10 = 9
                            THEN concat('  customer#', lpad(CAST({_SAME} AS STRING), 9, '0'))
                            ELSE c_name END AS customer_name,
                       {_SAME} AS k
                FROM {{customer}}
            ) AS keyed
        ) AS placed""",
    "pickup_input": f"""
        SELECT pickup_id, customer_id,
               CASE WHEN pickup_id % 4 = 0 THEN NULL ELSE {_address("pickup_id", "own_town")} END AS pickup_address,
               CASE WHEN pickup_id % 5 = 0 THEN NULL ELSE own_town END AS pickup_town,
               created_date
        FROM (
            SELECT o_orderkey AS pickup_id,
                   CASE WHEN o_orderkey % 97 = 0 THEN -1 ELSE o_custkey END AS customer_id,
                   o_orderdate AS created_date,
                   {_town("o_orderkey")} AS own_town
            FROM {{orders}}
        ) AS placed""",
    # A second table that refers to customers, by two columns.
    "parcel_input": """
        SELECT event_id AS parcel_id,
               CASE WHEN event_id % 59 <> 0 THEN user_id END AS sender_id,
               CASE WHEN event_id % 3 = 0 THEN 9 ELSE user_id + 1 END AS receiver_id,
               event_type AS service
        FROM {events}""",
    "header_input": """
        SELECT o_orderkey AS detain_hawb_id, o_orderdate AS created_date FROM {orders}""",
    "attachment_input": """
        SELECT page_id AS detain_hawb_id,
               CASE WHEN page_id % 30 = 0 THEN 'YES  ' WHEN page_id % 3 = 0 THEN 'YES'
                    WHEN page_id % 3 = 1 THEN 'NO' END AS atch_is_printed,
               CASE page_id % 11 WHEN 0 THEN NULL WHEN 1 THEN concat('_draft', page_id)
                    WHEN 2 THEN concat('.', page_id) WHEN 3 THEN concat('/lead', page_id)
                    ELSE concat('page', page_id) END AS atchmnt_name,
               {bytes_of_html} AS atchmnt_data
        FROM {pages}""",
    # A second attachment for pages with a query string.
    "attachment_twin_input": """
        SELECT page_id AS detain_hawb_id,
               CASE WHEN page_id % 3 = 0 THEN 'YES' ELSE 'NO' END AS atch_is_printed,
               concat('copy', page_id) AS atchmnt_name,
               {bytes_of_html} AS atchmnt_data
        FROM {pages} WHERE url LIKE '%?%'""",
    "attachment_ledger": f"""
        SELECT page_id AS id, concat('done-', page_id) AS document_name, {LEDGER_TIME} AS migrated_at
        FROM {{pages}} WHERE url LIKE '%.example.net/%'""",
    "shipment_input": """
        SELECT CASE WHEN event_id % 211 <> 7 THEN event_id END AS cour_delivery_id,
               CASE WHEN event_id % 103 <> 0 THEN ts + INTERVAL '1' MONTH * (event_id % 6) END AS created_date,
               CASE WHEN event_type = 'purchase' AND event_id % 13 = 0 THEN 'DE '
                    WHEN event_type = 'purchase' THEN 'DE' ELSE 'XX' END AS rec_status,
               CASE WHEN event_id % 101 = 0 THEN '!!!' ELSE {base64_of_props} END AS signature
        FROM {events}""",
    "shipment_ledger": f"""
        SELECT event_id AS id, concat('done-', event_id) AS document_name, {LEDGER_TIME} AS migrated_at
        FROM {{events}} WHERE ts < TIMESTAMP '2024-01-11 00:00:00'""",
}


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A derived view over the Parquet tables in ``sf_dir``."""
    text = VIEWS[name]
    used = [t for t in TABLES if "{" + t + "}" in text]
    for placeholder, spelling in SPARK.items():
        text = text.replace("{" + placeholder + "}", spelling)
    return spark.sql(text, **{t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in used})


def duckdb_text(name: str) -> str:
    """The same view for DuckDB, over tables of the given names."""
    return VIEWS[name].format(**{t: t for t in TABLES}, **DUCKDB)
