"""Record views over the driver's tables, in SQL that Spark and DuckDB both read.

The tables have no receipts or bank registers, so these play them: order lines are bank rows, some
of them, changed a little, are receipts; four customer totals are a trust case; perturbed copies of
record fields are predictions.  Each view is one WITH item; ``with_views`` adds those that a query
names and what they need.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()

# What the views write for a line or an order; ``cases`` writes the same from one pass over the lines.
REGISTER_WANT = """CASE field WHEN 'TRANSACTION_DATES' THEN dmy WHEN 'LINE_ITEM_DESCRIPTIONS' THEN description WHEN 'TRANSACTION_AMOUNTS_PAID' THEN CASE WHEN credit THEN 'NOT_FOUND' ELSE amt END ELSE amt END"""
REGISTER_GOT = """CASE WHEN case_id % 3 <> 1 AND credit AND case_id % 11 <> 0 THEN NULL WHEN case_id % 10 = 5 AND pos = 2 AND field = 'LINE_ITEM_DESCRIPTIONS' THEN NULL WHEN case_id % 13 = 3 THEN 'NOT_FOUND'
                          WHEN field = 'TRANSACTION_DATES' THEN CASE WHEN (case_id + pos) % 9 = 0 THEN 'soon' WHEN case_id % 2 = 0 THEN d || ' ' || mon || ' ' || y ELSE lpad(d, 2, '0') || '/' || lpad(m, 2, '0') || '/' || substr(y, 3) END
                          WHEN field = 'LINE_ITEM_DESCRIPTIONS' THEN CASE WHEN (case_id + pos) % 5 = 0 THEN lower(description) || ' x' WHEN (case_id + pos) % 7 = 0 THEN 'lamp' ELSE description END
                          WHEN field = 'TRANSACTION_AMOUNTS_PAID' THEN CASE WHEN credit THEN 'NOT_FOUND' WHEN (case_id * 3 + pos) % 8 = 0 THEN '$' || amt || '9' ELSE '$' || amt END ELSE amt END"""
REGISTER_PARTS = """flag = 'R' OR case_id % 11 = 0 AS credit, CAST(day(txn_date) AS STRING) AS d, CAST(month(txn_date) AS STRING) AS m, CAST(year(txn_date) AS STRING) AS y,
                           lpad(CAST(day(txn_date) AS STRING), 2, '0') || '/' || lpad(CAST(month(txn_date) AS STRING), 2, '0') || '/' || CAST(year(txn_date) AS STRING) AS dmy,
                           substr('JanFebMarAprMayJunJulAugSepOctNovDec', CAST(month(txn_date) * 3 - 2 AS INT), 3) AS mon, CAST(CAST(amount AS DECIMAL(18,2)) AS STRING) AS amt"""
BOUGHT_WANT = """CASE field WHEN 'LINE_ITEM_DESCRIPTIONS' THEN lower(description) WHEN 'LINE_ITEM_QUANTITIES' THEN CAST(qty AS STRING) ELSE '$' || CAST(CAST(amount AS DECIMAL(18,2)) AS STRING) END"""
BOUGHT_GOT = """CASE WHEN (case_id + pos) % 9 = 0 THEN NULL WHEN field = 'LINE_ITEM_DESCRIPTIONS' THEN CASE WHEN pos % 4 = 0 THEN substr(lower(description), 3) ELSE lower(description) END
                          WHEN field = 'LINE_ITEM_QUANTITIES' THEN CASE WHEN (case_id + pos) % 6 = 0 THEN CAST(qty + 1 AS STRING) ELSE CAST(qty AS STRING) END ELSE CAST(CAST(amount AS DECIMAL(18,2)) AS STRING) END"""
ORDER_WANT = """CASE field WHEN 'SUPPLIER_NAME' THEN c_name WHEN 'TOTAL_AMOUNT' THEN CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS STRING) WHEN 'PAYER_NAME' THEN c_mktsegment || ' ' || o_orderpriority
                    WHEN 'BUSINESS_ABN' THEN CASE WHEN o_orderkey % 6 = 0 THEN 'NOT_FOUND' ELSE CAST(51824753000 + o_custkey AS STRING) END
                    ELSE CASE WHEN o_orderkey % 2 = 0 THEN 'true' ELSE 'false' END END"""
ORDER_GOT = """CASE WHEN (doc * 7 + length(field)) % 13 = 0 THEN 'NOT_FOUND'
                    WHEN field = 'IS_GST_INCLUDED' THEN CASE WHEN doc % 5 = 0 THEN 'no' ELSE upper(value) END
                    WHEN (doc + length(field)) % 5 = 0 AND value <> 'NOT_FOUND' THEN substr(value, 1, CAST(length(value) - 1 AS INT)) || '9'
                    WHEN (doc + length(field)) % 7 = 0 THEN 'wrong'
                    ELSE value END"""
FLAG_TOTALS = """CASE WHEN (case_id + pos) % 8 = 0 THEN 'n/a' WHEN (case_id + pos) % 6 = 0 THEN '$' || CAST(qty * 10 + 3 AS STRING) ELSE CAST(qty * 10 AS STRING) || '.00' END"""
FLAG_PRICES = """CASE WHEN case_id % 10 = 3 AND pos = 2 THEN NULL ELSE '$10.00' END"""
FLAG_ORDERS = """CASE f WHEN 'GST_AMOUNT' THEN CASE WHEN o_orderkey % 7 = 0 THEN '5.00' ELSE '$10.00' END WHEN 'SUBTOTAL_AMOUNT' THEN CASE o_orderkey % 5 WHEN 0 THEN 'NOT_FOUND' ELSE '100' END WHEN 'TOTAL_AMOUNT' THEN CASE WHEN o_orderkey % 11 = 0 THEN 'abc' ELSE '$110.00' END
            ELSE CASE o_orderkey % 3 WHEN 0 THEN 'True' WHEN 1 THEN 'false' ELSE 'maybe' END END"""

VIEWS = {
    "bank_rows": """
        SELECT l_orderkey AS case_id,
               CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_shipdate, l_extendedprice) AS BIGINT) AS pos,
               CAST(l_shipdate AS DATE) AS txn_date, upper(p_name) || ' ' || substr(p_brand, 7) AS description,
               l_extendedprice AS amount, l_returnflag AS flag, CAST(l_quantity AS BIGINT) AS qty, l_partkey AS part_id
        FROM lineitem JOIN part ON l_partkey = p_partkey""",
    "receipts": """
        SELECT case_id, pos AS rid,
               CASE WHEN (case_id + pos) % 5 = 0 THEN substr(description, 1, strpos_(description, ' ') - 1) || ' OUTLET' ELSE lower(description) END AS supplier,
               CASE WHEN (case_id * 3 + pos) % 11 = 0 THEN NULL ELSE txn_date + CAST((case_id + pos * 2) % 9 AS INT) END AS receipt_date,
               CASE WHEN (case_id + pos) % 13 = 0 THEN NULL WHEN (case_id + pos) % 7 = 0 THEN amount + 5 WHEN (case_id + pos) % 7 = 1 THEN amount + 0.004 ELSE amount END AS total
        FROM bank_rows WHERE (case_id * 31 + pos) % 3 = 0""",
    "amount_texts": """
        SELECT case_id, pos, amount,
               CASE (case_id + pos) % 8 WHEN 0 THEN '$' || t WHEN 1 THEN '(' || t || ')' WHEN 2 THEN '-$' || t WHEN 3 THEN ' ' || t || ' ' WHEN 4 THEN 'NOT_FOUND'
                    WHEN 5 THEN t || ' CR' WHEN 6 THEN substr(t, 1, 2) || ',' || substr(t, 3) ELSE 'N/A' END AS text
        FROM (SELECT case_id, pos, amount, CAST(CAST(amount AS DECIMAL(18,2)) AS STRING) AS t FROM bank_rows)""",
    "date_texts": """
        SELECT case_id, pos, txn_date,
               CASE (case_id + pos) % 7
                 WHEN 0 THEN y || '-' || lpad(m, 2, '0') || '-' || lpad(d, 2, '0')
                 WHEN 1 THEN d || '/' || m || '/' || y
                 WHEN 2 THEN d || '-' || m || '-' || substr(y, 3)
                 WHEN 3 THEN d || ' ' || mon || ' ' || y
                 WHEN 4 THEN d || ' ' || lower(mon) || ' ' || substr(y, 3)
                 WHEN 5 THEN '31.2.' || y
                 ELSE 'NOT_FOUND' END AS text
        FROM (SELECT case_id, pos, txn_date, CAST(year(txn_date) AS STRING) AS y, CAST(month(txn_date) AS STRING) AS m, CAST(day(txn_date) AS STRING) AS d,
                     substr('JanFebMarAprMayJunJulAugSepOctNovDec', CAST(month(txn_date) * 3 - 2 AS INT), 3) AS mon FROM bank_rows)""",
    "register": """
        SELECT case_id, pos, txn_date, description, amount, flag, balance_of AS true_balance,
               CASE WHEN (case_id + pos * 7) % 11 = 0 THEN NULL ELSE balance_of END AS balance,
               CASE WHEN (flag = 'R') <> ((case_id + pos) % 5 = 0) THEN 0.0 ELSE amount END AS debit,
               CASE WHEN (flag = 'R') <> ((case_id + pos) % 5 = 0) THEN amount ELSE 0.0 END AS credit
        FROM (SELECT *, round(10000.0 + sum(CASE WHEN flag = 'R' THEN amount ELSE -amount END) OVER (PARTITION BY case_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 2) AS balance_of FROM bank_rows)""",
    "gt_fields": f"""
        SELECT o_orderkey AS doc, field,
               {ORDER_WANT} AS value
        FROM orders JOIN customer ON o_custkey = c_custkey
        CROSS JOIN (SELECT 'SUPPLIER_NAME' AS field UNION ALL SELECT 'TOTAL_AMOUNT' UNION ALL SELECT 'PAYER_NAME' UNION ALL SELECT 'BUSINESS_ABN' UNION ALL SELECT 'IS_GST_INCLUDED')""",
    "pred_fields": f"""
        SELECT doc, field,
               {ORDER_GOT} AS value
        FROM gt_fields""",
    "item_pairs": """
        SELECT case_id AS doc, pos, description AS want, CASE WHEN (case_id + pos) % 7 = 0 THEN NULL WHEN (case_id + pos) % 5 = 0 THEN lower(description) || ' x' WHEN (case_id * 3 + pos) % 11 = 0 THEN 'lamp ' || CAST(pos AS STRING) ELSE description END AS got FROM bank_rows""",
    "messy_values": """
        SELECT doc, field, CASE (doc + length(field)) % 11 WHEN 0 THEN '** ' || value WHEN 1 THEN value || ' each' WHEN 2 THEN 'AUD ' || value WHEN 3 THEN NULL WHEN 4 THEN 'n/a' WHEN 5 THEN ''
               WHEN 6 THEN '  ' || value || ' ,' WHEN 7 THEN 'ABN: ' || value WHEN 8 THEN value || '**' WHEN 9 THEN value || ' - P: (03) 9999 1234' ELSE value END AS raw FROM gt_fields
        UNION ALL SELECT CAST(-n AS BIGINT) AS doc, field, raw FROM (VALUES (1, 'LINE_ITEM_PRICES', '$1.50 $2.75 | NOT_FOUND'), (2, 'LINE_ITEM_PRICES', 'NOT_FOUND | NOT_FOUND'), (3, 'LINE_ITEM_DESCRIPTIONS', 'apple, pear,, fig'),
            (4, 'TRANSACTION_AMOUNTS_PAID', '$8,026.87, $12.00'), (5, 'LINE_ITEM_QUANTITIES', '** 1 | | 2 ea ;'), (6, 'BUSINESS_ADDRESS', '1 / 92 Watt Road, Mornington,  VIC 3931 - P: (03) 5975 1234'), (7, 'BUSINESS_ADDRESS', '7 High St - shop@mail.com.au'),
            (8, 'PAYER_ADDRESS', '5 Low St 51 824 753 556'), (9, 'BUSINESS_ABN', 'ABN: 51 824 753 556'), (10, 'ACCOUNT_ID', 'BSB 123-456'), (11, 'INVOICE_DATE', ' 1 / 2 / 2024 '), (12, 'INVOICE_DATE', '**3 - Mar - 24'),
            (13, 'DOCUMENT_TYPE', '** Tax Invoice'), (14, 'DOCUMENT_TYPE', 'Credit Card Statement'), (15, 'DOCUMENT_TYPE', 'memo'), (16, 'TOTAL_AMOUNT', 'US 12.50 per  item'), (17, 'TOTAL_AMOUNT', 'total $$1,234.50'), (18, 'GST_AMOUNT', '3.20 EA.'),
            (19, 'SUPPLIER_NAME', '  '), (20, 'SUPPLIER_NAME', '* Ace  Hardware ;'), (21, 'JOURNEY_DATES', '1/2/24 | 3/2/24'), (22, 'ITEMS', 'a | **'), (23, 'PAYER_ADDRESS', '9 End Rd 0412 345 678'), (24, 'LINE_ITEM_TOTAL_PRICES', '10 each, 20 each')) AS t(n, field, raw)""",
    "date_shapes": """
        SELECT CAST(case_id * 16 + pos AS BIGINT) AS n, text FROM date_texts
        UNION ALL SELECT CAST(-n * 10 - k AS BIGINT) AS n, text FROM (SELECT n, 0 AS k, text FROM (VALUES (1, '03/05/2025'), (2, '13/05/2025'), (3, '05/23/2025'), (4, 'Thu 04 Sep 2025'), (5, '04-Sep-25'), (6, '4-9-2025'), (7, '20 May'), (8, '31 Feb 2024'), (9, ''),
            (10, 'paid on 04 Sep 2025'), (11, '04/09/25'), (12, '06 aug 70')) AS t(n, text)
            UNION ALL SELECT n, 1 AS k, text FROM (VALUES (1, '1 February 2024 - 28 June 2024'), (2, '01/02/2024 to 28/06/2024'), (3, '28 June 2024'), (4, 'Fri 28 June 2023'), (5, '28/06/2024 - 28/06/2024'), (6, '1-2-24'), (7, 'Feb 2024'), (8, '12'), (9, '2024-03-18'), (10, '3/5')) AS u(n, text))""",
    "header_texts": """
        SELECT o_orderkey AS doc, CASE o_orderkey % 8 WHEN 0 THEN 'Headers:' || chr(10) || '1. Date' || chr(10) || '- Description' || chr(10) || '* **Debit**' || chr(10) || 'Credit' || chr(10) || 'Balance'
               WHEN 1 THEN 'Date, Transaction Details, Amount, Balance' WHEN 2 THEN 'Date | Particulars | Withdrawal | Deposit' WHEN 3 THEN 'Date' || chr(10) || 'Debits/Credits (-)' || chr(10) || 'Running Balance'
               WHEN 4 THEN 'CreditsDebits' || chr(10) || 'Posted' WHEN 5 THEN 'no columns can be made out in this picture at all' WHEN 6 THEN 'Value' || chr(10) || chr(10) || 'xy' || chr(10) || 'Details' ELSE 'Date, Desc' || chr(10) || 'Paid Out' END AS raw
        FROM orders""",
    "register_lists": f"""
        SELECT case_id AS doc, 'bank_statement' AS doc_type, field, joined_(want, pos) AS want, joined_(got, gpos) AS got
        FROM (SELECT case_id, pos, field, CASE WHEN case_id % 3 = 1 THEN -pos ELSE pos END AS gpos,
                     {REGISTER_WANT} AS want,
                     {REGISTER_GOT} AS got
              FROM (SELECT *, {REGISTER_PARTS} FROM bank_rows)
              CROSS JOIN (SELECT 'TRANSACTION_DATES' AS field UNION ALL SELECT 'LINE_ITEM_DESCRIPTIONS' UNION ALL SELECT 'TRANSACTION_AMOUNTS_PAID' UNION ALL SELECT 'ACCOUNT_BALANCE') AS fs)
        GROUP BY case_id, field""",
    "statement_lists": """
        SELECT case_id AS doc, joined_(d, pos) AS dates, joined_(b, pos) AS balances, joined_(t, pos) AS descriptions, joined_(p, pos) AS paid, joined_(r, pos) AS received
        FROM (SELECT case_id, pos,
                     CASE WHEN (case_id + pos) % 13 = 0 THEN 'soon' WHEN case_id % 3 = 0 THEN dd || '/' || mm || '/' || y WHEN case_id % 3 = 1 THEN 'Thu ' || dd || ' ' || mon || ' ' || y ELSE y || '-' || mm || '-' || dd END AS d,
                     CASE WHEN balance IS NULL THEN CASE WHEN case_id % 2 = 0 THEN 'n/a' ELSE '' END ELSE '$' || CAST(CAST(balance AS DECIMAL(18,2)) AS STRING) || ' CR' END AS b,
                     description || CASE (case_id + pos) % 5 WHEN 0 THEN ' SALARY' WHEN 1 THEN ' EFTPOS purchase' WHEN 2 THEN ' Refund fee' ELSE '' END AS t,
                     CASE WHEN case_id % 17 = 0 THEN 'illegible' WHEN debit = 0 THEN 'NOT_FOUND' WHEN case_id % 7 = 0 THEN '-$' || CAST(CAST(debit AS DECIMAL(18,2)) AS STRING) ELSE '$' || CAST(CAST(debit AS DECIMAL(18,2)) AS STRING) END AS p,
                     CASE WHEN credit = 0 OR (case_id + pos) % 4 = 0 THEN 'NOT_FOUND' ELSE CAST(CAST(credit AS DECIMAL(18,2)) AS STRING) END AS r
              FROM (SELECT *, lpad(CAST(day(txn_date) AS STRING), 2, '0') AS dd, lpad(CAST(month(txn_date) AS STRING), 2, '0') AS mm, CAST(year(txn_date) AS STRING) AS y,
                           substr('JanFebMarAprMayJunJulAugSepOctNovDec', CAST(month(txn_date) * 3 - 2 AS INT), 3) AS mon FROM register)) GROUP BY case_id
        UNION ALL SELECT -doc AS doc, dates, balances, descriptions, paid, received FROM (VALUES (1, '01/02/2024 | 01/02/2024 | 31/01/2024', '$5.00 | $3.00 | $9.00', 'b | c | a', '1 | 2 | 3', 'NOT_FOUND | NOT_FOUND | NOT_FOUND'), (2, '', '$1', 'x', '1', '2'), (3, '01/02/2024 | 02/02/2024', 'NOT_FOUND', 'x', '1', '2'),
            (4, 'Thu 01 Feb 2024 Fri 02 Feb 2024', '$10.00 CR $7.50', 'NOT_FOUND', '$2.50 and $1', 'NOT_FOUND'), (5, '01/02/2024 03/02/2024 02/02/2024', '100 90 95.5', 'one | two', 'NOT_FOUND', NULL), (6, '1-2-24, 2-2-24', '$1 | $2', 'x | y', '1-2 | 3', 'a | b'), (7, '01/02/2024 |', '$4.00 | $2.00 | $1.00', '', '', ''),
            (8, '01/02/2024 | 02/02/2024', '$4.00 | $4.00', 'ATM | pension', 'NOT_FOUND | 3', '2 | NOT_FOUND'), (9, NULL, NULL, NULL, NULL, NULL), (10, '2024-02-01 | 2024-02-02 | 2024-02-03', '$5.00 | oops | $8.00', 'x | | z', '$1.00 | | NOT_FOUND', '| 3 |')) AS t(doc, dates, balances, descriptions, paid, received)""",
    "link_records": """
        SELECT case_id AS image, pos AS k, CASE WHEN (case_id + pos) % 6 = 0 THEN NULL ELSE floor(amount / 5000) * 5000.0 + (case_id + pos * 3) % 7 END AS total, (case_id + pos) % 4 <> 0 AS matched, CASE (case_id + pos) % 3 WHEN 0 THEN 'HIGH' WHEN 1 THEN 'LOW' ELSE 'NONE' END AS confidence,
               CASE WHEN (case_id + pos) % 9 = 0 THEN NULL ELSE amount END AS amount, CASE WHEN pos % 5 = 0 THEN '' ELSE CAST(txn_date AS STRING) END AS date, CASE WHEN pos % 4 = 0 THEN NULL ELSE lower(substr(description, 1, 9)) || ' x' END AS description
        FROM bank_rows WHERE case_id % 8 <> 0 AND pos < 6""",
    "link_truth": """
        SELECT case_id AS image, pos AS k, CASE WHEN (case_id * 3 + pos) % 5 = 0 THEN NULL ELSE floor(amount / 5000) * 5000.0 + (case_id + pos) % 5 END AS total, CASE WHEN (case_id * 5 + pos) % 4 = 0 THEN 'NOT_FOUND' ELSE 'FOUND' END AS expected,
               CASE WHEN (case_id + pos) % 7 = 0 THEN amount + 9 ELSE amount END AS amount, CASE WHEN (case_id + pos) % 10 = 0 THEN NULL ELSE CAST(txn_date AS STRING) END AS date, description
        FROM bank_rows WHERE case_id % 10 <> 1""",
    "block_lines": """
        SELECT case_id AS doc, pos * 10 + k AS i,
               CASE k WHEN 0 THEN CASE WHEN case_id % 12 = 5 THEN 'no header' WHEN pos % 3 = 0 THEN 'receipt ' || p WHEN pos % 3 = 1 THEN '--- RECEIPT ' || p || ' ---' ELSE '  ---Receipt   ' || p END
               WHEN 1 THEN CASE WHEN (case_id + pos) % 6 = 0 THEN '' WHEN (case_id + pos) % 7 = 1 THEN 'RECEIPT_STORE: [Next Purchase]' WHEN (case_id + pos) % 7 = 2 THEN 'RECEIPT_STORE: Unknown' ELSE ' receipt_store : ' || description END WHEN 2 THEN 'STORE: ' || description || ': x'
               WHEN 3 THEN CASE WHEN pos % 2 = 0 THEN 'total: ' || amt ELSE 'TRANSACTION_AMOUNT: $' || amt END WHEN 4 THEN CASE WHEN pos % 4 = 0 THEN 'CONFIDENCE' ELSE 'Confidence: HIGH' END WHEN 5 THEN 'MATCHED_TRANSACTION: ' || CASE WHEN flag = 'R' THEN 'NOT_FOUND' ELSE 'FOUND' END
               WHEN 6 THEN CASE WHEN (case_id + pos) % 5 = 0 THEN 'STORE: again' ELSE 'anything: else' END WHEN 7 THEN 'DATE:' ELSE '' END AS line
        FROM (SELECT *, CAST(pos AS STRING) AS p, CAST(CAST(amount AS DECIMAL(18,2)) AS STRING) AS amt FROM bank_rows)
        CROSS JOIN (SELECT 0 AS k UNION ALL SELECT 1 UNION ALL SELECT 2 UNION ALL SELECT 3 UNION ALL SELECT 4 UNION ALL SELECT 5 UNION ALL SELECT 6 UNION ALL SELECT 7 UNION ALL SELECT 8) AS ks
        UNION ALL SELECT -doc AS doc, i, line FROM (VALUES (1, 1, 'STORE: before any block'), (1, 2, 'RECEIPT 1'), (1, 3, 'RECEIPT 2'), (1, 4, 'STORE: b'), (1, 5, 'store: c'), (2, 1, 'RECEIPT'), (2, 2, 'STORE: none'), (3, 1, 'RECEIPT 9 and more'), (3, 2, 'TOTAL: 1:2'), (3, 3, 'RECEIPT_STORE: Shop'), (4, 1, '')) AS t(doc, i, line)""",
    "cut_json": """
        SELECT c_custkey AS doc, substr(raw, 1, CAST((c_custkey * 13) % (length(raw) + 1) AS INT)) AS raw
        FROM (SELECT c_custkey, '```json' || chr(10) || '{ "name": "' || c_name || '", "n": ' || CAST(c_custkey AS STRING) || CASE WHEN c_custkey % 4 = 0 THEN '  "seg": [ "' ELSE ', "seg": [ "' END || c_mktsegment || '", "x y", ]' || chr(10) || ', "o": {"k": {}, "b": "' || substr(c_name, 10) || '"}, "ok": true, "f": -1.5 } ``` and {more}' AS raw FROM customer)
        UNION ALL SELECT -doc AS doc, raw FROM (VALUES (1, ''), (2, NULL), (3, 'no object'), (4, '{'), (5, '{"a"'), (6, '{"a": tru'), (7, '{"a": [[], {'), (8, '{"a": "b"}'), (9, '{"a": 1 2'), (10, 'text { "k" : [1, {"z": "w'), (11, '{"a": "b" "c": "d')) AS t(doc, raw)""",
    "trust_nodes": """
        SELECT case_id, kind, CASE WHEN case_id % 3 = 0 AND kind = 'trust_return' THEN '51 824 753 557' ELSE '51 824 753 556' END AS abn, CASE WHEN (case_id + length(kind)) % 4 = 1 THEN '' ELSE '123 456 ' || CAST(case_id % 1000 + CASE WHEN case_id % 6 = 0 THEN length(kind) ELSE 0 END AS STRING) END AS tfn,
               CASE WHEN (case_id + length(kind)) % 9 = 0 THEN NULL ELSE CAST(floor(income) AS BIGINT) END AS income, CAST(floor(franking) AS BIGINT) AS franking, CASE WHEN kind = 'beneficiary_itr' THEN NULL ELSE CAST(floor(cgt) AS BIGINT) END AS cgt
        FROM trust_docs WHERE case_id % 25 <> 3""",
    "answer_texts": """
        SELECT o_orderkey AS doc, CASE o_orderkey % 11
               WHEN 0 THEN '1. COLUMNS: Date | Narrative | Dr | Cr | Bal' || chr(10) || '2. PAID: NO' || chr(10) || '3. ROWS: 12'
               WHEN 1 THEN '<think>no table with headers like Date, Description, Debit</think>COLUMNS: NONE' || chr(10) || '**PAID**: YES' || chr(10) || 'ROWS: 3'
               WHEN 2 THEN '### 1. COLUMNS' || chr(10) || '```' || chr(10) || 'Day | Details | Withdrawals | Deposits' || chr(10) || '```' || chr(10) || '### 4. TRAVEL' || chr(10) || 'Answer YES or NO. The answer: NO'
               WHEN 3 THEN 'COLUMNS: NONE' || chr(10) || '### 4. TRAVEL' || chr(10) || 'It is a ticket, so no doubt: YES' WHEN 4 THEN '4) TRAVEL: YES' || chr(10) || '1) COLUMNS: **NONE**' || chr(10) || 'PAID: YES'
               WHEN 5 THEN 'It has columns like Date, Debit and Credit.' WHEN 6 THEN 'a tax invoice' WHEN 7 THEN '<think>COLUMNS: Debit | Credit | Balance' WHEN 8 THEN '- COLUMNS: `Qty, Unit Price, GST amount, Total`' || chr(10) || 'rows : 21' || chr(10) || 'PAID: maybe'
               WHEN 9 THEN '' ELSE 'COLUMNS: Date | Odometer | Purpose of trip' || chr(10) || 'ROWS: 5' || chr(10) || 'TRAVEL: NO' END AS raw FROM orders""",
    "trust_answers": """
        SELECT c_custkey AS doc, CASE c_custkey % 9
               WHEN 0 THEN '1. HEADER: Trust Income Tax Return' || chr(10) || '2. HAS_ABN: YES' || chr(10) || '5. HAS_ITEM_13: NO' WHEN 1 THEN '1. HEADER: What is the main title?' || chr(10) || '   - **Income Schedule 2024**' || chr(10) || '2. HAS_ABN: Is there a number? Answer YES or NO.' || chr(10) || '   - **NO**'
               WHEN 2 THEN 'header: Notice' || chr(10) || 'HAS_DISTRIBUTION_TABLE: YES' || chr(10) || 'ADDRESSED_TO: yes' WHEN 3 THEN 'HAS_ITEM_13: Does it? Answer YES or NO.' || chr(10) || ' - YES' WHEN 4 THEN 'It is the individual tax return of someone' WHEN 5 THEN ''
               WHEN 6 THEN 'HEADER:' || chr(10) || 'HAS_ABN: YES' || chr(10) || 'HEADER: The Smith Trust' WHEN 7 THEN 'HAS_ITEM_13: YES' || chr(10) || 'HAS_ITEM_13: NO' || chr(10) || 'HEADER: Beneficiary Distribution' ELSE 'the trustee details of somebody, HAS_ABN: NO' END AS raw FROM customer""",
    "flag_fields": f"""
        SELECT doc, field, want AS value FROM bought_lists WHERE field <> 'LINE_ITEM_TOTAL_PRICES'
        UNION ALL SELECT -case_id - 1, 'LINE_ITEM_TOTAL_PRICES', joined_(t, pos) FROM (SELECT case_id, pos, {FLAG_TOTALS} AS t FROM bank_rows) GROUP BY case_id
        UNION ALL SELECT -case_id - 1, 'LINE_ITEM_PRICES', joined_(t, pos) FROM (SELECT case_id, pos, {FLAG_PRICES} AS t FROM bank_rows) GROUP BY case_id
        UNION ALL SELECT o_orderkey, f, {FLAG_ORDERS} FROM orders CROSS JOIN (SELECT 'GST_AMOUNT' AS f UNION ALL SELECT 'SUBTOTAL_AMOUNT' UNION ALL SELECT 'TOTAL_AMOUNT' UNION ALL SELECT 'IS_GST_INCLUDED') AS fs
        UNION ALL SELECT doc + 100000000, field, want FROM register_lists WHERE NOT (doc % 6 = 0 AND field = 'TRANSACTION_DATES')
        UNION ALL SELECT DISTINCT doc + 100000000, 'DOCUMENT_TYPE', CASE WHEN doc % 4 = 0 THEN 'Statement' ELSE 'bank_statement' END FROM register_lists
        UNION ALL SELECT doc + 100000000, 'TRANSACTION_DATES', 'one | ' FROM register_lists WHERE doc % 6 = 0 AND field = 'TRANSACTION_DATES'""",
    "bought_lists": f"""
        SELECT -case_id - 1 AS doc, 'invoice' AS doc_type, field, joined_(want, pos) AS want, joined_(got, pos) AS got
        FROM (SELECT case_id, pos, field, {BOUGHT_WANT} AS want,
                     {BOUGHT_GOT} AS got
              FROM bank_rows CROSS JOIN (SELECT 'LINE_ITEM_DESCRIPTIONS' AS field UNION ALL SELECT 'LINE_ITEM_QUANTITIES' UNION ALL SELECT 'LINE_ITEM_TOTAL_PRICES') AS fs)
        GROUP BY case_id, field""",
    "doc_values": """
        SELECT doc, doc_type, field, want, CASE WHEN got = '' THEN NULL ELSE got END AS got FROM register_lists
        UNION ALL SELECT doc, doc_type, field, want, CASE WHEN got = '' THEN NULL ELSE got END AS got FROM bought_lists
        UNION ALL SELECT -g.doc - 1, 'invoice', g.field, g.value, p.value FROM gt_fields g JOIN pred_fields p ON g.doc = p.doc AND g.field = p.field""",
    "statement_lines": """
        SELECT case_id AS doc, pos * 8 + k AS i,
               CASE k WHEN 0 THEN CASE case_id % 7 WHEN 0 THEN p || '. **Date:** ' || dmy WHEN 1 THEN '**' || dmy || '**' WHEN 2 THEN p || '. **' || d || ' ' || mon || ' ' || y || '**' WHEN 3 THEN p || '. [' || d || ' ' || mon || ']'
                      WHEN 4 THEN CASE WHEN pos % 2 = 0 THEN '' ELSE p || '. ' || d || ' ' || mon || ' ' || substr(y, 3) END WHEN 5 THEN 'date ' || dmy || '**' ELSE p || '. **Thu ' || d || ' ' || mon || ' ' || y || '**' END
               WHEN 1 THEN CASE case_id % 3 WHEN 0 THEN '  - Description: ' WHEN 1 THEN '**Transaction:** ' ELSE '* Details: ' END || description
               WHEN 2 THEN CASE WHEN (case_id + pos) % 4 = 0 THEN '     - Perth WA' WHEN (case_id + pos) % 4 = 1 THEN '   - Card: xx' || p ELSE ' ' END
               WHEN 3 THEN CASE WHEN case_id % 4 = 0 THEN '  * Amount: -' || amt WHEN flag = 'R' THEN '- Credit: $' || amt WHEN case_id % 2 = 1 THEN '**Withdrawal Amount:** $' || amt ELSE '- DEBIT : ' || amt END
               WHEN 4 THEN CASE WHEN pos % 3 = 0 THEN '- Balance: ' || amt WHEN pos % 3 = 1 THEN 'nothing to read' ELSE '* Running balance: ' || amt END ELSE '- ' || lower(substr(description, 1, 4)) END AS line
        FROM (SELECT *, CAST(pos AS STRING) AS p, CAST(day(txn_date) AS STRING) AS d, CAST(year(txn_date) AS STRING) AS y, lpad(CAST(day(txn_date) AS STRING), 2, '0') || '/' || lpad(CAST(month(txn_date) AS STRING), 2, '0') || '/' || CAST(year(txn_date) AS STRING) AS dmy,
                     substr('JanFebMarAprMayJunJulAugSepOctNovDec', CAST(month(txn_date) * 3 - 2 AS INT), 3) AS mon, CAST(CAST(amount AS DECIMAL(18,2)) AS STRING) AS amt FROM bank_rows)
        CROSS JOIN (SELECT 0 AS k UNION ALL SELECT 1 UNION ALL SELECT 2 UNION ALL SELECT 3 UNION ALL SELECT 4 UNION ALL SELECT 5) AS ks WHERE NOT (k = 5 AND case_id % 5 <> 0)
        UNION ALL SELECT -doc AS doc, i, line FROM (VALUES (1, 1, '- Description: before any date'), (1, 2, '- Amount: 3'), (1, 3, '1. **03/05/2025**'), (1, 4, '- Details: after'), (2, 1, '- Description: one'), (2, 2, '- Description: two'), (2, 3, '**Date:** 1/2/24'), (2, 4, '- Debit: 5'),
            (3, 1, '1. **Date:** **'), (3, 2, '1. **20 September**'), (3, 3, '- more'), (3, 4, '- still more'), (3, 5, '- Credit: 1'), (3, 6, '- not more'), (4, 1, 'no rows at all'), (5, 1, '1. 04 Sep 2025 and text'), (5, 2, '- Amount: 9'), (5, 3, '- Debit: 8'), (5, 4, '- Amount: 7'), (5, 5, '- :x'),
            (6, 1, '2. 1-2-24'), (6, 2, '- SHOP SYDNEY'), (6, 3, '- Card xx1'), (6, 4, '- Value Date: 2'), (6, 5, '- not this'), (6, 6, '- Balance: 4'), (7, 1, '**Date:** 1/1/24'), (7, 2, '**Date:** 2/1/24'), (7, 3, '* Withdrawwal: 3'), (7, 4, '**  :** 3')) AS t(doc, i, line)""",
    "gt_items": """
        SELECT case_id AS doc, pos, CAST(CAST(amount AS DECIMAL(18,2)) AS STRING) AS item FROM bank_rows""",
    "pred_items": """
        SELECT doc, CAST(row_number() OVER (PARTITION BY doc ORDER BY pos) AS BIGINT) AS pos, item
        FROM (SELECT case_id AS doc, pos, CAST(CAST(CASE WHEN (case_id + pos * 3) % 7 = 0 THEN amount + 100 ELSE amount END AS DECIMAL(18,2)) AS STRING) AS item FROM bank_rows WHERE (case_id * 5 + pos) % 9 <> 0)""",
    "trust_docs": """
        SELECT c_custkey AS case_id, kind, conf AS confidence,
               CASE WHEN c_custkey % 4 = 0 AND kind = 'beneficiary_itr' THEN income * 0.8 WHEN c_custkey % 11 = 0 AND kind = 'trust_return' THEN income * 1.2 ELSE income END AS income,
               CASE WHEN c_custkey % 5 = 0 AND kind = 'beneficiary_itr' THEN franking * 1.3 ELSE franking END AS franking,
               CASE WHEN c_custkey % 7 = 0 AND kind = 'income_schedule' THEN 0.0 ELSE cgt END AS cgt,
               CASE WHEN c_custkey % 3 = 0 AND kind = 'trust_return' THEN '51824753557' ELSE '51824753556' END AS abn
        FROM (SELECT c_custkey, kind, 0.5 + (c_custkey + length(kind)) % 5 / 10.0 AS conf, CAST(cents_(abs(c_acctbal)) AS DOUBLE) AS income, CAST(cents_(abs(c_acctbal) * 0.3) AS DOUBLE) AS franking, CAST(cents_(abs(c_acctbal) * 0.1) AS DOUBLE) AS cgt
              FROM customer CROSS JOIN (SELECT 'trust_return' AS kind UNION ALL SELECT 'distribution_stmt' UNION ALL SELECT 'income_schedule' UNION ALL SELECT 'beneficiary_itr')
              WHERE NOT (c_custkey % 9 = 0 AND kind = 'income_schedule'))""",
    "runs": """
        SELECT m AS model, o_orderkey AS doc, CASE o_orderkey % 4 WHEN 0 THEN 'clean' WHEN 1 THEN 'light' WHEN 2 THEN 'moderate' ELSE 'heavy' END AS tier,
               CASE o_orderkey % 3 WHEN 0 THEN 'receipt' WHEN 1 THEN 'invoice' ELSE 'bank_statement' END AS doc_type,
               CASE (o_orderkey + k) % 17 WHEN 0 THEN 'receipt' WHEN 1 THEN 'invoice' WHEN 2 THEN 'other' ELSE CASE o_orderkey % 3 WHEN 0 THEN 'receipt' WHEN 1 THEN 'invoice' ELSE 'bank_statement' END END AS predicted,
               'field_' || CAST((o_orderkey * 7 + k) % 5 AS STRING) AS field,
               CAST(((o_orderkey * 37 + k * 11) % 101) / 100.0 AS DOUBLE) AS f1, CAST(1 + ((o_orderkey * 13 + k) % 29) / 10.0 AS DOUBLE) AS seconds,
               CAST((o_orderkey * 37 + k * 11) % 101 AS BIGINT) AS tp, CAST((o_orderkey + k) % 7 AS BIGINT) AS fp, CAST((o_orderkey * 3 + k) % 5 AS BIGINT) AS fn
        FROM orders CROSS JOIN (SELECT 'alpha' AS m, 1 AS k UNION ALL SELECT 'beta', 2 UNION ALL SELECT 'gamma', 4)""",
}


def with_views(sql: str, dialect: str) -> str:
    """The query with a WITH item for every view it needs, in dependency order."""
    need: list[str] = []

    def add(text: str) -> None:
        for name in VIEWS:
            if re.search(rf"\b{name}\b", text) and name not in need:
                add(VIEWS[name])
                need.append(name)

    add(sql)
    items = ", ".join(f"{name} AS ({VIEWS[name]})" for name in need)
    items = items.replace("strpos_(", "strpos(" if dialect == "duckdb" else "instr(")
    # half a cent goes by the binary product in both; Spark's own round goes by the decimal digits of the number
    cents = r"round(\1, 2)" if dialect == "duckdb" else r"floor((\1) * 100 + 0.5) / 100"
    items = re.sub(r"cents_\(((?:[^()]|\([^()]*\))*)\)", cents, items)
    # sort_array compares by itself, array_sort by a lambda; the field of an array of rows needs none either
    joined = r"string_agg(\1, ' | ' ORDER BY \2)" if dialect == "duckdb" else r"array_join(sort_array(collect_list(struct(\2, \1))).\1, ' | ')"
    items = re.sub(r"joined_\((\w+), (\w+)\)", joined, items)
    if not items:
        return sql
    if sql.lstrip().upper().startswith("WITH RECURSIVE "):
        return f"WITH RECURSIVE {items}, {sql.lstrip()[15:]}"
    return f"WITH {items}, {sql[5:]}" if sql.lstrip().upper().startswith("WITH ") else f"WITH {items} {sql}"


def duck(sql: str) -> str:
    return with_views(sql.strip(), "duckdb")


def spark_sql(spark: SparkSession, sf_dir: str, sql: str) -> DataFrame:
    """A query over the views and tables of ``sf_dir``."""
    for name in TABLES:
        if re.search(rf"\b{name}\b", with_views(sql.strip(), "spark")):
            spark.read.parquet(f"{sf_dir}/{name}.parquet").createOrReplaceTempView(name)
    return spark.sql(with_views(sql.strip(), "spark"))


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark_sql(spark, sf_dir, f"SELECT * FROM {name}")
