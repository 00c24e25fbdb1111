"""Input views derived from the plain tables.

Each view is one SELECT that Spark and DuckDB both accept, so a query and its
check start from the same definition.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)

ACCOUNTS_BASE = """
SELECT c_custkey AS account_id,
       CASE WHEN c_acctbal < 0 THEN 'blocked' ELSE 'active' END AS status,
       CASE WHEN c_mktsegment = 'AUTOMOBILE' THEN 'gold'
            WHEN c_mktsegment IN ('FURNITURE','HOUSEHOLD') THEN 'silver'
            ELSE 'bronze' END AS tier,
       n_name AS region,
       c_acctbal AS balance,
       cast(0 as bigint) AS version,
       timestamp '2023-12-31 00:00:00' AS updated_at
FROM customer JOIN nation ON c_nationkey = n_nationkey
WHERE c_mktsegment <> 'BUILDING'
"""

# Customers of the segment that the base leaves out enter as inserts, before all events.
ACCOUNT_OPS = """
SELECT event_id AS seq,
       cast(least(floor((extract(day from ts) - 1) / 10) + 1, 3) AS bigint) AS round_no,
       user_id AS account_id,
       CASE event_type WHEN 'signup' THEN 'insert' WHEN 'error' THEN 'delete' ELSE 'update' END AS op,
       CASE event_type WHEN 'view' THEN 'blocked' WHEN 'click' THEN 'closed' ELSE 'active' END AS status,
       CASE event_id % 3 WHEN 0 THEN 'bronze' WHEN 1 THEN 'silver' ELSE 'gold' END AS tier,
       concat('R', cast(user_id % 27 AS string)) AS region,
       value AS balance,
       ts AS updated_at
FROM events
UNION ALL
SELECT -1 - c_custkey, cast(1 AS bigint), c_custkey, 'insert',
       CASE WHEN c_acctbal < 0 THEN 'blocked' ELSE 'active' END, 'bronze', n_name, c_acctbal,
       timestamp '2023-12-31 00:00:00'
FROM customer JOIN nation ON c_nationkey = n_nationkey
WHERE c_mktsegment = 'BUILDING'
"""

# The sections of a report hold a fifth of the text each; of a repeated section the last one counts.
REPORTS_RAW = """
SELECT doc_id,
  concat('triage/', source, '/Alert', cast(doc_id % 7 AS string), '/2026__', md5(cast(doc_id AS string)), '.md') AS path,
  CASE
    WHEN doc_id % 50 = 7 THEN concat_ws(chr(10), '---', 'namespace: "x"', '---', '', '## Sintoma', text)
    WHEN doc_id % 50 = 13 THEN concat_ws(chr(10), '---', concat('dedup_key: "', md5(cast(doc_id AS string)), '"'), '---', '')
    WHEN doc_id % 50 = 19 THEN concat_ws(chr(10), '---', concat('dedup_key: "', md5(cast(doc_id AS string)), '"'), 'never closed', '## Sintoma', text)
    WHEN doc_id % 50 = 23 THEN concat_ws(chr(10), '## Sintoma', text)
    WHEN doc_id % 50 = 29 THEN concat_ws(chr(10), '---', concat('dedup_key: "', md5(cast(doc_id AS string)), '"'), '---', text)
    ELSE concat_ws(chr(10),
      '---', 'schema: 1',
      concat('incident_key: "', md5(cast(doc_id AS string)), '"'),
      CASE WHEN doc_id % 10 = 3 THEN 'dedup_key: ""' ELSE concat('dedup_key: "', md5(cast(doc_id AS string)), '"') END,
      concat('group_key: "{}/{}:{ns=', chr(92), chr(34), source, chr(92), chr(34), '}', chr(92), chr(92), 'tmp"'),
      CASE WHEN doc_id % 4 = 0 THEN 'alertnames: []'
           WHEN doc_id % 4 = 1 THEN concat_ws(chr(10), 'alertnames:', concat('  - "', lang, '-A"'))
           ELSE concat_ws(chr(10), 'alertnames:', concat('  - "', lang, '-A"'), '  - "Common: B"') END,
      concat('namespace: "', source, '"'), 'fired_at: "2026-07-05T23:35:20Z"',
      'confirmation: confirmed', '---', '',
      'Preamble prose to drop.', '', '---', '',
      concat('# Triagem: Alert', cast(doc_id % 7 AS string), ' ', chr(96), 'svc', chr(96)), '',
      CASE WHEN doc_id % 3 = 0 THEN '## SINTOMAS' ELSE '## Sintoma' END,
      CASE WHEN doc_id % 11 = 0 THEN 'first symptom loses' ELSE substr(text, 1, fifth) END, '',
      CASE WHEN doc_id % 3 = 1 THEN '## Evidencia' ELSE '## Evidência' END, substr(text, 1 + fifth, fifth),
      concat(chr(96), chr(96), chr(96)), '## not a heading', 'kubectl get pods', concat(chr(96), chr(96), chr(96)),
      '### Nested', substr(text, 1 + 2 * fifth, fifth), '',
      '## Causa provável', substr(text, 1 + 3 * fifth, fifth), '',
      CASE WHEN doc_id % 3 = 2 THEN '## Próximos Passos' ELSE '## Próximo passo' END, substr(text, 1 + 4 * fifth), '',
      CASE WHEN doc_id % 11 = 0 THEN concat_ws(chr(10), '## Sintoma', substr(text, 1, fifth), '') ELSE '' END,
      '## Confiança', CASE doc_id % 4 WHEN 0 THEN 'Alta.' WHEN 1 THEN 'Média.' WHEN 2 THEN 'Baixa.' ELSE '' END)
  END AS content
FROM (SELECT *, cast(floor(length(text) / 5) AS int) AS fifth FROM documents) AS parts
"""

CONCLUSIONS_RAW = """
SELECT doc_id,
  concat('conclusions/src', cast(doc_id % 20 AS string), '/2026__', md5(cast(doc_id AS string)), '.md') AS path,
  concat_ws(chr(10), '---', 'schema: 1',
    CASE WHEN doc_id % 40 = 1 THEN 'other: x'
         WHEN doc_id % 40 = 2 THEN concat('dedup_key: "orphan-', cast(doc_id AS string), '"')
         ELSE concat('dedup_key: "', md5(cast(doc_id AS string)), '"') END,
    CASE WHEN doc_id % 40 = 3 THEN 'outcome: maybe' WHEN quality = 1 THEN 'outcome: diagnosed' ELSE 'outcome: inconclusive' END,
    CASE WHEN quality = 1 THEN concat('verdict: "Cause: ', chr(92), chr(34), 'q', chr(92), chr(34), ' ', cast(doc_id AS string),
                                     CASE WHEN doc_id % 40 = 5 THEN repeat('x', 300) ELSE '' END, '"')
         ELSE 'reason: "no data"' END,
    CASE WHEN quality <> 1 OR doc_id % 40 = 6 THEN 'note: none'
         WHEN doc_id % 40 = 7 THEN 'confidence: alta'
         WHEN toxic = 1 THEN 'confidence: low' WHEN doc_id % 2 = 0 THEN 'confidence: high' ELSE 'confidence: medium' END,
    '---', '', '## Rationale', '', 'because', '') AS content
FROM labels
"""

CONFIRMATIONS_RAW = """
SELECT doc_id,
  concat('confirmations/src', cast(doc_id % 20 AS string), '/2026__', md5(cast(doc_id AS string)), '.md') AS path,
  concat_ws(chr(10), '---', 'schema: 1',
    CASE WHEN doc_id % 20 = 5 THEN concat('dedup_key: orphan-', cast(doc_id AS string))
         ELSE concat('dedup_key: ', md5(cast(doc_id AS string))) END,
    CASE WHEN doc_id % 15 = 0 THEN 'confirmation: maybe' WHEN quality = 1 THEN 'confirmation: confirmed' ELSE 'confirmation: refuted' END,
    'confirmed_by: U0123ABC', 'confirmed_at: 2026-07-13T18:18:09Z', 'via: slack_modal', '---', '', '## Motivo', '', 'n') AS content
FROM labels
"""

COST_CALLS = """
SELECT event_id AS call_id, md5(cast(user_id AS string)) AS session_id, event_type AS span_name,
       CASE WHEN event_type = 'error' THEN NULL
            WHEN event_id % 17 = 0 THEN 'free'
            ELSE cast(value AS string) END AS raw_cost
FROM events
"""

# One commit per day, as a maintained table would have recorded them.
HISTORY = """
SELECT cast(extract(day from ts) AS bigint) AS version,
       CASE WHEN extract(day from ts) % 5 = 0 THEN 'OPTIMIZE' ELSE 'MERGE' END AS operation,
       max(ts) AS timestamp
FROM events
GROUP BY extract(day from ts)
"""

VIEWS = {
    "accounts_base": (ACCOUNTS_BASE, ("customer", "nation")),
    "account_ops": (ACCOUNT_OPS, ("events", "customer", "nation")),
    "reports_raw": (REPORTS_RAW, ("documents",)),
    "conclusions_raw": (CONCLUSIONS_RAW, ("labels",)),
    "confirmations_raw": (CONFIRMATIONS_RAW, ("labels",)),
    "cost_calls": (COST_CALLS, ("events",)),
    "history": (HISTORY, ("events",)),
}


# Declared, so that opening a table costs no job.
SCHEMAS = {
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "labels": "doc_id bigint, quality int, toxic int",
    "embeddings": "vec_id bigint, embedding array<float>, label int",
}

# Tables of long texts, read for parsing. A session may name a number of partitions for them, which are else
# those of the files: a single small file is one task otherwise.
TEXTS = ("documents",)
TEXT_PARTITIONS = "spark.changeflow.textPartitions"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    reader = spark.read.schema(SCHEMAS[name]) if name in SCHEMAS else spark.read
    frame = reader.parquet(f"{sf_dir}/{name}.parquet")
    parts = spark.conf.get(TEXT_PARTITIONS, None) if name in TEXTS else None
    return frame.repartition(int(parts)) if parts else frame


def register(spark: SparkSession, frames: dict[str, DataFrame]) -> None:
    """Name DataFrames for ad-hoc SQL."""
    for name, frame in frames.items():
        frame.createOrReplaceTempView(name)


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    sql, tables = VIEWS[name]
    # Frames are passed by name, so views of two folders in one session do not meet.
    named = re.sub(r"\b(FROM|JOIN) (\w+)", r"\1 {\2}", sql.replace("{", "{{").replace("}", "}}"))
    frame = spark.sql(named, **{t: table(spark, sf_dir, t) for t in tables})
    for column, kind in frame.dtypes:
        if kind == "timestamp_ntz":
            frame = frame.withColumn(column, F.col(column).cast("timestamp"))
    return frame
