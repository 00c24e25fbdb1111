"""The same queries as SQL for a second engine, written independently.

Parsing is done here with line numbers and window sums, packing with a
recursive query, merges with a full join: none of it follows the shape of the
Spark expressions it checks. Queries without an entry have no SQL equivalent
(random draws from a 64-bit hash, file sizes) and are tested in `tests/`.
"""

from __future__ import annotations

from changeflow.functions.text import WHITESPACE
from changeflow.sources.views import VIEWS

WS = f"'{WHITESPACE}'"
NL = "chr(10)"
RUN_ID = "20240201T000000Z"


def _with(body: str, *ctes: tuple[str, str]) -> str:
    return "WITH RECURSIVE " + ",\n".join(f"{name} AS ({sql})" for name, sql in ctes) + "\n" + body


def _view(name: str) -> tuple[str, str]:
    return name, VIEWS[name][0]


# -- table changes ---------------------------------------------------------

ACCOUNTS = _view("accounts_base")
OPS = _view("account_ops")


def _last(name: str, where: str = "true", order: str = "seq") -> tuple[str, str]:
    return name, f"""
        SELECT * EXCLUDE (rn) FROM (
          SELECT *, row_number() OVER (PARTITION BY account_id ORDER BY {order} DESC) AS rn
          FROM account_ops WHERE {where}) WHERE rn = 1"""


def _merge(state: str, ops: str, out: str, version: int) -> list[tuple[str, str]]:
    """CTEs `<out>_c` (change rows) and `<out>` (the new state)."""
    pair = f"""
        SELECT coalesce(t.account_id, s.account_id) AS account_id, t.account_id IS NOT NULL AS hit,
               coalesce(s.op, 'none') AS op,
               t.status, t.tier, t.region, t.balance, t.version,
               s.status AS s_status, s.tier AS s_tier, s.region AS s_region, s.balance AS s_balance
        FROM {state} t FULL JOIN {ops} s ON t.account_id = s.account_id"""
    old = "status, tier, region, balance, version"
    upd = "s_status AS status, tier, region, s_balance AS balance, version + 1 AS version"
    ins = "s_status AS status, s_tier AS tier, s_region AS region, s_balance AS balance, cast(0 AS bigint) AS version"
    v = f"cast({version} AS bigint) AS _commit_version"
    p = f"{out}_p"
    return [
        (p, pair),
        (
            f"{out}_c",
            f"""
        SELECT account_id, 'delete' AS _change_type, {old}, {v} FROM {p} WHERE hit AND op = 'delete'
        UNION ALL SELECT account_id, 'update_preimage', {old}, {v} FROM {p} WHERE hit AND op = 'update'
        UNION ALL SELECT account_id, 'update_postimage', {upd}, {v} FROM {p} WHERE hit AND op = 'update'
        UNION ALL SELECT account_id, 'insert', {ins}, {v} FROM {p} WHERE NOT hit AND op = 'insert'""",
        ),
        (
            out,
            f"""
        SELECT account_id, {old} FROM {p} WHERE hit AND op NOT IN ('delete', 'update')
        UNION ALL SELECT account_id, {upd} FROM {p} WHERE hit AND op = 'update'
        UNION ALL SELECT account_id, {ins} FROM {p} WHERE NOT hit AND op = 'insert'""",
        ),
    ]


ONE = [ACCOUNTS, OPS, _last("batch"), *_merge("accounts_base", "batch", "s1", 1)]
ROUNDS = [
    ACCOUNTS,
    OPS,
    _last("b1", "round_no = 1"),
    _last("b2", "round_no = 2"),
    _last("b3", "round_no = 3"),
    *_merge("accounts_base", "b1", "r1", 1),
    *_merge("r1", "b2", "r2", 2),
    *_merge("r2", "b3", "r3", 3),
]
STATE = "account_id, status, tier, region, balance, version"
NOT_PRE = "_change_type <> 'update_preimage'"


def _messages(source: str, kind: str = "_change_type", version: str = "_commit_version") -> str:
    return f"""SELECT cast(account_id AS varchar) AS key, account_id, {kind} = 'delete' AS deleted,
        {kind} AS change_type, cast({version} AS bigint) AS commit_version, balance FROM {source}"""


# What the consumer of hydrate (at 2) and live messages (1 to 3) ends up with.
UPSERT = [
    *ROUNDS,
    (
        "up",
        f"""SELECT r3.*, CASE WHEN c3.account_id IS NOT NULL THEN 3 ELSE 2 END AS v,
               coalesce(c3._change_type, c2._change_type, 'hydrate') AS kind
        FROM r3
        LEFT JOIN (SELECT * FROM r3_c WHERE {NOT_PRE}) c3 ON r3.account_id = c3.account_id
        LEFT JOIN (SELECT * FROM r2_c WHERE {NOT_PRE}) c2 ON r3.account_id = c2.account_id""",
    ),
]
VIEW_COLUMNS = "SELECT account_id, status, balance, version, cast(v AS bigint) AS commit_version FROM up"

HISTORY = _view("history")
NOW = "timestamp '2024-02-01 00:00:00'"
HOURS = f"""round((epoch_us({NOW}) - epoch_us(max(timestamp))) / 3.6e9, 6)"""


TABLE_CHANGES = {
    "last_op_per_key": _with("SELECT account_id, op, status, tier, region, balance FROM batch", OPS, _last("batch")),
    "op_mix": _with("SELECT op, count(*) AS n FROM batch GROUP BY op", OPS, _last("batch")),
    "max_key": _with("SELECT coalesce(max(account_id), -1) AS m FROM accounts_base", ACCOUNTS),
    "dup_keys": _with("SELECT account_id, count(*) AS n FROM account_ops GROUP BY account_id HAVING count(*) > 1", OPS),
    "batch_diff": _with(
        """SELECT 'left' AS side, * FROM (SELECT account_id, op FROM x EXCEPT ALL SELECT account_id, op FROM y)
        UNION ALL
        SELECT 'right' AS side, * FROM (SELECT account_id, op FROM y EXCEPT ALL SELECT account_id, op FROM x)""",
        OPS,
        _last("x"),
        _last("y", order="(balance, seq)"),
    ),
    "change_rows": _with(
        "SELECT account_id, _change_type, status, tier, region, balance, version, _commit_version FROM s1_c", *ONE
    ),
    "merge_round": _with(f"SELECT {STATE} FROM s1", *ONE),
    "two_rounds": _with(f"SELECT {STATE} FROM r2", *ROUNDS),
    "state_as_of": _with(f"SELECT {STATE} FROM r2", *ROUNDS),
    "state_current": _with(f"SELECT {STATE} FROM r3", *ROUNDS),
    "adhoc_sql": _with(
        "SELECT region, count(*) AS n, round(sum(balance), 2) AS balance FROM r3 GROUP BY region", *ROUNDS
    ),
    "flagship": _with(
        "SELECT region, count(*) AS n, round(sum(balance), 2) AS balance FROM s1 GROUP BY region", *ONE
    ),
    "cdf_messages": _with(_messages(f"s1_c WHERE {NOT_PRE}"), *ONE),
    "cdf_stream": _with(
        _messages("r2", "'insert'", "2") + " UNION ALL " + _messages(f"r3_c WHERE {NOT_PRE}"), *ROUNDS
    ),
    "hydrate_messages": _with(_messages("r3", "'hydrate'", "3"), *ROUNDS),
    "upsert_view": _with(VIEW_COLUMNS, *UPSERT),
    "upsert_stream": _with(VIEW_COLUMNS, *UPSERT),
    "origin_parity": _with("SELECT kind AS change_type, count(*) AS n FROM up GROUP BY kind", *UPSERT),
    "history_head": _with("SELECT version, operation FROM history ORDER BY version DESC LIMIT 1", HISTORY),
    "hours_since_op": _with(f"SELECT {HOURS} AS hours FROM history WHERE operation = 'OPTIMIZE'", HISTORY),
    "maintenance_due": _with(
        f"SELECT {HOURS} AS hours, coalesce({HOURS} >= 1.0, true) AS due FROM history WHERE operation = 'OPTIMIZE'", HISTORY
    ),
    "migrate_run": _with(
        "SELECT count(*) AS n, cast(2 AS bigint) AS applied, cast(0 AS bigint) AS applied_again FROM s1", *ONE
    ),
    "migrations_pending": """
        SELECT doc_id AS ord, md5(cast(doc_id AS varchar)) AS id FROM documents
        WHERE doc_id NOT IN (SELECT doc_id FROM labels)""",
}


# -- reports and artefacts -------------------------------------------------


def _unquote(x: str) -> str:
    """Doubled backslashes are parked in a private-use character meanwhile."""
    park, b = "chr(57344)", "chr(92)"
    inner = f"replace(substr({x}, 2, length({x}) - 2), {b} || {b}, {park})"
    for mark, char in (("chr(34)", "chr(34)"), ("'n'", NL), ("'t'", "chr(9)"), ("'r'", "chr(13)")):
        inner = f"replace({inner}, {b} || {mark}, {char})"
    inner = f"replace({inner}, {park}, {b})"
    return f"CASE WHEN length({x}) >= 2 AND starts_with({x}, chr(34)) AND ends_with({x}, chr(34)) THEN {inner} ELSE {x} END"


def _quote(x: str) -> str:
    b = "chr(92)"
    for char, mark in ((b, b), ("chr(34)", "chr(34)"), (NL, "'n'"), ("chr(9)", "'t'"), ("chr(13)", "'r'")):
        x = f"replace({x}, {char}, {b} || {mark})"
    return f"chr(34) || {x} || chr(34)"


def _parse(p: str, source: str) -> list[tuple[str, str]]:
    """CTEs `<p>_e` (keys), `<p>_v` (values), `<p>_body` of the documents in `source`."""
    return [
        (
            f"{p}_ln",
            f"""SELECT doc_id, path, i, line, trim(line, {WS}) AS st FROM (
              SELECT doc_id, path, unnest(a) AS line, unnest(range(1, len(a) + 1)) AS i
              FROM (SELECT doc_id, path, string_split(content, {NL}) AS a FROM {source}))""",
        ),
        (
            f"{p}_b",
            f"""SELECT doc_id, bool_or(i = 1 AND st = '---') AS opened,
                  min(CASE WHEN i > 1 AND st = '---' THEN i END) AS close FROM {p}_ln GROUP BY doc_id""",
        ),
        (
            f"{p}_fl",
            f"""SELECT doc_id, i, st, starts_with(st, '- ') AS item,
                  sum(CASE WHEN starts_with(st, '- ') THEN 0 ELSE 1 END) OVER (PARTITION BY doc_id ORDER BY i) AS grp
                FROM {p}_ln JOIN {p}_b USING (doc_id)
                WHERE opened AND i > 1 AND (close IS NULL OR i < close) AND (starts_with(st, '- ') OR contains(st, ':'))""",
        ),
        (
            f"{p}_k",
            f"""SELECT doc_id, grp, trim(substr(st, 1, instr(st, ':') - 1), {WS}) AS key,
                  trim(substr(st, instr(st, ':') + 1), {WS}) AS raw FROM {p}_fl WHERE NOT item""",
        ),
        (
            f"{p}_e",
            f"""SELECT doc_id, key, grp, raw, raw IN ('', '[]') AS is_list FROM {p}_k
                JOIN (SELECT doc_id, key, max(grp) AS grp FROM {p}_k GROUP BY doc_id, key) USING (doc_id, key, grp)""",
        ),
        (
            f"{p}_v",
            f"""SELECT doc_id, key, is_list, cast(0 AS bigint) AS pos, {_unquote('raw')} AS value FROM {p}_e WHERE NOT is_list
                UNION ALL
                SELECT doc_id, key, is_list, pos, {_unquote('x')} AS value FROM (
                  SELECT e.doc_id, e.key, e.is_list, trim(substr(f.st, 3), {WS}) AS x,
                         row_number() OVER (PARTITION BY e.doc_id, e.key ORDER BY f.i) - 1 AS pos
                  FROM {p}_e e JOIN {p}_fl f ON e.doc_id = f.doc_id AND e.grp = f.grp AND f.item
                  WHERE e.raw = '')""",
        ),
        (
            f"{p}_bl",
            f"""SELECT doc_id, i, line, min(CASE WHEN starts_with(ltrim(line, {WS}), '#') THEN i END) OVER (PARTITION BY doc_id) AS h
                FROM {p}_ln JOIN {p}_b USING (doc_id) WHERE NOT opened OR i > close""",
        ),
        (
            f"{p}_body",
            f"""SELECT s.doc_id, s.path, coalesce(t.body, '') AS body FROM {source} s LEFT JOIN (
                  SELECT doc_id, trim(string_agg(line, {NL} ORDER BY i), {WS}) AS body FROM {p}_bl
                  WHERE h IS NULL OR i >= h GROUP BY doc_id) t ON s.doc_id = t.doc_id""",
        ),
        (
            f"{p}_s",
            f"""SELECT b.doc_id, b.path, b.body, {', '.join(
                f"max(CASE WHEN v.key = '{k}' AND NOT v.is_list THEN v.value END) AS {k}"
                for k in ('dedup_key', 'incident_key', 'namespace', 'outcome', 'verdict', 'confidence', 'reason', 'confirmation', 'group_key'))}
                FROM {p}_body b LEFT JOIN {p}_v v ON b.doc_id = v.doc_id GROUP BY b.doc_id, b.path, b.body""",
        ),
    ]


REPORTS_RAW = [_view("reports_raw"), *_parse("r", "reports_raw")]
REPORTS = [
    *REPORTS_RAW,
    (
        "keyed",
        """SELECT *, coalesce(nullif(dedup_key, ''), nullif(incident_key, '')) AS dkey,
             CASE WHEN coalesce(nullif(dedup_key, ''), nullif(incident_key, '')) IS NULL THEN 'no key'
                  WHEN body = '' THEN 'empty body' END AS skip_reason FROM r_s""",
    ),
    (
        "alerts",
        """SELECT e.doc_id, coalesce(string_agg(v.value, ',' ORDER BY v.pos), '') AS alert, count(v.value) AS n
           FROM r_e e LEFT JOIN r_v v ON e.doc_id = v.doc_id AND e.key = v.key WHERE e.key = 'alertnames' GROUP BY e.doc_id""",
    ),
    (
        "reports",
        """SELECT k.doc_id, k.dkey AS dedup_key, coalesce(k.incident_key, k.dkey) AS incident_key, k.namespace, k.path, k.body,
                  a.alert, coalesce(a.n, 0) AS n_alerts
           FROM keyed k LEFT JOIN alerts a ON k.doc_id = a.doc_id WHERE k.skip_reason IS NULL""",
    ),
]

CONCLUSIONS = [
    _view("conclusions_raw"),
    *_parse("c", "conclusions_raw"),
    (
        "c_good",
        """SELECT dedup_key, path, outcome,
             CASE WHEN outcome = 'diagnosed' THEN coalesce(verdict, '') END AS verdict,
             CASE WHEN outcome = 'diagnosed' THEN coalesce(confidence, 'low') END AS confidence,
             CASE WHEN outcome = 'inconclusive' THEN coalesce(reason, '') END AS reason
           FROM c_s WHERE nullif(dedup_key, '') IS NOT NULL AND (
             (outcome = 'diagnosed' AND length(coalesce(verdict, '')) <= 300
              AND coalesce(confidence, 'low') IN ('high', 'medium', 'low'))
             OR (outcome = 'inconclusive' AND length(coalesce(reason, '')) <= 300))""",
    ),
    (
        "conclusions",
        """SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY dedup_key ORDER BY path DESC) AS rn FROM c_good)
           WHERE rn = 1""",
    ),
]
CONFIRMATIONS = [
    _view("confirmations_raw"),
    *_parse("f", "confirmations_raw"),
    (
        "confirmations",
        """SELECT dedup_key, arg_max(confirmation, path) AS confirmation FROM f_s
           WHERE nullif(dedup_key, '') IS NOT NULL AND confirmation IN ('confirmed', 'refuted') GROUP BY dedup_key""",
    ),
]
ENRICHED = [
    *REPORTS,
    *CONCLUSIONS,
    *CONFIRMATIONS,
    (
        "enriched",
        """SELECT r.*, c.outcome, c.verdict, c.confidence, coalesce(f.confirmation, 'unverified') AS confirmation
           FROM reports r LEFT JOIN conclusions c ON r.dedup_key = c.dedup_key
           LEFT JOIN confirmations f ON r.dedup_key = f.dedup_key""",
    ),
]


def _markdown(finding: str, key: str, outcome: str, rationale: str) -> str:
    return (
        f"concat_ws({NL}, '---', 'schema: 1', 'dedup_key: ' || {_quote(key)}, 'outcome: ' || {outcome}, {finding}, "
        f"'---', '', '## Rationale', '', {rationale}, '')"
    )


def _finding() -> str:
    return (
        f"CASE WHEN outcome = 'diagnosed' THEN concat_ws({NL}, 'verdict: ' || {_quote('verdict')}, 'confidence: ' || confidence) "
        f"ELSE 'reason: ' || {_quote('reason')} END"
    )


def _stats(kind: str, artefacts: str, alarm: str) -> str:
    return f"""SELECT '{kind}' AS kind, (SELECT count(*) FROM {artefacts}) AS loaded,
        (SELECT count(*) FROM reports WHERE dedup_key IN (SELECT dedup_key FROM {artefacts})) AS enriched,
        (SELECT count(*) FROM reports) AS total,
        (SELECT count(*) FROM {artefacts} WHERE dedup_key NOT IN (SELECT dedup_key FROM reports)) AS orphans,
        (SELECT count(*) = 0 FROM {artefacts}) AND {alarm} AS alarm"""


DOCUMENTS = {
    "scan_reports": _with(
        " UNION ALL ".join(
            f"""SELECT '{folder}' AS family, array_to_string(string_split(path, '/')[-2:], '/') AS name, true AS readable,
                       md5(content || chr(10)) AS digest FROM {family}_raw
                UNION ALL SELECT '{folder}', 'broken', false, NULL"""
            for folder, family in (("triage", "reports"), ("conclusions", "conclusions"), ("confirmations", "confirmations"))
        ),
        _view("reports_raw"), _view("conclusions_raw"), _view("confirmations_raw"),
    ),
    "front_matter": _with(
        """SELECT e.doc_id, e.key, e.is_list, v.pos, v.value FROM r_e e
           LEFT JOIN r_v v ON e.doc_id = v.doc_id AND e.key = v.key""",
        *REPORTS_RAW,
    ),
    "unquote": _with(
        "SELECT doc_id, coalesce(group_key, '') AS value FROM r_s",
        *REPORTS_RAW,
    ),
    "quote_roundtrip": f"SELECT doc_id, md5({_quote('text')}) AS quoted, true AS same FROM documents",
    "report_body": _with("SELECT doc_id, body FROM r_body", *REPORTS_RAW),
    "report_skips": _with("SELECT doc_id, skip_reason FROM keyed WHERE skip_reason IS NOT NULL", *REPORTS),
    "reports_parsed": _with("SELECT dedup_key, path, namespace, alert, length(body) AS body_len FROM reports", *REPORTS),
    "mirror_path": _with(
        """SELECT path, CASE WHEN string_split(path, '/')[1] = 'triage'
             THEN array_to_string(list_prepend('conclusions', string_split(path, '/')[2:]), '/') END AS conclusion_path
           FROM reports_raw""",
        _view("reports_raw"),
    ),
    "conclusions_valid": _with("SELECT dedup_key, outcome, verdict, confidence FROM conclusions", *CONCLUSIONS),
    "confirmations_valid": _with("SELECT dedup_key, confirmation FROM confirmations", *CONFIRMATIONS),
    "conclusion_markdown": _with(
        f"SELECT dedup_key, md5({_markdown(_finding(), 'dedup_key', 'outcome', chr(39) + 'because' + chr(39))}) AS digest FROM c_good",
        *CONCLUSIONS,
    ),
    "conclusion_roundtrip": _with(
        "SELECT dedup_key, outcome, verdict, confidence, reason, 'because' AS rationale FROM c_good", *CONCLUSIONS
    ),
    **dict.fromkeys(("enriched_reports", "scan_enriched"), _with(
        """SELECT dedup_key, incident_key, coalesce(namespace, '') AS namespace, n_alerts, outcome, verdict, confidence, confirmation
           FROM enriched""",
        *ENRICHED,
    )),
    "enrichment_stats": _with(
        _stats("conclusion", "conclusions", "true") + " UNION ALL " + _stats("confirmation", "confirmations", "false"),
        *ENRICHED,
    ),
    "orphans": _with(
        """SELECT 'conclusion' AS kind, dedup_key FROM conclusions WHERE dedup_key NOT IN (SELECT dedup_key FROM reports)
           UNION ALL
           SELECT 'confirmation', dedup_key FROM confirmations WHERE dedup_key NOT IN (SELECT dedup_key FROM reports)""",
        *ENRICHED,
    ),
}

# -- points and index ------------------------------------------------------


def _uuid5(name: str) -> str:
    h = f"sha1(unhex('6ba7b8119dad11d180b400c04fd430c8') || encode({name}))"
    return (
        f"(SELECT concat(substr(h, 1, 8), '-', substr(h, 9, 4), '-5', substr(h, 14, 3), '-', "
        f"substr('89ab', cast(concat('0x', substr(h, 17, 1)) AS integer) % 4 + 1, 1), substr(h, 18, 3), '-', substr(h, 21, 12)) "
        f"FROM (SELECT {h} AS h))"
    )


NAME = "^[ \\t]{0,3}#{1,2}[ \\t]+(.+?)[ \\t]*$"
NORM = (
    "array_to_string(list_transform(list_filter(string_split_regex(trim(lower(strip_accents({0}))), '\\s+'), "
    "lambda w: w <> ''), lambda w: regexp_replace(w, 's$', '')), ' ')"
)
SECTIONS = [
    *REPORTS,
    (
        "sl",
        f"""SELECT doc_id, dedup_key, i, line,
              sum(CASE WHEN regexp_matches(line, '^ {{0,3}}```') THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY i) % 2 = 1 AS fenced
            FROM (SELECT doc_id, dedup_key, unnest(a) AS line, unnest(range(1, len(a) + 1)) AS i
                  FROM (SELECT doc_id, dedup_key, string_split(body, {NL}) AS a FROM reports))""",
    ),
    (
        "sh",
        f"""SELECT *, CASE WHEN NOT fenced AND regexp_matches(line, '{NAME}') THEN regexp_extract(line, '{NAME}', 1) END AS heading
            FROM sl""",
    ),
    ("sg", "SELECT *, count(heading) OVER (PARTITION BY doc_id ORDER BY i) AS grp FROM sh"),
    (
        "st",
        f"""SELECT doc_id, dedup_key, grp, {NORM.format('max(heading)')} AS norm,
              trim(coalesce(string_agg(line, {NL} ORDER BY i) FILTER (WHERE heading IS NULL), ''), {WS}) AS text
            FROM sg WHERE grp > 0 GROUP BY doc_id, dedup_key, grp""",
    ),
    (
        "sections",
        """SELECT doc_id, dedup_key, section, text FROM (
             SELECT *, row_number() OVER (PARTITION BY doc_id, section ORDER BY grp DESC) AS rn FROM (
               SELECT *, CASE norm WHEN 'sintoma' THEN 'symptom' WHEN 'evidencia' THEN 'evidence'
                   WHEN 'causa provavel' THEN 'cause' WHEN 'proximo passo' THEN 'next_step' END AS section FROM st)
             WHERE section IS NOT NULL AND text <> '') WHERE rn = 1""",
    ),
]
SECTION_POINTS = [
    *SECTIONS,
    *CONCLUSIONS,
    *CONFIRMATIONS,
    (
        "sp",
        f"""SELECT {_uuid5("dedup_key || '#' || section")} AS point_id, doc_id, dedup_key, section, text FROM sections""",
    ),
]

# Greedy packing, one paragraph per step.
CHUNKS = [
    (
        "paras",
        f"""SELECT doc_id, p, row_number() OVER (PARTITION BY doc_id ORDER BY i) AS i FROM (
              SELECT doc_id, trim(unnest(string_split(text, {NL})), {WS}) AS p,
                     unnest(range(1, len(string_split(text, {NL})) + 1)) AS i FROM documents) WHERE p <> ''""",
    ),
    ("last_para", "SELECT doc_id, max(i) AS n FROM paras GROUP BY doc_id"),
    (
        "pack",
        """SELECT doc_id, cast(0 AS bigint) AS i, cast([] AS varchar[]) AS flushed, '' AS cur FROM last_para
           UNION ALL
           SELECT k.doc_id, k.i + 1,
             CASE WHEN length(cur) + length(p) + 2 <= 1000 THEN cast([] AS varchar[])
                  WHEN length(p) > 1000 THEN list_concat(CASE WHEN cur = '' THEN [] ELSE [cur] END,
                       list_transform(range(0, length(p), 850), lambda o: substr(p, o + 1, 1000)))
                  ELSE CASE WHEN cur = '' THEN [] ELSE [cur] END END,
             CASE WHEN length(cur) + length(p) + 2 <= 1000
                    THEN CASE WHEN cur = '' THEN p ELSE concat(cur, chr(10), chr(10), p) END
                  WHEN length(p) > 1000 THEN '' ELSE p END
           FROM pack k JOIN paras q ON k.doc_id = q.doc_id AND q.i = k.i + 1""",
    ),
    (
        "pieces",
        """SELECT doc_id, i, unnest(flushed) AS text, unnest(range(1, len(flushed) + 1)) AS j FROM pack
           UNION ALL
           SELECT k.doc_id, k.i + 1, cur, 1 FROM pack k JOIN last_para l ON k.doc_id = l.doc_id AND k.i = l.n WHERE cur <> ''""",
    ),
    ("chunked", "SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY i, j) - 1 AS chunk, text FROM pieces"),
]

CENTRES = [
    (
        "cells",
        "SELECT label, unnest(embedding) AS x, unnest(range(1, len(embedding) + 1)) AS pos FROM embeddings",
    ),
    ("means", "SELECT label, pos, avg(cast(x AS double)) AS x FROM cells GROUP BY label, pos"),
    ("centres", "SELECT label, list(x ORDER BY pos) AS v FROM means GROUP BY label"),
]


def _topk(condition: str) -> str:
    return _with(
        f"""SELECT query_id, rank, vec_id, round(sim, 6) AS sim FROM (
             SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(sim, 9) DESC, vec_id) AS rank FROM (
               SELECT cast(c.label AS bigint) AS query_id, e.vec_id,
                      list_cosine_similarity(c.v, cast(e.embedding AS double[])) AS sim
               FROM centres c JOIN embeddings e ON {condition})) WHERE rank <= 5""",
        *CENTRES,
    )


OLD_RUN = "SELECT vec_id, label, 'run-1' AS run_id FROM embeddings WHERE label <= 6"
NEW_RUN = "SELECT vec_id, label, 'run-2' AS run_id FROM embeddings WHERE label >= 4"
BUCKET = "cast(concat('0x', substr(md5(w), 1, 8)) AS bigint)"

INDEX = {
    "points_whole": _with(
        f"SELECT {_uuid5('dedup_key')} AS point_id, dedup_key, length(body) AS n_chars FROM reports", *REPORTS
    ),
    "sections": _with("SELECT dedup_key, section, text FROM sections", *SECTIONS),
    "points_sections": _with("SELECT point_id, dedup_key, section, md5(text) AS digest FROM sp", *SECTION_POINTS),
    "heading_norm": _with(
        f"SELECT heading, count(*) AS n, {NORM.format('heading')} AS norm FROM sg WHERE heading IS NOT NULL GROUP BY heading",
        *SECTIONS,
        ),
    "chunks": _with("SELECT doc_id, chunk, text FROM chunked", *CHUNKS),
    "point_ids": _with(
        f"SELECT {_uuid5('cast(doc_id AS varchar) || chr(35) || cast(chunk AS varchar)')} AS point_id, doc_id, chunk FROM chunked",
        *CHUNKS,
    ),
    "embed_hash": _with(
        f"""SELECT point_id, slot AS cell, round(s / sqrt(sum(s * s) OVER (PARTITION BY point_id)), 4) AS value FROM (
             SELECT point_id, ({BUCKET} // 2) % 64 AS slot, sum(CASE WHEN {BUCKET} % 2 = 0 THEN 1 ELSE -1 END) AS s
             FROM (SELECT point_id, unnest(string_split_regex(trim(lower(text), {WS}), '\\s+')) AS w FROM sp) WHERE w <> ''
             GROUP BY point_id, slot) WHERE s <> 0""",
        *SECTION_POINTS,
    ),
    "embed_hook": _with(
        """SELECT point_id, cell, value FROM (
             SELECT point_id, unnest([0, 1, 2, 3])::bigint AS cell,
                    unnest([length(text) - length(replace(text, c, '')) for c in ['a', 'e', ' ', chr(10)]])::double AS value
             FROM sp) WHERE value <> 0""",
        *SECTION_POINTS,
    ),
    "index_upsert": f"{OLD_RUN} AND label < 4 UNION ALL {NEW_RUN}",
    "index_gc": NEW_RUN,
    "reconcile": NEW_RUN,
    "schema_guard": """SELECT cast(32 AS bigint) AS dim, count(*) AS n, false AS compatible_before, true AS compatible_after
                       FROM embeddings""",
    "counted_load": """
        SELECT count(*) AS stored, count(*) AS counted, round(sum(CAST(c_acctbal AS DOUBLE)), 2) AS balance FROM customer""",
    "cosine_topk": _topk("true"),
    "filtered_topk": _topk("c.label = e.label"),
    "point_filter": _with(
        """SELECT p.point_id, p.dedup_key FROM sp p JOIN conclusions c ON p.dedup_key = c.dedup_key
           JOIN confirmations f ON p.dedup_key = f.dedup_key
           WHERE p.section = 'cause' AND c.outcome = 'diagnosed' AND f.confirmation = 'confirmed'
             AND p.doc_id IN (SELECT doc_id FROM r_v WHERE key = 'alertnames' AND value = 'Common: B')""",
        *SECTION_POINTS,
    ),
    "run_metrics": _with(
        """SELECT 'run-1' AS run_id, count(*) AS points_in, count(*) AS points FROM sp
           UNION ALL SELECT 'run-2', 2 * count(*), count(*) FROM sp""",
        *SECTION_POINTS,
    ),
}

# -- classification --------------------------------------------------------

PENDING = "doc_id NOT IN (SELECT doc_id FROM labels)"
FITS = "length(coalesce(verdict, '')) <= 300"
CLASSIFIED = [
    *SECTIONS,
    (
        "stated",
        """SELECT doc_id, regexp_extract(lower(text), '^([^ .]+)', 1) AS word FROM st WHERE norm = 'confianca'""",
    ),
    (
        "scored",
        f"""SELECT r.doc_id, r.dedup_key, r.path, CASE WHEN s.text IS NULL THEN 'inconclusive' ELSE 'diagnosed' END AS outcome,
              trim(s.text, {WS}) AS verdict,
              CASE WHEN s.text IS NOT NULL THEN CASE c.word WHEN 'alta' THEN 'high' WHEN 'média' THEN 'medium' ELSE 'low' END END AS confidence,
              CASE WHEN s.text IS NULL THEN 'no cause section' END AS reason,
              CASE WHEN s.text IS NULL THEN 'no cause section' ELSE 'cause section present' END AS rationale
            FROM reports r LEFT JOIN (SELECT * FROM sections WHERE section = 'cause') s ON r.doc_id = s.doc_id
            LEFT JOIN stated c ON r.doc_id = c.doc_id""",
    ),
]
FIELDS = "dedup_key, outcome, verdict, confidence"
CONCLUSION_PATH = "replace(path, 'triage/', 'conclusions/')"
ATTRS = [
    *REPORTS,
    (
        "attrs",
        f"""SELECT dedup_key, 'trace.session.id' AS attr, dedup_key AS value FROM reports
            UNION ALL SELECT dedup_key, 'trace.trace.name', CASE WHEN coalesce(alert, '') = '' THEN 'classify' ELSE 'classify:' || alert END FROM reports
            UNION ALL SELECT dedup_key, 'incident.alertname', coalesce(alert, '') FROM reports
            UNION ALL SELECT dedup_key, 'incident.namespace', coalesce(namespace, '') FROM reports
            UNION ALL SELECT dedup_key, 'incident.run_id', '{RUN_ID}' FROM reports""",
    ),
]

CLASSIFICATION = {
    "classify_pending": _with(f"SELECT dedup_key FROM reports WHERE {PENDING}", *REPORTS),
    "reclassify_scope": _with("SELECT dedup_key FROM reports WHERE namespace = 'src3'", *REPORTS),
    "classify_hook": _with(
        """SELECT dedup_key, CASE WHEN n IN (2, 3) THEN 'diagnosed' WHEN n = 4 THEN 'inconclusive' END AS outcome,
                  CASE WHEN n IN (2, 3) THEN length(body) || ' characters' END AS verdict,
                  CASE WHEN n IN (2, 3) THEN 'high' END AS confidence, CASE WHEN n = 4 THEN 'too long' END AS reason,
                  CASE n WHEN 0 THEN 'call failed: busy' WHEN 1 THEN 'unknown outcome' END AS error
           FROM (SELECT *, length(body) % 5 AS n FROM reports)""",
        *REPORTS,
    ),
    "classify_rule": _with(f"SELECT {FIELDS} FROM scored", *CLASSIFIED),
    "call_attrs": _with(
        """SELECT dedup_key, attr, value FROM attrs
           UNION ALL SELECT dedup_key, 'incident.outcome', outcome FROM scored
           UNION ALL SELECT dedup_key, 'incident.confidence', confidence FROM scored WHERE confidence IS NOT NULL""",
        *CLASSIFIED, ATTRS[-1],
    ),
    "classify_run": _with(f"SELECT {FIELDS} FROM scored WHERE {PENDING} AND {FITS}", *CLASSIFIED),
    "conclusion_write": _with(
        f"""SELECT {CONCLUSION_PATH} AS path, md5({_markdown(_finding(), 'dedup_key', 'outcome', 'rationale')}) AS digest
            FROM scored WHERE {PENDING} AND {FITS}
            UNION ALL SELECT {CONCLUSION_PATH}, md5('old') FROM reports_raw WHERE doc_id IN (SELECT doc_id FROM labels)""",
        *CLASSIFIED,
    ),
    "classify_summary": _with(
        f"""SELECT count(*) FILTER (WHERE {PENDING} AND {FITS}) AS done, count(*) FILTER (WHERE NOT ({PENDING})) AS skipped,
               count(*) FILTER (WHERE {PENDING} AND NOT ({FITS})) AS failed FROM scored""",
        *CLASSIFIED,
    ),
    "trace_attrs": _with("SELECT dedup_key, attr, value FROM attrs", *ATTRS),
    "domain_attrs": _with(
        "SELECT dedup_key, attr, value FROM attrs WHERE starts_with(attr, 'incident.') AND value <> ''", *ATTRS
    ),
    "cost_per_session": _with(
        """SELECT session_id, round(sum(try_cast(nullif(trim(raw_cost), '') AS double)), 4) AS cost, count(*) AS calls,
             count(*) FILTER (WHERE try_cast(nullif(trim(raw_cost), '') AS double) IS NULL) AS unpriced
           FROM cost_calls GROUP BY session_id""",
        _view("cost_calls"),
    ),
}

ORACLES: dict[str, str] = {**TABLE_CHANGES, **DOCUMENTS, **INDEX, **CLASSIFICATION}
