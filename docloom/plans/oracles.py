"""The expected result of each query as SQL on the given tables, worked out without JSON."""

from __future__ import annotations

from docloom.operators import requests
from docloom.operators.elements import NO_CONTENT, PARSE_FAILURE, PARSER_FAILURE
from docloom.operators.normalize import SUBLIMIT_TYPES
from docloom.plans.queries import CHOSEN_FILE, LISTED, MODEL, PART_CHARS, RUN_TIME
from docloom.schemas import COVERAGE_TYPES, INCLUDED_STATES, POLICY_TYPES, SECTION_TYPES


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _words(values: tuple[str, ...]) -> str:
    return ", ".join(_text(value) for value in values)


def _pick(values: tuple[str, ...], index: str) -> str:
    return f"([{_words(values)}])[{index}]"


_DOCS = """docs AS (
  SELECT *, 'doc_' || doc_id || '.pdf' AS file_name, '/corpus/' || source || '/doc_' || doc_id || '.pdf' AS file_path,
         CAST(doc_id % 12 AS INTEGER) AS shape, string_split(text, chr(10)) AS parts
  FROM documents)"""
_LINES = f"""{_DOCS}, lines AS (
  SELECT * EXCLUDE (parts), unnest(parts) AS line, generate_subscripts(parts, 1) - 1 AS pos FROM docs)"""

# Page texts

_PAGED = f"""{_LINES}, page AS (
  SELECT doc_id, file_name, file_path, pos // 5 AS n, string_agg(line, chr(10) ORDER BY pos) AS page_text
  FROM lines GROUP BY ALL),
marked AS (
  SELECT *, '=== PAGE ' || (n + 1) || ' START ===' || chr(10)
    || CASE WHEN n % 9 = 7 AND doc_id % 3 = 0 THEN '[PAGE ERROR: unreadable]' WHEN n % 9 = 8 THEN '' ELSE page_text END
    || chr(10) || '=== PAGE ' || (n + 1) || ' END ===' AS block
  FROM page),
whole AS (
  SELECT doc_id, file_name, file_path, CAST(count(*) AS INTEGER) AS page_count,
         string_agg(block, chr(10) || chr(10) || chr(10) ORDER BY n) AS policy_text
  FROM marked GROUP BY ALL)"""

_ELEMENTS = f"""{_LINES}, item AS (
  SELECT doc_id, pos, greatest(pos // 5, 1) AS page, regexp_replace(line, '^\\s+|\\s+$', '', 'g') AS content
  FROM lines WHERE pos % 7 <> 6 AND doc_id % 50 NOT IN (46, 47, 48)),
block AS (
  SELECT doc_id, page, '=== PAGE ' || page || ' START ===' || chr(10)
    || string_agg(content, chr(10) || chr(10) ORDER BY pos) || chr(10) || '=== PAGE ' || page || ' END ===' AS block
  FROM item WHERE content <> '' GROUP BY doc_id, page),
whole AS (
  SELECT doc_id, CAST(max(page) AS INTEGER) AS page_count, string_agg(block, chr(10) || chr(10) ORDER BY page) AS policy_text
  FROM block GROUP BY doc_id),
result AS (
  SELECT file_name, file_path, page_count, policy_text,
         CASE WHEN policy_text IS NULL THEN 'FAILED' ELSE 'SUCCESS' END AS extraction_status,
         CASE WHEN doc_id % 50 = 46 THEN {_text(PARSER_FAILURE + "E46")}
              WHEN doc_id % 50 = 48 THEN {_text(PARSE_FAILURE + "Expecting value: line 1 column 1 (char 0)")}
              WHEN policy_text IS NULL THEN {_text(NO_CONTENT)} END AS error_message
  FROM docs LEFT JOIN whole USING (doc_id))"""


_MANIFEST = """WITH file AS (
  SELECT doc_id % 10 AS fate, '/corpus/' || source || '/doc_' || doc_id || '.pdf' AS path, '/moved/doc_' || doc_id || '.pdf' AS other,
         n_chars AS length, coalesce(text, '') AS text FROM documents),
saved AS (SELECT path, length, sha256(text) AS digest FROM file WHERE fate <> 9),
listed AS (
  SELECT CASE WHEN fate = 7 THEN other ELSE path END AS path, length, CASE WHEN fate IN (5, 6) THEN 2 ELSE 1 END AS modified,
         sha256(CASE WHEN fate = 6 THEN text || '!' ELSE text END) AS digest FROM file WHERE fate <> 8),
lost AS (SELECT digest, min(path) AS left_path FROM saved WHERE path NOT IN (SELECT path FROM listed) GROUP BY digest)
SELECT path, 'gone' AS status, length, 1 AS modified, digest, CAST(NULL AS VARCHAR) AS moved_from
FROM saved WHERE path NOT IN (SELECT path FROM listed)
UNION ALL
SELECT path, CASE WHEN s.digest = l.digest THEN 'unchanged' WHEN s.digest IS NOT NULL THEN 'changed'
                  WHEN left_path IS NOT NULL THEN 'moved' ELSE 'new' END, l.length, modified, l.digest,
       CASE WHEN s.digest IS NULL THEN left_path END
FROM listed l LEFT JOIN saved s USING (path) LEFT JOIN lost ON lost.digest = l.digest"""


# Fixed value: the most characters of one request.
_MOST = 120_000


def _part(text: str, most: int = _MOST) -> str:
    return f"substr({text}, p * {most} + 1, {most})"


def _part_numbers(text: str, most: int = _MOST) -> str:
    return f"unnest(range(0, greatest(1, CAST(ceil(length({text}) / {most}) AS BIGINT)))) AS p"


def _requests(prompts: dict[str, str], keep_failed: bool, system: bool, most: int = _MOST) -> str:
    rows = ", ".join(f"({_text(name)}, {_text(body)})" for name, body in prompts.items())
    body = "CASE WHEN doc_id % 50 <> 49 THEN policy_text END" if keep_failed else "policy_text"
    return f"""WITH {_PAGED}, body AS (
  SELECT *, {_part("whole_body", most)} AS body FROM (
    SELECT file_path, page_count, whole_body, {_part_numbers("whole_body", most)} FROM (
      SELECT file_path, page_count, coalesce({body}, '') AS whole_body
      FROM whole {"" if keep_failed else "WHERE doc_id % 50 <> 49"}))),
choice(variant, template) AS (VALUES {rows}),
filled AS (SELECT *, replace(template, '{requests.PLACEHOLDER}', body) AS prompt FROM body, choice)
SELECT file_path, {"CAST(NULL AS INTEGER) AS" if system else ""} page_count, variant,
       CAST(p + 1 AS INTEGER) AS part_no, CAST(greatest(1, ceil(length(whole_body) / {most})) AS INTEGER) AS part_count,
       CAST(length(body) AS BIGINT) AS request_chars, md5(prompt) AS prompt_md5,
       CAST({len(requests.SYSTEM_MESSAGE) if system else "length(prompt)"} AS INTEGER) AS first_message_chars
FROM filled"""


# Responses. Which shapes give all coverages, the first one, a row of nulls, or nothing:

_FULL = {"v1": "(0, 1, 2, 7, 9)", "v2": "(0, 1, 2, 7, 8)"}
_FIRST = {"v1": "(3, 11)", "v2": "(3, 10)"}
_BLANK = {"v1": "(6)", "v2": "(-1)"}
_CUT = {"v1": "(3, 4, 11)", "v2": "(3, 4, 10)"}


def _outcome(rules: str) -> str:
    return f"""outcome AS (
  SELECT *, CASE WHEN shape IN {_FULL[rules]} THEN 'full' WHEN shape IN {_FIRST[rules]} THEN 'first'
                 WHEN shape IN {_BLANK[rules]} THEN 'blank' END AS yield,
         CASE WHEN shape IN {_FULL[rules]} OR shape IN {_FIRST[rules]} OR shape IN {_BLANK[rules]}
              THEN 'SUCCESS' ELSE 'FAILED' END AS extraction_status,
         shape IN {_CUT[rules]} AS was_truncated, shape IN {_FIRST[rules]} AS was_repaired
  FROM docs)"""


def _status(rules: str) -> str:
    count = "shape + 1" if rules == "v2" else "NULL"
    return f"""WITH {_DOCS}, {_outcome(rules)}
SELECT file_name, file_path, CAST({count} AS INTEGER) AS page_count, n_chars AS request_chars, '{MODEL}' AS model_name,
       extraction_status, was_truncated, was_repaired FROM outcome"""


def _truncation() -> str:
    parts = [
        f"""SELECT '{rules}' AS rules, shape IN {_CUT[rules]} AS was_truncated, shape IN {_FIRST[rules]} AS was_repaired,
       CASE WHEN shape IN {_FULL[rules]} OR shape IN {_FIRST[rules]} OR shape IN {_BLANK[rules]}
            THEN 'SUCCESS' ELSE 'FAILED' END AS extraction_status, count(*) AS document_count
FROM docs GROUP BY ALL"""
        for rules in ("v1", "v2")
    ]
    return f"WITH {_DOCS} " + " UNION ALL ".join(parts)


def _coverage_rows(rules: str) -> str:
    """CTEs ending in ``found``: a row per coverage, or one of nulls."""
    return f"""{_LINES}, {_outcome(rules)}, found AS (
  SELECT o.file_name, o.file_path, o.yield, o.lang, l.line, l.pos, l.pos IS NOT NULL AS present
  FROM outcome o LEFT JOIN lines l
    ON o.doc_id = l.doc_id AND (o.yield = 'full' OR (o.yield = 'first' AND l.pos = 0))
  WHERE o.extraction_status = 'SUCCESS')"""


def _coverages(rules: str, only: str = "TRUE") -> str:
    kind = f"CASE WHEN present THEN {_pick(COVERAGE_TYPES, 'pos % 6 + 1')} END AS coverage_type," if rules == "v2" else ""
    return f"""WITH {_coverage_rows(rules)}
SELECT file_name, file_path, CASE WHEN pos % 11 <> 10 THEN line END AS coverage_name,
       CASE WHEN present THEN lang END AS coverage_section, {kind}
       length(line) * 1000.0::DOUBLE AS limit_amount,
       CASE WHEN pos % 2 = 0 THEN length(line) * 2000.0::DOUBLE END AS aggregate_limit,
       CASE WHEN pos % 3 = 0 THEN length(line) * 10.0::DOUBLE END AS deductible_or_retention,
       pos % 6 = 1 AS is_sublimit, length(line) % 101 / 100.0::DOUBLE AS coverage_confidence,
       CAST(pos // 5 + 1 AS VARCHAR) AS coverage_page_reference
FROM found WHERE {only}"""


def _policy_columns(shown: str) -> str:
    columns = {
        "policy_number": "'PN-' || doc_id",
        "carrier": "source",
        "named_insured": "'Insured ' || lang",
        "effective_date": "'2025-01-01'",
        "expiration_date": "'2026-01-01'",
        "policy_type": "CASE WHEN doc_id % 3 = 0 THEN 'Primary' ELSE 'Excess' END",
        "claims_made_or_occurrence": "CASE WHEN doc_id % 4 <> 0 THEN 'Occurrence' END",
        "policy_confidence": "n_chars % 101 / 100.0::DOUBLE",
    }
    return ", ".join(f"CASE WHEN {shown} THEN {body} END AS {name}" for name, body in columns.items())


def _policies(rules: str) -> str:
    more = f", CAST(shape + 1 AS INTEGER) AS page_count, '{RUN_TIME}' AS processed_at" if rules == "v2" else ""
    return f"""WITH {_DOCS}, {_outcome(rules)}
SELECT file_name, file_path, {_policy_columns("yield <> 'blank'")},
       CASE WHEN yield <> 'blank' THEN '1' END AS policy_page_reference{more}
FROM outcome WHERE extraction_status = 'SUCCESS'"""


_EXPOSURES = f"""WITH {_DOCS}, {_outcome("v1")}, item AS (
  SELECT doc_id, 'characters' AS kind, CAST(n_chars AS DOUBLE) AS amount FROM outcome WHERE yield = 'full' AND doc_id % 5 <> 0
  UNION ALL
  SELECT doc_id, 'lines', CAST(len(parts) AS DOUBLE) FROM outcome WHERE yield = 'full' AND doc_id % 5 <> 0)
SELECT file_name, file_path, kind AS exposure_type, amount AS exposure_value,
       CASE WHEN kind IS NOT NULL THEN 'document' END AS basis,
       CASE WHEN kind IS NOT NULL THEN 0.5::DOUBLE END AS exposure_confidence,
       CASE WHEN kind IS NOT NULL THEN '1' END AS exposure_page_reference
FROM outcome LEFT JOIN item USING (doc_id) WHERE extraction_status = 'SUCCESS'"""

_DASHBOARD_FROM_OUTPUT = f"""WITH {_coverage_rows("v1")},
named AS (SELECT file_path, count(CASE WHEN pos % 11 <> 10 THEN line END) AS coverage_count FROM found GROUP BY file_path)
SELECT file_name, file_path, {_policy_columns("yield <> 'blank'")}, coverage_count
FROM outcome JOIN named USING (file_path)"""

# Policies per order and coverages per order line

_ORDER_FILE = "'policy_' || {0} || '.pdf' AS file_name, '/orders/' || ({0} % 16) || '/policy_' || {0} || '.pdf' AS file_path"
_POLICY = f"""policy AS (
  SELECT {_ORDER_FILE.format("o_orderkey")}, CAST(o_orderkey AS VARCHAR) AS policy_number,
         'Carrier ' || o_orderstatus AS carrier, 'Customer ' || o_custkey AS named_insured,
         strftime(o_orderdate, '%Y-%m-%d') AS effective_date,
         CASE WHEN o_orderkey % 40 <> 0 THEN strftime(CAST(o_orderdate AS DATE) + INTERVAL 12 MONTH, '%Y-%m-%d')
              ELSE 'on cancellation' END AS expiration_date,
         o_orderpriority AS policy_type,
         CASE o_orderstatus WHEN 'F' THEN 'Claims-Made' WHEN 'O' THEN 'occurrence based' END AS claims_made_or_occurrence,
         o_orderkey % 101 / 100.0::DOUBLE AS policy_confidence,
         o_orderkey % 9 AS cited, o_orderkey % 7 + 1 AS page_count, o_orderkey
  FROM orders)"""
_DASHBOARD = f"""WITH {_POLICY}, view AS (
  SELECT file_name, file_path, policy_number, carrier, named_insured, effective_date, expiration_date, policy_type,
         claims_made_or_occurrence, policy_confidence,
         count(CASE WHEN l_linenumber <> 5 THEN l_partkey END) AS coverage_count
  FROM policy LEFT JOIN lineitem ON l_orderkey = o_orderkey GROUP BY ALL)
"""
_COVERAGE_DETAIL = f"""WITH coverage AS (
  SELECT {_ORDER_FILE.format("l_orderkey")}, CASE WHEN l_linenumber <> 5 THEN 'Part ' || l_partkey END AS coverage_name,
         l_returnflag AS coverage_section, l_extendedprice AS limit_amount,
         CASE WHEN l_returnflag = 'N' THEN l_extendedprice * 2 END AS aggregate_limit,
         CASE WHEN l_discount > 0 THEN l_quantity * 100 END AS deductible_or_retention,
         l_returnflag = 'R' AS is_sublimit, l_tax AS coverage_confidence,
         CAST(l_linenumber AS VARCHAR) AS coverage_page_reference FROM lineitem)
SELECT * EXCLUDE (file_path) FROM coverage WHERE file_name = '{CHOSEN_FILE}' ORDER BY coverage_name"""

# Usage

_ESCAPES = (
    "length({0}) + 2 + (length({0}) - length(regexp_replace({0}, '[\"\\\\\\n\\r\\t\\x08\\x0c]', '', 'g')))"
    " + 5 * (length({0}) - length(regexp_replace({0}, '[^ -~\\n\\r\\t\\x08\\x0c]', '', 'g')))"
    " + 6 * (length({0}) - length(regexp_replace({0}, '[\\x{{10000}}-\\x{{10FFFF}}]', '', 'g')))"
).format("a.text")


def _cost(tokens_in: str, tokens_out: str) -> str:
    return f"CAST(printf('%.6f', {tokens_in} / 1e6 * 2.5::DOUBLE + {tokens_out} / 1e6 * 10.0::DOUBLE) AS DOUBLE)"


_LOG = f"""tokens AS (
  SELECT u.conv_id, u.turn, greatest(1, length(u.text) // 4) AS tokens_in,
         CASE WHEN a.text IS NULL THEN 0 ELSE greatest(1, ({_ESCAPES} + 11) // 4) END AS tokens_out,
         a.text IS NOT NULL AS answered
  FROM conversations u LEFT JOIN conversations a
    ON a.conv_id = u.conv_id AND a.turn = u.turn + 1 AND a.role = 'assistant'
  WHERE u.role = 'user'),
log AS (
  SELECT conv_id || '-' || turn AS log_id, CAST(conv_id AS VARCHAR) AS policy_id, 'conversation' AS prompt_stage,
         CAST(tokens_in AS INTEGER) AS input_tokens, CAST(tokens_out AS INTEGER) AS output_tokens,
         'mock' AS model_tier, 0 AS retry_count, {_cost("tokens_in", "tokens_out")} AS cost_estimate_usd,
         0 AS duration_ms, CASE WHEN answered THEN 'SUCCESS' ELSE 'FAILED' END AS status
  FROM tokens)"""
_ROLLUP = f"""WITH {_LOG}
SELECT prompt_stage, status, count(*) AS calls, CAST(sum(input_tokens) AS BIGINT) AS input_tokens,
       CAST(sum(output_tokens) AS BIGINT) AS output_tokens, CAST(sum(retry_count) AS BIGINT) AS retries,
       CAST(count(*) FILTER (status = 'FAILED') AS BIGINT) AS failures,
       CAST(sum(CAST(cost_estimate_usd AS DECIMAL(18, 6))) AS DOUBLE) AS cost_usd
FROM log GROUP BY ROLLUP (prompt_stage, status)"""

_CALLS = f"""WITH {_DOCS}, call AS (
  SELECT file_path, CAST(p + 1 AS INTEGER) AS part_no, CAST(length({_part("text", PART_CHARS)}) AS BIGINT) AS n
  FROM (SELECT *, {_part_numbers("text", PART_CHARS)} FROM docs))"""
_MOCK_PROMPT = f"replace({_text(requests.PROMPTS['baseline'])}, '{requests.PLACEHOLDER}', {_part('text')})"
_MOCK_RUN = f"""WITH {_DOCS}, t AS (
  SELECT file_path, CAST(p + 1 AS INTEGER) AS part_no, greatest(1, length({_MOCK_PROMPT}) // 4) AS tokens_in
  FROM (SELECT *, {_part_numbers("text")} FROM docs))
SELECT file_path, part_no, CAST(tokens_in AS INTEGER) AS input_tokens, 14 AS output_tokens, 'mock' AS model_used,
       {_cost("tokens_in", "0")} AS cost_estimate_usd, 'declarations' AS stage FROM t"""

# Contracts

_HEADER_KINDS = ("primary", "excess", "cyber", "unknown", "marine")
_HEADER = f"""header AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS policy_id, o_custkey % 20 = 0 AS unnamed,
         {_pick(_HEADER_KINDS, "CAST(substr(o_orderpriority, 1, 1) AS INTEGER)")} NOT IN ({_words(POLICY_TYPES)}) AS odd_type
  FROM orders)"""
_ELEMENT = f"""element AS (
  SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS element_id,
         CAST(l_orderkey AS VARCHAR) AS policy_id, l_returnflag AS coverage_section, l_linenumber = 5 AS unnamed,
         CASE WHEN l_linestatus = 'F' THEN 'coverage' WHEN l_linenumber < 7 THEN 'endorsement' ELSE 'annex' END
           NOT IN ({_words(SECTION_TYPES)}) AS odd_section,
         'Limit of insurance for part ' || l_partkey || ' as scheduled with supplier ' || l_suppkey AS passage,
         l_quantity, l_discount, l_returnflag FROM lineitem)"""
_FINDINGS = f"""WITH {_HEADER}, {_ELEMENT}, {_LOG}, finding AS (
  SELECT 'header' AS record, 'missing:named_insured' AS finding FROM header WHERE unnamed
  UNION ALL SELECT 'header', 'unknown:policy_type' FROM header WHERE odd_type
  UNION ALL SELECT 'coverage', 'missing:coverage_name' FROM element WHERE unnamed
  UNION ALL SELECT 'coverage', 'unknown:section_type' FROM element WHERE odd_section
  UNION ALL SELECT 'citation', 'empty:passage' FROM element WHERE l_quantity = 1
  UNION ALL SELECT 'citation', 'length:passage' FROM element WHERE l_quantity = 1 OR length(passage) NOT BETWEEN 50 AND 100
  UNION ALL SELECT 'log', 'missing:duration_ms' FROM log)
SELECT record, finding, count(*) AS record_count FROM finding GROUP BY ALL"""
_ORPHAN_ELEMENTS = f"""WITH {_HEADER}, {_ELEMENT}
SELECT element_id, policy_id, coverage_section FROM element
WHERE policy_id NOT IN (SELECT policy_id FROM header WHERE NOT unnamed AND NOT odd_type)"""
_ORPHAN_CITATIONS = f"""WITH {_ELEMENT}
SELECT 'C-' || element_id AS citation_id, element_id FROM element
WHERE element_id NOT IN (SELECT element_id FROM element WHERE NOT unnamed AND NOT odd_section)"""
_COMPLETENESS = f"""WITH {_ELEMENT}, scored AS (
  SELECT coverage_section, 1 + CAST(NOT unnamed AS INTEGER) + CAST(l_quantity > 5 AS INTEGER)
         + CAST(l_returnflag = 'N' AS INTEGER) + CAST(l_discount > 0 AS INTEGER) AS filled FROM element)
SELECT coverage_section, count(*) AS coverage_count, CAST(sum(filled) AS BIGINT) AS filled_fields,
       CAST(sum(filled) AS DOUBLE) / (count(*) * 5.0::DOUBLE) AS completeness FROM scored GROUP BY coverage_section"""

# Normalisation

_TYPED = f"""typed AS (
  SELECT {_ORDER_FILE.format("l_orderkey")}, 'Part ' || l_partkey AS coverage_name, l_partkey % 9 AS w,
         CASE l_partkey % 9 WHEN 1 THEN l_quantity * 1e6 WHEN 5 THEN NULL WHEN 7 THEN l_quantity * 1e3 WHEN 8 THEN NULL
              WHEN 2 THEN (l_quantity + 0.5) * 1e6 WHEN 3 THEN l_quantity * 1e6 ELSE l_extendedprice END AS limit_amount,
         CASE WHEN l_returnflag = 'N' THEN l_extendedprice END AS aggregate_limit,
         CASE l_partkey % 9 WHEN 1 THEN l_linenumber * 1e6 WHEN 2 THEN l_quantity WHEN 3 THEN l_quantity
              WHEN 6 THEN l_quantity * 1e3 WHEN 7 THEN l_linenumber * 1e3 WHEN 8 THEN l_quantity * 1e3 END
           AS deductible_or_retention,
         CASE l_partkey % 9 WHEN 2 THEN l_quantity WHEN 3 THEN l_quantity WHEN 6 THEN l_quantity * 1e3
              WHEN 7 THEN l_quantity * 1e3 WHEN 8 THEN l_quantity * 1e3 END AS stated_deductible,
         {_pick(COVERAGE_TYPES, "l_linenumber % 6 + 1")} IN ({_words(SUBLIMIT_TYPES)}) AS is_sublimit
  FROM lineitem)"""
_NORMALIZED = f"""WITH {_TYPED}
SELECT file_path, coverage_name, limit_amount, aggregate_limit, deductible_or_retention, stated_deductible, is_sublimit,
       CASE WHEN limit_amount IS NOT NULL OR aggregate_limit IS NOT NULL THEN NULL
            WHEN deductible_or_retention IS NOT NULL THEN '{INCLUDED_STATES[2]}'
            WHEN is_sublimit THEN '{INCLUDED_STATES[1]}' ELSE '{INCLUDED_STATES[0]}' END AS included_state,
       concat_ws(',', CASE WHEN w NOT IN (1, 5, 7, 8) THEN 'money' END, CASE WHEN w IN (1, 7) THEN 'layer' END,
                 CASE WHEN w IN (2, 3) THEN 'waiting' END, CASE WHEN w = 4 THEN 'percent_only' END,
                 CASE WHEN w = 5 THEN 'no_limit' END, CASE WHEN w = 8 THEN 'unreadable_limit' END,
                 CASE WHEN w = 5 THEN 'unreadable_deductible' END, CASE WHEN w = 7 THEN 'layer_and_deductible' END, CASE WHEN is_sublimit THEN 'sublimit' END) AS rules
FROM typed"""
_RULES = f"""WITH {_TYPED}, used AS (
  SELECT 'money' AS rule FROM typed WHERE w NOT IN (1, 5, 7, 8) UNION ALL SELECT 'layer' FROM typed WHERE w IN (1, 7)
  UNION ALL SELECT 'waiting' FROM typed WHERE w IN (2, 3) UNION ALL SELECT 'percent_only' FROM typed WHERE w = 4
  UNION ALL SELECT 'no_limit' FROM typed WHERE w = 5 UNION ALL SELECT 'unreadable_limit' FROM typed WHERE w = 8
  UNION ALL SELECT 'unreadable_deductible' FROM typed WHERE w = 5
  UNION ALL SELECT 'layer_and_deductible' FROM typed WHERE w = 7 UNION ALL SELECT 'sublimit' FROM typed WHERE is_sublimit)
SELECT rule, count(*) AS coverage_count FROM used GROUP BY rule"""
_CONFIDENCE = f"""WITH {_coverage_rows("v1")}, banded AS (
  SELECT length(line) % 101 AS c FROM found WHERE present)
SELECT CASE WHEN c IS NULL THEN NULL WHEN c >= 95 THEN 'explicit' WHEN c >= 75 THEN 'clear' WHEN c >= 50 THEN 'partial'
            ELSE 'uncertain' END AS band, count(*) AS coverage_count FROM banded GROUP BY 1"""
_TERMS = f"""WITH {_POLICY}, term AS (
  SELECT *, date_diff('day', CAST(effective_date AS DATE), TRY_CAST(expiration_date AS DATE)) AS days FROM policy)
SELECT file_path, effective_date, expiration_date, CAST(days AS INTEGER) AS term_days,
       CASE WHEN days IS NULL THEN 'unreadable' WHEN days <= 0 THEN 'reversed' WHEN days BETWEEN 365 AND 366 THEN 'annual'
            ELSE 'other' END AS term_status FROM term"""
_PAGE_CHECK = f"""WITH {_POLICY}
SELECT cited >= 1 AND cited <= page_count AS pages_exist, count(*) AS policy_count FROM policy GROUP BY 1"""
_ENUMS = """SELECT 'unknown' AS policy_type,
  CASE o_orderstatus WHEN 'F' THEN 'claims-made' WHEN 'O' THEN 'occurrence' ELSE 'unknown' END AS claims_made_or_occurrence,
  count(*) AS policy_count FROM orders GROUP BY 2"""

# Comparison

_COMPARE = f"""WITH {_LINES}, side AS (
  SELECT file_path, line, lang, 1 AS a, 0 AS b FROM lines
  WHERE pos % 11 <> 10 AND (shape IN {_FULL["v1"]} OR (shape IN {_FIRST["v1"]} AND pos = 0))
  UNION ALL
  SELECT file_path, line, lang, 0, 1 FROM lines
  WHERE pos % 11 <> 10 AND (shape IN {_FULL["v2"]} OR (shape IN {_FIRST["v2"]} AND pos = 0))),
pair AS (SELECT file_path, line, lang, max(a) AS a, max(b) AS b FROM side GROUP BY ALL),
answered AS (
  SELECT file_path FROM docs
  WHERE shape IN {_FULL["v1"]} OR shape IN {_FIRST["v1"]} OR shape IN {_BLANK["v1"]} OR shape IN {_FULL["v2"]} OR shape IN {_FIRST["v2"]})
SELECT file_path, count(*) FILTER (a = 1 AND b = 0) AS first_only, count(*) FILTER (b = 1 AND a = 0) AS second_only,
       count(*) FILTER (a = 1 AND b = 1) AS in_both FROM answered LEFT JOIN pair USING (file_path) GROUP BY file_path"""


_RUNS = f"""WITH line AS (
  SELECT {_ORDER_FILE.format("l_orderkey")}, CASE WHEN l_linenumber <> 5 THEN 'Part ' || l_partkey END AS coverage_name,
         l_returnflag AS coverage_section, l_extendedprice AS price, l_orderkey % 10 AS fate FROM lineitem),
side AS (
  SELECT file_path, coverage_name, coverage_section, price AS limit_amount, 1 AS a, 0 AS b FROM line
  UNION ALL
  SELECT file_path, coverage_name, coverage_section, CASE WHEN fate = 2 THEN price + 1 ELSE price END, 0,
         CASE fate WHEN 3 THEN 2 ELSE 1 END FROM line WHERE fate <> 1),
whole AS (
  SELECT file_path, coverage_name, coverage_section, limit_amount, CAST(sum(a) AS BIGINT) AS first_rows, CAST(sum(b) AS BIGINT) AS second_rows
  FROM side GROUP BY ALL),
judged AS (
  SELECT *, least(first_rows, second_rows) AS kept, greatest(first_rows - second_rows, 0) AS removed,
         greatest(second_rows - first_rows, 0) AS added FROM whole)"""
_RUN_CHANGES = f"""{_RUNS}, total AS (
  SELECT file_path, sum(kept) AS kept, sum(removed) AS r, sum(added) AS d FROM judged GROUP BY file_path)
SELECT file_path, CAST(kept AS BIGINT) AS kept, CAST(least(r, d) AS BIGINT) AS changed, CAST(r - least(r, d) AS BIGINT) AS removed,
       CAST(d - least(r, d) AS BIGINT) AS added FROM total"""

# Terms

_IN_TERMS = """WITH term AS (
  SELECT o_custkey AS insured, CAST(o_orderkey AS VARCHAR) AS policy_number, CAST(o_orderdate AS DATE) AS starts,
         CAST(CAST(o_orderdate AS DATE) + INTERVAL 12 MONTH AS DATE) AS ends FROM orders WHERE o_orderkey % 40 <> 0),
loss AS (
  SELECT o_orderkey AS loss_id, o_custkey AS insured, CAST(o_orderdate AS DATE) + CAST(o_orderkey % 501 AS INTEGER) AS day FROM orders)"""
_IN_FORCE = f"""{_IN_TERMS}
SELECT loss_id, policy_number, CAST(day - starts AS INTEGER) AS days_in FROM loss JOIN term USING (insured)
WHERE starts <= day AND day < ends"""
_NEWEST_TERM = f"""{_IN_TERMS}, placed AS (
  SELECT loss_id, policy_number, starts, row_number() OVER (PARTITION BY loss_id ORDER BY starts DESC, ends DESC, policy_number DESC) AS place
  FROM loss JOIN term USING (insured) WHERE starts <= day)
SELECT loss_id, policy_number, strftime(starts, '%Y-%m-%d') AS starts
FROM loss LEFT JOIN (SELECT * FROM placed WHERE place = 1) USING (loss_id)"""
_COVER = f"""{_IN_TERMS}, edge AS (
  SELECT *, max(ends) OVER (PARTITION BY insured ORDER BY starts, ends ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM term),
part AS (
  SELECT *, sum(CASE WHEN starts <= reach THEN 0 ELSE 1 END) OVER (
    PARTITION BY insured ORDER BY starts, ends ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS n FROM edge),
whole AS (
  SELECT insured, n, min(starts) AS b, max(ends) AS e, count(*) AS term_count, sum(ends - starts) AS term_days FROM part GROUP BY insured, n)
SELECT 'Customer ' || insured AS insured, strftime(b, '%Y-%m-%d') AS cover_starts, strftime(e, '%Y-%m-%d') AS cover_ends, term_count,
       CAST(e - b AS BIGINT) AS covered_days, CAST(term_days - (e - b) AS BIGINT) AS overlap_days,
       CAST(b - lag(e) OVER (PARTITION BY insured ORDER BY n) AS INTEGER) AS gap_days FROM whole"""


def _odd(rules: str) -> str:
    """Shapes 3 and 7 are no JSON, 4 has no response, 6 has a number as its content."""
    answer = """'{"policy":{"policy_number":"PN-' || doc_id || '","carrier":"' || sha256(text) || '"}}'"""
    number = """'{"choices":[{"finish_reason":"stop","message":{"content":NaN}}],"usage":{"completion_tokens":9}}'"""
    if rules == "v1":
        content, message = "CASE WHEN k = 6 THEN 'NaN' END", _text("'float' object has no attribute 'strip'")
    else:
        content, message = "NULL", f"'Unable to extract text content from model response: ' || {number}"
    return f"""WITH {_DOCS}, odd AS (SELECT *, doc_id % 8 AS k, {answer} AS answer FROM docs)
SELECT file_path, CASE WHEN k IN (0, 1, 2, 5) THEN 'SUCCESS' ELSE 'FAILED' END AS extraction_status,
       {"k = 5" if rules == "v1" else "FALSE"} AS was_truncated,
       md5(CASE WHEN k IN (0, 1, 2, 5) THEN answer END) AS model_output_json,
       md5(CASE WHEN k IN (0, 1, 2, 5) THEN answer ELSE {content} END) AS raw_model_response,
       md5(CASE k WHEN 3 THEN 'stored response is not valid JSON' WHEN 7 THEN 'stored response is not valid JSON'
                  WHEN 4 THEN 'no capacity' WHEN 6 THEN {message} END) AS error_message
FROM odd"""


def _listing(tail: str) -> str:
    return f"""WITH listed AS (
  SELECT 'doc_' || doc_id || (['.pdf', '.PDF', '.Pdf', '.txt'])[doc_id % 4 + 1] AS file_name, source, n_chars AS length
  FROM documents WHERE doc_id % 4 <> 3)
SELECT file_name, '/corpus/' || source || '/' || file_name AS file_path, length FROM listed {tail}"""


def _stub(rules: str) -> str:
    output, raw, count = (
        (requests.STUB_V1_UNPAGED, '{"stub": true}', "NULL") if rules == "v1" else (requests.STUB_V2, requests.STUB_V2, "len(parts)")
    )
    return f"""WITH {_DOCS}
SELECT file_name, file_path, CAST({count} AS INTEGER) AS page_count,
       CAST(length(text) AS BIGINT) AS request_chars, 'STUB' AS model_name,
       'SUCCESS' AS extraction_status, {_text(output)} AS model_output_json, {_text(raw)} AS raw_model_response,
       CAST(NULL AS VARCHAR) AS error_message, '{RUN_TIME}' AS processed_at FROM docs"""


def all_oracles() -> dict[str, str]:
    pages = f"""WITH {_PAGED}
SELECT file_name, file_path, CASE WHEN good THEN page_count END AS page_count, CASE WHEN good THEN policy_text END AS policy_text,
       CASE WHEN good THEN 'SUCCESS' ELSE 'FAILED' END AS extraction_status,
       CASE WHEN NOT good THEN 'damaged file' END AS error_message
FROM (SELECT *, doc_id % 50 <> 49 AS good FROM whole)"""
    return {
        "file_listing": _listing(""),
        "file_listing_capped": _listing(f"ORDER BY file_path LIMIT {LISTED}"),
        "page_text_arrays": pages,
        "page_text_pages": pages,
        "page_text_arrivals": pages,
        "variant_documents": f"""WITH {_ELEMENTS}
SELECT file_name, file_path, page_count, md5(policy_text) AS policy_text, extraction_status,
       CASE WHEN error_message LIKE '%Expecting value%' THEN {_text("No text-like content returned by ai_parse_document")}
            ELSE error_message END AS error_message FROM result""",
        "page_text_elements": f"WITH {_ELEMENTS} SELECT * FROM result",
        "page_text_streamed": f"WITH {_ELEMENTS} SELECT * FROM result",
        "manifest_changes": _MANIFEST,
        "document_status": f"""WITH {_ELEMENTS}
SELECT extraction_status, error_message, count(*) AS document_count, CAST(sum(page_count) AS BIGINT) AS page_total
FROM result GROUP BY ALL""",
        "request_build": _requests({"baseline": requests.PROMPTS["baseline"]}, keep_failed=True, system=True),
        "request_variants": _requests(requests.PROMPTS, keep_failed=False, system=False),
        "request_parts": _requests({"baseline": requests.PROMPTS["baseline"]}, True, True, PART_CHARS),
        "request_parts_pages": _requests({"baseline": requests.PROMPTS["baseline"]}, False, False, PART_CHARS),
        "stub_run_v1": _stub("v1"),
        "stub_run_v2": _stub("v2"),
        "replay_run": f"""WITH {_DOCS}, {_outcome("v2")}
SELECT file_path, CAST(len(parts) AS INTEGER) AS page_count, CAST(p + 1 AS INTEGER) AS part_no,
       CAST(length({_part("text")}) AS BIGINT) AS request_chars,
       CASE WHEN p = 0 THEN extraction_status ELSE 'FAILED' END AS extraction_status, p = 0 AND was_repaired AS was_repaired
FROM (SELECT *, {_part_numbers("text")} FROM outcome)""",
        "completion_run": f"""{_CALLS}
SELECT file_path, part_no, n AS request_chars, CASE WHEN n % 7 = 0 THEN 'FAILED' ELSE 'SUCCESS' END AS extraction_status,
       CASE WHEN n % 7 <> 0 THEN '{{"policy": {{"policy_number": "' || n || '"}}}}' END AS model_output_json,
       CASE WHEN n % 7 = 0 THEN 'no capacity' END AS error_message FROM call""",
        "retry_run": f"""{_CALLS}
SELECT file_path, part_no, n AS request_chars, 'SUCCESS' AS extraction_status,
       '{{"policy": {{"policy_number": "' || CASE WHEN n % 7 = 0 THEN 'again ' ELSE '' END || n || '"}}}}' AS model_output_json,
       CAST(NULL AS VARCHAR) AS error_message FROM call""",
        "policy_of_parts": f"""{_CALLS}
SELECT file_path, arg_min(CAST(n AS VARCHAR), part_no) AS policy_number FROM call WHERE n % 7 <> 0 GROUP BY file_path""",
        "reported_usage": f"""{_CALLS}, used AS (
  SELECT *, CAST(CASE WHEN n % 7 = 0 THEN greatest(1, n // 4) ELSE n END AS INTEGER) AS input_tokens,
         CASE WHEN n % 7 = 0 THEN 0 ELSE 5 END AS output_tokens FROM call)
SELECT file_path, part_no, input_tokens, output_tokens, '{MODEL}' AS model_used,
       {_cost("input_tokens", "output_tokens")} AS cost_estimate_usd, 'extraction' AS stage FROM used""",
        "mock_run": _MOCK_RUN,
        "response_status_v1": _status("v1"),
        "response_status_v2": _status("v2"),
        "response_text_v1": _odd("v1"),
        "response_text_v2": _odd("v2"),
        "truncation_report": _truncation(),
        "repaired_coverages": _coverages("v1", "yield = 'first'"),
        "policy_summary": _policies("v1"),
        "policy_summary_v2": _policies("v2"),
        "coverages": _coverages("v1"),
        "coverages_v2": _coverages("v2"),
        "exposures": _EXPOSURES,
        "output_count": "SELECT count(*) AS row_count FROM documents",
        "dashboard_from_output": _DASHBOARD_FROM_OUTPUT,
        "dashboard_view": _DASHBOARD + "SELECT * FROM view",
        "dashboard_joined": _DASHBOARD + "SELECT * FROM view",
        "dashboard_rows": _DASHBOARD + "SELECT * FROM view ORDER BY file_name, file_path, policy_number",
        "file_options": _DASHBOARD + "SELECT file_name FROM view ORDER BY file_name",
        "dashboard_for_file": _DASHBOARD + f"SELECT * FROM view WHERE file_name = '{CHOSEN_FILE}'",
        "coverage_detail": _COVERAGE_DETAIL,
        "saved_dashboard": _DASHBOARD + "SELECT * FROM view",
        "saved_coverage_detail": _COVERAGE_DETAIL,
        "usage_log": f"WITH {_LOG} SELECT * FROM log",
        "usage_rollup": _ROLLUP,
        "contract_violations": _FINDINGS,
        "orphan_elements": _ORPHAN_ELEMENTS,
        "orphan_citations": _ORPHAN_CITATIONS,
        "completeness": _COMPLETENESS,
        "normalized_coverages": _NORMALIZED,
        "normalization_report": _RULES,
        "confidence_bands": _CONFIDENCE,
        "policy_term_check": _TERMS,
        "page_reference_check": _PAGE_CHECK,
        "policy_enums": _ENUMS,
        "losses_in_force": _IN_FORCE,
        "newest_term_of_loss": _NEWEST_TERM,
        "unbroken_cover": _COVER,
        "run_difference": _RUNS + " SELECT * FROM judged WHERE added > 0 OR removed > 0",
        "run_changes": _RUN_CHANGES,
        "variant_compare": _COMPARE,
    }
