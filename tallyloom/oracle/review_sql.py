"""Statements for review texts, call planning and model answers."""

from __future__ import annotations

from .. import catalog
from ..functions import fixed_values as fv
from ..sources import bindings as b
from .sql import count_if, describe, half_even, quoted, share, with_ctes

EXCERPT = "substr(regexp_replace(raw_text, '^\\s+|\\s+$', '', 'g'), 1, 200)"


def text(pattern: str) -> str:
    return "'" + pattern.replace("'", "''") + "'"


def soft(x: str) -> str:
    return f"trim(replace(lower(regexp_replace({x}, '\\s+', ' ', 'g')), 'ß', 'ss'))"


def issue(category: str, subcategory: str, evidence: str, confidence: float) -> str:
    return (
        f"{{'category': '{category}', 'subcategory': '{subcategory}', 'evidence': {evidence}, "
        f"'confidence': {confidence!r}::DOUBLE}}"
    )


def _patterns() -> str:
    kinds: dict[tuple[str, str], list[str]] = {}
    for pattern, category, subcategory, confidence in fv.ISSUE_PATTERNS:
        kinds.setdefault((category, subcategory), []).append(
            f"WHEN regexp_matches(normalized_text, {text(pattern)}) THEN {issue(category, subcategory, EXCERPT, confidence)}"
        )
    cells = ", ".join(f"CASE {' '.join(v)} END" for v in kinds.values())
    return f"list_filter([{cells}], lambda x: x IS NOT NULL)"


RECORDS = f"""split AS (
  SELECT doc_id, list_append(string_split(text, chr(10)), NULL) AS x FROM documents
), lines AS (
  SELECT doc_id, unnest(x) AS message, unnest(range(0, len(x))) AS line FROM split
), reviews AS (
  SELECT doc_id || '-' || line AS review_id, CAST(doc_id AS VARCHAR) AS order_id,
    CAST(1 + (doc_id + line) % 5 AS INT) AS review_score,
    CASE WHEN message IS NOT NULL THEN
      {quoted(b.REVIEW_TITLES)}[CAST((doc_id * 7 + line * 3) % {b.TITLE_MODULUS} AS INT) + 1] END
      AS review_comment_title, message AS review_comment_message
  FROM lines
), raws AS (
  SELECT review_id, order_id, review_score, concat_ws(' ',
    NULLIF(regexp_replace(review_comment_title, '^\\s+|\\s+$', '', 'g'), ''),
    NULLIF(regexp_replace(review_comment_message, '^\\s+|\\s+$', '', 'g'), '')) AS raw_text
  FROM reviews WHERE review_score <= 3
), records AS (
  SELECT *, sha1(normalized_text) AS text_hash FROM (
    SELECT *, trim(regexp_replace(strip_accents(replace(lower(regexp_replace(regexp_replace(
      raw_text, '<[^>]+>', ' ', 'g'), 'https?://\\S+|www\\.\\S+', ' ', 'gi')), 'ß', 'ss')),
      '[^\\p{{L}}\\p{{N}}_]+', ' ', 'g')) AS normalized_text
    FROM raws)
)"""

TEXTS = (
    RECORDS
    + f""", groups AS (
  SELECT text_hash AS dedup_key, min(review_id) AS review_id, COUNT(*) AS n_reviews FROM records GROUP BY 1
), firsts AS (
  SELECT g.*, raw_text, normalized_text FROM groups g JOIN records r USING (review_id)
), labelled AS (
  SELECT *, CASE WHEN normalized_text = '' THEN [{issue("general", "negative_low_detail", "''", 0.75)}]
      WHEN regexp_matches(normalized_text, {text(fv.POSITIVE_PATTERN)}) THEN [{issue("general", "unclear", EXCERPT, 0.55)}]
      WHEN len(string_split(normalized_text, ' ')) <= 4
        OR regexp_matches(normalized_text, {text(fv.LOW_INFORMATION_PATTERN)})
        THEN [{issue("general", "negative_low_detail", EXCERPT, 0.72)}]
      ELSE NULLIF({_patterns()}, []) END AS issues,
    normalized_text = '' OR regexp_matches(normalized_text, {text(fv.POSITIVE_PATTERN)}) AS needs_manual_review,
    len(regexp_extract_all(normalized_text, {text(fv.COMPLEX_MARKER_PATTERN)})) AS markers,
    length(normalized_text) AS len,
    CAST(length(raw_text) // 4 + 1 AS BIGINT) AS tok
  FROM firsts
), texts AS (
  SELECT *, CASE WHEN issues IS NOT NULL THEN 'rule'
      WHEN len > 160 OR (len > 120 AND markers >= 2) THEN 'large_llm' ELSE 'small_llm' END AS route,
    CASE WHEN issues IS NOT NULL THEN 'rule or low-information template'
      WHEN len > 160 THEN 'length ' || len || ' above 160'
      WHEN len > 120 AND markers >= 2 THEN 'medium length with several issue signals'
      ELSE 'short and not covered by rules' END AS reason
  FROM labelled
)"""
)

CAP = f"<= {round(fv.DEFAULT_COST_CAP_USD * 100_000_000)}"

CALLS = (
    TEXTS
    + f""", items AS (
  SELECT dedup_key, tok + 80 AS t, row_number() OVER (ORDER BY dedup_key) AS rn,
    CAST(sum(tok + 80) OVER (ORDER BY dedup_key) AS BIGINT) AS cum
  FROM texts WHERE route = 'small_llm'
), nexts AS MATERIALIZED (
  SELECT a.rn, greatest(c.rn, a.rn + 1) AS nx FROM
    (SELECT rn, cum - t + {fv.BATCH_TOKEN_BUDGET} AS edge FROM items) a ASOF JOIN items c ON a.edge < c.cum
), starts AS (
  SELECT CAST(1 AS BIGINT) AS rn UNION ALL SELECT n.nx FROM starts s JOIN nexts n ON s.rn = n.rn
), numbered AS (
  SELECT rn, row_number() OVER (ORDER BY rn) - 1 AS batch_id FROM starts
), batches AS (
  SELECT i.dedup_key, CAST(i.t AS BIGINT) AS tokens, n.batch_id FROM items i ASOF JOIN numbered n ON i.rn >= n.rn
), calls AS (
  SELECT 1 AS phase, min(dedup_key) AS call_key, batch_id, COUNT(*) AS items,
    CAST(SUM(tokens) AS BIGINT) AS input_tokens, greatest(200, COUNT(*) * 120) AS output_tokens,
    CAST(SUM(tokens) * 15 + greatest(200, COUNT(*) * 120) * 60 AS BIGINT) AS cost
  FROM batches GROUP BY batch_id
  UNION ALL
  SELECT 2, dedup_key, NULL, 1, tok + 180, 450, (tok + 180) * 250 + 450 * 1000
  FROM texts WHERE route = 'large_llm'
), gated AS (
  SELECT *, CAST(SUM(cost) OVER (ORDER BY phase, call_key) AS BIGINT) AS running FROM calls
), plan AS (SELECT *, running {CAP} AS accepted FROM gated)"""
)


def _answer_issues() -> str:
    def one(category: str, subcategory: str, evidence: str, confidence: str) -> str:
        return (
            f"{{'category': '{category}', 'subcategory': '{subcategory}', 'evidence': {evidence}, "
            f"'confidence': CAST({confidence} AS DOUBLE)}}"
        )

    said = "substr(raw_text, 1, 30)"
    conf = "CASE kind WHEN 2 THEN 1.2 WHEN 5 THEN 0.69 ELSE 0.9 END"
    plain = one("delivery", "delay", f"CASE WHEN kind = 4 THEN 'texto que não existe aqui' ELSE {said} END", conf)
    return f"""CASE kind WHEN 1 THEN [{one("weather", "delay", said, "0.9")}] WHEN 3 THEN []
      WHEN 7 THEN [{plain}, {one("product", "defective", f"lower({said})", "0.8")}] ELSE [{plain}] END"""


KINDS = [f"{c}.{s}" for c, subs in fv.TAXONOMY.items() for s in subs]
# An answer of kind 0 does not parse and one of kind 6 never came.
JUDGED = f"""answers AS (
  SELECT dedup_key, raw_text, tier, kind, CASE WHEN kind NOT IN (0, 6) THEN {_answer_issues()} END AS issues
  FROM (SELECT *, 'small' AS tier, CAST('0x' || dedup_key[1] AS INT) AS kind FROM texts WHERE route <> 'rule'
    UNION ALL SELECT *, 'large', CAST('0x' || dedup_key[2] AS INT) FROM texts WHERE route <> 'rule')
), graded AS (
  SELECT *, len(issues) > 0 AND len(list_filter(issues, lambda i:
      NOT list_contains({quoted(KINDS)}, i.category || '.' || i.subcategory)
      OR i.confidence < 0 OR i.confidence > 1)) = 0 AS well_formed,
    len(list_filter(issues, lambda i: NOT contains({soft("raw_text")}, {soft("i.evidence")}))) = 0 AS supported,
    list_min(list_transform(issues, lambda i: i.confidence)) < 0.7 AS unsure
  FROM answers
), judged AS (
  SELECT dedup_key, tier, CASE WHEN kind = 6 THEN 'missing' WHEN kind = 0 OR NOT well_formed THEN 'schema_error'
      WHEN tier = 'small' AND unsure THEN 'low_confidence' WHEN NOT supported THEN 'evidence_error'
      WHEN unsure THEN 'low_confidence' ELSE 'accepted' END AS status,
    CASE WHEN kind NOT IN (0, 6) AND well_formed THEN issues END AS issues, kind = 15 AS needs_manual_review
  FROM graded
)"""

OUTCOMES = f"""outcomes AS (
  SELECT t.dedup_key, t.raw_text, t.tok, j.status, j.issues AS found, j.needs_manual_review AS flag,
    CASE WHEN NOT p.accepted THEN 'fallback' WHEN j.status = 'accepted' THEN 'done'
      WHEN t.len >= 100 OR t.markers >= 2 OR regexp_matches(t.normalized_text, {text(fv.HIGH_VALUE_PATTERN)}) THEN 'retry'
      ELSE 'fallback' END AS outcome
  FROM texts t JOIN batches b USING (dedup_key) JOIN plan p ON p.phase = 1 AND p.batch_id = b.batch_id
    JOIN judged j ON t.dedup_key = j.dedup_key AND j.tier = 'small'
), retries AS (
  SELECT dedup_key AS call_key, tok + 180 AS input_tokens, 450 AS output_tokens,
    (tok + 180) * 250 + 450 * 1000 AS cost,
    (SELECT SUM(cost) FROM calls) + SUM((tok + 180) * 250 + 450 * 1000) OVER (ORDER BY dedup_key) {CAP}
      AS accepted
  FROM outcomes WHERE outcome = 'retry'
), asked AS (
  SELECT dedup_key, raw_text, p.accepted FROM texts t JOIN plan p ON p.phase = 2 AND p.call_key = t.dedup_key
  UNION ALL
  SELECT dedup_key, raw_text, accepted FROM outcomes o JOIN retries r ON r.call_key = o.dedup_key
), answered AS (
  SELECT a.*, j.status, j.issues AS found, j.needs_manual_review AS flag,
    a.accepted AND j.status IN ('accepted', 'low_confidence') AS kept
  FROM asked a JOIN judged j ON a.dedup_key = j.dedup_key AND j.tier = 'large'
), results AS (
  SELECT dedup_key, issues, 'rule' AS method, NULL AS model, needs_manual_review FROM texts WHERE route = 'rule'
  UNION ALL SELECT dedup_key, found, 'small_llm', 'small', flag FROM outcomes WHERE outcome = 'done'
  UNION ALL SELECT dedup_key, [{issue("general", "unclear", EXCERPT, 0.5)}], 'offline_small_llm_fallback', NULL, true
    FROM outcomes WHERE outcome = 'fallback'
  UNION ALL SELECT dedup_key, found, 'large_llm', 'large', flag OR status = 'low_confidence' FROM answered WHERE kept
  UNION ALL SELECT dedup_key, [{issue("general", "unclear", EXCERPT, 0.5)}], 'offline_large_llm_fallback', NULL, true
    FROM answered WHERE NOT kept
), expanded AS (
  SELECT review_id, order_id, review_score, raw_text, text_hash AS normalized_text_hash, method, model,
    needs_manual_review,
    NOT needs_manual_review AND len(list_filter(issues, lambda i: i.category <> 'general')) > 0 AS actionable_for_seller,
    unnest(issues) AS i, unnest(range(0, len(issues))) AS issue_no
  FROM records JOIN results ON text_hash = dedup_key
)"""

ISSUE_COLUMNS = "i.category AS category, i.subcategory AS subcategory, {} AS evidence, i.confidence AS confidence"


def on_records(body: str) -> str:
    return with_ctes(RECORDS) + body


def on_texts(body: str) -> str:
    return with_ctes(TEXTS) + body


def on_calls(body: str, *more: str) -> str:
    return with_ctes(CALLS, *more).replace("WITH ", "WITH RECURSIVE ", 1) + body


def without_cap(statement: str) -> str:
    """The same statement with a gate that lets every call through."""
    assert CAP in statement
    return statement.replace(CAP, "IS NOT NULL")


def exploded(source: str, keep: str, where: str = "true") -> str:
    return f"""SELECT {keep}, CAST(issue_no AS INT) AS issue_no, {ISSUE_COLUMNS.format("i.evidence")}
      FROM (SELECT {keep}, unnest(issues) AS i, unnest(range(0, len(issues))) AS issue_no
        FROM {source} WHERE {where})"""


def _sample() -> str:
    head = catalog.SAMPLE_SIZE // 3
    return on_texts(
        f"""SELECT dedup_key, route FROM ranked WHERE rank <= {head} UNION ALL
        SELECT dedup_key, route FROM (SELECT *, row_number() OVER (ORDER BY dedup_key) AS pos FROM ranked WHERE rank > {head})
        WHERE pos <= {catalog.SAMPLE_SIZE} - (SELECT COUNT(*) FROM ranked WHERE rank <= {head})""".replace(
            "FROM ranked",
            "FROM (SELECT dedup_key, route, row_number() OVER (PARTITION BY route ORDER BY dedup_key) AS rank FROM texts)",
        )
    )


def _metadata() -> str:
    methods = ["rule", "small_llm", "large_llm", "offline_small_llm_fallback", "offline_large_llm_fallback"]
    per_method = ", ".join(
        f"(SELECT COUNT(*) FROM records JOIN results ON text_hash = dedup_key WHERE method = '{m}') AS {m}_records"
        for m in methods
    )
    per_route = ", ".join(
        f"(SELECT COUNT(*) FROM texts WHERE route = '{r}') AS {r}_texts" for r in ("rule", "small_llm", "large_llm")
    )
    def errors(status: str) -> str:
        """Answers with this fault to calls that were made: to small batches and to single texts."""
        return f"""(SELECT COUNT(*) FROM batches b JOIN plan p ON p.phase = 1 AND p.batch_id = b.batch_id
          JOIN judged j ON j.dedup_key = b.dedup_key AND j.tier = 'small' WHERE p.accepted AND j.status = '{status}')
          + (SELECT COUNT(*) FROM asked a JOIN judged j ON j.dedup_key = a.dedup_key AND j.tier = 'large'
          WHERE a.accepted AND j.status = '{status}')"""

    made = """(SELECT cost, input_tokens, output_tokens, accepted FROM plan UNION ALL
      SELECT cost, input_tokens, output_tokens, accepted FROM retries)"""
    return f"""SELECT COUNT(*) AS record_count, {count_if("raw_text = ''")} AS empty_text_count,
      (SELECT COUNT(*) FROM texts) AS dedup_count, {per_route}, {per_method},
      (SELECT CAST(SUM(cost) FILTER (WHERE accepted) AS DOUBLE) / 1e8 FROM {made}) AS estimated_cost_usd,
      (SELECT CAST(SUM(input_tokens) FILTER (WHERE accepted) AS BIGINT) FROM {made}) AS estimated_input_tokens,
      (SELECT CAST(SUM(output_tokens) FILTER (WHERE accepted) AS BIGINT) FROM {made}) AS estimated_output_tokens,
      (SELECT {count_if("accepted")} FROM {made}) AS llm_call_count,
      (SELECT bool_or(NOT accepted) FROM {made}) AS budget_exhausted,
      {errors("schema_error")} AS schema_error_count, {errors("evidence_error")} AS evidence_error_count
      FROM records"""


def _metrics() -> str:
    def rate(a: str, c: str) -> str:
        return half_even(share(a, c), 1)

    return f"""WITH judged AS (
      SELECT CAST(1 + doc_id % 3 AS INT) AS batch,
        ['rule', 'small_llm', 'large_llm'][CAST((doc_id // 3) % 3 AS INT) + 1] AS method,
        quality, toxic, 1 + doc_id % 3 AS issues, 1 + doc_id % 2 AS true_issues FROM labels)
      SELECT batch, method, COUNT(*) AS reviews, {rate("SUM(quality)", "COUNT(*)")} AS classification_accuracy_pct,
        {rate("SUM(issues - toxic)", "SUM(issues)")} AS evidence_compliance_pct,
        {rate("SUM(1 - quality)", "SUM(true_issues)")} AS missed_recall_pct,
        {rate("SUM(toxic)", "SUM(issues)")} AS hallucination_pct,
        {rate("SUM(1 - toxic)", "COUNT(*)")} AS actionable_accuracy_pct
      FROM judged GROUP BY GROUPING SETS ((), (batch), (method))"""


#: Results that no gate cuts short.
UNCAPPED = (
    "escalation", "merged_results", "expanded_reviews", "issue_counts", "method_counts", "accuracy_sample", "extraction_metadata",
)


def statements() -> dict[str, str]:
    every = _statements()
    capped = {f"{name}_capped": every[name] for name in ("merged_results", "extraction_metadata")}
    out = {name: without_cap(s) if name in UNCAPPED else s for name, s in every.items()} | capped
    # What is written is what is read back.
    return out | {"results_json": out["expanded_reviews"], "metadata_json": out["extraction_metadata"]}


def _statements() -> dict[str, str]:
    full = (JUDGED, OUTCOMES)
    review_columns = (
        "review_id, order_id, review_score, raw_text, normalized_text_hash, method, model, "
        "needs_manual_review, actionable_for_seller"
    )
    adapted = f"CASE WHEN contains({soft('raw_text')}, {soft('i.evidence')}) AND (i.evidence <> '' OR raw_text = '') THEN i.evidence ELSE {EXCERPT} END"
    return {
        "low_score_reviews": on_records("SELECT * FROM reviews WHERE review_score <= 3"),
        "review_raw_text": on_records("SELECT review_id, raw_text FROM records"),
        "normalized_text": on_records("SELECT review_id, normalized_text FROM records"),
        "text_hash": on_records("SELECT review_id, text_hash FROM records"),
        "dedup_groups": on_texts("SELECT dedup_key, review_id, raw_text, n_reviews FROM firsts"),
        "near_duplicates": on_texts(
            """SELECT dedup_key, group_key, group_texts, group_reviews FROM (
              WITH RECURSIVE words AS (
                SELECT DISTINCT dedup_key AS k, unnest(string_split(normalized_text, ' ')) AS w FROM firsts
              ), sets AS (
                SELECT k, md5(string_agg(w, ' ' ORDER BY w)) AS c, COUNT(*) AS size FROM words WHERE w <> '' GROUP BY 1
              ), classes AS (SELECT c, min(k) AS k, any_value(size) AS size FROM sets GROUP BY 1
              ), of_class AS (SELECT classes.c, classes.k, size, w FROM classes JOIN words USING (k) WHERE w <> ''
              ), common AS (
                SELECT a.c AS x, b.c AS y, any_value(a.size) AS m, any_value(b.size) AS n, COUNT(*) AS s
                FROM of_class a JOIN of_class b ON a.w = b.w AND a.c < b.c AND 5 * a.size >= 4 * b.size AND 5 * b.size >= 4 * a.size GROUP BY 1, 2
              ), links AS (SELECT x, y FROM common WHERE 100 * s >= 80 * (m + n - s)
              ), both_ways AS (SELECT x, y FROM links UNION SELECT y, x FROM links
              ), reached AS (
                SELECT c AS node, c AS other FROM classes UNION
                SELECT node, y FROM reached JOIN both_ways ON x = other
              ), labels AS (SELECT node AS c, min(other) AS label FROM reached GROUP BY 1
              ), placed AS (
                SELECT dedup_key, n_reviews, COALESCE(label, 'none') AS label FROM firsts LEFT JOIN sets ON k = dedup_key LEFT JOIN labels USING (c)
              ), totals AS (
                SELECT label, min(dedup_key) AS group_key, COUNT(*) AS group_texts, CAST(SUM(n_reviews) AS BIGINT) AS group_reviews FROM placed GROUP BY 1
              ) SELECT dedup_key, group_key, group_texts, group_reviews FROM placed JOIN totals USING (label))"""
        ),
        "duplicate_text_top": on_records(
            """SELECT raw_text, COUNT(*) AS reviews FROM records WHERE raw_text <> '' GROUP BY 1
            ORDER BY reviews DESC, raw_text LIMIT 30"""
        ),
        "duplicate_text_stats": on_records(
            f"""SELECT CAST(SUM(n) AS BIGINT) AS reviews, CAST(SUM(n) FILTER (WHERE raw_text <> '') AS BIGINT) AS with_text,
            CAST(SUM(n) FILTER (WHERE raw_text = '') AS BIGINT) AS without_text, {count_if("raw_text <> ''")} AS unique_texts,
            {count_if("raw_text <> '' AND n > 1")} AS repeated_texts
            FROM (SELECT raw_text, COUNT(*) AS n FROM records GROUP BY 1)"""
        ),
        "text_length_profile": with_ctes(RECORDS, "sizes AS (SELECT length(raw_text) AS length FROM records)")
        + describe("sizes", ["length"], [0.25, 0.5, 0.75]),
        "rule_issues": on_texts(exploded("texts", "dedup_key, needs_manual_review", "issues IS NOT NULL")),
        "route": on_texts("SELECT dedup_key, route, reason, n_reviews FROM texts"),
        "route_counts": on_texts(
            "SELECT route, COUNT(*) AS texts, CAST(SUM(n_reviews) AS BIGINT) AS reviews FROM texts GROUP BY 1"
        ),
        "token_estimate": on_texts("SELECT dedup_key, tok AS tokens FROM texts"),
        "token_batches": on_calls("SELECT * FROM batches"),
        "budget_gate": on_calls("SELECT * FROM plan"),
        "route_sample": _sample(),
        "offline_results": on_texts(
            exploded(
                f"""(SELECT dedup_key, CASE WHEN route = 'rule' THEN 'rule' ELSE 'offline_' || route || '_fallback' END AS method,
                route <> 'rule' OR needs_manual_review AS needs_manual_review,
                CASE WHEN route = 'rule' THEN issues ELSE [{issue("general", "unclear", EXCERPT, 0.5)}] END AS issues FROM texts)""",
                "dedup_key, method, needs_manual_review",
            )
        ),
        "response_validation": on_calls(
            "SELECT dedup_key, tier, status, CAST(len(issues) AS INT) AS issues, needs_manual_review FROM judged", JUDGED
        ),
        "escalation": on_calls("SELECT outcome, status, COUNT(*) AS texts FROM outcomes GROUP BY 1, 2", *full),
        "merged_results": on_calls(exploded("results", "dedup_key, method, model, needs_manual_review"), *full),
        "expanded_reviews": on_calls(
            f"SELECT {review_columns}, CAST(issue_no AS INT) AS issue_no, {ISSUE_COLUMNS.format(adapted)} FROM expanded",
            *full,
        ),
        "issue_counts": on_calls(
            "SELECT i.category AS category, i.subcategory AS subcategory, COUNT(*) AS issues FROM expanded GROUP BY 1, 2", *full
        ),
        "method_counts": on_calls(
            "SELECT method, COUNT(*) AS records FROM records JOIN results ON text_hash = dedup_key GROUP BY 1", *full
        ),
        "accuracy_sample": on_calls(
            """SELECT review_id, method, rank, CAST((rank - 1) // 10 + 1 AS INT) AS batch FROM (
              SELECT review_id, method, CAST(row_number() OVER (PARTITION BY method ORDER BY sha1(review_id || raw_text), review_id) AS INT) AS rank
              FROM records JOIN results ON text_hash = dedup_key
              WHERE method IN ('rule', 'small_llm', 'large_llm') AND raw_text <> '') WHERE rank <= 30""",
            *full,
        ),
        "extraction_metadata": on_calls(_metadata(), *full),
        "accuracy_metrics": _metrics(),
        "cache_misses": on_texts(
            """SELECT review_id, text_hash FROM records WHERE review_id NOT IN
            (SELECT review_id FROM texts WHERE route = 'rule')"""
        ),
    }
