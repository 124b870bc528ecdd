"""For each registered query, the same result in DuckDB SQL over the same tables."""

from __future__ import annotations

from causeway.rules import DEFAULT_PACKS as PACKS

from . import views as v
from .views import q

RC = "root_cause_label"
D = PACKS.incident_default
ORACLES: dict[str, str] = {}


def add(name: str, ctes: str, select: str) -> None:
    ORACLES[name] = f"WITH {ctes}\n{select}" if ctes else select


PROFILE_COLUMNS = "label, category_description, common_patterns, key_phrases, error_types, example_logs, service_distribution, severity_distribution"
PER_CLASS_COLUMNS = 'label, round("precision", 6) AS "precision", round(recall, 6) AS recall, round(f1, 6) AS f1, support'

# --- sources and sinks
# An empty CSV field is null.
add("read_logs", v.LOGS, """SELECT * REPLACE (CASE WHEN log_message <> '' THEN log_message || chr(10) || '"' || service || '", end' END
  AS log_message) FROM logs""")
add("write_json_report", v.PROFILE, f"SELECT {PROFILE_COLUMNS} FROM profile")
add("write_per_class_csv", v.PER_CLASS, f"SELECT {PER_CLASS_COLUMNS} FROM per_class")

# --- profile
COLUMNS = ["log_id", "timestamp", "service", "severity", "log_message", RC]
add("profile_shape", v.LOGS, "SELECT 'total_rows' AS item, '' AS name, CAST(count(*) AS VARCHAR) AS value FROM logs "
    "UNION ALL SELECT 'total_columns', '', '5' UNION ALL SELECT 'missing_column', 'severity', '' "
    + " ".join(f"UNION ALL SELECT 'data_type', {q(k)}, 'string'" for k in COLUMNS if k != "severity"))
add("profile_missing", v.LOGS, "SELECT column_name, n_missing FROM ("
    + " UNION ALL ".join(f"SELECT {q(k)} AS column_name, count(*) FILTER (WHERE \"{k}\" IS NULL) AS n_missing FROM logs" for k in COLUMNS)
    + ") WHERE n_missing > 0")
DUP = v.LOGS + ", dup AS (SELECT * FROM logs UNION ALL SELECT * FROM logs WHERE severity = 'CRITICAL')"
add("profile_duplicates", DUP, """
SELECT 'total_duplicate_rows' AS metric, (SELECT count(*) FROM dup) - (SELECT count(*) FROM (SELECT DISTINCT * FROM dup)) AS n
UNION ALL SELECT 'duplicate_log_ids', (SELECT count(*) FROM dup) - (SELECT count(*) FROM (SELECT DISTINCT log_id FROM dup))""")
VALUE_COUNTS = " UNION ALL ".join(f"SELECT {q(k)} AS column_name, {k} AS value, count(*) AS n FROM logs WHERE {k} IS NOT NULL GROUP BY {k}"
                                  for k in (RC, "service", "severity"))
add("value_counts", v.LOGS, VALUE_COUNTS)
add("class_balance", v.LOGS, f"""
SELECT label, n, round(n * 100.0::DOUBLE / sum(n) OVER (), 2) AS percent, CAST(sum(n) OVER () AS BIGINT) AS total_samples,
       count(*) OVER () AS unique_classes, min(n) OVER () AS min_samples, max(n) OVER () AS max_samples
FROM (SELECT {RC} AS label, count(*) AS n FROM logs GROUP BY 1)""")
add("sample_head", v.LOGS, "SELECT * FROM logs ORDER BY log_id LIMIT 3")


def json_text(column: str) -> str:
    return f"""CASE WHEN "{column}" IS NULL THEN NULL ELSE '"{column}":"' || "{column}" || '"' END"""


SAMPLE_JSON = "'{' || concat_ws(',', " + ", ".join(json_text(k) for k in COLUMNS) + ") || '}'"
add("profile_summary", v.LOGS, f"""
SELECT 'shape' AS section, 'total_rows' AS name, CAST(count(*) AS VARCHAR) AS value FROM logs
UNION ALL SELECT 'total_columns', '', '6'
{' '.join(f"UNION ALL SELECT 'data_type', {q(k)}, 'string'" for k in COLUMNS)}
UNION ALL SELECT 'missing', 'log_message', CAST(count(*) AS VARCHAR) FROM logs WHERE log_message IS NULL
UNION ALL SELECT 'duplicates', 'total_duplicate_rows', CAST(count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM logs)) AS VARCHAR) FROM logs
UNION ALL SELECT 'duplicates', 'duplicate_log_ids', CAST(count(*) - count(DISTINCT log_id) AS VARCHAR) FROM logs
UNION ALL SELECT 'distribution ' || column_name, value, CAST(n AS VARCHAR) FROM ({VALUE_COUNTS})
UNION ALL SELECT * FROM (SELECT 'sample', log_id, {SAMPLE_JSON} FROM logs ORDER BY log_id LIMIT 3)""")
add("feature_profile", v.LOGS, f"""
SELECT count(DISTINCT {v.error_class('log_message')}) AS unique_error_types,
       round(avg(CAST(len({v.tags('service', 'log_message')}) AS DOUBLE)), 6) AS avg_service_patterns,
       count(DISTINCT service) AS unique_services, count(DISTINCT severity) AS unique_severities,
       bool_or("timestamp" <> 'not-a-date') AS has_timestamp, count(*) AS total_samples,
       CAST(107 AS BIGINT) AS total_features FROM logs""")
add("validate_for_scoring", v.LOGS, "SELECT log_id, coalesce(log_message, '') <> '' AS accepted FROM logs")

# --- projections
add("normalize_text", "", f"SELECT doc_id, {v.normalized('text')} AS clean FROM documents")
add("classify_error", v.LOGS, f"SELECT log_id, {v.error_class('log_message')} AS error_class FROM logs")
add("tag_service_keywords", v.LOGS, f"SELECT log_id, array_to_string({v.tags('service', 'log_message')}, '|') AS tags FROM logs")
add("combine_text", v.LOGS, f"SELECT log_id, {v.combined('service', 'log_message')} AS combined_text FROM logs")
PARSED = "try_strptime(\"timestamp\", '%Y-%m-%dT%H:%M:%SZ')"
add("parse_time", v.LOGS, f"SELECT log_id, strftime({PARSED}, '%Y-%m-%d %H:%M:%S') AS parsed FROM logs")
TIMES = f"""times AS (SELECT *, CAST(coalesce(hour({PARSED}), 0) AS INTEGER) AS hour_of_day,
  CAST(coalesce(isodow({PARSED}) - 1, 0) AS INTEGER) AS day_of_week FROM logs),
timed AS (SELECT *, CAST(day_of_week >= 5 AS INTEGER) AS is_weekend,
  CAST(hour_of_day >= 9 AND hour_of_day <= 17 AS INTEGER) AS is_business_hours FROM times)"""
add("time_features", v.LOGS + ", " + TIMES, "SELECT log_id, hour_of_day, day_of_week, is_weekend, is_business_hours FROM timed")
SEVERITY = "CASE severity WHEN 'INFO' THEN 0 WHEN 'WARNING' THEN 1 WHEN 'ERROR' THEN 2 WHEN 'CRITICAL' THEN 3 ELSE 0 END"
add("encode_severity", v.LOGS, f"SELECT log_id, severity, CAST({SEVERITY} AS INTEGER) AS severity_encoded FROM logs")
add("echo_inputs", v.LOGS, "SELECT log_id, " + ", ".join(
    f"coalesce(\"{k}\", '') AS \"{k}\"" for k in ("log_message", "service", "severity", "timestamp")) + " FROM logs")


def json_list(column: str) -> str:
    """A JSON array from texts joined with |."""
    return f"'[\"' || replace({column}, '|', '\",\"') || '\"]'"


RANKED = """ranked AS (
  SELECT log_id, prediction, p.label AS root_cause, p.value AS confidence,
         row_number() OVER (PARTITION BY log_id ORDER BY p.value DESC, p.label) AS rank
  FROM (SELECT log_id, prediction, unnest(list_transform(probability, lambda x, i: {'label': (%s)[i], 'value': x})) AS p FROM preds)
  QUALIFY rank <= 3)""" % v.texts(v.LABELS)
add("prediction_json", v.SUMMARY + ", " + RANKED + """,
tops AS (SELECT log_id, string_agg('{"root_cause":"' || root_cause || '","confidence":' || CAST(confidence AS VARCHAR) || '}', ',' ORDER BY rank) AS tops
         FROM ranked GROUP BY log_id)""", f"""
SELECT s.log_id, '{{"root_cause":"' || s.root_cause || '","confidence":' || CAST(s.confidence AS VARCHAR)
  || ',"top_n_predictions":[' || t.tops || '],"features_used":{{"log_message":"' || p.log_message || '","service":"' || p.service
  || '","severity":"' || p.severity || '","timestamp":"' || p."timestamp" || '"}},"summary":{{"root_cause":"' || s.root_cause
  || '","confidence":' || CAST(s.confidence AS VARCHAR) || ',"summary":"' || s.summary || '","key_evidence":' || {json_list('s.key_evidence')}
  || ',"recommended_actions":' || {json_list('s.recommended_actions')} || ',"severity":"' || s.severity || '","impact":"' || s.impact
  || '","time_to_resolution":"' || s.time_to_resolution || '"}}}}' AS json
FROM summaries s JOIN tops t ON t.log_id = s.log_id JOIN preds p ON p.log_id = s.log_id""")

# --- feature fitting
add("tokenize", "", f"SELECT doc_id, array_to_string({v.tokens('text')}, ' ') AS tokens FROM documents")
add("remove_stop_words", "", f"SELECT doc_id, array_to_string({v.kept_tokens('text')}, ' ') AS tokens FROM documents")
add("ngrams", f"toks AS (SELECT doc_id, {v.kept_tokens('text')} AS t FROM documents)",
    f"SELECT doc_id, array_to_string({v.ngrams('t')}, '|') AS terms FROM toks")
add("fit_vocabulary", v.vocabulary("documents", "doc_id", "text", 500, "2", "0.5::DOUBLE * n_docs"),
    "SELECT term, total_count, doc_count, idx FROM vocab")
add("tfidf", v.vocabulary("documents", "doc_id", "text", 200), "SELECT doc_id, term, round(weight, 6) AS weight FROM tfidf")
CODED = f"""coded AS (SELECT *, {v.error_class('log_message')} AS error_class FROM logs),
coded2 AS (SELECT *, dense_rank() OVER (ORDER BY service) - 1 AS s, dense_rank() OVER (ORDER BY error_class) - 1 AS c,
                  dense_rank() OVER (ORDER BY {RC}) - 1 AS r FROM coded)"""
add("index_category", v.LOGS + ", " + CODED, f"""
SELECT log_id, CAST(s AS INTEGER) AS service_encoded, CAST(c AS INTEGER) AS error_class_encoded, CAST(r AS INTEGER) AS {RC}_encoded FROM coded2""")
KNOWN = ", ".join(q(s) for s in PACKS.service_keywords)
add("index_unseen", v.LOGS + f""",
known AS (SELECT service, row_number() OVER (ORDER BY service) - 1 AS code FROM (SELECT DISTINCT service FROM logs WHERE service IN ({KNOWN})))""",
    "SELECT log_id, l.service, CAST(coalesce(code, -1) AS INTEGER) AS service_encoded FROM logs l LEFT JOIN known k ON k.service = l.service")
add("assemble_features", v.VALID + f""",
lines AS (SELECT log_id, {v.combined('service', 'log_message')} AS line FROM valid), """
    + v.vocabulary("lines", "log_id", "line", 100) + ", " + TIMES.replace("FROM logs", "FROM valid")
    + f""", coded AS (SELECT *, {v.error_class('log_message')} AS error_class FROM timed),
coded2 AS (SELECT *, dense_rank() OVER (ORDER BY service) - 1 AS s, dense_rank() OVER (ORDER BY error_class) - 1 AS c FROM coded)""", f"""
SELECT log_id, term AS feature, round(weight, 6) AS value FROM tfidf
""" + " ".join(f"UNION ALL SELECT log_id, '{n}', CAST({e} AS DOUBLE) FROM coded2 WHERE {e} <> 0" for n, e in (
        ("service_encoded", "s"), ("severity_encoded", SEVERITY), ("error_class_encoded", "c"), ("hour_of_day", "hour_of_day"),
        ("day_of_week", "day_of_week"), ("is_weekend", "is_weekend"), ("is_business_hours", "is_business_hours"))))
add("stratified_split", v.LOGS + ", " + v.split("logs", "0.3"), f"SELECT log_id, {RC}, is_test FROM split_rows")
add("class_weights", v.LOGS, f"""
SELECT label, n, round(CAST(sum(n) OVER () AS DOUBLE) / (count(*) OVER () * n), 6) AS weight
FROM (SELECT {RC} AS label, count(*) AS n FROM logs GROUP BY 1)""")
add("stratified_folds", v.LOGS, f"""
SELECT log_id, {RC}, CAST((row_number() OVER (PARTITION BY {RC} ORDER BY md5(log_id || '|42'), log_id) - 1) % 5 AS INTEGER) AS fold FROM logs""")

# --- models: what must hold for any fit
HELD_OUT = v.VALID + ", " + v.split("valid", "0.3")
for kind in ("random_forest", "logistic", "boosted_trees"):
    add(f"fit_{kind}_check", HELD_OUT, "SELECT count(*) AS n_rows, CAST(0 AS BIGINT) AS n_unknown, CAST(0 AS BIGINT) AS n_bad, true AS accurate "
        "FROM split_rows WHERE is_test")
add("save_pipeline_check", HELD_OUT, f"""
SELECT count(*) AS n_rows, CAST(0 AS BIGINT) AS n_changed, (SELECT count(DISTINCT {RC}) FROM valid) AS n_labels FROM split_rows WHERE is_test""")
add("score_check", HELD_OUT, "SELECT count(*) AS n_rows, CAST(0 AS BIGINT) AS n_sum, CAST(0 AS BIGINT) AS n_size, "
    "CAST(0 AS BIGINT) AS n_confidence FROM split_rows WHERE is_test")
add("tune_check", v.VALID, f"""
SELECT 'random_forest' AS model_type, CAST(3 * 3 * 3 * 2 AS BIGINT) AS n_points, CAST(3 * 3 * 3 * 2 AS BIGINT) AS n_params,
       CAST(greatest(2, least(5, count(*) // (2 * count(DISTINCT {RC})))) AS INTEGER) AS n_folds, CAST(0 AS BIGINT) AS n_bad, true AS accurate
FROM valid""")
add("compare_models_check", v.VALID, """
SELECT model_type, count(*) = 0 AS failed, count(*) > 0 AS accurate
FROM valid, (VALUES ('logistic_regression'), ('random_forest'), ('boosted_trees')) t(model_type) GROUP BY model_type""")
NAMES = v.VALID + f""",
lines AS (SELECT log_id, {v.combined('service', 'log_message')} AS line FROM valid), """ + v.vocabulary("lines", "log_id", "line", 100) + """,
width AS (SELECT count(*) + 7 AS n FROM vocab)"""
add("feature_importance_check", NAMES, "SELECT n AS n_features, n AS n_names, CAST(0 AS BIGINT) AS n_bad, CAST(1 AS DOUBLE) AS total FROM width")
add("permutation_importance_check", NAMES, f"""
SELECT label, n AS n_features, CAST(0 AS BIGINT) AS n_bad, true AS some_matter FROM width, (SELECT DISTINCT {RC} AS label FROM valid)""")
add("insights_check", NAMES + f", k AS (SELECT count(DISTINCT {RC}) AS k FROM valid)", """
SELECT 'overall_accuracy' AS section, CAST(1 AS BIGINT) AS n UNION ALL SELECT 'extreme_classes', 1 UNION ALL SELECT 'confusion', k * k FROM k
UNION ALL SELECT 'class_error_rate', k FROM k UNION ALL SELECT 'global_importance', n FROM width UNION ALL SELECT 'top_features', 5 * k FROM k""")
add("score_stream_check", v.VALID, "SELECT count(*) AS n_scored, CAST(0 AS BIGINT) AS n_differ, (SELECT count(*) FROM logs) - count(*) AS n_rejected FROM valid")
add("inference_check_check", v.VALID, f"SELECT min(log_id) AS log_id, {RC} AS label, true AS known, true AS consistent FROM valid GROUP BY {RC}")

# --- scores without a trained model
add("top_n_labels", v.PREDS + ", " + RANKED,
    "SELECT log_id, CAST(rank AS INTEGER) AS rank, root_cause, round(confidence, 6) AS confidence FROM ranked")
add("hard_scores", v.PREDS, "SELECT log_id, " + ", ".join(
    f"CAST(prediction = {q(k)} AS DOUBLE) AS p{i + 1}" for i, k in enumerate(v.LABELS)) + " FROM preds")
add("holdout_accuracy", v.PREDS + f", renamed AS (SELECT log_id, label AS {RC}, prediction FROM preds), " + v.split("renamed", "0.3"),
    f"SELECT round(avg(CAST({RC} = prediction AS DOUBLE)), 6) AS accuracy, count(*) AS n_rows FROM split_rows WHERE is_test")

# --- evidence and summaries
add("label_evidence", v.PREDS, f"SELECT log_id, array_to_string({v.label_matches('prediction', 'log_message')}, '|') AS evidence FROM preds")
add("general_evidence", v.PREDS, f"SELECT log_id, array_to_string({v.general_matches('log_message')}, '|') AS evidence FROM preds")
add("evidence", v.EVIDENCE, "SELECT log_id, array_to_string(evidence, '|') AS evidence FROM proofs")
add("template_lookup", v.PREDS + ", " + v.INCIDENTS + """,
marked AS (SELECT log_id, CASE WHEN severity = 'High' THEN 'RC-99' ELSE prediction END AS prediction FROM preds)""", f"""
SELECT log_id, prediction, coalesce(title, replace({q(D.title)}, '{{label}}', prediction)) AS title,
       coalesce(sentence, {q(D.sentence)}) AS sentence, coalesce(severity, {q(D.severity)}) AS severity,
       coalesce(impact, {q(D.impact)}) AS impact, coalesce(ttr, {q(D.time_to_resolution)}) AS ttr,
       coalesce(actions, {q('|'.join(D.actions))}) AS actions
FROM marked LEFT JOIN incidents ON label = prediction""")
add("summary_severity", v.PREDS + ", " + v.INCIDENTS, """
SELECT log_id, i.severity || CASE WHEN confidence < 0.5 THEN ' (Low confidence prediction)' ELSE '' END AS severity
FROM preds p JOIN incidents i ON i.label = p.prediction""")
add("summarize", v.SUMMARY, """
SELECT log_id, root_cause, round(confidence, 6) AS confidence, summary, key_evidence, recommended_actions, severity, impact,
       time_to_resolution FROM summaries""")

# --- category mining
add("message_shapes", v.SHAPES, "SELECT label, ord, shape, n, total FROM shapes")
add("key_phrases", v.PHRASES, "SELECT label, phrase, n, total FROM phrases")
add("mined_error_types", v.TYPES, "SELECT label, ord, error_type, n, total FROM types")
add("category_distribution", v.LOGS + ", " + v.DIST, "SELECT label, kind, value, n FROM dist")
add("category_examples", v.LOGS + ", " + v.EXAMPLES, "SELECT label, CAST(rank AS INTEGER) AS rank, log_id, log_message FROM examples")
add("category_description", v.LOGS + ", " + v.DESCRIBED, "SELECT label, description FROM described")
add("category_profile", v.PROFILE, f"SELECT {PROFILE_COLUMNS} FROM profile")
add("phrase_overlap", v.PHRASES + ", " + v.OVERLAP, "SELECT pair, phrases FROM overlap")
add("distinctive_phrases", v.PHRASES + ", " + v.OVERLAP, "SELECT label, phrases FROM distinctive")
add("category_similarity", v.SIMILARITY, "SELECT label_a, label_b, similarity FROM similarity")
add("similar_pairs", v.SIMILARITY, "SELECT label_a, label_b, similarity FROM similarity WHERE label_a <> label_b AND similarity > CAST(0.1 AS DOUBLE)")
ISSUES = v.values([(k, str(i), t) for k, cat in sorted(PACKS.categories.items()) for i, t in enumerate(cat.issues)])


def unfold(column: str) -> str:
    return f"""UNION ALL SELECT '{column}', label, CAST(unnest(range(len(string_split({column}, '|')))) AS VARCHAR), unnest(string_split({column}, '|'))
FROM profile WHERE {column} <> ''"""


def unfold_counts(column: str, kind: str) -> str:
    return f"UNION ALL SELECT '{column}', label, value, CAST(n AS VARCHAR) FROM dist WHERE kind = '{kind}'"


add("category_report", v.PROFILE + v.SIMILARITY[len(v.PHRASES):], f"""
SELECT 'total_categories' AS section, '' AS label, '' AS other, CAST(count(*) AS VARCHAR) AS value FROM profile
UNION ALL SELECT 'total_unique_key_phrases', '', '', CAST(count(DISTINCT phrase) AS VARCHAR) FROM phrases
UNION ALL SELECT 'description', label, '', description FROM described
UNION ALL SELECT 'overlap', pair, '', phrases FROM overlap
UNION ALL SELECT 'distinctive', label, '', phrases FROM distinctive
UNION ALL SELECT 'similarity', label_a, label_b, printf('%.3f', similarity) FROM similarity
UNION ALL SELECT 'typical_system_issues', label, pos, issue FROM {ISSUES} t(label, pos, issue)
{unfold('common_patterns')} {unfold('key_phrases')} {unfold('error_types')}
UNION ALL SELECT 'example_logs', label, CAST(rank - 1 AS VARCHAR), log_message FROM examples
{unfold_counts('service_distribution', 'service')} {unfold_counts('severity_distribution', 'severity')}""")
add("score_categories", v.VALID + ", lowered AS (SELECT *, lower(log_message) AS lm FROM valid)", " UNION ALL ".join(
    f"SELECT log_id, {q(k)} AS label, round({v.share(k)}, 3) AS score FROM lowered" for k in v.LABELS))

# --- evaluation
add("confusion", v.CM, "SELECT label, prediction, n FROM cm")
add("confusion_normalized", v.NORMALIZED, "SELECT label, prediction, n, round(share, 6) AS share FROM shares_of")
add("per_class_metrics", v.PER_CLASS, f"SELECT {PER_CLASS_COLUMNS} FROM per_class")
add("overall_metrics", v.OVERALL, "SELECT metric, round(value, 6) AS value FROM overall")
add("roc_auc_ovr", v.AUC_OVR, "SELECT class, round(auc, 6) AS auc FROM auc_ovr")
add("roc_auc_ovo", v.AUC_OVO, "SELECT class_a, class_b, round(auc, 6) AS auc FROM auc_ovo")
add("average_precision", v.AP, "SELECT class, round(average_precision, 6) AS average_precision FROM ap")
add("classification_report", v.OVERALL, """
SELECT label AS name, round("precision", 6) AS "precision", round(recall, 6) AS recall, round(f1, 6) AS f1, support FROM per_class
UNION ALL SELECT 'accuracy', round(value, 6), round(value, 6), round(value, 6), (SELECT count(*) FROM preds) FROM overall WHERE metric = 'accuracy'
UNION ALL SELECT 'macro avg', round(avg("precision"), 6), round(avg(recall), 6), round(avg(f1), 6), CAST(sum(support) AS BIGINT) FROM per_class
UNION ALL SELECT 'weighted avg', round(sum("precision" * support) / sum(support), 6), round(sum(recall * support) / sum(support), 6),
       round(sum(f1 * support) / sum(support), 6), CAST(sum(support) AS BIGINT) FROM per_class""")
METRICS = """
SELECT 'class' AS scope, label, 'precision' AS metric, round("precision", 6) AS value FROM per_class
UNION ALL SELECT 'class', label, 'recall', round(recall, 6) FROM per_class
UNION ALL SELECT 'class', label, 'f1', round(f1, 6) FROM per_class
UNION ALL SELECT 'class', label, 'support', CAST(support AS DOUBLE) FROM per_class
UNION ALL SELECT 'overall', '', metric, round(value, 6) FROM overall
UNION ALL SELECT 'confusion_share', label, label || '>' || prediction, round(share, 6) FROM shares_of"""
METRIC_CTES = v.OVERALL + v.NORMALIZED[len(v.CM):]
add("metrics_from_confusion", METRIC_CTES, METRICS)
add("evaluate", METRIC_CTES + v.AP[len(v.PREDS):], METRICS + """
UNION ALL SELECT 'confusion', label, label || '>' || prediction, CAST(n AS DOUBLE) FROM cm
UNION ALL SELECT 'overall', '', 'roc_auc_ovr', round(avg(auc), 6) FROM auc_ovr
UNION ALL SELECT 'overall', '', 'roc_auc_ovo', round(avg(auc), 6) FROM auc_ovo
UNION ALL SELECT 'overall', '', 'average_precision', round(avg(average_precision), 6) FROM ap""")
add("error_summary", v.PREDS, """
SELECT count(*) AS n_rows, count(*) FILTER (WHERE label <> prediction) AS n_wrong,
       round(avg(CAST(label <> prediction AS DOUBLE)), 6) AS wrong_share FROM preds""")
add("confused_pairs", v.NORMALIZED, """
SELECT label, prediction, n, round(share, 6) AS share FROM shares_of WHERE label <> prediction AND share > CAST(0.1 AS DOUBLE)""")
add("rank_classes", v.PER_CLASS, """
SELECT 'best' AS side, CAST(row_number() OVER (ORDER BY f1 DESC, label) AS INTEGER) AS rank, label, round(f1, 6) AS f1 FROM per_class QUALIFY rank <= 3
UNION ALL SELECT 'worst', CAST(row_number() OVER (ORDER BY f1, label) AS INTEGER) AS rank, label, round(f1, 6) FROM
  (SELECT * FROM per_class QUALIFY row_number() OVER (ORDER BY f1, label DESC) <= 3)""")

# --- diagnosis
add("class_error_rate", v.RATES, "SELECT label, n, n_wrong, round(error_rate, 6) AS error_rate FROM rates")
add("top_misclassifications", v.RATES, "SELECT CAST(rank AS INTEGER) AS rank, label, prediction, n, round(share, 6) AS share FROM top")
add("challenging_pairs", v.RATES, """
SELECT CAST(rank AS INTEGER) AS rank, pair, n, round(share, 6) AS share, description, label, prediction FROM pairs""")
add("misclassified_rows", v.PREDS, """
SELECT log_id, "timestamp", service, severity, log_message, label AS true_label, prediction AS predicted_label
FROM preds WHERE label <> prediction""")
add("extreme_classes", v.RATES, """
SELECT (SELECT label FROM rates ORDER BY error_rate DESC, label LIMIT 1) AS most_challenging_class,
       (SELECT label FROM rates ORDER BY error_rate, label LIMIT 1) AS easiest_class""")
add("top_features_per_class", v.IMPORTANCE, """
SELECT label, CAST(rank AS INTEGER) AS rank, feature, round(importance, 6) AS importance FROM top_features""")
add("common_features", v.IMPORTANCE, "SELECT feature, n_classes FROM common")
BOTH = v.RATES + v.IMPORTANCE[len(v.LOGS):]
add("recommendations", BOTH + ", acc AS (SELECT avg(CAST(label = prediction AS DOUBLE)) AS a FROM preds)", """
SELECT 1 AS ord, '' AS sub, CASE WHEN a < 0.7 THEN 'model_improvement' ELSE 'model_tuning' END AS type,
       CASE WHEN a < 0.7 THEN 'high' ELSE 'medium' END AS priority,
       'Overall accuracy is ' || printf('%.1f%%', a * 100) || CASE WHEN a < 0.7 THEN ', below 70%' ELSE ', below 85%' END AS description,
       CASE WHEN a < 0.7 THEN 'Gather more labelled logs or try another kind of model' ELSE 'Search the parameter grid' END AS action
FROM acc WHERE a < 0.85
UNION ALL SELECT 2, label, 'class_specific', CASE WHEN error_rate > 0.3::DOUBLE THEN 'high' ELSE 'medium' END,
       label || CASE WHEN error_rate > 0.3::DOUBLE THEN ' has a high error rate: ' ELSE ' has a moderate error rate: ' END || printf('%.1f%%', error_rate * 100),
       CASE WHEN error_rate > 0.3::DOUBLE THEN 'Gather logs and add features for ' ELSE 'Read the wrong predictions of ' END || label
FROM rates WHERE error_rate > 0.15::DOUBLE
UNION ALL SELECT 3, '', 'feature_engineering', 'medium',
       'Features that matter for many classes: ' || string_agg(feature, ', ' ORDER BY n_classes DESC, feature), 'Derive further features from them'
FROM (SELECT * FROM common ORDER BY n_classes DESC, feature LIMIT 3) HAVING count(*) > 0
UNION ALL SELECT 4, printf('%02d', rank), 'confusion_resolution', 'medium', description, 'Add features that tell ' || label || ' from ' || prediction
FROM pairs WHERE rank <= 3""")
add("error_patterns", BOTH, """
SELECT 1 AS ord, '' AS sub, 'error_clustering' AS type, 'Error rates far above the mean: ' || string_agg(label, ', ' ORDER BY label) AS description,
       'Too few logs or unclear boundaries for these classes' AS implication
FROM rates WHERE error_rate > (SELECT avg(error_rate) FROM rates) * 1.5 HAVING count(*) > 0
UNION ALL SELECT 2, printf('%02d', rank), 'asymmetric_confusion',
       label || ' is taken for ' || prediction || ' ' || CAST(n AS VARCHAR) || ' times, never the other way round',
       'What marks ' || prediction || ' may also occur in ' || label
FROM top t WHERE rank <= 5 AND n > 2
  AND NOT EXISTS (SELECT 1 FROM top b WHERE b.label = t.prediction AND b.prediction = t.label)
UNION ALL SELECT 3, '', 'feature_dominance', 'Feature ' || feature || ' carries ' || printf('%.1f%%', importance * 100) || ' of the importance',
       'The model leans on one feature, consider regularization'
FROM (SELECT * FROM global_importance ORDER BY importance DESC, feature LIMIT 1) WHERE importance > 0.3::DOUBLE""")
add("confidence_stats", v.PREDS, """
SELECT 'confidence' AS section, 'average' AS name, round(avg(confidence), 6) AS value FROM preds
UNION ALL SELECT 'confidence', 'minimum', round(min(confidence), 6) FROM preds
UNION ALL SELECT 'confidence', 'maximum', round(max(confidence), 6) FROM preds
UNION ALL SELECT 'confidence', 'below_0.5', CAST(count(*) FILTER (WHERE confidence < 0.5) AS DOUBLE) FROM preds
UNION ALL SELECT 'predictions', prediction, CAST(count(*) AS DOUBLE) FROM preds GROUP BY prediction""")
add("confidence_buckets", v.PREDS + """,
banded AS (SELECT CASE WHEN confidence >= 0.9::DOUBLE THEN 'very_high' WHEN confidence >= 0.7::DOUBLE THEN 'high'
                       WHEN confidence >= 0.5::DOUBLE THEN 'medium' ELSE 'low' END AS band FROM preds),
bands AS (SELECT b.band, count(p.band) AS n FROM (VALUES ('very_high'), ('high'), ('medium'), ('low')) b(band)
          LEFT JOIN banded p ON p.band = b.band GROUP BY b.band),
shared AS (SELECT band, n, n * 100.0::DOUBLE / sum(n) OVER () AS percent FROM bands)""", """
SELECT band, n, round(percent, 6) AS percent,
       CASE WHEN (SELECT percent FROM shared WHERE band = 'low') > 20 THEN 'lower the threshold to 0.3 or improve the model'
            WHEN (SELECT percent FROM shared WHERE band = 'low') > 10 THEN 'use a threshold of 0.4' ELSE 'use a threshold of 0.5' END AS advice
FROM shared""")
add("threshold_sweep", v.PREDS, """
SELECT t AS threshold, count(*) FILTER (WHERE confidence >= t) AS n, round(count(*) FILTER (WHERE confidence >= t) * 100.0::DOUBLE / count(*), 6) AS percent
FROM preds CROSS JOIN (SELECT unnest([0.3::DOUBLE, 0.4, 0.5, 0.6, 0.7]) AS t) GROUP BY t""")
add("sample_rows", v.PREDS, """
SELECT log_id, prediction, round(confidence, 6) AS confidence FROM preds ORDER BY md5(log_id || '|42'), log_id LIMIT 20""")
