"""DuckDB building blocks: common table expressions over the test tables."""

from __future__ import annotations

import re

from causeway.rules import DEFAULT_PACKS as PACKS
from causeway.rules.stop_words import ENGLISH
from causeway.sources import fixture


def q(value: str) -> str:
    """A SQL text literal."""
    return "'" + value.replace("'", "''") + "'"


def texts(values) -> str:
    return "[" + ", ".join(q(v) for v in values) + "]"


def values(rows) -> str:
    """A VALUES list of text and number rows."""
    def cell(v):
        return q(v) if isinstance(v, str) else str(v)
    return "(VALUES " + ", ".join("(" + ", ".join(cell(v) for v in r) + ")" for r in rows) + ")"


LABELS = PACKS.labels


def _message() -> str:
    out = ["CASE WHEN e % 103 = 0 THEN NULL WHEN e % 101 = 0 THEN ''"]
    for k, variants in enumerate(fixture.TEMPLATES):
        for v, template in enumerate(variants):
            parts = [f"CAST({p[1]} AS VARCHAR)" if re.fullmatch(r"\{[une]\}", p) else q(p)
                     for p in re.split(r"(\{[une]\})", template) if p]
            out.append(f"WHEN k = {k} AND v = {v} THEN {' || '.join(parts)}")
    return " ".join(out) + " END"


LOGS = f"""ev AS (
  SELECT event_id AS e, user_id AS u, CAST(floor(value) AS BIGINT) AS n, event_id % 8 AS k,
         (event_id // 8) % 3 AS v, ts, event_type FROM events),
logs AS (
  SELECT 'LOG-' || lpad(CAST(e AS VARCHAR), 8, '0') AS log_id,
         CASE WHEN e % 97 = 0 THEN 'not-a-date' ELSE strftime(ts, '%Y-%m-%dT%H:%M:%SZ') END AS "timestamp",
         CASE u % 12 {' '.join(f"WHEN {i} THEN {q(s)}" for i, s in enumerate(fixture.SERVICES))} END AS service,
         CASE event_type {' '.join(f"WHEN {q(a)} THEN {q(b)}" for a, b in fixture.SEVERITIES.items())}
           ELSE {q(fixture.SEVERITY_OTHER)} END AS severity,
         {_message()} AS log_message,
         'RC-0' || CAST(CASE WHEN e % 13 = 0 THEN (k + 2) % 8 + 1 ELSE k + 1 END AS VARCHAR) AS root_cause_label
  FROM ev)"""

VALID = LOGS + """,
valid AS (SELECT * FROM logs WHERE log_message IS NOT NULL AND log_message <> '')"""


def share(label: str, column: str = "lm") -> str:
    phrases = PACKS.categories[label].phrases
    hits = " + ".join(f"CAST(contains({column}, {q(p.lower())}) AS INTEGER)" for p in phrases)
    return f"CAST({hits} AS DOUBLE) / CAST({len(phrases)} AS DOUBLE)"


PREDS = VALID + f""",
shares AS (
  SELECT *, {', '.join(f"{share(k)} AS s{i}" for i, k in enumerate(LABELS))}
  FROM (SELECT *, lower(log_message) AS lm FROM valid)),
sums AS (SELECT *, {' + '.join(f's{i}' for i in range(len(LABELS)))} AS total FROM shares),
probs AS (
  SELECT *, [{', '.join(f"CASE WHEN total = 0 THEN CAST(1 AS DOUBLE) / CAST({len(LABELS)} AS DOUBLE) ELSE s{i} / total END" for i in range(len(LABELS)))}] AS probability
  FROM sums),
preds AS (
  SELECT log_id, "timestamp", service, severity, log_message, root_cause_label AS label,
         ({texts(LABELS)})[list_position(probability, list_max(probability))] AS prediction,
         probability, list_max(probability) AS confidence
  FROM probs)"""

CM = PREDS + """,
names AS (SELECT label AS name FROM preds UNION SELECT prediction FROM preds),
cm AS (
  SELECT a.name AS label, b.name AS prediction, count(p.label) AS n
  FROM names a CROSS JOIN names b LEFT JOIN preds p ON p.label = a.name AND p.prediction = b.name
  GROUP BY a.name, b.name)"""

PER_CLASS = CM + """,
per_class AS (
  SELECT name AS label,
         CASE WHEN pred = 0 THEN 0.0 ELSE CAST(hit AS DOUBLE) / pred END AS "precision",
         CASE WHEN sup = 0 THEN 0.0 ELSE CAST(hit AS DOUBLE) / sup END AS recall,
         CASE WHEN pred + sup = 0 THEN 0.0 ELSE CAST(2 * hit AS DOUBLE) / (pred + sup) END AS f1,
         CAST(sup AS BIGINT) AS support
  FROM (SELECT name, (SELECT count(*) FROM preds WHERE label = name AND prediction = name) AS hit,
               (SELECT count(*) FROM preds WHERE label = name) AS sup,
               (SELECT count(*) FROM preds WHERE prediction = name) AS pred FROM names))"""

OVERALL = PER_CLASS + """,
overall AS (
  SELECT 'accuracy' AS metric, avg(CAST(label = prediction AS DOUBLE)) AS value FROM preds
  UNION ALL SELECT 'macro_precision', avg("precision") FROM per_class
  UNION ALL SELECT 'macro_recall', avg(recall) FROM per_class
  UNION ALL SELECT 'macro_f1', avg(f1) FROM per_class
  UNION ALL SELECT 'weighted_precision', sum("precision" * support) / sum(support) FROM per_class
  UNION ALL SELECT 'weighted_recall', sum(recall * support) / sum(support) FROM per_class
  UNION ALL SELECT 'weighted_f1', sum(f1 * support) / sum(support) FROM per_class)"""

NORMALIZED = CM + """,
shares_of AS (
  SELECT c.label, c.prediction, c.n,
         CASE WHEN t.total = 0 THEN 0.0 ELSE CAST(c.n AS DOUBLE) / CAST(t.total AS DOUBLE) END AS share
  FROM cm c JOIN (SELECT label, CAST(sum(n) AS BIGINT) AS total FROM cm GROUP BY label) t ON t.label = c.label)"""

RATES = NORMALIZED + """,
rates AS (
  SELECT label, CAST(sum(n) AS BIGINT) AS n, CAST(sum(CASE WHEN label <> prediction THEN n ELSE 0 END) AS BIGINT) AS n_wrong,
         CASE WHEN sum(n) = 0 THEN 0.0
              ELSE CAST(sum(CASE WHEN label <> prediction THEN n ELSE 0 END) AS DOUBLE) / CAST(sum(n) AS DOUBLE) END AS error_rate
  FROM cm GROUP BY label),
top AS (
  SELECT row_number() OVER (ORDER BY n DESC, label, prediction) AS rank, label, prediction, n, share
  FROM shares_of WHERE label <> prediction AND n > 0 QUALIFY rank <= 20),
pairs AS (
  SELECT rank, label || ' → ' || prediction AS pair, n, share,
         label || ' frequently misclassified as ' || prediction AS description, label, prediction
  FROM top WHERE rank <= 10 AND share > CAST(0.1 AS DOUBLE))"""

# Score points per class: rows of the class and other rows for each distinct score.
POINTS = PREDS + f""",
class_points AS (
  SELECT c.class, p.label AS truth, p.probability[c.i] AS score, count(*) AS n
  FROM preds p CROSS JOIN (SELECT unnest({texts(LABELS)}) AS class, unnest(range(1, {len(LABELS) + 1})) AS i) c
  GROUP BY ALL)"""

AUC_OVR = POINTS + """,
auc_ovr AS (
  SELECT p.class, sum(p.n * q.n * CASE WHEN p.score > q.score THEN 1.0::DOUBLE WHEN p.score = q.score THEN 0.5 ELSE 0 END)
         / CAST(sum(p.n * q.n) AS DOUBLE) AS auc
  FROM class_points p JOIN class_points q ON q.class = p.class
  WHERE p.truth = p.class AND q.truth <> q.class GROUP BY p.class)"""

AUC_OVO = AUC_OVR + """,
auc_sides AS (
  SELECT p.class, q.truth AS rival,
         sum(p.n * q.n * CASE WHEN p.score > q.score THEN 1.0::DOUBLE WHEN p.score = q.score THEN 0.5 ELSE 0 END)
         / CAST(sum(p.n * q.n) AS DOUBLE) AS auc
  FROM class_points p JOIN class_points q ON q.class = p.class
  WHERE p.truth = p.class AND q.truth <> q.class GROUP BY p.class, q.truth),
auc_ovo AS (
  SELECT least(class, rival) AS class_a, greatest(class, rival) AS class_b, avg(auc) AS auc
  FROM auc_sides GROUP BY ALL)"""

AP = AUC_OVO + """,
thresholds AS (
  SELECT class, score, CAST(sum(CASE WHEN truth = class THEN n ELSE 0 END) AS DOUBLE) AS pos,
         CAST(sum(n) AS DOUBLE) AS everything FROM class_points GROUP BY class, score),
ap AS (
  SELECT t.class, sum(t.pos * (SELECT sum(b.pos) / sum(b.everything) FROM thresholds b
                               WHERE b.class = t.class AND b.score >= t.score)) / sum(t.pos) AS average_precision
  FROM thresholds t GROUP BY t.class)"""


# --- rule scans --------------------------------------------------------------

def contains_case(patterns, column: str, matcher: str) -> str:
    return " + ".join(f"CAST(coalesce({matcher.format(column=column, pattern=q(p))}, false) AS INTEGER)" for p in patterns)


MATCH_I = "regexp_matches({column}, {pattern}, 'i')"


def tally(name: str, rows: list[tuple[str, str]], source: str = "logs", label: str = "root_cause_label") -> str:
    """CTE ``name``(label, ord, name, n, total): summed expressions per label."""
    cells = " UNION ALL ".join(
        f"SELECT label, {i} AS ord, {q(n)} AS name, CAST(t{i} AS BIGINT) AS n, total FROM {name}_wide" for i, (n, _) in enumerate(rows))
    sums = ", ".join(f"sum({e}) AS t{i}" for i, (_, e) in enumerate(rows))
    return f"""{name}_wide AS (
  SELECT {label} AS label, count(*) AS total, {sums}
  FROM (SELECT *, lower(log_message) AS lm FROM {source}) WHERE {label} IN ({', '.join(q(k) for k in LABELS)}) GROUP BY 1),
{name} AS ({cells})"""


SHAPES = LOGS + ", " + tally("shape_tally", [(d, contains_case([p], "log_message", MATCH_I)) for p, d in PACKS.message_shapes]) + """,
shapes AS (SELECT label, ord, name AS shape, n, total FROM shape_tally WHERE n > total * CAST(0.3 AS DOUBLE))"""

TYPES = LOGS + ", " + tally("type_tally", [(k, contains_case(ps, "log_message", MATCH_I)) for k, ps in PACKS.mined_error_types.items()]) + """,
types AS (SELECT label, ord, name AS error_type, n, total FROM type_tally WHERE n > 0 AND n >= total * CAST(0.3 AS DOUBLE))"""

_PHRASES = tally("phrase_tally", [(t, contains_case([t], "lm", "contains({column}, {pattern})")) for t in PACKS.technical_terms]) + """,
phrases AS (SELECT label, name AS phrase, n, total FROM phrase_tally WHERE n >= greatest(1.0::DOUBLE, total * CAST(0.2 AS DOUBLE)))"""
PHRASES = LOGS + ", " + _PHRASES

DIST = """dist AS (
  SELECT root_cause_label AS label, 'service' AS kind, service AS value, count(*) AS n FROM logs GROUP BY ALL
  UNION ALL SELECT root_cause_label, 'severity', severity, count(*) FROM logs GROUP BY ALL)"""

DESCRIBED = DIST + f""",
defs AS (SELECT * FROM {values([(k, c.name, c.text) for k, c in sorted(PACKS.categories.items())])} t(label, name, text)),
best AS (SELECT label, kind, value FROM dist QUALIFY row_number() OVER (PARTITION BY label, kind ORDER BY n DESC, value) = 1),
described AS (
  SELECT d.label, d.name || '. ' || d.text || ' This category contains ' || CAST(t.total AS VARCHAR)
         || ' log entries across ' || CAST(t.services AS VARCHAR) || ' different services. Most commonly affects the '
         || a.value || ' service with ' || b.value || ' severity levels.' AS description
  FROM defs d
  JOIN (SELECT root_cause_label AS label, count(*) AS total, count(DISTINCT service) AS services FROM logs GROUP BY 1) t ON t.label = d.label
  JOIN best a ON a.label = d.label AND a.kind = 'service'
  JOIN best b ON b.label = d.label AND b.kind = 'severity')"""

EXAMPLES = """examples AS (
  SELECT root_cause_label AS label, row_number() OVER (PARTITION BY root_cause_label ORDER BY log_id) AS rank, log_id, log_message
  FROM logs QUALIFY rank <= 3)"""

SIMILARITY = PHRASES + """,
present AS (SELECT DISTINCT root_cause_label AS label FROM logs),
similarity AS (
  SELECT a.label AS label_a, b.label AS label_b,
         round(CASE WHEN both_n + a_n + b_n = 0 THEN 0.0 ELSE CAST(both_n AS DOUBLE) / (a_n + b_n - both_n) END, 3) AS similarity
  FROM present a CROSS JOIN present b
  CROSS JOIN LATERAL (SELECT (SELECT count(*) FROM phrases WHERE label = a.label) AS a_n,
                             (SELECT count(*) FROM phrases WHERE label = b.label) AS b_n,
                             (SELECT count(*) FROM phrases x JOIN phrases y ON x.phrase = y.phrase
                              WHERE x.label = a.label AND y.label = b.label) AS both_n))"""

OVERLAP = """overlap AS (
  SELECT x.label || '-' || y.label AS pair, string_agg(x.phrase, ', ' ORDER BY x.phrase) AS phrases
  FROM phrases x JOIN phrases y ON x.phrase = y.phrase AND x.label < y.label GROUP BY 1),
distinctive AS (
  SELECT label, string_agg(phrase, ', ' ORDER BY phrase) AS phrases FROM phrases
  WHERE phrase IN (SELECT phrase FROM phrases GROUP BY phrase HAVING count(DISTINCT label) = 1) GROUP BY label)"""

PROFILE = ", ".join([SHAPES, TYPES[len(LOGS) + 2:], _PHRASES, DESCRIBED, EXAMPLES, OVERLAP]) + """,
profile AS (
  SELECT d.label,
    coalesce((SELECT string_agg(shape, '|' ORDER BY ord) FROM shapes s WHERE s.label = d.label), '') AS common_patterns,
    coalesce((SELECT string_agg(phrase, '|' ORDER BY n DESC, phrase) FROM phrases s WHERE s.label = d.label), '') AS key_phrases,
    coalesce((SELECT string_agg(error_type, '|' ORDER BY n DESC, ord) FROM types s WHERE s.label = d.label), '') AS error_types,
    description AS category_description,
    (SELECT string_agg(log_message, '|' ORDER BY rank) FROM examples s WHERE s.label = d.label) AS example_logs,
    (SELECT string_agg(value || '=' || CAST(n AS VARCHAR), '|' ORDER BY value) FROM dist s WHERE s.label = d.label AND kind = 'service') AS service_distribution,
    (SELECT string_agg(value || '=' || CAST(n AS VARCHAR), '|' ORDER BY value) FROM dist s WHERE s.label = d.label AND kind = 'severity') AS severity_distribution
  FROM described d)"""

# Importance table for the analysis operators: how much of a label's messages a phrase is in.
IMPORTANCE = PHRASES + """,
importance AS (SELECT label, phrase AS feature, CAST(n AS DOUBLE) / total AS importance FROM phrases),
top_features AS (
  SELECT label, row_number() OVER (PARTITION BY label ORDER BY importance DESC, feature) AS rank, feature, importance
  FROM importance QUALIFY rank <= 5),
common AS (
  SELECT feature, count(*) AS n_classes FROM top_features WHERE rank <= 3 GROUP BY feature HAVING count(*) >= 3),
global_importance AS (
  SELECT feature, importance / (SELECT sum(importance) FROM (SELECT sum(n) AS importance FROM phrases GROUP BY phrase)) AS importance
  FROM (SELECT phrase AS feature, CAST(sum(n) AS DOUBLE) AS importance FROM phrases GROUP BY phrase))"""

# --- text --------------------------------------------------------------------


def error_class(column: str) -> str:
    whens = " ".join(f"WHEN regexp_matches(lower(coalesce({column}, '')), {q(p)}) THEN {q(n)}" for p, n in PACKS.error_classes)
    return f"CASE {whens} ELSE {q(PACKS.error_class_default)} END"


def tags(service: str, column: str) -> str:
    whens = " ".join(
        f"WHEN {q(s)} THEN list_filter([{', '.join(f'''CASE WHEN contains(lower(coalesce({column}, '')), {q(k)}) THEN {q(s + '_' + k)} END''' for k in ks)}], lambda x: x IS NOT NULL)"
        for s, ks in PACKS.service_keywords.items())
    return f"CASE {service} {whens} ELSE CAST([] AS VARCHAR[]) END"


def normalized(column: str) -> str:
    return f"trim(regexp_replace(lower(coalesce({column}, '')), '[^a-z]+', ' ', 'g'))"


def combined(service: str, column: str) -> str:
    return f"{normalized(column)} || ' ' || array_to_string({tags(service, column)}, ' ') || ' ' || {error_class(column)}"


def tokens(column: str) -> str:
    return f"regexp_extract_all(lower(coalesce({column}, '')), '[\\p{{L}}\\p{{N}}_]{{2,}}')"


def kept_tokens(column: str) -> str:
    return f"list_filter({tokens(column)}, lambda t: NOT list_contains({texts(ENGLISH)}, t))"


def ngrams(column: str) -> str:
    return (f"list_concat({column}, list_transform(range(1, greatest(len({column}), 1)), "
            f"lambda i: {column}[i] || ' ' || {column}[i + 1]))")


def vocabulary(source: str, key: str, column: str, k: int, min_df: str = "1", max_df: str = "n_docs") -> str:
    """CTEs doc_terms(key, term), vocab(term, total_count, doc_count, idx) and tfidf(key, term, weight)."""
    return f"""doc_tokens AS (SELECT {key}, {kept_tokens(column)} AS toks FROM {source}),
doc_terms AS (SELECT {key}, unnest({ngrams('toks')}) AS term FROM doc_tokens),
docs AS (SELECT count(*) AS n_docs FROM {source}),
term_stats AS (SELECT term, count(*) AS total_count, count(DISTINCT {key}) AS doc_count FROM doc_terms GROUP BY term),
vocab AS (
  SELECT *, row_number() OVER (ORDER BY encode(term)) - 1 AS idx FROM (
    SELECT term, total_count, doc_count FROM term_stats, docs WHERE doc_count >= {min_df} AND doc_count <= {max_df}
    ORDER BY total_count DESC, encode(term) LIMIT {k})),
weighted AS (
  SELECT d.{key}, d.term, count(*) * (ln((1 + n_docs) / CAST(1 + v.doc_count AS DOUBLE)) + 1) AS w
  FROM doc_terms d JOIN vocab v ON v.term = d.term CROSS JOIN docs GROUP BY d.{key}, d.term, v.doc_count, n_docs),
tfidf AS (
  SELECT {key}, term, w / sqrt(sum(w * w) OVER (PARTITION BY {key})) AS weight FROM weighted)"""


# --- evidence ----------------------------------------------------------------

def label_matches(label: str, column: str) -> str:
    whens = " ".join(
        f"WHEN {q(k)} THEN flatten([{', '.join(f'''regexp_extract_all({column}, {q('(?i)' + p)})''' for p in ps)}])"
        for k, ps in PACKS.label_evidence.items())
    return f"CASE {label} {whens} ELSE CAST([] AS VARCHAR[]) END"


def general_matches(column: str) -> str:
    parts = [f"list_transform(regexp_extract_all({column}, {q(p)}, {re.compile(p).groups}), lambda m: {q(k + ': ')} || m)"
             for k, p in PACKS.general_evidence]
    return f"flatten([{', '.join(parts)}])"


EVIDENCE = PREDS + f""",
found AS (
  SELECT *, list_concat({label_matches('prediction', 'log_message')}, {general_matches('log_message')}) AS hits FROM preds),
proofs AS (
  SELECT *, CASE WHEN len(hits) = 0 THEN ['Log excerpt: ' || substr(log_message, 1, 50) || '...']
                 ELSE list_filter(hits, lambda x, i: list_position(hits, x) = i)[1:5] END AS evidence FROM found)"""

INCIDENTS = "incidents AS (SELECT * FROM " + values(
    [(k, i.title, i.sentence, i.severity, i.impact, i.time_to_resolution, "|".join(i.actions)) for k, i in PACKS.incidents.items()]
) + " t(label, title, sentence, severity, impact, ttr, actions))"

SUMMARY = EVIDENCE + ", " + INCIDENTS + """,
summaries AS (
  SELECT p.log_id, p.prediction AS root_cause, p.confidence,
    replace(i.sentence, '{evidence}', 'Evidence includes: ' || array_to_string(p.evidence[1:3], '; '))
      || ' Context: Service: ' || p.service || ', Severity: ' || p.severity || ', '
      || CASE WHEN p."timestamp" = 'not-a-date' THEN 'Timestamp: not-a-date'
              ELSE 'Time: ' || replace(replace(p."timestamp", 'T', ' '), 'Z', '') || ' UTC' END || '.' AS summary,
    array_to_string(p.evidence, '|') AS key_evidence, i.actions AS recommended_actions,
    CASE WHEN p.confidence < 0.5 THEN i.severity || ' (Low confidence prediction)' ELSE i.severity END AS severity,
    i.impact, i.ttr AS time_to_resolution
  FROM proofs p JOIN incidents i ON i.label = p.prediction)"""


def split(source: str, test: str, seed: int = 42) -> str:
    """CTE split_rows: the rows of ``source`` with a flag is_test."""
    return f"""class_n AS (SELECT root_cause_label, count(*) AS n FROM {source} GROUP BY 1),
wanted AS (SELECT ceil(sum(n) * CAST({test} AS DOUBLE)) AS whole, CAST(sum(n) AS DOUBLE) AS total FROM class_n),
shares_q AS (SELECT root_cause_label, n * whole / total AS exact, floor(n * whole / total) AS low, whole FROM class_n, wanted),
quotas AS (
  SELECT root_cause_label, low + CASE WHEN row_number() OVER (ORDER BY exact - low DESC, root_cause_label)
                                        <= whole - (SELECT sum(low) FROM shares_q) THEN 1 ELSE 0 END AS quota FROM shares_q),
split_rows AS (
  SELECT l.*, row_number() OVER (PARTITION BY l.root_cause_label ORDER BY md5(log_id || '|{seed}'), log_id) <= quota AS is_test
  FROM {source} l JOIN quotas q ON q.root_cause_label = l.root_cause_label)"""
