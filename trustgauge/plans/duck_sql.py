"""The same results in plain SQL, one statement per query, for a second engine to check.

Each statement is put together from named steps; a step that several later ones read is
materialized. Floats are rounded as in the queries, because sums may run in another order.
"""

from __future__ import annotations

from trustgauge.functions import rules

# Written out here once more, so that a wrong value on either side shows.
URL_PATTERN = r"https?://[^\s\x0B\x1c-\x1f\x85\p{Z}]+|www\.[^\s\x0B\x1c-\x1f\x85\p{Z}]+"
USER_PATTERN = r"@[\p{L}\p{N}_]+"
TOKEN_PATTERN = r"[a-z0-9_#@']+"
ALPHAS = (0.05, 0.10, 0.15, 0.20, 0.25)
THRESHOLDS = (0.50, 0.55, 0.60, 0.65, 0.70, 0.75, 0.80, 0.85, 0.90, 0.95)


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _tokens(text: str) -> str:
    marked = f"regexp_replace(lower({text}), {_quoted(URL_PATTERN)}, ' urltoken ', 'g')"
    marked = f"regexp_replace({marked}, {_quoted(USER_PATTERN)}, ' usertoken ', 'g')"
    return f"regexp_extract_all({marked}, {_quoted(TOKEN_PATTERN)})"


def _composed(text: str, keyword: str) -> str:
    clean = f"trim(replace(coalesce({keyword}, ''), '%20', ' '))"
    return f"coalesce({text}, '') || '  keyword: ' || {clean}"


_KEYWORD = r"lower(trim(regexp_extract(text, '(?i)\bkeyword:\s*([^\n]*)$', 1)))"

_BIGRAMS = "list_transform(range(1, len(tok)), lambda i: tok[i] || ' ' || tok[i + 1])"

_DOCS = f"""
docs AS MATERIALIZED (
  SELECT doc_id AS id, {_composed('text', 'source')} AS text FROM documents)"""

_DOC_TERMS = f"""{_DOCS},
doc_tokens AS MATERIALIZED (SELECT id, {_tokens('text')} AS tok FROM docs),
doc_terms AS MATERIALIZED (
  SELECT id, term, count(*) AS c
  FROM (SELECT id, unnest(list_concat(tok, {_BIGRAMS})) AS term FROM doc_tokens)
  GROUP BY ALL)"""


def _vocabulary(name: str, terms: str, docs: str, limit: int | str = 15000) -> str:
    return f"""
{name} AS MATERIALIZED (
  SELECT term, (row_number() OVER (ORDER BY tf DESC, term) - 1)::INTEGER AS idx, tf, df,
         ln((1.0::DOUBLE + n) / (1.0::DOUBLE + df)) + 1.0::DOUBLE AS idf
  FROM (SELECT term, sum(c)::BIGINT AS tf, count(*) AS df FROM {terms} GROUP BY term),
       (SELECT count(*) AS n FROM {docs})
  WHERE df >= 2
  ORDER BY idx LIMIT {limit})"""


def _tfidf(name: str, terms: str, vocabulary: str) -> str:
    return f"""
{name} AS MATERIALIZED (
  SELECT id, idx, w / sqrt(sum(w * w) OVER (PARTITION BY id)) AS w
  FROM (SELECT t.id, v.idx, (1.0::DOUBLE + ln(t.c::DOUBLE)) * v.idf AS w
        FROM {terms} t JOIN {vocabulary} v USING (term)))"""


def _split(source: str, name: str) -> str:
    return f"""
{name} AS MATERIALIZED (
  SELECT * EXCLUDE (rn, n),
         CASE WHEN rn <= round_even(n * 0.6::DOUBLE, 0) THEN 'train'
              WHEN rn <= round_even(n * 0.6::DOUBLE, 0) + round_even(n * 0.2::DOUBLE, 0)
              THEN 'calibration' ELSE 'test' END AS split
  FROM (SELECT *, row_number() OVER (PARTITION BY target ORDER BY md5('42:' || id), id) AS rn,
               count(*) OVER (PARTITION BY target) AS n FROM {source}))"""


_LABELLED = f"""
labelled AS MATERIALIZED (
  SELECT d.doc_id AS id, l.quality AS target, {_composed('d.text', 'd.source')} AS text
  FROM documents d JOIN labels l USING (doc_id)),{_split('labelled', 'split_docs')}"""

_TRAIN_FEATURES = f"""{_LABELLED},
lab_tokens AS MATERIALIZED (
  SELECT id, target, split, {_tokens('text')} AS tok FROM split_docs),
lab_terms AS MATERIALIZED (
  SELECT id, term, count(*) AS c
  FROM (SELECT id, unnest(list_concat(tok, {_BIGRAMS})) AS term FROM lab_tokens)
  GROUP BY ALL),
train_docs AS MATERIALIZED (SELECT id, target FROM split_docs WHERE split = 'train'),
train_terms AS MATERIALIZED (SELECT t.* FROM lab_terms t SEMI JOIN train_docs USING (id)),
{_vocabulary('vocab', 'train_terms', 'train_docs')},
{_tfidf('feats', 'lab_terms', 'vocab')}"""

_MEMBERS = """
ranked AS MATERIALIZED (
  SELECT id, row_number() OVER (ORDER BY md5('142:' || id), id) - 1 AS rank FROM train_docs),
size AS (SELECT count(*) AS n FROM train_docs),
times AS MATERIALIZED (
  SELECT member, id, count(*) AS times
  FROM (SELECT slot // n AS member, ('0x' || substr(md5('142:' || slot), 1, 15))::BIGINT % n AS rank
        FROM size, range((SELECT 5 * n FROM size)) g(slot)) JOIN ranked USING (rank)
  GROUP BY ALL),
known AS MATERIALIZED (
  SELECT term, (row_number() OVER (PARTITION BY member ORDER BY tf DESC, term) - 1)::INTEGER AS idx,
         tf, df, ln((1.0::DOUBLE + n) / (1.0::DOUBLE + df)) + 1.0::DOUBLE AS idf, member::INTEGER AS member
  FROM (SELECT member, term, sum(c * times)::BIGINT AS tf, sum(times)::BIGINT AS df
        FROM train_terms JOIN times USING (id) GROUP BY ALL), size
  WHERE df >= 2
  QUALIFY idx < 15000)"""

_NB = f"""{_TRAIN_FEATURES},
nb_sums AS MATERIALIZED (
  SELECT v.idx, coalesce(sum(w) FILTER (target = 1), 0.0::DOUBLE) AS s1,
         coalesce(sum(w) FILTER (target = 0), 0.0::DOUBLE) AS s0
  FROM vocab v LEFT JOIN (SELECT f.*, t.target FROM feats f JOIN train_docs t USING (id)) x
    USING (idx) GROUP BY v.idx),
nb AS MATERIALIZED (
  SELECT idx, ln((s1 + 1) / (t1 + f)) - ln((s0 + 1) / (t0 + f)) AS weight
  FROM nb_sums, (SELECT sum(s1) AS t1, sum(s0) AS t0, count(*) AS f FROM nb_sums)),
nb_prior AS MATERIALIZED (
  SELECT ln(count(*) FILTER (target = 1) + 1.0::DOUBLE)
       - ln(count(*) FILTER (target = 0) + 1.0::DOUBLE) AS prior FROM train_docs)"""

_SIGMOID = (
    "CASE WHEN {x} >= 0 THEN 1.0::DOUBLE / (1.0::DOUBLE + exp(-abs({x}))) "
    "ELSE exp(-abs({x})) / (1.0::DOUBLE + exp(-abs({x}))) END"
)


def _sigmoid(x: str) -> str:
    return _SIGMOID.format(x=x)


def _clip(p: str) -> str:
    return f"least(greatest({p}, 1e-12::DOUBLE), 1.0::DOUBLE - 1e-12::DOUBLE)"


def _loss(y: str, p: str) -> str:
    return f"-ln(CASE WHEN {y} = 1 THEN {_clip(p)} ELSE 1.0::DOUBLE - {_clip(p)} END)"


_NB_PREDICTIONS = f"""{_NB},
preds AS MATERIALIZED (
  SELECT *, {_sigmoid('score')} AS prob FROM (
    SELECT 'naive_bayes_tfidf/raw' AS model, 'naive_bayes_tfidf' AS base_model, 'raw' AS method,
           d.split, d.id, d.target,
           (SELECT prior FROM nb_prior) + coalesce(s.total, 0.0::DOUBLE) AS score
    FROM split_docs d LEFT JOIN (
      SELECT id, sum(f.w * nb.weight) AS total FROM feats f JOIN nb USING (idx) GROUP BY id) s
      USING (id)
    WHERE d.split <> 'train'))"""

_EVENTS = """
ev AS MATERIALIZED (
  SELECT 'm' || (user_id % 4) || '/raw' AS model, 'm' || (user_id % 4) AS base_model,
         'raw' AS method, event_id AS id,
         (event_type IN ('error', 'purchase'))::INTEGER AS target,
         ln((value + 1.0::DOUBLE) / 51.0::DOUBLE) AS score,
         (value + 1.0::DOUBLE) / (value + 52.0::DOUBLE) AS prob
  FROM events)"""

_EVENT_SPLITS = f"""{_EVENTS},{_split('ev', 'preds')}"""

_DOC_PREDICTIONS = f"""{_DOCS},
doc_preds AS MATERIALIZED (
  SELECT base_model || '/raw' AS model, base_model, 'raw' AS method, id, target,
         ln((n_chars::DOUBLE + 1) / 1500.0::DOUBLE) AS score,
         (n_chars::DOUBLE + 1) / (n_chars::DOUBLE + 1501) AS prob
  FROM (SELECT doc_id AS id, n_chars, 'length_quality' AS base_model, quality AS target
        FROM documents JOIN labels USING (doc_id)
        UNION ALL
        SELECT doc_id, n_chars, 'length_toxic', toxic
        FROM documents JOIN labels USING (doc_id)))"""

_TEMPERATURES = f"""
grid AS MATERIALIZED (
  SELECT i::INTEGER AS step, pow(10.0::DOUBLE, -1.2::DOUBLE + i * 0.02::DOUBLE) AS temperature
  FROM range(121) g(i)),
losses AS MATERIALIZED (
  SELECT model, step, temperature, avg({_loss('target', '(' + _sigmoid('(score / temperature)') + ')')}) AS loss
  FROM (SELECT * FROM preds WHERE split = 'calibration'), grid GROUP BY ALL),
temps AS MATERIALIZED (
  SELECT model, temperature FROM losses
  QUALIFY row_number() OVER (PARTITION BY model ORDER BY loss, step) = 1)"""


def _blocks(source: str) -> str:
    """Isotonic blocks: a point ends a block when every run behind it has a higher mean than
    any run up to it."""
    return f"""
points AS MATERIALIZED (
  SELECT model, prob AS x, count(*) AS w, sum(target) AS s,
         row_number() OVER (PARTITION BY model ORDER BY prob) AS i
  FROM {source} GROUP BY model, prob),
sums AS MATERIALIZED (
  SELECT model, x, i, sum(w) OVER o AS cw, sum(s) OVER o AS cs FROM points
  WINDOW o AS (PARTITION BY model ORDER BY i)),
starts AS MATERIALIZED (
  SELECT model, i, cw, cs FROM sums UNION ALL SELECT DISTINCT model, 0, 0, 0 FROM sums),
up AS MATERIALIZED (
  SELECT b.model, b.i, max((b.cs - a.cs)::DOUBLE / (b.cw - a.cw)::DOUBLE) AS top
  FROM sums b JOIN starts a ON a.model = b.model AND a.i < b.i GROUP BY ALL),
down AS MATERIALIZED (
  SELECT a.model, a.i, min((b.cs - a.cs)::DOUBLE / (b.cw - a.cw)::DOUBLE) AS low
  FROM sums b JOIN sums a ON a.model = b.model AND a.i < b.i GROUP BY ALL),
ends AS MATERIALIZED (
  SELECT s.model, s.x, s.i, s.cw, s.cs
  FROM sums s JOIN up USING (model, i) LEFT JOIN down USING (model, i)
  WHERE down.low IS NULL OR up.top < down.low),
blocks AS MATERIALIZED (
  SELECT model, lag(x) OVER o AS lo, x AS hi, lead(x) OVER o IS NULL AS last,
         (cs - coalesce(lag(cs) OVER o, 0))::DOUBLE / (cw - coalesce(lag(cw) OVER o, 0))::DOUBLE
           AS value
  FROM ends WINDOW o AS (PARTITION BY model ORDER BY i))"""


_EVENT_CALIBRATION = f"""{_EVENT_SPLITS},{_TEMPERATURES},
cal AS MATERIALIZED (SELECT * FROM preds WHERE split = 'calibration'),
test AS MATERIALIZED (SELECT * FROM preds WHERE split = 'test'),{_blocks('cal')}"""

_ISOTONIC_TEST = f"""
isotonic_test AS MATERIALIZED (
  SELECT t.*, {_clip('b.value')} AS isotonic_prob
  FROM test t JOIN blocks b ON t.model = b.model
   AND (b.lo IS NULL OR t.prob > b.lo) AND (b.last OR t.prob <= b.hi))"""

_FAMILY = f"""{_EVENT_CALIBRATION},{_ISOTONIC_TEST},
family AS MATERIALIZED (
  SELECT model, base_model, method, split, id, target, score, prob FROM test
  UNION ALL
  SELECT base_model || '/temperature_scaling', base_model, 'temperature_scaling', split, id,
         target, score, {_clip('(' + _sigmoid('(score / temperature)') + ')')}
  FROM test JOIN temps USING (model)
  UNION ALL
  SELECT base_model || '/isotonic_regression', base_model, 'isotonic_regression', split, id,
         target, score, isotonic_prob FROM isotonic_test)"""

_QUANTILES = f"""
alphas(alpha) AS (VALUES {', '.join(f'({a}::DOUBLE)' for a in ALPHAS)}),
ranked AS MATERIALIZED (
  SELECT model, s, row_number() OVER (PARTITION BY model ORDER BY s) AS r,
         count(*) OVER (PARTITION BY model) AS n
  FROM (SELECT model, 1.0::DOUBLE - CASE WHEN target = 1 THEN prob ELSE 1.0::DOUBLE - prob END
        AS s FROM preds WHERE split = 'calibration')),
quantiles AS MATERIALIZED (
  SELECT model, alpha, n, s AS qhat FROM ranked, alphas
  WHERE r = least(greatest(ceil((n + 1)::DOUBLE * (1.0::DOUBLE - alpha))::BIGINT, 1), n)),
sets AS MATERIALIZED (
  SELECT *, include_0::INTEGER + include_1::INTEGER AS set_size,
         CASE WHEN target = 1 THEN include_1 ELSE include_0 END AS contains_true
  FROM (SELECT p.model, p.id, p.target, p.prob, q.alpha, q.qhat,
               1.0::DOUBLE - (1.0::DOUBLE - prob) <= qhat AS include_0,
               1.0::DOUBLE - prob <= qhat AS include_1
        FROM preds p JOIN quantiles q USING (model) WHERE p.split = 'test')),
conformal AS MATERIALIZED (
  SELECT model, alpha, 1.0::DOUBLE - alpha AS target_coverage, qhat,
         avg(contains_true::INTEGER) AS empirical_coverage, avg(set_size) AS avg_set_size,
         avg((set_size = 1)::INTEGER) AS singleton_rate,
         avg((set_size = 2)::INTEGER) AS ambiguous_rate,
         avg((set_size = 0)::INTEGER) AS empty_rate,
         CASE WHEN count(*) FILTER (set_size = 1) > 0 THEN
           (count(*) FILTER (set_size = 1 AND (prob >= 0.5)::INTEGER = target))::DOUBLE
           / (count(*) FILTER (set_size = 1))::DOUBLE END AS singleton_accuracy
  FROM sets GROUP BY model, alpha, qhat)"""

_CONFORMAL = f"{_EVENT_SPLITS},{_QUANTILES}"


def _network(docs: str) -> str:
    """Forward pass over documents: hidden units, scores; weights follow from their place."""
    return f"""
net_tokens AS MATERIALIZED (SELECT id, {_tokens('text')} AS tok FROM {docs}),
net_counts AS MATERIALIZED (
  SELECT id, term, count(*) AS c FROM (SELECT id, unnest(tok) AS term FROM net_tokens) GROUP BY ALL),
{_vocabulary('vocab', 'net_counts', docs, 10000)},
known AS MATERIALIZED (
  SELECT id, idx, c, sum(c) OVER (PARTITION BY id) AS n FROM net_counts JOIN vocab USING (term)),
x AS MATERIALIZED (
  SELECT d.id, k, coalesce(sum(c * ((idx * 7 + k * 13) % 101 - 50) / 101.0::DOUBLE) / max(n), 0.0::DOUBLE) AS x
  FROM {docs} d CROSS JOIN range(6) g(k) LEFT JOIN known USING (id) GROUP BY ALL),
h AS MATERIALIZED (
  SELECT id, j, sum(x * ((k * 31 + j * 17) % 41 - 20) / 41.0::DOUBLE) + ((j * 5) % 23 - 11) / 23.0::DOUBLE AS h
  FROM x, range(5) u(j) GROUP BY id, j),
net AS MATERIALIZED (
  SELECT id, 0.125::DOUBLE + sum(greatest(h, 0.0::DOUBLE) * ((j * 11 + 3) % 19 - 9) / 19.0::DOUBLE) AS score
  FROM h GROUP BY id)"""


def _metrics(source: str) -> str:
    """metrics, bins, eces and curve steps over a predictions step."""
    taus = ", ".join(f"({t}::DOUBLE)" for t in THRESHOLDS)
    safe = _clip("prob")
    return f"""
evaluated AS MATERIALIZED (
  SELECT *, (prob >= 0.5)::INTEGER AS label, greatest(prob, 1.0::DOUBLE - prob) AS conf
  FROM {source}),
counts AS MATERIALIZED (
  SELECT model, avg((label = target)::INTEGER) AS accuracy,
         avg({_loss('target', 'prob')}) AS log_loss,
         avg(({safe} - target) * ({safe} - target)) AS brier_score,
         count(*) FILTER (label = 0 AND target = 0) AS tn,
         count(*) FILTER (label = 1 AND target = 0) AS fp,
         count(*) FILTER (label = 0 AND target = 1) AS fn,
         count(*) FILTER (label = 1 AND target = 1) AS tp
  FROM evaluated GROUP BY model),
rates AS MATERIALIZED (
  SELECT *, CASE WHEN tp + fp > 0 THEN tp::DOUBLE / (tp + fp)::DOUBLE ELSE 0.0::DOUBLE END
           AS precision,
         CASE WHEN tp + fn > 0 THEN tp::DOUBLE / (tp + fn)::DOUBLE ELSE 0.0::DOUBLE END AS recall
  FROM counts),
metrics AS MATERIALIZED (
  SELECT *, CASE WHEN precision + recall > 0
                 THEN 2.0::DOUBLE * precision * recall / (precision + recall)
                 ELSE 0.0::DOUBLE END AS f1 FROM rates),
edges AS MATERIALIZED (
  SELECT i + 1 AS bin, i * 0.1::DOUBLE AS left_edge,
         CASE WHEN i = 9 THEN 1.0::DOUBLE ELSE (i + 1) * 0.1::DOUBLE END AS right_edge
  FROM range(10) g(i)),
bins AS MATERIALIZED (
  SELECT m.model, e.bin::INTEGER AS bin, left_edge, right_edge, count(v.conf) AS n,
         coalesce(avg(v.conf), (left_edge + right_edge) / 2) AS mean_confidence,
         avg((v.label = v.target)::INTEGER) AS accuracy
  FROM (SELECT DISTINCT model FROM evaluated) m CROSS JOIN edges e
  LEFT JOIN evaluated v ON v.model = m.model AND v.conf >= e.left_edge
   AND (v.conf < e.right_edge OR e.bin = 10)
  GROUP BY m.model, e.bin, left_edge, right_edge),
eces AS MATERIALIZED (
  SELECT model, sum(coalesce(abs(accuracy - mean_confidence), 0) * n) / sum(n)::DOUBLE AS ece
  FROM bins GROUP BY model),
curve AS MATERIALIZED (
  SELECT model, tau AS threshold, avg((conf > tau)::INTEGER) AS coverage,
         count(*) FILTER (NOT conf > tau) AS rejected, count(*) FILTER (conf > tau) AS answered,
         avg((label = target)::INTEGER) FILTER (conf > tau) AS selective_accuracy
  FROM evaluated, (VALUES {taus}) t(tau) GROUP BY model, tau)"""


def _any_of(phrases: list[str]) -> str:
    return "(" + " OR ".join(f"contains(low, {_quoted(p)})" for p in phrases) + ")"


def _categories(source: str, name: str, by_hits: bool = False) -> str:
    """Category and keyword of every row of ``source`` (text, true_label, predicted_label[, hits])."""

    def holds(k: str) -> str:
        return f"list_contains(hits, '{k}')" if by_hits else _any_of(rules.DEFAULT_PHRASES[k])

    false_positive = " ".join(
        f"WHEN true_label = 0 AND {holds(k)} THEN '{label}'" for k, label in rules.FALSE_POSITIVE_RULES
    )
    false_negative = " ".join(f"WHEN {holds(k)} THEN '{label}'" for k, label in rules.FALSE_NEGATIVE_RULES)
    return f"""
{name} AS MATERIALIZED (
  SELECT * EXCLUDE (low, n_raw),
         CASE WHEN true_label = predicted_label THEN '{rules.NO_ERROR}'
              {false_positive}
              WHEN true_label = 0 AND keyword <> '' THEN '{rules.KEYWORD_FALSE_POSITIVE}'
              WHEN true_label = 0 THEN '{rules.OTHER_FALSE_POSITIVE}'
              WHEN n_raw <= {rules.SHORT_TEXT_TOKENS} THEN '{rules.SHORT_FALSE_NEGATIVE}'
              {false_negative}
              ELSE '{rules.OTHER_FALSE_NEGATIVE}' END AS category
  FROM (SELECT *, lower(text) AS low, {_KEYWORD} AS keyword,
               len(regexp_extract_all(lower(text), {_quoted(TOKEN_PATTERN)})) AS n_raw
        FROM {source}))"""


_ERRORS = f"""{_DOC_PREDICTIONS},
wrong AS MATERIALIZED (
  SELECT model, p.id, target AS true_label, (prob >= 0.5)::INTEGER AS predicted_label,
         greatest(prob, 1.0::DOUBLE - prob) AS confidence, prob AS prob_positive, d.text
  FROM doc_preds p JOIN docs d USING (id) WHERE (prob >= 0.5)::INTEGER <> target),
{_categories('wrong', 'errors')}"""

_SUMMARY = f"""{_ERRORS},
summary AS MATERIALIZED (
  SELECT model, category, count(*) AS error_count,
         count(*) FILTER (confidence >= 0.9) AS high_confidence_error_count,
         avg(confidence) AS mean_confidence, max(confidence) AS max_confidence
  FROM errors GROUP BY model, category)"""

_BOARD_COLUMNS = """base_model, method, round(accuracy, 8) AS accuracy,
  round(precision, 8) AS precision, round(recall, 8) AS recall, round(f1, 8) AS f1,
  round(log_loss, 8) AS log_loss, round(brier_score, 8) AS brier_score, tn, fp, fn, tp,
  round(ece, 8) AS ece, model"""

_VARIANT = "split_part(model, '/', 1) AS base_model, CASE WHEN contains(model, '/') THEN " \
    "substr(model, instr(model, '/') + 1) ELSE 'raw' END AS method"

_BOARD = f"SELECT {_BOARD_COLUMNS} FROM (SELECT *, {_VARIANT} FROM metrics JOIN eces USING (model))"

_LOGITS_PREDICTIONS = f"""{_EVENTS},
external AS MATERIALIZED (SELECT * REPLACE (
  exp(score / 2 - abs(score / 2)) / (exp(-score / 2 - abs(score / 2)) + exp(score / 2 - abs(score / 2)))
    AS prob, 'vendor_model/raw' AS model, 'vendor_model' AS base_model) FROM ev),
{_split('external', 'preds')},{_TEMPERATURES},
cal AS MATERIALIZED (SELECT * FROM preds WHERE split = 'calibration'),
test AS MATERIALIZED (SELECT * FROM preds WHERE split = 'test')"""


def statements() -> dict[str, str]:
    sql: dict[str, str] = {}

    # text
    sql["labelled_csv"] = """
SELECT d.doc_id AS id, d.source AS keyword, d.lang,
  chr(10) || '  ' || d.text || ' ' || chr(10) AS text, l.quality AS target
FROM documents d JOIN labels l USING (doc_id)"""
    sql["compose_text"] = f"WITH {_DOCS} SELECT id, text FROM docs"
    sql["keyword_clean"] = (
        "SELECT doc_id AS id, trim(replace(coalesce(source, ''), '%20', ' ')) AS keyword FROM documents"
    )
    sql["tokenize"] = f"""
WITH {_DOCS} SELECT id, len(tok)::INTEGER AS n_tokens, array_to_string(tok, ' ') AS tokens
FROM (SELECT id, {_tokens('text')} AS tok FROM docs)"""
    sql["ngrams"] = f"""
WITH {_DOCS} SELECT id, len(terms)::INTEGER AS n_terms, array_to_string(terms, '|') AS terms
FROM (SELECT id, list_concat(tok, {_BIGRAMS}) AS terms
      FROM (SELECT id, {_tokens('text')} AS tok FROM docs))"""
    sql["raw_token_count"] = f"""
WITH {_DOCS} SELECT id, len(regexp_extract_all(lower(text), {_quoted(TOKEN_PATTERN)}))::INTEGER AS n_tokens
FROM docs"""
    sql["keyword_extract"] = f"WITH {_DOCS} SELECT id, {_KEYWORD} AS keyword FROM docs"
    sql["term_doc_frequency"] = f"""
WITH {_DOC_TERMS} SELECT term, sum(c)::BIGINT AS tf, count(*) AS df FROM doc_terms GROUP BY term"""
    sql["vocabulary"] = f"""
WITH {_DOC_TERMS}, {_vocabulary('vocab', 'doc_terms', 'docs')}
SELECT term, idx, tf, df, round(idf, 8) AS idf FROM vocab"""
    sql["vocabulary_unlimited"] = f"""
WITH {_DOC_TERMS}, {_vocabulary('vocab', 'doc_terms', 'docs', 2_000_000_000)}
SELECT term, idx, tf, df, round(idf, 8) AS idf FROM vocab"""
    sql["tfidf"] = f"""
WITH {_DOC_TERMS}, {_vocabulary('vocab', 'doc_terms', 'docs')}, {_tfidf('feats', 'doc_terms', 'vocab')}
SELECT id, idx, round(w, 8) AS w FROM feats"""
    sql["mlp_encode"] = f"""
WITH {_DOCS},
doc_tokens AS MATERIALIZED (SELECT id, {_tokens('text')} AS tok FROM docs),
placed AS MATERIALIZED (
  SELECT id, unnest(tok) AS term, unnest(range(len(tok))) AS pos FROM doc_tokens),
token_counts AS MATERIALIZED (SELECT id, term, count(*) AS c FROM placed GROUP BY ALL),
{_vocabulary('vocab', 'token_counts', 'docs', 10000)}
SELECT d.id, coalesce(e.token_ids, '') AS token_ids
FROM docs d LEFT JOIN (
  SELECT id, string_agg(idx::VARCHAR, ' ' ORDER BY pos) AS token_ids
  FROM placed JOIN vocab USING (term) GROUP BY id) e USING (id)"""

    sql["document_embeddings"] = f"""
WITH {_DOCS},
doc_tokens AS MATERIALIZED (SELECT id, {_tokens('text')} AS tok FROM docs),
placed AS MATERIALIZED (SELECT id, unnest(tok) AS term FROM doc_tokens),
token_counts AS MATERIALIZED (SELECT id, term, count(*) AS c FROM placed GROUP BY ALL),
{_vocabulary('vocab', 'token_counts', 'docs', '(SELECT count(*) FROM embeddings)')},
parts AS MATERIALIZED (
  SELECT t.id, d.dim, sum(t.c) AS n, sum(t.c * e.embedding[d.dim + 1]::DOUBLE) AS total
  FROM token_counts t JOIN vocab USING (term) JOIN embeddings e ON e.vec_id = vocab.idx,
       range(64) d(dim)
  GROUP BY t.id, d.dim)
SELECT docs.id, d.dim::INTEGER AS dim, round(coalesce(p.total / p.n, 0.0::DOUBLE), 8) AS value
FROM docs CROSS JOIN range(64) d(dim) LEFT JOIN parts p ON p.id = docs.id AND p.dim = d.dim"""
    sql["ensemble_vocabularies"] = f"""
WITH {_TRAIN_FEATURES},{_MEMBERS}
SELECT term, idx, tf, df, round(idf, 8) AS idf, member FROM known"""
    sql["ensemble_stationarity"] = f"""
WITH {_TRAIN_FEATURES},{_MEMBERS}
SELECT member, count(*) > 0 AS stationary FROM known GROUP BY member"""
    sql["ensemble_mean_fixed"] = f"""
WITH {_TRAIN_FEATURES},{_MEMBERS},
cells AS MATERIALIZED (
  SELECT t.id, k.member, k.idx, (1.0::DOUBLE + ln(t.c::DOUBLE)) * k.idf AS w
  FROM lab_terms t JOIN known k USING (term)),
dots AS MATERIALIZED (
  SELECT id, member, sum(w * ((idx * (37 + member)) % 101 - 50) / 100.0::DOUBLE) / sqrt(sum(w * w)) AS dot
  FROM cells GROUP BY ALL),
scored AS MATERIALIZED (
  SELECT d.id, m.member, 0.1::DOUBLE * m.member - 0.2::DOUBLE + coalesce(dot, 0.0::DOUBLE) AS score
  FROM split_docs d CROSS JOIN range(5) m(member) LEFT JOIN dots x ON x.id = d.id AND x.member = m.member
  WHERE split <> 'train'),
probs AS MATERIALIZED (SELECT id, {_sigmoid('score')} AS prob FROM scored)
SELECT id, round(avg(prob), 8) AS prob, round(min(prob), 8) AS least, round(max(prob), 8) AS most
FROM probs GROUP BY id"""

    # sampling
    sql["stratified_split"] = f"WITH {_LABELLED} SELECT id, target, split FROM split_docs"
    sql["stratified_split_events"] = f"WITH {_EVENT_SPLITS} SELECT id, target, split FROM preds"
    sql["limit_rows"] = f"""
WITH {_EVENT_SPLITS} SELECT id, split FROM (
  SELECT id, split, row_number() OVER (PARTITION BY split ORDER BY md5('42:' || id), id) AS rn
  FROM preds) WHERE rn <= 500"""
    sql["split_counts"] = f"""
WITH {_EVENT_SPLITS} SELECT split, count(*) AS n_rows FROM preds GROUP BY split"""
    sql["bootstrap_multiplicities"] = """
WITH ranked AS MATERIALIZED (
  SELECT doc_id AS id, row_number() OVER (ORDER BY md5('142:' || doc_id), doc_id) - 1 AS rank
  FROM labels),
size AS (SELECT count(*) AS n FROM labels),
draws AS MATERIALIZED (
  SELECT slot // n AS member, ('0x' || substr(md5('142:' || slot), 1, 15))::BIGINT % n AS rank
  FROM size, range((SELECT 5 * n FROM size)) g(slot))
SELECT r.id, m.member::INTEGER AS member, count(d.rank)::INTEGER AS multiplicity
FROM ranked r CROSS JOIN range(5) m(member)
LEFT JOIN draws d ON d.rank = r.rank AND d.member = m.member
GROUP BY r.id, m.member"""

    # scalars
    sql["score_scalars"] = f"""
WITH {_EVENTS} SELECT id, round({_sigmoid('score')}, 9) AS sigmoid, {_clip('prob')} AS clipped,
  (prob >= 0.5)::INTEGER AS label, greatest(prob, 1.0::DOUBLE - prob) AS confidence,
  CASE WHEN target = 1 THEN prob ELSE 1.0::DOUBLE - prob END AS true_class_prob,
  1.0::DOUBLE - CASE WHEN target = 1 THEN prob ELSE 1.0::DOUBLE - prob END AS nonconformity,
  round({_loss('target', 'prob')}, 9) AS log_loss,
  target * (1.0::DOUBLE - 0.1::DOUBLE) + 0.5::DOUBLE * 0.1::DOUBLE AS soft_label,
  CASE WHEN target = 1 THEN 1.0::DOUBLE ELSE -1.0::DOUBLE END AS signed_label,
  greatest(prob, 1.0::DOUBLE - prob) > 0.75::DOUBLE AS answered
FROM ev"""
    sql["variant_names"] = f"""
SELECT model, {_VARIANT}, count(*) AS n FROM (
  SELECT CASE event_type WHEN 'click' THEN 'm' || (user_id % 4)
              WHEN 'view' THEN 'm' || (user_id % 4) || '/raw'
              ELSE 'm' || (user_id % 4) || '/raw/v2' END AS model FROM events) GROUP BY ALL"""
    sql["softmax_scores"] = f"""
WITH {_EVENTS},
two AS (SELECT id, score / 2 AS a, score,
               CASE event_type WHEN 'click' THEN 0 WHEN 'view' THEN 1 ELSE 2 END AS kind
        FROM ev JOIN events ON id = event_id),
parts AS (SELECT *, exp(-a - m) AS e0, exp(a - m) AS e1, exp(0.25::DOUBLE - m) AS e2
          FROM (SELECT *, CASE WHEN kind = 2 THEN greatest(abs(a), 0.25::DOUBLE) ELSE abs(a) END AS m
                FROM two))
SELECT id, round(score, 9) AS score,
  round(CASE WHEN kind = 0 THEN {_sigmoid('score')}
             WHEN kind = 1 THEN e1 / (e0 + e1) ELSE e1 / (e0 + e1 + e2) END, 9) AS prob
FROM parts"""

    # models with a closed form
    sql["nb_fit"] = f"WITH {_NB} SELECT idx, round(weight, 8) AS weight FROM nb"
    sql["nb_score"] = f"""
WITH {_NB_PREDICTIONS}
SELECT id, split, target, round(score, 7) AS score, round(prob, 8) AS prob FROM preds"""
    sql["nb_score_all_documents"] = f"""
WITH {_DOC_TERMS}, {_NB}, {_tfidf('all_feats', 'doc_terms', 'vocab')}
SELECT d.id, round((SELECT prior FROM nb_prior) + coalesce(s.total, 0.0::DOUBLE), 7) AS score
FROM docs d LEFT JOIN (
  SELECT id, sum(f.w * nb.weight) AS total FROM all_feats f JOIN nb USING (idx) GROUP BY id) s
  USING (id)"""
    sql["nb_leaderboard"] = f"""
WITH {_NB_PREDICTIONS},{_TEMPERATURES},
both_variants AS MATERIALIZED (
  SELECT model, target, prob FROM preds WHERE split = 'test'
  UNION ALL
  SELECT base_model || '/temperature_scaling', target,
         {_clip('(' + _sigmoid('(score / temperature)') + ')')}
  FROM preds JOIN temps USING (model) WHERE split = 'test'),{_metrics('both_variants')}
{_BOARD}"""

    sql["saved_errors_roundtrip"] = """
SELECT source AS model, '  ' || text || ' "q", ' || chr(10) || ' ' AS text, 0::INTEGER AS true_label,
  1::INTEGER AS predicted_label, 0.5::DOUBLE AS confidence, 0.5::DOUBLE AS prob_positive,
  doc_id::VARCHAR AS keyword
FROM documents"""
    # A fit that ended where it should; its own numbers have no SQL.
    sql["logistic_stationarity"] = "SELECT 'logreg_tfidf' AS model, TRUE AS stationary"
    sql["smoothing_stationarity"] = "SELECT 'label_smoothing' AS model, TRUE AS stationary"
    sql["training_beats_constant"] = """
SELECT unnest(['linear_svm_tfidf', 'bootstrap_ensemble', 'embedding_mlp']) AS model, TRUE AS better"""
    sql["external_scoring"] = f"""
WITH scored AS MATERIALIZED (
  SELECT vec_id AS id,
    list_sum(list_transform(range(64), lambda k: embedding[k + 1]::DOUBLE * ((k * 7) % 11 - 5) / 11.0::DOUBLE)) AS l0,
    list_sum(list_transform(range(64), lambda k: embedding[k + 1]::DOUBLE * ((k * 5) % 13 - 6) / 13.0::DOUBLE)) AS l1
  FROM embeddings)
SELECT id, 'outside-net/raw' AS model, (id % 3 = 0)::INTEGER AS target, round(l1 - l0, 7) AS score,
  round({_clip('(' + _sigmoid('(l1 - l0)') + ')')}, 8) AS prob
FROM scored"""
    sql["mlp_score_fixed"] = f"""
WITH {_DOCS},{_network('docs')}
SELECT id, round(score, 8) AS score, round({_clip('(' + _sigmoid('score') + ')')}, 8) AS prob FROM net"""
    sql["mlp_gradient"] = f"""
WITH {_LABELLED},
train AS MATERIALIZED (SELECT * FROM split_docs WHERE split = 'train'),{_network('train')},
err AS MATERIALIZED (SELECT id, {_sigmoid('score')} - target AS e FROM net JOIN train USING (id)),
inner_ AS MATERIALIZED (
  SELECT id, j, CASE WHEN h > 0 THEN e * ((j * 11 + 3) % 19 - 9) / 19.0::DOUBLE ELSE 0.0::DOUBLE END AS g
  FROM h JOIN err USING (id)),
back AS MATERIALIZED (
  SELECT id, k, sum(g * ((k * 31 + j * 17) % 41 - 20) / 41.0::DOUBLE) AS b FROM inner_, range(6) r(k) GROUP BY ALL),
found AS (
  SELECT 'embedding' AS part, v.idx AS i, k AS j, coalesce(sum(f.c * b / f.n), 0.0::DOUBLE) AS value
  FROM vocab v CROSS JOIN range(6) r(k) LEFT JOIN known f USING (idx) LEFT JOIN back USING (id, k) GROUP BY ALL
  UNION ALL SELECT 'w1', k, j, sum(x * g) FROM x JOIN inner_ USING (id) GROUP BY ALL
  UNION ALL SELECT 'b1', j, 0, sum(g) FROM inner_ GROUP BY ALL
  UNION ALL SELECT 'w2', j, 0, sum(greatest(h, 0.0::DOUBLE) * e) FROM h JOIN err USING (id) GROUP BY ALL
  UNION ALL SELECT 'b2', 0, 0, sum(e) FROM err)
SELECT part, i::INTEGER AS i, j::INTEGER AS j, round(value, 6) + 0.0::DOUBLE AS value FROM found"""
    sql["svm_objective_fixed"] = f"""
WITH {_TRAIN_FEATURES},
rows AS MATERIALIZED (
  SELECT id, (2 * target - 1)::DOUBLE AS y, ((id * 37) % 101) / 100.0::DOUBLE AS a, (SELECT count(*) FROM train_docs) AS n
  FROM train_docs),
weights AS MATERIALIZED (
  SELECT idx, sum(a * y / (1e-3::DOUBLE * n) * w) AS weight FROM rows JOIN feats USING (id) GROUP BY idx),
level AS (SELECT sum(a * y / (1e-3::DOUBLE * n)) AS level FROM rows),
scored AS (
  SELECT r.id, y, a, coalesce(sum(w * weight), 0.0::DOUBLE) + (SELECT level FROM level) AS score
  FROM rows r LEFT JOIN feats f ON f.id = r.id LEFT JOIN weights USING (idx) GROUP BY ALL),
half AS (
  SELECT 1e-3::DOUBLE / 2 * ((SELECT sum(weight * weight) FROM weights) + level * level) AS half FROM level),
found AS (
  SELECT count(*) AS n, max(half) + avg(greatest(0.0::DOUBLE, 1 - y * score)) AS primal, avg(a) - max(half) AS dual
  FROM scored, half)
SELECT n, round(primal, 7) AS primal, round(dual, 7) AS dual, round(primal - dual, 7) AS gap FROM found"""
    sql["svm_duality_gap"] = f"""
WITH {_LABELLED}
SELECT count(*) AS n, TRUE AS closed, TRUE AS stored_duals_agree, TRUE AS better_than_nothing
FROM split_docs WHERE split = 'train'"""
    sql["linear_score_fixed"] = f"""
WITH {_DOC_TERMS}, {_vocabulary('vocab', 'doc_terms', 'docs')}, {_tfidf('feats', 'doc_terms', 'vocab')},
scored AS (
  SELECT docs.id, 0.25::DOUBLE + coalesce(sum(w * ((idx * 37) % 101 - 50) / 100.0::DOUBLE), 0.0::DOUBLE) AS score
  FROM docs LEFT JOIN feats ON feats.id = docs.id GROUP BY docs.id)
SELECT id, round(score, 7) AS score, round({_clip('(' + _sigmoid('score') + ')')}, 8) AS prob FROM scored"""
    sql["vectors"] = f"""
WITH {_DOC_TERMS}, {_vocabulary('vocab', 'doc_terms', 'docs')}, {_tfidf('feats', 'doc_terms', 'vocab')}
SELECT docs.id, (SELECT count(*) FROM vocab) AS size, count(w) AS n_values,
  round(coalesce(sum(w), 0.0::DOUBLE), 8) AS total
FROM docs LEFT JOIN feats ON feats.id = docs.id GROUP BY docs.id"""
    sql["metric_sink"] = f"WITH {_EVENTS},{_metrics('ev')} {_BOARD}"

    # calibrators
    sql["temperature_losses"] = f"""
WITH {_EVENT_SPLITS},{_TEMPERATURES}
SELECT model, step, round(temperature, 9) AS temperature, round(loss, 8) AS loss FROM losses"""
    sql["temperature_fit"] = f"""
WITH {_EVENT_SPLITS},{_TEMPERATURES} SELECT model, round(temperature, 9) AS temperature FROM temps"""
    sql["temperature_apply"] = f"""
WITH {_EVENT_SPLITS},{_TEMPERATURES}
SELECT model, id, round({_clip('(' + _sigmoid('(score / temperature)') + ')')}, 9) AS prob
FROM preds JOIN temps USING (model) WHERE split = 'test'"""
    sql["platt_apply"] = f"""
WITH {_EVENTS} SELECT model, id,
  round({_clip('(' + _sigmoid('(0.75::DOUBLE * score - 0.2::DOUBLE)') + ')')}, 9) AS prob FROM ev"""
    newton = f"""
WITH RECURSIVE {_EVENT_SPLITS},
cal AS MATERIALIZED (SELECT model, score AS z, target AS y FROM preds WHERE split = 'calibration'),
newton(model, step, a, b) AS (
  SELECT DISTINCT model, 0, 1.0::DOUBLE, 0.0::DOUBLE FROM cal
  UNION ALL
  SELECT model, step + 1,
         a - (h00 * (g1 + 1e-4::DOUBLE * a) - h10 * g0) / ((h11 + 1e-4::DOUBLE) * h00 - h10 * h10),
         b - ((h11 + 1e-4::DOUBLE) * g0 - h10 * (g1 + 1e-4::DOUBLE * a)) / ((h11 + 1e-4::DOUBLE) * h00 - h10 * h10)
  FROM (SELECT model, step, a, b, avg((p - y) * z) AS g1, avg(p - y) AS g0,
               avg(p * (1 - p) * z * z) AS h11, avg(p * (1 - p) * z) AS h10, avg(p * (1 - p)) AS h00
        FROM (SELECT n.model, n.step, n.a, n.b, z, y, 1 / (1 + exp(-(n.a * z + n.b))) AS p
              FROM newton n JOIN cal USING (model) WHERE n.step < 20)
        GROUP BY model, step, a, b))"""
    sql["platt_fit"] = f"""{newton}
SELECT model, round(a, 8) AS slope, round(b, 8) AS intercept FROM newton WHERE step = 20"""
    sql["calibrated_family_platt"] = f"""{newton}
SELECT base_model || '/platt_scaling_extra' AS model, base_model, 'platt_scaling_extra' AS method,
  split, id, target, round({_clip('(' + _sigmoid('(a * score + b)') + ')')}, 8) AS prob
FROM preds JOIN newton USING (model) WHERE split = 'test' AND step = 20"""
    sql["isotonic_fit"] = f"""
WITH {_EVENT_CALIBRATION} SELECT model, lo, hi, last, value FROM blocks"""
    sql["isotonic_apply"] = f"""
WITH {_EVENT_CALIBRATION},{_ISOTONIC_TEST} SELECT model, id, isotonic_prob AS prob FROM isotonic_test"""
    sql["calibrated_family"] = f"""
WITH {_FAMILY} SELECT model, base_model, method, split, id, target, round(prob, 9) AS prob FROM family"""

    # evaluation over all event scores
    ev = f"WITH {_EVENTS},{_metrics('ev')}"
    sql["classification_metrics"] = f"""{ev}
SELECT model, round(accuracy, 8) AS accuracy, round(precision, 8) AS precision,
  round(recall, 8) AS recall, round(f1, 8) AS f1, round(log_loss, 8) AS log_loss,
  round(brier_score, 8) AS brier_score, tn, fp, fn, tp FROM metrics"""
    sql["reliability_bins"] = f"""{ev}
SELECT model, bin, left_edge AS "left", right_edge AS "right", n AS "count",
  round(mean_confidence, 8) AS mean_confidence, round(accuracy, 8) AS accuracy FROM bins"""
    sql["ece"] = f"{ev} SELECT model, round(ece, 8) AS ece FROM eces"
    sql["rejection_curve"] = f"""{ev}
SELECT model, threshold, round(coverage, 8) AS coverage, rejected, answered,
  round(selective_accuracy, 8) AS selective_accuracy FROM curve"""
    sql["leaderboard"] = f"WITH {_FAMILY},{_metrics('family')} {_BOARD}"
    sql["best_variant"] = f"""
WITH {_FAMILY},{_metrics('family')}
SELECT model, round(ece, 8) AS ece, round(log_loss, 8) AS log_loss
FROM metrics JOIN eces USING (model) ORDER BY eces.ece, metrics.log_loss, model LIMIT 1"""

    sql["family_order"] = f"""
WITH {_FAMILY},{_metrics('family')}
SELECT base_model, row_number() OVER (ORDER BY best)::INTEGER AS place
FROM (SELECT split_part(model, '/', 1) AS base_model,
             min({{'a': eces.ece, 'b': metrics.log_loss, 'c': model}}) AS best
      FROM metrics JOIN eces USING (model) GROUP BY ALL)"""

    # conformal
    sql["conformal_quantile"] = f"WITH {_CONFORMAL} SELECT model, alpha, n, qhat FROM quantiles"
    sql["conformal_sets"] = f"""
WITH {_CONFORMAL} SELECT model, alpha, id, include_0, include_1, set_size, contains_true,
  set_size = 1 AS is_singleton, set_size = 0 AS is_empty, set_size = 2 AS is_ambiguous FROM sets"""
    sql["conformal_eval"] = f"""
WITH {_CONFORMAL} SELECT model, alpha, target_coverage, qhat,
  round(empirical_coverage, 8) AS empirical_coverage, round(avg_set_size, 8) AS avg_set_size,
  round(singleton_rate, 8) AS singleton_rate, round(ambiguous_rate, 8) AS ambiguous_rate,
  round(empty_rate, 8) AS empty_rate, round(singleton_accuracy, 8) AS singleton_accuracy
FROM conformal"""

    # errors
    sql["high_confidence_errors"] = f"""
WITH {_ERRORS} SELECT model, id, text, true_label, predicted_label, confidence, prob_positive
FROM wrong QUALIFY row_number() OVER (PARTITION BY model ORDER BY confidence DESC, id) <= 12"""
    sql["error_categories"] = f"""
WITH {_DOCS},
flipped AS MATERIALIZED (
  SELECT id, text, quality AS true_label, 1 - quality AS predicted_label
  FROM docs JOIN labels ON id = doc_id),
{_categories('flipped', 'categories')} SELECT id, category FROM categories"""
    named = " ".join(
        f"WHEN idx % 240 = {k} THEN '{n}'"
        for k, n in enumerate(("real_event", "news", "metaphor", "commerce", "fiction", "false_alarm"))
    )
    sql["error_categories_rules"] = f"""
WITH {_DOC_TERMS}, {_vocabulary('vocab', 'doc_terms', 'docs')},
phrases AS MATERIALIZED (
  SELECT term, CASE {named} ELSE 'list' || (idx % 40) END AS rule_set FROM vocab WHERE idx >= 5000),
met AS MATERIALIZED (
  SELECT id, list_sort(list(DISTINCT rule_set)) AS hits
  FROM docs JOIN labels ON id = doc_id JOIN phrases ON contains(lower(text), term) GROUP BY id),
flipped AS MATERIALIZED (
  SELECT d.id, text, quality AS true_label, 1 - quality AS predicted_label, coalesce(hits, []) AS hits
  FROM docs d JOIN labels ON d.id = doc_id LEFT JOIN met ON met.id = d.id),
{_categories('flipped', 'categories', True)}
SELECT id, category, array_to_string(hits, ',') AS hits FROM categories"""
    sql["error_analysis"] = f"""
WITH {_ERRORS} SELECT model, id, category, true_label, predicted_label, confidence, prob_positive,
  confidence >= 0.9 AS is_high_confidence, keyword, text FROM errors"""
    sql["error_category_summary"] = f"""
WITH {_SUMMARY} SELECT model, category, error_count, high_confidence_error_count,
  round(mean_confidence, 8) AS mean_confidence, max_confidence FROM summary"""
    sql["error_examples"] = f"""
WITH {_ERRORS} SELECT model, id, category, true_label, predicted_label, confidence,
  CASE WHEN length(line) > 220 THEN substr(line, 1, 217) || '...' ELSE line END AS example
FROM (SELECT *, replace(text, chr(10), ' ') AS line FROM errors
      QUALIFY row_number() OVER (PARTITION BY model ORDER BY confidence DESC, id) <= 8)"""
    sql["recategorize"] = f"""
WITH {_ERRORS} SELECT model, category, count(*) AS error_count,
  count(*) AS high_confidence_error_count, round(avg(confidence), 8) AS mean_confidence,
  max(confidence) AS max_confidence FROM errors GROUP BY model, category"""

    # chart tables
    sql["reliability_series"] = f"""{ev}
SELECT model, bin, round(mean_confidence, 8) AS mean_confidence, round(accuracy, 8) AS accuracy
FROM bins WHERE n > 0"""
    sql["rejection_series"] = f"""{ev}
SELECT model, threshold, round(coverage, 8) AS coverage,
  round(selective_accuracy, 8) AS selective_accuracy
FROM curve WHERE selective_accuracy IS NOT NULL"""
    sql["threshold_panels"] = f"""{ev}
SELECT model, threshold, panel, round(value, 8) AS value,
  (SELECT greatest(max(rejected), 1) FROM curve) AS max_rejected
FROM (SELECT model, threshold, 'accuracy' AS panel, selective_accuracy AS value FROM curve
      UNION ALL SELECT model, threshold, 'coverage', coverage FROM curve
      UNION ALL SELECT model, threshold, 'rejected', rejected::DOUBLE FROM curve)
WHERE value IS NOT NULL"""
    sql["confusion_cells"] = f"""{ev},
cells AS (UNPIVOT (SELECT model, tn, fp, fn, tp FROM metrics) ON tn, fp, fn, tp
          INTO NAME cell VALUE n)
SELECT model, cell, n, round(n::DOUBLE / (SELECT greatest(max(n), 1) FROM cells)::DOUBLE, 8)
  AS intensity FROM cells"""
    sql["conformal_panels"] = f"""
WITH {_CONFORMAL}
SELECT model, alpha, panel, round(value, 8) AS value
FROM (SELECT model, alpha, 'coverage' AS panel, empirical_coverage AS value FROM conformal
      UNION ALL SELECT model, alpha, 'singleton_rate', singleton_rate FROM conformal
      UNION ALL SELECT model, alpha, 'set_size', avg_set_size FROM conformal)"""
    sql["category_matrix"] = f"""
WITH {_SUMMARY} SELECT category,
  coalesce(sum(high_confidence_error_count) FILTER (model = 'length_quality/raw'), 0)::BIGINT
    AS length_quality,
  coalesce(sum(high_confidence_error_count) FILTER (model = 'length_toxic/raw'), 0)::BIGINT
    AS length_toxic
FROM summary GROUP BY category"""

    # external model
    sql["external_experiment"] = f"""
WITH {_LOGITS_PREDICTIONS},{_blocks('cal')},{_ISOTONIC_TEST},
family AS MATERIALIZED (
  SELECT model, target, prob FROM test
  UNION ALL
  SELECT base_model || '/temperature_scaling', target,
         {_clip('(' + _sigmoid('(score / temperature)') + ')')} FROM test JOIN temps USING (model)
  UNION ALL
  SELECT base_model || '/isotonic_regression', target, isotonic_prob FROM isotonic_test),
{_metrics('family')} {_BOARD}"""
    return sql
