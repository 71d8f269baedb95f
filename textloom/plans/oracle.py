"""The same results as plain SQL for a second engine.

Written in the long form on purpose: one rule per call, bigrams by window, splits by rank over the
whole class, so that the two sides share definitions but not methods.
"""

from __future__ import annotations

from itertools import product

from textloom.fixed_values import (
    EMOTICONS, EMOTIONS, FEATURE_TOKEN, GRIDS, IRREGULAR_FORMS, MIN_COUNT, NOUN_SUFFIXES, STOP_WORDS, PRESERVED_WORDS,
    SWEEP_HIDDEN, SWEEP_ITERATIONS, SYMBOL_RANGES, TAG, TWO_PART_WORDS, URL, VECTOR_SIZE, VERB_SUFFIXES, WHITE_SPACE,
)
from textloom.plans.corpus import LANGS
from textloom.plans.queries import EDGE_CASES
from textloom.sources.synthetic import FILLS, TEMPLATES

K = len(LANGS)


def q(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def array(values) -> str:
    return "[" + ", ".join(map(q, values)) + "]"


def sub(text: str, pattern: str, by: str) -> str:
    return f"regexp_replace({text}, {q(pattern)}, {q(by)}, 'g')"


def label_of(name: str, labels=LANGS) -> str:
    return f"CASE {name} " + " ".join(f"WHEN {q(n)} THEN {i}" for i, n in enumerate(labels)) + " END"


def name_of(label: str, labels=LANGS) -> str:
    return f"CASE {label} " + " ".join(f"WHEN {i} THEN {q(n)}" for i, n in enumerate(labels)) + " WHEN -1 THEN 'unknown' END"


def normalise(text: str) -> str:
    x = f"lower(coalesce({text}, ''))"
    for emoticon, word in sorted(EMOTICONS, key=lambda p: -len(p[0])):
        x = f"replace({x}, {q(emoticon)}, {q(f' {word} ')})"
    for pattern, by in [
        (f"[{SYMBOL_RANGES}]+", " "), (URL, " "), (TAG, " "), (r"\b\d+\b", "NUMBER"),
        (r"[^a-z\s']", " "), ("'+", "'"), (r"\s+", " "),
    ]:
        x = sub(x, pattern, by)
    return f"trim({x})"


def tokens(normalised: str) -> str:
    x = sub(normalised, r"'([a-ce-lo-ru-z])\b", r"' \1")
    x = "(' ' || " + sub(x, "([^'])' ", r"\1 ' ") + " || ' ')"
    x = sub(x, "([^' ])('s|'m|'d|') ", r"\1 \2 ")
    x = sub(x, "([^' ])('ll|'re|'ve|n't) ", r"\1 \2 ")
    for a, b in TWO_PART_WORDS:
        x = sub(x, rf"\b({a})({b})\b", r" \1 \2 ")
    x = sub(x, r"\b(wan)(na) ", r" \1 \2 ")
    x = sub(x, r" ('t)(is)\b", r" \1 \2 ")
    x = sub(x, r" ('t)(was)\b", r" \1 \2 ")
    return f"list_filter(string_split({x}, ' '), lambda t: t <> '')"


STOP = array(sorted(set(STOP_WORDS) - set(PRESERVED_WORDS)))

DOCS = f"docs AS (SELECT doc_id AS id, text, lang AS emotion, {label_of('lang')} AS label FROM documents)"


def tokenised(source: str, out: str, min_len: int = 2) -> str:
    """CTEs from (id, text, ...) to out: the same with content and tokens."""
    return f"""{out}_n AS (SELECT *, {normalise('text')} AS normalised FROM {source}),
{out}_t AS (SELECT *, {tokens('normalised')} AS raw_tokens FROM {out}_n),
{out} AS (SELECT *, array_to_string(tokens, ' ') AS content FROM (
  SELECT *, list_filter(raw_tokens, lambda t: NOT list_contains({STOP}, t) AND length(t) >= {min_len}) AS tokens
  FROM {out}_t))"""


TOKS = f"{DOCS},\n{tokenised('docs', 'toks')}"


TOKEN_DF = "tdf AS (SELECT token, count(DISTINCT id) AS df FROM (SELECT id, unnest(tokens) AS token FROM toks1) GROUP BY token)"


def lemmas() -> str:
    rules = [(0, *r) for r in VERB_SUFFIXES] + [(1, *r) for r in NOUN_SUFFIXES]
    proposals = " UNION ALL ".join(
        f"SELECT token, {kind} AS kind, left(token, length(token) - {len(old)}) || {q(new)} AS lemma "
        f"FROM tdf WHERE suffix(token, {q(old)})" for kind, old, new in rules)
    irregular = ", ".join(f"({q(a)}, {q(b)})" for a, b in IRREGULAR_FORMS.items())
    return f"""{DOCS}, {tokenised('docs', 'toks1', 1)}, {TOKEN_DF},
irregular(token, lemma) AS (VALUES {irregular}),
proposed AS ({proposals}),
best AS (SELECT token, arg_min(lemma, (kind, length(lemma), lemma)) AS lemma FROM proposed
  WHERE lemma IN (SELECT token FROM tdf WHERE df >= 2) GROUP BY token),
lemma_of AS (SELECT t.token, coalesce(i.lemma, b.lemma, t.token) AS lemma, t.df
  FROM tdf t LEFT JOIN irregular i USING (token) LEFT JOIN best b USING (token))"""


def lemmatised(source: str, out: str) -> str:
    """CTEs from tokenised rows (tokens of any length) to out: tokens and content of lemmas."""
    return f"""{out}_u AS (SELECT id, unnest(tokens) AS token, generate_subscripts(tokens, 1) AS pos FROM {source}),
{out}_l AS (SELECT id, list(coalesce(lemma, token) ORDER BY pos) AS tokens FROM {out}_u LEFT JOIN lemma_of USING (token)
  WHERE length(coalesce(lemma, token)) >= 2 GROUP BY id),
{out} AS (SELECT s.* EXCLUDE (tokens, content), coalesce(l.tokens, []) AS tokens, array_to_string(coalesce(l.tokens, []), ' ') AS content
  FROM {source} s LEFT JOIN {out}_l l USING (id))"""


LEMMA_TOKS = f"{lemmas()},\n{lemmatised('toks1', 'toks')}"


def grams(source: str, out: str, key: str = "id", bigrams: bool = True) -> str:
    """CTE out: (id, term, tf) of source's content."""
    words = f"""{out}_f AS (SELECT {key} AS id, regexp_extract_all(content, {q(FEATURE_TOKEN)}) AS f FROM {source}),
{out}_w AS (SELECT id, unnest(f) AS w, generate_subscripts(f, 1) AS pos FROM {out}_f),"""
    two = f"""
  UNION ALL SELECT id, term FROM (
    SELECT id, w || ' ' || lead(w) OVER (PARTITION BY id ORDER BY pos) AS term FROM {out}_w) WHERE term IS NOT NULL"""
    return f"""{words}
{out} AS (SELECT id, term, count(*) AS tf FROM (
  SELECT id, w AS term FROM {out}_w{two if bigrams else ''}) GROUP BY id, term)"""


def share_out(prefix: str, counts: str, n: str, draws: str) -> str:
    """CTE prefix: (label, n, kept) - largest remainders of `draws` rows over the classes of `counts`."""
    return f"""{prefix}_d AS (SELECT CAST({draws} AS HUGEINT) AS draws, sum({n})::HUGEINT AS total FROM {counts}),
{prefix} AS (SELECT label, n, whole + CASE WHEN row_number() OVER (ORDER BY rest DESC, label) <= draws - sum(whole) OVER ()
    THEN 1 ELSE 0 END AS kept FROM (
  SELECT label, {n} AS n, draws, draws * {n} // total AS whole, draws * {n} % total AS rest FROM {counts}, {prefix}_d))"""


def three_way(items: str, out: str) -> str:
    """CTE out: items (label, key, tie, ...) with their split."""
    return f"""{out}_c AS (SELECT label, count(*)::HUGEINT AS n FROM {items} GROUP BY label),
{share_out(out + '_a', out + '_c', 'n', 'sum(n) - ceil(sum(n)::DECIMAL(20,0) * 0.20)')},
{share_out(out + '_b', out + '_a', 'kept', 'sum(kept) - ceil(sum(kept)::DECIMAL(20,0) * 0.125)')},
{out} AS (SELECT i.*, CASE WHEN r <= c.n - a.kept THEN 'test' WHEN r <= c.n - b.kept THEN 'val' ELSE 'train' END AS split
  FROM (SELECT *, row_number() OVER (PARTITION BY label ORDER BY key, tie) AS r FROM {items}) i
  JOIN {out}_c c USING (label) JOIN {out}_a a USING (label) JOIN {out}_b b USING (label))"""


ID_ITEMS = f"""id_items AS (SELECT id, label, md5(id || ':42') AS key, id::VARCHAR AS tie FROM docs),
{three_way('id_items', 'id_split')}"""
ID_SPLIT = f"{DOCS}, {ID_ITEMS}"

CONTENT_SPLIT = f"""{LEMMA_TOKS},
items AS (SELECT content, md5(content || ':42') AS key, '' AS tie, min(label) AS label FROM toks GROUP BY content),
{three_way('items', 'item_split')},
corpus AS (SELECT t.id, t.text, t.emotion, t.label, t.content, t.tokens, s.split FROM toks t JOIN item_split s USING (content))"""


def vocabulary(terms: str, out: str, docs: str, limit: int = 50_000) -> str:
    """CTE out: (term, idx, df, cf, idf) from terms over the documents of `docs`."""
    return f"""{out}_n AS (SELECT count(*) AS n FROM {docs}),
{out}_k AS (SELECT term, count(*) AS df, sum(tf)::BIGINT AS cf FROM {terms} GROUP BY term
  HAVING count(*) >= 2 AND count(*) <= 0.95 * (SELECT n FROM {out}_n) ORDER BY cf DESC, term LIMIT {limit}),
{out} AS (SELECT term, (row_number() OVER (ORDER BY term) - 1)::INT AS idx, df, cf,
  ln((1 + n) / (1.0 + df)::DOUBLE) + 1 AS idf FROM {out}_k, {out}_n)"""


def tfidf(terms: str, vocab: str) -> str:
    return f"""SELECT id, term, round(w / sqrt(sum(w * w) OVER (PARTITION BY id)), 6) AS weight FROM (
  SELECT id, term, (1 + ln(tf)) * idf AS w FROM {terms} JOIN {vocab} USING (term))"""


NB_TERMS = f"""{CONTENT_SPLIT},
train AS (SELECT * FROM corpus WHERE split = 'train'),
{grams('corpus', 'tc')},
train_tc AS (SELECT tc.*, label FROM tc JOIN train USING (id)),
{vocabulary('train_tc', 'vocab', 'train')}"""

CLASSES = f"classes AS (SELECT unnest(range({K}))::INT AS label)"

NB = f"""{NB_TERMS}, {CLASSES},
cnt AS (SELECT term, c.label, sum(CASE WHEN t.label = c.label THEN tf ELSE 0 END)::BIGINT AS n, sum(tf)::BIGINT AS everywhere
  FROM train_tc t JOIN vocab USING (term), classes c GROUP BY term, c.label),
tot AS (SELECT label, sum(n)::BIGINT AS n, sum(everywhere)::BIGINT AS everywhere FROM cnt GROUP BY label),
weights AS (SELECT term, cnt.label, -ln((1.0::DOUBLE + cnt.everywhere - cnt.n) /
  (1.0::DOUBLE * (SELECT count(*) FROM vocab) + tot.everywhere - tot.n)) AS w FROM cnt JOIN tot USING (label))"""


def nb_scored(source: str, terms: str, out: str) -> str:
    """CTEs from tokenised rows and their terms to out: id, label, score, n_tokens."""
    return f"""{out}_s AS (SELECT id, label, sum(tf * w) AS score FROM {terms} JOIN weights USING (term) GROUP BY id, label),
{out} AS (SELECT s.id, len(s.tokens) AS n_tokens, c.label AS class, coalesce(x.score, 0.0) AS score
  FROM {source} s CROSS JOIN classes c LEFT JOIN {out}_s x ON x.id = s.id AND x.label = c.label)"""


def nb_predicted(scored: str, out: str) -> str:
    return f"""{out}_p AS (SELECT id, class, n_tokens, score, max(score) OVER (PARTITION BY id) AS top FROM {scored}),
{out}_q AS (SELECT id, class, CASE WHEN n_tokens = 0 THEN 0.0
    ELSE exp(score - top) / sum(exp(score - top)) OVER (PARTITION BY id) END AS p FROM {out}_p),
{out} AS (SELECT id, CASE WHEN any_value(n_tokens) = 0 THEN -1 ELSE min(class) FILTER (score = top) END AS prediction
  FROM {out}_p GROUP BY id)"""


PREDICTED = f"""{NB}, {nb_scored('corpus', 'tc', 'scored')}, {nb_predicted('scored', 'pred')},
outcome AS (SELECT c.id, c.split, c.label AS actual, p.prediction AS predicted FROM corpus c JOIN pred p USING (id))"""

HELD_OUT = f"{PREDICTED}, held AS (SELECT * FROM outcome WHERE split IN ('val', 'test'))"


def one_vs_rest(source: str, by: str = "") -> str:
    """CTEs ovr (counts) and rates (unrounded) for each class of classes."""
    b = f"{by}, " if by else ""
    groups = f"(SELECT DISTINCT {by} FROM {source}) CROSS JOIN" if by else ""
    link = f"h.{by} = g.{by}" if by else "true"
    g = f"SELECT * FROM {groups} classes"
    return f"""ovr AS (SELECT {f'g.{by}, ' if by else ''}g.label,
    count(*) FILTER (actual = g.label) AS support,
    count(*) FILTER (actual = g.label AND predicted = g.label) AS tp,
    count(*) FILTER (actual <> g.label AND predicted = g.label) AS fp,
    count(*) FILTER (actual = g.label AND predicted <> g.label) AS fn,
    count(*) FILTER (actual <> g.label AND predicted <> g.label) AS tn
  FROM ({g}) g JOIN {source} h ON {link} GROUP BY ALL),
rates AS (SELECT *, CASE WHEN tp + fp > 0 THEN tp / (tp + fp)::DOUBLE ELSE 0.0 END AS precision,
    CASE WHEN tp + fn > 0 THEN tp / (tp + fn)::DOUBLE ELSE 0.0 END AS recall,
    CASE WHEN 2 * tp + fp + fn > 0 THEN 2 * tp / (2 * tp + fp + fn)::DOUBLE ELSE 0.0 END AS f1,
    CASE WHEN tn + fp > 0 THEN tn / (tn + fp)::DOUBLE ELSE 0.0 END AS specificity FROM ovr),
overall AS (SELECT {b}sum(support)::BIGINT AS support, sum(tp) / sum(support)::DOUBLE AS accuracy,
    sum(precision * support) / sum(support) AS precision, sum(recall * support) / sum(support) AS recall,
    sum(round(recall, 4) * support) / sum(support) AS sensitivity,
    sum(round(specificity, 4) * support) / sum(support) AS specificity,
    sum(f1 * support) / sum(support) AS f1_weighted,
    avg(precision) AS macro_precision, avg(recall) AS macro_recall, avg(f1) AS macro_f1
  FROM rates {f'GROUP BY {by}' if by else ''})"""


METRICS = ["accuracy", "precision", "recall", "sensitivity", "specificity", "f1_weighted"]


def long_metrics(by: str = "") -> str:
    b = f"{by}, " if by else ""
    return " UNION ALL ".join(f"SELECT {b}'{m}' AS metric, round({m}, 4) AS value FROM overall" for m in METRICS)


STRIP = f"'^[{WHITE_SPACE}]+|[{WHITE_SPACE}]+$'"
LINES = f"""lines AS (SELECT conv_id, turn, (pos - 1)::INT AS line_no, regexp_replace(part, {STRIP}, '', 'g') AS line FROM (
  SELECT conv_id, turn, unnest(parts) AS part, generate_subscripts(parts, 1) AS pos FROM (
    SELECT conv_id, turn, regexp_split_to_array(text, '\\r\\n|[\\n\\r\\x0b\\x0c\\x1c-\\x1e\\x{{85}}\\x{{2028}}\\x{{2029}}]') AS parts
    FROM conversations)) WHERE regexp_replace(part, {STRIP}, '', 'g') <> '')"""

WORDS = f"list_filter(regexp_split_to_array(coalesce(text, ''), '[{WHITE_SPACE}]+'), lambda t: t <> '')"
LENGTHS = f"{DOCS}, lens AS (SELECT id, emotion, len({WORDS}) AS x FROM docs)"

def draw(options: str, salt: str) -> str:
    return f"(('0x' || substr(md5(id || ':42:{salt}'), 1, 8))::BIGINT % {options})"


def synthetic() -> str:
    templates = "[" + ", ".join(array(TEMPLATES[e]) for e in EMOTIONS) + "]"
    fills = "[" + ", ".join(array(FILLS[e]) for e in EMOTIONS) + "]"
    return f"""WITH ids AS (SELECT doc_id AS id, (doc_id % {len(EMOTIONS)})::INT AS label FROM documents),
pools AS (SELECT id, label, {templates}[label + 1] AS t, {fills}[label + 1] AS f FROM ids)
SELECT id, replace(t[{draw('len(t)', 'template')} + 1], '{{}}', f[{draw('len(f)', 'fill')} + 1]) AS text,
  label, {array(EMOTIONS)}[label + 1] AS emotion, md5(id || ':42') AS shuffle_key FROM pools"""


def preview(text: str) -> str:
    return f"CASE WHEN length({text}) > 80 THEN left({text}, 80) || '…' ELSE {text} END"


def cross_validation() -> str:
    alphas = "(0, 0.1::DOUBLE), (1, 0.5::DOUBLE), (2, 1.0::DOUBLE)"
    return f"""{NB_TERMS}, {CLASSES},
train_items AS (SELECT content, md5(content || ':42') AS key, min(label) AS label FROM train GROUP BY content),
fold_c AS (SELECT label, count(*) AS n FROM train_items GROUP BY label),
fold_start AS (SELECT label, coalesce(sum(n) OVER (ORDER BY label ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start, n FROM fold_c),
fold_size AS (SELECT label, f, sum(m) OVER (PARTITION BY label ORDER BY f) AS upto FROM (
  SELECT label, f, (SELECT count(*) FROM range(start::BIGINT, (start + n)::BIGINT) s(j) WHERE j % 5 = f) AS m
  FROM fold_start, range(5) r(f))),
fold_item AS (SELECT content, min(f)::INT AS fold FROM (
    SELECT *, row_number() OVER (PARTITION BY label ORDER BY key) AS r FROM train_items) JOIN fold_size USING (label)
  WHERE r <= upto GROUP BY content),
folded AS (SELECT id, label, fold FROM train JOIN fold_item USING (content)),
grid(grid_idx, alpha) AS (VALUES {alphas}),
folds AS (SELECT unnest(range(5))::INT AS fold),
seen AS (SELECT term, folds.fold, c.label,
    sum(CASE WHEN d.fold <> folds.fold AND d.label = c.label THEN tf ELSE 0 END)::BIGINT AS n,
    sum(CASE WHEN d.fold <> folds.fold THEN tf ELSE 0 END)::BIGINT AS everywhere
  FROM tc JOIN folded d USING (id) JOIN vocab USING (term), folds, classes c GROUP BY term, folds.fold, c.label),
seen_tot AS (SELECT fold, label, sum(n)::BIGINT AS n, sum(everywhere)::BIGINT AS everywhere FROM seen GROUP BY fold, label),
cv_w AS (SELECT term, s.fold, s.label, grid_idx, alpha, -ln((alpha + s.everywhere - s.n) /
    (alpha * (SELECT count(*) FROM vocab) + t.everywhere - t.n)) AS w
  FROM seen s JOIN seen_tot t USING (fold, label), grid),
cv_s AS (SELECT d.id, grid_idx, w.label, sum(tf * w) AS score FROM tc JOIN folded d USING (id)
  JOIN cv_w w ON w.term = tc.term AND w.fold = d.fold GROUP BY d.id, grid_idx, w.label),
cv_all AS (SELECT d.id, d.fold, d.label AS actual, g.grid_idx, g.alpha, c.label, coalesce(s.score, 0.0) AS score
  FROM folded d CROSS JOIN grid g CROSS JOIN classes c
  LEFT JOIN cv_s s ON s.id = d.id AND s.grid_idx = g.grid_idx AND s.label = c.label),
cv_pred AS (SELECT id, fold, grid_idx, alpha, any_value(actual) AS actual, min(label) FILTER (score = top) AS predicted FROM (
    SELECT *, max(score) OVER (PARTITION BY id, grid_idx) AS top FROM cv_all) GROUP BY id, fold, grid_idx, alpha),
cv_f1 AS (SELECT grid_idx, alpha, fold, avg(f1) AS score FROM (
  SELECT grid_idx, alpha, fold, c.label, coalesce(2 * count(*) FILTER (actual = c.label AND predicted = c.label) /
    nullif(count(*) FILTER (actual = c.label) + count(*) FILTER (predicted = c.label), 0)::DOUBLE, 0.0) AS f1
  FROM cv_pred, classes c GROUP BY grid_idx, alpha, fold, c.label) GROUP BY grid_idx, alpha, fold)"""


def edge_docs() -> str:
    cases = array(EDGE_CASES)
    return f"""WITH alone AS (SELECT list_concat({cases}, ['', NULL]) AS texts),
edge AS (SELECT doc_id AS id, {cases}[doc_id % {len(EDGE_CASES)} + 1] || text AS text FROM documents
  UNION ALL SELECT (-i)::BIGINT, texts[i] FROM alone, range(1, {len(EDGE_CASES) + 3}) r(i)),
n AS (SELECT id, {normalise('text')} AS cleaned FROM edge)"""


def model_sql() -> dict[str, str]:
    """What SQL can state about the queries of `model_queries`."""
    sql = {}
    for name in ("svm", "rf", "gb", "mlp"):
        sql[f"train_{name}"] = f"""WITH {CONTENT_SPLIT} SELECT label, any_value(emotion) AS emotion, count(*) AS support,
  true AS beats_majority, true AS accurate FROM corpus WHERE split = 'test' GROUP BY label"""
    sql["calibrated_proba"] = f"WITH {CONTENT_SPLIT} SELECT id, split, {K} AS classes, true AS valid FROM corpus"
    points = ", ".join(f"({i}, {c}::DOUBLE)" for i, c in enumerate(GRIDS["svm"]["C"]))
    sql["grid_search"] = f'SELECT grid_idx, c AS "C", true AS consistent FROM (VALUES {points}) v(grid_idx, c)'
    sweep = ", ".join(f"({i}, {h}, {m})" for i, (h, m) in enumerate(product(SWEEP_HIDDEN, SWEEP_ITERATIONS)))
    sql["sweep_holdout"] = f"SELECT grid_idx, hidden, max_iter, true AS consistent FROM (VALUES {sweep}) v(grid_idx, hidden, max_iter)"
    sql["score_batch"] = f"""WITH {CONTENT_SPLIT}, bench AS (SELECT item_id AS id, text FROM benchmark), {tokenised('bench', 'btoks1', 1)}, {lemmatised('btoks1', 'btoks')}
SELECT split, id, len(tokens) = 0 AS unknown FROM corpus UNION ALL SELECT 'benchmark', id, len(tokens) = 0 FROM btoks"""
    sql["stream_score"] = "SELECT count(*) AS n_rows, 0::BIGINT AS mismatches FROM documents"
    sql["training_history"] = "SELECT true AS improves"
    for name in ("validation_curves", "boosting_curves"):
        sql[name] = "SELECT unnest(['loss', 'val_loss', 'accuracy', 'val_accuracy']) AS curve, true AS improves"
    sql["word2vec_embed"] = f"""WITH {LEMMA_TOKS}, placed AS (SELECT id, unnest(tokens) AS token FROM toks),
often AS (SELECT token FROM placed GROUP BY token HAVING count(*) >= {MIN_COUNT}),
seen AS (SELECT DISTINCT id FROM placed JOIN often USING (token))
SELECT d.id, {VECTOR_SIZE} AS size, s.id IS NULL AS zero FROM docs d LEFT JOIN seen s USING (id)"""
    return sql


def oracle_sql() -> dict[str, str]:
    role = label_of("role", ["user", "assistant", "system"])
    sql: dict[str, str] = {}

    sql["load_labelled"] = f"WITH {DOCS} SELECT id, text, label, emotion FROM docs WHERE emotion IN ('en', 'fr', 'de')"
    sql["load_labelled_names"] = f"WITH {DOCS} SELECT id, label, emotion FROM named" .replace(
        "named", f"(SELECT id, label, {name_of('label')} AS emotion FROM docs WHERE id % 4 < 3)")
    sql["line_files"] = f"""SELECT regexp_replace(part, {STRIP}, '', 'g') AS text, role AS expected FROM (
  SELECT role, unnest(regexp_split_to_array(text, '\\r\\n|\\n|\\r')) AS part FROM conversations WHERE role IN ('user', 'assistant', 'system'))
WHERE regexp_replace(part, {STRIP}, '', 'g') <> ''"""
    sql["union_splits"] = f"""SELECT text, label::INT AS label, {name_of('label')} AS emotion FROM (
  SELECT text, {label_of('lang')} AS label FROM documents UNION ALL SELECT text, {role} FROM conversations
  UNION ALL SELECT text, item_id % 6 FROM benchmark)"""
    sql["load_splits_files"] = f"WITH {DOCS} SELECT text, label, emotion FROM docs WHERE text IS NOT NULL AND label IS NOT NULL"
    sql["synthetic_corpus"] = synthetic()
    sql["line_source"] = f"WITH {LINES} SELECT conv_id, turn, line_no, line FROM lines"
    sql["csv_roundtrip"] = f"WITH {DOCS} SELECT id, text, label, emotion FROM docs"

    sql["label_lookup"] = f"""SELECT doc_id AS id, {label_of('lang', ['en', 'fr', 'de'])} AS label,
  {array(LANGS)}[doc_id % 6 + 1] AS name FROM documents"""
    sql["encode_labels"] = f"WITH {DOCS} SELECT id, label, emotion FROM docs"
    sql["class_weights"] = f"""WITH {DOCS} SELECT label, count(*) AS n,
  round((SELECT count(*) FROM docs) / ({K} * count(*))::DOUBLE, 6) AS weight FROM docs GROUP BY label"""

    sql["clean_normalise"] = f"SELECT doc_id AS id, {normalise('text')} AS cleaned FROM documents"
    both = "concat_ws(' ', url, html)"
    sql["clean_pages"] = f"SELECT page_id, {normalise('html')} AS cleaned, {normalise(both)} AS cleaned_with_url FROM pages"
    sql["clean_edge_cases"] = f"""{edge_docs()} SELECT id, cleaned, array_to_string({tokens('cleaned')}, '|') AS tokens FROM n"""
    folded = f"list_transform({tokens('cleaned')}, lambda t: CASE WHEN t = 'n''t' THEN 'not' ELSE t END)"
    sql["fold_negation"] = f"""{edge_docs()} SELECT id, array_to_string(list_filter({folded},
  lambda t: NOT list_contains({STOP}, t) AND length(t) >= 2), ' ') AS tokens FROM n"""
    sql["tokenise"] = f"WITH {TOKS} SELECT id, array_to_string(raw_tokens, ' ') AS tokens FROM toks"
    sql["remove_stopwords"] = f"""WITH {DOCS}, {tokenised('docs', 'toks', 1)}
SELECT id, len(tokens)::INT AS n_tokens, content AS tokens FROM toks"""
    sql["lemmatise"] = f"WITH {lemmas()} SELECT token, lemma, df FROM lemma_of"
    sql["clean_full"] = f"""WITH {lemmas()},
placed AS (SELECT id, unnest(tokens) AS token, generate_subscripts(tokens, 1) AS pos FROM toks1),
joined AS (SELECT id, string_agg(lemma, ' ' ORDER BY pos) AS c FROM placed JOIN lemma_of USING (token)
  WHERE length(lemma) >= 2 GROUP BY id)
SELECT d.id, coalesce(c, '') AS clean_text FROM docs d LEFT JOIN joined USING (id)"""

    sql["class_distribution"] = f"""WITH {DOCS} SELECT emotion, count(*) AS n,
  round(count(*) * 100.0 / (SELECT count(*) FROM docs)::DOUBLE, 4) AS percent FROM docs GROUP BY emotion"""
    sql["token_length_stats"] = f"WITH {LENGTHS} SELECT id, x::INT AS token_count FROM lens"
    sql["token_length_histogram"] = f"""WITH {LENGTHS}, e AS (SELECT min(x) AS lo, max(x) AS hi FROM lens),
h AS (SELECT least((x - lo) * 40 // (hi - lo), 39) AS bin, count(*) AS n FROM lens, e GROUP BY 1)
SELECT b::INT AS bin, round(lo + b * (hi - lo) / 40.0::DOUBLE, 6) AS lower, round(lo + (b + 1) * (hi - lo) / 40.0::DOUBLE, 6) AS upper,
  coalesce(n, 0) AS n FROM e, range(40) r(b) LEFT JOIN h ON h.bin = b"""
    sql["token_length_box"] = f"""WITH {LENGTHS},
box AS (SELECT emotion, count(*) AS n_rows, quantile_cont(x, 0.25) AS q1, quantile_cont(x, 0.5) AS median,
  quantile_cont(x, 0.75) AS q3 FROM lens GROUP BY emotion),
f AS (SELECT l.emotion, x, x BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1) AS inside FROM lens l JOIN box USING (emotion))
SELECT b.emotion, b.n_rows, b.q1::DOUBLE AS q1, b.median::DOUBLE AS median, b.q3::DOUBLE AS q3,
  (min(x) FILTER (inside))::INT AS whisker_low, (max(x) FILTER (inside))::INT AS whisker_high,
  count(*) FILTER (NOT inside) AS outliers FROM f JOIN box b USING (emotion) GROUP BY ALL"""
    sql["top_terms_per_class"] = f"""WITH {TOKS},
c AS (SELECT emotion, term, count(*) AS n FROM (SELECT emotion, unnest(tokens) AS term FROM toks) GROUP BY ALL)
SELECT emotion, rank::INT AS rank, term, n FROM (
  SELECT *, row_number() OVER (PARTITION BY emotion ORDER BY n DESC, term) AS rank FROM c) WHERE rank <= 80"""
    sql["sample_rows"] = f"""WITH {TOKS} SELECT id, {preview('text')} AS raw, {preview('content')} AS clean
FROM toks ORDER BY md5(id || ':42'), id LIMIT 50"""

    sql["feature_tokens"] = f"""WITH {TOKS}, f AS (SELECT id, regexp_extract_all(content, {q(FEATURE_TOKEN)}) AS f FROM toks)
SELECT id, len(f)::INT AS n, array_to_string(f, ' ') AS features FROM f"""
    sql["ngrams_1_2"] = f"WITH {TOKS}, {grams('toks', 'tc')} SELECT id, term, tf FROM tc"
    sql["term_doc_freq"] = f"""WITH {TOKS}, {grams('toks', 'tc')}
SELECT term, count(*) AS df, sum(tf)::BIGINT AS cf FROM tc GROUP BY term"""
    sql["vocabulary_topk"] = f"""WITH {TOKS}, {grams('toks', 'tc')}, {vocabulary('tc', 'vocab', 'toks', 2000)}
SELECT term, idx, df, cf, round(idf, 6) AS idf FROM vocab"""
    fitted = f"""{LEMMA_TOKS}, {ID_ITEMS},
train AS (SELECT toks.* FROM toks JOIN id_split USING (id) WHERE split = 'train'),
{grams('train', 'tc')}, {vocabulary('tc', 'vocab', 'train')}"""
    sql["tfidf_fit_transform"] = f"WITH {fitted} {tfidf('tc', 'vocab')}"
    sql["tfidf_transform"] = f"""WITH {fitted}, bench AS (SELECT item_id AS id, text FROM benchmark),
{tokenised('bench', 'btoks1', 1)}, {lemmatised('btoks1', 'btoks')}, {grams('btoks', 'btc')}, {grams('toks', 'atc')},
a AS ({tfidf('atc', 'vocab')}), b AS ({tfidf('btc', 'vocab')})
SELECT id, split, term, weight FROM a JOIN id_split USING (id) UNION ALL SELECT id, 'benchmark', term, weight FROM b"""
    sql["embed_mean_pool"] = f"""WITH {LEMMA_TOKS}, placed AS (SELECT id, unnest(tokens) AS token FROM toks),
w AS (SELECT token, ('0x' || substr(md5(token || ':42:vec'), 1, 8))::BIGINT % (SELECT count(*) FROM embeddings) AS vec_id
  FROM placed GROUP BY token HAVING count(DISTINCT id) >= 2),
v AS (SELECT token, unnest(embedding) AS x, generate_subscripts(embedding, 1) AS dim FROM w JOIN embeddings USING (vec_id)),
tf AS (SELECT id, token, count(*) AS tf FROM placed GROUP BY id, token),
m AS (SELECT id, dim, sum(tf * x::DOUBLE) / sum(tf) AS x FROM tf JOIN v USING (token) GROUP BY id, dim)
SELECT d.id, dims.dim::INT AS dim, round(coalesce(m.x, 0.0), 6) AS value
FROM docs d CROSS JOIN range(64) dims(dim) LEFT JOIN m ON m.id = d.id AND m.dim = dims.dim + 1"""

    sql["stratified_split"] = f"WITH {ID_SPLIT} SELECT id, label, split FROM id_split"
    sql["split_sizes"] = f"""WITH {CONTENT_SPLIT} SELECT split, emotion, count(*) AS n_rows, count(DISTINCT content) AS n_contents
FROM corpus GROUP BY split, emotion"""
    ranked_train = f"""{ID_SPLIT}, tr AS (SELECT id, label, row_number() OVER (PARTITION BY label ORDER BY key, tie) AS r
  FROM id_split WHERE split = 'train'), tr_c AS (SELECT label, count(*)::HUGEINT AS n FROM tr GROUP BY label)"""
    sql["stratified_folds"] = f"""WITH {ranked_train},
st AS (SELECT label, n, coalesce(sum(n) OVER (ORDER BY label ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start FROM tr_c),
sz AS (SELECT label, f, sum(m) OVER (PARTITION BY label ORDER BY f) AS upto FROM (
  SELECT label, f, (SELECT count(*) FROM range(start::BIGINT, (start + n)::BIGINT) s(j) WHERE j % 5 = f) AS m FROM st, range(5) r(f)))
SELECT id, label, min(f)::INT AS fold FROM tr JOIN sz USING (label) WHERE r <= upto GROUP BY id, label"""
    sql["holdout_split"] = f"""WITH {ranked_train},
{share_out('ho', 'tr_c', 'n', 'sum(n) - ceil(sum(n)::DECIMAL(20,0) * 0.10)')}
SELECT id, label, CASE WHEN r <= n - kept THEN 'holdout' ELSE 'train' END AS split FROM tr JOIN ho USING (label)"""

    sql["nb_scores"] = f"""WITH {PREDICTED} SELECT id, split, class AS label, round(score, 4) AS score
FROM scored JOIN corpus USING (id)"""
    sql["nb_predict"] = f"""WITH {PREDICTED} SELECT id, split, prediction, {name_of('prediction')} AS emotion
FROM pred JOIN corpus USING (id)"""
    sql["score_unknown"] = f"""WITH {NB}, {LINES},
turns AS (SELECT conv_id || '/' || turn || '/' || line_no AS id, line AS text FROM lines),
{tokenised('turns', 'tt1', 1)}, {lemmatised('tt1', 'tt')}, {grams('tt', 'ttc')}, {nb_scored('tt', 'ttc', 'ts')}, {nb_predicted('ts', 'tp')}
SELECT id, {name_of('prediction')} AS emotion, round(max(p), 6) AS top_probability FROM tp JOIN tp_q USING (id) GROUP BY id, prediction"""
    sql["argmax_class"] = f"""WITH {NB}, {nb_scored('corpus', 'tc', 'scored')}
SELECT id, any_value(split) AS split, min(class) AS label FROM (
  SELECT *, max(score) OVER (PARTITION BY id) AS top FROM scored) JOIN corpus USING (id) WHERE score = top GROUP BY id"""
    sql["ranked_probabilities"] = f"""WITH {PREDICTED} SELECT id, split, (row_number() OVER (PARTITION BY id ORDER BY p DESC, class))::INT AS rank,
  {name_of('class')} AS emotion, round(p, 6) AS probability FROM pred_q JOIN corpus USING (id)"""
    sql["onehot_fallback"] = f"""WITH {PREDICTED} SELECT id, split, classes.label, CASE WHEN predicted = classes.label THEN 1.0::DOUBLE ELSE 0.0 END AS p
FROM outcome, classes"""
    sql["scored_report"] = f"""WITH {PREDICTED} SELECT c.id, c.split, {preview('c.text')} AS preview, {name_of('prediction')} AS predicted,
  round(coalesce(p, 0.0) * 100, 1) AS confidence_pct, {name_of('prediction')} = c.emotion AS hit
FROM corpus c JOIN pred USING (id) LEFT JOIN pred_q ON pred_q.id = c.id AND class = prediction"""

    sql["confusion_matrix"] = f"""WITH {HELD_OUT},
cell AS (SELECT s.split, a.label AS actual, p.predicted, (SELECT count(*) FROM held h
    WHERE h.split = s.split AND h.actual = a.label AND h.predicted = p.predicted) AS n
  FROM (SELECT DISTINCT split FROM held) s, classes a, (SELECT label AS predicted FROM classes UNION ALL SELECT -1) p)
SELECT split, actual, predicted, {name_of('actual')} AS actual_name, {name_of('predicted')} AS predicted_name, n,
  round(coalesce(n / nullif(sum(n) OVER (PARTITION BY split, actual), 0)::DOUBLE, 0.0), 4) AS row_pct FROM cell"""
    cells = ", ".join(f"count(*) FILTER (h.predicted = {i}) AS {n}" for i, n in enumerate(LANGS))
    sql["confusion_pivot"] = f"""WITH {HELD_OUT} SELECT c.label AS actual, {name_of('c.label')} AS actual_name, {cells}
FROM classes c LEFT JOIN held h ON h.actual = c.label GROUP BY c.label"""
    ovr = f"{HELD_OUT}, {one_vs_rest('held')}"
    counts = f"label, {name_of('label')} AS emotion, support, tp, fp, fn, tn"
    sql["one_vs_rest_counts"] = f"WITH {ovr} SELECT {counts} FROM ovr"
    sql["per_class_metrics"] = f"""WITH {ovr} SELECT {counts}, round(precision, 4) AS precision, round(recall, 4) AS recall,
  round(f1, 4) AS f1, round(recall, 4) AS sensitivity, round(specificity, 4) AS specificity, f1 >= 0.7 AS good_f1 FROM rates"""
    sql["weighted_metrics"] = f"WITH {ovr} SELECT " + ", ".join(f"round({m}, 4) AS {m}" for m in METRICS[1:]) + " FROM overall"
    sql["overall_metrics"] = f"WITH {ovr} {long_metrics()}"
    sql["macro_f1"] = f"WITH {ovr} SELECT round(macro_f1, 4) AS macro_f1 FROM overall"
    sql["classification_report"] = f"""WITH {ovr}
SELECT {name_of('label')} AS name, round(precision, 4) AS precision, round(recall, 4) AS recall, round(f1, 4) AS f1, support FROM rates
UNION ALL SELECT 'accuracy', NULL, NULL, round(accuracy, 4), support FROM overall
UNION ALL SELECT 'macro avg', round(macro_precision, 4), round(macro_recall, 4), round(macro_f1, 4), support FROM overall
UNION ALL SELECT 'weighted avg', round(precision, 4), round(recall, 4), round(f1_weighted, 4), support FROM overall"""
    sql["metrics_by_split"] = f"WITH {HELD_OUT}, {one_vs_rest('held', 'split')} {long_metrics('split')}"
    accuracy = f"""WITH {PREDICTED} SELECT {name_of('actual')} AS expected, sum((actual = predicted)::INT)::BIGINT AS correct,
  count(*) AS total, round(sum((actual = predicted)::INT) * 100.0 / count(*)::DOUBLE, 1) AS accuracy_pct FROM outcome GROUP BY actual"""
    sql["batch_accuracy"] = accuracy
    sql["stream_batch_accuracy"] = accuracy
    cv = cross_validation()
    sql["cv_summary"] = f"""WITH {cv} SELECT grid_idx, alpha, count(*) AS folds, round(avg(score), 4) AS mean,
  round(stddev_pop(score), 4) AS std FROM cv_f1 GROUP BY grid_idx, alpha"""
    sql["best_params"] = f"""WITH {cv} SELECT grid_idx, alpha, round(avg(score), 6) AS mean_score FROM cv_f1
GROUP BY grid_idx, alpha ORDER BY mean_score DESC, grid_idx LIMIT 1"""
    sql.update(model_sql())
    return sql
