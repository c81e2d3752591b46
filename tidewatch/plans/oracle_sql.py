"""DuckDB SQL twins of the registered queries (tables are pre-registered views).

Bindings are spelled out in each statement so the oracle is independent of
the Spark code.
"""

from __future__ import annotations

from tidewatch import constants as C

COUNTER_DAY = "DATE '2024-01-30'"

_FACT = """
fact AS (
  SELECT CAST(ts AS DATE) AS date, CAST(user_id AS VARCHAR) AS key,
         round(sum(value), 2) AS value, min(event_id) AS pos
  FROM events GROUP BY 1, 2
)"""


def _growth(days: int) -> str:
    return f"""
WITH {_FACT},
win AS (
  SELECT * FROM fact
  WHERE date >= {COUNTER_DAY} - {days} AND date <= {COUNTER_DAY} AND key IS NOT NULL AND key <> ''
),
st AS (
  SELECT key,
         arg_max(value, pos) FILTER (WHERE date = {COUNTER_DAY}) AS value,
         max(value) FILTER (WHERE date < {COUNTER_DAY}) AS prev_max,
         min(pos) FILTER (WHERE date = {COUNTER_DAY}) AS pos,
         count(*) FILTER (WHERE date = {COUNTER_DAY}) AS today_rows
  FROM win GROUP BY key
),
growth AS (
  SELECT key, value, prev_max,
         CASE WHEN prev_max > 0 THEN round((value - prev_max) / prev_max, 3) END AS growth_pct,
         prev_max IS NULL AS is_new, pos
  FROM st WHERE today_rows > 0 AND value IS NOT NULL
)"""


SQL: dict[str, str] = {}

SQL["counter_growth"] = _growth(30) + "\nSELECT * FROM growth"
SQL["top_growth"] = _growth(30) + """
SELECT * FROM growth WHERE growth_pct IS NOT NULL ORDER BY growth_pct DESC, pos, key LIMIT 10"""
SQL["new_entities"] = _growth(1) + """
SELECT * FROM growth WHERE is_new ORDER BY pos, key LIMIT 10"""
SQL["top_values"] = _growth(30) + """
SELECT * FROM growth ORDER BY value DESC, pos, key LIMIT 10"""
SQL["counter_totals"] = _growth(30) + f"""
SELECT round(sum(value), 2) AS total, count(*) AS key_count,
       (SELECT count(DISTINCT date) FROM fact
         WHERE date >= {COUNTER_DAY} - 30 AND date < {COUNTER_DAY}) AS history_days
FROM growth"""


def _kw(days: int, tail: str) -> str:
    D = COUNTER_DAY
    return f"""
WITH kwd AS (
  SELECT DISTINCT CAST(ts AS DATE) AS date, CAST(user_id AS VARCHAR) || ':' || event_type AS kw
  FROM events WHERE CAST(ts AS DATE) BETWEEN {D} - {days} AND {D}
),
recs AS (
  SELECT date, row_number() OVER (ORDER BY date DESC) AS rn
  FROM (SELECT DISTINCT date FROM kwd WHERE date < {D}) t
),
n AS (SELECT count(*) AS n_hist, least(count(*), 5) AS n_recent, greatest(count(*) - 5, 0) AS n_older FROM recs),
m AS (
  SELECT k.kw, bool_or(k.date = {D}) AS today, count(r.rn) AS df,
         count(*) FILTER (WHERE r.rn <= 5) AS recent_count,
         count(*) FILTER (WHERE r.rn > 5) AS older_count
  FROM kwd k LEFT JOIN recs r USING (date) GROUP BY k.kw
),
c AS (
  SELECT m.*, recent_count / greatest(n_recent, 1) AS recent_rate,
         CASE WHEN n_older > 0 THEN older_count / n_older ELSE 0.0 END AS older_rate
  FROM m, n
),
k AS (
  SELECT *, CASE WHEN today AND df = 0 THEN 'new'
                 WHEN today AND recent_rate > older_rate + 0.2 THEN 'rising'
                 WHEN NOT today AND df >= 3 AND recent_count = 0 THEN 'fading' END AS kind
  FROM c
),
trends AS (
  SELECT kind, kw, df, round(recent_rate, 6) AS recent_rate, round(older_rate, 6) AS older_rate
  FROM k WHERE kind IS NOT NULL AND EXISTS (SELECT 1 FROM kwd WHERE date = {D})
)
{tail}"""


SQL["keyword_trends"] = _kw(30, "SELECT * FROM trends")
SQL["keyword_trends_7"] = _kw(7, "SELECT * FROM trends")
_KW_LISTS = """SELECT kind, rank, kw FROM (
  SELECT kind, kw, row_number() OVER (PARTITION BY kind ORDER BY kw) AS rank FROM trends) t
WHERE rank <= 10"""
SQL["keyword_lists"] = _kw(30, _KW_LISTS)
SQL["keyword_lists_5"] = _kw(5, _KW_LISTS)

SQL["stream_keyword_trends"] = """
WITH kwd AS (SELECT DISTINCT CAST(ts AS DATE) AS date, CAST(user_id AS VARCHAR) || ':' || event_type AS kw FROM events),
days AS (SELECT DISTINCT date AS day FROM kwd WHERE kw IS NOT NULL AND date IS NOT NULL),
recs AS (SELECT q.day, r.day AS date, row_number() OVER (PARTITION BY q.day ORDER BY r.day DESC) AS rn
  FROM days q JOIN days r ON r.day >= q.day - 30 AND r.day < q.day),
n AS (SELECT q.day, least(count(r.rn), 5) AS n_recent, greatest(count(r.rn) - 5, 0) AS n_older FROM days q LEFT JOIN recs r USING (day) GROUP BY q.day),
m AS (
  SELECT q.day, k.kw, bool_or(k.date = q.day) AS today, count(r.rn) AS df,
         count(*) FILTER (WHERE r.rn <= 5) AS recent_count, count(*) FILTER (WHERE r.rn > 5) AS older_count
  FROM days q JOIN kwd k ON k.date BETWEEN q.day - 30 AND q.day LEFT JOIN recs r ON r.day = q.day AND r.date = k.date
  WHERE k.kw IS NOT NULL GROUP BY q.day, k.kw),
c AS (SELECT m.*, recent_count / greatest(n_recent, 1) AS recent_rate,
             CASE WHEN n_older > 0 THEN older_count / n_older ELSE 0.0 END AS older_rate FROM m JOIN n USING (day))
SELECT day AS date, kind, kw, df, round(recent_rate, 6) AS recent_rate, round(older_rate, 6) AS older_rate FROM (
  SELECT *, CASE WHEN today AND df = 0 THEN 'new' WHEN today AND recent_rate > older_rate + 0.2 THEN 'rising'
                 WHEN NOT today AND df >= 3 AND recent_count = 0 THEN 'fading' END AS kind FROM c) t
WHERE kind IS NOT NULL"""

_STAR_PAT = r"(?i)([\d,\.]+)\s*(k|K)?\s*stars?"

_STARS = f"""
stars AS (
  SELECT CAST(ts AS DATE) AS date, event_id AS pos,
         CASE WHEN event_type = 'error' THEN ', stars'
              WHEN cents >= 100000 THEN CAST(cents // 1000 AS VARCHAR) || '.' || CAST((cents % 1000) // 100 AS VARCHAR) || 'k stars'
              ELSE format('{{:,}}', cents) || ' stars today' END AS stars
  FROM (SELECT *, CAST(round(value * 100) AS BIGINT) AS cents FROM events) e
),
parsed AS (
  SELECT *, CASE WHEN regexp_matches(stars, '{_STAR_PAT}') THEN
      try_cast(trunc(try_cast(replace(regexp_extract(stars, '{_STAR_PAT}', 1), ',', '') AS DOUBLE)
           * CASE WHEN regexp_extract(stars, '{_STAR_PAT}', 2) <> '' THEN 1000.0 ELSE 1.0 END) AS BIGINT)
    END AS parsed
  FROM stars
)"""

SQL["star_parse"] = f"""WITH {_STARS}
SELECT pos, stars, parsed, coalesce(parsed, 0) AS parsed_or_zero FROM parsed"""

_SERIES = f"""WITH {_STARS},
series AS (
  SELECT 'stars' AS metric, date, CAST(sum(coalesce(parsed, 0)) AS DOUBLE) AS value FROM parsed
  WHERE date > {COUNTER_DAY} - 30 AND date <= {COUNTER_DAY} GROUP BY date
  UNION ALL
  SELECT 'downloads' AS metric, CAST(ts AS DATE) AS date, round(sum(value), 2) AS value FROM events
  WHERE CAST(ts AS DATE) > {COUNTER_DAY} - 30 AND CAST(ts AS DATE) <= {COUNTER_DAY} GROUP BY 2
)"""
TEXT_DAY = "DATE '2024-01-31'"
_DAY_TEXTS = """
day_texts AS (
  SELECT CAST(DATE '2024-01-01' + CAST(doc_id % 31 AS INTEGER) AS DATE) AS date, lang AS scope, text
  FROM documents
)"""
SQL["history_window"] = f"""WITH {_DAY_TEXTS}
SELECT date, count(*) AS texts, CAST(sum(length(text)) AS BIGINT) AS chars FROM day_texts
WHERE date >= {TEXT_DAY} - 30 AND date < {TEXT_DAY} GROUP BY date"""
SQL["chart_window"] = f"""
SELECT CAST(ts AS DATE) AS date, count(*) AS events FROM events
WHERE CAST(ts AS DATE) > {COUNTER_DAY} - 30 AND CAST(ts AS DATE) <= {COUNTER_DAY} GROUP BY 1"""


# ---------------------------------------------------------------- text vectors (V1-V6), detectors

# white space as a literal, so that the oracle doesn't lean on the implementation
_WS = r"[\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"


def _tf_sql(days: int = 30, day: str = TEXT_DAY) -> str:
    """CTEs ``day_texts, texts, words, padded, grams, tf`` for the query window."""
    return f"""{_DAY_TEXTS},
texts AS (SELECT * FROM day_texts WHERE date >= {day} - {days} AND date <= {day}),
words AS (
  SELECT scope, date, word, count(*) AS n
  FROM (SELECT scope, date, unnest(string_split_regex(lower(text), '{_WS}+')) AS word FROM texts) t
  WHERE word <> '' GROUP BY ALL
),
padded AS (SELECT scope, date, n, ' ' || word || ' ' AS p, length(' ' || word || ' ') AS l FROM words),
grams AS (
  SELECT scope, date, n, substring(p, i, k) AS term
  FROM (SELECT scope, date, n, p, l, unnest(generate_series(1, l - 1)) AS i FROM padded) x,
       (VALUES (2), (3), (4)) ks(k)
  WHERE i + k - 1 <= l
),
tf AS (SELECT scope, date, term, CAST(sum(n) AS BIGINT) AS tf FROM grams GROUP BY ALL)"""


def _members_sql(days: int = 30, day: str = TEXT_DAY, scopes: str = "SELECT DISTINCT scope FROM day_texts") -> str:
    return f"""
trecs AS (SELECT DISTINCT date FROM day_texts WHERE date >= {day} - {days} AND date <= {day}),
scopes AS ({scopes}),
members AS (SELECT s.scope, r.date, r.date = {day} AS is_query FROM scopes s, trecs r)"""


def _sims_sql(maxf: int = 5000, tf: str = "tf", members: str = "members", key: str = "scope") -> str:
    """CTEs ``ct, sizes, stats, vocab, docs, sims`` for corpus key ``key``."""
    return f"""
ct AS (SELECT m.{key}, m.date, m.is_query, t.term, t.tf FROM {tf} t JOIN {members} m USING (scope, date)),
n_docs AS (SELECT {key}, count(*) AS n_docs FROM {members} GROUP BY {key}),
n_nb AS (SELECT {key}, count(DISTINCT date) AS n_nonblank FROM ct GROUP BY {key}),
sizes AS (
  SELECT d.{key}, n_docs, coalesce(n_nonblank, 0) AS n_nonblank
  FROM n_docs d LEFT JOIN n_nb USING ({key}) WHERE coalesce(n_nonblank, 0) >= 2
),
stats AS (
  SELECT {key}, term, CAST(sum(tf) AS BIGINT) AS ctf, count(*) AS df,
         max(CASE WHEN is_query THEN tf END) AS qtf
  FROM ct GROUP BY {key}, term
),
vocab AS (
  SELECT s.{key}, term, ctf, df, rank, ln((n_docs + 1.0) / (df + 1.0)) + 1.0 AS idf,
         coalesce(qtf, 0) * (ln((n_docs + 1.0) / (df + 1.0)) + 1.0) AS wq
  FROM (SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY ctf DESC, term) AS rank FROM stats) s
  JOIN sizes z USING ({key}) WHERE rank <= {maxf}
),
docs AS (
  SELECT ct.{key}, ct.date, ct.is_query, sum((tf * idf) * (tf * idf)) AS nn, sum((tf * idf) * wq) AS dot
  FROM ct JOIN vocab USING ({key}, term) GROUP BY ALL
),
sims AS (
  SELECT m.{key}, m.date, coalesce(d.dot / sqrt(d.nn * q.nn), 0.0) AS sim
  FROM {members} m JOIN sizes USING ({key})
  LEFT JOIN docs d ON d.{key} = m.{key} AND d.date = m.date AND NOT d.is_query
  LEFT JOIN docs q ON q.{key} = m.{key} AND q.is_query
  WHERE NOT m.is_query
)"""


_TEXT_SIMS = "WITH " + _tf_sql() + "," + _members_sql() + "," + _sims_sql()

SQL["char_ngrams"] = "WITH " + _tf_sql() + "\nSELECT * FROM tf"
SQL["vocabulary"] = _TEXT_SIMS + """
SELECT scope, term, ctf, df, round(idf, 9) AS idf, rank FROM vocab"""
SQL["tfidf_weights"] = _TEXT_SIMS + """,
w AS (SELECT ct.scope, ct.date, ct.term, tf * idf AS w FROM ct JOIN vocab USING (scope, term)),
norms AS (SELECT scope, date, sqrt(sum(w * w)) AS norm FROM w GROUP BY ALL)
SELECT scope, date, term, round(w / norm, 9) AS weight FROM w JOIN norms USING (scope, date)"""
SQL["day_similarity"] = _TEXT_SIMS + "\nSELECT scope, date, round(sim, 9) AS sim FROM sims"


def _measures_sql(spike_delta="0.15", spike_min="0.3", cont_ratio="0.6", em_max="0.25", em_mean="0.15",
                  source="sims") -> str:
    return f""",
x AS (
  SELECT scope, date, sim, least(sim, 1.0) AS s,
         row_number() OVER (PARTITION BY scope ORDER BY date DESC) AS rn,
         lag(least(sim, 1.0)) OVER (PARTITION BY scope ORDER BY date) AS prev
  FROM {source}
),
agg AS (
  SELECT scope, count(*) AS n,
         avg(sim) FILTER (WHERE rn <= 3) AS recent, avg(sim) FILTER (WHERE rn > 3) AS older,
         max(sim) AS mx, avg(sim) AS mean,
         count(*) FILTER (WHERE rn <= 6 AND prev IS NOT NULL AND s >= prev) AS inner_up
  FROM x GROUP BY scope
),
measures AS (
  SELECT scope, n AS history_days, round(recent, 3) AS recent_sim, round(older, 3) AS older_sim,
         round(mx, 3) AS max_sim, round(mean, 3) AS mean_sim,
         inner_up + 1 AS up_steps, least(n, 7) + 1 AS trend_days,
         round((inner_up + 1) / least(n, 7), 2) AS monotonic_ratio,
         coalesce(n >= 3 AND older IS NOT NULL AND recent > older + {spike_delta} AND recent > {spike_min}, false) AS spike,
         coalesce(n >= 4 AND (inner_up + 1) / least(n, 7) >= {cont_ratio}, false) AS continuous,
         coalesce(n >= 3 AND mx < {em_max} AND mean < {em_mean}, false) AS emerging,
         round(least((recent - older) / 0.3, 1.0), 2) AS spike_confidence,
         round(1.0 - mx, 2) AS novelty_score,
         recent AS recent_raw, older AS older_raw, mx AS max_raw
  FROM agg
)"""


_MEASURE_COLS = """scope, history_days, recent_sim, older_sim, max_sim, mean_sim, up_steps, trend_days,
       monotonic_ratio, spike, continuous, emerging, spike_confidence, novelty_score"""
SQL["trend_measures"] = _TEXT_SIMS + _measures_sql() + f"\nSELECT {_MEASURE_COLS} FROM measures"

_SIGNALS = """
SELECT 'sudden_spike' AS type, 0 AS type_rank, 5 AS dim_rank, scope AS dimension,
       scope || '近3天内容相似度(' || printf('%.2f', recent_raw) || ')显著高于更早期均值(' || printf('%.2f', older_raw) || ')，表明该方向话题突然增强。' AS description,
       spike_confidence AS confidence, recent_sim AS recent_similarity, older_sim AS older_similarity,
       CAST(NULL AS BIGINT) AS trend_days, CAST(NULL AS DOUBLE) AS monotonic_ratio,
       CAST(NULL AS DOUBLE) AS max_historical_similarity, CAST(NULL AS DOUBLE) AS mean_historical_similarity,
       CAST(NULL AS DOUBLE) AS novelty_score
FROM measures WHERE spike
UNION ALL
SELECT 'continuous_trend', 1, 5, scope,
       scope || '的话题向量在最近' || trend_days || '天内呈现持续增强趋势（' || up_steps || '/' || (trend_days - 1) || '天递增），表明该方向正在持续升温。',
       monotonic_ratio, NULL, NULL, trend_days, monotonic_ratio, NULL, NULL, NULL
FROM measures WHERE continuous
UNION ALL
SELECT 'emerging_topic', 2, 5, scope,
       scope || '出现全新话题（与历史最大相似度仅' || printf('%.2f', max_raw) || '），这可能是一个新兴方向的早期信号。',
       NULL, NULL, NULL, NULL, NULL, max_sim, mean_sim, novelty_score
FROM measures WHERE emerging"""
SQL["trend_signals"] = _TEXT_SIMS + _measures_sql("-1.0", "0.0", "0.5", "1.01", "1.01") + _SIGNALS

SQL["signal_order"] = f"""
SELECT row_number() OVER (ORDER BY coalesce(confidence, 0.0) DESC, dim_rank, type_rank, dimension) AS rank, type, dimension, confidence
FROM ({SQL["trend_signals"]}) s"""

SQL["overall_novelty"] = "WITH " + _tf_sql() + """,
tf_all AS (SELECT '_combined' AS scope, date, term, CAST(sum(tf) AS BIGINT) AS tf FROM tf GROUP BY date, term),""" + \
    _members_sql(scopes="SELECT '_combined' AS scope") + "," + _sims_sql(tf="tf_all") + """
SELECT scope, round(1.0 - avg(sim), 3) AS novelty, count(*) AS history_days FROM sims GROUP BY scope"""


# Every day's corpus spelled out: the documents of its window are joined to it.
_ALL_DAYS = "WITH " + _tf_sql() + """,
recs AS (SELECT DISTINCT date FROM day_texts),
every AS (SELECT s.scope, q.date AS day, r.date, r.date = q.date AS is_query
  FROM (SELECT DISTINCT scope FROM day_texts) s, recs q, recs r WHERE r.date BETWEEN q.date - 30 AND q.date),
corpora AS (SELECT scope, day, strftime(day, '%Y-%m-%d') || '/' || scope AS corpus, date, is_query FROM every),""" + \
    _sims_sql(members="corpora", key="corpus")
SQL["similarity_backfill"] = _ALL_DAYS + """
SELECT c.scope, c.day, c.date, round(sim, 9) AS sim FROM sims JOIN corpora c USING (corpus, date)"""
SQL["trend_backfill"] = _ALL_DAYS + _measures_sql(source="(SELECT corpus AS scope, date, sim FROM sims)") + """
SELECT substr(scope, 12) AS scope, CAST(substr(scope, 1, 10) AS DATE) AS day, history_days, recent_sim, older_sim, max_sim, mean_sim,
  up_steps, trend_days, monotonic_ratio, spike, continuous, emerging, spike_confidence, novelty_score FROM measures"""
SQL["vocabulary_by_state"] = SQL["vocabulary"]
SQL["rolling_vocabulary"] = "WITH " + _tf_sql() + """,
recs AS (SELECT DISTINCT date AS day FROM day_texts),
stats AS (SELECT scope, day, term, CAST(sum(tf) AS BIGINT) AS ctf, count(*) AS df
  FROM tf JOIN recs ON tf.date BETWEEN day - 30 AND day GROUP BY ALL)
SELECT scope, day, term, ctf, df FROM stats
QUALIFY row_number() OVER (PARTITION BY scope, day ORDER BY ctf DESC, term) <= 5000"""


# ---------------------------------------------------------------- ingest

_ITEMS = """
catalog AS (SELECT source, row_number() OVER (ORDER BY source) - 1 AS src_rank, 'scrape' AS method
            FROM (SELECT DISTINCT source FROM documents) s),
items AS (SELECT source, lang AS category, doc_id AS pos, text AS title,
                 substr(sha256('|' || text), 1, 16) AS aid FROM documents),
seen AS (SELECT DISTINCT substr(sha256('|' || text), 1, 16) AS aid FROM documents WHERE doc_id % 7 = 0),
fresh AS (
  SELECT source, aid, min(pos) AS pos FROM items
  WHERE aid NOT IN (SELECT aid FROM seen) GROUP BY source, aid
)"""


def _strip(x: str) -> str:
    return f"regexp_replace({x}, '^{_WS}+|{_WS}+$', '', 'g')"


SQL["item_ids"] = f"""WITH {_ITEMS}
SELECT source, pos, aid, {_strip('title')} AS title,
       substring({_strip('title')}, 1, 1000) AS summary1000 FROM items"""

# RE2 knows neither a dot without line ends here nor Unicode word ends, so both are spelled out
_REL = "(?i)(" + "|".join(t.replace(".?", r"[^\n]?").replace(r"\b", r"([^\p{L}\p{N}_]|$)") for t in C.RELEVANCE_TERMS) + ")"
SQL["relevance_filter"] = f"""
SELECT source, doc_id AS pos, lang AS category FROM documents
WHERE regexp_matches(coalesce(source, '') || ' ' || coalesce(text, ''), '{_REL}')"""

SQL["dedup_global_first"] = f"""WITH {_ITEMS},
firsts AS (
  SELECT aid, arg_min(source, src_rank * 1000000000000 + pos) AS source,
         min(src_rank * 1000000000000 + pos) AS k
  FROM fresh JOIN catalog USING (source) GROUP BY aid
),
g AS (SELECT f.aid, f.source, c.src_rank, f.k - c.src_rank * 1000000000000 AS pos FROM firsts f JOIN catalog c USING (source)),
r AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY pos, aid) AS rank FROM g)
SELECT source, src_rank, pos, aid, rank FROM r WHERE rank <= 10"""

SQL["dedup_capped_exact"] = f"""WITH RECURSIVE {_ITEMS},
ranked AS (SELECT f.*, c.src_rank, row_number() OVER (PARTITION BY f.source ORDER BY pos, aid) AS rank
           FROM fresh f JOIN catalog c USING (source)),
cands AS (SELECT src_rank, list(aid ORDER BY rank) AS aids FROM ranked GROUP BY src_rank),
fold(s, acc, new) AS (
  SELECT -1, []::VARCHAR[], []::VARCHAR[]
  UNION ALL
  SELECT f.s + 1,
         list_concat(f.acc, list_slice(list_filter(coalesce(c.aids, []::VARCHAR[]), lambda x: NOT list_contains(f.acc, x)), 1, 10)),
         list_slice(list_filter(coalesce(c.aids, []::VARCHAR[]), lambda x: NOT list_contains(f.acc, x)), 1, 10)
  FROM fold f JOIN catalog k ON k.src_rank = f.s + 1 LEFT JOIN cands c ON c.src_rank = k.src_rank
),
accepted AS (SELECT s AS src_rank, unnest(new) AS aid FROM fold WHERE s >= 0)
SELECT r.source, r.src_rank, r.pos, r.aid, r.rank FROM ranked r JOIN accepted a USING (src_rank, aid)"""

_STATS = f"""WITH RECURSIVE {_ITEMS},
ranked AS (SELECT f.*, c.src_rank, row_number() OVER (PARTITION BY f.source ORDER BY pos, aid) AS rank
           FROM fresh f JOIN catalog c USING (source)),
cands AS (SELECT src_rank, list(aid ORDER BY rank) AS aids FROM ranked GROUP BY src_rank),
fold(s, acc, new) AS (
  SELECT -1, []::VARCHAR[], []::VARCHAR[]
  UNION ALL
  SELECT f.s + 1,
         list_concat(f.acc, list_slice(list_filter(coalesce(c.aids, []::VARCHAR[]), lambda x: NOT list_contains(f.acc, x)), 1, 10)),
         list_slice(list_filter(coalesce(c.aids, []::VARCHAR[]), lambda x: NOT list_contains(f.acc, x)), 1, 10)
  FROM fold f JOIN catalog k ON k.src_rank = f.s + 1 LEFT JOIN cands c ON c.src_rank = k.src_rank
),
accepted AS (SELECT s AS src_rank, unnest(new) AS aid FROM fold WHERE s >= 0),
stats AS (
  SELECT c.source, c.method,
         CASE WHEN coalesce(f.n, 0) > 0 THEN 'ok' ELSE 'fail' END AS status,
         CAST(coalesce(f.n, 0) AS BIGINT) AS fetched, CAST(coalesce(a.n, 0) AS BIGINT) AS new,
         CAST(NULL AS DOUBLE) AS elapsed_s
  FROM catalog c
  LEFT JOIN (SELECT source, count(*) AS n FROM items GROUP BY source) f USING (source)
  LEFT JOIN (SELECT k.source, count(*) AS n FROM accepted x JOIN catalog k USING (src_rank) GROUP BY k.source) a USING (source)
)"""
SQL["ingest_stats"] = _STATS + "\nSELECT * FROM stats"
SQL["run_totals"] = _STATS + """
SELECT source, CAST(sum(fetched) AS BIGINT) AS fetched, CAST(sum(new) AS BIGINT) AS new,
       round(sum(elapsed_s), 1) AS elapsed_s,
       count(*) FILTER (WHERE status = 'ok') AS ok_count, count(*) FILTER (WHERE status = 'fail') AS fail_count
FROM stats GROUP BY ROLLUP (source)"""


# ---------------------------------------------------------------- harvest

_ANCHOR = r'(?is)<a\s[^>]*href="([^"]*)"[^>]*>(.*?)</a>'
_ORIGIN = r"^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]+)"


def _decode(x: str) -> str:
    for ent, ch in [("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "''"), ("&apos;", "''"),
                    ("&nbsp;", " "), ("&amp;", "&")]:
        x = f"replace({x}, '{ent}', '{ch}')"
    return x


def _html_text(x: str) -> str:
    return _strip(_decode(f"regexp_replace({x}, '{_WS}*<[^>]*>{_WS}*', '', 'g')"))


_ANCHORS = f"""
a0 AS (
  SELECT page_id, url, regexp_extract(url, '{_ORIGIN}', 1) AS origin,
         regexp_extract_all(html, '{_ANCHOR}', 1) AS hrefs, regexp_extract_all(html, '{_ANCHOR}', 2) AS inners
  FROM pages
),
a AS (
  SELECT page_id, origin, i AS pos, {_decode('hrefs[i]')} AS href, {_html_text('inners[i]')} AS title
  FROM (SELECT *, unnest(generate_series(1, len(hrefs))) AS i FROM a0) t
)"""

SQL["link_harvest_before"] = f"""WITH {_ANCHORS},
b AS (SELECT page_id, pos, href, title, origin || href AS url FROM a WHERE starts_with(href, '/') AND href <> '/'),
first AS (SELECT page_id, href, min(pos) AS pos, arg_min(title, pos) AS title, arg_min(url, pos) AS url
          FROM b GROUP BY page_id, href),
cand AS (SELECT * FROM first WHERE length(title) >= 3)
SELECT page_id, pos, substring(title, 1, 200) AS title, url
FROM (SELECT *, row_number() OVER (PARTITION BY page_id ORDER BY pos) AS n FROM cand) t WHERE n <= 15"""

SQL["link_harvest_after"] = f"""WITH {_ANCHORS},
b AS (SELECT page_id, pos, title, CASE WHEN starts_with(href, 'http') THEN href ELSE origin || href END AS url
      FROM a WHERE contains(href, '/') AND regexp_replace(href, '/+$', '') <> origin AND length(title) >= 3),
first AS (SELECT page_id, url, min(pos) AS pos, arg_min(title, pos) AS title FROM b GROUP BY page_id, url)
SELECT page_id, pos, substring(title, 1, 200) AS title, url
FROM (SELECT *, row_number() OVER (PARTITION BY page_id ORDER BY pos) AS n FROM first) t WHERE n <= 15"""

_BLOCKS = f"""
b0 AS (SELECT page_id, url, regexp_extract_all(html, '(?is)<article[\\s>](.*?)</article>', 1) AS blocks FROM pages),
b AS (SELECT page_id, url, i AS pos, blocks[i] AS block FROM (SELECT *, unnest(generate_series(1, len(blocks))) AS i FROM b0) t),
items AS (
  SELECT page_id, CAST(pos AS BIGINT) AS pos, url,
         {_html_text("regexp_extract(block, '(?is)<h1(?:\\s[^>]*)?>(.*?)(?:</h1>)', 1)")} AS title,
         {_html_text("regexp_extract(block, '(?is)<p(?:\\s[^>]*)?>(.*?)(?:</p>|<p[\\s>]|$)', 1)")} AS description
  FROM b WHERE regexp_matches(block, '(?is)<h1(?:\\s[^>]*)?>.*?</h1>')
)"""
SQL["block_harvest"] = f"""WITH {_BLOCKS}
SELECT page_id, pos, title, description, substring(description, 1, 1000) AS summary FROM items"""
SQL["block_harvest_relevant"] = f"""WITH {_BLOCKS}
SELECT page_id, pos, title FROM items
WHERE regexp_matches(coalesce(title, '') || ' ' || coalesce(description, ''), '{_REL}')"""


# ---------------------------------------------------------------- text shift (M1), novelty series (M5)

def _shift_sql(day: str, tf: str = "tf", today: str = "SELECT scope, count(*) AS text_count FROM day_texts WHERE date = {day} AND length(text) > 0 GROUP BY scope") -> str:
    """CTE ``shift``: the text shift of every scope of ``tf`` or of today's texts."""
    return f""",
recs AS (SELECT DISTINCT date FROM day_texts WHERE date >= {day} - 30 AND date < {day}),
today AS ({today.format(day=day)}),
hist_nb AS (SELECT DISTINCT scope, date FROM {tf} WHERE date < {day}),
nb AS (SELECT scope, count(*) AS nonblank FROM hist_nb GROUP BY scope),
sc AS (SELECT scope, coalesce(t.text_count, 0) AS text_count, coalesce(nb.nonblank, 0) AS nonblank_history_days
       FROM today t FULL JOIN nb USING (scope)),
eligible AS (SELECT scope FROM sc WHERE text_count > 0 AND nonblank_history_days >= 3),
members AS (
  SELECT scope, date, false AS is_query FROM hist_nb WHERE scope IN (SELECT scope FROM eligible)
  UNION ALL SELECT scope, {day}, true FROM eligible
),""" + _sims_sql(tf=tf).replace("WHERE coalesce(n_nonblank, 0) >= 2", "WHERE coalesce(n_nonblank, 0) >= 1") + """,
agg AS (SELECT scope, avg(sim) AS mean_sim FROM sims GROUP BY scope),
shift AS (
SELECT sc.scope, text_count > 0 AS has_data,
       CASE WHEN text_count = 0 THEN '今日无 arXiv 摘要数据' WHEN mean_sim IS NULL THEN '历史数据不足（需至少 3 天）' END AS message,
       CASE WHEN mean_sim IS NOT NULL THEN (SELECT count(*) FROM recs)
            WHEN text_count > 0 THEN CAST(nonblank_history_days AS BIGINT) END AS history_days,
       CAST(nonblank_history_days AS BIGINT) AS nonblank_history_days, CAST(text_count AS BIGINT) AS text_count,
       round(1.0 - mean_sim, 3) AS capability_score, round(mean_sim, 3) AS mean_similarity,
       CASE WHEN mean_sim IS NULL THEN 'unknown' WHEN 1.0 - mean_sim > 0.4 THEN '跃迁'
            WHEN mean_sim > 0.5 THEN '延续' ELSE '渐进' END AS trend
FROM sc LEFT JOIN agg USING (scope))"""


SQL["text_shift"] = "WITH " + _tf_sql() + _shift_sql(TEXT_DAY) + " SELECT * FROM shift"

def _novelty_sql(tf: str = "tf", scopes: str = "SELECT DISTINCT scope FROM day_texts") -> str:
    return f""",
recs AS (SELECT DISTINCT date FROM day_texts WHERE date > {TEXT_DAY} - 30 AND date <= {TEXT_DAY}),
scopes AS ({scopes}),
spine AS (SELECT s.scope, r.date, lag(r.date) OVER (PARTITION BY s.scope ORDER BY r.date) AS prev FROM scopes s, recs r),
pairs AS (SELECT scope, date AS pair_end, prev FROM spine WHERE prev IS NOT NULL),
members AS (
  SELECT scope, scope || '|' || CAST(pair_end AS VARCHAR) AS pk, pair_end, prev AS date, false AS is_query FROM pairs
  UNION ALL
  SELECT scope, scope || '|' || CAST(pair_end AS VARCHAR), pair_end, pair_end, true FROM pairs
),""" + _sims_sql(tf=tf, maxf=3000, key="pk") + """,
novelty AS (
SELECT p.scope, p.pair_end AS date,
       CASE WHEN s.sim IS NULL THEN 0.0 ELSE round(1.0 - s.sim, 3) END AS novelty
FROM pairs p LEFT JOIN sims s ON s.pk = p.scope || '|' || CAST(p.pair_end AS VARCHAR))"""


SQL["novelty_series"] = "WITH " + _tf_sql() + _novelty_sql() + " SELECT * FROM novelty"

_ALL_SERIES = "WITH " + _tf_sql() + """,
tfc AS (SELECT '_combined' AS scope, date, term, CAST(sum(tf) AS BIGINT) AS tf FROM tf GROUP BY date, term)""" \
    + _novelty_sql("tfc", "SELECT '_combined' AS scope") + ", " + _SERIES.removeprefix("WITH ") + """,
all_series AS (SELECT metric, date, value FROM series UNION ALL SELECT 'novelty', date, novelty FROM novelty)"""
SQL["daily_series"] = _ALL_SERIES + "\nSELECT * FROM all_series"
SQL["chart_table"] = _ALL_SERIES + """
SELECT metric, date, value, strftime(date, '%m-%d') AS label,
       ((rn - 1) % greatest(1, n // 7)) = 0 AS show_tick
FROM (SELECT *, row_number() OVER (PARTITION BY metric ORDER BY date) AS rn,
             count(*) OVER (PARTITION BY metric) AS n FROM all_series) s
WHERE n >= 2"""


# ---------------------------------------------------------------- reports

def _digest(cats: str) -> str:
    return f"""
WITH items AS (
  SELECT source, coalesce(lang, 'other') AS category, doc_id AS pos, {_strip('text')} AS title,
         '' AS url, substring({_strip('text')}, 1, 1000) AS summary FROM documents
),
cats AS (SELECT * FROM (VALUES {cats}) t(category, cat_rank, label)),
listed AS (SELECT * FROM items JOIN cats USING (category)),
numbered AS (SELECT *, row_number() OVER (ORDER BY cat_rank, pos, source, title) AS idx FROM listed),
header AS (
  SELECT -1 AS section, CAST(0 AS BIGINT) AS item, line, text FROM (VALUES
    (0, '今日日期: 2024-01-31'), (1, '信息条目数: ' || (SELECT count(*) FROM items)), (2, ''),
    (3, '以下是今日新增的AI信息列表（按来源分类）：'), (4, '')) t(line, text)
),
groups AS (SELECT cat_rank, label, count(*) AS n FROM listed GROUP BY ALL),
group_lines AS (
  SELECT cat_rank AS section, CAST(0 AS BIGINT) AS item, 0 AS line, '### ' || label || '（' || n || ' 条）' AS text FROM groups
  UNION ALL SELECT cat_rank, 0, 1, '' FROM groups
),
item_lines AS (
  SELECT cat_rank AS section, idx AS item, 0 AS line, idx || '. [' || source || '] ' || title AS text FROM numbered
  UNION ALL SELECT cat_rank, idx, 1, '   URL: ' || url FROM numbered
  UNION ALL SELECT cat_rank, idx, 2, '   摘要: ' || substring(summary, 1, 400) FROM numbered WHERE summary <> ''
  UNION ALL SELECT cat_rank, idx, 3, '' FROM numbered
)
SELECT * FROM header UNION ALL SELECT * FROM group_lines UNION ALL SELECT * FROM item_lines"""


_DIGEST_CATS = "('en', 0, 'English'), ('fr', 1, 'Français'), ('de', 2, 'Deutsch')"
SQL["digest_lines"] = _digest(_DIGEST_CATS + ", ('es', 3, 'Español')")
SQL["digest_lines_partial"] = _digest(_DIGEST_CATS)

SQL["reference_list"] = f"""
WITH catalog AS (
  SELECT source, ['papers', 'company', 'opensource', 'industry'][(row_number() OVER (ORDER BY source) - 1) % 4 + 1] AS category
  FROM (SELECT DISTINCT source FROM documents) s
),
ev AS (
  SELECT CAST(DATE '2024-01-01' + CAST(doc_id % 31 AS INTEGER) AS DATE) AS date,
         coalesce(CASE lang WHEN 'en' THEN 0 WHEN 'de' THEN 1 WHEN 'fr' THEN 2 WHEN 'es' THEN 3 END, 4) AS dim_rank,
         doc_id AS pos, {_strip('text')} AS title, source, '' AS url
  FROM documents
),
cats AS (SELECT * FROM (VALUES ('papers', 0, '论文'), ('company', 1, '公司动态'), ('opensource', 2, '开源生态'),
                                ('industry', 3, '资本与行业'), ('other', 4, '其他')) t(category, cat_rank, label)),
e AS (SELECT ev.*, coalesce(c.category, 'other') AS category FROM ev LEFT JOIN catalog c USING (source)),
first AS (
  SELECT cat_rank, label, title, url, source, min(date) AS d0,
         arg_min(dim_rank, (date, dim_rank, pos)) AS r0, arg_min(pos, (date, dim_rank, pos)) AS p0
  FROM e JOIN cats USING (category) GROUP BY cat_rank, label, title, url, source
),
numbered AS (SELECT *, row_number() OVER (ORDER BY cat_rank, d0, r0, p0, title, url, source) AS item FROM first)
SELECT cat_rank AS section, CAST(0 AS BIGINT) AS item, 0 AS line, '### ' || label AS text
FROM (SELECT DISTINCT cat_rank, label FROM first) h
UNION ALL
SELECT cat_rank, item, 0, '- [' || coalesce(title, '') || '](' || coalesce(url, '') || ') — ' || coalesce(source, '') FROM numbered"""


# ---------------------------------------------------------------- streaming twins (batch equivalents)

SQL["stream_dedup"] = "SELECT DISTINCT substr(sha256('|' || text), 1, 16) AS aid FROM documents"
SQL["stream_dedup_capped"] = SQL["dedup_capped_exact"]
SQL["stream_daily"] = """
SELECT CAST(date_trunc('day', ts) AS DATE) AS date, CAST(user_id AS VARCHAR) || ':' || event_type AS kw,
       count(*) AS n, round(sum(value), 2) AS value
FROM events GROUP BY 1, 2"""


# ---------------------------------------------------------------- composite reports

_RD = COUNTER_DAY
SQL["trend_report_flat"] = _kw(30, ", " + _tf_sql(day=_RD) + f""",
tf2 AS (SELECT * FROM tf UNION ALL SELECT '_combined', date, term, CAST(sum(tf) AS BIGINT) FROM tf GROUP BY date, term),""" +
    _members_sql(day=_RD, scopes="SELECT DISTINCT scope FROM day_texts UNION SELECT '_combined'") + "," +
    _sims_sql(tf="tf2") + """,
sims_d AS (SELECT * FROM sims WHERE scope <> '_combined')""" + _measures_sql(source="sims_d") + f""",
nov AS (SELECT round(1.0 - avg(sim), 3) AS novelty FROM sims WHERE scope = '_combined'),
hist AS (SELECT count(*) AS n FROM trecs WHERE date < {_RD}),
lists AS (SELECT kind, kw, row_number() OVER (PARTITION BY kind ORDER BY kw) AS rank FROM trends)
SELECT {_RD} AS date, n >= 3 AS has_enough_history, n AS history_days,
       CASE WHEN n >= 3 THEN coalesce((SELECT novelty FROM nov), 1.0) ELSE 1.0 END AS overall_novelty,
       CASE WHEN n >= 3 THEN (SELECT count(*) FILTER (WHERE spike) + count(*) FILTER (WHERE continuous)
                                     + count(*) FILTER (WHERE emerging) FROM measures) ELSE 0 END AS signal_count,
       CASE WHEN n >= 3 THEN coalesce((SELECT string_agg(kw, ',' ORDER BY kw) FROM lists WHERE kind = 'new' AND rank <= 10), '') ELSE '' END AS new_keywords,
       CASE WHEN n >= 3 THEN coalesce((SELECT string_agg(kw, ',' ORDER BY kw) FROM lists WHERE kind = 'rising' AND rank <= 10), '') ELSE '' END AS rising_keywords,
       CASE WHEN n >= 3 THEN coalesce((SELECT string_agg(kw, ',' ORDER BY kw) FROM lists WHERE kind = 'fading' AND rank <= 10), '') ELSE '' END AS fading_keywords
FROM hist""")

_USAGE = """
usage AS (SELECT CASE WHEN role = 'assistant' THEN 'stage2' ELSE 'stage1' END AS stage, turn + 1 AS prompt_tokens,
          length(coalesce(text, '')) AS completion_tokens, turn + 1 + length(coalesce(text, '')) AS total_tokens FROM conversations)"""
SQL["run_summary"] = _STATS + f", {_USAGE}" + """
SELECT count(*) AS sources, count(*) FILTER (WHERE status = 'ok') AS ok_count,
       count(*) FILTER (WHERE status = 'fail') AS fail_count,
       CAST(coalesce(sum(fetched), 0) AS BIGINT) AS fetched, CAST(coalesce(sum(new), 0) AS BIGINT) AS new,
       round(coalesce(sum(elapsed_s), 0.0), 1) AS fetch_time_s,
       (SELECT CAST(coalesce(sum(total_tokens) FILTER (stage = 'stage1'), 0) AS BIGINT) FROM usage) AS stage1_tokens,
       (SELECT CAST(coalesce(sum(total_tokens) FILTER (stage = 'stage2'), 0) AS BIGINT) FROM usage) AS stage2_tokens,
       (SELECT CAST(coalesce(sum(total_tokens), 0) AS BIGINT) FROM usage) AS total_tokens,
       (SELECT CAST(coalesce(sum(prompt_tokens) FILTER (stage = 'stage1'), 0) AS BIGINT) FROM usage) AS stage1_prompt_tokens,
       (SELECT CAST(coalesce(sum(completion_tokens) FILTER (stage = 'stage1'), 0) AS BIGINT) FROM usage) AS stage1_completion_tokens,
       (SELECT CAST(coalesce(sum(prompt_tokens) FILTER (stage = 'stage2'), 0) AS BIGINT) FROM usage) AS stage2_prompt_tokens,
       (SELECT CAST(coalesce(sum(completion_tokens) FILTER (stage = 'stage2'), 0) AS BIGINT) FROM usage) AS stage2_completion_tokens,
       (SELECT CASE WHEN count(*) > 0 THEN 'bound' END FROM usage) AS model
FROM stats"""
SQL["token_totals"] = f"WITH {_USAGE}" + """
SELECT stage, CAST(sum(prompt_tokens) AS BIGINT) AS prompt_tokens, CAST(sum(completion_tokens) AS BIGINT) AS completion_tokens,
       CAST(sum(total_tokens) AS BIGINT) AS total_tokens FROM usage GROUP BY ROLLUP (stage)"""

SQL["metrics_report_flat"] = "WITH " + _tf_sql(day=_RD) + """,
tfc AS (SELECT '_combined' AS scope, date, term, CAST(sum(tf) AS BIGINT) AS tf FROM tf GROUP BY date, term)""" \
    + _shift_sql(_RD, "tfc", "SELECT '_combined' AS scope, count(*) AS text_count FROM day_texts WHERE date = {day} AND length(text) > 0") \
    + f""", {_STARS}, {_FACT},
sfact AS (SELECT p.date, 'u' || e.user_id || '/' || e.event_type AS key, p.parsed AS value, p.pos
          FROM parsed p JOIN events e ON e.event_id = p.pos WHERE p.date >= {_RD} - 30 AND p.date <= {_RD}),
sst AS (SELECT key, arg_max(value, pos) FILTER (WHERE date = {_RD}) AS value, max(value) FILTER (WHERE date < {_RD}) AS prev_max,
        min(pos) FILTER (WHERE date = {_RD}) AS pos FROM sfact GROUP BY key HAVING count(*) FILTER (WHERE date = {_RD}) > 0),
sg AS (SELECT *, round((value - prev_max) / prev_max, 3) AS g FROM sst WHERE value IS NOT NULL),
dst AS (SELECT key, arg_max(value, pos) FILTER (WHERE date = {_RD}) AS value, max(value) FILTER (WHERE date < {_RD}) AS prev_max,
        min(pos) FILTER (WHERE date = {_RD}) AS pos FROM fact WHERE date >= {_RD} - 30 AND date <= {_RD}
        GROUP BY key HAVING count(*) FILTER (WHERE date = {_RD}) > 0),
dg AS (SELECT *, CASE WHEN prev_max > 0 THEN round((value - prev_max) / prev_max, 3) END AS g FROM dst),
days AS (SELECT count(DISTINCT date) AS n FROM (SELECT date FROM parsed UNION ALL SELECT date FROM fact UNION ALL SELECT date FROM day_texts)
         WHERE date >= {_RD} - 30 AND date < {_RD})
SELECT {_RD} AS date, s.has_data AS papers_has_data, s.message AS papers_message, s.trend AS papers_trend, s.capability_score,
  CASE WHEN s.mean_similarity IS NOT NULL THEN (SELECT n FROM days) ELSE s.history_days END AS papers_history_days, s.text_count AS paper_count,
  (SELECT count(*) > 0 FROM sst) AS repos_has_data, (SELECT CAST(coalesce(sum(value), 0) AS BIGINT) FROM sst) AS total_stars_today,
  (SELECT count(*) FROM sst) AS repo_count,
  coalesce((SELECT string_agg(key || ':' || value || ':' || prev_max, ',' ORDER BY g DESC, pos, key) FROM
    (SELECT * FROM sg WHERE prev_max > 0 ORDER BY g DESC, pos, key LIMIT 10)), '') AS repo_growth,
  coalesce((SELECT string_agg(key, ',' ORDER BY pos, key) FROM (SELECT * FROM sg WHERE prev_max IS NULL ORDER BY pos, key LIMIT 10)), '') AS new_repos,
  (SELECT n FROM days) AS repos_history_days,
  (SELECT count(*) > 0 FROM dst) AS models_has_data, (SELECT round(sum(value), 2) FROM dst) AS total_downloads, (SELECT count(*) FROM dst) AS model_count,
  (SELECT string_agg(key, ',' ORDER BY value DESC, pos, key) FROM (SELECT * FROM dg ORDER BY value DESC, pos, key LIMIT 10)) AS top_models,
  (SELECT string_agg(key, ',' ORDER BY g DESC, pos, key) FROM (SELECT * FROM dg WHERE g IS NOT NULL ORDER BY g DESC, pos, key LIMIT 10)) AS model_growth,
  (SELECT n FROM days) AS models_history_days
FROM shift s"""


# ---------------------------------------------------------------- orders by month

_ORDER_GROWTH = """
WITH fact AS (
  SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS date, CAST(o_custkey AS VARCHAR) AS key,
         round(sum(o_totalprice), 2) AS value, min(o_orderkey) AS pos
  FROM orders GROUP BY 1, 2
),
win AS (SELECT * FROM fact WHERE date >= DATE '2001-07-01' - 365 AND date <= DATE '2001-07-01'),
st AS (
  SELECT key, arg_max(value, pos) FILTER (WHERE date = DATE '2001-07-01') AS value,
         max(value) FILTER (WHERE date < DATE '2001-07-01') AS prev_max,
         min(pos) FILTER (WHERE date = DATE '2001-07-01') AS pos,
         count(*) FILTER (WHERE date = DATE '2001-07-01') AS today_rows
  FROM win GROUP BY key
),
growth AS (
  SELECT key, value, prev_max,
         CASE WHEN prev_max > 0 THEN round((value - prev_max) / prev_max, 3) END AS growth_pct,
         prev_max IS NULL AS is_new, pos
  FROM st WHERE today_rows > 0 AND value IS NOT NULL
)"""
SQL["order_growth"] = _ORDER_GROWTH + "\nSELECT * FROM growth"
SQL["order_top_growth"] = _ORDER_GROWTH + "\nSELECT * FROM growth WHERE growth_pct IS NOT NULL ORDER BY growth_pct DESC, pos, key LIMIT 10"


# ---------------------------------------------------------------- documents, feeds and lists bound to the documents table

_TEXT = "coalesce(text, '')"
SQL["document_texts"] = f"""
WITH d AS (SELECT doc_id AS pos, coalesce(text, '') AS t, coalesce(source, '') AS s, coalesce(lang, '') AS l, n_chars FROM documents WHERE lang IS NOT NULL AND lang <> 'es'),
parts AS (SELECT *, concat_ws(' ', nullif(t, ''), nullif(s, ''), l, '') AS technology, nullif(concat_ws(' ', nullif(t, '')), '') AS extra FROM d),
texts AS (
  SELECT pos, 'technology' AS scope, technology AS text FROM parts
  UNION ALL SELECT pos, 'risk', concat_ws(' ', nullif(s, ''), nullif(l, '')) FROM parts
  UNION ALL SELECT pos, unnest(['infrastructure', 'application', 'capital']), '' FROM parts
  UNION ALL SELECT pos, 'weather', coalesce(extra, '') FROM parts
  UNION ALL SELECT pos, '_combined', s || ' ' || l || ' ' || technology || '    ' || concat_ws(' ', nullif(s, ''), nullif(l, '')) FROM parts)
SELECT pos, scope, length(text)::BIGINT AS chars, md5(text) AS digest FROM texts"""
SQL["document_keywords"] = """
SELECT doc_id AS pos, DATE '2024-01-01' + CAST(doc_id % 31 AS INTEGER) AS date, lang AS kw FROM documents WHERE lang <> 'es'"""
SQL["repo_names"] = """
SELECT pos, path, replace(path, '/', ' / ') AS name
FROM (SELECT doc_id AS pos, trim('//' || coalesce(source, '') || '/' || coalesce(lang, '') || '/', '/') AS path FROM documents) t"""
SQL["document_rejects"] = """
SELECT doc_id AS pos, CASE WHEN lang = 'es' THEN 'no date' ELSE 'not a JSON object' END AS reason
FROM documents WHERE lang IS NULL OR lang = 'es'"""
SQL["list_harvest"] = """
SELECT source, 'org/' || doc_id AS title, 'https://huggingface.co/org/' || doc_id AS url,
  CASE WHEN coalesce(lang, '') <> '' THEN 'Pipeline: ' || lang || '  |  ' ELSE '' END
    || 'Downloads: ' || format('{:,}', n_chars) || '  |  Likes: ' || format('{:,}', doc_id) AS summary,
  n_chars AS downloads, doc_id AS likes
FROM documents"""
SQL["feed_harvest"] = f"""
SELECT source, 'papers' AS category, {_strip(_TEXT)} AS title, 'https://feed.example/' || doc_id AS url,
  substring({_strip(_TEXT)}, 1, 1000) AS summary, '2024-01-01' AS published, 2::BIGINT AS pos
FROM documents WHERE {_strip(_TEXT)} <> ''"""
