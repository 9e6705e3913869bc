"""Check SQL of the operators that SQL can express (DuckDB)."""

from __future__ import annotations

from fathomline.llm import decontaminate, mixing, quality_rules

# Largest k whose exact binomial tail is at most the level, -1 without one.
_ALLOWED = f"""(SELECT coalesce(max(j), -1) FROM (SELECT j, sum(exp(lgamma(n + 1) - CASE WHEN j > 0 THEN lgamma(j + 1) ELSE 0 END - lgamma(n - j + 1)
  + j * ln({quality_rules.RISK!r}) + (n - j) * ln(1 - {quality_rules.RISK!r}))) OVER (ORDER BY j) AS tail FROM (SELECT unnest(range(0, floor(n * {quality_rules.RISK!r})::BIGINT + 1)) AS j)) WHERE tail <= level)"""

QUALITY_RULES = rf"""
WITH w AS (
  SELECT doc_id, coalesce(lang, 'und') AS stratum, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
win AS (SELECT doc_id, generate_subscripts(w, 1) AS i, w FROM w),
tri AS (SELECT doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g FROM win WHERE i + 2 <= len(w)),
twice AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS n FROM tri) WHERE n > 1),
rep AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM twice) GROUP BY doc_id),
ln AS (SELECT doc_id, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l FROM w),
f AS (
  SELECT w.doc_id, stratum, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
         length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g'))::BIGINT AS n_symbols,
         length(regexp_replace(t, '\P{{Lu}}+', '', 'g'))::BIGINT AS n_upper,
         len(l)::BIGINT AS n_lines, (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines,
         coalesce(rep.n, 0)::BIGINT AS n_repeat_words
  FROM w JOIN ln USING (doc_id) LEFT JOIN rep USING (doc_id)),
r AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
         CASE WHEN n_words > 0 THEN n_symbols / n_words ELSE 0.0 END AS symbol_rate,
         CASE WHEN word_chars > 0 THEN n_upper / word_chars ELSE 0.0 END AS upper_rate,
         CASE WHEN n_lines > 0 THEN n_dup_lines / n_lines ELSE 0.0 END AS dup_line_rate,
         CASE WHEN n_words > 0 THEN n_repeat_words / n_words ELSE 0.0 END AS repeat_rate FROM f),
sc AS (SELECT *, greatest({", ".join(f"{rate} / {unit!r}" for rate, unit in quality_rules.UNITS.items())}) AS score FROM r),
good AS (SELECT sc.* FROM sc SEMI JOIN (SELECT doc_id FROM labels GROUP BY doc_id HAVING min(quality) = 1) USING (doc_id) WHERE NOT base_failed),
n1 AS (SELECT stratum, count(*) AS n FROM good GROUP BY stratum),
lv AS (SELECT {quality_rules.ERROR!r} / (count(*) + 1) AS level FROM n1),
k1 AS (SELECT stratum, n, {_ALLOWED} AS k FROM n1, lv),
grp AS (SELECT stratum, CASE WHEN k >= 0 THEN stratum END AS g FROM k1),
n2 AS (SELECT g, sum(n)::BIGINT AS n FROM grp JOIN n1 USING (stratum) GROUP BY g),
k2 AS (SELECT g, {_ALLOWED} AS k FROM n2, lv),
rk AS (SELECT g, score, row_number() OVER (PARTITION BY g ORDER BY score DESC) AS place FROM good JOIN grp USING (stratum)),
cuts AS (SELECT rk.g, score AS cut FROM rk JOIN k2 ON rk.g IS NOT DISTINCT FROM k2.g AND place = k + 1 AND k >= 0)
SELECT sc.doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND coalesce(score <= cut, true) AS kept
FROM sc LEFT JOIN grp USING (stratum) LEFT JOIN cuts ON cuts.g IS NOT DISTINCT FROM grp.g
"""

_K = decontaminate.WIDTH


def _sets(table: str, key: str) -> str:
    return f"""SELECT DISTINCT {key}, g FROM (
    SELECT {key}, CASE WHEN len(w) <= {_K} THEN [array_to_string(w, ' ')]
           ELSE list_transform(range(1, len(w) - {_K} + 2), lambda i: array_to_string(w[i:i + {_K - 1}], ' ')) END AS gs
    FROM (SELECT {key}, regexp_extract_all(lower(text), '[\\p{{L}}\\p{{N}}]+') AS w FROM {table} WHERE text IS NOT NULL) WHERE len(w) > 0), unnest(gs) AS u(g)"""


DECONTAMINATION = f"""
WITH d AS ({_sets("documents", "doc_id")}), i AS ({_sets("benchmark", "item_id")}),
n AS (SELECT item_id, count(*) AS n_item FROM i GROUP BY item_id),
s AS (SELECT doc_id, item_id, count(*) AS n_shared FROM d JOIN i USING (g) GROUP BY doc_id, item_id)
SELECT doc_id, item_id, n_item::BIGINT AS n_item, n_shared::BIGINT AS n_shared FROM s JOIN n USING (item_id)
WHERE n_shared >= ceil(n_item * {decontaminate.CONTAINMENT} - 1e-9)
"""

URL_RULES = r"""
WITH p AS (
  SELECT page_id, translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path FROM pages),
r(verdict, rhost, rpath) AS (VALUES ('allow', 'org', '/'), ('block', 'example.org', '/es/'), ('block', 'example.org', '/en/1'), ('allow', 'com', '/fr/'), ('block', 'com', '/de/')),
m AS (
  SELECT host, path, max({'n': length(rhost || rpath), 'b': (r.verdict = 'block')::INT, 'rule': rhost || rpath, 'v': r.verdict}) AS f
  FROM (SELECT DISTINCT host, path FROM p) q JOIN r ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath) GROUP BY host, path)
SELECT page_id, p.host, p.path, f.rule AS rule, coalesce(f.v, 'allow') AS verdict FROM p LEFT JOIN m ON p.host = m.host AND p.path = m.path
"""


def _unit(*parts: str) -> str:
    text = " || ':' || ".join(f"CAST({p} AS VARCHAR)" for p in parts)
    return f"('0x' || md5({text})[1:13])::BIGINT / 4503599627370496.0"


def mixing_sql(weights: dict[str, float], default: float, seed: int) -> str:
    weight = "CASE _source " + " ".join(f"WHEN '{k}' THEN CAST({v!r} AS DOUBLE)" for k, v in weights.items()) + f" ELSE CAST({default!r} AS DOUBLE) END" if weights else repr(default)
    return f"""
WITH s AS (SELECT coalesce(source, '') AS _source, sum(coalesce(strlen(text), 0)) AS n_bytes FROM documents GROUP BY 1),
w AS (SELECT *, CASE WHEN n_bytes > 0 THEN {weight} ELSE 0.0 END AS weight FROM s),
rates AS (SELECT _source, CASE WHEN n_bytes > 0 THEN (SELECT sum(n_bytes) FROM w)::DOUBLE * (weight / (SELECT sum(weight) FROM w)) / n_bytes::DOUBLE ELSE 0.0 END AS rate FROM w),
tables AS (
  SELECT _source, rate, k, sum(exp(-rate + k * ln(rate) - CASE WHEN k > 1 THEN lgamma(k + 1) ELSE 0 END)) OVER (PARTITION BY _source ORDER BY k) AS cdf
  FROM rates, unnest(range(0, ceil(rate + 12 * sqrt(rate) + 24)::BIGINT + 1)) AS u(k) WHERE rate > 0),
o AS (SELECT *, md5(coalesce(text, '')) AS mark, row_number() OVER (PARTITION BY doc_id, text, lang, source, n_chars) AS occurrence FROM documents),
d AS (SELECT doc_id, source, coalesce(source, '') AS _source, coalesce(strlen(text), 0)::BIGINT AS n_bytes, mark, occurrence,
             {_unit(str(seed), "coalesce(doc_id::VARCHAR, '')", "mark", "occurrence")} AS u FROM o),
n AS (SELECT d.doc_id, d.source, d.n_bytes, d.mark, d.occurrence, t.rate, count(*) FILTER (t.cdf <= d.u) AS n FROM d JOIN tables t USING (_source) GROUP BY ALL)
SELECT doc_id, source, round(rate, 9) AS rate, n_bytes, c::INT AS copy, {_unit(str(seed), "'order'", "coalesce(doc_id::VARCHAR, '')", "c", "mark", "occurrence")} AS order_key
FROM n, unnest(range(0, n)) AS v(c)
"""


FILL_IN_MIDDLE = """
WITH drawn AS (
  SELECT doc_id, coalesce(text, '') AS text, length(coalesce(text, '')) AS n, sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS digest FROM documents),
numbers AS (
  SELECT doc_id, text, n, ('0x' || substr(digest, 1, 8))::BIGINT % (n + 1) AS a, ('0x' || substr(digest, 9, 8))::BIGINT % (n + 1) AS b,
         ('0x' || substr(digest, 17, 8))::BIGINT % 100 AS p, ('0x' || substr(digest, 25, 8))::BIGINT % 100 AS q FROM drawn),
cut AS (
  SELECT doc_id, text, n, least(a, b) AS x, greatest(a, b) AS y,
         CASE WHEN n = 0 OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR p >= 90 THEN 'plain' WHEN q < 20 THEN 'spm' ELSE 'psm' END AS form
  FROM numbers),
parts AS (SELECT *, substr(text, 1, x) AS prefix, substr(text, x + 1, y - x) AS middle, substr(text, y + 1) AS suffix FROM cut)
SELECT doc_id, CAST(n AS BIGINT) AS n, form, CASE WHEN form <> 'plain' THEN CAST(x AS BIGINT) END AS prefix_chars, CASE WHEN form <> 'plain' THEN CAST(y - x AS BIGINT) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM parts
"""
