"""DuckDB SQL twins of the training-data queries that SQL can express.

The others use hashes, trained models or tokenizers that SQL lacks; the tests
hold them against brute-force versions and against the tokenizer libraries.
"""

from __future__ import annotations

from collections.abc import Sequence

from abx.llm.quality import BOILERPLATE, NAVIGATION, Rules

WS = r"[\x09-\x0D\x20]"
WORD = r"[^\x09-\x0D\x20]"


def _words(x: str) -> str:
    return f"list_filter(string_split_regex({x}, '{WS}+'), lambda w: w <> '')"


def _quoted(values: Sequence[str]) -> str:
    return ", ".join("'" + v.replace("'", "''") + "'" for v in values)


def quality_sql(r: Rules = Rules()) -> str:
    k = f"len({_words('x')})"
    seps, symbols = (f"len(regexp_extract_all(x, '{c}'))" for c in ("[|»›·]", "[#*$%&<>]"))
    fails = (f"({k} >= {r.long_line_words} AND NOT regexp_matches(x, '[.!?…。！？]')) OR {symbols} > {k} * {r.max_symbol_share}"
             f" OR ({seps} >= {r.nav_separators} AND {seps} >= {k} * {r.nav_share}) OR trim(lower(x)) IN ({_quoted(NAVIGATION)}) OR "
             + " OR ".join(f"contains(lower(x), {_quoted([p])})" for p in BOILERPLATE))
    n = r.window
    return f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT doc_id, text, {_words('text')} AS words,
             list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '{WORD}')) AS lines FROM d),
win AS (SELECT doc_id, i, array_to_string(words[i:i + {n - 1}], ' ') AS s
        FROM (SELECT doc_id, words, unnest(range(1, len(words) - {n - 2})) AS i FROM w)),
often AS (SELECT doc_id, i FROM win QUALIFY count(*) OVER (PARTITION BY doc_id, s) > 1),
cover AS (SELECT doc_id, least({n}, coalesce(lead(i) OVER (PARTITION BY doc_id ORDER BY i) - i, {n})) AS c FROM often),
rep AS (SELECT doc_id, sum(c)::BIGINT AS n_repeat_words FROM cover GROUP BY doc_id),
c AS (SELECT w.doc_id, len(words)::BIGINT AS n_words, length(array_to_string(words, ''))::BIGINT AS word_chars,
             len(regexp_extract_all(text, '[#*$%&|<>]'))::BIGINT AS n_symbols,
             (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
             coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words,
             len({_words(f"array_to_string(list_filter(lines, lambda x: NOT ({fails})), chr(10))")}) AS n_kept
      FROM w LEFT JOIN rep ON rep.doc_id = w.doc_id),
b AS (SELECT *, n_words < {r.min_words} OR 100 * n_repeat_words > {r.max_repeat_percent} * n_words AS base_failed FROM c)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND n_words - n_kept <= {r.max_lost_share} * n_words AS kept FROM b"""


def _split(url: str, part: int) -> str:
    return rf"regexp_extract(coalesce({url}, ''), '(?s)^.*?://([^/?#]*)([^?#]*)(\?[^#]*)?', {part})"


def _lower(x: str) -> str:
    return f"translate({x}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _attribute(name: str) -> str:
    shape = rf"""(?is)\s{name}\s*=\s*(?:"([^"]*)"|''([^'']*)''|([^\s"''>]+))"""
    return "trim(" + " || ".join(f"regexp_extract(tag, '{shape}', {g})" for g in (1, 2, 3)) + ")"


def url_sql(rules: Sequence[tuple[str, str]]) -> str:
    def rule(host: str, path: str, what: int) -> str:
        cases = ""
        for verdict, text in sorted(rules, key=lambda r: (-len(r[1]), r[0] != "allow", r[1])):
            cut = text.index("/")
            name, prefix = text[:cut], text[cut:]
            cases += (f" WHEN ({host} = '{name}' OR ends_with({host}, '.{name}')) AND starts_with({path}, '{prefix}')"
                      f" THEN '{(verdict, text)[what]}'")
        return f"CASE{cases} END"

    return rf"""
WITH RECURSIVE p AS (SELECT page_id, html, {_lower(_split('url', 1))} AS host, {_split('url', 2)} AS path,
                            {_split('url', 3)} AS query FROM pages),
tags AS (SELECT host, path, query, unnest(regexp_extract_all(
           regexp_replace(html, '(?is)<!--.*?-->|<script\b.*?</script\s*>|<style\b.*?</style\s*>', ' ', 'g'),
           '(?is)<(?:link|meta)\s[^>]*>')) AS tag
         FROM p WHERE regexp_matches(html, '(?i)canonical|http-equiv')),
links AS (SELECT host, path, query, replace(CASE
            WHEN list_contains(string_split_regex(lower({_attribute('rel')}), '\s+'), 'canonical') THEN {_attribute('href')}
            WHEN lower({_attribute('http-equiv')}) = 'refresh'
            THEN regexp_extract({_attribute('content')}, '(?is)url\s*=\s*[''"]?([^''"\s]+)', 1) END, '&amp;', '&') AS t FROM tags),
goals AS (SELECT host || path || query AS a, CASE
            WHEN coalesce(t, '') = '' THEN NULL
            WHEN contains(t, '://') AND regexp_matches(t, '^[A-Za-z][A-Za-z0-9+.\-]*:') THEN t
            WHEN starts_with(t, '//') THEN 'x:' || t
            WHEN regexp_matches(t, '^[A-Za-z][A-Za-z0-9+.\-]*:') THEN NULL
            WHEN starts_with(t, '/') THEN 'x://' || host || t
            WHEN regexp_matches(t, '^[?#]') THEN 'x://' || host || path || t
            ELSE 'x://' || host || regexp_extract(path, '(?s)^(.*)/', 1) || '/' || t END AS u FROM links),
e AS (SELECT a, {_lower(_split('u', 1))} || {_split('u', 2)} || {_split('u', 3)} AS b FROM goals WHERE a <> '' AND u IS NOT NULL),
both_ways AS (SELECT a, b FROM e WHERE b <> '' AND a <> b UNION SELECT b, a FROM e WHERE b <> '' AND a <> b),
reach(node, other) AS (SELECT a, a FROM both_ways UNION
                       SELECT r.node, s.b FROM reach r JOIN both_ways s ON s.a = r.other),
classes AS (SELECT node, min({rule(r"regexp_extract(other, '(?s)^([^/?]*)([^?]*)', 1)",
                                   r"regexp_extract(other, '(?s)^([^/?]*)([^?]*)', 2)", 0)}) AS alias_verdict
            FROM reach GROUP BY node)
SELECT page_id, host, path, {rule('host', 'path', 1)} AS rule,
       coalesce({rule('host', 'path', 0)}, alias_verdict, 'allow') AS verdict, alias_verdict
FROM p LEFT JOIN classes ON node = host || path || query"""


def substring_sql(window: int) -> str:
    return f"""
WITH w AS (SELECT doc_id, {_words("coalesce(text, '')")} AS words FROM documents),
win AS (SELECT doc_id, i, array_to_string(words[i:i + {window - 1}], ' ') AS s
        FROM (SELECT doc_id, words, unnest(range(1, len(words) - {window - 2})) AS i FROM w)),
hit AS (SELECT doc_id, i FROM win QUALIFY min(doc_id) OVER (PARTITION BY s) < doc_id),
gone AS (SELECT DISTINCT doc_id, i + k AS p FROM hit, range({window}) r(k)),
pos AS (SELECT doc_id, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS p FROM w),
kept AS (SELECT pos.doc_id, count(g.p)::BIGINT AS n_removed,
                string_agg(CASE WHEN g.p IS NULL THEN word END, ' ' ORDER BY pos.p) AS t
         FROM pos LEFT JOIN gone g ON g.doc_id = pos.doc_id AND g.p = pos.p GROUP BY pos.doc_id)
SELECT w.doc_id, len(words)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM w LEFT JOIN kept ON kept.doc_id = w.doc_id"""


def embedding_sql(threshold: float) -> str:
    return f"""
WITH RECURSIVE v AS (SELECT vec_id, embedding::DOUBLE[] AS x FROM embeddings),
fit AS (SELECT * FROM v WHERE len(x) > 0 AND len(list_filter(x, lambda c: c IS NULL OR NOT isfinite(c))) = 0
        AND list_max(x) IS NOT NULL AND (list_max(x) <> 0 OR list_min(x) <> 0)),
pairs AS (SELECT a.vec_id AS a, b.vec_id AS b FROM fit a JOIN fit b ON a.vec_id < b.vec_id AND len(a.x) = len(b.x)
          WHERE list_cosine_similarity(a.x, b.x) >= {threshold}),
both_ways AS (SELECT a, b FROM pairs UNION SELECT b, a FROM pairs),
reach(node, other) AS (SELECT a, a FROM both_ways UNION
                       SELECT r.node, s.b FROM reach r JOIN both_ways s ON s.a = r.other),
comp AS (SELECT node, min(other) AS component_id FROM reach GROUP BY node),
links AS (SELECT a AS node, count(*) AS n FROM both_ways GROUP BY a)
SELECT v.vec_id, coalesce(n, 0)::BIGINT AS n_links, coalesce(component_id, v.vec_id) AS component_id,
       coalesce(component_id, v.vec_id) = v.vec_id AS kept
FROM v LEFT JOIN comp ON comp.node = v.vec_id LEFT JOIN links ON links.node = v.vec_id"""


def centroids_sql(k: int, dim: int, rounds: int, scale: int, seed: str) -> str:
    squared = "list_sum(list_transform(list_zip(x, c), lambda p: (p[1] - p[2]) * (p[1] - p[2])))"
    floor_of = "((s - ((s % n) + n) % n) // n)"
    steps = []
    for r in range(rounds + 1):
        steps.append(f"""
a{r} AS MATERIALIZED (SELECT row, vec_id, x, arg_min(cl, (d, cl)) AS cl, min(d) AS d
        FROM (SELECT row, vec_id, x, cl, {squared} AS d FROM v, c{r}) GROUP BY row, vec_id, x)""")
        if r < rounds:
            steps.append(f"""
m{r} AS (SELECT cl, j, {floor_of} AS m FROM (
        SELECT cl, j, sum(x[j])::HUGEINT AS s, count(*)::HUGEINT AS n FROM a{r}, range(1, {dim} + 1) q(j) GROUP BY cl, j)),
c{r + 1} AS MATERIALIZED (SELECT c{r}.cl, coalesce(any_value(t.c), any_value(c{r}.c)) AS c FROM c{r}
        LEFT JOIN (SELECT cl, list(m::BIGINT ORDER BY j) AS c FROM m{r} GROUP BY cl) t ON t.cl = c{r}.cl GROUP BY c{r}.cl)""")
    return f"""
WITH v AS MATERIALIZED (SELECT row_number() OVER () AS row, vec_id, list_transform(e, lambda t: floor({scale} * t)::BIGINT) AS x
      FROM (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings)
      WHERE len(e) = {dim} AND len(list_filter(e, lambda t: t IS NULL OR NOT isfinite(t))) = 0),
c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY sha256('{seed}' || vec_id), x) - 1 AS cl, x AS c
       FROM v WHERE vec_id IS NOT NULL QUALIFY cl < {k}),{','.join(steps)}
SELECT vec_id, a{rounds}.cl::INTEGER AS cluster, d::BIGINT AS distance, sum(d) OVER (PARTITION BY a{rounds}.cl)::BIGINT AS cluster_inertia,
       sum(d) OVER ()::BIGINT AS inertia, sha256(array_to_string(c, ',')) AS centroid_sha256
FROM a{rounds} JOIN c{rounds} ON c{rounds}.cl = a{rounds}.cl"""
