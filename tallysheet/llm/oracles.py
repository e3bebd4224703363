"""DuckDB counterparts of the queries that SQL can express."""

from __future__ import annotations

from tallysheet.llm import hardnegatives, hostrules, mixing, urlrules

WORDS = r"'[^\x20\x09-\x0D]+'"


def mix_sources(mix: mixing.Mix = mixing.DEFAULT) -> str:
    weights = ", ".join(map(str, mix.weights))
    return f"""
WITH sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), {WORDS}))::BIGINT AS size, md5(coalesce(text, '')) AS digest,
    row_number() OVER (PARTITION BY doc_id, source, md5(coalesce(text, ''))) AS turn
  FROM documents
), sums AS (
  SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source
), weighed AS (
  SELECT *, {mix.most_share} * source_size AS most,
    [{weights}][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % {len(mix.weights)} + 1)::BIGINT] AS weight
  FROM sums
), levels AS (
  -- Sources in the order in which they reach their limit: the level if all before one are at theirs.
  SELECT *,
    ((SELECT sum(source_size) FROM sums)::DOUBLE * {mix.total_share} - coalesce(sum(most) OVER before, 0)::DOUBLE)
      / ((SELECT sum(weight) FROM weighed) - coalesce(sum(weight) OVER before, 0))::DOUBLE AS level,
    row_number() OVER (ORDER BY most / weight, source NULLS LAST) AS turn
  FROM weighed
  WINDOW before AS (ORDER BY most / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), chosen AS (
  SELECT level FROM levels WHERE weight * level <= most ORDER BY turn LIMIT 1
), targets AS (
  SELECT source, source_size, least(weight * (SELECT level FROM chosen), most)::DOUBLE AS target FROM weighed
), rates AS (
  SELECT s.doc_id, s.size, t.source_size, t.target, s.source,
    CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0.0 END AS rate,
    ('0x' || substr(md5('{mix.seed}:' || coalesce(s.doc_id::VARCHAR, 'null') || ':' || s.digest || ':' || s.turn), 1, 13))::BIGINT::DOUBLE
      / 4503599627370496 AS draw
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source
), copied AS (
  SELECT *, (floor(rate) + (draw < rate - floor(rate))::INT)::BIGINT AS copies FROM rates
)
SELECT doc_id, size, source_size, target, copies * size AS taken, source, copies FROM copied
"""


def host_rules(r: hostrules.HostRules = hostrules.DEFAULT) -> str:
    def soft(symbols: int, lines: int) -> str:
        return (
            f"(100 * n_symbols > {symbols} * n_words OR 100 * n_dup_lines > {lines} * n_words"
            f" OR word_chars < {r.min_word_chars}::DOUBLE * n_words OR word_chars > {r.max_word_chars}::DOUBLE * n_words)"
        )

    base = f"(n_words < {r.min_words} OR 100 * n_repeat_words > {r.max_repeat_percent} * n_words)"
    loose, strict = (
        soft(r.max_symbol_percent, r.max_dup_line_percent),
        soft(r.strict_symbol_percent, r.strict_dup_line_percent),
    )
    return f"""
WITH d AS (
  SELECT row_number() OVER () AS n, doc_id, source, coalesce(text, '') AS t FROM documents
), w AS (
  SELECT *, regexp_extract_all(t, {WORDS}) AS words FROM d
), starts AS (
  SELECT n, words, unnest(range(1, len(words) - {hostrules.WINDOW - 2})) AS i FROM w WHERE len(words) >= {hostrules.WINDOW}
), windows AS (
  SELECT n, i, array_to_string(words[i:i + {hostrules.WINDOW - 1}], ' ') AS w FROM starts
), found AS (
  SELECT n, unnest(list(i)) AS i FROM windows GROUP BY n, w HAVING count(*) > 1
), covered AS (
  SELECT n, count(DISTINCT i + k) AS n_repeat_words FROM found, range({hostrules.WINDOW}) AS r(k) GROUP BY n
), lines AS (
  SELECT n, unnest(string_split(t, chr(10))) AS line FROM d
), dups AS (
  SELECT n, count(*) - count(DISTINCT line) AS n_dup_lines FROM lines
  WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]') GROUP BY n
), measured AS (
  SELECT w.doc_id, w.source, len(words)::BIGINT AS n_words,
    coalesce(list_sum(list_transform(words, lambda x: length(x))), 0)::BIGINT AS word_chars,
    (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
    coalesce(n_dup_lines, 0)::BIGINT AS n_dup_lines, coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words
  FROM w LEFT JOIN dups USING (n) LEFT JOIN covered USING (n)
), hosts AS (
  SELECT source, count(*) AS host_docs, sum(({base} OR {loose})::INT)::BIGINT AS host_failures FROM measured GROUP BY source
), corpus AS (
  SELECT sum(host_docs)::DOUBLE AS docs, sum(host_failures) / sum(host_docs)::DOUBLE AS mean, count(*) AS hosts,
    sum(host_failures::DOUBLE * host_failures / host_docs) AS squares, sum(host_docs * host_docs)::DOUBLE AS sizes
  FROM hosts
), moments AS (
  SELECT mean, mean * (1 - mean) AS noise, docs - sizes / docs AS room,
    squares - docs * mean * mean - (hosts - 1) * mean * (1 - mean) AS between_hosts
  FROM corpus
), prior AS (
  SELECT mean, CASE WHEN noise > 0 AND room > 0 AND between_hosts > 0
    THEN greatest(noise * room / between_hosts - 1, 1e-6) END AS strength FROM moments
), rated AS (
  SELECT h.*, round(CASE WHEN strength IS NULL THEN mean
    ELSE (host_failures + strength * mean) / (host_docs + strength) END, 9) AS host_rate FROM hosts h, prior
), judged AS (
  SELECT *, CASE WHEN host_rate >= {r.rejected_rate} THEN 'rejected' WHEN host_rate >= {r.suspect_rate} THEN 'suspect'
    ELSE 'trusted' END AS host_verdict FROM rated
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, {base} AS base_failed,
  NOT {base} AND CASE host_verdict WHEN 'trusted' THEN NOT {loose} WHEN 'suspect' THEN NOT {strict} ELSE false END AS kept,
  m.source, host_docs, host_failures, host_rate, host_verdict
FROM measured m JOIN judged j ON m.source IS NOT DISTINCT FROM j.source
"""


def url_rules(mining: urlrules.Mining = urlrules.DEFAULT, rules=urlrules.LIST_RULES) -> str:
    longest = sorted(rules, key=lambda r: len(r.text), reverse=True)
    fits = [f"(host = '{r.host}' OR ends_with(host, '.{r.host}')) AND starts_with(path, '{r.path}')" for r in longest]
    case = lambda value: "CASE " + " ".join(f"WHEN {f} THEN '{value(r)}'" for f, r in zip(fits, longest, strict=True)) + " END"
    lower = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"
    combinations = []
    for size in range(1, mining.most_tokens + 1):
        tables = ", ".join(f"items i{k}" for k in range(size))
        same = " AND ".join([f"i0.page = i{k}.page AND i{k - 1}.token < i{k}.token" for k in range(1, size)] or ["true"])
        text = " || ' ' || ".join(f"i{k}.token" for k in range(size))
        combinations.append(f"SELECT i0.page, {text} AS rule, {size} AS need FROM {tables} WHERE {same}")
    return f"""
WITH cut AS (
  SELECT row_number() OVER () AS page, page_id, url,
    CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages
), parsed AS (
  SELECT *, translate(regexp_extract(rest, '^[^/?#]*'), {lower}) AS host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path,
    regexp_extract(rest, '^[^?#]*\\?([^#]*)', 1) AS query FROM cut
), split AS (
  SELECT *, string_split(host, '.') AS labels, list_filter(string_split(path, '/'), lambda s: s <> '') AS segments,
    {case(lambda r: r.text)} AS rule, {case(lambda r: r.verdict)} AS listed FROM parsed
), tokens AS (
  SELECT page, unnest(list_distinct(list_filter([
    'scheme:' || translate(split_part(url, '://', 1), {lower}),
    CASE WHEN len(labels) > 2 THEN 'host:' || host END,
    'domain:' || array_to_string(labels[greatest(len(labels) - 1, 1):], '.'),
    'top:' || labels[-1],
    CASE WHEN len(labels) > 3 THEN 'sub:' || labels[1] END,
    'start:' || segments[1],
    'depth:' || least(len(segments), 9),
    CASE WHEN regexp_matches(segments[-1], '\\.[A-Za-z0-9]+$') THEN 'type:' || regexp_extract(segments[-1], '\\.([A-Za-z0-9]+)$', 1) END,
    CASE WHEN query <> '' THEN 'query:' || array_to_string(list_sort(list_distinct(
      list_transform(string_split(query, '&'), lambda p: split_part(p, '=', 1)))), '&') END
  ], lambda x: x IS NOT NULL))) AS token FROM split WHERE host <> ''
), items AS (
  SELECT t.page, t.token FROM tokens t
), sets AS (
  {" UNION ALL ".join(combinations)}
), labelled AS (
  SELECT count(*) AS n FROM split WHERE rule IS NOT NULL AND host <> ''
), counted AS (
  SELECT s.rule, need, count(*) AS every FROM sets s JOIN split p USING (page) WHERE p.rule IS NOT NULL GROUP BY ALL
), labels AS (
  SELECT s.rule, p.listed AS verdict, count(*) AS freq FROM sets s JOIN split p USING (page) WHERE p.rule IS NOT NULL GROUP BY ALL
), mined AS (
  SELECT rule, need, verdict, freq::DOUBLE / n AS support, freq::DOUBLE / every AS confidence
  FROM counted JOIN labels USING (rule), labelled
  WHERE freq >= ceil({mining.min_support} * n) AND freq >= {mining.min_urls} AND freq::DOUBLE / every >= {mining.min_confidence}
), best AS (
  SELECT s.page, m.rule AS mined_rule, m.verdict AS mined, m.confidence AS mined_confidence
  FROM sets s JOIN mined m USING (rule)
  QUALIFY row_number() OVER (PARTITION BY s.page ORDER BY confidence DESC, support DESC, m.need, m.rule, m.verdict) = 1
)
SELECT p.page_id, p.host, p.path, p.rule, coalesce(p.listed, b.mined, '{mining.default}') AS verdict,
  CASE WHEN p.rule IS NULL THEN mined_rule END AS mined_rule, CASE WHEN p.rule IS NULL THEN mined_confidence END AS mined_confidence
FROM split p LEFT JOIN best b USING (page)
"""


def hard_negatives(spec: hardnegatives.Mining = hardnegatives.DEFAULT) -> str:
    low, high = spec.window
    return f"""
WITH v AS (
  SELECT row_number() OVER () AS n, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    [floor({spec.scale} * x::DOUBLE) FOR x IN embedding] AS x
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
), scored AS (
  SELECT a.n AS a, a.vec_id AS anchor_id, r.n, r.vec_id, a.label = r.label AS same, list_inner_product(a.x, r.x)::BIGINT AS score
  FROM v a JOIN v r ON a.n <> r.n WHERE a.vec_id % 50 = 0
), positives AS (
  SELECT * FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY a ORDER BY score DESC, vec_id NULLS LAST, n) <= {spec.positives}
), found AS (
  SELECT p.anchor_id, p.vec_id AS positive_id, s.vec_id AS negative_id, p.score AS positive_score, s.score AS negative_score,
    row_number() OVER (PARTITION BY p.a, p.n ORDER BY s.score DESC, s.vec_id NULLS LAST, s.n)::INT AS rank
  FROM positives p JOIN scored s ON p.a = s.a AND NOT s.same
  WHERE {low} * p.score <= 100 * s.score AND 100 * s.score <= {high} * p.score
)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM found WHERE rank <= {spec.negatives}
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op2_mix_sources": mix_sources(),
        "op6_host_rules": host_rules(),
        "op7_url_rules": url_rules(),
        "op12_hard_negatives": hard_negatives(),
    }
