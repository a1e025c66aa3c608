"""DuckDB SQL of the operators that SQL can express."""

URL_FILTERS = r"""
WITH named AS (
  SELECT page_id, url, DATE '2024-01-01' + CAST((page_id * 37) % 366 AS INTEGER) AS fetched_on,
    nullif(lower(rtrim(regexp_extract(url,
      '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)', 1), '.')), '') AS host,
    list_filter(string_split(regexp_extract(url,
      '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*(/[^?#]*)', 1), '/'), lambda s: s <> '') AS segments
  FROM pages
), keyed AS (
  SELECT *, list_concat(
    list_transform(range(least(2, len(string_split(host, '.'))), len(string_split(host, '.')) + 1),
      lambda n: array_to_string(string_split(host, '.')[len(string_split(host, '.')) - n + 1:], '.')),
    list_transform(range(1, len(segments) + 1),
      lambda n: host || '/' || array_to_string(segments[1:n], '/'))) AS keys
  FROM named WHERE host IS NOT NULL
), kinds AS (
  SELECT DISTINCT keys[1] AS key, 'domain' AS kind FROM keyed
  UNION SELECT DISTINCT host, 'host' FROM keyed
  UNION SELECT DISTINCT host || '/' || segments[1], 'path' FROM keyed WHERE len(segments) > 0
), drawn AS (
  SELECT *, CAST('0x' || substr(md5(kind || ':' || key), 1, 6) AS BIGINT) AS n FROM kinds
), rules(kind, modulus, shift, action, category) AS (VALUES
  ('host', 3, 0, 'add', 'gambling'), ('host', 3, 60, 'remove', 'gambling'), ('host', 6, 150, 'add', 'adult'),
  ('domain', 5, 10, 'add', 'spam'), ('path', 4, 20, 'add', 'allow'), ('path', 8, 90, 'remove', 'allow')
), entries AS (
  SELECT lower(key) AS key, DATE '2024-01-01' + CAST(n % 200 + shift AS INTEGER) AS valid_from,
    max({'category': category, 'action': action}) AS entry
  FROM drawn JOIN rules USING (kind) WHERE n % modulus = 0 GROUP BY ALL
), spans AS (
  SELECT *, coalesce(lead(valid_from) OVER (PARTITION BY key ORDER BY valid_from), DATE '9999-12-31') AS valid_to
  FROM entries
), wanted AS (
  SELECT page_id, fetched_on, unnest(keys) AS key, unnest(range(len(keys))) AS depth FROM keyed
), hits AS (
  SELECT page_id, count(*) AS active_entries,
    max({'depth': depth, 'key': w.key, 'category': s.entry.category, 'valid_from': s.valid_from}) AS best
  FROM wanted w JOIN spans s ON w.key = s.key AND s.entry.action = 'add'
    AND fetched_on >= valid_from AND fetched_on < valid_to
  GROUP BY page_id
)
SELECT page_id, host, fetched_on, coalesce(active_entries, 0) AS active_entries, best.key AS rule,
  best.category AS category, best.valid_from AS listed_since, coalesce(best.category <> 'allow', false) AS blocked
FROM named LEFT JOIN hits USING (page_id)
"""

EXACT_DEDUP = r"""
WITH texts AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm FROM documents
)
SELECT doc_id, min(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
  doc_id = min(doc_id) OVER same AS kept, sha256(norm) AS text_sha256
FROM texts WINDOW same AS (PARTITION BY norm)
"""

# The tables as the mix sees them, then targets, order, cut and closing document.
MIX_STEPS = r"""
sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
    (CAST('0x' || substr(md5('0/' || doc_id), 1, 13) AS BIGINT) + 0.5::DOUBLE) / 4503599627370496::DOUBLE AS unit
  FROM {documents}
), ranked AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size, count(*) AS docs,
    row_number() OVER (ORDER BY source ASC NULLS LAST) AS rank,
    (row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3 + 1 AS weight
  FROM sized GROUP BY source
), leveled AS (
  SELECT *, (sum(source_size) OVER ()
      - coalesce(sum(3 * source_size) OVER (ORDER BY 3 * source_size / weight, rank
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE
    / sum(weight) OVER (ORDER BY 3 * source_size / weight, rank
        ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)::DOUBLE AS level
  FROM ranked
), targets AS (
  SELECT source, source_size, docs, CASE WHEN 3 * source_size <= level * weight THEN (3 * source_size)::DOUBLE
    ELSE (SELECT arg_min(level, (3 * source_size / weight, rank)) FROM leveled
          WHERE NOT 3 * source_size <= level * weight) * weight END AS target
  FROM leveled
), sources AS (
  SELECT *, floor(ratio)::BIGINT AS whole, ratio - floor(ratio) AS part,
    target - floor(ratio) * source_size AS need, source_size::DOUBLE / docs AS mean
  FROM (SELECT *, CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS ratio FROM targets)
), placed AS (
  SELECT doc_id, size, source_size, target, s.source, whole, need,
    CASE WHEN part > 0 AND size > 0 THEN (unit / (1 - unit)) / ((part / (1 - part)) * (size / mean)) END AS q
  FROM sized d JOIN sources s ON d.source IS NOT DISTINCT FROM s.source
), ordered AS (
  SELECT *, q / (1 + q) AS place,
    sum(CASE WHEN q IS NOT NULL THEN size END) OVER (PARTITION BY source ORDER BY q / (1 + q), doc_id) AS running
  FROM placed
), gaps AS (
  SELECT source, any_value(need) - coalesce(max(running) FILTER (running <= need), 0) AS gap
  FROM ordered WHERE place IS NOT NULL GROUP BY source
), closing AS (
  SELECT o.source, arg_max(doc_id, (size, -place, doc_id)) AS closing_id
  FROM ordered o JOIN gaps g ON o.source IS NOT DISTINCT FROM g.source
  WHERE place IS NOT NULL AND running > need AND size <= gap GROUP BY o.source
), mixed AS (
  SELECT doc_id, size, source_size, target, CASE WHEN size = 0 THEN 0 ELSE whole
    + CASE WHEN coalesce(place IS NOT NULL AND running <= need, false)
        OR coalesce(doc_id = closing_id, false) THEN 1 ELSE 0 END END AS copies
  FROM ordered o LEFT JOIN closing c ON o.source IS NOT DISTINCT FROM c.source
)
"""

SOURCE_MIX = (
    "WITH "
    + MIX_STEPS.format(documents="documents")
    + "SELECT doc_id, size, source_size, target, CAST(copies * size AS BIGINT) AS taken FROM mixed"
)

WARC = r"""
WITH payloads AS (
  SELECT page_id, coalesce(html, '') AS html, octet_length(encode(coalesce(html, ''))) AS n FROM pages
), named AS (
  SELECT page_id, n, sha1(html) AS digest,
    CASE WHEN n >= 1000 THEN max(page_id) OVER (PARTITION BY html) ELSE page_id END AS original
  FROM payloads
)
SELECT page_id, n AS payload_bytes, digest AS payload_digest,
  CASE WHEN original = page_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN original <> page_id THEN original END AS refers_to
FROM named
"""



def _centroid_steps(rounds: int) -> str:
    """One step that assigns and one that moves the centroids, for each round."""
    nearest = """near{k} AS MATERIALIZED (
  SELECT rid, arg_min({{'c': cluster, 'd': d}}, {{'d': d, 'c': cluster}}) AS best FROM (
    SELECT rid, cluster, list_sum(list_transform(list_zip(v, c), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS d
    FROM kept, centres{k}) GROUP BY rid
)"""
    moved = """totals{k} AS (
  SELECT best.c AS cluster, place, sum(x) AS s, count(*) AS n
  FROM (SELECT best, unnest(v) AS x, unnest(range(64)) AS place FROM kept JOIN near{k} USING (rid)) GROUP BY ALL
), centres{next} AS MATERIALIZED (
  SELECT cluster, coalesce(m, c) AS c FROM centres{k} LEFT JOIN (
    SELECT cluster, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY place) AS m
    FROM totals{k} GROUP BY cluster) USING (cluster)
)"""
    steps = [f"{nearest.format(k=k)}, {moved.format(k=k, next=k + 1)}" for k in range(rounds)]
    return ", ".join([*steps, nearest.format(k=rounds)])


CENTROIDS = f"""
WITH kept AS MATERIALIZED (
  SELECT row_number() OVER () AS rid, vec_id,
    list_transform(embedding, lambda x: CAST(floor(1024.0 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: coalesce(isfinite(x), false))) = 64
), centres0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY sha256('3:' || vec_id), v) - 1 AS cluster, v AS c
  FROM kept ORDER BY cluster LIMIT 8
), {_centroid_steps(10)}, finals AS (
  SELECT vec_id, best.c AS cluster, CAST(best.d AS BIGINT) AS distance FROM kept JOIN near10 USING (rid)
)
SELECT vec_id, CAST(cluster AS INTEGER) AS cluster, distance,
  CAST(sum(distance) OVER (PARTITION BY cluster) AS BIGINT) AS cluster_inertia,
  CAST(sum(distance) OVER () AS BIGINT) AS inertia, sha256(array_to_string(c, ',')) AS centroid_sha256
FROM finals JOIN centres10 USING (cluster)
"""


# Kinds in their order, with pattern and what a match must meet.
PRIVATE = [
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+", "true"),
    (
        "ip",
        r"[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)",
        "len(list_filter(string_split(value, '.'), lambda x: coalesce(TRY_CAST(x AS HUGEINT), 256) > 255)) = 0",
    ),
    (
        "card",
        r"[0-9](?:[\x20-]?[0-9])+",
        """len(digits) BETWEEN 14 AND 19 AND list_sum(list_transform(range(1, len(digits) + 1), lambda j:
          CASE WHEN (len(digits) - j) % 2 = 0 THEN CAST(digits[j] AS INTEGER)
            WHEN CAST(digits[j] AS INTEGER) > 4 THEN 2 * CAST(digits[j] AS INTEGER) - 9
            ELSE 2 * CAST(digits[j] AS INTEGER) END)) % 10 = 0""",
    ),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", "len(digits) BETWEEN 10 AND 15"),
]


def _private(k: int, kind: str, pattern: str, valid: str) -> str:
    """Valid matches of a kind with their places and the texts beside them."""
    entity = {"email": "lower(value)", "ip": "value"}.get(kind, "digits")
    places = "list_sum(list_transform({0}, lambda x: len(x)))"
    return f"""
  SELECT rid, {k} AS k, '{kind}' AS kind, '{kind}:' || {entity} AS entity, before, after, place AS start_, place + len(value) AS end_
  FROM (SELECT rid, found[i] AS value, regexp_replace(found[i], '[^0-9]', '', 'g') AS digits, gaps[i] AS before,
      gaps[i + 1] AS after, {places.format("gaps[1:i]")} + coalesce({places.format("found[1:i - 1]")}, 0) AS place
    FROM (SELECT rid, gaps, found, unnest(range(1, len(found) + 1)) AS i FROM (
      SELECT rid, string_split_regex(text, '{pattern}') AS gaps, regexp_extract_all(text, '{pattern}') AS found FROM docs)))
  WHERE {valid}"""


def _beside(gap: str, cut: str, edge: str) -> str:
    whole = f"CASE WHEN len({gap}) > 100 THEN regexp_replace({cut}({gap}, 100), '{edge}', '') ELSE {gap} END"
    return f"regexp_replace({whole}, '{PRIVATE[0][1]}', ' ', 'g')"


def _power(n: int) -> str:
    return " * ".join(["odds"] * n)


NEAR = _beside("before", "right", r"^[^\x20\x09-\x0D]+") + " || ' ' || " + _beside("after", "left", r"[^\x20\x09-\x0D]+$")
SANITISE = rf"""
WITH docs AS MATERIALIZED (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text FROM documents
), base AS MATERIALIZED ({" UNION ALL ".join(_private(k, *kind) for k, kind in enumerate(PRIVATE))}
), near AS (
  SELECT DISTINCT rid, entity, lower(w) AS term FROM (SELECT rid, entity, unnest(regexp_extract_all(
    {NEAR}, '[\p{{L}}\p{{M}}]+')) AS w FROM base) WHERE len(w) >= 3
), pairs AS (
  SELECT entity, term, count(*) AS n_both FROM near GROUP BY ALL HAVING count(*) >= 2
), entities AS (
  SELECT entity, count(DISTINCT rid) AS n_entity FROM base GROUP BY entity
), words AS (
  SELECT rid, unnest(found) AS w, unnest(list_transform(gaps[1:len(found)], lambda x: len(x))) AS gap,
    unnest(range(1, len(found) + 1)) AS i
  FROM (
    SELECT rid, string_split_regex(text, '[\p{{L}}\p{{M}}]+') AS gaps, regexp_extract_all(text, '[\p{{L}}\p{{M}}]+') AS found
    FROM docs)
), terms AS (
  SELECT term, count(*) AS n_term FROM (SELECT DISTINCT rid, lower(w) AS term FROM words WHERE len(w) >= 3) GROUP BY term
), weighed AS (
  SELECT entity, term, CAST((SELECT count(*) FROM docs) AS DOUBLE) / n_entity AS rare,
    CAST(greatest(n_term, n_both) AS DOUBLE) / n_both AS odds
  FROM pairs JOIN entities USING (entity) JOIN terms USING (term)
), telling AS (
  SELECT entity, term, CASE WHEN {_power(20)} <= rare THEN 2 ELSE 1 END AS level
  FROM weighed WHERE rare > 1 AND {_power(5)} <= rare
), levels AS (
  SELECT rid, term, max(level) AS level FROM (SELECT DISTINCT rid, entity FROM base) JOIN telling USING (entity) GROUP BY ALL
), placed AS MATERIALIZED (
  SELECT rid, lower(w) AS term, sum(gap + len(w)) OVER (PARTITION BY rid ORDER BY i) AS end_, len(w) AS chars
  FROM words WHERE rid IN (SELECT rid FROM base)
), told AS (
  SELECT rid, 3 + level AS k, CASE level WHEN 1 THEN 'generalised' ELSE 'removed' END AS kind,
    end_ - chars AS start_, end_
  FROM placed p JOIN levels USING (rid, term)
  WHERE NOT EXISTS (FROM base b WHERE b.rid = p.rid AND b.start_ < p.end_ AND p.end_ - chars < b.end_)
), every AS (
  SELECT rid, k, kind, start_, end_ FROM base UNION ALL SELECT * FROM told
), listed AS (
  SELECT rid, count(*) FILTER (kind = 'email') AS n_email, count(*) FILTER (kind = 'ip') AS n_ip,
    count(*) FILTER (kind = 'card') AS n_card, count(*) FILTER (kind = 'phone') AS n_phone,
    string_agg(kind || ':' || start_ || ':' || end_, ',' ORDER BY start_, k) FILTER (k < 4) AS base_spans,
    string_agg(kind || ':' || start_ || ':' || end_, ',' ORDER BY start_, k) AS spans,
    count(*) FILTER (k = 4) AS n_generalised, count(*) FILTER (k = 5) AS n_removed
  FROM every GROUP BY rid
)
SELECT doc_id, coalesce(n_email, 0) AS n_email, coalesce(n_ip, 0) AS n_ip, coalesce(n_card, 0) AS n_card,
  coalesce(n_phone, 0) AS n_phone, sha256(coalesce(base_spans, '')) AS base_sha256, coalesce(spans, '') AS spans,
  coalesce(n_generalised, 0) AS n_generalised, coalesce(n_removed, 0) AS n_removed
FROM docs LEFT JOIN listed USING (rid)
"""

PHRASES = r"""
WITH pieces AS (
  SELECT row_number() OVER () AS pid, lang, piece FROM (
    SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents)
), lists AS (
  SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces
), totals AS (
  SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM lists GROUP BY lang
), counts AS MATERIALIZED (
  SELECT lang, words, len(words) AS m, count(*) AS f
  FROM (SELECT lang, w[i:i + k - 1] AS words, k, i, len(w) AS size FROM (
    SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM lists), (SELECT unnest(range(1, 6)) AS k))
  WHERE i + k - 1 <= size GROUP BY ALL HAVING count(*) >= 100
), candidates AS (
  SELECT lang, words, m, f AS a, unnest(range(1, m)) AS k FROM counts WHERE m >= 2
), contained AS (
  SELECT DISTINCT lang, unnest([words[1:m - 1], words[2:m]]) AS words, f FROM counts WHERE m >= 3
), cuts AS (
  SELECT c.lang, c.words, a, k, l.f AS l, r.f AS r, n,
    CAST((1000::HUGEINT * a * n) // (l.f::HUGEINT * r.f) AS BIGINT) AS score
  FROM candidates c JOIN totals USING (lang)
  JOIN counts l ON l.lang = c.lang AND l.words = c.words[1:k]
  JOIN counts r ON r.lang = c.lang AND r.words = c.words[k + 1:c.m]
), scored AS (
  SELECT lang, array_to_string(words, ' ') AS phrase, a, arg_min({'l': l, 'r': r}, {'score': score, 'k': k}) AS parts,
    n, min(score) AS score
  FROM cuts WHERE NOT EXISTS (FROM contained o WHERE o.lang = cuts.lang AND o.words = cuts.words AND o.f = cuts.a)
  GROUP BY lang, words, a, n
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a,
  parts.l AS l, parts.r AS r, n, score
FROM scored QUALIFY rank <= 2000
"""

ORACLES = {
    "op1_url_filters": URL_FILTERS,
    "op3_exact_dedup": EXACT_DEDUP,
    "op8_source_mix": SOURCE_MIX,
    "op10_warc": WARC,
    "op11_phrases": PHRASES,
    "op12_centroids": CENTROIDS,
    "op13_sanitise": SANITISE,
}
