"""DuckDB SQL for the operators that SQL can express."""

# The same rules, priors and bound as url_reputation, level by level.
_URLS = r"""
WITH rest AS (
    SELECT page_id, CASE WHEN instr(url, '://') > 0
        THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages
), parsed AS (
    SELECT page_id,
        translate(regexp_extract(rest, '^([^/?#]*)', 1),
            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
        regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM rest
), outcomes AS (
    SELECT doc_id, max(CASE WHEN quality = 0 OR toxic = 1 THEN 1 ELSE 0 END) AS bad
    FROM labels WHERE doc_id IS NOT NULL AND (quality IS NOT NULL OR toxic IS NOT NULL) GROUP BY 1
), counts AS (
    SELECT host, count(bad) AS n, coalesce(sum(bad), 0) AS k,
        regexp_replace(host, '^.*@|:[0-9]*$|\.$', '') AS bare
    FROM parsed LEFT JOIN outcomes
        ON doc_id = TRY_CAST(regexp_extract(path, '/([0-9]+)(?:\.html|/)?$', 1) AS BIGINT)
    GROUP BY host
), labelled AS (
    SELECT host, n, k, string_split(bare, '.') AS parts,
        array_to_string(string_split(bare, '.')[-2:], '.') AS two FROM counts
), named AS (
    SELECT host, n, k,
        CASE WHEN two IN ({long}) THEN array_to_string(parts[-3:], '.') ELSE two END AS domain,
        CASE WHEN two IN ({long}) THEN two ELSE parts[-1] END AS suffix FROM labelled
), suffix_sums AS (
    SELECT suffix, sum(n) AS n, sum(k) AS k,
        (SELECT (sum(k) + 1) / (sum(n) + 2) FROM named) AS above FROM named GROUP BY suffix
), suffix_weight AS (SELECT {weight} AS w FROM suffix_sums),
suffixes AS (
    SELECT suffix, (k + w * above) / (n + w) AS mean FROM suffix_sums, suffix_weight
), domain_sums AS (
    SELECT domain, named.suffix, sum(n) AS n, sum(k) AS k, any_value(mean) AS above
    FROM named JOIN suffixes ON named.suffix = suffixes.suffix GROUP BY domain, named.suffix
), domain_weight AS (SELECT {weight} AS w FROM domain_sums),
domains AS (
    SELECT domain, suffix, (k + w * above) / (n + w) AS mean FROM domain_sums, domain_weight
), host_sums AS (
    SELECT host, n, k, mean AS above FROM named JOIN domains USING (domain, suffix)
), host_weight AS (SELECT {weight} AS w FROM host_sums),
hosts AS (
    SELECT host, n, w, (k + w * above) / (n + w) AS mean FROM host_sums, host_weight
), standing AS (
    SELECT host, n, mean - 1.645 * sqrt(mean * (1 - mean) / (n + w + 1)) AS low FROM hosts
), ruled AS (
    SELECT page_id, host, path, CASE
        WHEN (host = 'example.net' OR host LIKE '%.example.net') AND path LIKE '/en/%' THEN 'example.net/en/'
        WHEN (host = 'example.com' OR host LIKE '%.example.com') AND path LIKE '/de/%' THEN 'example.com/de/'
        WHEN (host = 'org' OR host LIKE '%.org') AND path LIKE '/fr/%' THEN 'org/fr/'
        WHEN (host = 'net' OR host LIKE '%.net') AND path LIKE '/%' THEN 'net/' END AS rule FROM parsed
)
SELECT page_id, host, path, rule, CASE
    WHEN rule IN ('example.net/en/', 'org/fr/') THEN 'allow'
    WHEN rule IS NOT NULL THEN 'block'
    WHEN low > 0.5 THEN 'block' ELSE 'allow' END AS verdict, n AS n_labelled
FROM ruled JOIN standing USING (host)
"""
_WEIGHT = """
    coalesce(greatest(2.0, least(1000.0, CASE
        WHEN sum(pow(k - n * above, 2) - n * above * (1 - above)) > 0
        THEN sum(n * above * (1 - above) * (n - 1))
            / nullif(sum(pow(k - n * above, 2) - n * above * (1 - above)), 0) - 1
        END)), 1000.0)
"""

# What the template adds is counted here by its lengths.
_CHATS = r"""
WITH turns AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
    UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
), escaped AS (
    SELECT *, replace(replace(replace(text, '\', '\b'), '###', '\h'), '</turn>', '\l') AS inside,
        lag(role) OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS before
    FROM turns
)
SELECT conv_id, count(*) AS n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text))
        AS turns_sha256,
    coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
    sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text)
        FILTER (role = 'assistant'), '')) AS loss_sha256,
    sum(length(inside) + 8
        + CASE WHEN before IS NULL OR before <> role THEN length(role) + 6 ELSE 0 END)::BIGINT
        AS formatted_chars
FROM escaped GROUP BY conv_id
"""


_NEAREST = """
WITH valid AS (
    SELECT vec_id, min(embedding) AS embedding FROM embeddings
    WHERE embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    GROUP BY vec_id
), whole AS (
    SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS x FROM valid
), scored AS (
    SELECT q.vec_id AS query_id, v.vec_id, list_dot_product(q.x, v.x)::BIGINT AS score
    FROM whole q JOIN whole v ON q.vec_id % 100 = 0 AND q.vec_id IS DISTINCT FROM v.vec_id
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored
)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM ranked WHERE rank <= 10
"""


_ARCHIVED = """
WITH payloads AS (
    SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes,
        sha256(coalesce(html, '')) AS payload_digest FROM pages
), grouped AS (
    SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS smallest,
        row_number() OVER (PARTITION BY payload_digest ORDER BY page_id NULLS LAST) AS place FROM payloads
), typed AS (SELECT *, payload_bytes >= 100 AND place > 1 AS again FROM grouped)
SELECT page_id, payload_bytes, payload_digest,
    CASE WHEN again THEN 'revisit' ELSE 'response' END AS record_type,
    CASE WHEN again THEN smallest END AS refers_to FROM typed
"""


_COLLOCATIONS = r"""
WITH folded AS (
    SELECT coalesce(lang, 'und') AS lang, string_split_regex(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ' || chr(9), 'abcdefghijklmnopqrstuvwxyz '),
        '[.,;:!?\x0A-\x0D]') AS pieces FROM documents
), piece AS (SELECT lang, unnest(pieces) AS piece FROM folded),
split AS (SELECT lang, list_filter(string_split(piece, ' '), lambda x: x <> '') AS w FROM piece),
places AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM split),
counts AS (
    SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase, count(*) AS f
    FROM places, (VALUES (1), (2), (3)) lengths(k) WHERE i + k - 1 <= len(w) GROUP BY ALL
), totals AS (SELECT lang, sum(f)::BIGINT AS n FROM counts WHERE k = 1 GROUP BY lang),
candidates AS (
    SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS w FROM counts WHERE k > 1 AND f >= 10
), keyed AS MATERIALIZED (SELECT lang || chr(9) || phrase AS key, f FROM counts),
longer AS (
    SELECT key, max(a) AS a FROM (
        SELECT lang || chr(9) || array_to_string(w[1:2], ' ') AS key, a FROM candidates WHERE k = 3
        UNION ALL SELECT lang || chr(9) || array_to_string(w[2:3], ' '), a FROM candidates WHERE k = 3
    ) GROUP BY key
), cuts AS (
    SELECT lang, phrase, a, 1 AS cut, lang || chr(9) || w[1] AS head,
        lang || chr(9) || array_to_string(w[2:k], ' ') AS rest FROM candidates
    UNION ALL SELECT lang, phrase, a, 2, lang || chr(9) || array_to_string(w[1:2], ' '), lang || chr(9) || w[3]
    FROM candidates WHERE k = 3
), headed AS MATERIALIZED (SELECT cuts.*, f AS l FROM cuts JOIN keyed ON key = head),
scored AS (
    SELECT lang, phrase, a, cut, l, f AS r,
        ((1000000::HUGEINT * a * a) // (l::HUGEINT * f))::BIGINT AS score
    FROM headed JOIN keyed ON key = rest
), lowest AS (
    SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) AS place FROM scored
), kept AS (
    SELECT lowest.* FROM lowest LEFT JOIN longer ON key = lang || chr(9) || phrase
    WHERE place = 1 AND coalesce(longer.a, 0) * 100 < 50 * lowest.a
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept
)
SELECT ranked.lang, rank, phrase, a, l, r, n, score FROM ranked JOIN totals ON totals.lang = ranked.lang
WHERE rank <= 2000
"""


def oracle_sql() -> dict[str, str]:
    long = "'co.uk', 'org.uk', 'com.au', 'co.jp', 'com.br', 'co.nz', 'co.in'"
    return {
        "op4_top_k": _NEAREST,
        "op5_url_reputation": _URLS.replace("{weight}", _WEIGHT).replace("{long}", long),
        "op10_chat": _CHATS,
        "op12_warc": _ARCHIVED,
        "op13_collocation": _COLLOCATIONS,
    }
