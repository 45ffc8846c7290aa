"""The queries that SQL can express, in DuckDB's dialect.

Not here: fingerprints, chunks, tokens, profiles and tags need hashes or models that SQL lacks, and lines
would need all pairs. Tests hold those against brute-force versions.
"""

from tickloom.llm import centroids, chat, hamming, quality

_SPACE = r"[\x20\x09-\x0D]+"

_GRID = ", ".join(
    f"('{rule}', {level}, {cutoff})"
    for rule, cutoffs in quality.RULES.items()
    for level, cutoff in enumerate(cutoffs)
)

QUALITY = f"""
WITH split AS (
    SELECT doc_id, coalesce(lang, '') AS stratum, coalesce(text, '') AS t,
        list_filter(string_split_regex(coalesce(text, ''), '{_SPACE}'), lambda x: x <> '') AS ws,
        list_filter(string_split(coalesce(text, ''), chr(10)),
            lambda x: regexp_replace(x, '{_SPACE}', '', 'g') <> '') AS ls
    FROM documents
), windows AS (
    SELECT doc_id, i, [ws[i], ws[i + 1], ws[i + 2]] AS w
    FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 1)) AS i FROM split)
), again AS (
    SELECT doc_id, i FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, w) AS n FROM windows) WHERE n > 1
), covered AS (
    SELECT doc_id, count(DISTINCT p) AS n
    FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM again) GROUP BY doc_id
), counts AS (
    SELECT s.doc_id, stratum, len(ws)::BIGINT AS n_words,
        length(array_to_string(ws, ''))::BIGINT AS word_chars,
        length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g'))::BIGINT AS n_symbols,
        (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines,
        coalesce(c.n, 0)::BIGINT AS n_repeat_words, len(ls)::BIGINT AS n_lines
    FROM split s LEFT JOIN covered c ON s.doc_id IS NOT DISTINCT FROM c.doc_id
), judged AS (
    SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
        coalesce(1000 * n_symbols // nullif(n_words, 0), 0) AS symbols,
        coalesce(1000 * word_chars // nullif(n_words, 0), 0) AS long_words,
        coalesce(1000 * n_dup_lines // nullif(n_lines, 0), 0) AS dup_lines,
        coalesce(1000 * n_repeat_words // nullif(n_words, 0), 0) AS repeats
    FROM counts
), signals AS (
    SELECT doc_id, stratum, base_failed, 'symbols' AS rule, symbols AS signal FROM judged
    UNION ALL SELECT doc_id, stratum, base_failed, 'long_words', long_words FROM judged
    UNION ALL SELECT doc_id, stratum, base_failed, 'dup_lines', dup_lines FROM judged
    UNION ALL SELECT doc_id, stratum, base_failed, 'repeats', repeats FROM judged
), grid(rule, level, cutoff) AS (VALUES {_GRID}
), tried AS (
    SELECT stratum, g.rule, level, cutoff, count(*) AS n, count(*) FILTER (signal >= cutoff) AS k
    FROM signals s
    JOIN (SELECT doc_id FROM labels GROUP BY doc_id HAVING min(quality) = 1) l ON l.doc_id = s.doc_id
    JOIN grid g ON g.rule = s.rule
    WHERE NOT base_failed GROUP BY ALL
), tested AS (
    SELECT *, CASE WHEN k > n * {quality.RISK} THEN 1 ELSE list_sum(list_transform(range(0, k + 1), lambda i:
        exp(lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1)
            + i * ln({quality.RISK}) + (n - i) * ln(1 - {quality.RISK})))) END
        <= {quality.ERROR} / (SELECT count(DISTINCT (stratum, rule)) FROM tried) AS passed
    FROM tried
), chosen AS (
    SELECT stratum, rule, min(cutoff) AS cutoff
    FROM (SELECT *, bool_and(passed) OVER (PARTITION BY stratum, rule ORDER BY level) AS sure FROM tested)
    WHERE sure GROUP BY ALL
), bad AS (
    SELECT DISTINCT doc_id FROM signals s JOIN chosen c USING (stratum, rule) WHERE signal >= cutoff
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    NOT base_failed AND doc_id NOT IN (SELECT doc_id FROM bad) AS kept
FROM judged
"""

_RENDERED = f"'{chat.START}' || role || chr(10) || text || '{chat.END}' || chr(10)"

CHAT = f"""
WITH placed AS (
    SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
        row_number() OVER (PARTITION BY conv_id
            ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) - 1 AS place
    FROM conversations WHERE conv_id IS NOT NULL
), last AS (
    SELECT conv_id, max(place) AS last FROM placed WHERE role = '{chat.TRAINED}' GROUP BY conv_id
), answers AS (
    SELECT p.conv_id, last, text FROM placed p JOIN last l ON p.conv_id = l.conv_id AND place = last
), swapped AS (
    SELECT conv_id, last, coalesce(
        lead(text) OVER (PARTITION BY conv_id // {chat.BLOCK} ORDER BY conv_id),
        first_value(text) OVER (PARTITION BY conv_id // {chat.BLOCK} ORDER BY conv_id)) AS other
    FROM answers
), sides AS (
    SELECT conv_id AS pair_id, true AS is_chosen, place, role, text FROM placed SEMI JOIN last USING (conv_id)
    UNION ALL
    SELECT p.conv_id, false, place, role, CASE WHEN place = last THEN other ELSE text END
    FROM placed p JOIN swapped s ON p.conv_id = s.conv_id AND place <= last
), shared AS (
    SELECT pair_id, place, count(*) AS n, count(DISTINCT (role, text)) AS kinds FROM sides GROUP BY ALL
), cut AS (
    SELECT pair_id, least(
        coalesce(min(place) FILTER (n = 2 AND kinds = 2), count(*) FILTER (n = 2) - 1),
        count(*) FILTER (n = 2) - 1) AS n_common
    FROM shared GROUP BY pair_id
), parts AS (
    SELECT s.*, n_common, {_RENDERED} AS said FROM sides s JOIN cut USING (pair_id)
), offsets AS (
    SELECT *, coalesce(sum(length(said)) OVER (PARTITION BY pair_id, is_chosen ORDER BY place
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) + length(role) + {len(chat.START) + 1} AS start
    FROM parts WHERE place >= n_common
), completions AS (
    SELECT pair_id, is_chosen, string_agg(said, '' ORDER BY place) AS said,
        coalesce(string_agg(start::BIGINT || '-' || (start + length(text) + {len(chat.END)})::BIGINT, ',' ORDER BY place)
            FILTER (role = '{chat.TRAINED}'), '') AS mask
    FROM offsets GROUP BY ALL
), prompts AS (
    SELECT pair_id, string_agg(said, '' ORDER BY place) AS prompt
    FROM parts WHERE is_chosen AND place < n_common GROUP BY pair_id
)
SELECT c.pair_id, c.n_common::BIGINT AS n_common, coalesce(p.prompt, '') AS prompt,
    a.said AS chosen, b.said AS rejected, a.mask AS chosen_mask, b.mask AS rejected_mask
FROM cut c LEFT JOIN prompts p ON p.pair_id = c.pair_id
JOIN completions a ON a.pair_id = c.pair_id AND a.is_chosen
JOIN completions b ON b.pair_id = c.pair_id AND NOT b.is_chosen
"""

HAMMING = f"""
WITH coded AS (
    SELECT vec_id, list_transform(embedding, lambda x: coalesce(x > 0, false)) AS bits
    FROM embeddings WHERE vec_id IS NOT NULL AND len(embedding) = {hamming.BITS}
), pairs AS (
    SELECT q.vec_id AS query_id, r.vec_id, list_sum(list_transform(range(1, {hamming.BITS + 1}),
        lambda i: (q.bits[i] <> r.bits[i])::INT))::BIGINT AS distance
    FROM coded q, coded r WHERE q.vec_id % {hamming.EVERY} = 0
)
SELECT query_id, rank::INT AS rank, vec_id, distance
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, vec_id) AS rank FROM pairs)
WHERE rank <= {hamming.TOP}
"""



def _round(n: int) -> str:
    """Nearest centroids of round ``n`` and, from them, those of the next one."""
    return f""", near{n} AS (
    SELECT row, arg_min(c, (distance, c)) AS c, min(distance) AS distance
    FROM (SELECT row, c, list_sum(list_transform(range(1, {centroids.PARTS + 1}),
        lambda i: (x[i] - m[i]) * (x[i] - m[i])))::BIGINT AS distance FROM kept, c{n})
    GROUP BY row
), sums{n} AS (
    SELECT c, i, sum(part) AS s, count(*) AS n
    FROM (SELECT c, unnest(x) AS part, unnest(range({centroids.PARTS})) AS i FROM kept JOIN near{n} USING (row))
    GROUP BY ALL
), means{n} AS (
    SELECT c, list(((s - ((s % n) + n) % n) // n)::BIGINT ORDER BY i) AS m FROM sums{n} GROUP BY c
), c{n + 1} AS (
    SELECT c, coalesce(means{n}.m, c{n}.m) AS m FROM c{n} LEFT JOIN means{n} USING (c)
)"""


_CLUSTERED = "".join(_round(n) for n in range(centroids.ROUNDS + 1))
_LAST = centroids.ROUNDS

CENTROIDS = f"""
WITH kept AS (
    SELECT *, row_number() OVER () AS row FROM (
        SELECT vec_id, list_transform(embedding, lambda v: floor({centroids.SCALE} * v::DOUBLE)::BIGINT) AS x
        FROM embeddings WHERE len(embedding) = {centroids.PARTS}
            AND list_bool_and(list_transform(embedding, lambda v: coalesce(isfinite(v), false))))
), c0 AS (
    SELECT place - 1 AS c, x AS m FROM (
        SELECT x, row_number() OVER (ORDER BY sha256('{centroids.SEED}:' || vec_id) NULLS LAST, x) AS place FROM kept)
    WHERE place <= {centroids.CLUSTERS}
){_CLUSTERED}
SELECT vec_id, c::INT AS cluster, distance, sum(distance) OVER (PARTITION BY c)::BIGINT AS cluster_inertia,
    sum(distance) OVER ()::BIGINT AS inertia, sha256(array_to_string(m, ',')) AS centroid_sha256
FROM kept JOIN near{_LAST} USING (row) JOIN c{_LAST} USING (c)
"""

SQL: dict[str, str] = {
    "op1_chat_preferences": CHAT,
    "op2_quality_rules": QUALITY,
    "op10_hamming_top_k": HAMMING,
    "op13_centroid_clusters": CENTROIDS,
}
