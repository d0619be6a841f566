"""DuckDB SQL of the dealt operators that SQL can express."""

EXACT_DEDUP = """
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents)
SELECT doc_id,
       max(doc_id) OVER same AS keep_id,
       count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept,
       sha256(text) AS text_sha256
FROM d
WINDOW same AS (PARTITION BY text)
"""

TOP_K = """
WITH v AS (
    SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS terms
    FROM embeddings
    WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
    SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.terms, c.terms)::BIGINT AS score
    FROM v AS q JOIN v AS c ON q.vec_id <> c.vec_id AND len(q.terms) = len(c.terms)
    WHERE q.vec_id % 50 = 0
)
SELECT query_id, (row_number() OVER best)::INTEGER AS rank, vec_id, score
FROM scored
WINDOW best AS (PARTITION BY query_id ORDER BY score DESC, vec_id)
QUALIFY row_number() OVER best <= 5
"""

SUBSTRING_DEDUP = r"""
WITH d AS (
    SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents
), starts AS (
    SELECT doc_id, words, unnest(range(1, len(words) - 11)) AS pos FROM d
), windows AS (
    SELECT doc_id, pos, md5(array_to_string(words[pos:pos + 12], ' ')) AS code FROM starts
), covering AS (
    SELECT doc_id, pos FROM (SELECT doc_id, pos, min(doc_id) OVER (PARTITION BY code) AS least FROM windows)
    WHERE least < doc_id
), removed AS (
    SELECT DISTINCT doc_id, pos + step AS pos FROM covering, (SELECT unnest(range(13)) AS step)
), gone AS (
    SELECT doc_id, list(pos) AS places FROM removed GROUP BY doc_id
)
SELECT doc_id,
       len(words)::BIGINT AS n_words,
       coalesce(len(places), 0)::BIGINT AS n_removed,
       sha256(array_to_string(
           list_filter(words, lambda w, i: NOT coalesce(list_contains(places, i), false)), ' ')) AS kept_sha256
FROM d LEFT JOIN gone USING (doc_id)
"""

# The limit on repetition has a closed form: the exponent at which the smallest source is seen twice.
MIXING = r"""
WITH d AS (
    SELECT doc_id, coalesce(source, '') AS source, coalesce(doc_id::VARCHAR, '') AS name,
           len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) + 1 AS tokens
    FROM documents
), held AS (
    SELECT source, sum(tokens)::BIGINT AS held FROM d GROUP BY source
), bounds AS (
    SELECT sum(held)::DOUBLE AS total, max(held)::DOUBLE AS most, max(held)::DOUBLE / min(held) AS ratio FROM held
), plan AS (
    SELECT source, held, ceil(held / 4194304.0)::BIGINT AS blocks,
           round(pow(held / total, x) * total * pow(most / total, 1 - x))::BIGINT AS target
    FROM held, (SELECT *, CASE WHEN ratio <= 2 THEN 0 ELSE 1 - ln(2) / ln(ratio) END AS x FROM bounds)
), coded AS (
    SELECT d.*, target, target // held AS epochs, target % held AS rest,
           ('0x' || md5(name)[1:12])::BIGINT % blocks AS block
    FROM d JOIN plan USING (source)
), last AS (
    SELECT source, name, rest, sum(tokens) AS tokens,
           md5('0:' || epochs || ':b:' || block)[1:16] || md5('0:' || epochs || ':d:' || name)[1:16] AS place
    FROM coded GROUP BY ALL
), again AS (
    SELECT source, name, coalesce(sum(tokens) OVER (
        PARTITION BY source ORDER BY place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) < rest AS taken
    FROM last
), copies AS (
    SELECT coded.*, unnest(range(epochs + taken::BIGINT)) AS epoch
    FROM coded JOIN again USING (source, name)
)
SELECT doc_id, source, tokens, target AS target_tokens, epoch,
       md5('0:' || epoch || ':b:' || block)[1:16] || md5('0:' || epoch || ':d:' || name)[1:16] AS order_key
FROM copies
"""

# Trees level by level; the steps of a proof are what stands before and after a node in its run of eight.
MERKLE = r"""
WITH RECURSIVE spelled AS (
    SELECT doc_id, text, CASE WHEN lang IS NULL THEN '-' ELSE '=' || lang END AS grp,
           coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
           || coalesce(strlen(lang) || ':' || lang, '-') || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-')
               AS head,
           list_reduce(
               flatten(list_transform(string_split(doc_id::VARCHAR, ''), lambda c: [ord(c), 0, 0, 0, 0, 0, 0, 0])),
               lambda crc, bits: xor(xor(crc, bits) >> 1, (xor(crc, bits) & 1) * 3988292384),
               4294967295::BIGINT) AS crc
    FROM documents
), leaves AS (
    SELECT doc_id, grp, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
           CASE WHEN xor(crc, 4294967295) % 3 = 0 THEN sha256(head || coalesce(strlen(text) || ':'
               || translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '-')) END AS tampered
    FROM spelled
), placed AS (
    SELECT *, row_number() OVER (PARTITION BY grp ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos FROM leaves
), tree AS (
    SELECT grp, 0 AS lvl, pos, leaf AS node, count(*) OVER (PARTITION BY grp) AS n FROM placed
    UNION ALL
    SELECT grp, lvl + 1, pos // 8, sha256(string_agg(node, '' ORDER BY pos)), any_value((n + 7) // 8)
    FROM tree WHERE n > 1 GROUP BY grp, lvl, pos // 8
), subroots AS (
    SELECT grp, node AS subroot, row_number() OVER (ORDER BY grp) - 1 AS pos FROM tree WHERE n = 1
), crown AS (
    SELECT 0 AS lvl, pos, subroot AS node, count(*) OVER () AS n FROM subroots
    UNION ALL
    SELECT lvl + 1, pos // 8, sha256(string_agg(node, '' ORDER BY pos)), any_value((n + 7) // 8)
    FROM crown WHERE n > 1 GROUP BY lvl, pos // 8
), nodes AS (
    SELECT grp, lvl, pos, node FROM tree WHERE n > 1 UNION ALL SELECT '', lvl, pos, node FROM crown WHERE n > 1
), sides AS (
    SELECT a.grp, a.lvl, a.pos,
           coalesce(string_agg(b.node, '' ORDER BY b.pos) FILTER (b.pos < a.pos), '') AS before,
           coalesce(string_agg(b.node, '' ORDER BY b.pos) FILTER (b.pos > a.pos), '') AS after
    FROM nodes AS a JOIN nodes AS b ON a.grp = b.grp AND a.lvl = b.lvl AND a.pos // 8 = b.pos // 8
    GROUP BY ALL
), steps AS (
    SELECT p.grp, p.pos, s.lvl, before, after
    FROM placed AS p JOIN sides AS s ON p.grp = s.grp AND s.pos = p.pos >> (3 * s.lvl)
    UNION ALL
    SELECT p.grp, p.pos, 99 + s.lvl, before, after
    FROM placed AS p JOIN subroots AS r USING (grp) JOIN sides AS s ON s.grp = '' AND s.pos = r.pos >> (3 * s.lvl)
), proofs AS (
    SELECT grp, pos, string_agg(before || after, '' ORDER BY lvl) AS siblings,
           list({before: before, after: after} ORDER BY lvl) AS steps
    FROM steps GROUP BY grp, pos
), folded AS (
    SELECT doc_id, leaf, subroot, c.node AS root, sha256(coalesce(siblings, '')) AS proof_sha256,
           list_reduce(coalesce(proofs.steps, []), lambda acc, s: {before: sha256(s.before || acc.before || s.after), after: ''},
               {before: coalesce(tampered, leaf), after: ''}).before AS folded_root
    FROM placed JOIN subroots USING (grp) LEFT JOIN proofs ON proofs.grp = placed.grp AND proofs.pos = placed.pos,
         (SELECT node FROM crown WHERE n = 1) AS c
)
SELECT *, folded_root = root AS verified FROM folded
"""

HARD_NEGATIVES = """
WITH v AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
           list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS terms
    FROM embeddings
    WHERE embedding IS NOT NULL AND vec_id IS NOT NULL AND label IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
    SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS alike,
           list_inner_product(a.terms, c.terms)::BIGINT AS score
    FROM v AS a JOIN v AS c ON a.vec_id <> c.vec_id AND len(a.terms) = len(c.terms)
    WHERE a.vec_id % 100 = 0
), positives AS (
    SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE alike
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT anchor_id, positive_id, (row_number() OVER best)::INTEGER AS rank, vec_id AS negative_id, positive_score,
       score AS negative_score
FROM positives JOIN scored USING (anchor_id)
WHERE NOT alike AND 80 * positive_score <= 100 * score AND 100 * score <= 100 * positive_score
WINDOW best AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id)
QUALIFY row_number() OVER best <= 5
"""

# The prior of the hosts' failure rates is fitted by moments, from the spread beyond chance.
HOST_RULES = r"""
WITH d AS (
    SELECT doc_id, source, coalesce(text, '') AS text,
           regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
    FROM documents
), windows AS (
    SELECT doc_id, pos, words[pos:pos + 2] AS three FROM d, unnest(range(1, len(words) - 1)) AS r(pos)
), repeated AS (
    SELECT doc_id, pos FROM windows QUALIFY count(*) OVER (PARTITION BY doc_id, three) > 1
), covered AS (
    SELECT doc_id, count(DISTINCT pos + step) AS n FROM repeated, (SELECT unnest(range(3)) AS step) GROUP BY doc_id
), lines AS (
    SELECT doc_id, list_filter(string_split(text, chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS lines
    FROM d
), m AS (
    SELECT doc_id, source, len(words)::BIGINT AS n_words, length(array_to_string(words, ''))::BIGINT AS word_chars,
           len(regexp_extract_all(text, '[#*$%&|<>]'))::BIGINT AS n_symbols, len(lines)::BIGINT AS n_lines,
           (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, coalesce(n, 0)::BIGINT AS n_repeat_words
    FROM d JOIN lines USING (doc_id) LEFT JOIN covered USING (doc_id)
), ruled AS (
    SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
           100 * n_repeat_words > 25 * n_words OR 100 * n_symbols > 10 * n_words OR 100 * n_dup_lines > 30 * n_lines
               OR word_chars < 2 * n_words OR word_chars > 15 * n_words AS failed
    FROM m
), hosts AS (
    SELECT source, count(*)::DOUBLE AS docs, sum((base_failed OR failed)::INTEGER)::DOUBLE AS bad
    FROM ruled GROUP BY source
), moments AS (
    SELECT sum(bad) / sum(docs) AS mean, sum(docs) AS docs, count(*) - 1 AS more, sum(docs * docs) AS squares,
           sum(bad * bad / docs) AS spread
    FROM hosts
), excess AS (
    SELECT mean, (docs - squares / docs - more) * mean * (1 - mean) AS room,
           spread - docs * mean * mean - more * mean * (1 - mean) AS over
    FROM moments
), prior AS (
    SELECT mean, CASE WHEN room > 0 AND over > 0 THEN 1 / least(over / room, 1) - 1 END AS strength FROM excess
), rated AS (
    SELECT source, coalesce((bad + strength * mean) / (docs + strength), mean) AS rate FROM hosts, prior
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       CASE WHEN rate >= 0.5 THEN 'blocked' WHEN rate >= 0.02 THEN 'watched' ELSE 'trusted' END AS verdict,
       NOT base_failed AND (rate < 0.02 OR rate < 0.5 AND NOT failed) AS kept
FROM ruled JOIN rated ON ruled.source IS NOT DISTINCT FROM rated.source
"""

# Texts as hex, so that a byte is two characters.
SUFFIX_ARRAY_DEDUP = """
WITH texts AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
-- Stretches of 1000 window starts: a substring costs what its string is long.
stretches AS (
    SELECT doc_id, base, substr(h, 2 * base + 1, 2 * 1049) AS part
    FROM (SELECT *, unnest(range(0, length(h) // 2, 1000)) AS base FROM texts)
),
starts AS (SELECT *, unnest(range(0, greatest(0, length(part) // 2 - 49))) AS j FROM stretches),
windows AS (SELECT doc_id, base + j AS i, substr(part, 2 * j + 1, 100) AS s FROM starts),
firsts AS (SELECT s, min(doc_id) AS least FROM windows GROUP BY s HAVING min(doc_id) < max(doc_id)),
covered AS (SELECT doc_id, i FROM windows JOIN firsts USING (s) WHERE least < doc_id),
steps AS (SELECT doc_id, i, i - lag(i) OVER (PARTITION BY doc_id ORDER BY i) AS gap FROM covered),
numbered AS (
    SELECT doc_id, i, count(*) FILTER (gap IS NULL OR gap > 50) OVER (PARTITION BY doc_id ORDER BY i) AS span
    FROM steps
),
spans AS (SELECT doc_id, span, min(i) AS a, max(i) + 50 AS b FROM numbered GROUP BY doc_id, span),
bounded AS (SELECT *, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS last_b FROM spans),
removed AS (
    SELECT doc_id, sum(b - a)::BIGINT AS n_removed, count(*) AS n_spans, max(b) AS tail,
        string_agg(substr(h, 2 * last_b + 1, 2 * (a - last_b)), '' ORDER BY a) AS head
    FROM bounded JOIN texts USING (doc_id) GROUP BY doc_id
)
SELECT doc_id, length(h) // 2 AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
    sha256(unhex(coalesce(head, '') || substr(h, 2 * coalesce(tail, 0) + 1))) AS kept_sha256
FROM texts LEFT JOIN removed USING (doc_id)
"""

ORACLE_SQL: dict[str, str] = {
    "op2_exact_dedup": EXACT_DEDUP,
    "op4_substring_dedup": SUBSTRING_DEDUP,
    "op6_mixing": MIXING,
    "op7_suffix_array_dedup": SUFFIX_ARRAY_DEDUP,
    "op9_exact_topk": TOP_K,
    "op11_merkle": MERKLE,
    "op12_hard_negatives": HARD_NEGATIVES,
    "op13_host_rules": HOST_RULES,
}
