"""The registered queries of the training-data operators in SQL, where SQL can express them."""

OP1 = r"""
WITH turns AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
    UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
), sized AS (
    SELECT *,
        length(text) + len(regexp_extract_all(text, '</?s>|\[/?INST\]|\[/?ROLE\]|\[END\]|\\')) AS body,
        length(role) + len(regexp_extract_all(role, '</?s>|\[/?INST\]|\[/?ROLE\]|\[END\]|\\')) AS head
    FROM turns
)
SELECT conv_id, count(*) AS n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
    CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
    sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), ''))
        AS loss_sha256,
    CAST(3 + sum(body + CASE role WHEN 'user' THEN 15 WHEN 'assistant' THEN 4 ELSE 19 + head END)
        AS BIGINT) AS formatted_chars
FROM sized GROUP BY conv_id
"""

OP7 = r"""
WITH split AS (
    SELECT page_id,
        CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest
    FROM pages
), parts AS (
    SELECT page_id,
        translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
            'abcdefghijklmnopqrstuvwxyz') AS host,
        regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path,
        TRY_CAST(regexp_extract(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1),
            '^/[a-z]{2}/([0-9]+)(?:/|\.html)?$', 1) AS BIGINT) AS shown
    FROM split
), outcomes AS (
    SELECT doc_id, count(bad) AS n, sum(bad) AS b FROM (
        SELECT doc_id, CASE WHEN quality = 0 OR toxic = 1 THEN 1
            WHEN quality = 1 OR toxic = 0 THEN 0 END AS bad FROM labels)
    WHERE bad IS NOT NULL GROUP BY doc_id
), hosts AS (
    SELECT host, coalesce(sum(n), 0) AS n, coalesce(sum(b), 0) AS b,
        CASE WHEN len(string_split(host, '.')) <= 2 THEN host
            ELSE array_to_string(string_split(host, '.')[-2:], '.') END AS domain,
        string_split(host, '.')[-1] AS suffix
    FROM parts LEFT JOIN outcomes ON shown = doc_id GROUP BY host
), domains AS (
    SELECT domain, suffix, sum(n) AS n, sum(b) AS b FROM hosts GROUP BY ALL
), suffixes AS (
    SELECT suffix, sum(n) AS n, sum(b) AS b, 1 AS parent,
        (sum(sum(b)) OVER () + 1) / (sum(sum(n)) OVER () + 2) AS prior FROM domains GROUP BY suffix
), suffix_spread AS (
    SELECT count(*) AS g, 1 AS ps, sum(n) AS t, sum(n * pow(b / n - prior, 2)) AS bw,
        sum(n * (b / n) * (1 - b / n)) AS wi, sum(n * n) AS sq FROM suffixes WHERE n > 0
), suffix_rho AS (
    SELECT (bw / nullif(g - ps, 0) - coalesce(wi / nullif(t - g, 0), 0))
        / nullif(bw / nullif(g - ps, 0) + ((t - sq / t) / nullif(g - ps, 0) - 1)
            * coalesce(wi / nullif(t - g, 0), 0), 0) AS rho FROM suffix_spread
), suffix_weight AS (
    SELECT CASE WHEN rho IS NULL OR rho <= 0 THEN 10000.0 WHEN rho >= 1 THEN 1.0
        ELSE least(greatest((1 - rho) / rho, 1.0), 10000.0) END AS w FROM suffix_rho
), suffix_rates AS (
    SELECT suffix, (b + w * prior) / (n + w) AS prior FROM suffixes, suffix_weight
), d AS (
    SELECT domain, domains.suffix, n, b, prior FROM domains JOIN suffix_rates USING (suffix)
), domain_spread AS (
    SELECT count(*) AS g, count(DISTINCT suffix) AS ps, sum(n) AS t, sum(n * pow(b / n - prior, 2)) AS bw,
        sum(n * (b / n) * (1 - b / n)) AS wi, sum(n * n) AS sq FROM d WHERE n > 0
), domain_rho AS (
    SELECT (bw / nullif(g - ps, 0) - coalesce(wi / nullif(t - g, 0), 0))
        / nullif(bw / nullif(g - ps, 0) + ((t - sq / t) / nullif(g - ps, 0) - 1)
            * coalesce(wi / nullif(t - g, 0), 0), 0) AS rho FROM domain_spread
), domain_weight AS (
    SELECT CASE WHEN rho IS NULL OR rho <= 0 THEN 10000.0 WHEN rho >= 1 THEN 1.0
        ELSE least(greatest((1 - rho) / rho, 1.0), 10000.0) END AS w FROM domain_rho
), domain_rates AS (
    SELECT domain, (b + w * prior) / (n + w) AS prior FROM d, domain_weight
), h AS (
    SELECT host, hosts.domain, n, b, prior FROM hosts JOIN domain_rates USING (domain)
), host_spread AS (
    SELECT count(*) AS g, count(DISTINCT domain) AS ps, sum(n) AS t, sum(n * pow(b / n - prior, 2)) AS bw,
        sum(n * (b / n) * (1 - b / n)) AS wi, sum(n * n) AS sq FROM h WHERE n > 0
), host_rho AS (
    SELECT (bw / nullif(g - ps, 0) - coalesce(wi / nullif(t - g, 0), 0))
        / nullif(bw / nullif(g - ps, 0) + ((t - sq / t) / nullif(g - ps, 0) - 1)
            * coalesce(wi / nullif(t - g, 0), 0), 0) AS rho FROM host_spread
), host_weight AS (
    SELECT CASE WHEN rho IS NULL OR rho <= 0 THEN 10000.0 WHEN rho >= 1 THEN 1.0
        ELSE least(greatest((1 - rho) / rho, 1.0), 10000.0) END AS w FROM host_rho
), betas AS (
    SELECT host, b + w * prior AS alpha, n - b + w * (1 - prior) AS beta FROM h, host_weight
), judged AS (
    SELECT host, alpha / (alpha + beta)
        - 1.645 * sqrt(alpha * beta / ((alpha + beta) * (alpha + beta) * (alpha + beta + 1))) > 0.5
        AS blocked FROM betas
), ruled AS (
    SELECT page_id, host, path, CASE
        WHEN (host = 'example.net' OR host LIKE '%.example.net') AND path LIKE '/en/%' THEN 'example.net/en/'
        WHEN (host = 'example.com' OR host LIKE '%.example.com') AND path LIKE '/de/%' THEN 'example.com/de/'
        WHEN (host = 'org' OR host LIKE '%.org') AND path LIKE '/fr/%' THEN 'org/fr/'
        WHEN (host = 'net' OR host LIKE '%.net') AND path LIKE '/%' THEN 'net/' END AS rule
    FROM parts
)
SELECT page_id, host, path, rule, CASE
    WHEN rule IN ('net/', 'example.com/de/') THEN 'block'
    WHEN rule IN ('org/fr/', 'example.net/en/') THEN 'allow'
    WHEN blocked THEN 'block' ELSE 'allow' END AS verdict
FROM ruled JOIN judged USING (host)
"""

OP8 = r"""
WITH plain AS (
    SELECT doc_id, length(coalesce(text, '')) AS chars,
        sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
    FROM documents
), ranked AS (
    SELECT *, count(*) OVER same AS group_size,
        first_value(doc_id) OVER (PARTITION BY text_sha256 ORDER BY chars DESC, doc_id) AS keep_id,
        row_number() OVER (PARTITION BY text_sha256 ORDER BY chars DESC, doc_id) AS place
    FROM plain WINDOW same AS (PARTITION BY text_sha256)
)
SELECT doc_id, keep_id, group_size, place = 1 AS kept, text_sha256 FROM ranked
"""

LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP11 = r"""
WITH RECURSIVE bits AS (
    SELECT i AS byte, i AS v, 0 AS k FROM range(256) t(i)
    UNION ALL
    SELECT byte, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END, k + 1
    FROM bits WHERE k < 8
), crc_table AS (
    SELECT byte, v FROM bits WHERE k = 8
), runs AS (
    SELECT CAST(doc_id AS VARCHAR) AS doc, unnest(regexp_extract_all(LOWERED, '[A-Za-zÀ-ÿ]+')) AS run
    FROM documents
), distinct_runs AS (
    SELECT doc, run, count(*) AS c FROM runs GROUP BY ALL
), coded AS (
    SELECT doc, run, c, flatten(list_transform(string_split(doc || ':' || run, ''), lambda x:
        CASE WHEN unicode(x) < 128 THEN [unicode(x)] ELSE [195, unicode(x) - 64] END)) AS code
    FROM distinct_runs
), steps AS (
    SELECT doc, run, c, code, 1 AS pos, CAST(4294967295 AS BIGINT) AS crc FROM coded
    UNION ALL
    SELECT doc, run, c, code, pos + 1, xor(crc >> 8, v) FROM steps
    JOIN crc_table ON byte = xor(crc, CAST(code[pos] AS BIGINT)) & 255 WHERE pos <= len(code)
), marked AS (
    SELECT run, c, xor(crc, 4294967295) AS h FROM steps WHERE pos = len(code) + 1
), words AS (
    SELECT CASE WHEN h % 97 = 0 THEN
        substr(run, 1, CAST(h % length(run) AS INT)) || substr(run, CAST(h % length(run) AS INT) + 2)
        ELSE run END AS word, CAST(sum(c) AS BIGINT) AS n
    FROM marked GROUP BY 1 HAVING length(word) >= 5 AND sum(c) >= 3
), cut AS (
    SELECT word, n, substr(word, 1, i - 1) AS a, substr(word, i + 1) AS b
    FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words)
), pairs AS (
    SELECT x.word, y.word AS near, y.n AS near_n FROM cut x JOIN cut y USING (a, b) WHERE x.word <> y.word
    UNION SELECT x.word, w.word, w.n FROM cut x JOIN words w ON w.word = x.a || x.b
    UNION SELECT w.word, x.word, x.n FROM cut x JOIN words w ON w.word = x.a || x.b
), best AS (
    SELECT word, count(*) AS n_near, max(near_n) AS form_n FROM pairs GROUP BY word
), near AS (
    SELECT words.word, n, coalesce(n_near, 0) AS n_near, CASE WHEN form_n >= 2 * n THEN form_n END AS form_n
    FROM words LEFT JOIN best USING (word)
), formed AS (
    SELECT word, n, n_near, form_n, (SELECT min(near) FROM pairs
        WHERE pairs.word = near.word AND near_n = form_n) AS form FROM near
), chain AS (
    SELECT word, word AS last FROM formed
    UNION ALL SELECT chain.word, form FROM chain JOIN formed ON formed.word = last WHERE form IS NOT NULL
), roots AS (
    SELECT chain.word, last AS root FROM chain JOIN formed ON formed.word = last WHERE form IS NULL
)
SELECT word, form, root, n, n_near, form_n FROM formed JOIN roots USING (word)
""".replace("LOWERED", LOWER)

OP12 = r"""
WITH RECURSIVE split AS (
    SELECT doc_id, regexp_extract_all(LOWERED, '[^\x20\x09-\x0D]+') AS words FROM documents
), shingles AS (
    SELECT DISTINCT doc_id, array_to_string(words[i:i + 4], ' ') AS shingle FROM (
        SELECT doc_id, words, unnest(range(1, greatest(len(words) - 3, 2))) AS i
        FROM split WHERE len(words) > 0)
), sizes AS (
    SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), shared AS (
    SELECT x.doc_id AS u, y.doc_id AS v, count(*) AS c
    FROM shingles x JOIN shingles y ON x.shingle = y.shingle AND x.doc_id <> y.doc_id GROUP BY ALL
), links AS (
    SELECT u, v FROM shared JOIN sizes a ON a.doc_id = u JOIN sizes b ON b.doc_id = v
    WHERE 100 * c >= 85 * (a.n + b.n - c)
), reach AS (
    SELECT u, v FROM links UNION SELECT reach.u, links.v FROM reach JOIN links ON reach.v = links.u
), lowest AS (
    SELECT u, min(v) AS low FROM reach GROUP BY u
)
SELECT doc_id, coalesce(n, 0) AS n_shingles, least(doc_id, coalesce(low, doc_id)) AS component_id,
    doc_id = least(doc_id, coalesce(low, doc_id)) AS kept
FROM split LEFT JOIN sizes USING (doc_id) LEFT JOIN lowest ON u = doc_id
""".replace("LOWERED", LOWER)

OP13 = r"""
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(LOWERED, '[.,;:!?\x0A-\x0D]')) AS piece
    FROM documents
), split AS (
    SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS words FROM pieces
), totals AS (
    SELECT lang, CAST(sum(len(words)) AS BIGINT) AS n FROM split GROUP BY lang
), starts AS (
    SELECT lang, words, unnest(range(1, len(words) + 1)) AS i FROM split
), grams AS (
    SELECT lang, words[i:i + k - 1] AS gram FROM starts, range(1, 6) t(k) WHERE i + k - 1 <= len(words)
), frequent AS (
    SELECT lang, gram, count(*) AS f FROM grams GROUP BY ALL HAVING count(*) >= 100
), candidates AS (
    SELECT lang, gram, f AS a FROM frequent WHERE len(gram) > 1
), inner_parts AS (
    SELECT DISTINCT lang, a, gram[i:i + k - 1] AS gram FROM (
        SELECT lang, a, gram, k, unnest(range(1, len(gram) - k + 2)) AS i
        FROM (SELECT lang, a, gram, unnest(range(2, len(gram))) AS k FROM candidates))
), kept AS (
    SELECT lang, gram, a FROM candidates c WHERE NOT EXISTS (
        SELECT 1 FROM inner_parts p WHERE p.lang = c.lang AND p.gram = c.gram AND 100 * p.a >= 100 * c.a)
), cuts AS (
    SELECT lang, gram, a, k, gram[1:k] AS head, gram[k + 1:] AS rest
    FROM (SELECT lang, gram, a, unnest(range(1, len(gram))) AS k FROM kept)
), scored AS (
    SELECT cuts.lang, cuts.gram, a, k, x.f AS l, y.f AS r, n,
        (1000 * CAST(a AS HUGEINT) * n) // (CAST(x.f AS HUGEINT) * y.f) AS score
    FROM cuts JOIN frequent x ON x.lang = cuts.lang AND x.gram = head
    JOIN frequent y ON y.lang = cuts.lang AND y.gram = rest JOIN totals ON totals.lang = cuts.lang
), lowest AS (
    SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, gram ORDER BY score, k) = 1
), ranked AS (
    SELECT lang, array_to_string(gram, ' ') AS phrase, a, l, r, n, CAST(score AS BIGINT) AS score,
        row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, array_to_string(gram, ' ')) AS rank
    FROM lowest
)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked WHERE rank <= 2000
""".replace("LOWERED", LOWER)

ORACLES = {
    "op1_chat_formatting": OP1, "op7_url_filters": OP7, "op8_exact_dedup": OP8,
    "op11_spelling_variants": OP11, "op12_minhash": OP12, "op13_phrase_collocations": OP13,
}
