"""DuckDB SQL for the queries that SQL can express."""

WARC = """
WITH p AS (
    SELECT page_id, encode(coalesce(html, '')) AS body FROM pages
), d AS (
    SELECT page_id, octet_length(body) AS payload_bytes, sha1(body) AS hex FROM p
), k AS (
    SELECT hex, payload_bytes, max(page_id) AS keeper FROM d GROUP BY ALL
)
SELECT page_id,
    payload_bytes::BIGINT AS payload_bytes,
    array_to_string(list_transform(range(32), lambda i:
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567'[
            ((('0x' || substr(hex, (i // 4) * 5 + 1, 5))::BIGINT >> (15 - 5 * (i % 4))) & 31) + 1
        ]), '') AS payload_digest,
    CASE WHEN page_id < keeper THEN 'revisit' ELSE 'response' END AS record_type,
    CASE WHEN page_id < keeper THEN keeper END AS refers_to
FROM d JOIN k USING (hex, payload_bytes)
"""

CHAT = r"""
WITH rows_ AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
    UNION ALL SELECT -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'
), joined AS (
    SELECT conv_id, count(*) AS n_turns,
        string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text) AS turns,
        coalesce(string_agg(text, '' ORDER BY turn, role, text)
            FILTER (role = 'assistant'), '') AS loss,
        sum(length('<|im_start|><|im_sep|><|im_end|>')
            + length(regexp_replace(role, '<(\\*)\|', '<\\\1|', 'g'))
            + length(regexp_replace(text, '<(\\*)\|', '<\\\1|', 'g'))) AS formatted_chars
    FROM rows_ GROUP BY conv_id
)
SELECT conv_id, n_turns, sha256(turns) AS turns_sha256, length(loss)::BIGINT AS loss_chars,
    sha256(loss) AS loss_sha256, formatted_chars::BIGINT AS formatted_chars
FROM joined
"""

MIXING = r"""
WITH sized AS (
    SELECT doc_id, source,
        coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
        ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT AS hash
    FROM documents
), ranked AS (
    SELECT source, sum(size)::BIGINT AS source_size,
        [3.0, 1.0, 2.0][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1]::DOUBLE AS w
    FROM sized GROUP BY source
), levels AS (
    SELECT *,
        (1.5::DOUBLE * sum(source_size) OVER () - 2.0::DOUBLE * coalesce(sum(source_size) OVER (
            ORDER BY source_size / w, source NULLS LAST
            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
        / sum(w) OVER (
            ORDER BY source_size / w, source NULLS LAST
            ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
    FROM ranked
), chosen AS (
    SELECT min_by(level, source_size / w) FILTER (level * w <= 2.0::DOUBLE * source_size) AS level
    FROM levels
), targets AS (
    SELECT source, source_size,
        least(w * chosen.level, 2.0::DOUBLE * source_size) AS target
    FROM levels, chosen
), plan AS (
    SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END::BIGINT AS whole
    FROM targets
), hashes AS (
    SELECT source, hash, sum(size) AS size FROM sized GROUP BY ALL
), summed AS (
    SELECT h.source, hash, size, target - whole * source_size AS wanted,
        sum(size) OVER (PARTITION BY h.source ORDER BY hash) AS upto
    FROM hashes h JOIN plan p ON h.source IS NOT DISTINCT FROM p.source
), bounds AS (
    SELECT source,
        max(CASE WHEN upto < wanted OR (upto - size < wanted AND upto - wanted < wanted - upto + size)
            THEN hash ELSE -1 END) AS bound
    FROM summed WHERE wanted > 0 GROUP BY source
)
SELECT doc_id, size, source_size, target,
    size * (whole + CASE WHEN hash <= coalesce(bound, -1) THEN 1 ELSE 0 END)::BIGINT AS taken
FROM sized s JOIN plan p ON s.source IS NOT DISTINCT FROM p.source
LEFT JOIN bounds b ON s.source IS NOT DISTINCT FROM b.source
"""

DECONTAMINATE = r"""
WITH texts AS (
    SELECT FALSE AS item, row_number() OVER () AS row_no, doc_id AS id, text FROM documents
    UNION ALL SELECT TRUE, row_number() OVER (), item_id, text FROM benchmark
), cut AS (
    SELECT item, row_no, id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
    FROM texts
), wanted AS (
    SELECT DISTINCT id, size, array_to_string(w[i : i + size - 1], ' ') AS gram
    FROM (
        SELECT id, w, least(len(w), 13) AS size, unnest(range(1, len(w) - least(len(w), 13) + 2)) AS i
        FROM cut WHERE item AND len(w) > 0
    )
), grams AS (
    SELECT row_no, i, size, array_to_string(w[i : i + size - 1], ' ') AS gram
    FROM (
        SELECT row_no, w, size, unnest(range(1, len(w) - size + 2)) AS i
        FROM cut, (SELECT DISTINCT size FROM wanted) WHERE NOT item AND len(w) >= size
    )
), met AS (
    SELECT row_no, i, size, id FROM grams JOIN wanted USING (gram, size)
), words AS (
    SELECT row_no, count(DISTINCT p) AS n_hit
    FROM (SELECT row_no, unnest(range(i, i + size)) AS p FROM met) GROUP BY row_no
), items AS (
    SELECT row_no, count(DISTINCT id) AS n_items,
        string_agg(DISTINCT id::VARCHAR, ',' ORDER BY id::VARCHAR) AS ids
    FROM met GROUP BY row_no
)
SELECT id AS doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit,
    coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
    coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM cut LEFT JOIN words USING (row_no) LEFT JOIN items USING (row_no) WHERE NOT item
"""

ROLLUP = r"""
WITH c AS (
    SELECT doc_id, source, lang, coalesce(length(text), 0) AS n,
        coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS words,
        coalesce(len(regexp_extract_all(text, '[0-9A-Za-z]+|[^0-9A-Za-z\x20\x09-\x0D]')), 0) AS pieces
    FROM documents
), parts AS (
    SELECT source, lang, 'words-1' AS tokenizer, words AS tokens FROM c
    WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE quality = 0 AND doc_id IS NOT NULL)
    UNION ALL
    SELECT CASE WHEN t THEN 'quarantine' ELSE source END, lang, 'pieces-1',
        CASE WHEN t THEN ceil(n / 4.0) ELSE pieces END
    FROM (SELECT *, doc_id IN (SELECT doc_id FROM labels WHERE toxic = 1) AS t FROM c)
)
SELECT source, lang, tokenizer, count(*) AS docs, sum(tokens)::BIGINT AS tokens
FROM parts GROUP BY ALL
"""

COLLOCATIONS = r"""
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[.,;:!?\x0A-\x0D]')) AS piece
    FROM documents
), cut AS (
    SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces
), grams AS (
    SELECT lang, g, len(g) AS k, count(*) AS f FROM (
        SELECT lang, unnest(list_transform(range(1, len(w) - k + 2), lambda i: w[i : i + k - 1])) AS g
        FROM cut, (SELECT unnest([1, 2, 3, 4]) AS k) WHERE len(w) >= k
    ) GROUP BY lang, g HAVING count(*) >= 30
), longer AS (
    SELECT lang, p.g AS g, p.left_ AS left_, f FROM (
        SELECT lang, f, unnest([{'g': g[2:], 'left_': TRUE}, {'g': g[1:k - 1], 'left_': FALSE}]) AS p
        FROM grams WHERE k > 1)
), ext AS (
    SELECT lang, g, count(*) FILTER (left_) AS n_left, max(f) FILTER (left_) AS most_left,
        count(*) FILTER (NOT left_) AS n_right, max(f) FILTER (NOT left_) AS most_right
    FROM longer GROUP BY ALL
), inside AS (
    SELECT lang, unnest(list_transform(
        [[1, k - 1], [2, k], [1, k - 2], [2, k - 1], [3, k]], lambda x: g[x[1]:x[2]])) AS g, f
    FROM grams WHERE k > 2
), absorbed AS (
    SELECT lang, g, max(f) AS most FROM inside WHERE len(g) >= 2 GROUP BY ALL
), cuts AS (
    SELECT lang, g, k, f, unnest(range(1, k)) AS c FROM grams WHERE k > 1
), scored AS (
    SELECT u.lang, u.g, u.f AS a, c, x.f AS l, y.f AS r,
        (2000000::HUGEINT * u.f // (x.f + y.f))::BIGINT AS score
    FROM cuts u JOIN grams x ON x.lang = u.lang AND x.g = u.g[1:c]
    JOIN grams y ON y.lang = u.lang AND y.g = u.g[c + 1:]
), weakest AS (
    SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, c) = 1
), kept AS (
    SELECT w.*, array_to_string(w.g, ' ') AS phrase FROM weakest w LEFT JOIN absorbed b
    ON b.lang = w.lang AND b.g = w.g WHERE coalesce(100 * most < 80 * a, TRUE)
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept
), sizes AS (
    SELECT lang, sum(len(w))::BIGINT AS n FROM cut GROUP BY lang
)
SELECT s.lang, rank, phrase, a, l, r, n, score, coalesce(n_left, 0) AS n_left,
    coalesce(most_left, 0) AS most_left, coalesce(n_right, 0) AS n_right,
    coalesce(most_right, 0) AS most_right
FROM ranked s JOIN sizes USING (lang) LEFT JOIN ext e ON e.lang = s.lang AND e.g = s.g
WHERE rank <= 2000
"""

INFILL = r"""
WITH h AS (
    SELECT doc_id, coalesce(text, '') AS text, sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS d
    FROM documents
), cut AS (
    SELECT doc_id, text, regexp_extract_all(text, '[A-Za-z]+|[^A-Za-z]') AS u,
        ('0x' || d[1:8])::BIGINT AS h1, ('0x' || d[9:16])::BIGINT AS h2,
        ('0x' || d[17:24])::BIGINT AS h3, ('0x' || d[25:32])::BIGINT AS h4
    FROM h
), ranked AS (
    SELECT *, len(u)::BIGINT AS n,
        least(h1 % (len(u) + 1), h2 % (len(u) + 1)) AS low,
        greatest(h1 % (len(u) + 1), h2 % (len(u) + 1)) AS high,
        CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>')
                OR contains(text, '<M>') OR h3 % 100 >= 90 THEN 'plain'
            WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
    FROM cut
), parts AS (
    SELECT doc_id, text, n, form, array_to_string(u[1:low], '') AS p,
        array_to_string(u[low + 1:high], '') AS m, array_to_string(u[high + 1:], '') AS s
    FROM ranked
)
SELECT doc_id, n, form,
    CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars,
    CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
    sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
        ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
    sha256(text) AS restored_sha256
FROM parts
"""

ORACLES = {
    "op1_warc": WARC,
    "op2_chat": CHAT,
    "op5_mixing": MIXING,
    "op8_decontaminate": DECONTAMINATE,
    "op10_rollup": ROLLUP,
    "op12_collocations": COLLOCATIONS,
    "op13_fill_in_middle": INFILL,
}
