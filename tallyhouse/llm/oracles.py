"""SQL answers of the queries that SQL can express."""

from __future__ import annotations

from string import ascii_lowercase, ascii_uppercase

from tallyhouse.llm import quality_rules as q

WORDS = "regexp_extract_all({0}, '[^\\x20\\x09-\\x0D]+')"

NEAR_DUPLICATES = f"""
    WITH RECURSIVE w AS (
        SELECT doc_id, {WORDS.format(f"translate(coalesce(text, ''), '{ascii_uppercase}', '{ascii_lowercase}')")} AS ws FROM documents),
    s AS (
        SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
            ELSE list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' ')) END) AS g FROM w),
    n AS (SELECT doc_id, count(*) AS n, md5(string_agg(g, chr(10) ORDER BY g)) AS set_name FROM s GROUP BY doc_id),
    c AS (SELECT doc_id, n, min(doc_id) OVER (PARTITION BY set_name) AS class_id FROM n),
    common AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS shared FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL),
    links AS (SELECT x, y FROM common JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y WHERE 100 * shared >= 85 * (a.n + b.n - shared)),
    reached AS (SELECT doc_id, doc_id AS root FROM documents UNION SELECT links.y, root FROM reached JOIN links ON links.x = reached.doc_id)
    SELECT doc_id, coalesce(c.n, 0) AS n_shingles, min(root) AS component_id, doc_id = min(root) AS kept, c.class_id
    FROM reached LEFT JOIN c USING (doc_id) GROUP BY doc_id, c.n, c.class_id"""

REPEATED_STRINGS = """
    WITH b AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
    windows AS (SELECT doc_id, p, md5(substr(h, 2 * p + 1, 200)) AS bytes
                FROM (SELECT doc_id, h, unnest(range(0, length(h) // 2 - 99)) AS p FROM b)),
    later AS (SELECT doc_id, p FROM windows QUALIFY row_number() OVER (PARTITION BY bytes ORDER BY doc_id, p) > 1),
    marked AS (SELECT doc_id, p, coalesce(p - lag(p) OVER (PARTITION BY doc_id ORDER BY p) > 100, true) AS fresh FROM later),
    numbered AS (SELECT doc_id, p, sum(CAST(fresh AS INT)) OVER (PARTITION BY doc_id ORDER BY p) AS run FROM marked),
    spans AS (SELECT doc_id, min(p) AS a, max(p) + 100 AS z FROM numbered GROUP BY doc_id, run),
    gaps AS (
        SELECT doc_id, coalesce(lag(z) OVER (PARTITION BY doc_id ORDER BY a), 0) AS a, a AS z FROM spans
        UNION ALL SELECT doc_id, coalesce(max(z), 0), max(length(h)) // 2 FROM b LEFT JOIN spans USING (doc_id) GROUP BY doc_id),
    kept AS (SELECT doc_id, string_agg(substr(h, 2 * gaps.a + 1, 2 * (gaps.z - gaps.a)), '' ORDER BY gaps.a) AS h
             FROM gaps JOIN b USING (doc_id) GROUP BY doc_id),
    removed AS (SELECT doc_id, sum(z - a) AS n_removed, count(*) AS n_spans FROM spans GROUP BY doc_id)
    SELECT doc_id, length(b.h) // 2 AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
           coalesce(n_spans, 0) AS n_spans, sha256(unhex(kept.h)) AS kept_sha256
    FROM b JOIN kept USING (doc_id) LEFT JOIN removed USING (doc_id)"""

_BINS = ", ".join(f"'{w}'" for w in q.BINS)
_DISTANCE = """sqrt(greatest(sum(CASE WHEN p > 0 THEN p * log2(2 * p / (p + r)) ELSE 0 END + CASE WHEN r > 0 THEN r * log2(2 * r / (p + r)) ELSE 0 END), 0) / 2)"""

QUALITY = f"""
    WITH t AS (SELECT doc_id, lang, coalesce(text, '') AS text FROM documents),
    w AS (SELECT *, {WORDS.format("text")} AS ws, regexp_replace(text, '[\\x20\\x09-\\x0D]+', '', 'g') AS bare FROM t),
    r AS (SELECT *, regexp_replace(bare, '[\\p{{Ll}}\\p{{Lo}}\\p{{M}}]+', '', 'g') AS rest FROM w),
    windows AS (SELECT doc_id, i, ws[i] AS a, ws[i + 1] AS b, ws[i + 2] AS c FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 1)) AS i FROM w)),
    again AS (SELECT doc_id, i FROM windows QUALIFY count(*) OVER (PARTITION BY doc_id, a, b, c) > 1),
    covered AS (SELECT doc_id, count(DISTINCT j) AS n FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS j FROM again) GROUP BY doc_id),
    lines AS (SELECT doc_id, count(*) - count(DISTINCT line) AS n FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM t)
              WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]') GROUP BY doc_id),
    classes AS (
        SELECT doc_id, lang, unnest([0, 1, 2, 3, 4, 5]) AS bin, unnest([length(bare) - length(rest),
            length(regexp_replace(rest, '[^\\p{{Lu}}\\p{{Lt}}]+', '', 'g')), length(regexp_replace(rest, '[^\\p{{N}}]+', '', 'g')), length(text) - length(bare),
            length(regexp_replace(rest, '[^.,;:!?''"()\\-]+', '', 'g')),
            length(regexp_replace(rest, '[\\p{{Lu}}\\p{{Lt}}\\p{{N}}.,;:!?''"()\\-]+', '', 'g'))]) AS n, length(text) AS total FROM r),
    small AS (SELECT doc_id, lang, lower(unnest(ws)) AS bin FROM w),
    found AS (SELECT doc_id, bin, count(*) AS n FROM small WHERE bin IN ({_BINS}) GROUP BY ALL),
    bins AS (SELECT unnest([{_BINS}]) AS bin),
    size AS (SELECT doc_id, lang, len(ws) AS total FROM w),
    class_refs AS (SELECT lang, bin, sum(n) / sum(total) AS r FROM classes WHERE lang IS NOT NULL GROUP BY ALL),
    sums AS (SELECT lang, bin, sum(n) AS n FROM found JOIN size USING (doc_id) WHERE lang IS NOT NULL GROUP BY ALL),
    totals AS (SELECT lang, sum(total) AS total FROM size WHERE lang IS NOT NULL GROUP BY ALL),
    word_refs AS (SELECT lang, bin, coalesce(n, 0) / total AS r FROM totals CROSS JOIN bins LEFT JOIN sums USING (lang, bin)),
    word_shares AS (SELECT doc_id, bin, coalesce(n, 0) / total AS p FROM (FROM size WHERE total >= {q.MIN_WORDS}) CROSS JOIN bins LEFT JOIN found USING (doc_id, bin)),
    word_pairs AS (
        SELECT doc_id, word_refs.lang, p, r FROM word_shares JOIN word_refs USING (bin)
        UNION ALL SELECT doc_id, o.lang, p, r FROM (SELECT doc_id, greatest(1 - sum(p), 0) AS p FROM word_shares GROUP BY doc_id)
            CROSS JOIN (SELECT lang, 1 - sum(r) AS r FROM word_refs GROUP BY lang) o),
    word_far AS (SELECT doc_id, min(d) AS d FROM (SELECT doc_id, lang, {_DISTANCE} AS d FROM word_pairs GROUP BY ALL) GROUP BY doc_id),
    class_far AS (SELECT doc_id, min(d) AS d FROM (SELECT doc_id, f.lang, {_DISTANCE} AS d FROM
        (SELECT doc_id, bin, n / total AS p FROM classes WHERE total >= {q.MIN_CHARS}) JOIN class_refs f USING (bin) GROUP BY ALL) GROUP BY doc_id),
    base AS (SELECT doc_id, len(ws) AS n_words, length(bare) AS word_chars, length(rest) - length(translate(rest, '#*$%&|<>', '')) AS n_symbols,
                    coalesce(lines.n, 0) AS n_dup_lines, coalesce(covered.n, 0) AS n_repeat_words
             FROM r LEFT JOIN lines USING (doc_id) LEFT JOIN covered USING (doc_id))
    SELECT base.*, n_words < {q.LEAST_WORDS} OR 100 * n_repeat_words > {q.MOST_REPEATED_PERCENT} * n_words AS base_failed,
           NOT base_failed AND coalesce(word_far.d, 0) <= {q.MAX_WORD_DISTANCE} AND coalesce(class_far.d, 0) <= {q.MAX_CLASS_DISTANCE} AS kept
    FROM base LEFT JOIN word_far USING (doc_id) LEFT JOIN class_far USING (doc_id)"""

RESAMPLED = f"""
    WITH codes AS (SELECT list_transform(range(256), lambda n: list_reduce(list_prepend(n, range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS tab),
    texts AS (SELECT false AS wanted, doc_id, text FROM documents UNION ALL SELECT true, NULL, text FROM benchmark),
    w AS (SELECT wanted, doc_id, regexp_extract_all(translate(coalesce(text, ''), '{ascii_uppercase}', '{ascii_lowercase}'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS ws FROM texts),
    f AS (SELECT wanted, doc_id, unnest(list_concat(ws, list_transform(range(1, len(ws)), lambda i: ws[i] || ' ' || ws[i + 1]))) AS feature FROM w),
    n AS (SELECT wanted, doc_id, feature, count(*) AS n FROM f GROUP BY ALL),
    named AS (SELECT feature, hex(encode(feature)) AS h FROM (SELECT DISTINCT feature FROM n)),
    crcs AS (SELECT feature, xor(list_reduce(list_prepend(4294967295, list_transform(range(1, length(h), 2), lambda i: 16 * (instr('0123456789ABCDEF', h[i]) - 1) + instr('0123456789ABCDEF', h[i + 1]) - 1)),
        lambda c, b: xor(c >> 8, tab[(xor(c, b) & 255) + 1])), 4294967295) % 10000 AS bucket FROM named, codes),
    counted AS (SELECT wanted, doc_id, bucket, CAST(sum(n) AS BIGINT) AS n FROM n JOIN crcs USING (feature) GROUP BY ALL),
    sums AS (SELECT coalesce(CAST(sum(n) FILTER (WHERE NOT wanted) AS BIGINT), 0) AS s_all, coalesce(CAST(sum(n) FILTER (WHERE wanted) AS BIGINT), 0) AS t_all FROM counted),
    buckets AS (SELECT bucket, coalesce(CAST(sum(n) FILTER (WHERE NOT wanted) AS BIGINT), 0) AS s, coalesce(CAST(sum(n) FILTER (WHERE wanted) AS BIGINT), 0) AS t FROM counted GROUP BY bucket),
    gains AS (SELECT bucket, floor(1000 * ln(CAST((t + 1) * (s_all + 10000) AS DOUBLE) / CAST((s + 1) * (t_all + 10000) AS DOUBLE))) AS gain FROM buckets, sums),
    weights AS (SELECT doc_id, CAST(sum(n) AS BIGINT) AS n_features, CAST(floor(sum(n * gain) / sum(n)) AS BIGINT) AS weight FROM counted JOIN gains USING (bucket) WHERE NOT wanted GROUP BY doc_id),
    noise AS (SELECT doc_id, len(ws) AS n_words, list_reduce(list_prepend(0, list_transform(range(1, 9), lambda i: instr('0123456789abcdef', sha256('7:' || doc_id)[i]) - 1)), lambda a, d: 16 * a + d) AS h FROM w WHERE NOT wanted),
    scored AS (SELECT doc_id, n_words, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight, coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296.0::DOUBLE))) AS BIGINT) AS score FROM noise LEFT JOIN weights USING (doc_id)),
    placed AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS place, count(*) OVER () AS n FROM scored WHERE n_words >= 20)
    SELECT doc_id, n_features, weight, score, CASE WHEN place <= 25 * n // 100 THEN place END AS rank FROM scored LEFT JOIN placed USING (doc_id)"""

HARD_NEGATIVES = """
    WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS parts
               FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    s AS (SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, CAST(list_inner_product(a.parts, b.parts) AS BIGINT) AS score FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0),
    p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5),
    n AS (SELECT anchor_id, positive_id, positive_score, vec_id AS negative_id, score AS negative_score FROM p JOIN s USING (anchor_id) WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score)
    SELECT anchor_id, positive_id, CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY negative_score DESC, negative_id) AS INT) AS rank, negative_id, positive_score, negative_score
    FROM n QUALIFY rank <= 3"""
