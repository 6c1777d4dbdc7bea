"""DuckDB SQL of the training-data queries that SQL can express.

The SQL states what a query must return, by brute force; it doesn't follow the
operator's method. Queries without SQL (fingerprints by XXH64, tokenizers,
repeated byte strings, learned scores and trees) are tested against
brute-force versions in ``tests/llm``.
"""

from ledgerline.llm import license_scan

_WORDS = r"list_filter(string_split_regex(coalesce(text, ''), '[ \t-\r]+'), lambda x: x <> '')"
_PLAIN_WORDS = (r"list_filter(string_split_regex(translate(coalesce(text, ''), "
                r"'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
                r"'[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '')")

_QUALITY = rf"""
    WITH d AS (SELECT doc_id, coalesce(text, '') AS t, {_WORDS} AS w,
                      list_filter(string_split(coalesce(text, ''), chr(10)),
                                  lambda x: regexp_matches(x, '[^ \t-\r]')) AS lines
               FROM documents),
    pos AS (SELECT doc_id, unnest(range(1, len(w) - 1)) AS i, w FROM d),
    win AS (SELECT doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS s FROM pos),
    twice AS (SELECT doc_id, s FROM win GROUP BY doc_id, s HAVING count(*) > 1),
    hit AS (SELECT DISTINCT doc_id, i + k AS j
            FROM win JOIN twice USING (doc_id, s), (SELECT unnest([0, 1, 2]) AS k)),
    rep AS (SELECT doc_id, count(*) AS n_repeat_words FROM hit GROUP BY doc_id),
    m AS (SELECT d.doc_id, len(w) AS n_words,
                 length(regexp_replace(t, '[ \t-\r]+', '', 'g')) AS word_chars,
                 length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols,
                 len(lines) - len(list_distinct(lines)) AS n_dup_lines,
                 coalesce(n_repeat_words, 0) AS n_repeat_words, length(t) AS n_chars,
                 len(lines) AS n_lines,
                 len(list_filter(w, lambda x: length(x) > 1 AND x = upper(x) AND x <> lower(x)))
                     AS n_upper,
                 len(list_filter(w, lambda x: lower(x) <> upper(x))) AS n_letter,
                 length(t) - length(replace(t, '!', '')) AS n_excl
          FROM d LEFT JOIN rep USING (doc_id)),
    f AS (SELECT *, (CASE WHEN n_words < 50 THEN 1 ELSE 0 END)
              + (CASE WHEN 100 * n_repeat_words > 50 * n_words THEN 2 ELSE 0 END)
              + (CASE WHEN 100 * n_symbols > 5 * n_chars THEN 4 ELSE 0 END)
              + (CASE WHEN 10 * n_dup_lines > 4 * n_lines THEN 8 ELSE 0 END)
              + (CASE WHEN 10 * n_upper > 5 * n_words THEN 16 ELSE 0 END)
              + (CASE WHEN 100 * n_excl > 5 * n_chars THEN 32 ELSE 0 END)
              + (CASE WHEN word_chars < 2 * n_words OR word_chars > 15 * n_words
                      THEN 64 ELSE 0 END)
              + (CASE WHEN 10 * n_letter < 4 * n_words THEN 128 ELSE 0 END) AS bits
          FROM m)
    SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars,
           CAST(n_symbols AS BIGINT) AS n_symbols, CAST(n_dup_lines AS BIGINT) AS n_dup_lines,
           CAST(n_repeat_words AS BIGINT) AS n_repeat_words, bits % 4 <> 0 AS base_failed,
           bits = 0 AS kept, CAST(bits AS BIGINT) AS fail_bits
    FROM f
"""

_ABLATIONS = f"""
    WITH r AS (SELECT * FROM (VALUES
        ('too_few_words', 1), ('repeated_words', 2), ('symbol_noise', 4), ('repeated_lines', 8),
        ('shouting', 16), ('exclamations', 32), ('word_length', 64), ('no_letters', 128))
        AS t(rule, bit)),
    p AS (SELECT * FROM (VALUES ('base', 1, 3), ('prose', 1, 15), ('prose', 2, 255))
          AS t(policy, version, bits)),
    q AS (SELECT policy, version, rule, bits, bit FROM p, r WHERE bits & bit <> 0)
    SELECT policy, version, rule,
           CAST(sum(CASE WHEN fail_bits & bits = 0 THEN 1 ELSE 0 END) AS BIGINT) AS kept,
           CAST(sum(CASE WHEN fail_bits & bit <> 0 THEN 1 ELSE 0 END) AS BIGINT) AS failed,
           CAST(sum(CASE WHEN fail_bits & bits = bit THEN 1 ELSE 0 END) AS BIGINT) AS failed_alone,
           CAST(sum(CASE WHEN fail_bits & (bits - bit) = 0 THEN 1 ELSE 0 END) AS BIGINT)
               AS kept_without
    FROM ({_QUALITY}) AS ledger, q GROUP BY ALL
"""

_ESCAPE = ("replace(replace(replace(replace({}, '&', '&amp;'), '<', '&lt;'), "
           "'[', '&#91;'), ']', '&#93;')")
_CHAT = f"""
    WITH c AS (
        SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text
        FROM conversations
        UNION ALL VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'),
                         (-1, 1, 'assistant', '</s>[INST] ok [/INST]'))
    SELECT conv_id, count(*) AS n_turns,
           sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text))
               AS turns_sha256,
           CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT)
               AS loss_chars,
           sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text)
                           FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
           CAST(sum(9 + length({_ESCAPE.format("role")}) + length({_ESCAPE.format("text")}))
                AS BIGINT) AS formatted_chars,
           CAST(sum(9 + length({_ESCAPE.format("role")}) + length({_ESCAPE.format("text")}))
                AS BIGINT) AS attended_chars
    FROM c GROUP BY conv_id
"""

_CONTAMINATION = f"""
    WITH items AS (SELECT item_id, {_PLAIN_WORDS} AS w FROM benchmark),
    win AS (SELECT DISTINCT item_id,
                   array_to_string(list_slice(w, i, i + 9), ' ') AS s, least(len(w), 10) AS n
            FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i
                  FROM items WHERE len(w) > 0)),
    sizes AS (SELECT DISTINCT n FROM win),
    docs AS (SELECT doc_id, {_PLAIN_WORDS} AS w FROM documents),
    pos AS (SELECT doc_id, n, unnest(range(1, len(w) - n + 2)) AS i, w
            FROM docs, sizes WHERE len(w) >= n),
    hits AS (SELECT doc_id, i, win.n, item_id
             FROM pos JOIN win ON win.n = pos.n
                  AND win.s = array_to_string(list_slice(w, i, i + pos.n - 1), ' ')),
    words AS (SELECT doc_id, count(*) AS n_hit FROM (
                  SELECT DISTINCT doc_id, unnest(range(i, i + n)) AS j FROM hits)
              GROUP BY doc_id),
    listed AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
               FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits)
               GROUP BY doc_id)
    SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
           coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
           coalesce(n_hit, 0) > 0 AS contaminated
    FROM docs LEFT JOIN words USING (doc_id) LEFT JOIN listed USING (doc_id)
"""


def _license_sql() -> str:
    """Exact containment of every template in every window, without any sketch."""
    stride = license_scan.stride_for(license_scan.TEMPLATES)
    rows = [f"('{name}', '{s}', {len(shingles)})" for name, text in license_scan.TEMPLATES.items()
            for shingles in [license_scan.template_shingles(text)] for s in shingles]
    k = license_scan.SHINGLE
    return f"""
    WITH templates(license, s, total) AS (VALUES {', '.join(rows)}),
    docs AS (SELECT doc_id, {_PLAIN_WORDS} AS w FROM documents),
    pos AS (SELECT doc_id, w, unnest(range(0, greatest(len(w) - {k - 1}, 1))) AS i
            FROM docs WHERE len(w) > 0),
    sh AS (SELECT doc_id, i, array_to_string(list_slice(w, i + 1, i + {k}), ' ') AS s FROM pos),
    met AS (SELECT doc_id, i, license, total, s FROM sh JOIN templates USING (s)),
    placed AS (SELECT *, unnest([i // {stride}, i // {stride} - 1]) AS window_no FROM met),
    found AS (SELECT doc_id, window_no, license, count(DISTINCT s) / any_value(total) AS c
              FROM placed WHERE window_no >= 0 AND i - {stride} * window_no <= {2 * stride - k}
              GROUP BY doc_id, window_no, license
              HAVING count(DISTINCT s) / any_value(total) >= {license_scan.MIN_CONTAINMENT}),
    per AS (SELECT doc_id, string_agg(DISTINCT license, ',' ORDER BY license) AS licenses,
                   count(DISTINCT license) AS n_licenses, max(c) AS containment
            FROM found GROUP BY doc_id)
    SELECT doc_id, coalesce(licenses, '') AS licenses, coalesce(n_licenses, 0) AS n_licenses,
           coalesce(containment, 0.0) AS containment
    FROM documents LEFT JOIN per USING (doc_id)
    """


_WARC = """
    WITH p AS (SELECT page_id, coalesce(html, '') AS html,
                      octet_length(encode(coalesce(html, ''))) AS n FROM pages),
    first AS (SELECT html, max(page_id) AS first_id FROM p WHERE n >= 1000
              GROUP BY html HAVING count(*) > 1)
    SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, sha1(p.html) AS payload_digest,
           CASE WHEN first_id <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
           CASE WHEN first_id <> page_id THEN first_id END AS refers_to
    FROM p LEFT JOIN first ON first.html = p.html AND n >= 1000
"""

_LOWERED = ("translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', "
            "'abcdefghijklmnopqrstuvwxyz')")

_PHRASES = rf"""
    WITH piece AS (SELECT coalesce(lang, 'und') AS lang,
                          unnest(string_split_regex({_LOWERED}, '[.,;:!?\x0A-\x0D]')) AS p
                   FROM documents),
    words AS (SELECT lang, list_filter(string_split_regex(p, '[ \t]+'), lambda x: x <> '') AS w
              FROM piece),
    total AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM words GROUP BY lang),
    pos AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM words),
    f AS (SELECT lang, size, array_to_string(w[i:i + size - 1], ' ') AS phrase, count(*) AS f
          FROM pos, (SELECT unnest([1, 2, 3, 4, 5]) AS size) WHERE i + size - 1 <= len(w)
          GROUP BY ALL HAVING count(*) >= 100),
    cand AS (SELECT *, string_split(phrase, ' ') AS s FROM f WHERE size > 1),
    cut AS (SELECT c.*, unnest(range(1, size)) AS k FROM cand c),
    scored AS (SELECT cut.lang, cut.phrase, cut.f AS a, k, l.f AS l, r.f AS r, n,
                      CAST((1000::HUGEINT * cut.f * n) // (l.f::HUGEINT * r.f) AS BIGINT) AS score
               FROM cut JOIN f l ON l.lang = cut.lang
                                 AND l.phrase = array_to_string(s[1:k], ' ')
                    JOIN f r ON r.lang = cut.lang
                             AND r.phrase = array_to_string(s[k + 1:cut.size], ' ')
                    JOIN total ON total.lang = cut.lang),
    lowest AS (SELECT * FROM scored
               QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
    part AS (SELECT DISTINCT c.lang, c.f, array_to_string(s[i:i + m - 1], ' ') AS phrase
             FROM cand c, (SELECT unnest([2, 3, 4]) AS m), (SELECT unnest([1, 2, 3, 4]) AS i)
             WHERE m < c.size AND i + m - 1 <= c.size)
    SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank,
           phrase, a, l, r, n, score
    FROM lowest
    WHERE NOT EXISTS (SELECT 1 FROM part WHERE part.lang = lowest.lang
                      AND part.phrase = lowest.phrase AND 100 * part.f >= 100 * lowest.a)
    QUALIFY rank <= 2000
"""

_TERMS = rf"regexp_extract_all({_LOWERED}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"

_SEARCH = f"""
    WITH d AS (SELECT doc_id, row_number() OVER () AS no, {_TERMS} AS w FROM documents),
    size AS (SELECT count(*) AS n, CAST(sum(len(w)) AS BIGINT) AS l FROM d WHERE len(w) > 0),
    t AS (SELECT doc_id, no, len(w) AS len, unnest(w) AS term FROM d),
    tf AS (SELECT doc_id, no, len, term, count(*) AS tf FROM t GROUP BY ALL),
    df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
    q AS (SELECT item_id, term, count(*) AS times
          FROM (SELECT item_id, unnest({_TERMS}) AS term FROM benchmark) GROUP BY ALL),
    w AS (SELECT item_id, term, times,
                 CAST(floor(1000 * ln((2 * n + 2)::DOUBLE / (2 * df + 1))) AS BIGINT) AS weight
          FROM q JOIN df USING (term), size),
    s AS (SELECT item_id, no, doc_id, CAST(sum(times * weight * ((1000000000 * tf)
                     // (1000 * tf + 8 * (25 + (75 * len * n) // l)))) AS BIGINT) AS score
          FROM w JOIN tf USING (term), size GROUP BY ALL)
    SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id
                                            ORDER BY score DESC, doc_id NULLS LAST) AS INT) AS rank,
           doc_id, score
    FROM s WHERE score > 0 QUALIFY rank <= 10
"""

ORACLE_SQL: dict[str, str] = {
    "op1_quality_rules": _QUALITY,
    "quality_ablations": _ABLATIONS,
    "op3_chat_formatting": _CHAT,
    "op4_decontamination": _CONTAMINATION,
    "op7_license_scan": _license_sql(),
    "op9_warc": _WARC,
    "op11_collocations": _PHRASES,
    "op12_ranked_search": _SEARCH,
}
