"""DuckDB SQL equivalents of the driver queries (same column names)."""

from __future__ import annotations

_SCD2_INPUTS = """
    early AS (SELECT DISTINCT o_custkey FROM orders WHERE o_orderdate < TIMESTAMP '1996-01-01'),
    existing AS (
        SELECT CAST(c_custkey AS VARCHAR) AS cik, c_name AS name,
               CASE WHEN c_acctbal < 0 THEN 'OLD' ELSE c_mktsegment END AS sic
        FROM customer WHERE c_custkey IN (SELECT o_custkey FROM early)),
    incoming AS (
        SELECT CAST(c_custkey AS VARCHAR) AS cik, c_name AS name, c_mktsegment AS sic
        FROM customer),
    j AS (
        SELECT e.cik AS ecik, e.name AS ename, e.sic AS esic,
               i.cik AS icik, i.name AS iname, i.sic AS isic,
               (e.cik IS NOT NULL AND i.cik IS NOT NULL
                AND (e.name IS DISTINCT FROM i.name OR e.sic IS DISTINCT FROM i.sic)) AS changed
        FROM existing e FULL OUTER JOIN incoming i ON e.cik = i.cik)
"""

_STAR_INPUTS = """
    num AS (SELECT CAST(l_orderkey AS VARCHAR) AS adsh, l_partkey AS tag_id,
                   CAST(l_shipdate AS DATE) AS ddate, l_extendedprice AS value FROM lineitem),
    sub AS (SELECT CAST(o_orderkey AS VARCHAR) AS adsh, CAST(o_custkey AS VARCHAR) AS cik
            FROM orders JOIN customer ON o_custkey = c_custkey)
"""

_NULL_COLUMNS = {
    "lineitem": ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
                 "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus",
                 "l_shipdate"],
    "orders": ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate",
               "o_orderpriority"],
    "customer": ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"],
    "part": ["p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice"],
}


def _null_counts_sql() -> str:
    parts = []
    for table, cols in _NULL_COLUMNS.items():
        for c in cols:
            parts.append(
                f"SELECT '{table}' AS table_name, '{c}' AS column_name, "
                f"CAST(count(*) FILTER (WHERE {c} IS NULL) AS BIGINT) AS null_count, "
                f"CAST(count(*) AS BIGINT) AS row_count FROM {table}")
    return "\nUNION ALL\n".join(parts)


def _orphan_sql(name: str, child: str, fk: str, parent: str, pk: str) -> str:
    return (f"SELECT '{name}' AS relation, "
            f"CAST(count(*) FILTER (WHERE {fk} NOT IN (SELECT {pk} FROM {parent} "
            f"WHERE {pk} IS NOT NULL)) AS BIGINT) AS orphan_rows, "
            f"CAST(count(*) AS BIGINT) AS checked_rows FROM {child} WHERE {fk} IS NOT NULL")


_RAW = """
    sub AS (SELECT CAST(o_orderkey AS VARCHAR) AS adsh, o_custkey AS cik, c_name AS name,
                   o_orderpriority AS form, c_mktsegment AS sic,
                   CAST(o_orderdate AS DATE) AS filed, o_orderstatus AS status
            FROM orders JOIN customer ON o_custkey = c_custkey),
    raw AS (SELECT * FROM sub WHERE filed < DATE '1998-01-01'),
    batch AS (SELECT * FROM sub WHERE filed >= DATE '1997-07-01'),
    req AS (SELECT DISTINCT CAST(l_orderkey AS VARCHAR) AS adsh FROM lineitem
            WHERE l_returnflag = 'R'),
    upd AS (SELECT DISTINCT CAST(l_orderkey AS VARCHAR) AS adsh FROM lineitem),
    last AS (SELECT CAST(l_orderkey AS VARCHAR) AS adsh,
                    max(l_linenumber) FILTER (WHERE l_returnflag = 'R') AS form_at,
                    coalesce(bool_or(l_returnflag = 'A'), FALSE) AS sic_set,
                    max(l_linenumber) FILTER (WHERE l_returnflag NOT IN ('A', 'R')) AS name_at
             FROM lineitem GROUP BY l_orderkey),
    later AS (SELECT * FROM sub WHERE filed >= DATE '1998-01-01'),
    conflicts AS (
        SELECT adsh, 'exists' AS reason FROM batch WHERE adsh IN (SELECT adsh FROM raw)
        UNION ALL
        SELECT adsh, 'duplicate_in_batch' AS reason FROM batch GROUP BY adsh HAVING count(*) > 1)
"""

_PAGE_TEXT = r"""
    trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(html,
        '(?is)<script[^>]*>.*?</script>', ' ', 'g'),
        '(?is)<style[^>]*>.*?</style>', ' ', 'g'),
        '<[^>]*>', ' ', 'g'),
        '\s+', ' ', 'g'))
"""


def _cosine(a: str, b: str) -> str:
    def dot(x, y):
        return f"list_dot_product(CAST({x} AS DOUBLE[]), CAST({y} AS DOUBLE[]))"
    return (f"(1 - {dot(a, b)} / (sqrt({dot(a, a)}) * sqrt({dot(b, b)})))")


_PROBE = "probe AS (SELECT embedding AS qv, label AS ql FROM embeddings ORDER BY vec_id LIMIT 1)"

_TFIDF = r"""
    WITH q AS (SELECT text FROM benchmark ORDER BY item_id LIMIT 1),
    toks AS (SELECT doc_id, unnest(string_split_regex(lower(text), '\s+')) AS term FROM documents),
    tf AS (SELECT doc_id, term, count(*) AS tf FROM toks WHERE term <> '' GROUP BY doc_id, term),
    n AS (SELECT CAST(count(*) AS DOUBLE) AS n FROM documents),
    df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
    w AS (SELECT tf.doc_id, tf.term, tf.tf * ln((SELECT n FROM n) / df.df) AS w
          FROM tf JOIN df USING (term)),
    qtok AS (SELECT unnest(string_split_regex(lower(text), '\s+')) AS term FROM q),
    qt AS (SELECT term, count(*) AS tf FROM qtok WHERE term <> '' GROUP BY term),
    qw AS (SELECT qt.term, qt.tf * ln((SELECT n FROM n) / df.df) AS qw FROM qt JOIN df USING (term)),
    qn AS (SELECT sqrt(sum(qw * qw)) AS qn FROM qw),
    per_doc AS (SELECT w.doc_id, sqrt(sum(w.w * w.w)) AS norm, sum(w.w * qw.qw) AS dot,
                       bool_or(qw.qw IS NOT NULL) AS hit
                FROM w LEFT JOIN qw USING (term) GROUP BY w.doc_id)
    SELECT doc_id, round(d, 5) + 0.0 AS distance
    FROM (SELECT doc_id, CASE WHEN norm * (SELECT qn FROM qn) > 0
                      THEN 1 - dot / (norm * (SELECT qn FROM qn)) END AS d
          FROM per_doc WHERE hit)
    ORDER BY round(d, 12) NULLS LAST, doc_id LIMIT 10
"""

_BUCKET = "CAST(CAST(('0x' || substr(md5(term), 1, 8)) AS BIGINT) % 256 AS INTEGER)"

_DOC_VECTORS = r"""
    WITH pt AS (SELECT page_id, coalesce(PAGE_TEXT, '') AS t FROM pages),
    corpus AS (SELECT d.doc_id,
                      coalesce(d.text, '') || chr(10) || chr(10) || coalesce(pt.t, '') AS full_text
               FROM documents d LEFT JOIN pt ON d.doc_id = pt.page_id),
    q AS (SELECT text FROM benchmark ORDER BY item_id LIMIT 1),
    toks AS (SELECT doc_id, unnest(string_split_regex(lower(full_text), '\s+')) AS term FROM corpus),
    tf AS (SELECT doc_id, term, count(*) AS tf FROM toks WHERE term <> '' GROUP BY doc_id, term),
    n AS (SELECT CAST(count(*) AS DOUBLE) AS n FROM corpus),
    df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
    w AS (SELECT tf.doc_id, tf.term, tf.tf * ln((SELECT n FROM n) / df.df) AS w
          FROM tf JOIN df USING (term)),
    b AS (SELECT doc_id, BUCKET AS bucket, sum(w) AS v FROM w GROUP BY doc_id, bucket),
    qtok AS (SELECT unnest(string_split_regex(lower(text), '\s+')) AS term FROM q),
    qt AS (SELECT term, count(*) AS tf FROM qtok WHERE term <> '' GROUP BY term),
    qw AS (SELECT qt.term, qt.tf * ln((SELECT n FROM n) / df.df) AS qw FROM qt JOIN df USING (term)),
    qb AS (SELECT BUCKET AS bucket, sum(qw) AS qv FROM qw GROUP BY bucket),
    qn AS (SELECT sqrt(sum(qv * qv)) AS qn FROM qb),
    dn AS (SELECT doc_id, sqrt(sum(v * v)) AS dn FROM b GROUP BY doc_id),
    dot AS (SELECT b.doc_id, sum(b.v * qb.qv) AS dot FROM b JOIN qb USING (bucket) GROUP BY b.doc_id)
    SELECT doc_id, round(d, 6) + 0.0 AS distance
    FROM (SELECT dn.doc_id, CASE WHEN dn.dn * (SELECT qn FROM qn) > 0
                      THEN 1 - coalesce(dot.dot, 0) / (dn.dn * (SELECT qn FROM qn)) END AS d
          FROM dn LEFT JOIN dot USING (doc_id)) x
    ORDER BY round(d, 12) NULLS LAST, doc_id LIMIT 10
""".replace("PAGE_TEXT", _PAGE_TEXT).replace("BUCKET", _BUCKET)

ORACLE_SQL = {
    "company_totals": """
        SELECT c.c_name AS company_name, round(sum(l.l_extendedprice), 2) AS total_value
        FROM lineitem l
        JOIN orders o ON l.l_orderkey = o.o_orderkey
        JOIN customer c ON o.o_custkey = c.c_custkey
        GROUP BY c.c_name
        ORDER BY total_value DESC, company_name
        LIMIT 10
    """,
    "company_totals_all": """
        SELECT c.c_name AS company_name, round(sum(l.l_extendedprice), 2) AS total_value
        FROM lineitem l
        JOIN orders o ON l.l_orderkey = o.o_orderkey
        JOIN customer c ON o.o_custkey = c.c_custkey
        GROUP BY c.c_name
    """,
    "dedup_tag_first": """
        SELECT p_name AS tag, p_brand AS version, p_size AS custom, p_type AS label
        FROM (SELECT *, row_number() OVER (PARTITION BY p_name ORDER BY p_partkey) AS rn
              FROM part WHERE p_name IS NOT NULL)
        WHERE rn = 1
    """,
    "metric_dim": """
        SELECT p_name AS tag, p_brand AS version, p_type AS tlabel,
               CAST(NULL AS VARCHAR) AS datatype, CAST(NULL AS VARCHAR) AS iord
        FROM (SELECT *, row_number() OVER (PARTITION BY p_name, p_brand ORDER BY p_partkey) AS rn
              FROM part)
        WHERE rn = 1
    """,
    "statement_dim": """
        SELECT DISTINCT l_returnflag AS statement_code,
               CASE l_returnflag WHEN 'A' THEN 'Accepted' WHEN 'R' THEN 'Returned'
                    ELSE 'Other' END AS statement_name
        FROM lineitem WHERE l_returnflag IS NOT NULL
    """,
    "statement_label_dim": """
        SELECT DISTINCT l_returnflag AS stmt, l_linestatus AS plabel
        FROM lineitem WHERE l_returnflag IS NOT NULL
    """,
    "date_dim_insert": """
        WITH ex AS (SELECT DISTINCT strftime(l_shipdate, '%Y%m%d') AS date_key FROM lineitem
                    WHERE l_shipdate < TIMESTAMP '1998-01-01'),
             src AS (SELECT DISTINCT strftime(l_shipdate, '%Y%m%d') AS date_key FROM lineitem
                     WHERE l_shipdate IS NOT NULL)
        SELECT date_key, FALSE AS inserted FROM ex
        UNION ALL
        SELECT date_key, TRUE AS inserted FROM src WHERE date_key NOT IN (SELECT date_key FROM ex)
    """,
    "filing_dim_insert": """
        SELECT CAST(o_orderkey AS VARCHAR) AS accession_number, o_orderpriority AS form_type,
               NOT coalesce(CAST(o_orderdate AS DATE) < DATE '1998-01-01', FALSE) AS inserted
        FROM orders JOIN customer ON o_custkey = c_custkey
    """,
    "calendar_dim": """
        SELECT strftime(d, '%Y-%m-%d') AS date, CAST(year(d) AS INTEGER) AS year,
               CAST(month(d) AS INTEGER) AS month, CAST(day(d) AS INTEGER) AS day,
               CAST(quarter(d) AS INTEGER) AS quarter, CAST(NULL AS INTEGER) AS fiscal_year
        FROM (SELECT CAST(unnest(generate_series(CAST(min(l_shipdate) AS DATE),
                                                 CAST(max(l_shipdate) AS DATE),
                                                 INTERVAL 1 DAY)) AS DATE) AS d
              FROM lineitem)
    """,
    "scd2_classify": f"""
        WITH {_SCD2_INPUTS}
        SELECT coalesce(icik, ecik) AS cik,
               CASE WHEN ecik IS NULL THEN 'new' WHEN icik IS NULL THEN 'vanished'
                    WHEN changed THEN 'changed' ELSE 'same' END AS change_kind
        FROM j
    """,
    "scd2_company": f"""
        WITH {_SCD2_INPUTS}
        SELECT ecik AS cik, ename AS name, esic AS sic, '2024-01-01 00:00:00' AS valid_from,
               CASE WHEN changed THEN '2025-01-01 00:00:00' ELSE '9999-12-31 00:00:00' END
                   AS valid_to,
               NOT changed AS is_current
        FROM j WHERE ecik IS NOT NULL
        UNION ALL
        SELECT icik, iname, isic, '2025-01-01 00:00:00', '9999-12-31 00:00:00', TRUE
        FROM j WHERE icik IS NOT NULL AND (ecik IS NULL OR changed)
    """,
    "fact_star": f"""
        WITH {_STAR_INPUTS},
        pre AS (SELECT DISTINCT CAST(l_orderkey AS VARCHAR) AS adsh, l_partkey AS tag_id,
                       l_returnflag AS stmt FROM lineitem)
        SELECT n.adsh, s.cik, p.p_name AS tag, strftime(n.ddate, '%Y%m%d') AS date_key,
               pre.stmt, n.value
        FROM num n
        JOIN pre ON n.adsh = pre.adsh AND n.tag_id = pre.tag_id
        JOIN sub s ON s.adsh = n.adsh
        JOIN part p ON p.p_partkey = n.tag_id
        WHERE p.p_name IS NOT NULL AND n.ddate IS NOT NULL AND pre.stmt IS NOT NULL
    """,
    "fact_left_variant": f"""
        WITH {_STAR_INPUTS},
        pre AS (SELECT DISTINCT CAST(l_orderkey AS VARCHAR) AS adsh, l_partkey AS tag_id,
                       l_returnflag AS stmt FROM lineitem WHERE l_returnflag IN ('A', 'R'))
        SELECT n.adsh, s.cik, p.p_name AS tag, strftime(n.ddate, '%Y%m%d') AS date_key,
               pre.stmt, n.value
        FROM num n
        LEFT JOIN pre ON n.adsh = pre.adsh AND n.tag_id = pre.tag_id
        LEFT JOIN sub s ON s.adsh = n.adsh
        LEFT JOIN part p ON p.p_partkey = n.tag_id
        WHERE n.adsh IS NOT NULL AND p.p_name IS NOT NULL AND s.cik IS NOT NULL
              AND n.ddate IS NOT NULL
    """,
    "star_company_totals": f"""
        WITH {_STAR_INPUTS},
        pre AS (SELECT DISTINCT CAST(l_orderkey AS VARCHAR) AS adsh, l_partkey AS tag_id,
                       l_returnflag AS stmt FROM lineitem)
        SELECT c.c_name AS company_name, round(sum(n.value), 2) AS total_value
        FROM num n
        JOIN pre ON n.adsh = pre.adsh AND n.tag_id = pre.tag_id
        JOIN sub s ON s.adsh = n.adsh
        JOIN part p ON p.p_partkey = n.tag_id
        JOIN customer c ON CAST(c.c_custkey AS VARCHAR) = s.cik
        WHERE p.p_name IS NOT NULL AND n.ddate IS NOT NULL AND pre.stmt IS NOT NULL
        GROUP BY c.c_name
        ORDER BY total_value DESC, company_name
        LIMIT 10
    """,
    "key_duplicates": """
        SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem
        GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1
    """,
    "null_counts": _null_counts_sql(),
    "fact_orphans": "\nUNION ALL\n".join([
        _orphan_sql("lineitem.l_orderkey->orders", "lineitem", "l_orderkey", "orders", "o_orderkey"),
        _orphan_sql("lineitem.l_partkey->part", "lineitem", "l_partkey", "part", "p_partkey"),
        _orphan_sql("lineitem.l_suppkey->supplier", "lineitem", "l_suppkey", "supplier", "s_suppkey"),
        _orphan_sql("orders.o_custkey->customer", "orders", "o_custkey", "customer", "c_custkey"),
    ]),
    "date_parse": """
        SELECT CAST(strftime(l_shipdate, '%Y%m%d') AS INTEGER) AS ddate_int,
               CAST(l_shipdate AS DATE) AS ddate, strftime(l_shipdate, '%Y%m%d') AS date_key,
               count(*) AS n
        FROM lineitem GROUP BY ALL
    """,
    "raw_create": f"""
        WITH {_RAW}
        SELECT adsh, cik, name, form, sic FROM raw
        UNION ALL
        SELECT adsh, cik, name, form, sic FROM batch
        WHERE adsh NOT IN (SELECT adsh FROM conflicts)
    """,
    "raw_conflicts": f"""
        WITH {_RAW}
        SELECT adsh, reason FROM conflicts
    """,
    "raw_page": f"""
        WITH {_RAW}
        SELECT adsh, cik, name, form, sic FROM sub ORDER BY adsh LIMIT 100 OFFSET 100
    """,
    "raw_get": f"""
        WITH {_RAW}
        SELECT req.adsh, r.adsh IS NOT NULL AS found, r.cik, r.name, r.form, r.sic
        FROM req LEFT JOIN raw r ON r.adsh = req.adsh
    """,
    "raw_update": f"""
        WITH {_RAW}
        SELECT sub.adsh, cik,
               CASE WHEN name_at IS NOT NULL THEN 'LINE ' || name_at ELSE name END AS name,
               CASE WHEN form_at IS NOT NULL THEN 'AMENDED ' || form_at ELSE form END AS form,
               CASE WHEN sic_set THEN NULL ELSE sic END AS sic
        FROM sub LEFT JOIN last USING (adsh)
    """,
    "raw_delete": f"""
        WITH {_RAW}
        SELECT adsh, cik, name, form, sic FROM sub WHERE adsh NOT IN (SELECT adsh FROM req)
    """,
    "raw_not_found": f"""
        WITH {_RAW}
        SELECT 'update' AS op, adsh FROM upd WHERE adsh NOT IN (SELECT adsh FROM raw)
        UNION ALL
        SELECT 'delete' AS op, adsh FROM req WHERE adsh NOT IN (SELECT adsh FROM raw)
    """,
    "page_text": f"""
        SELECT page_id, coalesce({_PAGE_TEXT}, '') AS extracted_text FROM pages
    """,
    "filing_text_left_join": f"""
        WITH pt AS (SELECT page_id, coalesce({_PAGE_TEXT}, '') AS t FROM pages)
        SELECT d.doc_id, pt.page_id IS NOT NULL AS has_text,
               coalesce(d.text, '') || chr(10) || chr(10) || coalesce(pt.t, '') AS full_text
        FROM documents d LEFT JOIN pt ON d.doc_id = pt.page_id
    """,
    "knn_all": f"""
        WITH {_PROBE}
        SELECT vec_id, label, round(d, 6) + 0.0 AS distance
        FROM (SELECT vec_id, label, {_cosine("e.embedding", "probe.qv")} AS d
              FROM embeddings e, probe ORDER BY round(d, 12) NULLS LAST, vec_id LIMIT 10)
    """,
    "knn_filtered": f"""
        WITH {_PROBE}
        SELECT vec_id, label, round(d, 6) + 0.0 AS distance
        FROM (SELECT vec_id, label, {_cosine("e.embedding", "probe.qv")} AS d
              FROM embeddings e, probe WHERE e.label = probe.ql
              ORDER BY round(d, 12) NULLS LAST, vec_id LIMIT 10)
    """,
    "knn_batch": f"""
        WITH x AS (SELECT label, unnest(range(1, len(embedding) + 1)) AS i,
                          unnest(CAST(embedding AS DOUBLE[])) AS v FROM embeddings),
        c AS (SELECT label, i, avg(v) AS cv FROM x GROUP BY label, i),
        q AS (SELECT label, list(cv ORDER BY i) AS qv FROM c GROUP BY label),
        s AS (SELECT e.label, e.vec_id, {_cosine("e.embedding", "q.qv")} AS d
              FROM embeddings e JOIN q ON e.label = q.label),
        r AS (SELECT *, row_number() OVER (PARTITION BY label
                                           ORDER BY round(d, 12) NULLS LAST, vec_id) AS rank FROM s)
        SELECT label, rank, vec_id, round(d, 6) + 0.0 AS distance FROM r WHERE rank <= 10
    """,
    "knn_indexed": f"""
        WITH s AS (SELECT q.vec_id AS qid, e.vec_id, {_cosine("e.embedding", "q.embedding")} AS d
                   FROM embeddings e, embeddings q WHERE q.vec_id % 20 = 0)
        SELECT qid, row_number() OVER (PARTITION BY qid
                                       ORDER BY round(d, 12) NULLS LAST, vec_id) AS rank,
               vec_id, round(d, 6) + 0.0 AS distance
        FROM s QUALIFY rank <= 10
    """,
    "vector_length_check": """
        SELECT coalesce(len(embedding) = 64, FALSE) AS valid, count(*) AS n
        FROM embeddings GROUP BY 1
    """,
    "facet_counts": """
        SELECT label, count(*) AS n FROM embeddings GROUP BY label
    """,
    "tfidf_search": _TFIDF,
    "delimiter_detect": """
        SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer
    """,
    "doc_vector_search": _DOC_VECTORS,
    "raw_create_strict": f"""
        WITH {_RAW}
        SELECT adsh, cik, name, form, sic FROM raw
        UNION ALL
        SELECT adsh, cik, name, form, sic FROM batch
        WHERE NOT EXISTS (SELECT 1 FROM conflicts)
    """,
}
ORACLE_SQL["gold_company_totals"] = ORACLE_SQL["star_company_totals"]
ORACLE_SQL["fact_star_ids"] = ORACLE_SQL["fact_star"]
ORACLE_SQL["raw_create_accepted"] = f"""
    WITH {_RAW}
    SELECT adsh, cik, name, form, sic FROM raw
    UNION ALL
    SELECT adsh, cik, name, form, sic FROM later
"""
ORACLE_SQL["gold_two_loads"] = f"""
    WITH {_STAR_INPUTS},
    pre AS (SELECT DISTINCT CAST(l_orderkey AS VARCHAR) AS adsh, l_partkey AS tag_id,
                   l_returnflag AS stmt FROM lineitem),
    facts AS (SELECT s.cik, count(*) AS facts
              FROM num n JOIN pre ON n.adsh = pre.adsh AND n.tag_id = pre.tag_id
              JOIN sub s ON s.adsh = n.adsh JOIN part p ON p.p_partkey = n.tag_id
              WHERE p.p_name IS NOT NULL AND n.ddate IS NOT NULL AND pre.stmt IS NOT NULL
              GROUP BY s.cik),
    company AS (SELECT CAST(c_custkey AS VARCHAR) AS cik, c_name AS name, c_mktsegment AS sic,
                       coalesce(c_acctbal < 0, FALSE) AND c_mktsegment IS DISTINCT FROM 'OLD'
                           AS changed
                FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders))
    SELECT cik, name, CASE WHEN changed THEN 'OLD' ELSE sic END AS sic,
           '2024-01-01 00:00:00' AS valid_from,
           CASE WHEN changed THEN '2025-01-01 00:00:00' ELSE '9999-12-31 00:00:00' END AS valid_to,
           NOT changed AS is_current,
           CAST(CASE WHEN changed THEN 0 ELSE coalesce(facts, 0) END AS BIGINT) AS facts
    FROM company LEFT JOIN facts USING (cik)
    UNION ALL
    SELECT cik, name, sic, '2025-01-01 00:00:00', '9999-12-31 00:00:00', TRUE,
           CAST(coalesce(facts, 0) AS BIGINT)
    FROM company LEFT JOIN facts USING (cik) WHERE changed
"""
ORACLE_SQL["bronze_to_silver"] = """
    SELECT l_orderkey * 10 + l_linenumber AS num_id,
           CASE WHEN l_linenumber < 6 AND l_shipdate IS NOT NULL
                THEN CAST(l_orderkey AS VARCHAR) END AS adsh,
           CASE WHEN l_linenumber < 6 AND l_shipdate IS NOT NULL THEN l_partkey END AS tag_id,
           CASE WHEN l_linenumber < 6 AND l_shipdate IS NOT NULL THEN 'us-gaap/2023' END AS version,
           CASE WHEN l_linenumber < 6 THEN CAST(l_shipdate AS DATE) END AS ddate,
           CASE WHEN l_linenumber < 6 AND l_shipdate IS NOT NULL THEN l_linenumber END AS qtrs,
           CASE WHEN l_linenumber < 6 AND l_shipdate IS NOT NULL THEN l_extendedprice END AS value,
           CASE WHEN l_linenumber = 7 THEN 'ddate does not parse as yyyyMMdd'
                WHEN l_linenumber = 6 OR l_shipdate IS NULL THEN 'ddate is missing' END AS reason
    FROM lineitem
"""
ORACLE_SQL["silver_filings"] = """
    SELECT CAST(o_orderkey AS VARCHAR) AS adsh, o_custkey AS cik, c_name AS name,
           o_orderpriority AS form, c_mktsegment AS sic,
           'Summary of "' || c_name || '",' || chr(10) || 'form ' || o_orderpriority
               AS filing_summary
    FROM orders JOIN customer ON o_custkey = c_custkey
"""
ORACLE_SQL["load_report"] = f"""
    WITH {_STAR_INPUTS},
    pre AS (SELECT DISTINCT CAST(l_orderkey AS VARCHAR) AS adsh, l_partkey AS tag_id,
                   l_returnflag AS stmt FROM lineitem)
    SELECT 'companydim_current' AS table_name, count(DISTINCT cik) AS rows FROM sub
    UNION ALL SELECT 'companydim_history', 0
    UNION ALL SELECT 'filingdim', count(DISTINCT adsh) FROM sub
    UNION ALL SELECT 'tagdim', count(DISTINCT p_name) FROM part
    UNION ALL SELECT 'datedim', count(DISTINCT ddate) FROM num
    UNION ALL SELECT 'statementdim', count(DISTINCT stmt) FROM pre
    UNION ALL SELECT 'factfinancials', count(*)
    FROM num n JOIN pre ON n.adsh = pre.adsh AND n.tag_id = pre.tag_id
    JOIN sub s ON s.adsh = n.adsh JOIN part p ON p.p_partkey = n.tag_id
    WHERE p.p_name IS NOT NULL AND n.ddate IS NOT NULL AND pre.stmt IS NOT NULL
"""
ORACLE_SQL["import_failures"] = """
    SELECT vec_id, label, CAST(least(len(embedding), 8) AS INTEGER) AS length FROM embeddings
    WHERE label = 0 OR len(embedding) <> 64 ORDER BY vec_id LIMIT 5
"""
_SEARCH = r"""
    WITH pt AS (SELECT page_id, coalesce(PAGE_TEXT, '') AS t FROM pages),
    corpus AS (SELECT d.doc_id, d.lang AS form, d.source AS name,
                      coalesce(d.text, '') || chr(10) || chr(10) || coalesce(pt.t, '') AS full_text
               FROM documents d LEFT JOIN pt ON d.doc_id = pt.page_id),
    q AS (QUERIES),
    toks AS (SELECT doc_id, unnest(string_split_regex(lower(full_text), '\s+')) AS term FROM corpus),
    tf AS (SELECT doc_id, term, count(*) AS tf FROM toks WHERE term <> '' GROUP BY doc_id, term),
    n AS (SELECT CAST(count(*) AS DOUBLE) AS n FROM corpus),
    df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
    w AS (SELECT tf.doc_id, tf.term, tf.tf * ln((SELECT n FROM n) / df.df) AS w
          FROM tf JOIN df USING (term)),
    norm AS (SELECT doc_id, sqrt(sum(w * w)) AS norm FROM w GROUP BY doc_id),
    qtok AS (SELECT qid, unnest(string_split_regex(lower(text), '\s+')) AS term FROM q),
    qt AS (SELECT qid, term, count(*) AS tf FROM qtok WHERE term <> '' GROUP BY qid, term),
    qw AS (SELECT qt.qid, qt.term, qt.tf * ln((SELECT n FROM n) / df.df) AS qw
           FROM qt JOIN df USING (term)),
    qn AS (SELECT qid, sqrt(sum(qw * qw)) AS qn FROM qw GROUP BY qid),
    dot AS (SELECT qw.qid, w.doc_id, sum(w.w * qw.qw) AS dot FROM w JOIN qw USING (term)
            GROUP BY qw.qid, w.doc_id),
    s AS (SELECT dot.qid, doc_id, CASE WHEN norm * qn > 0 THEN 1 - dot / (norm * qn) END AS d
          FROM dot JOIN norm USING (doc_id) JOIN qn USING (qid)),
    r AS (SELECT s.*, row_number() OVER (PARTITION BY s.qid ORDER BY round(d, 12) NULLS LAST,
                                         CAST(s.doc_id AS VARCHAR)) AS rank
          FROM s JOIN corpus USING (doc_id) JOIN q ON q.qid = s.qid
          WHERE q.form IS NULL OR q.form = corpus.form)
    SELECT COLUMNS CAST(doc_id AS VARCHAR) AS id, CAST(doc_id AS VARCHAR) AS cik,
           corpus.name, corpus.form, round(d, 5) + 0.0 AS distance
    FROM r JOIN corpus USING (doc_id) WHERE rank <= 10
""".replace("PAGE_TEXT", _PAGE_TEXT)
ORACLE_SQL["search_filtered"] = _SEARCH.replace("COLUMNS", "").replace(
    "QUERIES", "SELECT 0 AS qid, text, 'en' AS form FROM benchmark ORDER BY item_id LIMIT 1")
ORACLE_SQL["search_batch"] = _SEARCH.replace("COLUMNS", "qid, rank,").replace(
    "QUERIES", "SELECT item_id AS qid, text, NULL AS form FROM benchmark")
ORACLE_SQL["search_topk"] = ORACLE_SQL["search_batch"]

ORACLE_SQL["doc_embeddings"] = r"""
    WITH tok AS (SELECT doc_id, unnest(string_split_regex(lower(text), '\s+')) AS term
                 FROM documents),
    tf AS (SELECT DISTINCT doc_id, term FROM tok WHERE term <> ''),
    df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
    counted AS (SELECT DISTINCT doc_id FROM tf JOIN df USING (term)
                WHERE df >= 2 AND df < (SELECT count(*) FROM documents)),
    twins AS (SELECT doc_id, min(doc_id) OVER (PARTITION BY coalesce(text, '')) AS twin
              FROM documents)
    SELECT doc_id, CAST(64 AS BIGINT) AS length, twin,
           CASE WHEN counted.doc_id IS NULL THEN 0.0 ELSE 1.0 END::DOUBLE AS norm,
           CASE WHEN counted.doc_id IS NULL THEN 0.0 ELSE 1.0 END::DOUBLE AS twin_cosine
    FROM twins LEFT JOIN counted USING (doc_id)
"""

ORACLE_SQL["dense_filing_ids"] = """
    WITH f AS (SELECT CAST(o_orderkey AS VARCHAR) AS adsh, o_orderpriority AS form,
                      CASE WHEN o_orderdate < TIMESTAMP '1998-01-01' THEN 1 ELSE 2 END AS load
               FROM orders JOIN customer ON o_custkey = c_custkey)
    SELECT row_number() OVER (ORDER BY load, adsh) AS id, adsh, form, load FROM f
"""

ORACLE_SQL["document_files"] = """
    WITH p AS (SELECT page_id, coalesce(html, '') || CASE WHEN page_id % 5 = 1
                      THEN chr(12) || ' ' || chr(12) || '<p>Annex</p>' ELSE '' END AS page
               FROM pages),
    d AS (SELECT page_id, CASE WHEN page_id % 7 = 3
                 THEN substr(page, 1, length(page) // 2) ELSE page END AS whole FROM p),
    f AS (SELECT CAST(o_orderkey AS VARCHAR) AS adsh FROM orders JOIN customer
          ON o_custkey = c_custkey WHERE o_orderdate < TIMESTAMP '1998-01-01')
    SELECT page_id,
           array_to_string(list_filter(list_transform(string_split(whole, chr(12)),
               lambda html: PAGE_TEXT), lambda x: x <> ''), chr(10)) AS extracted_text,
           CASE WHEN page_id % 7 = 3 THEN octet_length(encode(whole)) END AS bad_at,
           CAST(page_id AS VARCHAR) NOT IN (SELECT adsh FROM f) AS is_new_filing
    FROM d
""".replace("PAGE_TEXT", _PAGE_TEXT)

ORACLE_SQL["hot_key_join"] = """
    WITH l AS (SELECT CASE WHEN l_returnflag = 'R' THEN (SELECT min(o_orderkey) FROM orders)
                      ELSE l_orderkey END AS o_orderkey, l_orderkey, l_linenumber,
                      l_extendedprice AS value FROM lineitem)
    SELECT l.*, o_custkey AS cik FROM l JOIN orders USING (o_orderkey)
"""
ORACLE_SQL["fact_bucketed"] = """
    WITH pre AS (SELECT DISTINCT l_orderkey, l_partkey, l_returnflag AS stmt FROM lineitem)
    SELECT CAST(n.l_orderkey AS VARCHAR) AS adsh, o_custkey AS cik, n.l_partkey AS tag_id, stmt,
           n.l_linenumber AS qtrs, n.l_extendedprice AS value
    FROM lineitem n JOIN pre ON n.l_orderkey = pre.l_orderkey AND n.l_partkey = pre.l_partkey
    JOIN orders ON n.l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
"""

ORACLE_SQL["raw_deep_page"] = """
    WITH f AS (SELECT CAST(o_orderkey AS VARCHAR) AS adsh, o_custkey AS cik,
                      o_orderpriority AS form
               FROM orders JOIN customer ON o_custkey = c_custkey)
    SELECT * FROM f ORDER BY adsh LIMIT 100 OFFSET (SELECT count(*) * 9 // 10 FROM f)
"""

ORACLE_SQL["raw_change_sets"] = f"""
    SELECT * FROM ({ORACLE_SQL["raw_update"]}) WHERE adsh NOT IN (
        SELECT CAST(l_orderkey AS VARCHAR) FROM lineitem WHERE l_returnflag = 'R')
"""

ORACLE_SQL["gold_incremental"] = ORACLE_SQL["gold_two_loads"]
