"""SQL that states the expected result of each query, for DuckDB on the same tables."""

from __future__ import annotations

from tidings.functions.text import CORPORATE_FORMS, LETTER_READINGS
from tidings.functions.vectors import BIGRAM_DIM

from .views import VIEWS

NEWS_COLS = "seq, site_name, basc_dt, title, content, doc_sentiment, part_basc_dt"


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


def view(name: str) -> str:
    return f"{name} AS ({VIEWS[name]})"


def cleaned(name: str, source: str, column: str, out: str) -> str:
    """CTE: the rows of ``source`` with the normalised form of a company name."""
    bare = f"upper(trim(coalesce({column}, '')))"
    for form in [*CORPORATE_FORMS, ",", ".", " "]:
        bare = f"replace({bare}, '{form}', '')"
    spelled = "_bare"
    for letter, reading in LETTER_READINGS.items():
        spelled = f"replace({spelled}, '{letter}', '{reading}')"
    return f"""{name} AS (
  SELECT * EXCLUDE (_bare),
         lower(trim(CASE WHEN regexp_matches(_bare, '[가-힣]') OR length(_bare) <= 3 THEN {spelled} ELSE _bare END)) AS {out}
  FROM (SELECT *, {bare} AS _bare FROM {source}) s)"""


def bigrams(name: str, source: str, key: str, text: str) -> str:
    """CTEs: ``name`` has the bucket counts of a text, ``name``_norm their lengths."""
    return f"""{name}_chars AS (SELECT {key} AS k, string_split(concat(' ', {text}, ' '), '') AS c FROM {source}),
{name} AS (SELECT k, (31 * unicode(p[1]) + unicode(p[2])) % {BIGRAM_DIM} AS bucket, CAST(count(*) AS DOUBLE) AS n
  FROM (SELECT k, unnest(list_zip(c[:-2], c[2:])) AS p FROM {name}_chars) t GROUP BY ALL),
{name}_norm AS (SELECT k, sqrt(sum(n * n)) AS len FROM {name} GROUP BY k)"""


def bigram_cosines(name: str, left: str, right: str) -> str:
    return f"""{name} AS (SELECT a.k AS ak, b.k AS bk, sum(a.n * b.n) / any_value(la.len * lb.len) AS cos
  FROM {left} a JOIN {right} b ON a.bucket = b.bucket
  JOIN {left}_norm la ON la.k = a.k JOIN {right}_norm lb ON lb.k = b.k GROUP BY a.k, b.k)"""


RELEVANCE = "(1 - sqrt(2) * (1 - cos))"
ROOT_NEWS = "channel = 'NEWS' AND seq = p_seq AND title IS NOT NULL"
INCREMENT = """upper(channel) = 'NEWS' AND seq = p_seq AND title IS NOT NULL AND trim(title) <> ''
  AND seq > {seq} AND (part_basc_dt >= '{day}' OR part_basc_dt IS NULL)"""
FIRST_RUN = INCREMENT.format(seq=0, day="20260101")
LATER_RUN = INCREMENT.format(seq=10, day="20260105")


def dotted(column: str) -> str:
    return f"""CASE WHEN regexp_matches({column}, '^\\d{{8}}$')
    THEN concat(substr({column}, 1, 4), '.', substr({column}, 5, 2), '.', substr({column}, 7, 2)) ELSE {column} END"""


REFERENCE = "concat('[', coalesce(site_name, 'None'), ']. ', coalesce(title, 'None'), '. ', coalesce({date}, 'None'))"
PROMPT = """concat('Which companies does this article report on, and what kind of event is it? Answer with one JSON object: ',
  '{"results": {"id", "company_names", "classification", "category", "summary"}}.', chr(10), chr(10),
  'ID: ', CAST(seq AS VARCHAR), chr(10), 'Date: ', coalesce(basc_dt, 'None'), chr(10),
  'Title: ', coalesce(title, 'None'), chr(10), 'Content: ', coalesce(content, 'None'), chr(10))"""

CLEAN_COMPANY = cleaned("company", "v_company", "cust_nm", "clean_cust_nm")
CLEAN_MENTION = cleaned("mention", "v_mention", "target_company", "clean_target_company")
DIRECTORY = """directory AS (SELECT clean_cust_nm, count(*) AS n_candidates, min(cust_no) AS cust_no,
  min_by(cust_nm, cust_no) AS cust_nm FROM company GROUP BY clean_cust_nm)"""
MATCHING = (view("v_mention"), view("v_company"), CLEAN_MENTION, CLEAN_COMPANY, DIRECTORY)
EXACT = "mention m LEFT JOIN directory d ON m.clean_target_company = d.clean_cust_nm"

# Nearest directory name of the names it lacks.
VECTOR_HITS = (
    """missing AS (SELECT DISTINCT clean_target_company AS nm FROM mention
  WHERE clean_target_company <> '' AND clean_target_company NOT IN (SELECT clean_cust_nm FROM directory))""",
    bigrams("q", "missing", "nm", "nm"),
    bigrams("x", "directory", "clean_cust_nm", "clean_cust_nm"),
    bigram_cosines("name_cos", "q", "x"),
    f"""hits AS (SELECT ak AS nm, bk AS hit_name, {RELEVANCE} AS score, d.cust_no AS hit_no, d.cust_nm AS hit_nm
  FROM name_cos JOIN directory d ON d.clean_cust_nm = bk
  QUALIFY row_number() OVER (PARTITION BY ak ORDER BY round(cos, 6) DESC, d.cust_no) = 1)""",
)
CASCADE = (
    *MATCHING,
    *VECTOR_HITS,
    """matched AS (SELECT m.*, CASE WHEN d.cust_no IS NULL THEN 'vector_search' ELSE 'exact_normalized' END AS mapping_method,
    CASE WHEN d.cust_no IS NULL THEN h.score ELSE 1.0 END AS similarity_score,
    CASE WHEN d.cust_no IS NULL THEN h.hit_name ELSE d.clean_cust_nm END AS matched_clean_name,
    CASE WHEN d.cust_no IS NULL THEN 1 ELSE d.n_candidates END AS n_candidates,
    CASE WHEN d.cust_no IS NULL THEN h.hit_no ELSE d.cust_no END AS cust_no,
    CASE WHEN d.cust_no IS NULL THEN h.hit_nm ELSE d.cust_nm END AS cust_nm
  FROM mention m LEFT JOIN directory d ON m.clean_target_company = d.clean_cust_nm
  LEFT JOIN hits h ON h.nm = m.clean_target_company AND h.score >= 0.5
  WHERE d.cust_no IS NOT NULL OR h.hit_no IS NOT NULL)""",
)

VECTOR_COSINES = """cosines AS (SELECT q.vec_id AS query_id, x.vec_id AS item_id,
  list_cosine_similarity(CAST(list_reverse(q.embedding) AS DOUBLE[]), CAST(x.embedding AS DOUBLE[])) AS cos
  FROM embeddings q, embeddings x)"""
VECTOR_TOP = f"""SELECT query_id, item_id, round({RELEVANCE}, 4) AS score FROM cosines {{where}}
  QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY round(cos, 6) DESC, item_id) = 1"""

LATEST = """latest AS (SELECT cust_no, cust_nm, sglr_ases_modl_clas_cd_nm, std_inds_clas_nm, primy_prod_nm, lst_ases_dt, tie1, tie2
  FROM v_company_hist WHERE lst_ases_dt <> 'N/A'
  QUALIFY row_number() OVER (PARTITION BY cust_no ORDER BY CAST(lst_ases_dt AS BIGINT) DESC, tie1, tie2) = 1)"""

RESPONSE_OK = "kind IN (0, 1, 2, 5)"
SERVED = """trim(news_clas) <> '' AND upper(trim(news_clas)) NOT IN ('NOISE', 'NONE', 'NAN', 'NULL')
  AND trim(doc_sentiment) <> '' AND upper(trim(doc_sentiment)) NOT IN ('NONE', 'NAN', 'NULL')"""

def replied(source: str) -> str:
    """CTE: what the stand-in model answers, in the terms of the news view."""
    return f"""extracted AS (SELECT seq, site_name, {dotted('basc_dt')} AS basc_dt, title, content, doc_sentiment,
    CASE WHEN seq % 10 = 7 THEN NULL WHEN seq % 10 = 3 THEN 'noise' ELSE 'essential' END AS classification,
    CASE WHEN seq % 10 = 7 THEN NULL ELSE 'RISK' END AS category,
    CASE WHEN seq % 10 = 7 THEN NULL ELSE concat(CAST(length({PROMPT}) AS VARCHAR), ' characters') END AS summary,
    CASE WHEN seq % 10 = 7 OR title NOT LIKE '% | %' THEN '' ELSE coalesce(split_part(title, ' | ', 1), '') END AS names,
    CASE WHEN seq % 10 = 7 THEN 'Failure: API calling: no answer' END AS llm_error,
    CASE WHEN seq % 10 = 7 THEN 'call_error' ELSE 'ok' END AS parse_status,
    {REFERENCE.format(date=dotted('basc_dt'))} AS reference
  FROM {source})"""

# The whole run: news, mentions, matches, contexts, target.
RUN = (
    view("v_news"),
    view("v_company_hist"),
    f"raw AS (SELECT * FROM v_news WHERE {FIRST_RUN})",
    replied("raw"),
    """v_mention AS (SELECT seq, names AS target_company FROM extracted WHERE classification = 'essential' AND names <> '')""",
    CLEAN_MENTION,
    # Attributes of a company do not change over its history, so ties do not matter.
    """v_company AS (SELECT DISTINCT cust_no, cust_nm, sglr_ases_modl_clas_cd_nm AS sglr_ases_modl_clas_cd,
  std_inds_clas_nm, primy_prod_nm FROM v_company_hist WHERE lst_ases_dt <> 'N/A')""",
    CLEAN_COMPANY,
    DIRECTORY,
    *VECTOR_HITS,
    CASCADE[-1],
    """unclear AS (SELECT DISTINCT seq, matched_clean_name FROM matched WHERE n_candidates > 1)""",
    bigrams(
        "ac", "(SELECT seq, concat(title, ' ', content) AS t FROM extracted WHERE seq IN (SELECT seq FROM unclear))", "seq", "t"
    ),
    bigrams("cc", "(SELECT DISTINCT concat(std_inds_clas_nm, ' ', primy_prod_nm) AS t FROM company)", "t", "t"),
    bigram_cosines("context_cos", "ac", "cc"),
    """chosen AS (SELECT u.seq, u.matched_clean_name, c.cust_no AS best_no, c.cust_nm AS best_nm
  FROM unclear u JOIN company c ON c.clean_cust_nm = u.matched_clean_name
  JOIN context_cos x ON x.ak = u.seq AND x.bk = concat(c.std_inds_clas_nm, ' ', c.primy_prod_nm)
  QUALIFY row_number() OVER (PARTITION BY u.seq, u.matched_clean_name ORDER BY round(x.cos, 6) DESC, c.cust_no) = 1)""",
    """picked AS (SELECT m.seq, coalesce(h.best_no, m.cust_no) AS cust_no, coalesce(h.best_nm, m.cust_nm) AS cust_nm
  FROM matched m LEFT JOIN chosen h ON h.seq = m.seq AND h.matched_clean_name = m.matched_clean_name)""",
    """target AS (SELECT row_number() OVER (ORDER BY e.seq, p.cust_no) AS news_mppg_id, e.seq, e.site_name AS site_nm,
    e.title AS news_tite, e.content AS news_ctt, e.category AS news_clas, e.doc_sentiment, e.summary AS news_summ,
    e.reference AS news_ref, p.cust_no AS etct_cust_no, p.cust_nm AS etct_cust_nm, c.sglr_ases_modl_clas_cd,
    c.std_inds_clas_nm, c.primy_prod_nm, e.basc_dt
  FROM extracted e JOIN picked p ON p.seq = e.seq JOIN company c ON c.cust_no = p.cust_no)""",
)

# What a streamed run reads: empty fields instead of nulls, and an empty day excludes.
STREAMED = tuple(
    f"raw AS (SELECT * REPLACE (coalesce(doc_sentiment, '') AS doc_sentiment) FROM v_news WHERE {FIRST_RUN} AND part_basc_dt IS NOT NULL)"
    if c.startswith("raw AS") else c for c in RUN
)

TARGET_COLS = """news_mppg_id, seq, site_nm, news_tite, news_ctt, news_clas, doc_sentiment, {summ} AS news_summ, {ref} AS news_ref,
  etct_cust_no, {nm} AS etct_cust_nm, {cl} AS sglr_ases_modl_clas_cd, {ind} AS std_inds_clas_nm, {prod} AS primy_prod_nm, basc_dt"""
NO_TEXT = "CAST(NULL AS VARCHAR)"

ORACLES = {
    "company_mentions": with_(
        view("v_mention"), view("v_company_hist"), CLEAN_MENTION, LATEST,
        "v_company AS (SELECT *, sglr_ases_modl_clas_cd_nm AS sglr_ases_modl_clas_cd FROM latest)", CLEAN_COMPANY, DIRECTORY,
    ) + """SELECT DISTINCT m.seq, d.cust_no, d.cust_nm, c.sglr_ases_modl_clas_cd, c.std_inds_clas_nm, c.primy_prod_nm
        FROM mention m JOIN directory d ON m.clean_target_company = d.clean_cust_nm JOIN company c ON c.cust_no = d.cust_no
        WHERE m.classification = 'essential'""",
    "incremental_news": with_(view("v_news")) + f"SELECT {NEWS_COLS} FROM v_news WHERE {LATER_RUN}",
    "stream_incremental": with_(view("v_news"))
    + f"""SELECT seq, site_name, basc_dt, title, content, coalesce(doc_sentiment, '') AS doc_sentiment, part_basc_dt
        FROM v_news WHERE {LATER_RUN} AND part_basc_dt IS NOT NULL""",
    "delimited_scan": with_(view("v_news"))
    + """SELECT CAST(seq AS VARCHAR) AS seq, CAST(p_seq AS VARCHAR) AS p_seq, channel, site_name, basc_dt,
        coalesce(title, '') AS title, content, coalesce(doc_sentiment, '') AS doc_sentiment,
        coalesce(part_basc_dt, '') AS part_basc_dt FROM v_news""",
    "delimited_layouts": with_(
        view("v_news"),
        """scan AS (SELECT CAST(seq AS VARCHAR) AS seq, CAST(p_seq AS VARCHAR) AS p_seq, channel, site_name, basc_dt,
        coalesce(title, '') AS title, content, coalesce(doc_sentiment, '') AS doc_sentiment,
        coalesce(part_basc_dt, '') AS part_basc_dt FROM v_news)""",
    ) + "SELECT *, 'known' AS layout FROM scan UNION ALL SELECT *, 'own' FROM scan",
    "stream_overlap": with_(view("v_news"))
    + f"""SELECT seq, site_name, basc_dt, title, content, coalesce(doc_sentiment, '') AS doc_sentiment, part_basc_dt
        FROM v_news WHERE {LATER_RUN} AND part_basc_dt IS NOT NULL""",
    "vector_approximate": f"""WITH moved AS (SELECT vec_id, list_transform(embedding,
            lambda e, i: CAST(e AS DOUBLE) + ((vec_id * 31 + (i - 1) * 17) % 11 - 5) * 0.015::DOUBLE) AS v FROM embeddings),
        cosines AS (SELECT q.vec_id AS query_id, x.vec_id AS item_id, list_cosine_similarity(q.v, CAST(x.embedding AS DOUBLE[])) AS cos
          FROM moved q, embeddings x)
        SELECT query_id, item_id, round({RELEVANCE}, 4) AS score, (SELECT count(*) FROM embeddings) AS answered,
          CAST(0 AS BIGINT) AS better_than_exact, true AS recall_reached FROM cosines
        QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY round(cos, 6) DESC, item_id) = 1""",
    "serving_lookup": with_(view("v_target"))
    + f"""SELECT 'customer' AS by, CAST(news_mppg_id AS VARCHAR) AS news_mppg_id FROM v_target WHERE {SERVED} AND etct_cust_no LIKE '0000%8'
        UNION ALL SELECT 'article', CAST(news_mppg_id AS VARCHAR) FROM v_target
        WHERE {SERVED} AND seq IN (SELECT item_id FROM benchmark)""",
    "stream_archive": with_(view("v_news")) + "SELECT CASE WHEN seq % 2 = 0 THEN 'archive' ELSE 'source' END AS place, seq FROM v_news",
    "catalog_retention": with_(view("v_target"), "t AS (SELECT seq, news_tite, CASE WHEN seq % 9 <> 0 THEN basc_dt END AS basc_dt FROM v_target)")
    + """SELECT *, (SELECT count(DISTINCT basc_dt) FROM t WHERE basc_dt < '2026.01.14') AS dropped,
        (SELECT count(DISTINCT coalesce(basc_dt, '')) FROM t WHERE coalesce(basc_dt, '9') >= '2026.01.14') AS partitions_left
        FROM t WHERE coalesce(basc_dt, '9') >= '2026.01.14'""",
    "snapshot_manifest": "SELECT *, (SELECT count(*) FROM orders) AS rows FROM orders",
    "new_chunks": """SELECT o_orderkey, o_custkey, o_orderstatus, CAST(o_orderkey % 8 + 1 AS BIGINT) AS chunk_idx FROM orders
        WHERE o_orderkey % 8 + 1 > 5""",
    "digest_changes": with_(view("v_company"), CLEAN_COMPANY)
    + """SELECT cust_no, CASE WHEN CAST(cust_no AS BIGINT) % 7 = 3 THEN 'insert' ELSE 'update' END AS change, CAST(0 AS BIGINT) AS buckets_left
        FROM company WHERE CAST(cust_no AS BIGINT) % 7 = 3 OR std_inds_clas_nm LIKE 'ECONOMY%'
        UNION ALL SELECT concat('x', cust_no), 'delete', 0 FROM company WHERE CAST(cust_no AS BIGINT) % 7 = 5""",
    "stream_windows": with_(
        view("v_news"),
        "copies AS (SELECT least(CAST(substr(part_basc_dt, 7, 2) AS INT) + 3, 28) - CAST(substr(part_basc_dt, 7, 2) AS INT) + 1 AS n FROM v_news WHERE part_basc_dt IS NOT NULL)",
    ) + """SELECT seq, site_name, basc_dt, title, content, coalesce(doc_sentiment, '') AS doc_sentiment, part_basc_dt,
        CAST((SELECT sum(n) + 28 FROM copies) AS BIGINT) AS records, CAST(28 AS BIGINT) AS bad_records,
        CAST(0 AS BIGINT) AS undated, CAST(0 AS BIGINT) AS late
        FROM v_news WHERE upper(channel) = 'NEWS' AND seq = p_seq AND trim(title) <> '' AND part_basc_dt IS NOT NULL""",
    "stream_counts": with_(view("v_news"))
    + f"""SELECT count(*) + count(*) FILTER (WHERE seq % 10 = 0) AS records, count(*) FILTER (WHERE seq % 10 = 0) AS bad_records,
        count(*) FILTER (WHERE upper(channel) = 'NEWS' AND seq = p_seq AND trim(title) <> '') AS articles,
        count(*) FILTER (WHERE upper(channel) = 'NEWS' AND seq = p_seq AND trim(title) <> ''
          AND NOT (seq > 10 AND coalesce(part_basc_dt, '') >= '20260105')) AS late FROM v_news""",
    "stream_target": with_(*STREAMED)
    + """SELECT * EXCLUDE (news_mppg_id), CAST(2 AS BIGINT) AS batches, (SELECT count(*) FROM v_news) AS records,
        (SELECT count(*) FROM raw) AS loaded, (SELECT count(*) FROM target) AS mapped, (SELECT count(*) FROM target) AS appended FROM target""",
    "numeric_keys": """SELECT o_orderkey, CAST(concat('10000000000', lpad(CAST(o_orderkey AS VARCHAR), 8, '0')) AS BIGINT) AS number,
        o_orderkey % 2 = 0 AS same FROM orders""",
    "vector_near_copies": f"""WITH cosines AS (SELECT q.vec_id AS query_id, x.vec_id AS item_id, list_cosine_similarity(
            list_transform(q.embedding, lambda e, i: CAST(e AS DOUBLE) + CASE WHEN i - 1 = q.vec_id % 64 THEN (q.vec_id % 10) * 0.0002::DOUBLE ELSE 0 END),
            CAST(x.embedding AS DOUBLE[])) AS cos FROM embeddings q, embeddings x),
        best AS (SELECT query_id, item_id, round({RELEVANCE}, 4) AS score, max(cos) OVER (PARTITION BY query_id) AS top FROM cosines
          QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY round(cos, 6) DESC, item_id) = 1)
        SELECT query_id, item_id, score, cells FROM best, (VALUES ('small'), ('default')) t(cells)
        WHERE round({RELEVANCE.replace('cos', 'top')}, 6) >= 1.0""",
    "catalog_insert": with_(
        view("v_target"),
        """loads AS (SELECT 0 AS load, * FROM v_target UNION ALL SELECT 1, * REPLACE (seq + 1000000000 AS seq) FROM v_target)""",
    ) + """SELECT row_number() OVER (ORDER BY load, seq, etct_cust_no, news_tite) AS news_mppg_id, seq, etct_cust_no,
        replace(replace(news_tite, chr(10), ' '), chr(13), ' ') AS news_tite,
        concat(replace(replace(news_tite, chr(10), ' '), chr(13), ' '), '  end') AS news_ctt, basc_dt FROM loads""",
    "cursor_state": with_(view("v_news"))
    + """SELECT seq AS last_seq, coalesce(part_basc_dt, 'None') AS last_part_basc_dt, n AS last_id, n AS published_id
        FROM v_news, (SELECT count(*) + count(*) FILTER (WHERE seq % 3 = 0) AS n FROM v_news) c
        ORDER BY seq DESC, part_basc_dt DESC NULLS LAST LIMIT 1""",
    "vector_refresh": with_(view("v_company"), CLEAN_COMPANY)
    + f"""SELECT clean_cust_nm, 'char-bigram-256' AS encoder_id, CAST(256 AS BIGINT) AS dim,
        CAST(min(CASE WHEN std_inds_clas_nm = 'ECONOMY' THEN 0 ELSE 1 END) AS BIGINT) AS turn FROM company GROUP BY clean_cust_nm""",
    "resume_run": with_(*RUN) + "SELECT * FROM target",
    "dry_run_preview": with_(*RUN)
    + """SELECT seq, site_nm, news_tite, news_clas, doc_sentiment, etct_cust_nm, etct_cust_no FROM target
        ORDER BY seq, etct_cust_no LIMIT 5""",
    "serving_after_failed_publish": with_(*RUN)
    + f"SELECT CAST(seq AS VARCHAR) AS seq, etct_cust_no, news_clas, basc_dt FROM target WHERE {SERVED}",
    "daily_news_sql": with_(view("v_news"))
    + f"SELECT {NEWS_COLS} FROM v_news WHERE part_basc_dt >= '20260105' AND seq > 10 AND {ROOT_NEWS}",
    "recent_n_days": with_(view("v_news")) + f"SELECT {NEWS_COLS} FROM v_news WHERE part_basc_dt >= '20260125' AND {ROOT_NEWS}",
    "table_snapshot": "SELECT * FROM customer",
    "empty_to_null": with_(view("v_news"))
    + "SELECT seq, nullif(trim(title), '') AS title, basc_dt, site_name FROM v_news",
    "newline_clean": "SELECT doc_id, replace(replace(text, chr(10), ' '), chr(13), ' ') AS text FROM documents",
    "new_file_scan": """SELECT concat('chunk_', CAST(o_orderkey AS VARCHAR), '.parquet') AS file_name, o_orderkey AS chunk_idx
        FROM orders WHERE o_orderstatus = 'F' AND o_orderkey > 5""",
    "union_by_name": """SELECT c_custkey AS key, c_name AS name, c_mktsegment AS segment FROM customer
        UNION ALL SELECT s_suppkey, s_name, NULL FROM supplier""",
    "company_source": with_(view("v_company")) + "SELECT * FROM v_company",
    "align_schema": with_(view("v_news"))
    + f"SELECT seq, {NO_TEXT} AS site_name, basc_dt, title, content, {NO_TEXT} AS doc_sentiment, part_basc_dt FROM v_news",
    "target_projection": with_(view("v_news"))
    + f"""SELECT seq, site_name AS site_nm, title AS news_tite, content AS news_ctt, 'RISK' AS news_clas, doc_sentiment,
        {NO_TEXT} AS news_summ, {NO_TEXT} AS news_ref, lpad(CAST(seq AS VARCHAR), 6, '0') AS etct_cust_no,
        {NO_TEXT} AS etct_cust_nm, {NO_TEXT} AS sglr_ases_modl_clas_cd, {NO_TEXT} AS std_inds_clas_nm,
        {NO_TEXT} AS primy_prod_nm, {dotted('basc_dt')} AS basc_dt FROM v_news""",
    "reference_string": with_(view("v_news")) + f"SELECT seq, {REFERENCE.format(date='basc_dt')} AS reference FROM v_news",
    "date_normalize": with_(view("v_news")) + f"SELECT seq, {dotted('basc_dt')} AS basc_dt FROM v_news",
    "context_text": with_(view("v_news"), view("v_company"))
    + """SELECT 'article' AS kind, seq AS id, CASE WHEN title IS NULL THEN content ELSE concat(title, ' ', content) END AS context
        FROM v_news UNION ALL
        SELECT 'company', CAST(cust_no AS BIGINT), concat(std_inds_clas_nm, ' ', primy_prod_nm) FROM v_company""",
    "prompt_render": with_(view("v_news")) + f"SELECT seq, {PROMPT} AS prompt FROM v_news",
    "normalize_name": with_(
        """raw AS (SELECT kind, id, concat(CASE id % 4 WHEN 1 THEN '(주)' WHEN 2 THEN '주식회사 ' WHEN 3 THEN ' ' ELSE '' END,
          name, ' Inc.') AS name FROM (
          SELECT 'part' AS kind, p_partkey AS id, p_name AS name FROM part
          UNION ALL SELECT 'supplier', s_suppkey, s_name FROM supplier
          UNION ALL SELECT 'customer', c_custkey, c_name FROM customer) t)""",
        cleaned("n", "raw", "name", "clean_name"),
    ) + "SELECT kind, id, clean_name FROM n",
    "cosine_pairs": """SELECT vec_id, round(cos, 4) AS cos, round(1 - sqrt(2) * (1 - cos), 4) AS relevance FROM (
        SELECT a.vec_id, list_cosine_similarity(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])) AS cos
        FROM embeddings a JOIN embeddings b ON b.vec_id = a.vec_id + 1) t""",
    "cursor_argmax": with_(view("v_news"))
    + "SELECT seq AS last_seq, part_basc_dt AS last_part_basc_dt FROM v_news ORDER BY seq DESC, part_basc_dt DESC NULLS LAST LIMIT 1",
    "max_id": "SELECT CAST(coalesce(max(o_orderkey), 0) AS BIGINT) AS max_id FROM orders",
    "latest_per_key": with_(view("v_company_hist"), LATEST) + "SELECT * FROM latest",
    "master_fingerprint": with_(view("v_company"))
    + """SELECT concat(CAST(count(*) AS VARCHAR), ':', CAST(sum(CAST(concat('0x', substr(md5(cust_no), 1, 15)) AS BIGINT)) AS VARCHAR),
        ':', CAST(sum(CAST(concat('0x', substr(md5(cust_no), 17, 15)) AS BIGINT)) AS VARCHAR)) AS fingerprint FROM v_company""",
    "master_delta": with_(view("v_company"), CLEAN_COMPANY)
    + "SELECT cust_no, clean_cust_nm FROM company WHERE std_inds_clas_nm = 'ECONOMY'",
    "json_repair": with_(view("v_llm_raw"))
    + """SELECT seq, CASE kind WHEN 2 THEN 'repaired' WHEN 3 THEN 'failed' WHEN 4 THEN 'call_error' ELSE 'ok' END AS parse_status,
        CASE WHEN kind IN (3, 4) THEN NULL ELSE CAST(seq AS VARCHAR) END AS id FROM v_llm_raw""",
    "llm_response_parse": f"""SELECT seq, CASE WHEN {RESPONSE_OK} THEN cls END AS classification,
        CASE WHEN {RESPONSE_OK} THEN 'RISK' END AS category, CASE WHEN {RESPONSE_OK} THEN event_type END AS summary
        FROM (SELECT event_id AS seq, event_id % 6 AS kind, event_type,
              CASE WHEN event_type IN ('view', 'click') THEN 'noise' ELSE 'essential' END AS cls FROM events) t""",
    "name_list_parse": f"""SELECT seq, CAST(CASE WHEN {RESPONSE_OK} THEN 1 ELSE 0 END AS BIGINT) AS n_names,
        CASE WHEN {RESPONSE_OK} THEN concat('U', CAST(user_id AS VARCHAR)) ELSE '' END AS names
        FROM (SELECT event_id AS seq, event_id % 6 AS kind, user_id FROM events) t""",
    "llm_error_split": """SELECT event_id AS seq, CASE WHEN event_id % 6 = 4 THEN 'Failure: API calling: timeout' END AS llm_error,
        CASE event_id % 6 WHEN 2 THEN 'repaired' WHEN 3 THEN 'failed' WHEN 4 THEN 'call_error' ELSE 'ok' END AS parse_status
        FROM events""",
    "explode_mentions": f"""SELECT seq, CASE WHEN event_type IN ('view', 'click') THEN 'noise' ELSE 'essential' END AS classification,
        concat('U', CAST(user_id AS VARCHAR)) AS target_company
        FROM (SELECT event_id AS seq, event_id % 6 AS kind, event_type, user_id FROM events) t WHERE {RESPONSE_OK}""",
    "extraction_rate": """SELECT count(*) AS n_articles, count(*) FILTER (WHERE event_id % 6 NOT IN (3, 4)) AS n_with_names FROM events""",
    "batch_inference": with_(view("v_news"), replied("v_news"))
    + """SELECT seq, basc_dt, CASE WHEN trim(names) = '' THEN '' ELSE names END AS names, classification, category, summary,
        llm_error, parse_status, reference FROM extracted""",
    "embed_texts": with_(bigrams("e", "documents", "doc_id", "text"))
    + """SELECT e.k AS doc_id, CAST(bucket AS BIGINT) AS bucket,
        CAST(floor(CAST(CAST(n / len AS FLOAT) AS DOUBLE) * 1000000) AS BIGINT) AS weight_ppm FROM e JOIN e_norm n ON n.k = e.k""",
    "exact_name_match": with_(*MATCHING)
    + f"SELECT m.seq, m.target_company, m.clean_target_company, coalesce(d.n_candidates, 0) AS n_candidates, d.cust_no, d.cust_nm FROM {EXACT}",
    "vector_top1": with_(VECTOR_COSINES) + VECTOR_TOP.format(where=""),
    "vector_threshold": with_(VECTOR_COSINES) + VECTOR_TOP.format(where=f"WHERE round({RELEVANCE}, 6) >= 0.2"),
    "cascade_match": with_(*CASCADE)
    + """SELECT seq, target_company, mapping_method, round(similarity_score, 4) AS similarity_score, matched_clean_name,
        n_candidates, cust_no FROM matched""",
    "match_enrich": with_(*CASCADE)
    + """SELECT m.cust_no, m.cust_nm, m.seq, m.target_company, c.sglr_ases_modl_clas_cd, c.std_inds_clas_nm, c.primy_prod_nm
        FROM matched m LEFT JOIN v_company c ON c.cust_no = m.cust_no AND c.cust_nm = m.cust_nm""",
    "duplicate_flag": with_(view("v_mention"))
    + "SELECT *, count(*) OVER (PARTITION BY seq, target_company) > 1 AS is_duplicate FROM v_mention",
    "homonym_resolve": with_(
        *MATCHING,
        """cosines AS MATERIALIZED (SELECT a.vec_id AS av, c.vec_id AS cv,
  list_cosine_similarity(CAST(a.embedding AS DOUBLE[]), CAST(c.embedding AS DOUBLE[])) AS cos FROM embeddings a, embeddings c)""",
        """wanted AS MATERIALIZED (SELECT DISTINCT m.seq, m.seq % (SELECT count(*) FROM embeddings) AS av,
    m.target_company, d.clean_cust_nm, d.n_candidates
  FROM mention m JOIN directory d ON m.clean_target_company = d.clean_cust_nm)""",
        """candidate AS MATERIALIZED (SELECT clean_cust_nm, cust_no, cust_nm,
    CAST(cust_no AS BIGINT) % (SELECT count(*) FROM embeddings) AS cv FROM company)""",
    ) + """SELECT w.seq, w.target_company, c.cust_no, c.cust_nm,
          CASE WHEN w.n_candidates = 1 THEN 0.0 ELSE round(x.cos, 4) END AS homonym_score
        FROM wanted w JOIN candidate c ON c.clean_cust_nm = w.clean_cust_nm JOIN cosines x ON x.av = w.av AND x.cv = c.cv
        QUALIFY row_number() OVER (PARTITION BY w.seq, w.target_company ORDER BY round(x.cos, 6) DESC, c.cust_no) = 1""",
    "distinct_rows": with_(view("v_mention")) + "SELECT DISTINCT * FROM v_mention",
    "dedup_keep_first": with_(*MATCHING)
    + """SELECT m.seq, d.cust_no, m.target_company, m.classification
        FROM mention m JOIN directory d ON m.clean_target_company = d.clean_cust_nm
        QUALIFY row_number() OVER (PARTITION BY m.seq, d.cust_no ORDER BY m.target_company, m.classification) = 1""",
    "essential_filter": with_(*MATCHING)
    + f"""SELECT m.seq, m.classification, m.target_company, d.cust_no FROM {EXACT}
        WHERE m.classification = 'essential' AND d.cust_no <> ''""",
    "mapping_rate": with_(*MATCHING)
    + f"SELECT count(*) AS n_mentions, count(d.cust_no) AS n_mapped, round(avg(CASE WHEN d.cust_no IS NULL THEN 0.0 ELSE 1.0 END), 6) AS mapping_rate FROM {EXACT}",
    "serving_filter": with_(view("v_target")) + f"SELECT * FROM v_target WHERE {SERVED}",
    "serving_export": with_(view("v_target"))
    + "SELECT "
    + TARGET_COLS.format(summ=NO_TEXT, ref=NO_TEXT, nm=NO_TEXT, cl=NO_TEXT, ind=NO_TEXT, prod=NO_TEXT)
    .replace("news_mppg_id, seq", "CAST(news_mppg_id AS VARCHAR) AS news_mppg_id, CAST(seq AS VARCHAR) AS seq")
    + f" FROM v_target WHERE {SERVED}",
    "append_with_ids": with_(
        view("v_target"),
        """loads AS (SELECT 0 AS load, seq, etct_cust_no, news_tite, basc_dt FROM v_target
          UNION ALL SELECT 1, seq + 1000000000, etct_cust_no, news_tite, basc_dt FROM v_target)""",
    ) + """SELECT row_number() OVER (ORDER BY load, seq, etct_cust_no, news_tite) AS news_mppg_id, seq, etct_cust_no, news_tite, basc_dt
        FROM loads""",
    "idempotent_append": with_(
        view("v_target"),
        """once AS (SELECT seq, etct_cust_no, min(news_tite) AS news_tite FROM v_target GROUP BY seq, etct_cust_no)""",
        """loads AS (SELECT 0 AS load, * FROM once UNION ALL SELECT 1, seq + 1000000000, etct_cust_no, news_tite FROM once)""",
    ) + "SELECT row_number() OVER (ORDER BY load, seq, etct_cust_no) AS news_mppg_id, seq, etct_cust_no, news_tite FROM loads",
    "row_chunks": "SELECT o_orderkey, CAST(floor((row_number() OVER (ORDER BY o_orderkey) - 1) / 1000) AS BIGINT) AS chunk_idx FROM orders",
    "retention_partitions": "SELECT DISTINCT strftime(ts, '%Y%m%d') AS folder FROM events WHERE CAST(ts AS DATE) < DATE '2024-01-16'",
    "dup_audit": with_(view("v_target"))
    + "SELECT seq, etct_cust_no, count(*) AS n_rows FROM v_target GROUP BY seq, etct_cust_no HAVING count(*) > 1",
    "run_summary": with_(view("v_news"), view("v_target"), *MATCHING)
    + f"""SELECT 'loaded' AS stage, count(*) AS n_rows FROM v_news WHERE {LATER_RUN}
        UNION ALL SELECT 'extracted', count(*) FROM events WHERE event_id % 6 NOT IN (3, 4)
        UNION ALL SELECT 'mapped', count(*) FROM {EXACT} WHERE m.classification = 'essential' AND d.cust_no IS NOT NULL
        UNION ALL SELECT 'appended', count(*) FROM v_target""",
    "limited_reads": with_(view("v_news"))
    + "".join(
        f"{union} SELECT '{name}' AS read, least(count(*), 100) AS n_rows, least(count(*), 100) AS n_known FROM v_news WHERE {rows}"
        for union, name, rows in (
            ("", "daily", f"part_basc_dt >= '20260105' AND seq > 10 AND {ROOT_NEWS}"),
            (" UNION ALL", "recent", f"part_basc_dt >= '20260125' AND {ROOT_NEWS}"),
            (" UNION ALL", "table", "true"),
        )
    ),
    "input_cleanup": with_(*STREAMED) + "SELECT *, false AS first_left, true AS second_left FROM target",
    "daily_run": with_(*RUN) + "SELECT * FROM target",
    "daily_run_serving": with_(*RUN)
    + f"SELECT CAST(seq AS VARCHAR) AS seq, etct_cust_no, news_clas, basc_dt FROM target WHERE {SERVED}",
}
