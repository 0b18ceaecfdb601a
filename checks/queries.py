"""One function per operator: ``(spark, sf_dir) -> DataFrame``. Columns match the SQL in ``oracles``."""

from __future__ import annotations

import math
import re
import uuid
from unittest import mock

from pyspark.errors import StreamingQueryException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidings import storage
from tidings.functions import responses, text, vectors
from tidings.operators import (
    align,
    approximate,
    dedup,
    digest_tree,
    homonyms,
    ids,
    inference,
    load,
    master,
    matching,
    nearest,
    quality,
    retention,
    serving,
    snapshot,
    state,
)
from tidings.plans import daily
from tidings.schema import NAME_VECTOR_SCHEMA, NEWS_SCHEMA, TARGET_SCHEMA
from tidings.sources import company, delimited, files, news, warehouse
from tidings.streaming import appending, incremental, ledger, windows

from .views import table, view

CURSOR = (10, "20260105")
# The columns of the news feed.
NEWS_FEED_COLUMNS = [
    "seq", "p_seq", "channel", "site_name", "basc_dt", "title", "content", "doc_sentiment", "part_basc_dt",
]


# --- sources -------------------------------------------------------------------------------------


def incremental_news(spark: SparkSession, sf: str) -> DataFrame:
    return news.new_articles(view(spark, sf, "v_news"), *CURSOR)


def daily_news_sql(spark: SparkSession, sf: str) -> DataFrame:
    view(spark, sf, "v_news").createOrReplaceTempView("v_news")
    return warehouse.daily_news(spark, "v_news", *CURSOR)


def recent_n_days(spark: SparkSession, sf: str) -> DataFrame:
    view(spark, sf, "v_news").createOrReplaceTempView("v_news")
    return warehouse.recent_news(spark, "v_news", days=4, base_date="20260128")


def limited_reads(spark: SparkSession, sf: str) -> DataFrame:
    """Catalog queries with a limit: how many rows each gives, and how many of them it gives without one, too."""
    view(spark, sf, "v_news").createOrReplaceTempView("v_news")
    reads = {
        "daily": lambda **most: warehouse.daily_news(spark, "v_news", *CURSOR, **most),
        "recent": lambda **most: warehouse.recent_news(spark, "v_news", days=4, base_date="20260128", **most),
        "table": lambda **most: warehouse.whole_table(spark, "v_news", **most),
    }
    counts = []
    for name, read in reads.items():
        every = read().select("seq", F.lit(True).alias("known")).distinct()
        found = read(limit=100).select("seq").join(every, "seq", "left")
        counts.append(found.agg(F.count("*").alias("n_rows"), F.count("known").alias("n_known")).select(F.lit(name).alias("read"), "n_rows", "n_known"))
    return files.union_by_name(*counts)


def table_snapshot(spark: SparkSession, sf: str) -> DataFrame:
    table(spark, sf, "customer").createOrReplaceTempView("customer")
    return warehouse.whole_table(spark, "customer")


def snapshot_manifest(spark: SparkSession, sf: str) -> DataFrame:
    """A catalog table, written and read back whole, with what its manifest counts."""
    table(spark, sf, "orders").createOrReplaceTempView("orders")
    path = storage.scratch_path(spark, "snapshot")
    told = snapshot.write_snapshot(warehouse.whole_table(spark, "orders"), path)
    return snapshot.read_snapshot(spark, path, check_rows=True).withColumn("rows", F.lit(told["rows"]).cast("bigint"))


def empty_to_null(spark: SparkSession, sf: str) -> DataFrame:
    view(spark, sf, "v_news").createOrReplaceTempView("v_news")
    return warehouse.fetch(spark, "SELECT seq, trim(title) AS title, basc_dt, site_name FROM v_news")


def newline_clean(spark: SparkSession, sf: str) -> DataFrame:
    return load.flatten_text(table(spark, sf, "documents").select("doc_id", "text"))


def new_file_scan(spark: SparkSession, sf: str) -> DataFrame:
    suffix = F.when(F.col("o_orderstatus") == "F", ".parquet").when(F.col("o_orderstatus") == "O", ".tmp")
    listing = table(spark, sf, "orders").select(
        F.concat(F.lit("chunk_"), F.col("o_orderkey"), F.coalesce(suffix, F.lit(".parquet.crc"))).alias("file_name")
    )
    return files.new_numbered_files(listing, last_done=5)


def new_chunks(spark: SparkSession, sf: str) -> DataFrame:
    """Orders in eight numbered files, of which the first five are done."""
    path = storage.scratch_path(spark, "chunks")
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    orders.withColumn("part", F.pmod("o_orderkey", F.lit(8)) + 1).repartition("part").write.partitionBy("part").parquet(f"{path}-parts")
    for k, file in ((int(f.rpartition("/part=")[2].partition("/")[0]), f) for f in storage.files_at(spark, f"{path}-parts/part=*")):
        storage.move(spark, file, f"{path}/chunk_{k}.parquet")
    return files.read_new_chunks(spark, path, 5, orders.schema)


def union_by_name(spark: SparkSession, sf: str) -> DataFrame:
    return files.union_by_name(
        table(spark, sf, "customer").select(
            F.col("c_custkey").alias("key"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment")
        ),
        table(spark, sf, "supplier").select(F.col("s_name").alias("name"), F.col("s_suppkey").alias("key")),
    )


# Bytes of records in a file of the feed. A part of more than that has several files, so that no task writes a whole part.
_FILE_BYTES = 384 << 20


def _record_line(names: list[str]) -> Column:
    """Nulls are written as empty fields, which is how they come back."""
    return F.concat_ws(delimited.FIELD_SEP, *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in names])


def _files_needed(rows: DataFrame, n_parts: int, file_bytes: int | None = None) -> int:
    """Files that each of ``n_parts`` parts of the rows needs, so that none has many more than ``file_bytes``."""
    size = rows.agg(F.sum(F.octet_length(_record_line(rows.columns)).cast("bigint"))).first()[0] or 0
    return max(1, math.ceil(size / n_parts / (file_bytes or _FILE_BYTES)))


def _write_delimited(rows: DataFrame, path: str, n_parts: int, first: int = 0, n_files: int | None = None) -> None:
    """Store rows as ``n_parts`` folders, from ``part=<first>``, with files of delimited records, a header record first in each.

    A part has ``n_files`` files, or as many as its size asks for; each is the work of one task.
    """
    spark = rows.sparkSession
    names = rows.columns
    n_files = n_files or _files_needed(rows, n_parts)
    key = F.xxhash64(*names)
    body = rows.select(
        F.pmod(key, F.lit(n_parts)).cast("int").alias("part"), F.pmod(F.shiftright(key, 24), F.lit(n_files)).cast("int").alias("file"),
        F.lit(1).alias("pos"), _record_line(names).alias("value"))
    heads = spark.range(n_parts * n_files).select(
        (F.col("id") % n_parts).cast("int").alias("part"), F.floor(F.col("id") / n_parts).cast("int").alias("file"),
        F.lit(0).alias("pos"), F.lit(delimited.FIELD_SEP.join(names)).alias("value")
    )
    (
        heads.unionByName(body)
        .repartitionById(n_parts * n_files, F.col("part") * n_files + F.col("file"))
        .withColumn("part", F.col("part") + first)
        .sortWithinPartitions("part", "pos")
        .select("part", "value")
        .write.mode("append").option("lineSep", delimited.RECORD_SEP)
        .partitionBy("part")
        .text(path)
    )


def _news_files(spark: SparkSession, sf: str) -> str:
    path = storage.scratch_path(spark, "news-files")
    _write_delimited(view(spark, sf, "v_news").select(NEWS_FEED_COLUMNS), path, 4)
    return path


def delimited_scan(spark: SparkSession, sf: str) -> DataFrame:
    return delimited.read_delimited(spark, _news_files(spark, sf) + "/part=*")


def delimited_layouts(spark: SparkSession, sf: str) -> DataFrame:
    """Files of two column orders, read with the known layout and without."""
    path = storage.scratch_path(spark, "layouts")
    feed = view(spark, sf, "v_news").select(NEWS_FEED_COLUMNS)
    _write_delimited(feed.where("seq % 2 = 0"), f"{path}/forward", 3)
    _write_delimited(feed.where("seq % 2 = 1").select(NEWS_FEED_COLUMNS[::-1]), f"{path}/backward", 2)
    paths = [f"{path}/forward/part=*", f"{path}/backward/part=*"]
    known = delimited.read_delimited(spark, paths, NEWS_FEED_COLUMNS).withColumn("layout", F.lit("known"))
    return known.unionByName(delimited.read_delimited(spark, paths).withColumn("layout", F.lit("own")))


def stream_overlap(spark: SparkSession, sf: str) -> DataFrame:
    """Two drains of a folder; before the second, every article comes again in other files."""
    source = _news_files(spark, sf)
    landed, state_path = storage.scratch_path(spark, "landed"), storage.scratch_path(spark, "stream-state")
    drain = lambda cursor: incremental.land_new_articles(
        spark, source + "/part=*", NEWS_FEED_COLUMNS, landed, state_path, cursor, max_files_per_trigger=3)
    first = drain(CURSOR)
    last = first.agg(F.max("seq")).first()[0]
    _write_delimited(view(spark, sf, "v_news").select(NEWS_FEED_COLUMNS[::-1]), source, 2, first=10)
    return drain((last, CURSOR[1]))


def _set_day(spark: SparkSession, folder: str, n: int) -> None:
    """Give the files of ``part=1`` to ``part=n`` modification times in that order, in which a stream then takes them."""
    fs, root = storage._fs(spark, folder)
    for k in range(1, n + 1):
        for status in fs.globStatus(storage._fs(spark, f"{folder}/part={k}/*.txt")[1]):
            fs.setTimes(status.getPath(), 1_700_000_000_000 + 1000 * k, -1)


def _daily_files(spark: SparkSession, sf: str, first: int, last: int, path: str) -> None:
    """Files for each day of the month, with the articles of that day and of the three before, and one short record.

    An article is moved once, to the task of its own day, which writes its copies; so a day has files from the tasks of four days.
    """
    feed = view(spark, sf, "v_news").select(NEWS_FEED_COLUMNS).where("part_basc_dt IS NOT NULL")
    day = F.substring("part_basc_dt", 7, 2).cast("int")
    reach = F.sequence(F.greatest(F.col("day"), F.lit(first)), F.least(F.col("day") + 3, F.lit(last)))
    start, n_files = max(1, first - 3), _files_needed(feed, 28, _FILE_BYTES // 2)  # of the four files' records, a task sorts all
    file = F.pmod(F.xxhash64(*NEWS_FEED_COLUMNS), F.lit(n_files)).cast("int")
    articles = feed.select(day.alias("day"), file.alias("file"), F.lit(1).alias("pos"), _record_line(NEWS_FEED_COLUMNS).alias("value"))
    days = spark.range(start * n_files, (last + 1) * n_files).select(
        F.floor(F.col("id") / n_files).cast("int").alias("day"), (F.col("id") % n_files).cast("int").alias("file"))
    head = days.select("*", F.lit(0).alias("pos"), F.lit(delimited.FIELD_SEP.join(NEWS_FEED_COLUMNS)).alias("value"))
    short = days.where((F.col("day") >= first) & (F.col("file") == 0)).select("*", F.lit(2).alias("pos"), F.lit(f"1{delimited.FIELD_SEP}1").alias("value"))
    rows = head.unionByName(articles.where(F.col("day").between(start, last))).unionByName(short)
    rows = rows.repartitionById((last + 1 - start) * n_files, (F.col("day") - start) * n_files + F.col("file"))
    own = F.when(F.col("pos") == 2, F.array("day")).otherwise(reach)  # the short record is that of its day alone
    (
        rows.withColumn("part", F.explode(own)).sortWithinPartitions("part", "pos").select("part", "value")
        .write.mode("append").option("lineSep", delimited.RECORD_SEP).partitionBy("part").text(path)
    )
    _set_day(spark, path, last)


def stream_windows(spark: SparkSession, sf: str) -> DataFrame:
    """Files of overlapping days, drained in several triggers, and again from the checkpoint when the later ones are there."""
    folder = storage.scratch_path(spark, "daily-files")
    landed, checkpoint = storage.scratch_path(spark, "landed"), storage.scratch_path(spark, "state")
    out = None
    for first, last in ((1, 14), (15, 28)):
        _daily_files(spark, sf, first, last, folder)
        out = windows.land_distinct(spark, f"{folder}/part=*", NEWS_FEED_COLUMNS, landed, checkpoint, max_files_per_trigger=7)
    counts = windows.read_counts(spark, windows.counts_path(landed)).agg(*(F.sum(c).alias(c) for c in ("records", "bad_records", "undated", "late"))).first()
    return out.select("*", *(F.lit(n).cast("bigint").alias(c) for c, n in counts.asDict().items()))


def stream_archive(spark: SparkSession, sf: str) -> DataFrame:
    """Where the records of files are after two drains that archive what they took: those of the second are still in the source."""
    root, archive = storage.scratch_path(spark, "feed"), storage.scratch_path(spark, "archive")
    feed = view(spark, sf, "v_news").select(NEWS_FEED_COLUMNS)
    landed, checkpoint = storage.scratch_path(spark, "landed"), storage.scratch_path(spark, "stream-state")
    for k in range(2):
        _write_delimited(feed.where(F.col("seq") % 2 == k), f"{root}/files{k}", 2)
        incremental.land_new_articles(
            spark, f"{root}/files*/part=*", NEWS_FEED_COLUMNS, landed, checkpoint, CURSOR, clean_source="archive", archive=archive)
    left = {"source": f"{root}/files*/part=*", "archive": f"{archive}/*" + "/*" * root.removeprefix("file:").strip("/").count("/") + "/files*/part=*"}
    read = lambda place: delimited.read_delimited(spark, left[place], NEWS_FEED_COLUMNS).select(F.lit(place).alias("place"), F.col("seq").cast("bigint").alias("seq"))
    return read("source").unionByName(read("archive"))


def stream_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Counts of landed files, some with short records, after the last micro-batch has run twice."""
    source = _news_files(spark, sf)
    short = view(spark, sf, "v_news").where("seq % 10 = 0").select("seq", "p_seq", "channel")
    line = F.concat_ws(delimited.FIELD_SEP, "seq", "p_seq", "channel")
    part = (F.pmod("seq", F.lit(20)) / 10 + 8).cast("int")
    head = spark.range(8, 10).select(F.col("id").cast("int").alias("part"), F.lit(0).alias("pos"), F.lit(delimited.FIELD_SEP.join(NEWS_FEED_COLUMNS)).alias("value"))
    rows = head.unionByName(short.select(part.alias("part"), F.lit(1).alias("pos"), line.alias("value")))
    rows = rows.repartitionByRange(2, "part").sortWithinPartitions("part", "pos")
    rows.select("part", "value").write.option("lineSep", delimited.RECORD_SEP).mode("append").partitionBy("part").text(source)
    landed, checkpoint = storage.scratch_path(spark, "landed"), storage.scratch_path(spark, "stream-state")
    for turn in range(2):
        incremental.land_new_articles(spark, source + "/part=*", NEWS_FEED_COLUMNS, landed, checkpoint, CURSOR, max_files_per_trigger=3)
        if not turn:
            last = max(int(n) for f in storage.files_at(spark, f"{checkpoint}/commits") if (n := f.rpartition("/")[2]).isdigit())
            storage.delete(spark, f"{checkpoint}/commits/{last}")
    return incremental.landed_counts(spark, landed, CURSOR)


def stream_incremental(spark: SparkSession, sf: str) -> DataFrame:
    source = _news_files(spark, sf)
    return incremental.land_new_articles(
        spark,
        source + "/part=*",
        NEWS_FEED_COLUMNS,
        storage.scratch_path(spark, "landed"),
        storage.scratch_path(spark, "stream-state"),
        CURSOR,
        max_files_per_trigger=2,
    )


def company_source(spark: SparkSession, sf: str) -> DataFrame:
    path = storage.scratch_path(spark, "company")
    view(spark, sf, "v_company").withColumn("cust_no", F.concat(F.lit(" "), "cust_no", F.lit("\n"))).write.parquet(path)
    return company.load_companies(spark, path)


# --- projections and expressions -----------------------------------------------------------------


def align_schema(spark: SparkSession, sf: str) -> DataFrame:
    return align.align(view(spark, sf, "v_news").drop("site_name", "doc_sentiment"), NEWS_SCHEMA)


def target_projection(spark: SparkSession, sf: str) -> DataFrame:
    return align.to_target(
        view(spark, sf, "v_news").withColumns({"category": F.lit("RISK"), "cust_no": F.lpad(F.col("seq").cast("string"), 6, "0")})
    )


def reference_string(spark: SparkSession, sf: str) -> DataFrame:
    return view(spark, sf, "v_news").select("seq", text.reference_text("title", "basc_dt", "site_name").alias("reference"))


def date_normalize(spark: SparkSession, sf: str) -> DataFrame:
    return view(spark, sf, "v_news").select("seq", text.normalize_date("basc_dt").alias("basc_dt"))


def numeric_keys(spark: SparkSession, sf: str) -> DataFrame:
    """Keys of 19 digits, given as text, and their neighbours."""
    key = lambda c: F.concat(F.lit("10000000000"), F.lpad(c.cast("string"), 8, "0"))
    own, other = key(F.col("o_orderkey")), key(F.col("o_orderkey") + F.col("o_orderkey") % 2)
    return table(spark, sf, "orders").select("o_orderkey", text.to_long(own).alias("number"), text.same_number(own, other).alias("same"))


def context_text(spark: SparkSession, sf: str) -> DataFrame:
    articles = view(spark, sf, "v_news").select(
        F.lit("article").alias("kind"), F.col("seq").alias("id"),
        text.article_context("title", "content").alias("context"),
    )
    companies = view(spark, sf, "v_company").select(
        F.lit("company"), F.col("cust_no").cast("bigint"),
        text.company_context("std_inds_clas_nm", "primy_prod_nm", "cust_nm"),
    )
    return articles.union(companies)


def prompt_render(spark: SparkSession, sf: str) -> DataFrame:
    return view(spark, sf, "v_news").select("seq", inference.article_prompt().alias("prompt"))


def normalize_name(spark: SparkSession, sf: str) -> DataFrame:
    names = [
        table(spark, sf, t).select(F.lit(t).alias("kind"), F.col(key).alias("id"), F.col(name).alias("name"))
        for t, key, name in (("part", "p_partkey", "p_name"), ("supplier", "s_suppkey", "s_name"), ("customer", "c_custkey", "c_name"))
    ]
    marks = [F.lit(""), F.lit("(주)"), F.lit("주식회사 "), F.lit(" ")]
    raw = files.union_by_name(*names).withColumn(
        "name", F.concat(F.element_at(F.array(*marks), (F.col("id") % 4 + 1).cast("int")), "name", F.lit(" Inc."))
    )
    return raw.select("kind", "id", text.normalize_company_name("name").alias("clean_name"))


def cosine_pairs(spark: SparkSession, sf: str) -> DataFrame:
    a = table(spark, sf, "embeddings").alias("a")
    b = table(spark, sf, "embeddings").alias("b")
    cos = vectors.cosine(F.col("a.embedding"), F.col("b.embedding"))
    return a.join(b, F.col("b.vec_id") == F.col("a.vec_id") + 1).select(
        F.col("a.vec_id").alias("vec_id"),
        F.round(cos, 4).alias("cos"),
        F.round(vectors.relevance(cos), 4).alias("relevance"),
    )


# --- cursor, master ------------------------------------------------------------------------------


def cursor_argmax(spark: SparkSession, sf: str) -> DataFrame:
    return state.next_cursor(view(spark, sf, "v_news"))


def max_id(spark: SparkSession, sf: str) -> DataFrame:
    return ids.max_id(table(spark, sf, "orders"), "o_orderkey")


def latest_per_key(spark: SparkSession, sf: str) -> DataFrame:
    return master.latest_per_customer(view(spark, sf, "v_company_hist"), ties=["tie1", "tie2"])


def master_fingerprint(spark: SparkSession, sf: str) -> DataFrame:
    return master.fingerprint(view(spark, sf, "v_company"))


def _clean_company(spark: SparkSession, sf: str) -> DataFrame:
    return master.with_clean_name(view(spark, sf, "v_company"))


def master_delta(spark: SparkSession, sf: str) -> DataFrame:
    # Companies of one industry were stored under an older name.
    old = F.when(F.col("std_inds_clas_nm") == "ECONOMY", F.concat("clean_cust_nm", F.lit("old")))
    stored = _clean_company(spark, sf).select("cust_no", F.coalesce(old, "clean_cust_nm").alias("clean_cust_nm"))
    return master.unseen_rows(_clean_company(spark, sf), stored, ["cust_no", "clean_cust_nm"]).select(
        "cust_no", "clean_cust_nm"
    )


def digest_changes(spark: SparkSession, sf: str) -> DataFrame:
    """Companies against a version with other names in one industry, one lacking and one more, and against themselves."""
    now = storage.materialize(_clean_company(spark, sf).select("cust_no", "clean_cust_nm", "std_inds_clas_nm"), label="companies")
    old = F.when(F.col("std_inds_clas_nm").startswith("ECONOMY"), F.concat("clean_cust_nm", F.lit("old"))).otherwise(F.col("clean_cust_nm"))
    before = now.withColumn("clean_cust_nm", old).where("cust_no % 7 <> 3")
    gone = now.where("cust_no % 7 = 5").withColumn("cust_no", F.concat(F.lit("x"), "cust_no"))
    stored = digest_tree.KeyedSnapshot(spark, storage.scratch_path(spark, "snapshot"), ["cust_no"], ["clean_cust_nm"])
    for version in (before.unionByName(gone), now):
        changes = stored.compare(version)
        rows = storage.materialize(changes.rows, label="changes")
        stored.save(version, changes)
    return rows.select("*", F.lit(len(stored.compare(now).buckets)).cast("bigint").alias("buckets_left"))


# --- responses -----------------------------------------------------------------------------------


def json_repair(spark: SparkSession, sf: str) -> DataFrame:
    parsed = responses.parse_json_text(view(spark, sf, "v_llm_raw"), "raw_content")
    return parsed.select("seq", "parse_status", F.try_variant_get("parsed", "$.results.id", "string").alias("id"))


def _parsed(spark: SparkSession, sf: str) -> DataFrame:
    return responses.parse_responses(view(spark, sf, "v_llm_raw"))


def llm_response_parse(spark: SparkSession, sf: str) -> DataFrame:
    return _parsed(spark, sf).select("seq", "classification", "category", "summary")


def name_list_parse(spark: SparkSession, sf: str) -> DataFrame:
    return _parsed(spark, sf).select(
        "seq", F.size("company_names").cast("bigint").alias("n_names"), F.concat_ws(",", "company_names").alias("names")
    )


def llm_error_split(spark: SparkSession, sf: str) -> DataFrame:
    return _parsed(spark, sf).select("seq", "llm_error", "parse_status")


def explode_mentions(spark: SparkSession, sf: str) -> DataFrame:
    return matching.explode_mentions(_parsed(spark, sf).select("seq", "classification", "company_names"))


def extraction_rate(spark: SparkSession, sf: str) -> DataFrame:
    return quality.extraction_rate(_parsed(spark, sf))


def _reply(prompt: str) -> str:
    """Offline stand-in for the model: names the company in the title, as the prompt asks."""
    number = re.search(r"^ID: (\d+)$", prompt, re.M).group(1)
    title = re.search(r"^Title: (.*)$", prompt, re.M).group(1)
    name = title.split(" | ")[0] if " | " in title else ""
    if number.endswith("7"):
        raise TimeoutError("no answer")
    kind = "noise" if number.endswith("3") else "essential"
    names = f'["{name}"]' if name.strip() else "[]"
    return (
        f'{{"results":{{"id":{number},"company_names":{names},"classification":"{kind}",'
        f'"category":"RISK","summary":"{len(prompt)} characters"}}}}'
    )


def batch_inference(spark: SparkSession, sf: str) -> DataFrame:
    extracted = inference.extract_articles(view(spark, sf, "v_news").select(NEWS_SCHEMA.names), _reply)
    return extracted.select(
        "seq", "basc_dt", F.concat_ws(",", "company_names").alias("names"),
        "classification", "category", "summary", "llm_error", "parse_status", "reference",
    )


def embed_texts(spark: SparkSession, sf: str) -> DataFrame:
    embedded = inference.embed(
        table(spark, sf, "documents").select("doc_id", "text"), "text", vectors.bigram_encoder, vectors.BIGRAM_ENCODER_ID
    )
    weights = embedded.select("doc_id", F.posexplode("embedding").alias("bucket", "weight"))
    return weights.where(F.col("weight") > 0).select(
        "doc_id", F.col("bucket").cast("bigint").alias("bucket"),
        F.floor(F.col("weight").cast("double") * 1000000).cast("bigint").alias("weight_ppm"),
    )


# --- matching ------------------------------------------------------------------------------------


def _mentions(spark: SparkSession, sf: str) -> DataFrame:
    return matching.with_clean_target(view(spark, sf, "v_mention"))


def _directory(spark: SparkSession, sf: str) -> DataFrame:
    return master.name_directory(_clean_company(spark, sf))


def exact_name_match(spark: SparkSession, sf: str) -> DataFrame:
    found = matching.exact_match(_mentions(spark, sf), _directory(spark, sf))
    return found.select(
        "seq", "target_company", "clean_target_company", F.coalesce("n_candidates", F.lit(0)).alias("n_candidates"),
        "cust_no", "cust_nm",
    )


def _vector_sides(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """All vectors read backwards as queries, all vectors as the index."""
    e = table(spark, sf, "embeddings")
    return (
        e.select(F.col("vec_id").alias("query_key"), F.reverse("embedding").alias("query_vec")),
        e.select(F.col("vec_id").alias("item_key"), F.col("embedding").alias("item_vec")),
    )


def _hits(found: DataFrame) -> DataFrame:
    return found.select(
        F.col("query_key").alias("query_id"), F.col("item_key").alias("item_id"), F.round("score", 4).alias("score")
    )


def vector_top1(spark: SparkSession, sf: str) -> DataFrame:
    return _hits(nearest.nearest(*_vector_sides(spark, sf)))


def vector_threshold(spark: SparkSession, sf: str) -> DataFrame:
    return _hits(nearest.nearest(*_vector_sides(spark, sf), threshold=0.2, cell_rows=100))


def vector_near_copies(spark: SparkSession, sf: str) -> DataFrame:
    """Vectors with one entry moved a little, searched at the highest threshold in small and in large cells."""
    e = table(spark, sf, "embeddings")
    step = F.col("vec_id") % 10 * F.lit(0.0002)
    moved = F.transform("embedding", lambda x, i: x.cast("double") + F.when(i == F.col("vec_id") % 64, step).otherwise(F.lit(0.0)))
    queries = storage.materialize(e.select(F.col("vec_id").alias("query_key"), moved.alias("query_vec")), label="moved")
    index = _vector_sides(spark, sf)[1]
    found = [
        _hits(nearest.nearest(queries, index, 1.0, **cells)).withColumn("cells", F.lit(name))
        for name, cells in (("small", {"cell_rows": 20}), ("default", {}))
    ]
    return found[0].unionByName(found[1])


def vector_approximate(spark: SparkSession, sf: str) -> DataFrame:
    """Each vector, with every entry moved, to its nearest: exact hits, and whether projections find nine in ten of them."""
    e = table(spark, sf, "embeddings")
    step = lambda i: ((F.col("vec_id") * 31 + i * 17) % 11 - 5) * F.lit(0.015)
    moved = F.transform("embedding", lambda x, i: x.cast("double") + step(i))
    queries = storage.materialize(e.select(F.col("vec_id").alias("query_key"), moved.alias("query_vec")), label="moved")
    index = _vector_sides(spark, sf)[1]
    exact = storage.materialize(nearest.nearest(queries, index), label="exact")
    found = storage.materialize(approximate.nearest_approximate(queries, index), label="found")
    told = approximate.recall(found, exact).first()
    better = found.join(exact.select("query_key", F.col("cos").alias("best")), "query_key").where(F.col("cos") > F.col("best") + 1e-5).count()
    return _hits(exact).select(
        "*", F.lit(found.count()).cast("bigint").alias("answered"), F.lit(better).cast("bigint").alias("better_than_exact"),
        F.lit(told.found >= 0.9 * told.n).alias("recall_reached"))


def _embedded(df: DataFrame, column: str) -> DataFrame:
    return storage.materialize(
        inference.embed(df, column, vectors.bigram_encoder, vectors.BIGRAM_ENCODER_ID), label="vectors"
    )


def _cascade(spark: SparkSession, sf: str, threshold: float = 0.5) -> DataFrame:
    mentions = storage.materialize(_mentions(spark, sf), label="mentions")
    directory = _directory(spark, sf)
    searched = _embedded(matching.unmatched_names(mentions, directory), "clean_target_company")
    known = _embedded(_clean_company(spark, sf).select("clean_cust_nm").distinct(), "clean_cust_nm")
    hits = matching.vector_match(searched, known, directory, vectors.BIGRAM_ENCODER_ID, threshold)
    return matching.cascade(mentions, directory, hits)


def cascade_match(spark: SparkSession, sf: str) -> DataFrame:
    return _cascade(spark, sf).select(
        "seq", "target_company", "mapping_method", F.round("similarity_score", 4).alias("similarity_score"),
        "matched_clean_name", "n_candidates", "cust_no",
    )


def match_enrich(spark: SparkSession, sf: str) -> DataFrame:
    return matching.enrich(
        _cascade(spark, sf).select("seq", "target_company", "cust_no", "cust_nm"), view(spark, sf, "v_company")
    )


def duplicate_flag(spark: SparkSession, sf: str) -> DataFrame:
    return dedup.flag_duplicates(view(spark, sf, "v_mention"), ["seq", "target_company"])


def homonym_resolve(spark: SparkSession, sf: str) -> DataFrame:
    """Contexts are vectors of the embeddings table, dealt out to articles and companies by number."""
    companies = _clean_company(spark, sf)
    matched = matching.cascade(
        matching.distinct_mentions(_mentions(spark, sf)),
        _directory(spark, sf),
        spark.createDataFrame([], "clean_target_company string, matched_clean_name string, similarity_score double"),
    )
    kept = "seq", "target_company", "matched_clean_name", "n_candidates", "cust_no", "cust_nm"
    named = storage.materialize(matched.select(*kept), label="named")
    e = table(spark, sf, "embeddings")
    n = e.count()
    articles = named.select("seq").distinct().withColumn("context_key", F.col("seq") % n)
    company_keys = companies.select("clean_cust_nm", "cust_no", (F.col("cust_no").cast("bigint") % n).alias("context_key"))
    resolved = homonyms.resolve_homonyms(
        named, articles, company_keys, companies.select("cust_no", "cust_nm"),
        e.select(F.col("vec_id").alias("context_key"), "embedding"),
    )
    return resolved.select("seq", "target_company", "cust_no", "cust_nm", F.round("homonym_score", 4).alias("homonym_score"))


def distinct_rows(spark: SparkSession, sf: str) -> DataFrame:
    return view(spark, sf, "v_mention").distinct()


def _exact_rows(spark: SparkSession, sf: str) -> DataFrame:
    found = matching.exact_match(_mentions(spark, sf), _directory(spark, sf))
    return found.where(F.col("cust_no").isNotNull()).withColumn("mapping_method", F.lit(matching.EXACT))


def dedup_keep_first(spark: SparkSession, sf: str) -> DataFrame:
    rows = matching.one_per_customer(_exact_rows(spark, sf), ["classification"])
    return rows.select("seq", "cust_no", "target_company", "classification")


def essential_filter(spark: SparkSession, sf: str) -> DataFrame:
    rows = matching.exact_match(_mentions(spark, sf), _directory(spark, sf))
    return matching.essential(rows).select("seq", "classification", "target_company", "cust_no")


def mapping_rate(spark: SparkSession, sf: str) -> DataFrame:
    rate = quality.mapping_rate(matching.exact_match(_mentions(spark, sf), _directory(spark, sf)))
    return rate.withColumn("mapping_rate", F.round("mapping_rate", 6))


# --- load and serving ----------------------------------------------------------------------------


def serving_filter(spark: SparkSession, sf: str) -> DataFrame:
    return serving.serving_filter(view(spark, sf, "v_target"))


def serving_export(spark: SparkSession, sf: str) -> DataFrame:
    path = storage.scratch_path(spark, "serving")
    serving.export_serving(view(spark, sf, "v_target"), path)
    return spark.read.schema(_text_target()).parquet(path)


def serving_lookup(spark: SparkSession, sf: str) -> DataFrame:
    """Served rows by customer number, and by the numbers of the benchmark items taken for articles."""
    path = storage.scratch_path(spark, "serving")
    serving.export_serving(view(spark, sf, "v_target"), path)
    by_customer = serving.lookup(spark, path, etct_cust_no=[f"{k:06d}" for k in range(8, 100, 10)])
    wanted = [r.seq for r in table(spark, sf, "benchmark").select(F.col("item_id").cast("string").alias("seq")).distinct().collect()]
    by_article = serving.lookup(spark, path, seq=wanted)
    return by_customer.select(F.lit("customer").alias("by"), "news_mppg_id").unionByName(by_article.select(F.lit("article").alias("by"), "news_mppg_id"))


def _text_target() -> T.StructType:
    return T.StructType([T.StructField(f.name, T.StringType()) for f in TARGET_SCHEMA.fields])


def _second_load(rows: DataFrame) -> DataFrame:
    return rows.withColumn("seq", F.col("seq") + 1000000000)


_LOAD_ORDER = ["seq", "etct_cust_no", "news_tite"]


def append_with_ids(spark: SparkSession, sf: str) -> DataFrame:
    rows = align.align(view(spark, sf, "v_target"), TARGET_SCHEMA)
    path = storage.scratch_path(spark, "target")
    load.append_with_ids(spark, rows, path, _LOAD_ORDER)
    load.append_with_ids(spark, _second_load(rows), path, _LOAD_ORDER)
    return storage.read_or_empty(spark, path, TARGET_SCHEMA).select(
        "news_mppg_id", "seq", "etct_cust_no", "news_tite", "basc_dt"
    )


def idempotent_append(spark: SparkSession, sf: str) -> DataFrame:
    rows = align.align(view(spark, sf, "v_target"), TARGET_SCHEMA)
    once = dedup.keep_first(rows, load.LOAD_KEY, ["news_tite"])
    path = storage.scratch_path(spark, "target")
    load.append_with_ids(spark, once, path)
    load.append_with_ids(spark, once, path)
    load.append_with_ids(spark, files.union_by_name(once, _second_load(once)), path)
    return storage.read_or_empty(spark, path, TARGET_SCHEMA).select("news_mppg_id", "seq", "etct_cust_no", "news_tite")


def catalog_insert(spark: SparkSession, sf: str) -> DataFrame:
    """Two inserts into a catalog table."""
    name = f"target_{uuid.uuid4().hex}"
    load.create_target_table(spark, name, storage.scratch_path(spark, "catalog"))
    rows = align.align(view(spark, sf, "v_target"), TARGET_SCHEMA).withColumn("news_ctt", F.concat("news_tite", F.lit("\r\nend")))
    load.insert_with_ids(spark, rows, name, _LOAD_ORDER)
    load.insert_with_ids(spark, _second_load(rows), name, _LOAD_ORDER)
    return spark.table(name).select("news_mppg_id", "seq", "etct_cust_no", "news_tite", "news_ctt", "basc_dt")


def cursor_state(spark: SparkSession, sf: str) -> DataFrame:
    """The state after two loads, the second of them published."""
    path = storage.scratch_path(spark, "state")
    news_rows = view(spark, sf, "v_news")
    for rows in (news_rows.where("seq % 3 = 0"), news_rows):
        top = state.next_cursor(rows).first()
        state.save_cursor(spark, path, top.last_seq, top.last_part_basc_dt or "None", state.load_last_id(spark, path) + rows.count())
    state.save_published_id(spark, path, state.load_last_id(spark, path))
    last_seq, last_day = state.load_cursor(spark, path)
    row = (last_seq, last_day, state.load_last_id(spark, path), state.load_published_id(spark, path))
    return spark.createDataFrame([row], "last_seq bigint, last_part_basc_dt string, last_id bigint, published_id bigint")


def vector_refresh(spark: SparkSession, sf: str) -> DataFrame:
    """Name vectors after the companies of one industry, and after all; names of both are embedded once."""
    path = storage.scratch_path(spark, "name-vectors")
    companies = storage.materialize(_clean_company(spark, sf), label="companies")
    for turn, rows in enumerate((companies.where("std_inds_clas_nm = 'ECONOMY'"), companies)):
        stored = storage.read_or_empty(spark, path, NAME_VECTOR_SCHEMA)
        save = lambda new, n=turn: new.write.mode("append").parquet(f"{path}/turn={n}")
        master.refresh_name_vectors(rows, stored, vectors.bigram_encoder, vectors.BIGRAM_ENCODER_ID, save)
    return spark.read.parquet(path).select(
        "clean_cust_nm", "encoder_id", F.size("embedding").cast("bigint").alias("dim"), F.col("turn").cast("bigint").alias("turn"))


def row_chunks(spark: SparkSession, sf: str) -> DataFrame:
    return ids.with_chunk_index(table(spark, sf, "orders").select("o_orderkey"), ["o_orderkey"], 1000)


def retention_partitions(spark: SparkSession, sf: str) -> DataFrame:
    folders = table(spark, sf, "events").select(F.date_format("ts", "yyyyMMdd").alias("folder")).distinct()
    named = folders.unionByName(table(spark, sf, "events").select(F.col("event_type").alias("folder")).distinct())
    return retention.expired(named, today="20240130")


def catalog_retention(spark: SparkSession, sf: str) -> DataFrame:
    """What is left of a catalog table, some of its rows without a day, when its expired partitions are dropped."""
    name = f"target_{uuid.uuid4().hex}"
    load.create_target_table(spark, name, storage.scratch_path(spark, "catalog"))
    day = F.when(F.col("seq") % 9 != 0, F.col("basc_dt"))
    load.insert_with_ids(spark, align.align(view(spark, sf, "v_target").withColumn("basc_dt", day), TARGET_SCHEMA), name, _LOAD_ORDER)
    gone = retention.drop_expired_partitions(spark, name, today="20260128", days=14, remove_files=True)
    partitions = retention.catalog_partitions(spark, name).count()
    return spark.table(name).select(
        "seq", "news_tite", "basc_dt", F.lit(len(gone)).cast("bigint").alias("dropped"), F.lit(partitions).cast("bigint").alias("partitions_left"))


def dup_audit(spark: SparkSession, sf: str) -> DataFrame:
    return quality.duplicate_audit(view(spark, sf, "v_target"))


def run_summary(spark: SparkSession, sf: str) -> DataFrame:
    found = matching.exact_match(_mentions(spark, sf), _directory(spark, sf))
    return quality.stage_counts(
        loaded=incremental_news(spark, sf),
        extracted=_parsed(spark, sf).where(F.size("company_names") > 0),
        mapped=matching.essential(found),
        appended=view(spark, sf, "v_target"),
    )


# --- whole run -----------------------------------------------------------------------------------


def _inputs(spark: SparkSession, sf: str, news_rows: DataFrame | None = None, news_folder: str = "news") -> str:
    root = storage.scratch_path(spark, "run")
    (view(spark, sf, "v_news") if news_rows is None else news_rows).write.parquet(f"{root}/{news_folder}")
    view(spark, sf, "v_company_hist").drop("tie1", "tie2").write.parquet(f"{root}/company")
    return root


def _day(spark: SparkSession, root: str, run_dt: str = "20260128", news_folder: str = "news", **settings) -> tuple[daily.Layout, daily.Summary]:
    layout = daily.Layout(f"{root}/warehouse")
    summary = daily.run_daily(
        spark, layout, f"{root}/{news_folder}", f"{root}/company", daily.Models(_reply), run_dt, threshold=0.5, **settings)
    return layout, summary


def _run(spark: SparkSession, sf: str) -> daily.Layout:
    return _day(spark, _inputs(spark, sf))[0]


class _Lost(Exception):
    """What a query raises on purpose, to fail a run at one place."""


def _failing(name: str):
    return mock.patch.object(daily, name, side_effect=_Lost)


def resume_run(spark: SparkSession, sf: str) -> DataFrame:
    """A run that is lost before the append, and called again."""
    root = _inputs(spark, sf)
    try:
        with _failing("append_with_ids"):
            _day(spark, root)
    except _Lost:
        pass
    return storage.read_or_empty(spark, _day(spark, root)[0].target, TARGET_SCHEMA)


def input_cleanup(spark: SparkSession, sf: str) -> DataFrame:
    """A run that removes the files it has read; those put in their place stay, as the same day's second call doesn't read them."""
    root = _inputs(spark, sf)
    feed = view(spark, sf, "v_news").select(NEWS_FEED_COLUMNS)
    left = []
    for name, rows in (("first", feed), ("second", feed.where("seq % 2 = 0"))):
        _write_delimited(rows, f"{root}/{name}", 2)
        for k, file in enumerate(storage.files_at(spark, f"{root}/{name}/part=*")):
            storage.move(spark, file, f"{root}/news-{k}.csv")
        layout, _ = _day(spark, root, news_folder="news-*.csv", news_columns=NEWS_FEED_COLUMNS)
        left.append(F.lit(storage.matches(spark, f"{root}/news-*.csv")).alias(f"{name}_left"))
    return storage.read_or_empty(spark, layout.target, TARGET_SCHEMA).select("*", *left)


def stream_target(spark: SparkSession, sf: str) -> DataFrame:
    """Two micro-batches through the whole run; the first one's append isn't committed, and is done again."""
    root = _inputs(spark, sf)
    feed = view(spark, sf, "v_news").select(NEWS_FEED_COLUMNS)
    halves = [feed.where(F.col("seq") % 2 == k) for k in range(2)]
    n_files = max(_files_needed(rows, 1) for rows in halves)  # a micro-batch takes one half, however many files that is
    for k, rows in enumerate(halves):
        _write_delimited(rows, f"{root}/files{k}", 1, n_files=n_files)
    layout = daily.Layout(f"{root}/warehouse")

    def drain() -> DataFrame:
        return appending.stream_to_target(
            spark, layout, f"{root}/files*/part=0", NEWS_FEED_COLUMNS, f"{root}/company", daily.Models(_reply), threshold=0.5, max_files_per_trigger=n_files)

    real = ledger.commit
    lost = lambda s, path, stream, *args: real(s, path, stream, *args) if stream == "opening" else _lose()
    try:
        with mock.patch.object(ledger, "commit", side_effect=lost):
            drain()
    except StreamingQueryException:
        pass
    counts = drain().first().asDict()
    rows = ledger.read_committed(spark, layout.target, layout.ledger)
    return rows.drop("news_mppg_id").select("*", *(F.lit(counts[c]).cast("bigint").alias(c) for c in ("batches", "records", "loaded", "mapped", "appended")))


def _lose() -> None:
    raise _Lost


def serving_after_failed_publish(spark: SparkSession, sf: str) -> DataFrame:
    """Three days: the second one's publishing fails, the third has nothing new."""
    # One partition, so that the cursor's day excludes nothing. The first day's articles come again on the others.
    root = _inputs(spark, sf, view(spark, sf, "v_news").withColumn("part_basc_dt", F.lit("20260105")), "day2")
    feed = spark.read.parquet(f"{root}/day2")
    middle = feed.agg(F.max("seq")).first()[0] // 2
    feed.where(F.col("seq") <= middle).write.parquet(f"{root}/day1")
    _day(spark, root, "20260126", "day1")
    try:
        with _failing("export_serving"):
            _day(spark, root, "20260127", "day2")
    except _Lost:
        pass
    layout, _ = _day(spark, root, "20260128", "day2")
    return spark.read.schema(_text_target()).parquet(layout.serving).select("seq", "etct_cust_no", "news_clas", "basc_dt")


def dry_run_preview(spark: SparkSession, sf: str) -> DataFrame:
    return _day(spark, _inputs(spark, sf), dry_run=True)[1].preview


def daily_run(spark: SparkSession, sf: str) -> DataFrame:
    layout = _run(spark, sf)
    return storage.read_or_empty(spark, layout.target, TARGET_SCHEMA)


def daily_run_serving(spark: SparkSession, sf: str) -> DataFrame:
    layout = _run(spark, sf)
    return spark.read.schema(_text_target()).parquet(layout.serving).select("seq", "etct_cust_no", "news_clas", "basc_dt")


def company_mentions(spark: SparkSession, sf: str) -> DataFrame:
    """The smallest whole question: which customers are essential articles about?"""
    companies = master.with_clean_name(
        master.company_columns(master.latest_per_customer(view(spark, sf, "v_company_hist"), ties=["tie1", "tie2"]))
    )
    companies = storage.materialize(companies, label="companies")  # ranked once for both uses
    found = matching.exact_match(_mentions(spark, sf), master.name_directory(companies))
    rows = matching.essential(found).withColumn("mapping_method", F.lit(matching.EXACT))
    once = matching.one_per_customer(rows).select("seq", "cust_no", "cust_nm")
    return matching.enrich(once, companies.drop("clean_cust_nm"))


QUERIES = {
    f.__name__: f
    for f in (
        company_mentions, incremental_news, daily_news_sql, recent_n_days, table_snapshot, empty_to_null,
        newline_clean, new_file_scan, union_by_name, delimited_scan, stream_incremental, company_source,
        align_schema, target_projection, reference_string, date_normalize, context_text, prompt_render,
        normalize_name, cosine_pairs, cursor_argmax, max_id, latest_per_key, master_fingerprint, master_delta,
        json_repair, llm_response_parse, name_list_parse, llm_error_split, explode_mentions, extraction_rate,
        batch_inference, embed_texts, exact_name_match, vector_top1, vector_threshold, cascade_match,
        match_enrich, duplicate_flag, homonym_resolve, distinct_rows, dedup_keep_first, essential_filter,
        mapping_rate, serving_filter, serving_export, append_with_ids, idempotent_append, row_chunks,
        retention_partitions, dup_audit, run_summary, daily_run, daily_run_serving, numeric_keys, vector_near_copies,
        delimited_layouts, stream_overlap, catalog_insert, cursor_state, vector_refresh, resume_run, dry_run_preview,
        serving_after_failed_publish, stream_windows, stream_counts, stream_target, vector_approximate,
        digest_changes, serving_lookup, stream_archive, catalog_retention, snapshot_manifest, new_chunks,
        limited_reads, input_cleanup,
    )
}
