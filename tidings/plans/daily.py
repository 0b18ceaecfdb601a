"""One incremental run: load, extract, match, append, publish.

Every stage is a table below the run's own folder. A stage whose write was committed is read back, so
a run that failed is resumed by calling it again with the same ``run_dt``: model calls are not repeated.
The cursor is saved after the append, and the append skips rows that are already in the target. Publishing goes by the
largest published id, which is saved last, so that what a failed run left out is made up by the next one.
"""

from __future__ import annotations

import hashlib
import time
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from .. import storage
from ..functions.vectors import BIGRAM_ENCODER_ID, bigram_encoder
from ..operators import digest_tree, homonyms, matching
from ..operators.align import keep_present, to_target
from ..operators.dedup import keep_first
from ..operators.inference import DEFAULT_TEMPLATE, embed, extract_articles
from ..operators.load import append_with_ids
from ..operators.master import (
    company_columns,
    latest_per_customer,
    name_directory,
    refresh_name_vectors,
    with_clean_name,
)
from ..operators.retention import RETENTION_DAYS, remove_expired
from ..operators.serving import export_serving
from ..operators.state import (
    load_cursor,
    load_last_id,
    load_published_id,
    next_cursor,
    save_cursor,
    save_published_id,
)
from ..schema import ID_COLUMN, NAME_VECTOR_SCHEMA, PARTITION_COLUMN, TARGET_SCHEMA
from ..sources.company import load_companies
from ..sources.files import input_files, is_delimited
from ..sources.news import load_new_articles

# Article columns carried to the target.
ARTICLE_COLUMNS = [
    "seq", "site_name", "basc_dt", "title", "content", "classification", "category",
    "doc_sentiment", "summary", "reference",
]
PREVIEW_ROWS = 5
PREVIEW_COLUMNS = ["seq", "site_nm", "news_tite", "news_clas", "doc_sentiment", "etct_cust_nm", "etct_cust_no"]


@dataclass
class Layout:
    """Where the tables of a deployment are."""

    root: str
    target: str = field(init=False)
    serving: str = field(init=False)
    name_vectors: str = field(init=False)
    name_digests: str = field(init=False)
    state: str = field(init=False)
    runs: str = field(init=False)
    landed: str = field(init=False)
    stream: str = field(init=False)
    batches: str = field(init=False)
    ledger: str = field(init=False)

    def __post_init__(self) -> None:
        for name in ("target", "serving", "name_vectors", "name_digests", "state", "runs", "landed", "stream", "batches", "ledger"):
            setattr(self, name, f"{self.root.rstrip('/')}/{name}")


@dataclass
class Models:
    """The model calls of a run, and what goes with them.

    At most ``concurrency`` calls run at once, spread over ``tasks`` tasks (the session's parallelism unless given);
    texts are embedded in as many tasks. ``window_chars`` is how many characters of a text the encoder reads at once,
    if it can't read all.
    """

    complete: Callable[[str], str]
    encode: Callable[[list[str]], object] = bigram_encoder
    encoder_id: str = BIGRAM_ENCODER_ID
    template: str = DEFAULT_TEMPLATE
    concurrency: int = 50
    tasks: int | None = None
    window_chars: int | None = None

    def embed(self, df: DataFrame, text: str) -> DataFrame:
        return embed(df, text, self.encode, self.encoder_id, tasks=self.tasks, window_chars=self.window_chars)


@dataclass
class Summary:
    """Counts of a run. ``bad_records`` and ``late`` are None unless this try has read a delimited feed."""

    loaded: int = 0
    bad_records: int | None = None
    late: int | None = None
    refreshed: bool | None = None
    considered: int = 0
    served: int = 0
    extracted: int = 0
    mapped: int = 0
    appended: int = 0
    seconds: float = 0.0
    preview: DataFrame | None = None


def _stage(spark: SparkSession, path: str, build: Callable[[], DataFrame]) -> DataFrame:
    """The stage table at ``path``, built unless an earlier try has committed it."""
    if storage.is_complete(spark, path):
        return spark.read.parquet(path)
    return storage.materialize(build(), path)


_INPUT_SCHEMA = "path string, length bigint, modified bigint"
_SETTING_SCHEMA = "name string, value string"


def prepare_master(feed: DataFrame) -> DataFrame:
    return with_clean_name(company_columns(latest_per_customer(feed)))


def essential_mentions(extracted: DataFrame) -> DataFrame:
    """Distinct mentions of essential articles. The class belongs to the article, so filtering first is safe."""
    articles = extracted.where(F.col("classification") == "essential").select("seq", "company_names")
    return matching.distinct_mentions(matching.with_clean_target(matching.explode_mentions(articles)))


def match_mentions(
    extracted: DataFrame,
    master: DataFrame,
    name_vectors: DataFrame,
    models: Models,
    threshold: float,
    stage: Callable[[str, Callable[[], DataFrame]], DataFrame],
) -> DataFrame:
    """One row per article and target name with its company, method and scores: the match audit.

    ``stage`` stores an intermediate table; model output always goes through it.
    """
    directory = stage("directory", lambda: name_directory(master))
    mentions = stage("mentions", lambda: essential_mentions(extracted))
    searched = stage(
        "mention_vectors",
        lambda: models.embed(matching.unmatched_names(mentions, directory), "clean_target_company"),
    )
    hits = matching.vector_match(searched, name_vectors, directory, models.encoder_id, threshold)
    named = stage("named", lambda: matching.cascade(mentions, directory, hits))

    # Contexts only of articles and companies that a shared name brings into question.
    unclear = homonyms.ambiguous(named)
    articles = keep_first(
        homonyms.article_contexts(extracted.join(unclear.select("seq").distinct(), "seq", "left_semi")),
        ["seq"],
        ["context_key"],
    )
    companies = homonyms.company_contexts(
        master.join(
            unclear.select(F.col("matched_clean_name").alias("clean_cust_nm")).distinct(), "clean_cust_nm", "left_semi"
        )
    )
    vectors = stage(
        "context_vectors",
        lambda: models.embed(homonyms.distinct_contexts(articles, companies), "context").select("context_key", "embedding"),
    )
    return homonyms.resolve_homonyms(named, articles, companies, master.select("cust_no", "cust_nm"), vectors)


def mapped_rows(extracted: DataFrame, matches: DataFrame, master: DataFrame) -> DataFrame:
    """Essential articles with their companies, one row per article and customer."""
    picked = matching.one_per_customer(matches.select("seq", "target_company", "mapping_method", "cust_no", "cust_nm"))
    articles = keep_present(extracted, ARTICLE_COLUMNS).where(F.col("classification") == "essential")
    joined = matching.essential(articles.join(picked, "seq"))
    # An article number may occur more than once in a feed.
    once = matching.one_per_customer(joined, ["basc_dt", "title", "content"])
    return matching.enrich(once, master.drop("clean_cust_nm")).drop("target_company", "mapping_method")


@dataclass
class _Run:
    """The settings of one run, and its stages."""

    spark: SparkSession
    layout: Layout
    models: Models
    folder: str
    threshold: float
    dry_run: bool

    def stage(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        return _stage(self.spark, f"{self.folder}/{name}", build)

    def counted_stage(self, name: str, build: Callable[[], DataFrame], **counts) -> tuple[DataFrame, dict[str, int]]:
        """A stage and aggregates of its rows, observed as they are written, or read from the stage of an earlier try."""
        path = f"{self.folder}/{name}"
        if storage.is_complete(self.spark, path):
            stored = self.spark.read.parquet(path)
            return stored, stored.agg(*(c.alias(n) for n, c in counts.items())).first().asDict()
        seen = Observation()
        stored = storage.materialize(build().observe(seen, *(c.alias(n) for n, c in counts.items())), path)
        return stored, seen.get

    def check_settings(self) -> None:
        """Note what stages depend on; an earlier try of the day with other settings is not resumed."""
        models = self.models
        mine = {"threshold": self.threshold, "encoder_id": models.encoder_id, "template": models.template, "window_chars": models.window_chars}
        rows = [(k, repr(v)) for k, v in mine.items()]
        stored = self.stage("settings", lambda: self.spark.createDataFrame(rows, _SETTING_SCHEMA).coalesce(1)).collect()
        other = [r.name for r in stored if (r.name, r.value) not in rows]
        if other:
            raise ValueError(f"the stages in {self.folder} were made with another {', '.join(sorted(other))}; use another run_dt")

    def note_inputs(self, *paths: str | None) -> DataFrame:
        """Length and time of the input files as they are before they are read; kept from the first try on."""
        named = [f for p in paths if p for f in input_files(self.spark, p)]
        states = [(f, *s) for f in named if (s := storage.file_state(self.spark, f))]
        return self.stage("inputs", lambda: self.spark.createDataFrame(states, _INPUT_SCHEMA).coalesce(1))

    def name_vectors(self, master: DataFrame, summary: Summary) -> DataFrame:
        """Stored vectors, after embedding the names they lack; a dry run keeps new ones to itself.

        Names are looked for only in buckets whose digest isn't that of the last refresh; without any, nothing is read.
        """
        spark, layout, encoder_id = self.spark, self.layout, self.models.encoder_id
        read = lambda path: storage.read_or_empty(spark, path, NAME_VECTOR_SCHEMA)
        path = f"{self.folder}/name_vectors" if self.dry_run else layout.name_vectors
        stored = read(layout.name_vectors)
        names = master.select("clean_cust_nm").distinct()
        held = f"{layout.name_digests}/{hashlib.md5(encoder_id.encode()).hexdigest()}"
        now = storage.materialize(digest_tree.digests(names, ["clean_cust_nm"], []), label="name-digests")
        known = digest_tree.load(spark, held) if storage.exists(spark, layout.name_vectors) else None
        buckets = None if known is None else digest_tree.changed_buckets(now, known)
        if buckets is not None:
            names = names.where(digest_tree.bucket_of(["clean_cust_nm"]).isin(buckets))
        summary.refreshed = buckets == [] or refresh_name_vectors(
            names, stored, self.models.encode, encoder_id, lambda rows: rows.write.mode("append").parquet(path), tasks=self.models.tasks)
        if summary.refreshed and buckets != [] and not self.dry_run:
            digest_tree.store(now, held)
        return read(path).unionByName(stored) if self.dry_run else read(path)

    def extract_and_map(self, raw: DataFrame, load_master: Callable[[], DataFrame], summary: Summary) -> DataFrame:
        """New articles to target rows, with the counts entered in ``summary``."""
        models = self.models
        extracted, counts = self.counted_stage(
            "extracted",
            lambda: extract_articles(
                raw.drop("part_basc_dt"), models.complete, models.template, models.concurrency, models.tasks
            ),
            n=F.count_if(F.size("company_names") > 0),
        )
        summary.extracted = counts["n"]
        master = self.stage("master", lambda: prepare_master(load_master()))
        vectors = self.name_vectors(master, summary)
        matches = self.stage(
            "matches",
            lambda: match_mentions(extracted, master, vectors, models, self.threshold, self.stage),
        )
        mapped, counts = self.counted_stage("mapped", lambda: to_target(mapped_rows(extracted, matches, master)), n=F.count("*"))
        summary.mapped = counts["n"]
        return mapped

    def load(self, raw: DataFrame, mapped: DataFrame, last_seq: int) -> int:
        """Append, then move the cursor; returns the rows appended."""
        spark, layout = self.spark, self.layout
        appended, last_id = append_with_ids(
            spark,
            mapped,
            layout.target,
            stage=f"{self.folder}/append-{time.time_ns()}",
            id_floor=load_last_id(spark, layout.state),
        )
        cursor = next_cursor(raw).first()
        if cursor.last_seq >= last_seq:  # repeating an older day does not move the cursor back
            save_cursor(spark, layout.state, cursor.last_seq, cursor.last_part_basc_dt or "None", last_id)
        return appended

    def publish(self, summary: Summary) -> None:
        """Rewrite the serving copy of every day that has rows beyond the largest published id, then save that id.

        Days of this run and days that an earlier run failed to publish are alike.
        """
        spark, layout = self.spark, self.layout
        if not storage.exists(spark, layout.target):
            return
        target = storage.read_or_empty(spark, layout.target, TARGET_SCHEMA)
        published = load_published_id(spark, layout.state)
        beyond = target.where(F.col(ID_COLUMN) > published)  # statistics leave out older files
        last_id = beyond.agg(F.max(ID_COLUMN)).first()[0]
        if last_id is None:
            return
        first = not storage.exists(spark, layout.serving)
        days = None if first else storage.materialize(beyond.select(PARTITION_COLUMN).distinct(), label="days")
        seen = Observation()
        export_serving(target, layout.serving, days, seen)
        summary.considered, summary.served = seen.get["considered"], seen.get["served"]
        save_published_id(spark, layout.state, last_id)


def run_daily(
    spark: SparkSession,
    layout: Layout,
    news_path: str | None,
    company_path: str,
    models: Models,
    run_dt: str,
    threshold: float = 0.9,
    news_columns: list[str] | None = None,
    company_feed_columns: list[str] | None = None,
    dry_run: bool = False,
    remove_input: bool = True,
    retention_days: int | None = RETENTION_DAYS,
    load_news: Callable[[int, str], DataFrame] | None = None,
) -> Summary:
    """Run, or resume, the batch of day ``run_dt``.

    New articles come from ``news_path``, or from ``load_news`` called with the cursor. Input files are removed at the
    end only if they are as they were when they were read.

    A dry run returns a preview of what would be loaded. Its stages go to the scratch folder, and it
    changes neither target, cursor, vectors nor inputs.
    """
    started = time.monotonic()
    summary = Summary()
    folder = storage.scratch_path(spark, "dry-run") if dry_run else f"{layout.runs}/{run_dt}"
    run = _Run(spark, layout, models, folder, threshold, dry_run)
    if retention_days is not None and not dry_run:
        remove_expired(spark, layout.runs, run_dt, retention_days)

    with storage.scratch_below(f"{folder}/scratch"):
        last_seq, last_day = load_cursor(spark, layout.state)
        run.check_settings()
        inputs = run.note_inputs(news_path, company_path)
        # Bad records and late articles have to be read to be counted, as a delimited feed is in any case.
        counted = load_news is None and is_delimited(spark, news_path) and not storage.is_complete(spark, f"{folder}/raw")
        records, articles = (Observation(), Observation()) if counted else (None, None)
        if load_news is None:
            load_news = lambda seq, day: load_new_articles(spark, news_path, seq, day, news_columns, records, articles)
        raw, counts = run.counted_stage("raw", lambda: load_news(last_seq, last_day), n=F.count("*"))
        summary.loaded = counts["n"]
        if counted:
            summary.bad_records, summary.late = records.get["bad_records"], articles.get["late"]
        if summary.loaded:
            mapped = run.extract_and_map(
                raw, lambda: load_companies(spark, company_path, company_feed_columns), summary
            )
            if dry_run:
                summary.preview = mapped.select(PREVIEW_COLUMNS).orderBy("seq", "etct_cust_no").limit(PREVIEW_ROWS)
            else:
                summary.appended = run.load(raw, mapped, last_seq)
        else:
            # Nothing to resume: a later try of this day reads its input again.
            storage.delete(spark, f"{folder}/raw", recursive=True)
        if not dry_run:
            run.publish(summary)
            if remove_input:
                remove_delimited_inputs(spark, inputs)
        if not summary.loaded:
            storage.delete(spark, f"{folder}/inputs", recursive=True)
    summary.seconds = time.monotonic() - started
    return summary


def remove_delimited_inputs(spark: SparkSession, inputs: DataFrame) -> list[str]:
    """Delete processed ``.csv`` files that are as ``inputs`` has them; parquet files and folders are left alone.

    A file that came, or was written anew, after the run had read its input stays.
    """
    return [
        r.path
        for r in inputs.collect()  # as many as the feed has files
        if r.path.lower().endswith(".csv")
        and storage.file_state(spark, r.path) == (r.length, r.modified)
        and storage.delete(spark, r.path)
    ]
