"""Choosing among companies of one name by the context of the article."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import storage
from ..functions.text import article_context, company_context
from .nearest import INDEX_ROWS, best_in_cells

# Vector entries per side of a tile, if its usual number of rows has fewer: short vectors come in larger tiles, so that
# contexts of a name that fill many tiles are copied less often.
_TILE_ENTRIES = 1 << 21
_TILE_ROWS = 4 * INDEX_ROWS


def context_key(context: Column | str) -> Column:
    return F.sha2(context, 256)


def article_contexts(articles: DataFrame) -> DataFrame:
    """``seq, context_key, context`` of articles; copies of an article share a key."""
    text = articles.select("seq", article_context("title", "content").alias("context"))
    return text.select("seq", context_key("context").alias("context_key"), "context")


def company_contexts(master: DataFrame) -> DataFrame:
    """``clean_cust_nm, cust_no, context_key, context`` of companies."""
    text = master.select(
        "clean_cust_nm", "cust_no", company_context("std_inds_clas_nm", "primy_prod_nm", "cust_nm").alias("context")
    )
    return text.withColumn("context_key", context_key("context"))


def distinct_contexts(*contexts: DataFrame) -> DataFrame:
    """Each context once, ready to be embedded."""
    both = contexts[0].select("context_key", "context")
    for more in contexts[1:]:
        both = both.unionByName(more.select("context_key", "context"))
    return both.groupBy("context_key").agg(F.first("context").alias("context"))


def ambiguous(matches: DataFrame) -> DataFrame:
    """Rows whose name is shared by several companies; only these need a context."""
    return matches.where(F.col("n_candidates") > 1)


def _tile_rows(vectors: DataFrame) -> int:
    """Rows per side of a tile, by the length of the vectors."""
    first = vectors.where(F.size("embedding") > 0).select(F.size("embedding")).head()
    return max(INDEX_ROWS, min(_TILE_ROWS, _TILE_ENTRIES // first[0])) if first else INDEX_ROWS


def resolve_homonyms(
    matches: DataFrame, article_keys: DataFrame, company_keys: DataFrame, names: DataFrame, vectors: DataFrame
) -> DataFrame:
    """One company per article and target name: the one whose context is closest to the article's.

    ``matches`` is the cascade's result for distinct mentions; ``article_keys`` has ``seq,
    context_key``, one row per article; ``company_keys`` has ``clean_cust_nm, cust_no, context_key``; ``names`` has
    ``cust_no, cust_nm``; ``vectors`` has ``context_key, embedding``. A name of one company, or an
    article without context, keeps the first company and gets ``homonym_score`` 0. The smallest
    customer number wins a tie.

    ``matches`` is read twice and should be a stored table. Rows of shared names are stored with the key of their article's
    context, so that articles are joined once. Only distinct (name, article context) and (name, company context) rows carry vectors through the
    search, and the search gives one row per query, so no list of pairs is ever built.
    """
    plain = matches.where(F.col("n_candidates") == 1).withColumn("homonym_score", F.lit(0.0))
    unclear = storage.materialize(
        ambiguous(matches).join(article_keys.select("seq", "context_key"), "seq", "left"), label="unclear"
    )
    wanted = (
        unclear.where(F.col("context_key").isNotNull())
        .select(F.col("matched_clean_name").alias("cell"), "context_key")
        .distinct()
    )
    offered = company_keys.groupBy(F.col("clean_cust_nm").alias("cell"), "context_key").agg(
        F.min("cust_no").alias("item_key")
    )
    wanted = storage.materialize(wanted, label="article-contexts")
    offered = storage.materialize(offered, label="company-contexts")
    queries = (
        wanted.join(vectors, "context_key")
        .select("cell", F.struct("cell", "context_key").alias("query_key"), F.col("embedding").alias("query_vec"))
    )
    index = (
        offered.join(vectors, "context_key")
        .select("cell", "item_key", F.col("embedding").alias("item_vec"))
    )
    # Rows per name are counted on the stored keys, so that vectors are joined once.
    cells = wanted.select("cell"), offered.select("cell")
    rows = _tile_rows(vectors)
    # Stored, so that the vectors' copies are off the disk when the mentions travel.
    best = storage.materialize(best_in_cells(queries, index, rows, rows, one_cell=True, counted=cells).drop("top"), label="best-contexts")
    best = (
        best.select("query_key.context_key", F.col("query_key.cell").alias("matched_clean_name"), "item_key", "cos")
        .join(names.select(F.col("cust_no").alias("item_key"), F.col("cust_nm").alias("best_nm")), "item_key")
    )
    # The context comes first: it tells rows apart sooner than the name does.
    resolved = unclear.join(best, ["context_key", "matched_clean_name"], "left").select(
        *[c for c in matches.columns if c not in ("cust_no", "cust_nm")],
        F.coalesce("item_key", "cust_no").alias("cust_no"),
        F.coalesce("best_nm", "cust_nm").alias("cust_nm"),
        F.coalesce("cos", F.lit(0.0)).alias("homonym_score"),
    )
    return plain.unionByName(resolved)
