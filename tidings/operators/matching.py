"""Resolving mentions of company names to customers.

A mention is matched to a *name* (one row in the directory), and only then to one of the companies
that share the name. Matching therefore gives one row per mention, however many companies share a
name.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import with_normalized_name
from .dedup import keep_first
from .nearest import nearest

EXACT = "exact_normalized"
VECTOR = "vector_search"

# Joins a customer number and a name to one key; occurs in neither.
_KEY_SEP = "\x1f"


def explode_mentions(articles: DataFrame, names: str = "company_names") -> DataFrame:
    """One row per name of an article; null and empty names vanish."""
    rest = [c for c in articles.columns if c != names]
    return articles.select(*rest, F.explode(names).alias("target_company")).where(
        F.col("target_company").isNotNull() & (F.col("target_company") != "")
    )


def with_clean_target(mentions: DataFrame) -> DataFrame:
    """Adds the join key. Store the result before filtering on it, or the key is computed twice."""
    return with_normalized_name(mentions, "target_company", "clean_target_company")


def distinct_mentions(mentions: DataFrame) -> DataFrame:
    """Each name once per article: repeats match alike, so they are dropped before matching."""
    return mentions.select("seq", "target_company", "clean_target_company").distinct()


def exact_match(mentions: DataFrame, directory: DataFrame) -> DataFrame:
    """All mentions with the directory entry of the same normalised name; nulls where there is none."""
    return mentions.join(directory, F.col("clean_target_company") == F.col("clean_cust_nm"), "left")


def unmatched_names(mentions: DataFrame, directory: DataFrame) -> DataFrame:
    """Distinct non-empty normalised names that the directory lacks: each is searched only once."""
    names = mentions.where(F.col("clean_target_company") != "").select("clean_target_company").distinct()
    return names.join(directory, F.col("clean_target_company") == F.col("clean_cust_nm"), "left_anti")


def vector_match(
    name_vectors: DataFrame,
    index_vectors: DataFrame,
    directory: DataFrame,
    encoder_id: str,
    threshold: float = 0.9,
    score: str = "relevance",
) -> DataFrame:
    """Nearest directory name of each unmatched name, if similar enough.

    ``name_vectors`` has ``clean_target_company, embedding, encoder_id``; ``index_vectors`` has
    ``clean_cust_nm, embedding, encoder_id``. Only vectors made by ``encoder_id`` are compared, and
    names no longer in the directory are not matched. The smallest customer number wins a tie.
    """
    made_by = F.col("encoder_id") == encoder_id
    queries = name_vectors.where(made_by).select(
        F.col("clean_target_company").alias("query_key"), F.col("embedding").alias("query_vec")
    )
    # The key is text with the number first, so that its order is that of the numbers.
    index = (
        index_vectors.where(made_by)
        .join(directory, "clean_cust_nm")
        .select(
            F.concat_ws(_KEY_SEP, "cust_no", "clean_cust_nm").alias("item_key"), F.col("embedding").alias("item_vec")
        )
    )
    return nearest(queries, index, threshold, score).select(
        F.col("query_key").alias("clean_target_company"),
        F.substring_index("item_key", _KEY_SEP, -1).alias("matched_clean_name"),
        F.col("score").alias("similarity_score"),
    )


def name_lookup(directory: DataFrame, vector_hits: DataFrame) -> DataFrame:
    """What each normalised name resolves to: its directory entry, else the entry of its vector hit.

    ``n_candidates`` is 1 for a vector hit, which stands for one company.
    """
    named = directory.select(
        F.col("clean_cust_nm").alias("clean_target_company"),
        F.lit(EXACT).alias("mapping_method"),
        F.lit(1.0).alias("similarity_score"),
        F.col("clean_cust_nm").alias("matched_clean_name"),
        "n_candidates",
        "cust_no",
        "cust_nm",
    )
    entries = directory.select(F.col("clean_cust_nm").alias("matched_clean_name"), "cust_no", "cust_nm")
    similar = (
        vector_hits.join(named, "clean_target_company", "left_anti")
        .join(entries, "matched_clean_name")
        .withColumns({"mapping_method": F.lit(VECTOR), "n_candidates": F.lit(1).cast("bigint")})
    )
    return named.unionByName(similar)


def cascade(mentions: DataFrame, directory: DataFrame, vector_hits: DataFrame) -> DataFrame:
    """Exact matches, and vector hits for the other mentions; mentions without either are dropped.

    Adds method, score, matched name, the number of companies of that name and the first of them. The
    mentions are joined once, so adaptive execution can split a name that very many of them share.
    """
    return mentions.join(name_lookup(directory, vector_hits), "clean_target_company")


def enrich(rows: DataFrame, master: DataFrame, keys: tuple[str, ...] = ("cust_no", "cust_nm")) -> DataFrame:
    """Company attributes by ``keys``; columns the master also has are taken from the master."""
    bare = rows.drop(*[c for c in master.columns if c not in keys])
    return bare.join(master, list(keys), "left")


def essential(df: DataFrame) -> DataFrame:
    """Rows of class ``essential`` with a customer number."""
    return df.where(
        (F.col("classification") == "essential") & F.col("cust_no").isNotNull() & (F.col("cust_no") != "")
    )


def one_per_customer(rows: DataFrame, ties: list[str] | None = None) -> DataFrame:
    """One row per article and customer: exact before vector, then by target name, then by ``ties``."""
    exact_first = F.when(F.col("mapping_method") == EXACT, 0).otherwise(1)
    return keep_first(rows, ["seq", "cust_no"], [exact_first, F.col("target_company"), *(ties or [])])
