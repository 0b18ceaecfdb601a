"""Column lists and types shared by sources, operators and sinks."""

from __future__ import annotations

from pyspark.sql import types as T

# Column names of the input feeds and of the load target.
NEWS_COLUMNS = ["seq", "site_name", "basc_dt", "title", "content", "doc_sentiment", "part_basc_dt"]
COMPANY_COLUMNS = ["cust_no", "cust_nm", "sglr_ases_modl_clas_cd", "std_inds_clas_nm", "primy_prod_nm"]
COMPANY_CLASS_SOURCE = "sglr_ases_modl_clas_cd_nm"
ASSESSED_ON = "lst_ases_dt"
ID_COLUMN = "news_mppg_id"
PARTITION_COLUMN = "basc_dt"

# Article / match column -> target column.
TARGET_RENAMES = {
    "site_name": "site_nm",
    "title": "news_tite",
    "content": "news_ctt",
    "category": "news_clas",
    "summary": "news_summ",
    "reference": "news_ref",
    "cust_no": "etct_cust_no",
    "cust_nm": "etct_cust_nm",
}


def _strings(*names: str) -> list[T.StructField]:
    return [T.StructField(n, T.StringType()) for n in names]


NEWS_SCHEMA = T.StructType(
    [T.StructField("seq", T.LongType()), *_strings(*NEWS_COLUMNS[1:])]
)

# The target's columns. Partition column last, so that positional inserts line up with the table.
TARGET_SCHEMA = T.StructType(
    [
        T.StructField(ID_COLUMN, T.LongType()),
        T.StructField("seq", T.LongType()),
        *_strings(
            "site_nm", "news_tite", "news_ctt", "news_clas", "doc_sentiment", "news_summ", "news_ref",
            "etct_cust_no", "etct_cust_nm", "sglr_ases_modl_clas_cd", "std_inds_clas_nm",
            "primy_prod_nm", "basc_dt",
        ),
    ]
)
TARGET_COLUMNS = TARGET_SCHEMA.names
TARGET_DATA_COLUMNS = [c for c in TARGET_COLUMNS if c != ID_COLUMN]

STATE_SCHEMA = T.StructType(
    [
        T.StructField("version", T.LongType()),
        T.StructField("last_seq", T.LongType()),
        T.StructField("last_part_basc_dt", T.StringType()),
        T.StructField("last_id", T.LongType()),
        T.StructField("published_id", T.LongType()),
    ]
)

NAME_VECTOR_SCHEMA = T.StructType(
    [
        T.StructField("clean_cust_nm", T.StringType()),
        T.StructField("embedding", T.ArrayType(T.FloatType())),
        T.StructField("encoder_id", T.StringType()),
    ]
)
