"""Explicit schemas (no inference pass, a missing field cannot change the job)."""

from __future__ import annotations

from pyspark.ml.linalg import VectorUDT
from pyspark.sql import types as T

_S = T.StringType()
_D = T.DoubleType()

# Raw offer feed: one JSON object per retailer offer, all fields nullable.
RAW_OFFER_SCHEMA = T.StructType(
    [
        T.StructField("availability", _S),
        T.StructField("brand", _S),
        T.StructField("e_brand_formatted", _S),
        T.StructField("e_brand_formatted_slug", _S),
        T.StructField("e_color", _S),
        T.StructField("e_color_parent", _S),
        T.StructField("e_image_urls_square_jpg", T.ArrayType(T.ArrayType(_S))),
        T.StructField("e_matched_tokens_categories_formatted", T.ArrayType(_S)),
        T.StructField("e_material", _S),
        T.StructField("e_price", _D),
        T.StructField("e_product_name", _S),
        T.StructField("gender", _S),
        T.StructField("id", _S),
        T.StructField("item_code", _S),
        T.StructField("long_description", _S),
        T.StructField("product_name", _S),
        T.StructField("retailer_code", _S),
        T.StructField("retailer_price", _D),
        T.StructField("retailer_url", _S),
    ]
)

# Columns the item rollup reads (column pruning reaches the JSON/Parquet scan).
ROLLUP_COLUMNS = (
    "product_name",
    "item_code",
    "e_brand_formatted_slug",
    "retailer_code",
    "e_matched_tokens_categories_formatted",
    "long_description",
    "e_price",
)

# One row per product name.  ``retrailer_count`` keeps the published spelling
# so readers of the item table find the column they expect.
ITEM_SCHEMA = T.StructType(
    [
        T.StructField("product_name", _S),
        T.StructField("codes", T.ArrayType(_S, False)),
        T.StructField("brands", T.ArrayType(_S, False)),
        T.StructField("retailers", T.ArrayType(_S, False)),
        T.StructField("categories", T.ArrayType(_S)),
        T.StructField("description", _S),
        T.StructField("price", _D),
        T.StructField("purchase_count", T.LongType(), False),
        T.StructField("retrailer_count", T.IntegerType(), False),
        T.StructField("category_count", T.IntegerType(), False),
        T.StructField("brand_count", T.IntegerType(), False),
        T.StructField("code_count", T.IntegerType(), False),
    ]
)

FEATURE_COLUMNS = ("product_name", "brands", "categories", "features", "cleaned_words")

TOP_TERM_TYPE = T.ArrayType(
    T.StructType([T.StructField("words", _S), T.StructField("termWeights", _D)])
)

VECTOR_TYPE = VectorUDT()
