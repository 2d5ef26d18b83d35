"""Loose signature JSON held in a text column, decoded by Spark's own JSON functions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from fraclake.functions.unsigned import bits_from_decimal
from fraclake.sources.archives import resolved_scale
from fraclake.types import SIGNATURE, SIGNATURE_FILE

_OUT_OF_RANGE = f"CAST({1 << 64} AS DECIMAL(20,0))"


def _values(signature: Column) -> Column:
    """``mins`` when not empty, else ``hashes`` as a list or as the keys of an object."""
    text = signature["hashes"]
    as_keys = F.transform(F.map_keys(F.from_json(text, "map<string,string>")),
                          lambda key: key.cast("decimal(20,0)"))
    as_list = F.from_json(text, "array<decimal(20,0)>")
    other = F.when(F.ltrim(text).startswith("{"), as_keys).otherwise(as_list)
    return F.when(F.size(signature["mins"]) > 0, signature["mins"]).otherwise(other)


def _signatures(record: Column) -> Column:
    bare = F.array(F.struct(*[record[f.name].alias(f.name) for f in SIGNATURE.fields]))
    return F.transform(
        F.coalesce(record["signatures"], bare),
        lambda s: F.struct(record["filename"].alias("filename"), s["ksize"].alias("ksize"),
                           s["scaled"].alias("scaled"), s["max_hash"].alias("max_hash"),
                           _values(s).alias("values")))


def decode_signatures(df: DataFrame, json_text: str, keys: list[str]) -> DataFrame:
    """(keys..., filename, ksize, scaled, num_hashes, hashes) per usable signature.

    ``from_json`` reads a single object as a list of one, so a record, a list of
    records and a bare signature all fit one schema. A text with any value outside
    the unsigned range gives no rows at all.
    """
    parsed = df.select(*keys, F.from_json(F.col(json_text), SIGNATURE_FILE).alias("_records"))
    listed = parsed.select(*keys, F.flatten(F.transform("_records", _signatures)).alias("_all"))
    wrong = F.exists("_all", lambda s: F.exists(
        s["values"], lambda v: v.isNull() | (v < 0) | (v >= F.expr(_OUT_OF_RANGE))))
    # Only generated columns are filtered: a filter on the parsed arrays, also the one
    # Spark derives for `inline`, would be moved below and parse the text once more.
    usable = listed.select(*keys, F.when(~F.coalesce(wrong, F.lit(False)), F.col("_all")).alias("_usable"))
    return (usable.select(*keys, F.inline_outer("_usable"))
            .where(F.col("ksize").isNotNull() & (F.size("values") > 0))
            .select(*keys, "filename", "ksize", resolved_scale().alias("scaled"),
                    F.size("values").cast("bigint").alias("num_hashes"),
                    F.transform("values", bits_from_decimal).alias("hashes")))
