"""Fixed schemas. Hashes are 64-bit patterns held in BIGINT (see functions.unsigned)."""

from pyspark.sql import types as T

#: One row per (archive, member, sketch, slice of the hash vector).
ARCHIVE_ROWS = T.StructType([
    T.StructField("path", T.StringType()),
    T.StructField("member", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("error", T.StringType()),
    T.StructField("archive_head", T.BooleanType()),
    T.StructField("member_head", T.BooleanType()),
    T.StructField("sketch_head", T.BooleanType()),
    T.StructField("filename", T.StringType()),
    T.StructField("ksize", T.IntegerType()),
    T.StructField("scaled", T.LongType()),
    T.StructField("max_hash", T.DecimalType(20, 0)),
    T.StructField("num_hashes", T.LongType()),
    T.StructField("hashes", T.ArrayType(T.LongType())),
])

#: ``hashes`` is a list or an object in the JSON; as STRING it is kept verbatim.
SIGNATURE = T.StructType([
    T.StructField("ksize", T.IntegerType()),
    T.StructField("seed", T.IntegerType()),
    T.StructField("num", T.IntegerType()),
    T.StructField("scaled", T.LongType()),
    T.StructField("max_hash", T.DecimalType(20, 0)),
    T.StructField("mins", T.ArrayType(T.DecimalType(20, 0))),
    T.StructField("hashes", T.StringType()),
])

#: A record carries a list of signatures, or is a bare signature itself.
SIGNATURE_FILE = T.ArrayType(T.StructType(
    [T.StructField("filename", T.StringType()),
     T.StructField("signatures", T.ArrayType(SIGNATURE))] + SIGNATURE.fields
))

MANIFEST = T.StructType([
    T.StructField("format", T.StringType()),
    T.StructField("partition_bits", T.IntegerType()),
    T.StructField("partition_mode", T.StringType()),
    T.StructField("created_at", T.StringType()),
    T.StructField("ksizes", T.MapType(T.StringType(), T.StructType([
        T.StructField("partitions", T.LongType()),
        T.StructField("distinct_count", T.LongType()),
    ]))),
    T.StructField("total_distinct", T.LongType()),
])

#: The work ledger, unique on (subdir, filename).
LEDGER = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("subdir", T.StringType()),
    T.StructField("filename", T.StringType()),
    T.StructField("url", T.StringType()),
    T.StructField("size", T.LongType()),
    T.StructField("mtime", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("tries", T.IntegerType()),
    T.StructField("last_error", T.StringType()),
    T.StructField("out_path", T.StringType()),
    T.StructField("updated_at", T.DoubleType()),
    T.StructField("created_at", T.DoubleType()),
])

#: Results reported back for ledger rows.
OUTCOMES = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("status", T.StringType()),
    T.StructField("out_path", T.StringType()),
    T.StructField("error", T.StringType()),
    T.StructField("inc_tries", T.BooleanType()),
    T.StructField("ts", T.DoubleType()),
])
