"""Column layouts the operators exchange."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T

# One proposed value with its evidence. ``ord`` is any orderable column giving
# the order the sources were read in: it settles every tie.
CANDIDATE = T.StructType([
    T.StructField("entity", T.StringType()),
    T.StructField("metric", T.StringType()),
    T.StructField("value", T.DoubleType()),
    T.StructField("unit", T.StringType()),
    T.StructField("tier", T.StringType()),
    T.StructField("form", T.StringType()),
    T.StructField("accession", T.StringType()),
    T.StructField("filing_date", T.DateType()),
    T.StructField("period_end", T.DateType()),
    T.StructField("url", T.StringType()),
    T.StructField("locator", T.StringType()),
    T.StructField("excerpt", T.StringType()),
    T.StructField("basis", T.MapType(T.StringType(), T.StringType())),
    T.StructField("transforms", T.ArrayType(T.StringType())),
    T.StructField("flags", T.ArrayType(T.StringType())),
    T.StructField("as_of", T.DateType()),
    T.StructField("terms_clock", T.DateType()),
    T.StructField("effective_from", T.DateType()),
    T.StructField("effective_until", T.DateType()),
    T.StructField("ord", T.LongType()),
])

# A typed explanation for an absent value.
NOTICE = T.StructType([
    T.StructField("entity", T.StringType()),
    T.StructField("metric", T.StringType()),
    T.StructField("reason", T.StringType()),
    T.StructField("detail", T.StringType()),
    T.StructField("as_of", T.DateType()),
    T.StructField("coverage_start", T.DateType()),
    T.StructField("coverage_end", T.DateType()),
    T.StructField("internal_note", T.StringType()),
    T.StructField("ord", T.LongType()),
])


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Project to a layout, filling absent columns with typed nulls.

    Empty arrays and maps replace nulls, and a missing ``as_of`` falls back to
    the period end, then the filing date.
    """
    have = set(df.columns)
    cols = []
    for field in schema.fields:
        col = F.col(field.name) if field.name in have else F.lit(None)
        col = col.cast(field.dataType)
        if isinstance(field.dataType, T.ArrayType):
            col = F.coalesce(col, F.array().cast(field.dataType))
        elif isinstance(field.dataType, T.MapType):
            col = F.coalesce(col, F.create_map().cast(field.dataType))
        cols.append(col.alias(field.name))
    out = df.select(*cols)
    if "filing_date" in schema.names and "as_of" in schema.names:
        out = out.withColumn("as_of", F.coalesce("as_of", "period_end", "filing_date"))
    return out


def union_sources(*frames: DataFrame, schema: T.StructType = CANDIDATE) -> DataFrame:
    """All source outputs in one layout; earlier frames sort before later ones.

    The source position is packed above the source's own ``ord`` (below 2^56),
    so the combined order is one number and order inside a source is kept.
    """
    out = None
    for position, frame in enumerate(frames):
        part = conform(frame, schema)
        packed = F.lit(position << 56).cast("bigint") + F.col("ord")
        part = part.withColumn("ord", packed)
        out = part if out is None else out.unionByName(part)
    return out
