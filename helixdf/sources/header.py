"""SAM header lines <-> header tables.

A header is small (one line per contig / read group / program), but it is
still handled as a DataFrame so the same code reads it from any file system
and joins it to read tables without a driver round trip.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Header record types, their required tags and the output order.
RECORD_TYPES = ("HD", "SQ", "RG", "PG", "CO")
REQUIRED_TAGS = {"HD": ("VN",), "SQ": ("SN", "LN"), "RG": ("ID", "SM"), "PG": ("ID",)}
LEADING_TAGS = {"HD": ("VN",), "SQ": ("SN", "LN"), "RG": ("ID",), "PG": ("ID",)}
CURRENT_VERSION = "1.4"


def header_fields(lines: DataFrame) -> DataFrame:
    """``ord, value`` header lines -> one row per ``key:value`` field.

    Columns: ord, rec_type, idx (field position), key, value, well_formed,
    first (first occurrence of the key on its line). ``@CO`` lines yield one
    row with key ``CO`` and the comment text.
    """
    h = lines.filter(F.col("value").startswith("@")).select(
        "ord", F.split("value", "\t").alias("f"), "value")
    h = h.select("ord", F.substr(F.get(F.col("f"), F.lit(0)), F.lit(2)).alias("rec_type"), "f", "value")
    co = h.filter(F.col("rec_type") == "CO").select(
        "ord", "rec_type", F.lit(1).alias("idx"), F.lit("CO").alias("key"),
        F.expr("substr(value, 5)").alias("value"), F.lit(True).alias("well_formed"))
    kv = h.filter(F.col("rec_type") != "CO").select(
        "ord", "rec_type", F.posexplode(F.slice("f", 2, F.size("f") - 1)).alias("idx", "field"))
    parts = F.split("field", ":", 2)
    kv = kv.select("ord", "rec_type", (F.col("idx") + 1).alias("idx"), parts[0].alias("key"),
                   F.when(F.size(parts) == 2, parts[1]).alias("value"),
                   (F.size(parts) == 2).alias("well_formed"))
    return kv.unionByName(co)


def first_values(fields: DataFrame) -> DataFrame:
    """Keep the first well-formed value of each key on a line (later clashes are errors)."""
    ok = fields.filter("well_formed")
    first = ok.groupBy("ord", "rec_type", "key").agg(F.min_by("value", "idx").alias("value"),
                                                    F.min("idx").alias("idx"))
    return first


def header_table(lines: DataFrame) -> DataFrame:
    """Parsed header: ``ord, rec_type, key, value`` for known record types."""
    return (first_values(header_fields(lines))
            .filter(F.col("rec_type").isin(*RECORD_TYPES))
            .select("ord", "rec_type", "key", "value"))


def header_errors(lines: DataFrame) -> DataFrame:
    """``ord, type`` for each header problem (SAM validation error names)."""
    fields = header_fields(lines)
    rec = fields.select("ord", "rec_type").distinct()
    unknown = rec.filter(~F.col("rec_type").isin(*RECORD_TYPES)) \
        .select("ord", F.lit("UNRECOGNIZED_HEADER_TYPE").alias("type"))
    known = fields.filter(F.col("rec_type").isin(*RECORD_TYPES))
    poor = known.filter(~F.col("well_formed")).select("ord", F.lit("POORLY_FORMATTED_HEADER_TAG").alias("type"))
    first = first_values(known)
    clash = (known.filter("well_formed").alias("a")
             .join(first.alias("b"), ["ord", "rec_type", "key"])
             .filter((F.col("a.idx") > F.col("b.idx")) & (F.col("a.value") != F.col("b.value")))
             .select("ord", F.lit("HEADER_TAG_MULTIPLY_DEFINED").alias("type")))
    have = first.groupBy("ord", "rec_type").agg(F.collect_set("key").alias("keys"))
    missing = None
    for rt, tags in REQUIRED_TAGS.items():
        cond = F.lit(False)
        for t in tags:
            cond = cond | ~F.array_contains("keys", t)
        m = have.filter((F.col("rec_type") == rt) & cond).select(
            "ord", F.lit("HEADER_RECORD_MISSING_REQUIRED_TAG").alias("type"))
        missing = m if missing is None else missing.unionByName(m)
    bad_pi = first.filter((F.col("rec_type") == "RG") & (F.col("key") == "PI")
                          & F.col("value").try_cast("int").isNull()) \
        .select("ord", F.lit("INVALID_PREDICTED_MEDIAN_INSERT_SIZE").alias("type"))
    return unknown.unionByName(poor).unionByName(clash).unionByName(missing).unionByName(bad_pi)


def header_lines(table: DataFrame) -> DataFrame:
    """Header table -> text lines ``rank, value`` in HD, SQ, RG, PG, CO order.

    Leading tags (VN; SN, LN; ID) come first, other tags by name; the @HD
    version is written as the current format version.
    """
    sect = F.array_position(F.array(*[F.lit(t) for t in RECORD_TYPES]), F.col("rec_type"))
    lead_rank = F.lit(99)
    for rt, tags in LEADING_TAGS.items():
        for i, t in enumerate(tags):
            lead_rank = F.when((F.col("rec_type") == rt) & (F.col("key") == t), F.lit(i)).otherwise(lead_rank)
    value = F.when((F.col("rec_type") == "HD") & (F.col("key") == "VN"), F.lit(CURRENT_VERSION)) \
        .otherwise(F.col("value"))
    text = F.when(F.col("rec_type") == "CO", F.col("value")).otherwise(F.concat_ws(":", "key", value))
    per = table.select("ord", "rec_type", sect.alias("sect"),
                       F.struct(lead_rank.alias("r"), F.col("key").alias("k"), text.alias("t")).alias("e"))
    lines = per.groupBy("sect", "ord", "rec_type").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list("e")), lambda e: e["t"]), "\t").alias("body"))
    return lines.select(F.col("sect").cast("int").alias("sect"), "ord",
                        F.concat(F.lit("@"), "rec_type", F.lit("\t"), "body").alias("value"))
