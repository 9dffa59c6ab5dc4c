"""Dictionary / read-group lookups, mate lookup, dictionary comparison."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import flags as fl


def contig_lookup(reads: DataFrame, contigs: DataFrame) -> DataFrame:
    """Add ``ref_name`` and ``ref_length`` by contig index (NULL when unknown).

    The dictionary is bounded by the header (not by data volume): broadcast.
    """
    d = F.broadcast(contigs.select(F.col("ref_index").alias("_ri"), F.col("ref_name").alias("ref_name"),
                                   F.col("length").alias("ref_length")))
    base = reads.drop("ref_name") if "ref_name" in reads.columns else reads
    return base.join(d, base["ref_index"] == d["_ri"], "left").drop("_ri")


def contig_index_lookup(df: DataFrame, contigs: DataFrame, name_col: str, out_col: str) -> DataFrame:
    """Name -> index; a miss gives -1."""
    d = F.broadcast(contigs.select(F.col("ref_name").alias("_n"), F.col("ref_index").alias("_i")))
    return (df.join(d, df[name_col] == d["_n"], "left")
            .withColumn(out_col, F.coalesce("_i", F.lit(-1)).cast("int")).drop("_n", "_i"))


def read_group_lookup(reads: DataFrame, read_groups: DataFrame, rg_col: str = "rg") -> DataFrame:
    """Attach the read-group record (``rg_*`` columns) named by the RG tag; NULL if absent.

    Read groups are header records (bounded by the header) and broadcast.
    """
    g = F.broadcast(read_groups.select([F.col(c).alias("rg_" + c) for c in read_groups.columns]))
    return reads.join(g, reads[rg_col] == g["rg_id"], "left").drop("rg_id")


def read_groups_from_header(table: DataFrame) -> DataFrame:
    """Header table (ord, rec_type, key, value) -> one row per @RG: id, sm, lb, pl, pi."""
    rg = table.filter(F.col("rec_type") == "RG")
    return (rg.groupBy("ord").pivot("key", ["ID", "SM", "LB", "PL", "PI"]).agg(F.first("value"))
            .select(F.col("ID").alias("id"), F.col("SM").alias("sm"), F.col("LB").alias("lb"),
                    F.col("PL").alias("pl"), F.col("PI").alias("pi")))


def query_mate(reads: DataFrame) -> DataFrame:
    """For each paired read, the record with the same name, the other end flag,
    placed where this read says its mate is.

    Equi self-join on (qname, end, position): shuffles by qname, never all
    pairs within a name. Returns the read columns plus ``mate_flag``,
    ``mate_found_pos`` and ``n_mates`` (more than one = error) per record key.
    """
    paired = reads.filter(fl.has("flag", fl.PAIRED))
    end = F.when(fl.has("flag", fl.FIRST_OF_PAIR), 1).when(fl.has("flag", fl.SECOND_OF_PAIR), 2).otherwise(0)
    want = paired.withColumn("_want_end", F.when(end == 1, 2).when(end == 2, 1).otherwise(-1))
    # One row per candidate position (count kept): a name with many records
    # at one place never multiplies rows in the join.
    cand = (paired.groupBy(F.col("qname").alias("_q"), end.alias("_end"), F.col("ref_index").alias("_r"),
                           F.col("pos").alias("_p"))
            .agg(F.min("flag").alias("mate_flag"), F.count(F.lit(1)).alias("_k")))
    cond = ((want["qname"] == cand["_q"]) & (want["_want_end"] == cand["_end"])
            & (want["mate_pos"] == cand["_p"]))
    if "mate_ref_index" in reads.columns:
        cond = cond & (want["mate_ref_index"] == cand["_r"])
    else:
        cond = cond & (want["ref_index"] == cand["_r"])
    j = want.join(cand, cond, "left")
    key = [c for c in ("qname", "flag", "ref_index", "pos", "mate_ref_index", "mate_pos") if c in reads.columns]
    counts = j.groupBy(*key).agg(
        F.min("mate_flag").alias("mate_flag"), F.min("_p").alias("mate_found_pos"),
        F.coalesce(F.sum("_k"), F.lit(0)).cast("long").alias("n_mates"))
    return counts


def mate_report(reads: DataFrame) -> DataFrame:
    """Each record with the mate that its name, end and mate place lead to, or why there is none.

    Returns qname, flag, ref_index, pos, mate_ref_index, mate_pos, mate_flag
    (of a mate found) and ``outcome``, one row per record:

    * ``UNPAIRED``, ``END_UNCLEAR``: the record has no mate to look for (bit 0x1 is off, or it
      is marked as both ends or none);
    * ``PAIRED_AND_UNPAIRED``: an unpaired record of that name lies at the mate's place;
    * ``SEVERAL_MATES``, ``MATE``, ``NO_MATE``: by the number of paired records of that name
      there that are not the record's own end.

    A mate without a contig is looked for among all records without one. One summary row per
    (name, place) holds the counts of unpaired records and of both ends, combined map-side,
    and mates and errors are read from it alike: a name with many records joins one row.
    """
    first, second = fl.has("flag", fl.FIRST_OF_PAIR), fl.has("flag", fl.SECOND_OF_PAIR)
    paired = fl.has("flag", fl.PAIRED)
    place = lambda ref, pos: F.when(ref != -1, pos).otherwise(F.lit(0))
    states = (reads.groupBy(F.col("qname").alias("_q"), F.col("ref_index").alias("_r"), place(F.col("ref_index"), F.col("pos")).alias("_p"))
              .agg(F.count_if(~paired).alias("_unpaired"), F.count_if(paired & ~first).alias("_not1"), F.count_if(paired & ~second).alias("_not2"),
                   F.min(F.when(paired & ~first, F.col("flag"))).alias("_flag1"), F.min(F.when(paired & ~second, F.col("flag"))).alias("_flag2")))
    at = place(F.col("mate_ref_index"), F.col("mate_pos"))
    j = reads.select("qname", "flag", "ref_index", "pos", "mate_ref_index", "mate_pos").join(
        states, (F.col("qname") == F.col("_q")) & (F.col("mate_ref_index") == F.col("_r")) & (at == F.col("_p")), "left")
    n = F.coalesce(F.when(first, F.col("_not1")).otherwise(F.col("_not2")), F.lit(0))
    outcome = (F.when(~paired, "UNPAIRED").when(first == second, "END_UNCLEAR").when(F.col("_unpaired") > 0, "PAIRED_AND_UNPAIRED")
               .when(n > 1, "SEVERAL_MATES").when(n == 1, "MATE").otherwise("NO_MATE"))
    j = j.withColumn("outcome", outcome)
    flag = F.when(F.col("outcome") == "MATE", F.when(first, F.col("_flag1")).otherwise(F.col("_flag2")))
    return j.select("qname", "flag", "ref_index", "pos", "mate_ref_index", "mate_pos", flag.alias("mate_flag"), "outcome")


def compare_dictionaries(a: DataFrame, b: DataFrame) -> DataFrame:
    """Per index: ``same``, or why two dictionaries differ (length, name/M5, missing).

    Length 0 is a wildcard; M5 decides when both sides have it, else the name.
    """
    def side(df, p):
        cols = [F.col("ref_index"), F.col("ref_name").alias(p + "name"), F.col("length").alias(p + "len")]
        cols.append(F.col("m5").alias(p + "m5") if "m5" in df.columns else F.lit(None).cast("string").alias(p + "m5"))
        return df.select(*cols)

    j = side(a, "a_").join(side(b, "b_"), "ref_index", "full_outer")
    len_ok = (F.col("a_len") == 0) | (F.col("b_len") == 0) | (F.col("a_len") == F.col("b_len"))
    id_ok = F.when(F.col("a_m5").isNotNull() & F.col("b_m5").isNotNull(), F.col("a_m5") == F.col("b_m5")) \
        .otherwise(F.col("a_name") == F.col("b_name"))
    status = (F.when(F.col("a_name").isNull(), "missing_in_a").when(F.col("b_name").isNull(), "missing_in_b")
              .when(~len_ok, "length").when(~id_ok, "name").otherwise("same"))
    return j.select("ref_index", "a_name", "b_name", status.alias("status"))


def observed_dictionary(reads: DataFrame, contigs: DataFrame) -> DataFrame:
    """Contigs that carry reads, each length stretched to the furthest read end."""
    from ..functions import coords as co
    r = reads.select("ref_index", co.alignment_end("pos", "cigar", "flag").alias("e"))
    return (r.groupBy("ref_index").agg(F.max("e").alias("e"))
            .join(F.broadcast(contigs), "ref_index")
            .select("ref_index", "ref_name", F.greatest("length", F.col("e").cast("long")).alias("length")))
