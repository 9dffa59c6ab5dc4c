"""Read preprocessing before calling: cleaning, duplicate marking, base quality
recalibration (BQSR), per-locus depth, MD mismatch sites, indel targets.

These replace external tools of the original pipeline with Spark jobs whose
contracts are stated per function (not claims of byte-equality with the
tools). Hot keys are handled with aggregations (map-side partial combine)
and joins against one-row-per-key tables, never with windows over a key that
may hold a large share of the data.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import bases as bs
from ..functions import cigar as cg
from ..functions import coords as co
from ..functions import flags as fl
from . import islands as isl
from . import records as rec
from ..session import ensure_checkpoint_dir, scratch_path
from .blocks import clips_and_span, distinct
from .covariates import count_covariates
from .recalibrate import recalibrate
from .reference import octets, row_sums

_ELEM = "struct<len:int,op:string>"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


# --- cleaning ------------------------------------------------------------------------

def clip_cigar_at(cigar, pos, ref_length) -> Column:
    """Soft-clip every read base aligned past ``ref_length``.

    Aligned runs are split at the contig end (the outside part becomes S),
    insertions past the end become S, deletions/skips past the end are cut,
    reference gaps left dangling before the clip are dropped and adjacent
    equal operators merged.
    """
    L = _c(ref_length)
    empty = F.array().cast(f"array<{_ELEM}>")

    def el(n, op):
        return F.struct(n.cast("int").alias("len"), op.alias("op"))

    def step(acc, e):
        n, op, g = e["len"], e["op"], acc["g"]
        inside = F.greatest(F.lit(0), F.least(n, L - g + 1))
        aligned = op.isin("M", "=", "X")
        gap = op.isin("D", "N")
        pieces = (F.when(aligned, F.array(el(inside, op), el(n - inside, F.lit("S"))))
                  .when(gap, F.array(el(inside, op)))
                  .when(op == "I", F.array(el(n, F.when(g > L, F.lit("S")).otherwise(F.lit("I")))))
                  .otherwise(F.array(el(n, op))))
        g2 = F.when(aligned | gap, g + n).otherwise(g)
        return F.struct(g2.alias("g"), F.concat(acc["out"], F.filter(pieces, lambda p: p["len"] > 0)).alias("out"))

    init = F.struct(_c(pos).cast("long").alias("g"), empty.alias("out"))
    cut = F.aggregate(cg.elements(cigar), init, step, lambda a: a["out"])

    def drop_dangling(acc, e):
        keep = ~e["op"].isin("D", "N") | acc["seen"]
        seen = acc["seen"] | e["op"].isin("M", "=", "X", "I")
        out = F.when(keep, F.concat(F.array(e), acc["out"])).otherwise(acc["out"])
        return F.struct(seen.alias("seen"), out.alias("out"))

    trimmed = F.aggregate(F.reverse(cut), F.struct(F.lit(False).alias("seen"), empty.alias("out")),
                          drop_dangling, lambda a: a["out"])

    def merge(acc, e):
        last = F.try_element_at(acc, F.lit(-1))
        same = F.size(acc) > 0
        same = same & (last["op"] == e["op"])
        merged = F.concat(F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(0))),
                          F.array(el(last["len"] + e["len"], e["op"])))
        return F.when(same, merged).otherwise(F.concat(acc, F.array(e)))

    merged = F.aggregate(trimmed, empty, merge)
    return F.array_join(F.transform(merged, lambda e: F.concat(e["len"].cast("string"), e["op"])), "")


def clean_reads(reads: DataFrame, contigs: DataFrame) -> DataFrame:
    """Unmapped reads get mapq 0; a mapped read starting past its contig end is
    made unmapped; one that runs off the end is soft-clipped at the end."""
    d = F.broadcast(contigs.select(F.col("ref_index").alias("_ri"), F.col("length").alias("_len")))
    j = reads.join(d, reads["ref_index"] == d["_ri"], "left")
    mapped = fl.is_mapped("flag")
    end = co.alignment_end("pos", "cigar", "flag")
    beyond = mapped & F.col("_len").isNotNull() & (F.col("pos") > F.col("_len"))
    overhang = mapped & F.col("_len").isNotNull() & ~beyond & (end > F.col("_len"))
    unmapped_rows = rec.make_unmapped(j.filter(beyond))
    rest = j.filter(~beyond | beyond.isNull())
    rest = (rest.withColumn("cigar", F.when(overhang, clip_cigar_at("cigar", "pos", "_len"))
                            .otherwise(F.col("cigar")))
            .withColumn("mapq", F.when(~mapped, F.lit(0)).otherwise(F.col("mapq"))))
    return rest.unionByName(unmapped_rows).drop("_ri", "_len")


# --- duplicates ------------------------------------------------------------------------

# Fixed value: bases below this quality do not count towards a read's score.
MIN_SCORE_QUALITY = 15
#: Bytes of a quality text to what they add to the score.
SCORES = np.zeros(256, dtype=np.int64)
SCORES[MIN_SCORE_QUALITY + bs.PHRED_OFFSET:bs.MAX_PHRED + bs.PHRED_OFFSET + 1] = np.arange(MIN_SCORE_QUALITY, bs.MAX_PHRED + 1)


def read_score(qual) -> Column:
    """Sum of base qualities >= 15 (one pass over the quality characters)."""
    lo, hi = MIN_SCORE_QUALITY + bs.PHRED_OFFSET, bs.MAX_PHRED + bs.PHRED_OFFSET

    def add(acc, ch):
        v = F.ascii(ch)
        return acc + F.when((v >= lo) & (v <= hi), v - bs.PHRED_OFFSET).otherwise(0)
    return F.aggregate(bs.chars(qual), F.lit(0).cast("long"), add)


def five_prime(pos="pos", cigar="cigar", flag="flag") -> Column:
    """Unclipped 5' end: unclipped start on the forward strand, unclipped end on the reverse."""
    end = co.alignment_end(pos, cigar, flag)
    return F.when(fl.has(flag, fl.REVERSE), co.unclipped_end(end, cigar)) \
        .otherwise(co.unclipped_start(pos, cigar))


def end_key(ref_index, five_prime_pos, reverse) -> Column:
    """(contig, 5' position, strand) packed into one BIGINT with the same order
    as the tuple, so min/max/equality run in hash aggregation."""
    r = _c(ref_index).cast("long") + 1
    p = _c(five_prime_pos).cast("long") + (1 << 31)
    return F.shiftleft(r, 33) + p * 2 + _c(reverse).cast("long")


def _ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of mapped reads: packed 5' end (``five_prime``, ``end_key``) and score (``read_score``)."""
    for batch in batches:
        column = {name: batch.column(name) for name in ("ref_index", "pos", "cigar", "flag", "qual")}
        texts, which = distinct(column["cigar"])
        lead, span, trail = (np.array(x, dtype=np.int64)[which] for x in zip(*map(clips_and_span, texts))) if texts else [np.zeros(0, dtype=np.int64)] * 3
        known = np.ones(batch.num_rows, dtype=bool)
        for name in ("ref_index", "pos", "cigar"):
            known &= column[name].is_valid().to_numpy(zero_copy_only=False)
        ref, pos, flag = (column[n].fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64) for n in ("ref_index", "pos", "flag"))
        back = (flag & fl.REVERSE != 0).astype(np.int64)
        place = np.where(back == 1, pos + span - 1 + trail, pos - lead)
        end = ((ref + 1) << 33) + (place + (1 << 31)) * 2 + back
        data, at = octets(column["qual"])
        score = row_sums(SCORES[data], at)
        absent = column["qual"].is_null().to_numpy(zero_copy_only=False)
        rest = [n for n in batch.schema.names if n not in column]
        yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in rest), pa.array(end, mask=~known), pa.array(score, mask=absent)], [*rest, "end", "score"])


def read_ends(mapped: DataFrame, keep: list[str]) -> DataFrame:
    """qname, ``keep``, packed 5' end and score of mapped reads, by numpy over batches."""
    rows = mapped.select("qname", *keep, "ref_index", "pos", "cigar", "flag", "qual")
    out = T.StructType([rows.schema[n] for n in ("qname", *keep)] + [T.StructField(n, T.LongType()) for n in ("end", "score")])
    return rows.mapInArrow(_ends, out)


def _stored(df: DataFrame, name: str) -> DataFrame:
    """The rows, written once to the checkpoint folder."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def mark_duplicates(reads: DataFrame, library: Column | None = None) -> DataFrame:
    """Flag duplicates (0x400) among mapped reads.

    * only primary records are judged: secondary and supplementary ones keep their
      flag and never form a pair;
    * records sharing a name and library form a pair, a single one is a fragment;
    * a pair's key is (library, both ends' (contig, 5' position, strand)),
      a fragment's key is (library, its end);
    * in each key the highest score (sum of qualities >= 15, summed over both
      ends) wins, ties to the smallest name; all others are duplicates;
    * a fragment whose end is also a pair end is a duplicate.

    Pairs are formed and winners chosen with aggregations (partial combine on
    the map side), then joined back on one-row-per-key tables: a position
    holding a third of all reads costs no single-task window.
    """
    own = [] if library is None else ["_lib"]
    reads = reads if library is None else reads.withColumn("_lib", F.coalesce(library, F.lit("")))
    m = reads.filter(fl.is_mapped("flag") & fl.is_primary("flag"))
    # the names are read by five steps below: they are worked out and written once
    names = _stored(read_ends(m, own).groupBy("qname", *own).agg(
        (F.count(F.lit(1)) >= 2).alias("paired"), F.min("end").alias("e1"), F.max("end").alias("e2"), F.sum("score").alias("score")), "names")

    # a fragment's ends are equal, so pairs and fragments share one key
    key = [*own, "paired", "e1", "e2"]
    pick = F.min_by("qname", F.struct((-F.col("score")).alias("s"), F.col("qname").alias("q")))
    best = names.groupBy(*key).agg(pick.alias("_best"), F.count(F.lit(1)).alias("_k")).filter("_k > 1")
    beaten = names.join(best, key).filter(F.col("qname") != F.col("_best")).select("qname", *own)

    pairs = names.filter("paired")
    pair_ends = pairs.select(*own, "e1").unionByName(pairs.select(*own, F.col("e2").alias("e1"))).distinct()
    taken = names.filter(~F.col("paired")).join(pair_ends, [*own, "e1"], "left_semi").select("qname", *own)

    # a name that is not here is no duplicate: most names need not travel to the reads
    dups = beaten.unionByName(taken).distinct().withColumn("dup", F.lit(True))
    out = reads.join(dups, ["qname", *own], "left")
    marked = fl.set_bit("flag", fl.DUPLICATE, F.coalesce("dup", F.lit(False)))
    return out.withColumn("flag", F.when(fl.is_primary("flag"), marked).otherwise(F.col("flag"))).select(
        *[c for c in reads.columns if c != "_lib"])


def duplicate_metrics(marked: DataFrame, library: Column | None = None) -> DataFrame:
    """Per library: fragments and pairs examined, duplicates, duplicate fraction."""
    lib = F.coalesce(library, F.lit("")) if library is not None else F.lit("LIB1")
    m = marked.filter(fl.is_mapped("flag") & fl.is_primary("flag")).withColumn("_lib", lib)
    per_name = m.groupBy("_lib", "qname").agg(
        F.count(F.lit(1)).alias("n"), F.max(fl.has("flag", fl.DUPLICATE).cast("int")).alias("dup"))
    agg = per_name.groupBy("_lib").agg(
        F.count_if(F.col("n") == 1).alias("unpaired_examined"),
        F.count_if(F.col("n") >= 2).alias("pairs_examined"),
        F.count_if((F.col("n") == 1) & (F.col("dup") == 1)).alias("unpaired_duplicates"),
        F.count_if((F.col("n") >= 2) & (F.col("dup") == 1)).alias("pair_duplicates"))
    frac = ((F.col("unpaired_duplicates") + 2 * F.col("pair_duplicates"))
            / (F.col("unpaired_examined") + 2 * F.col("pairs_examined")))
    return agg.select(F.col("_lib").alias("library"), "unpaired_examined", "pairs_examined",
                      "unpaired_duplicates", "pair_duplicates", F.round(frac, 6).alias("percent_duplication"))


# --- base-level covariates ---------------------------------------------------------------

def empirical_quality(mm, obs) -> Column:
    """-10 log10((mismatches + 1) / (observations + 2))."""
    return -10.0 * F.log10((_c(mm) + 1) / (_c(obs) + 2))


def bqsr_table(reads: DataFrame, ref_tiles: DataFrame, known: DataFrame, rg: str = "rg") -> DataFrame:
    """Per (read group, reported quality, cycle, context): observations and
    mismatches at aligned non-N bases outside known variant sites (``covariates``)."""
    t = count_covariates(reads, ref_tiles, known, rg)
    return t.withColumn("empirical_q", F.round(empirical_quality("mismatches", "observations"), 4))


def _level(table: DataFrame, keys: list[str]) -> DataFrame:
    return table.groupBy(*keys).agg(F.sum("observations").alias("obs"), F.sum("mismatches").alias("mm"),
                                    F.sum(F.col("q") * F.col("observations")).alias("qsum"))


_CTX_BASES = ("A", "C", "G", "T")
N_QUAL = 94          # Phred 0..93
N_CTX = 25           # 5 x 5 dinucleotide codes (A C G T, anything else)


def _base_code(b: Column) -> Column:
    p = F.array_position(F.array(*[F.lit(x) for x in _CTX_BASES]), b)
    return F.when(p == 0, F.lit(4)).otherwise(p - 1).cast("int")


def context_code(ctx) -> Column:
    c = _c(ctx)
    return _base_code(F.substring(c, 1, 1)) * 5 + _base_code(F.substring(c, 2, 1))


def _dense(sparse: DataFrame, rg: str, size: int, name: str) -> DataFrame:
    """(rg, idx, d) -> one row per read group holding a dense array (missing = 0),
    so a per-base lookup is an O(1) array access."""
    idx = sparse.select(rg).distinct().select(rg, F.explode(F.sequence(F.lit(0), F.lit(size - 1))).alias("idx"))
    j = idx.join(sparse, [rg, "idx"], "left")
    arr = F.array_sort(F.collect_list(F.struct("idx", F.coalesce("d", F.lit(0.0)).alias("d"))))
    return j.groupBy(rg).agg(arr.alias("_a")).select(rg, F.transform("_a", lambda x: x["d"]).alias(name))


def recalibration_deltas(table: DataFrame, rg: str = "rg") -> DataFrame:
    """One row per read group: the global delta and dense per-Q, per-(Q, cycle)
    and per-(Q, context) delta arrays. Size is bounded by read groups x 94
    qualities x (max cycle + 25 contexts), independent of data volume; the
    only value brought to the driver is the largest cycle (one scalar)."""
    # The table is small (bounded as above) but feeds four aggregations and a
    # driver scalar: materialise it once in the checkpoint folder.
    ensure_checkpoint_dir(table.sparkSession)
    table = table.checkpoint(eager=True)
    max_cycle = int(table.agg(F.max("cycle")).first()[0] or 0)
    width = max_cycle + 1
    g = _level(table, [rg]).withColumn("d_rg", empirical_quality("mm", "obs") - F.col("qsum") / F.col("obs"))
    q = _level(table, [rg, "q"]).join(g.select(rg, "d_rg"), rg) \
        .withColumn("d_q", empirical_quality("mm", "obs") - (F.col("q") + F.col("d_rg")))
    base = q.select(rg, "q", (F.col("q") + F.col("d_rg") + F.col("d_q")).alias("_b"))
    cyc = _level(table, [rg, "q", "cycle"]).join(base, [rg, "q"]) \
        .select(rg, (F.col("q") * width + F.col("cycle")).alias("idx"),
                (empirical_quality("mm", "obs") - F.col("_b")).alias("d"))
    ctx = _level(table.filter(F.col("context").isNotNull()), [rg, "q", "context"]).join(base, [rg, "q"]) \
        .select(rg, (F.col("q") * N_CTX + context_code("context")).alias("idx"),
                (empirical_quality("mm", "obs") - F.col("_b")).alias("d"))
    qa = _dense(q.select(rg, F.col("q").alias("idx"), F.col("d_q").alias("d")), rg, N_QUAL, "a_q")
    ca = _dense(cyc, rg, N_QUAL * width, "a_cycle")
    xa = _dense(ctx, rg, N_QUAL * N_CTX, "a_ctx")
    return (g.select(rg, "d_rg").join(qa, rg, "left").join(ca, rg, "left").join(xa, rg, "left")
            .withColumn("cycle_width", F.lit(width)))


def _codes(seq_upper: Column) -> Column:
    """Per-base codes A0 C1 G2 T3, anything else 4."""
    return F.transform(F.split(seq_upper, ""), lambda b: F.when(b == "A", 0).when(b == "C", 1)
                       .when(b == "G", 2).when(b == "T", 3).otherwise(4))


#: Delta arrays up to this size are broadcast.
DELTA_BYTES = 64 << 20


def bqsr_apply(reads: DataFrame, deltas: DataFrame, rg: str = "rg", delta_bytes: int = DELTA_BYTES,
               salts: int = 64) -> DataFrame:
    """New quality per base = q + global + per-Q + per-cycle + per-context
    deltas (missing deltas count 0), rounded, clamped to 1..93.

    Delta rows up to ``DELTA_BYTES`` (measured first) are sent to every worker, and numpy
    recalibrates all bases of a batch at once (``recalibrate``). Beyond it the rows are repeated for
    ``salts`` salts and reads join on (group, salt), so one group's reads go to many tasks, and array
    expressions recalibrate inside the read's row. Bases are never exploded or shuffled.
    """
    cells = F.size("a_q") + F.size("a_cycle") + F.size("a_ctx")
    held = 8 * (deltas.agg(F.sum(cells)).first()[0] or 0)
    if held <= delta_bytes:
        return recalibrate(reads, deltas, rg)
    salted = deltas.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    salt = F.pmod(F.xxhash64("qname", "seq", "qual"), F.lit(salts)).cast("int")
    j = reads.withColumn("_salt", salt).join(salted, [rg, "_salt"], "left").drop("_salt")
    n = F.length("seq")
    neg = fl.has("flag", fl.REVERSE)
    j = j.withColumn("_c", _codes(F.upper("seq"))).withColumn("_neg", neg).withColumn("_n", n)

    def comp(c):
        return F.when(c < 4, 3 - c).otherwise(4)

    def new_q(qi, i):
        nn, w = F.col("_n"), F.col("cycle_width")
        cur = F.element_at("_c", i + 1)
        fwd = F.when(i >= 1, F.element_at("_c", F.greatest(i, F.lit(1))) * 5 + cur)
        rev = F.when(i <= nn - 2, comp(F.element_at("_c", F.least(i + 2, nn))) * 5 + comp(cur))
        ctx = F.when(F.col("_neg"), rev).otherwise(fwd)
        cycle = F.when(F.col("_neg"), nn - i).otherwise(i + 1)
        dq = F.coalesce(F.try_element_at("a_q", qi + 1), F.lit(0.0))
        dc = F.when(cycle < w, F.coalesce(F.try_element_at("a_cycle", qi * w + cycle + 1), F.lit(0.0))) \
            .otherwise(F.lit(0.0))
        dx = F.coalesce(F.try_element_at("a_ctx", qi * N_CTX + ctx + 1), F.lit(0.0))
        v = F.round(qi + F.coalesce("d_rg", F.lit(0.0)) + dq + dc + dx).cast("int")
        return F.least(F.greatest(v, F.lit(1)), F.lit(bs.MAX_PHRED))

    recal = F.transform(bs.phred_decode("qual"), new_q)
    return (j.withColumn("qual", bs.phred_encode(recal))
            .drop("d_rg", "a_q", "a_cycle", "a_ctx", "cycle_width", "_c", "_neg", "_n"))


# --- MD sites, indel targets --------------------------------------------------------

def md_events(md) -> Column:
    """MD string -> array of (kind, base, md_offset): one per mismatching base
    (kind ``X``) and per deleted reference base (kind ``D``); offsets count the
    reference bases the MD string walks (0-based)."""
    toks = F.regexp_extract_all(_c(md), F.lit(r"(\d+|\^[A-Za-z]+|[A-Za-z])"), 1)
    ev_t = "array<struct<kind:string,base:string,off:int>>"

    def step(acc, t):
        o = acc["o"]
        is_num = t.rlike(r"^\d+$")
        is_del = t.startswith("^")
        dels = F.transform(F.sequence(F.lit(1), F.greatest(F.length(t) - 1, F.lit(1))),
                           lambda i: F.struct(F.lit("D").alias("kind"), F.substring(t, i + 1, 1).alias("base"),
                                              (o + i - 1).alias("off")))
        ev = (F.when(is_num, F.array().cast(ev_t))
              .when(is_del, dels)
              .otherwise(F.array(F.struct(F.lit("X").alias("kind"), t.alias("base"), o.alias("off")))))
        width = F.when(is_num, t.cast("int")).when(is_del, F.length(t) - 1).otherwise(F.lit(1))
        return F.struct((o + width).alias("o"), F.concat(acc["ev"], ev).alias("ev"))

    init = F.struct(F.lit(0).alias("o"), F.array().cast(ev_t).alias("ev"))
    return F.aggregate(toks, init, step, lambda a: a["ev"])


def md_length(md) -> Column:
    toks = F.regexp_extract_all(_c(md), F.lit(r"(\d+|\^[A-Za-z]+|[A-Za-z])"), 1)
    return F.aggregate(toks, F.lit(0), lambda a, t: a + F.when(t.rlike(r"^\d+$"), t.cast("int"))
                       .when(t.startswith("^"), F.length(t) - 1).otherwise(F.lit(1)))


def md_segments(cigar, pos) -> Column:
    """Reference-consuming elements the MD walks (M/=/X/D, not N) as
    (md_start, ref_start, len)."""
    seg_t = "array<struct<md:int,ref:int,len:int>>"

    def step(acc, e):
        n, op = e["len"], e["op"]
        walks = op.isin("M", "=", "X", "D")
        seg = F.when(walks, F.array(F.struct(acc["m"].alias("md"), acc["g"].alias("ref"), n.alias("len")))) \
            .otherwise(F.array().cast(seg_t))
        m = F.when(walks, acc["m"] + n).otherwise(acc["m"])
        g = F.when(op.isin("M", "=", "X", "D", "N"), acc["g"] + n).otherwise(acc["g"])
        return F.struct(m.alias("m"), g.alias("g"), F.concat(acc["s"], seg).alias("s"))

    init = F.struct(F.lit(0).alias("m"), _c(pos).alias("g"), F.array().cast(seg_t).alias("s"))
    return F.aggregate(cg.elements(cigar), init, step, lambda a: a["s"])


def md_sites(reads: DataFrame):
    """Mismatch / deletion sites from MD tags, counted per (contig, locus, base, kind).

    Returns (sites, errors): reads whose MD length differs from the number of
    M/=/X/D reference bases go to ``errors`` and are not counted.
    """
    walk = F.aggregate(md_segments("cigar", "pos"), F.lit(0), lambda a, s: a + s["len"])
    r = reads.filter(F.col("cigar") != "*").withColumn("_mdlen", md_length("md")).withColumn("_walk", walk)
    errors = r.filter(F.col("_mdlen") != F.col("_walk")).select("qname", "md", "cigar")
    ok = r.filter(F.col("_mdlen") == F.col("_walk"))
    ev = ok.select("ref_index", "pos", "cigar", F.explode(md_events("md")).alias("e"))
    segs = md_segments("cigar", "pos")
    hit = F.try_element_at(F.filter(segs, lambda s: (F.col("e.off") >= s["md"]) & (F.col("e.off") < s["md"] + s["len"])),
                           F.lit(1))
    locus = hit["ref"] + F.col("e.off") - hit["md"]
    sites = (ev.select("ref_index", locus.alias("locus"), F.upper("e.base").alias("base"), F.col("e.kind").alias("kind"))
             .groupBy("ref_index", "locus", "base", "kind").agg(F.count(F.lit(1)).alias("n")))
    return sites, errors


# Fixed value: bases added on each side of an indel for a realignment target.
INDEL_WINDOW = 20


def indel_target_intervals(reads: DataFrame, window: int = INDEL_WINDOW, contigs: DataFrame | None = None) -> DataFrame:
    """Intervals around insertions and deletions, merged when they touch.

    An insertion before reference base p covers [p - w, p - 1 + w]; a deletion
    of reference bases [p, p + n - 1] covers [p - w, p + n - 1 + w]. Intervals begin at
    base 1 at the earliest and, with ``contigs`` (ref_index, length), end on the contig;
    on a contig that is not listed the end stays.
    """
    def step(acc, e):
        n, op, g = e["len"], e["op"], acc["g"]
        iv = F.when(op == "I", F.array(F.struct((g - window).alias("start"), (g - 1 + window).alias("end")))) \
            .when(op == "D", F.array(F.struct((g - window).alias("start"), (g + n - 1 + window).alias("end")))) \
            .otherwise(F.array().cast("array<struct<start:int,end:int>>"))
        g2 = F.when(op.isin("M", "=", "X", "D", "N"), g + n).otherwise(g)
        return F.struct(g2.alias("g"), F.concat(acc["iv"], iv).alias("iv"))

    init = F.struct(F.col("pos").alias("g"), F.array().cast("array<struct<start:int,end:int>>").alias("iv"))
    ivs = reads.filter(fl.is_mapped("flag") & (F.col("ref_index") >= 0)).select(
        "ref_index", F.explode(F.aggregate(cg.elements("cigar"), init, step, lambda a: a["iv"])).alias("iv"))
    flat = ivs.select("ref_index", F.col("iv.start").alias("start"), F.col("iv.end").alias("end"))
    out = isl.islands(flat, gap=1).withColumnRenamed("n_reads", "n_events")
    columns = out.columns
    out = out.withColumn("island_start", F.greatest("island_start", F.lit(1)))
    if contigs is not None:
        lengths = contigs.select("ref_index", F.col("length").cast("int").alias("_len"))
        on_contig = F.least("island_end", F.greatest("_len", "island_start"))
        out = out.join(lengths, "ref_index", "left").withColumn(
            "island_end", F.when(F.col("_len").isNull(), F.col("island_end")).otherwise(on_contig))
    return out.select(*columns)
