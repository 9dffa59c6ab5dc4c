"""Line-oriented text sources and sinks: dictionaries, FASTQ, VCF, BED, region lists.

File order matters for some formats (FASTQ groups lines by four, dictionary
index = line order). ``number_lines`` gives every line its 0-based index in
the logical file without a single-task window: lines are counted per input
split, the small split table gets cumulative offsets, and each line adds its
position inside the split.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import scratch_path


def number_lines(lines: DataFrame, col: str = "value", per_file: bool = True) -> DataFrame:
    """Add ``file``, ``line_no`` (0-based, in file order) to a text scan.

    ``lines`` must come straight from ``spark.read.text`` (the ``_metadata``
    column is used). Splits are identified by (file, block start); inside a
    split, rows keep file order and ``monotonically_increasing_id`` is
    contiguous, so position = id - min id of the split.
    """
    base = _with_ids(lines, col)
    offsets = _split_offsets(base, per_file)
    out = base.join(offsets.select("file", "_blk", "_off", "_min"), ["file", "_blk"])
    return out.select(col, "file", (F.col("_off") + F.col("_mid") - F.col("_min")).alias("line_no"))


def _with_ids(lines: DataFrame, col: str) -> DataFrame:
    return lines.select(F.col(col).alias(col), F.col("_metadata.file_path").alias("file"),
                        F.col("_metadata.file_block_start").alias("_blk"), F.monotonically_increasing_id().alias("_mid"))


def _split_offsets(base: DataFrame, per_file: bool) -> DataFrame:
    """Per input split: file, _blk, _n lines, _min (first id), _off (lines before it)."""
    splits = base.groupBy("file", "_blk").agg(F.count(F.lit(1)).alias("_n"), F.min("_mid").alias("_min"))
    part = ["file"] if per_file else []
    w = Window.partitionBy(*part).orderBy("file", "_blk").rowsBetween(Window.unboundedPreceding, -1)
    return splits.withColumn("_off", F.coalesce(F.sum("_n").over(w), F.lit(0)))


#: Split tables up to this many rows (about 100 bytes each) are broadcast.
BROADCAST_SPLITS = 500_000


def stored_offsets(lines: DataFrame, col: str = "value", per_file: bool = True) -> tuple[DataFrame, int]:
    """The split table of a text scan, written once, and its number of rows."""
    path = scratch_path(lines.sparkSession, "splits.parquet")
    _split_offsets(_with_ids(lines, col), per_file).write.parquet(path)
    table = lines.sparkSession.read.parquet(path)
    return table, table.count()


def _fours(batches):
    """Every four lines that follow each other become a record (name, seq, qual)."""
    rest = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        if rest is not None and rest.num_rows:
            table = pa.concat_tables([rest, table])
        whole = table.num_rows // 4 * 4
        at = np.arange(0, whole, 4)
        head, seq, qual = (table.take(pa.array(at + k)) for k in (0, 1, 3))
        if whole:
            out = pa.table({"chunk_id": pc.divide(head["line_no"], 4), "name": pc.utf8_slice_codeunits(head["value"], 1),
                            "seq": seq["value"], "qual": qual["value"], "file": head["file"]})
            yield from out.combine_chunks().to_batches()
        rest = table.slice(whole)


def list_chunks(spark: SparkSession, folder: str, pattern: str = "part*") -> DataFrame:
    """Input chunk files under ``folder`` whose name matches ``pattern``, sorted by path:
    path (a URI), name (its last part), n_lines (0 for empty files).

    Files come from the listing that Spark's driver holds for the scan, since a scan
    itself skips empty files; lines are counted only if ``n_lines`` is used."""
    lines = spark.read.option("pathGlobFilter", pattern).text(folder)
    files = spark.createDataFrame([(p,) for p in lines.inputFiles()], "path string")
    # the listing and the scan write the slashes after a scheme differently
    key = lambda c: F.regexp_replace(c, "^([^:/]+):/+", "$1:/").alias("_key")
    counts = lines.select(key(F.col("_metadata.file_path"))).groupBy("_key").agg(F.count(F.lit(1)).alias("_n"))
    return (files.select("path", key(F.col("path"))).join(counts, "_key", "left")
            .select("path", F.regexp_extract("path", "([^/]*)$", 1).alias("name"),
                    F.coalesce("_n", F.lit(0).cast("long")).alias("n_lines")).orderBy("path"))


# --- sequence dictionary --------------------------------------------------------

def parse_dict_lines(numbered: DataFrame) -> DataFrame:
    """Dictionary lines (``file``, ``line_no``, ``value``) -> contigs.

    The first line is a header; on the others, field 2 and 3 (whitespace
    separated) hold ``SN:name`` and ``LN:length`` (text after the first ``:``);
    a non-numeric length becomes 0. Index = order of the line.
    """
    body = numbered.filter(F.col("line_no") > 0)
    f = F.split(F.col("value"), r"\s+")

    parsed = body.select("line_no", F.get(f, F.lit(1)).alias("_sn"), F.get(f, F.lit(2)).alias("_ln"))
    parsed = parsed.select(
        "line_no",
        F.expr("substr(_sn, instr(_sn, ':') + 1)").alias("ref_name"),
        F.coalesce(F.expr("substr(_ln, instr(_ln, ':') + 1)").try_cast("bigint"), F.lit(0)).alias("length"))
    return parsed.select((F.col("line_no") - 1).cast("int").alias("ref_index"), "ref_name", "length")


def read_contigs(spark: SparkSession, path: str) -> DataFrame:
    return parse_dict_lines(number_lines(spark.read.text(path)))


# --- FASTQ ------------------------------------------------------------------------

def parse_fastq_lines(numbered: DataFrame, mate: int | None = None, per_file: bool = False) -> DataFrame:
    """Numbered FASTQ lines -> one row per record: ``chunk_id`` = line_no div 4.

    Lines are grouped by their index, never by content, because ``@`` is a
    legal quality character. With ``per_file`` line numbers restart in each
    file (and records are keyed by file too); otherwise the folder is one
    logical file whose parts follow in name order.
    """
    g = numbered.withColumn("chunk_id", F.floor(F.col("line_no") / 4).cast("long")) \
        .withColumn("_k", (F.col("line_no") % 4).cast("int"))
    rec = g.groupBy(*(["file"] if per_file else []), "chunk_id").agg(
        F.max(F.when(F.col("_k") == 0, F.col("value"))).alias("_h"),
        F.max(F.when(F.col("_k") == 1, F.col("value"))).alias("seq"),
        F.max(F.when(F.col("_k") == 3, F.col("value"))).alias("qual"))
    out = rec.select(*(["file"] if per_file else []), "chunk_id", F.expr("substr(_h, 2)").alias("name"), "seq", "qual")
    if mate is not None:
        out = out.withColumn("mate", F.lit(mate))
    return out


def read_fastq(spark: SparkSession, path: str, mate: int | None = None, per_file: bool = False) -> DataFrame:
    """FASTQ records of the files under ``path`` (see ``parse_fastq_lines``), without moving lines.

    A first pass counts the lines of each input split. From these counts each split knows which
    of its lines belong to records that cross its borders: at most three at each end. Only those
    are exchanged; all other lines are put together in fours where they are read. Split tables
    beyond ``BROADCAST_SPLITS`` rows are joined by exchange instead.
    """
    lines = spark.read.text(path)
    splits, n = stored_offsets(lines, per_file=per_file)
    if n > BROADCAST_SPLITS:
        return parse_fastq_lines(number_lines(lines, per_file=per_file), mate, per_file)
    small = F.broadcast(splits.select(F.col("file").alias("_f"), F.col("_blk").alias("_fb"), "_n", "_min", "_off"))
    base = _with_ids(lines, "value")
    placed = (base.join(small, (base["file"] == small["_f"]) & (base["_blk"] == small["_fb"]))
              .withColumn("_at", F.col("_mid") - F.col("_min")).withColumn("line_no", F.col("_off") + F.col("_at")))
    head = F.least(F.pmod(-F.col("_off"), F.lit(4)), F.col("_n"))
    tail = F.pmod(F.col("_off") + F.col("_n"), F.lit(4))
    inner = (F.col("_at") >= head) & (F.col("_at") < F.col("_n") - tail)
    whole = placed.filter(inner).select("value", "file", "line_no").mapInArrow(
        _fours, "chunk_id long, name string, seq string, qual string, file string")
    crossing = parse_fastq_lines(placed.filter(~inner).select("value", "file", "line_no"), None, per_file)
    out = whole.select(*crossing.columns).unionByName(crossing)
    return out if mate is None else out.withColumn("mate", F.lit(mate))


def fastq_lines(records: DataFrame) -> DataFrame:
    """Records (name, seq, qual, order key ``k``) -> 4 text lines each.

    Returns ``k, _rid, sub, value``; sorting by (k, _rid, sub) keeps the four
    lines of a record together even when records tie on ``k``.
    """
    four = F.array(F.concat(F.lit("@"), F.col("name")), F.col("seq"), F.lit("+"), F.col("qual"))
    r = records.withColumn("_rid", F.monotonically_increasing_id())
    return r.select("k", "_rid", F.posexplode(four).alias("sub", "value"))


#: Records of a block, and bytes of records that a task holds before it hands blocks on.
BLOCK = 2048
HELD_BYTES = 16 << 20


def _packed(table: pa.Table) -> bytes:
    """A table as one compressed Arrow stream, columns apart."""
    out = pa.BufferOutputStream()
    with pa.ipc.new_stream(out, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as stream:
        stream.write_table(table.combine_chunks())
    return out.getvalue().to_pybytes()


def _unpacked(column) -> pa.Table:
    return pa.concat_tables([pa.ipc.open_stream(x.as_buffer()).read_all() for x in column])


def _runs(ids: pa.ChunkedArray) -> np.ndarray:
    """Where runs of equal values begin, and the end."""
    new = pc.not_equal(ids.slice(1), ids.slice(0, max(len(ids) - 1, 0))).combine_chunks()
    either = pc.xor(ids.slice(1).is_null(), ids.slice(0, max(len(ids) - 1, 0)).is_null()).combine_chunks()
    at = np.flatnonzero(pc.or_(pc.fill_null(new, False), either).to_numpy(zero_copy_only=False)) + 1
    return np.concatenate(([0], at, [len(ids)])).astype(np.int64)


def _blocks(batches):
    """Records that follow each other, packed by block: block, payload."""
    def packed(table):
        at = _runs(table["block"])
        rows = [(table["block"][low].as_py(), _packed(table.slice(low, high - low).drop(["block"]))) for low, high in zip(at[:-1].tolist(), at[1:].tolist())]
        return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.binary())], ["block", "payload"])

    held = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        held = table if held is None else pa.concat_tables([held, table])
        if held.nbytes > HELD_BYTES:
            last = int(_runs(held["block"])[-2])  # the last block may go on
            if last:
                yield packed(held.slice(0, last))
                held = pa.Table.from_batches(held.slice(last).combine_chunks().to_batches(), held.schema)
    if held is not None and held.num_rows:
        yield packed(held)


def _interleaved(table: pa.Table) -> pa.Table:
    """The records of a block, put together by chunk_id: mates in order."""
    rows = _unpacked(table.column("payload"))
    head = pc.binary_join_element_wise("@", rows["name"], "")
    rec = pc.binary_join_element_wise(head, rows["seq"], "+", rows["qual"], "\n", null_handling="skip")
    rows = pa.table({"chunk_id": rows["chunk_id"], "mate": rows["mate"], "rec": rec}).sort_by([("chunk_id", "ascending"), ("mate", "ascending"), ("rec", "ascending")])
    at = _runs(rows["chunk_id"])
    lists = pa.ListArray.from_arrays(pa.array(at, pa.int32()), rows["rec"].combine_chunks())
    return pa.table({"chunk_id": rows["chunk_id"].take(pa.array(at[:-1])), "value": pc.binary_join(lists, "\n")})


def interleave_fastq(r1: DataFrame, r2: DataFrame) -> DataFrame:
    """R1 and R2 records keyed by ``chunk_id`` -> one text block per chunk, R1 first.

    Returns ``chunk_id, value`` where value holds the 4 (or 8) lines joined by
    newlines; sorting by chunk_id gives the interleaved file. Files hold records in order, so
    a task's records of ``BLOCK`` chunks in a row are exchanged as one compressed payload.
    """
    both = r1.withColumn("mate", F.lit(1)).unionByName(r2.withColumn("mate", F.lit(2)))
    rows = both.select(F.floor(F.col("chunk_id") / BLOCK).cast("long").alias("block"), "chunk_id", "mate", "name", "seq", "qual")
    packed = rows.mapInArrow(_blocks, "block long, payload binary")
    kind = rows.schema["chunk_id"].dataType.simpleString()
    return packed.groupBy("block").applyInArrow(_interleaved, f"chunk_id {kind}, value string")


# --- VCF ---------------------------------------------------------------------------

def chrom_number(chrom) -> F.Column:
    """``chrN`` -> N, X -> 23, Y -> 24, other names -> NULL."""
    c = F.col(chrom) if isinstance(chrom, str) else chrom
    rest = F.substr(c, F.lit(4))
    return (F.when(rest == "X", F.lit(23)).when(rest == "Y", F.lit(24))
            .otherwise(rest.try_cast("int")))


VCF_COLUMNS = ["chrom", "pos", "id", "ref", "alt", "qual", "filter", "info", "format", "sample"]


def parse_vcf_lines(lines: DataFrame, col: str = "value") -> DataFrame:
    """VCF body (lines not starting ``#``) -> ``chrom_num, pos, fields..., line``."""
    body = lines.filter(~F.col(col).startswith("#"))
    f = F.split(F.col(col), "\t")
    return body.select(
        chrom_number(F.get(f, F.lit(0))).alias("chrom_num"),
        F.get(f, F.lit(1)).try_cast("int").alias("pos"),
        F.get(f, F.lit(0)).alias("chrom"), F.get(f, F.lit(2)).alias("id"), F.get(f, F.lit(3)).alias("ref"), F.get(f, F.lit(4)).alias("alt"),
        F.get(f, F.lit(5)).try_cast("double").alias("qual"), F.get(f, F.lit(6)).alias("filter"), F.get(f, F.lit(7)).alias("info"),
        F.get(f, F.lit(8)).alias("format"), F.get(f, F.lit(9)).alias("sample"),
        F.col(col).alias("line"))


def read_vcf(spark: SparkSession, path: str) -> DataFrame:
    return parse_vcf_lines(spark.read.text(path))


# Fixed value: the single-sample VCF column header written by the pipeline.
VCF_HEADER = "#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\tFORMAT\tSAMPLE1"


def sort_variants(variants: DataFrame) -> DataFrame:
    """Order by (chrom_num, pos, line); unknown chromosomes last. Adds ``rank``."""
    keyed = variants.withColumn("_c", F.coalesce(F.col("chrom_num"), F.lit(1 << 30)))
    from ..operators.order import global_rank
    return global_rank(keyed, ["_c", "pos", "line"]).drop("_c")


def write_vcf(variants: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Globally sorted VCF text: header file first, then range-sorted body parts."""
    spark = variants.sparkSession
    spark.createDataFrame([(VCF_HEADER,)], "value string").coalesce(1) \
        .write.mode(mode).text(f"{path}/0-header")
    keyed = variants.withColumn("_c", F.coalesce(F.col("chrom_num"), F.lit(1 << 30)))
    keyed.orderBy("_c", "pos", "line").select(F.col("line").alias("value")) \
        .write.mode(mode).text(f"{path}/1-body")


# --- BED / interval lists ------------------------------------------------------------

BED_SCHEMA = "ref_name string, start0 int, end0 int, name string"


def read_bed(spark: SparkSession, path: str) -> DataFrame:
    return (spark.read.option("sep", "\t").option("comment", "#").schema(BED_SCHEMA).csv(path))


def bed_lines(ranges: DataFrame, compat: bool = False) -> DataFrame:
    """1-based inclusive ranges (``ref_name, start, end``) -> BED text.

    BED is 0-based half-open: (start-1, end). ``compat=True`` writes
    (start-1, end-1) as the original region writer did.
    """
    end = F.col("end") - 1 if compat else F.col("end")
    return ranges.select(F.concat_ws("\t", "ref_name", (F.col("start") - 1).cast("string"),
                                     end.cast("string")).alias("value"))


def picard_interval_lines(ranges: DataFrame) -> DataFrame:
    """``name:start-end`` (1-based inclusive) per range."""
    return ranges.select(F.format_string("%s:%d-%d", "ref_name", "start", "end").alias("value"))


def write_text(lines: DataFrame, path: str, mode: str = "overwrite") -> None:
    lines.select("value").write.mode(mode).text(path)


# --- columnar read store ----------------------------------------------------------------

def write_reads_columnar(reads: DataFrame, path: str, mode: str = "overwrite",
                         records_per_file: int = 2_000_000, num_partitions: int | None = None) -> None:
    """Coordinate-sorted Parquet store partitioned by contig.

    ``repartitionByRange`` on (ref_index, pos, qname) balances files even when
    one contig or one position dominates, ``sortWithinPartitions`` keeps
    row-group min/max on ``pos`` tight, so region filters prune partitions and
    row groups (the role of a BAM index). The range count defaults to the
    session's shuffle partitions; pass ``num_partitions`` sized to the data
    (about 1 GB of reads per range) for very large inputs.
    """
    spark = reads.sparkSession
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    (reads.repartitionByRange(n, "ref_index", "pos", "qname")
     .sortWithinPartitions("ref_index", "pos")
     .write.mode(mode).option("maxRecordsPerFile", records_per_file)
     .partitionBy("ref_index").parquet(path))


def limit_records(reads: DataFrame, n: int, order: list[str]) -> DataFrame:
    """First ``n`` records in a declared order (top-k, not a full sort)."""
    return reads.orderBy(*order).limit(n)

