"""Read-shaped fixture tables derived from the driver's parquet tables.

The SQL text is used verbatim by both engines: as temp views in Spark and as
CTEs in the DuckDB oracle. Each table scales with the scale factor of the
driver tables it reads (except ``contigs``, the 25-row sequence dictionary).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

DRIVER_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
                 "events", "documents", "embeddings", "pages", "benchmark", "labels",
                 "conversations")

_ID = ("concat(cast(l_orderkey as varchar(20)),'_',cast(l_partkey as varchar(20)),'_',"
       "cast(l_suppkey as varchar(20)),'_',cast(l_linenumber as varchar(20)))")

# The hg19 primary sequence dictionary (index, name, length).
CONTIGS_SQL = """select cast(ref_index as int) as ref_index, ref_name, cast(length as bigint) as length from (values
(0,'chrM',16571), (1,'chr1',249250621), (2,'chr2',243199373), (3,'chr3',198022430),
(4,'chr4',191154276), (5,'chr5',180915260), (6,'chr6',171115067), (7,'chr7',159138663),
(8,'chr8',146364022), (9,'chr9',141213431), (10,'chr10',135534747), (11,'chr11',135006516),
(12,'chr12',133851895), (13,'chr13',115169878), (14,'chr14',107349540), (15,'chr15',102531392),
(16,'chr16',90354753), (17,'chr17',81195210), (18,'chr18',78077248), (19,'chr19',59128983),
(20,'chr20',63025520), (21,'chr21',48129895), (22,'chr22',51304566), (23,'chrX',155270560),
(24,'chrY',59373566)) t(ref_index, ref_name, length)"""

READS_SQL = f"""select concat('r', {_ID}) as qname,
 cast(case when l_suppkey % 27 = 26 then 4 when l_linenumber % 2 = 0 then 99 + 48*(l_partkey % 2) else 16*(l_partkey % 2) end as int) as flag,
 cast(case when l_suppkey % 27 = 26 then -1 else l_suppkey % 27 end as int) as ref_index,
 cast(case when l_suppkey % 27 = 26 then 0 else 1 + l_partkey*97 + l_orderkey*13 end as int) as pos,
 cast(case when l_suppkey % 27 = 26 then 0 else l_quantity end as int) as mapq,
 case when l_suppkey % 27 = 26 then '*' else case l_linenumber % 7 when 0 then '32M' when 1 then '4S28M'
   when 2 then '10M2I20M' when 3 then '10M3D22M' when 4 then '28M4S' when 5 then '5H12M100N20M' else '3S10M1D10M1I8M' end end as cigar,
 translate(md5(concat('b', {_ID})),'0123456789abcdef','ACGTACGTACGTACGN') as seq,
 translate(md5(concat('q', {_ID})),'0123456789abcdef','!+5:?ABCDEFGHIJ#') as qual
from lineitem"""

# Reads with an MD tag (own literals whose lengths fit each CIGAR).
READS_MD_SQL = f"""select concat('r', {_ID}) as qname,
 cast(case when l_suppkey % 27 = 26 then -1 else l_suppkey % 27 end as int) as ref_index,
 cast(case when l_suppkey % 27 = 26 then 0 else 1 + l_partkey*97 + l_orderkey*13 end as int) as pos,
 case when l_suppkey % 27 = 26 then '*' else case l_linenumber % 7 when 0 then '32M' when 1 then '4S28M'
   when 2 then '10M2I20M' when 3 then '10M3D22M' when 4 then '28M4S' when 5 then '5H12M100N20M' else '3S10M1D10M1I8M' end end as cigar,
 case l_linenumber % 7 when 0 then '10A21' when 1 then '5C22' when 2 then '30' when 3 then '10^ACG22' when 4 then '27T0' when 5 then '12G19' else '10^T0A17' end as md
from lineitem where l_suppkey % 27 <> 26"""

PAIRS_SQL = """select concat('p',cast(o_orderkey as varchar(20))) as qname, cast(case e when 1 then 99 else 147 end as int) as flag,
 cast(1 + o_custkey % 24 as int) as ref_index,
 cast(1 + o_custkey*61 + (case e when 1 then 0 else 150 end) as int) as pos,
 cast(1 + o_custkey*61 + (case e when 1 then 150 else 0 end) as int) as mate_pos,
 cast(case e when 1 then 182 else -182 end as int) as isize, '32M' as cigar,
 translate(md5(concat('q',cast(o_orderkey as varchar(20)),'/',cast(e as varchar(20)))),'0123456789abcdef','!+5:?ABCDEFGHIJ#') as qual
from orders cross join (select 1 as e union all select 2 as e) x"""

TARGETS_SQL = """select cast(1 + p_partkey % 24 as int) as ref_index, cast((p_partkey*193) as int) as start0,
 cast(p_partkey*193 + 20*(1+p_size) as int) as end0, p_brand as name from part"""

SAM_LINES_SQL = """select concat_ws(chr(9), r.qname, cast(r.flag as varchar(20)), coalesce(c.ref_name,'*'), cast(r.pos as varchar(20)),
 cast(r.mapq as varchar(20)), r.cigar, '*', '0', '0', r.seq, r.qual, 'RG:Z:GROUP1',
 concat('NM:i:', cast(r.mapq % 4 as varchar(20)))) as value
from reads r left join contigs c on r.ref_index = c.ref_index"""

VCF_LINES_SQL = """select concat_ws(chr(9), concat('chr', case p_partkey % 24 when 22 then 'X' when 23 then 'Y' else cast(1 + p_partkey % 24 as varchar(20)) end),
 cast(1 + p_partkey*193 as varchar(20)), '.', substr('ACGT', cast(1 + p_partkey % 4 as int), 1),
 substr('CGTA', cast(1 + p_partkey % 4 as int), 1), cast(30 + p_size as varchar(20)), 'PASS', '.', 'GT', '0/1') as value from part"""

REF_TILES_SQL = """select distinct ref_index, tile, translate(md5(concat('g',cast(ref_index as varchar(20)),'-',cast(tile as varchar(20)))),'0123456789abcdef','ACGTACGTACGTACGT') as bases
from (select ref_index, cast(((pos - 1) >> 5) + k as int) as tile from reads cross join
 (select 0 as k union all select 1 union all select 2 union all select 3 union all select 4 union all select 5) x where ref_index >= 0) y"""

# SAM header lines (ord = line order) with deliberate defects: missing SM,
# non-numeric PI, a clashing duplicate LB, a field without ':', an unknown type.
HEADER_LINES_SQL = """select cast(0 as bigint) as ord, concat_ws(chr(9), '@HD', 'VN:1.0', 'SO:coordinate') as value
union all select cast(1 + ref_index as bigint) as ord, concat_ws(chr(9), '@SQ', concat('SN:', ref_name), concat('LN:', cast(length as varchar(20)))) as value from contigs
union all select cast(100 + s_suppkey as bigint) as ord, concat_ws(chr(9), '@RG', concat('ID:rg', cast(s_suppkey as varchar(20))),
 case when s_suppkey % 11 = 5 then 'DS:none' else concat('SM:', s_name) end,
 concat('LB:lib', cast(s_nationkey as varchar(20))),
 case when s_suppkey % 7 = 3 then 'PI:abc' else concat('PI:', cast(200 + s_suppkey as varchar(20))) end,
 case when s_suppkey % 13 = 4 then 'LB:other' when s_suppkey % 13 = 8 then concat('LB:lib', cast(s_nationkey as varchar(20))) else 'PL:ILLUMINA' end,
 case when s_suppkey % 9 = 2 then 'DS:a:b:c' else 'CN:center' end,
 case when s_suppkey % 17 = 6 then 'badfield' else 'PU:unit' end) as value from supplier
union all select cast(100000000 + s_suppkey as bigint) as ord, concat_ws(chr(9), '@CO', concat('supplier ', s_name)) as value from supplier where s_suppkey % 5 = 0
union all select cast(200000000 as bigint) as ord, concat_ws(chr(9), '@PG', 'ID:bwa', 'PN:bwa', 'VN:0.7.10') as value
union all select cast(200000001 as bigint) as ord, concat_ws(chr(9), '@XX', 'ID:1') as value"""

# Reads with rule-breaking variants chosen by position (validation input).
VREADS_SQL = """select r.qname,
 cast(case r.pos % 11 when 1 then r.flag | 2 when 2 then r.flag | 8 when 3 then r.flag | 32 when 4 then r.flag | 64
   when 5 then r.flag | 128 when 6 then r.flag | 256 when 7 then r.flag & 3903 when 8 then r.flag | 260 else r.flag end as int) as flag,
 r.ref_index, r.pos,
 cast(case when r.pos % 5 = 0 and r.pos > 0 then r.mapq * 7 when r.ref_index = -1 and length(r.qname) % 2 = 0 then 3 else r.mapq end as int) as mapq,
 case r.pos % 9 when 0 then r.cigar when 1 then '0M' when 2 then '5S10M' when 3 then '5M5S5M' when 4 then '3H2S10M2S3H'
   when 5 then '10M2D2D10M' when 6 then '2P10M' when 7 then '10M2P' else '10M1I1P1I10M' end as cigar,
 case when r.pos % 17 = 0 and r.pos > 0 then '' else r.seq end as seq,
 case when r.pos % 13 = 0 and r.pos > 0 then substr(r.qual, 1, 31) else r.qual end as qual,
 cast(-1 as int) as mate_ref_index, cast(0 as int) as mate_pos,
 cast(case when r.pos % 19 = 0 and r.pos > 0 then 536870913 else 0 end as int) as isize,
 c.length as ref_length, cast(null as bigint) as mate_ref_length
from reads r left join contigs c on c.ref_index = r.ref_index"""

# SAM lines with text defects chosen by the line's md5 (validation input).
VLINES_SQL = """select case when substr(md5(value), 1, 1) = '0' then regexp_extract(value, '^(?:[^\t]*\t){8}[^\t]*', 0)
 when substr(md5(value), 1, 1) = '1' then replace(value, concat(chr(9), '*', chr(9), '0', chr(9), '0', chr(9)), concat(chr(9), '=', chr(9), '0', chr(9), '0', chr(9)))
 when substr(md5(value), 1, 1) = '2' then replace(value, 'A', 'Z')
 when substr(md5(value), 1, 1) = '3' then replace(value, concat(chr(9), 'RG:Z'), concat(chr(9), chr(9), 'RG:Z'))
 else value end as value from sam_lines"""

# Read pairs with mate defects: a missing mate, a strand clash, a moved mate, two first ends.
VPAIRS_SQL = """select qname, flag, ref_index, pos, ref_index as mate_ref_index, mate_pos from (
 select concat('p', cast(o_orderkey as varchar(20))) as qname,
  cast(case when e = 1 then 99 when o_orderkey % 41 = 0 then 131 when o_orderkey % 47 = 0 then 83 else 147 end as int) as flag,
  cast(1 + o_custkey % 24 as int) as ref_index,
  cast(1 + o_custkey*61 + (case e when 1 then 0 else 150 + (case when o_orderkey % 43 = 0 then 1 else 0 end) end) as int) as pos,
  cast(1 + o_custkey*61 + (case e when 1 then 150 else 0 end) as int) as mate_pos, e, o_orderkey
 from orders cross join (select 1 as e union all select 2 as e) x) y
where not (e = 2 and o_orderkey % 37 = 0)"""

# SAM lines with broken numbers, unknown contigs and broken (or odd, yet right) tags, chosen by the line's md5.
_H = "substr(md5(value), 1, 2)"
_FIELD = {i: f"split_part(value, chr(9), {i})" for i in range(1, 14)}
TLINES_SQL = f"""select concat_ws(chr(9), {_FIELD[1]}, case {_H} when '00' then 'x1' else {_FIELD[2]} end,
 case {_H} when '06' then 'chrNope' when '07' then '=' when '0a' then concat({_FIELD[3]}, ' alt') else {_FIELD[3]} end,
 case {_H} when '01' then '12.5' when '03' then '99999999999' else {_FIELD[4]} end,
 case {_H} when '02' then ' 7' else {_FIELD[5]} end, {_FIELD[6]},
 case {_H} when '08' then 'chrNope' when '09' then '=' else {_FIELD[7]} end,
 case {_H} when '04' then '1e3' else {_FIELD[8]} end, case {_H} when '05' then '--1' else {_FIELD[9]} end,
 {_FIELD[10]}, {_FIELD[11]}, {_FIELD[12]},
 case {_H} when '10' then 'NM:i' when '11' then 'NM:i:x' when '12' then 'NM:i:3000000000' when '13' then 'XA:A:ab' when '14' then 'XF:f:1.5.2'
  when '15' then 'XF:f:-1e5' when '16' then 'XH:H:1AG' when '17' then 'XH:H:1A2' when '18' then 'XH:H:1a2B' when '19' then 'XB:B:c'
  when '1a' then 'XB:B:c,1,200' when '1b' then 'XB:B:q,1' when '1c' then 'XB:B:f,1,x' when '1d' then 'XB:B:I,4294967295' when '1e' then 'XQ:q:1'
  when '1f' then 'XZ:Z:a:b' when '20' then 'XB:B:s,' when '21' then 'XB:B:C,1,-1' when '22' then 'XA:A:' when '23' then 'NM:i: 1'
  else {_FIELD[13]} end) as value from sam_lines"""

# Pairs, each name with one case of the mate search: a missing mate, a second mate at its place, an
# unpaired record there, an unclear end, an unpaired read alone, mates without a contig.
MPAIRS_SQL = """select concat('p', cast(o_orderkey as varchar(20))) as qname,
 cast(case when o_orderkey % 13 = 4 and e = 1 then 1 when o_orderkey % 13 = 5 and e = 2 then 193 when o_orderkey % 13 = 6 and e = 2 then 16
  when o_orderkey % 13 = 7 then 16 when e = 1 then 99 when e = 2 then 147 when o_orderkey % 13 = 2 then 163 else 0 end as int) as flag,
 cast(case when o_orderkey % 13 = 8 then -1 else 1 + o_custkey % 24 end as int) as ref_index,
 cast(1 + o_custkey*61 + (case e when 1 then 0 else 150 end) as int) as pos,
 cast(case when o_orderkey % 13 = 8 then -1 else 1 + o_custkey % 24 end as int) as mate_ref_index,
 cast(case when o_orderkey % 13 = 8 then 0 else 1 + o_custkey*61 + (case e when 1 then 150 else 0 end) end as int) as mate_pos
from orders cross join (select 1 as e union all select 2 as e union all select 3 as e) x
where not (e = 2 and o_orderkey % 13 = 1) and (e < 3 or o_orderkey % 13 in (2, 3))"""

# name -> (sql, dependencies on other fixtures)
FIXTURES: dict[str, tuple[str, tuple[str, ...]]] = {
    "contigs": (CONTIGS_SQL, ()),
    "reads": (READS_SQL, ()),
    "reads_md": (READS_MD_SQL, ()),
    "pairs": (PAIRS_SQL, ()),
    "targets": (TARGETS_SQL, ()),
    "sam_lines": (SAM_LINES_SQL, ("reads", "contigs")),
    "vcf_lines": (VCF_LINES_SQL, ()),
    "ref_tiles": (REF_TILES_SQL, ("reads",)),
    "header_lines": (HEADER_LINES_SQL, ("contigs",)),
    "vreads": (VREADS_SQL, ("reads", "contigs")),
    "vlines": (VLINES_SQL, ("sam_lines",)),
    "vpairs": (VPAIRS_SQL, ()),
    "tlines": (TLINES_SQL, ("sam_lines",)),
    "mpairs": (MPAIRS_SQL, ()),
}


# Spark's form of a fixture whose plain SQL does not scale: the same rows and types. The tiles that
# reads touch are first united as bits, 64 tiles to a row, and written out once each.
SPARK_SQL = {"ref_tiles": """select ref_index, tile, translate(md5(concat('g',cast(ref_index as varchar(20)),'-',cast(tile as varchar(20)))),'0123456789abcdef','ACGTACGTACGTACGT') as bases
from (select ref_index, cast((word << 6) + bit as int) as tile from
 (select ref_index, word, bit_or(bits) as bits from
  (select ref_index, word, aggregate(sequence(greatest(first, word << 6), least(first + 5, (word << 6) + 63)), 0L, (a, t) -> a | shiftleft(1L, t & 63)) as bits
   from (select ref_index, (pos - 1) >> 5 as first, explode(sequence(((pos - 1) >> 5) >> 6, (((pos - 1) >> 5) + 5) >> 6)) as word from reads where ref_index >= 0))
  group by ref_index, word)
 lateral view explode(sequence(0, 63)) b as bit where (bits >> bit) & 1 = 1)"""}


def _closure(names) -> list[str]:
    out: list[str] = []

    def visit(n):
        for d in FIXTURES[n][1]:
            visit(d)
        if n not in out:
            out.append(n)

    for n in names:
        visit(n)
    return out


def with_clause(*names: str) -> str:
    """``WITH`` prefix defining the given fixtures (and their inputs) as CTEs."""
    parts = [f"{n} as ({FIXTURES[n][0]})" for n in _closure(names)]
    return "with " + ",\n".join(parts) + "\n"


class Fixtures:
    """Fixture DataFrames over one scale-factor folder, built lazily.

    Driver tables are registered as temp views and each fixture is built with
    its SQL text. DataFrames are analysed eagerly, so a later registration for
    another folder does not change fixtures already handed out.
    """

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")
        self._cache: dict[str, DataFrame] = dict(_STORED.get(self.sf_dir, {}))

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_") or name not in FIXTURES:
            raise AttributeError(name)
        return self.get(name)

    def get(self, name: str) -> DataFrame:
        if name not in self._cache:
            for dep in _closure([name]):
                if dep in self._cache:
                    self._cache[dep].createOrReplaceTempView(dep)
                    continue
                sql, _ = FIXTURES[dep]
                for t in DRIVER_TABLES:
                    if t in sql:
                        self.table(t).createOrReplaceTempView(t)
                df = self.spark.sql(SPARK_SQL.get(dep, sql))
                df.createOrReplaceTempView(dep)
                self._cache[dep] = df
        return self._cache[name]


def load(spark: SparkSession, sf_dir: str) -> Fixtures:
    return Fixtures(spark, sf_dir)


# Fixtures written once to the checkpoint folder (benchmarks: the read tables
# then behave like stored Parquet tables instead of being re-derived per query).
_STORED: dict[str, dict[str, DataFrame]] = {}


def store(spark: SparkSession, sf_dir: str, names=tuple(FIXTURES)) -> None:
    """Write fixtures for ``sf_dir`` as Parquet under the session's checkpoint
    folder; later ``load`` calls for the folder read them back (results are
    unchanged)."""
    from .session import scratch_path
    key = sf_dir.rstrip("/")
    f = Fixtures(spark, key)
    stored = _STORED.setdefault(key, {})
    for n in _closure(list(names)):
        if n in stored:
            continue
        path = scratch_path(spark, f"fixture-{n}.parquet")
        f.get(n).write.parquet(path)
        df = spark.read.parquet(path)
        f._cache[n] = df
        df.createOrReplaceTempView(n)
        stored[n] = df
