"""helixdf: sequencing-read analytics as Spark DataFrame jobs.

Subpackages:
  functions  column expressions (flags, CIGAR, coordinates, bases, tags)
  operators  DataFrame -> DataFrame operators (filters, joins, ranks, stats, ...)
  sources    text sources and sinks (SAM, header, dictionary, FASTQ, VCF, BED)
  streaming  the stateless SAM parse on Structured Streaming
  plans      named queries paired with DuckDB oracle SQL
"""

__version__ = "0.1.0"
