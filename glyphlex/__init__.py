"""glyphlex: Spark table jobs for text that mixes words with pictographic symbols.

Layout
------
functions/  Column -> Column expressions (native Catalyst, no Python per row)
operators/  DataFrame -> DataFrame jobs (joins, aggregations, windows, Arrow stages)
sources/    readers and writers (TSV, JSON dictionaries, XML annotations, candidate sets)
plans/      end-to-end jobs and the fixtures built over the driver tables
streaming/  the stateless rewrites applied to a Structured Streaming source
"""

__version__ = "0.1.0"
