"""pubwatch: publication monitoring as Spark jobs.

Landed pages of article metadata and a journal registry go in; a deduplicated archive with
dashboard queries and a periodic, linked digest come out. Everything takes and returns DataFrames.
"""

from pubwatch.params import RunParams

__all__ = ["RunParams"]
