"""loam: soil survey rollups (horizon -> component -> map unit) on Spark DataFrames.

Every operator is a plain function ``DataFrame(s) + parameters -> DataFrame``
built from Spark SQL expressions, so Catalyst plans the whole rollup for all
survey areas at once.
"""

__version__ = "0.1.0"
