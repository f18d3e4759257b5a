"""tabsmith: rule-driven table building and checking on Spark DataFrames.

Subpackages
-----------
functions   column expressions (draws, check digits, working-time math, text rules)
sources     driver tables, lookup dictionaries, row source, sinks
operators   DataFrame -> DataFrame operators (draws, derivations, keyed rules,
            quality rules, profiles) and the prefix-sum / skew helpers they share
plans       assembled jobs (visit table) and the catalogue of bound queries
streaming   Structured Streaming forms of the keyed rules
"""

__version__ = "0.1.0"
