"""Operators of a training-data pipeline: sharding, near-duplicate join, page extraction,
quality, language-model scoring, language identification, mixing, exact search, substring
removal, benchmark decontamination, token counts, centroid clustering and hard negatives.
Nothing else in the library imports this package."""
