"""Training-data operators: extraction, scoring, near duplicates, scans,
mixing, sharding and benchmark decontamination.

Nothing else in the library imports this subpackage; ``__spark_entry__``
adds its queries when it is present.
"""
