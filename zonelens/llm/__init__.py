"""Training-data operators: near-duplicate groups, toxicity, source mixing, license scans,
quality rules, URL filters, line and span dedup, token counts, decontamination.

Nothing else in the library imports this subpackage.  Each operator is a module of its own;
``queries`` registers one query per operator over the driver tables."""
