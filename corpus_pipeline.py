"""Corpus pipeline: quality rules, line dedup, near-duplicate removal, decontamination, mixing.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet to
the shared folder and read back as the next one's ``docs``."""
from __future__ import annotations

from zonelens.llm import decontam, linededup, mixing, quality, simhash
from zonelens.llm.common import read, stored


def quality_rules(spark, docs, sf_dir):
    """Operator 5: rejected documents go."""
    return quality.passing(docs, "base", "v2")


def line_dedup(spark, docs, sf_dir):
    """Operator 7: cross-site boilerplate lines go, those of one to three words too, every document stays."""
    return linededup.strip_boilerplate(docs, min_words=1, counts=False)


def near_duplicates(spark, docs, sf_dir):
    """Operator 1: one document of each group stays."""
    return simhash.keep_one(docs)


def decontamination(spark, docs, sf_dir):
    """Operator 10: documents that hold a benchmark item go."""
    return decontam.drop_contaminated(docs, read(spark, sf_dir, "benchmark"))


def mix_sources(spark, docs, sf_dir):
    """Operator 3: documents that the mix takes, with the number of copies."""
    _, cuts = mixing.mix(docs)
    return mixing.apply_cuts(docs, cuts).filter("copies > 0")


STAGES = [("quality rules", quality_rules), ("line dedup", line_dedup), ("near duplicates", near_duplicates),
          ("decontamination", decontamination), ("mixing", mix_sources)]

#: SQL expresses neither SimHash nor Myers' distance: tested against brute force instead.
ORACLE_SQL = None


def run(spark, sf_dir):
    docs = read(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{k}")
    return docs
