"""The publication job: fetched pages to records, merged into the corpus, indexed anew."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marlstone.operators import corpus, search
from marlstone.session import settle
from marlstone.sources import pages


def extract(page_table: DataFrame, organisation: str | None = None) -> DataFrame:
    """Titled records of a page table, tagged with an organisation; ``seq`` is the page number."""
    found = corpus.titled(pages.publications(pages.page_facts(page_table)))
    if organisation:
        found = found.withColumn("organisations", F.array(F.lit(organisation)))
    return found.withColumnRenamed("page_id", "seq")


def update(old: DataFrame, page_table: DataFrame, organisation: str | None = None) -> DataFrame:
    """The corpus after merging newly fetched pages."""
    # The merge reads the new records more than once; pages are parsed once.
    return corpus.merge(old, settle(extract(page_table, organisation).select(*old.columns)))


def reindex(records: DataFrame, path: str, seq: str = "seq") -> search.Index:
    """Documents and index tables of a corpus, written to ``path``."""
    return search.save_index(search.build_index(search.build_documents(records, seq)), path)
