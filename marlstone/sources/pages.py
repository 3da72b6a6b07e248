"""Stored pages to records: parsing on Arrow batches, choices as column expressions."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from marlstone.functions import text
from marlstone.sources import html as H

FACTS = (
    "page_id bigint, url string, h1 string, title_tag string, page_text string, abstract_block string, "
    "meta_title string, meta_og_title string, meta_date string, meta_abstract string, "
    "meta_authors array<string>, "
    "anchors array<struct<href:string,label:string,title:string,aria:string>>"
)
PERSONS, PUBLICATIONS = "/en/persons/", "/en/publications/"


#: Pages whose pieces a task holds at once.
PARSED = 100


def _parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for k in range(0, len(batch), PARSED):
            part = batch.iloc[k:k + PARSED]
            found = pd.DataFrame([H.facts(page) for page in part["html"]], index=part.index)
            found.insert(0, "url", part["url"])
            found.insert(0, "page_id", part["page_id"])
            yield found


def page_facts(pages: DataFrame) -> DataFrame:
    """Parse every page once; each later choice reads this table."""
    return pages.select(F.col("page_id").cast("bigint"), "url", "html").mapInPandas(_parse, FACTS)


def links(facts: DataFrame) -> DataFrame:
    """Every link of a page in order, absolute: (page_id, url, pos, link)."""
    rows = facts.select("page_id", "url", F.posexplode("anchors").alias("pos", "a"))
    rows = rows.filter((F.col("a.href") != "") & ~F.col("a.href").startswith("#"))
    return rows.select("page_id", "url", "pos", text.absolute_url("url", "a.href").alias("link"))


def _first_filled(*parts: Column | str) -> Column:
    return F.coalesce(*[F.nullif(F.col(p) if isinstance(p, str) else p, F.lit("")) for p in parts], F.lit(""))


def publications(facts: DataFrame) -> DataFrame:
    """One record per page: title, year, authors with links, abstract, no organisations."""
    year = _first_filled(text.first_year("page_text"), text.first_year("meta_date"))

    people = F.filter(
        "anchors",
        lambda a: F.contains(a["href"], F.lit(PERSONS))
        & (F.lower(a["label"]) != "profiles") & (a["label"] != "") & ~a["href"].endswith(PERSONS),
    )
    named = F.transform(people, lambda a: F.struct(a["label"].alias("name"), text.absolute_url(F.col("url"), a["href"]).alias("url")))
    meta = F.transform(
        F.filter("meta_authors", lambda m: (m != "") & (F.lower(m) != "profiles")),
        lambda m: F.struct(m.alias("name"), F.lit("").alias("url")),
    )
    chosen = F.when(F.size(named) > 0, named).otherwise(meta)
    return (
        facts.withColumn("_found", chosen)
        .withColumn("authors", F.array_distinct(F.transform("_found", lambda a: a["name"])))
        .select(
            "page_id",
            F.col("url").alias("publication_url"),
            _first_filled("h1", "meta_title", "meta_og_title", "title_tag").alias("title"),
            year.alias("year"),
            "authors",
            # The link of a name is that of its first appearance.
            F.transform(
                "authors", lambda n: F.element_at(F.filter("_found", lambda a: a["name"] == n), 1)
            ).alias("author_links"),
            _first_filled("abstract_block", "meta_abstract").alias("abstract"),
            F.array().cast("array<string>").alias("organisations"),
        )
    )


def listed_publications(facts: DataFrame) -> DataFrame:
    """(page_id, pos, title, publication_url) of list pages; the first titled anchor per URL counts."""
    rows = facts.select("page_id", "url", F.posexplode("anchors").alias("pos", "a"))
    rows = rows.filter(F.contains(F.col("a.href"), F.lit(PUBLICATIONS)))
    rows = rows.select(
        "page_id", "pos", _first_filled("a.label", "a.title", "a.aria").alias("title"),
        text.absolute_url("url", "a.href").alias("publication_url"),
    ).filter((F.length("title") >= 4) & F.contains("publication_url", F.lit(PUBLICATIONS)))
    order = Window.partitionBy("page_id", "publication_url").orderBy("pos")
    return rows.withColumn("_rn", F.row_number().over(order)).filter("_rn = 1").drop("_rn")


def distinct_people(people: Column) -> tuple[Column, Column]:
    """Names without repeats in first-seen order, and the structs kept in step."""
    names = F.array_distinct(F.transform(people, lambda a: a["name"]))
    return names, F.transform(names, lambda n: F.element_at(F.filter(people, lambda a: a["name"] == n), 1))
