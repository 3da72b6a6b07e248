"""Corpus upkeep and page extraction."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.views import table, view, with_views
from marlstone.functions import text
from marlstone.operators import corpus
from marlstone.session import settle
from marlstone.sources import pages

PREFIX = "http://pub.example.org/en/publications/"


def publications(s, d):
    return view(s, d, "publications").select(
        "publication_url", "seq", "title", "year", "abstract", "authors", "organisations",
        F.array(F.struct(F.col("author").alias("name"), F.lit("").alias("url"))).alias("author_links"),
    )


def old_and_new(s, d):
    """Old: two thirds of the records. New: every second one, with a new title, and every tenth twice."""
    pubs = publications(s, d).select("publication_url", "seq", "title", "year", "abstract", "organisations")
    old = pubs.filter("seq % 3 <> 0")
    changed = pubs.filter("seq % 2 = 0").withColumn("title", F.concat(F.lit("New "), "title"))
    changed = changed.withColumn("abstract", F.when(F.col("seq") % 4 == 0, F.lit("")).otherwise(F.col("abstract")))
    changed = changed.withColumn("year", F.when(F.col("seq") % 6 == 0, F.lit(None)).otherwise(F.col("year")))
    again = pubs.filter("seq % 10 = 0").select(
        "publication_url", (F.col("seq") + 1000000000).alias("seq"), F.lit(None).cast("string").alias("title"),
        F.lit("2099").alias("year"), "abstract", F.array(F.lit("zz"), F.lit("aa")).alias("organisations"),
    )
    return old, changed.unionByName(again)


def _flat(df):
    return df.withColumns({"organisations": F.array_join("organisations", ","), "abstract": F.md5("abstract")})


def facts(s, d, folder=None):
    """Parsed pages; ``folder`` moves the site links below a folder, as portal pages have them."""
    stored = table(s, d, "pages")
    if folder:
        stored = stored.withColumn("html", F.replace("html", F.lit('<a href="/'), F.lit(f'<a href="{folder}')))
    return pages.page_facts(stored)


def urls(s, d):
    return publications(s, d).select(F.col("publication_url").alias("url"), F.col("seq").alias("pos"))


def _refreshed(s, d, limit=None):
    pubs = publications(s, d).drop("organisations").withColumn("abstract", F.when(F.col("seq") % 4 > 0, F.col("abstract")).otherwise(""))
    fresh = publications(s, d).filter("seq % 5 < 3").select(
        "publication_url", F.when(F.col("seq") % 5 == 0, F.lit("short")).otherwise(F.col("abstract")).alias("abstract"),
        F.when(F.col("seq") % 5 == 1, F.array(F.lit("someone"))).otherwise(F.col("authors")).alias("authors"), "author_links",
    )
    return corpus.refresh(pubs, fresh, limit).select(
        "seq", "changed", F.md5("abstract").alias("abstract"), F.array_join("authors", ",").alias("authors")
    ).withColumn("changed", F.col("changed").cast("int"))


QUERIES = {
    "x7_first_year": lambda s, d: table(s, d, "documents").select("doc_id", text.first_year("text").alias("year")),
    "x8_slug": lambda s, d: publications(s, d).select("seq", text.slug("title").alias("slug"), text.slug("title", 50).alias("slug_50"), text.slug("title", 65).alias("slug_65"), text.slug("title", 70).alias("slug_70")),
    "x9_x10_repaired_urls": lambda s, d: corpus.repair_urls(publications(s, d), PREFIX, 50).select(
        "seq", "publication_url", "original_url", F.col("matches").cast("int").alias("matches")
    ),
    "x9_repair_count": lambda s, d: corpus.repair_count(corpus.repair_urls(publications(s, d), PREFIX, 50)),
    "j8_merge": lambda s, d: _flat(corpus.merge(*old_and_new(s, d))),
    "j8_merge_fixed_tag": lambda s, d: _flat(corpus.merge(*old_and_new(s, d), fixed_tag="ORG")).select("publication_url", "organisations"),
    "j9_replace_records": lambda s, d: corpus.replace_records(*old_and_new(s, d)).select("publication_url", "seq", "title", "year"),
    "wn6_last_record": lambda s, d: corpus.last_record(old_and_new(s, d)[1]).select("publication_url", "seq", "year"),
    "st4_union_distinct": lambda s, d: corpus.union_distinct(*[p.select("publication_url") for p in old_and_new(s, d)]),
    "st5_array_union": lambda s, d: publications(s, d).select(
        "seq", F.array_join(F.array_sort(F.array_union("organisations", F.array(F.lit("en"), F.lit("ORG")))), ",").alias("tags")
    ),
    "st6_distinct_people": lambda s, d: table(s, d, "documents").select("doc_id", pages.distinct_people(
        F.array(*[F.struct(F.col(c).alias("name"), F.lit(u).alias("url")) for c, u in (("lang", "a"), ("source", "b"), ("lang", "c"))])
    )[1].alias("p")).select("doc_id", F.array_join(F.transform("p", lambda a: F.concat(a["name"], a["url"])), ",").alias("people")),
    "ag1_year_counts": lambda s, d: corpus.year_counts(publications(s, d)),
    "j10_year_gaps": lambda s, d: corpus.year_gaps(publications(s, d), target=59),
    "pf15_needs_refresh": lambda s, d: publications(s, d).select("seq", corpus.needs_refresh().cast("int").alias("due")),
    "pf22_refresh": _refreshed,
    "pf22_refresh_limited": lambda s, d: _refreshed(s, d, 25),
    "pf16_titled": lambda s, d: corpus.titled(corpus.keyed(publications(s, d).withColumn("title", F.when(F.col("seq") % 4 > 0, F.col("title")).otherwise("")))).select("seq", "title"),
    "pf17_same_host_links": lambda s, d: table(s, d, "pages").select("page_id", text.host("url").alias("host")).filter(
        text.host(F.concat(F.lit("https://u@"), "host", F.lit(":8080/x"))) == F.col("host")
    ),
    "sl7_newest": lambda s, d: corpus.newest(urls(s, d), 300),
    "sl8_newest_and_sample": lambda s, d: corpus.newest_and_sample(urls(s, d), 100, 100, 42),
    "x13_absolute_url": lambda s, d: table(s, d, "pages").select(
        "page_id", *[text.absolute_url("url", F.lit(h)).alias(n) for n, h in
                     (("full", "http://a.b/c"), ("scheme", "//h/x"), ("rooted", "/r/s"), ("stepping", "/r/../s/./t/..?u#v"), ("query", "?q=1"), ("relative", "n/m"),
                      ("climbing", "a/b/c/d/e/f/../../../../../../x"), ("beyond", "../../../../../../../x/./y?z=../w"), ("mixed", "./a/./../b/../c/."))]
    ),
    "x15_augment": lambda s, d: corpus.augment(publications(s, d).select("publication_url", "title", "year"), 500, 42),
    "hx1_links": lambda s, d: pages.links(facts(s, d)).select("page_id", "pos", "link"),
    "hx2_titles": lambda s, d: pages.publications(facts(s, d)).select("page_id", "title"),
    "hx3_hx5_publications": lambda s, d: pages.publications(facts(s, d)).select(
        "page_id", "publication_url", "title", "year", F.size("authors").alias("authors"), "abstract"
    ),
    "hx1_link_counts": lambda s, d: pages.links(facts(s, d)).groupBy("page_id").agg(F.count("*").alias("links")),
    "hx4_people": lambda s, d: pages.publications(facts(s, d, "/en/persons/")).select(
        "page_id", F.array_join(F.array_sort("authors"), ",").alias("authors"), F.size("author_links").alias("links")
    ),
    "hx6_listed_publications": lambda s, d: pages.listed_publications(facts(s, d, "/en/publications/")).select("page_id", "publication_url"),
    "pf17_crawlable_links": lambda s, d: corpus.crawlable_links(
        pages.links(facts(s, d, "/en/organisations/")), "http://example.com/", "link"
    ).unionByName(corpus.crawlable_links(pages.links(facts(s, d, "/en/organisations/")), url="link")).select("page_id", "pos", "link"),
    "hx7_pages_to_corpus": lambda s, d: corpus.merge(
        publications(s, d).select("publication_url", "seq", "title", "year", "abstract", "organisations"),
        settle(corpus.titled(pages.publications(facts(s, d)).select(
            "publication_url", F.col("page_id").alias("seq"), "title", "year", "abstract", F.array(F.lit("ORG")).alias("organisations")
        ))),
    ).select("publication_url", "title", "year", F.array_join("organisations", ",").alias("organisations")),
}


def _p(sql, extra=""):
    return with_views(sql, "publications", extra=extra)


_SIDES = (
    "old AS (SELECT * FROM publications WHERE seq % 3 <> 0), "
    "fresh AS (SELECT publication_url, seq, concat('New ', title) AS title, CASE WHEN seq % 6 = 0 THEN NULL ELSE year END AS year, "
    "CASE WHEN seq % 4 = 0 THEN '' ELSE abstract END AS abstract, [organisation] AS orgs FROM publications WHERE seq % 2 = 0 "
    "UNION ALL SELECT publication_url, seq + 1000000000, NULL, '2099', abstract, ['zz', 'aa'] FROM publications WHERE seq % 10 = 0), "
    "latest AS (SELECT publication_url, arg_max(title, seq) FILTER (title IS NOT NULL) AS title, arg_max(year, seq) FILTER (year IS NOT NULL) AS year, "
    "arg_max(abstract, seq) FILTER (abstract IS NOT NULL) AS abstract, flatten(list(orgs)) AS orgs FROM fresh GROUP BY 1)"
)
_SLUG = "trim(regexp_replace(regexp_replace(translate(lower(title), '‑–—', '---'), '[^\\p{L}\\p{M}\\p{N}_\\s-]', '', 'g'), '[-\\s]+', '-', 'g'), '-')"


def _cut(n):
    return f"CASE WHEN length({_SLUG}) > {n} THEN trim(substr({_SLUG}, 1, {n}), '-') ELSE {_SLUG} END"


_REPAIRED = f"CASE WHEN title <> '' THEN concat('{PREFIX}', {_cut(50)}, '/') ELSE publication_url END"
_REFRESH = (
    "r AS (SELECT seq, CASE WHEN seq % 4 > 0 THEN abstract ELSE '' END AS a, [author] AS au, seq % 5 < 3 AS found, CASE WHEN seq % 5 = 0 THEN 'short' ELSE abstract END AS na, "
    "CASE WHEN seq % 5 = 1 THEN ['someone'] ELSE [author] END AS nau FROM publications), "
    "due AS (SELECT *, found AND length(a) < 500 AS due FROM r), "
    "m AS (SELECT *, due AND length(na) > length(a) AS longer, due AND nau <> au AS other FROM due), "
    "ranked AS (SELECT *, longer OR other AS chg, sum(CAST(longer OR other AS INTEGER)) OVER (ORDER BY seq) AS rk FROM m) "
)


def _refresh_sql(limit):
    keep = f"chg AND rk <= {limit}" if limit else "chg"
    return _p(
        f"SELECT seq, CAST({keep} AS INTEGER) AS changed, md5(CASE WHEN {keep} AND longer THEN na ELSE a END) AS abstract, "
        f"array_to_string(CASE WHEN {keep} AND other THEN nau ELSE au END, ',') AS authors FROM ranked", _REFRESH
    )


_HOST = "regexp_extract(url, '^[a-z]+://([^/?#:]*)', 1)"
_ROOT = "regexp_extract(url, '^([a-z]+://[^/?#]*)', 1)"
_PAGE = "regexp_extract(url, '^([^?#]*)', 1)"

ORACLES = {
    "x7_first_year": "SELECT doc_id, regexp_extract(text, '\\b((19|20)\\d{2})\\b', 1) AS year FROM documents",
    "x8_slug": _p(f"SELECT seq, {_SLUG} AS slug, {_cut(50)} AS slug_50, {_cut(65)} AS slug_65, {_cut(70)} AS slug_70 FROM publications"),
    "x9_x10_repaired_urls": _p(f"SELECT seq, {_REPAIRED} AS publication_url, publication_url AS original_url, CAST({_REPAIRED} = publication_url AS INTEGER) AS matches FROM publications"),
    "x9_repair_count": _p(f"SELECT count(*) FILTER ({_REPAIRED} <> publication_url) AS repaired, count(*) AS records FROM publications"),
    "j8_merge": _p(
        "SELECT coalesce(o.publication_url, l.publication_url) AS publication_url, coalesce(l.title, o.title) AS title, coalesce(l.year, o.year) AS year, "
        "md5(coalesce(l.abstract, o.abstract)) AS abstract, CASE WHEN l.publication_url IS NULL THEN o.organisation ELSE "
        "array_to_string(list_sort(list_distinct(list_concat(CASE WHEN o.organisation IS NULL THEN [] ELSE [o.organisation] END, l.orgs))), ',') END AS organisations "
        "FROM old o FULL JOIN latest l ON o.publication_url = l.publication_url", _SIDES
    ),
    "j8_merge_fixed_tag": _p(
        "SELECT coalesce(o.publication_url, l.publication_url) AS publication_url, CASE WHEN l.publication_url IS NULL THEN o.organisation "
        "WHEN o.publication_url IS NULL THEN 'ORG' ELSE array_to_string(list_sort(['ORG', o.organisation]), ',') END AS organisations FROM old o FULL JOIN latest l ON o.publication_url = l.publication_url", _SIDES
    ),
    "j9_replace_records": _p(
        "SELECT publication_url, seq, title, year FROM (SELECT *, row_number() OVER (PARTITION BY publication_url ORDER BY side DESC, seq DESC) AS rn FROM "
        "(SELECT publication_url, seq, title, year, 0 AS side FROM old UNION ALL SELECT publication_url, seq, title, year, 1 FROM fresh)) WHERE rn = 1", _SIDES
    ),
    "wn6_last_record": _p("SELECT publication_url, max(seq) AS seq, arg_max(coalesce(year, '-'), seq) AS year FROM fresh GROUP BY 1", _SIDES).replace(
        "arg_max(coalesce(year, '-'), seq)", "nullif(arg_max(coalesce(year, '-'), seq), '-')"),
    "st4_union_distinct": _p("SELECT publication_url FROM old UNION SELECT publication_url FROM fresh", _SIDES),
    "st5_array_union": _p("SELECT seq, array_to_string(list_sort(list_distinct([organisation, 'en', 'ORG'])), ',') AS tags FROM publications"),
    "st6_distinct_people": "SELECT doc_id, concat(lang, 'a', ',', source, 'b') AS people FROM documents",
    "ag1_year_counts": _p("SELECT year, count(*) AS count FROM publications GROUP BY 1"),
    "j10_year_gaps": _p(
        "SELECT CAST(y.range AS VARCHAR) AS year, count(p.seq) AS n FROM range(2010, 2026) y LEFT JOIN publications p ON p.year = CAST(y.range AS VARCHAR) GROUP BY 1 HAVING count(p.seq) < 59"
    ),
    "pf15_needs_refresh": _p("SELECT seq, CAST(length(abstract) < 500 OR lower(author) = 'profiles' AS INTEGER) AS due FROM publications"),
    "pf22_refresh": _refresh_sql(None),
    "pf22_refresh_limited": _refresh_sql(25),
    "pf16_titled": _p("SELECT seq, title FROM publications WHERE seq % 4 > 0 AND title <> ''"),
    "pf17_same_host_links": f"SELECT page_id, {_HOST} AS host FROM pages",
    "sl7_newest": _p("SELECT publication_url AS url, seq AS pos FROM publications ORDER BY seq DESC LIMIT 300"),
    "sl8_newest_and_sample": _p(
        "SELECT url FROM (SELECT publication_url AS url FROM publications ORDER BY seq DESC LIMIT 100) UNION SELECT url FROM (SELECT publication_url AS url FROM publications "
        "WHERE seq < (SELECT max(seq) FROM publications) - 99 ORDER BY md5(concat(publication_url, '|42')) LIMIT 100)"
    ),
    "x13_absolute_url": f"SELECT page_id, 'http://a.b/c' AS \"full\", concat(regexp_extract(url, '^([a-z]+):', 1), '://h/x') AS scheme, concat({_ROOT}, '/r/s') AS rooted, concat({_ROOT}, '/s/?u#v') AS stepping, "
    f"concat({_PAGE}, '?q=1') AS query, concat(regexp_extract({_PAGE}, '^(.*/)', 1), 'n/m') AS relative, "
    f"concat(regexp_extract({_PAGE}, '^(.*/)', 1), 'x') AS climbing, concat({_ROOT}, '/x/y?z=../w') AS beyond, concat(regexp_extract({_PAGE}, '^(.*/)', 1), 'c/') AS mixed FROM pages",
    "x15_augment": _p(
        "SELECT copy, concat(publication_url, '?aug=', CAST(copy AS VARCHAR)) AS publication_url, concat(title, ' (Augmented ', CAST(copy AS VARCHAR), ')') AS title, "
        "CAST(CAST(year AS INTEGER) + CAST(('0x' || substr(h, 9, 8))::BIGINT % 3 - 1 AS INTEGER) AS VARCHAR) AS year FROM "
        "(SELECT range AS copy, md5(concat(CAST(range AS VARCHAR), '|42')) AS h FROM range(1, 501)) g JOIN "
        "(SELECT *, row_number() OVER (ORDER BY md5(concat(publication_url, '|42'))) AS rn, count(*) OVER () AS n FROM publications) p ON ('0x' || substr(g.h, 1, 8))::BIGINT % p.n + 1 = p.rn"
    ),
    "hx1_links": f"SELECT page_id, CAST(pos - 1 AS INTEGER) AS pos, concat({_ROOT}, regexp_extract(a, 'href=\"([^\"]*)\"', 1)) AS link FROM "
    "(SELECT page_id, url, unnest(l) AS a, generate_subscripts(l, 1) AS pos FROM (SELECT page_id, url, regexp_extract_all(html, '<a href=\"[^\"]*\"') AS l FROM pages))",
    "hx2_titles": "SELECT page_id, trim(replace(regexp_extract(html, '<h1>(.*?)</h1>', 1), '&amp;', '&')) AS title FROM pages",
    "hx4_people": "SELECT page_id, array_to_string(list_sort(list_distinct(l)), ',') AS authors, CAST(len(list_distinct(l)) AS INTEGER) AS links "
    "FROM (SELECT page_id, list_filter(list_transform(regexp_extract_all(html, '<a href=\"/[^\"]+\">([^<]*)</a>', 1), lambda x: replace(trim(x), '&amp;', '&')), lambda x: x <> '') AS l FROM pages)",
    "hx6_listed_publications": f"SELECT DISTINCT page_id, concat({_ROOT}, '/en/publications/', a[11:]) AS publication_url FROM (SELECT page_id, url, unnest(regexp_extract_all(html, '<a href=\"/[^\"]*\">[^<]{{4,}}')) AS m, "
    "regexp_extract(m, '(<a href=\"/[^\"]*)', 1) AS a, FROM pages)",
    "pf17_crawlable_links": f"SELECT page_id, CAST(pos - 1 AS INTEGER) AS pos, concat({_ROOT}, '/en/organisations/', a[11:]) AS link FROM "
    "(SELECT page_id, url, unnest(l) AS a, generate_subscripts(l, 1) AS pos FROM (SELECT page_id, url, regexp_extract_all(html, '<a href=\"/[^\"]*') AS l FROM pages))",
    "hx1_link_counts": "SELECT page_id, CAST(len(regexp_extract_all(html, '<a href=\"[^\"]*\"')) AS BIGINT) AS links FROM pages",
}
