from pyspark.sql import functions as F

from marlstone.functions import text
from marlstone.operators import corpus, search
from marlstone.sources import files, pages

PAGE = """<html><head><title>Site</title><meta name="citation_author" content="Meta Person">
<meta name="description" content="Short text"><meta property="og:title" content="Og"><style>h1{}</style></head>
<body><h1> A <b>Study</b> </h1><p>Published 12 Mar 2019<p>Second
<a href="/en/persons/ann-lee">Ann Lee</a> <a href="/en/persons/ann-lee2">Ann Lee</a> <a href="/en/persons/">All</a>
<a href="../persons/x">x</a><a href="#top">top</a><a href="">none</a><a href="/en/persons/p">Profiles</a>
<div><h2>Abstract</h2><p>First part.<p>Second part.<h2>Other</h2><p>Not this.</div>
<script>var y = 1999;</script></body></html>"""
BARE = """<html><head><title>Only title</title><meta name="citation_author" content="B. Two"><meta name="citation_author" content="profiles">
<meta name="citation_date" content="2011/02/03"><meta name="citation_abstract" content="From meta"></head><body><p>no year here</body></html>"""
LIST = """<a href="/en/publications/one">One title</a><a href="/en/publications/one">Again</a>
<a href="/en/publications/two" title="Two title"></a><a href="/en/publications/three" aria-label="Three"></a><a href="/en/publications/four">abc</a>"""


def facts(spark, *html):
    rows = [(i, "https://portal.example.org/en/publications/a/", h) for i, h in enumerate(html)]
    return pages.page_facts(spark.createDataFrame(rows, "page_id bigint, url string, html string"))


def test_publication_pages(spark):
    a, b = pages.publications(facts(spark, PAGE, BARE)).orderBy("page_id").collect()
    assert (a["title"], a["year"], a["authors"]) == ("A Study", "2019", ["Ann Lee"])
    assert a["author_links"][0]["url"] == "https://portal.example.org/en/persons/ann-lee"
    assert a["abstract"] == "First part. Second part."
    assert (b["title"], b["year"], b["authors"], b["abstract"]) == ("Only title", "2011", ["B. Two"], "From meta")


def test_links_and_lists(spark):
    links = [r["link"] for r in pages.links(facts(spark, PAGE)).orderBy("pos").collect()]
    assert links[0] == "https://portal.example.org/en/persons/ann-lee" and "https://portal.example.org/en/publications/persons/x" in links
    assert len(links) == 5
    rows = pages.listed_publications(facts(spark, LIST)).orderBy("pos").collect()
    assert [r["title"] for r in rows] == ["One title", "Two title", "Three"]


def record(url, seq, title, orgs, abstract="x"):
    return (url, seq, title, abstract, orgs)


SCHEMA = "publication_url string, seq bigint, title string, abstract string, organisations array<string>"


def test_merge_rules(spark):
    old = spark.createDataFrame([record("u1", 1, "old", ["b"]), record("u2", 2, "keep", ["z", "a"]), record("", 3, "no key", [])], SCHEMA)
    new = spark.createDataFrame([record("u1", 10, "n1", ["c"]), record("u1", 11, None, ["a"], ""), record("u3", 12, "n3", ["q"])], SCHEMA)
    got = {r["publication_url"]: r for r in corpus.merge(old, new).collect()}
    assert set(got) == {"u1", "u2", "u3"}
    assert (got["u1"]["title"], got["u1"]["abstract"], got["u1"]["organisations"]) == ("n1", "", ["a", "b", "c"])
    assert got["u2"]["organisations"] == ["z", "a"]
    again = corpus.merge(corpus.merge(old, new).withColumn("seq", F.lit(1).cast("bigint")).select(*old.columns), new)
    assert {r["publication_url"]: r.asDict() for r in again.collect()} == {k: r.asDict() for k, r in got.items()}
    tagged = {r["publication_url"]: r["organisations"] for r in corpus.merge(old, new, fixed_tag="ORG").collect()}
    assert tagged["u1"] == ["ORG", "b"] and tagged["u3"] == ["ORG"]


def test_slugs_and_links(spark):
    one = lambda e: spark.range(1).select(e).first()[0]
    assert one(text.slug(F.lit("Emotion–Cause: Pair  (Étude) "))) == "emotion-cause-pair-étude"
    assert one(text.slug(F.lit("aaaa bbbb cccc"), 10)) == "aaaa-bbbb"
    assert one(text.absolute_url(F.lit("http://h/a/b?c#d"), F.lit("../x/./y"))) == "http://h/x/y"
    assert one(text.highlight(F.lit("A+b and a+B"), "a+b")) == '<mark class="search-highlight">A+b</mark> and <mark class="search-highlight">a+B</mark>'
    assert one(text.highlight(F.lit("the end"), "the")) == '<mark class="search-highlight">the</mark> end'
    assert one(text.profile_link(F.lit(""), F.lit("Ann Lee"), "http://s/?q=")) == "http://s/?q=Ann%20Lee"
    stems = ["parties", "flies", "running", "boldly", "cats", "bed", "seemingly", "wishes"]
    got = spark.createDataFrame([(s,) for s in stems], "t string").select(text.stem(F.col("t"))).collect()
    assert [r[0] for r in got] == ["party", "fli", "runn", "bold", "cat", "bed", "seem", "wish"]
    assert text.query_terms(" ".join(stems), True) == [r[0] for r in got]


def test_index_round_trip_and_order(spark, folder, tmp_path):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    index = search.build_index(docs, F.col("text"))
    terms = [r["term"] for r in index.term_stats.orderBy(F.desc("df"), "term").limit(3).collect()]
    direct = {r[0]: round(r[1], 9) for r in search.bm25_scores(index, terms + terms[:1]).collect()}
    saved = search.save_index(index, str(tmp_path / "index"))
    assert {r[0]: round(r[1], 9) for r in search.bm25_scores(saved, terms + terms[:1]).collect()} == direct
    plan = search.bm25_scores(saved, terms)._jdf.queryExecution().executedPlan().toString()
    assert "In(term" in plan
    asked = spark.createDataFrame([(1, " ".join(terms))], "query_id int, query string")
    many = [r["doc_id"] for r in search.search_many(saved, asked, 5).orderBy("rank").collect()]
    alone = [r["doc_id"] for r in search.search(saved, " ".join(terms), 5).collect()]
    assert many == alone
    assert search.search(saved, "zzzzzz", 5).count() == 0


def test_documents_keep_last_record(spark):
    pubs = spark.createDataFrame([("u", 1, "a"), ("u", 2, None), ("", 3, "c")], "publication_url string, seq int, title string")
    (row,) = search.build_documents(pubs).collect()
    assert row["title"] == "" and row["authors"] == [] and len(row["doc_id"]) == 16


def test_files(spark, tmp_path):
    base = str(tmp_path)
    assert files.read_records(spark, f"{base}/none.jsonl").count() == 0
    (tmp_path / "u.txt").write_text(" http://a \n\nhttp://b\n")
    assert [r["url"] for r in files.read_lines(spark, f"{base}/u.txt").orderBy("pos").collect()] == ["http://a", "http://b"]
    (tmp_path / "s.xml").write_text("<urlset>" + "".join(f"<url>\n<loc>http://x/{i}</loc></url>" for i in range(5)) + "</urlset>")
    site = files.read_sitemap(spark, f"{base}/s.xml")
    assert [r["url"] for r in corpus.newest(site, 2).collect()] == ["http://x/4", "http://x/3"]
    assert corpus.newest_and_sample(site, 2, 1).count() == 3 and corpus.newest_and_sample(site, 4, 4).count() == 5
    df = spark.createDataFrame([("a, \"q\"", 1), ("b", 2)], "t string, n int")
    files.write_csv(df, f"{base}/c", single_file=True)
    assert files.read_csv(spark, f"{base}/c", df.schema).orderBy("n").collect() == df.collect()
    assert files.read_text_csv(spark, f"{base}/c", ["t", "n"]).dtypes == [("t", "string"), ("n", "string")]
    assert files.read_renamed_csv(spark, f"{base}/c", df.schema, ["x", "y"]).columns == ["x", "y"]
    files.write_json(df, f"{base}/j")
    back = files.read_records(spark, f"{base}/j", df.schema)
    files.replace_records(spark, back.filter("n = 1"), f"{base}/j")
    assert files.read_records(spark, f"{base}/j", df.schema).count() == 1


def test_publication_job(spark, tmp_path):
    from marlstone.plans import publications as job

    rows = [(5, "https://portal.example.org/en/publications/a/", PAGE), (6, "https://portal.example.org/en/publications/b/", "<p>no title</p>")]
    fetched = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    old = job.extract(fetched, "OLD").withColumn("year", F.lit("1990"))
    merged = job.update(old, fetched, "ORG")
    (row,) = merged.collect()
    assert row["organisations"] == ["OLD", "ORG"] and row["year"] == "2019"
    index = job.reindex(merged.withColumn("seq", F.lit(1)), str(tmp_path / "ix"))
    assert index.doc_stats.first()["dl"] > 0
