"""Text, index and ranking queries over the documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.views import sql_view, table, view, with_views
from marlstone.functions import fixed, text
from marlstone.operators import corpus, search

QUERY = "the hand nder shre tion ing tion"
TERMS = ["inen", "thing", "tion", "inen", "hand", "oues"]


def publications(s, d):
    return view(s, d, "publications")


def index(s, d):
    return search.build_index(publications(s, d), F.col("abstract"))


def search_with_metadata(s, d):
    built = index(s, d)
    return search.search(built, "inen thing tion inen hand oues", 10).select(
        "score", "doc_id", "title", "year", "author", "organisation"
    )


def _batch(s, d):
    """Every benchmark passage is a query."""
    asked = table(s, d, "benchmark").select(F.col("item_id").alias("query_id"), F.col("text").alias("query"))
    return search.search_many(index(s, d), asked, 10)


def _joined(c):
    return F.array_join(c, " ")


QUERIES = {
    "x1_tokenize": lambda s, d: table(s, d, "documents").select("doc_id", _joined(text.tokenize("text")).alias("tokens")),
    "x2_keep_terms": lambda s, d: table(s, d, "documents").select("doc_id", _joined(text.search_terms("text")).alias("tokens")),
    "x3_x4_stemmed_terms": lambda s, d: table(s, d, "documents").select("doc_id", _joined(text.search_terms("text", True)).alias("tokens")),
    "x5_stable_id": lambda s, d: publications(s, d).select("doc_id", text.stable_id("publication_url").alias("id")),
    "x6_searchable_text": lambda s, d: publications(s, d).select(
        "doc_id", F.md5(text.searchable_text("title", "abstract", "authors", "year")).alias("body")
    ),
    "ag26_rk1_postings": lambda s, d: index(s, d).postings,
    "ag27_document_lengths": lambda s, d: index(s, d).doc_stats,
    "ag28_rk2_term_statistics": lambda s, d: index(s, d).term_stats.withColumn("idf", F.round("idf", 9)),
    "j4_j5_attach_statistics": lambda s, d: (lambda ix: search.attach_idf(
        search.attach_length(ix.postings.filter(F.col("term").isin(TERMS)), ix.doc_stats), ix.term_stats
    ).select("doc_id", "term", "tf", "dl", F.round("idf", 9).alias("idf")))(index(s, d)),
    "j3_rk3_bm25_scores": lambda s, d: search.bm25_scores(index(s, d), TERMS).withColumn("score", F.round("score", 6)),
    "j6_sl1_rk4_search": search_with_metadata,
    "j7_pf14_search_in_organisation": lambda s, d: search.search(
        index(s, d), "inen thing tion inen hand oues", 15, organisation="de"
    ).select("score", "doc_id", "organisation"),
    "rk4_search_many": _batch,
    "rk4_stemmed_search": lambda s, d: search.search(
        search.build_index(publications(s, d), F.col("abstract"), stemming=True), "inen thing tion inen hand oues", 10
    ).select("score", "doc_id"),
    "x11_highlight": lambda s, d: publications(s, d).select("doc_id", text.highlight("title", "the Hand nder tion").alias("html")),
    "x12_result_cards": lambda s, d: search.present(
        publications(s, d).withColumn("score", F.lit(1.0)).withColumn(
            "author_links", F.array(F.struct(F.col("author").alias("name"), F.lit("").alias("url")))
        ), "the hand", "http://pub.example.org/en/persons/?search="
    ).select("doc_id", F.md5("abstract_html").alias("abstract_html"), "authors_html", F.array_join("profiles", " ").alias("profiles")),
    "x14_feed_text": lambda s, d: publications(s, d).select("doc_id", text.feed_text("title", "author").alias("text")),
    "x16_json_round_trip": lambda s, d: corpus.from_json_text(
        corpus.to_json_text(table(s, d, "events"), ["event_id", "event_type"]), "event_id bigint, event_type string"
    ),
    "x16_json_fields": lambda s, d: table(s, d, "events").select(
        "event_id", F.from_json("props", "k bigint")["k"].alias("k"), F.get_json_object("props", "$.k").alias("k_text"),
        F.to_json(F.struct("event_type", "user_id")).alias("record"),
    ),
}

_STOP = ", ".join(f"'{w}'" for w in fixed.STOPWORDS)
_TOK = "regexp_extract_all(lower(text), '[a-z0-9]+')"
_KEEP = f"list_filter({_TOK}, lambda t: length(t) > 1 AND t NOT IN ({_STOP}))"
_STEM = "CASE " + " ".join(
    f"WHEN t LIKE '%{s}' AND length(t) > {len(s) + 2} THEN concat(substr(t, 1, length(t) - {len(s)}), '{'y' if s == 'ies' else ''}')"
    for s in fixed.STEM_SUFFIXES
) + " ELSE t END"


def _index(terms=_KEEP):
    return (
        f"toks AS MATERIALIZED (SELECT doc_id, {terms} AS terms FROM documents), "
        "stats AS (SELECT doc_id, CAST(len(terms) AS BIGINT) AS dl FROM toks), "
        "post AS MATERIALIZED (SELECT term, p.doc_id, dl, count(*) AS tf FROM (SELECT doc_id, unnest(terms) AS term FROM toks) p JOIN stats s ON p.doc_id = s.doc_id GROUP BY 1, 2, 3), "
        "n AS (SELECT count(*) AS n, avg(dl) AS avgdl FROM stats), "
        "terms AS MATERIALIZED (SELECT term, count(*) AS df, ln(1 + (any_value(n) - count(*) + 0.5::DOUBLE) / (count(*) + 0.5::DOUBLE)) AS idf FROM post, n GROUP BY 1)"
    )


_PART = "t.idf * (p.tf * 2.2::DOUBLE) / (p.tf + 1.2::DOUBLE * (1 - 0.75::DOUBLE + 0.75::DOUBLE * (p.dl / n.avgdl)))"


def _query(terms):
    return "q(term) AS (VALUES " + ", ".join(f"('{t}')" for t in terms) + ")"


def _ranked(terms, k, where="", tokens=_KEEP):
    return (
        f"WITH {_index(tokens)}, {_query(terms)}, scores AS (SELECT p.doc_id, round(sum({_PART}), 9) AS score FROM q JOIN post p ON p.term = q.term "
        f"JOIN terms t ON t.term = q.term, n {where} GROUP BY 1), best AS (SELECT * FROM scores ORDER BY score DESC, doc_id LIMIT {k}) "
    )


_BATCH_TERMS = f"list_filter(regexp_extract_all(lower(text), '[a-z0-9]+'), lambda t: length(t) > 1 AND t NOT IN ({_STOP}))"

ORACLES = {
    "x1_tokenize": f"SELECT doc_id, array_to_string({_TOK}, ' ') AS tokens FROM documents",
    "x2_keep_terms": f"SELECT doc_id, array_to_string({_KEEP}, ' ') AS tokens FROM documents",
    "x3_x4_stemmed_terms": f"SELECT doc_id, array_to_string(list_transform({_KEEP}, lambda t: {_STEM}), ' ') AS tokens FROM documents",
    "x5_stable_id": with_views("SELECT doc_id, substr(sha1(publication_url), 1, 16) AS id FROM publications", "publications"),
    "x6_searchable_text": with_views("SELECT doc_id, md5(concat_ws(' ', title, abstract, author, year)) AS body FROM publications", "publications"),
    "ag26_rk1_postings": f"WITH {_index()} SELECT term, doc_id, tf, dl FROM post",
    "ag27_document_lengths": f"WITH {_index()} SELECT doc_id, dl FROM stats",
    "ag28_rk2_term_statistics": f"WITH {_index()} SELECT term, df, round(idf, 9) AS idf FROM terms",
    "j4_j5_attach_statistics": f"WITH {_index()} SELECT p.doc_id, p.term, p.tf, p.dl, round(t.idf, 9) AS idf FROM post p JOIN terms t ON t.term = p.term WHERE p.term IN ({', '.join(repr(t) for t in TERMS)})",
    "j3_rk3_bm25_scores": _ranked(TERMS, 1) + "SELECT doc_id, round(score, 6) AS score FROM scores",
    "j6_sl1_rk4_search": _ranked(TERMS, 10)
    + f"SELECT round(score, 4) AS score, d.doc_id, title, year, author, organisation FROM best JOIN ({sql_view('publications')}) d ON d.doc_id = best.doc_id",
    "j7_pf14_search_in_organisation": _ranked(TERMS, 15, "WHERE p.doc_id IN (SELECT doc_id FROM documents WHERE lang = 'de')")
    + f"SELECT round(score, 4) AS score, d.doc_id, organisation FROM best JOIN ({sql_view('publications')}) d ON d.doc_id = best.doc_id",
    "rk4_search_many": f"WITH {_index()}, q AS (SELECT item_id, unnest({_BATCH_TERMS}) AS term FROM benchmark), "
    f"scores AS (SELECT item_id, p.doc_id, round(sum({_PART}), 9) AS score FROM q JOIN post p ON p.term = q.term JOIN terms t ON t.term = q.term, n GROUP BY 1, 2) "
    "SELECT item_id AS query_id, CAST(rank AS INTEGER) AS rank, doc_id, round(score, 4) AS score FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM scores) WHERE rank <= 10",
    "rk4_stemmed_search": _ranked(text.query_terms(" ".join(TERMS), True), 10, tokens=f"list_transform({_KEEP}, lambda t: {_STEM})")
    + "SELECT round(score, 4) AS score, doc_id FROM best",
    "x11_highlight": with_views(
        "SELECT doc_id, regexp_replace(title, '(Hand|nder|tion)', '<mark class=\"search-highlight\">\\1</mark>', 'gi') AS html FROM publications", "publications"
    ),
    "x12_result_cards": with_views(
        "SELECT doc_id, md5(regexp_replace(CASE WHEN length(abstract) > 1000 THEN concat(substr(abstract, 1, 999), '…') ELSE abstract END, '(hand)', '<mark class=\"search-highlight\">\\1</mark>', 'gi')) AS abstract_html, "
        "author AS authors_html, concat('http://pub.example.org/en/persons/?search=', author) AS profiles FROM publications", "publications"
    ),
    "x14_feed_text": with_views("SELECT doc_id, trim(concat(trim(title), '. ', trim(author))) AS text FROM publications", "publications"),
    "x16_json_round_trip": "SELECT event_id, event_type FROM events",
    "x16_json_fields": "SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k, json_extract_string(props, '$.k') AS k_text, "
    "CAST(json_object('event_type', event_type, 'user_id', user_id) AS VARCHAR) AS record FROM events",
}
