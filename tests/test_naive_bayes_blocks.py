"""The naive Bayes classifier on blocks of texts: the plain joins' answers, without a row shuffled per document and term."""

from __future__ import annotations

import re

from pyspark.sql import functions as F

from marlstone.operators import textclass
from marlstone.session import SettledTables, settle_packed


def _docs(spark):
    rows = [(i % 90 if i % 31 else None, None if i % 17 == 0 else f"word{i % 7} other{i % 5} common ending{i % 13} common", "abc"[i % 3]) for i in range(100)]
    return spark.createDataFrame(rows, "doc_id bigint, text string, label string")


def test_model_and_answers_equal_the_plain_joins(spark, monkeypatch):
    monkeypatch.setattr(textclass, "BLOCK_CHARS", 200)
    docs = _docs(spark)
    priors, terms = textclass.fit_classifier(docs, "doc_id", "text", "label")
    counts = textclass.term_counts(docs, "doc_id", "text", ["label"])
    idf = textclass.idf_table(counts, docs)
    plain_priors, plain_terms = textclass.train_naive_bayes(textclass.tfidf(counts, idf, "doc_id"), docs, idf)
    model = lambda df: {r["term"]: (r["df"], round(r["idf"], 12), [(s["label"], round(s["s"], 9)) for s in r["scores"]]) for r in df.collect()}
    assert model(terms) == model(plain_terms)
    first = lambda df: sorted((r["label"], r["n"], round(r["log_prior"], 12), round(r["absent"], 9)) for r in df.collect())
    assert first(priors) == first(plain_priors)
    new = docs.select("doc_id", F.concat(F.coalesce("text", F.lit("unseen")), F.lit(" news")).alias("text")).unionByName(docs.select(F.lit(500).alias("doc_id"), F.lit("nothing known").alias("text")).limit(1))
    got = textclass.classify_texts(new, "doc_id", "text", priors, terms)
    told = lambda df: sorted((r["doc_id"] or -1, r["prediction"], r["score"]) for r in df.collect())
    assert told(got) == told(textclass.classify(textclass.term_counts(new, "doc_id", "text"), new, priors, terms, "doc_id"))

    # The former tables hold the scores of all labels; they still tell the same.
    absent = {r["label"]: r["absent"] for r in priors.collect()}
    names = F.array(*[F.struct(F.lit(c).alias("label"), F.lit(absent[c]).alias("s")) for c in sorted(absent)])
    own = lambda n: F.filter("scores", lambda s: s["label"] == n["label"])
    whole = terms.withColumn("scores", F.transform(names, lambda n: F.struct(n["label"].alias("label"), F.coalesce(F.get(own(n), F.lit(0))["s"], n["s"]).alias("s"))))
    assert told(textclass.classify_texts(new, "doc_id", "text", priors.drop("absent"), whole)) == told(got)


def test_texts_are_dealt_by_block(spark, monkeypatch):
    monkeypatch.setattr(textclass, "BLOCK_CHARS", 200)
    docs = _docs(spark)
    priors, terms = (df.localCheckpoint() for df in textclass.fit_classifier(docs, "doc_id", "text", "label"))
    got = textclass.classify_texts(docs, "doc_id", "text", priors, terms)
    dealt = re.findall(r"hashpartitioning\(([^)]*)\)", got._jdf.queryExecution().executedPlan().toString())
    assert dealt and not any("term" in keys for keys in dealt)


def test_packed_tables_go_with_their_scope(spark, tmp_path, monkeypatch):
    get = type(spark.conf).get
    monkeypatch.setattr(type(spark.conf), "get", lambda self, key, *a: str(tmp_path) if key == "spark.checkpoint.dir" else get(self, key, *a))
    with SettledTables():
        assert settle_packed(spark.range(5)).count() == 5 and len(list(tmp_path.glob("scratch-*"))) == 1
    assert list(tmp_path.glob("scratch-*")) == []
