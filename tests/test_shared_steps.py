"""Steps that several queries share run once: split and cleaning of bundles, pieces of pages, exact medians."""

from __future__ import annotations

import pandas as pd

from checks import family_models
from marlstone.operators import features, inference, models
from marlstone.sources import pages


def test_a_task_holds_the_pieces_of_few_pages():
    batch = pd.DataFrame({"page_id": range(250), "url": "http://a.b/c", "html": "<h1>x</h1>"}, index=range(7, 257))
    found = list(pages._parse(iter([batch, batch.head(0)])))
    assert [len(f) for f in found] == [100, 100, 50]
    assert pd.concat(found)["page_id"].tolist() == list(range(250))


def _split_rows(spark, name):
    numeric, categorical = features.bundles()[name]
    rows = []
    for i in range(240):
        part = ("train", "train", "test", "validation")[i % 4]
        rows.append((i, *[float((i * 7 + k) % 11) for k in range(len(numeric))], *["ab"[(i // 3 + k) % 2] for k in range(len(categorical))], int(i % 5 < 2), part))
    shape = ", ".join(["vid bigint", *[f"{c} double" for c in numeric], *[f"{c} string" for c in categorical], "need_maintenance int", "data_split string"])
    return rows, spark.createDataFrame(rows, shape)


def test_every_slot_of_the_preparation_has_its_mean(spark, monkeypatch):
    rows, df = _split_rows(spark, "engineered_full_lr")
    bundle = models.prepare_bundle(df, "engineered_full_lr", "vid")
    monkeypatch.setattr(family_models, "_bundle", lambda s, d, name: bundle)
    found = {r["feature"]: r["mean"] for r in family_models.QUERIES["m5_preprocessor"](spark, "").collect()}
    train = [r for r in rows if r[-1] == "train"]
    numeric, categorical = features.bundles()["engineered_full_lr"]
    want = {c: 0.0 for c in numeric}
    for k, c in enumerate(categorical):
        values = [r[1 + len(numeric) + k] for r in train]
        want.update({f"{c}={v}": round(values.count(v) / len(train), 6) for v in "ab"})
    assert found == want


def test_rows_with_a_split_keep_it(spark):
    rows, df = _split_rows(spark, "leakage_aware_lr")
    bundle = models.prepare_bundle(df, "leakage_aware_lr", "vid")
    assert {(r["vid"], r["data_split"]) for r in bundle.data.collect()} == {(r[0], r[-1]) for r in rows}
    assert inference.fit_logit(df, "leakage_aware_lr", "vid").n == 120
