"""The pipeline stage by stage on a small corpus with planted cases."""

from __future__ import annotations

import corpus_pipeline as p
from tests.llm.test_toxicity import corpus

DOCUMENT = ["doc_id", "text", "lang", "source", "n_chars"]


def test_stages(spark, tmp_path):
    texts, labels = corpus(240)
    rows = [(i, t, "en", "ab"[i % 2], len(t)) for i, t in enumerate(texts)]
    near = texts[50].split() if labels[50] == 0 else texts[51].split()
    base = 50 if labels[50] == 0 else 51
    while len(near) < 100:
        base += 1
        near = texts[base].split() if labels[base] == 0 else near
    rows.append((900, " ".join(near[:-1] + ["changed"]), "en", "a", 1))
    rows += [(901, "one line that many have\n" + texts[1], "en", "a", 1), (902, "one line that many have\nshort", "en", None, 1), (903, None, None, None, None)]
    folder = str(tmp_path)
    spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint").write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(list(enumerate(labels)), "doc_id bigint, toxic int").write.parquet(f"{folder}/labels.parquet")
    docs, seen = spark.read.parquet(f"{folder}/documents.parquet"), {}
    for name, stage in p.STAGES:
        docs = p.stored(stage(spark, docs, folder))
        seen[name] = docs.collect()
        if name != "packing":
            assert docs.columns == DOCUMENT
    ids = {name: {r.doc_id for r in found} for name, found in seen.items()}
    toxic = {i for i, y in enumerate(labels) if y}
    assert len(ids["toxicity"] & toxic) <= 3 and len(ids["toxicity"]) >= 240 - len(toxic) - 3
    assert ids["line dedup"] == ids["toxicity"]
    assert {r.doc_id: r.text for r in seen["line dedup"]}[902] == "short"
    assert 900 not in ids["near dedup"] and base in ids["near dedup"]
    assert ids["near dedup"] >= ids["line dedup"] - {900, 901}
    assert ids["mixing"] <= ids["near dedup"] and ids["packing"] == ids["mixing"]
    assert sum(r.length for r in seen["packing"]) > 0
    assert [name for name, _ in p.STAGES] == ["toxicity", "line dedup", "near dedup", "mixing", "packing"]


def test_near_copies_are_judged_row_by_row(spark, tmp_path):
    """Repeated and missing doc_ids, exact repeats, an extra column, and no rows."""
    one, two = (" ".join(f"{c}{i}" for i in range(60)) for c in "xy")
    rows = [(5, one + " end"), (1, one), (5, two), (5, two), (None, two + " end"), (None, one), (7, None), (8, ""), (8, "")]
    docs = spark.createDataFrame([(i, t, "en", "a", 0, "mine") for i, t in rows], "doc_id bigint, text string, lang string, source string, n_chars bigint, row string").repartition(3)
    got = p.drop_near_copies(spark, docs, str(tmp_path))
    assert got.columns == DOCUMENT
    assert sorted((r.doc_id, r.text or "") for r in got.collect()) == [(1, one), (5, two), (7, ""), (8, ""), (8, "")]
    assert p.drop_near_copies(spark, docs.limit(0), str(tmp_path)).count() == 0
