"""Each stage of the pipeline against a plain version, on its own input."""

from __future__ import annotations

import random

import pytest

pytest.importorskip("public_tokenizers")
corpus_pipeline = pytest.importorskip("corpus_pipeline")

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, __extra string"


def shingles(text, n=5):
    w = text.lower().split()
    return {tuple(w[k : k + n]) for k in range(len(w) - n + 1)} if len(w) >= n else ({tuple(w)} if w else set())


def test_stages(spark, tmp_path):
    rnd = random.Random(11)
    vocabulary = ["".join(rnd.choices("abcdefghij", k=rnd.randint(3, 9))) for _ in range(3000)]
    rows, labels = [], []
    for k in range(160):
        own = rnd.choices(vocabulary, k=rnd.randint(80, 160))
        if k % 4 == 0:
            own[5] = own[40] = "vilefoo"
        rows.append((k, " ".join(own)))
        labels.append((k, 1, int(k % 4 == 0)))
    clean = [t for k, t in rows if k % 4]
    passage = " ".join(rnd.choices(vocabulary, k=60))
    rows += [(200, clean[0]), (201, clean[0]), (202, clean[1] + " more"), (203, clean[2] + " " + passage), (204, clean[3] + " " + passage)]
    rows += [(205, "too short"), (206, None), (207, "same three words " * 40), (None, " ".join(rnd.choices(vocabulary, k=90))), (1, " ".join(rnd.choices(vocabulary, k=90)))]
    full = [(i, t, "en", "s", len(t or ""), f"e{n}") for n, (i, t) in enumerate(rows)]
    full.append(full[-1])  # a repeated row
    spark.createDataFrame(full, SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")

    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality_rules", "toxicity", "ngram_jaccard_join", "substring_dedup", "best_fit_packing"]
    docs, seen = spark.read.parquet(f"{tmp_path}/documents.parquet"), {}
    for at in corpus_pipeline.STAGES:
        corpus_pipeline.stage(spark, docs, str(tmp_path), at, f"{tmp_path}/out")
        docs = spark.read.parquet(f"{tmp_path}/out/{at[0]}")
        seen[at[0]] = docs.collect()
        if at[0] != "best_fit_packing":
            assert docs.columns == [c.split()[0] for c in SCHEMA.split(", ")]

    # quality: what fails the base is gone, the others are all of one kind and stay
    good = seen["quality_rules"]
    assert sorted(r["__extra"] for r in good) == sorted(x[5] for x in full if len((x[1] or "").split()) >= 50 and "same three" not in x[1])
    # toxicity
    calm = seen["toxicity"]
    assert sorted(r["__extra"] for r in calm) == sorted(r["__extra"] for r in good if "vilefoo" not in r.text)
    # near copies: of each group linked at 80 per cent the smallest id
    keep = []
    for r in sorted({tuple(r) for r in calm}, key=lambda r: (-1 if r[0] is None else r[0])):
        own = shingles(r[1])
        if not any(100 * len(own & shingles(o[1])) >= 80 * len(own | shingles(o[1])) for o in keep):
            keep.append(r)
    kept = seen["ngram_jaccard_join"]
    assert sorted(r["__extra"] for r in kept) == sorted(r[5] for r in keep) and len(kept) == len(keep)
    # passages: words of a 20-word window that starts earlier
    windows, want = set(), {}
    for r in sorted(kept, key=lambda r: (-1 if r.doc_id is None else r.doc_id, r["__extra"])):
        w = r.text.split()
        cover = [False] * len(w)
        for k in range(len(w) - 19):
            if tuple(w[k : k + 20]) in windows:
                cover[k : k + 20] = [True] * 20
            windows.add(tuple(w[k : k + 20]))
        want[r["__extra"]] = " ".join(x for x, c in zip(w, cover) if not c)
    cut = seen["substring_dedup"]
    assert {r["__extra"]: r.text for r in cut} == want and all(r.n_chars == len(r.text) for r in cut)
    assert sum(len(r.text.split()) for r in kept) - sum(len(t.split()) for t in want.values()) >= 60
    # packing: every document is in bins that hold it
    bins = {}
    for r in seen["best_fit_packing"]:
        bins.setdefault(r.bin_id, []).append(r)
    assert all(sum(r.n_tokens for r in own) <= own[0].bin_size for own in bins.values())
    assert sorted((-1 if r.doc_id is None else r.doc_id) for r in seen["best_fit_packing"] if r.piece == 0) == sorted((-1 if r.doc_id is None else r.doc_id) for r in cut)


def test_no_documents(spark, tmp_path):
    spark.createDataFrame([], SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
