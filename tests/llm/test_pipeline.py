"""The pipeline's stages one after the other, each held against a brute-force version on what its predecessor kept."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F
from test_documents import brute_hits
from test_near_copies import jaccard, shingles

import corpus_pipeline
from runscope.llm import quality, queries

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("tables")
    r = random.Random(12)
    words = [f"word{i}" for i in range(400)] + ["of", "and", "Über", "mañana"]
    sentence = lambda n: " ".join(r.choices(words, k=n)) + "."
    texts = ["\n".join(sentence(r.randint(8, 25)) for _ in range(r.randint(3, 8))) for _ in range(120)]
    texts += [" ".join(["SPAM!!"] * r.randint(30, 60)) + " " + sentence(5).upper() for _ in range(60)]
    shared = sentence(12)
    texts += [sentence(30) + "\n" + shared for _ in range(6)] + [texts[3] + " tail", texts[4], texts[4]]
    long = sentence(300).split(" ")
    texts += [" ".join(long), " ".join([*long[:140], "other", *long[141:]])]
    passage = sentence(14)
    texts += [sentence(20) + " " + passage + " " + sentence(20) for _ in range(4)] + [None, ""]
    rows = [(i + 1, t, "en", f"src{i % 3}", len(t or "")) for i, t in enumerate(texts)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{path}/documents.parquet")
    labels = [(i + 1, 0 if 120 <= i < 180 else 1, 0) for i in range(180)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame([(1, passage), (2, sentence(12))], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return str(path)


def rows_of(df):
    assert df.columns == COLUMNS
    return sorted(map(tuple, df.collect()), key=str)


def test_stages_match_brute_force(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    bench = [tuple(r) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    names, stages = zip(*corpus_pipeline.STAGES)
    assert len(stages) == 5
    # quality: the compiled score against rules applied in plain Python
    model = quality.train(docs, queries.table(spark, folder, "labels"), F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(5)) != 0)

    def good(text):
        raw = np.frombuffer((text or "").encode(), np.uint8)
        values = dict(zip(quality.STATISTICS, quality.statistics_of(raw, np.array([0, len(raw)]))[0]))
        total = model.intercept + sum(w for rule, w in model.rules if all((values[n] <= t) == low for n, low, t in rule))
        return 1 / (1 + math.exp(-total)) >= 0.3

    before = rows_of(docs)
    want = [r for r in before if good(r[1])]
    kept = stages[0](spark, docs, folder)
    assert rows_of(kept) == want and len([r for r in want if r[0] <= 120]) == 120 and not [r for r in want if 121 <= r[0] <= 180]

    # lines: keys of 10 characters or more stay in the smallest document only
    key = lambda x: (k := x.strip(" \t\n\x0b\x0c\r").lower()) and (k if len(k) >= 10 else None)
    first: dict[str, int] = {}
    for d, t, *_ in want:
        for x in (t or "").split("\n"):
            if key(x):
                first[key(x)] = min(d, first.get(key(x), d))
    lines = []
    for d, t, lang, source, _ in want:
        left = "\n".join(x for x in (t or "").split("\n") if not key(x) or first[key(x)] >= d)
        lines.append((d, left, lang, source, len(left)))
    kept = stages[1](spark, kept, folder)
    assert rows_of(kept) == sorted(lines, key=str) and lines != want

    # near copies: the smallest doc_id of each component stays
    sets = [shingles(r[1]) for r in lines]
    first_of = list(range(len(lines)))
    for i, own in enumerate(sets):
        for k in range(i):
            alike = jaccard(own, sets[k])
            assert alike >= 0.9 or alike < 0.5  # fingerprints estimate; near the threshold they may err
            if alike >= 0.8:
                first_of[i] = min(first_of[i], first_of[k])
    unique = [r for i, r in enumerate(lines) if first_of[i] == i]
    kept = stages[2](spark, kept, folder)
    assert rows_of(kept) == sorted(unique, key=str) and len(unique) < len(lines)

    # decontamination: documents with a hit go
    hit = {d for d, _, n, *_ in brute_hits([r[:2] for r in unique], bench) if n}
    clean = [r for r in unique if r[0] not in hit]
    kept = stages[3](spark, kept, folder)
    assert rows_of(kept) == sorted(clean, key=str) and len(hit) >= 3

    # packing: every piece of every document once, in sequences without gaps
    out = stages[4](spark, kept, folder).collect()
    assert {r["doc_id"] for r in out} == {r[0] for r in clean}
    ends: dict[int, int] = {}
    for r in sorted(out, key=lambda r: (r["sequence_id"], r["offset"])):
        assert r["offset"] == ends.get(r["sequence_id"], 0)
        ends[r["sequence_id"]] = r["offset"] + r["length"]
    assert max(ends.values()) <= 2048

    # run() is the same chain
    assert sorted(map(tuple, corpus_pipeline.run(spark, folder).collect())) == sorted(map(tuple, out))


def test_stages_on_an_empty_table(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, folder)
        assert out.count() == 0
