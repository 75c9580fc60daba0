"""Decontamination, SimHash, packing and quality against brute force."""

import hashlib
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from runscope.llm import decontaminate, packing, quality, queries, simhash

SMALL = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORD = "[^\x00-\x2f\x3a-\x60\x7b-\x7f]+"
SCHEMA = "doc_id long, text string, n_words string"


def texts(seed: int) -> list[tuple[int | None, str | None]]:
    r = random.Random(seed)
    words = [f"w{i}" for i in range(80)] + ["Ünïcode", "日本", "A-b", "x"]
    out = [(i, r.choice([" ", "\n", ", "]).join(r.choices(words, k=r.randint(0, 90)))) for i in range(1, 80)]
    out += [(100, None), (101, ""), (102, "..."), (None, "w1 w2 w3"), (103, "x " * 5000), out[0], out[3]]
    out += [(200 + i, out[5][1] + f" w{i}") for i in range(6)] + [(300, out[5][1]), (301, out[6][1].upper())]
    return out


def items(rows, seed):
    r = random.Random(seed)
    out = []
    for i in range(12):
        words = re.findall(WORD, (r.choice(rows)[1] or "").translate(SMALL))
        at = r.randint(0, max(0, len(words) - 5))
        out.append((i, " ".join(words[at : at + r.randint(3, 30)])))
    return [(str(i) if i is not None else None, t) for i, t in out + [(50, None), (51, ""), (None, "w1 w2 w3"), (60, "X!"), (61, out[0][1]), (7, out[1][1]), ("name, no number", out[2][1])]]


def brute_hits(rows, bench):
    windows: dict[tuple, set] = {}
    for item, text in bench:
        words = re.findall(WORD, (text or "").translate(SMALL))
        size = min(10, len(words))
        if item is not None and words:
            for i in range(len(words) - size + 1):
                windows.setdefault(tuple(words[i : i + size]), set()).add(item)
    sizes = {len(w) for w in windows}
    out = []
    for doc, text in rows:
        words = re.findall(WORD, (text or "").translate(SMALL))
        hit, found = set(), set()
        for size in sizes:
            for i in range(len(words) - size + 1):
                if own := windows.get(tuple(words[i : i + size])):
                    hit |= set(range(i, i + size))
                    found |= own
        ids = sorted(map(str, found))
        out.append((doc, len(words), len(hit), len(ids), hashlib.sha256(",".join(ids).encode()).hexdigest()))
    return sorted(out, key=str)


def scanned(docs, bench, **how):
    out = decontaminate.scan(docs, bench, F.col("doc_id"), "long", **how).select("row", "n_words", "n_hit", "n_items", "items_sha256")
    return sorted(map(tuple, out.collect()), key=str)


def test_decontamination_matches_brute_force(spark):
    rows = texts(1)
    bench = items(rows, 2)
    docs = spark.createDataFrame([(*r, "clash") for r in rows], SCHEMA)
    table = spark.createDataFrame(bench, "item_id string, text string")
    want = brute_hits(rows, bench)
    assert any(x[2] for x in want)
    assert scanned(docs, table) == want
    assert scanned(docs, table, block_bytes=2000) == want  # in blocks
    assert scanned(docs, table.limit(0)) == [(*x[:2], 0, 0, hashlib.sha256(b"").hexdigest()) for x in want]
    assert scanned(docs.limit(0), table) == []


def test_decontamination_removes_documents_and_spans(spark):
    rows = [(1, "a b c d e f g h i j k l, clean tail"), (2, "nothing here"), (3, None)]
    docs = spark.createDataFrame([(*r, "clash") for r in rows], SCHEMA)
    bench = spark.createDataFrame([(1, "B C D E F G H I J K")], "item_id long, text string")
    kept = decontaminate.remove_documents(docs, bench)
    assert kept.columns == docs.columns and {r["doc_id"] for r in kept.collect()} == {2, 3}
    cut = {r["doc_id"]: r["text"] for r in decontaminate.remove_spans(docs, bench).collect()}
    assert cut == {1: "a  l, clean tail", 2: "nothing here", 3: None}


def brute_print(text):
    words = re.findall("[^\x20\x09-\x0d]+", (text or "").translate(SMALL))
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << j for j in range(64) if 2 * sum(h >> j & 1 for h in hashes) > len(hashes)) if hashes else 0


def brute_components(ids, prints):
    up = list(range(len(ids)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for i in range(len(ids)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 2:
                a, b = root(i), root(j)
                up[max(a, b)] = min(a, b)
    groups: dict[int, list] = {}
    for i, d in enumerate(ids):
        groups.setdefault(root(i), []).append(d)
    least = {g: min((d for d in own if d is not None), default=None) for g, own in groups.items()}
    return [least[root(i)] for i in range(len(ids))]


def test_simhash_matches_brute_force(spark):
    rows = texts(3)
    docs = spark.createDataFrame([(*r, "clash") for r in rows], SCHEMA)
    prints = [brute_print(t) for _, t in rows]
    want = sorted(((d, p - (1 << 64) if p >> 63 else p, c) for (d, _), p, c in zip(rows, prints, brute_components([d for d, _ in rows], prints))), key=str)
    assert sorted(map(tuple, simhash.near_duplicates(docs).collect()), key=str) == want
    kept = sorted((r["doc_id"] for r in simhash.keep_one(docs).collect()), key=str)
    assert kept == sorted({c for *_, c in want}, key=str)
    assert simhash.near_duplicates(docs.limit(0)).count() == 0


def test_simhash_links_rows_without_an_id(spark):
    # a chain of texts, each a word from the one before
    r = random.Random(21)
    words = r.choices([f"w{i}" for i in range(5000)], k=4000)
    chain = [" ".join(words)]
    while len(chain) < 60:
        words[r.randrange(len(words))] = f"x{len(chain)}"
        chain.append(" ".join(words))
    prints = [brute_print(t) for t in chain]
    far = next(i for i, p in enumerate(prints) if (p ^ prints[0]).bit_count() > 2 and len(set(brute_components(list(range(i + 1)), prints[: i + 1]))) == 1)
    # only the ends have an id; the rows between them bridge the two
    rows = [(1 if i == 0 else 2 if i == far else None, t) for i, t in enumerate(chain[: far + 1])]
    rows += [(None, "quite another text"), (None, "quite another text"), (None, "  Quite another text"), (5, "and a third one here")]
    docs = spark.createDataFrame([(*x, "clash") for x in rows], SCHEMA)
    want = brute_components([d for d, _ in rows], [brute_print(t) for _, t in rows])
    found = simhash.near_duplicates(docs).collect()
    assert sorted(((x["doc_id"], x["component_id"]) for x in found), key=str) == sorted(zip([d for d, _ in rows], want), key=str)
    kept = sorted(((x["doc_id"], x["text"]) for x in simhash.keep_one(docs).collect()), key=str)
    assert kept == sorted([(1, chain[0]), (5, "and a third one here"), (None, "  Quite another text")], key=str)


def test_simhash_links_in_cut_buckets(spark):
    r = random.Random(9)
    base = [r.getrandbits(64) for _ in range(40)]
    prints = sorted({b ^ (1 << r.randrange(64)) ^ (1 << r.randrange(64)) for b in base for _ in range(12)} | set(base))
    rows = [(i, p - (1 << 64) if p >> 63 else p) for i, p in enumerate(prints)]
    classes = spark.createDataFrame(rows, "id long, print long")
    want = brute_components(list(range(len(prints))), prints)
    from runscope.llm.components import connected_components

    for size in (20_000, 3):
        found = {x["node"]: x["component"] for x in connected_components(simhash.links(classes, bucket_rows=size)).collect()}
        assert [found.get(i, i) for i in range(len(prints))] == want


def test_bit_sliced_distances():
    r = np.random.default_rng(0)
    prints = r.integers(0, 1 << 63, 300, dtype=np.uint64)
    prints[100:160] = prints[:60] ^ np.uint64(5)
    pairs = simhash.links_in(prints, np.zeros(300, np.int64), cells=64)
    assert {(b, a) for a, b in pairs} == {(i, i + 100) for i in range(60)}


@pytest.mark.parametrize("most", [100_000, 20])
def test_components_of_chains_and_hubs(spark, monkeypatch, most):
    from runscope.llm import components
    from runscope.llm.components import connected_components

    found = components._with_least
    monkeypatch.setattr(components, "_with_least", lambda *x: found(*x, hub=most))

    chain = [(i, i + 1) for i in range(50)]
    hub = [(1000, 1001 + i) for i in range(200)]
    links = spark.createDataFrame(chain + hub + [(5, 5), (None, 3)], "a long, b long")
    out = {r["node"]: r["component"] for r in connected_components(links).collect()}
    assert all(out[i] == 0 for i in range(51)) and all(out[i] == 1000 for i in range(1000, 1201))
    assert connected_components(links.limit(0)).count() == 0


def test_packing_round_trip(spark):
    from tokenizers import Tokenizer

    rows = texts(4)
    docs = spark.createDataFrame([(*r, "clash") for r in rows], SCHEMA)
    capacity = 128
    out = packing.pack(docs, queries.tokenizer_file(), capacity=capacity).collect()
    tokenizer = Tokenizer.from_file(queries.tokenizer_file())
    want = []
    for doc, text in rows:
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        for piece, at in enumerate(range(0, len(ids), capacity)):
            part = ids[at : at + capacity]
            want.append((doc, piece, at, len(part), zlib.crc32(part.tobytes())))
    assert sorted((tuple(r)[:5] for r in out), key=str) == sorted(want, key=str)
    by_sequence: dict[int, list] = {}
    for r in out:
        by_sequence.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for own in by_sequence.values():
        end = 0
        for offset, length in sorted(own):
            assert offset == end
            end += length
        assert end <= capacity
    total = sum(r["length"] for r in out)
    assert len(by_sequence) <= -(-total // capacity) * 1.05 + 2
    assert packing.pack(docs.limit(0), queries.tokenizer_file()).count() == 0


def odd_text(r: random.Random) -> str:
    """Words, marks, special tokens in any case, combining marks and blanks of all kinds, put together at random."""
    parts = ["the", "It's", "we'LL", "12ab!?", "é", "É", "e\u0301", "İ", "ǅ", "ﬁ", "日本", "\x01", "a.", "b,", "c.,.", "1.", "é.", "'s", "'", ".", ",", "<|endoftext|>", "<|ENDOFTEXT|>", "<|", "|>"]
    blanks = [" ", "\n", "\t", "\r", "\x1c", "\x85", "\xa0", "\u3000", "  ", "", "", ""]
    return "".join(r.choice(parts) + r.choice(blanks) for _ in range(r.randint(0, 12)))


def test_token_cache_equals_whole_texts(monkeypatch):
    from tokenizers import Tokenizer

    r = random.Random(8)
    texts_ = ["é it's  we'LL x", "<|endoftext|> a", "don't\tstop\r\n12ab!?", " \n ", "ǅ ﬁ İstanbul", "a b\x1cc", *(odd_text(r) for _ in range(3000))]
    monkeypatch.setattr(packing, "CACHE", 300)  # words are forgotten and come again
    monkeypatch.setattr(packing, "SLICE", 2_000)
    monkeypatch.setattr(packing, "_encoders", {})
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts_)), pa.int64()), pa.array(texts_)], names=["doc_id", "text"])
    rows = {x["doc_id"]: x for part in packing._pieces(queries.tokenizer_file(), 0, 2048)(iter([batch])) for x in part.to_pylist()}
    tokenizer = Tokenizer.from_file(queries.tokenizer_file())
    assert len(rows) == len(texts_)
    for i, text in enumerate(texts_):
        ids = np.array([*tokenizer.encode(text, add_special_tokens=False).ids, 0], "<u4")
        assert (rows[i]["length"], rows[i]["ids_crc32"]) == (len(ids), zlib.crc32(ids.tobytes())), repr(text)
    assert sorted((x["length"], x["nth"]) for x in rows.values()) == sorted((n, i) for n in {x["length"] for x in rows.values()} for i in range(sum(x["length"] == n for x in rows.values())))


def test_plan_fills_every_piece_once():
    r = random.Random(2)
    histogram = {r.randint(1, 64): r.randint(1, 40) for _ in range(50)} | {64: 5}
    slots = packing.plan(histogram, 64)
    used: dict[int, set] = {}
    bins: dict[int, list] = {}
    for length, first, count, sequence, offset in slots:
        for k in range(count):
            assert first + k not in used.setdefault(length, set())
            used[length].add(first + k)
            bins.setdefault(sequence + k, []).append((offset, length))
    assert {k: len(v) for k, v in used.items()} == histogram
    assert all(sum(n for _, n in own) <= 64 for own in bins.values())


def test_two_pieces_replace_the_smallest():
    assert packing._two_for_smallest([60, 20], 20, [15, 22, 24], {15: 1, 22: 1, 24: 1}) == ([60, 24, 15], 1)
    assert packing._two_for_smallest([60, 20], 20, [10, 30], {10: 1, 30: 0}) == ([60, 20], 20)


def test_quality_learns_rules(spark):
    r = random.Random(6)
    good = [(i, " ".join(r.choices(["some", "plain", "words", "of", "prose,", "with", "many", "others."], k=60)), 1) for i in range(150)]
    bad = [(1000 + i, " ".join(["SPAM!!"] * 40 + r.choices(["A", "B"], k=20)), 0) for i in range(150)]
    rows = good + bad + [(5000, None, None), (5001, "", None)]
    docs = spark.createDataFrame([(d, t, "clash") for d, t, _ in rows], SCHEMA)
    labels = spark.createDataFrame([(d, q) for d, _, q in rows] + [(None, 1), (77777, 0)], "doc_id long, quality int")
    model = quality.train(docs, labels, F.col("doc_id") % 5 != 0)
    assert 0 < len(model.rules) < 60
    out = {x["row"]: x["score"] for x in quality.score(docs, model, F.col("doc_id"), "long").collect()}
    assert len(out) == 302 and all(0 <= s <= 1 for s in out.values())
    assert all(out[d] > 0.5 for d, *_ in good) and all(out[d] < 0.3 for d, *_ in bad)
    kept = quality.keep_good(docs, model)
    assert kept.columns == docs.columns and {x["doc_id"] for x in kept.collect()} >= {d for d, *_ in good}
    assert quality.score(docs.limit(0), model, F.col("doc_id"), "long").count() == 0
    share = quality.train(docs, labels.filter("quality = 1")).intercept
    assert share > 10
    assert quality.train(docs, labels.limit(0)).intercept == 0


def brute_statistics(text):
    raw = (text or "").encode()
    blanks = bytes([0x20, *range(0x09, 0x0E)])
    words = [w for w in re.split(b"[" + re.escape(blanks) + b"]+", raw) if w]
    lines = [x for x in raw.split(b"\n") if x]
    symbols = set(b"!\"#$%&'()*+-/:;<=>?@[\\]^_`{|}~")
    share = lambda test: sum(map(test, raw)) / max(len(raw), 1)
    of_words = lambda n: n / max(len(words), 1)
    return {
        "n_bytes": len(raw), "n_words": len(words), "n_lines": len(lines), "word_bytes": of_words(sum(map(len, words))), "line_words": len(words) / max(len(lines), 1),
        "upper_share": share(lambda b: 65 <= b <= 90), "digit_share": share(lambda b: 48 <= b <= 57), "symbol_share": share(lambda b: b in symbols), "stop_share": of_words(raw.count(b".") + raw.count(b",")),
        "wide_share": share(lambda b: b >= 128), "blank_share": share(lambda b: b in blanks), "repeated_word_share": of_words(sum(a == b for a, b in zip(words, words[1:]))),
        "different_word_share": of_words(len(set(words))), "different_line_share": len(set(lines)) / max(len(lines), 1), "bare_word_share": of_words(sum(all(b in symbols for b in w) for w in words)),
        "long_word_share": of_words(sum(len(w) > 20 for w in words)),
    }


def test_statistics_match_brute_force():
    r = random.Random(14)
    parts = ["word", "Word", "a.", "b,", "12", "!!", "--", "é", "日本", "x" * 25, "\x00", "_", " ", "  ", "\n", "\n\n", "\t", "\x0b", "\x0c", "\r", "\x1c", "same same"]
    texts_ = ["", None, " ", "\n", *("".join(r.choices(parts, k=r.randrange(60))) for _ in range(300))]
    raw = [(t or "").encode() for t in texts_]
    found = quality.statistics_of(np.frombuffer(b"".join(raw), np.uint8), np.append(0, np.cumsum([len(x) for x in raw])))
    for text, row in zip(texts_, found):
        want = brute_statistics(text)
        assert tuple(want) == quality.STATISTICS
        assert np.allclose(row, list(want.values()), rtol=1e-12), text


def test_quality_query_matches_brute_force(spark, tmp_path):
    """Every row's score from its rules in plain Python, and what the scores are worth on labels that were not learned from."""
    r = random.Random(15)
    plain = ["some", "plain", "words", "of", "prose,", "with", "many", "others.", "Here", "and", "there", "7"]
    texts_ = [" ".join(r.choices(plain, k=r.randint(30, 80))) if i % 2 else " ".join(r.choices(["BUY!!", "$$$", "now", "now"], k=r.randint(10, 60))) for i in range(400)] + [None, "", "x"]
    spark.createDataFrame([(i, t, "clash") for i, t in enumerate(texts_)], "doc_id long, text string, score string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, i % 2 if i % 10 else 1 - i % 2) for i in range(400)], "doc_id long, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    fits = quality.fit
    models = []
    quality.fit = lambda rows: models.append(fits(rows)) or models[-1]
    try:
        out = {x["doc_id"]: x for x in queries.op3_quality(spark, str(tmp_path)).collect()}
    finally:
        quality.fit = fits
    (model,) = models
    assert len(out) == len(texts_) and model.rules
    for i, t in enumerate(texts_):
        values = brute_statistics(t)
        total = model.intercept + sum(w for rule, w in model.rules if all((values[n] <= limit) == low for n, low, limit in rule))
        assert abs(out[i]["score"] - 1 / (1 + np.exp(-total))) < 1e-9 and out[i]["predicted"] == int(out[i]["score"] >= 0.3)
        assert out[i]["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0)
    held = [i for i in range(400) if out[i]["held_out"]]
    ranked = [(out[a]["score"] > out[b]["score"]) + (out[a]["score"] == out[b]["score"]) / 2 for a in held if a % 2 for b in held if not b % 2]
    assert sum(ranked) / len(ranked) > 0.99


def test_statistics_of_small_texts():
    raw = b"Ab cd cd\n\nX!! 12"
    values = dict(zip(quality.STATISTICS, quality.statistics_of(np.frombuffer(raw, np.uint8), np.array([0, len(raw), len(raw)]))[0]))
    assert values["n_bytes"] == 16 and values["n_words"] == 5 and values["n_lines"] == 2
    assert values["repeated_word_share"] == 0.2 and values["different_word_share"] == 0.8
    assert abs(values["upper_share"] - 2 / 16) < 1e-12 and abs(values["symbol_share"] - 2 / 16) < 1e-12
    empty = quality.statistics_of(np.zeros(0, np.uint8), np.array([0, 0, 0]))
    assert empty.shape == (2, len(quality.STATISTICS)) and not empty.any()
