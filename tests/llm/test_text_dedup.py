"""Suffix-array, substring and line dedup against brute force."""

import dataclasses
import hashlib
import random
import types

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from runscope.llm import arrays as A
from runscope.llm import line_dedup, repeats, substrings, suffixes

BLANKS = " \t\n\x0b\x0c\r"
SCHEMA = "doc_id long, text string, n_removed string"


def corpus(seed: int) -> list[tuple[int | None, str | None]]:
    """Random texts with shared passages, copies, nulls, long repeats and ties."""
    r = random.Random(seed)
    words = ["ab", "b", "cde", "é", "日本", "a" * 30] + [f"w{i}" for i in range(300)]
    passages = [" ".join(r.choices(words, k=r.randint(40, 120))) for _ in range(6)]
    out: list[tuple[int | None, str | None]] = []
    for i in range(60):
        parts = [" ".join(r.choices(words, k=r.randint(0, 80)))]
        if r.random() < 0.5:
            parts.append(r.choice(passages)[r.randint(0, 30) :])
            parts.append(" ".join(r.choices(words, k=r.randint(0, 60))))
        out.append((r.randint(0, 10**6), r.choice(["\n", "  ", "\t", " "]).join(parts)))
    out += [(5, None), (6, ""), (7, "of " * 400), (8, "x" * 900), (9, "abcdefg" * 120), (None, passages[0] + " end"), (None, "alone")]
    out += [out[0], out[1], (10**7, out[2][1]), (11, passages[1]), (11, passages[2])]  # repeated rows, copies, one id for two texts
    r.shuffle(out)
    return out


def order(doc):
    return repeats.LAST_ID if doc is None else doc


def brute_words(rows, width=50):
    least: dict[tuple, int] = {}
    split = [(text or "").encode().split() for _, text in rows]
    for (doc, _), words in zip(rows, split):
        for i in range(len(words) - width + 1):
            w = tuple(words[i : i + width])
            least[w] = min(order(doc), least.get(w, order(doc)))
    out = []
    for (doc, _), words in zip(rows, split):
        gone = set()
        for i in range(len(words) - width + 1):
            if least[tuple(words[i : i + width])] < order(doc):
                gone |= set(range(i, i + width))
        kept = b" ".join(w for i, w in enumerate(words) if i not in gone)
        out.append((doc, len(words), len(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def brute_bytes(rows, width=200):
    times: dict[bytes, int] = {}
    texts = [(text or "").encode() for _, text in rows]
    for t in texts:
        for i in range(len(t) - width + 1):
            times[t[i : i + width]] = times.get(t[i : i + width], 0) + 1
    out = []
    for (doc, _), t in zip(rows, texts):
        gone = np.zeros(len(t) + 1, bool)
        for i in range(len(t) - width + 1):
            if times[t[i : i + width]] > 1:
                gone[i : i + width] = True
        spans = int((gone[1:] & ~gone[:-1]).sum() + gone[0]) if len(t) else 0
        kept = bytes(b for b, g in zip(t, gone) if not g)
        out.append((doc, len(t), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("parts", [1, 7])
def test_substrings_match_brute_force(spark, parts, monkeypatch):
    monkeypatch.setattr(repeats, "BUCKET_BYTES", 20_000)
    rows = corpus(parts)
    docs = spark.createDataFrame([(d, t, "clash") for d, t in rows], SCHEMA).repartition(parts)
    out = substrings.dedup(docs, F.col("doc_id"), "long").select("row", "n_words", "n_removed", "kept_sha256").collect()
    assert sorted(map(tuple, out), key=str) == brute_words(rows)


@pytest.mark.parametrize("parts", [1, 7])
def test_suffixes_match_brute_force(spark, parts, monkeypatch):
    monkeypatch.setattr(repeats, "BUCKET_BYTES", 20_000)
    rows = corpus(parts + 50)
    docs = spark.createDataFrame([(d, t, "clash") for d, t in rows], SCHEMA).repartition(parts)
    out = suffixes.dedup(docs, F.col("doc_id"), "long").select("row", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect()
    assert sorted(map(tuple, out), key=str) == brute_bytes(rows)


def test_empty_tables(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert substrings.dedup(empty, F.col("doc_id"), "long").count() == 0
    assert suffixes.dedup(empty, F.col("doc_id"), "long").count() == 0
    assert line_dedup.drop_repeated(empty, line_dedup.LineStore.of(empty), F.col("doc_id"), "long").count() == 0


def test_multikey_sort_orders_suffixes():
    r = np.random.default_rng(1)
    text = r.integers(97, 99, 400).astype(np.uint8)
    text = np.concatenate([text, text[50:300], text[:100]])
    at = np.arange(0, len(text) - 40, 3)
    order_, shared = suffixes.multikey_sort(text, at, 40)
    raw = text.tobytes()
    strings = [raw[i : i + 40] for i in at[order_]]
    assert strings == sorted(strings)
    for i in range(1, len(strings)):
        same = next((k for k in range(40) if strings[i][k] != strings[i - 1][k]), 40)
        assert shared[i] == same


def test_long_rows_are_cut_with_overlap():
    text = np.frombuffer(b"word " * 5000, np.uint8)
    for by_word, width in ((True, 50), (False, 200)):
        cuts = list(repeats.pieces(text, np.array([0, len(text)]), width, by_word, most=4000))
        count = 5000 if by_word else len(text)
        starts = set()
        for part, _, first in cuts:
            units = len(part.tobytes().split()) if by_word else len(part)
            own = set(range(first, first + units - width + 1))
            assert not own & starts
            starts |= own
        assert starts == set(range(count - width + 1))


def test_colliding_hashes_join_no_contents(monkeypatch):
    text = np.frombuffer(b"a b c d e f a b c d e f", np.uint8)
    units = repeats.Units(text, np.array([0, 11, len(text)]), True)
    runs = repeats.Runs(np.array([0, 6]), np.array([4, 4]), np.array([7, 7], np.uint64), np.array([0, 6]))
    want = {frozenset((i, i + 4)) for i in range(4)}
    for collide in (False, True):
        if collide:
            monkeypatch.setattr(units, "hashes", lambda width: np.zeros(10, np.uint64))
        window, number = repeats.hashed_classes(3)(units, runs)
        assert {frozenset(window[number == n].tolist()) for n in set(number.tolist())} == want


def thue_morse(n: int) -> str:
    return "".join("ab"[i.bit_count() % 2] for i in range(n))


@pytest.mark.parametrize("parts", [1, 2])
def test_words_that_fool_polynomial_hashes(spark, parts):
    # sums modulo 2^64 of powers of any odd number are the same for both words
    word = thue_morse(2048)
    other = word.translate(str.maketrans("ab", "ba"))
    shared = [f"w{i}" for i in range(49)]
    rows = [(1, " ".join([*shared, word])), (2, " ".join([*shared, other])), (3, " ".join([*shared, word])), (4, "xy " * 30 + word + " " + other + "!" * 90), (5, word + " " + other + "!" * 90)]
    docs = spark.createDataFrame([(d, t, "clash") for d, t in rows], SCHEMA).repartition(parts)
    words = substrings.dedup(docs, F.col("doc_id"), "long").select("row", "n_words", "n_removed", "kept_sha256").collect()
    assert sorted(map(tuple, words), key=str) == brute_words(rows)
    found = suffixes.dedup(docs, F.col("doc_id"), "long").select("row", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect()
    assert sorted(map(tuple, found), key=str) == brute_bytes(rows)


@pytest.mark.parametrize("slots, kept", [(1 << 19, 16 << 20), (1 << 4, 1 << 20), (1 << 19, 3000)])
def test_remembered_windows_are_compared_by_their_bytes(monkeypatch, slots, kept):
    """Repeated windows come back in later slices of a task, some displaced, and all with one hash of a few bits."""
    r = random.Random(slots + kept)
    passages = ["".join(r.choices("abcdefgh ", k=450)) for _ in range(3)]
    rows = [(r.randrange(50), r.choice(passages)[r.randrange(100) :] + "".join(r.choices("abc", k=r.randrange(40)))) for _ in range(60)]
    hashes = A.window_hashes
    monkeypatch.setattr(A, "window_hashes", lambda values, width, kind=0: hashes(values, width, kind) & np.uint64(0xFF << 56) if width == 200 else hashes(values, width, kind))
    seen_of = repeats.Seen
    monkeypatch.setattr(repeats, "Seen", lambda width: seen_of(width, slots, kept))
    monkeypatch.setattr(repeats, "SLICE", 2000)
    how = repeats.How(200, 16, False, False, suffixes.suffix_classes(200), lambda units, key, anchor: np.zeros(len(key), np.int64))
    sent = types.SimpleNamespace(value=repeats.Hot(np.zeros(0, np.uint64)))
    batch = pa.RecordBatch.from_arrays([pa.array([d for d, _ in rows]), pa.array(range(60)), pa.array([t.encode() for _, t in rows])], names=["doc", "mark", "text"])
    gone = [np.zeros(len(t) + 1, bool) for _, t in rows]
    for out in repeats._send(how, sent, 1)(iter([batch])):
        blobs = out.column("blob").drop_null()
        found = [out.filter(out.column("blob").is_null()).select(["doc", "mark", "start", "windows"])]
        if len(blobs):
            head, begin, text = repeats.opened(blobs)
            token = repeats.characters(text)[begin + head["anchor"]].astype(np.uint64)
            found += [repeats.as_rows(own, *repeats.removed_windows(how, own, at, text)) for own, at in repeats.token_parts(head, begin, token, 1 << 20)]
        for x in (x for f in found for x in f.to_pylist()):
            gone[x["mark"]][x["start"] : x["start"] + x["windows"] + 199] = True
    want = {d: (n, s) for (d, _, n, s, _), n, s in ((x, x[2], x[3]) for x in brute_bytes([(i, t) for i, (_, t) in enumerate(rows)]))}
    assert {i: (int(g.sum()), int((g[1:] & ~g[:-1]).sum() + g[0])) for i, g in enumerate(gone)} == want


def test_hot_grams_lose_to_their_surroundings(spark, monkeypatch):
    monkeypatch.setattr(repeats, "BUCKET_BYTES", 8_000)
    r = random.Random(4)
    line = "this very common line stands in each of the documents here"
    words = lambda: " ".join("".join(r.choices("abcdefghij", k=6)) for _ in range(120))
    rows = [(i, f"{words()} {line} {words()}") for i in range(150)] + [(100, None), (101, "")]
    rows += [(200 + i, rows[i][1]) for i in range(5)]
    docs = spark.createDataFrame([(d, t, "clash") for d, t in rows], SCHEMA).repartition(3)
    for op, brute, names, how in (
        (suffixes, brute_bytes, ("n_bytes", "n_removed", "n_spans"), repeats.How(200, 16, False, False, suffixes.suffix_classes(200), None)),
        (substrings, brute_words, ("n_words", "n_removed"), repeats.How(50, 5, True, True, repeats.hashed_classes(50), None)),
    ):
        hot = repeats.hot_grams(how, repeats.Sizes.of(docs, "text"), 1)
        assert len(hot.value.grams)
        out = op.dedup(docs, F.col("doc_id"), "long").select("row", *names, "kept_sha256").collect()
        assert sorted(map(tuple, out), key=str) == brute(rows)


def test_the_order_of_suffixes_decides(spark, monkeypatch):
    rows = corpus(3)
    docs = spark.createDataFrame([(d, t, "clash") for d, t in rows], SCHEMA).repartition(2)
    unsorted = lambda text, at, depth: (np.arange(len(at)), np.zeros(len(at), np.int64))
    part = pa.RecordBatch.from_arrays([pa.array([t or "" for _, t in rows])], names=["text"])
    how = repeats.How(200, 16, False, False, suffixes.suffix_classes(200), None)
    units = next(how.slices(part))[0]
    runs = how.runs(units, repeats.Hot(np.zeros(0, np.uint64)))
    assert len(how.classes(units, runs)[0]) > 1000
    monkeypatch.setattr(suffixes, "multikey_sort", unsorted)
    assert len(how.classes(units, runs)[0]) == 0


def test_blank_texts_have_no_parts():
    assert list(repeats.pieces(np.full(3 << 20, 0x20, np.uint8), np.array([0, 3 << 20]), 50, True)) == []


def brute_lines(rows, least=10):
    def key(line):
        k = line.strip(BLANKS).translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
        return k if len(k) >= least else None

    docs: dict[str, set] = {}
    for doc, text in rows:
        for line in (text or "").split("\n"):
            if (k := key(line)) is not None:
                docs.setdefault(k, set()).add(order(doc))
    out = []
    for doc, text in rows:
        own = (text or "").split("\n")
        stay = [x for x in own if key(x) is None or min(docs[key(x)]) >= order(doc)]
        out.append((doc, len(own), len(own) - len(stay), hashlib.sha256("\n".join(stay).encode()).hexdigest()))
    return sorted(out, key=str)


LINES = [
    (1, "Same long line here\nshort\n  SAME LONG line here  "), (2, "same LONG line here\nother text of two"), (3, "short\nother text of two\n\n"), (3, "short\nother text of two\n\n"),
    (4, None), (5, ""), (None, "same long line here\nonly in the null"), (6, "ééééééééé1\nééééééééé"), (7, "ééééééééé1\nééééééééé\nÉÉÉÉÉÉÉÉÉ1"), (8, "\x0bonly in the null\x0c"), (9, "\n\n"),
]


def lines_of(docs, store):
    out = line_dedup.drop_repeated(docs, store, F.col("doc_id"), "long").select("row", "n_lines", "n_dropped", "kept_sha256")
    return sorted(map(tuple, out.collect()), key=str)


def test_lines_match_brute_force(spark):
    docs = spark.createDataFrame([(d, t, "clash") for d, t in LINES], SCHEMA)
    assert lines_of(docs, line_dedup.LineStore.of(docs)) == brute_lines(LINES)


@pytest.mark.parametrize("shard_keys, group_bytes, least", [(1, 30, 10_000), (2, 1 << 20, 2), (100_000, 7, 3)])
def test_lines_in_shards_salts_and_heavy_keys(spark, monkeypatch, shard_keys, group_bytes, least):
    heavy, found = line_dedup.heavy_keys, line_dedup.repeats
    monkeypatch.setattr(line_dedup, "heavy_keys", lambda store: heavy(store, least=least))
    monkeypatch.setattr(line_dedup, "repeats", lambda *x: found(*x, group_bytes=group_bytes))
    docs = spark.createDataFrame([(d, t, "clash") for d, t in LINES], SCHEMA).repartition(3)
    store = line_dedup.LineStore.of(docs, shard_keys=shard_keys)
    assert (store.shards > 1) == (shard_keys < 10) and (len(line_dedup.heavy_keys(store)) > 0) == (least < 10)
    assert lines_of(docs, store) == brute_lines(LINES)


def state(store):
    """All that a store holds now: references, counts, and which keys its filters know."""
    refs = {tuple(r) for r in store.live_refs().collect()}
    repeated = {tuple(r) for r in store.live_repeated().collect()}
    filters = {r["shard"]: line_dedup.CuckooFilter.read(bytes(r["filter"])) for r in store.live_filters().collect()}
    for hi, lo, *_ in repeated:
        at = np.array([hi]), np.array([lo])
        assert filters[int(line_dedup.shard_of(at[0], store.shards)[0])].contains(*at)[0]
    assert store.keys == len(repeated)
    return refs, repeated, sum(int((f.table > 0).sum()) for f in filters.values())


def test_line_store_is_reversible(spark):
    make = lambda rows: spark.createDataFrame([(d, t, "clash") for d, t in rows], SCHEMA)
    first, later = LINES[:4], LINES[4:]
    store = line_dedup.LineStore.of(make(first), shard_keys=1)
    grown = store.insert(make(later))
    assert lines_of(make(LINES), grown) == brute_lines(LINES)
    whole = line_dedup.LineStore.of(make(LINES), shard_keys=1)
    assert state(grown) == state(whole)
    assert state(grown.insert(make(later[:3]))) == state(whole)  # what is there already counts once
    shrunk = grown.delete(make(later))
    assert lines_of(make(first), shrunk) == brute_lines(first)
    assert state(shrunk) == state(store)


def test_line_store_over_many_batches(spark):
    r = random.Random(3)
    make = lambda rows: spark.createDataFrame([(d, t, "clash") for d, t in rows], SCHEMA)
    rows = [(i, "\n".join(f"line number {r.randrange(12)}" for _ in range(4))) for i in range(24)]
    store = dataclasses.replace(line_dedup.LineStore.of(make(rows[:2]), shard_keys=2), most_batches=3)
    for at in range(2, 24, 6):
        store = store.insert(make(rows[at : at + 6]))
    store = store.delete(make(rows[:5] + rows[20:]))
    left = rows[5:20]
    assert store.version == 5 and store.shards > 1  # written anew once, and doubled
    want = line_dedup.LineStore.of(make(left))
    assert state(store)[:2] == state(want)[:2] and lines_of(make(left), store) == brute_lines(left)


def test_references_are_counted_once_for_each_document(spark):
    docs = spark.createDataFrame([(1, "a shared long line", ""), (1, "a shared long line\nmore", ""), (2, "a shared long line", ""), (None, "a shared long line", ""), (None, "a shared long line\n", "")], SCHEMA).repartition(4)
    assert [(r["n"], r["first_doc"]) for r in line_dedup.LineStore.of(docs).live_repeated().collect()] == [(3, 1)]


def test_cuckoo_filter():
    r = np.random.default_rng(5)
    hi, lo = (r.integers(-(2**63), 2**63 - 1, 5000) for _ in range(2))
    own = line_dedup.CuckooFilter.of(hi[:4000], lo[:4000])
    assert own.contains(hi[:4000], lo[:4000]).all()
    assert own.contains(hi[4000:], lo[4000:]).mean() < 0.01
    own.delete(hi[:2000], lo[:2000])
    again = line_dedup.CuckooFilter.read(own.blob())
    assert again.contains(hi[2000:4000], lo[2000:4000]).all()
    assert again.contains(hi[:2000], lo[:2000]).mean() < 0.01


def test_splitters_are_as_many_as_ranges(spark):
    """Edges of far more ranges than the driver would want numbers of a sample for; bits of the numbers are unsigned."""
    import numpy as np
    from pyspark.sql import functions as F

    from runscope.llm import suffixes

    leads = spark.range(0, 1_000_000, 1, 8).select(F.xxhash64("id").alias("lead"))
    edges = suffixes.parted(leads, 300_000)
    assert len(edges) == 299_999 and (edges[1:] >= edges[:-1]).all()
    every = np.sort(np.array([r[0] for r in leads.collect()], np.int64).view(np.uint64))
    sizes = np.diff(np.concatenate([[0], np.searchsorted(every, edges), [len(every)]]))
    assert sizes.min() >= 3 and sizes.max() <= 4
    few = suffixes.parted(spark.createDataFrame([(1,), (1,), (1,), (-1,)], "lead long"), 2)
    assert few.tolist() == [1] and suffixes.parted(leads.limit(0), 5).tolist() == []
