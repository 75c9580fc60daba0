"""Secret scan: long key-like strings are candidates; a random forest removes the false positives.

A candidate is a whole run of letters, digits and `_+/-` of 16 characters or more, with up to two closing `=`, that holds a digit, or
a small letter before a capital, or 24 letters on end: names of words joined by `_`, `-` or `/` are none. In a word with `://` a `/` parts
runs, so that no host is taken with its path for a key. All runs of a word are candidates, each numbered in the word; what stands before one
in its word (a name, a path, another candidate) is kept apart from it as its lead.

Features of a candidate: its length; shares of digits and upper-case letters; its changes between kinds of characters; how many of its
letters belong to dictionary words; what the path of its document tells; and its neighbouring words. The forest is trained from
labelled findings, `most_rows` of them at most. Everything is DataFrame functions and spark.ml; no Python runs on executors.

The dictionary is the corpus's own: words of `least_letters` letters or more that stand once in `per_bytes` bytes of all text or more
often. There are per_bytes / (least_letters + 1) such words at most, whatever the corpus, so they are sent to every task.

Defined cases: null or empty texts, and null paths, have no candidates or say nothing; a null doc_id is carried along; repeated
rows are scanned each; a string that stands twice in a text is two candidates, in one word too; without findings of both labels every
candidate gets the share of label 1 (0.5 without any); other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Collection

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from runscope.llm.shared import landed

def run_of(c: str) -> str:
    """A candidate in characters c, as the docstring has it."""
    return rf"(?<!{c})(?={c}{{16}})(?={c}*?[0-9]|{c}*?[a-z][A-Z]|{c}*?[A-Za-z]{{24}}){c}+(?:={{1,2}}(?![A-Za-z0-9_+/=-]))?"


RUN, RUN_IN_URL = run_of("[A-Za-z0-9_+/-]"), run_of("[A-Za-z0-9_+-]")
NAMES = r"(?i)(token|secret|passw|pwd|api_?key|apikey|credential|bearer|auth)"
EXAMPLE_PATH = r"(?i)(test|example|sample|mock|fixture|doc|vendor|\.lock|\.min\.)"
SECRET_PATH = r"(?i)(secret|config|settings|deploy|\.env|\.pem|\.key)"
#: Features that tell how a value is named and put: those that a label taken from the same must do without.
CONTEXT = ("named", "assigned", "quoted")
FEATURES = (
    "n_chars", "digit_share", "upper_share", "different_share", "changes", "digit_letter", "case_changes", "is_hex", "word_cover", "path_depth", "path_example", "path_secret",
    *CONTEXT, "after_number", "before_word", "known_before", "known_after",
)


def candidates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", path: str = "source") -> DataFrame:
    """(doc_id, path, word, part, candidate, lead, before2, before1, after1): word: its number in the text, part: the candidate's in the word, from 0.

    lead: what stands in the word before the candidate.
    """
    words = F.split(F.trim(F.regexp_replace(F.col(text), r"\s+", " ")), " ")
    own = docs.filter(F.length(text) >= 16).select(F.col(doc_id).alias("doc_id"), F.col(path).alias("path"), words.alias("words"))
    found = F.filter(F.transform("words", lambda w, i: F.struct(i.alias("word"), w.alias("token"))), lambda x: (F.length(x["token"]) >= 16) & x["token"].rlike(RUN_IN_URL + "|" + RUN))
    near = lambda x, k: F.coalesce(F.get("words", x["word"] + k), F.lit(""))
    # neighbours are looked up before the explode, so that no row carries a whole text
    with_near = F.transform(found, lambda x: F.struct(x["word"].alias("word"), x["token"].alias("token"), near(x, -2).alias("before2"), near(x, -1).alias("before1"), near(x, 1).alias("after1")))
    rows = own.select("doc_id", "path", F.explode(with_near).alias("at")).select("doc_id", "path", "at.*")
    # the word is cut behind each candidate; a lookbehind sees only its own piece, which begins where a run has ended
    is_url = F.col("token").contains("://")
    cut = lambda run: F.regexp_extract_all("token", F.lit(f"(?s).*?{run}"), F.lit(0))
    pieces = F.when(is_url, cut(RUN_IN_URL)).otherwise(cut(RUN))
    rows = rows.withColumns({"pieces": pieces, "is_url": is_url}).select("doc_id", "path", "word", F.posexplode("pieces").alias("part", "piece"), "pieces", "is_url", "before2", "before1", "after1")
    last = lambda run: F.regexp_extract("piece", f"({run})$", 1)
    rows = rows.withColumn("candidate", F.when(F.col("is_url"), last(RUN_IN_URL)).otherwise(last(RUN)))
    before = F.concat(F.array_join(F.slice("pieces", 1, F.col("part")), ""), F.expr("left(piece, length(piece) - length(candidate))"))
    return rows.select("doc_id", "path", "word", "part", "candidate", before.alias("lead"), "before2", "before1", "after1")


def dictionary(docs: DataFrame, text: str = "text", least_letters: int = 3, per_bytes: int = 500_000) -> DataFrame:
    """(known): the corpus's common words, in lower case."""
    least = (docs.agg(F.sum(F.octet_length(text))).first()[0] or 0) / per_bytes
    letters = docs.select(F.explode(F.split(F.lower(F.col(text)), r"[^\p{L}]+")).alias("known"))
    counts = letters.filter(F.length("known").between(least_letters, 40)).groupBy("known").count()
    return counts.filter(F.col("count") >= max(2.0, least)).select("known")


def features(found: DataFrame, words: DataFrame) -> DataFrame:
    """candidates with FEATURES; words: a bounded table (known)."""
    c = F.col("candidate")
    n = F.length(c)
    share = lambda pattern: F.regexp_count(c, F.lit(pattern)) / n
    before = F.concat_ws(" ", "before2", "before1", "lead")
    path = F.coalesce("path", F.lit(""))
    # written once: both sides of the join below then see the same numbers
    numbered = landed(found.withColumn("_n", F.monotonically_increasing_id()), "secret-candidates")
    rows = numbered.withColumns({
        "n_chars": n.cast("double"),
        "digit_share": share("[0-9]"),
        "upper_share": share("[A-Z]"),
        "different_share": F.size(F.array_distinct(F.split(c, ""))) / n,
        "changes": share("[0-9](?=[^0-9])|[A-Z](?=[^A-Z])|[a-z](?=[^a-z])"),
        "digit_letter": share("[0-9](?=[A-Za-z])|[A-Za-z](?=[0-9])"),
        "case_changes": share("[a-z](?=[A-Z])|[A-Z](?=[a-z])"),
        "is_hex": c.rlike("^[0-9a-fA-F]+$").cast("double"),
        "path_depth": F.regexp_count(path, F.lit("/")).cast("double"),
        "path_example": path.rlike(EXAMPLE_PATH).cast("double"),
        "path_secret": path.rlike(SECRET_PATH).cast("double"),
        "named": before.rlike(NAMES).cast("double"),
        "assigned": F.when(F.col("lead").rlike("^[\"'`]?$"), F.col("before1")).otherwise(F.col("lead")).rlike("[=:][\"'`]?$").cast("double"),
        "quoted": F.col("lead").rlike("[\"'`]$").cast("double"),
        "after_number": F.col("before1").rlike("^[0-9]+$").cast("double"),
        "before_word": F.col("after1").rlike(r"^\p{L}+$").cast("double"),
    })
    # the candidate's runs of letters and the two words around it are looked up together, in a table of bounded size
    runs = F.expr("transform(filter(split(lower(candidate), '[^a-z]+'), x -> length(x) >= 3), x -> struct(x as part, 'cover' as kind))")
    near = F.array(*[F.struct(F.regexp_extract(F.lower(w), r"(\p{L}+)", 1).alias("part"), F.lit(k).alias("kind")) for w, k in (("before1", "before"), ("after1", "after"))])
    parts = numbered.select("_n", F.explode(F.concat(runs, near)).alias("at")).select("_n", "at.*")
    hits = parts.join(F.broadcast(words), F.col("part") == F.col("known"))
    seen = lambda kind: F.max(F.when(F.col("kind") == kind, 1.0))
    cover = hits.groupBy("_n").agg(F.sum(F.when(F.col("kind") == "cover", F.length("part"))).alias("covered"), seen("before").alias("known_before"), seen("after").alias("known_after"))
    out = rows.join(cover, "_n", "left").withColumn("word_cover", F.coalesce("covered", F.lit(0)) / n)
    return out.withColumns({k: F.coalesce(k, F.lit(0.0)) for k in ("known_before", "known_after")}).drop("_n", "covered")


def score(
    found: DataFrame, findings: DataFrame, label: Column, without: Collection[str] = (), most_rows: int = 20_000, trees: int = 20, depth: int = 5, seed: int = 3
) -> DataFrame:
    """found (with FEATURES) with a column score: how likely a candidate is a secret. findings: labelled rows with FEATURES; label: 0 or 1.

    without: features that the forest does not get, such as those that the label was taken from.
    """
    names = [n for n in FEATURES if n not in without]
    order = F.xxhash64("doc_id", "word", "part", "candidate")
    sample = landed(findings.select(*names, label.cast("double").alias("label"), order.alias("_o")).filter("label is not null").orderBy("_o").limit(most_rows), "findings")
    counts = {r["label"]: r["count"] for r in sample.groupBy("label").count().collect()}
    if len(counts) < 2:
        share = 0.5 if not counts else float(next(iter(counts)))
        return found.withColumn("score", F.lit(share))
    assemble = VectorAssembler(inputCols=names, outputCol="_features")
    model = RandomForestClassifier(featuresCol="_features", numTrees=trees, maxDepth=depth, seed=seed).fit(assemble.transform(sample))
    scored = model.setRawPredictionCol("").setPredictionCol("").setProbabilityCol("_probability").transform(assemble.transform(found))
    return scored.withColumn("score", vector_to_array("_probability")[1]).drop("_features", "_probability")


def scan(
    docs: DataFrame, label: Column, use: Column | None = None, without: Collection[str] = (), doc_id: str = "doc_id", text: str = "text", path: str = "source", least: float = 0.5
) -> DataFrame:
    """All candidates with FEATURES, score and is_secret. label: of a candidate, from its columns and features; use: which train; without: as for score."""
    found = landed(features(candidates(docs, doc_id, text, path), dictionary(docs, text)), "secret-features")
    return score(found, found.filter(use) if use is not None else found, label, without).withColumn("is_secret", F.col("score") >= least)


def held_out(scanned: DataFrame, label: Column, use: Column) -> DataFrame:
    """One row: precision and recall of is_secret against the labels of findings that did not train, and how many there are."""
    own = scanned.filter(~use).select((label == 1).alias("label"), "is_secret")
    hit = F.count_if(F.col("label") & F.col("is_secret"))
    return own.agg(F.count("*").alias("n"), F.try_divide(hit, F.count_if("is_secret")).alias("precision"), F.try_divide(hit, F.count_if("label")).alias("recall"))
