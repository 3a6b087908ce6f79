"""Secret scans: a random forest that tells secrets from the words and numbers that look like them.

A candidate is a run of at least SHORTEST letters, digits and the marks of base64 and identifiers. Its features are its
length, its character transitions, how much of it the corpus' own dictionary covers, its path, and the words next to
it. The forest is trained on labelled findings. DataFrame operations and Spark's own machine learning only.

Missing and empty texts have no candidates. A missing path counts as an empty one. Rows that share a doc_id are scanned
each by itself; a missing doc_id is kept. Findings without both kinds of labels train no forest: every score is then the
mean label (0 without any).
"""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm.common import stored

SHORTEST = 16
#: Labelled findings the forest is fitted on, for each label: those with the least hash.
SAMPLE = 6_000
#: A word is in the dictionary if the corpus has it so often; its runs of PIECE letters are what candidates are held against.
FREQUENT, PIECE, LONGEST_WORD = 5, 3, 15
TREES, DEPTH = 40, 6
_RUN = r"[A-Za-z0-9_+/-]{%d,}={0,2}"
#: Words that name a secret, and folders that hold made-up ones.
NAMES = r"(?i)(token|secret|passw|pwd|api.?key|access.?key|credential|auth)"
MADE_UP = r"(?i)(test|example|sample|mock|fixture|doc|demo)"

FEATURES = [
    "length", "runs", "digit_share", "upper_share", "mark_share", "vowel_turns", "consonant_pairs", "digit_pairs", "letter_digit",
    "case_turns", "hex_share", "coverage", "commonness", "path_made_up", "path_depth", "before_named", "before_sign",
    "quoted", "before_odds", "after_odds",
]


def candidates(docs: DataFrame, path: str = "source", shortest: int = SHORTEST) -> DataFrame:
    """doc_id, at, candidate, before, before2, lead, trail, after, path: one row for each candidate.

    at: the number of its word in the text; lead and trail: what stands in the same word around it.
    """
    pattern = _RUN % shortest
    tokens = F.split(F.coalesce("text", F.lit("")), r"\s+")
    where = F.filter(
        F.sequence(F.lit(0), F.size("w") - 1), lambda i: (F.length(F.get(F.col("w"), i)) >= shortest) & F.rlike(F.get(F.col("w"), i), F.lit(pattern))
    )
    word = lambda i: F.coalesce(F.get(F.col("w"), i), F.lit(""))
    near = F.transform(
        where,
        lambda i: F.struct(
            i.alias("at"), word(i).alias("word"), F.when(i > 0, word(i - 1)).otherwise("").alias("before"),
            F.when(i > 1, word(i - 2)).otherwise("").alias("before2"), word(i + 1).alias("after"),
        ),
    )
    place = F.coalesce(F.col(path), F.lit("")) if path in docs.columns else F.lit("")
    found = (
        docs.select("doc_id", place.cast("string").alias("path"), tokens.alias("w"))
        .select("doc_id", "path", F.explode(near).alias("n"))
        .select("doc_id", "path", "n.*")
        .select("*", F.posexplode(F.regexp_extract_all("word", F.lit(pattern), F.lit(0))).alias("part", "candidate"))
    )
    begin = F.instr(F.col("word"), F.col("candidate"))
    return found.select(
        "doc_id", "path", "at", "part", "candidate", "before", "before2", "after",
        F.substring("word", F.lit(1), begin - 1).alias("lead"), F.substring("word", begin + F.length("candidate"), F.length("word")).alias("trail"),
    )


def dictionary(docs: DataFrame) -> DataFrame:
    """piece, weight: runs of PIECE letters in the words that the whole corpus has FREQUENT times; at most 26^PIECE rows."""
    words = docs.select(F.explode(F.split(F.lower(F.coalesce("text", F.lit(""))), "[^a-z]+")).alias("word"))
    size = F.length("word")
    common = words.filter((size >= PIECE) & (size <= LONGEST_WORD)).groupBy("word").count().filter(F.col("count") >= FREQUENT)
    starts = F.sequence(F.lit(1), F.length("word") - PIECE + 1)
    pieces = common.select("count", F.explode(F.transform(starts, lambda i: F.substring("word", i, F.lit(PIECE)))).alias("piece"))
    return pieces.groupBy("piece").agg(F.log1p(F.sum("count")).alias("weight"))


def _odds(findings: DataFrame, column: str) -> DataFrame:
    """Log-odds of a neighbouring word among the labelled findings; at most as many rows as those."""
    totals = findings.agg(F.sum("label").alias("p"), F.count("*").alias("n")).first()
    p, n = float(totals["p"] or 0), float(totals["n"] or 0)
    grouped = findings.groupBy(column).agg(F.sum("label").alias("y"), F.count("*").alias("c"))
    value = F.log((F.col("y") + 1) / (p + 2)) - F.log((F.col("c") - F.col("y") + 1) / (n - p + 2))
    return grouped.filter("c > 1").select(column, value.alias(f"{column}_odds"))


def measured(found: DataFrame, pieces: DataFrame, before: DataFrame, after: DataFrame) -> DataFrame:
    """The candidates with their features. All three tables are bounded: by 26^PIECE, and by the labelled findings."""
    c = F.col("candidate")
    n = F.length(c).cast("double")
    count = lambda pattern: (n - F.length(F.regexp_replace(c, pattern, ""))).cast("double")
    kinds = F.col("kinds")
    turns = lambda pattern: F.size(F.regexp_extract_all(kinds, F.lit(pattern), F.lit(0))) / n
    shape = F.translate(
        F.regexp_replace(F.regexp_replace(c, "[AEIOU]", "V"), "[B-DF-HJ-NP-TW-Z]", "C"),
        "aeioubcdfghjklmnpqrstvwxyz0123456789_+/-=", "vvvvvkkkkkkkkkkkkkkkkkkkkkdddddddddd.....",
    )
    out = (
        found.withColumn("kinds", shape)
        .withColumn("length", n)
        .withColumn("runs", F.length(F.regexp_replace("kinds", r"(.)\1+", "$1")) / n)
        .withColumn("digit_share", count("[0-9]") / n)
        .withColumn("upper_share", count("[A-Z]") / n)
        .withColumn("mark_share", count("[_+/=-]") / n)
        .withColumn("hex_share", count("[0-9a-fA-F]") / n)
        .withColumn("vowel_turns", turns("(?=(?:vk|kv|VC|CV))."))
        .withColumn("consonant_pairs", turns("(?=(?:kk|CC))."))
        .withColumn("digit_pairs", turns("(?=dd)."))
        .withColumn("letter_digit", turns("(?=(?:d[vkVC]|[vkVC]d))."))
        .withColumn("case_turns", turns("(?=(?:[vk][VC]|[VC][vk]))."))
        .withColumn("path_made_up", F.col("path").rlike(MADE_UP).cast("double"))
        .withColumn("path_depth", F.size(F.split("path", "/")).cast("double"))
        .withColumn("before_named", F.concat_ws(" ", "before2", "before", "lead").rlike(NAMES).cast("double"))
        .withColumn("before_sign", F.concat(F.col("before"), F.col("lead")).rlike("[=:]").cast("double"))
        .withColumn("quoted", F.col("lead").rlike("[\"'`]$").cast("double"))
        .withColumn("near_before", F.lower(F.when(F.col("before").rlike("[A-Za-z]"), F.col("before")).otherwise(F.col("before2"))))
        .withColumn("near_after", F.lower("after"))
        .join(F.broadcast(before), "near_before", "left")
        .join(F.broadcast(after), "near_after", "left")
        .withColumn("before_odds", F.coalesce("near_before_odds", F.lit(0.0)))
        .withColumn("after_odds", F.coalesce("near_after_odds", F.lit(0.0)))
        .drop("near_before", "near_after", "near_before_odds", "near_after_odds", "kinds")
    )
    # Each candidate's pieces are looked up and summed where they are: equal keys stand together, so the partial
    # aggregate leaves one row per candidate to shuffle. Equal candidates share one lookup.
    lower = F.lower("candidate")
    starts = F.sequence(F.lit(1), F.length("candidate") - PIECE + 1)
    looked = (
        found.select("candidate")
        .distinct()
        .select("candidate", F.explode(F.transform(starts, lambda i: F.substring(lower, i, F.lit(PIECE)))).alias("piece"))
        .join(F.broadcast(pieces), "piece", "left")
        .groupBy("candidate")
        .agg(F.avg(F.col("weight").isNotNull().cast("double")).alias("coverage"), F.avg(F.coalesce("weight", F.lit(0.0))).alias("commonness"))
    )
    # From a table, so that a candidate many documents have can be split between tasks.
    return out.join(stored(looked, "looked-up"), "candidate")


def weak_label(found: DataFrame) -> Column:
    """1 where the form alone gives a secret away, as a person labelling findings would read it; 0 otherwise."""
    key_id = F.col("candidate").rlike(r"^AKIA[0-9A-Z]{16}$")
    form = F.col("candidate").rlike(r"^([0-9a-f]{16,64}|[0-9A-F]{16,64})$")
    code = form & F.col("candidate").rlike("[0-9]") & F.col("candidate").rlike("[a-fA-F]")
    assigned = F.concat_ws(" ", "before2", "before", "lead").rlike(r"(?i)(token|secret|password|key)\s*[=:]\s*[\"']?$")
    return (key_id | code & assigned).cast("int")


def findings_sample(findings: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """At most `sample` findings of each label: those with the least hash."""
    order = [F.xxhash64("doc_id", "at", "part"), "doc_id", "at", "part"]
    parts = [findings.filter(F.col("label") == k).orderBy(*order).limit(sample) for k in (0, 1)]
    return parts[0].unionByName(parts[1])


def _near(findings: DataFrame) -> DataFrame:
    return findings.withColumn(
        "near_before", F.lower(F.when(F.col("before").rlike("[A-Za-z]"), F.col("before")).otherwise(F.col("before2")))
    ).withColumn("near_after", F.lower("after"))


def scan(found: DataFrame, findings: DataFrame, pieces: DataFrame) -> DataFrame:
    """The candidates with `score` and `is_secret`, by a forest trained on findings: candidates with a 0/1 `label`."""
    labelled = stored(_near(findings_sample(findings)), "findings")
    counts = {r["label"]: r["count"] for r in labelled.groupBy("label").count().collect()}
    before, after = (stored(_odds(labelled, c), c) for c in ("near_before", "near_after"))
    rows = measured(found, pieces, before, after)
    if len(counts) < 2:
        score = F.lit(float(counts.get(1, 0) > 0))
        return rows.withColumn("score", score).withColumn("is_secret", score >= 0.5)
    into = VectorAssembler(inputCols=FEATURES, outputCol="features", handleInvalid="keep")
    train = stored(measured(labelled.drop("near_before", "near_after"), pieces, before, after), "training")
    forest = RandomForestClassifier(labelCol="label", numTrees=TREES, maxDepth=DEPTH, seed=7).fit(into.transform(train))
    scored = forest.transform(into.transform(rows)).withColumn("score", vector_to_array("probability")[1])
    return scored.withColumn("is_secret", F.col("score") >= 0.5)


def find(docs: DataFrame, held_out: Column) -> DataFrame:
    """doc_id, at, part, candidate_sha256, length, labelled, held_out, score, is_secret for every candidate.

    Findings of documents that are not held out are labelled by their form and train the forest.
    """
    found = stored(candidates(docs), "candidates")
    pieces = stored(dictionary(docs), "dictionary")
    labelled = found.withColumn("label", weak_label(found)).filter(~held_out)
    scored = scan(found, labelled, pieces)
    return scored.select(
        "doc_id", "at", "part", F.sha2("candidate", 256).alias("candidate_sha256"), F.col("length").cast("long").alias("length"),
        weak_label(scored).alias("labelled"), held_out.alias("held_out"), "score", "is_secret",
    )
